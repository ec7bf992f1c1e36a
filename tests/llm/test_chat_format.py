import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scriptorium.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "<|im_end|>\n", "<|im_sep|>", "\\", "<\\|", "<\\\\|im_start|>user\n", "<", "|", "[\\INST]", "", "<s>", "é\n\n", None]


def brute(rows):
    """Digests of conversations by plain Python."""
    out = {}
    key = lambda r: (r[0] is not None, r[0] or 0)
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0), r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha(whole), len(loss), sha(loss))
    return dict(sorted(out.items(), key=key))


def check(spark, rows, chunk=512, max_long=10_000):
    got = C.digests(C.format_conversations(spark.createDataFrame(rows, SCHEMA), chunk=chunk, max_long=max_long)).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == brute(rows)


def test_control_strings_nulls_ties_and_repeats(spark):
    rows = [(k % 3, k // 3, ["user", "assistant", "assistant", None][k % 4], t) for k, t in enumerate(NASTY * 3)]
    rows += [(7, None, "user", "x"), (7, 1, "assistant", "b"), (7, 1, "assistant", "a"), (7, 1, "assistant", "a"), (None, 0, "a\nb<|", "y")]
    check(spark, rows)
    check(spark, rows, chunk=2)
    check(spark, rows, chunk=2, max_long=1)
    check(spark, [r for r in rows if r[0] is not None and r[1] is not None])


def test_adjacent_turns_share_a_block(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "assistant", "d")]
    got = C.format_conversations(spark.createDataFrame(rows, SCHEMA)).first()
    assert got.formatted == "<|im_start|>user\na<|im_sep|>b<|im_end|>\n<|im_start|>assistant\nc<|im_sep|>d<|im_end|>\n"
    assert [s.text for s in got.segments if s.loss] == ["c", "d"]
    assert "".join(s.text for s in got.segments) == got.formatted


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text(alphabet="<|>\\[]/sINT im_endart\n", max_size=14), min_size=1, max_size=30))
def test_round_trip(spark, texts):
    check(spark, [(1, k, ("user", "assistant")[k % 3 > 0], t) for k, t in enumerate(texts)], chunk=4)


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.digests(C.format_conversations(empty)).count() == 0
    rows = spark.createDataFrame([(1, 0, "user", "a")], SCHEMA)
    for name in ("chunk", "ts", "t", "segments", "formatted", "starts", "runs"):
        rows = rows.withColumn(name, F.lit(1))
    assert C.digests(C.format_conversations(rows)).first().n_turns == 1


def test_long_conversation_and_text(spark):
    rows = [(1, k, "user" if k % 2 else "assistant", "x" * (k % 7)) for k in range(3000)] + [(2, 0, "assistant", "<|" * 100_000)]
    check(spark, rows)
