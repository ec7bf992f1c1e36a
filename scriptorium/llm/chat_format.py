"""Chat formatting with Spark expressions only.

A conversation's rows become one formatted string. Adjacent turns of one role
share a block::

    <|im_start|>ROLE\\nTEXT<|im_sep|>TEXT<|im_end|>\\n

Control strings inside texts and roles are escaped reversibly: backslashes are
doubled, then a single backslash goes behind the first character of each control
string. A line break inside a role becomes ``<\\n>`` in the same manner.

Defined results: a null text or role counts as empty; rows with a null turn come
first; rows of one turn are ordered by role, then text; repeated rows are all
kept; rows with a null ``conv_id`` form one conversation; an empty table gives an
empty table; other columns are ignored.

A conversation is one output value, so its rows must meet. Rows are gathered by
chunks of ``chunk`` turns; sorting and escaping run on chunks. Most conversations
are one chunk, and complete with that one shuffle; which are longer is known from
their turn numbers alone. Their chunks meet in a second step: if there are up to
``max_long`` of them, theirs alone, else those of all conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
#: What no text may hold unescaped: the template's own marks and those of other templates.
CONTROL = r"<\||</?s>|\[/?INST\]"
_FIRST = rf"(?={CONTROL})(.)"
_MARKED = r"(<)\\(?=\||/?s>)|(\[)\\(?=/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _FIRST, r"$1\\")


def unescape(text: Column) -> Column:
    return F.replace(F.regexp_replace(text, _MARKED, "$1$2"), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n>"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n>"), F.lit("\n")))


def format_conversations(rows: DataFrame, loss_role: str = "assistant", chunk: int = 512, max_long: int = 10_000) -> DataFrame:
    """``conv_id, formatted string, segments array<struct<text, loss>>``.

    The segments' texts concatenated are ``formatted``; ``loss`` marks those that
    the loss is taken on, each text of ``loss_role`` as one segment.
    """
    turn = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    key = F.coalesce(F.floor(F.col("turn") / chunk), F.lit(-(1 << 62)))
    chunks = (
        rows.select("conv_id", key.cast("long").alias("chunk"), turn.alias("t"))
        .groupBy("conv_id", "chunk")
        .agg(F.array_sort(F.collect_list("t")).alias("ts"))
        .select(
            "conv_id",
            "chunk",
            F.transform(
                "ts",
                lambda t: F.struct(
                    escape_role(t.role).alias("role"),
                    escape(t.text).alias("text"),
                    (t.role == loss_role).alias("loss"),
                ),
            ).alias("ts"),
        )
    )

    def joined(parts: DataFrame) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct("chunk", "ts")))
        return parts.groupBy("conv_id").agg(F.flatten(F.transform(ordered, lambda c: c.ts)).alias("ts"))

    places = rows.select(F.col("conv_id").alias("__long"), key.alias("chunk")).groupBy("__long")
    long = places.agg(F.min("chunk").alias("a"), F.max("chunk").alias("b")).filter("a <> b").select("__long", F.lit(True).alias("__is"))
    n_long = long.limit(max_long + 1).count()
    if n_long == 0:
        whole = chunks.select("conv_id", "ts")
    elif n_long <= max_long:
        marked = chunks.join(F.broadcast(long), F.col("conv_id").eqNullSafe(F.col("__long")), "left")
        whole = marked.filter("__is is null").select("conv_id", "ts").unionByName(joined(marked.filter("__is is not null")))
    else:
        whole = joined(chunks)
    # where a run of one role starts, and where the next one does
    starts = F.filter(
        F.sequence(F.lit(0), F.size("ts") - 1),
        lambda i: (i == 0) | (F.get("ts", i).role != F.get("ts", F.greatest(i - 1, F.lit(0))).role),
    )
    runs = F.transform(
        "starts",
        lambda s, k: F.struct(
            F.get("ts", s).role.alias("role"),
            F.slice(
                "ts",
                s + 1,
                F.coalesce(F.get("starts", k + 1), F.size("ts")) - s,
            ).alias("turns"),
        ),
    )
    mark = lambda text: F.struct(text.alias("text"), F.lit(False).alias("loss"))
    segments = F.flatten(
        F.transform(
            "runs",
            lambda r: F.concat(
                F.array(mark(F.concat(F.lit(START), r.role, F.lit("\n")))),
                F.flatten(
                    F.transform(
                        r.turns,
                        lambda t, i: F.when(
                            i > 0,
                            F.array(mark(F.lit(SEP)), F.struct(t.text.alias("text"), t.loss.alias("loss"))),
                        ).otherwise(F.array(F.struct(t.text.alias("text"), t.loss.alias("loss")))),
                    )
                ),
                F.array(mark(F.lit(END))),
            ),
        )
    )
    return (
        whole.withColumn("starts", starts)
        .select("conv_id", runs.alias("runs"))
        .select("conv_id", segments.alias("segments"))
        .select("conv_id", F.array_join(F.col("segments.text"), "").alias("formatted"), "segments")
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted string: ``array<struct<role, text>>``."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda b: b != "")
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(F.regexp_replace(b, r"^[^\n]*\n", ""), r"<\|im_sep\|>", -1),
                lambda text: F.struct(
                    unescape_role(F.regexp_extract(b, r"^<\|im_start\|>([^\n]*)\n", 1)).alias("role"),
                    unescape(text).alias("text"),
                ),
            ),
        )
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Lengths and digests, read back from what ``format_conversations`` returned."""
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s.loss), lambda s: unescape(s.text)), "")
    return formatted.select(
        "conv_id", "formatted", read_back(F.col("formatted")).alias("turns"), loss.alias("loss_text")
    ).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(
            F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), ""), 256
        ).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
