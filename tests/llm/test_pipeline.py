"""The pipeline against plain Python over the smallest tables, and each stage's promises."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scriptorium.llm import language as L
from scriptorium.llm import packing as P
from scriptorium.llm import secret_scan as S
from scriptorium.llm.queries import ORACLE_SQL, QUERIES, language_model
from scriptorium.session import table
from tests.llm.test_corpus_operators import brute_components, check_packing, containment_brute, fingerprint_brute

SF = "/root/testdata/sf0.001"


def test_pipeline_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    model = language_model(docs)
    left = {}
    for r in docs.collect():
        lang, score = model.predict(r.text)
        if lang != "und" and score >= L.MIN_SCORE:
            left[r.doc_id] = r.text
    fps = {k: fingerprint_brute(t) for k, t in left.items()}
    label = brute_components(sorted(set(fps.values())))
    least = {}
    for k in sorted(left):
        least.setdefault(label[fps[k]], k)
    left = {k: left[k] for k in least.values()}
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    leaked = {d for d, *_ in containment_brute(list(left.items()), items)}
    enc = S.encoding()
    left = {k: S.without(t, S.spans(t, enc), "[SECRET]") for k, t in left.items() if k not in leaked}
    library = P.Encoder(P.model_path("word_bpe_49k.json")).library
    ids = {k: library.encode(t, add_special_tokens=False).ids + [2] for k, t in left.items()}
    assert check_packing(corpus_pipeline.run(spark, SF).collect(), ids) == 0


def test_stages_keep_the_columns(spark, tmp_path):
    docs = table(spark, SF, "documents")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        out.write.parquet(f"{tmp_path}/{k}")
        before, docs = docs.count(), spark.read.parquet(f"{tmp_path}/{k}")
        assert 0.7 * before < docs.count() <= before
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "packing"]


def test_stages_on_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_stages_on_odd_rows(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    rows = [tuple(r) for r in docs.collect()]
    long = max(rows, key=lambda r: r[4])
    fresh = "The mother of the other brother was thinking of the weather in the north and the earth of the third month."
    odd = [
        (None, None, None, None, None), (9001, None, "en", "s", 0), (9002, "", None, None, 0), (9003, "12 34 !!", "en", "s", 8), (9004, "Русский текст без всякого языка", None, "s", 31),
        (9005, fresh, "en", "s", len(fresh)), (9005, fresh, "en", "s", len(fresh)), (None, fresh, "en", "s", len(fresh)), (9006, fresh + " ", "en", "s", len(fresh) + 1),
        (9007, long[1] * 20, long[2], long[3], long[4] * 20),
    ]
    both = spark.createDataFrame(rows + odd, docs.schema).withColumns({c: F.lit("x") for c in ("fp", "root", "k0", "lang_pred", "score", "spans", "row", "start")})
    kept = both
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.columns == both.columns
    ids = [r.doc_id for r in kept.collect()]
    assert [k for k in (9001, 9002, 9003, 9004, 9006) if k in ids] == [] and ids.count(9005) == 1 and ids.count(None) == 1
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect()
    assert {r.doc_id for r in packed} == set(ids) and "fp" not in packed[0].asDict()


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, name):
    from tests.oracle import compare, connect

    assert compare(name, spark, connect("/root/testdata/sf0.01"), "/root/testdata/sf0.01") > 20


def test_scores_of_nothing_learned():
    assert L.Profiles([], np.zeros((0, L.DIMS))).predict("abc") == ("und", 0.0)
