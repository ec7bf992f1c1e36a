"""Gazetteers: loading, merging, finding entities, alias graphs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import verses as V
from scriptorium.operators.reports import first_seen
from scriptorium.session import prepare_batches

#: Words of a dictionary entry that tell a name's kind; the first kind that fits counts.
KIND_WORDS = (
    ("TRIBE", ("tribe", "people", "nation")),
    ("LOC", ("city", "town", "capital", "kingdom")),
    ("RIVER", ("river", "nadi", "nadī")),
    ("MOUNTAIN", ("mountain", "parvata")),
)


def guess_kind(entry: Column) -> Column:
    """The kind that a dictionary entry's words tell, or null."""
    out = F.lit(None).cast("string")
    for kind, words in reversed(KIND_WORDS):
        pattern = rf"(?iu)(?<![\p{{L}}\p{{N}}_])(?:{'|'.join(words)})(?![\p{{L}}\p{{N}}_])"
        out = F.when(F.regexp_like(entry, F.lit(pattern)), kind).otherwise(out)
    return out


def merge(seed: DataFrame, harvested: DataFrame, key: str = "surface") -> DataFrame:
    """The seed's entries, and harvested ones whose surface it does not have."""
    return seed.unionByName(harvested.join(seed.select(key), key, "left_anti"), allowMissingColumns=True)


def forms(entries: DataFrame) -> DataFrame:
    """``form, canonical, label, gaz_index``: the surface and each alias of an entry ``(gaz_index, surface, type, aliases)``."""
    every = F.array_distinct(F.concat(F.array("surface"), F.coalesce("aliases", F.array().cast("array<string>"))))
    return entries.select(
        F.explode(every).alias("form"), F.col("surface").alias("canonical"), F.col("type").alias("label"), "gaz_index"
    ).filter(F.coalesce("form", F.lit("")) != "")


def find_entities(rows: DataFrame, key: str, text: str, known: DataFrame, max_forms: int = 50_000, max_chars: int = 2_000_000) -> DataFrame:
    """``key, start, end, form, label, canonical, gaz_index``: all places of all forms, overlapping ones too.

    Up to ``max_forms`` distinct forms of ``max_chars`` together, both counted, are broadcast as one
    automaton, and a task finds their places in one pass over its texts; only places leave it.
    A larger gazetteer meets the texts in an equi-join on the forms' first three characters (shorter
    forms: on what they have); a place carries as much text as the longest form has.
    """
    known = known.select("form", "label", "canonical", "gaz_index").distinct()
    size = known.select("form").distinct().agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("form")), F.lit(0)).alias("chars")).first()
    if size.n <= max_forms and size.chars <= max_chars:
        places = _places(rows.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")), [r.form for r in known.select("form").distinct().collect()])
        found = places.join(F.broadcast(known), "form")
        return found.select(F.col("k").alias(key), "start", (F.col("start") + F.length("form")).alias("end"), "form", "label", "canonical", "gaz_index")
    stats = known.agg(F.max(F.length("form")).alias("longest"), F.collect_set(F.least(F.length("form"), F.lit(3))).alias("sizes")).first()
    heads = known.withColumn("__head", F.substring("form", 1, 3))
    at = _windows(rows.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")), stats.longest)
    at = at.select("k", "start", "here", F.explode(F.array_distinct(F.array(*(F.substring("here", 1, n) for n in sorted(stats.sizes))))).alias("__head"))
    hits = at.join(heads, "__head").filter(F.col("here").startswith(F.col("form")))
    return hits.select(F.col("k").alias(key), "start", (F.col("start") + F.length("form")).alias("end"), "form", "label", "canonical", "gaz_index")


def _places(rows: DataFrame, words: list[str]) -> DataFrame:
    """``k, form, start`` of each place of a word in the texts ``t``."""
    spark = rows.sparkSession
    prepare_batches(spark)
    shared = spark.sparkContext.broadcast(sorted(words))
    kind = rows.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        forms, automaton = shared.value, ahocorasick.Automaton()
        for n, form in enumerate(forms):
            automaton.add_word(form, n)
        if forms:
            automaton.make_automaton()
        names = pa.array(forms, pa.string())
        for batch in batches:
            owner, number, start = [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                if text and forms:
                    for end, n in automaton.iter(text):
                        owner.append(row)
                        number.append(n)
                        start.append(end + 1 - len(forms[n]))
                if len(owner) >= 200_000:  # a very long text must not grow one batch without end
                    yield out(batch, names, owner, number, start)
                    owner, number, start = [], [], []
            yield out(batch, names, owner, number, start)

    def out(batch, names, owner, number, start) -> pa.RecordBatch:
        at = pa.array(owner, pa.int64())
        columns = [batch.column(0).take(at), names.take(pa.array(number, pa.int64())), pa.array(start, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, ["k", "form", "start"])

    return rows.mapInArrow(run, f"k {kind}, form string, start int")


def _windows(rows: DataFrame, width: int) -> DataFrame:
    """``k, start, here``: the ``width`` characters at each place of the texts ``t``, fewer at the end."""
    prepare_batches(rows.sparkSession)
    kind = rows.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in enumerate(batch.column(1).to_pylist()):
                for first in range(0, len(text or ""), 50_000):
                    places = range(first, min(first + 50_000, len(text)))
                    at = pa.array([row] * len(places), pa.int64())
                    columns = [batch.column(0).take(at), pa.array(places, pa.int32()), pa.array([text[k : k + width] for k in places], pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, ["k", "start", "here"])

    return rows.mapInArrow(run, f"k {kind}, start int, here string")


def entities_by_form(rows: DataFrame, key: str, text: str, form: str) -> DataFrame:
    """``key, start``: the places of one form."""
    return rows.select(key, F.explode(V.find_all(F.col(text), F.lit(form))).alias("start"))


def dedupe(entities: DataFrame, key: str) -> DataFrame:
    """Each span and label of a row once: the first gazetteer entry's."""
    return first_seen(entities, [key, "start", "end", "label"], ["gaz_index", "form"])


def alias_graph(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes ``(id, kind)`` and edges ``(source, target, relation)``."""
    edges = entries.select(F.explode("aliases").alias("source"), F.col("surface").alias("target")).withColumn("relation", F.lit("alias_of"))
    nodes = (
        entries.select(F.col("surface").alias("id"), F.col("type").alias("kind"))
        .unionByName(edges.select(F.col("source").alias("id"), F.lit("alias").alias("kind")))
        .groupBy("id")
        .agg(F.min_by("kind", F.col("kind") == "alias").alias("kind"))
    )
    return nodes, edges.distinct()
