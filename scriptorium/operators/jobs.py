"""Jobs and annotation: which queued jobs may start; passages with their entities as tasks for an annotator."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: How many jobs of a kind may run at once, all other kinds together, and the labels of annotation.
SLOTS, OTHER_SLOTS = {"ocr": 2, "translate": 1}, 3
LABELS = ("PERSON", "LOC", "TRIBE", "DEITY", "CLAN", "RIVER", "MOUNTAIN")


def startable(jobs: DataFrame) -> DataFrame:
    """The queued jobs of ``seq, kind, doc, state`` (``queued``, ``running`` or another) that may start, with their ``pool``.

    A job is left out while an earlier one of its kind and document is queued or runs. In each pool the
    first by ``seq`` take the slots that running jobs leave.
    """
    pool = F.when(F.col("kind").isin(*SLOTS), F.col("kind")).otherwise("other")
    live = jobs.filter(F.col("state").isin("queued", "running")).withColumn("pool", pool)
    running = live.filter("state = 'running'")
    slots = F.lit(OTHER_SLOTS)
    for kind, n in SLOTS.items():
        slots = F.when(F.col("pool") == kind, n).otherwise(slots)
    busy = running.groupBy("pool").agg(F.count("*").alias("busy"))
    first = live.groupBy("kind", "doc").agg(F.min(F.struct((F.col("state") != "running").alias("waits"), F.col("seq"))).alias("f"))
    queued = first.filter("f.waits").select("kind", "doc", "f.seq").withColumn("pool", pool)
    most = max(*SLOTS.values(), OTHER_SLOTS)
    # a rank below a constant: each task keeps so many rows of a pool and shuffles no others
    ranked = queued.withColumn("n", F.row_number().over(Window.partitionBy("pool").orderBy("seq"))).filter(F.col("n") <= most)
    left = ranked.join(busy, "pool", "left").filter(F.col("n") <= slots - F.coalesce("busy", F.lit(0)))
    return left.select("seq", "kind", "doc", "pool")


def annotation_tasks(rows: DataFrame, entities: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key, task``: each passage as a JSON task, with its entities of ``LABELS`` as labels to correct.

    ``entities`` are ``key, start, end, form, label``, as ``gazetteer.find_entities`` gives them.
    """
    value = F.struct("start", "end", F.col("form").alias("text"), F.array("label").alias("labels"))
    result = F.struct(F.lit("labels").alias("from_name"), F.lit("text").alias("to_name"), F.lit("labels").alias("type"), value.alias("value"))
    ordered = F.array_sort(F.collect_list(F.struct("start", "end", "label", result.alias("result"))))
    found = entities.filter(F.col("label").isin(*LABELS)).groupBy(F.col(key).alias("__key")).agg(F.transform(ordered, lambda r: r.result).alias("result"))
    # a passage without entities has an empty list
    shape = "array<struct<from_name: string, to_name: string, type: string, value: struct<start: int, end: int, text: string, labels: array<string>>>>"
    joined = rows.join(found, F.col(key).eqNullSafe(F.col("__key")), "left")
    task = F.struct(
        F.struct(F.col(text).alias("text")).alias("data"),
        F.array(F.struct(F.coalesce(F.col("result").cast(shape), F.array().cast(shape)).alias("result"))).alias("predictions"),
    )
    return joined.select(key, F.to_json(task).alias("task"))
