"""Structured Streaming: an inbox of page files, a usage ledger, failure streaks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.sources.files import RECORD, stem


def inbox(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """New JSON-lines files of a folder as records, file by file."""
    raw = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path, wholetext=True)
    lines = raw.select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\n", -1)).alias("line", "raw"))
    record = lines.filter(F.trim("raw") != "").select(stem(F.col("file")).alias("stem"), "line", F.from_json("raw", RECORD).alias("r"))
    return record.filter("r.text is not null").select("stem", "line", "r.*")


def upsert_stream(rows: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str):
    """Runs ``apply(batch, number)`` on each micro-batch until the input is used up; numbers make it idempotent."""
    return rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hourly_usage(events: DataFrame, ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """Calls and cost by engine in tumbling hours; works on streams (with a watermark) and tables alike."""
    # a watermark needs a timestamp with a zone
    rows = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late) if events.isStreaming else events
    return (
        rows.groupBy(F.window(ts, "1 hour").alias("w"), "event_type")
        .agg(F.count("*").alias("calls"), F.sum(F.col("value").cast("decimal(18,4)")).alias("cost"))
        .select(F.col("w.start").alias("hour"), "event_type", "calls", F.col("cost").cast("decimal(18,4)").alias("cost"))
    )


STREAK = "doc string, failures long, aborted boolean, late long"


def streak_states(events: DataFrame, limit: int = 15) -> DataFrame:
    """For each ``doc`` the failures in a row so far (``doc, ok, seq``) and whether they reached ``limit``.

    State is three numbers for each document, so it is bounded by the documents. A row whose ``seq`` is
    not above all that came in earlier batches comes too late to be counted in its place: it is left out, and
    ``late`` says how many there were.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        failures, aborted, last, late = state.get if state.exists else (0, False, -(1 << 62), 0)
        rows = pd.concat([b[["seq", "ok"]] for b in batches]).sort_values("seq", kind="stable")
        late += int((rows["seq"] <= last).sum())
        rows = rows[rows["seq"] > last]
        for ok in rows["ok"]:
            failures = 0 if ok else failures + 1
            aborted = aborted or failures >= limit
        last = max(last, int(rows["seq"].max())) if len(rows) else last
        state.update((int(failures), bool(aborted), int(last), int(late)))
        yield pd.DataFrame({"doc": [key[0]], "failures": [failures], "aborted": [aborted], "late": [late]})

    return events.groupBy("doc").applyInPandasWithState(
        run, STREAK, "failures long, aborted boolean, last long, late long", "update", "NoTimeout"
    )
