"""Pipelines: ingest pages, translate a document, heal weak translations. One write for each table and run."""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.functions import verses as V
from scriptorium.functions.profiles import DEVA, PROMPT_VERSION, ScriptProfile
from scriptorium.operators import batches, ledger, reports, segment, sinks, translate, upsert
from scriptorium.plans.catalog import Catalog
from scriptorium.sources.files import page_from_name
from scriptorium.streaming.intake import inbox, upsert_stream

SETTINGS = "seq long, action string, budget_usd double"
CACHE = "engine string, lang_in string, lang_out string, text_hash string, text string, output string"
PASSAGES = {
    "doc": "string",
    "page_no": "int",
    "idx": "int",
    "text": "string",
    "norm": "string",
    "iast": "string",
    "verse_ref": "string",
    "chapter": "string",
    "text_type": "string",
    "chandas": "string",
    "padas": "int",
    "quality_score": "double",
    "translation": "string",
    "engine": "string",
    "translation_qa": "double",
    "mt_prompt_version": "string",
}


def passages_of(pages: DataFrame, profile: ScriptProfile = DEVA) -> DataFrame:
    """Passages out of records ``doc, page_no, line, text``; ``norm`` holds the record's normalised text.

    Predicates on documents and pages belong before this: they pass below the Unicode
    normalisation, which is the only Arrow function here.
    """
    normal = pages.select("doc", "page_no", "line", T.normalize_verses(F.col("text"), profile).alias("norm")).filter("norm <> ''")
    parts = segment.segment_pages(normal, ["doc", "page_no", "line"], "norm", profile)
    order = Window.partitionBy("doc", "page_no").orderBy("line", "nth")
    numbered = parts.withColumnRenamed("idx", "nth").withColumn("idx", F.row_number().over(order) - 1).drop("nth")
    return numbered.join(normal, ["doc", "page_no", "line"])


def ingest(catalog: Catalog, pages: DataFrame, profile: ScriptProfile = DEVA, iast: bool = True, tag: str | None = None) -> int:
    """Upserts a run's pages; translations, and passages that are gone from a page, stay. A ``tag`` is ingested once."""
    if tag is not None and (done := catalog.tagged("passages", tag)) is not None:
        return done
    new = passages_of(pages, profile)
    new = upsert.adapt(new.withColumn("iast", V.to_iast(F.col("text")) if iast else F.lit(None).cast("string")), PASSAGES, {})
    if not catalog.exists("passages"):
        return catalog.write("passages", new, tag=tag)
    return catalog.write("passages", upsert.upsert_passages(catalog.read("passages"), new), tag=tag)


def ingest_inbox(catalog: Catalog, path: str, checkpoint: str, profile: ScriptProfile = DEVA) -> None:
    """Ingests what is new in a folder of page files, batch by batch; a batch that is run again changes nothing."""

    stream = sha256(checkpoint.encode()).hexdigest()[:16]  # numbers of batches are a checkpoint's own

    def apply(batch: DataFrame, number: int) -> None:
        code = F.regexp_replace(F.regexp_replace("stem", "_norm$", ""), "_[0-9]+$", "")
        ingest(catalog, batch.select(code.alias("doc"), page_from_name(F.col("stem")).alias("page_no"), "line", "text"), profile, tag=f"{stream}-{number}")

    upsert_stream(inbox(catalog.spark, path), apply, checkpoint).awaitTermination()


def translate_document(
    catalog: Catalog, doc: str, engine: translate.Engine, name: str, profile: ScriptProfile = DEVA, lang: str = "en", n_context: int = 5
) -> int:
    """Cache first, then the engine; answers are scored, what they replace goes to the history."""
    passages = catalog.read("passages").withColumn("key", F.concat_ws("/", "doc", "page_no", "idx"))
    own = passages.filter(F.col("doc") == doc)
    context = translate.preceding(
        own, "doc", ["page_no", "idx"], F.struct("verse_ref", "translation"), n_context, ~T.is_blank(F.col("translation"))
    )
    todo = translate.candidates(context, profile=profile)
    cache = catalog.read("mt_cache")
    done = translate.translate(todo, cache, engine, name, lang, profile).filter(F.col("output") != "")
    done = done.withColumns(
        {"translation": F.col("output"), "translation_qa": F.col("qa"), "mt_prompt_version": F.lit(PROMPT_VERSION)}
    )
    at = catalog.write("translated", done)  # answers are asked for once, and read by all that follows
    done = catalog.read("translated", at)
    history, updated = translate.supersede(passages, done)
    if catalog.exists("translation_history"):
        history = catalog.read("translation_history").unionByName(history)
    catalog.write("translation_history", history)
    catalog.write("mt_cache", translate.admit(cache, done.filter("not hit"), "key", lang))
    return catalog.write("passages", updated.drop("key"))


def translate_open(
    catalog: Catalog,
    engine: translate.Engine,
    name: str,
    priorities: Sequence[str] = (),
    profile: ScriptProfile = DEVA,
    lang: str = "en",
    n_context: int = 5,
    size: int = batches.SIZE,
) -> bool:
    """All open passages of all documents, in batches under the budget; returns whether the budget ended the run.

    Documents go by ``priorities``, then by name. Tables ``usage_ledger`` and ``budget_settings`` hold what was spent and
    what may be; the calls are appended, and a breach is written as a pause, which stands until somebody resumes.
    """
    passages = catalog.read("passages").withColumn("key", F.concat_ws("/", "doc", "page_no", "idx"))
    log = catalog.read("usage_ledger") if catalog.exists("usage_ledger") else batches.empty_ledger(catalog.spark)
    settings = catalog.read("budget_settings") if catalog.exists("budget_settings") else catalog.spark.createDataFrame([], SETTINGS)
    state = ledger.budget_state(log, settings).first()
    if state.paused:
        return True
    done = ~T.is_blank(F.col("translation"))
    context = translate.preceding(passages, "doc", ["page_no", "idx"], F.struct("verse_ref", "translation"), n_context, done)
    todo = translate.candidates(context, profile=profile)
    # the order of the batches: documents are few and ranked, a place in one is made of page and index
    ranks = reports.by_priority(passages.select("doc").distinct(), priorities).withColumn(
        "rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("place"), "doc"))
    )
    todo = todo.join(ranks.select("doc", "rank"), "doc").withColumn("seq", F.expr("(cast(rank as long) << 44) + (cast(page_no as long) << 20) + idx"))
    cache = catalog.read("mt_cache") if catalog.exists("mt_cache") else catalog.spark.createDataFrame([], CACHE)
    out, calls, paused = batches.translate_batches(todo, cache, engine, name, state.budget_usd, state.spent_usd, "seq", size, lang, width=1 << 44)
    answered = out.filter(F.col("output") != "").withColumns({"translation": F.col("output"), "translation_qa": F.col("qa"), "engine": F.lit(name), "mt_prompt_version": F.lit(PROMPT_VERSION)})
    answered = catalog.read("translated", catalog.write("translated", answered))
    history, updated = translate.supersede(passages, answered)
    if catalog.exists("translation_history"):
        history = catalog.read("translation_history").unionByName(history)
    catalog.write("translation_history", history)
    asked = translate.with_cache_key(answered.filter("not hit"), name, "sa", lang)
    catalog.write("mt_cache", translate.admit(cache, asked, "key", lang))
    first = log.agg(F.coalesce(F.max("seq") + 1, F.lit(0)).alias("n")).first().n
    catalog.write("usage_ledger", log.unionByName(calls.withColumn("seq", F.col("seq") + F.lit(first))))
    if paused:
        at = settings.agg(F.coalesce(F.max("seq") + 1, F.lit(0)).alias("n")).first().n
        catalog.write("budget_settings", settings.unionByName(catalog.spark.createDataFrame([(at, "pause", None)], SETTINGS)))
    catalog.write("passages", updated.drop("key"))
    return paused


def advance(
    catalog: Catalog, pages: DataFrame, engine: translate.Engine, name: str, folder: str, priorities: Sequence[str] = (), profile: ScriptProfile = DEVA
) -> bool:
    """Page records in, books out: ingest, translate what is open, write every document's book."""
    ingest(catalog, pages, profile)
    paused = translate_open(catalog, engine, name, priorities, profile)
    sinks.write_book(sinks.book(catalog.read("passages")), folder)
    return paused


def heal(catalog: Catalog, below: float = 0.6, lang: str = "en") -> int:
    """Scores all, archives and clears what is below the threshold."""
    passages = catalog.read("passages").withColumn("key", F.concat_ws("/", "doc", "page_no", "idx"))
    history, cleared = translate.heal(passages, below, lang)
    if catalog.exists("translation_history"):
        history = catalog.read("translation_history").unionByName(history)
    catalog.write("translation_history", history)
    return catalog.write("passages", cleared.drop("key"))
