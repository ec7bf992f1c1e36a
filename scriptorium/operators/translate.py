"""Translating: context, cache, budget, history. Set-wise; engines are plugged in as Arrow functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.functions import translation as R
from scriptorium.functions.profiles import DEVA, LEGACY_VERSION, PROMPT_VERSION, ScriptProfile
from scriptorium.operators.blocks import running_sum
from scriptorium.operators.reports import first_seen
from scriptorium.operators.upsert import first_wins
from scriptorium.session import ship

# --- context ------------------------------------------------------------------------------------


def preceding(rows: DataFrame, doc: str, order: Sequence[str], value: Column, n: int = 5, where: Column | None = None) -> DataFrame:
    """A column ``context``: the ``value`` of the last ``n`` earlier rows of the document that fit ``where``, in order.

    The frame is bounded: each row that fits gathers the ``n`` up to itself, and other
    rows take over the last such list, so no array holds a whole document. Both
    windows run on one exchange by document.
    """
    where = F.lit(True) if where is None else where
    w = Window.partitionBy(doc).orderBy(*order)
    ranked = rows.repartition(doc).withColumn("__fits", F.coalesce(where, F.lit(False)).cast("int"))
    fits = Window.partitionBy(doc, "__fits").orderBy(*order)
    own = F.collect_list(value).over(fits.rowsBetween(-(n - 1), 0))
    ranked = ranked.withColumn("__own", F.when(F.col("__fits") == 1, own))
    last = F.last("__own", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return ranked.withColumn("context", F.coalesce(last, F.slice(F.array(value), 1, 0))).drop("__fits", "__own")


def candidates(
    rows: DataFrame, skip: DataFrame | None = None, key: str = "key", min_quality: float = 0.35, profile: ScriptProfile = DEVA
) -> DataFrame:
    """Untranslated rows worth translating: kind, text, quality gate, and the user's skip list."""
    out = rows.filter(
        T.is_blank(F.col("translation"))
        & ~F.coalesce("text_type", F.lit("mula")).isin("noise", "frontmatter")
        & T.worth_translating(F.col("text"), profile)
        & ~T.skips_quality(F.col("quality_score"), min_quality)
    )
    return out if skip is None else out.join(skip.select(key).distinct(), key, "left_anti")


def anchor(reference: Column, score: Column, least: float = 0.6) -> Column:
    """The reference translation where it is not blank and scores ``least``; a null score counts as 0."""
    return F.when(~T.is_blank(reference) & (F.coalesce(score, F.lit(0.0)) >= least), reference)


# --- cache --------------------------------------------------------------------------------------

CACHE_KEYS = ("engine", "lang_in", "lang_out", "text_hash")


def with_cache_key(rows: DataFrame, engine: str, lang_in: str, lang_out: str, text: str = "text", version: str = PROMPT_VERSION) -> DataFrame:
    return rows.withColumns(
        {
            "engine": F.lit(engine),
            "lang_in": F.lit(lang_in),
            "lang_out": F.lit(lang_out),
            "text_hash": R.cache_key(F.col(text), version),
        }
    )


def lookup(rows: DataFrame, cache: DataFrame) -> DataFrame:
    """``output`` (null: a miss) for each row; the cache has a key once."""
    return rows.join(cache.select(*CACHE_KEYS, "output"), list(CACHE_KEYS), "left")


def admissible(source: Column, output: Column, lang: str = "en") -> Column:
    return ~T.is_blank(output) & ~R.is_boilerplate(output, lang) & ~R.is_echo(source, output, lang)


def admit(cache: DataFrame, results: DataFrame, order: str, lang: str = "en") -> DataFrame:
    """The cache with new outputs that may be kept; the first for a key wins."""
    good = results.filter(admissible(F.col("text"), F.col("output"), lang))
    return first_wins(cache, good, CACHE_KEYS, order)


def poison_report(cache: DataFrame, lang: str = "en") -> DataFrame:
    """For each engine: rows, blank ones, boilerplate, and what a purge keeps."""
    blank = T.is_blank(F.col("output"))
    junk = ~blank & R.is_boilerplate(F.col("output"), lang)
    return cache.groupBy("engine").agg(
        F.count("*").alias("total"),
        F.count_if(blank).alias("empty"),
        F.count_if(junk).alias("junk"),
        F.count_if(~blank & ~junk).alias("kept"),
    )


def purge(cache: DataFrame, lang: str = "en") -> DataFrame:
    return cache.filter(~R.is_boilerplate(F.col("output"), lang))


# --- engines ------------------------------------------------------------------------------------

Engine = Callable[[list[str]], list[str]]


def echo_engine(messages: list[str]) -> list[str]:
    """A stand-in without a model. Its marks make the output inadmissible to the cache."""
    return ["[ECHO] " + m[:80] for m in messages]


def dictionary_engine(terms: dict[str, str]) -> Engine:
    """Word for word from a small dictionary."""
    return lambda messages: [" ".join(terms.get(w, w) for w in m.split()) for m in messages]


def run_engine(rows: DataFrame, engine: Engine, message: str, out: str = "output") -> DataFrame:
    """A column with the engine's answer to each message, batch by batch."""

    ship(rows.sparkSession)

    @F.pandas_udf("string")
    def answer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(engine(batch.fillna("").tolist()), dtype=object)

    return rows.withColumn(out, answer(F.col(message)))


def translate(
    rows: DataFrame, cache: DataFrame, engine: Engine, name: str, lang: str = "en", profile: ScriptProfile = DEVA
) -> DataFrame:
    """``rows`` (with ``key, doc, page_no, idx, text, iast, ...``) with ``output``, ``hit`` and scores.

    Hits come from the cache. A text that is missed is sent once, with the context of
    its first place, and its answer is stitched to all rows of that text. All rows are for one
    engine and one pair of languages, so the text's hash is the whole key.
    """
    keyed = with_cache_key(rows, name, "sa", lang)
    found = lookup(keyed, cache).withColumn("hit", F.col("output").isNotNull())
    misses = first_seen(found.filter("not hit"), ["text_hash"], ["doc", "page_no", "idx"])
    asked = run_engine(
        misses.withColumn("message", R.user_message(F.col("text"), F.col("iast"), F.col("context"), F.lit(None).cast("string"))),
        engine,
        "message",
    ).select("text_hash", F.col("output").alias("answer"))
    out = found.join(asked, "text_hash", "left").withColumn("output", F.coalesce("output", "answer")).drop("answer")
    kept = R.salvage(F.col("output"), lang)
    kept = F.when(R.is_echo(F.col("text"), kept, lang), F.lit("")).otherwise(kept)
    return out.withColumn("output", kept).withColumns(
        {
            "score": R.length_score(F.col("text"), F.col("output")),
            "qa": R.translation_quality(F.col("text"), F.col("output"), lang),
        }
    )


# --- costs and budget ---------------------------------------------------------------------------


def usage_totals(ledger: DataFrame) -> DataFrame:
    """Calls, characters, cost and passages by engine, from an append-only ledger."""
    hours = F.when(F.sum("duration_s") > 0, F.round(F.sum("passages") / F.greatest(F.lit(1.0), F.sum("duration_s")) * 3600, 1)).otherwise(0.0)
    return ledger.groupBy("engine").agg(
        F.count("*").alias("calls"),
        F.sum("in_chars").alias("in_chars"),
        F.sum("out_chars").alias("out_chars"),
        F.sum("cost_usd").alias("cost_usd"),
        F.sum("passages").alias("passages"),
        hours.alias("passages_per_hour"),
    )


def batch_estimate(rows: DataFrame, by: Sequence[str], message: Column, system_chars: int) -> DataFrame:
    """Characters that a batch will send and, at twice that, receive."""
    sent = F.sum(F.length(message)) + F.lit(system_chars) * F.count("*")
    return rows.groupBy(*by).agg(sent.alias("in_chars"), (2 * sent).alias("out_chars"))


def running_spend(calls: DataFrame, order: str, cost: str, by: Sequence[str] = (), width: float = 1_000_000) -> DataFrame:
    """``spent_before`` and ``spent`` at each call, in order; ``by`` (epochs, accounts) start anew.

    The order is a number, unique in an account. An account of any size is summed up
    in blocks of ``width`` of it.
    """
    out = running_sum(calls, by, order, cost, width, "spent")
    return out.withColumn("spent_before", F.col("spent") - F.col(cost))


def budget_gate(calls: DataFrame, order: str, cost: str, budget, by: Sequence[str] = (), width: float = 1_000_000) -> DataFrame:
    """``accepted``: false from the first call that would exceed the budget, for good.

    Until then all earlier calls were accepted, so the plain running sum is right;
    what comes at or after an account's first breach, a pre-aggregated minimum, is refused.
    """
    spent = running_spend(calls, order, cost, by, width)
    at = spent.filter(F.col("spent") > F.lit(budget)).groupBy(*by).agg(F.min(order).alias("__breach"))
    if not by:
        first = at.first()  # one row
        return spent.withColumn("accepted", F.lit(True) if first["__breach"] is None else F.col(order) < F.lit(first["__breach"]))
    at = at.select(*(F.col(c).alias(f"__{c}") for c in by), "__breach")
    on = _same(by)
    late = F.coalesce(F.col(order) >= F.col("__breach"), F.lit(False))
    return spent.join(at, on, "left").withColumn("accepted", ~late).select(*spent.columns, "accepted")


def failure_streaks(
    calls: DataFrame, by: Sequence[str], order: Sequence[str], ok: Column, limit: int = 15, width: float | None = None
) -> DataFrame:
    """``streak``: failures in a row up to each call, 0 at a success; ``aborts`` from ``limit`` on.

    With ``width``, and an order that is one number, unique in a group, a group of any size is worked
    out in blocks of ``width`` of it: what a block ends with is carried to the next ones.
    """
    if width is None:
        blocks, keyed = list(by), calls
    else:
        blocks, keyed = [*by, "__block"], calls.withColumn("__block", F.floor(F.col(order[0]) / width))
    up_to = Window.partitionBy(*blocks).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    island = keyed.withColumn("__ok", ok.cast("int")).withColumn("__island", F.sum("__ok").over(up_to))
    inside = Window.partitionBy(*blocks, "__island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = island.withColumn("streak", F.sum(1 - F.col("__ok")).over(inside))
    if width is not None:
        # of each block: whether it has a success, and its failures behind the last one
        last = F.max_by(F.when(ok, F.col(order[0])), F.when(ok, F.col(order[0])))
        ends = keyed.groupBy(*blocks).agg(last.alias("__last"))
        tails = keyed.join(ends.select(*(F.col(c).alias(f"__{c}") for c in by), F.col("__block").alias("__b"), "__last"), _same(by) & F.col("__block").eqNullSafe(F.col("__b")))
        tails = tails.groupBy(*blocks).agg(
            F.max(F.col("__last").isNotNull()).alias("__any"), F.count_if(F.coalesce(F.col(order[0]) > F.col("__last"), F.lit(True))).alias("__tail")
        )
        over = Window.partitionBy(*by).orderBy("__block").rowsBetween(Window.unboundedPreceding, 0)
        tails = tails.withColumn("__run", F.sum(F.col("__any").cast("int")).over(over))
        since = Window.partitionBy(*by, "__run").orderBy("__block").rowsBetween(Window.unboundedPreceding, 0)
        tails = tails.withColumn("__sum", F.sum("__tail").over(since))
        carried = F.lag("__sum", 1, 0).over(Window.partitionBy(*by).orderBy("__block"))
        tails = tails.select(*(F.col(c).alias(f"__{c}") for c in by), F.col("__block").alias("__b"), carried.alias("__carried"))
        found = found.join(tails, _same(by) & F.col("__block").eqNullSafe(F.col("__b")))
        found = found.withColumn("streak", F.col("streak") + F.when(F.col("__island") == 0, F.col("__carried")).otherwise(0))
    return found.withColumn("aborts", F.col("streak") >= limit).select(*calls.columns, "streak", "aborts")


def _same(by: Sequence[str]) -> Column:
    """Null-safe equality of columns with those of the same name behind ``__``."""
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return on


# --- history ------------------------------------------------------------------------------------

PROVENANCE = ("translation", "engine", "translation_qa", "mt_prompt_version")


def retranslate_pick(
    rows: DataFrame, doc: str | None = None, below: float | None = None, version: str | None = None
) -> DataFrame:
    """Translated rows to do again, with the ``reason``. At least one of ``below`` and ``version`` has to be given."""
    if below is None and version is None:
        raise ValueError("without a threshold or a prompt version this would pick everything")
    out, reasons = rows.filter(~T.is_blank(F.col("translation"))), []
    if doc is not None:
        out = out.filter(F.col("doc") == doc)
    if below is not None:
        out = out.filter(F.col("translation_qa").isNotNull() & (F.col("translation_qa") < below))
        reasons.append(f"qa<{below:g}")
    if version is not None:
        out = out.filter(F.col("mt_prompt_version") == version)
        reasons.append(f"prompt-upgrade:{version}")
    return out.withColumn("reason", F.lit(";".join(reasons)))


def archive_and_clear(rows: DataFrame, picked: DataFrame, key: str = "key") -> tuple[DataFrame, DataFrame]:
    """Rows for the history, and the table with the picked rows' translations and provenance as nulls."""
    history = picked.filter(~T.is_blank(F.col("translation"))).select(key, *PROVENANCE, "reason")
    marked = rows.join(picked.select(key, F.lit(True).alias("__picked")), key, "left")
    cleared = [
        (F.when(F.col("__picked").isNull(), F.col(c)) if c in PROVENANCE else F.col(c)).alias(c) for c in rows.columns
    ]
    return history, marked.select(*cleared)


def supersede(rows: DataFrame, new: DataFrame, key: str = "key", reason: str = "retranslated") -> tuple[DataFrame, DataFrame]:
    """History rows for translations that ``new`` replaces, and the table with the new ones. No text is lost."""
    picked = rows.join(new.select(key), key, "left_semi").withColumn("reason", F.lit(reason))
    history = picked.filter(~T.is_blank(F.col("translation"))).select(key, *PROVENANCE, "reason")
    n = new.select(key, *(F.col(c).alias(f"__{c}") for c in PROVENANCE), F.lit(True).alias("__new"))
    take = lambda c: F.when(F.col("__new"), F.col(f"__{c}")).otherwise(F.col(c)) if c in PROVENANCE else F.col(c)
    return history, rows.join(n, key, "left").select(*(take(c).alias(c) for c in rows.columns))


def backfill_version(rows: DataFrame, version: str = LEGACY_VERSION) -> DataFrame:
    """A prompt version for translated rows that have none."""
    fill = T.is_blank(F.col("mt_prompt_version")) & ~T.is_blank(F.col("translation"))
    return rows.withColumn("mt_prompt_version", F.when(fill, version).otherwise(F.col("mt_prompt_version")))


def score_rows(rows: DataFrame, lang: str = "en") -> DataFrame:
    """``translation_qa`` anew for translated rows; others have none."""
    qa = R.translation_quality(F.col("text"), F.col("translation"), lang)
    return rows.withColumn("translation_qa", F.when(~T.is_blank(F.col("translation")), qa))


def heal(rows: DataFrame, below: float = 0.6, lang: str = "en", key: str = "key") -> tuple[DataFrame, DataFrame]:
    """Scan, archive and clear: the history's new rows and a table in which what scores too low is open again."""
    scored = score_rows(rows, lang)
    return archive_and_clear(scored, retranslate_pick(scored, below=below), key)
