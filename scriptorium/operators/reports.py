"""Reports and selections over passages: conditional aggregates, paging, audits, samples, search."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.functions.profiles import DEVA, ScriptProfile
from scriptorium.operators.blocks import row_numbers

# --- quality ------------------------------------------------------------------------------------

EDGES = (0.0, 0.2, 0.4, 0.6, 0.8)


def _bucket(qa: Column, k: int) -> Column:
    low = qa >= EDGES[k] if k else F.lit(True)
    return F.count_if(qa.isNotNull() & low & ((qa < EDGES[k + 1]) if k + 1 < len(EDGES) else F.lit(True)))


def qa_summary(rows: DataFrame, by: Sequence[str] = ("doc",)) -> DataFrame:
    """Rows, translated, pending, unscored and scored ones, mean score and five buckets."""
    qa, done = F.col("translation_qa"), ~T.is_blank(F.col("translation"))
    return rows.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if(done).alias("translated"),
        (F.count("*") - F.count_if(done)).alias("pending"),
        F.count_if(done & qa.isNull()).alias("unscored"),
        F.count(qa).alias("scored"),
        F.round(F.avg(qa), 6).alias("mean_qa"),
        *(_bucket(qa, k).alias(f"b{k}") for k in range(len(EDGES))),
    )


def histogram(rows: DataFrame, by: Sequence[str], score: Column, width: int = 30) -> DataFrame:
    """For each group and bucket: rows, share as a bar of ``#``."""
    bucket = F.least(F.floor(score * 5), F.lit(4)).cast("int")
    n = rows.filter(score.isNotNull()).groupBy(*by, bucket.alias("bucket")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*by))
    return n.withColumn("bar", F.repeat(F.lit("#"), F.floor(width * F.col("n") / total + 0.5).cast("int")))


def real_rows(rows: DataFrame) -> DataFrame:
    """Without noise and front matter; a row without a kind is a verse."""
    return rows.filter(~F.coalesce("text_type", F.lit("mula")).isin("noise", "frontmatter"))


def pending_queue(rows: DataFrame, threshold: float, limit: int, order: Sequence[str] = ("doc", "page_no", "idx")) -> DataFrame:
    """The first ``limit`` untranslated real rows, and whether the quality gate would skip them."""
    out = real_rows(rows).filter(T.is_blank(F.col("translation")))
    flagged = out.withColumn("below_threshold", T.skips_quality(F.col("quality_score"), threshold))
    return flagged.orderBy(*order).limit(limit)


def weakest(rows: DataFrame, below: float = 0.6, limit: int = 200, order: Sequence[str] = ("doc", "page_no", "idx")) -> DataFrame:
    return rows.filter(F.col("translation_qa") < below).orderBy("translation_qa", *order).limit(limit)


def page_of(rows: DataFrame, order: Sequence[str], limit: int = 50, offset: int = 0, most: int = 200) -> DataFrame:
    """A slice by ``limit`` (up to ``most``) and ``offset`` of the total order."""
    return rows.orderBy(*order).offset(offset).limit(min(limit, most))


def type_counts(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy(*by, F.coalesce("text_type", F.lit("mula")).alias("text_type")).agg(F.count("*").alias("n"))


def provenance(rows: DataFrame, by: Sequence[str] = ("doc",)) -> DataFrame:
    """Translated rows with the engines and prompt versions that made them, and their mean score."""
    named = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return (
        rows.filter(~T.is_blank(F.col("translation")))
        .groupBy(*by)
        .agg(
            F.count("*").alias("n"),
            named("engine").alias("engines"),
            named("mt_prompt_version").alias("versions"),
            F.round(F.avg("translation_qa"), 3).alias("mean_qa"),
        )
    )


def progress(rows: DataFrame, by: Sequence[str] = ("doc",)) -> DataFrame:
    done = F.count_if(~T.is_blank(F.col("translation")))
    return rows.groupBy(*by).agg(
        F.count("*").alias("total"),
        done.alias("translated"),
        (F.count("*") - done).alias("missing"),
        F.round(F.avg("quality_score"), 3).alias("avg_quality"),
        F.round(100.0 * done / F.greatest(F.count("*"), F.lit(1)), 1).alias("pct"),
    )


def references_of(rows: DataFrame, refs: DataFrame, key: str, norm: str, ref: str) -> DataFrame:
    """``key``, the least ``ref`` of the same normalised text, and how many there are.

    Texts meet by their hashes, 64 bytes instead of whole texts in the shuffle; references of
    one text are counted before, so a frequent one does not multiply rows.
    """
    digest = F.sha2(norm, 256).alias("__digest")
    known = refs.groupBy(digest).agg(F.min(ref).alias(ref), F.count("*").alias("n"))
    return rows.select(key, digest).join(known, "__digest", "left").select(key, ref, F.coalesce("n", F.lit(0)).alias("n"))


def doc_quality(rows: DataFrame, by: Sequence[str] = ("doc",)) -> DataFrame:
    """Passages and mean quality by document; a passage without a score counts as 0."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.round(F.avg(F.coalesce("quality_score", F.lit(0.0))), 2).alias("avg_quality"))


def wipe_counts(rows: DataFrame, doc: str, column: str = "doc") -> DataFrame:
    """What wiping a document would take: passages, and translated ones among them."""
    return rows.filter(F.col(column) == doc).agg(F.count("*").alias("total"), F.count_if(~T.is_blank(F.col("translation"))).alias("translated"))


#: The orders of the review queue.
QUEUE_ORDERS = {"page": ("page_no", "idx"), "quality": ("quality_score", "page_no", "idx"), "quality_desc": ("-quality_score", "page_no", "idx")}


def queue_page(rows: DataFrame, mode: str = "page", page: int = 0, size: int = 40) -> DataFrame:
    """One page of the queue, by place or by quality, weakest or best first; rows without a score come last."""
    order = [F.desc_nulls_last(c[1:]) if c[0] == "-" else F.asc_nulls_last(c) for c in QUEUE_ORDERS[mode]]
    return rows.orderBy(*order, "doc").offset(page * size).limit(size)


def progress_snapshot(rows: DataFrame, limit: int = 20) -> DataFrame:
    """One row for each document: rows done and in all, percent, mean score, and its latest ``limit`` rows, by ``seq``."""
    done = ~T.is_blank(F.col("translation"))
    latest = rows.filter(done).select("doc", F.struct("seq", "page_no", "idx", F.substring("translation", 1, 300).alias("translation")).alias("r"))
    w = Window.partitionBy("doc").orderBy(F.desc("r.seq"))
    ring = latest.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= limit).groupBy("doc").agg(F.array_sort(F.collect_list("r")).alias("recent"))
    totals = rows.groupBy("doc").agg(F.count_if(done).alias("done"), F.count("*").alias("total"), F.round(F.avg(F.when(done, F.col("translation_qa"))), 3).alias("mean_qa"))
    return totals.withColumn("pct", F.round(100.0 * F.col("done") / F.col("total"), 1)).join(ring, "doc", "left")


def by_priority(docs: DataFrame, order: Sequence[str], key: str = "doc") -> DataFrame:
    """``place`` of each document in a list of priorities; others follow, by name."""
    listed = F.array_position(F.array(*map(F.lit, order)), F.col(key)) if order else F.lit(0)
    return docs.withColumn("place", F.nullif(listed.cast("int"), F.lit(0))).orderBy(F.asc_nulls_last("place"), key)


def doc_status(docs: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Every document with its rows and pages, also those without any."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n_rows"), F.countDistinct("page_no").alias("n_pages"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return docs.join(counts, key, "left").select(*docs.columns, zero("n_rows"), zero("n_pages"))


def page_spans(rows: DataFrame, by: Sequence[str], page: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.min(page).alias("page_from"), F.max(page).alias("page_to"), F.count("*").alias("n"))


def low_pages(rows: DataFrame, by: Sequence[str], text: str = "text", least: int = 300) -> DataFrame:
    """Pages with fewer characters than ``least``."""
    size = F.sum(F.length(F.coalesce(text, F.lit("")))).alias("chars")
    return rows.groupBy(*by).agg(size).filter(F.col("chars") < least)


def column_roles(rows: DataFrame, columns: Sequence[str], source_hints: Sequence[str], target_hints: Sequence[str], profile: ScriptProfile = DEVA) -> DataFrame:
    """For each column, how much it looks like source and like translated text. One pass over the rows given."""
    stacked = rows.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns))).alias("s")).select("s.*")
    given = stacked.filter(F.col("value").isNotNull() & (F.col("value") != ""))
    jsonish = F.regexp_like("value", F.lit(r"^\s*[{\[]")) | F.contains("value", F.lit('"engine"')) | F.contains("value", F.lit('"entities"'))
    shares = given.groupBy("column").agg(
        F.avg(T.script_share(F.col("value"), profile)).alias("own"),
        F.avg(T.share(F.col("value"), "\\x00-\\x7f")).alias("plain"),
        F.avg(jsonish.cast("double")).alias("jsonish"),
    )
    hint = lambda words: F.when(T.contains_any(F.col("column"), words), 0.5).otherwise(0.0)
    return shares.select(
        "column",
        F.round(1.2 * F.col("own") + hint(source_hints) - 0.3 * F.col("plain"), 6).alias("source_score"),
        F.round(1.2 * F.col("plain") + hint(target_hints) - 0.3 * F.col("own") - 2.0 * F.col("jsonish"), 6).alias("target_score"),
    )


# --- audits -------------------------------------------------------------------------------------


def missing(want: DataFrame, have: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Wanted keys that are not there."""
    return want.select(*keys).distinct().join(have.select(*keys), list(keys), "left_anti")


def expected_pages(spans: DataFrame, by: Sequence[str], page: str) -> DataFrame:
    """Every page of each span ``page_from`` to ``page_to``."""
    return spans.select(*by, F.explode(F.sequence("page_from", "page_to")).alias(page))


def in_ranges(rows: DataFrame, ranges: DataFrame, page: str, width: int = 64) -> DataFrame:
    """Range join ``page between page_from and page_to`` as an equi-join on blocks of ``width`` pages.

    A range is listed under each block that it touches, a row under its own, so only
    rows and ranges of one block meet; bounds the wrong way round are turned.
    """
    low, high = F.least("page_from", "page_to"), F.greatest("page_from", "page_to")
    listed = ranges.withColumns({"page_from": low, "page_to": high})
    listed = listed.withColumn("__block", F.explode(F.sequence(F.floor(F.col("page_from") / width), F.floor(F.col("page_to") / width))))
    keyed = rows.withColumn("__block", F.floor(F.col(page) / width))
    return keyed.join(listed, "__block").filter(F.col(page).between(F.col("page_from"), F.col("page_to"))).drop("__block")


# --- samples and order --------------------------------------------------------------------------


def systematic_sample(rows: DataFrame, by: Sequence[str], order: str, n: int, width: float = 1_000_000) -> DataFrame:
    """Rows ``floor(i * N / n)`` for i below n of each group in order; all rows where there are no more than n.

    Row r is one of them if some i has it, which is so for i = ceil(r * n / N). The
    order is a number, unique in a group; groups are numbered in blocks of ``width``
    of it and counted with pre-aggregation, so none has to fit a task.
    """
    ranked = row_numbers(rows, by, order, width, "__r").withColumn("__r", F.col("__r") - 1)
    counts = rows.groupBy(*by).agg(F.count("*").alias("__n")).select(*(F.col(c).alias(f"__{c}") for c in by), "__n")
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
    i = f"((__r * {n} + __n - 1) div __n)"
    hit = F.expr(f"__n <= {n} or (({i} * __n) div {n} = __r and {i} < {n})")
    return ranked.join(counts, on).filter(hit).select(*rows.columns)


def first_seen(rows: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = False) -> DataFrame:
    """One row for each key: its first by ``order``, or its last; of several at one place any.

    An aggregate, so a frequent key shrinks before the shuffle and is never sorted.
    """
    place = F.struct(*order)
    best = (F.max_by if last else F.min_by)(F.struct(*rows.columns), place)
    return rows.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(best.alias("__r")).select("__r.*")


def change_marks(rows: DataFrame, by: Sequence[str], order: Sequence[str], column: str) -> Column:
    """True where ``column`` is not what it was in the row before."""
    return ~F.col(column).eqNullSafe(F.lag(column).over(Window.partitionBy(*by).orderBy(*order)))


def tail(rows: DataFrame, order: str, limit: int, where: Column | None = None, factor: int = 4) -> DataFrame:
    """The latest ``limit`` rows that fit, out of the latest ``factor * limit``: the filter comes after the cut."""
    last = rows.orderBy(F.desc(order)).limit(factor * limit)
    return (last if where is None else last.filter(where)).orderBy(F.desc(order)).limit(limit)


# --- search -------------------------------------------------------------------------------------


def contains(columns: Sequence[str], query: str) -> Column:
    """Case-insensitive substring search, three characters at least; null columns hold nothing."""
    if len(query) < 3:
        return F.lit(False)
    found = F.lit(False)
    for c in columns:
        found = found | F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(query.lower()))
    return found


def matches(columns: Sequence[str], query: str) -> Column:
    """``word``, ``"a phrase"``, ``AND`` (also implied), ``OR``, ``NOT`` and parentheses over ``contains``.

    ``column:word`` and ``column:"a phrase"`` look into one of the columns.
    """
    tokens = re.findall(r'[A-Za-z_]+:"[^"]*"|"[^"]*"|[()]|[^\s()"]+', query)
    at = 0

    def peek() -> str | None:
        return tokens[at] if at < len(tokens) else None

    def either() -> Column:
        nonlocal at
        left = both()
        while peek() == "OR":
            at += 1
            left = left | both()
        return left

    def both() -> Column:
        nonlocal at
        left = one()
        while peek() not in (None, "OR", ")"):
            negated = False
            if peek() in ("AND", "NOT"):
                negated = peek() == "NOT"
                at += 1
            right = one()
            left = left & (~right if negated else right)
        return left

    def one() -> Column:
        nonlocal at
        token = peek()
        if token is None:
            raise ValueError(f"a term is missing at the end of {query!r}")
        at += 1
        if token == "(":
            inner = either()
            if peek() != ")":
                raise ValueError(f"a parenthesis is open in {query!r}")
            at += 1
            return inner
        if token == "NOT":
            return ~one()
        column, _, rest = token.partition(":")
        if rest and column in columns:
            return contains([column], rest.strip('"'))
        return contains(columns, token.strip('"'))

    out = either()
    if at < len(tokens):
        raise ValueError(f"{tokens[at]!r} is not expected in {query!r}")
    return out


def has_token(column: str, token: str) -> Column:
    """Whether ``token`` is one of the words of a column, case-insensitive."""
    return F.array_contains(F.split(F.lower(F.coalesce(column, F.lit(""))), r"[^\p{L}\p{N}]+", -1), token.lower())
