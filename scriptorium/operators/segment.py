"""Pages to passages: splitting, references, chapters carried forward, kinds, metre, quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.functions import verses as V
from scriptorium.functions.profiles import DEVA, WHITE, ScriptProfile


def _quoted(mark: str) -> str:
    return {"\n": "\n"}.get(mark, f"\\Q{mark}\\E")


def split_keeping(text: Column, mark: str) -> Column:
    """The parts of a text that end with ``mark``, and what is left; stripped, without blank ones."""
    parts = F.transform(F.split(text, _quoted(mark), -1), lambda p, k: F.struct(p.alias("p"), k.alias("k")))
    return T.let(
        parts,
        lambda parts: F.filter(
            F.transform(parts, lambda x: T.strip(F.when(x.k + 1 < F.size(parts), F.concat(x.p, F.lit(mark))).otherwise(x.p))),
            lambda p: p != "",
        ),
    )


def pair_halves(parts: Column, joint: str = "\n") -> Column:
    """First and second part, third and fourth, and so on, joined; an odd last part stays alone."""

    def of(parts: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(parts) - 1, F.lit(2))
        pairs = F.transform(starts, lambda i: F.array_join(F.slice(parts, i + 1, 2), joint))
        return F.when(F.size(parts) > 0, pairs).otherwise(F.array().cast("array<string>"))

    return T.let(parts, of)


def verse_parts(text: Column, profile: ScriptProfile = DEVA) -> Column:
    """A page's parts: by the major delimiter, else pairs by the minor one, else the page."""
    whole = F.filter(F.array(T.strip(text)), lambda p: p != "")
    return (
        F.when(F.contains(text, F.lit(profile.major)), split_keeping(text, profile.major))
        .when(F.contains(text, F.lit(profile.minor)), pair_halves(split_keeping(text, profile.minor)))
        .otherwise(whole)
    )


def split_by_numbers(text: Column, profile: ScriptProfile = DEVA) -> Column:
    """``array<struct<text, verse_ref>>``: verses that end with a number of the script at a line's end.

    The last part, without a number, has a null reference.
    """
    edge, digits = V._edge(profile), profile.digits.replace("0-9", "") or profile.digits
    number = f"{edge}([{digits}]{{1,3}}){edge}(?:\n|$)"
    texts, refs = F.split(text, number, -1), F.regexp_extract_all(text, F.lit(number), 1)
    both = F.transform(
        texts,
        lambda t, i: F.struct(T.strip(t).alias("text"), T.ascii_digits(F.get(refs, i), profile).alias("verse_ref")),
    )
    return F.filter(both, lambda v: v.text != "")


def segments(pages: DataFrame, keys: list[str], text: str = "norm", profile: ScriptProfile = DEVA) -> DataFrame:
    """Each page's parts: ``keys, pos, seg, seg_chapter, chapter`` in page order, before empty ones are dropped.

    ``page_text`` is the page's whole text, at its first part alone.

    A chapter holds until the next one; before the first it is the first on the page.
    One partition by the page's keys serves all that follows.
    """
    parts = (
        pages.select(*keys, F.col(text).alias("page_text"), V.chapter(F.col(text), profile).alias("page_chapter"), verse_parts(F.col(text), profile).alias("parts"))
        # outer: for an inner one a filter on the array's size is pushed down, and works the array out again
        .select(*keys, "page_text", "page_chapter", F.posexplode_outer("parts").alias("pos", "seg"))
        .filter(F.col("pos").isNotNull())
        .withColumn("page_text", F.when(F.col("pos") == 0, F.col("page_text")))
        .withColumn("seg_chapter", V.chapter(F.col("seg"), profile))
    )
    so_far = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    running = F.coalesce(F.last("seg_chapter", ignorenulls=True).over(so_far), F.col("page_chapter"))
    return parts.withColumn("chapter", running).drop("page_chapter")


def segment_pages(pages: DataFrame, keys: list[str], text: str = "norm", profile: ScriptProfile = DEVA) -> DataFrame:
    """Pages to passages: ``keys, idx, text, verse_ref, chapter, text_type, chandas, padas, quality_score``.

    Noise is dropped; a page that keeps nothing gives one prose passage, its whole
    text. ``idx`` counts from 0 within the keys.
    """
    page = Window.partitionBy(*keys)
    kept = (
        segments(pages, keys, text, profile)
        .select(*keys, "pos", "page_text", "chapter", V.ref_and_text(F.col("seg"), profile).alias("r"))
        .select(*keys, "pos", "page_text", "chapter", F.col("r.ref").alias("verse_ref"), T.strip(F.col("r.clean")).alias("text"))
        .withColumn("text_type", V.text_kind(F.col("text"), profile))
        .withColumn("kept", (F.col("text") != "") & (F.col("text_type") != "noise"))
        .withColumn("n_kept", F.count_if("kept").over(page))
        .filter(F.col("kept") | ((F.col("n_kept") == 0) & (F.col("pos") == 0)))
    )
    # a page without a passage left is one, as a whole
    whole, null = F.col("n_kept") == 0, F.lit(None).cast("string")
    mula = ~whole & (F.col("text_type") == "mula")
    quality = F.when(whole, T.passage_quality(F.col("page_text"), profile)).otherwise(T.density_score(F.col("text"), profile))
    return kept.select(
        *keys,
        (F.row_number().over(page.orderBy("pos")) - 1).alias("idx"),
        F.when(whole, F.col("page_text")).otherwise(F.col("text")).alias("text"),
        F.when(whole, null).otherwise(F.col("verse_ref")).alias("verse_ref"),
        F.when(whole, null).otherwise(F.col("chapter")).alias("chapter"),
        F.when(whole, "prose").otherwise(F.col("text_type")).alias("text_type"),
        F.when(mula, V.metre_of(F.col("text"), profile)).alias("chandas"),
        F.when(mula, V.padas(F.col("text"), F.col("text_type"), profile)).otherwise(0).alias("padas"),
        quality.alias("quality_score"),
    )


def resegment(pages: DataFrame, doc: str, page: str, text: str, least: float = 0.4, profile: ScriptProfile = DEVA) -> DataFrame:
    """Verses by trailing numbers; publisher headers go from a document's first verse; thin ones are dropped."""
    header = f"(?m)^{WHITE}*\\[[^\\]]*\\]|COLLECTION|नीलमतपुराणम्|^{WHITE}*$"
    first = Window.partitionBy(doc).orderBy(page, "pos")
    return (
        pages.select(doc, page, F.posexplode_outer(split_by_numbers(F.col(text), profile)).alias("pos", "v"))
        .filter(F.col("pos").isNotNull())
        .withColumn("nth", F.row_number().over(first))
        .select(
            doc,
            page,
            "pos",
            F.when(F.col("nth") == 1, T.strip(F.regexp_replace("v.text", header, ""))).otherwise(F.col("v.text")).alias("text"),
            F.col("v.verse_ref").alias("verse_ref"),
        )
        .filter((T.script_share(F.col("text"), profile) >= least) & (F.length(T.strip(F.col("text"))) >= 4))
    )


def line_blocks(lines: DataFrame, keys: list[str], order: str, text: str, hit: Column, least_chars: int = 20) -> DataFrame:
    """Runs of lines that are hits, one miss between two of them allowed; ``keys, block, n_lines, text``.

    Two misses in a row end a block. Islands over the hits alone: a gap of three in
    the line numbers starts a new one.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    island = (
        lines.filter(hit)
        .withColumn("opens", (F.col(order) - F.lag(order).over(w) >= 3).cast("int"))
        .withColumn("block", F.sum(F.coalesce("opens", F.lit(0))).over(w))
    )
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("k"), T.strip(F.col(text)).alias("t")))), lambda s: s.t), "\n")
    return (
        island.groupBy(*keys, "block")
        .agg(F.count("*").alias("n_lines"), F.min(order).alias("first_line"), joined.alias("text"))
        .filter(F.length("text") >= least_chars)
    )


def greedy_chunks(lines: Column, most: int = 1200, keep: float | None = None, profile: ScriptProfile = DEVA) -> Column:
    """An array of lines as chunks of up to ``most`` characters; headings (``# ``) stand alone, blank lines end a chunk.

    A line longer than ``most`` is a chunk of its own. With ``keep``, chunks that have
    less than this share of the script are dropped, headings are not.
    """
    start = F.struct(
        F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"), F.lit(0).alias("n")
    )

    def flushed(state: Column) -> Column:
        return F.when(state.n > 0, F.array_append(state.done, state.cur)).otherwise(state.done)

    def step(state: Column, x: Column) -> Column:
        make = lambda done, cur, n: F.struct(done.alias("done"), cur.alias("cur"), n.cast("int").alias("n"))
        size = F.length(x.line) + 1
        return (
            F.when((state.n > 0) & (x.line != "") & ~x.heading & (state.n + size <= most), make(state.done, F.concat(state.cur, F.lit("\n"), x.line), state.n + size))
            .when(x.line == "", make(flushed(state), F.lit(""), F.lit(0)))
            .when(x.heading, make(F.array_append(flushed(state), x.line), F.lit(""), F.lit(0)))
            .otherwise(make(flushed(state), x.line, size))
        )

    # lines are tidied once, before the fold
    tidy = F.transform(F.transform(lines, T.collapse), lambda x: F.struct(x.alias("line"), F.startswith(x, F.lit("# ")).alias("heading")))
    chunks = F.aggregate(tidy, start, step, flushed)
    if keep is None:
        return chunks
    return F.filter(chunks, lambda c: F.startswith(c, F.lit("# ")) | (T.script_share(c, profile) >= keep))
