"""Intake: reading images of pages, trees of files, numbering pages and passages, analysing a text."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.functions import verses as V
from scriptorium.functions.profiles import DEVA, ScriptProfile
from scriptorium.session import ship

#: Reads an image: ``(content, dpi, language, preprocessing, layout) -> text``.
Reader = Callable[[bytes, int, str, str, int], str]


def no_reader(content: bytes, dpi: int, lang: str, preproc: str, psm: int) -> str:
    """Stands in where no recognition software is installed; every page is then empty."""
    return ""


def read_scans(
    pages: DataFrame,
    reader: Reader = no_reader,
    dpi: int = 300,
    max_dpi: int = 600,
    langs: Sequence[str] = ("san", "san+eng"),
    preprocs: Sequence[str] = ("raw", "gray", "binary"),
    layouts: Sequence[int] = (6, 4),
    min_chars: int = 20,
) -> DataFrame:
    """Rows ``path, content`` with ``text`` and how it was read. A page is always returned, even if empty.

    Settings are tried in order: resolutions, then languages, preprocessing, layouts;
    the first text of ``max(20, min_chars)`` characters is taken, else the longest.
    """
    ship(pages.sparkSession)
    steps = list(dict.fromkeys((dpi, min(450, max_dpi), max_dpi)))
    least = max(20, min_chars)
    ladder = [(d, g, p, y) for d in steps for g in langs for p in preprocs for y in layouts]

    def read(content: bytes) -> tuple:
        best = ("", *ladder[0])
        for setting in ladder:
            d, lang, preproc, psm = setting
            text = "\n".join(x.strip() for x in reader(content, d, lang, preproc, psm).split("\n")).strip()
            if len(text) > len(best[0]):
                best = (text, *setting)
            if len(text) >= least:
                return best
        return best

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [read(c) for c in batch["content"]]
            yield pd.DataFrame(found, columns=["text", "dpi", "lang", "preproc", "psm"]).assign(path=batch["path"].to_numpy())

    return pages.select("path", "content").mapInPandas(run, "text string, dpi int, lang string, preproc string, psm int, path string")


def corpus_tree(spark: SparkSession, path: str) -> DataFrame:
    """``category, n_files, bytes`` of a folder with a sub-folder for each category; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pdf").load(path)
    return found.groupBy(F.regexp_extract("path", "([^/]+)/[^/]+$", 1).alias("category")).agg(F.count("*").alias("n_files"), F.sum("length").alias("bytes"))


def pages_of(pages: DataFrame, slugs: Sequence[str], key: str = "slug") -> DataFrame:
    """The pages of the slugs asked for; a slug without a page is an error."""
    found = pages.filter(F.col(key).isin(*slugs))
    lost = sorted(set(slugs) - {r[0] for r in found.select(key).distinct().collect()})
    if lost:
        raise LookupError(f"no page for {', '.join(lost)}")
    return found


def append_index(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``new`` with an ``idx`` that goes on from the largest of each key in ``old``; from 0 where there is none."""
    last = old.groupBy(*keys).agg((F.max("idx") + 1).alias("__from"))
    w = Window.partitionBy(*keys).orderBy(*order)
    numbered = new.withColumn("__n", F.row_number().over(w) - 1).join(last, list(keys), "left")
    return numbered.withColumn("idx", (F.col("__n") + F.coalesce("__from", F.lit(0))).cast("int")).drop("__n", "__from")


def number_pages(pages: DataFrame, book: str, number: str, has_text: Column) -> DataFrame:
    """``page_no``: 1, 2, ... over a book's pages with text, the index page (null ``number``) first."""
    w = Window.partitionBy(book).orderBy(F.asc_nulls_first(number))
    return pages.filter(has_text).withColumn("page_no", F.row_number().over(w))


def page_range(rows: DataFrame, page: str, low: int, high: int) -> DataFrame:
    """Pages between two bounds, given in any order."""
    return rows.filter(F.col(page).between(min(low, high), max(low, high)))


def fit_for_benchmark(text: Column, quality: Column) -> Column:
    return (F.length(F.trim(text)) > 40) & (F.coalesce(quality, F.lit(0.0)) >= 0.5)


def merge_skips(a: Column, b: Column) -> Column:
    """Two skip lists as one, sorted, each entry once; a null list is empty."""
    none = F.array().cast("array<bigint>")
    return F.array_sort(F.array_union(F.coalesce(a.cast("array<bigint>"), none), F.coalesce(b.cast("array<bigint>"), none)))


def analyse(text: Column, profile: ScriptProfile = DEVA) -> Column:
    """``struct<normalized, clauses, morph>`` of a text."""
    normal = T.normalize_verses(text, profile)
    return F.struct(normal.alias("normalized"), V.clauses(normal, profile).alias("clauses"), V.lemmas(normal).alias("morph"))
