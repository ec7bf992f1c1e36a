"""Keyed writes as joins: a table's new version out of the old one and a delta. Nothing is updated in place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.operators.reports import first_seen


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], replace: Sequence[str] = (), fill: Sequence[str] = ()) -> DataFrame:
    """Rows of both by key. On a match ``replace`` columns take the new value, ``fill`` columns the new
    one unless it is null, all others keep the old one. Rows of ``old`` alone stay. Of rows of ``new`` with
    one key the one that sorts first counts, so that a repeat does not multiply rows.
    """
    new = first_seen(new, keys, [c for c in new.columns if c not in keys] or list(keys))
    o, n = old.alias("o"), new.alias("n")
    on = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    both = o.withColumn("__old", F.lit(True)).alias("o").join(n.withColumn("__new", F.lit(True)).alias("n"), on, "full_outer")
    from_new, from_old = F.col("n.__new").isNotNull(), F.col("o.__old").isNotNull()

    def pick(name: str):
        kind = old.schema[name].dataType
        was = F.col(f"o.{name}")
        if name not in new.columns:
            return was.alias(name)
        now = F.col(f"n.{name}").cast(kind)
        if name in keys:
            return F.when(from_old, was).otherwise(now).alias(name)
        if name in replace:
            return F.when(from_new, now).otherwise(was).alias(name)
        if name in fill:
            return F.coalesce(now, was).alias(name)
        return F.when(from_old, was).otherwise(now).alias(name)

    return both.select(*(pick(c) for c in old.columns))


#: How passages are ingested: the text follows the source, structure is only filled, translations are left alone.
PASSAGE_REPLACE = ("text", "norm", "iast")
PASSAGE_FILL = ("verse_ref", "chapter", "text_type", "chandas", "padas", "quality_score")


def upsert_passages(old: DataFrame, new: DataFrame, keys: Sequence[str] = ("doc", "page_no", "idx")) -> DataFrame:
    return upsert(old, new, keys, PASSAGE_REPLACE, PASSAGE_FILL)


def ensure_docs(old: DataFrame, new: DataFrame) -> DataFrame:
    """Get or create by ``code``; other columns are filled where the new value is not null."""
    return upsert(old, new, ["code"], fill=[c for c in old.columns if c != "code"])


def _digest(keys: Sequence[str]):
    """The keys as one value of fixed size, so that long texts are no shuffle keys; null-safe."""
    return F.sha2(F.to_json(F.struct(*(F.col(k).isNull().alias(f"n{n}") for n, k in enumerate(keys)), *(F.col(k).alias(f"k{n}") for n, k in enumerate(keys)))), 256)


def first_wins(old: DataFrame, new: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Insert or ignore: of new rows with one key the first by ``order``, if the key is not there yet."""
    digest = _digest(keys).alias("__digest")
    fresh = new.select("*", digest).join(old.select(digest), "__digest", "left_anti")
    return old.unionByName(first_seen(fresh, ["__digest"], [order]).select(*old.columns))


def last_wins(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Insert or replace: of rows with one key the last by ``order``."""
    return first_seen(rows.withColumn("__digest", _digest(keys)), ["__digest"], [order], last=True).drop("__digest")


def replace_rows(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete and insert: rows of ``old`` whose key is in ``new`` go."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new)


def wipe(rows: DataFrame, doc: str, column: str = "doc") -> DataFrame:
    """Without one document's rows; rows without a document stay."""
    return rows.filter(~F.col(column).eqNullSafe(F.lit(doc)))


def adapt(rows: DataFrame, schema: dict[str, str], aliases: dict[str, Sequence[str]]) -> DataFrame:
    """Columns by their known aliases, cast to ``schema``; missing ones are typed nulls, others stay out."""
    out = []
    for name, kind in schema.items():
        found = next((c for c in (name, *aliases.get(name, ())) if c in rows.columns), None)
        out.append((F.col(found).try_cast(kind) if found else F.lit(None).cast(kind)).alias(name))
    return rows.select(*out)


#: What historical layouts call the columns.
ALIASES = {
    "page_no": ("pageno", "page", "pg", "pageNumber", "page_num"),
    "idx": ("line_no", "line", "lineno", "i"),
    "text": ("san",),
    "translation": ("en",),
}
