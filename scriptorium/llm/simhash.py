"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints are those of the word shingles' XXH64. Two fingerprints link at
``RADIUS`` or fewer differing bits; documents of linked fingerprints, directly or
through others, are one component.

Candidates come from bit masks with a guarantee. Each free bit gets a nonzero
vector of ``RADIUS + 1`` bits; for each of the ``2 ** (RADIUS + 1) - 1`` nonzero
vectors v there is a table, whose mask has the bits with an odd inner product with
v. The vectors of ``RADIUS`` differing bits span fewer dimensions than there are,
so some v is orthogonal to all: in its table the two agree. About half of the
bits are masked, so chance collisions are rare.

Only distinct fingerprints are hashed, so copies of one text count once. A bucket
of up to ``LARGEST`` fingerprints is linked in place, and gives at most one edge
for each member (a forest, not pairs). Members of a larger bucket agree on the
masked bits already; they go through the same scheme on the bits that are left,
which splits the bucket over many keys and keeps the guarantee. After three
levels at most 8 free bits are left, and no bucket can be large. Nothing is
dropped or capped.

Components come from label propagation with pointer jumping over the edges, in
DataFrame joins; every round is written to the shared folder.

Defined results: null texts and texts without a word have fingerprint zero and
link like any other; a bit set in exactly half of the hashes is 0; very long texts are read whole, in
blocks; rows without a ``doc_id`` take no part in a component's
smallest id (null where no row of the component has one); repeated rows are
returned as often as they come; an empty table gives an empty table; other
columns stay out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.words import word_blocks
from scriptorium.session import Durable, prepare_batches

SHINGLE, SEED, RADIUS, LARGEST = 3, 42, 3, 256


def fingerprint(text: str | None) -> int:
    """The unsigned 64-bit fingerprint of a whole text."""
    if not text:
        return 0
    ones, total = np.zeros(64, np.int64), 0
    last: list[bytes] = []
    for words in word_blocks(text.encode("utf-8", "surrogatepass").lower(), SHINGLE - 1):
        last = words
        joined = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)), strict=False))
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in joined), np.uint64)
        for k in range(0, len(hashes), 1 << 16):
            part = hashes[k : k + (1 << 16)]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(last), SEED) if last else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, *keys: Column) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) of every row, and whole numbers ``k0, k1, ...`` that come with it."""
    prepare_batches(docs.sparkSession)
    names = ["doc_id", "fp", *(f"k{k}" for k in range(len(keys)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]], names)

    rows = docs.select(docs["doc_id"].cast("long"), docs["text"], *(key.cast("long").alias(f"k{k}") for k, key in enumerate(keys)))
    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def masks(free: list[int], radius: int = RADIUS) -> list[int]:
    """A mask for each nonzero vector, of bits among ``free``."""
    n = 1 << (radius + 1)
    vector = {bit: k % (n - 1) + 1 for k, bit in enumerate(free)}
    return [sum(1 << bit for bit in free if (vector[bit] & v).bit_count() & 1) for v in range(1, n)]


def mask_levels() -> list[list[int]]:
    """The masks of each level; those below mask k of a level are k * 15 to k * 15 + 14 of the next one."""
    levels = [masks(list(range(64)))]
    for _ in range(2):
        levels.append([m | sub for m in levels[-1] for sub in masks([b for b in range(64) if not m >> b & 1])])
    return levels


def _longs(values: list[int]) -> Column:
    signed = np.array(values, np.uint64).view(np.int64)
    return F.split(F.lit(",".join(map(str, signed))), ",").cast("array<long>")


def link(fps: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """A forest over distinct fingerprints of a bucket: an edge from each to the least of its component, if another."""
    if len(fps) == 2:
        a, b = min(fps), max(fps)
        return [(b, a)] if ((a ^ b) & (1 << 64) - 1).bit_count() <= radius else []
    at = np.sort(np.array(fps, np.int64))
    near = np.bitwise_count(at[:, None].view(np.uint64) ^ at[None, :].view(np.uint64)) <= radius
    label = np.arange(len(at))
    while True:
        least = np.where(near, label[None, :], len(at)).min(axis=1)
        least = least[least]
        if (least == label).all():
            break
        label = least
    return [(int(at[k]), int(at[r])) for k, r in enumerate(label) if r != k]


def _link_buckets(buckets: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = [e for fps in batch.column(0).to_pylist() for e in link(fps)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], ["a", "b"]
            )

    return buckets.select("fps").mapInArrow(run, "a long, b long")


def edges(distinct: DataFrame, store: Durable, largest: int = LARGEST) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``fp`` that connect all that any links connect."""
    levels = mask_levels()
    rows = distinct.select(F.lit(0).alias("above"), "fp")
    parts = []
    for level, all_masks in enumerate(levels):
        masked = _longs(all_masks)
        keyed = rows.select(
            "fp", F.explode(F.sequence(F.col("above") * 15, F.col("above") * 15 + 14)).alias("mask")
        ).select("mask", F.col("fp").bitwiseAND(F.get(masked, F.col("mask"))).alias("part"), "fp")
        sizes = keyed.groupBy("mask", "part").agg(F.count("*").alias("n")).filter("n > 1")
        last = level == len(levels) - 1
        sizes = store.save(sizes)
        small = sizes if last else sizes.filter(F.col("n") <= largest)
        buckets = keyed.join(small, ["mask", "part"]).groupBy("mask", "part").agg(F.collect_list("fp").alias("fps"))
        parts.append(store.save(_link_buckets(buckets).distinct()))
        if last or sizes.filter(F.col("n") > largest).isEmpty():
            break
        large = sizes.filter(F.col("n") > largest).drop("n")
        rows = store.save(keyed.join(large, ["mask", "part"]).select(F.col("mask").alias("above"), "fp"))
    out = parts[0]
    for more in parts[1:]:
        out = out.union(more)
    return out.distinct()


def components(links: DataFrame, store: Durable, rounds: int = 100) -> DataFrame:
    """``node, root``: the least node that each node with a link reaches."""
    both = store.save(links.union(links.select("b", "a")).distinct())
    labels = store.save(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")))
    for _ in range(rounds):
        near = (
            both.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy("a")
            .agg(F.min("root").alias("near"))
            .withColumnRenamed("a", "node")
        )
        step = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        new = store.save(step.join(jump, "root").select("node", F.least("root", "far").alias("root"), "old"))
        done = new.filter("root <> old").isEmpty()
        store.drop(labels)
        labels = new.drop("old")
        labels._scriptorium_path = new._scriptorium_path
        if done:
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def named_fingerprints(fps: DataFrame, store: Durable, largest: int) -> DataFrame:
    """``fp, root, component_id``: of each fingerprint the least one that it reaches, and the smallest id of those."""
    reps, passing = store.save(fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))), Durable(store.spark, "simhash-links")
    links = store.save(edges(reps.select("fp"), passing, largest))
    if links.isEmpty():
        named = reps.select("fp", F.col("fp").alias("root"), F.col("rep").alias("component_id"))
    else:
        roots = components(links, passing).withColumnRenamed("node", "fp")
        linked = reps.join(roots, "fp")
        ids = linked.groupBy("root").agg(F.min("rep").alias("component_id"))
        linked = linked.select("fp", "root").join(ids, "root").select("fp", "root", "component_id")
        named = reps.join(linked, "fp", "left").select(
            "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "rep").alias("component_id")
        )
    # written, so that both sides of the join are plain exchanges and a fingerprint of many copies can be split
    named = store.save(named)
    store.drop(reps, links)
    passing.clear()
    return named


def near_duplicates(docs: DataFrame, largest: int = LARGEST) -> DataFrame:
    """``doc_id, fp, component_id`` of every row of ``docs``."""
    store = Durable(docs.sparkSession, "simhash")
    fps = store.save(fingerprints(docs))
    named = named_fingerprints(fps, store, largest)
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, largest: int = LARGEST, broadcast_rows: int = 500_000) -> DataFrame:
    """The rows of ``docs``, all columns, of one row of each component: that with the smallest id.

    Each row is judged by its own text, also where several rows have one id. Of rows of the same id in
    a component that with the smallest hash of all columns stays; of rows that agree in all columns
    one. Rows without a ``doc_id`` stay.

    Rows are known by a hash of all their columns (128 bits), so no text is shuffled: the keys of the
    rows that go are broadcast if they have been counted to be at most ``broadcast_rows``. If there are
    more, they meet the rows in an ordinary join.
    """
    store = Durable(docs.sparkSession, "simhash")
    columns = [docs[c] for c in docs.columns]
    shape = [c.isNull() for c in columns]  # a null adds nothing to a hash
    keys = [F.xxhash64(F.lit(k), *shape, *columns) for k in (0, 1)]
    fps = store.save(fingerprints(docs, *keys))
    named = named_fingerprints(fps, store, largest)
    rows = fps.filter("doc_id is not null").groupBy("doc_id", "k0", "k1", "fp").agg(F.count("*").alias("n")).join(named.select("fp", "root"), "fp")
    rows = store.save(rows.select("root", F.struct("doc_id", "k0", "k1").alias("row"), "n"))
    # a component of one row needs no verdict
    several = store.save(rows.groupBy("root").agg(F.min("row").alias("first"), F.sum("n").alias("all")).filter("all > 1").drop("all"))
    if several.count() <= broadcast_rows:
        several = F.broadcast(several)
    judged = store.save(rows.join(several, "root").select("row.k0", "row.k1", "n", (F.col("row") == F.col("first")).alias("stays")))
    store.drop(rows, fps, named)
    # rows that go, and those of which there are several that agree in all
    going = judged.filter("not stays or n > 1").select(F.col("k0").alias("__k0"), F.col("k1").alias("__k1"))
    once = judged.filter("stays and n > 1").select(F.col("k0").alias("__k0"), F.col("k1").alias("__k1"))
    if going.count() <= broadcast_rows:
        going, once = F.broadcast(going), F.broadcast(once)
    keyed = docs.withColumns({"__k0": keys[0], "__k1": keys[1]})
    left = keyed.join(going, ["__k0", "__k1"], "left_anti")
    if not judged.filter("stays and n > 1").isEmpty():
        left = left.unionByName(keyed.join(once, ["__k0", "__k1"], "left_semi").dropDuplicates(["__k0", "__k1"]))
    return left.select(docs.columns)
