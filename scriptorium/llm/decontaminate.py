"""Benchmark decontamination: short test items found inside long documents.

Texts become lower-case words (``\\w+``) and shingles of five words; an item of
fewer words is one shingle of its own width. An item is found in a document that
contains ``threshold`` or more of the item's distinct shingles.

Candidates come from MinHash sketches of the items, partitioned by size: those of up
to u shingles, u a power of two, are one partition. There a sketch has the K smallest
shingle hashes, K being u / 8, at least ``EXTRA``, more than the shingles that a
document may lack of an item of u shingles. A document that contains enough of an item of n shingles lacks
at most m(n) of them, so at least K - m(n) of the sketch are among the document's:
that many are asked for. The documents' shingle hashes are held against the sketches
alone; no other shingle of an item makes it a candidate, and no found item is missed,
however long the document. (A sketch of the document would have to grow with it: at
these ratios of sizes the Jaccard similarity that banded MinHash works with is near
zero.) Each candidate is verified by exact containment of its shingles.

The documents are read once, whatever the size of the benchmark. If its texts have at
most ``block_bytes``, sketches and items are broadcast, a task verifies the candidates of a
text as soon as it has read it, by the shingles as strings, and nothing is shuffled. A
larger benchmark stays distributed: a task writes the hashes (128 bits) that are in a
bitmap of the items' hashes (``BITMAP`` bits, whatever the size), equi-joins with the
sketches give the candidates, and others verify them.

Defined results: a null text counts as empty and holds nothing; an item without a
word is found nowhere; items that are contained equally are all reported; repeated
items and documents are reported row by row, but an item with the same id and text
once; very long texts are read whole, in blocks; an empty table of either kind finds
nothing; other columns stay out (``clean`` keeps them); null ids stay null.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil, floor

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.session import Durable, prepare_batches

WIDTH, BLOCK, BITS, REMEMBERED, EXTRA, BITMAP = 5, 1 << 20, 20, 250_000, 2, 1 << 26
_WORD, _GAP = re.compile(r"\w+"), re.compile(r"\W")
_FACTORS, _SECOND = np.random.default_rng(5).integers(1 << 62, 1 << 63, (2, WIDTH), np.uint64) | np.uint64(1)
_seen: dict[str, int] = {}


def word_hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes of words, remembered for up to ``REMEMBERED`` of them."""
    if len(_seen) > REMEMBERED:
        _seen.clear()
    for w in set(words).difference(_seen):
        _seen[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(_seen.__getitem__, words), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, width: int, factors: np.ndarray = _FACTORS) -> np.ndarray:
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n] * factors[0]
    for k in range(1, width):
        total = total + hashes[k : k + n] * factors[k]
    total ^= total >> np.uint64(31)
    total *= factors[WIDTH - 1]
    return total ^ (total >> np.uint64(29))


def blocks(text: str | None, carry: int = WIDTH - 1) -> Iterator[list[str]]:
    """Words in blocks, each after the first beginning with the last ``carry`` words before it."""
    low, at, kept = (text or "").lower(), 0, []
    while at < len(low):
        end = len(low)
        if at + BLOCK < end and (gap := _GAP.search(low, at + BLOCK)):
            end = gap.start()
        words = kept + _WORD.findall(low[at:end])
        yield words
        kept, at = words[-carry:], end


def may_lack(shingles: int, threshold: float) -> int:
    """How many of an item's shingles a document that contains it may lack."""
    return shingles - max(1, ceil(threshold * shingles - 1e-9))


def sketch_size(shingles: int, threshold: float) -> tuple[int, int]:
    """How many hashes the sketch of an item has, and how many of them a document must have at least."""
    partition = 1 << (shingles - 1).bit_length()
    size = min(shingles, floor((1 - threshold) * partition + 1e-9) + max(EXTRA, partition // 8))
    return size, size - may_lack(shingles, threshold)


def item_words(text: str | None) -> tuple[list[str], int]:
    """An item's words, and the width of its shingles."""
    words = [w for b in blocks(text, 0) for w in b]
    return words, min(WIDTH, len(words))


@dataclass
class Index:
    """What a task needs to find items: their sketches by width, and their shingles to verify them."""

    items: list[tuple] = field(default_factory=list)  # (id, width, shingles, hashes, hashes asked of the sketch, words)
    widths: dict[int, tuple] = field(default_factory=dict)  # width: bitmap, sorted hashes of sketches
    sketch: dict[tuple, list[int]] = field(default_factory=dict)  # (width, hash): items

    @classmethod
    def build(cls, rows: list[tuple], threshold: float) -> Index:
        """From ``(id, text)``."""
        index = cls()
        for key, text in rows:
            words, width = item_words(text)
            if not words:
                continue
            hashes = np.unique(shingle_hashes(word_hashes(words), width))
            shingles = frozenset(" ".join(words[k : k + width]) for k in range(len(words) - width + 1))
            size, need = sketch_size(len(shingles), threshold)
            for h in hashes[:size].tolist():
                index.sketch.setdefault((width, h), []).append(len(index.items))
            index.items.append((key, width, shingles, hashes, need, len(words)))
        for width in {w for w, _ in index.sketch}:
            known = np.array(sorted(h for w, h in index.sketch if w == width), np.uint64)
            index.widths[width] = (bitmap_of(known), known)
        return index

    def candidates(self, text: str | None) -> list[int]:
        """The items that the sketches do not rule out."""
        found: set[tuple[int, int]] = set()
        for words in blocks(text):
            hashes = word_hashes(words)
            for width, (bitmap, known) in self.widths.items():
                found.update((width, h) for h in among(shingle_hashes(hashes, width), bitmap, known)[1].tolist())
        hits = Counter(k for h in found for k in self.sketch[h])
        return sorted(k for k, n in hits.items() if n >= self.items[k][4])

    def find(self, text: str | None, threshold: float, least: int = 0) -> list[tuple]:
        """``(id, shingles, found)`` of each item of ``least`` or more words that ``text`` contains."""
        picked = [k for k in self.candidates(text) if self.items[k][5] >= least]
        if not picked:
            return []
        probes = {}
        for width in {self.items[k][1] for k in picked}:
            known = np.unique(np.concatenate([self.items[k][3] for k in picked if self.items[k][1] == width]))
            probes[width] = bitmap_of(known), known
        found: set[str] = set()
        for words in blocks(text):
            hashes = word_hashes(words)
            for width, probe in probes.items():
                found.update(" ".join(words[k : k + width]) for k in among(shingle_hashes(hashes, width), *probe)[0].tolist())
        out = []
        for k in picked:
            key, _, shingles, *_ = self.items[k]
            n = len(shingles & found)
            if n >= threshold * len(shingles) - 1e-9:
                out.append((key, len(shingles), n))
        return out


def bitmap_of(known: np.ndarray) -> np.ndarray:
    bitmap = np.zeros(1 << BITS, bool)
    bitmap[known >> np.uint64(64 - BITS)] = True
    return bitmap


def among(own: np.ndarray, bitmap: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the hashes in ``own`` that are in the sorted ``known``."""
    maybe = np.flatnonzero(bitmap[own >> np.uint64(64 - BITS)])
    at = own[maybe]
    hit = known[np.minimum(np.searchsorted(known, at), len(known) - 1)] == at
    return maybe[hit], at[hit]


def distinct_items(benchmark: DataFrame) -> tuple[DataFrame, int]:
    """``item_id, text`` without repeated rows, and the bytes of their texts."""
    rows = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), "text").distinct()
    return rows, rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n


def broadcast_index(rows: DataFrame, threshold: float):
    """The index of a benchmark that has been measured to be small, as a broadcast variable."""
    return rows.sparkSession.sparkContext.broadcast(Index.build([tuple(r) for r in rows.collect()], threshold))


def item_shingles(items: DataFrame, threshold: float) -> DataFrame:
    """A row for each shingle of ``item, item_id, text``: its two hashes, and whether it is in the item's sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words, width = item_words(text)
                if not words:
                    continue
                hashes = word_hashes(words)
                one, at = np.unique(shingle_hashes(hashes, width), return_index=True)
                two, n = shingle_hashes(hashes, width, _SECOND)[at], len(one)
                size, need = sketch_size(n, threshold)
                columns = ([item] * n, [key] * n, [n] * n, [need] * n, [len(words)] * n, [width] * n, one.view(np.int64), two.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in columns), pa.array(np.arange(n) < size)], names
                )

    names = ["item", "item_id", "n_shingles", "need", "n_words", "width", "one", "two", "sketched"]
    return items.mapInArrow(run, ", ".join(f"{n} long" for n in names[:-1]) + ", sketched boolean")


def shared_bitmap(shingles: DataFrame):
    """A bitmap of ``BITMAP`` bits over the first hashes, made by the tasks and broadcast: its size does not grow."""
    words = (
        shingles.selectExpr(f"pmod(one, {BITMAP}) as at")
        .selectExpr("at div 32 as word", "shiftleft(1L, cast(at % 32 as int)) as bit")
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros(BITMAP // 32, np.uint32)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return shingles.sparkSession.sparkContext.broadcast(bitmap)


def joined_containments(rows: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """For a benchmark of any size; ``rows`` are ``a, b, text``, the result has ``a, b`` for a document."""
    spark = rows.sparkSession
    store = Durable(spark, "decontaminate")
    # numbered rows are written before anything rests on the numbers
    items = store.save(items.withColumn("item", F.monotonically_increasing_id()).select("item", "item_id", "text"))
    shingles = store.save(item_shingles(items, threshold))
    bitmap = shared_bitmap(shingles)
    widths = [r.width for r in shingles.select("width").distinct().collect()]  # WIDTH at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch in batches:
            for row, a, b, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for words in blocks(text):
                    hashes = word_hashes(words)
                    for width in widths:
                        own = shingle_hashes(hashes, width)
                        at = own & np.uint64(BITMAP - 1)
                        hit = np.flatnonzero(bits[at >> np.uint64(5)] >> (at & np.uint64(31)).astype(np.uint32) & np.uint32(1))
                        one, first = np.unique(own[hit], return_index=True)
                        if n := len(one):
                            two = shingle_hashes(hashes, width, _SECOND)[hit][first]
                            columns = ([row] * n, [a] * n, [b] * n, [width] * n, one.view(np.int64), two.view(np.int64))
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    names, same = ["row", "a", "b", "width", "one", "two"], ["width", "one", "two"]
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "a", "b", "text")
    hits = store.save(numbered.mapInArrow(run, ", ".join(f"{n} long" for n in names)).distinct())
    sketches = shingles.filter("sketched").select("item", "need", *same)
    candidates = hits.select("row", *same).join(sketches, same).groupBy("row", "item", "need").count().filter("count >= need")
    wanted = store.save(candidates.select("row", "item"))
    return (
        wanted.join(shingles.drop("need", "sketched"), "item")
        .join(hits, ["row", *same])
        .groupBy("row", "a", "b", "item", "item_id", "n_shingles", "n_words")
        .agg(F.count("*").alias("n_found"))
        .filter(F.col("n_found") >= threshold * F.col("n_shingles") - 1e-9)
    )


def containments(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, block_bytes: int = 8 << 20
) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_found, containment``: a row for each document and item found in it."""
    prepare_batches(docs.sparkSession)
    items, size = distinct_items(benchmark)
    rows = docs.select(docs["doc_id"].cast("long"), docs["text"])
    if size > block_bytes:
        found = joined_containments(rows.select(F.col("doc_id").alias("a"), F.lit(0).cast("long").alias("b"), "text"), items, threshold)
        return found.select(
            F.col("a").alias("doc_id"), "item_id", "n_shingles", "n_found", (F.col("n_found") / F.col("n_shingles")).alias("containment")
        )
    shared = broadcast_index(items, threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [
                (doc, item, size, n, n / size)
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for item, size, n in shared.value.find(text, threshold)
            ]
            columns = list(zip(*hits, strict=True)) or [()] * 5
            kinds = (pa.int64(),) * 4 + (pa.float64(),)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["doc_id", "item_id", "n_shingles", "n_found", "containment"],
            )

    return rows.mapInArrow(run, "doc_id long, item_id long, n_shingles long, n_found long, containment double")


def clean(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, least: int = 1, block_bytes: int = 8 << 20
) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no item of ``least`` or more words.

    Items of a few words (a yes or no) stand in most texts by chance: where a corpus is to be
    cleaned, ``least`` should be ``WIDTH``. ``containments`` reports them all the same.
    """
    prepare_batches(docs.sparkSession)
    items, size = distinct_items(benchmark)
    at = docs.columns.index("text")
    if size > block_bytes:
        # the verdict is the text's, so a text is known again by its hash
        one, two = F.xxhash64(docs["text"]), F.xxhash64(docs["text"], F.lit(1))
        found = joined_containments(docs.select(one.alias("a"), two.alias("b"), docs["text"]), items, threshold)
        leaked = found.filter(F.col("n_words") >= least).select(F.col("a").alias("__a"), F.col("b").alias("__b")).distinct()
        return docs.join(leaked, (one == F.col("__a")) & (two == F.col("__b")), "left_anti")
    shared = broadcast_index(items, threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            yield batch.filter(pa.array([not shared.value.find(t, threshold, least) for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
