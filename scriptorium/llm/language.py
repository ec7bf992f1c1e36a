"""Language identification with hyperdimensional profiles.

Each letter has a random vector of ``DIMS`` times +1 or -1, which a hash of its code
point gives, so that letters of all scripts have one of their own. An n-gram's vector
binds (multiplies) those of its three letters, permuted by their places; a text's
vector is the sum (bundle) of its n-grams' vectors; a language's prototype is the sum
of its training texts' vectors, each of length 1. A text is given to the prototype of
the largest cosine, which is the score, cut to 0..1.

Vectors are kept as bits, so binding is an exclusive or and permuting rolls words of 64
bits. Letters are lower-cased; what is no letter is a boundary, and runs of it count
once.

Training takes the rows that are given; ``sample`` bounds them: in each language a hash
of the text's id picks about ``train_docs``, all where there are no more. At most
``max_langs`` languages may occur, or it is an error; that bounds what goes to the
driver.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so
is every text if there is nothing to learn from; of equal cosines the language
that sorts first wins; very long texts are read whole, in blocks of ``STEP`` characters;
repeated rows are judged alike; an empty table gives an empty table; other columns stay
out (``keep_known`` keeps them), whatever their names; a null ``doc_id`` stays null and
is held out of the training.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.session import prepare_batches

DIMS, SEED, STEP, AT_ONCE = 1024, 7, 1 << 20, 1024
#: Cosines of a text of other letters are about 1 / sqrt(DIMS), 0.031; the shortest clean texts have 0.11 and more.
MIN_SCORE = 0.1
#: Random letters share a language's frequent n-grams, so their cosine grows with their number, but less than that of clean
#: texts does: calibrated on held-out documents and on random letters, 16 to 22,000 n-grams long.
MIN_BASE, MIN_RISE, MIN_FROM, MIN_MOST = 0.03, 0.03, 16, 0.3
_table: list[np.ndarray] = []
_MASK = np.uint64((1 << 21) - 1)


def letters() -> np.ndarray:
    """For each code point that of its lower-case letter; 0 for what is no letter."""
    if not _table:
        numbers = np.zeros(0x110000, np.uint32)
        for cp in range(0x110000):
            if (c := chr(cp)).isalpha():
                numbers[cp] = ord(c.lower()[0])
        _table.append(numbers)
    return _table[0]


def profile(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """The distinct n-grams of a whole text (three code points of 21 bits each) and their counts; None without a letter."""
    if not text:
        return None
    numbers, parts, last = letters(), [], np.zeros(1, np.uint32)
    for at in range(0, len(text), STEP):
        cps = np.frombuffer(text[at : at + STEP].encode("utf-32-le", "surrogatepass"), np.uint32)
        x = np.concatenate([last, numbers[cps]])
        keep = x > 0
        keep[1:] |= x[:-1] > 0
        keep[: len(last)] = True
        x = x[keep]
        if at + STEP >= len(text) and x[-1]:
            x = np.append(x, np.uint32(0))
        if len(x) >= 3:
            y = x.astype(np.uint64)
            parts.append(np.unique(y[:-2] << np.uint64(42) | y[1:-1] << np.uint64(21) | y[2:], return_counts=True))
        last = x[-2:]
    if len(parts) > 1:
        grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        return grams, np.bincount(where, np.concatenate([n for _, n in parts])).astype(np.int64)
    return parts[0] if parts else None


def letter_bits(cps: np.ndarray, dims: int = DIMS, seed: int = SEED) -> np.ndarray:
    """The random bits of each code point, in words of 64: splitmix64 of the code point, the word and the seed."""
    z = cps.astype(np.uint64)[:, None] * np.uint64(dims // 64) + np.arange(dims // 64, dtype=np.uint64) + np.uint64(seed << 32)
    z = (z + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def bound(grams: np.ndarray, dims: int = DIMS, seed: int = SEED) -> np.ndarray:
    """The n-grams' vectors as bits (a row of 0 and 1 for each; 1 stands for -1)."""
    places = np.stack([grams >> np.uint64(42), grams >> np.uint64(21) & _MASK, grams & _MASK])
    cps, at = np.unique(places, return_inverse=True)
    one, two, three = at.reshape(places.shape)
    bits = letter_bits(cps, dims, seed)
    words = np.roll(bits, 2, axis=1)[one] ^ np.roll(bits, 1, axis=1)[two] ^ bits[three]
    return np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")


def bundle(grams: np.ndarray, counts: np.ndarray, dims: int = DIMS, seed: int = SEED) -> np.ndarray:
    """The sum of the n-grams' vectors, each as often as ``counts`` says."""
    minus = np.zeros(dims, np.float64)
    for k in range(0, len(grams), AT_ONCE):
        part = bound(grams[k : k + AT_ONCE], dims, seed).astype(np.float32)
        minus += counts[k : k + AT_ONCE].astype(np.float32) @ part
    return counts.sum() - 2 * minus


@dataclass
class Profiles:
    """Learned languages: ``prototypes`` has a row of length 1 for each."""

    langs: list[str]
    prototypes: np.ndarray
    seed: int = SEED

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.judge(text)[:2]

    def judge(self, text: str | None) -> tuple[str, float, int]:
        """The language, its score, and the number of n-grams that it rests on."""
        found = profile(text)
        if found is None or not self.langs:
            return "und", 0.0, 0
        vector = bundle(*found, self.prototypes.shape[1], self.seed)
        cosines = self.prototypes @ vector / max(float(np.linalg.norm(vector)), 1e-12)
        best = int(cosines.argmax())
        return self.langs[best], float(min(1.0, max(0.0, cosines[best]))), int(found[1].sum())


def least_score(grams: int, min_score: float = MIN_SCORE) -> float:
    """What a text of so many n-grams must score: ``min_score``, and more for each doubling of their number."""
    return max(min_score, min(MIN_MOST, MIN_BASE + MIN_RISE * np.log2(max(grams, MIN_FROM) / MIN_FROM)))


def sample(docs: DataFrame, train_docs: int, max_langs: int = 64) -> DataFrame:
    """About ``train_docs`` rows of each ``lang``, picked by a hash of the id; all rows of one that has no more."""
    sizes = [r for r in docs.filter("lang is not null").groupBy("lang").count().limit(max_langs + 1).collect()]
    if len(sizes) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    most = F.lit(1 << 30)
    for r in sizes:
        if r["count"] > train_docs:
            most = F.when(F.col("lang") == r.lang, F.lit(int((1 << 30) * train_docs / r["count"]))).otherwise(most)
    return docs.filter(F.col("lang").isNotNull() & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < most))


def learn(docs: DataFrame, dims: int = DIMS, seed: int = SEED, max_langs: int = 64) -> Profiles:
    """From columns ``text`` and ``lang``; rows without a language or without a letter teach nothing."""
    prepare_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if (found := profile(text)) is not None and (lang in sums or len(sums) <= max_langs):
                    vector = bundle(*found, dims, seed)
                    sums[lang] = sums.get(lang, 0) + vector / max(float(np.linalg.norm(vector)), 1e-12)
        for lang, vector in sums.items():
            # whole numbers, so that the sum does not depend on the order of the tasks
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dims, pa.string()), pa.array(range(dims), pa.int32()), pa.array(np.rint(vector * 2**32).astype(np.int64))],
                ["lang", "dim", "n"],
            )

    # langs * dims rows go to the driver
    found = (
        docs.filter(F.col("lang").isNotNull())
        .select("text", "lang")
        .mapInArrow(run, "lang string, dim int, n long")
        .groupBy("lang", "dim")
        .agg(F.sum(F.col("n").cast("double")).alias("n"))
        .toArrow()
    )
    names = found.column("lang").to_numpy(zero_copy_only=False)
    langs = sorted(set(names))
    if len(langs) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    prototypes = np.zeros((len(langs), dims), np.float64)
    dim, n = found.column("dim").to_numpy(), found.column("n").to_numpy()
    for k, lang in enumerate(langs):
        prototypes[k, dim[names == lang]] = n[names == lang]
        prototypes[k] /= max(float(np.linalg.norm(prototypes[k])), 1e-12)
    return Profiles(langs, prototypes, seed)


def identify(docs: DataFrame, model: Profiles) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row of ``docs``."""
    prepare_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Profiles, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs``, all columns, that have a language with ``least_score`` or more."""
    prepare_batches(docs.sparkSession)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def known(text: str | None) -> bool:
        lang, score, grams = shared.value.judge(text)
        return lang != "und" and score >= least_score(grams, min_score)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([known(t) for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
