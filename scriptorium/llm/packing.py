"""Packing documents into windows by minimum bin slack.

A document's token ids, with an end id, are cut into full windows and one
remainder. Each task keeps a pool of remainders. While the pool has a window's
worth of tokens, the largest remainder opens a window, and a subset-sum dynamic
program over the multiset of the other lengths finds the fill closest to the
capacity: sums that can be reached are the bits of an integer, a length with a
count is added in powers of two, and the counts are found by walking the steps
back. Slack that no subset fills takes the head of another remainder. The rest at
a task's end is cut into windows whose lengths are powers of two, which need no
padding. So no id is padding, lost or repeated.

There is no shuffle; a task holds ``pool_tokens`` ids, one Arrow batch, and all ids of the
document it reads (4 bytes for each). A task ends with at most 12 short sequences, one of
each power of two below a window's.
Sequence ids are the task's number times 2**36 plus a count, so they are unique
within a run; a task that is run again gives the same ones.

Tokenizing: the vocabulary's library splits a text into pieces that it encodes by
themselves. Where a text has only ASCII and Latin-1 letters the same split is made
here, and pieces are looked up in a table of those that the library has encoded
before (at most ``CACHED``); other texts, and those with control strings, go to
the library whole, long ones cut at safe spaces.

Defined results: a null or empty text is the end id alone; of remainders of equal length
the one that came last goes first; very long texts are read whole; repeated rows are
packed one by one; an empty table gives an empty table; other columns stay out,
whatever their names; a null ``doc_id`` stays null.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from scriptorium.llm.token_count import model_path, pieces
from scriptorium.session import prepare_batches

CACHED = 400_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Outside this set of characters texts go to the library whole.
_OTHER = re.compile("[^\t-\r -~À-ÖØ-öø-ÿ]")
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\s0-9a-zß-öø-ÿ]+")


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for t, k in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def learn(self, new: list[str]) -> None:
        """Encodes pieces, many in one text: each ends with an id of a word's end."""
        for at in range(0, len(new), 1000):
            part = new[at : at + 1000]
            ids = np.array(self.ids(" ".join(part)), "<u4")
            ends = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(ends) == len(part) and ends[-1] == 4 * len(ids):
                held, stops = ids.tobytes(), ends.tolist()
                self.known.update(zip(part, map(held.__getitem__, map(slice, [0, *stops], stops)), strict=True))
            else:
                self.known.update((p, pack_ids(self.ids(p))) for p in part)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [
            _PIECE.findall(t.lower()) if t and "<|" not in t and not _OTHER.search(t) else None for t in texts
        ]
        if len(self.known) > CACHED:
            # frequent pieces come first, so the older half is the better one
            self.known = dict(islice(self.known.items(), CACHED // 2))
        out = []
        for text, found in zip(texts, split, strict=True):
            if found is None:
                out.append(b"".join(pack_ids(self.ids(p)) for p in pieces(text, 1 << 18)) if text else b"")
                continue
            try:
                out.append(b"".join(map(self.known.__getitem__, found)))
            except KeyError:
                # what the rest of the batch has is learned with it
                self.learn(list({p for s in split[len(out) :] if s for p in s}.difference(self.known)))
                out.append(b"".join(map(self.known.__getitem__, found)))
        return out


_encoders: dict[str, Encoder] = {}


def encoder_at(path: str) -> Encoder:
    """The encoder for a file, one for each worker process, so that tasks after the first find its table filled."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pack_ids(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length to take so that the sum is as close to ``capacity`` as it can be from below."""
    reach, limit = 1, (1 << (capacity + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted(counts, reverse=True):
        left, many = min(counts[length], capacity // length), 1
        while left > 0:
            many = min(many, left)
            steps.append((length, many, reach))
            reach |= (reach << length * many) & limit
            left -= many
            many *= 2
        if reach >> capacity:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, many, before in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + many
            total -= length * many
    return taken


class Packer:
    """Windows out of documents that come one after another. A piece: ``doc_id, start, ids, doc_tokens``."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next = capacity, first
        self.pool: dict[int, list[tuple]] = {}
        self.tokens = 0
        self.rows: list[tuple] = []

    def put(self, piece: tuple) -> None:
        n = len(piece[2]) // 4
        self.pool.setdefault(n, []).append(piece)
        self.tokens += n

    def take(self, length: int) -> tuple:
        held = self.pool[length]
        piece = held.pop()
        if not held:
            del self.pool[length]
        self.tokens -= length
        return piece

    def close(self, window: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in window:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.next, offset))
            offset += n
        self.next += 1

    def add(self, doc: int | None, ids: bytes) -> None:
        total, step = len(ids) // 4, 4 * self.capacity
        full = len(ids) - len(ids) % step
        for at in range(0, full, step):
            self.close([(doc, at // 4, ids[at : at + step], total)])
        if full < len(ids):
            self.put((doc, full // 4, ids[full:], total))

    def head(self, n: int) -> tuple:
        """The first ``n`` ids of the largest piece, or all of it; the rest goes back."""
        doc, start, ids, total = self.take(max(self.pool))
        if 4 * n < len(ids):
            self.put((doc, start + n, ids[4 * n :], total))
        return doc, start, ids[: 4 * n], total

    def drain(self) -> None:
        """Windows while the pool can fill them."""
        while self.tokens >= self.capacity:
            largest = max(self.pool)
            window, slack = [self.take(largest)], self.capacity - largest
            for length, many in fill({n: len(p) for n, p in self.pool.items() if n <= slack}, slack).items():
                window += [self.take(length) for _ in range(many)]
                slack -= length * many
            while slack:
                window.append(self.head(slack))
                slack -= len(window[-1][2]) // 4
            self.close(window)

    def finish(self) -> None:
        """The rest, in windows of powers of two."""
        self.drain()
        while self.tokens:
            window, room = [], 1 << self.tokens.bit_length() - 1
            while room:
                window.append(self.head(room))
                room -= len(window[-1][2]) // 4
            self.close(window)


def pack(
    docs: DataFrame,
    vocabulary: str = "word_bpe_49k.json",
    folder: str | None = None,
    end_id: int = 2,
    capacity: int = 4096,
    pool_tokens: int = 1 << 20,
) -> DataFrame:
    """A row for each piece of each document, with its sequence and offset there."""
    if capacity & (capacity - 1):
        raise ValueError("the capacity is a power of two")
    prepare_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_at(model_path(vocabulary, folder)), pack_ids([end_id])
        packer = Packer(capacity, TaskContext.get().partitionId() << 36)

        def out() -> pa.RecordBatch:
            columns = list(zip(*packer.rows, strict=True)) or [()] * 7
            packer.rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [c.split()[0] for c in SCHEMA.split(", ")])

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(ids), 256):
                for doc, own in zip(ids[at : at + 256], encoder.encode(texts[at : at + 256]), strict=True):
                    packer.add(doc, own + end)
                if packer.tokens >= pool_tokens:
                    packer.drain()
            yield out()
        packer.finish()
        yield out()

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(run, SCHEMA)
