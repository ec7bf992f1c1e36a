"""Token counts: Arrow functions that encode batches and return lengths only.

Batches are filled by bytes, not by rows, so that a task holds about
``batch_bytes`` of text whatever the lengths. A text longer than ``piece_bytes``
is cut at single spaces between two letters of ASCII. There no token spans the
cut: a piece of this vocabulary holds a word start only at its beginning, and the
library puts one in front of each text it encodes, in the place of the space that
the cut takes away. Where no such place comes, the text grows until one does.

Defined results: a null text counts as empty, with 0 bytes and 0 tokens; texts of equal
length are counted alike, very long ones in pieces; repeated
rows are counted one by one; an empty table gives an empty table; other columns
stay out, whatever their names; a null ``doc_id`` stays null.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from scriptorium.session import prepare_batches

SCHEMA = "doc_id long, n_bytes long, n_tokens long"
_SAFE = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
_loaded: dict = {}


def model_path(name: str = "piece_bpe_32k.model", folder: str | None = None) -> str:
    """A vocabulary's place: in ``folder``, or where the package of public tokenizers has it."""
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(text: str, most: int) -> Iterator[str]:
    """``text`` cut at safe single spaces into pieces of about ``most`` characters; the spaces go."""
    at = 0
    while len(text) - at > most:
        cut = _SAFE.search(text, at + most)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:] if at else text


def processor(name: str, folder: str | None):
    """The library's processor, one for each worker process and file."""
    if (key := (name, folder)) not in _loaded:
        import sentencepiece

        _loaded[key] = sentencepiece.SentencePieceProcessor(model_file=model_path(name, folder))
    return _loaded[key]


def n_bytes(text: str) -> int:
    """Of UTF-8."""
    return len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass"))


def count(texts: Iterable[str | None], encode, batch_bytes: int, piece_bytes: int) -> Iterator[int]:
    """The number of tokens of each text; ``encode`` takes a list of strings."""
    held: list[str] = []
    owners: list[int] = []
    totals: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        for owner, ids in zip(owners, encode(held), strict=True):
            totals[owner] += len(ids)
        held.clear()
        owners.clear()
        size = 0

    for text in texts:
        totals.append(0)
        whole = text or ""
        for piece in pieces(whole, max(1, piece_bytes * len(whole) // max(n_bytes(whole), 1))):
            held.append(piece)
            owners.append(len(totals) - 1)
            size += n_bytes(piece) + 64
            if size >= batch_bytes:
                flush()
        if len(totals) >= 4096 and not held:
            yield from totals
            totals.clear()
    flush()
    yield from totals


def token_counts(
    docs: DataFrame,
    model: str = "piece_bpe_32k.model",
    folder: str | None = None,
    batch_bytes: int = 1 << 20,
    piece_bytes: int = 1 << 18,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row of ``docs``."""
    prepare_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(model, folder)

        def encode(texts: list[str]) -> list[list[int]]:
            return sp.encode(texts, num_threads=1) if texts else []

        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n_bytes(t or "") for t in texts], pa.int64()),
                    pa.array(list(count(texts, encode, batch_bytes, piece_bytes)), pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(run, SCHEMA)
