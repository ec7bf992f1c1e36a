"""Secret scans: patterns, then a token-efficiency test for strings they do not know.

A string that language or code uses is in a vocabulary's longer pieces; a random
one falls into pieces of one or two characters. A candidate is a run of 20 or
more characters of ``[A-Za-z0-9+/_=-]``, of whatever letters and digits,
which no pattern has found and which is not a known digest (``known``, sets of
hex or base64 lengths with their alphabets) or an identifier (UUIDs, numbers,
words joined by ``-``, ``_`` or ``/``, paths; words are what the vocabulary reads
in more than ``ratio`` characters a token). UUIDs, digests and what the patterns
found are cut out of a run, and what is left is a run again. A part between
separators, or the shortest stretch of parts with 20 characters, is a secret if it
has at most ``ratio`` characters for each token of a tiktoken vocabulary; so is a
part with a window of 20 characters that has at most 0.85 of that.

Spans are ``(kind, start, end)`` in code points, the end exclusive, ordered by
start, then kind as in ``KINDS``. Defined results: a null text counts as empty
and has no span; spans of one start are in the order of ``KINDS``; very long texts are scanned
whole; repeated rows are scanned one by one; an empty table gives an
empty table; other columns stay out (``redact`` keeps them), whatever their names;
a null ``doc_id`` stays null.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from scriptorium.session import prepare_batches

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")
LEAST, LONG = 20, 64
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
PART = re.compile(r"[A-Za-z0-9+]+")
#: Digests that are no secrets: MD5, SHA-1, SHA-256, SHA-512 in capital hex; subresource integrity values.
DIGEST = re.compile(r"(?:[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64}|[0-9A-F]{128}|sha(?:256|384|512)-[A-Za-z0-9+/]+={0,2})")
#: The same as parts of a run, by their exact lengths.
PART_DIGEST = re.compile(
    r"(?<![A-Za-z0-9])(?:(?:[0-9A-F]{128}|[0-9A-F]{64}|[0-9A-F]{40}|[0-9A-F]{32})(?![A-Za-z0-9])"
    r"|sha(?:256-[A-Za-z0-9+/]{43}|384-[A-Za-z0-9+/]{64}|512-[A-Za-z0-9+/]{86})(?![A-Za-z0-9+])={0,2})"
)
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
#: Parts that people name things by: a word in one case or capitalised, or a number.
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,8}")
_encodings: dict = {}


def encoding(name: str = "byte_bpe_50k.tiktoken", folder: str | None = None):
    """The vocabulary as a tiktoken encoding, one for each worker process and file."""
    if (key := (name, folder)) not in _encodings:
        import public_tokenizers
        import tiktoken

        with open(f"{folder}/{name}" if folder else public_tokenizers.path(name), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encodings[key] = tiktoken.Encoding(
            name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _encodings[key]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """What the patterns find: leftmost, non-overlapping for each kind; a match that is too short is dropped."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def named(word: str, enc, ratio: float) -> bool:
    """Whether ``word`` is a known digest or an identifier."""
    if DIGEST.fullmatch(word) or len(set(word)) < 5:  # lines and masks repeat a few characters
        return True
    parts = [p for p in re.split(r"[-_/+=]+", word) if p]
    parts = [p for p in parts if len(p) > 3] or parts  # versions and the like say nothing beside words
    pieces = [NAME_PART.findall(p) for p in parts]
    # in names words are long; random strings change between cases and digits every few characters
    if any(len(x) > 1 + len(p) // 5 for p, x in zip(parts, pieces, strict=True)):
        return False
    # letters of one case look like one long word, so the vocabulary must know the words too
    words = [x for p, found in zip(parts, pieces, strict=True) if len(p) > 3 for x in found if x.isalpha()]
    # joined words are names even if the vocabulary knows their language little
    least = ratio if len(parts) == 1 else 0.75 * ratio
    return sum(map(len, words)) > least * sum(len(enc.encode_ordinary(x)) for x in words) or not words


def rest(word: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What is left of a run without ``taken``, UUIDs and digests, where it is long enough to be a candidate."""
    cut = taken + [m.span() for pattern in (UUID, PART_DIGEST) for m in pattern.finditer(word)]
    at = 0
    for start, end in [*sorted(cut), (len(word), len(word))]:
        if start - at >= LEAST:
            yield at, start
        at = max(at, end)


def random_parts(word: str, enc, ratio: float) -> list[tuple[int, int]]:
    """The random stretches of a run, from separator to separator.

    Tested are each part between separators, the shortest stretches of parts that are long
    enough (separators may be characters of a secret), and windows inside of long parts. Plain
    words in the same run thus do not hide a random part.
    """

    def hit(start: int, end: int, most: float = ratio) -> bool:
        x = word[start:end]
        return len(x) <= most * len(enc.encode_ordinary(x)) and not named(x, enc, most)

    parts = [m.span() for m in PART.finditer(word)]
    hits = set()  # first and last part
    for k, (start, end) in enumerate(parts):
        if end - start >= LEAST:
            # stretches, as the vocabulary takes long to read what has no end
            stretches = ((x, min(x + LONG, end)) for x in range(start, end - LEAST + 1, LONG // 2))
            # words are cut at a window's ends, which costs tokens
            windows = (min(x, end - LEAST) for x in range(start, end - LEAST + 4, 4))
            if any(hit(*x) for x in stretches) or any(hit(x, x + LEAST, 0.85 * ratio) for x in windows):
                hits.add((k, k))
            continue
        up = next((j for j in range(k, len(parts)) if parts[j][1] - start >= LEAST), None)
        down = next((j for j in range(k, -1, -1) if end - parts[j][0] >= LEAST), None)
        for i, j in {(k, up), (down, k)}:
            if i is not None and j is not None and parts[j][1] - parts[i][0] <= LONG and hit(parts[i][0], parts[j][1]):
                while i < j and plain(word[slice(*parts[i])], enc, ratio):
                    i += 1
                while i < j and plain(word[slice(*parts[j])], enc, ratio):
                    j -= 1
                hits.add((i, j))
    if not hits and LEAST <= len(word) <= LONG and hit(0, len(word)):
        return [(0, len(word))]  # separators at the ends may be characters of it, too
    out: list[tuple[int, int]] = []
    for i, j in sorted(hits):
        start, end = parts[i][0], parts[j][1]
        if out and start <= out[-1][1] + 8:  # a part between that looks like a word is one by chance
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return [(s, min(len(word), e + len(word[e:]) - len(word[e:].lstrip("=")))) for s, e in out]


def plain(part: str, enc, ratio: float) -> bool:
    """Whether a part at the end of a random stretch is a word beside it."""
    return len(part) > 3 and named(part, enc, ratio)


def random_spans(text: str, taken: list[tuple[str, int, int]], enc, ratio: float) -> list[tuple[str, int, int]]:
    """Candidates outside ``taken`` that the token-efficiency test finds."""
    found = []
    for m in CANDIDATE.finditer(text):
        word, at = m.group(), m.start()
        if DIGEST.fullmatch(word):
            continue
        inside = [(max(s - at, 0), min(e - at, len(word))) for _, s, e in taken if s < m.end() and at < e]
        for left, right in rest(word, inside):
            found += [("random", at + left + s, at + left + e) for s, e in random_parts(word[left:right], enc, ratio)]
    return found


def spans(text: str | None, enc, ratio: float = 2.0) -> list[tuple[str, int, int]]:
    if not text:
        return []
    base = base_spans(text)
    return sorted(base + random_spans(text, base, enc, ratio), key=lambda s: (s[1], KINDS.index(s[0])))


def scan(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", folder: str | None = None, ratio: float = 2.0) -> DataFrame:
    """``doc_id, spans array<struct<kind, start, end>>`` of every row of ``docs``."""
    prepare_batches(docs.sparkSession)
    item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(vocabulary, folder)
        for batch in batches:
            found = [
                [{"kind": k, "start": s, "end": e} for k, s, e in spans(t, enc, ratio)] for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, item)], ["doc_id", "spans"])

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(
        run, "doc_id long, spans array<struct<kind: string, start: long, end: long>>"
    )


def without(text: str, found: list[tuple[str, int, int]], mark: str) -> str:
    """``text`` with each stretch that spans cover replaced by ``mark``."""
    out, at = [], 0
    covered: list[list[int]] = []
    for _, start, end in found:
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    for start, end in covered:
        out += [text[at:start], mark]
        at = end
    return "".join(out) + text[at:]


def redact(
    docs: DataFrame,
    vocabulary: str = "byte_bpe_50k.tiktoken",
    folder: str | None = None,
    ratio: float = 2.0,
    mark: str = "[SECRET]",
) -> DataFrame:
    """All rows and columns of ``docs``, with the spans in ``text`` replaced by ``mark``.

    ``n_chars``, where it is a column, follows the text.
    """
    prepare_batches(docs.sparkSession)
    at = docs.columns.index("text")
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(vocabulary, folder)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            found = [spans(t, enc, ratio) for t in texts]
            columns = list(batch.columns)
            if any(found):
                new = [without(t, f, mark) if f else t for t, f in zip(texts, found, strict=True)]
                columns[at] = pa.array(new, batch.schema.field(at).type)
                if chars is not None:
                    sizes = [len(t) if f else n for t, f, n in zip(new, found, columns[chars].to_pylist(), strict=True)]
                    columns[chars] = pa.array(sizes, batch.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
