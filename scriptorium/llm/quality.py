"""Quality rules per document and per host.

Each document is held against the rules of ``RULES``. Failures are aggregated by
host (column ``source``); a host's rate is shrunk by a beta prior that is fitted
to the rates of all hosts by the method of moments. Where hosts differ by no more than
chance the moments give a prior without bound; it then weighs as much as the mean
host's documents. Hosts are judged by their shrunk rate against the prior, of mean m and
standard deviation s; the verdict decides how strict their documents are judged:

* ``bad`` (above ``m + bad * s``, and most documents fail): no document stays;
* ``good`` (below ``m - good * s``, the lower quartile): all stay that pass the base rule;
* ``mixed`` (all others): documents that fail no rule stay.

The per-document figures are written once to the shared folder, without texts.
The verdicts' table is broadcast only if its rows have been counted to be at most
``broadcast_hosts``; else the join is an ordinary one.

Defined results: a null text counts as empty: no words, base rule failed; a null
``source`` is the same host as an empty one; a host at a bound is mixed; very long
texts are read whole, words in blocks; repeated rows are judged one by one
and all count for their host; an empty table gives an empty table; other columns
stay out, whatever their names; a null ``doc_id`` stays null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.words import word_blocks
from scriptorium.session import Durable, prepare_batches

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"
WINDOW = 5
FIGURES = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_upper n_letters n_shouts".split()
_ASCII, _UPPER, _LETTER = re.compile(r"[\x00-\x7f]+"), re.compile(r"[À-ÖØ-Þ]"), re.compile(r"[^\W\d_]")
_CAPITALS, _LETTERS = (bytes(range(65, 91)), bytes(range(65, 91)) + bytes(range(97, 123)))
_FACTORS = np.random.default_rng(11).integers(1 << 62, 1 << 63, WINDOW, np.uint64) | np.uint64(1)

#: A document fails the rule where the expression is true.
RULES = {
    "base": "n_words < 10 or 100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "n_dup_lines > 2 and 10 * n_dup_lines > 3 * n_lines",
    "shouting": "10 * n_upper > 5 * n_letters",
    "exclaiming": "10 * n_shouts > 3 * n_words",
    "word_length": "10 * word_chars < 25 * n_words or word_chars > 15 * n_words",
}


def repeated(words: np.ndarray, window: int = WINDOW) -> int:
    """How many of the words, given as numbers, are in windows found twice or more.

    Windows are numbered exactly, two, four, then five words wide, by sorting; but most texts
    have no two windows of one hash, and so no repeated one.
    """
    if len(words) <= window:
        return 0
    mixed = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    hashes = sum(mixed[k : len(words) - window + 1 + k] * _FACTORS[k % WINDOW] for k in range(window))
    hashes.sort()
    if not (hashes[1:] == hashes[:-1]).any():
        return 0
    ids, width = words, 1
    while width < window:
        step = min(width, window - width)
        n = len(words) - width - step + 1
        _, ids, counts = np.unique(ids[:n] * (int(ids.max()) + 1) + ids[step : step + n], return_inverse=True, return_counts=True)
        width += step
        if len(counts) == n:
            return 0
    twice = counts[ids] > 1
    inside = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + window, -1)
    return int((np.cumsum(inside[:-1]) > 0).sum())


def count_of(data: bytes, characters: bytes) -> int:
    """How many of ``data`` are among some ASCII characters."""
    return len(data) - len(data.translate(None, characters))


def figures(text: str | None) -> tuple[int, ...]:
    """The counts named by ``FIGURES``, of a whole text."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    numbers: dict[bytes, int] = {}
    parts = [
        np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
        for words in word_blocks(data, 0)
    ]
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    other = _ASCII.sub("", text) if len(data) > len(text) else ""
    return (
        len(ids),
        len(text) - count_of(data, WHITE.encode()),
        count_of(data, SYMBOLS.encode()),
        len(lines) - len(set(lines)),
        repeated(ids),
        len(lines),
        count_of(data, _CAPITALS) + len(_UPPER.findall(other)),
        count_of(data, _LETTERS) + len(_LETTER.findall(other)),
        data.count(b"!"),
    )


def document_figures(docs: DataFrame) -> DataFrame:
    """``doc_id, host`` and the figures of every row."""
    prepare_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([figures(t) for t in batch.column(2).to_pylist()], np.int64).reshape(-1, len(FIGURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, rows.T)], ["doc_id", "host", *FIGURES]
            )

    host = F.coalesce(docs["source"], F.lit("")).alias("host")
    schema = "doc_id long, host string, " + ", ".join(f"{n} long" for n in FIGURES)
    return docs.select(docs["doc_id"].cast("long"), host, docs["text"]).mapInArrow(run, schema)


def fails_any() -> Column:
    return F.expr(" or ".join(f"({rule})" for rule in RULES.values()))


def host_rates(judged: DataFrame) -> DataFrame:
    """``host, n, failed`` and a count for each rule, of rows with the figures; pre-aggregated before the shuffle."""
    return judged.groupBy("host").agg(
        F.count("*").alias("n"),
        F.count_if(fails_any()).alias("failed"),
        *(F.count_if(F.expr(rule)).alias(f"failed_{name}") for name, rule in RULES.items()),
    )


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """``alpha, beta`` by the method of moments over ``host, n, failed``; one row goes to the driver.

    What the hosts' rates vary beyond binomial chance is the prior's variance. The prior weighs
    one document at least, and as many as the mean host has at most.
    """
    row = hosts.agg(
        F.sum("n").alias("n"), F.sum("failed").alias("f"), F.count("*").alias("hosts"), F.sum(F.col("failed") * F.col("failed") / F.col("n")).alias("q")
    ).first()
    if not row.n:
        return 1.0, 1.0
    mean, most = (row.f + 0.5) / (row.n + 1), row.n / row.hosts
    spread = max(0.0, row.q / row.n - (row.f / row.n) ** 2 - mean * (1 - mean) * row.hosts / row.n)
    total = max(min(mean * (1 - mean) / spread - 1 if spread > 1e-9 else most, most), 1.0)
    return mean * total, (1 - mean) * total


def verdict_bounds(prior: tuple[float, float], good: float, bad: float, most: float) -> tuple[float, float]:
    """The shrunk rates below which hosts are good and above which they are bad."""
    total = prior[0] + prior[1]
    mean = prior[0] / total
    deviation = (mean * (1 - mean) / (total + 1)) ** 0.5
    return mean - good * deviation, max(most, mean + bad * deviation)


def host_verdicts(hosts: DataFrame, prior: tuple[float, float], good: float, bad: float, most: float) -> DataFrame:
    """``host, n, failed, rate, verdict``."""
    alpha, beta = prior
    low, high = verdict_bounds(prior, good, bad, most)
    rate = (F.col("failed") + alpha) / (F.col("n") + (alpha + beta))
    return hosts.withColumn("rate", rate).withColumn(
        "verdict", F.when(F.col("rate") > high, "bad").when(F.col("rate") < low, "good").otherwise("mixed")
    )


def judge(
    docs: DataFrame, good: float = 0.67, bad: float = 1.0, most: float = 0.5, broadcast_hosts: int = 20_000
) -> DataFrame:
    """``doc_id``, the figures, ``base_failed``, the host's ``rate`` and ``verdict``, and ``kept`` of every row."""
    store = Durable(docs.sparkSession, "quality")
    rows = store.save(document_figures(docs))
    hosts = store.save(host_rates(rows))
    verdicts = host_verdicts(hosts, beta_prior(hosts), good, bad, most).select("host", "rate", "verdict")
    if hosts.count() <= broadcast_hosts:
        verdicts = F.broadcast(verdicts)
    passes = (F.col("verdict") == "good") | ((F.col("verdict") == "mixed") & ~fails_any())
    return (
        rows.join(verdicts, "host")
        .withColumn("base_failed", F.expr(RULES["base"]))
        .withColumn("kept", ~F.col("base_failed") & passes)
    )
