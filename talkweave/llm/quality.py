"""Quality rules, with rates of failure by host that are shrunk by an empirical beta prior.

Each document is measured on its own, in arrays over many texts. A document that
fails a base rule is rejected. The failures of the softer rules are counted by
host; each host's rate is drawn towards the rate of all hosts by a beta prior
fitted to the hosts, so that a host of few documents is not judged by chance.

A document that fails a soft rule is judged by its host's shrunk rate and by its
own excess, the part of its measure that lies over the limit: it is rejected if
the two add up to more than ``VERDICT``. So a host that mostly fails loses all
documents that fail, while on an ordinary host those go that exceed a limit about
twice over. A document that fails no rule is kept whatever its host.

Defined cases: a missing text has no words, so it fails; a missing ``source``
counts as the host ``""``; repeated rows are judged alike and counted each; no
rows give no rows; further columns are ignored, or carried along by ``kept_rows``;
a very long text is measured as one chunk, with some ten numbers for each word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkweave.llm import words as W
from talkweave.llm.rows import beside_rows, shown_id
from talkweave.operators.skew import hot_keys, salted_join
from talkweave.session import stage

LEAST_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
#: The prior counts for as many documents at least, so that one document alone makes no bad host.
LEAST_STRENGTH = 4.0
#: A document is rejected if its host's shrunk rate and its own excess add up to more than this.
VERDICT = 0.5

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
COLUMNS = ", ".join(f"{m} bigint" for m in MEASURES)

#: The softer rules: a document fails where the first exceeds the second.
SOFT_RULES: dict[str, tuple[str, str]] = {
    "symbols": ("10 * n_symbols", "n_words"),
    "lines": ("10 * n_dup_lines", "3 * n_lines"),
    "short": ("2 * n_words", "word_chars"),
    "long": ("word_chars", "15 * n_words"),
}


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _same_text(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Make hashes differ between texts."""
    return W.mix(keys + owner.astype(np.uint64) * np.uint64(0x9E6C63D0676A9A99))


def _repeated(keys: np.ndarray) -> np.ndarray:
    """A flag for each key that occurs twice or more."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[place] == keys


def measures(chunk: W.Chunk) -> list[np.ndarray]:
    """The columns of ``MEASURES`` for the texts of a chunk."""
    data, offsets = chunk.data, chunk.offsets
    texts = len(offsets) - 1
    words = W.split(data, offsets)
    n_words = np.diff(words.first)
    points = ~W.IS_SPACE[data] & ((data & 0xC0) != 0x80)
    line = data.tobytes()
    owner = np.repeat(np.arange(texts), n_words)

    newline = np.flatnonzero(data == 10)
    line_start = np.sort(np.concatenate([offsets[:-1], newline + 1]), kind="stable")
    line_end = np.sort(np.concatenate([newline, offsets[1:]]), kind="stable")
    in_text = np.searchsorted(newline, offsets)
    n_lines = np.diff(in_text) + 1
    line_owner = np.repeat(np.arange(texts), n_lines)
    worded = np.searchsorted(words.start, line_end) > np.searchsorted(words.start, line_start)
    line_keys = W.xxh64(line, line_start[worded], (line_end - line_start)[worded])
    _, one_of_each = np.unique(_same_text(line_keys, line_owner[worded]), return_index=True)
    distinct = np.bincount(line_owner[worded][one_of_each], minlength=texts)
    n_dup_lines = np.bincount(line_owner[worded], minlength=texts) - distinct

    hashes = W.word_hashes(data, words)
    windows = W.sliding_hashes(W.prefixes(hashes, W.WORD_BASE), REPEAT_WINDOW, W.WORD_BASE)
    begins = np.flatnonzero(owner[: len(windows)] == owner[REPEAT_WINDOW - 1 :])
    twice = begins[_repeated(_same_text(windows[begins], owner[begins]))]
    inside = W.covered(twice, np.full(len(twice), REPEAT_WINDOW), len(owner))
    n_repeat = np.bincount(owner[inside], minlength=texts)
    return [n_words, _sums(points, offsets), _sums(SYMBOL[data], offsets), n_lines, n_dup_lines, n_repeat]


def _measure(texts: pa.Array) -> list[pa.Array]:
    parts = [measures(chunk) for chunk in W.chunks(texts)]
    columns = zip(*parts) if parts else ([np.zeros(0, np.int64)] for _ in MEASURES)
    return [pa.array(np.concatenate(c).astype(np.int64)) for c in columns]


def base_failed() -> Column:
    """True for fewer than 20 words, or over 30 % of words in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def measure(docs: DataFrame, carried: list[str] | None = None) -> DataFrame:
    """The measures of each document, ``base_failed``, and ``failed_RULE`` for each softer rule.

    ``carried`` are the columns that stay in ``row`` beside them, all by default.
    """
    rows = docs if carried is None else docs.select("doc_id", "source", "text", *carried)
    rows = beside_rows(rows, _measure, COLUMNS).withColumn("host", F.coalesce(F.col("row.source").cast("string"), F.lit("")))
    flags = {f"failed_{rule}": F.expr(f"{over} > {limit}") for rule, (over, limit) in SOFT_RULES.items()}
    return rows.withColumn("base_failed", base_failed()).withColumns(flags)


def host_rates(measured: DataFrame) -> DataFrame:
    """One row per host: documents, failures and shrunk rates for each softer rule.

    The prior of a rule is a beta distribution with the mean and variance of the
    hosts' rates, weighted by their documents. Hosts of equal rates give a
    strong prior, hosts that differ a weak one.
    """
    hosts = measured.groupBy("host").agg(
        F.count("*").alias("n_documents"),
        *(F.sum(F.col(f"failed_{rule}").cast("bigint")).alias(f"n_{rule}") for rule in SOFT_RULES),
    )
    squares = [F.sum(F.col(f"n_{r}") * F.col(f"n_{r}") / F.col("n_documents")).alias(f"s_{r}") for r in SOFT_RULES]
    sums = [F.sum(f"n_{r}").alias(f"n_{r}") for r in SOFT_RULES]
    whole = hosts.agg(F.sum("n_documents").alias("n"), *sums, *squares).first()
    out = hosts
    for rule in SOFT_RULES:
        n = whole["n"] or 1
        mean = (whole[f"n_{rule}"] or 0) / n
        variance = (whole[f"s_{rule}"] or 0.0) / n - mean * mean
        strength = max(mean * (1 - mean) / variance - 1, LEAST_STRENGTH) if variance > 1e-12 else 1e9
        rate = (F.col(f"n_{rule}") + F.lit(mean * strength)) / (F.col("n_documents") + F.lit(strength))
        out = out.withColumn(f"rate_{rule}", rate)
    return out


def _judged(measured: DataFrame, rates: DataFrame) -> DataFrame:
    """``measured`` with the verdict of each softer rule as ``blamed_RULE``, ``host_failed`` for any, and ``kept``.

    The hosts' rates are a written table, so Spark knows its size; hosts of very many documents are salted.
    """
    large = hot_keys(rates, "host", "n_documents")
    joined = salted_join(measured, rates.select("host", *(f"rate_{rule}" for rule in SOFT_RULES)), "host", large, "key_id", "left")
    verdicts = {}
    for rule, (over, limit) in SOFT_RULES.items():
        excess = F.expr(f"1 - ({limit}) / nullif({over}, 0)")
        verdicts[f"blamed_{rule}"] = F.col(f"failed_{rule}") & (F.col(f"rate_{rule}") + excess > VERDICT)
    blamed = F.lit(False)
    for rule in SOFT_RULES:
        blamed = blamed | F.col(f"blamed_{rule}")
    return joined.withColumns(verdicts).withColumn("host_failed", blamed).withColumn("kept", ~F.col("base_failed") & ~blamed)


def judge(docs: DataFrame) -> DataFrame:
    """The measures of each document with the verdicts on it and ``kept``."""
    measured = stage(measure(docs, carried=[]).drop("row"))
    return _judged(measured, stage(host_rates(measured))).select(shown_id(), "*")


def kept_rows(docs: DataFrame) -> DataFrame:
    """The documents that ``judge`` keeps, with all their columns.

    Rows are written once beside their measures and then filtered where they are;
    only those that fail a softer rule meet their hosts' rates.
    """
    measured = stage(measure(docs))
    fails = F.lit(False)
    for rule in SOFT_RULES:
        fails = fails | F.col(f"failed_{rule}")
    passed = measured.filter(~F.col("base_failed"))
    doubtful = _judged(passed.filter(fails), stage(host_rates(measured))).filter("kept")
    return passed.filter(~fails).select("row.*").union(doubtful.select("row.*"))
