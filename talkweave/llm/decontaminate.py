"""Benchmark passages in documents, found by one Aho-Corasick automaton.

The benchmark's texts (questions and answers) are normalised to words and cut
into windows of 13 words. All windows go into one automaton, which reads each
document's normalised text once. Normalising keeps every byte in its place, so
matches map back to the original text.

The benchmark is collected in shards of at most ``SHARD_BYTES``, as the automaton
must fit in a task. One shard is the usual case; a larger benchmark is scanned
for shard by shard, and the hits of a document are put together afterwards. The
result does not depend on the number of shards.

Defined cases: a missing text or a text without words has no hits; an item
without words has no windows; items that repeat are each reported; repeated rows
give the same result; no rows give no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.llm import words as W
from talkweave.llm.rows import beside_rows, keep_rows
from talkweave.session import stage

WINDOW = 13
SHARD_BYTES = 1 << 20

#: A-Z become a-z; all ASCII bytes but letters and digits become spaces.
NORMAL = bytes(
    W.LOWER[b] if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)

FOUND = (
    "n_words bigint,"
    " hits array<struct<first_word:int,n_words:int,start_byte:int,end_byte:int>>, items array<string>"
)
HITS = pa.list_(
    pa.struct([("first_word", pa.int32()), ("n_words", pa.int32()), ("start_byte", pa.int32()), ("end_byte", pa.int32())])
)


def normal_words(text: bytes) -> list[bytes]:
    """The words of a text after normalising."""
    return text.translate(NORMAL).split()


class Passages:
    """One automaton over the windows of all items, read in numbers of words."""

    def __init__(self, items: tuple[tuple[str, str], ...], window: int) -> None:
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in normal_words(text.encode())]
            for i in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(tuple(words[i : i + window]), set()).add(item)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for passage, who in owners.items():
            self.machine.add_word(passage, (len(passage), tuple(sorted(who))))
        if owners:
            self.machine.make_automaton()

    def scan(self, text: bytes) -> tuple[int, list[dict], list[str]]:
        """Words of a text, its maximal runs of hit words with their bytes, and the items found."""
        words = normal_words(text)
        if not words or not len(self.machine):
            return len(words), [], []
        number = self.numbers.get
        found = list(self.machine.iter(tuple([number(w, 0) for w in words])))
        if not found:
            return len(words), [], []
        size = np.array([n for _, (n, _) in found])
        first = np.array([end for end, _ in found]) + 1 - size
        hit = np.concatenate([[False], W.covered(first, size, len(words)), [False]])
        edge = np.flatnonzero(hit[1:] != hit[:-1]).reshape(-1, 2)
        data = np.frombuffer(text.translate(NORMAL), np.uint8)
        place = W.split(data, np.array([0, len(data)]))
        hits = [
            {"first_word": int(a), "n_words": int(b - a), "start_byte": int(place.start[a]), "end_byte": int(place.end[b - 1])}
            for a, b in edge
        ]
        return len(words), hits, sorted({item for _, (_, who) in found for item in who})


@lru_cache(maxsize=2)
def passages(items: tuple[tuple[str, str], ...], window: int) -> Passages:
    """The automaton of ``items`` (id, text), built once in each Python worker."""
    return Passages(items, window)


def _scanner(items: tuple[tuple[str, str], ...], window: int):
    def run(texts: pa.Array) -> list[pa.Array]:
        machine = passages(items, window)
        rows = [machine.scan(text.as_buffer().to_pybytes()) for text in texts]
        counts, hits, found = zip(*rows) if rows else ((), (), ())
        return [pa.array(counts, pa.int64()), pa.array(hits, HITS), pa.array(found, pa.list_(pa.string()))]

    return run


def _shard_count(benchmark: DataFrame, shard_bytes: int) -> int:
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-size // shard_bytes))


def _shard(benchmark: DataFrame, number: int, count: int) -> tuple[tuple[str, str], ...]:
    """The items, (id, text), whose hash falls into shard ``number`` of ``count``."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    group = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    return tuple(sorted(tuple(row) for row in items.filter(group == number).collect()))


def _scan(docs: DataFrame, items: tuple[tuple[str, str], ...], window: int) -> DataFrame:
    return beside_rows(docs, _scanner(items, window), FOUND)


def find_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Per document: key, number of words, runs of hit words with byte offsets, and items found.

    The automaton holds the whole benchmark, if that has no more than ``shard_bytes``
    of text. A larger one is taken in shards by a hash of the item: the driver
    and the tasks hold one at a time, and what it finds is written before the next.
    """
    rows = docs.select("doc_id", "text")
    count = _shard_count(benchmark, shard_bytes)
    if count == 1:
        return _scan(rows, _shard(benchmark, 0, 1), window).drop("row")
    union = None
    for number in range(count):
        part = stage(_scan(rows, _shard(benchmark, number, count), window).drop("row")).withColumn("shard", F.lit(number))
        union = part if union is None else union.unionByName(part)
    # A repeated row has equal hits, so one of each shard is enough; its copies are put back after.
    merged = union.groupBy("key_id", "key_hash").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_set("hits"))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.expr("count(*) DIV count(DISTINCT shard)").alias("copies"),
    )
    return merged.select(
        "key_id",
        "key_hash",
        "n_words",
        merge_runs("hits").alias("hits"),
        "items",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def clean_rows(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """The documents that are not contaminated, with all their columns.

    Against one shard, rows are filtered in the tasks that scan them; several are
    scanned by ``find_hits``, and the rows meet its verdicts by key.
    """
    dirty = contaminated(n_hit(), F.col("n_words"))
    if _shard_count(benchmark, shard_bytes) == 1:
        return _scan(docs, _shard(benchmark, 0, 1), window).filter(~dirty).select("row.*")
    return keep_rows(docs, find_hits(docs, benchmark, window, shard_bytes).filter(~dirty))


def merge_runs(column: str):
    """Sorted runs of words with those that overlap or touch made one."""
    return F.expr(
        f"""aggregate({column}, slice({column}, 1, 0), (runs, x) ->
            if(size(runs) > 0 AND element_at(runs, -1).first_word + element_at(runs, -1).n_words >= x.first_word,
               concat(slice(runs, 1, size(runs) - 1), array(named_struct(
                   'first_word', element_at(runs, -1).first_word,
                   'n_words', greatest(element_at(runs, -1).n_words, x.first_word + x.n_words - element_at(runs, -1).first_word),
                   'start_byte', element_at(runs, -1).start_byte,
                   'end_byte', greatest(element_at(runs, -1).end_byte, x.end_byte)))),
               concat(runs, array(x))))"""
    )


def contaminated(n_hit, n_words):
    """The rule: at least a twentieth of the words is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def n_hit(column: str = "hits"):
    """How many words of a document are hit."""
    return F.expr(f"cast(coalesce(aggregate({column}, 0, (n, x) -> n + x.n_words), 0) AS bigint)")


def items_sha256(items: list[str]) -> str:
    """SHA-256 of the comma-joined items."""
    return hashlib.sha256(",".join(items).encode()).hexdigest()
