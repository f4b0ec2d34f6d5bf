"""The manifest, the language model and the phrases on awkward rows, against plain versions."""

from __future__ import annotations

import math
import random
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from talkweave.llm import lattice, merkle, phrases  # noqa: E402

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, idx string, n string, word string, row string"
VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def _text(seed: int, count: int) -> str:
    rng = random.Random(seed)
    ends = [" ", " ", " ", "\t", ", ", ".\n", "\x0b", "; "]
    return "".join(f"Wö{rng.randrange(12)}{rng.choice(ends)}" for _ in range(count))


def _documents() -> list[tuple]:
    rng = random.Random(4)
    rows = []
    for doc in range(150):
        source = rng.choice([None, "", "a", "b", "é", "z"]) if doc % 3 else "hot"
        rows.append((doc, source, rng.choice(["de", "en", None]), doc, _text(doc, rng.randrange(40))))
    rows += [(150, "single", "en", None, "alone"), (151, None, None, None, None), (152, "a", "en", 0, "")]
    rows += [(7, "hot", "en", 3, "one\ntwo"), (7, "hot", "en", 3, "one\ntwo"), (7, "hot", "en", 3, "other\n")]
    rows += [(None, "a", "en", 1, "no number\n"), (None, None, "en", 1, "no number\n"), (153, "b", "en", 9, _text(9, 20_000))]
    rows += [(154, "b", "de", 9, "x" * 20_000 + " 梦é\x00"), (-3, "b", "de", 1, "minus\none"), (155, "a", "en", 1, " \t\n\x0b.,")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return _documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*row, "p", "q", "r", "s") for row in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("levels", [merkle.LEVELS, 2, 1])
def test_manifest(docs, rows, levels):
    """Also with blocks so small that trees need several rounds."""
    got = [tuple(row) for row in merkle.manifest(docs, levels).collect()]
    assert sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[1:])) == brute.manifest(rows)


def test_manifest_of_one_row_and_of_none(spark, docs):
    one = docs.filter("doc_id = 150")
    (row,) = merkle.manifest(one).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified
    assert row.proof_sha256 == brute.sha("")
    assert merkle.manifest(docs.filter("false")).collect() == []


def test_every_kind_of_tampering_is_found(docs, rows):
    checked = {(r.doc_id, r.leaf): r.verified for r in merkle.manifest(docs).collect()}
    for doc, leaf in checked:
        changed = doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0
        texts = [r[4] for r in rows if r[0] == doc]
        assert checked[doc, leaf] == (not changed or not any("\n" in (t or "") for t in texts)) or doc == 7


@pytest.mark.parametrize(
    "least, top, slots, bits", [(30, 2000, 1 << 40, 1 << 27), (2, 7, 1 << 20, 64), (3, 2000, 1, 64), (30, 5, 64, 128)]
)
def test_collocations(docs, rows, least, top, slots, bits):
    """Also with so few slots, or bits, that no window is cut short."""
    got = sorted(tuple(row) for row in phrases.collocations(docs, least, top, slots, bits).collect())
    want = brute.collocations([(row[2], row[4]) for row in rows], least, top)
    assert got == want and want
    assert phrases.collocations(docs.filter("false")).collect() == []


def test_scores_of_phrases_that_pass_64_bits(spark):
    counts = spark.createDataFrame([("en", 10**13)], "lang string, a bigint")
    scaled = (phrases._exact(F.lit(phrases.SCALE)) * phrases._exact(F.col("a"))).cast("decimal(38,0)")
    score = F.call_function("div", scaled, (2 * phrases._exact(F.col("a")) + 1).cast("decimal(38,0)"))
    assert counts.select(score.cast("bigint")).first()[0] == 2_000_000 * 10**13 // (2 * 10**13 + 1)


PIECES = {"▁": 0.1, "a": 0.15, "b": 0.1, "ab": 0.12, "▁a": 0.05, "ba": 0.2, "aba": 0.03, "é": 0.02}


def _tiny() -> tuple[lattice.Lattice, list[float]]:
    byte = [0.001 + b / 1e6 for b in range(256)]
    return lattice.Lattice(tuple(PIECES), np.log(np.array([*PIECES.values(), *byte]))), byte


@pytest.mark.parametrize("word", ["", "a", "abab", "bababa", "éa", "梦b", "zé"])
def test_all_segmentations_count(word):
    model, byte = _tiny()
    ways = brute.segmentations(lattice.MARK + word, PIECES, byte)
    whole = sum(p for p, _ in ways)
    assert math.isclose(model.log_probability(word), math.log(whole), rel_tol=1e-12)
    want = np.zeros(len(PIECES) + 256)
    for p, pieces in ways:
        for piece in pieces:
            places = [len(PIECES) + b for b in piece] if isinstance(piece, bytes) else [list(PIECES).index(piece)]
            for place in places:
                want[place] += 3 * p / whole
    got = np.zeros(len(PIECES) + 256)
    model.expect(word, 3, got)
    assert np.allclose(got, want, rtol=1e-9, atol=1e-12)


def test_probabilities_of_all_texts_add_up():
    """Pieces and end are one distribution: all rows of pieces up to a length and the longer ones make 1."""
    pieces = {"a": 0.3, "▁": 0.4}
    byte = [0.2 / 256] * 256
    model = lattice.Lattice(tuple(pieces), np.log(np.array([*pieces.values(), *byte])))
    end = 0.1
    words = {"": 0.4 + (0.2 / 256) ** 3, "a": (0.4 + (0.2 / 256) ** 3) * (0.3 + 0.2 / 256)}
    for word, p in words.items():
        assert math.isclose(model.log_probability(word), math.log(p), rel_tol=1e-12)
    assert math.isclose(sum(pieces.values()) + sum(byte) + end, 1)


@pytest.mark.parametrize("frequent", [lattice.FREQUENT, 0.02, 1.0])
def test_scores(docs, rows, frequent):
    """Counts, base scores and lattice scores, whichever words are scored where they are read."""
    held = {r[0]: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows}
    tokens = [(r[0], [*brute.WORD.findall((r[4] or "").translate(brute.LOWER)), None]) for r in rows]
    counts: dict = {}
    for doc, own in tokens:
        for word in own if not held[doc] else ():
            counts[word] = counts.get(word, 0) + 1
    total = sum(counts.values())
    pieces, logs = lattice.vocabulary(VOCABULARY)
    first = lattice.Lattice(pieces, logs)
    expected = np.full(len(logs) + 1, lattice.SMOOTHING)
    for word, n in counts.items():
        if word is None:
            expected[-1] += n
        else:
            first.expect(word, n, expected)
    logs = np.log(expected / expected.sum())
    model = lattice.Lattice(pieces, logs[:-1])
    log10 = {w: (logs[-1] if w is None else model.log_probability(w)) / math.log(10) for _, own in tokens for w in own}
    below = math.log10(total + 0.1 * (len(counts) + 1))
    want = sorted(
        (doc is None, doc or 0, held[doc], len(own), sum(w in counts for w in own), total,
         sum(math.log10(counts.get(w, 0) + 0.1) - below for w in own), sum(log10[w] for w in own))
        for doc, own in tokens
    )
    got = sorted((r.doc_id is None, r.doc_id or 0, *r[1:]) for r in lattice.score(docs, VOCABULARY, frequent=frequent).collect())
    assert [r[:6] for r in got] == [r[:6] for r in want]
    for mine, other in zip(got, want):
        assert math.isclose(mine[6], other[6], rel_tol=1e-9) and math.isclose(mine[7], other[7], rel_tol=1e-5)


def test_scores_of_no_rows(docs):
    assert lattice.score(docs.filter("false"), VOCABULARY).collect() == []


def test_held_out_texts_fit_better_than_under_the_first_weights(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sums = [
        lattice.score(docs, VOCABULARY, rounds).filter("held_out").agg(F.sum("score"), F.count("*")).first() for rounds in (1, 2)
    ]
    pieces, logs = lattice.vocabulary(VOCABULARY)
    first = lattice.Lattice(pieces, logs)
    start = 0.0
    for row in docs.collect():
        if zlib.crc32(str(row.doc_id).encode()) % 10 == 0:
            words = brute.WORD.findall((row.text or "").translate(brute.LOWER))
            start += sum(first.log_probability(w) for w in words) / math.log(10)
    assert sums[0][1] > 5 and start < sums[0][0] < sums[1][0] < 0
