"""The pipeline on awkward documents, stage by stage against plain versions."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key_id string, __gone string"
LAST = (1 << 63) - 1
ITEMS = [(1, " ".join(f"bench{i}" for i in range(30))), (2, "too short"), (3, None)]


def _text(seed: int, count: int) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(count))


def _documents() -> list[tuple[int | None, str | None]]:
    base, line = _text(1, 300), "one line that several documents hold"
    near = base.split(" ")
    near[150] = "changed"
    return [
        (4, base),
        (3, " ".join(near)),
        (9, base),
        (10, _text(2, 100) + "\n" + line + "\n" + _text(3, 30)),
        (11, line.upper() + "\n" + _text(4, 100) + "\n\n  " + line),
        (12, _text(5, 60) + "\n" + ITEMS[0][1]),
        (13, _text(6, 700) + " " + ITEMS[0][1]),
        (14, "a b c d e f g h " * 20),
        (15, "few words"),
        (16, None),
        (17, ""),
        (None, _text(7, 80)),
        (18, _text(8, 80)),
        (18, _text(8, 80)),
        (18, _text(9, 80)),
        (19, _text(10, 6000)),
        (20, line + "\n" + _text(2, 100)),
    ]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows = [(i, t, None, f"s{(i or 0) % 2}", len(t or ""), "x", "y") for i, t in _documents()]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/empty/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/empty/benchmark.parquet")
    return str(path)


def _rows(df) -> list[tuple[int, str | None]]:
    return sorted(
        ((LAST if r.doc_id is None else r.doc_id, r.text) for r in df.collect()), key=lambda r: (r[0], r[1] or "")
    )


def _in_order(rows) -> list[tuple[int, str | None]]:
    return sorted(rows, key=lambda r: (r[0], r[1] or ""))


def test_stages_against_plain_versions(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    plain = [(LAST if i is None else i, t) for i, t in _documents()]
    steps = iter(corpus_pipeline.STAGES)

    def following(docs):
        name, apply = next(steps)
        path = str(tmp_path / name)
        apply(spark, docs, folder).write.parquet(path)
        return spark.read.parquet(path)

    columns = docs.columns
    docs, plain = following(docs), [row for row in plain if not brute.base_failed(row[1])]
    assert _rows(docs) == _in_order(plain) and docs.columns == columns

    docs, plain = following(docs), brute.without_lines(plain)
    assert _rows(docs) == _in_order(plain) and docs.columns == columns
    assert docs.filter(F.length("text") != F.col("n_chars")).count() == 0

    docs = following(docs)
    groups = {}
    for (doc, text), (_, _, group) in zip(plain, _groups(plain)):
        groups.setdefault(group, set()).add((doc, text))
    got = _rows(docs)
    assert docs.columns == columns and len(got) == len(groups)
    for members in groups.values():
        stay = [row for row in got if row in members]
        assert len(stay) == 1 and stay[0][0] == min(doc for doc, _ in members)

    docs, plain = following(docs), [row for row in got if not brute.contaminated(row[1], [t for _, t in ITEMS])]
    assert _rows(docs) == plain and docs.columns == columns

    pieces = following(docs)
    assert {LAST if r.doc_id is None else r.doc_id for r in pieces.collect()} == {doc for doc, _ in plain}
    assert pieces.filter("offset + length > 2048").count() == 0
    assert pieces.count() > len(plain)


def _groups(plain):
    """Rows in the given order with the group of each, also where ids repeat."""
    numbered = brute.near_groups([(i, text) for i, (_, text) in enumerate(plain)])
    return [(plain[i][0], print_, group) for i, print_, group in numbered]


def test_run_equals_its_stages_and_takes_no_rows(spark, folder):
    packed = corpus_pipeline.run(spark, folder)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert {r.doc_id for r in packed.collect()} == {3, 9, 10, 11, 13, 18, 19, None}
    assert corpus_pipeline.run(spark, f"{folder}/empty").collect() == []
