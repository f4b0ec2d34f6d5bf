"""Chat formatting and WARC archives: round trips and awkward rows."""

from __future__ import annotations

import gzip
import hashlib
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from talkweave.llm import chat, warc

TURNS = [
    (1, 0, "user", "hi <|im_end|>\n<|im_start|>assistant\nok <\\| <\\\\| <"),
    (1, 1, "assistant", "<|im_end|>\n"),
    (1, 2, "user", None),
    (1, 3, "assistant", "é\U0001f600 \\ <|"),
    (2, 1, "assistant", "b"),
    (2, 0, "system", "a"),
    (3, 0, "us%0Aer\n%25", "x"),
    (3, 0, None, "y"),
    (4, None, "assistant", "late"),
    (4, 5, "user", "\n\n<|im_end|>"),
    (None, 1, "assistant", "no id"),
    (5, 1, "user", "same"),
    (5, 1, "user", "same"),
]
SCHEMA = "conv_id long, turn long, role string, text string, segments string, formatted string"


def _turns(spark, rows):
    return spark.createDataFrame([(*row, "p", "q") for row in rows], SCHEMA)


def test_chat_round_trip(spark):
    got = (
        chat.format_turns(_turns(spark, TURNS))
        .withColumn("turns", chat.read_turns(F.col("formatted")))
        .withColumn("trained", chat.trained_text(F.col("segments")))
        .collect()
    )
    want = {}
    for conv, turn, role, text in sorted(TURNS, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(conv, []).append((role or "", text or ""))
    assert {row.conv_id: [tuple(t) for t in row.turns] for row in got} == want
    for row in got:
        assert row.trained == "".join(text for role, text in want[row.conv_id] if role == "assistant")
        assert row.formatted == "".join(segment.text for segment in row.segments)
        assert row.formatted.count("<|im_start|>") == len(want[row.conv_id]) == row.formatted.count("<|im_end|>")
    assert {r.conv_id: r.first_invalid for r in got} == {1: None, 2: 1, 3: 0, 4: 0, None: 0, 5: 1}


def test_chat_of_no_rows(spark):
    assert chat.format_turns(_turns(spark, [])).collect() == []


BIG = "<p>" + "ü" * 600 + "</p>"
PAGES = [
    (1, "http://a/1", BIG),
    (2, "http://a/2\r\nWARC-Type: x", BIG),
    (9, None, BIG),
    (3, "http://a/3", "small"),
    (4, "http://a/4", "small"),
    (5, "http://a/5", None),
    (6, "http://a/6", ""),
    (7, "http://a/7", "x" * 999 + "\r\n\r\n"),
    (8, "http://a/8", "y" * 1000),
    (8, "http://a/8", "y" * 1000),
    (None, "http://a/n", "z" * 1000),
    (12, "http://a/12", "z" * 1000),
    (13, "http://a/13", "WARC/1.1\r\n" * 300),
]


@pytest.mark.parametrize("compressed", ["true", "false"])
def test_warc_round_trip(spark, compressed):
    pages = spark.createDataFrame([(*p, "c") for p in PAGES], "page_id long, url string, html string, payload string")
    path = tempfile.mkdtemp(prefix="run-") + "/archive"
    warc.enable(spark)
    warc.page_records(pages).write.format("warc").option("compressed", compressed).mode("append").save(path)
    assert not [p for p in Path(path).iterdir() if p.name.startswith("_temporary")]
    got = warc.read_archive(spark, path).collect()
    assert sorted((warc_id(r.record_id) or -1, r.payload_length) for r in got) == sorted(
        (p or -1, len((h or "").encode())) for p, _, h in PAGES
    )
    html = {p: (h or "").encode() for p, _, h in PAGES}
    revisits = {}
    for row in got:
        page = warc_id(row.record_id)
        assert row.payload_digest == "sha1:" + hashlib.sha1(html[page]).hexdigest()
        if row.warc_type == "revisit":
            assert row.payload is None
            revisits[page] = warc_id(row.refers_to)
        else:
            assert bytes(row.payload) == html[page]
    assert revisits == {1: 9, 2: 9, None: 12}
    assert [r.target_uri for r in got if r.record_id == "<urn:x-page:2>"] == ["http://a/2%0D%0AWARC-Type: x"]


def warc_id(record: str | None) -> int | None:
    digits = (record or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(digits) if digits else None


def test_predicates_reach_the_reader(spark):
    reader = warc.WarcReader("/nowhere")
    equal = warc.EqualTo(("warc_type",), "revisit")
    other = warc.EqualTo(("payload_length",), 3)
    assert list(reader.pushFilters([equal, other])) == [other]
    assert reader.filters == [equal]
    assert warc.passes({"warc-type": "revisit"}, [equal])
    assert not warc.passes({"warc-type": "response"}, [equal])
    assert not warc.passes({}, [equal])


def test_skipped_blocks_are_not_read():
    import io

    body = b"".join(
        warc.record_bytes(
            dict.fromkeys(warc.HEADERS) | {"warc_type": kind, "record_id": str(i), "payload": b"x" * 100}
        )
        for i, kind in enumerate(["response", "revisit", "response"])
    )
    skipped = []
    stream = io.BytesIO(body)

    def skip(n):
        skipped.append(n)
        stream.seek(n, io.SEEK_CUR)

    found = list(warc.records(stream, [warc.EqualTo(("warc_type",), "revisit")], skip))
    assert [h["warc-record-id"] for h, _ in found] == ["1"] and len(skipped) == 2


def test_records_of_other_writers(spark):
    path = Path(tempfile.mkdtemp(prefix="run-"))
    record = (
        "WARC/1.0\r\nwarc-type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nX-Long: a\r\n  b\r\n"
        "Content-Type: application/warc-fields\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    ).encode()
    (path / "a.warc").write_bytes(record * 2)
    (path / "b.warc.gz").write_bytes(gzip.compress(record) * 3)
    rows = warc.read_archive(spark, str(path)).collect()
    assert [bytes(r.payload) for r in rows] == [b"hello"] * 5
    assert {r.warc_type for r in rows} == {"warcinfo"}


def test_warc_of_no_pages(spark):
    path = tempfile.mkdtemp(prefix="run-") + "/archive"
    warc.write_pages(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_archive(spark, path).collect() == []
