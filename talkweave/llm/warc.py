"""WARC archives as a data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading plans partitions of whole files, about ``PARTITION_BYTES`` each. Predicates
on the record type and on other header columns are taken over from Spark. A
record's headers are parsed first; where they fail a predicate, its block is
skipped: by a seek in a plain file, by inflating without looking at it in a
``.warc.gz`` file, whose records are gzip members of their own.

Writing makes one file per task under a folder of its own, and moves the files of
the tasks that succeeded into place at the end; lost or repeated tasks leave
nothing behind.

Paths may be of any file system that pyarrow opens by its address.

Defined cases: a missing header is NULL; a missing payload is empty; line ends in
header values are written as %0D and %0A; an archive without records gives no rows.
"""

from __future__ import annotations

import gzip
import io
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from talkweave.session import ship_package, stage

PARTITION_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_REVISIT = 1000

#: Columns and the headers that hold them.
HEADERS = {
    "warc_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "payload_length": "Payload-Length",
}
SCHEMA = ", ".join(f"{name} string" for name in HEADERS if name != "payload_length")
SCHEMA += ", payload_length bigint, payload binary"
ARROW = pa.schema(
    [(n, pa.int64() if n == "payload_length" else pa.string()) for n in HEADERS] + [("payload", pa.binary())]
)


def open_place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


@dataclass
class Files(InputPartition):
    """Whole files that one task reads."""

    paths: tuple[str, ...]


def passes(headers: dict[str, str], filters: list[Filter]) -> bool:
    """True if the headers meet all predicates; a missing header meets none."""
    for test in filters:
        value = headers.get(HEADERS[test.attribute[0]].lower())
        if value is None:
            return False
        if isinstance(test, EqualTo) and value != test.value:
            return False
        if isinstance(test, In) and value not in test.value:
            return False
        if isinstance(test, StringStartsWith) and not value.startswith(test.value):
            return False
    return True


def records(stream, filters: list[Filter], skip) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and blocks of the records that pass; ``skip`` passes over a number of bytes."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a WARC record: {line[:40]!r}")
        headers: dict[str, str] = {}
        name = ""
        while (line := stream.readline().rstrip(b"\r\n")):
            if line[:1] in b" \t" and name:
                headers[name] += " " + line.strip().decode("utf-8", "replace")
                continue
            key, _, value = line.partition(b":")
            name = key.strip().lower().decode("utf-8", "replace")
            headers[name] = value.strip().decode("utf-8", "replace")
        length = int(headers.get("content-length", 0))
        if passes(headers, filters):
            yield headers, stream.read(length)
        else:
            skip(length)


def payload_of(headers: dict[str, str], block: bytes) -> bytes | None:
    """The payload in a block: what follows the HTTP head of a response, none of a revisit."""
    if headers.get("warc-type") == "revisit":
        return None
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


class WarcReader(DataSourceReader):
    """Reads the archives of a folder."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for test in filters:
            plain = isinstance(test, (EqualTo, In, StringStartsWith, IsNotNull)) and len(test.attribute) == 1
            if plain and test.attribute[0] in HEADERS and test.attribute[0] != "payload_length":
                self.filters.append(test)
            else:
                yield test

    def partitions(self) -> list[Files]:
        system, place = open_place(self.path)
        found = system.get_file_info(fs.FileSelector(place, recursive=True))
        found = sorted((f.path, f.size) for f in found if f.path.endswith((".warc", ".warc.gz")))
        groups, size = [[]], 0
        for path, length in (f for f in found if "/_temporary" not in f[0][len(place) :]):
            if groups[-1] and size + length > PARTITION_BYTES:
                groups.append([])
                size = 0
            groups[-1].append(path)
            size += length
        return [Files(tuple(paths)) for paths in groups]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = open_place(self.path)
        rows, size = [], 0
        for path in partition.paths:
            with system.open_input_file(path) as raw:
                if path.endswith(".gz"):
                    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 18)
                else:
                    stream = io.BufferedReader(raw, 1 << 18)
                for headers, block in records(stream, self.filters, lambda n: stream.seek(n, io.SEEK_CUR)):
                    payload = payload_of(headers, block)
                    row = [headers.get(header.lower()) for header in HEADERS.values()]
                    row[-1] = len(payload) if payload is not None else int(row[-1] or 0)
                    rows.append((*row, payload))
                    size += len(block) + 200
                    if size > BATCH_BYTES:
                        yield self._batch(rows)
                        rows, size = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), ARROW)], schema=ARROW)


@dataclass
class Written(WriterCommitMessage):
    """The file that a task has finished."""

    name: str | None


def head_value(value: str) -> str:
    """A header value on one line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(row: dict) -> bytes:
    """One record: version, headers, an empty line, the block, two line ends."""
    payload, revisit = row["payload"] or b"", row["warc_type"] == "revisit"
    block = b"" if revisit else (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    )
    lines = ["WARC/1.1"]
    lines += [f"{header}: {head_value(str(row[c]))}" for c, header in HEADERS.items() if row[c] is not None]
    lines += [f"WARC-Profile: {REVISIT}"] if revisit else ["Content-Type: application/http;msgtype=response"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class WarcWriter(DataSourceArrowWriter):
    """Writes a file per task; the files appear when the whole job has succeeded."""

    def __init__(self, path: str, compressed: bool, overwrite: bool) -> None:
        self.path, self.compressed = path, compressed
        system, place = open_place(path)
        self.job = f"{place}/_temporary-{uuid.uuid4().hex}"
        if overwrite:
            system.delete_dir_contents(place, missing_dir_ok=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, _ = open_place(self.path)
        system.create_dir(self.job, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.compressed
        with system.open_output_stream(f"{self.job}/{name}", compression=None) as out:
            for batch in iterator:
                for row in batch.to_pylist():
                    record = record_bytes(row)
                    if self.compressed:
                        member = zlib.compressobj(1, zlib.DEFLATED, 31)
                        record = member.compress(record) + member.flush()
                    out.write(record)
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        system, place = open_place(self.path)
        system.create_dir(place, recursive=True)
        for message in messages:
            if message is not None:
                system.move(f"{self.job}/{message.name}", f"{place}/{message.name}")
        self._clean(system)

    def abort(self, messages: list[Written | None]) -> None:
        self._clean(open_place(self.path)[0])

    def _clean(self, system: fs.FileSystem) -> None:
        if system.get_file_info(self.job).type == fs.FileType.Directory:
            system.delete_dir(self.job)


class WarcDataSource(DataSource):
    """The format ``warc``; option ``compressed`` (default true) writes ``.warc.gz``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], self.options.get("compressed", "true") != "false", overwrite)


def enable(spark: SparkSession) -> None:
    """Register the format, and let Spark hand predicates to it."""
    ship_package(spark.sparkContext)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def record_id(page_id: Column) -> Column:
    """The record id of a page."""
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def page_id(record: Column) -> Column:
    """The page of a record id."""
    return F.nullif(F.regexp_extract(record, r"^<urn:x-page:(-?\d*)>$", 1), F.lit("")).cast("bigint")


def page_records(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """The WARC record of each page (page_id, url, html).

    Of pages with equal payloads of at least ``least`` bytes, the one of largest
    ``page_id`` is a response and the others revisit it; rows that share that
    ``page_id`` are all responses. A missing ``page_id`` comes before all others.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("bigint"))
    # Written first, so that Spark knows its size before it picks the join.
    copies = stage(
        rows.filter(F.col("size") >= least)
        .groupBy("sha1", "size")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
        .select("sha1", "size", "first")
    )
    again = F.col("first").isNotNull() & F.coalesce(F.col("page_id") < F.col("first"), F.lit(True))
    return rows.join(copies, ["sha1", "size"], "left").select(
        F.when(again, "revisit").otherwise("response").alias("warc_type"),
        record_id(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit("2000-01-01T00:00:00Z").alias("warc_date"),
        F.concat(F.lit("sha1:"), "sha1").alias("payload_digest"),
        F.when(again, record_id(F.col("first"))).alias("refers_to"),
        F.col("size").alias("payload_length"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def write_pages(pages: DataFrame, path: str, least: int = LEAST_REVISIT) -> None:
    """Write pages to new archives under ``path``."""
    enable(pages.sparkSession)
    page_records(pages, least).write.format("warc").mode("append").save(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives under ``path``; filter on header columns to skip payloads."""
    enable(spark)
    return spark.read.format("warc").load(path)
