from __future__ import annotations

import json
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException

from talkweave.session import clear_scratch, shared_folder, stage
from talkweave.sources import tables


def test_json_lines_bz2(spark, tmp_path):
    path = str(tmp_path / "c.json")
    rows = [("1", "hi", 10, "Texas", 5, "t3_a"), ("2", None, None, None, None, "t3_b")]
    spark.createDataFrame(rows, tables.COMMENTS).write.option("compression", "bzip2").json(path)
    assert list(Path(path).glob("*.bz2"))
    df = tables.read_json(spark, path, tables.COMMENTS)
    assert df.schema == tables.COMMENTS
    assert sorted(map(tuple, df.collect())) == rows


def test_labels_with_bad_values(spark, tmp_path):
    path = tmp_path / "labels.csv"
    path.write_text("Input_id,labeldem,labelgop,labeldjt\na,0,1,-1\nb,,x,1\n")
    rows = sorted(map(tuple, tables.read_labels_csv(spark, str(path)).collect()))
    assert rows == [("a", 0, 1, -1), ("b", None, None, 1)]


def test_each_table_is_staged_once(spark, tmp_path):
    calls = []

    def reader(name):
        def read():
            calls.append(name)
            return spark.range(3)

        return read

    staged = str(tmp_path / "staged")
    tables.ingest(spark, {"a": reader("a")}, staged)
    found = tables.ingest(spark, {"a": reader("a"), "b": reader("b")}, staged)
    assert calls == ["a", "b"]
    assert found["a"].count() == found["b"].count() == 3
    (tmp_path / "staged" / "b.parquet" / "_SUCCESS").unlink()
    tables.ingest(spark, {"a": reader("a"), "b": reader("b")}, staged)
    assert calls == ["a", "b", "b"]


def test_csv_sink(spark, tmp_path):
    path = str(tmp_path / "r.csv")
    df = spark.range(50).selectExpr("cast(id AS string) AS state", "id / 50 AS pos", "0.5D AS neg").repartition(6)
    tables.write_csv(df, path)
    assert len(list(Path(path).glob("part-*"))) == 1
    back = tables.read_rollup(spark, path, "state string, pos double, neg double")
    assert back.exceptAll(df).count() == 0 and back.count() == 50
    with pytest.raises(AnalysisException):
        tables.write_csv(df, path)


def test_sanitize_file(spark, tmp_path):
    path = tmp_path / "x.json"
    path.write_text("\n".join(json.dumps({"body": b, "id": "x"}) for b in ("Good -- bad", "a.b")))
    rows = sorted(map(tuple, tables.sanitize_file(spark, str(path)).collect()))
    assert rows == [("a . b", "a b", "", ""), ("good bad", "good bad", "good_bad", "")]


def test_texts_stay_unless_a_number_is_set(spark):
    narrow = spark.range(100).coalesce(1)
    assert tables.spread(narrow, "id") is narrow
    spark.conf.set(tables.TEXT_PARTITIONS, "5")
    try:
        assert tables.spread(narrow, "id").rdd.getNumPartitions() == 5
    finally:
        spark.conf.unset(tables.TEXT_PARTITIONS)


def test_existence(spark, tmp_path):
    (tmp_path / "_file").write_text("")
    assert tables.exists(spark, str(tmp_path / "_file")) and tables.exists(spark, f"file://{tmp_path}")
    assert not tables.exists(spark, str(tmp_path / "no"))


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(root)
    assert shared_folder(spark) != shared_folder(spark)
    staged = stage(spark.range(5))
    assert staged.count() == 5 and root in staged.inputFiles()[0]


def test_the_warehouse_is_the_other_shared_folder():
    conf = {"spark.sql.warehouse.dir": "hdfs://w/house/"}
    session = SimpleNamespace(conf=SimpleNamespace(get=conf.get), sparkContext=SimpleNamespace(applicationId="app-1"))
    assert shared_folder(session).startswith("hdfs://w/house/talkweave-app-1/")


def test_scratch_is_removed(tmp_path):
    conf = {"spark.checkpoint.dir": f"file://{tmp_path}"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=SimpleNamespace(applicationId="a"))
    clear_scratch(session)
    (tmp_path / "talkweave-a" / "x").mkdir(parents=True)
    clear_scratch(session)
    assert list(tmp_path.iterdir()) == []
