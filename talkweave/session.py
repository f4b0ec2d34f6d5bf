"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def build_session(app_name: str = "talkweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` adds to them.

    Adaptive execution merges small shuffle partitions, splits skewed ones and
    turns a join into a broadcast join once it has measured a small side.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _scratch(spark: SparkSession) -> str:
    """The folder of this application under ``spark.checkpoint.dir``, else under the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/talkweave-{spark.sparkContext.applicationId}"


def shared_folder(spark: SparkSession) -> str:
    """A new folder name for intermediate tables, in a place that all executors share.

    That is the folder set as ``spark.checkpoint.dir``, or the session's warehouse
    where it is not set.
    """
    return f"{_scratch(spark)}/{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application; call it when its results are written."""
    address = _scratch(spark)
    if address.startswith("file:"):
        address = "/" + address[5:].lstrip("/")
    system, place = fs.FileSystem.from_uri(address)
    if system.get_file_info(place).type == fs.FileType.Directory:
        system.delete_dir(place)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Later steps neither compute it again nor depend on the executors that did.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_SHIPPED: set[str] = set()


def ship_package(context: SparkContext) -> None:
    """Send this package to the executors, once for each application.

    The functions that run in tasks import it; it need not be installed there.
    """
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="run-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)


def in_tasks(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType
) -> DataFrame:
    """``df.mapInArrow`` for a function of this package."""
    ship_package(df.sparkSession.sparkContext)
    return df.mapInArrow(function, schema)
