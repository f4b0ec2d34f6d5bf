"""Sources and sinks: JSON lines, CSV, Parquet, JDBC, staged copies, rollup files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkweave.functions.text import sanitize
from talkweave.session import stage

COMMENTS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("created_utc", T.LongType()),
        T.StructField("author_flair_text", T.StringType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("link_id", T.StringType()),
    ]
)

SUBMISSIONS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("score", T.IntegerType()),
    ]
)

LABELS = T.StructType(
    [
        T.StructField("Input_id", T.StringType()),
        T.StructField("labeldem", T.IntegerType()),
        T.StructField("labelgop", T.IntegerType()),
        T.StructField("labeldjt", T.IntegerType()),
    ]
)


UNREADABLE = "__unreadable"


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines, plain or compressed; bz2 files are split across tasks.

    The schema is given, so no job runs to infer one. A line that cannot be
    read gives a row of NULLs.
    """
    return spark.read.schema(schema).json(path)


def read_json_checked(
    spark: SparkSession, path: str, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """JSON lines as ``read_json`` reads them, and apart from them the lines that cannot be read.

    A line is unreadable if it is no JSON object or holds a value of another type
    than the schema's. It does not become a row; it is kept whole as ``line``, with
    the ``file`` that it is in. All lines are read and parsed once, and written.
    """
    wide = T.StructType([*schema.fields, T.StructField(UNREADABLE, T.StringType())])
    rows = spark.read.schema(wide).option("columnNameOfCorruptRecord", UNREADABLE).json(path)
    rows = stage(rows.withColumn("__file", F.input_file_name()))
    good = rows.filter(F.col(UNREADABLE).isNull()).select(*schema.names)
    bad = rows.filter(F.col(UNREADABLE).isNotNull()).select(F.col("__file").alias("file"), F.col(UNREADABLE).alias("line"))
    return good, bad


def read_labels_csv(spark: SparkSession, path: str) -> DataFrame:
    """The label file with its header; a label that is no integer becomes NULL."""
    return spark.read.schema(LABELS).csv(path, header=True)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` in ``folder``."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_jdbc(
    spark: SparkSession, url: str, table: str, split_by: str, low: int, high: int, parts: int,
    **options: str,
) -> DataFrame:
    """A database table, read by ``parts`` tasks over ranges of a numeric column."""
    return spark.read.jdbc(
        url, table, column=split_by, lowerBound=low, upperBound=high, numPartitions=parts,
        properties=options,
    )


TEXT_PARTITIONS = "spark.talkweave.textPartitions"


def spread(df: DataFrame, key: str) -> DataFrame:
    """Repartition by ``key`` into the number that ``spark.talkweave.textPartitions`` sets, if it is set.

    Cleaning text costs far more than reading it, and a file of one row group is
    read by one task. Set the number for such files; without it, as for inputs of
    many row groups, texts stay where they are read.
    """
    parts = df.sparkSession.conf.get(TEXT_PARTITIONS, None)
    return df.repartition(int(parts), key) if parts else df


def exists(spark: SparkSession, path: str) -> bool:
    """True where there is a file or folder ``path``, in any file system that Spark reads."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def _is_complete(spark: SparkSession, path: str) -> bool:
    """True where an earlier write to ``path`` was committed."""
    return exists(spark, f"{path}/_SUCCESS")


def ingest(
    spark: SparkSession, readers: dict[str, Callable[[], DataFrame]], staged: str
) -> dict[str, DataFrame]:
    """Read each table's Parquet copy, first making the copy where there is none.

    ``readers`` maps a table name to a function that reads its raw form. Every
    table is looked at on its own, and a copy left half-written is made again.
    """
    tables = {}
    for name, read_raw in readers.items():
        path = f"{staged.rstrip('/')}/{name}.parquet"
        if not _is_complete(spark, path):
            read_raw().write.mode("overwrite").parquet(path)
        tables[name] = spark.read.parquet(path)
    return tables


def ingest_comments(
    spark: SparkSession, submissions: str, comments: str, labels: str, staged: str
) -> dict[str, DataFrame]:
    """The three raw inputs of the sentiment job, staged as Parquet.

    Lines that cannot be read go to ``unreadable_comments`` and
    ``unreadable_submissions`` beside them, with the file that they are in.
    """
    checked = {}

    def parts(name: str, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
        if name not in checked:
            checked[name] = read_json_checked(spark, path, schema)
        return checked[name]

    return ingest(
        spark,
        {
            "unreadable_submissions": lambda: parts("submissions", submissions, SUBMISSIONS)[1],
            "submissions": lambda: parts("submissions", submissions, SUBMISSIONS)[0],
            "unreadable_comments": lambda: parts("comments", comments, COMMENTS)[1],
            "comments": lambda: parts("comments", comments, COMMENTS)[0],
            "labeled_data": lambda: read_labels_csv(spark, labels),
        },
        staged,
    )


# Strings come back as they were: quotes are doubled, spaces at the ends stay, and
# NULL is written as a string that no title holds, so that it differs from "".
_CSV = {
    "header": True,
    "escape": '"',
    "nullValue": "\x01NULL",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, path: str) -> None:
    """Write one CSV file with a header into the folder ``path``; fails if that exists.

    Meant for rollups, which are small by nature; the rows pass through one task
    one after the other.
    """
    df.repartition(1).write.csv(path, emptyValue='""', **_CSV)


def read_rollup(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read a rollup written by ``write_csv``; titles may hold line ends."""
    return spark.read.schema(schema).csv(path, multiLine=True, emptyValue="", **_CSV)


def sanitize_file(spark: SparkSession, path: str) -> DataFrame:
    """Clean the field ``body`` of every JSON line of a file."""
    bodies = spark.read.schema("body string").json(path)
    return bodies.select(F.inline(F.array(sanitize(F.col("body")))))
