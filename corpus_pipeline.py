"""From documents to packed sequences: five stages, each written before the next reads it.

Every stage takes the session, the documents that the stage before it kept, and the
folder of tables; all but the last return the columns of ``documents``. Stages key
rows by ``doc_id`` and text, so a missing or repeated ``doc_id`` does no harm;
missing texts count as empty, further columns are carried along, and an empty
table passes through every stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.llm import decontaminate, line_dedup, packing, quality, simhash
from talkweave.llm.rows import keep_rows, one_of_each
from talkweave.session import stage
from talkweave.sources.tables import read_table

#: SQL has no tokenizer and no fingerprints; tests check the stages against plain versions.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not rejected by a softer rule and their host."""
    return quality.kept_rows(docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of an earlier document; ``n_chars`` follows the text."""
    return line_dedup.without_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least ``doc_id`` of each group of linked fingerprints, once."""
    groups = simhash.near_duplicates(docs)
    least = groups.groupBy("root").agg(F.min(F.struct("key_id", "key_hash")).alias("one")).select("one.*")
    return one_of_each(keep_rows(docs, least))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    return decontaminate.clean_rows(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in sequences of 2,048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_lines),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for _, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
