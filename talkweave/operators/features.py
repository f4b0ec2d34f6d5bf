"""Vocabulary and bag-of-words features, as models and as plain tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.functions.text import ngrams, term_counts
from talkweave.operators.skew import is_small
from talkweave.session import in_tasks, stage

# The most terms of a fitted vocabulary, as in the estimator that it stands for.
VOCAB_SIZE = 1 << 18

# A filter of terms has so many bits per term, but never more than so many bits in all.
FILTER_BITS, MOST_FILTER_BITS = 16, 1 << 27
# Terms are put together by about so many rows.
GATHERED = 1 << 21
# Terms are counted by stretches of rows with about so many of them, or so many bytes.
COUNTED, COUNTED_BYTES = 1 << 22, 1 << 28
# Tasks hold the weights of the most frequent terms, up to so many bytes.
HELD_BYTES = 32 << 20


def add_ngrams(df: DataFrame, text: str = "body") -> DataFrame:
    """Add the n-grams of a text column as ``n_gram``."""
    return df.withColumn("n_gram", ngrams(F.col(text)))


def fit_vocabulary(df: DataFrame, min_df: int = 10, vocab_size: int = VOCAB_SIZE) -> CountVectorizerModel:
    """Fit the terms found in at least ``min_df`` rows of ``n_gram``, by presence.

    If there are more than ``vocab_size`` of them, those that occur most often are
    kept, repeats within a row included; ties go to the lower MD5 digest of the
    term. The driver receives that many terms, as any fitted vocabulary is held there.
    """
    counts = stage(term_totals(df).filter(F.col("df") >= min_df))
    chosen = most_frequent(counts, "total", "term", vocab_size)
    terms = [row["term"] for row in chosen.orderBy(F.desc("total"), "term").select("term").collect()]
    return CountVectorizerModel.from_vocabulary(terms, "n_gram", "features", binary=True)


def vectorize(model: CountVectorizerModel, df: DataFrame) -> DataFrame:
    """Add ``features``; terms outside the vocabulary are left out."""
    return model.transform(df)


def save_vocabulary(model: CountVectorizerModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_vocabulary(path: str) -> CountVectorizerModel:
    return CountVectorizerModel.load(path)


def vocabulary_rows(spark: SparkSession, path: str) -> DataFrame:
    """A saved vocabulary as rows ``(position, term)``."""
    return spark.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("position", "term"))


def term_rows(df: DataFrame, *keys: str) -> DataFrame:
    """One row per key and distinct n-gram; repeats are removed inside the row."""
    return df.select(*keys, F.explode(F.array_distinct("n_gram")).alias("term"))


def _stretches(function: Callable[[pa.Table], pa.RecordBatch], column: int, most: int, most_bytes: int):
    """``function`` over stretches of rows; one ends after about ``most`` n-grams of ``column``, or ``most_bytes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, size = [], 0, 0
        for one in batches:
            held.append(one)
            count += len(one.column(column).flatten())
            size += one.nbytes
            if count >= most or size >= most_bytes:
                yield function(pa.Table.from_batches(held))
                held, count, size = [], 0, 0
        if count:
            yield function(pa.Table.from_batches(held))

    return run


def _pairs(codes: np.ndarray, place: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of a code and one of ``count`` places once, by code and place. A sort takes far less time than ``np.unique``."""
    pairs = np.sort(codes * max(count, 1) + place)
    return np.divmod(pairs[np.diff(pairs, prepend=-1) > 0], max(count, 1))


def _count(schema: pa.Schema, most: int, most_bytes: int):
    """Rows of n-grams and numbers to one row per stretch of rows and term.

    It has the rows that hold the term, how often it occurs, and the sum of each number over
    those rows. A stretch ends after about ``most`` n-grams or ``most_bytes``.
    """

    def counted(rows: pa.Table) -> pa.RecordBatch:
        grams = rows.column(0).combine_chunks()
        place = pc.list_parent_indices(grams).to_numpy()
        found = grams.flatten().dictionary_encode(null_encoding="encode")
        terms, codes = found.dictionary, found.indices.to_numpy().astype(np.int64)
        total = np.bincount(codes, minlength=len(terms))
        code, row = _pairs(codes, place, len(grams))
        sums = [pc.fill_null(column, 0).to_numpy()[row] for column in rows.columns[1:]]
        held = [np.bincount(code, number, len(terms)).astype(np.int64) for number in sums]
        counts = [np.bincount(code, minlength=len(terms)), total, *held]
        return pa.RecordBatch.from_arrays([terms.cast(schema.field(0).type), *map(pa.array, counts)], schema=schema)

    return _stretches(counted, 0, most, most_bytes)


def counted_terms(df: DataFrame, *numbers: str) -> DataFrame:
    """``term``, ``df``, ``total`` and the sums of whole ``numbers`` over the rows that hold it, by stretches of rows.

    A task counts its rows' terms by their places in a list of them, a stretch at a
    time, and gives one row for each term of a stretch; these rows are still to be added up.
    """
    counts = ("df", "total", *numbers)
    fields = pa.schema([("term", pa.string()), *((name, pa.int64()) for name in counts)])
    rows = df.select("n_gram", *[F.col(name).cast("bigint").alias(name) for name in numbers])
    schema = ", ".join(["term string", *(f"{name} bigint" for name in counts)])
    return in_tasks(rows, _count(fields, COUNTED, COUNTED_BYTES), schema)


def term_totals(df: DataFrame) -> DataFrame:
    """``term``, the rows that hold it (``df``), and how often it occurs (``total``), in one pass."""
    rows = df.select(F.inline(term_counts(F.col("n_gram")))).withColumnRenamed("token", "term")
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))


def _cutoff(rows: DataFrame, column: str, most: int) -> tuple[int, int]:
    """The least bound so that ``most`` rows or more have ``column`` up to it, and how many are below it.

    The range is narrowed by counting a few hundred parts of it at a time, so
    neither a sort nor a row reaches a single task.
    """
    low, high = rows.agg(F.min(column), F.max(column)).first()
    below = 0
    while low < high:
        width = -(-(high - low + 1) // 256)
        part = F.expr(f"({column} - {low}) DIV {width}").alias("part")
        sizes = dict(
            rows.filter(F.col(column).between(low, high)).groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()
        )
        for number in range(256):
            if below + sizes.get(number, 0) >= most:
                break
            below += sizes.get(number, 0)
        low, high = low + number * width, min(high, low + (number + 1) * width - 1)
    return low, below


def most_frequent(counts: DataFrame, count: str, key: str, most: int) -> DataFrame:
    """The ``most`` rows with the highest counts; ties go to the lower MD5 digest of the key.

    ``counts`` is a written table. First the count of the last row wanted is found,
    then among its ties the digest of the last one.
    """
    if counts.count() <= most:
        return counts
    order = F.conv(F.substring(F.md5(F.col(key)), 1, 15), 16, 10).cast("bigint")
    ranked = counts.withColumn("falling", -F.col(count)).withColumn("digest", order)
    bound, below = _cutoff(ranked, "falling", most)
    ties = ranked.filter(F.col("falling") == bound)
    last, _ = _cutoff(ties, "digest", most - below)
    chosen = (F.col("falling") < bound) | ((F.col("falling") == bound) & (F.col("digest") <= last))
    # Digests of 60 bits tie by chance alone; the few rows too many go by their key.
    return ranked.filter(chosen).orderBy("falling", "digest", key).limit(most).drop("falling", "digest")


def vocabulary_table(df: DataFrame, min_df: int = 10) -> DataFrame:
    """The vocabulary as rows ``(term, df)``: all terms found in at least ``min_df`` rows.

    Tasks count their own terms before the shuffle, by stretches of rows, so a term found in
    every document costs one row per stretch. Most terms are rare: adding the counts up
    once more before the shuffle would hold nearly all terms of a task.
    """
    counts = counted_terms(df).select("term", "df").repartition("term").groupBy("term").agg(F.sum("df").alias("df"))
    return counts.filter(F.col("df") >= min_df)


def _term_filter(terms: DataFrame) -> np.ndarray:
    """A Bloom filter of a written column ``term``, as words of 64 bits. Its size is bounded; tasks make its parts."""
    bits = 1 << min(max(terms.count() * FILTER_BITS, 64).bit_length(), MOST_FILTER_BITS.bit_length() - 1)
    hashed = F.xxhash64("term")
    places = F.array(hashed.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(hashed, 32).bitwiseAND(F.lit(bits - 1)))
    words = (
        terms.select(F.explode(places).alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 AS int))")).alias("bits"))
        .toArrow()
    )
    table = np.zeros(bits // 64, np.int64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return table


def _most_frequent_weights(weights: DataFrame, often: str, names: list[str]) -> tuple[pa.Table, DataFrame]:
    """The weights of the terms found most often, of at most ``HELD_BYTES``, and the rows of all others.

    Terms are taken from the highest ``often`` down, by steps of an eighth of an octave; there are
    few such steps, whatever the data. The choice only steers where a term meets its weights.
    """
    step = F.floor(F.log2(F.greatest(F.max(often), F.lit(1))) * 8)
    added = [F.coalesce(F.sum(name), F.lit(0.0)).alias(name) for name in names]
    stepped = stage(weights.filter("term IS NOT NULL").groupBy("term").agg(step.alias("step"), *added))
    size = F.octet_length("term") + 4 + 8 * len(names)
    sizes = stepped.groupBy("step").agg(F.sum(size).alias("bytes")).orderBy(F.desc("step")).collect()
    least, total = None, 0
    for row in sizes:
        total += row["bytes"]
        if row["step"] is None or total > HELD_BYTES:
            break
        least = row["step"]
    held = F.coalesce(F.col("step") >= F.lit(least), F.lit(False))
    return stepped.filter(held).select("term", *names).toArrow(), stepped.filter(~held).select("term", *names)


def _passes(table: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Whether the filter has the bit that the low bits of each digest name."""
    place = digest.astype(np.int64) & (64 * len(table) - 1)
    return (table[place >> 6] >> (place & 63)) & 1 == 1


def _find(known: pa.Array, table: np.ndarray, schema: pa.Schema, most: int, most_bytes: int):
    """Rows of a key, n-grams and their digests to one row per stretch of rows and term.

    It has whether the term is ``known``, and the keys of all rows of the stretch that hold it. Other
    terms are left out unless they pass the filter. A stretch ends after about ``most`` n-grams or ``most_bytes``.
    """

    def found(rows: pa.Table) -> pa.RecordBatch:
        keys, grams = rows.column(0).combine_chunks(), rows.column(1).combine_chunks()
        place = pc.list_parent_indices(grams).to_numpy()
        listed = grams.flatten().dictionary_encode()
        terms, codes = listed.dictionary, pc.fill_null(listed.indices, -1).to_numpy().astype(np.int64)
        digest = np.zeros(len(terms) + 1, np.int64)
        digest[codes] = rows.column(2).combine_chunks().flatten().to_numpy()
        sure = np.append(pc.is_in(terms, value_set=known.cast(terms.type)).to_numpy(zero_copy_only=False), False)
        wanted = sure | (_passes(table, digest) & _passes(table, digest.view(np.uint64) >> np.uint64(32)))
        wanted[-1] = False
        of = wanted[codes]
        code, row = _pairs(codes[of], place[of], len(grams))
        ends = np.cumsum(np.bincount(code, minlength=len(terms))[wanted[:-1]])
        held = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), keys.take(pa.array(row)))
        columns = [terms.filter(pa.array(wanted[:-1])), pa.array(sure[wanted]), held]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return _stretches(found, 1, most, most_bytes)


def feature_rows(df: DataFrame, vocabulary: DataFrame, key: str = "id", often: str | None = None) -> DataFrame:
    """The features as rows ``(key, term)``, one per vocabulary term found.

    Pass a written vocabulary: its size in bytes then decides how it meets the terms. A small one is
    broadcast. Of a larger one, each task holds the terms found most often, by the column ``often``, which
    steers the work alone; its rows' other terms, as far as a filter lets them pass, go to the rest of the
    vocabulary once for each stretch of rows, with the keys of those that hold them.
    """
    plain = vocabulary.select("term")
    if is_small(plain):
        return term_rows(df, key).join(F.broadcast(plain), "term", "left_semi").select(key, "term")
    if often is None:
        known, others = plain.limit(0).toArrow(), plain
    else:
        known, others = _most_frequent_weights(vocabulary, often, [])
    rows = df.select(key, "n_gram", F.transform("n_gram", lambda term: F.xxhash64(term)).alias("digests"))
    schema = f"term string, known boolean, held array<{rows.schema[key].dataType.simpleString()}>"
    fields = df.sparkSession.createDataFrame([], schema).toArrow().schema
    held = known.column("term").combine_chunks()
    found = stage(in_tasks(rows, _find(held, _term_filter(others), fields, COUNTED, COUNTED_BYTES), schema))
    met = found.filter("NOT known").join(others.hint("shuffle_hash"), "term", "left_semi")
    return found.filter("known").unionByName(met).select(F.explode("held").alias(key), "term")


def _gather(known: pa.Table, table: np.ndarray, schema: pa.Schema, most: int):
    """Rows of terms, in order, to one row per row and one per stretch of rows and term.

    A row's keys come with the sums of its ``known`` weights. Its other terms, as far as
    they pass the filter, go with the numbers of all rows of the stretch that hold them. A row
    is in one stretch alone.
    """
    values = known.column("term").combine_chunks()
    weights = [np.append(known.column(name).to_numpy().astype(float), 0.0) for name in known.column_names[1:]]

    def batch(columns: list[pa.Array]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    def gathered(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        number = rows.column("row_number").to_numpy()
        first, place = int(number[0]), number - number[0]
        found = rows.column("term").combine_chunks().dictionary_encode()
        terms, codes = found.dictionary, pc.fill_null(found.indices, -1).to_numpy()
        at = pc.fill_null(pc.index_in(terms, value_set=values), len(values)).to_numpy() if len(values) else np.zeros(len(terms), int)
        weight = np.append(at, len(values))[codes]
        sums = [np.bincount(place, w[weight], int(place[-1]) + 1) for w in weights]
        starts = pc.is_valid(rows.column("keys")).to_numpy()
        keys = rows.column("keys").combine_chunks().filter(pa.array(starts))
        none = [pa.nulls(len(keys), f.type) for f in list(schema)[-2:]]
        yield batch([pa.array(number[starts]), keys, *(pa.array(s[place[starts]]) for s in sums), *none])
        # Of the terms without a known weight, those that the filter lets pass.
        digest = np.zeros(len(terms) + 1, np.int64)
        digest[codes] = rows.column("digest").to_numpy()
        digest = digest[:-1]
        open_terms = (at == len(values)) & _passes(table, digest) & _passes(table, digest.view(np.uint64) >> np.uint64(32))
        if not open_terms.any():
            return
        sent = np.flatnonzero(np.append(open_terms, False)[codes])
        sent = sent[np.argsort(codes[sent], kind="stable")]
        counts = np.bincount(codes[sent], minlength=len(terms))[open_terms]
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(place[sent].astype(np.int32)))
        count = len(counts)
        none = [pa.nulls(count, f.type) for f in list(schema)[1:-2]]
        yield batch([pa.array(np.full(count, first)), *none, terms.filter(pa.array(open_terms)), lists])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for one in batches:
            if not len(one):
                continue
            held.append(one)
            count += len(one)
            number = one.column("row_number").to_numpy()
            # The last row may go on in the next batch; where it began before this one, no stretch can end here.
            whole = int(np.searchsorted(number, number[-1]))
            if count >= most and whole:
                rows = pa.Table.from_batches([*held[:-1], one.slice(0, whole)])
                held, count = [one.slice(whole)], len(one) - whole
                yield from gathered(rows)
        if count:
            yield from gathered(pa.Table.from_batches(held))

    return run


def _sums_of_terms(df: DataFrame, keys: list[str], weights: DataFrame, names: list[str], often: str | None) -> DataFrame:
    """Per row of ``df`` its keys and the sums of its terms' weights, for weights of any size.

    The weights of the terms found most often are held by each task, which adds them up at once.
    A task puts its rows' other terms together: each goes once to its weights, with the
    numbers of all rows of a stretch that hold it, and comes back to that stretch with
    them. Most terms without a weight are left out before, by a filter. No texts move.
    """
    rows = df.withColumn("row_number", F.monotonically_increasing_id())
    terms = rows.select("row_number", F.struct(*keys).alias("keys"), F.posexplode_outer(F.array_distinct("n_gram")).alias("pos", "term"))
    first = F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("keys")).alias("keys")
    wanted = terms.select("row_number", first, "term", F.xxhash64("term").alias("digest"))
    kinds = {f.name: f.dataType.simpleString() for f in wanted.schema.fields}
    known_names = [f"known_{place}" for place in range(len(names))]
    known_kinds = "".join(f"{name} double, " for name in known_names)
    schema = f"row_number bigint, keys {kinds['keys']}, {known_kinds}term string, held array<int>"
    spark = df.sparkSession
    empty = spark.createDataFrame([], schema).toArrow().schema
    if often is None:
        known, others = weights.select("term", *names).limit(0).toArrow(), weights.select("term", *names)
    else:
        known, others = _most_frequent_weights(weights, often, names)
    gathered = stage(in_tasks(wanted, _gather(known, _term_filter(others), empty, GATHERED), schema))
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = (
        gathered.filter("term IS NOT NULL")
        .join(others.hint("shuffle_hash"), "term")
        .select("row_number", "held", *names)
        .repartition(count, "row_number")
    )
    sums = (
        found.select("row_number", F.explode("held").alias("place"), *names)
        .groupBy((F.col("row_number") + F.col("place")).alias("row_number"))
        .agg(*[F.sum(name).alias(name) for name in names])
    )
    whole = gathered.filter("term IS NULL").select("row_number", "keys", *known_names).join(sums, "row_number", "left")
    total = [(F.col(known) + F.coalesce(F.col(name), F.lit(0.0))).alias(name) for known, name in zip(known_names, names)]
    return whole.select("keys.*", *total)


def score_linear(
    df: DataFrame, keys: list[str], weights: DataFrame, intercept: dict, often: str | None = None
) -> DataFrame:
    """Logistic scores as a query: sigmoid of the intercept plus the term weights.

    ``weights`` holds ``term`` and one column per score; ``intercept`` maps those
    columns to numbers or columns; ``often`` may name a column that says how often a term is
    found, which steers the work alone. Pass written weights: their size in bytes
    decides how they are joined. Every row of ``df`` gives one row, also where
    ``keys`` are equal. Where the weights are broadcast, all terms of a row are
    added up in its task, and one row per row crosses the shuffle. Of weights that are
    too large for that, each task holds those of the most frequent terms; the others meet the
    terms of many rows at once.
    """
    plain = weights.select("term", *intercept)
    if is_small(plain):
        rows = df.withColumn("row_number", F.monotonically_increasing_id())
        terms = rows.select("row_number", *keys, F.explode_outer(F.array_distinct("n_gram")).alias("term"))
        sums = (
            terms.join(F.broadcast(plain), "term", "left")
            .groupBy("row_number", *keys)
            .agg(*[F.coalesce(F.sum(name), F.lit(0.0)).alias(name) for name in intercept])
            .drop("row_number")
        )
    else:
        sums = _sums_of_terms(df, keys, weights, list(intercept), often)
    return sums.withColumns(
        {
            name: 1 / (1 + F.exp(-(F.col(name) + F.lit(start))))
            for name, start in intercept.items()
        }
    )
