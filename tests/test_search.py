from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from talkweave.operators import blockmax, search, skew
from talkweave.plans import searching

DOCUMENTS = {1: "a b c", 2: "a a b", 3: "b, d. The end", 4: "c", 5: "", 6: "A! a? a"}


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(list(DOCUMENTS.items()), "song_id bigint, text string")


@pytest.fixture(scope="module")
def index(documents):
    return search.build_tfidf(documents)


@pytest.fixture(scope="module")
def song(spark):
    rows = [(i, f"song {i}", "x" if i % 2 else "y", f"/{i}") for i in DOCUMENTS if i != 4]
    return spark.createDataFrame(rows, "song_id bigint, song_name string, artist_id string, page_link string")


@pytest.fixture(scope="module")
def artist(spark):
    return spark.createDataFrame([("x", "X")], "artist_id string, artist_name string")


def ask(spark, *queries):
    rows = [(i, text, kind) for i, (text, kind) in enumerate(queries, 1)]
    return spark.createDataFrame(rows, "query_id int, query string, query_type string")


def expected_scores():
    words = {i: Counter(w for w in "".join(ch if ch.isalpha() else " " for ch in t.lower()).split()) for i, t in DOCUMENTS.items()}
    df = Counter(w for counts in words.values() for w in counts)
    return {(i, w): n * math.log(len(words) / df[w]) for i, counts in words.items() for w, n in counts.items()}


def test_index_against_brute_force(index):
    found = {(r["song_id"], r["token"]): r["score"] for r in index.collect()}
    assert found == pytest.approx(expected_scores())


def test_index_is_the_same_with_other_hot_keys(spark, documents, index):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    expected = sorted(map(tuple, index.collect()))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 50)
        assert sorted(map(tuple, search.build_tfidf(documents).collect())) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_texts_are_cleaned_before_the_index_is_joined(documents):
    plan = search.build_tfidf(documents)._jdf.queryExecution().executedPlan().toString()
    assert "regexp" not in plan


def test_query_tokens(spark):
    queries = ask(
        spark, ('Love, "me" do!', "or"), ("don't stop", "or"), ("a\tb", "or"), ("... !!", "or"), ("x x", "or"),
        ("two\nlines\r\n[end]", "or"),
    )
    for escape, stop in ((False, "don't"), (True, "don''t")):
        rows = search.query_tokens(queries, escape).orderBy("query_id", "pos").collect()
        found = [[r["token"] for r in rows if r["query_id"] == i] for i in range(1, 7)]
        assert found == [["Love", "me", "do"], [stop, "stop"], ["a\tb"], [], ["x", "x"], ["two", "lines", "end"]]


def test_or_and_duplicates(spark, index, song, artist):
    queries = ask(
        spark, ("a c", "or"), ("a c", "and"), ("a a", "and"), ("a a", "OR"), ("", "or"), ("b nothing", "and"),
        ("a b", "anything"),
    )
    ranked = search.rank_songs(queries, index).collect()
    found = {}
    for row in ranked:
        found.setdefault(row["query_id"], set()).add(row["song_id"])
    assert found == {1: {1, 2, 4, 6}, 2: {1}, 4: {1, 2, 6}, 7: {1, 2}}
    scores = expected_scores()
    for row in ranked:
        if row["query_id"] == 1:
            parts = [scores.get((row["song_id"], w), 0) for w in "ac"]
            assert row["score"] == pytest.approx(sum(parts), abs=1e-8)
    relaxed = search.rank_songs(queries, index, strict_duplicates=False)
    assert {r["song_id"] for r in relaxed.collect() if r["query_id"] == 3} == {1, 2, 6}
    either = search.search_or(queries, index, song, artist).select("query_id", "song_id")
    both = search.search_and(queries, index, song, artist).select("query_id", "song_id")
    assert both.exceptAll(either).count() == 0


def test_missing_names_are_null(spark, index, song, artist):
    rows = {r["song_id"]: r for r in search.search(ask(spark, ("a c", "or")), index, song, artist).collect()}
    assert rows[4]["song_name"] is None and rows[4]["artist_name"] is None
    assert rows[2]["song_name"] == "song 2" and rows[2]["artist_name"] is None
    assert rows[1]["artist_name"] == "X"
    shown = search.search_page(ask(spark, ("a c", "or")), index, song, artist).drop("rank").collect()
    assert sorted(map(tuple, shown), key=str) == sorted(
        (tuple(r[c] for c in ("query_id", "song_name", "artist_name", "page_link", "song_id", "score")) for r in rows.values()),
        key=str,
    )


def test_pages(spark, tmp_path):
    # 41 results, most with equal scores, and a second query with one result.
    rows = [(1, i, float(i % 3)) for i in range(41)] + [(2, 7, 1.0)]
    results = spark.createDataFrame(rows, "query_id int, song_id bigint, score double").repartition(5)
    best = sorted(rows[:41], key=lambda row: (-row[2], row[1]))
    pages = [search.page(results, n).filter("query_id = 1").orderBy("rank").collect() for n in (1, 2, 3, 4)]
    assert [len(p) for p in pages] == [20, 20, 1, 0]
    assert [r["song_id"] for p in pages for r in p] == [row[1] for row in best]
    assert [r["rank"] for p in pages for r in p] == list(range(1, 42))
    assert search.page(results, 0).collect() == search.page(results, 1).collect()
    assert search.page(results, 1).filter("query_id = 2").count() == 1
    search.materialize(results, str(tmp_path / "results"))
    for n, rows_of_page in enumerate(pages, 1):
        stored = search.stored_page(spark, str(tmp_path / "results"), 1, n)
        assert stored.orderBy("rank").collect() == rows_of_page


def test_counts_and_page_facts(spark):
    results = spark.createDataFrame([(1, i) for i in range(41)] + [(3, i) for i in range(40)], "query_id int, song_id int")
    counts = search.result_count(results, ask(spark, ("a", "or"), ("b", "or"), ("c", "or")))
    facts = {r["query_id"]: tuple(r)[1:] for r in search.page_info(counts, 2).collect()}
    assert facts == {1: (41, 2, 3, True, True), 2: (0, 2, 0, True, False), 3: (40, 2, 2, True, False)}
    requests = spark.createDataFrame(
        [(2, "previous", 1), (2, "next", 3), (2, None, 1), (1, "previous", 1), (7, "new", 1)], "n int, button string, page int"
    )
    turned = requests.withColumn("turned", search.turn_page(F.col("n"), F.col("button")))
    assert turned.filter("turned = page").count() == 5


def test_ranks_of_large_results(spark):
    """Ranks run on across the ranges of a query that fills several of them."""
    rows = [(q, s, float(s * 7 % 11)) for q, n in ((1, 3000), (2, 1), (3, 500)) for s in range(n)]
    results = spark.createDataFrame(rows, "query_id int, song_id bigint, score double").repartition(9)
    found = {(r.query_id, r.song_id): r["rank"] for r in search.add_ranks(results).collect()}
    for q in (1, 2, 3):
        order = sorted((r for r in rows if r[0] == q), key=lambda r: (-r[2], r[1]))
        assert [found[q, r[1]] for r in order] == list(range(1, len(order) + 1))


def test_a_stored_page_reads_its_rows(spark, tmp_path):
    path = str(tmp_path / "results")
    results = spark.range(20_000).select(F.lit(1).alias("query_id"), F.col("id").alias("song_id"), (-F.col("id") / 7).alias("score"))
    search.materialize(results, path)
    page = search.stored_page(spark, path, 1, 500)
    assert [r.song_id for r in page.orderBy("rank").collect()] == list(range(9980, 10_000))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(rank,9980)" in plan and "LessThanOrEqual(rank,10000)" in plan and "Window" not in plan


def test_tokens_are_pushed_into_the_stored_index(spark, documents, tmp_path):
    stored = searching.build_index(spark, documents, str(tmp_path / "index"), 4)
    matched = search.match_tokens(ask(spark, ("a b", "or")), stored)
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(token,a)" in plan and "LessThanOrEqual(token,b)" in plan and "PartitionFilters: [" in plan
    nothing = search.match_tokens(ask(spark, ("...", "or")), stored)
    assert nothing.count() == 0


def test_stored_index_gives_the_same_results(spark, documents, index, song, artist, tmp_path):
    stored = searching.build_index(spark, documents, str(tmp_path / "index"), 4)
    queries = ask(spark, ("a c", "or"), ("a b", "and"), ("end", "and"))
    order = ("query_id", "song_id")
    expected = search.rank_songs(queries, index).orderBy(*order).collect()
    assert search.rank_songs(queries, stored).orderBy(*order).collect() == expected
    answered = searching.answer(spark, queries, str(tmp_path / "index"), song, artist, str(tmp_path / "out"))
    assert answered.select("query_id", "song_id", "score").orderBy(*order).collect() == expected


def test_large_batches_are_not_broadcast(spark, index, monkeypatch):
    queries = ask(spark, ("a c", "or"), ("a b", "and"))
    expected = sorted(map(tuple, search.rank_songs(queries, index).collect()))
    monkeypatch.setattr(skew.broadcast_if_small, "__defaults__", (1,))
    assert sorted(map(tuple, search.rank_songs(queries, index).collect())) == expected


def test_url(spark):
    df = spark.createDataFrame([("/a",), (None,)], "page_link string")
    assert [r["url"] for r in search.with_url(df, "http://h").collect()] == ["http://h/a", None]
    assert search.with_url(df, "x").columns == ["page_link", "url"]


def test_results_do_not_depend_on_partitions(spark, index):
    queries = ask(spark, ("a b c d", "or"))
    one = search.page(search.rank_songs(queries, index.repartition(1)), 1).orderBy("rank").collect()
    many = search.page(search.rank_songs(queries, index.repartition(7, F.col("score"))), 1).orderBy("rank").collect()
    assert one == many


def test_blocks_give_the_first_page_and_are_not_all_read(spark, tmp_path):
    """Against whole sums, ties and full matches included, with most blocks left unread."""
    path = str(tmp_path / "blocks")
    rows = spark.range(6000).select(
        F.col("id").alias("song_id"),
        F.explode(F.array(*(F.struct(F.lit(t).alias("token"), F.pmod(F.xxhash64("id", F.lit(t)), F.lit(1000)).alias("x")) for t in "abcd"))).alias("r"),
    ).select("song_id", "r.token", (F.floor(F.col("r.x") * F.col("r.x") / 7000) / 10).alias("score")).filter("token <> 'd' OR song_id % 50 = 0")
    blockmax.write_blocks(rows, path, 64, 4)
    asked = spark.createDataFrame(
        [(1, "a b", "or"), (2, "a", "or"), (3, "a d", "and"), (4, "a b c", "and"), (5, "a a", "and"), (6, "no", "or"), (7, "c d no", "or"), (8, "a no", "and")],
        "query_id int, query string, query_type string",
    )
    stored = [tuple(r) for r in blockmax.best_songs(spark, asked, path).select("query_id", "rank", "song_id", "score").collect()]
    whole = search.page(search.rank_songs(asked, rows), 1).select("query_id", "rank", "song_id", "score")
    assert sorted(stored) == sorted(tuple(r) for r in whole.collect()) and stored
    blocks = blockmax.needed_blocks(spark, search.wanted_tokens(asked), path)
    read = {r.query_id: (r.n_read, r.n_rows) for r in blockmax.rows_read(blocks).collect()}
    assert read[1][1] == 12_000 and read[1][0] < 4000 and read[2][0] <= 128 and read[3][0] < 600


def test_blocks_are_stored_from_one_reading_of_the_index(spark, tmp_path):
    """The index is computed once; blocks fall by score and are no longer than asked, also where a range ends in a token."""
    path, read = str(tmp_path / "blocks"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for one in batches:
            read.add(one.num_rows)
            yield one

    rows = spark.range(3000).selectExpr("id AS song_id", "explode(array('a', 'b', concat('c', id % 40))) AS token", "pmod(id * 7, 11) / 10D AS score")
    rows = rows.unionByName(spark.sql("SELECT CAST(NULL AS bigint) AS song_id, 'a' AS token, 0.5D AS score"))
    blockmax.write_blocks(rows.mapInArrow(counted, rows.schema), path, 16, 8)
    assert read.value == 9001
    postings = spark.read.parquet(f"{path}/postings")
    assert sorted(map(repr, postings.select("song_id", "token", (F.col("units") / 10**9).alias("score")).collect())) == sorted(map(repr, rows.collect()))
    blocks = {}
    for r in postings.collect():
        blocks.setdefault(r.token, {}).setdefault(r.block, []).append(r.units)
    for held in blocks.values():
        ordered = [held[number] for number in sorted(held)]
        assert max(map(len, ordered)) <= 16
        assert all(min(one) >= max(two) for one, two in zip(ordered, ordered[1:]))
    stored = {(r.token, r.block): (r.top, r.n) for r in spark.read.parquet(f"{path}/blocks").collect()}
    assert stored == {(t, number): (max(u), len(u)) for t, held in blocks.items() for number, u in held.items()}
    assert spark.read.parquet(f"{path}/songs").count() == 9001


def test_blocks_of_an_index_with_songs_twice(spark, tmp_path):
    """A song's rows for a token count together, whose sum may pass the threshold where none of them does."""
    path = str(tmp_path / "blocks")
    rows = spark.range(400).selectExpr("id AS song_id", "explode(array('a', 'b')) AS token", "10D - id / 100D AS score")
    twice = spark.range(300, 310).selectExpr("id AS song_id", "explode(array('a', 'a', 'c')) AS token", "6D AS score")
    blockmax.write_blocks(rows.unionByName(twice), path, 16, 8)
    asked = ask(spark, ("a", "or"), ("a b", "or"), ("a b", "and"), ("a c", "and"), ("a a a", "and"), ("c b a", "and"))
    whole = search.page(search.rank_songs(asked, rows.unionByName(twice)), 1).select("query_id", "rank", "song_id", "score")
    found = blockmax.best_songs(spark, asked, path).select("query_id", "rank", "song_id", "score")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))
    assert found.filter("query_id = 1 AND song_id BETWEEN 300 AND 309").count() == 10


def test_first_blocks_have_enough_rows(spark):
    """Short blocks at a token's start are followed by the next ones; no more are read than asked for."""
    sizes = {"a": [64, 64], "b": [1, 64, 64], "c": [1, 2, 64, 64], "d": [3], "e": [19, 1, 64], "f": [20, 64]}
    rows = [(1, t, 100 * place, n) for t, held in sizes.items() for place, n in enumerate(held)]
    blocks = spark.createDataFrame(rows, "query_id int, token string, block bigint, n bigint")
    found = {r.token: r.opening // 100 for r in blockmax._openings(blocks, 20).collect()}
    assert found == {"a": 0, "b": 1, "c": 2, "d": 0, "e": 1, "f": 0}


@pytest.mark.parametrize("within, parts", [(1000, 256), (30, 3), (1, 2)])
def test_deep_pages_by_counting(spark, monkeypatch, within, parts):
    """Ties of thousands of songs, few results and scores far apart, against ranks of everything."""
    monkeypatch.setattr(search, "WITHIN", within)
    monkeypatch.setattr(search, "PARTS", parts)
    one = spark.range(9000).select(F.lit(1).alias("query_id"), F.col("id").alias("song_id"), (F.col("id") % 3 / 7).alias("score"))
    two = spark.range(700).select(F.lit(2).alias("query_id"), (3 * F.col("id")).alias("song_id"), F.exp(F.col("id") / 60).alias("score"))
    few = spark.range(5).select(F.lit(3).alias("query_id"), F.col("id").alias("song_id"), F.lit(1.0).alias("score"))
    results = one.unionByName(two).unionByName(few)
    ranked = search.add_ranks(results)
    for n in (1, 7, 35, 151, 500):
        got = search.deep_page(results, n)
        want = ranked.filter((F.col("rank") > 20 * (n - 1)) & (F.col("rank") <= 20 * n)).select(*got.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_readers_see_whole_versions(spark, tmp_path):
    path = str(tmp_path / "results")
    old = spark.range(300).select(F.lit(1).alias("query_id"), F.col("id").alias("song_id"), F.col("id").cast("double").alias("score"))
    assert search.materialize(old, path) == 1
    reader = search.published(spark, path)
    before = sorted(map(tuple, search.stored_page(spark, path, 1, 2).collect()))
    new = old.filter("song_id < 50")
    # A version that is written but not named yet is not seen.
    new.write.parquet(f"{path}/2-unfinished")
    assert sorted(map(tuple, search.stored_page(spark, path, 1, 2).collect())) == before
    assert search.materialize(new, path) == 2
    assert reader.count() == 300 and search.published(spark, path).count() == 50
    assert search.published(spark, path, 1).count() == 300


def test_common_words_meet_only_songs_of_the_rarest(spark, monkeypatch):
    """A query for all tokens is not compared with every song that holds its common words."""
    rows = [(i, t, 1.0) for i in range(400) for t in (["the", "of", "rare"] if i in (7, 9) else ["the", "of"])]
    tfidf = spark.createDataFrame(rows, "song_id bigint, token string, score double")
    pairs = []
    found = search._candidates
    monkeypatch.setattr(search, "_candidates", lambda *tables: (pairs.append(found(*tables)), pairs[-1])[1])
    queries = ask(spark, ("the of rare", "and"), ("the rare", "and"), ("the none", "and"))
    ranked = search.rank_songs(queries, tfidf)
    assert sorted(map(tuple, ranked.collect())) == [(1, 7, 3.0), (1, 9, 3.0), (2, 7, 2.0), (2, 9, 2.0)]
    assert pairs[0].count() == 4


def test_rows_and_queries_that_come_twice_count_twice(spark):
    """As by comparing all pairs: matching rows must number the query's tokens."""
    rows = [(1, "a", 1.0), (1, "a", 1.0), (2, "a", 1.0), (2, "b", 2.0), (None, "a", 1.0), (None, "b", 1.0), (3, "b", 1.0)]
    tfidf = spark.createDataFrame(rows, "song_id bigint, token string, score double")
    queries = ask(spark, ("a b", "and"), ("a a", "and"), ("a b", None))
    twice = spark.createDataFrame([(9, "a b", "and")] * 2, "query_id int, query string, query_type string")
    found = {tuple(r) for r in search.rank_songs(queries.unionByName(twice), tfidf).collect()}
    assert found == {
        (1, 1, 2.0), (1, 2, 3.0), (1, None, 2.0), (2, 1, 2.0), (3, 1, 2.0), (3, 2, 3.0), (3, None, 2.0), (9, 3, 2.0)
    }
