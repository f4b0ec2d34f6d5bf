"""The same results as ``queries``, as SQL for the checking database.

The text steps are written another way than in the library: words are split and
trimmed one by one, and n-grams come from neighbouring rows.
"""

from __future__ import annotations

from talkweave.functions.states import STATES, UNCHARTED_REGIONS
from talkweave.functions.text import ALPHANUMERIC, URL_PATTERN, WHITESPACE
from talkweave.operators.features import VOCAB_SIZE
from talkweave.plans import planted

_MARKS = "[,.!?;:]"


def _list(names: tuple[str, ...]) -> str:
    return ", ".join(f"'{name}'" for name in names)


def _normalize(text: str) -> str:
    return f"replace(replace(replace(replace({text}, chr(10), ' '), chr(9), ' '), '[', ''), ']', '')"


def _strip_urls(text: str) -> str:
    return f"regexp_replace({text}, '{URL_PATTERN}', '', 'g')"


def _isolate(text: str) -> str:
    return f"regexp_replace({text}, '{_MARKS}', ' \\0 ', 'g')"


def _trimmed(part: str) -> str:
    edges = f"'^[^{ALPHANUMERIC}]+|[^{ALPHANUMERIC}]+$'"
    return f"CASE WHEN regexp_full_match({part}, '{_MARKS}') THEN {part} ELSE regexp_replace({part}, {edges}, '', 'g') END"


def _tokens(text: str) -> str:
    clean = _isolate(_strip_urls(_normalize(f"coalesce({text}, '')")))
    parts = f"string_split_regex({clean}, '[{WHITESPACE}]+')"
    return f"list_filter(list_transform({parts}, lambda p: {_trimmed('p')}), lambda t: t <> '')"


def _query_tokens(text: str) -> str:
    punctuation = "[!-/:-@\\[-`{-~]"
    edges = f"'^{punctuation}+|{punctuation}+$'"
    parts = f"string_split_regex({text}, '[ \\n\\r]+')"
    return f"list_filter(list_transform({parts}, lambda p: regexp_replace(p, {edges}, '', 'g')), lambda t: t <> '')"


def _grams(source: str, key: str) -> str:
    """Rows (key, pos, n, term) of all n-grams of the token lists in ``source``."""
    return f"""
      SELECT {key}, pos, unnest([1, 2, 3]) AS n,
             unnest([w, w || '_' || w2, w || '_' || w2 || '_' || w3]) AS term
      FROM (SELECT {key}, pos, w, lead(w) OVER z AS w2, lead(w, 2) OVER z AS w3
            FROM (SELECT {key}, pos, CASE WHEN regexp_full_match(t, '{_MARKS}') THEN NULL ELSE t END AS w
                  FROM (SELECT {key}, unnest(toks) AS t, generate_subscripts(toks, 1) AS pos FROM {source}))
            WINDOW z AS (PARTITION BY {key} ORDER BY pos))"""


# Named sub-queries: what each is made of, and its text.
_PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "texts": ((), f"SELECT doc_id, text FROM documents UNION ALL SELECT doc_id, text FROM {planted.TEXTS}"),
    "text_tokens": (("texts",), f"SELECT doc_id, list_transform({_tokens('text')}, lambda t: lower(t)) AS toks FROM texts"),
    "text_grams": (("text_tokens",), _grams("text_tokens", "doc_id")),
    "text_words": (
        ("text_grams",),
        "SELECT doc_id, n, string_agg(term, ' ' ORDER BY pos) AS words FROM text_grams"
        " WHERE term IS NOT NULL GROUP BY doc_id, n",
    ),
    "comments": (
        (),
        """SELECT cast(d.doc_id AS varchar) AS id, d.text AS body,
             cast(floor(epoch(e.ts)) AS bigint) AS created_utc, n.n_name AS author_flair_text,
             cast(floor(e.value) AS int) AS score, concat('t3_', cast(d.doc_id % 120 AS varchar)) AS link_id
           FROM documents d JOIN events e ON e.event_id = d.doc_id
           LEFT JOIN customer c ON c.c_custkey = e.user_id
           LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    ),
    "all_comments": (
        ("comments",),
        f"""SELECT id, body, created_utc, author_flair_text, score, link_id FROM comments UNION ALL
            SELECT id, body, created_utc, author_flair_text, score, link_id FROM {planted.COMMENTS}""",
    ),
    "bodies": ((), "SELECT cast(doc_id AS varchar) AS id, text AS body FROM documents"),
    "all_bodies": (("bodies",), f"SELECT id, body FROM bodies UNION ALL SELECT id, body FROM {planted.COMMENTS}"),
    "kept_bodies": (
        ("all_bodies",),
        "SELECT id FROM all_bodies WHERE NOT contains(body, '/s') AND NOT starts_with(body, '&gt;')",
    ),
    "prepared": (
        ("all_comments",),
        """SELECT id, body, created_utc, author_flair_text AS state, score AS com_score,
             substr(link_id, 4) AS link_id FROM all_comments""",
    ),
    "kept": (
        ("prepared",),
        "SELECT * FROM prepared WHERE NOT contains(body, '/s') AND NOT starts_with(body, '&gt;')",
    ),
    "submissions": (
        (),
        """SELECT cast(conv_id AS varchar) AS link_id, text AS title,
             cast(length(text) AS int) AS sub_score FROM conversations WHERE turn = 0""",
    ),
    "labeled": (
        (),
        """SELECT cast(doc_id AS varchar) AS Input_id, toxic AS labeldem, quality AS labelgop,
             CASE WHEN toxic = 1 THEN -1 WHEN quality = 1 THEN 1 ELSE 0 END AS labeldjt FROM labels""",
    ),
    "marked": (
        ("bodies", "labeled"),
        """SELECT Input_id, body, CASE WHEN labeldjt = 1 THEN 1 ELSE 0 END AS pos_label,
             CASE WHEN labeldjt = -1 THEN 1 ELSE 0 END AS neg_label
           FROM bodies JOIN labeled ON id = Input_id""",
    ),
    "marked_tokens": (("marked",), f"SELECT Input_id, list_transform({_tokens('body')}, lambda t: lower(t)) AS toks FROM marked"),
    "marked_terms": (
        ("marked_tokens",),
        f"SELECT DISTINCT Input_id, term FROM ({_grams('marked_tokens', 'Input_id')}) WHERE term IS NOT NULL",
    ),
    "marked_totals": (
        ("marked_tokens",),
        f"""SELECT term, count(*) AS total, count(DISTINCT Input_id) AS df,
              cast('0x' || substr(md5(term), 1, 15) AS bigint) AS tie
            FROM ({_grams('marked_tokens', 'Input_id')}) WHERE term IS NOT NULL GROUP BY term
            HAVING count(DISTINCT Input_id) >= 10""",
    ),
    "vocabulary": (
        ("marked_totals",),
        f"SELECT term, df FROM marked_totals ORDER BY total DESC, tie, term LIMIT {VOCAB_SIZE}",
    ),
    "prior": (
        ("marked",),
        """SELECT ln((sum(pos_label) + 1) / (count(*) - sum(pos_label) + 1)) AS pos,
             ln((sum(neg_label) + 1) / (count(*) - sum(neg_label) + 1)) AS neg FROM marked""",
    ),
    "weights": (
        ("marked", "marked_terms", "prior"),
        """SELECT term, 0.05 * (ln((n_pos + 1) / (n - n_pos + 1)) - (SELECT pos FROM prior)) AS pos,
             0.05 * (ln((n_neg + 1) / (n - n_neg + 1)) - (SELECT neg FROM prior)) AS neg
            FROM (SELECT term, count(*) AS n, sum(pos_label) AS n_pos, sum(neg_label) AS n_neg
                  FROM marked_terms JOIN marked USING (Input_id) GROUP BY term HAVING count(*) >= 10)""",
    ),
    "comment_tokens": (
        ("all_bodies",),
        f"SELECT id, list_transform({_tokens('body')}, lambda t: lower(t)) AS toks FROM all_bodies",
    ),
    "comment_terms": (
        ("comment_tokens",),
        f"SELECT DISTINCT id, term FROM ({_grams('comment_tokens', 'id')}) WHERE term IS NOT NULL",
    ),
    "chances": (
        ("kept", "comment_terms", "weights", "prior"),
        """SELECT id, link_id, created_utc, state, com_score,
             1 / (1 + exp(-((SELECT pos FROM prior) + coalesce(pos, 0)))) AS pos,
             1 / (1 + exp(-((SELECT neg FROM prior) + coalesce(neg, 0)))) AS neg
           FROM kept LEFT JOIN (SELECT id, sum(pos) AS pos, sum(neg) AS neg
                                FROM comment_terms JOIN weights USING (term) GROUP BY id) USING (id)""",
    ),
    "scored": (
        ("chances", "submissions"),
        """SELECT id, link_id, created_utc, state, com_score, title, sub_score,
             CASE WHEN pos <= 0.2 THEN 0 ELSE 1 END AS pos_prob,
             CASE WHEN neg <= 0.25 THEN 0 ELSE 1 END AS neg_prob
           FROM chances JOIN submissions USING (link_id)""",
    ),
    "by_state": (
        ("scored",),
        f"""SELECT state, sum(pos_prob) / count(pos_prob) AS pos, sum(neg_prob) / count(neg_prob) AS neg
            FROM scored WHERE state IN ({_list(STATES + planted.TEST_STATES)}) GROUP BY state""",
    ),
    "by_post": (
        ("scored",),
        """SELECT link_id, title, sum(pos_prob) / count(pos_prob) AS pos,
             sum(neg_prob) / count(neg_prob) AS neg FROM scored GROUP BY link_id, title""",
    ),
    "differences": (("by_state",), "SELECT *, pos - neg AS difference FROM by_state"),
    "song": (
        (),
        """SELECT doc_id AS song_id, concat('doc ', cast(doc_id AS varchar)) AS song_name, source AS artist_id,
             concat('/', lang, '/', cast(doc_id AS varchar)) AS page_link FROM documents""",
    ),
    "artist": (
        (),
        "SELECT DISTINCT source AS artist_id, upper(source) AS artist_name FROM documents WHERE source <> 'src0'",
    ),
    "word_rows": (
        (),
        f"SELECT doc_id AS song_id, lower(unnest({_tokens('text')})) AS token FROM documents",
    ),
    "tf": (
        ("word_rows",),
        f"""SELECT song_id, token, count(*) AS tf FROM word_rows
            WHERE NOT regexp_full_match(token, '{_MARKS}') GROUP BY song_id, token""",
    ),
    "tfidf": (
        ("tf",),
        """SELECT song_id, token, tf * ln((SELECT count(*) FROM documents) / df) AS score
           FROM tf JOIN (SELECT token, count(*) AS df FROM tf GROUP BY token) USING (token)""",
    ),
    "asked": ((), f"SELECT query_id, query, query_type FROM {planted.QUERIES}"),
    "wanted": (
        ("asked",),
        f"""SELECT query_id, lower(query_type) = 'or' AS any_token, toks, len(toks) AS n_tokens
            FROM (SELECT *, {_query_tokens('query')} AS toks FROM asked)""",
    ),
    "wanted_tokens": (
        ("wanted",),
        "SELECT DISTINCT query_id, any_token, n_tokens, unnest(toks) AS token FROM wanted",
    ),
    "matched": (("wanted_tokens", "tfidf"), "SELECT * FROM wanted_tokens JOIN tfidf USING (token)"),
    "ranked": (
        ("matched",),
        """SELECT query_id, song_id, sum(cast(round(score * 1000000000) AS bigint)) / 1000000000 AS score
           FROM matched GROUP BY query_id, any_token, n_tokens, song_id
           HAVING any_token OR count(*) = n_tokens""",
    ),
    "ranked_plain": (
        ("matched",),
        """SELECT query_id, song_id, sum(score) AS score FROM matched
           GROUP BY query_id, any_token, n_tokens, song_id HAVING any_token OR count(*) = n_tokens""",
    ),
    "ranked_or": (
        ("matched",),
        """SELECT query_id, song_id, sum(score) AS score
           FROM matched GROUP BY query_id, song_id""",
    ),
    "ranked_and": (
        ("matched",),
        """SELECT query_id, song_id, sum(score) AS score
           FROM matched GROUP BY query_id, n_tokens, song_id HAVING count(*) = n_tokens""",
    ),
    "ranked_and_distinct": (
        ("matched", "wanted"),
        """SELECT query_id, song_id, sum(score) AS score
           FROM matched JOIN (SELECT query_id, toks FROM wanted) USING (query_id)
           GROUP BY query_id, toks, song_id HAVING count(*) = len(list_distinct(toks))""",
    ),
    "numbered": (
        ("ranked",),
        """SELECT *, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, song_id) AS int) AS rank
           FROM ranked""",
    ),
    "result_counts": (
        ("asked", "ranked"),
        """SELECT query_id, count(song_id) AS n_row FROM asked LEFT JOIN ranked USING (query_id)
           GROUP BY query_id""",
    ),
}


def _with(main: str, *needed: str) -> str:
    """``main`` with the sub-queries it needs in front, each after its own needs."""
    order: list[str] = []

    def add(name: str) -> None:
        for part in _PARTS[name][0]:
            add(part)
        if name not in order:
            order.append(name)

    for name in needed:
        add(name)
    parts = ",\n".join(f"{name} AS ({_PARTS[name][1]})" for name in order)
    return f"WITH {parts}\n{main}" if parts else main


def _shares(keys: str) -> str:
    return _with(
        f"""SELECT {keys}, sum(pos_prob) / count(pos_prob) AS pos, sum(neg_prob) / count(neg_prob) AS neg
            FROM scored GROUP BY {keys}""",
        "scored",
    )


def _text(expression: str) -> str:
    return _with(f"SELECT doc_id, {expression} AS result FROM texts", "texts")


def _words(n: int) -> str:
    return _with(
        f"""SELECT doc_id, coalesce(words, '') AS result FROM texts
            LEFT JOIN (SELECT doc_id, words FROM text_words WHERE n = {n}) USING (doc_id)""",
        "texts", "text_words",
    )


def _found(ranked: str) -> str:
    return _with(
        f"""SELECT query_id, song_name, artist_name, page_link, song_id, round(score, 6) AS score
            FROM {ranked} LEFT JOIN song USING (song_id) LEFT JOIN artist USING (artist_id)""",
        ranked, "song", "artist",
    )


_DAY = "strftime(to_timestamp(created_utc) AT TIME ZONE 'UTC', '%Y-%m-%d')"


def _part(seed: str) -> str:
    bucket = f"cast('0x' || substr(md5('{seed}' || Input_id), 1, 8) AS bigint) % 100"
    return f"SELECT Input_id, '{seed}' AS kind, CASE WHEN {bucket} < 50 THEN 'train' ELSE 'test' END AS part FROM labeled"


def _halves(main: str) -> str:
    """``main`` over the rows that each classifier is fitted on, with their folds."""

    def part(kind: str) -> str:
        return f"""SELECT '{kind}' AS kind, {kind}_label AS is_positive,
              cast(cast('0x' || substr(md5('fold {kind}' || Input_id), 1, 8) AS bigint) % 5 AS int) AS fold
            FROM marked WHERE cast('0x' || substr(md5('{kind}' || Input_id), 1, 8) AS bigint) % 100 < 50"""

    return _with(f"{main.replace('FROM halves', f'FROM ({part("pos")} UNION ALL {part("neg")})')}", "marked")


ORACLE: dict[str, str] = {
    "s3_read_table": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "s1_read_json": _with("SELECT * FROM all_comments", "all_comments"),
    "s1_read_json_checked": _with("SELECT * FROM all_comments", "all_comments"),
    "s1_unreadable_lines": _with(
        f"SELECT line, 1::bigint AS n_lines, (SELECT count(*) FROM all_comments) AS n_rows FROM {planted.BAD_LINES}",
        "all_comments",
    ),
    "s2_read_labels_csv": _with(f"SELECT * FROM labeled UNION ALL SELECT * FROM {planted.LABELS}", "labeled"),
    "s4_ingest": _with("SELECT link_id AS id, title, sub_score AS score FROM submissions", "submissions"),
    "s5_s10_csv_round_trip": _with(
        f"""SELECT link_id, title, length(title) / 7 AS pos
            FROM (SELECT link_id, title FROM submissions UNION ALL SELECT link_id, title FROM {planted.TITLES})""",
        "submissions",
    ),
    "s6_stored_vocabulary": _with("SELECT term FROM vocabulary", "vocabulary"),
    "s8_sanitize_file": _with(
        f"""SELECT lower(array_to_string({_tokens('text')}, ' ')) AS parsed_text, coalesce(u.words, '') AS unigrams,
              coalesce(b.words, '') AS bigrams, coalesce(t.words, '') AS trigrams
            FROM texts LEFT JOIN (SELECT * FROM text_words WHERE n = 1) u USING (doc_id)
            LEFT JOIN (SELECT * FROM text_words WHERE n = 2) b USING (doc_id)
            LEFT JOIN (SELECT * FROM text_words WHERE n = 3) t USING (doc_id)""",
        "texts", "text_words",
    ),
    "s9_read_songs": _with("SELECT * FROM song", "song"),
    "s9_read_artists": _with("SELECT * FROM artist", "artist"),
    "s9_read_index": _with("SELECT song_id, token, round(score, 6) AS score FROM tfidf", "tfidf"),
    "t6_turn_page": """SELECT conv_id, turn, greatest(1, CASE role WHEN 'user' THEN turn + 1
        WHEN 'assistant' THEN turn - 1 ELSE 1 END) AS n_page FROM conversations""",
    "t4_stored_third_page": _with(
        """SELECT query_id, song_id, round(score, 6) AS score, cast(rank AS bigint) AS rank FROM numbered
           WHERE rank BETWEEN 41 AND 60""",
        "numbered",
    ),
    "q4_stored_results": _with(
        "SELECT query_id, song_id, round(score, 6) AS score, cast(rank AS bigint) AS rank FROM numbered", "numbered"
    ),
    "p1_prepare_comments": _with("SELECT * FROM prepared", "prepared"),
    "p1_prepare_submissions": _with("SELECT * FROM submissions", "submissions"),
    "p3_drop_sarcasm": _with("SELECT id, body FROM all_bodies WHERE position('/s' IN body) = 0", "all_bodies"),
    "p4_drop_quotes": _with("SELECT id, body FROM all_bodies WHERE substr(body, 1, 4) <> '&gt;'", "all_bodies"),
    "p5_filter_states": _with(
        f"SELECT id, state FROM prepared WHERE state IN ({_list(STATES + planted.TEST_STATES)})", "prepared"
    ),
    "p6_match_tokens": _with("SELECT query_id, song_id, token, round(score, 6) AS score FROM matched", "matched"),
    "p7_drop_dates": _with(
        f"SELECT DISTINCT {_DAY} AS date FROM all_comments WHERE created_utc IS NULL OR {_DAY} <> '2018-12-31'",
        "all_comments",
    ),
    "p8_exclude_regions": (
        "SELECT n_name AS name FROM nation"
        f" WHERE n_name NOT IN ({_list(UNCHARTED_REGIONS + planted.TEST_UNCHARTED)})"
    ),
    "p9_strip_kind": _with("SELECT id, substr(link_id, 4) AS link_id FROM all_comments", "all_comments"),
    "p10_with_url": _with(
        "SELECT song_id, page_link, 'http://songs.example' || page_link AS url FROM song", "song"
    ),
    "p12_to_chart": _with(
        """SELECT sub_score AS submission_score, sum(pos_prob) / count(pos_prob) AS Positive,
             sum(neg_prob) / count(neg_prob) AS Negative FROM scored GROUP BY sub_score""",
        "scored",
    ),
    "j1_label_comments": _with(
        "SELECT Input_id, labeldem, labelgop, labeldjt, body FROM bodies JOIN labeled ON id = Input_id",
        "bodies", "labeled",
    ),
    "j2_attach_submission": _with(
        """SELECT id, created_utc, state, com_score, link_id, title, sub_score
           FROM prepared JOIN submissions USING (link_id)""",
        "prepared", "submissions",
    ),
    "j3_attach_metadata": _with(
        """SELECT query_id, song_id, song_name, artist_name, page_link FROM ranked
           LEFT JOIN song USING (song_id) LEFT JOIN artist USING (artist_id)""",
        "ranked", "song", "artist",
    ),
    "j4_songs_with_all_tokens": _with(
        "SELECT query_id, song_id FROM matched WHERE NOT any_token GROUP BY query_id, n_tokens, song_id"
        " HAVING count(*) = n_tokens",
        "matched",
    ),
    "j5_region_sentiment": _with(
        "SELECT n_name AS name, pos, neg FROM nation LEFT JOIN by_state ON n_name = state", "by_state"
    ),
    "a1_sentiment_by_post": _with("SELECT * FROM by_post", "by_post"),
    "a2_sentiment_by_day": _with(
        f"""SELECT {_DAY} AS date, sum(pos_prob) / count(pos_prob) AS pos,
             sum(neg_prob) / count(neg_prob) AS neg FROM scored GROUP BY 1""",
        "scored",
    ),
    "a3_sentiment_by_state": _with("SELECT * FROM by_state", "by_state"),
    "a4_sentiment_by_comment_score": _shares("com_score"),
    "a5_sentiment_by_submission_score": _shares("sub_score"),
    "a5_all_rollups_at_once": _with(
        f"""SELECT 'posts' AS rollup, coalesce(link_id, '-') AS key, title, pos, neg FROM by_post UNION ALL
            SELECT 'states', state, NULL, pos, neg FROM by_state UNION ALL """
        + " UNION ALL ".join(
            f"""SELECT '{name}', coalesce(cast({key} AS VARCHAR), '-'), NULL,
                sum(pos_prob) / count(pos_prob), sum(neg_prob) / count(neg_prob) FROM scored GROUP BY {key}"""
            for name, key in (("days", _DAY), ("sub_score", "sub_score"), ("com_score", "com_score"))
        ),
        "by_post", "by_state", "scored",
    ),
    "a6_sum_scores": _with(
        """SELECT query_id, song_id, round(sum(score), 6) AS score FROM matched WHERE any_token
           GROUP BY query_id, song_id""",
        "matched",
    ),
    "a7_sum_scores_of_full_matches": _with(
        """SELECT query_id, song_id, round(sum(score), 6) AS score FROM matched WHERE NOT any_token
           GROUP BY query_id, n_tokens, song_id HAVING count(*) = n_tokens""",
        "matched",
    ),
    "a8_result_count": _with("SELECT * FROM result_counts", "result_counts"),
    "a9_sentiment_difference": _with(
        "SELECT *, CASE WHEN difference < 0 THEN -1 ELSE 1 END AS sign FROM differences", "differences"
    ),
    "a10_chart_weight": _with(
        """SELECT state, round(1 - sqrt(pos / 100), 6) AS pos_weight, round(1 - sqrt(neg / 100), 6) AS neg_weight,
             round(1 - abs(difference) / 100, 6) AS difference_weight FROM differences""",
        "differences",
    ),
    "t1_top_positive_posts": _with("SELECT * FROM by_post ORDER BY pos DESC, link_id, title LIMIT 10", "by_post"),
    "t2_top_negative_posts": _with("SELECT * FROM by_post ORDER BY neg DESC, link_id, title LIMIT 10", "by_post"),
    "t3_first_page": _with(
        """SELECT query_id, rank, song_name, artist_name, page_link, song_id, round(score, 6) AS score
           FROM numbered LEFT JOIN song USING (song_id) LEFT JOIN artist USING (artist_id) WHERE rank <= 20""",
        "numbered", "song", "artist",
    ),
    "t3_first_page_from_blocks": _with(
        """SELECT query_id, rank, song_name, artist_name, page_link, song_id, round(score, 6) AS score
           FROM numbered LEFT JOIN song USING (song_id) LEFT JOIN artist USING (artist_id) WHERE rank <= 20""",
        "numbered", "song", "artist",
    ),
    "t4_tenth_page": _with(
        "SELECT query_id, song_id, round(score, 6) AS score, rank FROM numbered WHERE rank BETWEEN 181 AND 200",
        "numbered",
    ),
    "t4_third_page": _with(
        "SELECT query_id, song_id, round(score, 6) AS score, rank FROM numbered WHERE rank BETWEEN 41 AND 60",
        "numbered",
    ),
    "t5_page_info": _with(
        """SELECT query_id, n_row, 3 AS n_page, cast(ceil(n_row / 20) AS bigint) AS pages,
             3 > 1 AS has_previous, 3 < n_row / 20 AS has_next FROM result_counts""",
        "result_counts",
    ),
    "q1_search_or": _found("ranked_or"),
    "q2_search_and": _found("ranked_and"),
    "q2_search_and_ignoring_repeats": _found("ranked_and_distinct"),
    "q3_search": _found("ranked_plain"),
    "q3_search_stored_index": _found("ranked_plain"),
    "q3_search_passages": _with(
        f"""SELECT item_id AS query_id, song_id, round(sum(score), 6) AS score
            FROM (SELECT DISTINCT item_id, unnest(toks) AS token
                  FROM (SELECT item_id, {_query_tokens('lower(text)')} AS toks FROM benchmark))
            JOIN tfidf USING (token)
            JOIN (SELECT item_id, len(list_distinct({_query_tokens('lower(text)')})) AS n FROM benchmark) USING (item_id)
            GROUP BY item_id, n, song_id HAVING count(*) = n""",
        "tfidf",
    ),
    "x1_normalize": _text(_normalize("text")),
    "x3_strip_urls": _text(_strip_urls("text")),
    "x4_collapse_spaces": _text(f"trim(regexp_replace(text, '[{WHITESPACE}]+', ' ', 'g'))"),
    "x5_isolate_punct": _text(_isolate("text")),
    "x6_tokens": _text(f"array_to_string({_tokens('text')}, ' ')"),
    "x7_parsed_text": _text(f"lower(array_to_string({_tokens('text')}, ' '))"),
    "x8_unigrams": _words(1),
    "x9_bigrams": _words(2),
    "x9_trigrams": _words(3),
    "x10_ngrams": _with(
        """SELECT doc_id, coalesce(words, '') AS result FROM texts
           LEFT JOIN (SELECT doc_id, string_agg(words, ' ' ORDER BY n) AS words FROM text_words GROUP BY doc_id)
           USING (doc_id)""",
        "texts", "text_words",
    ),
    "x11_query_tokens": _with(
        f"""SELECT query_id, cast(generate_subscripts(toks, 1) - 1 AS int) AS pos, unnest(toks) AS token
            FROM (SELECT query_id, {_query_tokens('query')} AS toks
                  FROM (SELECT query_id, query FROM asked UNION ALL SELECT doc_id + 1000, text FROM texts))""",
        "asked", "texts",
    ),
    "x12_build_tfidf": _with("SELECT song_id, token, round(score, 6) AS score FROM tfidf", "tfidf"),
    "d1_utc_day": _with(f"SELECT id, {_DAY} AS date FROM all_comments", "all_comments"),
    "d2_parse_dates": _with(
        f"""SELECT id, cast(date_diff('day', DATE '1970-01-01', strptime({_DAY}, '%Y-%m-%d')) AS int) AS epoch_day
            FROM all_comments""",
        "all_comments",
    ),
    "m1_fit_vocabulary": _with(
        "SELECT term FROM marked_totals ORDER BY total DESC, tie, term LIMIT 300", "marked_totals"
    ),
    "m1_vocabulary_table": _with(
        """SELECT term, count(*) AS df
           FROM (SELECT id, term FROM comment_terms WHERE id IN (SELECT id FROM bodies))
           GROUP BY term HAVING count(*) >= 10""",
        "bodies", "comment_terms",
    ),
    "m2_vectorize": _with(
        """SELECT id, count(term) AS n_terms FROM all_bodies
           LEFT JOIN (SELECT id, term FROM comment_terms JOIN vocabulary USING (term)) USING (id) GROUP BY id""",
        "all_bodies", "comment_terms", "vocabulary",
    ),
    "m2_feature_rows": _with(
        "SELECT id, term FROM comment_terms JOIN vocabulary USING (term)", "comment_terms", "vocabulary"
    ),
    "m3_add_labels": _with(
        f"""SELECT Input_id, CASE WHEN labeldjt = 1 THEN 1 ELSE 0 END AS pos_label,
             CASE WHEN labeldjt = -1 THEN 1 ELSE 0 END AS neg_label
            FROM (SELECT * FROM labeled UNION ALL SELECT * FROM {planted.LABELS})""",
        "labeled",
    ),
    "m5_split_by_hash": _with(f"{_part('pos')} UNION ALL {_part('neg')}", "labeled"),
    "m10_threshold_flag": _with(
        f"""SELECT id, CASE WHEN chance <= 0.2 THEN 0 ELSE 1 END AS pos_prob,
             CASE WHEN chance <= 0.25 THEN 0 ELSE 1 END AS neg_prob
            FROM (SELECT id, pos AS chance FROM chances UNION ALL SELECT id, chance FROM {planted.CHANCES})""",
        "chances",
    ),
    "m11_score_linear": _with("SELECT id, round(pos, 6) AS pos, round(neg, 6) AS neg FROM chances", "chances"),
    **{
        name: _with("SELECT id, true AS pos_agrees, true AS neg_agrees FROM kept_bodies", "kept_bodies")
        for name in ("m8_prediction_equals_flag", "m9_score", "s7_stored_classifier")
    },
    "m6_fit_logistic_regression": _halves(
        "SELECT kind, count(*) AS n_rows, sum(is_positive)::bigint AS n_positive, true AS fits, true AS near_best FROM halves GROUP BY kind"
    ),
    "m7_cross_validate": _halves(
        "SELECT kind, fold, count(*) AS n_rows, true AS agrees FROM halves GROUP BY kind, fold"
    ),
    "m12_evaluate": "SELECT unnest(['pos', 'neg']) AS kind, true AS agrees",
}
