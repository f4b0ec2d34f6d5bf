"""Rows added to the given tables for cases the tables do not hold.

Each is a SQL row list that Spark and the checking database read alike.
"""

# Texts: links, brackets, tabs, line ends, odd white space and digits.
TEXTS = """(VALUES
  (-1, 'Hello, world! It''s 3.14 -- (see [this](http://a.b/c)) **bold** www.x.y'),
  (-2, 'good -- bad'),
  (-3, 'a.b'),
  (-4, 'don''t :) ''quoted'''),
  (-5, '?!'),
  (-6, ''),
  (-7, '&gt; q /s'),
  (-8, concat('tab', chr(9), 'here', chr(10), 'line', chr(13), 'return', chr(28), 'parted')),
  (-9, concat('no', chr(160), 'break [in] https://x.y/z', chr(160), 'after')),
  (-10, 'x² ①b --²-- éa--ß- ... ;;'),
  (-11, cast(null AS string)),
  (-12, 'HTTP://Not.A.Link but http:// is, www. too https://q')
) AS t(doc_id, text)"""

# Comments: sarcasm, quotes, states by exact name, missing values and posts.
COMMENTS = """(VALUES
  ('p1', 'nice /s', 1514764799, 'Texas', 1, 't3_0'),
  ('p2', 'see /story', 1514764800, 'texas', 2, 't3_abc'),
  ('p3', cast(null AS string), 1546214400, cast(null AS string), cast(null AS int), 't3_1'),
  ('p4', '&gt; quoted', 1546214400, 'Texas', cast(null AS int), 't3_none'),
  ('p5', ' &gt; not first', 1546300799, 'District of Columbia', 5, 't3_2'),
  ('p6', 'no post', 1546300800, '', -3, cast(null AS string)),
  ('p7', 'the of and', 1546214401, 'Texas', cast(null AS int), 't3_3'),
  ('p8', 'no date at all', cast(null AS bigint), 'Texas', 7, 't3_4')
) AS t(id, body, created_utc, author_flair_text, score, link_id)"""

# Lines of a file of comments that cannot be read: no JSON, cut short, and values of other types.
BAD_LINES = """(VALUES
  ('no json at all'), ('{"id": "b1", "body": "cut sho'), ('{"id": "b2", "score": "many"}'), ('["b3"]'),
  ('{"id": "b4", "created_utc": {"at": 1}, "body": "x"}')
) AS t(line)"""

# Titles that a CSV file may change.
TITLES = """(VALUES
  ('t1', ' outer spaces  '), ('t2', ''), ('t3', cast(null AS string)), ('t4', 'a "quoted" one, two'),
  ('t5', concat('back', chr(92), 'slash ', chr(92), '" end', chr(92))), ('t6', concat('line', chr(10), 'end')),
  ('t7', concat(chr(92), 'N')), ('t8', 'null'), ('t9', concat(chr(9), 'tab', chr(9))), ('t10', '"'), ('t11', '#no comment')
) AS t(link_id, title)"""

# Labels: every kind of value.
LABELS = """(VALUES
  ('l1', 0, 0, 1), ('l2', 0, 0, 0), ('l3', 0, 0, -1), ('l4', 0, 0, 2), ('l5', 0, 0, cast(null AS int))
) AS t(Input_id, labeldem, labelgop, labeldjt)"""

# Chances at and just above the two thresholds.
CHANCES = """(VALUES
  ('c1', cast(0.2 AS double)), ('c2', cast(0.2000001 AS double)), ('c3', cast(0.25 AS double)),
  ('c4', cast(0.2500001 AS double)), ('c5', cast(0 AS double)), ('c6', cast(1 AS double))
) AS t(id, chance)"""

# Keyword queries of either type, asked of the index over all documents.
QUERIES = """(VALUES
  (1, 'the and of', 'or'),
  (2, 'the and of', 'and'),
  (3, 'La, "des" le!', 'AND'),
  (4, '"le", (la)', 'OR'),
  (5, 'of of', 'and'),
  (6, 'of of', 'or'),
  (7, '... !!', 'or'),
  (8, 'le la des', 'xor'),
  (9, 'nosuchtoken und', 'or'),
  (10, 'nosuchtoken und', 'and'),
  (11, 'don''t stop', 'and'),
  (12, concat('the', chr(9), 'of', chr(10), 'in', chr(13), 'is'), 'and'),
  (13, 'the!\u0085 of!\u2028 and!\u2029 (la)', 'or')
) AS t(query_id, query, query_type)"""

# States kept by the state rollup, besides the fixed list.
TEST_STATES = tuple(f"NATION_{i}" for i in range(10))

# Map regions left out of the test charts.
TEST_UNCHARTED = ("NATION_2", "NATION_5")
