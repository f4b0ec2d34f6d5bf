"""The registered queries as DuckDB SQL, where SQL can express them on whole tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE["op3_benchmark_decontamination"] = rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), passage AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n,
         array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM item WHERE len(w) > 0)
), size AS (SELECT DISTINCT n FROM passage),
place AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS p
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, size WHERE len(w) >= n)
), found AS (SELECT doc_id, item_id, place.n, i FROM place JOIN passage ON place.p = passage.p AND place.n = passage.n),
hit AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, cast(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE["op4_warc"] = """
WITH page AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages
), judged AS (
  SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS first FROM page
)
SELECT page_id, cast(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < first THEN first END AS refers_to
FROM judged
"""

ORACLE["op5_chat_formatting"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), ordered AS (
  SELECT *, row_number() OVER w - 1 AS place, coalesce(lag(role) OVER w, '') AS before,
         row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS is_last
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       cast(sum(24 + length(role) + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g'))) AS BIGINT) AS formatted_chars,
       cast(coalesce(
         min(place) FILTER (NOT list_contains(
           ['>system', '>user', 'system>user', 'user>assistant', 'assistant>user', 'assistant>tool', 'tool>assistant'],
           before || '>' || role)),
         min(place + 1) FILTER (is_last AND role <> 'assistant')) AS INTEGER) AS first_invalid
FROM ordered GROUP BY conv_id
"""

ORACLE["op6_line_dedup"] = rf"""
WITH doc AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
line AS (
  SELECT doc_id, l, i, translate(regexp_replace(l, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
         '{_UPPER}', '{_LOWER}') AS k
  FROM (SELECT doc_id, unnest(ls) AS l, unnest(range(1, len(ls) + 1)) AS i FROM doc)
), judged AS (
  SELECT *, length(k) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY k) AS gone FROM line
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

ORACLE["op7_quality_rules"] = r"""
WITH doc AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), window_at AS (
  SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS p
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM doc WHERE len(w) >= 8)
), twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, p) AS n FROM window_at) WHERE n > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT k) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS k FROM twice) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n_lines,
         count(*) FILTER (regexp_matches(l, '[^\x20\x09-\x0D]'))
           - count(DISTINCT l) FILTER (regexp_matches(l, '[^\x20\x09-\x0D]')) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM doc) GROUP BY doc_id
), measured AS (
  SELECT doc_id, host, cast(len(w) AS BIGINT) AS n_words,
         cast(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         n_lines, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM doc JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)
), tested AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         [10 * n_symbols, 10 * n_dup_lines, 2 * n_words, word_chars] AS over,
         [n_words, 3 * n_lines, word_chars, 15 * n_words] AS most
  FROM measured
), rules AS (
  SELECT doc_id, host, unnest([1, 2, 3, 4]) AS r, unnest(over) AS o, unnest(most) AS m FROM tested
), failures AS (
  SELECT host, r, count(*) AS n, count(*) FILTER (o > m) AS k FROM rules GROUP BY host, r
), moments AS (
  SELECT r, sum(k) / sum(n) AS m, sum(k * k / n) / sum(n) - (sum(k) / sum(n)) ** 2 AS v FROM failures GROUP BY r
), prior AS (
  SELECT r, m, CASE WHEN v > 1e-12 THEN greatest(m * (1 - m) / v - 1, 4.0) ELSE 1e9 END AS s FROM moments
), rates AS (SELECT host, r, (k + m * s) / (n + s) AS rate FROM failures JOIN prior USING (r)),
blamed AS (
  SELECT doc_id, bool_or(o > m AND rate + (1 - m / nullif(o, 0)) > 0.5) AS b FROM rules JOIN rates USING (host, r) GROUP BY doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT b AS kept, b AS host_failed
FROM tested JOIN blamed USING (doc_id)
"""

ORACLE["op1_substring_dedup"] = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS p
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM doc WHERE len(w) >= 50)
), again AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY p) AS least FROM win) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, k FROM (SELECT doc_id, unnest(range(i, i + 50)) AS k FROM again)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS k FROM doc),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY k) AS kept, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id
)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""

ORACLE["op2_suffix_array_dedup"] = r"""
WITH doc AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
win AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS p
  FROM (SELECT doc_id, h, unnest(range(0, n - 199)) AS i FROM doc WHERE n >= 200)
), again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY p) AS c FROM win) WHERE c > 1),
island AS (
  SELECT doc_id, min(i) AS a, max(i) + 200 AS b
  FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS g
        FROM (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS fresh
              FROM again))
  GROUP BY doc_id, g
), cut AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS low, a AS high FROM island
  UNION ALL SELECT doc_id, max(b), NULL FROM island GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * low + 1, 2 * (coalesce(high, n) - low)), '' ORDER BY low) AS kept
  FROM cut JOIN doc USING (doc_id) GROUP BY doc_id
), found AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM island GROUP BY doc_id)
SELECT doc_id, cast(n AS BIGINT) AS n_bytes, cast(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM doc LEFT JOIN found USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

# Trees of up to 3 ** 12 documents a source and 3 ** 8 sources; a level above a root passes it on.
_TREES = {"leaves": ("named, src", 12), "tops": ("one", 8)}


def _tree(leaves: str, key: str, levels: int) -> str:
    """Tables ``LEAVES_0`` and on, of the nodes by level, and ``LEAVES_s0`` and on, of their siblings."""
    parts, keys = [f"{leaves}_0 AS MATERIALIZED (SELECT {key}, idx, n, d FROM {leaves})"], key.split(", ")
    for k in range(levels):
        parts.append(
            f"""{leaves}_{k + 1} AS MATERIALIZED (
  SELECT {key}, idx // 3 AS idx, (max(n) + 2) // 3 AS n,
         CASE WHEN max(n) > 1 THEN sha256(string_agg(d, '' ORDER BY idx)) ELSE max(d) END AS d
  FROM {leaves}_{k} GROUP BY {key}, idx // 3
)"""
        )
        parts.append(
            f"""{leaves}_s{k} AS MATERIALIZED (
  SELECT {", ".join(f"a.{name}" for name in keys)}, a.idx, any_value(a.n) AS n,
         coalesce(string_agg(b.d, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
         coalesce(string_agg(b.d, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM {leaves}_{k} a JOIN {leaves}_{k} b ON {" AND ".join(f"a.{name} = b.{name}" for name in keys)} AND a.idx // 3 = b.idx // 3
  GROUP BY {", ".join(f"a.{name}" for name in keys)}, a.idx
)"""
        )
    return ",\n".join(parts)


def _paths(walk: str, leaves: str, key: str, levels: int) -> str:
    """Tables ``WALK_1`` and on: proofs and folded digests of leaves, one level further each."""
    parts = []
    for k in range(levels):
        parts.append(
            f"""{walk}_{k + 1} AS MATERIALIZED (
  SELECT w.* REPLACE (w.node // 3 AS node, w.proof || s.l || s.r AS proof,
                      CASE WHEN s.n > 1 THEN sha256(s.l || w.fold || s.r) ELSE w.fold END AS fold)
  FROM {walk}_{k} w JOIN {leaves}_s{k} s ON {" AND ".join(f"w.{name} = s.{name}" for name in key.split(", "))} AND w.node = s.idx
)"""
        )
    return ",\n".join(parts)


def _field(name: str) -> str:
    return f"coalesce(strlen(cast({name} AS VARCHAR)) || ':' || {name}, '-')"


_LEAF = " || ".join(_field(name) for name in ("doc_id", "source", "lang", "n_chars", "text"))
_CRC = """list_reduce(list_prepend(4294967295, list_transform(string_split(cast(doc_id AS VARCHAR), ''), lambda c: cast(ascii(c) AS BIGINT))),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                               lambda c, z: xor(c >> 1, (c & 1) * 3988292384)))"""

ORACLE["op11_merkle_manifest"] = f"""
WITH bent AS (
  SELECT doc_id, source, {_LEAF} AS whole, xor({_CRC}, 4294967295) % 2 = 0 AS chosen,
         {_LEAF.replace(_field("text"), _field("replace(text, chr(10), '')"))} AS without FROM documents
), leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY named, src ORDER BY doc_id NULLS LAST, d) - 1 AS idx, count(*) OVER (PARTITION BY named, src) AS n
  FROM (SELECT doc_id, source IS NOT NULL AS named, coalesce(source, '') AS src, sha256(whole) AS d,
               sha256(CASE WHEN chosen THEN without ELSE whole END) AS bent FROM bent)
), {_tree("leaves", *_TREES["leaves"])},
tops AS MATERIALIZED (
  SELECT 1 AS one, named, src, d, row_number() OVER (ORDER BY named, src) - 1 AS idx, count(*) OVER () AS n FROM leaves_12
), {_tree("tops", *_TREES["tops"])},
walk_0 AS (SELECT *, idx AS node, '' AS proof, bent AS fold FROM leaves),
{_paths("walk", "leaves", *_TREES["leaves"])},
climb_0 AS (
  SELECT w.doc_id, w.d AS leaf, t.d AS subroot, 1 AS one, t.idx AS node, w.proof, w.fold
  FROM walk_12 w JOIN tops t ON w.named = t.named AND w.src = t.src
), {_paths("climb", "tops", *_TREES["tops"])}
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = d AS verified
FROM climb_8 c JOIN tops_8 t ON c.one = t.one
"""

ORACLE["op13_phrase_collocations"] = r"""
WITH piece AS (
  SELECT lang, regexp_extract_all(x, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS x
        FROM documents)
), total AS (SELECT lang, cast(sum(len(w)) AS BIGINT) AS n FROM piece GROUP BY lang),
gram AS (
  SELECT lang, w[i : i + k - 1] AS g, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT *, unnest([1, 2, 3, 4]) AS k FROM piece) WHERE len(w) >= k)
  GROUP BY lang, g HAVING count(*) >= 30
), cut AS (
  SELECT c.lang, c.g, c.f AS a, k, x.f AS l, y.f AS r, cast(2000000 AS HUGEINT) * c.f // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, len(g))) AS k FROM gram WHERE len(g) > 1) c
  JOIN gram x ON x.lang = c.lang AND x.g = c.g[1 : k] JOIN gram y ON y.lang = c.lang AND y.g = c.g[k + 1 : len(c.g)]
), weakest AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), inside AS (
  SELECT lang, p, max(f) AS around
  FROM (SELECT lang, f, g[i : i + k - 1] AS p
        FROM (SELECT *, unnest(range(1, len(g) - k + 2)) AS i FROM (SELECT *, unnest(range(2, len(g))) AS k FROM gram WHERE len(g) > 2)))
  GROUP BY lang, p
), ranked AS (
  SELECT w.lang, array_to_string(w.g, ' ') AS phrase, a, l, r, cast(score AS BIGINT) AS score,
         row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, array_to_string(w.g, ' ')) AS rank
  FROM weakest w LEFT JOIN inside i ON w.lang = i.lang AND w.g = i.p
  WHERE around IS NULL OR cast(100 AS HUGEINT) * around < cast(80 AS HUGEINT) * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
