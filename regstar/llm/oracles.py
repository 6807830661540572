"""DuckDB SQL for the queries of this subpackage that SQL can express, written
from their contracts. The others hash, sample or fit in ways that SQL lacks
and are tested against plain Python (``tests/llm``)."""

from __future__ import annotations

from functools import reduce

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _host(url: str) -> str:
    return f"translate(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}')"


def _path(url: str) -> str:
    return f"regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"


def _clear(path: str) -> str:
    """The path with its ``.`` and ``..`` segments carried out."""
    return (
        f"CASE WHEN regexp_matches({path}, '/\\.\\.?(/|$)') THEN "
        f"list_reduce(list_prepend('', string_split(substr({path}, 2), '/')), lambda kept, part: CASE part WHEN '.' THEN kept "
        f"WHEN '..' THEN regexp_replace(kept, '/[^/]*$', '') ELSE kept || '/' || part END) ELSE {path} END"
    )


def _node(url: str) -> str:
    query = (
        f"list_sort(list_filter(string_split(regexp_extract({url}, '(?s)^.*?://[^?#]*\\?([^#]*)', 1), '&'), "
        "lambda q: q <> '' AND NOT regexp_matches(q, '^(utm_[a-z]+|ref|gclid|fbclid)(=|$)')))"
    )
    return (
        f"CASE WHEN contains({url}, '://') THEN {_host(url)} || regexp_replace({_clear(_path(url))}, '/+$', '') || "
        f"CASE WHEN len({query}) > 0 THEN '?' || array_to_string({query}, '&') ELSE '' END END"
    )


def _rule(host: str, path: str, column: str) -> str:
    """The longest rule that fits, by (rule, action)."""
    return f"""(SELECT {column} FROM rules
      WHERE ({host} = rhost OR ends_with({host}, '.' || rhost)) AND starts_with({path}, rpath)
      ORDER BY length(rule) DESC, length(rhost) DESC, action LIMIT 1)"""


OP1 = rf"""
WITH RECURSIVE rules AS (
  SELECT action, rule, split_part(rule, '/', 1) AS rhost, substr(rule, strpos(rule, '/')) AS rpath
  FROM (VALUES ('allow', 'com/'), ('block', 'example.com/en/'), ('allow', 'www.example.com/en/'),
               ('block', 'net/es/'), ('block', 'net/fr/')) AS r(action, rule)
),
tags AS (
  SELECT url, unnest(list_concat(
    list_transform(regexp_extract_all(html, '(?i)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'),
                   lambda t: regexp_extract(t, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)),
    list_transform(regexp_extract_all(html, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'),
                   lambda t: regexp_extract(t, '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1)))) AS raw
  FROM pages WHERE contains(url, '://')
),
targets AS (
  SELECT url, CASE
    WHEN regexp_matches(raw, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN raw
    WHEN starts_with(raw, '//') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || raw
    WHEN starts_with(raw, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || raw
    WHEN starts_with(raw, '?') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || {_path('url')} || raw
    WHEN starts_with(raw, '#') THEN regexp_extract(url, '(?s)^([^#]*)', 1)
    ELSE regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1)
      || CASE WHEN regexp_replace({_path('url')}, '[^/]*$', '') = '' THEN '/'
              ELSE regexp_replace({_path('url')}, '[^/]*$', '') END || raw END AS target
  FROM (SELECT url, replace(trim(raw), '&amp;', '&') AS raw FROM tags WHERE raw <> '')
),
edges AS (
  SELECT {_node('url')} AS a, {_node('target')} AS b FROM targets WHERE {_node('url')} IS NOT NULL AND {_node('target')} IS NOT NULL
),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(a, b) AS (
  SELECT a, a FROM both_ways
  UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a
),
aliases AS (SELECT a AS node, min(b) AS component FROM reach GROUP BY a),
classes AS (
  SELECT component, bool_or(own = 'allow') AS allowed, bool_or(own = 'block') AS blocked
  FROM (SELECT component, {_rule(_host("('://' || node)"), _path("('://' || node)") + " || '/'", 'action')} AS own FROM aliases)
  GROUP BY component
),
judged AS (
  SELECT page_id, coalesce({_host('url')}, '') AS host, coalesce({_path('url')}, '') AS path, {_node('url')} AS node FROM pages
)
SELECT page_id, host, path, {_rule('host', 'path', 'rule')} AS rule,
       coalesce({_rule('host', 'path', 'action')},
                CASE WHEN blocked AND NOT coalesce(allowed, false) THEN 'block' ELSE 'allow' END) AS verdict,
       component
FROM judged LEFT JOIN aliases USING (node) LEFT JOIN classes USING (component)
"""

OP4 = r"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
split AS (
  SELECT *, list_filter(regexp_split_to_array(body, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
),
words_at AS (SELECT rid, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM split),
windows AS (
  SELECT rid, i, word = lag(word) OVER w AS echo,
         word || ' ' || lead(word, 1) OVER w || ' ' || lead(word, 2) OVER w || ' ' || lead(word, 3) OVER w
           || ' ' || lead(word, 4) OVER w AS words5
  FROM words_at WINDOW w AS (PARTITION BY rid ORDER BY i)
),
echoed AS (SELECT rid, count(*) AS echoes FROM windows WHERE echo GROUP BY rid),
starts AS (
  SELECT rid, i FROM (
    SELECT rid, i, count(*) OVER (PARTITION BY rid, words5) AS n FROM windows WHERE words5 IS NOT NULL
  ) WHERE n > 1
),
covered AS (
  SELECT rid, CAST(sum(least(5, gap)) AS BIGINT) AS n_repeat_words
  FROM (SELECT rid, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 5) AS gap FROM starts) GROUP BY rid
),
measured AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         length(regexp_replace(body, '[^\p{L}]', '', 'g')) AS letters,
         length(regexp_replace(body, '[^\p{Lu}]', '', 'g')) AS capitals,
         coalesce(echoes, 0) AS echoes
  FROM split LEFT JOIN covered USING (rid) LEFT JOIN echoed USING (rid)
),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR (10 * capitals > 4 * letters AND letters >= 40)
            OR 10 * echoes > 3 * n_words) AS kept
FROM judged
"""

OP11 = r"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
),
starts AS (SELECT rid, doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM texts),
windows AS (SELECT rid, doc_id, i, array_to_string(words[i : i + 12], ' ') AS passage FROM starts),
earliest AS (SELECT passage, min(doc_id) AS first_doc FROM windows GROUP BY passage),
gone AS (
  SELECT DISTINCT rid, i + j AS place
  FROM windows JOIN earliest USING (passage) CROSS JOIN range(13) AS r(j) WHERE doc_id > first_doc
),
words_at AS (SELECT rid, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts),
kept AS (
  SELECT rid, count(*) AS n_kept, string_agg(word, ' ' ORDER BY place) AS kept
  FROM words_at ANTI JOIN gone USING (rid, place) GROUP BY rid
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (rid)
"""

OP12 = """
WITH vectors AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same,
         CAST(list_inner_product(a.v, o.v) AS BIGINT) AS score
  FROM vectors AS a JOIN vectors AS o ON a.vec_id <> o.vec_id WHERE a.vec_id % 50 = 0
),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives AS p JOIN scored AS s ON p.anchor_id = s.anchor_id AND NOT same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def _trees(name: str, levels: int) -> str:
    """Tables of the trees over ``name``0 (tree, i, h): each next level, and the
    siblings' digests of each node; a tree with one node has no next level."""
    parts = []
    for n in range(levels):
        parts.append(f"""
{name}{n}_kin AS (
  SELECT tree, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}{n}) AS a JOIN {name}{n} AS b USING (tree)
  WHERE a.n > 1 AND a.i // 3 = b.i // 3 GROUP BY tree, a.i
),
{name}{n + 1} AS (
  SELECT tree, i // 3 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}{n}) WHERE n > 1 GROUP BY tree, i // 3
)""")
    every = " UNION ALL ".join(f"SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}{n}" for n in range(levels + 1))
    parts.append(f"{name}_tops AS (SELECT tree, h FROM ({every}) WHERE n = 1)")
    return ",".join(parts)


def _walk(start: str, out: str, name: str, tree: str, rank: str, levels: int) -> str:
    """``out``: rows of ``start`` with ``proof`` and ``folded`` taken up the tree."""
    parts, last = [], start
    for n in range(levels):
        parts.append(f"""{out}{n} AS (
  SELECT r.* EXCLUDE (proof, folded), proof || coalesce(k.before || k.after, '') AS proof,
         CASE WHEN k.i IS NULL THEN folded ELSE sha256(k.before || folded || k.after) END AS folded
  FROM {last} AS r LEFT JOIN {name}{n}_kin AS k ON k.tree = r.{tree} AND k.i = r.{rank} // {3**n}
)""")
        last = f"{out}{n}"
    return ",\n".join([*parts, f"{out} AS (SELECT * FROM {last})"])


def _leaf(text: str) -> str:
    told = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in told) + ")"


#: Levels of a source's tree and of the tree of sources (3 ** levels leaves).
_LEVELS, _TOP_LEVELS = 13, 6

#: crc32 by one byte at a time: the remainders of all bytes.
_CRC_TABLE = ", ".join(
    str(reduce(lambda c, _: c >> 1 ^ 0xEDB88320 * (c & 1), range(8), b)) for b in range(256)
)
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
    "lambda c: CAST(ascii(c) AS BIGINT))), lambda r, b: xor(r >> 8, crc_table[1 + (xor(r, b) & 255)])), 4294967295)"
)

OP13 = f"""
WITH table_of AS (SELECT CAST([{_CRC_TABLE}] AS BIGINT[]) AS crc_table),
hashed AS (
  SELECT doc_id, coalesce('s' || source, '') AS tree, {_leaf("text")} AS leaf,
         CASE WHEN {_CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} END AS held
  FROM documents, table_of
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM hashed
),
t0 AS (SELECT tree, place AS i, leaf AS h FROM leaves),
{_trees("t", _LEVELS)},
sources AS (SELECT tree AS of_tree, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS nth FROM t_tops),
s0 AS (SELECT '' AS tree, nth AS i, h FROM sources),
{_trees("s", _TOP_LEVELS)},
begun AS (
  SELECT l.*, '' AS one, s.nth, s.h AS subroot, '' AS proof, coalesce(held, leaf) AS folded
  FROM leaves AS l JOIN sources AS s ON s.of_tree = l.tree
),
{_walk("begun", "in_source", "t", "tree", "place", _LEVELS)},
{_walk("in_source", "whole", "s", "one", "nth", _TOP_LEVELS)}
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.h AS verified
FROM whole, s_tops AS r
"""

ORACLE_SQL = {
    "op1_url_filters": OP1.strip(),
    "op4_quality_rules": OP4.strip(),
    "op11_substring_dedup": OP11.strip(),
    "op12_hard_negatives": OP12.strip(),
    "op13_merkle_manifest": OP13.strip(),
}
