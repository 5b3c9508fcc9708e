"""DuckDB twins of the queries that SQL can follow."""

from riskloom.llm.chat import CHAT_SQL
from riskloom.llm.mixing import MIX_SQL
from riskloom.llm.topk import TOPK_SQL

QUALITY_SQL = r"""
WITH words AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, row_number() OVER () AS row,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS (
  SELECT row, unnest(range(1, len(w) - 1)) AS i, w FROM words WHERE len(w) > 2),
placed AS (SELECT row, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram FROM grams),
again AS (SELECT row, i, count(*) OVER (PARTITION BY row, gram) AS n FROM placed),
repeats AS (
  SELECT row, count(DISTINCT i + k) AS n_repeat_words
  FROM again, (VALUES (0), (1), (2)) AS step(k) WHERE n > 1 GROUP BY row),
lines AS (
  SELECT row, line, count(*) AS n
  FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row, line),
dups AS (SELECT row, sum(n - 1)::BIGINT AS n_dup_lines FROM lines GROUP BY row),
measures AS (
  SELECT doc_id, lang, source, len(w)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN repeats USING (row) LEFT JOIN dups USING (row)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measures),
long AS (
  SELECT lang, source, m.measure, m.value FROM (
    SELECT lang, source, unnest([
      {measure: 'symbols', value: n_symbols * 1000000 // word_chars},
      {measure: 'repeats', value: n_repeat_words * 1000000 // n_words},
      {measure: 'lines', value: n_dup_lines * 1000000 // n_words},
      {measure: 'length', value: word_chars * 1000000 // n_words}]) AS m
    FROM based WHERE NOT base_failed AND n_words > 0)),
edges AS (
  SELECT lang, source, measure, (value >> greatest(length(bin(value)) - 8, 0)) << greatest(length(bin(value)) - 8, 0) AS edge
  FROM long),
levels AS (
  SELECT 'own' AS level, lang, source, measure, edge FROM edges
  UNION ALL SELECT 'language', lang, NULL, measure, edge FROM edges
  UNION ALL SELECT 'all', NULL, NULL, measure, edge FROM edges),
cuts AS (
  SELECT level, lang, source, measure, count(*) AS n_rows,
    quantile_disc(edge, 0.75) AS q75, quantile_disc(edge, 0.9) AS q90
  FROM levels GROUP BY ALL),
fences AS (
  SELECT level, lang, source, measure, CASE WHEN q90 > q75 THEN q90 + 12 * (q90 - q75) ELSE greatest(q90, CASE measure
    WHEN 'symbols' THEN 50000 WHEN 'repeats' THEN 350000 WHEN 'lines' THEN 50000 ELSE 10000000 END) END AS fence
  FROM cuts WHERE n_rows >= 100 OR level = 'all'),
wide AS (
  SELECT level, lang, source, max(fence) FILTER (WHERE measure = 'symbols') AS symbols, max(fence) FILTER (WHERE measure = 'repeats') AS repeats,
    max(fence) FILTER (WHERE measure = 'lines') AS lines, max(fence) FILTER (WHERE measure = 'length') AS length
  FROM fences GROUP BY ALL)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  CASE WHEN base_failed THEN false ELSE NOT (
    n_symbols * 1000000 // word_chars > coalesce(least(o.symbols, l.symbols), a.symbols)
    OR n_repeat_words * 1000000 // n_words > coalesce(least(o.repeats, l.repeats), a.repeats)
    OR n_dup_lines * 1000000 // n_words > coalesce(least(o.lines, l.lines), a.lines)
    OR word_chars * 1000000 // n_words > coalesce(least(o.length, l.length), a.length)) END AS kept
FROM based b
LEFT JOIN wide o ON o.level = 'own' AND o.lang IS NOT DISTINCT FROM b.lang AND o.source IS NOT DISTINCT FROM b.source
LEFT JOIN wide l ON l.level = 'language' AND l.lang IS NOT DISTINCT FROM b.lang
LEFT JOIN wide a ON a.level = 'all'
"""

#: CRC-32 of a text's UTF-8 bytes: a table of 256 rests, then one look-up a byte.
CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce(list_prepend(i::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS rests
  FROM range(256) AS byte(i))"""


def crc32(text: str) -> str:
    """The SQL of a text's CRC-32, where `rests` is in reach."""
    code = f"hex(encode({text}))"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode({text}))), "
            f"lambda i: ('0x' || substr({code}, 2 * i + 1, 2))::BIGINT)), "
            "lambda c, b: xor(c >> 8, rests[xor(c & 255, b) + 1])), 4294967295)")


def _merkle_levels(name: str, group: str, levels: int) -> str:
    """Tables {name}1..: runs of 8 hashed level by level; {name}_side: what stands left and right of a node in its run."""
    out = []
    for k in range(levels):
        out.append(f"""{name}{k + 1} AS (
  SELECT {group}, i // 8 AS i, CASE WHEN n = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h, (n + 7) // 8 AS n
  FROM {name}{k} GROUP BY {group}, i // 8, n)""")
        out.append(f"""{name}{k}_side AS (
  SELECT {group}, i, n > 1 AS open, coalesce(string_agg(h, '') OVER (PARTITION BY {group}, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (PARTITION BY {group}, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})""")
    return ",\n".join(out)


def merkle_sql(levels: int = 7, language_levels: int = 2) -> str:
    """Trees of up to 8 ** levels leaves."""
    def field(c):
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"

    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps, previous = [], "placed"
    for name, here, count in (("t", "i", levels), ("s", "tree", language_levels)):
        for k in range(count):
            keys = f"x.lang IS NOT DISTINCT FROM d.lang AND x.i = d.{here} // {8 ** k}" if name == "t" else f"x.one = 0 AND x.i = d.{here} // {8 ** k}"
            steps.append(f"""{name}{k}_step AS (
  SELECT d.* EXCLUDE (folded, proof), CASE WHEN open THEN sha256(l || folded || r) ELSE folded END AS folded,
    CASE WHEN open THEN proof || l || r ELSE proof END AS proof
  FROM {previous} d JOIN {name}{k}_side x ON {keys})""")
            previous = f"{name}{k}_step"
    return f"""
WITH {CRC_TABLE},
leaves AS (
  SELECT doc_id, lang, sha256({head} || {field('text')}) AS leaf,
    CASE WHEN {crc32("coalesce(doc_id::VARCHAR, '')")} % 3 = 0 THEN sha256({head} || {field(lower)}) END AS changed
  FROM documents, crc_table),
ordered AS (
  SELECT doc_id, lang, leaf, coalesce(changed, leaf) AS changed, count(*) OVER (PARTITION BY lang) AS n,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
t0 AS (SELECT lang, i, leaf AS h, n FROM ordered),
{_merkle_levels("t", "lang", levels)},
s0 AS (
  SELECT 0 AS one, lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, h, count(*) OVER () AS n FROM t{levels}),
{_merkle_levels("s", "one", language_levels)},
placed AS (
  SELECT o.doc_id, o.lang, o.i, s0.i AS tree, o.leaf, s0.h AS subroot, o.changed AS folded, '' AS proof
  FROM ordered o JOIN s0 ON s0.lang IS NOT DISTINCT FROM o.lang),
{", ".join(steps)}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h AS verified
FROM {previous}, s{language_levels}
"""


SPELLING_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)),
hashed AS (SELECT run, {crc32("doc || ':' || run")} AS h, n FROM (SELECT doc, run, count(*) AS n FROM runs GROUP BY ALL), crc_table),
slipped AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
less AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT l.word, w.word AS other FROM less l JOIN words w ON w.word = l.rest
  UNION SELECT w.word, l.word FROM less l JOIN words w ON w.word = l.rest
  UNION SELECT a.word, b.word FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word),
ranked AS (
  SELECT near.word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
    row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS place
  FROM near JOIN words o ON o.word = near.other),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form,
    CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1),
chain AS (
  SELECT word, word AS stop, form AS further FROM formed
  UNION ALL SELECT c.word, c.further, f.form FROM chain c JOIN formed f ON f.word = c.further)
SELECT f.word, form, stop AS root, n, n_near, form_n FROM formed f JOIN chain c ON c.word = f.word AND c.further IS NULL
"""

SQL = {"op12_spelling_groups": SPELLING_SQL, "op11_merkle_manifest": merkle_sql(), "op1_mix_sources": MIX_SQL, "op4_quality_rules": QUALITY_SQL, "op6_top_k": TOPK_SQL, "op8_chat_calls": CHAT_SQL}
