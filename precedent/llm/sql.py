"""DuckDB SQL of the queries that SQL can express."""


def _crc32(parts: str) -> str:
    """Unsigned crc32 over a list of bytes: each byte goes in, then eight shifts (marked -1)."""
    steps = f"flatten(list_transform({parts}, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))"
    fold = "CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), lambda a, x: {fold}), 4294967295)"


#: The bytes of a text of ASCII characters.
def _ascii(text: str) -> str:
    return f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


MIX = r"""
WITH sized AS MATERIALIZED (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS draw
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight FROM sources
), leveled AS (
  -- Sources in the order in which they reach their bound; the level if all before this one are at it.
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed
  WINDOW before AS (ORDER BY 2 * source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
  SELECT arg_min(level, (2 * source_size / weight, place)) FILTER (weight * level <= 2 * source_size) AS level FROM leveled
), targets AS (
  SELECT source, source_size,
         CASE WHEN weight * chosen.level > 2 * source_size THEN (2 * source_size)::DOUBLE ELSE weight * chosen.level END AS target
  FROM weighed, chosen
), ordered AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS quota,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.draw, s.doc_id)::BIGINT - s.size AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, quota - before)) + greatest(0, least(size, quota - source_size - before)))::BIGINT AS taken
FROM ordered
"""

MERKLE = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT doc_id, source, {_leaf("text")} AS leaf,
         CASE WHEN {_crc32(_ascii("doc_id::VARCHAR"))} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS changed,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n
  FROM documents
), nodes AS (
  SELECT source, 0 AS level, pos, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT source, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3
  FROM nodes WHERE n > 1 GROUP BY source, level, pos // 3, n
), subroots AS MATERIALIZED (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, pos, subroot AS digest, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3
  FROM tops WHERE n > 1 GROUP BY level, pos // 3, n
), steps AS (
  -- Per row and level with a parent: the row's own slot, and the other nodes of its run.
  SELECT l.doc_id, x.level, x.pos, x.digest, x.pos < l.pos // (3 ** x.level)::BIGINT AS earlier
  FROM leaves l JOIN nodes x ON x.source IS NOT DISTINCT FROM l.source AND x.n > 1
    AND x.pos // 3 = l.pos // (3 ** (x.level + 1))::BIGINT
  WHERE x.pos <> l.pos // (3 ** x.level)::BIGINT
  UNION ALL
  SELECT l.doc_id, 1000 + x.level, x.pos, x.digest, x.pos < s.pos // (3 ** x.level)::BIGINT
  FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
  JOIN tops x ON x.n > 1 AND x.pos // 3 = s.pos // (3 ** (x.level + 1))::BIGINT
  WHERE x.pos <> s.pos // (3 ** x.level)::BIGINT
), sides AS MATERIALIZED (
  SELECT doc_id, level, coalesce(string_agg(digest, '' ORDER BY pos) FILTER (earlier), '') AS before,
         coalesce(string_agg(digest, '' ORDER BY pos) FILTER (NOT earlier), '') AS after
  FROM steps GROUP BY doc_id, level
), levels AS MATERIALIZED (
  -- Levels of single nodes have no siblings but hash all the same.
  SELECT doc_id, list(level ORDER BY level) AS levels FROM (
    SELECT l.doc_id, x.level FROM leaves l JOIN (SELECT DISTINCT source, level FROM nodes WHERE n > 1) x ON x.source IS NOT DISTINCT FROM l.source
    UNION ALL
    SELECT l.doc_id, 1000 + x.level FROM leaves l, (SELECT DISTINCT level FROM tops WHERE n > 1) x
  ) GROUP BY doc_id
), folds AS (
  SELECT l.doc_id, 1 AS step, l.changed AS digest, v.levels FROM leaves l LEFT JOIN levels v USING (doc_id)
  UNION ALL
  SELECT f.doc_id, f.step + 1, sha256(coalesce(s.before, '') || f.digest || coalesce(s.after, '')), f.levels
  FROM folds f LEFT JOIN sides s ON s.doc_id = f.doc_id AND s.level = f.levels[f.step]
  WHERE f.step <= len(f.levels)
), folded AS (
  SELECT doc_id, arg_max(digest, step) AS folded_root FROM folds GROUP BY doc_id
), proofs AS (
  SELECT doc_id, string_agg(before || after, '' ORDER BY level) AS proof FROM sides GROUP BY doc_id
)
SELECT l.doc_id, l.leaf, s.subroot, r.digest AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
       f.folded_root, f.folded_root = r.digest AS verified
FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
JOIN folded f USING (doc_id) LEFT JOIN proofs p USING (doc_id), (SELECT digest FROM tops WHERE n = 1) r
"""

VARIANTS = f"""
WITH RECURSIVE runs AS MATERIALIZED (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  GROUP BY ALL
), hashed AS MATERIALIZED (
  SELECT run, times, {_crc32(
      "flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),"
      " lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))"
  )} AS h
  FROM runs
), words AS MATERIALIZED (
  SELECT word, sum(times)::BIGINT AS n
  FROM (SELECT times, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word
        FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), cut AS MATERIALIZED (
  SELECT DISTINCT word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM words)
), pairs AS MATERIALIZED (
  -- One replaced character: equal without the same place. One inserted: the longer without one character is the shorter.
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS top_n FROM pairs GROUP BY word
), forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near, CASE WHEN b.top_n >= 2 * w.n THEN b.top_n END AS form_n,
         CASE WHEN b.top_n >= 2 * w.n THEN (SELECT min(p.other) FROM pairs p WHERE p.word = w.word AND p.other_n = b.top_n) END AS form
  FROM words w LEFT JOIN best b USING (word)
), chains AS (
  SELECT word, coalesce(form, word) AS root FROM forms
  UNION
  SELECT c.word, f.form FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
), roots AS (
  SELECT c.word, c.root FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM forms f JOIN roots r USING (word)
"""

ORACLE: dict[str, str] = {
    "op11_curriculum_mix": MIX,
    "op12_merkle_manifest": MERKLE,
    "op13_spelling_variants": VARIANTS,
}
