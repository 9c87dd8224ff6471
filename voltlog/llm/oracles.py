"""SQL for another engine that gives the rows of the queries that SQL can express."""

from __future__ import annotations

from voltlog.llm.decontaminate import MASKS

JACCARD = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, [v FOR v IN regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x09-\x0D\x20]+') IF v <> ''] AS w
  FROM documents
), shingled AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS whole FROM shingled GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingled a JOIN shingled b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  WHERE 100 * least(p.n, q.n) >= 85 * greatest(p.n, q.n)
  GROUP BY a.doc_id, b.doc_id, p.n, q.n
  HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))
), reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
), smallest AS (
  SELECT x, min(y) AS component_id FROM reached GROUP BY x
), classes AS (
  SELECT whole, min(doc_id) AS class_id FROM sizes GROUP BY whole
), counted AS (
  SELECT x, count(DISTINCT q.whole) AS n_links FROM links JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE p.whole <> q.whole GROUP BY x
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(class_id, d.doc_id) AS class_id,
  coalesce(n_links, 0) AS n_links
FROM documents d JOIN smallest m ON m.x = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN counted o ON o.x = d.doc_id
LEFT JOIN classes c ON c.whole = s.whole
"""

_WORDS = r"""[v FOR v IN regexp_split_to_array(
  lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') IF v <> '']"""


def _seeds(places: str, key: str) -> str:
    """Hashable text of the words that count, for every mask."""
    each = []
    for no, mask in enumerate(MASKS):
        words = ", ".join(f"w[p + {i + 1}]" for i, c in enumerate(mask) if c == "1")
        each.append(f"SELECT {key}, p, {no} AS mask, array_to_string([{words}], ' ') AS seed FROM {places}")
    return " UNION ALL ".join(each)


_SPAN = max(map(len, MASKS))
LEAKS = f"""
WITH items AS (
  SELECT min(item_id) AS item_id, w FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) split GROUP BY w
), docs AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), item_places AS (
  SELECT item_id, w, unnest(range(0, len(w) - {_SPAN - 1})) AS p FROM items WHERE len(w) >= {_SPAN}
), doc_places AS (
  SELECT doc_id, w, unnest(range(0, len(w) - {_SPAN - 1})) AS p FROM docs WHERE len(w) >= {_SPAN}
), item_seeds AS ({_seeds("item_places", "item_id")}),
doc_seeds AS ({_seeds("doc_places", "doc_id")}),
hits AS (
  SELECT DISTINCT doc_id, item_id, d.p - i.p AS start
  FROM doc_seeds d JOIN item_seeds i ON d.mask = i.mask AND d.seed = i.seed
), laid AS (
  SELECT doc_id, item_id, start, docs.w AS dw, items.w AS iw, unnest(range(1, len(items.w) + 1)) AS j
  FROM hits JOIN docs USING (doc_id) JOIN items USING (item_id)
), steps AS (
  SELECT doc_id, item_id, start, j,
    CASE WHEN start + j >= 1 AND coalesce(dw[start + j] = iw[j], false) THEN 1 ELSE -1 END AS step
  FROM laid
), sums AS (
  SELECT *, sum(step) OVER (PARTITION BY doc_id, item_id, start ORDER BY j) AS upto FROM steps
), lows AS (
  SELECT *, least(0, coalesce(min(upto) OVER (PARTITION BY doc_id, item_id, start ORDER BY j
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS low
  FROM sums
), scored AS (
  SELECT doc_id, item_id, start, greatest(0, max(upto - low)) AS overlap, count(*) FILTER (WHERE step = 1) AS matched
  FROM lows GROUP BY doc_id, item_id, start
)
SELECT doc_id, item_id, cast(start AS int) AS start, cast(matched AS int) AS matched, cast(overlap AS int) AS overlap
FROM scored WHERE overlap >= 8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY overlap DESC, matched DESC, start) = 1
"""


def _crc32(data: str) -> str:
    """CRC-32 of a BLOB, bit by bit."""
    byte = f"cast('0x' || substr(hex({data}), cast(2 * i + 1 AS int), 2) AS bigint)"
    bits = f"flatten([[{byte}, 0, 0, 0, 0, 0, 0, 0] FOR i IN range(octet_length({data}))])"
    step = "lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))"
    return f"xor(list_reduce(list_prepend(cast(4294967295 AS bigint), {bits}), {step}), 4294967295)"


def _encoded(value: str) -> str:
    return f"coalesce(strlen(cast({value} AS varchar)) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_encoded(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _levels(start: str) -> str:
    """The nodes of all levels of the trees ``start`` (tree, level, pos, digest)."""
    return f"""{start} UNION ALL
  SELECT tree, max(level) + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS many FROM nodes_now) WHERE many > 1 GROUP BY tree, pos // 3"""


MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('+' || source, '') AS tree, {_leaf('text')} AS digest,
    CASE WHEN {_crc32("encode(cast(doc_id AS varchar))")} % 2 = 0
      THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS got
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos FROM leaves
), low AS (
  {_levels("SELECT tree, 0 AS level, pos, digest FROM placed").replace("nodes_now", "low")}
), subroots AS (
  SELECT tree, digest, level, row_number() OVER (ORDER BY tree) - 1 AS place
  FROM (SELECT * FROM low QUALIFY level = max(level) OVER (PARTITION BY tree))
), high AS (
  {_levels("SELECT 'all' AS tree, 0 AS level, place AS pos, digest FROM subroots").replace("nodes_now", "high")}
), top AS (
  SELECT digest AS root, level AS height FROM high ORDER BY level DESC LIMIT 1
), steps AS (  -- every node on the way, and its run
  SELECT p.doc_id, p.tree, p.pos AS leaf_pos, l.level AS step, l.pos,
    p.pos // cast(power(3, l.level) AS bigint) AS own, l.digest
  FROM placed p JOIN subroots s USING (tree) JOIN low l ON l.tree = p.tree AND l.level < s.level
    AND l.pos // 3 = p.pos // cast(power(3, l.level + 1) AS bigint)
  UNION ALL
  SELECT p.doc_id, p.tree, p.pos, s.level + h.level, h.pos, s.place // cast(power(3, h.level) AS bigint), h.digest
  FROM placed p JOIN subroots s USING (tree) CROSS JOIN top JOIN high h ON h.level < top.height
    AND h.pos // 3 = s.place // cast(power(3, h.level + 1) AS bigint)
), beside AS (
  SELECT tree, leaf_pos, step,
    coalesce(string_agg(digest, '' ORDER BY pos) FILTER (WHERE pos < own), '') AS before,
    coalesce(string_agg(digest, '' ORDER BY pos) FILTER (WHERE pos > own), '') AS after
  FROM steps GROUP BY tree, leaf_pos, step
), proofs AS (
  SELECT tree, leaf_pos, string_agg(before || after, '' ORDER BY step) AS siblings FROM beside GROUP BY tree, leaf_pos
), folds AS (
  SELECT tree, pos AS leaf_pos, 0 AS step, got AS digest FROM placed
  UNION ALL
  SELECT f.tree, f.leaf_pos, f.step + 1, sha256(before || f.digest || after)
  FROM folds f JOIN beside b ON b.tree = f.tree AND b.leaf_pos = f.leaf_pos AND b.step = f.step
), ends AS (
  SELECT tree, leaf_pos, arg_max(digest, step) AS folded_root FROM folds GROUP BY tree, leaf_pos
)
SELECT p.doc_id, p.digest AS leaf, s.digest AS subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM placed p JOIN subroots s USING (tree) CROSS JOIN top
JOIN ends e ON e.tree = p.tree AND e.leaf_pos = p.pos
LEFT JOIN proofs q ON q.tree = p.tree AND q.leaf_pos = p.pos
"""

SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents
  ) GROUP BY doc_id, run
), hashed AS (
  SELECT run, c, {_crc32("encode(coalesce(cast(doc_id AS varchar), '') || ':' || run)")} AS h FROM runs
  WHERE length(run) >= 6
), words AS (
  SELECT word, sum(c) AS n FROM (
    SELECT c, CASE WHEN h % 199 = 0
      THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed
  ) WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5
), shorter AS (
  SELECT word, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT DISTINCT x.word, y.word AS other FROM shorter x JOIN shorter y
    ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
  UNION SELECT s.word, w.word FROM shorter s JOIN words w ON s.rest = w.word
  UNION SELECT w.word, s.word FROM shorter s JOIN words w ON s.rest = w.word
), best AS (
  SELECT p.word, count(*) OVER (PARTITION BY p.word) AS n_near, other, o.n AS n_other
  FROM near p JOIN words o ON o.word = other
  QUALIFY row_number() OVER (PARTITION BY p.word ORDER BY o.n DESC, other) = 1
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN n_other >= 5 * w.n THEN other END AS form,
    CASE WHEN n_other >= 5 * w.n THEN n_other END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), ways AS (
  SELECT word, word AS root, 0 AS step FROM forms
  UNION ALL
  SELECT y.word, f.form, y.step + 1 FROM ways y JOIN forms f ON f.word = y.root WHERE f.form IS NOT NULL
), ends AS (
  SELECT word, arg_max(root, step) AS root FROM ways GROUP BY word
)
SELECT word, form, root, cast(n AS bigint) AS n, n_near, cast(form_n AS bigint) AS form_n FROM forms JOIN ends USING (word)
"""

_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


def _places(phrase: str) -> str:
    """Numbers, from 0, of the words at which a phrase begins."""
    parts = phrase.split()
    return f"[i - 1 FOR i IN range(1, len(w) - {len(parts) - 2}) IF " + " AND ".join(
        f"w[i + {k}] = '{part}'" for k, part in enumerate(parts)
    ) + "]"


LICENSE_BASE = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), found AS (
  SELECT doc_id, len(w) AS n_words, {", ".join(f'{_places(phrase)} AS "{label}"' for phrase, label in _PHRASES)} FROM words
), placed AS (
  SELECT *, {" || ".join(f'"{label}"' for _, label in _PHRASES)} AS places FROM found
)
SELECT doc_id, n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
  concat_ws(',', {", ".join(f"CASE WHEN len({chr(34)}{label}{chr(34)}) > 0 THEN '{label}' END" for _, label in _PHRASES)})
    AS base_labels
FROM placed
"""


def url_rules(rules: tuple[tuple[str, str], ...]) -> str:
    """Host, path, and the longest rule that fits, with its verdict."""
    given = ", ".join(f"('{verdict}', '{rule}')" for verdict, rule in rules)
    return f"""
WITH rules(verdict, rule) AS (VALUES {given}), rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), cut AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS host, rest FROM rest
), parts AS (
  SELECT page_id, translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(host) + 1), '^[^?#]*') AS path
  FROM cut
), fits AS (
  SELECT page_id, rule, verdict FROM parts JOIN rules
    ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
    AND starts_with(path, substr(rule, strpos(rule, '/')))
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) = 1
)
SELECT page_id, host, path, rule, verdict FROM parts LEFT JOIN fits USING (page_id)
"""
