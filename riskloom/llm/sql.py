"""The operators that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

_LOWER = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(text: str) -> str:
    """List of the words of a text: runs without space and the controls 9 to 13."""
    return f"regexp_extract_all(coalesce({text}, ''), '[^\\x20\\x09-\\x0D]+')"


def shingles(table: str, key: str, size: int = 5) -> str:
    """(key, g): the distinct runs of words; a shorter text has its whole sequence."""
    return f"""
    SELECT DISTINCT k, array_to_string(w[p:p + {size - 1}], ' ') AS g, len(w[p:p + {size - 1}]) AS run FROM (
      SELECT k, w, unnest(range(1, greatest(len(w) - {size - 1}, 1) + 1)) AS p
      FROM (SELECT {key} AS k, {words(_LOWER.format(t='text'))} AS w FROM {table}) WHERE len(w) > 0)"""


CONTAINED = f"""
WITH d AS ({shingles('documents', 'doc_id')}), i AS ({shingles('benchmark', 'item_id')}),
n AS (SELECT k, count(*) AS n FROM i GROUP BY k)
SELECT d.k AS doc_id, i.k AS item_id, count(*) AS n_shared, any_value(n.n) AS n_item, count(*) / any_value(n.n) AS containment
FROM d JOIN i ON d.g = i.g AND d.run = i.run JOIN n ON n.k = i.k
GROUP BY d.k, i.k HAVING 100 * count(*) >= 75 * any_value(n.n)"""

JACCARD = f"""
WITH RECURSIVE s AS ({shingles('documents', 'doc_id')}), n AS (SELECT k, count(*) AS n FROM s GROUP BY k),
link AS (
  SELECT a.k AS a, b.k AS b FROM s a JOIN s b ON a.g = b.g AND a.run = b.run AND a.k <> b.k
  JOIN n x ON x.k = a.k JOIN n y ON y.k = b.k GROUP BY a.k, b.k
  HAVING 100 * count(*) >= 75 * (any_value(x.n) + any_value(y.n) - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, link.b FROM reach r JOIN link ON r.b = link.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents LEFT JOIN n ON n.k = doc_id JOIN c ON c.a = doc_id"""

LINES = f"""
WITH l AS (SELECT doc_id, unnest(x) AS line, unnest(range(len(x))) AS k FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
m AS (SELECT *, {_LOWER.format(t="trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l),
o AS (SELECT key, max(doc_id) AS keeper FROM m WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (keeper <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM m LEFT JOIN o USING (key) GROUP BY doc_id"""

QUALITY = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text, {words('text')} AS w FROM documents),
w AS (SELECT doc_id, w, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
g AS (SELECT doc_id, word, p, n, array_to_string(w[p:p + n - 1], ' ') AS g FROM w, (VALUES (3), (5), (8), (12)) AS s(n) WHERE p + n - 1 <= len(w)),
t AS (SELECT doc_id, p, n, count(*) OVER (PARTITION BY doc_id, n, g) > 1 AS twice FROM g),
c AS (SELECT doc_id, n, unnest(range(p, p + n)) AS p FROM t WHERE twice),
r AS (SELECT doc_id, count(*) FILTER (n = 3) AS r3, coalesce(sum(length(word)) FILTER (n = 5), 0) AS c5, coalesce(sum(length(word)) FILTER (n = 8), 0) AS c8,
  coalesce(sum(length(word)) FILTER (n = 12), 0) AS c12 FROM (SELECT DISTINCT doc_id, n, p FROM c) JOIN w USING (doc_id, p) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
lc AS (SELECT doc_id, line, count(*) AS n FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line),
q AS (SELECT doc_id, sum(n - 1) AS dup, sum(CASE WHEN n > 1 THEN n * length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) ELSE 0 END) AS chars FROM lc GROUP BY doc_id),
a AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(r3, 0) AS n_repeat_words, coalesce(chars, 0)::BIGINT AS dup_line_chars,
  coalesce(c5, 0)::BIGINT AS dup_5gram_chars, coalesce(c8, 0)::BIGINT AS dup_8gram_chars, coalesce(c12, 0)::BIGINT AS dup_12gram_chars
  FROM d LEFT JOIN r USING (doc_id) LEFT JOIN q USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * dup_line_chars <= 45 * word_chars
    AND 100 * dup_5gram_chars <= 50 * word_chars AND 100 * dup_8gram_chars <= 47 * word_chars AND 100 * dup_12gram_chars <= 44 * word_chars AS kept
FROM a"""

WARC = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)"""

def mixing(table: str = "documents", rounds: int = 30, temper: tuple[float, float, float] = (0.5, 0.7, 1.0), seed: int = 17, digits: int = 9, keep: float = 0.65) -> str:
    """Common table expressions that end in ``mixed``: the drawn documents of a table, a share ``keep`` of its tokens on average."""
    axes = ("source", "lang", "topic")

    def marks(chars: str) -> str:
        return " + ".join(f"length(t) - length(replace(t, '{c}', ''))" for c in chars)

    power = ", ".join(f"pow(sum(tokens) OVER (PARTITION BY {a}) / sum(tokens) OVER (), {p}) AS {a}_p, tokens / sum(tokens) OVER (PARTITION BY {a}) AS {a}_s" for a, p in zip(axes, temper, strict=True))
    target = ", ".join(f"{a}_p / sum({a}_p * {a}_s) OVER () AS {a}_t" for a in axes)
    turn = " ".join(f"WHEN {k} THEN weight * {a}_t / sum(weight) OVER (PARTITION BY {a})" for k, a in enumerate(axes))
    return f"""
mx AS (SELECT * EXCLUDE (t), CASE
    WHEN ({marks('|')}) * 50 > length(t) THEN 'table' WHEN ({marks('#*$%&')}) * 20 > length(t) THEN 'symbols'
    WHEN t <> lower(t) AND t = upper(t) THEN 'shouting' WHEN contains(t, 'License') THEN 'licence' ELSE 'prose' END AS topic,
    len({words('t')}) AS n_tokens, ('0x' || substr(md5('{seed}:' || doc_id), 1, 12))::BIGINT / 281474976710656.0 AS u
  FROM (SELECT *, coalesce(text, '') AS t FROM {table})),
mc AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM mx WHERE n_tokens > 0 GROUP BY ALL),
mp AS (SELECT *, {power} FROM mc),
mt AS (SELECT *, {target} FROM mp),
mw(k, source, lang, topic, tokens, source_t, lang_t, topic_t, weight) AS (
  SELECT 0, source, lang, topic, tokens, source_t, lang_t, topic_t, tokens / sum(tokens) OVER () FROM mt UNION ALL
  SELECT k + 1, source, lang, topic, tokens, source_t, lang_t, topic_t, CASE k % 3 {turn} END FROM mw WHERE k < {3 * rounds}),
mf AS (SELECT *, weight / tokens AS factor FROM mw WHERE k = {3 * rounds}),
ml AS (SELECT *, {keep} * sum(tokens) OVER () AS budget,
  sum(tokens) OVER (ORDER BY factor DESC) + (sum(weight) OVER () - sum(weight) OVER (ORDER BY factor DESC)) / factor <= {keep} * sum(tokens) OVER () AS clipped FROM mf),
ms AS (SELECT *, (budget - coalesce(sum(tokens) FILTER (clipped) OVER (), 0)) / sum(weight) FILTER (NOT clipped) OVER () AS scale FROM ml),
mg AS (SELECT source, lang, topic, round(weight, {digits}) AS cell_weight, round(CASE WHEN clipped THEN 1 ELSE least(1, scale * factor) END, {digits}) AS chance, clipped FROM ms),
mixed AS (SELECT mx.*, CASE WHEN n_tokens > 0 THEN cell_weight ELSE 0 END AS cell_weight, CASE WHEN n_tokens > 0 THEN chance ELSE 0 END AS chance,
  u < CASE WHEN n_tokens > 0 THEN chance ELSE 0 END AS sampled, coalesce(clipped, false) AS is_clipped FROM mx LEFT JOIN mg USING (source, lang, topic))"""


MIXING = f"WITH RECURSIVE {mixing()} SELECT doc_id, source, lang, topic, n_tokens, cell_weight, chance, sampled, is_clipped AS clipped FROM mixed"

#: The 256 remainders of the cyclic redundancy check, made by its rule.
_REMAINDERS = (
    "SELECT list_transform(range(256), lambda b: list_reduce([b] || [0, 0, 0, 0, 0, 0, 0, 0], "
    "lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tbl")


def crc32(codes: str) -> str:
    """Unsigned CRC-32 of a list of byte values, where ``tbl`` holds the remainders."""
    return f"xor(4294967295, list_reduce([4294967295] || {codes}, lambda a, b: xor(a >> 8, tbl[(xor(a, b) & 255) + 1])))"


_FIELD = "CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"


def merkle(table: str = "documents") -> str:
    """Leaves, subroots, root and folded proofs of a table; trees are grown and proofs folded level by level."""
    head = " || ".join(_FIELD.format(c=c) for c in ("doc_id", "source", "lang", "n_chars"))
    low = _LOWER.format(t="text")

    def tree(name: str, leaves: str) -> str:
        return f"""
{name}(k, s, r, n, digest) AS (SELECT 0, s, r, n, digest FROM {leaves} UNION ALL
  SELECT k + 1, s, r // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY r)) FROM {name} WHERE n > 1 GROUP BY k, s, r // 16, n),
{name}_p AS (SELECT k, s, r, n, digest, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
  coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
  FROM {name} WINDOW w AS (PARTITION BY k, s, r // 16 ORDER BY r))"""

    def fold(name: str, nodes: str, begin: str) -> str:
        return f"""
{name}(x, s, r, k, acc, proof) AS ({begin} UNION ALL
  SELECT x, f.s, f.r // 16, f.k + 1, sha256(lft || acc || rgt), proof || lft || rgt FROM {name} f JOIN {nodes} p ON p.k = f.k AND p.s = f.s AND p.r = f.r WHERE p.n > 1)"""

    return f"""
WITH RECURSIVE c AS ({_REMAINDERS}),
d AS (SELECT doc_id, source, sha256({head} || {_FIELD.format(c='text')}) AS digest, sha256({head} || {_FIELD.format(c=low)}) AS lowered,
  {crc32("list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)")} % 5 = 0 AS tampered FROM {table}, c),
l AS (SELECT *, row_number() OVER () AS x, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM d),
{tree('low', 'l')},
g AS (SELECT 0 AS s, s AS r, count(*) OVER () AS n, digest FROM low WHERE n = 1),
{tree('high', 'g')},
{fold('up', 'low_p', "SELECT x, s, r, 0, CASE WHEN tampered THEN lowered ELSE digest END, '' FROM l")},
sub AS (SELECT up.* FROM up JOIN low ON low.k = up.k AND low.s = up.s AND low.r = up.r WHERE low.n = 1),
{fold('on_top', 'high_p', "SELECT x, 0, s, 0, acc, proof FROM sub")},
e AS (SELECT o.* FROM on_top o JOIN high ON high.k = o.k AND high.r = o.r WHERE high.n = 1)
SELECT doc_id, l.digest AS leaf, g.digest AS subroot, high.digest AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = high.digest AS verified
FROM l JOIN e USING (x) JOIN g ON g.r = l.s JOIN high ON high.n = 1"""


MERKLE = merkle()

def spelling(table: str = "documents", min_chars: int = 6, min_count: int = 5, ratio: int = 5, slip: int = 199) -> str:
    """Words, their near words by shared deletions, forms and roots."""
    h = crc32("list_transform(range(1, strlen(t) + 1), lambda k: ('0x' || substr(hex(t), 2 * k - 1, 2))::BIGINT)")
    return f"""
WITH RECURSIVE c AS ({_REMAINDERS}),
r AS (SELECT coalesce(doc_id::VARCHAR, '') AS i, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM {table}),
k AS (SELECT i, {_LOWER.format(t="run")} AS run, count(*) AS n FROM r GROUP BY ALL),
b AS (SELECT i || ':' || run AS t, run, n FROM k WHERE length(run) >= {min_chars}),
o AS (SELECT run, n, {h} AS h FROM b, c),
v AS (SELECT CASE WHEN h % {slip} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM o),
w AS (SELECT word, sum(n)::BIGINT AS n FROM v WHERE length(word) >= {min_chars} GROUP BY word HAVING sum(n) >= {min_count}),
e AS (SELECT word, n, p, left(word, p) || substr(word, p + 2) AS rest FROM (SELECT *, unnest(range(length(word))) AS p FROM w)),
x AS (SELECT a.word, a.n, z.word AS other, z.n AS other_n FROM e a JOIN e z ON a.p = z.p AND a.rest = z.rest AND a.word <> z.word
  UNION SELECT e.word, e.n, w.word, w.n FROM e JOIN w ON w.word = e.rest UNION SELECT w.word, w.n, e.word, e.n FROM e JOIN w ON w.word = e.rest),
g AS (SELECT word, count(*) AS n_near, max(other_n) AS top FROM x GROUP BY word),
f AS (SELECT x.word, min(other) AS form, any_value(other_n) AS form_n FROM x JOIN g ON g.word = x.word AND x.other_n = g.top WHERE top >= {ratio} * n GROUP BY x.word),
way(word, root) AS (SELECT word, word FROM w UNION ALL SELECT way.word, form FROM way JOIN f ON f.word = way.root)
SELECT w.word, f.form, way.root, n, coalesce(n_near, 0) AS n_near, form_n
FROM w LEFT JOIN g USING (word) LEFT JOIN f USING (word) JOIN way USING (word) WHERE way.root NOT IN (SELECT word FROM f)"""


SPELLING = spelling()

ORACLES = {"op8_mixing": MIXING, "op9_warc": WARC, "op5_line_dedup": LINES, "op7_quality_rules": QUALITY, "op2_decontamination": CONTAINED, "op10_jaccard_join": JACCARD,
           "op11_spelling_variants": SPELLING, "op13_merkle_manifest": MERKLE}
