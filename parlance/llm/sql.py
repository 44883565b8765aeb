"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

_HOST_RULES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, u.word, u.i FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d) x,
  LATERAL (SELECT unnest(ws) AS word, generate_subscripts(ws, 1) AS i) u),
t AS (
  SELECT r, i, word, lead(word, 1) OVER p AS b, lead(word, 2) OVER p AS c FROM w WINDOW p AS (PARTITION BY r ORDER BY i)),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, word, b, c) AS n FROM t WHERE c IS NOT NULL),
rep AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM g, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY r),
ws AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY r),
ls AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT d.r, doc_id, source, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN ws ON d.r = ws.r LEFT JOIN ls ON d.r = ls.r LEFT JOIN rep ON d.r = rep.r),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source AS host, count(*) AS host_docs, sum(CASE WHEN base_failed THEN 1 ELSE 0 END) AS host_failures FROM f GROUP BY source),
p AS (SELECT avg(host_failures / host_docs) AS m, var_pop(host_failures / host_docs) AS v FROM h),
s AS (SELECT m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 0), 1e9) ELSE 1e9 END AS s FROM p),
j AS (SELECT host, host_docs, host_failures, (host_failures + m * s) / (host_docs + s) AS host_rate FROM h, s)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND host_rate <= 0.5 AS kept, host, CAST(host_docs AS BIGINT) AS host_docs,
  CAST(host_failures AS BIGINT) AS host_failures, host_rate
FROM f JOIN j ON f.source IS NOT DISTINCT FROM j.host
"""

_CONTAINED = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
q AS (SELECT item_id, text FROM benchmark),
dw AS (SELECT r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM d),
qw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM q),
ql AS (SELECT item_id, ws, least(len(ws), 5) AS k FROM qw WHERE len(ws) > 0),
qu AS (SELECT item_id, k, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM ql),
qt AS (SELECT item_id, k, i, word, lead(word, 1) OVER p AS b, lead(word, 2) OVER p AS c, lead(word, 3) OVER p AS d, lead(word, 4) OVER p AS e
  FROM qu WINDOW p AS (PARTITION BY item_id ORDER BY i)),
qs AS (SELECT DISTINCT item_id, k, concat_ws(' ', word, b, c, d, e) AS g FROM qt WHERE k = 5 AND e IS NOT NULL OR k < 5 AND i = 1),
qn AS (SELECT item_id, k, count(*) AS n_item FROM qs GROUP BY item_id, k),
ks AS (SELECT DISTINCT k FROM qs),
du AS (SELECT r, doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM dw),
dt AS (SELECT r, doc_id, i, word, lead(word, 1) OVER p AS b, lead(word, 2) OVER p AS c, lead(word, 3) OVER p AS d, lead(word, 4) OVER p AS e
  FROM du WINDOW p AS (PARTITION BY r ORDER BY i)),
dg AS (SELECT DISTINCT r, doc_id, k, concat_ws(' ', word, CASE WHEN k > 1 THEN b END, CASE WHEN k > 2 THEN c END, CASE WHEN k > 3 THEN d END, CASE WHEN k > 4 THEN e END) AS g
  FROM dt, ks WHERE CASE k WHEN 1 THEN word WHEN 2 THEN b WHEN 3 THEN c WHEN 4 THEN d ELSE e END IS NOT NULL),
hit AS (SELECT r, doc_id, item_id, qs.k, count(*) AS n_common FROM dg JOIN qs ON dg.g = qs.g AND dg.k = qs.k GROUP BY r, doc_id, item_id, qs.k)
SELECT doc_id, item_id, n_item, n_common FROM hit JOIN qn USING (item_id, k) WHERE 100 * n_common >= 80 * n_item
"""

_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS sha FROM p),
g AS (SELECT sha, max(page_id) AS first, count(*) AS copies FROM h GROUP BY sha),
b AS (SELECT h.*, first, copies FROM h JOIN g USING (sha)),
c AS (SELECT page_id, k, CAST(concat('0x', substr(sha, 5 * k + 1, 5)) AS BIGINT) AS v FROM b, (SELECT unnest(range(8)) AS k)),
d AS (SELECT page_id, string_agg(concat(
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v // 32768 AS INT) + 1, 1), substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v // 1024 % 32 AS INT) + 1, 1),
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v // 32 % 32 AS INT) + 1, 1), substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v % 32 AS INT) + 1, 1)), '' ORDER BY k) AS payload_digest
  FROM c GROUP BY page_id)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM b JOIN d USING (page_id)
"""

_PREFERENCE = """
WITH t AS (
  SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, coalesce(role, 'unknown'), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
a AS (SELECT conv_id, i, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS q, count(*) OVER (PARTITION BY conv_id) AS m FROM t WHERE role = 'assistant'),
c AS (SELECT conv_id, i AS cut, row_number() OVER (ORDER BY conv_id) AS k, count(*) OVER () AS n FROM a WHERE q = (m + 1) // 2),
p AS (
  SELECT x.conv_id, x.cut, y.conv_id AS mate, y.cut AS mate_cut
  FROM c x JOIN c y ON y.k = CASE WHEN x.k % 2 = 0 OR x.k = x.n THEN x.k - 1 ELSE x.k + 1 END),
ch AS (SELECT t.conv_id, i AS j, role, text FROM t JOIN p ON t.conv_id = p.conv_id),
rj AS (
  SELECT p.conv_id, i AS j, role, text FROM t JOIN p ON t.conv_id = p.conv_id WHERE i < cut
  UNION ALL SELECT p.conv_id, cut + i - mate_cut, role, text FROM t JOIN p ON t.conv_id = p.mate WHERE i >= mate_cut),
d AS (
  SELECT coalesce(ch.conv_id, rj.conv_id) AS conv_id, coalesce(ch.j, rj.j) AS j, ch.role IS NOT NULL AND rj.role IS NOT NULL AND ch.role = rj.role AND ch.text = rj.text AS same
  FROM ch FULL JOIN rj ON ch.conv_id = rj.conv_id AND ch.j = rj.j),
l AS (SELECT conv_id, min(CASE WHEN same THEN j + 1000000000 ELSE j END) AS first, max(j) AS longest FROM d GROUP BY conv_id),
s AS (SELECT conv_id, CASE WHEN first > 1000000000 THEN longest ELSE first - 1 END AS common FROM l),
r AS (
  SELECT side, conv_id, j, concat('<|', role, '|>', chr(10), text, '<|end|>', chr(10)) AS shown,
    concat(repeat('0', length(role) + 5), repeat(CASE WHEN role = 'assistant' THEN '1' ELSE '0' END, length(text) + 8)) AS mask
  FROM (SELECT 'yes' AS side, * FROM ch UNION ALL SELECT 'no', * FROM rj) b)
SELECT s.conv_id AS pair_id, CAST(common AS BIGINT) AS n_prompt_turns,
  coalesce(string_agg(shown, '' ORDER BY j) FILTER (WHERE side = 'yes' AND j <= common), '') AS prompt,
  coalesce(string_agg(shown, '' ORDER BY j) FILTER (WHERE side = 'yes' AND j > common), '') AS chosen,
  coalesce(string_agg(mask, '' ORDER BY j) FILTER (WHERE side = 'yes' AND j > common), '') AS chosen_mask,
  coalesce(string_agg(shown, '' ORDER BY j) FILTER (WHERE side = 'no' AND j > common), '') AS rejected,
  coalesce(string_agg(mask, '' ORDER BY j) FILTER (WHERE side = 'no' AND j > common), '') AS rejected_mask,
  count(*) FILTER (WHERE side = 'yes' AND j > common) > 0 AND count(*) FILTER (WHERE side = 'no' AND j > common) > 0 AS usable
FROM s JOIN r ON s.conv_id = r.conv_id GROUP BY s.conv_id, common
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_COLLOCATIONS = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]') AS ps FROM documents),
p AS (SELECT id, lang, unnest(ps) AS piece, generate_subscripts(ps, 1) AS p FROM d),
w AS (SELECT id, lang, p, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
u AS (SELECT id, lang, p, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
t AS (SELECT lang, x, lead(x, 1) OVER o AS x2, lead(x, 2) OVER o AS x3, lead(x, 3) OVER o AS x4 FROM u WINDOW o AS (PARTITION BY id, p ORDER BY i)),
g AS (
  SELECT lang, 1 AS n, x AS phrase FROM t UNION ALL SELECT lang, 2, concat(x, ' ', x2) FROM t WHERE x2 IS NOT NULL
  UNION ALL SELECT lang, 3, concat(x, ' ', x2, ' ', x3) FROM t WHERE x3 IS NOT NULL
  UNION ALL SELECT lang, 4, concat(x, ' ', x2, ' ', x3, ' ', x4) FROM t WHERE x4 IS NOT NULL),
f AS (SELECT lang, n, phrase, count(*) AS f, string_split(phrase, ' ') AS ws FROM g GROUP BY lang, n, phrase HAVING count(*) >= 30),
k AS (
  SELECT c.lang, c.n, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, (CAST(c.f AS HUGEINT) * 2000000) // (CAST(l.f AS HUGEINT) + r.f) AS score
  FROM f c, (SELECT unnest([1, 2, 3]) AS k), f l, f r
  WHERE k < c.n AND l.lang = c.lang AND r.lang = c.lang AND l.phrase = array_to_string(c.ws[1:k], ' ') AND r.phrase = array_to_string(c.ws[k + 1:], ' ')),
s AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM k),
i AS (
  SELECT lang, array_to_string(ws[b:b + m - 1], ' ') AS phrase, max(f) AS most
  FROM f, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS b) WHERE m < n AND b + m - 1 <= n GROUP BY ALL),
j AS (SELECT s.* FROM s LEFT JOIN i ON s.lang = i.lang AND s.phrase = i.phrase WHERE place = 1 AND (most IS NULL OR 100 * CAST(most AS HUGEINT) < 80 * CAST(a AS HUGEINT))),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM j),
q AS (SELECT lang, count(*) AS words FROM g WHERE n = 1 GROUP BY lang)
SELECT z.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(words AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM z JOIN q ON z.lang = q.lang WHERE rank <= 2000
"""


def _edit(letter: str, cost: str, plan: str) -> str:
    return f"{{'c': {plan}.c + {cost}, 'a': concat('{letter}', {plan}.a)}}"


def _least(*plans: str) -> str:
    return f"list_min([{', '.join(plans)}])"


def _inserts(state: str) -> str:
    """The least plan from a state when turns may be inserted before the next."""
    one, two = _edit("I", "3", "e2"), _edit("I", "6", "{'c': e3.c, 'a': concat('I', e3.a)}")
    return {"e3": _least("e3", one), "e2": _least("e2", _edit("I", "3", "e3"))}.get(state) or _least(state, one, two)


def _turn(state: int, given: int, *keeps: tuple[str, int]) -> str:
    """The least plan from a state over a turn: delete, change the role, keep one of the initials that may follow."""
    kept = [_edit("K", f"t + CASE WHEN bad OR initial <> '{i}' THEN 1000000000 ELSE 0 END", f"v{to}") for i, to in keeps]
    return _least(_edit("D", "4", f"v{state}"), _edit("R", "3 + t + CASE WHEN bad THEN 1000000000 ELSE 0 END", f"v{given}"), *kept)


_SOLID = r"[^\x20\x09-\x0D]"
_REPAIR = rf"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS key FROM conversations),
b AS (SELECT *, list_transform(range(8 * length(key)), lambda i: CAST((ascii(substr(key, CAST(i // 8 + 1 AS BIGINT), 1)) >> CAST(i % 8 AS INT)) & 1 AS UBIGINT)) AS bits FROM c),
h AS (
  SELECT *, xor(list_reduce([4294967295::UBIGINT] || bits, lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (xor(x, y) & 1))), 4294967295::UBIGINT) % 20 AS kind FROM b),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM h, (SELECT unnest([1, 2]) AS copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
s AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen, substr(role, 1, 1) AS initial,
    regexp_extract(text, '({_SOLID})[\x20\x09-\x0D]*$', 1) AS last, lead(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS follows FROM o),
f AS (
  SELECT *, last = '' OR seen AS bad, CASE WHEN last <> '' AND NOT seen AND last NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS t FROM s),
m AS (
  SELECT conv_id, count(*) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, sum(CASE WHEN last = '' THEN 1 ELSE 0 END) AS blank,
    sum(CASE WHEN last <> '' AND seen THEN 1 ELSE 0 END) AS duplicate, sum(t) // 3 AS truncated,
    sum(CASE WHEN follows IS NOT NULL AND concat(initial, follows) NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END) AS illegal
  FROM f GROUP BY conv_id),
dp AS (
  SELECT conv_id, n AS i, {{'c': 0::BIGINT, 'a': ''}} AS e0, {{'c': 1000000000::BIGINT, 'a': ''}} AS e1, {{'c': 1000000000::BIGINT, 'a': ''}} AS e2,
    {{'c': 0::BIGINT, 'a': ''}} AS e3 FROM m
  UNION ALL
  SELECT conv_id, i - 1, {_turn(0, 2, ("s", 1), ("u", 2))}, {_turn(1, 2, ("u", 2))}, {_turn(2, 3, ("a", 3))}, {_turn(3, 2, ("u", 2))}
  FROM (
    SELECT dp.conv_id, dp.i, initial, bad, t, {_inserts("e0")} AS v0, {_inserts("e1")} AS v1, {_inserts("e2")} AS v2, {_inserts("e3")} AS v3
    FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i)),
z AS (SELECT conv_id, {_inserts("e0")} AS best FROM dp WHERE i = 0),
x AS (
  SELECT conv_id, best, unnest(list_transform(range(1, length(best.a) + 1), lambda k: substr(best.a, CAST(k AS BIGINT), 1))) AS letter,
    unnest(range(1, length(best.a) + 1)) AS k FROM z),
y AS (
  SELECT *, sum(CASE WHEN letter = 'I' THEN 0 ELSE 1 END) OVER w AS at, sum(CASE WHEN letter = 'D' THEN 0 ELSE 1 END) OVER w AS place
  FROM x WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
l AS (
  SELECT y.conv_id, k, letter, place, CASE WHEN letter = 'I' THEN '' ELSE text END AS text, role,
    max(CASE WHEN place = 1 AND letter = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY y.conv_id) AS led
  FROM y LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM y.conv_id AND f.i = y.at WHERE letter <> 'D'),
r AS (
  SELECT conv_id, string_agg(concat(CASE WHEN letter = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END, ':', text), chr(10) ORDER BY k) AS said
  FROM l GROUP BY conv_id)
SELECT k.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
  coalesce(best.a, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN m ON m.conv_id IS NOT DISTINCT FROM k.conv_id
LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM k.conv_id LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM k.conv_id
"""

ORACLES = {
    "op5_host_rules": _HOST_RULES,
    "op7_decontamination": _CONTAINED,
    "op8_warc": _WARC,
    "op10_preference_format": _PREFERENCE,
    "op11_collocations": _COLLOCATIONS,
    "op12_conversation_repair": _REPAIR,
}
