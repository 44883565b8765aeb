"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The driver tables are pre-registered as views; the derived views of
``parlance.sources.views`` are rebuilt here as CTEs with portable functions.
Percentages and averages are rounded to 6 digits on both sides.
"""

from __future__ import annotations

# --- derived views -----------------------------------------------------------

UTTERANCES = r"""
SELECT event_id AS row_id,
       event_type || ' request from user ' || CAST(user_id AS VARCHAR)
         || CASE WHEN event_id % 10 = 3 THEN ' set a timer' ELSE '' END AS transcript,
       CASE WHEN event_id < 2 THEN 'RARE_PAIR' WHEN event_id = 2 THEN 'RARE_ONE'
            ELSE upper(event_type) END AS intent,
       CASE event_id % 10
         WHEN 0 THEN '[]'
         WHEN 1 THEN 'not json'
         WHEN 2 THEN '{"id": "' || ui || '", "params": {"k": ' || n || '}}'
         WHEN 3 THEN '[{"id": "' || ui || '", "params": {"k": ' || n || ', "timer_duration": {"amount": ' || n || ', "unit": "min"}}}]'
         WHEN 4 THEN '[{"id": "' || ui || '", "params": {"tags": ["a", "b"], "label": "' || event_type || '"}}]'
         WHEN 5 THEN '[{"params": {"k": ' || n || ', "on": true}}]'
         WHEN 6 THEN '[{"id": "' || ui || '"}]'
         WHEN 7 THEN '[{"id": "' || ui || '", "params": {}}]'
         WHEN 8 THEN '[{"id": "' || ui || '", "params": {"k": "' || n || '"}}]'
         ELSE '[{"id": "' || ui || '", "params": ' || props || '}]'
       END AS nli_output,
       CAST(floor(value) AS BIGINT) AS frequency
FROM (SELECT *, regexp_extract(props, '([0-9]+)', 1) AS n,
             CASE WHEN event_id < 2 THEN 'RARE_PAIR' WHEN event_id = 2 THEN 'RARE_ONE'
                  ELSE upper(event_type) END AS ui
      FROM events) e
"""

# Annotation facts per utterance (same meaning as annotation_columns()).
ANNOTATED = r"""
SELECT u.* EXCLUDE (j), elem,
       coalesce(json_type(elem) = 'OBJECT', false) AS elem_object,
       coalesce(json_type(elem) = 'OBJECT' AND json_extract(elem, '$.params') IS NOT NULL, false) AS has_params,
       CASE WHEN json_type(elem) = 'OBJECT' AND json_extract(elem, '$.params') IS NOT NULL
            THEN CAST(json_extract(elem, '$.params') AS VARCHAR) ELSE '{}' END AS params,
       CASE WHEN json_type(elem) = 'OBJECT' THEN json_type(json_extract(elem, '$.params')) END AS params_type,
       coalesce(json_type(elem) = 'OBJECT' AND json_extract(elem, '$.id') IS NOT NULL, false) AS has_id,
       CASE WHEN json_type(elem) = 'OBJECT' THEN json_extract_string(elem, '$.id') END AS ann_id
FROM (SELECT *, j IS NOT NULL AS valid,
             coalesce(json_type(j) = 'ARRAY' AND json_array_length(j) > 0, false) AS is_list,
             CASE WHEN json_type(j) = 'ARRAY' AND json_array_length(j) > 0
                  THEN json_extract(j, '$[0]') END AS elem
      FROM (SELECT *, TRY_CAST(nli_output AS JSON) AS j FROM utterances) t) u
"""

PAIRS = r"""
SELECT row_id, transcript, intent, params,
       'nlu: ' || transcript AS input_text,
       '{"intent":' || coalesce(CAST(to_json(intent) AS VARCHAR), 'null') || ',"params":' || params || '}' AS output_text,
       frequency
FROM annotated
"""

PREDICTIONS = r"""
SELECT row_id,
       CASE row_id % 8
         WHEN 0 THEN output_text
         WHEN 1 THEN '{"intent":"UNSUPPORTED","params":' || params || '}'
         WHEN 2 THEN substr(output_text, 2, length(output_text) - 2)
         WHEN 3 THEN ''
         WHEN 4 THEN '{"intent":' || coalesce(CAST(to_json(intent) AS VARCHAR), 'null') || ',"params":{}}'
         WHEN 5 THEN '{"intent":' || coalesce(CAST(to_json(intent) AS VARCHAR), 'null') || ',"params":{"k":1,"extra":2}}'
         WHEN 6 THEN '[1]'
         ELSE '{"params":' || params || '}'
       END AS pred_text
FROM pairs
"""

REFERENCES = "SELECT row_id, output_text AS ref_text FROM pairs"

# Exact stratified split (W2): quotas by largest remainder, rank by seeded md5.
_SEED = 42
_TEST = 0.15
_VAL_RATIO = 0.15 / (0.7 + 0.15)

SPLIT_QUOTAS = f"""
SELECT intent, c, q_tv,
       CAST(base2 + CASE WHEN row_number() OVER (ORDER BY rem2 DESC, intent) <= n_tr - sum(base2) OVER ()
                         THEN 1 ELSE 0 END AS BIGINT) AS q_train
FROM (SELECT *, (CAST(q_tv AS HUGEINT) * n_tr) // n_tv AS base2, (CAST(q_tv AS HUGEINT) * n_tr) % n_tv AS rem2
      FROM (SELECT *, n_tv - CAST(ceil(CAST({_VAL_RATIO!r} AS DOUBLE) * n_tv) AS BIGINT) AS n_tr
            FROM (SELECT intent, c, n, n_tv,
                         CAST(base + CASE WHEN row_number() OVER (ORDER BY rem DESC, intent) <= n_tv - sum(base) OVER ()
                                          THEN 1 ELSE 0 END AS BIGINT) AS q_tv
                  FROM (SELECT *, (CAST(c AS HUGEINT) * n_tv) // n AS base, (CAST(c AS HUGEINT) * n_tv) % n AS rem
                        FROM (SELECT intent, c, n, n - CAST(ceil(CAST({_TEST!r} AS DOUBLE) * n) AS BIGINT) AS n_tv
                              FROM (SELECT intent, count(*) AS c FROM pairs WHERE intent IS NOT NULL
                                    GROUP BY intent HAVING count(*) >= 3) k,
                                   (SELECT CAST(sum(c) AS BIGINT) AS n
                                    FROM (SELECT count(*) AS c FROM pairs WHERE intent IS NOT NULL
                                          GROUP BY intent HAVING count(*) >= 3) kk) t) a) b) c2) d) e
"""

SPLITS = f"""
SELECT p.*, CASE WHEN rk <= q_train THEN 'train' WHEN rk <= q_tv THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY intent
                                   ORDER BY md5('{_SEED}:' || CAST(row_id AS VARCHAR)), row_id) AS rk
      FROM pairs WHERE intent IS NOT NULL) p
JOIN split_quotas q USING (intent)
"""

VIEWS = {
    "utterances": UTTERANCES,
    "annotated": ANNOTATED,
    "pairs": PAIRS,
    "predictions": PREDICTIONS,
    "references_": REFERENCES,
    "split_quotas": SPLIT_QUOTAS,
    "splits": SPLITS,
}

# Views in definition order; extended below.
_ORDER = list(VIEWS)
_DEPS: dict[str, set[str]] = {}


def with_views(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause holding ``names`` (and what they need) followed by ``body``."""
    needed = set(names)
    deps = {
        "annotated": {"utterances"},
        "pairs": {"annotated"},
        "predictions": {"pairs"},
        "references_": {"pairs"},
        "split_quotas": {"pairs"},
        "splits": {"split_quotas"},
        **_DEPS,
    }
    changed = True
    while changed:
        changed = False
        for n in list(needed):
            for d in deps.get(n, ()):
                if d not in needed:
                    needed.add(d)
                    changed = True
    parts = [f"{n} AS ({VIEWS[n]})" for n in _ORDER if n in needed]
    for n, sql in (extra or {}).items():
        parts.append(f"{n} AS ({sql})")
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body


# --- evaluation ----------------------------------------------------------------

def intent_sql(text: str, fail: str) -> str:
    """P7 (fail='PARSE_ERROR') / P8 (fail='UNKNOWN') over a text column."""
    j = f"TRY_CAST({text} AS JSON)"
    if fail == "PARSE_ERROR":
        return (
            f"CASE WHEN coalesce(json_type({j}) = 'OBJECT', false) = false THEN 'PARSE_ERROR' "
            f"WHEN json_extract({j}, '$.intent') IS NULL THEN 'UNKNOWN' "
            f"ELSE json_extract_string({j}, '$.intent') END"
        )
    return (
        f"CASE WHEN coalesce(json_type({j}) = 'OBJECT', false) AND json_extract({j}, '$.intent') IS NOT NULL "
        f"THEN json_extract_string({j}, '$.intent') ELSE 'UNKNOWN' END"
    )


ALIGNED = f"""
SELECT p.row_id, pred_text, ref_text,
       {intent_sql('pred_text', 'PARSE_ERROR')} AS intent_pred,
       {intent_sql('ref_text', 'UNKNOWN')} AS intent_true
FROM predictions p JOIN references_ r USING (row_id)
"""


def eligible_sql(text: str, out: str) -> str:
    """Rows whose text is a JSON object with object-or-missing params; params as JSON."""
    return f"""
SELECT row_id, CASE WHEN json_extract(j, '$.params') IS NULL THEN CAST('{{}}' AS JSON)
                    ELSE json_extract(j, '$.params') END AS {out}
FROM (SELECT row_id, TRY_CAST({text} AS JSON) AS j FROM aligned) s
WHERE coalesce(json_type(j) = 'OBJECT', false)
  AND coalesce(json_type(json_extract(j, '$.params')), 'OBJECT') = 'OBJECT'
"""


ELIGIBLE_PAIRS = f"""
SELECT p.row_id, pv, rv FROM ({eligible_sql('pred_text', 'pv')}) p JOIN ({eligible_sql('ref_text', 'rv')}) r USING (row_id)
"""


def flat_sql(col: str, source: str = "eligible_pairs") -> str:
    kind = (
        "CASE WHEN t.type IN ('BIGINT', 'UBIGINT', 'HUGEINT') THEN 'INT' WHEN t.type = 'DOUBLE' THEN 'FLOAT' "
        "WHEN t.type = 'VARCHAR' THEN 'STRING' ELSE t.type END"
    )
    vkey = (
        "CASE WHEN t.type IN ('BIGINT', 'UBIGINT', 'HUGEINT') THEN 'n:' || CAST(t.value AS VARCHAR) "
        "WHEN t.type = 'DOUBLE' THEN 'n:' || CASE WHEN floor(CAST(t.value AS DOUBLE)) = CAST(t.value AS DOUBLE) AND abs(CAST(t.value AS DOUBLE)) < 9.2e18 "
        "THEN CAST(CAST(CAST(t.value AS DOUBLE) AS BIGINT) AS VARCHAR) ELSE CAST(CAST(t.value AS DOUBLE) AS VARCHAR) END "
        "WHEN t.type = 'BOOLEAN' THEN 'n:' || CAST(CAST(CAST(t.value AS BOOLEAN) AS INT) AS VARCHAR) "
        "WHEN t.type = 'VARCHAR' THEN 's:' || json_extract_string(t.value, '$') "
        "WHEN t.type = 'ARRAY' THEN 'l:' || CAST(t.value AS VARCHAR) "
        "WHEN t.type = 'NULL' THEN 'null' END"
    )
    return f"""
SELECT e.row_id, substr(t.fullkey, 3) AS path, {kind} AS kind, {vkey} AS vkey
FROM {source} e, json_tree(e.{col}) t
WHERE t.type <> 'OBJECT' AND t.fullkey NOT LIKE '%[%'
"""


VIEWS.update(
    {
        "aligned": ALIGNED,
        "eligible_pairs": ELIGIBLE_PAIRS,
        "pred_flat": flat_sql("pv"),
        "ref_flat": flat_sql("rv"),
    }
)
_ORDER[:] = list(VIEWS)
_DEPS.update({
    "aligned": {"predictions", "references_"},
    "eligible_pairs": {"aligned"},
    "pred_flat": {"eligible_pairs"},
    "ref_flat": {"eligible_pairs"},
})


# --- schema mining ----------------------------------------------------------------

_KIND = (
    "CASE WHEN e.type IN ('BIGINT', 'UBIGINT', 'HUGEINT') THEN 'INT' WHEN e.type = 'DOUBLE' THEN 'FLOAT' "
    "WHEN e.type = 'VARCHAR' THEN 'STRING' ELSE e.type END"
)
_TYPE_NAME = (
    "CASE kind WHEN 'STRING' THEN 'str' WHEN 'INT' THEN 'int' WHEN 'FLOAT' THEN 'float' "
    "WHEN 'BOOLEAN' THEN 'bool' WHEN 'NULL' THEN 'NoneType' WHEN 'OBJECT' THEN 'dict' "
    "WHEN 'ARRAY' THEN 'list' END"
)
VIEWS.update(
    {
        "mined": """
SELECT row_id, transcript, CASE WHEN has_id THEN ann_id ELSE intent END AS ann_intent, params, params_type
FROM annotated WHERE elem_object
""",
        "entries": f"""
SELECT *, {_TYPE_NAME} AS type_name,
       CASE WHEN kind IN ('INT', 'FLOAT') THEN CAST(v AS DOUBLE)
            WHEN kind = 'BOOLEAN' THEN CAST(CAST(CAST(v AS BOOLEAN) AS INT) AS DOUBLE) END AS num,
       CASE WHEN kind = 'STRING' THEN json_extract_string(v, '$') END AS sval
FROM (SELECT m.row_id, m.ann_intent, e.key AS param, e.value AS v, {_KIND} AS kind
      FROM mined m, json_each(CAST(m.params AS JSON)) e WHERE m.params_type = 'OBJECT') x
""",
    }
)
_ORDER[:] = list(VIEWS)
_DEPS.update({"mined": {"annotated"}, "entries": {"mined"}})


# --- output parsing ----------------------------------------------------------------

def _strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _count_sql(x: str, ch: str) -> str:
    return f"(length({x}) - length(replace({x}, '{ch}', '')))"


def parse_single_sql(src: str, text: str) -> str:
    """Single-mode parse (strict, braces, regex; scanner rows are marked
    ``scan`` with a null result) over ``src(row_id, text)``."""
    opened = f"CASE WHEN NOT starts_with({_strip_sql('t')}, '{{') THEN '{{' || t ELSE t END"
    s0 = f"""
SELECT row_id, t, TRY_CAST(t AS JSON) IS NOT NULL AS ok0,
       CASE WHEN NOT ends_with({_strip_sql('o')}, '}}') THEN o || '}}' ELSE o END AS t13,
       regexp_extract(t, '"intent":\\s*"([^"]+)"', 1) AS found,
       CASE WHEN a = '' THEN '' WHEN strpos(substr(a, 2), '"intent"') > 0
            THEN substr(a, 1, strpos(substr(a, 2), '"intent"')) ELSE a END AS ptext
FROM (SELECT row_id, t, {opened} AS o, regexp_extract(t, '(?s)"params":\\s*(.+)', 1) AS a
      FROM (SELECT row_id, {text} AS t FROM {src}) q) z
"""
    p1 = (
        "regexp_replace(regexp_replace(regexp_replace(" + _strip_sql("ptext") + ", '\"+$', ''), ',+$', ''), '\\s+$', '')"
    )
    s1 = f"""
SELECT *, NOT ok0 AND TRY_CAST(t13 AS JSON) IS NOT NULL AS ok13,
       CASE WHEN NOT starts_with(p1, '{{') THEN '{{' || p1 ELSE p1 END AS p2
FROM (SELECT *, {p1} AS p1 FROM ({s0}) a) b
"""
    s2 = f"""
SELECT *, ok13 AND json_array_length(json_keys(TRY_CAST(t13 AS JSON))) = 0 AS empty13,
       CASE WHEN NOT ends_with(p2, '}}') THEN p2 || repeat('}}', CAST(greatest({_count_sql('p2', '{')} - {_count_sql('p2', '}')}, 0) AS BIGINT))
            ELSE p2 END AS p3,
       NOT ok0 AND NOT ok13 AND found <> '' AS try14
FROM ({s1}) c
"""
    s3 = f"""
SELECT *, try14 AND (ptext = '' OR TRY_CAST(p3 AS JSON) IS NOT NULL) AS ok14 FROM ({s2}) d
"""
    s4 = f"""
SELECT row_id, t,
  CASE WHEN ok0 THEN 'strict' WHEN ok13 AND NOT empty13 THEN 'braces' WHEN ok13 THEN 'sentinel'
       WHEN ok14 THEN 'regex' WHEN try14 THEN 'scan' ELSE 'sentinel' END AS settled_by,
  CASE WHEN ok0 THEN t WHEN ok13 AND NOT empty13 THEN t13 WHEN ok13 THEN NULL
       WHEN ok14 THEN '{{"intent":' || CAST(to_json(found) AS VARCHAR) || ',"params":'
                      || CASE WHEN ptext = '' THEN '{{}}' ELSE p3 END || '}}' END AS result
FROM ({s3}) e
"""
    return f"""
SELECT row_id, settled_by,
  CASE WHEN settled_by = 'sentinel' THEN 'PARSE_ERROR' WHEN json_type(j) = 'OBJECT' THEN json_extract_string(j, '$.intent') END AS intent,
  CASE WHEN settled_by = 'sentinel' THEN '{{}}' WHEN json_type(j) = 'OBJECT' THEN CAST(json_extract(j, '$.params') AS VARCHAR) END AS params,
  CASE WHEN settled_by = 'sentinel' THEN t END AS raw_output,
  CASE WHEN settled_by = 'sentinel' THEN 'invalid JSON' END AS error,
  CASE WHEN settled_by = 'sentinel' THEN true ELSE coalesce(json_type(j) = 'OBJECT', false) END AS is_object,
  CASE WHEN settled_by = 'sentinel' THEN true
       ELSE coalesce(json_type(j) = 'OBJECT' AND json_extract(j, '$.intent') IS NOT NULL, false) END AS has_intent,
  result
FROM (SELECT *, TRY_CAST(result AS JSON) AS j FROM ({s4}) f) g
"""
