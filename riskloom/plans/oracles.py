"""ANSI SQL for the registered queries that SQL can express, over the same whole tables."""

from __future__ import annotations

from riskloom.operators import encode
from riskloom.plans import config
from riskloom.plans.catalog import CATS, EXPECTED, VEC, gene_sql
from riskloom.sources.views import APPS_SQL, DOCS_SQL, ITEM_KEYS, ITEMS_SQL, SCORED_SQL, VECS_SQL

KEYS = ", ".join(ITEM_KEYS)


def md5_long(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 12) AS BIGINT)"


SPLIT = f"""{APPS_SQL},
sized AS (SELECT count(*) AS n FROM apps),
ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || "ID")) AS pos FROM apps),
cut AS (SELECT ranked.*, CASE WHEN pos <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS part FROM ranked, sized)"""


def stratified(view: str, label: str, out: str) -> str:
    return f"""{view},
c AS (SELECT {label}, count(*) AS n FROM apps GROUP BY 1),
t AS (SELECT sum(n) AS total, ceil(0.2 * sum(n)) AS want FROM c),
f AS (SELECT {label}, floor(want * n / total) AS base, want * n / total - floor(want * n / total) AS rest, want FROM c, t),
take AS (SELECT {label}, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, CAST({label} AS VARCHAR)) <= want - sum(base) OVER () THEN 1 ELSE 0 END AS k FROM f),
r AS (SELECT "ID", {label}, row_number() OVER (PARTITION BY {label} ORDER BY md5('42:' || "ID")) AS pos FROM apps)
SELECT "ID", {label}, {out} FROM r JOIN take USING ({label})"""


def filled(c: str) -> str:
    return f"coalesce({c}, (SELECT {c} FROM apps WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}"


def codes(table: str, fitted: str, cols: list[str], keep: str) -> str:
    parts = [
        f"CAST(coalesce((SELECT r FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS r FROM (SELECT DISTINCT coalesce({c}, 'nan') AS v FROM {fitted})) m WHERE m.v = coalesce(t.{c}, 'nan')), -1) AS INTEGER) AS {c}"
        for c in cols
    ]
    return f"SELECT {keep}, {', '.join(parts)} FROM {table} t"


def knn_estimate(target: str, known: str) -> str:
    return f"""
e_{target} AS (
  SELECT known, sum(tie * take) / sum(take) AS est FROM (
    SELECT known, tie, least(w, 5 - before) AS take FROM (
      SELECT r.{known} AS known, p.{target} AS tie, p.n AS w,
             coalesce(sum(p.n) OVER (PARTITION BY r.{known} ORDER BY abs(p.{known} - r.{known}), p.{target}
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM (SELECT DISTINCT {known} FROM p WHERE {target} IS NULL AND {known} IS NOT NULL) r
      JOIN p ON p.{target} IS NOT NULL AND p.{known} IS NOT NULL)) WHERE take > 0 GROUP BY known)"""


TEXTS = f"""{APPS_SQL},
texts AS (SELECT {" || ' ' || ".join(f"'{c}_' || coalesce({c}, 'nan')" for c in CATS)} AS text, count(*) AS n FROM apps GROUP BY 1)"""

BINARY = f"""{VECS_SQL},
b AS (SELECT vec_id, v, CAST(label = 0 AS INTEGER) AS label FROM vecs)"""

VEC_OUT = ", ".join(f"round(v[{i + 1}], 6) AS {c}" for i, c in enumerate(VEC))
GAP_OUT = ", ".join(f"round(a[{i + 1}] + u * (o[{i + 1}] - a[{i + 1}]), 6) AS {c}" for i, c in enumerate(VEC))

JUDGED = f"{SCORED_SQL}, j AS (SELECT label AS y, CAST(score > 0.5 AS INTEGER) AS p FROM scored)"
CLASSES = f"""{JUDGED},
s AS (SELECT c, coalesce(hit / nullif(said, 0), 0) AS pr, coalesce(hit / nullif(tru, 0), 0) AS rc, tru FROM (
  SELECT c, sum(CASE WHEN y = c AND p = c THEN 1.0 ELSE 0 END) AS hit, sum(CASE WHEN p = c THEN 1.0 ELSE 0 END) AS said,
         sum(CASE WHEN y = c THEN 1.0 ELSE 0 END) AS tru FROM j, (SELECT unnest([0, 1]) AS c) GROUP BY c)),
m AS (SELECT c, pr, rc, coalesce(2 * pr * rc / nullif(pr + rc, 0), 0) AS f1, tru FROM s),
a AS (SELECT avg(CASE WHEN y = p THEN 1.0 ELSE 0 END) AS acc FROM j)"""


def rank_sql(cells: str) -> str:
    """AUC by average ranks and AP by thresholds, per class of cells(cls, score, hit)."""
    return f"""{cells},
g AS (SELECT cls, score, sum(hit) AS pos, sum(1 - hit) AS neg FROM cells GROUP BY 1, 2),
w AS (SELECT cls, score, pos, neg,
        sum(pos) OVER (PARTITION BY cls ORDER BY score DESC) AS tp, sum(neg) OVER (PARTITION BY cls ORDER BY score DESC) AS fp,
        sum(pos + neg) OVER (PARTITION BY cls ORDER BY score) AS upto FROM g),
m AS (SELECT cls, sum(pos) AS p, sum(neg) AS n, sum(pos * (upto - (pos + neg - 1) / 2.0)) AS ranks,
        sum(pos * (tp * 1.0 / (tp + fp))) AS area FROM w GROUP BY cls)"""


AUC = "round((ranks - p * (p + 1) / 2.0) / (p * n), 6) AS roc_auc"
AP = "round(area / p, 6) AS auprc"

RUNS = """runs AS (
  SELECT o_custkey AS run, CAST(year(o_orderdate) AS INTEGER) AS generation, o_orderkey AS individual,
         o_orderkey || ',' || o_custkey AS chromosome,
         ['logistic_regression', 'random_forest', 'gradient_boosting', 'neural_network'][o_orderkey % 4 + 1] AS model_type,
         round(o_totalprice / 500000, 2) AS fitness FROM orders)"""
BEST = RUNS + """,
best AS (SELECT run, generation, """ + ", ".join(
    f"max(CASE WHEN model_type = '{k}' THEN fitness END) AS {k}" for k in config.SPACE["model"][1]
) + " FROM runs GROUP BY run, generation)"


def decode_sql() -> str:
    """Genes joined to value tables and gathered by string_agg."""
    ranges = config.gene_ranges()
    genes = ", ".join(gene_sql(i, r) for i, r in enumerate(ranges))
    methods, values = [], []
    for stage, (gene, names, params) in config.SPACE.items():
        methods += [f"('{stage}', {gene}, {i}, '{m}')" for i, m in enumerate(names)]
        for m, entries in params.items():
            for order, (p, g, vals) in enumerate(entries):
                for i in range(ranges[g]):
                    known = i < len(vals) and vals[i] is not None
                    if known or p in config.KEEP_NONE:
                        shown = config.value_text(vals[i]) if known else "None"
                        values.append(f"('{stage}', '{m}', {order}, '{p}', {g}, {i}, '{shown}')")
    cols = ", ".join(
        f"max(CASE WHEN stage = '{s}' THEN method END) AS {s}_method, max(CASE WHEN stage = '{s}' THEN params END) AS {s}_params"
        for s in config.STAGES
    )
    return f"""WITH t AS (SELECT o_orderkey, [{genes}] AS genes FROM orders),
methods(stage, gene, code, method) AS (VALUES {', '.join(methods)}),
vals(stage, method, pos, name, gene, code, shown) AS (VALUES {', '.join(values)}),
chosen AS (SELECT o_orderkey, genes, stage, method FROM t JOIN methods m ON t.genes[m.gene + 1] = m.code),
parts AS (SELECT c.o_orderkey, c.stage, c.method,
    coalesce(string_agg(v.name || '=' || v.shown, ',' ORDER BY v.pos), '') AS params
  FROM chosen c LEFT JOIN vals v ON v.stage = c.stage AND v.method = c.method AND v.code = c.genes[v.gene + 1]
  GROUP BY 1, 2, 3)
SELECT o_orderkey, {cols} FROM parts GROUP BY o_orderkey"""


def prepared_sql() -> str:
    """The flagship preparation: fills, quartile filter, codes and scaling learned on train rows."""
    cols = ["o_totalprice", "c_acctbal", *CATS]
    numbers, texts = cols[:2], cols[2:]
    fill = [f"coalesce({c}, (SELECT median({c}) FROM t)) AS {c}" for c in numbers]
    fill += [f"coalesce({c}, (SELECT {c} FROM t WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}" for c in texts]
    q = ", ".join(f"quantile_cont({c}, 0.25) AS {c}_a, quantile_cont({c}, 0.75) AS {c}_b" for c in numbers)
    inside = " AND ".join(f"{c} BETWEEN {c}_a - 1.5 * ({c}_b - {c}_a) AND {c}_b + 1.5 * ({c}_b - {c}_a)" for c in numbers)
    maps = ", ".join(f"{c}_m AS (SELECT {c}, row_number() OVER (ORDER BY {c}) - 1 AS code FROM (SELECT DISTINCT {c} FROM k))" for c in texts)
    joins = " ".join(f"LEFT JOIN {c}_m USING ({c})" for c in texts)
    coded = ", ".join([*numbers, *[f"CAST(coalesce({c}_m.code, -1) AS DOUBLE) AS {c}" for c in texts]])
    stats = ", ".join(f"avg({c}) AS {c}_u, stddev_pop({c}) AS {c}_s" for c in cols)
    out = ", ".join(f"round(({c} - {c}_u) / {c}_s, 6) AS {c}" for c in cols)
    return f"""WITH {SPLIT}, t AS (SELECT * FROM cut WHERE part = 'train'),
f AS (SELECT "ID", part, {', '.join(fill)} FROM cut),
q AS (SELECT {q} FROM f WHERE part = 'train'),
k AS (SELECT f.* FROM f, q WHERE part = 'train' AND {inside}),
{maps},
e AS (SELECT "ID", {coded} FROM f {joins}),
s AS (SELECT {stats} FROM e WHERE "ID" IN (SELECT "ID" FROM k))
SELECT {out} FROM e, s"""


def grow(label: str, key: str, table: str) -> str:
    return f"""n AS (SELECT {label} AS c, count(*) AS n FROM {table} GROUP BY 1),
g AS (SELECT c, n, (SELECT max(n) FROM n) - n AS g FROM n),
d AS (SELECT c, n, unnest(range(g)) AS j FROM g),
spot AS (SELECT {key}, {label} AS c, row_number() OVER (PARTITION BY {label} ORDER BY md5('42:' || {key})) - 1 AS pos FROM {table})"""


def _split(name: str, rows: str, features: list[str], sums: list[str], leaf: int, least: int = 2) -> str:
    """CTE ``name(node, j, cut)``: for each node of ``rows`` the cut that lowers the squared error (or Gini impurity) of the sums most."""
    cells = " UNION ALL ".join(f"SELECT node, {j} AS j, {x} AS x, {', '.join(f'{y} AS s{k}' for k, y in enumerate(sums))} FROM {rows}" for j, x in enumerate(features))
    total = ", ".join(f"sum(s{k}) AS s{k}" for k in range(len(sums)))
    run = ", ".join(f"sum(s{k}) OVER (PARTITION BY node, j ORDER BY x) AS l{k}, sum(s{k}) OVER (PARTITION BY node, j) AS t{k}" for k in range(len(sums)))
    gain = " + ".join(f"pow(l{k} - nl * t{k} / nt, 2)" for k in range(len(sums)))
    return f"""
{name}_v AS (SELECT node, j, x, count(*)::DOUBLE AS n, {total} FROM ({cells}) GROUP BY node, j, x),
{name}_c AS (SELECT node, j, x, lead(x) OVER (PARTITION BY node, j ORDER BY x) AS above, sum(n) OVER (PARTITION BY node, j ORDER BY x) AS nl,
  sum(n) OVER (PARTITION BY node, j) AS nt, {run} FROM {name}_v),
{name}_g AS (SELECT node, j, x + (above - x) / 2 AS cut, ({gain}) * nt / (nl * (nt - nl)) AS gain FROM {name}_c
  WHERE above IS NOT NULL AND nl >= {leaf} AND nt - nl >= {leaf} AND nt >= {max(least, 2 * leaf)}),
{name} AS (SELECT node, arg_min(j, k) AS j, arg_min(cut, k) AS cut FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY round(gain, 9) DESC, j, cut) AS k FROM {name}_g) WHERE k = 1 GROUP BY node)"""


def _stump_fill(table: str, target: str, by: str, name: str) -> str:
    """CTE ``name``: ``table`` with the holes of ``target`` filled by one split of ``by``; h_ columns flag holes."""
    return f"""
{name}_r AS (SELECT 0 AS node, {by} AS x, {target} AS y FROM {table} WHERE NOT h_{target}),
{_split(f"{name}_s", f"{name}_r", ["x"], ["y"], 1)},
{name}_m AS (SELECT x > cut AS side, avg(y) AS fill FROM {name}_r, {name}_s GROUP BY 1),
{name} AS (SELECT t.* REPLACE (CASE WHEN h_{target} THEN fill ELSE {target} END AS {target}) FROM {table} t, {name}_s s JOIN {name}_m m ON m.side = (t.{by} > s.cut))"""


_STUMP = f"""start AS (SELECT {KEYS}, coalesce(l_discount, avg(l_discount) OVER ()) AS l_discount, coalesce(l_tax, avg(l_tax) OVER ()) AS l_tax,
  l_discount IS NULL AS h_l_discount, l_tax IS NULL AS h_l_tax, count(l_discount) OVER () >= count(l_tax) OVER () AS discount_first FROM items),
{_stump_fill("start", "l_discount", "l_tax", "a1")}, {_stump_fill("a1", "l_tax", "l_discount", "a2")},
{_stump_fill("start", "l_tax", "l_discount", "b1")}, {_stump_fill("b1", "l_discount", "l_tax", "b2")}
SELECT {KEYS}, round(l_discount, 6) AS l_discount, round(l_tax, 6) AS l_tax FROM (SELECT * FROM a2 WHERE discount_first UNION ALL SELECT * FROM b2 WHERE NOT discount_first)"""

_MONEY = "money AS (SELECT \"ID\", o_totalprice AS x0, coalesce(c_acctbal, 0) AS x1, label, o_orderstatus FROM apps)"

_TREE = f"""{_MONEY},
n0 AS (SELECT *, 0 AS node, label::DOUBLE AS y1, 1.0 - label AS y0 FROM money),
{_split("s0", "n0", ["x0", "x1"], ["y0", "y1"], 20, 100)},
n1 AS (SELECT n0.* REPLACE (CASE WHEN CASE j WHEN 0 THEN x0 ELSE x1 END > cut THEN 2 ELSE 1 END AS node) FROM n0, s0),
{_split("s1", "n1", ["x0", "x1"], ["y0", "y1"], 20, 100)},
n2 AS (SELECT n1.* REPLACE (CASE WHEN cut IS NULL THEN n1.node WHEN CASE j WHEN 0 THEN x0 ELSE x1 END > cut THEN 2 * n1.node + 2 ELSE 2 * n1.node + 1 END AS node) FROM n1 LEFT JOIN s1 USING (node))
SELECT "ID", round(avg(label) OVER (PARTITION BY node), 6) AS p FROM n2"""

_CLASSES = ("'F'", "'O'", "'P'")
_ROUND = f"""{_MONEY},
prior AS (SELECT {", ".join(f"avg((o_orderstatus = {c})::INT) AS p{k}" for k, c in enumerate(_CLASSES))} FROM money),
r AS (SELECT "ID", x0, x1, 0 AS node, {", ".join(f"(o_orderstatus = {c})::INT - p{k} AS y{k}, p{k}" for k, c in enumerate(_CLASSES))} FROM money, prior),
{",".join(_split(f"s{k}", "r", ["x0", "x1"], [f"y{k}"], 1) for k in range(3))},
{",".join(f"""
d{k} AS (SELECT "ID", CASE j WHEN 0 THEN x0 ELSE x1 END > cut AS side, y{k} AS y FROM r, s{k}),
f{k} AS (SELECT "ID", 0.5 * 2 / 3.0 * sum(y) OVER (PARTITION BY side) / sum(abs(y) * (1 - abs(y))) OVER (PARTITION BY side) AS v{k} FROM d{k})""" for k in range(3))},
e AS (SELECT "ID", {", ".join(f"p{k} * exp(v{k}) AS e{k}" for k in range(3))} FROM r JOIN f0 USING ("ID") JOIN f1 USING ("ID") JOIN f2 USING ("ID"))
SELECT "ID", {", ".join(f"round(e{k} / (e0 + e1 + e2), 6) AS p{k}" for k in range(3))} FROM e"""


def oracle_sql() -> dict[str, str]:
    apps = f"WITH {APPS_SQL}"
    items = f"WITH {ITEMS_SQL}"
    stats_cols = ["l_quantity", "l_discount", "l_tax", "l_cents"]
    corr_cols = ["ID", "o_totalprice", "c_acctbal", "label"]
    app_cols = ["ID", "o_totalprice", "c_acctbal", "c_mktsegment", "o_orderpriority", "o_orderstatus", "label"]
    return {
        "csv_source": """SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
            CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS c_acctbal,
            CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer""",
        "two_file_input": """SELECT o_orderkey, o_totalprice, o_orderstatus,
            CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey * 2 END AS only_train,
            CASE WHEN o_orderkey % 4 <> 0 THEN 'train' ELSE 'test' END AS _split FROM orders""",
        "holdout_split": f'WITH {SPLIT} SELECT "ID", label, part AS _split FROM cut',
        "processed_sink": f'WITH {SPLIT} SELECT "ID", label, part FROM cut',
        "stratified_split": "WITH " + stratified(APPS_SQL, "o_orderstatus", "CASE WHEN pos <= k THEN 'test' ELSE 'train' END AS _split"),
        "evaluation_split": "WITH " + stratified(APPS_SQL, "label", "CASE WHEN pos <= k THEN 'validation_set_from_train' ELSE 'train' END AS part"),
        "drop_columns": f"{apps} SELECT o_totalprice, c_acctbal, c_mktsegment, o_orderpriority, o_orderstatus, label FROM apps",
        "drop_duplicate_columns": "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders",
        "target_coerce": """SELECT o_orderkey,
            CAST((SELECT count(*) FROM (SELECT DISTINCT o_orderstatus AS s FROM orders) d WHERE d.s < o.o_orderstatus) AS INTEGER) AS o_orderstatus_code,
            CAST(o_orderkey % 5 AS INTEGER) AS grade_code, CAST(trunc(o_totalprice / 100000) AS INTEGER) AS size_code FROM orders o""",
        "target_label_encode": "SELECT event_id, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INTEGER) AS code FROM events",
        "align_features": f"{items} SELECT {KEYS}, l_tax, l_quantity, 0.0::DOUBLE AS absent_feature, l_discount FROM items",
        "alignment_report": items + " " + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", '{'present' if c in EXPECTED else 'extra'}' AS status, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_share FROM items"
            for c in ["l_quantity", "l_discount", "l_tax", "l_linestatus"]
        ) + " UNION ALL SELECT 'absent_feature', 'missing', NULL",
        "missing_summary": f"""{apps}, m AS ({' UNION ALL '.join(f"SELECT '{c}' AS col, count(*) - count(" + f'"{c}"' + ") AS nulls FROM apps" for c in app_cols)})
            SELECT col AS "column", nulls, CAST((SELECT sum(nulls) FROM m) AS BIGINT) AS total FROM m WHERE nulls > 0""",
        "numeric_stats": items + " " + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", round(avg({c}), 2) AS mean, round(median({c}), 2) AS median, round(stddev_samp({c}), 2) AS std, round(CAST(min({c}) AS DOUBLE), 2) AS min, round(CAST(max({c}) AS DOUBLE), 2) AS max FROM items"
            for c in stats_cols
        ),
        "target_distribution": f"{apps} SELECT c_mktsegment AS value, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 6) AS percent FROM apps GROUP BY 1",
        "target_correlations": apps + " " + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(corr(CAST(\"{c}\" AS DOUBLE), CAST(label AS DOUBLE)), 6) AS correlation FROM apps" for c in corr_cols
        ),
        "impute_mode": f"{apps} SELECT \"ID\", {', '.join(filled(c) for c in CATS)} FROM apps",
        "impute_categorical": f"""{apps}, b AS (SELECT "ID", CASE WHEN "ID" % 13 = 0 OR "ID" % 17 = 0 OR "ID" % 19 = 0 THEN NULL ELSE c_mktsegment END AS s, o_orderstatus FROM apps)
            SELECT "ID", coalesce(s, (SELECT s FROM b WHERE s IS NOT NULL GROUP BY s ORDER BY count(*) DESC, s LIMIT 1)) AS c_mktsegment, o_orderstatus FROM b""",
        "impute_median": f'{apps} SELECT "ID", round(coalesce(c_acctbal, (SELECT median(c_acctbal) FROM apps)), 6) AS c_acctbal FROM apps',
        "impute_median_stateful": f"WITH {SPLIT} SELECT \"ID\", round(coalesce(c_acctbal, (SELECT median(c_acctbal) FROM cut WHERE part = 'train')), 6) AS c_acctbal FROM cut",
        "impute_knn": f"""{items}, p AS (SELECT l_discount, l_tax, count(*) AS n FROM items GROUP BY 1, 2),{knn_estimate('l_discount', 'l_tax')},{knn_estimate('l_tax', 'l_discount')}
            SELECT {KEYS}, round(coalesce(l_discount, ed.est, (SELECT avg(l_discount) FROM items)), 6) AS l_discount,
                   round(coalesce(l_tax, et.est, (SELECT avg(l_tax) FROM items)), 6) AS l_tax
            FROM items LEFT JOIN e_l_discount ed ON l_discount IS NULL AND ed.known = l_tax
                       LEFT JOIN e_l_tax et ON l_tax IS NULL AND et.known = l_discount""",
        "impute_final_sweep": f"{apps} SELECT \"ID\", coalesce(c_acctbal, 0) AS c_acctbal, coalesce(c_mktsegment, '__UNKNOWN_FINAL__') AS c_mktsegment FROM apps",
        "outlier_iqr": """WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
            SELECT event_id, user_id, value FROM events, q WHERE NOT (value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a))""",
        "encode_onehot": f"{apps} SELECT \"ID\", " + ", ".join(
            f"CAST(coalesce({c}, 'nan') = '{v}' AS INTEGER)::DOUBLE AS \"{c}_{v}\""
            for c, vs in {
                "c_mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "nan"],
                "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
                "o_orderstatus": ["F", "O", "P"],
            }.items() for v in vs
        ) + " FROM apps",
        "encode_onehot_drop_first": f"""{apps} SELECT "ID", o_orderpriority, CAST(o_orderstatus = 'O' AS INTEGER)::DOUBLE AS "o_orderstatus_O",
            CAST(o_orderstatus = 'P' AS INTEGER)::DOUBLE AS "o_orderstatus_P" FROM apps""",
        "encode_label": f"{apps}, fitted AS (SELECT * FROM apps WHERE o_orderpriority <> '5-LOW') " + codes("apps", "fitted", CATS, '"ID"'),
        "encode_ordinal": f"{items}, fitted AS (SELECT * FROM items WHERE l_returnflag <> 'R') " + codes("items", "fitted", ["l_returnflag", "l_linestatus"], KEYS),
        "encode_word2vec": f"{apps} SELECT \"ID\", " + ", ".join(
            f"(('0x' || substr(md5('{encode.VECTOR_SEED}:{c}:' || coalesce({c}, 'nan') || ':{i}'), 1, 12))::BIGINT / 281474976710656::DOUBLE - 0.5) / 25::DOUBLE AS {c}_w2v_{i}"
            for c in CATS for i in range(25)) + " FROM apps",
        "rows_to_text": f"{apps} SELECT \"ID\", " + " || ' ' || ".join(f"'{c}_' || coalesce({c}, 'nan')" for c in CATS) + " AS text FROM apps",
        "encode_tfidf": f"""WITH {TEXTS},
            w AS (SELECT text, n, regexp_extract_all(lower(text), '\\w\\w+') AS ws FROM texts),
            grams AS (SELECT text, n, unnest(ws) AS term FROM w
              UNION ALL SELECT text, n, ws[i] || ' ' || ws[i + 1] AS term FROM (SELECT text, n, ws, unnest(range(1, len(ws))) AS i FROM w)),
            tf AS (SELECT text, n, term, count(*) AS tf FROM grams GROUP BY 1, 2, 3),
            total AS (SELECT sum(n) AS r FROM texts),
            df AS (SELECT term, sum(n) AS df FROM tf GROUP BY 1),
            idf AS (SELECT term, ln((1 + r) / (1.0 + df)) + 1 AS idf FROM df, total WHERE df >= 5 AND df <= 0.5 * r),
            x AS (SELECT text, n, term, tf * idf AS x FROM tf JOIN idf USING (term))
            SELECT text, n, term, round(x / sqrt(sum(x * x) OVER (PARTITION BY text)), 6) AS tfidf FROM x""",
        "encode_lsa_cosines": f"""WITH {TEXTS},
            w AS (SELECT text, n, regexp_extract_all(lower(text), '\\w\\w+') AS ws FROM texts),
            grams AS (SELECT text, n, unnest(ws) AS term FROM w
              UNION ALL SELECT text, n, ws[i] || ' ' || ws[i + 1] AS term FROM (SELECT text, n, ws, unnest(range(1, len(ws))) AS i FROM w)),
            tf AS (SELECT text, n, term, count(*) AS tf FROM grams GROUP BY 1, 2, 3),
            total AS (SELECT sum(n) AS r FROM texts),
            df AS (SELECT term, sum(n) AS df FROM tf GROUP BY 1),
            idf AS (SELECT term, ln((1 + r) / (1.0 + df)) + 1 AS idf FROM df, total WHERE df >= 5 AND df <= 0.5 * r),
            x AS (SELECT text, term, tf * idf AS x FROM tf JOIN idf USING (term)),
            u AS (SELECT text, term, x / sqrt(sum(x * x) OVER (PARTITION BY text)) AS u FROM x),
            p AS (SELECT a.text, b.text AS text_b FROM texts a JOIN texts b ON split_part(a.text, ' ', 1) = split_part(b.text, ' ', 1) AND a.text <= b.text)
            SELECT p.text, p.text_b, round(coalesce(sum(c.u * d.u), 0), 5) + 0.0::DOUBLE AS cosine
            FROM p LEFT JOIN u c ON c.text = p.text LEFT JOIN u d ON d.text = p.text_b AND d.term = c.term GROUP BY 1, 2""",
        "impute_forest_stump": f"{items}, {_STUMP}",
        "random_forest_tree": f"{apps}, {_TREE}",
        "gradient_boosting_round": f"{apps}, {_ROUND}",
        "impute_iterative_rf_cells": f"{items} SELECT {KEYS}, l_discount AS l_discount_observed, true AS l_discount_in_range, l_tax AS l_tax_observed, true AS l_tax_in_range FROM items",
        "impute_missforest_mixed_cells": f"{apps} SELECT \"ID\", " + ", ".join(
            f"{c} AS {c}_observed, true AS {c}_in_range" for c in ("o_totalprice", "c_acctbal", "c_mktsegment", "o_orderstatus")) + " FROM apps",
        "bundle_agrees": f"{apps} SELECT \"ID\", true AS agrees, true AS prediction_fits, true AS is_probability FROM apps",
        "encode_leave_one_out": f"{apps}, a AS (SELECT avg(label) AS prior FROM apps) SELECT \"ID\", " + ", ".join(
            f"round(CASE WHEN count(*) OVER (PARTITION BY {c}) > 1 THEN (sum(label) OVER (PARTITION BY {c}) - label) / (count(*) OVER (PARTITION BY {c}) - 1.0::DOUBLE) ELSE prior END, 6) AS {c}"
            for c in CATS
        ) + ", label FROM apps, a",
        "class_targets": f"""WITH {DOCS_SQL}, n AS (SELECT toxic, count(*) AS n FROM docs GROUP BY 1),
            lim AS (SELECT max(n) AS big, min(n) AS small FROM n),
            r(rule) AS (VALUES ('oversample auto'), ('oversample minority'), ('oversample 0.5'), ('undersample auto'), ('undersample 0.5'))
            SELECT toxic, n, CAST(CASE rule WHEN 'oversample auto' THEN big WHEN 'oversample minority' THEN big
              WHEN 'oversample 0.5' THEN CASE WHEN n = small THEN greatest(n, CAST(floor(big * 0.5) AS BIGINT)) ELSE n END
              WHEN 'undersample auto' THEN small
              ELSE CASE WHEN n = big THEN CASE WHEN small / 0.5 <= big THEN CAST(floor(small / 0.5) AS BIGINT) ELSE n END ELSE n END END AS BIGINT) AS target, rule
            FROM n, lim, r""",
        "resample_oversample": f"""WITH {DOCS_SQL}, {grow('toxic', 'doc_id', 'docs')},
            t AS (SELECT c, pos, count(*) AS times FROM (SELECT c, {md5_long("'42:base'", 'c', 'j')} % n AS pos FROM d) GROUP BY 1, 2)
            SELECT doc_id, spot.c AS toxic, unnest(range(0, coalesce(times, 0) + 1)) AS _copy FROM spot LEFT JOIN t USING (c, pos)""",
        "resample_undersample": f"""WITH {DOCS_SQL} SELECT doc_id, toxic FROM (
            SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY md5('42:' || doc_id)) AS pos FROM docs)
            WHERE pos <= (SELECT min(n) FROM (SELECT count(*) AS n FROM docs GROUP BY toxic))""",
        "resample_smote": f"""WITH {BINARY}, {grow('label', 'vec_id', 'b')},
            m AS (SELECT b.vec_id, b.v, b.label, spot.pos FROM b JOIN spot USING (vec_id) WHERE b.label = (SELECT c FROM g WHERE g > 0)),
            nb AS (SELECT x.vec_id, y.v AS o, row_number() OVER (PARTITION BY x.vec_id ORDER BY list_distance(x.v, y.v), y.vec_id) AS rk
                   FROM m x JOIN m y ON x.vec_id <> y.vec_id),
            dr AS (SELECT c, j, {md5_long("'42:base'", 'c', 'j')} % n AS pos, {md5_long("'42:near'", 'c', 'j')} % 5 + 1 AS rk,
                   {md5_long("'42:gap'", 'c', 'j')} / 281474976710656.0::DOUBLE AS u FROM d),
            s AS (SELECT m.vec_id, m.label, dr.j + 1 AS _copy, m.v AS a, nb.o, u FROM dr JOIN m USING (pos) JOIN nb ON nb.vec_id = m.vec_id AND nb.rk = dr.rk)
            SELECT vec_id, label, 0::BIGINT AS _copy, {VEC_OUT} FROM b UNION ALL SELECT vec_id, label, _copy, {GAP_OUT} FROM s""",
        "resample_adasyn": f"""WITH {BINARY}, {grow('label', 'vec_id', 'b')},
            mc AS (SELECT c FROM g WHERE g > 0),
            near AS (SELECT x.vec_id, y.label AS other, row_number() OVER (PARTITION BY x.vec_id ORDER BY list_distance(x.v, y.v), y.vec_id) AS rk
                   FROM b x JOIN b y ON x.vec_id <> y.vec_id WHERE x.label = (SELECT c FROM mc)),
            rt AS (SELECT vec_id, sum(CASE WHEN other <> (SELECT c FROM mc) THEN 1 ELSE 0 END) / 5.0::DOUBLE AS r FROM near WHERE rk <= 5 GROUP BY 1),
            w AS (SELECT vec_id, CAST(round_even(r / (SELECT sum(r) FROM rt) * (SELECT g FROM g WHERE g > 0), 0) AS BIGINT) AS k FROM rt),
            m AS (SELECT vec_id, v, label FROM b WHERE label = (SELECT c FROM mc)),
            nb AS (SELECT x.vec_id, y.v AS o, row_number() OVER (PARTITION BY x.vec_id ORDER BY list_distance(x.v, y.v), y.vec_id) AS rk
                   FROM m x JOIN m y ON x.vec_id <> y.vec_id),
            e AS (SELECT vec_id, unnest(range(1, k + 1)) AS _copy FROM w WHERE k > 0),
            dr AS (SELECT vec_id, _copy, {md5_long("'42:near'", '(SELECT c FROM mc)', 'vec_id', '_copy')} % 5 + 1 AS rk,
                   {md5_long("'42:gap'", '(SELECT c FROM mc)', 'vec_id', '_copy')} / 281474976710656.0::DOUBLE AS u FROM e),
            s AS (SELECT m.vec_id, m.label, _copy, m.v AS a, nb.o, u FROM dr JOIN m USING (vec_id) JOIN nb ON nb.vec_id = m.vec_id AND nb.rk = dr.rk)
            SELECT vec_id, label, 0::BIGINT AS _copy, {VEC_OUT} FROM b UNION ALL SELECT vec_id, label, _copy, {GAP_OUT} FROM s""",
        "scale_standard": f"""{apps}, s AS (SELECT avg(o_totalprice) AS m1, stddev_pop(o_totalprice) AS s1, avg(c_acctbal) AS m2, stddev_pop(c_acctbal) AS s2 FROM apps)
            SELECT "ID", round((o_totalprice - m1) / s1, 6) AS o_totalprice, round((c_acctbal - m2) / s2, 6) AS c_acctbal FROM apps, s""",
        "scale_minmax": f"""{apps}, s AS (SELECT min(o_totalprice) AS a1, max(o_totalprice) AS b1, min(c_acctbal) AS a2, max(c_acctbal) AS b2 FROM apps)
            SELECT "ID", round((o_totalprice - a1) / (b1 - a1), 6) AS o_totalprice, round((c_acctbal - a2) / (b2 - a2), 6) AS c_acctbal, 0.0::DOUBLE AS constant FROM apps, s""",
        "scale_test": f"""WITH {SPLIT}, s AS (SELECT stddev_pop(o_totalprice) AS s1 FROM cut WHERE part = 'train')
            SELECT "ID", round(o_totalprice / s1, 6) AS o_totalprice, 1.0::DOUBLE AS extra FROM cut, s WHERE part = 'test'""",
        "scale_on_score": f"""{apps}, s AS (SELECT min(o_totalprice) AS a, max(o_totalprice) AS b FROM apps)
            SELECT "ID", round((o_totalprice * 1.5::DOUBLE - 100.0::DOUBLE - a) / (b - a), 6) AS o_totalprice FROM apps, s""",
        "metric_accuracy": f"WITH {CLASSES} SELECT round(acc, 6) AS accuracy FROM a",
        "metric_f1": f"""WITH {CLASSES} SELECT round(max(CASE WHEN c = 1 THEN f1 END), 6) AS f1_score, round(sum(f1 * tru) / sum(tru), 6) AS f1_score_weighted,
            round(max(acc), 6) AS f1_score_micro, round(avg(f1), 6) AS f1_score_macro FROM m, a""",
        "metric_precision_recall": f"WITH {CLASSES} SELECT round(pr, 6) AS precision, round(rc, 6) AS recall FROM m WHERE c = 1",
        "metric_roc_auc": "WITH " + rank_sql(SCORED_SQL + ", cells AS (SELECT 1 AS cls, score, label AS hit FROM scored)") + f" SELECT {AUC} FROM m",
        "metric_auprc": "WITH " + rank_sql(SCORED_SQL + ", cells AS (SELECT 1 AS cls, score, label AS hit FROM scored)") + f" SELECT {AP} FROM m",
        "metric_multiclass": "WITH " + rank_sql("""e AS (SELECT event_id, dense_rank() OVER (ORDER BY event_type) - 1 AS y FROM events),
            k AS (SELECT unnest(range(max(y) + 1)) AS cls FROM e),
            cells AS (SELECT CAST(cls AS INTEGER) AS cls, ((event_id * 7919 + cls * 1009) % 1000) / 1000.0::DOUBLE AS score, CAST(y = cls AS INTEGER) AS hit FROM e, k)"""
        ) + f" SELECT cls, {AUC}, {AP} FROM m",
        "classification_report": f"""WITH {CLASSES},
            l AS (SELECT CAST(c AS VARCHAR) AS class, unnest(['precision', 'recall', 'f1-score', 'support']) AS metric, unnest([pr, rc, f1, tru]) AS value FROM m
              UNION ALL SELECT 'accuracy', 'accuracy', acc FROM a
              UNION ALL SELECT 'macro avg', unnest(['precision', 'recall', 'f1-score', 'support']), unnest([avg(pr), avg(rc), avg(f1), sum(tru)]) FROM m
              UNION ALL SELECT 'weighted avg', unnest(['precision', 'recall', 'f1-score', 'support']),
                unnest([sum(pr * tru) / sum(tru), sum(rc * tru) / sum(tru), sum(f1 * tru) / sum(tru), sum(tru)]) FROM m)
            SELECT class, metric, round(value, 6) AS value FROM l""",
        "decode_trials": decode_sql(),
        "generation_best": f"""WITH {RUNS} SELECT run, generation, fitness AS best_fitness, chromosome AS best_chromosome, model_type AS best_model_type
            FROM (SELECT *, row_number() OVER (PARTITION BY run, generation ORDER BY fitness DESC, individual) AS rk FROM runs) WHERE rk = 1""",
        "best_by_model": f"WITH {BEST} SELECT * FROM best",
        "fitness_carry_forward": f"WITH {BEST} SELECT run, generation, " + ", ".join(
            f"last_value({k} IGNORE NULLS) OVER (PARTITION BY run ORDER BY generation ROWS UNBOUNDED PRECEDING) AS {k}" for k in config.SPACE["model"][1]
        ) + " FROM best",
        "elite_topk": f"WITH {RUNS} SELECT run, individual, fitness FROM runs ORDER BY fitness DESC, individual LIMIT 250",
        "format_results": f"""WITH {SCORED_SQL} SELECT event_id, score, label, CAST(score > 0.5 AS INTEGER) AS prediction,
            round(1.0::DOUBLE - score, 6) AS probability_class_0, round(score, 6) AS probability_class_1, round(score, 6) AS credit_score,
            CASE WHEN score > 0.7 THEN 'Low' WHEN score > 0.4 THEN 'Medium' ELSE 'High' END AS risk_level FROM scored""",
        "predictions_sink": f"""WITH {SCORED_SQL} SELECT event_id, score, CAST(label AS BIGINT) AS label, CAST(score > 0.5 AS BIGINT) AS prediction,
            round(1.0::DOUBLE - score, 6) AS probability_class_0, round(score, 6) AS probability_class_1, round(score, 6) AS credit_score,
            CASE WHEN score > 0.7 THEN 'Low' WHEN score > 0.4 THEN 'Medium' ELSE 'High' END AS risk_level FROM scored""",
        "score_preprocess": prepared_sql(),
        "risk_level": f"""WITH {SCORED_SQL} SELECT event_id, CASE WHEN score > 0.7 THEN 'Low' WHEN score > 0.4 THEN 'Medium' ELSE 'High' END AS risk_level,
            CASE WHEN score > 0.7 THEN 'High' WHEN score > 0.4 THEN 'Medium' ELSE 'Low' END AS risk_reversed FROM scored""",
    }
