"""The SQL each registered query must agree with, for DuckDB on the same tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

DAY = "date_diff('day', DATE '1970-01-01', {0})"

# Orders as statements; k orders the rows of a customer.
STATEMENTS = """
st AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderkey,
         CASE WHEN o_orderpriority <> '5-LOW'
              THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS amount,
         CASE WHEN o_orderstatus <> 'P'
              THEN CAST(round(o_totalprice * 100) AS BIGINT)::DOUBLE / 2 END AS half,
         o_orderstatus,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'NaN'
              ELSE o_orderpriority END AS o_orderpriority,
         date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 1099511627776
           + o_orderkey AS k
  FROM orders)"""

STATUS = ["F", "O", "P", "NaN"]
PRIORITY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", "NaN"]


def number_parts(col: str, kind: str, key: str = "k") -> str:
    mean = f"(sum({col})::DOUBLE / count({col}))"
    last = f"arg_max({col}, {key}) FILTER (WHERE {col} IS NOT NULL)"
    return (f"CAST({mean} AS {kind}) AS {col}_mean, CAST(max({col}) AS {kind}) AS {col}_max, "
            f"CAST({last} AS {kind}) AS {col}_last, "
            f"CAST(CAST({last} AS DOUBLE) - {mean} AS {kind}) AS {col}_diff")


def share_parts(col: str, levels: list[str], kind: str) -> str:
    return ", ".join(
        f"CAST(count(*) FILTER (WHERE {col} = '{level}')::DOUBLE / count(*) AS {kind}) "
        f'AS "{col}_{level}"' for level in levels)


def code_parts(col: str, levels: list[str], kind: str) -> str:
    codes = " ".join(f"WHEN '{level}' THEN {i}" for i, level in enumerate(levels))
    return f"CAST(CASE arg_max({col}, k) {codes} END AS {kind}) AS {col}_last"


def collapse_sql(numbers: list[str], kind: str, codes: str, categories: bool = True) -> str:
    parts = [number_parts(c, kind) for c in numbers]
    if categories:
        parts += [share_parts("o_orderstatus", STATUS, kind),
                  share_parts("o_orderpriority", PRIORITY, kind)]
    if codes:
        parts += [code_parts("o_orderstatus", STATUS, codes),
                  code_parts("o_orderpriority", PRIORITY, codes)]
    return f"WITH {STATEMENTS} SELECT o_custkey, {', '.join(parts)} FROM st GROUP BY o_custkey"


ORACLES["entity_collapse"] = collapse_sql(["amount", "half"], "FLOAT", "TINYINT")
ORACLES["entity_collapse_shuffled"] = ORACLES["entity_collapse"]
ORACLES["level_shares"] = collapse_sql([], "DOUBLE", "")
ORACLES["last_level_code"] = collapse_sql([], "DOUBLE", "INTEGER", categories=False)
ORACLES["materialize_features"] = collapse_sql(["amount", "half"], "DOUBLE", "", categories=False)

ORACLES["wide_collapse"] = f"""
WITH {STATEMENTS}, w AS (SELECT o_custkey, k, {', '.join(
    f'CASE WHEN (o_orderkey + {i}) % 7 <> 0 THEN o_orderkey * {i + 3} % 1009 END AS x{i}'
    for i in range(40))} FROM st)
SELECT o_custkey, {', '.join(number_parts(f'x{i}', 'DOUBLE') for i in range(40))}
FROM w GROUP BY o_custkey"""

ORACLES["wide_collapse_batched"] = ORACLES["wide_collapse"]

EVENT_STATEMENTS = """
ev AS (
  SELECT user_id, event_id, event_type, (epoch_us(ts), event_id) AS k,
         CASE WHEN event_type <> 'error' THEN CAST(round(value * 100) AS BIGINT) END AS amount
  FROM events)"""

ORACLES["numeric_mean_max_last_diff"] = f"""
WITH {EVENT_STATEMENTS} SELECT user_id, {number_parts('amount', 'DOUBLE')}
FROM ev GROUP BY user_id"""

EVENT_TYPES = ["click", "error", "purchase", "signup", "view", "NaN"]

ORACLES["stream_collapse"] = f"""
WITH {EVENT_STATEMENTS} SELECT user_id, {number_parts('amount', 'DOUBLE')},
  {share_parts('event_type', EVENT_TYPES, 'DOUBLE')}, {code_parts('event_type', EVENT_TYPES, 'TINYINT')}
FROM ev GROUP BY user_id"""

ORACLES["entity_uniqueness"] = """
SELECT 'statements' AS stage, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_entities,
       count(*) = count(DISTINCT o_custkey) AS is_unique FROM orders
UNION ALL
SELECT 'features', count(DISTINCT o_custkey), count(DISTINCT o_custkey), TRUE FROM orders"""

# --- categories ------------------------------------------------------------


def vocabulary_sql(source: str, col: str) -> str:
    return f"""
SELECT '{col}' AS col, level, CAST(row_number() OVER (
         ORDER BY try_cast(level AS DOUBLE) IS NULL, try_cast(level AS DOUBLE), level) - 1
       AS INTEGER) AS code
FROM (SELECT DISTINCT CAST({col} AS VARCHAR) AS level FROM {source}
      WHERE CAST({col} AS VARCHAR) <> 'NaN') t
UNION ALL
SELECT '{col}', 'NaN', CAST(count(DISTINCT {col}) FILTER (WHERE CAST({col} AS VARCHAR) <> 'NaN')
       AS INTEGER) FROM {source}"""


ORACLES["category_vocabulary"] = f"WITH {STATEMENTS} " + " UNION ALL ".join([
    vocabulary_sql("st", "o_orderstatus"), vocabulary_sql("st", "o_orderpriority"),
    vocabulary_sql("part", "p_size"), vocabulary_sql("part", "p_type")])
ORACLES["vocabulary_roundtrip"] = " UNION ALL ".join([
    vocabulary_sql("part", "p_size"), vocabulary_sql("part", "p_type")])

ORACLES["vocabulary_digest"] = " UNION ALL ".join(f"""
SELECT '{c}' AS col, substr(sha256(string_agg(level, '|' ORDER BY level)), 1, 12) AS digest
FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS level FROM part) t""" for c in ("p_size", "p_type"))

ORACLES["unseen_levels"] = """
WITH long AS (
  SELECT 'event_type' AS col, event_type AS level, ts FROM events
  UNION ALL SELECT 'props', props, ts FROM events),
known AS (SELECT DISTINCT col, level FROM long WHERE ts < TIMESTAMP '2024-01-01 01:00:00'),
counts AS (
  SELECT col, level, count(*) AS n FROM long
  WHERE (col, level) NOT IN (SELECT (col, level) FROM known) GROUP BY col, level),
placed AS (SELECT *, row_number() OVER (PARTITION BY col ORDER BY level) AS place FROM counts)
SELECT col, CAST(sum(n) AS BIGINT) AS n_rows,
       string_agg(level, '|' ORDER BY place) FILTER (WHERE place <= 5) AS levels
FROM placed GROUP BY col"""

ORACLES["level_labels"] = """
SELECT p_partkey,
       CASE WHEN p_retailprice = floor(p_retailprice)
            THEN CAST(CAST(p_retailprice AS BIGINT) AS VARCHAR)
            ELSE CAST(p_retailprice AS VARCHAR) END AS price_label,
       CASE WHEN p_type = 'SMALL' THEN 'NaN' ELSE p_type END AS type_label
FROM part"""

# --- splits and routing ----------------------------------------------------

SPLITS = """
tg AS (SELECT c_custkey AS o_custkey, CAST(c_acctbal < 0 AS INTEGER) AS target FROM customer),
placed AS (
  SELECT o_custkey, target,
         row_number() OVER (PARTITION BY target ORDER BY md5('42:' || o_custkey)) AS r,
         count(*) OVER (PARTITION BY target) AS n
  FROM tg),
assigned AS (
  SELECT o_custkey, target,
         CASE WHEN r <= n * 7 // 10 THEN 'train' WHEN r <= n * 9 // 10 THEN 'validation'
              ELSE 'test' END AS split
  FROM placed)"""
ROUTED = f"""{STATEMENTS}, {SPLITS},
routed AS (
  SELECT st.*, coalesce(split, 'train') AS split
  FROM st LEFT JOIN assigned USING (o_custkey))"""

ORACLES["stratified_split"] = f"WITH {SPLITS} SELECT o_custkey, target, split FROM assigned"
ORACLES["stratified_split_ranked"] = ORACLES["stratified_split"]
ORACLES["route_statements"] = f"WITH {ROUTED} SELECT o_orderkey, o_custkey, split FROM routed"
ORACLES["route_statements_salted"] = ORACLES["route_statements"]
ORACLES["route_statements_by_hash"] = (
    ORACLES["route_statements"].replace("FROM customer)", "FROM customer WHERE c_acctbal < 6000)"))
ORACLES["membership_filter"] = f"""
WITH {STATEMENTS}, {SPLITS} SELECT o_orderkey, o_custkey FROM st
WHERE o_custkey IN (SELECT o_custkey FROM assigned WHERE split = 'test')"""
ORACLES["remainder_filter"] = f"""
WITH {STATEMENTS}, {SPLITS} SELECT o_orderkey, o_custkey FROM st
WHERE o_custkey NOT IN (SELECT o_custkey FROM assigned WHERE split <> 'train')"""
ORACLES["split_report"] = f"""
WITH {ROUTED} SELECT split, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_entities
FROM routed GROUP BY split"""
ORACLES["class_balance"] = f"""
WITH {SPLITS} SELECT split, count(*) AS n_entities, CAST(sum(target) AS BIGINT) AS n_positive,
  round(sum(target)::DOUBLE / count(*), 6) AS positive_share FROM assigned GROUP BY split"""
ORACLES["split_overlap"] = " UNION ALL ".join(f"""
SELECT '{a}' AS split_a, '{b}' AS split_b, count(*) AS n_shared FROM (
  SELECT o_custkey FROM orders WHERE o_orderstatus = '{a}'
  INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = '{b}') t"""
    for a, b in (("F", "O"), ("F", "P"), ("O", "P")))
TWICE = SPLITS.replace("FROM customer)", """FROM (
  SELECT c_custkey, c_acctbal FROM customer UNION ALL
  SELECT c_custkey + 10000000, c_acctbal FROM customer) c)""")
ORACLES["label_coverage"] = f"""
WITH {STATEMENTS}, {TWICE} SELECT split, count(*) AS n_labelled,
  count(*) FILTER (WHERE o_custkey NOT IN (SELECT o_custkey FROM st)) AS n_never_seen
FROM assigned GROUP BY split"""
ORACLES["label_sink"] = f"""
WITH {SPLITS} SELECT split, count(*) AS n_entities, CAST(sum(target) AS BIGINT) AS n_positive
FROM assigned GROUP BY split"""
ORACLES["many_class_split"] = """
WITH placed AS (
  SELECT o_orderkey AS o_custkey, CAST(o_orderkey % 1200 AS INTEGER) AS target,
         row_number() OVER (PARTITION BY o_orderkey % 1200 ORDER BY md5('42:' || o_orderkey)) AS r,
         count(*) OVER (PARTITION BY o_orderkey % 1200) AS n FROM orders)
SELECT o_custkey, target, CASE WHEN r <= n * 7 // 10 THEN 'train' WHEN r <= n * 9 // 10 THEN 'validation'
  ELSE 'test' END AS split FROM placed"""
ORACLES["concat_splits"] = f"""
WITH {ROUTED} SELECT split, count(*) AS n_rows, CAST(sum(amount) AS BIGINT) AS amount
FROM routed GROUP BY split"""
ORACLES["split_sink"] = f"""
WITH {ROUTED} SELECT o_orderkey, o_custkey, amount FROM routed WHERE split = 'test'"""
ORACLES["stream_route"] = """
WITH placed AS (
  SELECT c_custkey AS user_id, row_number() OVER (ORDER BY md5('42:' || c_custkey)) AS r,
         count(*) OVER () AS n FROM customer),
assigned AS (
  SELECT user_id, CASE WHEN r <= n * 7 // 10 THEN 'train'
                       WHEN r <= n * 9 // 10 THEN 'validation' ELSE 'test' END AS split
  FROM placed)
SELECT event_id, user_id, coalesce(split, 'train') AS split
FROM events LEFT JOIN assigned USING (user_id)"""

# --- label joins -----------------------------------------------------------

ORACLES["features_with_labels"] = """
SELECT doc_id, lang, n_chars, quality FROM documents JOIN labels USING (doc_id)"""
ORACLES["label_audit"] = """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels)) AS n_evaluated,
  count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS n_unmatched
FROM documents"""

# --- ranking metric --------------------------------------------------------

DOCUMENT_SCORES = """
sc AS (SELECT doc_id AS id, lang AS grp, quality AS target, n_chars::DOUBLE AS prediction
       FROM documents JOIN labels USING (doc_id))"""
ORDER_SCORES = """
sc AS (SELECT o_orderkey AS id, o_orderpriority AS grp,
              CAST(o_orderstatus = 'F' AS INTEGER) AS target, o_totalprice AS prediction
       FROM orders)"""
TIED_SCORES = ORDER_SCORES.replace(
    "o_totalprice AS", "CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS")


def metric_sql(scores: str, group: str = "", columns: str | None = None) -> str:
    """The metric by its definition: running sums for the scores and for a perfect ranking."""
    part = f"PARTITION BY {group} " if group else ""
    keep = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    join = f"USING ({group})" if group else "ON TRUE"
    columns = columns or ("round(0.5 * (raw / perfect + top), 6) AS score, "
                          "round(raw / perfect, 6) AS gini, round(top, 6) AS top4, "
                          "round((raw / perfect + 1) / 2, 6) AS auc, n_rows, n_positive")
    return f"""
WITH {scores},
weighted AS (SELECT *, CASE WHEN target = 0 THEN 20 ELSE 1 END AS wgt FROM sc),
totals AS (SELECT {keep}sum(wgt)::DOUBLE AS all_w, sum(target * wgt)::DOUBLE AS pos_w,
             count(*) AS n_rows, count(*) FILTER (WHERE target = 1) AS n_positive
           FROM weighted {by}),
ranked AS (
  SELECT *, sum(wgt) OVER scored AS cum_w, sum(target * wgt) OVER scored AS cum_p,
         sum(wgt) OVER ideal AS best_w, sum(target * wgt) OVER ideal AS best_p
  FROM weighted
  WINDOW scored AS ({part}ORDER BY prediction DESC, md5(CAST(id AS VARCHAR))
                    ROWS UNBOUNDED PRECEDING),
         ideal AS ({part}ORDER BY target DESC, md5(CAST(id AS VARCHAR))
                   ROWS UNBOUNDED PRECEDING)),
sums AS (
  SELECT {keep}all_w, pos_w, n_rows, n_positive,
         sum((cum_p / pos_w - cum_w / all_w) * wgt) AS raw,
         sum((best_p / pos_w - best_w / all_w) * wgt) AS perfect,
         count(*) FILTER (WHERE target = 1 AND cum_w <= floor(0.04::DOUBLE * all_w))::DOUBLE
           / n_positive AS top
  FROM ranked JOIN totals {join} GROUP BY {keep}all_w, pos_w, n_rows, n_positive)
SELECT {f'{group} AS ' + '{name}, ' if group else ''}{columns} FROM sums"""


ORACLES["ranking_metric"] = metric_sql(DOCUMENT_SCORES)
ORACLES["ranking_metric_orders"] = metric_sql(ORDER_SCORES)
ORACLES["ranking_metric_tied"] = metric_sql(TIED_SCORES)
ORACLES["metric_by_group"] = metric_sql(ORDER_SCORES, "grp").replace("{name}", "o_orderpriority")
ORACLES["metric_by_lang"] = metric_sql(DOCUMENT_SCORES, "grp").replace("{name}", "lang")
ORACLES["gini"] = metric_sql(ORDER_SCORES, columns="round(raw / perfect, 6) AS gini")
ORACLES["top4_capture"] = metric_sql(ORDER_SCORES, columns="round(top, 6) AS top4")
ORACLES["evaluate_counts"] = metric_sql(DOCUMENT_SCORES, columns=(
    "n_rows AS n_evaluated, (SELECT count(*) FROM documents) - n_rows AS n_unmatched, "
    "round((raw / perfect + 1) / 2, 6) AS auc"))
ORACLES["metric_totals"] = f"""
WITH {ORDER_SCORES} SELECT grp AS o_orderpriority, count(*) AS n_rows,
  CAST(sum(CASE WHEN target = 0 THEN 20 ELSE 1 END) AS BIGINT) AS total_weight,
  CAST(sum(CASE WHEN target = 0 THEN 0 ELSE target END) AS BIGINT) AS positive_weight,
  count(*) FILTER (WHERE target = 1) AS n_positive
FROM sc GROUP BY grp"""


def curve_sql(scores: str, columns: str) -> str:
    return f"""
WITH {scores},
weighted AS (SELECT *, CASE WHEN target = 0 THEN 20 ELSE 1 END AS wgt FROM sc),
curve AS (
  SELECT id, CAST(sum(wgt) OVER scored AS BIGINT) AS cum_weight,
         CAST(sum(target * wgt) OVER scored AS BIGINT) AS cum_positive,
         sum(wgt) OVER () AS all_w, sum(target * wgt) OVER () AS pos_w
  FROM weighted
  WINDOW scored AS (ORDER BY prediction DESC, md5(CAST(id AS VARCHAR)) ROWS UNBOUNDED PRECEDING))
SELECT {columns} FROM curve"""


ORACLES["gain_curve"] = curve_sql(DOCUMENT_SCORES, (
    "id AS doc_id, cum_weight, cum_positive, round(cum_positive / pos_w::DOUBLE, 6) AS lorentz, "
    "round(cum_weight / all_w::DOUBLE, 6) AS random"))
ORACLES["gain_curve_orders"] = curve_sql(ORDER_SCORES, "id AS o_orderkey, cum_weight, cum_positive")

ORACLES["running_total"] = """
SELECT o_orderkey, o_orderstatus,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (
    PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, md5(CAST(o_orderkey AS VARCHAR))
    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_amount,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (PARTITION BY o_orderstatus)
    AS BIGINT) AS cum_amount_total
FROM orders"""

ORACLES["running_total_partitioned"] = ORACLES["running_total"].replace(
    "ORDER BY o_totalprice DESC", "ORDER BY CASE WHEN o_orderkey % 10 = 0 THEN 150000.0 ELSE o_totalprice END DESC")

# The round a run stops at is the first one 6 or more past its best so far.
ORACLES["best_iteration_by_run"] = """
WITH daily AS (SELECT user_id, day(ts) AS it, max(value) AS score FROM events GROUP BY ALL),
best AS (
  SELECT a.user_id, a.it, arg_max(b.it, (b.score, -b.it)) AS best_it
  FROM daily a JOIN daily b ON a.user_id = b.user_id AND b.it <= a.it
  GROUP BY a.user_id, a.it),
stop AS (
  SELECT user_id, coalesce(min(it) FILTER (WHERE it - best_it >= 6), max(it)) AS last_it
  FROM best GROUP BY user_id)
SELECT stop.user_id, CAST(best.best_it AS INTEGER) AS best_iteration, daily.score AS best_score,
       CAST(last_it AS INTEGER) AS rounds_run
FROM stop JOIN best ON best.user_id = stop.user_id AND best.it = last_it
JOIN daily ON daily.user_id = stop.user_id AND daily.it = best.best_it"""

# --- audits ----------------------------------------------------------------

ORACLES["overflow_audit"] = " UNION ALL ".join(f"""
SELECT '{c}' AS col, CAST(max(abs(CAST({c} AS FLOAT))) AS DOUBLE) AS peak FROM lineitem
HAVING max(abs(CAST({c} AS FLOAT))) > 65504"""
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))


def half_sql(col: str) -> str:
    x = f"CAST(CAST({col} AS FLOAT) AS DOUBLE)"
    unit = f"pow(2.0::DOUBLE, greatest(floor(log2({x})), -14) - 10)"
    return f"CASE WHEN {x} = 0 THEN 0 ELSE round_even({x} / {unit}, 0) * {unit} END"


ORACLES["half_precision"] = f"""
SELECT l_orderkey, l_linenumber, {half_sql('l_discount')} AS discount, {half_sql('l_tax')} AS tax,
  CASE WHEN {half_sql('l_extendedprice')} <= 65504 THEN {half_sql('l_extendedprice')} END AS price,
  {half_sql('l_extendedprice')} > 65504 AS overflows
FROM lineitem"""

ORACLES["contiguity_audit"] = """
WITH l AS (SELECT user_id, lag(user_id) OVER (ORDER BY event_id) AS prev FROM events)
SELECT count(*) FILTER (WHERE prev IS NULL OR prev <> user_id) AS n_blocks,
       count(DISTINCT user_id) AS n_entities,
       count(*) FILTER (WHERE prev IS NULL OR prev <> user_id) = count(DISTINCT user_id) AS contiguous
FROM l"""
def blocks_sql(rows: str, order: str) -> str:
    return f"""
WITH r AS ({rows}),
l AS (SELECT user_id, lag(user_id) OVER (ORDER BY {order}) AS prev FROM r)
SELECT count(*) FILTER (WHERE prev IS NULL OR prev <> user_id) AS n_blocks,
       count(DISTINCT user_id) AS n_entities,
       count(*) FILTER (WHERE prev IS NULL OR prev <> user_id) = count(DISTINCT user_id) AS contiguous
FROM l"""


ORACLES["contiguity_tied"] = blocks_sql("""
SELECT DISTINCT user_id, CASE WHEN event_id % 5 <> 0 THEN CASE WHEN event_id % 2 = 0 THEN 1000 ELSE event_id END END
  AS seq FROM events""", "seq NULLS LAST, md5(CAST(user_id AS VARCHAR))")
ORACLES["contiguity_of_files"] = blocks_sql("SELECT user_id, event_id FROM events", "user_id % 7, event_id")
ORACLES["order_audit"] = """
WITH l AS (
  SELECT o_custkey, o_orderdate,
         lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS prev FROM orders)
SELECT o_custkey, count(*) AS n_backward FROM l WHERE prev > o_orderdate GROUP BY o_custkey"""
ORACLES["entity_sample"] = f"""
WITH {STATEMENTS} SELECT o_custkey, o_orderkey, amount FROM st WHERE o_custkey IN (
  SELECT DISTINCT o_custkey FROM orders ORDER BY o_custkey LIMIT 30)"""

# How many columns each test table has.
WIDTHS = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
    "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2,
    "labels": 3, "conversations": 4,
}
ORACLES["scan_metadata"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, {n} AS n_columns FROM {t}"
    for t, n in WIDTHS.items())

# --- importance ------------------------------------------------------------

GAINS = """
g AS (
  SELECT CASE p_partkey % 8
           WHEN 0 THEN 'B_30_' || p_size WHEN 1 THEN 'D_63_' || lower(p_type)
           WHEN 2 THEN 'P_' || p_size || '_mean' WHEN 3 THEN 'P_' || p_size || '_max'
           WHEN 4 THEN 'P_' || p_size || '_last' WHEN 5 THEN 'P_' || p_size || '_diff'
           WHEN 6 THEN 'B_38_last' ELSE 'S_' || p_size END AS feature,
         CASE WHEN p_size = 7 THEN 0 ELSE CAST(round(p_retailprice * 100) AS BIGINT) END AS gain
  FROM part),
f AS (
  SELECT feature, CAST(sum(gain) AS BIGINT) AS gain, count(*) AS splits FROM g GROUP BY feature),
imp AS (
  SELECT *, 100 * gain::DOUBLE / (SELECT sum(gain) FROM f)::DOUBLE AS gain_pct,
         CASE WHEN starts_with(feature, 'B_30_') THEN 'B_30'
              WHEN starts_with(feature, 'B_38_') THEN 'B_38'
              WHEN starts_with(feature, 'D_63_') THEN 'D_63'
              ELSE regexp_replace(feature, '_(mean|max|last|diff)$', '') END AS base
  FROM f)"""
ORACLES["importance_table"] = f"""
WITH {GAINS} SELECT feature, gain, splits, round(gain_pct, 6) AS gain_pct, base FROM imp"""
ORACLES["importance_merged"] = f"""
WITH {GAINS} SELECT base AS feature, CAST(sum(gain) AS BIGINT) AS gain,
  round(sum(gain_pct), 6) AS gain_pct, CAST(sum(splits) AS BIGINT) AS splits, count(*) AS parts
FROM imp GROUP BY base"""
ORACLES["importance_topk"] = f"""
WITH {GAINS}, r AS (
  SELECT row_number() OVER (ORDER BY gain DESC, feature) AS place, feature, gain, gain_pct,
         sum(gain_pct) OVER (ORDER BY gain DESC, feature ROWS UNBOUNDED PRECEDING) AS cum_pct
  FROM imp)
SELECT CAST(place AS INTEGER) AS place, feature, gain, round(gain_pct, 6) AS gain_pct,
       round(cum_pct, 6) AS cum_pct FROM r WHERE place <= 20"""
ORACLES["unused_features"] = f"""
WITH {GAINS} SELECT count(*) AS n_features, count(*) FILTER (WHERE gain = 0) AS n_unused FROM imp"""
ORACLES["base_columns"] = f"WITH {GAINS} SELECT feature, base FROM imp"

# --- sources and sinks -----------------------------------------------------

ORACLES["csv_statements"] = f"""
WITH {STATEMENTS} SELECT o_custkey, o_orderdate, o_orderkey, amount, half, o_orderstatus,
  CASE WHEN o_orderpriority <> 'NaN' THEN o_orderpriority END AS o_orderpriority FROM st"""
ORACLES["csv_late_types"] = """
WITH o AS (
  SELECT o_orderkey, o_custkey, o_orderkey > (SELECT max(o_orderkey) FROM orders) * 0.9 AS late FROM orders)
SELECT o_orderkey, o_custkey + CASE WHEN late THEN 0.5::DOUBLE ELSE 0::DOUBLE END AS v,
  CASE WHEN late THEN 'text ' || o_orderkey END AS w FROM o"""
ORACLES["csv_strict_types"] = """
SELECT o_orderkey, ['1d', '01', '1'][o_orderkey % 3 + 1] AS level,
  CASE WHEN o_orderkey % 5 = 0 THEN '007' ELSE CAST(o_orderkey AS VARCHAR) END AS padded,
  [1000, NULL, 0.5, -12][o_orderkey % 4 + 1]::DOUBLE AS number,
  CASE WHEN o_orderkey % 2 = 0 THEN '9007199254' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') ELSE '0.5' END AS precise,
  900719925400000000 + o_orderkey AS long_key FROM orders"""
ORACLES["format_sniffing"] = f"""
WITH {STATEMENTS} SELECT kind, count(*) AS n_rows, count(amount) AS n_amounts, CAST(sum(amount) AS BIGINT) AS amount
FROM st, (VALUES ('parquet'), ('csv')) k(kind) GROUP BY kind"""
ORACLES["prediction_sink"] = """
SELECT doc_id, n_chars::DOUBLE / 8 AS prediction FROM documents JOIN labels USING (doc_id)"""

# --- lineage and runs ------------------------------------------------------



def row_text(*columns: str) -> str:
    """A row as digests see it: each value after its length, a null as a bare mark."""
    return " || '|' || ".join(
        f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns)


def digest_sum(*columns: str) -> str:
    return f"sum(CAST('0x' || substr(md5({row_text(*columns)}), 1, 8) AS BIGINT))"


ORACLES["table_digests"] = f"""
SELECT count(*) AS n_rows, CAST({digest_sum("o_orderkey", "o_custkey", "o_orderstatus",
    "CAST(round(o_totalprice * 100) AS BIGINT)")} AS VARCHAR) AS digest
FROM orders"""
ORACLES["content_digests"] = f"""
WITH h AS (SELECT sha256({row_text("o_orderkey", "o_custkey", "o_orderstatus")}) AS x FROM orders
           WHERE o_orderkey % 2 <> 1)
SELECT count(*) AS n_rows, sha256(CAST(count(*) AS VARCHAR) || ':' || {" || ':' || ".join(
    f"CAST(sum(CAST('0x' || substr(x, {8 * k + 1}, 8) AS BIGINT)) AS VARCHAR)" for k in range(8))}) AS digest
FROM h"""
ORACLES["split_id"] = f"""
WITH d AS (
  SELECT count(*) AS n, {digest_sum("c_custkey", "CAST(c_acctbal < 0 AS INTEGER)")} AS digest FROM customer),
e AS (
  SELECT count(*) AS m, {digest_sum("o_orderkey", "o_custkey", "o_orderstatus")} AS rows FROM orders)
SELECT substr(sha256(n || ':' || digest || ':' || m || ':' || rows || '|42|test=1,train=7,validation=2'), 1, 12)
  AS split_id FROM d, e"""

LATEST = """
latest AS (
  SELECT o_custkey AS artifact, o_orderkey AS record_no,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS split_id
  FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""
ORACLES["lineage_current"] = f"WITH {LATEST} SELECT artifact, record_no, split_id FROM latest"
ORACLES["same_split_guard"] = f"""
WITH {LATEST} SELECT c_nationkey, count(DISTINCT split_id) AS n_splits,
  count(*) FILTER (WHERE split_id IS NULL) AS n_unknown, count(DISTINCT split_id) <= 1 AS same_split
FROM latest JOIN customer ON c_custkey = artifact GROUP BY c_nationkey"""
ORACLES["inherited_split"] = f"""
WITH {LATEST} SELECT split_id, count(*) AS n_derived
FROM orders LEFT JOIN latest ON artifact = o_custkey GROUP BY split_id"""
ORACLES["latest_run"] = "SELECT arg_max(event_id, (ts, event_id)) AS run_id FROM events"
ORACLES["latest_run_by_user"] = """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS run_id FROM events GROUP BY user_id"""
ORACLES["best_run"] = """
SELECT user_id, event_id AS run_id, value AS score FROM events WHERE event_type <> 'error'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, ts, event_id DESC) = 1"""
ORACLES["run_log"] = """
SELECT CAST(event_id AS VARCHAR) AS run_id, CASE WHEN event_type <> 'error' THEN value END AS score,
       CAST(user_id AS VARCHAR) AS split_id FROM events"""
ORACLES["run_metadata"] = """
SELECT c_name AS run_id, c_mktsegment AS split_id, CAST(c_nationkey AS BIGINT) AS feature_version,
       c_acctbal AS score, 2 AS n_features, 'NaN' AS last_level FROM customer"""

# --- jobs ------------------------------------------------------------------

ORACLES["wide_collapse_unsequenced"] = "SELECT o_custkey, " + ", ".join(
    f"sum({v})::DOUBLE / count({v}) AS x{i}_mean, CAST(max({v}) AS DOUBLE) AS x{i}_max" for i, v in (
        (i, f"CASE WHEN (o_orderkey + {i}) % 7 <> 0 THEN o_orderkey * {i + 3} % 1009 END")
        for i in range(177))) + " FROM orders GROUP BY o_custkey"
ORACLES["running_total_of_large_keys"] = """
SELECT o_orderkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (ORDER BY o_orderkey) AS BIGINT)
  AS cum_amount FROM orders"""
ORACLES["aligned_features"] = collapse_sql(["amount", "half"], "DOUBLE", "", categories=False)
ORACLES["model_inputs"] = f"""
WITH {STATEMENTS}, f AS (SELECT o_custkey, count(amount) AS a, count(half) AS h FROM st GROUP BY o_custkey)
SELECT col || '_' || part AS feature, count(*) AS n_values,
  count(*) FILTER (WHERE CASE col WHEN 'amount' THEN a ELSE h END = 0) AS n_missing
FROM f, (VALUES ('amount'), ('half')) c(col), (VALUES ('mean'), ('max'), ('last'), ('diff')) p(part)
GROUP BY col, part"""
HELD_OUT = f"""
WITH {ROUTED}, held AS (SELECT count(DISTINCT o_custkey) AS n FROM routed WHERE split = 'test')"""
ORACLES["staged_rounds"] = f"{HELD_OUT} SELECT iteration, n AS n_rows, true AS equal FROM held, range(1, 5) r(iteration)"
ORACLES["evaluated_counts"] = f"{HELD_OUT} SELECT n AS n_evaluated, 0::BIGINT AS n_unmatched, true AS auc_in_range FROM held"
ORACLES["importance_shares"] = "SELECT unnest([" + ", ".join(f"'{name}'" for name in [
    *(f"{c}_{part}" for c in ("amount", "half") for part in ("mean", "max", "last", "diff")),
    *(f"o_orderstatus_{level}" for level in STATUS), *(f"o_orderpriority_{level}" for level in PRIORITY),
    "o_orderstatus_last", "o_orderpriority_last"]) + "]) AS feature, true AS agrees"
ORACLES["split_lineage"] = f"""
WITH {ROUTED}
SELECT 'statements' AS kind, split, count(*) AS rows, count(DISTINCT o_custkey) AS customers,
  NULL::BIGINT AS positives, 42::BIGINT AS seed, true AS same_split FROM routed GROUP BY split
UNION ALL
SELECT 'labels', split, NULL, count(*), CAST(sum(target) AS BIGINT), 42, true FROM assigned GROUP BY split"""
ORACLES["trained_run"] = f"""{HELD_OUT}
SELECT n AS n_scored, n AS n_evaluated, 0::BIGINT AS n_unlabelled, true AS logged, true AS cut_to_best,
  true AS same_split, true AS same_score, true AS refused FROM held"""
ORACLES["stopped_run"] = f"""
WITH {ROUTED}
SELECT count(DISTINCT o_custkey) AS n_validation, true AS keeps_best, true AS stops_in_time, true AS stops_early,
  true AS same_score FROM routed WHERE split = 'validation'"""
ORACLES["round_histograms"] = metric_sql("""
sc AS (SELECT o_orderkey AS id, k AS grp, CAST(o_orderstatus = 'F' AS INTEGER) AS target,
              CASE k WHEN 0 THEN o_totalprice WHEN 1 THEN -o_totalprice
                     ELSE (o_orderkey * 7919 % 1000)::DOUBLE END AS prediction
       FROM orders, (VALUES (0), (1), (2)) r(k))""", "grp").replace("{name}", "place").replace(
    "n_rows, n_positive FROM sums", "n_rows, n_positive, true AS inside FROM sums")
ORACLES["importance_report"] = """
SELECT base AS feature, parts, true AS in_share FROM (
  VALUES ('amount', 4::BIGINT), ('half', 4::BIGINT)) v(base, parts)
UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus) + 2, true FROM orders
UNION ALL SELECT 'o_orderpriority',
  count(DISTINCT o_orderpriority) FILTER (WHERE o_orderpriority <> '4-NOT SPECIFIED') + 2, true FROM orders"""
ORACLES["statement_tables"] = " UNION ALL ".join(
    f"SELECT '{name}' AS tab, count(*) AS n_rows, {'true' if name == 'orders' else 'false'} AS is_statements FROM {name}"
    for name in ("orders", "lineitem", "customer", "events", "documents"))
ORACLES["lacking_features"] = """
SELECT count(DISTINCT o_custkey) AS n_entities, true AS refused, ['o_orderstatus_P'] AS lacking FROM orders
WHERE o_orderstatus <> 'P'"""
ORACLES["stream_snapshot"] = ORACLES["stream_collapse"]
