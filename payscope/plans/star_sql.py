"""The same queries in SQL, for comparison on the same tables."""

from __future__ import annotations

_WS = "chr(32)||chr(9)||chr(10)||chr(13)||chr(12)||chr(11)||chr(160)"


def _trim(x: str) -> str:
    return f"trim({x}, {_WS})"


def _int(x: str) -> str:
    return f"CASE WHEN regexp_full_match({_trim(x)}, '[+-]?[0-9]+') THEN TRY_CAST({_trim(x)} AS BIGINT) END"


def _double(x: str) -> str:
    number = "[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"
    return f"CASE WHEN regexp_full_match({_trim(x)}, '{number}') THEN TRY_CAST({_trim(x)} AS DOUBLE) END"


def _date(x: str) -> str:
    iso = "[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
    return f"CASE WHEN regexp_full_match({_trim(x)}, '{iso}') THEN TRY_CAST({_trim(x)} AS DATE) END"


def _suppressed(x: str) -> str:
    return f"({x} IS NULL OR {_trim(x)} IN ('N/A', 'Not Available', ''))"


_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_CENTS = "CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR)"

def _money(x: str) -> str:
    """Two digits, half away from zero on the decimal value; a double times 100 is not."""
    return f"CAST(round(CAST({x} AS DECIMAL(30, 9)), 2) AS DOUBLE)"


# Common table expressions, each relying on those before it.
_RAW = f"""
ev AS (SELECT *, {_K} AS k, {_CENTS} AS cents FROM events),
raw AS (
  SELECT event_id, user_id AS entity_id, event_type AS measure,
    CASE WHEN k < 8 THEN 'N/A' WHEN k < 16 THEN ' Not Available' || chr(9)
         WHEN k < 22 THEN '  ' WHEN k < 28 THEN NULL WHEN k < 32 THEN 'Too Few To Report'
         WHEN k < 34 THEN 'Not Applicable' WHEN k < 36 THEN 'nan'
         WHEN k < 38 THEN cents || 'd' ELSE cents END AS score,
    CASE WHEN k < 16 THEN ' 5 ' WHEN k < 28 THEN '' WHEN k < 32 THEN '1' ELSE '  ' END AS footnote,
    CASE WHEN event_type <> 'signup' THEN 'Not Applicable' WHEN k < 10 THEN 'Not Available'
         ELSE CAST(CAST(least(4, floor(value / 25)) AS BIGINT) + 1 AS VARCHAR) END AS rating,
    CASE WHEN k < 10 THEN strftime(ts, '%m/%d/%Y') WHEN k < 20 THEN strftime(ts, '%Y')
         ELSE strftime(ts, '%Y-%m-%d') END AS start_date,
    CASE WHEN k < 10 THEN strftime(ts, '%Y-%m-%d') END AS us_date
  FROM ev),
staged AS (
  SELECT event_id, entity_id, measure, {_double("score")} AS score, {_int("score")} AS score_int,
    {_int("rating")} AS rating, {_suppressed("score")} AS is_suppressed,
    nullif({_trim("footnote")}, '') AS footnote_code,
    coalesce(CAST({_date("start_date")} AS VARCHAR), us_date) AS start_date
  FROM raw),
usable AS (SELECT * FROM staged WHERE NOT is_suppressed AND score IS NOT NULL)
"""

_MART = (
    _RAW
    + f""",
grain AS (
  SELECT entity_id, measure, max(rating) OVER same AS rating,
    CASE WHEN NOT is_suppressed THEN score END AS outcome
  FROM staged
  WINDOW same AS (PARTITION BY entity_id, measure)
  QUALIFY row_number() OVER (PARTITION BY entity_id, measure ORDER BY event_id DESC) = 1),
outcomes AS (
  SELECT entity_id, count(outcome) AS n_measures, round(avg(outcome), 4) AS avg_outcome,
    count(outcome) FILTER (measure IN ('click', 'view', 'purchase')) AS n_core_measures,
    max(rating) FILTER (measure = 'signup') AS star,
    round(avg(outcome) FILTER (measure = 'click'), 4) AS outcome_click,
    round(avg(outcome) FILTER (measure = 'view'), 4) AS outcome_view,
    round(avg(outcome) FILTER (measure = 'purchase'), 4) AS outcome_purchase
  FROM grain GROUP BY entity_id),
stars AS (
  SELECT entity_id, max(rating) AS star FROM staged
  WHERE measure = 'signup' AND rating IS NOT NULL GROUP BY entity_id),
spend AS (
  SELECT o_custkey AS entity_id,
    round(avg(o_totalprice) FILTER (o_orderpriority = '1-URGENT'), 6) AS urgent_mean,
    round(avg(o_totalprice) FILTER (o_orderpriority = '5-LOW'), 6) AS low_mean
  FROM orders GROUP BY o_custkey),
quality AS (SELECT entity_id, star, urgent_mean, low_mean FROM stars FULL JOIN spend USING (entity_id)),
cost AS (
  SELECT l_suppkey AS entity_id, count(DISTINCT l_partkey) AS n_items,
    CAST(sum(l_quantity) AS BIGINT) AS total_volume,
    {_money("sum(round(l_extendedprice * 100) * l_quantity) / sum(l_quantity)")} AS weighted_payment,
    {_money("avg(round(l_extendedprice * 100))")} AS simple_payment
  FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 0 GROUP BY l_suppkey),
where_from AS (
  SELECT s_suppkey AS entity_id, s_name AS entity_name, r_name AS region FROM supplier
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
mart AS (
  SELECT entity_id, entity_name, region, weighted_payment, simple_payment, total_volume, n_items,
    avg_outcome, outcome_click, outcome_view, outcome_purchase, n_core_measures = 3 AS has_core,
    star, urgent_mean, low_mean
  FROM cost LEFT JOIN where_from USING (entity_id)
  LEFT JOIN (SELECT * FROM outcomes FULL JOIN spend USING (entity_id)) USING (entity_id)),
reliable AS (
  SELECT * FROM mart WHERE total_volume >= 5000 AND has_core AND avg_outcome IS NOT NULL
    AND weighted_payment IS NOT NULL),
cuts AS (
  SELECT quantile_cont(weighted_payment, 0.5) AS c, quantile_cont(avg_outcome, 0.5) AS o
  FROM reliable),
split AS (
  SELECT reliable.*,
    CASE WHEN weighted_payment >= c THEN 'high_cost' ELSE 'low_cost' END || ' / ' ||
    CASE WHEN avg_outcome >= o THEN 'poor_quality' ELSE 'good_quality' END AS quadrant
  FROM reliable, cuts)
"""
)


def _on_raw(select: str) -> str:
    return f"WITH {_RAW} {select}"


def _on_mart(select: str) -> str:
    return f"WITH {_MART} {select}"


# Two-sided p-value by the finite series for t with whole degrees of freedom, r and n given.
_P_VALUE = """
CASE WHEN n < 3 THEN NULL WHEN abs(r) >= 1 THEN 0.0
WHEN n % 2 = 0 THEN greatest(0.0, 1 - abs(r) * list_sum(list_transform(range(0, (n - 2) // 2),
  lambda j: exp(lgamma(j + 0.5) - lgamma(j + 1.0)) / sqrt(pi()) * pow(1 - r * r, j))))
ELSE greatest(0.0, 1 - 2 / pi() * (atan2(abs(r), sqrt(1 - r * r)) + coalesce(abs(r) * list_sum(
  list_transform(range(0, (n - 3) // 2), lambda j: sqrt(pi()) / 2
  * exp(lgamma(j + 1.0) - lgamma(j + 1.5)) * pow(1 - r * r, j + 0.5))), 0.0))) END
"""


def _r(x: str, y: str) -> str:
    x = f"(CASE WHEN {y} IS NOT NULL THEN {x} END)"
    return f"CASE WHEN stddev_pop({x}) > 0 AND stddev_pop({y}) > 0 THEN corr({x}, {y}) END"


def _pairs(scope: str, group: str) -> str:
    pairs = {
        "rating_vs_outcome": ("star", "avg_outcome"),
        "cost_vs_outcome": ("weighted_payment", "avg_outcome"),
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS pair, {scope} AS scope, count({x} + {y}) AS n, {_r(x, y)} AS r "
        f"FROM reliable {group}"
        for name, (x, y) in pairs.items()
    )


_OVERALL = _pairs("'ALL'", "")
_TESTED = f"SELECT pair, scope, n, round(r, 6) AS r, round({_P_VALUE}, 6) AS p FROM found WHERE n >= 6"

_WIDE = ", ".join(
    f"""
    CASE WHEN sum(l_quantity) FILTER (l_returnflag = '{f}') >= 40
         THEN CAST(sum(round(l_extendedprice * 100)) FILTER (l_returnflag = '{f}') AS BIGINT) END AS dollar_{f},
    CASE WHEN max(l_discount) FILTER (l_returnflag = '{f}') >= 0.08
         THEN round(max(l_discount) FILTER (l_returnflag = '{f}') * 100) END AS percentage_{f},
    CASE WHEN count(*) FILTER (l_returnflag = '{f}') >= 2
         THEN count(*) FILTER (l_returnflag = '{f}') || ' lines' END AS algorithm_{f},
    CASE WHEN count(*) FILTER (l_returnflag = '{f}') > 0 THEN 'fee' END AS methodology_{f}"""
    for f in "ANR"
)
_MELT = " UNION ALL ".join(
    f"""SELECT CAST(l_orderkey AS VARCHAR) AS code, 'LOCAL' AS code_type,
    CAST(NULL AS VARCHAR) AS setting, '{f}_plan_{f.lower()}_1' AS payer_plan, gross_charge,
    CAST(dollar_{f} AS DOUBLE) AS negotiated_dollar, percentage_{f} AS negotiated_percentage,
    algorithm_{f} AS negotiated_algorithm, methodology_{f} AS methodology FROM wide
    WHERE dollar_{f} IS NOT NULL OR percentage_{f} IS NOT NULL OR algorithm_{f} IS NOT NULL"""
    for f in "ANR"
) + """ UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'LOCAL', NULL, 'A_plan_a_1_1', gross_charge,
    top, NULL, NULL, 'top' FROM wide"""

_WIDE_TABLE = f"""wide AS (
  SELECT l_orderkey, sum(round(l_extendedprice * 100)) AS gross_charge,
    max(round(l_extendedprice * 100)) AS top, {_WIDE}
  FROM lineitem GROUP BY l_orderkey)"""

_ITEM_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
_PAYERS = f"""
  SELECT CAST(l_partkey AS VARCHAR) AS code, 'CPT' AS code_type,
    l_orderkey || '-' || l_linenumber AS description, l_linestatus AS setting,
    payer_name, l_linestatus AS plan_name, negotiated_dollar, negotiated_algorithm,
    'fee' AS methodology
  FROM (
    SELECT *, 'list' AS payer_name, CAST({_ITEM_CENTS} AS DOUBLE) AS negotiated_dollar,
      CAST(NULL AS VARCHAR) AS negotiated_algorithm FROM lineitem
    UNION ALL
    SELECT *, 'deal', CASE WHEN l_discount > 0.05 THEN CAST({_ITEM_CENTS} AS DOUBLE) END, NULL
    FROM lineitem
    UNION ALL
    SELECT *, 'rule', NULL, CASE WHEN l_tax > 0.05 THEN 'share' END FROM lineitem)
  WHERE l_returnflag <> 'N' AND (negotiated_dollar IS NOT NULL OR negotiated_algorithm IS NOT NULL)
"""

_NO_TEXT, _NO_NUMBER = "CAST(NULL AS VARCHAR)", "CAST(NULL AS DOUBLE)"
_CONTRACT = f"""
  SELECT 'orders' AS source_hospital, {_NO_TEXT} AS ccn, {_NO_TEXT} AS hospital_name,
    CAST(o_orderkey AS VARCHAR) AS code, {_NO_TEXT} AS code_type, {_NO_TEXT} AS description,
    o_orderstatus AS setting, {_NO_TEXT} AS payer_name, o_orderpriority AS plan_name,
    o_totalprice AS gross_charge, {_NO_NUMBER} AS discounted_cash_charge,
    {_NO_NUMBER} AS negotiated_dollar, {_NO_TEXT} AS negotiated_algorithm FROM orders
  UNION ALL
  SELECT 'lineitem', NULL, NULL, CAST(l_partkey AS VARCHAR), 'PART', NULL, NULL, l_returnflag, NULL,
    NULL, NULL, l_extendedprice, NULL FROM lineitem
  UNION ALL
  SELECT 'events', NULL, NULL, CAST(event_id AS VARCHAR), NULL, event_type, NULL, NULL, NULL,
    NULL, value, NULL, props FROM events
"""

_FAILING = """
  SELECT 'unique_lineitem' AS check_name,
    '{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || ',"n_rows":' || count(*) || '}' AS row
  FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
  UNION ALL
  SELECT 'values_event_type', '{"event_type":"' || event_type || '","n_rows":' || count(*) || '}'
  FROM events WHERE value > 50 AND event_type NOT IN ('click', 'view') GROUP BY event_type
  UNION ALL
  SELECT 'range_quantity', '{"l_orderkey":' || l_orderkey || '}' FROM lineitem
  WHERE l_linenumber NOT BETWEEN 1 AND 9
  UNION ALL
  SELECT 'status_orders', '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"P"}' FROM orders
  WHERE o_orderstatus = 'P'
"""
_SAMPLED = f"""
failing AS ({_FAILING}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY check_name ORDER BY row) AS place FROM failing),
collected AS (
  SELECT check_name, count(*) AS n_failing,
    list(row ORDER BY row) FILTER (place <= 15) AS samples FROM ranked GROUP BY check_name)
"""


def _summary(table: str, column: str) -> str:
    """count, mean, standard deviation, min, quartiles and max as one row."""
    q = lambda p: f"round(quantile_cont(CAST({column} AS DOUBLE), {p}), 4)"
    return (
        f"SELECT count({column}) AS count, round(avg({column}), 4) AS mean, "
        f"round(stddev_samp({column}), 4) AS std, min({column}) AS min, {q(0.25)} AS q1, "
        f"{q(0.5)} AS median, {q(0.75)} AS q3, max({column}) AS max FROM {table}"
    )


SPELLINGS = """
CASE WHEN k < 8 THEN ' ' || cents || chr(9) WHEN k < 16 THEN '+' || cents
  WHEN k < 24 THEN cents || '.5' WHEN k < 32 THEN cents || 'e1' WHEN k < 40 THEN cents || 'f'
  WHEN k < 44 THEN 'NaN' WHEN k < 48 THEN '-Infinity' WHEN k < 52 THEN '0x1F'
  WHEN k < 56 THEN cents || ' %' WHEN k < 60 THEN '' WHEN k < 64 THEN '1,234'
  WHEN k < 72 THEN day WHEN k < 76 THEN substr(day, 1, 4) WHEN k < 80 THEN day || 'T00:00:00'
  WHEN k < 84 THEN '2024-02-30' WHEN k < 88 THEN '-' || cents ELSE cents END
"""

_COST = f"""
  SELECT l_suppkey, count(DISTINCT l_partkey) AS n_items,
    CAST(sum(l_quantity) AS BIGINT) AS total_weight,
    {_money("sum(round(l_extendedprice * 100) * l_quantity) / sum(l_quantity)")} AS weighted_value,
    {_money("avg(round(l_extendedprice * 100))")} AS simple_value
"""

SQL = {
    "stage_suppressed_measures": _on_raw("SELECT * FROM staged"),
    "safe_cast_matrix": f"""
        WITH ev AS (SELECT event_id, {_K} AS k, {_CENTS} AS cents, strftime(ts, '%Y-%m-%d') AS day
          FROM events),
        t AS (SELECT event_id, {SPELLINGS} AS t FROM ev)
        SELECT event_id, {_int("t")} AS as_int, {_double("t")} AS as_double,
          CAST({_date("t")} AS VARCHAR) AS as_date FROM t""",
    "suppression_profile": _on_raw(
        f"""SELECT CASE WHEN score IS NULL THEN '(null)' WHEN {_trim("score")} = '' THEN '(blank)'
          WHEN {_trim("score")} IN ('N/A', 'Not Available', 'Not Applicable', 'Too Few To Report')
          THEN {_trim("score")} ELSE '(value)' END AS placeholder, count(*) AS n_rows,
          round(count(*) / (SELECT count(*) FROM raw), 6) AS share FROM raw GROUP BY 1"""
    ),
    "footnote_counts": _on_raw(
        "SELECT footnote_code, count(*) AS n FROM staged GROUP BY footnote_code"
    ),
    "key_coverage": """
        SELECT 'events' AS source, count(*) AS n_rows, count(DISTINCT user_id) AS n_keys FROM events
        UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_suppkey) FROM lineitem
        UNION ALL SELECT 'orders', count(*), count(DISTINCT o_custkey) FROM orders""",
    "prefix_region": """
        SELECT o_orderkey, CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'urgent'
          WHEN substr(o_orderpriority, 1, 1) IN ('3', '4') THEN 'routine' ELSE 'other' END
          AS priority_class FROM orders""",
    "string_helpers": """
        SELECT p_partkey, p_name || '''s' AS name, substr(p_type, 1, 3) AS type_code,
          replace(p_brand, '#', '_') AS brand, p_type LIKE 'E%' AS starts_e,
          p_brand LIKE '%7' AS ends_7, '''' || ' ' || p_name || '''''s ' || '''' AS literal
        FROM part""",
    "json_scalar": f"""
        SELECT event_id, json_extract_string(props, '$.k') AS k_text, CAST({_K} AS BIGINT) AS k,
          json_extract_string(props, '$.list[0].k') AS absent FROM events""",
    "weighted_cost": f"""{_COST}, {_money("avg(round(l_discount * 100))")} AS simple_discount
        FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 0 GROUP BY l_suppkey""",
    "entity_attributes": f"""{_COST}, min('Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0')) AS name,
          min(l_returnflag || l_linestatus) AS status
        FROM lineitem WHERE l_quantity > 0 GROUP BY l_suppkey""",
    "measure_pivot": _on_raw(
        """SELECT entity_id, count(DISTINCT measure) AS n_measures, round(avg(score), 4) AS avg_value,
          count(*) FILTER (measure IN ('click', 'view', 'purchase')) AS n_core_measures,
          round(avg(score) FILTER (measure = 'click'), 4) AS outcome_click,
          round(avg(score) FILTER (measure = 'view'), 4) AS outcome_view,
          round(avg(score) FILTER (measure = 'purchase'), 4) AS outcome_purchase
        FROM usable GROUP BY entity_id"""
    ),
    "summary_row_max": _on_raw(
        """SELECT entity_id, max(rating) AS star FROM staged
        WHERE measure = 'signup' AND rating IS NOT NULL GROUP BY entity_id"""
    ),
    "quality_full_outer": _on_mart("SELECT * FROM quality"),
    "dimension_lookup": """
        SELECT c_nationkey, c_custkey, n_name AS nation, 'customer' AS source,
          CAST(NULL AS VARCHAR) AS note
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "entity_mart": _on_mart("SELECT * FROM mart"),
    "analytic_set": _on_mart("SELECT * FROM reliable"),
    "analytic_counts": _on_mart(
        """SELECT (SELECT count(*) FROM mart) AS n_rows, (SELECT count(*) FROM reliable) AS n_kept,
          (SELECT count(*) FROM mart) - (SELECT count(*) FROM reliable) AS n_excluded"""
    ),
    "export_projection": _on_mart(
        """SELECT entity_id, entity_name, region, total_volume, weighted_payment AS avg_payment,
          avg_outcome AS outcome, has_core, total_volume >= 5000 AND has_core AS is_analytic
        FROM mart ORDER BY avg_payment DESC NULLS LAST, entity_id"""
    ),
    "exact_quantiles": """
        SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.05), 6) AS p05,
          round(quantile_cont(l_extendedprice, 0.5), 6) AS median,
          round(quantile_cont(l_extendedprice, 0.99), 6) AS p99,
          round(quantile_cont(l_quantity, 0.75), 6) AS quantity
        FROM lineitem GROUP BY l_returnflag""",
    "describe_volume": _summary("orders", "o_totalprice"),
    "describe_mart": _on_mart(_summary("mart", "total_volume")),
    "threshold_counts": _on_mart(
        """SELECT CAST(t AS BIGINT) AS threshold, (SELECT count(*) FROM mart WHERE total_volume >= t) AS n
        FROM (VALUES (4000), (4500), (5000), (5500)) AS v(t)"""
    ),
    "group_medians": _on_mart(
        """SELECT region, count(*) AS n, round(quantile_cont(weighted_payment, 0.5), 6) AS median_cost,
          round(quantile_cont(avg_outcome, 0.5), 6) AS median_outcome,
          round(quantile_cont(CAST(star AS DOUBLE), 0.5), 6) AS median_star
        FROM reliable GROUP BY region"""
    ),
    "median_gap": _on_mart(
        """SELECT round(a, 6) AS median_upper, round(b, 6) AS median_base, round(a / b - 1, 6) AS gap
        FROM (SELECT quantile_cont(weighted_payment, 0.5) FILTER (region = 'ASIA') AS a,
          quantile_cont(weighted_payment, 0.5) FILTER (region = 'EUROPE') AS b FROM mart)"""
    ),
    "pearson_overall": _on_mart(f", found AS ({_OVERALL}) {_TESTED}"),
    "pearson_by_group": _on_mart(
        f", found AS ({_OVERALL} UNION ALL {_pairs('region', 'GROUP BY region')}) {_TESTED}"
    ),
    "pearson_pvalue": f"""
        WITH ev AS (SELECT user_id, value, {_K} AS k FROM events),
        found AS (
          SELECT 'k_vs_value' AS pair, 'ALL' AS scope, count(*) AS n, {_r("k", "value")} AS r FROM ev
          UNION ALL
          SELECT 'k_vs_value', CAST(user_id AS VARCHAR), count(*), {_r("k", "value")} FROM ev
          GROUP BY user_id)
        {_TESTED}""",
    "quadrant_split": _on_mart(
        "SELECT entity_id, weighted_payment, avg_outcome, quadrant FROM split"
    ),
    "quadrant_counts": _on_mart("SELECT quadrant, count(*) AS n FROM split GROUP BY quadrant"),
    "quadrant_gap": _on_mart(
        """, g AS (SELECT count(*) FILTER (quadrant = 'low_cost / good_quality') AS n_low,
          count(*) FILTER (quadrant = 'high_cost / poor_quality') AS n_high,
          avg(weighted_payment) FILTER (quadrant = 'low_cost / good_quality') AS lo,
          avg(weighted_payment) FILTER (quadrant = 'high_cost / poor_quality') AS hi FROM split)
        SELECT n_low, n_high, round(lo, 6) AS mean_low, round(hi, 6) AS mean_high,
          round(hi - lo, 6) AS gap, round((hi - lo) / lo * 100, 6) AS gap_pct
        FROM g WHERE n_low > 0 AND n_high > 0"""
    ),
    "quadrant_listing": _on_mart(
        """SELECT entity_id, substr(entity_name, 1, 12) AS entity_name, weighted_payment,
          avg_outcome, star FROM split WHERE quadrant = 'low_cost / good_quality'
        ORDER BY weighted_payment, entity_id"""
    ),
    "headline_report": _on_mart(
        f""", found AS ({_OVERALL}), tested AS (SELECT *, {_P_VALUE} AS p FROM found WHERE n >= 6),
        worded AS (SELECT *, CASE WHEN r > 0 THEN 'positive' ELSE 'negative or zero' END AS sign,
          CASE WHEN r > 0.1 THEN 'rises together' WHEN r < -0.1 THEN 'moves opposite'
            ELSE 'little or no linear link' END AS direction,
          CASE WHEN p < 0.001 THEN 'p<0.001' ELSE printf('p=%.4f', p) END AS p_text FROM tested)
        SELECT pair, n, sign, direction, p_text,
          printf('r=%.2f', r) || ' (' || p_text || ') n=' || n || ' ' || direction AS statement
        FROM worded"""
    ),
    "wide_melt": f"WITH {_WIDE_TABLE} {_MELT}",
    "recovered_plans": f"""
        WITH {_WIDE_TABLE}
        SELECT code, payer_plan, substr(payer_plan, 1, 1) AS payer_name,
          CASE WHEN payer_plan = 'A_plan_a_1_1' THEN 'plan a 1'
            ELSE 'plan ' || lower(substr(payer_plan, 1, 1)) || '/1' END AS plan_name, negotiated_dollar
        FROM ({_MELT})""",
    "tall_stage": f"""
        SELECT CAST(l_partkey AS VARCHAR) AS code, 'LOCAL' AS code_type,
          l_orderkey || '-' || l_linenumber AS description, CAST(NULL AS VARCHAR) AS billing_class,
          l_linestatus AS setting, l_returnflag AS payer_name,
          CAST(l_suppkey AS VARCHAR) AS plan_name, CAST({_ITEM_CENTS} AS DOUBLE) AS gross_charge,
          CASE WHEN l_tax > 0.05 THEN CAST({_ITEM_CENTS} AS DOUBLE) END AS discounted_cash_charge,
          CASE WHEN l_discount > 0.05 THEN CAST({_ITEM_CENTS} AS DOUBLE) END AS negotiated_dollar,
          round(l_discount * 100) AS negotiated_percentage,
          CASE WHEN l_discount <= 0.05 THEN 'formula' END AS negotiated_algorithm,
          'fee schedule' AS methodology
        FROM lineitem""",
    "nested_first": f"""
        SELECT CAST(l_partkey AS VARCHAR) AS code, 'CPT' AS code_type,
          l_orderkey || '-' || l_linenumber AS description, l_linestatus AS setting,
          'facility' AS billing_class, CAST({_ITEM_CENTS} AS DOUBLE) AS gross_charge,
          CASE WHEN l_tax > 0.05 THEN CAST({_ITEM_CENTS} AS DOUBLE) END AS discounted_cash_charge
        FROM lineitem
        UNION ALL SELECT NULL, NULL, 'bare', NULL, NULL, NULL, NULL FROM lineitem""",
    "nested_explode": _PAYERS,
    "contract_union": _CONTRACT,
    "contract_totals": f"""
        SELECT count(*) AS n_rows, count(DISTINCT source_hospital) AS n_sources
        FROM ({_CONTRACT})""",
    "scan_csv_text": """
        SELECT l_suppkey AS supplier, l_returnflag AS col_1_flag, count(*) AS n,
          sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL""",
    "scan_paged_json": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "scan_nested_json": f"""
        SELECT code, payer_name, count(*) AS n,
          CAST(round(sum(negotiated_dollar)) AS BIGINT) AS dollars
        FROM ({_PAYERS}) GROUP BY code, payer_name""",
    "check_not_null": _on_mart("SELECT entity_id, region FROM mart WHERE has_core IS NULL"),
    "check_unique": """
        SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "check_range": _on_raw(
        """SELECT event_id, score FROM staged
        WHERE NOT is_suppressed AND NOT (score BETWEEN 100 AND 20000)"""
    ),
    "check_values": """
        SELECT event_type, count(*) AS n_rows FROM events
        WHERE value > 50 AND event_type NOT IN ('click', 'view') GROUP BY event_type""",
    "check_singular": _on_mart(
        "SELECT entity_id, total_volume FROM mart WHERE has_core AND NOT total_volume >= 5000"
    ),
    "row_preservation": _on_raw(
        """, c AS (
          SELECT 'events' AS "table", (SELECT count(*) FROM events) AS n_raw,
            (SELECT count(*) FROM staged) AS n_staged
          UNION ALL SELECT 'usable_events', (SELECT count(*) FROM events), (SELECT count(*) FROM usable)
          UNION ALL SELECT 'lineitem', count(*), count(*) FROM lineitem)
        SELECT *, CASE WHEN n_raw = n_staged THEN 'OK' ELSE 'MISMATCH' END AS status FROM c"""
    ),
    "key_integrity": _on_mart(
        """SELECT count(*) AS n_rows, count(DISTINCT entity_id) AS n_keys,
          count(*) FILTER (entity_id IS NULL) AS n_null_key,
          count(*) FILTER (avg_outcome IS NULL) AS n_null_required,
          count(*) = count(DISTINCT entity_id) AS is_unique FROM mart"""
    ),
    "dropped_groups": """
        SELECT 'B_none' AS label, 'standard_charge_B_none_methodology' AS "column",
          'incomplete group' AS reason, count(DISTINCT l_orderkey) AS n_cells FROM lineitem
        UNION ALL SELECT NULL, 'standard_charge_gross', 'no known suffix', count(DISTINCT l_orderkey)
        FROM lineitem""",
    "scan_raw_json": "SELECT l_orderkey || '-' || l_linenumber AS extra FROM lineitem",
    "scan_preamble_csv": """
        SELECT l_suppkey AS supplier, l_linestatus || ', "x"' AS note, count(*) AS n,
          sum(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2""",
    "scan_latin1_csv": "SELECT c_custkey, 'é ' || c_mktsegment AS segment FROM customer",
    "catalog_resolve": """
        SELECT l_orderkey, arg_min(l_orderkey || '-' || l_linenumber || '-.CSV', l_linenumber) AS "downloadURL"
        FROM lineitem WHERE l_linenumber <> 2 AND starts_with(CAST(l_partkey AS VARCHAR), '1')
        GROUP BY l_orderkey""",
    "load_and_reload": """
        SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1""",
    "recent_failures": f"""
        WITH {_SAMPLED} SELECT check_name, n_failing, 0 AS n_stale FROM collected""",
    "headline_reproduces": _on_mart(f""", found AS ({_OVERALL}), tested AS ({_TESTED})
        SELECT pair, n, round(coalesce(r, 0), 6) + CASE pair WHEN 'rating_vs_outcome' THEN 0 ELSE 0.02 END AS expected_r,
          CASE WHEN r IS NOT NULL THEN pair = 'rating_vs_outcome' END AS r_matches,
          CASE pair WHEN 'rating_vs_outcome' THEN p <= 0.01 ELSE p >= 0.05 END AS p_matches
        FROM tested"""),
    "totals_match": """
        SELECT count(*) AS n_rows, count(DISTINCT l_suppkey) AS n_keys,
          abs(count(*) - 4 * (SELECT count(*) FROM orders)) <= 0.4 * (SELECT count(*) FROM orders)
            AND count(DISTINCT l_suppkey) = (SELECT count(*) FROM supplier) AS matches FROM lineitem""",
    "failure_collection": f"""
        WITH {_SAMPLED}
        SELECT check_name, n_failing, array_to_string(samples, '|') AS samples FROM collected""",
    "triage_packet": f"""
        WITH {_SAMPLED},
        checked AS (SELECT 'unique_lineitem' AS check_name, count(*) AS n_rows FROM lineitem
          UNION ALL SELECT 'status_orders', count(*) FROM orders),
        joined AS (SELECT *, 'Got ' || n_failing || ' results' AS message, n_failing / n_rows AS share
          FROM collected LEFT JOIN checked USING (check_name))
        SELECT check_name, message, n_failing, n_rows,
          CASE WHEN share IS NULL THEN 'unclear' WHEN share >= 0.5 THEN 'upstream-source-change'
            WHEN share <= 0.05 THEN 'genuine-data-issue' ELSE 'test-config-too-strict' END AS failure_type,
          'check: ' || check_name || chr(10) || 'message: ' || message || chr(10)
            || 'failing rows: ' || n_failing || chr(10) || 'sample:' || chr(10) || '['
            || array_to_string(samples, ',' || chr(10)) || ']' AS packet
        FROM joined""",
}
