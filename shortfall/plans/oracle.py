"""DuckDB oracle SQL for every catalogue query.

Written independently of the Spark code: plain SQL with window functions,
``IS NOT DISTINCT FROM`` for UOM keys, where NULL matches NULL, and explicit
``NULLS FIRST/LAST``. The fixture views are inlined as CTEs from
``fixtures.VIEWS`` so both engines read the same derived inputs.
"""

from __future__ import annotations

from datetime import timedelta

from shortfall.functions import NA_TOKENS
from shortfall.plans import fixtures as X
from shortfall.sources import FEED_COLUMNS

T = X.REVIEW_THRESHOLD


def ts(v) -> str:
    return f"TIMESTAMP '{v:%Y-%m-%d %H:%M:%S}'"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(vals) -> str:
    return "(" + ", ".join(q(v) for v in vals) + ")"


def nn(x: str) -> str:
    """NaN -> NULL."""
    return f"(CASE WHEN isnan({x}) THEN NULL ELSE {x} END)"


def div(n: str, d: str) -> str:
    """x/0 = +/-inf, 0/0 = NULL, NULL operands -> NULL."""
    return (f"(CASE WHEN ({n}) IS NULL OR ({d}) IS NULL THEN NULL "
            f"WHEN ({d}) = 0 THEN CASE WHEN ({n}) > 0 THEN 'inf'::DOUBLE WHEN ({n}) < 0 THEN '-inf'::DOUBLE END "
            f"ELSE {nn(f'CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE)')} END)")


def ceil_d(x: str) -> str:
    return f"(CASE WHEN ({x}) IS NULL THEN NULL WHEN isinf({x}) THEN ({x}) ELSE CAST(ceil({x}) AS DOUBLE) END)"


def flag(x: str) -> str:
    return f"(CASE WHEN ({x}) >= {T} THEN 'Review' ELSE 'Okay' END)"


def remove_tok(lst: str, tok: str) -> str:
    return (f"(CASE WHEN ({lst}) IS NULL OR ({tok}) IS NULL THEN ({lst}) ELSE array_to_string(list_filter("
            f"list_transform(string_split({lst}, ','), lambda u: trim(u)), lambda u: u <> '' AND u <> trim({tok})), ',') END)")


LOCS = in_list(X.LOCATIONS)
SEC = q(X.SECONDARY_LOCATION)
NA = in_list(NA_TOKENS)
USAGE_LO = X.USAGE_AS_OF - timedelta(days=X.USAGE_WINDOW_DAYS)
FRESH_LO = X.FRESHNESS_AS_OF - timedelta(days=X.FRESHNESS_DAYS)
PKG = r"(\d+(?:\.\d+)?)\s+([A-Z]+)/([A-Z]+)"
RISK = "(?i)" + "|".join(X.RISK_LEVELS)

# ── stage CTEs ───────────────────────────────────────────────────────
FEED_N = "feed_n AS (SELECT DISTINCT " + ", ".join(
    f"CASE WHEN {c} IN {NA} THEN NULL ELSE {c} END AS {c}" for c in FEED_COLUMNS) + " FROM fx_feed)"

FEED_SEL = f"""feed_sel AS (SELECT *, CASE WHEN regexp_matches(coalesce(risk_level, ''), {q(RISK)})
      AND coalesce(CAST(duration AS DOUBLE) >= {X.DURATION_THRESHOLD}, false)
      AND coalesce(CAST(forecast_qty AS DOUBLE) <> 0, true) THEN 'x' ELSE '' END AS risk_selected FROM feed_n)"""

FEED = ("feed AS (SELECT *, row_number() OVER (ORDER BY customer_material_number ASC NULLS FIRST, "
        "md5(concat_ws(chr(2), " + ", ".join(f"coalesce({c}, chr(1))" for c in FEED_COLUMNS + ("risk_selected",))
        + "))) AS row_id FROM feed_sel)")

LATEST = f"""latest AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY location, item ORDER BY report_stamp DESC NULLS LAST,
      l_orderkey DESC NULLS LAST, l_linenumber DESC NULLS LAST, l_extendedprice DESC NULLS LAST) AS rn
  FROM fx_inventory WHERE location IN {LOCS} AND active = 'Yes' AND discontinued = 'No') WHERE rn = 1)"""

AVG_ISSUE = f"""avg_issue AS (SELECT location, item, sum(qty) / {float(X.USAGE_DIVISOR)} AS avg_daily_issue
  FROM fx_usage WHERE location IN {LOCS} AND trx_date BETWEEN {ts(USAGE_LO)} AND {ts(X.USAGE_AS_OF)}
  GROUP BY location, item)"""


def _nvals(c: str) -> str:
    return f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) > 1"


BAD_KEYS = f"""bad_keys AS (SELECT vendor_item, item FROM latest
  WHERE vendor_item IS NOT NULL AND item IS NOT NULL GROUP BY vendor_item, item
  HAVING {_nvals('stock_uom')} OR {_nvals('default_buy_uom')} OR {_nvals('buy_uom_multiplier')}),
bad_items AS (SELECT DISTINCT item FROM bad_keys)"""

REC_INV = f"""rec_inv AS (SELECT vendor_item, item, default_buy_uom, buy_uom_multiplier, stock_uom,
    coalesce(sum(available_qty), 0.0) AS available_qty, coalesce(sum(on_order_qty), 0.0) AS on_order_qty,
    max(report_stamp) AS report_stamp
  FROM latest l WHERE NOT EXISTS (SELECT 1 FROM bad_items b WHERE b.item = l.item AND l.location = {SEC})
  GROUP BY vendor_item, item, default_buy_uom, buy_uom_multiplier, stock_uom)"""

REC_USE = f"""rec_use AS (SELECT item, coalesce(sum(avg_daily_issue), 0.0) AS avg_daily_issue
  FROM avg_issue u WHERE NOT EXISTS (SELECT 1 FROM bad_items b WHERE b.item = u.item AND u.location = {SEC})
  GROUP BY item)"""

GU_TOTAL = f"""gu_total AS (SELECT item_group, coalesce(sum(rolling_daily_avg_7), 0.0) AS rolling_daily_avg_7
  FROM fx_group_usage WHERE location IN {LOCS} GROUP BY item_group)"""

ENRICHED = f"""sec_items AS (SELECT DISTINCT item FROM latest WHERE location = {SEC} AND item IS NOT NULL),
enriched AS (SELECT i.vendor_item, i.item, i.available_qty, i.on_order_qty, i.default_buy_uom,
    i.buy_uom_multiplier, i.stock_uom, i.report_stamp, u.avg_daily_issue, d.description3,
    CASE WHEN EXISTS (SELECT 1 FROM sec_items s WHERE s.item = i.item) THEN 'Yes' ELSE 'No' END AS in_secondary_location
  FROM rec_inv i LEFT JOIN rec_use u ON i.item = u.item
  LEFT JOIN fx_description d ON i.item = d.item)"""

LINKS = f"""links AS (SELECT item_group, item, replace_item, stage FROM fx_item_link
  WHERE stage NOT IN {in_list(X.EXCLUDED_STAGES)})"""

SUBS = f"""subs AS (SELECT l.item_group, l.item, l.replace_item, l.stage, i.vendor_item AS repl_vendor_item,
    i.available_qty AS repl_available_qty, i.on_order_qty AS repl_on_order_qty,
    i.default_buy_uom AS repl_default_buy_uom, i.buy_uom_multiplier AS repl_buy_uom_multiplier,
    i.stock_uom AS repl_stock_uom, u.avg_daily_issue AS repl_avg_daily_issue,
    d.description3 AS repl_description3,
    CASE WHEN i.available_qty = 0 THEN 0.0 ELSE {div('i.available_qty', 'u.avg_daily_issue')} END AS repl_dioh,
    'With Sub' AS with_sub
  FROM links l LEFT JOIN rec_inv i ON l.replace_item = i.item
  LEFT JOIN rec_use u ON l.replace_item = u.item
  LEFT JOIN fx_description d ON l.replace_item = d.item)"""

_DAYS = (f"floor((epoch_us(CAST(f.est_delivery_date AS TIMESTAMP)) - epoch_us({ts(X.COVERAGE_AS_OF)}))"
         " / 86400000000.0)")
COV = f"""cov0 AS (SELECT f.*, e.vendor_item AS inv_vendor_item, e.item, e.available_qty, e.on_order_qty,
    e.default_buy_uom, e.buy_uom_multiplier, e.stock_uom, e.report_stamp, e.avg_daily_issue, e.description3,
    e.in_secondary_location, coalesce(e._m, false) AS matched,
    CASE WHEN e.available_qty = 0 THEN 0.0 ELSE {div('e.available_qty', 'e.avg_daily_issue')} END AS dioh,
    CAST({_DAYS} AS DOUBLE) AS days_to_recover
  FROM feed f LEFT JOIN (SELECT *, true AS _m FROM enriched) e ON f.vendor_item = e.vendor_item),
cov AS (SELECT * EXCLUDE (matched, gap0), gap0 AS coverage_gap, {flag('gap0')} AS review_flag,
    CASE WHEN matched THEN 'Matched' ELSE 'Not Matched' END AS match_status,
    CASE WHEN matched AND avg_daily_issue IS NULL THEN 'No Issue Out' ELSE '' END AS no_issue_flag
  FROM (SELECT *, {nn('days_to_recover - dioh')} AS gap0 FROM cov0))"""

MSUB = """msub AS (SELECT c.* REPLACE (
      CAST(c.est_depletion_date AS TIMESTAMP) AS est_depletion_date,
      CAST(c.est_available_date AS TIMESTAMP) AS est_available_date,
      CAST(c.est_delivery_date AS TIMESTAMP) AS est_delivery_date,
      CAST(c.mioh AS DOUBLE) AS mioh, CAST(c.forecast_qty AS DOUBLE) AS forecast_qty,
      CAST(c.duration AS DOUBLE) AS duration),
    s.item_group, s.replace_item, s.stage, s.repl_vendor_item, s.repl_available_qty, s.repl_on_order_qty,
    s.repl_default_buy_uom, s.repl_buy_uom_multiplier, s.repl_stock_uom, s.repl_avg_daily_issue,
    s.repl_description3, s.repl_dioh, s.with_sub
  FROM cov c LEFT JOIN subs s ON c.item = s.item)"""

IG_QTY = f"""has_ig AS (SELECT * FROM msub WHERE item_group IS NOT NULL),
ig_qty AS (SELECT g.item_group, g.available_qty_ig, u.rolling_daily_avg_7 AS avg_daily_issue_ig,
    {div('g.available_qty_ig', 'u.rolling_daily_avg_7')} AS dioh_ig
  FROM (SELECT item_group, coalesce(sum(available_qty), 0.0) AS available_qty_ig FROM (
      SELECT DISTINCT item, item_group, available_qty FROM has_ig
      UNION ALL
      SELECT DISTINCT replace_item, item_group, repl_available_qty FROM has_ig) p GROUP BY item_group) g
  LEFT JOIN gu_total u ON g.item_group = u.item_group)"""

GROUP_COV = f"""group_cov AS (SELECT g.item_group, g.available_qty_ig, g.avg_daily_issue_ig, g.dioh_ig, d.item,
    {nn('d.days_to_recover - g.dioh_ig')} AS coverage_gap_ig,
    {flag(nn('d.days_to_recover - g.dioh_ig'))} AS review_flag_ig
  FROM ig_qty g LEFT JOIN (SELECT DISTINCT item, item_group, days_to_recover FROM has_ig) d
    ON g.item_group = d.item_group)"""

FULL = f"""full_ds AS (SELECT m.*, g.available_qty_ig, g.avg_daily_issue_ig, g.dioh_ig,
    CASE WHEN m.item_group IS NOT NULL THEN {nn('m.days_to_recover - g.dioh_ig')} END AS coverage_gap_ig,
    CASE WHEN m.item_group IS NOT NULL THEN {flag(nn('m.days_to_recover - g.dioh_ig'))} END AS review_flag_ig
  FROM msub m LEFT JOIN ig_qty g ON m.item_group = g.item_group)"""


def _rec_cols(prefix: str = "") -> str:
    """Recommendation expressions over a full/review row."""
    tc = nn(f"{prefix}coverage_gap - ({T})")
    tc_ig0 = nn(f"{prefix}coverage_gap_ig - ({T})")
    tc_ig = f"(CASE WHEN {tc_ig0} IS NULL THEN NULL ELSE greatest({tc_ig0}, 0.0) END)"
    tq = nn(f"{tc} * {prefix}avg_daily_issue")
    tq_ig = nn(f"{tc_ig} * {prefix}avg_daily_issue_ig")
    rec = f"coalesce({tq_ig}, {tq})"
    return {
        "target_coverage": tc, "target_coverage_ig": tc_ig, "target_qty_ea": tq, "target_qty_ea_ig": tq_ig,
        "rec_qty_ea": rec,
        "rec_qty_buy_uom": ceil_d(div(rec, f"{prefix}buy_uom_multiplier")),
        "rec_qty_buy_uom_repl": ceil_d(div(rec, f"{prefix}repl_buy_uom_multiplier")),
    }


REVIEW_COLS = ("vendor_item, packaging_string, item, review_flag, with_sub, review_flag_ig, item_group, "
               "replace_item, avg_daily_issue, avg_daily_issue_ig, default_buy_uom, buy_uom_multiplier, "
               "repl_default_buy_uom, repl_buy_uom_multiplier, coverage_gap, coverage_gap_ig")
REVIEW = ("review AS (SELECT " + REVIEW_COLS + ", " + ", ".join(
    f"{e} AS {k}" for k, e in _rec_cols().items()) + " FROM full_ds WHERE review_flag = 'Review')")

PARSED = f"""pk AS (SELECT customer_material_number, vendor_item, packaging_string,
    regexp_extract_all(packaging_string, {q(PKG)}, 1) AS a1,
    regexp_extract_all(packaging_string, {q(PKG)}, 2) AS a2,
    regexp_extract_all(packaging_string, {q(PKG)}, 3) AS a3 FROM feed_n),
parsed AS (
  SELECT customer_material_number, vendor_item, CAST(0 AS INTEGER) AS pos, '' AS convert_to_uom, '' AS uom,
      CAST(NULL AS DOUBLE) AS conv_factor
    FROM pk WHERE packaging_string IS NULL OR packaging_string = ''
  UNION ALL
  SELECT customer_material_number, vendor_item, CAST(i - 1 AS INTEGER) AS pos, a3[i] AS convert_to_uom,
      a2[i] AS uom, CAST(a1[i] AS DOUBLE) AS conv_factor
    FROM (SELECT *, unnest(range(1, len(a1) + 1)) AS i FROM pk WHERE packaging_string <> ''))"""

CONV = f"""uomb AS (SELECT DISTINCT vendor_item, CASE WHEN convert_to_uom = 'CS' THEN 'CA' ELSE convert_to_uom END AS base_uom,
    uom, coalesce(conv_factor, 0.0) AS conv_factor FROM parsed),
uomf AS (SELECT * FROM uomb WHERE base_uom <> '' AND vendor_item IS NOT NULL),
uom_t AS (SELECT vendor_item, conv_factor, base_uom, string_agg(uom, ',' ORDER BY uom) AS to_uom
  FROM uomf GROUP BY vendor_item, conv_factor, base_uom),
derived AS (SELECT b.vendor_item, {div('s.conv_factor', 'b.conv_factor')} AS conv_factor,
    unnest(string_split(b.to_uom, ',')) AS base_uom, s.to_uom AS to_uom
  FROM uom_t b JOIN uom_t s ON b.vendor_item = s.vendor_item AND b.base_uom = s.base_uom
    AND s.conv_factor > b.conv_factor),
extended AS (SELECT vendor_item, conv_factor, base_uom, to_uom FROM uom_t UNION
  SELECT vendor_item, conv_factor, base_uom, to_uom FROM derived),
compact AS (SELECT vendor_item, conv_factor, to_uom, string_agg(base_uom, ',' ORDER BY base_uom) AS from_uom
  FROM extended GROUP BY vendor_item, conv_factor, to_uom),
conversions AS (SELECT e.vendor_item, e.conv_factor, e.base_uom, e.to_uom, c.from_uom FROM extended e
  JOIN compact c ON e.vendor_item = c.vendor_item AND e.conv_factor = c.conv_factor AND e.to_uom = c.to_uom)"""

_K = "vendor_item, default_buy_uom, buy_uom_multiplier"


def _ns(a: str, b: str, cols: str = _K) -> str:
    return " AND ".join(f"{a}.{c.strip()} IS NOT DISTINCT FROM {b}.{c.strip()}" for c in cols.split(","))


ALT = f"""ukeys AS (SELECT DISTINCT {_K} FROM review),
prep AS (SELECT k.vendor_item, k.default_buy_uom, k.buy_uom_multiplier, c.conv_factor, c.base_uom, c.to_uom,
    c.from_uom, coalesce(k.default_buy_uom = c.base_uom AND k.buy_uom_multiplier = c.conv_factor, false) AS same
  FROM ukeys k JOIN conversions c ON k.vendor_item = c.vendor_item),
same_u AS (SELECT DISTINCT {_K}, to_uom FROM prep WHERE same),
alt_u AS (SELECT DISTINCT {_K}, to_uom, from_uom, conv_factor FROM prep WHERE NOT same),
alt_j AS (SELECT s.vendor_item, s.default_buy_uom, s.buy_uom_multiplier, s.to_uom,
    {remove_tok('a.from_uom', 's.default_buy_uom')} AS from_uom, a.conv_factor
  FROM same_u s LEFT JOIN alt_u a ON {_ns('s', 'a')} AND s.to_uom = a.to_uom),
alt_tab AS (SELECT *, 'Group ' || CAST(row_number() OVER (PARTITION BY {_K}
    ORDER BY to_uom ASC NULLS FIRST, conv_factor ASC NULLS FIRST, from_uom ASC NULLS FIRST) AS VARCHAR) AS alt_uom_group
  FROM alt_j)"""

STAMP = f"""stamp AS (SELECT strftime(max(report_stamp), '%Y-%m-%dT%H:%M:%S') AS stamp_text, max(report_stamp) AS stamp
  FROM fx_inventory WHERE location IN {LOCS} AND active = 'Yes' AND discontinued = 'No'
    AND report_stamp >= {ts(FRESH_LO)})"""


def _with(*parts: str, views=("fx_feed", "fx_inventory", "fx_usage", "fx_description", "fx_item_link",
                              "fx_group_usage")) -> str:
    return X.with_clause(*views) + ",\n" + ",\n".join(parts) + "\n"


PIPE_TO_COV = (FEED_N, FEED_SEL, FEED, LATEST, AVG_ISSUE, BAD_KEYS, REC_INV, REC_USE, ENRICHED, COV)
PIPE_TO_FULL = PIPE_TO_COV + (GU_TOTAL, LINKS, SUBS, MSUB, IG_QTY, FULL)
PIPE_TO_REVIEW = PIPE_TO_FULL + (REVIEW, )
PIPE_TO_ALT = PIPE_TO_REVIEW + (PARSED, CONV, ALT)


def _report_sql() -> str:
    from shortfall.operators.report import REPORT_COLUMNS
    rec = _rec_cols("f.")
    rec_sel = ", ".join(f"CASE WHEN f.review_flag = 'Review' THEN {e} END AS {k}" for k, e in rec.items())
    body = f"""r0 AS (SELECT f.*, {rec_sel} FROM full_ds f),
r1 AS (SELECT r.* REPLACE (coalesce(r.in_secondary_location, 'No') AS in_secondary_location),
    a.alt_uom_group, a.to_uom, a.from_uom, a.conv_factor,
    {ceil_d(div('r.rec_qty_ea', 'a.conv_factor'))} AS rec_qty_alt_uom,
    (SELECT stamp_text FROM stamp) AS inventory_as_of
  FROM r0 r LEFT JOIN alt_tab a ON {_ns('r', 'a')} AND r.review_flag = 'Review')"""
    cols = ", ".join(REPORT_COLUMNS)
    gap_c = lambda c: f"CASE WHEN {c} IS NULL THEN NULL WHEN {c} >= {T} THEN 'red' ELSE 'green' END"
    return (_with(*PIPE_TO_ALT, STAMP, body) +
            f"SELECT {cols}, match_status = 'Matched' AS visible, {gap_c('coverage_gap')} AS gap_colour, "
            f"{gap_c('coverage_gap_ig')} AS gap_ig_colour FROM r1")


def _alternatives_select() -> str:
    from shortfall.operators.uom import REVIEW_ALT_COLUMNS
    from_alt = {"alt_uom_group", "conv_factor", "from_uom", "to_uom"}
    cols = []
    for c in REVIEW_ALT_COLUMNS:
        if c == "rec_qty_alt_uom":
            cols.append(ceil_d(div("r.rec_qty_ea", "a.conv_factor")) + " AS rec_qty_alt_uom")
        else:
            cols.append(("a." if c in from_alt else "r.") + c)
    return f"SELECT {', '.join(cols)} FROM review r LEFT JOIN alt_tab a ON {_ns('r', 'a')}"


def _catalogue() -> dict[str, str]:
    from shortfall.plans.catalogue import COVERAGE_COLUMNS, FULL_VIEW, SUBSTITUTE_VIEW
    from shortfall.operators.reconcile import INCONSISTENCY_COLUMNS
    inv_only = ("fx_inventory",)
    out = {
        "latest_inventory": X.with_clause(*inv_only) + ", " + LATEST + " SELECT * FROM latest",
        "avg_daily_issue": X.with_clause("fx_usage") + ", " + AVG_ISSUE + " SELECT * FROM avg_issue",
        "latest_inventory_merged": X.with_clause(*inv_only) + ", " + LATEST + " SELECT * FROM latest",
        "avg_daily_issue_by_day": X.with_clause("fx_usage") + ", " + AVG_ISSUE + " SELECT * FROM avg_issue",
        "item_description": X.with_clause("fx_description") + " SELECT item, description3 FROM fx_description",
        "active_links": X.with_clause("fx_item_link") + ", " + LINKS + " SELECT * FROM links",
        "group_usage_total": X.with_clause("fx_group_usage") + ", " + GU_TOTAL + " SELECT * FROM gu_total",
        "inventory_freshness": X.with_clause(*inv_only) + ", " + STAMP + " SELECT stamp, stamp_text FROM stamp",
        "feed_dedup": X.with_clause("fx_feed") + ", " + FEED_N + " SELECT * FROM feed_n",
        "risk_selection": X.with_clause("fx_feed") + ", " + FEED_N + ", " + FEED_SEL +
        " SELECT customer_material_number, risk_level, duration, forecast_qty, risk_selected FROM feed_sel",
        "uom_inconsistency": X.with_clause(*inv_only) + ", " + LATEST + ", " + BAD_KEYS +
        f" SELECT {', '.join(INCONSISTENCY_COLUMNS)} FROM latest l WHERE EXISTS "
        "(SELECT 1 FROM bad_keys k WHERE k.vendor_item = l.vendor_item AND k.item = l.item)",
        "reconciled_inventory": _with(LATEST, AVG_ISSUE, BAD_KEYS, REC_INV) + "SELECT * FROM rec_inv",
        "reconciled_usage": _with(LATEST, AVG_ISSUE, BAD_KEYS, REC_USE) + "SELECT * FROM rec_use",
        "enriched_inventory": _with(LATEST, AVG_ISSUE, BAD_KEYS, REC_INV, REC_USE, ENRICHED) +
        "SELECT * FROM enriched",
        "substitutes": _with(LATEST, AVG_ISSUE, BAD_KEYS, REC_INV, REC_USE, LINKS, SUBS) + "SELECT * FROM subs",
        "feed_row_id": X.with_clause("fx_feed") + ", " + ",\n".join((FEED_N, FEED_SEL, FEED)) +
        " SELECT row_id, customer_material_number, vendor_item, risk_selected FROM feed",
        "coverage_metrics": _with(*PIPE_TO_COV) + f"SELECT {', '.join(COVERAGE_COLUMNS)} FROM cov",
        "feed_with_substitutes": _with(*PIPE_TO_FULL) + f"SELECT {', '.join(SUBSTITUTE_VIEW)} FROM msub",
        "group_coverage": _with(*PIPE_TO_FULL, GROUP_COV) + "SELECT * FROM group_cov",
        "full_dataset": _with(*PIPE_TO_FULL) + f"SELECT {', '.join(FULL_VIEW)} FROM full_ds",
        "recommendations": _with(*PIPE_TO_REVIEW) + "SELECT * FROM review",
        "packaging_parse": X.with_clause("fx_feed") + ", " + FEED_N + ", " + PARSED +
        " SELECT customer_material_number, vendor_item, pos, convert_to_uom, uom, conv_factor FROM parsed",
        "uom_conversions": X.with_clause("fx_feed") + ", " + ",\n".join((FEED_N, PARSED, CONV)) +
        " SELECT * FROM conversions",
        "unresolved_uom": _with(*PIPE_TO_REVIEW, PARSED, CONV) +
        "SELECT DISTINCT r.vendor_item FROM review r WHERE NOT EXISTS (SELECT 1 FROM conversions c WHERE "
        "c.vendor_item IS NOT DISTINCT FROM r.vendor_item AND c.conv_factor IS NOT DISTINCT FROM "
        "r.buy_uom_multiplier AND c.base_uom IS NOT DISTINCT FROM r.default_buy_uom)",
        "uom_alternatives": _with(*PIPE_TO_ALT) + _alternatives_select(),
        "final_report": _report_sql(),
        "batch_label": X.with_clause("fx_arrivals") +
        f" SELECT message_id, file_name, 'processed' || split_part(file_name, {q(X.LABEL_TOKEN)}, 2) AS batch_label "
        "FROM fx_arrivals",
        "retention_split": "SELECT o_orderkey, o_orderdate, o_orderstatus, CASE WHEN o_orderdate < "
        f"{ts(X.RETENTION_AS_OF.replace(day=1))} THEN 'archive' ELSE 'active' END AS retention FROM orders",
        "retention_purge": "SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders WHERE NOT "
        f"coalesce(o_orderdate < {ts(X.RETENTION_AS_OF.replace(day=1))}, false)",
    }
    lookback = X.ARRIVALS_AS_OF - timedelta(hours=X.ARRIVALS_LOOKBACK_HOURS)
    out["latest_arrival"] = X.with_clause("fx_arrivals") + f""",
ranked AS (SELECT *, dense_rank() OVER (PARTITION BY feed, folder ORDER BY received_at DESC, message_id DESC) AS rk
  FROM fx_arrivals WHERE folder IN ('inbox', {q(X.ARRIVALS_FALLBACK_FOLDER)})),
cand AS (SELECT *, CASE WHEN folder = 'inbox' AND contains(lower(subject), {q(X.ARRIVALS_KEYWORD.lower())})
      AND received_at >= {ts(lookback)} THEN 1 WHEN folder = {q(X.ARRIVALS_FALLBACK_FOLDER)} THEN 2 END AS tier
  FROM ranked WHERE rk <= {X.ARRIVALS_MAX_MESSAGES} AND attachment_type = 'file'
    AND starts_with(lower(file_name), {q(X.ARRIVALS_PREFIX.lower())}) AND ends_with(lower(file_name), '.xlsx'))
SELECT feed, tier, message_id, file_name, received_at FROM (
  SELECT *, row_number() OVER (PARTITION BY feed ORDER BY tier ASC, received_at DESC, message_id DESC,
      attachment_pos ASC) AS rn FROM cand WHERE tier IS NOT NULL) WHERE rn = 1"""
    from shortfall.plans.catalogue import AUDIT_DURATION_SECONDS, AUDIT_RUN_TIME
    out["run_audit"] = _with(
        *PIPE_TO_ALT, STAMP) + f"""SELECT 'shortfall' AS process_name, '1' AS process_id,
  '' AS source_file_path, {ts(AUDIT_RUN_TIME)} AS last_run_time, 'Not Applicable' AS target_table_name,
  'SUCCESS' AS task_status, (SELECT count(*) FROM feed) AS row_count, CAST({AUDIT_DURATION_SECONDS} AS INTEGER) AS duration,
  'jobs/shortfall' AS package_path, '' AS log_file_path, 'Not Applicable' AS stg_table_name,
  'weekly' AS process_frequency, '' AS error,
  (SELECT count(*) FROM feed WHERE risk_selected = 'x') AS selected_rows,
  (SELECT count(*) FROM full_ds f LEFT JOIN alt_tab a ON {_ns('f', 'a')} AND f.review_flag = 'Review') AS output_rows"""
    return out


def oracle_sql() -> dict[str, str]:
    return _catalogue()
