"""The same results in ANSI SQL over the test tables, written independently of the plans."""

from __future__ import annotations

import math

from marketide.plans.registry import CORRELATED
from marketide.sources.roles import (
    AGE_GROUPS,
    CPI_GAP,
    CPI_MONTHS,
    CPI_START,
    HOLIDAY_MONTH_DAYS,
    HOLIDAY_YEARS,
    PROMOTION_COLUMNS,
    PROMOTION_ROWS,
)

# The labels of the test tables, stated here; the queries find theirs in the data.
LABELS = {
    "category": ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"],
    "segment": [f"Brand#{i}" for i in range(1, 26)],
    "color": ["blue", "cold", "hot", "large", "new", "old", "red", "small"],
}

_HOLIDAYS = ", ".join(f"(DATE '{y}-{md}')" for y in HOLIDAY_YEARS for md in HOLIDAY_MONTH_DAYS)

# Named building blocks; every query states those it needs, in this order.
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "r_lines": ((), """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
               l_extendedprice / l_quantity AS unit_price,
               CASE WHEN l_discount > 0
                    THEN 'P' || CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) END AS promo_id
        FROM lineitem"""),
    "r_orders": ((), """
        SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'Cancelled' WHEN 'O' THEN 'delivered'
                    ELSE 'shipped' END AS order_status,
               o_orderpriority AS payment_method
        FROM orders"""),
    "r_products": ((), """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS segment,
               CASE WHEN p_size <= 10 THEN 'S' WHEN p_size <= 20 THEN 'M' WHEN p_size <= 30 THEN 'L'
                    WHEN p_size <= 40 THEN 'XL' ELSE 'XXL' END AS size,
               split_part(p_name, ' ', 1) AS color, p_retailprice AS price,
               p_retailprice * (CAST(0.5 AS DOUBLE) + CAST(p_size AS DOUBLE) / 200) AS cogs
        FROM part"""),
    "r_customers": ((), f"""
        SELECT c_custkey AS customer_id, CAST(c_nationkey AS VARCHAR) AS zip, n_name AS city,
               DATE '1994-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS signup_date,
               CASE c_custkey % 3 WHEN 0 THEN 'female' WHEN 1 THEN 'male' END AS gender,
               ([{AGE_GROUPS}, NULL])[CAST(c_custkey % 7 AS INTEGER) + 1] AS age_group,
               c_mktsegment AS acquisition_channel
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey"""),
    "r_geography": ((), """
        SELECT CAST(n_nationkey AS VARCHAR) AS zip, n_name AS city, r_name AS region,
               'district ' || CAST(n_nationkey % 4 AS VARCHAR) AS district
        FROM nation LEFT JOIN region ON r_regionkey = n_regionkey"""),
    "r_payments": ((), """
        SELECT o_orderkey AS order_id, o_orderpriority AS payment_method, o_totalprice AS payment_value,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS installments
        FROM orders"""),
    "r_shipments": ((), """
        SELECT l_orderkey AS order_id, CAST(min(l_shipdate) AS DATE) AS ship_date,
               CAST(max(l_shipdate) AS DATE) AS delivery_date, min(l_tax) * 100 AS shipping_fee
        FROM lineitem GROUP BY l_orderkey"""),
    "r_returns": ((), """
        SELECT l_orderkey AS order_id, l_partkey AS product_id,
               CAST(l_quantity AS INTEGER) AS return_quantity, l_linestatus AS return_reason,
               CAST(l_shipdate AS DATE) AS return_date
        FROM lineitem WHERE l_returnflag = 'R'"""),
    "r_reviews": ((), """
        SELECT l_orderkey AS order_id, l_partkey AS product_id,
               CAST(least(l_linenumber, 5) AS INTEGER) AS rating, CAST(l_shipdate AS DATE) AS review_date
        FROM lineitem"""),
    "r_promotions": ((), f"""
        SELECT promo_id, promo_name, promo_type, CAST(discount_value AS DOUBLE) AS discount_value,
               start_date, end_date, applicable_category, promo_channel, stackable_flag, min_order_value
        FROM (VALUES {PROMOTION_ROWS}) AS t({PROMOTION_COLUMNS})"""),
    "r_holidays": ((), f"SELECT date FROM (VALUES {_HOLIDAYS}) AS t(date)"),
    "r_cpi": ((), f"""
        SELECT CAST(DATE '{CPI_START}' + to_months(CAST(i AS INTEGER)) AS DATE) AS month_start,
               CAST(80 AS DOUBLE) + CAST(i AS DOUBLE) / 4 AS CPI
        FROM range({CPI_MONTHS}) AS t(i)
        WHERE CAST(DATE '{CPI_START}' + to_months(CAST(i AS INTEGER)) AS DATE) <> DATE '{CPI_GAP}'"""),
    "r_sessions": ((), """
        SELECT CAST(o_orderdate AS DATE) AS date, count(DISTINCT o_custkey) AS sessions
        FROM orders GROUP BY 1"""),
    "dim_customer": (("r_customers", "r_geography"), """
        SELECT c.zip, customer_id, c.city, region, district, signup_date, gender, age_group,
               acquisition_channel
        FROM r_customers c LEFT JOIN r_geography g ON g.zip = c.zip"""),
    "returns_by_line": (("r_returns",), """
        SELECT order_id, product_id, sum(return_quantity) AS return_quantity,
               max(return_date) AS return_date,
               coalesce(string_agg(DISTINCT return_reason, ', ' ORDER BY return_reason), '') AS return_reason
        FROM r_returns GROUP BY order_id, product_id"""),
    "reviews_by_line": (("r_reviews",), """
        SELECT order_id, product_id, CAST(round_even(avg(rating), 0) AS INTEGER) AS rating,
               max(review_date) AS review_date
        FROM r_reviews GROUP BY order_id, product_id"""),
    "priced": (("r_lines", "r_orders", "r_products", "r_promotions", "returns_by_line"), """
        SELECT l.order_id, l.product_id, l.quantity, l.unit_price, l.promo_id, p.promo_name,
               o.order_date, o.customer_id, o.order_status, o.payment_method,
               pr.category, pr.segment, pr.color, pr.cogs,
               rt.return_quantity, rt.return_reason,
               l.unit_price * l.quantity AS base_revenue,
               least(CASE WHEN sum(l.unit_price * l.quantity)
                               OVER (PARTITION BY l.order_id) >= coalesce(p.min_order_value, 0)
                     THEN CASE WHEN p.promo_type = 'percentage'
                               THEN l.unit_price * l.quantity * (p.discount_value / 100.0) ELSE 0 END
                        + CASE WHEN p.promo_type = 'fixed' THEN p.discount_value ELSE 0 END
                     ELSE 0 END, l.unit_price * l.quantity) AS final_discount
        FROM r_lines l
        LEFT JOIN r_orders o ON o.order_id = l.order_id
        LEFT JOIN returns_by_line rt ON rt.order_id = l.order_id AND rt.product_id = l.product_id
        LEFT JOIN r_products pr ON pr.product_id = l.product_id
        LEFT JOIN r_promotions p ON p.promo_id = l.promo_id"""),
    "sold": (("priced",), """
        SELECT *, base_revenue - final_discount AS actual_revenue,
               (base_revenue - final_discount) - cogs * quantity AS gross_profit
        FROM priced"""),
    "daily": (("sold",), """
        SELECT order_date AS date,
               round(fsum(actual_revenue), 6) AS actual_revenue,
               round(fsum(gross_profit), 6) AS gross_profit,
               count(DISTINCT order_id) AS order_id, CAST(sum(quantity) AS BIGINT) AS quantity,
               count(DISTINCT customer_id) AS customer_id,
               CAST(sum(CASE WHEN return_quantity > 0 THEN 1 ELSE 0 END) AS BIGINT) AS is_returned
        FROM sold GROUP BY order_date"""),
    "naive": (("daily",), """
        SELECT date, actual, pred, abs(actual - pred) AS abs_error
        FROM (SELECT date, actual_revenue AS actual, lag(actual_revenue, 7) OVER (ORDER BY date) AS pred
              FROM daily)
        WHERE pred IS NOT NULL"""),
    "deflated": (("daily", "r_cpi"), """
        SELECT * EXCLUDE (seen), CPI / 100.0 AS inflation_factor,
               actual_revenue / (CPI / 100.0) AS real_revenue
        FROM (SELECT j.* EXCLUDE (raw),
                     coalesce(last_value(raw IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN
                                  UNBOUNDED PRECEDING AND CURRENT ROW),
                              first_value(raw IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN
                                  CURRENT ROW AND UNBOUNDED FOLLOWING)) AS CPI, raw AS seen
              FROM (SELECT d.*, c.CPI AS raw
                    FROM daily d LEFT JOIN r_cpi c ON c.month_start = date_trunc('month', d.date)) j)"""),
    "sales": (("daily",), """
        SELECT date, actual_revenue AS Revenue, actual_revenue - gross_profit AS COGS FROM daily"""),
    "annual": (("sales",), """
        SELECT year(date) AS year, sum(Revenue) AS Revenue, sum(COGS) AS COGS FROM sales GROUP BY 1"""),
    "growth": (("annual",), """
        SELECT year, rev_growth, cogs_growth
        FROM (SELECT year, Revenue / lag(Revenue) OVER (ORDER BY year) - 1 AS rev_growth,
                     COGS / lag(COGS) OVER (ORDER BY year) - 1 AS cogs_growth
              FROM annual WHERE year BETWEEN 1995 AND 2000)
        WHERE rev_growth IS NOT NULL"""),
    "mean_growth": (("growth",), """
        SELECT pow(product(1 + rev_growth), 1.0 / count(*)) AS growth_rev,
               pow(product(1 + cogs_growth), 1.0 / count(*)) AS growth_cogs
        FROM growth"""),
    "profile": (("sales",), """
        SELECT month(date) AS month, day(date) AS day, avg(rn) AS rev_norm, avg(cn) AS cogs_norm
        FROM (SELECT date, Revenue / avg(Revenue) OVER (PARTITION BY year(date)) AS rn,
                     COGS / avg(COGS) OVER (PARTITION BY year(date)) AS cn
              FROM sales)
        GROUP BY 1, 2"""),
    "forecast": (("annual", "mean_growth", "profile"), """
        SELECT s.date, s.Revenue, s.COGS,
               (SELECT Revenue / 365 FROM annual WHERE year = 2000)
                 * pow((SELECT growth_rev FROM mean_growth), year(s.date) - 2000)
                 * coalesce(p.rev_norm, 1.0) AS Revenue_pred,
               (SELECT COGS / 365 FROM annual WHERE year = 2000)
                 * pow((SELECT growth_cogs FROM mean_growth), year(s.date) - 2000)
                 * coalesce(p.cogs_norm, 1.0) AS COGS_pred
        FROM sales s LEFT JOIN profile p ON p.month = month(s.date) AND p.day = day(s.date)"""),
}


def _needed(name: str, found: list[str]) -> list[str]:
    for other in PARTS[name][0]:
        _needed(other, found)
    if name not in found:
        found.append(name)
    return found


def with_parts(names: str, body: str, recursive: bool = False, **extra: str) -> str:
    """``body`` below the building blocks it uses; ``extra`` adds blocks of its own."""
    found: list[str] = []
    for name in names.split():
        _needed(name, found)
    blocks = [f"{n} AS ({PARTS[n][1]})" for n in found] + [f"{n} AS ({b})" for n, b in extra.items()]
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(blocks)} {body}" if blocks else body


# --- pieces of the window features -------------------------------------------------


def _ewm_sql(source: str, value: str, span: int, keys: str = "") -> str:
    """Weighted mean of all earlier rows, by pairing each row with those before it."""
    decay = 1 - 2 / (span + 1)
    back = math.ceil(math.log(1e-16) / math.log(decay))
    part = f"PARTITION BY {keys} " if keys else ""
    same = f"AND b.{keys} = a.{keys}" if keys else ""
    group = f", a.{keys}" if keys else ""
    return f"""
        SELECT a.date{group},
               sum(b.v * pow({decay!r}, a.rn - b.rn - 1)) / sum(pow({decay!r}, a.rn - b.rn - 1)) AS ewm
        FROM (SELECT *, {value} AS v, row_number() OVER ({part}ORDER BY date) AS rn FROM {source}) a
        JOIN (SELECT *, {value} AS v, row_number() OVER ({part}ORDER BY date) AS rn FROM {source}) b
          ON b.rn BETWEEN a.rn - {back} AND a.rn - 1 {same}
        GROUP BY a.date{group}"""


def _mean_sql(value: str, n: int, window: str = "(ORDER BY date)") -> str:
    """Mean of the n rows before, as a plain sum of lags: NULL unless all are there."""
    lags = " + ".join(f"lag({value}, {i}) OVER {window}" for i in range(n, 0, -1))
    return f"({lags}) / {float(n)}"


def _std_sql(value: str, n: int, day: str = "date", digits: int | None = 2) -> str:
    frame = f"(ORDER BY {day} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    std = f"CASE WHEN count({value}) OVER {frame} = {n} THEN stddev_samp({value}) OVER {frame} END"
    return std if digits is None else f"round({std}, {digits})"


def _flag_interval(day: str = "d.date") -> str:
    return (
        f"CAST(EXISTS (SELECT 1 FROM r_promotions p WHERE {day} BETWEEN p.start_date AND p.end_date) "
        "AS INTEGER)"
    )


def _flag_holiday(day: str = "d.date") -> str:
    return f"CAST(EXISTS (SELECT 1 FROM r_holidays h WHERE h.date = {day}) AS INTEGER)"


def _calendar(day: str, harmonics: bool = True) -> str:
    parts = [
        f"CAST(year({day}) AS INTEGER) AS year", f"CAST(month({day}) AS INTEGER) AS month",
        f"CAST(day({day}) AS INTEGER) AS day", f"CAST(isodow({day}) - 1 AS INTEGER) AS dayofweek",
        f"CAST(isodow({day}) >= 6 AS INTEGER) AS is_weekend",
        f"CAST(quarter({day}) AS INTEGER) AS quarter",
    ]
    if harmonics:
        parts += [
            f"CAST(dayofyear({day}) AS INTEGER) AS dayofyear", f"CAST(week({day}) AS INTEGER) AS week",
        ]
        for k in (1, 2):
            angle = f"{2 * math.pi * k!r} * dayofyear({day}) / 365.25"
            parts += [f"round(sin({angle}), 9) AS sin_year_{k}", f"round(cos({angle}), 9) AS cos_year_{k}"]
    return ", ".join(parts)


_SESSIONS_ROLL = f"SELECT date, {_mean_sql('sessions', 30)} AS sessions_roll_30_lag1 FROM r_sessions"
_SESSIONS_LAG = "SELECT date, lag(sessions) OVER (ORDER BY date) AS sessions_lag1 FROM r_sessions"

# Unrounded training matrix; ewma blocks need the deflated series under a name.
_MATRIX = f"""
    SELECT d.date, d.real_revenue AS actual_revenue, {_calendar('d.date')},
           {_flag_holiday()} AS is_holiday, {_flag_interval()} AS is_promo_active, d.CPI,
           d.inflation_factor, w.* EXCLUDE (date), e7.ewm AS revenue_ewma_7_lag1,
           e30.ewm AS revenue_ewma_30_lag1, s.sessions_roll_30_lag1
    FROM deflated d
    JOIN (SELECT date,
                 lag(real_revenue, 1) OVER (ORDER BY date) AS actual_revenue_lag1,
                 lag(real_revenue, 7) OVER (ORDER BY date) AS actual_revenue_lag7,
                 lag(real_revenue, 14) OVER (ORDER BY date) AS actual_revenue_lag14,
                 lag(real_revenue, 30) OVER (ORDER BY date) AS actual_revenue_lag30,
                 lag(real_revenue, 1) OVER (ORDER BY date) - lag(real_revenue, 7) OVER (ORDER BY date)
                   AS revenue_diff_lag1_lag7,
                 {_mean_sql('real_revenue', 7)} AS revenue_roll_mean_7_lag1,
                 {_mean_sql('real_revenue', 14)} AS revenue_roll_mean_14_lag1,
                 {_mean_sql('real_revenue', 30)} AS revenue_roll_mean_30_lag1,
                 {_std_sql('real_revenue', 7, digits=None)} AS revenue_roll_std_7_lag1
          FROM deflated) w ON w.date = d.date
    LEFT JOIN ({_ewm_sql('deflated', 'real_revenue', 7)}) e7 ON e7.date = d.date
    LEFT JOIN ({_ewm_sql('deflated', 'real_revenue', 30)}) e30 ON e30.date = d.date
    LEFT JOIN ({_SESSIONS_ROLL}) s ON s.date = d.date
    WHERE w.actual_revenue_lag30 IS NOT NULL AND s.sessions_roll_30_lag1 IS NOT NULL"""
_MATRIX_PARTS = "deflated r_promotions r_holidays r_sessions"

def _one_hot(column: str, labels: list[str], prefix: str | None = None) -> str:
    name = (prefix or column).replace("#", "_")
    return ", ".join(
        f"CAST(coalesce({column} = '{v}', false) AS INTEGER) AS \"{name}_{v.replace('#', '_')}\""
        for v in labels
    )


def _sliced() -> str:
    return ", ".join(
        f"coalesce(round(fsum(CASE WHEN {c} = '{v}' THEN actual_revenue END), 6), 0) "
        f"AS \"revenue_{c}_{v.replace('#', '_')}\""
        for c, labels in LABELS.items() for v in labels
    )


def _labels_long(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM {source}" for c in columns
    )


_LABELLED = {
    "products": ["category", "segment", "color"],
    "customers": ["city", "gender", "age_group", "acquisition_channel"],
    "promotions": ["promo_name", "promo_type", "applicable_category", "promo_channel"],
    "geography": ["city", "region", "district"],
}


def _all_labels() -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, * FROM ({_labels_long('r_' + table, columns)})"
        for table, columns in _LABELLED.items()
    )


def _linear_blocks(source: str, keys: tuple[str, ...]) -> dict[str, str]:
    """Least squares on the values one and seven rows before, then day by day."""
    k = "".join(f"{key}, " for key in keys)
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    same = " AND ".join(f"walk.{key} = weights.{key}" for key in keys) or "true"
    walked = "".join(f"walk.{key}, " for key in keys)
    return {
        "lagged": f"""
            SELECT {k}actual_revenue AS y, lag(actual_revenue, 1) OVER w AS x, lag(actual_revenue, 7) OVER w AS z
            FROM {source} WHERE year(date) <= 2000 WINDOW w AS ({part}ORDER BY date)""",
        "moments": f"""
            SELECT {k}avg(y) AS my, avg(x) AS mx, avg(z) AS mz, var_pop(x) AS vx, var_pop(z) AS vz,
                   covar_pop(x, z) AS cxz, covar_pop(x, y) AS cxy, covar_pop(z, y) AS czy
            FROM lagged WHERE z IS NOT NULL {group}""",
        "weights": """
            SELECT *, (cxy * vz - czy * cxz) / (vx * vz - cxz * cxz) AS b,
                   (czy * vx - cxy * cxz) / (vx * vz - cxz * cxz) AS c FROM moments""",
        "recent": f"""
            SELECT {k}list(actual_revenue ORDER BY date) AS s FROM (
                SELECT {k}date, actual_revenue, row_number() OVER ({part}ORDER BY date DESC) AS n
                FROM {source} WHERE year(date) <= 2000) WHERE n <= 7 {group}""",
        "walk": f"""
            SELECT {k}0 AS step, s FROM recent
            UNION ALL
            SELECT {walked}step + 1, list_append(s[2:], greatest(my - b * mx - c * mz + b * s[7] + c * s[1], 0.0))
            FROM walk JOIN weights ON {same} WHERE step < 400""",
    }


def _linear_body(source: str, keys: tuple[str, ...]) -> str:
    k = "".join(f"{key}, " for key in keys)
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    return f"""
        SELECT {k}date, round(s[7], 2) AS forecast
        FROM walk JOIN (
            SELECT {k}date, row_number() OVER ({part}ORDER BY date) AS step
            FROM (SELECT DISTINCT {k}date FROM {source} WHERE year(date) > 2000)) AS target USING ({k}step)"""


_TABLE_COLUMNS = {
    "products": ("r_products", ["product_id", "product_name", "category", "segment", "size", "color",
                                "price", "cogs"]),
    "customers": ("r_customers", ["customer_id", "zip", "city", "signup_date", "gender", "age_group",
                                  "acquisition_channel"]),
    "geography": ("r_geography", ["zip", "city", "region", "district"]),
    "orders": ("r_orders", ["order_id", "order_date", "customer_id", "order_status", "payment_method"]),
    "order_items": ("r_lines", ["order_id", "product_id", "quantity", "unit_price", "promo_id"]),
    "payments": ("r_payments", ["order_id", "payment_method", "payment_value", "installments"]),
    "shipments": ("r_shipments", ["order_id", "ship_date", "delivery_date", "shipping_fee"]),
    "returns": ("r_returns", ["order_id", "product_id", "return_quantity", "return_reason",
                              "return_date"]),
    "reviews": ("r_reviews", ["order_id", "product_id", "rating", "review_date"]),
    "promotions": ("r_promotions", [c.strip() for c in PROMOTION_COLUMNS.split(",")]),
    "web_traffic": ("(SELECT CAST(ts AS DATE) AS date, event_type AS traffic_source, "
                    "value AS bounce_rate FROM events)", ["date", "traffic_source", "bounce_rate"]),
}
_RAW_PARTS = " ".join(s for s, _ in _TABLE_COLUMNS.values() if s.startswith("r_"))


def _null_profile() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS n_null, "
        f"count(*) AS n_rows FROM {source} AS s_{t}"
        for t, (source, columns) in _TABLE_COLUMNS.items() for c in columns
    )


def _duplicate_profile() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, "
        f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates FROM (SELECT count(*) AS n "
        f"FROM {source} AS s_{t} GROUP BY {', '.join(columns)})"
        for t, (source, columns) in _TABLE_COLUMNS.items()
    )


def _summary(rows: list[tuple[str, str, int, str | None]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, {width} AS n_columns, "
        + (f"min({day}) AS first_date, max({day}) AS last_date" if day
           else "CAST(NULL AS DATE) AS first_date, CAST(NULL AS DATE) AS last_date")
        + f" FROM {source} AS s_{name}"
        for name, source, width, day in rows
    )


_EVENTS_TRAFFIC = _TABLE_COLUMNS["web_traffic"][0]

_FACT = """
    SELECT s.order_id, s.product_id, s.quantity, s.unit_price, s.promo_id, s.order_date, s.customer_id,
           s.order_status, s.payment_method, py.installments, sh.shipping_fee, sh.ship_date,
           sh.delivery_date, CAST(sh.delivery_date - sh.ship_date AS INTEGER) AS delivery_days,
           CAST(s.return_quantity AS DOUBLE) AS return_quantity, s.return_reason, s.actual_revenue,
           s.gross_profit
    FROM sold s
    LEFT JOIN r_payments py ON py.order_id = s.order_id
    LEFT JOIN r_shipments sh ON sh.order_id = s.order_id"""

_GAPS = """
    SELECT CAST(median(gap) AS DOUBLE) AS median_gap_days
    FROM (SELECT order_date - lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date) AS gap
          FROM r_orders) WHERE gap IS NOT NULL"""

_SIZE_RATES = """
    SELECT size, CAST(sum(l.quantity) AS BIGINT) AS total_sold,
           CAST(sum(coalesce(r.return_quantity, 0)) AS BIGINT) AS total_returned,
           round(CAST(sum(coalesce(r.return_quantity, 0)) AS DOUBLE) / sum(l.quantity), 9) AS return_rate
    FROM r_lines l JOIN r_products p ON p.product_id = l.product_id
    LEFT JOIN r_returns r ON r.order_id = l.order_id AND r.product_id = l.product_id
    GROUP BY size"""

_CITY_RANK = """
    SELECT city, n, CAST(row_number() OVER (ORDER BY n, city NULLS FIRST) AS INTEGER) AS rank
    FROM (SELECT city, count(*) AS n FROM r_customers GROUP BY city)"""

_AGE_CODE = (
    "CASE age_group WHEN '18-24' THEN 1 WHEN '25-34' THEN 2 WHEN '35-44' THEN 3 "
    "WHEN '45-54' THEN 4 WHEN '55+' THEN 5 ELSE 0 END"
)
_SIZE_CODE = "CASE size WHEN 'S' THEN 1 WHEN 'M' THEN 2 WHEN 'L' THEN 3 WHEN 'XL' THEN 4 ELSE 5 END"

_CHANNELS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_PROMO_CHANNELS = ["call_centre", "mobile_app", "storefront", "voucher"]
_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def _first(order: str, body: str) -> str:
    return f"SELECT * FROM ({body}) ORDER BY {order} LIMIT 1"


def _correlation(target: str, features: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, round(abs(corr(CAST({f} AS DOUBLE), {target})), 8) "
        "AS correlation_score FROM m" for f in features
    )


def _promoted_pct() -> str:
    return "SELECT round(avg(CASE WHEN promo_id IS NULL THEN 0.0 ELSE 1.0 END) * 100, 9) AS promoted_pct FROM r_lines"


# Date columns of the results; they are compared as ISO text.
_NET_DATES = ["order_date", "ship_date", "delivery_date", "return_date", "review_date", "start_date", "end_date"]
_DATE_COLUMNS = {
    "dim_customer": ["signup_date"],
    "fact_sales": ["order_date", "ship_date", "delivery_date"],
    "net_revenue_lines": _NET_DATES,
    "transaction_master": [*_NET_DATES, "signup_date"],
    "transaction_matrix": ["order_date", "ship_date", "delivery_date", "return_date", "review_date"],
    "publish_star": ["first_date", "last_date"],
    "table_summary": ["first_date", "last_date"],
    "encoded_promotions": ["start_date", "end_date"],
    "submission_merge": ["Date"],
    "csv_orders": ["order_date"],
    "csv_customers": ["signup_date"],
} | {
    name: ["date"] for name in (
        "recursive_forecast_linear", "regional_forecast_linear", "daily_sales", "daily_series", "daily_sliced_revenue", "daily_slices_long", "latest_days", "calendar_features",
        "promo_active_days", "holiday_flags", "cpi_deflate", "inflation_lookup", "lag_features",
        "rolling_features", "ewma_features", "regional_series", "traffic_rolling", "training_matrix",
        "training_matrix_v1", "chrono_split", "expanding_folds", "last_n", "seasonal_forecast",
        "naive_lag7_errors", "worst_best_days", "scaled_features",
    )
}


_NET_PARTS = "sold r_payments r_shipments returns_by_line reviews_by_line r_promotions"
_NET_LINES = """
    SELECT s.order_id, s.product_id, s.quantity, s.unit_price, s.promo_id, s.order_date, s.customer_id,
           s.order_status, s.payment_method, py.installments, sh.ship_date, sh.delivery_date, sh.shipping_fee,
           CAST(coalesce(s.return_quantity, 0) AS INTEGER) AS return_quantity, rt.return_date, s.return_reason,
           coalesce(rv.rating, -1) AS rating, rv.review_date,
           CASE WHEN s.return_quantity > 0 THEN 1 ELSE 0 END AS is_returned,
           s.promo_name, pm.start_date, pm.end_date, pm.applicable_category, pm.promo_channel, pm.stackable_flag,
           s.base_revenue, s.final_discount, s.actual_revenue
    FROM sold s
    LEFT JOIN r_payments py ON py.order_id = s.order_id
    LEFT JOIN r_shipments sh ON sh.order_id = s.order_id
    LEFT JOIN returns_by_line rt ON rt.order_id = s.order_id AND rt.product_id = s.product_id
    LEFT JOIN reviews_by_line rv ON rv.order_id = s.order_id AND rv.product_id = s.product_id
    LEFT JOIN r_promotions pm ON pm.promo_id = s.promo_id"""


def oracles() -> dict[str, str]:
    """SQL per query name."""
    out = _plain_oracles()
    for name, columns in _DATE_COLUMNS.items():
        texts = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in columns)
        out[name] = f"SELECT * REPLACE ({texts}) FROM ({out[name]}) AS result"
    # The path of large tables has to give the same rows.
    spread = ("transaction_master", "fact_sales", "transaction_matrix", "daily_series", "join_reconciliation", "duplicate_profile")
    blocks = ("lag_features", "rolling_features", "ewma_features")
    return (
        out | {f"{name}_spread": out[name] for name in spread} | {f"{name}_blocks": out[name] for name in blocks}
        | {"promo_active_days_sweep": out["promo_active_days"], "daily_sliced_revenue_sparse": out["daily_sliced_revenue"]}
    )


def _plain_oracles() -> dict[str, str]:

    margin = (
        "SELECT segment, round(avg((price - cogs) / price), 9) AS gross_margin "
        "FROM r_products GROUP BY segment"
    )
    region = (
        "SELECT region, round(fsum(actual_revenue), 6) "
        "AS actual_revenue FROM sold s JOIN dim_customer c ON c.customer_id = s.customer_id "
        "GROUP BY region"
    )
    summary = (
        "SELECT count(*) AS n, round(avg(abs_error), 4) AS mae, "
        "round(sqrt(avg(abs_error * abs_error)), 4) AS rmse, "
        "round(avg(abs_error / actual) * 100, 4) AS mape, "
    )
    by_region = (
        "SELECT region, order_date AS date, "
        "round(fsum(actual_revenue), 6) AS actual_revenue "
        "FROM sold s LEFT JOIN dim_customer c ON c.customer_id = s.customer_id GROUP BY 1, 2"
    )
    return {
        "dim_product": with_parts("r_products", "SELECT * FROM r_products"),
        "dim_customer": with_parts("dim_customer", "SELECT * FROM dim_customer"),
        "fact_sales": with_parts("sold r_payments r_shipments", _FACT),
        "transaction_matrix": with_parts(
            "r_lines r_orders r_payments r_shipments returns_by_line reviews_by_line", """
            SELECT l.*, o.order_date, o.customer_id, o.order_status, o.payment_method, py.installments,
                   sh.ship_date, sh.delivery_date, sh.shipping_fee,
                   CAST(coalesce(rt.return_quantity, 0) AS INTEGER) AS return_quantity,
                   rt.return_date, rt.return_reason, coalesce(rv.rating, -1) AS rating, rv.review_date,
                   CASE WHEN rt.return_quantity > 0 THEN 1 ELSE 0 END AS is_returned
            FROM r_lines l
            LEFT JOIN r_orders o ON o.order_id = l.order_id
            LEFT JOIN r_payments py ON py.order_id = l.order_id
            LEFT JOIN r_shipments sh ON sh.order_id = l.order_id
            LEFT JOIN returns_by_line rt ON rt.order_id = l.order_id AND rt.product_id = l.product_id
            LEFT JOIN reviews_by_line rv ON rv.order_id = l.order_id AND rv.product_id = l.product_id"""),
        "net_revenue_lines": with_parts(_NET_PARTS, _NET_LINES),
        "transaction_master": with_parts(f"{_NET_PARTS} r_products r_customers", f"""
            SELECT n.*, p.product_name, {_SIZE_CODE} AS size, p.price, p.cogs,
                   {', '.join(_one_hot(c, LABELS[c]) for c in LABELS)},
                   c.zip, cr.rank AS city, c.signup_date, {_AGE_CODE} AS age_group,
                   {_one_hot('gender', ['female', 'male'])}, {_one_hot('acquisition_channel', _CHANNELS)},
                   p.cogs * n.quantity AS total_cogs, n.actual_revenue - p.cogs * n.quantity AS gross_profit
            FROM ({_NET_LINES}) n JOIN r_products p ON p.product_id = n.product_id
            LEFT JOIN r_customers c ON c.customer_id = n.customer_id
            LEFT JOIN ({_CITY_RANK}) cr ON cr.city = c.city"""),
        "publish_star": with_parts(
            "sold r_payments r_shipments r_products dim_customer r_promotions",
            _summary([
                ("dim_product", "r_products", 8, None),
                ("dim_customer", "dim_customer", 9, "signup_date"),
                ("dim_promotion", "r_promotions", 10, "start_date"),
                ("fact_sales", f"({_FACT})", 18, "order_date"),
                ("fact_inventory", "part", 6, None),
                ("fact_webtraffic", _EVENTS_TRAFFIC, 3, "date"),
            ])),
        "daily_sales": with_parts("daily", "SELECT * FROM daily"),
        "daily_series": with_parts(
            "daily", "SELECT * FROM daily JOIN sliced USING (date)",
            sliced=f"SELECT order_date AS date, {_sliced()} FROM sold GROUP BY order_date"),
        "daily_sliced_revenue": with_parts(
            "sold", f"SELECT order_date AS date, {_sliced()} FROM sold GROUP BY order_date"),
        "daily_slices_long": with_parts("sold", " UNION ALL ".join(
            f"SELECT order_date AS date, '{c}' AS slice, {c} AS label, "
            "round(fsum(actual_revenue), 6) AS revenue "
            f"FROM sold WHERE {c} IS NOT NULL GROUP BY order_date, {c}" for c in LABELS)),
        "q1_order_gap": with_parts("r_orders", _GAPS),
        "q2_segment_margin": with_parts("r_products", _first("gross_margin DESC, segment", margin)),
        "q2_segment_margin_report": with_parts("r_products", margin),
        "q3_return_reason": with_parts("r_returns r_products", _first("n_returns DESC, return_reason", """
            SELECT return_reason, count(*) AS n_returns FROM r_returns r
            JOIN r_products p ON p.product_id = r.product_id
            WHERE category = 'ECONOMY' GROUP BY return_reason""")),
        "q4_bounce_rate": _first("bounce_rate, traffic_source", """
            SELECT event_type AS traffic_source, round(avg(value), 6) AS bounce_rate
            FROM events GROUP BY 1"""),
        "q5_promoted_share": with_parts("r_lines", _promoted_pct()),
        "q6_age_group_orders": with_parts("r_orders dim_customer", _first("mean_orders DESC, age_group", """
            SELECT age_group, round(avg(n), 9) AS mean_orders
            FROM (SELECT o.customer_id, age_group, count(*) AS n FROM r_orders o
                  JOIN dim_customer c ON c.customer_id = o.customer_id
                  WHERE age_group IS NOT NULL GROUP BY 1, 2) GROUP BY age_group""")),
        "q7_region_revenue": with_parts("sold dim_customer", _first("actual_revenue DESC, region", region)),
        "q7_region_revenue_report": with_parts("sold dim_customer", region),
        "q8_cancelled_payment": with_parts("r_orders", _first("n_orders DESC, payment_method", """
            SELECT payment_method, count(*) AS n_orders FROM r_orders
            WHERE lower(order_status) = 'cancelled' GROUP BY payment_method""")),
        "q9_size_return_rate": with_parts(
            "r_lines r_products r_returns", _first("return_rate DESC, size", _SIZE_RATES)),
        "q9_return_rate_report": with_parts("r_lines r_products r_returns", _SIZE_RATES),
        "q9_return_rate_lines_once": with_parts("r_lines r_products r_returns", """
            SELECT size, CAST(sum(q) AS BIGINT) AS total_sold, CAST(sum(coalesce(rq, 0)) AS BIGINT)
                     AS total_returned, round(CAST(sum(coalesce(rq, 0)) AS DOUBLE) / sum(q), 9) AS return_rate
            FROM (SELECT order_id, product_id, sum(quantity) AS q FROM r_lines GROUP BY 1, 2) l
            JOIN r_products p ON p.product_id = l.product_id
            LEFT JOIN (SELECT order_id, product_id, sum(return_quantity) AS rq FROM r_returns
                       GROUP BY 1, 2) r ON r.order_id = l.order_id AND r.product_id = l.product_id
            GROUP BY size"""),
        "q10_installments": with_parts("r_payments", _first("payment_value DESC, installments", """
            SELECT installments, round(avg(payment_value), 4) AS payment_value
            FROM r_payments GROUP BY installments""")),
        "null_profile": with_parts(_RAW_PARTS, _null_profile()),
        "duplicate_profile": with_parts(_RAW_PARTS, _duplicate_profile()),
        "join_reconciliation": with_parts(
            "r_lines r_orders r_payments r_shipments r_returns returns_by_line r_reviews r_promotions",
            " UNION ALL ".join(
                f"SELECT {i} AS step, '{name}' AS step_name, count(*) AS n_rows, {matched} AS n_matched "
                f"FROM {joins}"
                for i, (name, matched, joins) in enumerate([
                    ("order_items", "count(*)", "r_lines l"),
                    ("orders", "count(o.order_id)", "r_lines l LEFT JOIN r_orders o USING (order_id)"),
                    ("payments", "count(o.order_id)",
                     "r_lines l LEFT JOIN r_payments o ON o.order_id = l.order_id"),
                    ("shipments", "count(o.order_id)",
                     "r_lines l LEFT JOIN r_shipments o ON o.order_id = l.order_id"),
                    ("returns", "count(o.order_id)", "r_lines l LEFT JOIN returns_by_line o "
                     "ON o.order_id = l.order_id AND o.product_id = l.product_id"),
                    ("single_returns", "count(o.order_id)", "r_lines l LEFT JOIN r_returns o "
                     "ON o.order_id = l.order_id AND o.product_id = l.product_id"),
                    ("reviews", "count(v.order_id)", "r_lines l LEFT JOIN r_returns o "
                     "ON o.order_id = l.order_id AND o.product_id = l.product_id "
                     "LEFT JOIN r_reviews v ON v.order_id = l.order_id AND v.product_id = l.product_id"),
                    ("promotions", "count(p.promo_id)", "r_lines l LEFT JOIN r_returns o "
                     "ON o.order_id = l.order_id AND o.product_id = l.product_id "
                     "LEFT JOIN r_reviews v ON v.order_id = l.order_id AND v.product_id = l.product_id "
                     "LEFT JOIN r_promotions p ON p.promo_id = l.promo_id"),
                ]))),
        "cardinality_profile": with_parts("r_products r_customers r_promotions r_geography", f"""
            SELECT table_name, column_name, count(DISTINCT value) AS n_unique, count(*) - count(value) AS n_null
            FROM ({_all_labels()}) GROUP BY 1, 2"""),
        "distinct_values": with_parts("r_products r_customers r_promotions r_geography", f"""
            SELECT table_name, column_name, value, count(*) AS n
            FROM ({_all_labels()}) WHERE value IS NOT NULL GROUP BY 1, 2, 3"""),
        "frequencies_with_null": with_parts("r_products r_customers r_promotions r_geography", f"""
            SELECT table_name, column_name, value, count(*) AS n FROM ({_all_labels()}) GROUP BY 1, 2, 3"""),
        "recursive_forecast_linear": with_parts(
            "daily", _linear_body("daily", ()), recursive=True, **_linear_blocks("daily", ())),
        "regional_forecast_linear": with_parts(
            "sold dim_customer", _linear_body("known_region", ("region",)), recursive=True,
            known_region=f"SELECT * FROM ({by_region}) WHERE region IS NOT NULL AND date IS NOT NULL",
            **_linear_blocks("known_region", ("region",))),
        "csv_orders": with_parts("r_orders", "SELECT * FROM r_orders"),
        "csv_customers": with_parts("r_customers", "SELECT * FROM r_customers"),
        "csv_order_items": with_parts("r_lines", "SELECT * FROM r_lines"),
        "frequency_with_null": with_parts(
            "r_customers", "SELECT age_group, count(*) AS n FROM r_customers GROUP BY age_group"),
        "table_summary": with_parts(_RAW_PARTS, _summary([
            ("orders", "r_orders", 5, "order_date"), ("order_items", "r_lines", 5, None),
            ("shipments", "r_shipments", 4, "ship_date"), ("returns", "r_returns", 5, "return_date"),
            ("reviews", "r_reviews", 4, "review_date"), ("customers", "r_customers", 7, "signup_date"),
            ("web_traffic", _EVENTS_TRAFFIC, 3, "date"),
        ])),
        "latest_days": with_parts("daily", """
            SELECT date, actual_revenue, quantity
            FROM daily ORDER BY date DESC LIMIT 5"""),
        "ordinal_encode": with_parts(
            "r_customers", f"SELECT customer_id, age_group, {_AGE_CODE} AS age_code FROM r_customers"),
        "encoded_products": with_parts("r_products", f"""
            SELECT product_id, product_name, {_SIZE_CODE} AS size, price, cogs,
                   {', '.join(_one_hot(c, LABELS[c]) for c in LABELS)} FROM r_products"""),
        "encoded_promotions": with_parts("r_promotions r_lines", f"""
            SELECT p.promo_id, promo_name, discount_value, start_date, end_date,
                   coalesce(applicable_category, 'all_categories') AS applicable_category,
                   stackable_flag, min_order_value, {_one_hot('promo_type', ['fixed', 'percentage'])},
                   {_one_hot('promo_channel', _PROMO_CHANNELS)}, n_lines
            FROM r_promotions p LEFT JOIN (SELECT promo_id, count(*) AS n_lines FROM r_lines
                                           GROUP BY promo_id) l ON l.promo_id = p.promo_id"""),
        "encoded_geography": with_parts(
            "r_geography", f"SELECT zip, city, district, {_one_hot('region', _REGIONS)} FROM r_geography"),
        "rank_encode_city": with_parts("r_customers", _CITY_RANK),
        "one_hot_sparse": with_parts("r_customers", """
            SELECT customer_id, coalesce(string_agg(CAST(label_id AS VARCHAR), ',' ORDER BY label_id), '') AS label_ids
            FROM (SELECT customer_id, gender, acquisition_channel, city FROM r_customers) c
            LEFT JOIN (SELECT column_name, label, row_number() OVER (ORDER BY column_name, label) - 1 AS label_id
                       FROM (SELECT DISTINCT column_name, label FROM (
                           SELECT 'gender' AS column_name, gender AS label FROM r_customers
                           UNION ALL SELECT 'acquisition_channel', acquisition_channel FROM r_customers
                           UNION ALL SELECT 'city', city FROM r_customers) WHERE label IS NOT NULL)) d
              ON label = CASE column_name WHEN 'gender' THEN gender WHEN 'city' THEN city ELSE acquisition_channel END
            GROUP BY customer_id"""),
        "one_hot": with_parts("r_customers", f"""
            SELECT customer_id, cr.rank AS city, {_AGE_CODE} AS age_group,
                   {_one_hot('gender', ['female', 'male'])},
                   {_one_hot('acquisition_channel', _CHANNELS)}
            FROM r_customers c LEFT JOIN ({_CITY_RANK}) cr ON cr.city = c.city"""),
        "calendar_features": with_parts("r_orders", f"""
            SELECT date, {_calendar('date')} FROM (SELECT DISTINCT order_date AS date FROM r_orders)"""),
        "promo_active_days": with_parts(
            "daily r_promotions", f"SELECT d.date, {_flag_interval()} AS is_promo_active FROM daily d"),
        "holiday_flags": with_parts(
            "daily r_holidays", f"SELECT d.date, {_flag_holiday()} AS is_holiday FROM daily d"),
        "cpi_deflate": with_parts("deflated", """
            SELECT date, CPI, inflation_factor, real_revenue FROM deflated"""),
        "inflation_lookup": with_parts("daily r_cpi", """
            SELECT date, f AS inflation_factor, actual_revenue * f AS nominal_revenue
            FROM (SELECT d.date, d.actual_revenue,
                         coalesce(c.CPI, (SELECT CPI FROM r_cpi ORDER BY month_start DESC LIMIT 1)) / 100.0 AS f
                  FROM daily d LEFT JOIN r_cpi c ON c.month_start = date_trunc('month', d.date))"""),
        "lag_features": with_parts("daily", """
            SELECT date, actual_revenue,
                   lag(actual_revenue, 1) OVER w AS actual_revenue_lag1,
                   lag(actual_revenue, 7) OVER w AS actual_revenue_lag7,
                   lag(actual_revenue, 14) OVER w AS actual_revenue_lag14,
                   lag(actual_revenue, 30) OVER w AS actual_revenue_lag30,
                   lag(actual_revenue, 1) OVER w - lag(actual_revenue, 7) OVER w
                     AS revenue_diff_lag1_lag7
            FROM daily WINDOW w AS (ORDER BY date)"""),
        "rolling_features": with_parts("daily", f"""
            SELECT date, actual_revenue,
                   {_mean_sql('actual_revenue', 7)} AS roll_mean_7,
                   {_mean_sql('actual_revenue', 14)} AS roll_mean_14,
                   {_mean_sql('actual_revenue', 30)} AS roll_mean_30,
                   {_std_sql('actual_revenue', 7)} AS roll_std_7
            FROM daily"""),
        "line_windows": with_parts("r_lines", """
            SELECT order_id, product_id, quantity,
                   CAST(sum(quantity) OVER (ORDER BY order_id, product_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_quantity,
                   lag(quantity, 1) OVER w AS quantity_lag1, lag(quantity, 30) OVER w AS quantity_lag30,
                   CASE WHEN count(quantity) OVER (ORDER BY order_id, product_id ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) = 7
                        THEN avg(quantity) OVER (ORDER BY order_id, product_id ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) END AS mean_7
            FROM (SELECT order_id, product_id, CAST(sum(quantity) AS BIGINT) AS quantity FROM r_lines GROUP BY ALL)
            WINDOW w AS (ORDER BY order_id, product_id)"""),
        "ewma_features": with_parts("daily", f"""
            SELECT d.date, actual_revenue, round(e7.ewm, 2) AS ewma_7,
                   round(e30.ewm, 2) AS ewma_30
            FROM daily d
            LEFT JOIN ({_ewm_sql('daily', 'actual_revenue', 7)}) e7 ON e7.date = d.date
            LEFT JOIN ({_ewm_sql('daily', 'actual_revenue', 30)}) e30 ON e30.date = d.date"""),
        "regional_series": with_parts("sold dim_customer", f"""
            SELECT r.region, r.date, actual_revenue,
                   lag(actual_revenue, 1) OVER w AS actual_revenue_lag1,
                   lag(actual_revenue, 7) OVER w AS actual_revenue_lag7,
                   {_mean_sql('actual_revenue', 7, 'w')} AS roll_mean_7,
                   round(e.ewm, 2) AS ewma_7
            FROM by_region r LEFT JOIN ({_ewm_sql('by_region', 'actual_revenue', 7, 'region')}) e
              ON e.date = r.date AND e.region = r.region
            WINDOW w AS (PARTITION BY r.region ORDER BY r.date)""",
            by_region=by_region),
        "traffic_rolling": with_parts("r_sessions", f"""
            SELECT date, {_mean_sql('sessions', 30)} AS sessions_roll_30_lag1,
                   CAST(lag(sessions) OVER (ORDER BY date) AS DOUBLE) AS sessions_lag1 FROM r_sessions"""),
        "training_matrix": with_parts(_MATRIX_PARTS, f"""
            SELECT * REPLACE (round(revenue_roll_std_7_lag1, 2) AS revenue_roll_std_7_lag1,
                              round(revenue_ewma_7_lag1, 2) AS revenue_ewma_7_lag1,
                              round(revenue_ewma_30_lag1, 2) AS revenue_ewma_30_lag1)
            FROM ({_MATRIX})"""),
        "training_matrix_v1": with_parts("sold daily r_sessions", f"""
            SELECT * FROM (
                SELECT d.date, actual_revenue, {_calendar('d.date', False)},
                       {', '.join(f'lag({c}, {n}) OVER w AS {c}_lag{n}' for n in (1, 7) for c in (
                           'actual_revenue', 'gross_profit', 'order_id', 'quantity', 'customer_id',
                           'is_returned'))},
                       {_mean_sql('actual_revenue', 7, 'w')} AS revenue_roll_mean_7_lag1,
                       {_std_sql('actual_revenue', 7, 'd.date')} AS revenue_roll_std_7_lag1,
                       s.sessions_lag1
                FROM daily d LEFT JOIN ({_SESSIONS_LAG}) s ON s.date = d.date
                WINDOW w AS (ORDER BY d.date))
            WHERE actual_revenue_lag7 IS NOT NULL AND sessions_lag1 IS NOT NULL"""),
        "chrono_split": with_parts("daily", """
            SELECT date, CAST(row_number() OVER (ORDER BY date) <= floor(0.8 * count(*) OVER ())
                              AS INTEGER) AS is_train FROM daily"""),
        "expanding_folds": with_parts("daily", """
            SELECT date, CAST(CASE WHEN rn <= n - 3 * (n // 4) THEN 0
                                   ELSE (rn - 1 - (n - 3 * (n // 4))) // (n // 4) + 1 END AS INTEGER) AS fold
            FROM (SELECT date, row_number() OVER (ORDER BY date) AS rn, count(*) OVER () AS n FROM daily)"""),
        "last_n": with_parts("daily", """
            SELECT date, actual_revenue FROM daily ORDER BY date DESC LIMIT 60"""),
        "yoy_growth": with_parts("growth", """
            SELECT CAST(year AS INTEGER) AS year, round(rev_growth, 9) AS rev_growth,
                   round(cogs_growth, 9) AS cogs_growth FROM growth"""),
        "mean_growth": with_parts("mean_growth", """
            SELECT round(growth_rev, 9) AS growth_rev, round(growth_cogs, 9) AS growth_cogs
            FROM mean_growth"""),
        "seasonal_profile": with_parts("profile", """
            SELECT CAST(month AS INTEGER) AS month, CAST(day AS INTEGER) AS day,
                   round(rev_norm, 9) AS rev_norm, round(cogs_norm, 9) AS cogs_norm FROM profile"""),
        "seasonal_forecast": with_parts("forecast", """
            SELECT date, round(Revenue_pred, 4) AS "Revenue_pred", round(COGS_pred, 4) AS "COGS_pred"
            FROM forecast WHERE year(date) > 2000"""),
        "seasonal_validation": with_parts("forecast", """
            SELECT round(avg(abs(Revenue - Revenue_pred) / Revenue) * 100, 6) AS mape_rev,
                   round(avg(abs(COGS - COGS_pred) / COGS) * 100, 6) AS mape_cogs
            FROM forecast WHERE year(date) IN (1999, 2000)"""),
        "submission_export": with_parts("forecast", """
            SELECT strftime(date, '%Y-%m-%d') AS "Date", round(Revenue_pred, 2) AS "Revenue",
                   round(COGS_pred, 2) AS "COGS" FROM forecast WHERE year(date) > 2000"""),
        "naive_lag7_errors": with_parts("naive", """
            SELECT date, actual, pred, abs_error FROM naive"""),
        "error_summary": with_parts("naive", summary + """
            round(min(abs_error), 4) AS min_error, round(max(abs_error), 4) AS max_error,
            round(stddev_samp(abs_error), 4) AS std_error FROM naive"""),
        "error_metrics": with_parts("naive", summary + """
            round(1 - sum(abs_error * abs_error) / (var_pop(actual) * count(*)), 4) AS r2 FROM naive"""),
        "monthly_error_profile": with_parts("naive", """
            SELECT CAST(month(date) AS INTEGER) AS month, round(avg(abs_error), 4) AS mae, count(*) AS n
            FROM naive GROUP BY 1"""),
        "extreme_months": with_parts("naive", """
            (SELECT 'worst' AS kind, month, round(mae, 4) AS mae FROM m ORDER BY m.mae DESC, month LIMIT 1)
            UNION ALL
            (SELECT 'best' AS kind, month, round(mae, 4) AS mae FROM m ORDER BY m.mae, month LIMIT 1)""",
            m="""SELECT CAST(month(date) AS INTEGER) AS month, avg(abs_error) AS mae
                 FROM naive GROUP BY 1"""),
        "worst_best_days": with_parts("naive", """
            SELECT date, actual, pred, abs_error, kind
            FROM ((SELECT *, 'worst' AS kind FROM naive ORDER BY abs_error DESC, date LIMIT 5)
                  UNION ALL (SELECT *, 'best' AS kind FROM naive ORDER BY abs_error, date LIMIT 5))"""),
        "feature_correlation": with_parts(
            _MATRIX_PARTS, _correlation("actual_revenue", CORRELATED), m=_MATRIX),
        "error_correlation": with_parts(
            _MATRIX_PARTS, _correlation("abs(actual_revenue - actual_revenue_lag7)", CORRELATED), m=_MATRIX),
        "submission_merge": with_parts("forecast", """
            SELECT date AS "Date", round(Revenue_pred, 4) AS "Revenue", COGS AS "COGS"
            FROM forecast WHERE year(date) > 2000"""),
        "scaled_features": with_parts("daily", "SELECT date, " + ", ".join(
            f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 9) AS {c}_scaled"
            for c in ("quantity", "customer_id", "is_returned")) + " FROM daily"),
    }
