"""The same queries as plain SQL for an independent engine, over the files' own table names."""

from __future__ import annotations

_FACT = """
WITH t AS (
    SELECT o_orderkey AS transaction_id, o_orderdate AS ts, 'STORE-' || (o_custkey % 20) AS store_id,
           o_custkey AS customer_id, o_totalprice AS total_amount, o_orderpriority AS payment_method
    FROM orders
), c AS (
    SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
           split_part(c_name, '#', 2) AS last_name, n_name AS city, c_mktsegment AS segment
    FROM customer JOIN nation ON c_nationkey = n_nationkey
), i AS (
    SELECT l_orderkey AS transaction_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
           l_extendedprice / l_quantity AS unit_price
    FROM lineitem
), p AS (
    SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand FROM part
), fact AS (
    SELECT t.transaction_id, t.ts, t.store_id, c.customer_id, c.first_name, c.last_name, c.city, c.segment,
           p.product_id, p.product_name, p.category, p.brand, i.quantity, i.unit_price,
           CAST(i.quantity * i.unit_price AS DOUBLE) AS line_amount, t.payment_method
    FROM t JOIN c ON t.customer_id = c.customer_id
           JOIN i ON t.transaction_id = i.transaction_id
           JOIN p ON i.product_id = p.product_id
)"""

_MARTS = (
    _FACT
    + """, daily AS (
    SELECT CAST(ts AS DATE) AS sale_date,
           COUNT(DISTINCT transaction_id) AS transactions_count,
           CAST(SUM(quantity) AS BIGINT) AS items_sold,
           ROUND(SUM(line_amount), 2) AS revenue,
           ROUND(SUM(line_amount), 2) / COUNT(DISTINCT transaction_id) AS avg_check
    FROM fact GROUP BY 1
), product_sales AS (
    SELECT product_id, product_name, category, brand,
           CAST(SUM(quantity) AS BIGINT) AS units_sold, ROUND(SUM(line_amount), 2) AS revenue
    FROM fact GROUP BY 1, 2, 3, 4
), category_days AS (
    SELECT category, CAST(ts AS DATE) AS sale_date, ROUND(SUM(line_amount), 2) AS revenue
    FROM fact GROUP BY 1, 2
)"""
)

_COUNTS = (
    _MARTS
    + """, counts AS (
    SELECT 'silver_transactions' AS check_name, COUNT(*) AS row_count FROM t
    UNION ALL SELECT 'silver_items', COUNT(*) FROM i
    UNION ALL SELECT 'fact_sales', COUNT(*) FROM fact
    UNION ALL SELECT 'sales_daily', COUNT(*) FROM daily
    UNION ALL SELECT 'product_sales', COUNT(*) FROM product_sales
)"""
)


def _features(source: str, series: str = "") -> str:
    """The feature columns over ``source``, before incomplete rows are dropped."""
    by = f"PARTITION BY {series} " if series else ""
    keep = f"{series}, " if series else ""
    order = f"OVER ({by}ORDER BY sale_date"

    def rolling(k: int) -> str:
        frame = f"{order} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
        return f"CASE WHEN COUNT(revenue) {frame} = {k} THEN AVG(revenue) {frame} END AS revenue_rolling_{k}"

    return f"""
    SELECT {keep}sale_date, revenue,
           CAST(isodow(sale_date) - 1 AS INTEGER) AS dow,
           CASE WHEN isodow(sale_date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
           LAG(revenue, 1) {order}) AS revenue_lag_1,
           LAG(revenue, 2) {order}) AS revenue_lag_2,
           LAG(revenue, 7) {order}) AS revenue_lag_7,
           {rolling(3)}, {rolling(7)}
    FROM {source}"""


_COMPLETE = " AND ".join(
    f"{column} IS NOT NULL"
    for column in (
        "revenue", "revenue_lag_1", "revenue_lag_2", "revenue_lag_7", "revenue_rolling_3", "revenue_rolling_7",
    )
)
_FEATURE_LIST = """dow, is_weekend, revenue_lag_1, revenue_lag_2, revenue_lag_7,
       ROUND(revenue_rolling_3, 4) AS revenue_rolling_3, ROUND(revenue_rolling_7, 4) AS revenue_rolling_7"""

_PANEL = f"""{_MARTS}, framed AS ({_features("category_days", "category")}
), panel AS (SELECT * FROM framed WHERE {_COMPLETE}
), placed AS (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY category ORDER BY sale_date) AS n,
           COUNT(*) OVER (PARTITION BY category) AS size
    FROM panel
)"""

_SCORES = f"""{_PANEL}, holdout AS (
    SELECT * FROM placed WHERE n > FLOOR(size * CAST(0.8 AS DOUBLE))
), scores AS (
    SELECT category, 'lag_7' AS model_name, ROUND(AVG(ABS(revenue - revenue_lag_7)), 4) AS mae
    FROM holdout GROUP BY category
    UNION ALL
    SELECT category, 'rolling_7', ROUND(AVG(ABS(revenue - revenue_rolling_7)), 4) FROM holdout GROUP BY category
)"""



def _least_squares(rows: str) -> str:
    """CTEs ending in ``coefficients`` (b0..b7, the last for the constant): the normal equations over ``rows`` of
    ``placed``, solved by Gauss-Jordan elimination."""
    size = 8
    steps = "".join(
        f""", m{k + 1} AS (
    SELECT a.i, a.j, CASE WHEN a.i = {k} THEN a.v / p.v ELSE a.v - c.v * r.v / p.v END AS v
    FROM m{k} a JOIN m{k} c ON c.i = a.i AND c.j = {k}
                JOIN m{k} r ON r.i = {k} AND r.j = a.j
                JOIN m{k} p ON p.i = {k} AND p.j = {k}
)"""
        for k in range(size)
    )
    values = ", ".join(f"MAX(CASE WHEN i = {k} THEN v END) AS b{k}" for k in range(size))
    return f"""{_PANEL}, cells AS (
    SELECT category, sale_date, unnest([0, 1, 2, 3, 4, 5, 6, 7, 8]) AS j,
           unnest([CAST(dow AS DOUBLE), is_weekend, revenue_lag_1, revenue_lag_2, revenue_lag_7,
                   revenue_rolling_3, revenue_rolling_7, 1.0, revenue]) AS v
    FROM placed WHERE {rows}
), m0 AS (
    SELECT x.j AS i, y.j AS j, SUM(x.v * y.v) AS v
    FROM cells x JOIN cells y ON x.category = y.category AND x.sale_date = y.sale_date
    WHERE x.j < {size} GROUP BY 1, 2
){steps}, coefficients AS (SELECT {values} FROM m{size} WHERE j = {size})"""


def _predicted(dow: str, weekend: str, lag_1: str, lag_2: str, lag_7: str, mean_3: str, mean_7: str) -> str:
    return (
        f"b0 * {dow} + b1 * {weekend} + b2 * {lag_1} + b3 * {lag_2} + b4 * {lag_7}"
        f" + b5 * {mean_3} + b6 * {mean_7} + b7"
    )


def _rolled(days: int) -> str:
    """CTEs s0..s<days>: per category the date and the seven newest revenues, r1 the newest."""
    newest = ", ".join(f"MAX(CASE WHEN age = {k} THEN revenue END) AS r{k}" for k in range(1, 8))
    shifted = ", ".join(f"r{k} AS r{k + 1}" for k in range(1, 7))
    dow = "(isodow(sale_date + 1) - 1)"
    weekend = "(CASE WHEN isodow(sale_date + 1) >= 6 THEN 1 ELSE 0 END)"
    value = _predicted(
        dow, weekend, "r1", "r2", "r7", "((r1 + r2 + r3) / 3)", "((r1 + r2 + r3 + r4 + r5 + r6 + r7) / 7)"
    )
    steps = "".join(
        f""", s{k + 1} AS (
    SELECT category, sale_date + 1 AS sale_date, {value} AS r1, {shifted} FROM s{k}, coefficients
)"""
        for k in range(days)
    )
    return f""", aged AS (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY category ORDER BY sale_date DESC) AS age FROM category_days
), s0 AS (SELECT category, MAX(sale_date) AS sale_date, {newest} FROM aged GROUP BY category){steps}"""


_PREDICTED_ROW = _predicted(
    "dow", "is_weekend", "revenue_lag_1", "revenue_lag_2", "revenue_lag_7", "revenue_rolling_3", "revenue_rolling_7"
)
_ROLLED_DAYS = " UNION ALL ".join(
    f"SELECT category, sale_date, ROUND(r1, 1) AS revenue_forecast FROM s{day}" for day in range(1, 8)
)

_TEXT_TIME = "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00'"
_HEADERS = """
SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, o_orderdate AS ts,
       'STORE-' || (o_custkey % 20) AS store_id, CAST(o_custkey AS VARCHAR) AS customer_id,
       o_totalprice AS total_amount, o_orderpriority AS payment_method
FROM orders"""
_LINES = """
SELECT CAST(l_orderkey AS VARCHAR) AS transaction_id, CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice / l_quantity AS unit_price
FROM lineitem"""
_VERSIONS = """
WITH v AS (
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, year(o_orderdate) AS snapshot_id,
           make_timestamp(year(o_orderdate) + 1, 1, 1, 0, 0, 0.0) AS committed_at
    FROM orders
)"""



def _stump(rows: str) -> str:
    """CTEs ending in ``split`` (cut, low, mean): the best single split of the revenue by weekday over ``rows`` of ``placed``."""
    return f"""{_PANEL}, train AS (SELECT dow, revenue FROM placed WHERE {rows}
), sides AS (
    SELECT cut, dow <= cut AS low, COUNT(*) AS c, SUM(revenue) AS s, SUM(revenue * revenue) AS q
    FROM train, (SELECT unnest(range(0, 6)) AS cut) GROUP BY 1, 2
), best AS (SELECT cut FROM sides GROUP BY cut ORDER BY SUM(q - s * s / c), cut LIMIT 1
), split AS (SELECT cut, low, s / c AS mean FROM sides JOIN best USING (cut))"""


_SELECTION = f"""
        SELECT category, model_name, ROUND(error, 1) AS mae,
               CAST(ROW_NUMBER() OVER (PARTITION BY category ORDER BY error, model_name) AS INTEGER) AS rank
        FROM (
            SELECT * FROM ({_least_squares("n < size")}
                SELECT category, 'LinearRegression' AS model_name, AVG(ABS(revenue - ({_PREDICTED_ROW}))) AS error
                FROM placed, coefficients WHERE n = size GROUP BY category)
            UNION ALL
            SELECT * FROM ({_stump("n < size")}
                SELECT category, 'RandomForest' AS model_name, AVG(ABS(revenue - mean)) AS error
                FROM placed JOIN split ON low = (dow <= cut) WHERE n = size GROUP BY category)
        )"""

_SELECTED_FORECAST = f"""
        SELECT category, sale_date, revenue_forecast, model_name, TIMESTAMP '2000-07-01' AS generated_at
        FROM (
            SELECT *, 'LinearRegression' AS model_name FROM ({_least_squares("TRUE")}{_rolled(7)} {_ROLLED_DAYS})
            UNION ALL
            SELECT *, 'RandomForest' FROM ({_stump("TRUE")}, ahead AS (
                    SELECT category, CAST(MAX(sale_date) + n AS DATE) AS sale_date
                    FROM category_days, (SELECT unnest(range(1, 8))::INTEGER AS n) GROUP BY category, n)
                SELECT category, sale_date, ROUND(mean, 1) FROM ahead JOIN split ON low = (isodow(sale_date) - 1 <= cut))
        ) JOIN (SELECT category, model_name FROM ({_SELECTION}) WHERE rank = 1) USING (category, model_name)"""

_WHOLE_RECEIPTS = f"""
        SELECT 'scheduled__' || strftime(o_orderdate, '%Y-%m') || '-01T00:00:00+00:00' AS batch_id,
               CAST(o_orderkey AS VARCHAR) AS transaction_id,
               {_TEXT_TIME} AS "timestamp", 'STORE-' || (o_custkey % 20) AS store_id,
               CAST(o_custkey AS VARCHAR) AS customer_id, o_totalprice AS total_amount,
               o_orderpriority AS payment_method, CAST(l_partkey AS VARCHAR) AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice / l_quantity AS unit_price
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey"""

SQL: dict[str, str] = {
    "fact_sales": f"{_FACT} SELECT * FROM fact",
    "sales_daily": f"{_MARTS} SELECT * FROM daily",
    "product_sales": f"{_MARTS} SELECT * FROM product_sales",
    "federated_region": """
        SELECT c_name AS name, n_name AS country, r_name AS region
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "kpi_revenue": f"{_MARTS} SELECT ROUND(SUM(revenue), 2) AS revenue FROM daily",
    "kpi_transactions": f"{_MARTS} SELECT CAST(SUM(transactions_count) AS BIGINT) AS transactions FROM daily",
    "kpi_avg_check": f"{_MARTS} SELECT ROUND(AVG(avg_check), 4) AS avg_check FROM daily",
    "trend_revenue": f"""{_MARTS} SELECT sale_date, SUM(revenue) AS revenue FROM daily
        GROUP BY sale_date ORDER BY sale_date""",
    "trend_revenue_limited": f"""{_MARTS} SELECT sale_date, SUM(revenue) AS revenue FROM daily
        GROUP BY sale_date ORDER BY sale_date LIMIT 10000""",
    "trend_revenue_range": f"""{_MARTS} SELECT sale_date, SUM(revenue) AS revenue FROM daily
        WHERE sale_date >= DATE '1997-01-01' AND sale_date < DATE '1998-01-01'
        GROUP BY sale_date ORDER BY sale_date""",
    "trend_revenue_monthly": f"""{_MARTS}
        SELECT CAST(date_trunc('month', sale_date) AS DATE) AS sale_date, ROUND(SUM(revenue), 2) AS revenue
        FROM daily GROUP BY 1 ORDER BY 1""",
    "trend_transactions": f"""{_MARTS}
        SELECT sale_date, CAST(SUM(transactions_count) AS BIGINT) AS transactions
        FROM daily GROUP BY sale_date ORDER BY sale_date""",
    "top10_products": f"""{_MARTS}
        SELECT product_name, ROUND(SUM(revenue), 2) AS revenue FROM product_sales
        GROUP BY product_name ORDER BY 2 DESC, 1 LIMIT 10""",
    "silver_customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name, CAST(NULL AS VARCHAR) AS email, n_name AS city,
               c_mktsegment AS segment,
               DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS registration_date,
               DATE '2026-07-01' AS ingestion_batch_date
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "silver_products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_type AS category, p_brand AS brand,
               p_retailprice AS price, 'RUB' AS currency
        FROM part""",
    "silver_transactions": _HEADERS,
    "silver_items_flatten": _LINES,
    "receipt_total_reconcile": """
        WITH totals AS (
            SELECT l_orderkey, ROUND(SUM(CAST(l_quantity AS INTEGER) * (l_extendedprice / l_quantity)), 2) AS total
            FROM lineitem GROUP BY l_orderkey
        )
        SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, total AS receipt_total,
               o_totalprice AS declared_total, total = o_totalprice AS matches
        FROM orders JOIN totals ON o_orderkey = l_orderkey""",
    "timestamp_normalize": "SELECT event_id, date_trunc('second', ts) AS ts FROM events",
    "batch_id_sanitize": """
        WITH ids AS (
            SELECT event_id, 'scheduled__' || strftime(ts, '%Y-%m-%d') || 'T' || user_id || ':00+00:00' AS batch_id
            FROM events
        )
        SELECT event_id, batch_id, regexp_replace(batch_id, '[^A-Za-z0-9_.-]', '_', 'g') AS batch_key FROM ids""",
    "batch_filter": """
        SELECT event_id AS transaction_id, strftime(ts, '%Y-%m-%d') AS batch_id, event_type, value
        FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'""",
    "batch_completeness": """
        WITH counted AS (
            SELECT strftime(ts, '%Y-%m-%d') AS batch_id, COUNT(*) AS received FROM events GROUP BY 1
        ), announced AS (
            SELECT batch_id, received,
                   received + CASE WHEN received = (SELECT MAX(received) FROM counted) THEN 1 ELSE 0 END AS expected
            FROM counted
        )
        SELECT batch_id, expected, received, received = expected AS passed FROM announced""",
    "event_json_roundtrip": """
        SELECT event_id, ts, user_id, event_type, value,
               CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k
        FROM events""",
    "gold_row_counts": f"{_COUNTS} SELECT * FROM counts",
    "gold_validation": f"""{_COUNTS}, n AS (
            SELECT MAX(CASE WHEN check_name = 'silver_transactions' THEN row_count END) AS transactions,
                   MAX(CASE WHEN check_name = 'fact_sales' THEN row_count END) AS facts,
                   MAX(CASE WHEN check_name = 'sales_daily' THEN row_count END) AS days,
                   MAX(CASE WHEN check_name = 'product_sales' THEN row_count END) AS products
            FROM counts
        )
        SELECT 'fact_not_empty' AS "check", NOT (transactions > 0 AND facts = 0) AS passed FROM n
        UNION ALL
        SELECT 'marts_not_empty', NOT (facts > 0 AND (days = 0 OR products = 0)) FROM n""",
    "orphan_report": """
        SELECT 'transaction with unknown customer' AS reason, COUNT(*) AS row_count FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)
        UNION ALL
        SELECT 'item with unknown product', COUNT(*) FROM lineitem
        WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size <= 45)
        UNION ALL
        SELECT 'transaction without items', COUNT(*) FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
        UNION ALL
        SELECT 'item without transaction', COUNT(*) FROM lineitem
        WHERE NOT EXISTS (SELECT 1 FROM orders WHERE l_orderkey = o_orderkey)""",
    "insert_if_absent": """
        SELECT DISTINCT o_custkey AS customer_id, 'SEEN' AS segment FROM orders
        UNION ALL
        SELECT c_custkey, c_mktsegment FROM customer
        WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""",
    "as_of_read": f"""{_VERSIONS}
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM v
        WHERE committed_at <= (SELECT MAX(committed_at) FROM v WHERE committed_at <= TIMESTAMP '2000-07-01')""",
    "table_refresh_append": """
        SELECT CAST(o_orderkey AS INTEGER) AS order_id, CAST(o_custkey AS INTEGER) AS customer_id,
               CAST(o_totalprice AS DECIMAL(10, 2)) AS amount, CAST(o_orderdate AS DATE) AS order_date
        FROM orders""",
    "incremental_marts": f"""{_MARTS}
        SELECT 'day' AS mart, CAST(sale_date AS VARCHAR) AS label, transactions_count AS receipts, items_sold AS units, revenue FROM daily
        UNION ALL SELECT 'product', CAST(product_id AS VARCHAR), NULL, units_sold, revenue FROM product_sales""",
    "fact_calendar": f"""{_FACT} SELECT CAST(ts AS DATE) AS sale_date, COUNT(*) AS lines, ROUND(SUM(line_amount), 2) AS revenue
        FROM fact WHERE year(ts) = 1997 AND quarter(ts) = 2 GROUP BY 1""",
    "raw_batch_files": _WHOLE_RECEIPTS,
    "raw_array_files": _WHOLE_RECEIPTS,
    "pipeline_reports": f"""{_MARTS}, exact AS (
            SELECT CAST(ts AS DATE) AS sale_date, SUM(line_amount) AS revenue,
                   COUNT(DISTINCT transaction_id) AS receipts FROM fact GROUP BY 1
        ), names AS (
            SELECT product_name, SUM(line_amount) AS revenue FROM fact GROUP BY 1
            ORDER BY 2 DESC, 1 LIMIT 10
        )
        SELECT 'kpi_revenue' AS report, CAST(NULL AS VARCHAR) AS label, ROUND(SUM(revenue), 2) AS value FROM exact
        UNION ALL SELECT 'kpi_transactions', NULL, CAST(SUM(receipts) AS DOUBLE) FROM exact
        UNION ALL SELECT 'kpi_avg_check', NULL, ROUND(AVG(revenue / receipts), 4) FROM exact
        UNION ALL SELECT 'trend_revenue', CAST(sale_date AS VARCHAR), ROUND(revenue, 2) FROM exact
        UNION ALL SELECT 'trend_transactions', CAST(sale_date AS VARCHAR), CAST(receipts AS DOUBLE) FROM exact
        UNION ALL SELECT 'trend_forecast', CAST(CAST(last + n AS DATE) AS VARCHAR), CAST(1 AS DOUBLE)
        FROM (SELECT MAX(sale_date) AS last FROM exact), (SELECT unnest(range(1, 8))::INTEGER AS n)
        UNION ALL SELECT 'top_products', product_name, ROUND(revenue, 2) FROM names""",
    "daily_features": f"""{_MARTS}, framed AS ({_features("daily")})
        SELECT sale_date, revenue, {_FEATURE_LIST} FROM framed WHERE {_COMPLETE}""",
    "series_features": f"{_PANEL} SELECT category, sale_date, revenue, {_FEATURE_LIST} FROM panel",
    "next_day_features": f"""{_MARTS}, last AS (
            SELECT category, MAX(sale_date) + 1 AS sale_date FROM category_days GROUP BY category
        ), extended AS (
            SELECT * FROM category_days UNION ALL SELECT category, sale_date, 0.0 FROM last
        ), framed AS ({_features("extended", "category")})
        SELECT category, sale_date, {_FEATURE_LIST} FROM framed SEMI JOIN last USING (category, sale_date)""",
    "history_gate": f"""{_MARTS}, customer_days AS (
            SELECT customer_id, CAST(ts AS DATE) AS sale_date, SUM(line_amount) AS revenue FROM fact GROUP BY 1, 2
        ), framed AS ({_features("customer_days", "customer_id")}
        ), n AS (
            SELECT customer_id, COUNT(*) AS history, COUNT(*) FILTER (WHERE {_COMPLETE}) AS usable
            FROM framed GROUP BY customer_id
        )
        SELECT customer_id, CASE WHEN history < 14 THEN history ELSE usable END AS rows_available,
               history < 14 OR usable < 3 AS skipped
        FROM n""",
    "holdout_split": f"""{_PANEL}
        SELECT category, sale_date, n > size - 1 AS is_last,
               n > FLOOR(size * CAST(0.8 AS DOUBLE)) AS is_last_fifth
        FROM placed""",
    "candidate_mae": f"{_SCORES} SELECT category, model_name, mae FROM scores",
    "best_candidate": f"""{_SCORES}, ranked AS (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY category ORDER BY mae, model_name) AS place FROM scores
        )
        SELECT category, model_name, mae FROM ranked WHERE place = 1""",
    "linear_model_mae": f"""{_least_squares("n < size")}
        SELECT category, ROUND(ABS(revenue - ({_PREDICTED_ROW})), 1) AS mae
        FROM placed, coefficients WHERE n = size""",
    "merged_linear_mae": f"""{_least_squares("n < size")}
        SELECT category, ROUND(ABS(revenue - ({_PREDICTED_ROW})), 1) AS mae
        FROM placed, coefficients WHERE n = size""",
    "selected_model": _SELECTION,
    "selected_forecast": _SELECTED_FORECAST,
    "linear_forecast": f"""{_least_squares("TRUE")}{_rolled(7)}
        {_ROLLED_DAYS}""",
    "trend_forecast": f"""{_least_squares("TRUE")}{_rolled(7)}, predicted AS ({_ROLLED_DAYS})
        SELECT sale_date, ROUND(SUM(revenue_forecast), 1) AS forecast FROM predicted GROUP BY 1 ORDER BY 1""",
    "stream_daily_sales": """
        SELECT CAST(ts AS DATE) AS sale_date, COUNT(DISTINCT event_id) AS transactions_count,
               CAST(SUM(CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT)) AS BIGINT) AS items_sold,
               ROUND(SUM(value), 2) AS revenue, ROUND(SUM(value), 2) / COUNT(DISTINCT event_id) AS avg_check
        FROM events GROUP BY 1""",
    "stream_receipts_daily": f"{_MARTS} SELECT * FROM daily",
    "stream_closed_days": f"{_MARTS} SELECT * FROM daily",
    # no receipt of the tables is long enough for a second document
    "stream_raw": """
        SELECT 'scheduled__' || strftime(o_orderdate, '%Y-%m') || '-01T00:00:00+00:00' AS batch_id,
               COUNT(*) AS expected, COUNT(*) AS received, TRUE AS passed
        FROM orders GROUP BY 1""",
    "stream_bounded": """
        SELECT 'scheduled__1997-05-01T00:00:00+00:00' AS batch_id, COUNT(*) AS expected, COUNT(*) AS received, 'announced' AS ended_by
        FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1997-05'""",
    "stream_rejected": """
        SELECT 'broken ' || o_orderkey AS message, 'malformed' AS problem FROM orders WHERE o_orderkey % 50 = 0""",
    "stream_ingest_transactions": _HEADERS,
    "stream_ingest_items": _LINES,
}
