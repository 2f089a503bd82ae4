"""The same questions as ANSI SQL over the given tables, for an independent engine.

Written from the definitions and not from the Spark plans: plain joins and windows, no
pre-aggregation, no slices. Money is decimal until the final projection on both sides.
"""

from __future__ import annotations

_RAW = """
raw_all AS (
    SELECT p.*, 'first' AS kind, p_partkey * 3 AS id, p_partkey * 3 AS pos FROM part p
    UNION ALL
    SELECT p.*, 'copy', p_partkey * 3, p_partkey * 3 + 1 FROM part p WHERE p_partkey % 10 = 0
    UNION ALL
    SELECT p.*, 'unsold', p_partkey * 3 + 1, p_partkey * 3 + 2 FROM part p WHERE p_partkey % 97 = 0
),
raw AS (
    SELECT id, pos, p_type AS category,
        CASE kind WHEN 'unsold' THEN 'unsold ' || p_name ELSE p_name END AS title,
        CAST(p_retailprice AS DECIMAL(12,2))
            + CASE kind WHEN 'copy' THEN 1 ELSE 0 END AS price,
        CAST((p_partkey * 13) % 26 AS DECIMAL(6,2)) AS discount,
        CASE WHEN p_partkey % 53 = 0 THEN NULL
            ELSE CAST((p_partkey * 37) % 41 + 10 AS DOUBLE) / CAST(10 AS DOUBLE) END AS rating,
        CAST(p_size * 2 - 2 AS BIGINT) AS stock,
        CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE p_brand END AS brand
    FROM raw_all
)"""


def _net(price: str, discount: str) -> str:
    factor = f"CAST(1 - {discount} * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(8,4))"
    return f"CAST(round({price} * {factor}, 2) AS DECIMAL(12,2))"


_DIM = f"""{_RAW},
dim AS (
    SELECT id AS product_id, title AS product_name, category, price AS price_usd,
        discount AS discount_pct, rating AS avg_rating, stock AS stock_quantity,
        coalesce(brand, 'Unknown') AS brand, {_net('price', 'discount')} AS actual_price_usd
    FROM raw
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY pos) = 1
)"""

_LINES = """
lines AS (
    SELECT l_orderkey AS order_id, (l_partkey + l_linenumber) % 4 AS cart,
        l_partkey * 3 + CASE WHEN l_partkey % 101 = 0 THEN 2 ELSE 0 END AS product_id,
        CAST(l_quantity AS BIGINT) AS quantity,
        CAST(l_extendedprice AS DECIMAL(12,2)) AS gross,
        CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(6,2)) AS discount,
        CAST(round(CAST(l_extendedprice AS DECIMAL(12,2))
            * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(12,2)) AS net
    FROM lineitem
)"""

_ROWS = f"""{_DIM}, {_LINES},
joined AS (
    SELECT l.*, d.product_name, d.category, d.brand, d.price_usd, d.discount_pct, d.avg_rating,
        d.stock_quantity
    FROM lines l JOIN dim d USING (product_id)
)"""

_PRED = f"""{_ROWS},
pred AS (
    SELECT product_id, category,
        CAST(quantity + (order_id * 7 + product_id * 3) % 41 - 20 AS DOUBLE) AS predicted,
        CASE WHEN order_id % 50 = 0 THEN 0 ELSE quantity END AS actual,
        CAST('2025-01-01' AS DATE) AS run_date,
        CAST(3.25 AS DOUBLE) AS mae, CAST(0.8125 AS DOUBLE) AS r2
    FROM joined
),
graded AS (
    SELECT *, abs(predicted - actual) AS miss,
        round(predicted - actual, 2) AS prediction_error,
        round((predicted - actual) / nullif(actual, 0) * 100, 1) AS pct_error,
        CASE WHEN abs(predicted - actual) <= 5 THEN 'excellent'
            WHEN abs(predicted - actual) <= 15 THEN 'good' ELSE 'needs_review' END AS band
    FROM pred
)"""

_CARTS = f"""{_LINES},
headers AS (
    SELECT o_orderkey * 4 + coalesce(cart, 0) AS order_id, o_orderkey AS source,
        coalesce(cart, 0) AS cart, o_custkey AS user_id,
        coalesce(sum(gross), 0) AS total, coalesce(sum(net), 0) AS discounted_total,
        count(l.order_id) AS n, CAST(coalesce(sum(quantity), 0) AS BIGINT) AS units
    FROM orders LEFT JOIN lines l ON l.order_id = o_orderkey
    GROUP BY ALL
)"""


def _md5(*parts: str) -> str:
    text = " || '|' || ".join(parts)
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


_LINE_KEY = [
    "order_id",
    "product_id",
    "quantity",
    "CAST(gross * 100 AS BIGINT)",
    "CAST(discount * 100 AS BIGINT)",
]

_SPLIT = f"""{_ROWS},
split AS (
    SELECT order_id, product_id, quantity, {_md5("'42'", *_LINE_KEY)} % 10 < 8 AS is_train,
        CAST({_md5("'42'", "'fold'", *_LINE_KEY)} % 5 AS INT) AS fold
    FROM joined
)"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def _mean(total: str, n: str, digits: int = 2) -> str:
    return f"round(CAST({total} AS DOUBLE) / {n}, {digits})"


_DIM_COLUMNS = """product_id, product_name, category, CAST(price_usd AS DOUBLE) AS price_usd,
    CAST(discount_pct AS DOUBLE) AS discount_pct, avg_rating, stock_quantity, brand,
    CAST(actual_price_usd AS DOUBLE) AS actual_price_usd,
    CAST('2025-01-01 06:00:00' AS TIMESTAMP) AS processed_at"""

_RAW_COLUMNS = """id, title, category, brand, CAST(price AS DOUBLE) AS price,
    CAST(discount AS DOUBLE) AS "discountPercentage", rating, CAST(stock AS DOUBLE) AS stock"""

_CART_COLUMNS = """SELECT order_id, user_id, CAST(total AS DOUBLE) AS total,
    CAST(discounted_total AS DOUBLE) AS discounted_total, n AS total_products,
    units AS total_quantity, n AS n_lines, units AS line_units FROM headers"""

_FLAT_LINES = _with(
    _CARTS,
    """SELECT h.order_id, user_id, CAST(total AS DOUBLE) AS order_total_usd,
        CAST(discounted_total AS DOUBLE) AS order_discounted_usd,
        n AS order_total_products, units AS order_total_quantity, product_id,
        'product ' || product_id AS product_name, quantity AS quantity_ordered,
        CAST(CAST((2 * CAST(gross * 100 AS BIGINT) + quantity) // (2 * quantity) AS DECIMAL(18,2))
            / 100 AS DOUBLE) AS unit_price_usd,
        CAST('2025-01-01 06:00:00' AS TIMESTAMP) AS processed_at,
        CAST(gross AS DOUBLE) AS line_total_usd, CAST(discount AS DOUBLE) AS discount_pct,
        CAST(net AS DOUBLE) AS line_discounted_usd, CAST(gross - net AS DOUBLE) AS line_savings_usd
    FROM lines l JOIN headers h ON h.source = l.order_id AND h.cart = l.cart""",
)

_SPOILT = f"""{_RAW},
spoilt AS (
    SELECT id AS product_id, pos AS ingest_pos, brand,
        id % 11 = 0 OR id % 13 = 0 AS bad, price, discount, rating, stock
    FROM raw
),
parsed AS (
    SELECT product_id, ingest_pos, brand,
        CASE WHEN NOT bad THEN price END AS price, CASE WHEN NOT bad THEN discount END AS discount,
        CASE WHEN NOT bad THEN rating END AS rating, CASE WHEN NOT bad THEN stock END AS stock
    FROM spoilt
)"""

_BREAKDOWN = f"""{_ROWS},
breakdown AS (
    SELECT category, count(DISTINCT order_id) AS orders,
        CAST(sum(quantity) AS BIGINT) AS units_sold,
        round(sum(gross), 2) AS revenue,
        {_mean('sum(coalesce(price_usd, 0))', 'count(*)')} AS avg_price,
        {_mean('sum(coalesce(discount_pct, 0))', 'count(*)', 1)} AS avg_discount,
        round(avg(coalesce(avg_rating, 0)), 2) AS avg_rating
    FROM joined GROUP BY category
)"""

_BREAKDOWN_SELECT = (
    "SELECT category, orders, units_sold, CAST(revenue AS DOUBLE) AS revenue, avg_price, "
    "avg_discount, avg_rating FROM breakdown"
)

_BY_CATEGORY = """SELECT category, round(avg(predicted), 2) AS avg_predicted,
    round(avg(actual), 2) AS avg_actual, round(avg(miss), 2) AS avg_error,
    count(*) AS product_count
    FROM graded GROUP BY category"""

_KPIS = f"""{_LINES},
kpis AS (
    SELECT count(DISTINCT order_id) AS total_orders, count(DISTINCT product_id) AS total_products,
        CAST(sum(gross) AS DOUBLE) AS total_revenue,
        {_mean('sum(discount)', 'count(discount)', 1)} AS avg_discount_pct
    FROM lines
)"""

_STOCK_LIST = """SELECT product_id, product_name, category, brand, stock_quantity,
    CAST(price_usd AS DOUBLE) AS price_usd, avg_rating FROM dim"""


def _lookup(text: str) -> str:
    return f"""{_PRED},
hits AS (
    SELECT d.product_id, product_name, d.category, brand, CAST(price_usd AS DOUBLE) AS price_usd,
        CAST(discount_pct AS DOUBLE) AS discount_pct, avg_rating, stock_quantity,
        predicted AS predicted_units, actual AS actual_units,
        coalesce(band, 'needs_review') AS accuracy_band, pct_error,
        predicted IS NOT NULL AS has_prediction
    FROM dim d LEFT JOIN graded g ON g.product_id = d.product_id
    WHERE contains(lower(product_name), lower('{text}'))
        OR CAST(d.product_id AS VARCHAR) = '{text}'
),
page AS (
    SELECT * FROM hits ORDER BY product_id, predicted_units NULLS LAST, actual_units NULLS LAST
    LIMIT 20
)"""


_FEATURES = f"""{_ROWS},
keyed AS (
    SELECT *, coalesce(category, 'unknown') AS ck, coalesce(brand, 'unknown') AS bk,
        CAST(price_usd AS DOUBLE) AS price, CAST(discount_pct AS DOUBLE) / 100 AS rate
    FROM joined
),
cats AS (
    SELECT ck, row_number() OVER (ORDER BY ck) - 1 AS code, avg(quantity) AS mean,
        coalesce(stddev_samp(quantity), 1) AS std
    FROM keyed GROUP BY ck
),
marks AS (
    SELECT bk, row_number() OVER (ORDER BY bk) - 1 AS code, avg(quantity) AS mean
    FROM keyed GROUP BY bk
),
cuts AS (
    SELECT min(price) AS low, quantile_cont(price, 0.25) AS e1, quantile_cont(price, 0.5) AS e2,
        quantile_cont(price, 0.75) AS e3
    FROM keyed
),
feats AS (
    SELECT order_id, product_id, quantity AS units_sold,
        c.code AS category_enc, m.code AS brand_enc,
        price AS price_usd, ln(1 + price) AS price_log, price * (1 - rate) AS price_after_disc,
        CAST(price > e1 AS INT) + CAST(price > e2 AS INT) + CAST(price > e3 AS INT) AS price_tier,
        rate AS discount_rate, CAST(rate > 0 AS INT) AS is_discounted,
        coalesce(avg_rating, 0) AS avg_rating,
        CAST(coalesce(avg_rating >= 4.5, false) AS INT) AS is_high_rated,
        coalesce(avg_rating, 0) * rate AS rating_times_discount,
        ln(1 + CAST(stock_quantity AS DOUBLE)) AS stock_log,
        CAST(stock_quantity = 0 AS INT) AS is_out_of_stock,
        CAST(stock_quantity < 10 AS INT) AS is_low_stock,
        CAST(stock_quantity AS DOUBLE) / (quantity + 1) AS stock_to_sales_ratio,
        c.mean AS category_avg_sales,
        CASE WHEN c.std = 0 THEN 0 ELSE (quantity - c.mean) / c.std END AS category_sales_z,
        m.mean AS brand_avg_sales
    FROM keyed JOIN cats c USING (ck) JOIN marks m USING (bk) CROSS JOIN cuts
)"""

_DOUBLES = [
    "price_usd",
    "price_log",
    "price_after_disc",
    "discount_rate",
    "avg_rating",
    "rating_times_discount",
    "stock_log",
    "stock_to_sales_ratio",
    "category_avg_sales",
    "category_sales_z",
    "brand_avg_sales",
]


def _features(*columns: str) -> str:
    picked = [f"round({c}, 6) AS {c}" if c in _DOUBLES else c for c in columns]
    return _with(_FEATURES, f"SELECT order_id, product_id, units_sold, {', '.join(picked)} FROM feats")


_ALL_FEATURES = _features(
    "category_enc",
    "brand_enc",
    "price_tier",
    "is_discounted",
    "is_high_rated",
    "is_out_of_stock",
    "is_low_stock",
    *_DOUBLES,
)

_DIM_ROWS = _with(_DIM, f"SELECT {_DIM_COLUMNS} FROM dim")


def _order_analysis() -> str:
    return _with(
        f"{_DIM}, {_LINES}",
        f"""SELECT category, count(*) AS total_order_lines,
            CAST(sum(net) AS DOUBLE) AS total_revenue_usd,
            {_mean('sum(quantity)', 'count(*)')} AS avg_qty_per_order,
            CAST(sum(gross - net) AS DOUBLE) AS total_customer_savings_usd
        FROM lines LEFT JOIN dim USING (product_id) GROUP BY category""",
    )


def _ingest_counts() -> str:
    return _with(
        _RAW,
        """SELECT 'products' AS relation, count(*) AS raw_rows,
            count(DISTINCT id) AS clean_rows FROM raw
        UNION ALL SELECT 'orders', (SELECT count(*) FROM (
                SELECT DISTINCT o_orderkey, (l_partkey + l_linenumber) % 4
                FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey)),
            (SELECT count(*) FROM lineitem)""",
    )


def _catalogue() -> str:
    return _with(
        _DIM,
        f"""SELECT category, count(*) AS total_products,
            CAST(sum(actual_price_usd) AS DOUBLE) AS total_stock_value_usd,
            {_mean('sum(actual_price_usd)', 'count(*)')} AS avg_price_usd,
            round(avg(avg_rating), 2) AS avg_rating,
            CAST(sum(stock_quantity) AS BIGINT) AS total_units_in_stock
        FROM dim GROUP BY category""",
    )


def _ranked(report: str, rows: str, order: str) -> str:
    return f"""SELECT '{report}' AS report, category,
        CAST(row_number() OVER (ORDER BY {order} NULLS LAST, category NULLS LAST) AS INT) AS rank
        FROM ({rows})"""


def all_oracles() -> dict[str, str]:
    return {
        # sources and sinks
        "ingest_paged_products": _with(_RAW, f"SELECT {_RAW_COLUMNS} FROM raw"),
        "ingest_paged_carts": _with(_CARTS, _CART_COLUMNS),
        "scan_raw_carts": _with(_CARTS, _CART_COLUMNS),
        "roundtrip_raw_json": _with(_RAW, f"SELECT {_RAW_COLUMNS}, pos AS ingest_pos FROM raw"),
        "scan_csv": _DIM_ROWS,
        "roundtrip_csv": _FLAT_LINES,
        "latest_snapshot": _with(
            _RAW,
            f"""SELECT id AS product_id, title AS product_name, category,
                CAST(price + 5 AS DOUBLE) AS price_usd, CAST(discount AS DOUBLE) AS discount_pct,
                rating AS avg_rating, stock AS stock_quantity,
                coalesce(brand, 'Unknown') AS brand,
                CAST({_net('(price + 5)', 'discount')} AS DOUBLE) AS actual_price_usd,
                CAST('2025-01-01 06:00:00' AS TIMESTAMP) AS processed_at
            FROM raw QUALIFY row_number() OVER (PARTITION BY id ORDER BY pos) = 1""",
        ),
        "write_marts": _with(
            f"{_DIM}, {_LINES}",
            """SELECT 'revenue_by_category' AS mart, count(DISTINCT category) AS n_rows FROM dim
            UNION ALL SELECT 'discount_impact', count(DISTINCT category) FROM dim
            UNION ALL SELECT 'dead_inventory', count(*) FROM dim
                WHERE stock_quantity > 50 AND avg_rating < 3.5
            UNION ALL SELECT 'order_analysis', count(*) FROM (
                SELECT DISTINCT category FROM lines LEFT JOIN dim USING (product_id))""",
        ),
        "refresh_idempotent": _with(
            _PRED,
            """SELECT category, count(*) AS n_rows, sum(predicted) AS predicted_units
            FROM pred GROUP BY category""",
        ),
        "ingest_row_counts": _ingest_counts(),
        # cleaning
        "coerce_numeric": _with(
            _SPOILT,
            """SELECT product_id, ingest_pos, CAST(price AS DOUBLE) AS price_usd,
                CAST(discount AS DOUBLE) AS discount_pct, rating AS avg_rating,
                stock AS stock_quantity FROM parsed""",
        ),
        "fill_missing": _with(
            _SPOILT,
            """SELECT product_id, ingest_pos, coalesce(CAST(price AS DOUBLE), 0) AS price_usd,
                coalesce(CAST(discount AS DOUBLE), 0) AS discount_pct, rating AS avg_rating,
                coalesce(stock, 0) AS stock_quantity, coalesce(brand, 'Unknown') AS brand
            FROM parsed""",
        ),
        "net_price": _with(
            _SPOILT,
            f"""SELECT product_id, ingest_pos,
                coalesce(CAST({_net('price', 'discount')} AS DOUBLE), 0) AS actual_price_usd
            FROM parsed""",
        ),
        "dedup_products": _with(
            _RAW,
            f"""SELECT {_RAW_COLUMNS}, pos AS ingest_pos FROM raw
            QUALIFY row_number() OVER (PARTITION BY id ORDER BY pos) = 1""",
        ),
        "clean_products": _DIM_ROWS,
        "flatten_order_lines": _FLAT_LINES,
        # marts and views
        "revenue_by_category": _catalogue(),
        "dead_inventory": _with(
            _DIM,
            """SELECT product_name, category, stock_quantity, avg_rating,
                CAST(actual_price_usd AS DOUBLE) AS actual_price_usd,
                CAST(actual_price_usd * stock_quantity AS DOUBLE) AS stock_value_at_risk_usd
            FROM dim WHERE stock_quantity > 50 AND avg_rating < 3.5""",
        ),
        "discount_impact": _with(
            _DIM,
            f"""SELECT category, {_mean('sum(discount_pct)', 'count(*)')} AS avg_discount_pct,
                CAST(sum(price_usd - actual_price_usd) AS DOUBLE) AS total_revenue_lost_usd,
                count(*) AS products_discounted
            FROM dim GROUP BY category""",
        ),
        "order_analysis": _order_analysis(),
        "category_revenue": _with(
            _ROWS,
            """SELECT category, count(DISTINCT order_id) AS total_orders,
                CAST(sum(quantity) AS BIGINT) AS units_sold,
                CAST(sum(net) AS DOUBLE) AS total_revenue_usd,
                CAST(sum(gross - net) AS DOUBLE) AS total_savings_usd,
                round(avg(avg_rating), 2) AS avg_rating
            FROM joined GROUP BY category""",
        ),
        "product_performance": _with(
            f"{_DIM}, {_LINES}",
            """SELECT d.product_name, d.category, d.brand, d.avg_rating, d.stock_quantity,
                CAST(d.actual_price_usd AS DOUBLE) AS actual_price_usd,
                CAST(coalesce(sum(l.quantity), 0) AS BIGINT) AS units_sold,
                CAST(coalesce(sum(l.net), 0) AS DOUBLE) AS revenue_usd
            FROM dim d LEFT JOIN lines l ON l.product_id = d.product_id
            GROUP BY d.product_name, d.category, d.brand, d.avg_rating, d.stock_quantity,
                d.actual_price_usd""",
        ),
        "prediction_quality": _with(
            _PRED,
            """SELECT product_id, category, predicted AS predicted_units,
                actual AS actual_units, run_date, mae, r2 AS r2_score, prediction_error,
                pct_error, band AS accuracy_band FROM graded""",
        ),
        # reports
        "overview_kpis": _with(_KPIS, "SELECT * FROM kpis"),
        "formatted_kpis": _with(
            _KPIS,
            """SELECT total_orders, total_products,
                '$' || format('{:,.2f}', total_revenue) AS total_revenue,
                CAST(avg_discount_pct AS VARCHAR) || '%' AS avg_discount FROM kpis""",
        ),
        "revenue_by_category_report": _with(
            _ROWS,
            "SELECT category, CAST(sum(gross) AS DOUBLE) AS revenue FROM joined GROUP BY category",
        ),
        "category_breakdown": _with(_BREAKDOWN, _BREAKDOWN_SELECT),
        "category_totals": _with(
            _BREAKDOWN,
            """SELECT count(*) AS total_categories, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
                CAST(sum(units_sold) AS BIGINT) AS total_units_sold,
                '$' || format('{:,.2f}', CAST(sum(revenue) AS DOUBLE)) AS total_revenue_label
            FROM breakdown""",
        ),
        "units_by_category": _with(_BREAKDOWN, _BREAKDOWN_SELECT),
        "prediction_by_category": _with(_PRED, _BY_CATEGORY),
        "error_by_category": _with(_PRED, _BY_CATEGORY),
        "prediction_metrics": _with(
            _PRED,
            """SELECT round(avg(mae), 4) AS mae, round(avg(r2), 4) AS r2,
                (SELECT count(*) FROM (SELECT DISTINCT category FROM pred)) AS categories
            FROM pred""",
        ),
        "accuracy_bands": _with(
            _PRED, "SELECT band AS accuracy_band, count(*) AS products FROM graded GROUP BY band"
        ),
        "inventory_listing": _with(_DIM, _STOCK_LIST),
        "out_of_stock": _with(_DIM, f"{_STOCK_LIST} WHERE stock_quantity = 0"),
        "low_stock": _with(_DIM, f"{_STOCK_LIST} WHERE stock_quantity BETWEEN 1 AND 9"),
        "inventory_counts": _with(
            _DIM,
            """SELECT count(*) FILTER (stock_quantity = 0) AS out_of_stock,
                count(*) FILTER (stock_quantity < 10) AS low_stock,
                count(*) FILTER (stock_quantity >= 10) AS healthy_stock FROM dim""",
        ),
        "stock_histogram": _with(
            f"""{_DIM},
            ends AS (
                SELECT min(stock_quantity) AS low, max(stock_quantity) + 1 AS high FROM dim
            )""",
            """SELECT CAST(floor(CAST(30 * (stock_quantity - low) AS DOUBLE) / (high - low))
                    AS BIGINT) + 1 AS bin,
                min(stock_quantity) AS min_stock, max(stock_quantity) AS max_stock,
                count(*) AS products
            FROM dim CROSS JOIN ends GROUP BY bin""",
        ),
        "product_lookup": _with(_lookup("Bolt"), "SELECT * FROM page"),
        "product_lookup_all": _with(_lookup("Bolt"), "SELECT * FROM hits"),
        "lookup_cards": _with(
            _lookup("unsold"),
            """SELECT product_name || '  —  ' || category AS title,
                '$' || CAST(price_usd AS VARCHAR) AS price,
                CAST(discount_pct AS VARCHAR) || '%' AS discount, avg_rating AS rating,
                stock_quantity AS stock, predicted_units, actual_units, accuracy_band,
                has_prediction FROM page""",
        ),
        # features
        "training_rows": _with(
            _ROWS,
            """SELECT order_id, product_id, quantity AS units_sold,
                CAST(gross AS DOUBLE) AS line_total_usd,
                CAST(discount AS DOUBLE) AS order_discount_pct, category, brand, avg_rating,
                stock_quantity, CAST(price_usd AS DOUBLE) AS price_usd,
                CAST(discount_pct AS DOUBLE) AS product_discount_pct FROM joined""",
        ),
        "features_price": _features("price_usd", "price_log", "price_after_disc", "discount_rate"),
        "features_flags": _features(
            "is_discounted", "is_out_of_stock", "is_low_stock", "is_high_rated"
        ),
        "features_stock": _features("stock_log", "rating_times_discount", "stock_to_sales_ratio"),
        "features_label_codes": _features("category_enc", "brand_enc"),
        "features_price_tier": _features("price_tier"),
        "features_group_stats": _features(
            "category_avg_sales", "category_sales_z", "brand_avg_sales"
        ),
        "features_full": _ALL_FEATURES,
        "features_from_rows": _ALL_FEATURES,
        # model
        "regression_metrics": _with(
            _PRED,
            """SELECT round(avg(miss), 6) AS mae,
                round(1 - sum((actual - predicted) * (actual - predicted))
                    / (var_pop(actual) * count(*)), 6) AS r2 FROM graded""",
        ),
        "split_counts": _with(
            _SPLIT, "SELECT is_train, count(*) AS n_rows FROM split GROUP BY is_train"
        ),
        "split_rows": _with(
            _SPLIT, "SELECT order_id, product_id, quantity AS units_sold, is_train, fold FROM split"
        ),
        "forecast": _with(
            _ROWS,
            """SELECT order_id, product_id, category, quantity AS units_sold, true AS in_range
            FROM joined""",
        ),
        "cv_metrics": "SELECT 5 AS folds, true AS every_fold_beats_mean",
        "write_predictions": _with(
            _ROWS,
            """SELECT product_id, category, quantity AS actual_units,
                CAST('2025-01-01' AS DATE) AS run_date FROM joined""",
        ),
        "model_metrics": _with(
            _ROWS,
            """SELECT count(*) AS n_predictions, 0 AS n_missing, true AS above_least,
                true AS below_most, 0 AS n_other_metrics, true AS beats_mean,
                true AS cv_beats_mean FROM joined""",
        ),
        "features_by_saved_lookups": _ALL_FEATURES,
        # entry points
        "sql_over_views": _with(
            _ROWS,
            """SELECT category, count(DISTINCT order_id) AS total_orders,
                (SELECT count(*) FROM (SELECT DISTINCT product_name, d.category, brand, avg_rating,
                    stock_quantity, actual_price_usd FROM dim d
                    WHERE d.category = joined.category
                        AND product_id IN (SELECT product_id FROM lines))) AS n_products,
                count(*) AS n_predictions
            FROM joined GROUP BY category""",
        ),
        "search_wildcards": _with(
            _DIM,
            "SELECT product_id, product_name FROM dim WHERE lower(product_name) LIKE '%b_l%x%'",
        ),
        "search_by_id": _with(
            _DIM,
            """SELECT product_id, product_name FROM dim
            WHERE contains(product_name, '291') OR product_id = 291""",
        ),
        "at_risk_products": _with(
            _DIM,
            """SELECT count(*) AS at_risk FROM dim
            WHERE stock_quantity > 50 AND avg_rating < 3.5""",
        ),
        "mart_file_values": _order_analysis(),
        "ingest_job": _ingest_counts(),
        "display_order": " UNION ALL ".join(
            [
                _ranked("revenue", _with(_BREAKDOWN, _BREAKDOWN_SELECT), "revenue DESC"),
                _ranked("units", _with(_BREAKDOWN, _BREAKDOWN_SELECT), "units_sold"),
                _ranked("catalogue", _catalogue(), "total_stock_value_usd DESC"),
                _ranked("orders", _order_analysis(), "total_revenue_usd DESC"),
            ]
        ),
        # data tests
        "dq_unique": _with(
            _RAW, "SELECT id, count(*) AS n_rows FROM raw GROUP BY id HAVING count(*) > 1"
        ),
        "dq_not_null": _with(
            _RAW, "SELECT id, title, pos AS ingest_pos FROM raw WHERE brand IS NULL"
        ),
        "dq_orphans": _with(
            f"{_DIM}, {_LINES}",
            """SELECT order_id, product_id, quantity AS quantity_ordered,
                CAST(gross AS DOUBLE) AS line_total_usd
            FROM lines WHERE NOT EXISTS (
                SELECT 1 FROM dim WHERE dim.product_id = lines.product_id)""",
        ),
        "dq_declared_tests": _with(
            f"""{_ROWS},
            per_category AS (
                SELECT category, sum(net) AS revenue FROM joined GROUP BY category
            )""",
            """SELECT 'unique' AS test, 'dim_products' AS relation, 'product_id' AS column_name,
                (SELECT count(*) FROM (
                    SELECT product_id FROM dim GROUP BY 1 HAVING count(*) > 1)) AS failures
            UNION ALL SELECT 'not_null', 'dim_products', 'product_id',
                (SELECT count(*) FROM dim WHERE product_id IS NULL)
            UNION ALL SELECT 'unique', 'category_revenue', 'category', (SELECT count(*) FROM (
                SELECT category FROM per_category WHERE category IS NOT NULL
                GROUP BY 1 HAVING count(*) > 1))
            UNION ALL SELECT 'not_null', 'category_revenue', 'category',
                (SELECT count(*) FROM per_category WHERE category IS NULL)
            UNION ALL SELECT 'not_null', 'category_revenue', 'total_revenue_usd',
                (SELECT count(*) FROM per_category WHERE revenue IS NULL)
            UNION ALL SELECT 'not_null', 'product_performance', 'product_name',
                (SELECT count(*) FROM dim WHERE product_name IS NULL)""",
        ),
    }
