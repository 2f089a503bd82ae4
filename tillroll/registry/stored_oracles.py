"""SQL counterparts of the queries over stored state: what the tables say, without the state."""

from __future__ import annotations

from tillroll.registry.oracles import (
    _CARTS,
    _DIM,
    _FEATURES,
    _LINE_KEY,
    _LINES,
    _RAW,
    _SPLIT,
    _md5,
    _with,
    all_oracles,
)
from tillroll.registry.stored import SEARCHES, SNAPSHOT_DAY, STUMP

_AFTER = f"FROM lineitem WHERE NOT (l_shipdate < '{SNAPSHOT_DAY}' AND l_returnflag = 'R')"


def _search(text: str, wildcards: bool) -> str:
    name = f"LIKE lower('%{text}%')" if wildcards else f"LIKE '%' || lower('{text}') || '%'"
    return f"""SELECT '{text}' AS search, product_id, product_name FROM dim
        WHERE lower(product_name) {name} OR CAST(product_id AS VARCHAR) = '{text}'"""


def _stump(body: str) -> str:
    """The best single split by squared error over the training lines of the sample."""
    key = [k.replace("quantity", "units_sold") for k in _LINE_KEY]
    ctes = _FEATURES.replace(
        "SELECT order_id, product_id, quantity AS units_sold,",
        "SELECT order_id, product_id, quantity AS units_sold, gross, discount,",
        1,
    )
    values = " UNION ALL ".join(
        f"SELECT {i} AS f, {name} AS v, units_sold AS y FROM fitted" for i, name in enumerate(STUMP.inputs)
    )
    value = " ".join(f"WHEN {i} THEN {name}" for i, name in enumerate(STUMP.inputs))
    return _with(
        f"""{ctes},
        numbered AS (
            SELECT *, {_md5("'labelled'", *key)} AS h, {_md5("'42'", *key)} % 10 < 8 AS is_train,
                count(*) OVER () AS n FROM feats),
        fitted AS (
            SELECT * FROM numbered
            WHERE is_train AND (n <= {STUMP.labelled_rows} OR h < 4294967296 * {STUMP.labelled_rows} / n)),
        spread AS ({values}),
        sums AS (SELECT f, v, count(*) AS n, sum(y) AS s FROM spread GROUP BY f, v),
        sides AS (
            SELECT f, v, sum(n) OVER up AS nl, sum(s) OVER up AS sl,
                sum(n) OVER everything - sum(n) OVER up AS nr,
                sum(s) OVER everything - sum(s) OVER up AS sr
            FROM sums WINDOW up AS (PARTITION BY f ORDER BY v), everything AS (PARTITION BY f)),
        best AS (
            SELECT f, v, CAST(sl AS DOUBLE) / nl AS left_mean, CAST(sr AS DOUBLE) / nr AS right_mean
            FROM sides WHERE nl >= {STUMP.min_leaf} AND nr >= {STUMP.min_leaf}
            ORDER BY CAST(sl AS DOUBLE) * sl / nl + CAST(sr AS DOUBLE) * sr / nr DESC, f, v LIMIT 1),
        predicted AS (
            SELECT order_id, product_id, units_sold, is_train,
                CASE WHEN (CASE f {value} END) <= v THEN left_mean ELSE right_mean END AS p
            FROM numbered CROSS JOIN best)""",
        body,
    )


_KINDS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}


def _inferred(column: str, value: str) -> str:
    # the other engine rounds a fraction to a whole number, which is none here
    whole = "CASE WHEN regexp_full_match(x, '[+-]?[0-9]+') THEN x END"
    texts = {name: whole if name in ("int", "bigint") else "x" for name in _KINDS}
    tried = " ".join(
        f"WHEN count(TRY_CAST({texts[name]} AS {kind})) = count(x) THEN '{name}'"
        for name, kind in _KINDS.items()
    )
    return f"""SELECT '{column}' AS column_name, count(x) AS n_values,
        CASE WHEN count(x) = 0 THEN 'string' {tried} ELSE 'string' END AS inferred
        FROM (SELECT CAST({value} AS VARCHAR) AS x FROM raw)"""


def _rejects() -> str:
    """Text that the fields of spoilt records hold: 'n/a', or nothing at all."""
    fields = {"price": "decimal(28,10)", "discountPercentage": "decimal(28,10)", "rating": "double", "stock": "bigint"}
    return " UNION ALL ".join(
        f"""SELECT pos AS ingest_pos, '{field}' AS field,
            CASE WHEN id % 11 = 0 THEN 'n/a' ELSE '' END AS raw,
            CASE WHEN id % 11 = 0 THEN 'not {kind}' ELSE 'blank' END AS reason
        FROM raw WHERE id % 11 = 0 OR id % 13 = 0"""
        for field, kind in fields.items()
    )


def _left_out(key: str) -> str:
    """Mean of a group without a fold, for every (group, fold)."""
    return f"""(SELECT (sum(sum(units_sold)) OVER (PARTITION BY {key}) - sum(units_sold))
            / (sum(count(*)) OVER (PARTITION BY {key}) - count(*)) AS mean, {key}, fold
        FROM folded GROUP BY {key}, fold)"""


def stored_oracles() -> dict[str, str]:
    known = all_oracles()

    def after(name: str) -> str:
        return known[name].replace("FROM lineitem", _AFTER)

    return {
        "committed_snapshot": known["latest_snapshot"],
        "committed_refresh": known["refresh_idempotent"],
        "incremental_category_revenue": after("category_revenue"),
        "incremental_product_performance": after("product_performance"),
        "category_revenue_by_bitmaps": known["category_revenue"],
        "overview_kpis_by_bitmaps": known["overview_kpis"],
        "orders_by_year_from_months": _with(
            f"""{_DIM},
            shipped AS (
                SELECT l_orderkey, brand, CAST(year(l_shipdate) AS VARCHAR) AS year
                FROM lineitem JOIN dim ON product_id = l_partkey * 3
            )""",
            """SELECT brand, year, count(DISTINCT l_orderkey) AS orders FROM shipped GROUP BY ALL
            UNION ALL
            SELECT brand, 'all', count(DISTINCT l_orderkey) FROM shipped GROUP BY ALL""",
        ),
        "bucketed_lines": _with(
            f"{_DIM}, {_LINES}",
            """SELECT order_id, product_id, quantity AS quantity_ordered,
                CAST(gross AS DOUBLE) AS line_total_usd, category, brand
            FROM lines LEFT JOIN dim USING (product_id)""",
        ),
        "bucketed_order_analysis": known["order_analysis"],
        "search_by_trigrams": _with(_DIM, " UNION ALL ".join(_search(*s) for s in SEARCHES)),
        "contiguous_folds": """
            SELECT l_orderkey, l_partkey, l_linenumber, position, CAST(
                CASE WHEN position < n % 10 * (n // 10 + 1) THEN position // (n // 10 + 1)
                ELSE n % 10 + (position - n % 10 * (n // 10 + 1)) // greatest(n // 10, 1) END AS INT) AS fold
            FROM (SELECT *, row_number() OVER () - 1 AS position, count(*) OVER () AS n FROM lineitem)""",
        "out_of_fold_features": _with(
            f"""{_SPLIT},
            folded AS (
                SELECT order_id, product_id, quantity AS units_sold, fold, category, brand FROM (
                    SELECT joined.*, CAST({_md5("'42'", "'fold'", *_LINE_KEY)} % 5 AS INT) AS fold
                    FROM joined))""",
            f"""SELECT order_id, product_id, units_sold, f.fold,
                round(CAST(c.mean AS DOUBLE), 6) AS category_mean, round(CAST(b.mean AS DOUBLE), 6) AS brand_mean
            FROM folded f JOIN {_left_out("category")} c ON c.category = f.category AND c.fold = f.fold
            JOIN {_left_out("brand")} b ON b.brand = f.brand AND b.fold = f.fold""",
        ),
        "inferred_types": _with(
            _RAW,
            " UNION ALL ".join(
                _inferred(column, value)
                for column, value in {
                    "id": "id", "title": "title", "category": "category", "brand": "brand",
                    "price": "price", "discountPercentage": "CAST(discount AS BIGINT)", "rating": "rating",
                    "stock": "stock",
                }.items()
            ),
        ),
        "rejected_values": _with(_RAW, _rejects()),
        **{f"mart_file_{name}": known[name] for name in ("revenue_by_category", "dead_inventory", "discount_impact")},
        "scan_json_array": _with(
            _CARTS, "SELECT order_id, user_id, CAST(total AS DOUBLE) AS total, n AS n_lines FROM headers"
        ),
        "warehouse_sources": known["order_analysis"],
        "first_wins_across_snapshots": _with(
            _RAW,
            """SELECT id, title, pos AS ingest_pos,
                CAST(price + CASE WHEN id // 3 % 4 = 0 THEN 5 ELSE 0 END AS DOUBLE) AS price
            FROM raw QUALIFY row_number() OVER (PARTITION BY id ORDER BY pos) = 1""",
        ),
        "orphans_by_known_keys": known["dq_orphans"],
        "price_tier_by_brackets": known["features_price_tier"],
        "stump_forecast": _stump(
            "SELECT order_id, product_id, units_sold, round(p, 6) AS predicted_units FROM predicted"
        ),
        "stump_metrics": _stump(
            """SELECT round(avg(abs(p - units_sold)), 4) AS mae,
                round(1 - sum((units_sold - p) * (units_sold - p))
                    / (var_pop(units_sold) * count(*)), 6) AS r2
            FROM predicted WHERE NOT is_train"""
        ),
    }
