"""Independent SQL for the registered queries, runnable on the raw tables.

Written apart from the DataFrame code where the two could share a mistake: the
streak comes from islands of consecutive order numbers instead of break flags,
ranking quality from per-score counts in one window.
"""

from __future__ import annotations

import re

from basketry.schema import FEATURES, SEED

CTES: dict[str, str] = {}


def _ratio(numerator: str, denominator: str, digits: int) -> str:
    """Half-up ratio of two whole numbers, as a double."""
    a, b, scale = f"CAST({numerator} AS BIGINT)", f"CAST({denominator} AS BIGINT)", 10**digits
    return f"CAST((2 * {scale} * {a} + {b}) // nullif(2 * {b}, 0) AS DOUBLE) / 1e{digits}"


CTES["labelled_parts"] = """
    SELECT p_partkey, p_brand, p_type,
           CASE WHEN p_brand IS NOT NULL THEN dense_rank() OVER (ORDER BY p_brand NULLS LAST) END AS brand_id,
           CASE WHEN p_type IS NOT NULL THEN dense_rank() OVER (ORDER BY p_type NULLS LAST) END AS type_id
    FROM part"""
CTES["part_products"] = """
    SELECT p_partkey, p_brand, p_type, brand_id, type_id,
           CAST((brand_id - 1) * (SELECT greatest(10, max(type_id)) FROM labelled_parts) + type_id
                AS INTEGER) AS product_id
    FROM labelled_parts"""
CTES["products"] = """
    SELECT DISTINCT product_id, p_type || ' ' || p_brand AS product_name,
           brand_id AS aisle_id, type_id AS department_id, p_brand, p_type
    FROM part_products WHERE product_id IS NOT NULL"""
CTES["dated"] = """
    SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS day FROM orders"""
CTES["placed"] = """
    SELECT order_id, user_id, day,
           row_number() OVER (PARTITION BY user_id ORDER BY day, order_id) AS place,
           row_number() OVER (PARTITION BY user_id ORDER BY day DESC, order_id DESC) AS from_end,
           lag(day) OVER (PARTITION BY user_id ORDER BY day, order_id) AS day_before
    FROM dated"""
CTES["base_orders"] = """
    SELECT order_id, user_id,
           CASE WHEN from_end > 1 THEN 'prior' WHEN user_id % 5 = 0 THEN 'test' ELSE 'train' END AS eval_set,
           CAST(place AS INTEGER) AS order_number,
           CAST((dayofweek(day) + 1) % 7 AS INTEGER) AS order_dow,
           CAST(order_id % 24 AS INTEGER) AS order_hour_of_day,
           CAST(day - day_before AS DOUBLE) AS days_since_prior_order
    FROM placed"""
CTES["merged_lines"] = """
    SELECT l_orderkey AS order_id, product_id, min(l_linenumber) AS line
    FROM (SELECT l_orderkey, l_linenumber,
                 coalesce(product_id, CAST(-1 - l_partkey % 2147483647 AS INTEGER)) AS product_id
          FROM lineitem LEFT JOIN part_products ON l_partkey = p_partkey)
    GROUP BY l_orderkey, product_id"""
CTES["base_items"] = """
    SELECT m.order_id, m.product_id,
           CAST(row_number() OVER (PARTITION BY m.order_id ORDER BY m.line, m.product_id) AS INTEGER)
               AS add_to_cart_order,
           CAST(CASE WHEN o.order_number > min(o.order_number) OVER (PARTITION BY o.user_id, m.product_id)
                     THEN 1 ELSE 0 END AS INTEGER) AS reordered
    FROM merged_lines m LEFT JOIN base_orders o ON o.order_id = m.order_id"""
CTES["cleaned"] = """
    SELECT order_id, user_id, eval_set, order_number, order_hour_of_day,
           ifnull(days_since_prior_order, 0.0) AS days_since_prior_order,
           """ + ", ".join(f"CAST(order_dow = {d} AS INTEGER) AS is_dow_{d}" for d in range(7)) + """,
           CAST(order_dow < 2 AS INTEGER) AS is_weekend, order_dow AS order_dow_raw
    FROM base_orders"""


def _layer_ctes(suffix: str, source: str) -> None:
    """The feature layers over the orders named ``source``."""
    CTES[f"history{suffix}"] = f"""
    SELECT o.user_id, i.product_id, i.order_id, o.order_number, i.reordered,
           row_number() OVER pair AS buy_sequence,
           lag(o.order_number) OVER pair AS prev_order_number_for_product
    FROM base_items i JOIN {source} o ON o.order_id = i.order_id AND o.eval_set = 'prior'
    WINDOW pair AS (PARTITION BY o.user_id, i.product_id ORDER BY o.order_number)"""
    CTES[f"islands{suffix}"] = f"""
    SELECT user_id, product_id, order_number - buy_sequence AS island,
           count(*) AS length, sum(reordered) AS hits, max(order_number) AS last_order, min(order_number) AS first_order
    FROM history{suffix} GROUP BY user_id, product_id, order_number - buy_sequence"""
    CTES[f"pairs{suffix}"] = f"""
    SELECT user_id, product_id,
           CAST(sum(length) AS BIGINT) AS user_product_total_buys,
           {_ratio("sum(hits)", "sum(length)", 6)} AS user_product_reorder_rate,
           CAST(arg_max(length, island) - CASE WHEN count(*) > 1 THEN 1 ELSE 0 END AS BIGINT)
               AS user_product_order_streak,
           CAST(1 AS BIGINT) AS user_product_first_buy_number,
           CAST(sum(length) AS BIGINT) AS user_product_last_buy_number,
           CAST(arg_max(length, island) AS BIGINT) AS user_product_run_length,
           max(last_order) AS last_order_number,
           min(first_order) AS first_order_number,
           CAST(sum(hits) AS BIGINT) AS hits
    FROM islands{suffix} GROUP BY user_id, product_id"""
    CTES[f"users{suffix}"] = f"""
    SELECT o.user_id, o.user_total_orders, o.user_avg_days_between_orders, i.user_total_items_bought
    FROM (SELECT user_id, max(order_number) AS user_total_orders,
                 {_ratio("round(sum(ifnull(days_since_prior_order, 0) * 10))", "count(*) * 10", 4)}
                     AS user_avg_days_between_orders
          FROM {source} WHERE eval_set = 'prior' GROUP BY user_id) o
    JOIN (SELECT user_id, count(*) AS user_total_items_bought FROM history{suffix} GROUP BY user_id) i
      ON i.user_id = o.user_id"""
    CTES[f"product_rates{suffix}"] = f"""
    SELECT product_id, count(*) AS product_total_purchases,
           {_ratio("sum(reordered)", "count(*)", 6)} AS product_reorder_rate
    FROM history{suffix} GROUP BY product_id"""


_layer_ctes("", "base_orders")
CTES["only_prior"] = "SELECT * FROM base_orders WHERE eval_set = 'prior'"
_layer_ctes("_bare", "only_prior")

CTES["context"] = """
    SELECT order_id AS train_order_id, user_id, order_number AS train_order_number,
           order_hour_of_day AS train_order_hour, days_since_prior_order AS train_days_since_prior,
           order_dow_raw AS train_order_dow, is_weekend AS train_is_weekend,
           """ + ", ".join(f"is_dow_{d} AS train_is_dow_{d}" for d in range(7)) + """
    FROM cleaned WHERE eval_set = 'train'"""
CTES["wanted"] = """
    SELECT c.user_id, i.product_id, i.order_id AS train_order_id
    FROM base_items i JOIN context c ON c.train_order_id = i.order_id"""
CTES["matrix"] = f"""
    SELECT p.user_id, p.product_id, c.train_order_id,
           CAST((p.user_id, p.product_id) IN (SELECT (user_id, product_id) FROM wanted) AS INTEGER)
               AS is_reordered_target,
           p.* EXCLUDE (user_id, product_id, user_product_run_length, last_order_number, first_order_number, hits),
           {_ratio("user_product_last_buy_number", "user_product_total_buys", 4)} AS user_product_recency_ratio,
           u.* EXCLUDE (user_id),
           {_ratio("user_total_items_bought", "user_total_orders", 4)} AS user_avg_basket_size,
           r.* EXCLUDE (product_id),
           c.* EXCLUDE (user_id, train_order_id)
    FROM context c
    JOIN pairs p ON p.user_id = c.user_id
    LEFT JOIN users u ON u.user_id = c.user_id
    LEFT JOIN product_rates r ON r.product_id = p.product_id"""


def _bucket(key: str) -> str:
    """The portable hash bucket 0..999 of a key."""
    once = f"((CAST({key} AS BIGINT) % 2147483648) * 1103515245 + 12345) % 2147483648"
    return f"(((({once}) + {SEED}) % 2147483648 * 1103515245 + 12345) % 2147483648 // 65536) % 1000"


CTES["sides"] = f"""
    SELECT *, CASE WHEN {_bucket("user_id")} < 200 THEN 'test' ELSE 'train' END AS split FROM matrix"""

_POINTS = """CAST(user_product_total_buys AS BIGINT) * 10
             + CAST(user_product_order_streak AS BIGINT) * 15
             + (CAST(train_order_hour AS BIGINT) + CAST(train_order_dow AS BIGINT) * 3) % 40
             + CAST(floor(product_reorder_rate * 100) AS BIGINT)"""
CTES["scored"] = f"""
    SELECT user_id, product_id, is_reordered_target, ({_POINTS}) / ({_POINTS} + 1e2) AS reorder_prob
    FROM sides WHERE split = 'test'"""
CTES["outcome"] = """
    SELECT count(*) FILTER (is_reordered_target = 0 AND reorder_prob < 0.5) AS tn,
           count(*) FILTER (is_reordered_target = 0 AND reorder_prob >= 0.5) AS fp,
           count(*) FILTER (is_reordered_target = 1 AND reorder_prob < 0.5) AS fn,
           count(*) FILTER (is_reordered_target = 1 AND reorder_prob >= 0.5) AS tp
    FROM scored"""
CTES["requests"] = """
    SELECT event_id AS request_id, user_id, CAST(hour(ts) AS INTEGER) AS current_hour,
           CAST((dayofweek(ts) + 1) % 7 AS INTEGER) AS current_dow,
           CASE WHEN event_id % 2 = 0 THEN NULL ELSE 7.0::DOUBLE END AS days_since_last_order
    FROM events WHERE event_type = 'view'"""
CTES["request_rows"] = f"""
    SELECT q.request_id, q.user_id, p.product_id,
           p.* EXCLUDE (user_id, product_id, user_product_run_length, last_order_number, first_order_number, hits),
           {_ratio("user_product_last_buy_number", "user_product_total_buys", 4)} AS user_product_recency_ratio,
           u.* EXCLUDE (user_id),
           {_ratio("user_total_items_bought", "user_total_orders", 4)} AS user_avg_basket_size,
           r.* EXCLUDE (product_id),
           CAST(u.user_total_orders AS INTEGER) + 1 AS train_order_number,
           q.current_hour AS train_order_hour,
           ifnull(q.days_since_last_order, u.user_avg_days_between_orders) AS train_days_since_prior,
           q.current_dow AS train_order_dow,
           CAST(q.current_dow <= 1 AS INTEGER) AS train_is_weekend,
           """ + ", ".join(f"CAST(q.current_dow = {d} AS INTEGER) AS train_is_dow_{d}" for d in range(7)) + """
    FROM requests q JOIN pairs p USING (user_id) JOIN users u USING (user_id)
    JOIN product_rates r ON r.product_id = p.product_id"""
CTES["answers"] = f"""
    SELECT request_id, CAST(rank AS INTEGER) AS rank, product_id, product_name, reorder_prob,
           total_buys, order_streak, product_rate
    FROM (SELECT request_id, product_id, user_product_total_buys AS total_buys,
                 user_product_order_streak AS order_streak, product_reorder_rate AS product_rate,
                 ({_POINTS}) / ({_POINTS} + 1e3) AS reorder_prob,
                 row_number() OVER (PARTITION BY request_id
                                    ORDER BY {_POINTS} DESC, product_id) AS rank
          FROM request_rows) ranked
    JOIN products USING (product_id)
    WHERE rank <= 10 AND reorder_prob >= 0.05"""
CTES["summary"] = """
    SELECT q.request_id, count(p.product_id) AS candidates_scored
    FROM requests q LEFT JOIN pairs p ON p.user_id = q.user_id GROUP BY q.request_id"""


def _with(body: str) -> str:
    """Prefix a query with the CTEs it names, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in needed) + "\n" + body


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _check(name: str, count: str) -> str:
    return f"SELECT '{name}' AS check_name, CAST(({count}) AS BIGINT) AS violations"


_TABLE_SQL = {
    "aisles": "(SELECT DISTINCT brand_id AS aisle_id, p_brand AS aisle FROM labelled_parts)",
    "departments": "(SELECT DISTINCT type_id AS department_id, p_type AS department FROM labelled_parts)",
    "products": "(SELECT product_id, product_name, aisle_id, department_id FROM products)",
    "orders": "(SELECT * FROM base_orders)",
    "order_products": "(SELECT * FROM base_items)",
}
_REQUIRED = {
    "aisles": ["aisle_id", "aisle"],
    "departments": ["department_id", "department"],
    "products": ["product_id", "product_name", "aisle_id", "department_id"],
    "orders": ["order_id", "user_id", "eval_set", "order_number", "order_dow", "order_hour_of_day"],
    "order_products": ["order_id", "product_id", "add_to_cart_order", "reordered"],
}
_KEYS = {
    "pk_aisles": ("aisles", "aisle_id"),
    "pk_departments": ("departments", "department_id"),
    "pk_products": ("products", "product_id"),
    "pk_orders": ("orders", "order_id"),
    "pk_order_products": ("order_products", "order_id, product_id"),
}
_DOMAINS = {
    "orders.order_number": ("orders", "order_number < 1"),
    "orders.order_dow": ("orders", "order_dow < 0 OR order_dow > 6"),
    "orders.order_hour_of_day": ("orders", "order_hour_of_day < 0 OR order_hour_of_day > 23"),
    "orders.eval_set": ("orders", "eval_set NOT IN ('prior', 'train', 'test')"),
    "order_products.add_to_cart_order": ("order_products", "add_to_cart_order < 1"),
    "order_products.reordered": ("order_products", "reordered < 0 OR reordered > 1"),
    "aisles.aisle": ("aisles", "length(aisle) > 100"),
    "departments.department": ("departments", "length(department) > 100"),
    "products.product_name": ("products", "length(product_name) > 500"),
}
_PARENTS = {
    "products.aisle_id": ("products", "aisle_id", "aisles", "aisle_id"),
    "products.department_id": ("products", "department_id", "departments", "department_id"),
    "order_products.order_id": ("order_products", "order_id", "orders", "order_id"),
    "order_products.product_id": ("order_products", "product_id", "products", "product_id"),
}
_CLEANED_COLUMNS = [
    "order_id",
    "user_id",
    "eval_set",
    "order_number",
    "order_hour_of_day",
    "days_since_prior_order",
    *[f"is_dow_{d}" for d in range(7)],
    "is_weekend",
    "order_dow_raw",
]
_AUDIT = {
    "null_total_buys": "user_product_total_buys",
    "null_up_reorder_rate": "user_product_reorder_rate",
    "null_streak": "user_product_order_streak",
    "null_user_orders": "user_total_orders",
    "null_avg_days": "user_avg_days_between_orders",
    "null_prod_purchases": "product_total_purchases",
    "null_prod_reorder_rate": "product_reorder_rate",
    "null_train_days": "train_days_since_prior",
}
_BALANCE = """SELECT count(*) AS total_rows,
       count(*) FILTER (is_reordered_target = 1) AS positives,
       count(*) FILTER (is_reordered_target = 0) AS negatives,
       CAST(count(*) FILTER (is_reordered_target = 1) AS DOUBLE) / count(*) AS positive_rate,
       CAST(count(*) FILTER (is_reordered_target = 0) AS DOUBLE)
           / count(*) FILTER (is_reordered_target = 1) AS scale_pos_weight"""


def _share(column: str, count_name: str, table: str) -> str:
    return f"""SELECT {column}, n AS {count_name}, {_ratio("n * 100", "sum(n) OVER ()", 2)} AS pct_of_total
    FROM (SELECT {column}, count(*) AS n FROM {table} GROUP BY {column})"""


def _changed(layer: str, columns: str) -> str:
    """Rows of a layer that only one of the two builds has."""
    full, bare = f"SELECT {columns} FROM {layer}", f"SELECT {columns} FROM {layer}_bare"
    name = {"pairs": "user_product_features", "users": "user_features", "product_rates": "product_features"}[layer]
    return f"""SELECT '{name}' AS layer,
       (SELECT count(*) FROM (({bare}) EXCEPT ALL ({full}))) AS added_rows,
       (SELECT count(*) FROM (({full}) EXCEPT ALL ({bare}))) AS removed_rows"""


def _report_rows() -> str:
    classes = """per_class AS (
        SELECT CAST(tn AS DOUBLE) / nullif(tn + fn, 0) AS p0, CAST(tn AS DOUBLE) / nullif(tn + fp, 0) AS r0,
               CAST(2 * tn AS DOUBLE) / nullif(2 * tn + fn + fp, 0) AS f0, tn + fp AS s0,
               CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS p1, CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS r1,
               CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0) AS f1, tp + fn AS s1,
               CAST(tn + tp AS DOUBLE) / (tn + fp + fn + tp) AS acc
        FROM outcome)"""
    v = {f"{m}{k}": f"ifnull({m}{k}, 0)" for m in "prf" for k in "01"}
    rows = [("0", v["p0"], v["r0"], v["f0"], "s0"), ("1", v["p1"], v["r1"], v["f1"], "s1")]
    rows.append(("accuracy", "acc", "acc", "acc", "s0 + s1"))
    rows.append(("macro avg", *[f"({v[m + '0']} + {v[m + '1']}) / 2" for m in "prf"], "s0 + s1"))
    rows.append(
        ("weighted avg", *[f"({v[m + '0']} * s0 + {v[m + '1']} * s1) / (s0 + s1)" for m in "prf"], "s0 + s1")
    )
    body = _union([
        f"SELECT '{label}' AS label, {p} AS precision, {r} AS recall, {f} AS f1, {s} AS support FROM per_class"
        for label, p, r, f, s in rows
    ])
    prefix = _with("SELECT * FROM outcome").rsplit("\nSELECT * FROM outcome", 1)[0]
    return f"{prefix},\n{classes}\n{body}"


def _statistics() -> str:
    """Row counts, nulls and ranges of the three layers, one row per column."""
    sums = {"reordered_buys": "hits", "flagged_buys": "user_product_total_buys"}
    own = {
        "pairs": [
            "user_id", "product_id", *FEATURES[:5], "user_product_run_length", "last_order_number", "first_order_number", *sums,
        ],
        "users": ["user_id", "user_total_orders", "user_avg_days_between_orders", "user_total_items_bought"],
        "product_rates": ["product_id", "product_total_purchases", "product_reorder_rate"],
    }
    names = {"pairs": "user_product_features", "users": "user_features", "product_rates": "product_features"}
    return _union([
        f"SELECT '{names[layer]}' AS layer, '{c}' AS column_name, count(*) AS row_count, "
        f"count(*) - count({sums.get(c, c)}) AS null_count, CAST(min({sums.get(c, c)}) AS DOUBLE) AS low, "
        f"CAST(max({sums.get(c, c)}) AS DOUBLE) AS high FROM {layer}"
        for layer, columns in own.items()
        for c in columns
    ])


_BODIES: dict[str, str] = {
    "base_orders": "SELECT * FROM base_orders",
    "base_order_products": "SELECT * FROM base_items",
    "product_catalog": """SELECT product_id, product_name, p_brand AS aisle_name, p_type AS department_name
        FROM products""",
    "csv_orders": "SELECT * FROM base_orders",
    "csv_order_products": "SELECT * FROM base_items",
    "table_row_counts": _union([
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {sql} t" for name, sql in _TABLE_SQL.items()
    ]),
    "not_null_violations": _union([
        _check(f"{t}.{c}", f"SELECT count(*) FROM {_TABLE_SQL[t]} t WHERE {c} IS NULL")
        for t, columns in _REQUIRED.items()
        for c in columns
    ]),
    "pk_violations": _union([
        _check(name, f"SELECT count(*) FROM (SELECT {k} FROM {_TABLE_SQL[t]} t GROUP BY {k} HAVING count(*) > 1)")
        for name, (t, k) in _KEYS.items()
    ]),
    "fk_violations": _union([
        _check(
            name,
            f"SELECT count(*) FROM {_TABLE_SQL[c]} c WHERE c.{k} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {_TABLE_SQL[p]} p WHERE p.{pk} = c.{k})",
        )
        for name, (c, k, p, pk) in _PARENTS.items()
    ]),
    "fk_violations_after_purge": _union([
        _check(
            name,
            f"SELECT count(*) FROM {_TABLE_SQL[c]} c WHERE c.{k} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {_TABLE_SQL[p]} p WHERE p.{pk} = c.{k}"
            + (" AND p.order_hour_of_day <> 0)" if p == "orders" else ")"),
        )
        for name, (c, k, p, pk) in _PARENTS.items()
    ]),
    "pk_violations_of_lines": _check(
        "pk_lineitem",
        "SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) d",
    ),
    "uncleaned_null_check": "SELECT count(*) - count(days_since_prior_order) AS null_count FROM base_orders",
    "domain_violations": _union([
        _check(name, f"SELECT count(*) FROM {_TABLE_SQL[t]} t WHERE {bad}") for name, (t, bad) in _DOMAINS.items()
    ]),
    "feature_key_violations": _union([
        _check(
            "user_product_order_number",
            "SELECT count(*) FROM (SELECT user_id FROM history "
            "GROUP BY user_id, product_id, order_number HAVING count(*) > 1)",
        ),
        _check(
            "user_product",
            "SELECT count(*) FROM (SELECT user_id FROM pairs GROUP BY user_id, product_id HAVING count(*) > 1)",
        ),
    ]),
    "purge_orders": """SELECT i.order_id, i.product_id FROM base_items i
        WHERE i.order_id IN (SELECT order_id FROM base_orders WHERE order_number > 1)""",
    "deletable_products": """SELECT product_id FROM products WHERE product_id NOT IN (
        SELECT i.product_id FROM base_items i JOIN base_orders o ON o.order_id = i.order_id
        WHERE o.eval_set = 'test' AND o.order_hour_of_day = 0)""",
    "cleaned_orders": "SELECT * FROM cleaned",
    "cleaned_columns": _union([
        f"SELECT CAST({n} AS INTEGER) AS ordinal_position, '{c}' AS column_name, "
        f"(SELECT count(*) FROM cleaned WHERE {c} IS NULL) AS null_count"
        for n, c in enumerate(_CLEANED_COLUMNS, start=1)
    ]),
    "cleaned_null_check": "SELECT count(*) - count(days_since_prior_order) AS null_count FROM cleaned",
    "ohe_check": "SELECT count(*) AS rows_with_wrong_ohe FROM cleaned WHERE NOT ("
    + " + ".join(f"is_dow_{d}" for d in range(7))
    + " = 1)",
    "weekend_share": _share("is_weekend", "order_count", "cleaned"),
    "cleaned_sample": "SELECT * FROM cleaned ORDER BY substr(md5('42:' || order_id), 1, 15), order_id LIMIT 10",
    "matrix_sample": "SELECT * FROM matrix ORDER BY user_id, product_id, train_order_id LIMIT 10",
    "sampled_users": "SELECT * FROM matrix WHERE user_id % 4 = 0",
    "prior_items": """SELECT i.order_id, i.product_id, i.reordered, o.user_id, o.order_number
        FROM base_items i JOIN base_orders o ON o.order_id = i.order_id AND o.eval_set = 'prior'""",
    "user_features": "SELECT * FROM users",
    "product_features": "SELECT * FROM product_rates",
    "user_product_history": "SELECT * FROM history",
    "user_product_features": "SELECT * EXCLUDE (user_product_run_length, last_order_number, first_order_number, hits) FROM pairs",
    "streak_run": f"""SELECT p.user_id, p.product_id, p.user_product_run_length,
        {_ratio("p.last_order_number", "u.user_total_orders", 4)} AS recency_ratio_by_order
        FROM pairs p JOIN users u ON u.user_id = p.user_id""",
    "joined_layers": """SELECT p.* EXCLUDE (user_product_run_length, last_order_number, first_order_number, hits),
        u.* EXCLUDE (user_id), r.* EXCLUDE (product_id)
        FROM pairs p JOIN users u ON u.user_id = p.user_id JOIN product_rates r ON r.product_id = p.product_id""",
    "feature_spot_check": """SELECT p.user_id, p.product_id, user_total_orders, user_avg_days_between_orders,
        user_total_items_bought, product_total_purchases, product_reorder_rate,
        user_product_total_buys, user_product_reorder_rate, user_product_order_streak
        FROM pairs p JOIN users u ON u.user_id = p.user_id JOIN product_rates r ON r.product_id = p.product_id
        ORDER BY user_product_total_buys DESC, p.user_id, p.product_id LIMIT 10""",
    "leakage_guard": _union([
        _changed("pairs", "*"),
        _changed("users", "*"),
        _changed("product_rates", "*"),
    ]),
    "layer_statistics": _statistics(),
    "refreshed_layers": "SELECT * EXCLUDE (user_product_run_length, last_order_number, first_order_number, hits) FROM pairs",
    "lookup_user": f"""SELECT p.* EXCLUDE (user_id, user_product_run_length, last_order_number, first_order_number, hits),
        {_ratio("p.user_product_last_buy_number", "p.user_product_total_buys", 4)} AS user_product_recency_ratio,
        u.* EXCLUDE (user_id), {_ratio("u.user_total_items_bought", "u.user_total_orders", 4)} AS user_avg_basket_size,
        r.* EXCLUDE (product_id)
        FROM pairs p JOIN users u ON u.user_id = p.user_id JOIN product_rates r ON r.product_id = p.product_id
        WHERE p.user_id = (SELECT min(user_id) FROM users)""",
    "published_layers": "SELECT *, CAST(2 AS INTEGER) AS version FROM product_rates",
    "train_order_context": "SELECT * FROM context",
    "train_items": "SELECT * FROM wanted",
    "candidate_pairs": """SELECT * EXCLUDE (user_product_run_length, last_order_number, first_order_number, hits) FROM pairs
        WHERE user_id IN (SELECT user_id FROM context)""",
    "training_matrix": "SELECT * FROM matrix",
    "model_frame": "SELECT user_id, product_id, train_order_id, is_reordered_target, "
    + ", ".join(f"ifnull(CAST({c} AS DOUBLE), 0) AS {c}" for c in FEATURES)
    + " FROM matrix",
    "label_distribution": _share("is_reordered_target", "row_count", "matrix"),
    "matrix_null_audit": "SELECT "
    + ", ".join(f"count(*) - count({c}) AS {name}" for name, c in _AUDIT.items())
    + " FROM matrix",
    "matrix_pair_uniqueness": """SELECT count(*) AS total_rows,
        count(DISTINCT concat(user_id, ':', product_id)) AS unique_user_product_pairs,
        count(DISTINCT user_id) AS unique_users, count(DISTINCT product_id) AS unique_products
        FROM matrix""",
    "matrix_range_audit": """SELECT
        count(*) FILTER (user_product_reorder_rate < 0 OR user_product_reorder_rate > 1) AS bad_up_reorder_rate,
        count(*) FILTER (product_reorder_rate < 0 OR product_reorder_rate > 1) AS bad_prod_reorder_rate,
        count(*) FILTER (user_product_order_streak <= 0) AS bad_streak,
        count(*) FILTER (user_product_recency_ratio < 0 OR user_product_recency_ratio > 1) AS bad_recency_ratio
        FROM matrix""",
    "feature_null_counts": _union([
        f"SELECT '{c}' AS feature, count(*) - count({c}) AS null_count FROM matrix" for c in FEATURES
    ]),
    "group_split": """SELECT split, count(*) AS row_count, count(DISTINCT user_id) AS unique_users
        FROM sides GROUP BY split""",
    "split_overlap": """SELECT count(*) AS overlapping_users
        FROM (SELECT user_id FROM sides GROUP BY user_id HAVING min(split) <> max(split))""",
    "split_shared_users": """SELECT count(*) AS shared_users FROM (
        (SELECT user_id FROM sides WHERE split = 'train')
        INTERSECT (SELECT user_id FROM sides WHERE split = 'test'))""",
    "class_balance": f"{_BALANCE} FROM matrix",
    "train_class_weight": f"{_BALANCE} FROM sides WHERE split = 'train'",
    "user_split": f"""SELECT DISTINCT user_id, CASE WHEN bucket < 200 THEN 'test'
        WHEN bucket < 300 THEN 'validation' ELSE 'train' END AS split
        FROM (SELECT user_id, {_bucket("user_id")} AS bucket FROM matrix)""",
    "exact_user_split": f"""SELECT user_id, CASE WHEN place <= ceil(round(0.2 * n, 6)) THEN 'test'
        WHEN place <= ceil(round(0.2 * n, 6)) + ceil(round(0.1 * n, 6)) THEN 'validation' ELSE 'train' END AS split
        FROM (SELECT user_id, count(*) OVER () AS n,
                     row_number() OVER (ORDER BY substr(md5('{SEED}:' || user_id), 1, 15)) AS place
              FROM (SELECT DISTINCT user_id FROM matrix))""",
    "predictions": "SELECT *, CAST(reorder_prob >= 0.5 AS INTEGER) AS predicted FROM scored",
    "confusion_matrix": "SELECT * FROM outcome",
    "roc_auc": """SELECT auc, CASE WHEN auc >= 0.85 THEN 'EXCELLENT' WHEN auc >= 0.8 THEN 'GOOD'
                         WHEN auc >= 0.75 THEN 'FAIR' ELSE 'NEEDS REVIEW' END AS tier
        FROM (SELECT CAST(sum(pos * (2 * lower + neg)) AS DOUBLE)
                     / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE) * 2) AS auc
              FROM (SELECT pos, neg, sum(neg) OVER (ORDER BY reorder_prob) - neg AS lower
                    FROM (SELECT reorder_prob, sum(is_reordered_target) AS pos,
                                 sum(1 - is_reordered_target) AS neg
                          FROM scored GROUP BY reorder_prob)))""",
    "score_cumulative_share": f"""SELECT CAST(rank AS INTEGER) AS rank, feature, gain,
        gain * 100.0::DOUBLE / total AS gain_pct, running * 100.0::DOUBLE / total AS gain_pct_cum, running * 100.0::DOUBLE / total <= 80 AS in_top_80
        FROM (SELECT feature, CAST(n AS DOUBLE) AS gain,
                     row_number() OVER (ORDER BY n DESC, feature) AS rank,
                     CAST(sum(n) OVER (ORDER BY n DESC, feature) AS DOUBLE) AS running,
                     CAST(sum(n) OVER () AS DOUBLE) AS total
              FROM ({_union([
                  f"SELECT '{c}' AS feature, count(*) FILTER (is_reordered_target = 1 AND {c} > 0) AS n FROM matrix"
                  for c in FEATURES
              ])}))""",
    "serving_requests": "SELECT *, 10 AS top_n FROM requests",
    "stored_features": f"""SELECT p.* EXCLUDE (user_product_run_length, last_order_number, first_order_number, hits),
        {_ratio("p.user_product_last_buy_number", "p.user_product_total_buys", 4)} AS user_product_recency_ratio,
        u.* EXCLUDE (user_id), {_ratio("u.user_total_items_bought", "u.user_total_orders", 4)} AS user_avg_basket_size,
        r.* EXCLUDE (product_id)
        FROM pairs p JOIN users u ON u.user_id = p.user_id JOIN product_rates r ON r.product_id = p.product_id
        WHERE p.user_id IN (SELECT user_id FROM requests)""",
    "request_labels": """SELECT request_id,
        ['Saturday', 'Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday'][current_dow + 1] AS day_name,
        CASE WHEN current_dow < 2 THEN 'Weekend' ELSE 'Weekday' END AS day_kind,
        CASE WHEN days_since_last_order IS NULL THEN 'mean of earlier orders'
             ELSE CAST(CAST(round_even(days_since_last_order, 0) AS INTEGER) AS VARCHAR) || ' days, as given' END AS gap_label
        FROM requests""",
    "request_features": "SELECT * FROM request_rows",
    "recommend_topn": "SELECT * FROM answers",
    "response_summary": "SELECT * FROM summary",
    "cross_user_summary": """SELECT s.request_id, s.candidates_scored, count(a.product_id) AS listed,
        round(avg(a.reorder_prob), 6) AS avg_prob, round(avg(a.order_streak), 6) AS avg_streak
        FROM summary s LEFT JOIN answers a ON a.request_id = s.request_id
        GROUP BY s.request_id, s.candidates_scored""",
    "stream_recommend": "SELECT * FROM answers",
}
ORACLE: dict[str, str] = {name: _with(body) for name, body in _BODIES.items()}
ORACLE["classification_report"] = _report_rows()
