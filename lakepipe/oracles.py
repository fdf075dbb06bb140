"""Plain-SQL statements of the same results, for an independent engine over the same tables."""

from __future__ import annotations

# The adapted feed (see ``lakepipe.sources.adapted``).
_RAW = """
base AS (
  SELECT event_id,
    date_trunc('second', ts) AS event_time,
    CASE WHEN event_id % 97 = 0 THEN NULL
         WHEN event_type = 'click' AND event_id % 4 = 0 THEN 'add_to_cart'
         WHEN event_type = 'click' THEN 'cart'
         WHEN event_type = 'purchase' THEN 'purchase'
         ELSE 'view' END AS event_type,
    k AS product_id,
    CASE WHEN k % 7 = 0 THEN NULL ELSE concat('Brand#', CAST(k % 25 AS VARCHAR)) END AS brand,
    CASE WHEN event_id % 83 = 0 THEN NULL
         ELSE value * 10 - 50 + CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 16 AS DOUBLE) / 16 ELSE 0 END
         END AS price,
    CASE WHEN event_id % 89 = 0 THEN NULL ELSE user_id * 31 + day(ts) END AS user_id,
    CASE WHEN event_id % 101 = 0 THEN NULL
         ELSE concat(CAST(user_id AS VARCHAR), '-', CAST(day(ts) AS VARCHAR)) END AS user_session
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) t),
raw AS (
  SELECT event_time, event_type, product_id, brand, price, user_id, user_session FROM base
  UNION ALL
  SELECT event_time, 'purchase', product_id, brand, price, user_id, user_session
  FROM base WHERE event_id % 50 = 0)"""

_RANK = """row_number() OVER (
      PARTITION BY user_session, event_time, product_id
      ORDER BY CASE event_type WHEN 'purchase' THEN 0 WHEN 'cart' THEN 1 WHEN 'add_to_cart' THEN 1 ELSE 2 END,
               price DESC NULLS LAST, user_id ASC NULLS LAST, brand ASC NULLS LAST, event_type ASC NULLS LAST)"""

_SILVER = f"""{_RAW},
valid AS (SELECT * FROM raw WHERE price > 0 AND user_id IS NOT NULL AND event_type IS NOT NULL),
ranked AS (SELECT *, {_RANK} AS place FROM valid),
silver AS (
  SELECT event_time, event_type, product_id, brand, price, user_id, user_session,
    CAST(event_time AS DATE) AS event_date,
    CAST(hour(event_time) AS INTEGER) AS event_hour,
    CASE WHEN price < 100 THEN 'budget' WHEN price < 1000 THEN 'mid_range' ELSE 'premium' END AS price_category
  FROM ranked WHERE place = 1)"""

# No price of the feed needs more than four decimals; the rest of a double's digits are rounding errors.
_MONEY = "CAST(sum(CAST({0} AS DECIMAL(24,8))) AS DOUBLE)"


def _sum(amount: str) -> str:
    return _MONEY.format(amount)


def _avg(amount: str) -> str:
    return f"{_sum(amount)} / count({amount})"


def _count_if(test: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {test}) AS BIGINT)"


_CART = "event_type IN ('cart', 'add_to_cart')"

_DAILY = f"""{_SILVER},
daily AS (
  SELECT event_date, count(*) AS total_purchases, {_sum('price')} AS total_revenue,
    {_avg('price')} AS avg_order_value, count(DISTINCT user_id) AS unique_buyers
  FROM silver WHERE event_type = 'purchase' GROUP BY event_date)"""

_PRODUCTS = f"""{_SILVER},
products AS (
  SELECT *, round(purchases / total_views * 100, 2) AS conversion_rate FROM (
    SELECT product_id, brand, price_category, count(*) AS total_views,
      {_count_if("event_type = 'view'")} AS view_events,
      {_count_if("event_type = 'purchase'")} AS purchases,
      {_count_if(_CART)} AS cart_adds,
      {_avg('price')} AS avg_price
    FROM silver GROUP BY product_id, brand, price_category) t)"""

_SPENT = "CASE WHEN event_type = 'purchase' THEN price ELSE 0 END"

_USERS = f"""{_SILVER},
users AS (
  SELECT user_id, count(*) AS total_events,
    {_count_if("event_type = 'purchase'")} AS purchases,
    {_count_if("event_type = 'view'")} AS views,
    {_count_if(_CART)} AS cart_adds,
    coalesce({_sum(_SPENT)}, 0) AS total_spent,
    coalesce({_avg('price')}, 0) AS avg_price,
    count(DISTINCT product_id) AS unique_products,
    count(DISTINCT event_date) AS active_days
  FROM silver GROUP BY user_id),
labelled AS (SELECT *, CAST(CASE WHEN purchases > 0 THEN 1 ELSE 0 END AS INTEGER) AS label FROM users)"""

# What the query over a damaged feed writes unreadable: times of some users, prices of others.
_DAMAGED = "coalesce(user_id % 50 = 0 OR user_id % 70 = 1, FALSE)"

_TRAINED = """SELECT 'train_size' AS "check", count(*) FILTER (WHERE is_train) AS value FROM parts
UNION ALL SELECT 'test_size', count(*) FILTER (WHERE NOT is_train) FROM parts
UNION ALL SELECT 'train_buyers', CAST(sum(label) FILTER (WHERE is_train) AS BIGINT) FROM parts
UNION ALL SELECT 'test_buyers', CAST(sum(label) FILTER (WHERE NOT is_train) AS BIGINT) FROM parts
UNION ALL SELECT 'features', 7
UNION ALL SELECT 'rows_scored', count(*) FILTER (WHERE NOT is_train) FROM parts
UNION ALL SELECT * FROM (VALUES ('probability_out_of_range', 0), ('class_against_threshold', 0),
  ('metrics_recomputed', 3), ('metrics_not_as_logged', 0), ('models_stored', 1))"""


def _strict(tables: str) -> str:
    """The same tables with ``add_to_cart`` as the only cart event; the duplicates' order stays."""
    return tables.replace(_CART, "event_type = 'add_to_cart'")


_FUNNEL = """SELECT round(carts * 100.0::DOUBLE / nullif(events, 0), 2) AS view_to_cart_pct,
  round(bought * 100.0::DOUBLE / nullif(carts, 0), 2) AS cart_to_purchase_pct,
  round(bought * 100.0::DOUBLE / nullif(events, 0), 2) AS overall_conversion_pct
FROM (SELECT CAST(sum(cart_adds) AS DOUBLE) AS carts, CAST(sum(purchases) AS DOUBLE) AS bought,
        CAST(sum(total_views) AS DOUBLE) AS events FROM products) t"""

_PRICE_SCORE = "avg_price / (avg_price + 100.0::DOUBLE * views + 1.0::DOUBLE)"
_VIEWS_SCORE = "1.0::DOUBLE - CAST(views AS DOUBLE) / total_events"


def _scored(name: str, score: str, threshold: float) -> str:
    return (
        f"{name} AS (SELECT *, CAST(CASE WHEN score >= {threshold}::DOUBLE THEN 1 ELSE 0 END AS INTEGER) AS prediction "
        f"FROM (SELECT *, {score} AS score FROM labelled) t)"
    )


_PRICE_RULE = f"{_USERS},\n{_scored('price_rule', _PRICE_SCORE, 0.6)}"
_BOTH_RULES = f"{_PRICE_RULE},\n{_scored('views_rule', _VIEWS_SCORE, 0.5)}"


def _hash(seed: int = 42) -> str:
    return f"CAST(concat('0x', substr(md5(concat(CAST(user_id AS VARCHAR), ':{seed}')), 1, 15)) AS BIGINT)"


_PREDICTIONS = f"""{_PRICE_RULE},
predictions AS (
  SELECT user_id, total_events, total_spent, avg_price, prediction AS will_purchase,
    round_even(score, 4) AS purchase_probability,
    CASE WHEN prediction = 1 THEN 'Likely to Purchase' ELSE 'Not Likely to Purchase' END AS purchase_label,
    {_hash()} % 100 >= 20 AS is_train
  FROM price_rule)"""


def _auc(scored: str) -> str:
    """Mann-Whitney rank sum with average ranks, kept in whole half-ranks."""
    return f"""(SELECT CAST(sum(CASE WHEN label = 1 THEN half_rank ELSE 0 END)
        - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) AS DOUBLE)
      / nullif(2.0::DOUBLE * CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE)
               * CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE), 0)
    FROM (SELECT label, 2 * rank() OVER (ORDER BY score) + count(*) OVER (PARTITION BY score) - 1 AS half_rank
          FROM {scored}) r)"""


def _accuracy(scored: str) -> str:
    return f"(SELECT CAST(count(*) FILTER (WHERE prediction = label) AS DOUBLE) / count(*) FROM {scored})"


def _f1(scored: str) -> str:
    def one(c: int) -> str:
        return (
            f"(real_{c} * coalesce(2.0::DOUBLE * hit_{c} / nullif(CAST(pred_{c} + real_{c} AS DOUBLE), 0), 0))"
        )

    return f"""(SELECT ({one(0)} + {one(1)}) / CAST(real_0 + real_1 AS DOUBLE) FROM (
      SELECT {', '.join(
          f"count(*) FILTER (WHERE label = {c} AND prediction = {c}) AS hit_{c}, "
          f"count(*) FILTER (WHERE prediction = {c}) AS pred_{c}, "
          f"count(*) FILTER (WHERE label = {c}) AS real_{c}" for c in (0, 1))}
      FROM {scored}) c)"""


_STRATIFIED = f"""{_USERS},
hashed AS (SELECT *, {_hash()} AS h FROM labelled),
sizes AS (
  SELECT label, n, n * wanted // total AS base, n * wanted % total AS rest, wanted FROM (
    SELECT label, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total,
      CAST(ceil(sum(count(*)) OVER () * 20 / 100.0) AS BIGINT) AS wanted
    FROM hashed GROUP BY label) t),
wanted AS (
  SELECT label, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= wanted - sum(base) OVER ()
                            THEN 1 ELSE 0 END AS test_rows
  FROM sizes),
placed AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, user_id) AS place FROM hashed),
parts AS (SELECT user_id, p.label, place > test_rows AS is_train FROM placed p JOIN wanted w ON p.label = w.label)"""

_LAYERS = f"""{_PREDICTIONS},
daily AS (SELECT event_date, count(*) AS total_purchases FROM silver WHERE event_type = 'purchase' GROUP BY event_date),
products AS (SELECT product_id, brand, price_category FROM silver GROUP BY product_id, brand, price_category),
sizes(layer, rows) AS (
  SELECT 'bronze.events', count(*) FROM raw
  UNION ALL SELECT 'silver.events', count(*) FROM silver
  UNION ALL SELECT 'gold.daily_revenue', count(*) FROM daily
  UNION ALL SELECT 'gold.product_performance', count(*) FROM products
  UNION ALL SELECT 'gold.user_features', count(*) FROM users
  UNION ALL SELECT 'gold.user_purchase_predictions', count(*) FROM predictions)"""

_CHECKS = f"""{_LAYERS},
keys(layer, repeated) AS (
  SELECT 'silver.events', count(*) FROM (SELECT 1 FROM silver GROUP BY user_session, event_time, product_id HAVING count(*) > 1) t
  UNION ALL SELECT 'gold.daily_revenue', count(*) FROM (SELECT 1 FROM daily GROUP BY event_date HAVING count(*) > 1) t
  UNION ALL SELECT 'gold.product_performance', count(*) FROM (SELECT 1 FROM products GROUP BY product_id, brand, price_category HAVING count(*) > 1) t
  UNION ALL SELECT 'gold.user_features', count(*) FROM (SELECT 1 FROM users GROUP BY user_id HAVING count(*) > 1) t
  UNION ALL SELECT 'gold.user_purchase_predictions', count(*) FROM (SELECT 1 FROM predictions GROUP BY user_id HAVING count(*) > 1) t),
checks("check", relation, expected, actual) AS (
  SELECT concat(layer, ' has rows'), '>=', CAST(1 AS BIGINT), CAST(rows AS BIGINT) FROM sizes
  UNION ALL SELECT concat(layer, ' keys are unique'), '=', 0, repeated FROM keys
  UNION ALL SELECT 'cleaning adds no rows', '<=', (SELECT count(*) FROM raw), (SELECT count(*) FROM silver)
  UNION ALL SELECT 'every user is scored', '=', (SELECT count(*) FROM users), (SELECT count(*) FROM predictions)
  UNION ALL SELECT 'purchases agree', '=', (SELECT CAST(sum(total_purchases) AS BIGINT) FROM daily),
                                          (SELECT CAST(sum(purchases) AS BIGINT) FROM users))"""

_RULE_METRICS = f"""{_BOTH_RULES},
measured(metric, price_rule, views_rule) AS (
  SELECT 'auc', {_auc('price_rule')}, {_auc('views_rule')}
  UNION ALL SELECT 'f1_score', {_f1('price_rule')}, {_f1('views_rule')}
  UNION ALL SELECT 'accuracy', {_accuracy('price_rule')}, {_accuracy('views_rule')})"""

_RAW_COLUMNS = ("event_time", "event_type", "product_id", "brand", "price", "user_id", "user_session")


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


def _profile() -> str:
    """Rows and NULLs of every column of bronze and silver, the partition column and the audit column included."""
    day = "CAST(event_time AS DATE)"
    layers = {
        "bronze.events": ("raw", {c: c for c in _RAW_COLUMNS} | {"ingestion_ts": "0", "event_date": day}),
        "silver.events": ("silver", {c: c for c in (*_RAW_COLUMNS, "event_hour", "price_category", "event_date")}),
    }
    return "\nUNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS column_name, count(*) AS rows, "
        f"{_count_if(f'{value} IS NULL')} AS nulls FROM {table}"
        for layer, (table, columns) in layers.items()
        for name, value in columns.items()
    )


#: Reports that exist as functions and as SQL over registered tables; both give the same rows.
_ALSO_SQL = ("event_type_distribution", "top_revenue_days", "purchase_funnel", "prediction_summary", "layer_counts")


def oracle_sql() -> dict[str, str]:
    named = _named()
    return named | {f"{name}_sql": named[name] for name in _ALSO_SQL}


def _named() -> dict[str, str]:
    raw = _with(_RAW, "SELECT * FROM raw")
    contract = ", ".join(f"('{c}')" for c in _RAW_COLUMNS)
    nulls = ", ".join(f"{_count_if(f'{c} IS NULL')} AS {c}" for c in _RAW_COLUMNS)
    reason = (
        "CASE WHEN NOT coalesce(price > 0, false) THEN 'bad_price' WHEN user_id IS NULL THEN 'no_user' "
        "WHEN event_type IS NULL THEN 'no_type' END"
    )
    columns = ", ".join(_RAW_COLUMNS)
    return {
        "ingest_csv_roundtrip": raw,
        "bronze_audit": _with(_RAW, "SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS ingestion_ts FROM raw"),
        "schema_check": _with(
            f"""{_RAW},
differences AS (
  SELECT coalesce(want.column_name, have.column_name) AS column_name,
    CASE WHEN have.column_name IS NULL THEN 'missing' ELSE 'unexpected' END AS problem
  FROM (VALUES {contract}) want(column_name)
  FULL JOIN (SELECT column_name FROM (DESCRIBE events)) have ON want.column_name = have.column_name
  WHERE want.column_name IS NULL OR have.column_name IS NULL)""",
            """SELECT 'as_declared' AS batch, '' AS problems, count(*) AS rows_offered, count(*) AS rows_accepted FROM raw
UNION ALL SELECT 'price_as_text', 'price:type', count(*), 0 FROM raw
UNION ALL SELECT 'other_table',
  (SELECT string_agg(concat(column_name, ':', problem), ',' ORDER BY column_name) FROM differences), count(*), 0
FROM events""",
        ),
        "publish_table": raw,
        "append_published": _with(
            _RAW,
            """SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, count(*) AS rows_logged, count(*) AS rows_read,
  TRUE AS files_kept FROM raw WHERE product_id % 3 <> 0 OR product_id IS NULL
UNION ALL SELECT 1, 'APPEND', count(*), count(*), TRUE FROM raw""",
        ),
        "rerun_day": _with(
            _SILVER,
            """SELECT event_date, count(*) AS rows, event_date = DATE '2024-01-10' AS rewritten FROM silver
WHERE event_date <> DATE '2024-01-10' OR event_type <> 'view' GROUP BY event_date""",
        ),
        "publish_profile": _with(_SILVER, _profile()),
        "incremental_clean": _with(_SILVER, "SELECT * FROM silver"),
        "incremental_changes": _with(
            f"""{_SILVER},
keys AS (
  SELECT user_session, event_time, product_id, bool_or(event_type = 'purchase') AS bought,
    bool_or(event_type <> 'purchase') AS other
  FROM valid GROUP BY ALL)""",
            """SELECT 'others' AS batch, 'added' AS change, count(*) AS rows FROM keys WHERE other
UNION ALL SELECT 'purchases', 'added', count(*) FROM keys WHERE bought AND NOT other
UNION ALL SELECT 'purchases', 'replaced', count(*) FROM keys WHERE bought AND other
UNION ALL SELECT 'sent_again', 'kept', count(*) FROM keys WHERE product_id % 3 = 0""",
        ),
        "user_features_bucketed": _with(_USERS, "SELECT * FROM users"),
        "weekly_buyers": _with(
            _SILVER,
            """SELECT CAST(date_trunc('week', event_date) AS DATE) AS week, count(*) AS purchases,
  count(DISTINCT user_id) AS buyers, TRUE AS within_bound FROM silver WHERE event_type = 'purchase' GROUP BY 1""",
        ),
        "trailing_buyers": _with(
            f"""{_SILVER},
bought AS (SELECT event_date, user_id FROM silver WHERE event_type = 'purchase'),
days AS (SELECT DISTINCT event_date AS until FROM bought)""",
            """SELECT until, count(*) AS purchases, count(DISTINCT user_id) AS buyers, TRUE AS within_bound
FROM days JOIN bought ON event_date BETWEEN until - 6 AND until GROUP BY until""",
        ),
        "ingest_unreadable": _with(
            _SILVER.replace("FROM raw WHERE", f"FROM raw WHERE NOT {_DAMAGED} AND"),
            f"""SELECT reason, count(*) AS rows FROM (
  SELECT 'unreadable' AS reason FROM raw WHERE {_DAMAGED}
  UNION ALL SELECT reason FROM (SELECT {reason} AS reason FROM raw WHERE NOT {_DAMAGED}) t WHERE reason IS NOT NULL
  UNION ALL SELECT 'duplicate' FROM ranked WHERE place > 1
  UNION ALL SELECT 'kept' FROM silver) u GROUP BY reason""",
        ),
        "ml_random_forest": _with(_STRATIFIED, _TRAINED),
        "ml_logistic_regression": _with(_STRATIFIED, _TRAINED),
        "ml_model_choice": """SELECT CAST(2 AS BIGINT) AS runs, CAST(3 AS BIGINT) AS metrics_compared,
  TRUE AS winner_has_highest_auc, TRUE AS winner_by_tie_rule, TRUE AS auc_in_range""",
        "ml_score_users": _with(
            _STRATIFIED,
            """SELECT user_id, total_events, total_spent, avg_price, is_train, TRUE AS probability_in_range,
  TRUE AS probability_rounded, TRUE AS class_by_threshold, TRUE AS text_by_class
FROM parts JOIN labelled USING (user_id)""",
        ),
        "publish_history": _with(
            _SILVER,
            """SELECT 'bronze.events' AS table_name, CAST(0 AS BIGINT) AS version, 'WRITE' AS operation,
  count(*) AS rows_written FROM raw
UNION ALL SELECT 'bronze.events', 1, 'OPTIMIZE', count(*) FROM raw
UNION ALL SELECT 'silver.events', 0, 'WRITE', count(*) FROM silver""",
        ),
        "zorder_rewrite": raw,
        "null_profile": _with(_RAW, f"SELECT {nulls} FROM raw"),
        "filter_price": _with(_RAW, "SELECT * FROM raw WHERE price > 0"),
        "filter_not_null": _with(_RAW, "SELECT * FROM raw WHERE user_id IS NOT NULL AND event_type IS NOT NULL"),
        "dedup_events": _with(
            _RAW, f"SELECT {columns} FROM (SELECT *, {_RANK} AS place FROM raw) t WHERE place = 1"
        ),
        "silver_events": _with(_SILVER, "SELECT * FROM silver"),
        "price_bands": _with(
            _RAW,
            """SELECT CASE WHEN price < 100 THEN 'budget' WHEN price < 1000 THEN 'mid_range' ELSE 'premium' END
  AS price_category, count(*) AS rows, min(price) AS lowest, max(price) AS highest FROM raw GROUP BY 1""",
        ),
        "cleaning_delta": _with(
            _SILVER,
            """SELECT bronze_rows, silver_rows, bronze_rows - silver_rows AS rows_removed FROM (
  SELECT (SELECT count(*) FROM raw) AS bronze_rows, (SELECT count(*) FROM silver) AS silver_rows) t""",
        ),
        "cleaning_rejects": _with(
            _SILVER,
            f"""SELECT {columns}, reason FROM (SELECT *, {reason} AS reason FROM raw) t WHERE reason IS NOT NULL
UNION ALL SELECT {columns}, 'duplicate' FROM ranked WHERE place > 1""",
        ),
        "daily_revenue": _with(_DAILY, "SELECT * FROM daily ORDER BY event_date NULLS FIRST"),
        "product_performance": _with(_PRODUCTS, "SELECT * FROM products"),
        "user_features": _with(_USERS, "SELECT * FROM users"),
        "product_performance_strict": _with(_strict(_PRODUCTS), "SELECT * FROM products"),
        "user_features_strict": _with(_strict(_USERS), "SELECT * FROM users"),
        "purchase_funnel_strict": _with(_strict(_PRODUCTS), _FUNNEL),
        "event_type_distribution": _with(
            _SILVER, 'SELECT event_type, count(*) AS "count" FROM silver GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST'
        ),
        "top_revenue_days": _with(
            _DAILY,
            """SELECT event_date, total_revenue, total_purchases, unique_buyers FROM daily
ORDER BY total_revenue DESC NULLS LAST, event_date NULLS LAST LIMIT 10""",
        ),
        "purchase_funnel": _with(
            _PRODUCTS,
            _FUNNEL,
        ),
        "prediction_summary": _with(
            _PREDICTIONS,
            f"""SELECT purchase_label, count(*) AS user_count, round({_avg('total_spent')}, 2) AS avg_spend,
  round(CAST(sum(CAST(purchase_probability AS DECIMAL(24,8))) AS DOUBLE) / count(*), 4) AS avg_score
FROM predictions GROUP BY purchase_label ORDER BY avg_spend DESC, purchase_label""",
        ),
        "layer_counts": _with(_LAYERS, "SELECT layer, CAST(rows AS BIGINT) AS rows FROM sizes ORDER BY layer"),
        "layer_verification": _with(
            _CHECKS,
            """SELECT *, CASE relation WHEN '>=' THEN actual >= expected WHEN '<=' THEN actual <= expected
  ELSE actual = expected END AS ok FROM checks""",
        ),
        "label_users": _with(_USERS, "SELECT user_id, purchases, label FROM labelled"),
        "label_distribution": _with(
            _USERS, 'SELECT label, count(*) AS "count" FROM labelled GROUP BY label ORDER BY 2 DESC, 1'
        ),
        "buyer_rate": _with(_USERS, "SELECT avg(label) * 100 AS buyer_rate_pct FROM labelled"),
        "feature_matrix": _with(
            _USERS,
            """SELECT user_id, total_events, views, cart_adds, total_spent, avg_price, unique_products, active_days, label
FROM labelled""",
        ),
        "split_users": _with(_USERS, f"SELECT user_id, label, {_hash()} % 100 >= 20 AS is_train FROM labelled"),
        "split_users_stratified": _with(_STRATIFIED, "SELECT * FROM parts"),
        "split_summary": _with(
            _STRATIFIED,
            "SELECT is_train, count(*) AS users, CAST(sum(label) AS BIGINT) AS buyers FROM parts GROUP BY is_train",
        ),
        "metric_auc": _with(_PRICE_RULE, f"SELECT {_auc('price_rule')} AS auc"),
        "metric_auc_bounds": _with(
            f"""{_PRICE_RULE},
bins AS (
  SELECT CASE WHEN score < 0 THEN -1 WHEN score >= 1 THEN 1000 ELSE CAST(floor(score * 1000) AS BIGINT) END AS bin,
    count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
  FROM price_rule GROUP BY 1),
summed AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower FROM bins),
sums AS (
  SELECT CAST(sum(pos * lower) AS DOUBLE) AS sure, CAST(sum(pos * neg) AS DOUBLE) AS within, count(*) AS bins_used,
    CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE) AS pairs FROM summed)""",
            f"""SELECT (sure + within / 2) / pairs AS auc, within / 2 / pairs AS error_bound, bins_used,
  {_auc('price_rule')} BETWEEN sure / pairs AND (sure + within) / pairs AS exact_inside FROM sums""",
        ),
        "metric_f1_weighted": _with(_PRICE_RULE, f"SELECT {_f1('price_rule')} AS f1_score"),
        "metric_accuracy": _with(_PRICE_RULE, f"SELECT {_accuracy('price_rule')} AS accuracy"),
        "model_comparison": _with(_RULE_METRICS, "SELECT * FROM measured"),
        "select_best_run": _with(
            _RULE_METRICS,
            """SELECT CASE WHEN price_rule >= views_rule THEN 'price_rule' ELSE 'views_rule' END AS run_id,
  CASE WHEN price_rule >= views_rule THEN 'price_rule' ELSE 'views_rule' END AS run_name,
  metric, greatest(price_rule, views_rule) AS value FROM measured WHERE metric = 'auc'""",
        ),
        "label_text": _with(
            _PRICE_RULE,
            """SELECT user_id, prediction,
  CASE WHEN prediction = 1 THEN 'Likely to Purchase' ELSE 'Not Likely to Purchase' END AS purchase_label
FROM price_rule""",
        ),
    }
