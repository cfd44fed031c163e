"""The registered queries in SQL, to check the Spark results against."""

from __future__ import annotations

from tallymill.functions.text import STOP_NAMES
from tallymill.sources.testviews import FIRST_DAY_DIGITS, VIEWS, sql_view


def _read(column: str) -> str:
    """The date of a delivered text."""
    return (
        f"CAST(try_strptime({column}, ['%Y-%m-%d', '%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S',"
        " '%Y%m%d']) AS DATE)"
    )


def _blank(column: str) -> str:
    return rf"CASE WHEN NOT regexp_matches({column}, '^\s*$') THEN {column} END AS {column}"


def _strip(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


_STOP = ", ".join(f"'{name}'" for name in STOP_NAMES)
_SALES = "transaction_id, customer_id, product_id"
_CUSTOMER = "customer_id, customer_name, email, city, state"
_PRODUCT = "product_id, product_name, category, brand, unit_price"
_FACT = "customer_id, product_id, date_id, quantity, unit_price"
_AMOUNTS = (
    "CAST(total_sale_amount AS DOUBLE) AS total_sale_amount, "
    "CAST(net_sale_amount AS DOUBLE) AS net_sale_amount"
)
_INGEST = "CAST(ingest_date AS VARCHAR) AS ingest_date"


def _half_up_cents(total: str, n: str) -> str:
    """Exact mean of decimal cents, halves away from zero."""
    cents = f"CAST(({total}) * 100 AS HUGEINT)"
    return (
        f"CAST(sign({cents}) * ((2 * abs({cents}) + ({n})) // (2 * ({n}))) AS DOUBLE) / 100"
    )


# --- the cleaning chain, one step per name; a check uses what it needs ---

CHAIN = {
    **{name: sql_view(name) for name in VIEWS if name.endswith("_stage")},
    "customers_norm": f"""
SELECT customer_id, {_blank('customer_name')}, {_blank('email')}, {_blank('city')},
  {_blank('state')}, {_blank('signup_date')}, ingest_date FROM customers_stage""",
    "products_norm": f"""
SELECT product_id, {_blank('product_name')}, {_blank('category')}, {_blank('brand')},
  unit_price, ingest_date FROM products_stage""",
    "sales_norm": f"""
SELECT {_SALES}, {_blank('transaction_date')}, quantity, unit_price, discount, ingest_date
FROM sales_transactions_stage""",
    "sales_priced": f"""
SELECT {_SALES}, transaction_date, quantity AS delivered, abs(coalesce(quantity, 0)) AS pieces,
  coalesce(nullif(abs(unit_price), 0), (SELECT median(unit_price) FROM sales_norm)) AS unit_price,
  discount, ingest_date FROM sales_norm""",
    "sales_num": f"""
SELECT {_SALES}, transaction_date, TRY_CAST(trunc(pieces) AS INTEGER) AS quantity, unit_price,
  discount, ingest_date, nullif(concat_ws(';',
    CASE WHEN pieces >= 2147483648 THEN 'quantity=' || CAST(delivered AS DECIMAL(38,2)) END,
    CASE WHEN pieces * unit_price >= 1e16
      THEN 'amount=' || CAST(pieces * unit_price AS DECIMAL(38,2)) END,
    CASE WHEN abs(pieces * unit_price - coalesce(discount, 0)) >= 1e16
      THEN 'net=' || CAST(pieces * unit_price - coalesce(discount, 0) AS DECIMAL(38,2)) END), '')
  AS misfit_values FROM sales_priced""",
    "products_num": """
SELECT product_id, product_name, category, brand,
  coalesce(nullif(abs(unit_price), 0),
    (SELECT median(nullif(abs(unit_price), 0)) FROM products_norm)) AS unit_price,
  ingest_date FROM products_norm""",
    "customers_ranked": f"""
SELECT * REPLACE (CAST(day AS VARCHAR) AS signup_date), row_number() OVER (
  PARTITION BY customer_id ORDER BY day DESC NULLS LAST, customer_name DESC NULLS LAST,
  email DESC NULLS LAST, city DESC NULLS LAST, state DESC NULLS LAST) AS rn
FROM (SELECT *, {_read('signup_date')} AS day FROM customers_norm)""",
    "products_named": f"""
SELECT *, coalesce(length(lower(product_name)) >= 4 AND lower(product_name) NOT IN ({_STOP})
  AND NOT regexp_matches(product_name, '^[0-9]+$'), false) AS is_valid_name
FROM (SELECT * REPLACE ({_strip('product_name')} AS product_name) FROM products_num)""",
    "products_ranked": """
SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY is_valid_name DESC,
  coalesce(unit_price, 0) > 0 DESC, category IS NOT NULL DESC, brand IS NOT NULL DESC,
  unit_price DESC NULLS LAST, product_name DESC NULLS LAST, category DESC NULLS LAST,
  brand DESC NULLS LAST) AS rn,
  bool_or(is_valid_name) OVER (PARTITION BY product_id) AS any_valid
FROM products_named""",
    "customers_clean": "SELECT * FROM customers_ranked WHERE rn = 1",
    "products_clean": "SELECT * FROM products_ranked WHERE rn = 1 AND is_valid_name",
    "sales_dated": f"""
SELECT * REPLACE ({_read('transaction_date')} AS transaction_date),
  transaction_date AS raw_transaction_date FROM sales_num""",
    "sales_classified": """
SELECT *, CASE WHEN transaction_date IS NULL THEN 'INVALID_DATE'
  WHEN quantity <= 0 OR unit_price <= 0 OR misfit_values IS NOT NULL THEN 'CORRUPT_VALUE'
  WHEN customer_id NOT IN (SELECT customer_id FROM customers_clean)
    OR product_id NOT IN (SELECT product_id FROM products_clean) THEN 'ORPHAN_KEY' END
  AS reject_reason
FROM sales_dated""",
    "customers_dim": """
SELECT customer_id, customer_name, lower(coalesce(email, 'unknown@example.com')) AS email,
  coalesce(city, (SELECT city FROM customers_clean WHERE city IS NOT NULL
    GROUP BY city ORDER BY count(*) DESC, city LIMIT 1)) AS city,
  upper(coalesce(state, (SELECT state FROM customers_clean WHERE state IS NOT NULL
    GROUP BY state ORDER BY count(*) DESC, state LIMIT 1))) AS state,
  coalesce(signup_date, '2024-01-01') AS signup_date FROM customers_clean""",
    "products_tidy": f"""
SELECT product_id, product_name, {_strip('category')} AS category, {_strip('brand')} AS brand,
  unit_price FROM products_clean""",
    "products_dim": """
SELECT product_id, lower(product_name) AS product_name,
  lower(coalesce(category, (SELECT category FROM products_tidy WHERE category IS NOT NULL
    GROUP BY category ORDER BY count(*) DESC, category LIMIT 1), 'unknown')) AS category,
  lower(coalesce(brand, (SELECT brand FROM products_tidy WHERE brand IS NOT NULL
    GROUP BY brand ORDER BY count(*) DESC, brand LIMIT 1), 'unknown')) AS brand,
  unit_price FROM products_tidy""",
    "sales_totals": """
SELECT *, round_even(quantity * unit_price * 100, 0) / 100 AS total
FROM sales_classified WHERE reject_reason IS NULL""",
    "facts": """
SELECT transaction_id, customer_id, product_id,
  CAST(strftime(transaction_date, '%Y%m%d') AS INTEGER) AS date_id, quantity, unit_price,
  CAST(total AS DECIMAL(18,2)) AS total_sale_amount,
  CAST(round_even((total - coalesce(discount, 0)) * 100, 0) / 100 AS DECIMAL(18,2))
    AS net_sale_amount
FROM sales_totals""",
}

STAR = {
    name: sql_view(name)
    for name in (
        "dim_customer",
        "dim_product",
        "dim_date",
        "fact_sales",
        "dirty_fact",
        "gapped_dim_date",
    )
}


def _with(steps: dict[str, str], query: str) -> str:
    names = ",\n".join(f"{name} AS ({text.strip()})" for name, text in steps.items())
    return f"WITH {names}\n{query.strip()}"


def _chain(query: str) -> str:
    return _with(CHAIN, query)


def _star(query: str) -> str:
    return _with(STAR, query)


def _top(table: str, key: str, label: str, amount: str, k: int) -> str:
    return _star(f"""
SELECT {key}, {label}, CAST(CAST(sum(coalesce(net_sale_amount, 0)) AS DECIMAL(18,2)) AS DOUBLE)
  AS {amount}
FROM fact_sales JOIN {table} USING ({key}) GROUP BY {key}, {label}
ORDER BY sum(coalesce(net_sale_amount, 0)) DESC, {key} LIMIT {k}""")


def _retained(same_period: str) -> str:
    return _star(f"""
, months AS (SELECT DISTINCT year, month, customer_id FROM fact_sales JOIN dim_date USING (date_id))
SELECT curr.year, curr.month, count(DISTINCT curr.customer_id) AS retained_customers
FROM months curr JOIN months prev ON curr.customer_id = prev.customer_id AND {same_period}
GROUP BY curr.year, curr.month""").replace(")\n, months", "),\nmonths", 1)


def _orphans(dimension: str, key: str, name: str) -> str:
    return _star(f"""
SELECT count(*) AS {name} FROM dirty_fact f LEFT JOIN {dimension} x ON f.{key} = x.{key}
WHERE x.{key} IS NULL""")


_DAY = "CAST(transaction_date AS VARCHAR) AS transaction_date"
_CLEAN_SALES = (
    f"{_SALES}, {_DAY}, quantity, unit_price, discount, {_INGEST}, raw_transaction_date"
)
_STAGED_SALES = f"{_SALES}, transaction_date, quantity, unit_price, discount, {_INGEST}"


def _on_day(table: str, day: int) -> str:
    key, digits = FIRST_DAY_DIGITS[table]
    return f"{key} % 10 {'<' if day == 1 else '>='} {digits}"


_FIRST_DAY = _on_day("sales_transactions_stage", 1)
_SECOND_DAY = _on_day("sales_transactions_stage", 2)



def _go(table: str) -> str:
    """1 for rows of the first day, 2 for those of the second."""
    key, digits = FIRST_DAY_DIGITS[table]
    return f"CAST(CASE WHEN {key} % 10 < {digits} THEN 1 ELSE 2 END AS INTEGER)"


def _accounts(key: str, loaded: str) -> str:
    """Delivered, misfit, rejected and loaded rows."""
    misfit = f"count(*) FILTER ({key} % 100 = 77)"
    return (
        f"count(*) + {misfit} AS delivered, {misfit} AS misfit, "
        f"count(*) FILTER (NOT ({loaded})) AS rejected, count(*) FILTER ({loaded}) AS loaded"
    )


def _constraints(table: str, key: str, new: str, loaded: str) -> str:
    named = f"SELECT '{table}' AS table_name, '{key}"
    of_fact = f"SELECT 'fact_sales', '{key}"
    return f"""{named} NOT NULL' AS constraint_name, count(*) FILTER ({key} IS NULL) AS violations FROM {new}
UNION ALL {named} UNIQUE', count(*) FROM (SELECT {key}, count(*) AS n FROM {new} WHERE {key} IS NOT NULL
  GROUP BY 1) WHERE n > 1 OR {key} IN (SELECT {key} FROM {loaded} WHERE {key} IS NOT NULL)
UNION ALL {of_fact} NOT NULL', count(*) FILTER ({key} IS NULL) FROM dirty_fact
UNION ALL {of_fact} REFERENCES {table}', count(*) FROM dirty_fact WHERE {key} IS NOT NULL
  AND {key} NOT IN (SELECT {key} FROM {new} WHERE {key} IS NOT NULL
  UNION SELECT {key} FROM {loaded} WHERE {key} IS NOT NULL)"""


def _audit(name: str, table: str, bad: str, day: int) -> str:
    return f"""
SELECT '{name}' AS pipeline_name, '2024-01-0{day} 00:00:00' AS last_processed_ingest_date,
  count(*) AS records_processed, count(*) FILTER ({bad}) AS records_rejected,
  count(*) FILTER (NOT ({bad})) AS records_loaded, 'SUCCESS' AS run_status,
  '2024-01-03 00:00:00' AS updated_at
FROM {table} WHERE {_on_day(table, day)}"""


def _schema_rows(table: str, source: str, columns: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{said}' AS finding, "
        + ("count(*)" if said == "missing" else f"count(*) FILTER ({c} IS NULL)")
        + f" AS null_count FROM {source}"
        for c, said in columns
    )


def _ok(*names: str) -> list[tuple[str, str]]:
    return [(n, "ok") for n in names]


ORACLES: dict[str, str] = {
    # reports
    "top_products_by_revenue": _top(
        "dim_product", "product_id", "product_name", "total_revenue", 10
    ),
    "top_customers_by_ltv": _top(
        "dim_customer", "customer_id", "customer_name", "lifetime_value", 5
    ),
    "monthly_revenue": _star("""
SELECT year, month, CAST(CAST(sum(coalesce(net_sale_amount, 0)) AS DECIMAL(18,2)) AS DOUBLE)
  AS monthly_revenue
FROM fact_sales JOIN dim_date USING (date_id) GROUP BY year, month"""),
    "avg_order_value": _star(f"""
SELECT customer_id, customer_name,
  {_half_up_cents('sum(coalesce(net_sale_amount, 0))', 'count(*)')} AS avg_order_value
FROM fact_sales JOIN dim_customer USING (customer_id) GROUP BY customer_id, customer_name"""),
    "category_revenue_share": _star("""
SELECT category, CAST(revenue AS DOUBLE) AS revenue,
  round(CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER () AS DOUBLE) * 100, 2) AS revenue_pct
FROM (SELECT category, CAST(sum(coalesce(net_sale_amount, 0)) AS DECIMAL(18,2)) AS revenue
  FROM fact_sales JOIN dim_product USING (product_id) GROUP BY category)"""),
    "customer_retention": _retained(
        "curr.year = prev.year AND curr.month = prev.month + 1"
    ),
    "customer_retention_fixed": _retained(
        "curr.year * 12 + curr.month = prev.year * 12 + prev.month + 1"
    ),
    "rolling_3_month_avg": _star(f"""
SELECT year, month, CAST(sales AS DOUBLE) AS monthly_sales,
  {_half_up_cents('sum(sales) OVER w', 'count(*) OVER w')} AS rolling_3_month_avg
FROM (SELECT year, month, CAST(sum(net_sale_amount) AS DECIMAL(18,2)) AS sales
  FROM fact_sales JOIN dim_date USING (date_id) GROUP BY year, month)
WINDOW w AS (ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""),
    "best_product_per_month": _star("""
SELECT year, month, product_name, CAST(revenue AS DOUBLE) AS revenue, CAST(rnk AS INTEGER) AS rnk
FROM (SELECT year, month, product_name, CAST(sum(net_sale_amount) AS DECIMAL(18,2)) AS revenue,
    rank() OVER (PARTITION BY year, month ORDER BY sum(net_sale_amount) DESC) AS rnk
  FROM fact_sales JOIN dim_date USING (date_id) JOIN dim_product USING (product_id)
  GROUP BY year, month, product_name)
WHERE rnk = 1"""),
    "declining_customers": _star("""
SELECT * FROM (
  SELECT customer_id, year, month, count(*) AS order_count,
    lag(count(*)) OVER (PARTITION BY customer_id ORDER BY year, month) AS prev_orders
  FROM fact_sales JOIN dim_date USING (date_id) GROUP BY customer_id, year, month)
WHERE prev_orders IS NOT NULL AND order_count < prev_orders"""),
    "revenue_by_day_type": _star("""
SELECT CASE WHEN weekday IN ('Saturday', 'Sunday') THEN 'Weekend' ELSE 'Weekday' END AS day_type,
  CAST(CAST(sum(coalesce(net_sale_amount, 0)) AS DECIMAL(18,2)) AS DOUBLE) AS total_revenue
FROM fact_sales JOIN dim_date USING (date_id) GROUP BY 1"""),
    # warehouse checks
    "orphan_fact_customers": _orphans("dim_customer", "customer_id", "orphan_customers"),
    "orphan_fact_products": _orphans("dim_product", "product_id", "orphan_products"),
    "orphan_fact_dates": _orphans("gapped_dim_date", "date_id", "orphan_dates"),
    "duplicate_fact_grain": _star("""
SELECT customer_id, product_id, date_id, count(*) AS duplicate_count
FROM fact_sales GROUP BY ALL HAVING count(*) > 1"""),
    "line_total_mismatch": _star(f"""
SELECT {_FACT}, {_AMOUNTS} FROM dirty_fact
WHERE total_sale_amount <> quantity * CAST(unit_price AS DECIMAL(18,2))"""),
    "total_reconciliation": _star("""
SELECT CAST(round(sum(CAST(quantity * unit_price AS DECIMAL(28,6))), 2) AS DOUBLE)
    AS recomputed_total,
  CAST(sum(total_sale_amount) AS DOUBLE) AS stored_total FROM dirty_fact"""),
    "discount_sanity": _star(f"""
SELECT {_FACT}, {_AMOUNTS} FROM dirty_fact
WHERE net_sale_amount > total_sale_amount OR net_sale_amount < 0"""),
    "not_null_violations": _with({**CHAIN, **STAR}, """
SELECT 'dim_customer' AS table_name, count(*) AS violations FROM customers_stage
  WHERE customer_id IS NULL
UNION ALL SELECT 'dim_product', count(*) FROM products_stage WHERE product_id IS NULL
UNION ALL SELECT 'dim_date', count(*) FROM dim_date WHERE date_id IS NULL"""),
    "unique_violations": _with({**CHAIN, **STAR}, """
SELECT 'dim_customer' AS table_name, CAST(customer_id AS BIGINT) AS key, count(*) AS occurrences
  FROM customers_stage GROUP BY customer_id HAVING count(customer_id) > 1
UNION ALL SELECT 'dim_product', CAST(product_id AS BIGINT), count(*)
  FROM products_stage GROUP BY product_id HAVING count(product_id) > 1
UNION ALL SELECT 'dim_date', CAST(date_id AS BIGINT), count(*)
  FROM dim_date GROUP BY date_id HAVING count(date_id) > 1"""),
    # staging checks
    "duplicate_customers": _chain(f"""
SELECT {_CUSTOMER}, signup_date, {_INGEST} FROM customers_stage WHERE customer_id IN
  (SELECT customer_id FROM customers_stage GROUP BY 1 HAVING count(customer_id) > 1)"""),
    "duplicate_products": _chain(f"""
SELECT {_PRODUCT}, {_INGEST} FROM products_stage WHERE product_id IN
  (SELECT product_id FROM products_stage GROUP BY 1 HAVING count(product_id) > 1)"""),
    "sales_by_transaction": _chain(
        f"SELECT {_STAGED_SALES} FROM sales_transactions_stage ORDER BY transaction_id"
    ),
    "duplicate_transactions": _chain("""
SELECT transaction_id, count(transaction_id) AS duplicate_tran FROM sales_transactions_stage
GROUP BY 1 HAVING count(transaction_id) > 1"""),
    "malformed_dates": _chain(rf"""
SELECT {_STAGED_SALES} FROM sales_transactions_stage WHERE transaction_date IS NULL OR NOT
  regexp_matches(transaction_date, '^\d{{4}}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$')"""),
    "rejected_union": _chain(f"""
SELECT CASE reject_reason WHEN 'INVALID_DATE' THEN 1 WHEN 'CORRUPT_VALUE' THEN 2 ELSE 3 END
    AS batch_idx, {_SALES}, {_DAY}, quantity, unit_price, discount, raw_transaction_date,
  reject_reason, coalesce(raw_transaction_date = 'NaT', false) AS is_nat_text
FROM sales_classified WHERE reject_reason IS NOT NULL"""),
    "date_issue_profile": _chain(rf"""
SELECT count(*) AS total_records,
  count(*) FILTER ({_read('d')} IS NULL) AS bad_dates,
  count(*) FILTER ({_read('d')} IS NOT NULL) AS good_dates,
  count(*) FILTER (d IS NULL) AS null_dates,
  count(*) FILTER (regexp_matches(d, '^\s*$')) AS empty_dates,
  count(*) FILTER ({_read('d')} IS NULL AND NOT regexp_matches(d, '^\s*$'))
    AS invalid_dates
FROM (SELECT transaction_date AS d FROM sales_transactions_stage)"""),
    "date_issue_sample": _chain(f"""
SELECT transaction_id, transaction_date, 'INVALID_DATE' AS date_issue_reason
FROM sales_transactions_stage WHERE {_read('transaction_date')} IS NULL
ORDER BY transaction_id NULLS LAST, transaction_date NULLS LAST LIMIT 5"""),
    "date_format_profile": _chain(f"""
SELECT CASE WHEN {_read('transaction_date')} IS NULL THEN 'unread'
  WHEN length(transaction_date) = 8 THEN 'compact' WHEN length(transaction_date) > 10 THEN 'timed'
  ELSE 'day' END AS date_format, count(*) AS dates
FROM sales_transactions_stage GROUP BY 1"""),
    "schema_report": _chain(
        " UNION ALL ".join(
            [
                _schema_rows(
                    "dim_customer",
                    "customers_stage",
                    _ok("customer_id", "customer_name", "email", "city", "state")
                    + [("signup_date", "type"), ("ingest_date", "extra")],
                ),
                _schema_rows(
                    "dim_product",
                    "products_stage",
                    _ok("product_id", "product_name", "category", "brand", "unit_price")
                    + [("ingest_date", "extra")],
                ),
                _schema_rows(
                    "fact_sales",
                    "sales_transactions_stage",
                    [("sales_id", "missing")]
                    + _ok("customer_id", "product_id")
                    + [("date_id", "missing"), ("quantity", "type")]
                    + _ok("unit_price")
                    + [("total_sale_amount", "missing"), ("net_sale_amount", "missing")]
                    + [
                        (c, "extra")
                        for c in ("transaction_id", "transaction_date", "discount", "ingest_date")
                    ],
                ),
            ]
        )
    ),
    # cleaning
    "normalized_customers": _chain(
        f"SELECT {_CUSTOMER}, signup_date, {_INGEST} FROM customers_norm"
    ),
    "normalized_products": _chain(f"SELECT {_PRODUCT}, {_INGEST} FROM products_norm"),
    "normalized_sales": _chain(f"SELECT {_STAGED_SALES} FROM sales_norm"),
    "clean_sales_numbers": _with(
        {**CHAIN, "sales_norm": "SELECT * FROM sales_transactions_stage"},
        f"SELECT {_STAGED_SALES}, misfit_values FROM sales_num",
    ),
    "clean_product_prices": _with(
        {**CHAIN, "products_norm": "SELECT * FROM products_stage"},
        f"SELECT {_PRODUCT}, {_INGEST} FROM products_num",
    ),
    "typed_staging": _chain("""
SELECT CAST(customer_id AS INTEGER) AS customer_id, customer_name,
  CAST(try_cast(signup_date AS TIMESTAMP) AS VARCHAR) AS signup_date FROM customers_norm"""),
    "imputed_transaction_dates": _chain(f"""
SELECT {_SALES}, CAST(coalesce({_read('transaction_date')},
    first_signup, DATE '2024-01-01') AS VARCHAR) AS transaction_date,
  quantity, unit_price, discount, {_INGEST}
FROM sales_norm LEFT JOIN (
  SELECT customer_id, min({_read('signup_date')}) AS first_signup
  FROM customers_norm GROUP BY customer_id) USING (customer_id)"""),
    # splits
    "customers_dedup_clean": _chain(
        f"SELECT {_CUSTOMER}, signup_date, {_INGEST} FROM customers_clean"
    ),
    "customers_dedup_rejected": _chain(f"""
SELECT {_CUSTOMER}, signup_date, {_INGEST}, 'DUPLICATE_CUSTOMER_ID' AS reject_reason
FROM customers_ranked WHERE rn > 1"""),
    "products_dedup_clean": _chain(f"""
SELECT product_id, product_name, {_strip('category')} AS category, {_strip('brand')} AS brand,
  unit_price, {_INGEST}, is_valid_name FROM products_clean"""),
    "products_dedup_rejected": _chain(f"""
SELECT {_PRODUCT}, {_INGEST}, is_valid_name,
  CASE WHEN any_valid THEN 'DUPLICATE_PRODUCT_ID' ELSE 'INVALID_PRODUCT_NAME' END AS reject_reason
FROM products_ranked WHERE NOT any_valid OR rn > 1"""),
    "valid_date_sales": _with(
        {**CHAIN, "sales_num": "SELECT * FROM sales_transactions_stage"},
        f"SELECT {_CLEAN_SALES} FROM sales_dated WHERE transaction_date IS NOT NULL",
    ),
    "invalid_date_sales": _with(
        {**CHAIN, "sales_num": "SELECT * FROM sales_transactions_stage"},
        f"SELECT {_CLEAN_SALES} FROM sales_dated WHERE transaction_date IS NULL",
    ),
    "corrupt_sales": _chain(
        f"SELECT {_CLEAN_SALES}, misfit_values FROM sales_classified WHERE reject_reason = 'CORRUPT_VALUE'"
    ),
    "multi_customer_transactions": _chain(f"""
SELECT {_STAGED_SALES} FROM sales_transactions_stage WHERE transaction_id IN
  (SELECT transaction_id FROM sales_transactions_stage GROUP BY 1
   HAVING count(DISTINCT customer_id) > 1)"""),
    "orphan_sales": _chain(
        f"SELECT {_CLEAN_SALES}, misfit_values FROM sales_classified WHERE reject_reason = 'ORPHAN_KEY'"
    ),
    # warehouse tables and loading
    "dim_customer": _chain("SELECT * FROM customers_dim"),
    "dim_product": _chain("SELECT * FROM products_dim"),
    "dim_date": _chain("""
SELECT DISTINCT CAST(strftime(transaction_date, '%Y%m%d') AS INTEGER) AS date_id,
  CAST(transaction_date AS VARCHAR) AS date, CAST(day(transaction_date) AS INTEGER) AS day,
  CAST(month(transaction_date) AS INTEGER) AS month,
  CAST(quarter(transaction_date) AS INTEGER) AS quarter,
  CAST(year(transaction_date) AS INTEGER) AS year, dayname(transaction_date) AS weekday
FROM sales_totals"""),
    "fact_sales": _chain(f"SELECT {_FACT}, {_AMOUNTS} FROM facts"),
    "new_dimension_rows": _chain(f"""
SELECT * FROM customers_dim d WHERE NOT EXISTS (
  SELECT 1 FROM customers_stage s
  WHERE s.customer_id = d.customer_id AND s.{_on_day('customers_stage', 1)})"""),
    "new_fact_rows": _chain(f"""
SELECT {_FACT}, {_AMOUNTS} FROM facts n WHERE {_SECOND_DAY} AND NOT EXISTS (
  SELECT 1 FROM facts o WHERE o.{_FIRST_DAY} AND o.customer_id = n.customer_id
    AND o.product_id = n.product_id AND o.date_id = n.date_id)"""),
    "incremental_extract": _chain(f"""
SELECT {_SALES}, transaction_date, quantity, unit_price, discount,
  '2024-01-02 00:00:00' AS ingest_date FROM sales_transactions_stage WHERE {_SECOND_DAY}"""),
    "audit_upsert": _chain(
        " UNION ALL ".join(
            [
                _audit("customers", "customers_stage", "email IS NULL", 1),
                _audit("products", "products_stage", "product_name IS NULL", 1),
                _audit("sales_etl", "sales_transactions_stage", "transaction_date IS NULL", 2),
            ]
        )
    ),
    "dq_report": _chain("""
, outcomes AS (
SELECT 'customers_stage' AS table_name, CASE rn WHEN 1 THEN 'load' ELSE 'customer_duplicates' END
  AS stage, CASE rn WHEN 1 THEN 'LOADED' ELSE 'DUPLICATE_CUSTOMER_ID' END AS reason
  FROM customers_ranked
UNION ALL SELECT 'products_stage',
  CASE WHEN any_valid AND rn = 1 THEN 'load' ELSE 'product_duplicates' END,
  CASE WHEN NOT any_valid THEN 'INVALID_PRODUCT_NAME' WHEN rn = 1 THEN 'LOADED'
    ELSE 'DUPLICATE_PRODUCT_ID' END
  FROM products_ranked
UNION ALL SELECT 'sales_transactions_stage', coalesce(lower(reject_reason), 'load'),
  coalesce(reject_reason, 'LOADED') FROM sales_classified)
SELECT '20240101_000000' AS run_id, table_name, stage, reason, count(*) AS row_count
FROM outcomes GROUP BY ALL""").replace(")\n, outcomes", "),\noutcomes", 1),
    "streamed_staging": _chain(f"""
SELECT 'customers_stage' AS table_name, customer_id AS row_key, customer_name AS text,
  city AS other, CAST(NULL AS DOUBLE) AS amount, {_go('customers_stage')} AS go FROM customers_stage
UNION ALL SELECT 'products_stage', product_id, product_name,
  CASE WHEN {_go('products_stage')} = 1 THEN brand END, unit_price, {_go('products_stage')}
  FROM products_stage
UNION ALL SELECT 'sales_transactions_stage', transaction_id, transaction_date, NULL, unit_price,
  {_go('sales_transactions_stage')} FROM sales_transactions_stage"""),
    "archived_files": _chain("""
SELECT 'customers_stage' AS table_name, count(*) AS delivered, CAST(0 AS BIGINT) AS misfit,
  true AS staged_are_archived, false AS files_left FROM customers_stage
UNION ALL SELECT 'products_stage', count(*), 0, true, false FROM products_stage
UNION ALL SELECT 'sales_transactions_stage', count(*), 0, true, true
  FROM sales_transactions_stage"""),
    "loaded_warehouse": _chain(f"""
SELECT {_FACT}, {_AMOUNTS}, (SELECT count(*) FROM facts) AS id_span FROM facts"""),
    # However late a feed is staged, the warehouse is the same.
    "late_feed_load": _chain("""
SELECT 'dim_customer' AS table_name, count(*) AS row_count,
  count(DISTINCT customer_id) AS distinct_keys, CAST(sum(customer_id) AS DOUBLE) AS total
  FROM customers_dim
UNION ALL SELECT 'dim_product', count(*), count(DISTINCT product_id),
  CAST(sum(product_id) AS DOUBLE) FROM products_dim
UNION ALL SELECT 'dim_date', count(DISTINCT date_id), count(DISTINCT date_id),
  CAST(sum(DISTINCT date_id) AS DOUBLE) FROM facts
UNION ALL SELECT 'fact_sales', count(*), count(*), CAST(sum(net_sale_amount) AS DOUBLE)
  FROM facts"""),
    "run_accounting": _chain(f"""
SELECT '20240101_000000' AS run_id, * FROM (
SELECT 1 AS load, 'customers_stage' AS table_name, {_accounts('customer_id', 'rn = 1')}
  FROM customers_ranked
UNION ALL SELECT 1, 'products_stage', {_accounts('product_id', 'any_valid AND rn = 1')}
  FROM products_ranked
UNION ALL SELECT 1, 'sales_transactions_stage', 0, 0, 0, 0
UNION ALL SELECT 2, 'customers_stage', 0, 0, 0, 0 UNION ALL SELECT 2, 'products_stage', 0, 0, 0, 0
UNION ALL SELECT 2, 'sales_transactions_stage',
  {_accounts('transaction_id', 'reject_reason IS NULL')} FROM sales_classified)"""),
    "constraint_gate": _with(
        {**CHAIN, **STAR},
        "\nUNION ALL ".join(
            _constraints(*names)
            for names in (
                ("dim_customer", "customer_id", "(SELECT nullif(customer_id, 5) AS customer_id FROM customers_stage)",
                 f"(SELECT customer_id FROM customers_stage s WHERE s.{_on_day('customers_stage', 1)})"),
                ("dim_product", "product_id", "products_stage",
                 f"(SELECT product_id FROM products_stage s WHERE s.{_on_day('products_stage', 1)})"),
                ("dim_date", "date_id", "gapped_dim_date", "(SELECT date_id FROM dim_date WHERE day <= 2)"),
            )
        ),
    ),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
