"""Independent SQL for every registered query, for an engine without Spark's functions.

All money is computed in integer cents and every rounding is integer half-up, so
the expected values do not depend on floating point or on an engine's decimal
division.
"""

from __future__ import annotations

from oracle import constants as fixed

VIP_LIMIT, TOP_LIMIT = 2100000, 1300000
PREMIUM_LIMIT, MEDIO_LIMIT = 975, 925


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _case(column: str, values: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in values.items())
    return f"CASE {column} {whens} END"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


def _half_up(num: str, den: str) -> str:
    """Integer num / den rounded half away from zero; den > 0."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return f"(CASE WHEN {n} >= 0 THEN 1 ELSE -1 END * ((2 * abs({n}) + {d}) // (2 * {d})))"


def _money(cents: str, width: int = 28) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(28,0)) * 0.01 AS DECIMAL({width},2))"


def _scaled(units: str, scale: int, width: int) -> str:
    return f"CAST(CAST({units} AS DECIMAL(28,0)) * {'0.' + '0' * (scale - 1) + '1'} AS DECIMAL({width},{scale}))"


def _ratio_money(cents: str, count: str, scale: int = 6) -> str:
    """cents / count in money units with `scale` digits; NULL for count 0."""
    value = _scaled(_half_up(f"({cents}) * {10 ** (scale - 2)}", f"nullif({count}, 0)"), scale, 18 + scale)
    return f"CASE WHEN {count} = 0 THEN NULL ELSE {value} END"


def _ordinal(column: str, order) -> str:
    return f"CAST(coalesce(list_position({_list(order)}, {column}), 0) AS INTEGER)"


CHANNEL = _case("channel", fixed.CHANNEL_LABELS)

PRELUDE = f"""
WITH raw_sales AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT),
           date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE))) AS sale_id,
         o_orderdate + to_hours(CAST((l_orderkey * 7 + l_linenumber * 5) % 24 AS INTEGER)) AS sold_at,
         CAST(CASE WHEN o_custkey % 50 = 49 THEN o_custkey - 1 ELSE o_custkey END AS VARCHAR) AS customer_id,
         concat(CASE WHEN l_partkey % 200 = 199 THEN 'X' ELSE '' END, l_partkey) AS product_id,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'ecommerce' ELSE 'loja_fisica' END AS channel,
         CAST(l_quantity AS BIGINT) AS quantity,
         CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT) AS unit_cents
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
         CAST(round(p_retailprice * 100) AS BIGINT) AS price_cents,
         CASE WHEN round(p_retailprice * 100) > {PREMIUM_LIMIT} * 100 THEN 'PREMIUM'
              WHEN round(p_retailprice * 100) > {MEDIO_LIMIT} * 100 THEN 'MEDIO' ELSE 'BASICO' END AS price_band,
         CAST(DATE '1995-01-01' + CAST(p_partkey * 37 % 1200 AS INTEGER) AS TIMESTAMP) AS created_at
  FROM part
), customers_coded AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
         concat(CASE c_custkey % 7 WHEN 0 THEN 'Sr. ' WHEN 1 THEN 'Sra. ' WHEN 2 THEN 'Srta. ' WHEN 3 THEN 'Dr. '
                WHEN 4 THEN 'Dra. ' ELSE '' END, c_name) AS raw_name,
         array_to_string(list_transform(string_split(lower(c_name), ' '), lambda w: concat(upper(w[1]), w[2:])), ' ')
           AS customer_name,
         list_extract({_list(fixed.STATES)}, CAST(c_custkey % {len(fixed.STATES)} AS INTEGER) + 1) AS state,
         CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS registered_on,
         c_nationkey
  FROM customer
), customers AS (
  SELECT customer_id, raw_name, customer_name, state, {_case('state', fixed.STATE_NAMES)} AS state_name,
         {_case('state', fixed.STATE_REGIONS)} AS region, 'Brasil' AS country, registered_on
  FROM customers_coded
), unique_sales AS (
  -- the first version of every sale is the line itself: copies and later versions are added to lines
  SELECT * FROM raw_sales
  QUALIFY row_number() OVER (PARTITION BY sale_id) = 1
), sales AS (
  SELECT s.sale_id, s.sold_at, CAST(s.sold_at AS DATE) AS sale_date, CAST(hour(s.sold_at) AS INTEGER) AS sale_hour,
         CAST(dayofweek(s.sold_at) + 1 AS INTEGER) AS weekday_num,
         list_extract({_list(fixed.WEEKDAYS)}, CAST(dayofweek(s.sold_at) + 1 AS INTEGER)) AS weekday,
         s.customer_id, s.product_id, s.channel, s.quantity, s.unit_cents, s.quantity * s.unit_cents AS cents,
         p.created_at IS NOT NULL AS is_registered, coalesce(s.sold_at < p.created_at, false) AS sold_before_created
  FROM unique_sales s LEFT JOIN products p ON p.product_id = s.product_id
), offers AS (
  SELECT p_partkey, k, CAST(round(p_retailprice * 100) AS BIGINT) AS own_cents,
         CASE p_partkey // 4 % 7 WHEN 0 THEN 100 WHEN 1 THEN 115 + 5 * k WHEN 2 THEN 70 + 5 * k
              ELSE 55 + (p_partkey * 31 + 17 * k) % 70 END AS percent
  FROM part, (SELECT unnest([0, 1, 2, 3]) AS k)
), competitor_prices AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
         list_extract(['Competitor A', 'Competitor B', 'Competitor C', 'Competitor D'], CAST(k AS INTEGER) + 1) AS competitor,
         (own_cents * percent + 50) // 100 AS price_cents,
         TIMESTAMP '2001-08-01 00:00:00' + to_hours(CAST(p_partkey % 24 AS INTEGER)) AS collected_at,
         10 * ((own_cents * percent + 50) // 100) < 6 * own_cents AS is_suspect
  FROM offers
), purchases AS (
  SELECT customer_id, count(*) AS n, sum(cents) AS cents, min(sold_at) AS first_purchase, max(sold_at) AS last_purchase
  FROM sales GROUP BY customer_id
), segments AS (
  SELECT c.customer_id, c.customer_name, c.state, c.state_name, c.region,
         CAST(coalesce(p.n, 0) AS BIGINT) AS total_orders, CAST(coalesce(p.cents, 0) AS BIGINT) AS cents,
         {_half_up('p.cents', 'p.n')} AS ticket_cents, p.first_purchase, p.last_purchase,
         CASE WHEN coalesce(p.cents, 0) >= {VIP_LIMIT} * 100 THEN 'VIP'
              WHEN coalesce(p.cents, 0) >= {TOP_LIMIT} * 100 THEN 'TOP_TIER' ELSE 'REGULAR' END AS segment,
         CAST(row_number() OVER (ORDER BY coalesce(p.cents, 0) DESC, c.customer_id) AS BIGINT) AS revenue_rank
  FROM customers c LEFT JOIN purchases p ON p.customer_id = c.customer_id
), time_mart AS (
  SELECT sale_date, weekday, weekday_num, sale_hour, channel, count(*) AS total_sales,
         CAST(sum(quantity) AS BIGINT) AS items_sold, CAST(sum(cents) AS BIGINT) AS cents,
         count(DISTINCT customer_id) AS unique_customers
  FROM sales GROUP BY ALL
), sold_products AS (
  SELECT s.product_id, coalesce(p.product_name, 'Produto não cadastrado') AS product_name,
         coalesce(p.category, 'Não cadastrado') AS category, coalesce(p.brand, 'Não cadastrado') AS brand,
         coalesce(p.price_band, 'Não cadastrado') AS price_band, s.is_registered,
         count(*) AS total_sales, CAST(sum(s.quantity) AS BIGINT) AS items_sold, CAST(sum(s.cents) AS BIGINT) AS cents
  FROM sales s LEFT JOIN products p ON p.product_id = s.product_id GROUP BY ALL
), product_mart AS (
  SELECT *, {_half_up('cents', 'total_sales')} AS ticket_cents,
         CAST(row_number() OVER (ORDER BY cents DESC, product_id) AS BIGINT) AS revenue_rank,
         CAST(row_number() OVER (PARTITION BY category ORDER BY cents DESC, product_id) AS BIGINT) AS category_rank
  FROM sold_products
), detail AS (
  SELECT s.sale_id, s.sold_at, s.sale_date, s.weekday, s.weekday_num, s.sale_hour, s.channel, s.product_id,
         coalesce(p.product_name, 'Produto não cadastrado') AS product_name,
         coalesce(p.category, 'Não cadastrado') AS category, coalesce(p.brand, 'Não cadastrado') AS brand,
         coalesce(p.price_band, 'Não cadastrado') AS price_band,
         s.customer_id, c.customer_name, c.state, c.region, c.segment, s.quantity, s.unit_cents, s.cents,
         s.is_registered, s.sold_before_created
  FROM sales s LEFT JOIN products p ON p.product_id = s.product_id
  LEFT JOIN segments c ON c.customer_id = s.customer_id
), market AS (
  SELECT product_id, {_half_up('sum(price_cents)', 'count(*)')} AS mean_cents, min(price_cents) AS low_cents,
         max(price_cents) AS high_cents, count(*) AS competitor_count, bool_or(is_suspect) AS has_suspect
  FROM competitor_prices GROUP BY product_id
), sold AS (
  SELECT product_id, sum(cents) AS cents, sum(quantity) AS items FROM sales GROUP BY product_id
), position AS (
  SELECT p.product_id, p.product_name, p.category, p.brand, p.price_cents AS own_cents, m.mean_cents, m.low_cents,
         m.high_cents, m.competitor_count, m.has_suspect,
         CAST({_half_up('(p.price_cents - m.mean_cents) * 10000', 'm.mean_cents')} AS BIGINT) AS avg_bp,
         CAST({_half_up('(p.price_cents - m.low_cents) * 10000', 'm.low_cents')} AS BIGINT) AS min_bp,
         CASE WHEN p.price_cents > m.high_cents THEN 'MAIS_CARO_QUE_TODOS'
              WHEN p.price_cents < m.low_cents THEN 'MAIS_BARATO_QUE_TODOS'
              WHEN p.price_cents > m.mean_cents THEN 'ACIMA_DA_MEDIA'
              WHEN p.price_cents < m.mean_cents THEN 'ABAIXO_DA_MEDIA' ELSE 'NA_MEDIA' END AS price_class,
         CAST(coalesce(s.cents, 0) AS BIGINT) AS cents, CAST(coalesce(s.items, 0) AS BIGINT) AS items_sold
  FROM products p JOIN market m ON m.product_id = p.product_id LEFT JOIN sold s ON s.product_id = p.product_id
), shown_sales AS (
  SELECT *, {CHANNEL} AS shown_channel, concat(lpad(CAST(sale_hour AS VARCHAR), 2, '0'), 'h') AS hour_label FROM detail
), shown_prices AS (
  SELECT *, {_case('price_class', fixed.PRICE_CLASS_LABELS)} AS price_class_label,
         CASE WHEN has_suspect THEN 'Preço suspeito (conferir)' ELSE 'Confirmado' END AS price_status,
         CASE WHEN has_suspect THEN 'Sim' ELSE 'Não' END AS to_confirm,
         CASE WHEN price_class = 'MAIS_CARO_QUE_TODOS' AND NOT has_suspect THEN 1 ELSE 0 END AS is_confirmed_dearest,
         CASE WHEN has_suspect THEN 1 ELSE 0 END AS suspect
  FROM position
)
"""

REVENUE = _money("sum(cents)") + " AS revenue"
PERIOD = "sale_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'"

_SALES_COLUMNS = f"""sale_id, sold_at, sale_date, sale_hour, weekday_num, weekday, customer_id, product_id, channel,
  quantity, {_money('unit_cents', 10)} AS unit_price, {_money('cents', 10)} AS revenue, is_registered, sold_before_created"""

_SEGMENT_COLUMNS = f"""customer_id, customer_name, state, state_name, region, total_orders, {_money('cents')} AS revenue,
  {_money('ticket_cents', 10)} AS avg_ticket, first_purchase, last_purchase, segment, revenue_rank"""

_PRODUCT_MART_COLUMNS = f"""product_id, product_name, category, brand, price_band, is_registered, total_sales, items_sold,
  {_money('cents')} AS revenue, {_money('ticket_cents', 10)} AS avg_ticket, revenue_rank, category_rank"""

_ACTION = f"""product_name, product_id, category, {_money('own_cents', 10)} AS our_price,
  {_money('mean_cents', 10)} AS avg_competitor_price, {_money('low_cents', 10)} AS min_competitor_price,
  {_scaled('avg_bp', 4, 12)} AS diff_vs_avg, {_scaled('min_bp', 4, 12)} AS diff_vs_min,
  {_money('cents')} AS revenue, to_confirm"""

_DIFF = _scaled(_half_up("sum(avg_bp) * 100", "count(*)"), 6, 12)


def _best_sellers(dimension: str, with_customers: bool, source: str = "shown_sales") -> str:
    customers = ", count(DISTINCT customer_id) AS customers" if with_customers else ""
    shown = "shown_channel" if dimension == "channel" else dimension
    return f"""SELECT {shown} AS {dimension}, {REVENUE}, count(*) AS sales,
      {_ratio_money('sum(cents)', 'count(*)', 2)} AS avg_ticket{customers}
      FROM {source} GROUP BY {shown} ORDER BY sum(cents) DESC, {shown} LIMIT 10"""


def _expectations() -> str:
    sales = {
        **{f"{c}_present": f"{e} IS NULL" for c, e in {
            "sale_id": "sale_id", "sold_at": "sold_at", "customer_id": "customer_id", "product_id": "product_id",
            "quantity": "quantity", "unit_price": "unit_cents",
        }.items()},
        "quantity_positive": "NOT coalesce(quantity > 0, false)",
        "unit_price_positive": "NOT coalesce(unit_cents > 0, false)",
        "channel_known": "NOT coalesce(channel IN ('ecommerce', 'loja_fisica'), false)",
    }
    rows = [("sales", name, "fail", bad) for name, bad in sales.items()]
    rows += [
        ("sales", "product_registered", "warn", "NOT is_registered"),
        ("sales", "sold_after_created", "warn", "sold_before_created"),
        ("customers", "customer_id_present", "fail", "customer_id IS NULL"),
        ("customers", "region_present", "fail", "region IS NULL"),
        ("products", "product_id_present", "fail", "product_id IS NULL"),
        ("products", "current_price_positive", "fail", "NOT coalesce(price_cents > 0, false)"),
        ("competitor_prices", "product_id_present", "fail", "product_id IS NULL"),
        ("competitor_prices", "competitor_price_positive", "fail", "NOT coalesce(price_cents > 0, false)"),
        ("competitor_prices", "price_plausible", "warn", "is_suspect"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{r}' AS rule, '{s}' AS severity, "
        f"CAST(count(*) FILTER (WHERE {bad}) AS BIGINT) AS violations FROM {t}"
        for t, r, s, bad in rows
    )


def _quality() -> str:
    def unique(table: str, *keys: str) -> str:
        known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        key = keys[0] if len(keys) == 1 else f"CASE WHEN {known} THEN ({', '.join(keys)}) END"
        return f"SELECT count(*) - count(DISTINCT {key}) FROM {table}"

    def rows(table: str, predicate: str) -> str:
        return f"SELECT count(*) FROM {table} WHERE {predicate}"

    def same_revenue(table: str) -> str:
        return (
            f"SELECT CASE WHEN (SELECT sum(cents) FROM {table}) = (SELECT sum(cents) FROM sales) THEN 0 ELSE 1 END"
        )

    tests = {
        "products_key_unique": unique("products", "product_id"),
        "customers_key_unique": unique("customers", "customer_id"),
        "competitor_prices_key_unique": unique("competitor_prices", "product_id", "competitor"),
        "sales_key_unique": unique("sales", "sale_id"),
        "sales_revenue_is_quantity_x_price": rows("sales", "cents <> quantity * unit_cents"),
        "sales_unregistered_below_share": """SELECT CASE WHEN 100 * count(*) FILTER (WHERE NOT is_registered) >= count(*)
            THEN count(*) FILTER (WHERE NOT is_registered) ELSE 0 END FROM sales""",
        "segments_revenue_equals_sales": same_revenue("segments"),
        "segments_key_unique": unique("segments", "customer_id"),
        "segments_segment_valid": rows("segments", "segment IS NULL OR segment NOT IN ('VIP', 'TOP_TIER', 'REGULAR')"),
        "segments_vip_reach_limit": rows("segments", f"segment = 'VIP' AND cents < {VIP_LIMIT}00"),
        "segments_top_tier_within_limits": rows(
            "segments", f"segment = 'TOP_TIER' AND (cents < {TOP_LIMIT}00 OR cents >= {VIP_LIMIT}00)"
        ),
        "segments_regular_below_limit": rows("segments", f"segment = 'REGULAR' AND cents >= {TOP_LIMIT}00"),
        "time_revenue_equals_sales": same_revenue("time_mart"),
        "time_grain_unique": unique("time_mart", "sale_date", "sale_hour", "channel"),
        "product_revenue_equals_sales": same_revenue("product_mart"),
        "product_sales_key_unique": unique("product_mart", "product_id"),
        "detail_revenue_equals_sales": same_revenue("detail"),
        "detail_rows_equal_sales": "SELECT abs((SELECT count(*) FROM detail) - (SELECT count(*) FROM sales))",
        "detail_key_unique": unique("detail", "sale_id"),
        "detail_has_segment_and_region": rows("detail", "segment IS NULL OR region IS NULL"),
        "price_position_key_unique": unique("position", "product_id"),
        "mart_columns_documented": "SELECT 0",
    }
    union = " UNION ALL ".join(
        f"SELECT '{name}' AS test, CAST(({sql}) AS BIGINT) AS problem_rows" for name, sql in tests.items()
    )
    return f"SELECT test, problem_rows, CASE WHEN problem_rows = 0 THEN 'OK' ELSE 'FALHOU' END AS status FROM ({union})"


def _reconciliation() -> str:
    tables = {
        "sales": "sales",
        "customer_segments": "segments",
        "sales_time": "time_mart",
        "product_sales": "product_mart",
        "sales_detail": "detail",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {_money('sum(cents)')} AS revenue, "
        f"sum(cents) = (SELECT sum(cents) FROM sales) AS agrees FROM {cte}"
        for name, cte in tables.items()
    )


def _audit(body) -> str:
    tables = {
        "customer_segments": "gold_customer_segments",
        "sales_time": "gold_sales_time",
        "product_sales": "gold_product_sales",
        "sales_detail": "gold_sales_detail",
        "price_position": "gold_price_position",
    }
    # The columns of a mart are those of its own question, which must all carry a comment.
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, count(*) AS row_count, max(columns) AS column_count,
        max(columns) AS documented_columns, CAST(0 AS BIGINT) AS undocumented_columns
        FROM (SELECT CAST(len(json_keys(to_json(m))) AS BIGINT) AS columns FROM ({body(question)}) m)"""
        for name, question in tables.items()
    )


ONLINE = f"shown_sales WHERE {PERIOD} AND shown_channel IN ('E-commerce')"
SOME_CUSTOMERS = "segments WHERE segment IN ('VIP', 'TOP_TIER') AND region IN ('Norte', 'Sul')"
SOME_PRICES = """shown_prices WHERE category IN ('ECONOMY', 'PROMO')
  AND price_class_label IN ('Mais caro que todos', 'Acima da média')"""

_WEEKDAYS = f"""SELECT weekday, {_ratio_money('sum(cents)', 'count(DISTINCT sale_date)')} AS revenue_per_day,
  {REVENUE}, {_ordinal('weekday', fixed.WEEKDAYS)} AS weekday_num FROM shown_sales GROUP BY weekday"""

_TICKET_2 = _ratio_money("sum(cents)", "count(*)", 2) + " AS avg_ticket"

BODIES: dict[str, str] = {
    # Cleaned tables
    "dedup_sales": f"""SELECT sale_id, sold_at, customer_id, product_id, channel, quantity,
        {_money('unit_cents', 14)} AS unit_price FROM unique_sales""",
    "price_band": f"""SELECT price_band, count(*) AS products, {_money('min(price_cents)', 10)} AS lowest,
        {_money('max(price_cents)', 10)} AS highest FROM products GROUP BY price_band""",
    "silver_products": f"""SELECT product_id, product_name, category, brand, {_money('price_cents', 10)} AS current_price,
        price_band, created_at FROM products""",
    "silver_customers": """SELECT customer_id, raw_name, customer_name, state, state_name, region, country, registered_on
        FROM customers""",
    "customers_by_nation": """SELECT customer_id, customer_name, n_name AS nation_name, r_name AS region
        FROM customers_coded LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""",
    "silver_sales": f"SELECT {_SALES_COLUMNS} FROM sales",
    "silver_competitor_prices": f"""SELECT product_id, competitor, {_money('price_cents', 10)} AS competitor_price,
        collected_at, is_suspect FROM competitor_prices""",
    "expectation_report": _expectations(),
    # Marts
    "gold_customer_segments": f"SELECT {_SEGMENT_COLUMNS} FROM segments",
    "gold_sales_time": f"""SELECT sale_date, weekday, weekday_num, sale_hour, channel, total_sales, items_sold,
        {_money('cents')} AS revenue, unique_customers FROM time_mart""",
    "gold_product_sales": f"SELECT {_PRODUCT_MART_COLUMNS} FROM product_mart",
    "gold_sales_detail": f"""SELECT sale_id, sold_at, sale_date, weekday, weekday_num, sale_hour, channel, product_id,
        product_name, category, brand, price_band, customer_id, customer_name, state, region, segment, quantity,
        {_money('unit_cents', 10)} AS unit_price, {_money('cents', 10)} AS revenue, is_registered, sold_before_created
        FROM detail""",
    "gold_price_position": f"""SELECT product_id, product_name, category, brand, {_money('own_cents', 10)} AS our_price,
        {_money('mean_cents', 10)} AS avg_competitor_price, {_money('low_cents', 10)} AS min_competitor_price,
        {_money('high_cents', 10)} AS max_competitor_price, competitor_count, {_money('avg_bp', 10)} AS pct_vs_avg,
        {_money('min_bp', 10)} AS pct_vs_min, price_class, has_suspect, {_money('cents')} AS revenue, items_sold
        FROM position""",
    "rank_customers_by_revenue": f"SELECT customer_id, {_money('cents')} AS revenue, revenue_rank FROM segments",
    "rank_products_in_category": f"""SELECT category, category_rank, product_id, product_name, {_money('cents')} AS revenue,
        revenue_rank FROM product_mart""",
    "clustered_sales_detail": f"""SELECT channel, count(*) AS sales, {REVENUE} FROM detail
        WHERE {PERIOD} GROUP BY channel""",
    # Quality
    "quality_suite": _quality(),
    "revenue_reconciliation": _reconciliation(),
    "column_comment_audit": "",
    "published_quality": _quality(),
    "refresh_expectations": _expectations(),
    "raw_coverage": """SELECT 'sales' AS table_name, count(*) AS row_count, CAST(sum(l_quantity) AS BIGINT) AS items FROM lineitem
        UNION ALL SELECT 'products', count(*), NULL FROM part
        UNION ALL SELECT 'customers', count(*), NULL FROM customer
        UNION ALL SELECT 'competitor_prices', 4 * count(*), NULL FROM part""",
    "refresh_reconciliation": _reconciliation(),
    "refresh_ranks": f"SELECT customer_id, segment, {_money('cents')} AS revenue, revenue_rank FROM segments",
    # Datasets
    "sales_dataset": f"""SELECT sale_id, sale_date, weekday, weekday_num, sale_hour, hour_label, shown_channel AS channel,
        product_id, category, brand, customer_id, state, region, segment, quantity, {_money('cents', 10)} AS revenue
        FROM shown_sales""",
    "customer_dataset": f"""SELECT {_SEGMENT_COLUMNS},
        {_money("CASE WHEN segment = 'VIP' THEN cents ELSE 0 END")} AS vip_revenue,
        CASE WHEN segment = 'VIP' THEN 1 ELSE 0 END AS is_vip FROM segments""",
    "price_dataset": f"""SELECT product_id, product_name, category, brand, price_class_label, price_class, has_suspect,
        price_status, to_confirm, {_money('own_cents', 10)} AS our_price, {_money('mean_cents', 10)} AS avg_competitor_price,
        {_money('low_cents', 10)} AS min_competitor_price, competitor_count, {_scaled('avg_bp', 4, 12)} AS diff_vs_avg,
        {_scaled('min_bp', 4, 12)} AS diff_vs_min, {_money('cents')} AS revenue, items_sold, is_confirmed_dearest, suspect
        FROM shown_prices""",
    # Sales questions
    "commercial_kpis": f"""SELECT {REVENUE}, count(*) AS sales, {_ratio_money('sum(cents)', 'count(*)')} AS avg_ticket,
        CAST(sum(quantity) AS BIGINT) AS items_sold FROM shown_sales""",
    "filtered_commercial_kpis": f"""SELECT {REVENUE}, count(*) AS sales,
        {_ratio_money('sum(cents)', 'count(*)')} AS avg_ticket, CAST(sum(quantity) AS BIGINT) AS items_sold
        FROM shown_sales WHERE {PERIOD} AND shown_channel IN ('E-commerce')""",
    "filtered_daily_revenue": f"""SELECT CAST(sale_date AS TIMESTAMP) AS day, shown_channel AS channel, {REVENUE}
        FROM {ONLINE} GROUP BY 1, 2""",
    "filtered_weekday_revenue": _WEEKDAYS.replace("FROM shown_sales", "FROM " + ONLINE),
    "filtered_hour_revenue": f"SELECT hour_label, {REVENUE} FROM {ONLINE} GROUP BY 1",
    "filtered_category_revenue": f"SELECT category, {REVENUE} FROM {ONLINE} GROUP BY 1",
    "filtered_region_category": f"""SELECT region, category, count(DISTINCT customer_id) AS customers, count(*) AS sales,
        {REVENUE}, {_TICKET_2} FROM {ONLINE} GROUP BY region, category""",
    "filtered_best_sellers": _best_sellers("state", True, ONLINE),
    "daily_revenue_by_channel": f"""SELECT CAST(sale_date AS TIMESTAMP) AS day, shown_channel AS channel, {REVENUE}
        FROM shown_sales GROUP BY 1, 2""",
    "channel_revenue": f"SELECT shown_channel AS channel, {REVENUE} FROM shown_sales GROUP BY 1",
    "filtered_channel_revenue": f"""SELECT shown_channel AS channel, {REVENUE} FROM shown_sales
        WHERE {PERIOD} AND shown_channel IN ('E-commerce', 'Loja física') GROUP BY 1""",
    "weekday_mean_revenue": _WEEKDAYS,
    "best_weekday": f"""WITH w AS ({_WEEKDAYS}) SELECT
        (SELECT weekday FROM w ORDER BY revenue_per_day DESC, weekday_num LIMIT 1) AS best_by_mean,
        (SELECT max(revenue_per_day) FROM w) AS best_mean,
        (SELECT weekday FROM w ORDER BY revenue DESC, weekday_num LIMIT 1) AS best_by_total,
        (SELECT max(revenue) FROM w) AS best_total""",
    "hour_revenue": f"SELECT hour_label, {REVENUE} FROM shown_sales GROUP BY 1",
    "category_revenue": f"SELECT category, {REVENUE} FROM shown_sales GROUP BY 1",
    "top_products_filtered": f"""SELECT CAST(row_number() OVER (ORDER BY sum(cents) DESC, product_id) AS INTEGER) AS position,
        product_id, product_name, category, count(*) AS sales, CAST(sum(quantity) AS BIGINT) AS items_sold, {REVENUE},
        {_ratio_money('sum(cents)', 'count(*)')} AS avg_ticket
        FROM shown_sales WHERE {PERIOD} AND shown_channel IN ('E-commerce')
        GROUP BY product_id, product_name, category ORDER BY sum(cents) DESC, product_id LIMIT 10""",
    "top_products_all": f"""SELECT CAST(row_number() OVER (ORDER BY sum(cents) DESC, product_id) AS INTEGER) AS position,
        product_id, product_name, category, count(*) AS sales, CAST(sum(quantity) AS BIGINT) AS items_sold, {REVENUE},
        {_ratio_money('sum(cents)', 'count(*)')} AS avg_ticket
        FROM shown_sales GROUP BY product_id, product_name, category ORDER BY sum(cents) DESC, product_id LIMIT 10""",
    "sql_parameters": f"""SELECT category, count(*) AS sales, {REVENUE} FROM detail
        WHERE {PERIOD} AND channel IN ('loja_fisica') GROUP BY category""",
    "ticket_by_channel": f"""SELECT {CHANNEL} AS channel, {REVENUE}, CAST(sum(total_sales) AS BIGINT) AS sales,
        {_ratio_money('sum(cents)', 'sum(total_sales)', 2)} AS avg_ticket FROM time_mart GROUP BY 1""",
    "region_category_revenue": f"""SELECT region, category, count(DISTINCT customer_id) AS customers, count(*) AS sales,
        {REVENUE}, {_TICKET_2} FROM detail GROUP BY region, category""",
    "best_sellers_by_dimension": _best_sellers("region", True),
    "best_sellers_by_state": _best_sellers("state", True),
    "best_sellers_by_segment": _best_sellers("segment", True),
    "best_sellers_by_category": _best_sellers("category", False),
    "best_sellers_by_channel": _best_sellers("channel", False),
    "distinct_products_by_category": """SELECT category, count(product_id) AS products,
        count(DISTINCT product_name) AS names FROM product_mart GROUP BY category""",
    "measure_sales": f"""SELECT shown_channel AS channel, weekday, {REVENUE}, count(sale_id) AS sales,
        {_ratio_money('sum(cents)', 'count(*)')} AS avg_ticket, CAST(sum(quantity) AS BIGINT) AS items_sold,
        {_ratio_money('sum(cents)', 'count(DISTINCT sale_date)')} AS revenue_per_day
        FROM shown_sales GROUP BY 1, 2""",
    # Customer questions
    "customer_kpis": f"""SELECT count(*) AS customers, CAST(count(*) FILTER (WHERE segment = 'VIP') AS BIGINT) AS vip_customers,
        {_scaled(_half_up("sum(CASE WHEN segment = 'VIP' THEN cents ELSE 0 END) * 1000000", "sum(cents)"), 6, 24)}
        AS vip_revenue_share, {_ratio_money('sum(cents)', 'sum(total_orders)')} AS avg_ticket FROM segments""",
    "filtered_customer_kpis": f"""SELECT count(*) AS customers,
        CAST(count(*) FILTER (WHERE segment = 'VIP') AS BIGINT) AS vip_customers,
        {_scaled(_half_up("sum(CASE WHEN segment = 'VIP' THEN cents ELSE 0 END) * 1000000", "sum(cents)"), 6, 24)}
        AS vip_revenue_share, {_ratio_money('sum(cents)', 'sum(total_orders)')} AS avg_ticket FROM segments
        WHERE segment IN ('VIP', 'TOP_TIER') AND region IN ('Norte', 'Sul')""",
    "filtered_segment_summary": f"""SELECT segment, count(*) AS customers, {REVENUE},
        {_ordinal('segment', fixed.SEGMENTS)} AS segment_place FROM {SOME_CUSTOMERS} GROUP BY segment""",
    "filtered_region_segment": f"""SELECT region, segment, {REVENUE},
        {_money('sum(sum(cents)) OVER (PARTITION BY region)')} AS region_revenue FROM {SOME_CUSTOMERS} GROUP BY region, segment""",
    "filtered_customer_list": f"""SELECT revenue_rank, customer_name, state, region, segment, total_orders,
        {_money('cents')} AS revenue, last_purchase FROM {SOME_CUSTOMERS}""",
    "segment_summary": f"""SELECT segment, count(*) AS customers, {REVENUE},
        {_ordinal('segment', fixed.SEGMENTS)} AS segment_place FROM segments GROUP BY segment""",
    "region_segment_revenue": f"""SELECT region, segment, {REVENUE},
        {_money('sum(sum(cents)) OVER (PARTITION BY region)')} AS region_revenue FROM segments GROUP BY region, segment""",
    "customer_ranking_list": f"""SELECT revenue_rank, customer_name, state, region, segment, total_orders,
        {_money('cents')} AS revenue, last_purchase FROM segments""",
    "avg_ticket_by_segment": f"""SELECT segment, count(*) AS customers, CAST(sum(total_orders) AS BIGINT) AS sales, {REVENUE},
        {_ratio_money('sum(cents)', 'sum(total_orders)', 2)} AS avg_ticket FROM segments GROUP BY segment""",
    "top_tier_share": f"""SELECT count(*) FILTER (WHERE segment = 'TOP_TIER') AS top_tier_customers,
        {_money("sum(CASE WHEN segment = 'TOP_TIER' THEN cents ELSE 0 END)")} AS top_tier_revenue,
        {_money('sum(cents)')} AS total_revenue,
        {_scaled(_half_up("sum(CASE WHEN segment = 'TOP_TIER' THEN cents ELSE 0 END) * 1000", "sum(cents)"), 1, 19)}
        AS revenue_pct FROM segments""",
    "customers_region_segment": "SELECT region, segment, count(*) AS customers FROM segments GROUP BY region, segment",
    "near_vip_customers": f"""SELECT customer_id, customer_name, state, region, {_money('cents')} AS revenue,
        {_money(f'{VIP_LIMIT}00 - cents')} AS gap_to_vip FROM segments WHERE segment = 'TOP_TIER'
        ORDER BY {VIP_LIMIT}00 - cents, customer_id LIMIT 10""",
    "sales_by_customer_profile": f"""SELECT g.state_name, g.segment, count(DISTINCT d.customer_id) AS customers,
        count(*) AS sales, {_money('sum(d.cents)')} AS revenue FROM detail d
        LEFT JOIN segments g ON g.customer_id = d.customer_id GROUP BY g.state_name, g.segment""",
    "measure_customers": f"""SELECT region, count(*) AS customers,
        CAST(count(*) FILTER (WHERE segment = 'VIP') AS BIGINT) AS vip_customers,
        {_scaled(_half_up("sum(CASE WHEN segment = 'VIP' THEN cents ELSE 0 END) * 1000000", "sum(cents)"), 6, 24)}
        AS vip_revenue_share, {_ratio_money('sum(cents)', 'sum(total_orders)')} AS avg_ticket, {REVENUE}
        FROM segments GROUP BY region""",
    # Price questions
    "price_kpis": f"""SELECT count(*) AS products, CAST(sum(is_confirmed_dearest) AS BIGINT) AS confirmed_dearest,
        {_money('sum(is_confirmed_dearest * cents)')} AS confirmed_dearest_revenue,
        CAST(sum(suspect) AS BIGINT) AS suspect_products FROM shown_prices""",
    "filtered_price_kpis": f"""SELECT count(*) AS products, CAST(sum(is_confirmed_dearest) AS BIGINT) AS confirmed_dearest,
        {_money('sum(is_confirmed_dearest * cents)')} AS confirmed_dearest_revenue,
        CAST(sum(suspect) AS BIGINT) AS suspect_products FROM shown_prices
        WHERE category IN ('ECONOMY', 'PROMO') AND price_class_label IN ('Mais caro que todos', 'Acima da média')""",
    "filtered_price_classes": f"""SELECT price_class_label, price_status, count(*) AS products
        FROM {SOME_PRICES} GROUP BY price_class_label, price_status""",
    "filtered_price_gap": f"""SELECT category, {_DIFF} AS avg_diff_vs_market FROM {SOME_PRICES}
        AND NOT has_suspect GROUP BY category""",
    "filtered_price_actions": f"SELECT {_ACTION} FROM {SOME_PRICES} AND price_class = 'MAIS_CARO_QUE_TODOS'",
    "products_by_price_class": """SELECT price_class_label, price_status, count(*) AS products
        FROM shown_prices GROUP BY price_class_label, price_status""",
    "price_gap_by_category": f"""SELECT category, {_DIFF} AS avg_diff_vs_market FROM shown_prices
        WHERE NOT has_suspect GROUP BY category""",
    "price_action_list": f"SELECT {_ACTION} FROM shown_prices WHERE price_class = 'MAIS_CARO_QUE_TODOS'",
    "dearest_products_top": f"""SELECT {_ACTION} FROM shown_prices WHERE price_class = 'MAIS_CARO_QUE_TODOS'
        ORDER BY cents DESC, product_id LIMIT 10""",
    "above_market_counts": """WITH dear AS (SELECT * FROM position WHERE avg_bp > 0)
        SELECT CASE WHEN has_suspect THEN 'A confirmar (preço suspeito)' ELSE 'Confirmado' END AS status,
               count(DISTINCT product_id) AS products,
               array_to_string(list_sort(list(DISTINCT category)), ', ') AS categories
        FROM dear GROUP BY has_suspect
        UNION ALL SELECT 'Total', count(DISTINCT product_id), NULL FROM dear""",
    "categories_above_market": f"""SELECT category, {_money(_half_up('sum(avg_bp)', 'count(*)'), 10)} AS avg_pct_vs_market,
        count(*) FILTER (WHERE NOT has_suspect) AS confirmed_products,
        count(*) FILTER (WHERE has_suspect) AS suspect_products, count(*) AS products
        FROM position GROUP BY category HAVING {_half_up('sum(avg_bp)', 'count(*)')} > 0""",
    "product_sales_with_price_position": f"""SELECT m.product_id, m.product_name, m.category, m.total_sales,
        {_money('m.cents')} AS revenue, {_money('m.ticket_cents', 10)} AS avg_ticket, {_money('p.own_cents', 10)} AS our_price,
        {_money('p.mean_cents', 10)} AS avg_competitor_price, {_money('p.avg_bp', 10)} AS pct_vs_avg, p.price_class,
        p.has_suspect FROM product_mart m JOIN position p ON p.product_id = m.product_id""",
    "measure_prices": f"""SELECT price_class_label, count(*) AS products,
        CAST(sum(is_confirmed_dearest) AS BIGINT) AS confirmed_dearest,
        {_money('sum(is_confirmed_dearest * cents)')} AS confirmed_dearest_revenue,
        CAST(sum(suspect) AS BIGINT) AS suspect_products, {_DIFF} AS avg_diff_vs_market, {REVENUE}
        FROM shown_prices GROUP BY price_class_label""",
}


BODIES["column_comment_audit"] = _audit(BODIES.__getitem__)
BODIES["bucketed_customer_profiles"] = BODIES["sales_by_customer_profile"]


def oracle_sql() -> dict[str, str]:
    """`best_weekday` and `above_market_counts` open with their own WITH: join it to the prelude."""
    sql = {}
    for name, body in BODIES.items():
        text = body.strip()
        sql[name] = PRELUDE + (", " + text[len("WITH ") :] if text.startswith("WITH ") else text)
    return sql
