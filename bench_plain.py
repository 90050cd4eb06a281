"""The baseline of `bench.py`: the same headline results as the plainest Spark SQL.

Each table is a view written straight from its definition: row numbers over windows for
repeated rows and for ranks, ordinary joins in the order of the data flow. Prints one JSON
line with seconds per headline, measured like `bench.py`.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyhouse import RetailModel, build_session  # noqa: E402

FIRST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS n FROM {table}) WHERE n = 1"

VIEWS = {
    "products": f"""SELECT product_id, trim(product_name) AS product_name, category, brand,
        CAST(current_price AS DECIMAL(10,2)) AS current_price, created_at,
        CASE WHEN current_price > 975 THEN 'PREMIUM' WHEN current_price > 925 THEN 'MEDIO' ELSE 'BASICO' END AS price_band
        FROM ({FIRST.format(key='product_id', order='created_at', table='raw_products')})""",
    "customers": f"""SELECT customer_id, initcap(regexp_replace(trim(customer_name), '^(Sr|Sra|Srta|Dr|Dra)[.] +', '')) AS customer_name,
        upper(trim(state)) AS state, region, country, registered_on
        FROM ({FIRST.format(key='customer_id', order='registered_on', table='raw_customers')})
        LEFT JOIN states ON code = upper(trim(state))""",
    "sales": f"""SELECT s.sale_id, s.sold_at, to_date(s.sold_at) AS sale_date, hour(s.sold_at) AS sale_hour,
        dayofweek(s.sold_at) AS weekday_num, s.customer_id, s.product_id, s.channel, s.quantity,
        CAST(s.unit_price AS DECIMAL(10,2)) AS unit_price, CAST(s.quantity * s.unit_price AS DECIMAL(10,2)) AS revenue,
        p.created_at IS NOT NULL AS is_registered, coalesce(s.sold_at < p.created_at, false) AS sold_before_created
        FROM ({FIRST.format(key='sale_id', order='source_version', table='raw_sales')}) s
        LEFT JOIN products p ON p.product_id = s.product_id""",
    "prices": f"""SELECT c.product_id, competitor, CAST(competitor_price AS DECIMAL(10,2)) AS competitor_price,
        to_timestamp(collected_at) AS collected_at, competitor_price < 0.6 * p.current_price AS is_suspect
        FROM ({FIRST.format(key='product_id, competitor', order='collected_at', table='raw_competitor_prices')}) c
        LEFT JOIN products p ON p.product_id = c.product_id""",
    "segments": """SELECT c.customer_id, c.customer_name, c.state, c.region, count(s.sale_id) AS total_orders,
        coalesce(sum(s.revenue), 0) AS revenue, round(avg(s.revenue), 2) AS avg_ticket, min(sold_at) AS first_purchase,
        max(sold_at) AS last_purchase, CASE WHEN coalesce(sum(s.revenue), 0) >= 2100000 THEN 'VIP'
          WHEN coalesce(sum(s.revenue), 0) >= 1300000 THEN 'TOP_TIER' ELSE 'REGULAR' END AS segment,
        row_number() OVER (ORDER BY coalesce(sum(s.revenue), 0) DESC, c.customer_id) AS revenue_rank
        FROM customers c LEFT JOIN sales s ON s.customer_id = c.customer_id
        GROUP BY c.customer_id, c.customer_name, c.state, c.region""",
    "times": """SELECT sale_date, weekday_num, sale_hour, channel, count(*) AS total_sales, sum(quantity) AS items_sold,
        sum(revenue) AS revenue, count(DISTINCT customer_id) AS unique_customers
        FROM sales GROUP BY sale_date, weekday_num, sale_hour, channel""",
    "product_sales": """SELECT *, row_number() OVER (ORDER BY revenue DESC, product_id) AS revenue_rank,
        row_number() OVER (PARTITION BY category ORDER BY revenue DESC, product_id) AS category_rank
        FROM (SELECT s.product_id, p.product_name, p.category, p.brand, p.price_band, s.is_registered, count(*) AS total_sales,
          sum(s.quantity) AS items_sold, sum(s.revenue) AS revenue, round(avg(s.revenue), 2) AS avg_ticket
          FROM sales s LEFT JOIN products p ON p.product_id = s.product_id GROUP BY ALL)""",
    "detail": """SELECT s.*, p.product_name, p.category, p.brand, p.price_band, c.customer_name, c.state, c.region, c.segment
        FROM sales s LEFT JOIN products p ON p.product_id = s.product_id LEFT JOIN segments c ON c.customer_id = s.customer_id""",
    "position": """SELECT p.product_id, p.product_name, p.category, p.brand, p.current_price, m.mean, m.low, m.high, m.suspect,
        coalesce(s.revenue, 0) AS revenue, coalesce(s.items, 0) AS items_sold
        FROM products p JOIN (SELECT product_id, avg(competitor_price) AS mean, min(competitor_price) AS low,
          max(competitor_price) AS high, bool_or(is_suspect) AS suspect FROM prices GROUP BY product_id) m ON m.product_id = p.product_id
        LEFT JOIN (SELECT product_id, sum(revenue) AS revenue, sum(quantity) AS items FROM sales GROUP BY product_id) s
          ON s.product_id = p.product_id""",
}

HEADLINES = {
    "silver_products": "SELECT * FROM products",
    "silver_customers": "SELECT * FROM customers",
    "silver_sales": "SELECT * FROM sales",
    "silver_competitor_prices": "SELECT * FROM prices",
    "gold_customer_segments": "SELECT * FROM segments",
    "gold_sales_time": "SELECT * FROM times",
    "gold_product_sales": "SELECT * FROM product_sales",
    "gold_sales_detail": "SELECT * FROM detail",
    "gold_price_position": "SELECT * FROM position",
    "commercial_kpis": "SELECT sum(revenue), count(*), sum(revenue) / count(*), sum(quantity) FROM detail",
    "daily_revenue_by_channel": "SELECT sale_date, channel, sum(revenue) FROM detail GROUP BY sale_date, channel ORDER BY 1, 2",
    "weekday_mean_revenue": "SELECT weekday_num, sum(revenue) / count(DISTINCT sale_date), sum(revenue) FROM detail GROUP BY 1 ORDER BY 1",
    "top_products_filtered": """SELECT product_id, product_name, category, count(*), sum(quantity), sum(revenue) FROM detail
        WHERE sale_date BETWEEN '1996-01-01' AND '1998-12-31' AND channel = 'ecommerce' GROUP BY ALL ORDER BY 6 DESC, 1 LIMIT 10""",
    "region_category_revenue": "SELECT region, category, count(DISTINCT customer_id), count(*), sum(revenue) FROM detail GROUP BY 1, 2",
    "best_sellers_by_segment": "SELECT segment, sum(revenue), count(*), count(DISTINCT customer_id) FROM detail GROUP BY 1 ORDER BY 2 DESC LIMIT 10",
    "customer_kpis": "SELECT count(*), count_if(segment = 'VIP'), sum(revenue) / sum(total_orders) FROM segments",
    "top_tier_share": "SELECT count_if(segment = 'TOP_TIER'), sum(if(segment = 'TOP_TIER', revenue, 0)) / sum(revenue) FROM segments",
    "near_vip_customers": "SELECT * FROM segments WHERE segment = 'TOP_TIER' ORDER BY 2100000 - revenue, customer_id LIMIT 10",
    "price_kpis": "SELECT count(*), count_if(current_price > high AND NOT suspect), count_if(suspect) FROM position",
    "price_action_list": "SELECT * FROM position WHERE current_price > high ORDER BY revenue DESC, product_id",
    "product_sales_with_price_position": "SELECT * FROM product_sales m JOIN position p ON p.product_id = m.product_id",
}


def main() -> None:
    from oracle.constants import STATE_REGIONS

    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = build_session("plain", f"local[{cpus}]", **{"spark.driver.memory": "16g", "spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    raw = RetailModel.from_folder(spark, folder).raw
    for name in raw:
        raw[name].createOrReplaceTempView(f"raw_{name}")
    spark.createDataFrame(list(STATE_REGIONS.items()), "code string, region string").createOrReplaceTempView("states")
    for name, sql in VIEWS.items():
        spark.sql(sql).createOrReplaceTempView(name)

    def run(name: str) -> float:
        start = time.perf_counter()
        result = spark.sql(HEADLINES[name])
        result.toDF(*[f"c{i}" for i in range(len(result.columns))]).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("gold_sales_time")  # start the JVM's compilers; not counted
    times = {name: run(name) for name in HEADLINES}
    spark.stop()
    print(json.dumps({"metric": "plain Spark SQL", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times}))


if __name__ == "__main__":
    main()
