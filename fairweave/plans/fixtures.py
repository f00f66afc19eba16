"""Views over the given tables in the shapes the operators expect.

The SQL runs on Spark and DuckDB alike; table names stand in braces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fairweave.operators.store import spread

LISTINGS = """
SELECT o.o_orderkey AS row_id,
  CASE CAST(o.o_orderkey % 12 AS INT)
    WHEN 0 THEN 'Fighter Practice' WHEN 1 THEN 'Archery Practice' WHEN 2 THEN 'Spring Crown Tournament'
    WHEN 3 THEN 'Gulf Wars XXXV' WHEN 4 THEN 'Business Meeting (Virtual)' WHEN 5 THEN 'Harvest Feast (OUT OF KINGDOM)'
    WHEN 6 THEN 'Harvest Feast' WHEN 7 THEN 'A&S Night' WHEN 8 THEN 'Award deadline'
    WHEN 9 THEN 'Cancelled: Demo' WHEN 10 THEN 'Lilies War' ELSE 'Populace Meeting' END AS title,
  o.o_orderdate AS start_ts,
  o.o_orderdate + CAST(o.o_orderkey % 9 AS INT) * INTERVAL '1' DAY AS end_ts,
  CASE WHEN o.o_custkey % 3 = 0 THEN concat('Kingdom of ', r.r_name) ELSE concat('Barony of ', n.n_name) END AS source,
  concat('Kingdom of ', r.r_name) AS kingdom,
  CASE WHEN o.o_custkey % 3 = 0 THEN 'kingdom' ELSE 'baronial' END AS calendar_type,
  (o.o_orderkey % 12 = 4) AS is_virtual,
  CASE WHEN o.o_orderkey % 11 = 0 THEN '' ELSE concat(CAST(100 + c.c_nationkey AS STRING), ' Main St, ', n.n_name, ', ',
     CASE CAST(n.n_regionkey AS INT) WHEN 0 THEN 'PA' WHEN 1 THEN 'TX' WHEN 2 THEN 'MS' WHEN 3 THEN 'OH' ELSE 'CA' END, ' 75001') END AS clean_location,
  round(CAST(24 + (o.o_custkey * 37 % 2600) / 100.0 AS DOUBLE), 2) AS lat,
  round(CAST(-125 + (o.o_custkey * 53 % 5800) / 100.0 AS DOUBLE), 2) AS lng
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""
EDGES = """
SELECT n.n_nationkey AS poly_id, concat('Kingdom of ', r.r_name) AS kingdom, 0 AS ring, e.i AS edge,
  CAST(-125 + (n.n_nationkey % 5) * 11.6 + e.dx1 AS DOUBLE) AS x1, CAST(24 + CAST(floor(n.n_nationkey / 5) AS INT) * 5.2 + e.dy1 AS DOUBLE) AS y1,
  CAST(-125 + (n.n_nationkey % 5) * 11.6 + e.dx2 AS DOUBLE) AS x2, CAST(24 + CAST(floor(n.n_nationkey / 5) AS INT) * 5.2 + e.dy2 AS DOUBLE) AS y2
FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey
CROSS JOIN (VALUES (0, 0.5, 0.3, 10.9, 0.9), (1, 10.9, 0.9, 9.7, 4.8), (2, 9.7, 4.8, 5.1, 2.6), (3, 5.1, 2.6, 1.2, 4.9), (4, 1.2, 4.9, 0.5, 0.3)) AS e(i, dx1, dy1, dx2, dy2)
"""
# a county with a hole in each nation, two thirds of them assigned, above the nations as a second layer
LAYERED = f"""
SELECT 100 + n.n_nationkey AS poly_id, CASE WHEN n.n_nationkey % 3 <> 0 THEN concat('County ', CAST(n.n_nationkey AS STRING)) END AS kingdom, e.r AS ring, e.i AS edge,
  CAST(-125 + (n.n_nationkey % 5) * 11.6 + e.dx1 AS DOUBLE) AS x1, CAST(24 + CAST(floor(n.n_nationkey / 5) AS INT) * 5.2 + e.dy1 AS DOUBLE) AS y1,
  CAST(-125 + (n.n_nationkey % 5) * 11.6 + e.dx2 AS DOUBLE) AS x2, CAST(24 + CAST(floor(n.n_nationkey / 5) AS INT) * 5.2 + e.dy2 AS DOUBLE) AS y2, 0 AS layer
FROM {{nation}} n CROSS JOIN (VALUES (0, 0, 3.0, 0.8, 7.0, 0.8), (0, 1, 7.0, 0.8, 7.0, 2.4), (0, 2, 7.0, 2.4, 3.0, 2.4), (0, 3, 3.0, 2.4, 3.0, 0.8), (1, 0, 4.0, 1.2, 6.0, 1.2), (1, 1, 6.0, 1.2, 6.0, 2.0), (1, 2, 6.0, 2.0, 4.0, 2.0), (1, 3, 4.0, 2.0, 4.0, 1.2)) AS e(r, i, dx1, dy1, dx2, dy2)
UNION ALL SELECT poly_id, kingdom, ring, edge, x1, y1, x2, y2, 1 AS layer FROM ({EDGES})
"""
GROUPS = """
SELECT s.s_suppkey AS group_id, concat(CASE CAST(s.s_suppkey % 4 AS INT) WHEN 0 THEN 'Barony' WHEN 1 THEN 'Shire' WHEN 2 THEN 'Canton' ELSE 'College' END, ' of ', n.n_name, '-', CAST(s.s_suppkey AS STRING)) AS group_name,
 concat('Kingdom of ', r.r_name) AS kingdom, round(CAST(24 + (s.s_suppkey * 71 % 2600) / 100.0 AS DOUBLE), 2) AS lat, round(CAST(-125 + (s.s_suppkey * 97 % 5800) / 100.0 AS DOUBLE), 2) AS lng
FROM {supplier} s JOIN {nation} n ON s.s_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""
PAGES = """
SELECT page_id, url, concat(html, CASE CAST(page_id % 7 AS INT)
  WHEN 0 THEN concat('<iframe src="https://calendar.google.com/calendar/embed?src=grp', CAST(page_id % 20 AS STRING), '%40group.calendar.google.com"></iframe>')
  WHEN 1 THEN concat('<a href="webcal://site', CAST(page_id AS STRING), '.example.org/feed.ics">Subscribe</a>')
  WHEN 2 THEN '<link href="/wp-content/plugins/the-events-calendar/style.css">'
  WHEN 3 THEN '<link href="/wp-content/plugins/events-manager/style.css">' ELSE '' END) AS html FROM {pages}
"""
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def run_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The SQL over the Parquet tables of a folder."""
    return spark.sql(sql.format(**{t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES}))


def plain(sql: str) -> str:
    """The SQL over views of the tables' names."""
    return sql.format(**{t: t for t in TABLES})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, spread over all cores if its file has too few parts for that."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, LISTINGS)


def territory_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, EDGES)


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, GROUPS)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, PAGES)
