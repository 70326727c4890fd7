"""Join, aggregate, window, top-k and binning queries over orders and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.binning import edge_bin, edge_label
from tidemark.functions.text import clean_level, empty_to
from tidemark.operators.keyed import count_over, keep_first, keep_top, top_levels
from tidemark.plans import explore, features
from tidemark.sources.tables import query
from tidemark.workload.catalog import bin_sql, slot_sql
from tidemark.workload.market import Market
from tidemark.workload.registry import Registry

REGISTRY = Registry()


@REGISTRY.add("""
SELECT r_name, n_name, c_mktsegment, count(*) AS n_lines, count(DISTINCT o_orderkey) AS n_orders,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE NOT (l_linestatus = 'O') AND c_mktsegment NOT IN ('MACHINERY', 'BUILDING') GROUP BY ALL""")
def five_way_join(m: Market) -> DataFrame:
    """Five tables, a negated flag and an excluded list; lines are counted per order before the joins."""
    lines = (
        m.table("lineitem")
        .filter(~(F.col("l_linestatus") == "O"))
        .groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("q"))
    )
    segments = m.table("customer").filter(~F.col("c_mktsegment").isin("MACHINERY", "BUILDING"))
    orders = m.table("orders").select("o_orderkey", "o_custkey")
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(segments, F.col("o_custkey") == F.col("c_custkey"))
        .join(m.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(m.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.groupBy("r_name", "n_name", "c_mktsegment").agg(
        F.sum("n").alias("n_lines"), F.count(F.lit(1)).alias("n_orders"), F.sum("q").alias("quantity")
    )


@REGISTRY.add("""
SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')""")
def customers_without_urgent_orders(m: Market) -> DataFrame:
    urgent = m.table("orders").filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return m.table("customer").select("c_custkey", "c_name").join(urgent, "c_custkey", "left_anti")


@REGISTRY.add("""
WITH big AS (SELECT o_custkey FROM orders GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 25)
SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders WHERE o_custkey IN (SELECT o_custkey FROM big) GROUP BY ALL""")
def orders_of_top_customers(m: Market) -> DataFrame:
    top = keep_top(m.table("orders").select("o_custkey", "o_orderstatus"), "o_custkey", F.count(F.lit(1)), 25)
    return top.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add("""
SELECT p_partkey, COALESCE(n, 0) AS n_returned FROM part LEFT JOIN (
  SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45 GROUP BY 1) ON l_partkey = p_partkey""")
def returns_per_part(m: Market) -> DataFrame:
    """Left join with missing counts filled by 0."""
    returned = (
        m.table("lineitem")
        .filter("l_returnflag = 'R' AND l_quantity > 45")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.count(F.lit(1)).alias("n_returned"))
    )
    return m.table("part").select("p_partkey").join(returned, "p_partkey", "left").fillna(0, ["n_returned"])


@REGISTRY.add("""
WITH kept AS (
  SELECT p_brand FROM (SELECT p_brand, count(DISTINCT l_suppkey) AS m FROM lineitem JOIN part ON l_partkey = p_partkey
                       GROUP BY p_brand ORDER BY m DESC, p_brand LIMIT 12) WHERE m > 90)
SELECT CASE WHEN p_brand IN (SELECT p_brand FROM kept) THEN p_brand ELSE '0' END AS p_brand_simp, count(*) AS n
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def lumped_brands(m: Market) -> DataFrame:
    """Brands outside the twelve sold by most suppliers, or sold by 90 or fewer, become '0'."""
    lines = m.table("lineitem").select("l_partkey", "l_suppkey")
    branded = lines.join(m.table("part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    lumped = features.lump_rare(branded, "p_brand", F.countDistinct("l_suppkey"), 12, 90)
    return lumped.groupBy("p_brand_simp").agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add("""
WITH kept AS (SELECT l_suppkey FROM lineitem GROUP BY l_suppkey HAVING count(*) > 590)
SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey IN (SELECT l_suppkey FROM kept) THEN CAST(l_suppkey AS VARCHAR) ELSE '0' END AS l_suppkey_simp
FROM lineitem""")
def lumped_suppliers(m: Market) -> DataFrame:
    rows = m.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return features.lump_rare(rows, "l_suppkey", F.count("l_suppkey"), None, 590).drop("l_suppkey")


@REGISTRY.add("""
SELECT l_orderkey, l_suppkey, count(l_orderkey) OVER (PARTITION BY l_orderkey) AS lines_of_order,
       count(l_suppkey) OVER (PARTITION BY l_suppkey) AS lines_of_supplier FROM lineitem""")
def counts_beside_rows(m: Market) -> DataFrame:
    rows = m.table("lineitem").select("l_orderkey", "l_suppkey")
    counted = count_over(rows, ["l_orderkey"], {"lines_of_order": "l_orderkey"})
    return count_over(counted, ["l_suppkey"], {"lines_of_supplier": "l_suppkey"})


@REGISTRY.add("""
SELECT l_suppkey, count(DISTINCT l_partkey) AS measure FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""")
def suppliers_with_most_parts(m: Market) -> DataFrame:
    return top_levels(m.table("lineitem"), "l_suppkey", F.countDistinct("l_partkey"), 15)


@REGISTRY.add("""
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def first_order_per_customer(m: Market) -> DataFrame:
    first = keep_first(m.table("orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return first.select("o_custkey", "o_orderkey", "o_totalprice")


@REGISTRY.add("""
SELECT c_custkey, count(DISTINCT o_orderkey) AS n_orders, count(DISTINCT o_orderdate) AS n_days,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) / count(*) AS mean_cents FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def mixed_aggregates(m: Market) -> DataFrame:
    """Two distinct counts and a mean per key in one aggregate."""
    return m.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.countDistinct("o_orderkey").alias("n_orders"),
        F.countDistinct("o_orderdate").alias("n_days"),
        F.avg(F.round(F.col("o_totalprice") * 100).cast("long")).alias("mean_cents"),
    )


@REGISTRY.add("""
SELECT o_orderpriority, count(*) AS count, count(*) / sum(count(*)) OVER () AS share FROM orders GROUP BY 1 ORDER BY 2 DESC""")
def priority_shares(m: Market) -> DataFrame:
    return explore.value_counts(m.table("orders"), "o_orderpriority", share=True).orderBy(F.desc("count"))


PROFILE = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@REGISTRY.add(" UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
    f"min({c}) = 0 AND max({c}) = 1 AS is_binary FROM lineitem" for c in PROFILE))
def column_ranges(m: Market) -> DataFrame:
    return explore.range_profile(m.table("lineitem"), PROFILE)


@REGISTRY.add("""
SELECT CAST(sum(quality) AS BIGINT) AS quality, CAST(sum(toxic) AS BIGINT) AS toxic, CAST(sum(doc_id) AS BIGINT) AS doc_id FROM labels""")
def label_column_sums(m: Market) -> DataFrame:
    return explore.column_sums(m.table("labels"))


@REGISTRY.add("SELECT count(*) AS n_rows, CAST(11 AS INTEGER) AS n_columns FROM lineitem")
def table_shape(m: Market) -> DataFrame:
    return explore.shape(m.table("lineitem"))


@REGISTRY.add("""
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""")
def rows_of_last_day(m: Market) -> DataFrame:
    return features.temporal_holdout(m.table("orders").select("o_orderkey", "o_orderdate"), "o_orderdate")[1]


@REGISTRY.add("""
SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderdate < (SELECT max(o_orderdate) FROM orders) GROUP BY 1""")
def rows_before_last_day(m: Market) -> DataFrame:
    train, _ = features.temporal_holdout(m.table("orders"), "o_orderdate")
    return train.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


QUANTITY_EDGES = [1, 5, 10, 25, 40]


@REGISTRY.add(f"""
WITH b AS (SELECT {bin_sql('l_quantity', QUANTITY_EDGES)} AS bin, l_returnflag = 'R' AS r FROM lineitem)
SELECT bin, CASE bin WHEN 1 THEN '(1, 5]' WHEN 2 THEN '(5, 10]' WHEN 3 THEN '(10, 25]' WHEN 4 THEN '(25, 40]' END AS label,
       count(*) AS n, avg(CAST(r AS INTEGER)) AS rate FROM b GROUP BY ALL""")
def quantity_bins(m: Market) -> DataFrame:
    """Right-closed bins with explicit edges; values outside them have no bin."""
    bin_ = edge_bin(F.col("l_quantity"), QUANTITY_EDGES)
    binned = m.table("lineitem").select(bin_.alias("bin"), (F.col("l_returnflag") == "R").cast("int").alias("r"))
    return binned.groupBy("bin", edge_label(F.col("bin"), QUANTITY_EDGES).alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("r").alias("rate")
    )


@REGISTRY.add(f"""
WITH bounds AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
SELECT o_orderstatus, bin, n, lo + (bin - 1) * ((hi - lo) / 12.0::DOUBLE) AS lower, lo + bin * ((hi - lo) / 12.0::DOUBLE) AS upper
FROM (SELECT o_orderstatus, {slot_sql('o_totalprice', 12)} AS bin, count(*) AS n FROM orders, bounds GROUP BY ALL), bounds""")
def order_price_histogram(m: Market) -> DataFrame:
    return explore.histogram(m.table("orders"), "o_totalprice", 12, "o_orderstatus")


@REGISTRY.add("""
SELECT n_name, replace(replace(trim('  ' || r_name || ' / zone '), ' ', '_'), '/', '') AS level,
       CASE WHEN r_name = 'ASIA' THEN 'False' ELSE r_name END AS flag FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey)""")
def cleaned_levels(m: Market) -> DataFrame:
    """Padded texts with blanks and slashes made into level names, empty flags filled."""
    used = m.table("nation").join(
        m.table("customer").select(F.col("c_nationkey").alias("n_nationkey")), "n_nationkey", "left_semi"
    )
    rows = used.join(m.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    padded = F.concat(F.lit("  "), "r_name", F.lit(" / zone "))
    flag = F.when(F.col("r_name") == "ASIA", F.lit("")).otherwise(F.col("r_name"))
    return rows.select("n_name", clean_level(padded).alias("level"), empty_to(flag, "False").alias("flag"))


@REGISTRY.add("""
SELECT o_orderstatus, count(*) AS n, -max(o_totalprice) AS lowest FROM orders GROUP BY 1 ORDER BY 2 DESC, 1""")
def sql_text_query(m: Market) -> DataFrame:
    """A statement with ordinals over a frame given by name."""
    return query(
        m.spark,
        "SELECT o_orderstatus, count(*) AS n, -max(o_totalprice) AS lowest FROM {orders} GROUP BY 1 ORDER BY 2 DESC, 1",
        orders=m.table("orders"),
    )
