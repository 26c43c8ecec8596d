"""Driver tables and their bindings to the canonical ``Features(id, x, label)`` shape.

Bindings (see SURVEY §1.3):

* ``E`` embeddings: id = vec_id, x = embedding (FLOAT[] widened to DOUBLE[]), label INT.
* ``P`` part: id = p_partkey, x = (p_size, p_retailprice), label = p_type.
* ``O`` orders ⋈ lineitem aggregated per order: x = (o_totalprice, sum qty,
  sum extended price, avg discount, line count), label = o_orderpriority.
  lineitem is pre-aggregated per order key before the join, so the join is
  order-to-order and never multiplies rows; an order without lines has zeros.
* ``V`` events: id = event_id, x = (value), label = event_type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def features_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").cast("bigint").alias("id"),
                    F.col("embedding").cast("array<double>").alias("x"),
                    F.col("label").cast("int").alias("label"))


def features_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").cast("bigint").alias("id"),
                    F.array(F.col("p_size").cast("double"), F.col("p_retailprice").cast("double")).alias("x"),
                    F.col("p_type").alias("label"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order line aggregates (map-side combined before the join)."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("sum_qty"),
        F.sum("l_extendedprice").alias("sum_price"),
        F.avg("l_discount").alias("avg_disc"),
        F.count(F.lit(1)).alias("n_lines"))


def features_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice",
                                                   "o_orderpriority")
    lines = order_lines(spark, sf_dir)
    j = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")  # an order without lines counts as zeros
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return j.select(
        F.col("o_orderkey").cast("bigint").alias("id"),
        F.array(F.col("o_totalprice").cast("double"), zero("sum_qty"), zero("sum_price"), zero("avg_disc"),
                zero("n_lines")).alias("x"),
        F.col("o_orderpriority").alias("label"))


def features_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = read_table(spark, sf_dir, "events")
    return v.select(F.col("event_id").cast("bigint").alias("id"), F.array(F.col("value").cast("double")).alias("x"),
                    F.col("event_type").alias("label"))


BINDINGS = {
    "E": features_embeddings,
    "P": features_part,
    "O": features_orders,
    "V": features_events,
}


def features(spark: SparkSession, sf_dir: str, binding: str = "E") -> DataFrame:
    return BINDINGS[binding](spark, sf_dir)


def dims(df: DataFrame, x: str = "x") -> int:
    """Vector width, read from one row (0 for an empty frame)."""
    r = df.select(F.size(x).alias("p")).limit(1).collect()
    return int(r[0]["p"]) if r else 0
