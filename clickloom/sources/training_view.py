"""Binary-response view over the star-schema tables: ``rk, label, c01..c05, b01..b08``.

Line items joined to their order, part, supplier and customer. The joins carry no hint: Catalyst broadcasts a side
only if its file size is under the session's threshold, and uses a shuffle join beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import hash_bucket
from clickloom.sources.tables import deal_rows, read_table

KEY = "rk"
NUMERIC = ["c01", "c02", "c03", "c04", "c05"]
CATEGORICAL = ["b01", "b02", "b03", "b04", "b05", "b06", "b07", "b08"]
LINE_COLUMNS = [
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_linestatus",
]


def training_view(spark: SparkSession, sf_dir: str, customers_first: bool = False) -> DataFrame:
    """The view. With ``customers_first`` customers are joined to the orders before the lines are, so that no line moves for them, and the
    widest side, the part, comes last. The rows are the same in another order; fits of trees, whose sample of candidate splits follows
    the order, keep the other one."""
    line = deal_rows(read_table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS), "l_orderkey", "l_linenumber")
    orders = read_table(spark, sf_dir, "orders")
    part = read_table(spark, sf_dir, "part")
    supplier = read_table(spark, sf_dir, "supplier")
    customer = read_table(spark, sf_dir, "customer")

    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")  # order, line, part and supplier alone are not unique
    if customers_first:
        joined = (
            line.join(orders.join(customer, orders.o_custkey == customer.c_custkey), line.l_orderkey == orders.o_orderkey)
            .join(supplier, line.l_suppkey == supplier.s_suppkey)
            .join(part, line.l_partkey == part.p_partkey)
        )
    else:
        joined = (
            line.join(orders, line.l_orderkey == orders.o_orderkey)
            .join(part, line.l_partkey == part.p_partkey)
            .join(supplier, line.l_suppkey == supplier.s_suppkey)
            .join(customer, orders.o_custkey == customer.c_custkey)
        )
    joined = joined.withColumn(KEY, F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents.cast("string")))
    clicked = hash_bucket(KEY, 100, salt="y|") < F.lit(10) + F.lit(0.6) * F.col("l_quantity")
    return joined.select(
        KEY,
        F.when(clicked, 1).otherwise(0).alias("label"),
        F.col("l_quantity").alias("c01"),
        F.col("l_extendedprice").alias("c02"),
        F.col("s_acctbal").alias("c03"),
        F.col("p_size").cast("double").alias("c04"),
        F.col("l_discount").alias("c05"),
        F.col("p_brand").alias("b01"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "").otherwise(F.col("o_orderpriority")).alias("b02"),
        F.col("l_linestatus").alias("b03"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("b04"),
        F.col("p_type").alias("b05"),
        F.col("c_mktsegment").alias("b06"),
        F.col("l_suppkey").cast("string").alias("b07"),
        F.col("l_partkey").cast("string").alias("b08"),
    )
