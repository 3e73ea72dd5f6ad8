"""Hot groups: one document holding most of the children, one key holding most
of the documents.  Results must stay whole; the plan must split or pre-reduce
the hot group instead of sending it to one task."""

import os

from helpers import write_lines
from tradelake.plans.build import table
from tradelake.sources.jsonsrc import land_json


def _docs():
    hot = {"_ord": 0, "deal_id": "1",
           "order_products": [{"product_unit_id": str(i), "external_id": "e"}
                              for i in range(6000)]}
    rest = [{"_ord": i, "deal_id": str(i % 50 + 2),       # 50 keys, many duplicates
             "order_products": [{"product_unit_id": "1", "external_id": "e"}]}
            for i in range(1, 400)]
    junk = [{"_ord": 1000 + i, "deal_id": "x"} for i in range(300)]   # NULL-key group
    return [hot] + rest + junk


def _spread_export(spark):
    """Export whose hot document's elements arrive from many map tasks (as when
    children are rows of a large relational table).  One JSON line is read by
    one task, so a single document's elements can never be split further."""
    from pyspark.sql import functions as F
    from tradelake.sources.export import Export, Frame
    docs = spark.range(0, 400, numPartitions=4).select(
        F.col("id").alias("_ord"), (F.col("id") % 50 + 2).cast("string").alias("deal_id"))
    docs = docs.withColumn("deal_id", F.when(F.col("_ord") == 0, F.lit("1"))
                           .otherwise(F.col("deal_id")))
    hot = spark.range(0, 20000, numPartitions=8).select(
        F.lit(0).cast("long").alias("_ord"), F.col("id").alias("_p1"),
        F.col("id").cast("string").alias("product_unit_id"), F.lit("e").alias("external_id"))
    rest = spark.range(1, 400, numPartitions=4).select(
        F.col("id").alias("_ord"), F.lit(0).cast("long").alias("_p1"),
        F.lit("1").alias("product_unit_id"), F.lit("e").alias("external_id"))
    exp = Export("order")
    exp.frames[""] = Frame(docs, ("_ord",))
    exp.frames["order_products"] = Frame(hot.unionByName(rest), ("_ord", "_p1"))
    return exp


def test_hot_parent_split_and_whole(spark):
    exp = _spread_export(spark)
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = table(exp, "order_products")
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(rows) == 20000 + 50                     # nothing dropped or capped
    assert "isFinalPlan=true" in plan and "skew=true" in plan


def test_hot_key_pre_reduced_before_shuffle(spark, tmpdir_path):
    exp = land_json(spark, "order", write_lines(os.path.join(tmpdir_path, "k"), _docs()))
    df = table(exp, "orders")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the partial top-1 runs before the exchange: a hot key leaves each map
    # task as at most one row
    partial = plan.index("WindowGroupLimit")
    assert "Partial" in plan and plan.rfind("Exchange") > partial
    assert df.count() == 1 + 50 + 1                    # hot key, 50 keys, NULL key
