"""One order key holding a third of all lineitems: results stay exact, and AQE
splits the hot partition of the view's sort-merge join."""

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as E
from check_oracle import digest

from conftest import SF01

HOT_ORDER = 7


def _skewed_copy(spark, root):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    hot = F.col("l_orderkey") % 3 == 0  # a third of all rows move to one key
    skewed = li.withColumn("l_orderkey", F.when(hot, F.lit(HOT_ORDER).cast("bigint")).otherwise(F.col("l_orderkey")))
    # several files, as at scale: AQE splits a hot partition along map-output
    # boundaries, so it needs the hot key to arrive from more than one map task
    skewed.repartition(8).write.parquet(f"{root}/lineitem.parquet")
    for t in ("orders", "customer", "nation"):
        spark.read.parquet(f"{SF01}/{t}.parquet").write.parquet(f"{root}/{t}.parquet")
    return root


def test_skewed_key_exact_and_split(spark, tmp_path):
    root = _skewed_copy(spark, str(tmp_path / "skewed"))
    conf = {  # thresholds scaled down to the test's size
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = E.queries()["pipeline_2010"](spark, root)
        got = [tuple(r) for r in df.collect()]
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    final = plan.split("== Initial Plan ==")[0]
    assert "SortMergeJoin(skew=true)" in final  # AQE split the hot key's partition
    con = duckdb.connect()
    for t in ("lineitem", "orders", "customer", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet/*.parquet')")
    rel = con.sql(E.oracle_sql()["pipeline_2010"])
    assert digest(df.columns, got) == digest(rel.columns, rel.fetchall())


def test_hot_customer_exact_and_split(spark, tmp_path):
    """One customer with a third of all orders: the orders ⋈ customer join splits its partition."""
    root = str(tmp_path / "hot")
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    hot = F.col("o_orderkey") % 3 == 0
    orders = orders.withColumn("o_custkey", F.when(hot, F.lit(HOT_ORDER).cast("bigint")).otherwise(F.col("o_custkey")))
    orders.repartition(8).write.parquet(f"{root}/orders.parquet")
    for t in ("lineitem", "customer", "nation"):
        spark.read.parquet(f"{SF01}/{t}.parquet").write.parquet(f"{root}/{t}.parquet")
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        split = spark.read.parquet(f"{root}/orders.parquet").select("o_custkey", "o_orderkey").join(
            spark.read.parquet(f"{root}/customer.parquet").select("c_custkey"), F.expr("o_custkey = c_custkey")
        )
        split.collect()
        assert "SortMergeJoin(skew=true)" in split._jdf.queryExecution().executedPlan().toString()
        df = E.queries()["pipeline_2010"](spark, root)
        got = [tuple(r) for r in df.collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    con = duckdb.connect()
    for t in ("lineitem", "orders", "customer", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet/*.parquet')")
    rel = con.sql(E.oracle_sql()["pipeline_2010"])
    assert digest(df.columns, got) == digest(rel.columns, rel.fetchall())
