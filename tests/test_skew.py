"""A company holding a third (here: most) of the rows never ships whole through a shuffle."""

from pyspark.sql import functions as F

from kestrel.operators import dedup, newest, rollup

MAP_PARTITIONS = 4


def hash_shuffle_records(df) -> int:
    """Records written by the hash-partitioned exchanges of the executed (AQE final) plan."""
    df.collect()
    total = 0

    def walk(p):
        nonlocal total
        name = p.nodeName()
        if name == "Exchange" and "hashpartitioning" in p.toString().split("\n")[0]:
            total += p.metrics().apply("shuffleRecordsWritten").value()
        it = p.children().iterator()
        while it.hasNext():
            walk(it.next())
        if name.startswith("AdaptiveSparkPlan"):
            walk(p.executedPlan())
        elif "QueryStage" in name:
            walk(p.plan())

    walk(df._jdf.queryExecution().executedPlan())
    return total


def skewed(spark, hot_rows=30_000, cold=100):
    hot = spark.range(hot_rows).select(F.lit("hot").alias("org"), F.col("id").cast("string").alias("full_name"),
                                       (F.col("id") * 1000).cast("timestamp").alias("pushed_at"),
                                       (F.col("id") % 7).cast("int").alias("stars"))
    rest = spark.range(cold).select(F.col("id").cast("string").alias("org"), F.concat(F.lit("c"), F.col("id")).alias("full_name"),
                                    (F.col("id") * 1000).cast("timestamp").alias("pushed_at"), F.lit(1).alias("stars"))
    return hot.unionByName(rest).repartition(MAP_PARTITIONS)


def test_top_n_ships_at_most_n_rows_per_map_task(spark):
    df = skewed(spark)
    out = newest.newest_per_group(df, "org", "pushed_at", 10, ["full_name"])
    assert hash_shuffle_records(out) <= MAP_PARTITIONS * 10 + 100


def test_rollup_and_dedup_combine_map_side(spark):
    df = skewed(spark).withColumn("forks", F.lit(0)).withColumn("open_issues", F.lit(0))
    gold = rollup.repo_rollup(df)
    assert hash_shuffle_records(gold) <= MAP_PARTITIONS * 101
    copies = df.select("org", "stars", F.col("pushed_at").alias("seq"))
    last = dedup.last_wins(copies, "org", "seq")
    assert hash_shuffle_records(last) <= MAP_PARTITIONS * 101


def test_rank_window_is_partitioned_by_group_and_bucket(spark):
    from kestrel.operators import ranking

    df = skewed(spark).select("org", F.col("pushed_at").cast("long").alias("v"))
    out = ranking.rank_within(df, "org", "v", buckets=16)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the in-bucket window shuffles on (group, bucket): the hot group spreads over up to 16 tasks
    assert "hashpartitioning(org#" in plan and ", __b#" in plan.split("hashpartitioning(org#", 1)[1].split(")")[0]
    # and the hot group's values really land in many buckets
    hot = df.where("org = 'hot'")
    bounds = hot.agg(F.percentile_approx("v", [i / 16 for i in range(1, 16)], 10_000).alias("b")).first().b
    assert len(set(bounds)) == 15
