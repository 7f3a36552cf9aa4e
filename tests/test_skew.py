"""Hot groups: one key holding most rows must still give exact results while
the work is split over several tasks."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from evalpress.operators import gates, pick


def test_rank_within_single_hot_group(spark):
    df = spark.range(20000).select(F.lit("hot").alias("g"), (F.col("id") % 97).alias("score"), F.col("id").alias("k"))
    df = df.union(spark.range(50).select(F.lit("cold").alias("g"), F.col("id").alias("score"), F.col("id").alias("k")))
    ranked = pick.rank_within(df, ["g"], [F.col("score").desc(), F.col("k")], num_partitions=8)
    w = Window.partitionBy("g").orderBy(F.col("score").desc(), "k")
    want = df.withColumn("rank", F.row_number().over(w))
    assert ranked.select("g", "k", "rank").exceptAll(want.select("g", "k", "rank")).count() == 0
    assert ranked.count() == 20050


def test_forward_fill_hot_document(spark):
    df = spark.range(30000).select(F.lit("doc").alias("doc"), F.col("id").alias("pos"),
                                   F.when(F.col("id") % 1000 == 7, F.col("id")).alias("v"))
    got = pick.forward_fill(df, "doc", "pos", "v", "o", chunk=512)
    wrong = got.where((F.col("pos") >= 7) & (F.col("o") != F.col("pos") - ((F.col("pos") - 7) % 1000)))
    assert wrong.count() == 0
    assert got.where(F.col("pos") < 7).where(F.col("o").isNotNull()).count() == 0


def test_gate_hot_report(spark):
    cases = spark.range(100000).select(F.lit("d").alias("run_dir"),
                                       F.when(F.col("id") < 99000, F.lit("hot")).otherwise(F.lit("cold")).alias("stem"),
                                       F.when(F.col("id") % 4 == 0, F.lit("error")).otherwise(F.lit("pass")).alias("verdict"))
    c = {r["stem"]: (r["total"], r["err"]) for r in gates.case_counts(cases, ["run_dir", "stem"]).collect()}
    assert c["hot"] == (99000, 24750) and c["cold"] == (1000, 250)


def test_dimensions_do_not_pass_through_the_driver(spark):
    """A table that others look things up in is joined by sorting, however small its compressed columns look."""
    from pyspark.sql import functions as F

    from evalpress.plans import fixtures as fx
    from tests.conftest import SMALL
    rows = spark.createDataFrame([("u1",), (None,)], "k string")
    for build, key in ((fx.fx6_meta, "name"), (fx.fx7_store, "id"), (fx.fx7_status_cache, "id"),
                       (fx.fx7_license_cache, "profile"), (fx.fx8_profile_text, "profile")):
        right = build(spark, SMALL).select(F.col(key).alias("_k"), "*")
        plan = rows.join(right, F.col("k") == F.col("_k"), "left")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan, build.__name__
