"""Property tests: the scale-friendly operators equal the plain window
formulation on random inputs (ties, nulls, hot groups included)."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from evalpress.operators import pick

ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5), st.booleans()),
                min_size=1, max_size=60)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(ROWS, st.integers(1, 7))
def test_forward_fill_equals_window(spark, rows, chunk):
    data = [(g, i, f"v{i}" if opener else None) for i, (g, _, opener) in enumerate(rows)]
    df = spark.createDataFrame(data, "doc string, pos long, v string")
    got = {(r["doc"], r["pos"]): r["o"] for r in pick.forward_fill(df, "doc", "pos", "v", "o", chunk=chunk).collect()}
    w = Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    want = {(r["doc"], r["pos"]): r["o"] for r in df.withColumn("o", F.last("v", True).over(w)).collect()}
    assert got == want


@SETTINGS
@given(ROWS, st.integers(1, 6))
def test_rank_within_equals_row_number(spark, rows, parts):
    data = [(g, score, i) for i, (g, score, _) in enumerate(rows)]
    df = spark.createDataFrame(data, "g string, score int, k long")
    got = {r["k"]: r["rank"] for r in
           pick.rank_within(df, ["g"], [F.col("score").desc(), F.col("k")], num_partitions=parts).collect()}
    w = Window.partitionBy("g").orderBy(F.col("score").desc(), "k")
    want = {r["k"]: r["rn"] for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert got == want
