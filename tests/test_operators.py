"""Edge rows of the DataFrame operators (FIXTURES section C)."""
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalpress.operators import audit, gates, lookups, nested, pick, publish, state


def test_allow_list_fail_closed(spark):
    df = spark.createDataFrame([("01_quality",), ("99_unlisted",)], "playbook string")
    assert [r[0] for r in publish.filter_allowed(df, "playbook", ["01_quality"]).collect()] == ["01_quality"]
    with pytest.raises(publish.PublicationError):
        publish.filter_allowed(df, "playbook", [])
    empty = spark.createDataFrame([], "name string")
    with pytest.raises(Exception):
        publish.filter_allowed_df(df, "playbook", empty).collect()


def test_error_gate_boundaries(spark):
    df = spark.createDataFrame([("zero", 0, 0), ("three", 10, 3), ("four", 10, 4)], "k string, total long, err long")
    kept = sorted(r[0] for r in gates.gate_error_rate(df).collect())
    assert kept == ["three"]
    v = {r["k"]: (r["err_rate"], r["valid"]) for r in gates.validity(df).collect()}
    assert v["zero"] == (1.0, False) and v["three"][1] and not v["four"][1]


def test_min_cohort_and_classify(spark):
    rows = [("d2", i, False) for i in range(2)] + [("d3", i, i < 1) for i in range(3)] \
        + [("s6", i, i < 3) for i in range(6)] + [("l5", i, i < 2) for i in range(5)]
    df = spark.createDataFrame(rows, "run_dir string, i int, is_saas boolean")
    sized = gates.min_cohort(df, "run_dir", 3)
    c = {r["run_dir"]: r["is_saas"] for r in gates.classify_cohort(sized, "run_dir", "is_saas").collect()}
    assert c == {"d3": False, "s6": True, "l5": False}


def test_pick_cohort(spark):
    df = spark.createDataFrame([("2024-01-01", False), ("2024-01-08", False), ("2024-01-15", True)],
                               "run_dir string, is_saas boolean")
    assert pick.pick_cohort_pinned(df, "run_dir", "2024-01-01").first()[0] == "2024-01-01"
    assert pick.pick_cohort_pinned(df, "run_dir", "absent").first()[0] == "2024-01-08"
    assert pick.pick_cohort_latest(df, "run_dir").first()[0] == "2024-01-15"


def test_raw_fields(spark):
    schema = T.StructType([T.StructField("results", T.StringType()), T.StructField("x_token", T.StringType()),
                           T.StructField("judge_knockouts", T.IntegerType()),
                           T.StructField("s", T.StructType([T.StructField("response", T.StringType()),
                                                           T.StructField("ok", T.StringType())]))])
    df = spark.createDataFrame([], schema)
    with pytest.raises(publish.PublicationError, match="results, x_token"):
        publish.assert_no_raw_fields(df)
    clean = publish.drop_raw_fields(df)
    assert clean.columns == ["judge_knockouts", "s"]
    assert clean.schema["s"].dataType.fieldNames() == ["ok"]
    publish.assert_no_raw_fields(clean, top_level_only=False)
    assert publish.raw_paths(df.schema, exempt=("s.response",)) == ["results", "x_token"]


def test_first_needle_order(spark):
    df = spark.createDataFrame([("a blue ring",), ("green",)], "t string")
    rules = ((1, "blue", "B"), (2, "ring", "R"), (3, "o", "O"))
    assert [r[0] for r in df.select(lookups.first_needle_case("t", rules)).collect()] == ["B", None]


def test_registry_status(spark):
    ids = spark.createDataFrame([("cached",), ("in_store",), ("nowhere",), ("lifted",)], "id string")
    cache = spark.createDataFrame([("cached", "anon", "gated", "c"), ("lifted", "anon", "undetermined", "c")],
                                  "id string, mode string, status string, detail string")
    store = spark.createDataFrame([("in_store",), ("lifted",)], "id string")
    st = {r["id"]: r["status"] for r in lookups.registry_status(ids, cache, store, "anon").collect()}
    assert st == {"cached": "gated", "in_store": "ok", "nowhere": "undetermined", "lifted": "ok"}
    merged = lookups.merge_status_cache(ids, cache, store, "anon")
    assert merged.where(F.col("origin") == "new").count() == 2


def test_argmax_argmin(spark):
    df = spark.createDataFrame([("a", None, "p1"), ("b", 0.9, "p2"), ("c", 0.9, "p3")],
                               "label string, f1 double, pos string")
    assert pick.argmax_first(df, "f1", "pos").first()["label"] == "b"
    d2 = spark.createDataFrame([("z", 0.0, 1), ("n", None, 2), ("f", 3.0, 3), ("g", 3.0, 4)],
                               "m string, s double, pos int")
    assert pick.argmin_default(d2, "s", "pos").first()["m"] == "f"


def test_latest_per_key_ties(spark):
    df = spark.createDataFrame([("m1", "2024-01-01", 1), ("m1", "2024-01-01", 2), ("m2", "2024-01-02", 5)],
                               "model string, d string, k int")
    got = {r["model"]: r["k"] for r in pick.latest_per_key(df, ["model"], ["d", "k"]).collect()}
    assert got == {"m1": 2, "m2": 5}


def test_first_match_and_sorted_structs(spark):
    schema = "arr array<struct<test_id:string,response:string>>, m map<string,struct<total:int>>"
    df = spark.createDataFrame([
        ([("a", "1"), ("perf", "2"), ("perf", "3")], {"b": (2,), "a": (1,)}),
        ([], {}),
        (None, None)], schema)
    rows = df.select(nested.first_match(F.col("arr"), "test_id", "perf").alias("f"),
                     nested.map_to_sorted_structs(F.col("m"), "playbook").alias("s")).collect()
    assert rows[0]["f"]["response"] == "2"
    assert [x["playbook"] for x in rows[0]["s"]] == ["a", "b"]
    assert rows[1]["f"] is None and rows[1]["s"] == []
    assert rows[2]["f"] is None and rows[2]["s"] is None


def test_forward_fill_chunks_match_window(spark):
    from pyspark.sql import Window
    rows = [("d1", i, f"o{i}" if i % 7 == 0 else None) for i in range(1, 60)] + \
           [("d2", i, None if i < 30 else ("x" if i == 30 else None)) for i in range(1, 50)]
    df = spark.createDataFrame(rows, "doc string, pos long, v string")
    got = {(r["doc"], r["pos"]): r["o"] for r in pick.forward_fill(df, "doc", "pos", "v", "o", chunk=4).collect()}
    w = Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    want = {(r["doc"], r["pos"]): r["o"] for r in df.withColumn("o", F.last("v", True).over(w)).collect()}
    assert got == want


def test_rank_within_matches_row_number(spark):
    from pyspark.sql import Window
    rows = [("a" if i % 3 else "b", i % 5, i) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, score int, k int")
    got = {r["k"]: r["rank"] for r in pick.rank_within(df, ["g"], [F.col("score").desc(), F.col("k")]).collect()}
    w = Window.partitionBy("g").orderBy(F.col("score").desc(), "k")
    want = {r["k"]: r["rn"] for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert got == want


def test_typed_sort(spark):
    df = spark.createDataFrame([("a", "12 ms"), ("b", "3,5%"), ("c", "—"), ("d", "2")], "k string, cell string")
    keyed = pick.typed_sort_keys(df, "cell")
    order = [r["k"] for r in pick.rank_within(keyed, [], [F.col("_blank"), F.col("_num_key"),
                                                        F.col("_text_key"), F.col("k")]).orderBy("rank").collect()]
    assert order == ["d", "b", "a", "c"]
    txt = spark.createDataFrame([("a", "b10"), ("b", "b2"), ("c", "Granite-4.1-30B")], "k string, cell string")
    keyed = pick.typed_sort_keys(txt, "cell")
    order = [r["k"] for r in pick.rank_within(keyed, [], [F.col("_blank"), F.col("_num_key"),
                                                        F.col("_text_key"), F.col("k")]).orderBy("rank").collect()]
    assert order == ["b", "a", "c"]


def test_one_to_one_and_change_date(spark):
    rows = spark.createDataFrame([("c", "r1"), ("c", "r2"), ("c", "r2")], "config string, run_id string")
    runs = spark.createDataFrame([("c", "r1"), ("c", "r3")], "config string, run_id string")
    bad = {r["run_id"]: (r["n_rows"], r["n_runs"]) for r in audit.unmatched_keys(rows, runs).collect()}
    assert bad == {"r2": (2, 0), "r3": (0, 1)}
    prev = spark.createDataFrame([(1, "h1", "2024-01-01"), (2, "h2", "2024-01-01"), (4, "h4", "2024-01-01")],
                                 "k int, hash string, stamp string")
    new = spark.createDataFrame([(1, "h1"), (2, "hX"), (3, "h3")], "k int, h string")
    got = {r["k"]: (r["stamp"], r["change"]) for r in
           state.change_date(new, prev, "k", F.col("h"), F.lit("2024-02-01")).collect()}
    assert got == {1: ("2024-01-01", "unchanged"), 2: ("2024-02-01", "changed"), 3: ("2024-02-01", "new")}


def test_leak_text_cut(spark):
    df = spark.createDataFrame([(1, "mail a.b@x.org and c@y.net, token = abcdefghijklmnopqrstuvwxyz0123456789XYZ")],
                               "id int, t string")
    rules = (("email", r"[\w.+-]+@[\w-]+\.\w+"), ("secret", r"(?i)token\s*=\s*\S+"))
    got = sorted((r["rule"], r["match"]) for r in audit.leak_text(df, "id", "t", rules).collect())
    assert got[0] == ("email", "a.b@x.org") and got[1] == ("email", "c@y.net")
    assert len(got[2][1]) == 40


def test_one_to_one_compares_keys(spark):
    rows = spark.createDataFrame([("c", "r1"), ("c", "r2"), ("d", "s")], "config string, run_id string")
    runs = spark.createDataFrame([("c", "r1"), ("c", "r3"), ("d", "s")], "config string, run_id string")
    got = {r["config"]: (r["n_rows"], r["n_runs"], r["n_keys"], r["n_unmatched"], r["one_to_one"])
           for r in audit.one_to_one(rows, runs).collect()}
    assert got == {"c": (2, 2, 2, 2, False), "d": (1, 1, 1, 0, True)}
    twice = audit.one_to_one(rows.union(rows), runs.union(runs)).collect()
    assert not any(r["one_to_one"] for r in twice)


def test_forward_fill_null_part(spark):
    df = spark.createDataFrame([(None, 0, "x"), (None, 5, None), ("p", 0, None), ("p", 9, None)],
                               "part string, pos int, v string")
    got = {(r["part"], r["pos"]): r["o"] for r in pick.forward_fill(df, "part", "pos", "v", "o", chunk=4).collect()}
    assert got == {(None, 0): "x", (None, 5): "x", ("p", 0): None, ("p", 9): None}


def test_zero_as_boolean(spark):
    from pyspark.sql import types as T
    from evalpress.operators.typed import project_typed
    df = spark.sql("SELECT * FROM VALUES (0, 'x'), (3, ''), (null, null) t(n, s)")
    got = [tuple(r) for r in project_typed(df, [("n", T.BooleanType()), ("s", T.BooleanType())]).collect()]
    assert got == [(False, True), (True, None), (None, None)]


def test_verdict_scans_every_string(spark, monkeypatch):
    """A store path in a column outside the shared header, or in a list of the
    run metadata, is a leak of the build verdict."""
    from evalpress.plans import q_marts, runs
    from tests.conftest import SMALL
    marts, table = dict(runs.marts(spark, SMALL)), runs.runs_table
    path = F.lit("/hf_models/x")
    n = marts["tts_de"].count()
    assert n > 0
    clean = q_marts.q_verdict(spark, SMALL).first()["n_leaks"]
    monkeypatch.setattr(runs, "marts", lambda *a: {**marts, "tts_de": marts["tts_de"].withColumn("voice_id", path)})
    monkeypatch.setattr(runs, "runs_table", lambda *a: table(spark, SMALL, marts).withColumn("excluded", F.array(path, path)))
    runs_n = table(spark, SMALL, marts).count()
    assert q_marts.q_verdict(spark, SMALL).first()["n_leaks"] >= clean + n + 2 * runs_n


def test_best_shown_compares_cells(spark):
    rows = [("a", "85%", "120 ms"), ("b", "85%", "—"), ("c", "9%", "99 ms"), ("d", None, "K.O. 3")]
    df = spark.createDataFrame(rows, "name string, rate_cell string, wait_cell string")
    got = pick.best_shown(df, {"rate_cell": "max", "wait_cell": "min"})
    assert got.columns == ["name", "rate_cell", "wait_cell", "best_rate", "best_wait"]
    assert {r["name"]: (r["best_rate"], r["best_wait"]) for r in got.collect()} == {
        "a": (True, False), "b": (True, False), "c": (False, True), "d": (False, False)}
    assert pick.best_shown(df.where("false"), {"rate_cell": "max"}).collect() == []
