"""Report files, config text and sinks."""
import os
import tempfile

from pyspark.sql import functions as F

from evalpress.sources import config_text as CT
from evalpress.sources import reports_json as RJ


def test_report_files_skip_malformed(spark):
    root = tempfile.mkdtemp(prefix="evalpress-test-")
    d = os.path.join(root, "run_dir=2024-01-01")
    for stem, body in (("good", '{"meta": {"model": "m"}, "playbooks": {"01_quality": {"results": '
                                '[{"test_id": "t1", "verdict": "error"}]}}}'),
                       ("empty", "{}"), ("broken", '{"meta": {"model": '), ("dashboard", '{"meta": {}}')):
        os.makedirs(os.path.join(d, f"stem={stem}"))
        with open(os.path.join(d, f"stem={stem}", "r.json"), "w") as f:
            f.write(body + "\n")
    recs = RJ.valid_records(RJ.read_reports(spark, root))
    # a data column must be read with the corrupt-record column (Spark rule)
    assert sorted(r["stem"] for r in recs.select("stem", "meta").collect()) == ["empty", "good"]
    cases = RJ.cases_from_records(recs)
    assert [tuple(r) for r in cases.select("stem", "verdict").collect()] == [("good", "error")]
    files = RJ.list_report_files(spark, root)
    assert sorted(r["stem"] for r in files.collect()) == ["broken", "empty", "good"]


def test_line_records_last_block_wins(spark):
    lines = ['- name: "a"', '  license: MIT', '  license: x # note', '- name: "b"', '  hf_repo: o/b',
             '- name: "a"', '  release_date: 2024-05']
    df = spark.createDataFrame([("doc", i, l) for i, l in enumerate(lines)], "doc string, pos long, line string")
    got = {r["name"]: (r["license"], r["hf_repo"], r["release_date"]) for r in CT.line_records(df).collect()}
    assert got == {"a": (None, None, "2024-05"), "b": (None, "o/b", None)}


def test_first_child_only(spark):
    lines = ['  - name: "m1"', '    dir: first', '    dir: second', '  - name: "m2"', '    note: x',
             '    dir: late']
    df = spark.createDataFrame([("doc", i, l) for i, l in enumerate(lines)], "doc string, pos long, line string")
    got = {r["name"]: r["dir"] for r in CT.first_child(df).collect()}
    assert got == {"m1": "first", "m2": "late"}


def test_blocks_and_keyed_json(spark):
    df = spark.createDataFrame([(1, 'pre<li><a href="/x">X</a><li>plain')], "id int, html string")
    b = CT.split_blocks(df, "html", "<li>", ["id"]).select(
        "block_no", CT.block_field("block", 'href="([^"]+)"').alias("href")).collect()
    assert [tuple(r) for r in b] == [(1, "/x"), (2, None)]
    from pyspark.sql import types as T
    j = spark.createDataFrame([('{"a/b": {"sha": "1"}, "c/d": {"sha": ""}}',), ('{"broken": ',)], "t string")
    got = {r["id"]: r["sha"] for r in CT.keyed_json(j, "t", T.StructType([T.StructField("sha", T.StringType())])).collect()}
    assert got == {"a/b": "1", "c/d": ""}


def test_sinks_roundtrip(spark):
    from evalpress.sources import sinks
    root = tempfile.mkdtemp(prefix="evalpress-sink-")
    df = spark.createDataFrame([("r1", None, 1), ("r2", "x", None)], "run_id string, note string, n int")
    back = sinks.write_runs_jsonl(df, root + "/runs_jsonl", df.schema)
    assert sinks.same_rows(df, back).count() == 0
    text = spark.read.text(root + "/runs_jsonl").collect()
    assert any('"note":null' in r[0] for r in text)
    pq = sinks.write_runs_parquet(df, root + "/runs_parquet")
    assert sinks.same_rows(pq, back).count() == 0
    m = sinks.manifest(spark, root + "/runs_parquet")
    assert m.where(F.col("rel_path").endswith(".parquet")).count() >= 1


def test_reports_from_files_match_fixture(spark):
    from evalpress.plans import fixtures as fx
    from evalpress.plans import cohorts
    from tests.conftest import SMALL
    root = RJ.write_reports(spark, SMALL, root=tempfile.mkdtemp(prefix="evalpress-rep-") + "/r")
    from_files = cohorts.report_rows(spark, SMALL, RJ.reports_from_records(RJ.read_reports(spark, root)))
    from_fixture = cohorts.report_rows(spark, SMALL, fx.fx1_reports(fx.fx1_cases(spark, SMALL)))
    cols = ["run_dir", "stem", "name", "is_saas", "total", "err", "pass_rate", "overall", "knockouts", "run"]
    a, b = from_files.select(*cols), from_fixture.select(*cols)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0
    pa = from_files.select("run_dir", "stem", F.explode("pb").alias("k", "v")).select(
        "run_dir", "stem", "k", "v.pass_rate", "v.mean_score", "v.n_error", "v.perf_response")
    pb = from_fixture.select("run_dir", "stem", F.explode("pb").alias("k", "v")).select(
        "run_dir", "stem", "k", "v.pass_rate", "v.mean_score", "v.n_error", "v.perf_response")
    assert pa.exceptAll(pb).count() == 0 and pb.exceptAll(pa).count() == 0


def test_ingest_to_parquet_roundtrip(spark):
    from tests.conftest import SMALL
    scratch = tempfile.mkdtemp(prefix="evalpress-ing-")
    root = RJ.write_reports(spark, SMALL, root=scratch + "/r")
    ing = RJ.ingest_to_parquet(spark, root, scratch + "/pq")
    a = RJ.reports_from_records(ing)
    b = RJ.reports_from_records(RJ.read_reports(spark, root))
    cols = ["run_dir", "stem", "model", "pass_rate", "total_tests"]
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0
    assert a.count() == b.count()


def test_report_files_without_an_index_of_all_files(spark):
    """Names as Spark reads them, lines in ranges of bytes, nothing kept on the driver."""
    root = tempfile.mkdtemp(prefix="evalpress-many-")
    rows = [("2024-01-01", f"u{i}", f"s{i % 3}") for i in range(40)] + [("2024-01-08", "a/b=c %1", "long"), ("2025-01-06", "u1", "x")]
    recs = spark.createDataFrame(rows, "run_dir string, stem string, source string").select(
        "run_dir", "stem", F.struct(F.lit("m").alias("model"), "source").alias("meta"),
        F.struct(F.when(F.col("source") == "long", 9).alias("total_tests")).alias("summary"), F.create_map().cast("map<string,string>").alias("playbooks"))
    recs = recs.withColumn("n", F.explode(F.sequence(F.lit(1), F.when(F.col("meta.source") == "long", 50).otherwise(2)))).drop("n")
    assert RJ.write_files(recs, root, most=100) == 42
    os.makedirs(f"{root}/run_dir=2024-01-01/stem=broken")
    with open(f"{root}/run_dir=2024-01-01/stem=broken/part-0.txt", "w") as f:
        f.write('{"meta": {"model": \n\n')
    with open(f"{root}/run_dir=2024-01-01/stem=u1/.half", "w") as f:
        f.write("{}\n")
    index = spark.read.schema(RJ.READ_SCHEMA).option("columnNameOfCorruptRecord", "_corrupt").option("basePath", root).json(root)
    want = sorted(map(tuple, index.select("run_dir", "stem", "meta.model", "meta.source", "summary.total_tests", "_corrupt").collect()), key=str)
    got = RJ.read_reports(spark, root).select("run_dir", "stem", "meta.model", "meta.source", "summary.total_tests", "_corrupt")
    assert sorted(map(tuple, got.collect()), key=str) == want and len(want) == 40 * 2 + 50 + 2 + 1
    for size in (1, 7, 64):
        lines = RJ.local_lines(spark, root, size=size).groupBy("stem").count().collect()
        assert {r["stem"]: r["count"] for r in lines} == {**{f"u{i}": 2 for i in range(40)}, "u1": 4, "a/b=c %1": 50, "broken": 1}
    files = RJ.list_report_files(spark, root, "2024-*")
    assert "binaryFile" not in files._jdf.queryExecution().toString()
    assert files.count() == 41 and files.where("length > 0 and modificationTime > '2024-01-01'").count() == 41
    assert RJ.list_report_files(spark, root, "1999-*").count() == 0


def test_large_report_is_dealt_out_over_files(spark):
    root = tempfile.mkdtemp(prefix="evalpress-hot-")
    recs = spark.range(600).select(
        F.lit("d").alias("run_dir"), F.lit("u").alias("stem"), F.struct(F.col("id").cast("string").alias("model")).alias("meta"),
        F.struct(F.lit(1000).alias("total_tests")).alias("summary"), F.create_map().cast("map<string,string>").alias("playbooks"))
    assert RJ.write_files(recs, root, most=100) == 11
    assert RJ.read_reports(spark, root).select("meta.model").distinct().count() == 600
    assert max(r["count"] for r in RJ.local_lines(spark, root).groupBy("file").count().collect()) < 120
