"""Whole-file feeds, lists that fail closed, versioned state, raw fields at any
depth, discovered keys and the scan of written files."""
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalpress.operators import audit, pick, publish
from evalpress.operators.versions import Versions
from evalpress.plans import fixtures as fx
from evalpress.sources import feeds, lists
from evalpress.sources import reports_json as RJ
from tests.conftest import SMALL


def _drop(root, name, body):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(body if isinstance(body, str) else json.dumps(body, indent=2))


def test_real_file_drop(spark):
    root = tempfile.mkdtemp(prefix="evalpress-test-")
    _drop(root, "img/2026-01-02_a/summary.json", {"model": "a", "cases": 3, "generated": 2, "failed": 1})
    _drop(root, "img/2026-01-03_b/summary.json", '{"model": "b", ')
    _drop(root, "tts/2026-01-01_suite_x/rescore_judge2.json", {"run": "2026-01-01_suite_x", "wer_judge2_mean": 0.5})
    _drop(root, "tts/2026-01-01_suite_x/summary.json", {"tts_model": "own/eng", "n_error": 0})
    _drop(root, "tts/2026-01-02_suite_y/rescore_judge2.json", {"run": "2026-01-02_suite_y"})
    _drop(root, "guards/g.json", [{"label": "g1", "metrics": {"f1": 0.25, "confusion": {"tp": 1}}}, {"label": "g2", "mtime": "2026-02-02"}])
    got = feeds.images(spark, f"{root}/img", "*_*/summary.json").collect()
    assert [(r["run_dir"], r["model"], r["failed"]) for r in got] == [("2026-01-02_a", "a", 1)]
    bad = feeds.bad_files(feeds.whole_files(spark, f"{root}/img/*/*.json", feeds.IMAGE_FILE)).collect()
    assert len(bad) == 1 and bad[0]["path"].endswith("2026-01-03_b/summary.json")
    rescore, summary = feeds.tts(spark, f"{root}/tts")
    j = {r["dir"]: r["tts_model"] for r in rescore.join(summary, "dir", "left").collect()}
    assert j == {"2026-01-01_suite_x": "own/eng", "2026-01-02_suite_y": None}
    g = {r["label"]: r for r in feeds.guards(spark, f"{root}/guards", "*.json").collect()}
    assert g["g1"]["metrics"]["confusion"]["tp"] == 1 and g["g2"]["mtime"] == "2026-02-02" and len(g["g1"]["mtime"]) == 10


def test_absent_feed_is_empty_and_typed(spark):
    root = tempfile.mkdtemp(prefix="evalpress-test-")
    for d in (feeds.guards(spark, f"{root}/none"), feeds.images(spark, f"{root}/none"), *feeds.tts(spark, f"{root}/none")):
        assert d.collect() == []
    assert feeds.images(spark, f"{root}/none").schema == feeds.IMAGE_FILE


def test_pretty_llm_report(spark):
    """One object per file over many lines: list order without positions, and
    the total as the report states it."""
    root = tempfile.mkdtemp(prefix="evalpress-test-")
    results = [{"test_id": "t", "verdict": "pass", "response": "z"}, {"test_id": "perf_benchmark", "verdict": "pass", "response": "second"},
               {"test_id": "perf_benchmark", "verdict": "pass", "response": "a later one"}]
    _drop(root, "2026-03-01/m1.json", {"meta": {"model": "m1"}, "playbooks": {"05_code": {"total": 40, "passed": 39, "results": results}}})
    _drop(root, "2026-03-01/m2.json", '{"meta": {"model": "m2"}, "playbooks": ')
    _drop(root, "2026-03-01/dashboard.json", {"meta": {"model": "no"}, "playbooks": {"05_code": {"results": []}}})
    recs = RJ.read_whole_reports(spark, root)
    rep = RJ.reports_from_records(recs).collect()
    assert [(r["run_dir"], r["stem"], r["model"]) for r in rep] == [("2026-03-01", "m1", "m1")]
    pb = rep[0]["playbooks"]["05_code"]
    assert pb["perf_response"] == "second" and pb["total"] == 40
    assert [r["path"][-7:] for r in feeds.bad_files(recs.select("meta", "_corrupt", "path")).collect()] == ["m2.json"]


def test_feeds_equal_the_fixtures(spark):
    root = tempfile.mkdtemp(prefix="evalpress-test-")
    g = fx.fx2_guards(spark, SMALL)
    back = feeds.guards(spark, feeds.write_each(g.withColumn("file", F.col("label")), root + "/g", "file", feeds.GUARD_FILE.names))
    a, b = ({r["label"]: r.asDict(True) for r in d.select(*feeds.GUARD_FILE.names).collect()} for d in (g, back))
    assert a == b and len(a) > 5
    text = spark.read.text(root + "/g").count()
    assert text > 20 * len(a)  # many lines a report
    i = fx.fx4_images(spark, SMALL)
    back = feeds.images(spark, feeds.write_arrays(i, root + "/i", "run_dir", feeds.IMAGE_FILE.names, per_file=50))
    assert sorted(map(tuple, i.select(*feeds.IMAGE_FILE.names).collect())) == sorted(map(tuple, back.collect()))


def test_lists_fail_closed(spark):
    root = tempfile.mkdtemp(prefix="evalpress-test-")
    _drop(root, "pb.txt", '# released\nname: no entry\n- name: "a"\n  public: true\n- name: b # c\n  public: false\n'
                          '- name: "c"\n  note: x\n  public: true # yes\n- name: "a"\n  public: true\n')
    _drop(root, "none.txt", "# nothing here\n")
    names = lists.read_list(spark, root + "/pb.txt", "public")
    assert sorted(r["name"] for r in names.collect()) == ["a", "c"]
    assert sorted(r["name"] for r in lists.read_list(spark, root + "/pb.txt").collect()) == ["a", "b", "c"]
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,), ("a",)], "p string")
    assert sorted(r["p"] for r in lists.keep_listed(df, "p", names).collect()) == ["a", "a", "c"]
    assert sorted(str(r["p"]) for r in lists.drop_listed(df, "p", names).collect()) == ["None", "b"]
    empty = lists.read_list(spark, root + "/none.txt")
    for use in (lists.keep_listed, lists.drop_listed):
        plan = use(df, "p", empty)  # nothing runs yet
        with pytest.raises(Exception, match="has no entry"):
            plan.collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lists.read_list(spark, root + "/missing.txt").collect()


def test_versions(spark):
    schema = T.StructType.fromDDL("k long, v string")
    v = Versions(spark, "test-" + os.urandom(4).hex(), schema)
    assert v.newest() == (0, None, 0) and v.read().collect() == []
    rows = lambda d: sorted((r["k"], r["v"]) for r in d.collect())
    one = v.publish(spark.createDataFrame([(1, "a"), (2, "b")], schema))
    assert v.newest()[0] == 1 and v.newest()[2] == 2 and rows(v.read()) == [(1, "a"), (2, "b")]
    v.upsert(spark.createDataFrame([(2, "c"), (3, "d")], schema), "k")
    assert v.newest()[0] == 2 and rows(v.read()) == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(one) == [(1, "a"), (2, "b")]  # a reader of the version before keeps its files
    with pytest.raises(Exception):
        v.publish(spark.range(3).select(F.col("id").alias("k"), F.raise_error(F.lit("boom")).cast("string").alias("v")))
    assert v.newest()[0] == 2 and rows(v.read()) == [(1, "a"), (2, "c"), (3, "d")]


def test_second_run_changes_no_stamp(spark):
    from evalpress.operators.state import change_date
    schema = T.StructType.fromDDL("doc_id long, hash string, stamp string, change string")
    state = Versions(spark, "test-" + os.urandom(4).hex(), schema)

    def run(texts, day):
        df = spark.createDataFrame(texts, "doc_id long, text string")
        out = state.publish(change_date(df, state.read(), "doc_id", F.sha2("text", 256), F.lit(day)))
        return {r["doc_id"]: (r["stamp"], r["change"]) for r in out.collect()}

    assert run([(1, "a"), (2, "b")], "d1") == {1: ("d1", "new"), 2: ("d1", "new")}
    assert run([(1, "a"), (2, "b")], "d2") == {1: ("d1", "unchanged"), 2: ("d1", "unchanged")}
    assert run([(1, "a"), (2, "B")], "d3") == {1: ("d1", "unchanged"), 2: ("d3", "changed")}


def test_raw_fields_go_at_any_depth(spark):
    raw = sorted(publish.RAW_FIELDS)[0]
    df = spark.sql(f"""SELECT 1 AS id, array(named_struct('ok', 1, '{raw}', 'x', 'in', array(named_struct('{raw}', 'y', 'n', 2)))) AS l,
      map('k', named_struct('{raw}', 'z', 'm', 3)) AS m, named_struct('a', named_struct('{raw}', 'w', 'b', 4)) AS s,
      CAST(NULL AS array<struct<{raw}: string, q: int>>) AS nothing, 'top' AS {raw}""")
    out = publish.drop_raw_fields(df)
    assert publish.raw_paths(out.schema) == [] and publish.raw_paths(df.schema)
    r = out.first().asDict(True)
    assert r == {"id": 1, "l": [{"ok": 1, "in": [{"n": 2}]}], "m": {"k": {"m": 3}}, "s": {"a": {"b": 4}}, "nothing": None}
    kept = publish.drop_raw_fields(df, exempt=(f"s.a.{raw}",))
    assert kept.first()["s"]["a"][raw] == "w"


def test_unknown_metric_is_discovered(spark):
    df = spark.createDataFrame([
        ("b", '{"f1": 0.5, "brand_new": 3, "text": "7", "flag": true, "nested": {"x": 1}, "none": null}'),
        ("a", '{"zeta": 1e3, "f1": 1, "hidden": 2}'), ("c", "not json"), ("d", None), ("e", "[1]"), ("f", '{"none": 4}')], "label string, j string")
    got = {r["key"]: (r["first_row"], r["first_kpos"]) for r in pick.discover_json_keys(df, "j", "label", ("hidden",)).collect()}
    assert got == {"zeta": ("a", 0), "f1": ("a", 1), "brand_new": ("b", 1), "none": ("f", 0)}


def test_leaks_in_every_kind_of_cell(spark):
    rules = (("path", r"/secret/\w+"), ("mail", r"\w+@\w+"))
    df = spark.sql("""SELECT * FROM VALUES (1, '/secret/a', array('x', '/secret/b', 'm@n'), map('k', '/secret/c'),
      array(named_struct('t', array('/secret/d', 'q'))), array(map('k', 'u@v'))), (2, NULL, NULL, NULL, NULL, NULL) AS t(id, s, a, m, l, am)""")
    got = {(r["column_name"], r["rule"]): r["n"] for r in audit.leak_all(df, rules).collect()}
    assert got == {("s", "path"): 1, ("a", "path"): 1, ("a", "mail"): 1, ("m", "path"): 1, ("l.t", "path"): 1, ("am", "mail"): 1}


def test_leak_in_a_written_file_is_found(spark):
    root = tempfile.mkdtemp(prefix="evalpress-test-")
    df = spark.createDataFrame([("r1", "fine"), ("r2", "see /secret/store")], "run_id string, note string")
    df.coalesce(1).write.mode("overwrite").json(root + "/runs_jsonl")
    got = audit.leak_files(spark, root + "/runs_jsonl", (("path", r"/secret/\w+"),)).collect()
    assert [(r["rule"], r["match"]) for r in got] == [("path", "/secret/store")] and "/runs_jsonl/part-" in got[0]["file"]


def test_key_paths_at_any_depth(spark):
    df = spark.createDataFrame([('{"a": 1, "b": {"pii_score": 2, "c": [{"d": {"e": 1}}, {"f": 2}, [3]]}}',), ('{"a": null}',),
                                ("no json",), (None,), ('[{"z": 1}]',)], "j string")
    keys = audit.json_paths(df, "j")
    assert {r["key"]: r["n"] for r in keys.collect()} == {"a": 2, "b": 1, "b.pii_score": 1, "b.c": 1, "b.c[].d": 1, "b.c[].d.e": 1, "b.c[].f": 1}
    flagged = {r["key"] for r in keys.where(audit.withheld("key", "^pii_")).collect()}
    assert flagged == {"b.pii_score"}
    assert audit.json_paths(df.where("j = 'no json'"), "j").collect() == []


def test_verdict_turns_on_each_fault(spark):
    def verdict(ok=True, leaks=0, status="ok", held=False):
        return audit.verdict(spark.createDataFrame([(ok,)], "ok boolean"), spark.createDataFrame([(leaks,)], "n long"),
                             spark.createDataFrame([(status,)], "status string"),
                             spark.createDataFrame([(held,)], "withheld boolean")).first()["passed"]

    assert verdict() is True
    assert [verdict(ok=False), verdict(leaks=1), verdict(status="missing"), verdict(held=True)] == [False] * 4
