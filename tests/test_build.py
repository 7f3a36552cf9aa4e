"""Pipeline-level behaviour on the smallest tables."""
import json
from pathlib import Path

from pyspark.sql import functions as F

from evalpress.constants import CONFIGS
from evalpress.plans import cohorts, roster
from evalpress.plans.build import audit_dataset, emit_dataset, expectations
from evalpress.session import scratch_root
from tests.conftest import SMALL


def test_scratch_root_uses_checkpoint_dir(spark):
    root = scratch_root(spark)
    assert root
    assert spark.sparkContext.getCheckpointDir() is not None


def test_cohorts_split_and_pin(spark):
    classified, sized = cohorts.cohort_table(spark, SMALL)
    kinds = {r["run_dir"]: r["is_saas"] for r in classified.collect()}
    assert True in kinds.values() and False in kinds.values()
    local = cohorts.cohort_rows(spark, SMALL, "local").select("run_dir").distinct().collect()
    assert [r[0] for r in local] == ["2024-01-08"]
    # a gated row never has an error share above 0.3
    assert sized.where(F.col("err") * 10 > F.col("total") * 3).count() == 0


def test_roster_statuses(spark):
    rs = roster.roster_status(spark, SMALL, running=roster.RUNNING_PROFILE)
    statuses = {r[0] for r in rs.select("status").distinct().collect()}
    assert {"valid", "pending"} <= statuses
    assert statuses <= {"valid", "running", "degraded", "pending", "na"}
    # N/A beats a degraded report; a roster row in the valid set is valid
    assert rs.where(F.col("in_valid_set") & (F.col("status") != "valid") & F.col("in_roster")).count() == 0


def test_emit_dataset_verdict(spark, tmp_path):
    row = emit_dataset(spark, SMALL, str(tmp_path / "ds")).first()
    assert row["one_to_one"] is True
    assert row["n_leaks"] == 0 and row["n_missing"] == 0
    written = spark.read.parquet(str(tmp_path / "ds" / "data" / "t2i"))
    assert written.count() > 0


def test_verdict_follows_expectations_and_planted_faults(spark, tmp_path):
    target = str(tmp_path / "ds")
    assert emit_dataset(spark, SMALL, target).first()["counts_ok"] is False  # the fixed counts are of another site
    counts = {c: spark.read.parquet(f"{target}/data/{c}").count() for c in CONFIGS}
    path = tmp_path / "expected.jsonl"
    path.write_text("".join(json.dumps({"config": c, "expected": n}) + "\n" for c, n in counts.items()))
    expected = expectations(spark, str(path))
    good = audit_dataset(spark, SMALL, target, expected).first()
    assert good["passed"] is True and spark.read.text(f"{target}/audit/unmatched_keys").count() == 0

    lines = f"{target}/runs_jsonl"
    first = json.loads(spark.read.text(lines).first()[0])
    planted = Path(lines) / "part-planted.json"
    planted.write_text(json.dumps({**first, "pii_score": 1, "source": "/home/someone/x"}) + "\n")
    bad = audit_dataset(spark, SMALL, target, expected).first()
    assert bad["passed"] is False and bad["one_to_one"] is False and bad["n_leaks"] > 0 and bad["counts_ok"] is True
    listed = spark.read.json(f"{target}/audit/unmatched_keys").collect()
    assert [(r["run_id"], r["n_rows"], r["n_runs"]) for r in listed] == [(first["run_id"], 1, 2)]
    assert audit_dataset(spark, SMALL, target, {**counts, "t2i": counts["t2i"] + 1}).first()["counts_ok"] is False


def test_use_report_files_switches_source(spark, tmp_path):
    import tempfile
    from evalpress.plans import stage
    from evalpress.sources import reports_json as RJ
    sf = SMALL.rstrip("/") + "/"   # a distinct staging key for this test
    root = RJ.write_reports(spark, SMALL, root=tempfile.mkdtemp(prefix="evalpress-src-") + "/r")
    before = cohorts.cohort_rows(spark, SMALL, "local").select("name").collect()
    cohorts.use_report_files(spark, sf, root)
    after = cohorts.cohort_rows(spark, sf, "local").select("name").collect()
    assert sorted(before) == sorted(after)
    stage.replace(spark, sf, "unused", lambda: spark.range(1))


def test_emit_site_tables(spark, tmp_path):
    from evalpress.plans.build import SITE_TABLES, emit_site_tables
    got = {r["table"]: r["rows"] for r in emit_site_tables(spark, SMALL, str(tmp_path / "site")).collect()}
    assert set(got) == set(SITE_TABLES) | {"summary"}
    assert got["summary"] == 1 and all(v > 0 for v in got.values())


def test_run_metadata_is_built_once(spark, tmp_path, monkeypatch):
    """The JSON lines are written from the Parquet files, with the same rows."""
    from evalpress.plans import build
    from evalpress.plans.schemas import RUNS
    write, seen = build.sinks.write_runs_jsonl, []
    monkeypatch.setattr(build.sinks, "write_runs_jsonl", lambda df, *a: seen.append(df.inputFiles()) or write(df, *a))
    target = str(tmp_path / "once")
    emit_dataset(spark, SMALL, target)
    assert seen and all("/data/runs/" in f for f in seen[0])
    lines, files = spark.read.schema(RUNS).json(f"{target}/runs_jsonl"), spark.read.parquet(f"{target}/data/runs")
    assert lines.count() == files.count() > 0 and lines.exceptAll(files).count() == 0
