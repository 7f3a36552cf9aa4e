"""End-to-end dataset build: the five metric tables, run metadata (Parquet and
JSON lines), the summary, then audits over what was written.

    python -m evalpress.plans.build --sf /root/testdata/sf0.1 [--target DIR]

Everything is written below ``target`` (default: the shared scratch folder);
the verdict is one row read back from the written files.
"""
from __future__ import annotations

import argparse
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalpress.constants import CONFIGS, EXPECTED_ROWS, LEAK_RULES, WITHHELD_FIELD_PATTERN
from evalpress.operators import audit, lookups as L
from evalpress.operators.publish import assert_no_raw_fields
from evalpress.plans import fixtures as fx
from evalpress.plans import runs
from evalpress.plans.schemas import HEADER, RUNS, TABLE_COLUMNS
from evalpress.session import scratch_path
from evalpress.sources import sinks
from evalpress.sources.tables import sf_tag


def emit_dataset(spark: SparkSession, sf: str, target: str | None = None,
                 expected: Mapping[str, int] | DataFrame = EXPECTED_ROWS) -> DataFrame:
    """Write the dataset and return the one-row verdict of ``audit_dataset``."""
    target = target or scratch_path(spark, "dataset_build", sf_tag(sf))
    marts = runs.marts(spark, sf)
    for cfg in CONFIGS:
        cols = [c for c, _ in TABLE_COLUMNS[cfg]]
        df = marts[cfg].select(*cols)
        assert_no_raw_fields(df, cfg)
        sinks.write_metric_parquet(df, f"{target}/data/{cfg}", cfg)
    # the lines are written from the files, so run metadata is built once
    run_meta = sinks.write_runs_parquet(runs.runs_table(spark, sf, marts), f"{target}/data/runs")
    sinks.write_runs_jsonl(run_meta, f"{target}/runs_jsonl", RUNS)
    return audit_dataset(spark, sf, target, expected)


def expectations(spark: SparkSession, path: str) -> DataFrame:
    """The expected rows of every config, from JSON lines (config, expected)."""
    return spark.read.schema("config string, expected int").json(path)


def audit_dataset(spark: SparkSession, sf: str, target: str, expected: Mapping[str, int] | DataFrame = EXPECTED_ROWS) -> DataFrame:
    """The one-row verdict of a written dataset, from its files alone: rows per
    config as ``expected``, one run per row, no leak in a value or a line of
    text, no withheld column or key, no id that the registry misses.  Keys that
    are not exactly once on both sides are listed in ``audit/unmatched_keys``."""
    written = {cfg: spark.read.parquet(f"{target}/data/{cfg}") for cfg in CONFIGS}
    jsonl = spark.read.schema(RUNS).json(f"{target}/runs_jsonl")
    header = None
    for cfg in CONFIGS:
        part = written[cfg].select(F.lit(cfg).alias("config"), *[c for c, _ in HEADER])
        header = part if header is None else header.unionByName(part)
    counts = audit.expected_counts(header, expected)
    leaks = audit.leak_all(jsonl, LEAK_RULES)
    for cfg in CONFIGS:
        leaks = leaks.unionByName(audit.leak_all(written[cfg], LEAK_RULES))
    in_files = audit.leak_files(spark, f"{target}/runs_jsonl", LEAK_RULES).groupBy("file", "rule").agg(F.count(F.lit(1)).alias("n"))
    leaks = leaks.unionByName(in_files.withColumnRenamed("file", "column_name"))
    ids = (header.select(F.col("model_id").alias("id")).union(header.select("base_model_id"))
           .where(F.col("id").isNotNull()).distinct())
    status = L.registry_status(ids, fx.fx7_status_cache(spark, sf), fx.fx7_store(spark, sf), fx.CACHE_MODE)
    # names of every column of the written tables, and of every key in the written lines
    tables = {**{cfg: written[cfg].schema for cfg in CONFIGS}, "runs": spark.read.parquet(f"{target}/data/runs").schema}
    fields = audit.field_names(spark, tables, WITHHELD_FIELD_PATTERN).select("withheld")
    lines = audit.json_paths(spark.read.text(f"{target}/runs_jsonl"), "value")
    fields = fields.unionByName(lines.select(audit.withheld("key", WITHHELD_FIELD_PATTERN).alias("withheld")))
    audit.unmatched_keys(header, jsonl, config="config").write.mode("overwrite").json(f"{target}/audit/unmatched_keys")
    return audit.verdict(counts, leaks, status, fields, audit.one_to_one(header, jsonl))


SITE_TABLES = ("report_llm_local", "report_llm_saas", "report_guards", "report_image", "report_tts")


def emit_site_tables(spark: SparkSession, sf: str, target: str | None = None) -> DataFrame:
    """The display tables and the summary as JSON lines (the data of the
    overview page); returns one row per written table with its row count,
    read back from the files."""
    from evalpress.plans.registry import QUERIES
    from evalpress.plans import catalog  # noqa: F401  (registers the queries)
    from evalpress.plans.q_marts import q_sink_summary
    target = target or scratch_path(spark, "site", sf_tag(sf))
    out = None
    for name in SITE_TABLES:
        back = sinks.write_runs_jsonl(QUERIES[name](spark, sf), f"{target}/{name}", None)
        part = back.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = part if out is None else out.unionByName(part)
    summary = q_sink_summary(spark, sf)
    return out.unionByName(summary.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("summary").alias("table"), "rows"))


def main() -> None:
    ap = argparse.ArgumentParser(description="Build the evaluation dataset.")
    ap.add_argument("--sf", required=True)
    ap.add_argument("--target", default=None)
    ap.add_argument("--reports", default=None, help="read LLM reports from this file drop")
    ap.add_argument("--expected", default=None, help="JSON lines with the expected rows of every config")
    ap.add_argument("--site", action="store_true", help="also write the display tables and summary")
    a = ap.parse_args()
    from evalpress.session import build_session
    spark = build_session()
    if a.reports:
        from evalpress.plans.cohorts import use_report_files
        use_report_files(spark, a.sf, a.reports)
    expected = expectations(spark, a.expected) if a.expected else EXPECTED_ROWS
    row = emit_dataset(spark, a.sf, a.target, expected).first().asDict()
    print(json.dumps(row))
    if a.site:
        site = a.target + "/site" if a.target else None
        print(json.dumps({r["table"]: r["rows"] for r in emit_site_tables(spark, a.sf, site).collect()}))
    if not row["passed"]:
        raise SystemExit("the dataset did not pass its audit")


if __name__ == "__main__":
    main()
