"""Queries over all metric tables together: run metadata, unions, counts,
summary, audits of the written dataset, sinks and report-file sources."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalpress.constants import EXPECTED_ROWS, LEAK_RULES
from evalpress.functions import columns as C
from evalpress.operators import audit, lookups as L
from evalpress.operators.publish import raw_field_report
from evalpress.plans import fixtures as fx
from evalpress.plans import modal, runs
from evalpress.plans import sqlfn as S
from evalpress.plans.q_lookups import REG_SQL
from evalpress.plans.registry import query
from evalpress.plans.schemas import RUNS, TABLE_COLUMNS
from evalpress.session import scratch_path
from evalpress.sources import reports_json as RJ
from evalpress.sources import sinks
from evalpress.sources.tables import sf_tag

W = fx.with_
ALL = runs.ALL_MART_CTES
HDR = runs.header_union_sql()


@query("mart_runs", runs.runs_sql())
def q_mart_runs(spark, sf):
    return runs.flatten_runs(runs.runs_table(spark, sf))


@query("union_configs", W(*ALL, HDR) + "SELECT config, run_id FROM hdr")
def q_union_configs(spark, sf):
    return runs.header_union(spark, sf).select("config", "run_id")


@query("project_common_header", W(*ALL, HDR) + "SELECT * FROM hdr")
def q_common_header(spark, sf):
    return runs.header_union(spark, sf)


@query("union_distinct_ids", W(*ALL, HDR) + """SELECT DISTINCT id FROM (
  SELECT model_id AS id FROM hdr UNION ALL SELECT base_model_id FROM hdr) u WHERE id IS NOT NULL""")
def q_union_ids(spark, sf):
    h = runs.header_union(spark, sf)
    return (h.select(F.col("model_id").alias("id")).union(h.select("base_model_id"))
            .where(F.col("id").isNotNull()).distinct())


@query("compose_run_id", W(*ALL, HDR) + """SELECT config, count(*) AS n_rows, count(DISTINCT run_id) AS n_keys,
  count(*) - count(DISTINCT run_id) AS n_duplicates FROM hdr GROUP BY config""")
def q_compose_run_id(spark, sf):
    h = runs.header_union(spark, sf)
    return h.groupBy("config").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("run_id").alias("n_keys")
                                   ).withColumn("n_duplicates", F.col("n_rows") - F.col("n_keys"))


@query("count_per_config", W(*ALL, HDR) + """SELECT coalesce(config, 'total') AS config, count(*) AS n
FROM hdr GROUP BY ROLLUP (config)""")
def q_count_per_config(spark, sf):
    h = runs.header_union(spark, sf)
    return h.rollup("config").agg(F.count(F.lit(1)).alias("n")).select(
        F.coalesce("config", F.lit("total")).alias("config"), "n")


_MAIN_IDS_SQL = "main_ids AS (SELECT DISTINCT model_id AS id FROM hdr WHERE model_id IS NOT NULL)"


@query("anchor_resolution", W(*ALL, HDR, _MAIN_IDS_SQL, fx.FX7_CACHE_SQL,
                              REG_SQL.replace("FROM ids i", "FROM main_ids i")) + """SELECT id, status
FROM reg WHERE status <> 'ok'""")
def q_anchor(spark, sf):
    h = runs.header_union(spark, sf)
    ids = h.select(F.col("model_id").alias("id")).where(F.col("id").isNotNull()).distinct()
    st = L.registry_status(ids, fx.fx7_status_cache(spark, sf), fx.fx7_store(spark, sf), fx.CACHE_MODE)
    return st.where(F.col("status") != "ok").select("id", "status")


def _data_dates(spark, sf):
    """Date texts of the four sources shown in the summary (run names,
    guard file dates, image run directories, TTS suite runs)."""
    m = runs.marts(spark, sf)
    parts = [m["llm_local"].select(F.col("_run").alias("d")), m["llm_saas"].select(F.col("_run").alias("d")),
             m["guardrails"].select(F.col("_mtime").alias("d")), m["t2i"].select(F.col("_run_dir").alias("d")),
             m["tts_de"].select(F.col("_run").alias("d"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _data_date(spark, sf):
    d = _data_dates(spark, sf).agg(F.max(C.date_prefix("d")).alias("_d"))
    return d.crossJoin(fx.feed_date(spark, sf)).select(F.coalesce("_d", "feed_date").alias("data_date"))


DATES_SQL = """dates AS (
  SELECT s.run AS d FROM sized s JOIN local_cohort c USING (run_dir)
  UNION ALL SELECT s.run FROM sized s JOIN saas_cohort c USING (run_dir)
  UNION ALL SELECT mtime FROM fx2 UNION ALL SELECT run_dir FROM img_latest UNION ALL SELECT run FROM fx3_rescore)"""
DATE_SQL = f"data_date AS (SELECT coalesce(max({S.date_prefix('d')}), (SELECT feed_date FROM feed)) AS data_date FROM dates)"


@query("max_data_date", W(*ALL, DATES_SQL, DATE_SQL) + "SELECT data_date FROM data_date")
def q_max_date(spark, sf):
    return _data_date(spark, sf)


def _summary(spark, sf):
    """Run id (local cohort, else SaaS cohort, else unknown), data date and
    counts; every input is one row after a global aggregate."""
    m = runs.marts(spark, sf)

    def n(cfg, alias):
        return m[cfg].agg(F.count(F.lit(1)).alias(alias))

    one = (m["llm_local"].agg(F.max("_run_dir").alias("_loc"), F.count(F.lit(1)).alias("_nl"))
           .crossJoin(m["llm_saas"].agg(F.max("_run_dir").alias("_saas"), F.count(F.lit(1)).alias("_ns")))
           .crossJoin(n("guardrails", "n_guard")).crossJoin(n("t2i", "n_image")).crossJoin(n("tts_de", "n_tts"))
           .crossJoin(_data_date(spark, sf)))
    return one.select(
        F.coalesce("_loc", "_saas", F.lit("unknown")).alias("run"), F.col("data_date").alias("date"),
        (F.col("_nl") + F.col("_ns")).alias("n_llm"), "n_guard", "n_image", "n_tts")


def _summary_json(df):
    return F.to_json(F.struct(F.col("run"), F.col("date"), F.struct(
        F.col("n_llm").alias("llm"), F.col("n_guard").alias("guard"), F.col("n_image").alias("image"),
        F.col("n_tts").alias("tts")).alias("counts")))


SUMMARY_SQL = """summary AS (
  SELECT coalesce((SELECT max(s.run_dir) FROM sized s JOIN local_cohort c USING (run_dir)),
                  (SELECT max(s.run_dir) FROM sized s JOIN saas_cohort c USING (run_dir)), 'unknown') AS run,
         (SELECT data_date FROM data_date) AS date,
         (SELECT count(*) FROM sized s JOIN local_cohort c USING (run_dir))
           + (SELECT count(*) FROM sized s JOIN saas_cohort c USING (run_dir)) AS n_llm,
         (SELECT count(*) FROM fx2) AS n_guard, (SELECT count(*) FROM img_latest) AS n_image,
         (SELECT count(*) FROM fx3_rescore) AS n_tts)"""
SUMMARY_JSON_SQL = ("""'{"run":"' || run || '","date":"' || date || '","counts":{"llm":' || n_llm || ',"guard":' """
                    """|| n_guard || ',"image":' || n_image || ',"tts":' || n_tts || '}}'""")


@query("summary_counts", W(*ALL, DATES_SQL, DATE_SQL, SUMMARY_SQL) +
       f"SELECT run, date, n_llm, n_guard, n_image, n_tts, {SUMMARY_JSON_SQL} AS json FROM summary")
def q_summary(spark, sf):
    s = _summary(spark, sf)
    return s.withColumn("json", _summary_json(s))


# ------------------------------------------------------------------ audits
_EXPECTED_SQL = "expected AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{k}', {v})" for k, v in EXPECTED_ROWS.items()) + ") t(config, expected))"


@query("audit_expected_counts", W(*ALL, HDR, _EXPECTED_SQL) + """SELECT coalesce(a.config, e.config) AS config,
  coalesce(a.actual, 0) AS actual, CAST(e.expected AS INTEGER) AS expected,
  coalesce(a.actual, 0) = coalesce(e.expected, -1) AS ok
FROM (SELECT config, count(*) AS actual FROM hdr GROUP BY config) a FULL OUTER JOIN expected e ON a.config = e.config""")
def q_expected(spark, sf):
    return audit.expected_counts(runs.header_union(spark, sf), EXPECTED_ROWS)


@query("audit_one_to_one", runs.runs_sql([HDR], """SELECT config, CAST(sum(nr) AS BIGINT) AS n_rows,
  CAST(sum(nm) AS BIGINT) AS n_runs, count_if(nr > 0 AND run_id IS NOT NULL) AS n_keys,
  count_if(nr <> 1 OR nm <> 1 OR run_id IS NULL) AS n_unmatched,
  count_if(nr <> 1 OR nm <> 1 OR run_id IS NULL) = 0 AS one_to_one
FROM (SELECT config, run_id, sum(r) AS nr, sum(m) AS nm FROM (
        SELECT config, run_id, 1 AS r, 0 AS m FROM hdr UNION ALL SELECT config, run_id, 0, 1 FROM runs_flat) u
      GROUP BY config, run_id) k GROUP BY config"""))
def q_one_to_one(spark, sf):
    m = runs.marts(spark, sf)
    return audit.one_to_one(runs.header_union(spark, sf, m), runs.runs_table(spark, sf, m))


def _leak_sql(rel: str, cols) -> str:
    """Matches of every leak rule in the text columns ``cols`` of ``rel``."""
    unp = " UNION ALL ".join(f"SELECT {c} AS v FROM {rel}" for c in cols)
    hits = " + ".join(f"count_if(regexp_matches(v, '{p}'))" for _, p in LEAK_RULES)
    return f"(SELECT coalesce({hits}, 0) FROM ({unp}) u WHERE v IS NOT NULL)"


def _strings(cfg) -> list[str]:
    return [c for c, t in TABLE_COLUMNS[cfg] if t == T.StringType()]


#: nested run metadata holds the ids and header texts once more, and constants of this build
_LEAKS_SQL = " + ".join(_leak_sql(runs.MART_CTE[cfg], _strings(cfg)) for cfg in TABLE_COLUMNS)
_COUNTS_SQL = """(SELECT bool_and(coalesce(a.actual, 0) = coalesce(e.expected, -1))
   FROM (SELECT config, count(*) AS actual FROM hdr GROUP BY config) a FULL OUTER JOIN expected e
   ON a.config = e.config)"""


@query("build_verdict", W(*ALL, HDR, _EXPECTED_SQL, fx.FX7_CACHE_SQL,
                          "ids AS (SELECT DISTINCT id FROM (SELECT model_id AS id FROM hdr UNION ALL "
                          "SELECT base_model_id FROM hdr) u WHERE id IS NOT NULL)", REG_SQL,
                          f"leaked AS (SELECT {_LEAKS_SQL} AS n)") + f"""SELECT {_COUNTS_SQL} AS counts_ok,
  (SELECT n FROM leaked) AS n_leaks, (SELECT count(*) FROM reg WHERE status = 'missing') AS n_missing,
  {_COUNTS_SQL} AND (SELECT n FROM leaked) = 0 AND (SELECT count(*) FROM reg WHERE status = 'missing') = 0 AS passed""")
def q_verdict(spark, sf):
    h = runs.header_union(spark, sf)
    counts = audit.expected_counts(h, EXPECTED_ROWS)
    marts = runs.marts(spark, sf)
    leaks = audit.leak_all(runs.runs_table(spark, sf, marts), LEAK_RULES)
    for cfg, columns in TABLE_COLUMNS.items():
        leaks = leaks.unionByName(audit.leak_all(marts[cfg].select(*[c for c, _ in columns]), LEAK_RULES))
    ids = (h.select(F.col("model_id").alias("id")).union(h.select("base_model_id"))
           .where(F.col("id").isNotNull()).distinct())
    st = L.registry_status(ids, fx.fx7_status_cache(spark, sf), fx.fx7_store(spark, sf), fx.CACHE_MODE)
    return audit.verdict(counts, leaks, st)


# ------------------------------------------------------------------- sinks
def _sink_dir(spark, sf, name):
    return scratch_path(spark, "dataset", sf_tag(sf), name)


def _published(spark, sf, name):
    """The five metric tables, each published as the next version of its name
    and read back from its files."""
    out = {}
    for cfg, columns in TABLE_COLUMNS.items():
        df = runs.marts(spark, sf)[cfg].select(*[c for c, _ in columns])
        out[cfg] = sinks.publish_metric_parquet(df, f"{name}-{sf_tag(sf)}-{cfg}", cfg)
    return out


@query("sink_metric_parquet", W(*ALL) + " UNION ALL BY NAME ".join(
    f"SELECT '{cfg}' AS config, {', '.join(c for c, _ in columns)} FROM {runs.MART_CTE[cfg]}"
    for cfg, columns in TABLE_COLUMNS.items()))
def q_sink_parquet(spark, sf):
    """All columns of all five tables, as their files hold them."""
    out = None
    for cfg, df in _published(spark, sf, "metric").items():
        part = df.select(F.lit(cfg).alias("config"), "*")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


@query("src_readback", W(*ALL) + " UNION ALL ".join(
    f"SELECT '{cfg}' AS config, '{c}' AS column_name, count({c}) AS n_nonnull, {i} AS position FROM {runs.MART_CTE[cfg]}"
    for cfg, columns in TABLE_COLUMNS.items() for i, (c, _) in enumerate(columns)))
def q_readback(spark, sf):
    out = None
    for cfg, df in _published(spark, sf, "readback").items():
        part = sinks.column_profile(df).select(F.lit(cfg).alias("config"), "column_name", "n_nonnull", "position")
        out = part if out is None else out.unionByName(part)
    return out


@query("sink_runs_jsonl", runs.runs_sql())
def q_sink_jsonl(spark, sf):
    back = sinks.write_runs_jsonl(runs.runs_table(spark, sf), _sink_dir(spark, sf, "runs_jsonl"), RUNS)
    return runs.flatten_runs(back)


@query("sink_runs_parquet", runs.runs_sql())
def q_sink_runs_parquet(spark, sf):
    back = sinks.write_runs_parquet(runs.runs_table(spark, sf), _sink_dir(spark, sf, "data/runs"))
    return runs.flatten_runs(back)


@query("sink_summary_json", W(*ALL, DATES_SQL, DATE_SQL, SUMMARY_SQL) + f"SELECT {SUMMARY_JSON_SQL} AS json FROM summary")
def q_sink_summary(spark, sf):
    s = _summary(spark, sf)
    body = s.select(F.col("run"), F.col("date"), F.struct(
        F.col("n_llm").alias("llm"), F.col("n_guard").alias("guard"), F.col("n_image").alias("image"),
        F.col("n_tts").alias("tts")).alias("counts"))
    return sinks.write_summary_json(body, _sink_dir(spark, sf, "summary"))


@query("dataset_manifest")
def q_manifest(spark, sf):
    """Files of the built dataset (all tables, run metadata, JSON lines)."""
    from evalpress.plans.build import emit_dataset
    target = _sink_dir(spark, sf, "build")
    emit_dataset(spark, sf, target).collect()
    return sinks.manifest(spark, target)


@query("assert_no_raw_fields")
def q_raw_fields(spark, sf):
    from evalpress.plans.schemas import struct_of
    tables = {k: struct_of(v) for k, v in TABLE_COLUMNS.items()}
    tables["runs"] = RUNS
    tables["tts_summary_feed"] = fx.fx3_summary(spark, sf).schema
    return raw_field_report(spark, tables, exempt=("judge.playbooks.rubric_url",))


# ------------------------------------------------------------ report files
@query("src_report_json", W(fx.FX1_SQL) + """SELECT run_dir, count(DISTINCT stem) AS n_reports, count(*) AS n_cases,
  count_if(verdict = 'error') AS n_errors FROM fx1 GROUP BY run_dir""")
def q_report_json(spark, sf):
    root = RJ.write_reports(spark, sf)
    recs = RJ.valid_records(RJ.read_reports(spark, root))
    cases = RJ.cases_from_records(recs)
    return cases.groupBy("run_dir").agg(F.countDistinct("stem").alias("n_reports"),
                                        F.count(F.lit(1)).alias("n_cases"),
                                        F.count_if(F.col("verdict") == "error").alias("n_errors"))


@query("src_path_select", W(fx.FX1_SQL) + """SELECT run_dir, count(DISTINCT stem) AS n_files
FROM fx1 WHERE run_dir LIKE '2024-%' GROUP BY run_dir""")
def q_path_select(spark, sf):
    root = RJ.write_reports(spark, sf)
    files = RJ.list_report_files(spark, root, dir_glob="2024-*")
    return files.groupBy("run_dir").agg(F.countDistinct("stem").alias("n_files"))


@query("src_file_mtime")
def q_file_mtime(spark, sf):
    root = RJ.write_reports(spark, sf)
    files = RJ.list_report_files(spark, root)
    return files.groupBy("run_dir").agg(F.to_date(F.max("modificationTime")).alias("newest_file_date"))
