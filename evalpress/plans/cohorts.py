"""LLM reports: gates, cohorts and the two LLM metric tables.

Spark side and DuckDB side are kept together so the two can be read against
each other.  Stages:

    cases (FX1) -> reports (one row per report, playbook map)
      -> report_rows: allowed playbooks only, case counts folded row-locally
      -> gated: error share <= 0.3, deny-list
      -> cohorts: >= 3 files and >= 3 rows per run directory, SaaS or local
      -> chosen cohort rows -> typed 26-column table
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalpress.constants import (
    HARDWARE_LOCAL, HARDWARE_SAAS, PERF_PLAYBOOK, PLAYBOOK_COLUMN, SERVED_BY,
)
from evalpress.functions import columns as C
from evalpress.operators import gates, pick, publish
from evalpress.plans import fixtures as fx
from evalpress.plans import sqlfn as S
from evalpress.plans.schemas import LLM_COLUMNS
from evalpress.plans.stage import replace, staged

ALLOWED = fx.ALLOWED_PLAYBOOKS


# ------------------------------------------------------------------ Spark
def reports(spark: SparkSession, sf: str) -> DataFrame:
    return fx.fx1_reports(fx.fx1_cases(spark, sf))


def report_rows(spark: SparkSession, sf: str, reps: DataFrame | None = None) -> DataFrame:
    """Every report with case counts over the allowed playbooks and its subject
    (materialised once per session when built from the fixture)."""
    if reps is None:
        return staged(spark, sf, "report_rows", lambda: report_rows(spark, sf, reports(spark, sf)))
    allowed_pb = publish.filter_map_keys("playbooks", ALLOWED)
    total, err = gates.map_case_counts(allowed_pb)
    return reps.select(
        "run_dir", "stem", "model", "source", "profile", "run", "judge", "overall",
        "pass_rate", "knockouts", "total_tests", "playbooks",
        allowed_pb.alias("pb"),
        total.alias("total"), err.alias("err"),
        C.subject_basename("model", "stem").alias("name"),
        (F.col("source") == "saas_proxy").alias("is_saas"),
    )


def deny(spark: SparkSession, sf: str) -> DataFrame:
    """The deny-list, distinct names (materialised once per session)."""
    return staged(spark, sf, "deny", lambda: fx.deny_list(spark, sf).select("name").distinct())


def use_report_files(spark: SparkSession, sf: str, root: str) -> DataFrame:
    """Read the LLM reports from a report file drop (``run_dir=*/stem=*``)
    instead of the events fixture; every LLM query of this session and scale
    folder then runs on the files."""
    from evalpress.sources import reports_json as RJ
    return replace(spark, sf, "report_rows",
                   lambda: report_rows(spark, sf, RJ.reports_from_records(RJ.read_reports(spark, root))))


def gated_rows(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    rows = rows if rows is not None else report_rows(spark, sf)
    kept = gates.gate_error_rate(rows)
    return publish.exclude_subjects(kept, "name", deny(spark, sf))


def cohort_table(spark: SparkSession, sf: str, min_files: int = 3,
                 min_rows: int = 3) -> tuple[DataFrame, DataFrame]:
    """(classified directories, surviving rows), materialised once per
    session and threshold pair; every cohort query reads them.

    One aggregation per run directory gives all three counts at once: candidate
    files, rows surviving the error gate and the deny-list, and SaaS rows among
    them.  The directory table is tiny (one row per run) and is joined back.
    """
    key = f"cohort_{min_files}_{min_rows}"
    rows = report_rows(spark, sf)
    denied = deny(spark, sf).withColumn("_denied", F.lit(True))
    flagged = rows.join(denied, "name", "left")
    ok = gates.error_share_ok() & ~F.coalesce(F.col("_denied"), F.lit(False))

    def classify():
        stats = flagged.groupBy("run_dir").agg(
            F.count(F.lit(1)).alias("n_files"),
            F.count_if(ok).alias("n_rows"),
            F.count_if(ok & F.col("is_saas")).alias("n_flagged"))
        return (stats.where((F.col("n_files") >= min_files) & (F.col("n_rows") >= min_rows))
                .select("run_dir", "n_rows", "n_flagged", (F.col("n_flagged") * 2 >= F.col("n_rows")).alias("is_saas")))

    classified = staged(spark, sf, key + "_dirs", classify)
    # surviving rows: a filter and a semi join over staged tables (the
    # directory table is one row per run, so AQE broadcasts it)
    sized = flagged.where(ok).drop("_denied").join(classified.select("run_dir"), "run_dir", "left_semi")
    return classified, sized


def cohort_rows(spark: SparkSession, sf: str, kind: str, pin: str | None = fx.PINNED_LOCAL_COHORT) -> DataFrame:
    classified, sized = cohort_table(spark, sf)
    chosen = (pick.pick_cohort_pinned(classified, "run_dir", pin) if kind == "local"
              else pick.pick_cohort_latest(classified, "run_dir"))
    return sized.join(F.broadcast(chosen), "run_dir", "left_semi")


def llm_mart(spark: SparkSession, sf: str, config: str) -> DataFrame:
    is_saas = config == "llm_saas"
    r = cohort_rows(spark, sf, "saas" if is_saas else "local")
    meta = fx.fx6_meta(spark, sf).select("name", "hf_repo")
    store = fx.fx7_store(spark, sf).select(F.col("id").alias("model_id"), C.nz("sha").alias("model_revision"))
    r = r.join(meta, "name", "left").crossJoin(F.broadcast(fx.feed_date(spark, sf)))
    basis = C.nz("hf_repo")
    if not is_saas:
        r = r.withColumn("_base_profile", C.strip_variant(F.coalesce("profile", F.lit(""))))
    model_id = basis if is_saas else C.canonical_id("_base_profile")
    datum = F.coalesce(C.date_prefix("run"), F.col("feed_date"))
    perf_text = F.col("playbooks")[PERF_PLAYBOOK]["perf_response"]
    median = C.json_number(perf_text, "throughput_median_tok_s")
    ttft = C.json_number(perf_text, "ttft_p50_ms")
    has_perf = median.isNotNull() | ttft.isNotNull()
    metrics = {
        "n_tests": F.col("total_tests").cast("int"),
        "throughput_tok_s_median": F.when(has_perf, median),
        "throughput_tok_s_mean": F.when(has_perf, C.json_number(perf_text, "throughput_mean_tok_s")),
        "ttft_ms_p50": F.when(has_perf, ttft),
        "perf_threshold_pass": C.normalise_rate(F.col("pb")[PERF_PLAYBOOK]["pass_rate"]),
        "judge_verdict": F.col("overall"),
        "judge_pass_rate_overall": C.normalise_rate("pass_rate"),
    }
    for key, col in PLAYBOOK_COLUMN:
        metrics[f"judge_pass_rate_{col}"] = C.normalise_rate(F.col("pb")[key]["pass_rate"])
        metrics[f"judge_mean_score_{col}"] = F.col("pb")[key]["mean_score"]
    metrics["judge_knockouts"] = F.coalesce(F.col("knockouts"), F.lit(0)).cast("int")
    header = {
        "run_id": C.compose_run_id(F.lit(config), F.col("name"), F.col("run"), datum),
        "model_id": model_id,
        "base_model_id": basis,
        "served_model_ref": F.coalesce(C.nz("profile"), F.col("name")),
        "quantization": F.lit("none") if is_saas else C.quant_label("profile"),
        "served_by": F.lit(SERVED_BY[config]),
        "hardware": F.lit(HARDWARE_SAAS if is_saas else HARDWARE_LOCAL),
        "measured_at": C.strict_date(datum),
        "valid": F.lit(True),
    }
    staged = r.select(*[v.alias(k) for k, v in {**header, **metrics}.items()],
                      F.col("name").alias("_entity"), F.col("judge").alias("_judge"),
                      F.col("run").alias("_run"), F.col("run_dir").alias("_run_dir"))
    out = staged.join(store, "model_id", "left")
    return out.select(*[F.col(c) for c, _ in LLM_COLUMNS], "_entity", "_judge", "_run", "_run_dir")


# ------------------------------------------------------------------- SQL
ALLOWED_IN = fx.sql_in(ALLOWED)

ROWS_SQL = f"""rep_counts AS (
  SELECT run_dir, stem,
         CAST(coalesce(sum(total) FILTER (WHERE playbook IN {ALLOWED_IN}), 0) AS BIGINT) AS total,
         CAST(coalesce(sum(n_error) FILTER (WHERE playbook IN {ALLOWED_IN}), 0) AS BIGINT) AS err
  FROM fx1_pb GROUP BY run_dir, stem),
rows AS (
  SELECT r.*, c.total, c.err, {S.subject('r.model', 'r.stem')} AS name,
         (r.source = 'saas_proxy') AS is_saas
  FROM fx1_rep r JOIN rep_counts c USING (run_dir, stem)),
gated AS (
  SELECT * FROM rows
  WHERE total > 0 AND err * 10 <= total * 3 AND name NOT IN (SELECT name FROM deny)
    AND run_dir IN (SELECT run_dir FROM rows GROUP BY run_dir HAVING count(*) >= 3)),
sized AS (
  SELECT * FROM gated WHERE run_dir IN (SELECT run_dir FROM gated GROUP BY run_dir HAVING count(*) >= 3)),
classified AS (
  SELECT run_dir, count(*) AS n_rows, CAST(sum(CAST(is_saas AS INTEGER)) AS BIGINT) AS n_flagged,
         sum(CAST(is_saas AS INTEGER)) * 2 >= count(*) AS is_saas
  FROM sized GROUP BY run_dir),
local_cohort AS (
  SELECT coalesce(max(run_dir) FILTER (WHERE run_dir = '{fx.PINNED_LOCAL_COHORT}'), max(run_dir)) AS run_dir
  FROM classified WHERE NOT is_saas),
saas_cohort AS (SELECT max(run_dir) AS run_dir FROM classified WHERE is_saas)"""

BASE_SQL = [fx.FX1_SQL, fx.FX1_PB_SQL, fx.FX1_REP_SQL, fx.DENY_SQL, fx.FEED_DATE_SQL, ROWS_SQL]


def pb_wide_sql() -> str:
    cols = []
    for key, col in PLAYBOOK_COLUMN:
        cols.append(f"max(pass_rate) FILTER (WHERE playbook = '{key}') AS pr_{col}")
        cols.append(f"max(mean_score) FILTER (WHERE playbook = '{key}') AS ms_{col}")
    cols.append(f"max(pass_rate) FILTER (WHERE playbook = '{PERF_PLAYBOOK}') AS pr_perf")
    cols.append(f"max(perf_response) FILTER (WHERE playbook = '{PERF_PLAYBOOK}') AS perf_response")
    return f"pbw AS (SELECT run_dir, stem, {', '.join(cols)} FROM fx1_pb GROUP BY run_dir, stem)"


def llm_mart_sql_body(config: str) -> str:
    """SELECT over CTEs BASE_SQL + pbw + store + fx6 producing the 26 columns."""
    is_saas = config == "llm_saas"
    cohort = "saas_cohort" if is_saas else "local_cohort"
    datum = f"coalesce({S.date_prefix('s.run')}, feed.feed_date)"
    model_id = "nullif(m.hf_repo, '')" if is_saas else S.canonical_id(S.strip_variant("coalesce(s.profile, '')"))
    median = S.json_number("w.perf_response", "throughput_median_tok_s")
    ttft = S.json_number("w.perf_response", "ttft_p50_ms")
    has = f"({median} IS NOT NULL OR {ttft} IS NOT NULL)"
    pb_cols = []
    for _key, col in PLAYBOOK_COLUMN:
        pb_cols.append(f"{S.rate(f'w.pr_{col}')} AS judge_pass_rate_{col}")
        pb_cols.append(f"w.ms_{col} AS judge_mean_score_{col}")
    return f"""
  SELECT '{config}' || '/' || s.name || '/' || coalesce(nullif(s.run, ''), {datum}) AS run_id,
         {model_id} AS model_id,
         nullif(m.hf_repo, '') AS base_model_id,
         coalesce(nullif(s.profile, ''), s.name) AS served_model_ref,
         {"'none'" if is_saas else S.quant_label('s.profile')} AS quantization,
         '{SERVED_BY[config]}' AS served_by,
         '{HARDWARE_SAAS if is_saas else HARDWARE_LOCAL}' AS hardware,
         CAST({datum} AS DATE) AS measured_at,
         true AS valid,
         s.total_tests AS n_tests,
         CASE WHEN {has} THEN {median} END AS throughput_tok_s_median,
         CASE WHEN {has} THEN {S.json_number('w.perf_response', 'throughput_mean_tok_s')} END AS throughput_tok_s_mean,
         CASE WHEN {has} THEN {ttft} END AS ttft_ms_p50,
         {S.rate('w.pr_perf')} AS perf_threshold_pass,
         s.overall AS judge_verdict,
         {S.rate('s.pass_rate')} AS judge_pass_rate_overall,
         {', '.join(pb_cols)},
         CAST(coalesce(s.knockouts, 0) AS INTEGER) AS judge_knockouts,
         s.name AS entity, s.judge AS judge
  FROM sized s JOIN {cohort} c ON s.run_dir = c.run_dir
  JOIN pbw w ON s.run_dir = w.run_dir AND s.stem = w.stem
  LEFT JOIN fx6 m ON m.name = s.name
  CROSS JOIN feed"""


def llm_mart_sql(config: str, final: str | None = None) -> str:
    """Full oracle: the mart with the revision joined."""
    body = llm_mart_sql_body(config)
    ctes = BASE_SQL + [pb_wide_sql(), fx.FX6_SQL, fx.FX7_STORE_SQL, f"mart0 AS ({body})"]
    cols = ", ".join(f"mart0.{c}" if c != "model_revision" else "nullif(st.sha, '') AS model_revision"
                     for c, _ in LLM_COLUMNS)
    sel = f"SELECT {cols} FROM mart0 LEFT JOIN store st ON st.id = mart0.model_id"
    if final:
        return fx.with_(*ctes, f"mart AS ({sel})") + final
    return fx.with_(*ctes) + sel
