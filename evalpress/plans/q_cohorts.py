"""Queries over the LLM reports (FX1): filters, gates, cohorts, LLM marts and
the column jobs whose query runs over FX1."""
from __future__ import annotations

from pyspark.sql import functions as F

from evalpress.constants import PERF_TEST_ID
from evalpress.functions import columns as C
from evalpress.operators import gates, pick, publish
from evalpress.plans import fixtures as fx
from evalpress.plans import cohorts
from evalpress.plans import sqlfn as S
from evalpress.plans.registry import query
from evalpress.plans.schemas import LLM_COLUMNS
from evalpress.session import scratch_path
from evalpress.sources import lists
from evalpress.sources.tables import sf_tag

W = fx.with_
BASE = cohorts.BASE_SQL
ALLOWED = fx.ALLOWED_PLAYBOOKS
ALLOWED_IN = cohorts.ALLOWED_IN


def _slice(spark, sf):
    rows = cohorts.cohort_rows(spark, sf, "local")
    return rows.select("run_dir", "name", "stem", C.normalise_rate("pass_rate").alias("pass_rate"))


SLICE_SQL = W(*BASE) + f"""SELECT s.run_dir, s.name, s.stem, {S.rate('s.pass_rate')} AS pass_rate
FROM sized s JOIN local_cohort c ON s.run_dir = c.run_dir"""

query("pick_cohort_pinned", SLICE_SQL)(_slice)


@query("pick_cohort_latest", W(*BASE) + f"""SELECT s.run_dir, s.name, s.stem, {S.rate('s.pass_rate')} AS pass_rate
FROM sized s JOIN saas_cohort c ON s.run_dir = c.run_dir""")
def q_pick_latest(spark, sf):
    rows = cohorts.cohort_rows(spark, sf, "saas")
    return rows.select("run_dir", "name", "stem", C.normalise_rate("pass_rate").alias("pass_rate"))


@query("filter_public_playbooks", W(fx.FX1_SQL) + f"""SELECT run_dir, playbook, count(*) AS n_cases
FROM fx1 WHERE playbook IN {ALLOWED_IN} GROUP BY run_dir, playbook""")
def q_filter_public(spark, sf):
    """The allow-list is read from its text, where every playbook has a block
    and the released ones say so."""
    cases = fx.fx1_cases(spark, sf)
    seen = cases.select("playbook").distinct().withColumn("public", F.col("playbook").isin(list(ALLOWED)))
    path = lists.write_list(seen, scratch_path(spark, "lists", sf_tag(sf), "playbooks"), "playbook", "public", "public")
    kept = lists.keep_listed(cases, "playbook", lists.read_list(spark, path, "public"))
    return kept.groupBy("run_dir", "playbook").agg(F.count(F.lit(1)).alias("n_cases"))


@query("filter_excluded_models", W(*BASE) + """SELECT run_dir, count(*) AS n_reports
FROM rows WHERE name NOT IN (SELECT name FROM deny) GROUP BY run_dir""")
def q_filter_excluded(spark, sf):
    """The deny-list is read from its text."""
    path = lists.write_list(fx.deny_list(spark, sf), scratch_path(spark, "lists", sf_tag(sf), "excluded"), "name")
    rows = lists.drop_listed(cohorts.report_rows(spark, sf), "name", lists.read_list(spark, path))
    return rows.groupBy("run_dir").agg(F.count(F.lit(1)).alias("n_reports"))


@query("agg_case_counts", W(*BASE) + "SELECT run_dir, stem, total, err FROM rows")
def q_case_counts(spark, sf):
    return cohorts.report_rows(spark, sf).select("run_dir", "stem", "total", "err")


@query("gate_error_rate", W(*BASE) + """SELECT run_dir, stem, total, err FROM rows
WHERE total > 0 AND err * 10 <= total * 3""")
def q_gate(spark, sf):
    return gates.gate_error_rate(cohorts.report_rows(spark, sf)).select("run_dir", "stem", "total", "err")


@query("scan_report_validity", W(*BASE) + """SELECT run_dir, name, arg_max(stem, stem) AS stem,
  arg_max(total, stem) AS total, arg_max(err, stem) AS err,
  arg_max(CASE WHEN total > 0 THEN CAST(err AS DOUBLE) / total ELSE 1.0 END, stem) AS err_rate,
  arg_max(total > 0 AND err * 10 <= total * 3, stem) AS valid
FROM rows WHERE NOT is_saas AND name NOT IN (SELECT name FROM deny) GROUP BY run_dir, name""")
def q_validity(spark, sf):
    rows = cohorts.report_rows(spark, sf).where(~F.col("is_saas"))
    rows = publish.exclude_subjects(rows, "name", cohorts.deny(spark, sf))
    v = gates.validity(rows.select("run_dir", "name", "stem", "total", "err"))
    return pick.latest_per_key(v, ["run_dir", "name"], ["stem"])


@query("gate_min_cohort", W(*BASE) + """SELECT f.run_dir, f.n_files, coalesce(g.n_rows, 0) AS n_rows,
  (f.n_files >= 3 AND coalesce(g.n_rows, 0) >= 3) AS kept
FROM (SELECT run_dir, count(*) AS n_files FROM rows GROUP BY run_dir) f
LEFT JOIN (SELECT run_dir, count(*) AS n_rows FROM gated GROUP BY run_dir) g USING (run_dir)""")
def q_min_cohort(spark, sf):
    rows = cohorts.report_rows(spark, sf)
    files = gates.cohort_sizes(rows, "run_dir", "n_files")
    g = cohorts.gated_rows(spark, sf, rows)
    g = g.join(files.where(F.col("n_files") >= 3).select("run_dir"), "run_dir", "left_semi")
    n = gates.cohort_sizes(g, "run_dir", "n_rows")
    out = files.join(n, "run_dir", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    return out.withColumn("kept", (F.col("n_files") >= 3) & (F.col("n_rows") >= 3))


@query("classify_cohort", W(*BASE) + "SELECT run_dir, n_rows, n_flagged, is_saas FROM classified")
def q_classify(spark, sf):
    classified, _ = cohorts.cohort_table(spark, sf)
    return classified


@query("first_match_in_array", W(fx.FX1_SQL) + f"""SELECT run_dir, stem, arg_min(response, pos) AS response
FROM fx1 WHERE playbook = '06_performance' AND test_id = '{PERF_TEST_ID}' GROUP BY run_dir, stem""")
def q_first_match(spark, sf):
    cases = fx.fx1_cases(spark, sf)
    hits = cases.where((F.col("playbook") == "06_performance") & (F.col("test_id") == PERF_TEST_ID))
    return hits.groupBy("run_dir", "stem").agg(F.min_by("response", "pos").alias("response"))


def _mart_sql(config):
    return cohorts.llm_mart_sql(config)


@query("mart_llm_local", _mart_sql("llm_local"))
def q_mart_local(spark, sf):
    return cohorts.llm_mart(spark, sf, "llm_local").select(*[c for c, _ in LLM_COLUMNS])


@query("mart_llm_saas", _mart_sql("llm_saas"))
def q_mart_saas(spark, sf):
    return cohorts.llm_mart(spark, sf, "llm_saas").select(*[c for c, _ in LLM_COLUMNS])


@query("sort_pass_rate", W(*BASE) + """SELECT run_dir, stem,
  row_number() OVER (PARTITION BY run_dir ORDER BY coalesce(TRY_CAST(nullif(pass_rate, '') AS DOUBLE), 0) DESC, stem)
    AS rank
FROM gated""")
def q_sort_pass_rate(spark, sf):
    g = cohorts.gated_rows(spark, sf).select("run_dir", "stem", "pass_rate")
    key = F.coalesce(C.tcast(C.nz("pass_rate"), "double"), F.lit(0.0))
    return pick.rank_within(g, ["run_dir"], [key.desc(), F.col("stem")]).select("run_dir", "stem", "rank")


@query("project_playbook_aggregates", W(fx.FX1_SQL, fx.FX1_PB_SQL) + f"""SELECT run_dir, stem, playbook,
  pass_rate, mean_score, total, passed, n_knockouts FROM fx1_pb WHERE playbook IN {ALLOWED_IN}""")
def q_pb_aggs(spark, sf):
    reps = cohorts.reports(spark, sf)
    m = publish.filter_map_keys("playbooks", ALLOWED)
    e = reps.select("run_dir", "stem", F.explode(m).alias("playbook", "agg"))
    return e.select("run_dir", "stem", "playbook", "agg.pass_rate", "agg.mean_score", "agg.total",
                    "agg.passed", "agg.n_knockouts")


@query("null_default", W(*BASE) + """SELECT run_dir, stem, CAST(coalesce(knockouts, 0) AS INTEGER) AS judge_knockouts,
  nullif(judge, '') AS judge, coalesce(TRY_CAST(nullif(pass_rate, '') AS DOUBLE), 0) AS pass_rate_sort
FROM rows""")
def q_null_default(spark, sf):
    r = cohorts.report_rows(spark, sf)
    return r.select("run_dir", "stem",
                    C.falsy_default("knockouts", 0).cast("int").alias("judge_knockouts"),
                    C.nz("judge").alias("judge"),
                    C.falsy_default(C.lenient_double("pass_rate"), 0.0).alias("pass_rate_sort"))


@query("fallback_first_nonnull", W(*BASE) + f"""SELECT run_dir, stem,
  coalesce({S.date_prefix('run')}, feed.feed_date) AS measured_at,
  {S.subject('model', 'stem')} AS name,
  ({S.date_prefix('run')} IS NULL) AS date_fell_back,
  (nullif(model, '') IS NULL) AS subject_fell_back
FROM rows CROSS JOIN feed""")
def q_fallback(spark, sf):
    r = cohorts.report_rows(spark, sf).crossJoin(F.broadcast(fx.feed_date(spark, sf)))
    return r.select("run_dir", "stem",
                    F.coalesce(C.date_prefix("run"), F.col("feed_date")).alias("measured_at"),
                    C.subject_basename("model", "stem").alias("name"),
                    C.date_prefix("run").isNull().alias("date_fell_back"),
                    C.nz("model").isNull().alias("subject_fell_back"))


@query("subject_basename", W(*BASE) + """SELECT name, count(*) AS n_reports,
  count_if(nullif(model, '') IS NULL) AS n_from_stem FROM rows GROUP BY name""")
def q_basename(spark, sf):
    r = cohorts.report_rows(spark, sf)
    return r.groupBy("name").agg(F.count(F.lit(1)).alias("n_reports"),
                                 F.count_if(C.nz("model").isNull()).alias("n_from_stem"))


def _passed_fold(m):
    return F.aggregate(F.map_values(m), F.lit(0).cast("long"),
                       lambda acc, v: acc + F.coalesce(v["passed"], F.lit(0)))


@query("quant_label", W(*BASE) + f"""SELECT {S.quant_label('r.profile')} AS label, count(*) AS n_reports,
  CAST(sum(r.total_tests) AS BIGINT) AS n_cases, CAST(sum(p.passed) AS BIGINT) AS n_passed,
  CAST(sum(p.passed) AS DOUBLE) / sum(r.total_tests) AS pass_share
FROM rows r JOIN (SELECT run_dir, stem, sum(passed) AS passed FROM fx1_pb GROUP BY run_dir, stem) p
  USING (run_dir, stem)
GROUP BY label""")
def q_quant(spark, sf):
    r = cohorts.report_rows(spark, sf).withColumn("passed", _passed_fold(F.col("playbooks")))
    g = r.groupBy(C.quant_label("profile").alias("label")).agg(
        F.count(F.lit(1)).alias("n_reports"),
        F.sum("total_tests").cast("long").alias("n_cases"),
        F.sum("passed").cast("long").alias("n_passed"))
    return g.withColumn("pass_share", F.col("n_passed").cast("double") / F.col("n_cases"))


@query("strip_variant", W(*BASE) + f"""SELECT {S.strip_variant('profile')} AS base_profile,
  count(DISTINCT profile) AS n_profiles, CAST(sum(total_tests) AS BIGINT) AS n_cases
FROM rows GROUP BY base_profile""")
def q_strip_variant(spark, sf):
    r = cohorts.report_rows(spark, sf)
    return r.groupBy(C.strip_variant("profile").alias("base_profile")).agg(
        F.countDistinct("profile").alias("n_profiles"),
        F.sum("total_tests").cast("long").alias("n_cases"))


@query("parse_truncated_json", W(fx.FX1_SQL) + f"""SELECT run_dir, count(*) AS n,
  count({S.json_number('response', 'ttft_p50_ms')}) AS n_ttft,
  count({S.json_number('response', 'throughput_median_tok_s')}) AS n_median,
  count({S.json_number('response', 'throughput_mean_tok_s')}) AS n_mean,
  CAST(count({S.json_number('response', 'throughput_median_tok_s')}) AS DOUBLE) / count(*) AS share_median,
  CAST(sum(CAST(round({S.json_number('response', 'ttft_p50_ms')} * 100) AS BIGINT)) AS DOUBLE)
    / count({S.json_number('response', 'ttft_p50_ms')}) / 100.0 AS mean_ttft
FROM fx1 WHERE test_id = '{PERF_TEST_ID}' GROUP BY run_dir""")
def q_parse_json(spark, sf):
    c = fx.fx1_cases(spark, sf).where(F.col("test_id") == PERF_TEST_ID)
    ttft = C.json_number("response", "ttft_p50_ms")
    med = C.json_number("response", "throughput_median_tok_s")
    mean = C.json_number("response", "throughput_mean_tok_s")
    return c.groupBy("run_dir").agg(
        F.count(F.lit(1)).alias("n"), F.count(ttft).alias("n_ttft"), F.count(med).alias("n_median"),
        F.count(mean).alias("n_mean"),
        (F.count(med).cast("double") / F.count(F.lit(1))).alias("share_median"),
        (F.sum(F.round(ttft * 100).cast("long")).cast("double") / F.count(ttft) / 100.0).alias("mean_ttft"))


@query("normalise_rate", W(fx.FX1_SQL, fx.FX1_PB_SQL, fx.FX1_REP_SQL) + f"""SELECT run_dir, playbook, count(rate) AS n,
  min(rate) AS min_rate, max(rate) AS max_rate,
  CAST(sum(CAST(round(rate * 10000) AS BIGINT)) AS DOUBLE) / count(rate) / 10000.0 AS mean_rate
FROM (SELECT run_dir, playbook, {S.rate('pass_rate')} AS rate FROM fx1_pb
      UNION ALL SELECT run_dir, 'summary', {S.rate('pass_rate')} FROM fx1_rep) u
GROUP BY run_dir, playbook""")
def q_normalise(spark, sf):
    reps = cohorts.reports(spark, sf)
    pbs = reps.select("run_dir", F.explode("playbooks").alias("playbook", "agg")).select(
        "run_dir", "playbook", C.normalise_rate(F.col("agg.pass_rate")).alias("rate"))
    summ = reps.select("run_dir", F.lit("summary").alias("playbook"), C.normalise_rate("pass_rate").alias("rate"))
    u = pbs.unionByName(summ)
    return u.groupBy("run_dir", "playbook").agg(
        F.count("rate").alias("n"), F.min("rate").alias("min_rate"), F.max("rate").alias("max_rate"),
        (F.sum(F.round(F.col("rate") * 10000).cast("long")).cast("double") / F.count("rate") / 10000.0)
        .alias("mean_rate"))


@query("link_url", W(*BASE, fx.FX6_SQL) + f"""SELECT run_dir, count_if(link <> '') AS n_with_link,
  count_if(link = '') AS n_without_link
FROM (SELECT g.run_dir,
        coalesce(nullif(CASE WHEN g.is_saas THEN {S.provider('g.profile', 2, '')} ELSE {S.hub_link('g.profile')} END, ''),
                 CASE WHEN nullif(m.hf_repo, '') IS NOT NULL THEN 'https://huggingface.co/' || m.hf_repo END, '')
          AS link
      FROM gated g LEFT JOIN fx6 m ON m.name = g.name) t
GROUP BY run_dir""")
def q_link(spark, sf):
    g = cohorts.gated_rows(spark, sf).join(fx.fx6_meta(spark, sf).select("name", "hf_repo"), "name", "left")
    # provider or hub link first; the metadata repo is the fallback for every row
    first = F.when(F.col("is_saas"), C.provider_case("profile", 2, "")).otherwise(C.hub_link_from_profile("profile"))
    link = F.coalesce(C.nz(first),
                      F.when(C.nz("hf_repo").isNotNull(), F.concat(F.lit("https://huggingface.co/"), "hf_repo")),
                      F.lit(""))
    return g.withColumn("link", link).groupBy("run_dir").agg(
        F.count_if(F.col("link") != "").alias("n_with_link"),
        F.count_if(F.col("link") == "").alias("n_without_link"))


@query("withheld_playbooks", cohorts.llm_mart_sql("llm_local", final=f"""SELECT m.run_id,
  (SELECT string_agg(playbook, ',' ORDER BY playbook)
   FROM (SELECT DISTINCT playbook FROM fx1 WHERE playbook NOT IN {ALLOWED_IN})) AS excluded
FROM mart m"""))
def q_withheld(spark, sf):
    w = publish.withheld_playbooks(fx.fx1_cases(spark, sf), "playbook", ALLOWED)
    mart = cohorts.llm_mart(spark, sf, "llm_local").select("run_id")
    return mart.crossJoin(F.broadcast(w)).select("run_id", F.concat_ws(",", "excluded").alias("excluded"))


@query("map_to_sorted_structs", W(fx.FX1_SQL, fx.FX1_PB_SQL) + """SELECT run_dir, stem,
  row_number() OVER (PARTITION BY run_dir, stem ORDER BY playbook) - 1 AS idx, playbook, total
FROM fx1_pb""")
def q_sorted_structs(spark, sf):
    from evalpress.operators.nested import map_to_sorted_structs
    reps = cohorts.reports(spark, sf)
    arr = map_to_sorted_structs(F.col("playbooks"), "playbook")
    e = reps.select("run_dir", "stem", F.posexplode(arr).alias("idx", "pb"))
    return e.select("run_dir", "stem", F.col("idx").cast("long").alias("idx"), "pb.playbook", "pb.total")


@query("union_same_schema", W(*BASE) + """SELECT name, arg_min(cohort, o) AS cohort FROM (
  SELECT s.name, 'local' AS cohort, 0 AS o FROM sized s JOIN local_cohort c USING (run_dir)
  UNION ALL SELECT s.name, 'saas', 1 FROM sized s JOIN saas_cohort c USING (run_dir)) u GROUP BY name""")
def q_union_same(spark, sf):
    loc = cohorts.cohort_rows(spark, sf, "local").select("name", F.lit("local").alias("cohort"), F.lit(0).alias("o"))
    saas = cohorts.cohort_rows(spark, sf, "saas").select("name", F.lit("saas").alias("cohort"), F.lit(1).alias("o"))
    return pick.first_per_key(loc.unionByName(saas), ["name"], ["o"]).select("name", "cohort")
