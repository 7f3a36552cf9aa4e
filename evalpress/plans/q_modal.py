"""Queries over guard (FX2), TTS (FX3) and image (FX4) feeds."""
from __future__ import annotations

from pyspark.sql import functions as F

from evalpress.constants import GUARD_HIDDEN_METRICS
from evalpress.functions import columns as C
from evalpress.operators import pick
from evalpress.operators.publish import drop_raw_fields
from evalpress.operators.typed import project_typed
from evalpress.plans import fixtures as fx
from evalpress.plans import modal as M
from evalpress.plans import sqlfn as S
from evalpress.plans.registry import query
from evalpress.plans.schemas import GUARD_COLUMNS, T2I_COLUMNS, TTS_COLUMNS

W = fx.with_


@query("mart_guardrails", M.guard_mart_sql())
def q_mart_guard(spark, sf):
    return M.guard_mart(spark, sf).select(*[c for c, _ in GUARD_COLUMNS])


@query("mart_tts", M.tts_mart_sql())
def q_mart_tts(spark, sf):
    return M.tts_mart(spark, sf).select(*[c for c, _ in TTS_COLUMNS])


@query("mart_t2i", M.image_mart_sql())
def q_mart_t2i(spark, sf):
    return M.image_mart(spark, sf).select(*[c for c, _ in T2I_COLUMNS])


@query("flag_nonempty", W(fx.FX2_SQL) + "SELECT label, has_detail FROM fx2")
def q_flag_nonempty(spark, sf):
    return M.guard_rows(spark, sf).select("label", "has_detail")


@query("valid_flag", W(*M.TTS_CTES, *M.IMG_CTES[:2], *M.IMG_CTES[2:5], *M.IMG_CTES[7:]) + """
SELECT config, valid, count(*) AS n FROM (
  SELECT 'tts_de' AS config, valid FROM tts_mart UNION ALL SELECT 't2i', valid FROM img_mart) u
GROUP BY config, valid""")
def q_valid_flag(spark, sf):
    t = M.tts_mart(spark, sf).select(F.lit("tts_de").alias("config"), "valid")
    i = M.image_mart(spark, sf).select(F.lit("t2i").alias("config"), "valid")
    return t.unionByName(i).groupBy("config", "valid").agg(F.count(F.lit(1)).alias("n"))


@query("join_static_map", W(fx.FX2_SQL, fx.GUARD_MAP_SQL) + f"""SELECT g.label, {S.slugify('g.label')} AS slug,
  coalesce(m.name, '') AS full_name FROM fx2 g LEFT JOIN guard_map m ON m.slug = {S.slugify('g.label')}""")
def q_static_map(spark, sf):
    return M.guard_rows(spark, sf).select("label", "slug", "full_name")


@query("join_dir_map", W(*M.IMG_CTES[:4]) + f"""SELECT d.model, x.dir,
  {S.canonical_id("coalesce(x.dir, '')")} AS model_id
FROM img_latest d LEFT JOIN img_dirs x ON x.name = d.model""")
def q_dir_map(spark, sf):
    d = M.image_latest(spark, sf).select("model")
    dirs = M.image_dirs(spark, sf)
    j = d.join(dirs, d["model"] == dirs["name"], "left")
    return j.select("model", "dir", C.canonical_id(F.coalesce("dir", F.lit(""))).alias("model_id"))


@query("src_config_first_child", W(fx.FX8_IMG_SQL, M.IMG_DIRS_SQL) + "SELECT name, dir FROM img_dirs")
def q_first_child(spark, sf):
    return M.image_dirs(spark, sf)


@query("join_sibling_files", W(fx.FX3_RESCORE_SQL, fx.FX3_SUMMARY_SQL) + """SELECT r.dir, r.run,
  r.wer_judge1_mean, r.wer_judge2_mean, s.tts_model, s.n_total, s.n_error
FROM fx3_rescore r LEFT JOIN fx3_summary s ON s.dir = r.dir""")
def q_sibling(spark, sf):
    return M.tts_rows(spark, sf).select("dir", "run", "wer_judge1_mean", "wer_judge2_mean", "tts_model",
                                        "n_total", "n_error")


@query("drop_raw_fields", W(fx.FX3_SUMMARY_SQL) + "SELECT * FROM fx3_summary")
def q_drop_raw(spark, sf):
    return drop_raw_fields(fx.fx3_summary(spark, sf))


_T2I_SOURCE = {"n_cases": "cases", "n_generated": "generated", "n_failed": "failed",
               "ocr_text_cer_mean": "text_rendering_cer_mean",
               "judge_adherence_score_mean": "adherence_score_mean"}


@query("project_typed", W(fx.FX4_SQL) + """SELECT run_dir, cases AS n_cases, generated AS n_generated,
  failed AS n_failed, gen_seconds_mean, text_rendering_cer_mean AS ocr_text_cer_mean,
  CAST(NULL AS DOUBLE) AS ocr_text_exact_rate, adherence_score_mean AS judge_adherence_score_mean
FROM fx4""")
def q_project_typed(spark, sf):
    from pyspark.sql import types as T
    cols = [("run_dir", T.StringType())] + [c for c in T2I_COLUMNS[10:]]
    return project_typed(fx.fx4_images(spark, sf), cols, _T2I_SOURCE)


@query("latest_per_model", W(fx.FX4_SQL, M.IMG_LATEST_SQL) + """SELECT model, run_dir, cases, gen_seconds_mean
FROM img_latest""")
def q_latest(spark, sf):
    return M.image_latest(spark, sf).select("model", "run_dir", "cases", "gen_seconds_mean")


@query("argmax_first", W(fx.FX2_SQL) + "SELECT arg_min(label, (-coalesce(f1, 0), label)) AS label, "
       "arg_min(f1, (-coalesce(f1, 0), label)) AS f1 FROM fx2")
def q_argmax(spark, sf):
    g = M.guard_rows(spark, sf).select("label", F.col("metrics.f1").alias("f1"))
    return pick.argmax_first(g, "f1", "label").select("label", "f1")


@query("argmin_default", W(fx.FX4_SQL) + """SELECT arg_min(model, (k, first_path)) AS model,
  arg_min(gen_seconds_mean, (k, first_path)) AS gen_seconds_mean
FROM (SELECT model, arg_max(gen_seconds_mean, run_dir) AS gen_seconds_mean, min(run_dir) AS first_path,
             CASE WHEN coalesce(arg_max(gen_seconds_mean, run_dir), 0) = 0 THEN 9e9
                  ELSE arg_max(gen_seconds_mean, run_dir) END AS k
      FROM fx4 GROUP BY model) t""")
def q_argmin(spark, sf):
    imgs = fx.fx4_images(spark, sf)
    latest = imgs.groupBy("model").agg(
        F.max_by("gen_seconds_mean", "run_dir").alias("gen_seconds_mean"),
        F.min("run_dir").alias("first_path"))
    return pick.argmin_default(latest, "gen_seconds_mean", "first_path").select("model", "gen_seconds_mean")


_BEST = {"f1": "max", "recall": "max", "fpr": "min", "latency_ms_mean": "min"}


@query("best_in_column", W(fx.FX2_SQL) + """SELECT label,
  coalesce(f1 = max(f1) OVER (), false) AS best_f1,
  coalesce(recall = max(recall) OVER (), false) AS best_recall,
  coalesce(fpr = min(fpr) OVER (), false) AS best_fpr,
  coalesce(latency_ms_mean = min(latency_ms_mean) OVER (), false) AS best_latency_ms_mean
FROM fx2""")
def q_best(spark, sf):
    g = M.guard_rows(spark, sf).select("label", "metrics.f1", "metrics.recall", "metrics.fpr",
                                       "metrics.latency_ms_mean")
    return pick.best_in_column(g, _BEST).select("label", *[f"best_{c}" for c in _BEST])


_NUMERIC_KEYS = ("n_unsafe", "n_safe", "recall", "fn_rate", "fpr", "trap_fpr", "precision", "f1",
                 "accuracy", "latency_ms_mean", "latency_ms_p95")


@query("discover_numeric_keys", W(fx.FX2_SQL) + f"""SELECT key, arg_min(label, (label, kpos)) AS first_row,
  CAST(arg_min(kpos, (label, kpos)) AS INTEGER) AS first_kpos
FROM (SELECT label, k.key, k.kpos, k.v FROM fx2,
      unnest([{", ".join(f"{{'key': '{k}', 'kpos': {i}, 'v': CAST({k} AS DOUBLE)}}" for i, k in enumerate(_NUMERIC_KEYS))}]) t(k)) u
WHERE v IS NOT NULL AND key NOT IN {fx.sql_in(GUARD_HIDDEN_METRICS)}
GROUP BY key""")
def q_discover(spark, sf):
    """Nothing here names a metric: the keys come from the reports' JSON text."""
    g = M.guard_rows(spark, sf).select("label", F.to_json("metrics", {"ignoreNullFields": "false"}).alias("json"))
    return pick.discover_json_keys(g, "json", "label", GUARD_HIDDEN_METRICS)


@query("sort_wer", W(fx.FX3_RESCORE_SQL) + """SELECT regexp_replace(run, '^\\d{4}-\\d{2}-\\d{2}_suite_', '') AS voice,
  row_number() OVER (ORDER BY coalesce(wer_judge2_mean, 9), dir) AS rank FROM fx3_rescore""")
def q_sort_wer(spark, sf):
    r = fx.fx3_rescore(spark, sf).select("dir", C.voice_from_run("run").alias("voice"), "wer_judge2_mean")
    key = F.coalesce(F.col("wer_judge2_mean"), F.lit(9.0))
    return pick.rank_within(r, [], [key, F.col("dir")]).select("voice", "rank")


@query("engine_repo", W(fx.FX3_RESCORE_SQL, fx.FX3_SUMMARY_SQL, M.TTS_ROWS_SQL) + """SELECT coalesce(engine, '') AS engine,
  count(*) AS n_voices, count(wer_judge2_mean) AS n_scored,
  CAST(sum(CAST(round(wer_judge2_mean * 1000000) AS BIGINT)) AS DOUBLE) / count(wer_judge2_mean) / 1000000.0
    AS mean_wer_voxtral
FROM tts GROUP BY 1""")
def q_engine_repo(spark, sf):
    t = M.tts_rows(spark, sf)
    return t.groupBy(F.coalesce("engine", F.lit("")).alias("engine")).agg(
        F.count(F.lit(1)).alias("n_voices"), F.count("wer_judge2_mean").alias("n_scored"),
        (F.sum(F.round(F.col("wer_judge2_mean") * 1000000).cast("long")).cast("double")
         / F.count("wer_judge2_mean") / 1000000.0).alias("mean_wer_voxtral"))


@query("display_format", W(fx.FX4_SQL, M.IMG_LATEST_SQL) + f"""SELECT model, {S.fmt_int('generated')} AS generated_txt,
  {S.fmt_num('gen_seconds_mean')} AS gen_seconds_txt, {S.fmt_num('text_rendering_cer_mean')} AS cer_txt,
  {S.fmt_percent('adherence_score_mean')} AS adherence_txt, gen_seconds_mean
FROM img_latest""")
def q_display(spark, sf):
    d = M.image_latest(spark, sf)
    return d.select("model", C.fmt_int("generated").alias("generated_txt"),
                    C.fmt_num("gen_seconds_mean").alias("gen_seconds_txt"),
                    C.fmt_num("text_rendering_cer_mean").alias("cer_txt"),
                    C.fmt_percent("adherence_score_mean").alias("adherence_txt"), "gen_seconds_mean")
