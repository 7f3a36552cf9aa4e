"""Guard, TTS and image metric tables (FX2, FX3, FX4) with their oracles."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalpress.constants import HARDWARE_LOCAL, HUB_URL, SERVED_BY
from evalpress.functions import columns as C
from evalpress.operators import gates, pick
from evalpress.operators.publish import drop_raw_fields
from evalpress.plans import fixtures as fx
from evalpress.plans import sqlfn as S
from evalpress.plans.schemas import GUARD_COLUMNS, T2I_COLUMNS, TTS_COLUMNS
from evalpress.plans.stage import staged
from evalpress.sources.config_text import first_child


def _revision(spark, sf, df: DataFrame) -> DataFrame:
    store = fx.fx7_store(spark, sf).select(F.col("id").alias("model_id"), C.nz("sha").alias("model_revision"))
    return df.join(store, "model_id", "left")


def _meta(spark, sf) -> DataFrame:
    return fx.fx6_meta(spark, sf).select(F.col("name").alias("_meta_name"), F.col("hf_repo").alias("_meta_repo"))


# ------------------------------------------------------------------ guards
def guard_rows(spark: SparkSession, sf: str, name_map: dict[str, str] | None = None) -> DataFrame:
    """Guard reports with slug, detail flag and looked-up full name.  The
    slug -> name map is a bounded parameter: the fixture's map for the test
    corpus, ``constants.GUARD_NAME`` for real guard reports."""
    if name_map is None:
        # one row per guard report, read by several outputs: staged once
        return staged(spark, sf, "guard_rows", lambda: guard_rows(spark, sf, dict(fx.GUARD_STATIC_MAP)))
    g = fx.fx2_guards(spark, sf)
    pairs = list(name_map.items())
    smap = spark.createDataFrame(pairs, "slug string, full_name string")
    g = g.withColumn("slug", C.slugify("label")).withColumn(
        "has_detail", F.coalesce(F.size("per_case"), F.lit(0)) > 0)
    return g.join(F.broadcast(smap), "slug", "left").withColumn(
        "full_name", F.coalesce("full_name", F.lit("")))


def guard_mart(spark: SparkSession, sf: str) -> DataFrame:
    g = guard_rows(spark, sf).join(_meta(spark, sf), F.col("full_name") == F.col("_meta_name"), "left")
    # the id is a column first, so the quantisation label reads it instead of
    # nesting the whole id expression in every branch
    g = g.withColumn("_mid", C.canonical_id("served_model"))
    mid = F.col("_mid")
    m = F.col("metrics")
    cols = {
        "run_id": F.concat_ws("/", F.lit("guardrails"), F.col("label"), F.col("mtime")),
        "model_id": mid,
        "base_model_id": C.nz("_meta_repo"),
        "served_model_ref": F.coalesce(C.nz(C.clean_ref("served_model")), F.col("label")),
        "quantization": C.quant_label(mid),
        "served_by": F.lit(SERVED_BY["guardrails"]),
        "hardware": F.lit(HARDWARE_LOCAL),
        "measured_at": C.strict_date("mtime"),
        "valid": F.lit(True),
        "guard_protocol": F.coalesce(C.nz("protocol"), m["guard_protocol"]),
        "threshold": F.col("threshold"),
        "reasoning_effort": C.nz("reasoning_effort"),
        "n_unsafe": m["n_unsafe"], "n_safe": m["n_safe"],
        "tp": m["confusion"]["tp"], "tn": m["confusion"]["tn"], "fp": m["confusion"]["fp"],
        "fn": m["confusion"]["fn"], "errors": m["confusion"]["errors"],
    }
    for k in ("recall", "fn_rate", "fpr", "trap_fpr", "precision", "f1", "accuracy",
              "latency_ms_mean", "latency_ms_p95"):
        cols[k] = m[k]
    staged = g.select(*[v.alias(k) for k, v in cols.items() if k != "model_revision"],
                      F.col("label").alias("_entity"), F.col("mtime").alias("_mtime"))
    return _revision(spark, sf, staged).select(*[c for c, _ in GUARD_COLUMNS], "_entity", "_mtime")


GUARD_SQL_BODY = f"""
  SELECT 'guardrails/' || g.label || '/' || g.mtime AS run_id,
         {S.canonical_id('g.served_model')} AS model_id,
         nullif(m.hf_repo, '') AS base_model_id,
         coalesce(nullif({S.clean_ref('g.served_model')}, ''), g.label) AS served_model_ref,
         {S.quant_label(S.canonical_id('g.served_model'))} AS quantization,
         'vllm' AS served_by, '{HARDWARE_LOCAL}' AS hardware,
         CAST(g.mtime AS DATE) AS measured_at, true AS valid,
         coalesce(nullif(g.protocol, ''), g.guard_protocol) AS guard_protocol,
         g.threshold, nullif(g.reasoning_effort, '') AS reasoning_effort,
         g.n_unsafe, g.n_safe, g.tp, g.tn, g.fp, g.fn, g.errors, g.recall, g.fn_rate, g.fpr, g.trap_fpr,
         g.precision, g.f1, g.accuracy, g.latency_ms_mean, g.latency_ms_p95, g.label AS entity
  FROM fx2 g LEFT JOIN guard_map gm ON gm.slug = {S.slugify('g.label')}
  LEFT JOIN fx6 m ON m.name = coalesce(gm.name, '')"""

GUARD_CTES = [fx.FX2_SQL, fx.GUARD_MAP_SQL, fx.FX6_SQL, fx.FX7_STORE_SQL,
              f"guard0 AS ({GUARD_SQL_BODY})",
              "guard_mart AS (SELECT g.* EXCLUDE (entity), nullif(st.sha, '') AS model_revision, g.entity "
              "FROM guard0 g LEFT JOIN store st ON st.id = g.model_id)"]


def guard_mart_sql() -> str:
    return fx.with_(*GUARD_CTES) + "SELECT " + ", ".join(c for c, _ in GUARD_COLUMNS) + " FROM guard_mart"


# --------------------------------------------------------------------- TTS
def tts_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rescore file joined with the summary file of the same directory; a
    missing summary keeps the rescore row.  Raw fields of the summary are
    dropped before anything else sees them."""
    rescore = fx.fx3_rescore(spark, sf)
    summary = drop_raw_fields(fx.fx3_summary(spark, sf))
    j = rescore.join(summary, "dir", "left")
    repo = C.engine_repo("tts_model")
    return j.select(
        "*",
        C.voice_from_run(F.coalesce(C.nz("run"), F.col("dir"))).alias("voice"),
        F.when(repo != "", F.concat(F.lit(HUB_URL), repo)).otherwise(F.lit("")).alias("hf"),
        C.nz(repo).alias("engine"),
    )


def tts_mart(spark: SparkSession, sf: str) -> DataFrame:
    t = tts_rows(spark, sf).crossJoin(F.broadcast(fx.feed_date(spark, sf)))
    t = t.join(_meta(spark, sf), F.coalesce(F.col("engine"), F.lit("")) == F.col("_meta_name"), "left")
    datum = F.coalesce(C.date_prefix("run"), F.col("feed_date"))
    mid = F.col("engine")
    cols = {
        "run_id": F.concat_ws("/", F.lit("tts_de"), F.col("voice"), datum),
        "model_id": mid,
        "base_model_id": F.coalesce(C.nz("_meta_repo"), mid),
        "served_model_ref": F.coalesce(C.nz(C.clean_ref("tts_model")), mid, F.col("voice")),
        "quantization": C.quant_label(mid),
        "served_by": F.lit(SERVED_BY["tts_de"]),
        "hardware": F.lit(HARDWARE_LOCAL),
        "measured_at": C.strict_date(datum),
        "valid": gates.zero_or_null("n_error"),
        "voice_id": F.col("voice"), "n_repeats": F.col("n_repeats"),
        "n_total": F.col("n_total"), "n_ok": F.col("n_ok"), "n_error": F.col("n_error"),
        "n_asr_runaway": F.col("n_asr_runaway"), "rtf_mean": F.col("rtf_mean"),
        "sec_per_char_median": F.col("sec_per_char_median"), "sec_per_char_mean": F.col("sec_per_char_mean"),
        "asr_wer_whisper": F.col("wer_judge1_mean"), "asr_wer_voxtral": F.col("wer_judge2_mean"),
        "asr_wer_mean": F.col("wer_mean"), "asr_wer_capped_mean": F.col("wer_capped_mean"),
        "asr_wer_best_mean": F.col("wer_best_mean"), "asr_cer_mean": F.col("cer_mean"),
    }
    extra = [F.col("voice").alias("_entity"), F.col("judge1").alias("_asr1"), F.col("judge2").alias("_asr2"),
             F.col("protocol").alias("_protocol"), F.col("testset").alias("_testset"), F.col("run").alias("_run")]
    staged = t.select(*[v.alias(k) for k, v in cols.items()], *extra)
    return _revision(spark, sf, staged).select(*[c for c, _ in TTS_COLUMNS], *[e for e in
                                               ("_entity", "_asr1", "_asr2", "_protocol", "_testset", "_run")])


TTS_ROWS_SQL = f"""tts AS (
  SELECT r.*, s.* EXCLUDE (dir),
         regexp_replace(coalesce(nullif(r.run, ''), r.dir), '^\\d{{4}}-\\d{{2}}-\\d{{2}}_suite_', '') AS voice,
         CASE WHEN {S.engine_repo('s.tts_model')} <> '' THEN '{HUB_URL}' || {S.engine_repo('s.tts_model')}
              ELSE '' END AS hf,
         nullif({S.engine_repo('s.tts_model')}, '') AS engine
  FROM fx3_rescore r LEFT JOIN fx3_summary s ON s.dir = r.dir)"""

TTS_SQL_BODY = f"""
  SELECT 'tts_de/' || t.voice || '/' || coalesce({S.date_prefix('t.run')}, feed.feed_date) AS run_id,
         t.engine AS model_id, coalesce(nullif(m.hf_repo, ''), t.engine) AS base_model_id,
         coalesce(nullif({S.clean_ref('t.tts_model')}, ''), t.engine, t.voice) AS served_model_ref,
         {S.quant_label('t.engine')} AS quantization, 'tts-adapter' AS served_by, '{HARDWARE_LOCAL}' AS hardware,
         CAST(coalesce({S.date_prefix('t.run')}, feed.feed_date) AS DATE) AS measured_at,
         coalesce(t.n_error, 0) = 0 AS valid,
         t.voice AS voice_id, t.n_repeats, t.n_total, t.n_ok, t.n_error, t.n_asr_runaway, t.rtf_mean,
         t.sec_per_char_median, t.sec_per_char_mean, t.wer_judge1_mean AS asr_wer_whisper,
         t.wer_judge2_mean AS asr_wer_voxtral, t.wer_mean AS asr_wer_mean,
         t.wer_capped_mean AS asr_wer_capped_mean, t.wer_best_mean AS asr_wer_best_mean,
         t.cer_mean AS asr_cer_mean, t.voice AS entity, t.judge1 AS asr1, t.judge2 AS asr2,
         t.protocol AS tprotocol, t.testset
  FROM tts t CROSS JOIN feed LEFT JOIN fx6 m ON m.name = coalesce(t.engine, '')"""

TTS_CTES = [fx.FX3_RESCORE_SQL, fx.FX3_SUMMARY_SQL, TTS_ROWS_SQL, fx.FEED_DATE_SQL, fx.FX6_SQL,
            fx.FX7_STORE_SQL, f"tts0 AS ({TTS_SQL_BODY})",
            "tts_mart AS (SELECT t.* EXCLUDE (entity, asr1, asr2, tprotocol, testset), nullif(st.sha, '') AS model_revision, "
            "t.entity, t.asr1, t.asr2, t.tprotocol, t.testset "
            "FROM tts0 t LEFT JOIN store st ON st.id = t.model_id)"]


def tts_mart_sql() -> str:
    return fx.with_(*TTS_CTES) + "SELECT " + ", ".join(c for c, _ in TTS_COLUMNS) + " FROM tts_mart"


# ------------------------------------------------------------------- image
def image_dirs(spark: SparkSession, sf: str) -> DataFrame:
    """Subject -> model directory from the image config (staged once)."""
    return staged(spark, sf, "image_dirs", lambda: first_child(fx.fx8_image_config(spark, sf), "dir"))


def image_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Newest run per subject by sorted path; the subject falls back to the
    directory name."""
    def build():
        imgs = fx.fx4_images(spark, sf).withColumn("model", F.coalesce(C.nz("model"), F.col("run_dir")))
        return pick.latest_per_key(imgs, ["model"], ["run_dir"])
    return staged(spark, sf, "image_latest", build)


def image_mart(spark: SparkSession, sf: str) -> DataFrame:
    d = image_latest(spark, sf)
    dirs = image_dirs(spark, sf).withColumnRenamed("name", "_dir_name")
    d = (d.join(dirs, d["model"] == dirs["_dir_name"], "left")
         .join(_meta(spark, sf), F.col("model") == F.col("_meta_name"), "left")
         .crossJoin(F.broadcast(fx.feed_date(spark, sf))))
    d = d.withColumn("_mid", C.canonical_id(F.coalesce("dir", F.lit(""))))
    mid = F.col("_mid")
    datum = F.coalesce(C.date_prefix("run_dir"), F.col("feed_date"))
    cols = {
        "run_id": F.concat_ws("/", F.lit("t2i"), F.col("model"), F.coalesce(C.nz("run_dir"), datum)),
        "model_id": mid,
        "base_model_id": C.nz("_meta_repo"),
        "served_model_ref": F.coalesce(C.nz("dir"), F.col("model")),
        "quantization": C.quant_label(mid),
        "served_by": F.lit(SERVED_BY["t2i"]),
        "hardware": F.lit(HARDWARE_LOCAL),
        "measured_at": C.strict_date(datum),
        "valid": gates.zero_or_null("failed"),
        "n_cases": F.col("cases"), "n_generated": F.col("generated"), "n_failed": F.col("failed"),
        "gen_seconds_mean": F.col("gen_seconds_mean"),
        "ocr_text_cer_mean": F.col("text_rendering_cer_mean"),
        "ocr_text_exact_rate": F.lit(None).cast("double"),
        "judge_adherence_score_mean": F.col("adherence_score_mean"),
    }
    staged = d.select(*[v.alias(k) for k, v in cols.items()], F.col("model").alias("_entity"),
                      F.col("run_dir").alias("_run_dir"))
    return _revision(spark, sf, staged).select(*[c for c, _ in T2I_COLUMNS], "_entity", "_run_dir")


IMG_DIRS_SQL = """img_lines AS (
  SELECT doc, pos, line,
         nullif(trim(regexp_extract(line, '^\\s*-\\s*name:\\s*"?([^"#\\n]+?)"?\\s*$', 1)), '') AS oname
  FROM fx8_img),
img_filled AS (
  SELECT *, last_value(CASE WHEN oname IS NOT NULL THEN pos END IGNORE NULLS)
              OVER (PARTITION BY doc ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS opos,
            last_value(oname IGNORE NULLS)
              OVER (PARTITION BY doc ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS owner
  FROM img_lines),
img_kids AS (
  SELECT owner AS name, doc, opos, arg_min(regexp_extract(line, '^\\s*dir:\\s*"?([^"#\\s]+)"?', 1), pos) AS dir
  FROM img_filled
  WHERE oname IS NULL AND owner IS NOT NULL AND regexp_matches(line, '^\\s*dir:\\s*"?([^"#\\s]+)"?')
  GROUP BY owner, doc, opos),
img_dirs AS (SELECT name, arg_max(dir, (doc, opos)) AS dir FROM img_kids GROUP BY name)"""

IMG_LATEST_SQL = """img_latest AS (
  SELECT model, arg_max(run_dir, run_dir) AS run_dir, arg_max_null(cases, run_dir) AS cases,
         arg_max_null(generated, run_dir) AS generated, arg_max_null(failed, run_dir) AS failed,
         arg_max_null(gen_seconds_mean, run_dir) AS gen_seconds_mean,
         arg_max_null(text_rendering_cer_mean, run_dir) AS text_rendering_cer_mean,
         arg_max_null(adherence_score_mean, run_dir) AS adherence_score_mean
  FROM (SELECT * REPLACE (coalesce(nullif(model, ''), run_dir) AS model) FROM fx4) GROUP BY model)"""

IMG_SQL_BODY = f"""
  SELECT 't2i/' || d.model || '/' || coalesce(nullif(d.run_dir, ''), {S.date_prefix('d.run_dir')}, feed.feed_date)
           AS run_id,
         {S.canonical_id("coalesce(x.dir, '')")} AS model_id,
         nullif(m.hf_repo, '') AS base_model_id,
         coalesce(nullif(x.dir, ''), d.model) AS served_model_ref,
         {S.quant_label(S.canonical_id("coalesce(x.dir, '')"))} AS quantization,
         'diffusers' AS served_by, '{HARDWARE_LOCAL}' AS hardware,
         CAST(coalesce({S.date_prefix('d.run_dir')}, feed.feed_date) AS DATE) AS measured_at,
         coalesce(d.failed, 0) = 0 AS valid,
         d.cases AS n_cases, d.generated AS n_generated, d.failed AS n_failed, d.gen_seconds_mean,
         d.text_rendering_cer_mean AS ocr_text_cer_mean, CAST(NULL AS DOUBLE) AS ocr_text_exact_rate,
         d.adherence_score_mean AS judge_adherence_score_mean, d.model AS entity
  FROM img_latest d LEFT JOIN img_dirs x ON x.name = d.model LEFT JOIN fx6 m ON m.name = d.model CROSS JOIN feed"""

IMG_CTES = [fx.FX4_SQL, fx.FX8_IMG_SQL, IMG_DIRS_SQL, IMG_LATEST_SQL, fx.FEED_DATE_SQL, fx.FX6_SQL,
            fx.FX7_STORE_SQL, f"img0 AS ({IMG_SQL_BODY})",
            "img_mart AS (SELECT t.* EXCLUDE (entity), nullif(st.sha, '') AS model_revision, t.entity "
            "FROM img0 t LEFT JOIN store st ON st.id = t.model_id)"]


def image_mart_sql() -> str:
    return fx.with_(*IMG_CTES) + "SELECT " + ", ".join(c for c, _ in T2I_COLUMNS) + " FROM img_mart"
