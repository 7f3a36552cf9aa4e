"""Roster of the local cohort with status, and the display tables (ops 27,
28, 37, 38, 47, 61, 83-87)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evalpress.constants import BEST_DIRECTION, NO_VALUE, STATUS_RANK
from evalpress.functions import columns as C
from evalpress.operators import gates, lookups as L, pick
from evalpress.operators.publish import exclude_subjects
from evalpress.plans import fixtures as fx
from evalpress.plans import cohorts

# parameter: the profile currently being served (status "running")
RUNNING_PROFILE = "owner6--u1000"
SHOWN_PLAYBOOKS = (("01_quality", "quality"), ("02_german_language", "german"), ("03_bias", "bias"), ("05_code", "code"))
NA_PATTERN = r"\bN/?A\b"


def rank_of(status: Column) -> Column:
    expr = None
    for s, r in STATUS_RANK:
        expr = F.when(status == s, F.lit(r)) if expr is None else expr.when(status == s, F.lit(r))
    return expr


def build_roster(raw: DataFrame, deny: DataFrame) -> DataFrame:
    """Roster rows need a profile; SaaS machines are not part of it; active
    defaults to true; N/A = inactive and the word N/A in name or note."""
    r = raw.where(C.nz("profile").isNotNull() & (F.coalesce("machine", F.lit("")) != "saas"))
    active = F.coalesce(F.col("active"), F.lit(True))
    na = ~active & F.concat_ws(" ", F.col("name"), F.coalesce("notes", F.lit(""))).rlike(NA_PATTERN)
    r = r.select("name", "profile", active.alias("active"), na.alias("na"))
    return exclude_subjects(r, "name", deny)


def shown(prefix: str) -> Column:
    """What the display table shows of a report beyond its header."""
    median, ttft = perf_values(F.col("playbooks"))
    return F.struct(
        F.col("stem").alias("stem"), F.col("profile").alias("profile"),
        *[F.col("pb")[k]["pass_rate"].alias(c) for k, c in SHOWN_PLAYBOOKS],
        median.alias("tok_s"), ttft.alias("ttft")).alias(f"{prefix}_shown")


def local_reports(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    """All non-SaaS reports of the chosen local cohort directory, valid or not;
    last file per name wins."""
    rows = rows if rows is not None else cohorts.report_rows(spark, sf)
    classified, _ = cohorts.cohort_table(spark, sf)
    chosen = pick.pick_cohort_pinned(classified, "run_dir", fx.PINNED_LOCAL_COHORT)
    r = rows.join(F.broadcast(chosen), "run_dir", "left_semi").where(~F.col("is_saas"))
    r = exclude_subjects(r, "name", cohorts.deny(spark, sf))
    v = gates.validity(r.select("name", "stem", "total", "err", "profile", "pass_rate", "overall",
                                "knockouts", "pb", "playbooks"))
    return pick.latest_per_key(v, ["name"], ["stem"])


def roster_status(spark: SparkSession, sf: str, running: str | None = RUNNING_PROFILE) -> DataFrame:
    rows = cohorts.report_rows(spark, sf)
    roster = build_roster(fx.fx5_roster_raw(spark, sf), cohorts.deny(spark, sf))
    reps = local_reports(spark, sf, rows)
    # a subject with several files counts once: the last one by falling pass rate, then file name
    valid = (cohorts.cohort_rows(spark, sf, "local")
             .select("name", F.col("pass_rate").alias("_v_pass_rate"), F.lit(True).alias("_in_valid"),
                     F.col("overall").alias("v_overall"), F.col("knockouts").alias("v_knockouts"),
                     F.col("stem").alias("_v_stem"), shown("v")))
    valid = pick.latest_per_key(valid, ["name"], [-F.coalesce(C.lenient_double("_v_pass_rate"), F.lit(0.0)), "_v_stem"]
                                ).drop("_v_stem")
    rep_cols = reps.select(F.col("name").alias("_r_name"), F.col("profile").alias("_r_profile"),
                           F.col("total").alias("_r_total"), F.col("valid").alias("_r_valid"),
                           F.col("err_rate").alias("_r_err_rate"), F.col("knockouts").alias("r_knockouts"),
                           shown("r"))
    ros = roster.select(F.col("name").alias("_o_name"), F.col("profile").alias("_o_profile"),
                        "active", "na", F.lit(True).alias("_in_roster"))
    j = ros.join(rep_cols, F.col("_o_name") == F.col("_r_name"), "full_outer")
    j = j.withColumn("name", F.coalesce("_o_name", "_r_name")).join(valid, "name", "left")
    in_roster = F.coalesce("_in_roster", F.lit(False))
    has_rep = F.col("_r_name").isNotNull()
    in_valid = F.coalesce("_in_valid", F.lit(False))
    visible = ~in_roster | F.col("active") | F.col("na") | has_rep
    status = (F.when(~in_roster, F.when(F.col("_r_valid"), F.lit("valid")).otherwise(F.lit("degraded")))
              .when(in_valid, F.lit("valid"))
              .when(F.col("na"), F.lit("na"))
              .when(has_rep & (F.col("_r_total") > 0) & ~F.col("_r_valid"), F.lit("degraded"))
              .when(F.lit(bool(running)) & (F.col("_o_profile") == F.lit(running or "")), F.lit("running"))
              .otherwise(F.lit("pending")))
    out = j.where(visible).select(
        "name", status.alias("status"), in_roster.alias("in_roster"), has_rep.alias("has_report"),
        F.col("_r_valid").alias("report_valid"), in_valid.alias("in_valid_set"),
        F.coalesce(C.nz("_o_profile"), F.col("_r_profile"), F.lit("")).alias("profile"),
        F.col("_r_err_rate").alias("err_rate"), F.col("_v_pass_rate").alias("valid_pass_rate"),
        F.coalesce("active", F.lit(False)).alias("active"), F.coalesce("na", F.lit(False)).alias("na"),
        "v_overall", "v_knockouts", "r_knockouts", "v_shown", "r_shown")
    return out.withColumn("status_rank", rank_of(F.col("status")))


def sort_key(df: DataFrame) -> list[Column]:
    pr = F.when((F.col("status") == "valid") & F.col("in_valid_set"),
                F.coalesce(C.tcast(C.nz("valid_pass_rate"), "double"), F.lit(0.0))).otherwise(F.lit(0.0))
    return [F.col("status_rank"), pr.desc(), F.lower("name"), F.col("name")]


# ------------------------------------------------------------ display cells
#: shown column -> its heading, which tells the best direction
BEST_LLM, BEST_IMAGE, BEST_TTS = ({c: BEST_DIRECTION[h] for c, h in t.items()} for t in (
    {"overall_cell": "Gesamt", "quality_cell": "Qualität", "german_cell": "Deutsch", "bias_cell": "Bias",
     "code_cell": "Code", "tok_s_cell": "Tok/s", "ttft_cell": "TTFT"},
    {"gen_seconds_cell": "Ø s/Bild", "cer_cell": "Textrender CER", "exact_cell": "Textrender exakt",
     "adherence_cell": "Prompt-Treue"},
    {"wer_whisper_cell": "WER (Whisper)", "wer_voxtral_cell": "WER (Voxtral)"}))


def pct_cell(v: Column) -> Column:
    return F.when(v.isNull(), F.lit(NO_VALUE)).otherwise(
        F.concat(F.bround(v.cast("double") * 100.0, 0).cast("bigint").cast("string"), F.lit("%")))


def tok_cell(median: Column) -> Column:
    return F.when(median.isNull(), F.lit(NO_VALUE)).otherwise(F.format_string("%.1f", F.bround(median, 1)))


def ttft_cell(ttft: Column) -> Column:
    return F.when(ttft.isNull(), F.lit(NO_VALUE)).otherwise(
        F.concat(F.bround(ttft, 0).cast("bigint").cast("string"), F.lit(" ms")))


def release_cell(release_date: Column) -> Column:
    return F.when(C.release_sort_key(release_date).isNotNull(), release_date).otherwise(F.lit(NO_VALUE))


def overall_cell(overall: Column, pass_rate: Column) -> Column:
    return F.concat(F.coalesce(C.nz(overall), F.lit(NO_VALUE)), F.lit(" "), F.coalesce(pass_rate, F.lit("")), F.lit("%"))


def perf_values(playbooks: Column) -> tuple[Column, Column]:
    text = playbooks["06_performance"]["perf_response"]
    med = C.json_number(text, "throughput_median_tok_s")
    ttft = C.json_number(text, "ttft_p50_ms")
    keep = med.isNotNull() | ttft.isNotNull()
    return F.when(keep, med), F.when(keep, ttft)


def llm_report(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Display table of one LLM cohort, ranked by pass rate."""
    rows = cohorts.cohort_rows(spark, sf, kind)
    meta = fx.fx6_meta(spark, sf)
    r = L.with_license(rows, fx.fx7_license_cache(spark, sf), meta)
    r = r.join(meta.select("name", F.col("release_date"), F.col("hf_repo")), "name", "left")
    med, ttft = perf_values(F.col("playbooks"))
    link = F.when(F.col("is_saas"), C.provider_case("profile", 2, "")).otherwise(C.hub_link_from_profile("profile"))
    link = F.when((link == "") & C.nz("hf_repo").isNotNull(), F.concat(F.lit("https://huggingface.co/"), "hf_repo")
                  ).otherwise(link)
    cells = r.select(
        "run_dir", "stem", "name", "pass_rate", link.alias("link"),
        release_cell(F.col("release_date")).alias("release"),
        overall_cell(F.col("overall"), F.col("pass_rate")).alias("overall_cell"),
        F.coalesce("knockouts", F.lit(0)).cast("string").alias("ko_cell"),
        *[pct_cell(F.col("pb")[k]["pass_rate"]).alias(f"{c}_cell") for k, c in SHOWN_PLAYBOOKS],
        tok_cell(med).alias("tok_s_cell"), ttft_cell(ttft).alias("ttft_cell"), "license")
    key = F.coalesce(C.tcast(C.nz("pass_rate"), "double"), F.lit(0.0))
    ranked = pick.rank_within(cells, [], [key.desc(), F.col("stem")], out="position").drop("pass_rate", "run_dir")
    return pick.best_shown(ranked, BEST_LLM)
