"""Roster status and display-table queries (ops 27, 28, 37, 38, 47, 61, 83-87)."""
from __future__ import annotations

from pyspark.sql import functions as F

from evalpress.constants import BEST_DIRECTION, GUARD_HIDDEN_METRICS, GUARD_KEY_LABEL, NO_VALUE
from evalpress.functions import columns as C
from evalpress.operators import lookups as L, pick
from evalpress.plans import fixtures as fx
from evalpress.plans import cohorts, modal
from evalpress.plans import roster as R
from evalpress.plans import sqlfn as S
from evalpress.plans.registry import query

W = fx.with_
ERROR_SHARE_SUFFIX = "% Fehler"

ROSTER_SQL = [
    fx.FX5_SQL,
    """roster AS (SELECT name, profile, coalesce(active, true) AS active,
   (NOT coalesce(active, true)) AND regexp_matches(name || ' ' || coalesce(notes, ''), '\\bN/?A\\b') AS na
 FROM fx5 WHERE nullif(profile, '') IS NOT NULL AND coalesce(machine, '') <> 'saas'
   AND name NOT IN (SELECT name FROM deny))""",
    """lreps AS (SELECT r.name, arg_max_null(r.stem, r.stem) AS stem, arg_max_null(r.total, r.stem) AS total,
   arg_max_null(r.total > 0 AND r.err * 10 <= r.total * 3, r.stem) AS valid,
   arg_max_null(CASE WHEN r.total > 0 THEN CAST(r.err AS DOUBLE) / r.total ELSE 1.0 END, r.stem) AS err_rate,
   arg_max_null(r.profile, r.stem) AS profile, arg_max_null(r.knockouts, r.stem) AS knockouts
 FROM rows r WHERE r.run_dir IN (SELECT run_dir FROM local_cohort) AND NOT r.is_saas
   AND r.name NOT IN (SELECT name FROM deny) GROUP BY r.name)""",
    """vset AS (SELECT name, f.pass_rate AS pass_rate, f.overall AS overall, f.knockouts AS knockouts, f.stem AS stem, f.profile AS profile
 FROM (SELECT s.name, arg_max({'pass_rate': s.pass_rate, 'overall': s.overall, 'knockouts': s.knockouts, 'stem': s.stem, 'profile': s.profile},
                              (-coalesce(TRY_CAST(nullif(s.pass_rate, '') AS DOUBLE), 0), s.stem)) AS f
       FROM sized s JOIN local_cohort c USING (run_dir) GROUP BY s.name) k)""",
    f"""rs AS (SELECT coalesce(o.name, r.name) AS name,
   CASE WHEN o.name IS NULL THEN CASE WHEN r.valid THEN 'valid' ELSE 'degraded' END
        WHEN v.name IS NOT NULL THEN 'valid'
        WHEN o.na THEN 'na'
        WHEN r.name IS NOT NULL AND r.total > 0 AND NOT r.valid THEN 'degraded'
        WHEN o.profile = '{R.RUNNING_PROFILE}' THEN 'running'
        ELSE 'pending' END AS status,
   o.name IS NOT NULL AS in_roster, r.name IS NOT NULL AS has_report, r.valid AS report_valid,
   v.name IS NOT NULL AS in_valid_set, coalesce(nullif(o.profile, ''), r.profile, '') AS profile,
   r.err_rate, v.pass_rate AS valid_pass_rate, coalesce(o.active, false) AS active, coalesce(o.na, false) AS na,
   v.overall AS v_overall, v.knockouts AS v_knockouts, v.stem AS v_stem, v.profile AS v_profile,
   r.knockouts AS r_knockouts, r.stem AS r_stem
 FROM roster o FULL OUTER JOIN lreps r ON o.name = r.name LEFT JOIN vset v ON v.name = coalesce(o.name, r.name)
 WHERE o.name IS NULL OR o.active OR o.na OR r.name IS NOT NULL)""",
    """rsr AS (SELECT *, CASE status WHEN 'valid' THEN 0 WHEN 'running' THEN 1 WHEN 'degraded' THEN 2
                                    WHEN 'pending' THEN 3 WHEN 'na' THEN 4 END AS status_rank FROM rs)""",
]
ROSTER_CTES = cohorts.BASE_SQL + ROSTER_SQL


def position_sql(t: str = "") -> str:
    """Status rank, pass rate of valid rows descending, lower-case name."""
    p = f"{t}." if t else ""
    return f"""row_number() OVER (ORDER BY {p}status_rank,
  CASE WHEN {p}status = 'valid' AND {p}in_valid_set
       THEN coalesce(TRY_CAST(nullif({p}valid_pass_rate, '') AS DOUBLE), 0) ELSE 0 END DESC,
  lower({p}name), {p}name)"""


POSITION_SQL = position_sql()


@query("build_roster", W(*cohorts.BASE_SQL, *ROSTER_SQL[:2]) + "SELECT name, profile, active, na FROM roster")
def q_build_roster(spark, sf):
    return R.build_roster(fx.fx5_roster_raw(spark, sf), cohorts.deny(spark, sf))


@query("filter_roster_visible", W(*ROSTER_CTES) + "SELECT name, active, na, has_report FROM rs WHERE in_roster")
def q_roster_visible(spark, sf):
    return R.roster_status(spark, sf).where(F.col("in_roster")).select("name", "active", "na", "has_report")


@query("join_roster_reports", W(*ROSTER_CTES) + """SELECT name, in_roster, has_report, report_valid, in_valid_set
FROM rs""")
def q_roster_join(spark, sf):
    return R.roster_status(spark, sf).select("name", "in_roster", "has_report", "report_valid", "in_valid_set")


@query("roster_status", W(*ROSTER_CTES) + "SELECT name, status FROM rs")
def q_roster_status(spark, sf):
    return R.roster_status(spark, sf).select("name", "status")


@query("status_histogram", W(*ROSTER_CTES) + """SELECT status, status_rank, count(*) AS n,
  (SELECT CAST(count_if(status = 'valid') AS DOUBLE) / count(*) FROM rsr) AS valid_share
FROM rsr GROUP BY status, status_rank""")
def q_status_hist(spark, sf):
    rs = R.roster_status(spark, sf)
    per = rs.groupBy("status", "status_rank").agg(F.count(F.lit(1)).alias("n"))
    tot = per.agg((F.coalesce(F.sum(F.when(F.col("status") == "valid", F.col("n"))), F.lit(0)).cast("double")
                   / F.sum("n")).alias("valid_share"))
    return per.crossJoin(F.broadcast(tot))


@query("sort_status_roster", W(*ROSTER_CTES) + f"SELECT name, status, {POSITION_SQL} AS position FROM rsr")
def q_sort_roster(spark, sf):
    rs = R.roster_status(spark, sf)
    return pick.rank_within(rs, [], R.sort_key(rs), out="position").select("name", "status", "position")


def _pct_sql(v):
    return f"(CASE WHEN {v} IS NULL THEN '{NO_VALUE}' ELSE CAST(CAST(round_even({v} * 100.0, 0) AS BIGINT) AS VARCHAR) || '%' END)"


def _overall_sql(o, pr):
    return f"coalesce(nullif({o}, ''), '{NO_VALUE}') || ' ' || coalesce({pr}, '') || '%'"


def _release_sql(d):
    return f"(CASE WHEN {S.release_key(d)} IS NOT NULL THEN {d} ELSE '{NO_VALUE}' END)"


_LOCAL_LICENSE_SQL = f"""coalesce(CASE WHEN lc.license <> '' AND lc.license <> '{NO_VALUE}' THEN lc.license END,
  nullif(m.license, ''), '{NO_VALUE}')"""


#: detail page of a report, by its file name
LLM_DETAIL_PAGE = ("m/", ".html")
_MED, _TTFT = S.json_number("w.perf_response", "throughput_median_tok_s"), S.json_number("w.perf_response", "ttft_p50_ms")
_PERF_CELLS = f"""CASE WHEN {_MED} IS NOT NULL THEN printf('%.1f', round_even({_MED}, 1)) ELSE '{NO_VALUE}' END AS tok_s_cell,
  CASE WHEN {_TTFT} IS NOT NULL THEN CAST(CAST(round_even({_TTFT}, 0) AS BIGINT) AS VARCHAR) || ' ms' ELSE '{NO_VALUE}' END AS ttft_cell"""
_PB_CELLS = ", ".join(f"{_pct_sql(f'w.pr_{c}')} AS {c}_cell" for _, c in R.SHOWN_PLAYBOOKS)


@query("report_llm_local", W(*ROSTER_CTES, cohorts.pb_wide_sql(), fx.FX6_SQL, fx.FX7_LIC_SQL, f"""cells AS (SELECT x.name, x.status,
  CASE WHEN x.status = 'valid' THEN {S.hub_link('x.v_profile')} ELSE '' END AS link,
  CASE WHEN x.status = 'valid' AND x.v_stem IS NOT NULL
       THEN '{LLM_DETAIL_PAGE[0]}' || x.v_stem || '{LLM_DETAIL_PAGE[1]}' ELSE '' END AS detail,
  {position_sql("x")} AS position, {_release_sql('m.release_date')} AS release,
  CASE x.status WHEN 'valid' THEN {_overall_sql('x.v_overall', 'x.valid_pass_rate')}
                WHEN 'degraded' THEN CAST(CAST(round_even(x.err_rate * 100, 0) AS BIGINT) AS VARCHAR) || '{ERROR_SHARE_SUFFIX}'
                ELSE '{NO_VALUE}' END AS overall_cell,
  CASE x.status WHEN 'valid' THEN CAST(coalesce(x.v_knockouts, 0) AS VARCHAR)
                WHEN 'degraded' THEN CAST(coalesce(x.r_knockouts, 0) AS VARCHAR) ELSE '{NO_VALUE}' END AS ko_cell,
  {_PB_CELLS}, {_PERF_CELLS}, {_LOCAL_LICENSE_SQL} AS license
FROM rsr x LEFT JOIN fx6 m ON m.name = x.name LEFT JOIN lic_cache lc ON lc.profile = x.profile
LEFT JOIN (SELECT pbw.* FROM pbw JOIN local_cohort USING (run_dir)) w
  ON w.stem = CASE x.status WHEN 'valid' THEN x.v_stem WHEN 'degraded' THEN x.r_stem END)""")
  + f"SELECT *, {S.best_shown(R.BEST_LLM)} FROM cells")
def q_report_local(spark, sf):
    """The roster with what its reports show; an entry that is neither valid nor
    degraded shows no values.  Marks compare the shown numbers of all rows."""
    rs = R.roster_status(spark, sf).withColumn("is_saas", F.lit(False))
    meta = fx.fx6_meta(spark, sf)
    rs = L.with_license(rs, fx.fx7_license_cache(spark, sf), meta)
    rs = rs.join(meta.select("name", "release_date"), "name", "left")
    st = F.col("status")
    overall = (F.when(st == "valid", R.overall_cell(F.col("v_overall"), F.col("valid_pass_rate")))
               .when(st == "degraded", F.concat(F.bround(F.col("err_rate") * 100, 0).cast("bigint").cast("string"),
                                                F.lit(ERROR_SHARE_SUFFIX)))
               .otherwise(F.lit(NO_VALUE)))
    ko = (F.when(st == "valid", F.coalesce("v_knockouts", F.lit(0)).cast("string"))
          .when(st == "degraded", F.coalesce("r_knockouts", F.lit(0)).cast("string")).otherwise(F.lit(NO_VALUE)))
    rs = rs.withColumn("_shown", F.when(st == "valid", F.col("v_shown")).when(st == "degraded", F.col("r_shown")))
    valid = (st == "valid") & F.col("v_shown").isNotNull()
    link = F.when(valid, C.hub_link_from_profile("v_shown.profile")).otherwise(F.lit(""))
    detail = F.when(valid, F.concat(F.lit(LLM_DETAIL_PAGE[0]), "v_shown.stem", F.lit(LLM_DETAIL_PAGE[1]))).otherwise(F.lit(""))
    cells = rs.select("name", "status", "status_rank", "in_valid_set", "valid_pass_rate", link.alias("link"), detail.alias("detail"),
                      R.release_cell(F.col("release_date")).alias("release"), overall.alias("overall_cell"), ko.alias("ko_cell"),
                      *[R.pct_cell(F.col(f"_shown.{c}")).alias(f"{c}_cell") for _, c in R.SHOWN_PLAYBOOKS],
                      R.tok_cell(F.col("_shown.tok_s")).alias("tok_s_cell"), R.ttft_cell(F.col("_shown.ttft")).alias("ttft_cell"), "license")
    ranked = pick.rank_within(cells, [], R.sort_key(cells), out="position").drop("status_rank", "in_valid_set", "valid_pass_rate")
    return pick.best_shown(ranked, R.BEST_LLM)


def _llm_report_sql(kind: str) -> str:
    cohort = "local_cohort" if kind == "local" else "saas_cohort"
    link = (f"(CASE WHEN s.is_saas THEN {S.provider('s.profile', 2, '')} ELSE {S.hub_link('s.profile')} END)")
    lic = f"""CASE WHEN s.is_saas THEN {S.provider('s.profile', 1, 'proprietär (API)')} ELSE {_LOCAL_LICENSE_SQL} END"""
    cells = f"""cells AS (SELECT s.stem, s.name,
  CASE WHEN {link} = '' AND nullif(m.hf_repo, '') IS NOT NULL THEN 'https://huggingface.co/' || m.hf_repo
       ELSE {link} END AS link,
  {_release_sql('m.release_date')} AS release, {_overall_sql('s.overall', 's.pass_rate')} AS overall_cell,
  CAST(coalesce(s.knockouts, 0) AS VARCHAR) AS ko_cell, {_PB_CELLS}, {_PERF_CELLS},
  {lic} AS license,
  row_number() OVER (ORDER BY coalesce(TRY_CAST(nullif(s.pass_rate, '') AS DOUBLE), 0) DESC, s.stem) AS position
FROM sized s JOIN {cohort} c USING (run_dir) JOIN pbw w ON w.run_dir = s.run_dir AND w.stem = s.stem
LEFT JOIN fx6 m ON m.name = s.name LEFT JOIN lic_cache lc ON lc.profile = coalesce(s.profile, ''))"""
    return (W(*cohorts.BASE_SQL, cohorts.pb_wide_sql(), fx.FX6_SQL, fx.FX7_LIC_SQL, cells)
            + f"SELECT *, {S.best_shown(R.BEST_LLM)} FROM cells")


@query("report_llm_saas", _llm_report_sql("saas"))
def q_report_saas(spark, sf):
    return R.llm_report(spark, sf, "saas")


# ------------------------------------------------------------------ guards
_GUARD_KEYS = ("n_unsafe", "n_safe", "recall", "fn_rate", "fpr", "trap_fpr", "precision", "f1",
               "accuracy", "latency_ms_mean", "latency_ms_p95")

#: link of a report's detail page, below the site's address
DETAIL_PAGE = ("g/", ".html")
FIRST_COLUMN, LAST_COLUMN = "Release", "Lizenz"


def _guard_sql() -> list[str]:
    items = ", ".join(f"{{'key': '{k}', 'kpos': {i}, 'v': CAST({k} AS DOUBLE)}}" for i, k in enumerate(_GUARD_KEYS))
    label = "CASE key " + " ".join(f"WHEN '{k}' THEN '{GUARD_KEY_LABEL[k]}'" for k in _GUARD_KEYS) + " ELSE key END"
    way = "CASE column_name " + " ".join(f"WHEN '{c}' THEN '{d}'" for c, d in BEST_DIRECTION.items()) + " END"
    return [f"""grow AS (SELECT g.*, {S.slugify('g.label')} AS slug, coalesce(gm.name, '') AS full_name
  FROM fx2 g LEFT JOIN guard_map gm ON gm.slug = {S.slugify('g.label')})""",
            f"glong AS (SELECT label, k.key, k.kpos, k.v FROM fx2, unnest([{items}]) t(k))",
            f"""gkeys AS (SELECT key, {label} AS column_name, row_number() OVER (ORDER BY min((label, kpos))) AS position
  FROM glong WHERE v IS NOT NULL AND key NOT IN {fx.sql_in(GUARD_HIDDEN_METRICS)} GROUP BY key)""",
            f"""gcells AS (SELECT label, position, column_name, {S.fmt_num('v')} AS cell, {way} AS way,
    TRY_CAST({S.fmt_num('v')} AS DOUBLE) AS shown FROM glong JOIN gkeys USING (key)
  UNION ALL SELECT g.label, 0, '{FIRST_COLUMN}', {_release_sql('m.release_date')}, NULL, NULL
  FROM grow g LEFT JOIN fx6 m ON m.name = g.full_name
  UNION ALL SELECT g.label, (SELECT count(*) + 1 FROM gkeys), '{LAST_COLUMN}', coalesce(nullif(m.license, ''), '{NO_VALUE}'), NULL, NULL
  FROM grow g LEFT JOIN fx6 m ON m.name = g.full_name)"""]


@query("report_guards", W(fx.FX2_SQL, fx.GUARD_MAP_SQL, fx.FX6_SQL, *_guard_sql()) + f"""SELECT c.label,
  CASE WHEN g.has_detail THEN '{DETAIL_PAGE[0]}' || g.slug || '{DETAIL_PAGE[1]}' ELSE '' END AS link,
  CAST(c.position AS INTEGER) AS position, c.column_name, c.cell,
  coalesce(CASE c.way WHEN 'max' THEN c.shown = max(c.shown) OVER (PARTITION BY c.column_name)
                      WHEN 'min' THEN c.shown = min(c.shown) OVER (PARTITION BY c.column_name) END, false) AS best
FROM gcells c JOIN grow g ON g.label = c.label""")
def q_report_guards(spark, sf):
    """One row per guard and column: the release, the metrics found in the
    reports in first-seen order, the license.  Best marks compare what is shown."""
    g = modal.guard_rows(spark, sf).withColumn("_json", F.to_json("metrics", {"ignoreNullFields": "false"}))
    meta = fx.fx6_meta(spark, sf).select(F.col("name").alias("full_name"), "release_date", "license")
    g = g.join(meta, "full_name", "left")
    link = F.when(F.col("has_detail"), F.concat(F.lit(DETAIL_PAGE[0]), "slug", F.lit(DETAIL_PAGE[1]))).otherwise(F.lit(""))
    found = pick.discover_json_keys(g, "_json", "label", GUARD_HIDDEN_METRICS)
    # one row with the names of the metrics in order, as many as reports have names for them
    names = found.agg(F.array_sort(F.collect_list(F.struct("first_row", "first_kpos", "key"))).alias("_keys"))
    values = F.from_json("_json", "map<string, string>")
    g = g.crossJoin(F.broadcast(names)).withColumn("_values", values)
    cells = F.transform("_keys", lambda k, i: F.struct(
        (i + 1).alias("position"), _shown_name(k["key"]).alias("column_name"), _shown(F.col("_values")[k["key"]]).alias("cell")))
    ends = [F.array(F.struct(at.alias("position"), F.lit(name).alias("column_name"), cell.alias("cell")))
            for at, name, cell in ((F.lit(0), FIRST_COLUMN, R.release_cell(F.col("release_date"))),
                                   (F.size("_keys") + 1, LAST_COLUMN, F.coalesce(C.nz("license"), F.lit(NO_VALUE))))]
    long = g.select("label", link.alias("link"), F.inline(F.concat(ends[0], cells, ends[1])))
    way = F.create_map(*[F.lit(x) for kv in BEST_DIRECTION.items() for x in kv])[F.col("column_name")]
    long = long.withColumn("_shown", F.when(way.isNotNull(), F.expr("try_cast(cell AS double)"))).withColumn("_way", way)
    edge = long.where("_shown IS NOT NULL").groupBy("column_name").agg(
        F.when(F.first("_way") == "max", F.max("_shown")).otherwise(F.min("_shown")).alias("_best"))
    return (long.join(edge, "column_name", "left")
            .select("label", "link", "position", "column_name", "cell",
                    F.coalesce(F.col("_shown") == F.col("_best"), F.lit(False)).alias("best")))


def _shown_name(key):
    return F.coalesce(F.create_map(*[F.lit(x) for kv in GUARD_KEY_LABEL.items() for x in kv])[key], key)


def _shown(text):
    """A JSON number as shown: whole numbers as they are, others with three digits."""
    return (F.when(text.isNull(), F.lit(NO_VALUE)).when(text.rlike(r"^-?\d+$"), text)
            .otherwise(F.format_string("%.3f", F.bround(text.cast("double"), 3))))


# ------------------------------------------------------------------- image
@query("report_image", W(*modal.IMG_CTES[:4], fx.FX6_SQL, f"""cells AS (SELECT d.model,
  CASE WHEN x.dir IS NOT NULL THEN 'https://huggingface.co/' || {S.replace_first_dashes('x.dir')} ELSE '' END AS link,
  {_release_sql('m.release_date')} AS release, {S.fmt_int('d.generated')} AS generated_cell,
  {S.fmt_num('d.gen_seconds_mean')} AS gen_seconds_cell, {S.fmt_num('d.text_rendering_cer_mean')} AS cer_cell,
  '{NO_VALUE}' AS exact_cell, {S.fmt_num('d.adherence_score_mean')} AS adherence_cell,
  coalesce(nullif(m.license, ''), '{NO_VALUE}') AS license,
  d.model = (SELECT arg_min(model, (CASE WHEN coalesce(gen_seconds_mean, 0) = 0 THEN 9e9 ELSE gen_seconds_mean END,
                                    first_path))
             FROM (SELECT model, arg_max_null(gen_seconds_mean, run_dir) AS gen_seconds_mean,
                          min(run_dir) AS first_path FROM fx4 GROUP BY model)) AS fastest
FROM img_latest d LEFT JOIN img_dirs x ON x.name = d.model LEFT JOIN fx6 m ON m.name = d.model)""")
  + f"SELECT *, {S.best_shown(R.BEST_IMAGE)} FROM cells")
def q_report_image(spark, sf):
    imgs = fx.fx4_images(spark, sf)
    latest = imgs.groupBy("model").agg(F.max_by(F.struct(*[c for c in imgs.columns if c != "model"]), "run_dir")
                                       .alias("_r"), F.min("run_dir").alias("first_path")).select("model", "_r.*",
                                                                                                 "first_path")
    fastest = pick.argmin_default(latest.select("model", "gen_seconds_mean", "first_path"), "gen_seconds_mean",
                                  "first_path").select(F.col("model").alias("_fastest"))
    dirs = modal.image_dirs(spark, sf).withColumnRenamed("name", "_dir_name")
    meta = fx.fx6_meta(spark, sf).select(F.col("name").alias("_m_name"), "release_date", "license")
    d = (latest.join(dirs, latest["model"] == dirs["_dir_name"], "left")
         .join(meta, F.col("model") == F.col("_m_name"), "left").crossJoin(F.broadcast(fastest)))
    cells = d.select(
        "model", F.when(F.col("dir").isNotNull(), F.concat(F.lit("https://huggingface.co/"),
                                                           C.replace_first_dashes("dir"))).otherwise(F.lit("")).alias("link"),
        R.release_cell(F.col("release_date")).alias("release"), C.fmt_int("generated").alias("generated_cell"),
        C.fmt_num("gen_seconds_mean").alias("gen_seconds_cell"), C.fmt_num("text_rendering_cer_mean").alias("cer_cell"),
        F.lit(NO_VALUE).alias("exact_cell"), C.fmt_num("adherence_score_mean").alias("adherence_cell"),
        F.coalesce(C.nz("license"), F.lit(NO_VALUE)).alias("license"),
        (F.col("model") == F.col("_fastest")).alias("fastest"))
    return pick.best_shown(cells, R.BEST_IMAGE)


# --------------------------------------------------------------------- TTS
@query("report_tts", W(fx.FX3_RESCORE_SQL, fx.FX3_SUMMARY_SQL, modal.TTS_ROWS_SQL, fx.FX6_SQL, f"""cells AS (SELECT t.voice,
  row_number() OVER (ORDER BY coalesce(t.wer_judge2_mean, 9), t.dir) AS position, t.hf AS link,
  {_release_sql('m.release_date')} AS release, {S.fmt_num('t.wer_judge1_mean')} AS wer_whisper_cell,
  {S.fmt_num('t.wer_judge2_mean')} AS wer_voxtral_cell, coalesce(nullif(m.license, ''), '{NO_VALUE}') AS license
FROM tts t LEFT JOIN fx6 m ON m.name = coalesce(t.engine, ''))""")
  + f"SELECT *, {S.best_shown(R.BEST_TTS)} FROM cells")
def q_report_tts(spark, sf):
    t = modal.tts_rows(spark, sf)
    meta = fx.fx6_meta(spark, sf).select(F.col("name").alias("_m_name"), "release_date", "license")
    t = t.join(meta, F.coalesce("engine", F.lit("")) == F.col("_m_name"), "left")
    cells = t.select("dir", "voice", "wer_judge2_mean", F.col("hf").alias("link"),
                     R.release_cell(F.col("release_date")).alias("release"),
                     C.fmt_num("wer_judge1_mean").alias("wer_whisper_cell"),
                     C.fmt_num("wer_judge2_mean").alias("wer_voxtral_cell"),
                     F.coalesce(C.nz("license"), F.lit(NO_VALUE)).alias("license"))
    key = F.coalesce(F.col("wer_judge2_mean"), F.lit(9.0))
    ranked = pick.rank_within(cells, [], [key, F.col("dir")], out="position").select(
        "voice", "position", "link", "release", "wer_whisper_cell", "wer_voxtral_cell", "license")
    return pick.best_shown(ranked, R.BEST_TTS)
