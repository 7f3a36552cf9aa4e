"""All five metric tables together: union, run metadata (one nested row per
measurement run) and their oracles."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evalpress.constants import (
    CONFIGS, HW_LOCAL, HW_SAAS, IMAGE_JUDGE_MODEL, JUDGE_NOTE_IMAGE, JUDGE_REASON_GUARD,
    JUDGE_REASON_TTS, PLAYBOOK_COLUMN, RUBRIC_BASE, VERSION_SOURCE_NOT_VLLM,
)
from evalpress.functions import columns as C
from evalpress.functions.text import marker_block, version_line
from evalpress.operators import publish
from evalpress.plans import fixtures as fx
from evalpress.plans import cohorts, modal
from evalpress.plans import sqlfn as S
from evalpress.plans.schemas import HEADER, RUNS
from evalpress.plans.stage import staged
from evalpress.sources.tables import table

# the documents stand for the judge playbooks' texts; a block starts at a line
# beginning with this marker (the test corpus has no YAML playbooks)
PLAYBOOK_MARKER = "The"


def marts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The five metric tables (with the extra columns run metadata needs),
    each materialised once per session."""
    build = {
        "llm_local": lambda: cohorts.llm_mart(spark, sf, "llm_local"),
        "llm_saas": lambda: cohorts.llm_mart(spark, sf, "llm_saas"),
        "guardrails": lambda: modal.guard_mart(spark, sf),
        "tts_de": lambda: modal.tts_mart(spark, sf),
        "t2i": lambda: modal.image_mart(spark, sf),
    }
    return {cfg: staged(spark, sf, "mart_" + cfg, fn) for cfg, fn in build.items()}


def header_union(spark: SparkSession, sf: str, m: dict[str, DataFrame] | None = None) -> DataFrame:
    """The ten shared columns of all configs plus ``config``, in config order."""
    m = m or marts(spark, sf)
    out = None
    for cfg in CONFIGS:
        part = m[cfg].select(F.lit(cfg).alias("config"), *[c for c, _ in HEADER])
        out = part if out is None else out.unionByName(part)
    return out


def judge_provenance(spark: SparkSession, sf: str) -> DataFrame:
    """One row: the judge playbooks (name, prompt version, block hash, rubric
    url) sorted by name.  Bounded by the four judge playbooks.

    Every document belongs to one playbook.  A playbook's hash is one over
    the number of its blocks and the sums of four slices of their hashes: free
    of order, so partial sums combine and no text is gathered.  Its version is
    that of its first document that states one."""
    keys = [k for k, _ in PLAYBOOK_COLUMN]
    key = F.element_at(F.array(*[F.lit(k) for k in keys]), (F.pmod(F.col("doc_id"), F.lit(len(keys))) + 1).cast("int"))
    docs = table(spark, sf, "documents").select(
        "doc_id", key.alias("playbook"), F.sha2(marker_block("text", PLAYBOOK_MARKER), 256).alias("hash"),
        version_line("text").alias("version"))
    slices = [F.sum(F.conv(F.substring("hash", 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)")).cast("string") for k in range(4)]
    pb = docs.where(F.col("hash").isNotNull()).groupBy("playbook").agg(
        F.sha2(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *slices), 256).alias("hash"),
        F.min_by("version", F.when(F.col("version").isNotNull(), F.col("doc_id"))).alias("version"))
    pb = pb.select(F.struct(
        F.col("playbook"), F.col("version").alias("prompt_version"), F.col("hash").alias("prompt_sha256"),
        F.concat(F.lit(RUBRIC_BASE + "/"), F.col("playbook"), F.lit(".yaml")).alias("rubric_url")).alias("p"))
    return pb.agg(F.coalesce(F.sort_array(F.collect_list("p")),
                             F.array().cast(RUNS["judge"].dataType["playbooks"].dataType)).alias("playbooks"))


def _struct(values: dict, dtype) -> Column:
    fields = []
    for f in dtype.fields:
        v = values.get(f.name)
        fields.append((v if isinstance(v, Column) else F.lit(v)).cast(f.dataType).alias(f.name))
    return F.struct(*fields)


def runs_table(spark: SparkSession, sf: str, m: dict[str, DataFrame] | None = None) -> DataFrame:
    m = m or marts(spark, sf)
    hw_t, sv_t = RUNS["hardware"].dataType, RUNS["serving"].dataType
    jd_t, in_t = RUNS["judge"].dataType, RUNS["instruments"].dataType
    prov = judge_provenance(spark, sf)
    withheld = publish.withheld_playbooks(fx.fx1_cases(spark, sf), "playbook", fx.ALLOWED_PLAYBOOKS)
    texts = fx.fx8_profile_text(spark, sf).select(F.col("profile").alias("_pt_profile"), F.col("text").alias("_pt_text"))
    empty = F.array().cast("array<string>")
    out = None
    for cfg in CONFIGS:
        d = m[cfg]
        vllm = cfg in ("llm_local", "guardrails")
        if vllm:
            d = d.join(texts, C.strip_variant("served_model_ref") == F.col("_pt_profile"), "left")
            image, version, vsource = C.serving_version("_pt_text")
            serving = _struct({"stack": F.col("served_by"), "image": image, "version": version,
                               "version_source": vsource}, sv_t)
        else:
            serving = _struct({"stack": F.col("served_by"), "image": "", "version": "",
                               "version_source": VERSION_SOURCE_NOT_VLLM}, sv_t)
        hardware = _struct(HW_SAAS if cfg == "llm_saas" else HW_LOCAL, hw_t)
        instruments = F.lit(None).cast(in_t)
        excluded = empty
        if cfg.startswith("llm"):
            d = d.crossJoin(F.broadcast(prov)).crossJoin(F.broadcast(withheld))
            judge = _struct({"model": C.nz("_judge"), "temperature": 0.0,
                             "recorded_in_run": F.coalesce(C.nz("_judge").isNotNull(), F.lit(False)),
                             "playbooks": F.col("playbooks")}, jd_t)
            excluded = F.coalesce(F.col("excluded"), empty)
        elif cfg == "guardrails":
            judge = _struct({"reason": JUDGE_REASON_GUARD}, jd_t)
        elif cfg == "tts_de":
            judge = _struct({"reason": JUDGE_REASON_TTS}, jd_t)
            instruments = _struct({"asr_whisper": C.nz("_asr1"), "asr_voxtral": C.nz("_asr2"),
                                   "protocol": C.nz("_protocol"), "testset": C.nz("_testset"),
                                   "n_repeats": F.col("n_repeats")}, in_t)
        else:
            judge = _struct({"model": IMAGE_JUDGE_MODEL, "recorded_in_run": False,
                             "playbooks": F.array().cast(jd_t["playbooks"].dataType),
                             "note": JUDGE_NOTE_IMAGE}, jd_t)
            instruments = _struct({"ocr_model": IMAGE_JUDGE_MODEL, "ocr_recorded_in_run": False}, in_t)
        part = d.select(
            F.col("run_id"), F.lit(cfg).alias("config"), F.col("_entity").alias("entity"),
            F.col("model_id"), F.date_format("measured_at", "yyyy-MM-dd").alias("measured_at"),
            F.col("valid"), hardware.alias("hardware"), serving.alias("serving"), judge.alias("judge"),
            instruments.alias("instruments"), excluded.alias("excluded"))
        out = part if out is None else out.unionByName(part)
    return out


HARDWARE_LEAVES = ("name", "soc", "arch", "cpu_arch", "memory_gb", "note")


def flatten_runs(r: DataFrame) -> DataFrame:
    """Flat view of run metadata for comparison."""
    pbs = F.col("judge.playbooks")
    return r.select(
        "run_id", "config", "entity", "model_id", "measured_at", "valid",
        *[F.col(f"hardware.{k}").alias(f"hardware_{k}") for k in HARDWARE_LEAVES],
        F.col("serving.stack").alias("serving_stack"), F.col("serving.image").alias("serving_image"),
        F.col("serving.version").alias("serving_version"),
        F.col("serving.version_source").alias("serving_version_source"),
        F.col("judge.model").alias("judge_model"), F.col("judge.temperature").alias("judge_temperature"),
        F.col("judge.recorded_in_run").alias("judge_recorded_in_run"),
        F.col("judge.reason").alias("judge_reason"), F.col("judge.note").alias("judge_note"),
        F.size(pbs).cast("int").alias("judge_n_playbooks"),
        F.concat_ws(";", F.transform(pbs, lambda p: F.concat_ws(
            ":", p["playbook"], F.coalesce(p["prompt_version"], F.lit("")), p["prompt_sha256"], p["rubric_url"])))
        .alias("judge_playbooks"),
        F.col("instruments.asr_whisper").alias("instruments_asr_whisper"),
        F.col("instruments.asr_voxtral").alias("instruments_asr_voxtral"),
        F.col("instruments.protocol").alias("instruments_protocol"),
        F.col("instruments.testset").alias("instruments_testset"),
        F.col("instruments.n_repeats").alias("instruments_n_repeats"),
        F.col("instruments.ocr_model").alias("instruments_ocr_model"),
        F.col("instruments.ocr_recorded_in_run").alias("instruments_ocr_recorded_in_run"),
        F.concat_ws(",", "excluded").alias("excluded"),
    )


# ------------------------------------------------------------------- SQL
def _llm_cte(config: str) -> str:
    return (f"{config}_mart AS (SELECT m.*, nullif(st.sha, '') AS model_revision FROM ({cohorts.llm_mart_sql_body(config)}) m "
            "LEFT JOIN store st ON st.id = m.model_id)")


ALL_MART_CTES = (cohorts.BASE_SQL + [cohorts.pb_wide_sql(), fx.FX6_SQL, fx.FX7_STORE_SQL, _llm_cte("llm_local"),
                                 _llm_cte("llm_saas")]
                 + modal.GUARD_CTES + modal.TTS_CTES + modal.IMG_CTES)

MART_CTE = {"llm_local": "llm_local_mart", "llm_saas": "llm_saas_mart", "guardrails": "guard_mart",
            "tts_de": "tts_mart", "t2i": "img_mart"}


def header_union_sql() -> str:
    cols = ", ".join(c for c, _ in HEADER)
    return "hdr AS (" + " UNION ALL ".join(f"SELECT '{cfg}' AS config, {cols} FROM {MART_CTE[cfg]}"
                                           for cfg in CONFIGS) + ")"


_PROV_KEYS = [k for k, _ in PLAYBOOK_COLUMN]
PROV_SQL = f"""prov AS (
  SELECT count(*) AS n_pb, coalesce(string_agg(
    playbook || ':' || coalesce(version, '') || ':' || digest || ':{RUBRIC_BASE}/' || playbook || '.yaml', ';' ORDER BY playbook), '') AS pbs
  FROM (SELECT playbook, arg_min(v, doc_id) AS version, sha256(concat_ws(':', count(*)::VARCHAR, {", ".join(
      f"sum(CAST('0x' || substr(sha256(b), {1 + 15 * k}, 15) AS BIGINT))::VARCHAR" for k in range(4))})) AS digest
        FROM (SELECT doc_id, nullif(regexp_extract(text, '(?m)^version:\\s*"?([^"\\n]+)"?', 1), '') AS v,
                     {fx.sql_list(_PROV_KEYS)}[doc_id % {len(_PROV_KEYS)} + 1] AS playbook,
                     nullif(regexp_replace(regexp_extract(text, '(?m)^{PLAYBOOK_MARKER}[^\\n]*(\\n([ \\t][^\\n]*)?)*', 0),
                                           '\\s+$', ''), '') AS b
              FROM documents) t WHERE b IS NOT NULL GROUP BY playbook) d)"""

WITHHELD_SQL = f"""withheld AS (SELECT coalesce(string_agg(playbook, ',' ORDER BY playbook), '') AS excluded
  FROM (SELECT DISTINCT playbook FROM fx1 WHERE playbook NOT IN {cohorts.ALLOWED_IN}))"""


def _hardware_sql(values: dict) -> str:
    literal = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
    return ", ".join(f"{literal(values.get(k))} AS hardware_{k}" for k in HARDWARE_LEAVES)


def _serving_sql(ref: str):
    img, ver, src = S.serving("pt.text")
    return img, ver, src


def runs_flat_sql() -> str:
    img, ver, src = S.serving("pt.text")
    cols_common = "run_id, '{cfg}' AS config, entity, model_id, strftime(measured_at, '%Y-%m-%d') AS measured_at, valid"
    hw_local, hw_saas = _hardware_sql(HW_LOCAL), _hardware_sql(HW_SAAS)
    serv_vllm = (f"served_by AS serving_stack, {img} AS serving_image, {ver} AS serving_version, "
                 f"{src} AS serving_version_source")
    serv_none = (f"served_by AS serving_stack, '' AS serving_image, '' AS serving_version, "
                 f"'{VERSION_SOURCE_NOT_VLLM}' AS serving_version_source")
    no_instr = ("NULL AS instruments_asr_whisper, NULL AS instruments_asr_voxtral, NULL AS instruments_protocol, NULL AS instruments_testset, "
                "NULL AS instruments_n_repeats, NULL AS instruments_ocr_model, NULL AS instruments_ocr_recorded_in_run")
    parts = []
    for cfg in ("llm_local", "llm_saas"):
        vllm = cfg == "llm_local"
        parts.append(f"""SELECT {cols_common.format(cfg=cfg)}, {hw_local if vllm else hw_saas},
  {serv_vllm if vllm else serv_none},
  nullif(judge, '') AS judge_model, CAST(0.0 AS DOUBLE) AS judge_temperature, nullif(judge, '') IS NOT NULL AS judge_recorded_in_run,
  NULL AS judge_reason, NULL AS judge_note, CAST(prov.n_pb AS INTEGER) AS judge_n_playbooks, prov.pbs AS judge_playbooks,
  {no_instr}, withheld.excluded AS excluded
FROM {MART_CTE[cfg]} m CROSS JOIN prov CROSS JOIN withheld
{"LEFT JOIN profile_text pt ON pt.profile = " + S.strip_variant("m.served_model_ref") if vllm else ""}""")
    parts.append(f"""SELECT {cols_common.format(cfg='guardrails')}, {hw_local}, {serv_vllm},
  NULL, NULL, NULL, '{JUDGE_REASON_GUARD}', NULL, NULL, '', {no_instr}, ''
FROM guard_mart m LEFT JOIN profile_text pt ON pt.profile = {S.strip_variant('m.served_model_ref')}""")
    parts.append(f"""SELECT {cols_common.format(cfg='tts_de')}, {hw_local}, {serv_none},
  NULL, NULL, NULL, '{JUDGE_REASON_TTS}', NULL, NULL, '',
  nullif(asr1, ''), nullif(asr2, ''), nullif(tprotocol, ''), nullif(testset, ''), n_repeats, NULL, NULL, ''
FROM tts_mart""")
    parts.append(f"""SELECT {cols_common.format(cfg='t2i')}, {hw_local}, {serv_none},
  '{IMAGE_JUDGE_MODEL}', NULL, false, NULL, '{JUDGE_NOTE_IMAGE}', 0, '',
  NULL, NULL, NULL, NULL, NULL, '{IMAGE_JUDGE_MODEL}', false, ''
FROM img_mart""")
    return " UNION ALL ".join(parts)


RUNS_CTES = ALL_MART_CTES + [fx.FX8_PROFILE_SQL, PROV_SQL, WITHHELD_SQL]


def runs_sql(extra_ctes=(), select: str | None = None) -> str:
    """Oracle over the flat run metadata; ``select`` may use ``runs_flat``."""
    if select:
        return fx.with_(*RUNS_CTES, f"runs_flat AS ({runs_flat_sql()})", *extra_ctes) + select
    return fx.with_(*RUNS_CTES) + runs_flat_sql()
