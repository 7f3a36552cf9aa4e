"""Declared output schemas: shared header, five metric tables, run metadata,
and the read schema of an LLM report file."""
from __future__ import annotations

from pyspark.sql import types as T

S, D_, I, B, DT = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType(), T.DateType()

HEADER = [
    ("run_id", S), ("model_id", S), ("base_model_id", S), ("served_model_ref", S),
    ("model_revision", S), ("quantization", S), ("served_by", S), ("hardware", S),
    ("measured_at", DT), ("valid", B),
]

LLM_COLUMNS = HEADER + [
    ("n_tests", I), ("throughput_tok_s_median", D_), ("throughput_tok_s_mean", D_),
    ("ttft_ms_p50", D_), ("perf_threshold_pass", D_),
    ("judge_verdict", S), ("judge_pass_rate_overall", D_),
    ("judge_pass_rate_quality", D_), ("judge_mean_score_quality", D_),
    ("judge_pass_rate_german", D_), ("judge_mean_score_german", D_),
    ("judge_pass_rate_bias", D_), ("judge_mean_score_bias", D_),
    ("judge_pass_rate_code", D_), ("judge_mean_score_code", D_),
    ("judge_knockouts", I),
]

GUARD_COLUMNS = HEADER + [
    ("guard_protocol", S), ("threshold", D_), ("reasoning_effort", S),
    ("n_unsafe", I), ("n_safe", I), ("tp", I), ("tn", I), ("fp", I), ("fn", I),
    ("errors", I), ("recall", D_), ("fn_rate", D_), ("fpr", D_), ("trap_fpr", D_),
    ("precision", D_), ("f1", D_), ("accuracy", D_),
    ("latency_ms_mean", D_), ("latency_ms_p95", D_),
]

TTS_COLUMNS = HEADER + [
    ("voice_id", S), ("n_repeats", I),
    ("n_total", I), ("n_ok", I), ("n_error", I), ("n_asr_runaway", I),
    ("rtf_mean", D_), ("sec_per_char_median", D_), ("sec_per_char_mean", D_),
    ("asr_wer_whisper", D_), ("asr_wer_voxtral", D_), ("asr_wer_mean", D_),
    ("asr_wer_capped_mean", D_), ("asr_wer_best_mean", D_), ("asr_cer_mean", D_),
]

T2I_COLUMNS = HEADER + [
    ("n_cases", I), ("n_generated", I), ("n_failed", I), ("gen_seconds_mean", D_),
    ("ocr_text_cer_mean", D_), ("ocr_text_exact_rate", D_),
    ("judge_adherence_score_mean", D_),
]

TABLE_COLUMNS = {"llm_local": LLM_COLUMNS, "llm_saas": LLM_COLUMNS, "guardrails": GUARD_COLUMNS,
                 "tts_de": TTS_COLUMNS, "t2i": T2I_COLUMNS}


def struct_of(cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


HARDWARE = struct_of([("name", S), ("soc", S), ("arch", S), ("memory_gb", I), ("cpu_arch", S), ("note", S)])
PLAYBOOK_PROV = T.ArrayType(struct_of([("playbook", S), ("prompt_version", S),
                                       ("prompt_sha256", S), ("rubric_url", S)]))
RUNS = T.StructType([
    T.StructField("run_id", S), T.StructField("config", S), T.StructField("entity", S),
    T.StructField("model_id", S), T.StructField("measured_at", S), T.StructField("valid", B),
    T.StructField("hardware", HARDWARE),
    T.StructField("serving", struct_of([("stack", S), ("image", S), ("version", S), ("version_source", S)])),
    T.StructField("judge", struct_of([("model", S), ("temperature", D_), ("recorded_in_run", B),
                                      ("reason", S), ("note", S), ("playbooks", PLAYBOOK_PROV)])),
    T.StructField("instruments", struct_of([("asr_whisper", S), ("asr_voxtral", S), ("protocol", S),
                                            ("testset", S), ("n_repeats", I), ("ocr_model", S),
                                            ("ocr_recorded_in_run", B)])),
    T.StructField("excluded", T.ArrayType(S)),
])

RESULT = struct_of([("test_id", S), ("verdict", S), ("response", S), ("pos", T.LongType())])
PLAYBOOK_ENTRY = struct_of([("pass_rate", D_), ("mean_score", D_), ("total", I), ("passed", I),
                            ("knockouts", T.ArrayType(S)), ("results", T.ArrayType(RESULT))])
REPORT = T.StructType([
    T.StructField("meta", struct_of([("model", S), ("source", S), ("profile", S), ("run", S), ("judge", S)])),
    T.StructField("summary", struct_of([("overall", S), ("pass_rate", S), ("knockouts", I), ("total_tests", I)])),
    T.StructField("playbooks", T.MapType(S, PLAYBOOK_ENTRY)),
    T.StructField("_corrupt", S),
])
