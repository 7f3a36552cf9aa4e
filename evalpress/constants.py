"""Fixed values.

FIXED VALUES -- these must equal the behaviour being rebuilt for the results to
match, so they are stated plainly and in their natural order.  Everything
else in the package is parameters.
"""
from __future__ import annotations

# --- fixed values: publication filter ------------------------------------
RAW_FIELDS = ("results", "per_case", "cases", "worst_cases", "knockouts",
              "response", "thinking", "reasoning", "metadata", "judge_raw",
              "stt_prompt", "voice_instruct")
RAW_SUFFIXES = ("_transcript", "_endpoint", "_url", "_api_key", "_token")
WITHHELD_FIELD_PATTERN = r"(?i)security|jailbreak|injection|pii"

# --- fixed values: playbooks ----------------------------------------------
# playbook -> dataset column suffix (judge playbooks)
PLAYBOOK_COLUMN = (("01_quality", "quality"), ("02_german_language", "german"),
                   ("03_bias", "bias"), ("05_code", "code"))
PERF_PLAYBOOK = "06_performance"
PERF_TEST_ID = "perf_benchmark"
ERROR_VERDICT = "error"

# --- fixed values: identifiers --------------------------------------------
# quantisation suffix -> label, in matching order
QUANT_SUFFIXES = (("bnb-4bit", "bnb-4bit"), ("nvfp4", "NVFP4"), ("fp8", "FP8"),
                  ("awq", "AWQ"), ("gptq", "GPTQ"), ("int8", "INT8"),
                  ("int4", "INT4"), ("w4a16", "W4A16"), ("mxfp4", "MXFP4"))
VARIANT_SUFFIXES = ("-DFlash", "-DSpark", "-MTP")
HUB_URL = "https://huggingface.co/"

# --- fixed values: SaaS providers (needle, label, url), first match wins ---
SAAS_PROVIDERS = (
    ("claude", "Anthropic · proprietär", "https://www.anthropic.com/claude"),
    ("gpt", "OpenAI · proprietär", "https://platform.openai.com/docs/models"),
    ("gemini", "Google · proprietär", "https://ai.google.dev/gemini-api/docs/models"),
    ("grok", "xAI · proprietär", "https://docs.x.ai/docs/models"),
    ("xai", "xAI · proprietär", "https://docs.x.ai/docs/models"),
    ("magistral", "Mistral · proprietär", "https://docs.mistral.ai/getting-started/models/"),
    ("ministral", "Mistral · proprietär", "https://docs.mistral.ai/getting-started/models/"),
    ("mistral", "Mistral · proprietär", "https://docs.mistral.ai/getting-started/models/"),
)
SAAS_LICENSE_DEFAULT = "proprietär (API)"
NO_VALUE = "—"

# --- fixed values: serving ------------------------------------------------
RUNNER_DEFAULT_IMAGE = "vllm/vllm-openai:v0.26.0"
VERSION_SOURCE_PROFILE = "profile_tag"
VERSION_SOURCE_DEFAULT = "runner_default"
VERSION_SOURCE_NONE = "unbestimmt"
VERSION_SOURCE_NOT_VLLM = "kein_vllm"

# --- fixed values: header values per config -------------------------------
HARDWARE_LOCAL = "dgx-spark-gb10"
HARDWARE_SAAS = "saas-cloud"
SERVED_BY = {"llm_local": "vllm", "llm_saas": "litellm-proxy", "guardrails": "vllm",
             "tts_de": "tts-adapter", "t2i": "diffusers"}
CONFIGS = ("llm_local", "llm_saas", "guardrails", "tts_de", "t2i")
RUBRIC_BASE = "https://example.org/playbooks"  # parameter: where the rubric files are published
IMAGE_JUDGE_MODEL = "qwen/qwen3.7-plus"
JUDGE_REASON_GUARD = "kein Judge — der Testsatz ist gelabelt, gemessen wird gegen das Label"
JUDGE_REASON_TTS = ("kein Judge — WER/CER gegen den Ausgangstext; die ASR-Modelle "
                    "stehen unter instruments")
JUDGE_NOTE_IMAGE = "default of the image orchestrator; not recorded in the run"
HW_LOCAL = {"name": "NVIDIA DGX Spark", "soc": "GB10", "arch": "sm_120",
            "memory_gb": 128, "cpu_arch": "aarch64"}
HW_SAAS = {"name": "SaaS API",
           "note": "Anbieter-Infrastruktur, Durchsatz und TTFT messen Cloud und Netzweg"}

# --- fixed values: expected rows per config (build check) -----------------
EXPECTED_ROWS = {"llm_local": 20, "llm_saas": 28, "guardrails": 5, "tts_de": 16, "t2i": 6}

# --- fixed values: report statuses ----------------------------------------
STATUS_RANK = (("valid", 0), ("running", 1), ("degraded", 2), ("pending", 3), ("na", 4))
REGISTRY_STATUSES = ("ok", "gated", "missing", "undetermined", "error")

# --- fixed values: best-value direction per display column ----------------
BEST_DIRECTION = {
    "Gesamt": "max", "Tok/s": "max", "F1": "max", "Recall": "max",
    "Qualität": "max", "Deutsch": "max", "Bias": "max", "Code": "max", "Performance": "max",
    "HSF": "max", "Guardrails": "max", "Sicherheit": "max",
    "Textrender exakt": "max", "Prompt-Treue": "max",
    "TTFT": "min", "FPR": "min", "Trap-FPR": "min",
    "WER (Whisper)": "min", "WER (Voxtral)": "min",
    "Ø s/Bild": "min", "Textrender CER": "min",
    "Präz.": "max", "Acc": "max", "FN-Rate": "min", "Lat ø": "min", "Lat p95": "min",
}
GUARD_HIDDEN_METRICS = ("n_unsafe", "n_safe", "fn_rate", "latency_ms_p95")
# --- fixed values: shown names of known guard metrics (an unknown one shows its own) ---
GUARD_KEY_LABEL = {
    "n_unsafe": "Unsafe", "n_safe": "Safe", "recall": "Recall", "fn_rate": "FN-Rate", "fpr": "FPR",
    "trap_fpr": "Trap-FPR", "precision": "Präz.", "f1": "F1", "accuracy": "Acc",
    "latency_ms_mean": "Lat ø", "latency_ms_p95": "Lat p95",
}
GUARD_NAME = {
    "granite-guardian": "Granite-Guardian-4.1-8B", "gpt-oss-safeguard": "gpt-oss-safeguard-20b",
    "nemotron-3-5": "Nemotron-3.5-Content-Safety", "nemotron-3": "Nemotron-3-Content-Safety",
    "shieldstral": "Shieldstral-1.0-3B",
}

# --- fixed values: forbidden value patterns in written artifacts ----------
LEAK_RULES = (
    ("model_store_path", r"/hf_models/"),
    ("private_lan_address", r"\b10\.0\.0\.\d+"),
    ("local_endpoint", r"127\.0\.0\.1|localhost:\d+"),
    ("home_path", r"/home/[a-z]+/"),
    ("possible_key", r"(?i)(sk-[A-Za-z0-9]{16,}|hf_[A-Za-z0-9]{20,}|Bearer\s+\w{20,})"),
)
