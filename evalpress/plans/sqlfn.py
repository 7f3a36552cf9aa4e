"""DuckDB SQL text for the column jobs, used only to write oracle queries.

Each function returns an SQL expression over the given expression text and
mirrors the Spark expression of the same name in ``functions.columns``.
"""
from __future__ import annotations

from evalpress.constants import (
    HUB_URL, QUANT_SUFFIXES, RUNNER_DEFAULT_IMAGE, SAAS_PROVIDERS, VARIANT_SUFFIXES,
)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def pystrip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def nz(x: str) -> str:
    return f"nullif({x}, '')"


def basename(x: str) -> str:
    return f"string_split({x}, '/')[-1]"


def subject(model: str, stem: str) -> str:
    return basename(f"coalesce(nullif({model}, ''), {stem})")


def date_prefix(x: str) -> str:
    return f"nullif(regexp_extract({x}, '^(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1), '')"


def rate(x: str) -> str:
    v = f"TRY_CAST(nullif(CAST({x} AS VARCHAR), '') AS DOUBLE)"
    return f"(CASE WHEN {v} > 1.0 THEN round({v} / 100.0, 4) ELSE round({v}, 4) END)"


def json_number(x: str, key: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({x}, '\"{key}\"\\s*:\\s*([\\d.]+)', 1), '') AS DOUBLE)"


def replace_first_dashes(x: str) -> str:
    return f"regexp_replace({x}, '--', '/')"


def canonical_id(x: str) -> str:
    s = pystrip(f"coalesce({x}, '')")
    last = f"string_split({s}, '/')[-1]"
    s2 = f"(CASE WHEN {last} LIKE '%--%' THEN string_split(rtrim({s}, '/'), '/')[-1] ELSE {s} END)"
    return (f"(CASE WHEN {s} = '' THEN NULL WHEN {s2} LIKE '%--%' THEN {replace_first_dashes(s2)} "
            f"WHEN regexp_full_match({s2}, '[\\w.-]+/[\\w.-]+') THEN {s2} END)")


def strip_variant(x: str) -> str:
    parts = " ".join(f"WHEN suffix({x}, {q(s)}) THEN left({x}, length({x}) - {len(s)})"
                     for s in VARIANT_SUFFIXES)
    return f"(CASE {parts} ELSE {x} END)"


def quant_label(x: str, fallback: str = "none") -> str:
    name = f"lower(string_split(coalesce({x}, ''), '/')[-1])"
    parts = " ".join(f"WHEN suffix({name}, {q('-' + s)}) OR contains({name}, {q('-' + s + '-')}) THEN {q(lab)}"
                     for s, lab in QUANT_SUFFIXES)
    return f"(CASE {parts} ELSE {q(fallback)} END)"


def clean_ref(x: str) -> str:
    s = f"string_split({pystrip(f'coalesce({x}, {chr(39)}{chr(39)})')}, ' ')[1]"
    seg = f"list_filter(string_split({s}, '/'), lambda e: e LIKE '%--%')[1]"
    tail = f"string_split(rtrim({s}, '/'), '/')[-1]"
    return (f"(CASE WHEN {s} = '' THEN '' WHEN {seg} IS NOT NULL THEN {seg} "
            f"WHEN regexp_full_match({s}, '[\\w.-]+/[\\w.-]+') THEN {s} ELSE {tail} END)")


def engine_repo(x: str) -> str:
    raw = pystrip(f"coalesce({x}, '')")
    seg = f"list_filter(string_split({raw}, '/'), lambda e: e LIKE '%--%')[1]"
    return (f"(CASE WHEN {seg} IS NOT NULL THEN {replace_first_dashes(seg)} "
            f"WHEN regexp_full_match({raw}, '[\\w.-]+/[\\w.-]+') THEN {raw} ELSE '' END)")


def slugify(x: str) -> str:
    return f"regexp_replace(regexp_replace(lower({x}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"


def release_key(x: str) -> str:
    return f"TRY_CAST(nullif(replace(regexp_extract({x}, '^(\\d{{4}})-(\\d{{2}})', 0), '-', ''), '') AS INTEGER)"


def provider(x: str, field: int, default: str) -> str:
    low = f"lower(coalesce({x}, ''))"
    parts = " ".join(f"WHEN contains({low}, {q(r[0])}) THEN {q(r[field])}" for r in SAAS_PROVIDERS)
    return f"(CASE {parts} ELSE {q(default)} END)"


def cell_number(cell: str) -> str:
    s = f"regexp_replace(regexp_replace({cell}, '\\s+', '', 'g'), ',', '.')"
    return (f"CASE WHEN regexp_full_match({s}, '(?i)-?\\d+(?:\\.\\d+)?(?:%|s|ms|x|×|GB|GiB|MB|tok/s)?') "
            f"THEN CAST(regexp_extract({s}, '^-?\\d+(?:\\.\\d+)?', 0) AS DOUBLE) END")


def best_shown(directions: dict[str, str]) -> str:
    """Select list of the marks of the columns that show the best number."""
    return ", ".join(f"coalesce({cell_number(c)} = {d}({cell_number(c)}) OVER (), false) AS best_{c.removesuffix('_cell')}"
                     for c, d in directions.items())


def hub_link(profile: str) -> str:
    p = f"coalesce({profile}, '')"
    return f"(CASE WHEN {p} LIKE '%--%' THEN {q(HUB_URL)} || {replace_first_dashes(p)} ELSE '' END)"


def serving(text: str) -> tuple[str, str, str]:
    found = f"nullif(regexp_extract(coalesce({text}, ''), '(?m)^PROFILE_DOCKER_IMAGE=''([^'']+)''', 1), '')"
    image = f"coalesce({found}, {q(RUNNER_DEFAULT_IMAGE)})"
    source = f"(CASE WHEN {found} IS NOT NULL THEN 'profile_tag' ELSE 'runner_default' END)"
    tag = f"string_split({image}, ':')[-1]"
    version = f"(CASE WHEN regexp_full_match({tag}, 'v?\\d+\\.\\d+(\\.\\d+)?') THEN ltrim({tag}, 'v') ELSE '' END)"
    vsource = f"(CASE WHEN {version} <> '' THEN {source} ELSE 'unbestimmt' END)"
    return image, version, vsource


def fmt_num(x: str, decimals: int = 3) -> str:
    return f"(CASE WHEN {x} IS NULL THEN '—' ELSE printf('%.{decimals}f', round_even({x}, {decimals})) END)"


def fmt_int(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL THEN '—' ELSE CAST({x} AS VARCHAR) END)"


def fmt_percent(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL THEN '—' ELSE CAST(CAST(round_even({x} * 100.0, 0) AS BIGINT) AS VARCHAR) || '%' END)"
