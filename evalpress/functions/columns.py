"""Column -> Column jobs.

Every helper here is a pure expression over built-in functions, so it stays
inside whole-stage codegen and applies to a whole table at once.  Regex notes
for the JVM: ``regexp_extract`` returns '' on no match (hence ``nz``), a full
match needs ``\\A...\\z`` because ``$`` also matches before a final newline,
and ``(?U)`` makes ``\\w`` match letters outside ASCII like Python does.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evalpress.constants import (
    QUANT_SUFFIXES, RUNNER_DEFAULT_IMAGE, SAAS_PROVIDERS, VARIANT_SUFFIXES,
    VERSION_SOURCE_DEFAULT, VERSION_SOURCE_NONE, VERSION_SOURCE_PROFILE, HUB_URL,
)

ColumnOrName = Column | str


def tcast(x, t: str) -> Column:
    """try_cast: null instead of an error on a bad value."""
    return (F.col(x) if isinstance(x, str) else x).try_cast(t)


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nz(x: ColumnOrName) -> Column:
    """'' -> null."""
    return F.nullif(_c(x), F.lit(""))


def pystrip(x: ColumnOrName) -> Column:
    """Python's ``str.strip()``: remove leading and trailing whitespace of any
    kind (``trim`` removes spaces only)."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+\z", "")


def first_nonnull(*cols: ColumnOrName) -> Column:
    """Value chain: the first non-null, non-empty candidate."""
    return F.coalesce(*[nz(c) for c in cols])


def falsy_default(x: ColumnOrName, default) -> Column:
    """Python's ``x or default``: null, '', false and zero of any numeric type
    take the default; a text ``'0'`` does not."""
    c = _c(x)
    s = c.cast("string")
    zero = (F.typeof(c) != "string") & F.coalesce((tcast(s, "double") == 0) | (s == "false"), s == "false")
    return F.when(c.isNull() | (s == "") | zero, F.lit(default)).otherwise(c)


def date_prefix(x: ColumnOrName) -> Column:
    """Leading ``YYYY-MM-DD`` of a text, else null."""
    return nz(F.regexp_extract(_c(x).cast("string"), r"^(\d{4}-\d{2}-\d{2})", 1))


def slugify(x: ColumnOrName) -> Column:
    s = F.regexp_replace(F.lower(_c(x).cast("string")), "[^a-z0-9]+", "-")
    return F.regexp_replace(s, "^-+|-+$", "")


def replace_first_dashes(x: ColumnOrName) -> Column:
    """Replace only the first ``--`` by ``/``."""
    return F.concat_ws("/", F.split(_c(x), "--", 2))


_OWNER_NAME = r"(?U)\A[\w.-]+/[\w.-]+\z"


def canonical_id(x: ColumnOrName) -> Column:
    """Raw model reference -> ``owner/name`` or null.

    The last path segment is taken only when it holds ``--``; then the first
    ``--`` is replaced.  A plain ``owner/name`` passes, anything else is null.
    """
    s = pystrip(F.coalesce(_c(x).cast("string"), F.lit("")))
    last = F.substring_index(s, "/", -1)
    s2 = F.when(last.contains("--"),
                F.substring_index(F.regexp_replace(s, "/+$", ""), "/", -1)).otherwise(s)
    return (F.when(s == "", F.lit(None).cast("string"))
            .when(s2.contains("--"), replace_first_dashes(s2))
            .when(s2.rlike(_OWNER_NAME), s2))


def quant_label(x: ColumnOrName, fallback: str = "none") -> Column:
    """First quantisation suffix (list order) that ends the name after '-' or
    stands between dashes; case-insensitive."""
    name = F.lower(F.substring_index(F.coalesce(_c(x).cast("string"), F.lit("")), "/", -1))
    expr = None
    for suffix, label in QUANT_SUFFIXES:
        cond = name.endswith("-" + suffix) | name.contains("-" + suffix + "-")
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(fallback))


def clean_ref(x: ColumnOrName) -> Column:
    """Strip machine paths from a model reference."""
    s = F.substring_index(pystrip(F.coalesce(_c(x).cast("string"), F.lit(""))), " ", 1)
    seg = F.try_element_at(F.filter(F.split(s, "/"), lambda e: e.contains("--")), F.lit(1))
    tail = F.substring_index(F.regexp_replace(s, "/+$", ""), "/", -1)
    return (F.when(s == "", F.lit(""))
            .when(seg.isNotNull(), seg)
            .when(s.rlike(_OWNER_NAME), s)
            .otherwise(tail))


def engine_repo(x: ColumnOrName) -> Column:
    """Engine repository of a voice: first ``owner--name`` segment as
    ``owner/name``, else a plain ``owner/name``, else ''."""
    raw = pystrip(F.coalesce(_c(x).cast("string"), F.lit("")))
    seg = F.try_element_at(F.filter(F.split(raw, "/"), lambda e: e.contains("--")), F.lit(1))
    return (F.when(seg.isNotNull(), replace_first_dashes(seg))
            .when(raw.rlike(_OWNER_NAME), raw)
            .otherwise(F.lit("")))


def strip_variant(x: ColumnOrName) -> Column:
    """Remove one serving-variant suffix (first match in list order)."""
    c = _c(x)
    expr = None
    for suffix in VARIANT_SUFFIXES:
        cond = c.endswith(suffix)
        val = F.substring(c, F.lit(1), F.length(c) - len(suffix))
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(c)


def json_number(text: ColumnOrName, key: str) -> Column:
    """Number after ``"key":`` in a possibly truncated JSON text; null if absent
    or not a number (``1.2.3``)."""
    pat = '"' + key + r'"\s*:\s*([\d.]+)'
    return tcast(nz(F.regexp_extract(_c(text), pat, 1)), "double")


def normalise_rate(x: ColumnOrName) -> Column:
    """Pass rate to 0..1: values above 1 are percents; rounded to 4 places."""
    v = lenient_double(x)
    return F.when(v > 1.0, F.round(v / 100.0, 4)).otherwise(F.round(v, 4))


def release_sort_key(x: ColumnOrName) -> Column:
    """``YYYY-MM...`` -> integer ``YYYYMM``; else null."""
    m = F.regexp_extract(_c(x).cast("string"), r"^(\d{4})-(\d{2})", 0)
    return tcast(nz(F.regexp_replace(m, "-", "")), "int")


def subject_basename(model: ColumnOrName, stem: ColumnOrName) -> Column:
    return F.substring_index(F.coalesce(nz(model), _c(stem)), "/", -1)


def provider_case(text: ColumnOrName, field: int, default) -> Column:
    """First SaaS provider rule (list order) whose needle occurs in the
    lower-cased text; ``field`` 1 = label, 2 = url."""
    low = F.lower(F.coalesce(_c(text), F.lit("")))
    expr = None
    for rule in SAAS_PROVIDERS:
        cond = low.contains(rule[0])
        expr = F.when(cond, F.lit(rule[field])) if expr is None else expr.when(cond, F.lit(rule[field]))
    return expr.otherwise(F.lit(default))


def hub_link_from_profile(profile: ColumnOrName) -> Column:
    p = F.coalesce(_c(profile), F.lit(""))
    return F.when(p.contains("--"), F.concat(F.lit(HUB_URL), replace_first_dashes(p))).otherwise(F.lit(""))


def serving_version(profile_text: ColumnOrName) -> tuple[Column, Column, Column]:
    """(image, version, version_source) from a profile text holding a line
    ``PROFILE_DOCKER_IMAGE='image:tag'``; the runner default otherwise."""
    found = nz(F.regexp_extract(F.coalesce(_c(profile_text), F.lit("")),
                                r"(?m)^PROFILE_DOCKER_IMAGE='([^']+)'", 1))
    image = F.coalesce(found, F.lit(RUNNER_DEFAULT_IMAGE))
    source = F.when(found.isNotNull(), F.lit(VERSION_SOURCE_PROFILE)).otherwise(F.lit(VERSION_SOURCE_DEFAULT))
    tag = F.substring_index(image, ":", -1)
    version = F.when(tag.rlike(r"\Av?\d+\.\d+(\.\d+)?\z"),
                     F.regexp_replace(tag, "^v+", "")).otherwise(F.lit(""))
    vsource = F.when(version != "", source).otherwise(F.lit(VERSION_SOURCE_NONE))
    return image, version, vsource


def fmt_num(x: ColumnOrName, decimals: int = 3) -> Column:
    """Display cell: dash for null, fixed decimals for floats."""
    c = _c(x)
    return F.when(c.isNull(), F.lit("—")).otherwise(F.format_string(f"%.{decimals}f", F.bround(c, decimals)))


def fmt_int(x: ColumnOrName) -> Column:
    c = _c(x)
    return F.when(c.isNull(), F.lit("—")).otherwise(c.cast("string"))


def fmt_percent(x: ColumnOrName) -> Column:
    """Share 0..1 as whole percent, half-even like the reference's ``round``."""
    c = _c(x)
    return F.when(c.isNull(), F.lit("—")).otherwise(
        F.concat(F.bround(c * 100.0, 0).cast("bigint").cast("string"), F.lit("%")))


def compose_run_id(config: ColumnOrName, subject: ColumnOrName, run: ColumnOrName,
                   fallback_date: ColumnOrName) -> Column:
    return F.concat_ws("/", _c(config), _c(subject), F.coalesce(nz(run), _c(fallback_date)))


def voice_from_run(run: ColumnOrName) -> Column:
    return F.regexp_replace(_c(run), r"^\d{4}-\d{2}-\d{2}_suite_", "")


_NUMBER = r"(?i)\A[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf|infinity|nan)\z"


def lenient_int(x: ColumnOrName) -> Column:
    """'' and null -> null; numbers via double, truncated; bad -> null."""
    return tcast(lenient_double(x), "int")


def lenient_double(x: ColumnOrName) -> Column:
    """Number text to double; '' , null and anything else -> null.  A cast alone
    would also take type suffixes (``1.0f``, ``3d``)."""
    s = pystrip(_c(x).cast("string"))
    return F.when(s.rlike(_NUMBER), tcast(s, "double"))


def strict_date(x: ColumnOrName) -> Column:
    """Date from the first 10 characters; a bad date fails the query."""
    s = nz(_c(x).cast("string"))
    return F.to_date(F.substring(s, 1, 10), "yyyy-MM-dd")


def truthy(x: ColumnOrName) -> Column:
    """Python ``bool(v)`` for text: any non-empty string is true."""
    s = _c(x).cast("string")
    return F.when(s.isNull() | (s == ""), F.lit(None).cast("boolean")).otherwise(F.lit(True))


def natural_sort_key(x: ColumnOrName, locale: str = "de") -> Column:
    """Text key in locale order with embedded digit runs ordered by value
    (b2 before b10): each digit run loses its leading zeros and is led by its
    length, so runs of any length compare by value; then the key carries the
    locale collation (ICU), so umlauts sort with their base letters."""
    s = F.coalesce(_c(x), F.lit(""))

    def part(t: Column) -> Column:
        digits = F.regexp_replace(t, "^0+", "")
        return F.when(t.rlike(r"\A\d"), F.concat(F.lpad(F.length(digits).cast("string"), 10, "0"), digits)).otherwise(t)

    return F.collate(F.array_join(F.transform(F.regexp_extract_all(s, F.lit(r"\d+|\D+"), 0), part), ""), locale)


_NUM_CELL = r"(?i)\A-?\d+(?:\.\d+)?(?:%|s|ms|x|×|GB|GiB|MB|tok/s)?\z"


def cell_number(x: ColumnOrName) -> Column:
    """Numeric value of a display cell with optional unit, else null.  Spaces
    and no-break spaces are removed and the first comma is read as a point."""
    s = F.regexp_replace(F.coalesce(_c(x), F.lit("")), "[ \\s]+", "")
    s = F.regexp_replace(s, "^([^,]*),", "$1.")
    num = F.regexp_extract(s, r"\A-?\d+(?:\.\d+)?", 0)
    return F.when(s.rlike(_NUM_CELL), tcast(num, "double"))


def cell_blank(x: ColumnOrName) -> Column:
    t = F.trim(F.coalesce(_c(x), F.lit("")))
    return (t == "") | (t == "—") | (t == "-")
