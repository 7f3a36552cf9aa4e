"""Queries for lookups, registry status, column jobs over the driver tables
and the config-text sources."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalpress.functions import columns as C
from evalpress.operators import lookups as L
from evalpress.operators import pick
from evalpress.operators.versions import Versions
from evalpress.plans import fixtures as fx
from evalpress.plans import cohorts
from evalpress.plans import sqlfn as S
from evalpress.plans.registry import query
from evalpress.sources import config_text as CT
from evalpress.sources.tables import sf_tag, table

W = fx.with_
BASE = cohorts.BASE_SQL


# ----------------------------------------------------------------- metadata
@query("join_model_meta", W(*BASE, fx.FX6_SQL) + """SELECT n.name, m.hf_repo, m.release_date, m.license
FROM (SELECT DISTINCT name FROM rows) n LEFT JOIN fx6 m ON m.name = n.name""")
def q_model_meta(spark, sf):
    names = cohorts.report_rows(spark, sf).select("name").distinct()
    return names.join(fx.fx6_meta(spark, sf), "name", "left")


def _refs(spark, sf):
    """FX9 raw references; the profiles come from the (staged) report rows."""
    return fx.fx9_refs(spark, sf, cohorts.report_rows(spark, sf))


def _ids(spark, sf):
    refs = _refs(spark, sf)
    return refs.select(C.canonical_id("raw").alias("id")).where(F.col("id").isNotNull()).distinct()


IDS_SQL = f"ids AS (SELECT DISTINCT {S.canonical_id('raw')} AS id FROM fx9 WHERE {S.canonical_id('raw')} IS NOT NULL)"


@query("join_revision", W(fx.FX1_SQL, fx.FX9_SQL, IDS_SQL, fx.FX7_STORE_SQL) + """SELECT i.id,
  nullif(s.sha, '') AS revision FROM ids i LEFT JOIN store s ON s.id = i.id""")
def q_revision(spark, sf):
    store = fx.fx7_store(spark, sf).select("id", C.nz("sha").alias("revision"))
    return _ids(spark, sf).join(store, "id", "left")


def _license_rows(spark, sf):
    g = cohorts.gated_rows(spark, sf)
    return L.with_license(g, fx.fx7_license_cache(spark, sf), fx.fx6_meta(spark, sf))


LICENSE_SQL = f"""CASE WHEN g.is_saas THEN {S.provider('g.profile', 1, 'proprietär (API)')}
  ELSE coalesce(CASE WHEN lc.license <> '' AND lc.license <> '—' THEN lc.license END,
                nullif(m.license, ''), '—') END"""


@query("license_precedence", W(*BASE, fx.FX6_SQL, fx.FX7_LIC_SQL) + f"""SELECT g.run_dir, g.stem, {LICENSE_SQL} AS license
FROM gated g LEFT JOIN lic_cache lc ON lc.profile = coalesce(g.profile, '') LEFT JOIN fx6 m ON m.name = g.name""")
def q_license(spark, sf):
    return _license_rows(spark, sf).select("run_dir", "stem", "license")


@query("join_first_needle", f"""SELECT p_partkey, label FROM (
  SELECT p_partkey, CASE {" ".join(f"WHEN contains(lower(p_name), '{n}') THEN '{lab}'" for _, n, lab in fx.NEEDLE_RULES)} END
    AS label FROM part) t WHERE label IS NOT NULL""")
def q_first_needle(spark, sf):
    p = table(spark, sf, "part")
    return (p.select("p_partkey", L.first_needle_case("p_name", fx.NEEDLE_RULES).alias("label"))
            .where(F.col("label").isNotNull()))


REG_SQL = """st AS (SELECT DISTINCT id FROM store),
reg0 AS (SELECT i.id, c.status AS c_status, c.detail AS c_detail, s.id IS NOT NULL AS in_store
         FROM ids i LEFT JOIN status_cache c ON c.id = i.id AND c.mode = 'anon' LEFT JOIN st s ON s.id = i.id),
reg AS (SELECT id,
   CASE WHEN coalesce(c_status, CASE WHEN in_store THEN 'ok' ELSE 'undetermined' END) = 'undetermined' AND in_store
        THEN 'ok' ELSE coalesce(c_status, CASE WHEN in_store THEN 'ok' ELSE 'undetermined' END) END AS status,
   CASE WHEN coalesce(c_status, CASE WHEN in_store THEN 'ok' ELSE 'undetermined' END) = 'undetermined' AND in_store
        THEN 'in store' WHEN c_status IS NOT NULL THEN c_detail ELSE 'offline' END AS detail,
   in_store FROM reg0)"""

REG_CTES = [fx.FX1_SQL, fx.FX9_SQL, IDS_SQL, fx.FX7_STORE_SQL, fx.FX7_CACHE_SQL, REG_SQL]


def _registry(spark, sf):
    return L.registry_status(_ids(spark, sf), fx.fx7_status_cache(spark, sf), fx.fx7_store(spark, sf), fx.CACHE_MODE)


@query("registry_status", W(*REG_CTES) + "SELECT id, status, detail, in_store FROM reg")
def q_registry(spark, sf):
    return _registry(spark, sf)


@query("group_ids_by_status", W(*REG_CTES) + """SELECT status, count(*) AS n_ids,
  (SELECT CAST(count_if(status = 'ok') AS DOUBLE) / count(*) FROM reg) AS ok_share FROM reg GROUP BY status""")
def q_group_ids(spark, sf):
    return L.status_counts(_registry(spark, sf))


@query("merge_status_cache", W(fx.FX1_SQL, fx.FX9_SQL, IDS_SQL, fx.FX7_STORE_SQL, fx.FX7_CACHE_SQL) + """
SELECT id, mode, status, detail, 'cached' AS origin FROM status_cache
UNION ALL
SELECT i.id, 'anon', CASE WHEN i.id IN (SELECT id FROM store) THEN 'ok' ELSE 'undetermined' END, 'looked up', 'new'
FROM ids i WHERE i.id NOT IN (SELECT id FROM status_cache WHERE mode = 'anon')""")
def q_merge_cache(spark, sf):
    """The cache of an earlier run is read from its stored version; the result
    is the version that the next run reads."""
    state = Versions(spark, f"status-cache-{sf_tag(sf)}",
                     T.StructType.fromDDL("id string, mode string, status string, detail string, origin string"))
    state.publish(fx.fx7_status_cache(spark, sf).withColumn("origin", F.lit("cached")))
    return state.publish(L.merge_status_cache(_ids(spark, sf), state.read().drop("origin"), fx.fx7_store(spark, sf), fx.CACHE_MODE))


@query("audit_metadata_gaps", W(*BASE, fx.FX6_SQL, fx.FX7_LIC_SQL) + f"""SELECT name, missing FROM (
  SELECT g.name, concat_ws(', ',
      CASE WHEN {S.release_key('m.release_date')} IS NULL THEN 'release_date' END,
      CASE WHEN ({LICENSE_SQL}) = '—' THEN 'license' END) AS missing
  FROM (SELECT name, f.profile AS profile, f.is_saas AS is_saas FROM (
          SELECT name, arg_min({{'profile': profile, 'is_saas': is_saas}}, (o, -pr, stem)) AS f FROM (
            SELECT s.name, s.profile, s.is_saas, 0 AS o, s.stem, coalesce(TRY_CAST(nullif(s.pass_rate, '') AS DOUBLE), 0) AS pr
            FROM sized s JOIN local_cohort c USING (run_dir)
            UNION ALL SELECT s.name, s.profile, s.is_saas, 1, s.stem, coalesce(TRY_CAST(nullif(s.pass_rate, '') AS DOUBLE), 0)
            FROM sized s JOIN saas_cohort c USING (run_dir)) u
          GROUP BY name) k) g
  LEFT JOIN lic_cache lc ON lc.profile = coalesce(g.profile, '') LEFT JOIN fx6 m ON m.name = g.name) t
WHERE missing <> ''""")
def q_metadata_gaps(spark, sf):
    rate = F.coalesce(C.lenient_double("pass_rate"), F.lit(0.0))
    loc, saas = (cohorts.cohort_rows(spark, sf, kind).select("name", "profile", "is_saas", "stem", (-rate).alias("_rate"),
                                                             F.lit(o).alias("o"))
                 for o, kind in enumerate(("local", "saas")))
    first = pick.first_per_key(loc.unionByName(saas), ["name"], ["o", "_rate", "stem"]).drop("o", "_rate", "stem")
    meta = fx.fx6_meta(spark, sf)
    lic = L.with_license(first, fx.fx7_license_cache(spark, sf), meta)
    j = lic.join(meta.select("name", "release_date"), "name", "left")
    missing = F.concat_ws(", ", F.when(C.release_sort_key("release_date").isNull(), F.lit("release_date")),
                          F.when(F.col("license") == "—", F.lit("license")))
    return j.select("name", missing.alias("missing")).where(F.col("missing") != "")


# -------------------------------------------------------------- column jobs
@query("slugify", f"""SELECT {S.slugify('p_name')} AS slug, count(*) AS n_rows, count(DISTINCT p_name) AS n_spellings
FROM part GROUP BY slug""")
def q_slugify(spark, sf):
    p = table(spark, sf, "part")
    return p.groupBy(C.slugify("p_name").alias("slug")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("p_name").alias("n_spellings"))


@query("canonical_id", W(fx.FX1_SQL, fx.FX9_SQL) + f"""SELECT {S.canonical_id('raw')} AS id, count(*) AS n_raw
FROM fx9 GROUP BY id""")
def q_canonical(spark, sf):
    refs = _refs(spark, sf)
    return refs.groupBy(C.canonical_id("raw").alias("id")).agg(F.count(F.lit(1)).alias("n_raw"))


@query("clean_ref", W(fx.FX1_SQL, fx.FX9_SQL) + f"""SELECT {S.clean_ref('raw')} AS cleaned, count(*) AS n,
  contains({S.clean_ref('raw')}, '/hf_models/') AS has_store_path FROM fx9 GROUP BY cleaned""")
def q_clean_ref(spark, sf):
    refs = _refs(spark, sf).select(C.clean_ref("raw").alias("cleaned"))
    return refs.groupBy("cleaned").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "has_store_path", F.col("cleaned").contains("/hf_models/"))


@query("release_sort_key", W(fx.FX6_SQL) + f"""SELECT {S.release_key('release_date')} AS release_key, count(*) AS n
FROM fx6 GROUP BY release_key""")
def q_release_key(spark, sf):
    m = fx.fx6_meta(spark, sf)
    return m.groupBy(C.release_sort_key("release_date").alias("release_key")).agg(F.count(F.lit(1)).alias("n"))


_IMG, _VER, _SRC = S.serving("text")


@query("serving_version", W(fx.FX8_PROFILE_SQL) + f"""SELECT brand, {_IMG} AS image, {_VER} AS version,
  {_SRC} AS version_source, count(*) AS n FROM profile_text GROUP BY ALL""")
def q_serving(spark, sf):
    p = fx.fx8_profile_text(spark, sf)
    image, version, vsource = C.serving_version("text")
    return p.groupBy("brand", image.alias("image"), version.alias("version"), vsource.alias("version_source")).agg(
        F.count(F.lit(1)).alias("n"))


_LENIENT = (("orders", "o_orderkey", "int"), ("orders", "o_totalprice", "int"),
            ("orders", "o_totalprice", "double"), ("orders", "o_orderstatus", "int"),
            ("orders", "o_orderstatus", "bool"), ("orders", "o_orderpriority", "int"),
            ("orders", "o_orderdate", "date"), ("events", "props", "int"), ("events", "props", "bool"))


def _lenient_sql(v, t):
    if t == "int":
        return f"TRY_CAST(trunc(TRY_CAST(nullif(trim({v}), '') AS DOUBLE)) AS INTEGER)"
    if t == "double":
        return f"TRY_CAST(nullif(trim({v}), '') AS DOUBLE)"
    if t == "date":
        return f"CAST(substr(nullif({v}, ''), 1, 10) AS DATE)"
    return f"CASE WHEN {v} IS NULL OR {v} = '' THEN NULL ELSE true END"


@query("cast_lenient", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{t}' AS type_name, count({_lenient_sql(f'CAST({c} AS VARCHAR)', t)}) AS n_accepted,
  count_if(nullif(CAST({c} AS VARCHAR), '') IS NOT NULL AND {_lenient_sql(f'CAST({c} AS VARCHAR)', t)} IS NULL) AS n_rejected
FROM {tb}""" for tb, c, t in _LENIENT))
def q_cast_lenient(spark, sf):
    """One pass per table: two conditional counts per (column, type) check in
    one aggregate, whose single row is then unfolded."""
    from evalpress.operators.typed import cast_lenient
    types = {"int": T.IntegerType(), "double": T.DoubleType(), "date": T.DateType(), "bool": T.BooleanType()}
    out = None
    for tb in dict.fromkeys(t for t, _, _ in _LENIENT):
        checks = []
        for t2, c, t in _LENIENT:
            if t2 != tb:
                continue
            v = F.col(c).cast("string")
            r = cast_lenient(v, types[t])
            checks.append(F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("type_name"),
                                   F.count_if(r.isNotNull()).alias("n_accepted"),
                                   F.count_if(C.nz(v).isNotNull() & r.isNull()).alias("n_rejected")))
        part = table(spark, sf, tb).agg(F.array(*checks).alias("x")).select(F.inline("x"))
        out = part if out is None else out.unionByName(part)
    return out


# marker chosen from the documents: a block starts at a line beginning with it
BLOCK_MARKER = "The"


@query("block_hash", f"""SELECT doc_id, length(b) AS block_chars, sha256(b) AS block_sha256 FROM (
  SELECT doc_id, regexp_replace(regexp_extract(text, '(?m)^{BLOCK_MARKER}[^\\n]*(\\n([ \\t][^\\n]*)?)*', 0),
                               '\\s+$', '') AS b FROM documents) t WHERE b <> ''""")
def q_block_hash(spark, sf):
    from evalpress.functions.text import marker_block
    d = table(spark, sf, "documents")
    b = d.select("doc_id", marker_block("text", BLOCK_MARKER).alias("b")).where(F.col("b").isNotNull())
    return b.select("doc_id", F.length("b").cast("bigint").alias("block_chars"), F.sha2("b", 256).alias("block_sha256"))


# ------------------------------------------------------------- config text
_FIELD = CT.FIELD_LINE.format(keys="|".join(CT.META_KEYS))


_LINES_CTES = [
    fx.FX8_SQL,
    f"""lines AS (SELECT doc, pos, line,
    nullif(trim(regexp_extract(line, '{CT.NAME_LINE}', 1)), '') AS oname FROM fx8)""",
    """filled AS (SELECT *, last_value(CASE WHEN oname IS NOT NULL THEN pos END IGNORE NULLS) OVER w AS opos,
                  last_value(oname IGNORE NULLS) OVER w AS owner
           FROM lines WINDOW w AS (PARTITION BY doc ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    f"""fields AS (SELECT owner AS name, doc, opos, regexp_extract(line, '{_FIELD}', 1) AS key,
                  trim(regexp_extract(line, '{_FIELD}', 2)) AS value, pos
           FROM filled WHERE oname IS NULL AND owner IS NOT NULL AND regexp_matches(line, '{_FIELD}'))""",
    """blocks AS (SELECT oname AS name, arg_max(doc, (doc, pos)) AS last_doc, arg_max(pos, (doc, pos)) AS last_pos
           FROM lines WHERE oname IS NOT NULL GROUP BY oname)""",
    """kept AS (SELECT f.name, f.key, arg_max(f.value, f.pos) AS value FROM fields f
         JOIN blocks b ON b.name = f.name AND b.last_doc = f.doc AND b.last_pos = f.opos GROUP BY f.name, f.key)""",
]


@query("src_config_lines", W(*_LINES_CTES) + f"""SELECT b.name,
  {", ".join(f"max(k.value) FILTER (WHERE k.key = '{x}') AS {x}" for x in CT.META_KEYS)}
FROM blocks b LEFT JOIN kept k ON k.name = b.name GROUP BY b.name""")
def q_config_lines(spark, sf):
    return CT.line_records(fx.fx8_lines(spark, sf))


@query("src_config_blocks", """SELECT page_id, CAST(i AS BIGINT) AS block_no,
  nullif(regexp_extract(parts[i + 1], 'href="([^"]+)"', 1), '') AS href,
  nullif(regexp_extract(parts[i + 1], '>([^<]*)</a>', 1), '') AS label
FROM (SELECT page_id, string_split(html, '<li>') AS parts FROM pages) p, range(1, len(parts)) r(i)""")
def q_config_blocks(spark, sf):
    pages = table(spark, sf, "pages")
    b = CT.split_blocks(pages, "html", "<li>", ["page_id"])
    return b.select("page_id", F.col("block_no").cast("bigint").alias("block_no"),
                    CT.block_field("block", 'href="([^"]+)"').alias("href"),
                    CT.block_field("block", ">([^<]*)</a>").alias("label"))


@query("src_keyed_json", """SELECT 'owner' || (s_suppkey % 7) || '/u' || s_suppkey AS id,
  CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE s_name END AS sha
FROM supplier WHERE s_suppkey % 10 <> 3""")
def q_keyed_json(spark, sf):
    store = fx.fx7_store(spark, sf)
    k = F.regexp_extract("id", r"/u(\d+)$", 1).cast("long")
    text = F.to_json(F.create_map(F.col("id"), F.struct(F.col("sha"))))
    broken = F.substring(text, F.lit(1), F.length(text) - 2)
    docs = store.select(F.when(k % 10 == 3, broken).otherwise(text).alias("json_text"))
    return CT.keyed_json(docs, "json_text", T.StructType([T.StructField("sha", T.StringType())]))


@query("forward_fill_owner", """SELECT conv_id, turn, role,
  last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS)
    OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS owner_turn
FROM conversations""")
def q_forward_fill(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    c = c.withColumn("_open", F.when(F.col("role") == "user", F.col("turn")))
    return pick.forward_fill(c, "conv_id", "turn", "_open", "owner_turn").select("conv_id", "turn", "role", "owner_turn")


_CELL_SQL = "CASE WHEN f1 IS NULL THEN '—' ELSE tp || ',' || fp || '%' END"


@query("sort_typed_column", W(
    fx.FX2_SQL,
    f"c AS (SELECT label, {_CELL_SQL} AS cell FROM fx2)",
    """n AS (SELECT label, cell, trim(cell) IN ('', '—', '-') AS blank,
        regexp_replace(regexp_replace(cell, '\\s+', '', 'g'), ',', '.') AS s FROM c)""",
    """k AS (SELECT *, CASE WHEN regexp_full_match(s, '(?i)-?\\d+(?:\\.\\d+)?(?:%|s|ms|x|×|GB|GiB|MB|tok/s)?')
                     THEN CAST(regexp_extract(s, '^-?\\d+(?:\\.\\d+)?', 0) AS DOUBLE) END AS num FROM n)""")
    + "SELECT label, cell, row_number() OVER (ORDER BY blank, num, label) AS rank FROM k")
def q_sort_typed(spark, sf):
    from evalpress.plans.modal import guard_rows
    g = guard_rows(spark, sf)
    cell = F.when(F.col("metrics.f1").isNull(), F.lit("—")).otherwise(
        F.concat(F.col("metrics.confusion.tp").cast("string"), F.lit(","),
                 F.col("metrics.confusion.fp").cast("string"), F.lit("%")))
    df = g.select("label", cell.alias("cell"))
    keyed = pick.typed_sort_keys(df, "cell")
    return pick.rank_within(keyed, [], [F.col("_blank"), F.col("_num_key"), F.col("_text_key"), F.col("label")]
                            ).select("label", "cell", "rank")
