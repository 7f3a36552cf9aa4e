"""Leak and field-name audits (ops 91-93) and the change-stamped snapshot (94)."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalpress.constants import LEAK_RULES, WITHHELD_FIELD_PATTERN
from evalpress.operators import audit
from evalpress.operators.state import change_date
from evalpress.operators.versions import Versions
from evalpress.plans import fixtures as fx
from evalpress.plans.registry import query
from evalpress.sources.tables import sf_tag, table

W = fx.with_

# parameter: positive rules for the test corpus (FX10), beside the fixed ones
CORPUS_RULES = (
    ("email", r"[\w.+-]+@[\w-]+\.\w+"),
    ("ipv4", r"\b\d{1,3}(\.\d{1,3}){3}\b"),
    ("secret_assignment", r"(?i)token\s*=\s*\S+"),
    ("license_word", r"(?i)licen[sc]e"),
    ("page_host", r"example\.net"),
)
RULES = LEAK_RULES + CORPUS_RULES
_SCANNED = (("documents", "doc_id", ("text", "lang", "source")), ("pages", "page_id", ("url", "html")))


def _rules_sql(rules) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS rule, '{p}' AS pattern" for n, p in rules)


@query("audit_leak_columns", " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, u.column_name, r.rule, count(*) AS n
FROM (SELECT {k} AS k, unnest(['{"', '".join(cols)}']) AS column_name, unnest([{", ".join(cols)}]) AS v FROM {t}) u,
     ({_rules_sql(RULES)}) r
WHERE u.v IS NOT NULL AND regexp_matches(u.v, r.pattern) GROUP BY u.column_name, r.rule""" for t, k, cols in _SCANNED))
def q_leak_columns(spark, sf):
    out = None
    for t, _, cols in _SCANNED:
        part = audit.leak_columns(table(spark, sf, t), list(cols), RULES).select(
            F.lit(t).alias("table_name"), "column_name", "rule", "n")
        out = part if out is None else out.unionByName(part)
    return out


_TEXTS = (("documents", "doc_id", "text"), ("pages", "page_id", "url"), ("pages", "page_id", "html"))


@query("audit_leak_text", " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name, {k} AS row_id, '{n}' AS rule, substr(m, 1, 40) AS match
FROM (SELECT {k}, unnest(regexp_extract_all({c}, '{p}')) AS m FROM {t}) t""" for t, k, c in _TEXTS for n, p in RULES))
def q_leak_text(spark, sf):
    out = None
    for t, k, c in _TEXTS:
        found = audit.leak_text(table(spark, sf, t), k, c, RULES).select(
            F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), F.col(k).alias("row_id"), "rule", "match")
        out = found if out is None else out.unionByName(found)
    return out


@query("audit_field_names", f"""SELECT key, count(*) AS n_rows, regexp_matches(key, '{WITHHELD_FIELD_PATTERN}') AS withheld
FROM (SELECT unnest(json_keys(props)) AS key FROM events) t GROUP BY key""")
def q_field_names(spark, sf):
    keys = audit.json_paths(table(spark, sf, "events"), "props")
    return keys.select("key", F.col("n").alias("n_rows"), audit.withheld("key", WITHHELD_FIELD_PATTERN).alias("withheld"))


NEW_STAMP = "2024-02-01"


@query("snapshot_change_date", W(fx.FX11_SQL) + f"""SELECT n.doc_id, sha256(n.text) AS hash,
  CASE WHEN p.hash = sha256(n.text) THEN p.stamp ELSE '{NEW_STAMP}' END AS stamp,
  CASE WHEN p.hash IS NULL THEN 'new' WHEN p.hash = sha256(n.text) THEN 'unchanged' ELSE 'changed' END AS change
FROM new_docs n LEFT JOIN prev p ON p.doc_id = n.doc_id""")
def q_snapshot(spark, sf):
    """The state that an earlier build left is read from its stored version, and
    the next version is stored; the result is what the next build will read."""
    state = Versions(spark, f"snapshot-{sf_tag(sf)}", T.StructType.fromDDL("doc_id long, hash string, stamp string, change string"))
    state.publish(fx.fx11_previous(spark, sf).withColumn("change", F.lit("new")))
    return state.publish(change_date(fx.fx11_new(spark, sf), state.read(), "doc_id", F.sha2("text", 256), F.lit(NEW_STAMP)))
