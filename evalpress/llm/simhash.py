"""SimHash fingerprints and the search for near ones by block tables.

Everything is DataFrame expressions: each word of a text votes with its hash on
the sign of every bit; fingerprints within a Hamming radius share a choice of
blocks, so tables keyed by each choice find them all.
"""
from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evalpress.llm.common import order_id, shuffle_parts, staged, text_or_empty

BITS = 64
LANES = BITS // 2
#: one counter in the low and one in the high half of a long
PAIR = (1 << 32) | 1


def terms(text: Column) -> Column:
    """Lower-cased words; each occurrence votes, so a term weighs as often as
    it occurs.  A text without words has none."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def fingerprint(n: Column) -> Column:
    """The 64 signs: a bit is set if more than half of the votes have it."""
    low = (1 << 32) - 1
    parts = []
    for k in range(LANES):
        v = F.col(f"_v{k}")
        for bit, ones in ((k, v.bitwiseAND(F.lit(low))), (k + 32, F.shiftrightunsigned(v, 32))):
            mask = (1 << bit) if bit < 63 else -(1 << 63)
            parts.append(F.when(ones * 2 > n, F.lit(mask)).otherwise(F.lit(0).cast("long")))
    while len(parts) > 1:
        parts = [a.bitwiseOR(b) for a, b in zip(parts[::2], parts[1::2])]
    return parts[0]


def fingerprints(rows: DataFrame, key: list[str], text: str) -> DataFrame:
    """``key`` columns and ``_fp`` per different key; rows of equal keys must
    have equal texts.  Votes are summed where the text is read, so the shuffle
    carries one row per text and task."""
    # an outer explode keeps a text without words, whose null hash votes nowhere
    term = rows.select(*key, F.explode_outer(terms(F.col(text))).alias("_term"))
    hashed = term.select(*key, F.when(F.col("_term").isNotNull(), F.xxhash64("_term")).alias("_hash"))
    # bits k and k + 32 are counted side by side in one long: no half overflows below 2^31 words
    sums = [F.coalesce(F.sum(F.shiftright("_hash", k).bitwiseAND(F.lit(PAIR))), F.lit(0)).alias(f"_v{k}")
            for k in range(LANES)]
    agg = hashed.groupBy(*key).agg(F.count("_hash").alias("_n"), *sums)
    return agg.select(*key, fingerprint(F.col("_n")).alias("_fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def block_masks(radius: int, blocks: int) -> list[int]:
    """Masks of every choice of ``blocks - radius`` of the equal blocks: two
    fingerprints within ``radius`` agree on all bits of one of them."""
    edge = [BITS * i // blocks for i in range(blocks + 1)]
    own = [((1 << edge[i + 1]) - (1 << edge[i])) for i in range(blocks)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [signed(sum(own[i] for i in c)) for c in combinations(range(blocks), blocks - radius)]


def near_pairs(fps: DataFrame, queries: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """(query, found, distance) of all different fingerprints within ``radius``.

    ``fps`` and ``queries`` have a column ``_fp``; equal fingerprints are one
    entry, however many documents have them.  Each mask is a permuted table;
    the entries meet on (table, masked bits), and each pair is reported by the
    first table that has it, so nothing has to be made distinct."""
    masks = block_masks(radius, blocks)
    table = F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.lit(m).alias("m")) for i, m in enumerate(masks)]))

    def keyed(d: DataFrame, name: str) -> DataFrame:
        return (d.select("_fp").where("_fp is not null").distinct().select(F.col("_fp").alias(name), table.alias("_t"))
                .select(name, F.col("_t.t").alias("_table"), F.col(name).bitwiseAND(F.col("_t.m")).alias("_block")))

    x = F.col("query").bitwiseXOR(F.col("found"))
    first = F.lit(None).cast("int")
    for i, m in reversed(list(enumerate(masks))):
        first = F.when(x.bitwiseAND(F.lit(m)) == 0, F.lit(i)).otherwise(first)
    pairs = keyed(queries, "query").join(keyed(fps, "found"), ["_table", "_block"])
    return (pairs.where((F.col("query") != F.col("found")) & (F.bit_count(x) <= radius) & (F.col("_table") == first))
            .select("query", "found", F.bit_count(x).alias("distance")))


def bucket_starts(docs: DataFrame, buckets: int) -> list[int]:
    """First ids of consecutive ranges of about equal size: at most ``buckets``
    numbers, from approximate quantiles, each an id that occurs."""
    ids = docs.select(order_id().alias("_id"))
    if buckets < 2:
        cuts = []
    else:
        q = ids.agg(F.percentile_approx("_id", [i / buckets for i in range(1, buckets)], 10 * buckets)).first()[0]
        cuts = q or []
    low = ids.agg(F.min("_id")).first()[0]
    return [] if low is None else sorted({low, *cuts})


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """(_bucket, _last, _id, doc_id, text, _next) of every document, ``_next``
    the text of the next one by ascending doc_id (nulls first, ties by a hash
    of the text); after the last comes the first.

    Rows go once to the task of their id range.  The first document of a range
    is also sent, marked ``_last``, to the range before (the very first to the
    last range), so no window spans ranges and no task sees all rows."""
    buckets = buckets or 4 * shuffle_parts(docs.sparkSession)
    starts = bucket_starts(docs, buckets)
    if not starts:
        return docs.select(F.lit(0).alias("_bucket"), F.lit(False).alias("_last"), order_id().alias("_id"), "doc_id",
                           text_or_empty().alias("text"), F.lit("").alias("_next")).limit(0)
    bounds = F.array(*[F.lit(s) for s in starts])
    rows = docs.select(order_id().alias("_id"), "doc_id", text_or_empty().alias("text"))
    rows = rows.withColumn("_bucket", F.size(F.filter(bounds, lambda s: s <= F.col("_id"))) - 1)
    before = F.when(F.col("_bucket") == 0, F.lit(len(starts) - 1)).otherwise(F.col("_bucket") - 1)
    own = F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("l"))
    sentinel = F.struct(before.alias("b"), F.lit(True).alias("l"))
    places = F.when(F.array_contains(bounds, F.col("_id")), F.array(own, sentinel)).otherwise(F.array(own))
    rows = (rows.withColumn("_p", F.explode(places))
            .select(F.col("_p.b").alias("_bucket"), F.col("_p.l").alias("_last"), "_id", "doc_id", "text"))
    order = Window.partitionBy("_bucket").orderBy("_last", "_id", F.xxhash64("text"))
    return rows.withColumn("_next", F.lead("text").over(order))


def edited(text: Column, then: Column) -> Column:
    """The text with its last floor(n / 2) characters replaced by the first as
    many (or all) of the next text."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.left(text, (n - half).cast("int")), F.left(then, half))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def next_and_edited(docs: DataFrame) -> DataFrame:
    """(_id, doc_id, n_chars, edited_sha256, _a, _b, _c) of every document:
    the fingerprints of its text, its edited text and its next document."""
    rows = with_next(docs)
    rows = rows.select(
        "_bucket", "_last", "_id", "doc_id", "text", F.xxhash64("text").alias("_h"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.when(F.col("_last"), F.lit("")).otherwise(edited(F.col("text"), F.coalesce("_next", F.lit("")))).alias("_edited"),
        F.monotonically_increasing_id().alias("_row"))
    version = F.explode(F.array(F.struct(F.lit(0).alias("w"), F.col("text").alias("t")),
                                F.struct(F.lit(1).alias("w"), F.col("_edited").alias("t"))))
    both = rows.select("_row", "_bucket", "_last", "_id", "_h", "doc_id", "n_chars",
                       F.sha2("_edited", 256).alias("edited_sha256"), version.alias("_v"))
    key = ["_row", "_bucket", "_last", "_id", "_h", "doc_id", "n_chars", "edited_sha256", "_which"]
    fps = fingerprints(both.select(*key[:-1], F.col("_v.w").alias("_which"), F.col("_v.t").alias("_t")), key, "_t")
    wide = fps.groupBy(*key[:-1]).agg(F.max(F.when(F.col("_which") == 0, F.col("_fp"))).alias("_a"),
                                      F.max(F.when(F.col("_which") == 1, F.col("_fp"))).alias("_b"))
    order = Window.partitionBy("_bucket").orderBy("_last", "_id", "_h", "_row")
    wide = wide.withColumn("_c", F.lead("_a").over(order)).where(~F.col("_last"))
    return wide.select("_id", "doc_id", "n_chars", "edited_sha256", "_a", "_b", "_c")


def near_groups(wide: DataFrame, asked: Column, radius: int) -> DataFrame:
    """(_fp, _n, _first, _last_doc, _near, _near_docs, _found) of the different
    fingerprints ``_a`` of the rows that are ``asked``: its documents, the first
    and last of them, the other fingerprints within ``radius``, their documents,
    and the list of these fingerprints, which has at most one entry per choice
    of ``radius`` bits (43,744 for 3), however many documents there are."""
    groups = staged(wide.groupBy(F.col("_a").alias("_fp")).agg(
        F.count("*").alias("_n"), F.min_by("doc_id", "_id").alias("_first"), F.max_by("doc_id", "_id").alias("_last_doc"),
        F.max(F.coalesce(asked, F.lit(False))).alias("_asked")))
    queries = groups.where("_asked").select("_fp", "_n", "_first", "_last_doc")
    pairs = near_pairs(groups.select("_fp"), queries.select("_fp"), radius)
    found = groups.select(F.col("_fp").alias("found"), F.col("_n").alias("_docs"), F.col("_first").alias("_doc"))
    entry = F.struct("distance", as_hex(F.col("found")).alias("fingerprint"), F.col("_docs").alias("n_docs"), F.col("_doc").alias("doc_id"))
    near = pairs.join(found, "found").groupBy(F.col("query").alias("_fp")).agg(
        F.count("*").alias("_near"), F.sum("_docs").alias("_near_docs"), F.array_sort(F.collect_list(entry)).alias("_found"))
    return queries.join(near, "_fp", "left")


def compare_edited(docs: DataFrame, radius: int = 3, every: int = 50) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, and for documents whose id is
    divisible by ``every`` (the search's queries), else null:

    ``n_near``: other fingerprints of all documents within ``radius``;
    ``n_near_docs``: other documents within ``radius``, those of the same
    fingerprint (distance 0: copies, other case, spacing or order) included;
    ``near``: per fingerprint within ``radius`` its distance, itself, its number
    of other documents and one of their ids, by distance.  All documents of a
    fingerprint are the rows that have it in ``fingerprint``.

    A null text is an empty one; a text without words has fingerprint 0.
    Documents without an id come before all others; repeated rows follow one
    another and are documents of their own; a single document is its own next
    one; an empty table gives no rows; other columns are ignored."""
    wide = staged(next_and_edited(docs))
    asked = F.col("doc_id").cast("long") % every == 0
    near = near_groups(wide, asked, radius)
    others = F.col("_n") - 1
    partner = F.when(F.col("_first") == F.col("doc_id"), F.col("_last_doc")).otherwise(F.col("_first"))
    same = F.struct(F.lit(0).alias("distance"), as_hex(F.col("_a")).alias("fingerprint"), others.alias("n_docs"), partner.alias("doc_id"))
    kind = f"array<struct<distance:int,fingerprint:string,n_docs:bigint,doc_id:{docs.schema['doc_id'].dataType.simpleString()}>>"
    none = F.array().cast(kind)
    listed = F.concat(F.when(others > 0, F.array(same).cast(kind)).otherwise(none), F.coalesce(F.col("_found").cast(kind), none))
    own = ["doc_id", "n_chars", "edited_sha256", as_hex(F.col("_a")).alias("fingerprint"),
           as_hex(F.col("_b")).alias("edited_fingerprint"), likeness(F.col("_a"), F.col("_b")).alias("near_edited"),
           likeness(F.col("_a"), F.col("_c")).alias("near_next")]
    # only queries meet the search's results; no other row moves
    is_query = F.coalesce(asked, F.lit(False))
    queries = wide.where(is_query).join(near, F.col("_a") == F.col("_fp")).select(
        *own, F.coalesce("_near", F.lit(0)).cast("long").alias("n_near"),
        (others + F.coalesce("_near_docs", F.lit(0))).cast("long").alias("n_near_docs"), listed.alias("near"))
    null = F.lit(None)
    rest = wide.where(~is_query).select(*own, null.cast("long").alias("n_near"), null.cast("long").alias("n_near_docs"),
                                        null.cast(kind).alias("near"))
    return queries.unionByName(rest)
