"""Near-duplicate lines by a deletion-neighbourhood join.

Two lines are alike if one edit at most (a character inserted, deleted or
replaced) turns one into the other.  All steps are DataFrame expressions:

1. Equal lines, of any length but blank, meet on two hashes of the line.
2. Only lines of ``min_chars`` characters at least can be alike without being
   equal: one edit makes another word of a short one.  Alike lines agree on their first or on their second half, so only lines that
   share a half with another line go on.  These are seen as stretches of
   ``stretch`` characters: alike lines agree on everything outside one stretch,
   so only stretches go on whose outside another line shares.
3. Of each such stretch all deletion variants are emitted as hashed keys (at
   most ``stretch`` + 2), tagged by what the deletion stands for.  Lines that
   meet on a variant are checked by edit distance; the earliest line stays.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalpress.llm.common import NULL_ID, small, staged

STRETCH = 64
MIN_CHARS = 20
BLANK = " \t\r\f\v"


def lines(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """(_id, _h, _pos, _line): every trimmed line of ``min_chars`` characters
    at least (1: all but blank ones), with its document's keys."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID).cast("long")).alias("_id"),
                       F.xxhash64(text).alias("_h"), F.posexplode(F.split(text, "\n")).alias("_pos", "_raw"))
    return (rows.select("_id", "_h", "_pos", F.trim("_raw", F.lit(BLANK)).alias("_line"))
            .where(F.char_length("_line") >= min_chars))


def half_keys(line: Column, min_chars: int) -> Column:
    """Hashes of both halves, as the shorter and as the longer line of a pair;
    the halves are cut where the shorter line's are."""
    n = F.char_length(line)

    def role(size: Column) -> list[Column]:
        cut = F.floor(size / 2).cast("int")
        rest = (size - cut).cast("int")
        return [F.xxhash64(size, F.lit(0), F.left(line, cut)), F.xxhash64(size, F.lit(1), F.right(line, rest))]

    return F.when(n > min_chars, F.array(*role(n), *role(n - 1))).otherwise(F.array(*role(n)))


def stretch_keys(line: Column, stretch: int, min_chars: int) -> Column:
    """(key, longer, part) of every stretch.  A key hashes all of the line but
    the stretch; ``longer``: the line as the longer of a pair whose shorter
    line has one character less, so its stretch has one more.  Outsides are
    hashed by the hashes of their stretches, which takes linear time."""
    n = F.char_length(line)
    cut = lambda x: F.regexp_extract_all(x, F.lit(f"(?s).{{1,{stretch}}}"), F.lit(0))
    hashed = lambda x: F.transform(x, lambda s: F.xxhash64(s))
    parts = cut(line)
    head, shifted = hashed(parts), hashed(cut(F.substr(line, F.lit(2))))

    def role(size: Column, tail: Column, extra: bool) -> Column:
        count = F.ceil(size / F.lit(float(stretch))).cast("int")

        def key(c: Column) -> Column:
            part = F.get(parts, c)
            if extra:
                part = F.concat(part, F.coalesce(F.left(F.get(parts, c + 1), F.lit(1)), F.lit("")))
            outside = F.xxhash64(size, c, F.slice(head, 1, c), F.slice(tail, c + 2, n))
            return F.struct(outside.alias("key"), F.lit(extra).alias("longer"), part.alias("part"))

        return F.transform(F.sequence(F.lit(0), count - 1), key)

    none = F.array().cast("array<struct<key:bigint,longer:boolean,part:string>>")
    return F.concat(role(n, head, False), F.when(n > min_chars, role(n - 1, shifted, True)).otherwise(none))


def variants(key: Column, longer: Column, part: Column) -> Column:
    """Hashed deletion variants of a stretch.

    A replaced character: the stretches agree after deleting the same place,
    so these keys carry the place.  An inserted one: a deletion variant of the
    longer stretch is the shorter stretch itself."""
    n = F.char_length(part)
    without = lambda p: F.concat(F.left(part, p), F.substr(part, p + 2, n))
    every = F.sequence(F.lit(0), n - 1)
    own = F.array(F.xxhash64(key, F.lit(-1), part))
    return (F.when(longer, F.transform(every, lambda p: F.xxhash64(key, F.lit(-1), without(p))))
            .when(n > 0, F.concat(own, F.transform(every, lambda p: F.xxhash64(key, p, without(p)))))
            .otherwise(own))


def alike_lines(docs: DataFrame, table: DataFrame, stretch: int, min_chars: int) -> DataFrame:
    """(_a, _b) of the different lines that have an earlier alike line;
    ``table`` has the hashes of all lines and of their halves."""
    halves = table.select("_a", F.explode("_halves").alias("half"))
    shared = staged(halves.groupBy("half").agg(F.min("_a").alias("lo"), F.max("_a").alias("hi")).where("lo <> hi").select("half"))
    close = (table.select(F.struct("_id", "_h", "_pos").alias("ref"), "_a", "_b", F.explode("_halves").alias("half"))
             .join(small(shared), "half").groupBy("_a", "_b").agg(F.min("ref").alias("ref")))
    close = staged(close.select("_a", "_b", "ref", "ref._id", "ref._h", "ref._pos"))
    text = (lines(docs, min_chars).join(small(close), ["_id", "_h", "_pos"])
            .select("_a", "_b", "ref", "_line").dropDuplicates(["_a", "_b"]))
    every = staged(text.select("_a", "_b", "ref", F.explode(stretch_keys(F.col("_line"), stretch, min_chars)).alias("s"))
                   .select("_a", "_b", "ref", "s.key", "s.longer", "s.part"))
    open_keys = staged(every.groupBy("key").agg(F.min("_a").alias("lo"), F.max("_a").alias("hi")).where("lo <> hi").select("key"))
    parts = every.join(small(open_keys), "key")
    parts = staged(parts.groupBy("key", "longer", "_a", "_b").agg(F.min("ref").alias("ref"), F.first("part").alias("part")))
    keyed = parts.select("_a", "_b", "ref", "key", "longer", F.explode(variants(F.col("key"), F.col("longer"), F.col("part"))).alias("variant"))
    # two longer lines of an inserted character need not be alike, so a longer
    # line looks for the shorter one, and a shorter one for the first longer one
    entry = F.struct("ref", "_a", "_b", "longer")
    best = (keyed.groupBy("variant").agg(F.min(F.when(~F.col("longer"), entry)).alias("short"), F.min(F.when(F.col("longer"), entry)).alias("long"),
                                         F.min("_a").alias("lo"), F.max("_a").alias("hi"))
            .where("lo <> hi and short is not null").select("variant", "short", "long"))
    seen = keyed.join(best, "variant").withColumn("f", F.when(F.col("longer") | F.col("long").isNull(), F.col("short")).otherwise(F.col("long")))
    met = (seen.where((F.col("ref") > F.col("f.ref")) & ((F.col("_a") != F.col("f._a")) | (F.col("_b") != F.col("f._b"))))
           .select("key", "_a", "_b", "longer", F.col("f._a").alias("fa"), F.col("f._b").alias("fb"), F.col("f.longer").alias("flonger")).distinct())
    own = parts.select("key", "_a", "_b", "longer", "part")
    other = parts.select("key", F.col("_a").alias("fa"), F.col("_b").alias("fb"), F.col("longer").alias("flonger"),
                         F.col("part").alias("fpart"))
    checked = (met.join(own, ["key", "_a", "_b", "longer"]).join(other, ["key", "fa", "fb", "flonger"])
               .where(F.levenshtein("part", "fpart") <= 1))
    return checked.select("_a", "_b").distinct()


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, stretch: int = STRETCH) -> DataFrame:
    """(_id, _h, _gone): the numbers of the lines to remove, per document that
    has some; rows repeating id and text are one document."""
    line = F.col("_line")
    halves = F.when(F.char_length(line) >= min_chars, half_keys(line, min_chars)).otherwise(F.array().cast("array<bigint>"))
    rows = staged(lines(docs).select("_id", "_h", "_pos", F.xxhash64(line).alias("_a"), F.xxhash64(F.lit(1), line).alias("_b"),
                                     halves.alias("_halves")))
    equal = (rows.groupBy("_a", "_b").agg(F.min(F.struct("_id", "_h", "_pos")).alias("first"), F.count("*").alias("n"))
             .where("n > 1").select("_a", "_b", "first"))
    near = alike_lines(docs, rows, stretch, min_chars).withColumn("near", F.lit(True))
    marked = staged(equal.join(near, ["_a", "_b"], "full").select("_a", "_b", "first", F.coalesce("near", F.lit(False)).alias("near")))
    gone = (rows.select("_id", "_h", "_pos", "_a", "_b").join(small(marked), ["_a", "_b"])
            .where(F.col("near") | (F.struct("_id", "_h", "_pos") > F.col("first"))))
    return staged(gone.groupBy("_id", "_h").agg(F.collect_set("_pos").alias("_gone")))


def with_kept(docs: DataFrame, min_chars: int, stretch: int) -> DataFrame:
    """(_row, _n, _removed, _kept): each row whole, its number of lines, how
    many were removed, and the text of the others."""
    gone = repeated_lines(docs.select("doc_id", "text"), min_chars, stretch)
    text = F.coalesce(F.col("_row.text"), F.lit(""))
    rows = docs.select(F.struct("*").alias("_row")).select(
        "_row", F.coalesce(F.col("_row.doc_id").cast("long"), F.lit(NULL_ID).cast("long")).alias("_id"), F.xxhash64(text).alias("_h"))
    joined = rows.join(small(gone), ["_id", "_h"], "left")
    split = F.split(text, "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("_gone"))  # hashed, so linear
    kept = F.array_join(F.transform(stay, lambda i: F.get(split, i)), "\n")
    return joined.select("_row", F.size(split).cast("long").alias("_n"),
                         F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("_removed"),
                         F.when(F.col("_gone").isNull(), text).otherwise(kept).alias("_kept"))


def line_counts(docs: DataFrame, min_chars: int = MIN_CHARS, stretch: int = STRETCH) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_chars, kept_sha256 of every document.

    A line (split at ``\\n``, trimmed) that is not blank is removed if an earlier
    line of the corpus (smaller doc_id, or earlier in the same document) is
    equal, or one edit away and both have ``min_chars`` characters at least,
    whether that one stays or not.  Blank lines always stay.  A null text is an empty one (one
    blank line).  Documents of one id are in order of a hash of their texts,
    those without an id come first; rows that repeat id and text are one
    document.  An empty table gives no rows; other columns are ignored."""
    out = with_kept(docs.select("doc_id", "text"), min_chars, stretch)
    return out.select(F.col("_row.doc_id").alias("doc_id"), F.col("_n").alias("n_lines"), F.col("_removed").alias("n_removed"),
                      F.char_length("_kept").cast("long").alias("kept_chars"), F.sha2("_kept", 256).alias("kept_sha256"))


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, stretch: int = STRETCH) -> DataFrame:
    """The documents without the removed lines; a document that loses lines and
    keeps no text goes.  All columns stay; ``n_chars`` counts the new text."""
    out = with_kept(docs, min_chars, stretch).where((F.col("_removed") == 0) | F.col("_kept").rlike(r"\S"))
    new = F.col("_row").withField("text", F.when(F.col("_removed") > 0, F.col("_kept")).otherwise(F.col("_row.text")))
    if "n_chars" in docs.columns:
        size = F.char_length("_kept").cast(docs.schema["n_chars"].dataType)
        new = new.withField("n_chars", F.when(F.col("_removed") > 0, size).otherwise(F.col("_row.n_chars")))
    return out.select(new.alias("_row")).select("_row.*")
