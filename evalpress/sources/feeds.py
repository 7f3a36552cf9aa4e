"""Whole-file JSON feeds: guard, image and TTS reports, one pretty-printed
object (or an array of them) per file.

A file is read as a whole (``multiLine``), so line breaks inside a report do
not matter.  A file that is no JSON is one row of :func:`bad_files` and never
stops a build; a folder that is not there is an empty feed of the same type.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalpress.plans.schemas import D_, I, S, struct_of

CORRUPT = "_corrupt"

GUARD_FILE = struct_of([
    ("label", S), ("served_model", S), ("threshold", D_), ("protocol", S), ("reasoning_effort", S), ("mtime", S),
    ("per_case", T.ArrayType(S)), ("metrics", struct_of([
        ("n_unsafe", I), ("n_safe", I), ("recall", D_), ("fn_rate", D_), ("fpr", D_), ("trap_fpr", D_), ("precision", D_),
        ("f1", D_), ("accuracy", D_), ("latency_ms_mean", D_), ("latency_ms_p95", D_), ("guard_protocol", S),
        ("confusion", struct_of([(c, I) for c in ("tp", "tn", "fp", "fn", "errors")]))]))])
RESCORE_FILE = struct_of([("run", S), ("wer_judge1_mean", D_), ("wer_judge2_mean", D_), ("judge1", S), ("judge2", S),
                          ("protocol", S), ("cases", T.ArrayType(S))])
SUMMARY_FILE = struct_of(
    [("tts_model", S), ("testset", S)] + [(c, I) for c in ("n_total", "n_ok", "n_error", "n_asr_runaway", "n_repeats")]
    + [(c, D_) for c in ("rtf_mean", "sec_per_char_median", "sec_per_char_mean", "wer_mean", "wer_capped_mean", "wer_best_mean",
                         "cer_mean")] + [("worst_cases", T.ArrayType(S)), ("stt_prompt", S)])
IMAGE_FILE = struct_of([("run_dir", S), ("model", S), ("cases", I), ("generated", I), ("failed", I), ("gen_seconds_mean", D_),
                        ("text_rendering_cer_mean", D_), ("adherence_score_mean", D_)])


def or_empty(spark: SparkSession, read: Callable[[], DataFrame], schema: T.StructType) -> DataFrame:
    """``read()``, or no rows of the same type if its path is not there."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def whole_files(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """The objects of whole JSON files with ``path``, ``file_time`` and, for a file
    that cannot be parsed, its text in ``_corrupt``.  A file is one task's work,
    as JSON over many lines cannot be split; many small files share a task."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, S)])
    told = T.StructType([*full.fields, T.StructField("path", S), T.StructField("file_time", T.TimestampType())])

    def read() -> DataFrame:
        return (spark.read.schema(full).option("multiLine", True).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", CORRUPT).option("ignoreMissingFiles", True).json(paths)
                .select("*", F.col("_metadata.file_path").alias("path"),
                        F.col("_metadata.file_modification_time").alias("file_time")))

    return or_empty(spark, read, told)


def folder(path: Column | str = "path", level: int = 2) -> Column:
    """Name of the folder ``level - 1`` steps above a file; ``key=name``, as a
    partitioned writer calls folders, is ``name``."""
    part = F.try_element_at(F.split(path, "/"), F.lit(-level))
    return F.url_decode(F.regexp_replace(part, r"^[^=]*=", ""))


def good(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_files(df: DataFrame) -> DataFrame:
    """(path, n_chars) of every file that is no JSON, once each."""
    # Spark only parses, and so only sees a bad file, if a column of the data is read
    data = next(c for c in df.columns if c not in (CORRUPT, "path", "file_time"))
    seen = F.to_json(F.struct(data)) != ""
    return df.where(F.col(CORRUPT).isNotNull() & seen).groupBy("path").agg(F.max(F.length(CORRUPT)).alias("n_chars"))


def guards(spark: SparkSession, root: str, pattern: str = "*/*") -> DataFrame:
    """Guard reports; a report without a date of its own has its file's."""
    d = good(whole_files(spark, f"{root}/{pattern}", GUARD_FILE))
    return d.withColumn("mtime", F.coalesce("mtime", F.date_format("file_time", "yyyy-MM-dd"))).select(*GUARD_FILE.names)


def images(spark: SparkSession, root: str, pattern: str = "*/*") -> DataFrame:
    """Image summaries; the run directory is the folder if the report names none."""
    d = good(whole_files(spark, f"{root}/{pattern}", IMAGE_FILE))
    return d.withColumn("run_dir", F.coalesce("run_dir", folder())).select(*IMAGE_FILE.names)


def tts(spark: SparkSession, root: str, rescore: str = "*/rescore_judge2.json",
        summary: str = "*/summary.json") -> tuple[DataFrame, DataFrame]:
    """The two files of a TTS run with their directory, to be joined on it."""
    return tuple(good(whole_files(spark, f"{root}/{p}", s)).select(folder().alias("dir"), *s.names)
                 for p, s in ((rescore, RESCORE_FILE), (summary, SUMMARY_FILE)))


def pretty(cols: Sequence[str], keep_null: bool = False) -> Column:
    return F.to_json(F.struct(*cols), {"pretty": "true", "ignoreNullFields": str(not keep_null).lower()})


def write_each(df: DataFrame, root: str, by: str, cols: Sequence[str]) -> str:
    """One pretty-printed file per row below a folder named by ``by``."""
    df.select(by, pretty(cols).alias("value")).write.mode("overwrite").partitionBy(by).text(root)
    return root


def write_arrays(df: DataFrame, root: str, by: str, cols: Sequence[str], per_file: int = 200) -> str:
    """Pretty-printed arrays of about ``per_file`` objects, for feeds of very
    many small reports."""
    files = max(1, -(-df.count() // per_file))
    d = df.select(F.pmod(F.xxhash64(by), F.lit(files)).alias("bulk"), pretty(cols).alias("o"))
    text = F.concat(F.lit("[\n"), F.array_join(F.collect_list("o"), ",\n"), F.lit("\n]"))
    d.groupBy("bulk").agg(text.alias("value")).write.mode("overwrite").partitionBy("bulk").text(root)
    return root

