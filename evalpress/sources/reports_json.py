"""Report files: write the LLM reports as nested JSON files and read them back
(ops 1-3).

Layout: ``<root>/run_dir=<dir>/stem=<file stem>/part-*.json`` -- one folder
per report file, as the reports arrive in the file drop.  A record holds the
report's meta and summary plus one playbook with a slice of at most
``chunk`` consecutive case positions, so no record grows with a hot report.
Reading uses an explicit schema (no inference); a malformed record lands in
``_corrupt`` and is dropped.
"""
from __future__ import annotations

import glob
import itertools
import os
import re
import shutil
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalpress.plans import fixtures as fx
from evalpress.plans.schemas import REPORT
from evalpress.session import scratch_path
from evalpress.sources.feeds import folder, whole_files
from evalpress.sources.tables import sf_tag

# FIXED VALUE: report files whose names match this are not reports
NOT_A_REPORT = r"(?i)dashboard|index"

READ_SCHEMA = T.StructType(REPORT.fields + [T.StructField("run_dir", T.StringType()),
                                            T.StructField("stem", T.StringType())])


def report_records(cases: DataFrame, chunk: int = 256) -> DataFrame:
    """Nested report records from flat cases (the reference's file shape)."""
    reps = fx.fx1_reports(cases).select(
        "run_dir", "stem",
        F.struct("model", "source", "profile", "run", "judge").alias("meta"),
        F.struct("overall", "pass_rate", "knockouts", "total_tests").alias("summary"),
        F.col("playbooks").alias("_agg"))
    slices = (cases.withColumn("_chunk", F.floor(F.col("pos") / chunk))
              .groupBy("run_dir", "stem", "playbook", "_chunk").agg(
                  F.sort_array(F.collect_list(F.struct("pos", "test_id", "verdict", "response"))).alias("_res"),
                  F.collect_list(F.when(F.col("knockout"), F.col("test_id"))).alias("_ko")))
    j = slices.join(reps, ["run_dir", "stem"])
    agg = F.col("_agg")[F.col("playbook")]
    entry = F.struct(
        agg["pass_rate"].alias("pass_rate"), agg["mean_score"].alias("mean_score"),
        agg["total"].alias("total"), agg["passed"].alias("passed"),
        F.col("_ko").alias("knockouts"),
        F.transform("_res", lambda r: F.struct(r["test_id"].alias("test_id"), r["verdict"].alias("verdict"),
                                               r["response"].alias("response"), r["pos"].alias("pos"))
                    ).alias("results"))
    return j.select("run_dir", "stem", "meta", "summary", F.create_map(F.col("playbook"), entry).alias("playbooks"))


def _local(spark: SparkSession, root: str) -> str | None:
    """The folder as the tasks' own file calls name it, if ``root`` is one."""
    if root.startswith("/"):
        root = (spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///").rstrip("/") + root
    return re.sub("^file:/+", "/", root) if root.startswith("file:/") else None


def write_files(recs: DataFrame, folder: str, most: int = 100_000) -> int:
    """Write report records as JSON lines, a file per report, with plain file
    calls in the tasks; returns the number of files.

    Spark's writer starts four processes per file on a local or mounted folder
    (owner rights of the file and its checksum).  A report of more than ``most``
    cases is dealt out over several files.  A file gets its name only when it is
    whole, and a repeated task writes the same files."""
    line = F.to_json(F.struct("meta", "summary", "playbooks"))
    parts = F.floor(F.coalesce(F.col("summary.total_tests"), F.lit(0)) / most) + 1
    lines = (recs.select("run_dir", "stem", parts.alias("part"), line.alias("line"))
             .withColumn("part", F.pmod(F.xxhash64("line"), "part")))
    key = ["run_dir", "stem", "part"]

    def escaped(name):  # as Spark names and reads the folder of a value
        if not name:
            return "__HIVE_DEFAULT_PARTITION__"
        return re.sub(r"""["#%'*/:=?\\{\[\]^\x00-\x1f\x7f]""", lambda m: f"%{ord(m[0]):02X}", name)

    def write(batches):
        at, out, n = None, None, 0

        def close():
            if out:
                out.close()
                os.replace(out.name, f"{os.path.dirname(out.name)}/part-{at[2]:05d}.json")

        try:
            for b in batches:
                for run_dir, stem, part, text in zip(*(c.to_pylist() for c in b.columns)):
                    if at != (run_dir, stem, part):
                        close()
                        d = f"{folder}/run_dir={escaped(run_dir)}/stem={escaped(stem)}"
                        os.makedirs(d, exist_ok=True)
                        out = open(f"{d}/.{uuid.uuid4().hex}", "w", encoding="utf-8", errors="surrogatepass")
                        at, n = (run_dir, stem, part), n + 1
                    out.write(text + "\n")
            close()
        except BaseException:
            if out and not out.closed:
                out.close()
                os.unlink(out.name)
            raise
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    made = lines.repartition(*key).sortWithinPartitions(*key).mapInArrow(write, "n long")
    return made.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_reports(spark: SparkSession, sf: str, root: str | None = None, decoys: bool = True) -> str:
    """Write the FX1 reports once per scale factor (reused when complete)."""
    root = root or scratch_path(spark, "reports", sf_tag(sf))
    local = _local(spark, root)
    if local and os.path.exists(f"{local}/_SUCCESS"):
        return root
    cases = fx.fx1_cases(spark, sf)
    if local:
        shutil.rmtree(local, ignore_errors=True)
        os.makedirs(local)
        write_files(report_records(cases), local)
    else:
        report_records(cases).write.mode("overwrite").partitionBy("run_dir", "stem").json(root)
    named = F.col("run_dir").isNotNull() & F.col("stem").isNotNull()
    first = cases.where(named).agg(F.min(F.struct("run_dir", "stem")).alias("m")).first()["m"] if decoys else None
    if first:
        # a dashboard and an index file beside the reports, and a broken file
        one = report_records(cases.where((F.col("run_dir") == first["run_dir"]) & (F.col("stem") == first["stem"])))
        for stem in ("dashboard", "index"):
            one.limit(1).drop("run_dir", "stem").write.mode(
                "overwrite").json(f"{root}/run_dir={first['run_dir']}/stem={stem}")
        spark.createDataFrame([("{\"meta\": {\"model\": ",)], "value string").write.mode("overwrite").text(
            f"{root}/run_dir={first['run_dir']}/stem=broken")
    if local:
        open(f"{local}/_SUCCESS", "w").close()
    return root


def read_whole_reports(spark: SparkSession, root: str, pattern: str = "*/*.json") -> DataFrame:
    """Report files as they are dropped, ``<run directory>/<stem>.json``, each a
    pretty-printed object; the same columns as :func:`read_reports`."""
    schema = T.StructType([f for f in REPORT.fields if f.name != "_corrupt"])
    df = whole_files(spark, f"{root}/{pattern}", schema)
    stem = F.regexp_replace(folder("path", 1), r"\.json$", "")
    return df.select(*schema.names, "_corrupt", folder("path", 2).alias("run_dir"), stem.alias("stem"), "path",
                     F.col("file_time").alias("mtime"))


def local_files(spark: SparkSession, folder: str, dir_glob: str = "*", ending: str = "") -> DataFrame:
    """(file, length, mtime) of the files with this ``ending`` below the run directories,
    listed by the tasks: a run directory's entries by one task, what lies below
    them by all.  The driver sees the run directories only."""
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dirs = sorted(glob.glob(f"{glob.escape(folder)}/run_dir={dir_glob}"))

    def seen(d):  # not what Spark's readers take as hidden
        with os.scandir(d) as found:
            yield from (e for e in found if not (e.name[0] == "." or e.name[0] == "_" and "=" not in e.name))

    def children(batches):
        for b in batches:
            for d in b.column(0).to_pylist():
                names = (e.path for e in seen(d))
                while some := list(itertools.islice(names, 10_000)):
                    yield pa.RecordBatch.from_pydict({"file": pa.array(some, pa.string())})

    def below(paths):
        for p in paths:
            if os.path.isdir(p):
                yield from below(e.path for e in seen(p))
            elif p.endswith(ending):
                yield p, os.stat(p)

    def files(batches):
        for b in batches:
            found = below(b.column(0).to_pylist())
            while some := list(itertools.islice(found, 10_000)):
                yield pa.RecordBatch.from_pydict({
                    "file": pa.array([p for p, _ in some], pa.string()),
                    "length": pa.array([st.st_size for _, st in some], pa.int64()),
                    "mtime": pa.array([st.st_mtime_ns // 10**6 * 1000 for _, st in some], pa.timestamp("us", "UTC"))})

    top = spark.createDataFrame([(d,) for d in dirs], "dir string").repartition(max(1, min(tasks, len(dirs))), "dir")
    return (top.mapInArrow(children, "file string").repartition(tasks, "file")
            .mapInArrow(files, "file string, length long, mtime timestamp"))


def local_lines(spark: SparkSession, folder: str, dir_glob: str = "*", size: int = 64 << 20) -> DataFrame:
    """(file, mtime, run_dir, stem, line) of the files' lines, the folders' names
    as Spark reads them.  A file is read in ranges of ``size`` bytes: a line
    belongs to the range that it starts in."""
    ranges = (local_files(spark, folder, dir_glob)
              .select("file", "mtime", F.explode(F.sequence(F.lit(0), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(size))).alias("start")))

    def value(path, key):
        got = re.search(f"/{key}=([^/]*)/", path[len(folder):])
        if not got or got[1] == "__HIVE_DEFAULT_PARTITION__":
            return None
        return re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), got[1])

    def lines(path, start):
        with open(path, "rb") as f:
            at = start
            if start:
                f.seek(start - 1)
                at += len(f.readline()) - 1
            while at < start + size and (text := f.readline()):
                at += len(text)
                if text.strip():
                    yield text.strip(b"\r\n").decode("utf-8", "replace")

    def read(batches):
        for b in batches:
            rows = ((p, t, value(p, "run_dir"), value(p, "stem"), text)
                    for p, t, start in zip(*(c.to_pylist() for c in b.columns)) for text in lines(p, start))
            some, held = [], 0
            for r in itertools.chain(rows, [None]):
                if r:
                    some.append(r)
                    held += len(r[4])
                if some and (not r or held > 4 << 20 or len(some) >= 10_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.timestamp("us", "UTC") if i == 1 else pa.string()) for i, c in enumerate(zip(*some))],
                        names=["file", "mtime", "run_dir", "stem", "line"])
                    some, held = [], 0

    return ranges.mapInArrow(read, "file string, mtime timestamp, run_dir string, stem string, line string")


def read_reports(spark: SparkSession, root: str, dir_glob: str = "*") -> DataFrame:
    """Report records with run directory, file stem, path and file time.  A
    local or mounted folder is listed and read by the tasks; with a file per
    report, an index of all files would outgrow the driver."""
    if local := _local(spark, root):
        told = {"columnNameOfCorruptRecord": "_corrupt"}
        df = local_lines(spark, local, dir_glob).withColumn("r", F.from_json("line", READ_SCHEMA, told))
        return df.select(*[F.coalesce(c, f"r.{c}").alias(c) if c in ("run_dir", "stem") else F.col(f"r.{c}") for c in READ_SCHEMA.names],
                         F.concat(F.lit("file://"), "file").alias("path"), "mtime")
    df = (spark.read.schema(READ_SCHEMA)
          .option("columnNameOfCorruptRecord", "_corrupt")
          .option("basePath", root)
          .json(f"{root}/run_dir={dir_glob}"))
    return df.select("*", F.col("_metadata.file_path").alias("path"),
                     F.col("_metadata.file_modification_time").alias("mtime"))


def list_report_files(spark: SparkSession, root: str, dir_glob: str = "*") -> DataFrame:
    """Candidate report files by glob, without reading their content: run
    directory and file stem from the path, names that are not reports
    dropped (case-insensitive)."""
    if local := _local(spark, root):
        files = local_files(spark, local, dir_glob, ".json").select(
            F.concat(F.lit("file:"), "file").alias("path"), "length", F.col("mtime").alias("modificationTime"))
    else:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("basePath", root)
                 .load(f"{root}/run_dir={dir_glob}").select("path", "length", "modificationTime"))
    files = files.select(
        F.regexp_extract("path", r"/run_dir=([^/]+)/", 1).alias("run_dir"),
        F.regexp_extract("path", r"/stem=([^/]+)/", 1).alias("stem"), "path", "length", "modificationTime")
    return files.where(~F.col("stem").rlike(NOT_A_REPORT))


def valid_records(df: DataFrame) -> DataFrame:
    """Drop malformed records and files that are not reports.  The caller must
    read at least one data column besides ``_corrupt`` (Spark only detects a
    malformed record when it parses fields)."""
    return df.where(F.col("_corrupt").isNull() & ~F.col("stem").rlike(NOT_A_REPORT))


def cases_from_records(df: DataFrame) -> DataFrame:
    e = df.select("run_dir", "stem", F.explode("playbooks").alias("playbook", "pb"))
    return e.select("run_dir", "stem", "playbook", F.explode("pb.results").alias("r")).select(
        "run_dir", "stem", "playbook", "r.*")


def reports_from_records(records: DataFrame) -> DataFrame:
    """Report files -> one row per report in the shape the LLM report flow reads
    (meta and summary fields, map playbook -> aggregates).

    Works on any number of records per report (a file may hold its playbooks
    in slices): case counts are summed over slices, the first performance
    case is the smallest position, the playbook aggregates are taken as
    written.  Every step is an aggregation with partial combine; the map has
    at most one entry per playbook.
    """
    recs = valid_records(records)
    e = recs.select("run_dir", "stem", "meta", "summary", F.explode("playbooks").alias("playbook", "pb"))
    # a result's place: as written by a slice, else its place in the list
    placed = F.transform("pb.results", lambda r, i: F.struct(
        F.coalesce(r["pos"], i.cast("long")).alias("pos"), r["response"].alias("response"), r["test_id"].alias("test_id")))
    perf = F.filter(placed, lambda r: r["test_id"] == F.lit("perf_benchmark"))
    first_perf = F.try_element_at(F.array_sort(F.transform(perf, lambda r: F.struct(r["pos"], r["response"]))),
                                  F.lit(1))
    sl = e.select(
        "run_dir", "stem", "meta", "summary", "playbook",
        F.col("pb.pass_rate").alias("pass_rate"), F.col("pb.mean_score").alias("mean_score"),
        F.col("pb.passed").alias("passed"), F.col("pb.total").alias("_total"),
        F.coalesce(F.size("pb.results"), F.lit(0)).alias("n_results"),
        F.coalesce(F.size(F.filter(F.col("pb.results"), lambda r: r["verdict"] == F.lit("error"))), F.lit(0))
        .alias("n_err"),
        F.coalesce(F.size("pb.knockouts"), F.lit(0)).alias("n_ko"),
        first_perf.alias("perf"))
    pb = sl.groupBy("run_dir", "stem", "playbook").agg(
        F.max("meta").alias("meta"), F.max("summary").alias("summary"),
        F.max("pass_rate").alias("pass_rate"), F.max("mean_score").alias("mean_score"),
        F.coalesce(F.max("_total"), F.sum("n_results")).cast("int").alias("total"), F.max("passed").alias("passed"),
        F.sum("n_ko").cast("int").alias("n_knockouts"), F.sum("n_err").cast("int").alias("n_error"),
        F.min("perf").alias("perf"))
    entry = F.struct(F.col("pass_rate"), F.col("mean_score"), F.col("total"), F.col("passed"),
                     F.col("n_knockouts"), F.col("n_error"), F.col("perf.response").alias("perf_response"))
    rep = pb.groupBy("run_dir", "stem").agg(
        F.max("meta").alias("meta"), F.max("summary").alias("summary"),
        F.map_from_entries(F.collect_list(F.struct(F.col("playbook"), entry))).alias("playbooks"))
    return rep.select("run_dir", "stem", "meta.model", "meta.source", "meta.profile", "meta.run", "meta.judge",
                      "summary.overall", "summary.pass_rate", "summary.knockouts", "summary.total_tests",
                      "playbooks")


def ingest_to_parquet(spark: SparkSession, root: str, target: str) -> DataFrame:
    """Parse the report files once into a Parquet table partitioned by run
    directory (columnar, splittable, prunable by directory); malformed
    records and files that are not reports are left out.  Returns the table
    as read back."""
    recs = valid_records(read_reports(spark, root)).drop("_corrupt", "path", "mtime")
    recs.write.mode("overwrite").option("compression", "zstd").partitionBy("run_dir").parquet(target)
    return read_ingested(spark, target)


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    """Report records from the ingested table, in the file reader's shape."""
    schema = T.StructType([f for f in READ_SCHEMA.fields if f.name != "_corrupt"])
    df = spark.read.schema(schema).parquet(target)
    return df.withColumn("_corrupt", F.lit(None).cast("string"))
