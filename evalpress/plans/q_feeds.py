"""Report feeds as files: written pretty-printed, read back whole (op 1)."""
from __future__ import annotations

from pyspark.sql import functions as F

from evalpress.plans import fixtures as fx
from evalpress.plans.registry import query
from evalpress.session import scratch_path
from evalpress.sources import feeds
from evalpress.sources.tables import sf_tag

W = fx.with_


def _root(spark, sf, name):
    return scratch_path(spark, "feeds", sf_tag(sf), name)


_GUARD = ("label", "served_model", "threshold", "protocol", "reasoning_effort", "mtime")
_METRICS = [n for n in feeds.GUARD_FILE["metrics"].dataType.names if n != "confusion"]
_CONFUSION = feeds.GUARD_FILE["metrics"].dataType["confusion"].dataType.names


def guard_files(spark, sf, name="guards"):
    """The guard reports as files, and beside some of them a file cut short."""
    g = fx.fx2_guards(spark, sf).withColumn("file", F.col("label"))
    root = feeds.write_each(g, _root(spark, sf, name), "file", feeds.GUARD_FILE.names)
    cut = (g.where(F.col("label").rlike("[05]$"))
           .select(F.concat(F.lit("cut-"), "label").alias("file"), feeds.pretty(["label", "mtime"]).alias("value"))
           .withColumn("value", F.expr("substr(value, 1, length(value) - 3)")))
    cut.write.mode("append").partitionBy("file").text(root)
    return root


@query("src_guard_json", W(fx.FX2_SQL) + f"SELECT {', '.join([*_GUARD, *_METRICS, *_CONFUSION])} FROM fx2")
def q_guard_json(spark, sf):
    g = feeds.guards(spark, guard_files(spark, sf))
    return g.select(*_GUARD, *[f"metrics.{m}" for m in _METRICS], *[f"metrics.confusion.{c}" for c in _CONFUSION])


@query("src_bad_files", W(fx.FX2_SQL) + """SELECT 'cut-' || label AS file FROM fx2
WHERE regexp_matches(label, '[05]$')""")
def q_bad_files(spark, sf):
    files = feeds.whole_files(spark, f"{guard_files(spark, sf, 'guards_bad')}/*/*", feeds.GUARD_FILE)
    return feeds.bad_files(files).select(feeds.folder().alias("file"))


_TTS_SUM = [n for n in feeds.SUMMARY_FILE.names if n not in ("worst_cases", "stt_prompt")]


@query("src_tts_json", W(fx.FX3_RESCORE_SQL, fx.FX3_SUMMARY_SQL) +
       f"""SELECT r.dir, r.run, r.wer_judge1_mean, r.wer_judge2_mean, r.judge1, r.judge2, {', '.join('s.' + c for c in _TTS_SUM)}
FROM fx3_rescore r LEFT JOIN fx3_summary s ON s.dir = r.dir""")
def q_tts_json(spark, sf):
    root = _root(spark, sf, "tts")
    feeds.write_each(fx.fx3_rescore(spark, sf), f"{root}/rescore", "dir", feeds.RESCORE_FILE.names)
    feeds.write_each(fx.fx3_summary(spark, sf), f"{root}/summary", "dir", feeds.SUMMARY_FILE.names)
    rescore, summary = feeds.tts(spark, root, "rescore/*/*", "summary/*/*")
    return rescore.join(summary.select("dir", *_TTS_SUM), "dir", "left").select(
        "dir", "run", "wer_judge1_mean", "wer_judge2_mean", "judge1", "judge2", *_TTS_SUM)


@query("src_image_json", W(fx.FX4_SQL) + f"SELECT {', '.join(feeds.IMAGE_FILE.names)} FROM fx4")
def q_image_json(spark, sf):
    root = feeds.write_arrays(fx.fx4_images(spark, sf), _root(spark, sf, "images"), "run_dir", feeds.IMAGE_FILE.names)
    return feeds.images(spark, root)

