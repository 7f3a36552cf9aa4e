"""The streaming ingest gives the same per-report counts as the batch plan."""
import tempfile

from pyspark.sql import functions as F

from evalpress.plans import cohorts
from evalpress.sources import reports_json as RJ
from evalpress.streaming.ingest import read_counts, start_report_ingest
from tests.conftest import SMALL


def test_stream_matches_batch(spark):
    scratch = tempfile.mkdtemp(prefix="evalpress-stream-")
    root = RJ.write_reports(spark, SMALL, root=f"{scratch}/reports")
    q = start_report_ingest(spark, root, f"{scratch}/counts", f"{scratch}/ckpt", max_files_per_trigger=50)
    q.awaitTermination(300)
    got = read_counts(spark, f"{scratch}/counts")
    want = cohorts.report_rows(spark, SMALL).where(F.col("total") > 0).select("run_dir", "stem", "total", "err")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0
