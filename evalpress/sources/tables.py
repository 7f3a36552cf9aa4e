"""Reading the driver's parquet tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


_READ: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Catalyst prunes columns and pushes filters into the
    scan, and the scan's splits are its tasks.  The DataFrame is immutable, so
    one read (file listing, footer) per session is reused by every query."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _READ.get(key)
    if df is None:
        df = _READ[key] = spark.read.parquet(path)
    return df


def sf_tag(sf_dir: str) -> str:
    """Short name of a scale-factor folder, used to key written fixtures:
    the folder name plus a hash of the full path (two folders of the same
    name never share written files)."""
    import hashlib
    path = sf_dir.rstrip("/")
    return path.rsplit("/", 1)[-1] + "-" + hashlib.sha1(path.encode()).hexdigest()[:8]
