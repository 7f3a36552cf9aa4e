"""The pipeline's stages on planted documents, each against its operator."""
from __future__ import annotations

import random

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import CLASH, collected, docs
from tests.llm.test_models import TONGUES, prose


def planted() -> list[tuple]:
    rng = random.Random(11)
    rows = [(i, "\n".join(prose(rng, lang, rng.randrange(20, 60)) for _ in range(3)), lang)
            for i in range(120) for lang in [rng.choice(list(TONGUES))]]
    passage = prose(rng, "aa", 70)
    rows += [(200, rows[0][1], rows[0][2]), (201, None, "aa"), (202, "12 34", "aa"), (203, "", "bb")]
    rows += [(210 + i, prose(rng, "aa", 30) + " " + passage + " " + prose(rng, "aa", 30), "aa") for i in range(3)]
    near = prose(rng, "bb", 150).split()
    rows += [(220, " ".join(near), "bb"), (221, " ".join(near[:70] + ["xung"] + near[71:]), "bb")]
    return rows


def test_stages(spark):
    rows = planted()
    first = docs(spark, rows, clash=True)
    out = {}
    now = first
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, now, "")
        if name != "packing":
            assert got.columns == first.columns
            got = spark.createDataFrame(got.collect(), first.schema)
        out[name] = {r["doc_id"]: r for r in collected(got)} if name != "packing" else collected(got)
        now = got
    assert {201, 202, 203}.isdisjoint(out["language_id"]) and len(out["language_id"]) >= len(rows) - 5
    assert 200 not in out["line_dedup"] and 0 in out["line_dedup"]
    assert 220 in out["near_dedup"] and 221 not in out["near_dedup"]
    text = {k: r["text"] for k, r in out["substring_dedup"].items()}
    assert len(text[211]) < len(text[210]) - 100 and all(r["n_chars"] == len(r["text"]) for r in out["substring_dedup"].values())
    clean = [i for i in range(120) if i in out["language_id"]]
    assert sum(text.get(i) == rows[i][1] for i in clean) >= 0.98 * len(clean)
    assert {r["doc_id"] for r in out["packing"]} == set(text)


def test_run_and_empty(spark, tmp_path):
    docs(spark, planted()).write.parquet(f"{tmp_path}/documents.parquet")
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert whole.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert whole.select("doc_id").distinct().count() > 100
    empty = docs(spark, []).select("*", *[F.lit("x").alias(c) for c in CLASH])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0
