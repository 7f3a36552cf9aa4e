"""Language identification by string kernels.

Blended-spectrum presence kernel: two texts are as alike as the cosine of
their sets of character n-grams (all lengths up to ``grams``).  Landmark texts
span the Nystroem space; one kernel ridge regression per language scores it.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalpress.llm.common import bounded_batches, fraction_class, sampled, staged, tidy

UNKNOWN = "und"


@dataclass(frozen=True)
class Params:
    """Bounds of the training sample: at most ``per_lang`` ids of each of the
    ``langs`` most frequent languages and ``rows`` in all, chosen by a hash of
    the id, with one stretch of ``piece`` characters of a longer text.  Rarer
    languages have no class.  Predictions see whole texts: a text's score is the
    mean over its pieces of ``piece`` characters, by length, so the hashed
    n-grams of a long text do not fill up."""

    grams: int = 3
    bits: int = 13
    per_lang: int = 300
    langs: int = 200
    rows: int = 12_000
    piece: int = 8_000
    landmarks: int = 32  # per language
    ridge: float = 1e-2


def gram_codes(text: str, grams: int, bits: int) -> list[np.ndarray]:
    """Hashed n-grams of each length, by Fibonacci hashing of code points."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    h, out = np.zeros(len(c), np.uint64), []
    for n in range(1, grams + 1):
        if len(c) < n:
            break
        h = (h[:len(c) - n + 1] * np.uint64(0x100000001B3)) ^ (c[n - 1:] + np.uint64(n << 40))
        out.append((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits))
    return out


def presence(texts: list[str], grams: int, bits: int) -> np.ndarray:
    """One unit row per text over the hashed n-grams that occur in it."""
    x = np.zeros((len(texts), 1 << bits), np.float32)
    for row, t in zip(x, texts):
        for codes in gram_codes(t, grams, bits):
            row[codes] = 1.0
    norm = np.sqrt(x.sum(1, keepdims=True))
    return x / np.maximum(norm, 1.0)


@dataclass
class Model:
    langs: list[str]
    landmarks: np.ndarray  # features x landmarks
    weights: np.ndarray  # landmarks x languages
    params: Params

    def scores(self, texts: list[str], batch: int = 256) -> np.ndarray:
        """One row per text, one column per language."""
        p = self.params
        step = self.landmarks @ self.weights[:-1]
        parts = [(i, t[at:at + p.piece]) for i, t in enumerate(texts) for at in range(0, len(t), p.piece)]
        out, size = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        for at in range(0, len(parts), batch):
            some = parts[at:at + batch]
            owner = np.array([i for i, _ in some])
            weight = np.array([len(t) for _, t in some], np.float64)
            x = presence([t for _, t in some], p.grams, p.bits) @ step + self.weights[-1]
            np.add.at(out, owner, x * weight[:, None])
            np.add.at(size, owner, weight)
        return out / np.maximum(size, 1)[:, None]


def fit(texts: list[str], langs: list[str], params: Params) -> Model:
    """Nystroem features of the landmarks and one-versus-rest ridge weights."""
    names = sorted(set(langs))
    if not names:
        return Model([], np.zeros((1 << params.bits, 0), np.float32), np.zeros((0, 0), np.float32), params)
    x = presence(texts, params.grams, params.bits)
    y = np.array([[1.0 if a == b else 0.0 for b in names] for a in langs])
    chosen = [i for b in names for i in [j for j, a in enumerate(langs) if a == b][:params.landmarks]]
    land = x[chosen].T.copy()
    kmm = (land.T @ land).astype(np.float64)
    values, vectors = np.linalg.eigh(kmm)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    z = (x @ land).astype(np.float64) @ root
    z1 = np.hstack([z, np.ones((len(z), 1))])
    share = y.mean(0)
    w = (y / share).sum(1)  # every language has the same weight in total
    a = z1.T @ (z1 * w[:, None])
    reg = params.ridge * len(z) * np.eye(a.shape[0])
    reg[-1, -1] = 0
    beta = np.linalg.solve(a + reg + 1e-9 * np.eye(a.shape[0]), z1.T @ (y * w[:, None]))
    weights = np.vstack([root @ beta[:-1], beta[-1:]])
    return Model(names, land, weights.astype(np.float32), params)


def training_rows(docs: DataFrame, learn: Column, params: Params) -> tuple[list[str], list[str]]:
    """The bounded sample; an id with several languages takes the first by name."""
    docs = docs.where(learn & F.col("text").isNotNull())
    known = staged(docs.where(F.col("lang").isNotNull()).groupBy("doc_id").agg(F.min(F.col("lang").cast("string")).alias("_label")))
    common = [r["_label"] for r in known.groupBy("_label").count().orderBy(F.desc("count"), "_label").limit(params.langs).collect()]
    if not common:
        return [], []
    most = min(params.per_lang, max(1, params.rows // len(common)))
    texts, _ = sampled(docs, known.where(F.col("_label").isin(common)), most, seed=5)
    h = F.xxhash64(F.lit(5), "doc_id")
    start = F.when(F.length("text") > params.piece, F.pmod(h, F.length("text") - params.piece + 1)).otherwise(0) + 1
    picked = (texts.select("_label", F.substring("text", start.cast("int"), F.lit(params.piece)).alias("text"), h.alias("_h"), "doc_id")
              .collect())
    picked.sort(key=lambda r: (r["_h"], r["doc_id"]))
    return [r["text"] for r in picked], [r["_label"] for r in picked]


def predict(docs: DataFrame, model: Model, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """``id_cols`` plus lang_pred and score of every row.

    ``und`` with score 0 for a null text, a text without a letter, or a model
    without languages; a score is the winner's regression value clipped to 0..1;
    ties go to the first language by name.  Whole texts are read; repeated rows,
    null ids and other columns pass through or are ignored."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded: languages x landmarks x 2^bits

    def run(batches):
        m: Model = shared.value
        for b in batches:
            texts = b.column(len(id_cols)).to_pylist()
            lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            todo = [i for i, t in enumerate(texts) if t and m.langs and any(map(str.isalpha, t))]
            s = m.scores([texts[i] for i in todo]) if todo else np.zeros((0, 1))
            for i, k, v in zip(todo, s.argmax(1).tolist(), s.max(1).tolist()):
                lang[i], score[i] = m.langs[k], min(1.0, max(0.0, v))
            yield pa.RecordBatch.from_arrays(
                [b.column(k) for k in range(len(id_cols))] + [pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=id_cols + ["lang_pred", "score"])

    src = bounded_batches(docs.select(*id_cols, text_col))
    out = T.StructType(src.schema.fields[:-1]).add("lang_pred", "string").add("score", "double")
    return src.mapInArrow(tidy(run), out)


def not_held_out() -> Column:
    return F.coalesce(fraction_class("doc_id", 4) != 2, F.lit(False))


def identify(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; the model learns
    only from documents that are not held out.  A null doc_id is neither held
    out nor learnt from.  An empty table gives no rows."""
    model = fit(*training_rows(docs, not_held_out(), params), params)
    out = predict(docs.select("doc_id", "text"), model, ["doc_id"])
    held = F.coalesce(fraction_class("doc_id", 4) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, min_score: float = 0.2, params: Params = Params()) -> DataFrame:
    """The documents whose language is recognised: not ``und``, and a score of
    ``min_score`` at least.  Rows keep all their columns."""
    model = fit(*training_rows(docs, not_held_out(), params), params)
    found = predict(docs.select(F.struct("*").alias("_row"), "text"), model, ["_row"])
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select("_row.*")
