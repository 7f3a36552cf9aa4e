"""Near-duplicate documents by ProbMinHash of weighted word shingles.

Every shingle is a Poisson process whose rate is its number of occurrences;
its arrivals fall on random registers, a register keeps the earliest one, and a
shingle stops when it can no longer win any.  Registers agree with the
probability Jaccard similarity of two texts.  Bands of registers bring
candidates together; the exact probability Jaccard similarity decides.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalpress.llm.common import NULL_ID, bounded_batches, order_id, small, staged, tidy
from evalpress.llm.components import PARITY_WORDS, bucket_classes


@dataclass(frozen=True)
class Params:
    """``bands`` x ``rows`` registers: texts of similarity 0.8 share a band with
    probability 1 - (1 - 0.8^5)^24 > 0.9999.  A shingle weighs as often as it
    occurs; without ``weighted`` each different one weighs 1, for which the
    probability Jaccard similarity is the Jaccard similarity of the shingle sets."""

    words: int = 5
    similarity: float = 0.8
    weighted: bool = True
    bands: int = 24
    rows: int = 5


M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


def shingles(text: str, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different runs of ``words`` lower-cased words, ascending,
    and how often each occurs; a shorter text is one run, an empty one none."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0)
    known: dict[str, int] = {}
    h = np.array([known.get(w) or known.setdefault(w, xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")))
                  for w in found], np.uint64)
    n = max(1, len(h) - words + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(words, len(h))):
        out = mix(out * M1 + h[k:k + n])
    value, count = np.unique(out, return_counts=True)
    return value, count.astype(np.float64)


def prob_minhash(items: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """The item that wins each register."""
    best, won = np.full(size, np.inf), np.zeros(size, np.uint64)
    alive, clock, step = np.arange(len(items)), np.zeros(len(items)), 0
    while len(alive):
        block = int(min(64, max(1, -(-3 * size // len(alive)))))
        own = items[alive]
        draw = mix(own[:, None] + (np.arange(step, step + block, dtype=np.uint64) + np.uint64(1)) * M1)
        gap = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53)
        when = clock[alive][:, None] + np.cumsum(gap, 1) / weights[alive][:, None]
        where = (mix(draw ^ M3) % np.uint64(size)).astype(np.int64)
        w, r, o = when.ravel(), where.ravel(), np.repeat(own, block)
        use = np.flatnonzero(w < best[r])
        if len(use):
            use = use[np.argsort(-w[use], kind="stable")]  # the earliest is written last
            best[r[use]] = w[use]
            won[r[use]] = o[use]
        clock[alive] = when[:, -1]
        alive = alive[clock[alive] < best.max()]
        step += block
    return won


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    rows = signature.reshape(bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64) * M1
    for k in range(rows.shape[1]):
        key = mix(key * M2 + rows[:, k])
    return key.view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Sum over common items d of 1 / sum_i max(x_i / x_d, y_i / y_d)."""
    every = np.union1d(a, b)
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, a)], y[np.searchsorted(every, b)] = wa, wb
    with np.errstate(divide="ignore"):
        ratio = np.where(x > 0, y / np.where(x > 0, x, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    below, above = np.concatenate([[0], np.cumsum(x)]), np.concatenate([np.cumsum(y[::-1])[::-1], [0]])
    both = np.flatnonzero((x > 0) & (y > 0))
    at = np.searchsorted(ratio, ratio[both], side="right")
    return float((1 / (below[at] / x[both] + above[at] / y[both])).sum())


def signatures(docs: DataFrame, p: Params) -> DataFrame:
    """(_id, _h, _g, keys) per row: order id, two hashes of the text (a null
    one as empty), and the band keys; equal texts in a batch are hashed once."""
    src = bounded_batches(docs).select(order_id().alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    src = src.select("_id", F.xxhash64("text").alias("_h"), F.xxhash64(F.lit(1), "text").alias("_g"), "text")

    def run(batches):
        for b in batches:
            known: dict[tuple, np.ndarray] = {}
            out = []
            for h, g, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                got = known.get((h, g))
                if got is None:
                    items, weights = shingles(text, p.words)
                    weights = weights if p.weighted else np.ones(len(items))
                    got = known[h, g] = (band_keys(prob_minhash(items, weights, p.bands * p.rows), p.bands)
                                         if len(items) else np.zeros(0, np.int64))
                out.append(got)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(out, pa.list_(pa.int64()))],
                                             names=["_id", "_h", "_g", "keys"])

    return src.mapInArrow(tidy(run), "_id long, _h long, _g long, keys array<long>")


def shingle_sets(docs: DataFrame, texts: DataFrame, nodes: DataFrame, p: Params) -> DataFrame:
    """(node, s, w) of the text nodes: their shingles as ascending 32-bit
    hashes, and their weights, empty if all are 1."""
    need = staged(nodes.join(texts.select("node", "_id"), "node"))
    src = docs.select(order_id().alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("node"), "text")

    def sets(batches):
        for b in batches:
            item, weight = [], []
            for t in b.column(1).to_pylist():
                v, w = shingles(t or "", p.words)
                v, at = np.unique((v >> np.uint64(32)).astype(np.uint32), return_index=True)
                item.append(v.tobytes())
                w = np.add.reduceat(w, at).astype(np.uint32) if len(at) else np.zeros(0, np.uint32)
                weight.append(w.tobytes() if p.weighted and (w != 1).any() else b"")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(item, pa.binary()), pa.array(weight, pa.binary())],
                                             names=["node", "s", "w"])

    return staged(src.join(small(need), ["node", "_id"], "left_semi").select("node", "text")
                  .mapInArrow(tidy(sets), "node long, s binary, w binary").dropDuplicates(["node"]))


def item_weights(s: bytes, w: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The items of a written set and their weights."""
    items = np.frombuffer(s, np.uint32)
    return items, np.frombuffer(w, np.uint32) if w else np.ones(len(items), np.uint32)


def shared_items(own: DataFrame) -> DataFrame:
    """(node, n, u, r) of weighted sets: the weight of each node's items, of
    those that no other node has, and of what goes beyond each item's first occurrence."""

    def items(batches):
        for b in batches:
            out = [(x.astype(np.uint64) | w.astype(np.uint64) << np.uint64(32)).view(np.int64)
                   for x, w in map(item_weights, b.column(1).to_pylist(), b.column(2).to_pylist())]
            n = [int((x >> 32).sum()) for x in out]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int64())), pa.array(n, pa.int64()),
                                              pa.array([k - len(x) for k, x in zip(n, out)], pa.int64())],
                                             names=["node", "items", "n", "r"])

    listed = staged(own.select("node", "s", "w").mapInArrow(tidy(items), "node long, items array<long>, n long, r long"))
    single = (listed.select("node", F.explode("items").alias("item"))
              .groupBy(F.col("item").bitwiseAND(0xFFFFFFFF).alias("item"))
              .agg(F.count("*").alias("c"), F.min("node").alias("node"), F.min(F.shiftrightunsigned("item", 32)).alias("w"))
              .where("c = 1").groupBy("node").agg(F.sum("w").alias("u")))
    return listed.select("node", "n", "r").join(single, "node", "left").select("node", "n", F.coalesce("u", F.lit(0)).alias("u"), "r")


def item_parities(own: DataFrame) -> DataFrame:
    """(node, bits, kinds) of weighted sets: bit b of ``bits`` is the parity of
    the number of (item, occurrence) pairs whose hash modulo the number of bits
    is b, so two sets differ in no more bits than their weights differ in all;
    ``kinds`` counts each item once, so it differs in no more bits than there
    are items that only one set has."""
    size = 64 * PARITY_WORDS

    def parity(hashed: np.ndarray) -> np.ndarray:
        slot = mix(hashed) % np.uint64(size)
        return np.packbits((np.bincount(slot.astype(np.int64), minlength=size) & 1).astype(np.uint8)).view(np.int64)

    def parities(s: bytes, w: bytes) -> tuple[np.ndarray, np.ndarray]:
        items, weights = item_weights(s, w)
        kinds = parity(items.astype(np.uint64))
        if not w:
            return kinds, kinds
        nth = np.arange(int(weights.sum())) - np.repeat(np.cumsum(weights.astype(np.int64)) - weights, weights)
        return parity(np.repeat(items, weights).astype(np.uint64) + nth.astype(np.uint64) * M1), kinds

    def run(batches):
        for b in batches:
            out = [parities(*x) for x in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([x[k] for x in out], pa.list_(pa.int64())) for k in (0, 1)]],
                                             names=["node", "bits", "kinds"])

    return own.select("node", "s", "w").mapInArrow(tidy(run), "node long, bits array<long>, kinds array<long>")


def verified(pairs: DataFrame, own: DataFrame, p: Params) -> DataFrame:
    """The pairs (a, b) of text nodes whose shingle sets, among ``own``, are alike enough."""
    side = lambda n, k: own.select(F.col("node").alias(n), F.struct("s", "w").alias(k))
    full = (pairs.join(side("a", "x"), "a").join(side("b", "y"), "b")
            .select("a", "b", "x.s", F.col("y.s").alias("t"), "x.w", F.col("y.w").alias("u")))

    def alike(s: bytes, t: bytes, w: bytes, u: bytes) -> bool:
        (a, wa), (b, wb) = item_weights(s, w), item_weights(t, u)
        return (probability_jaccard(a, wa, b, wb) if w or u else jaccard(a, b)) >= p.similarity - 1e-9

    def check(batches):
        for b in batches:
            keep = pa.array([alike(*x) for x in zip(*[b.column(k).to_pylist() for k in range(2, 6)])], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["a", "b"])

    return full.mapInArrow(tidy(check), "a long, b long")


def near_classes(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(_id, _h, _g, class_id, class_texts, stays) of every row: the least
    order id of its class, how many different texts the class has, and whether
    the row is its class's first."""
    rows = staged(signatures(docs, p))
    texts = staged(rows.groupBy("_h", "_g").agg(F.min("_id").alias("_id"), F.first("keys").alias("keys"))
                   .select(F.col("_h").alias("node"), "_g", "_id", "keys"))
    buckets = staged(texts.select(F.explode("keys").alias("key"), "node"))
    labels = bucket_classes(buckets, lambda nodes: shingle_sets(docs, texts, nodes, p),
                            lambda pairs, own: verified(pairs, own, p), shared_items, item_parities, p.similarity)
    labelled = texts.join(labels, "node", "left").select("node", "_g", "_id", F.coalesce("label", "node").alias("label"))
    classes = labelled.groupBy("label").agg(F.min(F.struct("_id", "node", "_g")).alias("_first"), F.count("*").alias("class_texts"))
    of_text = labelled.join(classes, "label").select(F.col("node").alias("_h"), "_g", "_first", "class_texts")
    first = (F.col("_first._id") == F.col("_id")) & (F.col("_first.node") == F.col("_h")) & (F.col("_first._g") == F.col("_g"))
    return rows.select("_id", "_h", "_g").join(of_text, ["_h", "_g"]).select(
        "_id", "_h", "_g", F.col("_first._id").alias("class_id"), "class_texts", first.alias("stays"))


def near_duplicates(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, class_id, class_texts, stays of every document.

    A class is a component of the links between different texts whose
    ``words``-word shingles, weighted by their occurrences, have a probability
    Jaccard similarity of ``similarity`` or more; equal texts are always one class (a null text is an empty one).  Its
    id is its least doc_id, whose document stays; rows repeating both id and
    text have the same result; rows without an id come first and have the class
    id null if they lead it.  A text of fewer words than a shingle is alike to
    texts of the same words only.  An empty table gives no rows; other columns
    are ignored."""
    null = F.lit(NULL_ID).cast("long")
    return near_classes(docs, p).select(
        F.when(F.col("_id") != null, F.col("_id")).alias("doc_id"),
        F.when(F.col("class_id") != null, F.col("class_id")).alias("class_id"), "class_texts", "stays")


def keep_one(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The first document of every class, with all its columns."""
    found = staged(near_classes(docs, p))
    gone = staged(found.where(~F.col("stays")).select("_id", "_h", "_g").distinct())
    text = F.coalesce(F.col("_row.text"), F.lit(""))
    rows = docs.select(F.struct("*").alias("_row")).select(
        "_row", F.coalesce(F.col("_row.doc_id").cast("long"), F.lit(NULL_ID)).alias("_id"),
        F.xxhash64(text).alias("_h"), F.xxhash64(F.lit(1), text).alias("_g"))
    kept = rows.join(small(gone), ["_id", "_h", "_g"], "left_anti")
    if found.where("stays").count() > found.where("stays").select("_id", "_h", "_g").distinct().count():
        kept = kept.dropDuplicates(["_id", "_h", "_g"])  # rows that repeat both id and text
    return kept.select("_row.*")
