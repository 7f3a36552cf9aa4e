"""Toxicity by a subsequence string kernel and a linear support vector machine.

Words are compared by the three letters that occur in the same order, near each
other, with gaps discounted; so an insult with inserted or left-out characters
stays close to the insult.  Landmarks are words of labelled toxic documents; a
text's Nystroem features are its best kernel value against each landmark.
"""
from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalpress.llm.common import bounded_batches, fraction_class, sampled, small, staged, tidy


@dataclass(frozen=True)
class Params:
    """``landmarks``: most words taken as landmarks, among words in at least
    ``least_docs`` toxic documents; ``decay``: factor for each skipped letter;
    ``span``: letters that a subsequence may stretch over; ``floor``: kernel
    values below it count as 0; ``rows``: training ids of a label at most, a text
    each (the fitting sample, drawn by a hash of the id)."""

    landmarks: int = 192
    least_docs: int = 4
    least_odds: float = 8.0
    decay: float = 0.6
    span: int = 5
    floor: float = 0.45
    rows: int = 6000
    cost: float = 1.0
    unit: int = 32


LETTERS = re.compile(r"[\W\d_]+")
SPACED = re.compile(r"(?:^|(?<=\s))(?:\w\s){2,}\w(?=\s|$)")


def clean(token: str) -> str:
    """A word without the characters between its letters."""
    return token if token.isalpha() else LETTERS.sub("", token)


#: which code points are white space; none above U+3000 is
SPACE = np.array([chr(c).isspace() for c in range(0x3002)])


def may_be_spaced(text: str) -> bool:
    """Whether two single characters stand between blanks next to each other,
    as in every match of ``SPACED``."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    blank = np.ones(len(code) + 2, bool)  # the text's ends count as blanks
    blank[1:-1] = SPACE[np.minimum(code, 0x3001)]
    lone = blank[:-2] & ~blank[1:-1] & blank[2:]
    return bool((lone[:-2] & lone[2:]).any())


def units(text: str, step: int) -> set[str]:
    """The different words of a text, lower-cased; runs of single letters also
    count as one word; longer words count as overlapping stretches."""
    low = text.casefold()
    out = set(low.split())
    if may_be_spaced(low):
        out.update("".join(m.split()) for m in SPACED.findall(low))
    long = [w for w in out if len(w) > step]
    for w in long:
        out.discard(w)
        w = clean(w)
        out.update(w[i:i + step] for i in range(0, max(1, len(w) - step // 2), step // 2))
    return out


def offsets(p: Params) -> list[tuple[int, int, float]]:
    return [(a, b, p.decay ** (b - 2)) for b in range(2, p.span) for a in range(1, b)]


def profile(word: str, p: Params) -> dict[int, float]:
    """Weights of the letter triples of a word, of unit length."""
    c = [ord(x) for x in word]
    out: dict[int, float] = {}
    for a, b, w in offsets(p):
        for i in range(len(c) - b):
            key = c[i] << 42 | c[i + a] << 21 | c[i + b]
            out[key] = out.get(key, 0.0) + w
    norm = math.sqrt(sum(v * v for v in out.values()))
    return {k: v / norm for k, v in out.items()}


class Landmarks:
    """Kernel values of many words against the landmarks."""

    def __init__(self, words: list[str], p: Params, known: int = 400_000):
        self.words, self.p = words, p
        profiles = [profile(w, p) for w in words]
        self.codes = np.array(sorted({k for x in profiles for k in x}), np.uint64)
        at = {int(k): i for i, k in enumerate(self.codes.tolist())}
        self.matrix = np.zeros((len(at), len(words)), np.float32)
        for j, x in enumerate(profiles):
            for k, v in x.items():
                self.matrix[at[k], j] = v
        # a triple's greatest weight in any landmark, and in any of a few like-spelled ones
        self.most = self.matrix.max(1, initial=0)
        alike = sorted(range(len(words)), key=words.__getitem__)
        self.coarse = np.stack([self.matrix[:, alike[i:i + 8]].max(1) for i in range(0, len(words), 8)] or [self.most], 1)
        self.known = known
        self.settled: set[str] = set()
        self.before: set[str] = set()  # words settled earlier, next to be forgotten
        self.vectors: dict[str, np.ndarray] = {}  # of the settled words with a value of floor or more
        self.maybe = np.zeros(1 << 18, bool)
        self.maybe[self._slot(self.codes)] = True

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)

    def values(self, words: list[str], chunk: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        """(indices of words with a value of ``floor`` or more, their values).

        No kernel value of a word exceeds the sum over its triples of weight
        times the greatest weight that any landmark gives the triple, so most
        words are settled without a product."""
        p = self.p
        text = "".join(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        if not len(self.codes) or not text:
            return np.zeros(0, np.int64), np.zeros((0, len(self.words)), np.float32)
        c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        word = np.repeat(np.arange(len(words)), size)
        left = np.repeat(np.cumsum(size), size) - np.arange(len(c))  # letters to the end of the word
        whole = np.zeros(len(words))
        hit_w: list[np.ndarray] = []
        hit_k: list[np.ndarray] = []
        hit_v: list[np.ndarray] = []
        for a, b, w in offsets(p):
            at = np.flatnonzero(left > b)
            if not len(at):
                continue
            owner = word[at]
            whole += np.bincount(owner, minlength=len(words)) * (w * w)
            code = c[at] << np.uint64(42) | c[at + a] << np.uint64(21) | c[at + b]
            some = np.flatnonzero(self.maybe[self._slot(code)])
            code, owner = code[some], owner[some]
            k = np.searchsorted(self.codes, code).clip(max=len(self.codes) - 1)
            same = self.codes[k] == code
            hit_w.append(owner[same])
            hit_k.append(k[same])
            hit_v.append(np.full(int(same.sum()), w))
        if not hit_w:
            return np.zeros(0, np.int64), np.zeros((0, len(self.words)), np.float32)
        ow, ok, ov = np.concatenate(hit_w), np.concatenate(hit_k), np.concatenate(hit_v)
        bound = np.bincount(ow, ov * self.most[ok], minlength=len(words))
        left_over = np.flatnonzero(bound >= (p.floor - 1e-6) * np.sqrt(whole))
        left_over = left_over[whole[left_over] > 0]
        place = np.full(len(words), -1)
        place[left_over] = np.arange(len(left_over))
        pick = place[ow] >= 0
        ow, ok, ov = place[ow[pick]], ok[pick], ov[pick]
        order = np.argsort(ow, kind="stable")
        ow, ok, ov = ow[order], ok[order], ov[order]
        norm = np.sqrt(whole[left_over]).astype(np.float32)
        kept, rows = [], []
        first = np.searchsorted(ow, np.arange(len(left_over) + 1))
        ov = ov.astype(np.float32)
        for at in range(0, len(left_over), chunk):  # sums of landmark rows, by word
            end = min(at + chunk, len(left_over))
            lo, hi, head = first[at], first[end], first[at:end] - first[at]
            v = np.add.reduceat(self.coarse[ok[lo:hi]] * ov[lo:hi, None], head)
            good = at + np.flatnonzero(v.max(1) >= (p.floor - 1e-4) * norm[at:end])
            if not len(good):
                continue
            size = first[good + 1] - first[good]
            some = np.repeat(first[good] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            v = np.add.reduceat(self.matrix[ok[some]] * ov[some, None], np.cumsum(size) - size)
            v = np.minimum(v / norm[good, None], 1.0)
            best = v.max(1) >= p.floor
            kept.append(left_over[good[best]])
            v = v[best]
            v[v < p.floor] = 0
            rows.append(v)
        if not kept:
            return np.zeros(0, np.int64), np.zeros((0, len(self.words)), np.float32)
        return np.concatenate(kept), np.concatenate(rows)

    def features(self, texts: list[str | None], piece: int = 2_000_000) -> np.ndarray:
        """One row per text: its best value against each landmark.  Texts are
        taken up to ``piece`` characters at a time; words settled before are
        remembered, up to ``known`` of them, the later half if more come."""
        out = np.zeros((len(texts), len(self.words)), np.float32)
        at = 0
        while at < len(texts):
            size, end = 0, at
            while end < len(texts) and (end == at or size + len(texts[end] or "") <= piece):
                size += len(texts[end] or "")
                end += 1
            each = [units(t, self.p.unit) if t else set() for t in texts[at:end]]
            new = list(set().union(*each).difference(self.settled, self.before))
            if len(self.settled) + len(new) > self.known // 2:
                self.before, self.settled = self.settled, set()
                self.vectors = {u: v for u, v in self.vectors.items() if u in self.before}
                new = list(set().union(*each).difference(self.before))
            self.settled.update(new)
            hits, v = self.values([clean(u) for u in new])
            self.vectors.update((new[k], row) for k, row in zip(hits.tolist(), v))
            for o, found in zip(out[at:end], each):
                for u in filter(self.vectors.__contains__, found):
                    np.maximum(o, self.vectors[u], out=o)
            at = end
        return out


@dataclass
class Model:
    land: Landmarks
    root: np.ndarray
    weights: np.ndarray
    scale: tuple[float, float]

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(texts))
        f = self.land.features(texts) @ self.root
        m = f @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * m + self.scale[1], -30, 30)))


def train_svm(z: np.ndarray, y: np.ndarray, cost: float, steps: int = 30) -> np.ndarray:
    """Primal squared-hinge support vector machine by Newton steps; ``y`` +-1."""
    x = np.hstack([z, np.ones((len(z), 1))])
    weight = np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y < 0).sum())) * len(y) / 2 * cost
    w = np.zeros(x.shape[1])
    reg = np.eye(x.shape[1])
    reg[-1, -1] = 1e-6
    for _ in range(steps):
        active = y * (x @ w) < 1
        xa = x[active] * weight[active, None]
        new = np.linalg.solve(reg + x[active].T @ xa, xa.T @ y[active])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w


def calibrate(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Logistic curve through the margins, with smoothed targets."""
    pos, neg = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([margin, np.ones_like(margin)], 1)
    b = np.array([1.0, 0.0])
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (q - t))
        b = b - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1])


def may_learn() -> Column:
    return F.coalesce(fraction_class("doc_id", 3) != 1, F.lit(False))


def learnable(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, _toxic) of the labelled rows to learn from; an id with
    several labels is toxic if one of them says so."""
    known = (labels.where(may_learn() & F.col("toxic").isNotNull())
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("_toxic")))
    return docs.select("doc_id", "text").where(F.col("text").isNotNull() & may_learn()).join(small(staged(known)), "doc_id")


def landmark_words(rows: DataFrame, p: Params) -> list[str]:
    """The words whose documents are most often toxic, by documents, counted
    over all learnable rows with partial sums."""
    words = F.transform(F.split(F.lower("text"), r"\s+"), lambda w: F.regexp_replace(w, r"[^\p{L}]+", ""))
    counts = (rows.select("_toxic", F.explode(F.array_distinct(words)).alias("_word"))
              .where(F.length("_word").between(3, p.unit))
              .groupBy("_word").agg(F.sum(F.col("_toxic")).alias("_bad"), F.count("*").alias("_all"))
              .where(F.col("_bad") >= p.least_docs))
    total = rows.agg(F.sum("_toxic"), F.count("*")).first()
    bad, fine = total[0] or 0, (total[1] or 0) - (total[0] or 0)
    if not bad or not fine:
        return []
    odds = ((F.col("_bad") + 0.5) / F.lit(bad + 1.0)) / ((F.col("_all") - F.col("_bad") + 0.5) / F.lit(fine + 1.0))
    best = (counts.withColumn("_odds", odds).where(F.col("_odds") >= p.least_odds)
            .orderBy(F.desc(F.col("_bad") * F.log("_odds")), "_word").limit(p.landmarks).collect())
    return [r["_word"] for r in best]


def fit(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> Model:
    rows = staged(learnable(docs, labels))
    land = Landmarks(landmark_words(rows, p), p)
    none = Model(land, np.zeros((0, 0)), None, (1.0, 0.0))
    if not land.words:
        return none
    known = rows.groupBy("doc_id").agg(F.max("_toxic").alias("_label"))
    sample, _ = sampled(rows, known, p.rows)
    shared = docs.sparkSession.sparkContext.broadcast(land)

    def featurise(batches):
        for b in batches:
            f = shared.value.features(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in f], pa.binary())], names=["y", "f"])

    got = sample.select(F.col("_label").alias("y"), "text").mapInArrow(tidy(featurise), "y int, f binary").collect()
    if not got:
        return none
    f = np.stack([np.frombuffer(r["f"], np.float32) for r in got]).astype(np.float64)
    y = np.where(np.array([r["y"] for r in got]) > 0, 1.0, -1.0)
    order_rows = np.lexsort(np.vstack([f.T, y]))
    f, y = f[order_rows], y[order_rows]
    if (y > 0).all() or (y < 0).all():
        return none
    kmm = land.matrix.T.astype(np.float64) @ land.matrix
    values, vectors = np.linalg.eigh(kmm)
    keep = values > 1e-3 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    w = train_svm(f @ root, y, p.cost)
    return Model(land, root, w, calibrate(f @ root @ w[:-1] + w[-1], y))


def score(docs: DataFrame, model: Model, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """``id_cols`` and the score of every whole text, row by row; a null or
    empty text has the score of a text without words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        n = len(id_cols)
        for b in batches:
            s = m.score(b.column(n).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(n)] + [pa.array(s.astype(np.float64))],
                                             names=id_cols + ["score"])

    src = bounded_batches(docs.select(*id_cols, text_col))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return src.mapInArrow(tidy(run), f"{schema}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, p: Params = Params(), limit: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    Labels are learnt only from rows that are not held out.  Without labels of
    both kinds every score is 0.  Null ids are neither held out nor learnt
    from; repeated rows are scored each; empty tables give no rows; other
    columns are ignored."""
    out = score(docs, fit(docs, labels, p), ["doc_id"])
    held = F.coalesce(fraction_class("doc_id", 3) == 1, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))
