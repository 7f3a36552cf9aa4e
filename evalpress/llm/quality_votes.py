"""Quality by nearest neighbours in a latent-semantic space.

A text's terms are its words, the shapes of its characters and how much of it
repeats.  A bounded sample of labelled texts spans the space (truncated singular
value decomposition of the weighted term matrix); their vectors are broadcast,
every text's cosines with all of them are computed in blocks, and its nearest
neighbours vote with their similarity.
"""
from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalpress.llm.common import bounded_batches, fraction_class, sampled, staged, tidy


@dataclass(frozen=True)
class Params:
    """``rows``: labelled texts of a label at most (the fitting sample, drawn by
    a hash of the id); ``rank``: dimensions; ``near``: voting neighbours, ties
    included; ``power``: exponent of a similarity as weight; ``slots``: hashed
    words; ``block``: texts whose cosines are computed at once; ``piece``: bytes
    looked at in one go (a longer text is counted piece by piece)."""

    rows: int = 3000
    rank: int = 64
    near: int = 9
    power: float = 16.0
    slots: int = 1024
    block: int = 256
    piece: int = 2_000_000


#: classes of bytes: letters, digits, blanks, line feeds, and marks by use
CLASSES = ("lower", "upper", "digit", "blank", "line", "stop", "comma", "call", "quote", "symbol", "other", "wide")
N = len(CLASSES)
LEVELS = 9  # terms that a share or a size is spread over


def _class_table() -> np.ndarray:
    out = np.full(256, CLASSES.index("other"), np.int64)
    for name, chars in (("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)), ("blank", b" \t\r\x0b\x0c"),
                        ("line", b"\n"), ("stop", b"."), ("comma", b",;:"), ("call", b"!?"), ("quote", b"'\"()-"),
                        ("symbol", b"#*$%&|<>@^_=+~/\\{}[]"), ("wide", range(128, 256))):
        out[list(chars)] = CLASSES.index(name)
    return out


CLASS_OF = _class_table()
#: (name, terms) of the groups of terms that do not depend on the parameters
GROUPS = [("pairs", N * N), ("shapes", N ** 3), ("lengths", 24), ("echo", LEVELS), ("again", LEVELS), ("variety", LEVELS),
          ("lines", LEVELS), ("size", 2 * LEVELS)]
#: weight of each group: those of repetition and shape tell quality, words tell the language
WEIGHT = {"pairs": 1.0, "shapes": 1.0, "lengths": 0.7, "echo": 1.0, "again": 1.0, "variety": 1.0, "lines": 1.0, "size": 0.5, "words": 0.3}


def levels(share: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number from 0 to 1 as weights of two neighbouring terms out of ``top``."""
    x = np.clip(share, 0, 1) * (top - 1)
    low = np.minimum(x.astype(np.int64), top - 2)
    return low, 1 - (x - low), x - low


def group_of(n: int, size: int, doc: np.ndarray, term: np.ndarray) -> np.ndarray:
    return roots(np.bincount(doc * size + term, minlength=n * size).reshape(n, size))


def roots(counts: np.ndarray) -> np.ndarray:
    """Square roots of the terms' shares in each text: rows of length 1 or 0."""
    total = counts.sum(1, keepdims=True)
    return np.sqrt(counts / np.maximum(total, 1)).astype(np.float32)


def shape_counts(texts: list[bytes], piece: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of neighbouring classes, and triples where a run of one class is
    one place, counted per text, ``piece`` bytes at a time."""
    n = len(texts)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, n))
    starts = np.concatenate([[0], ends[:-1]]) if n else ends
    pairs, shapes = np.zeros(n * N * N, np.int64), np.zeros(n * N ** 3, np.int64)
    k_last, d_last = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for at in range(0, len(raw), piece):
        lo, hi = max(0, at - 1), min(at + piece, len(raw))  # one byte again, for the pair across the border
        kind = CLASS_OF[raw[lo:hi]]
        doc = np.repeat(np.arange(n), np.clip(ends, lo, hi) - np.clip(starts, lo, hi))
        inner = doc[1:] == doc[:-1]
        pairs += np.bincount((doc[1:] * N * N + kind[:-1] * N + kind[1:])[inner], minlength=len(pairs))
        step = np.ones(len(kind), bool)
        step[1:] = ~inner | (kind[1:] != kind[:-1])
        step[0] = at == 0
        k, d = np.concatenate([k_last, kind[step]]), np.concatenate([d_last, doc[step]])
        inside = d[2:] == d[:-2]
        shapes += np.bincount((d[2:] * N ** 3 + (k[:-2] * N + k[1:-1]) * N + k[2:])[inside], minlength=len(shapes))
        k_last, d_last = k[-2:], d[-2:]
    return pairs.reshape(n, -1), shapes.reshape(n, -1)


def word_lists(text: bytes, piece: int) -> Iterator[list[bytes]]:
    """The words of a text, cut between words every ``piece`` bytes or so."""
    at = 0
    while len(text) - at > piece:
        gap = GAP.search(text, at + piece)
        if gap is None:
            break
        yield text[at:gap.start()].split()
        at = gap.start()
    yield text[at:].split()


GAP = re.compile(rb"[ \t\n\x0b\x0c\r]")


def repeats(n: int, doc: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Share of each text's codes that stand in it more than once."""
    order = np.lexsort((code, doc))
    d, c = doc[order], code[order]
    same = (d[1:] == d[:-1]) & (c[1:] == c[:-1])
    twice = np.zeros(len(d), bool)
    twice[1:] |= same
    twice[:-1] |= same
    return np.bincount(d, twice, minlength=n) / np.maximum(np.bincount(d, minlength=n), 1)


class Terms:
    """Term weights of texts, one row each; every text is read whole."""

    def __init__(self, p: Params, known: int = 500_000):
        self.p, self.known = p, known
        self.numbers: dict[bytes, int] = {}
        self.slots: list[int] = []
        self.size = sum(s for _, s in GROUPS) + p.slots

    def number(self, word: bytes) -> int:
        at = self.numbers.get(word)
        if at is None:
            at = self.numbers[word] = len(self.slots)
            self.slots.append(zlib.crc32(word.lower()) % self.p.slots)
        return at

    def matrix(self, texts: list[bytes]) -> np.ndarray:
        n = len(texts)
        if len(self.numbers) > self.known:
            self.numbers, self.slots = {}, []
        pairs, shapes = shape_counts(texts, self.p.piece)
        parts = {"pairs": roots(pairs), "shapes": roots(shapes)}
        number, each = self.number, []
        for t in texts:
            some = [np.stack([np.fromiter(map(f, ws), np.int64, len(ws)) for f in (number, len)]) for ws in word_lists(t, self.p.piece)]
            each.append(some[0] if len(some) == 1 else np.hstack(some))
        count = np.fromiter((x.shape[1] for x in each), np.int64, n)
        wdoc = np.repeat(np.arange(n), count)
        word, length = np.hstack(each) if each else np.zeros((2, 0), np.int64)
        parts["lengths"] = group_of(n, 24, wdoc, np.minimum(length, 23))
        parts["words"] = group_of(n, self.p.slots, wdoc, np.array(self.slots, np.int64)[word] if len(word) else word)
        much = np.maximum(count, 1)
        echo = np.bincount(wdoc[1:], (word[1:] == word[:-1]) & (wdoc[1:] == wdoc[:-1]), minlength=n) / much
        whole = wdoc[2:] == wdoc[:-2]
        w = word.astype(np.uint64)
        three = ((w[:-2] * np.uint64(0x9E3779B97F4A7C15) + w[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + w[2:])[whole]
        again = repeats(n, wdoc[2:][whole], three)
        order = np.lexsort((word, wdoc))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (word[order][1:] != word[order][:-1]) | (wdoc[order][1:] != wdoc[order][:-1])
        different = np.bincount(wdoc[order], fresh, minlength=n)
        # words of a long text recur anyway: different words against a power of all words
        variety = different / much ** 0.9
        lines = [[hash(x) for x in t.split(b"\n") if x.strip()] for t in texts]
        ldoc = np.repeat(np.arange(n), np.fromiter(map(len, lines), np.int64, n))
        twin = repeats(n, ldoc, np.fromiter((x for ls in lines for x in ls), np.int64, len(ldoc)))
        for name, share, top in (("echo", np.sqrt(echo), LEVELS), ("again", np.sqrt(again), LEVELS), ("variety", variety, LEVELS),
                                 ("lines", np.sqrt(twin), LEVELS), ("size", np.log2(count + 1) / 20, 2 * LEVELS)):
            low, a, b = levels(share, top)
            x = np.zeros((n, top), np.float32)
            x[np.arange(n), low], x[np.arange(n), low + 1] = np.sqrt(a), np.sqrt(b)
            parts[name] = x
        names = [g for g, _ in GROUPS] + ["words"]
        return np.hstack([parts[g] * WEIGHT[g] for g in names]).astype(np.float32)

    def blocks(self, texts: list[bytes]) -> Iterator[tuple[slice, np.ndarray]]:
        """Matrices of up to ``block`` texts and ``piece`` bytes (or one text)."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and end - at < self.p.block and (end == at or size + len(texts[end]) <= self.p.piece):
                size += len(texts[end])
                end += 1
            yield slice(at, end), self.matrix(texts[at:end])
            at = end


@dataclass
class Model:
    """``basis``: weighted terms to latent dimensions; ``vectors``: the labelled
    texts, of length 1; ``label``: 0 or 1; ``share``: the weight of a vote of
    each, so that both labels vote by their share of all labelled rows."""

    p: Params
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    label: np.ndarray
    share: np.ndarray
    rate: float

    def latent(self, terms: np.ndarray) -> np.ndarray:
        v = (terms * self.idf) @ self.basis
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    def score(self, terms: np.ndarray) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(terms), self.rate)
        near = self.latent(terms) @ self.vectors.T
        k = min(self.p.near, near.shape[1])
        least = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
        row, col = np.nonzero(near >= least[:, None] - 1e-6)
        vote = np.maximum(near[row, col], 0).astype(np.float64) ** self.p.power * self.share[col]
        all_votes = np.bincount(row, vote, minlength=len(near))
        good = np.bincount(row, vote * self.label[col], minlength=len(near))
        return np.clip(np.where(all_votes > 0, good / np.maximum(all_votes, 1e-300), self.rate), 0, 1)


def singular_basis(x: np.ndarray, rank: int, seed: int = 7, rounds: int = 4) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration."""
    rank = min(rank, *x.shape)
    q = np.random.default_rng(seed).standard_normal((x.shape[1], min(rank + 16, *x.shape))).astype(x.dtype)
    for _ in range(rounds):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    return q @ v[:rank].T


def train(terms: np.ndarray, label: np.ndarray, rate: float, p: Params) -> Model:
    """``rate``: share of label 1 among all rows that may be learnt from."""
    n = len(terms)
    idf = (np.log((1 + n) / (1 + (terms > 0).sum(0))) + 1).astype(np.float32)
    x = terms * idf
    basis = singular_basis(x, p.rank) if n else np.zeros((terms.shape[1], 0), np.float32)
    good = max(1, int(label.sum()))
    share = np.where(label > 0, rate / good, (1 - rate) / max(1, n - good))
    m = Model(p, idf, basis.astype(np.float32), np.zeros((0, basis.shape[1]), np.float32), label.astype(np.float64), share, rate)
    m.vectors = m.latent(terms).astype(np.float32)
    return m


def may_learn() -> Column:
    return F.coalesce(fraction_class("doc_id", 5) != 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> Model:
    known = (labels.where(may_learn() & F.col("quality").isNotNull())
             .groupBy("doc_id").agg(F.max((F.col("quality") > 0).cast("int")).alias("_label")))
    texts, counts = sampled(docs.where(may_learn()), staged(known), p.rows)
    total = sum(counts.values())
    rate = counts.get(1, 0) / total if total else 0.5

    def terms(batches):
        t = Terms(p)
        for b in batches:
            for part, x in t.blocks([v or b"" for v in b.column(1).cast(pa.binary()).to_pylist()]):
                at = [np.flatnonzero(r).astype(np.uint32) for r in x]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(part.start, part.stop - part.start), pa.array([a.tobytes() for a in at], pa.binary()),
                     pa.array([r[a].tobytes() for r, a in zip(x, at)], pa.binary())], names=["y", "at", "v"])

    got = texts.select(F.col("_label").alias("y"), "text").mapInArrow(tidy(terms), "y int, at binary, v binary").collect()
    got.sort(key=lambda r: (r["y"], bytes(r["at"]), bytes(r["v"])))
    x = np.zeros((len(got), Terms(p).size), np.float32)
    for row, r in zip(x, got):
        row[np.frombuffer(r["at"], np.uint32)] = np.frombuffer(r["v"], np.float32)
    return train(x, np.array([r["y"] for r in got], np.int64), rate, p)


def score(docs: DataFrame, model: Model, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """``id_cols`` and the score of every whole text, row by row; a null text
    counts as an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m, n = shared.value, len(id_cols)
        t = Terms(m.p)
        for b in batches:
            texts = [v or b"" for v in b.column(n).cast(pa.binary()).to_pylist()]
            s = np.concatenate([m.score(x) for _, x in t.blocks(texts)]) if texts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(n)] + [pa.array(s.astype(np.float64))],
                                             names=id_cols + ["score"])

    src = bounded_batches(docs.select(*id_cols, text_col))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return src.mapInArrow(tidy(run), f"{schema}, score double")


def quality(docs: DataFrame, labels: DataFrame, p: Params = Params(), limit: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    Labels are learnt only from rows that are not held out, an id with several
    labels counts as 1 if one of them does.  Without labelled texts every score
    is 0.5, with one label only it is 0 or 1.  Null ids are neither held out nor
    learnt from; repeated rows are scored each; empty tables give no rows; other
    columns are ignored."""
    out = score(docs, fit(docs, labels, p), ["doc_id"])
    held = F.coalesce(fraction_class("doc_id", 5) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))

