"""Exact substring dedup by difference-cover suffix sorting.

Every text is covered by windows of ``length`` bytes.  The least hash of the
grams in a window is the window's anchor; equal windows have equal anchors, so
anchors deal the work out and most of it is settled early:

1. Runs of windows with one anchor form a block.  A block that is the only one
   of its anchor holds no repeat; a block equal to an earlier one repeats as a
   whole.  Both are settled by one shuffle of block hashes.
2. The bytes of the other blocks go to the task of their anchor, which sorts
   their suffixes: ranks of sampled triples (positions 1 and 2 modulo 3), names
   sorted by recursion, the remaining suffixes merged in; windows with equal
   prefixes are then neighbours, and all but the earliest are removed.
3. The removed windows return to their texts.

An anchor with very many different blocks (a common line in ever new
surroundings) would make one task hot; its windows are instead dealt out by a
hash of their bytes, so each task still sees all copies of a window.  Such an
anchor is found in a batch by its number of blocks, and over all batches by the
bytes of its different blocks.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalpress.llm.common import NULL_ID, bounded_batches, shuffle_parts, small, staged, tidy

U = np.uint64
GRAM = 27  # three levels of triples


@dataclass(frozen=True)
class Params:
    """``length`` bytes of a repeat (at least 40); ``hot``: different blocks of
    an anchor in one batch from which its windows are dealt out by their own
    bytes.  An anchor whose different blocks have more than ``batch`` bytes over
    all batches is dealt out by window too.  Memory only: ``piece`` bytes are
    hashed and ``batch`` bytes sorted at once, ``send`` bytes are held before
    they leave, and a task gets the blocks of ``share`` bytes of text."""

    length: int = 100
    hot: int = 256
    piece: int = 1 << 18
    batch: int = 1 << 18
    send: int = 8 << 20
    share: int = 16 << 20


# ---------------------------------------------------------------- anchors

def triple_names(text: np.ndarray, levels: int) -> np.ndarray:
    """Hash names of the 3^levels bytes from every position, by triples of
    triples; one vector step per level."""
    h = text.astype(U) * U(0x9E3779B97F4A7C15) + U(12345)
    width = 1
    for _ in range(levels):
        n = max(0, len(h) - 2 * width)
        h = (h[:n] * U(0xBF58476D1CE4E5B9) + h[width:width + n]) * U(0x94D049BB133111EB) + h[2 * width:2 * width + n]
        h ^= h >> U(32)
        width *= 3
    h *= U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


def sliding(values: np.ndarray, width: int, op: np.ufunc, fill: int) -> np.ndarray:
    """``op`` over every full stretch of ``width`` values, by block prefixes
    and suffixes."""
    n = len(values)
    if n < width:
        return values[:0]
    x = np.concatenate([values, np.full(-n % width, fill, values.dtype)]).reshape(-1, width)
    head = op.accumulate(x, 1).ravel()
    tail = op.accumulate(x[:, ::-1], 1)[:, ::-1].ravel()
    return op(tail[:n - width + 1], head[width - 1:n])


@dataclass
class Blocks:
    """Runs of windows with one anchor: text number, first window, windows,
    anchor, hash of the covered bytes, whether the anchor's gram occurs twice
    in reach (then a block can repeat within itself)."""

    doc: np.ndarray
    at: np.ndarray
    n: np.ndarray
    anchor: np.ndarray
    hash: np.ndarray
    twice: np.ndarray


def pieces(texts: list[bytes], most: int) -> Iterator[tuple[list[int], bytes]]:
    """Texts joined up to ``most`` bytes; a longer one stands alone."""
    own: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        if own and size + len(t) > most:
            yield own, b"".join(texts[k] for k in own)
            own, size = [], 0
        own.append(i)
        size += len(t)
    if own:
        yield own, b"".join(texts[k] for k in own)


def blocks_of(texts: list[bytes], p: Params) -> Blocks:
    out: list[list[np.ndarray]] = []
    reach = p.length - GRAM + 1
    for own, joined in pieces(texts, p.piece):
        grams = triple_names(np.frombuffer(joined, np.uint8), 3)
        least = sliding(grams, reach, np.minimum, 2 ** 64 - 1)
        if not len(least):
            continue
        ends = np.cumsum([len(texts[k]) for k in own])
        doc_of = np.repeat(np.arange(len(own)), [len(texts[k]) for k in own])[:len(least)]
        inside = np.arange(len(least)) + p.length <= ends[doc_of]
        first = inside & np.concatenate([[True], (least[1:] != least[:-1]) | (doc_of[1:] != doc_of[:-1]) | ~inside[:-1]])
        at = np.flatnonzero(first)
        if not len(at):
            continue
        border = np.flatnonzero(first | ~inside)
        nxt = np.searchsorted(border, at, side="right")
        stop = np.where(nxt < len(border), border[np.minimum(nxt, len(border) - 1)], len(least))
        chosen = np.flatnonzero(grams == sliding(
            np.concatenate([np.zeros(reach - 1, U), least, np.zeros(reach - 1, U)]), reach, np.maximum, 0)[:len(grams)])
        order = np.lexsort((chosen, grams[chosen]))
        c = chosen[order]
        close = (grams[c[1:]] == grams[c[:-1]]) & (c[1:] - c[:-1] <= p.length)
        repeated = np.unique(grams[c[:-1][close]])
        start = (ends - [len(texts[k]) for k in own])[doc_of[at]]
        hashes = np.array([xxhash.xxh3_64_intdigest(joined[s:e]) for s, e in zip(at.tolist(), (stop - 1 + p.length).tolist())], U)
        v = least[at]
        out.append([np.array(own)[doc_of[at]], at - start, stop - at, v, hashes, np.isin(v, repeated)])
    if not out:
        z = np.zeros(0, np.int64)
        return Blocks(z, z, z, z.astype(U), z.astype(U), z.astype(bool))
    return Blocks(*[np.concatenate(x) for x in zip(*out)])


# ---------------------------------------------------------------- suffix order

def packed(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Triples as integers of the same order."""
    mb, mc = int(b.max(initial=0)) + 1, int(c.max(initial=0)) + 1
    if (int(a.max(initial=0)) + 1) * mb * mc < 1 << 63:
        return (a * mb + b) * mc + c
    pair = np.unique(a * mb + b, return_inverse=True)[1].astype(np.int64)  # fewer than 2^31 letters
    return pair * mc + c


def suffix_ranks(t: np.ndarray, need: int) -> np.ndarray:
    """Ranks 1..n of the suffixes of ``t`` (letters from 1), right for the
    first ``need`` letters; suffixes alike in those are in any order."""
    n = len(t)
    rank = np.empty(n, np.int64)
    if need <= 1 or n < 4:
        if n < 4 and need > 1:
            order = np.array(sorted(range(n), key=lambda i: t[i:].tolist()), np.int64)
        else:
            order = np.argsort(t, kind="stable")
        rank[order] = np.arange(1, n + 1)
        return rank
    x = np.concatenate([t, np.zeros(3, np.int64)])
    one = np.arange(1, n + (n % 3 == 1), 3)
    two = np.arange(2, n, 3)
    both = np.concatenate([one, two])
    names = np.unique(packed(x[both], x[both + 1], x[both + 2]), return_inverse=True)[1].astype(np.int64) + 1
    own = names if int(names.max()) == len(names) else suffix_ranks(names, -(-need // 3) + 1)
    order12 = np.empty(len(both), np.int64)
    order12[own - 1] = both
    r = np.zeros(n + 4, np.int64)
    r[both] = own
    zero = np.arange(0, n, 3)
    wide = len(both) + 1
    key = x[zero] * wide + r[zero + 1]
    turn = np.argsort(key, kind="stable")
    zero, key = zero[turn], key[turn]
    before = np.searchsorted(np.sort(x[one] * wide + r[one + 1]), key)
    if len(two):
        mixed = packed(np.concatenate([x[two], x[zero]]), np.concatenate([x[two + 1], x[zero + 1]]),
                       np.concatenate([r[two + 2], r[zero + 2]]))
        before = before + np.searchsorted(np.sort(mixed[:len(two)]), mixed[len(two):])
    place = np.arange(len(zero)) + np.maximum.accumulate(before)
    merged = np.empty(len(zero) + len(both), np.int64)
    rest = np.ones(len(merged), bool)
    rest[place] = False
    merged[place], merged[rest] = zero, order12
    merged = merged[merged < n]
    rank[merged] = np.arange(1, n + 1)
    return rank


def same_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` bytes from a[k] and b[k] are equal."""
    x = np.concatenate([text, np.zeros(8, np.uint8)])
    word = np.zeros(len(text) + 1, U)
    for k in range(8):
        word |= x[k:k + len(word)].astype(U) << U(8 * k)
    left = np.arange(len(a))
    for k in [*range(0, length - 7, 8), length - 8]:
        left = left[word[a[left] + k] == word[b[left] + k]]
    out = np.zeros(len(a), bool)
    out[left] = True
    return out


def later_windows(datas: list[bytes], n: np.ndarray, length: int) -> np.ndarray:
    """For blocks in order of their texts: whether each of their windows, one
    block after the other, equals an earlier one.  Suffix order makes equal
    windows neighbours."""
    text = np.frombuffer(b"".join(datas), np.uint8)
    size = np.array([len(d) for d in datas], np.int64)
    offset = np.cumsum(size) - size
    total = int(n.sum())
    block = np.repeat(np.arange(len(n)), n)
    window = offset[block] + np.arange(total) - np.repeat(np.cumsum(n) - n, n)
    rank = suffix_ranks(text.astype(np.int64) + 1, length).astype(np.int32 if len(text) < 1 << 31 else np.int64)
    order = np.argsort(rank[window], kind="stable")
    sorted_window = window[order]
    equal = same_prefix(text, sorted_window[:-1], sorted_window[1:], length)
    starts = np.flatnonzero(np.concatenate([[True], ~equal]))
    earliest = np.repeat(np.minimum.reduceat(order, starts), np.diff(np.append(starts, total)))
    later = np.empty(total, bool)
    later[order] = order != earliest
    return later


# ---------------------------------------------------------------- rows between tasks

#: every row of a shuffle: where it goes, what it is, and packed columns
ROW = "part int, kind int, a binary, b binary, c binary, d binary, e binary, f binary, g binary"
NAMES = ["part", "kind", "a", "b", "c", "d", "e", "f", "g"]
SETTLED, BY_ANCHOR, BY_WINDOW = 0, 1, 2
BLOCK, HOT_MARK, PASS, TEXT, WINDOW, DATA = 3, 4, 5, 6, 7, 8


def rows_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*[r + (b"",) * (len(NAMES) - len(r)) for r in rows])) if rows else [()] * len(NAMES)
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32())] + [pa.array(c, pa.binary()) for c in cols[2:]], names=NAMES)


def dealt(part: np.ndarray, kind: int, *cols: np.ndarray) -> Iterator[tuple]:
    """One row per target with the packed columns of its entries."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    cols = tuple(c[order] for c in cols)
    for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(part)]):
        yield (int(part[s]), kind, *[c[s:e].tobytes() for c in cols])


def unpacked(rows: Iterable[tuple], *kinds: type) -> list[np.ndarray]:
    """The columns of such rows, put together."""
    rows = list(rows)
    return [np.frombuffer(b"".join(r[k] for r in rows), kind) for k, kind in enumerate(kinds)]


def target(hash: np.ndarray, parts: int) -> np.ndarray:
    return ((hash.astype(U) * U(0x9E3779B97F4A7C15) >> U(20)) % U(parts)).astype(np.int32)


def home(ids: np.ndarray, hashes: np.ndarray, parts: int) -> np.ndarray:
    """The task of a text."""
    return target(ids.astype(np.int64).view(U) * U(31) ^ hashes.astype(np.int64).view(U), parts)


def table_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns])


def firsts(*keys: np.ndarray) -> np.ndarray:
    """Marks the first row of each run of equal keys (already sorted)."""
    out = np.zeros(len(keys[0]), bool)
    if len(out):
        out[0] = True
        for k in keys:
            out[1:] |= k[1:] != k[:-1]
    return out


def find_blocks(p: Params, parts: int):
    """Texts to block records.  Copies of a block within a batch are settled
    here, and blocks of a hot anchor pass through spread out, so no anchor can
    send more than ``hot`` blocks per batch to its task."""

    def run(batches):
        for b in batches:
            ids, hs = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            x = blocks_of([t or b"" for t in b.column(2).cast(pa.binary()).to_pylist()], p)
            ids, hs = ids[x.doc], hs[x.doc]
            order = np.lexsort((x.at, hs, ids, x.hash, x.anchor))
            ids, hs, at, n, v, h, twice = (c[order] for c in (ids, hs, x.at, x.n, x.anchor, x.hash, x.twice))
            new_ref = firsts(v, h, ids, hs, at)
            ids, hs, at, n, v, h, twice = (c[new_ref] for c in (ids, hs, at, n, v, h, twice))
            lead = firsts(v, h)
            group = np.cumsum(firsts(v)) - 1
            hot = (np.bincount(group, lead, minlength=group[-1] + 1 if len(group) else 0) >= p.hot)[group]
            out: list[tuple] = []
            col = lambda m, *c: [k[m] for k in c]
            spread = home(ids, hs, parts)
            for mask, flag in ((~lead, SETTLED), (lead & hot, BY_WINDOW)):
                out += dealt(spread[mask], PASS, *col(mask, ids, hs, at, n), np.full(int(mask.sum()), flag, np.int8), v[mask])
            m = lead & ~hot
            out += dealt(target(v[m], parts), BLOCK, *col(m, ids, hs, at, n), twice[m].astype(np.int8), v[m], h[m])
            mark = np.unique(v[hot])
            out += dealt(target(mark, parts), HOT_MARK, mark)
            yield rows_batch(out)

    return run


def settle(p: Params, parts: int):
    """Block records of an anchor to states: equal to an earlier block, alone
    (left out), or still open.  Open blocks of an anchor go to one task only if
    all of them fit into a batch."""

    def run(batches):
        rows = list(table_rows(batches))
        out = [(r[0], SETTLED, *r[2:8]) for r in rows if r[1] == PASS]
        hot = unpacked((r[2:3] for r in rows if r[1] == HOT_MARK), U)[0]
        ids, hs, at, n, twice, v, h = unpacked((r[2:9] for r in rows if r[1] == BLOCK), np.int64, np.int64, np.int64, np.int64, np.int8, U, U)
        order = np.lexsort((at, hs, ids, h, v))
        ids, hs, at, n, twice, v, h = (c[order] for c in (ids, hs, at, n, twice, v, h))
        new = firsts(v, h, ids, hs, at)
        ids, hs, at, n, twice, v, h = (c[new] for c in (ids, hs, at, n, twice, v, h))
        lead = firsts(v, h)
        group = np.cumsum(firsts(v)) - 1
        different = np.bincount(group, lead, minlength=group[-1] + 1 if len(group) else 0)[group]
        size = np.bincount(group, lead * (n + p.length - 1), minlength=group[-1] + 1 if len(group) else 0)[group]
        in_hot = np.isin(v, hot) | (different > 1) & (size > p.batch)
        state = np.where(~lead, SETTLED, np.where(in_hot, BY_WINDOW, BY_ANCHOR)).astype(np.int8)
        told = ~lead | in_hot | (different > 1) | (twice > 0)
        ids, hs, at, n, state, v = (c[told] for c in (ids, hs, at, n, state, v))
        out += dealt(home(ids, hs, parts), SETTLED, ids, hs, at, n, state, v)
        yield rows_batch(out)

    return run


def send_texts(parts: int):
    """Texts, compressed, to their tasks."""

    def run(batches):
        comp = zstandard.ZstdCompressor(level=1)
        for b in batches:
            ids, hs = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            to = home(ids, hs, parts)
            yield rows_batch([(int(q), TEXT, int(i).to_bytes(8, "little", signed=True), int(h).to_bytes(8, "little", signed=True),
                               comp.compress(t or b""), *more) for q, i, h, t, *more in
                              zip(to, ids, hs, b.column(2).cast(pa.binary()).to_pylist(),
                                  *[b.column(k).to_pylist() for k in range(3, b.num_columns)])])

    return run


class Marks:
    """Entries (text, first window, windows, state, anchor) by text."""

    def __init__(self, rows: list[tuple]):
        ids, hs, at, n, state, v = unpacked(rows, np.int64, np.int64, np.int64, np.int64, np.int8, U)
        order = np.lexsort((at, hs, ids))
        self.at, self.n, self.state, self.v = (c[order] for c in (at, n, state, v))
        ids, hs = ids[order], hs[order]
        cut = np.flatnonzero(firsts(ids, hs))
        self.where = dict(zip(zip(ids[cut].tolist(), hs[cut].tolist()), zip(cut.tolist(), [*cut[1:].tolist(), len(ids)])))

    def of(self, i: int, h: int) -> slice:
        return slice(*self.where.get((i, h), (0, 0)))


def texts_after_marks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Marks, int, int, bytes, tuple]]:
    """Each text with the marks of its task; rows come sorted so that a part's
    marks precede its texts, which stream by."""
    open_zstd = zstandard.ZstdDecompressor()
    part, waiting, marks = None, [], None
    for r in table_rows(batches):
        if r[0] != part:
            part, waiting, marks = r[0], [], None
        if r[1] != TEXT:
            waiting.append(r[2:8])
            continue
        if marks is None:
            marks, waiting = Marks(waiting), []
        i, h = (int.from_bytes(r[k], "little", signed=True) for k in (2, 3))
        yield marks, i, h, open_zstd.decompress(r[4]), r


def open_blocks(p: Params, parts: int):
    """Texts with open blocks: the blocks' bytes to the task of the anchor, or,
    for a hot anchor, a hash (128 bits) of each window to the task of the hash.  Later
    copies of a window in what leaves at once are settled here, so a common
    window is sent once a time."""

    def run(batches):
        keep: list[list] = []
        hot: list[tuple] = []
        size = 0

        def flush():
            nonlocal keep, hot, size
            out: list[tuple] = []
            if hot:
                i, h, k, names, more = (np.concatenate(c) for c in zip(*hot))
                order = np.lexsort((k, h, i, more, names))
                i, h, k, names, more = (c[order] for c in (i, h, k, names, more))
                new = firsts(names, more, i, h, k)  # a repeated row is one text
                lead = firsts(names, more)
                out += dealt(target(names[lead], parts), WINDOW, i[lead], h[lead], k[lead], more[lead], names[lead])
                i, h, k = (c[new & ~lead] for c in (i, h, k))
                order = np.lexsort((k, h, i))
                i, h, k = (c[order] for c in (i, h, k))
                s, count = runs_of(np.ones(len(k), bool), np.cumsum(firsts(i, h, k - np.arange(len(k)))))
                out += dealt(home(i[s], h[s], parts), SETTLED, i[s], h[s], k[s], count, np.zeros(len(s), np.int8), np.ones(len(s), U))
            if keep:
                ids, hs, at, n, v = (np.array(c, k) for c, k in zip(list(zip(*keep))[:5], (np.int64, np.int64, np.int64, np.int64, U)))
                data = [k[5] for k in keep]
                to = target(v, parts)
                order = np.argsort(to, kind="stable")
                cut = np.flatnonzero(firsts(to[order]))
                for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(order)]):
                    o = order[s:e]
                    out.append((int(to[o[0]]), DATA, *[c[o].tobytes() for c in (ids, hs, at, n, v)], b"".join(data[k] for k in o)))
            keep, hot, size = [], [], 0
            return out

        for marks, i, h, text, _ in texts_after_marks(batches):
            s = marks.of(i, h)
            for at, n, state, v in zip(marks.at[s].tolist(), marks.n[s].tolist(), marks.state[s].tolist(), marks.v[s].tolist()):
                if state == BY_ANCHOR:
                    keep.append([i, h, at, n, v, text[at:at + n + p.length - 1]])
                    size += n + p.length
                elif state == BY_WINDOW:
                    both = b"".join(xxhash.xxh3_128_digest(text[k:k + p.length]) for k in range(at, at + n))
                    names, more = np.frombuffer(both, U).reshape(-1, 2).T
                    hot.append((np.full(n, i, np.int64), np.full(n, h, np.int64), np.arange(at, at + n), names, more))
                    size += 48 * n
            if size >= p.send:
                yield rows_batch(flush())
        yield rows_batch(flush())

    return run


def runs_of(flag: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first index, length) of the marked runs within equal groups."""
    start = flag & np.concatenate([[True], ~flag[:-1] | (group[1:] != group[:-1])]) if len(flag) else flag
    end = flag & np.concatenate([~flag[1:] | (group[1:] != group[:-1]), [True]]) if len(flag) else flag
    s = np.flatnonzero(start)
    return s, np.flatnonzero(end) - s + 1


def resolve(p: Params, parts: int):
    """Open blocks and hot windows to removed windows."""

    def run(batches):
        rows: list[tuple] = []
        for b in batches:
            here = list(table_rows([b]))
            yield rows_batch([(r[0], SETTLED, *r[2:8]) for r in here if r[1] == SETTLED])
            rows += [r for r in here if r[1] != SETTLED]
        ids, hs, at, more, names = unpacked((r[2:7] for r in rows if r[1] == WINDOW), np.int64, np.int64, np.int64, U, U)
        if len(ids):
            order = np.lexsort((at, hs, ids, more, names))
            ids, hs, at, more, names = (c[order] for c in (ids, hs, at, more, names))
            new = firsts(names, more, ids, hs, at)  # a repeated row is one text
            ids, hs, at, more, names = (c[new] for c in (ids, hs, at, more, names))
            gone = ~firsts(names, more)
            ids, hs, at = ids[gone], hs[gone], at[gone]
            one = np.ones(len(ids), np.int64)
            yield rows_batch(list(dealt(home(ids, hs, parts), SETTLED, ids, hs, at, one, np.zeros(len(ids), np.int8), one)))
        some = [r for r in rows if r[1] == DATA]
        ids, hs, at, n, v = unpacked((r[2:7] for r in some), np.int64, np.int64, np.int64, np.int64, U)
        if not len(ids):
            return
        data = b"".join(r[7] for r in some)
        size = n + p.length - 1
        offset = np.cumsum(size) - size
        order = np.lexsort((at, hs, ids, v))
        ids, hs, at, n, v, size, offset = (c[order] for c in (ids, hs, at, n, v, size, offset))
        new = firsts(v, ids, hs, at)
        ids, hs, at, n, v, size, offset = (c[new] for c in (ids, hs, at, n, v, size, offset))
        border = np.append(np.flatnonzero(firsts(v)), len(v))
        total = np.concatenate([[0], np.cumsum(size)])
        s = 0
        while s < len(v):  # whole anchors, up to a batch of bytes
            k = int(np.searchsorted(border, s, side="right"))
            e = int(border[k])
            while k + 1 < len(border) and total[border[k + 1]] - total[s] <= p.batch:
                k += 1
                e = int(border[k])
            o = np.lexsort((at[s:e], hs[s:e], ids[s:e])) + s
            later = later_windows([data[offset[j]:offset[j] + size[j]] for j in o.tolist()], n[o], p.length)
            block = np.repeat(np.arange(len(o)), n[o])
            inner = np.arange(len(later)) - np.repeat(np.cumsum(n[o]) - n[o], n[o])
            first, count = runs_of(later, block)
            j = o[block[first]]
            yield rows_batch(list(dealt(home(ids[j], hs[j], parts), SETTLED, ids[j], hs[j], at[j] + inner[first], count,
                                        np.zeros(len(j), np.int8), v[j])))
            s = e

    return run


def removed_spans(at: np.ndarray, n: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the windows (starts ascending)."""
    out: list[list[int]] = []
    for s, e in zip(at.tolist(), (at + n + length - 1).tolist()):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def cut_out(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    keep, at = [], 0
    for s, e in spans:
        keep.append(text[at:s])
        at = e
    keep.append(text[at:])
    return b"".join(keep)


RESULT = "_id long, _h long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def finish(p: Params, full: bool):
    """Texts with their removed windows to results."""

    def run(batches):
        rows: list[tuple] = []

        def flush():
            cols = list(zip(*rows)) if rows else [()] * (6 + full)
            kinds = [pa.int64()] * 5 + [pa.string()] * (1 + full)
            names = ["_id", "_h", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["_kept"] * full
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        size = 0
        for marks, i, h, text, _ in texts_after_marks(batches):
            s = marks.of(i, h)
            settled = marks.state[s] == SETTLED
            spans = removed_spans(marks.at[s][settled], marks.n[s][settled], p.length)
            kept = cut_out(text, spans)
            rows.append((i, h, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                         *[kept.decode("utf-8", "ignore")] * full))
            size += 200 + len(kept) * full
            if size > 8 << 20:
                yield flush()
                rows, size = [], 0
        yield flush()

    return run


def keyed(docs: DataFrame, text: Column, doc_id: Column) -> DataFrame:
    own = F.coalesce(text, F.lit(""))
    return docs.select(F.coalesce(doc_id.cast("long"), F.lit(NULL_ID).cast("long")).alias("_id"),
                       F.xxhash64(own).alias("_h"), own.cast("binary").alias("_text"))


def marked_texts(marks: DataFrame, open_only: bool, most: int = 1 << 20) -> DataFrame:
    """(_id, _h) of the texts that have marks, or open ones.  A task names a text
    once, or once more after ``most`` others, however many marks it has."""

    def run(batches):
        held, size = [], 0

        def flush():
            nonlocal held, size
            both = np.unique(np.concatenate(held), axis=0) if held else np.zeros((0, 2), np.int64)
            held, size = [both], 0
            return both

        def rows(both):
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["_id", "_h"])

        for b in batches:
            ids, hs, _, _, state = unpacked((r[2:7] for r in table_rows([b])), np.int64, np.int64, np.int64, np.int64, np.int8)
            pick = state != SETTLED if open_only else np.ones(len(state), bool)
            held.append(np.unique(np.stack([ids[pick], hs[pick]], 1), axis=0))
            size += len(held[-1])
            if size > most and len(flush()) > most:
                yield rows(held.pop())
        yield rows(flush())

    return staged(marks.mapInArrow(tidy(run), "_id long, _h long").distinct())


def removed(docs: DataFrame, p: Params = Params(), full: bool = False) -> DataFrame:
    """(_id, _h, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``,
    ``_h`` a hash of the text; with ``full`` only rows that lose bytes, and
    their remaining text ``_kept``.

    Only texts with marks are shuffled.  They are picked by a broadcast of
    their keys while these are few, else by a shuffle join."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(shuffle_parts(docs.sparkSession), -(-size // p.share))
    texts = keyed(bounded_batches(docs), F.col("text"), F.col("doc_id"))
    deal = lambda d: d.repartition(parts, "part")
    states = staged(deal(texts.mapInArrow(tidy(find_blocks(p, parts)), ROW)).mapInArrow(tidy(settle(p, parts)), ROW))

    def meet(marks: DataFrame, picked: DataFrame) -> DataFrame:
        sent = texts.join(picked, ["_id", "_h"], "left_semi").mapInArrow(tidy(send_texts(parts)), ROW)
        return marks.unionByName(sent).repartition(parts, "part").sortWithinPartitions("part", "kind")

    opened = meet(states, small(marked_texts(states, True))).mapInArrow(tidy(open_blocks(p, parts)), ROW)
    marks = states.unionByName(staged(deal(opened).mapInArrow(tidy(resolve(p, parts)), ROW)))
    picked = small(marked_texts(marks, False))
    result = RESULT + ", _kept string" * full
    changed = meet(marks, picked).mapInArrow(tidy(finish(p, full)), result)
    if full:
        return changed.where("n_removed > 0")
    whole = texts.join(picked, ["_id", "_h"], "left_anti").select(
        "_id", "_h", F.octet_length("_text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2("_text", 256).alias("kept_sha256"))
    return changed.unionByName(whole)


def repeated_bytes(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document.

    Removed is each byte of a ``length``-byte string that also starts earlier:
    in a document of smaller id, or earlier in the same one; matches never cross
    documents and are judged on the input.  A null or empty text has 0 bytes.
    Documents of one id are in order of a hash of their texts, those without an
    id come first; rows that repeat both id and text are one document, and each
    has its result.  An empty table gives no rows; other columns are ignored."""
    null = F.lit(NULL_ID).cast("long")
    return removed(docs, p).select(F.when(F.col("_id") != null, F.col("_id")).alias("doc_id"),
                                   "n_bytes", "n_removed", "n_spans", "kept_sha256")


def without_repeats(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The documents with repeated bytes removed (and with them the rest of a
    character cut in two); a document that had text and has none left goes.
    All columns stay; ``n_chars``, where present, counts the new text."""
    found = staged(removed(docs, p, full=True).select("_id", "_h", "_kept").dropDuplicates(["_id", "_h"]))
    rows = docs.select(F.struct("*").alias("_row"))
    key = ["_id", "_h"]
    rows = rows.select("_row", F.coalesce(F.col("_row.doc_id").cast("long"), F.lit(NULL_ID).cast("long")).alias("_id"),
                       F.xxhash64(F.coalesce(F.col("_row.text"), F.lit(""))).alias("_h"))
    picked = small(found.select(*key))
    same = rows.join(picked, key, "left_anti").select("_row")
    bare = rows.join(picked, key, "left_semi").select(F.col("_row").withField("text", F.lit(None).cast("string")).alias("_row"), *key)
    new = F.col("_row").withField("text", F.col("_kept"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new = new.withField("n_chars", F.char_length("_kept").cast(kind))
    changed = bare.join(found.where("_kept <> ''"), key).select(new.alias("_row"))
    return same.unionByName(changed).select("_row.*")
