"""Operators with exact results against brute force or the libraries."""
from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evalpress.llm import bpe_codec, line_dedup, minhash_dedup, packing, quality_rules, simhash, suffix_dedup
from evalpress.llm.components import most_apart
from evalpress.llm.queries import tokenizer_file
from tests.conftest import SMALL
from tests.llm.helpers import collected, docs, words


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def corpus(seed: int = 1) -> list[tuple]:
    """Copies, near copies, shared passages, periodic text, nulls and ties."""
    rng = random.Random(seed)
    base = [words(rng, rng.randrange(5, 150)) for _ in range(30)]
    passage = words(rng, 40)
    rows = [(i * 3, t) for i, t in enumerate(base)]
    for i in range(12):
        t = rng.choice(base).split()
        for _ in range(rng.randrange(0, 4)):
            t[rng.randrange(len(t))] = "edit%d" % rng.randrange(99)
        rows.append((i * 3 + 1, " ".join(t)))
    rows += [(200 + i, words(rng, 30) + passage + words(rng, 30)) for i in range(6)]
    rows += [(300, base[0]), (301, base[0]), (302, "a" * 700), (303, "ab" * 300), (304, None), (305, ""), (306, "é" * 120 + base[1]),
             (307, (base[2] + "\n") * 4), (None, base[3]), (None, None), (300, base[4]), (308, "x"), (308, "x")]
    rows.append((309, words(rng, 6000) + "\n" + passage))
    return rows


# ---------------------------------------------------------------- 1 suffix array dedup

def brute_suffix(rows: list[tuple], length: int = 100) -> dict:
    order = sorted({(r[0] is not None, r[0] or 0, r[1] or "") for r in rows}, key=lambda r: (r[0], r[1]))
    out, seen = {}, set()
    for has, i, text in order:
        data = text.encode()
        mark = np.zeros(len(data), bool)
        for k in range(len(data) - length + 1):
            s = data[k:k + length]
            if s in seen:
                mark[k:k + length] = True
            seen.add(s)
        spans = int((np.diff(np.concatenate([[0], mark.astype(np.int8)])) == 1).sum())
        out[(i if has else None, text)] = (len(data), int(mark.sum()), spans, sha(np.frombuffer(data, np.uint8)[~mark].tobytes()))
    return out


@pytest.mark.parametrize("hot", [2, 256])
def test_suffix_dedup_brute_force(spark, hot):
    rows = [r for r in corpus() if not (r[0] == 300 and r[1] is None)]
    rows = [r for r in rows if r != (300, corpus()[4])]
    seen, unique = set(), []
    for r in rows:  # ids with several texts are in hash order, tested below
        if r[0] in seen and r[0] is not None and (r[0], r[1]) not in unique:
            continue
        seen.add(r[0])
        unique.append((r[0], r[1]))
    unique = [r for r in unique if r[0] is not None]
    want = brute_suffix(unique)
    p = suffix_dedup.Params(hot=hot, piece=5000, batch=3000)
    got = collected(suffix_dedup.repeated_bytes(docs(spark, unique, clash=True).repartition(5), p))
    assert len(got) == len(unique)
    assert sum(r["n_removed"] for r in got) > 5000
    by = defaultdict(list)
    for (i, _), v in want.items():
        by[i].append(v)
    for r in got:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) in by[r["doc_id"]], r["doc_id"]


def test_suffix_dedup_edges(spark):
    assert collected(suffix_dedup.repeated_bytes(docs(spark, []))) == []
    t = "z" * 50 + words(random.Random(0), 99, 10 ** 4)[:200]
    got = collected(suffix_dedup.repeated_bytes(docs(spark, [(None, t), (5, t), (5, t), (7, None), (8, "")])))
    # the row without an id comes first; rows repeating id and text are one document
    assert Counter((r["doc_id"], r["n_removed"]) for r in got)[(5, len(t))] == 2
    assert sorted((str(r["doc_id"]), r["n_bytes"]) for r in got) == sorted(
        [("None", 250), ("5", 250), ("5", 250), ("7", 0), ("8", 0)])
    kept = suffix_dedup.without_repeats(docs(spark, [(1, t), (2, t + "tail of its own"), (3, t), (4, ""), (5, None)], clash=True))
    got = {r["doc_id"]: r for r in collected(kept)}
    assert set(got) == {1, 2, 4, 5} and got[2]["text"] == "tail of its own" and got[2]["n_chars"] == 15
    assert got[2]["_row"] == "x2" and got[1]["text"] == t


def test_suffix_dedup_common_passage_in_small_batches():
    """A passage in a fifth of the rows of many small batches is not hot in any
    of them; its blocks' bytes still do not all go to one task."""
    rng, p = random.Random(5), suffix_dedup.Params(batch=20000)
    passage = words(random.Random(6), 60)
    texts = [(words(rng, 60, 10 ** 6) + (passage + words(rng, 60, 10 ** 6) if i % 5 == 0 else "")).encode() for i in range(2000)]
    kinds = (pa.int64(), pa.int64(), pa.binary())
    batches = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(([*range(s, s + 50)], [7] * 50, texts[s:s + 50]), kinds)],
                                          names=["_id", "_h", "_text"]) for s in range(0, 2000, 50)]
    found = list(suffix_dedup.find_blocks(p, 1)(batches))
    assert not any(r[1] == suffix_dedup.HOT_MARK for r in suffix_dedup.table_rows(found))
    rows = suffix_dedup.table_rows(suffix_dedup.settle(p, 1)(found))
    _, _, _, n, state, v = suffix_dedup.unpacked([r[2:8] for r in rows], *[np.int64] * 4, np.int8, np.uint64)
    at_anchor = Counter()
    for count, key in zip(n[state == suffix_dedup.BY_ANCHOR].tolist(), v[state == suffix_dedup.BY_ANCHOR].tolist()):
        at_anchor[key] += count + p.length - 1
    assert max(at_anchor.values(), default=0) <= p.batch and (state == suffix_dedup.BY_WINDOW).sum() > 100


def test_suffix_dedup_common_passage_brute_force(spark):
    rng = random.Random(7)
    passage, run = words(random.Random(6), 60), "a" * 300
    rows = [(i, words(rng, 20, 10 ** 6) + (passage + run[:100 + i] + words(rng, 20, 10 ** 6) if i % 5 == 0 else "")) for i in range(200)]
    rows.append(rows[10])
    got = collected(suffix_dedup.repeated_bytes(docs(spark, rows).repartition(8), suffix_dedup.Params(batch=2000)))
    want = brute_suffix(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[(r["doc_id"], dict(rows)[r["doc_id"]])]


def test_suffix_ranks_are_suffix_order():
    rng = np.random.default_rng(0)
    for n in range(1, 60):
        t = rng.integers(1, 4, n)
        order = np.argsort(suffix_dedup.suffix_ranks(t, n + 1))
        tails = [t[i:].tolist() for i in order]
        assert tails == sorted(tails)


# ---------------------------------------------------------------- 2 packing

def test_packing(spark):
    from tokenizers import Tokenizer

    path = tokenizer_file("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    rows = corpus(2) + [(900 + i, "some <|endoftext|> words  \n\n here" * (i + 1)) for i in range(40)]
    got = collected(packing.pack(docs(spark, rows, clash=True), path, group_docs=40))
    want = Counter()
    for i, t in [(r[0], r[1]) for r in rows]:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        want[i, len(ids)] += len(ids)
    assert Counter({k: sum(r["length"] for r in got if (r["doc_id"], r["doc_tokens"]) == k) for k in want}) == want
    by_doc = {(r[0], r[1]): tok.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in rows}
    crcs = {(i, s, n): zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes()) for (i, _), ids in by_doc.items()
            for r in got if r["doc_id"] == i and r["doc_tokens"] == len(ids) for s, n in [(r["start"], r["length"])]}
    assert all(r["ids_crc32"] in {v for k, v in crcs.items() if k == (r["doc_id"], r["start"], r["length"])}
               or [x[0] for x in rows].count(r["doc_id"]) > 1 for r in got)
    seqs = defaultdict(list)
    for r in got:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at and n > 0
            at += n
        assert at <= 2048
    assert collected(packing.pack(docs(spark, []), path)) == []


def test_packing_spreads_repeated_rows(spark):
    path = tokenizer_file("byte_bpe_50k.json")
    rows = [(None, None)] * 4000 + [(7, "the same text")] * 4000 + [(i, "own text %d" % i) for i in range(100, 4100)]
    got = packing.pack(docs(spark, rows), path, group_docs=500)
    sizes = [r["n"] for r in got.groupBy(F.shiftright("sequence_id", 32).alias("g")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 12000 and len(sizes) == 24 and max(sizes) < 2 * 500
    assert got.select("sequence_id", "offset").distinct().count() == 12000
    assert Counter(r["doc_id"] for r in got.collect())[7] == 4000


def test_first_fit_decreasing_matches_plain_search():
    rng = np.random.default_rng(1)
    n = rng.integers(1, 2049, 500)
    where, offset = packing.first_fit_decreasing(n, 2048)
    room: list[int] = []
    for i in np.argsort(-n, kind="stable"):
        b = next((k for k, r in enumerate(room) if r >= n[i]), len(room))
        room += [2048] * (b == len(room))
        assert (where[i], offset[i]) == (b, 2048 - room[b])
        room[b] -= n[i]


def test_padding_is_small(spark):
    path = tokenizer_file("byte_bpe_50k.json")
    got = packing.pack(spark.read.parquet(f"{SMALL}/documents.parquet"), path)
    size = got.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.sum("n"), F.count("*")).first()
    assert size[0] >= 0.97 * 2048 * (size[1] - 1)


# ---------------------------------------------------------------- 4 encoding and decoding

def test_bpe_codec_matches_library(spark):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    rng = random.Random(4)
    texts = [r[1] for r in corpus(3)]
    texts += ["It's  THE'RE we'll \t\n 123 4½ <|endoftext|>x<|startoftext|> ΣΑΣ İ ﬁ é 日本語テキスト 😀😀   a\x1cb\x85c",
              "a" * 3000, "!" * 999, "<|endoftext|>", "ab" * 777]
    texts += ["".join(chr(rng.choice([rng.randrange(1, 128), rng.randrange(128, 0x250), 32, rng.randrange(0x400, 0x460)])) for _ in range(80))
              for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in collected(bpe_codec.encode_decode(docs(spark, rows, clash=True), path, full=True))}
    assert len(got) == len(rows)
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        assert got[i]["ids"] == ids and got[i]["n_tokens"] == len(ids), t
        assert got[i]["decoded"] == tok.decode(ids, skip_special_tokens=False)
        assert got[i]["ids_sha256"] == sha(np.array(ids, "<u4").tobytes())
        assert got[i]["decoded_sha256"] == sha(got[i]["decoded"].encode())
    assert collected(bpe_codec.encode_decode(docs(spark, []), path)) == []


# ---------------------------------------------------------------- 6 line dedup

def distance_at_most_one(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:] or a == b


def test_line_dedup_brute_force(spark):
    rng = random.Random(6)
    pool = ["".join(rng.choice("abcdé ") for _ in range(n)).strip().ljust(20, "q") for n in (20, 21, 40, 63, 64, 65, 66, 128, 129, 300)]

    def edit(s: str) -> str:
        k = rng.randrange(len(s) + 1)
        return rng.choice([s, s[:k] + "Z" + s[k:], s[:k] + s[k + 1:], s[:k] + "Y" + s[k + 1:], s[:k] + "ZZ" + s[k:]])

    rows = [(i, "\n".join(rng.choice([edit(rng.choice(pool)), rng.choice(["short", "shor", "x", " Read more", "nineteen characters", "é.", "\t"]), "", "  " + rng.choice(pool) + " ", words(rng, 12)])
                          for _ in range(rng.randrange(1, 9)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, rows[0][1]), (103, "\n".join(pool * 3)), (104, "y" * 5000), (105, "y" * 5001 + "\nok")]
    got = {r["doc_id"]: r for r in collected(line_dedup.line_counts(docs(spark, rows, clash=True).repartition(4)))}
    earlier: list[str] = []
    total = 0
    for i, t in sorted(rows):
        kept, n = [], 0
        for line in (t or "").split("\n"):
            s = line.strip()
            if s:
                if any(e == s or min(len(s), len(e)) >= 20 and distance_at_most_one(s, e) for e in earlier):
                    n += 1
                else:
                    kept.append(line)
                earlier.append(s)
            else:
                kept.append(line)
        total += n
        text = "\n".join(kept)
        assert (got[i]["n_lines"], got[i]["n_removed"], got[i]["kept_sha256"]) == ((t or "").count("\n") + 1, n, sha(text.encode())), i
    assert total > 100
    assert collected(line_dedup.line_counts(docs(spark, []))) == []


def test_line_dedup_stage_and_repeated_rows(spark):
    line = "this very line is long enough"
    rows = [(None, line), (1, line + "!"), (2, "own text here that stays\n" + line), (3, None), (3, None), (4, " "), (2, "own text here that stays\n" + line)]
    got = collected(line_dedup.without_repeated_lines(docs(spark, rows, clash=True)))
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(
        [(None, line), (2, "own text here that stays"), (2, "own text here that stays"), (3, None), (3, None), (4, " ")])
    assert {r["n_chars"] for r in got if r["doc_id"] == 2} == {24} and got[0]["_gone"] == "x11"


# ---------------------------------------------------------------- 7 near duplicates

def brute_alike(a: Counter, b: Counter) -> float:
    """Probability Jaccard similarity as its definition has it."""
    both, every = a.keys() & b.keys(), a.keys() | b.keys()
    return sum(1 / sum(max(a[i] / a[d], b[i] / b[d]) for i in every) for d in both)


def brute_classes(rows: list[tuple], k: int = 5, least: float = 0.8, weighted: bool = False) -> dict:
    def shingle(t: str) -> Counter:
        w = (t or "").lower().split()
        n = Counter(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else Counter()
        return n if weighted else Counter(n.keys())

    texts = sorted({r[1] or "" for r in rows})
    sets = [shingle(t) for t in texts]
    up = list(range(len(texts)))

    def root(i: int) -> int:
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and (len(a.keys() & b.keys()) >= least * len(a.keys() | b.keys()) if not weighted
                            else 3 * len(a) > len(b) and 3 * len(b) > len(a) and brute_alike(a, b) >= least - 1e-9):
                up[root(i)] = root(j)
    first: dict[int, int] = {}
    where = {t: root(i) for i, t in enumerate(texts)}
    for i, t in sorted((r[0], r[1] or "") for r in rows):
        first.setdefault(where[t], i)
    return {i: first[where[t or ""]] for i, t in [(r[0], r[1]) for r in rows]}


def near_rows() -> list[tuple]:
    rng = random.Random(7)
    rows, base = [], [words(rng, n, 5000) for n in (3, 5, 12, 60, 200, 400, 900)]
    base.append(base[3] + " " + " ".join(["same old words come again"] * 80))
    for i in range(150):
        t = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2, 5, 12, 30])):
            t[rng.randrange(len(t))] = "n%d" % rng.randrange(10 ** 6)
        rows.append((i, " ".join(t)))
    rows += [(500, None), (501, ""), (502, "  "), (503, base[4].upper()), (504, words(rng, 20000, 10 ** 6))]
    return rows


@pytest.mark.parametrize("weighted", [False, True])
def test_near_duplicates_brute_force(spark, weighted):
    rows, p = near_rows(), minhash_dedup.Params(weighted=weighted)
    want = brute_classes(rows, weighted=weighted)
    got = collected(minhash_dedup.near_duplicates(docs(spark, rows, clash=True).repartition(4), p))
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    assert all(r["stays"] == (r["doc_id"] == r["class_id"]) for r in got)
    assert len(set(want.values())) < 120
    kept = collected(minhash_dedup.keep_one(docs(spark, rows + [rows[0]], clash=True), p))
    assert sorted(r["doc_id"] for r in kept) == sorted(set(want.values()))
    assert collected(minhash_dedup.near_duplicates(docs(spark, []))) == []
    assert collected(minhash_dedup.keep_one(docs(spark, []))) == []
    got = collected(minhash_dedup.near_duplicates(docs(spark, [(None, "a b c"), (3, "A b  c"), (3, "other")])))
    assert Counter((r["doc_id"], r["class_id"], r["stays"]) for r in got) == Counter(
        [(None, None, True), (3, None, False), (3, 3, True)])


def test_parity_bits_never_exceed_the_difference(spark):
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2 ** 32, int(k), dtype=np.uint32)) for k in (0, 1, 30, 400, 5000)]
    sets.append(np.concatenate([sets[3][10:], sets[2]]))
    own = spark.createDataFrame([(i, bytearray(np.sort(s).tobytes()), bytearray()) for i, s in enumerate(sets)],
                                "node long, s binary, w binary")
    bits = {r.node: np.array(r.bits, np.int64).view(np.uint64) for r in minhash_dedup.item_parities(own).collect()}
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            differ = int(np.bitwise_count(bits[i] ^ bits[j]).sum())
            assert differ <= len(np.setxor1d(a, b)) and (i != j or differ == 0)
            assert len(bits[i]) == minhash_dedup.PARITY_WORDS


def test_weighted_classes(spark):
    rng = random.Random(70)
    head, line = words(rng, 60, 5000), " ".join(["same old words come again"] * 80)
    rows = [(1, head), (2, head + " " + line), (3, words(rng, 60, 5000) + " " + line)]
    plain = collected(minhash_dedup.near_duplicates(docs(spark, rows), minhash_dedup.Params(weighted=False)))
    assert {r["doc_id"]: r["class_id"] for r in plain} == {1: 1, 2: 1, 3: 3}
    by_weight = collected(minhash_dedup.near_duplicates(docs(spark, rows), minhash_dedup.Params(weighted=True, similarity=0.6)))
    assert {r["doc_id"]: r["class_id"] for r in by_weight} == {1: 1, 2: 2, 3: 2}


def test_weighted_bounds_never_exclude_alike_texts(spark):
    rng, texts = random.Random(71), []
    line = " ".join(["old words come again now"] * 12)
    for n in (40, 80, 160):
        t = words(rng, n, 5000)
        texts += [t, t + " " + line, line + " " + t + " " + line, " ".join(t.split()[:-4]) + " " + line, t + " " + t]
    own, counts = [], []
    for i, t in enumerate(texts):
        v, w = minhash_dedup.shingles(t, 5)
        v, at = np.unique((v >> np.uint64(32)).astype(np.uint32), return_index=True)
        own.append((i, bytearray(v.tobytes()), bytearray(np.add.reduceat(w, at).astype(np.uint32).tobytes())))
        counts.append(Counter(dict(zip(v.tolist(), np.add.reduceat(w, at).tolist()))))
    own = spark.createDataFrame(own, "node long, s binary, w binary")
    bits = {r.node: np.array(r.bits, np.int64).view(np.uint64) for r in minhash_dedup.item_parities(own).collect()}
    weight = {r.node: (r.n, r.u) for r in minhash_dedup.shared_items(own).collect()}
    alike = 0
    for i, a in enumerate(counts):
        only = sum(c for x, c in a.items() if sum(x in b for b in counts) == 1)
        assert weight[i] == (sum(a.values()), only)
        for j, b in enumerate(counts[:i]):
            value, differ = brute_alike(a, b), int(np.bitwise_count(bits[i] ^ bits[j]).sum())
            few, many = sorted((weight[i][0], weight[j][0]))
            assert differ <= sum(abs(a[x] - b[x]) for x in a.keys() | b.keys()) <= 2 * (1 - value) * few + many - few + 1e-6
            assert min(1 - u / n for n, u in (weight[i], weight[j])) >= value - 1e-9
            alike += value >= 0.5
    assert alike > 5


def test_most_apart_holds_for_weighted_sets(spark):
    rng, rows = random.Random(72), []
    for k in range(300):
        a = Counter({i: rng.choice([1, 1, 1, 2, rng.randrange(1, 30)]) if k % 3 else 1 for i in range(rng.randrange(1, 40))})
        b = Counter({i: c if rng.random() < 0.7 else rng.randrange(1, 2 + (k % 3) * c) for i, c in a.items() if rng.random() < 0.95})
        b.update({100 + i: rng.randrange(1, 2 + k % 3) for i in range(rng.randrange(0, 4))})
        b = b or Counter([1])
        only = sum(c for i, c in (a | b).items() if not (a[i] and b[i]))
        differ = sum(abs(a[i] - b[i]) for i in a | b)
        side = [{"n": float(sum(s.values())), "r": float(sum(s.values()) - len(s))} for s in (a, b)]
        rows.append((*side, float(brute_alike(a, b)), float(only), float(differ), not side[0]["r"] and not side[1]["r"]))
    shape = "n double, r double"
    df = spark.createDataFrame(rows, f"x struct<{shape}>, y struct<{shape}>, least double, o double, d double, plain boolean")
    both = most_apart("x", "y", F.col("least"))
    got = df.select("*", both[0].alias("only"), both[1].alias("differ")).where("least > 0").collect()
    assert len(got) > 250 and all(r.o <= r.only and r.d <= r.differ for r in got)
    assert all(abs(r.o - r.only) < 1e-4 and abs(r.d - r.differ) < 1e-4 for r in got if r.plain)
    assert sum(r.plain for r in got) > 30


def test_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    rng, seen, verified = random.Random(73), [], minhash_dedup.verified
    line = " ".join(["same old words come again"] * 4)
    base = (words(rng, 110, 9000) + " " + line + " " + words(rng, 80, 9000)).split()
    rows = []
    for i in range(80):  # three edits each: too far from most others, near enough for their buckets
        t = list(base)
        for k in rng.sample(range(len(t)), 3):
            t[k] = "edit%d" % rng.randrange(10 ** 6)
        rows.append((i, " ".join(t)))
    rows.append((80, rows[0][1] + " end"))

    def counting(pairs, own, p):
        seen.append(pairs.count())
        return verified(pairs, own, p)

    monkeypatch.setattr(minhash_dedup, "verified", counting)
    got = collected(minhash_dedup.near_duplicates(docs(spark, rows)))
    assert {r["doc_id"]: r["class_id"] for r in got} == brute_classes(rows, weighted=True)
    assert len({r["class_id"] for r in got}) > 10
    assert max(seen) < 6 * len(rows)


def test_registers_estimate_weighted_similarity():
    rng = np.random.default_rng(2)
    items = rng.integers(1, 2 ** 62, 400).astype(np.uint64)
    wa, wb = rng.integers(1, 5, 400).astype(float), rng.integers(1, 5, 400).astype(float)
    a, b = slice(0, 300), slice(100, 400)
    want = sum(1 / np.maximum(np.where(np.arange(400) < 300, wa, 0) / wa[i], np.where(np.arange(400) >= 100, wb, 0) / wb[i]).sum()
               for i in range(100, 300))
    assert abs(minhash_dedup.probability_jaccard(items[a], wa[a], items[b], wb[b]) - want) < 1e-9
    x, y = (minhash_dedup.prob_minhash(items[s], w[s], 4096) for s, w in ((a, wa), (b, wb)))
    assert abs((x == y).mean() - want) < 0.04


# ---------------------------------------------------------------- 8 fingerprints

def brute_edited(rows: list[tuple]) -> dict:
    order = sorted(rows, key=lambda r: r[0])
    out = {}
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        out[i] = (len(t), t[:len(t) - half] + nxt[:half], nxt)
    return out


def test_simhash(spark):
    rows = [(r[0], r[1]) for r in corpus(8)[:60]] + [(700, "Hello  World"), (701, "hello world"), (702, "😀é" * 9), (703, None), (704, " ")]
    rows = list({r[0]: r for r in rows if r[0] is not None}.values())
    want = brute_edited(rows)
    df = simhash.compare_edited(docs(spark, rows, clash=True).repartition(3), every=1)
    got = {r["doc_id"]: r for r in collected(df)}
    assert len(got) == len(rows)
    every = [(k, t) for i, (n, e, x) in want.items() for k, t in ((f"{i}e", e), (f"{i}x", x), (f"{i}t", dict(rows)[i] or ""))]
    terms = spark.createDataFrame([(k, w) for k, t in every for w in t.lower().split()], "k string, w string").select("k", F.xxhash64("w").alias("h"))
    hashes = defaultdict(list)
    for r in terms.collect():
        hashes[r["k"]].append(r["h"] & (2 ** 64 - 1))
    fp = {k: sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes[k]) > len(hashes[k])) for k, _ in every}
    bits = lambda a, b: bin(a ^ b).count("1")
    for i, (n, e, _) in want.items():
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (n, sha(e.encode())), i
        assert (r["fingerprint"], r["edited_fingerprint"]) == (f"{fp[f'{i}t']:016x}", f"{fp[f'{i}e']:016x}")
        assert r["near_edited"] == 1 - bits(fp[f"{i}t"], fp[f"{i}e"]) / 64
        assert r["near_next"] == 1 - bits(fp[f"{i}t"], fp[f"{i}x"]) / 64
        own = {fp[f"{k}t"] for k in want}
        assert r["n_near"] == sum(0 < bits(x, fp[f"{i}t"]) <= 3 for x in own)
    assert got[700]["fingerprint"] == got[701]["fingerprint"] and got[704]["fingerprint"] == "0" * 16
    assert collected(simhash.compare_edited(docs(spark, []))) == []
    one = collected(simhash.compare_edited(docs(spark, [(5, "abcd efgh")])))
    assert one[0]["edited_sha256"] == sha(b"abcd abcd") and one[0]["near_next"] == 1.0
    many = collected(simhash.compare_edited(docs(spark, [(None, "x y"), (None, None), (3, "a b"), (3, "a b")])))
    assert len(many) == 4


def test_simhash_finds_copies_and_names_partners(spark):
    rng = random.Random(3)
    base = words(rng, 400).split()
    close = [" ".join([*base[:k], f"new{k}", *base[k + 1:]]) for k in range(40)]
    rows = [(0, "one two three four"), (1, "one two three four"), (50, "ONE  two four three"), (None, "one two three four")]
    rows += [(100, "no copy of this anywhere")] + [(150 + 50 * k, t) for k, t in enumerate(close)] + [(7, close[0])]
    got = collected(simhash.compare_edited(docs(spark, rows, clash=True).repartition(3)))
    fp = [(r["doc_id"], int(r["fingerprint"], 16)) for r in got]
    bits = lambda a, b: bin(a ^ b).count("1")
    seen = set()
    for k, r in enumerate(got):
        if r["doc_id"] is None or r["doc_id"] % 50:
            assert r["near"] is r["n_near_docs"] is r["n_near"] is None
            continue
        others = [(bits(f, fp[k][1]), f, i) for j, (i, f) in enumerate(fp) if j != k and bits(f, fp[k][1]) <= 3]
        assert r["n_near_docs"] == len(others) == sum(e["n_docs"] for e in r["near"])
        assert Counter((d, f"{f:016x}") for d, f, _ in others) == {(e["distance"], e["fingerprint"]): e["n_docs"] for e in r["near"]}
        assert all((e["distance"], int(e["fingerprint"], 16), e["doc_id"]) in others for e in r["near"])
        assert [e["distance"] for e in r["near"]] == sorted(e["distance"] for e in r["near"])
        seen.update(e["distance"] for e in r["near"])
    by = {r["doc_id"]: r for r in got}
    assert by[0]["n_near_docs"] == by[50]["n_near_docs"] == 3 and by[0]["n_near"] == 0 and by[100]["near"] == [] and len(seen) > 1


def test_block_tables_find_all(spark):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(6))) for b in base for _ in range(12)}
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    df = spark.createDataFrame([(v,) for v in signed.values()] + [(None,)], "_fp long")
    got = {(r["query"], r["found"]) for r in simhash.near_pairs(df, df, 3).collect()}
    assert got == {(signed[a], signed[b]) for a in fps for b in fps if a != b and bin(a ^ b).count("1") <= 3}
    assert simhash.near_pairs(df, df, 3).count() == len(got)


# ---------------------------------------------------------------- 10 quality rules

def test_quality_base_counts(spark):
    import re

    rows = corpus(10) + [(800, "a b c a b c\n\n \na b c a b c\n#x $y"), (801, "\x1c word one two"), (802, "x y z x y z x y z"),
                         (803, "a a a a"), (804, "The cat sat. " * 500), (805, "".join(random.Random(5).choices("abcdefghij0123456789 ", k=9000)))]
    got = collected(quality_rules.quality_rules(docs(spark, rows, clash=True)))
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    for i, t in [(r[0], r[1]) for r in rows]:
        t = t or ""
        w = re.split(r"[\x20\x09-\x0D]+", t)
        w = [x for x in w if x]
        win = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        rep = len({j for k in range(len(w) - 2) if win[tuple(w[k:k + 3])] > 1 for j in range(k, k + 3)})
        seen, dup = set(), 0
        for line in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        base = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, rep, len(w) < 50 or 100 * rep > 50 * len(w))
        assert base in [(r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
                        for r in by[i]], i
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert not by[804][0]["kept"]
    assert collected(quality_rules.quality_rules(docs(spark, []))) == []


def test_compression_bands():
    import zstandard

    comp = zstandard.ZstdCompressor(level=3)
    rng = random.Random(3)
    prose = " ".join("".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(rng.randrange(1, 4))) for _ in range(900))
    noise = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(3000))
    conf = quality_rules.Bands()
    assert quality_rules.judge(prose, conf, comp)["kept"]
    for bad in (" ".join(chr(97 + i % 26) * 3 for i in range(60)) * 40, " ".join(noise[i:i + 20] for i in range(0, 3000, 20))):
        assert not quality_rules.judge(bad, conf, comp)["kept"]


def test_marked_texts_are_named_once_a_task(spark):
    rng = random.Random(4)
    marks = [(rng.randrange(40), rng.randrange(3), k, 1, rng.choice([suffix_dedup.SETTLED, suffix_dedup.BY_ANCHOR]), 9) for k in range(3000)]
    rows = [tuple([0, suffix_dedup.SETTLED, *[np.array([m[c] for m in marks[at:at + 7]], t).tobytes() for c, t in
                                               enumerate((np.int64, np.int64, np.int64, np.int64, np.int8, np.uint64))], b""])
            for at in range(0, len(marks), 7)]
    df = spark.createDataFrame(rows, suffix_dedup.ROW)
    for only in (True, False):
        want = {(m[0], m[1]) for m in marks if not only or m[4] != suffix_dedup.SETTLED}
        for most in (5, 1 << 20):
            got = suffix_dedup.marked_texts(df, only, most).collect()
            assert sorted((r["_id"], r["_h"]) for r in got) == sorted(want)
    assert suffix_dedup.marked_texts(df.limit(0), True).collect() == []
