"""Periodic runs against brute force."""
from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np

from evalpress.llm import periodic_runs as pr
from tests.llm.helpers import collected, docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words: list, least: int, exponent: int) -> list[tuple[int, int, int]]:
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, exponent * q):
                part = words[i:i + length]
                if not any(all(part[k] == part[k + d] for k in range(length - d)) for d in range(1, q)):
                    out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc_id, text) -> dict:
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n and doc_id is not None:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = brute_runs(words, 6, 4)
    drop = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return {"doc_id": doc_id, "n_runs": len(found), "start": best[0], "length": best[1], "period": best[2],
            "exponent_milli": 1000 * best[1] // best[2] if found else None,
            "runs_sha256": sha("".join("%d,%d,%d\n" % r for r in found)),
            "collapsed_sha256": sha(" ".join(w for i, w in enumerate(words) if i not in drop)), "n_words": n}


def sequences(rng: random.Random):
    for _ in range(1500):
        yield [rng.randrange(rng.choice([1, 2, 2, 3, 5])) for _ in range(rng.randrange(60))]
    for _ in range(300):
        out: list[int] = []
        for _ in range(rng.randrange(1, 5)):
            part = [rng.randrange(4) for _ in range(rng.randrange(1, 9))]
            out += (part * rng.randrange(1, 8))[:rng.randrange(1, 50)] + [rng.randrange(4) for _ in range(rng.randrange(4))]
        yield out


def test_runs_equal_brute_force():
    for x in sequences(random.Random(11)):
        for least, exponent in ((6, 4), (2, 2), (4, 3)):
            assert pr.runs(np.array(x, np.int64), pr.Params(least, exponent)) == brute_runs(x, least, exponent), x


def test_automaton_without_cut_of_stretches(monkeypatch):
    monkeypatch.setattr(pr, "stretches", lambda words, p: [(0, len(words))])
    for x in sequences(random.Random(12)):
        assert pr.runs(np.array(x, np.int64)) == brute_runs(x, 6, 4), x


def test_long_text_is_linear():
    x = np.array([k % 7 for k in range(60_000)] + list(range(100, 40_000)) + [5] * 50_000)
    assert pr.runs(x) == [(0, 60_000, 7), (99_900, 50_000, 1)]


def test_query(spark):
    rng = random.Random(3)
    vocab = ["a", "b", "the", "é", "ß", " x", "nul\u0001", " wide"]
    rows = [(i, rng.choice([" ", "\t", "\n", "\r\n ", "\x0b"]).join(
        rng.choice(vocab[:rng.choice([1, 3, 8])]) for _ in range(rng.randrange(80)))) for i in range(500)]
    rows += [(k, t) for k, t in rows[:20]]  # repeated rows
    rows += [(None, "x " * 9), (None, None), (900, None), (901, ""), (902, " \n\t "), (903, " lead " * 8), (904, "x y " * 30_000)]
    got = collected(pr.periodic_runs(docs(spark, rows, clash=True)))
    key = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["n_words"], r["runs_sha256"])
    want = [brute(*r) if r[0] != 904 else None for r in rows]
    long = [r for r in got if r["doc_id"] == 904]
    assert sorted([r for r in got if r["doc_id"] != 904], key=key) == sorted([w for w in want if w], key=key)
    assert len(long) == 1 and long[0]["n_words"] == 60_000
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(500)) > 30
    assert collected(pr.periodic_runs(docs(spark, []))) == []


def test_collapsed_text_and_runs(spark):
    got = collected(pr.find_runs(docs(spark, [(1, "so a b a b a b a b end"), (2, "no run here")])))
    assert [(r["collapsed"], [tuple(x) for x in r["runs"]]) for r in sorted(got, key=lambda r: r["doc_id"])] == [
        ("so a b end", [(1, 8, 2)]), ("no run here", [])]
