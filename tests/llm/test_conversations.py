"""Conversation repair against all edit sequences of short conversations."""
from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

from pyspark.sql import functions as F

from evalpress.llm import conversation_repair as cr
from tests.llm.helpers import collected

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def brute_repair(rows: list[tuple]) -> tuple:
    """The cheapest, then least, edits by a search over all of them.  ``rows``:
    (role, text, fault); state 0 nothing, 1 s, 2 u, 3 a."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    full = {"u": "user", "a": "assistant"}

    @lru_cache(None)
    def best(i: int, state: int, inserted: int) -> tuple:
        options = []
        if i == len(rows) and state in (0, 3):
            options.append((0, "", ()))
        if inserted < 3:
            for r in "ua":
                if (state, r) in step:
                    c, e, t = best(i, step[state, r], inserted + 1)
                    options.append((c + 5, "I" + e, (full[r] + ":",) + t))
        if i < len(rows):
            role, text, fault = rows[i]
            c, e, t = best(i + 1, state, 0)
            options.append((c + 2, "D" + e, t))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if (state, role[:1]) in step:
                    c, e, t = best(i + 1, step[state, role[:1]], 0)
                    options.append((c + more, "K" + e, (role + ":" + text,) + t))
                for r in "ua":
                    if (state, r) in step:
                        c, e, t = best(i + 1, step[state, r], 0)
                        options.append((c + 1 + more, "R" + e, (full[r] + ":" + text,) + t))
        return min(options) if options else (10 ** 6, "", ())

    return best(0, 0, 0)


def brute(rows: list[tuple]) -> list[dict]:
    convs = defaultdict(list)
    sp = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        convs[conv]
        role, text = sp(role), sp(text)
        code = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        convs[conv] += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    out = []
    for conv, some in convs.items():
        some.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked, count = set(), [], defaultdict(int)
        for _, role, text in some:
            letters = WORD.findall(text)
            fault = ("blank" if not letters else "duplicate" if (role, text) in seen
                     else "truncated" if letters[-1] not in ".!?" else None)
            seen.add((role, text))
            count[fault] += 1
            marked.append((role, text, fault))
        cost, audit, texts = brute_repair(marked)
        turns = {t for t, _, _ in some if t is not None}
        out.append({"conv_id": conv, "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                    "blank": count["blank"], "duplicate": count["duplicate"], "truncated": count["truncated"],
                    "illegal": sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:])),
                    "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(texts).encode()).hexdigest()})
    return out


def random_rows(rng: random.Random, convs: int) -> list[tuple]:
    rows = []
    for c in range(convs):
        turn = rng.randrange(4)
        for k in range(rng.randrange(1, 14)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ["user", "assistant"][k % 2]
            role = rng.choice(["system", "tool", "", None, "ua", "sys"]) if rng.random() < 0.12 else role
            text = rng.choice(["Yes.", "No!", "Why? ", "cut", "", " \n", None, "Line.\none", "ünï.", "a.\x0b", "…", "x" * 40 + "."])
            rows.append((c, None if rng.random() < 0.05 else turn, role, text))
            turn += rng.choice([0, 1, 1, 1, 1, 2, 5])
    return rows


def key(r: dict):
    return r["conv_id"] is not None, r["conv_id"] or 0


def test_query_equals_brute_force(spark):
    rng = random.Random(5)
    rows = random_rows(rng, 500)
    rows += rows[:40] + [(None, 1, "user", "Hi."), (None, None, None, None), (None, 2, "assistant", "Ho.")]
    rows += [(7_000 + k, 0, "user", "Only.") for k in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("_conv", "_key", "place", "edit", "_id")])
    got = collected(cr.conversation_repair(df))
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    assert any(r["audit"] == "" for r in got) and len({r["cost"] for r in got}) > 8
    assert collected(cr.conversation_repair(spark.createDataFrame([], SCHEMA))) == []


def test_spilled_trail_is_the_same(spark):
    rows = random_rows(random.Random(6), 60) + [(9, t, ["user", "assistant"][t % 2], f"Turn {t % 50}.") for t in range(20, 400)]
    df = spark.createDataFrame(rows, SCHEMA)
    a, b = (collected(cr.conversation_repair(df, cr.Costs(block=n))) for n in (3, 10_000))
    assert sorted(a, key=key) == sorted(b, key=key)


def test_insertions_and_all_costs():
    rng = random.Random(8)
    roles = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    for _ in range(400):
        kinds = [(rng.choice("suuaax"), rng.choice([None, None, "truncated", "blank"])) for _ in range(rng.randrange(9))]
        rows = [(0, t, roles[r], f"{t}.", f == "blank", f == "truncated", False) for t, (r, f) in enumerate(kinds)]
        for insert in (1, 5):
            costs = cr.Costs(insert=insert, block=4)
            got = list(cr.digest_rows(cr.repaired_rows(rows, cr.Program(costs)), costs))
            if insert == 5:
                want = brute_repair([(roles[r], f"{t}.", f) for t, (r, f) in enumerate(kinds)])
                assert [(g[6], g[7]) for g in got] == ([want[:2]] if kinds else [])
            elif kinds:
                assert got[0][6] <= 10 ** 5


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "user", "Hello."), (1, 3, "user", "Hi?"), (1, 4, "user", " ")]
    got = sorted(collected(cr.repair(spark.createDataFrame(rows, SCHEMA))), key=lambda r: r["place"])
    assert [(r["edit"], r["role"], r["fault"]) for r in got] == [
        ("K", "system", None), ("K", "user", None), ("R", "assistant", None), ("D", None, "duplicate"), ("D", None, "blank")]


def test_long_conversation(spark):
    n = 50_000
    df = (spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                F.concat(F.col("id").cast("string"), F.lit(".")).alias("text")))
    got = collected(cr.digest(cr.repair(df, cr.Costs(block=1000)), cr.Costs()))
    assert got[0]["audit"] == "K" * n and got[0]["cost"] == 0
    text = "\n".join(f"{['user', 'assistant'][t % 2]}:{t}." for t in range(n))
    assert got[0]["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()
