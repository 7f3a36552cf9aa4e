"""Packing of token sequences: first-fit decreasing over a tournament tree.

Documents are cut into pieces, the pieces are dealt into randomised groups of
documents, and every group is packed on its own.
"""
from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalpress.llm.bpe_codec import byte_chars
from evalpress.llm.common import bounded_batches, tidy

#: pre-tokens of the byte-level vocabulary (fixed pattern of its file format)
PATTERN = r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class TokenBytes:
    """Ids of a text as little-endian unsigned 32-bit bytes, as the tokenizers
    library gives them for the file at ``path`` without its post-processor.

    The file's vocabulary, whose ids are merge ranks, is handed to tiktoken,
    which gives the same ids several times faster; texts of ``long`` characters
    or more go to the tokenizers library itself.  A special string in a text
    is its special token."""

    def __init__(self, path: str, long: int = 300_000):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        back = {c: b for b, c in enumerate(byte_chars())}
        ranks = {bytes([back[c] for c in t]): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.exact = Tokenizer.from_file(path)
        self.long = long

    def plain(self, text: str) -> bytes:
        if len(text) >= self.long:
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if self.cut is None or "<" not in text:
            return self.plain(text)
        return b"".join(self.special[p] if p in self.special else self.plain(p) for p in self.cut.split(text) if p)


def pieces(total: int, size: int, unit: int) -> Iterator[tuple[int, int]]:
    """(start, length): full sequences first, then the rest as a piece of whole
    units and one of less than a unit, which fills gaps."""
    at = 0
    while total - at >= size:
        yield at, size
        at += size
    rest = total - at
    for n in (rest // unit * unit, rest % unit):
        if n:
            yield at, n
            at += n


class Tournament:
    """Leaves are bins in the order they were opened; an inner node has the
    greater room of its two children, so the first bin with enough room is
    found from the root in log time."""

    def __init__(self, bins: int, size: int):
        self.width = 1 << max(0, bins - 1).bit_length()
        self.room = [size] * (2 * self.width)

    def place(self, length: int) -> int:
        room, node = self.room, 1
        while node < self.width:
            node *= 2
            if room[node] < length:
                node += 1
        leaf = node - self.width
        room[node] -= length
        node >>= 1
        while node:
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
            node >>= 1
        return leaf


def first_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece."""
    order = np.argsort(-lengths, kind="stable")
    tree = Tournament(len(lengths), size)
    where = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    used = np.zeros(len(lengths) + 1, np.int64)
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        b = tree.place(n)
        where[i], offset[i] = b, used[b]
        used[b] += n
    return where, offset


def cut_documents(docs: DataFrame, path: str, eos: int, size: int, unit: int) -> DataFrame:
    """(doc_id, _mix, start, length, ids_crc32, doc_tokens) per piece; every
    document has its end token, so an empty or null text gives one piece."""
    end = np.array([eos], "<u4").tobytes()

    def run(batches):
        tok = TokenBytes(path)
        for b in batches:
            rows: list[tuple] = []
            for i, text in enumerate(b.column(1).to_pylist()):
                ids = tok.ids(text or "") + end
                total = len(ids) // 4
                for start, n in pieces(total, size, unit):
                    rows.append((i, start, n, zlib.crc32(ids[4 * start:4 * (start + n)]), total))
            cols = np.array(rows, np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(cols[0])), b.column(2).take(pa.array(cols[0]))] + [pa.array(c) for c in cols[1:]],
                names=["doc_id", "_mix", "start", "length", "ids_crc32", "doc_tokens"])

    src = bounded_batches(docs).select("doc_id", "text", F.xxhash64(F.lit(11), "doc_id", "text").alias("_mix"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(tidy(run), f"doc_id {kind}, _mix long, start long, length long, ids_crc32 long, doc_tokens long")


def pack(docs: DataFrame, path: str, eos: int = 1, size: int = 2048, unit: int = 256,
         group_docs: int = 8192, block: int = 64) -> DataFrame:
    """Pack every document into sequences of at most ``size`` tokens.

    Returns one row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.  The groups are drawn by a hash of the document, about
    ``group_docs`` documents each, and a group is packed by one task; only piece
    lengths are shuffled, never texts or ids.  Rows that repeat id and text would
    all have one hash: their pieces are counted first, and each ``block`` of the
    copies draws a group of its own, so no group grows with them.  Null texts are empty ones; rows without an id and repeated
    rows are packed like any other; an empty table gives no rows; extra columns
    are ignored.  Pieces of equal length keep (doc_id, start) order."""
    groups = max(1, -(-docs.count() // group_docs))
    cut = cut_documents(docs, path, eos, size, unit)
    copies = cut.groupBy(*cut.columns).agg(F.count("*").alias("_n"))
    blocks = copies.select("*", F.explode(F.sequence(F.lit(0), F.col("_n") - 1, F.lit(block).cast("long"))).alias("_from"))
    cut = blocks.select(*cut.columns, F.least(F.col("_n") - F.col("_from"), F.lit(block)).alias("_copies"),
                        F.pmod(F.xxhash64("_mix", "_from"), F.lit(groups)).alias("_group"))
    key = cut.schema["doc_id"]
    out = T.StructType([key] + [T.StructField(c, T.LongType()) for c in
                                ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.loc[g.index.repeat(g["_copies"])].sort_values(["doc_id", "start", "ids_crc32", "length"], kind="stable")
        where, offset = first_fit_decreasing(g["length"].to_numpy(np.int64), size)
        return g.assign(sequence_id=(int(g["_group"].iloc[0]) << 32) + where, offset=offset)[[f.name for f in out]]

    return cut.groupBy("_group").applyInPandas(run, out)
