"""Compression bands: zstandard ratios of whole texts and fixed chunks.

Repetitive text compresses far better than prose, random text far worse.  The
accepted band depends on the length, because short inputs compress worse.
"""
from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from evalpress.llm.common import bounded_batches, tidy


@dataclass(frozen=True)
class Bands:
    """(bytes below, least ratio, greatest ratio) by ascending length; the last
    band holds for all longer texts.  ``chunk`` bytes per chunk; a text fails
    if more than ``bad_share`` of its chunks leave the band of their length."""

    bands: tuple[tuple[float, float, float], ...] = (
        (100, 0.0, 9.0), (300, 0.35, 1.15), (1000, 0.30, 0.85), (4000, 0.22, 0.72),
        (16000, 0.16, 0.65), (float("inf"), 0.10, 0.65))
    chunk: int = 4096
    chunk_bands: tuple[tuple[float, float, float], ...] = (
        (100, 0.0, 9.0), (300, 0.30, 1.15), (1000, 0.25, 0.85), (float("inf"), 0.18, 0.72))
    bad_share: float = 0.34
    level: int = 3


WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"


def ratio(comp: zstandard.ZstdCompressor, data: bytes) -> float:
    return len(comp.compress(data)) / len(data)


def outside(bands: tuple[tuple[float, float, float], ...], size: int, value: float) -> bool:
    for below, least, most in bands:
        if size < below:
            return not least <= value <= most
    return False


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """(words, characters in words, symbols, repeated lines, words in 3-word
    windows that occur twice or more)."""
    words = WORD.findall(text)
    n = len(words)
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    repeat = 0
    if n >= 4:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            often = Counter(windows)
            end = 0  # first word not yet counted
            for i, w in enumerate(windows):
                if often[w] > 1:
                    repeat += i + 3 - max(i, end)
                    end = i + 3
    return n, sum(map(len, words)), sum(map(text.count, SYMBOLS)), dup, repeat


def judge(text: str, conf: Bands, comp: zstandard.ZstdCompressor) -> dict:
    n, chars, symbols, dup, repeat = base_counts(text)
    failed = n < 50 or 100 * repeat > 50 * n
    data = text.encode("utf-8", "surrogatepass")
    whole, chunks, bad = None, 0, 0
    if data:
        whole = ratio(comp, data)
        for at in range(0, len(data), conf.chunk):
            part = data[at:at + conf.chunk]
            chunks += 1
            bad += outside(conf.chunk_bands, len(part), ratio(comp, part))
    odd = bool(data) and (outside(conf.bands, len(data), whole) or bad > conf.bad_share * chunks)
    return {"n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup,
            "n_repeat_words": repeat, "base_failed": failed, "kept": not failed and not odd,
            "zstd_ratio": whole, "n_chunks": chunks, "n_bad_chunks": bad}


RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, zstd_ratio double, n_chunks long, n_bad_chunks long")
_ARROW = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
          ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
          ("kept", pa.bool_()), ("zstd_ratio", pa.float64()), ("n_chunks", pa.int64()), ("n_bad_chunks", pa.int64())]


def quality_rules(docs: DataFrame, conf: Bands = Bands(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, counts and the verdict.

    A null text counts as an empty one (no words: fails the base rule);
    repeated rows and null ids give one row each; other columns of ``docs``
    are not read, whatever their names.  Row by row, nothing is shuffled."""

    def run(batches):
        comp = zstandard.ZstdCompressor(level=conf.level)
        for b in batches:
            rows = [judge(t or "", conf, comp) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0)] + [pa.array([r[k] for r in rows], kind) for k, kind in _ARROW],
                names=[id_col] + [k for k, _ in _ARROW])

    src = bounded_batches(docs.select(id_col, text_col))
    kind = src.schema[id_col].dataType.simpleString()
    return src.mapInArrow(tidy(run), f"`{id_col}` {kind}, {RESULT}")
