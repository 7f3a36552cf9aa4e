"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

The encoding of a text has a unique last token at every prefix.  For each
prefix end, an automaton over the vocabulary gives all tokens that end there;
the one that may follow the stored last token of the shorter prefix is stored.
Back-pointers from the end emit the ids.
"""
from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from evalpress.llm.common import bounded_batches, tidy

END = "\0"  # stands for the end-of-word mark in vocabulary strings
NEVER = 1 << 60


def byte_chars() -> list[str]:
    """The printable character of each byte in byte-level vocabularies (fixed
    by the format): itself if printable in Latin-1, else the next free one
    from code point 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = [""] * 256, 256
    for b in range(256):
        if b in own:
            out[b] = chr(b)
        else:
            out[b], free = chr(free), free + 1
    return out


class PrefixBpe:
    """A vocabulary with ranked merges, encoded by per-prefix back-pointers."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = "</w>"):
        inner = lambda t: t[:-len(suffix)] + END if suffix and t.endswith(suffix) and t != suffix else t
        self.suffix = suffix
        self.id = {inner(t): i for t, i in vocab.items()}
        self.text = {i: t for t, i in vocab.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.born: dict[int, tuple[int, int, int]] = {}  # token -> (rank, left, right)
        for r, (a, b) in enumerate(merges):
            x, y = self.id[inner(a)], self.id[inner(b)]
            self.rank[x, y] = r
            t = self.id.get(inner(a + b))
            if t is not None:
                self.born.setdefault(t, (r, x, y))
        self.fits: dict[tuple[int, int], bool] = {}
        self.right: dict[int, tuple] = {}
        self.left: dict[int, tuple] = {}
        self.match = ahocorasick.Automaton()
        for t, i in self.id.items():
            if i in self.born or len(t.rstrip(END)) == 1:
                self.match.add_word(t, (i, len(t)))
        self.match.make_automaton()

    def _edge(self, token: int, side: int, known: dict[int, tuple]) -> tuple:
        """(part, rank at which a merge takes it in) along one edge of the
        token's merge tree, from the whole token down to its outer symbol."""
        got = known.get(token)
        if got is None:
            out, t, until = [], token, NEVER
            while True:
                out.append((t, until))
                made = self.born.get(t)
                if made is None:
                    break
                until, t = made[0], made[side]
            got = known[token] = tuple(out)
        return got

    def may_follow(self, first: int, then: int) -> bool:
        """Whether the two tokens stay apart when their texts are encoded
        together: no merge across the border comes before both of its parts
        are taken into their own token (leftmost first among equal ranks)."""
        got = self.fits.get((first, then))
        if got is None:
            got, rank = True, self.rank
            heads = self._edge(then, 1, self.left)
            for a, until_a in self._edge(first, 2, self.right):
                for b, until_b in heads:
                    r = rank.get((a, b))
                    if r is not None and r < until_a and r <= until_b:
                        got = False
                        break
                if not got:
                    break
            if len(self.fits) > 2_000_000:
                self.fits.clear()
            self.fits[first, then] = got
        return got

    def encode_word(self, word: str) -> list[int]:
        """Ids of one pre-token given in byte characters."""
        s = word + END if self.suffix else word
        whole = self.id.get(s)
        if whole is not None and (whole in self.born or len(word) == 1):
            return [whole]
        last: list[tuple[int, int] | None] = [None] * (len(s) + 1)
        fits = self.may_follow
        for end, (token, size) in self.match.iter(s):
            end += 1
            if last[end] is None:
                before = end - size
                if before == 0 or last[before] is not None and fits(last[before][0], token):
                    last[end] = (token, before)
        out, at = [], len(s)
        while at:
            token, at = last[at]
            out.append(token)
        return out[::-1]


#: code points below this stay below it in lower case, and every Unicode
#: version agrees on their classes
USUAL = 0x180


class WordCodec:
    """A tokenizer file with lower-casing, a word pattern and word ends.

    Texts of usual characters are split here; others by the library's own
    normalizer and pre-tokenizer, whose Unicode tables may differ from ours.
    At most ``words`` encoded words are remembered."""

    def __init__(self, path: str, words: int = 300_000):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pair = lambda m: tuple(m.split(" ")) if isinstance(m, str) else tuple(m)
        self.bpe = PrefixBpe(model["vocab"], [pair(m) for m in model["merges"]], model["end_of_word_suffix"] or "")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        for name, start in (("\\p{L}", "L"), ("\\p{N}", "N")):  # only ever inside brackets
            have = "".join(chr(c) for c in range(USUAL) if unicodedata.category(chr(c))[0] == start)
            pattern = pattern.replace(name, re.escape(have))
        self.find = re.compile(pattern).findall
        self.usual = re.compile(f"[\\x00-\\x1b\\x20-{chr(USUAL - 1)}]*").fullmatch
        self.space = re.compile(r"\s+")
        self.chars = byte_chars()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bpe.text.update({i: t for t, i in self.special.items()})
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.library = Tokenizer.from_file(path)
        self.words = words
        self.ids: dict[str, bytes] = {}
        self.back: dict[str, str] = {}

    def pre_tokens(self, text: str) -> list[str]:
        """Words of a text: composed, lower-cased, cut by the file's pattern."""
        if self.usual(text):
            return self.find(self.space.sub(" ", unicodedata.normalize("NFC", text)).lower())
        text = self.library.normalizer.normalize_str(text)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder: token strings joined by a space."""
        return " ".join([self.bpe.text[i] for i in ids])

    def _learn(self, words: set[str], raw: bool) -> None:
        new = [w for w in words if w not in self.ids]
        if len(self.ids) + len(new) > self.words:
            self.ids.clear()
            self.back.clear()
            new = list(words)
        chars = self.chars
        for w in new:
            got = self.bpe.encode_word("".join([chars[b] for b in w.encode()]) if raw else w[1:])
            self.ids[w] = struct.pack(f"<{len(got)}I", *got)
            self.back[w] = self.decode(got)

    def run(self, text: str) -> tuple[bytes, str]:
        """(ids as little-endian unsigned 32-bit bytes, decoded text)."""
        ids: list[bytes] = []
        back: list[str] = []
        for part in self.cut.split(text) if self.cut and "<" in text else [text]:
            if part in self.special:
                i = self.special[part]
                ids.append(struct.pack("<I", i))
                back.append(self.decode([i]))
                continue
            found, raw = self.pre_tokens(part), bool(self.usual(part))
            if not raw:  # already in byte characters: a key of their own
                found = ["\x1f" + w for w in found]
            step = self.words // 2
            for at in range(0, len(found), step):
                chunk = found[at:at + step]
                self._learn(set(chunk), raw)
                ids.append(b"".join(map(self.ids.__getitem__, chunk)))
                back.append(" ".join(map(self.back.__getitem__, chunk)))
        return b"".join(ids), " ".join(back)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  full: bool = False) -> DataFrame:
    """Ids of every text and the text that they decode to.

    Returns the id, n_tokens, ids_sha256, decoded_sha256, and with ``full``
    also the ids (array<int>) and the decoded text.  A null text counts as an
    empty one (no ids, empty decoded text); null ids, repeated rows and an
    empty table pass through; extra columns are ignored.  Row by row, no
    shuffle."""

    def run(batches):
        codec = WordCodec(path)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for b in batches:
            n, a, d, ids_out, back_out = [], [], [], [], []
            for text in b.column(1).to_pylist():
                ids, back = codec.run(text or "")
                n.append(len(ids) // 4)
                a.append(sha(ids))
                d.append(sha(back.encode()))
                if full:
                    ids_out.append(np.frombuffer(ids, "<i4"))
                    back_out.append(back)
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if full:
                cols += [pa.array(ids_out, pa.list_(pa.int32())), pa.array(back_out, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    src = bounded_batches(docs.select(id_col, text_col))
    kind = src.schema[id_col].dataType.simpleString()
    more = ", ids array<int>, decoded string" if full else ""
    return src.mapInArrow(tidy(run), f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
