"""Encoding by a byte-level BPE vocabulary with a tokenization automaton (problem 7).

The merge list is compiled, merge by merge, into a deterministic automaton whose arcs are
labelled with tokens and whose paths are exactly the correct tokenizations. A merge
``(u, v) -> uv`` of rank ``m`` adds one gadget: an arc ``uv`` beside every path ``u v``, and
the removal of ``v`` behind ``u``. An arc of a longer token stands for the arcs it was merged
from: its right spine (the token, its right part, the right part of that ...) and its left
spine each give the pieces that meet at a token border, with the span of ranks in which they
were there. So arc ``y`` leaves the state behind arc ``x`` exactly if no gadget of a rank in
both spans joins the two spines; a state is determined by the last arc. The transition table
``(x, y) -> allowed`` is filled on demand from the gadgets and kept.

Every prefix of a word has one correct tokenization, so encoding is one left-to-right pass:
from each position the byte trie is followed as far as it goes and the one allowed arc that
reaches a later position is noted there. Following the noted arcs back emits their labels.
A word of ``n`` bytes costs ``O(n * longest token)``; nothing is re-merged.

Defined cases: null and empty texts have the empty list; special tokens' strings in a text
are ordinary text; texts are encoded whole, of any length.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: The split of a text into words before the merges (fixed value of the vocabulary).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "byte_bpe_50k.json"
#: Words a worker keeps encoded; the cache is emptied when full, results do not depend on it.
CACHE_WORDS = 400_000
NEVER = 1 << 40


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Place of a public vocabulary file: the installed package, else its usual folder."""
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return os.path.join("/opt/tokenizers", name)


def printable_bytes() -> dict[str, int]:
    """The vocabulary file writes each byte as one printable character: bytes that are
    printable in Latin-1 stand for themselves, the others follow from U+0100 in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Automaton:
    """The tokenization automaton of a merge list."""

    def __init__(self, merges: list[tuple[bytes, bytes]], ids: dict[bytes, int]):
        self.text: dict[int, bytes] = {}
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.gadgets: dict[int, int] = {}
        self.allowed: dict[int, bool] = {}
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.left: dict[int, list[tuple[int, int]]] = {}
        self.trie: dict = {}
        for b in range(256):
            if bytes([b]) in ids:
                self._arc(ids[bytes([b])], bytes([b]), -1)
        for m, (u, v) in enumerate(merges):
            self._gadget(m, ids[u], ids[v], ids[u + v], u + v)
        self.words: dict[str, tuple[int, ...]] = {}
        self.split = regex.compile(SPLIT).findall

    def _arc(self, token: int, text: bytes, rank: int) -> None:
        self.text[token], self.rank[token] = text, rank
        node = self.trie
        for b in text:
            node = node.setdefault(b, {})
        node[-1] = token

    def _gadget(self, m: int, u: int, v: int, uv: int, text: bytes) -> None:
        self.gadgets[u << 20 | v] = m
        if uv not in self.rank and u in self.rank and v in self.rank and self._joins(u, v, m):
            self.parts[uv] = (u, v)
            self._arc(uv, text, m)

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """Pieces at one end of an arc and the rank at which each was merged away."""
        kept = (self.left, self.right)[side]
        spine = kept.get(token)
        if spine is None:
            spine, piece, gone = [], token, NEVER
            while True:
                spine.append((piece, gone))
                if piece not in self.parts:
                    break
                gone, piece = self.rank[piece], self.parts[piece][side]
            kept[token] = spine
        return spine

    def _joins(self, x: int, y: int, until: int) -> bool:
        """True if no gadget of a rank below ``until`` merges across the border of x and y.

        At one rank the leftmost pair goes first: a merge across the border loses against
        one of the same rank inside x, and wins against one inside y."""
        gadget = self.gadgets.get
        for a, a_gone in self._spine(x, 1):
            for b, b_gone in self._spine(y, 0):
                m = gadget(a << 20 | b)
                if m is not None and m < until and m < a_gone and m <= b_gone:
                    return False
        return True

    def _follows(self, x: int, y: int) -> bool:
        key = x << 20 | y
        ok = self.allowed.get(key)
        if ok is None:
            ok = self.allowed[key] = self._joins(x, y, NEVER)
        return ok

    def word(self, raw: bytes) -> tuple[int, ...]:
        n = len(raw)
        arc = [-1] * (n + 1)
        trie, follows = self.trie, self._follows
        for i in range(n):
            x, node = arc[i], trie
            if i and x < 0:
                continue
            for j in range(i, n):
                node = node.get(raw[j])
                if node is None:
                    break
                y = node.get(-1)
                if y is not None and arc[j + 1] < 0 and (i == 0 or follows(x, y)):
                    arc[j + 1] = y
        labels, i = [], n
        while i:
            y = arc[i]
            labels.append(y)
            i -= len(self.text[y])
        return tuple(reversed(labels))

    def _known(self, piece: str) -> tuple[int, ...]:
        if len(self.words) >= CACHE_WORDS:
            self.words.clear()
        if len(self.allowed) >= 4 * CACHE_WORDS:
            self.allowed.clear()
        ids = self.words[piece] = self.word(piece.encode("utf-8", "surrogatepass"))
        return ids

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        extend, get, known = out.extend, self.words.get, self._known
        for piece in self.split(text or ""):
            extend(get(piece) or known(piece))
        return out

    def count(self, text: str | None) -> int:
        get, known = self.words.get, self._known
        return sum([len(get(piece) or known(piece)) for piece in self.split(text or "")])

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.text[i] for i in ids).decode("utf-8", "replace")


_LOADED: dict[str, Automaton] = {}


def automaton(path: str | None = None) -> Automaton:
    """The compiled automaton of a vocabulary file, once per process."""
    path = path or vocabulary_path()
    if path not in _LOADED:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        back = printable_bytes()
        raw = lambda s: bytes(back[c] for c in s)
        ids = {raw(s): i for s, i in model["vocab"].items() if all(c in back for c in s)}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        _LOADED[path] = Automaton([(raw(a), raw(b)) for a, b in pairs], ids)
    return _LOADED[path]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``id_col, ids``: the token ids of every text. Rows stay where they are: no shuffle."""
    schema = T.StructType([docs.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]):
        a = automaton(path)
        for batch in batches:
            # In slices, so that few very long texts never make one huge output batch.
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                lists = [a.encode(t) for t in part.column(1).to_pylist()]
                offsets = np.zeros(len(lists) + 1, np.int32)
                np.cumsum([len(x) for x in lists], out=offsets[1:])
                flat = np.fromiter((i for x in lists for i in x), np.int32, int(offsets[-1]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[id_col, "ids"]
                )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``id_col, text``: the texts of token ids, by emitting the label of every arc. The empty list gives
    the empty text, a null list null; bytes that are no text come out as replacement characters."""
    schema = T.StructType([encoded.schema[id_col], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]):
        a = automaton(path)
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                texts = [None if ids is None else a.decode(ids) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return encoded.select(id_col, ids_col).mapInArrow(run, schema)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), path: str | None = None) -> DataFrame:
    """``id_col, keep..., n_tokens``: only the number of tokens of every text."""
    names = [id_col, *keep]
    schema = T.StructType([*[docs.schema[c] for c in names], T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]):
        a = automaton(path)
        for batch in batches:
            sizes = pa.array([a.count(t) for t in batch.column(len(names)).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], sizes], names=[*names, "n_tokens"])

    return docs.select(*names, text_col).mapInArrow(run, schema)
