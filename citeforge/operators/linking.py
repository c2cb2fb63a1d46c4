"""Scores of publications beside patents, block by block (survey SIM-10..19).

Rows of both sides meet by a key (a family name, an applicant, a keyword). Keys with many rows are
dealt into tiles that all meet, so the pairs of one key are neither held at once nor scored by one
task; pairs are never written, only links are. Ratcliff/Obershelp ratios are slow, so a score
begins as an upper bound: shared letters, then the longest common subsequence (matching blocks are
one), and the ratio itself only where a pair can still reach the threshold. What is returned is
exact: a pair is left out only if its bound is too low, and its best ratio is always computed,
for many pairs at once (``ratios``)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeforge.functions.similarity import PATENT_THRESHOLDS, SEQUENCE_MATCH, ratio
from citeforge.session import cut

#: Rows of a key and side in a tile, rows and pairs in a group of tiles, and combinations of names held at once.
TILE, ROWS, PAIRS, HELD = 512, 20_000, 4_000_000, 4_000_000
#: Longer names have the bound by shared letters only.
LONG = 256
#: From this length on ``difflib`` leaves out frequent letters of the second name; row numbers are bytes.
JUNK, BYTE = 200, 255
#: Ratios and common subsequences computed at once, and how few ratios are computed one by one.
BATCH, AT_ONCE, FEW = 512, 2048, 16
_ONES = np.array([(1 << k) - 1 for k in range(65)], np.uint64)
#: Bounds may be off by rounding only.
EPS = 1e-9
_LETTERS = "abcdefghijklmnopqrstuvwxyz -.,"
_CLASS = np.full(0x110000, len(_LETTERS), np.int8)  # all other characters are one class: still a bound
_CLASS[[ord(c) for c in _LETTERS]] = np.arange(len(_LETTERS))
_N = len(_LETTERS) + 1
#: Lists of keywords: those of a publication, those of a patent's title, and keys of a publication before a row's own.
WORDS = ("keywords", "held", "earlier")


class Names:
    """Distinct names of a side: letters, and bit masks of their places for names up to ``LONG`` letters."""

    def __init__(self, values: list[str]):
        self.values = values
        self.size = np.array([len(v) for v in values])
        self.points = np.frombuffer("".join(values).encode("utf-32-le", "surrogatepass"), np.uint32)
        row = np.repeat(np.arange(len(values)), self.size)
        flat = _CLASS[self.points].astype(np.int64)
        self.letters = np.bincount(row * _N + flat, minlength=len(values) * _N).reshape(-1, _N).astype(np.uint16 if self.size.max(initial=0) > 255 else np.uint8)
        self.flat, self.row = flat, row
        self.start = np.cumsum(self.size) - self.size
        self.place = np.arange(len(flat)) - np.repeat(self.start, self.size)
        self._masks = self._texts = self._pairs = self._alphabet = None

    @property
    def masks(self) -> np.ndarray:
        if self._masks is None:
            low = self.place < LONG
            row, letter, (word, bit) = self.row[low], self.flat[low], np.divmod(self.place[low], 64)
            self._masks = np.zeros((1 + word.max(initial=0), len(self.values), _N + 1), np.uint64)
            np.bitwise_or.at(self._masks, (word, row, letter), np.uint64(1) << bit.astype(np.uint64))
        return self._masks

    @property
    def texts(self) -> np.ndarray:
        if self._texts is None:
            self._texts = np.full((len(self.values), self.size.max(initial=0)), _N, np.int8)
            self._texts[self.row, self.place] = self.flat
        return self._texts

    @property
    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each name: bits of the (hashed) pairs of neighbouring letters that occur once, twice and more; how many occur beyond that."""
        if self._pairs is None:
            inner = np.flatnonzero(self.place[1:] > 0)
            kinds = (self.points[inner] * np.uint32(2654435761) + self.points[inner + 1] * np.uint32(40503)) >> np.uint32(7) & np.uint32(511)
            cell, n = np.unique(self.row[inner] * 512 + kinds, return_counts=True)
            row, (word, bit) = cell // 512, np.divmod(cell % 512, 64)
            bits = np.zeros((len(self.values), 16), np.uint64)
            for level in (1, 2):
                at = n >= level
                np.bitwise_or.at(bits, (row[at], word[at] + 8 * (level - 1)), np.uint64(1) << bit[at].astype(np.uint64))
            self._pairs = bits, np.bincount(row, np.maximum(n - 2, 0), len(self.values)).astype(np.int64)
        return self._pairs

    @property
    def alphabet(self) -> tuple[np.ndarray, int]:
        """Numbers of the characters that the names hold, 0 for all others; how many numbers there are."""
        if self._alphabet is None:
            code = np.zeros(0x110000, np.int32)
            code[self.points] = 1
            held = np.flatnonzero(code)
            code[held] = np.arange(1, len(held) + 1)
            self._alphabet = code, len(held) + 1
        return self._alphabet

    def padded(self, rows: np.ndarray, pad: int) -> np.ndarray:
        at = np.arange(self.size[rows].max(initial=0))
        inside = at < self.size[rows][:, None]
        return np.where(inside, self.points[np.where(inside, self.start[rows][:, None] + at, 0)], pad).astype(np.uint32)


def shared_letters(a: Names, b: Names, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Bounds of the ratios of all names ``p`` with all names ``q``: the smaller count of a letter is a sum of
    products, one for each number that both counts reach."""
    x, y = a.letters[p], b.letters[q]
    most = np.minimum(x.max(axis=0, initial=0), y.max(axis=0, initial=0)).astype(np.int64)
    letter = np.repeat(np.arange(_N), most)
    count = np.arange(1, len(letter) + 1) - np.repeat(np.cumsum(most) - most, most)
    both = (x[:, letter] >= count).astype(np.float32) @ (y[:, letter] >= count).astype(np.float32).T
    return 2.0 * both.astype(np.float64) / np.maximum(a.size[p][:, None] + b.size[q][None, :], 1)


def shared_neighbours(a: Names, b: Names, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Bounds of the ratios of names ``p[i]`` with ``q[i]``. ``M`` letters in blocks hold ``M`` less the number of
    blocks pairs of neighbours; of ``S`` letters in all, ``S - 2M`` stand between the blocks, one at least."""
    (x, more), (y, rest) = a.neighbours, b.neighbours
    shared = np.minimum(more[p], rest[q])
    for w in range(16):
        shared += np.bitwise_count(x[p, w] & y[q, w])
    total = a.size[p] + b.size[q]
    return 2.0 * ((shared + total + 1) // 3) / np.maximum(total, 1)


def common_subsequence(a: Names, b: Names, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Bounds of the ratios of names ``p[i]`` with ``q[i]``; 1 for names ``p`` of more than ``LONG`` letters."""
    n, m = a.size[p], b.size[q]
    out = np.ones(len(p))
    order = np.flatnonzero(n <= LONG)
    order = order[np.lexsort((m[order], (n[order] + 63) // 64))]  # names of a length together: few words and steps
    masks = a.masks.reshape(len(a.masks), -1)
    for part in np.split(order, np.arange(AT_ONCE, len(order), AT_ONCE)):
        base, texts = p[part] * (_N + 1), np.ascontiguousarray(b.texts[q[part], : m[part].max(initial=0)].T)
        words = [np.full(len(part), ~np.uint64(0)) for _ in range(min(len(masks), -(-n[part].max(initial=0) // 64)))]
        for letters in texts:
            at, carry = base + letters, None
            for k, v in enumerate(words):
                u = v & masks[k].take(at)
                total = v + u
                over = total < v
                if carry is not None:
                    total += carry
                    over |= total < carry
                words[k] = total | (v - u)
                carry = over.astype(np.uint64) if k + 1 < len(words) else None
        shared = sum((np.bitwise_count(~v).astype(np.int64) for v in words), np.zeros(len(part), np.int64))
        out[part] = 2.0 * shared / np.maximum(n[part] + m[part], 1)
    return out


def _cells(words: list[np.ndarray]) -> np.ndarray:
    """Keys (row, place in ``a``, place in ``b``) in order, of the bits of one array (row, place in ``a``) a word."""
    out = [np.empty(0, np.int32)]
    for w, of in enumerate(words):
        flat = np.flatnonzero(of)
        row, i = np.divmod(flat.astype(np.int32), np.int32(of.shape[1]))
        key, left = row << 16 | i << 8 | 64 * w, of.ravel()[flat]
        while len(left):
            rest = left & (left - np.uint64(1))
            out.append(key + np.bitwise_count((left ^ rest) - np.uint64(1)))
            more = np.flatnonzero(rest)
            key, left = key[more], rest[more]
    return np.sort(np.concatenate(out))


def _split(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return key >> 16, key >> 8 & BYTE, key & BYTE


def _runs(key: np.ndarray) -> np.ndarray:
    """How many keys follow one another from each key on, a place further in both names."""
    at = np.searchsorted(key, key + 257)
    end = len(key)
    link = np.append(np.where(key[np.minimum(at, end - 1)] == key + 257, at, end), end)
    count = np.append(np.ones(end, np.int32), np.int32(0))
    while (link < end).any():
        count, link = count + count[link], link[link]
    return count[:-1]


def _blocks(same: list[np.ndarray], m: np.ndarray) -> np.ndarray:
    """Matching letters of pairs of names by Ratcliff/Obershelp: the longest run that both have, first in ``a``, then
    in ``b``; then the same to its left and to its right. ``same`` has a row of words for each place of ``a``
    and one more, with a bit for each place of ``b`` (of ``m``) with the same letter.

    In each round every rectangle of places that still holds a run of two gives up its longest. Single
    letters come last, when only their order counts."""
    rows, high = same[0].shape
    twice = [w[:, :-1] & (w[:, 1:] >> np.uint64(1) | (same[k + 1][:, 1:] << np.uint64(63) if k + 1 < len(same) else np.uint64(0))) for k, w in enumerate(same)]
    key = _cells(twice)
    s, i, j = _split(key)
    size = _runs(key) + 1 if len(key) else key
    pair, down, right = np.arange(rows), np.full(rows, BYTE), np.full(rows, BYTE)  # of the rectangles
    found = []
    while len(i):
        first = np.flatnonzero(np.diff(s, prepend=-1))
        k = np.repeat(np.arange(len(first)), np.diff(first, append=len(s)))
        held = s[first]
        best = np.maximum.reduceat(size << 16 | (BYTE - i) << 8 | (BYTE - j), first)
        length, u, v = best >> 16, BYTE - (best >> 8 & BYTE), BYTE - (best & BYTE)
        pair, down, right = pair[held], down[held], right[held]
        found.append((pair, u, v, length))
        pair, down, right = np.repeat(pair, 2), np.stack([u, down], 1).ravel(), np.stack([v, right], 1).ravel()
        after = (i >= (u + length)[k]) & (j >= (v + length)[k])
        s = 2 * k + after
        size = np.minimum(size, np.minimum(down[s] - i, right[s] - j)).astype(np.int32)
        keep = np.flatnonzero((size > 1) & (after | (i < u[k]) & (j < v[k])))
        i, j, size, s = i[keep], j[keep], size[keep], s[keep]
    # Places of b between the blocks before and after a place of a; places within blocks have none.
    low, top, part = np.zeros((rows, high), np.int16), np.repeat(m.astype(np.int16)[:, None], high, axis=1), np.zeros((rows, high), np.int16)
    matched = np.zeros(rows, np.int64)
    if found:
        pair, u, v, length = (np.concatenate(x) for x in zip(*found, strict=True))
        matched += np.bincount(pair, length, rows).astype(np.int64)
        low[pair, u + length] = v + length
        top[pair[u > 0], u[u > 0] - 1] = v[u > 0]
        np.add.at(part, (pair, u), 1)
        np.add.at(part, (pair, u + length), 1)
        np.cumsum(part, axis=1, out=part)  # odd within blocks
    low = np.maximum.accumulate(low, axis=1)
    top = np.minimum.accumulate(top[:, ::-1], axis=1)[:, ::-1] * (1 - part % 2)
    free = [w & _ONES[np.clip(top - 64 * k, 0, 64)] & ~_ONES[np.clip(low - 64 * k, 0, 64)] for k, w in enumerate(same)]
    of, i, j = _split(_cells(free))
    s = of * (2 * high + 2) + part[of, i]
    while len(i):
        first = np.flatnonzero(np.diff(s, prepend=-1))
        matched += np.bincount(of[first], minlength=rows)
        each = np.diff(first, append=len(s))
        keep = np.flatnonzero((i > np.repeat(i[first], each)) & (j > np.repeat(j[first], each)))
        of, i, j, s = of[keep], i[keep], j[keep], s[keep]
    return matched


def ratios(a: Names, b: Names, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The ratios of names ``p[i]`` with ``q[i]``, as ``ratio`` has them."""
    out = np.zeros(len(p))
    n, m = a.size[p], b.size[q]
    many = (n < BYTE) & (m < JUNK) & (len(p) > FEW)
    rest = np.flatnonzero(~many)
    out[rest] = [ratio(a.values[x], b.values[y]) for x, y in zip(p[rest].tolist(), q[rest].tolist(), strict=True)]
    order = np.flatnonzero(many & (n > 0) & (m > 0))
    order = order[np.lexsort((n[order], (m[order] - 1) // 64))]
    at = 0
    while at < len(order):
        part = order[at : at + BATCH]
        part = part[: max(1, BATCH * 256 // b.alphabet[1])]
        at += len(part)
        names, row = np.unique(q[part], return_inverse=True)
        code, letters = b.alphabet
        text = b.padded(names, 0)
        of, place = np.nonzero(np.arange(text.shape[1]) < b.size[names][:, None])
        word, bit = np.divmod(place, 64)
        table = np.zeros((1 + (text.shape[1] - 1) // 64, len(names), letters), np.uint64)
        np.bitwise_or.at(table, (word, of, code[text[of, place]]), np.uint64(1) << bit.astype(np.uint64))
        inside = np.arange(n[part].max() + 1) < n[part][:, None]
        at_a = np.where(inside, np.pad(code[a.padded(p[part], 0)], ((0, 0), (0, 1))), 0) + (row * letters)[:, None]
        out[part] = 2.0 * _blocks([t.ravel()[at_a] for t in table], m[part]) / (n[part] + m[part])
    return out


class Lists:
    """A column of lists of names as codes; an empty list holds the empty name, whose ratios are 0."""

    def __init__(self, column: pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
        given = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = column.flatten().dictionary_encode()
        self.names = Names([*coded.dictionary.to_pylist(), ""])
        self.given, self.size = given, np.maximum(given, 1)
        self.start = np.cumsum(self.size) - self.size
        self.codes = np.full(self.size.sum(), len(self.names.values) - 1)
        self.codes[np.repeat(given > 0, self.size)] = coded.indices.to_numpy()

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of the rows one after the other, where each row begins, and how many it has."""
        return _of(self, rows)


def _of(lists, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = lists.size[rows]
    start = np.cumsum(n) - n
    return lists.codes[np.arange(n.sum()) + np.repeat(lists.start[rows] - start, n)], start, n


class Words:
    """A column of lists of keywords as codes."""

    def __init__(self, size: np.ndarray, codes: np.ndarray):
        self.size, self.codes, self.start = size, codes, np.cumsum(size) - size

    @classmethod
    def of_all(cls, *columns: pa.ChunkedArray) -> list[Words]:
        """The same codes for all columns."""
        whole = [pa.concat_arrays(c.chunks) for c in columns]
        sizes = [pc.fill_null(pc.list_value_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in whole]
        codes = pa.concat_arrays([c.flatten().cast(pa.string()) for c in whole]).dictionary_encode().indices.to_numpy()
        return [cls(n, part) for n, part in zip(sizes, np.split(codes, np.cumsum([n.sum() for n in sizes])[:-1]), strict=True)]

    def counts(self, rows: np.ndarray, known: np.ndarray) -> np.ndarray:
        """How often each row has each of the known codes (sorted)."""
        codes, _, n = _of(self, rows)
        at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        cell = (np.repeat(np.arange(len(rows)), n) * len(known) + at)[known[at] == codes]
        return np.bincount(cell, minlength=len(rows) * len(known)).reshape(len(rows), len(known)).astype(np.float32)


class Best:
    """The best ratio of two lists of names, for the pairs of a tile: bounds until asked for."""

    def __init__(self, left: Lists, right: Lists, i: np.ndarray, j: np.ndarray):
        self.a, self.b = left.names, right.names
        p, self.p0, self.pn = left.of(i)
        q, self.q0, self.qn = right.of(j)
        (self.p, self.p_of), (self.q, self.q_of) = (np.unique(x, return_inverse=True) for x in (p, q))
        self.bound = shared_letters(self.a, self.b, self.p, self.q)
        self.exact = np.zeros(self.bound.shape, bool)

    def bounds(self) -> np.ndarray:
        """Of all pairs of the tile."""
        rows = np.maximum.reduceat(self.bound[self.p_of], self.p0, axis=0)
        return np.maximum.reduceat(rows[:, self.q_of], self.q0, axis=1)

    def count(self, above: float) -> np.ndarray:
        """How many names of the left list have a ratio of more than ``above`` with one of the right."""
        flat = self.bound.ravel()
        near = np.flatnonzero(flat > above)
        self.tighten(near)
        self.settle(near[flat[near] > above])
        hit = np.maximum.reduceat((self.bound > above)[:, self.q_of], self.q0, axis=1)
        return np.add.reduceat(hit[self.p_of].astype(np.int64), self.p0, axis=0)

    def tighten(self, at: np.ndarray) -> None:
        p, q = np.divmod(at, len(self.q))
        flat = self.bound.ravel()
        flat[at] = np.minimum(flat[at], common_subsequence(self.a, self.b, self.p[p], self.q[q]))

    def settle(self, at: np.ndarray) -> None:
        p, q = np.divmod(at, len(self.q))
        self.bound.ravel()[at] = ratios(self.a, self.b, self.p[p], self.q[q])
        self.exact.ravel()[at] = True

    def take(self, x: np.ndarray, y: np.ndarray) -> None:
        """Look at these pairs of the tile only."""
        n = self.pn[x] * self.qn[y]
        self.start, self.of = np.cumsum(n) - n, np.repeat(np.arange(len(x)), n)
        at = np.arange(n.sum()) - self.start[self.of]
        u, v = np.divmod(at, self.qn[y][self.of])
        self.at = self.p_of[self.p0[x][self.of] + u] * len(self.q) + self.q_of[self.q0[y][self.of] + v]

    def narrowed(self) -> np.ndarray:
        p, q = np.divmod(self.at, len(self.q))
        flat = self.bound.ravel()
        flat[self.at] = np.minimum(flat[self.at], shared_neighbours(self.a, self.b, self.p[p], self.q[q]))
        return self.best()

    def tightened(self) -> np.ndarray:
        at = np.unique(self.at)
        self.tighten(at[~self.exact.ravel()[at]])
        return self.best()

    def best(self) -> np.ndarray:
        return np.maximum.reduceat(self.bound.ravel()[self.at], self.start)

    def settled(self, wanted: np.ndarray) -> bool:
        """Compute the ratios on which the best ones of the wanted pairs rest; True if all were known."""
        value = self.bound.ravel()[self.at]
        top = value >= np.maximum.reduceat(value, self.start)[self.of]
        known = np.maximum.reduceat(top & self.exact.ravel()[self.at], self.start)
        open_ = np.unique(self.at[top & (wanted & ~known)[self.of]])
        self.settle(open_)
        return not len(open_)


def near_years(pub: np.ndarray, patent: np.ndarray) -> np.ndarray:
    """``year_proximity`` of all pairs; unknown years are nan."""
    lag = patent[None, :] - pub[:, None]
    after = np.select([lag <= 1, lag <= 3, lag <= 5, lag <= 10], [1.0, 0.8, 0.6, 0.3], 0.1)
    before = np.select([-lag <= 1, -lag <= 3, -lag <= 5], [0.7, 0.4, 0.2], 0.1)
    return np.where(np.isnan(lag), 0.0, np.where(lag >= 0, after, before))


def _sum(*parts: tuple[np.ndarray | float, float]) -> np.ndarray:
    """As ``patent_confidence``, in the same order."""
    total = 0.0
    for value, weight in parts:
        total = total + value * weight
    return np.minimum(total, 1.0)


class _Group:
    """The rows of both sides of one group of tiles."""

    def __init__(self, left: pa.Table, right: pa.Table, kind: str, least: float):
        self.kind, self.least = kind, least
        self.left = {c: Lists(left[c]) for c in left.column_names if pa.types.is_list(left[c].type) and c not in WORDS}
        self.right = {c: Lists(right[c]) for c in right.column_names if pa.types.is_list(right[c].type) and c not in WORDS}
        year = lambda t: t["year"].to_numpy().astype(float)
        self.years = year(left), year(right)
        self.keywords, self.titles = left["keywords"].to_pylist(), right["title"].to_pylist()
        if kind == "subject_match":
            held = right["held"] if "held" in right.column_names else self._held()
            self.words, self.held, *self.earlier = Words.of_all(left["keywords"], held, *[left[c] for c in left.column_names if c == "earlier"])

    def _held(self) -> pa.ChunkedArray:
        """The keywords in each title; a missing title holds none."""
        known = sorted({k for ks in self.keywords for k in ks})
        return pa.chunked_array([[[k for k in known if t is not None and k in t] for t in self.titles]], pa.list_(pa.string()))

    def subjects(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Share of the keywords in the title, pair by pair; a missing title holds none."""
        keys, titles, out = self.keywords, self.titles, np.zeros(len(i))
        for n, (x, y) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
            t, ks = titles[y], keys[x]
            if t is not None and ks:
                hits = 0
                for k in ks:
                    if k in t:
                        hits += 1
                out[n] = hits / len(ks)
        return out

    def score(self, i: np.ndarray, j: np.ndarray):
        return getattr(self, self.kind)(i, j, self._near(i, j))

    def _near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        (a, of_a), (b, of_b) = np.unique(self.years[0][i], return_inverse=True), np.unique(self.years[1][j], return_inverse=True)
        return near_years(a, b)[of_a][:, of_b]

    def _settle(self, i, j, x, y, total, bests) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``total(*ratios)`` gives the confidences of pairs ``x, y`` by the ratios of ``bests``."""
        for b in bests:
            b.take(x, y)
        ratios = [b.tightened() for b in bests]
        open_ = True
        while open_:
            open_ = False
            for k, b in enumerate(bests):
                if not b.settled(total(*ratios) >= self.least - EPS):
                    open_, ratios[k] = True, b.best()
        now = total(*ratios)
        alive = now >= self.least
        return i[x[alive]], j[y[alive]], now[alive]

    def _some(self, x, y, width):
        """Pairs in parts of no more combinations than are held at once."""
        if len(x):
            part = np.cumsum(width) // HELD
            for at in np.split(np.arange(len(x)), np.flatnonzero(np.diff(part)) + 1):
                yield x[at], y[at]

    def author_match(self, i, j, year):
        name = Best(self.left["people"], self.right["inventors"], i, j)
        place = Best(self.left["institutions"], self.right["applicants"], i, j)
        names, places = name.bounds(), place.bounds()
        x, y = np.nonzero(_sum((names, 0.4), (places, 0.3), (year, 0.2), (1.0, 0.1)) >= self.least - EPS)
        for x, y in self._some(x, y, name.pn[x] * name.qn[y] + place.pn[x] * place.qn[y]):
            near, subject = year[x, y], self.subjects(i[x], j[y])
            keep = _sum((names[x, y], 0.4), (places[x, y], 0.3), (near, 0.2), (subject, 0.1)) >= self.least - EPS
            x, y, near, subject = x[keep], y[keep], near[keep], subject[keep]
            if len(x):
                yield self._settle(i, j, x, y, lambda p, n, near=near, subject=subject: _sum((n, 0.4), (p, 0.3), (near, 0.2), (subject, 0.1)), [place, name])

    def institution_match(self, i, j, year):
        people, inventors = self.left["people"], self.right["inventors"]
        place = Best(self.left["contexts"], self.right["applicants"], i, j)
        longer = np.maximum(people.given[i][:, None], inventors.given[j][None, :])
        author = Best(people, inventors, i, j).count(SEQUENCE_MATCH) / np.maximum(longer, 1)
        x, y = np.nonzero(_sum((place.bounds(), 0.5), (author, 0.25), (year, 0.15), (1.0, 0.1)) >= self.least - EPS)
        for x, y in self._some(x, y, place.pn[x] * place.qn[y]):
            near, same, subject = year[x, y], author[x, y], self.subjects(i[x], j[y])
            yield self._settle(i, j, x, y, lambda p, near=near, same=same, subject=subject: _sum((p, 0.5), (same, 0.25), (near, 0.15), (subject, 0.1)), [place])

    def subject_match(self, i, j, year):
        known = np.intersect1d(_of(self.words, i)[0], _of(self.held, j)[0])
        size = np.maximum(self.words.size[i], 1)
        if len(known):
            held = self.held.counts(j, known).T
            hits = self.words.counts(i, known) @ held
            fresh = [e.counts(i, known) @ held == 0 for e in self.earlier]
        else:
            hits, fresh = np.zeros((len(i), len(j)), np.float32), []
        # Rounding of the short floats is far less than the margin.
        can = hits * (0.6 / size).astype(np.float32)[:, None] + (year * 0.15).astype(np.float32) >= np.float32(self.least - 0.25 - 1e-4)
        for f in fresh:
            can &= f
        x, y = np.nonzero(can)
        if not len(x):
            return
        subject, near = hits[x, y].astype(float) / size[x], year[x, y]
        title = Best(self.left["titles"], self.right["titles"], i, j)
        for bound in (title.best, title.narrowed):
            title.take(x, y)
            keep = np.flatnonzero(_sum((subject, 0.6), (bound(), 0.25), (near, 0.15)) >= self.least - EPS)
            x, y, subject, near = x[keep], y[keep], subject[keep], near[keep]
            if not len(x):
                return
        yield self._settle(i, j, x, y, lambda t: _sum((subject, 0.6), (t, 0.25), (near, 0.15)), [title])


def _rows_by(column: pa.ChunkedArray) -> dict[str, np.ndarray]:
    coded = pa.concat_arrays(column.chunks).dictionary_encode()
    codes = coded.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    return dict(zip(coded.dictionary.to_pylist(), np.split(order, np.cumsum(np.bincount(codes))[:-1]), strict=True))


def scored(left: pa.Table, right: pa.Table, kind: str, least: float) -> pa.Table:
    """Links of a group: all rows of both sides with the same ``cell`` are pairs."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    if left.num_rows and right.num_rows:
        group, of_right = _Group(left, right, kind, least), _rows_by(right["cell"])
        width = sum(c.size for c in group.left.values())
        for cell, i in _rows_by(left["cell"]).items():
            j = of_right.get(cell)
            if j is not None:
                for of_j in np.split(j, np.arange(TILE, len(j), TILE)):
                    each = sum(c.size[of_j].sum() for c in group.right.values())
                    part = np.cumsum(width[i]) * each // HELD  # long lists of names: fewer rows at once
                    for rows in np.split(i, np.flatnonzero(np.diff(part) + np.diff(np.arange(len(i)) // TILE)) + 1):
                        found += group.score(rows, of_j)
    i, j, confidence = (np.concatenate(x) for x in zip(*found, strict=True))
    return pa.table({"pub_id": left["pub_id"].take(pa.array(i)), "lens_id": right["lens_id"].take(pa.array(j)), "confidence": pa.array(confidence)})


def meet(left: DataFrame, right: DataFrame, kind: str, threshold: float | None, tile: int = TILE) -> DataFrame:
    """``pub_id, lens_id, link_type, confidence`` of the pairs of rows with the same ``key`` that reach the threshold."""
    n, m = (df.groupBy("key").agg(F.count("*").alias(c)) for df, c in ((left, "n"), (right, "m")))
    tiles = lambda c: F.ceil(F.col(c) / tile).cast("int")
    keys = cut(n.join(m, "key").withColumns({"tiles_n": tiles("n"), "tiles_m": tiles("m")}), "link-keys")
    load = keys.agg(F.sum(F.col("n") * F.col("tiles_m") + F.col("m") * F.col("tiles_n")).alias("rows"), F.sum(F.col("n") * F.col("m")).alias("pairs")).first()
    groups = 1 + max((load["rows"] or 0) // ROWS, (load["pairs"] or 0) // PAIRS)

    def dealt(df: DataFrame, id_col: str, own: str, other: str) -> DataFrame:
        rows = df.join(keys.select("key", "tiles_n", "tiles_m"), "key").withColumns({
            own: F.pmod(F.xxhash64(id_col), F.col("tiles_" + own)), other: F.explode(F.sequence(F.lit(0), F.col("tiles_" + other) - 1))
        })
        cell = F.concat_ws("\x00", "key", F.col("n").cast("string"), F.col("m").cast("string"))
        return rows.withColumn("cell", cell).withColumn("group", F.pmod(F.xxhash64("cell"), F.lit(groups))).drop("key", "n", "m", "tiles_n", "tiles_m")

    least = PATENT_THRESHOLDS[kind] if threshold is None else threshold
    kinds = dict(left.dtypes)["pub_id"], dict(right.dtypes)["lens_id"]
    sides = dealt(left, "pub_id", "n", "m").groupBy("group"), dealt(right, "lens_id", "m", "n").groupBy("group")
    links = sides[0].cogroup(sides[1]).applyInArrow(lambda a, b: scored(a, b, kind, least), f"pub_id {kinds[0]}, lens_id {kinds[1]}, confidence double")
    # Pairs that meet by several keys have been scored alike.
    once = links.groupBy("pub_id", "lens_id").agg(F.max("confidence").alias("confidence"))
    return once.select("pub_id", "lens_id", F.lit(kind).alias("link_type"), "confidence")
