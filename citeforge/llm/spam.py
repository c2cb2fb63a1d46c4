"""Keyword-stuffed and link-list pages (problem 9).

Counts over the whole corpus (documents that hold a word, and a pair of neighbouring words; every
text counts, however short) give the pointwise mutual information of every neighbouring pair.
A page is *list-like* if little of it is running text: sentences of five words or more, links and
markup left out. The mean mutual information is measured of every page of two words or more. Pages of which less
than ``JUDGED`` is running text, pages with many repeated collocations, and all pages whose mean lies outside what
running text shows are judged: others read as text and can't be mainly keywords, links or tags that repeat. A list-like page is a seed if its collocations are repeated beyond measure (``repeats``: the
share of its neighbouring pairs that the page has had before), or if it consists of links or
tags, or if its mean mutual information lies outside what running text shows: far below it
the words are salad, far above it they are stock phrases strung together. What running text shows
is taken from the judged pages that have some: their median, give or take ``SPREAD`` median deviations.

The seeds then tell which words such pages are made of: over all documents, each word gets
the log odds of standing on a seed page. Judged pages whose words speak for spam on the
whole are flagged, so that sentences made of keywords only are found as well. Reference lists, contents lists, tables and bare titles are list-like too,
but consist of the words of the domain. Pages of few words count as partly of the domain (``PRIOR_WORDS``).
Spam is what lies ``OUTSIDE`` deviations above the median of the list-like pages that are no seeds, most of which
are of the domain; the deviation is the median one, so that spam among them does not move the bound.

One Arrow pass reads the texts and emits per-document measures, counts already summed per
batch, and for every page its pairs and words; everything later works on these small rows.
Words have two letters or more, links are one word of their own; counts are of hashes of 64 bits.

Defined cases: null, empty, blank and wordless texts are never flagged, nor is anything where no
page is a seed; long texts are read whole; copies are judged alike; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeforge.session import cut

#: A page with less running text than this is list-like.
RUNNING_TEXT = 0.3
REPEATS = 0.3
LINKS = 0.3
#: Pages with less running text than this are judged.
JUDGED = 0.6
#: Median deviations of the mean mutual information beyond which a page is incoherent or stock phrases.
SPREAD = 3
#: Median deviations of the log odds, as standard ones (a fixed factor), beyond which a page is spam.
OUTSIDE = 5 * 1.4826
#: Words of the domain that every page is taken to have besides its own.
PRIOR_WORDS = 10
LINK = "\x01"

_TOKEN = re.compile(r"https?://[^\s)\"'>\]]+|#[^\W_]\w*|[^\W\d_]{2,}", re.I)
_MARKUP = re.compile(r"https?://[^\s)\"'>\]]+|<[^<>]*>|\]\([^)]*\)", re.I)
_STOP = re.compile(r"([.!?]+(?=[\"”’)\]]*(?:\s|$))|[。？！]+|\n)")
_DENSE = re.compile("[぀-ヿ㐀-鿿]")


def tokens(text: str) -> list[str]:
    return [LINK if "://" in w[:9] else w for w in _TOKEN.findall(text.lower())]


def running_text(text: str) -> float:
    """Share of a text, blanks left out, that stands in sentences of five words or more."""
    plain = _MARKUP.sub(" ", text) if "<" in text or "://" in text or "](" in text else text
    letters = sum(map(len, text.split()))
    if not letters:
        return 0.0
    inside = 0
    parts = _STOP.split(plain)
    # Pieces and what ends them take turns; a line break or the end ends no sentence.
    for piece, stop in zip(parts[::2], parts[1::2], strict=False):
        if stop != "\n":
            words = piece.split()
            if len(words) >= 5 or _DENSE.search(piece):
                inside += sum(map(len, words)) + len(stop)
    return inside / letters


class _Reader:
    """Measures of one batch of documents."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def hashed(self, words: list[str]) -> np.ndarray:
        known, out = self.known, []
        if len(known) > 500_000:
            known.clear()
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w) - (1 << 63)
            out.append(h)
        return np.array(out, np.int64)

    @staticmethod
    def pairs(h: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return h[:-1] * np.int64(-7046029254386353131) ^ (h[1:] + (h[1:] << np.int64(31)))


#: Rows of pages' pairs and words that are held at once.
HELD = 500_000
#: Row kinds of the pass: a document, a word count, a pair count, and a page's pairs and words.
DOC, WORD, PAIR, PAGE_PAIR, PAGE_WORD = range(5)
_COLUMNS = ["kind", "doc_id", "h", "a", "b", "n", "text_share", "repeats", "links"]


def _scan(batches: Iterator[pa.RecordBatch], id_type: pa.DataType):
    reader = _Reader()
    words_seen: list[tuple[np.ndarray, ...]] = []
    pairs_seen: list[tuple[np.ndarray, ...]] = []
    held = 0

    def rows(kind, n_rows, doc=None, **given):
        cols = {
            "kind": pa.array(np.full(n_rows, kind, np.int8)),
            "doc_id": doc if doc is not None else pa.nulls(n_rows, id_type),
        }
        for c in _COLUMNS[2:]:
            kind_of = pa.float64() if c in ("text_share", "repeats", "links") else pa.int64()
            cols[c] = pa.array(given[c], kind_of) if c in given else pa.nulls(n_rows, kind_of)
        return pa.RecordBatch.from_arrays([cols[c] for c in _COLUMNS], names=_COLUMNS)

    def counted():
        for kind, seen in ((WORD, words_seen), (PAIR, pairs_seen)):
            if seen:
                h, a, b = (np.concatenate(x) for x in zip(*seen, strict=True))
                h, first, n = np.unique(h, return_index=True, return_counts=True)
                a, b = a[first], b[first]
                seen.clear()
                for i in range(0, len(h), 100_000):
                    at = slice(i, i + 100_000)
                    yield rows(kind, len(h[at]), h=h[at], a=a[at], b=b[at], n=n[at])

    def paged(ids, pages):
        for kind, found in pages.items():
            if found:
                at = np.concatenate([np.full(len(h), row) for row, h, _ in found])
                h, n = (np.concatenate([x[k] for x in found]) for k in (1, 2))
                found.clear()
                yield rows(kind, len(at), ids.take(pa.array(at)), h=h, n=n)

    for batch in batches:
        docs = {"doc": [], "text_share": [], "repeats": [], "links": [], "n": []}
        pages, in_pages, ids = {PAGE_PAIR: [], PAGE_WORD: []}, 0, batch.column(0)
        for row, text in enumerate(batch.column(1).to_pylist()):
            w = tokens(text or "")
            if not w:
                continue
            h = reader.hashed(w)
            p = reader.pairs(h)
            distinct, first, times = np.unique(p, return_index=True, return_counts=True)
            own, own_times = np.unique(h, return_counts=True)
            words_seen.append((own, own, own))
            pairs_seen.append((distinct, h[first], h[first + 1]))
            held += len(own) + len(distinct)
            share = running_text(text)
            docs["doc"].append(row)
            docs["text_share"].append(share)
            docs["repeats"].append(1 - len(distinct) / max(1, len(p)))
            docs["links"].append(sum(1 for x in w if x == LINK or x[0] == "#") / len(w))
            docs["n"].append(len(w))
            if len(p):
                pages[PAGE_PAIR].append((row, distinct, times))
                pages[PAGE_WORD].append((row, own, own_times))
                in_pages += len(distinct) + len(own)
                if in_pages > HELD:
                    yield from paged(ids, pages)
                    in_pages = 0
        if docs["doc"]:
            yield rows(DOC, len(docs["doc"]), ids.take(pa.array(docs.pop("doc"))), **docs)
        yield from paged(ids, pages)
        if held > 2_000_000:
            yield from counted()
            held = 0
    yield from counted()


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of the one pass over the texts, written once."""
    schema = docs.selectExpr(
        "cast(0 as tinyint) as kind", f"{id_col} as doc_id", "0L as h", "0L as a", "0L as b", "0L as n",
        "0D as text_share", "0D as repeats", "0D as links",
    ).schema
    for f in schema.fields:
        f.nullable = True
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[dict(docs.dtypes)[id_col]]
    return cut(docs.select(id_col, text_col).mapInArrow(lambda b: _scan(b, id_type), schema), "spam-scan")


def page_measures(scanned: DataFrame) -> DataFrame:
    """Of every page of two words and more: ``text_share, repeats, links, mean_pmi``."""
    words = scanned.filter(F.col("kind") == WORD).groupBy("h").agg(F.sum("n").alias("df"))
    pairs = scanned.filter(F.col("kind") == PAIR).groupBy("h").agg(F.sum("n").alias("df"), F.first("a").alias("a"), F.first("b").alias("b"))
    totals = scanned.filter(F.col("kind").isin(WORD, PAIR)).agg(
        F.sum(F.when(F.col("kind") == WORD, F.col("n"))).alias("nw"), F.sum(F.when(F.col("kind") == PAIR, F.col("n"))).alias("np")
    ).first()
    nw, np_ = float(totals["nw"] or 1), float(totals["np"] or 1)
    # A pair seen in one document only says nothing.
    valued = (
        pairs.filter("df > 1")
        .join(words.select(F.col("h").alias("a"), F.col("df").alias("da")), "a")
        .join(words.select(F.col("h").alias("b"), F.col("df").alias("db")), "b")
        .select("h", (F.log(F.col("df") / np_) - F.log(F.col("da") / nw) - F.log(F.col("db") / nw)).alias("pmi"))
    )
    own = scanned.filter(F.col("kind") == PAGE_PAIR).select("doc_id", "h", "n")
    mean = own.join(valued, "h").groupBy("doc_id").agg((F.sum(F.col("n") * F.col("pmi")) / F.sum("n")).alias("mean_pmi"))
    pages = scanned.filter((F.col("kind") == DOC) & (F.col("n") > 1))
    return pages.select("doc_id", "n", "text_share", "repeats", "links").join(mean, "doc_id", "left")


def listed() -> Column:
    """Little running text or many repeats: the pages among which the bounds are taken."""
    return (F.col("text_share") < JUDGED) | (F.col("repeats") >= REPEATS)


def middle(pages: DataFrame, column: str) -> tuple[float, float] | None:
    """Median and median deviation of a column, in bounded memory; None without rows."""
    at = lambda c: F.percentile_approx(c, 0.5, 10_000)
    m = pages.agg(at(F.col(column))).first()[0]
    return None if m is None else (m, pages.agg(at(F.abs(F.col(column) - m))).first()[0])


def coherent(pages: DataFrame) -> tuple[float, float]:
    """The mean mutual information of running text, from the judged pages that have some."""
    shape = middle(pages.filter((F.col("text_share") >= RUNNING_TEXT) & F.col("mean_pmi").isNotNull()), "mean_pmi")
    return (-math.inf, math.inf) if shape is None else (shape[0] - SPREAD * shape[1], shape[0] + SPREAD * shape[1])


def cutoff(pages: DataFrame) -> float:
    """The mean log odds above which a page is spam; infinite if no page is a seed."""
    if pages.filter("seed").isEmpty():
        return math.inf
    shape = middle(pages.filter(listed() & ~F.col("seed") & F.col("odds").isNotNull()), "odds")
    # Without other pages: words that hardly ever stand on seeds.
    return -4.0 if shape is None else shape[0] + OUTSIDE * max(shape[1], 0.05)


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Judged pages with their measures, ``seed`` and ``odds`` (mean log odds of the words)."""
    scanned = scan(docs, id_col, text_col)
    repeated = F.col("repeats") >= REPEATS
    linked = F.col("links") >= LINKS
    pages = cut(page_measures(scanned), "spam-measures")
    low, high = coherent(pages.filter(listed()))
    incoherent = F.coalesce(~F.col("mean_pmi").between(low, high), F.lit(False))
    halfway = incoherent & (F.col("repeats") >= REPEATS / 2)
    pages = cut(pages.filter(listed() | incoherent).withColumn("seed", (F.col("text_share") < RUNNING_TEXT) & (repeated | linked | halfway)), "spam-pages")
    n_docs = scanned.filter(F.col("kind") == DOC).count()
    n_seeds = pages.filter("seed").count()
    words = scanned.filter(F.col("kind") == PAGE_WORD).select("doc_id", "h", "n").join(pages.select("doc_id"), "doc_id", "left_semi")
    on_seeds = words.join(pages.filter("seed").select("doc_id"), "doc_id", "left_semi").groupBy("h").agg(F.count("*").alias("s"))
    every = scanned.filter(F.col("kind") == WORD).groupBy("h").agg(F.sum("n").alias("df"))
    needed = words.groupBy("h").agg(F.lit(1).alias("x")).drop("x")
    prior = (n_seeds + 0.5) / (n_docs + 1.0)
    seen = F.coalesce("s", F.lit(0))
    # Smoothed towards the prior, so a word hardly seen at all speaks for neither side.
    odds = (
        needed.join(every, "h")
        .join(on_seeds, "h", "left")
        .select(
            "h",
            (F.log((seen + prior) / (F.col("df") - seen + 1 - prior)) - F.lit(math.log(prior / (1 - prior)))).alias("odds"),
        )
    )
    sums = words.join(odds, "h").groupBy("doc_id").agg(
        F.sum(F.col("n") * F.least(F.greatest("odds", F.lit(-4.0)), F.lit(4.0))).alias("sum"), F.sum("n").alias("of")
    )
    summed = cut(pages.join(sums, "doc_id", "left"), "spam-odds")
    domain = summed.filter(listed() & ~F.col("seed")).agg(F.avg(F.col("sum") / F.col("of"))).first()[0]
    odds = (F.col("sum") + F.lit(PRIOR_WORDS * (-4.0 if domain is None else domain))) / (F.col("of") + PRIOR_WORDS)
    return summed.withColumn("odds", odds).drop("sum", "of").withColumnRenamed("doc_id", id_col)


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` of the pages that are spam."""
    pages = cut(judged(docs, id_col, text_col), "spam-judged")
    return pages.filter(F.col("odds") > cutoff(pages)).select(id_col)
