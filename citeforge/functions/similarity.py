"""Similarity scores and confidences of record linkage (survey SIM and NUM ids in brackets)."""

from __future__ import annotations

import difflib
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeforge.functions import col
from citeforge.functions.text import page_range, split_list, strip, text, words

# Base confidences, adjustments, thresholds and weights of the scores.
BASE_CONFIDENCE = {"pmid": 0.95, "journal": 0.85, "title": 0.70}
OTHER_CONFIDENCE = 0.5
PATENT_THRESHOLDS = {"author_match": 0.7, "institution_match": 0.6, "subject_match": 0.5}
SEQUENCE_MATCH = 0.8


def jaccard(a: Column, b: Column) -> Column:
    """[SET-03, SIM-01] Shared over all distinct elements; 0 if either side is empty."""
    both = F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both).otherwise(F.lit(0.0))


def title_similarity(a: Column | str, b: Column | str) -> Column:
    """[SIM-01] Jaccard coefficient of the lower-case words."""
    return jaccard(words(F.lower(text(a))), words(F.lower(text(b))))


def last_names(display: Column | str) -> Column:
    """Family names of ``Last, F.; Last, F.``: names without comma give none."""
    listed = F.filter(split_list(display), lambda n: F.contains(n, F.lit(",")))
    return F.array_distinct(F.transform(listed, lambda n: F.lower(strip(F.substring_index(n, ",", 1)))))


def work_authors(authors: Column | str) -> Column:
    """Display names ``Family, G.`` of a work's author structs, joined by semicolons."""
    one = lambda a: F.when(
        text(a["given"]) != "", F.concat(text(a["family"]), F.lit(", "), F.substring(a["given"], 1, 1), F.lit("."))
    ).otherwise(text(a["family"]))
    return F.array_join(F.transform(F.coalesce(col(authors), F.array().cast("array<struct<family:string,given:string>>")), one), "; ")


def author_overlap(a: Column | str, b: Column | str) -> Column:
    """[SIM-02] Jaccard coefficient of the family names of two display lists."""
    return jaccard(last_names(a), last_names(b))


def clamp(score: Column) -> Column:
    """[NUM-09]"""
    return F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))


def match_confidence(record: dict[str, Column], work: dict[str, Column], method: str) -> Column:
    """[SIM-03..05] ``struct<confidence, title_sim, author_sim, year_match, volume_match, pages_match>``.

    ``record`` and ``work`` give ``title, authors, year, volume`` as columns, and ``pages``
    (of the record built from its first and last page)."""
    ry, wy = text(record["year"]), text(work["year"])
    known_year = (strip(ry) != "") & (wy != "")
    year_match = known_year & (strip(ry) == wy)
    title_sim = title_similarity(record["title"], work["title"])
    author_sim = author_overlap(record["authors"], work["authors"])
    both_authors = (F.size(last_names(record["authors"])) > 0) & (F.size(last_names(work["authors"])) > 0)
    volume_known = (strip(text(record["volume"])) != "") & (text(work["volume"]) != "")
    volume_match = volume_known & (strip(text(record["volume"])) == text(work["volume"]))
    pages_match = (text(record["pages"]) != "") & F.contains(text(work["pages"]), text(record["pages"]))
    score = F.lit(BASE_CONFIDENCE.get(method, OTHER_CONFIDENCE))
    score += F.when(year_match, 0.1).when(known_year, -0.3).otherwise(-0.1)
    if method != "title":
        score += F.when(title_sim > 0.8, 0.1).when(title_sim < 0.5, -0.2).otherwise(0.0)
    score += F.when(author_sim > 0.5, 0.1).when((author_sim < 0.2) & both_authors, -0.1).otherwise(0.0)
    if method == "journal":
        score += F.when(volume_match & pages_match, 0.1).when(volume_known & ~volume_match, -0.2).otherwise(0.0)
    return F.struct(
        clamp(score).alias("confidence"),
        title_sim.alias("title_sim"),
        author_sim.alias("author_sim"),
        year_match.alias("year_match"),
        volume_match.alias("volume_match"),
        pages_match.alias("pages_match"),
    )


def confidence_status(score: Column) -> Column:
    """[NUM-08]"""
    return F.when(score >= 0.9, "high").when(score >= 0.7, "medium").when(score >= 0.5, "low").otherwise("very_low")


def enrichment_score(record: dict[str, Column], work: dict[str, Column]) -> Column:
    """[SIM-07] Title 0.4, year, volume and first page 0.2 each; null under two comparable fields."""
    pairs = {
        "title": (title_similarity(record["title"], work["title"]) * 0.4, 1),
        "year": (F.when(text(record["year"]) == text(work["year"]), 0.2).otherwise(0.0), 1),
        "volume": (F.when(text(record["volume"]) == text(work["volume"]), 0.2).otherwise(0.0), 1),
        "page": (F.when(F.contains(text(work["page"]), text(record["page"])), 0.2).otherwise(0.0), 1),
    }
    known = {k: (strip(text(record[k])) != "") & (text(work[k]) != "") for k in pairs}
    total = sum((F.when(known[k], v).otherwise(0.0) for k, (v, _) in pairs.items()), F.lit(0.0))
    fields = sum((known[k].cast("int") for k in pairs), F.lit(0))
    return F.when(fields >= 2, total)


def record_pages(start: Column | str, end: Column | str) -> Column:
    return page_range(start, end)


def year_proximity(pub: Column, patent: Column) -> Column:
    """[NUM-10] How well a patent's year follows (or precedes) a publication's."""
    lag = patent - pub
    after = F.when(lag <= 1, 1.0).when(lag <= 3, 0.8).when(lag <= 5, 0.6).when(lag <= 10, 0.3).otherwise(0.1)
    before = F.when(-lag <= 1, 0.7).when(-lag <= 3, 0.4).when(-lag <= 5, 0.2).otherwise(0.1)
    return F.when(lag.isNull(), 0.0).when(lag >= 0, after).otherwise(before)


def subject_overlap(keywords: Column, *texts: Column) -> Column:
    """[ARR-03, SIM-14] Share of the keywords that occur in the texts."""
    inside = F.lower(F.concat_ws(" ", *[text(t) for t in texts]))
    hits = F.size(F.filter(keywords, lambda k: F.contains(inside, F.lower(k))))
    return F.when(F.size(keywords) > 0, hits / F.size(keywords)).otherwise(F.lit(0.0))


# --- sequence ratios: no built-in equals them, so Arrow; pairs must be blocked before -----


@lru_cache(maxsize=300_000)
def ratio(a: str | None, b: str | None) -> float:
    """Kept per worker: the same names meet in very many pairs."""
    return difflib.SequenceMatcher(None, a, b).ratio() if a and b else 0.0


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """[SIM-09, SIM-15] Matching characters of two strings, twice over their lengths."""
    return pd.Series([ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def best_ratio(one: pd.Series, many: pd.Series) -> pd.Series:
    """[SIM-10..12] The best ratio of a name with any of a list."""
    return pd.Series([max((ratio(x, y) for y in ys), default=0.0) if ys is not None else 0.0 for x, ys in zip(one, many, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def list_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """[SIM-11] The best ratio between two lists."""
    best = lambda xs, ys: max((ratio(x, y) for x in xs for y in ys), default=0.0)
    return pd.Series([best(x, y) if x is not None and y is not None else 0.0 for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def name_overlap(a: pd.Series, b: pd.Series) -> pd.Series:
    """[JOIN-14, SIM-13] Names of the first list that resemble one of the second, over the longer list."""

    def one(xs, ys) -> float:
        if xs is None or ys is None or not len(xs) or not len(ys):
            return 0.0
        return sum(any(ratio(x, y) > SEQUENCE_MATCH for y in ys) for x in xs) / max(len(xs), len(ys))

    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def patent_confidence(kind: str, name: Column, institution: Column, year: Column, subject: Column, author: Column, title: Column) -> Column:
    """[SIM-16..19] Weighted confidence of a link of a kind; other kinds score 0."""
    weights = {
        "author_match": [(name, 0.4), (institution, 0.3), (year, 0.2), (subject, 0.1)],
        "institution_match": [(institution, 0.5), (author, 0.25), (year, 0.15), (subject, 0.1)],
        "subject_match": [(subject, 0.6), (title, 0.25), (year, 0.15)],
    }
    return F.least(sum((c * w for c, w in weights.get(kind, [])), F.lit(0.0)), F.lit(1.0))
