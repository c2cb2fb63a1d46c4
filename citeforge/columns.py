"""Binding of export headers to the engine's column names, on the driver, once per header."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Column name -> the header it has in exports and the other spellings of it (fixed values).
HEADERS = {
    "authors": ["Authors", "Author"],
    "author_ids": ["Author(s) ID", "Author IDs", "Authors ID"],
    "author_full_names": ["Author full names", "Author Full Names"],
    "title": ["Title", "Document Title"],
    "pub_year": ["Year", "Publication Year"],
    "source_title": ["Source title", "Source Title", "Journal"],
    "volume": ["Volume"],
    "issue": ["Issue"],
    "art_no": ["Art. No.", "Article Number"],
    "page_start": ["Page start"],
    "page_end": ["Page end"],
    "page_count": ["Page count"],
    "cited_by": ["Cited by"],
    "doi": ["DOI"],
    "link": ["Link"],
    "affiliations": ["Affiliations", "Affiliation"],
    "abstract": ["Abstract"],
    "author_keywords": ["Author Keywords"],
    "index_keywords": ["Index Keywords"],
    "ref_list": ["References"],
    "funding": ["Funding Details", "Funding Texts"],
    "chemicals": ["Chemicals/CAS", "Chemical"],
    "trade_names": ["Tradenames", "Trade Names"],
    "correspondence": ["Correspondence Address", "Corresponding Author"],
    "publisher": ["Publisher"],
    "access_type": ["Access Type", "Open Access"],
    "issn": ["ISSN"],
    "isbn": ["ISBN"],
    "pubmed_id": ["PubMed ID", "PMID"],
    "language": ["Language of Original Document"],
    "document_type": ["Document Type"],
    "stage": ["Publication Stage"],
    "source_db": ["Source"],
    "eid": ["EID"],
}


def resolve(columns: list[str], name: str, spellings: list[str], taken: set[str] = frozenset()) -> str | None:
    """The header that holds a field: an exact spelling first, then one that differs in case,
    then, for spellings of more than one word, one that contains it. Headers already taken are
    left out, so that a short name (Title) cannot bind to a longer one (Source title)."""
    free = [c for c in columns if c not in taken]
    for want in [name, *spellings]:
        if want in free:
            return want
    lower = {c.lower().strip("﻿ "): c for c in reversed(free)}
    for want in [name, *spellings]:
        if want.lower() in lower:
            return lower[want.lower()]
    for want in spellings:
        if len(want.split()) > 1:
            for c in free:
                if want.lower() in c.lower():
                    return c
    return None


def binding(columns: list[str], headers: dict[str, list[str]] = HEADERS) -> dict[str, str | None]:
    """Column name -> header. Exact spellings of all fields bind before looser ones of any."""
    exact = {n: next((s for s in [n, *sp] if s in columns), None) for n, sp in headers.items()}
    taken = {c for c in exact.values() if c}
    return {n: exact[n] or resolve(columns, n, sp, taken) for n, sp in headers.items()}


def bind(df: DataFrame, headers: dict[str, list[str]] = HEADERS, keep: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the engine's columns, each a string; absent or missing cells are empty."""
    found = binding(df.columns, headers)
    cell = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c else F.lit("")
    return df.select(*keep, *[cell(c).alias(n) for n, c in found.items()])
