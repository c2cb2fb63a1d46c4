"""Declared schemas of the stored tables and of nested service records (survey SNK-01, §1.4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Table -> its columns. Keys and references are checked by assertions (operators/coverage.py).
TABLES = {
    "papers": "paper_id long, title string, year int, doi string, source_title string, volume string, issue string, page_start string, "
    "page_end string, page_count int, cited_by int, abstract string, language_original string, document_type string, publication_stage string, "
    "issn string, isbn string",
    "authors_master": "author_id long, scopus_id string, full_name string, canonical_name string, abbreviated_name string",
    "institutions_master": "institution_id long, canonical_name string, country string",
    "keywords_master": "keyword_id long, keyword_text string, keyword_category string, normalized_text string",
    "paper_authors": "paper_id long, author_id long, position int, first_author boolean, last_author boolean",
    "paper_keywords": "paper_id long, keyword_id long, keyword_type string, position int",
    "paper_institutions": "paper_id long, institution_id long, author_count long, primary_affiliation boolean",
    "paper_citations": "paper_id long, position int, reference_text string, reference_year int, reference_authors string, reference_title string, "
    "reference_journal string, reference_volume string, reference_issue string, reference_pages string",
    "paper_funding": "paper_id long, funding_id int, agency_name string, grant_numbers array<string>",
    "paper_chemicals": "paper_id long, chemical_name string, cas_number string, position int",
    "paper_trade_names": "paper_id long, trade_name string, manufacturer string, position int",
    "paper_correspondence": "paper_id long, author_name string, email string, institution string",
    "paper_open_access": "paper_id long, access_type string, publisher string, open_access boolean",
    "patents": "lens_id string, title string, publication_date string, patent_type string, jurisdiction string",
    "publication_patent_links": "pub_id long, lens_id string, link_type string, confidence double",
}
#: Primary keys of the tables that have one.
KEYS = {
    "papers": ["paper_id"], "authors_master": ["author_id"], "institutions_master": ["institution_id"], "keywords_master": ["keyword_id"],
    "paper_authors": ["paper_id", "author_id"], "paper_keywords": ["paper_id", "keyword_id", "keyword_type"],
    "paper_institutions": ["paper_id", "institution_id"], "paper_correspondence": ["paper_id"], "paper_open_access": ["paper_id"], "patents": ["lens_id"],
}
WORK = (
    "work_id long, pmid string, title array<string>, author array<struct<family:string,given:string>>, published struct<date_parts:array<array<int>>>, "
    "volume string, page string, container_title array<string>"
)


def schema(name: str) -> StructType:
    return StructType.fromDDL(TABLES[name])


def conform(df: DataFrame, name: str) -> DataFrame:
    """``df`` with exactly the declared columns, in order, in their types; a missing one is null."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema(name).fields])
