"""Papers, the registries of authors, institutions and keywords, and the bridges between them
(survey WIN, PIPE-03..09). Input: deduplicated and filtered records with the engine's column
names and an order column; all tables keep first-seen semantics by that order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeforge.functions.text import canonical_author, country, full_author, institution_name, normalize_keyword, safe_int, split_list, text
from citeforge.operators.ids import dense_ids


def papers(records: DataFrame, order: str) -> DataFrame:
    """[WIN-01, PIPE-03] One row per record with ``paper_id`` 1..n in the records' order."""
    have = set(records.columns)
    opt = lambda c: text(c) if c in have else F.lit("")
    shaped = records.select(
        order, text("title").alias("title"), safe_int("pub_year").cast("int").alias("year"), text("doi").alias("doi"),
        text("source_title").alias("source_title"), text("volume").alias("volume"), text("issue").alias("issue"),
        text("page_start").alias("page_start"), text("page_end").alias("page_end"), safe_int("page_count").cast("int").alias("page_count"),
        safe_int("cited_by", 0).cast("int").alias("cited_by"), text("abstract").alias("abstract"), opt("document_type").alias("document_type"),
        opt("language").alias("language_original"), opt("stage").alias("publication_stage"), opt("issn").alias("issn"), opt("isbn").alias("isbn"),
    )
    return dense_ids(shaped, [order], "paper_id")


def author_tokens(records: DataFrame, order: str) -> DataFrame:
    """[JOIN-16] ``order, pos, scopus_id, name`` of authors and ids as far as both lists go."""
    have_full = "author_full_names" in records.columns
    names, ids = split_list("authors"), split_list("author_ids")
    n = F.least(F.size(names), F.size(ids))
    zipped = F.arrays_zip(F.slice(names, 1, F.greatest(n, F.lit(0))).alias("name"), F.slice(ids, 1, F.greatest(n, F.lit(0))).alias("scopus_id"))
    full = F.col("author_full_names") if have_full else F.lit("")
    each = records.select(order, full.alias("__full"), F.posexplode(zipped).alias("p", "z"))
    short = F.col("z.name")
    return each.select(
        order, (F.col("p") + 1).alias("pos"), F.col("z.scopus_id").alias("scopus_id"), short.alias("abbreviated_name"),
        full_author("__full", F.col("p") + 1, short).alias("full_name"),
    )


def registry(tokens: DataFrame, key: str, payload: list[str], order: list[str], out: str) -> DataFrame:
    """[WIN-02] Dictionary of a natural key: the payload of its first occurrence and a dense id
    by first occurrence. Keys are reduced map-side; only distinct keys are numbered."""
    first = tokens.groupBy(key).agg(F.min(F.struct(*order, *payload)).alias("__f"))
    flat = first.select(key, *[F.col(f"__f.{c}").alias(c if c in payload else f"__o_{c}") for c in [*order, *payload]])
    return dense_ids(flat, [f"__o_{c}" for c in order], out).drop(*[f"__o_{c}" for c in order])


def authors(records: DataFrame, order: str) -> DataFrame:
    """[PIPE-04] ``author_id, scopus_id, full_name, canonical_name, abbreviated_name``."""
    tokens = author_tokens(records, order)
    reg = registry(tokens, "scopus_id", ["full_name", "abbreviated_name"], [order, "pos"], "author_id")
    return reg.select("author_id", "scopus_id", "full_name", canonical_author("full_name").alias("canonical_name"), "abbreviated_name")


def paper_authors(records: DataFrame, order: str) -> DataFrame:
    """[PIPE-07, WIN-03/04] ``order, scopus_id, position, first_author, last_author``: every id
    of the list at its least position; an id twice in one list is one row."""
    ids = split_list("author_ids")
    each = records.select(order, F.size(ids).alias("n"), F.posexplode(ids).alias("p", "scopus_id"))
    least = each.groupBy(order, "scopus_id").agg(F.min(F.col("p") + 1).alias("position"), F.max("n").alias("n"))
    return least.select(
        order, "scopus_id", "position", (F.col("position") == 1).alias("first_author"), (F.col("position") == F.col("n")).alias("last_author")
    )


def institution_tokens(records: DataFrame, order: str) -> DataFrame:
    each = records.select(order, F.posexplode(split_list("affiliations")).alias("p", "affiliation"))
    return each.select(
        order, (F.col("p") + 1).alias("pos"), institution_name("affiliation").alias("canonical_name"), country("affiliation").alias("country")
    ).filter(F.col("canonical_name") != "")


def institutions(records: DataFrame, order: str) -> DataFrame:
    """[PIPE-05] ``institution_id, canonical_name, country``."""
    return registry(institution_tokens(records, order), "canonical_name", ["country"], [order, "pos"], "institution_id")


def paper_institutions(records: DataFrame, order: str) -> DataFrame:
    """[PIPE-09, AGG-07] ``order, canonical_name, author_count, primary_affiliation``."""
    counts = institution_tokens(records, order).groupBy(order, "canonical_name").agg(F.count("*").alias("author_count"))
    most = F.max("author_count").over(Window.partitionBy(order))
    return counts.withColumn("primary_affiliation", F.col("author_count") == most)


def keyword_tokens(records: DataFrame, order: str) -> DataFrame:
    """``order, pass, pos, keyword_text, keyword_type, normalized_text`` of both keyword lists;
    all author keywords come before all index keywords."""
    kinds = F.array(
        F.struct(F.lit(0).alias("pass"), F.lit("author").alias("keyword_type"), split_list("author_keywords").alias("l")),
        F.struct(F.lit(1).alias("pass"), F.lit("index").alias("keyword_type"), split_list("index_keywords").alias("l")),
    )
    each = records.select(order, F.explode(kinds).alias("k")).select(order, "k.pass", "k.keyword_type", F.posexplode("k.l").alias("p", "keyword_text"))
    return each.select(
        order, "pass", (F.col("p") + 1).alias("pos"), "keyword_text", "keyword_type", normalize_keyword("keyword_text").alias("normalized_text")
    )


def keywords(records: DataFrame, order: str) -> DataFrame:
    """[PIPE-06] ``keyword_id, normalized_text, keyword_text, keyword_category``."""
    reg = registry(keyword_tokens(records, order), "normalized_text", ["keyword_text", "keyword_type"], ["pass", order, "pos"], "keyword_id")
    return reg.select("keyword_id", "normalized_text", "keyword_text", F.col("keyword_type").alias("keyword_category"))


def paper_keywords(records: DataFrame, order: str) -> DataFrame:
    """[PIPE-08] ``order, normalized_text, keyword_type, position``: the first place of each."""
    return keyword_tokens(records, order).groupBy(order, "normalized_text", "keyword_type").agg(F.min("pos").alias("position"))


def with_ids(bridge: DataFrame, papers_: DataFrame, order: str, registry_: DataFrame, key: str, id_col: str) -> DataFrame:
    """[JOIN-08] A bridge with the surrogate ids of its paper and its entity."""
    of_paper = papers_.select(order, "paper_id")
    of_entity = registry_.select(key, id_col)
    return bridge.join(of_paper, order).join(of_entity, key).drop(order, key)
