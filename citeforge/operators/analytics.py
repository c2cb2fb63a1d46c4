"""Innovation and collaboration analytics over publications, links and patents (survey §2.13,
AGG-09..17). ``links(pub_id, lens_id, link_type, confidence)``; every ranking breaks ties by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeforge.functions.text import split_list, text, year_of

BANDS = [(0.8, "high"), (0.6, "medium")]


def band(c: Column) -> Column:
    """[AGG-10]"""
    out = F.lit("low")
    for least, name in reversed(BANDS):
        out = F.when(c >= least, name).otherwise(out)
    return out


def innovation_metrics(pubs: DataFrame, links: DataFrame) -> DataFrame:
    """[AGG-09] Publications, those with patents, and the conversion rate in per cent."""
    total = pubs.agg(F.count("*").alias("publications"))
    linked = links.agg(F.countDistinct("pub_id").alias("with_patents"), F.countDistinct("lens_id").alias("patents"), F.count("*").alias("links"))
    rate = F.when(F.col("publications") > 0, F.col("with_patents") * 100.0 / F.col("publications")).otherwise(0.0)
    return total.join(linked, F.lit(True)).withColumn("conversion_rate", rate)


def confidence_histogram(links: DataFrame) -> DataFrame:
    return links.groupBy(band(F.col("confidence")).alias("band")).agg(F.count("*").alias("links"))


def link_types(links: DataFrame) -> DataFrame:
    """[AGG-11]"""
    return links.groupBy("link_type").agg(F.count("*").alias("links"))


def lags(pubs: DataFrame, links: DataFrame, patents: DataFrame, least: float = 0.7) -> DataFrame:
    """[JOIN-03, NUM-14] ``pub_id, lens_id, lag`` in years of links of a confidence."""
    years = patents.select("lens_id", year_of(F.substring("publication_date", 1, 4)).alias("py"))
    joined = links.filter(F.col("confidence") >= least).join(pubs.select("pub_id", "year"), "pub_id").join(years, "lens_id")
    return joined.select("pub_id", "lens_id", (F.col("py") - F.col("year")).alias("lag")).filter("lag is not null")


def mean_time_to_patent(pubs: DataFrame, links: DataFrame, patents: DataFrame) -> DataFrame:
    """[AGG-12]"""
    return lags(pubs, links, patents).filter("lag >= 0").agg(F.avg("lag").alias("mean_lag"), F.count("*").alias("links"))


def lag_histogram(pubs: DataFrame, links: DataFrame, patents: DataFrame, longest: int = 10) -> DataFrame:
    """[AGG-14, FLT-13]"""
    return lags(pubs, links, patents).filter(F.col("lag").between(0, longest)).groupBy("lag").agg(F.count("*").alias("links"))


def group_ranking(pubs: DataFrame, links: DataFrame, key: Column, least_pubs: int, least_patents: int, limit: int | None) -> DataFrame:
    """[AGG-13, AGG-15] Groups of publications by patents per publication."""
    joined = pubs.select("pub_id", key.alias("group_key")).filter(F.col("group_key") != "").join(links, "pub_id")
    agg = joined.groupBy("group_key").agg(
        F.countDistinct("pub_id").alias("publications"),
        F.countDistinct("lens_id").alias("patents"),
        F.count("*").alias("links"),
        F.bround(F.avg("confidence"), 3).alias("mean_confidence"),
        F.count(F.when(F.col("confidence") >= 0.8, 1)).alias("strong_links"),
    )
    agg = agg.filter((F.col("publications") >= least_pubs) & (F.col("patents") >= least_patents))
    agg = agg.withColumn("ratio", F.col("patents") / F.col("publications"))
    return agg.orderBy(F.desc("ratio"), F.desc("patents"), "group_key").limit(limit) if limit else agg


def institution_ranking(pubs: DataFrame, links: DataFrame, limit: int | None = None) -> DataFrame:
    return group_ranking(pubs, links, F.substring(text("affiliations"), 1, 100), 5, 2, limit)


def subject_ranking(pubs: DataFrame, links: DataFrame, limit: int | None = None, least_pubs: int = 3) -> DataFrame:
    return group_ranking(pubs, links, F.substring(text("author_keywords"), 1, 50), least_pubs, 0, limit)


def collaboration_groups(pubs: DataFrame, links: DataFrame) -> DataFrame:
    """[AGG-16] Author teams of several people whose publications lead to two patents or more."""
    joined = pubs.select("pub_id", text("authors").alias("team")).join(links, "pub_id")
    agg = joined.groupBy("team").agg(F.countDistinct("lens_id").alias("patents"), F.countDistinct("pub_id").alias("publications"))
    return agg.filter("patents >= 2").withColumn("team_size", F.size(split_list("team"))).filter("team_size > 1")


def author_profile(pubs: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """[AGG-17, FLT-09] One row: what is known of the publications that name an author."""
    own = pubs.filter(F.contains(F.lower(text("authors")), F.lit(name.lower()))).select("pub_id")
    linked = links.join(own, "pub_id", "left_semi")
    return own.agg(F.count("*").alias("publications")).join(
        linked.agg(
            F.countDistinct("pub_id").alias("with_patents"),
            F.countDistinct("lens_id").alias("patents"),
            F.count(F.when(F.col("confidence") >= 0.8, 1)).alias("strong_links"),
            F.bround(F.avg("confidence"), 3).alias("mean_confidence"),
        ),
        F.lit(True),
    )


def author_patents(pubs: DataFrame, links: DataFrame, patents: DataFrame, name: str) -> DataFrame:
    """[SET-05, ORD-02] Distinct patents linked to an author's publications, the surest and newest first."""
    own = pubs.filter(F.contains(F.lower(text("authors")), F.lit(name.lower()))).select("pub_id", F.col("title").alias("pub_title"), "year")
    found = links.join(own, "pub_id").join(patents, "lens_id").select(
        "lens_id", "title", "publication_date", "jurisdiction", "pub_title", "year", "confidence"
    ).distinct()
    return found.orderBy(F.desc("confidence"), F.desc("publication_date"), "lens_id", "pub_title")


def patents_of(links: DataFrame, patents: DataFrame, publications: DataFrame) -> DataFrame:
    """[JOIN-05] Patents linked to any of a list of publications (``pub_id``): a semi-join."""
    return links.join(publications.select("pub_id"), "pub_id", "left_semi").join(patents, "lens_id")


def institution_patents(pubs: DataFrame, links: DataFrame, patents: DataFrame, name: str) -> DataFrame:
    """Distinct patents linked to publications whose affiliations name an institution, the surest
    and newest first."""
    own = pubs.filter(F.contains(F.lower(text("affiliations")), F.lit(name.lower()))).select("pub_id", F.col("title").alias("pub_title"), "authors")
    found = patents_of(links, patents, own).join(own, "pub_id").select(
        "lens_id", "title", "publication_date", "confidence", "link_type", "pub_title", "authors"
    ).distinct()
    return found.orderBy(F.desc("confidence"), F.desc("publication_date"), "lens_id", "pub_title")


def patented_subjects(pubs: DataFrame, links: DataFrame, least: float = 0.7, least_links: int = 3, limit: int | None = None) -> DataFrame:
    """[AGG-15] Keyword heads (50 characters) by how many sure links their publications have."""
    heads = pubs.select("pub_id", F.substring(text("author_keywords"), 1, 50).alias("subject")).filter("subject <> ''")
    counts = links.filter(F.col("confidence") >= least).join(heads, "pub_id").groupBy("subject").agg(F.count("*").alias("links"))
    counts = counts.filter(F.col("links") >= least_links)
    return counts.orderBy(F.desc("links"), "subject").limit(limit) if limit else counts


def technology_transfer(pubs: DataFrame, links: DataFrame, patents: DataFrame, limit: int = 20) -> dict[str, DataFrame]:
    """Time lags between publication and patent, and the most patented subjects, as two frames."""
    return {"time_lags": lag_histogram(pubs, links, patents).orderBy("lag"), "subjects": patented_subjects(pubs, links, limit=limit)}


def enrichment_stats(links: DataFrame, patents: DataFrame, processed: DataFrame) -> DataFrame:
    """[AGG-26] One row: publications processed, patents, links, and links by band of confidence."""
    bands = band(F.col("confidence"))
    return processed.agg(F.count("*").alias("processed")).join(patents.agg(F.count("*").alias("patents")), F.lit(True)).join(
        links.agg(F.count("*").alias("links"), *[F.count(F.when(bands == b, 1)).alias(f"{b}_links") for b in ("high", "medium", "low")]), F.lit(True)
    )


def stats(tables: dict[str, DataFrame]) -> DataFrame:
    """[AGG-01] ``table_name, rows`` of several tables in one job."""
    one = [t.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, t in tables.items()]
    out = one[0]
    for x in one[1:]:
        out = out.unionByName(x)
    return out


def country_pairs(places: DataFrame, papers: DataFrame) -> DataFrame:
    """[JOIN-17, AGG-29] Countries that publish together: papers and mean citations of each pair.
    ``places(record_id, country)``; a paper's distinct countries are few, whatever its places."""
    own = places.filter("country <> ''").select("record_id", "country").distinct()
    a, b = own.withColumnRenamed("country", "country_a"), own.withColumnRenamed("country", "country_b")
    pairs = a.join(b, "record_id").filter("country_a < country_b").join(papers.select("record_id", "cited_by"), "record_id")
    return pairs.groupBy("country_a", "country_b").agg(F.count("*").alias("papers"), F.avg("cited_by").alias("mean_citations"))


def keyword_trend(tokens: DataFrame, papers: DataFrame, least: int = 2) -> DataFrame:
    """[JOIN-18, AGG-29] Papers and mean citations by keyword and year of keywords in ``least`` papers a year."""
    own = tokens.select("record_id", "normalized_text").distinct().join(papers.select("record_id", "year", "cited_by"), "record_id")
    agg = own.filter("year is not null").groupBy("normalized_text", "year").agg(F.count("*").alias("papers"), F.avg("cited_by").alias("mean_citations"))
    return agg.filter(F.col("papers") >= least)


def attempts(log: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """[WIN-09] Number of attempts and the last row of every key: an aggregation, not a window."""
    last = F.max_by(F.struct(*[c for c in log.columns if c not in key]), F.struct(*order))
    return log.groupBy(*key).agg(F.count("*").alias("attempts"), last.alias("last")).select(*key, "attempts", "last.*")


def resume(items: DataFrame, log: DataFrame, key: str, order: list[str], done: str = "completed") -> DataFrame:
    """[JOIN-06] Items whose last logged status is not ``done``."""
    finished = attempts(log.select(key, "status", *order), [key], order).filter(F.col("status") == done).select(key)
    return items.join(finished, key, "left_anti")


def recovery_by_method(matched: DataFrame) -> DataFrame:
    """[FLT-16]"""
    return matched.groupBy("method").agg(F.count("*").alias("records"), F.avg("confidence").alias("mean_confidence"))
