"""Registered queries of the bibliographic operators and their SQL counterparts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeforge.functions import similarity, text
from citeforge.plans.problems import ID_TABLE, NODES_SQL, table_sql
from citeforge.operators import analytics, coverage, details, entities, ids, matching, patents, quality
from citeforge.session import shared_dir
from citeforge.streaming import ingest

ORDER = "record_id"


def _t(name: str):
    return lambda s, d: s.read.parquet(f"{d}/{name}.parquet")


_records, _patents, _works = _t("scopus_records"), _t("citing_patents_analysis"), _t("crossref_works")


def _kept(s: SparkSession, d: str) -> DataFrame:
    return quality.kept(quality.dedup_by_doi(_records(s, d), [ORDER]))


def _on_kept(f):
    return lambda s, d: f(_kept(s, d), ORDER)


def _links(s: SparkSession, d: str) -> DataFrame:
    """Publications linked to the patents that cite their DOI, with a confidence by evidence."""
    p = patents.flat(_patents(s, d)).select("rec_id", "lens_id", "target_doi", "publication_type")
    confirmed = _patents(s, d).select("rec_id", F.coalesce("citation_confirmed", F.lit(False)).alias("ok"))
    score = F.when(F.col("ok"), 0.9).when(F.col("publication_type") == "GRANTED_PATENT", 0.75).otherwise(0.55)
    pairs = p.join(confirmed, "rec_id").filter("target_doi <> '' and lens_id <> 'N/A'").select(
        F.col("target_doi").alias("doi"), "lens_id", F.col("publication_type").alias("link_type"), score.alias("confidence")
    )
    once = pairs.groupBy("doi", "lens_id", "link_type").agg(F.max("confidence").alias("confidence"))
    pubs = _kept(s, d).filter("doi <> ''").select(F.col("record_id").alias("pub_id"), "doi")
    return once.join(pubs, "doi").select("pub_id", "lens_id", "link_type", "confidence")


def _pubs(s: SparkSession, d: str) -> DataFrame:
    return _kept(s, d).select(
        F.col("record_id").alias("pub_id"), "title", "authors", "author_keywords", "affiliations", coverage.valid_year().alias("year")
    )


def _patent_rows(s: SparkSession, d: str) -> DataFrame:
    return patents.patent_table(_patents(s, d))


# --- SQL parts --------------------------------------------------------------------------

_WS = text.WS
_STRIP = lambda x: f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"
_TXT = lambda x: f"coalesce({x}, '')"
_BLANK = lambda x: f"{_STRIP(_TXT(x))} = ''"
_LIST = lambda x: f"list_filter(list_transform(string_split({_TXT(x)}, ';'), lambda v: {_STRIP('v')}), lambda v: v <> '')"
_WORDS = lambda x: f"list_filter(string_split_regex({x}, '{_WS}+'), lambda v: v <> '')"
_PUNCT = text.PUNCT.replace("'", "''")
_INT = lambda x: f"CASE WHEN regexp_full_match({_TXT(x)}, '[0-9]+') THEN TRY_CAST({x} AS BIGINT) END"
_CANON = lambda x: f"array_to_string(list_sort({_WORDS(f'lower(translate({x}, {chr(39)}{_PUNCT}{chr(39)}, {chr(39)}{chr(39)}))')}), ' ')"
_NORM = lambda x: f"translate(array_to_string({_WORDS(f'lower({x})')}, ' '), '{_PUNCT}', '')"
_YEAR = f"CASE WHEN {_INT('pub_year')} BETWEEN 1990 AND 2025 THEN CAST(pub_year AS INTEGER) END"


def _reason(strict: bool) -> str:
    fields = quality.REQUIRED_STRICT if strict else quality.REQUIRED
    whens = " ".join(
        f"WHEN {_BLANK(quality.COLUMN_OF.get(f, f))} THEN 'MISSING_{f.upper()}: No {f.replace('_', ' ')} provided'" for f in fields
    )
    return f"CASE {whens} END"


_DEDUP = f"d AS (SELECT * EXCLUDE (k) FROM (SELECT *, {_STRIP(_TXT('doi'))} AS k FROM scopus_records) QUALIFY k = '' OR row_number() OVER (PARTITION BY k ORDER BY record_id) = 1)"
_KEPT = f"{_DEDUP}, kept AS (SELECT * FROM d WHERE {_reason(False)} IS NULL)"
_INST = (
    "CASE WHEN len(list_filter(parts, lambda p: regexp_matches(lower(p), 'university|institute|college|school'))) > 0 "
    "THEN list_filter(parts, lambda p: regexp_matches(lower(p), 'university|institute|college|school'))[1] "
    f"WHEN length(parts[1]) > 3 THEN parts[1] ELSE {_STRIP('a')} END"
)
_COUNTRY = r"CASE WHEN len(parts) > 1 AND length(parts[-1]) BETWEEN 2 AND 20 AND regexp_full_match(parts[-1], '\p{L}+') THEN parts[-1] ELSE '' END"
_INST_TOKENS = f"""it AS (SELECT * FROM (SELECT record_id, pos, {_INST} AS canonical_name, {_COUNTRY} AS country FROM (
  SELECT record_id, pos, a, list_transform(string_split(a, ','), lambda v: {_STRIP('v')}) AS parts FROM (
    SELECT record_id, unnest(range(1, len(l) + 1)) AS pos, unnest(l) AS a FROM (SELECT record_id, {_LIST('affiliations')} AS l FROM kept)))) WHERE canonical_name <> '')"""
_KW_TOKENS = f"""kt AS (SELECT record_id, pass, pos, keyword_text, keyword_type, {_NORM('keyword_text')} AS normalized_text FROM (
  SELECT record_id, 0 AS pass, 'author' AS keyword_type, unnest(range(1, len(l) + 1)) AS pos, unnest(l) AS keyword_text FROM (SELECT record_id, {_LIST('author_keywords')} AS l FROM kept)
  UNION ALL
  SELECT record_id, 1, 'index', unnest(range(1, len(l) + 1)), unnest(l) FROM (SELECT record_id, {_LIST('index_keywords')} AS l FROM kept)))"""
_AUTHOR_TOKENS = f"""atok AS (SELECT record_id, unnest(range(1, n + 1)) AS pos, unnest(ids[1:n]) AS scopus_id, unnest(names[1:n]) AS name
  FROM (SELECT record_id, names, ids, least(len(names), len(ids)) AS n FROM (SELECT record_id, {_LIST('authors')} AS names, {_LIST('author_ids')} AS ids FROM kept)))"""
_PAPER_AUTHORS = f"""pa AS (SELECT record_id, scopus_id, min(p) AS position, max(n) AS n FROM (
  SELECT record_id, len(l) AS n, unnest(range(1, len(l) + 1)) AS p, unnest(l) AS scopus_id FROM (SELECT record_id, {_LIST('author_ids')} AS l FROM kept)) GROUP BY 1, 2)"""
_P = lambda c, path: f"coalesce({c}, json_extract_string(payload, '{path}'), 'N/A')"
_FLAT = (
    "flat AS (SELECT rec_id, target_doi, citation_confirmed, "
    + ", ".join(f"{_P(c, p)} AS {c}" for c, p in patents.PAYLOAD_PATHS.items())
    + ", CAST(coalesce(family_size, TRY_CAST(json_extract_string(payload, '$.families.simple_family.size') AS INTEGER), 0) AS INTEGER) AS family_size FROM citing_patents_analysis)"
)
_PATENT_ROWS = "pr AS (SELECT lens_id, substr(title, 1, 500) AS title, publication_date, publication_type AS patent_type, jurisdiction FROM (SELECT * FROM flat WHERE lens_id <> 'N/A' QUALIFY row_number() OVER (PARTITION BY lens_id ORDER BY rec_id) = 1))"
_LINKS = """links AS (SELECT k.record_id AS pub_id, l.lens_id, l.link_type, l.confidence FROM (
  SELECT target_doi AS doi, lens_id, publication_type AS link_type, max(CASE WHEN coalesce(citation_confirmed, false) THEN 0.9::DOUBLE WHEN publication_type = 'GRANTED_PATENT' THEN 0.75::DOUBLE ELSE 0.55::DOUBLE END) AS confidence
  FROM flat WHERE target_doi <> '' AND lens_id <> 'N/A' GROUP BY 1, 2, 3) l JOIN kept k ON k.doi = l.doi AND k.doi <> '')"""
_PUBS = f"pubs AS (SELECT record_id AS pub_id, title, authors, author_keywords, affiliations, {_YEAR} AS year FROM kept)"
_INNO = f"WITH {_KEPT}, {_FLAT}, {_PATENT_ROWS}, {_LINKS}, {_PUBS}"
_PY = r"TRY_CAST(nullif(regexp_extract(substr(publication_date, 1, 4), '\b(19|20)\d{2}\b', 0), '') AS INTEGER)"
_LAGS = f"lags AS (SELECT l.pub_id, l.lens_id, {_PY} - p.year AS lag FROM links l JOIN pubs p USING (pub_id) JOIN pr USING (lens_id) WHERE l.confidence >= 0.7 AND {_PY} - p.year IS NOT NULL)"
_VCHECK = "SELECT '{0}' AS name, {1} AS passed, {2} AS details"

_FILLED = ["authors", "author_ids", "title", "pub_year", "doi", "affiliations", "abstract", "author_keywords", "ref_list", "volume", "page_start"]


def _ranking_sql(key: str, pubs: int, pats: int) -> str:
    return f"""{_INNO} SELECT group_key, count(DISTINCT pub_id) AS publications, count(DISTINCT lens_id) AS patents, count(*) AS links,
 round_even(avg(confidence), 3) AS mean_confidence, count(*) FILTER (confidence >= 0.8) AS strong_links, count(DISTINCT lens_id) / count(DISTINCT pub_id) AS ratio
 FROM (SELECT pub_id, {key} AS group_key FROM pubs) p JOIN links USING (pub_id) WHERE group_key <> '' GROUP BY 1 HAVING publications >= {pubs} AND patents >= {pats}"""


def _validation(s: SparkSession, d: str) -> DataFrame:
    k = _kept(s, d)
    p = entities.papers(k, ORDER)
    pa, pk = entities.paper_authors(k, ORDER), entities.paper_keywords(k, ORDER)
    return coverage.run_all([
        coverage.same_count("paper_count", p, k),
        coverage.no_orphans("paper_authors_orphans", pa, p, ORDER),
        coverage.no_orphans("paper_keywords_orphans", pk, p, ORDER),
        coverage.unique_key("paper_id_unique", p, ["paper_id"]),
        coverage.unique_key("paper_authors_unique", pa, [ORDER, "scopus_id"]),
        coverage.not_empty("institutions", entities.institution_tokens(k, ORDER), k.filter(~text.blank("affiliations"))),
        coverage.not_empty("references", k.filter(F.size(text.split_list("ref_list")) > 0), k.filter(~text.blank("ref_list"))),
        coverage.special_characters("special_characters", p, k, ORDER),
        coverage.same_content("paper_content", p, k, ORDER, ["title", "doi", "abstract", "source_title"]),
        coverage.near_counts(
            "keyword_counts", pk.groupBy("keyword_type").agg(F.count("*").alias("n")),
            entities.keyword_tokens(k, ORDER).groupBy("keyword_type").agg(F.countDistinct(ORDER, F.lower("keyword_text")).alias("n")), "keyword_type"),
        coverage.few_blank("missing_titles", k, "title"),
    ])


def _match_journal(s: SparkSession, d: str) -> DataFrame:
    left, right = matching.record_fields(_records(s, d)), matching.work_fields(_works(s, d))
    return matching.scored(matching.candidates(left, right, "journal"), "journal").drop("method")


def _match_title(s: SparkSession, d: str) -> DataFrame:
    left, right = matching.record_fields(_records(s, d)), matching.work_fields(_works(s, d))
    return matching.best(matching.scored(matching.candidates(left, right, "title"), "title"))


def _document_parts(s: SparkSession, d: str) -> DataFrame:
    """[STR-14..17, STR-24] The parsers of a record's complex fields, over texts of every kind."""
    heads = _t("documents")(s, d).select("doc_id", F.substring_index(text.text("text"), "\n", 1).alias("t"), "source")
    c, n, m = text.chemical("t"), text.trade_name("t"), text.correspondence("t")
    return heads.select(
        "doc_id", c["cas_number"].alias("cas_number"), n["trade_name"].alias("trade_name"), n["manufacturer"].alias("manufacturer"),
        m["author_name"].alias("author_name"), m["email"].alias("email"), text.open_access("t").alias("open_access"), text.valid_email("t").alias("has_address"),
    )


def _cited(s: SparkSession, d: str) -> DataFrame:
    return _kept(s, d).select("record_id", text.safe_int("pub_year").cast("int").alias("year"), text.safe_int("cited_by", 0).cast("int").alias("cited_by"))


def _stream_ingest(s: SparkSession, d: str) -> DataFrame:
    base = f"{shared_dir(s)}/stream-{uuid.uuid4().hex}"
    schema, name = _records(s, d).schema, "scopus_records.parquet"
    place = s._jvm.org.apache.hadoop.fs.Path(f"{d}/{name}")
    # A stream watches a folder: the table itself, or the folder of a one-file table.
    one_file = place.getFileSystem(s._jsc.hadoopConfiguration()).getFileStatus(place).isFile()
    source, options = (d, {"pathGlobFilter": name}) if one_file else (f"{d}/{name}", {})
    return ingest.ingest(s, source, f"{base}/table", f"{base}/checkpoint", schema, options=options).select("record_id", "doi")


QUERIES = {
    "quality_reasons": lambda s, d: quality.flagged(_records(s, d)).select("record_id", "reason", "category"),
    "quality_reasons_strict": lambda s, d: quality.flagged(_records(s, d), strict=True).select("record_id", "reason", "category"),
    "exclusion_breakdown": lambda s, d: quality.breakdown(_records(s, d)),
    "exclusion_breakdown_strict": lambda s, d: quality.breakdown(_records(s, d), strict=True),
    "doi_dedup": lambda s, d: quality.dedup_by_doi(_records(s, d), [ORDER]).select("record_id", "doi"),
    "duplicate_log": lambda s, d: quality.duplicate_log(_records(s, d), [ORDER], "record_id"),
    "duplicates_by_year": lambda s, d: quality.duplicate_log(_records(s, d), [ORDER], "record_id").groupBy("year").agg(F.count("*").alias("duplicates")),
    "missing_doi_by_year": lambda s, d: _records(s, d).filter(text.blank("doi")).groupBy(quality.plausible_year("pub_year").alias("year")).agg(F.count("*").alias("records")),
    "papers": _on_kept(entities.papers),
    "author_registry": _on_kept(entities.authors),
    "institution_registry": _on_kept(entities.institutions),
    "keyword_registry": _on_kept(entities.keywords),
    "paper_authors": _on_kept(entities.paper_authors),
    "paper_institutions": _on_kept(entities.paper_institutions),
    "paper_keywords": _on_kept(entities.paper_keywords),
    "keywords_by_type": lambda s, d: entities.paper_keywords(_kept(s, d), ORDER).groupBy("keyword_type").agg(F.count("*").alias("keywords")),
    "top_authors": lambda s, d: entities.paper_authors(_kept(s, d), ORDER).groupBy("scopus_id").agg(F.count("*").alias("papers")).orderBy(F.desc("papers"), "scopus_id").limit(10),
    "top_keywords": lambda s, d: entities.paper_keywords(_kept(s, d), ORDER).groupBy("normalized_text").agg(F.count("*").alias("papers")).orderBy(F.desc("papers"), "normalized_text").limit(10),
    "references_parsed": _on_kept(details.references),
    "reference_count": lambda s, d: _records(s, d).select("record_id", F.size(text.split_list("ref_list")).alias("n_refs")),
    "yearly_counts": lambda s, d: coverage.yearly_counts(_records(s, d)),
    "year_range": lambda s, d: coverage.year_range(_records(s, d)),
    "timeline": lambda s, d: coverage.timeline(coverage.yearly_counts(_records(s, d))),
    "peak_year": lambda s, d: coverage.peak(coverage.yearly_counts(_records(s, d))),
    "yearly_coverage": lambda s, d: coverage.yearly_coverage(
        coverage.yearly_counts(_records(s, d)).withColumnRenamed("records", "expected"), coverage.yearly_counts(_kept(s, d))
    ),
    "completeness": lambda s, d: coverage.completeness(_records(s, d), _FILLED),
    "recovery_potential": lambda s, d: coverage.recovery_potential(_records(s, d)),
    "expected_counts": lambda s, d: coverage.expected_counts(_records(s, d)),
    "population": lambda s, d: coverage.population(
        coverage.expected_counts(_kept(s, d)).select("item", F.col("distinct_items").alias("expected")),
        analytics.stats({
            "authors": entities.author_tokens(_kept(s, d), ORDER).select("scopus_id").distinct(),
            "affiliations": entities.institution_tokens(_kept(s, d), ORDER).select("canonical_name").distinct(),
            "author_keywords": entities.keyword_tokens(_kept(s, d), ORDER).filter("pass = 0").select("normalized_text").distinct(),
        }).select(F.col("table_name").alias("item"), F.col("rows").alias("actual")),
    ),
    "validation": _validation,
    "patents_flat": lambda s, d: patents.flat(_patents(s, d)),
    "patent_table": _patent_rows,
    "patent_summary": lambda s, d: patents.summary(_patents(s, d)),
    "patent_filing_range": lambda s, d: patents.filing_range(_patents(s, d)),
    "patent_inventors": lambda s, d: patents.party_table(_patents(s, d), "inventor"),
    "patent_applicants": lambda s, d: patents.party_table(_patents(s, d), "applicant"),
    "patent_confirmation": lambda s, d: patents.confirmation(_patents(s, d)),
    "citing_lookup": lambda s, d: patents.citing(_patents(s, d), _records(s, d).select("doi")),
    "patent_search": lambda s, d: patents.search(_patents(s, d), title_words=["micropump"], size=25),
    "author_links": lambda s, d: patents.link_by_authors(_kept(s, d), _patents(s, d)),
    "institution_links": lambda s, d: patents.link_by_institutions(_kept(s, d), _patents(s, d)),
    "subject_links": lambda s, d: patents.link_by_subjects(_kept(s, d), _patents(s, d)),
    "patent_field_presence": lambda s, d: patents.field_presence(_patents(s, d)),
    "country_pairs": lambda s, d: analytics.country_pairs(entities.institution_tokens(_kept(s, d), ORDER), _cited(s, d)),
    "keyword_trend": lambda s, d: analytics.keyword_trend(entities.keyword_tokens(_kept(s, d), ORDER), _cited(s, d)),
    "attempts": lambda s, d: analytics.attempts(_t("events")(s, d).select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], ["event_id"]),
    "resume": lambda s, d: analytics.resume(
        _t("customer")(s, d).select(F.col("c_custkey").alias("user_id")), _t("events")(s, d).select("user_id", F.col("event_type").alias("status"), "event_id"), "user_id", ["event_id"], "click"),
    "exclusions_by_year": lambda s, d: quality.exclusions_by_year(_records(s, d)),
    "exclusion_samples": lambda s, d: quality.exclusion_samples(_records(s, d), ORDER),
    "orphaned_works": lambda s, d: coverage.orphans(
        _works(s, d).select("work_id", F.lower(F.try_element_at("container_title", F.lit(1))).alias("journal")).filter("journal is not null"),
        _t("journals")(s, d).select(F.lower("source_title").alias("journal")), "journal"),
    "institution_patents": lambda s, d: analytics.institution_patents(_pubs(s, d), _links(s, d), _patent_rows(s, d), "University"),
    "patented_subjects": lambda s, d: analytics.patented_subjects(_pubs(s, d), _links(s, d), least_links=2),
    "worst_years": lambda s, d: coverage.worst_years(QUERIES["yearly_coverage"](s, d)),
    "match_bands": lambda s, d: _match_journal(s, d).groupBy(similarity.confidence_status(F.col("confidence")).alias("status")).agg(F.count("*").alias("pairs")),
    "completeness_bands": lambda s, d: coverage.completeness(_records(s, d), _FILLED).select("column_name", coverage.completeness_band(F.col("rate")).alias("band")),
    "exclusion_grades": lambda s, d: quality.breakdown(_records(s, d)).select("category", quality.friendly()["friendly_name"].alias("friendly_name"), quality.grade(F.col("rate")).alias("grade")),
    "document_funding": lambda s, d: details.funding(_t("documents")(s, d), "doc_id", "text"),
    "document_parts": _document_parts,
    "innovation_links": _links,
    "innovation_metrics": lambda s, d: analytics.innovation_metrics(_pubs(s, d), _links(s, d)),
    "confidence_histogram": lambda s, d: analytics.confidence_histogram(_links(s, d)),
    "link_types": lambda s, d: analytics.link_types(_links(s, d)),
    "lag_histogram": lambda s, d: analytics.lag_histogram(_pubs(s, d), _links(s, d), _patent_rows(s, d)),
    "mean_time_to_patent": lambda s, d: analytics.mean_time_to_patent(_pubs(s, d), _links(s, d), _patent_rows(s, d)),
    "institution_ranking": lambda s, d: analytics.institution_ranking(_pubs(s, d), _links(s, d)),
    "subject_ranking": lambda s, d: analytics.subject_ranking(_pubs(s, d), _links(s, d), least_pubs=2),
    "collaboration_groups": lambda s, d: analytics.collaboration_groups(_pubs(s, d), _links(s, d)),
    "author_profile": lambda s, d: analytics.author_profile(_pubs(s, d), _links(s, d), "Laxarholt"),
    "author_patents": lambda s, d: analytics.author_patents(_pubs(s, d), _links(s, d), _patent_rows(s, d), "Laxarholt"),
    "table_stats": lambda s, d: analytics.stats({"records": _records(s, d), "patents": _patents(s, d), "works": _works(s, d)}),
    "match_by_journal": _match_journal,
    "match_by_title": _match_title,
    "canonical_names": lambda s, d: _t("party_names")(s, d).select("name_id", text.canonical_author("name_text").alias("canonical"), text.normalize_keyword("name_text").alias("normalized")),
    "clean_names": lambda s, d: _t("party_names")(s, d).select("name_id", text.clean_person("name_text").alias("person"), text.clean_institution("name_text").alias("institution")),
    "name_variants": lambda s, d: _t("party_names")(s, d).filter("name_kind = 'person'").select("name_id", F.explode(text.name_variants(text.clean_person("name_text"))).alias("variant")),
    "document_patterns": lambda s, d: _t("documents")(s, d).select(
        "doc_id", F.size(text.grants("text")).alias("n_grants"), F.regexp_extract(text.text("text"), f"({text.EMAIL})", 1).alias("email"), text.year_of("text").alias("first_year"),
        text.truncated("text", 50).alias("head"),
    ),
    "year_proximity": lambda s, d: _t("orders")(s, d).join(_t("lineitem")(s, d), F.col("o_orderkey") == F.col("l_orderkey")).groupBy(
        similarity.year_proximity(F.year("o_orderdate"), F.year("l_shipdate")).alias("proximity")).agg(F.count("*").alias("pairs")),
    "upsert_replace": lambda s, d: ids.insert_or_replace(
        _t("events")(s, d).filter("event_id % 2 = 0").select("user_id", "event_type", "event_id", "value").transform(lambda x: ids.first_by(x, ["user_id", "event_type"], ["event_id"])),
        _t("events")(s, d).filter("event_id % 2 = 1").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], ["event_id"]),
    "upsert_ignore": lambda s, d: ids.insert_or_ignore(
        _t("events")(s, d).filter("event_id % 2 = 0").select("user_id", "event_type", "event_id", "value").transform(lambda x: ids.first_by(x, ["user_id", "event_type"], ["event_id"])),
        _t("events")(s, d).filter("event_id % 2 = 1").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], ["event_id"]),
    "stream_ingest": _stream_ingest,
    "event_windows": lambda s, d: ingest.windowed_counts(_t("events")(s, d)).select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "events", F.round("total", 4).alias("total")),
    "json_properties": lambda s, d: _t("events")(s, d).select("event_id", F.md5("props").alias("props_key"), text.cache_key(F.col("event_type"), F.col("props")).alias("cache_key")),
}

_SIM = lambda a, b: f"(CASE WHEN len({a}) > 0 AND len({b}) > 0 THEN len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b}))) ELSE 0::DOUBLE END)"

_HEAD = "split_part(v, ',', 1)"
_D = lambda x: f"({x})::DOUBLE"
_LAST = lambda x: f"list_distinct(list_transform(list_filter({_LIST(x)}, lambda v: contains(v, ',')), lambda v: lower({_STRIP(_HEAD)})))"
_MATCH = f"""WITH l AS (SELECT record_id, title, authors, pub_year AS year, volume, source_title AS journal, page_start,
    regexp_replace({_TXT('page_start')} || '-' || {_TXT('page_end')}, '^-+|-+$', '', 'g') AS pages FROM scopus_records),
  r AS (SELECT work_id, title[1] AS w_title, CAST(published.date_parts[1][1] AS VARCHAR) AS w_year, volume AS w_volume, page AS w_pages, container_title[1] AS w_journal,
    array_to_string(list_transform(coalesce(author, []), lambda a: CASE WHEN coalesce(a.given, '') <> '' THEN coalesce(a.family, '') || ', ' || substr(a.given, 1, 1) || '.' ELSE coalesce(a.family, '') END), '; ') AS w_authors FROM crossref_works),
  lk AS (SELECT *, lower({_STRIP(_TXT('journal'))}) || '|' || {_STRIP(_TXT('volume'))} || '|' || split_part(page_start, '-', 1) AS k FROM l WHERE {_STRIP(_TXT('volume'))} <> '' AND {_TXT('page_start')} <> ''),
  rk AS (SELECT *, lower({_STRIP(_TXT('w_journal'))}) || '|' || {_STRIP(_TXT('w_volume'))} || '|' || split_part(w_pages, '-', 1) AS k FROM r WHERE {_STRIP(_TXT('w_volume'))} <> '' AND {_TXT('w_pages')} <> ''),
  p AS (SELECT record_id, work_id, {_WORDS(f"lower({_TXT('title')})")} AS tw, {_WORDS(f"lower({_TXT('w_title')})")} AS ww, {_LAST('authors')} AS la, {_LAST('w_authors')} AS lb,
    {_STRIP(_TXT('year'))} <> '' AND {_TXT('w_year')} <> '' AS known_year, {_STRIP(_TXT('year'))} = {_TXT('w_year')} AS years, {_STRIP(_TXT('volume'))} = {_TXT('w_volume')} AS volume_match,
    {_TXT('pages')} <> '' AND contains({_TXT('w_pages')}, {_TXT('pages')}) AS pages_match FROM lk JOIN rk USING (k)),
  q AS (SELECT *, {_SIM('tw', 'ww')} AS title_sim, {_SIM('la', 'lb')} AS author_sim, known_year AND years AS year_match FROM p)
SELECT record_id, work_id, least(greatest({_D(0.85)} + CASE WHEN year_match THEN {_D(0.1)} WHEN known_year THEN {_D(-0.3)} ELSE {_D(-0.1)} END
    + CASE WHEN title_sim > 0.8 THEN {_D(0.1)} WHEN title_sim < 0.5 THEN {_D(-0.2)} ELSE {_D(0.0)} END
    + CASE WHEN author_sim > 0.5 THEN {_D(0.1)} WHEN author_sim < 0.2 AND len(la) > 0 AND len(lb) > 0 THEN {_D(-0.1)} ELSE {_D(0.0)} END
    + CASE WHEN volume_match AND pages_match THEN {_D(0.1)} WHEN NOT volume_match THEN {_D(-0.2)} ELSE {_D(0.0)} END, {_D(0)}), {_D(1)}) AS confidence,
  title_sim, author_sim, year_match, volume_match, pages_match FROM q"""
_ASCII = lambda x: f"regexp_replace(strip_accents({_TXT(x)}), '[^\\x00-\\x7f]', '', 'g')"
_TITLE_LIST = "[" + ", ".join(f"'{t}'" for t in sorted(text.ACADEMIC_TITLES)) + "]"


def _PERSON_SQL(x: str) -> str:  # noqa: N802
    bare = f"list_transform({_WORDS(f'lower({_ASCII(x)})')}, lambda v: regexp_replace(v, '[^\\w-]', '', 'g'))"
    kept = f"list_filter({bare}, lambda v: v <> '' AND NOT list_contains({_TITLE_LIST}, v))"
    name = f"array_to_string(list_transform({kept}, lambda v: upper(substr(v, 1, 1)) || substr(v, 2)), ' ')"
    return f"CASE WHEN length({name}) >= 3 AND regexp_matches({name}, '[A-Za-z]') THEN {name} ELSE '' END"


def _INSTITUTION_SQL(x: str) -> str:  # noqa: N802
    bare = f"regexp_replace({_STRIP(_ASCII(x))}, '^(the|an|a){_WS}+', '', 'i')"
    bare = f"regexp_replace({bare}, '\\([^)]*\\)', '', 'g')"
    bare = f"array_to_string({_WORDS(f'split_part({bare}, {chr(39)},{chr(39)}, 1)')}, ' ')"
    return _STRIP(f"split_part(split_part({bare}, ';', 1), ' - ', 1)")


_WORD_SET = lambda x: f"list_distinct({_WORDS(x)})"
_BARE_TITLE = lambda x: f"regexp_replace(lower({_TXT(x)}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')"
_MATCH_TITLE = f"""WITH l AS (SELECT record_id, title, authors, pub_year AS year, lower({_TXT('title')}) AS t FROM scopus_records),
  r AS (SELECT work_id, title[1] AS w_title, lower(coalesce(title[1], '')) AS t, CAST(published.date_parts[1][1] AS VARCHAR) AS w_year,
    array_to_string(list_transform(coalesce(author, []), lambda a: CASE WHEN coalesce(a.given, '') <> '' THEN coalesce(a.family, '') || ', ' || substr(a.given, 1, 1) || '.' ELSE coalesce(a.family, '') END), '; ') AS w_authors
    FROM crossref_works),
  a AS (SELECT DISTINCT t, {_WORD_SET('t')} AS raw, {_WORD_SET(_BARE_TITLE('t'))} AS bare FROM l),
  b AS (SELECT DISTINCT t, {_WORD_SET('t')} AS raw, {_WORD_SET(_BARE_TITLE('t'))} AS bare FROM r),
  n AS (SELECT a.t AS ta, b.t AS tb FROM a JOIN b ON len(list_intersect(a.raw, b.raw)) >= 0.65 * len(list_distinct(a.raw || b.raw)) AND len(a.raw) > 0 AND len(b.raw) > 0
     OR len(list_intersect(a.bare, b.bare)) >= 0.65 * len(list_distinct(a.bare || b.bare)) AND len(a.bare) > 0 AND len(b.bare) > 0),
  p AS (SELECT record_id, work_id, {_WORDS('l.t')} AS tw, {_WORDS('r.t')} AS ww, {_LAST('authors')} AS la, {_LAST('w_authors')} AS lb,
    {_STRIP(_TXT('year'))} <> '' AND {_TXT('w_year')} <> '' AS known_year, {_STRIP(_TXT('year'))} = {_TXT('w_year')} AS years
    FROM n JOIN l ON l.t = ta JOIN r ON r.t = tb),
  q AS (SELECT *, {_SIM('tw', 'ww')} AS title_sim, {_SIM('la', 'lb')} AS author_sim FROM p),
  s AS (SELECT record_id, work_id, title_sim, least(greatest({_D(0.70)} + CASE WHEN known_year AND years THEN {_D(0.1)} WHEN known_year THEN {_D(-0.3)} ELSE {_D(-0.1)} END
    + CASE WHEN author_sim > 0.5 THEN {_D(0.1)} WHEN author_sim < 0.2 AND len(la) > 0 AND len(lb) > 0 THEN {_D(-0.1)} ELSE {_D(0.0)} END, {_D(0)}), {_D(1)}) AS confidence FROM q)
SELECT record_id, work_id, 'title' AS method, confidence FROM s QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY confidence DESC, title_sim DESC, work_id) = 1"""
_POPULATION = f"""WITH {_KEPT}, {_AUTHOR_TOKENS}, {_INST_TOKENS}, {_KW_TOKENS},
  e AS (SELECT item, count(DISTINCT token) AS expected FROM ({" UNION ALL ".join(f"SELECT '{n}' AS item, unnest({_LIST(c)}) AS token FROM kept" for n, c in {"authors": "author_ids", "affiliations": "affiliations", "author_keywords": "author_keywords", "index_keywords": "index_keywords"}.items())}) GROUP BY 1),
  a AS (SELECT 'authors' AS item, count(DISTINCT scopus_id) AS actual FROM atok UNION ALL SELECT 'affiliations', count(DISTINCT canonical_name) FROM it UNION ALL SELECT 'author_keywords', count(DISTINCT normalized_text) FROM kt WHERE pass = 0)
SELECT item, expected, coalesce(actual, 0) AS actual, rate, CASE WHEN coalesce(actual, 0) = 0 THEN 'CRITICAL_FAIL' WHEN rate < 50 THEN 'FAIL' WHEN rate < 90 THEN 'WARNING' ELSE 'PASS' END AS status
FROM (SELECT *, CASE WHEN expected > 0 THEN coalesce(actual, 0) * {_D('100.0')} / expected ELSE 0 END AS rate FROM e LEFT JOIN a USING (item))"""

_VALIDATION = f"""WITH {_KEPT}, {_INST_TOKENS}, {_KW_TOKENS}, {_PAPER_AUTHORS},
  n AS (SELECT count(*) AS kept, count(*) FILTER (NOT ({_BLANK('affiliations')})) AS placed, count(*) FILTER (len({_LIST('ref_list')}) > 0) AS refs, count(*) FILTER (NOT ({_BLANK('ref_list')})) AS cited,
    count(*) FILTER (regexp_matches({_TXT('title')}, '[^\\x00-\\x7f]')) AS special, count(*) FILTER ({_BLANK('title')}) AS untitled, (SELECT count(*) FROM it) AS places,
    (SELECT count(*) - count(DISTINCT (record_id, scopus_id)) FROM pa) AS twice FROM kept)
SELECT 'paper_count' AS name, true AS passed, kept || ' of ' || kept AS details FROM n
UNION ALL SELECT 'paper_authors_orphans', true, '0 orphaned rows' UNION ALL SELECT 'paper_keywords_orphans', true, '0 orphaned rows'
UNION ALL SELECT 'paper_id_unique', true, '0 keys not unique' UNION ALL SELECT 'paper_authors_unique', twice = 0, twice || ' keys not unique' FROM n
UNION ALL SELECT 'institutions', places > 0 OR placed = 0, places || ' of ' || placed FROM n
UNION ALL SELECT 'references', refs > 0 OR cited = 0, refs || ' of ' || cited FROM n
UNION ALL SELECT 'special_characters', true, special || ' with special characters, 0 changed' FROM n
UNION ALL SELECT 'paper_content', true, '0 rows differ'
UNION ALL SELECT 'keyword_counts', coalesce(max(off), 0) < 5, printf('%.1f', coalesce(max(off), 0)) || ' % off at most' FROM (
  SELECT keyword_type, abs(count(DISTINCT (record_id, normalized_text)) - count(DISTINCT (record_id, lower(keyword_text)))) * 100.0 / count(DISTINCT (record_id, lower(keyword_text))) AS off FROM kt GROUP BY 1)
UNION ALL SELECT 'missing_titles', untitled * 100.0 / kept < 10, printf('%.2f', untitled * 100.0 / kept) || ' % blank' FROM n"""

SQL = {
    "validation": _VALIDATION,
    "match_by_journal": _MATCH,
    "population": _POPULATION,
    "quality_reasons": f"SELECT record_id, reason, CASE WHEN reason IS NOT NULL THEN split_part(reason, ':', 1) END AS category FROM (SELECT record_id, {_reason(False)} AS reason FROM scopus_records)",
    "quality_reasons_strict": f"SELECT record_id, reason, CASE WHEN reason IS NOT NULL THEN split_part(reason, ':', 1) END AS category FROM (SELECT record_id, {_reason(True)} AS reason FROM scopus_records)",
    **{
        f"exclusion_breakdown{suffix}": f"SELECT split_part(reason, ':', 1) AS category, count(*) AS excluded, count(*) * 100.0::DOUBLE / any_value(total) AS rate FROM (SELECT {_reason(strict)} AS reason, count(*) OVER () AS total FROM scopus_records) WHERE reason IS NOT NULL GROUP BY 1"
        for suffix, strict in (("", False), ("_strict", True))
    },
    "doi_dedup": f"WITH {_DEDUP} SELECT record_id, doi FROM d",
    "duplicate_log": f"SELECT k AS doi, record_id, kept_id, year FROM (SELECT {_STRIP(_TXT('doi'))} AS k, record_id, CASE WHEN {_INT('pub_year')} BETWEEN 2000 AND 2030 THEN CAST(pub_year AS INTEGER) END AS year, min(record_id) OVER (PARTITION BY {_STRIP(_TXT('doi'))}) AS kept_id FROM scopus_records) WHERE k <> '' AND record_id <> kept_id",
    "duplicates_by_year": f"SELECT year, count(*) AS duplicates FROM (SELECT {_STRIP(_TXT('doi'))} AS k, record_id, CASE WHEN {_INT('pub_year')} BETWEEN 2000 AND 2030 THEN CAST(pub_year AS INTEGER) END AS year, min(record_id) OVER (PARTITION BY {_STRIP(_TXT('doi'))}) AS kept_id FROM scopus_records) WHERE k <> '' AND record_id <> kept_id GROUP BY 1",
    "missing_doi_by_year": f"SELECT CASE WHEN {_INT('pub_year')} BETWEEN 2000 AND 2030 THEN CAST(pub_year AS INTEGER) END AS year, count(*) AS records FROM scopus_records WHERE {_BLANK('doi')} GROUP BY 1",
    "papers": f"WITH {_KEPT} SELECT record_id, row_number() OVER (ORDER BY record_id) AS paper_id, {_TXT('title')} AS title, CAST({_INT('pub_year')} AS INTEGER) AS year, {_TXT('doi')} AS doi, {_TXT('source_title')} AS source_title, {_TXT('volume')} AS volume, {_TXT('issue')} AS issue, {_TXT('page_start')} AS page_start, {_TXT('page_end')} AS page_end, CAST({_INT('page_count')} AS INTEGER) AS page_count, CAST(coalesce({_INT('cited_by')}, 0) AS INTEGER) AS cited_by, {_TXT('abstract')} AS abstract, {_TXT('document_type')} AS document_type, '' AS language_original, '' AS publication_stage, '' AS issn, '' AS isbn FROM kept",
    "author_registry": f"WITH {_KEPT}, {_AUTHOR_TOKENS}, f AS (SELECT scopus_id, record_id, pos, name FROM atok QUALIFY row_number() OVER (PARTITION BY scopus_id ORDER BY record_id, pos) = 1) SELECT row_number() OVER (ORDER BY record_id, pos) AS author_id, scopus_id, name AS full_name, {_CANON('name')} AS canonical_name, name AS abbreviated_name FROM f",
    "institution_registry": f"WITH {_KEPT}, {_INST_TOKENS}, f AS (SELECT * FROM it QUALIFY row_number() OVER (PARTITION BY canonical_name ORDER BY record_id, pos) = 1) SELECT row_number() OVER (ORDER BY record_id, pos) AS institution_id, canonical_name, country FROM f",
    "keyword_registry": f"WITH {_KEPT}, {_KW_TOKENS}, f AS (SELECT * FROM kt QUALIFY row_number() OVER (PARTITION BY normalized_text ORDER BY pass, record_id, pos) = 1) SELECT row_number() OVER (ORDER BY pass, record_id, pos) AS keyword_id, normalized_text, keyword_text, keyword_type AS keyword_category FROM f",
    "paper_authors": f"WITH {_KEPT}, {_PAPER_AUTHORS} SELECT record_id, scopus_id, CAST(position AS INTEGER) AS position, position = 1 AS first_author, position = n AS last_author FROM pa",
    "paper_institutions": f"WITH {_KEPT}, {_INST_TOKENS} SELECT record_id, canonical_name, count(*) AS author_count, count(*) = max(count(*)) OVER (PARTITION BY record_id) AS primary_affiliation FROM it GROUP BY 1, 2",
    "paper_keywords": f"WITH {_KEPT}, {_KW_TOKENS} SELECT record_id, normalized_text, keyword_type, CAST(min(pos) AS INTEGER) AS position FROM kt GROUP BY 1, 2, 3",
    "keywords_by_type": f"WITH {_KEPT}, {_KW_TOKENS} SELECT keyword_type, count(*) AS keywords FROM (SELECT DISTINCT record_id, normalized_text, keyword_type FROM kt) GROUP BY 1",
    "top_authors": f"WITH {_KEPT}, {_PAPER_AUTHORS} SELECT scopus_id, count(*) AS papers FROM pa GROUP BY 1 ORDER BY papers DESC, scopus_id LIMIT 10",
    "top_keywords": f"WITH {_KEPT}, {_KW_TOKENS} SELECT normalized_text, count(*) AS papers FROM (SELECT DISTINCT record_id, normalized_text, keyword_type FROM kt) GROUP BY 1 ORDER BY papers DESC, normalized_text LIMIT 10",
    "reference_count": f"SELECT record_id, CAST(len({_LIST('ref_list')}) AS INTEGER) AS n_refs FROM scopus_records",
    "yearly_counts": f"SELECT year, count(*) AS records FROM (SELECT {_YEAR} AS year FROM scopus_records) WHERE year IS NOT NULL GROUP BY 1",
    "year_range": f"SELECT min(y) AS first_year, max(y) AS last_year, count(y) AS with_year FROM (SELECT {_INT('pub_year')} AS y FROM scopus_records)",
    "timeline": f"WITH c AS (SELECT year, count(*) AS n FROM (SELECT {_YEAR} AS year FROM scopus_records) WHERE year IS NOT NULL GROUP BY 1) SELECT CAST(y AS INTEGER) AS year, coalesce(n, 0) AS records FROM (SELECT unnest(range((SELECT min(year) FROM c), (SELECT max(year) FROM c) + 1)) AS y) LEFT JOIN c ON c.year = y",
    "peak_year": f"WITH c AS (SELECT year, count(*) AS n FROM (SELECT {_YEAR} AS year FROM scopus_records) WHERE year IS NOT NULL GROUP BY 1) SELECT (SELECT year FROM c ORDER BY n DESC, year LIMIT 1) AS peak_year, max(n) AS peak_records, count(*) FILTER (n < 100) AS low_years FROM c",
    "yearly_coverage": f"WITH {_KEPT}, e AS (SELECT year, count(*) AS n FROM (SELECT {_YEAR} AS year FROM scopus_records) WHERE year IS NOT NULL GROUP BY 1), f AS (SELECT year, count(*) AS n FROM (SELECT {_YEAR} AS year FROM kept) WHERE year IS NOT NULL GROUP BY 1), j AS (SELECT coalesce(e.year, f.year) AS year, coalesce(e.n, 0) AS expected, coalesce(f.n, 0) AS found FROM e FULL JOIN f ON e.year = f.year), t AS (SELECT year, CAST(sum(expected) AS BIGINT) AS expected, CAST(sum(found) AS BIGINT) AS found FROM j GROUP BY ROLLUP (year)) SELECT year, expected, found, coverage, CASE WHEN coverage >= 95 THEN 'excellent' WHEN coverage >= 80 THEN 'good' ELSE 'needs_attention' END AS status FROM (SELECT *, CASE WHEN expected > 0 THEN found * 100.0::DOUBLE / expected ELSE 0 END AS coverage FROM t)",
    "completeness": " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (NOT ({_BLANK(c)})) AS filled, count(*) AS total, count(*) FILTER (NOT ({_BLANK(c)})) * 100.0::DOUBLE / count(*) AS rate FROM scopus_records" for c in _FILLED),
    "recovery_potential": f"SELECT CASE WHEN NOT ({_BLANK('source_title')}) AND (NOT ({_BLANK('volume')}) OR NOT ({_BLANK('page_start')})) THEN 'journal' WHEN length({_TXT('title')}) >= 10 THEN 'title' ELSE 'insufficient' END AS way, count(*) AS records FROM scopus_records WHERE {_BLANK('doi')} GROUP BY 1",
    "expected_counts": "SELECT item, count(DISTINCT token) AS distinct_items, count(*) AS items FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS item, unnest({_LIST(c)}) AS token FROM scopus_records" for n, c in {"authors": "author_ids", "affiliations": "affiliations", "author_keywords": "author_keywords", "index_keywords": "index_keywords"}.items()) + ") GROUP BY 1",
    "patents_flat": f"WITH {_FLAT} SELECT * EXCLUDE (citation_confirmed) FROM flat",
    "patent_table": f"WITH {_FLAT}, {_PATENT_ROWS} SELECT * FROM pr",
    **{
        f"patent_{kind}s": f"{NODES_SQL}, {_FLAT}, n AS ({table_sql(kind)}) SELECT lens_id, name, {mins} FROM n JOIN flat USING (rec_id) WHERE name IS NOT NULL AND name NOT IN ('', 'N/A') GROUP BY 1, 2"
        for kind, mins in (("inventor", "min(residence) AS residence"), ("applicant", 'min(residence) AS residence, min("type") AS "type"'))
    },
    "patent_confirmation": f"""{NODES_SQL}, c AS ({table_sql("citation")}), v AS ({ID_TABLE}), t AS (SELECT rec_id, target_doi FROM citing_patents_analysis WHERE target_doi <> ''),
      h AS (SELECT c.rec_id, c.child_no, c.sequence FROM c JOIN v ON v.rec_id = c.rec_id AND v.parent_no = c.child_no JOIN t ON t.rec_id = c.rec_id WHERE value = target_doi
        UNION ALL SELECT c.rec_id, child_no, sequence FROM c JOIN t USING (rec_id) WHERE contains(text, target_doi)),
      f AS (SELECT rec_id, arg_min(sequence, child_no) AS s FROM h GROUP BY 1)
      SELECT rec_id, f.rec_id IS NOT NULL AS citation_confirmed, coalesce(s, 'N/A') AS citation_sequence FROM citing_patents_analysis LEFT JOIN f USING (rec_id)""",
    "citing_lookup": f"""{NODES_SQL}, c AS ({table_sql("citation")}), v AS ({ID_TABLE})
      SELECT v.rec_id, doi, CAST(v.parent_no AS INTEGER) AS citation_no, sequence FROM v JOIN (SELECT DISTINCT doi FROM scopus_records WHERE doi <> '') d ON lower(value) = lower(doi)
      JOIN c ON c.rec_id = v.rec_id AND c.child_no = v.parent_no""",
    "clean_names": f"SELECT name_id, {_PERSON_SQL('name_text')} AS person, {_INSTITUTION_SQL('name_text')} AS institution FROM party_names",
    "name_variants": f"""WITH p AS (SELECT name_id, person, {_WORDS('person')} AS p FROM (SELECT name_id, {_PERSON_SQL('name_text')} AS person FROM party_names WHERE name_kind = 'person')),
      w AS (SELECT *, p[1] AS g, p[-1] AS f, substr(p[1], 1, 1) AS i, array_to_string(list_transform(p[1:greatest(len(p) - 1, 1)], lambda x: substr(x, 1, 1)), '') AS h FROM p),
      l AS (SELECT *, list_filter([person, g || ' ' || f, f || ' ' || g, f || ', ' || g, i || ' ' || f, i || '. ' || f, f || ' ' || i, f || ', ' || i, f || ', ' || i || '.',
        CASE WHEN len(p) > 2 THEN h || ' ' || f END, CASE WHEN len(p) > 2 THEN f || ' ' || h END], lambda v: v IS NOT NULL) AS l FROM w),
      d AS (SELECT *, list_filter(list_filter(l, lambda v, k: list_position(l, v) = k), lambda v: length(v) >= 3 AND contains(v, ' ')) AS u FROM l)
      SELECT name_id, unnest(CASE WHEN len(p) < 1 THEN [] WHEN len(p) < 2 THEN [person] ELSE u[1:5] END) AS variant FROM d""",
    "match_by_title": _MATCH_TITLE,
    "patent_summary": f"WITH {_FLAT}, u AS (SELECT * FROM flat QUALIFY row_number() OVER (PARTITION BY lens_id ORDER BY rec_id) = 1) SELECT 'jurisdiction' AS dimension, jurisdiction AS value, count(*) AS patents FROM u GROUP BY 2 UNION ALL SELECT 'legal_status', legal_status, count(*) FROM u GROUP BY 2",
    "patent_filing_range": f"WITH {_FLAT} SELECT min(filing_date) AS first_filing, max(filing_date) AS last_filing FROM flat WHERE filing_date <> 'N/A'",
    "patent_search": f"WITH {_FLAT}, {_PATENT_ROWS} SELECT * FROM pr WHERE contains(lower(title), 'micropump') ORDER BY publication_date DESC, lens_id LIMIT 25",
    "patent_field_presence": f"WITH {_FLAT} " + " UNION ALL ".join(f"SELECT '{c}' AS field, count(*) FILTER ({c} <> 'N/A') AS present, count(*) AS total FROM flat" for c in patents.PAYLOAD_PATHS),
    "country_pairs": f"WITH {_KEPT}, {_INST_TOKENS}, c AS (SELECT DISTINCT record_id, country FROM it WHERE country <> '') SELECT a.country AS country_a, b.country AS country_b, count(*) AS papers, avg(coalesce({_INT('cited_by')}, 0)) AS mean_citations FROM c a JOIN c b ON a.record_id = b.record_id AND a.country < b.country JOIN kept k ON k.record_id = a.record_id GROUP BY 1, 2",
    "keyword_trend": f"WITH {_KEPT}, {_KW_TOKENS} SELECT normalized_text, CAST({_INT('pub_year')} AS INTEGER) AS year, count(*) AS papers, avg(coalesce({_INT('cited_by')}, 0)) AS mean_citations FROM (SELECT DISTINCT record_id, normalized_text FROM kt) t JOIN kept USING (record_id) WHERE {_INT('pub_year')} IS NOT NULL GROUP BY 1, 2 HAVING papers >= 2",
    "attempts": "SELECT user_id, event_type, count(*) AS attempts, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2",
    "resume": "SELECT c_custkey AS user_id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events GROUP BY 1 HAVING arg_max(event_type, event_id) = 'click')",
    "exclusions_by_year": f"SELECT CAST({_INT('pub_year')} AS INTEGER) AS year, count(*) AS records, count({_reason(False)}) AS excluded FROM scopus_records GROUP BY 1",
    "exclusion_samples": f"SELECT record_id, split_part(reason, ':', 1) AS category, reason, title FROM (SELECT *, {_reason(False)} AS reason FROM scopus_records) WHERE reason IS NOT NULL QUALIFY row_number() OVER (PARTITION BY reason ORDER BY record_id) = 1",
    "orphaned_works": "SELECT work_id, lower(container_title[1]) AS journal FROM crossref_works WHERE container_title[1] IS NOT NULL AND NOT EXISTS (SELECT 1 FROM journals WHERE lower(source_title) = lower(container_title[1]))",
    "innovation_links": f"{_INNO} SELECT * FROM links",
    "innovation_metrics": f"{_INNO} SELECT (SELECT count(*) FROM pubs) AS publications, count(DISTINCT pub_id) AS with_patents, count(DISTINCT lens_id) AS patents, count(*) AS links, count(DISTINCT pub_id) * 100.0::DOUBLE / (SELECT count(*) FROM pubs) AS conversion_rate FROM links",
    "confidence_histogram": f"{_INNO} SELECT CASE WHEN confidence >= 0.8 THEN 'high' WHEN confidence >= 0.6 THEN 'medium' ELSE 'low' END AS band, count(*) AS links FROM links GROUP BY 1",
    "link_types": f"{_INNO} SELECT link_type, count(*) AS links FROM links GROUP BY 1",
    "lag_histogram": f"{_INNO}, {_LAGS} SELECT lag, count(*) AS links FROM lags WHERE lag BETWEEN 0 AND 10 GROUP BY 1",
    "mean_time_to_patent": f"{_INNO}, {_LAGS} SELECT avg(lag) AS mean_lag, count(*) AS links FROM lags WHERE lag >= 0",
    "institution_ranking": _ranking_sql(f"substr({_TXT('affiliations')}, 1, 100)", 5, 2),
    "subject_ranking": _ranking_sql(f"substr({_TXT('author_keywords')}, 1, 50)", 2, 0),
    "collaboration_groups": f"{_INNO} SELECT team, count(DISTINCT lens_id) AS patents, count(DISTINCT pub_id) AS publications, CAST(len({_LIST('team')}) AS INTEGER) AS team_size FROM (SELECT pub_id, {_TXT('authors')} AS team FROM pubs) JOIN links USING (pub_id) GROUP BY team HAVING patents >= 2 AND team_size > 1",
    "author_profile": f"{_INNO}, own AS (SELECT pub_id FROM pubs WHERE contains(lower({_TXT('authors')}), 'laxarholt')), l AS (SELECT * FROM links WHERE pub_id IN (SELECT pub_id FROM own)) SELECT (SELECT count(*) FROM own) AS publications, count(DISTINCT pub_id) AS with_patents, count(DISTINCT lens_id) AS patents, count(*) FILTER (confidence >= 0.8) AS strong_links, round_even(avg(confidence), 3) AS mean_confidence FROM l",
    "author_patents": f"{_INNO} SELECT DISTINCT lens_id, pr.title, publication_date, jurisdiction, pubs.title AS pub_title, year, confidence FROM links JOIN pubs USING (pub_id) JOIN pr USING (lens_id) WHERE contains(lower({_TXT('authors')}), 'laxarholt')",
    "table_stats": "SELECT 'records' AS table_name, count(*) AS rows FROM scopus_records UNION ALL SELECT 'patents', count(*) FROM citing_patents_analysis UNION ALL SELECT 'works', count(*) FROM crossref_works",
    "canonical_names": f"SELECT name_id, {_CANON('name_text')} AS canonical, {_NORM('name_text')} AS normalized FROM party_names",
    "document_patterns": rf"SELECT doc_id, CAST(len(regexp_extract_all({_TXT('text')}, '{text.GRANT}')) AS INTEGER) AS n_grants, regexp_extract({_TXT('text')}, '{text.EMAIL}') AS email, TRY_CAST(nullif(regexp_extract({_TXT('text')}, '(?:^|[^\p{{L}}\p{{N}}_])((?:19|20)[0-9]{{2}})(?:[^\p{{L}}\p{{N}}_]|$)', 1), '') AS INTEGER) AS first_year, CASE WHEN length(text) > 50 THEN substr(text, 1, 50) || '...' ELSE text END AS head FROM documents",
    "year_proximity": "SELECT proximity, count(*) AS pairs FROM (SELECT CASE WHEN lag IS NULL THEN 0::DOUBLE WHEN lag >= 0 THEN CASE WHEN lag <= 1 THEN 1.0::DOUBLE WHEN lag <= 3 THEN 0.8::DOUBLE WHEN lag <= 5 THEN 0.6::DOUBLE WHEN lag <= 10 THEN 0.3::DOUBLE ELSE 0.1::DOUBLE END ELSE CASE WHEN -lag <= 1 THEN 0.7::DOUBLE WHEN -lag <= 3 THEN 0.4::DOUBLE WHEN -lag <= 5 THEN 0.2::DOUBLE ELSE 0.1::DOUBLE END END AS proximity FROM (SELECT year(l_shipdate) - year(o_orderdate) AS lag FROM orders JOIN lineitem ON o_orderkey = l_orderkey)) GROUP BY 1",
    "upsert_replace": "WITH a AS (SELECT user_id, event_type, event_id, value FROM events WHERE event_id % 2 = 0 QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1), b AS (SELECT user_id, event_type, event_id, value FROM events WHERE event_id % 2 = 1 QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1) SELECT * FROM b UNION ALL SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.user_id = a.user_id AND b.event_type = a.event_type)",
    "upsert_ignore": "WITH a AS (SELECT user_id, event_type, event_id, value FROM events WHERE event_id % 2 = 0 QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1), b AS (SELECT user_id, event_type, event_id, value FROM events WHERE event_id % 2 = 1 QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1) SELECT * FROM a UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE b.user_id = a.user_id AND b.event_type = a.event_type)",
    "stream_ingest": f"WITH {_DEDUP} SELECT record_id, doi FROM d",
    "event_windows": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS events, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "json_properties": "SELECT event_id, md5(props) AS props_key, md5(event_type || ':' || props) AS cache_key FROM events",
}
_CASES = lambda x, names: f"CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + " END"
SQL |= {
    "worst_years": f"SELECT * FROM ({SQL['yearly_coverage']}) WHERE year IS NOT NULL",
    "match_bands": f"SELECT CASE WHEN confidence >= 0.9 THEN 'high' WHEN confidence >= 0.7 THEN 'medium' WHEN confidence >= 0.5 THEN 'low' ELSE 'very_low' END AS status, count(*) AS pairs FROM ({_MATCH}) GROUP BY 1",
    "completeness_bands": f"SELECT column_name, CASE WHEN rate < 90 THEN 'significant' WHEN rate < 98 THEN 'minor' ELSE 'complete' END AS band FROM ({SQL['completeness']})",
    "exclusion_grades": f"SELECT category, {_CASES('category', quality.CATEGORY_NAMES)} AS friendly_name, CASE WHEN rate < 5 THEN 'excellent' WHEN rate < 15 THEN 'good' WHEN rate < 30 THEN 'fair' ELSE 'poor' END AS grade FROM ({SQL['exclusion_breakdown']})",
    "institution_patents": f"{_INNO} SELECT DISTINCT lens_id, pr.title, publication_date, confidence, link_type, pubs.title AS pub_title, authors FROM links JOIN pubs USING (pub_id) JOIN pr USING (lens_id) WHERE contains(lower({_TXT('affiliations')}), 'university')",
    "patented_subjects": f"{_INNO} SELECT substr(author_keywords, 1, 50) AS subject, count(*) AS links FROM links JOIN pubs USING (pub_id) WHERE confidence >= 0.7 AND {_TXT('author_keywords')} <> '' GROUP BY 1 HAVING count(*) >= 2",
    "document_funding": f"""WITH e AS (SELECT doc_id, generate_subscripts(l, 1) AS funding_id, unnest(l) AS entry FROM (SELECT doc_id, {_LIST('text')} AS l FROM documents)),
      g AS (SELECT *, regexp_extract_all(entry, '{text.GRANT}') AS grant_numbers FROM e),
      a AS (SELECT *, {_STRIP("regexp_replace(list_reduce(list_concat([entry], grant_numbers), lambda x, y: " + _STRIP("replace(x, y, '')") + "), '[,;]+$', '')")} AS agency_name FROM g)
      SELECT doc_id, CAST(funding_id AS INTEGER) AS funding_id, agency_name, grant_numbers FROM a WHERE length(agency_name) > 3""",
    "document_parts": f"""WITH t AS (SELECT doc_id, split_part({_TXT('text')}, chr(10), 1) AS t FROM documents)
      SELECT doc_id, nullif(regexp_extract(t, '{text.CAS}'), '') AS cas_number, {_STRIP("regexp_replace(t, '[(][^)]*[)]', '', 'g')")} AS trade_name,
        CASE WHEN regexp_extract(t, '[(]([^)]+)[)]', 1) <> '' THEN {_STRIP("regexp_extract(t, '[(]([^)]+)[)]', 1)")} END AS manufacturer,
        {_STRIP("split_part(split_part(t, ';', 1), ',', 1)")} AS author_name, nullif(regexp_extract(t, '{text.EMAIL}'), '') AS email,
        regexp_matches(lower(t), '{"|".join(text.OPEN_ACCESS_WORDS)}') AS open_access, regexp_matches(t, '@[^@]*[.]') AS has_address FROM t""",
}
