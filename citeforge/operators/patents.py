"""Patent records: one flat shape for both deliveries, citation look-ups, tables, links
(survey ARR-06/07, SRC-13..16, JOIN-13/15, PIPE-15/16/21, AGG-23)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeforge.functions.similarity import SEQUENCE_MATCH, sequence_ratio
from citeforge.functions.text import (
    INSTITUTION_WORDS, ascii_form, ascii_institution, ascii_person, clean_institution, clean_person, split_list, text, year_of,
)
from citeforge.operators.ids import first_by
from citeforge.operators.linking import meet
from citeforge.operators.nested import node_tables
from citeforge.session import cut

#: Flat columns of a patent and where the payload has them (fixed values).
PAYLOAD_PATHS = {
    "lens_id": "$.lens_id", "doc_key": "$.doc_key", "doc_number": "$.doc_number", "jurisdiction": "$.jurisdiction", "kind_code": "$.kind",
    "publication_date": "$.date_published", "publication_type": "$.publication_type", "title": "$.biblio.invention_title[0].text",
    "application_number": "$.biblio.application_reference.doc_number", "filing_date": "$.biblio.application_reference.date",
    "filing_jurisdiction": "$.biblio.application_reference.jurisdiction", "priority_date": "$.biblio.priority_claims.earliest_claim.date",
    "priority_jurisdiction": "$.biblio.priority_claims.earliest_claim.jurisdiction", "legal_status": "$.legal_status.patent_status",
    "family_id": "$.families.simple_family.family_id",
}
MISSING = "N/A"


def flat(patents: DataFrame) -> DataFrame:
    """[ARR-06] ``rec_id, target_doi`` and the flat columns: a column that is given is used,
    else the payload's value, else ``N/A``; ``family_size`` 0 where none is given."""
    doc = F.try_parse_json("payload")
    value = lambda c, p: F.coalesce(F.col(c), F.try_variant_get(doc, p, "string"), F.lit(MISSING)).alias(c)
    size = F.coalesce(F.col("family_size"), F.try_variant_get(doc, "$.families.simple_family.size", "int"), F.lit(0))
    return patents.select("rec_id", "target_doi", *[value(c, p) for c, p in PAYLOAD_PATHS.items()], size.alias("family_size"))


def known(c: str) -> Column:
    return F.when(F.col(c) != MISSING, F.col(c))


def patent_year(c: str = "publication_date") -> Column:
    """[DAT-01, NUM-14]"""
    return year_of(c)


def citing(patents: DataFrame, dois: DataFrame) -> DataFrame:
    """[SRC-16, JOIN-15] ``rec_id, doi, citation_no, sequence`` of every citation of a document of
    ``dois(doi)`` by an external id: one equi-join on the lower-case id."""
    nodes = node_tables(patents, written=True)
    ids = nodes["external_id"].select("rec_id", "pre", "post", F.lower("value").alias("id"))
    cites = nodes["citation"].select(
        "rec_id", F.col("pre").alias("c_pre"), F.col("post").alias("c_post"), F.col("child_no").alias("citation_no"), "sequence"
    )
    wanted = dois.select("doi", F.lower("doi").alias("id")).filter("id <> ''").distinct()
    hits = ids.join(wanted, "id")
    return hits.join(cites, "rec_id").filter("c_pre < pre and post < c_post").select("rec_id", "doi", "citation_no", "sequence")


def confirmation(patents: DataFrame) -> DataFrame:
    """``rec_id, citation_confirmed, citation_sequence`` of a record's own target document: the
    first citation whose external ids hold it or whose text contains it."""
    nodes = node_tables(patents, written=True)
    target = patents.select("rec_id", "target_doi").filter("target_doi <> ''")
    cites, ids = nodes["citation"], nodes["external_id"]
    by_id = (
        ids.join(target, "rec_id")
        .filter(F.col("value") == F.col("target_doi"))
        .select("rec_id", F.col("pre").alias("e_pre"), F.col("post").alias("e_post"))
        .join(cites.select("rec_id", "pre", "post", "child_no", "sequence"), "rec_id")
        .filter("pre < e_pre and e_post < post")
        .select("rec_id", "child_no", "sequence")
    )
    by_text = cites.join(target, "rec_id").filter(F.contains("text", "target_doi")).select("rec_id", "child_no", "sequence")
    hit = by_id.unionByName(by_text).groupBy("rec_id").agg(F.min_by("sequence", "child_no").alias("s"), F.count("*").alias("n"))
    return patents.select("rec_id").join(hit, "rec_id", "left").select(
        "rec_id", F.col("n").isNotNull().alias("citation_confirmed"), F.coalesce("s", F.lit(MISSING)).alias("citation_sequence")
    )


def patent_table(patents: DataFrame) -> DataFrame:
    """[PIPE-16, SNK-03] One row per ``lens_id``, its first delivery; title cut at 500."""
    rows = flat(patents).filter(F.col("lens_id") != MISSING)
    firsts = first_by(rows, ["lens_id"], ["rec_id"])
    return firsts.select(
        "lens_id", F.substring("title", 1, 500).alias("title"), "publication_date", F.col("publication_type").alias("patent_type"), "jurisdiction"
    )


def party_table(patents: DataFrame, kind: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Distinct parties of every patent: ``lens_id, name`` and what else is known of them."""
    parties = (tables or node_tables(patents))[kind]
    ids = flat(patents).select("rec_id", "lens_id")
    extra = [c for c in parties.columns if c in ("residence", "type")]
    named = parties.filter(F.col("name").isNotNull() & ~F.col("name").isin("", MISSING)).join(ids, "rec_id")
    return named.groupBy("lens_id", "name").agg(*[F.min(c).alias(c) for c in extra])


def summary(patents: DataFrame) -> DataFrame:
    """[AGG-23] ``dimension, value, patents`` by jurisdiction and by status, over distinct patents."""
    rows = first_by(flat(patents), ["lens_id"], ["rec_id"])
    dims = F.explode(
        F.array(
            F.struct(F.lit("jurisdiction").alias("dimension"), F.col("jurisdiction").alias("value")),
            F.struct(F.lit("legal_status").alias("dimension"), F.col("legal_status").alias("value")),
        )
    )
    return rows.select(dims.alias("d")).groupBy("d.dimension", "d.value").agg(F.count("*").alias("patents"))


def filing_range(patents: DataFrame) -> DataFrame:
    """[AGG-23, ORD-04] First and last filing date that is known."""
    return flat(patents).agg(F.min(known("filing_date")).alias("first_filing"), F.max(known("filing_date")).alias("last_filing"))


def search(patents: DataFrame, inventor: str | None = None, applicant: str | None = None, title_words: list[str] | None = None,
           size: int = 50, from_: int = 0) -> DataFrame:
    """[SRC-13, SRC-14, ORD-08] Patents of a party or with title words, newest first, paged."""
    if not 1 <= size <= 1000 or from_ < 0:
        raise ValueError("size must be 1 to 1000 and from_ at least 0")
    hits = patent_table(patents)
    for kind, name in (("inventor", inventor), ("applicant", applicant)):
        if name:
            of = party_table(patents, kind).filter(F.contains(F.lower("name"), F.lit(name.lower()))).select("lens_id")
            hits = hits.join(of.distinct(), "lens_id", "left_semi")
    for w in title_words or []:
        hits = hits.filter(F.contains(F.lower("title"), F.lit(w.lower())))
    return hits.orderBy(F.desc("publication_date"), "lens_id").offset(from_).limit(size)


# --- links between publications and patents ----------------------------------------------


def publications(records: DataFrame, id_col: str = "record_id") -> DataFrame:
    """``pub_id, title, year, people, institutions, contexts, keywords`` [STR-11, WIN-07, DAT-02]: ``people``
    and ``institutions`` are the cleaned lower-case names that are scored, ``contexts`` the cleaned
    names of all institutions listed with more than five characters, in their order."""
    ascii_ = records.select(
        F.col(id_col).alias("pub_id"), text("title").alias("title"), F.col("pub_year").try_cast("int").alias("year"),
        ascii_form(text("authors")).alias("authors"), ascii_form(text("affiliations")).alias("affiliations"), "author_keywords",
    )
    institution = lambda v: F.lower(ascii_institution(v))
    return ascii_.select(
        "pub_id", "title", "year",
        F.filter(F.transform(split_list("authors", ";", 2), lambda v: F.lower(ascii_person(v))), lambda v: v != "").alias("people"),
        F.filter(F.transform(split_list("affiliations"), institution), lambda v: F.length(v) > 5).alias("institutions"),
        F.transform(split_list("affiliations", ";", 5), institution).alias("contexts"),
        split_list("author_keywords", ";", 2).alias("keywords"),
    )


def _parties(patents: DataFrame) -> dict[str, DataFrame]:
    """``lens_id, name, cleaned`` of inventors and applicants, from one walk of the records."""
    tables = node_tables(patents, written=True)
    clean = {"inventor": clean_person, "applicant": clean_institution}
    return {k: cut(party_table(patents, k, tables).select("lens_id", "name", F.lower(f("name")).alias("cleaned")), k) for k, f in clean.items()}


def _patent_side(patents: DataFrame, parties: dict[str, DataFrame]) -> DataFrame:
    """``lens_id, title, year, inventors, applicants`` of every patent, for scoring: titles lower case, null where missing."""
    applicants = parties["applicant"].groupBy("lens_id").agg(F.collect_set("cleaned").alias("applicants"))
    inventors = parties["inventor"].filter("cleaned <> ''").groupBy("lens_id").agg(F.collect_set("cleaned").alias("inventors"))
    rows = patent_table(patents).select(
        "lens_id", F.when(F.col("title") != MISSING, F.lower("title")).alias("title"), patent_year("publication_date").alias("year")
    )
    none = F.array().cast("array<string>")
    both = rows.join(applicants, "lens_id", "left").join(inventors, "lens_id", "left")
    return cut(both.withColumns({c: F.coalesce(c, none) for c in ("applicants", "inventors")}), "link-patents")


def _publication_side(records: DataFrame, id_col: str, *columns: str) -> DataFrame:
    """What a phase scores of ``publications``, keywords in lower case: cleaning is most of the time."""
    return cut(publications(records, id_col).select("pub_id", "year", F.transform("keywords", F.lower).alias("keywords"), *columns), "link-publications")


def link_by_authors(records: DataFrame, patents: DataFrame, id_col: str = "record_id", most: int = 5, threshold: float | None = None) -> DataFrame:
    """[JOIN-13, PIPE-15, SIM-10, SIM-11] ``pub_id, lens_id, link_type, confidence`` of the author phase.

    A patent is a candidate if an inventor has the family name (the last word) of one of the first
    ``most`` authors (the first word of ``Last, F.``); the score is the weighted sum of name,
    institution, year and subject similarity, the best of the authors' names with any inventor's."""
    pubs, patent_side = _publication_side(records, id_col, "people", "institutions"), _patent_side(patents, _parties(patents))
    families = F.array_distinct(F.transform("inventors", lambda v: F.element_at(F.split(v, " "), -1)))
    # Written with the family name first, or last where there is no comma: either end may be it.
    ends = F.array_distinct(F.flatten(F.transform(F.slice("people", 1, most), lambda p: F.array(F.substring_index(p, " ", 1), F.substring_index(p, " ", -1)))))
    left = pubs.select("pub_id", "year", "keywords", "institutions", F.slice("people", 1, most).alias("people"), F.explode(F.filter(ends, lambda w: F.length(w) > 1)).alias("key"))
    right = patent_side.select("*", F.explode(families).alias("key"))
    return meet(left, right, "author_match", threshold)


#: Institutions are searched for by names of at least this ratio.
NAME_HIT = SEQUENCE_MATCH
_KINDS = "|".join([*INSTITUTION_WORDS, "institut", "hospital", "technical", "department", "faculty"])


def similar_names(left: DataFrame, right: DataFrame) -> DataFrame:
    """``a, b``: distinct names (column ``name``) of both sides whose ratio is at least ``NAME_HIT`` and
    that share a telling word (of four letters and more that names no kind), or such a word with one
    letter mistyped, left out or added: both sides are keyed by every such word and by the word
    with each letter removed. A name without telling word is keyed as a whole."""
    telling = F.filter(F.split("name", "[^a-z0-9]+"), lambda w: (F.length(w) >= 4) & ~w.rlike(_KINDS))
    keyed = F.when(F.size(telling) > 0, telling).otherwise(F.array(F.regexp_replace("name", "[^a-z0-9]+", "")))
    without = lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substring(w, 1, i - 1), F.substring(w, i + 1, F.length(w))))
    keys = F.array_distinct(F.flatten(F.transform(F.filter(keyed, lambda w: w != ""), lambda w: F.concat(F.array(w), without(w)))))
    sides = [df.select("name").filter("name <> ''").distinct().select("name", F.explode(keys).alias("key")) for df in (left, right)]
    pairs = sides[0].withColumnRenamed("name", "a").join(sides[1].withColumnRenamed("name", "b"), "key").select("a", "b").distinct()
    return pairs.filter(sequence_ratio("a", "b") >= NAME_HIT)


def link_by_institutions(records: DataFrame, patents: DataFrame, id_col: str = "record_id", most: int = 3, threshold: float | None = None) -> DataFrame:
    """[SIM-12, SIM-13, SIM-17] The institution phase: an applicant has a name like one of the first
    ``most`` institutions (``similar_names``, over the few distinct names)."""
    pubs, patent_side = _publication_side(records, id_col, "people", "contexts"), _patent_side(patents, _parties(patents))
    listed = pubs.select("pub_id", "year", "keywords", F.array_distinct("people").alias("people"), F.slice("contexts", 1, most).alias("contexts"))
    left = listed.select("*", F.explode(F.array_distinct("contexts")).alias("a"))
    right = patent_side.select("*", F.explode("applicants").alias("key"))
    near = cut(similar_names(left.select(F.col("a").alias("name")), right.select(F.col("key").alias("name"))), "institution-names")
    return meet(left.join(near.withColumnRenamed("b", "key"), "a").drop("a"), right, "institution_match", threshold)


#: Rows of a keyword are many and small: larger tiles, so that few copies of them are dealt.
SUBJECT_TILE = 4096


def containing(titles: DataFrame, keys: DataFrame) -> DataFrame:
    """``t, k``: all pairs of a title ``t`` and a keyword ``k`` of three letters and more that it contains
    anywhere. They meet by the keyword's trigram that is rarest in the titles; a title with the keyword has it.
    Spark takes trigrams for as large as what they are taken from; merged, they are not broadcast by that size."""
    grams = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - 2), lambda i: F.substring(F.col(c), i, F.lit(3))))
    of_titles = titles.filter(F.length("t") >= 3).select("t", F.explode(grams("t")).alias("gram"))
    of_keys = keys.filter(F.length("k") >= 3).select("k", F.explode(grams("k")).alias("gram"))
    spread = of_titles.groupBy("gram").agg(F.count("*").alias("n"))
    rarest = of_keys.hint("merge").join(spread, "gram").groupBy("k").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    return of_titles.hint("merge").join(rarest, "gram").filter(F.contains("t", "k")).select("t", "k")


def link_by_subjects(records: DataFrame, patents: DataFrame, id_col: str = "record_id", most: int = 3, threshold: float | None = None) -> DataFrame:
    """[SIM-14, SIM-18] The subject phase: a patent's title holds one of the first ``most`` keywords."""
    pubs = _publication_side(records.withColumn("title", F.lower("title")), id_col, "title")
    first = F.array_distinct(F.slice("keywords", 1, most))
    keys = pubs.select("pub_id", "year", "keywords", F.array("title").alias("titles"), first.alias("first"), F.posexplode(first).alias("at", "key"))
    titles = cut(patent_table(patents).select("lens_id", F.lower("title").alias("t"), patent_year("publication_date").alias("year")), "subject-titles")
    words = pubs.select(F.explode("keywords").alias("k")).distinct()
    held = cut(containing(titles.select("t").distinct(), words).groupBy("t").agg(F.collect_set("k").alias("ks")), "subject-keywords")
    given = F.col("t") != MISSING.lower()
    # Files of few bytes hold many: keywords are repeated in them.
    right = held.hint("merge").join(titles, "t").select(
        "lens_id", "year", F.when(given, F.col("t")).alias("title"), F.array("t").alias("titles"),
        F.when(given, F.col("ks")).otherwise(F.array().cast("array<string>")).alias("held"), F.explode("ks").alias("key"),
    )
    # A pair of several keys is scored with the first of them.
    left = keys.withColumn("earlier", F.slice("first", 1, F.col("at"))).drop("first", "at")
    return meet(left, right, "subject_match", threshold, SUBJECT_TILE)


def link_all(records: DataFrame, patents: DataFrame, phases: dict[str, bool], id_col: str = "record_id", thresholds: dict[str, float] | None = None) -> DataFrame:
    """[PIPE-15] The enabled phases; of a publication, patent and kind the best confidence."""
    by = {"authors": (link_by_authors, "author_match"), "institutions": (link_by_institutions, "institution_match"), "subjects": (link_by_subjects, "subject_match")}
    parts = [f(records, patents, id_col, threshold=(thresholds or {}).get(kind)) for name, (f, kind) in by.items() if phases.get(name)]
    if not parts:
        raise ValueError("no phase is enabled")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("pub_id", "lens_id", "link_type").agg(F.max("confidence").alias("confidence"))


def detail(patents: DataFrame, lens_id: str) -> DataFrame:
    """[SRC-15] The flat record of one patent, its first delivery."""
    return first_by(flat(patents).filter(F.col("lens_id") == lens_id), ["lens_id"], ["rec_id"])


def field_presence(patents: DataFrame) -> DataFrame:
    """[SRC-25] ``field, present, total`` of the flat fields: how many records have each."""
    rows = flat(patents)
    counts = rows.agg(F.count("*").alias("total"), *[F.count(known(c)).alias(c) for c in PAYLOAD_PATHS])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("present")) for c in PAYLOAD_PATHS]))
    return counts.select("total", each.alias("e")).select("e.field", "e.present", "total")
