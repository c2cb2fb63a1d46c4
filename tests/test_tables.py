"""Ids, upserts, quality, entities, coverage and checks on small frames."""

import pytest
from pyspark.sql import functions as F

from citeforge.columns import bind, binding
from citeforge.operators import coverage, details, entities, ids, matching, quality

RECORDS = "record_id long, authors string, author_ids string, title string, pub_year string, doi string, affiliations string, abstract string, author_keywords string, index_keywords string, ref_list string, source_title string, volume string, issue string, page_start string, page_end string, page_count string, cited_by string"


def record(i, **kw):
    base = dict(authors="Doe, J.; Roe, K.", author_ids="1; 2", title="A title of some length", pub_year="2020", doi=f"10.1/{i}", affiliations="Univ X, University of Y, Germany; Acme, France",
                abstract="text", author_keywords="Gel; Ink", index_keywords="gel", ref_list="", source_title="J", volume="1", issue="", page_start="1", page_end="2", page_count="2", cited_by="")
    base |= kw
    return (i, *[base[c.split()[0]] for c in RECORDS.split(", ")[1:]])


@pytest.fixture(scope="module")
def recs(spark):
    rows = [
        record(5), record(1, doi=" 10.1/5 "), record(2, doi="", authors=" "), record(3, doi=None, title="\xa0"), record(4, doi="10.1/A"), record(6, doi="10.1/a", author_ids="1; 1; 3", authors="Doe, J."),
    ]
    return spark.createDataFrame(rows, RECORDS)


def test_dense_ids(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    rows = ids.dense_ids(df.repartition(7), ["k"], "n").collect()
    assert sorted((r["n"], r["k"]) for r in rows) == [(i + 1, i) for i in range(1000)]
    assert ids.dense_ids(df.limit(0), ["k"], "n").count() == 0


def test_first_last_and_upserts(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 3, None)], "k long, o long, v string")
    assert sorted(map(tuple, ids.first_by(df, ["k"], ["o"]).collect())) == [(1, 1, "a"), (2, 3, None)]
    assert sorted(map(tuple, ids.last_by(df, ["k"], ["o"]).collect())) == [(1, 2, "b"), (2, 3, None)]
    old = spark.createDataFrame([(1, 0, "z"), (3, 0, "y")], "k long, o long, v string")
    assert sorted(r["v"] or "" for r in ids.insert_or_ignore(old, df, ["k"], ["o"]).collect()) == ["", "y", "z"]
    assert sorted(r["v"] or "" for r in ids.insert_or_replace(old, df, ["k"], ["o"]).collect()) == ["", "b", "y"]
    new = spark.createDataFrame([(3, "w")], "k long, v string")
    assert {r["k"]: r["v"] for r in ids.update_by_key(old, new, "k", ["v"]).collect()} == {1: "z", 3: "w"}
    assert ids.ensure_columns(old, {"c": "double", "k": "long"}).columns == ["k", "o", "v", "c"]


def test_quality(recs):
    flags = {r["record_id"]: (r["reason"], r["category"]) for r in quality.flagged(recs).collect()}
    assert flags[2] == ("MISSING_AUTHORS: No authors provided", "MISSING_AUTHORS")
    assert flags[3][1] == "MISSING_TITLE" and flags[1] == (None, None)
    strict = {r["record_id"]: r["category"] for r in quality.excluded(recs, strict=True).collect()}
    assert strict == {2: "MISSING_AUTHORS", 3: "MISSING_TITLE"}
    assert quality.flagged(recs, enabled=False).filter("reason is not null").count() == 0
    assert {r["category"]: r["rate"] for r in quality.breakdown(recs).collect()} == {"MISSING_AUTHORS": pytest.approx(100 / 6), "MISSING_TITLE": pytest.approx(100 / 6)}
    assert quality.clean_key("Author(s) ID") == "authors_id"


def test_dedup_keeps_first_and_blanks(recs):
    assert sorted(r["record_id"] for r in quality.dedup_by_doi(recs, ["record_id"]).collect()) == [1, 2, 3, 4, 6]
    assert [tuple(r) for r in quality.duplicate_log(recs, ["record_id"], "record_id").collect()] == [("10.1/5", 5, 1, 2020)]


def test_entities(recs):
    kept = quality.kept(recs)
    people = {r["scopus_id"]: (r["author_id"], r["abbreviated_name"]) for r in entities.authors(kept, "record_id").collect()}
    assert people == {"1": (1, "Doe, J."), "2": (2, "Roe, K.")}
    pa = {(r["record_id"], r["scopus_id"]): (r["position"], r["first_author"], r["last_author"]) for r in entities.paper_authors(kept, "record_id").collect()}
    assert pa[6, "1"] == (1, True, False) and pa[6, "3"] == (3, False, True) and (6, "2") not in pa
    words = [(r["keyword_id"], r["normalized_text"], r["keyword_category"]) for r in entities.keywords(kept, "record_id").orderBy("keyword_id").collect()]
    assert words == [(1, "gel", "author"), (2, "ink", "author")]
    places = {r["canonical_name"]: r["country"] for r in entities.institutions(kept, "record_id").collect()}
    assert places == {"University of Y": "Germany", "Acme": "France"}
    assert all(r["primary_affiliation"] for r in entities.paper_institutions(kept, "record_id").collect())


def test_details(spark):
    df = spark.createDataFrame(
        [(1, "Big Agency, 12345; NSF, 9999", "water 7732-18-5; ; salt", "Alpha (B)", "Doe, J.; X; d@x.org", "Gold", ""), (2, "", None, "", " ", "", None)],
        "record_id long, funding string, chemicals string, trade_names string, correspondence string, access_type string, publisher string",
    )
    assert [(r["agency_name"], r["grant_numbers"]) for r in details.funding(df, "record_id").collect()] == [("Big Agency", ["12345"])]
    assert [(r["position"], r["chemical_name"]) for r in details.chemicals(df, "record_id").collect()] == [(1, "water"), (2, "salt")]
    assert details.trade_names(df, "record_id").first()["manufacturer"] == "B"
    assert details.correspondences(df, "record_id").first()["email"] == "d@x.org"
    assert [tuple(r) for r in details.access(df, "record_id").collect()] == [(1, "Gold", "", True)]


def test_coverage_and_checks(spark, recs):
    expected = spark.createDataFrame([(2019, 10), (2020, 6)], "year int, expected long")
    rows = {r["year"]: (r["found"], r["coverage"], r["status"]) for r in coverage.yearly_coverage(expected, coverage.yearly_counts(recs)).collect()}
    assert rows == {2019: (0, 0.0, "needs_attention"), 2020: (6, 100.0, "excellent"), None: (6, 37.5, "needs_attention")}
    counts = spark.createDataFrame([(2018, 3), (2020, 5)], "year int, records long")
    assert [tuple(r) for r in coverage.timeline(counts).orderBy("year").collect()] == [(2018, 3), (2019, 0), (2020, 5)]
    assert coverage.timeline(counts.limit(0)).count() == 0
    twice = spark.createDataFrame([(1,), (1,), (None,)], "k long")
    checks = coverage.run_all([coverage.unique_key("k", twice, ["k"]), coverage.no_orphans("o", twice.dropna(), twice, "k"), coverage.same_count("c", twice, recs, 3), coverage.few_blank("b", recs, "title")])
    assert {r["name"]: r["passed"] for r in checks.collect()} == {"k": False, "o": True, "c": True, "b": False}


def test_header_binding(spark):
    got = binding(["Source title", "Title", "Author full names", "Authors", "Author(s) ID", "Chemicals/CAS", "year"])
    assert got["title"] == "Title" and got["source_title"] == "Source title" and got["pub_year"] == "year" and got["doi"] is None
    df = bind(spark.createDataFrame([("x", None)], "`Source title` string, Year string"))
    assert df.select("source_title", "pub_year", "title").first() == ("x", "", "")


def test_recovery_cascade(spark):
    recs = spark.createDataFrame(
        [record(1, doi=""), record(2, doi="", title="Wholly different words here"), record(3)], RECORDS
    ).withColumn("pubmed_id", F.when(F.col("record_id") == 2, "77"))
    works = spark.createDataFrame(
        [(1, "77", ["Wholly different words here"], [("Doe", "Jane")], (([[2020]],)), "1", "1-2", ["J"], "10.9/p"), (2, None, ["a title of some LENGTH"], [("Doe", "J"), ("Roe", "K")], (([[2020, 5]],)), "1", "1-2", ["J"], "10.9/t")],
        "work_id long, pmid string, title array<string>, author array<struct<family:string,given:string>>, published struct<date_parts:array<array<int>>>, volume string, page string, container_title array<string>, doi string",
    )
    got = {r["record_id"]: (r["work_id"], r["method"]) for r in matching.cascade(recs, works).collect()}
    assert got == {2: (1, "pmid"), 1: (2, "journal")}
    filled = {r["record_id"]: r["doi"] for r in matching.recover_dois(recs, works).collect()}
    assert filled == {1: "10.9/t", 2: "10.9/p", 3: "10.1/3"}
    assert matching.recovery_stats(recs, matching.cascade(recs, works)).first()["passed"]
