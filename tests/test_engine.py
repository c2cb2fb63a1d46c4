"""Exports on disk to tables and back: sources, store, cache, client, stream, API, configuration."""

import csv
import json
import urllib.error

import pytest

from citeforge import config, reports
from citeforge.api import Engine
from citeforge.sources import exports
from citeforge.sources.http import Client, ServiceError, fetch_table, patent_query
from citeforge.sources.rejects import EXPORT_FIELDS
from citeforge.sources.store import ResponseCache, Store, new_files
from citeforge.streaming import ingest


def write(path, rows, header=EXPORT_FIELDS):
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f, quoting=csv.QUOTE_ALL)
        out.writerow(header)
        for r in rows:
            out.writerow([r.get(h, "") for h in header])


def row(i, **kw):
    return {"Authors": "Doe, J.; Roe, K.", "Author(s) ID": "1; 2", "Title": f"Title {i}", "Year": "2020", "DOI": f"10.1/{i}", "Affiliations": "University of Y, Germany",
            "Abstract": 'Two\nlines, "quoted"', "Author Keywords": "Gel", "References": "Smith A, Any book", "Source title": "J"} | kw


@pytest.fixture
def folder(tmp_path):
    raw = tmp_path / "raw_scopus"
    raw.mkdir()
    write(raw / "b.csv", [row(1), row(2, Title="")], header=list(reversed(EXPORT_FIELDS)))
    write(raw / "a.csv", [row(1, Title="First seen"), row(3)])
    write(raw / "a_exclusions.csv", [row(9)])
    (raw / "~tmp.csv").write_text("x")
    return tmp_path


def test_discovery_and_scan(spark, folder):
    paths = exports.discover(str(folder))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["a.csv", "b.csv"]
    df = exports.scan_all(spark, paths)
    assert {r["src_file"]: r["records"] for r in exports.record_counts(df).collect()} == {"a.csv": 2, "b.csv": 2}
    assert [r["title"] for r in df.orderBy("file_ord", "src_ord").collect()] == ["First seen", "Title 3", "Title 1", ""]
    assert df.first()["abstract"] == 'Two\nlines, "quoted"'


def test_query_and_expectations(spark, tmp_path):
    (tmp_path / "q.json").write_text("Scopus_query=TITLE(x)\ntotal_results= 12\n")
    assert exports.query_file(str(tmp_path / "q.json")) == {"query": "TITLE(x)", "total_results": 12}
    (tmp_path / "e.csv").write_text("Year, Documents\n2020, 5\nx, 1\n2020, 6\n")
    assert [tuple(r) for r in exports.expected_by_year(spark, str(tmp_path / "e.csv")).collect()] in ([(2020, 6)], [])


def test_build_validate_add(spark, folder, tmp_path):
    engine = Engine(spark, f"file://{tmp_path}/db")
    counts = engine.build(exports.discover(str(folder)))
    assert counts["source_records"] == 4 and counts["papers"] == 2 and counts["exclusions"] == 1 and counts["paper_authors"] == 4
    assert all(r["passed"] for r in engine.validate())
    assert engine.sql("select title from papers order by paper_id").first()[0] == "First seen"
    late = folder / "raw_scopus" / "c.csv"
    write(late, [row(4), row(3)])
    assert engine.add(exports.discover(str(folder)))["papers"] == 3
    assert engine.add(exports.discover(str(folder)))["papers"] == 3
    engine.report(str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text())["exclusions"][0]["category"] == "MISSING_TITLE"
    with pytest.raises(ValueError, match="json or txt"):
        engine.report(str(tmp_path / "r.xml"), "xml")


def content(engine):
    """The tables by natural keys, so that stores with other ids can be compared."""
    q = lambda sql: sorted(map(str, engine.sql(sql).collect()))
    of = "join papers p using (paper_id)"
    return {
        "papers": q("select title, year, doi, abstract from papers"),
        "authors": q(f"select p.title, scopus_id, position, first_author, last_author from paper_authors {of} join authors_master using (author_id)"),
        "places": q(f"select p.title, canonical_name, author_count from paper_institutions {of} join institutions_master using (institution_id)"),
        "words": q(f"select p.title, normalized_text, keyword_type, position from paper_keywords {of} join keywords_master using (keyword_id)"),
        "citations": q(f"select p.title, position, reference_text from paper_citations {of}"),
        "exclusions": q("select title, reason from exclusions"),
        "masters": q("select scopus_id, full_name from authors_master"),
    }


def test_added_exports_are_appended(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write(raw / "a.csv", [row(1), row(2, **{"Author(s) ID": "7; 2", "Author Keywords": "Ink; Gel"})])
    write(raw / "b.csv", [row(1, Title="Again"), row(3, Title="")])
    late = [row(3), row(4, Authors="Poe, A.; Roe, K.", **{"Author(s) ID": "9; 2", "Affiliations": "Institute of Z, France"}), row(2, Title="Again"), row(5, Abstract="")]
    engine = Engine(spark, f"file://{tmp_path}/db")
    engine.build(exports.discover(str(raw)))
    before = {r["scopus_id"]: r["author_id"] for r in engine.sql("select * from authors_master").collect()}
    places = engine.sql("select distinct input_file_name() f from papers").collect()
    write(raw / "c.csv", late)
    engine.add(exports.discover(str(raw)))
    after = {r["scopus_id"]: r["author_id"] for r in engine.sql("select * from authors_master").collect()}
    assert before.items() <= after.items() and sorted(after.values()) == list(range(1, len(after) + 1))
    assert {r["f"] for r in places} <= {r["f"] for r in engine.sql("select distinct input_file_name() f from papers").collect()}
    assert all(r["passed"] for r in engine.validate())
    whole = Engine(spark, f"file://{tmp_path}/whole")
    whole.build(exports.discover(str(raw)))
    appended = content(engine)
    assert appended == content(whole)


def test_broken_rows_and_files(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write(raw / "a.csv", [row(1), row(2)])
    with open(raw / "a.csv", "a", encoding="utf-8") as f:
        f.write('"too","few"\n')
    engine = Engine(spark, f"file://{tmp_path}/db")
    counts = engine.build([str(raw / "a.csv"), str(raw / "missing.csv")])
    assert counts["papers"] == 2 and list(engine.failed) == [str(raw / "missing.csv")]
    assert [(r["src_file"], r["reason"], r["raw_line"]) for r in engine.store.read("rejected_records").collect()] == [("a.csv", "columns", '"too","few"')]
    with pytest.raises(ValueError, match="no files"):
        engine.build([str(raw / "missing.csv")])


def test_changed_tables_fail_their_checks(spark, folder, tmp_path):
    engine = Engine(spark, f"file://{tmp_path}/db")
    engine.build(exports.discover(str(folder)))
    papers = engine.store.read("papers")
    engine.store.replace("papers", papers.selectExpr("* except (title)", "'Größe lost' as title").select(papers.columns))
    failed = {r["name"] for r in engine.validate() if not r["passed"]}
    assert failed == {"paper_content"}
    engine.store.replace("paper_authors", engine.store.read("paper_authors").filter("position > 1"))
    assert {"author_entries", "first_author"} <= {r["name"] for r in engine.validate() if not r["passed"]}


def test_enrichment(spark, small, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write(raw / "a.csv", [row(1, Title="A chip of ink layers for water", Affiliations="University of Lundby, France"), row(2, DOI="", Title="Gel on paper", Volume="3", **{"Page start": "12"})])
    (tmp_path / "c.json").write_text(json.dumps({"lens": {"phases": {"subjects": True}, "thresholds": {"subject_match": 0.3}}}))
    engine = Engine(spark, f"file://{tmp_path}/db", str(tmp_path / "c.json"))
    engine.build(exports.discover(str(raw)))
    deliveries = spark.read.parquet(f"{small}/citing_patents_analysis.parquet").limit(3).selectExpr("* except (title, applicants)", "'Gel for ink' as title", "array(named_struct('name', 'University of Lundby', 'residence', 'FR', 'type', 'x')) as applicants")
    stats = engine.link_patents(deliveries)
    assert stats["processed"] == 2 and stats["links"] == engine.store.read("publication_patent_links").count() > 0
    assert engine.link_patents(deliveries, resume=True)["links"] == stats["links"]
    assert engine.institution_patents("lundby").count() > 0 and engine.author_patents("nobody").count() == 0
    assert engine.innovation()["metrics"].first()["publications"] == 2
    work = "work_id long, pmid string, title array<string>, author array<struct<family:string,given:string>>, published struct<date_parts:array<array<int>>>, volume string, page string, container_title array<string>, doi string"
    works = spark.createDataFrame([(1, None, ["Gel on paper"], [("Doe", "J")], ([[2020]],), "3", "12-19", ["J"], "10.9/found")], work)
    assert engine.recover_dois(works)["recovered"] == 1
    assert [r["doi"] for r in engine.sql("select doi from papers order by paper_id").collect()] == ["10.1/1", "10.9/found"]
    assert set(engine.reports(str(tmp_path / "reports"))) >= {"exclusions", "missing_doi", "enrichment", "validation"}
    assert (tmp_path / "reports" / "missing_doi.txt").exists() and json.loads((tmp_path / "reports" / "enrichment.json").read_text())["metrics"]


def test_searches_in_works(spark):
    from citeforge.operators import matching

    work = "work_id long, pmid string, title array<string>, author array<struct<family:string,given:string>>, published struct<date_parts:array<array<int>>>, volume string, page string, container_title array<string>"
    works = spark.createDataFrame(
        [(i, None, [t], [(a, "J")], ([[y]],), "3", p, ["J of X"]) for i, t, a, y, p in [(1, "Gel on paper", "Doe", 2019, "1-5"), (2, "Gel on a chip", "Roe", 2020, "12-19"), (3, "Ink", "Doe", 2021, "7")]], work
    )
    found = lambda df: [r["work_id"] for r in df.collect()]
    assert found(matching.search_journal(works, "j of x ")) == [1] and found(matching.search_journal(works, "J of X", (2020, 2022), "7")) == [3]
    assert found(matching.search_title(works, "gel on paper")) == [1, 2] and found(matching.search_title(works, "gel on paper", "roe")) == [2]
    records = spark.createDataFrame([(1, "", "Gel on paper", "Doe, J.", "2019", "J of X", "3", "1", "5")], "record_id long, doi string, title string, authors string, pub_year string, source_title string, volume string, page_start string, page_end string")
    both = matching.with_and_without(records, works.selectExpr("*", "concat('10.1/', work_id) as doi"), lambda df: df)
    assert {r["setting"]: r["with_doi"] for r in both.collect()} == {"without_recovery": 0, "with_recovery": 1}


def test_env_file(tmp_path):
    (tmp_path / ".env").write_text("# note\nexport CROSSREF_EMAIL='a@b.org'\nX=1=2\nnothing\n")
    assert config.env_file(str(tmp_path / ".env")) == {"CROSSREF_EMAIL": "a@b.org", "X": "1=2"}


def test_shared_folder_is_needed_off_local_mode():
    from types import SimpleNamespace

    from citeforge import session

    none = SimpleNamespace(isDefined=lambda: False)
    context = SimpleNamespace(master="spark://x", getConf=lambda: {}, _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none)))
    with pytest.raises(RuntimeError, match="checkpoint"):
        session.shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context))


def test_store_and_cache(spark, tmp_path):
    store = Store.new_run(spark, f"file://{tmp_path}")
    assert store.counts(["papers"]) == {"papers": 0}
    cache = ResponseCache(store)
    keys = spark.createDataFrame([("a",), ("b",)], "key string")
    assert cache.missing(keys).count() == 2
    cache.put(spark.createDataFrame([("a", "1")], "key string, response_data string"))
    cache.put(spark.createDataFrame([("a", "2")], "key string, response_data string"))
    assert [r["key"] for r in cache.missing(keys).collect()] == ["b"] and cache.live().first()["response_data"] == "2"
    assert cache.cleanup() == 1 and cache.stats() == {"total": 1, "valid": 1, "expired": 0}
    listed = spark.createDataFrame([("x.csv",), ("y.csv",)], "src_file string")
    assert [r[0] for r in new_files(listed, listed.limit(1)).collect()] == ["y.csv"]


def http_error(code):
    return urllib.error.HTTPError("u", code, "m", {}, None)


def test_client_retries():
    waits, answers = [], [http_error(429), http_error(503), b'{"ok": 1}']

    def send(request, timeout):
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    client = Client("http://s", email="a@b.org", rate=1000, send=send, sleep=waits.append)
    assert client.fetch("/works", {"rows": 5}) == {"ok": 1}
    assert client.stats()["success_rate"] == pytest.approx(1 / 3) and client.counters["limited"] == 1
    answers[:] = [http_error(404)]
    assert client.fetch("/x") is None
    answers[:] = [http_error(401)]
    with pytest.raises(ServiceError):
        client.fetch("/x")
    with pytest.raises(ValueError, match="e-mail"):
        Client("http://s", email="nobody")
    assert patent_query("inventor", "A B") == 'inventor.name:"A B"'


def test_fetch_table(spark):
    keys = spark.createDataFrame([("k1",), ("k2",), ("k1",)], "key string")
    got = fetch_table(keys, lambda: Client("http://s", rate=1e6), lambda c, k: {"k": k} if k == "k1" else None)
    assert [tuple(r) for r in got.collect()] == [("k1", '{"k": "k1"}')]


def test_stream_takes_each_file_and_doi_once(spark, tmp_path):
    src, out, check = (f"file://{tmp_path}/{n}" for n in ("src", "out", "check"))
    make = lambda rows: spark.createDataFrame(rows, "record_id long, doi string").coalesce(1).write.mode("append").parquet(src)
    make([(1, "a"), (2, "a"), (3, "")])
    schema = spark.read.parquet(src).schema
    assert ingest.ingest(spark, src, out, check, schema).count() == 2
    make([(4, "a"), (5, "b"), (6, "")])
    rows = sorted(r["record_id"] for r in ingest.ingest(spark, src, out, check, schema).collect())
    assert rows == [1, 3, 5, 6]
    assert ingest.ingest(spark, src, out, check, schema).count() == 4


def test_config(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"lens": {"rate": 5}, "crossref": {"email": "f@x.org"}}))
    conf = config.load(str(tmp_path / "c.json"), {"CROSSREF_EMAIL": "e@x.org", "LENS_API_TOKEN": "0123456789abcd"})
    assert conf["crossref"]["email"] == "e@x.org" and conf["lens"]["rate"] == 5 and conf["lens"]["timeout"] == 30
    assert "...abcd" in config.summary(conf) and "0123" not in config.summary(conf)
    for bad in ({"crossref": {"email": "x"}}, {"lens": {"rate": 0}}, {"crossref": {"thresholds": {"pmid": 2}}}):
        with pytest.raises(ValueError, match=r"\w"):
            config.validate(config.merged(config.DEFAULTS, bad))


def test_reports(spark, tmp_path):
    assert "no rows" in reports.text_table("t", []) and "<td>&lt;</td>" in reports.html_page("t", {"s": [{"a": "<"}]})
    assert reports.short_list(["a", "b", "c", "d"]) == "a, b, c ... and 1 more"
