"""Nested records to flat tables: shapes, places, intervals."""

import json

from citeforge.operators.nested import child_rows, interval_join, label_nodes, node_tables

SCHEMA = """rec_id long, payload string, priority_claims array<struct<jurisdiction:string,number:string,date:string>>,
 inventors array<struct<name:string,residence:string>>, applicants array<struct<name:string,residence:string,type:string>>,
 citations array<struct<sequence:string,nplcit:struct<text:string,external_ids:array<string>>,patcit:struct<jurisdiction:string,doc_number:string>>>,
 extra string, nodes string"""


def payload(**biblio):
    return json.dumps({"biblio": biblio})


def frame(spark):
    cite = ("1", ("a text", ["x", None, "y"]), None)
    rows = [
        (1, None, [("US", "1", None), None, ("N/A", None, None)], [], None, [cite, None, ("3", None, ("DE", "5"))], "e", "n"),
        (2, payload(priority_claims={"earliest_claim": {"date": "1"}, "claims": [{"jurisdiction": "US"}, None]}), None, None, None, None, None, None),
        (3, payload(priority_claims={"earliest_claim": {"date": "1"}}, parties={"inventors": {"name": {"name": "A"}}}), None, None, None, None, None, None),
        (4, payload(priority_claims=[{"jurisdiction": None, "date": "N/A"}], parties={"applicants": json.dumps([None, {"name": "B"}])}), None, None, None, None, None, None),
        (5, payload(references_cited={"citations": json.dumps({"nplcit": {"external_ids": ["p", "q"]}})}), None, None, None, None, None, None),
        (6, "not json", None, None, None, None, None, None),
        (7, None, None, None, None, None, None, None),
        (8, payload(parties={"inventors": "", "applicants": []}, references_cited={}), None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_children(spark):
    got = sorted(map(tuple, child_rows(frame(spark)).collect()))
    assert got == sorted(
        [
            (1, "priority_claim", 0, 1), (1, "priority_claim", 0, 3), (1, "citation", 0, 1), (1, "citation", 0, 3),
            (1, "external_id", 1, 1), (1, "external_id", 1, 3), (2, "priority_claim", 0, 1), (3, "inventor", 0, 1),
            (4, "priority_claim", 0, 1), (4, "applicant", 0, 2), (5, "citation", 0, 1), (5, "external_id", 1, 1), (5, "external_id", 1, 2),
        ]
    )


def test_intervals_nest_and_link(spark):
    for row in label_nodes(frame(spark)).collect():
        n = len(row["nodes"])
        assert sorted(x["pre"] for x in row["nodes"]) == list(range(1, n + 1))
        assert sorted(x["post"] for x in row["nodes"]) == list(range(n))
        for a in row["nodes"]:
            inside = [b for b in row["nodes"] if a["pre"] < b["pre"] and b["post"] < a["post"]]
            assert len(inside) == a["size"] - 1
    tables = node_tables(frame(spark), written=True)
    linked = interval_join(tables["citation"], tables["external_id"]).select("rec_id", "parent_no", "child_no", "value")
    assert sorted(map(tuple, linked.collect())) == [(1, 1, 1, "x"), (1, 1, 3, "y"), (5, 1, 1, "p"), (5, 1, 2, "q")]
    assert [tuple(r) for r in tables["applicant"].select("rec_id", "child_no", "name").collect()] == [(4, 2, "B")]


def test_empty_table(spark):
    assert child_rows(frame(spark).limit(0)).count() == 0


def test_a_very_long_list(spark):
    rows = [(1, payload(parties={"inventors": [{"name": f"n{i}"} for i in range(5000)]}), None, None, None, None, None, None)]
    assert child_rows(spark.createDataFrame(rows, SCHEMA)).count() == 5000
