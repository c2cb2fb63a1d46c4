"""String rules, row by row, with hand-derived expectations."""

import pytest
from pyspark.sql import functions as F

from citeforge.functions import similarity as sim
from citeforge.functions import text as t


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "c string").select(expr.alias("r")).first()[0]


@pytest.mark.parametrize(
    ("value", "rule", "expected"),
    [
        (" a ; b;;\xa0; c", lambda: t.split_list("c"), ["a", "b", "c"]),
        (None, lambda: t.split_list("c"), []),
        ("Smith, J.-P.", lambda: t.canonical_author("c"), "jp smith"),
        ("Plato", lambda: t.canonical_author("c"), "plato"),
        ("3D-Printing", lambda: t.normalize_keyword("c"), "3dprinting"),
        ("3d  printing ", lambda: t.normalize_keyword("c"), "3d printing"),
        ("Dept X, University of Y, United States", lambda: t.institution_name("c"), "University of Y"),
        ("Acme Corp, Berlin, Germany", lambda: t.institution_name("c"), "Acme Corp"),
        ("ABC, D", lambda: t.institution_name("c"), "ABC, D"),
        ("Dept X, University of Y, United States", lambda: t.country("c"), ""),
        ("X, Y, Österreich", lambda: t.country("c"), "Österreich"),
        ("Berlin", lambda: t.country("c"), ""),
        ("NSF, 1234567", lambda: t.agency("c"), None),
        ("National Science Fund, 1234567", lambda: t.agency("c"), "National Science Fund"),
        ("Grant #A-12 of EU 99", lambda: t.grants("c"), ["Grant #A-12", "EU 99"]),
        ("water 7732-18-5", lambda: t.chemical("c"), ("water", "7732-18-5")),
        ("Alpha (Beta Inc)", lambda: t.trade_name("c"), ("Alpha", "Beta Inc")),
        ("Doe, J.; Univ of Z; email: j.doe@z.example.org", lambda: t.correspondence("c"), ("Doe", "j.doe@z.example.org", "J.; Univ of Z; email:")),
        ("All Open Access, Gold", lambda: t.open_access("c"), True),
        ("2024", lambda: t.safe_int("c"), 2024),
        (" 2024", lambda: t.safe_int("c"), None),
        ("²", lambda: t.safe_int("c"), None),
        ("", lambda: t.safe_int("c", 0), 0),
        ("filed 2019-03-02", lambda: t.year_of("c"), 2019),
        ("12019", lambda: t.year_of("c"), None),
        ("x" * 60, lambda: t.truncated("c", 50), "x" * 50 + "..."),
        ("a@b", lambda: t.valid_email("c"), False),
        ("a@b.org", lambda: t.valid_email("c"), True),
        ("Prof. José Müller-Lüdenscheid", lambda: t.clean_person("c"), "Jose Muller-ludenscheid"),
        ("Dr.", lambda: t.clean_person("c"), ""),
        ("The University (Main) of X, Dept", lambda: t.clean_institution("c"), "University of X"),
        (None, lambda: t.clean_institution("c"), ""),
    ],
)
def test_rules(spark, value, rule, expected):
    got = one(spark, value, rule())
    assert (tuple(got) if isinstance(expected, tuple) else got) == expected


def test_name_variants_are_ordered_and_bounded(spark):
    got = one(spark, "Ann Bee Cee", t.name_variants("c"))
    assert got == ["Ann Bee Cee", "Ann Cee", "Cee Ann", "Cee, Ann", "A Cee"]
    assert one(spark, "Plato", t.name_variants("c")) == ["Plato"]
    assert one(spark, "", t.name_variants("c")) == []


def test_page_range_and_full_names(spark):
    df = spark.createDataFrame([("12", "", "Doe, Jane (99); X")], "a string, b string, f string")
    row = df.select(
        t.page_range("a", "b").alias("p"), t.full_author("f", F.lit(1), F.lit("Doe, J.")).alias("x"), t.full_author("f", F.lit(2), F.lit("X, Y.")).alias("y"),
        t.full_author("f", F.lit(9), F.lit("Z")).alias("z"),
    ).first()
    assert tuple(row) == ("12", "Doe, Jane", "X, Y.", "Z")


def test_confidence_scores(spark):
    df = spark.createDataFrame(
        [("A b c", "Doe, J.", "2020", "7", "1-9", "a b c", "Doe, J.", "2020", "7", "1-9"), ("A b", "", "2019", "", "", "x y", "Roe, K.", "2020", "3", "")],
        "t string, a string, y string, v string, p string, wt string, wa string, wy string, wv string, wp string",
    )
    r = {k: F.col(c) for k, c in {"title": "t", "authors": "a", "year": "y", "volume": "v", "pages": "p"}.items()}
    w = {k: F.col("w" + c) for k, c in {"title": "t", "authors": "a", "year": "y", "volume": "v", "pages": "p"}.items()}
    for method, best, worst in (("pmid", 1.0, 0.45), ("journal", 1.0, 0.35), ("title", 0.9, 0.4), ("other", 0.8, 0.0)):
        got = [x[0] for x in df.select(sim.match_confidence(r, w, method)["confidence"]).collect()]
        assert got[0] == pytest.approx(best)
        assert got[1] == pytest.approx(worst, abs=1e-9)


def test_year_proximity_and_overlap(spark):
    df = spark.createDataFrame([(2000, 2001), (2000, 2009), (2000, 1998), (2000, None)], "a int, b int")
    assert [x[0] for x in df.select(sim.year_proximity(F.col("a"), F.col("b"))).collect()] == [1.0, 0.3, 0.4, 0.0]
    kw = spark.createDataFrame([(["Gel", "ink"], "a gel head")], "k array<string>, t string")
    assert kw.select(sim.subject_overlap(F.col("k"), F.col("t"))).first()[0] == 0.5
    names = spark.createDataFrame([(["Jane Doe", "Kim Lee"], ["Jane Do"]), ([], ["x"]), (None, None)], "a array<string>, b array<string>")
    assert [x[0] for x in names.select(sim.name_overlap("a", "b")).collect()] == [0.5, 0.0, 0.0]
