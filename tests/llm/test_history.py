"""Duplicates against history: rules on pairs, the table against brute force, batches."""

import random

import pytest

from citeforge.llm import history as h
from citeforge.llm import records as r

SCHEMA = "record_id long, eid string, doi string, title string, authors string, pub_year string, source_title string, volume string, page_start string, art_no string"
TITLE = "Determination of zolgamide in river water by a portable sensor patch and reader"


def row(i, title=TITLE, doi=None, eid=None, page="12", volume="3", authors="Doe, J.; Roe, K.", year="2020", art=None):
    return (i, eid, doi, title, authors, year, "Journal of X", volume, page, art)


@pytest.mark.parametrize(
    ("other", "verdict"),
    [
        (TITLE.upper() + ".", "equal"),
        (TITLE.replace("portable", "potrable"), "near"),
        (TITLE.replace(" portable", ""), "near"),
        (TITLE.replace(" and ", " & "), "equal"),
        (TITLE[:50], "cut"),
        (TITLE[:50] + "…", "cut"),
        (TITLE.replace("river water", "sea salt"), "other"),
        ("Erratum: " + TITLE, "other"),
        (TITLE + ". Part II", "part"),
        ("<i>" + TITLE + "</i>", "equal"),
    ],
)
def test_same_title(other, verdict):
    assert r.same_title(r.plain(TITLE), r.plain(other)) == verdict


def test_parts_and_greek():
    assert r.same_title(r.plain("A b c d. Part I"), r.plain("A b c d. Part 1")) == "equal"
    assert r.same_title(r.plain("A b c d. Part I"), r.plain("A b c d. Part II")) == "other"
    assert r.plain("β-Foo Î²-Größe") == "beta foo beta grosse"
    assert r.identifier("https://doi.example/10.1/ABC123.") == "10.1/abc123" and r.identifier("10.0000/pending") is None and r.identifier("N/A") is None


def test_found(spark):
    rows = [
        row(5, TITLE.upper(), doi="10.1/x123"), row(1, doi="10.1/X123"), row(9, TITLE[:48] + "...", page="", art="000012"),
        row(2, TITLE.replace("zolgamide", "brunolone"), page="77"), row(3, "Erratum: " + TITLE, page="90"), row(4, TITLE + ". Part II", page="40"),
        row(6, None, eid="2-s2.0-1234567", page=None, volume=None), row(7, "", eid="2-s2.0-1234567", page=None), row(8, None, None, None, None, None, None, None),
        row(10, "Editorial", page="1"), row(11, "Editorial", page="1"), row(12, "Editorial", page="1", volume="4", authors="Poe, A."), row(13, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as anchor", "'x' as pivots")
    assert sorted(map(tuple, h.found(df).collect())) == [(1, 5), (1, 9), (6, 7), (10, 11)]
    assert h.found(df.limit(0)).count() == 0


def test_pivot_bound_never_exceeds_the_distance():
    from citeforge.llm.names import distance

    rng = random.Random(4)
    for _ in range(400):
        a = "".join(rng.choice("abe 19") for _ in range(rng.randint(0, 30)))
        b = "".join(rng.choice("abe 19") for _ in range(rng.randint(0, 30))) if rng.random() < 0.5 else a[: rng.randint(0, len(a))] + "z"
        # Swaps count as one edit here and two in the metric, so the bound is taken on twice the edits.
        assert max(abs(x - y) for x, y in zip(h.pivots(a), h.pivots(b), strict=True)) <= 2 * max(distance(a, b, 60), 0)


def test_against_brute_force(spark):
    rng = random.Random(7)
    words = ["alpha", "beta", "sensor", "chip", "water", "urine", "ink", "layer", "optical", "rapid", "stable", "thermal"]
    rows = []
    for i in range(150):
        base = f"{rng.choice(words)} {rng.choice(words)} of compound{i // 3}x in {rng.choice(words) if i % 3 == 0 else 'the'} {words[i // 3 % 12]} for a study"
        if i % 3:
            base = rows[i - i % 3][3]
            base = base.upper() if i % 3 == 1 else base.replace("study", "stduy")
        rows.append(row(i, base, page=str(i // 3), volume=str(i // 3 % 7)))
    df = spark.createDataFrame(rows, SCHEMA)
    read = {x["record_id"]: x.asDict() for x in h.read_records(df).collect()}
    brute = {}
    for b in read:
        for a in range(b):
            if h.same_publication(read[a], read[b]):
                brute[b] = brute.get(a, a)
                break
    assert {x["record_id"]: x["first_record_id"] for x in h.found(df).collect()} == brute


def test_stand_ins_identify_nothing(spark):
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [row(i, " ".join("".join(rng.choice(letters) for _ in range(8)) for _ in range(8)), doi="10.5/same123", page=str(i), volume="1") for i in range(60)]
    assert h.found(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_batches(spark, tmp_path):
    past = h.History(spark, f"file://{tmp_path}/h")
    first = past.accept(spark.createDataFrame([row(1), row(2, TITLE.replace("zolgamide", "brunolone"), page="77")], SCHEMA))
    assert {x["record_id"]: x["first_record_id"] for x in first.collect()} == {1: None, 2: None}
    second = past.accept(spark.createDataFrame([row(3, TITLE.upper()), row(4, "A wholly new title of other words", page="5")], SCHEMA))
    assert {x["record_id"]: x["first_record_id"] for x in second.collect()} == {3: 1, 4: None}
    third = past.accept(spark.createDataFrame([row(5, TITLE.replace("patch", "pacth"))], SCHEMA))
    assert {x["record_id"]: x["first_record_id"] for x in third.collect()} == {5: 1}


def accepted(spark, folder, *batches):
    past = h.History(spark, f"file://{folder}")
    out = {}
    for b in batches:
        out |= {x["record_id"]: x["first_record_id"] for x in past.accept(spark.createDataFrame(b, SCHEMA)).collect()}
    return out, {x["node"]: x["root"] for x in past.members().collect()}


def test_a_retyped_copy_in_a_later_batch(spark, tmp_path):
    # The words of the first record are each the only one of their kind when it is stored.
    a, b = row(1, page=None, volume=None, authors=None), row(2, TITLE.replace("portable", "potrable"), page="9", authors="Poe, A.")
    assert accepted(spark, tmp_path / "h", [a], [b]) == ({1: None, 2: 1}, {2: 1})


def test_ids_need_not_rise(spark, tmp_path):
    out, members = accepted(spark, tmp_path / "h", [row(50, doi="10.1/x123"), row(60, "Another work of wholly different words", page="8")], [row(7, doi="10.1/x123"), row(6)])
    assert out == {50: None, 60: None, 7: 50, 6: 50} and members == {7: 50, 6: 50}


def test_a_record_that_joins_two_publications(spark, tmp_path):
    cut_title = TITLE[:60]
    a, b = row(1, None, eid="2-s2.0-1234567", page=None, authors=None), row(2, cut_title, page="44", volume="9", doi="10.1/y456")
    c = row(3, cut_title, eid="2-s2.0-1234567", doi="10.1/y456", page=None, volume=None)
    out, members = accepted(spark, tmp_path / "h", [a, b], [c], [row(4, cut_title, doi="10.1/y456", page="44")])
    assert out == {1: None, 2: None, 3: 1, 4: 1} and members == {2: 1, 3: 1, 4: 1}


def test_stand_ins_across_batches(spark, tmp_path):
    rng = random.Random(3)
    words = lambda: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(8))
    past = [row(i, words(), doi="10.5/same123", page=str(i), volume="1") for i in range(20)]
    later = [row(100, words(), doi="10.5/same123", page="200"), row(101, None, doi="10.5/same123", page=None, authors=None)]
    assert accepted(spark, tmp_path / "h", past, later)[1] == {}


def test_an_interrupted_batch_leaves_nothing(spark, tmp_path, monkeypatch):
    past = h.History(spark, f"file://{tmp_path}/h")
    past.accept(spark.createDataFrame([row(1)], SCHEMA))
    with monkeypatch.context() as m:
        m.setattr(h, "components", lambda links: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            past.accept(spark.createDataFrame([row(2, TITLE.upper())], SCHEMA))
    assert past.batches() == [1]
    got = past.accept(spark.createDataFrame([row(2, TITLE.upper())], SCHEMA)).collect()
    assert [tuple(x) for x in got] == [(2, 1)]


def test_empty_batches_and_a_single_one(spark, tmp_path):
    rows = [row(1), row(2, TITLE.upper())]
    past = h.History(spark, f"file://{tmp_path}/h")
    df = spark.createDataFrame(rows, SCHEMA)
    assert past.accept(df.limit(0)).count() == 0 and past.members().count() == 0
    assert {tuple(r) for r in past.accept(df).collect()} == {(1, None), (2, 1)}
    assert past.accept(df.limit(0)).count() == 0 and [tuple(r) for r in past.members().collect()] == [(2, 1)]
    assert [tuple(r) for r in h.found(df.selectExpr("*", "7 as batch_no")).collect()] == [(1, 2)]
    assert [tuple(r) for r in h.found(df.selectExpr("*", "if(record_id = 1, null, 3) as batch_no")).collect()] == [(1, 2)]


def test_batch_by_batch_as_the_whole(spark, small, tmp_path):
    """Recall of the incremental path: what three batches find is what the whole table gives."""
    records = spark.read.parquet(f"{small}/scopus_records.parquet")
    whole = {x["record_id"]: x["first_record_id"] for x in h.found(records.drop("batch_no")).collect()}
    past = h.History(spark, f"file://{tmp_path}/h")
    for low, high in ((0, 4), (4, 8), (8, 99)):
        past.accept(records.filter(f"batch_no > {low} and batch_no <= {high}"))
    assert {x["node"]: x["root"] for x in past.members().collect()} == whole
    assert {x["record_id"]: x["first_record_id"] for x in h.found(records).collect()} == whole


def test_long_titles_are_aligned():
    words = [f"word{i}x" for i in range(300)]
    other = ["opening", *words[:299], "closing", words[299]]
    assert r.same_title(" ".join(words), " ".join(other)) == "near"
    assert r.same_title(" ".join(words), " ".join(f"thing{i}" for i in range(300))) == "other"


def test_a_long_title_cut_very_short(spark):
    long = TITLE + " with results for several further samples, a comparison of storage lives, and notes on the use by untrained people at home"
    rows = [row(1, long, doi="10.1/a111"), row(2, long[:60] + "...", doi="10.1/b222")]
    assert [tuple(x) for x in h.found(spark.createDataFrame(rows, SCHEMA)).collect()] == [(1, 2)]


def test_hot_anchors_stay_complete(spark, monkeypatch):
    rows = [row(1), row(2, TITLE.replace("portable", "potrable"), volume=None), row(3, TITLE.upper() + ".", year=None, volume="Vol. 3")]
    rows += [row(i, f"Some other title of thing{i}x in river water by a portable sensor patch and reader", volume=str(i)) for i in range(4, 16)]
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(h, "HOT", 1)
    assert sorted(map(tuple, h.found(df).collect())) == [(1, 2), (1, 3)]
