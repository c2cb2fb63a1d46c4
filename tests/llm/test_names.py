"""Variant spellings: the index against brute force, and small tables of people and organisations."""

import itertools
import random

import pytest

from citeforge.llm import names as n


def test_symmetric_deletes_find_all_neighbours():
    rng = random.Random(2)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(4, 9))) for _ in range(250)}
    index = {}
    for w in words:
        for d in n.deletes(w):
            index.setdefault(d, set()).add(w)
    for a in words:
        near = {b for b in words if b != a and n.distance(a, b, 2) <= min(n.reach(len(a)), n.reach(len(b)))}
        assert near <= set().union(*(index[d] for d in n.deletes(a)))


def test_distance_is_bounded_and_counts_swaps():
    assert n.distance("abcd", "acbd", 2) == 1 and n.distance("abc", "xyz", 1) == 2 and n.distance("", "ab", 2) == 2


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Prof. Jane Q. Smit, Jr.", (["jane", "smit"], "q")),
        (" Smit,Jane", (["smit", "jane"], "")),
        ("Smit JQ", (["smit"], "jq")),
        ("SMIT Jane", (["smit", "jane"], "")),
        ("Ken. Müller", (["ken.", "muller"], "")),
        ("Mueller, K.", (["muller"], "k")),
    ],
)
def test_parse_person(text, expected):
    assert n.parse_person(text) == expected


def test_parse_org():
    assert n.parse_org("Dept. of Chem., Univ. of Lund, 12345 Lund, Sverige") == ["=uni", "lund"]
    assert n.parse_org("TU Lund") == ["=tec", "=uni", "lund"]
    assert n.parse_org("Acme Print. Tech. Co., Ltd.") == ["acme", "print.", "tech."]


def test_assignment_against_all_orders():
    rng = random.Random(9)
    words = ["chem.", "chemical", "chemistry", "phys.", "physics", "physical", "appl.", "applied", "print.", "printing", "lund", "lunds"]
    for _ in range(400):
        a, b = (rng.sample(words, k) for k in [rng.randint(1, 5)] * 2)
        brute = any(all(n.matches(x, y) for x, y in zip(a, p, strict=True)) for p in itertools.permutations(b))
        assert n.aligned(a, b) == brute
    long = [f"{c}word{c}" for c in "abcdefghijkl"]
    assert n.aligned(long, long[::-1]) and not n.aligned(long, [*long[1:], "other"])


def test_an_error_that_recurs(spark):
    """A misspelling counts against the right spelling, not against a fixed number."""
    titles = ["", "Dr. ", "Prof. ", "Ms. ", "Mrs. ", "Ing. ", "Mr. ", "Dipl. "]
    right = [("person", f"{t}Katrin Wolverhampten{e}", "DE") for t in titles for e in ("", ", PhD", ", Jr.")]
    wrong = [("person", f"{t}Katrin Wolverhamtpen", "DE") for t in titles[:5]]
    rows = [(i, *r) for i, r in enumerate(right + wrong)]
    df = spark.createDataFrame(rows, "name_id long, name_kind string, name_text string, country string")
    assert n.found(df).count() == len(rows) * (len(rows) - 1) // 2


def test_blocks_of_an_entity_all_meet(spark, monkeypatch):
    rows = [(i, "org", f"University of Lundby, Dept. {i}", None) for i in range(30)]
    df = spark.createDataFrame(rows, "name_id long, name_kind string, name_text string, country string")
    monkeypatch.setattr(n, "BLOCK", 4)
    got = [tuple(r) for r in n.found(df).collect()]
    assert len(got) == len(set(got)) == 30 * 29 // 2


def test_entities(spark):
    groups = [
        [("person", "Kenneth Doering", "GB"), ("person", "DOERING, Kenneth", None), ("person", "K. Döring", "United Kingdom"), ("person", "Ken Doering", "GB"),
         ("person", "Prof. Kenneth Doering", None), ("person", "Kenneht Doering", "GB"), ("person", "Doering K", "GB")],
        [("person", "Karin Doering", "DE"), ("person", "K. Doering", "Germany"), ("person", "Karin Doering, PhD", None)],
        [("person", "Elena Lind", "SE"), ("person", "Lind Elena", "SE")],
        [("person", "Helena Lind", "SE"), ("person", "Helena Lind, Jr.", None)],
        [("org", "University of Lundby", "SE"), ("org", "Lundby University, Dept Physics, Lundby, Sweden", None), ("org", "UNIV LUNDBY", None), ("org", "Universiyt of Lundby", None)],
        [("org", "University Hospital Lundby", "SE"), ("org", "Lundby Univ Hosp, Lundby, Sverige", None)],
        [("org", "Lundby Institute of Chemical Physics", None), ("org", "Inst. Chem. Phys. Lundby", None)],
        [("org", "Lundby Institute of Photonics", None), ("org", "LUNDBY INSTITUTE OF PHOTONICS", None)],
        [("org", "Acme Instruments Ltd.", None), ("org", "Acme Instr. Ltd", None)],
        [("org", "Acme Sensors Inc.", None)],
        [("person", "  ", None)], [("person", None, None)], [("org", "y" * 50_000, None)],
    ]
    rows, truth = [], set()
    for g in groups:
        ids = []
        for kind, text, land in g:
            ids.append(len(rows))
            rows.append((len(rows), kind, text, land, None))
        truth |= {(a, b) for a in ids for b in ids if a < b}
    # Common names make typing errors recognisable.
    df = spark.createDataFrame(rows, "name_id long, name_kind string, name_text string, country string, entity string")
    assert {tuple(r) for r in n.found(df).collect()} == truth
    assert n.found(df.limit(0)).count() == 0
