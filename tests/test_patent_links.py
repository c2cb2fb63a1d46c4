"""Subject links: keywords anywhere in patent titles."""

import difflib
import re
import unicodedata

import pytest

from citeforge.operators import patents

TITLES = ["reader on thermal chip: urine analysis", "microchips for water", "lab-on-chip, portable", "gel ink", "chip", "ch", "", "süßwasser-chip", "thermal chips and chip"]
KEYS = ["chip", "thermal chip", "gel", "süß", "ink", "none of these", "chip:", "lab-on-chip"]


def test_containing_against_brute_force(spark):
    got = patents.containing(spark.createDataFrame([(t,) for t in TITLES], "t string"), spark.createDataFrame([(k,) for k in KEYS], "k string"))
    assert sorted(map(tuple, got.collect())) == sorted((t, k) for t in TITLES for k in KEYS if k in t)


def test_a_keyword_before_a_colon_or_within_a_word_links(spark, monkeypatch):
    pubs = spark.createDataFrame([(1, "Chip; Water", "A chip", "2020", "Doe, J.", "")], "record_id long, author_keywords string, title string, pub_year string, authors string, affiliations string")
    titles = spark.createDataFrame([(str(i), t, "2021-01-01") for i, t in enumerate(TITLES)], "lens_id string, title string, publication_date string")
    none = {k: spark.createDataFrame([], "lens_id string, name string, cleaned string") for k in ("inventor", "applicant")}
    monkeypatch.setattr(patents, "patent_table", lambda p: p)
    monkeypatch.setattr(patents, "_parties", lambda p: none)
    got = {r["lens_id"] for r in patents.link_by_subjects(pubs, titles, threshold=0.0).collect()}
    assert got == {str(i) for i, t in enumerate(TITLES) if "chip" in t or "water" in t}


def _ascii(x):
    return unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode()


def _person(x):
    return " ".join(w for w in (re.sub(r"[^\w-]", "", w) for w in _ascii(x).lower().split()) if w not in ("dr", "prof", "phd"))


def _place(x):
    return re.sub(r"^(the|an|a)\s+", "", _ascii(x), flags=re.I).split(",")[0].strip().lower()


def _best(xs, ys):
    return max((difflib.SequenceMatcher(None, x, y).ratio() for x in xs for y in ys), default=0.0)


PUBS = [
    (1, "Doe, Jane; Roé, K.", "Université of Lundby, Dept X, France; Quatutrent Printing, Sweden", "chip; ink layer; water", "2019", "A chip of ink"),
    (2, "Wang, L.; Wang, Q.; Poe, A.", "Institute of Y; Ab; The Kalmar Sensors, Kalmar", "reader", "2021", "Some reader"),
    (3, "", "", "", None, None),
    (4, "Jane Doe", "Quatutrent Ptinting", "gel; wax ink; paper; chip", "2010", "Gel"),
]
PATENTS = [
    ("a", "Ink layer on a chip", "2020-01-02", ["Jane Doe", "Karl Roe"], ["Universite of Lundby"]),
    ("b", "Readers of sensors", "2018-05-06", ["Lei Wang"], ["Kalmar Sensor Ltd", "Quatutrent Ptinting"]),
    ("c", "N/A", "N/A", [], []),
    ("d", "Wax ink for paper with a gel and a chip", "2012", ["Qi Wang", "Anna Poe"], ["Quatutrent Printing"]),
]


@pytest.fixture
def linked(spark, monkeypatch):
    pubs = spark.createDataFrame(PUBS, "record_id long, authors string, affiliations string, author_keywords string, pub_year string, title string")
    titles = spark.createDataFrame([p[:3] for p in PATENTS], "lens_id string, title string, publication_date string")
    parties = {
        k: spark.createDataFrame([(p[0], n, f(n)) for p in PATENTS for n in p[i]], "lens_id string, name string, cleaned string")
        for k, i, f in (("inventor", 3, _person), ("applicant", 4, _place))
    }
    monkeypatch.setattr(patents, "patent_table", lambda p: p)
    monkeypatch.setattr(patents, "_parties", lambda p: parties)
    return pubs, titles


def _scores(kind):
    """Every pair's confidence by the plain rules, whatever the candidates."""
    out = {}
    for rid, authors, places, keys, year, title in PUBS:
        people = [_person(a.strip()) for a in authors.split(";") if len(a.strip()) > 2]
        insts = [p for p in (_place(a.strip()) for a in places.split(";")) if len(p) > 5]
        first = [_place(a.strip()) for a in places.split(";") if len(a.strip()) > 5][:3]
        words = [k.strip() for k in keys.split(";") if len(k.strip()) > 2]
        for lens, ptitle, date, inventors, applicants in PATENTS:
            inv, app = [_person(i) for i in inventors], [_place(a) for a in applicants]
            near = 0.0
            if year and date != "N/A":
                lag = int(date[:4]) - int(year)
                near = (1.0 if lag <= 1 else 0.8 if lag <= 3 else 0.6 if lag <= 5 else 0.3 if lag <= 10 else 0.1) if lag >= 0 else (0.7 if lag >= -1 else 0.4 if lag >= -3 else 0.2 if lag >= -5 else 0.1)
            subject = sum(w.lower() in ptitle.lower() for w in words) / len(words) if words and ptitle != "N/A" else 0.0
            if kind == "author_match":
                score = 0.4 * _best(people[:5], inv) + 0.3 * _best(insts, app) + 0.2 * near + 0.1 * subject
            elif kind == "institution_match":
                hits = sum(any(difflib.SequenceMatcher(None, x, y).ratio() > 0.8 for y in set(inv)) for x in set(people))
                overlap = hits / max(len(set(people)), len(set(inv))) if people and inv else 0.0
                score = 0.5 * _best(first, app) + 0.25 * overlap + 0.15 * near + 0.1 * subject
            else:
                ratio = _best([title.lower()], [ptitle.lower()]) if title and ptitle != "N/A" else 0.0
                score = 0.6 * subject + 0.25 * ratio + 0.15 * near
            out[rid, lens] = score
    return out


@pytest.mark.parametrize(
    ("phase", "kind", "candidates"),
    [
        (patents.link_by_authors, "author_match", {(1, "a"), (4, "a"), (2, "b"), (2, "d")}),
        (patents.link_by_institutions, "institution_match", {(1, "a"), (1, "b"), (1, "d"), (4, "b"), (4, "d"), (2, "b")}),
        (patents.link_by_subjects, "subject_match", {(1, "a"), (1, "d"), (2, "b"), (4, "d")}),
    ],
)
def test_scores_against_the_plain_rules(linked, phase, kind, candidates):
    got = {(r["pub_id"], r["lens_id"]): r["confidence"] for r in phase(*linked, threshold=0.0).collect()}
    assert set(got) == candidates
    plain = _scores(kind)
    assert got == {k: pytest.approx(plain[k]) for k in candidates}


def test_similar_names_against_brute_force(spark):
    left = ["quatutrent printing", "kalmar sensors", "university of lundby", "acme", "abc", "institute of photonics", "lundby hospital"]
    right = ["quatutrent ptinting", "kalmar sensor ltd", "universiyt of lundby", "acne", "abd", "institute of photonics", "lundby", "other works"]
    got = {tuple(r) for r in patents.similar_names(spark.createDataFrame([(x,) for x in left], "name string"), spark.createDataFrame([(x,) for x in right], "name string")).collect()}
    brute = {(x, y) for x in left for y in right if difflib.SequenceMatcher(None, x, y).ratio() >= 0.8}
    # Short names with an error in their only word are keyed by that word without a letter.
    assert got <= brute and brute - got == set()


def _broadcast_rows(plan):
    """Rows of every broadcast table of a plan that has run."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return _broadcast_rows(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return _broadcast_rows(plan.plan())
    own = [plan.metrics().apply("numOutputRows").value()] if plan.nodeName() == "BroadcastExchange" else []
    children = plan.children()
    return own + [n for i in range(children.size()) for n in _broadcast_rows(children.apply(i))]


def test_trigrams_are_not_broadcast_by_the_size_of_their_texts(spark, tmp_path):
    words = [f"{a}{b}{c}" for a in ("thermal", "porous", "woven") for b in ("chip", "reader", "gel") for c in ("plate", "valve", "strip")]
    made = [(f"{x} with {y} and a {z} for water {x[:4]}",) for x in words for y in words[:9] for z in words[9:18]]
    keys = [(w,) for w in words] + [(f"none {n}",) for n in range(3000)]
    for name, rows in (("t", made), ("k", keys)):
        spark.createDataFrame(rows, f"{name} string").write.parquet(str(tmp_path / name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        got = patents.containing(spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "k")))
        pairs = {tuple(r) for r in got.collect()}
        sent = _broadcast_rows(got._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert pairs == {(t, k) for (t,) in made for (k,) in keys if k in t}
    assert max(sent, default=0) <= max(len(made), len(keys))
