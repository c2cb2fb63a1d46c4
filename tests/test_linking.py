"""Scores by bounds against every ratio computed."""

import random

import numpy as np
import pyarrow as pa
import pytest

from citeforge.functions.similarity import PATENT_THRESHOLDS
from citeforge.operators import linking

KINDS = ["author_match", "institution_match", "subject_match"]


def _rows(n, seed):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(k))
    families, places, topics = [word(7) for _ in range(12)], [f"university of {word(8)}" for _ in range(15)] + ["x" * 70 + word(9)], [word(6) for _ in range(20)]
    person = lambda: f"{rng.choice(families)} {word(rng.choice([1, 5]))}"
    some = lambda f, most: [f() for _ in range(rng.randint(0, most))]
    typo = lambda v: v[:3] + rng.choice("abc") + v[4:]
    place = lambda: typo(rng.choice(places)) if rng.random() < 0.3 else rng.choice(places)
    title = lambda: " ".join(rng.choice(topics) for _ in range(8))
    year = lambda: rng.choice([None, *range(2005, 2020)])
    left = [{"cell": rng.choice("ab"), "pub_id": i, "year": year(), "people": some(person, 5), "institutions": some(place, 3), "contexts": some(place, 3),
             "keywords": [rng.choice(topics) for _ in range(rng.randint(1, 4))], "titles": some(title, 1)} for i in range(n)]
    right = [{"cell": rng.choice("ab"), "lens_id": str(i), "year": year(), "inventors": some(person, 4), "applicants": some(place, 2), "title": rng.choice([None, title()])} for i in range(n)]
    for r in right:
        r["titles"] = [r["title"] or "n/a"]
    return left, right


def _expected(kind, a, b):
    best = lambda xs, ys: max((linking.ratio(x, y) for x in xs for y in ys), default=0.0)
    lag = None if a["year"] is None or b["year"] is None else b["year"] - a["year"]
    after, before = [(1, 1.0), (3, 0.8), (5, 0.6), (10, 0.3)], [(1, 0.7), (3, 0.4), (5, 0.2)]
    year = 0.0 if lag is None else next((v for most, v in (after if lag >= 0 else before) if abs(lag) <= most), 0.1)
    subject = sum(k in (b["title"] or "") for k in a["keywords"]) / len(a["keywords"])
    if kind == "author_match":
        return best(a["people"], b["inventors"]) * 0.4 + best(a["institutions"], b["applicants"]) * 0.3 + year * 0.2 + subject * 0.1
    if kind == "institution_match":
        hits = sum(any(linking.ratio(x, y) > 0.8 for y in b["inventors"]) for x in a["people"])
        author = hits / max(len(a["people"]), len(b["inventors"]), 1)
        return best(a["contexts"], b["applicants"]) * 0.5 + author * 0.25 + year * 0.15 + subject * 0.1
    return subject * 0.6 + best(a["titles"], b["titles"]) * 0.25 + year * 0.15


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("scale", [1.0, 0.0])
def test_links_are_those_of_all_ratios(kind, scale, monkeypatch):
    left, right = _rows(90, 5)
    least = PATENT_THRESHOLDS[kind] * scale
    want = {(a["pub_id"], b["lens_id"]): s for a in left for b in right if a["cell"] == b["cell"] and (s := _expected(kind, a, b)) >= least}
    asked = []
    monkeypatch.setattr(linking, "ratio", lambda x, y, of=linking.ratio: asked.append((x, y)) or of(x, y))
    got = linking.scored(pa.Table.from_pylist(left), pa.Table.from_pylist(right), kind, least).to_pylist()
    assert {(r["pub_id"], r["lens_id"]): r["confidence"] for r in got} == pytest.approx(want) and len(got) == len(want) > 0
    # The work that took the time: ratios are computed where they can decide only.
    pairs = sum(a["cell"] == b["cell"] for a in left for b in right)
    assert not scale or len(asked) < pairs


@pytest.mark.parametrize("letters", ["ab", "abcdé ", "aßx漢😀", "abcdefghijklmnopqrstuvwxyz "])
@pytest.mark.parametrize("most", [20, 90, 210, 300])
def test_ratios_of_many_names_are_those_of_one(letters, most):
    rng = random.Random(most)
    of = lambda n: ["", "a", *("".join(rng.choice(letters) for _ in range(rng.randint(most // 2, most))) for _ in range(n))]
    left, right = of(12), of(12)
    right += [x[:5] + y[3:] for x, y in zip(left, right, strict=True)]
    a, b = linking.Names(left), linking.Names(right)
    p, q = (np.array(x) for x in zip(*((x, y) for x in range(len(left)) for y in range(len(right))), strict=True))
    want = np.array([linking.ratio(left[x], right[y]) for x, y in zip(p, q, strict=True)])
    assert linking.ratios(a, b, p, q).tolist() == want.tolist()
    for bound in (linking.shared_neighbours(a, b, p, q), linking.common_subsequence(a, b, p, q), linking.shared_letters(a, b, np.arange(len(left)), np.arange(len(right)))[p, q]):
        assert (bound >= want - linking.EPS).all()


def test_subject_pairs_of_several_keys_are_scored_once(monkeypatch):
    left, right = _rows(90, 7)
    for r in left + right:
        r["cell"] = "a"
    for r in right:
        r["held"] = [] if r["title"] is None else sorted({k for x in left for k in x["keywords"] if k in r["title"]})
    dealt = [x | {"cell": k, "earlier": ks[:n]} for x in left for ks in [list(dict.fromkeys(x["keywords"]))] for n, k in enumerate(ks)]
    meet = [x | {"cell": k} for x in right for k in x["held"]]
    least = PATENT_THRESHOLDS["subject_match"]
    want = {(a["pub_id"], b["lens_id"]): s for a in left for b in right if set(a["keywords"]) & set(b["held"]) and (s := _expected("subject_match", a, b)) >= least}
    slow = []
    monkeypatch.setattr(linking, "FEW", 0)
    monkeypatch.setattr(linking, "ratio", lambda x, y, of=linking.ratio: slow.append((x, y)) or of(x, y))
    got = linking.scored(pa.Table.from_pylist(dealt), pa.Table.from_pylist(meet), "subject_match", least).to_pylist()
    assert {(r["pub_id"], r["lens_id"]): r["confidence"] for r in got} == pytest.approx(want)
    # What took the time: a pair for each of its keys, and ratios one by one.
    assert len(got) == len(want) > 0 and not slow
