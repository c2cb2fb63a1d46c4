"""Records and works: exactness of the index, calibration, small tables."""

import random

import numpy as np

from citeforge.llm import linkage as li

REC = "record_id long, title string, authors string, pub_year string, source_title string, volume string, page_start string, art_no string"
WORK = "work_id long, pmid string, title array<string>, author array<struct<family:string,given:string>>, published struct<date_parts:array<array<int>>>, volume string, page string, container_title array<string>"
TITLE = "Determination of zolgamide in river water by a portable sensor patch and reader"


def test_chunks_meet_within_the_radius():
    rng = random.Random(5)
    for _ in range(300):
        x = bytearray(li.bits("".join(rng.choice("abcdef ") for _ in range(90))))
        y = bytearray(x)
        for k in rng.sample(range(li.BITS), li.CHUNKS - 1):
            y[k // 8] ^= 128 >> k % 8
        step = len(x) // li.CHUNKS
        assert any(x[i * step : (i + 1) * step] == y[i * step : (i + 1) * step] for i in range(li.CHUNKS))


def test_weights_bound_the_distance(spark):
    from pyspark.sql import functions as F

    rng, rows = random.Random(6), []
    make = lambda t: li._encoded(0, t, None, None, None, "", "", "")
    for _ in range(300):
        a = "".join(rng.choice("abcdef ") for _ in range(80))
        b = a[:40] + rng.choice("abc") + a[41:] if rng.random() < 0.5 else "".join(rng.choice("abcdef ") for _ in range(400))
        x, y = make(a), make(b)
        hamming = (int.from_bytes(x[8]) ^ int.from_bytes(y[8])).bit_count()
        rows.append((x[10], y[10], hamming))
    df = spark.createDataFrame(rows, "a long, b long, h int")
    assert df.filter(~li.within_radius(F.col("a"), F.col("b")) & (F.col("h") < li.CHUNKS)).count() == 0
    assert df.filter(~li.within_radius(F.col("a"), F.col("b"))).count() > 0


def test_confidences_are_calibrated():
    rng = np.random.default_rng(1)
    counts, true = {}, {}
    for _ in range(20_000):
        match = rng.random() < 0.3
        levels = [int(rng.choice([2, 3] if rng.random() < 0.95 else [1])) if match else int(rng.choice([1, 1, 1, 2]))]
        levels += [0 if rng.random() < 0.1 else 2 if rng.random() < (0.9 if match else 0.15) else 1 for _ in range(5)]
        code = 0
        for v, k in zip(levels, li._LEVELS, strict=True):
            code = code * k + v
        counts[code] = counts.get(code, 0) + 1
        true[code] = true.get(code, 0) + match
    post = li.fit(counts)
    mean = sum(post[c] * n for c, n in counts.items()) / sum(counts.values())
    assert abs(mean - 0.3) < 0.03
    for lo, hi in ((0, 0.2), (0.2, 0.8), (0.8, 1.01)):
        inside = [c for c in counts if lo <= post[c] < hi]
        n = sum(counts[c] for c in inside)
        if n > 300:
            assert abs(sum(true[c] for c in inside) / n - sum(post[c] * counts[c] for c in inside) / n) < 0.08


def test_tables(spark):
    filler = [(100 + i, f"Study number {i} of thing{i} in medium{i % 5} by method{i % 7}", f"Auth{i}, A.", "2019", f"Journal of Field {i % 9}", str(i), str(i * 3), None) for i in range(60)]
    recs = spark.createDataFrame(
        [(1, TITLE, "Doe, J.; Roe, K.", "2020", "Journal of Applied Things", "3", "12", None), (2, TITLE.upper(), "Doe, J.", "2021", "J. Appl. Things", "", "", "000012"),
         (3, "Editorial", "", "", "", "", "", None), (4, None, None, None, None, None, None, None), (5, TITLE + ". Part II", "Doe, J.; Roe, K.", "2020", "Journal of Applied Things", "3", "99", None), *filler], REC)
    works = spark.createDataFrame(
        [(1, None, [TITLE.replace("portable", "portbale") + "."], [("Doe", "Jane"), ("Roe", None)], (([[2020, 1]],)), "Vol. 3", "12-19", ["J. Appl. Things"]),
         (2, None, [], None, None, None, None, []), (3, None, ["Editorial."], None, None, "1", None, None), (4, None, [None], [None], ([],), "", "", [None]),
         (5, None, [TITLE.replace("zolgamide", "brunolone")], [("Doe", "J")], (([[2020]],)), "3", "50", ["J. Appl. Things"]),
         *[(100 + i, None, [f[1].upper()], [(f"Auth{i}", "A")], ([[2019]],), f[5], f[6], [f[4]]) for i, f in enumerate(filler)]], WORK)
    got = {tuple(r) for r in li.found(recs, works).collect()}
    assert {p for p in got if p[0] < 100} == {(1, 1), (2, 1)}
    assert {p for p in got if p[0] >= 100} == {(100 + i, 100 + i) for i in range(60)}
    assert li.found(recs.limit(0), works).count() == 0 and li.found(recs, works.limit(0)).count() == 0


def test_hot_keys_lose_no_pair(spark, monkeypatch):
    """Candidates are the same however small the blocks are, also of rows with few segments."""
    recs = spark.createDataFrame(
        [(i, TITLE, None if i % 2 else "Doe, J.", "2020" if i % 3 else None, "Journal of Applied Things", None if i % 5 else "3", None, None) for i in range(40)], REC)
    works = spark.createDataFrame([(i, None, [TITLE], None, (([[2020]],)) if i % 2 else None, "3" if i % 3 else None, None, ["J. Appl. Things"]) for i in range(30)], WORK)
    left, right = li.encode_records(recs).cache(), li.encode_works(works).cache()
    whole = {tuple(r) for r in li.candidates(left, right).collect()}
    assert len(whole) == 40 * 30
    monkeypatch.setattr(li, "BLOCK", 7)
    rows = li.candidates(left, right).collect()
    assert {tuple(r) for r in rows} == whole and len(rows) == len(whole)


def test_one_other_number_does_not_separate():
    x = {"page": 12, "volume": 3, "year": 2020, "families": "doe poe roe", "journal": "jx"}
    other = x | {"volume": 30, "families": "doe roe"}
    for y in (other, other | {"year": 2021}, other | {"families": ""}, other | {"page": None}):
        assert li.settled(x, y)["volume"] is None
    assert li.settled(x, x | {"year": 2010})["year"] is None
    for y in (other | {"page": 13}, other | {"families": "wang"}, other | {"year": 2015}, other | {"page": None, "year": 2021}, other | {"families": "", "journal": "jy"}, x):
        assert li.settled(x, y) == y


def test_confidences_on_planted_pairs(spark):
    """Reliability: of pairs by tenths of confidence, the share of true ones is near the mean confidence."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("bdfglmnrst") + rng.choice("aeiou") for _ in range(3))
    recs, works = [], []
    for i in range(400):
        title = " ".join(word() for _ in range(9))
        author, page, volume, year = word(), rng.randint(1, 900), rng.randint(1, 40), rng.randint(2010, 2022)
        recs.append((i, title, f"{author.title()}, A.; Roe, B.", str(year), f"Journal of {word()}", str(volume), str(page), None))
        if i % 2:
            kept = lambda v, other: None if rng.random() < 0.15 else v if rng.random() < 0.9 else other
            typed = title.replace(title.split()[2], title.split()[2][::-1]) if rng.random() < 0.3 else title
            works.append((i, None, [typed], [(author.title(), "A"), ("Roe", "B")], ([[year]],), kept(str(volume), "77"), kept(str(page), "901"), [recs[-1][4]]))
        else:
            works.append((i, None, [" ".join(word() for _ in range(9))], [(author.title(), "A")], ([[year]],), str(volume), "950", [recs[-1][4]]))
    rows = li.scored(spark.createDataFrame(recs, REC), spark.createDataFrame(works, WORK)).collect()
    pairs = [(r["confidence"], r["record_id"] == r["work_id"] and r["work_id"] % 2 == 1) for r in rows]
    assert sum(t for _, t in pairs) >= 0.97 * 200
    for low, high in ((0.0, 0.1), (0.9, 1.01)):
        inside = [(c, t) for c, t in pairs if low <= c < high]
        assert len(inside) > 100
        assert abs(sum(t for _, t in inside) / len(inside) - sum(c for c, _ in inside) / len(inside)) < 0.05
