"""Keyword and link pages among prose, lists and tables."""

import random

from citeforge.llm import spam

WORDS = "the of and in sample sensor water layer after method result was found with test for strip reader signal".split()
_RNG = random.Random(1)
# The words of the domain: enough that neighbours vary, as in real texts.
WORDS += ["".join(_RNG.choice("bdfglmnrstv") + _RNG.choice("aeiou") for _ in range(3)) for _ in range(300)]
GOODS = ["lab tape", "patent filing", "wax ink", "glove box"]


def prose(rng, n=8):
    return " ".join(" ".join(rng.choice(WORDS) for _ in range(rng.randint(7, 14))).capitalize() + "." for _ in range(n))


def pages(rng):
    mods = ["cheap", "best", "buy", "online", "bulk", "sale"]
    yield ", ".join(f"{rng.choice(mods)} {rng.choice(GOODS)}" for _ in range(60))
    yield "\n".join(f"* [{rng.choice(GOODS)}](http://a{i}.example/{i})" for i in range(30))
    yield " ".join(f"#{rng.choice(GOODS).replace(' ', '')}" for _ in range(40))
    yield prose(rng, 1) + " " + " | ".join(f"{rng.choice(mods)} {GOODS[0]}" for _ in range(50))
    yield "tags: " + "; ".join(f"{rng.choice(mods)} {rng.choice(WORDS)}" if i % 3 else rng.choice(mods) for i in range(60))


def clean(rng):
    yield prose(rng)
    yield prose(rng) + " (see http://x.example/y)."
    yield "Contents\n" + "\n".join(f"{i}. {rng.choice(WORDS)} in {rng.choice(WORDS)} {'.' * 9} {i * 7}" for i in range(1, 14))
    yield "\n".join(f"[{i}] Doe{i}, J., On {rng.choice(WORDS)} and {rng.choice(WORDS)}, Journal of Strip Tests, {i}, 3, pp. 4-9, (20{i:02d})" for i in range(10, 22))
    yield "sample\tvalue\n" + "\n".join(f"S{i}\t{i * 3.7:.3f}" for i in range(30)) + "\n" + prose(rng, 2)
    yield "A title of a study on the sensor layer in water"


def test_found(spark):
    rng = random.Random(8)
    rows, truth = [], set()
    for k in range(40):
        for t in clean(rng):
            rows.append((len(rows), t))
        if k % 2 == 0:
            for t in pages(rng):
                truth.add(len(rows))
                rows.append((len(rows), t))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, " \n "), (len(rows) + 3, prose(rng, 3000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1L as h", "'x' as kind")
    got = {r["doc_id"] for r in spam.found(docs).collect()}
    assert not got - truth
    assert len(got) >= 0.95 * len(truth)
    assert spam.found(docs.limit(0)).count() == 0


def test_running_text():
    assert spam.running_text("One two three four five six. Another sentence of some words!") == 1.0
    assert spam.running_text("lab tape, best lab tape, cheap lab tape") == 0.0
    assert spam.running_text("Tips - SKU 1 - best - 15.42\nTape - SKU 2 - cheap - 3.99") == 0.0
    assert spam.running_text("") == 0.0 and spam.running_text("123") == 0.0
    assert spam.running_text("x " * 200_000) == 0.0


def test_short_texts_and_no_seeds(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng)) for i in range(60)] + [(60, "A title"), (61, "word"), (62, "A title of few words on a sensor")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert spam.found(docs).count() == 0
    links = [(100 + i, " ".join(f"http://a{i}.example/{k}" for k in range(3 + i % 3))) for i in range(12)]
    got = {r["doc_id"] for r in spam.found(spark.createDataFrame(rows + links, "doc_id long, text string")).collect()}
    assert got == {i for i, _ in links}


def test_mean_information_against_brute_force(spark):
    import math

    from pyspark.sql import functions as F

    rng = random.Random(11)
    texts = [" ".join(rng.choice(["ab", "cd", "ef", "gh", "ij", "kl"]) for _ in range(rng.randint(2, 12))) for _ in range(40)] + ["ab cd", "zz"]
    rows = spam.page_measures(spam.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).select("doc_id", F.round("mean_pmi", 9).alias("m")).collect()
    words, pairs = {}, {}
    for t in texts:
        w = t.split()
        for x in set(w):
            words[x] = words.get(x, 0) + 1
        for x in set(zip(w, w[1:], strict=False)):
            pairs[x] = pairs.get(x, 0) + 1
    nw, np_ = sum(words.values()), sum(pairs.values())
    want = {}
    for i, t in enumerate(texts):
        w = t.split()
        pmi = [math.log(pairs[x] / np_) - math.log(words[x[0]] / nw) - math.log(words[x[1]] / nw) for x in zip(w, w[1:], strict=False) if pairs[x] > 1]
        if len(w) > 1:
            want[i] = round(sum(pmi) / len(pmi), 9) if pmi else None
    assert {r["doc_id"]: r["m"] for r in rows} == want


def test_running_text_is_measured_and_judged_where_it_does_not_cohere(spark):
    rng = random.Random(12)
    phrases = [" ".join(rng.choice(WORDS) for _ in range(8)).capitalize() + "." for _ in range(30)]
    texts = [" ".join(rng.choice(phrases) for _ in range(4)) for _ in range(60)] + list(clean(rng)) * 3
    salad = [" ".join(" ".join(w) + "." for w in zip(*[iter(rng.sample(WORDS, 60))] * 6, strict=True)) for _ in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts + salad)), "doc_id long, text string")
    measured = {r["doc_id"]: r for r in spam.page_measures(spam.scan(docs)).collect()}
    assert set(measured) == set(range(len(texts + salad))) and all(measured[i]["mean_pmi"] is not None for i in range(60))
    low, high = spam.coherent(spam.page_measures(spam.scan(docs)).filter(f"text_share < {spam.JUDGED} or repeats >= {spam.REPEATS}"))
    outside = {i for i, r in measured.items() if r["text_share"] >= spam.JUDGED and r["mean_pmi"] is not None and not low <= r["mean_pmi"] <= high}
    assert outside and outside <= {r["doc_id"] for r in spam.judged(docs).collect()}
