"""Title candidates against brute force."""

import random
import re

from pyspark.sql import functions as F

from citeforge.operators import matching


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def brute(left, right):
    """Pairs whose words, with or without punctuation marks, are alike enough."""
    raw, bare = (lambda t: set(t.split())), (lambda t: set(re.sub(r"[\W_]+", " ", t).split()))
    return {(a, b) for a in left for b in right if max(jaccard(raw(a), raw(b)), jaccard(bare(a), bare(b))) >= 0.65}


def test_similar_titles_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in "xyz"]

    def changed(title):
        words = title.split()
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(words) + 1)
            words[i : i + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 1)
        return rng.choice([" ", " ", " ", "-", ": "]).join(words)

    left = {" ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 9, 14, 22]))) for _ in range(250)}
    right = {changed(rng.choice(sorted(left))) for _ in range(250)}
    frames = [spark.createDataFrame([(t,) for t in sorted(x)], "t string") for x in (left, right)]
    got = [tuple(r) for r in matching.similar_titles(*frames).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(left, right) and sum(a != b for a, b in got) > 100


def test_a_retyped_or_missing_word_keeps_the_pair(spark):
    title = "A portable sensor chip for zolgamide in river water"
    records = spark.createDataFrame(
        [(1, title), (2, title.replace("portable", "potrable")), (3, title.replace(" river", "")), (4, "Wholly different words about an other thing"), (5, "")],
        "record_id long, title string",
    ).select("*", *[F.lit(v).alias(c) for c, v in (("authors", "Doe, J."), ("year", "2020"), ("volume", "1"), ("pages", "1-2"))])
    works = records.filter("record_id = 1").drop("record_id").withColumn("work_id", F.lit(7).cast("long"))
    # A work of the same confidence whose title is only similar does not come before the equal one.
    works = works.unionByName(works.withColumns({"work_id": F.lit(3).cast("long"), "title": F.lit(title.replace("chip", "film"))}))
    best = matching.best(matching.scored(matching.candidates(records, works, "title"), "title"))
    assert {r["record_id"]: r["work_id"] for r in best.collect()} == {1: 7, 2: 7, 3: 7}
