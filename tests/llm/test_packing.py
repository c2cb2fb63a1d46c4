"""Containers: nothing lost, nothing split without need, little unused space, shares kept."""

import random
from collections import Counter, defaultdict

import pytest

from citeforge.llm.packing import best_fit, pack, pack_documents


def rows(n, seed=0):
    rng = random.Random(seed)
    return [(i, "hot" if rng.random() < 0.4 else f"s{rng.randint(0, 9)}", rng.choice([0, 7, 90, 300, 700, 2048, 2049, 9000])) for i in range(n)]


def check(items, packed, capacity=2048):
    size, parts, fill = {i: n for i, _, n in items}, defaultdict(list), Counter()
    for r in packed:
        parts[r["doc_id"]].append((r["part_no"], r["token_start"], r["n_tokens"]))
        fill[r["container_id"]] += r["n_tokens"]
    assert set(parts) == set(size) and max(fill.values(), default=0) <= capacity
    for i, p in parts.items():
        p.sort()
        assert sum(n for _, _, n in p) == size[i] and [s for _, s, _ in p] == [k * capacity for k in range(len(p))]
        assert len(p) == max(1, -(-size[i] // capacity)) and all(n == capacity for _, _, n in p[:-1])
    return fill


@pytest.mark.parametrize("shard_tokens", [10**9, 200_000])
def test_whole_and_dense(spark, shard_tokens):
    items = rows(3000)
    fill = check(items, pack(spark.createDataFrame(items, "doc_id long, source string, n_tokens long"), shard_tokens=shard_tokens).collect())
    assert sum(fill.values()) / (2048 * len(fill)) > (0.985 if shard_tokens > 10**8 else 0.97)


def test_shares_follow_the_target(spark):
    items = [(i, "a" if i % 4 else "b", 100) for i in range(8000)]
    out = pack(spark.createDataFrame(items, "doc_id long, source string, n_tokens long"), window=20).collect()
    windows = defaultdict(Counter)
    for r in out:
        windows[r["window_id"]][r["source"]] += r["n_tokens"]
    shares = [w["b"] / sum(w.values()) for w in windows.values() if sum(w.values()) > 30_000]
    assert len(shares) > 10 and all(abs(s - 0.25) < 0.03 for s in shares)


def test_edges(spark):
    schema = "doc_id long, source string, n_tokens long"
    assert pack(spark.createDataFrame([], schema)).count() == 0
    check([(1, None, 0), (2, None, 5)], pack(spark.createDataFrame([(1, None, None), (2, None, 5)], schema)).collect())
    docs = spark.createDataFrame([(1, "s", None), (2, "s", ""), (3, None, "word " * 5000), (4, "s", "word")], "doc_id long, source string, text string")
    out = pack_documents(docs).collect()
    assert {r["doc_id"] for r in out} == {1, 2, 3, 4} and max(r["part_no"] for r in out if r["doc_id"] == 3) >= 2


def test_best_fit():
    where = best_fit([5, 5, 3, 7, 2], 10)
    fill = Counter()
    for i, c in enumerate(where):
        fill[c] += [5, 5, 3, 7, 2][i]
    assert max(fill.values()) <= 10 and len(fill) == 3
