"""Filling fixed-capacity containers to a target mixture of sources (problem 8).

Items are queued by source and taken window by window in deficit round-robin: a window of
``window_containers`` containers gives each source a quantum of its target share of the
window's tokens plus what earlier windows owed it; what a source takes beyond its quantum is
owed back. A window's items are then placed best-fit, largest first; the items of a container
that stayed too empty go back to the heads of their queues, so only the last window of a
partition can leave open containers.

Partitions: items are dealt to ``ceil(tokens / shard_tokens)`` shards by a hash of their id,
so a shard holds a bounded amount however large a source is. The deficits that shard ``k``
starts with are what the shards before it leave, a running sum over the small table of tokens
by shard and source; so windows follow on across partitions without being made in sequence.

Target shares are the sources' shares of all tokens unless given. Every item comes out:
``container_id, window_id, doc_id, part_no, token_start, n_tokens, source``. Only an item above the
capacity is split, into full containers and one rest that is packed like any other item.

Defined cases: null, empty and missing texts measure 0 tokens and come out as one part of 0
tokens in some container; a null source is a source; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict, deque

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeforge.llm.bpe import measure
from citeforge.session import cut

CAPACITY = 2048
SHARD_TOKENS = 2_000_000
WINDOW_CONTAINERS = 48
#: A container filled less than this is taken apart again unless its shard is at an end.
FILLED = 0.97


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """Container number of each item: largest first into the fullest container that has room."""
    # Equal sizes in mixed order, so that a container does not gather one source.
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i * 2654435761 % 4294967296))
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms = np.zeros(capacity + 1, bool)
    where, count = [0] * len(sizes), 0
    for i in order:
        fits = np.flatnonzero(rooms[sizes[i] :])
        if len(fits):
            room = int(fits[0]) + sizes[i]
            c = by_room[room].pop()
            rooms[room] = bool(by_room[room])
        else:
            room, c, count = capacity, count, count + 1
        where[i] = c
        by_room[room - sizes[i]].append(c)
        rooms[room - sizes[i]] = True
    return where


def fill_shard(
    items: pd.DataFrame, shares: dict, owed: dict, capacity: int, window: int, filled: float
) -> tuple[list[int], list[int]]:
    """Container and window of each item of one shard. ``owed`` holds the deficits it starts with."""
    queues: dict = defaultdict(deque)
    for i, s in enumerate(items["source"]):
        queues[s].append(i)
    sizes = items["n_tokens"].tolist()
    source = items["source"].tolist()
    place, turn, first, number_of, deficit = [0] * len(sizes), [0] * len(sizes), 0, 0, dict(owed)
    left = len(sizes)
    while left:
        taken, budget = [], window * capacity
        for s in sorted(queues, key=lambda s: (-deficit.get(s, 0.0), str(s))):
            deficit[s] = deficit.get(s, 0.0) + shares.get(s, 0.0) * budget
            q = queues[s]
            while q and deficit[s] > 0:
                i = q.popleft()
                taken.append(i)
                deficit[s] -= sizes[i]
        room = budget - sum(sizes[i] for i in taken)
        for s in sorted(queues, key=lambda s: (-deficit[s], str(s))):
            # Sources that ran dry leave room; the others fill it and owe it back.
            q = queues[s]
            while q and room > 0:
                i = q.popleft()
                taken.append(i)
                deficit[s] -= sizes[i]
                room -= sizes[i]
        last = left == len(taken)
        where = best_fit([sizes[i] for i in taken], capacity)
        load: dict[int, int] = defaultdict(int)
        for i, c in zip(taken, where, strict=True):
            load[c] += sizes[i]
        keep = {c for c in load if last or load[c] >= filled * capacity} or {max(load, key=load.get)}
        number = {c: first + k for k, c in enumerate(sorted(keep))}
        for i, c in zip(reversed(taken), reversed(where), strict=True):
            if c in keep:
                place[i], turn[i] = number[c], number_of
                left -= 1
            else:
                queues[source[i]].appendleft(i)
                deficit[source[i]] += sizes[i]
        first += len(keep)
        number_of += 1
        for s in [s for s in queues if not queues[s]]:
            deficit[s] = min(deficit.get(s, 0.0), 0.0)
    return place, turn


def _prefix(df: DataFrame, order: str, value: str, out: str, by: list[str] | None = None, block: int = 4096) -> DataFrame:
    """Sum of ``value`` over the rows before, by ``order``, in two levels: within blocks, and
    over the totals of the blocks, so that no task sorts the whole table."""
    by = by or []
    blocked = df.withColumn("__b", F.floor(F.col(order) / block))
    before = Window.partitionBy(*by, "__b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    totals = blocked.groupBy(*by, "__b").agg(F.sum(value).alias("__t"))
    ahead = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*by, "__b", F.coalesce(F.sum("__t").over(ahead), F.lit(0)).alias("__a"))
    summed = blocked.withColumn("__w", F.coalesce(F.sum(value).over(before), F.lit(0)))
    same = F.col("l.__b") == F.col("r.__b")
    for c in by:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    joined = summed.alias("l").join(totals.alias("r"), same)
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], (F.col("l.__w") + F.col("r.__a")).alias(out))


def pack(
    measured: DataFrame,
    shares: DataFrame | None = None,
    capacity: int = CAPACITY,
    shard_tokens: int = SHARD_TOKENS,
    window: int = WINDOW_CONTAINERS,
    filled: float = FILLED,
) -> DataFrame:
    """Containers of ``measured(doc_id, source, n_tokens)``; ``shares(source, share)`` optional.

    ``measured`` is read several times: pass a table, not a plan that tokenizes."""
    measured = measured.select("doc_id", "source", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"))
    total = measured.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_tokens))
    sharded = measured.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))
    by = sharded.groupBy("shard", "source").agg(F.sum("n_tokens").alias("have"))
    if shares is None:
        shares = by.groupBy("source").agg((F.sum("have") / F.lit(max(total, 1))).alias("share"))
    served = _prefix(by.groupBy("shard").agg(F.sum("have").alias("all")), "shard", "all", "all_before")
    had = _prefix(by, "shard", "have", "had_before", ["source"])
    owed = (
        had.join(served.select("shard", "all_before"), "shard")
        .alias("h")
        .join(shares.alias("s"), F.col("h.source").eqNullSafe(F.col("s.source")), "left")
        .select(
            F.col("shard").alias("of_shard"),
            F.col("h.source").alias("source"),
            F.coalesce("share", F.lit(0.0)).alias("share"),
            (F.coalesce("share", F.lit(0.0)) * F.col("all_before") - F.col("had_before")).alias("owed"),
        )
    )
    cap = F.lit(capacity).cast("long")
    starts = F.when(F.col("n_tokens") <= cap, F.array(F.lit(0).cast("long"))).otherwise(
        F.sequence(F.lit(0).cast("long"), F.col("n_tokens") - 1, cap)
    )
    parts = sharded.select(
        "shard", "doc_id", "source", F.col("n_tokens").alias("__n"), F.posexplode(starts).alias("part_no", "token_start")
    ).select(
        "shard",
        "doc_id",
        "source",
        "part_no",
        "token_start",
        F.least(cap, F.col("__n") - F.col("token_start")).alias("n_tokens"),
    )

    def run(items: pd.DataFrame, debts: pd.DataFrame) -> pd.DataFrame:
        out = ["container_id", "window_id", "doc_id", "part_no", "token_start", "n_tokens", "source"]
        if items.empty:
            return pd.DataFrame(columns=out)
        items = items.sort_values(["doc_id", "part_no"], kind="stable").reset_index(drop=True)
        items["source"] = items["source"].astype(object).where(items["source"].notna(), None)
        names = [None if pd.isna(s) else s for s in debts["source"]]
        place, turn = fill_shard(
            items, dict(zip(names, debts["share"], strict=True)), dict(zip(names, debts["owed"], strict=True)), capacity, window, filled
        )
        items["window_id"] = items["shard"].astype("int64") * (1 << 28) + np.array(turn, dtype="int64")
        items["container_id"] = items["shard"].astype("int64") * (1 << 28) + np.array(place, dtype="int64")
        return items[out]

    schema = parts.selectExpr(
        "cast(0 as bigint) as container_id", "cast(0 as bigint) as window_id", "doc_id", "part_no", "token_start", "n_tokens", "source"
    ).schema
    return parts.groupBy("shard").cogroup(owed.groupBy("of_shard")).applyInPandas(run, schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, **options) -> DataFrame:
    """Documents measured by the tokenization automaton and packed."""
    return pack(cut(measure(docs, keep=("source",), path=path), "measured"), capacity=capacity, **options)
