"""Matching records of two sources that share no identifier (problem 6).

Attributes are encoded as fixed bit vectors. The q-grams (q = 2) of a title set bits of a
1,024-bit vector, those of the authors' family names and of the journal bits of 256-bit vectors; page, volume, year, first author and journal each give a code of their own
segment (a journal's is made of the initials of its words, which abbreviation keeps).

Close pairs are found by multi-index hashing, exactly for the radii used: title vectors are
cut into 8 chunks, so two within Hamming distance 7 agree in at least one, and the numbers of
bits in the chunks, kept with the key, drop most pairs beyond that distance; of the five
segments two may differ or be missing, so pairs within that radius agree in some three. (The
triple of journal, year and volume is no key: in one journal the year gives the volume away.)
A key that very many rows of both sides share is dealt into blocks of ``BLOCK`` rows, and every
block of one side meets every block of the other: no task makes all its pairs, none is lost.
Titles under ``SHORT`` characters name no single work: the exact comparison takes them only
with equal page and volume and the same authors or journal, so their segments find all of them.

Every candidate pair gets the Dice coefficients of its vectors, field by field (titles cut short and
author lists cut short by what they contain, abbreviated journals by their initials as well). The fields'
levels of Dice make a bounded number of patterns; over the counts of the patterns of all pairs an
expectation-maximisation fit (Fellegi-Sunter) gives each level its weight, and the posterior
of a pattern is the confidence of its pairs: calibrated, as its mean over the pairs is the
share of matches. An exact comparison of titles, notices, parts, pages and volumes follows.

Defined cases: works without title, author, date, volume or page match by what they have;
``published`` may hold empty lists; repeated records and works give all their pairs; blank
values never agree with each other; empty tables give an empty result.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeforge.llm.history import family_names, first_family, same_publication
from citeforge.llm.names import fold
from citeforge.llm.records import number, plain, titles_near
from citeforge.session import cut

BITS, CHUNKS = 1024, 8
#: Bits of the vectors of family names and journals.
SMALL = 256
SHORT = 30
#: Rows of one key and side that one task handles.
BLOCK = 1000
THRESHOLD = 0.5
#: Pairs of either kind that the levels' weights are begun from.
PSEUDO = 5
SEGMENTS = ["page", "volume", "year", "first", "journal"]
_TRIPLES = [t for t in itertools.combinations(SEGMENTS, 3) if t != ("volume", "year", "journal")]
_SMALL = {"in", "and", "of", "the", "for", "on", "a", "iin", "annd", "adn", "ofo", "fo"}
#: Where each of the 65,536 two-byte grams sets its bit: a fixed pseudo-random table.
_BIT = (np.arange(65536, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % BITS


def bits(text: str, size: int = BITS) -> bytes:
    """The bit vector of a text's q-grams."""
    out = np.zeros(size, np.uint8)
    raw = np.frombuffer(f" {text} ".encode(), np.uint8).astype(np.int64)
    out[_BIT[raw[:-1] * 256 + raw[1:]] % size] = 1
    return np.packbits(out).tobytes()


def journal_code(name: str) -> str:
    """Initials of a journal's words."""
    return "".join(w[0] for w in name.split() if w not in _SMALL)


def families_of(authors: list | None) -> str:
    names = [re.sub(r"[^a-z ]", "", fold((a or {}).get("family") or "")).strip() for a in authors or []]
    return " ".join(sorted(n for n in names if n))


_SCHEMA = pa.schema(
    [
        ("id", pa.int64()), ("title", pa.string()), ("page", pa.int64()), ("volume", pa.int64()), ("year", pa.int64()),
        ("first", pa.string()), ("families", pa.string()), ("journal", pa.string()), ("vector", pa.binary()), ("keys", pa.list_(pa.int64())),
        ("weights", pa.int64()), ("chunked", pa.bool_()), ("people", pa.binary()), ("venue", pa.binary()),
    ]
)
_DDL = (
    "id long, title string, page long, volume long, year long, first string, families string, journal string, vector binary, keys array<long>, "
    "weights long, chunked boolean, people binary, venue binary"
)


def _encoded(rid, title, page, volume, year, first, families, venue):
    vector = bits(title)
    keys, weights = [], 0
    chunked = len(title) >= SHORT
    if chunked:
        step = len(vector) // CHUNKS
        for i in range(CHUNKS):
            part = vector[i * step : (i + 1) * step]
            keys.append(xxhash.xxh3_64_intdigest(part, seed=i) - (1 << 63))
            weights = weights << 6 | min(int.from_bytes(part).bit_count(), 63)
    journal = journal_code(venue)
    have = {"page": page, "volume": volume, "year": year, "first": first or None, "journal": journal or None}
    for at, triple in enumerate(_TRIPLES):
        x, y, z = (have[s] for s in triple)
        if x is not None and y is not None and z is not None:
            keys.append(xxhash.xxh3_64_intdigest(f"{x}|{y}|{z}", seed=100 + at) - (1 << 63))
    return rid, title, page, volume, year, first, families, journal, vector, keys, weights, chunked, bits(families, SMALL), bits(venue, SMALL)


def _batches(batches: Iterator[pa.RecordBatch], make):
    for batch in batches:
        rows = [make(*r) for r in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def _record(rid, title, authors, year, source, volume, page, art):
    first = number(page)
    return _encoded(
        rid, plain(title), first if first is not None else number(art), number(volume), number(year), first_family(authors),
        family_names(authors), plain(source),
    )


def _work(wid, titles, authors, published, volume, page, containers):
    parts = ((published or {}).get("date_parts") or [None])[0] or [None]
    head = next(iter(authors or []), None)
    return _encoded(
        wid, plain(next(iter(titles or []), None)), number(page), number(volume), parts[0], families_of([head] if head else []),
        families_of(authors), plain(next(iter(containers or []), None)),
    )


def encode_records(records: DataFrame) -> DataFrame:
    return records.select(
        "record_id", "title", "authors", "pub_year", "source_title", "volume", "page_start", "art_no"
    ).mapInArrow(lambda b: _batches(b, _record), _DDL)


def encode_works(works: DataFrame) -> DataFrame:
    return works.select("work_id", "title", "author", "published", "volume", "page", "container_title").mapInArrow(
        lambda b: _batches(b, _work), _DDL
    )


def _keyed(side: DataFrame) -> DataFrame:
    """``id, key, weights``: a row per key; ``weights`` (the numbers of bits in the chunks of the
    title vector) only with the keys of chunks."""
    each = side.select("id", "weights", "chunked", F.posexplode("keys").alias("at", "key"))
    return each.withColumn("weights", F.when(F.col("chunked") & (F.col("at") < CHUNKS), F.col("weights"))).drop("at", "chunked")


def within_radius(a: Column, b: Column) -> Column:
    """False if the numbers of bits in the chunks alone put two vectors beyond the radius: the
    Hamming distance is at least the sum of their differences."""
    part = lambda c, i: F.shiftright(c, 6 * i).bitwiseAND(F.lit(63))
    return sum((F.abs(part(a, i) - part(b, i)) for i in range(CHUNKS)), F.lit(0)) < CHUNKS


def candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """``record_id, work_id`` of every pair that shares a key, once."""
    a, b = _keyed(left), _keyed(right)
    counts = (
        a.select("key", F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(b.select("key", F.lit(0).alias("l"), F.lit(1).alias("r")))
        .groupBy("key")
        .agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
        .filter((F.col("l") > 0) & (F.col("r") > 0))
    )
    shared = cut(counts, "link-keys")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("long")
    hot = shared.filter((F.col("l") > BLOCK) | (F.col("r") > BLOCK)).select("key", blocks("l").alias("own_l"), blocks("r").alias("own_r"))
    split = not hot.isEmpty()

    def dealt(side: DataFrame, own: str, met: str, first: bool) -> DataFrame:
        rows = side.join(shared.select("key"), "key", "left_semi")
        if not split:
            return rows
        mine = F.pmod(F.xxhash64("id"), F.col(own))
        others = F.sequence(F.lit(0).cast("long"), F.col(met) - 1)
        keys = F.transform(others, lambda o: F.xxhash64("key", *((mine, o) if first else (o, mine))))
        rows = rows.join(hot, "key", "left")
        return rows.select("id", "weights", F.explode(F.when(F.col(own).isNotNull(), keys).otherwise(F.array("key"))).alias("key"))

    x, y = dealt(a, "own_l", "own_r", True).alias("x"), dealt(b, "own_r", "own_l", False).alias("y")
    near = F.col("x.weights").isNull() | within_radius(F.col("x.weights"), F.col("y.weights"))
    return (
        x.join(y, F.col("x.key") == F.col("y.key"))
        .filter(near)
        .select(F.col("x.id").alias("record_id"), F.col("y.id").alias("work_id"))
        .distinct()
    )


#: Levels of each field in a pattern.
_LEVELS = [4, 3, 3, 3, 4, 4]


def _dice(x: bytes, y: bytes) -> tuple[float, float]:
    """Dice coefficient of two vectors, and the share of the smaller that the larger contains."""
    a, b = int.from_bytes(x), int.from_bytes(y)
    m, n, both = a.bit_count(), b.bit_count(), (a & b).bit_count()
    return (2 * both / (m + n), both / min(m, n)) if m and n else (0.0, 0.0)


def _level(a, b) -> int:
    return 0 if a is None or b is None or a == "" or b == "" else 2 if a == b else 1


def pattern(x: dict, y: dict) -> tuple[int, float]:
    """Agreement pattern of a pair, as one number, and its title Dice."""
    dice, part = _dice(x["vector"], y["vector"]) if x["title"] and y["title"] else (0.0, 0.0)
    # A title cut short is contained in the whole one.
    levels = [0 if not (x["title"] and y["title"]) else 3 if dice >= 0.9 else 2 if dice >= 0.7 or part >= 0.9 else 1]
    levels += [_level(x[f], y[f]) for f in ("page", "volume", "year")]
    fams = venue = 0
    if x["families"] and y["families"]:
        p, q = set(x["families"].split()), set(y["families"].split())
        whole = _dice(x["people"], y["people"])[0]
        fams = 3 if whole >= 0.9 else 2 if whole >= 0.7 or 2 * len(p & q) >= 1.2 * min(len(p), len(q)) else 1
    if x["journal"] and y["journal"]:
        whole = _dice(x["venue"], y["venue"])[0]
        # Journals differ by a word in many, so only nearly equal vectors stand for equal initials.
        code = x["journal"] == y["journal"]
        venue = 3 if whole >= 0.9 and code else 2 if whole >= 0.95 or code else 1
    levels += [fams, venue]
    code = 0
    for level, n in zip(levels, _LEVELS, strict=True):
        code = code * n + level
    return code, dice


def settled(x: dict, y: dict) -> dict:
    """``y`` without a volume or year that is the only thing to speak against the pair: the sources
    often give another one. What outweighs it is the same first page by the same authors (or, where
    one side names none, in the same journal), or, where a page is missing, the same authors, year
    and journal."""
    p, q = set(x["families"].split()), set(y["families"].split())
    people = bool(p and q) and 2 * len(p & q) >= 1.2 * min(len(p), len(q))
    journal = bool(x["journal"]) and x["journal"] == y["journal"]
    paged = x["page"] is not None and y["page"] is not None
    years = x["year"] is not None and y["year"] is not None
    volumes = x["volume"] is not None and y["volume"] is not None
    volume_other = volumes and x["volume"] != y["volume"]
    if paged and x["page"] == y["page"] and (people or (journal and not (p and q))):
        if volume_other and (not years or abs(x["year"] - y["year"]) <= 1):
            return y | {"volume": None}
        if volumes and not volume_other and years and x["year"] != y["year"]:
            return y | {"year": None}
    if volume_other and not paged and people and journal and years and x["year"] == y["year"]:
        return y | {"volume": None}
    return y


def fit(counts: dict[int, int], rounds: int = 60) -> dict[int, float]:
    """Posterior match probability of every pattern, by expectation-maximisation."""
    codes = np.array(sorted(counts), np.int64)
    n = np.array([counts[c] for c in codes], float)
    levels, rest = [], codes.copy()
    for k in reversed(_LEVELS):
        levels.append(rest % k)
        rest //= k
    levels = levels[::-1]
    # Start: a pair is a match if its title is alike and most other known fields agree.
    agree = sum((lv >= 2).astype(float) for lv in levels[1:]) / np.maximum(1, sum((lv > 0).astype(float) for lv in levels[1:]))
    post = np.clip(0.98 * (levels[0] >= 2) * (agree > 0.5), 0.01, 0.98)
    for _ in range(rounds):
        p = float((n * post).sum() / n.sum())
        weights = np.full(len(codes), np.log(max(p, 1e-9) / max(1 - p, 1e-9)))
        for lv, k in zip(levels, _LEVELS, strict=True):
            # Few pairs hardly move the weights from what agreement and disagreement usually mean.
            usual = np.array([0.0, 0.1] + [0.9 / (k - 2)] * (k - 2)) * PSEUDO
            rare = np.array([0.0, 0.9] + [0.1 / (k - 2)] * (k - 2)) * PSEUDO
            m = np.array([(n * post)[lv == v].sum() for v in range(k)]) + usual
            u = np.array([(n * (1 - post))[lv == v].sum() for v in range(k)]) + rare
            # A missing value (level 0) speaks for neither side.
            m, u = m / m[1:].sum(), u / u[1:].sum()
            w = np.log(np.maximum(m, 1e-12) / np.maximum(u, 1e-12))
            w[0] = 0.0
            weights += w[lv]
        post = 1 / (1 + np.exp(-np.clip(weights, -40, 40)))
    return {int(c): float(x) for c, x in zip(codes, post, strict=True)}


def scored(records: DataFrame, works: DataFrame) -> DataFrame:
    """``record_id, work_id, title_dice, confidence, same`` of every candidate pair."""
    left, right = cut(encode_records(records), "link-records"), cut(encode_works(works), "link-works")
    pairs = cut(candidates(left, right), "link-pairs")
    cols = ["title", "page", "volume", "year", "families", "journal", "vector", "people", "venue"]
    joined = pairs.join(left.select(F.col("id").alias("record_id"), F.struct(*cols).alias("x")), "record_id").join(
        right.select(F.col("id").alias("work_id"), F.struct(*cols).alias("y")), "work_id"
    )
    untitled = (F.col("x.title") == "") | (F.col("y.title") == "")
    near = untitled | titles_near(F.col("x.title"), F.col("y.title"))
    joined = joined.select("record_id", "work_id", "x", "y", near.alias("near"))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            codes, dices, same = [], [], []
            for x, y, near in zip(*[batch.column(k).to_pylist() for k in (2, 3, 4)], strict=True):
                code, dice = pattern(x, y)
                x |= {"doi": None, "eid": None, "source": x["journal"] or None}
                y |= {"doi": None, "eid": None, "source": y["journal"] or 0}
                codes.append(code)
                dices.append(dice)
                same.append(near and same_publication(x, settled(x, y)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(codes, pa.int32()), pa.array(dices, pa.float64()), pa.array(same, pa.bool_())],
                names=["record_id", "work_id", "pattern", "title_dice", "same"],
            )

    valued = cut(joined.mapInArrow(run, "record_id long, work_id long, pattern int, title_dice double, same boolean"), "link-valued")
    # At most as many rows as there are patterns: a bound fixed by the levels.
    counts = {r["pattern"]: r["n"] for r in valued.groupBy("pattern").agg(F.count("*").alias("n")).collect()}
    post = fit(counts) if counts else {}
    table = records.sparkSession.createDataFrame(sorted(post.items()) or [(-1, 0.0)], "pattern int, confidence double")
    return valued.join(F.broadcast(table), "pattern").select("record_id", "work_id", "title_dice", "confidence", "same")


def matches(records: DataFrame, works: DataFrame) -> DataFrame:
    """``record_id, work_id, title_dice, confidence`` of the pairs of the same publication."""
    keep = F.col("same") & (F.col("confidence") >= THRESHOLD)
    return scored(records, works).filter(keep).select("record_id", "work_id", "title_dice", "confidence")


def found(records: DataFrame, works: DataFrame) -> DataFrame:
    return matches(records, works).select("record_id", "work_id")
