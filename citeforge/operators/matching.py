"""Offline record-to-work matching: candidates by blocking keys, scores, best match, DOI recovery
(survey SRC-10..12, JOIN-12, WIN-06, SIM-05..08, PIPE-13/14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeforge.functions.similarity import enrichment_score, jaccard, match_confidence, record_pages, title_similarity, work_authors
from citeforge.functions.text import blank, strip, text, words
from citeforge.operators.ids import update_by_key
from citeforge.session import cut

#: Least confidence of each recovery phase, in the order of the phases (fixed values).
PHASES = {"pmid": 0.8, "journal": 0.75, "title": 0.65}


def work_fields(works: DataFrame) -> DataFrame:
    """``work_id, pmid, title, authors, year, volume, pages, journal`` of nested works [STR-19/20, DAT-03]."""
    first = lambda c: F.try_element_at(c, F.lit(1))
    extra = [c for c in ("doi",) if c in works.columns]
    return works.select(
        "work_id", "pmid", first(F.col("title")).alias("title"), work_authors("author").alias("authors"),
        first(first(F.col("published.date_parts"))).cast("string").alias("year"), "volume", F.col("page").alias("pages"),
        first(F.col("container_title")).alias("journal"), *extra,
    )


def record_fields(records: DataFrame) -> DataFrame:
    pmid = F.col("pubmed_id") if "pubmed_id" in records.columns else F.lit(None).cast("string")
    return records.select(
        "record_id", pmid.alias("pmid"), "title", "authors", F.col("pub_year").alias("year"), "volume",
        record_pages("page_start", "page_end").alias("pages"), "page_start", F.col("source_title").alias("journal"), "doi",
    )


def _struct(names: list[str], prefix: str) -> dict[str, Column]:
    return {n: F.col(f"{prefix}.{n}") for n in names}


FIELDS = ["title", "authors", "year", "volume", "pages"]


def scored(pairs: DataFrame, method: str) -> DataFrame:
    """Pairs ``r, w`` of structs with the confidence of a method and its parts."""
    c = match_confidence(_struct(FIELDS, "r"), _struct(FIELDS, "w"), method)
    return pairs.withColumn("c", c).select(F.col("r.record_id").alias("record_id"), F.col("w.work_id").alias("work_id"), F.lit(method).alias("method"), "c.*")


def pairs_by(records: DataFrame, works: DataFrame, left: Column, right: Column) -> DataFrame:
    """Candidate pairs that agree on a key, which must not be blank."""
    a = records.select(left.alias("__k"), F.struct(*records.columns).alias("r")).filter("__k is not null and __k <> ''")
    b = works.select(right.alias("__k"), F.struct(*works.columns).alias("w")).filter("__k is not null and __k <> ''")
    return a.join(b, "__k").select("r", "w")


def journal_key(journal: Column, volume: Column, page: Column) -> Column:
    known = (strip(text(volume)) != "") & (text(page) != "")
    return F.when(known, F.concat_ws("|", F.lower(strip(text(journal))), strip(text(volume)), F.substring_index(text(page), "-", 1)))


#: Least word Jaccard of the titles of a candidate pair (SIM-08), and how many words of both prefixes are a key.
LEAST_TITLE, SHARED = 0.65, 3


def title_words(title: Column, marks: bool = False) -> Column:
    """The distinct lower-case words of a title, with their punctuation marks or without."""
    low = F.lower(text(title))
    return F.array_sort(F.array_distinct(words(low if marks else F.regexp_replace(low, r"[^\p{L}\p{N}]+", " "))))


def _prefix_keys(ranked: Column) -> Column:
    """Keys of a word set in rank order, rarest first. Two sets of the Jaccard coefficient wanted have at least
    ``SHARED`` words in common among as many more than their size less the least overlap, and so a key; where
    the overlap may be less than ``SHARED``, one common word is the key."""
    n = F.size(ranked)
    overlap = F.ceil(n * F.lit(LEAST_TITLE) - F.lit(1e-9)).cast("int")
    p = F.slice(ranked, 1, F.greatest(n - overlap + SHARED, F.lit(0)))
    rest = lambda i: F.slice(p, i, F.size(p) + 1)
    threes = F.flatten(
        F.transform(p, lambda x, i: F.flatten(F.transform(rest(i + 2), lambda y, j: F.transform(rest(i + j + 3), lambda z: F.xxhash64(x, y, z)))))
    )
    ones = F.transform(F.slice(ranked, 1, F.greatest(n - overlap + 1, F.lit(0))), lambda x: F.xxhash64(x))
    short = int((SHARED - 1) / LEAST_TITLE)  # of so many words, fewer than SHARED may do; its partners have up to partner words
    partner = int(short / LEAST_TITLE)
    none = F.array().cast("array<bigint>")
    return F.when(n > short, F.when(n <= partner, F.concat(ones, threes)).otherwise(threes)).when(n > 0, ones).otherwise(none)


def _bits(hashes: Column, half: int) -> Column:
    """64 bits, one for each word of one half of all words: bits that differ are words that differ."""
    mine = F.filter(hashes, lambda h: F.shiftright(h, 6).bitwiseAND(F.lit(1)) == half)
    one = F.lit(1).cast("long")
    return F.aggregate(mine, F.lit(0).cast("long"), lambda b, h: b.bitwiseOR(F.call_function("shiftleft", one, h.bitwiseAND(F.lit(63)).cast("int"))))


def similar_titles(left: DataFrame, right: DataFrame) -> DataFrame:
    """``a, b``: all pairs of a title of ``left`` and one of ``right`` (column ``t``) whose words, with or
    without punctuation marks, have a Jaccard coefficient of ``LEAST_TITLE``. An exact set-similarity join:
    prefix keys over words ordered by frequency, pruned by bit counts, verified on the words."""
    kinds = {"raw": True, "bare": False}
    sets = [
        df.select("t").distinct().select("t", F.xxhash64("t").alias("tid"), *[title_words(F.col("t"), m).alias(k) for k, m in kinds.items()])
        for df in (left, right)
    ]
    a, b = cut(sets[0], "titles"), cut(sets[1], "titles")
    hashed = lambda k: F.transform(F.filter("r", lambda x: F.array_contains(F.col(k), x["word"])), lambda x: F.xxhash64(x["word"]))
    every = lambda df: df.select("tid", F.explode(F.array_union("raw", "bare")).alias("word"))
    spread = every(a).unionByName(every(b)).groupBy("word").agg(F.count("*").alias("n"))

    def keyed(df: DataFrame, p: str) -> DataFrame:
        ranks = every(df).join(spread, "word").groupBy("tid").agg(F.array_sort(F.collect_list(F.struct("n", "word"))).alias("r"))
        ranked = df.join(ranks, "tid").select("tid", *[hashed(k).alias(k) for k in kinds])
        keys = F.array_distinct(F.concat(*[_prefix_keys(F.col(k)) for k in kinds]))
        parts = [c for k in kinds for c in (F.size(k).alias(f"{p}_{k}_n"), _bits(F.col(k), 0).alias(f"{p}_{k}_0"), _bits(F.col(k), 1).alias(f"{p}_{k}_1"))]
        packed = cut(ranked.select(F.col("tid").alias(p), *parts, keys.alias("keys")), "title-keys")
        return packed.select(F.explode("keys").alias("key"), *[c for c in packed.columns if c != "keys"])

    def near(k: str) -> Column:
        """Words that differ in at least this many bits leave room for the coefficient: J = (n - d) / (n + d)."""
        differ = sum((F.bit_count(F.col(f"a_{k}_{h}").bitwiseXOR(F.col(f"b_{k}_{h}"))) for h in (0, 1)), F.lit(0))
        return differ <= (F.col(f"a_{k}_n") + F.col(f"b_{k}_n")) * F.lit((1 - LEAST_TITLE) / (1 + LEAST_TITLE)) + F.lit(1e-9)

    pairs = keyed(a, "a").join(keyed(b, "b"), "key").filter(near("raw") | near("bare")).select(F.col("a").alias("x"), F.col("b").alias("y")).distinct()
    x = a.select(F.col("tid").alias("x"), F.col("t").alias("a"), *[F.col(k).alias(f"a_{k}") for k in kinds])
    y = b.select(F.col("tid").alias("y"), F.col("t").alias("b"), *[F.col(k).alias(f"b_{k}") for k in kinds])
    alike = lambda k: jaccard(F.col(f"a_{k}"), F.col(f"b_{k}")) >= LEAST_TITLE
    return pairs.join(x, "x").join(y, "y").filter(alike("raw") | alike("bare")).select("a", "b")


def pairs_by_title(records: DataFrame, works: DataFrame) -> DataFrame:
    """Candidate pairs of similar titles."""
    a = records.select(F.lower(text("title")).alias("a"), F.struct(*records.columns).alias("r"))
    b = works.select(F.lower(text("title")).alias("b"), F.struct(*works.columns).alias("w"))
    near = similar_titles(a.select(F.col("a").alias("t")), b.select(F.col("b").alias("t")))
    return near.join(a, "a").join(b, "b").select("r", "w")


def candidates(records: DataFrame, works: DataFrame, method: str) -> DataFrame:
    if method == "pmid":
        return pairs_by(records, works, F.col("pmid"), F.col("pmid"))
    if method == "journal":
        return pairs_by(
            records, works, journal_key(F.col("journal"), F.col("volume"), F.col("page_start")), journal_key(F.col("journal"), F.col("volume"), F.col("pages"))
        )
    return pairs_by_title(records, works)


def best(pairs: DataFrame) -> DataFrame:
    """[WIN-06] The pair of the highest confidence of every record; on ties the most similar title of the
    title phase, then the least work."""
    title = F.when(F.col("method") == "title", F.col("title_sim")).alias("title_sim")
    top = F.max_by(F.struct("work_id", "method", "confidence"), F.struct("confidence", title, -F.col("work_id")))
    return pairs.groupBy("record_id").agg(top.alias("b")).select("record_id", "b.*")


def search_journal(works: DataFrame, journal: str, years: tuple[int, int] | None = None, page: str | None = None) -> DataFrame:
    """[SRC-11] The work of a journal that a search gives: within a range of years, one whose pages
    hold the page asked for before the others, then the least id; at most one row."""
    w = work_fields(works).filter(F.lower(strip(text("journal"))) == journal.strip().lower())
    if years:
        w = w.filter(F.col("year").try_cast("int").between(*years))
    holds = F.contains(text("pages"), F.lit(page)) if page else F.lit(False)
    return w.orderBy(F.desc(holds), "work_id").limit(1)


def search_title(works: DataFrame, title: str, author: str | None = None, year: int | None = None, limit: int = 5) -> DataFrame:
    """[SRC-12] The works whose titles are the most like one, best first, of an author or year if given."""
    w = work_fields(works).withColumn("likeness", title_similarity(F.lit(title), "title")).filter("likeness > 0")
    if author:
        w = w.filter(F.contains(F.lower("authors"), F.lit(author.lower())))
    if year:
        w = w.filter(F.col("year") == str(year))
    return w.orderBy(F.desc("likeness"), "work_id").limit(limit)


def with_and_without(records: DataFrame, works: DataFrame, kept) -> DataFrame:
    """[PIPE-22] ``setting, kept, with_doi``: what a filter keeps with and without recovered DOIs."""
    sides = {"without_recovery": records, "with_recovery": recover_dois(records, works)}
    rows = [
        kept(df).agg(F.count("*").alias("kept"), F.count(F.when(~blank("doi"), 1)).alias("with_doi")).select(F.lit(n).alias("setting"), "kept", "with_doi")
        for n, df in sides.items()
    ]
    return rows[0].unionByName(rows[1])


def cascade(records: DataFrame, works: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """[PIPE-13] ``record_id, work_id, method, confidence``: the best match of the first phase
    that has one above its threshold; later phases leave out what is matched."""
    left = record_fields(records.filter(blank("doi")))
    right = work_fields(works)
    done: DataFrame | None = None
    for method, least in (thresholds or PHASES).items():
        todo = left if done is None else left.join(done.select("record_id"), "record_id", "left_anti")
        hit = best(scored(candidates(todo, right, method), method).filter(F.col("confidence") >= least))
        done = hit if done is None else done.unionByName(hit)
    return done


def recover_dois(records: DataFrame, works: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """[PIPE-14, SNK-05] Records with missing DOIs filled from works that carry one."""
    found = cascade(records, works, thresholds).join(works.select("work_id", "doi"), "work_id").filter(~blank("doi")).select("record_id", "doi")
    return update_by_key(records.withColumn("doi", F.when(~blank("doi"), F.col("doi"))), found, "record_id", ["doi"])


def recovery_stats(records: DataFrame, matched: DataFrame) -> DataFrame:
    """[AGG-25, SUP-11] One row: missing before, recovered by phase, and the success rate."""
    missing = records.filter(blank("doi")).agg(F.count("*").alias("missing"))
    by = matched.agg(*[F.count(F.when(F.col("method") == m, 1)).alias(f"by_{m}") for m in PHASES], F.count("*").alias("recovered"))
    rate = F.when(F.col("missing") > 0, F.col("recovered") * 100.0 / F.col("missing")).otherwise(0.0)
    return missing.join(by, F.lit(True)).withColumn("rate", rate).withColumn("passed", F.col("recovered") >= F.greatest(F.lit(1), F.col("missing") / 10))


__all__ = ["best", "candidates", "cascade", "enrichment_score", "recover_dois", "recovery_stats", "scored", "title_similarity", "work_fields"]
