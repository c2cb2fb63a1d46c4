"""Deduplicating new batches against all history with a pivot-distance table (problem 5).

Records are points of a product of metric spaces: an anchor on a line (a 64-bit number) and
a title under edit distance. A record has one point per anchor (``anchors`` lists them): its
identifiers; its page with its authors; its volume or year with page and first author; the
head of its title with the volume; and any four of the five rarest words of its title. The
table holds for every point the distances to fixed pivots: the anchor line's origin (that
distance is the anchor itself), the empty title (the title's length), and titles of one letter
class repeated beyond any title's length (each distance is a length less a count, under the
class-preserving projection, which never lengthens a distance). So every stored value is a
distance to a pivot, computed in one pass. Beside them stand page, volume and year.

The table is kept in ``SLOTS`` ranges of the first distance; a batch reads the ranges that its
own points lie in. Points of one publication share the first distance exactly for some anchor.
Among those the triangle inequality prunes: no edit distance is below the difference of two
distances to the same pivot. Pairs with different pages or volumes or distant years
go as well, unless an identifier brought them together. What survives, few pairs, is verified by true edit distance, then by an exact
comparison of titles, notices, parts, pages and volumes; only for these are stored titles
joined. The batch's rows are appended to the table.

No anchor depends on the size of the table: which words of a title are the rarest is decided
by the count that a word had when it was first stored, an order that never changes again, so a
record gets the same anchors in whatever batch it comes. An anchor that more than ``HOT``
points of history share is dealt into blocks, and every block of the batch meets every block
of history, so no task gathers a large part of the table and no pair is lost. Exact copies are
collapsed to their first record before anything is compared.

An identifier is a stand-in, and identifies nothing, if most of the titles that carry it are
far from one of them. The counts of near and far titles are stored with that one title.

Each accepted batch is a folder of each table and counts only once its mark is written, so an
interrupted batch leaves nothing behind and is simply accepted again.

Defined cases: a record without title is matched by identifier or page and authors only; one
without any anchor matches nothing; blank identifiers and stand-ins never match; repeated
rows are duplicates of the first; the first record of a publication is the one accepted first,
whatever its id, and within a batch the least id; a record that shows two publications of history
to be one makes the later one follow the earlier (``members``).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeforge.llm.encoding import characters
from citeforge.llm.graph import components
from citeforge.llm.names import fold
from citeforge.llm.records import EDITS, identifier, number, plain, repair, same_title, titles_near
from citeforge.session import cut, shared_dir

#: An anchor of more points than this is dealt into blocks of about as many.
HOT = 1000
#: Of so many rarest words of a title, all but one make an anchor.
RAREST = 5
#: Ranges of the anchor line that the stored table is kept in.
SLOTS = 32
#: Letter classes whose repetitions are the pivots.
CLASSES = ["aeiou", "bcdfgt", "lmnrs", "0123456789kpvwxyz"]

_STRIP = [str.maketrans("", "", "".join(c for c in "abcdefghijklmnopqrstuvwxyz0123456789 " if c not in k)) for k in CLASSES]


def key(*parts: object) -> int:
    return xxhash.xxh3_64_intdigest("\x1f".join(map(str, parts))) - (1 << 63)


def pivots(title: str) -> list[int]:
    """Distances of a title to the pivots, each less the pivot's fixed length."""
    return [len(title), *[len(title.translate(t)) for t in _STRIP]]


#: Bits of a stored distance. Longer distances count as the longest, which keeps every bound.
WIDTH = 12


def packed(distances: list[int]) -> int:
    """Up to five distances in one number, the first in the lowest bits."""
    return sum(min(d, (1 << WIDTH) - 1) << WIDTH * i for i, d in enumerate(distances))


def stored(pivots: Column | str, i: int) -> Column:
    return F.shiftright(pivots, WIDTH * i).bitwiseAND(F.lit((1 << WIDTH) - 1))


def family_names(authors: str | None) -> str:
    """Family names of an author list, folded and sorted; initials may follow without comma."""
    names = []
    for a in characters(authors or "").split(";"):
        name = a.split(",")[0].strip()
        if re.fullmatch(r"et al\.?|others", name, re.I):
            continue
        if "," not in a:
            name = re.sub(r"\s+(?:[^\W\d_]\.?-?){1,3}$", "", name)
        flat = re.sub(r"[^a-z ]", "", fold(repair(name) if not name.isascii() else name)).strip()
        if flat:
            names.append(flat)
    return " ".join(sorted(names))


def first_family(authors: str | None) -> str:
    return family_names(characters(authors or "").split(";")[0])


_READ = pa.schema(
    [
        ("record_id", pa.int64()), ("eid", pa.string()), ("doi", pa.string()), ("title", pa.string()), ("page", pa.int64()),
        ("volume", pa.int64()), ("year", pa.int64()), ("families", pa.string()), ("first", pa.string()), ("source", pa.string()), ("pivots", pa.int64()),
    ]
)
_READ_DDL = (
    "record_id long, eid string, doi string, title string, page long, volume long, year long, families string, first string, source string, pivots long"
)


def _read(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        rows = []
        for rid, eid, doi, title, authors, year, source, volume, page, art in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            flat = plain(title)
            first = number(page)
            rows.append(
                (
                    rid, identifier(eid), identifier(doi), flat, first if first is not None else number(art), number(volume),
                    number(year), family_names(authors), first_family(authors), plain(source), packed(pivots(flat)),
                )
            )
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _READ, strict=True)], schema=_READ
            )


def read_records(records: DataFrame) -> DataFrame:
    """The fields that are compared, in comparable form."""
    return records.select(
        "record_id", "eid", "doi", "title", "authors", "pub_year", "source_title", "volume", "page_start", "art_no"
    ).mapInArrow(_read, _READ_DDL)


def representatives(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct records by everything compared (``n`` copies, least id), and ``record_id, rep``."""
    same = [c for c in read.columns if c not in ("record_id", "pivots")]
    content = F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in same]))
    keyed = read.withColumn("content", content)
    reps = keyed.groupBy("content").agg(F.min_by(F.struct("record_id", *same, "pivots"), "record_id").alias("r"))
    # A record without title and identifier is no copy of another such record.
    telling = (F.col("title") != "") | F.col("doi").isNotNull() | F.col("eid").isNotNull()
    copies = keyed.filter(telling).select("record_id", "content").join(reps.select("content", F.col("r.record_id").alias("rep")), "content")
    return reps.select("r.*"), copies.filter("record_id <> rep").select(F.col("rep").alias("a"), F.col("record_id").alias("b"))


def title_words(title: Column) -> Column:
    """Words of a plain title that can be anchors; a number belongs to the word before it."""
    joined = F.regexp_replace(title, "([a-z]+) ([0-9]+)", "$1$2")
    return F.array_distinct(F.filter(F.split(joined, " "), lambda x: F.length(x) >= 3))


def word_ranks(reps: DataFrame, stored_words: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """``word, rank`` of the words that are new with this batch (their count in it), and of those
    it shares with history (their stored rank, which never changes)."""
    fresh = reps.select(F.explode(title_words(F.col("title"))).alias("word")).groupBy("word").agg(F.count("*").alias("rank"))
    if stored_words is None:
        return fresh, None
    return fresh.join(stored_words, "word", "left_anti"), stored_words.join(fresh.select("word"), "word", "left_semi")


def anchors(reps: DataFrame, ranks: DataFrame) -> DataFrame:
    """The pivot-distance table of records: ``anchor, record_id, by_id, pivots, page, volume, year``,
    one row per point. ``ranks(word, rank)`` order the words of their titles."""
    base = reps.withColumn("w", title_words(F.col("title")))
    each = base.select("record_id", F.explode("w").alias("word"))
    rare = (
        each.join(ranks, "word")
        .groupBy("record_id")
        .agg(F.sort_array(F.slice(F.array_sort(F.collect_list(F.struct("rank", "word"))), 1, RAREST)["word"]).alias("r"))
    )
    hashed = lambda tag, *cols: F.xxhash64(F.lit(tag), *cols)
    # All but one of the rarest words; a title of fewer words has them all in one anchor.
    sets = F.when(
        F.size("r") == RAREST,
        F.transform("r", lambda x: hashed("w", F.array_join(F.array_remove("r", x), " "))),
    ).otherwise(F.array(hashed("w", F.array_join("r", " "))))
    from_words = F.when(F.col("r").isNotNull(), sets).otherwise(F.array().cast("array<bigint>"))
    head = F.slice(F.split("title", " "), 1, 3)
    paged, titled, led = F.col("page").isNotNull(), F.col("title") != "", F.col("first") != ""
    by_id = F.array_compact(
        F.array(F.when(F.col("eid").isNotNull(), hashed("e", "eid")), F.when(F.col("doi").isNotNull(), hashed("d", "doi")))
    )
    by_place = F.array_compact(
        F.array(
            F.when(paged & (F.col("families") != ""), hashed("c", "page", "families")),
            F.when(paged & F.col("volume").isNotNull() & led, hashed("v", "page", "volume", "first")),
            F.when(paged & F.col("year").isNotNull() & led, hashed("y", "page", "year", "first")),
            F.when(paged & F.col("year").isNotNull() & led, hashed("y", "page", F.col("year") + 1, "first")),
            F.when(F.col("volume").isNotNull() & titled, hashed("h", "volume", F.array_join(head, " "))),
        )
    )
    facts = ["record_id", "pivots", "page", "volume", "year"]
    points = base.select(*facts, by_id.alias("ids"), by_place.alias("places")).join(rare, "record_id", "left")
    of = lambda keys, flag: F.transform(F.array_distinct(keys), lambda k: F.struct(k.alias("anchor"), F.lit(flag).alias("by_id")))
    return points.select(*facts, F.inline(F.concat(of(F.col("ids"), True), of(F.concat("places", from_words), False))))


def slot(anchor: Column | str) -> Column:
    """The range of the anchor line that an anchor lies in: its highest bits."""
    bits = SLOTS.bit_length() - 1
    return (F.shiftright(anchor, 64 - bits) + SLOTS // 2).cast("int")


def blocked(batch: DataFrame, table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the key they meet by: the anchor, or for an anchor of more than ``HOT``
    points of the table a pair of blocks. A point of the batch stands once for each block of the
    table and a point of the table once for each block of the batch, so each pair meets once."""
    size = lambda df, n: df.groupBy("anchor").agg(F.count("*").alias(n))
    many = size(table, "t").filter(F.col("t") > HOT)
    hot = cut(
        many.join(size(batch, "b"), "anchor").select(
            "anchor", F.ceil(F.col("t") / HOT).cast("long").alias("t_blocks"), F.ceil(F.col("b") / HOT).cast("long").alias("b_blocks")
        ),
        "history-hot",
    )
    if hot.isEmpty():
        return batch.withColumnRenamed("anchor", "key"), table.withColumnRenamed("anchor", "key")

    def dealt(side: DataFrame, own: str, met: str, own_first: bool) -> DataFrame:
        mine = F.pmod(F.xxhash64("record_id"), F.col(own))
        others = F.sequence(F.lit(0).cast("long"), F.col(met) - 1)
        keys = F.transform(others, lambda o: F.xxhash64("anchor", *((mine, o) if own_first else (o, mine))))
        keyed = side.join(hot, "anchor", "left")
        return keyed.withColumn("key", F.explode(F.when(F.col(own).isNotNull(), keys).otherwise(F.array("anchor")))).drop(own, met, "anchor")

    return dealt(batch, "b_blocks", "t_blocks", True), dealt(table, "t_blocks", "b_blocks", False)


def candidates(batch: DataFrame, table: DataFrame) -> DataFrame:
    """``a, b``: pairs of a point of ``table`` (a) and one of ``batch`` (b) with the same first
    distance that neither the triangle inequality nor their facts rule out; each pair once.
    ``table`` holds history (``old``, if there is any) and the batch itself, of which the lesser id is ``a``."""
    left, right = blocked(batch, table)
    x, y = right.alias("x"), left.alias("y")
    a, b = F.col("x.pivots"), F.col("y.pivots")
    short, long = F.least(stored(a, 0), stored(b, 0)), F.greatest(stored(a, 0), stored(b, 0))
    bound = F.greatest(*[F.abs(stored(a, i) - stored(b, i)) for i in range(len(CLASSES) + 1)])
    titled = (stored(a, 0) > 0) & (stored(b, 0) > 0)
    differ = lambda c: F.coalesce(F.col(f"x.{c}") != F.col(f"y.{c}"), F.lit(False))
    far = F.coalesce(F.abs(F.col("x.year") - F.col("y.year")) > YEARS, F.lit(False))
    # An anchor is an identifier's for both of its points; asked of both, so that a batch that is its own
    # table is shuffled once for both sides.
    open_ = (F.col("x.by_id") & F.col("y.by_id")) | ~(differ("page") | differ("volume") | far)
    earlier = F.col("x.record_id") < F.col("y.record_id")
    return (
        x.join(y, F.col("x.key") == F.col("y.key"))
        .filter(((F.col("x.old") | earlier) if "old" in table.columns else earlier) & (~titled | (bound <= long - short + EDITS * short + 1)) & open_)
        .select(F.col("x.record_id").alias("a"), F.col("y.record_id").alias("b"))
        .distinct()
    )


#: Years of versions of one publication are at most so far apart.
YEARS = 2


def same_publication(x: dict, y: dict) -> bool:
    """The exact check of a pair of records in comparable form whose titles are near."""
    ids = (x["doi"] and x["doi"] == y["doi"]) or (x["eid"] and x["eid"] == y["eid"])
    paged = x["page"] is not None and y["page"] is not None
    page_same, page_other = paged and x["page"] == y["page"], paged and x["page"] != y["page"]
    volumes = x["volume"] is not None and y["volume"] is not None
    volume_other = volumes and x["volume"] != y["volume"]
    years = x["year"] is not None and y["year"] is not None
    year_far = years and abs(x["year"] - y["year"]) > YEARS
    authors = bool(x["families"]) and x["families"] == y["families"]
    if not x["title"] or not y["title"]:
        return bool(ids or (page_same and authors and not volume_other and not year_far))
    verdict = same_title(x["title"], y["title"])
    if verdict == "other":
        return False
    if ids:
        return verdict != "part" or page_same
    if page_other or volume_other or year_far:
        return False
    if verdict in ("part", "open"):
        return bool(page_same and (authors or volumes))
    if verdict == "cut" and not page_same:
        p, q = set(x["families"].split()), set(y["families"].split())
        return bool(volumes and p and q and 2 * len(p & q) > min(len(p), len(q)))
    if len(x["title"]) < 30:
        return bool(page_same and volumes and (authors or x["source"] == y["source"]))
    return True


def verified(pairs: DataFrame, reps: DataFrame, other: DataFrame | None = None) -> DataFrame:
    """The pairs of the same publication."""
    cols = ["eid", "doi", "title", "page", "volume", "year", "families", "source"]
    left = reps.select(F.col("record_id").alias("a"), F.struct(*cols).alias("x"))
    right = (other if other is not None else reps).select(F.col("record_id").alias("b"), F.struct(*cols).alias("y"))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            keep = [same_publication(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    ids = F.coalesce(F.col("x.doi") == F.col("y.doi"), F.lit(False)) | F.coalesce(F.col("x.eid") == F.col("y.eid"), F.lit(False))
    untitled = (F.col("x.title") == "") | (F.col("y.title") == "")
    # The true distance, where no identifier is shared: only pairs within it are aligned.
    joined = joined.filter(untitled | ids | titles_near(F.col("x.title"), F.col("y.title")))
    return joined.mapInArrow(run, "a long, b long")


def identifier_counts(reps: DataFrame, stored_ids: DataFrame | None) -> DataFrame:
    """``id, title, near, far`` of the batch's identifiers: ``title`` is one title that carries the
    identifier (the stored one, if there is one), ``near`` and ``far`` count the batch's others."""
    carried = reps.filter("title <> ''").select(F.explode(F.array_compact(F.array("eid", "doi"))).alias("id"), F.col("title").alias("t"))
    one = carried.groupBy("id").agg(F.min_by("t", F.xxhash64("t")).alias("own"))
    if stored_ids is not None:
        kept = stored_ids.filter("title is not null").groupBy("id").agg(F.min_by("title", F.xxhash64("title")).alias("kept"))
        one = one.join(kept, "id", "left").select("id", F.coalesce("kept", "own").alias("own"))
    # Only identifiers with a second title have anything to count.
    others = carried.join(one, "id").filter("t <> own").withColumn("near", titles_near(F.col("t"), F.col("own")))
    counts = others.groupBy("id").agg(F.sum(F.col("near").cast("long")).alias("near"), F.sum((~F.col("near")).cast("long")).alias("far"))
    return one.join(counts, "id", "left").select("id", F.col("own").alias("title"), F.coalesce("near", F.lit(0)).alias("near"), F.coalesce("far", F.lit(0)).alias("far"))


def without_stand_ins(reps: DataFrame, counts: DataFrame, stored_ids: DataFrame | None) -> DataFrame:
    """``reps`` without the identifiers that are stand-ins after this batch."""
    sums = counts.select("id", "near", "far")
    if stored_ids is not None:
        sums = sums.unionByName(stored_ids.join(counts.select("id"), "id", "left_semi").select("id", "near", "far"))
    bad = sums.groupBy("id").agg(F.sum("near").alias("near"), F.sum("far").alias("far")).filter("far > 1 and far > near + 1").select("id")
    bad = cut(bad, "history-stand-ins")
    if bad.isEmpty():
        return reps
    for c in ("eid", "doi"):
        marked = bad.select(F.col("id").alias(c), F.lit(True).alias("bad"))
        reps = reps.join(marked, c, "left").withColumn(c, F.when(F.col("bad").isNull(), F.col(c))).drop("bad")
    return reps


def found(records: DataFrame) -> DataFrame:
    """``first_record_id, record_id`` of every record whose publication has an earlier one: all
    batches but the last are loaded as history, then the last one is checked against them."""
    spark = records.sparkSession
    past = History(spark, f"{shared_dir(spark)}/history-{uuid.uuid4().hex}")
    last = records.agg(F.max("batch_no")).first()[0] if "batch_no" in records.columns else None
    if last is None:
        past.accept(records)
    else:
        newest = F.coalesce(F.col("batch_no") == last, F.lit(False))
        past.accept(records.filter(~newest))
        past.accept(records.filter(newest))
    return past.members().select(F.col("root").alias("first_record_id"), F.col("node").alias("record_id"))


class History:
    """Accepted records as a pivot-distance table that batches are checked against.

    ``accept(batch)`` gives ``record_id, first_record_id`` (null if the record is new) and then
    appends the batch. Stored are the points, the comparable fields, the ranks of words, the
    counts of identifiers, and of every duplicate the record it follows."""

    #: The stored tables; their schemas are fixed, as a batch may have no row for one of them.
    TABLES = {
        "points": "record_id long, pivots long, page long, volume long, year long, anchor long, by_id boolean, slot int, seq int",
        "fields": f"{_READ_DDL}, seq int", "words": "word string, rank long, seq int",
        "ids": "id string, title string, near long, far long, seq int", "roots": "node long, root long, seq int",
    }

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()), jpath

    def batches(self) -> list[int]:
        """Numbers of the accepted batches: the marks in the folder ``accepted``."""
        fs, folder = self._fs(f"{self.path}/accepted")
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(folder)) if fs.exists(folder) else []

    def _table(self, name: str) -> DataFrame | None:
        paths = [f"{self.path}/{name}/seq={n}" for n in self.batches()]
        return self.spark.read.schema(self.TABLES[name]).option("basePath", f"{self.path}/{name}").parquet(*paths) if paths else None

    def _write(self, df: DataFrame, name: str, seq: int, *parts: str) -> DataFrame:
        path = f"{self.path}/{name}/seq={seq}"
        df.write.mode("overwrite").partitionBy(*parts).parquet(path)
        # Read back with the schema at hand: an empty partitioned table has no files to tell it.
        return self.spark.read.schema(df.schema).parquet(path)

    def accept(self, batch: DataFrame) -> DataFrame:
        seq = max(self.batches(), default=0) + 1
        old = {t: self._table(t) for t in self.TABLES}
        read = cut(read_records(batch), "batch-read")
        all_reps, copies = representatives(read)
        all_reps = cut(all_reps, "batch-reps")
        counts = self._write(identifier_counts(all_reps, old["ids"]), "ids", seq)
        reps = self._write(without_stand_ins(all_reps, counts, old["ids"]), "fields", seq)
        new_words, shared = word_ranks(reps, old["words"])
        new_words = self._write(new_words, "words", seq)
        ranks = new_words if shared is None else new_words.unionByName(shared.select("word", "rank"))
        made = anchors(reps, ranks).withColumn("slot", slot("anchor"))
        points = self._write(made.repartitionByRange("anchor").sortWithinPartitions("anchor"), "points", seq, "slot")
        table, fields = points, reps
        if old["points"] is not None:
            # At most SLOTS rows. Ranges in which the batch has no point are not read.
            slots = [r["slot"] for r in points.select("slot").distinct().collect()]
            history = old["points"].filter(F.col("slot").isin(slots)).join(points.select("anchor").distinct(), "anchor", "left_semi")
            table = points.withColumn("old", F.lit(False)).unionByName(history.withColumn("old", F.lit(True)).select(*points.columns, "old"))
            fields = old["fields"].select(reps.columns).unionByName(reps)
        links = verified(cut(candidates(points, table), "batch-pairs"), fields, reps).unionByName(copies)
        first = cut(self._follow(links, read.select("record_id"), old["roots"]), "batch-roots")
        self._write(first, "roots", seq)
        result = cut(
            read.select("record_id").join(first.select(F.col("node").alias("record_id"), F.col("root").alias("first_record_id")), "record_id", "left"),
            "batch-result",
        )
        fs, mark = self._fs(f"{self.path}/accepted/{seq}")
        fs.create(mark).close()
        return result

    def _follow(self, links: DataFrame, batch: DataFrame, roots: DataFrame | None) -> DataFrame:
        """``node, root`` of the batch's duplicates, and of the first records of history that the
        links join to earlier ones."""
        links = cut(links, "batch-links")
        if roots is not None:
            up = roots.select(F.col("node").alias("a"), F.col("root").alias("next"))
            while True:
                # A step up the stored table for each time that first records were joined.
                stepped = cut(links.join(up, "a", "left"), "batch-steps")
                links = stepped.select(F.coalesce("next", "a").alias("a"), "b")
                if stepped.filter("next is not null").isEmpty():
                    break
        placed = components(links).join(batch.select(F.col("record_id").alias("node"), F.lit(True).alias("new")), "node", "left")
        # Records of history come first; then the least id.
        order = F.struct(F.coalesce("new", F.lit(False)).alias("new"), "node")
        top = placed.groupBy("root").agg(F.min(order)["node"].alias("top"))
        return placed.join(top, "root").filter("node <> top").select("node", F.col("top").alias("root"))

    def members(self) -> DataFrame:
        """``node, root`` of every duplicate accepted so far, by what is known now."""
        roots = self._table("roots")
        if roots is None:
            raise ValueError("nothing has been accepted yet")
        roots = roots.select("node", "root")
        up = roots.select(F.col("node").alias("at"), F.col("root").alias("next"))
        out = roots
        while True:
            stepped = cut(out.join(up, out["root"] == up["at"], "left"), "history-steps")
            if stepped.filter("next is not null").isEmpty():
                return stepped.select("node", "root")
            out = stepped.select("node", F.coalesce("next", "root").alias("root"))
