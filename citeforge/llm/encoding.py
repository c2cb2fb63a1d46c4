"""Text decoded with the wrong character encoding: finding and restoring it (problem 3).

The unit is the *chunk*: a maximal run without ASCII blanks and punctuation that holds a
non-ASCII character. True words and damaged ones are both chunks, and every damaged chunk
comes from a chunk, so the counts of all chunks of all cells are the word frequencies that
a noisy-channel decoder needs. Everything costly works on the distinct chunks.

A channel is a true encoding and the one it was read with. Undoing it turns a chunk into a
byte lattice: each character gives the bytes it stands for under the wrong encoding (or its
own code where that encoding has none), a replacement character gives a wildcard for the
byte, or the character of a one-byte encoding, that was lost. Where nothing is lost there is
one path per channel. With wildcards, a known word that the channel turns into just this
chunk is taken by its frequency (the damage is done to every word once and joined by
equality), and where no word of the corpus fits, Viterbi searches the lattice for the best
path under the frequencies of neighbouring characters in the corpus's words; it is taken if
it holds ``SURE`` of the probability of all paths, otherwise the chunk stays unrestored.

A chunk is damaged if it holds a replacement or C1 control character; or if its bytes read
as plausible UTF-8 under some channel, which true text does not do by chance; or if a channel
between two one-byte encodings leads to a much more frequent chunk whose characters also
follow each other more often; or if it holds a sign that cannot stand between letters and
some channel explains it. Numeric HTML entities count
as the characters they name, so wrong characters written that way are found as well. Foreign
letters, entities of right characters and unaccented spellings leave no trace under these.

A chunk of one character (or of lost ones only) is no evidence by itself. It is decided place
by place by its neighbours: how often each candidate, the character itself among them,
stands after the same word and before the same word elsewhere, and, where no candidate does,
between the same signs (blank, hyphen, end).

Defined cases: null and empty cells have no chunks and are never found; what can't be
restored is found with its original text; long cells are read whole; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeforge.session import cut

#: What a UTF-8 text may have been read with (fixed values).
READ_AS = ["cp1252", "latin-1", "cp1250", "cp1251", "cp437", "mac_roman", "gbk", "cp850", "iso8859-2", "cp1253"]
#: Pairs of one-byte encodings, true and wrong (fixed values).
ONE_BYTE = [
    ("cp1252", "mac_roman"), ("cp1252", "cp437"), ("cp1252", "cp850"), ("cp1252", "cp1251"), ("cp1252", "cp1250"),
    ("cp1252", "cp1253"), ("mac_roman", "cp1252"), ("mac_roman", "latin-1"), ("cp437", "cp1252"), ("cp850", "cp1252"),
    ("cp850", "latin-1"), ("cp437", "latin-1"), ("cp1250", "cp1252"), ("cp1250", "latin-1"),
]
#: A one-byte reading must be this much more frequent than the chunk itself.
LEAD = 3
#: Share of the probability that a restored reading must have among all that fit.
SURE = 0.8
#: Smoothing of the counts of neighbouring characters.
PRIOR = 0.2
LOST = "�"

_ASCII_CUT = r"\x00-\x20!-/:-@\[-`{-\x7f"
#: Characters written as numeric entities belong to the chunk they stand in.
_NUMBER = r"&#[0-9]{3,5};"
CHUNK = rf"(?:[^{_ASCII_CUT}]|{_NUMBER})*(?:[^\x00-\x7f]|{_NUMBER})(?:[^{_ASCII_CUT}]|{_NUMBER})*"
_ENTITY = re.compile("&#([0-9]{3,5});")
_HARD = re.compile("[�\x80-\x9f]")
_LATIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ſ]")
_GREEK = re.compile(r"[Α-ω]")
_KNOWN = re.compile(r"[ -ſΑ-ωȘ-ț‐-…′″€™−≤≥×]")
_CASE = re.compile(r"[a-zß-öø-ÿ][A-ZÀ-ÖØ-Þ]")
#: Signs that do not stand beside a Latin letter inside a word.
_SIGN = r"[Ͱ-ΐΘΣΦπστЀ-ӿˆ-˝∀-⋿⌐─-◿ⁿ√‡‰¬¸·¯¿¡÷™ﬁﬂı]"
_ALIEN = re.compile(rf"[A-Za-z]{_SIGN}|{_SIGN}[A-Za-z]|[a-z][À-ÖØ-Þ](?![a-zß-ÿ])")


def characters(text: str) -> str:
    """Numeric entities as the characters they name."""
    return _ENTITY.sub(lambda m: chr(int(m[1])), text) if "&#" in text else text


def undo(text: str, true: str, wrong: str) -> str | None:
    """The text read again: its bytes under ``wrong``, decoded as ``true``; None if impossible."""
    raw = bytearray()
    for c in text:
        try:
            raw += c.encode(wrong)
        except UnicodeEncodeError:
            if ord(c) > 255:
                return None
            raw.append(ord(c))
    try:
        out = raw.decode(true)
    except UnicodeDecodeError:
        return None
    return out if out != text else None


def plausible(text: str) -> bool:
    """No stray signs, and no word that mixes Greek and Latin letters."""
    for i, c in enumerate(text):
        if ord(c) > 127 and not _KNOWN.match(c):
            return False
        if _GREEK.match(c) and any(_LATIN.match(x) for x in text[max(0, i - 1) : i] + text[i + 1 : i + 2]):
            return False
    return not _ALIEN.search(text)


def patched(text: str, wrong: str) -> str | None:
    """The text with those spans read again that are one UTF-8 character under ``wrong``, the
    rest kept: for chunks of which a part was damaged. None if there is no such span."""
    out, i, changed = [], 0, False
    while i < len(text):
        for n in (3, 2) if ord(text[i]) > 127 else ():
            span = text[i : i + n]
            c = undo(span, "utf-8", wrong) if len(span) == n and all(ord(x) > 127 for x in span) else None
            if c is not None and len(c) == 1 and _KNOWN.match(c):
                out.append(c)
                i, changed = i + n, True
                break
        else:
            out.append(text[i])
            i += 1
    return "".join(out) if changed else None


def readings(chunk: str) -> list[tuple[str, str]]:
    """``(channel, text)`` of every plausible path through the lattice without lost bytes."""
    chunk = characters(chunk)
    out: list[tuple[str, str]] = []
    if LOST in chunk:
        return out
    for wrong in READ_AS:
        text = undo(chunk, "utf-8", wrong)
        if text is None:
            continue
        if plausible(text):
            out.append(("utf-8", text))
        again = [undo(text, "utf-8", w) for w in ("cp1252", "latin-1")]
        out += [("utf-8", t) for t in again if t is not None and plausible(t)]
    if not out and sum(ord(c) > 127 for c in chunk) > 2:
        parts = [patched(chunk, wrong) for wrong in READ_AS]
        out += [("utf-8", t) for t in parts if t is not None and plausible(t)]
    for true, wrong in ONE_BYTE:
        text = undo(chunk, true, wrong)
        if text is not None and plausible(text) and not (_CASE.search(text) and not _CASE.search(chunk)):
            out.append(("one-byte", text))
    return list(dict.fromkeys(out))


def bytes_under(text: str, wrong: str) -> list[int | None] | None:
    """The byte lattice of a text under ``wrong``; None is a wildcard. ``ascii``: characters
    that are not lost are whole. None altogether if the encoding has no byte for a character."""
    out: list[int | None] = []
    for c in text:
        if c == LOST:
            out.append(None)
        elif wrong == "ascii":
            out += c.encode("utf-8", "replace")
        else:
            try:
                out += c.encode(wrong)
            except UnicodeEncodeError:
                if ord(c) > 255:
                    return None
                out.append(ord(c))
    return out


def damaged_forms(word: str) -> set[str]:
    """What a word becomes under the channels that lose something: every non-ASCII character or
    every byte of its UTF-8 form lost, or those bytes that the wrong encoding does not have."""
    raw = word.encode("utf-8", "replace")
    forms = {"".join(c if c < "\x80" else LOST for c in word), "".join(chr(b) if b < 128 else LOST for b in raw)}
    for wrong in READ_AS:
        text = raw.decode(wrong, "replace")
        if LOST in text:
            forms.add(text)
    return forms


class Characters:
    """Frequencies of neighbouring characters in the words of a corpus."""

    def __init__(self, pairs: dict[str, int]):
        self.pairs = pairs
        self.after: dict[str, int] = defaultdict(int)
        for p, n in pairs.items():
            self.after[p[0]] += n
        self.letters = sorted({c for p in pairs for c in p if c > "\x7f"})
        self.encoded = [(c, c.encode("utf-8", "replace")) for c in self.letters]
        self.size = len(self.letters) + 96

    def follows(self, a: str, b: str) -> float:
        """Log probability of ``b`` after ``a``; pairs of ASCII characters count for nothing."""
        if a < "\x80" and b < "\x80":
            return 0.0
        return math.log((self.pairs.get(a + b, 0) + PRIOR) / (self.after.get(a, 0) + PRIOR * self.size))

    def score(self, text: str) -> float:
        """Mean over the pairs with a non-ASCII character, so that lengths can be compared."""
        full = f"^{text}$"
        held = [self.follows(x, y) for x, y in zip(full, full[1:], strict=False) if x > "\x7f" or y > "\x7f"]
        return sum(held) / max(1, len(held))

    def viterbi(self, text: str) -> tuple[str, float] | None:
        """The best path through the lattices of a text with lost bytes, and its share of the
        probability of all paths; None if there is none."""
        best: dict[str, float] = {}
        total = 0.0
        lattices = [("chars", [None if c == LOST else c for c in text])]
        for wrong in ["ascii", *READ_AS] if any(c > "\x7f" and c != LOST for c in text) else ["ascii"]:
            lattice = bytes_under(text, wrong)
            if lattice is not None:
                lattices.append((wrong, lattice))
        for kind, slots in lattices:
            ends = self._search(slots, kind == "chars")
            if ends:
                path, top, mass = ends
                best[path] = max(best.get(path, -math.inf), top)
                total += math.exp(mass)
        if not best:
            return None
        path = max(best, key=lambda p: (best[p], p))
        return path, min(1.0, math.exp(best[path]) / total) if total else 0.0

    def _steps(self, slots: list, at: int, whole: bool):
        """``(character, slots it takes)`` that can stand at a place of a lattice."""
        if whole:
            c = slots[at]
            return [(c, 1)] if c is not None else [(x, 1) for x in self.letters]
        first = slots[at]
        if first is not None and first < 128:
            return [(chr(first), 1)]
        out = []
        for c, raw in self.encoded:
            part = slots[at : at + len(raw)]
            if len(part) == len(raw) and all(s is None or s == b for s, b in zip(part, raw, strict=True)):
                out.append((c, len(raw)))
        return out

    def _search(self, slots: list, whole: bool) -> tuple[str, float, float] | None:
        """Best path, its log probability, and that of all paths together."""
        states: list[dict[str, tuple[float, float, str]]] = [{} for _ in range(len(slots) + 1)]
        states[0]["^"] = (0.0, 0.0, "")
        for at in range(len(slots)):
            if not states[at]:
                continue
            for c, n in self._steps(slots, at, whole):
                for last, (top, mass, path) in states[at].items():
                    w = self.follows(last, c)
                    old = states[at + n].get(c)
                    if old is None:
                        states[at + n][c] = (top + w, mass + w, path + c)
                    else:
                        high, low = max(old[1], mass + w), min(old[1], mass + w)
                        summed = high + math.log1p(math.exp(low - high))
                        states[at + n][c] = (top + w, summed, path + c) if top + w > old[0] else (old[0], summed, old[2])
        ends = [(top + self.follows(c, "$"), mass + self.follows(c, "$"), path) for c, (top, mass, path) in states[-1].items()]
        if not ends:
            return None
        high = max(m for _, m, _ in ends)
        top, _, path = max(ends)
        return path, top, high + math.log(sum(math.exp(m - high) for _, m, _ in ends))


#: A chunk that its neighbours decide: one character, or lost ones only.
_LONE = rf"^(?:[^\x00-\x7f]|{LOST}+|{_NUMBER})$"


def with_places(df: DataFrame, cell: str) -> DataFrame:
    """``df`` with the cell's ``chunks``, the ``pieces`` between them, and ``places``: ``chunk, left,
    right`` of each chunk, in order; ``left`` and ``right`` of a lone chunk are the nearest words
    with the signs between, otherwise null. Columns of their own, so each pattern runs once."""
    found = F.regexp_extract_all(cell, F.lit(f"({CHUNK})"), F.lit(1))
    df = df.withColumns({"chunks": found, "pieces": F.split(cell, CHUNK, -1)})
    word, signs = rf"[^{_ASCII_CUT}]*", rf"[{_ASCII_CUT}]*"

    def side(text: Column, pattern: str) -> Column:
        return F.lower(F.regexp_extract(text, pattern, 1))

    def place(chunk: Column, i: Column) -> Column:
        # The chunks before and behind belong to the neighbours. Only their near ends are looked at.
        before = F.concat(F.coalesce(F.get("chunks", i - 1), F.lit("")), F.get("pieces", i))
        behind = F.concat(F.get("pieces", i + 1), F.coalesce(F.get("chunks", i + 1), F.lit("")))
        left, right = side(F.right(before, F.lit(60)), rf"({word}{signs})$"), side(F.left(behind, F.lit(60)), rf"^({signs}{word})")
        lone = (F.length(chunk) == 1) | chunk.rlike(_LONE)
        return F.struct(chunk.alias("chunk"), F.when(lone, left).alias("left"), F.when(lone, right).alias("right"))

    return df.withColumn("places", F.transform("chunks", place))


def _flat(records: DataFrame, fields: list[str], id_col: str) -> DataFrame:
    pairs = [F.struct(F.lit(f).alias("field_name"), F.col(f).alias("cell")) for f in fields]
    return records.select(id_col, F.inline(F.array(*pairs))).filter(F.col("cell").rlike(rf"[^\x00-\x7f]|{_NUMBER}"))


def cells(records: DataFrame, fields: list[str], id_col: str = "record_id") -> DataFrame:
    """``id_col, field_name, chunk, left, right``: the distinct chunks of every cell, lone ones
    with their neighbours; written once, so that the texts are read once."""
    placed = with_places(_flat(records, fields, id_col), "cell")
    return cut(placed.select(id_col, "field_name", F.inline(F.array_distinct("places"))), "chunk-cells")


def character_pairs(counts: DataFrame) -> DataFrame:
    """``pair, n``: neighbouring characters of the undamaged words, by the words' frequency. Only
    pairs with a character of ``_KNOWN`` (some 450) beside another or an ASCII character are
    counted, so there are at most 450 * 2 * 580 = 522,000 however large the corpus is."""
    words = counts.filter(~F.col("chunk").rlike(r"[\x{fffd}\x80-\x9f]|&#")).select(F.concat(F.lit("^"), "chunk", F.lit("$")).alias("w"), "n")
    pairs = F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substring(F.col("w"), i, F.lit(2)))
    known = _KNOWN.pattern[1:-1].replace(" -ſ", "\xa0-ſ")
    return (
        words.select(F.explode(pairs).alias("pair"), "n")
        .filter(F.col("pair").rlike(rf"[{known}]") & F.col("pair").rlike(rf"^[\x20-\x7e{known}]{{2}}$"))
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
    )


def _judge(model: Characters):
    names = ["chunk", "plain", "n", "hard", "alien", "channel", "reading", "fluent"]
    types = [pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string(), pa.string(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            cols: list[list] = [[] for _ in names]
            for chunk, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                plain = characters(chunk)
                own = None
                for channel, text in readings(chunk) or [(None, None)]:
                    fluent = True
                    if channel == "one-byte":
                        own = model.score(plain) if own is None else own
                        fluent = model.score(text) > own
                    row = (chunk, plain, n, bool(_HARD.search(plain)), bool(_ALIEN.search(plain)), channel, text, fluent)
                    for col, v in zip(cols, row, strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    return run


def _forms(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        rows = [(w, n, f) for w, n in zip(*[c.to_pylist() for c in batch.columns], strict=True) for f in sorted(damaged_forms(w))]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string()), strict=True)],
                names=["word", "n", "chunk"],
            )


def _search(model: Characters):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            chunks = batch.column(0).to_pylist()
            found = [model.viterbi(characters(c)) for c in chunks]
            kept = [f[0] if f and f[1] >= SURE and plausible(f[0]) else None for f in found]
            yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.string()), pa.array(kept, pa.string())], names=["chunk", "path"])

    return run


def verdicts(chunks: DataFrame) -> DataFrame:
    """``chunk, left, right, restored`` of every damaged chunk, of lone ones at every place
    (otherwise ``left`` and ``right`` are null); ``restored`` is null if nothing fits."""
    counts = cut(chunks.groupBy("chunk").agg(F.count("*").alias("n")), "chunk-counts")
    # At most 522,000 pairs, see there: the one table that goes to the driver and the workers.
    model = Characters({r["pair"]: r["n"] for r in character_pairs(counts).collect()})
    read = counts.mapInArrow(
        _judge(model), "chunk string, plain string, n long, hard boolean, alien boolean, channel string, reading string, fluent boolean"
    )
    read = cut(read, "chunk-readings")
    known = counts.select(F.col("chunk").alias("reading"), F.col("n").alias("known"))
    weighed = read.filter(F.col("channel").isNotNull() | F.col("hard")).join(known, "reading", "left")
    # What is written with entities is as frequent as the characters it names.
    as_read = known.select(F.col("reading").alias("plain"), F.col("known").alias("as_plain"))
    weighed = weighed.join(as_read, "plain", "left").withColumn("n", F.greatest("n", F.coalesce("as_plain", F.lit(0))))
    score = F.coalesce("known", F.lit(0))
    sure = (F.col("channel") == "utf-8") | F.col("alien") | F.col("hard")
    # A quotation mark beside a plain word needs no lead: no word ends or begins in its reading.
    quoted = F.col("reading").rlike(r"^[‘“]?[\x00-\x7f]+[’”]?$")
    led = (score >= F.when(quoted, F.col("n")).otherwise(F.greatest(F.lit(2), LEAD * F.col("n")))) & (quoted | F.col("fluent"))
    lone = F.col("chunk").rlike(_LONE)
    plain = cut(
        weighed.filter(sure | (led & ~lone))
        .groupBy("chunk")
        .agg(F.max_by("reading", F.struct(score, F.col("channel"), F.col("reading"))).alias("restored")),
        "chunk-plain",
    )
    words = counts.filter(~F.col("chunk").rlike(r"[\x{fffd}\x80-\x9f]|&#")).select(F.col("chunk").alias("word"), "n")
    lost = plain.filter(F.col("chunk").contains(LOST))
    fits = (
        words.mapInArrow(_forms, "word string, n long, chunk string")
        .join(lost.select("chunk"), "chunk")
        .groupBy("chunk")
        .agg(F.max_by("word", F.struct("n", "word")).alias("fit"), F.max("n").alias("top"), F.sum("n").alias("all"))
    )
    fits = cut(fits.select("chunk", F.when(F.col("top") >= SURE * F.col("all"), F.col("fit")).alias("fit")), "chunk-fits")
    # Several known words that fit are no reason to guess a further one.
    free = lost.filter(~lone).select("chunk").join(fits, "chunk", "left_anti")
    paths = free.mapInArrow(_search(model), "chunk string, path string")
    whole = (
        plain.join(fits, "chunk", "left")
        .join(paths, "chunk", "left")
        .filter(~(lone & F.col("chunk").contains(LOST)))
        .select("chunk", F.lit(None).cast("string").alias("left"), F.lit(None).cast("string").alias("right"), F.coalesce("restored", "fit", "path").alias("restored"))
    )
    weak = weighed.filter(led & ~sure & lone).select("chunk", F.col("reading").alias("candidate")).distinct()
    return whole.unionByName(_by_neighbours(chunks, weak, lost.filter(lone).select("chunk"), words))


def _by_neighbours(chunks: DataFrame, weak: DataFrame, lost: DataFrame, words: DataFrame) -> DataFrame:
    """The verdicts on lone chunks: ``weak`` ones, with the readings that may be meant, are
    damaged only where the neighbours say so; ``lost`` ones are damaged everywhere and restored
    where the neighbours settle by what. Candidates are single characters, so each place has few."""
    at = cut(
        chunks.filter(F.col("left").isNotNull()).groupBy("chunk", "left", "right").agg(F.count("*").alias("n")), "lone-places"
    )
    sign = lambda c: F.regexp_replace(c, rf"[^{_ASCII_CUT}]+", "")
    near = at.select("chunk", "left", "right", "n", sign("left").alias("before"), sign("right").alias("behind"))
    one = words.filter(F.length("word") == 1).mapInArrow(_forms, "word string, n long, chunk string").select("chunk", F.col("word").alias("candidate"))
    pairs = cut(weak.unionByName(one.join(lost, "chunk")).unionByName(weak.select("chunk", F.col("chunk").alias("candidate")).distinct()), "lone-candidates")
    asked = near.join(pairs, "chunk")
    for name, cols in {"l": ["left"], "r": ["right"], "s": ["before", "behind"]}.items():
        seen = near.groupBy(F.col("chunk").alias("candidate"), *cols).agg(F.sum("n").alias(name))
        asked = asked.join(seen, ["candidate", *cols], "left")
    # A place is no evidence for itself, other places with the same neighbours are.
    own = F.when(F.col("candidate") == F.col("chunk"), 1).otherwise(0)
    worded = F.coalesce("l", F.lit(0)) + F.coalesce("r", F.lit(0)) - 2 * own
    signed = F.coalesce("s", F.lit(0)) - own
    each = asked.select("chunk", "left", "right", "candidate", worded.alias("w"), signed.alias("s"))
    sums = each.groupBy("chunk", "left", "right").agg(
        F.sum("w").alias("w_all"), F.sum("s").alias("s_all"),
        F.max_by("candidate", F.struct("w", "s", "candidate")).alias("w_best"), F.max("w").alias("w"),
        F.max_by("candidate", F.struct("s", "w", "candidate")).alias("s_best"), F.max("s").alias("s"),
    )
    # One place with a neighbouring word is chance; then the signs decide.
    worded_out = F.col("w") > 1
    best = F.when(worded_out, F.col("w_best")).otherwise(F.col("s_best"))
    top, total = F.when(worded_out, F.col("w")).otherwise(F.col("s")), F.when(worded_out, F.col("w_all")).otherwise(F.col("s_all"))
    is_lost = F.col("chunk").contains(LOST)
    # Which letter was lost is for words to say; signs say only which sign it was.
    open_ = is_lost & ~worded_out & best.rlike(r"\p{L}")
    settled = F.when((top >= 2) & (top >= SURE * total) & (best != F.col("chunk")) & ~open_, best)
    decided = sums.select("chunk", "left", "right", settled.alias("restored"))
    unsettled = at.join(lost, "chunk").join(decided, ["chunk", "left", "right"], "left").select("chunk", "left", "right", "restored")
    return unsettled.unionByName(decided.filter(~is_lost & F.col("restored").isNotNull()))


def damaged_cells(records: DataFrame, fields: list[str], id_col: str = "record_id") -> DataFrame:
    """``id_col, field_name, chunk, left, right, restored``: the damaged chunks of every cell."""
    chunks = cells(records, fields, id_col)
    judged = cut(verdicts(chunks), "chunk-verdicts")
    c, j = chunks.alias("c"), judged.alias("j")
    same = (F.col("c.chunk") == F.col("j.chunk")) & (
        F.col("j.left").isNull() | ((F.col("c.left") == F.col("j.left")) & (F.col("c.right") == F.col("j.right")))
    )
    return c.join(j, same).select(f"c.{id_col}", "c.field_name", "c.chunk", "j.left", "j.right", "restored")


def found(records: DataFrame, fields: list[str], id_col: str = "record_id") -> DataFrame:
    """``id_col, field_name``: the cells that hold damaged text."""
    return damaged_cells(records, fields, id_col).select(id_col, "field_name").distinct()


def _place_key(chunk: Column, left: Column, right: Column) -> Column:
    return F.concat_ws("\x1f", chunk, left, right)


def restored(records: DataFrame, fields: list[str], id_col: str = "record_id") -> DataFrame:
    """``id_col, field_name, original, restored, complete`` of the damaged cells: the text with
    every chunk that could be restored put right, each at its place; ``complete`` if that is all."""
    repairs = (
        damaged_cells(records, fields, id_col)
        .groupBy(id_col, "field_name")
        .agg(
            F.map_from_entries(
                F.collect_set(F.struct(_place_key(F.col("chunk"), F.col("left"), F.col("right")), F.coalesce("restored", "chunk")))
            ).alias("repairs"),
            F.every(F.col("restored").isNotNull()).alias("complete"),
        )
    )
    flat = _flat(records, fields, id_col).withColumnRenamed("cell", "original")
    whole = lambda p: F.element_at("repairs", p["chunk"])
    placed = lambda p: F.element_at("repairs", _place_key(p["chunk"], p["left"], p["right"]))
    words = F.concat(F.transform("places", lambda p: F.coalesce(placed(p), whole(p), p["chunk"])), F.array(F.lit("")))
    fixed = F.array_join(F.zip_with("pieces", words, lambda piece, word: F.concat(piece, word)), "")
    return with_places(flat.join(repairs, [id_col, "field_name"]), "original").select(
        id_col, "field_name", "original", fixed.alias("restored"), "complete"
    )
