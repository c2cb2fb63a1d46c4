"""Bibliographic records made comparable: titles, kinds, parts, pages, identifiers.

Shared by the operators that look for records of the same publication.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeforge.llm.encoding import characters, readings
from citeforge.llm.names import distance, fold

#: Greek letters as they are spelled out (fixed values).
GREEK = dict(
    zip(
        "αβγδεζηθικλμνξοπρστυφχψω",
        "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split(),
        strict=True,
    )
)
_GREEK = str.maketrans(GREEK | {"ς": "sigma", "µ": "mu"})
_TAG = re.compile(r"<[^<>]{0,40}>")
_CHUNK = re.compile(r"[^\x00-\x20!-/:-@\[-`{-\x7f]*[^\x00-\x7f][^\x00-\x20!-/:-@\[-`{-\x7f]*")
_REPAIRED: dict[str, str] = {}

#: First words of notices about another publication, by what they are (fixed values).
NOTICES = {
    "erratum": "error", "corrigendum": "error", "correction": "error", "errata": "error", "addendum": "error", "retraction": "error",
    "comment": "comment", "comments": "comment", "commentary": "comment", "discussion": "comment",
    "reply": "reply", "response": "reply", "rejoinder": "reply",
}
_FOLLOWS = {"to", "on", "of", "from", "for", "the"}
_ROMAN = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9, "x": 10}
_PART = re.compile(r"\bpart (\d{1,2}|[ivx]{1,4})\b")
_PLACEHOLDER = re.compile(r"^(n/?a|none|null|unknown|pending|tba|-+|0*)$")


def repair(text: str) -> str:
    """Chunks that are UTF-8 read with another encoding, put right."""

    def one(m: re.Match) -> str:
        chunk = m.group()
        if chunk not in _REPAIRED:
            if len(_REPAIRED) > 200_000:
                _REPAIRED.clear()
            _REPAIRED[chunk] = next((t for c, t in readings(chunk) if c == "utf-8"), chunk)
        return _REPAIRED[chunk]

    return _CHUNK.sub(one, text)


def plain(text: str | None) -> str:
    """Lower-case words of ASCII letters and digits, one blank apart."""
    if not text:
        return ""
    text = characters(text)
    if not text.isascii():
        text = repair(text)
    if "&" in text:
        text = html.unescape(text).replace("&", " and ")
    text = _TAG.sub("", text).lower()
    if not text.isascii():
        text = fold(unicodedata.normalize("NFC", text).translate(_GREEK))
    return " ".join(re.findall(r"[a-z0-9]+", text))


def split_title(flat: str) -> tuple[list[str], str, int]:
    """Words of a plain title without notice and part, the notice, and the part's number."""
    words = flat.split()
    notice = ""
    while words:
        head = words[0]
        kind = NOTICES.get(head)
        if kind is None and len(head) >= 5 and not notice:
            kind = next((k for n, k in NOTICES.items() if abs(len(n) - len(head)) < 2 and distance(head, n, 1) <= 1), None)
        if kind is None or len(words) == 1:
            break
        notice += kind + " "
        words = words[1:]
        while words and words[0] in _FOLLOWS - {"the"}:
            words = words[1:]
        if notice.count(" ") == 2:
            break
    rest = " ".join(words)
    m = _PART.search(rest)
    part = 0
    if m:
        part = int(m[1]) if m[1].isdigit() else _ROMAN.get(m[1], 0)
        if part:
            rest = rest[: m.start()] + rest[m.end() :]
    return rest.split(), notice.strip(), part


def number(text: str | None) -> int | None:
    """The first number of a text: of a page range its first page, of ``Vol. 14`` the 14."""
    m = re.search(r"\d+", text or "")
    return int(m[0]) if m and len(m[0]) < 10 else None


def identifier(text: str | None) -> str | None:
    """A DOI or other identifier in one spelling; None for blanks and stand-ins."""
    flat = (text or "").strip().lower()
    flat = re.sub(r"^(https?://[^/]+/|doi:?\s*)", "", flat).rstrip(". ")
    if _PLACEHOLDER.match(flat) or re.search(r"(pending|unknown|none)$", flat) or not re.search(r"\d{3,}", flat):
        return None
    return flat


def alike(a: str, b: str) -> bool:
    """True if two words can be one: a typing error, an abbreviation, or cut off."""
    if a == b:
        return True
    short, long = sorted((a, b), key=len)
    if short.isdigit() or long.isdigit():
        return False
    if len(short) >= 3 and long.startswith(short):
        return True
    most = 1 if len(long) < 6 else 2 if len(long) < 11 else 3
    return len(long) >= 3 and distance(a, b, most) <= most and (a[0] == b[0] or a[-1] == b[-1])


def compare(a: list[str], b: list[str]) -> tuple[int, int, int]:
    """``(replaced, dropped, cut)`` words between two titles: words of both that stand for each
    other but are not alike, words of one that the other leaves out, and words at the end of
    one that the other, cut short, does not have."""
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    if not a or not b:
        return (0, 0, len(a) + len(b)) if j == 0 else (0, len(a) + len(b), 0)
    # Alignment by least cost: (cost, replaced, dropped) for each pair of prefixes. In titles of
    # very many words only places within ``BAND`` of the diagonal, so the work grows with the length.
    band = max(len(a), len(b)) if len(a) * len(b) <= 900 else BAND
    none = (math.inf, 0, 0)
    table = [{q: (1.0 * q, 0, q) for q in range(min(len(b), band) + 1)}]
    for p, x in enumerate(a, 1):
        last, row = table[-1], {}
        for q in range(max(0, p - band), min(len(b), p + band) + 1):
            up = last.get(q, none)
            best = (up[0] + 1, up[1], up[2] + 1)
            if q:
                y, d, left = b[q - 1], last.get(q - 1, none), row.get(q - 1, none)
                same = alike(x, y)
                best = min(
                    (d[0] + (0 if x == y else 0.2 if same else 2.5), d[1] + (not same), d[2]), best, (left[0] + 1, left[1], left[2] + 1)
                )
                if q >= 2 and x == b[q - 2] + y or q >= 2 and len(x) > 6 and distance(x, b[q - 2] + y, 2) <= 2:
                    w = last.get(q - 2, none)
                    best = min(best, (w[0] + 0.2, w[1], w[2]))
                if p >= 2 and a[p - 2] + x == y:
                    w = table[-2].get(q - 1, none)
                    best = min(best, (w[0] + 0.2, w[1], w[2]))
            row[q] = best
        table.append(row)
    full = table[-1].get(len(b), (math.inf, max(len(a), len(b)), 0))
    if j:
        return full[1], full[2], 0
    # The end of one may be missing: the best alignment of all of one with a prefix of the other.
    ends = [(table[p].get(len(b), none), len(a) - p) for p in range(1, len(a) + 1)] + [(table[-1].get(q, none), len(b) - q) for q in range(1, len(b) + 1)]
    best, rest = min(ends, key=lambda e: (e[0][0] + 0.01 * e[1], e[1]))
    if best[0] < full[0]:
        return best[1], best[2], rest
    return full[1], full[2], 0


#: Words that the alignment of two very long titles may lie off the diagonal.
BAND = 32
#: Titles of one publication differ by what one is shorter, and by this share of the shorter.
EDITS = 0.3


def titles_near(a: Column, b: Column) -> Column:
    """True if the edit distance of two titles allows for one publication: the JVM's banded
    computation, which stops at the bound. Words left out and ends cut off are part of the
    difference in length, so the bound holds for them as well."""
    short, long = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    bound = (long - short + short * F.lit(EDITS)).cast("int")
    return F.call_function("levenshtein", a, b, bound) >= 0


def same_title(a: str, b: str) -> str:
    """``equal``; ``near`` (typing errors, words left out); ``cut`` (the end of one is missing;
    ``open`` if that may have held a part number); ``part`` (only one has a part number); or
    ``other``."""
    (x, notice_a, part_a), (y, notice_b, part_b) = split_title(a), split_title(b)
    if notice_a != notice_b or (part_a and part_b and part_a != part_b):
        return "other"
    if x == y:
        return "equal" if part_a == part_b else "part"
    replaced, dropped, cut_off = compare(x, y)
    least = min(len(x), len(y))
    if replaced or dropped > 3 or dropped > least // 3 + 1 or (cut_off and least < 4):
        return "other"
    if part_a != part_b and not cut_off:
        return "part"
    if cut_off:
        return "cut" if part_a == part_b else "open"
    return "near"
