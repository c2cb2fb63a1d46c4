"""Taking one reference string apart (survey STR-18), natively.

The rules form a cascade on the shape of the string: too short, a web document, no commas, a
standard, with a recognised journal part, or by position. Each outcome is a struct and the
first that applies is taken; the parts are computed once, in a column of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


from citeforge.functions.text import strip, text, words

# What marks a journal, a document, a book.
JOURNAL = [
    r"\bJ\b", r"\bProc\b", r"\bNature\b", r"\bScience\b", r"\bIEEE\b", r"\bACM\b", r"\bAnn\b", r"\bArch\b",
    r"\bBr\b.*\bJ\b", r"\bAm\b.*\bJ\b", r"\bInt\b.*\bJ\b", r"\bEur\b.*\bJ\b", r"\bSci\b.*\bRep\b",
    r"Surgery|Medicine|Engineering|Robotics|Manufacturing", r"Transaction|Review|Letter|HNO|BMC",
]
WEB = "[WWW Document]"
STANDARD_WORDS = ["standard", "specification", "guideline", "principles", "terminology"]
STANDARD_MARKS = ["iso ", "astm ", "standard", "specification", "guideline"]
BOOK_WORDS = ["press", "publisher", "books", "edition"]
JOURNAL_WORDS = ["journal", "proc", "lett", "rev"]
FIELDS = ["authors", "title", "journal", "volume", "issue", "pages", "year"]

_JOURNAL = "(?iU)" + "|".join(f"(?:{p})" for p in JOURNAL)


def _out(**given: Column) -> Column:
    tidy = lambda c: F.nullif(F.array_join(words(c), " "), F.lit(""))
    year = given.pop("year", F.lit(None).cast("int"))
    return F.struct(*[tidy(given[f]).alias(f) if f in given else F.lit(None).cast("string").alias(f) for f in FIELDS[:-1]], year.cast("int").alias("year"))


def _digits(c: Column) -> Column:
    return c.rlike("^[0-9]+$")


def _range(c: Column) -> Column:
    return c.rlike(r"^[0-9]+-[0-9]+$")


def _paged(c: Column) -> Column:
    return F.contains(F.lower(c), F.lit("pp."))


def _page_text(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?i)pp\.\s*", ""))


def _any_word(c: Column, listed: list[str]) -> Column:
    return F.lower(c).rlike("|".join(listed))


def parse_references(df: DataFrame, reference: str, out: str = "parsed") -> DataFrame:
    """``df`` with the struct ``out`` of authors, title, journal, volume, issue, pages, year."""
    raw = strip(text(reference))
    cut = F.regexp_replace(raw, "^,+", "")
    last_year = F.regexp_extract(cut, r"\((\d{4})\)\s*$", 1)
    any_year = F.regexp_extract(cut, r"\b((?:19|20)\d{2})\b", 1)
    body = F.when(last_year != "", F.regexp_replace(strip(F.regexp_replace(cut, r"\(\d{4}\)\s*$", "")), r"[,\s]+$", "")).otherwise(strip(cut))
    year = F.when(last_year != "", last_year).otherwise(F.nullif(any_year, F.lit("")))
    staged = df.withColumn("__raw", raw).withColumn("__body", body).withColumn("__year", year.try_cast("int"))
    staged = staged.withColumn("__p", F.filter(F.transform(F.split("__body", ","), strip), lambda x: x != ""))
    p, b, y = F.col("__p"), F.col("__body"), F.col("__year")
    n = F.size(p)
    at = lambda i: F.try_element_at(p, F.lit(i))
    # Place (from 0) of the journal part: the first that a pattern marks, else by its looks.
    marked = F.transform(p, lambda x, i: F.when((i >= 1) & ~_digits(x) & ~x.rlike(r"^pp\.|^\d+-\d+$") & x.rlike(_JOURNAL), i))
    looks = F.transform(
        p,
        lambda x, i: F.when(
            (i >= 2) & (i < 5) & (F.length(x) > 1) & ~_digits(x) & ~x.rlike(r"^pp\.|^\d+-\d+$")
            & ((F.length(x) <= 15) | (F.size(words(x)) >= 2) | _any_word(x, JOURNAL_WORDS)),
            i,
        ),
    )
    staged = staged.withColumn("__j", F.coalesce(F.array_min(marked), F.array_min(looks)))
    j = F.col("__j")
    rest = F.slice(p, j + 2, F.greatest(n - j - 1, F.lit(0)))
    numbers = lambda arr: F.filter(arr, _digits)
    pages_of = F.coalesce(
        _page_text(F.try_element_at(F.filter(rest, _paged), F.lit(-1))),
        F.try_element_at(F.filter(rest, _range), F.lit(1)),
    )
    journal_form = _out(
        authors=at(1), title=F.array_join(F.slice(p, 2, F.greatest(j - 1, F.lit(0))), ", "), journal=F.try_element_at(p, j + 1),
        volume=F.try_element_at(numbers(rest), F.lit(1)), issue=F.try_element_at(numbers(rest), F.lit(2)), pages=pages_of, year=y,
    )
    tail = F.slice(p, 4, F.greatest(n - 3, F.lit(0)))
    third = at(3)
    book = _digits(third) | (F.length(third) < 3) | _any_word(third, BOOK_WORDS)
    third_volume = F.when(_digits(third), third)
    nums = numbers(tail)
    position_form = _out(
        authors=at(1), title=at(2), journal=F.when(book, "Book/Monograph").otherwise(third),
        volume=F.coalesce(third_volume, F.try_element_at(nums, F.lit(1))),
        issue=F.try_element_at(nums, F.when(third_volume.isNotNull(), 1).otherwise(2)),
        pages=_page_text(F.try_element_at(F.filter(tail, lambda x: _paged(x) | _range(x)), F.lit(-1))), year=y,
    )
    last = F.element_at(p, -1)
    standard_form = _out(
        title=F.array_join(F.slice(p, 1, F.greatest(n - 1, F.lit(0))), ", "), journal=F.lit("Standard"), volume=F.when(_digits(last), last), year=y
    )
    no_comma = (
        F.when(_any_word(b, STANDARD_WORDS), _out(title=b, journal=F.lit("Standard/Document"), year=y))
        .when(F.size(words(b)) >= 3, _out(title=b, year=y))
        .otherwise(_out(year=y))
    )
    r = F.col("__raw")
    marks = F.lower(F.array_join(p, ", ")).rlike("|".join(STANDARD_MARKS))
    parsed = (
        F.when(F.length(r) < 3, _out())
        .when((F.length(r) < 10) & r.rlike(r"^\d{4}$"), _out(year=r.try_cast("int")))
        .when((F.length(r) < 10) & ~_digits(r), _out(title=r))
        .when(F.length(r) < 10, _out())
        .when(F.contains(b, F.lit(WEB)), _out(title=strip(F.replace(b, F.lit(WEB), F.lit(""))), journal=F.lit("Web Document"), year=y))
        .when(~F.contains(b, F.lit(",")), no_comma)
        .when(n < 2, _out(title=b, year=y))
        .when(marks, standard_form)
        .when(j >= 2, journal_form)
        .when(n >= 3, position_form)
        .otherwise(_out(authors=at(1), title=at(2), journal=F.lit("Book/Monograph"), year=y))
    )
    return staged.withColumn(out, parsed).drop("__raw", "__body", "__year", "__p", "__j")
