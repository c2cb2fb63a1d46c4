"""String rules of the bibliographic model as Column expressions (survey ids in brackets).

White space is what ``str.strip`` of Python takes for it, given once as a character class, so
the same rule holds in every engine that reads the class.
"""

from __future__ import annotations

import string
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeforge.functions import col

WS = "[\t-\r\x1c-\x20\x85\xa0  -     　]"
PUNCT = string.punctuation

# The words and patterns by which fields are taken apart.
INSTITUTION_WORDS = ["university", "institute", "college", "school"]
GRANT = r"[A-Z]{2,}\s*[-\d]+|Grant\s*[#:]?\s*[\w-]+|\d{4,}"
CAS = r"\b\d{2,7}-\d{2}-\d\b"
EMAIL = r"[\w\.-]+@[\w\.-]+\.\w+"
OPEN_ACCESS_WORDS = ["open", "free", "public", "gold", "green"]
ACADEMIC_TITLES = [
    "prof", "professor", "dr", "doctor", "phd", "md", "jr", "sr", "mr", "mrs", "ms", "miss", "assoc", "assistant", "associate",
]
YEAR = r"(?U)\b(?:19|20)\d{2}\b"


def strip(c: Column | str) -> Column:
    """[STR-02] Without white space at either end."""
    return F.regexp_replace(col(c), f"^{WS}+|{WS}+$", "")


def text(c: Column | str) -> Column:
    """A missing cell reads as the empty string."""
    return F.coalesce(col(c), F.lit(""))


def blank(c: Column | str) -> Column:
    return strip(text(c)) == ""


def words(c: Column | str) -> Column:
    return F.filter(F.split(col(c), f"{WS}+"), lambda w: w != "")


def split_list(c: Column | str, sep: str = ";", longer: int = 0) -> Column:
    """[STR-01, STR-11] Items between separators, stripped, those not longer than ``longer`` left out."""
    parts = F.transform(F.split(text(c), sep), strip)
    return F.filter(parts, lambda x: F.length(x) > longer)


def canonical_author(c: Column | str) -> Column:
    """[STR-03] Lower-case words without punctuation, in code point order."""
    bare = F.lower(F.translate(col(c), PUNCT, ""))
    return F.array_join(F.array_sort(words(bare)), " ")


def normalize_keyword(c: Column | str) -> Column:
    """[STR-04] Lower case, single blanks, then without punctuation."""
    return F.translate(F.array_join(words(F.lower(col(c))), " "), PUNCT, "")


def full_author(full_names: Column | str, place: Column, short: Column) -> Column:
    """[STR-05] The written-out name at a place of the full-name list, which gives the id in
    parentheses; else the short name."""
    item = F.try_element_at(F.transform(F.split(text(full_names), ";"), strip), place)
    return F.when(F.contains(item, F.lit("(")), strip(F.substring_index(item, "(", 1))).otherwise(short)


def institution_name(c: Column | str) -> Column:
    """[STR-06] The first comma part that names an institution, else the first part if it is
    longer than three characters, else the whole."""
    parts = F.transform(F.split(col(c), ","), strip)
    named = F.filter(parts, lambda p: F.lower(p).rlike("|".join(INSTITUTION_WORDS)))
    return F.coalesce(F.try_element_at(named, F.lit(1)), F.when(F.length(parts[0]) > 3, parts[0]), strip(c))


def country(c: Column | str) -> Column:
    """[STR-07] The last comma part if it is one word of 2 to 20 letters, else empty."""
    parts = F.transform(F.split(col(c), ","), strip)
    last = F.element_at(parts, -1)
    ok = (F.size(parts) > 1) & F.length(last).between(2, 20) & last.rlike(r"^\p{L}+$")
    return F.when(ok, last).otherwise("")


def grants(c: Column | str) -> Column:
    """[STR-13] Grant numbers of a funding text."""
    return F.regexp_extract_all(text(c), F.lit(f"({GRANT})"), F.lit(1))


def agency(c: Column | str) -> Column:
    """[STR-12] The funding text without its grant numbers; null if three characters or less remain."""
    left = F.aggregate(grants(c), text(c), lambda acc, g: strip(F.replace(acc, g, F.lit(""))))
    name = strip(F.regexp_replace(left, "[,;]+$", ""))
    return F.when(F.length(name) > 3, name)


def chemical(c: Column | str) -> Column:
    """[STR-14] ``struct<chemical_name, cas_number>``."""
    number = F.regexp_extract(text(c), f"({CAS})", 1)
    name = F.when(number != "", strip(F.replace(text(c), number, F.lit("")))).otherwise(strip(text(c)))
    return F.struct(name.alias("chemical_name"), F.when(number != "", number).alias("cas_number"))


def trade_name(c: Column | str) -> Column:
    """[STR-15] ``struct<trade_name, manufacturer>``."""
    maker = F.regexp_extract(text(c), r"\(([^)]+)\)", 1)
    return F.struct(
        strip(F.regexp_replace(text(c), r"\([^)]*\)", "")).alias("trade_name"), F.when(maker != "", strip(maker)).alias("manufacturer")
    )


def correspondence(c: Column | str) -> Column:
    """[STR-16] ``struct<author_name, email, institution>``."""
    email = F.regexp_extract(text(c), f"({EMAIL})", 1)
    author = strip(F.substring_index(F.substring_index(text(c), ";", 1), ",", 1))
    rest = F.replace(text(c), author, F.lit(""))
    rest = F.when(email != "", F.replace(rest, email, F.lit(""))).otherwise(rest)
    return F.struct(
        author.alias("author_name"), F.when(email != "", email).alias("email"), strip(F.regexp_replace(strip(rest), r"^[,;]\s*", "")).alias("institution")
    )


def open_access(c: Column | str) -> Column:
    """[STR-17] True if the access type names an open form."""
    return F.lower(text(c)).rlike("|".join(OPEN_ACCESS_WORDS))


def safe_int(c: Column | str, default: int | None = None) -> Column:
    """[NUM-01] Digits only, without blanks or sign, as a number; else the default."""
    return F.when(text(c).rlike("^[0-9]+$"), text(c).try_cast("long")).otherwise(F.lit(default).cast("long"))


def year_of(c: Column | str) -> Column:
    """[DAT-01] The first year of this or the last century in a text."""
    return F.regexp_extract(text(c), YEAR, 0).try_cast("int")


def truncated(c: Column | str, n: int, mark: str = "...") -> Column:
    """[FLT-15] At most ``n`` characters, marked where cut."""
    return F.when(F.length(col(c)) > n, F.concat(F.substring(col(c), 1, n), F.lit(mark))).otherwise(col(c))


def page_range(start: Column | str, end: Column | str) -> Column:
    """[STR-21] ``start-end`` without a hyphen at either end."""
    return F.regexp_replace(F.concat(text(start), F.lit("-"), text(end)), "^-+|-+$", "")


def valid_email(c: Column | str) -> Column:
    """[STR-24]"""
    return text(c).rlike(r"@[^@]*\.")


def bar(count: Column | str, most: Column, width: int = 50) -> Column:
    """[STR-29] A bar of asterisks in proportion."""
    return F.repeat(F.lit("*"), (col(count) * F.lit(width) / most).cast("int"))


def cache_key(endpoint: Column | str, params: Column | str) -> Column:
    """[STR-26]"""
    return F.md5(F.concat_ws(":", col(endpoint), col(params)))


# --- names as patents give them: decomposition needs Unicode tables, so Arrow -------------


def ascii_only(value: str) -> str:
    return unicodedata.normalize("NFKD", value).encode("ascii", "ignore").decode()


@F.pandas_udf(T.StringType())
def ascii_form(values: pd.Series) -> pd.Series:
    """Compatibility decomposition with everything outside ASCII left out."""
    return values.map(lambda v: None if v is None else ascii_only(v))


def clean_person(c: Column | str) -> Column:
    """[STR-08] Capitalised words without titles and signs; empty if under three characters
    or without a letter."""
    return ascii_person(ascii_form(text(c)))


def ascii_person(c: Column) -> Column:
    """``clean_person`` of a name that is ASCII already: built-ins only, so lists can be mapped."""
    bare = F.transform(words(F.lower(c)), lambda w: F.regexp_replace(w, r"[^\w-]", ""))
    kept = F.filter(bare, lambda w: (w != "") & ~w.isin(ACADEMIC_TITLES))
    name = F.array_join(F.transform(kept, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1_000_000))), " ")
    return F.when((F.length(name) >= 3) & name.rlike("[A-Za-z]"), name).otherwise("")


def clean_institution(c: Column | str) -> Column:
    """[STR-09] Without article, parentheses and what follows a comma, semicolon or dash."""
    return ascii_institution(ascii_form(text(c)))


def ascii_institution(c: Column) -> Column:
    """``clean_institution`` of a name that is ASCII already."""
    bare = F.regexp_replace(strip(c), r"(?i)^(the|an|a)\s+", "")
    bare = F.regexp_replace(bare, r"\([^)]*\)", "")
    bare = F.array_join(words(F.substring_index(bare, ",", 1)), " ")
    return strip(F.substring_index(F.substring_index(bare, ";", 1), " - ", 1))


def name_variants(cleaned: Column | str, most: int = 5) -> Column:
    """[STR-10] Search forms of a cleaned name in a fixed order, the first ``most`` of them."""
    parts = words(cleaned)
    given, family = parts[0], F.element_at(parts, -1)
    initial = F.substring(given, 1, 1)
    firsts = F.array_join(F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(1))), lambda p: F.substring(p, 1, 1)), "")
    j = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x])
    forms = [
        col(cleaned), j(given, " ", family), j(family, " ", given), j(family, ", ", given), j(initial, " ", family),
        j(initial, ". ", family), j(family, " ", initial), j(family, ", ", initial), j(family, ", ", initial, "."),
        F.when(F.size(parts) > 2, j(firsts, " ", family)), F.when(F.size(parts) > 2, j(family, " ", firsts)),
    ]
    several = F.slice(
        F.filter(F.array_distinct(F.array_compact(F.array(*forms))), lambda v: (F.length(v) >= 3) & F.contains(v, F.lit(" "))), 1, most
    )
    return F.when(F.size(parts) < 1, F.array().cast("array<string>")).when(F.size(parts) < 2, F.array(col(cleaned))).otherwise(several)
