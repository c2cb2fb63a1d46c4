"""Variant spellings of the names of persons and organisations (problem 2).

Names are parsed to folded tokens: accents and transliterations (ue, oe, sh ...) are evened
out, titles, degrees, departments and addresses set aside, initials and abbreviations marked.

A symmetric-delete index joins every token with the tokens that share a form with up to one
(from eight letters two) characters removed; pairs within that edit distance are neighbours,
and a rare token is read as its far more frequent neighbour. Two tokens of which both are
common are different names, however close (Elena, Helena).

Names are then aligned token by token, by optimal assignment in any order: a token matches
an equal one, its typing error, a word it abbreviates, or, for persons, a nickname or an
initial. Persons known by full name form the entities; names with initials, abbreviations or
nicknames go to the one entity that their family name, middle initials and country admit, and
stay apart if several do. Organisations are the same if place or brand and kind agree and
every further word finds its counterpart; words of the kind (university, technical
university, hospital, institute, company form) count by meaning in several languages.

Entities are computed from distinct spellings and joined back; pairs of rows are made at the
end, from the entity, because all pairs of rows are the required result.

Defined cases: null and blank names belong to nobody and give no pair; equal rows are linked;
very long names are read whole; an unknown kind is treated as an organisation.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeforge.llm import graph
from citeforge.session import cut

# Titles and degrees, words of departments, kinds and company forms, nicknames.
TITLES = set("prof dr ms mr mrs miss ing dipl dipling phd md jr sr ii iii iv msc bsc dsc prof.dr".split())
DEPARTMENT = re.compile(
    r"^(dep|fac|cent|ctr|lab|sch|r ?& ?d|r and d|div|section|unit of|institute division|chair|group)\w*\b", re.I
)
KINDS = {
    "university": "uni", "univ": "uni", "universitat": "uni", "universite": "uni", "universidade": "uni", "universidad": "uni",
    "universita": "uni", "universitet": "uni", "uniwersytet": "uni", "universiteit": "uni", "u": "uni", "uni": "uni",
    "technical": "tec", "technische": "tec", "techn": "tec", "technique": "tec", "tecnica": "tec", "technological": "tec",
    "institute": "ins", "inst": "ins", "institut": "ins", "instituto": "ins", "istituto": "ins", "instytut": "ins",
    "hospital": "hos", "hosp": "hos", "klinikum": "hos", "clinic": "hos",
}
LEGAL = set("ltd inc gmbh ab sa corp co se llc plc ag kg bv nv spa srl oy as company limited corporation mbh gesellschaft incorporated pty kk aktiebolag aktiengesellschaft societe anonyme sociedad anonima societa azioni".split())
SMALL = set("of for and the de du la le des di da do der die das fur und et e y in at".split())
NICKNAMES = {
    "alex": "alexander", "sasha": "alexander alexandra", "andy": "andrew", "bea": "beatrice", "becky": "rebecca", "bella": "isabella",
    "ben": "benjamin", "beth": "elizabeth", "betty": "elizabeth", "bill": "william", "billy": "william", "bob": "robert",
    "bobby": "robert", "cathy": "catherine", "kate": "catherine katarina kateryna", "katja": "katarina kateryna", "charlie": "charles", "chuck": "charles",
    "chris": "christopher", "dan": "daniel", "danny": "daniel", "dave": "david", "debbie": "deborah", "deb": "deborah",
    "dick": "richard", "dima": "dmitri", "ed": "edward", "eddie": "edward", "ted": "edward theodore", "fran": "frances francesca",
    "frank": "francis", "fred": "frederick", "gabi": "gabriela", "greg": "gregory", "hank": "henry", "harry": "henry",
    "jack": "john", "jake": "jacob", "jenny": "jennifer", "jen": "jennifer", "jim": "james", "jimmy": "james", "joe": "joseph",
    "ken": "kenneth", "larry": "lawrence", "len": "leonard", "leo": "leonard", "liv": "olivia", "liz": "elizabeth", "lola": "dolores",
    "maggie": "margaret", "meg": "margaret", "peggy": "margaret", "matt": "matthew", "mike": "michael", "misha": "mihai michael",
    "nadya": "nadia", "natasha": "natalia", "nick": "nicholas", "pat": "patricia", "patty": "patricia", "trish": "patricia",
    "pepe": "jose", "pete": "peter", "phil": "philip", "rick": "richard", "rich": "richard", "rob": "robert", "sam": "samuel",
    "sue": "susan", "susie": "susan", "sveta": "svetlana", "terry": "theresa", "tess": "theresa", "theo": "theodore", "tom": "thomas",
    "tony": "anthony", "val": "valentina", "vicky": "victoria", "vince": "vincent", "vova": "vladimir", "wally": "walter",
    "walt": "walter", "will": "william", "zach": "zachary", "zack": "zachary", "zosia": "zofia", "wika": "wiktoria", "ollie": "oliver",
    "lucy": "lucia lucja", "ola": "olga", "steve": "steven stephen", "tim": "timothy", "drew": "andrew",
}
#: A token is read as a neighbour, one or two edits away, that is this many times as frequent.
LEAD = (8, 20)
#: An error makes up at least this part (one in ...) of the rows in which its word occurs.
OWN = 3
#: Rows of one entity that one task pairs.
BLOCK = 1000
COUNTRIES = {
    "turkey": "tr", "turkiye": "tr", "italy": "it", "italia": "it", "united states": "us", "usa": "us", "united states of america": "us",
    "china": "cn", "p.r. china": "cn", "poland": "pl", "polska": "pl", "canada": "ca", "south korea": "kr", "republic of korea": "kr",
    "korea": "kr", "india": "in", "sweden": "se", "sverige": "se", "france": "fr", "japan": "jp", "germany": "de", "deutschland": "de",
    "united kingdom": "gb", "uk": "gb", "great britain": "gb", "brazil": "br", "brasil": "br", "spain": "es", "espana": "es",
}

_SPECIAL = str.maketrans({"ø": "o", "ł": "l", "ß": "ss", "ı": "i", "đ": "d", "æ": "a", "œ": "o", "þ": "th", "ð": "d"})
_DIGRAPHS = re.compile(r"(?<=[aou])e|(?<=a)a|(?<=s)h")


def fold(text: str) -> str:
    flat = unicodedata.normalize("NFKD", text.lower().translate(_SPECIAL)).lower().translate(_SPECIAL)
    return "".join(c for c in flat if not unicodedata.combining(c))


def even(word: str) -> str:
    """Transliterated umlauts and sibilants as their plain letters."""
    return _DIGRAPHS.sub("", word)


def country_code(text: str | None) -> str | None:
    flat = fold(text or "").strip()
    if len(flat) == 2 and flat.isalpha():
        return flat
    return COUNTRIES.get(flat)


def parse_person(text: str) -> tuple[list[str], str]:
    """Long tokens (an abbreviation keeps its dot) and the initials, in order."""
    words = re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*\.?", text.replace("Dipl.-Ing.", " ").replace("M.D.", " ").replace("Ph.D.", " "))
    mixed = any(not w.isupper() and len(w.rstrip(".")) > 2 for w in words)
    long, initials = [], ""
    for w in words:
        bare = w.rstrip(".")
        flat = even(fold(bare))
        if flat in TITLES and (w.endswith(".") or flat in ("phd", "jr", "sr", "md", "dr", "prof")):
            continue
        if len(bare) == 1 or (len(bare) <= 2 and bare.isupper() and (mixed or len(words) > 1)):
            initials += fold(bare)
        elif flat:
            long.append(flat + ("." if w.endswith(".") and len(bare) <= 5 else ""))
    return long, initials


def parse_org(text: str) -> list[str]:
    """Folded tokens of the organisation itself, without departments and address."""
    text = re.sub(r"\([^)]*\)", " ", text)
    text = re.sub(r",\s*(?=(ltd|inc|gmbh|llc|co)\b)", " ", text, flags=re.I)
    parts = [p.strip() for p in re.split(r"\s*[,;/]\s*|\s+-\s+", text) if p.strip()]
    kept = [p for p in parts if not DEPARTMENT.match(fold(p))] or parts
    best, score = kept[0], -1
    for at, p in enumerate(kept):
        words = re.findall(r"[^\W\d_]+", fold(p))
        kinds = sum(1 for w in words if w in KINDS or w in LEGAL or w == "tu" or _near_kind(w))
        if kinds * 10 - at > score and (kinds or score < 0):
            best, score = p, kinds * 10 - at
    flat = re.sub(r"\b([a-z])\.(?=[a-z]\b)", r"\1", fold(best).replace("s. a.", "sa").replace("g.m.b.h", "gmbh"))
    flat = re.sub(r"\b(\w{1,3})-(?=\w)", r"\1", flat).replace("-", " ")
    out = []
    for w in re.findall(r"[^\W\d_]+\.?", flat):
        bare = w.rstrip(".")
        if bare in SMALL or bare in LEGAL:
            continue
        kind = KINDS.get(bare) or _near_kind(bare)
        if bare == "tu":
            out += ["=tec", "=uni"]
        elif kind:
            out.append("=" + kind)
        elif bare == "tech" and any(x in flat for x in ("univ", "hosp")):
            out.append("=tec")
        elif len(bare) > 3 or (len(bare) > 1 and w.endswith(".")):
            out.append(even(bare) + ("." if w.endswith(".") else ""))
    return out


_KIND_WORDS = sorted((k for k in KINDS if len(k) > 5), key=len, reverse=True)


@lru_cache(maxsize=100_000)
def _near_kind(word: str) -> str | None:
    """The kind a word is a typing error of; kept per worker, as the same words come again and again."""
    if len(word) < 6:
        return None
    return next((KINDS[k] for k in _KIND_WORDS if distance(word, k, reach(len(k))) <= reach(len(k))), None)


def distance(a: str, b: str, most: int) -> int:
    """Edit distance with transpositions, at most ``most + 1``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return last[-1]


def reach(length: int) -> int:
    """Edit distance within which tokens of a length are neighbours."""
    return 0 if length < 3 else 1 if length < 8 else 2


def deletes(token: str) -> set[str]:
    """The token with up to ``reach`` characters removed."""
    forms, edge = {token}, {token}
    for _ in range(reach(len(token))):
        edge = {t[:i] + t[i + 1 :] for t in edge for i in range(len(t))}
        forms |= edge
    return forms


def _arrow(batches: Iterator[pa.RecordBatch], make, schema: pa.Schema):
    for batch in batches:
        rows = [r for row in zip(*[c.to_pylist() for c in batch.columns], strict=True) for r in make(*row)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
            )


def _parsed(name_id, kind, text, country):
    if not text or not text.strip():
        return
    if kind == "person":
        tokens, initials = parse_person(text)
    else:
        tokens, initials = parse_org(text), ""
    if tokens or initials:
        yield name_id, kind, tokens, initials, country_code(country)


def neighbours(tokens: DataFrame) -> DataFrame:
    """``kind, token, reading, strong``: tokens and their more frequent neighbours; ``strong``
    if the lead alone settles that the token is a typing error.
    ``tokens(kind, token, n)`` are the distinct tokens."""
    schema = pa.schema([("kind", pa.string()), ("token", pa.string()), ("n", pa.int64()), ("form", pa.string())])
    long = tokens.filter((F.length("token") >= 3) & ~F.col("token").endswith(".") & ~F.col("token").startswith("="))
    forms = long.select("kind", "token", "n").mapInArrow(
        lambda b: _arrow(b, lambda k, t, n: ((k, t, n, f) for f in deletes(t)), schema), "kind string, token string, n long, form string"
    )
    forms = cut(forms, "names-deletes")
    a, b = forms.alias("a"), forms.alias("b")
    pairs = (
        a.join(b, (F.col("a.form") == F.col("b.form")) & F.col("a.kind").eqNullSafe(F.col("b.kind")))
        .filter((F.col("b.n") > F.col("a.n")) | ((F.col("b.n") == F.col("a.n")) & (F.col("b.token") > F.col("a.token"))))
        .select(F.col("a.kind").alias("kind"), F.col("a.token").alias("token"), F.col("b.token").alias("reading"), F.col("a.n").alias("m"), F.col("b.n").alias("n"))
        .distinct()
    )
    near = pa.schema(
        [("kind", pa.string()), ("token", pa.string()), ("reading", pa.string()), ("d", pa.int32()), ("m", pa.int64()), ("n", pa.int64())]
    )

    def check(k, t, r, m, n):
        most = reach(max(len(t), len(r)))
        d = distance(t, r, most)
        if d <= most and not (k == "person" and t in NICKNAMES):
            yield k, t, r, d, m, n

    kept = pairs.mapInArrow(
        lambda b: _arrow(b, check, near), "kind string, token string, reading string, d int, m long, n long"
    )
    strong = F.col("n") >= F.when(F.col("d") < 2, LEAD[0]).otherwise(LEAD[1]) * F.col("m")
    return kept.withColumn("strong", strong)


def corrections(near: DataFrame) -> DataFrame:
    """``kind, token, reading``: each typing error and the one neighbour it is read as."""
    return near.filter("strong").groupBy("kind", "token").agg(
        F.max_by("reading", F.struct(-F.col("d"), "n", "reading")).alias("reading")
    )


def spellings(names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``name_id, kind, tokens, initials, country`` with typing errors read as their neighbours,
    and the table of neighbours."""
    schema = pa.schema(
        [("name_id", pa.int64()), ("kind", pa.string()), ("tokens", pa.list_(pa.string())), ("initials", pa.string()), ("country", pa.string())]
    )
    parsed = cut(
        names.selectExpr("name_id", "name_kind", "name_text", "country").mapInArrow(
            lambda b: _arrow(b, _parsed, schema), "name_id long, kind string, tokens array<string>, initials string, country string"
        ),
        "names-parsed",
    )
    each = parsed.select("name_id", "kind", "initials", "country", F.posexplode("tokens").alias("at", "token"))
    counts = each.groupBy("kind", "token").agg(F.count("*").alias("n"))
    near = cut(neighbours(counts), "names-neighbours")
    read = corrections(near)
    fixed = (
        each.alias("e")
        .join(read.alias("r"), (F.col("e.token") == F.col("r.token")) & F.col("e.kind").eqNullSafe(F.col("r.kind")), "left")
        .select("name_id", "e.kind", "initials", "country", "at", F.coalesce("reading", "e.token").alias("token"))
        .groupBy("name_id")
        .agg(
            F.first("kind").alias("kind"),
            F.first("initials").alias("initials"),
            F.first("country").alias("country"),
            F.transform(F.array_sort(F.collect_list(F.struct("at", "token"))), lambda x: x["token"]).alias("tokens"),
        )
    )
    return cut(fixed, "names-read"), near


def replaced(forms: DataFrame, near: DataFrame) -> DataFrame:
    """``a, b`` of forms that one reading of one of their words turns into each other, with any
    further columns of ``near(token, reading)`` and of ``forms(form, words)`` (the words sorted): a
    word that is no clear error by itself is one if everything else of the name agrees."""
    swap = forms.select("form", "words", F.explode("words").alias("token")).join(near, "token")
    other = F.array_sort(F.transform("words", lambda w: F.when(w == F.col("token"), F.col("reading")).otherwise(w)))
    made = swap.select(F.col("form").alias("a"), other.alias("words"), *[c for c in near.columns if c not in ("token", "reading")])
    target = forms.select(F.col("form").alias("b"), "words", *[c for c in forms.columns if c not in ("form", "words")])
    return made.join(target, "words").filter("a <> b")


# --- persons ----------------------------------------------------------------------------


def _hints(token: str) -> list[str] | None:
    """What a given name that is not written out may begin with: None if it is written out."""
    if token.endswith("."):
        bare = token[:-1]
        return NICKNAMES[bare].split() if bare in NICKNAMES else [bare]
    if token in NICKNAMES:
        return NICKNAMES[token].split()
    return None


def _person_rows(name_id, tokens, initials, country):
    """``(name_id, full, family, hint, middle, country)``: a full name, or one row for each
    reading of a name whose given name is only hinted at."""
    full = [t for t in tokens if _hints(t) is None]
    hinted = [t for t in tokens if _hints(t) is not None]
    if len(full) >= 2:
        yield name_id, "|".join(sorted(full)), None, None, initials, country
    elif len(full) == 1 and hinted:
        for h in _hints(hinted[0]):
            yield name_id, None, full[0], h, initials, country
    elif len(full) == 1 and initials:
        yield name_id, None, full[0], initials[0], initials[1:], country
    elif tokens:
        yield name_id, "|".join(sorted(tokens)) + "?" + initials, None, None, "", country


def persons(read: DataFrame, near: DataFrame) -> DataFrame:
    """``name_id, entity``."""
    schema = pa.schema(
        [("name_id", pa.int64()), ("full", pa.string()), ("family", pa.string()), ("hint", pa.string()), ("middle", pa.string()), ("country", pa.string())]
    )
    rows = cut(
        read.filter("kind = 'person'").select("name_id", "tokens", "initials", "country").mapInArrow(
            lambda b: _arrow(b, _person_rows, schema),
            "name_id long, full string, family string, hint string, middle string, country string",
        ),
        "names-persons",
    )
    full = rows.filter(F.col("full").isNotNull()).select("name_id", F.col("full").alias("form"), "middle", "country")
    forms = full.groupBy("form").agg(
        F.split("form", "[|]").alias("words"), F.collect_set("country").alias("lands"), F.count("*").alias("n")
    )
    # A first or family name is an error only if the countries agree, if it is the rarer, if it
    # stands in hardly any other name (true names do), and if the right name is not rarer still.
    links = replaced(forms, near.filter("kind = 'person' and n >= 2 * m").select("token", "reading", "m"))
    own = forms.select(F.col("form").alias("a"), F.col("lands").alias("own"), F.col("n").alias("k"))
    agree = (F.size("own") == 0) | (F.size("lands") == 0) | F.arrays_overlap("own", "lands")
    links = links.join(own, "a").filter(agree & (F.col("m") <= OWN * F.col("k")) & (F.col("k") <= OWN * F.col("n"))).select("a", "b")
    of_form = cut(components(forms.select("form"), links), "names-forms")
    full = full.join(of_form, "form")
    # What is known of each full name: its middle initials and countries, a handful of values.
    known = full.groupBy("entity").agg(
        F.collect_set(F.when(F.col("middle") != "", F.substring("middle", 1, 1))).alias("middles"),
        F.collect_set("country").alias("countries"),
    )
    # Every spelling of an entity can be what a hint stands for.
    ends = of_form.withColumn("t", F.split("form", "[|]")).select("entity", F.explode("t").alias("family"), "t")
    ends = ends.select("entity", "family", F.explode(F.filter("t", lambda x: x != F.col("family"))).alias("given"))
    ends = ends.join(known, "entity").withColumn("i", F.substring("given", 1, 1))
    part = rows.filter(F.col("family").isNotNull()).withColumn("i", F.substring("hint", 1, 1))
    own_mid = F.substring("middle", 1, 1)
    fits_mid = (F.col("middle") == "") | (F.size("middles") == 0) | F.array_contains("middles", own_mid)
    fits_land = F.col("p.country").isNull() | (F.size("countries") == 0) | F.array_contains("countries", F.col("p.country"))
    cands = (
        part.alias("p")
        .join(ends.alias("e"), ["family", "i"])
        .filter(F.col("given").startswith(F.col("hint")) & fits_mid & fits_land)
        .select(
            "name_id",
            "entity",
            (
                F.when((F.col("middle") != "") & F.array_contains("middles", own_mid), 2).otherwise(0)
                + F.when(F.array_contains("countries", F.coalesce("p.country", F.lit(""))), 1).otherwise(0)
            ).alias("score"),
        )
        .groupBy("name_id", "entity")
        .agg(F.max("score").alias("score"))
    )
    ranked = cands.groupBy("name_id").agg(
        F.max_by("entity", F.struct("score", "entity")).alias("entity"),
        F.max("score").alias("best"),
        F.collect_list("score").alias("scores"),
    )
    sole = ranked.filter(F.size(F.filter("scores", lambda s: s == F.col("best"))) == 1).select("name_id", "entity")
    # Hinted names that no full name claims are the same if nothing tells them apart.
    rest = part.join(sole, "name_id", "left_anti").groupBy("name_id").agg(
        F.min(F.concat_ws("?", "family", "hint", "middle", F.coalesce("country", F.lit("")))).alias("entity")
    )
    return full.select("name_id", "entity").unionByName(sole).unionByName(rest).withColumn("entity", F.concat(F.lit("p:"), "entity"))


# --- organisations ----------------------------------------------------------------------


def matches(a: str, b: str) -> bool:
    """True if two words can be the same: equal, one abbreviating the other, or a typing error."""
    x, y = a.rstrip("."), b.rstrip(".")
    if x == y:
        return True
    if x[0] != y[0] and len(x) != len(y):
        return False
    short, long = sorted((x, y), key=len)
    dotted = (a if len(x) < len(y) else b).endswith(".")
    if long.startswith(short) and (dotted or len(short) >= 4 or len(long) - len(short) <= 1):
        return True
    return distance(x, y, reach(len(short))) <= reach(len(short)) and len(short) >= 5


def aligned(a: list[str], b: list[str]) -> bool:
    """True if an assignment exists under which every word of both has its counterpart: a perfect
    matching, found by augmenting paths."""
    if len(a) != len(b):
        return False
    fits = [[j for j, y in enumerate(b) if matches(x, y)] for x in a]
    owner: dict[int, int] = {}

    def place(i: int, tried: set[int]) -> bool:
        for j in fits[i]:
            if j not in tried:
                tried.add(j)
                if j not in owner or place(owner[j], tried):
                    owner[j] = i
                    return True
        return False

    return all(place(i, set()) for i in range(len(a)))


def _org_rows(name_id, tokens):
    kinds = "".join(sorted({t for t in tokens if t.startswith("=")}))
    words = sorted({t for t in tokens if not t.startswith("=")})
    if words or kinds:
        yield name_id, kinds, words


def orgs(read: DataFrame, near: DataFrame) -> DataFrame:
    """``name_id, entity``."""
    schema = pa.schema([("name_id", pa.int64()), ("kinds", pa.string()), ("words", pa.list_(pa.string()))])
    rows = read.filter("kind is null or kind <> 'person'").select("name_id", "tokens").mapInArrow(
        lambda b: _arrow(b, _org_rows, schema), "name_id long, kinds string, words array<string>"
    )
    rows = rows.withColumn("form", F.concat_ws(" ", "kinds", F.array_join("words", " ")))
    rows = cut(rows, "names-orgs")
    forms = rows.groupBy("form", "kinds").agg(F.first("words").alias("words"), F.count("*").alias("n"))
    # Abbreviation keeps the first letters of a word, so forms that can be aligned agree in the
    # first three letters of all their words; errors in those are left to the index.
    heads = F.array_join(F.array_sort(F.transform("words", lambda w: F.substring(w, 1, 3))), "|")
    keyed = cut(forms.select("form", "kinds", "words", heads.alias("heads")), "names-heads")
    pair = pa.schema([("a", pa.string()), ("b", pa.string())])
    links = (
        keyed.alias("x")
        .join(keyed.alias("y"), ["heads", "kinds"])
        .filter(F.col("x.form") < F.col("y.form"))
        .select("x.form", "x.words", "y.form", "y.words")
        .toDF("fa", "wa", "fb", "wb")
        .mapInArrow(lambda b: _arrow(b, lambda fa, wa, fb, wb: [(fa, fb)] if aligned(wa, wb) else [], pair), "a string, b string")
    )
    errors = replaced(
        forms.select(F.col("form"), F.concat(F.array("kinds"), "words").alias("words")),
        near.filter("kind is null or kind <> 'person'").select("token", "reading"),
    )
    links = links.unionByName(errors.select("a", "b")).distinct()
    entity = components(forms.select("form"), links)
    return rows.join(entity, "form").select("name_id", F.concat(F.lit("o:"), "entity").alias("entity"))


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``form, entity``: the least form that a form is linked with, itself if with none."""
    roots = graph.components(links)
    return nodes.join(roots, nodes["form"] == roots["node"], "left").select("form", F.coalesce("root", "form").alias("entity"))


def entities(names: DataFrame) -> DataFrame:
    """``name_id, entity`` of every name."""
    read, near = spellings(names)
    return persons(read, near).unionByName(orgs(read, near))


def found(names: DataFrame) -> DataFrame:
    """``name_id_a, name_id_b``: all pairs of rows with the same entity, the smaller id first.

    The rows of an entity are dealt into blocks of about ``BLOCK`` that all meet, so an entity of
    very many rows is paired by as many tasks. Where the pairs are too many to be wanted,
    ``entities`` says the same in one row a name."""
    of = cut(entities(names), "names-entities")
    sizes = of.groupBy("entity").agg(F.count("*").alias("k")).filter("k > 1")
    dealt = of.join(sizes.select("entity", F.ceil(F.col("k") / BLOCK).cast("long").alias("blocks")), "entity")
    mine = F.pmod(F.xxhash64("name_id"), F.col("blocks"))
    a = dealt.select(F.col("name_id").alias("name_id_a"), "entity", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("met"), mine.alias("own"))
    b = dealt.select(F.col("name_id").alias("name_id_b"), "entity", mine.alias("met"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("own"))
    return a.join(b, ["entity", "met", "own"]).filter("name_id_a < name_id_b").select("name_id_a", "name_id_b")
