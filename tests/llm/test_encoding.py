"""Wrong decoding: damage made here is found and undone, true text is left alone."""

import itertools
import math
import random

import pytest

from citeforge.llm import encoding as e

WORDS = ["Müller", "Größe", "Ragaffção", "Hahablić", "Łódź", "Dvořák", "naïve", "l’échantillon", "‘rapid"]


@pytest.mark.parametrize("word", WORDS)
@pytest.mark.parametrize("wrong", ["cp1252", "latin-1", "cp1250", "cp1251", "cp437", "mac_roman"])
def test_undo(word, wrong):
    damaged = ""
    for b in word.encode():
        try:
            damaged += bytes([b]).decode(wrong)
        except UnicodeDecodeError:
            damaged += chr(b)
    assert e.undo(damaged, "utf-8", wrong) == word
    assert ("utf-8", word) in e.readings(damaged)


def test_true_text_has_no_utf8_reading():
    for word in [*WORDS, "AVALIAÇÃO", "SÃO", "β", "µ", "“Ω", "Åß", "Türkiye", "żywności", "…"]:
        assert not [t for c, t in e.readings(word) if c == "utf-8"], word


def test_forms_of_lost_bytes():
    assert {"M�ller", "M��ller"} <= e.damaged_forms("Müller") and "���rapid" in e.damaged_forms("‘rapid")
    assert "M�ller" not in e.damaged_forms("Miller") and "M���ller" not in e.damaged_forms("Müller")
    # 0x81 has no character in cp1252: the first byte of the letter stays, the second is lost.
    assert "Ã�gua" in e.damaged_forms("Água")


def model(words):
    pairs = {}
    for w, n in words.items():
        for x, y in zip(f"^{w}", f"{w}$", strict=True):
            if x > "\x7f" or y > "\x7f":
                pairs[x + y] = pairs.get(x + y, 0) + n
    return e.Characters(pairs)


def test_viterbi_against_all_paths():
    m = model({"Müller": 30, "Größe": 12, "Ragaffção": 20, "Łódź": 9, "naïve": 5})
    for damaged in ["Br�ller", "Br��lle", "�ódź", "xa��o", "S��o", "Ã�x"]:
        paths = {}
        whole = ["".join(w) for w in itertools.product(*[m.letters if c == e.LOST else [c] for c in damaged])]
        lattices = [whole]
        for wrong in ["ascii", *e.READ_AS] if "Ã" in damaged else ["ascii"]:
            slots = e.bytes_under(damaged, wrong)
            found = [[]]
            if slots is not None:
                lengths = range(1, len(slots) + 1)
                texts = ["".join(t) for n in lengths if n <= 7 for t in paths_of(slots, m, n)]
                found = [texts]
            lattices += found
        for texts in lattices:
            for t in texts:
                p = sum(m.follows(x, y) for x, y in zip(f"^{t}", f"{t}$", strict=True))
                paths.setdefault(t, []).append(p)
        best = max(paths, key=lambda t: (max(paths[t]), t))
        total = sum(math.exp(p) for ps in paths.values() for p in ps)
        got, share = m.viterbi(damaged)
        assert got == best and share == pytest.approx(math.exp(max(paths[best])) / total)


def paths_of(slots, m, n, at=0):
    """Every reading of a byte lattice in ``n`` characters, by plain recursion."""
    if at == len(slots) and n == 0:
        yield ()
    if at < len(slots) and n > 0:
        for c, k in m._steps(slots, at, False):
            for rest in paths_of(slots, m, n - 1, at + k):
                yield (c, *rest)


def test_planted_losses_are_restored(spark):
    """Every twentieth occurrence of a word loses its letters: of the cells restored, at least 98 %
    must be the original, and at least 80 % of all must be restored."""
    rng = random.Random(5)
    stems = ["Kalm", "Brod", "Vist", "Herg", "Sold", "Fenn", "Trav", "Munt"]
    words = [f"{a}{v}{b}" for a in stems for v, b in [("ü", "ller"), ("ö", "ping"), ("çã", "o"), ("é", "ny"), ("ñ", "eda"), ("ý", "")]]
    rows, truth = [], {}
    for i in range(3000):
        word = rng.choice(words)
        text = f"On {word} at à {rng.choice(['bas', 'haut'])} level"
        if i % 20 == 0:
            truth[i] = text
            lost = text.encode().decode("ascii", "replace") if i % 40 else "".join(c if c < "\x80" else e.LOST for c in text)
            text = lost
        rows.append((i, text))
    df = spark.createDataFrame(rows, "record_id long, title string")
    out = {r["record_id"]: r for r in e.restored(df, ["title"]).collect()}
    assert set(out) == set(truth)
    done = [i for i, r in out.items() if r["complete"]]
    assert len(done) >= 0.8 * len(truth) and sum(out[i]["restored"] == truth[i] for i in done) >= 0.98 * len(done)


def test_a_single_character_is_decided_by_its_neighbours(spark):
    rows = [(i, f"méthode à bas coût pour chose{i}") for i in range(6)] + [(10, "plug for …"), (11, "chip for …"), (12, "another …"), (13, "what …"), (14, "strip …")]
    rows += [(100 + i, f"rapid α-thing{i} and β-cyclodextrin test") for i in range(400)]
    rows += [(1000 + i, f"thing{i} – flow rate, a review") for i in range(40)]
    rows += [(2000, "things û flow rate, a review"), (2001, "a �� flow rate"), (2002, "new �-cyclodextrin chip"), (2003, "new �-unheard chip"), (2004, "seul à Paris")]
    df = spark.createDataFrame(rows, "record_id long, title string")
    out = {r["record_id"]: (r["restored"], r["complete"]) for r in e.restored(df, ["title"]).collect()}
    assert out.pop(2000) == ("things – flow rate, a review", True)
    assert out.pop(2002) == ("new β-cyclodextrin chip", True)
    assert out.pop(2001)[1] is False and out.pop(2003) == ("new �-unheard chip", False)
    assert not out


def test_tables(spark):
    clean = [(i, "Müller, J.; Łódź", None, "x" * 50 + " Ragaffção") for i in range(30)]
    rows = clean + [
        (100, "MÃ¼ller, J.", "", "A title – with a dash"),
        (101, "M�ller; Miller", None, "RagaffÃ§Ã£o &uuml; Muller"),
        (102, "Mьller", "RagaffÃƒÂ§ÃƒÂ£o", None),
        (103, "Zx�qq", None, "long " * 30_000 + "MÃ¼ller"),
        (104, "M&#195;&#188;ller", "M&#252;ller &#8211; caf&#233;", None),
    ]
    df = spark.createDataFrame(rows, "record_id long, authors string, affiliations string, title string").selectExpr("*", "'clash' as chunk")
    fields = ["authors", "affiliations", "title"]
    assert sorted(map(tuple, e.found(df, fields).collect())) == [
        (100, "authors"), (101, "authors"), (101, "title"), (102, "affiliations"), (102, "authors"), (103, "authors"), (103, "title"), (104, "authors"),
    ]
    fixed = {(r["record_id"], r["field_name"]): (r["restored"], r["complete"]) for r in e.restored(df, fields).collect()}
    assert fixed[100, "authors"] == ("Müller, J.", True) and fixed[101, "authors"] == ("Müller; Miller", True)
    assert fixed[101, "title"] == ("Ragaffção &uuml; Muller", True) and fixed[102, "authors"] == ("Müller", True)
    assert fixed[102, "affiliations"] == ("Ragaffção", True) and fixed[103, "authors"] == ("Zx�qq", False)
    assert fixed[104, "authors"] == ("Müller", True)
    assert e.found(df.limit(0), fields).count() == 0


def test_partly_damaged_chunks():
    assert ("utf-8", "l’échantillon") in e.readings("l‚Äô&#233;chantillon")
    assert ("utf-8", "Größe") in e.readings("GrÃ¶ße")
    assert e.patched("Größe", "cp1252") is None and e.patched("l’é", "mac_roman") is None
