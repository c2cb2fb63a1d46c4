"""The tokenization automaton against a public encoder of the same vocabulary, and round trips."""

import random

import pytest

from citeforge.llm import bpe

PIECES = ["a", "aa", "the ", "  ", "\n", "1", "é", "日", "👍", "\x1c", "\xa0", "²", "Ⅷ", "́", "\x00", "<|endoftext|>", "'s", "'ll", "---", "====", "_", "ß", "٣", "​", "\x85", "ing", "\t"]


@pytest.fixture(scope="module")
def automaton():
    return bpe.automaton()


@pytest.fixture(scope="module")
def public():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(bpe.vocabulary_path())
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids


def test_decoded_frames(spark):
    texts = ["", None, "naïve “Größe” 河水\t\n  two", "x" * 5000, "\U0001f600 \x00"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    back = {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(docs)).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {tuple(r) for r in bpe.decode(nulls).collect()} == {(1, None), (2, "")}


def test_equals_public_encoder(automaton, public):
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 40)))
        assert automaton.encode(text) == public(text)
    for _ in range(2000):
        text = "".join(rng.choice("abcdeirstnolh") for _ in range(rng.randint(1, 50)))
        assert automaton.encode(text) == public(text)


def test_long_word_and_round_trip(automaton, public):
    text = "a" * 20_000 + "=" * 5_000 + "日本" * 2_000
    ids = automaton.encode(text)
    assert ids == public(text) and automaton.decode(ids) == text and automaton.count(text) == len(ids)


def test_merge_gadgets_on_a_small_list():
    # Overlapping merges: the leftmost pair goes first.
    a = bpe.Automaton([(b"a", b"a"), (b"aa", b"a")], {b"a": 0, b"aa": 1, b"aaa": 2})
    assert a.word(b"aaa") == (2,) and a.word(b"aaaa") == (1, 1) and a.word(b"aaaaa") == (1, 2)


def test_table(spark):
    rows = [(1, "Hello world", "x"), (2, "", None), (3, None, None), (4, "Hello world", "y"), (5, "long " * 50_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {r["doc_id"]: r["ids"] for r in bpe.encode(docs).collect()}
    assert got[1] == got[4] == [15496, 995] and got[2] == [] and got[3] == [] and len(got[5]) >= 50_000
    sizes = {r["doc_id"]: r["n_tokens"] for r in bpe.measure(docs).collect()}
    assert sizes == {k: len(v) for k, v in got.items()}
    assert bpe.encode(docs.limit(0)).count() == 0
