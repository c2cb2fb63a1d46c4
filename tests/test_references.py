"""The cascade of the reference parser, one case per outcome."""

import pytest

from citeforge.functions.references import parse_references

CASES = {
    "": {},
    "ab": {},
    "2019": {"year": 2019},
    "short": {"title": "short"},
    "Reference 1": {},
    "Results for Hr [WWW Document], (2014)": {"title": "Results for Hr", "journal": "Web Document", "year": 2014},
    "General guideline of tests 2001": {"title": "General guideline of tests 2001", "journal": "Standard/Document", "year": 2001},
    "Some three words": {"title": "Some three words"},
    "ISO 13485, quality, 12": {"title": "ISO 13485, quality", "journal": "Standard", "volume": "12"},
    "Smith, J., Title, Journal X, 12, 3, pp. 4-5, (2020)": {
        "authors": "Smith", "title": "J.", "journal": "Title", "volume": "12", "issue": "3", "pages": "4-5", "year": 2020,
    },
    "Smith A, A long title of work, IEEE Trans, 12, 3, pp. 4-5, (2020)": {
        "authors": "Smith A", "title": "A long title of work", "journal": "IEEE Trans", "volume": "12", "issue": "3", "pages": "4-5", "year": 2020,
    },
    "Smith A, A title, more of it, Nature, 7, 10-12": {
        "authors": "Smith A", "title": "A title, more of it", "journal": "Nature", "volume": "7", "pages": "10-12",
    },
    "Smith A, Any book": {"authors": "Smith A", "title": "Any book", "journal": "Book/Monograph"},
    "Smith A, J. B, Big Press, (1999)": {"authors": "Smith A", "title": "J. B", "journal": "Book/Monograph", "year": 1999},
}


@pytest.fixture(scope="module")
def parsed(spark):
    rows = spark.createDataFrame([(r,) for r in [*CASES, None]], "reference string")
    return {r["reference"]: r["parsed"].asDict() for r in parse_references(rows, "reference").collect()}


@pytest.mark.parametrize("reference", list(CASES))
def test_case(parsed, reference):
    assert {k: v for k, v in parsed[reference].items() if v is not None} == CASES[reference]


def test_null(parsed):
    assert all(v is None for v in parsed[None].values())
