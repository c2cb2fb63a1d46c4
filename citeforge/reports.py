"""Reports from small result frames: JSON, text, HTML, CSV (survey SNK-09..14, SNK-17, SUP-01/02)."""

from __future__ import annotations

import html
import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeforge.functions.text import blank
from citeforge.operators.coverage import recovery_potential, recovery_way
from citeforge.operators.quality import breakdown, clean_key, excluded, friendly, grade, plausible_year


def rows(df: DataFrame) -> list[dict]:
    """A report frame on the driver: for aggregates only, whose size is bounded by their keys."""
    return [r.asDict(recursive=True) for r in df.collect()]


def exclusion_summary(records: DataFrame, strict: bool = False) -> list[dict]:
    shaped = breakdown(records, strict).withColumn("f", friendly()).withColumn("grade", grade(F.col("rate")))
    return rows(shaped.select("category", "excluded", "rate", "grade", "f.friendly_name", "f.impact").orderBy(F.desc("excluded"), "category"))


def recommendations(summary: list[dict], least: float = 10.0) -> list[str]:
    """[NUM-07] One line for each category above a share of the records."""
    return [f"{s['friendly_name']}: {s['rate']:.1f} % of the records; {s['impact'].lower()}" for s in summary if s["rate"] > least]


def write_json(path: str, value: object) -> None:
    Path(path).write_text(json.dumps(value, indent=2, ensure_ascii=False, default=str), encoding="utf-8")


def text_table(title: str, data: list[dict]) -> str:
    if not data:
        return f"{title}\n(no rows)\n"
    heads = list(data[0])
    cells = [[str(r[h]) if not isinstance(r[h], float) else f"{r[h]:.2f}" for h in heads] for r in data]
    widths = [max(len(h), *(len(c[i]) for c in cells)) for i, h in enumerate(heads)]
    line = lambda c: "  ".join(x.ljust(w) for x, w in zip(c, widths, strict=True)).rstrip()
    return "\n".join([title, "=" * len(title), line(heads), *map(line, cells)]) + "\n"


def html_page(title: str, sections: dict[str, list[dict]]) -> str:
    def table(data: list[dict]) -> str:
        if not data:
            return "<p>no rows</p>"
        head = "".join(f"<th>{html.escape(str(h))}</th>" for h in data[0])
        body = "".join("<tr>" + "".join(f"<td>{html.escape(str(v))}</td>" for v in r.values()) + "</tr>" for r in data)
        return f"<table><tr>{head}</tr>{body}</table>"

    parts = "".join(f"<h2>{html.escape(n)}</h2>{table(d)}" for n, d in sections.items())
    return f"<!doctype html><html><head><meta charset='utf-8'><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1>{parts}</body></html>"


def export_excluded(records: DataFrame, path: str, strict: bool = False, least: int = 10) -> None:
    """[SNK-12, SNK-13] Excluded rows as CSV, reason and category first; categories of ``least``
    rows and more again as one folder each."""
    out = excluded(records, strict)
    rest = sorted(c for c in out.columns if c not in ("reason", "category"))
    flat = out.select("reason", "category", *[F.col(c).cast("string").alias(clean_key(c)) for c in rest])
    flat.write.mode("overwrite").option("header", True).csv(f"{path}/all")
    big = flat.groupBy("category").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    flat.join(big.select("category"), "category", "left_semi").write.mode("overwrite").partitionBy("category").option("header", True).csv(f"{path}/by_category")


def write_csv(df: DataFrame, path: str) -> None:
    """[SNK-14]"""
    df.write.mode("overwrite").option("header", True).csv(path)


def enrichment_summary(metrics: dict[str, DataFrame], path: str, fmt: str = "json") -> None:
    """[SNK-17] Named aggregate frames as one JSON or text file."""
    data = {n: rows(d) for n, d in metrics.items()}
    if fmt == "json":
        write_json(path, data)
    elif fmt == "txt":
        Path(path).write_text("\n".join(text_table(n, d) for n, d in data.items()), encoding="utf-8")
    else:
        raise ValueError("format must be json or txt")


def missing_doi_report(records: DataFrame, folder: str) -> dict:
    """[PIPE-20] Records without DOI: all of them as CSV with the way in which one could be found,
    and a summary by way and year as JSON and text."""
    missing = records.filter(blank("doi"))
    write_csv(missing.select("record_id", "title", "source_title", "pub_year", "volume", "page_start", recovery_way(records).alias("way")), f"{folder}/missing_doi")
    data = {
        "ways": rows(recovery_potential(records).orderBy("way")),
        "years": rows(missing.groupBy(plausible_year("pub_year").alias("year")).agg(F.count("*").alias("records")).orderBy("year")),
    }
    write_json(f"{folder}/missing_doi.json", data)
    Path(f"{folder}/missing_doi.txt").write_text("\n".join(text_table(n, d) for n, d in data.items()), encoding="utf-8")
    return data


def citing_patents_report(flat: DataFrame, confirmed: DataFrame, path: str, doi: str) -> dict:
    """[SNK-18] What is known of the patents that cite one document, as JSON."""
    cited = flat.filter(F.lower("target_doi") == doi.lower()).join(confirmed, "rec_id")
    data = {
        "doi": doi, "patents": rows(cited.drop("rec_id", "target_doi").orderBy("lens_id")),
        "confirmed": cited.filter("citation_confirmed").count(),
    }
    write_json(path, data | {"total": len(data["patents"])})
    return data


def first_rows(log: DataFrame, order: str, most: int = 50) -> list[dict]:
    """[ORD-07] The first rows of a log, as reports show them."""
    return rows(log.orderBy(order).limit(most))


def short_list(names: list[str], most: int = 3) -> str:
    """[SUP-02] The first names and how many more there are."""
    return ", ".join(names[:most]) + (f" ... and {len(names) - most} more" if len(names) > most else "")
