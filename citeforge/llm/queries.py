"""The queries of the training-data operators and, where SQL can express one, its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citeforge.llm import bpe, encoding, history, linkage, names, packing, spam


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return names.found(_table(spark, folder, "party_names"))


def p2_entities(spark: SparkSession, folder: str) -> DataFrame:
    """One row a name: the entity it belongs to."""
    return names.entities(_table(spark, folder, "party_names"))


#: The fields of the exports in which damaged text is looked for.
TEXT_FIELDS = ["authors", "affiliations", "title"]


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.found(_table(spark, folder, "scopus_records"), TEXT_FIELDS)


def p3_restored(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.restored(_table(spark, folder, "scopus_records"), TEXT_FIELDS)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return history.found(_table(spark, folder, "scopus_records"))


def _sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return _table(spark, folder, "scopus_records"), _table(spark, folder, "crossref_works")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return linkage.found(*_sides(spark, folder))


def p6_matches(spark: SparkSession, folder: str) -> DataFrame:
    return linkage.matches(*_sides(spark, folder))


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(_table(spark, folder, "documents"))


def p7_decoded(spark: SparkSession, folder: str) -> DataFrame:
    """Every text encoded and decoded again."""
    return bpe.decode(p7_ids(spark, folder))


def p8_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that stand in some container, once each."""
    return p8_containers(spark, folder).select("doc_id").distinct()


def p8_containers(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return spam.found(_table(spark, folder, "documents"))


QUERIES = {
    "p2_found": p2_found,
    "p2_entities": p2_entities,
    "p3_found": p3_found,
    "p3_restored": p3_restored,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p6_matches": p6_matches,
    "p7_ids": p7_ids,
    "p7_decoded": p7_decoded,
    "p8_documents": p8_documents,
    "p8_containers": p8_containers,
    "p9_found": p9_found,
}
SQL: dict[str, str] = {
    "p7_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p8_documents": "SELECT doc_id FROM documents",
}
