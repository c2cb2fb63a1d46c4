"""The queries of the general problems (1 and 4) and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeforge.operators import nested
from citeforge.sources import rejects


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return nested.child_rows(_table(spark, folder, "citing_patents_analysis"))


def p1_intervals(spark: SparkSession, folder: str) -> DataFrame:
    nodes = nested.label_nodes(_table(spark, folder, "citing_patents_analysis"), attrs=False)
    flat = nodes.select("rec_id", F.explode("nodes").alias("n"))
    return flat.select("rec_id", F.col("n.kind").alias("kind"), F.col("n.place").alias("child_no"), F.col("n.pre").alias("pre"), F.col("n.post").alias("post"))


def _p1_table(kind: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return nested.node_tables(_table(spark, folder, "citing_patents_analysis"))[kind]

    return run


def p1_external_ids_linked(spark: SparkSession, folder: str) -> DataFrame:
    tables = nested.node_tables(_table(spark, folder, "citing_patents_analysis"), written=True)
    return nested.interval_join(tables["citation"], tables["external_id"])


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return rejects.rejected(_table(spark, folder, "raw_lines"))


def p4_loaded(spark: SparkSession, folder: str) -> DataFrame:
    return rejects.loaded(_table(spark, folder, "raw_lines"))


QUERIES = {
    "p1_found": p1_found,
    "p1_intervals": p1_intervals,
    "p1_external_ids_linked": p1_external_ids_linked,
    **{f"p1_{kind}s": _p1_table(kind) for kind in nested.KINDS},
    "p4_found": p4_found,
    "p4_loaded": p4_loaded,
}


def _unwrapped(x: str) -> str:
    return f"CASE WHEN json_type({x}) = 'VARCHAR' AND ({x} ->> '$') LIKE '[%' THEN CAST({x} ->> '$' AS JSON) ELSE {x} END"


def _items(x: str) -> str:
    return f"CASE json_type({x}) WHEN 'ARRAY' THEN json_extract({x}, '$[*]') WHEN 'OBJECT' THEN [{x}] END"


def _p1_sql() -> str:
    from_columns, from_payload = [], []
    for kind, column, path in (
        ("priority_claim", "priority_claims", None),
        ("inventor", "inventors", "$.biblio.parties.inventors"),
        ("applicant", "applicants", "$.biblio.parties.applicants"),
        ("citation", "citations", "$.biblio.references_cited.citations"),
    ):
        from_columns.append(
            f"SELECT rec_id, '{kind}' AS child_kind, 0 AS parent_no, i AS child_no FROM (SELECT rec_id, "
            f"unnest(range(1, len({column}) + 1)) AS i, unnest({column}) AS x FROM t) WHERE x IS NOT NULL"
        )
        raw = f"json_extract(j, '{path}')" if path else (
            "CASE WHEN json_type(j, '$.biblio.priority_claims') = 'OBJECT' THEN json_extract(j, '$.biblio.priority_claims.claims') "
            "ELSE json_extract(j, '$.biblio.priority_claims') END"
        )
        from_payload.append(
            f"SELECT rec_id, '{kind}' AS child_kind, {_unwrapped('x')} AS x FROM (SELECT rec_id, {raw} AS x FROM p)"
        )
    lists = " UNION ALL ".join(from_payload)
    return f"""
WITH t AS (SELECT * FROM citing_patents_analysis),
p AS (SELECT rec_id, CAST(payload AS JSON) AS j FROM t WHERE payload IS NOT NULL),
lists AS (SELECT rec_id, child_kind, {_items('x')} AS l FROM ({lists})),
elems AS (SELECT rec_id, child_kind, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS x FROM lists),
made AS (SELECT * FROM elems WHERE json_type(x) <> 'NULL'),
ids AS (
  SELECT rec_id, i, unnest(range(1, len(l) + 1)) AS k, unnest(l) AS e
  FROM (SELECT rec_id, i, {_items("json_extract(x, '$.nplcit.external_ids')")} AS l FROM made WHERE child_kind = 'citation')),
flat_ids AS (
  SELECT rec_id, i, unnest(range(1, len(l) + 1)) AS k, unnest(l) AS e
  FROM (SELECT rec_id, i, c.nplcit.external_ids AS l
        FROM (SELECT rec_id, unnest(range(1, len(citations) + 1)) AS i, unnest(citations) AS c FROM t)))
SELECT rec_id, child_kind, CAST(parent_no AS INTEGER) AS parent_no, CAST(child_no AS INTEGER) AS child_no FROM (
  {" UNION ALL ".join(from_columns)}
  UNION ALL SELECT rec_id, 'external_id', i, k FROM flat_ids WHERE e IS NOT NULL
  UNION ALL SELECT rec_id, child_kind, 0, i FROM made
  UNION ALL SELECT rec_id, 'external_id', i, k FROM ids WHERE json_type(e) <> 'NULL')"""


_FIELD = r'(?:"(?:[^"]|"")*"|[^",\r\n]*)'
_P4 = f"""
WITH a AS (
  SELECT line_id, raw_line, raw_line IS NOT NULL AND NOT regexp_full_match(raw_line, '(?s){_FIELD}(?:,{_FIELD})*') AS broken,
    regexp_extract_all(',' || coalesce(raw_line, ''), '(?s),({_FIELD})', 1) AS parts
  FROM raw_lines),
b AS (
  SELECT line_id, raw_line, broken, list_transform(parts, lambda v: CASE WHEN v LIKE '"%' THEN replace(substr(v, 2, length(v) - 2), '""', '"') ELSE v END) AS f
  FROM a)
"""
_P4_REASON = r"""CASE WHEN raw_line IS NULL THEN 'columns' WHEN broken THEN 'quoting' WHEN len(f) <> 20 THEN 'columns'
  WHEN (f[4] <> '' AND NOT coalesce(regexp_full_match(f[4], '[0-9]{4}') AND TRY_CAST(f[4] AS INTEGER) BETWEEN 1900 AND 2030, false))
    OR NOT regexp_full_match(f[11], '[0-9]*') OR NOT regexp_full_match(f[12], '[0-9]*')
    OR regexp_matches(raw_line, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]') THEN 'value' END"""

#: A node's pre-order number is its place in the walk; post = pre + size - 1 - depth.
_P1_INTERVALS = f"""
WITH c AS ({_p1_sql()}),
w AS (SELECT *, row_number() OVER (PARTITION BY rec_id ORDER BY CASE child_kind WHEN 'priority_claim' THEN 1 WHEN 'inventor' THEN 2 WHEN 'applicant' THEN 3 ELSE 4 END,
    CASE WHEN child_kind = 'external_id' THEN parent_no ELSE child_no END, CASE WHEN child_kind = 'external_id' THEN child_no ELSE 0 END) AS pre FROM c),
s AS (SELECT rec_id, parent_no, count(*) AS n FROM c WHERE child_kind = 'external_id' GROUP BY 1, 2)
SELECT w.rec_id, child_kind AS kind, child_no, CAST(pre AS INTEGER) AS pre,
  CAST(pre + CASE WHEN child_kind = 'citation' THEN coalesce(n, 0) ELSE 0 END - CASE WHEN child_kind = 'external_id' THEN 2 ELSE 1 END AS INTEGER) AS post
FROM w LEFT JOIN s ON s.rec_id = w.rec_id AND child_kind = 'citation' AND s.parent_no = w.child_no"""

#: Every node of the two deliveries as JSON with its place, and its interval.
_TEXT = lambda x, *paths: "coalesce(" + ", ".join(f"{x} ->> '{p}'" for p in paths) + ", NULL)"
_COLUMN_OF = {"priority_claim": "priority_claims", "inventor": "inventors", "applicant": "applicants", "citation": "citations"}
_IN_COLUMNS = " UNION ALL ".join(
    f"SELECT rec_id, '{kind}' AS kind, i, to_json(x) AS x FROM (SELECT rec_id, unnest(range(1, len({c}) + 1)) AS i, unnest({c}) AS x FROM citing_patents_analysis) WHERE x IS NOT NULL"
    for kind, c in _COLUMN_OF.items()
)
_NODES = f"""places AS ({_P1_INTERVALS}),
payload AS ({_p1_sql().split("SELECT rec_id, child_kind, CAST(parent_no")[0].rstrip()} SELECT rec_id, child_kind AS kind, i, x FROM made),
payload_ids AS ({_p1_sql().split("SELECT rec_id, child_kind, CAST(parent_no")[0].rstrip()} SELECT rec_id, i, k, e ->> '$' AS value FROM ids WHERE json_type(e) <> 'NULL' UNION ALL SELECT rec_id, i, k, e FROM flat_ids WHERE e IS NOT NULL),
elements AS ({_IN_COLUMNS} UNION ALL SELECT rec_id, kind, i, x FROM payload),
nodes AS (SELECT p.*, x FROM places p JOIN elements e ON e.rec_id = p.rec_id AND e.kind = p.kind AND e.i = p.child_no AND p.kind <> 'external_id')"""
_NAME = "coalesce(x ->> '$.name.name', CASE WHEN json_type(x, '$.name') <> 'OBJECT' THEN x ->> '$.name' END)"
_FIELD_SQL = {
    "priority_claim": {"jurisdiction": _TEXT("x", "$.jurisdiction"), "number": _TEXT("x", "$.doc_number", "$.number"), "date": _TEXT("x", "$.date")},
    "inventor": {"name": _NAME, "residence": _TEXT("x", "$.residence")},
    "applicant": {"name": _NAME, "residence": _TEXT("x", "$.residence"), "type": _TEXT("x", "$.type")},
    "citation": {
        "sequence": _TEXT("x", "$.sequence"), "text": _TEXT("x", "$.nplcit.text"),
        "jurisdiction": _TEXT("x", "$.patcit.document_id.jurisdiction", "$.patcit.jurisdiction"),
        "doc_number": _TEXT("x", "$.patcit.document_id.doc_number", "$.patcit.doc_number"),
    },
}


def table_sql(kind: str) -> str:
    """A kind's flat table as a query over ``_NODES``."""
    fields = ", ".join(f"{v} AS {k}" for k, v in _FIELD_SQL[kind].items())
    return f"SELECT rec_id, pre, post, child_no, {fields} FROM nodes WHERE kind = '{kind}'"


#: External ids with their intervals: within a citation they follow it in order.
ID_TABLE = """SELECT c.rec_id, c.child_no AS parent_no, k AS child_no, value,
  c.pre + row_number() OVER (PARTITION BY c.rec_id, c.child_no ORDER BY k) AS pre FROM payload_ids v JOIN places c ON c.rec_id = v.rec_id AND c.kind = 'citation' AND c.child_no = v.i"""
NODES_SQL = f"WITH {_NODES}"

SQL = {
    **{f"p1_{kind}s": f"{NODES_SQL} {table_sql(kind)}" for kind in _FIELD_SQL},
    "p1_external_ids": f"{NODES_SQL} SELECT rec_id, CAST(pre AS INTEGER) AS pre, CAST(pre - 2 AS INTEGER) AS post, CAST(child_no AS INTEGER) AS child_no, value FROM ({ID_TABLE})",
    "p1_external_ids_linked": f"{NODES_SQL} SELECT rec_id, CAST(pre AS INTEGER) AS pre, CAST(pre - 2 AS INTEGER) AS post, CAST(child_no AS INTEGER) AS child_no, value, CAST(parent_no AS INTEGER) AS parent_no FROM ({ID_TABLE})",
    "p1_found": _p1_sql(),
    "p1_intervals": _P1_INTERVALS,
    "p4_found": f"{_P4} SELECT line_id, reason FROM (SELECT line_id, {_P4_REASON} AS reason FROM b) WHERE reason IS NOT NULL",
    "p4_loaded": f"{_P4} SELECT line_id, "
    + ", ".join(f'f[{i}] AS "{name}"' for i, name in enumerate(rejects.EXPORT_FIELDS, 1))
    + f" FROM b WHERE {_P4_REASON} IS NULL",
}
