"""Deeply nested records to related flat tables, linked by depth-first intervals (problem 1).

Every record is a tree: the record itself, its priority claims, inventors, applicants and
citations, and below a citation its external ids. A depth-first walk gives each node a
pre-order and a post-order number; a node lies below another exactly if its interval
``[pre, post]`` is contained in the other's, i.e. ``a.pre < d.pre and d.post < a.post``.

The walk is a JVM expression: each branch becomes an array of nodes in document order,
``flatten`` joins them, and the position in that array *is* the pre-order number. With the
subtree size known where a node is made, ``post = pre + size - 1 - depth``. No shuffle and
no Python is needed, and the work per record is linear in its nodes, so a record with very
many children stays one row of one task but is never compared pairwise.

Defined cases: a null, missing, empty or blank list has no children; null elements are no
children but keep their place; an object whose fields are all null or ``N/A`` is a child; a
single object in place of a list is child 1; a list written as a JSON string is read as the
list; unreadable payloads give a record without children; repeated records are all kept.
Extra columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeforge.session import cut

#: The fields of each kind of node, in the order of its table.
NODE_FIELDS = {
    "priority_claim": ["jurisdiction", "number", "date"],
    "inventor": ["name", "residence"],
    "applicant": ["name", "residence", "type"],
    "citation": ["sequence", "text", "jurisdiction", "doc_number"],
    "external_id": ["value"],
}
KINDS = list(NODE_FIELDS)


def _node(kind: str, depth: int, place: Column, size: Column, attrs: dict[str, Column] | None) -> Column:
    parts = [
        F.lit(kind).alias("kind"),
        F.lit(depth).alias("depth"),
        place.cast("int").alias("place"),
        size.cast("int").alias("size"),
    ]
    if attrs is not None:
        pairs = [x for k, v in attrs.items() for x in (F.lit(k), v.cast("string"))]
        parts.append(F.create_map(*pairs).alias("attrs"))
    return F.struct(*parts)


def _present(nodes: Column) -> Column:
    return F.coalesce(F.filter(nodes, lambda n: n.isNotNull()), F.array())


def _leaves(items: Column, kind: str, depth: int, is_null, attrs) -> Column:
    """One node per present element; the place counts null elements too."""
    made = F.transform(
        items, lambda x, i: F.when(~is_null(x), _node(kind, depth, i + 1, F.lit(1), attrs(x) if attrs else None))
    )
    return F.filter(made, lambda n: n.isNotNull())


def _trees(items: Column, is_null, attrs, ids_of, id_is_null, id_text) -> Column:
    """Citations, each followed by its external ids, in document order."""

    def one(x, i):
        below = F.coalesce(
            _leaves(ids_of(x), "external_id", 2, id_is_null, (lambda v: {"value": id_text(v)}) if attrs else None),
            F.array().cast(_node_type(attrs is not None)),
        )
        top = _node("citation", 1, i + 1, F.size(below) + 1, attrs(x) if attrs else None)
        return F.when(~is_null(x), F.concat(F.array(top), below))

    return F.flatten(F.filter(F.transform(items, one), lambda n: n.isNotNull()))


def _node_type(attrs: bool) -> str:
    extra = ",attrs:map<string,string>" if attrs else ""
    return f"array<struct<kind:string,depth:int,place:int,size:int{extra}>>"


# --- variant payloads -------------------------------------------------------------------


def _shape(v: Column) -> Column:
    return F.schema_of_variant(v)


def _unwrap(v: Column) -> Column:
    """A JSON document written as a string is read as the document."""
    text = F.try_variant_get(v, "$", "string")
    return F.when((_shape(v) == "STRING") & text.rlike(r"^\s*[\[{]"), F.try_parse_json(text)).otherwise(v)


def _as_list(v: Column) -> Column:
    """The list at ``v``: as it is, or of the one object that stands in its place."""
    v = _unwrap(v)
    return F.when(_shape(v).startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).when(
        _shape(v).startswith("OBJECT"), F.array(v)
    )


def _get(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def _text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _v_null(x: Column) -> Column:
    return x.isNull() | F.is_variant_null(x)


def _v_ids(x: Column) -> Column:
    ids = _unwrap(_get(_unwrap(x), "$.nplcit.external_ids"))
    return F.when(_shape(ids).startswith("ARRAY"), F.try_variant_get(ids, "$", "array<variant>")).when(
        _shape(ids).isin("STRING", "BIGINT"), F.array(ids)
    )


def _party(fields: list[str]):
    def attrs(x):
        x = _unwrap(x)
        name = F.coalesce(_text(x, "$.name.name"), F.when(~_shape(_get(x, "$.name")).startswith("OBJECT"), _text(x, "$.name")))
        return {"name": name} | {f: _text(x, f"$.{f}") for f in fields}

    return attrs


def _claim(x):
    x = _unwrap(x)
    return {
        "jurisdiction": _text(x, "$.jurisdiction"),
        "number": F.coalesce(_text(x, "$.doc_number"), _text(x, "$.number")),
        "date": _text(x, "$.date"),
    }


def _v_citation(x):
    x = _unwrap(x)
    return {
        "sequence": _text(x, "$.sequence"),
        "text": _text(x, "$.nplcit.text"),
        "jurisdiction": F.coalesce(_text(x, "$.patcit.document_id.jurisdiction"), _text(x, "$.patcit.jurisdiction")),
        "doc_number": F.coalesce(_text(x, "$.patcit.document_id.doc_number"), _text(x, "$.patcit.doc_number")),
    }


def _payload_lists(payload: Column) -> dict[str, Column]:
    doc = _unwrap(F.try_parse_json(payload))
    claims = _unwrap(_get(doc, "$.biblio.priority_claims"))
    cited = _unwrap(_get(doc, "$.biblio.references_cited"))
    claim_keys = F.when(
        _shape(claims).startswith("OBJECT"),
        F.when(_shape(claims).rlike(r"[<\s]claims:"), _get(claims, "$.claims")).when(
            ~_shape(claims).rlike(r"[<\s]earliest_claim:") & (_shape(claims) != "OBJECT<>"), claims
        ),
    ).otherwise(claims)
    cite_keys = F.when(_shape(cited).startswith("OBJECT"), _get(cited, "$.citations")).otherwise(cited)
    return {
        "priority_claim": _as_list(claim_keys),
        "inventor": _as_list(_get(doc, "$.biblio.parties.inventors")),
        "applicant": _as_list(_get(doc, "$.biblio.parties.applicants")),
        "citation": _as_list(cite_keys),
    }


def _variant_nodes(lists: dict[str, Column], attrs: bool) -> list[Column]:
    keep = lambda f: f if attrs else None
    return [
        _leaves(lists["priority_claim"], "priority_claim", 1, _v_null, keep(_claim)),
        _leaves(lists["inventor"], "inventor", 1, _v_null, keep(_party(["residence"]))),
        _leaves(lists["applicant"], "applicant", 1, _v_null, keep(_party(["residence", "type"]))),
        _trees(lists["citation"], _v_null, keep(_v_citation), _v_ids, _v_null, lambda v: F.try_variant_get(v, "$", "string")),
    ]


def _column_nodes(attrs: bool) -> list[Column]:
    null = lambda x: x.isNull()

    def fields(names):
        return (lambda x: {n: x[n] for n in names}) if attrs else None

    def cite(x):
        return {
            "sequence": x["sequence"],
            "text": x["nplcit"]["text"],
            "jurisdiction": x["patcit"]["jurisdiction"],
            "doc_number": x["patcit"]["doc_number"],
        }

    return [
        _leaves(F.col("priority_claims"), "priority_claim", 1, null, fields(NODE_FIELDS["priority_claim"])),
        _leaves(F.col("inventors"), "inventor", 1, null, fields(NODE_FIELDS["inventor"])),
        _leaves(F.col("applicants"), "applicant", 1, null, fields(NODE_FIELDS["applicant"])),
        _trees(
            F.col("citations"), null, cite if attrs else None, lambda x: x["nplcit"]["external_ids"], null, lambda v: v
        ),
    ]


def label_nodes(records: DataFrame, id_col: str = "rec_id", attrs: bool = True) -> DataFrame:
    """``id_col, nodes``: per record its nodes in pre-order, each with ``kind, depth, place,
    size, pre, post`` (and ``attrs``). The record itself is the node with ``pre`` 0, left out.
    A nested column that is not null is used; the payload supplies the ones that are."""
    kind = _node_type(attrs)
    from_columns = _column_nodes(attrs)
    lists = records.withColumn("__l", F.struct(*[v.alias(k) for k, v in _payload_lists(F.col("payload")).items()]))
    from_payload = _variant_nodes({k: F.col(f"__l.{k}") for k in ("priority_claim", "inventor", "applicant", "citation")}, attrs)
    parts = [
        F.coalesce(c, F.when(F.col("payload").isNotNull(), p), F.array()).cast(kind)
        for c, p in zip(from_columns, from_payload, strict=True)
    ]
    flat = F.concat(*parts)
    labelled = F.transform(
        flat,
        lambda n, i: F.struct(
            n["kind"].alias("kind"),
            n["depth"].alias("depth"),
            n["place"].alias("place"),
            n["size"].alias("size"),
            (i + 1).alias("pre"),
            (i + 1 + n["size"] - 1 - n["depth"]).alias("post"),
            *([n["attrs"].alias("attrs")] if attrs else []),
        ),
    )
    return lists.select(F.col(id_col), labelled.alias("nodes"))


def node_tables(records: DataFrame, id_col: str = "rec_id", written: bool = False) -> dict[str, DataFrame]:
    """One flat table per kind: ``id_col, pre, post, child_no`` and the fields of the kind.
    ``written``: walk the records once, into a table that all kinds are read from."""
    nodes = label_nodes(records, id_col).select(id_col, F.explode("nodes").alias("n"))
    if written:
        nodes = cut(nodes, "nodes")
    return {
        kind: nodes.filter(F.col("n.kind") == kind).select(
            id_col,
            F.col("n.pre").alias("pre"),
            F.col("n.post").alias("post"),
            F.col("n.place").alias("child_no"),
            *[F.col("n.attrs")[f].alias(f) for f in fields],
        )
        for kind, fields in NODE_FIELDS.items()
    }


def interval_join(parents: DataFrame, children: DataFrame, id_col: str = "rec_id") -> DataFrame:
    """Children with the ``child_no`` of the node of ``parents`` whose interval contains theirs
    (``parent_no``). Equi-join on the record, so it shuffles on ``id_col`` only; within a
    record the containment condition leaves one parent per child."""
    up = parents.select(
        id_col, F.col("pre").alias("__pre"), F.col("post").alias("__post"), F.col("child_no").alias("parent_no")
    )
    inside = (F.col("__pre") < F.col("pre")) & (F.col("post") < F.col("__post"))
    return children.join(up, id_col).filter(inside).drop("__pre", "__post")


def child_rows(records: DataFrame, id_col: str = "rec_id") -> DataFrame:
    """``id_col, child_kind, parent_no, child_no``: every child with its place and its parent's.

    Containment is resolved inside the row: the descendants of a node are the ``size - 1``
    nodes after it in pre-order, so one ``slice`` per citation reads exactly its interval."""
    row = lambda n, parent: F.struct(
        n["kind"].alias("child_kind"), parent.cast("int").alias("parent_no"), n["place"].alias("child_no")
    )
    labelled = label_nodes(records, id_col, attrs=False)
    linked = F.flatten(
        F.transform(
            F.filter("nodes", lambda n: n["depth"] == 1),
            lambda n: F.concat(
                F.array(row(n, F.lit(0))),
                F.transform(F.slice(F.col("nodes"), n["pre"] + 1, n["size"] - 1), lambda d: row(d, n["place"])),
            ),
        )
    )
    return labelled.select(id_col, F.inline(linked))
