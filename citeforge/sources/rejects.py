"""Loading delimited records and separating the ones that fail, with the reason (problem 4).

Records are taken in blocks. A block is parsed as a whole by Arrow's columnar CSV reader; it
counts as good only if one scan of a strict RFC 4180 grammar accepts the whole block, every
record comes back as exactly one row (each carries its own number as a sentinel last field,
so records that merge or fall apart can't cancel out) and the vectorised value checks hold.
A block that fails is bisected until the bad records stand alone, and those are diagnosed
strictly, one by one, by the grammar itself. Rows never leave their partition: no shuffle.

Reasons: ``quoting`` (not a well-formed record), else ``columns`` (another field count), else
``value`` (Year, Page count, Cited by, or a control character).

Defined cases: a null line is a record that can't be loaded (``columns``), as is an empty one
(one empty field); very long lines are one block each if need be; repeated lines are judged
each for itself; extra input columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: The header of the exports, in file order (fixed values).
EXPORT_FIELDS = [
    "Authors", "Author(s) ID", "Title", "Year", "Source title", "Volume", "Issue", "Art. No.",
    "Page start", "Page end", "Page count", "Cited by", "DOI", "Affiliations", "Abstract",
    "Author Keywords", "Index Keywords", "References", "Source", "EID",
]
YEARS = (1900, 2030)
BLOCK_RECORDS = 256

_FIELD = r'(?:"(?:[^"]++|"")*+"|[^",\r\n]*+)'
#: A whole record, for ``rlike``.
WELL_FORMED = rf"(?s)\A{_FIELD}(?:,{_FIELD})*+[\r\n]*\z"
_RECORD = re.compile(rf"{_FIELD}(?:,{_FIELD})*+\Z")
_PARTS = re.compile(rf"(?:\A|,)({_FIELD})")
_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
_YEAR = re.compile(r"[0-9]{4}\Z")
_DIGITS = re.compile(r"[0-9]*\Z")


class Layout:
    """What a good record looks like: its fields and the ones that must be numbers."""

    def __init__(self, fields: list[str], year: str = "Year", counts: tuple[str, ...] = ("Page count", "Cited by")):
        self.fields = fields
        self.width = len(fields)
        self.year = fields.index(year)
        self.counts = [fields.index(c) for c in counts]
        row = rf"{_FIELD}(?:,{_FIELD}){{{self.width}}}+\n"
        self.block = re.compile(rf"(?:{row})*+\Z")
        self.read = pacsv.ParseOptions(newlines_in_values=True, ignore_empty_lines=False)
        names = [f"c{i}" for i in range(self.width + 1)]
        self.names = names
        self.convert = pacsv.ConvertOptions(
            column_types={n: pa.large_string() for n in names}, strings_can_be_null=False, check_utf8=False
        )

    def bulk(self, lines: list[str | None]) -> pa.Table | None:
        """The block's columns if all its records are good, else None."""
        if any(x is None for x in lines):
            return None
        block = "".join([f"{x},{i}\n" for i, x in enumerate(lines)])
        if not self.block.match(block) or _CONTROL.search(block):
            return None
        raw = block.encode("utf-8", "surrogatepass")
        try:
            table = pacsv.read_csv(
                pa.BufferReader(raw),
                read_options=pacsv.ReadOptions(column_names=self.names, block_size=len(raw) + 1024, use_threads=False),
                parse_options=self.read,
                convert_options=self.convert,
            )
        except pa.ArrowInvalid:
            return None
        if table.num_rows != len(lines) or table.column(self.width).to_pylist() != [str(i) for i in range(len(lines))]:
            return None
        years = table.column(self.year)
        fits = pc.or_(pc.equal(years, ""), pc.match_substring_regex(years, r"^[0-9]{4}$"))
        if not pc.all(fits, min_count=0).as_py():
            return None
        given = pc.cast(pc.filter(years, pc.not_equal(years, "")), pa.int32())
        if len(given) and (pc.min(given).as_py() < YEARS[0] or pc.max(given).as_py() > YEARS[1]):
            return None
        for k in self.counts:
            if not pc.all(pc.match_substring_regex(table.column(k), r"^[0-9]*$"), min_count=0).as_py():
                return None
        return table.drop_columns([self.names[-1]])

    def diagnose(self, line: str | None) -> str | None:
        """The reason why a record fails, None if it loads."""
        if line is None:
            return "columns"
        if not _RECORD.match(line):
            return "quoting"
        parts = _PARTS.findall(line)
        if len(parts) != self.width:
            return "columns"
        values = [p[1:-1].replace('""', '"') if p[:1] == '"' else p for p in parts]
        year = values[self.year]
        if year and not (_YEAR.match(year) and YEARS[0] <= int(year) <= YEARS[1]):
            return "value"
        if any(not _DIGITS.match(values[k]) for k in self.counts) or any(map(_CONTROL.search, values)):
            return "value"
        return None

    def strict(self, line: str) -> pa.Table:
        """The columns of one good record, by the grammar alone."""
        values = [p[1:-1].replace('""', '"') if p[:1] == '"' else p for p in _PARTS.findall(line)]
        return pa.table([pa.array([v], pa.large_string()) for v in values], names=self.names[:-1])

    def split(self, lines: list[str | None], at: int = 0) -> Iterator[tuple[int, pa.Table | str, int]]:
        """``(offset, columns, n)`` of good runs and ``(offset, reason, 1)`` of bad records."""
        table = self.bulk(lines) if lines else None
        if table is not None:
            yield at, table, len(lines)
        elif len(lines) == 1:
            reason = self.diagnose(lines[0])
            # A record that the grammar accepts loads, whatever the fast path makes of it.
            yield (at, reason, 1) if reason else (at, self.strict(lines[0]), 1)
        elif lines:
            half = len(lines) // 2
            yield from self.split(lines[:half], at)
            yield from self.split(lines[half:], at + half)


def _blocks(batches: Iterator[pa.RecordBatch], layout: Layout):
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_RECORDS):
            part = batch.slice(start, BLOCK_RECORDS)
            yield part.column(0), list(layout.split(part.column(1).to_pylist()))


def rejected(lines: DataFrame, id_col: str = "line_id", line_col: str = "raw_line", fields: list[str] | None = None) -> DataFrame:
    """``id_col, reason``: one row per record that fails."""
    names = fields or EXPORT_FIELDS
    schema = T.StructType([lines.schema[id_col], T.StructField("reason", T.StringType())])

    def run(batches):
        layout = Layout(names)
        for ids, parts in _blocks(batches, layout):
            bad = [(at, what) for at, what, _ in parts if isinstance(what, str)]
            if bad:
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array([a for a, _ in bad])), pa.array([r for _, r in bad], pa.string())],
                    names=[id_col, "reason"],
                )

    return lines.select(id_col, line_col).mapInArrow(run, schema)


def loaded(lines: DataFrame, id_col: str = "line_id", line_col: str = "raw_line", fields: list[str] | None = None) -> DataFrame:
    """``id_col`` and one string column per field: the records that load."""
    names = fields or EXPORT_FIELDS
    schema = T.StructType([lines.schema[id_col], *[T.StructField(f, T.StringType()) for f in names]])

    def run(batches):
        layout = Layout(names)
        for ids, parts in _blocks(batches, layout):
            for at, what, n in parts:
                if not isinstance(what, str):
                    columns = [pc.cast(c.combine_chunks(), pa.string()) for c in what.columns]
                    yield pa.RecordBatch.from_arrays([ids.slice(at, n), *columns], names=[id_col, *names])

    return lines.select(id_col, line_col).mapInArrow(run, schema)
