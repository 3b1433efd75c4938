"""Office documents as tables: ODT blocks, ODS cells, DOCX paragraphs and cells.

Each file is one row of ``binaryFile`` input and is parsed in the task that
reads it; the parsers use only the ZIP and XML modules.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from itertools import groupby
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# XML name spaces of the formats.
TEXT = "{urn:oasis:names:tc:opendocument:xmlns:text:1.0}"
TABLE = "{urn:oasis:names:tc:opendocument:xmlns:table:1.0}"
OFFICE = "{urn:oasis:names:tc:opendocument:xmlns:office:1.0}"
WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
#: Bytes of one XML part; larger ones are refused.
LARGEST_PART = 256 << 20


def _part(content: bytes, name: str) -> ElementTree.Element:
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        if archive.getinfo(name).file_size > LARGEST_PART:
            raise ValueError(f"{name} is too large")
        data = archive.read(name)
    if b"<!DOCTYPE" in data[:1024] or b"<!ENTITY" in data[:4096]:
        raise ValueError("document type declaration")
    return ElementTree.fromstring(data)


def _odf_text(node: ElementTree.Element) -> str:
    """Text of a paragraph, with its spaces, tabs and breaks; notes' own paragraphs excluded."""
    out = [node.text or ""]
    for child in node:
        if child.tag == TEXT + "s":
            out.append(" " * int(child.get(TEXT + "c", "1")))
        elif child.tag == TEXT + "tab":
            out.append("\t")
        elif child.tag == TEXT + "line-break":
            out.append("\n")
        elif child.tag != TEXT + "note":
            out.append(_odf_text(child))
        out.append(child.tail or "")
    return "".join(out)


def _table_rows(node: ElementTree.Element) -> Iterator[ElementTree.Element]:
    """A table's own rows, those in header rows and row groups included, those of nested tables not."""
    for child in node:
        if child.tag == TABLE + "table-row":
            yield child
        elif child.tag in (TABLE + "table-header-rows", TABLE + "table-rows", TABLE + "table-row-group"):
            yield from _table_rows(child)


def odt_blocks(content: bytes) -> list[dict]:
    """Paragraphs, headings, list items and table paragraphs in document order, each exactly once."""
    body = _part(content, "content.xml").find(f"{OFFICE}body/{OFFICE}text")
    blocks: list[dict] = []
    tables = 0

    def walk(node, container: str, depth: int, place: str):
        nonlocal tables
        for child in node:
            if child.tag in (TEXT + "p", TEXT + "h"):
                level = int(child.get(TEXT + "outline-level", "1")) if child.tag == TEXT + "h" else None
                blocks.append({"block_order": len(blocks), "block_kind": "heading" if level else "paragraph", "container": container, "depth": level or depth, "place": place, "raw_text": _odf_text(child)})
            elif child.tag == TEXT + "list":
                walk(child, container, depth, place)
            elif child.tag in (TEXT + "list-item", TEXT + "list-header"):
                walk(child, "list", depth + 1, place)
            elif child.tag == TABLE + "table":
                number, tables = tables, tables + 1
                for r, row in enumerate(_table_rows(child)):
                    for c, cell in enumerate(x for x in row if x.tag in (TABLE + "table-cell", TABLE + "covered-table-cell")):
                        walk(cell, "table", depth, f"{place}t{number}r{r}c{c}")
            elif child.tag in (TEXT + "section", TEXT + "index-body", TABLE + "table-header-rows", TEXT + "tracked-changes"):
                if child.tag != TEXT + "tracked-changes":
                    walk(child, container, depth, place)

    if body is not None:
        walk(body, "body", 0, "")
    return blocks


def ods_runs(content: bytes) -> list[dict]:
    """Typed cells of all sheets as they are written, each with its first row and column and its repeats; cells without content are left out.

    The raw lexical value is kept, never coerced.
    """
    book = _part(content, "content.xml").find(f"{OFFICE}body/{OFFICE}spreadsheet")
    sheets = book.findall(TABLE + "table") if book is not None else []
    cells = []
    for sheet_index, sheet in enumerate(sheets):
        row_index = 0
        for row in _table_rows(sheet):
            repeat_rows = int(row.get(TABLE + "number-rows-repeated", "1"))
            column = 0
            for cell in row:
                if cell.tag not in (TABLE + "table-cell", TABLE + "covered-table-cell"):
                    continue
                repeat = int(cell.get(TABLE + "number-columns-repeated", "1"))
                if repeat < 1 or repeat_rows < 1:
                    raise ValueError("repeat below 1")
                kind = cell.get(OFFICE + "value-type")
                text = "\n".join(_odf_text(p) for p in cell.findall(TEXT + "p"))
                if kind or text or cell.get(TABLE + "formula"):
                    raw = next((cell.get(OFFICE + a) for a in ("value", "date-value", "time-value", "boolean-value", "string-value") if cell.get(OFFICE + a) is not None), None)
                    cells.append({
                        "sheet": sheet.get(TABLE + "name"), "sheet_index": sheet_index, "covered": cell.tag.endswith("covered-table-cell"), "value_type": kind,
                        "raw_value": raw, "formula": cell.get(TABLE + "formula"), "rendered_text": text,
                        "row_index": row_index, "column_index": column, "row_repeat": repeat_rows, "column_repeat": repeat,
                    })
                column += repeat
            row_index += repeat_rows
    return cells


def ods_cells(content: bytes) -> list[dict]:
    """The cells of :func:`ods_runs` with all repeated rows and columns expanded, in the order of the sheets."""
    cells = []
    for _, row in groupby(ods_runs(content), lambda c: (c["sheet_index"], c["row_index"])):
        runs = list(row)
        bare = [({n: v for n, v in c.items() if n not in REPEATS}, c["column_index"], c["column_repeat"]) for c in runs]
        cells.extend({**c, "row_index": c["row_index"] + r, "column_index": column + k} for r in range(runs[0]["row_repeat"]) for c, column, repeat in bare for k in range(repeat))
    return cells


def docx_blocks(content: bytes) -> list[dict]:
    """Paragraphs of a Word document in order, those in tables with their place."""
    body = _part(content, "word/document.xml").find(WORD + "body")
    blocks: list[dict] = []
    tables = 0

    def text(paragraph):
        marks = {WORD + "t": lambda n: n.text or "", WORD + "tab": lambda n: "\t", WORD + "br": lambda n: "\n"}
        return "".join(marks[n.tag](n) for n in paragraph.iter() if n.tag in marks)

    def walk(node, container, place):
        nonlocal tables
        for child in node:
            if child.tag == WORD + "p":
                blocks.append({"block_order": len(blocks), "block_kind": "paragraph", "container": container, "depth": 0, "place": place, "raw_text": text(child)})
            elif child.tag == WORD + "tbl":
                number, tables = tables, tables + 1
                for r, row in enumerate(child.findall(WORD + "tr")):
                    for c, cell in enumerate(row.findall(WORD + "tc")):
                        walk(cell, "table", f"{place}t{number}r{r}c{c}")
            elif child.tag == WORD + "sdt":
                walk(child.find(WORD + "sdtContent") or [], container, place)

    walk(body if body is not None else [], "body", "")
    return blocks


BLOCK_FIELDS = [("block_order", pa.int32()), ("block_kind", pa.string()), ("container", pa.string()), ("depth", pa.int32()), ("place", pa.string()), ("raw_text", pa.string())]
CELL_FIELDS = [
    ("sheet", pa.string()), ("sheet_index", pa.int32()), ("row_index", pa.int32()), ("column_index", pa.int32()), ("covered", pa.bool_()), ("value_type", pa.string()),
    ("raw_value", pa.string()), ("formula", pa.string()), ("rendered_text", pa.string()),
]
REPEATS = ("row_repeat", "column_repeat")
NAMES = {pa.int32(): "int", pa.string(): "string", pa.bool_(): "boolean"}


def read_documents(files: DataFrame, parser: Callable[[bytes], list[dict]]) -> DataFrame:
    """Parsed rows of ``(path, content)`` files; a file that can't be parsed gives one row with ``error``.

    Of sheets the tasks give the cells as written, whose repeats Spark expands row by row.
    """
    fields = [*CELL_FIELDS, *((n, pa.int32()) for n in REPEATS)] if parser is ods_cells else BLOCK_FIELDS
    parser = ods_runs if parser is ods_cells else parser

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                error = None
                try:
                    rows = parser(content)
                except (zipfile.BadZipFile, KeyError, ValueError, ElementTree.ParseError) as problem:
                    rows, error = [{}], f"{type(problem).__name__}: {problem}"
                columns = [pa.array([path] * len(rows)), pa.array([error] * len(rows), pa.string())]
                columns += [pa.array([r.get(n) for r in rows], t) for n, t in fields]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "error", *[n for n, _ in fields]])

    schema = "path string, error string, " + ", ".join(f"{n} {NAMES[t]}" for n, t in fields)
    rows = files.select("path", "content").mapInArrow(run, schema)
    if parser is ods_runs:
        for at, repeat in zip(("row_index", "column_index"), REPEATS):
            # A file with an error has no repeats and keeps its one row.
            rows = rows.withColumn(at, F.explode_outer(F.sequence(F.col(at), F.col(at) + F.col(repeat) - 1))).drop(repeat)
    return rows
