"""Rows and cells of HTML tables, by one pass over a page's tags.

Pages are walked from left to right with a stack of open tables, in Arrow batches: tables may be nested, end tags may be missing, and
comments, CDATA, scripts and styles hold neither rows nor text. Regular expressions cannot tell an inner table's rows from an outer one's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# Entities resolved in page text; the ampersand comes last.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}
SECTIONS = ("thead", "tbody", "tfoot")
ROW = "table_number int, depth int, section string, row_number int, cells array<struct<kind:string,text:string,column:int>>"
_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>script|style)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"""
    r"""|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attributes>[^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*)>|<[!?/][^>]*>""",
    re.I | re.S,
)
_SPAN = re.compile(r"""\bcolspan\s*=\s*["']?\s*(\d{1,4})""", re.I)


def plain_text(parts: list[str]) -> str:
    text = "".join(parts)
    if "&" in text:
        for entity, char in ENTITIES.items():
            text = text.replace(entity, char)
    return text


class _Rows:
    """Rows and their cells as columns: a list a page's walk adds to is cheaper than an object per row and cell."""

    def __init__(self):
        self.table, self.depth, self.section, self.number, self.first = [], [], [], [], []
        self.kind, self.text, self.column = [], [], []
        self.cells: list[tuple[int, str, list[str], int]] = []  # row, kind, text, column, in the order in which cells begin

    def sorted_cells(self) -> None:
        """Put the cells in the order of their rows; those of an outer row may go on behind an inner table's."""
        made = self.cells
        if any(made[i][0] > made[i + 1][0] for i in range(len(made) - 1)):
            made.sort(key=lambda c: c[0])
        at = 0
        for row in range(len(self.number)):
            self.first.append(at)
            while at < len(made) and made[at][0] == row:
                at += 1
        self.first.append(at)
        self.kind, self.text, self.column = [c[1] for c in made], [plain_text(c[2]) for c in made], [c[3] for c in made]


def _walk(page: str, into: _Rows) -> int:
    """Add the rows of all tables of a page, and tell how many they are."""
    before, tables = len(into.number), 0
    # An outer table: its number, section, rows so far, open row (-1: none), next column and the text of its open cell.
    stack: list[tuple] = []
    table, section, rows, row, column, cell = -1, None, 0, -1, 0, None
    open_cells: list[list[str]] = []  # of the outer tables
    parts = iter(_MARKUP.split(page))
    next(parts)  # before the first tag no table is open
    for _, end, tag, attributes, text in zip(parts, parts, parts, parts, parts):
        kind = tag.lower() if tag else ""
        if kind == "table":
            if not end:
                stack.append((table, section, rows, row, column, cell))
                if cell is not None:
                    open_cells.append(cell)
                table, section, rows, row, column, cell = tables, None, 0, -1, 0, None
                tables += 1
            elif stack:
                table, section, rows, row, column, cell = stack.pop()
                if cell is not None:
                    open_cells.pop()
        elif not stack:
            continue
        elif kind == "td" or kind == "th":
            cell = None
            if not end:
                if row < 0:
                    row, column = _begin(into, table, len(stack) - 1, section, rows), 0
                    rows += 1
                cell = []
                into.cells.append((row, kind, cell, column))
                span = _SPAN.search(attributes) if attributes else None
                column += max(1, int(span[1])) if span else 1
        elif kind == "tr":
            row, cell = -1, None
            if not end:
                row, column = _begin(into, table, len(stack) - 1, section, rows), 0
                rows += 1
        elif kind in SECTIONS:
            row, cell, section = -1, None, None if end else kind
        if text:
            if cell is not None:
                cell.append(text)
            for outer in open_cells:
                outer.append(text)
    return len(into.number) - before


def _begin(into: _Rows, table: int, depth: int, section: str | None, number: int) -> int:
    into.table.append(table)
    into.depth.append(depth)
    into.section.append(section)
    into.number.append(number)
    return len(into.number) - 1


def walk(page: str) -> list[dict]:
    """The rows of all tables of a page in the order in which they begin; rows of a table are numbered from 0.

    The text of a cell is all text in it, that of inner tables too; its column counts the spans of the cells before it.
    Cells outside a row are in a row of their own; what is open at an end tag of something around it ends there.
    """
    found = _Rows()
    _walk(page, found)
    found.sorted_cells()
    return [
        {
            "table_number": found.table[i], "depth": found.depth[i], "section": found.section[i], "row_number": found.number[i],
            "cells": [{"kind": found.kind[k], "text": found.text[k], "column": found.column[k]} for k in range(found.first[i], found.first[i + 1])],
        }
        for i in range(len(found.number))
    ]


def table_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per table row, beside the columns of its page: ``table_number``, ``depth`` (0 for outer tables), ``section`` (the
    part of the table it is in, null if it is the table's own), ``row_number`` in its table and ``cells``.

    Null and empty pages, and pages without tables, have none. Columns of ``pages`` with one of these names are an error.
    """
    added = StructType.fromDDL(ROW)
    if clash := {f.name for f in added} & set(pages.columns):
        raise ValueError(f"columns of the pages clash: {sorted(clash)}")

    def rows(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = _Rows()
                counts = [_walk(page, found) if page else 0 for page in part.column(html).to_pylist()]
                found.sorted_cells()
                taken = part.take(pa.array(np.repeat(np.arange(len(counts)), counts)))
                cells = pa.StructArray.from_arrays(
                    [pa.array(found.kind, pa.string()), pa.array(found.text, pa.string()), pa.array(found.column, pa.int32())], ["kind", "text", "column"]
                )
                made = [
                    pa.array(found.table, pa.int32()), pa.array(found.depth, pa.int32()), pa.array(found.section, pa.string()), pa.array(found.number, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(found.first, pa.int32()), cells),
                ]
                yield pa.RecordBatch.from_arrays([*taken.columns, *made], [*part.schema.names, *added.names])

    return pages.mapInArrow(rows, StructType([*pages.schema.fields, *added.fields]))
