"""A1 range expressions (``'Tab name'!A:Z``, ``A2:I``, ``B3:D10``) and range reads on grids."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetfold.operators.layout import slice_range

_CORNER = r"([A-Za-z]{1,3})?([1-9][0-9]{0,7})?"
_CELLS = re.compile(rf"{_CORNER}(?::{_CORNER})?")


class BadRange(ValueError):
    """Raised for a text that is no range expression."""


class Range(NamedTuple):
    """0-based and half-open; None: open to that side's end."""

    tab: str | None
    first_row: int
    end_row: int | None
    first_col: int
    end_col: int | None

    @property
    def n_cols(self) -> int | None:
        return None if self.end_col is None else self.end_col - self.first_col


def column_number(letters: str) -> int:
    """0-based position of a column's letters (A → 0, Z → 25, AA → 26)."""
    n = 0
    for c in letters.upper():
        n = 26 * n + ord(c) - ord("A") + 1
    return n - 1


def parse_range(text: str) -> Range:
    """A range expression, with or without its tab (quoted if it holds more than letters, digits and
    ``_``; a quote in it is doubled). A tab alone is the whole tab; ``A:Z`` whole columns, ``2:5`` whole
    rows, ``A2:I`` columns from a row on, ``B3`` one cell. Corners may be swapped. :class:`BadRange`
    for anything else."""
    body, tab = text.strip(), None
    quoted = re.match(r"'((?:[^']|'')+)'(!|$)", body)
    if quoted:
        tab, body = quoted[1].replace("''", "'"), body[quoted.end():]
        if not quoted[2]:
            return Range(tab, 0, None, 0, None)
        if not body:
            raise BadRange(text)
    elif "!" in body:
        tab, body = body.split("!", 1)
        if not re.fullmatch(r"\w+", tab):
            raise BadRange(text)
    cells = _CELLS.fullmatch(body)
    if not cells or not body:
        if tab is None and re.fullmatch(r"\w+", body):
            return Range(body, 0, None, 0, None)
        raise BadRange(text)
    c1, r1, c2, r2 = cells.groups()
    if ":" not in body:
        if not (c1 and r1):
            if tab is None and re.fullmatch(r"\w+", body):
                return Range(body, 0, None, 0, None)    # a tab whose name is all letters or all digits
            raise BadRange(text)
        c2, r2 = c1, r1
    if not (c1 or r1) or not (c2 or r2) or bool(c1) != bool(c2):
        raise BadRange(text)
    cols = sorted((column_number(c1), column_number(c2))) if c1 else None
    if r1 and r2:
        rows = sorted((int(r1), int(r2)))
        first_row, end_row = rows[0] - 1, rows[1]
    else:                                               # one row given: from there on
        first_row, end_row = int(r1 or r2 or 1) - 1, None
    return Range(tab, first_row, end_row, cols[0] if cols else 0, cols[1] + 1 if cols else None)


def read_range(grid: DataFrame, expression: str, tab_col: str = "tab") -> DataFrame:
    """The rows and cells of ``grid`` (``row_idx, cells`` and sheet keys) that a range expression names,
    positions counted from the range's corner. A tab in the expression selects by ``tab_col``; tab and
    row bounds are predicates that reach the scan."""
    r = parse_range(expression)
    if r.tab is not None:
        grid = grid.where(F.col(tab_col) == r.tab)
    if r.end_row is not None:
        grid = grid.where(F.col("row_idx") < r.end_row)
    return slice_range(grid, r.first_row, r.first_col, r.n_cols)
