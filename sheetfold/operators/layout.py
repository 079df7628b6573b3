"""Sheet layout discovery on raw grids.

A *grid* is one row per sheet row: ``<sheet keys>, row_idx int (0-based position), cells
array<string>``. A *layout* is one row per sheet: where the header is, where the table stops,
the header cells. It is computed with one grouped aggregate (partial aggregation map-side, so a
huge sheet costs no more than a small one), then joined back to the rows behind a size check.
No window over rows, no per-file loop, nothing collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetfold.functions.text import strip, strip_py, upper
from sheetfold.operators.joins import sized_side


def _any_keyword(keywords: list[str], strip_cells: bool = False):
    def pred(c: Column) -> Column:
        u = upper(strip(c) if strip_cells else c)
        cond = None
        for kw in keywords:
            cond = u.contains(kw) if cond is None else (cond | u.contains(kw))
        return cond
    return pred


def blank_error_cells(grid: DataFrame, cells: str = "cells") -> DataFrame:
    """Cells whose stripped text starts with '#' (``#REF!``, ``#N/A``…) become ''."""
    return grid.withColumn(cells, F.transform(F.col(cells), lambda c: F.when(
        F.coalesce(strip_py(c).startswith("#"), F.lit(False)), F.lit("")).otherwise(c)))


def row_has_keyword(cells: Column, keywords: list[str], strip_cells: bool = False) -> Column:
    """Some cell of the row contains one of ``keywords`` (upper-case match)."""
    return F.exists(cells, _any_keyword(keywords, strip_cells))


def sheet_layout(grid: DataFrame, keys: list[str], header_keywords: list[str], search_rows: int,
                 fallback_first_row: bool, stop_keywords: list[str] | None = None,
                 min_rows: int = 2, require_data: bool = True) -> DataFrame:
    """One row per sheet: ``n_rows, header_idx, header, stop_idx, n_data`` (+ ``width`` when the
    table runs to the end of the sheet).

    * header: first of rows ``0..search_rows-1`` with a cell containing a keyword; else row 0 if
      ``fallback_first_row``, else the sheet has no table;
    * stop: first row after the header with a cell containing a stop keyword (exclusive);
    * sheets with fewer than ``min_rows`` rows, or no row under the header, have no table.

    The stop row is found in the same pass: stop candidates inside the header search window are
    kept as a set (at most ``search_rows`` ints per sheet), later ones only as their minimum.
    """
    ri, cells = F.col("row_idx"), F.col("cells")
    early = ri < search_rows
    is_hdr = early & row_has_keyword(cells, header_keywords)
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.max(ri).alias("_last"),
            F.min(F.when(is_hdr, F.struct(ri.alias("i"), cells.alias("c")))).alias("_hdr")]
    if fallback_first_row:
        aggs.append(F.min(F.when(ri == 0, F.struct(ri.alias("i"), cells.alias("c")))).alias("_row0"))
    if stop_keywords:
        is_stop = row_has_keyword(cells, stop_keywords, strip_cells=True)
        aggs += [F.collect_set(F.when(is_stop & early, ri)).alias("_early_stops"),
                 F.min(F.when(is_stop & ~early, ri)).alias("_late_stop")]
    else:
        aggs += [F.collect_list(F.when(early, F.struct(ri.alias("i"), F.size(cells).alias("w")))).alias("_early_w"),
                 F.max(F.when(~early, F.size(cells))).alias("_late_w")]
    agg = grid.groupBy(*keys).agg(*aggs)

    hdr_idx = F.col("_hdr.i")
    hdr = F.col("_hdr.c")
    if fallback_first_row:
        hdr_idx = F.coalesce(hdr_idx, F.when(F.col("_row0").isNotNull(), F.lit(0)))
        hdr = F.coalesce(hdr, F.col("_row0.c"))
    out = agg.select(*keys, "n_rows", "_last", *(["_early_stops", "_late_stop"] if stop_keywords else ["_early_w", "_late_w"]),
                     hdr_idx.cast("long").alias("header_idx"), hdr.alias("header"))
    h = F.col("header_idx")
    if stop_keywords:
        first_early = F.array_min(F.filter("_early_stops", lambda s: s > h))
        out = out.withColumn("stop_idx", F.least(first_early, F.col("_late_stop")).cast("long"))
    else:
        later = F.transform(F.filter("_early_w", lambda e: e["i"] > h), lambda e: e["w"])
        out = (out.withColumn("stop_idx", F.lit(None).cast("long"))
               .withColumn("width", F.greatest(F.size("header"), F.coalesce(F.array_max(later), F.lit(0)),
                                               F.coalesce(F.col("_late_w"), F.lit(0)))))
    out = out.withColumn("n_data", (F.coalesce(F.col("stop_idx"), F.col("_last") + 1) - h - 1).cast("int"))
    out = out.where((F.col("n_rows") >= min_rows) & h.isNotNull())
    if require_data:
        out = out.where(F.col("n_data") > 0)
    return out.drop("_last", "_early_stops", "_late_stop", "_early_w", "_late_w")


def first_row_layout(grid: DataFrame, keys: list[str], min_rows: int = 2) -> DataFrame:
    """Layout of a sheet whose header is its first row and whose table runs to the end.

    Positions are contiguous from 0, so "at least ``min_rows`` rows" means rows ``0..min_rows-1``
    exist: only those rows are aggregated (the filter reaches the scan)."""
    ri = F.col("row_idx")
    agg = (grid.where(ri < min_rows).groupBy(*keys)
           .agg(F.count(F.lit(1)).alias("_n"),
                F.min(F.when(ri == 0, F.struct(ri.alias("i"), F.col("cells").alias("c")))).alias("_row0")))
    return (agg.where((F.col("_n") >= min_rows) & F.col("_row0").isNotNull())
            .select(*keys, F.lit(0).cast("long").alias("header_idx"), F.col("_row0.c").alias("header"),
                    F.lit(None).cast("long").alias("stop_idx")))


def table_rows(grid: DataFrame, layout: DataFrame, keys: list[str],
               max_broadcast_rows: int | None = None, checkpoint: bool = True) -> DataFrame:
    """Rows strictly between the header and the stop row, with the layout's columns attached.

    The layout (one row per sheet) is checkpointed (unless the caller already materialised it)
    and broadcast only when its row count is within bound; otherwise it is a shuffle join whose
    hot sheets AQE splits.
    """
    lay = sized_side(layout, max_broadcast_rows, checkpoint=checkpoint)
    ri = F.col("row_idx")
    return (grid.join(lay, keys, "inner")
            .where((ri > F.col("header_idx")) & (F.col("stop_idx").isNull() | (ri < F.col("stop_idx")))))


def carved_width(grid: DataFrame, layout: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``width`` = max(header length, longest carved row) to a stop-carved layout (one more
    aggregate over the carved rows)."""
    rows = table_rows(grid, layout.select(*keys, "header_idx", "stop_idx"), keys)
    w = rows.groupBy(*keys).agg(F.max(F.size("cells")).alias("_w"))
    return (layout.join(w, keys, "left")
            .withColumn("width", F.greatest(F.size("header"), F.coalesce(F.col("_w"), F.lit(0))))
            .drop("_w"))


def cell_at(cells: Column, idx: Column) -> Column:
    """Cell at 0-based ``idx`` padded with '' (null when the column is absent: idx null)."""
    return F.when(idx.isNotNull(), F.coalesce(F.get(cells, idx), F.lit("")))


def fit_cells(cells: Column, width: Column) -> Column:
    """Pad with '' or cut to exactly ``width`` cells (``width`` 0 gives an empty row; Spark's
    ``sequence(0, -1)`` would count down)."""
    fitted = F.transform(F.sequence(F.lit(0), width - 1), lambda k: F.coalesce(F.get(cells, k), F.lit("")))
    return F.when(width > 0, fitted).otherwise(F.array().cast("array<string>"))


def row_map(names: Column, cells: Column, width: Column) -> Column:
    """One row as ``map<name, text>`` over the sheet's (unique) column names, cells padded or cut
    to ``width`` — every column of any sheet shape in one column type."""
    return F.map_from_arrays(F.slice(names, 1, width), fit_cells(cells, width))


def slice_range(grid: DataFrame, first_row: int = 0, first_col: int = 0, n_cols: int | None = None) -> DataFrame:
    """A1-style range read on a grid: drop rows before ``first_row`` (re-indexed from 0) and keep
    ``n_cols`` columns from ``first_col`` (``A2:I`` = first_row 1, n_cols 9; ``A:Z`` = n_cols 26)."""
    out = grid.where(F.col("row_idx") >= first_row)
    if first_row:
        out = out.withColumn("row_idx", F.col("row_idx") - first_row)
    if n_cols is not None or first_col:
        length = F.lit(n_cols) if n_cols is not None else F.size("cells")
        out = out.withColumn("cells", F.slice("cells", first_col + 1, length))
    return out
