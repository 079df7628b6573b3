import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sheetfold.session import build_session

    s = build_session("local[*]", app="sheetfold-tests", conf={"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


def grid_df(spark, sheets: dict, key: str = "sheet", extra: dict | None = None):
    """Hand-written sheets {key: [[cell, ...], ...]} → grid rows (key, row_idx, cells)."""
    rows = []
    for k, grid in sheets.items():
        for i, cells in enumerate(grid):
            row = {key: k, "row_idx": i, "cells": list(cells)}
            for col, fn in (extra or {}).items():
                row[col] = fn(k)
            rows.append(row)
    schema = f"{key} string, row_idx int, cells array<string>"
    for col in (extra or {}):
        schema += f", {col} string"
    return spark.createDataFrame(rows, schema)
