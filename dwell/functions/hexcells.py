"""Hexagonal cell ids. Inside they are signed longs; outside 15 hex digits, or unsigned DECIMAL(20,0)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def cell_of(lat: Column, lon: Column, resolution: int) -> Column:
    """The cell at a place. Needs the library h3; without it callers pass a column of precomputed cells."""
    try:
        import h3  # noqa: F401
    except ImportError:
        raise ValueError("h3 is not installed: pass a column of precomputed cells (h3_int)") from None

    @F.arrow_udf("long")
    def cells(a: pa.Array, b: pa.Array) -> pa.Array:
        import h3

        to_cell = getattr(h3, "latlng_to_cell", None) or h3.geo_to_h3
        to_int = getattr(h3, "str_to_int", None) or h3.string_to_h3
        values = [None if x is None or y is None else to_int(to_cell(x, y, resolution)) for x, y in zip(a.to_pylist(), b.to_pylist())]
        return pa.array([v if v is None or v < 1 << 63 else v - (1 << 64) for v in values], pa.int64())

    return cells(lat, lon)


def cell_number(text: Column) -> Column:
    return F.conv(text, 16, -10).cast("long")


def cell_text(cell: Column) -> Column:
    return F.lower(F.hex(cell))


def cell_uid(cell: Column, prefix: str, code: str) -> Column:
    """Two underscores stand before the cell."""
    return F.concat(F.lit(f"{prefix}_{code}__"), cell_text(cell))
