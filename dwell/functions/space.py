"""Square grids: from coordinates to cells and names of cells."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from dwell.functions.columns import finite


@dataclass(frozen=True)
class Grid:
    grid_crs: str
    origin_x: float
    origin_y: float
    n_cols: int
    cell_size_m: float = 500.0
    n_rows: int | None = None
    bbox: tuple[float, float, float, float] | None = None
    coord_crs: str = "EPSG:4326"
    code: str | None = None

    def cell(self, x: Column, y: Column) -> tuple[Column, Column]:
        """(row * n_cols + col, whether the cell lies in the grid). The number is null where coordinates are not finite."""
        ok = finite(x) & finite(y)
        c = F.floor((x - self.origin_x) / self.cell_size_m)
        r = F.floor((y - self.origin_y) / self.cell_size_m)
        inside = ok & (c >= 0) & (c < self.n_cols) & (r >= 0)
        if self.n_rows is not None:
            inside = inside & (r < self.n_rows)
        if self.bbox is not None:
            x0, y0, x1, y1 = self.bbox
            inside = inside & (x >= x0) & (x <= x1) & (y >= y0) & (y <= y1)
        return F.when(ok, (r * self.n_cols + c).cast("long")), F.coalesce(inside, F.lit(False))

    def uid(self, cell: Column, prefix: str, code: str, order: str = "col_row") -> Column:
        if order.strip().lower() not in ("col_row", "row_col"):
            raise ValueError("the order of a grid uid is col_row or row_col")
        c = F.pmod(cell, F.lit(self.n_cols)).cast("string")
        r = F.floor(cell / self.n_cols).cast("long").cast("string")
        return F.concat_ws("_", F.lit(prefix), F.lit(code), *((c, r) if order.strip().lower() == "col_row" else (r, c)))


def placed(cell: Column, inside: Column, mode: str) -> Column:
    """A cell's number by the out-of-bounds mode: drop leaves null (the caller filters), null gives -1, keep leaves it."""
    mode = mode.lower()
    if mode == "keep":
        return F.coalesce(cell, F.lit(-1).cast("long"))
    if mode == "null":
        return F.when(inside, cell).otherwise(F.lit(-1).cast("long"))
    if mode == "drop":
        return F.when(inside, cell)
    raise ValueError("oob_mode is drop, null or keep")
