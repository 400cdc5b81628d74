"""User covariates: hashed name, columns that describe the user, and the cells of home and work. One row for each input row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwell.functions import columns as C
from dwell.functions.hashing import uid64
from dwell.functions.projection import project
from dwell.functions.space import Grid


def ses_columns(columns: list[str], given: dict) -> list[str]:
    named = given.get("ses_cols")
    if isinstance(named, str):
        named = [c.strip() for c in named.split(",") if c.strip()]
    return [c for c in (named or [c for c in columns if c.lower().startswith("ses")]) if c in columns]


def covariates(users: DataFrame, grid: Grid, schema_map: dict | None = None, hash_method: str = "sha256_64", output_grid_uid: bool = True, output_grid_id: bool = False, prefix: str = "grid", code: str = "", order: str = "col_row") -> DataFrame:
    given = (schema_map or {}).get("uuid_table") or {}
    names = users.columns
    out = [uid64(C.as_text(users, C.need(names, "uuid", given)), hash_method).alias("uuid_hash"), *[C.col(c) for c in ses_columns(names, given)]]
    ids, uids = [], []
    for place in ("home", "work"):
        found = {k: c for k in ("x", "y", "lon", "lat") if (c := C.find(names, f"{place}_{k}", given)) in names}
        if {"x", "y"} <= found.keys():
            x, y = C.as_double(users, found["x"]), C.as_double(users, found["y"])
        elif {"lon", "lat"} <= found.keys():
            x, y = project(C.as_double(users, found["lon"]), C.as_double(users, found["lat"]), grid.coord_crs, grid.grid_crs)
        else:
            continue
        cell, inside = grid.cell(x, y)
        cell = F.when(inside & (cell >= 0), cell)
        ids.append(cell.cast("int").alias(f"{place}_grid_id"))
        uids.append(F.when(cell.isNotNull(), grid.uid(cell, prefix, code, order)).alias(f"{place}_grid_uid"))
    return users.select(*out, *(ids if output_grid_id else []), *(uids if output_grid_uid else []))
