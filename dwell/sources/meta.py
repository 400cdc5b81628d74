"""Descriptions of grids and hexagon sets, from small JSON files read on the driver."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from dwell.functions.space import Grid

NESTED = ("grid_meta", "meta", "params")


def _object(path: str | Path) -> dict:
    raw = json.loads(Path(path).read_text(encoding="utf-8-sig"))
    if not isinstance(raw, dict):
        raise ValueError(f"{path} must hold a JSON object")
    return raw


def _first(obj: dict, *names: str):
    return next((obj[n] for n in names if obj.get(n) is not None), None)


def _code(obj: dict, *names: str) -> str | None:
    return next((t for n in names if obj.get(n) is not None and (t := str(obj[n]).strip())), None)


def grid_from(raw: dict) -> Grid:
    """From an object whose fields may be nested under grid_meta, meta or params."""
    inner = next((raw[k] for k in NESTED if isinstance(raw.get(k), dict)), None)
    shape = next((raw[k] for k in NESTED if isinstance(raw.get(k), dict) and {"origin_x", "origin_y", "n_cols"} & raw[k].keys()), None)
    obj = {**raw, **shape} if shape else raw
    box = obj.get("bbox")
    if isinstance(box, dict):
        box = [box[k] for k in ("min_x", "min_y", "max_x", "max_y")]
    box = tuple(map(float, box)) if isinstance(box, (list, tuple)) and len(box) == 4 else None
    origin = obj["origin"] if isinstance(obj.get("origin"), dict) else {}
    x = _first({"a": obj.get("origin_x"), "b": origin.get("x"), "c": origin.get("origin_x")}, "a", "b", "c")
    y = _first({"a": obj.get("origin_y"), "b": origin.get("y"), "c": origin.get("origin_y")}, "a", "b", "c")
    crs, n_cols = obj.get("grid_crs") or obj.get("crs"), _first(obj, "n_cols", "ncols")
    for name, value in (("grid_crs", crs), ("origin_x", x), ("origin_y", y), ("n_cols", n_cols)):
        if value is None:
            raise ValueError(f"the grid description lacks {name}")
    size = _first(obj, "cell_size_m", "cell_size")
    code = _code({**raw, **inner} if inner else raw, "grid_uid_code", "city_code", "code", "adcode")
    return Grid(crs, float(x), float(y), int(n_cols), float(500 if size is None else size), None if obj.get("n_rows") is None else int(obj["n_rows"]), box, obj.get("coord_crs", "EPSG:4326"), code)


def read_grid(path: str | Path) -> Grid:
    return grid_from(_object(path))


@dataclass(frozen=True)
class HexMeta:
    city: str
    resolution: int
    cells: tuple[str, ...]
    code: str | None = None
    bbox: tuple[float, float, float, float] | None = None
    coord_crs: str = "EPSG:4326"

    def table(self, spark: SparkSession) -> DataFrame:
        """h3_int (signed), one row for each distinct cell. A city's cells are few; the join decides itself how to use them."""
        numbers = sorted({int(c, 16) for c in self.cells})
        return spark.createDataFrame([(n - (1 << 64) if n >= 1 << 63 else n,) for n in numbers], "h3_int long")


def hexes_from(raw: dict, stem: str = "") -> HexMeta:
    city = str(raw.get("city") or stem).strip()
    if not city:
        raise ValueError("the hexagon description lacks city")
    if raw.get("h3_resolution") is None:
        raise ValueError("the hexagon description lacks h3_resolution")
    cells = tuple(t for c in raw["h3_ids"] if (t := str(c).strip())) if isinstance(raw.get("h3_ids"), list) else ()
    if not cells:
        raise ValueError("the hexagon description lacks h3_ids")
    box = raw.get("bbox")
    box = tuple(map(float, box)) if isinstance(box, (list, tuple)) and len(box) == 4 else None
    return HexMeta(city, int(raw["h3_resolution"]), cells, _code(raw, "hex_uid_code", "city_code", "code", "adcode"), box, str(raw.get("coord_crs") or "EPSG:4326").strip() or "EPSG:4326")


def read_hexes(path: str | Path) -> HexMeta:
    return hexes_from(_object(path), Path(path).stem)


def uid_code(flag: str | None, meta: str | None, city: str) -> str:
    """The code in unit names: as given, else of the description, else the city."""
    return next(t for v in (flag, meta, city) if v is not None and (t := str(v).strip()))
