import json
from collections import Counter

import pytest

from dwell import api
from dwell.operators import fill
from dwell.operators.stays import Clock
from dwell.plans import inputs as I
from tests.conftest import SF_SMALL

GRID = {"grid_crs": "EPSG:32650", "coord_crs": "EPSG:4326", "cell_size_m": 500, "origin_x": 0, "origin_y": 0, "n_cols": 10, "n_rows": 10, "bbox": [0, 0, 5000, 5000], "code": "4403"}


def test_keywords_reach_the_pipeline(spark, tmp_path):
    stays = I.stays(spark, SF_SMALL).withColumnsRenamed({"start_ms": "start_time", "end_ms": "end_time"})
    stays.write.parquet(f"{tmp_path}/stays.parquet")
    (tmp_path / "grid.json").write_text(json.dumps(GRID))
    figures = api.export_user_grid_time_strict_filled(city="T", staypoints=[tmp_path / "stays.parquet"], grid_meta_path=tmp_path / "grid.json", out_dir=tmp_path / "out", windows=["lunch", "dinner"], timestamps_are_utc=False, schema_map={}, buckets=4, duckdb_temp_dir=None)
    want = fill.strict_filled(stays, fill.Cells(I.GRID, code="4403"), fill.Options(clock=Clock(timestamps_are_utc=False)))
    got = spark.read.parquet(f"{tmp_path}/out/T/user_grid_time_strict_filled_T.parquet")
    key = lambda r: tuple(round(x, 6) if isinstance(x, float) else x for x in r)
    assert figures["output_rows"] == got.count() > 0
    assert Counter(map(key, got.select(*want.columns).collect())) == Counter(map(key, want.collect()))
    rows = api.process_large_poi_data(f"{tmp_path}/visits.parquet" if I.visit_records(spark, SF_SMALL).write.parquet(f"{tmp_path}/visits.parquet") is None else "", tmp_path / "p", notebook=True)
    assert rows.count() > 0


def test_unknown_and_missing_keywords():
    with pytest.raises(TypeError, match="unexpected"):
        api.export_user_grid_time(city="T", staypoints=["x"], grid_meta_path="g", out_dir="o", colour=1)
    with pytest.raises(TypeError, match="missing"):
        api.export_user_hex_time_strict_filled(city="T", staypoints=["x"], out_dir="o")
