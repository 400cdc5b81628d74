"""Sources, descriptions, sinks and command lines, from files to files."""

import csv
import json

import pytest

from dwell.plans import cli
from dwell.plans import inputs as I
from dwell.sources import meta, readers, sinks
from tests.conftest import SF_SMALL


def test_paths(tmp_path):
    for n in ("a.csv", "b.csv", "c.parquet"):
        (tmp_path / n).write_text("x\n1\n")
    (tmp_path / "link.csv").symlink_to(tmp_path / "a.csv")
    assert readers.expand([f"{tmp_path}/*.csv", f"{tmp_path}/b.csv", "hdfs://h/x"]) == [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv", "hdfs://h/x"]
    assert readers.format_of(["a.CSV", "b.csv"]) == "csv" and readers.format_of(["a.parquet"]) == "parquet" and readers.format_of(["a"], "csv") == "csv"
    for bad in (lambda: readers.format_of(["a.csv", "b.parquet"]), lambda: readers.format_of(["a"], "orc")):
        with pytest.raises(ValueError):
            bad()
    with pytest.raises(FileNotFoundError):
        readers.expand(f"{tmp_path}/none*.csv")


def test_csv_types_come_from_the_first_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,2\n")
    (tmp_path / "b.csv").write_text("k,v\nx,3\n")
    got = readers.read(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv"])
    assert got.dtypes == [("k", "int"), ("v", "int")] and sorted(map(tuple, got.collect()), key=str) == [(1, 2), (None, 3)]
    assert readers.read(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv"], lenient=True).collect() == [(1, 2)]


def test_grid_descriptions():
    base = {"grid_crs": "EPSG:32650", "origin_x": 1, "origin_y": 2, "n_cols": 3}
    assert meta.grid_from(base).cell_size_m == 500.0 and meta.grid_from(base).n_rows is None
    for raw in ({"grid_meta": base, "code": 4403}, {"meta": {**base, "code": " 4403 "}}, {"crs": "EPSG:32650", "origin": {"x": 1, "y": 2}, "ncols": 3, "adcode": "4403", "bbox": {"min_x": 0, "min_y": 1, "max_x": 2, "max_y": 3}, "cell_size": 250, "n_rows": 7}):
        g = meta.grid_from(raw)
        assert (g.origin_x, g.origin_y, g.n_cols, g.code) == (1.0, 2.0, 3, "4403")
    assert (g.bbox, g.cell_size_m, g.n_rows) == ((0.0, 1.0, 2.0, 3.0), 250.0, 7)
    for k in base:
        with pytest.raises(ValueError):
            meta.grid_from({x: v for x, v in base.items() if x != k})


def test_hex_descriptions(spark, tmp_path):
    raw = {"city": "x", "h3_resolution": 9, "h3_ids": ["8928308280fffff", " 8928308280fffff", ""], "code": 44}
    (tmp_path / "h.json").write_text(json.dumps(raw), encoding="utf-8-sig")
    m = meta.read_hexes(tmp_path / "h.json")
    assert m.code == "44" and [r.h3_int for r in m.table(spark).collect()] == [617700169958293503]
    for k in ("h3_resolution", "h3_ids"):
        with pytest.raises(ValueError):
            meta.hexes_from({x: v for x, v in raw.items() if x != k})
    assert meta.uid_code(None, " ", "city") == "city" and meta.uid_code("a", "b", "c") == "a"


def test_figures_have_a_byte_order_mark(tmp_path):
    sinks.write_figures({"城": "深圳", "n": 1, "x": None}, tmp_path / "q" / "f.csv")
    assert (tmp_path / "q" / "f.csv").read_bytes().startswith(b"\xef\xbb\xbf")
    assert list(csv.DictReader((tmp_path / "q" / "f.csv").open(encoding="utf-8-sig"))) == [{"城": "深圳", "n": "1", "x": ""}]


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("files")
    s = I.stays(spark, SF_SMALL).withColumnsRenamed({"start_ms": "start_time", "end_ms": "end_time"})
    s.write.parquet(f"{d}/stays.parquet")
    s.coalesce(1).write.option("header", True).csv(f"{d}/stays.csv")
    I.visit_records(spark, SF_SMALL).drop("event_id").write.parquet(f"{d}/visits.parquet")
    I.user_table(spark, SF_SMALL).write.parquet(f"{d}/users.parquet")
    I.place_table(spark, SF_SMALL).write.parquet(f"{d}/places.parquet")
    (d / "grid.json").write_text(json.dumps({"grid_crs": "EPSG:32650", "cell_size_m": 500, "origin_x": 0, "origin_y": 0, "n_cols": 10, "n_rows": 10, "bbox": [0, 0, 5000, 5000], "code": "4403"}))
    (d / "hex.json").write_text(json.dumps({"city": "T", "code": "4403", "h3_resolution": 9, "h3_ids": [f"{617700169958293503 + k * 262144:x}" for k in range(30)]}))
    return d


def figures(path):
    (row,) = csv.DictReader(open(path, encoding="utf-8-sig"))
    return row


COMMON = ["--city", "T", "--timestamps_are_utc", "no"]


def test_visits(spark, files, tmp_path):
    cli.main(["visits", "--input", f"{files}/visits.parquet", "--output_dir", str(tmp_path), "--rhythm_specs", json.dumps(I.RHYTHM)])
    got = cli.read_profiles(spark, f"{tmp_path}/user_poi_analysis.parquet")
    assert got.count() > 0 and dict(got.dtypes)["top_weekdays"] == "array<int>"
    assert spark.read.option("header", True).csv(f"{tmp_path}/poi_coordination.csv").columns == ["poi_id", "location"]


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_grid_minutes(spark, files, tmp_path, kind):
    cli.main(["grid-minutes", *COMMON, "--staypoints", f"{files}/stays.{kind}", "--grid_meta", f"{files}/grid.json", "--out_dir", str(tmp_path), "--windows", "lunch,dinner", "--output_grid_id", "true", "--poi_meta", f"{files}/places.parquet", "--poi_filter_mode", "exclude_food_poi", "--food_category_keywords", "promo", "--uuid_table", f"{files}/users.parquet", "--export_covariates", "1"])
    q = figures(f"{tmp_path}/T/qa_summary_T.csv")
    out = spark.read.parquet(f"{tmp_path}/T/user_grid_time_T.parquet")
    assert int(q["input_rows"]) == 1000 and int(q["output_rows"]) == out.count() > 0 and int(q["filtered_poi_category"]) > 0 and float(q["avg_unique_grids_per_user_lunch"]) >= 1
    assert out.columns == ["uuid_hash", "grid_id", "grid_uid", "tau_lunch_min", "tau_dinner_min", "tau_total_min", "n_stops_lunch", "n_stops_dinner"]
    assert spark.read.parquet(f"{tmp_path}/T/user_covariates_T.parquet").count() == spark.read.parquet(f"{files}/users.parquet").count()
    assert (tmp_path / "T" / "run_log_T.txt").read_text()


def test_filled(spark, files, tmp_path):
    args = ["grid-filled", *COMMON, "--staypoints", f"{files}/stays.parquet", "--grid_meta", f"{files}/grid.json", "--out_dir", str(tmp_path), "--id_mode", "both", "--uuid_table", f"{files}/users.parquet", "--drop_uuid_not_in_table", "yes", "--keep_intermediate", "yes"]
    cli.main(args)
    first = figures(f"{tmp_path}/T/qa_summary_grid_strict_filled_T.csv")
    cli.main([*args, "--resume_stage2", "yes"])
    assert figures(f"{tmp_path}/T/qa_summary_grid_strict_filled_T.csv")["lunch__missing_p90"] == first["lunch__missing_p90"]
    assert int(first["output_rows"]) > 0 and first["uid64_uuid_collision_rows"] == "0"
    cli.main(["hex-filled", *COMMON, "--staypoints", f"{files}/stays.parquet", "--hex_meta", f"{files}/hex.json", "--out_dir", str(tmp_path), "--cell_column", "h3_int", "--filter_city_code", "yes", "--city_code_value", "440301"])
    q = figures(f"{tmp_path}/T/qa_summary_hex_strict_filled_T.csv")
    assert int(q["output_rows"]) > 0 and int(q["filtered_oob_hex"]) > 0 and int(q["input_rows"]) < 1000


def test_arguments():
    for t, want in (("TRUE", True), ("y", True), ("off", False), ("0", False)):
        assert cli.truth(t) is want
    with pytest.raises(Exception):
        cli.truth("maybe")
    a = cli.parser().parse_args(["grid-minutes", "--city", "x", "--staypoints", "a", "b", "--grid_meta", "g", "--out_dir", "o"])
    assert (a.windows, a.min_stay_minutes, a.tz_offset_hours, a.timestamps_are_utc, a.buckets) == ("lunch", 5, 8, True, 256)
    a = cli.parser().parse_args(["hex-filled", "--city", "x", "--staypoints", "a", "--hex_meta", "g", "--out_dir", "o"])
    assert (a.windows, a.id_mode, a.output_h3_int, a.point_source_value) == ("lunch,dinner", "uuid", False, "cell_appearance")


def test_the_rest_works_without_the_optional_parts(monkeypatch):
    import builtins
    import importlib
    import sys

    real = builtins.__import__

    def gone(name, *args, **kw):
        if name.startswith(("dwell.llm", "corpus_pipeline")):
            raise ImportError(name)
        return real(name, *args, **kw)

    monkeypatch.setattr(builtins, "__import__", gone)
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    entry = importlib.import_module("__spark_entry__")
    assert "pipeline" not in entry.queries() and "visit_profile" in entry.queries() and not any(k.startswith("op") for k in entry.queries())
    monkeypatch.delitem(sys.modules, "__spark_entry__")
