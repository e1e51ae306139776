import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from regionscore import schemas
from regionscore.landing import landing_folder
from regionscore.sources import cubes, tables

DIMS = {"R": {"category": {"index": {"b": 1, "a": 0}, "label": {"a": "A", "b": "B"}}},
        "T": {"category": {"index": ["x", "y", "z"], "label": {"x": "X"}}}}


def cube(value, **extra):
    return {"id": ["R", "T"], "size": [2, 3], "dimension": DIMS, "value": value, **extra}


def flat(spark, doc):
    df = spark.createDataFrame([(json.dumps(doc),)], "doc string")
    return [tuple(r) for r in cubes.jsonstat_to_long(df, ["R", "T"]).collect()]


DENSE = [("a", "A", "x", "X", 1.0), ("a", "A", "y", "y", 2.0), ("a", "A", "z", "z", None),
         ("b", "B", "x", "X", 4.0), ("b", "B", "y", "y", 5.0), ("b", "B", "z", "z", 6.0)]


@pytest.mark.parametrize("wrap", [lambda d: d, lambda d: {"dataset": d}, lambda d: [d]])
def test_dense_cube_and_envelopes(spark, wrap):
    assert flat(spark, wrap(cube([1, 2, None, 4, 5, 6]))) == DENSE


def test_cells_beyond_the_cube_are_dropped(spark):
    assert flat(spark, cube([1, 2, None, 4, 5, 6, 7, 8])) == DENSE
    assert flat(spark, cube([1, 2])) == DENSE[:2]


def test_sparse_cube(spark):
    assert [r[-1] for r in flat(spark, cube({"4": 5, "0": 1}))] == [1.0, None, None, None, 5.0]


def test_index_may_be_absent(spark):
    doc = cube([1, 2, 3, 4, 5, 6])
    doc["dimension"] = {**DIMS, "R": {"category": {"label": {"b": "B", "a": "A"}}}}
    assert [r[0] for r in flat(spark, doc)] == ["b", "b", "b", "a", "a", "a"]


def test_many_documents_of_different_shape(spark):
    other = {"id": ["T", "R"], "size": [1, 1], "value": [9],
             "dimension": {"T": {"category": {"index": {"q": 0}}}, "R": {"category": {"index": {"c": 0}}}}}
    df = spark.createDataFrame([(1, json.dumps(cube([1]))), (2, json.dumps(other))], "n int, doc string")
    got = sorted(tuple(r) for r in cubes.jsonstat_to_long(df, ["R", "T"], keep=["n"]).select("n", "R_code", "T_code", "value").collect())
    assert got == [(1, "a", "x", 1.0), (2, "c", "q", 9.0)]


def test_px_documents(spark, rows):
    doc = {"data": [{"key": ["180", "x"], "values": ["91.5"]}, {"key": ["0181"], "values": [".."]}, {"key": ["182"], "values": ["0"]},
                    {"key": ["0180"], "values": ["92"]}, {"key": ["183"], "values": []}]}
    df = spark.createDataFrame([(json.dumps(doc),)], "doc string")
    assert rows(cubes.pxjson_to_long(df)) == [("0180", 92.0)]


def test_slice(spark, rows):
    long = spark.createDataFrame(
        [("0301", "Oslo - Test", kind, year, 100.0 + i) for i, (kind, year) in enumerate([("01", "2024"), ("02", "2024"), ("00", "2024"), ("01", "2018")])]
        + [("0301", "Oslo - Test", "01", str(y), 1.0) for y in range(2020, 2024)]
        + [("9999", "Gone (-2019)", "01", "2024", 5.0), ("1", "Null", "01", "2024", None)],
        "Region_code string, Region string, Boligtype_code string, Tid_code string, value double")
    out = cubes.read_slice(long, cubes.SLICES_NO["price_sqm"])
    assert out.columns == ["municipality_code", "municipality", "year", "price_sqm", "municipality_clean"]
    assert rows(out, "year", "price_sqm", "municipality_clean") == [(str(y), 1.0, "oslo") for y in range(2020, 2024)] + [("2024", 100.0, "oslo"), ("2024", 101.0, "oslo")]


def test_cubes_of_one_small_file_are_flattened_in_all_tasks(spark, tmp_path):
    from catalog.documents import _slice_cube

    spark.createDataFrame([(1, 3, 10.0), (2, 4, -1.5)], "c_custkey long, c_nationkey int, c_acctbal double").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    long = _slice_cube(spark, str(tmp_path), cubes.SLICES_SE["construction"])
    assert long.count() == 2 * 3 * 6
    assert long.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_every_slice_reads_a_cube_with_its_dimensions(spark):
    for spec in [*cubes.SLICES_NO.values(), *cubes.SLICES_SE.values()]:
        dims = {c[:-5] if c.endswith("_code") else c for c in spec.columns} | set(spec.items) | {spec.period}
        one = {d: (spec.items.get(d) or ("2024",))[0] for d in dims}
        row = [(*one.values(), *one.values(), 3.0)]
        long = spark.createDataFrame(row, [*(f"{d}_code" for d in one), *one, "value"])
        out = cubes.read_slice(long, spec)
        assert out.count() == 1 and {*spec.columns.values(), spec.value} <= set(out.columns)


def test_series_documents(spark, rows):
    df = spark.createDataFrame([("no", ["2024-01-01T00:00:00", "2024-02-01"], [1.5, None])], "country string, dates array<string>, values array<double>")
    assert [(c, str(d), v) for c, d, v in rows(tables.series_to_long(df, ["country"]))] == [("no", "2024-01-01", 1.5)]


def test_regions_from_document(spark, rows, tmp_path):
    doc = {"municipalities": [{"code": "0301", "name": "Oslo", "region_code": "03", "region_name": "Oslo", "rent_zone": "01"},
                              {"code": "3201", "name": "Bærum", "region_code": "32", "region_name": "Akershus"}]}
    (tmp_path / "no.json").write_text(json.dumps(doc, indent=1))
    assert rows(tables.load_regions(spark, str(tmp_path / "no.json"), "norway")) == [
        ("0301", "Oslo", "03", "Oslo", "01"), ("3201", "Bærum", "32", "Akershus", "99")]
    doc = {"municipalities": [{"code": "0180", "name": "Stockholm", "county": "01", "county_name": "Stockholms län"}]}
    (tmp_path / "se.json").write_text(json.dumps(doc))
    assert rows(tables.load_regions(spark, str(tmp_path / "se.json"), "sweden")) == [("0180", "Stockholm", "01", "Stockholms län", "7.00")]


def test_named_table_or_empty(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "there.parquet"))
    assert tables.load_table(spark, str(tmp_path), "there", "id long").count() == 3
    missing = tables.load_table(spark, str(tmp_path), "missing", schemas.REGION_GROWTH)
    assert missing.count() == 0 and missing.schema == schemas.REGION_GROWTH


def test_records_and_csv(spark, rows, tmp_path):
    df = spark.createDataFrame([("0301", 1.5), ("0302", None)], "code string, v double")
    tables.write_records(df, str(tmp_path / "r"))
    assert rows(tables.read_records(spark, str(tmp_path / "r"), df.schema)) == rows(df)
    tables.export_csv(df, str(tmp_path / "c"), ["v", "absent", "code"])
    back = spark.read.csv(str(tmp_path / "c"), header=True)
    assert back.columns == ["v", "code"] and rows(back) == [("1.5", "0301"), (None, "0302")]


def test_ragged_rows_and_fixed_columns(spark, rows):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([(2, 0.5)], "i int, d double")
    assert rows(tables.union_ragged([a, b]), "i", "s", "d") == [(1, "x", None), (2, None, 0.5)]
    out = tables.with_columns_in_order(a, schemas.RENT_GRID)
    assert out.columns == ["zone", "sqm", "monthly_rent"] and tuple(out.first()) == (None, None, None)


def test_stored_cubes_read_only_the_latest_periods(spark, tmp_path, rows):
    spec = cubes.SLICES_NO["construction"]
    data = [(r, f"Name {r}", b, f"202{q // 4}K{q % 4 + 1}", float(q)) for r in ("0301", "4601") for b in ("111", "142", "zz") for q in range(10)]
    long = spark.createDataFrame(data, "Region_code string, Region string, Byggeareal_code string, Tid_code string, value double")
    path = str(tmp_path / "cube")
    cubes.write_cube(long, path, "Tid")
    cubes.write_cube(long.limit(0), path, "Tid")
    got = cubes.stored_slice(spark, path, long.schema, spec, ["Byggeareal_code"])
    want = cubes.read_slice(long, spec, ["Byggeareal_code"])
    assert got.columns == want.columns and rows(got) == rows(want) and got.count() == 2 * 2 * 8
    assert len({r.f.rsplit("/", 2)[1] for r in got.select(F.input_file_name().alias("f")).collect()}) == 8
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2020K3" in plan.split("PartitionFilters")[1]
    assert rows(cubes.stored_slice(spark, path, long.schema, cubes.replace(spec, latest=None)))  == rows(cubes.read_slice(long, cubes.replace(spec, latest=None)))


def test_cells_are_written_where_they_are_made(spark, rows, tmp_path):
    """No shuffle and no sort for the folders of periods, and the session's setting stays as it was."""
    data = [(r, "111", f"202{q // 4}K{q % 4 + 1}" if q < 39 else None, float(q)) for r in ("0301", "4601") for q in range(40)]
    long = spark.createDataFrame(data, "Region_code string, Byggeareal_code string, Tid_code string, value double").repartition(3)
    path, name = str(tmp_path / "cube"), "spark.sql.maxConcurrentOutputFileWriters"
    for periods, before in ((cubes.OPEN_PERIODS, "0"), (2, "5")):
        spark.conf.set(name, before)
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(cubes, "OPEN_PERIODS", periods)
            cubes.write_cube(long, path, "Tid")
        assert spark.conf.get(name) == before
    spark.conf.unset(name)
    stored = spark.read.schema(long.schema).parquet(path)
    assert rows(stored, *long.columns) == rows(long.union(long))
    assert len({r.f for r in stored.select(F.input_file_name().alias("f")).collect()}) > 2 * 40


def test_one_cube_at_a_time_is_on_disk(spark, tmp_path):
    """What is left of the slices is their rows: a cube's table goes when its slice is landed."""
    from catalog import documents

    folder = Path(landing_folder(spark).removeprefix("file:"))
    before = {p.name for p in folder.glob("*")}
    spark.createDataFrame([(k, k % 3, k * 1.5) for k in range(7)] + [(7, 1, None)], "c_custkey long, c_nationkey int, c_acctbal double").write.parquet(str(tmp_path / "customer.parquet"))
    slices = {n: cubes.SLICES_SE[n] for n in ("population", "employment")}
    out = documents._slices(spark, str(tmp_path), slices)
    left = [p for p in folder.glob("*") if p.name not in before]
    assert len(left) == len(slices) and not [p for p in left if list(p.glob("Tid_code=*"))]
    counts = {r["slice"]: r["count"] for r in out.groupBy("slice").count().collect()}
    assert counts == {"population": 8, "employment": 7 * 2}
