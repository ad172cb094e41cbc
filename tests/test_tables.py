"""Versions, upserts by partition, checks while writing, and workbooks."""

import datetime as dt
import glob
import os
import zipfile
from xml.sax.saxutils import escape

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from weftline.sources import files, versions, workbooks

FORECASTS = "run_date date, key string, month date, horizon int, model string, units double"
DAY, MAY, JUNE, JULY = dt.date(2024, 5, 2), dt.date(2024, 5, 1), dt.date(2024, 6, 1), dt.date(2024, 7, 1)


def files_of(path):
    """Data files with their times and contents."""
    return {f: (os.stat(f).st_mtime_ns, open(f, "rb").read()) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_upsert_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.upsert_partitions(spark, path, spark.createDataFrame([(DAY, k, m, 1, "a", 1.0) for k in "xy" for m in (MAY, JUNE)], FORECASTS))
    before = files_of(path)
    new = spark.createDataFrame([(DAY, "x", JUNE, 1, "a", 5.0), (DAY, "z", JULY, 1, "a", 7.0), (DAY, "x", JUNE, 2, "a", 6.0)], FORECASTS)
    versions.upsert_partitions(spark, path, new)
    rows = {(r["key"], r["month"], r["horizon"]): r["units"] for r in spark.read.parquet(path).collect()}
    assert rows == {("x", MAY, 1): 1.0, ("y", MAY, 1): 1.0, ("x", JUNE, 1): 5.0, ("y", JUNE, 1): 1.0, ("x", JUNE, 2): 6.0, ("z", JULY, 1): 7.0}
    after = files_of(path)
    same = {f for f in before if "2024-05" in f}
    assert same and all(after[f] == before[f] for f in same) and not any(f in after for f in before if "2024-06" in f)


def test_upsert_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    new = spark.createDataFrame([(DAY, "x", MAY, 1, "a", 1.0), (DAY, "x", MAY, 1, "a", 1.0)], FORECASTS)
    for _ in range(2):
        versions.upsert_partitions(spark, path, new)
        assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError, match="part of the key"):
        versions.upsert_partitions(spark, path, new, partition="units")


def test_versions_of_unlike_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.read_versions(spark, path) is None and versions.read_version(spark, path, "1") is None and versions.versions(spark, path).count() == 0
    one = spark.createDataFrame([("a", 1.0)], "sku string, units double")
    two = spark.createDataFrame([("a", 2.0, "x"), ("b", 3.0, None)], "sku string, units double, variant string")
    assert versions.publish(one, path, "1") == 1 and versions.publish(two, path, "2", ["variant"]) == 2
    assert versions.read_version(spark, path, "2").schema == two.schema and versions.read_version(spark, path, "3") is None
    both = {(r["version"], r["sku"], r["units"], r["variant"]) for r in versions.read_versions(spark, path).collect()}
    assert both == {("1", "a", 1.0, None), ("2", "a", 2.0, "x"), ("2", "b", 3.0, None)}
    assert versions.read_versions(spark, path, ["2", "9"]).count() == 2 and versions.read_versions(spark, path, ["9"]) is None
    with pytest.raises(ValueError, match="committed already"):
        versions.publish(one, path, "1")


def test_failed_versions_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    bad = spark.createDataFrame([(-1.0,), (2.0,), (None,)], "units double")
    with pytest.raises(versions.CheckFailed, match="1 rows break no_negatives"):
        versions.publish(bad, path, "1", checks={"no_negatives": F.col("units") < 0, "small": F.col("units") > 9})
    assert os.path.isdir(f"{path}/data/version=1") and versions.read_versions(spark, path) is None
    versions.publish(bad.where("units > 0"), path, "1")  # the next attempt writes over what the failed one left
    assert [r["units"] for r in versions.read_versions(spark, path).collect()] == [2.0]


def test_union_is_counted_while_written(spark, tmp_path):
    parts = [spark.range(5).withColumn("a", F.lit("x")), spark.range(3)]
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("union", "union")
    assert versions.write_union(parts, str(tmp_path / "u")) == 8
    assert len(jobs.getJobIdsForGroup("union")) == 1  # written and checked by one job
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert spark.read.parquet(str(tmp_path / "u")).where("a is null").count() == 3
    assert files.whole_union(parts).count() == 8


def test_unique(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, None), (None, 3, "y")], "k string, v int, w string")
    assert sorted(map(str, versions.unique(df, "k").collect())) == sorted(map(str, df.collect()))
    with pytest.raises(PySparkException, match="more than one row of b"):
        versions.unique(df.unionByName(df.where("k = 'b'")), "k").select("v").collect()


# Workbooks

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def write_workbook(path, tables):
    """tables: {sheet: rows}; texts are shared or in line in turn, None leaves the cell out."""
    shared = []

    def cell(ref, v):
        if v is None:
            return ""
        if isinstance(v, bool):
            return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
        if isinstance(v, (int, float)):
            return f'<c r="{ref}"><v>{v}</v></c>'
        if isinstance(v, tuple):  # (kind, text) as it is
            return f'<c r="{ref}" t="{v[0]}"><v>{escape(v[1])}</v></c>'
        if len(v) % 2:
            shared.append(v)
            return f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><r><t>{escape(v[:1])}</t></r><r><t>{escape(v[1:])}</t></r></is></c>'

    with zipfile.ZipFile(path, "w") as z:
        names, relations = "", ""
        for k, (name, rows) in enumerate(tables.items(), 1):
            body = "".join(f'<row r="{i}">' + "".join(cell(f"{column(j)}{i}", v) for j, v in enumerate(row)) + "</row>" for i, row in enumerate(rows, 1))
            z.writestr(f"xl/worksheets/sheet{k}.xml", f"<worksheet {MAIN}><cols/><sheetData>{body}</sheetData></worksheet>")
            names += f'<sheet name="{escape(name)}" sheetId="{k}" r:id="rId{k}"/>'
            relations += f'<Relationship Id="rId{k}" Type="t" Target="{"/xl/" if k == 2 else ""}worksheets/sheet{k}.xml"/>'
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{names}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{relations}</Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>" + "".join(f"<si><t>{escape(s)}</t></si>" for s in shared) + "</sst>")


def column(k):
    return chr(65 + k) if k < 26 else chr(64 + k // 26) + chr(65 + k % 26)


def test_places():
    assert [workbooks.place(c) for c in ("A1", "Z9", "AA10", "AB3", "BA7")] == [0, 25, 26, 27, 52]


SCHEMA = "order string, qty double, n int, day date, at timestamp_ntz, open boolean, missing string, source_file string, source_sheet string"


def test_workbooks(spark, tmp_path):
    head = ["n", "order", " qty ", "day", "at", "open", "extra"]
    write_workbook(tmp_path / "b.xlsx", {"Lines": [[], head, [1, "A & B", 2.5, 45413, 45413.75, True, "x"], [None] * 7, [2, 17.0, "n/a", "2024-05-02", None, "FALSE", None], [1.5, ("e", "#N/A"), 3, "never", "2024-05-02T06:00:00", 7]], "More <1>": [["order", "qty"], ["odd", 1e3]]})
    write_workbook(tmp_path / "a.xlsx", {"Lines": [["qty", "order"], [4, "last"]], "Empty": [], "Head only": [["order"]]})
    (tmp_path / "notes.txt").write_text("not a workbook")
    rows = {(r["source_file"], r["source_sheet"], r["order"]): r.asDict() for r in workbooks.read_workbooks(spark, str(tmp_path), SCHEMA).collect()}
    assert set(rows) == {("b.xlsx", "Lines", "A & B"), ("b.xlsx", "Lines", "17"), ("b.xlsx", "Lines", None), ("b.xlsx", "More <1>", "odd"), ("a.xlsx", "Lines", "last")}
    r = rows["b.xlsx", "Lines", "A & B"]
    assert (r["qty"], r["n"], r["day"], r["at"], r["open"], r["missing"]) == (2.5, 1, dt.date(2024, 5, 1), dt.datetime(2024, 5, 1, 18), True, None)
    r = rows["b.xlsx", "Lines", "17"]
    assert (r["qty"], r["n"], r["day"], r["at"], r["open"]) == (None, 2, dt.date(2024, 5, 2), None, False)
    r = rows["b.xlsx", "Lines", None]
    assert (r["qty"], r["n"], r["day"], r["at"], r["open"]) == (3.0, None, None, dt.datetime(2024, 5, 2, 6), None)
    assert rows["b.xlsx", "More <1>", "odd"]["qty"] == 1000.0 and rows["a.xlsx", "Lines", "last"]["qty"] == 4.0


def test_workbook_partitions_and_options(spark, tmp_path):
    write_workbook(tmp_path / "a.xlsx", {"One": [["é", 1], ["b", 2]], "Two": [["c", 3]] * 500})
    source = spark.read.format("workbook").schema("k string, v int")
    found = source.option("header", "false").load(str(tmp_path / "a.xlsx"))
    assert found.rdd.getNumPartitions() == 2 and found.count() == 502 and found.first()["k"] == "é"
    assert source.option("header", "false").option("sheet", "One").load(f"file://{tmp_path}/a.xlsx").count() == 2
    for bad in (source.option("sheet", "None").load(str(tmp_path)), source.load(str(tmp_path / "gone.xlsx"))):
        with pytest.raises(PySparkException):
            bad.collect()


def test_order_workbooks_become_clean_lines(spark, tmp_path):
    """Two extracts, one written with a column more, united with their provenance and cleaned."""
    from weftline.operators import etl

    base = ["order_number", "line_number", "bo_number", "Invoice Date", "acct_year", "acct_period", "item_category", "item_number", "original_item", "Shipped", "returned_qty", "cancel_qty"]
    write_workbook(tmp_path / "2023.xlsx", {"S": [base, [17, 1, 0, 45306, 2024, 1, "men's t-shirt", "a", "a", 3, 0, None]]})
    write_workbook(tmp_path / "2024.xlsx", {"S": [[*base, "note"], [18, 1, 0, None, 2024, 2, "SHOES", "b", "c", "2", 1, 0, "late"]]})
    schema = ", ".join(f"`{c}` string" for c in base if c != "Invoice Date") + ", `Invoice Date` date, source_file string"
    raw = workbooks.read_workbooks(spark, str(tmp_path), schema).withColumnRenamed("Shipped", "shipped_qty")
    clean = etl.clean_lines(raw, {"Invoice Date": "invoice_date"}, ["shipped_qty", "returned_qty", "cancel_qty"])
    rows = {r["source_file"]: r for r in clean.collect()}
    assert rows["2023.xlsx"]["demand_month"] == dt.date(2024, 1, 1) and rows["2024.xlsx"]["demand_month"] == dt.date(2024, 2, 1)
    assert rows["2023.xlsx"]["item_category"] == "Men'S T-Shirt" and rows["2024.xlsx"]["is_substituted"] == 1 and rows["2024.xlsx"]["shipped_qty"] == 2.0
    assert {r["source_file"]: r["n_rows"] for r in files.listed(raw).collect()} == {"2023.xlsx": 1, "2024.xlsx": 1}
