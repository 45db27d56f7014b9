import pytest

from cargotide.operators.scoring import compare_runs, mode_delta, run_scores
from cargotide.sources import readers as R, writers as W
from conftest import day, days

HEAD = "ACTUALSHIPDATE,WHSEID,CATEGORY,BRAND,Total QTY,Total CBM,Week,Day\n"


def test_read_years_warns_and_fails(spark, tmp_path):
    for year in (2023, 2024):
        (tmp_path / f"data_{year}.csv").write_text(HEAD + f"{year}-05-01,W1,DRY,A,1,2,1.Monday,1\n")
    with pytest.warns(UserWarning):
        rows = R.read_years(spark, str(tmp_path), [2023, 2024, 2025]).collect()
    assert {r.ACTUALSHIPDATE.year for r in rows} == {2023, 2024} and rows[0]["Total CBM"] == 2.0
    with pytest.raises(FileNotFoundError), pytest.warns(UserWarning):
        R.read_years(spark, str(tmp_path), [1999])


@pytest.mark.parametrize("name,year", [("Outboundreports_20240101_20241231.csv", 2024), ("data_2023.csv", 2023),
                                       ("x_2025_final.csv", 2025), ("x_1890.csv", None), ("none.csv", None)])
def test_year_of_name(name, year):
    assert R.year_of_name(name) == year


def test_prefix_range_and_lineage(spark, tmp_path):
    head = "ACTUALSHIPDATE,WHSEID,SKU,CATEGORY,QTY,CUBE_OUT\n"
    (tmp_path / "Outboundreports_20240101_20240131.csv").write_text(head + "2024-01-05 10:00:00,W,1,DRY,1,1\n2024-01-25 23:00:00,W,1,DRY,2,1\n")
    (tmp_path / "Outboundreports_20240201_20240229.csv").write_text(head + "2024-02-05 10:00:00,W,1,DRY,4,1\n")
    (tmp_path / "Outboundreports_20230101_20230131.csv").write_text(head + "2023-01-05 10:00:00,W,1,DRY,8,1\n")
    (tmp_path / "other_2024.csv").write_text(head)
    rows = R.read_by_prefix(spark, str(tmp_path), "Outboundreports", [2024]).collect()
    assert sorted(r.QTY for r in rows) == [1.0, 2.0, 4.0] and all("2024" in r.source_file for r in rows)
    got = R.read_date_range(spark, str(tmp_path), "2024-01-25", "2024-02-05").collect()
    assert sorted(r.QTY for r in got) == [2.0, 4.0]
    names = spark.createDataFrame([("Outboundreports_20240101_20240131.csv",), ("Outboundreports_2024_a.csv",), ("Outboundreports_old.csv",)], "name string")
    kept = {r.name for r in R.prune_files_by_range(names, "2024-01-31", "2024-03-01").collect()}
    assert kept == {"Outboundreports_20240101_20240131.csv", "Outboundreports_2024_a.csv"}


def test_columns_by_name_and_mixed_times(spark, tmp_path):
    (tmp_path / "Outboundreports_20240101_20240131.csv").write_text("ORDERID,SKU,WHSEID,ACTUALSHIPDATE,CUBE_OUT,QTY,CATEGORY\n9,1,W,15/01/2024 18:30:00,5,2,DRY\n9,1,W,2024-01-15T18:30:00.250,5,2,DRY\n")
    (tmp_path / "Outboundreports_20240201_20240229.csv").write_text("ACTUALSHIPDATE,WHSEID,SKU,CATEGORY,QTY,CUBE_OUT\n1/2/2024 9:05,W,1,FRESH,4,1\n02/13/2024,W,1,DRY,6,1\nnone,W,1,DRY,8,1\n")
    rows = R.read_by_prefix(spark, str(tmp_path), "Outboundreports", [2024]).collect()
    got = {(str(r.ACTUALSHIPDATE), r.SKU, r.CATEGORY, r.QTY, r.CUBE_OUT) for r in rows}
    assert got == {("2024-01-15 18:30:00", "1", "DRY", 2.0, 5.0), ("2024-01-15 18:30:00.250000", "1", "DRY", 2.0, 5.0), ("2024-02-01 09:05:00", "1", "FRESH", 4.0, 1.0),
                   ("2024-02-13 00:00:00", "1", "DRY", 6.0, 1.0), ("None", "1", "DRY", 8.0, 1.0)}
    (tmp_path / "Outboundreports_20240301_20240331.csv").write_text("ACTUALSHIPDATE,SKU\n1/3/2024,1\n")
    with pytest.raises(ValueError):
        R.read_by_prefix(spark, str(tmp_path), "Outboundreports", [2024])
    (tmp_path / "a b.csv").write_text("v,name\n3,x\n")
    assert R.read_csv_with_encoding(spark, [str(tmp_path / "a b.csv")], "name string, v int").first().v == 3


def test_mixed_encodings(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("name,v\nPhở,1\n".encode("utf-8"))
    (tmp_path / "b.csv").write_bytes("name,v\nCafé,2\n".encode("latin-1"))
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv")]
    rows = R.read_csv_with_encoding(spark, paths, "name string, v int").collect()
    assert {r.name: r.v for r in rows} == {"Phở": 1, "Café": 2}
    with pytest.raises(ValueError):
        R.read_csv_with_encoding(spark, paths, "name string, v int", ["utf-8"])


def test_panel_and_forecast_sinks(spark, tmp_path):
    panel = spark.createDataFrame([(d, "W", "DRY", "A", 1.0, 2.0) for d in days("2023-12-30", 4)],
                                  "ACTUALSHIPDATE date, WHSEID string, CATEGORY string, BRAND string, `Total QTY` double, `Total CBM` double")
    W.write_panel(panel, str(tmp_path / "p"))
    back = spark.read.parquet(str(tmp_path / "p"))
    assert {r.year: r["count"] for r in back.groupBy("year").count().collect()} == {2023: 2, 2024: 2}
    assert back.filter("Week = '1.Monday'").first().ACTUALSHIPDATE == day("2024-01-01")
    f = spark.createDataFrame([(d, "DRY", b, 1.0) for d in days("2023-12-30", 4) for b in "BA"], "date date, CATEGORY string, BRAND string, predicted double")
    W.write_forecasts(f, str(tmp_path / "f"))
    rows = W.combined_forecasts(spark, str(tmp_path / "f")).collect()
    assert [(r.date, r.BRAND) for r in rows] == [(d, b) for d in days("2023-12-30", 4) for b in "AB"]


def test_upsert_table_and_append(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", 1.0)], "k int, n string, v double")
    old.write.parquet(str(tmp_path / "t"))
    path = W.upsert_table(spark, str(tmp_path / "t"), spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, v double"), ["k"])
    assert {r.k: (r.n, r.v) for r in spark.read.parquet(path).collect()} == {1: ("a", 2.0), 2: (None, 3.0)}
    W.append_rows(spark, str(tmp_path / "t"), spark.createDataFrame([(5, 9.0)], "k int, v double"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_runs(spark, tmp_path):
    for run, mode, p in (("20250101_000000", "teacher_forcing", 2.0), ("20250101_000000", "recursive", 3.0),
                         ("20250201_000000", "teacher_forcing", 1.5)):
        folder = tmp_path / f"run_{run}"
        folder.mkdir(exist_ok=True)
        (folder / f"predictions_{mode}.csv").write_text(f"predicted,actual\n{p},1.0\n9.0,\n")
    rows = R.read_runs(spark, str(tmp_path), "predicted double, actual double")
    scores = run_scores(rows)
    assert {(r.run_id, r.mode): r.mae for r in scores.collect()} == {
        ("run_20250101_000000", "teacher_forcing"): 1.0, ("run_20250101_000000", "recursive"): 2.0, ("run_20250201_000000", "teacher_forcing"): 0.5}
    assert compare_runs(scores, "run_20250201_000000").first().mae_improvement_pct == pytest.approx(50.0)
    delta = {r.run_id: r.mae_increase_pct for r in mode_delta(scores).collect()}
    assert delta == {"run_20250101_000000": 100.0, "run_20250201_000000": None}


def test_headers_of_many_files_take_one_job(spark, tmp_path):
    orders = ["k,v", "v,k,extra", "extra,k,v"]
    for n in range(60):
        head = orders[n % 3]
        cells = {"k": f"key{n}", "v": str(n), "extra": '"a,b"'}
        (tmp_path / f"data_{2000 + n}.csv").write_text(head + "\n" + (",".join(cells[c] for c in head.split(",")) + "\n") * 3000)
    (tmp_path / "data_2060.csv").write_text("")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("heads", "heads")
    rows = R.read_years(spark, str(tmp_path), range(2000, 2061), schema="k string, v int")
    jobs = len(tracker.getJobIdsForGroup("heads"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 3  # listing many files, then the heads
    assert rows.count() == 60 * 3000 and rows.filter("k = concat('key', v)").count() == 60 * 3000
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(1 << 50)
    (tmp_path / "data_2061.csv").write_bytes("v,k,Prix é\n7,x,1\n".encode("latin-1"))
    assert R.read_years(spark, str(tmp_path), [2061], schema="k string, v int", encoding="ISO-8859-1").first().v == 7
    assert R.read_years(spark, str(tmp_path), [2061], schema="k string, v int, `Prix é` int", encoding="ISO-8859-1").first()["Prix é"] == 1


def test_zones_and_half_days(spark):
    from cargotide.functions.cleaning import parse_mixed_timestamp

    texts = {"2025-01-15T18:30:00Z": "2025-01-15 18:30:00", "2025-01-15T18:30:00+07:00": "2025-01-15 11:30:00", "2025-01-15 01:00:00-0530": "2025-01-15 06:30:00",
             "2025-01-15 01:00:00.5+07": "2025-01-14 18:00:00.500000", "15/1/2025 10:00 AM": "2025-01-15 10:00:00", "15/1/2025 12:05:09 am": "2025-01-15 00:05:09",
             "15/1/2025 12:05 p.m.": "2025-01-15 12:05:00", "1/15/2025 3:07PM": "2025-01-15 15:07:00", "15-01-2025": "2025-01-15 00:00:00", "2025/1/5 7:08": "2025-01-05 07:08:00",
             "2025-01-15 18:30": "2025-01-15 18:30:00", "pm": None, "": None, "Z": None, "15/15/2025 1:00 PM": None}
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = {r.t: r.p for r in df.select("t", parse_mixed_timestamp("t").cast("string").alias("p")).collect()}
    assert {t: None if p is None else p[:26] for t, p in got.items()} == {**{t: None if p is None else p.rstrip("0").rstrip(".") if "." in p else p for t, p in texts.items()}, None: None}


def test_rejects_are_told_apart_and_observed(spark, tmp_path):
    from pyspark.sql import Observation

    from cargotide.operators import rejects as J
    from cargotide.plans.jobs import panel_job

    head = "ACTUALSHIPDATE,WHSEID,SKU,CATEGORY,QTY,CUBE_OUT\n"
    lines = ["2024-05-01 10:00:00,W,1,,2,1", "soon,W,1,,2,1", "2024-05-01,W,1,,x,1", ",W,1,,2,1", "2024-05-01,W,,,2,1", "2024-05-01,W,99,,2,1", "2024-05-01,W,2,,2,1",
             "2024-05-01,,1,,2,1", "2024-05-02,W, 1 ,,3,", "bad,W,99,,2,1"]
    (tmp_path / "Outboundreports_20240501_20240531.csv").write_text(head + "\n".join(lines) + "\n")
    raw = R.read_by_prefix(spark, str(tmp_path), "Outboundreports", [2024], unreadable="unreadable")
    master = spark.createDataFrame([("1", "A", "DRY"), ("2", "B", "TEST")], "SKU string, BRAND string, CATEGORY string")
    assert {r.unreadable for r in raw.collect()} == {None, "ACTUALSHIPDATE", "QTY"}
    known = J.mark_lines(raw, master.withColumnRenamed("CATEGORY", "CATEGORY_MASTER"), unreadable="unreadable")
    assert {r.reject_reason: r.lines for r in J.reject_counts(known).collect()} == {
        "unreadable": 3, "missing_date": 1, "missing_sku": 1, "unknown_sku": 1, "excluded_category": 1, "missing_key": 1}
    counts = Observation("rejects")
    panel = panel_job(raw, master, str(tmp_path / "panel"), rejects=counts, unreadable="unreadable")
    assert counts.get == {"lines": 10, "good": 2, "unreadable": 3, "missing_date": 1, "missing_sku": 1, "unknown_sku": 1, "excluded_category": 1, "missing_key": 1}
    assert panel.agg({"Total QTY": "sum"}).first()[0] == 5.0
    plain = panel_job(raw.filter("unreadable IS NULL").drop("unreadable"), master, str(tmp_path / "plain"))
    assert plain.orderBy("ACTUALSHIPDATE").collect() == panel.orderBy("ACTUALSHIPDATE").collect()


def test_upsert_replaces_only_the_folders_of_new_rows(spark, tmp_path):
    path = tmp_path / "t"
    spark.createDataFrame([(y, k, "n", float(k)) for y in (2022, 2023, 2024) for k in range(3)], "y int, k int, n string, v double").write.partitionBy("y").parquet(str(path))
    files = {y: sorted(p.name for p in (path / f"y={y}").glob("part-*")) for y in (2022, 2023, 2024)}
    new = spark.createDataFrame([(2023, 1, 10.0), (2023, 2, None), (2023, 9, 90.0), (2025, 1, 1.0)], "y int, k int, v double")
    W.upsert_partitions(spark, str(path), new, ["y", "k"], ["y"])
    got = {(r.y, r.k): (r.n, r.v) for r in spark.read.parquet(str(path)).collect()}
    assert got == {**{(y, k): ("n", float(k)) for y in (2022, 2023, 2024) for k in range(3)}, (2023, 1): ("n", 10.0), (2023, 9): (None, 90.0), (2025, 1): (None, 1.0)}
    after = {y: sorted(p.name for p in (path / f"y={y}").glob("part-*")) for y in (2022, 2023, 2024)}
    assert after[2022] == files[2022] and after[2024] == files[2024] and after[2023] != files[2023]
    W.upsert_partitions(spark, str(path), new.limit(0), ["y", "k"], ["y"])
    assert spark.read.parquet(str(path)).count() == len(got)
    with pytest.raises(Exception, match="null in y"):
        W.upsert_partitions(spark, str(path), spark.createDataFrame([(None, 1, 1.0)], "y int, k int, v double"), ["y", "k"], ["y"])
    with pytest.raises(ValueError):
        W.upsert_partitions(spark, str(path), new.withColumn("extra", new.v), ["y", "k"], ["y"])
    assert spark.read.parquet(str(path)).count() == len(got)


def test_each_text_is_parsed_once(spark, tmp_path):
    """Values and their `unreadable` names come from one parse; layouts are only tried on texts of their shape."""
    from cargotide.functions.cleaning import SHAPES

    (tmp_path / "Outboundreports_20240101_20240131.csv").write_text(
        "ACTUALSHIPDATE,WHSEID,SKU,CATEGORY,QTY,CUBE_OUT\n13/01/2024 07:00:00 PM,W,1,DRY,many,1\n01/13/2024,W,2,DRY,1,1\n2024-01-13T19:00:00+07:00,W,3,DRY,1,1\n"
        "32/01/2024,W,4,DRY,1,1\nsoon,W,5,DRY,1,1\n,W,6,DRY,1,1\n")
    rows = R.read_by_prefix(spark, str(tmp_path), "Outboundreports", [2024], source_column=None, unreadable="bad")
    plan = rows.select("SKU", "ACTUALSHIPDATE", "QTY", "bad")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("gettimestamp") == len(SHAPES)
    got = {r.SKU: (str(r.ACTUALSHIPDATE), r.bad) for r in rows.collect()}
    assert got == {"1": ("2024-01-13 19:00:00", "QTY"), "2": ("2024-01-13 00:00:00", None), "3": ("2024-01-13 12:00:00", None),
                   "4": ("None", "ACTUALSHIPDATE"), "5": ("None", "ACTUALSHIPDATE"), "6": ("None", None)}


def test_heads_of_files_in_splits(spark, tmp_path):
    """The first line is found where a file is read in several splits, without a Python worker."""
    (tmp_path / "a.csv").write_text("x,y\n" + "1,2\n" * 5000)
    (tmp_path / "b.csv").write_text("y,x\n3,4\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        heads = R.file_heads(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv")])
        assert "MapInArrow" not in heads._jdf.queryExecution().executedPlan().toString()
        assert {bytes(r.head).decode() for r in heads.collect()} == {"x,y", "y,x"} and heads.count() == 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
