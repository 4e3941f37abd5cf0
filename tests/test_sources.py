"""Sources and sinks: European CSV, result tables, packs, metadata, name rules."""

import os
import tempfile

from pyspark.sql import functions as F

from sensorgrid.functions.columns import (drop_by_regex, numeric_columns, pick_target_column,
                                          pollutant_candidates, priority_features)
from sensorgrid.sources.csv_eu import read_eu_csv, read_eu_csv_raw
from tests.conftest import ts

RAW = """Date;Time;CO(GT);PT08.S1(CO);NMHC(GT);T;;
10/03/2004;18.00.00;2,6;1360;150;13,6;;
10/03/2004;19:00:00;2;1292;-200;13,3;;
10/03/2004;20.00.00;junk;1402;88;11,9;;
99/99/2004;21.00.00;1,1;1376;80;11,0;;
;;;;;;;
"""


def write_raw(text):
    d = tempfile.mkdtemp(prefix="sg-csv-")
    p = os.path.join(d, "AirQuality.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_eu_csv(spark):
    p = write_raw(RAW)
    raw = read_eu_csv_raw(spark, p)
    assert [c for c in raw.columns if c.startswith("Unnamed")] == ["Unnamed: 6", "Unnamed: 7"]
    typed = read_eu_csv(spark, p)
    assert typed.columns == ["ts", "CO(GT)", "PT08.S1(CO)", "NMHC(GT)", "T"]
    rows = typed.orderBy(F.col("ts").asc_nulls_last()).collect()
    assert len(rows) == 4  # the blank trailing line is dropped
    assert rows[0]["ts"] == ts("2004-03-10 18:00") and rows[0]["CO(GT)"] == 2.6
    assert rows[1]["ts"] == ts("2004-03-10 19:00") and rows[1]["NMHC(GT)"] == -200.0
    assert rows[2]["CO(GT)"] is None  # junk -> NULL
    assert rows[3]["ts"] is None      # invalid date -> NULL


def test_eu_csv_too_few_timestamps(spark):
    import pytest
    with pytest.raises(RuntimeError):
        read_eu_csv(spark, write_raw(RAW), min_valid=100)


def test_name_rules(spark):
    cols = ["AH", "CO(GT)", "PT08.S1(CO)", "NMHC(GT)", "C6H6(GT)", "T", "RH", "NOx(GT)", "NO2(GT)",
            "CO(GT)__was_missing", "target_reg", "target_cls"]
    assert pick_target_column(cols) == "CO(GT)"
    assert pick_target_column(["x", "y"], ["y"]) == "y"
    assert pollutant_candidates(cols) == ["CO(GT)", "C6H6(GT)", "NOx(GT)", "NO2(GT)"]
    pf = priority_features(cols, exclude=["target_reg", "target_cls"])
    assert pf == sorted(pf) and "target_reg" not in pf and len(pf) <= 12
    df = spark.createDataFrame([(1, 2.0, "a", None)], "a int, b double, c string, `Unnamed: 3` string")
    assert drop_by_regex(df).columns == ["a", "b", "c"]
    assert numeric_columns(df) == ["a", "b"]


def test_result_tables_roundtrip(spark):
    from sensorgrid.session import scratch_path
    from sensorgrid.sources.results import read_result_tables, write_result_table
    base = scratch_path(spark, "res-test")
    a = spark.createDataFrame([("Ridge", "CO(GT)", 1, 0.5, 1.0, 1.0, 10.0)],
                              "model string, pollutant string, horizon_h int, R2 double, RMSE double, MAE double, `MAPE(%)` double")
    b = spark.createDataFrame([("GBDT", "NO2(GT)", "24h", 0.4, 2.0, 1.5, 12.0), ("X_TUNED", "NO2(GT)", "6h", 0.9, 1.0, 1.0, 1.0)],
                              "model string, pollutant string, horizon string, R2 double, RMSE double, MAE double, MAPE double")
    write_result_table(a, f"{base}/a_results.csv")
    write_result_table(b, f"{base}/b_results.csv")
    write_result_table(a, f"{base}/tuned_tree_results.csv")
    got = sorted((r.model, r.horizon_h, r["MAPE(%)"]) for r in read_result_tables(spark, base).collect())
    assert got == [("GBDT", 24, 12.0), ("Ridge", 1, 10.0)]


def test_many_unlike_tables_are_one_scan(spark):
    from sensorgrid.session import local_path, scratch_path
    from sensorgrid.sources.results import read_result_tables, scan_tables
    base = scratch_path(spark, "res-many")
    folder = local_path(base)
    os.makedirs(folder)

    def table(name, text):
        with open(f"{folder}/{name}.csv", "w", encoding="utf-8") as f:
            f.write(text)
    for i in range(300):
        names = ["model", "R2", "pollutant", "horizon_h", *[f"x{j}" for j in range(i % 7)]]
        names = names[i % 4:] + names[:i % 4]
        value = {"model": f'"m,{i}"', "R2": str(i / 1000), "pollutant": "CO(GT)", "horizon_h": "6h"}
        table(f"t{i:03d}", "\n" + ",".join(names) + "\n" + ",".join(value.get(n, "7") for n in names) + "\n")
    table("bom", "\ufeffmodel,pollutant,horizon,R2,RMSE,MAE,MAPE,run_id\nA,CO(GT),24,0.5,1,2,3,9\nA,CO(GT),24,,1,2,3,9\nmy_tuned,CO(GT),24,1,1,2,3,9\n")
    table("both", 'model,pollutant,horizon_h,R2,RMSE,MAE,MAPE(%),MAPE\n"B ""q""",CO(GT),1,nan,1,2,3,4\nB,CO(GT),1,0.25,1,2,3,4\nshort,CO(GT),1,0.75\n')
    table("only_header", "model,pollutant\n")
    table("nothing", "")
    got = read_result_tables(spark, base)
    rows = {r.model: r for r in got.collect()}
    assert len(rows) == 303 and all(rows[f"m,{i}"].R2 == i / 1000 and rows[f"m,{i}"].horizon_h == 6 and rows[f"m,{i}"].RMSE is None for i in range(300))
    assert (rows["A"]["MAPE(%)"], rows["A"].horizon_h, rows["A"].run_id) == (3.0, 24, 9)
    assert rows["B"]["MAPE(%)"] == 3.0 and rows["short"].RMSE is None and rows["B"].run_id is None
    assert {r.model for r in read_result_tables(spark, base, missing="skip").collect()} == {"A", "B", "short"}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Union" not in plan
    assert [d.count() for d in scan_tables(spark, [base + "/nothing.csv"])] == [0, 0]


def test_pack_write_load_prunes(spark):
    from sensorgrid.session import scratch_path
    from sensorgrid.sources.packs import load_pack, validate_pack, write_pack
    df = spark.createDataFrame([("e", ts("2004-03-10 18:00"), 1.0, 0, "train"), ("e", ts("2004-03-10 19:00"), 2.0, 3, "test")],
                               "entity_id string, ts timestamp_ntz, a double, target_cls int, split string")
    base = scratch_path(spark, "pack-test")
    write_pack(df, base)
    tr = load_pack(spark, base, split="train")
    assert [r.a for r in tr.collect()] == [1.0]
    plan = tr._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "split" in plan
    v = {r.split: (r.n_rows, r.n_bad_labels) for r in validate_pack(df, ["a"]).collect()}
    assert v == {"train": (1, 0), "test": (1, 1)}


def test_checks_ride_on_the_write(spark):
    import pytest
    from sensorgrid.session import scratch_path
    from sensorgrid.sources.packs import load_pack, validate_pack, write_checked_pack
    rows = [("e", i, float("nan") if i == 3 else None if i == 5 else 1.0, 1.0, 7 if i == 40 else None if i == 41 else i % 3,
             "train" if i < 50 else "val" if i < 60 else None) for i in range(90)]
    df = spark.createDataFrame(rows, "entity_id string, ts long, a double, b double, target_cls int, split string")
    report = write_checked_pack(df, scratch_path(spark, "checked"), ["a", "b"])
    want = {r.split: tuple(r)[1:] for r in validate_pack(df, ["a", "b"]).collect()}
    assert report.by_split == want == {"train": (50, 2, 2), "val": (10, 0, 0), None: (30, 0, 0)} and report.rows == 90
    assert {tuple(r) for r in report.as_frame(spark).collect()} == {tuple(r) for r in validate_pack(df, ["a", "b"]).collect()}
    with pytest.raises(RuntimeError, match="missing feature"):
        report.require()
    good = df.where("split = 'val'")
    assert write_checked_pack(good, scratch_path(spark, "checked"), ["a"], label=None).require().rows == 10
    with pytest.raises(RuntimeError, match="no rows"):
        write_checked_pack(df.limit(0), scratch_path(spark, "checked"), ["a"]).require()
    with pytest.raises(RuntimeError, match="50 rows of a split other"):
        write_checked_pack(df, scratch_path(spark, "checked"), ["a"], splits=("val", None))


def scanned_rows(df):
    """Rows that the scan of an executed plan gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    total = 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        total += leaf.metrics().apply("numOutputRows").value()
    return total


def test_clustered_pack_skips_files_and_row_groups(spark):
    from sensorgrid.session import scratch_path
    from sensorgrid.sources.packs import load_pack, write_pack
    n = 24 * 7 * 8
    df = spark.range(40 * n).selectExpr("concat('e', lpad(id % 40, 2, '0')) entity_id", f"timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id div 40) ts",
                                        "rand(1) a", "rand(2) b", "rand(3) c", "if(id % 5 = 0, 'val', 'train') split").repartition(8)
    plain, base = scratch_path(spark, "plain"), scratch_path(spark, "clustered")
    write_pack(df, plain, row_group_bytes=64 << 10)
    write_pack(df, base, cluster_by=("entity_id", "ts"), row_group_bytes=64 << 10)
    week = dict(split="train", entities=["e07"], start=ts("2024-01-15 00:00"), end=ts("2024-01-22 00:00"))
    got, want = load_pack(spark, base, **week), load_pack(spark, plain, **week)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 24 * 7
    assert "PushedFilters: [" in got._jdf.queryExecution().executedPlan().toString()
    assert scanned_rows(load_pack(spark, base, **week)) < scanned_rows(load_pack(spark, plain, **week)) / 4


def test_metadata_roundtrip(spark):
    from sensorgrid.session import scratch_path
    from sensorgrid.sources.metadata import _meta_frame, read_metadata, write_metadata
    m = _meta_frame(spark, "CO(GT)", ["a", "b"], [1, 2], [3], (1.5, 2.5), 185, "rule", 9357, 9333)
    p = scratch_path(spark, "meta-test")
    write_metadata(m, p)
    r = read_metadata(spark, p).first()
    assert r.rows_total == 9357 and r.X_trees_shape == [9333, 185] and r.label_map["high"] == 2


def test_bom_sink_roundtrip(spark):
    import glob
    from sensorgrid.session import local_path, scratch_path
    from sensorgrid.sources.results import read_csv_table, write_result_table
    df = spark.createDataFrame([("Naive", "1h", "0.7482")], "Model string, Horizon string, Accuracy string")
    p = write_result_table(df, scratch_path(spark, "bom"), bom=True)
    files = glob.glob(local_path(p) + "/part-*.csv")
    assert len(files) == 1
    with open(files[0], "rb") as f:
        assert f.read(3) == b"\xef\xbb\xbf"
    back = read_csv_table(spark, p)
    assert back.columns == ["Model", "Horizon", "Accuracy"] and back.first().Model == "Naive"
