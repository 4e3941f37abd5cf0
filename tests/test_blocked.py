"""Time-blocked execution gives the same rows as the whole-series plan."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from sensorgrid.operators import blocked as bk
from sensorgrid.operators import clean, grid
from sensorgrid.plans.prepare import PrepareConfig, clean_readings, clean_readings_blocked, feature_pack, \
    feature_pack_blocked

SCHEMA = "entity_id string, ts timestamp_ntz, a double, b double"


def frame(spark):
    rows = []
    t0 = dt.datetime(2004, 3, 1, 0, 30)  # off-hour start: grid anchored at :30
    for i in range(200):
        if 40 <= i < 75:        # a gap longer than a block
            continue
        a = None if i % 7 == 0 else float(i % 13)
        rows.append(("hot", t0 + pd.Timedelta(hours=i), a, float((i * 7) % 11)))
    rows.append(("hot", dt.datetime(2004, 3, 2, 5, 0), 99.0, 99.0))  # off-grid row: dropped
    for i in range(30):
        rows.append(("cold", dt.datetime(2004, 3, 3) + pd.Timedelta(hours=i), float(i), 1.0))
    return spark.createDataFrame(rows, SCHEMA)


def as_rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_blocked_grid_and_ffill_equal_plain(spark):
    df = frame(spark)
    x = clean.missing_flags(df, ["a", "b"])
    plain = grid.forward_fill(grid.hourly_grid(x), ["a", "b"])
    g = bk.hourly_grid_blocked(x, 16)
    blocked = bk.forward_fill_blocked(g, ["a", "b"], 16)
    cols = ["entity_id", "ts", "a", "b", "a__was_missing", "__gap"]
    assert as_rows(plain, cols) == as_rows(blocked, cols)
    assert plain.count() == 200 + 30


def test_blocked_pack_equal_plain(spark):
    df = frame(spark)
    cfg = PrepareConfig(sensors=["a", "b"], target="a", features=["a", "b"], test_start="2004-03-07 00:00:00",
                        lags=(1, 2, 6), rolls=(3, 6))
    p1 = feature_pack(clean_readings(df, cfg), cfg, label_tasks=[("b", 3)])
    cfg_b = PrepareConfig(**{**cfg.__dict__, "block_hours": 8})
    p2 = feature_pack_blocked(clean_readings_blocked(df, cfg_b), cfg_b, label_tasks=[("b", 3)])
    cols = p1.columns
    r1 = as_rows(p1.select(*[F.round(F.col(c), 9).alias(c) if t == "double" else F.col(c) for c, t in p1.dtypes]), cols)
    r2 = as_rows(p2.select(*[F.round(F.col(c), 9).alias(c) if t == "double" else F.col(c)
                             for c, t in p2.select(*cols).dtypes]), cols)
    assert r1 == r2


def test_halo_copies(spark):
    df = spark.createDataFrame([("e", dt.datetime(2004, 1, 1) + pd.Timedelta(hours=i), float(i), 0.0) for i in range(10)], SCHEMA)
    h = bk.with_halo(df, block_hours=4, before=2, after=1)
    core = h.where(F.col(bk.CORE) == 1).count()
    assert core == 10
    # hours since epoch of 2004-01-01 is a multiple of 4, so blocks are [0..3], [4..7], [8..9];
    # tails (offset >= 2) go to the next block, heads (offset < 1) to the previous one
    b0 = h.where(F.col(bk.CORE) == 1).agg(F.min(bk.BLK)).first()[0]
    got = sorted((r[bk.BLK] - b0, int(r.a)) for r in h.where(F.col(bk.CORE) == 0).collect())
    assert got == [(-1, 0), (0, 4), (1, 2), (1, 3), (1, 8), (2, 6), (2, 7)]


def test_non_constant_columns(spark):
    df = spark.createDataFrame([("e", dt.datetime(2004, 1, 1), 1.0, 5.0), ("e", dt.datetime(2004, 1, 2), 2.0, 5.0)], SCHEMA)
    got = {r.column: r.varying for r in clean.non_constant_columns(df, ["a", "b"]).collect()}
    assert got == {"a": True, "b": False}


def test_window_summaries_in_blocks_equal_plain(spark):
    from sensorgrid.operators.models import window_summary_frame
    t0 = dt.datetime(2004, 3, 1)
    rows = [(e, t0 + pd.Timedelta(hours=i), "train" if i < 61 else "val" if i < 75 else "test", None if i % 11 == 3 else float((i * 7) % 13), i % 3)
            for e, n in (("hot", 150), ("cold", 30), ("one", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "entity_id string, ts timestamp_ntz, split string, a double, cls int")
    plain, names = window_summary_frame(df, ["a"], "cls", 6, (1, 24), ["entity_id", "split"])
    cols = ["entity_id", "split", "ts", *names, "cls__h1", "cls__h24"]
    key = lambda d: sorted((tuple(r) for r in d.select(*cols).collect()), key=str)
    want = key(plain)
    assert len(want) == 56 + 9 + 70 + 25
    for width in (4, 16, 500):
        got, found = window_summary_frame(df, ["a"], "cls", 6, (1, 24), ["entity_id", "split"], block_hours=width)
        assert found == names and key(got) == want
