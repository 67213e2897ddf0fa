"""Hand cases and folds for the raster rules."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from firnline import codes
from firnline.functions import quality as fq
from firnline.functions import radar as fr
from firnline.operators import pixels as px
from firnline.plans import snow as sn
from firnline.registry import load
from firnline.scale import Payload, fold_order

DAY = 86400
BASE = 1_700_000_000 - 1_700_000_000 % DAY  # midnight


def stack(spark, stacks):
    """Pixels from lists of (value, age in days), newest first."""
    rows = []
    for p, values in enumerate(stacks):
        for i, (value, age) in enumerate(values):
            t = BASE + 3600 * 12 - age * DAY - i
            rows.append((1, p, 0, f"id{len(values) - i:04d}", t, value, i % 4, i, t))
    return spark.createDataFrame(
        rows, "tile_id int, row int, col int, product_id string, s long, value int, qc int, flags int, acq_epoch long"
    ).withColumn("product_ts", F.timestamp_seconds("s"))


@pytest.mark.parametrize(
    "values,expected",
    [([205, 40, 60], 40), ([205, 255, 255], 205), ([255, 205, 255], 255), ([7, 40], 7), ([255, 255, 3], 3)],
)
def test_daily_fill_cases(spark, values, expected):
    df = px.daily_fill(stack(spark, [[(v, i) for i, v in enumerate(values)]]))
    assert df.collect()[0].value == expected


def fold_daily(values):
    cur = 0
    for i, v in enumerate(values):
        if i and values[cur] in (205, 255) and v not in (205, 255):
            cur = i
    return cur


def fold_temporal(items, cutoff):
    """Sequential window fill: (value, acquisition) newest first."""
    value, source = 255, None
    for i, (v, acq) in enumerate(items):
        if i == 0:
            if acq >= cutoff:
                value, source = v, 0
        elif value in (205, 255) and v != 255 and acq > cutoff:
            value, source = v, i
    return value, source


def test_fills_match_sequential_folds(spark):
    rng = np.random.default_rng(3)
    stacks = [
        [(int(rng.choice([0, 5, 60, 205, 255])), int(a)) for a in np.sort(rng.integers(0, 10, rng.integers(1, 7)))]
        for _ in range(300)
    ]
    df = stack(spark, stacks).cache()
    daily = {r.row: r for r in px.daily_fill(df).collect()}
    window = {r.row: r for r in px.temporal_fill(df, F.lit("2023-11-14").cast("date"), 4).collect()}
    cutoff = BASE + DAY - 1 - 4 * DAY
    for p, values in enumerate(stacks):
        k = fold_daily([v for v, _ in values])
        assert (daily[p].value, daily[p].flags) == (values[k][0], k)
        items = [(v, BASE + 3600 * 12 - a * DAY - i) for i, (v, a) in enumerate(values)]
        value, source = fold_temporal(items, cutoff)
        got = window[p]
        assert got.value == value
        assert got.flags == (0 if source is None else source)
        assert got.acq_epoch == (0 if source is None else items[source][1])
        if source is None:
            assert got.qc == 255


@pytest.mark.parametrize("values,expected", [((0, 1, 0), 1), ((255, 0), 0), ((255, 255), 255), ((0, 255), 0), ((1, 0), 1)])
def test_mosaic(spark, values, expected):
    df = spark.createDataFrame([(0, 0, v, i, i) for i, v in enumerate(values)], "row int, col int, value int, qc int, source_order int")
    cur, qc = None, None
    for i, v in enumerate(values):
        if cur is None or cur == 255 or (cur == 0 and v == 1):
            cur, qc = v, i
    r = px.mosaic(df).collect()[0]
    assert (r.value, r.qc) == (expected, qc)


@pytest.mark.parametrize(
    "block,side,expected",
    [
        ([10, 11] + [205] * 7, 3, 10), ([205] * 5 + [255] * 4, 3, 205), ([205] * 3 + [255] * 6, 3, 255),
        ([205, 205, 255, 255], 2, 205), ([10, 11, 11, 12], 2, 11), ([210] * 4, 2, 255),
    ],
)
def test_upscale(spark, block, side, expected):
    df = spark.createDataFrame([(1, i // side, i % side, v) for i, v in enumerate(block)], "tile_id int, row int, col int, value int")
    assert px.upscale(df, side).collect()[0].value == expected


@pytest.mark.parametrize("n_set,expected", [(4, 0), (5, 2)])
def test_upscale_bits(spark, n_set, expected):
    df = spark.createDataFrame([(1, i // 3, i % 3, 2 if i < n_set else 0) for i in range(9)], "tile_id int, row int, col int, flags int")
    assert px.upscale_bits(df, 3).collect()[0].flags == expected


@pytest.mark.parametrize("clear,snow,value,qc", [(20, 19, 1, 1), (20, 18, 0, 1), (0, 0, 255, 255), (25, 25, 1, 0), (10, 10, 1, 3)])
def test_persistent_snow(spark, clear, snow, value, qc):
    rows = [(1, 0, 0, 50)] * snow + [(1, 0, 0, 0)] * (clear - snow) + [(1, 0, 0, 205)]
    r = px.persistent_snow(spark.createDataFrame(rows, "tile_id int, row int, col int, value int")).collect()[0]
    assert (r.value, r.qc) == (value, qc)


def test_season_map_refuses_thin_tiles(spark):
    rows = [(1, 0, 0, 50, str(i), "2024-06-01 00:00:00") for i in range(4)]
    df = spark.createDataFrame(rows, "tile_id int, row int, col int, value int, product_id string, t string").withColumn("product_ts", F.col("t").cast("timestamp"))
    with pytest.raises(sn.NotEnoughProducts):
        sn.season_map(df, F.lit("2024-05-01").cast("date"), F.lit("2024-10-01").cast("date"))


@pytest.mark.parametrize("rc,value,qc", [(-2.5, 125, 250), (-2.6, 110, 3), (-3.2, 110, 2), (-3.7, 110, 1), (-4.1, 110, 0)])
def test_wet_classes(spark, rc, value, qc):
    r = spark.range(1).select(fr.wet_class(F.lit(rc)).alias("v"), fr.wet_quality(F.lit(rc)).alias("q")).collect()[0]
    assert (r.v, r.q) == (value, qc)


@pytest.mark.parametrize("flags,expected", [(0, 0), (2, 1), (1, 2), (3, 3)])
def test_quality_levels(spark, flags, expected):
    r = spark.range(1).select(fq.snow_quality(F.lit(flags), F.lit(50)).alias("q"), fq.snow_quality(F.lit(flags), F.lit(205)).alias("c")).collect()[0]
    assert (r.q, r.c) == (expected, 205)


def test_tree_cover_of_one_is_worst(spark):
    r = spark.range(1).select(fq.snow_quality(F.lit(0), F.lit(50), F.lit(2)).alias("q")).collect()[0]
    assert r.q == 3


def test_gradient_matches_stencil(spark):
    rng = np.random.default_rng(1)
    z = rng.normal(size=(6, 7)) * 50
    rows = [(1, r, c, float(z[r, c])) for r in range(6) for c in range(7)]
    out = px.gradients(spark.createDataFrame(rows, "tile_id int, row int, col int, z double"), 20.0).collect()
    pad = np.pad(z, 1, mode="symmetric")
    for g in out:
        w = pad[g.row : g.row + 3, g.col : g.col + 3]
        dc = (w[0, 0] + 2 * w[1, 0] + w[2, 0] - w[0, 2] - 2 * w[1, 2] - w[2, 2]) / 160
        dl = (w[2, 0] + 2 * w[2, 1] + w[2, 2] - w[0, 0] - 2 * w[0, 1] - w[0, 2]) / 160
        assert g.dz_dc == pytest.approx(dc) and g.dz_dl == pytest.approx(dl)


def test_align_grid_needs_overlap(spark):
    df = spark.createDataFrame([(0, 0, 1)], "row int, col int, value int")
    a = {"ulx": 0.0, "uly": 0.0, "size": 60.0, "nrows": 2, "ncols": 2}
    with pytest.raises(ValueError):
        px.align_grid(df, a, {**a, "ulx": 600.0})
    r = px.align_grid(df, a, {**a, "ulx": -90.0, "ncols": 10}).collect()[0]
    assert (r.row, r.col) == (0, 1)  # 1.5 pixels truncate to 1


def test_radar_only_day_is_filled(spark):
    """A day without optical data takes wet snow into an empty layer."""
    schema = "tile_id int, day date, row int, col int, product_ts timestamp, product_id string, value int, qc int, flags int, acq_epoch long"
    none = spark.createDataFrame([], schema)
    wet = spark.sql("select 1 tile_id, date'2024-01-01' day, 0 row, 0 col, current_timestamp() product_ts, 'w' product_id, 110 value, 2 qc, 99L acq_epoch")
    r = sn.fill_days(none, wet).collect()[0]
    assert (r.value, r.qc, r.flags, r.acq_epoch) == (100, 2, 64, 99)


def test_codes_are_consistent():
    assert set(codes.SNOW_GAPS) <= set(codes.WET_SNOW_GAPS)
    assert sorted(codes.ALLOWED_NEXT) == list(range(17))


@pytest.mark.parametrize("name", ["daily_fill", "temporal_fill", "mosaic", "gap_filled_day", "gap_filled_clouds", "wet_dry_snow"])
def test_folds_are_hash_aggregates(spark, data, name):
    plan = load()[0][name](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_fold_order_follows_the_struct_order(spark):
    us = [None, "0001-01-01 00:00:00", "1969-12-31 23:59:59.999999", "2024-01-25 10:00:00", "2024-01-25 10:00:00.000001", "9999-12-31 00:00:00"]
    ids = [None, -(2**63) + 1, -1, 0, 1, 2**63 - 1]
    rows = [(v, t, i) for v in (None, False, True) for t in us for i in ids]
    df = spark.createDataFrame(rows, "v boolean, t string, i long").withColumn("t", F.col("t").cast("timestamp"))
    order = ["t", "i"]
    for lead in (["v"], []):
        one = fold_order(df, [*lead, *order])
        got = [r[0] for r in df.select(one.alias("n"), F.struct(*lead, *order).alias("s")).orderBy("s").select("n").collect()]
        assert got == sorted(got) and len(set(got)) == (len(rows) if lead else len(rows) // 3)
    assert "struct" in df.select(fold_order(df, ["v", F.col("i").cast("string")])).dtypes[0][1]


def test_payload_round_trip_and_range(spark):
    rows = [(0, 255, None, 2**35 - 1), (None, 0, 7, 0), (255, None, 255, None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "value int, qc int, flags int, acq_epoch long")
    p = Payload(df, {c: F.col(c) for c in df.columns})
    out = df.select(p.struct(p.packed()).alias("p")).select("p.*")
    assert out.dtypes == df.dtypes and sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    bad = spark.createDataFrame([(256, 0)], "value int, qc int")
    with pytest.raises(Exception, match="value out of range: 256"):
        bad.select(Payload(bad, {c: F.col(c) for c in bad.columns}).packed()).collect()
