"""Readers, writers and id handling."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from firnline.functions import ids
from firnline.functions import times as tm
from firnline.operators import jobs as jb
from firnline.sinks import tables as st
from firnline.sources import catalogue as cat
from firnline.sources import lineage, store


def one(spark, c):
    return spark.range(1).select(c.alias("x")).collect()[0].x


def test_catalogue_patterns(spark):
    good = [
        "a/S2A_MSIL1C_20170105T013442_N0204_R031_T53NMJ_20170105T013443.SAFE",
        "a/S1A_IW_GRDH_1SDV_20200101T053000_20200101T053025_030000_036F00_ABCD.SAFE",
        "a/FSC_20210415T091255_S2A_T36VVQ_V100_1",
    ]
    bad = ["a/S2C_MSIL1C_20170105T013442_N0204_R031_T53NMJ_20170105T013443.SAFE", "a/FSC_20211315T091255_S2A_T36VVQ_V100_1", "x"]
    ok, rejects = cat.catalogue_from_paths(spark.createDataFrame([(p,) for p in good + bad], "path string"))
    rows = {r.kind: r for r in ok.collect()}
    assert rows["optical_scene"].tile_id == "53NMJ" and rows["optical_scene"].orbit == "031" and rows["optical_scene"].version == "0204"
    assert rows["radar_scene"].sensing_stop == dt.datetime(2020, 1, 1, 5, 30, 25) and rows["radar_scene"].product_type == "IW_GRDH"
    assert rows["product"].mode == "1" and rows["product"].version == "100"
    assert {r.path for r in rejects.collect()} == set(bad)


def test_feature_pages_multiline(spark, tmp_path):
    feature = {"properties": {"productIdentifier": "/x/S2A_MSIL1C_20200101T000000_N0208_R001_T32TLR_20200101T010101.SAFE", "cloudCover": 3.5, "startDate": "2020-01-01T00:00:00.024Z", "published": "2020-01-01T02:00:00Z", "gmlgeometry": "<gml:coordinates>1,2 3,2 3,4 1,2</gml:coordinates>"}}
    (tmp_path / "p1.json").write_text(json.dumps({"features": [feature, feature]}, indent=1))
    (tmp_path / "p2.json").write_text(json.dumps({"features": []}, indent=1))
    df = cat.read_feature_pages(spark, str(tmp_path), tiles=["T32TLR"])
    assert df.count() == 2
    r = df.withColumn("ring", cat.gml_ring(F.col("gml"))).first()
    assert r.measurement_date == dt.datetime(2020, 1, 1, 0, 0, 0, 24000)
    assert [(p.x, p.y) for p in r.ring] == [(1, 2), (3, 2), (3, 4)]
    assert cat.read_feature_pages(spark, str(tmp_path), columns=["product_id"], tiles=["01AAA"]).count() == 0


def test_wkt_round_trip(spark):
    ring = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0.0, 0.0), (1.5, 0.0), (1.0, 2.0))])
    wkt = one(spark, cat.ring_wkt(ring))
    assert wkt == "POLYGON ((0.0 0.0, 1.5 0.0, 1.0 2.0, 0.0 0.0))"
    assert [(p.x, p.y) for p in one(spark, cat.wkt_ring(F.lit(wkt)))] == [(0, 0), (1.5, 0), (1, 2)]


def test_store_scan_prunes(spark, tmp_path):
    rows = [(f"p{i}", "T", dt.datetime(2019, 12, 25) + dt.timedelta(days=i)) for i in range(20)]
    st.write_products(spark.createDataFrame(rows, "product_id string, tile_id string, measurement_date timestamp"), str(tmp_path / "s"))
    df = store.scan_products(spark, str(tmp_path / "s"), dt.date(2019, 12, 30), dt.date(2020, 1, 2), "T")
    assert sorted(r.product_id for r in df.collect()) == ["p5", "p6", "p7", "p8"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_tile_files(spark):
    lines = ["32TLR: {epsg: 32632, ulx: 300000, uly: 5000040, lrx: 409800, lry: 4890240}", "# comment"]
    g = store.parse_tile_grid(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert len(g) == 1 and (g[0].epsg, g[0].lrx) == (32632, 409800.0)
    t = store.parse_tile_tracks(spark.createDataFrame([("32TLR: [8, 15]",)], "value string"))
    assert sorted(r.track for r in store.tile_tracks_long(t).collect()) == [8, 15]
    assert store.parse_tile_list(spark.createDataFrame([("T32TLR",), ("",)], "value string")).count() == 1


def test_lineage_single_and_many(spark):
    item = "<gmd:seriesMetadata><gmd:MD_Metadata><gmd:fileIdentifier><gco:CharacterString>{}</gco:CharacterString></gmd:fileIdentifier><gmd:identificationInfo><gmd:MD_DataIdentification><gmd:extent><gmd:EX_Extent><gmd:temporalElement><gmd:EX_TemporalExtent><gmd:extent><gml:TimePeriod><gml:beginPosition>{}</gml:beginPosition><gml:endPosition>2020-01-02T00:00:00</gml:endPosition></gml:TimePeriod></gmd:extent></gmd:EX_TemporalExtent></gmd:temporalElement></gmd:EX_Extent></gmd:extent></gmd:MD_DataIdentification></gmd:identificationInfo></gmd:MD_Metadata></gmd:seriesMetadata>"
    wrap = "<gmd:MD_Metadata><gmd:series><gmd:DS_OtherAggregate>{}</gmd:DS_OtherAggregate></gmd:series></gmd:MD_Metadata>"
    a, b = item.format("a", "2020-01-01T00:00:00.5"), item.format("b", "2020-01-01T00:00:00")
    docs = spark.createDataFrame([("one", wrap.format(a)), ("two", wrap.format(a + b))], "product_id string, xml string")
    got = {(r.product_id, r.input_id): r.begin for r in lineage.lineage_from_metadata(docs).collect()}
    assert len(got) == 3 and got[("two", "a")].microsecond == 500000


def test_span_ids_and_version_tags(spark):
    names = ["PSA_20170501-3672_S2_T32TLR_V100", "PSA_20170501-153_S2_T32TLR_V100", "FSC_20170501-3672_S2_T32TLR_V100"]
    got = [r.product_id for r in st.fix_span_ids(spark.createDataFrame([(n,) for n in names], "product_id string")).collect()]
    assert got == ["PSA_20170501-153_S2_T32TLR_V100"] + names[1:]
    with pytest.raises(ValueError):
        st.retag_version(spark.range(1), "100", "V101", [])


def test_upsert_is_idempotent(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, n string, v int")
    c = spark.createDataFrame([(2, 9), (3, 7)], "id int, v int")
    once = st.upsert(t, c, ["id"])
    rows = sorted(tuple(r) for r in once.collect())
    assert rows == [(1, "a", 1), (2, "b", 9), (3, None, 7)]
    assert sorted(tuple(r) for r in st.upsert(once, c, ["id"]).collect()) == rows


def test_cascade_reaches_links(spark):
    tables = {
        "parent_jobs": spark.createDataFrame([(1,), (2,)], "id int"),
        "wet_snow": spark.createDataFrame([(10, 1), (11, 2)], "id int, fk_parent_job_id int"),
        "execution_info": spark.createDataFrame([(20, 1), (21, 2)], "id int, fk_parent_job_id int"),
        "links": spark.createDataFrame([(20, "m"), (21, "m")], "fk_execution_info_id int, message_key string"),
    }
    out = st.clear_family({**tables, "wet_snow": tables["wet_snow"].where("id = 10")}, "wet_snow")
    assert [r.id for r in out["parent_jobs"].collect()] == [2]
    assert [r.fk_execution_info_id for r in out["links"].collect()] == [21]


def test_message_dictionary(spark):
    log = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "job int, body string")
    messages, links = jb.normalise_messages(log)
    assert messages.count() == 2 and links.join(messages, "message_key").count() == 3


def test_ids(spark):
    pid = F.lit("FSC_20210415T091255_S2A_T36VVQ_V100_1")
    assert one(spark, ids.toggled_mode_id(pid)).endswith("_0")
    assert one(spark, ids.id_day(F.lit("GFSC_20210415-007_S1-S2_T36VVQ_V100_1618"))) == dt.date(2021, 4, 15)
    assert one(spark, ids.short_tile(F.lit("T32TLR"))) == "32TLR" and one(spark, ids.short_tile(F.lit("3ATLR"))) is None
    assert one(spark, tm.add_months_keep_offset(F.lit("2024-01-31 10:00:00").cast("timestamp"), F.lit(1))) == dt.datetime(2024, 3, 2, 10)


def test_parameter_history(spark):
    t = [dt.datetime(2024, 1, d) for d in (1, 5)]
    h = st.param_history(spark.createDataFrame([(t[0], 1), (t[1], 2)], "time timestamp, v int"))
    assert [r.v for r in st.params_at(h, F.lit("2024-01-04").cast("timestamp")).collect()] == [1]
    assert [r.v for r in st.params_at(h, F.lit("2024-01-05").cast("timestamp")).collect()] == [2]


def test_write_pixels_round_trip(spark, tmp_path):
    df = spark.range(100).select(F.lit("32TLR").alias("tile_id"), F.lit("2024-01-01").cast("date").alias("day"), F.lit("p").alias("product_id"), F.lit(None).cast("timestamp").alias("product_ts"), (F.col("id") % 10).cast("int").alias("row"), F.floor(F.col("id") / 10).cast("int").alias("col"), F.lit(1).alias("value"))
    st.write_pixels(df, str(tmp_path / "px"))
    back = store.read_pixels(spark, str(tmp_path / "px"), layers=("value",), tiles=["32TLR"], start=dt.date(2024, 1, 1), end=dt.date(2024, 1, 2))
    assert back.count() == 100


def test_operations_report(spark):
    from firnline.plans.operations import operations_report

    t0 = dt.datetime(2024, 1, 10)
    h = lambda x: t0 + dt.timedelta(hours=x)
    jobs = spark.createDataFrame(
        [
            (1, 1, "A", True, "nominal", "p1", h(0), h(1), h(2), h(2.5), "32TLR"),
            (2, 2, "A.SAFE", True, "nominal", "p1", h(0), h(1), h(9), h(9), "32TLR"),  # same source, dropped
            (3, 3, "B", True, "nominal", None, h(1), h(2), None, None, "32TLS"),
            (4, 4, "C", False, "nominal", "p4", h(-99), h(-98), h(3), h(4), "32TLS"),
        ],
        "id long, fk_parent_job_id long, l1c_id string, nrt boolean, run_mode string, snow_path string, source_publication_date timestamp,"
        " hub_publication_date timestamp, completion_date timestamp, product_publication_date timestamp, tile_id string",
    )
    parents = spark.createDataFrame([(1, 12, "32TLR"), (2, 14, "32TLR"), (3, 4, "32TLS"), (4, None, "32TLS")], "id long, last_status_id int, tile_id string")
    log = spark.createDataFrame([(1, 3, h(0), 4, None), (2, 1, h(0), 12, None)], "id long, fk_parent_job_id long, time timestamp, job_status int, error_subtype string")
    tiles = spark.createDataFrame([("32TLR",), ("32TLS",), ("32TLT",)], "tile_id string")
    low, high = (F.lit(x).cast("timestamp") for x in ("2024-01-10", "2024-01-11"))
    r = operations_report(jobs, parents, log, tiles, low, high, F.lit("2024-01-10 02:00:00").cast("timestamp"))
    assert {x.id: x.request_selection for x in r["monthly"].collect()} == {1: "both", 3: "l1c_tracking", 4: "generated_within_period"}
    kpi = r["kpi"].first()
    assert (kpi.n_jobs, kpi.n_made, kpi.share_total) == (2, 1, 1.0)
    assert {x.n_products: x.n_tiles for x in r["coverage"].collect()} == {2: 2, 0: 1}
    status = {x.id: x.simple_status_parent for x in r["all_products"].collect()}
    assert status == {1: "successful", 2: "system_error", 3: "in_progress", 4: "in_progress"}
    assert [x.snow_path for x in r["duplicates"].collect()] == ["p1"]
    assert [x.parent_job_id for x in r["stuck"].collect()] == [3]
    hist = r["turnaround_hist"]
    assert hist.count() == 37 and hist.where("n_jobs = 1").first().from_minute == 150


def test_stores_accumulate(spark, tmp_path):
    """A later write replaces its own days only."""
    def px(day, value):
        return spark.createDataFrame([(1, day, 0, 0, value), (2, day, 0, 0, value)], "tile_id long, day date, row int, col int, value int").where("true")

    root = str(tmp_path / "layers")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    st.write_pixels(px(d1, 1), root)
    st.write_pixels(px(d2, 2), root)
    st.write_pixels(px(d2, 3), root)
    got = sorted((r.tile_id, r.day, r.value) for r in spark.read.parquet(root).collect())
    assert got == [(1, d1, 1), (1, d2, 3), (2, d1, 1), (2, d2, 3)]
    rows = lambda *ts: spark.createDataFrame([(str(t), t) for t in ts], "product_id string, measurement_date timestamp")
    t1, t2 = dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 2, 6)
    st.write_products(rows(t1), str(tmp_path / "p"))
    st.write_products(rows(t2), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
