"""Time-series rules against the published cases and brute force, also with one
crowded key."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from firnline import codes, scale
from firnline.operators import jobs as jb
from firnline.operators import products as pr
from firnline.operators import series as se
from firnline.operators import slices as sl
from firnline.plans import planning as pl
from firnline.scale import carry, id_chunk, running_sum

T0 = dt.datetime(2019, 1, 1)
JOB = (
    "id long, tile_id string, measurement_date timestamp, creation_date timestamp, source_id string, last_status_id int,"
    " last_status_change_id long, output_status string, reference_job boolean, reprocessing_context string, run_mode string,"
    " snow_path string, backward_reprocessing_run boolean, output_deleted boolean, n_jobs_run_since_last_init long,"
    " n_l2a_produced_since_last_init long"
)


def job(i, tile="32TLR", day=0, status=9, output="generated", ref=True, context=None, mode="nominal", flag="0", rerun=False,
        deleted=False, runs=1, made=1, created=None, source=None):
    m = T0 + dt.timedelta(days=day)
    return (i, tile, m, created or m + dt.timedelta(hours=5), source or f"s{i}", status, i, output, ref, context, mode,
            f"P_{flag}" if output == "generated" else None, rerun, deleted, runs, made)


def jobs_df(spark, rows):
    return spark.createDataFrame(rows, JOB)


def test_previous_job_alternating_tiles(spark):
    rows = [job(i, tile=f"32TLR{i % 2}", day=30 * i, output="pending", status=1) for i in range(6)]
    got = {r.id: r.prev_id for r in se.previous_usable(jobs_df(spark, rows)).collect()}
    assert got == {2: 0, 3: 1, 4: 2, 5: 3}


def test_same_time_candidate_hides_older_one(spark):
    rows = [job(0, day=0), job(1, day=10, created=T0 + dt.timedelta(days=10, hours=1)), job(2, day=10)]
    got = {r.id: r.prev_id for r in se.previous_usable(jobs_df(spark, rows)).collect()}
    # job 2 finds job 1 at its own time, so it has no predecessor
    assert got == {1: 0}


def brute_previous(rows):
    out = {}
    for q in rows:
        best = None
        for p in rows:
            usable = p[8] and (p[7] == "generated" or (p[7] == "pending" and (p[5] not in (13, 14, 16) or (q[9] == "backward" and p[5] != 16))))
            if p[1] == q[1] and p[2] <= q[2] and p[3] < q[3] and p[4] != q[4] and usable:
                key = (p[2], p[3], p[6], p[0])
                if best is None or key > best[0]:
                    best = (key, p)
        if best and best[1][2] < q[2]:
            out[q[0]] = best[1][0]
    return out


def random_jobs(n, seed, hot):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        tile = "A" if rng.random() < hot else str(rng.integers(0, 5))
        day = float(rng.integers(0, 400))
        late = dt.timedelta(hours=float(rng.choice([3, 30, 24 * 60])))
        rows.append(job(i, tile, day, int(rng.integers(1, 17)), str(rng.choice(["generated", "pending", "none"])), bool(rng.random() < 0.8),
                        "backward" if rng.random() < 0.3 else None, created=T0 + dt.timedelta(days=day) + late + dt.timedelta(seconds=i),
                        source=f"s{rng.integers(0, n // 2)}", flag=str(rng.integers(0, 2)), rerun=bool(rng.random() < 0.2)))
    return rows


@pytest.mark.parametrize("seed,hot", [(1, 0.3), (2, 0.95)])
def test_previous_usable_brute_force(spark, seed, hot):
    rows = random_jobs(350, seed, hot)
    got = {r.id: r.prev_id for r in se.previous_usable(jobs_df(spark, rows)).collect()}
    assert got == brute_previous(rows)


@pytest.mark.parametrize("fan", [2, 32])
def test_previous_over_many_levels(spark, monkeypatch, fan):
    """One tile with all rows; most are created long after their measurement, a few
    at once, so answers lie thousands of rows back; one source holds half of them."""
    monkeypatch.setattr(se, "PREVIOUS_FANOUT", fan)
    rng = np.random.default_rng(11)
    n = 1500
    rows = []
    for i in range(n):
        created = i + (2 * n if i % 97 else int(rng.integers(0, 3)))
        rows.append(("A", 0, i, i // 3, created, i, f"s{rng.integers(0, 40)}" if rng.random() < 0.5 else "hot"))
    schema = "tile_id string, rule int, id long, m long, c long, chg long, source string"
    extra = [("A", 0, n, None, 5, 0, "x"), ("A", 0, n + 1, 5, None, 0, "x"), ("A", 1, n + 2, 9999, 9999, 0, "x"), ("A", 0, n + 3, 9999, 1, 0, None)]
    got = {r.id: r.prev_id for r in se.latest_created_before(*[spark.createDataFrame(rows + extra, schema)] * 2).collect()}
    want = {}
    both = sorted((r for r in rows + extra if r[3] is not None and r[4] is not None), key=lambda r: (r[3], r[4], r[5], r[2]))
    for q in both:
        for p in reversed(both):
            if p[1] == q[1] and p[3] <= q[3] and p[4] < q[4] and p[6] != q[6]:
                want[q[2]] = p[2]
                break
    assert got == want and sum(q - p > 90 for q, p in want.items()) > 10


def test_next_n_brute_force(spark):
    rng = np.random.default_rng(5)
    a = [(("A" if rng.random() < 0.9 else "B"), i, int(m), int(m + rng.integers(1, 4000))) for i, m in enumerate(rng.integers(0, 20000, 120))]
    r = [(("A" if rng.random() < 0.9 else "B"), 1000 + i, int(m), int(m + rng.integers(1, 4000))) for i, m in enumerate(rng.integers(0, 20000, 150))]
    us = 1_000_000 * 3600
    schema = "tile_id string, id long, m long, c long"
    scale = lambda rows: spark.createDataFrame([(t, i, m * us, c * us) for t, i, m, c in rows], schema)
    got = {}
    for x in se.next_n(scale(a), scale(r), 4).orderBy("id", "position").collect():
        got.setdefault(x.id, []).append(x.next_id)
    want = {}
    for t, i, m, c in a:
        hits = sorted((rm, rid) for rt, rid, rm, rc in r if rt == t and rm >= m and rc > c)[:4]
        if hits:
            want[i] = [rid for _, rid in hits]
    assert got == want


def test_next_n_of_jobs_created_years_later(spark):
    """One tile; all anchors and most rows were created two years after sensing, the
    rest at once, so thousands of rows lie between an anchor's dates."""
    us, n = 1_000_000 * 3600, 3000
    late = 2 * 365 * 24
    base = spark.range(n).select(F.lit("A").alias("tile_id"), "id", (F.col("id") * us).alias("m"))
    anchors = base.withColumn("c", F.col("m") + late * us)
    rows = base.withColumn("c", F.when(F.col("id") % 100 == 7, F.col("m") + (late + 50) * us).otherwise(F.col("m")))
    got = {}
    for x in se.next_n(anchors, rows, 3).orderBy("id", "position").collect():
        got.setdefault(x.id, []).append(x.next_id)
    created = {i: i + late + 50 if i % 100 == 7 else i for i in range(n)}
    want = {i: [j for j in range(i, n) if created[j] > i + late][:3] for i in range(n)}
    assert got == {i: w for i, w in want.items() if w}


def test_mode_nominal_init_wait(spark):
    open_ = dict(mode=None, output="pending", status=1)
    rows = [
        job(0, "N", 0, flag="1"), job(1, "N", 60, **open_),
        job(2, "I", 0, flag="1"), job(3, "I", 61, **open_),
        job(4, "W", 0, **open_),
        job(5, "D", 0, flag="1", deleted=True), job(6, "D", 10, **open_),
    ]
    df = jobs_df(spark, rows)
    got = {r.id: r for r in se.assign_mode(df, se.previous_usable(df)).collect()}
    assert {i: r.run_mode for i, r in got.items()} == {1: "nominal", 3: "init", 4: "wait", 6: "init"}
    assert (got[1].n_jobs_run_since_last_init, got[1].n_l2a_produced_since_last_init, got[1].previous_id) == (2, 1, 0)
    assert got[3].n_jobs_run_since_last_init == 0


def test_mode_backward(spark):
    rows = [job(0, day=0, mode=None, output="pending", status=1)]
    rows += [job(i, day=10 * i) for i in range(1, 10)]
    rows += [job(20, day=5, flag="1"), job(21, day=6, output="pending", deleted=True)]
    df = jobs_df(spark, rows)
    r = {x.id: x for x in se.assign_mode(df, se.previous_usable(df)).collect()}[0]
    assert r.run_mode == "backward" and r.member_ids == [0, 1, 2, 3, 4, 5, 6, 7]
    assert r.n_jobs_run_since_last_init == 8
    off = {x.id: x for x in se.assign_mode(df, se.previous_usable(df), allow_backward=False).collect()}[0]
    assert off.run_mode == "init"
    gap = [job(0, day=0, mode=None, output="pending", status=1)] + [job(i, day=10 * i + (61 if i > 3 else 0)) for i in range(1, 10)]
    g = jobs_df(spark, gap)
    assert {x.id: x.run_mode for x in se.assign_mode(g, se.previous_usable(g)).collect()}[0] == "wait"


def test_backward_plan(spark):
    rows = [job(0, day=0, mode="init")] + [job(i, day=10 * i) for i in range(1, 9)]
    df = jobs_df(spark, rows)
    trig = df.where("id = 8").select("tile_id", F.col("measurement_date").alias("trigger_measurement"))
    issued, replaced = se.backward_plan(df, trig)
    got = sorted((r.position, r.source_id, r.run_mode, r.n_jobs_run_since_last_init) for r in issued.collect())
    assert got[0] == (0, "s0", "backward", 8) and [g[1] for g in got[1:]] == [f"s{i}" for i in range(1, 8)]
    assert sorted(r.id for r in replaced.collect()) == list(range(8))


def test_configure_optical(spark):
    rows = [job(0, day=0, flag="1", made=8), job(1, day=5, mode=None, output="pending", status=1), job(2, day=9, mode=None, output="pending", status=1)]
    out = pl.configure_optical(jobs_df(spark, rows))
    state = {r.id: r.readiness for r in out["state"].collect()}
    assert state == {1: "ready", 2: "configured"}
    assert {r.id: r.run_mode for r in out["modes"].collect()} == {1: "nominal"}


def test_readiness(spark):
    statuses = [1, 1, 1, 2, 9]
    rows = [job(i, day=i, status=statuses[i] if i < 5 else 1, output="generated" if i == 4 else "pending") for i in range(6)]
    df = jobs_df(spark, rows)
    got = {r.id: r.readiness for r in se.readiness(df, se.previous_usable(df)).collect()}
    assert got == {0: "ready", 1: "configured", 2: "configured", 3: "configured", 4: "configured", 5: "ready"}


def test_new_jobs_codated(spark):
    schema = "seq long, source_id string, tile_id string, measurement_date timestamp, creation_date timestamp, publication_date timestamp"
    h = lambda x: T0 + dt.timedelta(hours=x)
    existing = spark.createDataFrame([(0, "a", "T", h(0), h(1), h(2))], schema)
    cands = spark.createDataFrame(
        [(1, "a", "T", h(0), h(1), h(2)), (2, "b", "T", h(0), h(3), h(24)), (3, "c", "T", h(0), h(3), h(25)), (4, "d", "T", h(9), h(9), h(9)), (5, "d", "T", h(9), h(9), h(9))],
        schema,
    )
    new, old = pr.new_jobs(cands, existing)
    assert sorted(r.seq for r in new.collect()) == [2, 4]
    assert [r.source_id for r in old.collect()] == ["a"]
    again, _ = pr.new_jobs(cands.where("seq = 4"), existing.unionByName(cands.where("seq = 4")))
    assert again.count() == 0


def test_search_intervals(spark):
    days = spark.createDataFrame([(f"2024-01-{d:02d}",) for d in (1, 3, 8, 14, 14)], "d string").select(F.to_date("d").alias("day"))
    got = sorted((r.date_min.day, r.date_max.day) for r in pr.search_intervals(days).collect())
    assert got == [(1, 8), (14, 14)]


def test_transitions_cover_every_pair(spark):
    rows, want = [], set()
    for i, (old, new) in enumerate([(o, n) for o in range(17) for n in range(1, 17)]):
        if old:
            rows.append((2 * i, i, old, T0))
        rows.append((2 * i + 1, i, new, T0))
        if new not in codes.ALLOWED_NEXT[old]:
            want.add((old, new))
    log = spark.createDataFrame(rows, "id long, fk_parent_job_id long, job_status int, time timestamp")
    bad = {(r.previous_status, r.job_status) for r in jb.bad_transitions(log).where("id % 2 = 1").collect()}
    assert bad == want


def test_carry_and_running_sum_on_one_key(spark):
    """A key spread over many chunks, chunks without a value included."""
    n = 5000
    df = spark.range(n).select(F.lit("k").alias("k"), F.col("id"), F.when(F.col("id") % 700 == 0, F.col("id")).alias("v"))
    c = carry(df, ["k"], id_chunk("id", 6), ["id"], F.struct("v").withField("v", F.col("v")), "prev")
    assert c.where("id > 0 and not (prev.v <=> case when (id - 1) % 700 = 0 then id - 1 end)").count() == 0
    c = carry(df, ["k"], id_chunk("id", 6), ["id"], F.col("v"), "prev", inclusive=True)
    assert c.where("prev != id - id % 700").count() == 0
    nxt = carry(df, ["k"], id_chunk("id", 6), ["id"], F.col("v"), "next", backward=True)
    assert nxt.where("id < 4200 and next != id - id % 700 + 700").count() == 0
    s = running_sum(df, ["k"], id_chunk("id", 6), ["id"], F.lit(1), "n")
    assert s.where("n != id + 1").count() == 0


def slices_df(spark, rows):
    schema = "stripe_id string, product_id string, start double, stop double, slice int, total_slices int"
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("start_ts", F.timestamp_seconds("start")).withColumn("stop_ts", F.timestamp_seconds("stop"))


def test_assemble_slices(spark):
    rows = [("S", f"p{i}", 25.0 * i, 25.0 * i + 25, i, 6) for i in (1, 2, 3, 5, 6)] + [("S", "dup", 25.5, 50.0, 1, 6)]
    got = [
        (r.assembly_no, r.product_id, r.exclude_first, r.exclude_last)
        for r in sl.assemble_slices(slices_df(spark, rows)).orderBy("assembly_no", "position").collect()
    ]
    assert got == [
        (1, "p1", False, True), (1, "p2", False, True),
        (2, "p2", True, True), (2, "p3", False, True),
        (3, "p3", True, True),
        (4, "p5", True, True), (4, "p6", False, False),
        (5, "p6", True, False),
    ]


def test_supersede_and_master(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 5), (3, "a", 4)], "id long, g string, c int")
    assert {r.id for r in pr.supersede(df, ["g"], "c").where("not cancelled").collect()} == {2}
    jobs = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "id long, assembly_id string")
    live = spark.createDataFrame([(99, "y")], "id long, assembly_id string")
    got = {r.id: r.assembly_master_job_id for r in pr.elect_master(jobs, live).collect()}
    assert got == {1: 0, 2: 1, 3: 99}


def test_held_triggers(spark):
    pub = T0
    schema = "triggering_product_id string, tile_id string, product_date date, triggering_product_publication_date timestamp, curation_timestamp timestamp"
    jobs = spark.createDataFrame(
        [("FSC_20190101T000000_S2A_T1_V100_1", "1", T0.date(), pub, pub), ("FSC_20190101T000000_S2A_T2_V100_0", "2", T0.date(), pub, pub),
         ("WDS_20190101T000000_S1A_T3_V100_0", "3", T0.date(), pub, pub)], schema)
    ins = spark.createDataFrame(
        [("FSC_20190101T000000_S2A_T1_V100_1", "FSC_20190101T000000_S2A_T1_V100_0", T0, T0.date()),
         ("FSC_20190101T000000_S2A_T2_V100_0", "WDS_20190101T000000_S1A_T2_V100_0", T0, T0.date())],
        "triggering_product_id string, product_id string, measurement_date timestamp, product_date date")
    now = F.lit("2019-01-01 02:00:00").cast("timestamp")
    state = lambda **k: {r.tile_id: r.state for r in pl.configure_gap_filling(jobs, ins, now, **k).collect()}
    assert state() == {"1": "cancelled", "2": "waiting", "3": "ready"}
    assert state(early_release=True)["2"] == "ready"


def test_priority_cases(spark):
    from firnline.functions.rules import priority

    h = lambda x: T0 + dt.timedelta(hours=x)
    rows = [(False, h(0), h(1), h(2)), (True, None, h(1), h(2)), (True, h(0), None, h(2)), (True, h(0), h(1), None), (True, h(0), h(25), h(26)), (True, h(0), h(1), h(5)), (True, h(0), h(1), h(2))]
    df = spark.createDataFrame(rows, "n boolean, m timestamp, s timestamp, h timestamp")
    got = [r.p for r in df.select(priority(F.col("n"), F.col("m"), F.col("s"), F.col("h")).alias("p")).collect()]
    assert got == ["reprocessing"] + ["delayed"] * 5 + ["nrt"]


def test_walk_back_stops_after_an_empty_day(spark):
    day = lambda d: dt.date(2024, 1, d)
    start = spark.createDataFrame([(day(20),)], "start_day date")
    made = spark.createDataFrame([(day(d),) for d in (20, 19, 17, 12)], "day date")
    got = lambda low, high: sorted(r.day.day for r in pr.walk_back(start, made, low, high).collect())
    assert got(0, 9) == [18, 19, 20]  # 18 gave nothing, so 17 is not visited
    assert got(3, 9) == [16, 17, 18, 19, 20]  # 17 gave something, 16 did not
    assert got(4, 9) == [16, 17, 18, 19, 20]
    assert got(9, 9) == list(range(11, 21))


def test_pairing_waits_for_unfinished_radar(spark):
    from firnline.plans.ice import pair_radar_optical

    schema = "job_id long, tile_id string, day date, sensing_time timestamp, path string, published timestamp, status int, satellite string"
    d = dt.date(2024, 1, 10)
    at = lambda h: dt.datetime(2024, 1, 10) + dt.timedelta(hours=h)
    radar = spark.createDataFrame(
        [(1, "A", d, at(5), "r1", at(6), 12, "S1A"), (2, "A", d, at(9), "r2", at(10), 12, "S1B"), (3, "B", d, at(5), None, None, 7, "S1A")], schema)
    optical = spark.createDataFrame([(4, "A", d, at(10), "o1", at(12), 12, None)], schema)
    tiles = spark.createDataFrame([("A",)], "tile_id string")
    done = spark.createDataFrame([], "tile_id string, day date")
    run = lambda now, **k: pair_radar_optical(
        radar, optical, done, tiles, F.lit(now).cast("timestamp"), F.lit("2024-01-01").cast("timestamp"), **k)
    assert run("2024-01-11 00:00:00")["pairs"].count() == 0  # 48 h by the published count, radar pending
    late = run("2024-01-11 00:00:01", min_search_days=1)
    r = late["pairs"].collect()
    assert [(x.tile_id, x.satellite) for x in r] == [("A", "S1B")]
    assert sorted(x.path for x in late["inputs"].collect()) == ["o1", "r2"]
    assert run("2024-01-11 12:00:00", literal_delay=False)["pairs"].count() == 0


def test_refused_row_does_not_hide_a_later_valid_one(spark):
    day, hour = dt.datetime(2024, 1, 1), dt.timedelta(hours=1)
    kind = "seq long, source_id string, tile_id string, measurement_date timestamp, creation_date timestamp, publication_date timestamp"
    existing = spark.createDataFrame([(0, "old", "T", day, day, day)], kind)
    cands = spark.createDataFrame([(1, "s", "T", day, day + hour, day + 30 * hour), (2, "s", "T", day, day + hour, day + 3 * hour),
                                   (3, "s", "T", day, day + hour, day + 4 * hour)], kind)
    assert [r.seq for r in pr.new_jobs(cands, existing)[0].collect()] == [2]


def test_silent_days_are_below_their_band(spark):
    from firnline.operators import reporting as rp

    rows = [("a", dt.datetime(2024, 1, d, 3)) for d in (1, 1, 3)] + [("x", dt.datetime(2024, 1, 2))]
    jobs = spark.createDataFrame(rows, "family string, created timestamp")
    bands = spark.createDataFrame([("a", 1, 1), ("b", 1, 2)], "family string, lower int, upper int")
    got = sorted((r.family, r.day.day, r.n_jobs, r.verdict) for r in rp.production_bands(jobs, bands).collect())
    assert got == [("a", 1, 2, "above"), ("a", 2, 0, "below"), ("a", 3, 1, "nominal"), ("b", 1, 0, "below"), ("b", 2, 0, "below"),
                   ("b", 3, 0, "below"), ("x", 2, 1, "nominal")]


def brute_chain(rows, n):
    """Counters row by row; rows are (id, tile, measured, mode, produced)."""
    state, out = {}, {}
    for i, tile, m, mode, made in sorted(rows, key=lambda r: (r[2], r[0])):
        runs, prods = state.get(tile, (0, 0))
        if mode == "init":
            runs = prods = 0
        elif mode == "backward":
            runs = prods = n
        else:
            runs, prods = runs + 1, prods + bool(made)
        state[tile] = runs, prods
        out[i] = (runs, prods, "0" if prods < n else "1")
    return out


@pytest.mark.parametrize("bits", [0, 2, 16])
def test_chain_quality_over_chunks(spark, monkeypatch, bits):
    """One tile with nearly all rows, all measured within one hour, in chunks of one
    row, four rows, or all."""
    monkeypatch.setattr(scale, "CHUNK_BITS", bits)
    rng = np.random.default_rng(bits)
    rows = []
    for i in range(240):
        tile = [None, "B", "A", "A", "A", "A"][int(rng.integers(0, 6))]
        mode = str(rng.choice(["init", "backward", "nominal", "none"], p=[0.05, 0.05, 0.8, 0.1]))
        rows.append((i, tile, T0 + dt.timedelta(seconds=int(rng.integers(0, 900))), None if mode == "none" else mode, [True, False, None][int(rng.integers(0, 3))]))
    df = spark.createDataFrame(rows, "id long, tile_id string, measurement_date timestamp, run_mode string, produced boolean")
    got = {r.id: tuple(r)[-3:] for r in se.chain_quality(df, 4).collect()}
    assert got == brute_chain(rows, 4)


def test_chunks_of_one_key_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(scale, "CHUNK_BITS", 5)
    line = scale.placed(spark.range(5000).select(F.lit("A").alias("k"), F.lit(1).alias("t"), "id"), ["k"], ["t", "id"])
    sizes = line.groupBy("_chunk").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high")).orderBy("_chunk").collect()
    assert max(r.n for r in sizes) <= 32 and all(a.high < b.low for a, b in zip(sizes, sizes[1:]))
    total = running_sum(line, ["k"], F.col("_chunk"), ["t", "id"], F.lit(1), "number")
    assert total.where("number <> id + 1").isEmpty()


def gap_tables(spark, day):
    """A tile with products on ``day`` and the day before, a tile with a gap-filled product only."""
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    catalogue = spark.createDataFrame(
        [("FSC_a_V100_1", "A", at(day, 9), at(day, 10)), ("WDS_b_V100_0", "A", at(day, 6), at(day, 8)), ("FSC_c_V100_1", "A", at(day - 1, 9), at(day - 1, 10))],
        "product_id string, tile_id string, measurement_date timestamp, publication_date timestamp",
    )
    gap = spark.createDataFrame(
        [("GFSC_x_100", "A", at(day - 1, 0)), ("GFSC_y_100", "B", at(day - 1, 0)), ("GFSC_y_090", "B", at(day - 2, 0)), ("GFSC_old_5", "C", at(day - 8, 0))],
        "product_id string, tile_id string, measurement_date timestamp",
    )
    contents = spark.createDataFrame([("GFSC_x_100", "FSC_c_V100_1"), ("GFSC_x_100", "WDS_b_V100_0")], "product_id string, input_id string")
    known = spark.createDataFrame(
        [], "triggering_product_id string, tile_id string, product_date date, curation_timestamp timestamp, triggering_product_publication_date timestamp, last_status_id int"
    )
    return catalogue, gap, contents, known, spark.createDataFrame([("A",), ("B",), ("C",)], "tile_id string")


def test_first_gap_filling_round(spark):
    now, start, day = dt.datetime(2024, 1, 21, 1), F.lit("2024-01-01").cast("timestamp"), dt.date(2024, 1, 20)
    tables = gap_tables(spark, 20)
    out = pl.gap_filling_round(*tables, now, start, day)
    jobs = {r.tile_id: (r.triggering_product_id, r.origin, r.state, r.gap_filled_id, r.n_inputs) for r in out["jobs"].collect()}
    # radar goes first; a gap-filled product a week old makes no daily job
    assert jobs == {"A": ("WDS_b_V100_0", "new", "ready", "GFSC_x_100", 3), "B": ("GFSC_y_100", "daily", "ready", "GFSC_y_100", 0)}
    # only a date whose products are all inside the gap-filled one goes
    assert {r.product_id: r.used for r in out["inputs"].collect()} == {"FSC_a_V100_1": True, "WDS_b_V100_0": True, "FSC_c_V100_1": False}


def test_gap_filling_round_after_an_interruption(spark):
    """No product of the day at all: no daily jobs; without any product, no jobs."""
    now, start = dt.datetime(2024, 1, 21, 1), F.lit("2024-01-01").cast("timestamp")
    catalogue, *rest = gap_tables(spark, 20)
    out = pl.gap_filling_round(catalogue.where("product_id = 'FSC_c_V100_1'"), *rest, now, start, dt.date(2024, 1, 20))
    assert out["jobs"].collect() == []
    out = pl.gap_filling_round(catalogue.limit(0), *rest, now, start, dt.date(2024, 1, 20))
    assert [out[k].count() for k in ("jobs", "inputs", "reprocessed")] == [0, 0, 0]


def test_gap_filling_round_goes_on_from_known_jobs(spark):
    """An open job of the tile and date is overridden by the newer one."""
    now, start = dt.datetime(2024, 1, 20, 12), F.lit("2024-01-01").cast("timestamp")
    catalogue, gap, contents, known, tiles = gap_tables(spark, 20)
    known = spark.createDataFrame(
        [("WDS_b_V100_0", "A", dt.date(2024, 1, 20), dt.datetime(2024, 1, 20, 8, 30), dt.datetime(2024, 1, 20, 8), 2)], known.schema
    )
    out = pl.gap_filling_round(catalogue, gap, contents, known, tiles, now, start)
    assert {(r.triggering_product_id, r.origin, r.state) for r in out["jobs"].collect()} == {
        ("WDS_b_V100_0", "open", "cancelled"), ("FSC_a_V100_1", "new", "waiting")
    }
