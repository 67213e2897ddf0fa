"""Streams: validation fold, early release, recovery from the checkpoint."""

import datetime as dt

from firnline import codes
from firnline.scale import latest_by
from firnline.streaming import intake as si
from firnline.streaming import run as sr
from firnline.streaming import status as ss

T0 = dt.datetime(2024, 1, 1)
LOG = "id long, fk_parent_job_id long, time timestamp, job_status int"


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(folder))


def run(spark, df, tmp_path, mode="append"):
    sr.use_rocksdb(spark)
    with sr.state_partitions(spark, 2):
        q = sr.start(df, sr.batch_writer(str(tmp_path / "out")), str(tmp_path / "cp"), mode)
        q.awaitTermination()
    return spark.read.schema(df.schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "out"))


def test_validation_survives_restart(spark, tmp_path):
    changes = [(i, 7, T0 + dt.timedelta(minutes=i), s) for i, s in enumerate([1, 3, 2, 3, 4, 9, 5])]
    write(spark, tmp_path / "in", "a", changes[:3], LOG)
    src = stream(spark, tmp_path / "in", LOG)
    run(spark, ss.validate_stream(src), tmp_path)
    write(spark, tmp_path / "in", "b", changes[3:], LOG)
    rows = run(spark, ss.validate_stream(stream(spark, tmp_path / "in", LOG)), tmp_path).orderBy("change_id").collect()
    status, want = 0, []
    for i, _, _, s in changes:
        ok = s in codes.ALLOWED_NEXT[status]
        want.append((i, status, ok))
        status = s if ok else status
    assert [(r.change_id, r.previous_status, r.accepted) for r in rows] == want


def test_early_release(spark, tmp_path):
    schema = "product_id string, tile_id string, product_date date, publication_date timestamp, optical boolean"
    day = T0.date()
    rows = [("o", "t", day, T0, True), ("r", "t", day, T0 + dt.timedelta(hours=1), False), ("late", "u", day, T0 + dt.timedelta(hours=9), False), ("wait", "v", day, T0 + dt.timedelta(hours=8), True)]
    write(spark, tmp_path / "in", "a", rows, schema)
    for early, reason in ((False, "held"), (True, "partner")):
        base = tmp_path / str(early)
        out = run(spark, si.hold_trigger(stream(spark, tmp_path / "in", schema), early_release=early), base)
        got = {r.product_id: r.reason for r in out.collect()}
        assert got == {"o": reason, "r": "immediate", "late": "immediate"}


def test_replaced_version_outside_valid_time(spark, tmp_path):
    schema = "product_id string, tile_id string, measurement_date timestamp, creation_date timestamp, publication_date timestamp"
    h = lambda x: T0 + dt.timedelta(hours=x)
    rows = [("a", "t", h(0), h(1), h(2)), ("b", "t", h(0), h(3), h(4)), ("same", "t", h(0), h(3), h(5)), ("late", "t", h(0), h(7), h(25))]
    write(spark, tmp_path / "in", "a", rows, schema)
    out = run(spark, si.replace_codated(stream(spark, tmp_path / "in", schema), watermark="2 days"), tmp_path)
    assert {r.product_id: r.replaces for r in out.collect()} == {"a": None, "b": "a"}


def test_last_status_updates(spark, tmp_path):
    write(spark, tmp_path / "in", "a", [(1, 1, T0, 1)], LOG)
    write(spark, tmp_path / "in", "b", [(2, 1, T0, 2), (3, 2, T0, 1)], LOG)
    out = run(spark, ss.status_state(stream(spark, tmp_path / "in", LOG)), tmp_path, "update")
    got = {r.parent_job_id: r.status for r in latest_by(out, ["parent_job_id"], ["change_id"]).collect()}
    assert got == {1: 2, 2: 1}


def test_stuck_alarm_fires_once(spark, tmp_path):
    m = lambda x: T0 + dt.timedelta(minutes=x)
    rows = [(1, 1, m(0), 4), (2, 2, m(0), 4), (3, 2, m(59), 5), (4, 3, m(500), 1)]
    write(spark, tmp_path / "in", "a", rows, LOG)
    out = run(spark, ss.stuck_alarm(stream(spark, tmp_path / "in", LOG)), tmp_path)
    got = sorted((r.parent_job_id, r.status) for r in out.collect())
    assert got == [(1, 4), (2, 5)]


def test_intake_of_several_files_out_of_order(spark, tmp_path):
    schema = "product_id string, publication_date timestamp"
    h = lambda x: T0 + dt.timedelta(hours=x)
    files = [[("p", h(0)), ("p", h(1))], [("q", h(100))], [("p", h(100)), ("r", h(20))], [("r", h(20)), ("s", h(101))]]
    for k, rows in enumerate(files):
        write(spark, tmp_path / "in", str(k), rows, schema)
        q = sr.start(stream(spark, tmp_path / "in", schema), si.intake(str(tmp_path / "out")), str(tmp_path / "cp"))
        q.awaitTermination()
        assert q.exception() is None
    got = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "out")).collect()
    assert sorted(map(tuple, got)) == [("p", h(0)), ("q", h(100)), ("r", h(20)), ("s", h(101))]


def test_late_version_is_no_second_reference(spark, tmp_path):
    schema = "product_id string, tile_id string, measurement_date timestamp, creation_date timestamp, publication_date timestamp"
    h = lambda x: T0 + dt.timedelta(hours=x)
    files = [[("a", "t", h(0), h(1), h(2))], [("b", "t", h(0), h(3), h(4))], [("x", "u", h(50), h(51), h(58))], [("y", "u", h(50), h(52), h(59))], [("c", "t", h(0), h(5), h(60))]]
    for k, rows in enumerate(files):
        write(spark, tmp_path / "in", str(k), rows, schema)
        out = run(spark, si.replace_codated(stream(spark, tmp_path / "in", schema)), tmp_path)
    assert sorted((r.product_id, r.replaces) for r in out.collect()) == [("a", None), ("b", "a"), ("x", None), ("y", "x")]


def test_intake_reads_only_buckets_of_its_ids(spark, tmp_path):
    assert si.runs_before(0) == [] and si.runs_before(7) == [(0, i) for i in range(7)]
    assert si.runs_before(74) == [(2, 0), (1, 64), (0, 72), (0, 73)]
    schema = "product_id long, publication_date timestamp"
    add = si.intake(str(tmp_path / "out"))
    for k in range(17):
        # fifty new ids, some of the batch before, one of the first batch, one without id
        ids = [*range(k * 50, k * 50 + 50), *range(max(k * 50 - 5, 0), k * 50), 3, None]
        add(spark.createDataFrame([(i, T0) for i in ids], schema), k)
    kept = spark.read.schema(schema).parquet(str(tmp_path / "out"))
    assert sorted(r[0] for r in kept.collect() if r[0] is not None) == list(range(17 * 50))
    assert kept.where("product_id IS NULL").count() == 1
    # a replayed batch sees the batches before it only
    add(spark.createDataFrame([(i, T0) for i in (800, 801, 7)], schema), 16)
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out" / "batch_id=16")).collect()) == [800, 801]
    read = lambda ids: si.stored_ids(spark.createDataFrame([(i,) for i in ids], "product_id long"), str(tmp_path / "out_ids"), 17)
    from pyspark.sql import functions as F

    for ids in ([3], [3, 4, 900]):
        found = read(ids)
        assert found.select(F.input_file_name()).distinct().count() <= len(ids) * len(si.runs_before(17))
        assert set(ids) & set(range(800)) <= {r.product_id for r in found.collect()}


def test_state_of_ended_jobs_goes(spark, tmp_path):
    """Job 1 is cancelled, job 2 done; after a silence only job 1 begins anew."""
    d = lambda x: T0 + dt.timedelta(days=x)
    files = [
        [(1, 1, d(0), 1), (2, 1, d(0), 16), (3, 2, d(0), 5), (4, 2, d(0), 6)], [(5, 3, d(9), 1)], [(6, 3, d(41), 2)], [(7, 3, d(42), 3)],
        [(8, 1, d(50), 1), (9, 2, d(50), 7)],
    ]
    for k, rows in enumerate(files):
        write(spark, tmp_path / "in", str(k), rows, LOG)
        out = run(spark, ss.validate_stream(stream(spark, tmp_path / "in", LOG), keep_days=30), tmp_path)
    got = {r.change_id: (r.previous_status, r.accepted) for r in out.collect()}
    assert got[8] == (0, True) and got[9] == (6, True) and got[7] == (2, True)


def test_cancelled_job_is_kept_through_the_silence(spark, tmp_path):
    d = lambda x: T0 + dt.timedelta(days=x)
    files = [[(1, 1, d(0), 16)], [(2, 2, d(29), 1)], [(3, 2, d(29), 2)], [(4, 1, d(29), 1), (5, 1, d(29), 13)]]
    for k, rows in enumerate(files):
        write(spark, tmp_path / "in", str(k), rows, LOG)
        out = run(spark, ss.validate_stream(stream(spark, tmp_path / "in", LOG), keep_days=30), tmp_path)
    got = {r.change_id: (r.previous_status, r.accepted) for r in out.collect()}
    assert got[4] == (16, False) and got[5] == (16, True)


def test_retry_counts_over_restarts(spark, tmp_path):
    m = lambda x: T0 + dt.timedelta(minutes=x)
    changes = [9, 12, 14, 5, 12, 14, 5, 9, 12, 14]
    for i, s in enumerate(changes):
        if i % 3 == 0:
            write(spark, tmp_path / "in", str(i), [(j, 1, m(j), changes[j]) for j in range(i, min(i + 3, len(changes)))], LOG)
            out = run(spark, ss.retry_stream(stream(spark, tmp_path / "in", LOG)), tmp_path)
    assert sorted((r.change_id, r.failures, r.permanent) for r in out.collect()) == [(2, 1, False), (5, 2, False), (9, 3, True)]


def test_production_days_with_silence(spark, tmp_path):
    schema = "family string, created timestamp"
    d = lambda x: T0 + dt.timedelta(days=x, hours=3)
    bands = spark.createDataFrame([("a", 1, 2), ("b", 1, 2)], "family string, lower int, upper int")
    files = [[("a", d(0))] * 3 + [("c", d(1))], [("b", d(5))], [("a", d(9))], [("a", d(14))]]
    for k, rows in enumerate(files):
        write(spark, tmp_path / "in", str(k), rows, schema)
        q = sr.start(si.daily_counts(stream(spark, tmp_path / "in", schema)), si.production_days(str(tmp_path / "out"), bands), str(tmp_path / "cp"))
        q.awaitTermination()
        assert q.exception() is None
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    got = {(r.family, (r.day - T0.date()).days): (r.n_jobs, r.verdict) for r in rows}
    assert len(rows) == len(got)
    want = {(f, k): (0, "below") for f in "ab" for k in range(10)}
    want |= {("a", 0): (3, "above"), ("b", 5): (1, "nominal"), ("a", 9): (1, "nominal"), ("c", 1): (1, "nominal")}
    assert got == want


def test_tiles_of_a_day_share_a_call(spark, tmp_path, monkeypatch):
    """Many tile-days: as few processor calls as groups, every tile-day on its own,
    over a restart and through the end of the wait."""
    monkeypatch.setattr(si, "TILE_GROUPS", 2)
    calls = spark.sparkContext.accumulator(0)
    for processor in (si._Replace, si._Hold):
        def counted(self, key, rows, timerValues, inner=processor.handleInputRows):
            calls.add(1)
            return inner(self, key, rows, timerValues)

        monkeypatch.setattr(processor, "handleInputRows", counted)
    schema = "product_id string, tile_id string, measurement_date timestamp, creation_date timestamp, publication_date timestamp"
    m = lambda x: T0 + dt.timedelta(minutes=x)
    for k in range(2):
        write(spark, tmp_path / "r", str(k), [(f"{i}.{k}", f"t{i}", m(i % 3), m(5 + k), m(10 + k)) for i in range(60)], schema)
        out = run(spark, si.replace_codated(stream(spark, tmp_path / "r", schema)), tmp_path / "a")
    assert sorted((r.tile_id, r.product_id, r.replaces) for r in out.collect()) == sorted(
        (f"t{i}", f"{i}.{k}", f"{i}.0" if k else None) for i in range(60) for k in range(2))
    schema = "product_id string, tile_id string, product_date date, publication_date timestamp, optical boolean"
    files = [[(f"o{i}", f"t{i}", T0.date(), m(i), True) for i in range(60)], [("x", "far", T0.date(), m(209), False)], [("y", "far", T0.date(), m(400), False)]]
    held = []
    for k, rows in enumerate(files):
        write(spark, tmp_path / "h", str(k), rows, schema)
        out = run(spark, si.hold_trigger(stream(spark, tmp_path / "h", schema)), tmp_path / "b").where("reason = 'held'").collect()
        held.append(sorted(int(r.product_id[1:]) for r in out))
        assert all(r.tile_id == "t" + r.product_id[1:] and r.fired_at_ms == int((m(180 + int(r.product_id[1:])) - dt.datetime(1970, 1, 1)).total_seconds()) * 1000 for r in out)
    assert held == [[], list(range(29)), list(range(60))]
    assert calls.value <= 12


def test_days_of_a_group_share_a_call(spark, tmp_path, monkeypatch):
    """Tiles on many days: calls do not grow with the days, each tile-day stays on its
    own, over spans of state, a restart, partners and the end of the wait."""
    monkeypatch.setattr(si, "TILE_GROUPS", 2)
    calls = spark.sparkContext.accumulator(0)
    for processor in (si._Replace, si._Hold):
        for name in ("handleInputRows", "handleExpiredTimer"):
            def counted(self, *a, inner=getattr(processor, name), **named):
                calls.add(1)
                return inner(self, *a, **named)

            monkeypatch.setattr(processor, name, counted)
    at = lambda day, h: T0 + dt.timedelta(days=day, hours=h)
    schema = "product_id string, tile_id string, product_date date, publication_date timestamp, optical boolean"
    days = [*range(0, 80, 2), None]
    optical = [(f"o{d}", t, d if d is None else at(d, 0).date(), at(90, d or 1), True) for d in days for t in ("t", None)]
    # a partner on day 4 alone, before the wait of any but day 0 ends
    files = [optical, [("x", "t", at(4, 0).date(), at(90, 3), False), ("late", "t", at(4, 0).date(), at(90, 85), True)], [("y", "far", at(0, 0).date(), at(200, 0), False)]]
    for early in (False, True):
        for k, rows in enumerate(files):
            write(spark, tmp_path / f"h{early}", str(k), rows, schema)
            out = run(spark, si.hold_trigger(stream(spark, tmp_path / f"h{early}", schema), early_release=early, watermark="4 days"), tmp_path / f"a{early}")
        got = {(r.product_id, r.tile_id, r.product_date): r.reason for r in out.collect() if r.product_id not in "xy"}
        want = {(p, str(t), d): "held" for p, t, d, *_ in optical} | {("late", "t", at(4, 0).date()): "held"}
        if early:
            want |= {("o4", "t", at(4, 0).date()): "partner", ("late", "t", at(4, 0).date()): "partner"}
        assert got == want
    schema = "product_id string, tile_id string, measurement_date timestamp, creation_date timestamp, publication_date timestamp"
    for k in range(2):
        rows = [(f"{d}.{k}", "t", at(d, 0), at(d, 1 + k), at(d, 2 + k)) for d in range(0, 80, 2)]
        write(spark, tmp_path / "r", str(k), rows, schema)
        out = run(spark, si.replace_codated(stream(spark, tmp_path / "r", schema), watermark="100 days"), tmp_path / "b")
    assert sorted((r.product_id, r.replaces) for r in out.collect()) == sorted(
        (f"{d}.{k}", f"{d}.0" if k else None) for d in range(0, 80, 2) for k in range(2))
    assert calls.value <= 40
