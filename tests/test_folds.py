"""Ordered rules over chunks against a plain loop over the whole key."""

import random

import pytest
from pyspark.sql import functions as F

from firnline import codes
from firnline.operators import jobs as jb
from firnline.operators import slices as sl

DAY = 86_400_000_000
SLICES = "stripe_id string, product_id string, start long, stop long, slice int, total_slices int"


def assemblies(rows, longest):
    """Rows of one stripe (product, start, stop, slice, total), one after the other."""
    part = lambda us: us % DAY // 1_000_000
    out, before, members, number = [], None, 0, 1
    for product, start, stop, piece, total in sorted(rows, key=lambda r: (r[1], r[0])):
        if before and part(start - before[0]) <= 1:
            continue
        last = not (piece and piece == total)
        if before is None:
            out.append((number, 0, product, piece != 1, last))
            members = 1
        elif (piece and before[2] and piece != before[2] + 1) or part(start - before[1]) > 1:
            number, members = number + 1, 1
            out.append((number, 0, product, True, last))
        elif members + 1 >= longest:
            out.append((number, members, product, False, last))
            number, members = number + 1, 1
            out.append((number, 0, product, True, last))
        else:
            out.append((number, members, product, False, last))
            members += 1
        before = (start, stop, piece)
    return out


def stripe(rng, n):
    """Crowded slices: repeats, a slice a day behind another, gaps, missing numbers."""
    rows, at, piece = [], 0, 0
    for i in range(n):
        at += rng.choice([0, 300_000, 900_000, 1_999_999, 2_000_000, 25_000_000, 25_000_000, DAY, DAY + 1_000_000, DAY - 1])
        piece = 0 if rng.random() < 0.2 else piece + rng.choice([1, 1, 1, 2])
        rows.append((f"p{i:04}", at, at + rng.choice([25_000_000, 24_000_000, 10_000_000, 26_500_000]), piece, 9))
    return rows


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_assemblies_in_small_chunks(spark, longest):
    rng = random.Random(longest)
    takes = {f"s{k}": stripe(rng, n) for k, n in enumerate([1, 2, 700, 40, 3])}
    df = spark.createDataFrame([(s, *r) for s, rows in takes.items() for r in rows] + [(None, "x", 1, 2, 1, 1), ("s0", "y", None, 2, 1, 1)], SLICES)
    df = df.selectExpr("*", "timestamp_micros(start) AS start_ts", "timestamp_micros(stop) AS stop_ts")
    for bits in (2, 5):
        got = sorted(map(tuple, sl.assemble_slices(df, longest, bits).collect()))
        assert got == sorted((s, *r) for s, rows in takes.items() for r in assemblies(rows, longest))


def test_one_cluster_of_repeats_over_many_chunks(spark):
    """Only the first of hundreds of slices within a second, and days apart, counts."""
    rows = [(f"p{i:04}", i * 1000 + i // 50 * DAY, i * 1000 + i // 50 * DAY + 5, 0, 0) for i in range(400)]
    df = spark.createDataFrame([("s", *r) for r in rows], SLICES).selectExpr("*", "timestamp_micros(start) AS start_ts", "timestamp_micros(stop) AS stop_ts")
    assert [(r.assembly_no, r.product_id) for r in sl.assemble_slices(df, chunk_bits=3).collect()] == [(1, "p0000")]


def test_empty_slices(spark):
    df = spark.createDataFrame([], SLICES).selectExpr("*", "timestamp_micros(start) AS start_ts", "timestamp_micros(stop) AS stop_ts")
    assert sl.assemble_slices(df).collect() == []


def test_verdicts_in_small_chunks(spark):
    rng = random.Random(5)
    log = [(i, 7 if rng.random() < 0.8 else rng.choice([8, 9, None]), rng.choice([*range(17), *range(17), 99, None])) for i in range(900)]
    status, want = {}, []
    for i, job, new in log:
        old = status.get(job, 0)
        ok = new in codes.ALLOWED_NEXT[old]
        want.append((job, i, old, new, ok))
        status[job] = new if ok else old
    df = spark.createDataFrame(log, "id long, fk_parent_job_id long, job_status int").withColumn("extra", F.lit(1))
    for bits in (3, 6, 16):
        assert sorted(map(tuple, jb.validate_log(df, bits).collect()), key=lambda r: r[1]) == want
