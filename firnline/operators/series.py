"""Time series of optical jobs per tile: predecessors, modes, backward plans.

A tile's series is cut into chunks of a bounded number of rows wherever rows must
be ordered, so one crowded tile or hour is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from itertools import accumulate
from typing import Any

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from firnline import codes
from firnline.operators.filters import in_range
from firnline.scale import carry, epoch_us, latest_by, placed, running_sum
from firnline.session import cut_lineage

US = 1_000_000


# --- previous usable job ---------------------------------------------------------
#: Rows of a block, and children of a block of the level above.
PREVIOUS_FANOUT = 32


def _able(least: Column, created: Column, source: Column) -> Column:
    """A block holds a row created before ``created`` by another source: ``least``
    has its first creation, that row's source, and the first by any other source."""
    same = least["source"].eqNullSafe(source)
    return F.coalesce(F.when(same, least["other"] < created).otherwise(least["first"] < created), F.lit(False))


def _least(children: Column, first: Callable, source: Callable, other: Callable) -> Column:
    """Summary of a block from its children, see :func:`_able`."""
    best = F.array_min(F.transform(children, lambda x: F.struct(first(x).alias("first"), source(x).alias("source"))))

    def summary(one: Column) -> Column:
        second = F.array_min(F.transform(children, lambda x: F.when(source(x).eqNullSafe(one["source"]), other(x)).otherwise(first(x))))
        return F.struct(one["first"].alias("first"), one["source"].alias("source"), second.alias("other"))

    return F.transform(F.array(best), summary)[0]


def latest_created_before(candidates: DataFrame, asking: DataFrame) -> DataFrame:
    """``id, prev_id, prev_m`` for every asking row that has a predecessor: the
    last candidate measured no later, created strictly earlier, from another
    source.

    Both inputs: ``tile_id, rule, id, m, c, chg, source`` (times in
    microseconds); rows meet within a tile and rule.  All rows are sorted over the
    cluster and cut into blocks of a fixed number of rows, so neither a crowded
    tile nor a crowded hour makes a large task.  A block answers its own rows.  What
    stays open meets, in one join, the blocks before its own under each of its
    ancestors; the nearest that can answer is descended, one join a level.
    """
    keys, fan = ["tile_id", "rule"], PREVIOUS_FANOUT
    none = F.lit(None)

    def rows(df: DataFrame, side: int) -> DataFrame:
        return df.select(*keys, "m", F.lit(side).alias("side"), "c", "chg", "id", "source")

    line = rows(candidates.where("m is not null and c is not null"), 0).unionByName(rows(asking, 1))
    at = F.monotonically_increasing_id()
    row = F.struct("at", "id", "m", "c", "source")
    blocks = (
        line.orderBy(*keys, "m", "side", "c", "chg", "id").withColumn("at", at)
        .groupBy(*keys, F.floor(F.col("at") / fan).alias("block"))
        .agg(F.collect_list(F.when(F.col("side") == 0, row)).alias("rows"), F.collect_list(F.when(F.col("side") == 1, row)).alias("asks"))
    )

    def last_before(ask: Column) -> Column:
        return F.array_max(F.filter("rows", lambda x: (x["at"] < ask["at"]) & (x["c"] < ask["c"]) & ~x["source"].eqNullSafe(ask["source"])))

    asks = F.transform("asks", lambda q: F.struct(q["id"].alias("id"), q["c"].alias("c"), q["source"].alias("source"), last_before(q).alias("found")))
    # partition in the high bits of a block's number, its place there in the low ones
    bits = 33 - (fan.bit_length() - 1)
    blocks = cut_lineage(blocks.select(*keys, "block", "rows", asks.alias("asks")))
    sizes = dict(
        blocks.groupBy(F.shiftright("block", bits).alias("part")).agg(F.max(F.col("block").bitwiseAND((1 << bits) - 1))).collect()
    )
    parts = sorted(sizes)
    starts = dict(zip(parts, accumulate((sizes[p] + 1 for p in parts), initial=0)))
    total = sum(sizes[p] + 1 for p in parts)
    depth = 1
    while fan**depth < total:
        depth += 1
    part = blocks.sparkSession.createDataFrame([(p, n) for p, n in starts.items()], "part long, start long")
    blocks = blocks.withColumn("part", F.shiftright("block", bits)).join(part, "part").select(
        *keys, (F.col("start") + F.col("block").bitwiseAND((1 << bits) - 1)).alias("block"), "rows", "asks"
    )
    asked = blocks.select(*keys, "block", F.explode("asks").alias("q")).select(*keys, "block", "q.*")
    answered = asked.where("found is not null").select("id", F.col("found.id").alias("prev_id"), F.col("found.m").alias("prev_m"))

    # nodes of all levels: a node's children are the blocks of the level below
    below = blocks.where(F.size("rows") > 0).select(
        *keys, "block", _least(F.col("rows"), lambda x: x["c"], lambda x: x["source"], lambda x: none.cast("long")).alias("least"))
    levels = []
    for level in range(1, depth + 1):
        node = below.groupBy(*keys, F.floor(F.col("block") / fan).alias("block")).agg(F.collect_list(F.struct("block", "least")).alias("children"))
        levels.append(node.withColumn("level", F.lit(level)))
        below = node.select(*keys, "block", _least(
            F.col("children"), lambda x: x["least"]["first"], lambda x: x["least"]["source"], lambda x: x["least"]["other"]).alias("least"))
    nodes = reduce(DataFrame.unionByName, levels)

    def last_able(before: Column) -> Column:
        able = F.filter("children", lambda x: (x["block"] < before) & _able(x["least"], F.col("c"), F.col("source")))
        return F.array_max(F.transform(able, lambda x: x["block"]))

    up = asked.where("found is null").select(
        *keys, "id", "c", "source", "block", F.explode(F.sequence(F.lit(1), F.lit(depth))).alias("level")
    ).withColumns({
        "child": F.floor(F.col("block") / F.pow(F.lit(fan), F.col("level") - 1)).cast("long"),
        "block": F.floor(F.col("block") / F.pow(F.lit(fan), F.col("level"))).cast("long"),
    })
    front = (
        up.join(nodes, [*keys, "level", "block"]).withColumn("hit", last_able(F.col("child"))).where("hit is not null")
        .groupBy(*keys, "id", "c", "source").agg(F.min(F.struct((F.col("level") - 1).alias("level"), "hit")).alias("_at"))
        .select(*keys, "id", "c", "source", F.col("_at.level").alias("level"), F.col("_at.hit").alias("block"))
    )
    for level in range(depth - 1, 0, -1):
        # questions that stand on a lower level find no node and stay there
        here = levels[level - 1].select(*keys, "level", "block", "children")
        front = front.join(here, [*keys, "level", "block"], "left").select(
            *keys, "id", "c", "source",
            F.when(F.col("children").isNull(), F.col("level")).otherwise(F.col("level") - 1).alias("level"),
            F.coalesce(last_able(F.lit(total)), "block").alias("block"),
        )
    leaves = blocks.where(F.size("rows") > 0).select(*keys, "block", "rows")
    found = front.join(leaves, [*keys, "block"]).select(
        "id", last_before(F.struct(F.lit((1 << 63) - 1).alias("at"), "c", "source")).alias("found"))
    return answered.unionByName(found.select("id", F.col("found.id").alias("prev_id"), F.col("found.m").alias("prev_m")))


def previous_usable(jobs: DataFrame, allow_codated: bool = False, asking: Column | None = None) -> DataFrame:
    """The earlier job each job builds on.

    ``jobs``: ``id, tile_id, measurement_date, creation_date, source_id,
    last_status_id, last_status_change_id, output_status, reference_job,
    reprocessing_context``.  Candidates are measured no later, created strictly
    earlier, come from another source, and have an output or may still get one.
    The answer is dropped when it is not measured strictly earlier, even if an
    older candidate exists.
    """
    generated = F.col("output_status") == "generated"
    pending = F.col("output_status") == "pending"
    backward = F.coalesce(F.col("reprocessing_context") == "backward", F.lit(False))
    shown = F.lit(True) if allow_codated else F.coalesce("reference_job", F.lit(False))
    flat = jobs.select(
        F.col("tile_id").cast("string").alias("tile_id"),
        "id",
        epoch_us("measurement_date").alias("m"),
        epoch_us("creation_date").alias("c"),
        F.col("last_status_change_id").cast("long").alias("chg"),
        F.col("source_id").cast("string").alias("source"),
        (shown & (generated | (pending & ~F.col("last_status_id").isin(13, 14, 16)))).alias("ok"),
        (shown & (generated | (pending & (F.col("last_status_id") != 16)))).alias("ok_backward"),
        backward.alias("backward"),
        (F.lit(True) if asking is None else asking).alias("ask"),
    )
    # rule 0: plain jobs; rule 1: re-run jobs, which may also build on failed ones
    cols = ["tile_id", "rule", "id", "m", "c", "chg", "source"]
    usable = flat.withColumn(
        "rule", F.explode(F.filter(F.array(F.when(F.col("ok"), 0), F.when(F.col("ok_backward"), 1)), lambda r: r.isNotNull()))
    )
    asks = flat.where("ask").withColumn("rule", F.col("backward").cast("int"))
    found = latest_created_before(usable.select(*cols), asks.select(*cols))
    return asks.select("id", "m").join(found, "id").where(F.col("prev_m") < F.col("m")).select("id", "prev_id")


# --- following jobs ------------------------------------------------------------------
def following(
    jobs: DataFrame, tile_id: Any, measured_from: Any, created_after: Any, n: int
) -> DataFrame:
    """The ``n`` reference jobs of a tile measured from a date on, ascending."""
    return (
        jobs.where(
            (F.col("tile_id") == tile_id)
            & (F.col("measurement_date") >= measured_from)
            & (F.col("creation_date") > created_after)
            & F.coalesce("reference_job", F.lit(False))
        )
        .orderBy("measurement_date", "id")
        .limit(n)
    )


#: Children of a block in the search tree of :func:`next_n`.
FANOUT = 16


def next_n(anchors: DataFrame, rows: DataFrame, n: int, keys: tuple[str, ...] = ("tile_id",)) -> DataFrame:
    """First ``n`` rows measured from each anchor's time on and created after it.

    Both: keys, ``id, m, c`` in microseconds.  Rows are numbered along their key.
    An anchor first asks for the next ``2 * n`` numbers, which answers nearly all.
    The others search blocks of numbers from the largest down, each with its latest
    creation: a block after the anchor whose latest creation is later holds a hit,
    so the first ``n + 1`` such blocks of a level hold all answers.  An anchor thus
    meets a bounded number of blocks per level, however many rows between its
    dates were created too early; the levels grow with the logarithm of the rows.
    """
    def marks(df: DataFrame, side: int, weight: int) -> DataFrame:
        return df.select(
            *keys, "id", F.col("m").alias("t"), "m", "c", F.lit(side).alias("side"), F.lit(weight).alias("weight")
        )

    line = marks(anchors, -1, 0).unionByName(marks(rows, 0, 1))
    order_of = ["t", "side", "id"]
    # read by every step below, so kept once in the shared folder
    numbered = cut_lineage(running_sum(placed(line, keys, order_of), keys, F.col("_chunk"), order_of, F.col("weight"), "number").drop("_chunk"))
    leaves = numbered.where("side = 0").select(
        *keys, "number", F.col("id").alias("next_id"), F.col("m").alias("next_m"), F.col("c").alias("latest")
    )
    asked = numbered.where("side = -1").select(*keys, "id", "c", F.col("number").alias("before"))
    order = Window.partitionBy(*keys, "id", "c", "before").orderBy("number")

    def hits(wanted: DataFrame) -> DataFrame:
        return wanted.join(leaves, [*keys, "number"]).where((F.col("latest") > F.col("c")) & (F.col("number") > F.col("before")))

    near = hits(asked.withColumn("number", F.explode(F.sequence(F.col("before") + 1, F.col("before") + 2 * n))))
    full = near.groupBy(*keys, "id", "c", "before").agg(F.count("*").alias("_hits")).where(F.col("_hits") >= n)
    count = numbered.groupBy(*keys).agg(F.max("number").alias("_last"))
    last = numbered.agg(F.max("number")).first()[0] or 0
    far = (
        asked.join(count, list(keys)).where(F.col("before") + 2 * n < F.col("_last")).drop("_last")
        .join(full, [*keys, "id", "c", "before"], "left_anti")
    )

    # levels of blocks: block k of a level covers the numbers under floor(number / width) = k
    levels, width = [], 1
    below = leaves.select(*keys, "number", "latest")
    while True:
        level = below.groupBy(*keys, F.floor(F.col("number") / FANOUT).alias("block")).agg(
            F.max("latest").alias("latest"), F.collect_list(F.struct("number", "latest")).alias("children")
        )
        levels.append((level.select(*keys, "block", "children"), width))
        below = level.select(*keys, F.col("block").alias("number"), "latest")
        width *= FANOUT
        if last < width:
            break
    front = far.withColumn("block", F.lit(0).cast("long"))
    for level, width in reversed(levels):
        later = F.filter(
            "children",
            lambda k: (k["latest"] > F.col("c")) & ((k["number"] + 1) * width - 1 > F.col("before")),
        )
        found = front.join(level, [*keys, "block"]).select(*keys, "id", "c", "before", F.explode(later).alias("_k"))
        found = found.select(*keys, "id", "c", "before", F.col("_k.number").alias("number"))
        front = (
            found.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= n + 1).drop("_nth")
            .withColumnRenamed("number", "block")
        )
    answers = near.join(far, [*keys, "id", "c", "before"], "left_anti").unionByName(hits(front.withColumnRenamed("block", "number")))
    return (
        answers.withColumn("position", (F.row_number().over(order) - 1).cast("int")).where(F.col("position") < n)
        .select(*keys, "id", "position", "next_id", "next_m")
    )


def asof_previous(
    left: DataFrame, right: DataFrame, keys: list[str], time: str, value: list[str]
) -> DataFrame:
    """Latest ``right`` row at or before each ``left`` row of the key.

    Both: keys, ``id`` and ``time``.  One timeline, one carried value.
    """
    r = right.select(
        *keys, F.col(time).alias("_t"), F.lit(0).alias("_side"), F.col("id").alias("_id"),
        F.struct(*value).alias("_payload"), F.lit(None).cast("long").alias("_left"),
    )
    l = left.select(
        *keys, F.col(time).alias("_t"), F.lit(1).alias("_side"), F.col("id").alias("_id"),
        F.lit(None).cast(r.schema["_payload"].dataType).alias("_payload"), F.col("id").cast("long").alias("_left"),
    )
    order = ["_t", "_side", "_id"]
    line = placed(r.unionByName(l), keys, order)
    out = carry(line, keys, F.col("_chunk"), order, F.col("_payload"), "_found")
    return out.where("_side = 1").select(
        *keys, F.col("_left").alias("id"), *[F.col(f"_found.{c}").alias(f"previous_{c}") for c in value]
    )


# --- runs and counters ------------------------------------------------------------------
def consecutive(jobs: DataFrame, days: int = codes.CONSECUTIVE_DAYS, keys: tuple[str, ...] = ("tile_id",)) -> DataFrame:
    """Whether every gap between neighbours of a key is at most ``days``."""
    line = placed(jobs.select(*keys, "id", epoch_us("measurement_date").alias("_us")), keys, ["_us", "id"])
    prev = carry(line, list(keys), F.col("_chunk"), ["_us", "id"], F.col("_us"), "_before")
    gap = F.col("_us") - F.col("_before")
    return prev.groupBy(*keys).agg(
        F.count("*").alias("n_jobs"),
        F.coalesce(F.max(gap), F.lit(0)).alias("largest_gap_us"),
        F.coalesce(F.bool_and(gap <= F.lit(days * 86400 * US)), F.lit(True)).alias("consecutive"),
    )


def chain_quality(jobs: DataFrame, n: int = codes.BACKWARD_JOBS) -> DataFrame:
    """Counters since the last init or backward job, and the quality flag.

    An init job restarts at 0 and a backward job at ``n``; each later job of the
    chain adds one run, and one product when it made one.  Quality is "0" below
    ``n`` products.
    """
    start = F.coalesce(F.col("run_mode").isin("init", "backward"), F.lit(False))
    base = F.when(F.col("run_mode") == "backward", F.lit(n)).otherwise(F.lit(0))
    made = F.coalesce("produced", F.lit(False)) & ~start
    order, tile = ["_us", "id"], ["tile_id"]
    line = placed(jobs.withColumn("_us", epoch_us("measurement_date")), tile, order)

    def upto(*keys: str, by: Sequence[str]) -> WindowSpec:
        return Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)

    # the state after each row, as far as its chunk tells: starts met, and since the
    # last one the runs, the products and what the start counted from
    chunk = [*tile, "_chunk"]
    line = line.withColumn("_starts", F.sum(start.cast("int")).over(upto(*chunk, by=order)))
    own = upto(*chunk, "_starts", by=order)
    line = line.withColumns({
        "_runs": F.sum((~start).cast("long")).over(own), "_made": F.sum(made.cast("long")).over(own),
        "_base": F.when(F.col("_starts") > 0, F.first(base).over(own)).otherwise(0).cast("long"),
    })
    state = F.struct("_starts", "_runs", "_made", "_base")
    ends = line.groupBy(*chunk).agg(F.max_by(state, F.struct(*order)).alias("_e")).select(*chunk, "_e.*")
    # states of the chunks put together along the tile: one row a chunk
    ends = ends.withColumn("_since", F.sum((F.col("_starts") > 0).cast("int")).over(upto(*tile, by=["_chunk"])))
    along = upto(*tile, "_since", by=["_chunk"])
    ends = ends.select(*chunk, *[F.sum(c).over(along).alias(c) for c in ("_runs", "_made")], F.first("_base").over(along).alias("_base"))
    before = Window.partitionBy(*tile).orderBy("_chunk")
    came = ends.select(
        F.col("tile_id").alias("_tile"), F.col("_chunk").alias("_at"), *[F.lag(c, 1, 0).over(before).alias(f"{c}_in") for c in ("_runs", "_made", "_base")]
    )
    joined = line.join(came, F.col("tile_id").eqNullSafe(F.col("_tile")) & (F.col("_chunk") == F.col("_at")))

    def total(c: str) -> Column:
        carried = F.when(F.col("_starts") > 0, F.lit(0)).otherwise(F.col(f"{c}_in") + F.col("_base_in"))
        return F.col(c) + F.col("_base") + carried

    return joined.select(
        *jobs.columns,
        total("_runs").alias("n_jobs_run_since_last_init"),
        total("_made").alias("n_l2a_produced_since_last_init"),
        F.when(total("_made") < n, "0").otherwise("1").alias("quality_flag"),
    )


# --- readiness and mode ---------------------------------------------------------------------
def readiness(jobs: DataFrame, previous: DataFrame, asking: Column | None = None) -> DataFrame:
    """``ready``, ``configured`` or ``internal_error`` from the job built upon,
    for all jobs or those ``asking``."""
    prev = jobs.select(
        F.col("id").alias("prev_id"),
        F.col("last_status_id").alias("prev_status"),
        F.col("output_status").alias("prev_output"),
    )
    backward = F.coalesce(F.col("reprocessing_context") == "backward", F.lit(False))
    waits = (F.col("prev_status") < codes.STATUS["processed"]) | (backward & F.col("prev_status").isin(13, 14))
    state = (
        F.when(F.col("prev_id").isNull(), "ready")
        .when(F.col("prev_status").isNull(), "internal_error")
        .when(waits, "configured")
        .when(F.col("prev_output") == "generated", "ready")
        .otherwise("configured")
    )
    asked = jobs if asking is None else jobs.where(asking)
    return asked.join(previous, "id", "left").join(prev, "prev_id", "left").withColumn("readiness", state)


def degraded(jobs: DataFrame) -> DataFrame:
    """Jobs with a degraded product not reprocessed yet."""
    flag = F.element_at(F.split(F.col("snow_path"), "_"), -1)
    return jobs.where(
        (F.col("output_status") == "generated")
        & F.col("snow_path").isNotNull()
        & ~F.coalesce("backward_reprocessing_run", F.lit(False))
        & F.coalesce("reference_job", F.lit(False))
        & (flag == "0")
    )


def backward_lists(
    jobs: DataFrame, asking: DataFrame, required: int = codes.BACKWARD_JOBS, days: int = codes.CONSECUTIVE_DAYS
) -> DataFrame:
    """Jobs a backward run of each asking job would use: itself and the next
    ``required - 1`` degraded ones, all neighbours within ``days``."""
    def flat(df: DataFrame) -> DataFrame:
        return df.select("tile_id", "id", epoch_us("measurement_date").alias("m"), epoch_us("creation_date").alias("c"))

    n = required - 1
    nexts = next_n(flat(asking), flat(degraded(jobs)), n)
    own = flat(asking).select(
        "tile_id", "id", F.lit(-1).alias("position"), F.col("id").alias("next_id"), F.col("m").alias("next_m")
    )
    limit = F.lit(days * 86400 * US)
    member = F.struct("position", "next_m", "next_id")
    lists = own.unionByName(nexts).groupBy("tile_id", "id").agg(F.array_sort(F.collect_list(member)).alias("_l"))
    gaps_ok = F.forall(
        F.sequence(F.lit(1), F.size("_l") - 1),
        lambda i: F.abs(F.get("_l", i)["next_m"] - F.get("_l", i - 1)["next_m"]) <= limit,
    )
    # a list holds at most eight members
    return (
        lists.where((F.size("_l") == n + 1) & (F.size("_l") > 1))
        .where(gaps_ok)
        .select("tile_id", "id", F.transform("_l", lambda x: x["next_id"]).alias("member_ids"))
    )


def assign_mode(
    jobs: DataFrame,
    previous: DataFrame,
    required: int = codes.BACKWARD_JOBS,
    days: int = codes.CONSECUTIVE_DAYS,
    allow_backward: bool = True,
) -> DataFrame:
    """Run mode of jobs that have none yet, with counters and inputs.

    nominal: a usable predecessor at most ``days`` away whose output still
    exists; backward: enough degraded followers; wait: no predecessor while
    backward runs are allowed; else init.
    """
    open_jobs = jobs.where(F.col("run_mode").isNull())
    prev = jobs.select(
        F.col("id").alias("prev_id"),
        F.col("measurement_date").alias("_pm"),
        F.col("output_deleted").alias("_pdel"),
        F.col("n_jobs_run_since_last_init").alias("_pruns"),
        F.col("n_l2a_produced_since_last_init").alias("_pmade"),
    )
    # asked twice below, and the search for predecessors is many joins
    base = cut_lineage(open_jobs.join(previous, "id", "left").join(prev, "prev_id", "left"))
    near = F.abs(epoch_us("measurement_date") - epoch_us("_pm")) <= F.lit(days * 86400 * US)
    nominal = F.coalesce(near & ~F.coalesce("_pdel", F.lit(False)), F.lit(False))
    if allow_backward:
        asking = base.where(~nominal).select(*open_jobs.columns)
        lists = backward_lists(jobs, asking, required, days).drop("tile_id")
        base = base.join(lists, "id", "left")
    else:
        base = base.withColumn("member_ids", F.lit(None).cast("array<bigint>"))
    mode = (
        F.when(nominal, "nominal")
        .when(F.col("member_ids").isNotNull(), "backward")
        .when(F.col("prev_id").isNull() & F.lit(allow_backward), "wait")
        .otherwise("init")
    )
    size = F.size("member_ids").cast("long")
    zero = F.lit(0).cast("long")
    runs = F.when(mode == "nominal", F.col("_pruns") + 1).when(mode == "backward", size).when(mode == "init", zero)
    made = F.when(mode == "nominal", F.col("_pmade")).when(mode == "backward", size).when(mode == "init", zero)
    return base.select(
        "id", "tile_id", mode.alias("run_mode"),
        F.when(mode == "nominal", F.col("prev_id")).alias("previous_id"),
        F.when(mode == "backward", F.col("member_ids")).alias("member_ids"),
        runs.alias("n_jobs_run_since_last_init"),
        made.alias("n_l2a_produced_since_last_init"),
    )


def last_init(jobs: DataFrame, before: Column | None = None) -> DataFrame:
    """Latest init job of each tile with an output and no backward run yet."""
    fit = (
        (F.col("run_mode") == "init")
        & ~F.col("backward_reprocessing_run")
        & (F.col("output_status") == "generated")
    )
    rows = jobs.where(fit if before is None else fit & before)
    return latest_by(rows, ["tile_id"], [epoch_us("measurement_date"), "id"])


def backward_plan(
    jobs: DataFrame, triggered_tiles: DataFrame, required: int = codes.BACKWARD_JOBS, days: int = codes.CONSECUTIVE_DAYS
) -> tuple[DataFrame, DataFrame]:
    """Re-issued jobs for the last init job of each triggered tile, and the ids
    that stop being the reference.

    ``triggered_tiles``: ``tile_id, trigger_measurement`` of a chain long enough.
    """
    t = triggered_tiles.groupBy("tile_id").agg(F.max("trigger_measurement").alias("_trigger"))
    eligible = jobs.join(t, "tile_id").where(F.col("measurement_date") < F.col("_trigger")).select(*jobs.columns)
    init = last_init(eligible)
    lists = backward_lists(jobs, init, required, days)
    members = lists.select(
        F.col("id").alias("init_id"), F.posexplode("member_ids").alias("position", "id"), F.size("member_ids").alias("n")
    )
    source = jobs.select("id", "tile_id", "source_id", "measurement_date", "creation_date")
    issued = members.join(source, "id").select(
        "init_id", "tile_id", "source_id", "measurement_date", "creation_date", "position",
        F.when(F.col("position") == 0, "backward").alias("run_mode"),
        F.when(F.col("position") == 0, F.col("n")).cast("long").alias("n_jobs_run_since_last_init"),
        F.lit("backward").alias("reprocessing_context"),
        F.lit(False).alias("nrt"),
        F.lit("pending").alias("output_status"),
    )
    return issued, members.select("id")


def jobs_in_period(jobs: DataFrame, column: str, low: Any, high: Any, closed: bool = False) -> DataFrame:
    return jobs.where(in_range(F.col(column), low, high, closed))
