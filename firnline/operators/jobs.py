"""Job tables: views, status log, integrity checks, upserts of status."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnline import codes
from firnline.folds import OrderedRule, State, ordered_fold
from firnline.functions.rules import simple_status, status_name
from firnline.scale import CHUNK_BITS, carry, earliest_by, id_chunk


# --- views and lookups ------------------------------------------------------
def status_dimension(df: DataFrame) -> DataFrame:
    """The sixteen statuses (a fixed table)."""
    return df.sparkSession.createDataFrame(list(codes.JOB_STATUS), "id smallint, name string")


def job_view(jobs: DataFrame, parents: DataFrame) -> DataFrame:
    """Child job, its parent and the name of the parent's last status.

    Status names are a fixed list of sixteen, so they become an expression and
    the view needs one join only.
    """
    parent = parents.select(
        F.col("id").alias("fk_parent_job_id"),
        *[F.col(c).alias(f"parent_{c}") for c in parents.columns if c != "id"],
        status_name(F.col("last_status_id")).alias("status_name"),
    )
    return jobs.join(parent, "fk_parent_job_id").where(F.col("status_name").isNotNull())


def job_messages(
    parents: DataFrame,
    executions: DataFrame,
    links: DataFrame,
    messages: DataFrame,
    parent_ids: Sequence[int] | None = None,
) -> DataFrame:
    """Messages logged for jobs in order of time."""
    wanted = parents if parent_ids is None else parents.where(F.col("id").isin(list(parent_ids)))
    level = F.lit(None).cast("string")
    for code, label in codes.LOG_LEVELS:
        level = F.when(F.col("log_level") == code, F.lit(label)).otherwise(level)
    return (
        wanted.select(F.col("id").alias("parent_job_id"), F.col("name").alias("job_name"))
        .join(
            executions.select(F.col("fk_parent_job_id").alias("parent_job_id"), F.col("id").alias("_ei")),
            "parent_job_id",
        )
        .join(
            links.select(
                F.col("fk_execution_info_id").alias("_ei"),
                F.col("fk_execution_message_id").alias("_em"),
                "log_level",
                "time",
            ),
            "_ei",
        )
        .join(messages.select(F.col("id").alias("_em"), "body"), "_em")
        .select("parent_job_id", "job_name", level.alias("log_level_name"), "time", "body")
        .where(F.col("log_level_name").isNotNull())
        .orderBy("time")
    )


def attach_parent(children: DataFrame, parents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Children with their parent's columns, and the orphans that have none."""
    parent = parents.select(
        F.col("id").alias("fk_parent_job_id"),
        *[F.col(c).alias(f"parent_{c}") for c in parents.columns if c != "id"],
    )
    attached = children.join(parent, "fk_parent_job_id", "inner")
    orphans = children.join(parent.select("fk_parent_job_id"), "fk_parent_job_id", "left_anti")
    return attached, orphans


def embed(children: DataFrame, filtered_parents: DataFrame) -> DataFrame:
    """Children whose parent passed the parent filter."""
    return attach_parent(children, filtered_parents)[0]


# --- status log -------------------------------------------------------------
def last_status(
    log: DataFrame, ids: Sequence[int] | None = None, statuses: Sequence[int] | None = None
) -> DataFrame:
    """Last change per job; the status filter applies to that change only."""
    if ids is not None:
        log = log.where(F.col("fk_parent_job_id").isin(list(ids)))
    out = (
        log.groupBy(F.col("fk_parent_job_id").alias("parent_job_id"))
        .agg(F.max_by(F.struct("job_status", "id", "time", "error_subtype"), F.col("id")).alias("r"))
        .select(
            "parent_job_id",
            F.col("r.job_status").alias("status"),
            F.col("r.id").alias("change_id"),
            F.col("r.time").alias("time"),
            F.col("r.error_subtype").alias("error_subtype"),
        )
    )
    return out if statuses is None else out.where(F.col("status").isin(list(statuses)))


def status_history(log: DataFrame, parents: DataFrame, ids: Sequence[int] | None = None) -> DataFrame:
    """All changes with job and status names, ordered per job."""
    if ids is not None:
        log = log.where(F.col("fk_parent_job_id").isin(list(ids)))
    return (
        log.select(
            F.col("fk_parent_job_id").alias("parent_job_id"),
            F.col("job_status").alias("status"),
            status_name(F.col("job_status")).alias("status_name"),
            F.col("id").alias("change_id"),
            "time",
        )
        .where(F.col("status_name").isNotNull())
        .join(parents.select(F.col("id").alias("parent_job_id"), F.col("name").alias("job_name")), "parent_job_id")
        .orderBy("parent_job_id", "change_id")
    )


def worst_error(log: DataFrame) -> DataFrame:
    """Highest error status (13 to 15) seen per job."""
    return (
        log.where(F.col("job_status").between(13, 15))
        .groupBy(F.col("fk_parent_job_id").alias("parent_job_id"))
        .agg(F.max("job_status").alias("worst_status"))
    )


def with_previous_status(log: DataFrame) -> DataFrame:
    """Adds ``previous_status`` (0 for the first change of a job).

    Chunks follow the unique change id, so each holds a bounded number of rows
    however many belong to one job.
    """
    out = carry(
        log,
        ["fk_parent_job_id"],
        id_chunk("id"),
        ["id"],
        F.struct(F.col("job_status").alias("s")),
        "_prev",
    )
    return out.withColumn("previous_status", F.coalesce(F.col("_prev.s").cast("int"), F.lit(0))).drop("_prev")


def is_allowed_transition(previous: Column, status: Column) -> Column:
    expr = F.lit(False)
    for before, after in codes.ALLOWED_NEXT.items():
        expr = F.when(previous == before, status.isin(list(after))).otherwise(expr)
    return expr


def bad_transitions(log: DataFrame) -> DataFrame:
    """Changes whose (previous, new) pair is not allowed."""
    return with_previous_status(log).where(
        ~is_allowed_transition(F.col("previous_status"), F.col("job_status"))
    )


class _Verdicts(OrderedRule):
    """Accepts a change allowed from the job's status; others leave it as it was.

    State: the status.
    """

    def summary(self, rows: list[tuple]) -> list[int]:
        # statuses that paths from several starts share are stepped once
        reached = {status: [status] for status in codes.ALLOWED_NEXT}
        for *_, status in rows:
            after: dict[int, list[int]] = {}
            for before, starts in reached.items():
                after.setdefault(status if status in codes.ALLOWED_NEXT[before] else before, []).extend(starts)
            reached = after
        out = [0] * (max(codes.ALLOWED_NEXT) + 1)
        for end, starts in reached.items():
            for start in starts:
                out[start] = end
        return out

    def advance(self, state: State, summary: list[int]) -> State:
        return [summary[state[0] if state else 0]]

    def run(self, key: tuple, state: State, rows: Iterable[tuple]) -> Iterator[tuple]:
        previous = state[0] if state else 0
        for _, change, status in rows:
            accepted = status in codes.ALLOWED_NEXT[previous]
            yield (*key, change, previous, status, accepted)
            if accepted:
                previous = status


def validate_log(log: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """Every change with its verdict, as the validation on arrival gives it: a
    refused change leaves the job's status as it was.

    Jobs with any number of changes (see :func:`firnline.folds.ordered_fold`); a
    change without status is refused, one without job stands with the others without.
    """
    narrow = log.select(
        F.col("fk_parent_job_id").cast("long").alias("parent_job_id"), F.col("id").cast("long").alias("change_id"),
        F.col("job_status").cast("int").alias("job_status"),
    )
    schema = "parent_job_id long, change_id long, previous_status int, job_status int, accepted boolean"
    return ordered_fold(narrow, ["parent_job_id"], ["change_id"], schema, _Verdicts(), chunk_bits)


def publication_failures(log: DataFrame, limit: int = codes.PUBLICATION_RETRIES) -> DataFrame:
    """Times a job went from done to external error; ``limit`` makes it permanent."""
    failed = (F.col("previous_status") == 12) & (F.col("job_status") == 14)
    return (
        with_previous_status(log)
        .groupBy(F.col("fk_parent_job_id").alias("parent_job_id"))
        .agg(F.count_if(failed).alias("failures"))
        .withColumn("permanent", F.col("failures") >= limit)
    )


def stuck_jobs(last: DataFrame, now: Column) -> DataFrame:
    """Jobs longer in their status than it allows (``last`` from :func:`last_status`)."""
    limit = F.lit(None).cast("int")
    for status, minutes in codes.STUCK_MINUTES.items():
        limit = F.when(F.col("status") == status, F.lit(minutes)).otherwise(limit)
    waited = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("time").cast("timestamp"))
    return last.withColumn("limit_minutes", limit).where(
        waited > F.col("limit_minutes").cast("long") * F.lit(60_000_000)
    )


# --- cached status against the log ------------------------------------------
def unsynced(parents: DataFrame, log: DataFrame) -> DataFrame:
    """Jobs whose cached status differs from the log."""
    last = last_status(log).select(F.col("parent_job_id").alias("id"), "status")
    return (
        parents.join(last, "id").where(F.col("status") != F.col("last_status_id")).select(*parents.columns)
    )


def resync(parents: DataFrame, log: DataFrame) -> DataFrame:
    """Parents with cached status, change id, date, subtype and error flag repaired.

    One pass over the log gives both the last change and the worst error.
    """
    seen = log.groupBy(F.col("fk_parent_job_id").alias("id")).agg(
        F.max_by(F.struct("job_status", "id", "time", "error_subtype"), F.col("id")).alias("_l"),
        F.max(F.when(F.col("job_status").between(13, 15), True)).alias("_err"),
    )
    joined = parents.join(seen, "id", "left")
    stale = F.coalesce(F.col("_l.job_status") != F.col("last_status_id"), F.lit(False))

    def fixed(new: Column, old: str) -> Column:
        return F.when(stale, new).otherwise(F.col(old)).alias(old)

    repaired = {
        "last_status_id": fixed(F.col("_l.job_status"), "last_status_id"),
        "last_status_change_id": fixed(F.col("_l.id"), "last_status_change_id"),
        "last_status_change_date": fixed(F.col("_l.time"), "last_status_change_date"),
        "last_status_error_subtype": fixed(F.col("_l.error_subtype"), "last_status_error_subtype"),
        "error_raised": F.when(stale & F.coalesce("_err", F.lit(False)), F.lit(True))
        .otherwise(F.col("error_raised"))
        .alias("error_raised"),
    }
    return joined.select(*[repaired.get(c, F.col(c)) for c in parents.columns])


# --- integrity ---------------------------------------------------------------
def unique_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def is_unique(df: DataFrame, key: Sequence[str]) -> bool:
    return unique_violations(df, key).isEmpty()


def duplicate_products(jobs: DataFrame, product: str = "product_id") -> DataFrame:
    """Products named by more than one job."""
    return (
        jobs.where(F.col(product).isNotNull())
        .groupBy(product)
        .agg(F.count("*").alias("n_jobs"))
        .where(F.col("n_jobs") > 1)
    )


# --- queues and marks ---------------------------------------------------------
def latest_with_date(jobs: DataFrame, date: str) -> DataFrame:
    """Row with the greatest date, rows without one last."""
    return jobs.orderBy(F.col(date).desc_nulls_last(), F.col("id").asc()).limit(1)


def high_water_mark(jobs: DataFrame, date: str, now: Column, default_days: int, whole_days: bool = False) -> DataFrame:
    """Start of the next search: last publication less a second, else some days
    back, with ``whole_days`` from midnight on."""
    back = F.date_trunc("day", now.cast("timestamp")) if whole_days else now.cast("timestamp")
    start = F.coalesce(
        F.max(date).cast("timestamp") - F.expr("INTERVAL 1 SECOND"),
        back - F.make_dt_interval(F.lit(default_days)),
    )
    return jobs.agg(start.alias("date_min")).withColumn("date_max", now.cast("timestamp"))


def ready_queue(jobs: DataFrame, date: str = "publication_date") -> DataFrame:
    """The queue in execution order: by priority (``urgency``), then publication date, then id."""
    rank = (
        F.when(F.col("priority") == "nrt", 0)
        .when(F.col("priority") == "delayed", 1)
        .when(F.col("priority") == "reprocessing", 2)
        .otherwise(3)
    )
    return jobs.withColumn("urgency", rank).orderBy("urgency", F.col(date), F.col("id"))


def dedup_jobs(jobs: DataFrame) -> DataFrame:
    """First job per source product and processing type."""
    scene = F.concat(F.regexp_replace(F.col("l1c_id"), r"\.SAFE", ""), F.lit(".SAFE"))
    kind = F.when(F.coalesce("nrt", F.lit(False)), "standard").otherwise("reprocessing")
    tagged = jobs.withColumn("l1c_id", scene).withColumn("processing_type", kind)
    return earliest_by(tagged, ["l1c_id", "processing_type"], ["id"])


def all_products(
    families: dict[str, DataFrame], parents: DataFrame, tile_from_parent: Sequence[str] = ("wet_snow", "gap_filled")
) -> DataFrame:
    """All families in one table with their parent's status in five classes."""
    union: DataFrame | None = None
    for family, jobs in families.items():
        if family in tile_from_parent and "tile_id" in jobs.columns:
            jobs = jobs.drop("tile_id")
        tagged = jobs.withColumn("job_table", F.lit(family))
        union = tagged if union is None else union.unionByName(tagged, allowMissingColumns=True)
    parent = parents.select(
        F.col("id").alias("fk_parent_job_id"),
        F.coalesce(F.col("last_status_id").cast("int"), F.lit(1)).alias("status_parent_id"),
        F.col("tile_id").alias("_tile"),
    )
    out = union.join(parent, "fk_parent_job_id")
    tile = F.coalesce("tile_id", "_tile") if "tile_id" in union.columns else F.col("_tile")
    return (
        out.withColumn("tile_id", tile)
        .drop("_tile")
        .withColumn("status_parent", status_name(F.col("status_parent_id")))
        .withColumn("simple_status_parent", simple_status(F.col("status_parent_id")))
    )


# --- message dictionary -------------------------------------------------------
def normalise_messages(log: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Each body once with a content key, and a link row per occurrence.

    The key is a hash of the body, so the link table needs no join back.
    """
    keyed = log.withColumn("message_key", F.sha2(F.col(body), 256))
    messages = keyed.select("message_key", body).dropDuplicates(["message_key"])
    return messages, keyed.drop(body)
