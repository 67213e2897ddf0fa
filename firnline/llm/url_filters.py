"""URL filters with dated lists.

Entries are added to and removed from lists on dates.  They become validity
intervals, and every capture is judged against the entries that were active when
it was fetched (an as-of join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Schemes whose URLs always have a host and take a backslash for a slash (fixed values).
SPECIAL = ("http", "https", "ftp", "ws", "wss")
#: Authority of such a URL, or of one without scheme, and of any other URL.
WEB = rf"(?i)^(?:(?:{'|'.join(SPECIAL)}):[/\\]*|[/\\]{{2}}[/\\]*)([^/\\?#]*)"
OTHER = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
#: What no host may hold, decoded or not; longer names cannot exist in the name system.
FORBIDDEN, LONGEST = r"[\x00-\x20\x7F#%/:<>?@\[\\\]^|]", 253
ADDRESS = r"^(\[.*\]|[0-9]+(\.[0-9]+){3})$"


def name_of(name: Column) -> Column:
    """A host or domain as names compare: lower case, no dots at the end."""
    return F.regexp_replace(F.lower(name), r"\.+$", "")


def host_of(url: Column) -> Column:
    """Lower-case host name as a browser reads it; empty if there is none.

    White space and controls around the URL, and line breaks and tabs in it, do not
    count.  What stands before the last ``@`` of the authority is no part of the host,
    a backslash ends the authority of a web URL as a slash does, an address in
    brackets is a host, ``%xx`` is decoded, and the wide full stops are full stops.  A
    host that holds a character no host may hold, or of more than 253 characters, is
    none.  Other writings of one name (``xn--`` beside Unicode, an address as one
    number) are different names.
    """
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[\x00-\x20]+|[\x00-\x20]+$", ""), r"[\t\n\r]", "")
    authority = F.when(bare.rlike(WEB), F.regexp_extract(bare, WEB, 1)).otherwise(F.regexp_extract(bare, OTHER, 1))
    raw = F.regexp_extract(F.regexp_replace(authority, "(?s)^.*@", ""), r"^(\[[^\]]*\]|[^:]*)", 1)
    decoded = F.when(raw.contains("%"), F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))).otherwise(raw)
    host = name_of(F.translate(decoded, "\u3002\uff0e\uff61", "..."))
    bracketed = host.rlike(r"^\[[0-9a-f:.]+\]$")
    return F.when((F.length(host) <= LONGEST) & (bracketed | ~host.rlike(FORBIDDEN)), host).otherwise("")


def domains_of(host: Column, least: int = 1) -> Column:
    """The host and the domains above it, down to ``least`` labels; an address has none."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.when(
        (n >= least) & ~host.rlike(ADDRESS),
        F.transform(F.sequence(F.lit(1), n - (least - 1)), lambda i: F.array_join(F.slice(labels, i, n - i + 1), ".")),
    ).otherwise(F.array(host))


def validity(entries: DataFrame) -> DataFrame:
    """Rows ``(list, pattern, valid_from, valid_to)`` of the times an entry is active.

    ``entries`` has ``list, pattern, day, action`` (``add`` or ``remove``).  Of
    several actions on one day adding wins; repeats of an action change nothing;
    the last interval has no end.  Patterns compare as hosts do (``name_of``).
    Rows with a null in any of these are void.
    """
    daily = (
        entries.select("list", name_of(F.col("pattern")).alias("pattern"), F.col("day").cast("date").alias("day"), "action").na.drop()
        .groupBy("list", "pattern", "day").agg(F.max(F.col("action") == "add").alias("on"))
    )
    w = Window.partitionBy("list", "pattern").orderBy("day")
    changes = daily.withColumn("was", F.coalesce(F.lag("on").over(w), F.lit(False))).where(F.col("on") != F.col("was"))
    spans = changes.select("list", "pattern", F.col("day").alias("valid_from"), F.lead("day").over(w).alias("valid_to"), "on")
    return spans.where("on").drop("on")


def url_verdicts(
    captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched", key: str = "page_id"
) -> DataFrame:
    """One row per capture: ``key, url, host, n_active`` (active entries that cover
    it), ``lists`` (their lists, sorted, comma-joined) and ``blocked``.

    An entry covers its own host and every host below it.  Captures are reduced to
    distinct (host, day) before they meet the lists; an entry's intervals are one
    row, so a host with many captures multiplies nothing.  A capture without URL,
    host or date is covered by nothing; repeated rows are each answered; empty
    tables are fine; other columns are not read.
    """
    history = validity(entries).groupBy("pattern").agg(F.collect_list(F.struct("list", "valid_from", "valid_to")).alias("history"))
    rows = captures.select(
        F.col(key).alias(key), F.col(url).alias("url"), host_of(F.col(url)).alias("host"),
        F.coalesce(F.col(fetched).cast("date"), F.lit("0001-01-01").cast("date")).alias("day"),
    )
    asked = rows.where("host <> ''").select("host", "day").distinct()
    met = asked.select("host", "day", F.explode(domains_of(F.col("host"))).alias("pattern")).join(history, "pattern")
    active = met.select("host", "day", F.explode(F.filter(
        "history", lambda h: (h["valid_from"] <= F.col("day")) & (h["valid_to"].isNull() | (F.col("day") < h["valid_to"]))
    )).alias("entry"))
    verdict = active.groupBy("host", "day").agg(
        F.count("*").alias("n_active"), F.array_join(F.sort_array(F.collect_set("entry.list")), ",").alias("lists")
    )
    return rows.join(verdict, ["host", "day"], "left").select(
        key, "url", "host", F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        F.coalesce("lists", F.lit("")).alias("lists"), F.col("n_active").isNotNull().alias("blocked"),
    )


def entries_from_pages(pages: DataFrame) -> DataFrame:
    """Dated list entries for the hosts and domains in ``pages``.

    The driver tables hold no lists, so Spark derives one: a name's hash decides
    whether and when it is added, removed and added again; names that advertise
    are on a second list from the start.
    """
    names = pages.select(host_of(F.col("url")).alias("host")).distinct().where("host <> ''")
    patterns = names.select(F.explode(domains_of(F.col("host"), least=2)).alias("pattern")).distinct()
    x = F.conv(F.substring(F.md5("pattern"), 1, 4), 16, 10).cast("int")
    day = F.date_add(F.lit("2024-01-01").cast("date"), x % 300)

    def entry(when: Column, name: str, at: Column, action: str) -> Column:
        return F.when(when, F.struct(F.lit(name).alias("list"), at.alias("day"), F.lit(action).alias("action")))

    made = F.array(
        entry(x % 4 == 0, "hashed", day, "add"), entry(x % 8 == 0, "hashed", F.date_add(day, 40), "remove"),
        entry(x % 16 == 0, "hashed", F.date_add(day, 90), "add"),
        entry(F.col("pattern").rlike("cheap|pills|casino|adult"), "adverts", F.lit("2024-01-15").cast("date"), "add"),
    )
    return patterns.select("pattern", F.explode(F.array_compact(made)).alias("e")).select("e.list", "pattern", "e.day", "e.action")


def fetched_on(page_id: Column) -> Column:
    """Day of a capture; the driver tables name none, so it follows the id."""
    return F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(page_id, F.lit(366)).cast("int"))
