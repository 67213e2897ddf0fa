"""Secret scan with multipart credential linking.

Strong parts (assignments, access identifiers, long hex) are reported always.
Weak parts (account names, short or random values, endpoints) are reported only
where complementary parts stand in the same scope: a secret beside an identifier
or an endpoint.  A scope is a stretch of text without a blank line; parts link
when at most ``reach`` code points lie between the end of the earlier and the
start of the later, however long they are.

Parts become rows (text fingerprint, kind, start, end).  The interval join is two
running values per scope and role, the furthest end before a part and the next
start after it, so it emits no pairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def any_case(words: str) -> str:
    """Pattern for the words with each ASCII letter in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


@dataclass(frozen=True)
class Kind:
    """A kind of part; ``value`` is the group whose length is tested."""

    name: str
    pattern: str
    role: str  # secret, identifier, endpoint or break
    value: int = 0
    least: int = 1
    strong: bool = False
    weak_name: str = ""  # reported under this name if too short to be strong


_SAYS = r"""["']?\x20*[:=]\x20*["']?"""

ASSIGN = Kind(
    "assign",
    "(" + any_case("password|passwd|secret|token|api_") + "?" + any_case("key") + ")" + _SAYS + "([A-Za-z0-9+/_.=-]+)",
    "secret", 2, 8, True, "secret",
)
ACCESS = Kind("access", "AKIA[A-Z0-9]+", "identifier", 0, 16, True, "identifier")
#: Runs shorter than the least length cannot match, so the pattern names it.
HEX = Kind("hex", "[0-9a-f]{32,}", "secret", 0, 32, True)

#: Every pattern starts at a fixed character or a run of bounded length, so long
#: runs without a match are read once, not once per start.
WEAK = (
    Kind("identifier", "(" + any_case("username|user|login|account|client_id|access_id") + ")" + _SAYS + "([A-Za-z0-9@_.-]{3,})", "identifier", 2, 3),
    Kind("secret", "(" + any_case("pwd|passphrase|credential|auth") + ")" + _SAYS + "([A-Za-z0-9+/_.=-]{4,})", "secret", 2, 4),
    Kind("endpoint", r"[A-Za-z]{2,10}://[A-Za-z0-9.-]+(:[0-9]+)?|\.[A-Za-z0-9-]{1,63}:[0-9]{2,5}", "endpoint", 0, 1),
)
BREAK = Kind("break", r"\n[\x20\x09\r]*\n", "break")

#: Order of the kinds in reports.
BASE = ("assign", "access", "hex")
NAMES = (*BASE, "identifier", "secret", "endpoint")
KINDS = (ASSIGN, ACCESS, HEX, *WEAK)
#: Most code points between linked parts.
REACH = 200


def fingerprint(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _found(text: Column, at: int, kind: Kind) -> Column:
    """Lengths of the pieces between matches, of the matches and of their values."""
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.value)) if kind.value else hits
    one = F.struct(
        F.lit(at).alias("kind"),
        F.arrays_zip(
            F.transform(F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(hits)), F.length).alias("gap"),
            F.transform(hits, F.length).alias("hit"),
            F.transform(values, F.length).alias("value"),
        ).alias("hits"),
    )
    none = F.lit(None).cast("array<struct<kind:int,hits:array<struct<gap:int,hit:int,value:int>>>>")
    return F.when(text.rlike(kind.pattern), F.array(one)).otherwise(F.coalesce(none, F.array()))


def parts(docs: DataFrame, text: str = "text", kinds: Sequence[Kind] = KINDS) -> DataFrame:
    """Rows ``(fp, kind, start, end, value)`` of every part in every distinct text.

    Equal texts are merged before rows are made.  Positions are running sums of
    the lengths of what lies before, so no text is scanned again for them.
    """
    t = F.coalesce(F.col("_text"), F.lit(""))
    kinds = [*kinds, BREAK]
    per_text = (
        docs.select(F.col(text).alias("_text"))
        .where(F.greatest(*[t.rlike(k.pattern) for k in kinds if k is not BREAK]))
        .select(fingerprint(F.col("_text")).alias("fp"), F.concat(*[_found(t, i, k) for i, k in enumerate(kinds)]).alias("found"))
        .groupBy("fp").agg(F.any_value("found").alias("found"))
    )
    rows = per_text.select("fp", F.explode("found").alias("f")).select(
        "fp", F.col("f.kind").alias("kind"), F.posexplode("f.hits").alias("nth", "h")
    )
    before = Window.partitionBy("fp", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("h.gap") + F.col("h.hit")).over(before)
    return rows.select("fp", "kind", (end - F.col("h.hit")).alias("start"), end.alias("end"), F.col("h.value").alias("value"))


def _by_kind(kinds: Sequence[Kind], of) -> Column:
    return F.element_at(F.array(*[F.lit(of(k)) for k in kinds]), F.col("kind") + 1)


def linked_spans(docs: DataFrame, text: str = "text", reach: int = REACH) -> DataFrame:
    """Rows ``(fp, name, start, end)`` of the reported spans of every distinct text."""
    kinds = [*KINDS, BREAK]
    named = parts(docs, text).select(
        "fp", "kind", "start", "end",
        (_by_kind(kinds, lambda k: k.strong) & (F.col("value") >= _by_kind(kinds, lambda k: k.least))).alias("strong"),
        _by_kind(kinds, lambda k: k.name).alias("name"),
        _by_kind(kinds, lambda k: k.weak_name or k.name).alias("weak_name"),
        _by_kind(kinds, lambda k: k.role).alias("role"),
    )
    is_break = F.col("role") == "break"
    up = Window.partitionBy("fp").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("fp").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    placed = named.select(
        "*",
        F.coalesce(F.count_if(is_break).over(up), F.lit(0)).alias("scope"),
        F.coalesce(F.max(F.when(~is_break, F.col("end"))).over(up), F.lit(0)).alias("ended"),
        F.min(F.when(F.col("strong"), F.col("start"))).over(down).alias("next_strong"),
    )
    free = (F.col("ended") <= F.col("start")) & (F.col("next_strong").isNull() | (F.col("next_strong") >= F.col("end")))
    scope = Window.partitionBy("fp", "scope")
    earlier = scope.orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    later = scope.orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    secret = F.col("role") == "secret"

    def near(role: Column) -> Column:
        """Whether a part of the role before or after is within reach."""
        ended, starts = F.max(F.when(role, F.col("end"))).over(earlier), F.min(F.when(role, F.col("start"))).over(later)
        return F.coalesce(F.col("start") - ended <= reach, F.lit(False)) | F.coalesce(starts - F.col("end") <= reach, F.lit(False))

    usable = placed.where(~is_break & (F.col("strong") | free)).select(
        "*", near(secret).alias("near_secret"), near(~secret).alias("near_other")
    )
    return usable.where(F.col("strong") | F.when(secret, F.col("near_other")).otherwise(F.col("near_secret"))).select(
        "fp", F.when(F.col("strong"), F.col("name")).otherwise(F.col("weak_name")).alias("name"), "start", "end"
    )


def spans_per_text(docs: DataFrame, text: str = "text", reach: int = REACH) -> DataFrame:
    """Rows ``(fp, spans)``: the sorted spans of each distinct text that has any."""
    rank = F.array_position(F.array(*[F.lit(n) for n in NAMES]), F.col("name"))
    return linked_spans(docs, text, reach).groupBy("fp").agg(
        F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "end", "name"))).alias("spans")
    )


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """One row per document: ``doc_id`` and ``secrets``, its spans in order.

    A null or empty text has an empty list; ids may be null or repeated (each row
    is answered); an empty table gives no rows; other columns are not read.
    """
    ids = docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text)).alias("fp"))
    return ids.join(spans_per_text(docs, text, reach), "fp", "left").select(
        "doc_id", F.coalesce("spans", F.array().cast("array<struct<start:bigint,rank:bigint,end:bigint,name:string>>")).alias("secrets")
    )


def redact_secrets(docs: DataFrame, text: str = "text", reach: int = REACH, mark: str = "[secret]") -> DataFrame:
    """The rows of ``docs`` with every reported span of ``text`` replaced by ``mark``
    (overlapping spans become one mark).  Other columns, whatever their names,
    and rows without spans are unchanged; null texts stay null."""
    names = docs.columns
    spans = spans_per_text(docs, text, reach)
    row = F.struct(*[docs[c] for c in names]).alias("row")
    joined = docs.select(row, fingerprint(docs[text]).alias("fp")).join(spans, "fp", "left")
    t = F.col(f"row.`{text}`")

    def cut(acc: Column, span: Column) -> Column:
        start, end = span["start"].cast("int"), span["end"].cast("int")
        gap = F.substring(t, acc["pos"] + 1, F.greatest(start - acc["pos"], F.lit(0)))
        piece = F.when(start >= acc["pos"], F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["pos"], end).alias("pos"), piece.alias("out"))

    clean = F.aggregate(
        "spans", F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")), cut,
        lambda acc: F.concat(acc["out"], F.substring(t, acc["pos"] + 1, F.length(t))),
    )
    return joined.select(*[
        (F.when(F.col("spans").isNull(), t).otherwise(clean) if c == text else F.col(f"row.`{c}`")).alias(c) for c in names
    ])


def secret_report(docs: DataFrame) -> DataFrame:
    """Digest per document: counts of the base kinds, the hash of the base spans
    and all spans as text."""
    def said(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))))

    def count(name: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["name"] == name)).cast("long").alias(f"n_{name}")

    base = F.filter("secrets", lambda s: s["rank"] <= len(BASE))
    return scan_secrets(docs).select(
        "doc_id",
        *[count(n) for n in BASE],
        F.sha2(said(base), 256).alias("base_sha256"),
        said(F.col("secrets")).alias("spans"),
    )
