"""Quality rules as a short-circuit cascade.

Every rule is a native expression that says whether a text is rejected.  The
cost and the selectivity of each rule are measured on a bounded sample, the
rules are ordered by rejections per cost, and a nested ``CASE`` stops at the
first rule that rejects.  The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnline.llm.common import WORD

#: Rows used to measure rules.  They steer the order of the rules only.
SAMPLE_ROWS = 300


@dataclass(frozen=True)
class Limits:
    """Limits of the rules; ratios are in hundredths."""

    min_words: int = 50
    max_repeat: int = 50
    max_symbols: int = 10
    max_shouts: int = 30
    max_dup_lines: int = 40
    min_word_tenths: int = 20
    max_word_tenths: int = 140


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps the column of per-text counts to a boolean."""

    name: str
    rejects: Callable[[Counts], Column]


class Counts:
    """Counts of one text as expressions over ``text`` (null: empty)."""

    def __init__(self, text: Column):
        self.text = F.coalesce(text, F.lit(""))

    def words(self) -> Column:
        return F.regexp_extract_all(self.text, F.lit(WORD), F.lit(0))

    def n_words(self) -> Column:
        return F.size(self.words()).cast("long")

    def word_chars(self) -> Column:
        return F.length(F.regexp_replace(self.text, r"[\x20\x09-\x0D]+", "")).cast("long")

    def n_of(self, characters: str) -> Column:
        """How often any of the characters occurs."""
        return (F.length(self.text) - F.length(F.translate(self.text, characters, ""))).cast("long")

    def n_symbols(self) -> Column:
        return self.n_of("#*$%&|<>")

    def n_shouts(self) -> Column:
        return self.n_of("!?")

    def lines(self) -> Column:
        return F.filter(F.split(self.text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def n_lines(self) -> Column:
        return F.size(self.lines()).cast("long")

    def n_dup_lines(self) -> Column:
        lines = self.lines()
        return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")

    def n_repeat_words(self) -> Column:
        """Words inside 3-word windows that occur twice or more.

        The windows' hashes are sorted with their place in the low bits, so equal
        windows are neighbours; neighbours are compared word by word.  A ``with``
        is spelt as a lambda over a one-element array, so nothing is evaluated
        twice.
        """
        return _let(self.words(), _repeats).cast("long")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), body)[0]


def _repeats(words: Column) -> Column:
    n = F.size(words)
    bits = F.length(F.bin(n.cast("long"))).cast("int")

    def place(key: Column) -> Column:
        return F.call_function("mod", key, F.call_function("shiftleft", F.lit(1).cast("long"), bits))

    def window(i: Column) -> Column:
        h = F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
        # one bit is given up so that no key is negative
        top = F.call_function("shiftrightunsigned", h, bits + 1)
        return F.call_function("shiftleft", top, bits) + i.cast("long")

    def repeated(keys: Column) -> Column:
        def same(j: Column) -> Column:
            a, b = F.get(keys, j - 1), F.get(keys, j)
            close = F.call_function("shiftright", a, bits) == F.call_function("shiftright", b, bits)
            p, q = place(a).cast("int"), place(b).cast("int")
            words_equal = (
                (F.get(words, p) == F.get(words, q))
                & (F.get(words, p + 1) == F.get(words, q + 1))
                & (F.get(words, p + 2) == F.get(words, q + 2))
            )
            return close & words_equal

        pairs = F.when(F.size(keys) > 1, F.filter(F.sequence(F.lit(1), F.size(keys) - 1), same)).otherwise(F.array().cast("array<int>"))
        starts = _let(pairs, lambda js: F.array_distinct(F.flatten(F.transform(js, lambda j: F.array(place(F.get(keys, j - 1)), place(F.get(keys, j)))))))
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2)))))

    keys = F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), window))
    return F.when(n >= 3, _let(keys, repeated)).otherwise(0)


def base_rules(limits: Limits = Limits()) -> list[Rule]:
    return [
        Rule("few_words", lambda c: c.n_words() < limits.min_words),
        Rule("repetition", lambda c: c.n_repeat_words() * 100 > c.n_words() * limits.max_repeat),
    ]


def extra_rules(limits: Limits = Limits()) -> list[Rule]:
    return [
        Rule("symbols", lambda c: c.n_symbols() * 100 > c.n_words() * limits.max_symbols),
        Rule("shouting", lambda c: c.n_shouts() * 100 > c.n_words() * limits.max_shouts),
        Rule("duplicate_lines", lambda c: c.n_dup_lines() * 100 > c.n_lines() * limits.max_dup_lines),
        Rule("short_words", lambda c: c.word_chars() * 10 < c.n_words() * limits.min_word_tenths),
        Rule("long_words", lambda c: c.word_chars() * 10 > c.n_words() * limits.max_word_tenths),
    ]


def measure(docs: DataFrame, rules: Sequence[Rule], text: str = "text", rows: int = SAMPLE_ROWS) -> list[dict]:
    """Seconds and share rejected of each rule on at most ``rows`` rows."""
    spark = docs.sparkSession
    taken = docs.select(F.col(text).alias("text")).take(rows)
    if not taken:
        return [{"rule": r.name, "seconds": 1.0, "rejected": 0.0} for r in rules]
    sample = spark.createDataFrame(taken, "text string").repartition(2).cache()
    try:
        sample.count()
        out = []
        for rule in rules:
            probe = sample.select(F.count_if(rule.rejects(Counts(F.col("text")))).alias("n"))
            probe.collect()  # compiles
            begin = time.perf_counter()
            n = probe.collect()[0]["n"]
            out.append({"rule": rule.name, "seconds": time.perf_counter() - begin, "rejected": n / len(taken)})
        return out
    finally:
        sample.unpersist()


def ordered(rules: Sequence[Rule], measured: Sequence[dict]) -> list[Rule]:
    """Rules by rejections per cost, best first."""
    gain = {m["rule"]: m["rejected"] / max(m["seconds"], 1e-6) for m in measured}
    return sorted(rules, key=lambda r: -gain[r.name])


def cascade(rules: Sequence[Rule], counts: Counts) -> Column:
    """True if no rule rejects; later rules run only where earlier ones pass."""
    verdict: Column = F.lit(True)
    for rule in reversed(rules):
        verdict = F.when(rule.rejects(counts), F.lit(False)).otherwise(verdict)
    return verdict


def quality_filter(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Rows that every rule accepts, columns unchanged.

    A null text counts as empty and is rejected; repeated rows are judged each
    for itself; an empty table stays empty; further columns are carried along.
    """
    rules = base_rules(limits) + extra_rules(limits)
    return docs.where(cascade(ordered(rules, measure(docs, rules, text)), Counts(docs[text])))


class _Ready(Counts):
    """Counts that are columns already."""

    def __getattribute__(self, name: str):
        if name in ("n_words", "word_chars", "n_symbols", "n_shouts", "n_lines", "n_dup_lines", "n_repeat_words"):
            return lambda: F.col(name)
        return super().__getattribute__(name)


def quality_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """One row per document: its counts, ``base_failed`` and ``kept``.

    The whole text is counted.  Null texts count as empty (all zero, not kept);
    ids may be null or repeated; an empty table gives no rows; other columns are
    not read, so their names cannot clash.
    """
    rules = extra_rules(limits)
    order = ordered(rules, measure(docs, rules, text))
    c = Counts(F.col("text"))
    counted = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).select(
        "doc_id",
        c.n_words().alias("n_words"), c.word_chars().alias("word_chars"), c.n_symbols().alias("n_symbols"),
        c.n_dup_lines().alias("n_dup_lines"), c.n_repeat_words().alias("n_repeat_words"),
        c.n_lines().alias("n_lines"), c.n_shouts().alias("n_shouts"),
    )
    ready = _Ready(F.lit(""))
    failed = ~cascade(base_rules(limits), ready)
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        F.when(failed, F.lit(False)).otherwise(cascade(order, ready)).alias("kept"),
    )
