"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule is a condition under which a document fails. On a bounded sample
each rule's cost (seconds to evaluate it alone) and selectivity (share of
documents that it rejects) are measured, and the rules are ordered by
rejection per cost. In that order, what a rule needs is measured only where the
rules before it passed (CASE WHEN skips the rest of a row that failed). The
order changes the time only, never the verdict.

Words are maximal runs of characters other than ``\\x20`` and ``\\x09-\\x0D``.

Defined cases: a null text has no words, and fails ``few_words``; an empty
table gives no rows and keeps the given order of rules; repeated rows are
judged alike; other columns are ignored by the rules and kept by ``keep_good``.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regstar.llm.shared import SharedTables

#: As it stands in an SQL literal.
SPACE = r"[\\x20\\x09-\\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """Documents fail where ``fails`` holds: SQL over the columns of
    ``LAYERS`` that ``needs`` names (and those they need in turn)."""

    name: str
    needs: tuple[str, ...]
    fails: str


#: Measured columns by name, as SQL over columns before them. A layer is a
#: projection of its own, so that what a higher-order function reads many
#: times is computed once.
LAYERS: dict[str, tuple[tuple[str, ...], str]] = {
    "body": ((), "coalesce(text, '')"),
    "words": (("body",), rf"array_remove(split(body, '{SPACE}+'), '')"),
    "n_words": (("words",), "cast(size(words) as bigint)"),
    "word_chars": (("body",), r"cast(length(translate(body, ' \t\n\u000b\u000c\r', '')) as bigint)"),
    "n_symbols": (("body",), f"cast(length(body) - length(translate(body, '{SYMBOLS}', '')) as bigint)"),
    "lines": (("body",), r"filter(split(body, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')"),
    "n_dup_lines": (("lines",), "cast(size(lines) - size(array_distinct(lines)) as bigint)"),
    # Windows of five words, as hashes of the words' hashes.
    "hashes": (("words",), "transform(words, x -> xxhash64(x))"),
    "windows": (
        ("hashes",),
        f"CASE WHEN size(hashes) < {WINDOW} THEN array() ELSE transform(sequence(0, size(hashes) - {WINDOW}), "
        "i -> xxhash64(hashes[i], hashes[i + 1], hashes[i + 2], hashes[i + 3], hashes[i + 4])) END",
    ),
    # Only texts with a repeated window are sorted: equal windows then stand
    # side by side, and their places in the text give the words they cover.
    "by_window": (
        ("windows",),
        "CASE WHEN size(array_distinct(windows)) = size(windows) THEN NULL "
        "ELSE sort_array(transform(windows, (x, i) -> struct(x, i))) END",
    ),
    "repeats": (
        ("by_window",),
        "sort_array(transform(filter(by_window, (x, i) -> x.x = get(by_window, i - 1).x OR x.x = get(by_window, i + 1).x),"
        " x -> x.i))",
    ),
    "n_repeat_words": (
        ("repeats",),
        "cast(CASE WHEN repeats IS NULL THEN 0 ELSE aggregate(transform(repeats, (p, i) -> "
        f"least({WINDOW}, coalesce(get(repeats, i + 1) - p, {WINDOW}))), 0, (n, x) -> n + x) END as bigint)",
    ),
    "n_letters": (("body",), r"regexp_count(body, '\\p{L}')"),
    "n_capitals": (("body",), r"regexp_count(body, '\\p{Lu}')"),
    "n_echoes": (("hashes",), "size(filter(hashes, (x, i) -> i > 0 AND x = get(hashes, i - 1)))"),
}

#: Rules with the limits used in production. The first two are the base rules.
RULES = (
    Rule("few_words", ("n_words",), "n_words < 10"),
    Rule("repeated_passages", ("n_words", "n_repeat_words"), "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", ("n_words", "n_symbols"), "10 * n_symbols > n_words"),
    Rule("capitals", ("n_letters", "n_capitals"), "10 * n_capitals > 4 * n_letters AND n_letters >= 40"),
    Rule("echoed_words", ("n_words", "n_echoes"), "10 * n_echoes > 3 * n_words"),
)
BASE = ("few_words", "repeated_passages")


def _measure(docs: DataFrame, names: tuple[str, ...], done: set[str], only: Column | None = None) -> DataFrame:
    """``docs`` with the columns ``names`` of ``LAYERS``, and what they need,
    that are not ``done`` yet; null where ``only`` does not hold."""
    depth: dict[str, int] = {}

    def want(name: str) -> int:
        depth[name] = 1 + max(map(want, LAYERS[name][0]), default=-1)
        return depth[name]

    for name in names:
        want(name)
    for level in sorted(set(depth.values())):
        new = {x: F.expr(LAYERS[x][1]) for x in depth if depth[x] == level and x not in done}
        docs = docs.withColumns(new if only is None else {x: F.when(only, e) for x, e in new.items()})
    done.update(depth)
    return docs


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, sample_rows: int = 2000) -> list[Rule]:
    """``rules`` by rejection per cost, measured on at most ``sample_rows``
    documents from all over the table."""
    spark = docs.sparkSession
    shared = SharedTables(spark, "quality")
    n = docs.count()
    if not n:
        return list(rules)
    share = min(1.0, 1.5 * sample_rows / n)
    texts = docs.select("text")
    some = shared.put((texts.sample(share, seed=7) if share < 1 else texts).limit(sample_rows), "sample")

    def run(rule: Rule | None) -> tuple[float, int]:
        began = time.perf_counter()
        fails = F.expr(rule.fails if rule else "length(text) < 0")
        rejected = _measure(some, rule.needs if rule else (), set()).agg(F.count_if(fails).alias("n")).first()["n"]
        return time.perf_counter() - began, rejected

    run(None)  # the first read of the sample
    empty, _ = run(None)
    scored = []
    for i, rule in enumerate(rules):
        seconds, rejected = run(rule)
        scored.append((-rejected / max(seconds - empty, 0.001), i, rule))
    shared.drop("sample")
    return [rule for _, _, rule in sorted(scored, key=lambda x: x[:2])]


def judge(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, always: tuple[str, ...] = (), sample_rows: int = 2000
) -> DataFrame:
    """``docs`` (a column ``text``, no other name of ``LAYERS``) with
    ``kept``. What a rule needs is measured only for rows that passed the
    rules before it; columns named in ``always`` are measured for all."""
    done: set[str] = set()
    docs = _measure(docs, always, done).withColumn("kept", F.lit(True))
    for i, rule in enumerate(order_rules(docs, rules, sample_rows=sample_rows)):
        docs = _measure(docs, rule.needs, done, F.col("kept") if i else None)
        docs = docs.withColumn("kept", F.col("kept") & ~F.coalesce(F.expr(rule.fails), F.lit(False)))
    return docs


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, **options) -> DataFrame:
    """The rows of ``docs`` that pass all rules, with their columns."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    judged = judge(docs.select("text", row.alias("row")), rules, **options)
    # Not a filter: the optimiser would copy the rules into it, down through
    # every layer, and each layer multiplies the copies.
    return judged.select(F.explode(F.when(F.col("kept"), F.array("row"))).alias("row")).select("row.*")
