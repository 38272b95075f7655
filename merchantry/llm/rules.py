"""Quality rules as a short-circuit cascade.

A rule rejects a document by features of its text. What a rule costs and what
it rejects is estimated on a sample; rules then run by rejections per unit of
cost, and a document that one rule rejects is not looked at by the next. The
order changes the work only, never which documents pass.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store
from .common import spare, words

SAMPLE_ROWS = 2000


def _repeat_words(get: Callable[[str], Column]) -> Mapping[str, Column]:
    """Steps to the number of words inside a 3-word window found twice or more.

    Windows are told apart by a 64-bit hash: their hashes are sorted with their
    places, and a window is repeated if a neighbour has its hash.
    """
    n, w = get("n_words"), get("words")
    return {
        "windows": F.sort_array(
            F.transform(
                F.slice(w, F.lit(1), F.greatest(n.cast("int") - 2, F.lit(0))),
                lambda x, i: F.struct(
                    F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("at")
                ),
            )
        )
    }


def _repeat_places(get: Callable[[str], Column]) -> Column:
    rows = get("windows")
    return F.sort_array(
        F.array_compact(
            F.transform(
                rows,
                lambda x, i: F.when(
                    (F.get(rows, i - 1)["h"] == x["h"]) | (F.get(rows, i + 1)["h"] == x["h"]),
                    x["at"],
                ),
            )
        )
    )


def _repeat_count(get: Callable[[str], Column]) -> Column:
    at = get("repeat_places")
    return F.aggregate(
        F.transform(
            at, lambda p, i: F.when(i == 0, F.lit(3)).otherwise(F.least(F.lit(3), p - F.get(at, i - 1)))
        ),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )


def _lines(get: Callable[[str], Column]) -> Column:
    return F.filter(F.split(get("text"), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


# Features by name: from the text, or from features before them.
FEATURES: dict[str, Callable[[Callable[[str], Column]], Column]] = {
    "words": lambda get: words(get("text")),
    "n_words": lambda get: F.size(get("words")).cast("long"),
    "word_chars": lambda get: F.length(F.array_join(get("words"), "")).cast("long"),
    "n_symbols": lambda get: F.length(
        F.regexp_replace(get("text"), r"[^#*$%&|<>]+", "")
    ).cast("long"),
    "lines": _lines,
    "n_lines": lambda get: F.size(get("lines")).cast("long"),
    "n_dup_lines": lambda get: (
        get("n_lines") - F.size(F.array_distinct(get("lines")))
    ).cast("long"),
    "n_letters": lambda get: F.length(F.regexp_replace(get("text"), r"\P{L}+", "")).cast("long"),
    "windows": lambda get: _repeat_words(get)["windows"],
    "repeat_places": _repeat_places,
    "n_repeat_words": _repeat_count,
}

# Features each feature is computed from.
NEEDS: dict[str, tuple[str, ...]] = {
    "n_words": ("words",),
    "word_chars": ("words",),
    "n_lines": ("lines",),
    "n_dup_lines": ("lines", "n_lines"),
    "windows": ("words", "n_words"),
    "repeat_places": ("windows",),
    "n_repeat_words": ("repeat_places",),
}


@dataclass(frozen=True)
class Rule:
    """Rejects a document; ``rejects`` maps the columns of its features to a condition."""

    name: str
    features: tuple[str, ...]
    rejects: Callable[..., Column]


BASE_RULES = (
    Rule("too_short", ("n_words",), lambda n: n < 50),
    Rule(
        "repeated_windows", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 50 * n
    ),
)

QUALITY_RULES = (
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 10 * s > n),
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: ~c.between(2 * n, 16 * n)),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda d, n: 10 * d > 3 * n),
    Rule("letters", ("n_letters", "word_chars"), lambda a, c: 10 * a < 6 * c),
)


class Measures:
    """A table to which features are added as columns of unused names."""

    def __init__(self, docs: DataFrame, text: str = "text"):
        self.columns = list(docs.columns)
        self.names: dict[str, str] = {}
        self.df = docs
        self._put("text", F.coalesce(F.col(f"`{text}`"), F.lit("")))

    def _put(self, feature: str, value: Column) -> None:
        (name,) = spare(self.df, feature)
        self.names[feature] = name
        self.df = self.df.withColumn(name, value)

    def get(self, feature: str) -> Column:
        return F.col(f"`{self.names[feature]}`")

    def add(self, feature: str, where: Column | None = None) -> None:
        """Compute a feature and what it needs, for rows with ``where`` only."""
        if feature in self.names:
            return
        for need in NEEDS.get(feature, ()):
            self.add(need, where)
        value = FEATURES[feature](self.get)
        self._put(feature, value if where is None else F.when(where, value))

    def rejects(self, rule: Rule) -> Column:
        return F.coalesce(rule.rejects(*map(self.get, rule.features)), F.lit(False))

    def cascade(self, rules: Sequence[Rule]) -> str:
        """Column that is true where no rule rejects; later rules see survivors only."""
        (alive,) = spare(self.df, "alive")
        self.df = self.df.withColumn(alive, F.lit(True))
        for rule in rules:
            for feature in rule.features:
                self.add(feature, F.col(f"`{alive}`"))
            self.df = self.df.withColumn(
                alive, F.when(F.col(f"`{alive}`"), ~self.rejects(rule)).otherwise(F.lit(False))
            )
        return alive


def order_rules(
    docs: DataFrame,
    rules: Sequence[Rule],
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> list[Rule]:
    """``rules`` by rejections per cost, from about ``sample_rows`` rows of any part of ``docs``.

    The cost of a rule is the time it takes on the sample by itself. Rules
    overlap, so after each choice only the rows that it leaves count for the
    next; how many rows each combination of rules rejects is one small
    aggregate, of at most a row per combination.
    """
    share = max(1, docs.count() // max(1, sample_rows))
    row = F.xxhash64(*[F.col(f"`{c}`") for c, t in docs.dtypes if not t.startswith("map")])
    sample = store(
        docs.where(F.pmod(row, F.lit(share)) == 0).select(F.col(f"`{text}`").alias("text")),
        "rule-sample",
    )
    sample.count()
    costs: dict[str, float] = {}
    for rule in rules:
        measures = Measures(sample)
        for feature in rule.features:
            measures.add(feature)
        start = time.perf_counter()
        measures.df.agg(F.count_if(measures.rejects(rule))).collect()
        costs[rule.name] = time.perf_counter() - start
    measures = Measures(sample)
    for rule in rules:
        for feature in rule.features:
            measures.add(feature)
    hits = F.array(*[measures.rejects(rule) for rule in rules]).alias("hits")
    left = [(r["hits"], r["count"]) for r in measures.df.groupBy(hits).count().collect()]
    ordered, rest = [], list(range(len(rules)))
    while rest:
        gain = {k: sum(n for hit, n in left if hit[k]) / costs[rules[k].name] for k in rest}
        best = max(rest, key=lambda k: (gain[k], -costs[rules[k].name]))
        ordered.append(rules[best])
        rest.remove(best)
        left = [(hit, n) for hit, n in left if not hit[best]]
    return ordered


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, inside one expression."""
    return F.get(F.transform(F.array(value), body), 0)


def feature_of(text: Column, feature: str) -> Column:
    """A feature as one expression of a text, with what it needs computed once."""

    def bind(left: list[str], known: dict[str, Column]) -> Column:
        name = left[0]
        value = FEATURES[name](known.__getitem__)
        if len(left) == 1:
            return value
        return _let(value, lambda x: bind(left[1:], {**known, name: x}))

    order: list[str] = []

    def need(name: str) -> None:
        for other in NEEDS.get(name, ()):
            need(other)
        if name not in order:
            order.append(name)

    need(feature)
    return bind(order, {"text": text})


def keep_documents(
    docs: DataFrame,
    rules: Sequence[Rule] = (*BASE_RULES, *QUALITY_RULES),
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns.

    One filter, whose conditions are tried in the order of the rules, so a row
    is left at the first rule that rejects it. A NULL text counts as empty, and
    so is rejected as too short; equal rows share one verdict and all stay or
    all go; an empty table stays empty; columns named like a feature do not
    matter.
    """
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    kept = docs
    for rule in order_rules(docs, rules, text, sample_rows):
        found = rule.rejects(*[feature_of(content, f) for f in rule.features])
        kept = kept.where(~F.coalesce(found, F.lit(False)))
    return kept


BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    rules: Sequence[Rule] = QUALITY_RULES,
    base_rules: Sequence[Rule] = BASE_RULES,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """A row per document: base measures, whether a base rule failed, and the verdict.

    Edge cases as in :func:`keep_documents`; every row of ``docs`` gives one
    row, whatever its ``doc_id``.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    order = order_rules(rows, rules, sample_rows=sample_rows)
    measures = Measures(rows)
    for feature in BASE_COLUMNS:
        measures.add(feature)
    failed = measures.rejects(base_rules[0])
    for rule in base_rules[1:]:
        failed = failed | measures.rejects(rule)
    measures.df = measures.df.withColumn("base_failed", failed)
    alive = measures.cascade(
        [Rule("base", (), lambda: F.col("base_failed")), *order]
    )
    # A condition of the caller must not be moved below the features, each of which would
    # then be copied into it with all it needs; it stays above what is no function of the row.
    once = F.monotonically_increasing_id() >= 0
    return measures.df.select(
        "doc_id",
        *[F.col(measures.names[f]).alias(f) for f in BASE_COLUMNS],
        "base_failed",
        (F.col(alive) & once).alias("kept"),
    )
