"""Quality rules: text statistics and a decision list learned from labels, as one Spark conditional expression."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundline.llm.common import GAP, WORD, let, stored, whole, word_count, words

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT = 50  # percent of words in repeated windows
WINDOW = 3

# Inputs of the learned rules. Rates are per thousand, so that a threshold means the same for any length.
FEATURES = ("n_words", "mean_chars", "symbol_rate", "dup_line_rate", "repeat_rate", "distinct_rate")


def repeat_words(ws: Column) -> Column:
    """Words inside windows of three that occur twice or more in the text.

    A text without a repeated window is settled by comparing two sizes. Otherwise windows are sorted by hash, the
    places of equal neighbours are sorted again, and each place covers its three words up to the next place.
    """
    starts = F.slice(ws, F.lit(1), F.greatest(F.size(ws) - (WINDOW - 1), F.lit(0)))
    hashes = F.transform(starts, lambda w, i: F.xxhash64(w, F.get(ws, i + 1), F.get(ws, i + 2)))

    def covered(hs: Column) -> Column:
        ordered = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(pairs: Column) -> Column:
            twice = F.filter(
                pairs,
                lambda p, j: (p["h"] == F.get(pairs, j - 1)["h"]) | F.coalesce(p["h"] == F.get(pairs, j + 1)["h"], F.lit(False)),
            )
            return F.sort_array(F.transform(twice, lambda p: p["i"]))

        return let(
            let(ordered, places),
            lambda at: F.aggregate(
                F.transform(at, lambda i, j: F.least(F.coalesce(F.get(at, j + 1) - i, F.lit(WINDOW)), F.lit(WINDOW))),
                F.lit(0).cast("long"),
                lambda n, more: n + more,
            ),
        )

    zero = F.lit(0).cast("long")
    return let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), zero).otherwise(covered(hs)))


def statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` as `(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_distinct)`.

    Expressions on one row: no shuffle. A missing text counts as an empty one: no words, base_failed. Rows keep their
    number, repeated or not.
    """
    text = F.col("text")
    with_word = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(WORD))
    lines = let(with_word, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long")
    of_words = let(
        words(text),
        lambda ws: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            repeat_words(ws).alias("n_repeat_words"),
            F.size(F.array_distinct(ws)).cast("long").alias("n_distinct"),
        ),
    )
    rows = docs.select(F.col(id_column).alias("doc_id"), whole(F.col(text_column)).alias("text")).select(
        "doc_id",
        (F.length(text) - F.regexp_count(text, F.lit(GAP[:-1]))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("n_dup_lines"),
        of_words.alias("w"),
    )
    failed = (F.col("w.n_words") < MIN_WORDS) | (100 * F.col("w.n_repeat_words") > MAX_REPEAT * F.col("w.n_words"))
    return rows.select(
        "doc_id", "w.n_words", "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words", failed.alias("base_failed"), "w.n_distinct"
    )


def features() -> dict[str, Column]:
    """The columns that rules may test, from those of `statistics`."""
    words_ = F.greatest("n_words", F.lit(1))
    rate = lambda column: F.floor(1000 * F.col(column) / words_)
    return {
        "n_words": F.col("n_words"),
        "mean_chars": F.floor(100 * F.col("word_chars") / words_),
        "symbol_rate": rate("n_symbols"),
        "dup_line_rate": rate("n_dup_lines"),
        "repeat_rate": rate("n_repeat_words"),
        "distinct_rate": rate("n_distinct"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # >= threshold, else <
    threshold: int

    def column(self) -> Column:
        value = features()[self.feature]
        return value >= self.threshold if self.above else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold}"


Rule = tuple[Condition, ...]


def matches(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [c.column() for c in rule])


def verdict(rules: list[Rule]) -> Column:
    """The ordered list as one expression: the first rule that matches rejects, a row that none matches is kept."""
    out = None
    for rule in rules:
        out = F.when(matches(rule), F.lit(False)) if out is None else out.when(matches(rule), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def learn(
    labelled: DataFrame,
    max_rules: int = 6,
    max_conditions: int = 3,
    bins: int = 24,
    min_share: float = 0.01,
    precision: float = 0.95,
) -> list[Rule]:
    """Ordered rules that reject bad rows of `labelled` (columns of `statistics` and `good` boolean, NULL left out).

    Sequential covering. Two thirds of the rows (by hash of the id) grow rules, one third prunes them. A rule grows by
    the condition of highest information gain (FOIL) until it covers no good row or has `max_conditions`; conditions are
    then dropped from its end while its worth on the pruning rows, (bad - good) / (bad + good), does not fall. It is
    taken if its share of bad rows is at least `precision` on both parts and it covers `min_share` of the bad rows left;
    the rows it covers are taken out and the next one is grown. Thresholds are quantiles of the growing rows.

    All labelled rows are used. Each step is one aggregation whose result is a row per feature and bin; nothing
    else reaches the driver. Without labels, or with one kind only, there are no rules and every row is kept.
    """
    columns = [features()[n].cast("long").alias(f"f_{n}") for n in FEATURES]
    grow_side = F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(3)) != 0
    named = [F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct")]
    rows = stored(
        labelled.filter("good IS NOT NULL").select("good", grow_side.alias("grows"), *named, *columns), "quality-labelled"
    )
    edges = rows.filter("grows").agg(
        *[F.percentile_approx(f"f_{n}", [i / bins for i in range(1, bins)], 1000).alias(n) for n in FEATURES]
    ).first()
    cuts = {n: sorted(set(edges[n] or [])) for n in FEATURES}

    def bin_of(name: str) -> Column:
        """How many cuts a value reaches."""
        if not cuts[name]:
            return F.lit(0)
        return F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts[name]]), lambda c: c <= F.col(f"f_{name}")))

    binned = F.array(*[F.struct(F.lit(n).alias("feature"), bin_of(n).alias("bin")) for n in FEATURES])
    table = stored(rows.withColumn("bins", binned), "quality-binned")
    bad, good = (F.sum(F.when(F.col("good") == flag, 1).otherwise(0)) for flag in (False, True))

    def counts(df: DataFrame) -> tuple[int, int]:
        row = df.agg(bad.alias("bad"), good.alias("good")).first()
        return row["bad"] or 0, row["good"] or 0

    def best(covered: DataFrame, total: tuple[int, int]) -> Condition | None:
        """The condition of highest gain over rows that hold `total` bad and good ones."""
        per_bin = {
            (r["feature"], r["bin"]): (r["bad"], r["good"])
            for r in covered.select("good", F.inline("bins"))
            .groupBy("feature", "bin")
            .agg(bad.alias("bad"), good.alias("good"))
            .collect()
        }
        found = (1e-9, None)
        for name in FEATURES:
            below = (0, 0)
            for i, cut in enumerate(cuts[name]):
                more = per_bin.get((name, i), (0, 0))
                below = (below[0] + more[0], below[1] + more[1])
                above = (total[0] - below[0], total[1] - below[1])
                for side, (b, g) in ((False, below), (True, above)):
                    gain = b * (_log_share(b, g) - _log_share(*total)) if b else 0.0
                    if gain > found[0]:
                        found = (gain, Condition(name, side, cut))
        return found[1]

    rules: list[Rule] = []
    left = table
    while len(rules) < max_rules:
        growing, pruning = left.filter("grows"), left.filter("NOT grows")
        start = total = counts(growing)
        rule: Rule = ()
        while total[1] and total[0] and len(rule) < max_conditions:
            condition = best(growing, total)
            if condition is None:
                break
            rule += (condition,)
            growing = growing.filter(condition.column())
            total = counts(growing)
        if not rule:
            break
        worth = {}
        for n in range(len(rule), 0, -1):
            b, g = counts(pruning.filter(matches(rule[:n])))
            worth[n] = (b - g) / (b + g) if b + g else -1.0
        n = min(worth, key=lambda n: (-worth[n], n))
        rule = rule[:n]
        both = (counts(part.filter(matches(rule))) for part in (left.filter("grows"), pruning))
        if any(b < precision * (b + g) or b < min_share * start[0] / 4 or not b for b, g in both):
            break
        rules.append(rule)
        left = left.filter(~matches(rule))
    return rules


def _log_share(bad: int, good: int) -> float:
    import math

    return math.log2((bad + 1) / (bad + good + 2))


def learn_from(stats: DataFrame, labels: DataFrame, **options) -> list[Rule]:
    """Rules from the rows of `stats` (see `statistics`) that `labels(doc_id, quality)` covers: good is quality 1.

    Rows that fail the base rules are left out, since the list never decides on them. An id with differing labels counts
    as bad if any says so; a missing id has no label. No texts are joined, only their statistics.
    """
    marks = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("doc_id IS NOT NULL")
    labelled = stats.filter("NOT base_failed").join(marks, "doc_id").withColumn("good", F.col("quality") == 1)
    return learn(labelled, **options)


def with_verdict(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """`stats` and `kept`: the base rules hold and the list does not reject."""
    return stats.withColumn("kept", ~F.col("base_failed") & verdict(rules))
