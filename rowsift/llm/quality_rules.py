"""Quality rules learned as a decision list.

Sequential covering on labelled statistics: each rule is grown, one threshold at a
time by FOIL gain, on two thirds of the labelled rows, cut back on the other third,
and kept while it is precise enough there; the rows it covers are then set aside and
the next rule is grown. The result is an ordered list of threshold conjunctions that
becomes one conditional Spark expression. Only counts by feature bin, of a fixed
size, come to the driver; all rows stay in DataFrame operations.

Defined results. Null text: no words, all counts 0, ``base_failed``. Empty text: the
same. Null or contradicting labels: the worst label of a doc_id counts, null labels
and null ids are left out. No labels or only one class: an empty list, which rejects
nothing. Repeated rows: each row is judged alike. Empty table: no rows. Other columns
never matter. Five-word windows are compared by their 64-bit hashes within a text.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsift.llm.common import let, text_or_empty, words, written

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: Characters counted as symbols (fixed by the contract).
SYMBOLS = "[#*$%&|<>]"
#: Ratios the rules are made of; each is null for a text without words.
FEATURES = ("n_words", "mean_word_chars", "symbols_per_word", "dup_line_share", "repeat_share")


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    cut: float

    def column(self) -> Column:
        x = F.col(self.feature)
        return F.coalesce(x >= F.lit(self.cut) if self.at_least else x < F.lit(self.cut), F.lit(False))

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.cut:.6g}"


@dataclass(frozen=True)
class Rule:
    """A conjunction, with its counts of bad and good rows on the pruning third."""

    conditions: tuple[Condition, ...]
    bad: int = 0
    good: int = 0

    def column(self) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules for rejection; what none covers is kept."""

    rules: tuple[Rule, ...] = field(default_factory=tuple)

    def fired(self) -> Column:
        """Text of the first rule that covers the row, else null."""
        out = None
        for r in self.rules:
            out = F.when(r.column(), F.lit(str(r))) if out is None else out.when(r.column(), F.lit(str(r)))
        return F.lit(None).cast("string") if out is None else out

    def rejects(self) -> Column:
        return self.fired().isNotNull()


def _repeat_words(w: Column) -> Column:
    """Words inside a five-word window that the text holds twice or more."""

    def covered(p: Column) -> Column:
        n = F.size(p)
        steps = F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda j: F.when(j == n - 1, F.lit(WINDOW)).otherwise(
                F.least(F.lit(WINDOW), F.get(p, j + 1) - F.get(p, j))
            ),
        )
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def repeated(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(
            ordered,
            lambda s: let(
                F.sort_array(
                    F.transform(
                        F.filter(
                            s,
                            lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                            | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)),
                        ),
                        lambda x: x["i"],
                    )
                ),
                covered,
            ),
        )

    hashes = F.transform(
        F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW)))
    )
    return F.when(F.size(w) < WINDOW, F.lit(0)).otherwise(
        let(
            hashes,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(repeated(h)),
        )
    )


def text_stats(text: Column | str = "text") -> Column:
    """Struct of the counts n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long)."""

    def lines(t: Column) -> Column:
        with_word = F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\x0b\x0c\r"))) > 0)
        return let(
            with_word,
            lambda x: F.struct(
                F.size(x).cast("long").alias("n"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"),
            ),
        )

    def stats(t: Column) -> Column:
        return let(
            words(t),
            lambda w: let(
                lines(t),
                lambda x: F.struct(
                    F.size(w).cast("long").alias("n_words"),
                    F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                    F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                    x["n"].alias("n_lines"),
                    x["dup"].alias("n_dup_lines"),
                    _repeat_words(w).cast("long").alias("n_repeat_words"),
                ),
            ),
        )

    return let(text_or_empty(text), stats)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (s["n_repeat_words"] * 100 > s["n_words"] * MAX_REPEAT_PERCENT)


def features(s: Column) -> list[Column]:
    """The columns FEATURES out of the struct of :func:`text_stats`."""
    n = F.when(s["n_words"] > 0, s["n_words"]).cast("double")
    lines = F.when(s["n_lines"] > 0, s["n_lines"]).cast("double")
    return [
        n.alias("n_words"),
        (s["word_chars"] / n).alias("mean_word_chars"),
        (s["n_symbols"] / n).alias("symbols_per_word"),
        (s["n_dup_lines"] / lines).alias("dup_line_share"),
        (s["n_repeat_words"] / n).alias("repeat_share"),
    ]


def _entropy_term(bad: int, good: int) -> float:
    return math.log2(bad / (bad + good)) if bad else -math.inf


def _best_condition(
    counts: dict[str, dict[int, tuple[int, int]]], cuts: dict[str, list[float]], least: int, failed: set
):
    """The condition of highest FOIL gain over the rows counted by feature and bin; None without gain.

    ``failed`` holds the (feature, side) that are not to be used.
    """
    best, chosen = 1e-9, None
    for f in FEATURES:
        bins = counts.get(f, {})
        bad, good = (sum(b[k] for b in bins.values()) for k in (0, 1))
        start = _entropy_term(bad, good)
        below_bad = below_good = 0
        last = math.nan
        for i, cut in enumerate(cuts[f]):
            b, g = bins.get(i, (0, 0))
            below_bad, below_good = below_bad + b, below_good + g
            for at_least, (p, n) in ((False, (below_bad, below_good)), (True, (bad - below_bad, good - below_good))):
                if (f, at_least) in failed or p < max(least, 1):
                    continue
                gain = p * (_entropy_term(p, n) - start)
                # of cuts that part the rows alike, the one farthest from the good rows
                if gain > best or (gain == best and at_least and chosen == Condition(f, True, last)):
                    best, chosen = gain, Condition(f, at_least, cut)
            last = cut
    return chosen


def learn_decision_list(
    labelled: DataFrame,
    bad: str = "bad",
    key: str = "doc_id",
    bins: int = 64,
    max_rules: int = 8,
    max_conditions: int = 4,
    min_precision: float = 0.98,
    min_covered: int = 3,
) -> DecisionList:
    """Decision list for ``bad`` from a table of ``key``, FEATURES and the boolean ``bad``.

    Every row counts. A rule is kept if it covers at least ``min_covered`` bad rows of
    the pruning third and at least ``min_precision`` of what it covers there is bad.
    """
    # one third prunes, chosen by the key, so that a rerun splits alike
    rows = labelled.select(*FEATURES, F.col(bad).alias("bad"), (F.pmod(F.xxhash64(key), F.lit(3)) == 0).alias("prune"))
    quantiles = [i / bins for i in range(1, bins)]
    row = rows.agg(
        *(F.percentile_approx(f, quantiles, 10000).alias(f"a_{f}") for f in FEATURES),
        *(F.percentile_approx(F.when(F.col("bad"), F.col(f)), quantiles, 10000).alias(f"b_{f}") for f in FEATURES),
    ).first()
    cuts = {f: sorted({*(row[f"a_{f}"] or []), *(row[f"b_{f}"] or [])}) for f in FEATURES}

    def bin_of(f: str) -> Column:
        """How many cuts are at or below the value."""
        return F.size(F.filter(F.array(*map(F.lit, cuts[f])), lambda c: c <= F.col(f))) if cuts[f] else F.lit(0)

    binned = rows.withColumn(
        "cells",
        F.array(
            *(
                F.struct(F.lit(f).alias("f"), F.when(F.col(f).isNotNull(), bin_of(f)).alias("i"))
                for f in FEATURES
            )
        ),
    )
    binned = written(binned, "labelled")
    covered, rules, failed = F.lit(False), [], set()
    while len(rules) < max_rules:
        grow = binned.filter(~F.col("prune") & ~covered)
        conditions: list[Condition] = []
        while len(conditions) < max_conditions:
            counted = (
                grow.filter(Rule(tuple(conditions)).column())
                .select("bad", F.explode("cells").alias("c"))
                .filter("c.i is not null")
                .groupBy("c.f", "c.i")
                .agg(F.count_if("bad").alias("b"), F.count_if(~F.col("bad")).alias("g"))
                .collect()
            )
            counts: dict[str, dict[int, tuple[int, int]]] = {}
            for r in counted:
                counts.setdefault(r["f"], {})[r["i"]] = (r["b"], r["g"])
            if conditions and all(sum(g for _, g in x.values()) == 0 for x in counts.values()):
                break
            found = _best_condition(counts, cuts, min_covered, set() if conditions else failed)
            if found is None:
                break
            conditions.append(found)
        if not conditions:
            break
        prefixes = [Rule(tuple(conditions[: i + 1])) for i in range(len(conditions))]
        held = (
            binned.filter(F.col("prune") & ~covered)
            .agg(
                *(F.count_if(r.column() & F.col("bad")).alias(f"b{i}") for i, r in enumerate(prefixes)),
                *(F.count_if(r.column() & ~F.col("bad")).alias(f"g{i}") for i, r in enumerate(prefixes)),
            )
            .first()
        )

        def worth(i: int) -> float:
            b, g = held[f"b{i}"], held[f"g{i}"]
            return (b - g) / (b + g) if b + g else -1.0

        best = max(range(len(prefixes)), key=lambda i: (worth(i), -i))
        b, g = held[f"b{best}"], held[f"g{best}"]
        if b < min_covered or b < min_precision * (b + g):
            # no rule starts from this side of this feature again
            failed.add((conditions[0].feature, conditions[0].at_least))
            continue
        rules.append(Rule(prefixes[best].conditions, b, g))
        covered = covered | rules[-1].column()
    return DecisionList(tuple(rules))


def labelled_features(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, FEATURES, bad) of the rows with a label; ``stats`` has doc_id and the struct ``stats``.

    ``bad`` is true where a quality label of the id is 0.
    """
    worst = (
        labels.filter("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg((F.min("quality") == 0).alias("bad"))
    )
    s = F.col("stats")
    return stats.join(worst, "doc_id").select("doc_id", *features(s), "bad")


def stats_table(docs: DataFrame) -> DataFrame:
    """(doc_id, stats) of every document, written once: the only pass over the texts."""
    return written(docs.select("doc_id", text_stats("text").alias("stats")), "quality-stats")


def judge(stats: DataFrame, rules: Sequence[Rule] | DecisionList) -> DataFrame:
    """Add base_failed, rule and kept to rows that hold the struct ``stats``.

    The feature columns are made under the names FEATURES, so ``stats`` should hold
    the id and the struct only.
    """
    rules = rules if isinstance(rules, DecisionList) else DecisionList(tuple(rules))
    s = F.col("stats")
    rest = [c for c in stats.columns if c not in FEATURES]
    return (
        stats.select(*rest, *features(s))
        .select(*rest, base_failed(s).alias("base_failed"), rules.fired().alias("rule"))
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )


def quality_table(docs: DataFrame, labels: DataFrame, **learning) -> DataFrame:
    """One row per document: its counts, base verdict, fired rule and kept."""
    stats = stats_table(docs)
    rules = learn_decision_list(labelled_features(stats, labels), **learning)
    return judge(stats, rules).select(
        "doc_id",
        *(F.col(f"stats.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        "base_failed",
        "kept",
        "rule",
    )


def keep_good(docs: DataFrame, labels: DataFrame, **learning) -> DataFrame:
    """The rows of ``docs`` that the base rules and the learned list keep, columns unchanged.

    The list is learned from the statistics table; the filter then counts again in
    its own scan, so no text is shuffled.
    """
    rules = learn_decision_list(labelled_features(stats_table(docs), labels), **learning)
    rejected = F.lit(False)
    s = text_stats("text")

    def verdict(x: Column) -> Column:
        values = dict(zip(FEATURES, features(x), strict=True))
        out = base_failed(x)
        for r in rules.rules:
            hit = F.lit(True)
            for c in r.conditions:
                v = values[c.feature]
                hit = hit & F.coalesce(v >= F.lit(c.cut) if c.at_least else v < F.lit(c.cut), F.lit(False))
            out = out | hit
        return out

    rejected = let(s, verdict)
    return docs.filter(~rejected)
