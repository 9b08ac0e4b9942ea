"""Quality rules: document statistics and a learned decision list over them.

All of it is DataFrame work. The statistics come from one pass of array
functions per text. The decision list is learned by sequential covering: each
rule starts empty and grows by the threshold condition that most improves the
rule's gain over the labelled documents still uncovered; the grown rule is then
pruned on a held-back third by dropping final conditions while its precision
there does not fall; rules are added until none is precise enough. The list
becomes one ordered conditional expression: the first rule that fires rejects,
and a document on which none fires is kept.

Learning reads statistics only, as aggregates over threshold bins: the labelled
documents are counted once per combination of bins, so each step works on a
small table whatever the number of labels.

Defined results. Null, empty or blank text: all counts 0 and base_failed, since
fewer than 20 words. No labels, or none that says 0: an empty list, so the base
rules decide alone. Ties between conditions: the first in the fixed order of
statistics and thresholds. Repeated rows are judged each, extra columns ignored.
A document labelled more than once counts once per label, contradicting labels too,
and repeated rows under one id are learned from each; a row or a label without id has
no counterpart. Thresholds are values at exact ranks, so the list does not depend on
how rows are partitioned.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import BLANK, materialise
from orrery.operators.quantile import exact_values
from orrery.operators.skew import join_counted

SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
#: Ratios that rules may test, in the order in which ties are settled.
FEATURES = {
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "bang_per_word": "n_bang / greatest(n_words, 1)",
    "dup_lines": "double(n_dup_lines)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "echo_share": "n_echo / greatest(n_words, 1)",
}
#: Quantiles of each ratio that serve as thresholds.
CUTS = [0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.75, 0.8, 0.84, 0.88, 0.91, 0.94, 0.96, 0.98]
MAX_RULES, MAX_CONDITIONS = 6, 3
#: A rule must reject at least this share of low quality among what it covers.
MIN_PRECISION = 0.9
MIN_COVER = 5


def _pairs(of: str, apart: int) -> Column:
    """Hashes of each element with the one ``apart`` places on."""
    heads = F.slice(of, F.lit(1), F.greatest(F.lit(0), F.size(of) - apart))
    return F.transform(heads, lambda x, i: F.xxhash64(x, F.get(F.col(of), i + apart)))


def statistics(docs: DataFrame) -> DataFrame:
    """Counts of every row, by array functions within the row.

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and for
    the rules n_upper, n_bang and n_echo (words equal to the word before).
    Windows of eight words are compared by 64-bit hashes. Only a text with an
    equal pair of windows has its windows sorted to find them all.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", text.alias("t")).withColumn("w", F.array_remove(F.split("t", BLANK + "+"), ""))
    lines = F.filter(F.split("t", "\n"), lambda line: line.rlike("[^" + BLANK[1:]))
    counted = base.withColumn("lines", lines).select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.regexp_count("t", F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count("t", F.lit("!")).cast("long").alias("n_bang"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h1"),
    )
    echo = F.size(F.filter("h1", lambda x, i: x == F.get(F.col("h1"), i + 1))).cast("long")
    counted = counted.withColumns({"n_echo": echo, "h2": _pairs("h1", 1)}).drop("h1")
    counted = counted.withColumn("h4", _pairs("h2", 2)).drop("h2")
    counted = counted.withColumn("h", _pairs("h4", 4)).drop("h4")
    placed = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    some = F.size(F.array_distinct("h")) < F.size("h")
    counted = counted.withColumn("s", F.when(some, placed)).drop("h")
    s = F.col("s")
    twice = F.filter("s", lambda e, i: (e["h"] == F.get(s, i - 1)["h"]) | (e["h"] == F.get(s, i + 1)["h"]))
    starts = F.array_sort(F.transform(twice, lambda e: e["i"]))
    counted = counted.withColumn("starts", starts).drop("s")
    # Windows overlap: each start adds the words past the window before it.
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    return counted.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        "n_upper",
        "n_bang",
        "n_echo",
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


# --- decision list --------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float
    at: int  # place of the cut among the feature's thresholds

    def on_bins(self) -> Column:
        return F.col(self.feature) > self.at if self.above else F.col(self.feature) <= self.at

    def on_counts(self) -> Column:
        ratio = F.expr(FEATURES[self.feature])
        return ratio > self.cut if self.above else ratio <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:g}"


def _all(rule: list[Condition], how: str) -> Column:
    out = F.lit(True)
    for c in rule:
        out &= getattr(c, how)()
    return out


def learn(stats: DataFrame, labels: DataFrame) -> list[list[Condition]]:
    """The decision list for labels (doc_id, quality), by sequential covering."""
    mine = stats.where(~base_failed())
    # Labels are counted per id first, so neither side of the join can have a hot id.
    marks = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.sum(1 - F.col("quality")).alias("low"), F.sum("quality").alias("high"))
    known = marks.join(mine.groupBy("doc_id").agg(F.count("*").alias("of")), "doc_id")
    seen = join_counted(mine, materialise(known, "known-labels"), "doc_id", "of")
    each = [F.struct(F.lit(bad).alias("bad"), F.col(c).cast("long").alias("n")) for bad, c in ((1, "low"), (0, "high"))]
    ratios = [F.expr(v).alias(k) for k, v in FEATURES.items()]
    hold = (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("hold")
    seen = materialise(seen.select(F.inline(F.array(*each)), hold, *ratios).where("n > 0"), "labelled")
    values = F.explode(F.array(*[F.struct(F.lit(k).alias("f"), F.col(k).alias("v")) for k in FEATURES]))
    ranks = lambda n: F.array(*[F.greatest(F.lit(0), F.ceil(q * n) - 1) for q in CUTS])
    points = exact_values(seen.select("n", values.alias("x")).select("n", "x.*"), ["f"], "v", ranks, F.col("n"))
    points = points.select("f", "value").distinct().collect()  # features x CUTS rows at most
    cuts = {k: sorted(r["value"] for r in points if r["f"] == k) for k in FEATURES}
    bins = {k: sum([(F.col(k) > c).cast("int") for c in cuts[k]], F.lit(0)).alias(k) for k in FEATURES}
    table = materialise(
        seen.select("bad", "hold", "n", *bins.values()).groupBy("bad", "hold", *FEATURES).agg(F.sum("n").alias("n")), "bins"
    )
    rules: list[list[Condition]] = []
    while len(rules) < MAX_RULES:
        left = table
        for r in rules:
            left = left.where(~_all(r, "on_bins"))
        rule: list[Condition] = []
        while len(rule) < MAX_CONDITIONS:
            best = _best_condition(left.where(~F.col("hold")).where(_all(rule, "on_bins")), cuts)
            if best is None:
                break
            rule.append(best)
        rule = _pruned(left.where("hold"), rule)
        if not rule:
            break
        cover = left.where(_all(rule, "on_bins")).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("bad")).alias("bad")).first()
        if (cover["n"] or 0) < MIN_COVER or cover["bad"] < MIN_PRECISION * cover["n"]:
            break
        rules.append(rule)
    return rules


def _best_condition(rows: DataFrame, cuts: dict[str, list[float]]) -> Condition | None:
    """The condition of the largest information gain, or none that gains."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("f"), F.col(k).alias("b")) for k in FEATURES])).alias("x")
    counted = (
        rows.select("bad", "n", each)
        .groupBy("x.f", "x.b")
        .agg(F.sum(F.col("n") * F.col("bad")).alias("bad"), F.sum(F.col("n") * (1 - F.col("bad"))).alias("good"))
        .collect()  # features x bins at most
    )
    bad = {(r["f"], r["b"]): r["bad"] for r in counted}
    good = {(r["f"], r["b"]): r["good"] for r in counted}
    first = next(iter(FEATURES))
    p0 = sum(v for (f, _), v in bad.items() if f == first)
    n0 = sum(v for (f, _), v in good.items() if f == first)
    if not p0 or not n0:
        return None
    best, best_gain = None, 1e-9
    for f in FEATURES:
        for at, cut in enumerate(cuts[f]):
            for above in (True, False):
                p = sum(v for (g, b), v in bad.items() if g == f and (b > at) == above)
                n = sum(v for (g, b), v in good.items() if g == f and (b > at) == above)
                if p:
                    gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                    if gain > best_gain:
                        best, best_gain = Condition(f, above, cut, at), gain
    return best


def _pruned(rows: DataFrame, rule: list[Condition]) -> list[Condition]:
    """Drop final conditions while the precision on ``rows`` does not fall."""
    if len(rule) < 2:
        return rule
    sums = []
    for k in range(1, len(rule) + 1):
        on = F.when(_all(rule[:k], "on_bins"), F.col("n")).otherwise(0)
        sums += [F.sum(on).alias(f"n{k}"), F.sum(on * F.col("bad")).alias(f"bad{k}")]
    got = rows.agg(*sums).first()
    precision = {k: (got[f"bad{k}"] or 0) / (got[f"n{k}"] or 1) for k in range(1, len(rule) + 1)}
    k = len(rule)
    while k > 1 and precision[k - 1] >= precision[k]:
        k -= 1
    return rule[:k]


def verdict(rules: list[list[Condition]]) -> Column:
    """The ordered conditional expression: the number of the first rule that
    fires, from 1; 0 if none does."""
    out = None
    for k, rule in enumerate(rules, 1):
        fires = _all(rule, "on_counts")
        out = F.when(fires, k) if out is None else out.when(fires, k)
    return F.lit(0) if out is None else out.otherwise(0)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics and verdict of every row of ``docs``; see the module's text.

    ``rule`` is the text of the rule that rejected the document, else null.
    """
    stats = materialise(statistics(docs), "statistics")
    rules = learn(stats, labels)
    names = F.array(*[F.lit(" and ".join(map(str, r))) for r in rules]).cast("array<string>")
    fired = stats.withColumns({"base_failed": base_failed(), "fired": verdict(rules)})
    return fired.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.col("fired") == 0)).alias("kept"),
        F.get(names, F.col("fired") - 1).alias("rule"),
    )
