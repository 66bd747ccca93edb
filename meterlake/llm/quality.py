"""Quality rules (operator 2): text statistics and learned decision lists.

DataFrame operations only.  Statistics are columns over the whole text; the
list is learned from labelled statistics by sequential covering, each step
one aggregate of class counts by feature and threshold, and applied as one
ordered conditional expression.
"""

from __future__ import annotations

import math
from collections.abc import Collection
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.shared import WORD, fresh, pick, saved, table, words

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
# Rules after which the rows still to be covered are written anew.
RULES_A_WRITE = 8
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def text_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the statistics and the learner's ratios to every row.

    ``n_words``; ``word_chars``: code points in words; ``n_symbols``;
    ``n_dup_lines``: lines with a word that equal an earlier line;
    ``n_repeat_words``: words in a 5-word window found twice or more in the
    text (windows are compared by 64-bit hash).  Ratios: ``FEATURES``.  A
    NULL or empty text has 0 everywhere.  Columns of ``docs`` with these
    names are replaced.

    Windows are hashed and sorted inside the row; only texts with a repeated
    window are sorted, so the work is n log n at worst and no row leaves its
    task.
    """
    keep = [c for c in docs.columns if c.lower() not in (*STATS, *FEATURES)]
    base = docs.select(*(f"`{c}`" for c in keep))
    w, t, lines, h, n, z, p = fresh(base, "w", "t", "lines", "h", "n", "z", "p")
    d = base.withColumn(t, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    d = d.withColumns({w: words(F.col(t)),
                       lines: F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))})
    at = lambda i, k: F.get(F.col(w), i + k)
    last = F.size(w) - WINDOW
    d = d.select(
        *(f"`{c}`" for c in keep), F.size(w).cast("bigint").alias("n_words"),
        F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        _ratio(F.size(lines) - F.size(F.array_distinct(lines)), F.size(lines)).alias("dup_line_ratio"),
        _ratio(F.size(F.array_distinct(w)), F.size(w)).alias("distinct_word_ratio"),
        _ratio(F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}", "")), F.length(t)).alias("upper_ratio"),
        _ratio(F.length(t) - F.length(F.regexp_replace(t, r"\p{Nd}", "")), F.length(t)).alias("digit_ratio"),
        _ratio(F.size(w), F.size(lines)).alias("words_per_line"),
        F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.when(last >= 0, last).otherwise(0)),
                                      lambda i: F.xxhash64(*(at(i, k) for k in range(WINDOW)))))
        .otherwise(F.array().cast("array<bigint>")).alias(h))
    names = d.columns[:-1]
    # Hashes with their places, sorted, where some hash occurs twice.
    d = d.withColumn(z, F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(F.transform(
        h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))).otherwise(F.array()))
    d = d.select(*(f"`{c}`" for c in names), z)
    # Places of windows whose neighbour in that order is equal.
    both = F.zip_with(F.slice(z, 1, F.greatest(F.size(z) - 1, F.lit(0))), F.slice(z, 2, F.greatest(F.size(z) - 1, F.lit(0))),
                      lambda a, b: F.when(a["x"] == b["x"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    d = d.select(*(f"`{c}`" for c in names), F.sort_array(F.array_distinct(F.flatten(both))).alias(p))
    # Words covered by those windows: the last adds 5, each other the step to its follower, 5 at most.
    steps = F.zip_with(F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))), F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))),
                       lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.when(F.size(p) > 0, F.aggregate(steps, F.lit(0), lambda s, x: s + x) + WINDOW).otherwise(0)
    d = d.select(*(f"`{c}`" for c in names), covered.cast("bigint").alias("n_repeat_words"))
    return d.withColumns({
        "repeat_ratio": _ratio(F.col("n_repeat_words"), F.col("n_words")),
        "symbol_ratio": _ratio(F.col("n_symbols"), F.col("word_chars")),
        "mean_word_chars": _ratio(F.col("word_chars"), F.col("n_words"))})


# What the rules may test.
FEATURES = ("n_words", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "distinct_word_ratio",
            "upper_ratio", "digit_ratio", "words_per_line", "mean_word_chars")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature > threshold, else feature <= threshold
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Ordered rules; a row that none fits is kept."""
    rules: list[list[Condition]] = field(default_factory=list)

    def fired(self) -> Column:
        """Text of the first rule that fits, else NULL."""
        out = F.lit(None).cast("string")
        for rule in reversed(self.rules):
            out = F.when(_all(rule), F.lit(" and ".join(map(str, rule)))).otherwise(out)
        return out


def _all(rule: list[Condition]) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def learn_rules(train: DataFrame, bad: str = "bad", key: str = "doc_id", features: tuple[str, ...] = FEATURES,
                max_rules: int | None = None, max_conditions: int = 3, n_thresholds: int = 24,
                min_precision: float = 0.9, min_covered: int = 10, max_rows: int = 200_000) -> DecisionList:
    """Learn a decision list for the rows with ``bad`` = 1.

    Sequential covering: a rule grows by the threshold condition of largest
    information gain on two thirds of the rows, is cut back to the prefix
    with the best (p - n) / (p + n) on the others, and is accepted while it
    covers ``min_covered`` bad rows there at ``min_precision``; its rows are
    then taken away.  A rule that fails is grown anew from another feature or
    side; the list ends when none is left that passes (``max_rules``: or
    earlier), so a kind with under ``min_covered`` bad rows in the third gets
    no rule.  ``max_rows`` bounds the labelled sample, drawn by hash of the
    key; thresholds lie halfway between quantiles of the two classes among
    the rows that no rule covers yet.  Ties go to the earlier feature and
    lower threshold.  Rows with NULL label are ignored; no rows or one class
    only: an empty list.
    """
    train = train.filter(F.col(bad).isNotNull())
    share = max_rows / max(1, train.count())
    unit = lambda seed: F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 40)) / F.lit(float(1 << 40))
    if share < 1:
        train = train.filter(unit(1) < share)
    train = saved(train.select(*features, (F.col(bad) == 1).cast("int").alias("y"),
                               (unit(2) < 2 / 3).alias("grow")), "labelled")
    learned, rest = DecisionList(), train
    while max_rules is None or len(learned.rules) < max_rules:
        rule = _next_rule(rest, features, max_conditions, n_thresholds, min_precision, min_covered)
        if not rule:
            break
        learned.rules.append(rule)
        rest = rest.filter(~_all(rule))
        if len(learned.rules) % RULES_A_WRITE == 0:  # keeps the plan short
            rest = saved(rest, "labelled-rest")
    return learned


def _next_rule(rest: DataFrame, features: tuple[str, ...], max_conditions: int, n_thresholds: int,
               min_precision: float, min_covered: int) -> list[Condition]:
    """The first rule that passes, starts tried by falling gain; none: empty."""
    grow, prune = rest.filter("grow"), rest.filter(~F.col("grow"))
    if prune.agg(F.coalesce(F.sum("y"), F.lit(0))).first()[0] < min_covered:
        return []
    cuts = _thresholds(rest, features, n_thresholds)
    tried: set[tuple[str, bool]] = set()
    while True:
        rule: list[Condition] = []
        while len(rule) < max_conditions:
            best = _best_condition(grow.filter(_all(rule)), features, cuts, () if rule else tried)
            if best is None:
                break
            rule.append(best)
        if not rule:
            return []
        tried.add((rule[0].feature, rule[0].above))
        rule = _pruned(prune, rule, min_precision, min_covered)
        if rule:
            return rule


def _thresholds(rows: DataFrame, features: tuple[str, ...], n_thresholds: int) -> dict[str, list[float]]:
    """Per feature, the values halfway between quantiles of the two classes."""
    steps = [(i + 0.5) / n_thresholds for i in range(n_thresholds)]
    quantiles = rows.agg(*(F.percentile_approx(F.when(F.col("y") == y, F.col(f)), steps, 10_000).alias(f"{f}_{y}")
                           for f in features for y in (0, 1))).first()
    seen = {f: sorted({float(x) for y in (0, 1) for x in quantiles[f"{f}_{y}"] or ()}) for f in features}
    return {f: [(a + b) / 2 for a, b in zip(x, x[1:])] for f, x in seen.items()}


def _best_condition(rows: DataFrame, features: tuple[str, ...], cuts: dict[str, list[float]],
                    but: Collection[tuple[str, bool]] = ()) -> Condition | None:
    """The condition of largest gain for the bad class, from one count of the
    rows by feature and the cell between two thresholds that they fall in.

    ``but``: features and sides (above or not) that are left out.
    """
    if not any(cuts.values()):
        return None

    def cell(f: str) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, cuts[f])), lambda c: c < F.col(f)))

    cells = F.array(*(F.struct(F.lit(i).alias("f"), cell(f).alias("cell"))
                      for i, f in enumerate(features) if cuts[f]))
    counts = {(r.f, r.cell): (r.p, r.n) for r in
              rows.select(F.explode(cells).alias("c"), "y").groupBy("c.f", "c.cell")
              .agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n")).collect()}
    best, found = 1e-9, None
    for i, f in enumerate(features):
        got = [counts.get((i, k), (0, 0)) for k in range(len(cuts[f]) + 1)]
        pos, neg = sum(p for p, _ in got), sum(n for _, n in got)
        if not pos or not neg:
            continue
        low_p = low_n = 0
        for k, c in enumerate(cuts[f]):
            low_p, low_n = low_p + got[k][0], low_n + got[k][1]
            for above, p, n in ((False, low_p, low_n), (True, pos - low_p, neg - low_n)):
                if p and p + n < pos + neg and (f, above) not in but:
                    gain = p * (math.log2(p / (p + n)) - math.log2(pos / (pos + neg)))
                    if gain > best * (1 + 1e-12):
                        best, found = gain, Condition(f, above, c)
    return found


def _pruned(rows: DataFrame, rule: list[Condition], min_precision: float, min_covered: int) -> list[Condition]:
    if not rule:
        return []
    prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
    got = rows.agg(*(F.coalesce(F.sum(F.when(_all(r) & (F.col("y") == y), 1)), F.lit(0)).alias(f"c{k}_{y}")
                     for k, r in enumerate(prefixes) for y in (0, 1))).first()
    best, out = -2.0, []
    for k, r in enumerate(prefixes):
        p, n = got[f"c{k}_1"], got[f"c{k}_0"]
        if p >= min_covered and p / (p + n) >= min_precision and (p - n) / (p + n) > best:
            best, out = (p - n) / (p + n), r
    return out


def base_failed() -> Column:
    """Fewer than 10 words, or over 20 % of them in repeated windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _verdicts(stats: DataFrame, labels: DataFrame, doc_id: str, label: str, options: dict) -> DataFrame:
    seen = pick(labels, label_id=doc_id, label=label)
    train = (stats.filter(~base_failed()).join(seen, F.col("doc_id") == F.col("label_id"))
             .withColumn("bad", 1 - F.col("label")))
    rules = learn_rules(train, **options)
    return stats.withColumns({"base_failed": base_failed(), "rule": rules.fired()}).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull())


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "quality", **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, statistics, features,
    ``base_failed``, ``rule`` (of the learned list, else NULL), ``kept``.

    The list is learned from rows within the base limits whose id ``labels``
    has (``doc_id``, ``label`` 0/1, 0 is bad); several labels of one id count
    once each.  NULL ids have no label, NULL text fails the base limits.  Long
    texts are read whole; repeated rows are judged each; other columns are
    left out, whatever their names; an empty table gives no rows.
    """
    stats = saved(text_stats(pick(docs, doc_id=doc_id, text=text)).drop("text"), "text-stats")
    return _verdicts(stats, labels, doc_id, label, options)


def judged_rows(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                label: str = "quality", **options) -> DataFrame:
    """As ``judge``, with the whole row of ``docs`` in the struct column ``row``.

    Rows are written with their statistics, so they need no join afterwards.
    """
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return _verdicts(saved(text_stats(rows).drop("text"), "judged-rows"), labels, doc_id, label, options)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on all documents by base limits and the learned list."""
    got = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return got.select("doc_id", *STATS, "base_failed", "kept", "rule")
