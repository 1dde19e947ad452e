"""Quality classifier as a sparse rule ensemble.

A random forest is grown on statistics of labelled texts; every path from a root to a node
becomes a conjunctive rule; lasso logistic regression weighs the rules and drops most; what
is left compiles into one Spark column expression over the statistics.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import written

# Largest training sample: the labelled rows of least hash, all of them where there are fewer.
TRAIN_ROWS = 20_000
TREES, DEPTH, LASSO, SEED = 24, 4, 0.002, 7
HELD_OUT_MOD = 5
PREDICT_AT = 0.3

# Features over the statistics of ``textstats.FIELDS``; a share of nothing is 0.
FEATURES = {
    "log_words": "ln(1 + n_words)",
    "symbol_share": "n_symbols / n_words",
    "repeat_share": "n_repeat_words / n_words",
    "twice_share": "n_twice / n_words",
    "distinct_share": "n_distinct / n_words",
    "short_share": "n_short / n_words",
    "word_length": "word_chars / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "words_per_line": "n_words / n_lines",
    "capital_share": "n_upper / word_chars",
    "digit_share": "n_digits / word_chars",
}


def features(stats: DataFrame) -> DataFrame:
    """``stats`` with one double per feature."""
    def safe(e: str) -> str:
        top, _, bottom = e.partition(" / ")
        return f"coalesce(cast({e} as double), 0)" if not bottom else f"coalesce({top} / nullif({bottom}, 0), 0)"
    return stats.withColumns({n: F.expr(safe(e)).cast("double") for n, e in FEATURES.items()})


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text is divisible by 5 (NULL: not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_MOD == 0, F.lit(False))


Rule = tuple[tuple[str, str, float], ...]  # conjunction of (feature, "<=" or ">", threshold)


def tree_rules(text: str, names: list[str]) -> list[Rule]:
    """The conjunctions of all nodes but the root of a printed decision tree."""
    rules, path = [], []
    for line in text.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", line)
        if m:
            path = [x for x in path if x[0] < len(m[1])] + [(len(m[1]), (names[int(m[2])], m[3], float(m[4])))]
            rules.append(tuple(c for _, c in path))
    return rules


def shortened(rule: Rule) -> Rule:
    """The same conjunction with one condition per feature and direction, in fixed order."""
    kept: dict[tuple[str, str], float] = {}
    for f, op, x in rule:
        old = kept.get((f, op), x)
        kept[f, op] = min(old, x) if op == "<=" else max(old, x)
    return tuple(sorted((f, op, x) for (f, op), x in kept.items()))


def holds(rule: Rule) -> Column:
    out = F.lit(True)
    for f, op, x in rule:
        out = out & (F.col(f) <= x if op == "<=" else F.col(f) > x)
    return out.cast("double")


@dataclass(frozen=True)
class RuleModel:
    """Score: logistic function of ``base`` plus the weights of the rules that hold."""
    base: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        total = F.lit(self.base)
        for rule, w in self.rules:
            total = total + holds(rule) * w
        return 1 / (1 + F.exp(-total))

    def describe(self) -> list[str]:
        return [f"{w:+.3f}  " + " and ".join(f"{f} {op} {x:.4g}" for f, op, x in rule) for rule, w in
                sorted(self.rules, key=lambda r: -abs(r[1]))]


def training_rows(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality",
                  rows: int = TRAIN_ROWS) -> DataFrame:
    """Features and ``label`` of at most ``rows`` labelled rows that are not held out, chosen
    by a hash of their id.  Labels other than 0 and 1 are left out; a repeated label row
    counts once, contradictory ones both."""
    known = labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("double").alias("label")) \
                  .filter(F.col("label").isin(0.0, 1.0) & ~held_out(F.col("__id"))).distinct()
    chosen = known.orderBy(F.xxhash64("__id"), "__id", "label").limit(rows)
    own = features(stats).select(F.col(doc_id).alias("__id"), *FEATURES)
    return chosen.join(own, "__id").select("label", *FEATURES)


def fit(train: DataFrame) -> RuleModel:
    """Forest, rules, lasso.  Without rows of both classes the score is the smoothed share of
    good rows for every text."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.functions import array_to_vector
    from math import log

    counts = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    if len(counts) < 2:
        good = counts.get(1.0, 0)
        share = (good + 1) / (sum(counts.values()) + 2)
        return RuleModel(log(share / (1 - share)), ())
    names = list(FEATURES)
    table = train.select("label", array_to_vector(F.array(*names)).alias("features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxBins=64, minInstancesPerNode=5,
                                    subsamplingRate=0.7, featureSubsetStrategy="onethird").fit(table)
    rules = sorted({shortened(r) for tree in forest.trees for r in tree_rules(tree.toDebugString, names)})
    if not rules:
        return RuleModel(log(counts[1.0] / counts[0.0]), ())
    table = train.select("label", array_to_vector(F.array(*[holds(r) for r in rules])).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=60).fit(table)
    weights = lasso.coefficients.toArray()
    return RuleModel(float(lasso.intercept), tuple((r, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6))


def score(stats: DataFrame, model: RuleModel, predict_at: float = PREDICT_AT) -> DataFrame:
    """``stats`` with ``score`` and ``predicted``."""
    plain = stats.columns
    return (features(stats).withColumn("score", model.score())
            .withColumn("predicted", (F.col("score") >= predict_at).cast("int")).select(*plain, "score", "predicted"))


def classify(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """Fit on the labelled rows that are not held out and score every row of ``stats`` (one
    row per document with ``textstats.FIELDS``; NULL and empty texts have zeros and score
    like any other).  Repeated rows score alike; an empty table gives no rows; the id, the
    labels and any other column are never inputs of a score."""
    train = written(training_rows(stats, labels, doc_id, label), "training")
    return score(stats, fit(train)).withColumn("held_out", held_out(F.col(doc_id)))
