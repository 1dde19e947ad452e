"""Quality rules combined by weak supervision.

Every rule looks at the statistics of a document and votes *good* (1), *bad* (-1) or abstains
(0).  Documents with the same votes are counted together, and expectation-maximisation over
these counts estimates, without labels, the share of good documents and how often each rule
votes either way on good and on bad ones.  A document is kept when its posterior probability
of being good is high enough; no single rule decides.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm import textstats
from marquee.llm.common import add_columns, struct_of


@dataclass(frozen=True)
class VoteRule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains (SQL over
    the statistics; a NULL condition does not hold)."""
    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        return F.when(F.expr(self.bad), -1).when(F.expr(self.good), 1).otherwise(0)


NEVER = "false"
RULES = (
    # one kind of defect each: they vote bad or abstain
    VoteRule("symbols", "10 * n_symbols > n_words", NEVER),
    VoteRule("repeated_windows", "10 * n_repeat_words > 3 * n_words", NEVER),
    VoteRule("repeated_lines", "10 * n_dup_lines > 4 * n_lines and n_lines > 3", NEVER),
    VoteRule("word_twice", "10 * n_twice > n_words", NEVER),
    VoteRule("vocabulary", "10 * n_distinct < 3 * n_words and n_words between 50 and 5000", NEVER),
    VoteRule("capitals", "5 * n_upper > word_chars", NEVER),
    VoteRule("word_length", "word_chars > 10 * n_words or 2 * word_chars < 5 * n_words", NEVER),
    VoteRule("digits", "5 * n_digits > word_chars", NEVER),
    # ordinary statistics all round: they vote good or abstain
    VoteRule("prose", NEVER, "100 * n_symbols <= n_words and 20 * n_upper <= word_chars and n_words >= 20 "
                             "and word_chars between 3 * n_words and 8 * n_words"),
    VoteRule("varied", NEVER, "2 * n_distinct >= n_words and 10 * n_repeat_words <= n_words and 100 * n_twice <= 3 * n_words "
                              "and n_words >= 50"),
)

VOTES = (1, 0, -1)
MIN_WORDS = 50
KEEP_AT = 0.5  # posterior probability of being good


def base_failed() -> Column:
    """Too short, or more than half of the words repeated in 3-word windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def with_stats(df: DataFrame, text: str = "text", keep=None) -> DataFrame:
    """``df`` with the statistics of ``textstats.FIELDS`` (no shuffle; NULL like empty)."""
    return add_columns(df, [text], textstats.DDL, textstats.make_stats, keep)


def vote_counts(stats: DataFrame, rules: Sequence[VoteRule] = RULES) -> list[tuple[tuple[int, ...], int]]:
    """Documents per vote pattern: one partial aggregate over all documents, at most
    ``3 ** len(rules)`` rows whatever the size of the corpus."""
    names = [f"__v{i}" for i in range(len(rules))]
    rows = (stats.select(*[r.vote().alias(n) for r, n in zip(rules, names, strict=True)])
                 .groupBy(*names).agg(F.count("*").alias("__n")).collect())
    return sorted((tuple(r[n] for n in names), r["__n"]) for r in rows)


@dataclass(frozen=True)
class VoteModel:
    """``prior``: share of good documents.  ``rates[i][y][v]``: probability that rule i votes
    v on a document of class y (1 good, 0 bad)."""
    rules: tuple[VoteRule, ...]
    prior: float
    rates: tuple[dict[int, dict[int, float]], ...]

    def log_odds(self) -> Column:
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for r, p in zip(self.rules, self.rates, strict=True):
            odds = {v: math.log(p[1][v] / p[0][v]) for v in VOTES}
            total = total + F.when(r.vote() == 1, odds[1]).when(r.vote() == -1, odds[-1]).otherwise(odds[0])
        return total

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-self.log_odds()))

    def accuracies(self) -> dict[str, float]:
        """Of each rule, the estimated share of its votes that are right."""
        out = {}
        for r, p in zip(self.rules, self.rates, strict=True):
            q = self.prior
            right, wrong = q * p[1][1] + (1 - q) * p[0][-1], q * p[1][-1] + (1 - q) * p[0][1]
            out[r.name] = right / (right + wrong)
        return out


def fit_votes(counts: Sequence[tuple[tuple[int, ...], int]], rules: Sequence[VoteRule] = RULES,
              rounds: int = 200, smooth: float = 1.0) -> VoteModel:
    """EM on the pattern counts, started from a majority vote in which one bad vote weighs
    as much as all good ones (a defect is rare and specific, a clean statistic common).

    Votes and abstentions are conditionally independent given the class.  A rule's bad vote
    is never estimated to be likelier on good documents than on bad ones, nor the reverse
    for a good vote, so the classes cannot swap.  An empty table gives the even prior with
    uninformative rates.
    """
    k, n = len(rules), sum(c for _, c in counts)
    cast = [{0} | {votes[i] for votes, _ in counts} for i in range(k)]  # kinds of votes that occur
    post = [0.05 if -1 in votes else 0.95 if 1 in votes else 0.5 for votes, _ in counts]
    prior, rates = 0.5, tuple({y: dict.fromkeys(VOTES, 1 / 3) for y in (1, 0)} for _ in range(k))
    for _ in range(rounds):
        weight = {1: [c * q for (_, c), q in zip(counts, post, strict=True)],
                  0: [c * (1 - q) for (_, c), q in zip(counts, post, strict=True)]}
        new_prior = min(max((sum(weight[1]) + smooth) / (n + 2 * smooth), 0.01), 0.99)
        new = []
        for i in range(k):
            table = {}
            for y in (1, 0):
                seen = {v: smooth + sum(w for w, (votes, _) in zip(weight[y], counts, strict=True) if votes[i] == v)
                        if v in cast[i] else 1e-9 for v in VOTES}
                table[y] = {v: seen[v] / sum(seen.values()) if v in cast[i] else 1e-9 for v in VOTES}
            if any(table[0][v] > table[1][v] if v == 1 else table[1][v] > table[0][v] for v in cast[i] if v):
                # worse than chance: counted as uninformative
                same = {v: (table[0][v] + table[1][v]) / 2 for v in VOTES}
                table = {1: same, 0: dict(same)}
            new.append(table)
        moved = abs(new_prior - prior) + sum(abs(a[y][v] - b[y][v]) for a, b in zip(new, rates, strict=True)
                                             for y in (0, 1) for v in VOTES)
        prior, rates = new_prior, tuple(new)
        post = []
        for votes, _ in counts:
            odds = math.log(prior / (1 - prior)) + sum(math.log(rates[i][1][v] / rates[i][0][v]) for i, v in enumerate(votes))
            post.append(1 / (1 + math.exp(-max(-60.0, min(60.0, odds)))))
        if moved < 1e-9:
            break
    return VoteModel(tuple(rules), prior, rates)


def judge(stats: DataFrame, model: VoteModel, keep_at: float = KEEP_AT) -> DataFrame:
    """``stats`` with ``p_good``, ``base_failed`` and ``kept``."""
    return (stats.withColumn("p_good", model.probability()).withColumn("base_failed", base_failed())
                 .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= keep_at)))


def filter_quality(df: DataFrame, text: str = "text", rules: Sequence[VoteRule] = RULES) -> DataFrame:
    """The rows of ``df`` that are kept, with its own columns.

    The statistics are computed twice (to fit, then to judge) instead of shuffling or storing
    the texts; to judge, a text goes to Python once, by itself, and only numbers come back.
    Repeated rows are judged alike and all stay or all go; NULL and empty texts have no
    words and go; an empty table stays empty; columns named like a statistic are carried
    through untouched.
    """
    seen = df.select(struct_of(F.col(f"`{text}`"), textstats.DDL, textstats.make_stats).alias("__stats")).select("__stats.*")
    model = fit_votes(vote_counts(seen, rules), rules)
    carried = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"))
    stats = struct_of(F.col(f"__row.`{text}`"), textstats.DDL, textstats.make_stats)
    judged = judge(carried.withColumn("__stats", stats).select("__row", "__stats.*"), model)
    return judged.filter("kept").select("__row.*")
