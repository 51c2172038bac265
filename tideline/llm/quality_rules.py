"""Quality rules as weak supervision, in DataFrame operations only.

Each rule looks at one figure of a text and votes good, votes bad, or abstains.
The votes are summed up by pattern over all texts, at most 3 to the number of
rules, and expectation-maximisation estimates from the pattern counts how common
good texts are and how often each rule gives each vote on good and on bad texts;
no label is used. A text is kept if its posterior probability of being good is at
least ``KEEP``. Two failures are final whatever the rules say (``base_failed``).

The figures of a text are made in one pass and written out narrow; patterns are
counted by a partial aggregation; the posterior is a sum of one logarithm a rule.

Null and empty texts have no words and fail. With no text at all the estimates
stay where they start. Ties of the posterior keep the text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.session import materialise

#: White space by the contract, each mapped to a space.
SPACES = "\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS, MOST_REPEATED = 10, 20
STEPS, KEEP = 50, 0.5
FALSE_ALARM, LEAST_HIT = 0.005, 0.05


@dataclass(frozen=True)
class Rule:
    """Votes good if the figure is within ``good``, bad if outside ``fair``, else abstains."""

    name: str
    figure: str
    good: tuple[float, float]
    fair: tuple[float, float]

    def vote(self) -> Column:
        x = F.expr(self.figure)
        within = lambda bounds: (x >= bounds[0]) & (x <= bounds[1])
        return F.when(within(self.good), 1).when(~within(self.fair), -1).otherwise(0)


#: Figures are expressions over the columns of ``figures``; shares are of words, of characters or of lines.
RULES = (
    Rule("word_length", "word_chars / greatest(n_words, 1)", (2.5, 7.5), (2.0, 9.0)),
    Rule("symbols", "n_symbols / greatest(word_chars, 1)", (0.0, 0.01), (0.0, 0.06)),
    Rule("symbols_of_words", "n_symbols / greatest(n_words, 1)", (0.0, 0.05), (0.0, 0.25)),
    Rule("letters", "n_letters / greatest(word_chars, 1)", (0.9, 1.0), (0.75, 1.0)),
    Rule("repeated_words", "n_repeat_words / greatest(n_words, 1)", (0.0, 0.05), (0.0, 0.18)),
    Rule("repeated_lines", "n_dup_lines / greatest(n_lines, 1)", (0.0, 0.15), (0.0, 0.5)),
    Rule("capitals", "n_capitals / greatest(word_chars, 1)", (0.0, 0.1), (0.0, 0.3)),
    Rule("shouting", "n_marks / greatest(n_words, 1)", (0.0, 0.05), (0.0, 0.25)),
    Rule("length", "n_words", (30, 1e12), (15, 1e12)),
)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), lambda w: w != "")


def figures(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the counts that rules and contract use; nulls count as empty texts."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    plain = F.translate("t", SPACES + " ", "")
    lines = F.filter(F.split("t", "\n"), lambda x: F.translate(x, SPACES + " ", "") != "")
    cut = base.select(
        "doc_id",
        F.transform(_words(F.col("t")), lambda w: F.xxhash64(w)).alias("w"),
        F.length(plain).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("t") - F.length(F.translate("t", "!?", ""))).alias("n_marks"),
        F.length(F.regexp_replace(plain, r"\P{Lu}+", "")).alias("n_capitals"),
        F.length(F.regexp_replace(plain, r"\P{L}+", "")).alias("n_letters"),
        lines.alias("lines"),
    )
    windows = F.when(
        F.size("w") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("w") - WINDOW),
            lambda i: F.xxhash64(*(F.get("w", i + j) for j in range(WINDOW))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    seen = cut.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_marks",
        "n_capitals",
        "n_letters",
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("h"),
    )
    # only texts with a repeated window are sorted; equal windows then stand together
    sorted_h = F.when(
        F.size(F.array_distinct("h")) < F.size("h"),
        F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i")))),
    )
    paired = seen.withColumn("s", sorted_h).drop("h")
    starts = F.array_sort(
        F.transform(
            F.filter(
                "s",
                lambda p, k: F.coalesce(F.get("s", k - 1)["x"] == p["x"], F.lit(False))
                | F.coalesce(F.get("s", k + 1)["x"] == p["x"], F.lit(False)),
            ),
            lambda p: p["i"],
        )
    )
    placed = paired.withColumn("p", starts).drop("s")
    covered = F.aggregate(
        F.transform(
            "p", lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get("p", k + 1) - i, F.lit(WINDOW)))
        ),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    return placed.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("p")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


@dataclass(frozen=True)
class LabelModel:
    """Share of good texts, and for each rule the chance of each vote (-1, 0, 1) on bad and good texts."""

    good: float
    chances: tuple[tuple[dict[int, float], dict[int, float]], ...]

    def weight(self, rule: int, vote: int) -> float:
        """Log-odds that a vote adds; an abstention adds none."""
        if not vote:
            return 0.0
        bad, good = self.chances[rule]
        return math.log(good[vote] / bad[vote])


def estimate(patterns: list[tuple[tuple[int, ...], int]], n_rules: int, steps: int = STEPS) -> LabelModel:
    """Expectation-maximisation over (votes, count); abstentions say nothing.

    Rules are set to fire on bad texts only: a bad vote is taken to be no more
    frequent than ``FALSE_ALARM`` on good texts, and no less than ``LEAST_HIT`` on
    bad ones. Without that, the one kind of bad text on which most rules agree
    would become the bad class, and every other kind would count as good.
    """
    good = 0.7
    chances = [({-1: 0.5, 1: 0.5}, {-1: FALSE_ALARM, 1: 1 - FALSE_ALARM}) for _ in range(n_rules)]
    for _ in range(steps):
        seen = [[{-1: 1.0, 1: 1.0}, {-1: 1.0, 1: 1.0}] for _ in range(n_rules)]  # one text of each beforehand
        total = [1.0, 1.0]
        for votes, n in patterns:
            odds = math.log(good / (1 - good))
            for (b, g), v in zip(chances, votes, strict=True):
                odds += math.log(g[v] / b[v]) if v else 0.0
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
            for side, share in ((0, 1 - p), (1, p)):
                total[side] += n * share
                for r, v in enumerate(votes):
                    if v:
                        seen[r][side][v] += n * share
        good = total[1] / sum(total)
        chances = []
        for bad, fine in seen:
            hit = max(bad[-1] / (bad[-1] + bad[1]), LEAST_HIT)
            alarm = min(fine[-1] / (fine[-1] + fine[1]), FALSE_ALARM)
            chances.append(({-1: hit, 1: 1 - hit}, {-1: alarm, 1: 1 - alarm}))
    return LabelModel(good, tuple(chances))


def fit(counted: DataFrame, rules: tuple[Rule, ...] = RULES, steps: int = STEPS) -> LabelModel:
    """Estimate from the pattern counts of a table of ``figures``."""
    votes = counted.select(*(r.vote().alias(r.name) for r in rules))
    names = [r.name for r in rules]
    patterns = sorted((tuple(row[n] for n in names), row["count"]) for row in votes.groupBy(*names).count().collect())
    return estimate(patterns, len(rules), steps)


def posterior(model: LabelModel, rules: tuple[Rule, ...] = RULES) -> Column:
    """Probability of a good text from its figures."""
    odds = F.lit(math.log(model.good / (1 - model.good)))
    for i, rule in enumerate(rules):
        vote = rule.vote()
        odds = odds + F.when(vote == 1, model.weight(i, 1)).when(vote == -1, model.weight(i, -1)).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def judge(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The figures of every document, ``base_failed``, ``posterior`` and ``kept``."""
    counted = materialise(figures(docs, doc_id=doc_id, text=text))
    model = fit(counted, rules)
    judged = counted.withColumn("base_failed", base_failed()).withColumn("posterior", posterior(model, rules))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP))
