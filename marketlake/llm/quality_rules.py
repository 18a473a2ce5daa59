"""Quality rules as weak supervision, native.

Each rule votes good (1), bad (0) or abstains (null) on a document's statistics.
Expectation-maximisation over the counts of vote patterns estimates how often a rule is
right on good and on bad documents, without labels; the posterior probability that a
document is good, given its votes, replaces passing every rule.

The patterns are a bounded table (3^rules rows); each round is one aggregate over it.

Defined cases: a null or blank text has no words and fails the base rule; other columns
stay as they are; no documents give no rows and the prior model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import WORD_BREAKS, keep, words_of

WINDOW = 5
SYMBOLS = "[^#*$%&|<>]+"  # everything but the symbols counted
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# and n_upper: capital letters

# Starting point of the estimates: good documents hardly ever draw a bad vote, bad ones
# are bad in one respect and draw good votes for the others.
PRIOR_GOOD = 0.5
START_ON_GOOD = 0.99
START_ON_BAD = 0.6
# The rules' bounds are set so that few good documents lie beyond: what pulls an estimate
# above this share of false alarms is taken for bad documents.
FALSE_ALARMS = 0.01
ROUNDS = 25


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def _repeat_words(words: Column) -> Column:
    """Words in windows of WINDOW words that occur twice or more in the text.

    Windows are 64-bit hashes.  Sorted (hash, place) pairs bring equal windows together;
    each place then covers the words up to the next covered place, WINDOW at most."""

    def places(words):
        return F.sequence(F.lit(1), F.size(words) - F.lit(WINDOW - 1))

    def hashed(words):
        return F.transform(
            places(words),
            lambda i: F.xxhash64(*[F.get(words, i + F.lit(k - 1)) for k in range(WINDOW)]),
        )

    def repeated(hashes):
        pairs = F.array_sort(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        return _let(
            pairs,
            lambda s: F.array_sort(
                F.transform(
                    F.filter(
                        s,
                        lambda p, k: (p["h"] == F.get(s, k + 1)["h"]).eqNullSafe(True)
                        | ((k > 0) & (p["h"] == F.get(s, k - 1)["h"])).eqNullSafe(True),
                    ),
                    lambda p: p["i"],
                )
            ),
        )

    def covered(at):
        return F.aggregate(
            F.transform(
                at,
                lambda i, k: F.least(F.coalesce(F.get(at, k + 1) - i, F.lit(WINDOW)), F.lit(WINDOW)),
            ),
            F.lit(0),
            lambda total, n: total + n,
        )

    def count(words):
        return _let(
            hashed(words),
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
                _let(repeated(h), covered)
            ),
        )

    return _let(words, lambda w: F.when(F.size(w) < WINDOW, F.lit(0)).otherwise(count(w)))


def with_statistics(docs: DataFrame) -> DataFrame:
    """Add the statistics of ``text``; columns of the same names are replaced."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    words = docs.withColumn("_words", words_of(F.col("text")))
    return words.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.regexp_replace(text, WORD_BREAKS, "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long"),
            "n_upper": F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long"),
            "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast(
                "long"
            ),
            "n_repeat_words": _repeat_words(F.col("_words")).cast("long"),
        }
    ).drop("_words")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(good, F.lit(1)).when(bad, F.lit(0))


def rules() -> dict[str, Column]:
    """Votes on the statistics.  Between a rule's two bounds it abstains."""
    words, chars = F.col("n_words"), F.col("word_chars")
    symbols, repeats = F.col("n_symbols"), F.col("n_repeat_words")
    return {
        "length": _vote(words >= 20, words < 10),
        "word_length": _vote(
            chars.between(3 * words, 9 * words), (chars < 2 * words) | (chars > 14 * words)
        ),
        "symbols": _vote(50 * symbols <= words, 5 * symbols > words),
        "capitals": _vote(5 * F.col("n_upper") <= chars, 2 * F.col("n_upper") > chars),
        "duplicate_lines": _vote(
            F.col("n_dup_lines") == 0, 5 * F.col("n_dup_lines") > F.greatest(words, F.lit(20))
        ),
        "repeats": _vote(20 * repeats <= words, 5 * repeats > words),
    }


@dataclass(frozen=True)
class RuleModel:
    """Share of good documents; per rule the chance that its vote, if it votes, is
    ``good`` on good documents and on bad ones."""

    good: float
    on_good: dict[str, float]
    on_bad: dict[str, float]

    def log_odds(self) -> Column:
        odds = F.log(F.lit(self.good / (1 - self.good)))
        for name in self.on_good:
            g, b = self.on_good[name], self.on_bad[name]
            odds = odds + F.when(F.col(name) == 1, F.log(F.lit(g / b))).when(
                F.col(name) == 0, F.log(F.lit((1 - g) / (1 - b)))
            ).otherwise(F.lit(0.0))
        return odds

    def posterior(self) -> Column:
        return 1 / (1 + F.exp(-self.log_odds()))


def fit(stats: DataFrame, rounds: int = ROUNDS) -> RuleModel:
    """Estimate the rules' accuracies from all documents' votes."""
    votes = rules()
    patterns = keep(
        stats.select(*[v.alias(k) for k, v in votes.items()])
        .groupBy(*votes)
        .agg(F.count(F.lit(1)).alias("n"))
        .coalesce(1),
        "vote-patterns",
    )
    model = RuleModel(
        PRIOR_GOOD,
        dict.fromkeys(votes, START_ON_GOOD),
        dict.fromkeys(votes, START_ON_BAD),
    )
    for _ in range(rounds):
        good = model.posterior() * F.col("n")
        bad = (1 - model.posterior()) * F.col("n")
        sums = [F.sum(good).alias("good"), F.sum(bad).alias("bad")]
        for name in votes:
            for side, share in (("good", good), ("bad", bad)):
                said = F.when(F.col(name).isNotNull(), share)
                sums.append(F.sum(said).alias(f"{name}_{side}"))
                sums.append(F.sum(F.when(F.col(name) == 1, share)).alias(f"{name}_{side}_1"))
        row = patterns.agg(*sums).first().asDict()
        if row["good"] is None:
            break

        # one imagined vote, at the starting rate, keeps estimates inside (0, 1)
        def share(name: str, side: str, start: float, row=row) -> float:
            yes, all_ = row[f"{name}_{side}_1"] or 0.0, row[f"{name}_{side}"] or 0.0
            return (yes + start) / (all_ + 1)

        model = RuleModel(
            (row["good"] + PRIOR_GOOD) / (row["good"] + row["bad"] + 1),
            {k: max(1 - FALSE_ALARMS, share(k, "good", START_ON_GOOD)) for k in votes},
            {k: share(k, "bad", START_ON_BAD) for k in votes},
        )
    return model


def judge(stats: DataFrame, model: RuleModel, least: float = 0.5) -> DataFrame:
    """Add base_failed, quality (posterior) and kept to documents with statistics."""
    voted = stats.withColumns({f"_rule_{k}": v for k, v in rules().items()})
    renamed = RuleModel(
        model.good,
        {f"_rule_{k}": v for k, v in model.on_good.items()},
        {f"_rule_{k}": v for k, v in model.on_bad.items()},
    )
    return voted.withColumns(
        {"base_failed": base_failed(), "quality": renamed.posterior()}
    ).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least)).drop(
        *renamed.on_good
    )
