"""Quality rules by weak supervision, from DataFrame functions only.

Ten rules look at a document's counts; each votes good (1) or bad (-1) or abstains (0).
Expectation-maximisation over all documents estimates, for either class, how often a
voting rule is right, and the posterior probability of "good" decides, in place of a
filter that every rule must pass.

The votes of all documents are first counted by vote pattern (at most 3^10 rows, by a
partial aggregate); all EM rounds are one expression over that bounded table, and the
few learned numbers go into the final projection as literals. All counting runs over
whole texts and over every document.

Null and empty texts have no words: they fail the base rule. An empty table learns the
starting values and gives an empty table. Repeated rows are judged one by one, alike.
Window equality is compared by 64-bit hashes of the five words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlift.llm.common import save, text_or_empty

BLANK = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
ROUNDS = 12
KEEP_AT = 0.5


def _without(col: str, chars: str) -> Column:
    return F.translate(F.col(col), chars, "")


def _count(col: str, chars: str) -> Column:
    return (F.length(col) - F.length(_without(col, chars))).cast("long")


def counts(docs: DataFrame) -> DataFrame:
    """``docs`` plus the word, symbol, line and repeat counts of ``_text``.

    Every array lives in a projection of its own and is referenced more than once
    above it, so it is evaluated once a row.
    """
    blank = "".join(BLANK)
    df = docs.withColumn("_text", text_or_empty())
    df = df.withColumn("_trimmed", F.btrim("_text", F.lit(blank)))
    df = df.withColumns({
        "_words": F.when(F.col("_trimmed") == "", F.array().cast("array<string>"))
        .otherwise(F.split("_trimmed", r"[ \t-\r]+")),
        "_lines": F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(blank)) != ""),
    })
    df = df.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(_without("_text", blank)).cast("long"),
        "n_symbols": _count("_text", SYMBOLS),
        "_n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_n_marked": F.size(F.filter("_lines", lambda x: F.translate(x, SYMBOLS, "") != x)).cast("long"),
        "_n_upper": _count("_text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "_n_bang": _count("_text", "!"),
        "_last": F.right("_trimmed", F.lit(1)),
        "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
    })
    h = F.col("_hashes")
    df = df.withColumn("_windows", F.when(F.size(h) < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(h) - F.lit(WINDOW)),
                    lambda i: F.xxhash64(*[h[i + F.lit(k)] for k in range(WINDOW)]))))
    # Most texts repeat no window; only the others pay for the sort.
    df = df.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda w, i: F.struct(w.alias("h"), i.alias("i"))))))
    s = F.col("_sorted")
    same = lambda x, y: s[x]["h"] == s[y]["h"]
    last = F.size(s) - F.lit(1)
    df = df.withColumn("_starts", F.sort_array(F.transform(
        F.filter(F.sequence(F.lit(0), last), lambda k: F.when(k > 0, same(k, k - 1)).otherwise(False)
                 | F.when(k < last, same(k, k + 1)).otherwise(False)),
        lambda k: s[k]["i"])))
    covered = F.aggregate("_starts", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("at")),
                          lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["at"])).alias("n"),
                                                  p.alias("at")), lambda acc: acc["n"])
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("tinyint")


def votes() -> dict[str, Column]:
    """The rules. Ratios are per word, so a rule means the same at every length."""
    per_word = lambda c: F.col(c) / F.greatest(F.col("n_words"), F.lit(1))
    size = per_word("word_chars")
    lines = F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1))
    marked = F.col("_n_marked") / F.greatest(F.col("_n_lines"), F.lit(1))
    symbols = F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))
    upper = F.col("_n_upper") / F.greatest(F.col("word_chars"), F.lit(1))
    never = F.lit(False)
    return {
        "long_enough": _vote(never, F.col("n_words") < 10),
        "word_length": _vote(never, (size < 2) | (size > 14)),
        "few_symbols": _vote(per_word("n_symbols") <= 0.02, per_word("n_symbols") > 0.1),
        "letters_not_symbols": _vote(symbols <= 0.005, symbols > 0.05),
        "clean_lines": _vote(marked <= 0.1, marked > 0.5),
        "few_repeats": _vote(per_word("n_repeat_words") <= 0.05, per_word("n_repeat_words") > 0.2),
        "few_dup_lines": _vote((F.col("_n_lines") >= 3) & (lines <= 0.05), lines > 0.4),
        "lower_case": _vote(upper <= 0.12, upper > 0.3),
        "few_shouts": _vote(per_word("_n_bang") <= 0.02, per_word("_n_bang") > 0.2),
        "ends_a_sentence": _vote(F.col("_last").isin(list(".!?\"')…”»")), never),
    }


def features(docs: DataFrame) -> DataFrame:
    """``counts`` plus one ``_v_<rule>`` column per rule and ``base_failed``."""
    df = counts(docs).withColumns({f"_v_{k}": v for k, v in votes().items()})
    return df.withColumn("base_failed", (F.col("n_words") < 10)
                         | (F.lit(100) * F.col("n_repeat_words") > F.lit(20) * F.col("n_words")))


@dataclass(frozen=True)
class QualityModel:
    """Learned by EM: P(good), and per rule P(votes bad), P(votes good) in either class.

    ``rates[rule]`` is (bad | good doc, good | good doc, bad | bad doc, good | bad doc); the
    rest of each class abstains.
    """

    prior: float
    rates: dict[str, tuple[float, float, float, float]]

    def accuracy(self, rule: str) -> float:
        """How often the rule is right when it votes."""
        wrong, right, hit, miss = self.rates[rule]
        p = self.prior
        return (p * right + (1 - p) * hit) / (p * (right + wrong) + (1 - p) * (hit + miss))

    def posterior(self) -> Column:
        score = F.lit(math.log(self.prior / (1 - self.prior)))
        for rule, (bg, gg, bb, gb) in self.rates.items():
            rest = math.log(_abstains(bg, gg) / _abstains(bb, gb))
            v = F.col(f"_v_{rule}")
            score = score + F.when(v == 1, math.log(gg / gb)).when(v == -1, math.log(bg / bb)).otherwise(rest)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def _abstains(bad: float, good: float) -> float:
    return max(0.01, 1 - bad - good)


# What EM may conclude of any rule: (lowest, highest) of the four rates. A rule seldom
# calls a good document bad, so that one confident vote against a document counts.
RANGES = ((0.001, 0.1), (0.05, 0.98), (0.1, 0.9), (0.02, 0.6))
START = (0.02, 0.6, 0.3, 0.3)


def vote_patterns(voted: DataFrame) -> DataFrame:
    """How many documents share each pattern of votes: at most 3^rules rows."""
    return voted.groupBy(*[f"_v_{k}" for k in votes()]).agg(F.count("*").alias("n"))


def learn(patterns: DataFrame, rounds: int = ROUNDS) -> QualityModel:
    """EM over the pattern table, all rounds in one expression over its one-row array.

    Abstaining is an outcome of its own, with its own probability in either class. Every
    estimate stays within RANGES, so the classes cannot change places.
    """
    rules = list(votes())
    table = patterns.select(F.struct(F.col("n").cast("double").alias("n"),
                                     F.array(*[F.col(f"_v_{k}").cast("int") for k in rules]).alias("v")).alias("s"))
    table = table.groupBy().agg(F.collect_list("s").alias("rows"))
    names = ("bg", "gg", "bb", "gb")
    start = F.struct(F.lit(0.85).alias("prior"),
                     *[F.array(*[F.lit(x)] * len(rules)).alias(k) for k, x in zip(names, START)])
    every = F.sequence(F.lit(0), F.lit(len(rules) - 1))
    rest = lambda bad, good: F.greatest(F.lit(0.01), 1 - bad - good)

    def posterior(s: Column, m: Column) -> Column:
        score = F.aggregate(every, F.log(m["prior"] / (1 - m["prior"])), lambda a, r: a + F.log(
            F.when(s["v"][r] == 1, m["gg"][r] / m["gb"][r]).when(s["v"][r] == -1, m["bg"][r] / m["bb"][r])
            .otherwise(rest(m["bg"][r], m["gg"][r]) / rest(m["bb"][r], m["gb"][r]))))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))

    def maximise(scored: Column) -> Column:
        total = lambda share: F.aggregate(scored, F.lit(1e-9), lambda a, x: a + x["n"] * share(x))
        good, bad = (lambda x: x["p"]), (lambda x: 1 - x["p"])

        def rate(share, vote: int, name: str) -> Column:
            low, high = RANGES[names.index(name)]
            own = lambda r: lambda x: F.when(x["v"][r] == vote, share(x)).otherwise(0.0)
            return F.transform(every, lambda r: F.least(F.lit(high), F.greatest(
                F.lit(low), total(own(r)) / total(share)))).alias(name)

        prior = F.least(F.lit(0.95), F.greatest(F.lit(0.5), total(good) / (total(good) + total(bad))))
        return F.struct(prior.alias("prior"), rate(good, -1, "bg"), rate(good, 1, "gg"), rate(bad, -1, "bb"),
                        rate(bad, 1, "gb"))

    def step(m: Column, _round: Column) -> Column:
        scored = F.transform("rows", lambda s: F.struct(s["n"], s["v"], posterior(s, m).alias("p")))
        return F.transform(F.array(scored), maximise)[0]  # binds the scored rows once

    m = table.select(F.when(F.size("rows") > 0, F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)), start, step)).otherwise(start).alias("m")).first()["m"]
    return QualityModel(m["prior"], {k: tuple(m[n][i] for n in names) for i, k in enumerate(rules)})


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: its counts, ``base_failed``, ``kept`` and ``quality`` (posterior).

    The counts are written once and used for both learning and judging.
    """
    slim = features(docs.select("doc_id", "text"))
    voted = save(slim.select("doc_id", *COUNTS, "base_failed", *[f"_v_{k}" for k in votes()]), "quality")
    model = learn(vote_patterns(voted))
    judged = voted.select("doc_id", *COUNTS, "base_failed", model.posterior().alias("quality"))
    return judged.select("doc_id", *COUNTS, "base_failed",
                         (~F.col("base_failed") & (F.col("quality") >= KEEP_AT)).alias("kept"), "quality")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, all columns as they were.

    Rows are written once with their votes and judged in place, never joined by id, so
    null or repeated ids cannot mix them up. A plain filter on the votes would not do:
    the optimizer would push it below the projections and so into their lambdas.
    """
    rows = docs.select(F.col("text").alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_in"))
    voted = save(features(rows).select("_in", "base_failed", *[f"_v_{k}" for k in votes()]), "quality-rows")
    model = learn(vote_patterns(voted))
    kept = voted.where(~F.col("base_failed") & (model.posterior() >= KEEP_AT))
    return kept.select(*[F.col(f"_in.`{c}`").alias(c) for c in docs.columns])
