"""Quality rules by weak supervision.

Every rule votes good, votes bad or abstains. A two-class model holds, for each rule and class,
the chance of each of its three answers; expectation-maximisation estimates these and the share
of good documents from the votes alone. The classes are anchored, since votes alone do not say which
minority is the bad one, or whether there is one: to each class the estimate adds pseudo-documents
that vote as rules are meant to, a share of the corpus, so that copies do not outweigh them; a good
vote never speaks for bad nor a bad one for good; and without a bad vote abstentions do not speak for
bad. A document is kept by its posterior probability.

All of it is DataFrame functions. The corpus enters the estimate through the counts of vote
patterns: at most 3 ** rules rows, whatever the number of documents, so the iterations run over
that table on the driver. The fitted model is a weighted sum of votes, evaluated in the scan."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import land

WS = r"[\x20\x09-\x0D]+"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Frequent function words of the corpus languages (en, fr, de, es).
FUNCTION_WORDS = (
    "a an and are as at be by for from in is it of on that the this to was with "
    "au avec dans de des du elle en est et la le les par pas pour que qui sur un une "
    "als auf das dem den der die ein eine für im in ist mit nicht sich und von zu "
    "al como con del el es lo los las más no para por se su una y").split()

_FUNCTION_FORMS = sorted({form for w in FUNCTION_WORDS
                          for form in (w, w.capitalize(), w + ",", w + ".")})

GOOD, BAD, ABSTAIN = 1, -1, 0

# The pseudo-documents of a class as a share of the corpus, and their answers.
ANCHOR_SHARE = 0.01
ANCHOR = {GOOD: (0.85, 0.2), BAD: (0.05, 0.6), ABSTAIN: (0.1, 0.2)}  # given good, given bad


def features(text: Column | str = "text") -> dict[str, Column]:
    """The first set of feature columns, from the text alone."""
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    edge, end = r"(?<![^\x20\x09-\x0D])", r"(?![^\x20\x09-\x0D])"
    return {
        "word_chars": (F.length(t) - F.regexp_count(t, F.lit(r"[\x20\x09-\x0D]"))).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_plain": F.regexp_count(t, F.lit(edge + r"\p{L}[\p{Ll}'’-]*+[.,;:?!]?" + end)).cast("long"),
        "n_upper": F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long"),
        "_words": F.array_remove(F.split(t, WS), ""),
    }


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_plain,
    n_function and n_upper; a null or empty text has zeros. Columns of these names are replaced."""
    words, n = F.col("_words"), F.size("_words")
    out = docs.withColumns(features(text)).withColumns({
        "n_words": n.cast("long"),
        "n_function": F.size(F.filter(words, lambda w: w.isin(_FUNCTION_FORMS))).cast("long"),
        # the 3-word windows by 64-bit hash; null for fewer than two
        "_h": F.when(n >= 4, F.transform(
            F.sequence(F.lit(0), F.greatest(n, F.lit(3)) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))})
    # only where a hash repeats: in hash order with their positions, equal windows are
    # neighbours; their positions go back into text order
    out = out.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    out = out.withColumn("_twice", F.expr("""
        array_sort(transform(filter(_sorted, (x, k) ->
            (k > 0 AND x.h = get(_sorted, k - 1).h) OR x.h <=> get(_sorted, k + 1).h),
            x -> x.i))""")).drop("_words", "_sorted", "_h")
    # a window adds the words after the one before it: 3 at most
    covered = F.expr("""
        aggregate(transform(_twice, (x, k) ->
            least(3, x - coalesce(get(_twice, k - 1), -3))), 0L, (s, x) -> s + x)""")
    return out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_twice")


FEATURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_plain", "n_function", "n_upper"]


@dataclass(frozen=True)
class Rule:
    name: str
    good: Column | None  # votes good where true
    bad: Column | None   # votes bad where true (first)


def default_rules() -> list[Rule]:
    c, words = F.col, F.greatest(F.col("n_words"), F.lit(1))
    share = lambda name: c(name) / words
    length = c("word_chars") / words
    return [
        Rule("function_words", share("n_function") >= 0.08, share("n_function") <= 0.02),
        Rule("plain_words", share("n_plain") >= 0.85, share("n_plain") <= 0.65),
        Rule("symbols", share("n_symbols") <= 0.05, share("n_symbols") >= 0.25),
        Rule("upper_case", c("n_upper") <= 0.15 * c("word_chars"), c("n_upper") >= 0.4 * c("word_chars")),
        Rule("word_length", length.between(3.5, 9.0), (length < 2.5) | (length > 15.0)),
        Rule("repetition", share("n_repeat_words") <= 0.1, share("n_repeat_words") >= 0.3),
        Rule("lines", None, (c("n_lines") >= 2) & (c("n_dup_lines") >= 0.3 * c("n_lines"))),
    ]


def vote(rule: Rule) -> Column:
    out = F.lit(ABSTAIN)
    if rule.good is not None:
        out = F.when(rule.good, GOOD).otherwise(out)
    if rule.bad is not None:
        out = F.when(rule.bad, BAD).otherwise(out)
    return F.coalesce(out, F.lit(ABSTAIN))


@dataclass(frozen=True)
class Model:
    prior: float                      # share of good documents
    chance: list[dict[int, tuple]]    # per rule: answer -> (given good, given bad)

    def accuracy(self) -> list[float]:
        """Per rule, the chance that its vote is right where it votes."""
        out = []
        for c in self.chance:
            right = self.prior * c[GOOD][0] + (1 - self.prior) * c[BAD][1]
            wrong = self.prior * c[BAD][0] + (1 - self.prior) * c[GOOD][1]
            out.append(right / (right + wrong))
        return out

    def log_odds(self, answer: int, rule: int) -> float:
        """What an answer adds to the log odds of good, with a vote's sign where it votes."""
        good, bad = self.chance[rule][answer]
        z = math.log(good) - math.log(bad)
        return max(z, 0.0) if answer == GOOD else min(z, 0.0) if answer == BAD else z

    def odds(self, votes: tuple[int, ...]) -> float:
        """The log odds of good of a pattern; at least even, and raised by each good vote, where
        no rule votes bad."""
        least = -math.inf if BAD in votes else 0.0
        return max(math.log(self.prior) - math.log(1 - self.prior), least) + sum(
            max(self.log_odds(a, j), least) if a == ABSTAIN else self.log_odds(a, j)
            for j, a in enumerate(votes))

    def posterior(self, votes: list[Column]) -> Column:
        none_bad = ~F.greatest(*[(v == BAD).cast("int") for v in votes]).cast("boolean") \
            if len(votes) > 1 else votes[0] != BAD
        prior = math.log(self.prior) - math.log(1 - self.prior)

        def floored(z: float) -> Column:
            return F.when(none_bad, max(z, 0.0)).otherwise(z) if z < 0 else F.lit(z)

        z = floored(prior)
        for j, v in enumerate(votes):
            z = z + F.when(v == GOOD, self.log_odds(GOOD, j)) \
                .when(v == BAD, self.log_odds(BAD, j)).otherwise(floored(self.log_odds(ABSTAIN, j)))
        return 1.0 / (1.0 + F.exp(-z))


def fit(patterns: list[tuple[tuple[int, ...], int]], k: int, iterations: int = 200,
        tolerance: float = 1e-9) -> Model:
    """Expectation-maximisation over (votes, count) pairs, from the majority of votes. The
    pseudo-documents of ANCHOR, and one per answer, keep every chance above zero. Without
    documents the model keeps everything."""
    total = sum(n for _, n in patterns)
    if not total:
        return Model(0.999, [{GOOD: (0.5, 0.5), BAD: (0.5, 0.5), ABSTAIN: (0.5, 0.5)}] * k)
    # the start: a good vote counts 1, a bad one 2, since most rules answer good by default
    post = [1 / (1 + math.exp(-(sum(1 if v == GOOD else -2 if v == BAD else 0 for v in p))))
            for p, _ in patterns]
    before, extra = None, ANCHOR_SHARE * total
    for _ in range(iterations):
        good = sum(q * n for q, (_, n) in zip(post, patterns, strict=True))
        prior = (good + 1) / (total + 2)
        chance = []
        for j in range(k):
            table = {}
            for a in (GOOD, BAD, ABSTAIN):
                g = sum(q * n for q, (p, n) in zip(post, patterns, strict=True) if p[j] == a)
                b = sum((1 - q) * n for q, (p, n) in zip(post, patterns, strict=True) if p[j] == a)
                table[a] = ((g + extra * ANCHOR[a][0] + 1) / (good + extra + 3),
                            (b + extra * ANCHOR[a][1] + 1) / (total - good + extra + 3))
            chance.append(table)
        model = Model(prior, chance)
        odds = [model.odds(p) for p, _ in patterns]
        post = [1 / (1 + math.exp(-max(-500.0, min(500.0, z)))) for z in odds]
        likelihood = sum(n * max(z, 0) + n * math.log1p(math.exp(-abs(z)))
                         for z, (_, n) in zip(odds, patterns, strict=True)) / total
        if before is not None and abs(likelihood - before) < tolerance:
            break
        before = likelihood
    return model


def quality(docs: DataFrame, rules: list[Rule] | None = None, threshold: float = 0.5,
            text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs` (all by default) with the features, `posterior`, base_failed
    and kept. A null text has no words and fails the base rules; repeated rows get equal
    verdicts; an empty table stays empty; columns with the names of the result's are replaced.

    The texts are read once: the features are landed with the kept columns, and both the counts
    of vote patterns and the verdicts come from that table."""
    rules = rules or default_rules()
    featured = with_features(docs, text)
    keep = docs.columns if keep is None else keep
    featured = land(featured.select(*[c for c in keep if c not in FEATURES], *FEATURES), "quality")
    votes = [vote(r) for r in rules]
    names = [f"_vote_{j}" for j in range(len(rules))]
    counted = (featured.where(F.col("n_words") > 0)
               .groupBy(*[v.alias(n) for v, n in zip(votes, names, strict=True)]).count())
    # at most 3 ** len(rules) rows
    patterns = [(tuple(r[n] for n in names), r["count"]) for r in counted.collect()]
    model = fit(sorted(patterns), len(rules))
    return (featured
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
            .withColumn("posterior", model.posterior(votes))
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)))
