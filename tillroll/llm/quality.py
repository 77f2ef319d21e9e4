"""Quality of documents by rules that vote or abstain.

Each rule says good, bad or nothing about a text. No labels are used: the accuracy of every
rule, on good and on bad texts, and the share of good texts are estimated by
expectation-maximisation over the combinations of votes that occur. Their counts are all
that leaves Spark: a combination is a number below ``3 ** rules``, so the table is bounded by
the rules, whatever the corpus. A document's posterior probability follows from its votes.
Only DataFrame functions touch the texts.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import stored

#: Words of a window that counts as repeated when it is found twice; a power of two.
WINDOW = 8
#: Texts with fewer words, or a larger percentage of repeated words, fail the base rules.
LEAST_WORDS = 20
MOST_REPEATED = 30

# White space between words, and characters that count as symbols.
_SPACES = "\t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_CLOSING = (".", "!", "?", "…", ":", ";", '"', "'", ")", "。", "！", "？", "»", "”")


class Rule(NamedTuple):
    """A measure of a text that speaks for it up to ``good`` and against it from ``bad`` on.

    With ``good`` above ``bad`` the measure is read the other way round. Between the two,
    and where the measure is null, the rule abstains.
    """

    name: str
    measure: str
    good: float
    bad: float

    def vote(self) -> Column:
        """1 for good, 0 for bad, null for neither."""
        x = F.expr(self.measure)
        low, high = (x <= self.good, x >= self.bad)
        if self.good > self.bad:
            low, high = (x >= self.good, x <= self.bad)
        return F.when(low, 1).when(high, 0)


#: Over the columns of :func:`measured`.
RULES = (
    Rule("length", "n_words", 60, 15),
    Rule("word_length", "abs(try_divide(word_chars, n_words) - 5.5)", 1.5, 4.0),
    Rule("symbols", "try_divide(n_symbols, n_words)", 0.03, 0.15),
    Rule("repeated_lines", "if(n_lines > 1, n_dup_lines / n_lines, null)", 0.1, 0.3),
    Rule("repeated_words", "try_divide(n_repeat_words, n_words)", 0.1, 0.3),
    Rule("letters", "try_divide(n_letter_words, n_words)", 0.95, 0.8),
    Rule("sentences", "try_divide(n_closed_lines, n_lines)", 0.7, 0.3),
    Rule("variety", "try_divide(n_distinct_words, least(n_words, 2000))", 0.45, 0.2),
)

#: Shares of right votes that each rule starts with, on good and on bad texts: a bad text need
#: not break most rules. They count as so many votes besides those that are seen.
_START = (0.95, 0.3)
_START_VOTES = 10.0
#: Rules are written for few good texts to break them. Without this bound the commonest defect
#: alone would be taken for the bad texts, and all others for habits of good ones.
_LEAST_ON_GOOD = 0.98
_PRECISION = 1e-10
_MOST_ROUNDS = 100_000


def measured(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ...), a row per row.

    Lines count if they hold a word; a line is a duplicate if an earlier one is equal. Words
    are repeated if they lie in a window that the text has twice or more. Null is empty.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    flat = F.translate(F.col("_text"), _SPACES, " " * len(_SPACES))
    # Arrays that lambdas read by position are named twice in a projection, else the
    # optimizer would put their making into the lambda.
    cut = documents.select(F.col(id_column).alias("id"), text.alias("_text"))
    cut = cut.select(
        "id", "_text",
        F.array_remove(F.split(flat, " "), "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(_SPACES + " ")) != "").alias("_lines"),
    )
    marked = F.array_join(F.filter("_words", lambda x: F.rlike(x, F.lit(f"[{_SYMBOLS}]"))), "")
    cut = cut.select(
        "id",
        "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length(marked) - F.length(F.translate(marked, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_lines", _closed)).cast("long").alias("n_closed_lines"),
        F.size(F.filter("_words", lambda x: F.rlike(x, F.lit(r"\p{L}")))).cast("long").alias("n_letter_words"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct_words"),
        F.transform("_words", lambda x: F.xxhash64(x)).alias("_hashes"),
    )
    # A hash of the window from each word on, by doubling; the last WINDOW - 1 are null. Equal
    # windows have equal hashes, so texts without equal hashes need no closer look; the others
    # compare the windows themselves.
    width = 1
    while width < WINDOW:
        cut = cut.withColumn("_hashes", _doubled(width))
        width *= 2
    doubtful = (F.size("_words") > WINDOW) & (
        F.size("_hashes") - (WINDOW - 1) > F.size(F.array_distinct("_hashes")) - 1
    )
    named = F.transform(
        F.sequence(F.lit(1), F.size("_words") - WINDOW + 1),
        lambda i: F.struct(F.array_join(F.slice("_words", i, WINDOW), " ").alias("w"), i.alias("i")),
    )
    cut = cut.withColumn("_sorted", F.when(doubtful, F.sort_array(named)))

    def repeated(x: Column, i: Column) -> Column:
        before, after = F.get("_sorted", i - 1), F.get("_sorted", i + 1)
        return (x["w"].eqNullSafe(before["w"])) | (x["w"].eqNullSafe(after["w"]))

    starts = F.sort_array(F.transform(F.filter("_sorted", repeated), lambda x: x["i"]))
    cut = cut.withColumn("_starts", F.when(F.col("_sorted").isNotNull(), starts))
    covered = F.transform(
        "_starts",
        lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", i + 1) - x, F.lit(WINDOW))),
    )
    summed = F.aggregate(covered, F.lit(0), lambda a, x: a + x)
    return cut.select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(summed, F.lit(0)).cast("long").alias("n_repeat_words"),
        "n_lines", "n_closed_lines", "n_letter_words", "n_distinct_words",
    )


def _doubled(width: int) -> Column:
    """Hashes of twice ``width`` words from those of ``width`` words."""
    later = F.slice("_hashes", width + 1, F.greatest(F.size("_hashes") - width, F.lit(0)))
    return F.zip_with("_hashes", later, lambda x, y: x.bitwiseXOR(F.shiftleft(y, 7 * width)))


def _closed(line: Column) -> Column:
    """Whether a line ends like a sentence."""
    return F.right(F.rtrim(line, F.lit(_SPACES + " ")), F.lit(1)).isin(*_CLOSING)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )


class Votes(NamedTuple):
    """What expectation-maximisation found: shares, not logarithms."""

    good: float
    right_on_good: list[float]
    right_on_bad: list[float]

    def posterior(self, votes: list[Column]) -> Column:
        """Probability of a good text from the votes of all rules, added in their order."""
        score = F.lit(math.log(self.good) - math.log1p(-self.good))
        for vote, a, b in zip(votes, self.right_on_good, self.right_on_bad):
            score = score + F.when(vote == 1, math.log(a) - math.log1p(-b)).when(
                vote == 0, math.log1p(-a) - math.log(b)
            ).otherwise(0.0)
        return 1 / (1 + F.exp(-score))


def estimate(counts: dict[tuple, int], rules: int) -> Votes:
    """Accuracies of the rules and the share of good texts, by expectation-maximisation.

    ``counts`` has the number of texts by their votes (1, 0 or None for each rule). Rules start
    with ``_START``, and a vote against a text never comes to speak for it, which tells good
    from bad; the starting votes keep accuracies off 0 and 1. Rounds go on until no value moves
    by ``_PRECISION``. Without texts the starting values are returned.
    """
    good, right = 0.5, [[share] * rules for share in _START]
    patterns = sorted(counts, key=repr)
    for _ in range(_MOST_ROUNDS):
        total, many = [1.0, 1.0], 2.0
        hits = [[share * _START_VOTES] * rules for share in _START]
        asked = [[_START_VOTES] * rules for _ in right]
        for votes in patterns:
            n = counts[votes]
            score = math.log(good) - math.log1p(-good)
            for vote, a, b in zip(votes, *right):
                if vote is not None:
                    score += math.log(a) - math.log1p(-b) if vote else math.log1p(-a) - math.log(b)
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, score))))
            many += n
            for k, share in enumerate((p, 1 - p)):
                total[k] += n * share
                for j, vote in enumerate(votes):
                    if vote is not None:
                        asked[k][j] += n * share
                        hits[k][j] += n * share * (vote == 1 - k)
        now = [[h / a for h, a in zip(*both)] for both in zip(hits, asked)]
        now[0] = [max(_LEAST_ON_GOOD, a) for a in now[0]]
        now[1] = [max(1 - a, b) for a, b in zip(*now)]
        moved = max(abs(x - y) for old, new in zip(right, now) for x, y in zip(old, new))
        moved = max(moved, abs(good - total[0] / many))
        good, right = total[0] / many, now
        if moved < _PRECISION:
            break
    return Votes(good, *right)


def quality(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """(id, the measures, base_failed, quality, kept) for every row.

    ``quality`` is the posterior probability of a good text; texts are kept if it is 0.5 or
    more and the base rules hold. Null, empty and blank texts have no words: rules on shares
    abstain and the base rules fail. Repeated rows and rows without an id each get their own
    row. An empty table gives an empty result.
    """
    table = stored(measured(documents, id_column, text_column), "measures")
    names = [f"v{k}" for k in range(len(rules))]
    votes = table.select(*(rule.vote().alias(name) for rule, name in zip(rules, names)))
    # at most 3 ** len(rules) rows
    counts = {tuple(row[:-1]): row[-1] for row in votes.groupBy(*names).count().collect()}
    found = estimate(counts, len(rules))
    judged = table.withColumn("base_failed", base_failed())
    judged = judged.withColumn("quality", found.posterior([rule.vote() for rule in rules]))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
