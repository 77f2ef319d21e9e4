"""Mixing documents to target weights by soft membership in domains.

A classifier fitted on a table of labelled documents gives every document posterior
probabilities of the domains: log odds of hashed words are summed over the text, once all of
them and once those that speak clearly, and a multinomial logistic regression on these sums,
fitted on documents whose words the odds were not counted on, turns them into posteriors.

Document rates r >= 0 are then fitted so that the expected tokens of each domain, the sum of
rate * tokens * posterior, match their targets: least squares over the domains' misses,
sum of (got_k - target_k)^2 / available_k, by projected gradient steps in the metric of the
documents' tokens, r <- max(0, r - sum_k posterior_k * miss_k) with miss_k = (got_k -
target_k) / available_k. In that metric the largest curvature is one, since posteriors sum to
one. Where all targets can be met at once it does not matter how misses are weighed: steps first
weigh them by the inverse Gram matrix of the documents that are not held at a bound, which
takes few steps. Where these come to a stand, steps on the objective itself follow, with
momentum that starts anew when it rises, until it stands still. A step depends on a document's
posteriors alone. These are whole thousandths, so documents of equal posteriors are one row
with the sum of their tokens: at most 501,501 rows for three domains, whatever the corpus.
Each step is one aggregation; only the domains' sums come to the driver. Only DataFrame
functions are used.

With an upper bound on rates the total is free, and rates of zero would meet any shares. There
steps are lazy: they add up in one weight for each domain, and rates are what the bounds leave
of one less a document's posteriors times the weights. Steps are scaled by the Gram matrix of
the documents inside the bounds and halved until the concave dual of the objective rises. The
objective is the misses beside a small weight of the tokens that are left out, so that documents
stay where shares cannot be met otherwise.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import bounded_sample, stored

#: Labelled documents that the classifier is fitted on, at most, chosen by hashes of their ids.
TRAINING_ROWS = 20_000
BUCKETS = 16_384
#: Texts added to those of a domain that have a bucket and to those that would by its size.
SMOOTHING = 3.0
#: Log odds of a bucket that speak clearly.
CLEAR_ODDS = 1.0
#: Weight of the zero that the regression's coefficients are drawn to, in documents.
RIDGE = 0.1
_SHARES = 1000
_MET = 1e-6
_STILL = 1e-6
#: Weight of a left out token beside the misses, where the total is free.
KEEP = 2e-4
_UNITS = 1_000_000
_STEPS_BETWEEN_TABLES = 10
_GROUP_FILES = 8
_TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+"


def _tokens(text_column: str) -> Column:
    """Words and runs of signs of a text; a text without any has none."""
    found = F.regexp_extract_all(F.lower(F.col(text_column)), F.lit(_TOKEN), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def _bucket(token: str) -> Column:
    return F.when(F.col(token).isNotNull(), F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int"))


class Classifier(NamedTuple):
    """Log odds of each bucket by domain, against the first, and the regression on their sums.

    ``coefficients`` has four numbers for each domain but the first: a constant, and the weights
    of the sum of all odds, of the sum of the clear ones, and of how often words repeat.
    """

    odds: list[list[float]]
    coefficients: list[list[float]]


def fit_classifier(
    documents: DataFrame,
    labelled: DataFrame,
    domains: list[str],
    id_column: str = "doc_id",
    text_column: str = "text",
    rows: int = TRAINING_ROWS,
) -> Classifier:
    """The classifier of documents into ``domains`` from their labels.

    ``labelled`` has (id, domain); domains that are not listed and null ones are left out. The
    sample is halved by its ids' hashes. Odds counted on one half give the sums of the other,
    which the regression is fitted on; the odds of the result are those of both halves.
    Without labels all domains are as likely.
    """
    usable = labelled.where(F.col("id").isNotNull() & F.col("domain").isin(domains))
    chosen = bounded_sample(usable, "id", rows)
    # at most TRAINING_ROWS rows of an id and a name
    sample = documents.select(id_column, text_column).join(
        F.broadcast(chosen.select(F.col("id").alias(id_column), "domain")), id_column
    )
    half = F.pmod(F.xxhash64(id_column, F.lit(11)), F.lit(2)).cast("int")
    sample = stored(
        sample.select(F.col(id_column).alias("id"), F.col(text_column).alias("t"), "domain", half.alias("half")),
        "sample",
    )
    # a text counts once in its half, however many copies it has, and so does a word in a text
    texts = sample.select("domain", "half", "t").distinct()
    counted = (
        texts.select("domain", "half", F.explode(F.array_distinct(_tokens("t"))).alias("token"))
        .groupBy("domain", "half", _bucket("token").alias("bucket")).agg(F.count("*").alias("n"))
    )
    counts = [[[0.0] * BUCKETS for _ in domains] for _ in range(2)]
    for row in counted.collect():  # two rows for each domain and bucket at most
        counts[row["half"]][domains.index(row["domain"])][row["bucket"]] = float(row["n"])
    scored = None
    for k in range(2):
        sums = _sums(sample.where(F.col("half") != k), _odds(counts[k]), "id", "t", ["domain"])
        scored = sums if scored is None else scored.unionByName(sums)
    both = [[x + y for x, y in zip(a, b)] for a, b in zip(*counts)]
    return Classifier(_odds(both), _regression(stored(scored, "scored"), domains))


def _odds(counts: list[list[float]]) -> list[list[float]]:
    """Log odds of each bucket by domain against the first, drawn to zero where it is rare."""
    totals, everywhere = [sum(c) for c in counts], [sum(c) for c in zip(*counts)]
    usual = [n / max(1.0, sum(everywhere)) for n in everywhere]
    lifts = [
        [math.log((n + SMOOTHING) / (total * u + SMOOTHING)) for n, u in zip(count, usual)]
        for count, total in zip(counts, totals)
    ]
    return [[x - y for x, y in zip(lift, lifts[0])] for lift in lifts]


def _table(values: list[float]) -> Column:
    """A constant array in millionths, folded once when the query is planned.

    Whole numbers make sums over a text free of the order of its words.
    """
    whole = ",".join(str(round(value * _UNITS)) for value in values)
    return F.split(F.lit(whole), ",").cast("array<bigint>")


def _sums(
    documents: DataFrame, odds: list[list[float]], id_column: str, text_column: str, keep: list[str] = []
) -> DataFrame:
    """(id, n_tokens, d, a1, c1, a2, c2, ...): sums of odds for domains 1, 2, ...

    ``a`` adds the odds of every token, ``c`` those that are clear, ``d`` tells how often words
    repeat. Sums are drawn together by their logarithms: a text twice as long does not speak
    twice as clearly.
    """
    names = [F.col(name) for name in keep]
    whole = documents.select(F.struct(F.col(id_column).alias("id"), *names).alias("_key"), _tokens(text_column).alias("_tokens"))
    # counted in a step of its own, as rows are repeated for each token in the next
    whole = whole.select("_key", F.size(F.array_distinct("_tokens")).alias("_different"), "_tokens")
    words = whole.select("_key", "_different", F.explode_outer("_tokens").alias("_token"))
    words = words.select("_key", "_different", _bucket("_token").alias("bucket"))
    sums = []
    for k in range(1, len(odds)):
        clear = [x if abs(x) >= CLEAR_ODDS else 0.0 for x in odds[k]]
        sums += [F.sum(F.get(_table(x), F.col("bucket"))).alias(f"{n}{k}") for n, x in (("a", odds[k]), ("c", clear))]
    summed = words.groupBy("_key").agg(
        F.count("bucket").alias("n_tokens"), F.max("_different").alias("_different"), *sums
    )
    drawn = [F.log((F.col("n_tokens") + 1) / (F.col("_different") + 1)).alias("d")]
    for k in range(1, len(odds)):
        for name in (f"a{k}", f"c{k}"):
            x = F.coalesce(F.col(name) / _UNITS, F.lit(0.0))
            drawn.append((F.signum(x) * F.log1p(F.abs(x))).alias(name))
    return summed.select("_key.id", "n_tokens", *drawn, *(f"_key.{name}" for name in keep))


def _logits(coefficients: list[list[float]]) -> list[Column]:
    return [
        sum((F.lit(b) * x for b, x in zip(own[1:], _inputs(k)[1:])), F.lit(own[0]))
        for k, own in enumerate(coefficients, 1)
    ]


def _inputs(k: int) -> list[Column]:
    return [F.lit(1.0), F.col(f"a{k}"), F.col(f"c{k}"), F.col("d")]


def _softmax(logits: list[Column]) -> list[Column]:
    """Posteriors from logits against the first domain, whose own is zero."""
    top = F.greatest(F.lit(0.0), F.lit(0.0), *logits)
    parts = [F.exp(-top), *(F.exp(z - top) for z in logits)]
    return [part / sum(parts[1:], parts[0]) for part in parts]


def _regression(scored: DataFrame, domains: list[str]) -> list[list[float]]:
    """Coefficients of a multinomial logistic regression of ``domain`` on the sums of odds.

    Newton's method, one aggregation a step; a step is halved until it lowers the loss.
    """
    many = len(domains) - 1

    def measured(coefficients):
        table = scored
        for k, p in enumerate(_softmax(_logits(coefficients))):
            table = table.withColumn(f"p{k}", p)
        own = [(F.col("domain") == d).cast("double") for d in domains]
        inputs = [_inputs(k) for k in range(1, many + 1)]
        likely = sum((F.when(o == 1, F.col(f"p{k}")).otherwise(0.0) for k, o in enumerate(own)), F.lit(0.0))
        wanted = [F.sum(-F.log(F.greatest(likely, F.lit(1e-300))))]
        wanted += [F.sum((F.col(f"p{k + 1}") - own[k + 1]) * x) for k in range(many) for x in inputs[k]]
        for i in range(4 * many):
            for j in range(i, 4 * many):
                (k, x), (m, y) = divmod(i, 4), divmod(j, 4)
                pair = F.col(f"p{k + 1}") * (float(k == m) - F.col(f"p{m + 1}"))
                wanted.append(F.sum(pair * inputs[k][x] * inputs[m][y]))
        found = [x or 0.0 for x in table.agg(*(w.alias(f"w{n}") for n, w in enumerate(wanted))).first()]
        flat = [b for row in coefficients for b in row]
        loss = found[0] + RIDGE / 2 * sum(b * b for b in flat)
        slope = [g + RIDGE * b for g, b in zip(found[1:], flat)]
        rest = iter(found[1 + len(flat) :])
        curve = [[0.0] * len(flat) for _ in flat]
        for i in range(len(flat)):
            for j in range(i, len(flat)):
                curve[i][j] = curve[j][i] = next(rest) + RIDGE * (i == j)
        return loss, slope, curve

    at = [[0.0] * 4 for _ in range(many)]
    loss, slope, curve = measured(at)
    while max(map(abs, slope), default=0.0) > 1e-6 * (1 + loss):
        step, share = _solved(curve, slope), 1.0
        while True:
            flat = iter(step)
            tried = [[b - share * next(flat) for b in row] for row in at]
            found = measured(tried)
            if found[0] < loss:
                break
            share /= 2
            if share < 1e-6:  # as low as numbers of this size can say
                return at
        still = loss - found[0] < 1e-12 * loss
        at, (loss, slope, curve) = tried, found
        if still:
            break
    return at


def _solved(matrix: list[list[float]], values: list[float]) -> list[float]:
    """The solution of a small positive definite system, by elimination."""
    rows = [[*row, v] for row, v in zip(matrix, values)]
    for k in range(len(rows)):
        best = max(range(k, len(rows)), key=lambda i: abs(rows[i][k]))
        rows[k], rows[best] = rows[best], rows[k]
        for i in range(len(rows)):
            if i != k:
                share = rows[i][k] / rows[k][k]
                rows[i] = [x - share * y for x, y in zip(rows[i], rows[k])]
    return [row[-1] / row[k] for k, row in enumerate(rows)]


def members(
    documents: DataFrame,
    model: Classifier,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, n_tokens, q0, q1, ...): a document's tokens and posteriors in whole thousandths.

    What rounding leaves over of the thousand goes to the first domain.
    """
    found = _sums(documents, model.odds, id_column, text_column)
    shares = [F.floor(p * _SHARES).cast("int") for p in _softmax(_logits(model.coefficients))[1:]]
    rest = sum(shares, F.lit(0))
    return found.select(
        "id", "n_tokens", (F.lit(_SHARES) - rest).alias("q0"), *(q.alias(f"q{k}") for k, q in enumerate(shares, 1))
    )


def rates(
    documents: DataFrame,
    labelled: DataFrame,
    targets: Mapping[str, float],
    id_column: str = "doc_id",
    text_column: str = "text",
    total_tokens: float | None = None,
    largest: float | None = None,
) -> DataFrame:
    """(id, n_tokens, p_<domain> ..., rate, share_<domain> ...): how often to take each document.

    ``targets`` are the domains' shares of ``total_tokens``; without it the total is what
    leaves the domain with the largest share as it is. With ``largest`` rates are no larger, and
    the total is free: only the shares are fitted, from rates of one on, so that with 1 documents
    are left out but never repeated; a left out token weighs ``KEEP`` beside the misses. ``share_<domain>`` is what the rates make of the domain's
    share, the same in all rows: it tells how near targets that cannot be met have come.

    Null, empty and blank texts have no tokens and the posteriors of texts without evidence.
    Rows that share an id, null among them, are one document. A domain that no document
    belongs to is missed without effect on the others. An empty table gives an empty result.
    """
    domains = list(targets)
    model = fit_classifier(documents, labelled, domains, id_column, text_column)
    table = stored(members(documents, model, id_column, text_column), "members")
    q = [f"q{k}" for k in range(len(domains))]
    # few rows that are read in every step: few files
    groups = table.groupBy(*q).agg(F.sum("n_tokens").alias("n")).coalesce(_GROUP_FILES)
    groups = stored(groups, "groups")
    shares = [targets[d] / sum(targets.values()) for d in domains]
    rated, got = _fitted(groups, shares, total_tokens, largest)
    all_tokens = sum(got) or 1.0
    # as many rows as there are posteriors, at most 501,501 for three domains
    return table.join(rated, q).select(
        "id", "n_tokens", *((F.col(x) / _SHARES).alias(f"p_{d}") for x, d in zip(q, domains)), "rate",
        *(F.lit(x / all_tokens).alias(f"share_{d}") for x, d in zip(got, domains)),
    )


def _fitted(
    groups: DataFrame, shares: list[float], total_tokens: float | None, largest: float | None
) -> tuple[DataFrame, list[float]]:
    """The groups (q0, q1, ..., n) with their rates, and the domains' expected tokens.

    With a free total a document's part in a domain's miss is its posterior less the target
    share.
    """
    many, n, rate = len(shares), F.col("n"), F.col("rate")
    p = [F.col(f"q{k}") / _SHARES for k in range(many)]
    first = groups.agg(*(F.sum(n * x) for x in p)).first()
    available = [x or 0.0 for x in first]
    if largest is None:
        lead = max(range(many), key=lambda k: shares[k])
        wanted = [s * (total_tokens or available[lead] / shares[lead]) for s in shares]
        scale = sum((s * sum(available)) ** 2 / a for s, a in zip(shares, available) if a)

        def objective(tokens):
            return sum((t - w) ** 2 / a for t, w, a in zip(tokens, wanted, available) if a)

        table = groups.withColumn("rate", F.lit(1.0))
        table, met = _leapt(table, p, wanted, available, scale, objective)
        if not met:
            table = _descended(table, p, wanted, available, scale, objective)
    else:
        # a domain without documents leaves the others' shares to each other
        known = sum(s for s, a in zip(shares, available) if a) or 1.0
        part = [x - s / known if a else F.lit(0.0) for x, s, a in zip(p, shares, available)]
        weights = _weights(groups, part, available, largest)
        table = groups.withColumn("rate", _clipped(1 - _along(part, weights), largest))
    back = table.agg(*(F.sum(rate * n * x) for x in p)).first()
    return stored(table.select(*groups.drop("n").columns, "rate"), "rates"), [x or 0.0 for x in back]


def _expected(table: DataFrame, part: list[Column]) -> list[float]:
    return [x or 0.0 for x in table.agg(*(F.sum(F.col("rate") * F.col("n") * x) for x in part)).first()]


def _weights(groups: DataFrame, part: list[Column], available: list[float], largest: float) -> list[float]:
    """A weight for each domain, so that clipped rates of one less ``part`` times the weights
    make misses and left out tokens least; one aggregation of constant size a step."""
    many, n, every = len(part), F.col("n"), sum(available)
    if not every:
        return [0.0] * many
    sizes = [max(a, 1e-9 * every) * KEEP for a in available]

    def measured(weights):
        moved = 1 - _along(part, weights)
        rate = _clipped(moved, largest)
        inside = F.when((moved >= 0) & (moved <= largest), n).otherwise(0.0)
        sums = [F.sum(n * rate * x) for x in part] + [F.sum(n * (rate - 1) ** 2)]
        sums += [F.sum(inside * part[k] * part[m]) for k in range(many) for m in range(many)]
        found = list(groups.agg(*(x.alias(f"s{k}") for k, x in enumerate(sums))).first())
        got, left, flat = found[:many], found[many], found[many + 1 :]
        height = left / 2 + sum(w * g - s * w * w / 2 for w, g, s in zip(weights, got, sizes))
        slope = [g - s * w for g, s, w in zip(got, sizes, weights)]
        curve = [[flat[many * k + m] + sizes[k] * (k == m) for m in range(many)] for k in range(many)]
        return height, slope, curve

    weights = [0.0] * many
    height, slope, curve = measured(weights)
    while sum(x * x / s for x, s in zip(slope, sizes)) * KEEP > _MET**2 * every:
        step, share = _solved(curve, slope), 1.0
        rise = sum(x * y for x, y in zip(slope, step))
        while True:
            tried = [w + share * x for w, x in zip(weights, step)]
            found = measured(tried)
            if found[0] > height + 1e-4 * share * rise:
                break
            share /= 2
            if share < 1e-9:  # as high as numbers of this size can say
                return weights
        weights, (height, slope, curve) = tried, found
    return weights


def _clipped(rate: Column, largest: float | None = None) -> Column:
    rate = F.greatest(F.lit(0.0), rate)
    return rate if largest is None else F.least(F.lit(float(largest)), rate)


def _along(part: list[Column], weights: list[float]) -> Column:
    return sum((x * w for x, w in zip(part[1:], weights[1:])), part[0] * weights[0])


def _leapt(table, part, wanted, available, scale, objective) -> tuple[DataFrame, bool]:
    """The table after projected steps that are scaled for the rates that can move.

    The misses are weighed by the inverse Gram matrix of the documents whose rates are not
    held by a bound, so that a step which meets no bound meets all targets. A step is halved
    until it lowers the objective; false is returned where none does.
    """
    many, n, rate = len(wanted), F.col("n"), F.col("rate")
    got, step = _expected(table, part), 0
    while objective(got) > _MET**2 * scale:
        miss = [g - w for g, w in zip(got, wanted)]
        slope = _along(part, [m / a if a else 0.0 for m, a in zip(miss, available)])
        free = F.when((rate <= 0) & (slope > 0), 0.0).otherwise(n)
        sums = table.agg(*(F.sum(free * part[k] * part[m]) for k in range(many) for m in range(many))).first()
        flat = [x or 0.0 for x in sums]
        small = 1e-9 * (sum(flat[:: many + 1]) or 1.0)
        gram = [[flat[many * k + m] + small * (k == m) for m in range(many)] for k in range(many)]
        weights, share = _solved(gram, miss), 1.0
        while True:
            tried = table.withColumn("rate", _clipped(rate - _along(part, [share * w for w in weights])))
            tokens = _expected(tried, part)
            if objective(tokens) < (1 - share / 100) * objective(got):
                break
            share /= 2
            if share < 1e-3:
                return table, False
        got, step = tokens, step + 1
        table = stored(tried, "rates") if step % _STEPS_BETWEEN_TABLES == 0 else tried
    return table, True


def _descended(table, part, wanted, available, scale, objective) -> DataFrame:
    """The table after accelerated projected gradient steps on the objective itself.

    Its largest curvature in the metric of the tokens is one. Momentum starts anew when the
    objective rises; steps end when targets are met or it stands still.
    """
    rate, names = F.col("rate"), [name for name in table.columns if name != "rate"]
    table = stored(table, "rates").withColumn("before", rate)
    got = _expected(table, part)
    last, history, speed, step = got, [objective(got)], 1.0, 0
    while history[-1] > _MET**2 * scale:
        faster = (1 + math.sqrt(1 + 4 * speed * speed)) / 2
        push, speed = (speed - 1) / faster, faster
        ahead = [x + push * (x - y) for x, y in zip(got, last)]
        miss = [(x - w) / a if a else 0.0 for x, w, a in zip(ahead, wanted, available)]
        moved = _clipped(rate + push * (rate - F.col("before")) - _along(part, miss))
        tried = table.select(*names, moved.alias("rate"), rate.alias("before"))
        step += 1
        if step % _STEPS_BETWEEN_TABLES == 0:
            tried = stored(tried, "rates")
        tokens = _expected(tried, part)
        if objective(tokens) > history[-1] and push > 0:
            speed = 1.0  # the same step without momentum
            continue
        table, last, got = tried, got, tokens
        history.append(objective(got))
        if len(history) > 10 and history[-11] - history[-1] <= _STILL * history[-1]:
            break
    return table.drop("before")


def copies(rate: Column, id_column: Column, seed: int = 5) -> Column:
    """A whole number of copies with the rate as its mean over ids: by the id's hash."""
    part = F.pmod(F.xxhash64(id_column, F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    return F.floor(rate + part).cast("int")


def mixed(
    documents: DataFrame,
    labelled: DataFrame,
    targets: Mapping[str, float],
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The documents, with all their columns, left out as their rates of at most one say."""
    found = rates(documents, labelled, targets, id_column, text_column, largest=1.0)
    taken = found.select(F.col("id").alias("_id"), copies(F.col("rate"), F.col("id")).alias("_n"))
    whole = documents.select(F.struct("*").alias("_row"), F.col(id_column).alias("_key"))
    joined = whole.join(taken.where("_n > 0"), F.col("_key").eqNullSafe(F.col("_id")))
    repeated = joined.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    return repeated.select("_row.*")


def label_domains(labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id, domain) of a table with quality and toxic marks: toxic, low, clean or null."""
    domain = (
        F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low")
        .when((F.col("quality") == 1) & (F.col("toxic") == 0), "clean")
    )
    return labels.select(F.col(id_column).alias("id"), domain.alias("domain"))


#: Shares of a corpus that is mostly clean.
TARGETS = {"clean": 0.93, "low": 0.04, "toxic": 0.03}
