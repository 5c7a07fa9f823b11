"""Soft-membership mixing: document rates that give each domain its share of tokens.

A naive Bayes classifier over hashed words, fitted to the labels table, gives
each document posterior memberships in the domains.  Projected-gradient least
squares then finds nonnegative rates (expected copies of a document) whose
expected tokens per domain meet the targets, starting from one copy of each,
with momentum for targets that drive many rates to zero.  Residuals are weighted by the inverse of the domains' Gram matrix, in which the
problem is perfectly scaled: without active bounds, one step solves it.  The
driver sees one number per domain, or pair of domains, and step.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle

#: Labelled rows that the classifier is fitted to, at most.
LABELLED = 20_000
#: Hashed places for words, and pseudo-counts of each.
BUCKETS = 4_096
SMOOTHING = 1.0
#: Weight of the mean log-likelihood of a word: a document counts as so many independent words.
EVIDENCE_WORDS = 60.0

STEPS = 48
#: Largest miss of a target, as a part of all targets' tokens, at which the rates are as wanted.
TOLERANCE = 1e-4
#: Where targets cannot be met, totals that move by less than this in each of so many steps have come to rest.
REST, REST_STEPS = 1e-5, 3
#: Steps after which the rates so far are written.
STRIDE = 8


@dataclass(frozen=True)
class Domain:
    """A combination of labels; its target is a fixed ``share`` of all tokens, or else its own tokens times ``weight``."""

    name: str
    quality: int
    toxic: int
    weight: float = 1.0
    share: float | None = None


@dataclass(frozen=True)
class Solution:
    """Rates of documents, and how near they come: tokens wanted and reached of each domain."""

    rates: DataFrame
    domains: tuple[Domain, ...]
    targets: tuple[float, ...]
    reached: tuple[float, ...]
    steps: int
    #: Targets are met, or the totals rest as near to them as they get.
    converged: bool

    @property
    def met(self) -> bool:
        return max(abs(r - t) for r, t in zip(self.reached, self.targets)) <= TOLERANCE * max(sum(self.targets), 1e-300)

    def report(self) -> DataFrame:
        """One row per domain: target and reached tokens, and whether the search came to rest."""
        rows = [(d.name, t, r, self.converged) for d, t, r in zip(self.domains, self.targets, self.reached)]
        return self.rates.sparkSession.createDataFrame(rows, "domain string, target_tokens double, reached_tokens double, converged boolean")


class NotConverged(RuntimeError):
    """The rates still moved after ``STEPS`` steps."""


#: Domains by label, and how much each shall weigh for each token it has.  Weights are relative to
#: the corpus: fixed shares would repeat a domain without limit where little of it is left.
DOMAINS = (
    Domain("good", 1, 0, 1.0), Domain("good_toxic", 1, 1, 0.8), Domain("low", 0, 0, 0.8), Domain("low_toxic", 0, 1, 0.7),
)
#: Tokens of the mix for each token given.
BUDGET = 1.05


def _total(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def _words(docs: DataFrame, key: str, text: str, *others: str) -> DataFrame:
    """One row per word: id and hashed place."""
    parts = F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+")
    exploded = docs.select(F.col(key).alias("doc_id"), *others, F.explode(parts).alias("word")).where("word <> ''")
    return exploded.select("doc_id", *others, F.expr(f"cast(pmod(xxhash64(lower(word)), {BUCKETS}) as int)").alias("bucket"))


def classifier(docs: DataFrame, labels: DataFrame, domains: Sequence[Domain], key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per hashed place: its log-likelihood in each domain (w0, w1, ...) and the log-priors (c0, c1, ...)."""
    which = F.coalesce(*(F.when((F.col("quality") == d.quality) & (F.col("toxic") == d.toxic), F.lit(i)) for i, d in enumerate(domains)))
    known = labels.select(F.col("doc_id").alias("doc_id"), which.alias("domain")).where("domain IS NOT NULL AND doc_id IS NOT NULL")
    sample = settle(known.groupBy("doc_id").agg(F.min("domain").alias("domain")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED), "labelled")
    # The sample has LABELLED rows of two numbers at most, so it can go to every task.
    texts = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    chosen = texts.join(F.broadcast(sample), "doc_id")
    counts = _words(chosen, "doc_id", "text", "domain").groupBy("bucket").agg(
        *(F.sum((F.col("domain") == i).cast("double")).alias(f"n{i}") for i in range(len(domains))))
    places = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    filled = settle(places.join(counts, "bucket", "left").na.fill(0.0), "word-counts")
    seen = filled.agg(*(F.sum(f"n{i}").alias(f"t{i}") for i in range(len(domains)))).first()
    of = sample.agg(*(F.sum((F.col("domain") == i).cast("double")).alias(f"d{i}") for i in range(len(domains)))).first()
    rows = [of[f"d{i}"] or 0.0 for i in range(len(domains))]
    return filled.select(
        "bucket",
        *(F.log((F.col(f"n{i}") + SMOOTHING) / (seen[f"t{i}"] + SMOOTHING * BUCKETS)).alias(f"w{i}") for i in range(len(domains))),
        *(F.log(F.lit((n + 1) / (sum(rows) + len(domains)))).alias(f"c{i}") for i, n in enumerate(rows)),
    )


def memberships(docs: DataFrame, labels: DataFrame, domains: Sequence[Domain] = DOMAINS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, tokens (words) and the posterior of each domain (p0, p1, ...) for every document.

    Texts without a word get the priors.  Words are added up per document where
    they are read, so one row per document and task is shuffled.
    """
    places = settle(classifier(docs, labels, domains, key, text), "classifier")
    numbers = range(len(domains))
    # BUCKETS rows, whatever the input.
    scored = _words(docs, key, text).join(F.broadcast(places.select("bucket", *(f"w{i}" for i in numbers))), "bucket")
    sums = scored.groupBy("doc_id").agg(F.count("*").alias("tokens"), *(F.sum(f"w{i}").alias(f"s{i}") for i in numbers))
    every = docs.select(F.col(key).alias("doc_id")).distinct()
    priors = places.where("bucket = 0").first()
    same = F.col("e.doc_id").eqNullSafe(F.col("s.doc_id"))
    joined = every.alias("e").join(settle(sums, "word-scores").alias("s"), same, "left").select(
        "e.doc_id", F.coalesce("tokens", F.lit(0)).alias("tokens"),
        *((F.lit(priors[f"c{i}"]) + EVIDENCE_WORDS * F.coalesce(F.col(f"s{i}") / F.col("tokens"), F.lit(0.0))).alias(f"l{i}") for i in numbers))
    top = F.greatest(*(F.col(f"l{i}") for i in numbers))
    raised = joined.select("doc_id", "tokens", *(F.exp(F.col(f"l{i}") - top).alias(f"e{i}") for i in numbers))
    return raised.select("doc_id", "tokens", *((F.col(f"e{i}") / _total([F.col(f"e{j}") for j in numbers])).alias(f"p{i}") for i in numbers))


def solve(matrix: list[list[float]], right: list[float]) -> list[float]:
    """Solution of a small symmetric system by elimination with pivots; directions without weight get zero."""
    n = len(right)
    rows = [[*matrix[i], right[i]] for i in range(n)]
    least = 1e-12 * max([abs(v) for row in matrix for v in row] + [1e-300])
    for i in range(n):
        pivot = max(range(i, n), key=lambda r: abs(rows[r][i]))
        rows[i], rows[pivot] = rows[pivot], rows[i]
        if abs(rows[i][i]) <= least:
            rows[i] = [0.0] * (n + 1)
            rows[i][i] = 1.0
            continue
        for r in range(n):
            if r != i:
                factor = rows[r][i] / rows[i][i]
                rows[r] = [a - factor * b for a, b in zip(rows[r], rows[i])]
    return [rows[i][n] / rows[i][i] for i in range(n)]


def _targets(domains: Sequence[Domain], held: Sequence[float], whole: float) -> list[float]:
    """Tokens wanted of each domain, ``whole`` in all: fixed shares, and what they leave in proportion to weighed tokens."""
    shares = [d.share for d in domains]
    fixed = sum(s for s in shares if s is not None)
    if fixed > 1 + 1e-9 or any(s is not None and s < 0 for s in shares):
        raise ValueError("shares must be nonnegative and add up to one at most")
    if all(s is not None for s in shares) and abs(fixed - 1) > 1e-9:
        raise ValueError("shares of all domains must add up to one")
    weighed = [d.weight * h if d.share is None else 0.0 for d, h in zip(domains, held)]
    rest = max(0.0, 1 - fixed) * whole
    return [whole * d.share if d.share is not None else rest * w / max(sum(weighed), 1e-300) for d, w in zip(domains, weighed)]


def solution(members: DataFrame, domains: Sequence[Domain] = DOMAINS, budget: float = BUDGET, most_copies: float | None = None) -> Solution:
    """``members`` with the ``rate`` of each document, by targets that add up to ``budget`` times all tokens.

    Rates lie between zero and ``most_copies`` (no bound if None); targets that
    no such rates can meet are met as nearly as the weighted least squares
    allow, and ``reached`` tells how nearly.
    """
    numbers = range(len(domains))
    held = [F.col("tokens") * F.col(f"p{i}") for i in numbers]
    sums = members.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("all"),
        *(F.coalesce(F.sum(held[i]), F.lit(0.0)).alias(f"h{i}") for i in numbers),
        *(F.coalesce(F.sum(held[i] * held[j]), F.lit(0.0)).alias(f"g{i}_{j}") for i in numbers for j in numbers if j <= i),
    ).first()
    gram = [[sums[f"g{max(i, j)}_{min(i, j)}"] for j in numbers] for i in numbers]
    targets = _targets(domains, [sums[f"h{i}"] for i in numbers], budget * sums["all"])
    scale = max(sum(targets), 1e-300)
    current, pending, before, converged = members.withColumns({"rate": F.lit(1.0), "last_rate": F.lit(1.0)}), [], None, False
    resting = 0
    for step in range(STEPS + 1):
        moved = _after(current, pending, held, most_copies)
        sums = moved.agg(*(F.coalesce(F.sum(held[i] * F.col("rate")), F.lit(0.0)).alias(f"t{i}") for i in numbers)).first()
        reached = [sums[f"t{i}"] for i in numbers]
        near = max(abs(r - t) for r, t in zip(reached, targets)) <= TOLERANCE * scale
        rests = before is not None and max(abs(r - b) for r, b in zip(reached, before)) <= REST * scale
        resting = resting + 1 if rests else 0
        converged = near or resting >= REST_STEPS
        if converged or step == STEPS:
            break
        # The gradient is taken ahead of the rates, by the momentum; totals are linear in the rates.
        momentum = step / (step + 3)
        ahead = [r + momentum * (r - b) for r, b in zip(reached, before or reached)]
        pending.append([momentum, *solve(gram, [a - t for a, t in zip(ahead, targets)])])
        before = reached
        if len(pending) == STRIDE:
            current, pending = settle(_after(current, pending, held, most_copies), "rates"), []
    final = _after(current, pending, held, most_copies).drop("last_rate")
    return Solution(final, tuple(domains), tuple(targets), tuple(reached), step, converged)


def rates(members: DataFrame, domains: Sequence[Domain] = DOMAINS, budget: float = BUDGET, most_copies: float | None = None) -> DataFrame:
    """The rates of :func:`solution`; an error if they have not come to rest."""
    found = solution(members, domains, budget, most_copies)
    if not found.converged:
        raise NotConverged(f"rates still move after {found.steps} steps: {found.reached} of {found.targets} tokens")
    return found.rates


def _after(current: DataFrame, steps: list[list[float]], held: list[Column], most_copies: float | None = None) -> DataFrame:
    """Rates after more gradient steps with momentum, each projected onto the allowed numbers."""
    if not steps:
        return current
    given = F.array(*(F.array(*map(F.lit, s)) for s in steps))

    def move(state: Column, step: Column) -> Column:
        ahead = state.rate + step[0] * (state.rate - state.last_rate)
        moved = ahead - _total([h * step[i + 1] for i, h in enumerate(held)])
        allowed = F.greatest(F.lit(0.0), moved if most_copies is None else F.least(F.lit(float(most_copies)), moved))
        return F.struct(allowed.alias("rate"), state.rate.alias("last_rate"))

    final = F.aggregate(given, F.struct("rate", "last_rate"), move)
    return current.withColumn("moved", final).withColumns({"rate": F.col("moved.rate"), "last_rate": F.col("moved.last_rate")}).drop("moved")


def mix(
    docs: DataFrame, labels: DataFrame, domains: Sequence[Domain] = DOMAINS, budget: float = BUDGET, key: str = "doc_id", text: str = "text",
    most_copies: float | None = None,
) -> DataFrame:
    """One row per document: doc_id, tokens, a membership per domain, rate, and copies.

    ``copies`` is the rate rounded up or down, by the hash of the id, so that
    its expectation is the rate.  Rows with the same id (null among them) are
    one document, whose tokens add up.  Null text counts as empty; documents
    without tokens keep the rate one.  Labels that are null or name no domain
    are not used; without labels all memberships are equal.  Texts of any
    length are read whole.  ``converged`` tells whether the rates came to rest
    (see :func:`solution`, which also reports target and reached tokens).
    Other columns are not read; an empty table gives an empty one.
    """
    members = settle(memberships(docs, labels, domains, key, text), "memberships")
    chance = F.expr("cast(pmod(xxhash64(doc_id, 29), 1000000007) as double) / 1000000007")
    rate = F.col("rate")
    found = solution(members, domains, budget, most_copies)
    return found.rates.select(
        "doc_id", "tokens", *(F.col(f"p{i}").alias(f"p_{d.name}") for i, d in enumerate(domains)), "rate",
        (F.floor(rate) + (chance < rate - F.floor(rate)).cast("bigint")).alias("copies"),
        F.lit(found.converged).alias("converged"),
    )


def apply(docs: DataFrame, mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, each as many times as its copies."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(key).alias("id"))
    copies = mixed.select("doc_id", F.col("copies").cast("int").alias("copies")).where("copies > 0")
    joined = rows.join(copies, F.col("id").eqNullSafe(F.col("doc_id"))).select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return joined.select("row.*")
