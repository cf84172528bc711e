"""Mixing sources to target weights, in DataFrame operations only.

1. A naive Bayes classifier over hashed words is fitted on labelled documents (a
   table of identifier and domain). It gives every document soft memberships:
   posteriors over the domains.
2. Projected gradients solve, over nonnegative document rates r_i,
       min sum_d (sum_i r_i n_i p_id - T_d)^2 / A_d
   where n_i are the document's tokens, p_id its posteriors, T_d the domain's
   target tokens and A_d its tokens at rate 1. With gradients preconditioned by
   n_i the step is 1. A step needs the domains' sums only; a rate is a function
   of its posteriors and the sums so far, so that no rate is ever stored.
3. A document is taken floor(r_i + u) times, u a number that its identifier decides.

Defined results
* null text: no tokens, the domains' priors as posteriors. Null identifiers are
  rows of their own and share one u; repeated rows are rows of their own.
* a domain without tokens (less than one is expected, by all posteriors): its
  residual is left alone and it binds no budget. No labelled row: uniform
  posteriors. Labelled rows of domains without a target, or null, are ignored.
* targets that no rates meet: the nearest rates after STEPS steps; target_gap tells.
* empty table: an empty result. Very long texts: read whole; evidence beyond
  EVIDENCE tokens is scaled down so that posteriors stay soft.
* other columns are ignored by mix() and returned untouched by take(), which
  takes each of several rows with one identifier by its own text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import same_text, staged, text_of, unit_hash

#: Labelled documents at most that the classifier is fitted on (a bounded sample: those of smallest hash).
MAX_LABELLED = 20_000
#: Hash buckets of words, which bound the classifier's table.
BUCKETS = 4096
#: Tokens whose evidence counts in full.
EVIDENCE = 64
#: Steps at most, and the relative residual that is good enough.
STEPS, TOLERANCE = 40, 0.001
#: Expected tokens of a domain that isn't absent; posteriors are never quite zero.
LEAST_TOKENS = 1.0


def _grams(docs: DataFrame, *keep: Column) -> DataFrame:
    """A row for each word: the columns to keep and its bucket (null for a text without words)."""
    words = F.array_remove(F.split(F.lower(text_of("_text")), r"[^\p{L}\p{N}]+"), "")
    rows = docs.select(*keep, F.explode_outer(words).alias("_word"))
    return rows.select(*[c for c in rows.columns if c != "_word"], F.when(F.col("_word").isNotNull(), F.pmod(F.xxhash64("_word"), F.lit(BUCKETS))).cast("int").alias("_bucket"))


def fit(docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str, text_col: str) -> tuple[DataFrame, list[float]]:
    """The classifier's table (bucket, log-likelihood of each domain) and the domains' log priors."""
    chosen = (
        labelled.select(F.col(labelled.columns[0]).alias("_lid"), F.col(labelled.columns[1]).alias("_domain"))
        .filter(F.col("_domain").isin(domains) & F.col("_lid").isNotNull())
        .orderBy(F.xxhash64("_lid"), "_lid", "_domain")
        .limit(MAX_LABELLED)
    )
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), F.col("_id") == F.col("_lid"))
    counts = _grams(own, F.col("_domain"), F.col("_text")).groupBy("_bucket").pivot("_domain", domains).count().na.fill(0)
    counts = staged(counts.filter("_bucket is not null"), "mix-counts")
    sums = counts.agg(*[F.coalesce(F.sum(F.col(f"`{d}`")), F.lit(0)).alias(f"_s{i}") for i, d in enumerate(domains)]).first()
    table = counts.select(
        F.col("_bucket").alias("_b"), *[F.log((F.col(f"`{d}`") + F.lit(0.5)) / F.lit(sums[i] + 0.5 * BUCKETS)).alias(f"_l{i}") for i, d in enumerate(domains)]
    )
    prior = [math.log((s + 1) / (sum(sums) + len(domains))) for s in sums]
    return table, prior


def memberships(docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: _id, _sa and _sb (stand for the text), _tokens, _p0, _p1, ... in the order of domains."""
    table, prior = fit(docs, labelled, domains, id_col, text_col)
    rows = docs.select(F.monotonically_increasing_id().alias("_u"), F.col(id_col).alias("_id"), *_known_by(text_col), F.col(text_col).alias("_text"))
    k = range(len(domains))
    said = _grams(rows, F.col("_u"), F.col("_id"), F.col("_sa"), F.col("_sb"), F.col("_text")).drop("_text")
    scored = (
        said.join(F.broadcast(table), F.col("_bucket") == F.col("_b"), "left")
        .groupBy("_u")
        .agg(F.first("_id").alias("_id"), F.first("_sa").alias("_sa"), F.first("_sb").alias("_sb"), F.count("_bucket").alias("_tokens"), *[F.coalesce(F.sum(f"_l{i}"), F.lit(0.0)).alias(f"_s{i}") for i in k])
    )
    soft = F.least(F.lit(1.0), F.lit(float(EVIDENCE)) / F.greatest(F.col("_tokens"), F.lit(1)))
    scored = scored.select("_id", "_sa", "_sb", "_tokens", *[(F.col(f"_s{i}") * soft + F.lit(prior[i])).alias(f"_s{i}") for i in k])
    top = F.greatest(*[F.col(f"_s{i}") for i in k]) if len(domains) > 1 else F.col("_s0")
    scored = scored.select("_id", "_sa", "_sb", "_tokens", *[F.exp(F.col(f"_s{i}") - top).alias(f"_s{i}") for i in k])
    total = sum((F.col(f"_s{i}") for i in k), F.lit(0.0))
    return scored.select("_id", "_sa", "_sb", "_tokens", *[(F.col(f"_s{i}") / total).alias(f"_p{i}") for i in k])


def rate_of(residuals: list[list[float]], start: float, most: float, n: int) -> Column:
    """The rate after these steps, as a function of the posteriors."""
    rate = F.lit(start)
    for e in residuals:
        step = sum((F.col(f"_p{i}") * F.lit(e[i]) for i in range(n)), F.lit(0.0))
        rate = F.least(F.greatest(rate - step, F.lit(0.0)), F.lit(most))
    return rate


def solve(soft: DataFrame, weights: list[float], max_rate: float, budget: float | None) -> tuple[list[list[float]], float, float]:
    """The residuals of every step, the rate to start from, and the largest part of its target that a domain is off in the end."""
    n = len(weights)

    def sums(rate: Column) -> list[float]:
        return [x or 0.0 for x in soft.agg(*[F.sum(F.col("_tokens") * F.col(f"_p{i}") * rate).alias(f"_m{i}") for i in range(n)]).first()]

    plain = sums(F.lit(1.0))
    if not sum(plain):
        return [], 1.0, 0.0
    if budget is None:  # as much as there is without repeating a domain beyond max_rate
        budget = min([sum(plain), *(max_rate * a / w for a, w in zip(plain, weights, strict=True) if w and a >= LEAST_TOKENS)])
    target = [w * budget for w in weights]
    start, steps = min(max_rate, budget / sum(plain)), []
    got = [a * start for a in plain]

    def gap() -> float:
        return max(abs(m - t) / max(t, 1.0) for m, t in zip(got, target, strict=True))

    while len(steps) < STEPS and any(a >= LEAST_TOKENS and abs(m - t) > TOLERANCE * max(t, 1) for m, t, a in zip(got, target, plain, strict=True)):
        steps.append([(m - t) / a if a >= LEAST_TOKENS else 0.0 for m, t, a in zip(got, target, plain, strict=True)])
        got = sums(rate_of(steps, start, max_rate, n))
    return steps, start, gap()


def _mixed(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float] | list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    max_rate: float = 4.0,
    budget: float | None = None,
    seed: int = 0,
) -> DataFrame:
    """mix(), and _sa and _sb, which stand for the row's text."""
    domains = sorted(targets)
    soft = staged(memberships(docs, labelled, domains, id_col, text_col), "mix-memberships")
    if isinstance(targets, dict):
        whole = sum(targets.values())
        steps, start, gap = solve(soft, [targets[d] / whole for d in domains], max_rate, budget)
    else:
        tokens = (soft.agg(F.sum("_tokens")).first()[0] or 0) if budget is not None else 0
        steps, start, gap = [], min(max_rate, budget / tokens if tokens else 1.0), 0.0
    best = F.greatest(*[F.struct(F.col(f"_p{i}").alias("p"), F.lit(-i).alias("order"), F.lit(d).alias("name")) for i, d in enumerate(domains)]) if len(domains) > 1 else F.struct(F.col("_p0").alias("p"), F.lit(domains[0]).alias("name"))
    out = soft.withColumn("_rate", rate_of(steps, start, max_rate, len(domains))).withColumn("_best", best)
    return out.select(
        F.col("_id").alias(id_col),
        F.col("_tokens").alias("n_tokens"),
        F.col("_best.name").alias("domain"),
        F.col("_best.p").alias("membership"),
        F.col("_rate").alias("rate"),
        F.floor(F.col("_rate") + unit_hash("_id", seed=seed)).cast("int").alias("copies"),
        F.lit(gap).alias("target_gap"),
        "_sa",
        "_sb",
    )


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | list[str], **how) -> DataFrame:
    """One row per input row: id_col, n_tokens, domain (the likeliest), membership (its posterior), rate, copies, target_gap.

    labelled: a table whose first two columns are an identifier and a domain.
    targets: the share of tokens of each domain, scaled to a sum of 1; or domains only, whose shares are to stay as they
    are: all documents have one rate then, 1 if there is no budget.
    id_col, text_col: the columns' names. max_rate: the largest rate (4). budget: the mix's expected tokens; if not
    given, all tokens, or fewer where max_rate binds. seed: of the draw.
    target_gap: the same in every row, the largest part of its target that a domain's expected tokens are off; above
    TOLERANCE where no rates meet the targets (domains without tokens, a budget beyond max_rate).
    """
    return _mixed(docs, labelled, targets, **how).drop("_sa", "_sb")


def take(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | list[str], **how) -> DataFrame:
    """The rows of docs, each as often as its copies in mix() say. Rows are known by identifier and text."""
    id_col, text_col = how.get("id_col", "doc_id"), how.get("text_col", "text")
    mixed = _mixed(docs, labelled, targets, **how)
    taken = mixed.groupBy(F.col(id_col).alias("_mid"), F.col("_sa").alias("_ma"), F.col("_sb").alias("_mb")).agg(F.first("copies").alias("_copies")).filter("_copies > 0")
    taken = taken.select("_mid", "_ma", "_mb", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    a, b = _known_by(text_col)
    same = docs[id_col].eqNullSafe(taken["_mid"]) & (a == taken["_ma"]) & (b == taken["_mb"])
    return docs.join(taken, same).select(*[docs[c] for c in docs.columns])


def in_mixed_order(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """All rows of docs, each once, sorted so that from the first row on the domains have the shares of tokens that targets asks for, each domain for as long as it lasts.

    A row stands at u * (its domain's tokens) / (its domain's target), u a number that its identifier decides: up to any
    place p, a domain that isn't used up has some p * target tokens. Domains whose target is 0 come last.
    """
    mixed = _mixed(docs, labelled, sorted(targets), id_col, text_col, max_rate=1.0)
    lengths = F.lit(None).cast("double")
    for r in mixed.groupBy("domain").agg(F.sum("n_tokens").alias("n")).collect():  # a row a domain
        if targets[r["domain"]]:
            lengths = F.when(F.col("domain") == r["domain"], F.lit(r["n"] / targets[r["domain"]])).otherwise(lengths)
    placed = mixed.select(F.col(id_col).alias("_mid"), F.col("_sa").alias("_ma"), F.col("_sb").alias("_mb"), (unit_hash(id_col, seed=seed) * lengths).alias("_place"))
    placed = placed.groupBy("_mid", "_ma", "_mb").agg(F.first("_place").alias("_place"))
    a, b = _known_by(text_col)
    same = docs[id_col].eqNullSafe(placed["_mid"]) & (a == placed["_ma"]) & (b == placed["_mb"])
    return docs.join(placed, same).orderBy(placed["_place"].asc_nulls_last(), placed["_ma"]).select(*[docs[c] for c in docs.columns])


def _known_by(text_col: str) -> list[Column]:
    """128 bits that stand for the text, as two numbers, which aggregates by hash can hold."""
    both = same_text(text_of(text_col))
    return [both["a"].alias("_sa"), both["b"].alias("_sb")]
