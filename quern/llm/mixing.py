"""Soft-membership mixing of sources to target weights, with DataFrame functions only.

A Bernoulli naive Bayes classifier over the words and word beginnings that tell the labelled domains apart predicts each document's domain
posteriors. Document rates start at 1 and follow the projected gradient of the least squares between expected domain
token totals and targets; a rate never falls below 0. Every step reads one row of domain totals back; rates are kept as a function
of those rows and are not stored."""

from __future__ import annotations

import json
import math
import warnings
import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import materialize

#: Labelled rows used at most, the chance that any feature is kept by accident, and entries of a map that is searched.
MAX_LABELLED, CHANCE, ENTRIES = 8192, 0.01, 4
STEPS, TOLERANCE = 40, 1e-6


def words_of(text: Column) -> Column:
    """Lower-case words between white space; the first and the last may be empty."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x09-\x0D\x20]+", -1)


def features(words: Column) -> Column:
    """The words, and their first four characters with a star."""
    return F.concat(words, F.transform(words, lambda w: F.concat(F.left(w, F.lit(4)), F.lit("*"))))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once however often use names it."""
    return F.transform(F.array(value), use)[0]


def n_tokens(words: Column) -> Column:
    """Size of a text in tokens, taken as its words; a text without words weighs nothing."""
    return (F.size(words) - (words[0] == "").cast("int") - ((F.size(words) > 1) & (F.element_at(words, -1) == "")).cast("int")).cast("bigint")


class Classifier:
    """For each domain, the log-odds of the features kept, and the log prior of a document without any of them."""

    def __init__(self, domains: list[str], prior: list[float], odds: dict[str, list[float]]):
        self.domains, self.prior, self.odds = domains, prior, odds

    def posteriors(self, words: Column) -> Column:
        """An array with a chance for each domain."""
        if not self.odds:
            scores = F.array(*[F.lit(p) for p in self.prior])
        else:
            names = sorted(self.odds)
            n = -(-len(names) // ENTRIES)
            parts: list[dict[str, list[float]]] = [{"": [0.0] * len(self.domains)} for _ in range(n)]
            for w in names:
                parts[zlib.crc32(w.encode()) % n][w] = self.odds[w]
            # maps are searched from end to end, so words are dealt over many small ones
            table = F.from_json(F.lit(json.dumps(parts)), "array<map<string,array<double>>>")  # folded into one constant
            place = lambda w: F.element_at(table, (F.crc32(w) % n + 1).cast("int"))
            found = F.transform(F.array_distinct(features(F.array_distinct(words))), lambda w: F.element_at(place(w), w))
            scores = F.aggregate(F.array_compact(found), F.array(*[F.lit(p) for p in self.prior]), lambda total, odds: F.zip_with(total, odds, lambda a, b: a + b))
        above = let(scores, lambda s: let(F.array_max(s), lambda most: F.transform(s, lambda x: F.exp(x - most))))
        return let(above, lambda e: let(F.aggregate(e, F.lit(0.0), lambda a, b: a + b), lambda whole: F.transform(e, lambda x: x / whole)))


def fit_classifier(labelled: DataFrame, domains: list[str], *, text_col: str = "text", domain_col: str = "domain") -> Classifier:
    """labelled is a bounded sample, and so are the features that reach the driver: all whose documents stray from the
    domains' shares by more than any feature would by accident."""
    rows = labelled.where(F.col(domain_col).isin(domains)).select(F.col(domain_col).alias("domain"), F.array_distinct(features(words_of(F.col(text_col)))).alias("words"))
    sizes = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    prior = [math.log((sizes.get(d, 0) + 1) / (total + len(domains))) for d in domains]
    if not total:
        return Classifier(domains, prior, {})
    counts = [F.count(F.when(F.col("domain") == d, 1)).alias(f"c{k}") for k, d in enumerate(domains)]
    table = rows.select("domain", F.explode("words").alias("word")).where("word <> ''").groupBy("word").agg(F.count("*").alias("n"), *counts)
    # how far a word's documents stray from the domains' shares, as chi-squared
    chi = sum(((F.col(f"c{k}") - F.col("n") * F.lit(sizes.get(d, 0) / total)) ** 2) / (F.col("n") * F.lit(max(sizes.get(d, 0), 0.5) / total)) for k, d in enumerate(domains))
    table = materialize(table.withColumn("chi", chi))
    free, surprise = max(len(domains) - 1, 1), math.log(max(table.count(), 1) / CHANCE)
    kept = table.where(F.col("chi") > free + 2 * math.sqrt(free * surprise) + 2 * surprise).orderBy("word").collect()  # Laurent and Massart's bound on the tail
    odds = {}
    for r in kept:
        chance = [(r[f"c{k}"] + 0.1) / (sizes.get(d, 0) + 0.2) for k, d in enumerate(domains)]
        odds[r["word"]] = [math.log(c / (1 - c)) for c in chance]
        prior = [p + math.log(1 - c) for p, c in zip(prior, chance, strict=True)]
    return Classifier(domains, prior, odds)


def rate(share: Column, steps: list[list[float]]) -> Column:
    """The document's rate after steps: from 1, each takes away the inner product of posteriors and step, never below 0."""
    if not steps:
        return F.lit(1.0)
    out = F.lit(1.0)
    moves = F.array(*[F.array(*[F.lit(v) for v in s]) for s in steps])
    n = len(steps[0])
    return F.aggregate(moves, out, lambda r, s: F.greatest(F.lit(0.0), r - sum((share[k] * s[k] for k in range(n)), F.lit(0.0))))


def solve(table: DataFrame, targets: list[float], free: list[int]) -> tuple[list[list[float]], list[float]]:
    """Steps of the projected gradient, and the totals reached. table: tokens, share__. targets: wanted domain tokens.
    free: the domains that are held to their targets; the others take no step.

    The gradient is taken in the metric of the domains' overlap among documents that still have a rate, so that domains
    that share documents don't slow each other down."""
    n = len(targets)
    share, tokens = F.col("share__"), F.col("tokens")
    steps: list[list[float]] = []
    totals: list[float] = []
    for _ in range(STEPS + 1):
        r = rate(share, steps)
        live = F.when(F.col("r") > 0, F.col("tokens")).otherwise(F.lit(0.0))
        sums = [F.sum(tokens * share[k] * F.col("r")).alias(f"t{k}") for k in range(n)]
        sums += [F.sum(live * share[k] * share[m]).alias(f"g{k}_{m}") for k in free for m in free if k <= m]
        got = table.withColumn("r", r).agg(*sums).first()
        totals = [float(got[f"t{k}"] or 0) for k in range(n)]
        off = [totals[k] - targets[k] for k in free]
        if max((abs(x) for x in off), default=0.0) <= TOLERANCE * max(1.0, sum(targets)) or len(steps) == STEPS:
            break
        overlap = [[float(got[f"g{min(k, m)}_{max(k, m)}"] or 0) for m in free] for k in free]
        ridge = 1e-9 + 1e-7 * max(overlap[k][k] for k in range(len(free)))
        found = solved([[x + (ridge if k == m else 0.0) for m, x in enumerate(row)] for k, row in enumerate(overlap)], off)
        steps.append([found[free.index(k)] if k in free else 0.0 for k in range(n)])
    return steps, totals


def solved(matrix: list[list[float]], right: list[float]) -> list[float]:
    """The solution of a small regular system, by elimination."""
    n = len(right)
    rows = [[*m, r] for m, r in zip(matrix, right, strict=True)]
    for k in range(n):
        best = max(range(k, n), key=lambda i: abs(rows[i][k]))
        rows[k], rows[best] = rows[best], rows[k]
        for i in range(k + 1, n):
            f = rows[i][k] / rows[k][k]
            rows[i] = [x - f * y for x, y in zip(rows[i], rows[k], strict=True)]
    out = [0.0] * n
    for k in reversed(range(n)):
        out[k] = (rows[k][n] - sum(rows[k][m] * out[m] for m in range(k + 1, n))) / rows[k][k]
    return out


def sample_of(labels: DataFrame, id_col: str, most: int) -> DataFrame:
    """The most rows with the lowest id hashes."""
    return labels.orderBy(F.xxhash64(F.col(id_col), F.lit("labelled")), id_col).limit(most)


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float], *, total: float | None = None, anchor: str | None = None, free_anchor: bool = False, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain", carry: list[str] | None = None, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The carried columns of docs (all by default) with tokens, posteriors (domain to chance), rate and copies.

    labels: id_col and domain_col for some ids; max_labelled of them, with the lowest id hashes, train the classifier.
    targets: domain shares, made to add up to 1. total: wanted tokens, by default those of docs or, with anchor, as many
    as leave that domain the expected tokens that it has. With free_anchor the anchor isn't held to its total: its own
    documents keep the rate 1, and only the other domains are brought to their targets. rate is the expected number of times that a document
    is used, copies a draw with that mean by the hash of the id: floor(rate + u). A domain that no document belongs to
    can't be filled: its total stays what the posteriors give. A warning names the totals that miss their targets. Null texts have no tokens and keep the classifier's
    prior; null ids draw like any other value; repeated rows draw alike; an empty table gives an empty result. Columns
    of docs that are named like added ones are left out."""
    domains = sorted(targets)
    scale = sum(targets.values())
    chosen = sample_of(labels.where(F.col(domain_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("l_id"), F.col(domain_col).alias("l_domain")).dropDuplicates(["l_id"]), "l_id", max_labelled)
    labelled = docs.select(F.col(id_col).alias("l_id"), F.col(text_col).alias("l_text")).join(F.broadcast(chosen), "l_id")
    model = fit_classifier(materialize(labelled), domains, text_col="l_text", domain_col="l_domain")
    added = ("tokens", "posteriors", "rate", "copies", "read__", "share__", "unit__")
    kept = [c for c in (docs.columns if carry is None else carry) if c not in added]
    unit = F.pmod(F.xxhash64(F.col(id_col), F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    read = let(words_of(F.col(text_col)), lambda w: F.struct(n_tokens(w).alias("tokens"), model.posteriors(w).alias("share__")))
    table = materialize(docs.select(*kept, read.alias("read__"), unit.alias("unit__")).select(*kept, "read__.tokens", "read__.share__", "unit__"))
    if total is None:
        held = F.col("tokens") if anchor is None else F.col("tokens") * F.col("share__")[domains.index(anchor)] * F.lit(scale / targets[anchor])
        total = float(table.agg(F.sum(held)).first()[0] or 0)
    wanted, held_to = [targets[d] / scale * total for d in domains], [k for k, d in enumerate(domains) if not (free_anchor and d == anchor)]
    steps, reached = solve(table, wanted, held_to)
    off = {domains[k]: reached[k] - wanted[k] for k in held_to}
    if max((abs(x) for x in off.values()), default=0.0) > TOLERANCE * max(1.0, sum(wanted)):
        warnings.warn(f"domain totals miss their targets by {off}", stacklevel=2)
    rated = table.withColumn("rate", F.round(rate(F.col("share__"), steps), 6))
    named = F.map_from_arrays(F.array(*[F.lit(d) for d in domains]), F.col("share__"))
    return rated.select(*kept, "tokens", named.alias("posteriors"), "rate", F.floor(F.col("rate") + F.col("unit__")).cast("int").alias("copies"))
