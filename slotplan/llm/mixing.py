"""Mixing documents to target domain weights (DataFrame and SQL functions only).

A classifier fitted on the labelled rows gives every document a posterior over
domains (soft membership). Nonnegative document rates ``r`` are then fitted so
that the expected domain totals ``sum(r * tokens * posterior)`` meet
``budget * target``: projected gradient on the least-squares residual. A step is
``r <- max(0, r + posterior . u)`` with ``u`` the residual scaled by the inverse of
the small domain-by-domain Gram matrix, halved until the residual falls. One
aggregation over (tokens, posterior) serves each step; a rate is the fold of the
steps so far over the document's own posterior, so no per-document state is kept.

``mixed`` draws each row at most once, so it is fitted for that draw: a step is
projected onto [0, 1] (in the fold and in the totals), and no domain is asked for more
than one copy of all its tokens; the part of a target that its domain cannot fill is
shared out among the others. Rows of the ``once`` domain and of such domains have rate 1.

Classifier: naive Bayes over binned features: shares of symbols, capitals and
distinct words, and for each domain the strongest log-odds among the text's
hashed word beginnings (``BUCKETS`` of them, learnt on all labelled rows).

Defined cases: null, empty and blank texts have no tokens and a posterior from
their bins; null or missing labels are unlabelled; a document labelled twice
counts for each row; domains without a labelled row get posterior 0 and their
target is shared out among the others; without any label every domain gets equal
posteriors; an empty table gives an empty result; repeated rows each get a rate;
extra columns are kept by ``mixed`` and ignored elsewhere.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotplan.operators.quality import keep_where

from .common import settled, sized

BUCKETS = 1 << 16
PREFIX = 4            # letters of a word that are hashed
MIN_DOCS = 5          # labelled documents a bucket needs for a weight
# Upper ends of the feature bins.
_SYMBOL_BINS = (0.0, 0.02, 0.1, 0.3, 1.0)
_CAPITAL_BINS = (0.0, 0.02, 0.05, 0.2, 0.6)
_DISTINCT_BINS = (0.1, 0.25, 0.4, 0.6, 0.8)
_ODDS_BINS = (0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 5.0)
_BITS = len(_ODDS_BINS) + 1     # bits of a domain in a bucket's number
_GROUP = 7                      # domains in one number


def _bin(value: Column, ends: Sequence[float]) -> Column:
    out = F.lit(len(ends))
    for i in reversed(range(len(ends))):
        out = F.when(value <= ends[i], F.lit(i)).otherwise(out)
    return out


def features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``_n`` tokens, ``_bins`` and ``_words`` (distinct hashed word beginnings)."""
    keep = docs.columns
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.btrim(F.lower(text), F.lit(" \t\n\x0b\f\r"))
    df = docs.select(
        *keep,
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+")).alias("_w"),
        F.regexp_count(text, F.lit("[#*$%&|<>!]")).alias("_sym"),
        F.regexp_count(text, F.lit("[A-Z]")).alias("_cap"))
    df = df.select(*keep, F.size("_w").alias("_n"), F.array_distinct("_w").alias("_d"), "_sym", "_cap")
    per_word = lambda x: x / F.greatest(F.col("_n"), F.lit(1))
    return df.select(
        *keep, F.col("_n").cast("long").alias("_n"),
        F.array(_bin(per_word(F.col("_sym")), _SYMBOL_BINS),
                _bin(per_word(F.col("_cap")) / 5.0, _CAPITAL_BINS),
                _bin(per_word(F.size("_d")), _DISTINCT_BINS)).alias("_bins"),
        F.transform("_d", lambda w: F.pmod(F.xxhash64(F.substring(w, 1, PREFIX)), F.lit(BUCKETS)).cast("int")).alias("_words"))


@dataclass
class Model:
    domains: list[str]
    weights: DataFrame                      # one row: arrays m0.. of BUCKETS numbers, a bit per domain and bin
    prior: list[float]
    tables: list[list[list[float]]]         # feature -> domain -> log share of each bin

    def posterior(self, feats: DataFrame) -> DataFrame:
        """``feats`` with ``_p``, the posterior over ``domains``; its helper columns go."""
        keep = [c for c in feats.columns if c not in ("_bins", "_words")]
        df = feats
        if self.tables:
            df = self.binned(df)
            logs = [sum((F.get(F.array(*[F.lit(x) for x in t[k]]), F.get("_bins", F.lit(j)))
                         for j, t in enumerate(self.tables)), F.lit(self.prior[k]))
                    for k in range(len(self.domains))]
            df = df.select(*keep, F.array(*logs).alias("_log"))
            df = df.select(*keep, F.transform("_log", lambda x: F.exp(x - F.array_max("_log"))).alias("_e"))
            total = F.aggregate("_e", F.lit(0.0), lambda s, x: s + x)
            return df.select(*keep, F.transform("_e", lambda x: x / total).alias("_p"))
        k = len(self.domains)
        return df.select(*keep, F.array(*[F.lit(1.0 / k)] * k).alias("_p"))

    def binned(self, feats: DataFrame) -> DataFrame:
        """``feats`` with the strongest log-odds bin of each domain added to ``_bins``.

        A bucket's bins are bits of one number, so one look-up and OR per word serve
        all domains of a group.
        """
        groups = range(-(-len(self.domains) // _GROUP))
        df = feats.withColumns({f"_m{g}": self.weights.select(f"m{g}").scalar() for g in groups})   # one array each
        df = df.withColumns({f"_c{g}": F.aggregate("_words", F.lit(0).cast("long"), _or_lookup(f"_m{g}")) for g in groups})
        # a generator of one row: the optimiser copies no expression across it, so the fold runs once
        df = df.select(*feats.columns, F.explode(F.array(F.struct(*[f"_c{g}" for g in groups]))).alias("_c"))
        odds = [_highest(F.col(f"_c._c{k // _GROUP}"), _BITS * (k % _GROUP)) for k in range(len(self.domains))]
        return df.withColumn("_bins", F.concat("_bins", F.array(*odds))).drop("_c")


def _or_lookup(masks: str):
    return lambda acc, b: acc.bitwiseOR(F.get(F.col(masks), b))


def _highest(code: Column, offset: int) -> Column:
    """Highest bin whose bit is set (a text without words has bin 0)."""
    out = F.lit(0)
    for b in range(1, _BITS):
        out = F.when(code.bitwiseAND(F.lit(1 << (offset + b))) != 0, F.lit(b)).otherwise(out)
    return out


def fit(docs: DataFrame, labels: DataFrame, domains: Sequence[str],
        id_col: str = "doc_id", text_col: str = "text") -> Model:
    """``labels``: ``id_col`` and ``domain``. Counts run over all labelled rows."""
    domains = list(domains)
    known = labels.where(F.col("domain").isin(domains)).select(id_col, "domain")
    labelled = docs.select(id_col, text_col).join(sized(settled(known, "mixing-known")), id_col)
    feats = settled(features(labelled, text_col).drop(text_col), "mixing-labelled")
    size = {r["domain"]: r["count"] for r in feats.groupBy("domain").count().collect()}
    total = sum(size.values())
    if not total:
        return Model(domains, docs.sparkSession.range(1), [], [])
    seen = [F.count(F.when(F.col("domain") == d, 1)).alias(f"c{k}") for k, d in enumerate(domains)]
    counts = feats.select("domain", F.explode(F.array_distinct("_words")).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("c"), *seen)
    masks = []
    for g in range(0, len(domains), _GROUP):
        mask = F.lit(0).cast("long")
        for k, d in list(enumerate(domains))[g:g + _GROUP]:
            inside, outside = size.get(d, 0), total - size.get(d, 0)
            odds = (F.log((F.col(f"c{k}") + 0.5) / (inside + 1.0))
                    - F.log((F.col("c") - F.col(f"c{k}") + 0.5) / (outside + 1.0)))
            place = _bin(F.when(F.col("c") >= MIN_DOCS, odds).otherwise(0.0), _ODDS_BINS) + _BITS * (k - g)
            mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
        masks.append(mask.alias(f"m{g // _GROUP}"))
    names = [f"m{g}" for g in range(len(masks))]
    full = (docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
            .join(counts.select("bucket", *masks), "bucket", "left").na.fill(0))
    rows = full.agg(F.sort_array(F.collect_list(F.struct("bucket", *names))).alias("r"))
    weights = settled(rows.select(*[F.col(f"r.{m}").alias(m) for m in names]), "mixing-weights")

    model = Model(domains, weights, [math.log((size.get(d, 0) or 1e-12) / total) for d in domains], [])
    n_bins = [len(_SYMBOL_BINS) + 1, len(_CAPITAL_BINS) + 1, len(_DISTINCT_BINS) + 1] + [len(_ODDS_BINS) + 1] * len(domains)
    bins = model.binned(feats)
    told = {(r["pos"], r["bin"], r["domain"]): r["count"] for r in
            bins.select("domain", F.posexplode("_bins").alias("pos", "bin")).groupBy("pos", "bin", "domain").count().collect()}
    model.tables = [[[math.log((told.get((j, b, d), 0) + 1.0) / (size.get(d, 0) + nb)) for b in range(nb)] for d in domains]
                    for j, nb in enumerate(n_bins)]
    return model


def _solve(m: list[list[float]], y: list[float]) -> list[float]:
    """Solution of a small symmetric system (Gaussian elimination with a small ridge)."""
    n = len(y)
    ridge = 1e-9 * max(sum(m[i][i] for i in range(n)), 1e-30)
    a = [row[:] + [y[i]] for i, row in enumerate(m)]
    for i in range(n):
        a[i][i] += ridge
    for i in range(n):
        p = max(range(i, n), key=lambda r: abs(a[r][i]))
        a[i], a[p] = a[p], a[i]
        for r in range(n):
            if r != i and a[i][i]:
                f = a[r][i] / a[i][i]
                a[r] = [x - f * z for x, z in zip(a[r], a[i])]
    return [a[i][n] / a[i][i] if a[i][i] else 0.0 for i in range(n)]


def rate(posterior: Column, steps: Sequence[Sequence[float]], most: float | None = None) -> Column:
    """Rate of a document after the gradient steps, from its posterior alone; at most ``most``."""
    if not steps:
        return F.lit(1.0)
    k = len(steps[0])
    dot = lambda u: sum((F.get(posterior, F.lit(i)) * u[i] for i in range(1, k)), F.get(posterior, F.lit(0)) * u[0])
    table = F.array(*[F.array(*[F.lit(float(x)) for x in u]) for u in steps])
    upper = (lambda r: r) if most is None else (lambda r: F.least(F.lit(float(most)), r))
    return F.aggregate(table, F.lit(1.0), lambda r, u: F.greatest(F.lit(0.0), upper(r + dot(u))))


def draw_rate(posterior: Column, kept: Column, steps: Sequence[Sequence[float]]) -> Column:
    """Chance of a row in a draw without repeats: 1 for the rows in ``kept``."""
    return F.when(kept, F.lit(1.0)).otherwise(rate(posterior, steps, 1.0))


def draw_goal(sums: Sequence[float], targets: Sequence[float], once: int) -> list[float]:
    """Tokens of each domain in a draw without repeats that holds domain ``once`` whole.

    A domain that cannot fill its share gives all it has (``sums``). Without tokens or a
    target for ``once``, the largest budget that every domain with tokens can fill.
    """
    live = [t if s > 1e-9 * sum(sums) else 0.0 for t, s in zip(targets, sums)]
    budgets = [s / t for s, t in zip(sums, live) if t]
    budget = sums[once] / live[once] if live[once] else min(budgets, default=0.0)
    return [min(s, budget * t) for s, t in zip(sums, live)]


def solve_rates(members: DataFrame, targets: Sequence[float], budget: float | None = None,
                goal: Sequence[float] | None = None, max_steps: int = 40, tol: float = 1e-6) -> list[list[float]]:
    """Gradient steps that bring expected domain totals to ``budget * targets``.

    ``members``: columns ``_n`` and ``_p``. ``budget`` defaults to all tokens. With
    ``goal`` (tokens per domain, see ``draw_goal``) the fit is for a draw without repeats
    and ``members`` has ``_kept``, the rows that stay anyway; a step that gains less than
    1e-5 of the tokens ends it, as soft posteriors can put the goal out of reach.
    """
    k = len(targets)
    part = lambda i: F.get("_p", F.lit(i))
    draw = goal is not None
    free = ~F.col("_kept") if draw else F.lit(True)

    def totals(steps):
        r = draw_rate(F.col("_p"), F.col("_kept"), steps) if draw else rate(F.col("_p"), steps)
        df = members.select(F.col("_n").cast("double").alias("n"), "_p", r.alias("r"), free.alias("free"))
        live = F.when(F.col("free") & (F.col("r") > 0), F.col("n")).otherwise(0.0)
        row = df.agg(
            F.coalesce(F.sum("n"), F.lit(0.0)),
            *[F.coalesce(F.sum(F.col("n") * F.col("r") * part(i)), F.lit(0.0)) for i in range(k)],
            *[F.coalesce(F.sum(live * part(i) * part(j)), F.lit(0.0)) for i in range(k) for j in range(i, k)]).first()
        flat, gram = list(row[1 + k:]), [[0.0] * k for _ in range(k)]
        for i in range(k):
            for j in range(i, k):
                gram[i][j] = gram[j][i] = flat.pop(0)
        return row[0], list(row[1:1 + k]), gram

    n, sums, gram = totals([])
    if not n:
        return []
    if not draw:
        have = [t if s > 1e-9 * n else 0.0 for t, s in zip(targets, sums)]
        scale = sum(have) or 1.0
        budget = n if budget is None else budget
        goal = [budget * t / scale for t in have]
    else:
        budget = sum(goal)
    least = budget * (1e-5 if draw else tol * 1e-3)
    # a gradient step of this length always falls: no Gram matrix of live rows is larger
    longest = sum(gram[i][i] for i in range(k))
    miss = lambda s: math.sqrt(sum((a - b) ** 2 for a, b in zip(s, goal)))
    steps: list[list[float]] = []
    while len(steps) < max_steps and miss(sums) > tol * budget:
        left = [g - s for g, s in zip(goal, sums)]
        step = _solve(gram, left)
        for tried in range(9 if draw else 8):
            if tried == 8:
                step = [x / longest if longest else 0.0 for x in left]
            _, s2, g2 = totals(steps + [step])
            if miss(s2) < miss(sums):
                break
            step = [x / 2 for x in step]
        else:
            break
        gain = miss(sums) - miss(s2)
        steps, sums, gram = steps + [step], s2, g2
        if gain < least:
            break
    return steps


def mix(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float], budget: float | None = None,
        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, posterior (map domain -> share) and rate of every document."""
    domains = list(targets)
    model = fit(docs, labels, domains, id_col, text_col)
    members = settled(model.posterior(features(docs.select(id_col, text_col), text_col)).drop(text_col), "mixing-members")
    steps = solve_rates(members, [targets[d] for d in domains], budget)
    return members.select(
        F.col(id_col).alias("doc_id"), F.col("_n").alias("n_tokens"),
        F.map_from_arrays(F.array(*[F.lit(d) for d in domains]), F.col("_p")).alias("posterior"),
        rate(F.col("_p"), steps).alias("rate"))


def mixed(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float], once: str,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` drawn by rate, without repeats: a row stays if the uniform
    hash of its id lies below its rate. Rows labelled ``once``, and those whose posterior
    is highest there, all stay; domain ``once`` sets the budget."""
    domains = list(targets)
    at = domains.index(once)
    model = fit(docs, labels, domains, id_col, text_col)
    told = settled(labels.where(F.col("domain") == once).select(F.col(id_col).alias("_id")).distinct()
                   .withColumn("_told", F.lit(True)), "mixing-once")
    # the input row travels as one struct, so no column of it can clash with the features
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text_col).alias("_in"), F.col(id_col).alias("_id"))
    scored = model.posterior(features(rows.join(sized(told), "_id", "left").drop("_id"), "_in"))
    scored = scored.select("_row", "_n", "_p", F.coalesce("_told", F.lit(False)).alias("_told"))
    members = settled(scored.select("_n", "_p", "_told"), "mixing-members")
    asked = [targets[d] for d in domains]
    sums = list(members.agg(*[F.coalesce(F.sum(F.col("_n") * F.get("_p", F.lit(i))), F.lit(0.0))
                              for i in range(len(domains))]).first())
    goal = draw_goal(sums, asked, at)
    whole = [i for i, t in enumerate(asked) if i == at or (t > 0 and goal[i] >= sums[i])]
    kept = F.col("_told")
    for i in whole:
        kept = kept | (F.get("_p", F.lit(i)) >= F.array_max("_p"))
    steps = solve_rates(members.withColumn("_kept", kept), asked, goal=goal)
    uniform = F.pmod(F.xxhash64(F.lit("mix"), F.col("_row")[id_col]), F.lit(1 << 30)) / float(1 << 30)
    return keep_where(scored, uniform < draw_rate(F.col("_p"), kept, steps)).select("_row.*")


def label_domains(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Domains of the labels table: junk (quality 0), toxic, clean."""
    return labels.select(id_col, F.when(F.col("quality") == 0, "junk").when(F.col("toxic") == 1, "toxic")
                         .when((F.col("quality") == 1) & (F.col("toxic") == 0), "clean").alias("domain"))
