"""Quality and toxicity of documents, with the sites they come from.

A document's own words and shape give evidence; the host and the section of the
host it comes from give a prior. The three are combined by hierarchical
empirical Bayes, once for "low quality" and once for "toxic":

1. *Evidence.* Log-likelihood ratios of words that differ significantly between
   labelled documents, counted by grouped aggregation; a logistic model of them
   and of the text's shape, fitted on labelled documents that were not counted.
2. *Sites.* The calibrated probabilities are summed per section and per host.
   How far hosts differ (beyond what their own noise explains) sets how many
   pseudo-documents of the global rate a host starts with, and likewise for
   sections within hosts. A sparse site so stays near its parent.
3. *Decision.* A document's log-odds are its evidence plus those of its
   section's shrunken rate, taken without the document itself.

Learning uses at most ``SAMPLE_ROWS`` labelled documents and ``MAX_FEATURES``
features. Sites are counted over all documents; hot ones by partial sums.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import attach, map_rows, stored

TARGETS = ("low", "toxic")

SAMPLE_ROWS = 20_000
MAX_FEATURES = 20_000
# Of the sample, the logistic model gets this share and the rest is counted.
CALIBRATION_SHARE = 0.25
# A feature counts if its log-ratio is this many standard errors from zero.
LEAST_Z = 4.0
LEAST_DOCS = 5
REJECT_FROM = 0.5

# Pseudo-documents a site's parent may weigh.
LEAST_WEIGHT, MOST_WEIGHT = 2.0, 1e6

_EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
_LOUD_END = re.compile(r"[^\w\s]{2,}(?=\s|$)")
_NO_WORD = re.compile(r"(?<!\S)[^\w\s]+(?=\s|$)")
_STEM = 5
_STEPS = (0.0, 0.02, 0.1, 0.3, 0.6)


def words(tokens: set[str]) -> set[str]:
    """Distinct words and the first letters of longer ones, lower-cased."""
    found = {t.strip(_EDGES).lower() for t in tokens}
    found |= {f"{w[:_STEM]}*" for w in found if len(w) > _STEM}
    found.discard("")
    return found


def shape(text: str, tokens: list[str]) -> list[float]:
    """Shares of odd tokens, as they are and in steps, and the length."""
    n = max(len(tokens), 1)
    shares = (
        sum(t.isupper() and len(t) > 1 for t in tokens) / n,
        sum(map(str.__eq__, tokens, tokens[1:])) / n,
        len(_LOUD_END.findall(text)) / n,
        len(_NO_WORD.findall(text)) / n,
    )
    steps = [float(share > step) for share in shares for step in _STEPS]
    return [*shares, *steps, len(set(tokens)) / n, math.log1p(len(tokens))]


@dataclass(frozen=True)
class Evidence:
    """A target's word weights, and a logistic model of them and the shape."""

    weights: dict[str, float]
    coefficients: tuple[float, ...] = ()
    rate: float = 0.5

    def vector(self, found: set[str], shape: list[float]) -> list[float]:
        """Model input: word evidence for and against, and the shape."""
        known = self.weights.keys() & found
        values = [self.weights[f] for f in known]
        strong = sum(v for v in values if v > 0)
        weak = sum(v for v in values if v < 0)
        length = 1 + shape[-1]
        return [math.sqrt(strong), strong / length, weak / length, max(values, default=0.0), *shape, 1.0]

    def log_ratio(self, found: set[str], shape: list[float]) -> float:
        """Calibrated log-odds less those of the base rate."""
        if not self.coefficients:
            return 0.0
        terms = zip(self.coefficients, self.vector(found, shape))
        return sum(c * v for c, v in terms) - _logit(self.rate)


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def logistic(x: np.ndarray, labels: np.ndarray, ridge: float = 0.3) -> tuple[float, ...]:
    """Coefficients of a logistic fit, by Newton's method; the last column of
    ``x`` is one. Without both kinds of labels there is nothing to fit."""
    if not 0 < labels.sum() < len(labels):
        return ()
    beta = np.zeros(x.shape[1])
    beta[-1] = _logit((labels.sum() + 1) / (len(labels) + 2))
    start, pull = beta.copy(), np.full(x.shape[1], ridge)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (labels - p) - pull * (beta - start)
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        move = np.linalg.solve(curve, slope)
        # Short moves keep separable data from overshooting.
        beta = beta + move * min(1.0, 2.0 / max(np.abs(move).max(), 1e-9))
        if np.abs(move).max() < 1e-6:
            break
    return tuple(map(float, beta))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    max_features: int = MAX_FEATURES,
) -> dict[str, Evidence]:
    """Evidence models from at most ``sample_rows`` labelled documents.

    Labels with a NULL are not used; a document labelled twice counts as low
    or toxic if any label says so. Without labels nothing is evidence.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg((1 - F.min("quality")).cast("int").alias("low"), F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
        .withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(1000)) / 1000)
    )
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    # At most sample_rows short rows are broadcast.
    sample = stored(texts.join(F.broadcast(known), "doc_id"), "labelled-sample")
    counted = sample.where(F.col("fold") >= CALIBRATION_SHARE)

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [sorted(words(set((t or "").split()))) for t in batch["text"]]
            yield pd.DataFrame({"low": batch["low"], "toxic": batch["toxic"], "found": found})

    schema = "low int, toxic int, found array<string>"
    per_feature = (
        counted.mapInPandas(listed, schema)
        .select("low", "toxic", F.explode("found").alias("feature"))
        .groupBy("feature")
        .agg(F.count("*").alias("docs"), F.sum("low").alias("low"), F.sum("toxic").alias("toxic"))
        .where(F.col("docs") >= LEAST_DOCS)
    )
    per_feature = stored(per_feature, "feature-counts")
    total = counted.agg(
        F.count("*").alias("docs"),
        *[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in TARGETS],
    ).first()

    models = {}
    for target in TARGETS:
        with_, without = total[target], total["docs"] - total[target]
        ratio = F.log((F.col(target) + 0.5) / (with_ + 1.0)) - F.log(
            (F.col("docs") - F.col(target) + 0.5) / (without + 1.0)
        )
        error = F.sqrt(1 / (F.col(target) + 0.5) + 1 / (F.col("docs") - F.col(target) + 0.5))
        chosen = (
            per_feature.select("feature", ratio.alias("weight"), (F.abs(ratio) / error).alias("z"))
            .where(F.col("z") >= LEAST_Z)
            .orderBy(F.desc("z"), "feature")
            .limit(max_features)
            .collect()  # at most max_features rows
        )
        models[target] = Evidence({r["feature"]: r["weight"] for r in chosen})

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = [_seen(t) for t in batch["text"]]
            yield pd.DataFrame(
                {t: batch[t] for t in TARGETS}
                | {f"{t}_vector": [m.vector(*s) for s in seen] for t, m in models.items()}
            )

    schema = ", ".join([f"{t} int, {t}_vector array<double>" for t in TARGETS])
    held = sample.where(F.col("fold") < CALIBRATION_SHARE)
    # At most sample_rows short rows of numbers.
    held = held.mapInPandas(vectors, schema).select(*[c.format(t) for t in TARGETS for c in ("{}", "{}_vector")]).toPandas()
    for target in TARGETS:
        truth = held[target].to_numpy(float)
        if len(truth):
            found = logistic(np.vstack(held[f"{target}_vector"]), truth)
            rate = float((truth.sum() + 1) / (len(truth) + 2))
            models[target] = Evidence(models[target].weights, found, rate)
    return models


def _seen(text: str | None) -> tuple[set[str], list[float]]:
    tokens = (text or "").split()
    return words(set(tokens)), shape(text or "", tokens)


def _weight(groups: DataFrame, parent_rate, columns: tuple[str, str, str]) -> tuple[float, float]:
    """Rate of all rows, and pseudo-documents of the parent's rate by moments.

    ``groups`` has per group the columns (rows, sum, sum of squares).
    """
    n, s, q = (F.col(c) for c in columns)
    mean = s / n
    noise = F.greatest(q / n - mean * mean, F.lit(0.0))
    row = groups.agg(
        F.sum(n).alias("n"), F.sum(s).alias("s"),
        F.sum(n * (mean - parent_rate) ** 2).alias("spread"), F.sum(noise).alias("noise"),
    ).first()
    if not row["n"]:
        return 0.5, MOST_WEIGHT
    rate = min(max(row["s"] / row["n"], 1e-6), 1 - 1e-6)
    between = (row["spread"] - row["noise"]) / row["n"]
    weight = rate * (1 - rate) / between - 1 if between > 0 else MOST_WEIGHT
    return rate, min(max(weight, LEAST_WEIGHT), MOST_WEIGHT)


def _site(column: str) -> Column:
    name = F.col(column).cast("string")
    return F.when(name.isNull(), "-").otherwise(F.concat(F.lit("+"), name))


def _digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    host: str = "source",
    section: str = "lang",
    id_column: str = "doc_id",
    text_column: str = "text",
    models: dict[str, Evidence] | None = None,
) -> DataFrame:
    """``doc_id, host, section``, per target ``*_evidence`` (log-ratio),
    ``*_site`` (the shrunken rate of the section) and ``p_*``, and ``rejected``.

    A document is rejected if either probability is ``REJECT_FROM`` or more.
    ``section`` is a part of ``host``: for addresses the first part of the
    path. A NULL host or section is a site of its own. A NULL text counts as
    empty. Rows that repeat an id are listed as often as they occur. Without
    labels the evidence is zero and nothing is rejected.
    """
    return _classified(docs, labels, host, section, id_column, text_column, models).drop("digest")


def _classified(
    docs: DataFrame,
    labels: DataFrame,
    host: str,
    section: str,
    id_column: str,
    text_column: str,
    models: dict[str, Evidence] | None = None,
) -> DataFrame:
    """What ``classify`` gives, and the ``digest`` of the text."""
    models = fit(docs, labels, id_column, text_column) if models is None else models
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def evidence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = shared.value
        for batch in batches:
            seen = [_seen(t) for t in batch["text"]]
            out = {c: batch[c] for c in ("doc_id", "host", "section", "digest")}
            for target, model in models.items():
                log_ratio = np.array([model.log_ratio(*s) for s in seen], float)
                out[f"{target}_evidence"] = log_ratio
                odds = np.exp(np.clip(log_ratio + _logit(model.rate), -50, 50))
                out[f"{target}_own"] = odds / (1 + odds)
            yield pd.DataFrame(out)

    numbers = ", ".join(f"{t}_evidence double, {t}_own double" for t in TARGETS)
    texts = docs.select(
        F.col(id_column).alias("doc_id"),
        _site(host).alias("host"),
        _site(section).alias("section"),
        F.col(text_column).alias("text"),
        _digest(F.col(text_column)).alias("digest"),
    )
    rows = stored(map_rows(texts, evidence, f"host string, section string, digest string, {numbers}"), "evidence")

    sums = [F.count("*").alias("n")]
    for t in TARGETS:
        own = F.col(f"{t}_own")
        sums += [F.sum(own).alias(f"{t}_s"), F.sum(own * own).alias(f"{t}_q")]
    sections = stored(rows.groupBy("host", "section").agg(*sums), "sections")
    totals = [F.sum(c).alias(f"host_{c}") for c in sections.columns[2:]]
    hosts = stored(sections.groupBy("host").agg(F.count("*").alias("parts"), *totals), "hosts")

    shrunk = hosts
    for t in TARGETS:
        columns = ("host_n", f"host_{t}_s", f"host_{t}_q")
        rate, _ = _weight(hosts, F.lit(0.0), columns)
        _, weight = _weight(hosts, F.lit(rate), columns)
        shrunk = shrunk.withColumn(
            f"{t}_host", (F.col(columns[1]) + weight * rate) / (F.col("host_n") + weight)
        )
    shrunk = stored(shrunk.select("host", "parts", *[f"{t}_host" for t in TARGETS]), "host-rates")
    sections = stored(attach(sections, shrunk, ["host"], "parts").drop("parts"), "section-rates")
    weights = {
        t: _weight(sections, F.col(f"{t}_host"), ("n", f"{t}_s", f"{t}_q"))[1] for t in TARGETS
    }

    found = attach(rows, sections, ["host", "section"], "n")
    for t in TARGETS:
        rest = (F.col(f"{t}_s") - F.col(f"{t}_own") + weights[t] * F.col(f"{t}_host")) / (
            F.col("n") - 1 + weights[t]
        )
        prior = F.least(F.greatest(rest, F.lit(1e-6)), F.lit(1 - 1e-6))
        log_odds = F.col(f"{t}_evidence") + F.log(prior / (1 - prior))
        found = found.withColumn(f"{t}_site", prior).withColumn(f"p_{t}", 1 / (1 + F.exp(-log_odds)))
    learned = any(m.coefficients for m in models.values())
    rejected = F.greatest(*[F.col(f"p_{t}") for t in TARGETS]) >= REJECT_FROM
    return found.select(
        "doc_id",
        "host",
        "section",
        *[c.format(t) for t in TARGETS for c in ("{}_evidence", "{}_site", "p_{}")],
        (rejected & F.lit(learned)).alias("rejected"),
        "digest",
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    host: str = "source",
    section: str = "lang",
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Rows of ``docs``, unchanged, that are not rejected. Each row is judged by
    itself, also where rows share an id or have none."""
    found = _classified(docs, labels, host, section, id_column, text_column).where("rejected")
    names = {"doc_id": "gone_id", "digest": "gone_digest", "host": "gone_host", "section": "gone_section"}
    gone = found.select(*[F.col(c).alias(n) for c, n in names.items()]).distinct()
    match = (
        docs[id_column].eqNullSafe(gone["gone_id"])
        & (_digest(docs[text_column]) == gone["gone_digest"])
        & (_site(host) == gone["gone_host"])
        & (_site(section) == gone["gone_section"])
    )
    return docs.join(gone, match, "left_anti")
