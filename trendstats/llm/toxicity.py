"""Toxicity by weak supervision.

1. Voters. Words (``word``), word beginnings (``begi-``) and beginnings of
   at least every 200th word (``begi=``) that are much more frequent in toxic
   than in clean labelled training texts (a bounded sample of labelled rows;
   near copies of a toxic text, those of one SimHash class, count once).
2. Label model. Each voter votes "toxic" where its pattern occurs and
   abstains elsewhere. A generative model over the votes of all training
   rows, labelled or not, estimates every voter's accuracy by expectation
   maximisation (labels of the sample are held fixed) and the correlations
   between voters; voters that fire together share their weight.
3. Classifier. A logistic regression over the pattern features and the
   number and density of the words that match, trained on the label model's
   posterior labels of a bounded sample.

Scale: documents are scanned in Arrow batches and never shuffled; labels
reach the scans as a broadcast of at most ``label_rows`` rows. Votes are
grouped by vote set before each round; the driver sees a row per voter (or
pair of voters), never documents, but for the classifier's sample of at
most ``fit_rows`` feature rows.

Defined cases: null and empty texts have no pattern and get the score of a
text without any; rows with a null id are never learned from; null labels
are ignored, of repeated labels of an id the largest counts; repeated
documents each get a row (and count once in the classifier's sample); without a labelled toxic and a labelled clean
training row there are no voters and every score is ``PRIOR``; an empty
table gives an empty result; other columns (language, source, labels) are
never read by a score.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendstats.llm import simhash
from trendstats.llm.common import cut, lowest, spare
from trendstats.llm.graph import connected_components

LABEL_ROWS = 50_000  # labelled rows that voters are mined from, at most
FIT_ROWS = 20_000  # rows that the classifier is fitted on, at most
VOTERS = 96
FEATURES = 512
PREFIXES = (4, 5, 6, 7)
DENSE = 200
SUPPORT = 0.004  # a pattern must occur in this share of the toxic sample
ENRICHED = 1.5  # and be e**1.5 times as frequent as in clean texts;
CHANCE = 0.01  # bound on the chance that any pattern passes by accident
PRIOR = 0.01
ROUNDS = 4
_WORD = re.compile(r"[^\W\d_]+")
_FLUSH = 200_000


def _words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def patterns_of(text: str | None) -> set[str]:
    """All patterns of a text."""
    words = _words(text)
    counts = Counter(words)
    out = set(counts)
    for n in PREFIXES:
        starts: Counter = Counter()
        for w, k in counts.items():
            if len(w) >= n:
                starts[w[:n]] += k
        out.update([p + "-" for p in starts])
        out.update([p + "=" for p, k in starts.items() if k * DENSE >= len(words)])
    return out


class Finder:
    """Which of the given patterns occur in a text, and how many of its
    words match any of them."""

    def __init__(self, patterns: list[str]):
        self.words = {p: i for i, p in enumerate(patterns) if p[-1] not in "-="}
        self.starts = []
        for n in PREFIXES:
            own = {p: i for i, p in enumerate(patterns) if p[-1] in "-=" and len(p) == n + 1}
            self.starts.append((n, {p[:-1] for p in own}, own))

    def find(self, text: str | None) -> tuple[list[int], int, int]:
        words = _words(text)
        distinct = set(words)
        matched = {w: words.count(w) for w in distinct & self.words.keys()}
        found = [self.words[w] for w in matched]
        for n, starts, own in self.starts:
            seen = {w[:n] for w in distinct} & starts if starts else ()
            if seen:
                counts: Counter = Counter()
                for w in distinct:
                    if w[:n] in seen:
                        matched[w] = k = matched.get(w) or words.count(w)
                        counts[w[:n]] += k
                for p, k in counts.items():
                    if p + "-" in own:
                        found.append(own[p + "-"])
                    if p + "=" in own and k * DENSE >= len(words):
                        found.append(own[p + "="])
        return sorted(found), sum(matched.values()), len(words)


EXTRA = 4  # features beside the patterns


def amounts(hits, words):
    """Number and density of matching words as classifier features."""
    rate = 100.0 * hits / np.maximum(words, 1)
    return np.stack([np.minimum(rate, 5.0), np.log1p(np.minimum(hits, 50)), hits >= 2, (hits >= 2) & (rate >= 0.5)], axis=-1).astype(float)


_FINDERS: dict[str, Finder] = {}


def _finder(patterns: list[str]) -> Finder:
    key = hashlib.sha256("\n".join(patterns).encode()).hexdigest()
    if key not in _FINDERS:
        _FINDERS.clear()
        _FINDERS[key] = Finder(patterns)
    return _FINDERS[key]


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


# --- voters ------------------------------------------------------------------


def _one_of_each(toxic: DataFrame) -> DataFrame:
    """``text`` of one row of each class of near copies (SimHash, as in the
    near-duplicate operator) of ``(doc_id, text)`` rows."""
    marked = cut(toxic.select("doc_id", "text", simhash.fingerprint(F.col("text")).alias("fp")))
    classes = connected_components(simhash.links(marked.select("fp").distinct())).withColumnRenamed("node", "fp")
    found = marked.join(classes, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    found = found.groupBy("component").agg(F.min_by("text", F.struct("doc_id", F.xxhash64("text"))).alias("text"))
    return cut(found.select("text"))


def _counted(texts: DataFrame, wanted: set[str] | None) -> DataFrame:
    """``(pattern, n)``: texts of the single column that hold the pattern
    (one of ``wanted``, if given); partial counts leave each task before the
    shuffle."""
    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(counts.keys()), pa.string()), pa.array(list(counts.values()), pa.int64())], ["pattern", "n"]
            )
            counts.clear()
            return batch

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(patterns_of(text) if shared.value is None else patterns_of(text) & shared.value)
                if len(counts) > _FLUSH:
                    yield out()
        yield out()

    return texts.mapInArrow(run, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))


@dataclass
class Voters:
    patterns: list[str] = field(default_factory=list)
    n_toxic: int = 0
    n_clean: int = 0


def mine(labelled: DataFrame, features: int = FEATURES) -> Voters:
    """Patterns of ``(doc_id, text, toxic)`` rows, best first."""
    toxic = _one_of_each(labelled.where("toxic = 1"))
    clean = labelled.where("toxic = 0").select("text")
    n1, n0 = toxic.count(), clean.count()
    if not n1 or not n0:
        return Voters()
    least = max(2, math.ceil(SUPPORT * n1))
    # a pattern needs `least` texts, so their number is bounded by the share
    ones = {r["pattern"]: r["n"] for r in _counted(toxic, None).where(F.col("n") >= least).toLocalIterator()}
    zeros = {r["pattern"]: r["n"] for r in _counted(clean, set(ones)).toLocalIterator()}
    rated, rate, needed = [], n1 / (n1 + n0), math.log(max(1, len(ones)) / CHANCE)
    for p, n in ones.items():
        z = zeros.get(p, 0)
        gain = math.log((n + 0.5) / (n1 + 1)) - math.log((z + 0.5) / (n0 + 1))
        # Chernoff bound on n or more toxic among n + z texts at the base rate
        share = n / (n + z)
        proof = n * math.log(share / rate) + (z * math.log((1 - share) / (1 - rate)) if z else 0.0)
        if gain >= ENRICHED and share > rate and proof >= needed:
            rated.append((-proof, p))
    # of patterns that start alike and occur equally often the longest stays
    same: dict[tuple, tuple[float, str]] = {}
    for proof, p in rated:
        key = (p[:4], p[-1] == "=", ones[p], zeros.get(p, 0))
        if key not in same or len(p.rstrip("-=")) > len(same[key][1].rstrip("-=")):
            same[key] = (proof, p)
    return Voters([p for _, p in sorted(same.values())[:features]], n1, n0)


def found_in(text: Column, patterns: list[str], spark) -> Column:
    """Struct of the patterns' indices in each text, its matching words and
    its words."""
    shared = spark.sparkContext.broadcast(patterns)

    @F.pandas_udf("found array<int>, hits long, words long")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        finder = _finder(shared.value)
        for texts in batches:
            yield pd.DataFrame([finder.find(t) for t in texts], columns=["found", "hits", "words"])

    return find(text)


# --- label model -------------------------------------------------------------


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


@dataclass
class LabelModel:
    prior: float
    accuracy: np.ndarray  # P(toxic | the voter fires)
    correlation: np.ndarray  # of firing, among toxic rows
    weight: np.ndarray  # share of the evidence, from the correlations

    def terms(self) -> np.ndarray:
        return self.weight * (_logit(self.accuracy) - _logit(self.prior))

    def posterior(self, votes: Column) -> Column:
        """P(toxic) of an array of voter indices."""
        terms = F.array(*[F.lit(float(x)) for x in self.terms()])
        total = F.aggregate(votes, F.lit(float(_logit(self.prior))), lambda a, v: a + F.get(terms, v))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit_label_model(votes: DataFrame, voters: int, rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation over ``(votes, toxic or null)`` rows."""
    sets = cut(votes.groupBy("votes", "toxic").agg(F.count(F.lit(1)).alias("n")))
    label = F.col("toxic").cast("double")

    def sums(q: Column) -> tuple[np.ndarray, np.ndarray]:
        """Rows and toxic mass of each pair of voters that fire together;
        index ``voters`` stands for every row."""
        ids = F.array_append("votes", F.lit(voters))
        rows = sets.select(F.explode(ids).alias("i"), ids.alias("ids"), "n", (F.col("n") * q).alias("x"))
        rows = rows.select("i", F.explode("ids").alias("j"), "n", "x")
        n, x = np.zeros((voters + 1, voters + 1)), np.zeros((voters + 1, voters + 1))
        for r in rows.groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect():
            n[r["i"], r["j"]], x[r["i"], r["j"]] = r["n"], r["x"] or 0.0
        return n, x

    # start from the labelled rows
    known = sets.where("toxic is not null").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("toxic")).alias("t")).first()
    prior = (known["t"] + 0.5) / (known["n"] + 1)
    n, x = sums(label)
    accuracy = (x.diagonal()[:voters] + 2 * prior) / (x.diagonal()[:voters] + 2 + sums(1 - label)[1].diagonal()[:voters])
    model = LabelModel(prior, accuracy, np.eye(voters), np.ones(voters))
    for _ in range(rounds):
        _, x = sums(F.coalesce(label, model.posterior(F.col("votes"))))
        total = max(1e-9, x[voters, voters])
        p = x.diagonal()[:voters] / total
        spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
        rho = (x[:voters, :voters] / total - np.outer(p, p)) / np.outer(spread, spread)
        np.fill_diagonal(rho, 1.0)
        # voters that fire together count as one: rho of 0.5 or more
        weight = 1.0 / np.where(rho >= 0.5, rho, 0.0).clip(0, 1).sum(axis=1)
        accuracy = (x.diagonal()[:voters] + 2 * prior) / (n.diagonal()[:voters] + 2)
        model = LabelModel(prior, accuracy, rho, weight)
    return model


# --- classifier --------------------------------------------------------------


@dataclass
class Classifier:
    patterns: list[str]
    coef: np.ndarray
    bias: float

    def score(self, text: Column, spark) -> Column:
        shared = spark.sparkContext.broadcast((self.patterns, self.coef, self.bias))

        @F.pandas_udf("double")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            patterns, coef, bias = shared.value
            finder = _finder(patterns)
            for texts in batches:
                seen = [finder.find(t) for t in texts]
                margin = np.array([bias + coef[found].sum() for found, _, _ in seen], dtype=float)
                if len(seen):
                    margin += amounts(np.array([h for _, h, _ in seen]), np.array([w for _, _, w in seen])) @ coef[-EXTRA:]
                yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30))))

        return of(text)


def fit_linear(
    rows: list[tuple[list[int], int, int, float, float]], width: int, steps: int = 25, ridge: float = 0.2
) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps on rows of ``(found, hits, words,
    rows, toxic mass)``; the last ``EXTRA`` coefficients are of the amounts."""
    x = np.zeros((len(rows), width + EXTRA + 1))
    x[:, -1] = 1.0
    for i, row in enumerate(rows):
        x[i, row[0]] = 1.0
    x[:, width:-1] = amounts(np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
    width += EXTRA
    n, mass = np.array([r[3] for r in rows], dtype=float), np.array([r[4] for r in rows], dtype=float)
    coef = np.zeros(width + 1)
    coef[width] = _logit(mass.sum() / n.sum())
    penalty = np.append(np.full(width, ridge), 1e-6)
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ coef, -30, 30)))
        slope = x.T @ (n * p - mass) + penalty * coef
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-6), slope)
        coef -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return coef[:width], float(coef[width])


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    label_rows: int = LABEL_ROWS,
    fit_rows: int = FIT_ROWS,
) -> Classifier:
    spark = docs.sparkSession
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.where(~held_out(F.col(id_col))).groupBy(F.col(id_col).alias("doc_id"))
    known = known.agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic"))
    # bounded: at most label_rows rows, always the same ones
    known = lowest(known, label_rows, F.xxhash64("doc_id"), "doc_id")
    texts = docs.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    texts = texts.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    mined = mine(texts.join(F.broadcast(known), "doc_id"))
    if not mined.patterns:
        return Classifier([], np.zeros(EXTRA), float(_logit(PRIOR)))
    width = min(VOTERS, len(mined.patterns))
    seen = found_in(F.col("text"), mined.patterns, spark)
    marked = cut(texts.join(F.broadcast(known), "doc_id", "left").select("doc_id", "toxic", seen.alias("s")).select("doc_id", "toxic", "s.*"))
    votes = F.filter("found", lambda j: j < width)
    model = fit_label_model(marked.select(votes.alias("votes"), "toxic"), width)
    label = F.coalesce(F.col("toxic").cast("double"), model.posterior(votes))
    sample = lowest(marked, fit_rows, F.xxhash64("doc_id"), "doc_id", "found", "hits", "words")
    # texts without a match differ in length only, which no feature shows then
    words = F.when(F.col("hits") > 0, F.col("words")).otherwise(0).alias("words")
    sample = sample.groupBy("found", "hits", words).agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("mass"))
    rows = [tuple(r) for r in sample.orderBy("found", "hits", "words").toLocalIterator()]
    coef, bias = fit_linear(rows, len(mined.patterns))
    return Classifier(mined.patterns, coef, bias)


def scored(docs: DataFrame, labels: DataFrame, into: str, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the score (0 to 1) in the column ``into``."""
    model = train(docs, labels, text_col=text_col, **options)
    return docs.withColumn(into, model.score(F.col(text_col), docs.sparkSession))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """``docs`` without those that score ``threshold`` or more."""
    into = spare(docs, "__score")
    return scored(docs, labels, into, **options).where(F.col(into) < threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
