"""A quality classifier: document evidence, and host and path rates by hierarchical empirical Bayes.

The evidence of a document is the log likelihood ratio of a logistic model over word, prefix and
shape features that grouped counts select from labelled rows. Every document's probability then goes
into the rates of its host and of its path; sparse paths shrink towards their host, sparse hosts
towards the corpus. A document's posterior odds are its evidence times the odds of its path's rate
without its own share.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import released, stored, utf8

EDGE = " \t\r\n.,;:!?\"'()[]{}#*$%&|<>-_0123456789"
UPPER = re.compile("[A-ZÀ-ÖØ-Þ]+")
LETTER = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
PREFIXES = (4, 5, 6)
LEAST_RATE = 1e-3
# Chance exceeds this for one feature in a thousand; the penalty holds those down.
LEAST_STATISTIC = 10.8


def words_of(text: str) -> set[str]:
    return {w.strip(EDGE) for w in set(text.lower().split())}


def tenth(part: float, whole: float) -> int:
    return min(10, int(10 * part / whole)) if whole else 0


def shape_of(text: str) -> list[str]:
    """Features of the form of a text: the tenths that each share exceeds or reaches."""
    words = text.split()
    n = len(words)
    lines = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(len, LETTER.findall(text)))
    symbols = sum(map(text.count, "#*$%&|<>"))
    marks = text.count("!") + text.count("?")
    runs = sum(a == b for a, b in zip(words, words[1:]))
    shares = {
        "symbols": tenth(symbols, n), "marks": tenth(marks, n), "runs": tenth(runs, n),
        "upper": tenth(sum(map(len, UPPER.findall(text))), letters),
        "lines": tenth(len(lines) - len(set(lines)), len(lines)),
        "letters": tenth(letters, len(text)), "distinct": tenth(len(set(words)), n),
        "bars": tenth(10 * text.count("|"), n),
    }
    # A step holds for all larger values as well.
    return [f"\x00{name}>{step}" for name, value in shares.items() for step in range(value)]


def features_of(text: str) -> set[str]:
    """Words, their beginnings (marked) and the shape features of a text."""
    words = words_of(text)
    found = set(shape_of(text)) | words
    for k in PREFIXES:
        found.update(f"{w[:k]}~" for w in words if len(w) > k)
    found.discard("")
    return found


@dataclass
class Model:
    """Feature weights on the log scale, the intercept, and the rate of bad rows fitted on."""

    weights: dict[str, float] = field(default_factory=dict)
    intercept: float = 0.0
    rate: float = 0.0

    def evidence(self, text: str) -> float:
        if not self.weights:
            return 0.0
        get = self.weights.get
        total = self.intercept
        words = words_of(text)
        for w in words:
            total += get(w, 0.0)
        for k in PREFIXES:
            for prefix in {w[:k] for w in words if len(w) > k}:
                total += get(f"{prefix}~", 0.0)
        for name in shape_of(text):
            total += get(name, 0.0)
        return total - math.log(self.rate / (1 - self.rate))


def logistic(rows: list[np.ndarray], bad: np.ndarray, width: int, penalty: float, rounds: int = 500) -> tuple[np.ndarray, float]:
    """Weights and intercept of a penalised logistic model over presence features, by Adam."""
    index = np.concatenate(rows) if rows else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    weights = np.zeros(width + 1)
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, rounds + 1):
        score = np.bincount(owner, weights[index], len(rows)) + weights[-1]
        off = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - bad
        slope = np.append(np.bincount(index, off[owner], width), off.sum()) / len(rows)
        slope[:-1] += penalty * weights[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        weights = weights - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights[:-1], float(weights[-1])


def fit(
    docs: DataFrame, labels: DataFrame, bad: Column, id_col: str = "doc_id", text_col: str = "text",
    sample_rows: int = 20_000, max_features: int = 4096, penalty: float = 1e-5,
) -> Model:
    """Fit the document model on at most sample_rows labelled ids, chosen by a hash of the id.

    bad: whether a row of labels marks a bad document; an id is bad if one of its rows says so, and
    rows without an id or label are not used. Texts that occur more than once count once. Features
    are chosen by their likelihood-ratio statistic over grouped counts, at most max_features of those
    beyond LEAST_STATISTIC. The driver gets the chosen features and
    their indexes per sampled row, whose number the two parameters bound. Without rows of either
    kind the model has no features and all evidence is 0.
    """
    spark = docs.sparkSession
    chosen = (
        labels.select(F.col(id_col).alias("id"), bad.cast("int").alias("bad")).dropna()
        .groupBy("id").agg(F.max("bad").alias("bad")).orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    )
    texts = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text"))
    # The chosen labels have at most sample_rows rows, so no text is moved to find theirs.
    sample = texts.join(F.broadcast(chosen), "id").groupBy("text").agg(F.max("bad").alias("bad"))
    sample = stored(sample, "labelled")

    def spelled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(features_of(t)) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([batch.column(1), pa.array(found, pa.list_(pa.string()))], names=["bad", "features"])

    total = sample.agg(F.count("*").alias("n"), F.sum("bad").alias("bad")).first()
    n, n_bad = total["n"], total["bad"] or 0
    if n_bad in (0, n):
        return Model()
    counts = (
        sample.mapInArrow(spelled, "bad int, features array<string>").select("bad", F.explode("features").alias("feature"))
        .groupBy("feature").agg(F.count("*").cast("double").alias("df"), F.sum("bad").cast("double").alias("b"))
    )
    rate = n_bad / n
    part = lambda a, e: F.when(a > 0, a * F.log(a / e)).otherwise(0.0)
    stat = 2 * (
        part(F.col("b"), F.col("df") * rate) + part(F.col("df") - F.col("b"), F.col("df") * (1 - rate))
        + part(n_bad - F.col("b"), (n - F.col("df")) * rate)
        + part(n - n_bad - F.col("df") + F.col("b"), (n - F.col("df")) * (1 - rate))
    )
    counts = stored(counts.select("feature", stat.alias("stat")), "features")
    top = counts.where(F.col("stat") > LEAST_STATISTIC).orderBy(F.desc("stat"), "feature").limit(max_features).collect()
    index = {r["feature"]: i for i, r in enumerate(top)}

    def indexed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(index[f] for f in features_of(t) if f in index) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["bad", "at"])

    held = sample.mapInArrow(indexed, "bad int, at array<int>").toPandas()
    rows = [np.asarray(a, np.int64) for a in held["at"]]
    weights, intercept = logistic(rows, held["bad"].to_numpy(float), len(index), penalty)
    return Model({f: float(weights[i]) for f, i in index.items() if abs(weights[i]) > 1e-6}, intercept, rate)


def with_evidence(docs: DataFrame, model: Model, name: str, text_col: str = "text") -> DataFrame:
    """The same rows and columns with the evidence of each whole text as a column of that name."""
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema)
    at, columns = docs.columns.index(text_col), docs.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.evidence(t or "") for t in batch.column(at).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(scores, pa.float64())], names=[*columns, name])

    return docs.mapInArrow(lambda batches: released(run(batches)), f"{fields}, `{name}` double")


def strength(groups: DataFrame, rate: float) -> float:
    """How many documents the prior of a level weighs, from the spread of its groups' rates."""
    off = F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("above"), 2))
    r = groups.agg(off.alias("off"), F.count("*").alias("groups"), F.sum("n").alias("n")).first()
    if not r["n"]:
        return 1.0
    chance = rate * (1 - rate)
    between = r["off"] / r["n"] - chance * r["groups"] / r["n"]
    return min(1e4, max(1.0, chance / between - 1)) if between > 0 else 1e4


def judge(
    docs: DataFrame, model: Model, host: Column, path: Column, text_col: str = "text", prefix: str = "__",
    keep: list[str] | None = None,
) -> DataFrame:
    """The rows of docs with {prefix}evidence, {prefix}host_rate, {prefix}path_rate, {prefix}posterior
    and {prefix}kept, false where the posterior probability of a bad document is a half or more.

    A null host or path is a group of its own. Empty and null texts have the evidence of their shape.
    A model without features keeps all. Repeated rows count each; an empty table gives an empty
    result. docs may have any other columns but ones that begin with the prefix; keep names those that
    the result has, all by default.
    """
    quoted = lambda columns: [f"`{c.replace('`', '``')}`" for c in columns]
    names = quoted(keep or docs.columns)
    h, p, e = f"{prefix}host", f"{prefix}path", f"{prefix}evidence"
    key = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))
    scored = with_evidence(docs.select(*quoted(docs.columns), key(host).alias(h), key(path).alias(p)), model, e, text_col)
    scored = stored(scored.select(*names, h, p, e), "evidence")
    base = min(1 - LEAST_RATE, max(LEAST_RATE, model.rate))
    own = 1 / (1 + F.exp(-(F.col(e) + math.log(base / (1 - base)))))
    narrow = scored.select(h, p, own.alias("s"))
    paths = stored(narrow.groupBy(h, p).agg(F.count("*").alias("n"), F.sum("s").alias("s")), "paths")
    hosts = paths.groupBy(h).agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    whole = paths.agg(F.sum("s") / F.sum("n")).first()[0]
    whole = base if whole is None else min(1 - LEAST_RATE, max(LEAST_RATE, whole))
    k_host = strength(hosts.withColumn("above", F.lit(whole)), whole)
    host_rates = hosts.select(h, F.col("n").alias("nh"), F.col("s").alias("sh"), (F.col("s") / F.col("n")).alias("above"))
    both = paths.join(host_rates, h)
    k_path = strength(both, whole)
    sites = both.select(h, p, F.col("n").alias(f"{prefix}n"), F.col("s").alias(f"{prefix}s"),
                        F.col("nh").alias(f"{prefix}nh"), F.col("sh").alias(f"{prefix}sh"))
    c = lambda name: F.col(f"{prefix}{name}")
    joined = scored.join(sites, [h, p]).withColumn(f"{prefix}own", own)
    joined = joined.withColumn(
        f"{prefix}host_rate", (c("sh") - c("own") + k_host * whole) / (c("nh") - 1 + k_host))
    joined = joined.withColumn(
        f"{prefix}path_rate", (c("s") - c("own") + k_path * c("host_rate")) / (c("n") - 1 + k_path))
    prior = F.greatest(F.lit(LEAST_RATE), F.least(F.lit(1 - LEAST_RATE), c("path_rate")))
    posterior = 1 / (1 + F.exp(-(c("evidence") + F.log(prior / (1 - prior)))))
    joined = joined.withColumn(f"{prefix}posterior", posterior)
    kept = c("posterior") < 0.5 if model.weights else F.lit(True)
    return joined.select(*names, c("evidence"), c("host_rate"), c("path_rate"), c("posterior"), kept.alias(f"{prefix}kept"))
