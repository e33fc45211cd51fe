"""Quality classifier: document evidence combined with host and path priors (empirical Bayes).

Method: a logistic classifier over character and word statistics gives each document
a log-likelihood ratio, its evidence. Grouped sums of the classifier's probabilities
give every host and every path a posterior share of good documents: a host's share
is shrunk toward the global one, a path's toward its host's, each as a beta prior
whose strength is estimated from how much sites differ beyond what their sizes
explain (method of moments). Sparse sites thus stay near their parent. A
document's posterior log-odds are its evidence plus its path's, bounded so that a
site alone cannot outweigh clear evidence; it is kept at a probability of at least
``KEEP``.

The classifier is fitted on a bounded sample, the ``SAMPLE_ROWS`` labelled rows of
smallest id hash outside the held-out fold (crc32 of the id as text, modulo 5, is 0)
and of at most ``SAMPLE_CHARS`` characters. Site statistics cover all documents, by
map-side combined sums. The site table is joined without a hint.

Defined cases: null or empty text (no words) has the lowest evidence; a null host or
path is a site of its own, the empty name; without both classes in the sample the
evidence of every text with words is 0; repeated rows count each in the sites, once in the fit; an empty table gives no rows. Other columns
are kept by ``keep_good`` and not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import free_names, slices, text_bytes, word_hashes, word_spans, written

SAMPLE_ROWS = 6000
SAMPLE_CHARS = 20_000
KEEP = 0.5
MAX_EVIDENCE = 8.0
MAX_SITE = 2.0
_CLASSES = np.full(256, 5, np.int64)  # 0 lower or non-ASCII letters, 1 upper, 2 digits, 3 white, 4 common marks, 5 others
_CLASSES[97:123] = _CLASSES[128:] = 0
_CLASSES[65:91] = 1
_CLASSES[48:58] = 2
_CLASSES[[9, 10, 11, 12, 13, 32]] = 3
_CLASSES[[ord(c) for c in ".,;:?'\"()-"]] = 4
N_FEATURES = 11


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Statistics of every text (rows x N_FEATURES) and the number of its words."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    rows = np.repeat(np.arange(n), np.diff(offsets))
    counts = np.bincount(rows * 6 + _CLASSES[data], minlength=6 * n).reshape(n, 6).astype(float)
    starts, ends, word_rows = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends, lower=True)
    words = np.bincount(word_rows, minlength=n).astype(float)
    per_word = np.maximum(words, 1)
    ends_odd = np.bincount(word_rows, weights=_CLASSES[data[ends - 1]] == 5, minlength=n)
    lone = np.bincount(word_rows, weights=(ends - starts == 1) & (_CLASSES[data[starts]] == 5), minlength=n)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (word_rows[1:] == word_rows[:-1])
    order = np.lexsort((hashes, word_rows))
    h, r = hashes[order], word_rows[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    distinct = np.bincount(r[new], minlength=n)
    share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    x = np.column_stack([
        np.sqrt(share[:, 1:]), np.sqrt(ends_odd / per_word), np.sqrt(lone / per_word),
        np.sqrt(np.bincount(word_rows, weights=same, minlength=n) / per_word),
        np.log1p(distinct) / np.log(per_word + 2), np.bincount(word_rows, weights=ends - starts, minlength=n) / per_word / 10,
        np.log1p(words) / 10])
    return x, words


@dataclass
class Model:
    """Standardised logistic regression; ``prior`` is the log-odds of the sample."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float
    base: float

    def evidence(self, column: pa.Array) -> np.ndarray:
        """Log-likelihood ratio of good against bad of every text."""
        x, words = features(column)
        z = ((x - self.mean) / self.scale) @ self.weights[1:] + self.weights[0] - self.prior
        z = np.clip(z, -MAX_EVIDENCE, MAX_EVIDENCE) if len(z) else z
        return np.round(np.where(words > 0, z, -MAX_EVIDENCE), 9)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> Model:
    base = float(y.mean()) if len(y) else 0.5
    if not len(y) or not 0 < base < 1:
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES + 1), 0.0, min(max(base, 0.01), 0.99))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    a = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(a.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty, a.T @ (y - p) - penalty @ w)
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return Model(mean, scale, w, float(np.log(base / (1 - base))), base)


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on a bounded sample of labelled rows outside the held-out fold."""
    def feature_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x, _ = features(part.column("text"))
                at = np.arange(part.num_rows + 1, dtype=np.int32) * N_FEATURES
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("quality"),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(x.reshape(-1)))], names=["doc_id", "quality", "x"])

    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
              .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held)
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    found = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
             .where(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(chosen), "doc_id")  # at most ``rows`` ids
             .select("doc_id", "quality", "text")
             .mapInArrow(feature_task, "doc_id long, quality int, x array<double>")
             .groupBy("doc_id", "quality").agg(F.min("x").alias("x"))  # one row for a repeated id: ``rows`` rows at most
             .toArrow().sort_by("doc_id"))
    x = found.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
    return fit(x, found.column("quality").to_numpy().astype(float))


def _site(host: Column, path: Column) -> list[Column]:
    return [F.coalesce(host.cast("string"), F.lit("")).alias("_host"), F.coalesce(path.cast("string"), F.lit("")).alias("_path")]


def evidence(docs: DataFrame, model: Model, host: Column, path: Column) -> DataFrame:
    """(doc_id, _host, _path, llr) of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("_host", pa.string()), ("_path", pa.string()), ("llr", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("_host"), part.column("_path"),
                                                  pa.array(model.evidence(part.column("text")))], schema=schema)

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         *_site(host, path))
    return picked.mapInArrow(run, "doc_id long, _host string, _path string, llr double")


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(sites: DataFrame, parent: Column) -> float:
    """Strength of the beta prior of site shares around their parent's, by the method of moments.

    The spread of the shares beyond p(1-p)/n is what sites really differ by.
    """
    m = F.col("good") / F.col("n")
    spread, noise, var = sites.select(
        F.sum(F.col("n") * (m - parent) * (m - parent)) / F.sum("n"),
        F.sum(parent * (1 - parent)) / F.sum("n"),
        F.sum(F.col("n") * parent * (1 - parent)) / F.sum("n")).first()
    if spread is None:
        return 1.0
    return float(min(max((var or 0.0) / max(spread - noise, 1e-6) - 1, 1.0), 1e6))


def site_posteriors(found: DataFrame, base: float) -> DataFrame:
    """(_host, _path, host_posterior, path_posterior) from the evidence of all documents."""
    good = 1 / (1 + F.exp(-(F.col("llr") + F.lit(float(np.log(base / (1 - base)))))))
    paths = written(found.groupBy("_host", "_path").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(good), 6).alias("good")),
                    "paths")
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = hosts.agg(F.sum("good") / F.sum("n")).first()[0]
    share = min(max(total if total is not None else base, 0.001), 0.999)
    k_host = _strength(hosts, F.lit(share))
    hosts = written(hosts.select("_host", ((F.col("good") + k_host * share) / (F.col("n") + k_host)).alias("host_posterior")),
                    "hosts")
    both = written(paths.join(hosts, "_host"), "paths")
    k_path = _strength(both, F.col("host_posterior"))
    return written(both.select(
        "_host", "_path", "host_posterior",
        ((F.col("good") + k_path * F.col("host_posterior")) / (F.col("n") + k_path)).alias("path_posterior")), "sites")


def _posterior(llr: Column, path_posterior: Column) -> Column:
    inside = F.greatest(F.least(path_posterior, F.lit(0.999)), F.lit(0.001))
    site = F.greatest(F.least(_logit(inside), F.lit(MAX_SITE)), F.lit(-MAX_SITE))
    return 1 / (1 + F.exp(-(llr + site)))


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """doc_id, llr, host_posterior, path_posterior, quality (probability) and kept of every document."""
    model = train(docs, labels)
    found = written(evidence(docs, model, host, path), "evidence")
    sites = site_posteriors(found, model.base)
    return (found.join(sites, ["_host", "_path"])
            .withColumn("quality", F.round(_posterior(F.col("llr"), F.col("path_posterior")), 9))
            .select("doc_id", "llr", F.round("host_posterior", 9).alias("host_posterior"),
                    F.round("path_posterior", 9).alias("path_posterior"), "quality",
                    (F.col("quality") >= KEEP).alias("kept")))


def keep_good(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """The rows of the documents that are kept, with all their columns."""
    model = train(docs, labels)
    sites = site_posteriors(written(evidence(docs, model, host, path), "evidence"), model.base)
    names = docs.columns
    host_as, path_as, prior_as = free_names(names, "_host", "_path", "_path_posterior")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                site = np.clip(part.column(prior_as).to_numpy(zero_copy_only=False), 0.001, 0.999)
                site = np.clip(np.log(site / (1 - site)), -MAX_SITE, MAX_SITE)
                good = 1 / (1 + np.exp(-(model.evidence(part.column("text")) + site))) >= KEEP
                yield part.select(names).filter(pa.array(good))

    host_name, path_name = _site(host, path)
    known = sites.select(F.col("_host").alias(host_as), F.col("_path").alias(path_as), F.col("path_posterior").alias(prior_as))
    joined = (docs.select("*", host_name.alias(host_as), path_name.alias(path_as))
              .join(known, [host_as, path_as]).select(*[F.col(f"`{n}`") for n in names], prior_as))
    return joined.mapInArrow(run, docs.schema)
