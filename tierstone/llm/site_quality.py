"""Quality by hierarchical empirical Bayes: document evidence, path and host posteriors."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.common import crc_fold, extended, scratch, texts

BUCKETS = 1 << 13
BINS, SPAN = 200, 4.0
#: An unlabelled document counts for its site as this many labelled ones, by its own probability.
SOFT_WEIGHT = 0.25
#: Most labelled ids the classifier is fitted on.
FIT_ROWS = 20_000
TOKEN = re.compile(r"[^ \t\n\x0b\f\r]+")
RUNS = ((re.compile("[0-9]+"), "9"), (re.compile("[A-ZÀ-ÖØ-Þ]+"), "A"), (re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ]+"), "a"), (re.compile(r"(\W)\1+"), r"\1"))


def shape(token: str) -> str:
    """A token with letters, capitals, digits and repeated marks reduced to one character each."""
    for pattern, short in RUNS:
        token = pattern.sub(short, token)
    return token[:12]


def bucket(name: str) -> int:
    import xxhash

    return xxhash.xxh32_intdigest(name.encode("utf-8", "surrogatepass"), 5) % BUCKETS


class Features:
    """Bucket counts of a text: lower-cased tokens, token shapes, and repeats of the token before."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, int]] = {}

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(buckets, counts), each bucket once."""
        found: list[int] = []
        before = None
        if len(self.known) > 300_000:
            self.known.clear()  # only a memo
        for token in TOKEN.findall(text or ""):
            own = self.known.get(token)
            if own is None:
                own = self.known[token] = (bucket("w" + token.lower()), bucket("s" + shape(token)))
            found += own
            if token == before:
                found.append(bucket("again"))
            before = token
        return np.unique(np.array(found, np.int64), return_counts=True)


def evidence(counts: tuple[np.ndarray, np.ndarray], weights: np.ndarray) -> float:
    """Mean log-likelihood ratio of the text's features, good over bad; 0 without any."""
    buckets, n = counts
    return float(weights[buckets] @ n / n.sum()) if len(buckets) else 0.0


def feature_weights(labelled: DataFrame) -> np.ndarray:
    """Naive Bayes log-likelihood ratios per bucket, from grouped sums over the labelled texts.

    A text counts by feature frequency, so that a very long text weighs like any other.
    Only the sums, two per bucket, reach the driver.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, features = np.zeros((2, BUCKETS)), Features()
        for batch in batches:
            for good, text in zip(batch.column("good").to_pylist(), texts(batch)):
                buckets, n = features.of(text)
                if len(buckets):
                    total[int(good), buckets] += n / n.sum()
        good, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(good, pa.int64()), pa.array(at, pa.int64()), pa.array(total[good, at])], ["good", "bucket", "mass"])

    rows = labelled.select(F.col("good").cast("int").alias("good"), "text").mapInArrow(sums, "good long, bucket long, mass double")
    table = np.zeros((2, BUCKETS))
    for r in rows.groupBy("good", "bucket").agg(F.sum("mass").alias("mass")).orderBy("good", "bucket").collect():  # at most two per bucket
        table[r["good"], r["bucket"]] = round(r["mass"], 9)
    table = (table + 0.01) / (table + 0.01).sum(axis=1, keepdims=True)
    return np.log(table[1] / table[0])


def with_evidence(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """`docs` without the text, with `evidence`."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    at = docs.columns.index("text")
    schema = extended(docs.drop("text").schema, evidence="double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            found = [evidence(features.of(x), shared.value) for x in texts(batch)]
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.float64())], schema.names)

    return docs.mapInArrow(run, schema)


def calibrate(labelled: DataFrame, steps: int = 50) -> tuple[float, float]:
    """a, b of the logit a + b * evidence, by Newton steps on a histogram of labelled rows."""
    place = F.floor((F.greatest(F.least(F.col("evidence"), F.lit(SPAN)), F.lit(-SPAN)) + SPAN) / (2 * SPAN) * BINS)
    rows = labelled.groupBy(place.alias("bin"), F.col("good").cast("int").alias("good")).agg(F.count("*").alias("n")).collect()  # two per bin
    if not rows:
        return 0.0, 1.0
    x = np.array([(r["bin"] + 0.5) / BINS * 2 * SPAN - SPAN for r in rows])
    y, n = np.array([r["good"] for r in rows], float), np.array([r["n"] for r in rows], float)
    design, w = np.stack([np.ones_like(x), x], axis=1), np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (n * (y - p)) - 0.01 * w
        w += np.linalg.solve(design.T @ (design * (n * p * (1 - p))[:, None]) + 0.01 * np.eye(2), gradient)
    return float(w[0]), float(w[1])


def logit(p: Column) -> Column:
    held = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(held / (1 - held))


def shrink(sites: DataFrame, good: str, n: str, parent: Column, overall: float) -> tuple[Column, float]:
    """Posterior mean (good + s parent) / (n + s); s by moments, from how far sites scatter.

    The scatter beyond that of the binomial gives the strength s of the prior: sites that
    differ little are pulled hard. One row of sums reaches the driver.
    """
    sums = sites.agg(F.count("*").alias("k"), F.sum(n).alias("n"), F.sum(F.pow(F.col(good) - F.col(n) * parent, 2) / F.greatest(n, F.lit(1e-9))).alias("chi")).first()
    noise = max(overall * (1 - overall), 1e-6)
    if not sums["k"] or not sums["n"]:
        return parent, 1.0
    # E[(g - n m)^2 / n] = noise * (1 + (n - 1) rho), summed over sites
    rho = (sums["chi"] / noise - sums["k"]) / max(sums["n"] - sums["k"], 1e-9)
    strength = float(np.clip(1 / rho - 1 if rho > 1e-4 else 1e4, 1.0, 1e4))
    return (F.col(good) + strength * parent) / (F.col(n) + strength), strength


def assess(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, threshold: float = 0.5, fit_rows: int = FIT_ROWS, hold_out: bool = False
) -> DataFrame:
    """doc_id, host, path, p_doc, p_host, p_path, quality, kept, per document.

    p_doc is the calibrated classifier of the text alone. p_host shrinks a host's mean to the
    global mean, p_path a path's mean (a path lies within a host) to its host's; labelled
    documents count fully, others by p_doc at `SOFT_WEIGHT`. `quality` puts the document's
    evidence, relative to the global mean, on top of its path's posterior. The classifier is
    fitted on at most `fit_rows` labelled ids, by seeded order, so that no text is shuffled to
    meet its label; calibration and sites use all labels.

    With `hold_out`, labels of rows with crc32(doc_id) mod 5 = 0 are left out everywhere, to
    measure on them. Null host and path
    are sites of their own. Null text gives no evidence. Several labels of an id: the mean,
    rounded up. Repeated documents stay; texts are read whole, of any length. Without labels p_doc is a half and all are kept.
    An empty table gives no rows; a quality equal to the threshold keeps.
    """
    by_id = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg((F.avg("quality") >= 0.5).alias("good"))
    if hold_out:
        by_id = by_id.filter(crc_fold(F.col("doc_id")) != 0)
    own = docs.select("doc_id", host.cast("string").alias("host"), path.cast("string").alias("path"), "text")
    by_id = scratch(by_id, "labels")
    place = F.xxhash64("doc_id", F.lit(3))
    # hashes are uniform: twice the rows wanted lie below this limit, so that few are ranked in one task
    known = by_id.count()
    limit = min(int(min(1.0, 2 * fit_rows / max(known, 1)) * (1 << 64)), (1 << 64) - 1) - (1 << 63)
    fitted = scratch(by_id.filter(place <= limit).orderBy(place, "doc_id").limit(fit_rows), "fitted-labels")
    weights = feature_weights(docs.select("doc_id", "text").join(fitted, "doc_id"))
    scored = scratch(with_evidence(own, weights).join(by_id, "doc_id", "left"), "evidence")
    a, b = calibrate(scored.filter("good is not null"))
    p_doc = 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.greatest(F.least(F.col("evidence"), F.lit(SPAN)), F.lit(-SPAN)))))
    counted = scored.withColumn("p_doc", p_doc)
    n = F.when(F.col("good").isNotNull(), 1.0).otherwise(SOFT_WEIGHT)
    mass = F.when(F.col("good").isNotNull(), F.col("good").cast("double")).otherwise(SOFT_WEIGHT * F.col("p_doc"))
    paths = scratch(counted.groupBy("host", "path").agg(F.sum(mass).alias("g_path"), F.sum(n).alias("n_path")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("g_path").alias("g_host"), F.sum("n_path").alias("n_host"))
    sums = hosts.agg(F.sum("g_host"), F.sum("n_host")).first()
    overall = float(np.clip((sums[0] or 0) / (sums[1] or 1), 1e-3, 1 - 1e-3)) if sums[1] else 0.5
    p_host, _ = shrink(hosts, "g_host", "n_host", F.lit(overall), overall)
    hosts = hosts.select(F.col("host").alias("h"), p_host.alias("p_host"))
    sites = scratch(paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h"), "sites")
    p_path, _ = shrink(sites, "g_path", "n_path", F.col("p_host"), overall)
    sites = sites.select(F.col("host").alias("h"), F.col("path").alias("p"), "p_host", p_path.alias("p_path"))
    joined = counted.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")))
    combined = logit(F.col("p_path")) + logit(F.col("p_doc")) - logit(F.lit(overall))
    quality = 1 / (1 + F.exp(-combined))
    out = joined.withColumn("quality", F.round(quality, 6))
    return out.select("doc_id", "host", "path", *[F.round(c, 6).alias(c) for c in ("p_doc", "p_host", "p_path")], "quality", (F.col("quality") >= threshold).alias("kept"))
