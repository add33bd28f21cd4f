"""
Quality by importance resampling.

Two generative models give the probability of hashed n-grams: one of the target text (labelled
as good and not toxic), one of all the raw text. An n-gram here is a word, two words in a row,
the first 4, 5 or 6 bytes of a longer word, or the last two bytes of a space-delimited token. A
document's weight is the sum of the log ratios of all its n-grams over the root of its number of
words, so text like the target weighs up, and junk, insults and strings the target never holds
weigh down. The expected target count of an n-gram follows from the raw model; ``PRIOR`` is added
to both. Each ratio is scaled by how sure its counts make it that the models differ: from
``FLOOR`` for what rests on a few places to 1; no ratio is left out.

Documents are drawn without replacement by Gumbel top-k: the k largest of weight / TEMPERATURE
plus Gumbel noise, where the noise is a hash of the row, so every run draws the same. k is the
number of documents with a weight above the value that best divides the labelled ones, where a
good one is weighed without its own share in the target.

Raw counts cover all documents. The target model and the division use at most about ``SAMPLE``
labelled ids, chosen by a hash, the division one row of each. A model is ``BUCKETS`` numbers at any input size.

Texts without n-grams (null and empty ones too) have weight 0: as likely in the target as in the raw text. Labels that are null or name no document are not used; of
several labels of one id the worst counts. Without labels of either kind all documents are kept. Documents
equal in id and text draw the same. Rows whose noisy weight equals the k-th are all kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.base import ship_package, stored
from tallybrook.llm.tokens import MARKS, SPACE, Slices, groups, shingle_hashes, word_spans

BITS = 20
BUCKETS = 1 << BITS
SAMPLE = 200_000
PRIOR, DOUBT, FLOOR = 0.5, 10.0, 0.05
TEMPERATURE = 0.01
# Names that no table has.
WEIGHT, NOISY = (f"{name}-{uuid4().hex}" for name in ("weight", "noisy"))


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket) of each n-gram, and the number of words of each row."""
    slices, rows, buckets = Slices(data), [], []

    def put(row, hashes):
        rows.append(row)
        buckets.append((hashes >> np.uint64(64 - BITS)).astype(np.int64))

    def add(starts, ends, kind):
        put(np.searchsorted(offsets, starts, "right") - 1, slices.hashes(starts, ends, kind))

    starts, ends = word_spans(data, offsets, MARKS)
    add(starts, ends, 1)
    words = np.bincount(rows[0], minlength=len(offsets) - 1)
    pairs, edges = shingle_hashes(slices.hashes(starts, ends), np.searchsorted(starts, offsets), 2, short=False)
    put(np.repeat(np.arange(len(edges) - 1), np.diff(edges)), pairs)
    for size in (4, 5, 6):
        long = ends - starts > size
        add(starts[long], starts[long] + size, 1 + size)
    starts, ends = word_spans(data, offsets, SPACE)
    add(np.maximum(starts, ends - 2), ends, 9)
    return np.concatenate(rows), np.concatenate(buckets), words


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each bucket this task has seen: its count in all texts and in the target's."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        good = np.asarray(batch.column("good").fill_null(False).to_numpy(zero_copy_only=False), bool)
        for first, data, offsets in groups(batch.column("text")):
            row, bucket, _ = features(data, offsets)
            # In place: an array of all buckets for every group would be more work than its texts.
            np.add.at(raw, bucket, 1)
            np.add.at(target, bucket[good[first:first + len(offsets) - 1][row]], 1)
    seen = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])],
                                     ["bucket", "raw", "target"])


@dataclass(frozen=True)
class Model:
    """Log ratios by bucket, and the weight from which on a document counts as good."""

    ratios: np.ndarray
    least: float = float("-inf")


def _scorer(ratios, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = np.zeros(batch.num_rows)
            for first, data, offsets in groups(batch.column("text")):
                row, bucket, words = features(data, offsets)
                rows = len(offsets) - 1
                sums = np.bincount(row, weights=ratios.value[bucket], minlength=rows)
                weights[first:first + rows] = sums / np.sqrt(np.maximum(words, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(weights)], [*batch.schema.names, name])

    return run


def weighed(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column ``WEIGHT``."""
    ship_package(docs.sparkSession)
    ratios = docs.sparkSession.sparkContext.broadcast(model.ratios)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{WEIGHT}` double"
    return docs.mapInArrow(_scorer(ratios, WEIGHT), schema)


def sampled_labels(labels: DataFrame) -> DataFrame:
    """``id, good`` of about ``SAMPLE`` labelled rows at most, one per id."""
    known = labels.filter("doc_id is not null and quality is not null and toxic is not null").groupBy(
        F.col("doc_id").alias("id")).agg((F.min((F.col("quality") == 1) & (F.col("toxic") == 0))).alias("good"))
    count = known.count()
    if count <= SAMPLE:
        return known
    return known.filter(F.pmod(F.xxhash64("id"), F.lit(count)) < SAMPLE)


def log_ratios(target: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """Log ratios of target counts to expected ones, scaled by the evidence for them."""
    told = np.where(target > 0, target * np.log(np.maximum(target, 1) / np.maximum(expected, 1e-9)), 0)
    # The log of how much likelier the target count is under its own rate than under the raw one.
    sure = 1 / (1 + np.exp(np.minimum(DOUBT - (told - target + expected), 50)))
    return np.log((target + PRIOR) / (expected + PRIOR)) * (FLOOR + (1 - FLOOR) * sure)


def _rate(held):
    """``good, weight`` of labelled rows; good ones weigh as if the target did not hold them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, raw, share, ratios = held.value
        for batch in batches:
            weights = np.zeros(batch.num_rows)
            good = np.asarray(batch.column("good").to_numpy(zero_copy_only=False), bool)
            for first, data, offsets in groups(batch.column("text")):
                row, bucket, words = features(data, offsets)
                rows = len(offsets) - 1
                sums = np.bincount(row, weights=ratios[bucket], minlength=rows)
                inside = good[first:first + rows]
                keys, own = np.unique((row * BUCKETS + bucket)[inside[row]], return_counts=True)
                at = keys % BUCKETS
                without = log_ratios(np.maximum(target[at] - own, 0), np.maximum(raw[at] - own, 0) * share)
                sums[inside] = np.bincount(keys // BUCKETS, weights=without * own, minlength=rows)[inside]
                weights[first:first + rows] = sums / np.sqrt(np.maximum(words, 1))
            yield pa.RecordBatch.from_arrays([batch.column("good"), pa.array(weights)], ["good", "weight"])

    return run


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    ship_package(docs.sparkSession)
    texts = docs.select("doc_id", "text")
    # At most SAMPLE ids.
    sample = F.broadcast(sampled_labels(labels))
    marked = texts.join(sample, F.col("doc_id") == F.col("id"), "left").select("text", "good")
    counts = stored(marked.mapInArrow(_count, "bucket long, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")), "counts")
    raw, target = counts.agg(F.sum("raw"), F.sum("target")).first()
    if not target:
        return Model(np.zeros(BUCKETS, np.float32))
    # At most BUCKETS rows of three numbers.
    rows = counts.toArrow()
    held = np.zeros((2, BUCKETS), np.int64)
    held[:, rows.column("bucket").to_numpy()] = rows.column("target").to_numpy(), rows.column("raw").to_numpy()
    share = target / raw
    ratios = log_ratios(held[0], held[1] * share)
    # One row of each labelled id, so that there are as few as ids; repeated ones leave a task as one.
    own = F.min(F.struct(F.xxhash64("text").alias("key"), "text", "good")).alias("own")
    rated = texts.join(sample, F.col("doc_id") == F.col("id")).groupBy("id").agg(own).select("own.text", "own.good")
    sent = docs.sparkSession.sparkContext.broadcast((*held, share, ratios))
    rows = rated.mapInArrow(_rate(sent), "good boolean, weight double").toArrow()
    good = rows.column("good").to_numpy().astype(bool)
    return Model(ratios.astype(np.float32), dividing_weight(rows.column("weight").to_numpy(), good))


def dividing_weight(weights: np.ndarray, good: np.ndarray) -> float:
    """The value that most good rows reach and most others do not; the lowest of equally fit ones."""
    if good.all() or not good.any():
        return float("-inf")
    order = np.argsort(weights, kind="stable")
    weights, good = weights[order], good[order]
    gain = np.concatenate([[0], np.cumsum(np.where(good, -1 / good.sum(), 1 / (~good).sum()))])
    fresh = np.concatenate([[True], weights[1:] > weights[:-1], [False]])
    best = int(np.argmax(np.where(fresh, gain, -np.inf)))
    return float("-inf") if best == 0 else float((weights[best - 1] + weights[best]) / 2)


def noisy(weight: Column, *of: str) -> Column:
    """Weight / TEMPERATURE + Gumbel noise, which is a hash of the given columns."""
    even = (F.pmod(F.xxhash64(*of), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return weight / F.lit(TEMPERATURE) - F.log(-F.log(even))


def kth_largest(values: DataFrame, column: str, k: int, bins: int = 4096) -> float:
    """The k-th largest value, by narrowing histograms; only bin counts reach the driver."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    left, inside = k, values
    while low < high:
        width = (high - low) / bins
        if width <= 0 or low + width <= low:
            break
        at = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1))
        counts = inside.groupBy(at.alias("bin")).agg(
            F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        for row in sorted(counts, key=lambda r: -r["bin"]):
            if row["n"] >= left:
                low, high = row["low"], row["high"]
                break
            left -= row["n"]
        inside = values.filter(F.col(column).between(low, high))
    return low


def cut_of(weights: DataFrame, model: Model) -> float:
    """The noisy weight from which on documents are drawn; ``weights(WEIGHT, NOISY)``."""
    k = weights.filter(F.col(WEIGHT) >= model.least).count()
    return kth_largest(weights, NOISY, k) if k else float("inf")


def _with_noise(docs: DataFrame, model: Model) -> DataFrame:
    return weighed(docs, model).withColumn(NOISY, noisy(F.col(WEIGHT), "doc_id", "text"))


def resampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents drawn, with all their columns."""
    model = fit(docs, labels)
    weights = stored(_with_noise(docs.select("doc_id", "text"), model).select(WEIGHT, NOISY), "weights")
    return _with_noise(docs, model).filter(F.col(NOISY) >= cut_of(weights, model)).drop(WEIGHT, NOISY)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, weight, noisy_weight, kept`` for every document."""
    model = fit(docs, labels)
    weights = stored(_with_noise(docs.select("doc_id", "text"), model).select("doc_id", WEIGHT, NOISY), "weights")
    return weights.select("doc_id", F.col(WEIGHT).alias("weight"), F.col(NOISY).alias("noisy_weight"),
                          (F.col(NOISY) >= cut_of(weights, model)).alias("kept"))
