"""
Fingerprints by consistent weighted sampling.

A text is a weighted set: its two-word shingles with their counts. For each term and each of
``SAMPLES`` places, r and c are drawn from Gamma(2, 1) and b from [0, 1), from a hash of the
term; with t = floor(ln w / r + b), the term's value is ln c - r (t - b + 1), and the place takes
the term and t with the smallest value. Two sets agree in a place with a probability equal to
their generalised Jaccard similarity. As (term, t) fixes the value, 16 bits of a hash of the
smallest value stand for it, so a fingerprint is ``SAMPLES`` groups of four hex digits.

A term is the 64-bit hash of its shingle. Each Python worker keeps the values at weight 1 of up to
``SLOTS`` terms it met more than once; others are drawn anew. A text of one word has that as
its term. Texts without words (null and empty ones too) have the fingerprint "" and are alike
only to each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.base import partitions, ship_package, stored
from tallybrook.llm.tokens import groups, mixed, shingle_hashes, word_hashes

SAMPLES, WORDS = 64, 2
SLOTS, STEP = 1 << 17, 1 << 9


# Two numbers of 32 bits each from a factor; five are needed a place.
FACTORS = mixed(np.arange(1, 5 * SAMPLES // 2 + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def _uniforms(terms: np.ndarray) -> np.ndarray:
    """5 * SAMPLES numbers in (0, 1) of each term, from 24 bits each."""
    bits = mixed(terms + np.uint64(1))[:, None] * FACTORS
    bits ^= bits >> np.uint64(32)
    bits *= np.uint64(0x9FB21C651E98DF25)
    bits ^= bits >> np.uint64(29)
    halves = bits.view(np.uint32)
    halves >>= np.uint32(8)
    out = halves.view(np.int32).astype(np.float32)
    out += np.float32(0.5)
    out *= np.float32(2.0 ** -24)
    return out


def _draws(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c, b by (term, place). The sum of two exponential draws is a Gamma(2, 1) draw."""
    u = _uniforms(terms)
    one, two, three, four, five = (u[:, k * SAMPLES:(k + 1) * SAMPLES] for k in range(5))
    return -np.log(one * two), np.log(-np.log(three * four)), five


def values(terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The value of each term of its weight in each place."""
    r, log_c, b = _draws(terms)
    t = np.floor(np.log(weights.astype(np.float32))[:, None] / r + b)
    return log_c - r * (t - b + 1)


def _single(terms: np.ndarray) -> np.ndarray:
    """Values at weight 1."""
    out = np.empty((len(terms), SAMPLES), np.float32)
    for a in range(0, len(terms), STEP):
        r, log_c, b = _draws(terms[a:a + STEP])
        out[a:a + STEP] = log_c - r * (np.float32(1) - b)
    return out


class _Kept:
    """Values at weight 1, of which those of terms met again are kept, one term a slot."""

    def __init__(self):
        self.terms, self.met = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.uint64)
        self.values = np.repeat(_single(np.zeros(1, np.uint64)), SLOTS, axis=0)

    def of(self, terms: np.ndarray) -> np.ndarray:
        slots = (terms >> np.uint64(64 - 17)).astype(np.int64)
        out = self.values[slots]
        missed = np.flatnonzero(self.terms[slots] != terms)
        if len(missed):
            fresh, back, counts = np.unique(terms[missed], return_inverse=True, return_counts=True)
            drawn = _single(fresh)
            out[missed] = drawn[back]
            # Sorted by term, so by slot: the first of the terms of a slot that is met again stays.
            at = (fresh >> np.uint64(64 - 17)).astype(np.int64)
            again = np.flatnonzero((counts > 1) | (self.met[at] == fresh))
            slot, first = np.unique(at[again], return_index=True)
            self.met[at] = fresh
            self.terms[slot], self.values[slot] = fresh[again[first]], drawn[again[first]]
        return out


@lru_cache(maxsize=1)
def _kept() -> _Kept:
    return _Kept()


def _weighted(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, weight), sorted by row, of the terms of some rows of bytes."""
    hashes, edges = shingle_hashes(*word_hashes(data, offsets), WORDS)
    rows = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    for a, b in zip(edges.tolist(), edges[1:].tolist()):
        hashes[a:b].sort()
    fresh = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])])) if len(rows) else rows
    return rows[fresh], hashes[fresh], np.diff(np.append(fresh, len(rows)))


def sketches(texts: pa.Array) -> list[np.ndarray | None]:
    """The codes of each text; None without words."""
    out: list[np.ndarray | None] = [None] * len(texts)
    for first, data, offsets in groups(texts):
        rows, terms, weights = _weighted(data, offsets)
        # A bounded number of terms at a time; a long text takes several steps.
        for a in range(0, len(rows), 1 << 14):
            part = slice(a, a + (1 << 14))
            held = _kept().of(terms[part])
            heavy = np.flatnonzero(weights[part] > 1)
            if len(heavy):
                held[heavy] = values(terms[part][heavy], weights[part][heavy])
            starts = np.flatnonzero(np.diff(rows[part], prepend=-1))
            for row, least in zip(rows[part][starts].tolist(), np.minimum.reduceat(held, starts, axis=0)):
                old = out[first + row]
                out[first + row] = least if old is None else np.minimum(old, least)
    for k, least in enumerate(out):
        if least is not None:
            out[k] = (mixed(least.view(np.uint32).astype(np.uint64)) >> np.uint64(48)).astype(">u2")
    return out


def _text(codes: np.ndarray | None) -> str:
    return "" if codes is None else codes.tobytes().hex()


def likeness(one: np.ndarray | None, other: np.ndarray | None) -> float:
    if one is None or other is None:
        return float(one is other)
    return float(np.mean(one == other))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every row of ``docs(doc_id, text)``."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(_text, sketches(batch.column("text"))), pa.string())],
                ["doc_id", "fingerprint"])

    given = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {given}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many, or all, of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


FIGURES = (("n_chars", "long"), ("edited_sha256", "string"), ("fingerprint", "string"),
           ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double"))


def _figures(ids: pa.Array, pairs: list) -> list[pa.Array]:
    """The figures of (text, codes) pairs: each with the one after it."""
    texts = [edited(a, b) for (a, _), (b, _) in pairs]
    changed = sketches(pa.array(texts, pa.string()))
    return [
        ids, pa.array([len(a) for (a, _), _ in pairs], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
        pa.array([_text(codes) for (_, codes), _ in pairs], pa.string()),
        pa.array([_text(c) for c in changed], pa.string()),
        pa.array([likeness(codes, c) for ((_, codes), _), c in zip(pairs, changed)], pa.float64()),
        pa.array([likeness(a, b) for (_, a), (_, b) in pairs], pa.float64()),
    ]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """
    Rows of one sorted partition, each met with the one after it. The partition's first and last
    rows come with their texts, for the partitions beside it.
    """
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    names = ["part", "edge", "text", "doc_id", *(n for n, _ in FIGURES)]

    def out(edge, ids, figures, texts=None):
        rows = len(ids)
        held = figures or [ids, *(pa.nulls(rows, t) for t in (
            pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))]
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * rows, pa.int32()), pa.array([edge] * rows, pa.string()),
             texts if texts is not None else pa.nulls(rows, pa.string()), *held], names)

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("doc_id")
        texts = [t or "" for t in batch.column("text").to_pylist()]
        if last is None:
            yield out("first", ids.slice(0, 1), None, pa.array(texts[:1], pa.string()))
        chain = ([last[1]] if last else []) + list(zip(texts, sketches(batch.column("text"))))
        chain_ids = pa.concat_arrays([last[0], ids]) if last else ids
        if len(chain) > 1:
            yield out("", chain_ids.slice(0, len(chain) - 1), _figures(
                chain_ids.slice(0, len(chain) - 1), list(zip(chain, chain[1:]))))
        last = ids.slice(len(ids) - 1, 1), chain[-1]
    if last:
        yield out("last", last[0], None, pa.array([last[1][0]], pa.string()))


def _compare_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = [[(t or "", codes) for t, codes in zip(batch.column(n).to_pylist(), sketches(batch.column(n)))]
                for n in ("text", "next_text")]
        yield pa.RecordBatch.from_arrays(_figures(batch.column("doc_id"), list(zip(*both))),
                                         ["doc_id", *(n for n, _ in FIGURES)])


def report(docs: DataFrame) -> DataFrame:
    """
    Each document against its edited text and its successor in falling order of id.

    Texts move once, into partitions of id ranges, where a row meets its successor as the next
    row. Only the first and last row of a partition are looked at again, to join a partition's
    end to the start of the next one that has rows; the very last meets the very first. Null ids
    come last; rows of one id go by a hash of their text.
    """
    ship_package(docs.sparkSession)
    given = docs.schema["doc_id"].dataType.simpleString()
    # Equal rows are told apart by their numbers, so that any number of them is cut into ranges.
    order = [F.col("doc_id").desc_nulls_last(), F.col("text_key"), F.col("row_number")]
    ranged = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"), F.monotonically_increasing_id().alias("row_number")).repartitionByRange(
        partitions(docs.sparkSession), *order).sortWithinPartitions(*order).select("doc_id", "text")
    figures = ", ".join(f"{n} {t}" for n, t in FIGURES)
    done = stored(ranged.mapInArrow(_compare, f"part int, edge string, text string, doc_id {given}, {figures}"), "compared")
    firsts = done.filter("edge = 'first'").select(F.col("part").alias("at"), F.col("text").alias("next_text"))
    # One number per partition with rows.
    parts = Window.orderBy("at")
    after = firsts.select("at").select("at", F.lead("at").over(parts).alias("next"), F.first("at").over(parts).alias("start"))
    after = after.select(F.col("at").alias("part"), F.coalesce("next", "start").alias("at"))
    ends = done.filter("edge = 'last'").select("part", "doc_id", "text").join(after, "part").join(firsts, "at").select(
        "doc_id", "text", "next_text").mapInArrow(_compare_edges, f"doc_id {given}, {figures}")
    return done.filter("edge = ''").select("doc_id", *(n for n, _ in FIGURES)).unionByName(ends)
