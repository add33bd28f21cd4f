"""
Removal of repeated passages by suffix arrays.

A byte goes if a string of ``LEAST`` bytes that covers it also starts earlier: in a document with
a smaller id, or earlier in the same document.

1. Anchors. Of each run of ``LEAST`` bytes, the ``GRAM`` bytes with the smallest hash are marked
   (the first, if several are equal). Equal strings have equal anchors at the same place in
   them, so two equal strings of ``LEAST`` bytes always share an anchor. About one place in 40
   is an anchor.
2. Only anchors that occur at two places of different texts, or twice in one, can belong to a
   repeat. For each, its context is cut out of the text: the bytes of the strings it is the
   anchor of. So each string is in one context.
3. Contexts are dealt by anchor into buckets of about ``ROWS`` rows. In a bucket, equal contexts
   are put together, and those without a string whose hash occurs twice are left out; over the others an
   enhanced suffix array is built, and its tree of common-prefix intervals is gone through with a
   stack. An interval whose suffixes follow different bytes is a maximal repeat with all its
   places; all places but the earliest go.
4. Anchors with more than ``HOT`` places, as of a passage in a third of all documents, would
   make a bucket too large. Their contexts are taken apart into strings of ``LEAST`` bytes, and
   the first place of each is found by a plain aggregate, which no frequent string slows down.
5. Equal texts are found by their digest. A later copy goes as a whole, if it has ``LEAST`` bytes,
   and is not looked at in steps 3 and 4; copies of the most frequent texts have no anchors either.

Null texts count as empty. Texts shorter than ``LEAST`` stay whole. Rows equal in id and text are
one document and get the same result; different texts of one id are in the order of a hash of
the text; null ids come last. Ids are whole numbers; other kinds are refused. Texts may have any length that
a string can have. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.base import HOT_SHARE, ship_package, spread_join, stored
from tallybrook.llm.suffixes import SuffixArray, repeated_lengths
from tallybrook.llm.tokens import _BASE, _INVERSE, _power, groups, mixed

LEAST, GRAM = 100, 20
ROWS, HOT = 20_000, 40_000
LAST = (1 << 63) - 1


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Hash of the ``size`` bytes from each place on."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, len(data)), out=total[1:])
    return mixed((total[size:] - total[:-size]) * _power("down", _INVERSE, len(data) + 1)[:len(data) + 1 - size])


def repeating(strings: list[bytes]) -> np.ndarray:
    """Which of the strings, of ``LEAST`` bytes at least, hold a string of ``LEAST`` bytes whose hash occurs twice."""
    if not strings:
        return np.zeros(0, np.int64)
    sizes = np.array([len(s) for s in strings])
    hashes = gram_hashes(np.frombuffer(b"".join(strings), np.uint8), LEAST)
    counts = sizes - LEAST + 1
    of = np.repeat(np.arange(len(strings)), counts)
    own = hashes[np.arange(len(of)) + (of * (LEAST - 1))]
    order = np.sort(own)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return np.zeros(0, np.int64)
    at = np.searchsorted(twice, own)
    return np.unique(of[(at < len(twice)) & (twice[np.minimum(at, len(twice) - 1)] == own)])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """
    (row, start, end, hash) of the anchors of some rows of bytes: the first and last byte, end
    exclusive, of the strings that an anchor stands for, within its row.
    """
    none = np.zeros(0, np.int64)
    if len(data) < LEAST:
        return none, none, none, np.zeros(0, np.uint64)
    hashes = gram_hashes(data)
    # The upper bits of the hash and the place: the smallest is the first of equal hashes. No text has 2^32 bytes.
    bits = np.uint64(32)
    least = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while 2 * span <= LEAST - GRAM + 1:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    if rest := LEAST - GRAM + 1 - span:
        least = np.minimum(least[:-rest], least[rest:])
    # No string goes on into the next row.
    whole = np.zeros(len(least) + 1, np.int64)
    starts, ends = offsets[:-1], np.maximum(offsets[:-1], offsets[1:] - LEAST + 1)
    np.add.at(whole, starts[starts < ends], 1)
    np.add.at(whole, ends[starts < ends], -1)
    starts = np.flatnonzero(np.cumsum(whole[:-1]) > 0)
    # Strings of one anchor start one after the other.
    at, first, count = np.unique((least[starts] & np.uint64((1 << 32) - 1)).astype(np.int64),
                                 return_index=True, return_counts=True)
    row = np.searchsorted(offsets, at, "right") - 1
    begin = starts[first] - offsets[row]
    return row, begin, begin + count - 1 + LEAST, hashes[at]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, data, offsets in groups(batch.column("text")):
            row, start, end, hashes = anchors(data, offsets)
            rows = pa.array(row + first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), batch.column("id").take(rows), batch.column("text_key").take(rows),
                 pa.array(start.astype(np.int32)), pa.array((end - start).astype(np.int16))],
                ["anchor", "id", "text_key", "start", "size"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the strings that the anchors of the rows stand for."""
    for batch in batches:
        texts, found = batch.column("text").cast(pa.large_binary()), batch.column("found")
        edges = found.offsets.to_numpy()
        marks = found.values
        starts, sizes = (marks.field(n).to_numpy() for n in ("start", "size"))
        held: list[bytes] = []
        first = edges[0]
        for k in range(len(texts)):
            text = texts[k].as_py() or b""
            a, b = int(edges[k]), int(edges[k + 1])
            held += [text[s:s + n] for s, n in zip(starts[a:b].tolist(), sizes[a:b].tolist())]
            if len(held) > 20_000 or k == len(texts) - 1:
                part = slice(int(first), b)
                row = pa.array(np.searchsorted(edges, np.arange(part.start, part.stop), "right") - 1)
                yield pa.RecordBatch.from_arrays(
                    [marks.field("anchor").slice(part.start, len(held)), marks.field("hot").slice(part.start, len(held)),
                     batch.column("id").take(row), batch.column("text_key").take(row),
                     pa.array(starts[part].astype(np.int64)), pa.array(held, pa.binary())],
                    ["anchor", "hot", "id", "text_key", "start", "context"])
                held, first = [], b


def merged(starts: np.ndarray, ends: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(of, start, end) of the unions of spans of the same owner."""
    if not len(starts):
        return of, starts, ends
    order = np.lexsort((starts, of))
    of, starts, ends = of[order], starts[order], ends[order]
    wide = int(ends.max()) + 1
    upto = np.maximum.accumulate(ends + of * wide)
    fresh = np.flatnonzero(np.concatenate([[True], (starts + of * wide)[1:] > upto[:-1]]))
    lasts = np.concatenate([fresh[1:], [len(of)]]) - 1
    return of[fresh], starts[fresh], upto[lasts] - of[lasts] * wide


def _bucket(rows: pa.Table) -> pa.Table:
    """The spans of a bucket's contexts that repeat earlier ones."""
    rows = rows.combine_chunks()
    ids, keys, starts = (rows.column(c).to_numpy() for c in ("id", "text_key", "start"))
    contexts = rows.column("context").combine_chunks()
    contexts = contexts.chunk(0) if isinstance(contexts, pa.ChunkedArray) else contexts
    coded = contexts.dictionary_encode()
    code, strings = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
    # Documents in order, and the earliest place of each context.
    order = np.lexsort((keys, ids))
    fresh = np.concatenate([[True], (np.diff(ids[order]) != 0) | (np.diff(keys[order]) != 0)])
    document = np.empty(len(ids), np.int64)
    document[order] = np.cumsum(fresh) - 1
    place = (document << 32) | starts
    first = np.full(len(strings), LAST)
    np.minimum.at(first, code, place)
    sizes = np.array([len(s) for s in strings], np.int64)
    later = np.flatnonzero(place > first[code])
    of, begin, end = [document[later]], [starts[later]], [starts[later] + sizes[code[later]]]
    some = repeating(strings)
    array = SuffixArray([strings[k] for k in some], LEAST)
    first = first[some]
    suffix, length = repeated_lengths(array, LEAST, first[array.string] + array.offset)
    at = first[array.string[suffix]] + array.offset[suffix]
    of, begin, end = (np.concatenate([a, b]) for a, b in zip(
        (of[0], begin[0], end[0]), (at >> 32, at & 0xFFFFFFFF, (at & 0xFFFFFFFF) + length)))
    of, begin, end = merged(begin, end, of)
    row = order[np.flatnonzero(fresh)][of]
    return pa.table({"id": ids[row], "text_key": keys[row], "start": begin, "end": end})


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All strings of LEAST bytes of the contexts, by digest."""
    for batch in batches:
        for a in range(0, batch.num_rows, 500):
            part = batch.slice(a, 500)
            row, start, digest = [], [], []
            for k, (at, text) in enumerate(zip(part.column("start").to_pylist(), part.column("context").to_pylist())):
                for o in range(len(text) - LEAST + 1):
                    row.append(k)
                    start.append(at + o)
                    digest.append(hashlib.blake2b(text[o:o + LEAST], digest_size=16).digest())
            rows = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest, pa.binary()), part.column("id").take(rows), part.column("text_key").take(rows),
                 pa.array(start, pa.int64())], ["digest", "id", "text_key", "start"])


SPANS = "id long, text_key long, start long, end long"


def hot_spans(contexts: DataFrame) -> DataFrame:
    strings = stored(contexts.mapInArrow(_strings, "digest binary, id long, text_key long, start long"), "strings")
    firsts = strings.groupBy("digest").agg(F.min(F.struct("id", "text_key", "start")).alias("first"))
    return spread_join(strings, firsts, "digest").filter(
        F.struct("id", "text_key", "start") > F.col("first")).select(
        "id", "text_key", "start", (F.col("start") + LEAST).alias("end"))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, counts, digests, sizes = [], [], [], []
        for text, spans in zip(batch.column("text").cast(pa.large_binary()).to_pylist(), batch.column("spans").to_pylist()):
            text, kept, upto, runs, gone = text or b"", hashlib.sha256(), 0, 0, 0
            for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
                if start > upto or not runs:
                    runs += 1
                    kept.update(text[upto:start])
                    upto = start
                if end > upto:
                    gone += end - upto
                    upto = end
            kept.update(text[upto:])
            sizes.append(len(text))
            removed.append(gone)
            counts.append(runs)
            digests.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(counts, pa.int64()), pa.array(digests, pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def without_frequent(texts: DataFrame, digests: DataFrame) -> DataFrame:
    """
    The ``texts`` without later copies of those that more than one in ``HOT_SHARE`` of them are. There
    are fewer than ``HOT_SHARE`` such texts at any size, so their digests are broadcast.
    """
    groups_ = digests.groupBy("digest").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.min("text_key").alias("hot_key"))
    frequent = stored(groups_.filter(F.col("n") * HOT_SHARE > digests.count()).drop("n"), "frequent")
    # The digest is taken of texts whose key is that of a frequent one.
    copy = (F.col("text_key") == F.col("hot_key")) & (F.col("id") > F.col("first")) & (F.sha2("text", 256) == F.col("digest"))
    return texts.join(F.broadcast(frequent), copy, "left_anti")


def repeated_spans(docs: DataFrame, rows_per_bucket: int = ROWS, hot: int = HOT) -> DataFrame:
    """``id, text_key, start, end``: the spans to remove, by document; they may overlap."""
    ship_package(docs.sparkSession)
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    texts = docs.select(id_.alias("id"), F.xxhash64("text").alias("text_key"), "text").filter(F.octet_length("text") >= LEAST)
    digests = texts.select("id", "text_key", F.sha2("text", 256).alias("digest"), F.octet_length("text").cast("long").alias("end"))
    digests = stored(digests, "digests")
    firsts = digests.groupBy("digest").agg(F.min("id").alias("first"))
    copies = stored(spread_join(digests, firsts, "digest").filter(F.col("id") > F.col("first")).select(
        "id", "text_key", F.lit(0).cast("long").alias("start"), "end").distinct(), "copies")
    marks = without_frequent(texts, digests).mapInArrow(_anchors, "anchor long, id long, text_key long, start int, size short")
    of = F.xxhash64("text_key", "start")
    shared = marks.groupBy(F.col("anchor").alias("shared")).agg(
        F.min(of).alias("low"), F.max(of).alias("high"), F.count("*").alias("n")).filter("low <> high").select(
        "shared", (F.col("n") > hot).alias("hot"))
    found = marks.join(shared, F.col("anchor") == F.col("shared")).join(
        copies.select("id", "text_key"), ["id", "text_key"], "left_anti").groupBy("id", "text_key").agg(
        F.collect_set(F.struct("start", "size", "anchor", "hot")).alias("found"))
    contexts = stored(texts.join(found.hint("shuffle_hash"), ["id", "text_key"]).select("id", "text_key", "text", "found").mapInArrow(
        _contexts, "anchor long, hot boolean, id long, text_key long, start long, context binary"), "contexts")
    cold = contexts.filter(~F.col("hot"))
    buckets = max(1, ceil(cold.count() / rows_per_bucket))
    spans = cold.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets))).drop("anchor", "hot").groupBy(
        "bucket").applyInArrow(_bucket, SPANS)
    if contexts.filter("hot").head(1):
        spans = spans.unionByName(hot_spans(contexts.filter("hot")))
    return spans.unionByName(copies)


def report(docs: DataFrame, rows_per_bucket: int = ROWS, hot: int = HOT) -> DataFrame:
    spans = repeated_spans(docs, rows_per_bucket, hot)
    own = stored(spans.groupBy(F.col("id").alias("of_id"), F.col("text_key").alias("of_key")).agg(
        F.collect_list(F.struct("start", "end")).alias("spans")), "spans")
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    joined = texts.join(own.hint("shuffle_hash"), (id_ == F.col("of_id")) & (F.col("text_key") == F.col("of_key")), "left")
    given = docs.schema["doc_id"].dataType.simpleString()
    return joined.select("doc_id", "text", "spans").mapInArrow(
        _kept, f"doc_id {given}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
