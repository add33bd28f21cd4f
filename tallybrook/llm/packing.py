"""
Packing of tokenised documents into sequences of fixed length, by best-two-fit.

A document is its token ids and an end mark. One longer than a sequence is cut into full
pieces, of which the first may be shorter. Pieces are then packed: a bin starts with the
longest piece left and takes the longest that fits until none does; if a gap stays, the bin's
smallest piece is traded for the two unpacked pieces that fill the widened gap best, if they
fill it better. A chunk is packed with several least gaps to trade for, until one needs no more bins
than the sum of lengths does, or else with the best of them.

Pieces are packed in chunks of about ``CHUNK`` pieces, drawn by a hash of the row's number, each in one
task, as a histogram of lengths with a bit set of the lengths left; a chunk loses at most its
last bins to the cut, far below one in a thousand. Memory is bounded by the chunk, and the number
of chunks grows with the input.

Token ids come from the vocabulary file given (a rank file); ``tests/llm`` hold them against
the ``tokenizers`` file of the same vocabulary, which finds the special token in texts as well.
Null texts count as empty: a piece of the end mark only. Every row is packed, null and repeated
ids included. Very long texts are tokenised whole and cut. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.base import ship_package, stored

LENGTH, END = 1024, 2
CHUNK = 50_000
GAPS = (1, 2, 4, 8, 16, 32, 64)
VOCABULARY = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}


@lru_cache(maxsize=2)
def encoder(vocabulary: str):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def cuts(count: int, length: int) -> list[int]:
    """The bounds of a document's pieces: all but the first are full."""
    pieces = -(-count // length)
    first = count - length * (pieces - 1)
    return [0, *range(first, count + 1, length)]


def _pieces(vocabulary: str, length: int, end: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = partial(encoder(vocabulary).encode, allowed_special=set(SPECIAL), disallowed_special=())
        for batch in batches:
            row, piece, start, size, crc, kept = [], [], [], [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                ids = np.array([*encode(text or ""), end], dtype="<u4")
                bounds = cuts(len(ids), length)
                for n, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    row.append(k)
                    piece.append(n)
                    start.append(a)
                    size.append(b - a)
                    crc.append(zlib.crc32(ids[a:b]))
                    if with_ids:
                        kept.append(ids[a:b].astype(np.int32))
            columns = [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH, end: int = END,
           with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``."""
    ship_package(docs.sparkSession)
    given = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {given}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(_pieces(vocabulary, length, end, with_ids), schema)


def two_that_fit(left: int, counts: list[int], gap: int, more_than: int) -> tuple[int, int] | None:
    """Two lengths left whose sum is the largest up to ``gap``, if it is over ``more_than``."""
    best, pair = more_than, None
    x = (left & ((1 << gap) - 1)).bit_length() - 1
    while x > 0 and 2 * x > best:
        rest = left & ((1 << (min(x, gap - x) + 1)) - 1)
        y = rest.bit_length() - 1
        if y == x and counts[x] < 2:
            y = (rest & ((1 << x) - 1)).bit_length() - 1
        if y > 0 and x + y > best:
            best, pair = x + y, (x, y)
            if best == gap:
                break
        x = (left & ((1 << x) - 1)).bit_length() - 1
    return pair


def fewest_bins(lengths: list[int], length: int) -> list[list[int]]:
    """
    Best-two-fit with the ``GAPS`` from which on it trades, and of these the filling with the fewest bins.

    Where small gaps are traded too, the pieces left over at the end get too alike to fill the last
    bins. The greedy filling alone counts only where no trades come up to it.
    """
    best, bound = None, ceil(sum(lengths) / length)
    for least in (*GAPS, length + 1):
        bins = best_two_fit(lengths, length, least)
        if best is None or len(bins) < len(best):
            best = bins
        if len(best) == bound:
            break
    return best


def best_two_fit(lengths: list[int], length: int, least: int = 1) -> list[list[int]]:
    """Bins as lists of lengths; gaps of ``least`` or more are traded for."""
    counts, left, bins = [0] * (length + 1), 0, []
    for n in lengths:
        counts[n] += 1
        left |= 1 << n

    def take(n):
        nonlocal left
        counts[n] -= 1
        if not counts[n]:
            left &= ~(1 << n)

    def give_back(n):
        nonlocal left
        counts[n] += 1
        left |= 1 << n

    while left:
        gap, bin_ = length, []
        while n := max(0, (left & ((1 << (gap + 1)) - 1)).bit_length() - 1):
            take(n)
            bin_.append(n)
            gap -= n
        if gap >= least and left:
            smallest = bin_[-1]
            if pair := two_that_fit(left, counts, gap + smallest, smallest):
                bin_.pop()
                for n in pair:
                    take(n)
                    bin_.append(n)
                give_back(smallest)
        bins.append(bin_)
    return bins


def _packer(length: int):
    def run(rows: pa.Table) -> pa.Table:
        sizes = rows.column("length").to_numpy()
        waiting: dict[int, list[int]] = {}
        for row in np.argsort(sizes, kind="stable")[::-1].tolist():
            waiting.setdefault(int(sizes[row]), []).append(row)
        bin_of, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for number, bin_ in enumerate(fewest_bins(sizes.tolist(), length)):
            at = 0
            for n in bin_:
                row = waiting[n].pop()
                bin_of[row], offset[row] = number, at
                at += n
        chunk = rows.column("chunk")[0].as_py()
        return rows.drop_columns(["chunk"]).append_column(
            "sequence_id", pa.array(bin_of + (chunk << 32))).append_column("offset", pa.array(offset))

    return run


def pack(rows: DataFrame, length: int = LENGTH, chunk: int = CHUNK) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``, their place there."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", sequence_id long, offset long"
    numbered = stored(rows.withColumn("row_number", F.monotonically_increasing_id()), "pieces")
    chunks = max(1, ceil(numbered.count() / chunk))
    # By the number of the row, so that equal pieces, however many, are spread like others.
    drawn = numbered.withColumn("chunk", F.pmod(F.xxhash64("row_number"), F.lit(chunks))).drop("row_number")
    return drawn.groupBy("chunk").applyInArrow(_packer(length), schema)


def report(docs: DataFrame) -> DataFrame:
    return pack(pieces(docs))
