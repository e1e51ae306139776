"""Helpers of the corpus operators: texts as byte arrays, words and shingles as 64-bit hashes.

Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z. A word's hash is a polynomial over seeded byte
values modulo 2**64, finished by a bijective mixer; a block of texts takes a few passes over its bytes.
Distinct words (or shingles) share a hash with a probability of about pairs / 2**64.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that one numpy pass takes; a longer single text is a block of its own.
BLOCK_BYTES = 2 << 20

_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD_BYTE = _BYTE[_LOWER]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes that one pass of hashing takes, and powers that the tables hold.
SEGMENT = 1 << 16


def key_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the key (`key`, bigint) and the text (`text`), whatever other columns there are."""
    return df.select(F.col(quoted(id_col)).cast("bigint").alias("key"), F.col(quoted(text_col)).cast("string").alias("text"))


def free_name(taken: list[str], name: str) -> str:
    """The name, with underscores before it until no column has it."""
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def crc_rest(id_col: str, modulus: int) -> Column:
    """crc32 of the key's digits modulo `modulus`; NULL keys count as the empty text."""
    return F.crc32(F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit("")).cast("binary")) % modulus


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The text column with NULL as the empty text."""
    column = batch.column(batch.schema.get_field_index(name))
    return pc.fill_null(column, "") if column.null_count else column


def as_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, one after the other, and the offsets (one more than texts)."""
    wide = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    n = len(texts)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, wide)[texts.offset:texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def blocks(batches: Iterator[pa.RecordBatch], most: int = 0) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the rows of each take about `most` bytes (one row at least)."""
    most = most or BLOCK_BYTES
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        sizes = np.zeros(rows, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) or pa.types.is_binary(column.type):
                sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(sizes) - sizes) // most
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), rows]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)


@functools.cache
def _powers(base: int) -> np.ndarray:
    """The first `SEGMENT` powers of the base modulo 2**64."""
    steps = np.full(SEGMENT, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _segment_scales(base: int, n: int) -> np.ndarray:
    """The base to the power of where each of `n` segments starts."""
    steps = np.full(n, pow(base, SEGMENT, 2**64), np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = _BYTE) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end).

    Sums over the bytes are worked out for one segment after the other and kept only where spans start and end, so that memory
    grows with the spans, not with eight bytes for each byte of a long text.
    """
    up, scales = _powers(_BASE), _segment_scales(_BASE, len(data) // SEGMENT + 1)
    down, unscales = _powers(_INVERSE), _segment_scales(_INVERSE, len(data) // SEGMENT + 1)
    sums = []
    for places in (starts, ends):
        order = None if (places[1:] >= places[:-1]).all() else np.argsort(places, kind="stable")
        sums.append((places if order is None else places[order], order, np.zeros(len(places), np.uint64)))
    before = np.zeros(1, np.uint64)
    inside = np.zeros(SEGMENT + 1, np.uint64)
    for k in range(len(scales)):
        low, scale = k * SEGMENT, scales[k:k + 1]
        part = table[data[low:low + SEGMENT]] * up[:len(data) - low]
        np.cumsum(part, out=inside[1:len(part) + 1])
        for places, _, at in sums:
            a, b = np.searchsorted(places, [low, low + len(part) + (k + 1 == len(scales))])
            at[a:b] = before + inside[places[a:b] - low] * scale
        before = before + inside[len(part):len(part) + 1] * scale
    for places, order, at in sums:
        if order is not None:
            at[order] = at.copy()
    h = (sums[1][2] - sums[0][2]) * (down[starts % SEGMENT] * unscales[starts // SEGMENT])
    return mixed(h ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word."""
    n = len(data)
    if n == 0:
        return (np.zeros(0, np.int64),) * 3
    space = _SPACE[data]
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = space[:-1]
    edge = offsets[(offsets > 0) & (offsets < n)]
    before[edge] = True
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = space[1:]
    after[edge - 1] = True
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(after & ~space) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number, start and end of every word, A-Z lower-cased."""
    starts, ends, doc = word_spans(data, offsets)
    return span_hashes(data, starts, ends, _WORD_BYTE), doc, starts, ends


def shingle_hashes(words: np.ndarray, doc: np.ndarray, texts: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words and offsets by text; fewer words make one run, no words none."""
    count = np.bincount(doc, minlength=texts)
    runs = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    offsets = np.concatenate(([0], np.cumsum(runs)))
    first = np.concatenate(([0], np.cumsum(count)))
    # Start of each run among the words, and its length.
    start = np.repeat(first[:-1] - offsets[:-1], runs) + np.arange(offsets[-1])
    length = np.repeat(np.minimum(count, size), runs)
    h = np.zeros(len(start), np.uint64)
    for k in range(size):
        has = length > k
        at = np.minimum(start + k, max(len(words) - 1, 0))
        h = np.where(has, h * np.uint64(_BASE) + words[at] if len(words) else h, h)
    return mixed(h ^ length.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)), offsets


def sets_of(hashes: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct hashes of each text."""
    return [np.unique(hashes[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def narrow(counts: np.ndarray) -> bytes:
    """Counts as unsigned integers of as few bytes as the largest needs."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))).newbyteorder("<")).tobytes()


def add_up(parts: DataFrame, width: int) -> dict[int, np.ndarray]:
    """Sums by `block` of the vectors in `data` (`width` unsigned integers of any size), one vector for each of a fixed number of blocks.

    Each task adds up what it reads while it reads; a second round adds up the few results of each block.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                vector = _counts(data.as_buffer(), width)
                if block in sums:
                    sums[block] += vector
                else:
                    sums[block] = vector.astype(np.uint64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([narrow(v) for v in sums.values()], pa.binary())], ["block", "data"])

    kind = "block int, data binary"
    first = parts.select("block", "data").repartition("block", F.pmod(F.spark_partition_id(), F.lit(16))).mapInArrow(run, kind)
    return {r["block"]: _counts(r["data"], width).astype(np.int64) for r in first.repartition("block").mapInArrow(run, kind).collect()}


def _counts(data, width: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // width}")
