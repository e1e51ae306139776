"""Document fingerprints by content-defined chunking.

A gear hash over the last 8 bytes marks places to cut; up to the normal chunk size only a rarer mark counts, beyond
it a commoner one, so that sizes stay near the normal. Places depend on the bytes around them alone, so chunks
survive shifts. A fingerprint is the sorted set of chunk digests, ten hexadecimal digits each: eight of the digest,
two of the chunk's length. Likeness is the share of a fingerprint's length that another contains.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionscore.llm.common import as_bytes, blocks, key_and_text, span_hashes, text_column

LEAST, NORMAL, MOST = 8, 32, 128
#: Bits of the gear hash that are zero at a place that counts before, and after, the normal size.
HARD_BITS, EASY_BITS = 6, 4
#: Rows of one part of the table in which each document meets its next one.
ROWS_PER_PART = 20_000
_GEAR = np.random.default_rng(20240915).integers(0, 2**32, 256, dtype=np.uint32)
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash of the 8 bytes that end at each place: sums of shifted table values, doubled three times."""
    h = _GEAR[data]
    for width in (1, 2, 4):
        if len(h) > width:
            more = h.copy()
            more[width:] += h[:-width] << np.uint32(width)
            h = more
    return h


def cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every chunk of the texts between the offsets."""
    h = gear(data)
    easy = np.flatnonzero(h >> np.uint32(32 - EASY_BITS) == 0)
    hard = easy[h[easy] >> np.uint32(32 - HARD_BITS) == 0] + 1
    easy += 1
    number = np.searchsorted(easy, hard)
    far = 1 << 62
    easy_to, hard_to = np.append(easy, far), np.append(hard, far)
    number_of = np.append(number, -1)

    def following(start: np.ndarray) -> list[int]:
        """Number (among the easy places) of the cut after each start; -1 where the longest chunk ends first."""
        i = np.searchsorted(hard, start + LEAST)
        j = np.searchsorted(easy, start + NORMAL)
        then = np.where(easy_to[j] <= start + MOST, j, -1)
        return np.where(hard_to[i] < start + NORMAL, number_of[i], then).tolist()

    places, after, first = easy.tolist(), following(easy), following(offsets[:-1])
    ends: list[int] = []
    for doc, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        at, start = first[doc], a
        while True:
            if at < 0:
                end = start + MOST
                if end >= b:
                    break
                k = bisect_left(places, end)
                at = after[k] if k < len(places) and places[k] == end else following(np.array([end]))[0]
            else:
                end = places[at]
                if end >= b:
                    break
                at = after[at]
            ends.append(end)
            start = end
        if b > a:
            ends.append(b)
    stop = np.array(ends, np.int64)
    start = np.empty_like(stop)
    if len(stop):
        start[0] = offsets[0]
        start[1:] = stop[:-1]
    return start, stop


def chunk_keys(texts: pa.Array) -> np.ndarray:
    """Sorted distinct (text number, 32 bits of digest, 8 bits of length) of all chunks, as one number each."""
    data, offsets = as_bytes(texts)
    if not len(data):
        return np.zeros(0, np.uint64)
    start, end = cuts(data, offsets)
    doc = np.searchsorted(offsets, start, "right") - 1
    digest = span_hashes(data, start, end) >> np.uint64(32)
    return np.unique(doc.astype(np.uint64) << np.uint64(40) | digest << np.uint64(8) | (end - start).astype(np.uint64))


def _weights(keys: np.ndarray, rows: int) -> np.ndarray:
    """Length of the chunks of each text."""
    return np.bincount((keys >> np.uint64(40)).astype(np.int64), (keys & np.uint64(255)).astype(np.float64), rows)[:rows]


def contained(own: np.ndarray, other: np.ndarray, rows: int) -> np.ndarray:
    """Share of the length of each text's chunks that the other text has; of empty texts 1 if both are, else 0."""
    whole = _weights(own, rows)
    common = _weights(np.intersect1d(own, other, assume_unique=True), rows)
    return np.where(whole > 0, common / np.maximum(whole, 1), (_weights(other, rows) == 0).astype(float))


def as_text(keys: np.ndarray, rows: int) -> pa.Array:
    """Fingerprints of the texts from their keys."""
    nibbles = (keys[:, None] >> np.arange(36, -1, -4, dtype=np.uint64)[None, :]).astype(np.uint8) & 15
    edges = np.searchsorted(keys >> np.uint64(40), np.arange(rows + 1)) * 10
    return pa.StringArray.from_buffers(rows, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(_HEX[nibbles])))


def shifted(keys: np.ndarray, rows: int) -> np.ndarray:
    """Keys of text i + 1 as those of text i, up to `rows`."""
    one = np.uint64(1 << 40)
    return keys[(keys >= one) & (keys < one * np.uint64(rows + 1))] - one


FINGERPRINTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()), T.StructField("fingerprint", T.StringType())])


def fingerprint(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, n_chars, fingerprint` of every row's whole text; NULL and empty texts have the empty fingerprint.

    Equal texts have equal fingerprints. Repeated rows and NULL keys stay as they are; other columns are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            texts = text_column(batch, "text")
            sizes = pa.array([len(t) for t in texts.to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, as_text(chunk_keys(texts), len(texts))], FINGERPRINTS.names)

    return key_and_text(df, id_col, text_col).mapInArrow(run, FINGERPRINTS)


def likeness(a: Column, b: Column) -> Column:
    """Share of fingerprint `a`'s length that `b` contains, from 0 to 1; of the empty one 1 if both are empty, else 0."""
    pieces = lambda c: F.regexp_extract_all(c, F.lit("[0-9a-f]{10}"), F.lit(0))
    length = lambda x: F.conv(F.substring(x, 9, 2), 16, 10).cast("double")
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + length(x))
    return F.when(a == "", F.when(b == "", 1.0).otherwise(0.0)).otherwise(total(F.array_intersect(pieces(a), pieces(b))) / total(pieces(a)))


EDITED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
    T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])


def next_to_each_other(df: DataFrame, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """`part, extra, key, text`: parts of rows by descending key, each followed by the row after it (`extra`).

    The borders are keys of the table, so the first row of a part is known and goes to the part before as well; the
    first of all follows the last of all. Each text moves once. NULL keys come last, rows of one key by text.
    """
    k = F.coalesce(F.col("key"), F.lit(-(2**63)))
    rows = df.count()
    wanted = max(1, -(-rows // rows_per_part), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if rows > 1000 else 1)
    shares = [(i + 1) / wanted for i in range(wanted)]
    found = df.agg(F.percentile_approx(k, shares, max(10_000, 10 * wanted)).alias("borders"), F.max(k).alias("top")).first()
    borders = sorted({*(found["borders"] or []), *([] if found["top"] is None else [found["top"]])})
    edges = F.lit(borders) if borders else F.array(F.lit(0).cast("bigint"))
    # Number of borders below the key, by halving.
    lo, hi = (lambda s: s.getField("lo")), (lambda s: s.getField("hi"))
    half = lambda s: F.shiftright(lo(s) + hi(s), 1)
    step = lambda s, _: F.when(lo(s) >= hi(s), s).when(F.get(edges, half(s)) < k, F.struct((half(s) + 1).alias("lo"), hi(s).alias("hi"))).otherwise(
        F.struct(lo(s).alias("lo"), half(s).alias("hi")))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(borders)).alias("hi"))
    at = F.aggregate(F.sequence(F.lit(1), F.lit(math.ceil(math.log2(len(borders) + 1)) + 1)), start, step).getField("lo")
    last = len(borders) - 1
    own = F.struct((last - F.col("at")).alias("part"), F.lit(False).alias("extra"))
    other = F.struct(F.when(F.col("at") == last, last).otherwise(last - F.col("at") - 1).alias("part"), F.lit(True).alias("extra"))
    dealt = df.select("key", "text", at.alias("at")).select("key", "text", F.inline(F.when(F.get(edges, "at") == k, F.array(own, other)).otherwise(F.array(own))))
    return dealt.repartitionById(max(1, len(borders)), F.col("part")).sortWithinPartitions("part", "extra", k.desc(), "text")


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edit, and how alike they and the next document's are.

    The edit replaces the last half of a text's code points (rounded down) by the first as many, or all, of the next
    document in descending key order; the first follows the last. NULL texts are empty.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in blocks(batches):
            joined = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            held = joined.slice(joined.num_rows - 1)
            if (out := _edited(joined)) is not None:
                yield out

    dealt = next_to_each_other(key_and_text(df, id_col, text_col))
    return dealt.select("part", "extra", "key", "text").mapInArrow(run, EDITED)


def _edited(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """All rows of the batch but the last and the extra ones, each with the row after it."""
    rows = batch.num_rows - 1
    extra = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)[:rows]
    if rows < 1 or extra.all():
        return None
    texts = text_column(batch, "text")
    plain = texts.to_pylist()
    edited = [t[:len(t) - len(t) // 2] + after[:len(t) // 2] for t, after in zip(plain, plain[1:])]
    own, other = chunk_keys(texts), chunk_keys(pa.array(edited, pa.string()))
    mine = own[own < np.uint64(rows << 40)]
    out = pa.RecordBatch.from_arrays([
        batch.column(2).slice(0, rows), pa.array([len(t) for t in plain[:rows]], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]), as_text(mine, rows), as_text(other, rows),
        pa.array(contained(mine, other, rows)), pa.array(contained(mine, shifted(own, rows), rows))], EDITED.names)
    return out.filter(pa.array(~extra))
