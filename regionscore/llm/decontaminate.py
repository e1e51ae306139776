"""Benchmark decontamination: windows of benchmark words found in documents, and spans or documents taken out.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z; an item's windows are its runs of ten words, or all its words
if they are fewer. The windows' hashes are a sorted set that is broadcast; tasks slide over the words of whole texts, look
their windows up, and compare the words of every hit with the item's. A set has a bounded number of bytes of items:
a larger benchmark is dealt into several, which the documents meet one after the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionscore.landing import land
from regionscore.llm.common import as_bytes, blocks, free_name, mixed, quoted, span_hashes

WINDOW = 10
#: Bytes of benchmark text in one broadcast set (one item at least).
SET_BYTES = 8 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[48:58] = _INSIDE[65:91] = _INSIDE[97:123] = _INSIDE[128:] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Words:
    """Words of several texts: lower-cased bytes with one space after each word, and where words stand there and in the texts."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    raw_start: np.ndarray
    raw_end: np.ndarray
    #: Number of the first word of each text, and of the word after the last.
    first: np.ndarray


def _ramp(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), then from starts[1], and so on."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def words_of(texts: pa.Array) -> Words:
    data, offsets = as_bytes(texts)
    n = len(data)
    inside = _INSIDE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    raw_start = np.flatnonzero(inside & (edge[:n] | ~np.concatenate(([False], inside[:-1]))) if n else inside)
    raw_end = np.flatnonzero(inside & (edge[1:] | ~np.concatenate((inside[1:], [False]))) if n else inside) + 1
    doc = np.searchsorted(offsets, raw_start, "right") - 1
    sizes = raw_end - raw_start
    end = np.cumsum(sizes + 1) - 1
    text = np.full(int(sizes.sum()) + len(sizes), 32, np.uint8)
    at = _ramp(end - sizes, sizes)
    text[at] = _LOWER[data[_ramp(raw_start, sizes)]]
    return Words(text, end - sizes, end, doc, raw_start - offsets[doc], raw_end - offsets[doc], np.searchsorted(doc, np.arange(len(texts) + 1)))


def window_hashes(words: Words, hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of `size` words from each word on, also those that reach into the next text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = hashes[:n].copy()
    for k in range(1, size):
        h *= _BASE
        h += hashes[k:k + n]
    return mixed(h ^ np.uint64(size * 0xA24BAED4963EE407 % 2**64))


class WindowSet:
    """Distinct windows of items: sorted hashes, the words of each, and the items that hold it."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        names = sorted({name for name, _ in items})
        number = {name: k for k, name in enumerate(names)}
        words = words_of(pa.array([text for _, text in items], pa.large_string()))
        count = np.diff(words.first)
        size = np.where(count >= window, window, count)
        runs = np.where(count >= window, count - window + 1, (count > 0).astype(np.int64))
        start = _ramp(words.first[:-1], runs)
        size, owner = np.repeat(size, runs), np.repeat(np.array([number[name] for name, _ in items], np.int64), runs)
        hashes = span_hashes(words.text, words.start, words.end)
        h = np.zeros(len(start), np.uint64)
        for s in np.unique(size).tolist():
            of = size == s
            h[of] = window_hashes(words, hashes, s)[start[of]]
        a, b = words.start[start], words.end[start + size - 1] if len(start) else start
        # Windows with equal words are one; different words with one hash stay apart.
        order = np.lexsort((owner, h))
        h, owner, a, length = h[order], owner[order], a[order], (b - a)[order]
        same = np.flatnonzero((h[1:] == h[:-1]) & (length[1:] == length[:-1])) + 1
        if len(same):
            equal = words.text[_ramp(a[same], length[same])] == words.text[_ramp(a[same - 1], length[same])]
            same = same[np.logical_and.reduceat(equal, np.cumsum(length[same]) - length[same])]
        fresh = np.ones(len(h), bool)
        fresh[same] = False
        again = np.concatenate(([False], owner[1:] == owner[:-1])) & ~fresh if len(h) else fresh
        self.names, self.sizes, self.text = names, sorted(set(size.tolist())), words.text
        self.hash, self.at, self.length = h[fresh], a[fresh], length[fresh]
        self.owner = owner[~again].astype(np.int32)
        self.owner_from = np.concatenate((np.flatnonzero(fresh[~again]), [len(self.owner)])).astype(np.int64)
        # Most windows of clean texts end at this bitmap of hash bits.
        self.bits = max(16, (4 * len(self.hash)).bit_length())
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[(self.hash >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, number of words and window number of every occurrence, words compared."""
        hashes = span_hashes(words.text, words.start, words.end)
        found = [(np.zeros(0, np.int64),) * 3]
        for size in self.sizes:
            h = window_hashes(words, hashes, size)
            if not len(h):
                continue
            at = np.flatnonzero(self.seen[(h >> np.uint64(64 - self.bits)).astype(np.int64)])
            at = at[words.doc[at] == words.doc[at + size - 1]]
            low = np.searchsorted(self.hash, h[at], "left")
            many = np.searchsorted(self.hash, h[at], "right") - low
            at, entry = np.repeat(at, many), _ramp(low, many)
            a, length = words.start[at], words.end[at + size - 1] - words.start[at]
            fits = length == self.length[entry]
            at, entry, a, length = at[fits], entry[fits], a[fits], length[fits]
            if len(at):
                equal = words.text[_ramp(a, length)] == self.text[_ramp(self.at[entry], length)]
                good = np.logical_and.reduceat(equal, np.cumsum(length) - length)
                found.append((at[good], np.full(int(good.sum()), size), entry[good]))
        return tuple(np.concatenate(part) for part in zip(*found))


def _sets(benchmark: DataFrame, id_col: str, text_col: str, most: int) -> list[DataFrame]:
    """The items (`id, text`), dealt into sets of `most` bytes at most, but for a bucket of hashes that is larger alone.

    Sixteen buckets make about `most` bytes, so a set beyond the bound is one very long item and its few neighbours.
    """
    items = land(benchmark.select(
        F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")).alias("text")).distinct())
    size = F.sum(F.octet_length("text") + F.octet_length("id"))
    total = items.agg(size).first()[0] or 0
    if total <= most:
        return [items]
    bucket = F.pmod(F.xxhash64("id", "text"), F.lit(16 * -(-total // most)))
    edges, held = [0], 0
    for row in items.groupBy(bucket.alias("bucket")).agg(size.alias("bytes")).orderBy("bucket").collect():
        if held and held + row["bytes"] > most:
            edges.append(row["bucket"])
            held = 0
        held += row["bytes"]
    edges.append(16 * -(-total // most))
    return [items.filter((bucket >= a) & (bucket < b)) for a, b in zip(edges, edges[1:])]


STATE = "n_words bigint, hits binary, items array<string>"


def _meet(docs: DataFrame, text: str, state: str, windows: WindowSet, first: bool) -> DataFrame:
    """`docs` with the struct `state`: words, a bit for each word that is hit, and items found, added to what it holds."""
    shared = docs.sparkSession.sparkContext.broadcast(windows)
    names = docs.columns
    out = T.StructType([*(f for f in docs.schema.fields if f.name != state), T.StructField(state, T.StructType.fromDDL(STATE))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has = shared.value
        for batch in blocks(batches):
            texts = batch.column(names.index(text))
            words = words_of(texts.fill_null(""))
            at, size, entry = has.find(words)
            change = np.zeros(len(words.doc) + 1, np.int64)
            np.add.at(change, at, 1)
            np.add.at(change, at + size, -1)
            hit = np.cumsum(change[:-1]) > 0
            doc, many = words.doc[at], has.owner_from[entry + 1] - has.owner_from[entry]
            pairs = np.unique((np.repeat(doc, many) << 32) + has.owner[_ramp(has.owner_from[entry], many)])
            split = np.searchsorted(pairs >> 32, np.arange(len(texts) + 1))
            before = [None] * len(texts) if first else batch.column(names.index(state)).to_pylist()
            made = []
            for k, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
                found = [has.names[i] for i in (pairs[split[k]:split[k + 1]] & 0xFFFFFFFF).tolist()]
                bits = hit[a:b] if not before[k] else hit[a:b] | np.unpackbits(np.frombuffer(before[k]["hits"], np.uint8), count=b - a).astype(bool)
                if before[k] and before[k]["items"]:
                    found = sorted({*found, *before[k]["items"]})
                made.append({"n_words": b - a, "hits": np.packbits(bits).tobytes(), "items": found})
            kind = pa.struct([("n_words", pa.int64()), ("hits", pa.binary()), ("items", pa.list_(pa.string()))])
            kept = [(n, batch.column(k)) for k, n in enumerate(names) if n != state]
            yield pa.RecordBatch.from_arrays([*(c for _, c in kept), pa.array(made, kind)], [*(n for n, _ in kept), state])

    return docs.mapInArrow(run, out)


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
         window: int = WINDOW, most: int = SET_BYTES) -> tuple[DataFrame, str]:
    """`docs` with one more column, and its name: `n_words`, `hits` (a bit for each word, packed, highest bit first), `items` (sorted).

    NULL and empty texts have no words; NULL item ids are the empty string, rows of one id are one item. Documents stay as they
    are, in number and columns; they are not shuffled. `most` bounds the bytes of items in a broadcast: beyond it the documents,
    with what was found so far, are written and read once for each further set.
    """
    state = free_name(docs.columns, "found")
    for k, items in enumerate(_sets(benchmark, item_col, item_text, most)):
        windows = WindowSet([tuple(r) for r in items.select("id", "text").collect()], window)
        docs = _meet(land(docs) if k else docs, text_col, state, windows, k == 0)
    return docs, state


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """`doc_id, n_words, n_hit, n_items, items_sha256, contaminated`, a row for each row of `docs`."""
    found, state = scan(docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(options.pop("text_col", "text"))).cast("string").alias("text")), benchmark, **options)
    return digests(found.select("doc_id", state), state)


def digests(found: DataFrame, state: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, hits, items = (batch.column(1).field(k) for k in range(3))
            n_hit = [int(np.unpackbits(np.frombuffer(bits, np.uint8)).sum()) for bits in hits.to_pylist()]
            lists = items.to_pylist()
            yield pa.RecordBatch.from_arrays([
                batch.column(0), words, pa.array(n_hit, pa.int64()), pa.array([len(x) for x in lists], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in lists]), pa.array([n > 0 for n in n_hit])], names)

    kind = T.StructType([found.schema[0], *T.StructType.fromDDL("n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean")])
    names = kind.names
    return found.mapInArrow(run, kind)


def without_documents(docs: DataFrame, benchmark: DataFrame, share: float = 0.0, text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` of whose words at most `share` are hit; rows without words stay."""
    found, state = scan(docs, benchmark, text_col, **options)
    hit = F.aggregate(F.split(F.hex(F.col(state)["hits"]), ""), F.lit(0), lambda n, c: n + F.bit_count(F.coalesce(F.conv(c, 16, 10).cast("int"), F.lit(0))))
    return found.filter(hit <= F.lit(share) * F.col(state)["n_words"]).select(*[F.col(quoted(c)) for c in docs.columns])


def without_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """`docs` with every run of hit words cut out of the text, from the first letter of its first word to the end of its last."""
    found, state = scan(docs, benchmark, text_col, **options)
    names, kind = found.columns, docs.schema
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            texts = batch.column(at)
            words = words_of(texts.fill_null(""))
            cut = []
            for k, (text, bits) in enumerate(zip(texts.to_pylist(), batch.column(names.index(state)).field(1).to_pylist())):
                a, b = words.first[k], words.first[k + 1]
                hit = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
                edges = np.flatnonzero(np.diff(np.concatenate(([0], hit, [0])).astype(np.int8)))
                if not len(edges):
                    cut.append(text)
                    continue
                raw, kept, last = text.encode(), [], 0
                for x, y in zip(words.raw_start[a + edges[::2]].tolist(), words.raw_end[a + edges[1::2] - 1].tolist()):
                    kept.append(raw[last:x])
                    last = y
                cut.append(b"".join([*kept, raw[last:]]).decode())
            columns = [pa.array(cut, batch.schema.field(at).type) if k == at else batch.column(k) for k, n in enumerate(names) if n != state]
            yield pa.RecordBatch.from_arrays(columns, [n for n in names if n != state])

    return found.mapInArrow(run, kind)
