"""Cross-tokenizer alignment: where the tokens of two tokenizers cover the same bytes.

Tokens of both are intervals of bytes. All intervals of a block of texts are sorted by start at once; the running maximum of
their ends tells where groups break: at a start that reaches it. Within groups every token of one side is linked with the
run of tokens of the other side that overlap it, so links grow with tokens, not with pairs. How many documents hold a pair
of linked ids is counted over all documents, and each document's links look their counts up.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regionscore.landing import land
from regionscore.llm.common import as_bytes, blocks, key_and_text, text_column

#: Units (words with the space before) that a task remembers.
REMEMBERED = 250_000
#: Units that are encoded as one text.
JOINED = 2_000
#: Distinct pairs of ids whose counts one broadcast holds, 13 bytes each.
COUNTS = 4_000_000
#: Bytes of text that one numpy pass takes.
BLOCK = 1 << 20
#: A pair of ids is one number: A's id times this, and B's.
PAIR = np.int64(1) << np.int64(31)


def _byte_values() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(other)}}


class ByteLevel:
    """A byte-level tokenizer file; it encodes a space and the text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        values, vocabulary = _byte_values(), self.tokenizer.get_vocab(with_added_tokens=True)
        self.pieces = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for piece, number in vocabulary.items():
            self.pieces[number] = bytes(values[c] for c in piece) if all(c in values for c in piece) else piece.encode()

    def encode(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(units, add_special_tokens=False)]


class Pieces:
    """A piece model with byte fallback; it adds the space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in name.lstrip("▁") for name in names):
            raise ValueError("pieces go on beyond a space: texts can't be cut before spaces")
        self.pieces = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.space = [self.model.piece_to_id("▁")]

    def encode(self, units: list[str]) -> list[list[int]]:
        found = self.model.encode([u[1:] for u in units], num_threads=1)
        return [ids if len(u) > 1 else self.space for u, ids in zip(units, found)]


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where units start: at every text, and at every space after a character that is no white space.

    Neither tokenizer joins such a character with the space after it, so units are encoded apart. The character is seen
    by its last bytes: printable ASCII, or two bytes from U+00C0 on; after others no unit starts.
    """
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 2:
        ascii_ = (data > 0x20) & (data < 0x7F)
        latin = np.zeros(n, bool)
        latin[1:] = (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
        cut[1:n] = (data[1:] == 0x20) & (ascii_ | latin)[:-1]
    cut[offsets] = True
    cut[n] = False
    return np.flatnonzero(cut)


def spaced(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts with a space before each that isn't empty."""
    data, offsets = as_bytes(texts)
    has = np.diff(offsets) > 0
    moved = offsets + np.concatenate(([0], np.cumsum(has)))
    out = np.full(int(moved[-1]), 0x20, np.uint8)
    keep = np.ones(len(out), bool)
    keep[moved[:-1][has]] = False
    out[keep] = data
    return out, moved


def _ramp(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class Side:
    """One tokenizer's bytes and sizes by id."""

    def __init__(self, tokenizer: ByteLevel | Pieces):
        self.tokenizer = tokenizer
        self.size = np.array([len(p) for p in tokenizer.pieces], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.pool = np.frombuffer(b"".join(tokenizer.pieces), np.uint8)

    def ids(self, units: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units, and how many each has. Units that end in a character that lets one start after it are encoded
        many at a time, as one text; their bytes tell where each ends."""
        joined = [k for k in range(0, len(units), JOINED)]
        texts = ["".join(units[k:k + JOINED]) for k in joined]
        pool, counts = [], []
        for k, ids in zip(joined, self.tokenizer.encode(texts)):
            ids, want = np.array(ids, np.int32), np.cumsum(sizes[k:k + JOINED])
            ends = np.cumsum(self.size[ids])
            at = np.searchsorted(ends, want)
            if len(ids) and ends[-1] == want[-1] and (ends[at] == want).all():
                pool.append(ids)
                counts.append(np.diff(at, prepend=-1))
            else:  # some unit is not spelled byte by byte: each apart
                for apart in self.tokenizer.encode(units[k:k + JOINED]):
                    pool.append(np.array(apart, np.int32))
                    counts.append(np.array([len(apart)]))
        return np.concatenate([np.zeros(0, np.int32), *pool]), np.concatenate([np.zeros(0, np.int64), *counts])

    def equals(self, ids: np.ndarray, starts: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Whether each token's bytes are those of the data from its start on."""
        sizes = self.size[ids]
        good = starts + sizes <= len(data)
        check = np.flatnonzero(good & (sizes > 0))
        if len(check):
            same = data[_ramp(starts[check], sizes[check])] == self.pool[_ramp(self.at[ids[check]], sizes[check])]
            good[check] = np.logical_and.reduceat(same, np.cumsum(sizes[check]) - sizes[check])
        return good


class Tokens:
    """Both sides' ids of the units a task has met lately."""

    def __init__(self, a: Side, b: Side):
        self.sides = a, b
        longest = max(len(side.size) for side in self.sides)
        self.digits, self.places = _digits(np.arange(longest))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.pools = [np.zeros(0, np.int32)] * 2
        self.counts = [np.zeros(0, np.int64)] * 2

    def ids(self, units: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of the units in a row and how many each has, for both sides."""
        coded = pc.dictionary_encode(units)
        names = coded.dictionary.to_pylist()
        known = self.known
        if len(known) > REMEMBERED:
            self._forget()
            known = self.known
        fresh = [k for k, u in enumerate(names) if u not in known]
        if fresh:
            # Only the last unit of a text can end in white space; it is encoded apart.
            tail = [k for k in fresh if not (names[k][-1:].isascii() and names[k][-1:].isprintable() and names[k][-1:] != " ")]
            odd = set(tail)
            plain = [k for k in fresh if k not in odd]
            sizes = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False)
            for number, side in enumerate(self.sides):
                ids, counts = side.ids([names[k] for k in plain], sizes[plain])
                apart = side.tokenizer.encode([names[k] for k in tail]) if tail else []
                self.pools[number] = np.concatenate([self.pools[number], ids, *[np.array(x, np.int32) for x in apart]])
                self.counts[number] = np.concatenate([self.counts[number], counts, np.array([len(x) for x in apart], np.int64)])
            known.update(zip((names[k] for k in [*plain, *tail]), range(len(known), len(known) + len(fresh))))
        codes = np.array([known[u] for u in names], np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
        return [(pool[_ramp((np.cumsum(count) - count)[codes], count[codes])], count[codes]) for pool, count in zip(self.pools, self.counts)]


@dataclass
class Aligned:
    """Tokens of both sides in order of (group, side, start), and links, of a block of texts; texts by number."""

    texts: int
    ids: np.ndarray
    second: np.ndarray
    doc: np.ndarray
    group: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    link_doc: np.ndarray


def _tiled(side: Side, ids: np.ndarray, doc: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of every token, and the texts that the tokens' bytes make up."""
    sizes = side.size[ids]
    total = np.bincount(doc, sizes, len(offsets) - 1).astype(np.int64)
    before = np.cumsum(sizes) - sizes
    first = np.searchsorted(doc, np.arange(len(offsets) - 1))
    base = np.concatenate((before, [0]))[first]
    starts = before - base[doc] + offsets[doc]
    good = total == np.diff(offsets)
    right = side.equals(ids, starts, data)
    good[doc[~right]] = False
    return starts, good


def align_block(texts: pa.Array, tokens: Tokens) -> Aligned:
    """Tokens, groups and links of the texts; texts that either side doesn't spell byte by byte have none."""
    data, offsets = spaced(texts)
    starts = unit_starts(data, offsets[:-1][np.diff(offsets) > 0])
    units = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(np.concatenate((starts, [len(data)])).astype(np.int64)), pa.py_buffer(data)])
    of_unit = np.searchsorted(offsets, starts, "right") - 1
    sides = []
    whole = np.diff(offsets) > 0
    for side, (ids, count) in zip(tokens.sides, tokens.ids(units)):
        doc = np.repeat(of_unit, count)
        at, good = _tiled(side, ids, doc, data, offsets)
        whole &= good
        sides.append((ids, doc, at, at + side.size[ids]))
    sides = [tuple(x[whole[doc]] for x in (ids, doc, at, end)) for ids, doc, at, end in sides]
    (ids_a, doc_a, start_a, end_a), (ids_b, _, start_b, end_b) = sides
    ids, doc, start, end = (np.concatenate(x) for x in zip(*sides))
    second = np.repeat(np.array([False, True]), [len(ids_a), len(ids_b)])
    order = np.lexsort((second, start))
    reach = np.maximum.accumulate(end[order]) if len(order) else end
    breaks = np.ones(len(order), np.int64)
    breaks[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    # Groups are runs of bytes, so within both sides tokens are in order already; A goes before B in each.
    by = np.argsort(group * 2 + second, kind="stable")
    low = np.searchsorted(end_b, start_a, "right")
    many = np.searchsorted(start_b, end_a, "left") - low
    return Aligned(len(texts), ids[by], second[by], doc[by], group[by], np.repeat(ids_a, many), ids_b[_ramp(low, many)], np.repeat(doc_a, many))


def _digits(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of numbers below 10**7 (seven places each), and how many places count, from the right."""
    tens = 10 ** np.arange(6, -1, -1)
    return (numbers[:, None] // tens % 10 + 48).astype(np.uint8), 1 + (numbers[:, None] >= tens[:-1]).sum(1)


def group_texts(found: Aligned, tokens: Tokens) -> list[bytes]:
    """`a1,a2|b1;a3|b2,b3` of each text: groups, and in them the ids of both sides."""
    n = len(found.ids)
    if not n:
        return [b""] * found.texts
    digits, places = tokens.digits[found.ids], tokens.places[found.ids]
    mark = np.full(n, ord(","), np.uint8)
    mark[:-1][found.second[1:] != found.second[:-1]] = ord("|")
    mark[:-1][found.group[1:] != found.group[:-1]] = ord(";")
    spread = np.concatenate((digits, mark[:, None]), 1).ravel()
    keep = np.arange(7) >= 7 - places[:, None]
    kept = spread[np.concatenate((keep, np.ones((n, 1), bool)), 1).ravel()].tobytes()
    ends = np.concatenate(([0], np.cumsum(places + 1)))
    first = np.searchsorted(found.doc, np.arange(found.texts + 1))
    return [kept[ends[x]:ends[y] - 1] if y > x else b"" for x, y in zip(first[:-1].tolist(), first[1:].tolist())]


def pairs_of(found: Aligned) -> tuple[list[bytes], list[bytes]]:
    """Distinct linked pairs of each text (8 bytes, A's id * 2**31 + B's, rising) and how often each is linked (4 bytes)."""
    pair = found.link_a.astype(np.int64) * PAIR + found.link_b
    order = np.lexsort((pair, found.link_doc))
    pair, doc = pair[order], found.link_doc[order]
    fresh = np.ones(len(pair), bool)
    fresh[1:] = (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(fresh)
    times = np.diff(np.concatenate((at, [len(pair)]))).astype("<u4")
    pair, first = pair[at].astype("<i8"), np.searchsorted(doc[at], np.arange(found.texts + 1)).tolist()
    return [pair[x:y].tobytes() for x, y in zip(first, first[1:])], [times[x:y].tobytes() for x, y in zip(first, first[1:])]


ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, groups_sha256 string, pairs binary, times binary"


def align(df: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text", groups: bool = True) -> DataFrame:
    """A row of `ALIGNED` for every row of `df`: counts, the groups as text (NULL without `groups`) and its SHA-256, linked pairs.

    `byte_level` and `pieces` are paths of tokenizer files that every executor has. NULL and empty texts, and texts whose tokens
    don't spell a space and the text, have zeros, an empty digest and no pairs. Whole texts are encoded; repeated rows, NULL keys
    stay rows; other columns are left out, whatever their names.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, names = Tokens(Side(ByteLevel(byte_level)), Side(Pieces(pieces))), [c.split()[0] for c in ALIGNED.split(", ")]
        for batch in blocks(batches, BLOCK):
            found = align_block(text_column(batch, "text"), tokens)
            n = found.texts
            spelled = group_texts(found, tokens)
            pairs, times = pairs_of(found)
            count = lambda doc: pa.array(np.bincount(doc, minlength=n), pa.int64())
            first = np.ones(len(found.group), bool)
            first[1:] = found.group[1:] != found.group[:-1]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), count(found.doc[~found.second]), count(found.doc[found.second]), count(found.doc[first]), count(found.link_doc),
                pa.array([s.decode() for s in spelled] if groups else [None] * n, pa.string()),
                pa.array([hashlib.sha256(s).hexdigest() if s else "" for s in spelled]), pa.array(pairs, pa.binary()), pa.array(times, pa.binary())], names)

    return key_and_text(df, id_col, text_col).mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """`pair, n, best`: in how many rows of `aligned` the pair is linked, and whether no pair of its A id is in more.

    Every task adds up the pairs it reads, a few rows for a pair each, before they are shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        pair, n, size = np.zeros(0, np.int64), np.zeros(0, np.int64), 0

        def added() -> tuple[np.ndarray, np.ndarray]:
            new, times = np.unique(np.concatenate(held), return_counts=True)
            both, back = np.unique(np.concatenate((pair, new)), return_inverse=True)
            return both, np.bincount(back, np.concatenate((n, times)), len(both)).astype(np.int64)

        for batch in batches:
            for data in batch.column(0):
                if data.is_valid and (buffer := data.as_buffer()).size:
                    held.append(np.frombuffer(buffer, "<i8"))
                    size += len(held[-1])
            if size > 2_000_000:
                pair, n = added()
                held, size = [], 0
                if len(pair) > COUNTS:
                    yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], ["pair", "n"])
                    pair, n = pair[:0], n[:0]
        if held:
            pair, n = added()
        for k in range(0, len(pair), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(pair[k:k + 100_000]), pa.array(n[k:k + 100_000])], ["pair", "n"])

    summed = aligned.select("pairs").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    # An A id has at most as many pairs as the other vocabulary has ids.
    return summed.withColumn("best", F.expr(f"n = max(n) over (partition by pair div {int(PAIR)})"))


def with_counts(aligned: DataFrame, counts: DataFrame, most: int = COUNTS) -> DataFrame:
    """`aligned` without `pairs` and `times`, with `n_best` and `count_sum` over all links.

    Counts are broadcast, `most` pairs at a time, by ranges of A ids: if there are more, the rows, with what has been added up so far,
    are written and read once for each further range. (An A id has fewer pairs than the other vocabulary has ids.)
    """
    counts = land(counts)
    by_id = counts.groupBy(F.expr(f"pair div {int(PAIR)}").alias("a")).agg(F.count("*").alias("n")).orderBy("a").collect() if counts.count() > most else []
    edges, held = [0], 0
    for row in by_id:
        if held and held + row["n"] > most:
            edges.append(row["a"] * int(PAIR))
            held = 0
        held += row["n"]
    edges.append(2**63 - 1)
    kept = [f for f in aligned.schema.fields if f.name not in ("pairs", "times")]
    state = aligned.withColumns({"n_best": F.lit(0).cast("bigint"), "count_sum": F.lit(0).cast("bigint")})
    for k, (low, high) in enumerate(zip(edges, edges[1:])):
        state = _looked_up(land(state) if k else state, counts.filter((F.col("pair") >= low) & (F.col("pair") < high)), low, high)
    return state.select(*[f.name for f in kept], "n_best", "count_sum")


def _looked_up(state: DataFrame, counts: DataFrame, low: int, high: int) -> DataFrame:
    """`state` with the counts of the pairs from `low` to below `high` added."""
    held = counts.toArrow().sort_by("pair")
    pair, n, best = (held.column(c).to_numpy() for c in ("pair", "n", "best"))
    shared = state.sparkSession.sparkContext.broadcast((pair, n, best))
    names = state.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(names)}
            ids, sizes = as_bytes(column["pairs"])
            ids, first = np.frombuffer(ids.tobytes(), "<i8"), sizes // 8
            times = np.frombuffer(as_bytes(column["times"])[0].tobytes(), "<u4").astype(np.int64)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(first))
            here = (ids >= low) & (ids < high)
            at = np.searchsorted(pair, ids[here])
            doc, times = doc[here], times[here]
            total, most = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(total, doc, times * n[at])
            np.add.at(most, doc, np.where(best[at], times, 0))
            column["count_sum"] = pc.add(column["count_sum"], pa.array(total))
            column["n_best"] = pc.add(column["n_best"], pa.array(most))
            yield pa.RecordBatch.from_arrays([column[name] for name in names], names)

    return state.mapInArrow(run, state.schema)


def measure(df: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text", most: int = COUNTS) -> DataFrame:
    """`doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256` of every row of `df` (see `align`)."""
    aligned = land(align(df, byte_level, pieces, id_col, text_col, groups=False).drop("groups"))
    return with_counts(aligned, pair_counts(aligned), most).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def public_files(byte_level: str, pieces: str) -> tuple[str, str]:
    """Paths of two public tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path(byte_level), public_tokenizers.path(pieces)
