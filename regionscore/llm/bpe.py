"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece there is exactly one token that can end its encoding: the last token t such that
the encoding of what stands before t ends with a token u and (u, t) stays as it is when merged by rank.
Storing that token for each prefix makes appending exact (earlier entries never change) and lets an edit
keep all entries before it and, once the entries agree again for the length of the longest token, all after.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from regionscore.llm.common import blocks, key_and_text, text_column

#: Pieces up to so many bytes are remembered, and so many of them in one Python worker.
REMEMBERED_BYTES, REMEMBERED = 48, 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: a line for each token, base64 and number."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    return ranks


class PrefixTable:
    """The encoding of one piece: the last token of each of its prefixes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        """Add bytes at the end; nothing that is stored changes."""
        self.data += more
        self.vocabulary.extend(self.data, self.last)

    def edit(self, start: int, stop: int, new: bytes) -> None:
        """Replace data[start:stop]; entries are worked out again only near the edit."""
        old_last, shift, longest = self.last[stop:], len(new) - (stop - start), self.vocabulary.longest
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = self.last[:start]
        agree, first_old = 0, start + len(new)
        while len(self.last) < len(self.data):
            self.vocabulary.extend(self.data, self.last, len(self.last) + 1)
            at = len(self.last) - first_old
            if at > 0:
                agree = agree + 1 if self.last[-1] == old_last[at - 1] else 0
                # An entry depends on the bytes and entries of the last `longest` places only.
                if agree >= longest and at >= longest:
                    self.last += old_last[at:]
        assert len(self.last) == len(self.data) and shift == len(new) - (stop - start)

    def tokens(self) -> list[int]:
        """Ids of the whole piece."""
        return self.vocabulary.walk(self.data, self.last)


class Vocabulary:
    """Ranks, and which neighbours stay apart."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.apart: dict[tuple[int, int], bool] = {}
        self.spines: dict[int, tuple[list, list] | None] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}

    def merged(self, data: bytes, least: int = 1) -> list[int]:
        """Ids by merging the neighbours of lowest rank, leftmost first, down to `least` parts; for short data."""
        parts = [data[i:i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > least:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge joins; None for a byte and for a token that merging never yields."""
        if token not in self.halves:
            data = self.bytes_of[token]
            two = self.merged(data, 2) if len(data) > 1 else []
            joined = len(two) == 2 and self.ranks.get(self.bytes_of[two[0]] + self.bytes_of[two[1]]) == token
            self.halves[token] = tuple(two) if joined else None
        return self.halves[token]

    def edges(self, token: int) -> tuple[list, list] | None:
        """What stands at the left and at the right edge while the token is merged: (bytes, rank of the merge that
        ends it), the token itself first. None if merging its bytes doesn't yield it."""
        if token not in self.spines:
            sides = ([], [])
            for side in (0, 1):
                now, until = token, 1 << 60
                while now is not None:
                    sides[side].append((self.bytes_of[now], until))
                    halves = self.split(now)
                    if halves is None and len(self.bytes_of[now]) > 1:
                        sides = None
                        break
                    now, until = (halves[side], now) if halves else (None, 0)
                if sides is None:
                    break
            self.spines[token] = sides
        return self.spines[token]

    def stays(self, left: int, right: int) -> bool:
        """The two tokens next to each other are the encoding of their joined bytes.

        They are unless, at some time of the merging, the parts at both sides of the border have a merge of lower
        rank than what either of them goes into; of equal ranks the left one goes first.
        """
        a, b = self.edges(left), self.edges(right)
        if a is None or b is None:
            return False
        a, b, i, j, ranks = a[1], b[0], 0, 0, self.ranks
        while True:
            (x, until_x), (y, until_y) = a[i], b[j]
            rank = ranks.get(x + y)
            if rank is not None and rank < until_x and rank <= until_y:
                return False
            # Back in time: the later of the two merges that made x and y is undone.
            made_x = ranks[x] if i + 1 < len(a) else -1
            made_y = ranks[y] if j + 1 < len(b) else -1
            if made_x < 0 and made_y < 0:
                return True
            if made_x > made_y:
                i += 1
            else:
                j += 1

    def extend(self, data: bytes, last: list[int], stop: int | None = None) -> None:
        """Fill `last` for all prefixes of `data` up to `stop` bytes; last[i] ends the prefix of i + 1 bytes."""
        ranks, apart, longest = self.ranks, self.apart, self.longest
        for end in range(len(last) + 1, (len(data) if stop is None else stop) + 1):
            for start in range(end - 1, end - longest - 1 if end > longest else -1, -1):
                token = ranks.get(data[start:end])
                if token is None:
                    continue
                if start:
                    pair = last[start - 1], token
                    good = apart.get(pair)
                    if good is None:
                        if len(apart) >= 1_000_000:
                            apart.clear()
                        good = apart[pair] = self.stays(*pair)
                else:
                    good = self.edges(token) is not None
                if good:
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token ends the prefix of {end} bytes")

    def walk(self, data: bytes, last: list[int]) -> list[int]:
        """Ids from the stored last tokens, back to front; a piece that is a token is that token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        ids, end = [], len(data)
        while end:
            ids.append(last[end - 1])
            end -= len(self.bytes_of[ids[-1]])
        return ids[::-1]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        last: list[int] = []
        self.extend(piece, last)
        return self.walk(piece, last)


class Encoder:
    """Encodes and decodes texts; each match of the pattern is a piece of its own. `forget` drops what texts have taught it."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.vocabulary = Vocabulary(ranks)
        self.find = regex.compile(pattern).findall
        self.token_of = self.vocabulary.bytes_of
        self.known: dict[str, bytes] = {}

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        pieces = list(map(self.find, texts))
        new = sorted((p.encode(), p) for p in set().union(*pieces).difference(self.known))
        known, vocabulary = self.known, self.vocabulary
        # In sorted order a piece starts like the one before; the table of that start is kept and appended to.
        before, last = b"", []
        for data, piece in new:
            same, most = 0, min(len(before), len(data))
            while same < most and before[same] == data[same]:
                same += 1
            del last[same:]
            vocabulary.extend(data, last)
            known[piece] = np.array(vocabulary.walk(data, last), "<u4").tobytes()
            before = data
        packed = [b"".join(map(known.__getitem__, p)) for p in pieces]
        if len(known) > REMEMBERED:
            for _, piece in new:
                del known[piece]
        else:
            for data, piece in new:
                if len(data) > REMEMBERED_BYTES:
                    del known[piece]
        return packed

    def forget(self) -> None:
        self.known.clear()
        self.vocabulary.apart.clear()

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed([text])[0], "<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_of.__getitem__, ids))


#: One encoder for each rank file and pattern in a Python worker: the ranks are read once. A worker goes on to other stages, so
#: remembered pieces and pairs are dropped at the end of a partition.
_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(ranks: str, pattern: str) -> Encoder:
    if (ranks, pattern) not in _ENCODERS:
        _ENCODERS[ranks, pattern] = Encoder(read_ranks(ranks), pattern)
    return _ENCODERS[ranks, pattern]


ENCODED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
DIGESTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])


def encode(df: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id` and token `ids` of every row of `df`: whole texts, without special tokens.

    `ranks` is the path of a rank file that every executor has; `pattern` splits texts into pieces.
    NULL and empty texts have no ids. Repeated rows and NULL keys stay as they are; other columns are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(ranks, pattern)
        for batch in blocks(batches):
            packed = e.encode_packed(text_column(batch, "text").to_pylist())
            offsets = np.concatenate(([0], np.cumsum([len(p) // 4 for p in packed]))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])
        e.forget()

    return key_and_text(df, id_col, text_col).mapInArrow(run, ENCODED)


def decode(df: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """`doc_id` and the bytes (`data`) that the ids stand for; NULL ids give no bytes. An unknown id is an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(ranks, pattern)
        for batch in batches:
            data = [e.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    return df.select(df[id_col].cast("bigint").alias("doc_id"), df[ids_col].cast("array<int>").alias("ids")).mapInArrow(run, "doc_id bigint, data binary")


def round_trip(df: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, n_tokens, ids_sha256, decoded_sha256`: texts are encoded and the ids decoded again in one pass.

    The digests are of the ids as little-endian unsigned 32-bit integers and of the decoded bytes. Rows as in `encode`.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(ranks, pattern)
        digest = lambda data: hashlib.sha256(data).hexdigest()
        for batch in blocks(batches):
            counts, of_ids, of_bytes = [], [], []
            for packed in e.encode_packed(text_column(batch, "text").to_pylist()):
                ids = np.frombuffer(packed, "<u4")
                counts.append(len(ids))
                of_ids.append(digest(packed))
                of_bytes.append(digest(e.decode(ids.tolist())))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_bytes)], DIGESTS.names)
        e.forget()

    return key_and_text(df, id_col, text_col).mapInArrow(run, DIGESTS)


def public_vocabulary(file: str) -> tuple[str, str]:
    """Path of a public rank file and the pattern that goes with it."""
    import public_tokenizers

    return public_tokenizers.path(file), public_tokenizers.PATTERN
