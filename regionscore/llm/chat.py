"""Chat formatting by columnar byte assembly, with a loss mask, and the way back.

A turn is `<|role|>`, a line end, the text, `<|end|>`, a line end. Lengths of all segments of a block of turns give
their offsets by cumulative sums; headers and contents are scattered into one buffer that becomes an Arrow column.
In texts, a backslash goes before each backslash and each control string; in roles, also before each `<`, `|`, `>`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionscore.llm.common import as_bytes, blocks, quoted, text_column

#: Strings that must not stand in a text as they are: marks of this and of other common templates.
CONTROL = (b"<|", b"|>", b"<s>", b"</s>", b"[INST]", b"[/INST]", b"<<SYS>>", b"<</SYS>>")
_OPEN, _CLOSE, _END = b"<|", b"|>\n", b"<|end|>\n"
_BACKSLASH = 92

FORMATTED = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("part", T.LongType()), T.StructField("n_turns", T.IntegerType()),
    T.StructField("formatted", T.StringType()), T.StructField("loss_start", T.ArrayType(T.IntegerType())),
    T.StructField("loss_end", T.ArrayType(T.IntegerType()))])


def to_escape(data: np.ndarray, offsets: np.ndarray, role: bool) -> np.ndarray:
    """Bytes that get a backslash before them. Control strings do not reach over the end of a text."""
    mark = data == _BACKSLASH
    if role:
        return mark | (data == ord("<")) | (data == ord("|")) | (data == ord(">"))
    for first in {c[0] for c in CONTROL}:
        at = np.flatnonzero(data == first)
        if not len(at):
            continue
        end = offsets[np.searchsorted(offsets, at, "right")]
        for control in (c for c in CONTROL if c[0] == first):
            hit = at[at + len(control) <= end]
            for k in range(1, len(control)):
                hit = hit[data[hit + k] == control[k]]
            mark[hit] = True
    return mark


def _scatter(out: np.ndarray, data: np.ndarray, offsets: np.ndarray, mark: np.ndarray, base: np.ndarray) -> None:
    """Copy each text, with its backslashes, to its base in the buffer."""
    upto = np.cumsum(mark)
    before = np.concatenate(([0], upto))[offsets[:-1]]
    place = np.arange(len(data)) + upto + np.repeat(base - offsets[:-1] - before, np.diff(offsets))
    out[place] = data
    out[place[mark] - 1] = _BACKSLASH


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all turns in one buffer, the turns' offsets, and start and end of each turn's text."""
    (r, r_at), (t, t_at) = as_bytes(roles), as_bytes(texts)
    r_mark, t_mark = to_escape(r, r_at, True), to_escape(t, t_at, False)
    size = lambda mark, at: np.diff(at) + np.diff(np.concatenate(([0], np.cumsum(mark)))[at])
    r_size, t_size = size(r_mark, r_at), size(t_mark, t_at)
    total = r_size + t_size + len(_OPEN) + len(_CLOSE) + len(_END)
    offsets = np.concatenate(([0], np.cumsum(total)))
    out = np.empty(offsets[-1], np.uint8)
    start = offsets[:-1]
    role_at = start + len(_OPEN)
    close_at = role_at + r_size
    text_at = close_at + len(_CLOSE)
    end_at = text_at + t_size
    for constant, at in ((_OPEN, start), (_CLOSE, close_at), (_END, end_at)):
        out[at[:, None] + np.arange(len(constant))] = np.frombuffer(constant, np.uint8)
    _scatter(out, r, r_at, r_mark, role_at)
    _scatter(out, t, t_at, t_mark, text_at)
    return out, offsets, text_at, end_at


def format_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", learn_role: str = "assistant") -> DataFrame:
    """Formatted conversations: `conv_id, part, n_turns, formatted, loss_start, loss_end`.

    A conversation is one part, or several that follow each other by `part` where it is long; parts joined in order are
    the whole. `loss_start` and `loss_end` are byte places within the part of the texts of `learn_role`. Turns go by
    `turn` (NULL first), then role and text; NULL roles and texts are empty. Rows without a conversation are one of
    their own (NULL). The turns are dealt out by ranges, so that a hot conversation is split.
    """
    own = df.select(F.col(quoted(conv_col)).cast("bigint").alias("conv_id"), F.col(quoted(turn_col)).cast("bigint").alias("turn"),
                    F.coalesce(F.col(quoted(role_col)).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")).alias("text"))
    dealt = own.repartitionByRange("conv_id", "turn", "role").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in blocks(batches):
            roles, texts = text_column(batch, "role"), text_column(batch, "text")
            out, offsets, text_at, end_at = assemble(roles, texts)
            ids = batch.column(0)
            filled, missing = pc.fill_null(ids, 0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
            change = np.flatnonzero((filled[1:] != filled[:-1]) | (missing[1:] != missing[:-1])) + 1
            first = np.concatenate(([0], change)).astype(np.int64)
            stop = np.concatenate((change, [batch.num_rows])).astype(np.int64)
            part_at = offsets[np.concatenate((first, [batch.num_rows]))].astype(np.int32)
            formatted = pa.StringArray.from_buffers(len(first), pa.py_buffer(part_at), pa.py_buffer(out))
            learn = pc.equal(roles, learn_role).to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(learn)
            base = np.repeat(part_at[:-1], stop - first)[rows]
            edges = pa.array(np.searchsorted(rows, np.concatenate((first, [batch.num_rows]))).astype(np.int32))
            spans = [pa.ListArray.from_arrays(edges, pa.array((at[rows] - base).astype(np.int32))) for at in (text_at, end_at)]
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(first)), pa.array(number + np.arange(len(first))), pa.array((stop - first).astype(np.int32)), formatted, *spans], FORMATTED.names)
            number += len(first)

    return dealt.select("conv_id", "role", "text").mapInArrow(run, FORMATTED)


def escapes(data: np.ndarray) -> np.ndarray:
    """Backslashes that stand before an escaped byte: every other one of a run, from its first."""
    slash = np.flatnonzero(data == _BACKSLASH)
    out = np.zeros(len(data), bool)
    if len(slash):
        new = np.concatenate(([True], np.diff(slash) > 1))
        start = slash[np.flatnonzero(new)][np.cumsum(new) - 1]
        out[slash[(slash - start) % 2 == 0]] = True
    return out


def parse(formatted: bytes) -> tuple[list[tuple[bytes, bytes]], np.ndarray]:
    """Roles and texts as they were before formatting, and the places of all escaping backslashes."""
    data = np.frombuffer(formatted, np.uint8)
    escape = escapes(data)
    free = np.ones(len(data), bool)
    free[1:] = ~escape[:-1]
    pair = lambda a, b: np.flatnonzero((data[:-1] == ord(a)) & (data[1:] == ord(b)) & free[:-1])
    opened, closed = pair("<", "|"), pair("|", ">")
    kept = np.concatenate(([0], np.cumsum(~escape)))
    plain = data[~escape].tobytes()
    spans = zip(kept[opened[0::2] + 2].tolist(), kept[closed[0::2]].tolist(), kept[closed[0::2] + 3].tolist(), kept[opened[1::2]].tolist())
    return [(plain[a:b], plain[c:d]) for a, b, c, d in spans], escape


DIGESTS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
    T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])


def _characters(data: np.ndarray) -> int:
    return int(((data & 0xC0) != 0x80).sum())


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations, one row for each.

    Parts go in order through running digests, so that a conversation of any length takes the memory of one part.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, done = None, []

        def finished(s: list) -> tuple:
            return s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]

        for batch in batches:
            for conv, text, starts, ends in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(finished(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                raw = text.encode()
                turns, escape = parse(raw)
                data = np.frombuffer(raw, np.uint8)
                for role, content in turns:
                    state[2].update(role + b"\n" + content + b"\n")
                for a, b in zip(starts, ends):
                    content = data[a:b][~escape[a:b]]
                    state[3] += _characters(content)
                    state[4].update(content.tobytes())
                state[1] += len(turns)
                state[5] += _characters(data)
            if len(done) >= 2000:
                yield _rows(done)
                done = []
        if state is not None:
            done.append(finished(state))
        if done:
            yield _rows(done)

    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return dealt.select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(run, DIGESTS)


def _rows(done: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], DIGESTS.names)
