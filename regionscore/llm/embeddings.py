"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

A vector is turned by sign flips and Hadamard transforms, three times; its hash is the signed axis it then lies
nearest to, of two turns together. Several tables, and in each the next-best axes as well, make similar vectors meet in
a bucket with high probability; all pairs that meet are verified by cosine in double precision. Equal vectors are one
class with a number, so copies never meet. A pair counts in the first bucket that both have, so links are counted
without listing them; buckets above a size are cut into blocks that meet pairwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionscore.landing import land
from regionscore.llm.common import quoted
from regionscore.llm.components import components


@dataclass(frozen=True)
class Hashing:
    """Tables, axes looked at in each of the two turns of a table, buckets kept of their combinations, members of a block."""

    tables: int = 10
    axes: int = 3
    probes: int = 4
    block: int = 1024
    seed: int = 5


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    """Three rounds of random signs and a Hadamard transform; columns are filled up to a power of two."""
    n = 1 << max(0, int(x.shape[1] - 1).bit_length())
    y = np.zeros((len(x), n))
    y[:, :x.shape[1]] = x
    random = np.random.default_rng(seed)
    for _ in range(3):
        y *= random.choice([-1.0, 1.0], n)
        width = 1
        while width < n:
            pairs = y.reshape(len(y), n // (2 * width), 2, width)
            y = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(len(y), n)
            width *= 2
        y /= np.sqrt(n)
    return y


def buckets(x: np.ndarray, h: Hashing) -> np.ndarray:
    """Sorted bucket numbers of each vector in each table, best combinations of axes: (vectors, tables, probes)."""
    out = np.empty((len(x), h.tables, h.probes), np.int32)
    for table in range(h.tables):
        signed, sizes = [], []
        for turn in range(2):
            y = rotated(x, h.seed * 1000 + table * 2 + turn)
            best = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :h.axes]
            if best.shape[1] < h.axes:
                best = np.concatenate([best] + [best[:, -1:]] * (h.axes - best.shape[1]), axis=1)
            value = np.take_along_axis(y, best, axis=1)
            signed.append(2 * best + (value > 0))
            sizes.append(np.abs(value))
        sums = (sizes[0][:, :, None] + sizes[1][:, None, :]).reshape(len(x), -1)
        codes = (signed[0][:, :, None] * 4096 + signed[1][:, None, :]).reshape(len(x), -1)
        top = np.argsort(-sums, axis=1, kind="stable")[:, :h.probes]
        out[:, table] = np.sort(np.take_along_axis(codes, top, axis=1), axis=1)
    return out


def _first_met(a: np.ndarray, b: np.ndarray, table: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The pairs of rows have no common bucket before (table, code)."""
    first = np.ones(len(a), bool)
    for t in range(a.shape[1]):
        same = a[:, t, :, None] == b[:, t, None, :]
        same &= (t < table)[:, None, None] | ((t == table)[:, None, None] & (a[:, t, :, None] < code[:, None, None]))
        first &= ~same.any(axis=(1, 2))
    return first


HASHED = T.StructType([T.StructField("cls", T.LongType()), T.StructField("codes", T.BinaryType()), T.StructField("dim", T.IntegerType())])
FOUND = T.StructType([T.StructField("cls", T.LongType()), T.StructField("links", T.LongType()), T.StructField("other", T.LongType())])


def usable(vector: str, label: str):
    """A label, and a vector that has a direction: no NULL or non-finite component, not all zero."""
    good = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf"))
    v = F.col(vector)
    return F.coalesce(F.col(label).isNotNull() & v.isNotNull() & F.forall(v, good) & F.exists(v, lambda x: x != 0), F.lit(False))


def near(df: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", hashing: Hashing | None = None) -> DataFrame:
    """`vec_id, n_links, component_id, kept` of every row: links to other rows of the label with cosine >= `least`.

    Vectors without a direction, and rows with a NULL label, link with nothing and are kept. Vectors of different length never
    link. Rows that repeat a vector link with each other. `component_id` is the smallest id reachable (NULL ids are
    above all); `kept`: the row has that id.
    """
    h = hashing or Hashing()
    rows = df.select(F.col(quoted(id_col)).cast("bigint").alias("vec_id"), F.col(quoted(vector_col)).alias("v"), F.col(quoted(label_col)).cast("string").alias("label"))
    rows = rows.withColumn("used", usable("v", "label"))
    classes = rows.filter("used").groupBy("label", "v").agg(F.count("*").alias("n"), F.min("vec_id").alias("least_id"))
    classes = land(classes.withColumn("cls", F.monotonically_increasing_id()))
    found = land(_links(classes, least, h))
    joined = components(found.filter("other is not null").select(F.col("cls").alias("a"), F.col("other").alias("b")))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    told = classes.join(links, "cls", "left").join(joined.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    told = land(told.select("label", "v", "component", "least_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    first = told.groupBy("component").agg(F.min("least_id").alias("component_id"))
    told = land(told.join(first, "component").select("label", "v", "n_links", "component_id"))
    # Only classes of a row with others, or with links, need to be told; the rest speak for themselves.
    told = told.filter("n_links > 0")
    out = rows.join(told, ["label", "v"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def _links(classes: DataFrame, least: float, h: Hashing) -> DataFrame:
    """`cls, links, other`: linked rows of other classes that a block found, and edges that join what is linked."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1)
            sizes = np.diff(vectors.offsets.to_numpy())
            values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.concatenate(([0], np.cumsum(sizes)))
            codes: list[bytes] = [b""] * batch.num_rows
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                x = values[starts[at][:, None] + np.arange(size)]
                x = x / np.abs(x).max(axis=1, keepdims=True)
                for row, code in zip(at.tolist(), buckets(x, h)):
                    codes[row] = code.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.binary()), pa.array(sizes.astype(np.int32))], HASHED.names)

    codes = land(classes.select("cls", "v").mapInArrow(hashed, HASHED))
    labelled = codes.join(classes.select("cls", "label"), "cls")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int32).reshape(-1, h.tables, h.probes)
            table = np.broadcast_to(np.arange(h.tables, dtype=np.int32)[None, :, None], codes.shape)
            keep = np.ones(codes.shape, bool)
            keep[:, :, 1:] = codes[:, :, 1:] != codes[:, :, :-1]
            row = np.broadcast_to(np.arange(len(codes))[:, None, None], codes.shape)[keep]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(row)), batch.column(2).take(pa.array(row)), batch.column(3).take(pa.array(row)), pa.array(table[keep]), pa.array(codes[keep])], ["cls", "dim", "label", "t", "code"])

    placed = labelled.select("cls", "codes", "dim", "label").mapInArrow(spread, "cls bigint, dim int, label string, t int, code int")
    bucket = ["label", "dim", "t", "code"]
    placed = land(placed)
    sizes = placed.groupBy(*bucket).agg(F.count("*").alias("m")).filter("m > 1").select(*bucket, F.ceil(F.col("m") / h.block).cast("int").alias("cuts"))
    met = placed.join(sizes, bucket)
    # Blocks i <= j of a bucket meet; a member is in block `own`.
    own = F.pmod(F.xxhash64("cls", "t"), F.col("cuts")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda k: F.struct(F.least(k, F.col("own")).alias("i"), F.greatest(k, F.col("own")).alias("j")))
    met = met.withColumn("own", own).select("cls", *bucket, "own", F.inline(pairs))
    full = met.join(classes.select("cls", "n", "v"), "cls").join(codes.select("cls", "codes"), "cls")

    full = full.select(F.xxhash64(*bucket, "i", "j").alias("g"), "cls", "n", "v", "codes", "t", "code", "own", "i", "j", "label", "dim")
    order = ["g", "label", "dim", "t", "code", "i", "j", "cls"]

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            # Whole groups go on; the last one may continue in the next batch.
            g = batch.column(0).to_numpy()
            last = len(g) - int(np.argmax(g[::-1] != g[-1])) if (g != g[-1]).any() else 0
            if last:
                yield _found(pa.Table.from_batches([*held, batch.slice(0, last)]), least, h)
                held = []
            held.append(batch.slice(last))
        if held:
            yield _found(pa.Table.from_batches(held), least, h)

    return full.repartition("g").sortWithinPartitions(*order).drop("label", "dim").mapInArrow(blocks_of, FOUND)


def _unit(vectors: pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows of length 1, filled up with zeros."""
    flat = vectors.combine_chunks()
    size = np.diff(flat.offsets.to_numpy())
    x = np.zeros((len(flat), size.max()))
    x[np.arange(size.max()) < size[:, None]] = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _found(rows: pa.Table, least: float, h: Hashing) -> pa.RecordBatch:
    """Links within blocks, or between two: for each class the rows it links with, and the smallest class joined to it."""
    g, cls, n, t, code, own, i, j = (rows.column(c).to_numpy() for c in ("g", "cls", "n", "t", "code", "own", "i", "j"))
    # Two groups with one hash are told apart by their order as well: a group ends where any of these changes.
    keys = np.stack([g, t.astype(np.int64), code.astype(np.int64), i.astype(np.int64), j.astype(np.int64)])
    first = np.flatnonzero(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0))))
    x = _unit(rows.column("v"))
    codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.int32).reshape(len(g), h.tables, h.probes)
    links, joined = np.zeros(len(g), np.int64), []

    def take(p: np.ndarray, q: np.ndarray) -> None:
        joined.append((p, q))
        once = _first_met(codes[p], codes[q], t[p], code[p])
        np.add.at(links, p[once], n[q[once]])
        np.add.at(links, q[once], n[p[once]])

    small_p, small_q = [], []
    for a, b in zip(first.tolist(), np.append(first[1:], len(g)).tolist()):
        if i[a] == j[a] and b - a <= 24:
            p, q = _PAIRS[b - a]
            small_p.append(p + a)
            small_q.append(q + a)
            continue
        left, right = a + np.flatnonzero(own[a:b] == i[a]), a + np.flatnonzero(own[a:b] == j[a])
        for c in range(0, len(left), 256):
            p, q = np.nonzero(x[left[c:c + 256]] @ x[right].T >= least)
            p, q = left[c + p], right[q]
            some = p < q if i[a] == j[a] else np.ones(len(p), bool)
            p, q = p[some], q[some]
            for d in range(0, len(p), 50_000):
                take(p[d:d + 50_000], q[d:d + 50_000])
    if small_p:
        p, q = np.concatenate(small_p), np.concatenate(small_q)
        for c in range(0, len(p), 50_000):
            u, w = p[c:c + 50_000], q[c:c + 50_000]
            some = np.einsum("ij,ij->i", x[u], x[w]) >= least
            take(u[some], w[some])
    label = np.arange(len(g))
    if joined:
        u, w = np.concatenate([p for p, _ in joined]), np.concatenate([q for _, q in joined])
        while True:
            low, new = np.minimum(label[u], label[w]), label.copy()
            np.minimum.at(new, u, low)
            np.minimum.at(new, w, low)
            new = new[new]
            if (new == label).all():
                break
            label = new
    some = np.flatnonzero((links > 0) | (label != np.arange(len(g))))
    return pa.RecordBatch.from_arrays([pa.array(cls[some]), pa.array(links[some]), pa.array(cls[label[some]])], FOUND.names)


#: Pairs of the members of a small group.
_PAIRS = [np.triu_indices(m, 1) for m in range(25)]
