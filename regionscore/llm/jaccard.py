"""Similarity join on word shingles, with count-vector R-trees.

Every set of shingles is also a point: shingles are dealt to groups by hash, and the numbers in the groups are the
coordinates. The sum of the smaller coordinates of two points bounds the overlap of their sets from above, and so
does that of a point and the upper corner of a box of points; an R-tree over the points leaves out whole boxes.
What survives is verified on the sets themselves, exactly.

Which points come into one tree: equal sets are one class. Two different sets that are similar enough share one of
their first shingles in any order common to all sets; the order here puts often used shingles last (by counts in a
table of fixed size), so that passages and lines that many documents share bring few sets together. The sets that
share a first shingle are a block. All members of a block are first compared with one of them, that of the smallest document, which
joins groups of near copies in linear work; only members of blocks that are not one component after that meet in a tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionscore.landing import land
from regionscore.llm.common import add_up, as_bytes, blocks, free_name, key_and_text, mixed, narrow, quoted, sets_of, shingle_hashes, text_column, word_hashes
from regionscore.llm.components import components


@dataclass(frozen=True)
class Join:
    """Words of a shingle, percent of intersection to union, shingles of a set for each coordinate of its point (half as
    many at least), counters of shingle use (a power of two), entries of a tree's node, and members of a block that one
    group holds."""

    words: int = 5
    percent: int = 80
    crowd: int = 1
    counter_bits: int = 20
    fanout: int = 16
    chunk: int = 2048

    def groups(self, n: int) -> int:
        """Coordinates of the point of a set of n shingles: a power of two, so that sets of like size fit by adding neighbours."""
        return 1 << max(4, (max(n, 1) - 1) // self.crowd).bit_length()

    def least_overlap(self, a, b):
        """Smallest overlap of sets of these sizes that links them."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def sizes_agree(self, a, b):
        return 100 * np.minimum(a, b) >= self.percent * np.maximum(a, b)


#: Bytes of counters in one row, and bits of the filter of wanted sets.
_COUNTER_BLOCK, _FILTER_BITS = 1 << 14, 25


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each text."""
    data, offsets = as_bytes(texts)
    hashes, doc, _, _ = word_hashes(data, offsets)
    return sets_of(*shingle_hashes(hashes, doc, len(texts), words))


def set_id(shingles: np.ndarray) -> int:
    """64 bits that stand for the whole set; 0 for the empty one."""
    if not len(shingles):
        return 0
    both = np.array([shingles.sum(dtype=np.uint64) + np.uint64(len(shingles)), np.bitwise_xor.reduce(shingles)], np.uint64)
    a, b = mixed(both)
    return int(np.array([a ^ (b << np.uint64(1))], np.uint64).view(np.int64)[0]) or 1


def point(shingles: np.ndarray, groups: int) -> np.ndarray:
    """Numbers of shingles by the first bits of their hashes; a set with more than 255 in a group gets the point that meets all others."""
    counts = np.bincount((shingles >> np.uint64(65 - groups.bit_length())).astype(np.int64), minlength=groups)
    return counts.astype("u1") if counts.max() < 256 else np.full(groups, 255, "u1")


def packed(point: np.ndarray) -> bytes:
    """A point in a bit for each shingle and each coordinate: as many ones as the coordinate's number, then a zero."""
    bits = np.ones(-(-(len(point) + int(point.sum(dtype=np.int64))) // 8) * 8, "u1")
    bits[np.cumsum(point, dtype=np.int64) + np.arange(len(point))] = 0
    return np.packbits(bits).tobytes()


def folded(points: np.ndarray, groups: int) -> np.ndarray:
    """Points with fewer coordinates, sums of neighbours."""
    return points if points.shape[1] == groups else points.reshape(len(points), groups, -1).sum(axis=2, dtype=points.dtype)


SETS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("set", T.LongType()), T.StructField("data", T.BinaryType())])


def described(docs: DataFrame, join: Join) -> DataFrame:
    """Landed row for each document: size, id and point of its set; and rows (n < 0) of the counters of shingle use."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = np.zeros(1 << join.counter_bits, np.uint32)
        top = np.uint64(64 - join.counter_bits)
        for batch in blocks(batches):
            sets = shingle_sets(text_column(batch, "text"), join.words)
            points = [packed(point(s, join.groups(len(s)))) for s in sets]
            every = np.concatenate(sets)
            np.add(used, np.bincount((every >> top).astype(np.int64), minlength=len(used)).astype(np.uint32), out=used)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int32()), pa.array([set_id(s) for s in sets], pa.int64()), pa.array(points, pa.binary())], SETS.names)
        if used.any():
            cut = used.reshape(-1, min(_COUNTER_BLOCK, len(used)))
            some = np.flatnonzero(cut.any(axis=1))
            yield pa.RecordBatch.from_arrays([
                pa.nulls(len(some), pa.int64()), pa.array((-1 - some).astype(np.int32)), pa.nulls(len(some), pa.int64()), pa.array([narrow(cut[k]) for k in some], pa.binary())], SETS.names)

    return land(docs.mapInArrow(run, SETS))


def use_classes(counters: dict[int, np.ndarray], join: Join) -> np.ndarray:
    """0 for shingles of usual use, then 1 and up for each doubling of what a counter has beyond that.

    Many seldom used shingles share a counter; what they add up to, and the spread of it, is usual.
    """
    used = np.zeros((max(1, (1 << join.counter_bits) // _COUNTER_BLOCK), min(_COUNTER_BLOCK, 1 << join.counter_bits)))
    for block, sums in counters.items():
        used[block] = sums
    used = used.ravel()
    middle = np.median(used)
    beyond, usual = used - middle, 8 + 5 * np.sqrt(middle)
    return np.where(beyond > usual, 1 + np.floor(np.log2(np.maximum(beyond, 1) / usual)), 0).astype(np.uint8)


def first_shingles(docs: DataFrame, classes: np.ndarray, join: Join) -> DataFrame:
    """`shingle, set, n`: of each set so many of its least used shingles that similar sets share one of them."""
    shared, top = docs.sparkSession.sparkContext.broadcast(classes), np.uint64(64 - join.counter_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = shared.value
        for batch in blocks(batches):
            out, owner, size = [np.zeros(0, np.uint64)], [], []
            for s in shingle_sets(text_column(batch, "text"), join.words):
                n = len(s)
                # A set this small is similar to no other set but itself.
                if n * (100 - join.percent) < join.percent and (n + 1) * join.percent > 100 * n:
                    continue
                count = n + (-join.percent * n // 100) + 1
                c = use[(s >> top).astype(np.int64)]
                first = s[:count] if not c.any() else s[np.argsort(c, kind="stable")[:count]]
                out.append(first)
                owner.append(np.full(count, set_id(s)))
                size.append(np.full(count, n, np.int32))
            if owner:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64)), pa.array(np.concatenate(owner)), pa.array(np.concatenate(size))], ["shingle", "set", "n"])

    return docs.select("text").mapInArrow(run, "shingle bigint, set bigint, n int")


MEMBERS = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("first", T.LongType()), T.StructField("first_n", T.IntegerType()),
    T.StructField("member", T.LongType()), T.StructField("member_n", T.IntegerType())])


def block_members(firsts: DataFrame, join: Join) -> DataFrame:
    """Landed distinct `block, first, first_n, member, member_n`: other members of each block, with its first one.

    Blocks of the same sets get the same number, so they are one. A block of two that differ too much in size is left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        long: tuple[int, int, int, int] | None = None  # a block that goes on: shingle, first, its size, last member
        seen: set[int] = set()
        for batch in batches:
            shingle = batch.column(0).to_numpy()
            last = len(shingle) - int(np.argmax(shingle[::-1] != shingle[-1])) if (shingle != shingle[-1]).any() else 0
            if last:
                table = pa.Table.from_batches([*held, batch.slice(0, last)])
                held = []
                out, long = _members(table, join, seen, long, whole=True)
                if out.num_rows:
                    yield out
            elif held and held[-1].column(0)[-1].as_py() != shingle[0]:
                # A block starts with the batch: the one that was held ends before it.
                out, long = _members(pa.Table.from_batches(held), join, seen, long, whole=True)
                held = []
                if out.num_rows:
                    yield out
            held.append(batch.slice(last))
            if sum(b.num_rows for b in held) > 50_000:
                out, long = _members(pa.Table.from_batches(held), join, seen, long, whole=False)
                held = []
                if out.num_rows:
                    yield out
        if held:
            yield _members(pa.Table.from_batches(held), join, seen, long, whole=True)[0]

    dealt = firsts.repartition("shingle").sortWithinPartitions("shingle", "set")
    return land(dealt.mapInArrow(run, MEMBERS).distinct())


def _members(rows: pa.Table, join: Join, seen: set[int], long, whole: bool):
    """Members of the blocks in sorted rows; `long` is the state of a block too large to hold, `whole` that no block goes on."""
    shingle, owner, n = (rows.column(c).to_numpy() for c in ("shingle", "set", "n"))
    new = np.concatenate(([True], (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])))
    if long is not None and shingle[0] == long[0] and owner[0] == long[3]:
        new &= ~((shingle == long[0]) & (owner == long[3]))
    shingle, owner, n = shingle[new], owner[new], n[new]
    out = [[], [], [], [], []]

    def add(block, first, first_n, member, member_n):
        for to, x in zip(out, (block, first, first_n, member, member_n)):
            to.append(x)

    begin = 0
    if long is not None and len(shingle):
        begin = int(np.searchsorted(shingle != long[0], True)) if shingle[0] == long[0] else 0
        if begin:
            add(np.full(begin, long[0]), np.full(begin, long[1]), np.full(begin, long[2]), owner[:begin], n[:begin])
            long = (*long[:3], int(owner[begin - 1]))
        if begin < len(shingle) or whole:
            long = None
    shingle, owner, n = shingle[begin:], owner[begin:], n[begin:]
    if not whole and len(shingle):
        # All rows are of one block that goes on: it keeps its shingle as number.
        add(np.full(len(owner) - 1, shingle[0]), np.full(len(owner) - 1, owner[0]), np.full(len(owner) - 1, n[0]), owner[1:], n[1:])
        long = (int(shingle[0]), int(owner[0]), int(n[0]), int(owner[-1]))
    elif len(shingle):
        start = np.flatnonzero(np.concatenate(([True], shingle[1:] != shingle[:-1])))
        size = np.diff(np.append(start, len(shingle)))
        number = mixed(np.add.reduceat(mixed(owner.view(np.uint64)), start)).view(np.int64)
        keep = (size > 2) | ((size == 2) & join.sizes_agree(n[start], n[np.minimum(start + 1, len(n) - 1)]))
        fresh = []
        for i in np.flatnonzero(keep).tolist():
            if (x := int(number[i])) not in seen:
                if len(seen) < 1_000_000:
                    seen.add(x)
                fresh.append(i)
        fresh = np.array(fresh, np.int64)
        if len(fresh):
            many = size[fresh] - 1
            at = np.repeat(start[fresh] + 1 - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
            add(np.repeat(number[fresh], many), np.repeat(owner[start[fresh]], many), np.repeat(n[start[fresh]], many), owner[at], n[at])
    arrays = [np.concatenate(x) if x else np.zeros(0) for x in out]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(x.astype(k.to_pandas_dtype())) for x, k in zip(arrays, kinds)], MEMBERS.names), long


class Tree:
    """An R-tree over points of set sizes and group counts, packed by size and then by the first coordinates."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, fanout: int):
        order = np.lexsort((*points[:, :2].T[::-1], sizes))
        self.rows = [order]
        upper, low, high = points[order], sizes[order], sizes[order]
        self.levels = [(upper, low, high)]
        self.fanout = fanout
        while len(upper) > fanout:
            start = np.arange(0, len(upper), fanout)
            upper, low, high = np.maximum.reduceat(upper, start), np.minimum.reduceat(low, start), np.maximum.reduceat(high, start)
            self.levels.append((upper, low, high))

    def near(self, points: np.ndarray, sizes: np.ndarray, join: Join) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of all pairs that sizes and summed minima leave possible."""
        top = len(self.levels[-1][1])
        query, node = np.repeat(np.arange(len(points)), top), np.tile(np.arange(top), len(points))
        for depth in range(len(self.levels) - 1, -1, -1):
            upper, low, high = self.levels[depth]
            kept_q, kept_n = [], []
            size_of_step = max(1, (1 << 20) // points.shape[1])
            for a in range(0, len(query), size_of_step):
                q, x = query[a:a + size_of_step], node[a:a + size_of_step]
                size = sizes[q]
                good = (100 * high[x] >= join.percent * size) & (100 * size >= join.percent * low[x])
                q, x, size = q[good], x[good], size[good]
                least = join.least_overlap(size, np.maximum(low[x], -(-join.percent * size // 100)))
                bound = np.minimum(points[q], upper[x]).sum(axis=1, dtype=np.int64)
                kept_q.append(q[bound >= least])
                kept_n.append(x[bound >= least])
            query, node = (np.concatenate(k) if k else np.zeros(0, np.int64) for k in (kept_q, kept_n))
            if depth:
                children = len(self.levels[depth - 1][1])
                node = (node[:, None] * self.fanout + np.arange(self.fanout)).ravel()
                query = np.repeat(query, self.fanout)[node < children]
                node = node[node < children]
        return query, self.rows[0][node]


def _points(data: list[bytes], groups: int) -> np.ndarray:
    """Packed points of one number of coordinates as rows."""
    out, at_once = np.empty((len(data), groups), np.uint16), max(1, (1 << 20) // groups)
    for a in range(0, len(data), at_once):
        some = data[a:a + at_once]
        zeros = np.flatnonzero(np.unpackbits(np.frombuffer(b"".join(some), "u1")) == 0).reshape(len(some), groups)
        size = 8 * np.array([len(x) for x in some])
        out[a:a + at_once] = np.diff(zeros, axis=1, prepend=(np.cumsum(size) - size - 1)[:, None]) - 1
    return out


def possible(pairs: DataFrame, join: Join) -> DataFrame:
    """Of the pairs `a, a_n, a_data, b, b_n, b_data` those whose points allow a link: distinct `a, b`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(5).to_pylist()
            a_n, b_n = (batch.column(i).to_numpy().astype(np.int64) for i in (1, 4))
            least = join.least_overlap(a_n, b_n)
            sizes = np.array([(join.groups(x), join.groups(y)) for x, y in zip(a_n.tolist(), b_n.tolist())])
            good = np.zeros(batch.num_rows, bool)
            for p, q in np.unique(sizes, axis=0).tolist():
                rows = np.flatnonzero((sizes[:, 0] == p) & (sizes[:, 1] == q))
                for at in range(0, len(rows), max(1, (1 << 20) // max(p, q))):
                    some = rows[at:at + max(1, (1 << 20) // max(p, q))]
                    x, y = (folded(_points([of[i] for i in some], wide), min(p, q)) for of, wide in ((left, p), (right, q)))
                    good[some] = np.minimum(x, y).sum(axis=1) >= least[some]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3)], ["a", "b"]).filter(pa.array(good))

    return pairs.select("a", "a_n", "a_data", "b", "b_n", "b_data").mapInArrow(run, "a bigint, b bigint")


def wanted_filter(ids: DataFrame) -> np.ndarray:
    """A filter of a fixed number of bits that lets all values of the column `id` through, and few others while they are few."""
    bit = F.shiftrightunsigned(F.xxhash64("id"), 64 - _FILTER_BITS)
    words = ids.select(F.shiftright(bit, 6).cast("int").alias("w"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(bit, F.lit(64)).cast("int")).alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    out = np.zeros(1 << (_FILTER_BITS - 6), np.uint64)
    for r in words.collect():
        out[r["w"]] = np.uint64(r["b"] & (2**64 - 1))
    return out


def wanted_sets(docs: DataFrame, ids: DataFrame, join: Join) -> DataFrame:
    """Landed `id, shingles` of the sets whose ids are in the column `id`, worked out again from the texts."""
    ids = land(ids.select("id").distinct())
    hashed = docs.sparkSession.sparkContext.broadcast(wanted_filter(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = hashed.value, set()
        for batch in blocks(batches):
            found, numbers = [], []
            for s in shingle_sets(text_column(batch, "text"), join.words):
                number = set_id(s)
                if number and number not in seen and _passes(wanted, number):
                    if len(seen) < 1_000_000:
                        seen.add(number)
                    found.append(s.view(np.int64))
                    numbers.append(number)
            if found:
                edges = np.concatenate(([0], np.cumsum([len(s) for s in found]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(found)))], ["id", "shingles"])

    made = docs.select("text").mapInArrow(run, "id bigint, shingles array<bigint>")
    return land(made.join(ids, "id", "left_semi").dropDuplicates(["id"]))


def _passes(wanted: np.ndarray, number: int) -> bool:
    bit = _xxhash64(number) >> (64 - _FILTER_BITS)
    return bool(int(wanted[bit >> 6]) >> (bit & 63) & 1)


def _xxhash64(value: int) -> int:
    """Spark's xxhash64 of one bigint."""
    import xxhash

    return xxhash.xxh64_intdigest(value.to_bytes(8, "little", signed=True), 42)


def verified(pairs: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """The pairs `a, b` whose sets link, by the sets themselves."""
    left, right = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    common = pairs.join(left, "a").join(right, "b").select("a", "b", F.size("x").alias("p"), F.size("y").alias("q"), F.size(F.array_intersect("x", "y")).alias("i"))
    return common.filter(F.lit(100) * F.col("i") >= F.lit(join.percent) * (F.col("p") + F.col("q") - F.col("i"))).select("a", "b")


def centred(members: DataFrame, one: DataFrame) -> DataFrame:
    """Landed `block, id, n, centre, centre_n`: all members of each block, with the one that the smallest document has.

    Copies come after what they were made from, so that is the member that most others are similar to.
    """
    rows = members.select("block", F.col("member").alias("id"), F.col("member_n").alias("n")).union(members.select("block", "first", "first_n").distinct())
    known = rows.join(one.select("id", "least"), "id")
    centre = known.groupBy("block").agg(F.min(F.struct("least", "id", "n")).alias("c")).select("block", F.col("c.id").alias("centre"), F.col("c.n").alias("centre_n"))
    return land(rows.join(centre, "block"))


def unresolved(rows: DataFrame, joined: DataFrame, described_sets: DataFrame, join: Join) -> DataFrame:
    """Pairs in blocks whose members are not one component yet that size and trees leave possible: `a, b`, once for each such block."""
    rows = land(rows.join(joined.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id")))
    # Blocks of two were compared when their member was.
    main = F.max(F.when(F.col("id") == F.col("centre"), F.col("component")))
    open_blocks = rows.groupBy("block").agg(F.count("*").alias("m"), main.alias("main"), F.min("component").alias("low"), F.max("component").alias("high"))
    open_blocks = land(open_blocks.filter("low < high and m > 2").select("block", "m", "main"))
    rows = rows.select("block", "id", "component").join(open_blocks, "block")
    rows = rows.withColumn("apart", F.col("component") != F.col("main"))
    others = land(rows.filter("apart").groupBy("block").agg(F.count("*").alias("m2")))
    rows = rows.join(others, "block").withColumn("cuts", F.ceil(F.col("m") / join.chunk).cast("int")).withColumn("cuts2", F.ceil(F.col("m2") / join.chunk).cast("int"))
    # Every member as an entry of a tree, those apart from the main component as queries too; in the cell of both it is one row.
    i, j = F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int"), F.pmod(F.xxhash64("id"), F.col("cuts2")).cast("int")
    spread = lambda n: F.sequence(F.lit(0), n - 1)
    entries = F.transform(spread(F.col("cuts2")), lambda k: F.struct(i.alias("i"), k.alias("j"), F.lit(True).alias("entry"), (F.col("apart") & (k == j)).alias("query")))
    others = F.filter(spread(F.col("cuts")), lambda k: F.col("apart") & (k != i))
    queries = F.transform(others, lambda k: F.struct(k.alias("i"), j.alias("j"), F.lit(False).alias("entry"), F.lit(True).alias("query")))
    met = rows.select("block", "id", "component", "apart", F.inline(F.concat(entries, queries)))
    full = met.join(described_sets, "id").select(F.xxhash64("block", "i", "j").alias("g"), "id", "component", "apart", "entry", "query", "n", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            g = batch.column(0).to_numpy()
            last = len(g) - int(np.argmax(g[::-1] != g[-1])) if (g != g[-1]).any() else 0
            if last:
                yield _meeting(pa.Table.from_batches([*held, batch.slice(0, last)]), join)
                held = []
            held.append(batch.slice(last))
        if held:
            yield _meeting(pa.Table.from_batches(held), join)

    return full.repartition("g").sortWithinPartitions("g").mapInArrow(run, "a bigint, b bigint")


def _meeting(rows: pa.Table, join: Join) -> pa.RecordBatch:
    """Possible links of each group's queries with its entries, of different components."""
    g, number, component, n = (rows.column(c).to_numpy() for c in ("g", "id", "component", "n"))
    apart, entry, query = (rows.column(c).to_numpy().astype(bool) for c in ("apart", "entry", "query"))
    data = rows.column("data").to_pylist()
    n, width = n.astype(np.int64), np.array([join.groups(x) for x in n.tolist()])
    first = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def meet(asks: np.ndarray, entries: np.ndarray, groups: int) -> None:
        taken = lambda at: folded(_points([data[i] for i in at], int(width[at[0]])), groups)
        p, q = Tree(taken(entries), n[entries], join.fanout).near(taken(asks), n[asks], join)
        p, q = asks[p], entries[q]
        good = (component[p] != component[q]) & join.sizes_agree(n[p], n[q]) & (~apart[q] | (number[p] < number[q]))
        a.append(number[p[good]])
        b.append(number[q[good]])

    for start, stop in zip(first.tolist(), np.append(first[1:], len(g)).tolist()):
        asks, entries = start + np.flatnonzero(query[start:stop]), start + np.flatnonzero(entry[start:stop])
        # Sets that can link have as many coordinates, or one twice as many as the other.
        for w in np.unique(width[entries]).tolist():
            own = entries[width[entries] == w]
            for other in (w // 2, w, 2 * w):
                if len(some := asks[width[asks] == other]):
                    meet(some, own, min(w, other))
    a, b = np.concatenate(a), np.concatenate(b)
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1]))], ["a", "b"])


def links(docs: DataFrame, join: Join) -> tuple[DataFrame, DataFrame]:
    """What is known of each document's set (`doc_id, n, set, data`), and links between sets (`a, b`) that join all that are similar.

    `docs` has `key` and `text`. All links between different texts are kept as far as components go: a link is left
    out only where its ends are joined already.
    """
    told = described(docs, join)
    counters = add_up(told.filter("n < 0").select((-1 - F.col("n")).alias("block"), "data"), min(_COUNTER_BLOCK, 1 << join.counter_bits))
    sets = told.filter("n >= 0")
    if not counters:
        empty = sets.select(F.col("set").alias("a"), F.col("set").alias("b")).filter("false")
        return sets, empty
    members = block_members(first_shingles(docs, use_classes(counters, join), join), join)
    met = members.select(F.col("first").alias("set")).union(members.select("member")).distinct()
    one = sets.filter("n > 0").join(met, "set", "left_semi").groupBy(F.col("set").alias("id")).agg(
        F.coalesce(F.min("doc_id"), F.lit(2**63 - 1)).alias("least"), F.first("n").alias("n"), F.first("data").alias("data"))
    one = land(one)
    rows = centred(members, one)

    agree = 100 * F.least("n", "centre_n") >= join.percent * F.greatest("n", "centre_n")
    stars = rows.filter((F.col("id") != F.col("centre")) & agree).select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    side = lambda x: one.select(F.col("id").alias(x), F.col("n").alias(f"{x}_n"), F.col("data").alias(f"{x}_data"))
    stars = land(possible(stars.join(side("a"), "a").join(side("b"), "b"), join))
    ends = lambda pairs: pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    found = land(verified(stars, wanted_sets(docs, ends(stars), join), join))

    more = land(unresolved(rows, components(found), one, join).distinct())
    return sets, land(found.union(verified(more, wanted_sets(docs, ends(more), join), join)))


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", join: Join | None = None) -> DataFrame:
    """`doc_id, n_shingles, component_id, set, component` of every row: the smallest id that links reach, the row's own included.

    A text without words, or NULL, has an empty set and links with nothing. Equal sets always link. NULL ids are left
    out of the smallest; where all are NULL it is NULL. Repeated rows are members like any other. `component` stands for
    the linked sets themselves, whatever the ids.
    """
    sets, edges = links(key_and_text(df, id_col, text_col), join or Join())
    classes = land(sets.filter("n > 0").groupBy("set").agg(F.min("doc_id").alias("least"), F.count("*").alias("m")))
    joined = components(edges).withColumnRenamed("node", "set")
    tied = classes.join(joined, "set").select("set", "component", "least")
    smallest = tied.groupBy("component").agg(F.min("least").alias("component_id"))
    told = tied.join(smallest, "component").select("set", "component_id", "component")
    # Only sets of several rows, or with links, need to be told; other rows are their own component.
    copies = classes.filter("m > 1").join(told, "set", "left_anti").select("set", F.col("least").alias("component_id"), F.col("set").alias("component"))
    told = land(told.union(copies))
    out = sets.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), "set").join(told, "set", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "set", F.coalesce("component", "set").alias("component"))


def unique(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", join: Join | None = None) -> DataFrame:
    """The rows of `df`, all columns, of which one of each group of linked rows stays: that of the smallest id.

    Rows without words all stay. Of rows that agree in id and set one stays.
    """
    join = join or Join()
    told = groups(df, id_col, text_col, join)
    key = F.coalesce("doc_id", F.lit(2**63 - 1))
    best = F.min(F.struct(key.alias("k"), F.col("set").alias("s")))
    kept = land(told.filter("n_shingles > 0").groupBy("component").agg(best.alias("b")).select("b.k", "b.s"))
    names = df.columns
    own_key, own_set, own_row, stays = (free_name(names, x) for x in ("own_key", "own_set", "own_row", "stays"))
    place = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            texts = pc.fill_null(batch.column(place).cast(pa.string()), "")
            numbers = [set_id(s) for s in shingle_sets(texts, join.words)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], names=[*batch.schema.names, own_set])

    own = df.select(*[F.col(quoted(c)) for c in names], F.coalesce(F.col(quoted(id_col)).cast("bigint"), F.lit(2**63 - 1)).alias(own_key))
    rows = own.mapInArrow(run, T.StructType([*own.schema.fields, T.StructField(own_set, T.LongType())]))
    # A row without words is one of its own.
    rows = rows.withColumn(own_row, F.when(F.col(own_set) == 0, F.monotonically_increasing_id()).otherwise(F.lit(-1)))
    kept = kept.select(F.col("k").alias(own_key), F.col("s").alias(own_set), F.lit(True).alias(stays))
    rows = rows.join(kept, [own_key, own_set], "left").filter(F.col(stays) | (F.col(own_set) == 0)).dropDuplicates([own_key, own_set, own_row])
    return rows.select(*[F.col(quoted(c)) for c in names])
