"""Language-model scores: a log-bilinear neural model trained by noise-contrastive estimation, and unigram counts.

Counts of all words of the training texts are exact and stay distributed. The neural model predicts a class for each
token from the two tokens before it: one of the most frequent words, the end, or one of `groups` groups (by the last
bytes) of all other words. A group's words that occur `least` times or more have vectors of their own, as many as the
corpus has (`frequent` at most): as targets in two more levels, a bin of the group and a word of the bin, each
normalised over its few siblings, and as contexts, added to the features of their group. Other words of a group share
one vector there and go by their counts.

A score is bilinear in the features of context and class. For contexts without vectors of their own, tables of matrix
products hold all of it with the normaliser of every pair; for others the normaliser sums products of the exponentials
of both contexts, kept for frequent words and worked out once in a block for others. A token's probability is then
exact and normalised: over all known words and one unknown word the probabilities add up to 1.

Training reads all training texts: each task runs stochastic gradients over its own, from a start that a bounded
sample gave, and the tasks' parameters are averaged by tokens, a word's vectors by the tokens that met them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionscore.landing import land
from regionscore.llm.common import BLOCK_BYTES, as_bytes, blocks, key_and_text, quoted, text_column, word_hashes


@dataclass(frozen=True)
class Settings:
    """Words with a class of their own, groups of the others, words whose counts are broadcast, width, and training.

    Broadcast words that occur `least` times have vectors, trained in steps of `pace` against `siblings` noise words.
    `start_texts` windows of `start_chars` characters give the start of the training.
    """

    words: int = 767
    groups: int = 128
    frequent: int = 524_288
    least: int = 5
    width: int = 24
    noise: int = 32
    batch: int = 2048
    rate: float = 0.4
    siblings: int = 2
    pace: float = 0.2
    start_texts: int = 400
    start_chars: int = 2000
    start_epochs: int = 4


@dataclass
class Tree:
    """Words with vectors below the groups: `word` is the number of a frequent word (`words`: none).

    Nodes are the words, bin after bin, then for each group its bins and what it has besides. Families of siblings are
    the bins, then the groups; a family's nodes begin at `starts`. `base` is the log share of a node among its siblings by counts.
    """

    words: int
    word: np.ndarray
    bin_of: np.ndarray
    bin_node: np.ndarray
    rest: np.ndarray
    rest_size: np.ndarray
    starts: np.ndarray
    base: np.ndarray

    @property
    def bins(self) -> int:
        return len(self.starts) - 1 - len(self.rest)

    def paths(self, group: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes of tokens of groups and their families: first all in their groups, then those (`has`) in their bins."""
        has = np.flatnonzero(word < self.words)
        bins = self.bin_of[word]
        node = np.where(word < self.words, self.bin_node[bins], self.rest[group])
        return np.concatenate((node, word[has])), np.concatenate((self.bins + group, bins[has])), has


def grown(counts: np.ndarray, groups: np.ndarray, vectors: np.ndarray, rest: np.ndarray) -> Tree:
    """The tree over the frequent words that `vectors` marks; `rest` is what else each group weighs."""
    picked = np.flatnonzero(vectors)
    picked = picked[np.lexsort((-counts[picked], groups[picked]))]
    n, number = len(picked), len(rest)
    word = np.full(len(counts), n)
    word[picked] = np.arange(n)
    many = np.bincount(groups[picked], minlength=number)
    size = np.maximum(np.ceil(np.sqrt(many)).astype(np.int64), 1)
    bins = -(-many // size)
    first_word, first_bin = np.cumsum(many) - many, np.cumsum(bins) - bins
    g = groups[picked]
    bin_of = first_bin[g] + (np.arange(n) - first_word[g]) // size[g]
    weight, total = counts[picked] + 1.0, int(bins.sum())
    of_bin = np.bincount(bin_of, weight, total) if n else np.zeros(total)
    group_of_bin = np.repeat(np.arange(number), bins)
    bin_node = n + np.arange(total) + group_of_bin
    rest_node = n + np.cumsum(bins + 1) - 1
    base = np.zeros(n + total + number)
    of_group = np.bincount(group_of_bin, of_bin, number) + rest if total else rest.astype(float)
    base[:n] = np.log(weight / of_bin[bin_of])
    base[bin_node] = np.log(of_bin / of_group[group_of_bin])
    base[rest_node] = np.log(rest / of_group)
    starts = np.concatenate((np.searchsorted(bin_of, np.arange(total)), rest_node - bins, [len(base)])).astype(np.int64)
    pad = lambda x: np.append(x, 0).astype(np.int64)
    return Tree(n, word, pad(bin_of), pad(bin_node), rest_node, rest, starts, base.astype(np.float32))


@dataclass
class Vocabulary:
    """Frequent words by sorted hash: their count and class (-1: by group). Classes: words, groups, then the end."""

    settings: Settings
    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    group_tokens: np.ndarray
    group_words: np.ndarray
    texts: int
    tokens: int
    distinct: int
    class_counts: np.ndarray = field(default=None)
    tree: Tree = field(default=None)

    @property
    def size(self) -> int:
        return self.settings.words + self.settings.groups + 1

    @cached_property
    def upto(self) -> np.ndarray:
        """Shares of the tree's nodes added up; each family adds 1."""
        return np.cumsum(np.exp(self.tree.base.astype(np.float64)))

    @cached_property
    def guide(self) -> np.ndarray:
        """The node where each of a family's equal shares begins, as many shares as it has nodes."""
        starts = self.tree.starts
        size = np.diff(starts)
        family = np.repeat(np.arange(len(size)), size)
        return np.searchsorted(self.upto, family + (np.arange(len(family)) - starts[family]) / size[family])

    def siblings(self, family: np.ndarray, draws: np.ndarray) -> np.ndarray:
        """Nodes of the families by their shares, for draws between 0 and 1."""
        first, end = self.tree.starts.take(family), self.tree.starts.take(family + 1)
        at = np.minimum(self.guide.take(first + (draws * (end - first)).astype(np.int64)), len(self.upto) - 1)
        draws = draws + family
        return np.clip(_advanced(at, self.upto, draws), first, end - 1)

    @property
    def end(self) -> int:
        return self.size - 1

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place among the frequent words; -1 for others."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        shift, starts = self.leading
        at = _advanced(starts.take((hashes >> shift).view(np.int64)), self.hashes, hashes)
        at[self.hashes.take(at) != hashes] = -1
        return at

    @cached_property
    def leading(self) -> tuple[np.uint64, np.ndarray]:
        """Bits that follow the leading ones, and the first place (one that exists) whose hash is no less than each number of leading bits."""
        bits = min(len(self.hashes).bit_length() + 1, 22)
        shift = np.uint64(64 - bits)
        return shift, np.minimum(np.searchsorted(self.hashes, np.arange(1 << bits, dtype=np.uint64) << shift), len(self.hashes) - 1)

    def __getstate__(self) -> dict:
        return {k: x for k, x in self.__dict__.items() if k not in ("leading", "upto", "guide")}


def _advanced(at: np.ndarray, ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The first place from `at` on (the last one at most) where the ordered numbers are no less than the values; overwrites `at`."""
    less = np.flatnonzero((ordered.take(at) < values) & (at < len(ordered) - 1))
    while len(less):
        at[less] += 1
        now = at[less]
        less = less[(ordered.take(now) < values[less]) & (now < len(ordered) - 1)]
    return at


def group_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, groups: int) -> np.ndarray:
    """Group of a word, by its last two bytes in lower case."""
    low = lambda b: np.where((b >= 65) & (b <= 90), b + 32, b).astype(np.uint32)
    last, before = low(data[ends - 1]), np.where(ends - starts > 1, low(data[np.maximum(ends - 2, 0)]), 0).astype(np.uint32)
    return ((last * np.uint32(2654435761) + before * np.uint32(40503 * 65537 % 2**32)) >> np.uint32(16)).astype(np.int64) % groups


def tokenized(texts: pa.Array, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, group and text number of every word."""
    data, offsets = as_bytes(texts)
    hashes, doc, starts, ends = word_hashes(data, offsets)
    return hashes, group_of(data, starts, ends, groups), doc


def word_counts(texts: DataFrame, settings: Settings) -> DataFrame:
    """Landed `word` (hash), `grp` and `c` of all words in the column `text`; each task adds up its own first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            h, g, c = (np.concatenate(x) for x in zip(*held))
            words, first, at = np.unique(h, return_index=True, return_inverse=True)
            return words, g[first], np.bincount(at, c, len(words)).astype(np.int64)

        for batch in blocks(batches):
            h, g, _ = tokenized(text_column(batch, "text"), settings.groups)
            words, first, c = np.unique(h, return_index=True, return_counts=True)
            held.append((words, g[first], c))
            size += len(words)
            if size > 1_000_000:
                held = [merged()]
                size = len(held[0][0])
                if size > 700_000:
                    yield _counted(*held[0])
                    held, size = [], 0
        if held:
            yield _counted(*merged())

    rows = texts.select("text").mapInArrow(run, "word bigint, grp int, c bigint")
    return land(rows.groupBy("word").agg(F.min("grp").alias("grp"), F.sum("c").alias("c")))


def _counted(words: np.ndarray, groups: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(groups.astype(np.int32)), pa.array(counts)], ["word", "grp", "c"])


def vocabulary(counts: DataFrame, texts: int, settings: Settings) -> Vocabulary:
    """What is broadcast of the counts: at most `settings.frequent` words and totals by group."""
    step = F.floor(F.log2("c") * 8)
    steps = counts.groupBy(step.alias("s")).agg(F.count("*").alias("n")).orderBy(F.desc("s")).collect()
    least, room = None, settings.frequent
    for r in steps:
        room -= r["n"]
        if room < 0:
            break
        least = r["s"]
    rows = counts.filter(step >= least if least is not None else F.lit(False)).select("word", "grp", "c").toArrow()
    words, g, c = (rows.column(x).to_numpy().astype(np.int64) for x in ("word", "grp", "c"))
    by = np.lexsort((words, -c))
    words, g, c = words[by].view(np.uint64), g[by], c[by]
    own = min(settings.words, len(words))
    group_tokens, group_words = np.zeros(settings.groups), np.zeros(settings.groups)
    for r in counts.groupBy("grp").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():
        group_tokens[r["grp"]], group_words[r["grp"]] = r["c"], r["n"]
    tokens, distinct = int(group_tokens.sum()) + texts, int(group_words.sum()) + (texts > 0)
    np.subtract.at(group_tokens, g[:own], c[:own])
    np.subtract.at(group_words, g[:own], 1)
    vectors = c >= settings.least
    vectors[:own] = False
    rest = group_tokens + group_words + 1 - np.bincount(g[vectors], c[vectors] + 1.0, settings.groups)
    classes = np.full(len(words), -1)
    classes[:own] = np.arange(own)
    by = np.argsort(words)
    class_counts = np.zeros(settings.words + settings.groups + 1)
    class_counts[:own] = c[:own]
    class_counts[settings.words:-1] = group_tokens
    class_counts[-1] = texts
    return Vocabulary(settings, words[by], c[by], classes[by], group_tokens, group_words, texts, tokens, distinct, class_counts, grown(c[by], g[by], vectors[by], rest))


def classes_of(v: Vocabulary, hashes: np.ndarray, groups: np.ndarray, doc: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Class of every token (words and ends), its place among the frequent words, and the two classes before it."""
    found = v.find(hashes)
    own = np.where(found >= 0, v.classes[found] if len(v.classes) else -1, -1)
    place = np.arange(len(hashes)) + doc
    ids = np.full(len(hashes) + texts, v.end)
    ids[place] = np.where(own >= 0, own, v.settings.words + groups)
    starts = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=texts) + 1)))[:-1]
    none = v.size
    one = np.concatenate(([none], ids[:-1]))
    one[starts] = none
    two = np.concatenate(([none], one[:-1]))
    two[starts] = none
    return ids, found, one, two


def words_of(v: Vocabulary, found: np.ndarray, doc: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of every token (words and ends) among the words with vectors, and of the two before it."""
    none = v.tree.words
    out = np.full(len(found) + texts, none)
    out[np.arange(len(found)) + doc] = np.where(found >= 0, v.tree.word[found] if len(v.hashes) else none, none)
    starts = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=texts) + 1)))[:-1]
    one = np.concatenate(([none], out[:-1]))
    one[starts] = none
    two = np.concatenate(([none], one[:-1]))
    two[starts] = none
    return out, one, two


@dataclass
class Vectors:
    """Vectors (with an offset) of the tree's nodes and what its words add to contexts (one row more, for none), and how often each was met."""

    nodes: np.ndarray
    own: np.ndarray
    node_steps: np.ndarray = field(default=None)
    own_steps: np.ndarray = field(default=None)
    node_met: np.ndarray = field(default=None)
    own_met: np.ndarray = field(default=None)

    @staticmethod
    def fresh(v: Vocabulary, kind=np.float32) -> Vectors:
        n, d, w = len(v.tree.base), v.settings.width, v.tree.words + 1
        return Vectors(np.zeros((n, d + 1), kind), np.zeros((w, d), kind))

    def trained(self) -> Vectors:
        self.node_steps, self.own_steps, self.node_met, self.own_met = (np.zeros(len(x), np.float32) for x in (self.nodes, self.own) * 2)
        return self

    def learn(self, v: Vocabulary, q: np.ndarray, ids: np.ndarray, word: np.ndarray, turn: np.ndarray, pace: float, random) -> np.ndarray:
        """A step of noise-contrastive estimation among siblings, of the tokens that are in groups; what it tells the contexts.

        Tokens are ordered by class and word; `turn` is their place in the batch, by which they draw their noise.
        """
        tree, k, d = v.tree, v.settings.siblings, q.shape[1]
        low, high = np.searchsorted(ids, [v.settings.words, v.end])
        nodes, family, has = tree.paths(ids[low:high] - v.settings.words, word[low:high])
        turn = turn[low:high]
        draw = np.concatenate((_ranks(turn), high - low + _ranks(turn[has])))
        noise = v.siblings(np.repeat(family, k), random.random((len(family), k)).take(draw, axis=0).ravel())
        every = np.concatenate((nodes[:, None], noise.reshape(-1, k)), axis=1)
        unit = np.zeros((len(every), d + 2), np.float32)
        unit[:high - low, :d], unit[high - low:, :d] = q[low:high], q[low:high].take(has, axis=0)
        unit[:, d] = 1
        values = self.nodes.take(every, axis=0)
        # Siblings by counts are the noise and the start of the scores, so that the two cancel out.
        error = _sigma(np.einsum("nkd,nd->nk", values, unit[:, :-1]) - np.float32(np.log(k)))
        error[:, 0] -= 1
        told = np.einsum("nk,nkd->nd", error, values[:, :, :-1])
        back = np.zeros_like(q)
        back[low:high] = told[:high - low]
        back[low + has] += told[high - low:]
        _shorten(unit[:, :d])
        by, rows = _ordered(every.ravel())
        error = error.ravel().take(by)
        steps = unit.take(np.repeat(np.arange(len(every)), k + 1).take(by), axis=0)
        steps *= error[:, None]
        steps[:, -1] = error * error
        _paced(self.nodes, self.node_steps, rows, steps, pace)
        np.add.at(self.node_met, nodes, np.float32(1))
        return back

    def learn_contexts(self, w1: np.ndarray, w2: np.ndarray, told: np.ndarray, squares: np.ndarray, pace: float) -> None:
        """Steps of the words before, near ones first, by what they are told."""
        rows = np.concatenate((w1, w2))
        has = np.flatnonzero(rows < len(self.own) - 1)
        if len(has):
            by, rows = _ordered(rows[has])
            has = has.take(by)
            steps = np.empty((len(has), told.shape[1] + 1), np.float32)
            steps[:, :-1], steps[:, -1] = told.take(has, axis=0), squares.take(has)
            _paced(self.own, self.own_steps, rows, steps, pace)
            np.add.at(self.own_met, rows, np.float32(1))

    def packed(self) -> Iterator[tuple[int, bytes]]:
        """Rows that were met, in blocks: even ones of the nodes, odd ones of the contexts."""
        for kind, values, met in ((0, self.nodes, self.node_met), (1, self.own, self.own_met)):
            rows = np.flatnonzero(met)
            cut = np.searchsorted(rows, np.arange(0, len(met) + _ROWS, _ROWS))
            for block, (a, b) in enumerate(zip(cut, cut[1:])):
                if b > a:
                    r = rows[a:b]
                    yield 2 * block + kind, _pack(r - block * _ROWS, met[r], values[r])


#: Rows of a block of vectors on the way.
_ROWS = 1024


def _pack(rows: np.ndarray, met: np.ndarray, values: np.ndarray) -> bytes:
    return rows.astype("<u2").tobytes() + met.astype("<f4").tobytes() + values.astype("<f2").tobytes()


def _unpack(data, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(data) // (6 + 2 * width)
    return np.frombuffer(data, "<u2", n), np.frombuffer(data, "<f4", n, 2 * n), np.frombuffer(data, "<f2", n * width, 6 * n).reshape(n, width)


def _single(x: np.ndarray) -> np.ndarray:
    """Half floats that are finite as single ones, by their bits, as numpy takes them one by one; others as they are."""
    if x.dtype != np.float16:
        return x
    bits = np.ascontiguousarray(x).view(np.int16).astype(np.int32)
    bits <<= 13
    bits &= -0x70002000
    out = bits.view(np.float32)
    out *= np.float32(2.0**112)
    return out


def averaged(parts: DataFrame, width: int) -> list:
    """One row for each `block`: sums of plain vectors (below 0), or the mean of each row of vectors by how often it was met."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if block < 0:
                    vector = np.frombuffer(data.as_buffer(), "<f8")
                    sums[block] = sums[block] + vector if block in sums else vector.copy()
                    continue
                wide = width + 1 - block % 2
                rows, met, values = _unpack(data.as_buffer(), wide)
                if block not in sums:
                    sums[block] = np.zeros((_ROWS, wide + 1))
                sums[block][rows, 0] += met
                sums[block][rows, 1:] += met[:, None] * values.astype(np.float64)
        for block, x in sums.items():
            if block >= 0:
                rows = np.flatnonzero(x[:, 0])
                data = _pack(rows, x[rows, 0], x[rows, 1:] / x[rows, :1])
            else:
                data = x.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([data], pa.binary())], ["block", "data"])

    kind = "block int, data binary"
    first = parts.repartition("block", F.pmod(F.spark_partition_id(), F.lit(4))).mapInArrow(run, kind)
    return first.repartition("block").mapInArrow(run, kind).collect()


@dataclass
class Model:
    """Features of contexts (one row more, for none) and classes, a matrix for each of the two places, offsets, and vectors of words."""

    features: np.ndarray
    near: np.ndarray
    far: np.ndarray
    targets: np.ndarray
    bias: np.ndarray
    vectors: Vectors | None = None

    def inputs(self, one: np.ndarray, two: np.ndarray, w1: np.ndarray, w2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features of the two contexts, with what their words add."""
        return self.context(one, w1), self.context(two, w2)

    def context(self, cls: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = self.features.take(cls, axis=0)
        if self.vectors is not None:
            out += _single(self.vectors.own.take(word, axis=0))
        return out

    @cached_property
    def reach(self) -> tuple[float, float]:
        """Length of the longest class and the largest offset."""
        return float(_longest(self.targets)), float(np.abs(self.bias).max())

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.features, self.near, self.far, self.targets, self.bias)]).astype(np.float64)

    @staticmethod
    def of(flat: np.ndarray, size: int, width: int) -> Model:
        shapes, out, at = [(size + 1, width), (width, width), (width, width), (size, width), (size,)], [], 0
        for shape in shapes:
            n = int(np.prod(shape))
            out.append(flat[at:at + n].reshape(shape).astype(np.float32))
            at += n
        return Model(*out)


def _longest(x: np.ndarray) -> float:
    return np.sqrt(np.einsum("nd,nd->n", x, x).max(initial=0))


def fresh(v: Vocabulary, seed: int = 11) -> Model:
    random, d, n = np.random.default_rng(seed), v.settings.width, v.size
    p = (v.class_counts + 1) / (v.class_counts.sum() + n)
    eye = np.eye(d, dtype=np.float32)
    return Model(random.normal(0, 0.1, (n + 1, d)).astype(np.float32), eye, 0.5 * eye, random.normal(0, 0.1, (n, d)).astype(np.float32), np.log(p).astype(np.float32))


#: No parameter grows beyond `_LARGEST`. A step weighs each token of a batch as one of `_FEW`, but moves no row by more
#: than `_MEANS` times the mean of its tokens. Steps have shrunk by a third or so after `_DECAY` of them.
_LARGEST, _FEW, _MEANS, _DECAY = 4.0, 30, 2, 2000


def _ordered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of small keys that are not negative, and the keys in it; both are sorted as one number."""
    bits = len(keys).bit_length()
    both = np.sort((keys.astype(np.int64) << bits) | np.arange(len(keys)))
    return both & ((1 << bits) - 1), both >> bits


def _ranks(places: np.ndarray) -> np.ndarray:
    """Rank of each of some different places."""
    taken = np.zeros(places.max(initial=-1) + 1, np.int64)
    taken[places] = 1
    return (np.cumsum(taken) - 1)[places]


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, np.int64)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the runs of rows that begin at `first`. Short runs are added up in pairs, pairs of pairs and so on, in place."""
    n = len(values)
    if n > 3 * len(first):
        return np.add.reduceat(values, first, axis=0)
    size = np.diff(first, append=n)
    place = np.arange(n) - np.repeat(first, size)
    left, reach = np.repeat(size, size) - place, 1
    at = np.flatnonzero((place & 1 == 0) & (left > 1))
    while len(at):
        values[at] = values.take(at, axis=0) + values.take(at + reach, axis=0)
        reach *= 2
        at = at[(place[at] & (2 * reach - 1) == 0) & (left[at] > reach)]
    return values.take(first, axis=0)


def _sigma(x: np.ndarray) -> np.ndarray:
    """The logistic function, in place."""
    np.clip(x, -30, 30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _shorten(x: np.ndarray) -> np.ndarray:
    """Makes rows longer than 1 as long as 1, in place; the sums of their squares before."""
    squares = np.einsum("nd,nd->n", x, x)
    x *= np.reciprocal(np.sqrt(np.maximum(1, squares)))[:, None]
    return squares


def _paced(to: np.ndarray, steps: np.ndarray, ordered: np.ndarray, values: np.ndarray, pace: float) -> None:
    """Steps against the values of ordered rows, shorter for rows that have taken many; the last column is the square that counts."""
    if not len(ordered):
        return
    first = _runs(ordered)
    r, sums = ordered[first], _sums(values, first)
    steps[r] += sums[:, -1]
    sums *= (pace / np.sqrt(1 + steps[r]))[:, None]
    moved = to.take(r, axis=0)
    moved -= sums[:, :-1]
    to[r] = np.clip(moved, -_LARGEST, _LARGEST, out=moved)


def step(m: Model, v: Vocabulary, tokens: tuple[np.ndarray, ...], turn: np.ndarray, noise: np.ndarray, log_noise: np.ndarray, rate: float, random) -> None:
    """A step of noise-contrastive estimation: true classes against noise words that the batch shares. Tokens are ordered by class and word."""
    ids, one, two, word, w1, w2 = tokens
    n, k = len(ids), np.float32(np.log(len(noise)))
    a, b = m.inputs(one, two, w1, w2)
    q = a @ m.near + b @ m.far
    t, against = m.targets.take(ids, axis=0), m.targets[noise]
    true = _sigma(np.einsum("nd,nd->n", q, t) + (m.bias - log_noise - k)[ids]) - 1
    wrong = q @ against.T
    wrong += (m.bias - log_noise - k)[noise]
    wrong = _sigma(wrong)
    t *= true[:, None]
    back = wrong @ against
    back += t
    if m.vectors is not None:
        back += m.vectors.learn(v, q, ids, word, turn, v.settings.pace, random)

    def rates(weight: np.ndarray) -> np.ndarray:
        """Step of each row, by the weight of the tokens that meet it."""
        return (rate * np.minimum(_FEW / n, _MEANS / np.maximum(weight, 1e-9))).astype(np.float32)

    classes, wrongs = len(m.bias), wrong.sum(axis=0)
    of_class = rates(np.bincount(ids, -true, classes) + np.bincount(noise, wrongs, classes))
    each = wrong.sum(axis=1) - true
    by, contexts = _ordered(np.concatenate((one, two)))
    of_context = rates(np.bincount(contexts, np.concatenate((each, each)).take(by), classes + 1))
    # Inputs longer than 1 take shorter steps, or the steps would overshoot.
    q *= np.reciprocal(np.maximum(1, np.einsum("nd,nd->n", q, q)))[:, None]
    told = np.concatenate((back @ m.near.T, back @ m.far.T))
    squares = np.minimum(1, _shorten(told))
    _shorten(back)
    near, far = a.T @ back, b.T @ back
    if m.vectors is not None:
        m.vectors.learn_contexts(w1, w2, told, squares, v.settings.pace)
    first = _runs(ids)
    own = ids[first]
    m.targets[own] -= of_class[own][:, None] * _sums(true[:, None] * q, first)
    m.bias[own] -= of_class[own] * np.add.reduceat(true, first)
    drawn, noise = _ordered(noise)
    first = _runs(noise)
    own = noise[first]
    m.targets[own] -= of_class[own][:, None] * np.add.reduceat((wrong.T @ q)[drawn], first, axis=0)
    m.bias[own] -= of_class[own] * np.add.reduceat(wrongs[drawn], first)
    first = _runs(contexts)
    own = contexts[first]
    m.features[own] -= of_context[own][:, None] * _sums(told.take(by, axis=0), first)
    m.near -= np.float32(rate / n) * near
    m.far -= np.float32(rate / n) * far
    for x in (m.features, m.targets, m.near, m.far):
        np.clip(x, -_LARGEST, _LARGEST, out=x)


def learn(m: Model, v: Vocabulary, streams: Iterator[tuple[np.ndarray, ...]], rate: float, seed: int) -> int:
    """Run over (class, class before, class before that, and the same of words with vectors); the tokens it has seen."""
    random, p = np.random.default_rng(seed), (v.class_counts + 1) / (v.class_counts.sum() + v.size)
    log_noise, upto, seen, steps = np.log(p).astype(np.float32), np.cumsum(p), 0, 0
    for tokens in streams:
        n = len(tokens[0])
        order, key = random.permutation(n), tokens[0] * (v.tree.words + 1) + tokens[3]
        for a in range(0, n, v.settings.batch):
            rows = order[a:a + v.settings.batch]
            turn = _ordered(key.take(rows))[0]
            rows = rows.take(turn)
            noise = np.minimum(np.searchsorted(upto, random.random(v.settings.noise)), v.size - 1)
            # A short batch takes a shorter step, and steps get shorter with time.
            step(m, v, tuple(x.take(rows) for x in tokens), turn, noise, log_noise, rate * len(rows) / v.settings.batch / np.sqrt(1 + steps / _DECAY), random)
            steps += 1
        seen += n
    return seen


def train(texts: DataFrame, v: Vocabulary, sample: list[str]) -> Model:
    """The average, by tokens, of what all tasks learn from their texts, after a common start from the sample."""
    s, start = v.settings, fresh(v)
    if sample:
        h, g, doc = tokenized(pa.array(sample, pa.string()), s.groups)
        ids, found, one, two = classes_of(v, h, g, doc, len(sample))
        tokens = ids, one, two, *words_of(v, found, doc, len(sample))
        for epoch in range(s.start_epochs):
            learn(start, v, iter([tokens]), s.rate, epoch)
    shared = texts.sparkSession.sparkContext.broadcast((v, start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, m = shared.value
        m = Model.of(m.flat(), own.size, own.settings.width)
        m.vectors = Vectors.fresh(own).trained()

        def streams():
            for batch in blocks(batches):
                h, g, doc = tokenized(text_column(batch, "text"), own.settings.groups)
                ids, found, one, two = classes_of(own, h, g, doc, batch.num_rows)
                yield ids, one, two, *words_of(own, found, doc, batch.num_rows)

        seen = learn(m, own, streams(), own.settings.rate / 2, 1)
        if seen:
            flat = np.concatenate(([1.0], m.flat())) * seen
            cut = range(0, len(flat), 4096)
            yield pa.RecordBatch.from_arrays([pa.array([-1 - i for i in range(len(cut))], pa.int32()), pa.array([flat[a:a + 4096].tobytes() for a in cut], pa.binary())], ["block", "data"])
            for block, data in m.vectors.packed():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([data], pa.binary())], ["block", "data"])

    sums = {r["block"]: r["data"] for r in averaged(texts.select("text").mapInArrow(run, "block int, data binary"), s.width)}
    vectors = Vectors.fresh(v, np.float16)
    if not sums:
        start.vectors = vectors
        return start
    flat = np.concatenate([np.frombuffer(sums[k], "<f8") for k in sorted((k for k in sums if k < 0), reverse=True)])
    for k in sums:
        if k >= 0:
            to = vectors.own if k % 2 else vectors.nodes
            rows, _, values = _unpack(sums[k], to.shape[1])
            to[k // 2 * _ROWS + rows.astype(np.int64)] = values
    out = Model.of(flat[1:] / flat[0], v.size, s.width)
    out.vectors = vectors
    return out


@dataclass
class Tables:
    """Log scores by (context class, class) for both places, offsets, and log normalisers by pair of contexts."""

    near: np.ndarray
    far: np.ndarray
    bias: np.ndarray
    normaliser: np.ndarray

    def log10(self, ids: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        values = self.near[one, ids].astype(np.float64) + self.far[two, ids] + self.bias[ids] - self.normaliser[one, two]
        return values / np.log(10)


def tables(spark, m: Model) -> Tables:
    """Matrix products of all context features with all classes; tasks work out the normalisers of their contexts."""
    near, far = m.features @ m.near @ m.targets.T, m.features @ m.far @ m.targets.T
    contexts = len(m.features)
    shared = spark.sparkContext.broadcast((near, far, m.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, bias = (x.astype(np.float64) for x in shared.value)
        top = b.max(axis=1)
        weight = np.exp(b - top[:, None]).T  # of the farther context, so that a product sums over the classes
        for batch in batches:
            x = a[batch.column(0).to_numpy()] + bias
            high = x.max(axis=1)
            z = np.exp(x - high[:, None]) @ weight
            out = np.log(np.maximum(z, 1e-300)) + high[:, None] + top[None, :]
            # Where the two contexts disagree so much that the product loses its digits, the sum is taken directly.
            for i, j in np.argwhere(z < 1e-200).tolist():
                both = x[i] + b[j]
                out[i, j] = both.max() + np.log(np.exp(both - both.max()).sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in out], pa.binary())], ["id", "data"])

    rows = spark.range(0, contexts, 1, 8).mapInArrow(run, "id bigint, data binary").collect()
    normaliser = np.empty((contexts, contexts))
    for r in rows:
        normaliser[r["id"]] = np.frombuffer(r["data"], "f8")
    return Tables(near, far, m.bias, normaliser)


#: Contexts or tokens whose scores of all classes are worked out at once, words whose exponentials are kept, the largest scores whose exponentials
#: need no shift, and sums of exponentials beyond which digits may be lost.
_AT_ONCE, _KEPT, _PLAIN, _SAFE = 128, 8192, 40.0, (1e-20, 1e30)


@dataclass
class Kept:
    """Exponentials of the scores of all classes by contexts that come often, for each of the two places, and what was taken off the scores.

    `rows` is the row of a word with a vector, or -1; contexts without (one row more, for none) come after the words.
    """

    rows: np.ndarray
    plain: int
    near: tuple[np.ndarray, np.ndarray]
    far: tuple[np.ndarray, np.ndarray]

    def row(self, cls: np.ndarray, word: np.ndarray) -> np.ndarray:
        own = self.rows.take(word)
        return np.where(word == len(self.rows) - 1, self.plain + cls, own)


def kept(v: Vocabulary, m: Model, most: int = _KEPT) -> Kept:
    """The tables of contexts of classes and of the `most` frequent words with vectors."""
    none = v.tree.words
    places = np.flatnonzero(v.tree.word < none)
    places = places[np.argsort(-v.counts[places], kind="stable")[:most]]
    words = np.concatenate((v.tree.word[places], np.full(len(m.features), none))).astype(np.int64)
    rows = np.full(none + 1, -1)
    rows[words[:len(places)]] = np.arange(len(places))
    # The group of a word is that of its bin.
    groups = np.searchsorted(v.tree.rest, v.tree.bin_node[v.tree.bin_of[words[:len(places)]]])
    cls = np.concatenate((v.settings.words + groups, np.arange(len(m.features))))
    out = []
    for place in (0, 1):
        values, high = np.empty((len(cls), len(m.bias)), np.float32), np.empty(len(cls), np.float32)
        for a in range(0, len(cls), _AT_ONCE):
            values[a:a + _AT_ONCE], high[a:a + _AT_ONCE] = exponentials(m, place, cls[a:a + _AT_ONCE], words[a:a + _AT_ONCE])
        out.append((values, high))
    return Kept(rows, len(places), *out)


def exponentials(m: Model, place: int, cls: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of the scores of all classes by contexts at a place (0: the nearer one, with the offsets), and what was taken off the scores."""
    q = m.context(cls, word) @ (m.far if place else m.near)
    return _exponentials(m, q, not place)


def _exponentials(m: Model, q: np.ndarray, offsets: bool) -> tuple[np.ndarray, np.ndarray]:
    x = q @ m.targets.T
    if offsets:
        x += m.bias
    if _longest(q) * m.reach[0] + (m.reach[1] if offsets else 0) < _PLAIN:
        high = np.zeros(len(x), np.float32)
    else:
        high = x.max(axis=1)
        x -= high[:, None]
    return np.exp(x, out=x), high


def normalisers(m: Model, q: np.ndarray, tokens: tuple[np.ndarray, ...], often: Kept) -> np.ndarray:
    """Log of the sums over all classes for tokens of these contexts; the exponential of a score is a product of both contexts' ones.

    A context that isn't kept is worked out once for all tokens that have a kept one beside it. Two such contexts take a sum of their own.
    """
    one, two, w1, w2 = tokens
    rows = often.row(one, w1), often.row(two, w2)
    z, out = np.empty(len(one), np.float32), np.empty(len(one))
    here = [r >= 0 for r in rows]

    def times(at: np.ndarray, x: tuple[np.ndarray, np.ndarray], i: np.ndarray, y: tuple[np.ndarray, np.ndarray], j: np.ndarray) -> None:
        for a in range(0, len(at), _AT_ONCE):
            some = slice(a, a + _AT_ONCE)
            z[at[some]] = np.vecdot(x[0].take(i[some], axis=0), y[0].take(j[some], axis=0))
        out[at] = x[1].take(i) + y[1].take(j)

    both = np.flatnonzero(here[0] & here[1])
    both = both[_ordered(rows[0][both])[0]]
    times(both, often.near, rows[0][both], often.far, rows[1][both])
    for place, (cls, word), table in ((0, (one, w1), often.far), (1, (two, w2), often.near)):
        at = np.flatnonzero(here[1 - place] & ~here[place])
        by, words = _ordered(word[at])
        at, first = at[by], _runs(words)
        edges = np.append(first, len(at))
        for a in range(0, len(first), _AT_ONCE):
            lead = at[first[a:a + _AT_ONCE]]
            x = exponentials(m, place, cls[lead], word[lead])
            low, high = edges[a], edges[a + len(lead)]
            times(at[low:high], x, np.repeat(np.arange(len(lead)), np.diff(edges[a:a + len(lead) + 1])), table, rows[1 - place][at[low:high]])
    rest = np.flatnonzero(~(here[0] | here[1]))
    for at in (rest[i:i + _AT_ONCE] for i in range(0, len(rest), _AT_ONCE)):
        x, out[at] = _exponentials(m, q[at, :-1], True)
        z[at] = x @ np.ones(x.shape[1], np.float32)
    out += np.log(np.maximum(z, 1e-38))
    # Where the two contexts disagree so much that the product loses its digits, the sum is taken directly.
    for at in np.array_split(np.flatnonzero(~((z > _SAFE[0]) & (z < _SAFE[1]))), np.arange(_AT_ONCE, len(z), _AT_ONCE)):
        if len(at):
            x = q[at, :-1].astype(np.float64) @ m.targets.T + m.bias
            high = x.max(axis=1)
            out[at] = high + np.log(np.exp(x - high[:, None]).sum(axis=1))
    return out


def families(v: Vocabulary, m: Model, q: np.ndarray, ids: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Log of the probability of each token in its group, and of its word in its bin, each family for all its tokens."""
    at = np.flatnonzero((ids >= v.settings.words) & (ids < v.end))
    nodes, family, has = v.tree.paths(ids[at] - v.settings.words, word[at])
    token = np.concatenate((at, at[has]))
    by, family = _ordered(family)
    token, place = token[by], nodes[by] - v.tree.starts[family]
    own, sums, edges = np.empty(len(by), np.float32), np.empty(len(by), np.float32), _runs(family)
    starts, ends = v.tree.starts[family[edges]], v.tree.starts[family[edges] + 1]
    upto, low, high = np.append(edges[1:], len(by)), 0, 0
    steps, ones = np.arange(_TOKENS), np.ones(np.max(ends - starts, initial=0), np.float32)
    for i, j, first, end in zip(edges.tolist(), upto.tolist(), starts.tolist(), ends.tolist()):
        if end > high:  # nodes of the next families
            low, high = first, max(end, first + _NODES)
            values = _single(m.vectors.nodes[low:high])
            values = np.concatenate((values[:, :-1], (values[:, -1] + v.tree.base[low:high])[:, None]), axis=1)
        of = values[first - low:end - low]
        for a in range(i, j, _TOKENS):
            b = min(a + _TOKENS, j)
            x = q.take(token[a:b], axis=0) @ of.T
            own[a:b] = x.take(steps[:b - a] * (end - first) + place[a:b])
            with np.errstate(over="ignore"):
                sums[a:b] = np.exp(x, out=x) @ ones[:end - first]
    out = own - np.log(np.maximum(sums, 1e-38).astype(np.float64))
    # Sums of scores too large or too small for single exponentials.
    for i in np.flatnonzero(~((sums > _SAFE[0]) & (sums < _SAFE[1]))):
        family_of = slice(v.tree.starts[family[i]], v.tree.starts[family[i] + 1])
        x = _single(m.vectors.nodes[family_of]).astype(np.float64) @ q[token[i]] + v.tree.base[family_of]
        out[i] = x[place[i]] - x.max() - np.log(np.exp(x - x.max()).sum())
    return np.bincount(token, out, len(ids))


#: Tokens whose rows of factors are worked out at once, and nodes of the tree that are made single floats at once.
_TOKENS, _NODES = 1 << 14, 4096


def modelled_log10(v: Vocabulary, m: Model, t: Tables, tokens: tuple[np.ndarray, ...], often: Kept | None = None) -> np.ndarray:
    """log10 of the probability of each token's class and, in a group, of its word, or of all words there that have no vector."""
    ids, one, two, word, w1, w2 = tokens
    none, out = v.tree.words, np.empty(len(ids))
    q = np.ones((len(ids), len(m.near) + 1), np.float32)
    for some in (slice(i, i + _TOKENS) for i in range(0, len(ids), _TOKENS)):
        a, b = m.inputs(one[some], two[some], w1[some], w2[some])
        x = q[some, :-1] = a @ m.near + b @ m.far
        out[some] = np.einsum("nd,nd->n", x, m.targets.take(ids[some], axis=0)) + m.bias[ids[some]]
    plain = (w1 == none) & (w2 == none)
    others = np.flatnonzero(~plain)
    if len(others):
        out[others] -= normalisers(m, q if len(others) == len(q) else q.take(others, axis=0), tuple(x[others] for x in (one, two, w1, w2)), often or kept(v, m))
    out[plain] = t.log10(ids[plain], one[plain], two[plain]) * np.log(10)
    return (out + families(v, m, q, ids, word)) / np.log(10)


PARTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("known", T.LongType()),
    T.StructField("counted", T.DoubleType()), T.StructField("modelled", T.DoubleType()),
    T.StructField("rare", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.IntegerType()))])


def _parts(texts: pa.Array, keys: pa.Array, v: Vocabulary, m: Model, t: Tables, often: Kept) -> pa.RecordBatch:
    """What broadcast tables tell of each text, and the words (with their numbers) whose counts must be joined."""
    n = len(texts)
    h, g, doc = tokenized(texts, v.settings.groups)
    ids, found, one, two = classes_of(v, h, g, doc, n)
    text_of = np.repeat(np.arange(n), np.bincount(doc, minlength=n) + 1)
    word, w1, w2 = words_of(v, found, doc, n)
    modelled = np.bincount(text_of, modelled_log10(v, m, t, (ids, one, two, word, w1, w2), often), n)
    common = found >= 0
    counted = np.where(common, np.log10(v.counts[found] + 1.0) if len(v.counts) else 0.0, 0.0)
    by_count = (~common | (v.classes[found] < 0 if len(v.classes) else True)) & (word[np.arange(len(h)) + doc] == v.tree.words)
    modelled += np.bincount(doc, np.where(by_count, counted - np.log10(v.tree.rest_size)[g], 0.0), n)
    counted = np.bincount(doc, counted, n) + np.log10(v.texts + 1.0)
    known = np.bincount(doc, common, n).astype(np.int64) + (v.texts > 0)
    # Distinct rare words of each text.
    rare, rare_doc = h[~common], doc[~common]
    by = np.lexsort((rare, rare_doc))
    rare, rare_doc = rare[by], rare_doc[by]
    first = np.flatnonzero(np.concatenate(([True], (rare[1:] != rare[:-1]) | (rare_doc[1:] != rare_doc[:-1])))) if len(rare) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(rare))).astype(np.int32)
    edges = pa.array(np.searchsorted(rare_doc[first], np.arange(n + 1)).astype(np.int32))
    return pa.RecordBatch.from_arrays([
        keys, pa.array((np.bincount(doc, minlength=n) + 1).astype(np.int64)), pa.array(known), pa.array(counted), pa.array(modelled),
        pa.ListArray.from_arrays(edges, pa.array(rare[first].view(np.int64))), pa.ListArray.from_arrays(edges, pa.array(times))], PARTS.names)


def score(df: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None) -> DataFrame:
    """`doc_id, n_tokens, n_known, train_tokens, base_score, score` of every row.

    The model learns from the rows where `learn_from` holds. `base_score`: log10 of smoothed unigram probabilities;
    `score`: log10 of the model's. A NULL or empty text is its end alone. Without any training text every word is
    unknown. Repeated rows and NULL keys are scored each for itself; other columns are left out.
    """
    s, spark = settings or Settings(), df.sparkSession
    both = df.select(F.col(quoted(id_col)).cast("bigint").alias("key"), F.col(quoted(text_col)).cast("string").alias("text"), F.coalesce(learn_from, F.lit(False)).alias("learns"))
    texts = both.filter("learns")
    counts = word_counts(texts, s)
    number = texts.count()
    v = vocabulary(counts, number, s)
    # A hash lets about three times as many through as are wanted, so that no task hands over more than its share.
    order = F.xxhash64("key", "text")
    share = min(1.0, 3.0 * s.start_texts / max(number, 1))
    start = F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - s.start_chars, F.lit(0)) + 1) + 1
    chosen = texts.filter("text is not null").withColumn("h", order).filter(F.shiftrightunsigned("h", 11) / 2.0**53 < share)
    chosen = chosen.select("h", F.substring("text", start.cast("int"), F.lit(s.start_chars)).alias("text")).orderBy("h", "text").limit(s.start_texts)
    m = train(texts, v, [r["text"] for r in chosen.collect()])
    shared = spark.sparkContext.broadcast((v, m, tables(spark, m)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, learnt, t = shared.value
        often = kept(own, learnt)
        # Blocks are large, so that words meet again in them.
        for batch in blocks(batches, 2 * BLOCK_BYTES):
            yield _parts(text_column(batch, "text"), batch.column(0), own, learnt, t, often)

    parts = land(key_and_text(df, id_col, text_col).mapInArrow(run, PARTS).withColumn("row", F.monotonically_increasing_id()))
    words = parts.select("row", F.inline(F.arrays_zip("rare", "times"))).withColumnRenamed("rare", "word")
    more = words.join(counts.select("word", "c"), "word").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("more"), F.sum("times").alias("more_known"))
    joined = parts.drop("rare", "times").join(more, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    total = float(np.log10(v.tokens + v.distinct + 1.0))
    return joined.select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(v.tokens).cast("bigint").alias("train_tokens"),
        (F.col("counted") + more - F.col("n_tokens") * total).alias("base_score"), (F.col("modelled") + more).alias("score"))
