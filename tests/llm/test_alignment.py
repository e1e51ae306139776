import hashlib
import random
from collections import Counter

import corpus
import numpy as np
import pyarrow as pa
import pytest

from regionscore.llm import alignment
from regionscore.llm.queries import ALIGNED_FILES, QUERIES

FILES = alignment.public_files(*ALIGNED_FILES)
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=FILES[1])


def spelled(text, a, b):
    """Ids and bytes of both sides, or None, from the libraries on the whole text."""
    values = alignment._byte_values()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(values[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, map(b.id_to_piece, ids_b))]
    want = (" " + text).encode()
    return (ids_a, bytes_a, ids_b, bytes_b) if text and b"".join(bytes_a) == want and b"".join(bytes_b) == want else None


def brute(rows, a, b):
    found, held = [], Counter()
    for key, text in rows:
        tokens = spelled(text or "", a, b)
        if tokens is None:
            found.append((key, 0, 0, 0, [], ""))
            continue
        spans = []
        for ids, data in (tokens[:2], tokens[2:]):
            at, side = 0, []
            for i, piece in zip(ids, data):
                side.append((i, at, at + len(piece)))
                at += len(piece)
            spans.append(side)
        links = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if s < f and t < e]
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        names, low = [], 0
        for cut in cuts:
            names.append("|".join(",".join(str(i) for i, s, e in side if low <= s < cut) for side in spans))
            low = cut
        held.update(set(links))
        found.append((key, len(spans[0]), len(spans[1]), len(cuts), links, hashlib.sha256(";".join(names).encode()).hexdigest()))
    best = {}
    for (i, _), n in held.items():
        best[i] = max(best.get(i, 0), n)
    return [(key, na, nb, ng, len(links), sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links), sha) for key, na, nb, ng, links, sha in found]


ODD = [" a", "a ", "a  b ", " ", "  ", "\t", "a\tb\n c", "x  y", "é è à", "U+2581 ▁ here", "<|endoftext|> <s> </s>", "naïve   café's it's", "word　wide   x",
       "漢字 かな", "🙂🙃 a🙂 b", "1234 5,678", "\x00 a\x00", "ﬁ ½ Å", "'s 's", "a\r\nb", "x\u0085 y  z", "éé éé ñ ñ", "¡¿ ¡ a"]


def texts(n=60):
    r = random.Random(3)
    alphabet = [" ", "  ", "\n", "\t", "a", "the", "é", "ß", "’", "'s", "漢", "🙂", " ", " ", "▁", "<0x41>", ".", ",", "1", "99", "Word", "ing", "\x1f", "﻿", "İ"]
    return ["".join(r.choice(alphabet) for _ in range(r.randint(1, 40))) for _ in range(n)]


def test_units_are_encoded_as_in_whole_texts(libraries):
    tokens = alignment.Tokens(alignment.Side(alignment.ByteLevel(FILES[0])), alignment.Side(alignment.Pieces(FILES[1])))
    for some in (ODD, texts(300), [corpus.sentence(k, 50) for k in range(20)]):
        found = alignment.align_block(pa.array(some), tokens)
        for k, text in enumerate(some):
            want = spelled(text, *libraries)
            of = found.doc == k
            assert (found.ids[of & ~found.second].tolist(), found.ids[of & found.second].tolist()) == ((want[0], want[2]) if want else ([], [])), repr(text)


def test_equals_brute_force(spark, libraries):
    rows = [(k, t) for k, t in enumerate([*ODD, *texts(), corpus.sentence(1, 200), corpus.sentence(1, 200), "", None, "x" * 500])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    want = brute(rows, *libraries)
    for most in (alignment.COUNTS, 40):  # in one broadcast, and by ranges of A ids
        got = alignment.measure(df, *FILES, most=most).select(*COLUMNS).collect()
        assert sorted(map(tuple, got)) == sorted(want)


def test_counts_of_many_blocks_add_up(spark, libraries, monkeypatch):
    rows = [(k, corpus.sentence(k % 7, 30 + k % 3)) for k in range(80)]
    monkeypatch.setattr(alignment, "BLOCK", 500)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(map(tuple, alignment.measure(df, *FILES).select(*COLUMNS).collect())) == sorted(brute(rows, *libraries))


def test_a_chain_without_common_ends_has_linear_links():
    class Fixed:
        def __init__(self, pieces, ids):
            self.pieces, self.wanted = pieces, ids

        def encode(self, units):
            return [self.wanted for _ in units]

    a, b = Fixed([b" ", b"xx", b"x"], [0, *[1] * 500, 2]), Fixed([b" x", b"xx"], [0, *[1] * 500])
    tokens = alignment.Tokens(alignment.Side(a), alignment.Side(b))
    found = alignment.align_block(pa.array(["x" * 1001]), tokens)
    assert len(np.unique(found.group)) == 1 and len(found.link_a) == 502 + 501 - 1


def test_awkward_rows_and_clashing_columns(spark, libraries):
    got = alignment.measure(corpus.frame(spark), *FILES)
    assert got.columns == COLUMNS
    want = brute([(r[0], r[1]) for r in corpus.rows() if len(r[1] or "") < 5000], *libraries)
    kept = {(r[0], len(r[1] or "")) for r in corpus.rows() if len(r[1] or "") >= 5000}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(corpus.rows()) and len(kept) == 2
    same = [0, 1, 2, 3, 4, 7]
    short = sorted((repr([r[i] for i in same]) for r in rows if r[0] not in {k for k, _ in kept}))
    assert short == sorted(repr([r[i] for i in same]) for r in want)
    assert alignment.measure(corpus.empty(spark), *FILES).collect() == []


def test_groups_are_text_on_request(spark):
    df = spark.createDataFrame([(1, "hello world")], "doc_id bigint, text string")
    row = alignment.align(df, *FILES).first()
    assert hashlib.sha256(row["groups"].encode()).hexdigest() == row["groups_sha256"] and row["groups"].count(";") == row["n_groups"] - 1


def test_query_equals_brute_force(spark, libraries):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    small = [r for r in rows if len(r[1] or "") < 1500]
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_token_alignment"](spark, sf).collect()}
    assert len(got) == len(rows)
    for row in brute(small, *libraries):
        assert tuple(got[row[0]][i] for i in (0, 1, 2, 3, 4, 7)) == tuple(row[i] for i in (0, 1, 2, 3, 4, 7))
