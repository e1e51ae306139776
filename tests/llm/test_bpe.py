"""Byte-level BPE against the library it must equal, and the prefix table's appends and edits."""

import hashlib

import corpus
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from regionscore.llm import bpe
from regionscore.llm.queries import RANKS

PATH, PATTERN = bpe.public_vocabulary(RANKS)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
ENCODER = bpe.encoder(PATH, PATTERN)


def test_rows_equal_the_library(spark):
    got = [tuple(r) for r in bpe.round_trip(corpus.frame(spark), PATH, PATTERN).collect()]
    want = []
    for key, text, *_ in corpus.rows():
        ids = LIBRARY.encode_ordinary(text or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        want.append((key, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_ids_and_bytes(spark):
    ids = bpe.encode(corpus.frame(spark), PATH, PATTERN)
    assert sorted((r["ids"] for r in ids.collect()), key=repr) == sorted((LIBRARY.encode_ordinary(t or "") for _, t, *_ in corpus.rows()), key=repr)
    back = bpe.decode(ids, PATH, PATTERN).collect()
    assert sorted(bytes(r["data"]) for r in back) == sorted((t or "").encode() for _, t, *_ in corpus.rows())


def test_empty_table(spark):
    assert bpe.encode(corpus.empty(spark), PATH, PATTERN).collect() == []
    assert bpe.round_trip(corpus.empty(spark), PATH, PATTERN).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_special_names_are_ordinary_text():
    text = "<|endoftext|> a<|endoftext|>"
    assert ENCODER.encode(text) == LIBRARY.encode_ordinary(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    ids = ENCODER.encode(text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert ENCODER.decode(ids) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=40), st.binary(max_size=20), st.integers(0, 60), st.integers(0, 60), st.binary(max_size=8))
def test_appends_and_edits_are_exact(data, more, a, b, new):
    table = bpe.PrefixTable(ENCODER.vocabulary, data)
    before = list(table.last)
    table.append(more)
    assert table.last[:len(before)] == before
    whole = data + more
    assert table.last == bpe.PrefixTable(ENCODER.vocabulary, whole).last
    a, b = sorted((min(a, len(whole)), min(b, len(whole))))
    table.edit(a, b, new)
    changed = whole[:a] + new + whole[b:]
    assert (table.data, table.last) == (changed, bpe.PrefixTable(ENCODER.vocabulary, changed).last)
    assert table.tokens() == ENCODER.vocabulary.encode(changed)


def test_edit_of_a_long_piece_keeps_what_is_far():
    v, word = ENCODER.vocabulary, b"tion" * 200
    table = bpe.PrefixTable(v, word)
    table.edit(300, 301, b"qq")
    assert table.last == bpe.PrefixTable(v, word[:300] + b"qq" + word[301:]).last


@pytest.mark.parametrize("seed", range(3))
def test_neighbours_stay_as_merging_says(seed):
    import random

    r, v = random.Random(seed), ENCODER.vocabulary
    ids = sorted(v.bytes_of)
    for _ in range(2000):
        a, b = r.choice(ids), r.choice(ids[:3000])
        assert v.stays(a, b) == (v.merged(v.bytes_of[a] + v.bytes_of[b]) == [a, b])


def test_pieces_are_forgotten(spark):
    from regionscore.llm.queries import RANKS

    e = bpe.encoder(*bpe.public_vocabulary(RANKS))
    ids = e.encode("some words, some more")
    assert e.known and e.vocabulary.apart
    e.forget()
    assert not e.known and not e.vocabulary.apart and e.encode("some words, some more") == ids
