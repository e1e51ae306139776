"""Chat formatting: escapes, masks, order, long conversations, and the way back."""

import hashlib

import corpus
import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from regionscore.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part int, formatted string, n_turns string"
TEXT = st.text(alphabet=st.sampled_from(list("ab<>|\\/s[]INSTY é🙂\n")), max_size=30)


def rows():
    out = [(1, 2, "assistant", "b </s>"), (1, 1, "user", "a"), (1, 3, "user", None), (2, 1, None, ""), (2, 1, None, ""), (3, None, "assistant", "first"),
           (3, 0, "assistant", "é🙂"), (None, 1, "user", "no id"), (None, 2, "assistant", "\\<|end|>\n"), (4, 5, "a|>\n<", "role <|x|>"), (5, 1, "assistant", "<" * 5)]
    out += [(6, i, "assistant" if i % 2 else "user", corpus.sentence(i, 400)) for i in range(600)]
    return [(*r, 1, "f", "n") for r in out]


def want(data):
    groups = {}
    for conv, turn, role, text, *_ in data:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in groups.items():
        turns.sort()
        whole, learned = "".join(f"{r}\n{t}\n" for *_, r, t in turns), "".join(t for *_, r, t in turns if r == "assistant")
        out.append((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_read_back(spark, monkeypatch):
    formatted = chat.format_turns(spark.createDataFrame(rows(), SCHEMA)).cache()
    got = chat.digests(formatted).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == want(rows())
    lengths = {}
    for r in formatted.collect():
        lengths[r["conv_id"]] = lengths.get(r["conv_id"], 0) + len(r["formatted"])
        raw = r["formatted"].encode()
        for a, b in zip(r["loss_start"], r["loss_end"]):
            assert raw[:a].endswith(b"<|assistant|>\n") and raw[b:].startswith(b"<|end|>\n")
    assert {r["conv_id"]: r["formatted_chars"] for r in got} == lengths
    assert sum(r["n_turns"] for r in formatted.filter("conv_id = 6").collect()) == 600


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert chat.format_turns(none).count() == 0 and chat.digests(chat.format_turns(none)).count() == 0


def test_layout():
    out, offsets, start, end = chat.assemble(pa.array(["user", "assistant"]), pa.array(["a </s>", "\\"]))
    assert out.tobytes().decode() == "<|user|>\na \\</s><|end|>\n<|assistant|>\n\\\\<|end|>\n"
    assert [out[a:b].tobytes() for a, b in zip(start, end)] == [b"a \\</s>", b"\\\\"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=5))
def test_any_turns_come_back(turns):
    out, offsets, start, end = chat.assemble(pa.array([r for r, _ in turns]), pa.array([t for _, t in turns]))
    raw = out.tobytes()
    assert [(r.decode(), t.decode()) for r, t in chat.parse(raw)[0]] == turns
    for row, (a, b) in enumerate(zip(start, end)):
        content = raw[a:b]
        plain = np.frombuffer(content, np.uint8)
        assert plain[~chat.escapes(plain)].tobytes().decode() == turns[row][1]
        # No control string is left that a backslash does not break off.
        for control in chat.CONTROL:
            at = content.find(control)
            while at >= 0:
                slashes = len(content[:at]) - len(content[:at].rstrip(b"\\"))
                assert slashes % 2 == 1
                at = content.find(control, at + 1)
