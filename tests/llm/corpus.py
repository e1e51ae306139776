"""Small tables with every awkward row: NULLs, empty and long texts, repeated rows, columns with clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key bigint, set bigint, n int, epoch string, n_tokens string, own_set string, tie int, letters string"


def sentence(seed: int, words: int, letters: str = "aeinorst") -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(1, 8))) for _ in range(words))


def rows() -> list[tuple]:
    base = sentence(1, 120)
    words = base.split()
    texts = [
        (1, base), (2, base), (3, " ".join(words[:118])), (4, " ".join(words[:60] + ["zzz"] + words[60:])), (5, None), (6, ""), (7, "   \n\t"),
        (8, "one two"), (9, "ONE  two"), (10, "123 !!!"), (None, base), (None, None), (11, "Ünïcödé 漢字 🙂 naïve"), (11, "Ünïcödé 漢字 🙂 naïve"),
        (12, sentence(2, 30_000)), (13, "x" * 200_000), (14, sentence(3, 80)), (15, sentence(4, 80, "bcdfgh")), (16, sentence(5, 90, "bcdfgh")),
        (-17, "the </s> [INST] \\ <| |> end"), (2**62, sentence(6, 40)),
    ]
    out = []
    for i, (key, text) in enumerate(texts):
        lang = [None, "en", "de"][i % 3] if i < 16 else "de"
        out.append((key, text, lang, [None, "src1", "src2", ""][i % 4], None if text is None else len(text), i, -i, i, "e", "t", "s", i, "l"))
    return out


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
