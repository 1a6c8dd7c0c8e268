"""Small inputs with every odd case: nulls, empty and long texts, repeats, clashing extra columns."""

from __future__ import annotations

import random

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, id long, n long, c string, score double, "
        "`odd name` string")


def docs(spark, rows):
    """``rows``: (doc_id, text[, lang]); the other columns clash with names that the operators use."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", None if r[1] is None else len(r[1]), 5, 6, "x", 0.5, "y")
            for r in rows]
    return spark.createDataFrame(full, DOCS)


def sentence(rng, n=12):
    words = ["alpha", "beta", "gamma", "delta", "omega", "river", "stone", "cloud", "maple", "tiger", "violin", "copper"]
    return " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n)).capitalize() + "."


def corpus(seed=3):
    """Texts with exact copies, near copies, chains of near copies, shared passages and odd cases."""
    rng = random.Random(seed)
    base = [" ".join(sentence(rng) for _ in range(rng.randrange(3, 9))) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    for k, t in enumerate(base[:5]):
        words = t.split(" ")
        for step in range(4):  # a chain: each differs from the one before by a word
            words = list(words)
            words[(7 * step + k) % len(words)] = f"changed{step}"
            rows.append((100 + 10 * k + step, " ".join(words)))
        rows.append((200 + k, t.upper()))  # words are lower-cased
    passage = " ".join(sentence(rng) for _ in range(5))
    for k in range(6):
        rows.append((300 + k, f"{sentence(rng)} {sentence(rng)} {passage} {sentence(rng)}"))
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "one two"), (404, "One\ntwo"), (405, "a b c d e"),
             (406, "word " * 30000), (None, base[0]), (None, None), (407, base[0]), (407, base[0])]
    rng.shuffle(rows)
    return rows
