from __future__ import annotations

import random

import pytest


@pytest.fixture(scope="session")
def prose():
    """Texts that share passages, differ by a few words, or are odd in some way, with ids."""
    draw = random.Random(11)
    words = ["the", "of", "and", "Là", "straße", "ñu", "tion", "ingly", "x1", "a,", "END.", "and\tso"]
    words += [f"{a}{b}" for a in ("thr", "bel", "kön", "éta") for b in ("on", "er", "ish", "al", "um")]
    sentence = lambda n: " ".join(draw.choice(words) for _ in range(n))
    base, passage = sentence(90), sentence(70)
    texts = [sentence(draw.randrange(1, 160)) for _ in range(40)]
    for _ in range(60):
        own = base.split(" ")
        for _ in range(draw.randrange(8)):
            own[draw.randrange(len(own))] = f"w{draw.randrange(40)}"
        texts.append(" ".join(own))
    texts += [f"{sentence(30)} {passage[draw.randrange(60):]} {sentence(20)}" for _ in range(25)]
    texts += [base] * 5 + [base.upper(), base.replace(" ", "\n\n"), None, None, "", "", " \n\t", "one", "ONE", "one two", "\x00\x7f", "é"]
    texts += ["ab" * 600, "c" * 401, "d" * 400, "e" * 399, "🙂" * 150, sentence(6000)]
    return [(k, text) for k, text in enumerate(texts)] + [(None, passage), (None, None), (3, texts[3]), (3, "other text")]


@pytest.fixture(scope="session")
def documents(spark, prose):
    """``prose`` as a table that also has columns named like the operators' own."""
    rows = [(k, text, "n", k, 1, "x") for k, text in prose]
    fields = "doc_id bigint, text string, node string, token bigint, n_tokens int, _text string"
    return spark.createDataFrame(rows, fields).repartition(5)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")
