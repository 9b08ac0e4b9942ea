import random

import pytest

SYL = ["tha", "ren", "sti", "on", "ea", "wh", "or", "ble", "ing", "ed", "ti", "ou"]


@pytest.fixture(scope="session")
def prose():
    """A maker of invented prose: prose(seed, words)."""

    def make(seed: int, n: int) -> str:
        rng = random.Random(seed)
        words = ["".join(rng.choice(SYL) for _ in range(rng.randint(1, 3))) for _ in range(n)]
        return " ".join(w + rng.choice(["", "", "", ".", ",", "\n"]) for w in words)

    return make


ODD = [None, "", " \t\n", "x", "Ünïcode ÄÖ 日本語 👍", "a" * 3000, "the end. " * 400, "\x00\x0b\x1c\u00a0\u2028 k\u212a \u0130", "###!! $$%% ||"]


@pytest.fixture(scope="session")
def docs(spark, prose):
    """Documents with nulls, odd texts, copies, near copies, repeated rows and clashing columns."""
    texts = [prose(i, 5 + (i * 37) % 160) for i in range(60)]
    texts += [texts[3], texts[3], texts[4] + " tail", texts[5].replace("on", "or", 1)] + ODD
    rows = [(i, t, "en" if i % 3 else "de", f"s{i % 4}", len(t or ""), "clash") for i, t in enumerate(texts)]
    rows += [rows[7], (None, texts[8], None, None, None, None), (5000, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def empty(spark, docs):
    return spark.createDataFrame([], docs.schema)
