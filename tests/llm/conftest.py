import random

import pytest

WORDS = [a + b for a in ("the", "on", "re", "ti", "éa", "sh", "ou") for b in ("", "n", "st", "ing", "ha", "le.", "Er")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Texts with nulls, empties, copies, shared passages, white space of all kinds, other scripts and one long text."""
    rng = random.Random(5)
    passage = prose(rng, 60)
    out = [None, "", " \t\n", "one", "two words", "tres\u00a0palabras\u2003nicht getrennt", "日本語 テキスト 三", "A  B\tC\nD"]
    base = [prose(rng, rng.randint(5, 200)) for _ in range(60)]
    out += base + base[:5] + [base[7]] * 20
    out += [prose(rng, 30) + " " + passage + " " + prose(rng, rng.randint(0, 80)) for _ in range(25)]
    for t in base[20:30]:  # near copies: one word changed
        w = t.split(" ")
        w[len(w) // 2] = "changed"
        out.append(" ".join(w))
    out += ["be " * 40 + "to " * 50, " ".join(["x"] * 200), passage, passage.replace(" ", "\r\n"), prose(rng, 30000)]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts under integer ids, some null or repeated, with columns whose names clash with the operators' own."""
    rows = [(None if i == 30 else i - (i == 41), t, "x", i, f"keep{i}") for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, body string, n_words long, `odd.name` string").repartition(3).cache()
