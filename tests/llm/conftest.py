import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, keep_id string, copy long, score double"


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(n))


def hard_rows():
    """Nulls everywhere, empty and very long texts, ties, repeated rows, near copies, clashing column names."""
    rng = random.Random(3)
    a, b = sentence(rng, 120), sentence(rng, 90)
    words = a.split()
    near = " ".join(words[:60] + ["zz"] + words[61:])
    texts = [a, a, a + " ", near, b, b.upper(), None, "", " \t\n", "one two", "ONE two", "x", "é ü 中文 ß",
             sentence(rng, 12_000), "w" * 20_000, a + "\n" + b, b + "\n" + a, a, "\n".join([a[:80], a[80:300], b[:90]] * 2),
             "\n".join([a[:80], a[80:300], b[:90]]) + "\nother"]
    rows = [(i, t, None if i % 3 else "en", None if i % 4 == 0 else f"s{i % 3}", None, None if i % 2 else 7, "k", i, 0.5)
            for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, b, None, None, None, None, None, None, None), (None, b, None, None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(hard_rows(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
