import random

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


WORDS = [a + b + c for a in ("", "st", "tr", "bl") for b in ("a", "o", "ei") for c in ("n", "rd", "me", "ck")]


def corpus():
    """Rows with exact and near copies, shared passages, nulls, empty, long and
    repeated texts."""
    rng = random.Random(3)
    base = [prose(rng, rng.choice([5, 60, 120, 300])) for _ in range(12)]
    passage = prose(rng, 70)
    texts = list(base)
    for t in base[1:8]:
        words = t.split(" ")
        for k in (1, 2, 6):
            near = list(words)
            for _ in range(k):
                near[rng.randrange(len(near))] = "changed"
            texts.append(" ".join(near))
        texts.append(t)
    texts += [f"{prose(rng, 40)}\n{passage}\n{prose(rng, 40)}" for _ in range(6)]
    texts += [None, "", "   ", "one", "one", "one two", "é ñ ü — 漢字 🙂", prose(rng, 20_000), "\n".join(["same line here"] * 40)]
    rows = [(100 + 7 * i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", "B", None]), len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[1], "en", "a", 1), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture()
def docs(spark, rows):
    """The corpus with extra columns whose names clash with inner ones."""
    df = spark.createDataFrame(rows, DOCS)
    for name in ("node", "n", "row", "ids", "size", "bucket", "rid", "order", "toxicity", "component", "key", "copies"):
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def links_by_brute_force(sets, percent):
    """Components (smallest key) of sets by Jaccard similarity."""
    keys = sorted(sets, key=lambda k: (k is None, k))
    parent = {k: k for k in keys}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)), key=lambda k: (k is None, k))
                parent[y] = x
    return {k: root(k) for k in keys}
