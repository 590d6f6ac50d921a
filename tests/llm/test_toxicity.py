import random

import numpy as np
import pyarrow as pa
import pytest

from sparkmart.llm import toxicity
from sparkmart.llm._common import text_slices
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        text = prose(rng, 60)
        if i % 8 == 0:
            words = text.split(" ")
            words[rng.randrange(60)] = rng.choice(["idiot", "stupid", "1d10t", "stuuupid", "s.t.u.p.i.d"])
            text = " ".join(words)
        rows.append((i, text))
        labels.append((i, int(i % 8 == 0)))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_tokens_that_look_disguised():
    text = "you 1d10t and i d i o t, st.u.p.i.d x.y.z a$$ foo$$$ HELLO!! looooser 12,5 plain"
    found = [t for s in text_slices(pa.array([text])) for _, t in toxicity.disguised(s)]
    assert found == ["1d10t", "st.u.p.i.d", "x.y.z", "a$$", "looooser", "idiot"]


def test_restoration(spark):
    rng = random.Random(1)
    words = ["idiot", "stupid", "loser", "trash", "moron", "worthless"]
    docs = spark.createDataFrame([(i, prose(rng, 30) + " " + rng.choice(words)) for i in range(200)], "doc_id long, text string")
    decoder = toxicity.Restorer(toxicity.language_model(docs))
    for raw, word in [("1d10t", "idiot"), ("$tup1d", "stupid"), ("looooser", "loser"), ("tr@sh", "trash"), ("m.o.r.o.n", "moron"),
                      ("w0rthl3ss", "worthless"), ("plain", "plain")]:
        assert decoder.restore(raw) == word


def test_chains_and_tokens_of_any_length(spark):
    """A 200-letter chain, a 100-byte token and spaced leetspeak."""
    words = ["you", "are", "idiot", "stupid", "loser", "the", "worthless", "moron"]
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words) for _ in range(40))) for i in range(200)],
                                 "doc_id long, text string")
    decoder = toxicity.Restorer(toxicity.language_model(docs))

    def restored(text):
        return {x for s in text_slices(pa.array([text])) for _, t in toxicity.disguised(s) for x in decoder.words(t)}

    sentence = ["you", "are", "the", "stupid", "worthless", "moron"] * 7
    assert len("".join(sentence)) > 200 and restored(" ".join("".join(sentence))) >= set(sentence)
    assert restored("  ".join(" ".join(x) for x in sentence)) >= set(sentence)
    assert restored("s" + "t" * 100 + "upid") == {"stupid"}
    assert restored(".".join("".join(sentence))) >= set(sentence)
    assert "idiot" in restored("you i d 1 0 t here") and "stupid" in restored("s t u p 1 d")
    assert "idiot" in restored("1 d 1 0 7") and not restored("1 2 3 4 5 6")
    assert len("".join(decoder.words(toxicity.Chain("ab1" * 50_000)))) > 50_000


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    model = toxicity.ToxicityModel.fit(docs, labels, toxicity.remainder(5) != 0)
    got = {r.doc_id: r.toxicity for r in model.score(docs).collect()}
    right = [(s >= 0.5) == (i % 8 == 0) for i, s in got.items()]
    assert len(got) == 400 and np.mean(right) > 0.97


def test_edge_rows_pass_and_columns_stay(labelled, docs, rows, no_docs):
    model = toxicity.ToxicityModel.fit(*labelled)
    kept = toxicity.screen(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    assert toxicity.screen(no_docs, model).count() == 0


def test_labels_of_one_kind_or_none(spark, labelled, no_docs):
    docs, labels = labelled
    model = toxicity.ToxicityModel.fit(no_docs, labels.limit(0))
    assert all(r.toxicity < 1e-9 for r in model.score(docs.limit(5)).collect())
