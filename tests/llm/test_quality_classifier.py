import random

import numpy as np

from sparkmart.llm import quality_classifier
from sparkmart.llm.toxicity import remainder
from tests.llm.conftest import prose


def test_held_out_accuracy_and_edge_rows(spark, docs, rows, no_docs):
    rng = random.Random(5)
    texts, labels = [], []
    for i in range(500):
        text, kind = prose(rng, 80), i % 10
        if kind == 0:
            text = " ".join(w.upper() + "!!" for w in text.split(" "))
        elif kind == 1:
            text = " ".join(f"{w} {w} {w}" for w in text.split(" ")[:30])
        texts.append((i, text))
        labels.append((i, int(kind > 1)))
    train = spark.createDataFrame(texts, "doc_id long, text string")
    labels_df = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality_classifier.QualityModel.fit(train, labels_df, remainder(4) != 2)
    held = {r.doc_id for r in train.where(remainder(4) == 2).collect()}
    got = {r.doc_id: r.score for r in model.score(train).collect()}
    assert np.mean([(got[i] >= 0.7) == bool(y) for i, y in labels if i in held]) > 0.95
    edge = model.score(docs).collect()
    assert len(edge) == len(rows) and all(0 <= r.score <= 1 for r in edge)
    assert model.score(no_docs).count() == 0


def test_no_labels(no_docs, docs, spark):
    model = quality_classifier.QualityModel.fit(no_docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in model.score(docs).collect()} == {0.5}
