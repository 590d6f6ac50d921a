import hashlib

import corpus_pipeline
from pyspark.sql import functions as F

from sparkmart.llm import bpe, mixing, toxicity
from tests.llm.conftest import links_by_brute_force
from tests.llm.test_ngram_join import shingles
from tests.llm.test_suffix_dedup import brute

SF = "/root/testdata/sf0.001"


def test_stages_do_what_their_operators_say(spark):
    """Each stage against brute force on what the one before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["toxicity", "ngram_jaccard_join", "suffix_array_dedup", "mixing", "bpe"]
    given = docs.select("doc_id", "text").collect()

    calm = steps["toxicity"](spark, docs, SF).cache()
    scores = toxicity.fitted(spark, docs, SF).score(docs.select("doc_id", "text")).collect()
    assert {r.doc_id for r in calm.collect()} == {r.doc_id for r in scores if r.toxicity < 0.5}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [r.doc_id for r in given if labels.get(r.doc_id) == 0]
    assert len({r.doc_id for r in calm.collect()} & set(clean)) > 0.97 * len(clean)

    sole = steps["ngram_jaccard_join"](spark, calm, SF).cache()
    want = links_by_brute_force({r.doc_id: shingles(r.text, 5) for r in calm.collect()}, 80)
    assert sorted(r.doc_id for r in sole.collect()) == sorted(i for i in want if want[i] == i)

    cut = steps["suffix_array_dedup"](spark, sole, SF).cache()
    kept = {i: sha for i, _, _, _, sha in brute([(r.doc_id, r.text) for r in sole.collect()])}
    for r in cut.collect():
        if hashlib.sha256(r.text.encode()).hexdigest() != kept[r.doc_id]:
            assert not r.text.isascii()                       # a cut inside a character
    assert cut.columns == docs.columns

    mixed = steps["mixing"](spark, cut, SF).cache()
    taken = {r.doc_id: r.copies for r in mixing.queued(cut).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == taken

    out = steps["bpe"](spark, mixed, SF).collect()
    tok = bpe.codec(bpe.default_vocabulary()).tok
    text = {r.doc_id: r.text for r in cut.collect()}
    assert len(out) == sum(taken.values())
    assert all(r.n_tokens == len(tok.encode(text[r.doc_id], add_special_tokens=False).ids) for r in out)


def test_run_on_an_empty_table(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.lit(False))
    docs.write.parquet(f"{scratch}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{scratch}/labels.parquet")
    assert corpus_pipeline.run(spark, scratch).count() == 0
