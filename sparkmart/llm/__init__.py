"""Operators of a training-data pipeline.  Nothing else in the library
imports this package; ``QUERIES`` and ``ORACLE_SQL`` are what the entry
module registers."""

from sparkmart.llm import (bpe, embedding_dedup, hard_negatives, lexical_search, mixing, ngram_join, quality_classifier,
                           quality_rules, sentencepiece_bpe, suffix_dedup, token_files, toxicity, warc)

QUERIES = {
    "op1_ngram_jaccard_join": ngram_join.op1_ngram_jaccard_join,
    "op2_warc": warc.op2_warc,
    "op3_source_mixing": mixing.op3_source_mixing,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_bpe_round_trip": bpe.op5_bpe_round_trip,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_quality_classifier": quality_classifier.op7_quality_classifier,
    "op8_suffix_array_dedup": suffix_dedup.op8_suffix_array_dedup,
    "op9_token_files": token_files.op9_token_files,
    "op10_embedding_near_dedup": embedding_dedup.op10_embedding_near_dedup,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_lexical_search": lexical_search.op12_lexical_search,
    "op13_sentencepiece_round_trip": sentencepiece_bpe.op13_sentencepiece_round_trip,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {"op2_warc": warc.ORACLE, "op11_hard_negatives": hard_negatives.ORACLE,
                              "op12_lexical_search": lexical_search.ORACLE}
