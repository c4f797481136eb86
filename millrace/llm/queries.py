"""The registered queries of this package and the SQL they are checked against."""

from millrace.llm import (conversations, embeddings, exact_dedup, fingerprints, hard_negatives, html_extraction, language, minhash,
                          mixing, packing, quality, separators, toxicity)

QUERIES = {f.__name__: f for f in (
    mixing.op1_mixing, exact_dedup.op2_exact_dedup, language.op3_language_id, toxicity.op4_toxicity,
    quality.op5_quality_classifier, minhash.op6_minhash_near_dedup, packing.op7_packing,
    separators.op8_separator_scan, embeddings.op9_embedding_near_dedup, html_extraction.op10_html_extraction,
    hard_negatives.op11_hard_negatives, conversations.op12_conversation_repair, fingerprints.op13_document_fingerprints)}
ORACLES = {"op2_exact_dedup": exact_dedup.OP2_SQL, "op11_hard_negatives": hard_negatives.OP11_SQL,
           "op12_conversation_repair": conversations.OP12_SQL}
