"""The queries of this subpackage, and the SQL they are held against."""

from . import chunk_dedup, exact_dedup, fingerprints, language_gru, mixing, orchard, packing, quality_cnn, simhash, suffix_dedup, token_counts, toxicity, whitening

QUERIES = {
    "op1_best_fit_packing": packing.op1,
    "op2_suffix_dedup": suffix_dedup.op2,
    "op3_quality_classifier": quality_cnn.op3,
    "op4_simhash_near_dedup": simhash.op4,
    "op5_token_counts": token_counts.op5,
    "op6_mixing": mixing.op6,
    "op7_substring_dedup": chunk_dedup.op7,
    "op8_exact_dedup": exact_dedup.op8,
    "op9_document_fingerprints": fingerprints.op9,
    "op10_toxicity": toxicity.op10,
    "op11_language_id": language_gru.op11,
    "op12_embedding_whitening": whitening.op12,
    "op13_centroid_clustering": orchard.op13,
}

ORACLES = {"op8_exact_dedup": exact_dedup.OP8_SQL}
