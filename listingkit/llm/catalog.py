"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from listingkit.llm.chat import OP3_SQL, op3_chat_format
from listingkit.llm.hmm import op7_hmm_score
from listingkit.llm.jaccard import OP8_SQL, op8_jaccard_join
from listingkit.llm.kmeans import OP13_SQL, op13_centroid_clusters
from listingkit.llm.language import op6_language_id
from listingkit.llm.mixing import op2_mix_sources
from listingkit.llm.neighbours import op5_nearest_neighbours
from listingkit.llm.packing import op4_best_fit_packing
from listingkit.llm.quality import OP10_SQL, op10_quality_ledger
from listingkit.llm.sentences import op9_sentence_dedup
from listingkit.llm.subword import op12_quality_classifier
from listingkit.llm.toxicity import op1_toxicity
from listingkit.llm.whitening import op11_whitening

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_mix_sources": op2_mix_sources,
    "op3_chat_format": op3_chat_format,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_language_id": op6_language_id,
    "op7_hmm_score": op7_hmm_score,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_sentence_dedup": op9_sentence_dedup,
    "op10_quality_ledger": op10_quality_ledger,
    "op11_whitening": op11_whitening,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_centroid_clusters": op13_centroid_clusters,
}

ORACLE_SQL = {
    "op3_chat_format": OP3_SQL,
    "op8_jaccard_join": OP8_SQL,
    "op10_quality_ledger": OP10_SQL,
    "op13_centroid_clusters": OP13_SQL,
}
