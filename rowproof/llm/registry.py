"""The registered queries of this package and their DuckDB equivalents."""

from __future__ import annotations

from rowproof.llm import divergence, exactdedup, interpolation, jaccard, language, mixing, packing, periods, phrases, suffixes, superkmers, toxicity, vectors
from rowproof.llm.oracles import ORACLES

QUERIES = {
    f.__name__: f
    for f in (
        toxicity.op1_toxicity,
        language.op2_language_id,
        vectors.op3_vector_dedup,
        suffixes.op4_suffix_dedup,
        interpolation.op5_lm_scoring,
        jaccard.op6_jaccard_join,
        mixing.op7_mixing,
        packing.op8_packing,
        exactdedup.op9_exact_dedup,
        superkmers.op10_superkmer_dedup,
        periods.op11_periodic_runs,
        divergence.op12_source_divergence,
        phrases.op13_phrase_fingerprint,
    )
}

__all__ = ["ORACLES", "QUERIES"]
