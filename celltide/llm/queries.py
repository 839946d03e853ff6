"""The registered queries of these operators, and their results in SQL where SQL can express them."""

from __future__ import annotations

from celltide.llm import divergence, lexical, line_dedup, mixing
from celltide.llm.divergence import op12_source_divergence
from celltide.llm.fingerprints import op2_document_fingerprints
from celltide.llm.hash_forest import op3_hash_forest
from celltide.llm.html_text import op9_html_text
from celltide.llm.jaccard_join import op4_jaccard_join
from celltide.llm.lexical import op13_ranked_search
from celltide.llm.licenses import op6_license_scan
from celltide.llm.line_dedup import op10_line_dedup
from celltide.llm.mixing import op8_mix_sources
from celltide.llm.packing import op7_best_fit_packing
from celltide.llm.personal import op11_personal_data
from celltide.llm.quality import op5_quality_classifier
from celltide.llm.suffix_dedup import op1_suffix_dedup

QUERIES = {q.__name__: q for q in (
    op1_suffix_dedup,
    op2_document_fingerprints,
    op3_hash_forest,
    op4_jaccard_join,
    op5_quality_classifier,
    op6_license_scan,
    op7_best_fit_packing,
    op8_mix_sources,
    op9_html_text,
    op10_line_dedup,
    op11_personal_data,
    op12_source_divergence,
    op13_ranked_search,
)}

ORACLES = {
    "op8_mix_sources": mixing.ORACLE,
    "op10_line_dedup": line_dedup.ORACLE,
    "op12_source_divergence": divergence.ORACLE,
    "op13_ranked_search": lexical.ORACLE,
}
