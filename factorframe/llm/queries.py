"""The registered queries of this subpackage, and the SQL for those that SQL can express."""

from __future__ import annotations

from factorframe.llm import line_dedup, near_dup, neighbours, phrases, secrets
from factorframe.llm.chat import op6_chat_format
from factorframe.llm.decontaminate import op8_benchmark_decontamination
from factorframe.llm.language_id import op1_language_id
from factorframe.llm.line_dedup import op9_line_dedup
from factorframe.llm.near_dup import op10_minhash_near_dup
from factorframe.llm.neighbours import op12_nearest_neighbours
from factorframe.llm.packing import op2_best_fit_packing
from factorframe.llm.phrases import op11_phrase_collocations
from factorframe.llm.quality import op3_quality_rules
from factorframe.llm.secrets import op7_secret_scan
from factorframe.llm.suffix_dedup import op5_suffix_dedup
from factorframe.llm.token_counts import op4_token_counts
from factorframe.llm.variants import op13_spelling_variants

QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_best_fit_packing,
        op3_quality_rules,
        op4_token_counts,
        op5_suffix_dedup,
        op6_chat_format,
        op7_secret_scan,
        op8_benchmark_decontamination,
        op9_line_dedup,
        op10_minhash_near_dup,
        op11_phrase_collocations,
        op12_nearest_neighbours,
        op13_spelling_variants,
    )
}

#: The others count tokens, compress, learn, rank or cut bytes, which SQL cannot do or not on whole tables;
#: tests/llm compares them with brute force.
ORACLE = {
    "op7_secret_scan": secrets.ORACLE_SQL,
    "op9_line_dedup": line_dedup.ORACLE_SQL,
    "op10_minhash_near_dup": near_dup.ORACLE_SQL,
    "op11_phrase_collocations": phrases.ORACLE_SQL,
    "op12_nearest_neighbours": neighbours.ORACLE_SQL,
}
