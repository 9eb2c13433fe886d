"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from postroom.llm.chat import OP9_SQL, op9_chat_formatting
from postroom.llm.licenses import OP7_SQL, op7_license_scan
from postroom.llm.minhash import op11_minhash_near_dedup
from postroom.llm.mixing import op10_mixing
from postroom.llm.packing import op5_best_fit_packing
from postroom.llm.periodic_runs import op12_periodic_runs
from postroom.llm.perplexity import op1_quality_classifier
from postroom.llm.quality_rules import op2_quality_rules
from postroom.llm.simhash import op8_simhash_near_dedup
from postroom.llm.token_counts import op4_token_counts
from postroom.llm.topk import OP6_SQL, op6_exact_top_k
from postroom.llm.toxicity import op3_toxicity
from postroom.llm.whitening import op13_whitening

QUERIES = {
    q.__name__: q
    for q in (
        op1_quality_classifier, op2_quality_rules, op3_toxicity, op4_token_counts, op5_best_fit_packing,
        op6_exact_top_k, op7_license_scan, op8_simhash_near_dedup, op9_chat_formatting, op10_mixing,
        op11_minhash_near_dedup, op12_periodic_runs, op13_whitening,
    )
}
ORACLE: dict[str, str] = {"op6_exact_top_k": OP6_SQL, "op7_license_scan": OP7_SQL, "op9_chat_formatting": OP9_SQL}
