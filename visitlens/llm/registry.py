"""Registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from visitlens.llm import divergence, urls
from visitlens.llm.fingerprints import op3_one_permutation_minhash
from visitlens.llm.language import op9_hyperdimensional_language
from visitlens.llm.licenses import op7_conditional_compression
from visitlens.llm.packing import op10_vector_best_fit
from visitlens.llm.personal import op6_semi_markov_pii
from visitlens.llm.pieces import op8_relational_lattice
from visitlens.llm.quality import op5_isolation_forest
from visitlens.llm.runs import op13_synchronising_runs
from visitlens.llm.similarity import op4_chosen_path_join
from visitlens.llm.substrings import op2_prefix_doubling
from visitlens.llm.toxicity import op1_block_max_toxicity

QUERIES = {
    "op1_block_max_toxicity": op1_block_max_toxicity,
    "op2_prefix_doubling": op2_prefix_doubling,
    "op3_one_permutation_minhash": op3_one_permutation_minhash,
    "op4_chosen_path_join": op4_chosen_path_join,
    "op5_isolation_forest": op5_isolation_forest,
    "op6_semi_markov_pii": op6_semi_markov_pii,
    "op7_conditional_compression": op7_conditional_compression,
    "op8_relational_lattice": op8_relational_lattice,
    "op9_hyperdimensional_language": op9_hyperdimensional_language,
    "op10_vector_best_fit": op10_vector_best_fit,
    "op11_path_templates": urls.op11_path_templates,
    "op12_source_divergence": divergence.op12_source_divergence,
    "op13_synchronising_runs": op13_synchronising_runs,
}

ORACLE: dict[str, str] = {
    "op11_path_templates": urls.ORACLE,
    "op12_source_divergence": divergence.ORACLE,
}
