"""The registered queries of the operators, and the SQL of those that SQL can express."""

from tendersift.llm.alignment import op13_token_alignment
from tendersift.llm.bpe import op7_bpe_round_trip
from tendersift.llm.cube import op9_cube_mix
from tendersift.llm.density import op5_text_density
from tendersift.llm.exact import OP11_SQL, op11_bloom_exact_dedup
from tendersift.llm.maxent import op6_maxent_lm
from tendersift.llm.nbsvm import op3_quality_nbsvm
from tendersift.llm.neighbours import op8_stable_projection_ann
from tendersift.llm.order import op1_training_order
from tendersift.llm.rules import op10_quality_rules
from tendersift.llm.simhash import op2_simhash_near_dedup
from tendersift.llm.skyband import OP12_SQL, op12_source_divergence
from tendersift.llm.toxicity import op4_toxicity_mil

QUERIES = {f.__name__: f for f in (
    op1_training_order, op2_simhash_near_dedup, op3_quality_nbsvm, op4_toxicity_mil, op5_text_density, op6_maxent_lm, op7_bpe_round_trip,
    op8_stable_projection_ann, op9_cube_mix, op10_quality_rules, op11_bloom_exact_dedup, op12_source_divergence,
    op13_token_alignment,
)}
ORACLE: dict[str, str] = {"op11_bloom_exact_dedup": OP11_SQL, "op12_source_divergence": OP12_SQL}
