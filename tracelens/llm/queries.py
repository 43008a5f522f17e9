"""Driver queries of the llm operators and their DuckDB SQL."""

from __future__ import annotations

from .bagminhash import op2_bagminhash
from .cap_filters import op4_cap_filters
from .crf_langid import op1_crf_langid
from .suffix_repeats import op3_suffix_repeats
from .gru_lm import op5_gru_lm
from .laesa_codes import OP13_SQL, op13_laesa_codes
from .periodic_runs import op12_periodic_runs
from .rendezvous import op9_rendezvous_shards
from .ss_packing import op8_sum_of_squares_packing
from .trie_bpe import op7_trie_bpe
from .vp_trees import op10_vp_trees
from .whole_tokens import op11_whole_token_counts
from .zstd_toxicity import op6_zstd_toxicity

QUERIES = {f.__name__: f for f in (
    op1_crf_langid, op2_bagminhash, op3_suffix_repeats, op4_cap_filters, op5_gru_lm, op6_zstd_toxicity, op7_trie_bpe, op8_sum_of_squares_packing, op9_rendezvous_shards, op10_vp_trees,
    op11_whole_token_counts, op12_periodic_runs, op13_laesa_codes,
)}

ORACLE: dict[str, str] = {"op13_laesa_codes": OP13_SQL}
