"""Registered queries of this subpackage."""

from __future__ import annotations

from .decontaminate import op2_qgram_bands
from .dialogue import OP4_SQL, op4_perspective_rotation
from .language import op6_ftrl_regression
from .minhash import op10_bbit_minhash
from .negatives import OP12_SQL, op12_inverted_multi_index
from .packing import op1_sum_of_squares
from .pii import op3_boosted_candidates
from .quality import op5_loglikelihood_ratio
from .rans import op8_interleaved_rans
from .substring import op9_level_doubling
from .toxicity import op7_blockmax_neighbours
from .trie import OP11_SQL, op11_prefix_trie
from .warc import OP13_SQL, op13_zstd_warc

QUERIES = {f.__name__: f for f in (
    op1_sum_of_squares, op2_qgram_bands, op3_boosted_candidates, op4_perspective_rotation, op5_loglikelihood_ratio, op6_ftrl_regression, op7_blockmax_neighbours,
    op8_interleaved_rans, op9_level_doubling, op10_bbit_minhash, op11_prefix_trie, op12_inverted_multi_index, op13_zstd_warc)}
ORACLE_SQL = {"op4_perspective_rotation": OP4_SQL, "op11_prefix_trie": OP11_SQL, "op12_inverted_multi_index": OP12_SQL, "op13_zstd_warc": OP13_SQL}
