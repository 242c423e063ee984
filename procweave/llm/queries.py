"""Queries over the training-data operators: one for each, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat import OP7_SQL, op7_grammar_chat
from .debruijn import OP5_SQL, op5_debruijn_dedup
from .filter_audit import OP13_SQL, op13_filter_audit
from .importance import OP12_SQL, op12_importance_resampling
from .kmeans_tree import op10_kmeans_tree
from .langid import op6_word_first_langid
from .lpf import OP9_SQL, op9_suffix_dedup
from .minhash_forest import OP2_SQL, op2_lsh_forest
from .multi_index import OP8_SQL, op8_multi_index
from .packing import op3_concat_cut
from .prefix_bpe import op11_prefix_table
from .tree_bpe import op4_tree_bpe
from .wavelet import op1_wavelet_tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_wavelet_tokens, op2_lsh_forest, op3_concat_cut, op4_tree_bpe, op5_debruijn_dedup, op6_word_first_langid, op7_grammar_chat, op8_multi_index, op9_suffix_dedup, op10_kmeans_tree, op11_prefix_table, op12_importance_resampling, op13_filter_audit)
}

#: DuckDB SQL for those that SQL can express. Tokenizers (1, 3, 4, 11), a fitted model (6) and an approximate search (10)
#: are tested against the library, brute force and recall in tests/llm.
ORACLE_SQL: dict[str, str] = {"op2_lsh_forest": OP2_SQL, "op5_debruijn_dedup": OP5_SQL, "op7_grammar_chat": OP7_SQL, "op8_multi_index": OP8_SQL, "op9_suffix_dedup": OP9_SQL, "op12_importance_resampling": OP12_SQL, "op13_filter_audit": OP13_SQL}
