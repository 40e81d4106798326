"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import corpus_pipeline

from .bpe import op7_byte_bpe
from .chat_format import OP1_SQL, op1_chat_format
from .exact_dedup import OP2_SQL, op2_exact_dedup
from .kd_sharding import op13_kd_sharding
from .language_id import op6_language_id
from .media import op9_media
from .merkle import OP11_SQL, op11_merkle_manifest
from .packing import op3_packing
from .prefix_trie import OP12_SQL, op12_prefix_trie
from .secret_scan import op8_secret_scan
from .simhash import op5_simhash
from .suffix_tree_lm import op4_lm_score
from .url_filter import OP10_SQL, op10_url_filter

QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_packing": op3_packing,
    "op4_lm_score": op4_lm_score,
    "op5_simhash": op5_simhash,
    "op6_language_id": op6_language_id,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_secret_scan": op8_secret_scan,
    "op9_media": op9_media,
    "op10_url_filter": op10_url_filter,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_kd_sharding": op13_kd_sharding,
    "pipeline": corpus_pipeline.run,
}

#: The others are held against brute force in tests/llm.
ORACLE_SQL = {"op1_chat_format": OP1_SQL, "op2_exact_dedup": OP2_SQL, "op10_url_filter": OP10_SQL, "op11_merkle_manifest": OP11_SQL, "op12_prefix_trie": OP12_SQL}
