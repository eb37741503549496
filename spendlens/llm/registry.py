"""Queries of this folder by name, and their SQL."""

from __future__ import annotations

from . import collocations, embeddings, line_dedup, minhash, mixing, prefix_trie, quality_rules
from .byte_bpe import op7_byte_bpe
from .collocations import op12_collocations
from .embeddings import op6_embedding_near_dedup
from .line_dedup import op11_line_dedup
from .minhash import op5_minhash_near_dedup
from .mixing import op10_mixing
from .pii import op1_pii
from .prefix_trie import op13_prefix_trie
from .quality_classifier import op4_quality_classifier
from .quality_rules import op3_quality_rules
from .secrets import op9_secret_scans
from .token_cache import op2_token_counts
from .toxicity import op8_toxicity

QUERIES = {
    "op1_pii": op1_pii,
    "op2_token_counts": op2_token_counts,
    "op3_quality_rules": op3_quality_rules,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_toxicity": op8_toxicity,
    "op9_secret_scans": op9_secret_scans,
    "op10_mixing": op10_mixing,
    "op11_line_dedup": op11_line_dedup,
    "op12_collocations": op12_collocations,
    "op13_prefix_trie": op13_prefix_trie,
}

SQL: dict[str, str] = {
    "op3_quality_rules": quality_rules.ORACLE,
    "op5_minhash_near_dedup": minhash.ORACLE,
    "op6_embedding_near_dedup": embeddings.ORACLE,
    "op10_mixing": mixing.ORACLE,
    "op11_line_dedup": line_dedup.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
