"""Registered queries of the package and their DuckDB SQL, by name."""
from __future__ import annotations

from .decontaminate import op5_decontaminate
from .embedding_dedup import op10_embedding_dedup
from .hmm_scores import op2_hmm_scores
from .merkle import OP13_SQL, op13_merkle_manifest
from .minhash_dedup import op6_minhash_dedup
from .prefix_trie import OP11_SQL, op11_prefix_trie
from .quality_crf import op3_quality_crf
from .repeated_text import OP12_SQL, op12_repeated_text
from .secret_scan import op9_secret_scan
from .sentencepiece_codec import op4_sentencepiece
from .token_counts import op8_token_counts
from .token_files import op7_token_files
from .warc import OP1_SQL, op1_warc

QUERIES = {
    "op1_warc": op1_warc,
    "op2_hmm_scores": op2_hmm_scores,
    "op3_quality_crf": op3_quality_crf,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_decontaminate": op5_decontaminate,
    "op6_minhash_dedup": op6_minhash_dedup,
    "op7_token_files": op7_token_files,
    "op8_token_counts": op8_token_counts,
    "op9_secret_scan": op9_secret_scan,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_repeated_text": op12_repeated_text,
    "op13_merkle_manifest": op13_merkle_manifest,
}

#: Queries that SQL cannot express have none; tests/llm holds them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_warc": OP1_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_repeated_text": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
