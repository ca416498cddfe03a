"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from gridwise.llm.bpe import op3_bpe
from gridwise.llm.collocations import OP12_SQL, op12_collocations
from gridwise.llm.hamming import OP2_SQL, op2_hamming_topk
from gridwise.llm.jaccard import OP9_SQL, op9_jaccard_join
from gridwise.llm.langid import op10_language_id
from gridwise.llm.mixing import OP8_SQL, op8_mixing
from gridwise.llm.pii import op7_pii
from gridwise.llm.quality import op6_quality
from gridwise.llm.rp_forest import OP5_SQL, op5_embedding_dedup
from gridwise.llm.token_scan import op4_token_counts
from gridwise.llm.toxicity import op13_toxicity
from gridwise.llm.variants import OP11_SQL, op11_variants
from gridwise.llm.warc import OP1_SQL, op1_warc

QUERIES = {
    "op1_warc": op1_warc,
    "op2_hamming_topk": op2_hamming_topk,
    "op3_bpe": op3_bpe,
    "op4_token_counts": op4_token_counts,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_quality": op6_quality,
    "op7_pii": op7_pii,
    "op8_mixing": op8_mixing,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_language_id": op10_language_id,
    "op11_variants": op11_variants,
    "op12_collocations": op12_collocations,
    "op13_toxicity": op13_toxicity,
}

SQL: dict[str, str] = {
    "op1_warc": OP1_SQL,
    "op2_hamming_topk": OP2_SQL,
    "op5_embedding_dedup": OP5_SQL,
    "op8_mixing": OP8_SQL,
    "op9_jaccard_join": OP9_SQL,
    "op11_variants": OP11_SQL,
    "op12_collocations": OP12_SQL,
}
