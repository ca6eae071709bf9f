"""Registered queries of this subpackage, and the same in SQL where SQL can say it."""

from trackledger.catalog.base import Query
from trackledger.llm import (
    bpe,
    chat,
    exact_dedup,
    fingerprints,
    lm,
    mixing,
    near_dups,
    quality,
    search,
    token_files,
    toxicity,
    warc,
    whitening,
)

QUERIES: dict[str, Query] = {
    "op1_fingerprints": Query(fingerprints.query),
    "op2_toxicity": Query(toxicity.query),
    "op3_mixing": Query(mixing.query),
    "op4_lm_scoring": Query(lm.query),
    "op5_byte_bpe": Query(bpe.query),
    "op6_exact_dedup": Query(exact_dedup.query, exact_dedup.SQL),
    "op7_chat": Query(chat.query),
    "op8_ngram_jaccard": Query(near_dups.query, near_dups.SQL),
    "op9_warc": Query(warc.query, warc.SQL),
    "op10_token_files": Query(token_files.query),
    "op11_whitening": Query(whitening.query),
    "op12_search": Query(search.query, search.SQL),
    "op13_quality": Query(quality.query),
}
