"""Encoding, packing, alignment and token counts of all documents.  SQL cannot express the tokenizers."""

from __future__ import annotations

import public_tokenizers

from clamor.llm.alignment import align
from clamor.llm.byte_bpe import token_digests
from clamor.llm.common import table
from clamor.llm.packing import pack
from clamor.llm.token_counts import token_counts

RANKS = "byte_bpe_multi_50k.tiktoken"
WORDS = "word_bpe_49k.json"
BYTES = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def op5_byte_bpe(spark, sf_dir):
    return token_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    )


def op8_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))


def op11_token_alignment(spark, sf_dir):
    docs, path = table(spark, sf_dir, "documents"), public_tokenizers.path
    return align(docs, path(BYTES), public_tokenizers.PATTERN, path(PIECES))


def op12_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))


QUERIES = {
    "op5_byte_bpe": op5_byte_bpe,
    "op8_packing": op8_packing,
    "op11_token_alignment": op11_token_alignment,
    "op12_token_counts": op12_token_counts,
}
ORACLES = {}
