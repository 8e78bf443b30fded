"""op3: encode every document and decode it again."""

from __future__ import annotations

import public_tokenizers

from ledgerline.llm import bpe
from ledgerline.llm.common import read, register

RANKS = "byte_bpe_multi_50k.tiktoken"


def tokenizer(spark, path: str | None = None) -> bpe.Tokenizer:
    return bpe.Tokenizer(spark, path or public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


@register("op3_byte_bpe")
def op3_byte_bpe(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, tokenizer(spark)).drop("text", "ids")
