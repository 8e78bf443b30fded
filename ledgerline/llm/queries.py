"""Every query of this subpackage; importing the modules registers them."""

from ledgerline.llm import (  # noqa: F401
    q_bpe, q_chat, q_decontaminate, q_lines, q_ngrams, q_pii, q_quality, q_secrets, q_simhash,
    q_spelling, q_suffix, q_url, q_vectors,
)
from ledgerline.llm.common import ORACLES, QUERIES  # noqa: F401
