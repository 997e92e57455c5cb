"""The queries of this subpackage and, where SQL can express them, their oracles."""

from casemart.llm import (  # noqa: F401  (each registers its query)
    bpe, chat, decontaminate, hilbert, lexical, lm_score, near_dedup, pii, quality, token_counts, topk, url_filter,
    whitening)
from casemart.llm.common import ORACLE, REGISTRY  # noqa: F401
