"""Column-level building blocks (built-in Spark expressions)."""

from .text import (CLS_ID, MAX_LENGTH, N_FEATURES, PAD_ID, SEP_ID, THRESHOLD, UNKNOWN, as_text, cut_text,
                   feature_of, order_key, render_template, sigmoid, strip_brackets_quotes,
                   token_ids, tokens, unit_hash, word_id)
from .lists import parse_list, parse_list_strict, parse_list_tolerant

__all__ = [
    "CLS_ID", "MAX_LENGTH", "N_FEATURES", "PAD_ID", "SEP_ID", "THRESHOLD", "UNKNOWN", "as_text", "cut_text",
    "feature_of", "order_key", "render_template", "sigmoid", "strip_brackets_quotes",
    "token_ids", "tokens", "unit_hash", "word_id", "parse_list", "parse_list_strict", "parse_list_tolerant",
]
