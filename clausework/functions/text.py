"""Column expressions for text: tokens, hashed token ids, cuts, templates.

Everything here is a built-in Spark expression (JVM side, no Python), so it
runs inside the scan stage and in whole-stage codegen where Spark allows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the behaviour being matched).
MAX_LENGTH = 512          # window width in tokens, specials included
TRAIN_STEP = 256          # training windows start every 256 tokens
PREDICT_OVERLAP = 256     # prediction windows overlap by 256 tokens
CUT_CHARS = 2000          # stance premise is cut above 2,000 characters ...
CUT_SUFFIX = "..."        # ... and gets this suffix
THRESHOLD = 0.5           # a class is predicted when its pooled p >= 0.5
UNKNOWN = "Unknown"       # label of a row that failed or could not be parsed
# ---------------------------------------------------------------------------

# Our own hashed vocabulary (the default tokenizer; a foreign one plugs in).
PAD_ID = 0
CLS_ID = 1
SEP_ID = 2
FIRST_WORD_ID = 3
WORD_BUCKETS = 65533      # word ids are 3 .. 65535
N_FEATURES = 1 << 14      # scorer features (default): token id modulo this
BIAS_FEATURE = -1         # the head keeps its bias as feature -1

TOKEN_PATTERN = r"[^ \t\n\r]+"


def tokens(text: Column) -> Column:
    """Whitespace tokens of a text, in order (T1 default tokenizer)."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 0)


def md5_bits(s: Column, hex_digits: int = 8) -> Column:
    """First ``hex_digits`` hex digits of md5(s) as a non-negative BIGINT."""
    return F.conv(F.substring(F.md5(s), 1, hex_digits), 16, 10).cast("bigint")


def word_id(tok: Column) -> Column:
    return (F.lit(FIRST_WORD_ID) + F.pmod(md5_bits(F.lower(tok)), F.lit(WORD_BUCKETS))).cast("int")


def _lowered_word_id(tok: Column) -> Column:
    return (F.lit(FIRST_WORD_ID) + F.pmod(md5_bits(tok), F.lit(WORD_BUCKETS))).cast("int")


def token_ids(text: Column) -> Column:
    """Token ids without specials: hashed lower-cased whitespace tokens.

    The text is lower-cased once before splitting (the same tokens as
    lower-casing each one: lower-casing never adds or removes whitespace).
    """
    return F.transform(tokens(F.lower(text)), _lowered_word_id)


def feature_of(token_id: Column, n_features: int = N_FEATURES) -> Column:
    return F.pmod(token_id, F.lit(n_features)).cast("int")


def unit_hash(seed: Column | str | int, key: Column) -> Column:
    """Uniform value in [0, 1) from md5(seed:key): partition-independent."""
    return md5_bits(F.concat_ws(":", F.lit(str(seed)) if not isinstance(seed, Column) else seed,
                                key.cast("string"))) / F.lit(4294967296.0)


def order_key(seed: Column | str | int, key: Column) -> Column:
    """60-bit ordering key from md5(seed:key) (exact samples sort by it)."""
    return md5_bits(F.concat_ws(":", F.lit(str(seed)) if not isinstance(seed, Column) else seed,
                                key.cast("string")), 15)


def cut_text(text: Column, max_chars: int = CUT_CHARS, suffix: str = CUT_SUFFIX) -> Column:
    """Cut to ``max_chars`` characters and append ``suffix`` when longer."""
    return F.when(F.length(text) > max_chars,
                  F.concat(F.substring(text, 1, max_chars), F.lit(suffix))).otherwise(text)


def strip_brackets_quotes(s: Column) -> Column:
    """Strip the characters [ ] ' " from both ends."""
    return F.btrim(s, F.lit("[]'\""))


def render_template(template: Column, actor: Column, slot: str = "{actor}") -> Column:
    """Literal replacement of the actor slot, never a regex."""
    return F.replace(template, F.lit(slot), actor)


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def as_text(c: Column, null_text: str = "") -> Column:
    """Cast to text; a null becomes ``null_text`` (C2). Use "nan" for the
    behaviour of a pandas ``astype(str)``."""
    return F.coalesce(c.cast("string"), F.lit(null_text))
