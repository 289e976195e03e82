"""Token windows (T1-T5): two different windowings, kept apart on purpose.

* ``fixed_step_windows`` (training): specials only at the two ends of the
  whole text, a window of 512 every 256 tokens, never stopping early:
  ceil(n/256) windows with n counting the specials.
* ``overlap_windows`` (prediction): each window has its own two specials and
  510 text tokens, consecutive windows overlap by 256 tokens (so the step is
  254), and the last window is the one reaching the end:
  1 window if n <= 510, else 1 + ceil((n - 510) / 254), n without specials.

Both are narrow array expressions (``sequence`` + ``transform`` + ``slice``)
followed by one ``posexplode``: no shuffle, no Python, and each window is
built once from the token array (linear in the text length).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import built, identity_of, let
from ..functions.text import CLS_ID, FIRST_WORD_ID, MAX_LENGTH, PAD_ID, PREDICT_OVERLAP, SEP_ID, TRAIN_STEP, WORD_BUCKETS, token_ids

# texts that a plug-in tokenizer is given at once
TEXTS = 256
# different words whose ids a worker keeps, and the bytes of the longest that it keeps
WORDS = 1 << 18
WORD_BYTES = 64


def with_token_ids(df: DataFrame, text: str = "clause", out: str = "ids") -> DataFrame:
    """Token ids without specials (hashed whitespace tokens)."""
    return df.withColumn(out, token_ids(F.col(text)))


def _tokens(ids: str) -> Column:
    """The token array; a text without one (null) has no tokens and still gets its window of specials."""
    return F.coalesce(F.col(ids), F.array().cast("array<int>"))


def fixed_step_windows(df: DataFrame, ids: str = "ids", max_length: int = MAX_LENGTH, step: int = TRAIN_STEP,
                       keep: tuple[str, ...] = ("row_id",), out: str = "window_ids",
                       cls_id: int = CLS_ID, sep_id: int = SEP_ID) -> DataFrame:
    """One row per window ``(keep..., window, window_ids)``; carried columns repeat per window."""
    if step < 1 or max_length < 1:
        raise ValueError("step and max_length must be positive")
    whole = F.concat(F.array(F.lit(cls_id)), _tokens(ids), F.array(F.lit(sep_id)))
    # bound once: a window takes its slice of it and does not build it again
    wins = let(whole, lambda full: F.transform(F.sequence(F.lit(0), F.size(full) - 1, F.lit(step)), lambda s: F.slice(full, s + 1, max_length)))
    return df.select(*keep, F.posexplode(wins).alias("window", out))


def overlap_count(n_tokens, max_length: int = MAX_LENGTH, overlap: int = PREDICT_OVERLAP):
    """Closed-form window count of ``overlap_windows`` (Column or int)."""
    cap = max_length - 2
    step = cap - overlap
    if isinstance(n_tokens, int):
        return 1 if n_tokens <= cap else 1 + -(-(n_tokens - cap) // step)
    return F.when(n_tokens <= cap, F.lit(1)).otherwise(1 + F.ceil((n_tokens - cap) / F.lit(step))).cast("int")


def overlap_windows(df: DataFrame, ids: str = "ids", max_length: int = MAX_LENGTH,
                    overlap: int = PREDICT_OVERLAP, keep: tuple[str, ...] = ("row_id",),
                    out: str = "window_ids", cls_id: int = CLS_ID, sep_id: int = SEP_ID) -> DataFrame:
    """T5: overflow windows with their own specials; ``overlap`` is the shared span."""
    cap = max_length - 2
    step = cap - overlap
    if cap < 1 or step < 1:
        raise ValueError("need max_length - 2 > overlap")
    tokens = _tokens(ids)
    count = overlap_count(F.size(tokens), max_length, overlap)
    starts = F.sequence(F.lit(0), (count - 1) * F.lit(step), F.lit(step))
    wins = F.transform(starts, lambda s: F.concat(F.array(F.lit(cls_id)), F.slice(tokens, s + 1, cap),
                                                  F.array(F.lit(sep_id))))
    return df.select(*keep, F.posexplode(wins).alias("window", out))


def pad_windows(df: DataFrame, window_ids: str = "window_ids", max_length: int = MAX_LENGTH,
                pad_id: int = PAD_ID) -> DataFrame:
    """Right-pad to ``max_length`` with the pad id and add the 0/1 mask."""
    n = F.size(F.col(window_ids))
    pad = F.lit(max_length) - n
    return (df.withColumn("n_tokens", n.cast("int"))
            .withColumn("input_ids", F.concat(F.col(window_ids), F.array_repeat(F.lit(pad_id), pad)))
            .withColumn("attention_mask", F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), pad))))


# --- the default tokenizer in a Python worker ---------------------------------

def make_word_ids() -> Callable[[bytes], np.ndarray]:
    """``encode`` that gives a lower-cased text (UTF-8) the ids of ``token_ids``; a word that comes back is not hashed again."""
    word = re.compile(rb"[^ \t\n\r]+")

    class Known(dict):
        def __missing__(self, w: bytes) -> int:
            own = FIRST_WORD_ID + int.from_bytes(hashlib.md5(w, usedforsecurity=False).digest()[:4], "big") % WORD_BUCKETS
            if len(w) <= WORD_BYTES:
                if len(self) >= WORDS:
                    self.clear()
                self[w] = own
            return own

    known = Known()

    def encode(text: bytes) -> np.ndarray:
        # a vertical tab and a form feed are no blanks here
        words = word.findall(text) if b"\x0b" in text or b"\x0c" in text else text.split()
        return np.fromiter(map(known.__getitem__, words), dtype=np.int32, count=len(words))

    return encode


def encoded(texts: pa.Array, encode: Callable[[bytes], np.ndarray]) -> Iterator[np.ndarray | None]:
    """The ids of each text of an Arrow array, one after another; null stays None."""
    for t in texts.cast(pa.binary()):
        own = t.as_py()
        yield None if own is None else encode(own)


def word_token_ids(text: Column) -> Column:
    """The ids of ``token_ids`` by an Arrow UDF that hashes a word once."""
    identity = identity_of(make_word_ids)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = built("word-ids", identity, make_word_ids)
        for texts in batches:
            parts = [pa.array(list(encoded(texts.slice(at, TEXTS), encode)), type=pa.list_(pa.int32())) for at in range(0, len(texts), TEXTS)]
            yield pa.concat_arrays(parts) if parts else pa.array([], type=pa.list_(pa.int32()))

    return ids(F.lower(text))


# --- foreign tokenizers (U1) -------------------------------------------------

def foreign_token_ids(text: Column, make_tokenizer) -> Column:
    """T1 through a plug-in tokenizer, as an Arrow UDF.

    ``make_tokenizer()`` returns ``encode(texts: list[str]) -> list[list[int]]``
    (ids without specials). It is built once per Python worker and given
    ``TEXTS`` texts of an Arrow batch at a time, whose ids are packed before the
    next ones; windows, scoring and pooling stay as they are.
    """
    identity = identity_of(make_tokenizer)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fn = built("tokenizer", identity, make_tokenizer)

        def ids_of(texts: list) -> pa.Array:
            known, own = [i for i, t in enumerate(texts) if t is not None], [None] * len(texts)
            for i, ids in zip(known, fn([texts[i] for i in known]) if known else [], strict=True):
                own[i] = np.fromiter((int(x) for x in ids), dtype=np.int32)
            return pa.array(own, type=pa.list_(pa.int32()))

        for texts in batches:
            parts = [ids_of(texts.slice(at, TEXTS).to_pylist()) for at in range(0, len(texts), TEXTS)]
            yield pa.concat_arrays(parts) if parts else pa.array([], type=pa.list_(pa.int32()))

    return encode(text)


def with_foreign_token_ids(df: DataFrame, make_tokenizer, text: str = "clause", out: str = "ids") -> DataFrame:
    return df.withColumn(out, foreign_token_ids(F.col(text), make_tokenizer))
