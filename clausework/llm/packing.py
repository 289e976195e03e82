"""Pack token sequences by best-fit with two-for-one replacement.

A document is tokenized, closed with an end id and, only if longer than a
sequence, cut into full pieces and a rest. Pieces of one length are alike, so
the packing is planned on the histogram of lengths, which has at most
``capacity`` rows however many documents there are: fill a bin greedily with
the longest length that fits, then replace its smallest member with the two
unpacked lengths that fit the expanded gap more tightly, and use the layout as
often as the counts allow. The plan is then dealt out: a piece's number among
those of its length (distributed prefix sums over hash buckets) names its
layout, bin and place.

Defined cases: a null text is empty and becomes the end id alone; repeated rows
are packed once each; an empty table gives an empty result; a very long text is
cut, never dropped; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import give_back, stored, word_memory

CAPACITY = 2048
END_ID = 0
# words a worker remembers per generation; two generations are kept
REMEMBERED = 200_000
# pieces of a length and bucket that are numbered together, about
BUCKET_ROWS = 5_000

# fixed values: the pipeline of tokenizers that work word by word (white space dropped), as their files write it
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
# words of these characters are in normal form and lower-case one character at a time
PLAIN = "[!-~¡-ɏ]+"


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others take the code
    points from 256 on in order.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return {b: chr(b) if b in own else chr(next(spare)) for b in range(256)}


class WordIds(dict):
    """Token ids of white-space separated words, as little-endian bytes, filled as words are met.

    Missing words are split and tokenized by the tokenizer's own model; words
    with characters outside ``PLAIN`` or with an added token go through the
    whole tokenizer. Old words are dropped a generation at a time.
    """

    def __init__(self, tokenizer, remembered: int = REMEMBERED):
        import re

        import regex

        super().__init__()
        self.tokenizer, self.model, self.remembered, self.old, self.parts = tokenizer, tokenizer.model, remembered, {}, {}
        self.plain, self.split, self.letters = re.compile(PLAIN).fullmatch, regex.compile(WORD_PATTERN).findall, byte_letters()

    def part(self, p: str) -> bytes:
        found = self.parts.get(p)
        if found is None:
            ids = [t.id for t in self.model.tokenize(p.encode().decode("latin-1").translate(self.letters))]
            if len(self.parts) >= self.remembered:
                self.parts.clear()
            found = self.parts[p] = np.array(ids, dtype="<u4").tobytes()
        return found

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            w = word.decode("utf-8", "surrogatepass")
            if self.plain(w) and "<|" not in w:
                w = w.lower()
                ids = self.part(w) if w.isalpha() else b"".join(map(self.part, self.split(w)))
            else:
                ids = np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(self) >= self.remembered:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids


def tokenizer_of(path: str):
    """A function from a text (UTF-8) to its ids as little-endian bytes, kept per worker.

    Tokenizers that drop white space and never look beyond a word are run word
    by word with a memory of words; others get the whole text.
    """
    import json

    from tokenizers import Tokenizer

    def make():
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        tokenizer = Tokenizer.from_file(path)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        by_word = (((spec.get("normalizer") or {}).get("normalizers") == WORD_NORMALIZERS) and len(steps) == 2
                   and steps[0] == {"type": "Split", "pattern": {"Regex": WORD_PATTERN}, "behavior": "Removed", "invert": True}
                   and steps[1]["type"] == "ByteLevel" and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]
                   and all("<|" in a["content"] and not a["lstrip"] and not a["rstrip"] and not a["single_word"]
                           and not any(c.isspace() for c in a["content"]) for a in spec["added_tokens"]))
        if by_word:
            ids_of = WordIds(tokenizer).__getitem__
            return lambda text: b"".join(map(ids_of, text.split()))
        return lambda text: np.array(
            tokenizer.encode(text.decode("utf-8", "surrogatepass"), add_special_tokens=False).ids, dtype="<u4").tobytes()

    return word_memory(f"packing {path}", make)


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every piece; ``with_ids`` adds the ids themselves."""
    end = np.array([end_id], dtype="<u4").tobytes()
    kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}
    if with_ids:
        kinds["ids"] = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer_of(tokenizer)
        for batch in batches:
            columns: list[list] = [[] for _ in kinds]
            size = 0
            # one text at a time leaves Arrow's buffer
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary()), strict=True):
                data = (encode(text.as_py()) if text.is_valid else b"") + end
                for at in range(0, len(data), 4 * capacity):
                    cut = data[at:at + 4 * capacity]
                    row = (doc_id, at // 4 // capacity, at // 4, len(cut) // 4, zlib.crc32(cut))
                    for column, value in zip(columns, (*row, np.frombuffer(cut, dtype="<i4")) if with_ids else row, strict=True):
                        column.append(value)
                size += len(data)
                if with_ids and size > 1 << 24:
                    yield frame(columns)
                    columns, size = [[] for _ in kinds], 0
            yield frame(columns)
        give_back()

    def frame(columns: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def plan_layouts(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Layouts ``(lengths, times)`` that use up ``counts`` (length -> number of pieces).

    Each round exhausts a length (or leaves less of it than a layout needs), so
    the number of rounds follows the lengths, not the pieces.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for n, c in counts.items():
        if not 0 < n <= capacity:
            raise ValueError(f"a piece of {n} tokens does not fit")
        left[n] = c
    layouts = []
    while left.any():
        lengths = np.flatnonzero(left)
        free = left.copy()

        def longest(most: int) -> int:
            """The longest length up to ``most`` of which a piece is free."""
            at = int(np.searchsorted(lengths, most, side="right")) - 1
            while at >= 0 and not free[lengths[at]]:
                at -= 1
            return int(lengths[at]) if at >= 0 else 0

        layout, gap = [], capacity
        while gap and (n := longest(gap)):
            layout.append(n)
            free[n] -= 1
            gap -= n
        if gap and len(layout) > 1:
            small = layout[-1]
            pair = _best_pair(free, lengths, gap + small)
            if sum(pair) > small:
                layout[-1:] = pair
                free[small] += 1
                for n in pair:
                    free[n] -= 1
        used = left - free
        some = np.flatnonzero(used)
        times = int((left[some] // used[some]).min())
        layouts.append((sorted(layout, reverse=True), times))
        left -= used * times
    return layouts


def _best_pair(free: np.ndarray, lengths: np.ndarray, room: int) -> tuple[int, ...]:
    """Two free lengths with the largest sum up to ``room``; empty if there are none."""
    have = lengths[(free[lengths] > 0) & (lengths < room)]
    if not len(have):
        return ()
    at = np.searchsorted(have, np.minimum(room - have, have), side="right") - 1
    # the partner is at most as long; a length paired with itself needs two free pieces
    same = (at >= 0) & (have[np.maximum(at, 0)] == have) & (free[have] < 2)
    at = np.where(same, at - 1, at)
    sums = np.where(at >= 0, have + have[np.maximum(at, 0)], 0)
    best = int(sums.argmax())
    return (int(have[best]), int(have[at[best]])) if sums[best] else ()


def layout_slots(layouts: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """The plan as arrays: which numbers of a length go to which layout, bins and offsets."""
    taken: dict[int, int] = {}
    rows, offsets, base = [], [], 0
    for layout, times in layouts:
        places = np.cumsum([0, *layout[:-1]])
        for n in sorted(set(layout)):
            own = [int(p) for p, m in zip(places, layout, strict=True) if m == n]
            start = taken.get(n, 0)
            rows.append((n, start, base, len(own), len(offsets)))
            offsets += own
            taken[n] = start + times * len(own)
        base += times
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return {**dict(zip(("length", "start", "base", "each", "at"), cols, strict=True)), "offsets": np.array(offsets, dtype=np.int64)}


def pack(parts: DataFrame, capacity: int = CAPACITY, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a stored table of pieces with a ``length``.

    Any columns may be there; they are kept. The pieces of a sequence fill it
    from 0 without gaps.
    """
    spark = parts.sparkSession
    counts = {r["length"]: r["count"] for r in parts.groupBy("length").count().collect()}
    slots = layout_slots(plan_layouts(counts, capacity))
    shared = spark.sparkContext.broadcast(slots)
    buckets = sum(counts.values()) // bucket_rows + 1
    rest = [c for c in parts.columns if c != "length"]
    bucket = F.pmod(F.xxhash64(F.lit("pack"), *[F.col(c) for c in rest]), F.lit(buckets)).cast("int")
    dealt = parts.withColumn("bucket_", bucket)
    sizes = dealt.groupBy("length", "bucket_").agg(F.count(F.lit(1)).alias("n_"))
    before = Window.partitionBy("length").orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sizes.withColumn("ahead_", F.coalesce(F.sum("n_").over(before), F.lit(0)))
              .select(F.col("length").alias("length_"), F.col("bucket_").alias("b_"), "ahead_"))
    inside = Window.partitionBy("length", "bucket_").orderBy(*rest)
    numbered = dealt.withColumn("i_", F.row_number().over(inside) - 1).join(
        starts, (F.col("length") == F.col("length_")) & (F.col("bucket_") == F.col("b_")))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        p = shared.value
        n, i = length.to_numpy(np.int64), number.to_numpy(np.int64)
        wide = np.int64(1) << 48
        at = np.searchsorted(p["length"] * wide + p["start"], n * wide + i, side="right") - 1
        k = i - p["start"][at]
        return pd.DataFrame({"sequence_id": p["base"][at] + k // p["each"][at],
                             "offset": p["offsets"][p["at"][at] + k % p["each"][at]]})

    done = numbered.withColumn("place_", place(F.col("length"), F.col("ahead_") + F.col("i_")))
    return done.select(*parts.columns, "place_.sequence_id", "place_.offset")


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and place: ``pieces``, stored, then ``pack``."""
    parts = stored(pieces(docs, tokenizer, id_col, text_col, capacity, end_id, with_ids), "pieces")
    return pack(parts, capacity)
