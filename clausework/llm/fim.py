"""Fill-in-the-middle: texts cut at line ends into prefix, middle and suffix, and put in another order.

The units are lines (with their line break). Two hashed numbers of the id say
after how many units the prefix and the middle end; the text is written as
prefix, suffix, middle or as suffix, prefix, middle, each part behind its
mark, or left as it is.

Memoised chunks. A text's lines are not listed. A rolling hash cuts it into
chunks at places that depend on the bytes around them alone, so what texts
share is mostly cut alike. A chunk's summary, its line breaks, its code points
and the places after its breaks, is kept per worker under the chunk's bytes (an
equal hash counts only if the bytes are equal). Running sums of the summaries
give the number of units and tell in which chunk a cut lies; the place within
it is in the summary. Chunk borders may split a character or a line: breaks
and code points add up over chunks in any case.

Defined cases: a null text is empty; an empty text, and one that holds a mark,
is left as it is (``plain``) and has its number of units all the same; a last
line without a break is a unit; a null id is hashed as an empty text; repeated
rows give equal rows; very long texts are hashed in slices; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import give_back, word_memory
from .suffix_dedup import gram_hashes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
RATE = 100            # per cent of the texts that are transformed
SPM_RATE = 50         # per cent of those that are written suffix first
GRAM = 16             # bytes that the rolling hash sees
BELOW = np.uint32(1 << 23)  # a chunk ends where the hash is below: every 512 bytes on average
LONGEST = 1 << 13     # bytes of a chunk at most
SLICE = 1 << 20       # bytes hashed at once
MEMORY = 16 << 20     # bytes of remembered chunks per worker


def chunk_ends(text: bytes) -> list[int]:
    """Where the chunks of a text end."""
    found = []
    for at in range(0, len(text) - GRAM + 1, SLICE):
        h = gram_hashes(np.frombuffer(text[at:at + SLICE + GRAM - 1], dtype=np.uint8), GRAM, np.uint32)
        found.append(np.flatnonzero(h < BELOW) + (at + GRAM))
    ends, last = [], 0
    for end in [*(np.concatenate(found).tolist() if found else []), len(text)]:
        while end - last > LONGEST:
            last += LONGEST
            ends.append(last)
        if end > last:
            ends.append(end)
            last = end
    return ends


def summary(chunk: bytes) -> tuple[int, int, np.ndarray]:
    """``(line breaks, code points, code points up to each break)`` of a chunk."""
    a = np.frombuffer(chunk, dtype=np.uint8)
    opens = (a & 0xC0) != 0x80
    breaks = np.flatnonzero(a == 10)
    return len(breaks), int(opens.sum()), np.cumsum(opens)[breaks] if len(breaks) else breaks


class Chunks:
    """Summaries under the bytes they belong to, up to a bound of bytes."""

    def __init__(self, memory: int = MEMORY):
        self.memory, self.held, self.known = memory, 0, {}

    def get(self, chunk: bytes) -> tuple[int, int, np.ndarray]:
        got = self.known.get(chunk)
        if got is None:
            if self.held + len(chunk) > self.memory:
                self.known, self.held = {}, 0
            got = self.known[chunk] = summary(chunk)
            self.held += len(chunk)
        return got


def cut_places(text: bytes, first: int, second: int, chunks: Chunks) -> tuple[int, int, int]:
    """``(units, a, b)``: the number of lines, and the code points before the two cuts that the numbers choose."""
    if not text:
        return 0, 0, 0
    start, parts = 0, []
    for end in chunk_ends(text):
        parts.append(chunks.get(text[start:end]))
        start = end
    breaks, points = np.cumsum([p[0] for p in parts]), np.cumsum([p[1] for p in parts])
    n = int(breaks[-1]) + (text[-1] != 10)

    def place(units: int) -> int:
        if units == 0:
            return 0
        if units > breaks[-1]:  # behind a last line without a break
            return int(points[-1])
        k = int(np.searchsorted(breaks, units))
        inside = units - (int(breaks[k - 1]) if k else 0)
        return (int(points[k - 1]) if k else 0) + int(parts[k][2][inside - 1])

    a, b = sorted((first % (n + 1), second % (n + 1)))
    return n, place(a), place(b)


def cuts(text: Column, first: Column, second: Column) -> Column:
    """``struct<n, a, b>`` of ``cut_places`` for text columns; null texts count as empty."""
    @F.arrow_udf("struct<n: long, a: long, b: long>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        chunks = word_memory("fim-chunks", Chunks)
        for texts, h1, h2 in batches:
            rows = [cut_places(t.as_buffer().to_pybytes() if t.is_valid else b"", x, y, chunks)
                    for t, x, y in zip(texts.cast(pa.binary()), h1.to_pylist(), h2.to_pylist(), strict=True)]
            n, a, b = (pa.array([r[i] for r in rows], pa.int64()) for i in range(3))
            yield pa.StructArray.from_arrays([n, a, b], names=["n", "a", "b"])
        give_back()

    return run(text, first, second)


def _number(digest: Column, which: int) -> Column:
    return F.conv(F.substring(digest, 8 * which + 1, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE,
                   spm_rate: int = SPM_RATE) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)``, one row per row of ``docs``.

    ``form`` is ``psm``, ``spm`` or ``plain``. The cuts and choices depend on
    the sha256 of ``seed:id`` alone, so a rerun writes the same.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), digest.alias("h"))
    rows = rows.select("doc_id", "text", "h", cuts(F.col("text"), _number(F.col("h"), 0), _number(F.col("h"), 1)).alias("c"))
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    plain = (F.length("text") == 0) | marked | (_number(F.col("h"), 2) % 100 >= rate)
    form = F.when(plain, F.lit("plain")).when(_number(F.col("h"), 3) % 100 < spm_rate, F.lit("spm")).otherwise(F.lit("psm"))
    rows = rows.select("doc_id", "text", F.col("c.n").alias("n"), F.col("c.a").cast("int").alias("a"), F.col("c.b").cast("int").alias("b"),
                       form.alias("form"))
    prefix, middle = F.substring("text", 1, F.col("a")), F.substring("text", F.col("a") + 1, F.col("b") - F.col("a"))
    suffix = F.substring("text", F.col("b") + 1, F.length("text"))
    output = (F.when(F.col("form") == "plain", F.col("text"))
              .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
              .otherwise(F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)))
    cut = F.col("form") != "plain"
    return rows.select("doc_id", "n", "form", F.when(cut, F.col("a").cast("long")).alias("prefix_chars"),
                       F.when(cut, (F.col("b") - F.col("a")).cast("long")).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text again, from what was written and its form."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "plain", output).when(form == "spm", F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))
            .otherwise(F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))))
