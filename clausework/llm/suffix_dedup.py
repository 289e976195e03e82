"""Byte strings that documents share, found on Burrows-Wheeler transforms up to a length bound.

A byte of a document goes if a string of ``min_length`` bytes that covers it
also starts in a document of a smaller id. Strings are judged on the input,
matches never cross documents, overlaps count.

Bounded expansion. On the transform of a set of strings the common prefixes of
neighbouring suffixes are derived by increasing value (``prefix_groups``): all
suffixes start as one interval per first symbol; a step extends every interval
backward by one symbol, so that two neighbours stay together if what follows
their first symbol lay in one interval before. Pairs that part are decided and
never looked at again; the expansion stops at ``min_length``. The intervals
that are left are the groups of equal strings of that length, whose smallest
document id decides what goes.

Dealing the work out. Of a window's grams the one of the smallest hash (the
first on ties) names the window, so equal windows have one name wherever they
stand, and neighbouring windows mostly share it: a run of windows of one name
is a segment. Names that only one document holds cannot repeat and are dropped
by exchanging hashes alone; the segments of the others, equal ones of a block
of documents once, go to the task of their name, where the transform is built
in bounded chunks. The hashes only deal; equality is decided on the bytes. A
name that very many blocks hold (``crowd``) is dealt out again: its windows go
one by one by the hash of their own bytes. Tasks answer with the runs that each
block's documents repeat. Blocks are kept in a bucketed table, so their texts
are written once and never shuffled.

Defined cases: a null text is empty; texts below ``min_length`` keep
everything; a null id counts as the largest one; rows of one id (or of none)
take nothing from each other; a very long text is in a block of its own and is
read whole; periodic texts have long runs, cut into segments of bounded length;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ._common import give_back, stored

MIN_LENGTH = 50
# text bytes of a block of documents, about
BLOCK_BYTES = 12 << 20
# text bytes for each task that compares names or segments
BUCKET_BYTES = 12 << 20
# files of a bucketed table at most, Spark's own limit
MOST_BUCKETS = 100_000
# symbols of one transform, about
CHUNK = 1 << 17
# names of a bucket are put into so many parts, the units of chunks
PARTS = 1 << 8
# blocks holding one name, beyond which its windows are dealt out one by one
CROWD = 4096
# bytes of a text hashed at once; the place in the slice stands in as many low bits of a key
SLICE_BITS = 17
# bytes of short texts that are hashed together
TOGETHER = 1 << 16
NO_ID = np.iinfo(np.int64).max
# odd factors of the hashes that deal windows out; they decide no result
BYTE, JOIN, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9


def gram_hashes(text: np.ndarray, length: int, kind: type = np.uint64) -> np.ndarray:
    """Hashes of all grams of ``length`` bytes in an unsigned type, by joining hashes of shorter grams."""
    bits = 8 * np.dtype(kind).itemsize
    byte, factor = kind(BYTE % (1 << bits)), JOIN % (1 << bits)
    shorter, size, out, have = text.astype(kind), 1, None, 0
    shorter += kind(1)
    shorter *= byte

    def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        both = left * kind(factor)
        both += right
        return both

    while size <= length:
        if length & size:  # grams of the lengths whose sum is asked for stand one after another
            out = shorter if out is None else joined(out[:len(shorter) - have], shorter[have:])
            have += size
        if size * 2 <= length:
            shorter = joined(shorter[:len(shorter) - size], shorter[size:])
        size, factor = size * 2, factor * factor % (1 << bits)
    return out


def _gram_length(min_length: int) -> int:
    return max(1, min_length // 3)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(29))) * np.uint64(MIX)
    return values ^ (values >> np.uint64(32))


def named_runs(texts: list[bytes], min_length: int = MIN_LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(names, text, starts, ends)``: runs of windows that share a name, by where in which text they start.

    Short texts are hashed together, and windows across two of them left out.
    """
    together = TOGETHER if min_length - _gram_length(min_length) + 1 < min_length else 0
    first = 0
    while first < len(texts):
        last, size = first + 1, len(texts[first])
        while last < len(texts) and size + len(texts[last]) <= together:
            size += len(texts[last])
            last += 1
        if last == first + 1:
            names, starts, ends = _text_runs(texts[first], min_length)
            yield names, np.full(len(names), first), starts, ends
        else:
            lengths = np.array([len(t) for t in texts[first:last]])
            begin = np.cumsum(lengths) - lengths
            names, starts, ends = _text_runs(b"".join(texts[first:last]), min_length)
            # a run is shorter than what lies between the windows of two texts
            of = np.searchsorted(begin, ends - 1, side="right") - 1
            starts, ends = np.maximum(starts, begin[of]), np.minimum(ends, begin[of] + lengths[of] - min_length + 1)
            ok = starts < ends
            of = of[ok]
            yield names[ok], of + first, starts[ok] - begin[of], ends[ok] - begin[of]
        first = last


def _text_runs(text: bytes, min_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(names, starts, ends)`` of one text."""
    gram = _gram_length(min_length)
    width = min_length - gram + 1
    places, firsts = [], []
    move = (1 << SLICE_BITS) - min_length
    whole = np.frombuffer(text, dtype=np.uint8)
    for at in range(0, len(text) - min_length + 1, move):
        low, reach = gram_hashes(whole[at:at + move + min_length - 1], gram, np.uint32), 1
        low &= np.uint32(0xFFFFFFFF << SLICE_BITS & 0xFFFFFFFF)
        low |= np.arange(len(low), dtype=np.uint32)
        # the smallest of ever longer stretches of grams
        while reach < width:
            more = min(reach, width - reach)
            low, reach = np.minimum(low[:-more], low[more:]), reach + more
        first = _runs(low)
        places.append((low[first] & np.uint32((1 << SLICE_BITS) - 1)).astype(np.int64) + at)
        firsts.append(first + at)
    if not places:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    place, start = np.concatenate(places), np.concatenate(firsts)
    names = _grams_named(text, place, gram)
    # places of equal grams in a row (periodic texts) are one run, cut to a bounded length
    new = _runs(names)
    names, start = names[new], start[new]
    end = np.append(start[1:], len(text) - min_length + 1)
    if (end - start).max() > width:
        times = -(-(end - start) // width)
        step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        names, start, last = np.repeat(names, times), np.repeat(start, times) + step * width, np.repeat(end, times)
        end = np.minimum(start + width, last)
    return names, start, end


def _grams_named(text: bytes, place: np.ndarray, gram: int) -> np.ndarray:
    """64-bit names of the grams at some places, read eight bytes at a time."""
    padded, names = text + bytes(8), np.zeros(len(place), dtype=np.uint64)
    words = np.ndarray((len(text) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    for at in range(0, gram, 8):
        word = words[place + at]
        if gram - at < 8:
            word &= np.uint64((1 << 8 * (gram - at)) - 1)
        names = _mixed(names * np.uint64(JOIN) + word + np.uint64(BYTE))
    return names


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    new = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return np.flatnonzero(new)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted ``known``."""
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _bucket(names: np.ndarray, buckets: int) -> np.ndarray:
    return (names % np.uint64(buckets)).astype(np.int64)


def _pack(values: np.ndarray) -> bytes:
    """An array as its length and compressed byte planes, in which the high bytes of small numbers vanish."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T if len(values) else np.zeros((1, 0), dtype=np.uint8)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, kind: type) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    raw = pa.decompress(data[8:], n * width, codec="zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(width, n).T).view(kind).reshape(n)


# --- the transform ------------------------------------------------------------

def _order(keys: np.ndarray) -> np.ndarray:
    """Positions in the order of their keys, equal ones as they stand."""
    bits = len(keys).bit_length()
    if int(keys.max()).bit_length() + bits > 64:
        return np.argsort(keys, kind="stable")
    # sorting keys with their places attached is much faster than an argsort
    packed = keys << np.uint64(bits)
    packed |= np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    packed &= np.uint64((1 << bits) - 1)
    return packed.view(np.int64)


def suffix_order(symbols: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order; each ends at its string's end mark, equal ones stay in text order.

    ``symbols`` are above 0 but for the end marks; ``left`` is the number of
    symbols to the end mark, itself included.
    """
    n = len(symbols)

    buffer, short = np.zeros(n, dtype=np.uint64), left.astype(np.uint8 if left.max(initial=0) < 256 else np.int64)

    def ahead(values: np.ndarray, by: int) -> np.ndarray:
        m = max(0, n - by)
        np.multiply(values[by:], short[:m] > by, out=buffer[:m])
        buffer[m:] = 0
        return buffer

    used = np.bincount(symbols, minlength=1) > 0
    used[0] = True
    code = (np.cumsum(used) - 1).astype(np.uint64)[symbols]
    bits = int(used.sum() - 1).bit_length() or 1
    known, longest = max(1, (64 - n.bit_length()) // bits), int(left.max(initial=0))
    key = code.copy()
    for by in range(1, known):
        key <<= np.uint64(bits)
        key |= ahead(code, by)
    while True:
        order = _order(key)
        if known >= longest:
            return order
        inside = key[order]
        new = np.ones(n, dtype=np.int32)
        new[1:] = inside[1:] != inside[:-1]
        rank = np.empty(n, dtype=np.uint64)
        rank[order] = np.cumsum(new, dtype=np.int32)
        key = rank << np.uint64(n.bit_length())
        key |= ahead(rank, known)
        known *= 2


def prefix_groups(transform: np.ndarray, min_length: int) -> np.ndarray:
    """For each row of a transform, whether a new group of equal prefixes of ``min_length`` symbols starts there.

    ``transform`` has the symbol before each suffix in suffix order, 0 at the
    start of a string. Its stable order by symbol tells for each suffix the row
    of the suffix without its first symbol.
    """
    behind = _order(transform.astype(np.uint64))
    first = transform[behind]
    starts = np.ones(len(first), dtype=np.int32)
    starts[1:] = (first[1:] != first[:-1]) | (first[1:] == 0)
    open_rows = np.flatnonzero(starts == 0)
    here, above = behind[open_rows], behind[open_rows - 1]
    # buffers that every step writes anew: fresh memory would cost more than the work
    interval, one, other = np.empty_like(starts), np.empty(len(here), dtype=np.int32), np.empty(len(here), dtype=np.int32)
    parted, left = np.empty(len(here), dtype=bool), min_length - 1
    while left:
        n = len(open_rows)
        if not n:
            break
        np.cumsum(starts, out=interval)
        np.take(interval, here, out=one[:n], mode="clip")
        np.take(interval, above, out=other[:n], mode="clip")
        apart = np.not_equal(one[:n], other[:n], out=parted[:n])
        starts[open_rows[apart]] = 1
        if np.count_nonzero(apart) * 8 > n:  # decided rows are left out, when there are some
            stay = ~apart
            open_rows, here, above = open_rows[stay], here[stay], above[stay]
        left -= 1
        if int((here - above).sum()) <= 2 * len(here):
            return _close_groups(starts.astype(bool), open_rows, here, above, left)
    return starts.astype(bool)


def _close_groups(starts: np.ndarray, open_rows: np.ndarray, here: np.ndarray, above: np.ndarray, steps: int) -> np.ndarray:
    """The remaining steps once the two rows behind nearly every open pair are neighbours: then the lower one's own mark tells.

    The other pairs look at the marks of all rows between.
    """
    near = np.flatnonzero(here - above == 1)
    far = np.flatnonzero(here - above > 1)
    span = (here - above)[far]
    between, heads = _ranges(above[far] + 1, span), np.cumsum(span) - span
    rows, behind, far_rows = open_rows[near], here[near], open_rows[far]
    mark, before = np.empty(len(rows), dtype=bool), np.count_nonzero(starts)
    for _ in range(steps):
        np.take(starts, behind, out=mark[:len(rows)], mode="clip")
        apart = np.logical_or.reduceat(starts[between], heads) if len(far) else None
        starts[rows[mark[:len(rows)]]] = True
        if len(far):
            starts[far_rows[apart]] = True
        now = np.count_nonzero(starts)
        if now == before:  # nothing parted, so nothing will
            break
        if (now - before) * 8 > len(rows):
            stay = ~starts[rows]
            rows, behind = rows[stay], behind[stay]
        before = now
    return starts


def smallest_ids(data: np.ndarray, lengths: np.ndarray, lows: np.ndarray, min_length: int) -> np.ndarray:
    """For each window of each string, in order, the smallest ``lows`` of all strings that hold it.

    ``data`` has the strings' bytes one after another; each has at least ``min_length``.
    """
    n = len(data) + len(lengths)
    ends = np.cumsum(lengths + 1)
    symbols = np.zeros(n, dtype=np.uint16)
    body = np.ones(n, dtype=bool)
    body[ends - 1] = False
    symbols[body] = data.astype(np.uint16) + np.uint16(1)
    own = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths + 1)
    left = ends[own] - np.arange(n)
    order = suffix_order(symbols, left)
    starts = prefix_groups(symbols[order - 1], min_length)
    heads = np.flatnonzero(starts)
    low = np.minimum.reduceat(lows[own[order]], heads)
    at = np.empty(n, dtype=np.int64)
    at[order] = np.repeat(low, np.diff(np.append(heads, n)))
    return at[left > min_length]


# --- blocks of documents --------------------------------------------------------

BASE = "block long, row long, doc_id long, text binary"


def blocks_of(docs: DataFrame, id_col: str, text_col: str, buckets: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(block, row, doc_id, text)``: documents in blocks of about ``block_bytes``, a row number each.

    Written below the shared folder as a table bucketed by block, so that what
    is said about a block comes to its documents and not the other way round.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, block, held = TaskContext.get().partitionId() << 33, 0, 0
        for b in batches:
            sizes = pc.binary_length(b["text"]).to_numpy(zero_copy_only=False)
            numbers = np.empty(len(b), dtype=np.int64)
            for i, size in enumerate(sizes.tolist()):
                if held and held + size > block_bytes:
                    block, held = block + 1, 0
                numbers[i] = block
                held += size
            yield pa.RecordBatch.from_arrays([pa.array(numbers + first), b["row"], b["doc_id"], b["text"]],
                                             names=["block", "row", "doc_id", "text"])
        give_back()

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit(b"")).alias("text"))
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "suffix-base")
    name = "suffix_base_" + path.rsplit("-", 1)[1]
    (rows.mapInArrow(run, BASE).write.format("parquet").option("path", path).option("compression", "zstd")
     .bucketBy(buckets, "block").saveAsTable(name))
    base = spark.table(name)
    base.schema
    spark.sql(f"DROP TABLE {name}")  # the name alone: the files are the frame's
    return base


def _texts(docs: pa.Table | pa.RecordBatch) -> Iterator[bytes]:
    """One text at a time leaves Arrow's buffer."""
    return (t.as_buffer().to_pybytes() for t in docs["text"])


def held_names(base: DataFrame, min_length: int, buckets: int) -> DataFrame:
    """``(bucket, block, once, more)``: each block's names, those of several of its documents in ``more``."""
    def rows_of(block: int, texts: list[bytes]) -> pa.RecordBatch | None:
        found = []
        for names, of, _, _ in named_runs(texts, min_length):
            order = np.lexsort((of, names))
            names, of = names[order], of[order]
            found.append(names[_runs(names) if (of == of[:1]).all() else np.flatnonzero(np.concatenate(
                [[True], (names[1:] != names[:-1]) | (of[1:] != of[:-1])]))])
        names, counts = np.unique(np.concatenate(found), return_counts=True)
        if not len(names):
            return None
        bucket = _bucket(names, buckets)
        order = np.argsort(bucket, kind="stable")
        names, counts, bucket = names[order], counts[order], bucket[order]
        cuts = np.append(_runs(bucket), len(bucket))
        parts = [(names[a:b], counts[a:b] > 1) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[cuts[:-1]]), pa.array(np.full(len(parts), block, dtype=np.int64)),
             pa.array([_sorted_pack(x[~m]) for x, m in parts], pa.binary()), pa.array([_sorted_pack(x[m]) for x, m in parts], pa.binary())],
            names=["bucket", "block", "once", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, texts, held = None, [], 0
        for b in batches:
            for own, text in zip(b["block"].to_pylist(), _texts(b), strict=True):
                if texts and (own != block or held > 2 * BLOCK_BYTES):
                    out = rows_of(block, texts)
                    if out is not None:
                        yield out
                    texts, held = [], 0
                block, held = own, held + len(text)
                texts.append(text)
        if texts:
            out = rows_of(block, texts)
            if out is not None:
                yield out
        give_back()

    return base.select("block", "text").mapInArrow(run, "bucket long, block long, once binary, more binary")


def _sorted_pack(names: np.ndarray) -> bytes:
    """Sorted names by their differences."""
    return _pack(np.diff(names, prepend=np.uint64(0)))


def _sorted_unpack(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.uint64), dtype=np.uint64)


def shared_names(held: DataFrame, crowd: int) -> DataFrame:
    """``(block, names, crowded)``: per block and bucket, the names that several documents hold, hot ones apart."""
    def run(t: pa.Table) -> pa.Table:
        once, more = ([_sorted_unpack(x) for x in t[c].to_pylist()] for c in ("once", "more"))
        names, at, counts = np.unique(np.concatenate(once + more), return_inverse=True, return_counts=True)
        several = counts > 1
        several[at[sum(map(len, once)):]] = True
        hot = counts > crowd
        places = np.split(at, np.cumsum([len(x) for x in once + more])[:-1])
        out = [], []
        for a, b in zip(places[:len(once)], places[len(once):], strict=True):
            own = np.sort(np.concatenate([a, b]))
            own = own[several[own]]
            out[0].append(_sorted_pack(names[own[~hot[own]]]))
            out[1].append(_sorted_pack(names[own[hot[own]]]))
        return pa.table({"block": t["block"], "names": pa.array(out[0], pa.binary()), "crowded": pa.array(out[1], pa.binary())})

    return held.groupBy("bucket").applyInArrow(run, "block long, names binary, crowded binary")


# per block and bucket: its different strings (bytes, lengths, parts, smallest ids of the block, how often they stand
# in it) and their places (document of the block by number, its id, byte)
STRINGS = {"data": np.uint8, "lengths": np.int32, "parts": np.uint8, "lows": np.int64, "times": np.int32,
           "rows": np.int32, "ids": np.int64, "starts": np.int32}


def segments(base: DataFrame, shared: DataFrame, min_length: int, buckets: int) -> DataFrame:
    """``(block, bucket, ...)`` with the packed arrays of ``STRINGS``: each block's segments of shared names.

    Windows of crowded names are segments of their own, dealt by their bytes.
    """
    import xxhash

    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), *[(n, pa.binary()) for n in STRINGS]])

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows or not answers.num_rows:
            return schema.empty_table()
        block, docs = docs["block"][0].as_py(), docs.sort_by("row")
        known, crowded = (np.unique(np.concatenate([_sorted_unpack(x) for x in answers[c].to_pylist()])) for c in ("names", "crowded"))
        del answers
        index: dict[bytes, int] = {}
        named, own, rows, starts = [], [], [], []
        texts = list(_texts(docs))
        doc_ids = np.array([NO_ID if i is None else i for i in docs["doc_id"].to_pylist()], dtype=np.int64)
        for names, of, start, end in named_runs(texts, min_length):
            hot = _among(names, crowded)
            some = np.flatnonzero(hot | _among(names, known))
            for name, row, a, b, one_by_one in zip(*(x[some].tolist() for x in (names, of, start, end, hot)), strict=True):
                text = texts[row]
                for c in range(a, b) if one_by_one else (a,):
                    data = text[c:(c + 1 if one_by_one else b) + min_length - 1]
                    n = index.setdefault(data, len(named))
                    if n == len(named):
                        named.append(xxhash.xxh64_intdigest(data) if one_by_one else name)
                    own.append(n)
                    rows.append(row)
                    starts.append(c)
        if not named:
            return schema.empty_table()
        data, named, own = list(index), np.array(named, dtype=np.uint64), np.array(own, dtype=np.int64)
        rows, starts = np.array(rows, dtype=np.int32), np.array(starts, dtype=np.int32)
        ids = doc_ids[rows]
        del index, texts
        # strings by bucket, places by string
        bucket = _bucket(named, buckets)
        order = np.lexsort((named, bucket))
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.arange(len(order))
        by = np.argsort(number[own], kind="stable")
        own, rows, ids, starts = number[own][by], rows[by], ids[by], starts[by]
        first = _runs(own)
        lows, times = np.minimum.reduceat(ids, first), np.diff(np.append(first, len(own)))
        parts = (named[order] // np.uint64(buckets) % np.uint64(PARTS)).astype(np.uint8)
        lengths = np.array([len(s) for s in data], dtype=np.int32)[order]
        cuts = np.append(_runs(bucket[order]), len(order))
        out = {f.name: [] for f in schema}
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            places = slice(first[a], first[b] if b < len(first) else len(own))
            strings = b"".join([data[i] for i in order[a:b].tolist()])
            out["block"].append(block)
            out["bucket"].append(int(bucket[order[a]]))
            for name, value in zip(STRINGS, (np.frombuffer(strings, dtype=np.uint8), lengths[a:b], parts[a:b], lows[a:b], times[a:b].astype(np.int32),
                                             rows[places], ids[places], starts[places]), strict=True):
                out[name].append(_pack(value))
        return pa.table(out, schema=schema)

    return base.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(run, ", ".join(f"{f.name} {'long' if i < 2 else 'binary'}" for i, f in enumerate(schema)))


def repeated_runs(found: DataFrame, min_length: int, chunk: int = CHUNK) -> DataFrame:
    """``(block, rows, starts, ends)``: runs of bytes that a document of a smaller id holds as well.

    Equal segments of the blocks are one string. The strings of a bucket are
    put into chunks by their parts, so equal windows meet in one transform.
    """
    def run(t: pa.Table) -> pa.Table:
        index: dict[bytes, int] = {}
        lows, parts, own, counts = [], [], [], []
        for row in zip(*(t[c].to_pylist() for c in ("data", "lengths", "parts", "lows")), strict=True):
            data, lengths, part, low = (_unpack(x, STRINGS[c]) for x, c in zip(row, ("data", "lengths", "parts", "lows"), strict=True))
            data, mine, start = data.tobytes(), np.empty(len(lengths), dtype=np.int64), 0
            for i, end in enumerate(np.cumsum(lengths).tolist()):
                n = mine[i] = index.setdefault(data[start:end], len(index))
                if n == len(parts):
                    parts.append(part[i])
                start = end
            own.append(mine)
            lows.append(low)
        strings, parts = list(index), np.array(parts, dtype=np.uint8)
        del index
        least = np.full(len(strings), NO_ID, dtype=np.int64)
        for mine, low in zip(own, lows, strict=True):
            np.minimum.at(least, mine, low)
        lengths = np.array([len(s) for s in strings], dtype=np.int64)
        counts = lengths - min_length + 1
        offsets = np.concatenate([[0], np.cumsum(counts)])
        windows = np.empty(offsets[-1], dtype=np.int64)
        order = np.argsort(parts, kind="stable")
        last = np.append(_runs(parts[order])[1:], len(order))
        sums, a = np.cumsum(lengths[order])[last - 1], 0
        while a < len(order):
            base = sums[np.searchsorted(last, a)] if a in last else 0
            # whole parts up to the chunk's size, one at least
            k = max(np.searchsorted(last, a, side="right"), np.searchsorted(sums, base + chunk, side="right") - 1)
            some = order[a:last[k]]
            got = smallest_ids(np.frombuffer(b"".join([strings[i] for i in some.tolist()]), dtype=np.uint8), lengths[some], least[some], min_length)
            windows[_ranges(offsets[some], counts[some])] = got
            a = int(last[k])
        out = []
        for mine, row in zip(own, zip(*(t[c].to_pylist() for c in ("times", "rows", "ids", "starts")), strict=True), strict=True):
            times, rows, ids, starts = (_unpack(x, STRINGS[c]) for x, c in zip(row, ("times", "rows", "ids", "starts"), strict=True))
            of = np.repeat(mine, times)
            n = counts[of]
            place = np.repeat(np.arange(len(of)), n)
            step = _ranges(np.zeros(len(of), dtype=np.int64), n)
            gone = windows[np.repeat(offsets[of], n) + step] < ids[place]
            before = np.concatenate([[False], gone[:-1] & (place[1:] == place[:-1])])
            after = np.concatenate([gone[1:] & (place[1:] == place[:-1]), [False]])
            begin, end = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after)
            out.append((rows[place[begin]], (starts[place[begin]] + step[begin]).astype(np.int32),
                        (starts[place[end]] + step[end] + min_length).astype(np.int32)))
        return pa.table({"block": t["block"], **{c: pa.array([_pack(o[i]) for o in out], pa.binary()) for i, c in enumerate(("rows", "starts", "ends"))}})

    return found.groupBy("bucket").applyInArrow(run, "block long, rows binary, starts binary, ends binary")


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers ``start .. start + count`` of each pair, one after another."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


RESULT = "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary"


def _removed(base: DataFrame, runs: DataFrame) -> DataFrame:
    """``RESULT`` of every document from the runs of its block."""
    many = pa.list_(pa.int64())
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("starts", many), ("ends", many), ("kept", pa.binary())])

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        docs = docs.sort_by("row")
        sizes = pc.binary_length(docs["text"]).to_numpy().astype(np.int64)
        # a byte between documents, so that runs of two never touch
        first = np.concatenate([[0], np.cumsum(sizes + 1)])
        rows, starts, ends = (np.concatenate([np.zeros(0, dtype=np.int32)] + [_unpack(x, np.int32) for x in found[c].to_pylist()]).astype(np.int64)
                              for c in ("rows", "starts", "ends"))
        begin, end = first[rows] + starts, first[rows] + ends
        order = np.argsort(begin, kind="stable")
        begin, end = begin[order], np.maximum.accumulate(end[order]) if len(order) else end
        new = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]])) if len(begin) else np.zeros(0, dtype=np.int64)
        begin, end = begin[new], end[np.append(new[1:], len(end)) - 1] if len(new) else end
        row = np.searchsorted(first, begin, side="right") - 1
        begin, end = begin - first[row], end - first[row]
        cuts = np.searchsorted(row, np.arange(len(sizes) + 1))
        kept = []
        for text, a, b in zip(_texts(docs), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            kept.append(text if a == b else b"".join(text[x:y] for x, y in zip([0, *end[a:b].tolist()], [*begin[a:b].tolist(), len(text)], strict=True)))
        lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x)) for x in (begin, end)]
        return pa.table([docs["doc_id"], pa.array(sizes), *lists, pa.array(kept, pa.binary())], schema=schema)

    return base.groupBy("block").cogroup(runs.groupBy("block")).applyInArrow(run, RESULT)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                    crowd: int = CROWD, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES, chunk: int = CHUNK) -> DataFrame:
    """``RESULT``, one row per row of ``docs``: the removed runs of bytes, and what is kept of the text.

    ``starts`` and ``ends`` are byte offsets of the maximal removed runs.
    """
    if min_length < 2:
        raise ValueError("strings have two bytes at least")
    total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    base = blocks_of(docs, id_col, text_col, min(MOST_BUCKETS, int(total // block_bytes) + 1), block_bytes)
    buckets = int(total // bucket_bytes) + 1
    shared = stored(shared_names(held_names(base, min_length, buckets), crowd), "suffix-names")
    runs = stored(repeated_runs(segments(base, shared, min_length, buckets), min_length, chunk), "suffix-runs")
    return _removed(base, runs)
