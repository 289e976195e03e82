"""Shared byte strings: transforms against sorting, whole results against brute force, defined cases."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clausework.llm import queries as Q
from clausework.llm import suffix_dedup as S


def brute(rows, length):
    """``(id, spans, kept)`` per row by a dictionary of all strings of that length."""
    first = {}
    data = [(S.NO_ID if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for k in range(len(b) - length + 1):
            s = b[k:k + length]
            first[s] = min(first.get(s, i), i)
    out = []
    for (i, b), (own, _) in zip(data, rows):
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k:k + length]] < i:
                gone[k:k + length] = b"\1" * length
        spans, k = [], 0
        while k < len(b):
            if gone[k]:
                e = k
                while e < len(b) and gone[e]:
                    e += 1
                spans.append((k, e))
                k = e
            else:
                k += 1
        out.append((own, spans, bytes(c for c, g in zip(b, gone) if not g)))
    return out


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.without_repeats(df, **options).collect()
    return [(r.doc_id, list(zip(r.starts, r.ends)), bytes(r.kept)) for r in got]


def same(a, b):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    return sorted(a, key=key) == sorted(b, key=key)


@pytest.mark.parametrize("length", [1, 2, 3, 7, 8, 24, 50])
def test_gram_hashes_depend_on_the_gram_alone(length):
    text = np.frombuffer(bytes(random.Random(1).choices(b"ab", k=300)), dtype=np.uint8)
    h, seen = S.gram_hashes(text, length), {}
    assert len(h) == 300 - length + 1
    for i, x in enumerate(h.tolist()):
        assert seen.setdefault(text[i:i + length].tobytes(), x) == x
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("length", [2, 5, 12, 50])
def test_equal_windows_have_one_name(length):
    rnd = random.Random(length)
    for text in (bytes(rnd.choices(b"ab", k=900)), b"a" * 500, b"abc" * 200, bytes(rnd.choices(b"abcdefgh ", k=5000)) * 2, b"a" * (length - 1)):
        names, starts, ends = S._text_runs(text, length)
        seen = {}
        assert [k for a, b in zip(starts, ends) for k in range(a, b)] == list(range(max(0, len(text) - length + 1)))
        assert not len(names) or (ends - starts).max() <= length - max(1, length // 3) + 1
        for name, a, b in zip(names.tolist(), starts, ends):
            assert all(seen.setdefault(text[k:k + length], name) == name for k in range(a, b))


def test_names_do_not_depend_on_slices(monkeypatch):
    text = bytes(random.Random(5).choices(b"abcdefgh ", k=6000)) * 2
    each = lambda: [n for n, a, b in zip(*S._text_runs(text, 50)) for _ in range(a, b)]
    whole = each()
    monkeypatch.setattr(S, "SLICE_BITS", 10)
    # the key's hash has more bits now, so names may differ, but not between places of the same bytes
    short = each()
    assert len(short) == len(whole) and short[:5000] == short[6000:11000] and whole[:5000] == whole[6000:11000]


@pytest.mark.parametrize("length", [2, 3, 12, 50])
def test_texts_hashed_together_have_the_names_they_have_alone(length):
    rnd = random.Random(length)
    texts = [bytes(rnd.choices(b"abc ", k=rnd.choice([0, 1, length - 1, length, length + 1, 300, 4000]))) for _ in range(60)] + [b"a" * 70_000]
    per_window = lambda runs: [(int(t), k, n) for names, of, starts, ends in runs
                               for n, t, a, b in zip(names.tolist(), of, starts, ends) for k in range(a, b)]
    alone = [(i, k, n) for i, t in enumerate(texts) for _, k, n in per_window(S.named_runs([t], length))]
    assert per_window(S.named_runs(texts, length)) == alone
    assert len(alone) == sum(max(0, len(t) - length + 1) for t in texts)


def test_packed_arrays_come_back():
    for kind in (np.uint8, np.int32, np.int64, np.uint64):
        for values in ([], [0], [1, 2, 200], list(range(255)) * 9):
            assert S._unpack(S._pack(np.array(values, dtype=kind)), kind).tolist() == values


@pytest.mark.parametrize("length", [2, 3, 5, 9])
def test_groups_equal_sorted_strings(length):
    rnd = random.Random(length)
    strings = [bytes(rnd.choices(b"ab\x00\xff", k=rnd.randint(length, 40))) for _ in range(60)] + [b"a" * 40, b"ab" * 20]
    lows = np.array([rnd.randint(0, 30) for _ in strings])
    want = {}
    for s, low in zip(strings, lows):
        for k in range(len(s) - length + 1):
            want[s[k:k + length]] = min(want.get(s[k:k + length], 99), low)
    got = S.smallest_ids(np.frombuffer(b"".join(strings), dtype=np.uint8), np.array([len(s) for s in strings]), lows, length)
    assert got.tolist() == [want[s[k:k + length]] for s in strings for k in range(len(s) - length + 1)]


def test_suffixes_are_in_order():
    rnd = random.Random(3)
    strings = [bytes(rnd.choices(b"ab", k=rnd.randint(1, 60))) for _ in range(40)]
    symbols = np.concatenate([np.append(np.frombuffer(s, dtype=np.uint8).astype(np.uint16) + 1, 0) for s in strings])
    ends = np.cumsum([len(s) + 1 for s in strings])
    left = np.concatenate([np.arange(len(s) + 1, 0, -1) for s in strings])
    tails = [(symbols[i:i + n].tolist(), i) for i, n in enumerate(left)]
    assert ends[-1] == len(symbols)
    assert S.suffix_order(symbols, left).tolist() == [i for _, i in sorted(tails)]


@pytest.mark.parametrize("options", [{}, {"crowd": 1}, {"crowd": 0, "block_bytes": 100}, {"block_bytes": 300, "bucket_bytes": 200, "chunk": 64}])
def test_equals_brute_force(spark, options):
    rnd = random.Random(8)
    pool = ["".join(rnd.choices("abc é", k=rnd.randint(5, 60))) for _ in range(12)]
    rows = [(rnd.randint(0, 25), "".join(rnd.choices(pool, k=rnd.randint(1, 5))) + str(k)) for k in range(60)]
    rows += [(None, rows[0][1]), (None, rows[1][1]), (3, None), (4, ""), (5, "x"), (6, "a" * 300), (7, "a" * 200 + "b"),
             (8, "ab" * 100), rows[5], rows[5], (-4, "\x00" * 40 + "z")]
    for length in (2, 12):
        assert same(found(spark, rows, min_length=length, **options), brute(rows, length))


def test_whole_table_equals_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in Q.QUERIES["op11_bounded_bwt_dedup"](spark, sf_small).collect()}
    want = {i: (len((t or "").encode()), sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept).hexdigest())
            for (i, spans, kept), (_, t) in zip(brute(rows, 50), rows)}
    assert got == want and any(v[1] for v in got.values())


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, block int")
    assert S.without_repeats(empty).count() == 0
    rows = [(1, "long enough a text, twice", 5, "x"), (2, "long enough a text, twice", 6, "y")]
    df = spark.createDataFrame(rows, "key long, body string, block int, row string")
    got = {r.doc_id: bytes(r.kept) for r in S.without_repeats(df, "key", "body", min_length=10).collect()}
    assert got == {1: rows[0][1].encode(), 2: b""}


def test_long_text(spark):
    text = "".join(random.Random(2).choices("abcdefgh \n", k=400_000))
    rows = [(2, text), (1, text[1000:1500]), (3, text[100_000:300_000])]
    assert same(found(spark, rows, block_bytes=1 << 16), brute(rows, 50))


def test_ids_are_kept_apart_from_columns_of_other_types(spark):
    df = spark.range(3).select(F.col("id").cast("int").alias("doc_id"), F.lit("the same words, every time, in every one of them").alias("text"))
    got = {r.doc_id: len(r.kept) for r in S.without_repeats(df, min_length=20).collect()}
    assert got == {0: 48, 1: 0, 2: 0}
