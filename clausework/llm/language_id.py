"""Language identification by unigrams over pieces, summed over all segmentations.

The pieces are those of a fixed public vocabulary; only their probabilities
are learned, one set per language, by expectation maximisation on labelled
text. The probability of a word in a language is the sum over every way to cut
it into pieces of the product of their probabilities (forward algorithm), and
that of a text the product over its words, since no piece crosses a blank. The
language with the highest probability wins; the score is its posterior under
equal priors.

Words are runs of letters in lower case. A letter that is no piece has a small
fixed probability in every language. The sums run over whole words, however
long (a sentence of a script without blanks is one): they are scaled on the way
and only the last ones, as many as a piece has letters, are held. Learning alone
reads words of over ``MAX_LETTERS`` letters in slices.

The model is fitted on a bounded sample, at most about ``max_docs`` labelled
documents per language, drawn by a hash of the id; prediction reads whole texts
and nothing else. Fitting: words are counted per language in Spark, and each
round computes expected piece counts in tasks and adds them up by piece; a
model has a row per piece and a column per language, whatever the data.

Defined cases: a null text or one without a letter is ``und`` with score 0, as is
every text if nothing could be learned; ties go to the smaller name; rows with
a null label are predicted but not learned from; a null id counts as an empty
one; repeated rows are predicted alike; an empty table gives an empty result;
other columns are never read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import give_back, stored, word_memory

UNKNOWN = "und"
# labelled documents per language that the model is fitted on, about
MAX_DOCS = 1000
ROUNDS = 3
# added to every expected count
SMOOTHING = 0.01
# probability of a letter that is no piece
STRAY = 1e-9
# letters of a word that words of its length are scored together for; longer words are scored letter by letter,
# and learned from in slices of as many letters
MAX_LETTERS = 31
# letters of long words that are scored together, padding included
LONG_LETTERS = 1 << 18
# letters after which the forward sums of long words are scaled anew
SCALE_EVERY = 16
# words a worker remembers before it starts anew
REMEMBERED = 100_000
# letters that are scored before their batch's next texts are read
CHUNK = 1 << 19

# fixed value: the mark that begins a word in the vocabulary
WORD_MARK = "▁"
_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """The words of a text; none if it has no letter (the pattern also finds numerals such as superscripts)."""
    found = _LETTERS.findall(text.lower())
    return found if any(map(str.isalpha, found)) or any(c.isalpha() for w in found for c in w) else []


def letter_pieces(path: str) -> list[str]:
    """The vocabulary's pieces of letters, in lower case, each once, in the order of the file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    all_ = (sp.id_to_piece(i).lower() for i in range(sp.get_piece_size()))
    return list(dict.fromkeys(p for p in all_ if p.lstrip(WORD_MARK).isalpha() and p.rfind(WORD_MARK) <= 0))


def trie_arrays(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The pieces as a prefix tree: sorted keys (node, letter), the nodes they lead to, each node's piece, the number of pieces."""
    step: dict[tuple[int, int], int] = {}
    final = [-1]
    for n, p in enumerate(pieces):
        node = 0
        for c in map(ord, p):
            nxt = step.get((node, c))
            if nxt is None:
                nxt = step[node, c] = len(final)
                final.append(-1)
            node = nxt
        final[node] = n
    keys = np.array([(a << 21) | c for a, c in step], dtype=np.int64)
    order = np.argsort(keys)
    return keys[order], np.array(list(step.values()), dtype=np.int64)[order], np.array(final, dtype=np.int64), len(pieces)


class Trie:
    """A prefix tree that many words can walk at once."""

    def __init__(self, keys: np.ndarray, to: np.ndarray, final: np.ndarray, size: int):
        self.keys, self.to, self.final, self.size, self._depth = keys, to, final, size, None

    def walk(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The next nodes; -1 where there is none."""
        key = (node << 21) | letter
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], -1)

    def depth(self) -> int:
        """The letters of the longest piece."""
        if self._depth is None:
            level = np.zeros(len(self.final), dtype=np.int64)
            parent = self.keys >> 21
            for _ in range(len(self.final)):
                deeper = level[parent] + 1
                if (level[self.to] == deeper).all():
                    break
                level[self.to] = deeper
            self._depth = max(1, int(level.max()))
        return self._depth

    def spans(self, letters: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``(from, to, words, pieces)`` of all pieces in words of one length, by start.

        A letter that is no piece is the piece number ``size``.
        """
        n, length = letters.shape
        for i in range(length):
            live, node = np.arange(n), np.zeros(n, dtype=np.int64)
            for j in range(i, length):
                node = self.walk(node, letters[live, j])
                on = node >= 0
                if j == i:
                    piece = np.where(on, self.final[np.maximum(node, 0)], -1)
                    yield i, j + 1, live, np.where(piece >= 0, piece, self.size)
                    live, node = live[on], node[on]
                else:
                    live, node = live[on], node[on]
                    piece = self.final[node]
                    hit = piece >= 0
                    if hit.any():
                        yield i, j + 1, live[hit], piece[hit]
                if not len(live):
                    break


def _by_length(words: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slices of the words as code-point arrays: ``(word numbers, letters)``, one length at a time."""
    groups: dict[int, tuple[list[int], list[str]]] = {}
    for n, w in enumerate(words):
        if w is None:
            continue
        marked = WORD_MARK + w
        for at in range(0, len(marked), MAX_LETTERS + 1):
            s = marked[at:at + MAX_LETTERS + 1]
            g = groups.setdefault(len(s), ([], []))
            g[0].append(n)
            g[1].append(s)
    for length, (numbers, slices) in groups.items():
        yield np.array(numbers), np.array(slices, dtype=f"U{length}").view(np.uint32).reshape(-1, length).astype(np.int64)


def _long_words(trie: Trie, probs: np.ndarray, words: list[str]) -> np.ndarray:
    """``log_likelihoods`` of words of any length: scaled sums in a ring of the last places."""
    out = np.zeros((len(words), probs.shape[1]))
    order = sorted(range(len(words)), key=lambda n: len(words[n]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * (len(words[order[end]]) + 1) <= LONG_LETTERS:
            end += 1
        numbers = order[at:end]
        marked = [WORD_MARK + words[n] for n in numbers]
        lengths, longest = np.array([len(w) for w in marked]), len(marked[-1])
        # behind a word's end stands what no piece has
        letters = np.full((len(marked), longest), (1 << 21) - 1, dtype=np.int64)
        for row, w in zip(letters, marked, strict=True):
            row[:len(w)] = np.frombuffer(w.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ring = trie.depth() + 1
        alpha, log = np.zeros((ring, len(marked), probs.shape[1])), np.zeros((len(marked), probs.shape[1]))
        alpha[0] = 1.0
        here = 0
        for i, j, who, piece in trie.spans(letters):
            if i != here:  # what led to the place before is used up
                alpha[here % ring] = 0.0
                here = i
                done = np.flatnonzero(lengths == i)
                out[[numbers[d] for d in done]] = np.log(alpha[i % ring, done]) + log[done]
                if i % SCALE_EVERY == 0:
                    scale = alpha[i % ring].copy()
                    alpha /= scale
                    log += np.log(scale)
            alpha[j % ring, who] += alpha[i % ring, who] * probs[piece]
        done = np.flatnonzero(lengths == longest)
        out[[numbers[d] for d in done]] = np.log(alpha[longest % ring, done]) + log[done]
        at = end
    return out


def log_likelihoods(trie: Trie, probs: np.ndarray, words: list[str]) -> np.ndarray:
    """The log probability of each word in each language: all segmentations, by the forward algorithm."""
    out = np.zeros((len(words), probs.shape[1]))
    long = [n for n, w in enumerate(words) if len(w) > MAX_LETTERS]
    if long:
        out[long] = _long_words(trie, probs, [words[n] for n in long])
        words = [w if len(w) <= MAX_LETTERS else None for w in words]
    for numbers, letters in _by_length(words):
        n, length = letters.shape
        alpha = np.zeros((length + 1, n, probs.shape[1]))
        alpha[0] = 1.0
        for i, j, who, piece in trie.spans(letters):
            alpha[j, who] += alpha[i, who] * probs[piece]
        np.add.at(out, numbers, np.log(alpha[length]))
    return out


def expected_counts(trie: Trie, probs: np.ndarray, words: list[str], weights: np.ndarray) -> np.ndarray:
    """Expected uses of each piece per language, words weighted by their counts in it (forward-backward)."""
    out = np.zeros_like(probs)
    for numbers, letters in _by_length(words):
        n, length = letters.shape
        k = probs.shape[1]
        spans = list(trie.spans(letters))
        alpha, beta = np.zeros((length + 1, n, k)), np.zeros((length + 1, n, k))
        alpha[0] = beta[length] = 1.0
        for i, j, who, piece in spans:
            alpha[j, who] += alpha[i, who] * probs[piece]
        for i, j, who, piece in reversed(spans):
            beta[i, who] += beta[j, who] * probs[piece]
        share = weights[numbers] / alpha[length]
        pieces = np.concatenate([s[3] for s in spans])
        uses = np.concatenate([alpha[i, who] * probs[piece] * beta[j, who] * share[who] for i, j, who, piece in spans])
        for lang in range(k):
            out[:, lang] += np.bincount(pieces, weights=uses[:, lang], minlength=len(probs))
    return out


class Model:
    """Languages, their piece probabilities and the pieces."""

    def __init__(self, languages: list[str], pieces: list[str], probs: np.ndarray):
        self.languages, self.pieces, self.probs = languages, pieces, probs


def held_out(id_col: str) -> F.Column:
    """Whether a document is kept from learning: CRC-32 of its id's text, modulo 3, is 1."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 3 == 1


def fit(docs: DataFrame, vocabulary: str, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        max_docs: int = MAX_DOCS, rounds: int = ROUNDS) -> Model:
    """A model learned from the labelled rows of ``docs`` (leave held-out rows out before)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(id_col).alias("id")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    # one row per language
    found = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages, pieces = sorted(found), letter_pieces(vocabulary)
    flat = np.full((len(pieces) + 1, max(1, len(languages))), 1.0 / len(pieces))
    flat[-1] = STRAY
    if not languages:
        return Model(languages, pieces, flat)
    parts = 1 << 20
    limit = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(parts, parts * max_docs // found[lang] + 1))])
    sample = rows.where(F.pmod(F.xxhash64(F.lit("fit"), F.col("id")), F.lit(parts)) < F.element_at(limit, F.col("lang")))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            counts = {lang: Counter() for lang in b["lang"].unique()}
            for lang, text in zip(b["lang"], b["text"], strict=True):
                counts[lang].update(words_of(text))
            yield pd.DataFrame([(lang, w, n) for lang, c in counts.items() for w, n in c.items()], columns=["lang", "word", "n"])

    words = stored(sample.select("lang", "text").mapInPandas(count, "lang string, word string, n long")
                   .groupBy("word", "lang").agg(F.sum("n").alias("n")), "language-words")
    # plain arrays travel, so that workers need no import of this module
    trie, probs, number = trie_arrays(pieces), flat, {lang: i for i, lang in enumerate(languages)}
    for _ in range(rounds):
        state = spark.sparkContext.broadcast((trie, probs))

        def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            arrays, p = state.value
            t = Trie(*arrays)
            total = np.zeros_like(p)
            for b in batches:
                names, at = np.unique(b["word"].to_numpy(dtype=object).astype(str), return_inverse=True)
                weights = np.zeros((len(names), p.shape[1]))
                np.add.at(weights, (at, b["lang"].map(number).to_numpy(dtype=np.int64)), b["n"].to_numpy(dtype=np.float64))
                total += expected_counts(t, p, names.tolist(), weights)
            piece, lang = np.nonzero(total[:-1])
            yield pd.DataFrame({"piece": piece, "lang": lang, "uses": total[piece, lang]})

        # at most a row per piece and language comes back
        got = (words.mapInPandas(expect, "piece long, lang long, uses double")
               .groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toPandas())
        uses = np.zeros_like(probs)
        uses[got["piece"].to_numpy(np.int64), got["lang"].to_numpy(np.int64)] = got["uses"].to_numpy()
        uses[:-1] += SMOOTHING
        probs = uses / uses.sum(axis=0)
        probs[-1] = STRAY
        state.unpersist()
    return Model(languages, pieces, probs)


def predict(text: F.Column, model: Model, spark) -> F.Column:
    """``struct<lang_pred string, score double>`` of a text column."""
    shared = spark.sparkContext.broadcast((trie_arrays(model.pieces), model.languages, model.probs))

    @F.arrow_udf("lang_pred string, score double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        arrays, languages, probs = shared.value
        trie, k = Trie(*arrays), len(languages)
        word_memory("language", dict)
        known: dict[str, int] = {}
        table = np.zeros((0, max(1, k)))

        def scores(lists: list[list[str]]) -> np.ndarray:
            nonlocal table
            new = set().union(*lists).difference(known)
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                table = table[:0]
                new = set().union(*lists)
            if new:
                ordered = sorted(new)
                known.update(zip(ordered, range(len(table), len(table) + len(ordered)), strict=True))
                parts = [log_likelihoods(trie, probs, ordered[a:a + 10_000]) for a in range(0, len(ordered), 10_000)]
                table = np.concatenate([table, *parts])
            out = np.zeros((len(lists), table.shape[1]))
            for n, words in enumerate(lists):
                out[n] = table[np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))].sum(axis=0)
            return out

        for texts in batches:
            names, best, at = [], [], 0
            while at < len(texts):
                lists, size = [], 0
                while at < len(texts) and size < CHUNK:  # few texts at a time leave Arrow's buffer
                    t = texts[at].as_py() or ""
                    lists.append(words_of(t) if k else [])
                    size += len(t)
                    at += 1
                ll = scores(lists)
                top = ll.argmax(axis=1)
                share = 1.0 / np.exp(ll - ll.max(axis=1, keepdims=True)).sum(axis=1)
                names += [languages[i] if words else UNKNOWN for i, words in zip(top, lists, strict=True)]
                best += [float(s) if words else 0.0 for s, words in zip(share, lists, strict=True)]
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(best, pa.float64())], ["lang_pred", "score"])
        give_back()

    return run(text)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (replacing columns of these names)."""
    rows = docs.select(F.struct("*").alias("row"), predict(F.col(text_col), model, docs.sparkSession).alias("found"))
    keep = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    return rows.select(*keep, "found.lang_pred", "found.score")


def accepted(docs: DataFrame, model: Model, min_score: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is told with at least ``min_score``, columns kept."""
    rows = docs.select(F.struct("*").alias("row"), predict(F.col(text_col), model, docs.sparkSession).alias("found"))
    return rows.where((F.col("found.lang_pred") != UNKNOWN) & (F.col("found.score") >= min_score)).select("row.*")
