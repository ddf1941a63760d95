"""Language identification by segmentation-marginalised unigrams.

A language is a probability for each piece of a fixed public vocabulary. The probability of a word is the sum,
over all ways to cut it into pieces, of the product of the pieces' probabilities; a forward algorithm adds
them up. A text's likelihood is the product over its words. Piece probabilities come from expected piece counts: each
training word is cut in all ways under a first distribution (pieces weighted by rank), and its
posterior piece counts are added to its language. Counting covers all training rows.

Words are runs of letters (Unicode category L) of the lower-cased text. Runs of more than ``RUN`` letters are cut into runs of
``RUN`` before they are cut into pieces. A letter that is no piece counts as the piece "unknown".

Defined results: text null or without a letter gives `und` and score 0; rows with null or empty lang or null text teach nothing;
without any training row every text is `und`. Ties go to the language that sorts first. Rows without doc_id count as held in (their
remainder is null) for training and are scored like others.
"""
from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import released
from .words import IS_LETTER, Words, hashed_words, parts

RUN = 32  # letters
LONGEST = 12  # letters of the longest piece that is used
SMOOTHING = 0.5
TOKENIZER = os.path.join("/opt/tokenizers", "piece_bpe_32k.model")
CACHE = 400_000  # different words that a task remembers
UNKNOWN = 1  # number of the piece "unknown"
TABLE_BITS = 20
_BASE, _ALL = 0x9E3779B97F4A7C15, (1 << 64) - 1

_LETTERS = regex.compile(r"\p{L}+").findall
_SPACE = "▁"


def read_pieces(path: str = TOKENIZER) -> list[str]:
    """Lower-case letter pieces of a sentencepiece vocabulary, in order of rank; the mark for a space is dropped."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found: dict[str, None] = {}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            piece = model.id_to_piece(i).lstrip(_SPACE).lower()
            if 0 < len(piece) <= LONGEST and _LETTERS(piece) == [piece]:
                found[piece] = None
    return list(found)


class Lattice:
    """All cuts of many words at once, by array arithmetic. Piece 0 is "no piece" with probability
    0, ``UNKNOWN`` covers one letter, the vocabulary follows."""

    def __init__(self, pieces: list[str]):
        self.size = len(pieces) + 2
        spots = np.zeros(1 << TABLE_BITS, dtype=np.int32)
        more = np.zeros(1 << TABLE_BITS, dtype=np.int32)
        self.keys = np.zeros(self.size, dtype=np.uint64)
        for i, piece in enumerate(pieces, start=2):
            h = 0
            for c in piece:
                h = (h * _BASE + ord(c) + 1) & _ALL
            self.keys[i] = h
            first, second = _spots(self.keys[i : i + 1])
            table, at = (spots, first[0]) if not spots[first[0]] else (more, second[0])
            if table[at]:
                raise ValueError("two pieces have the same places in both tables; raise TABLE_BITS")
            table[at] = i
        self.spots, self.more = spots, more

    def pieces(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """piece[start, letters - 1, word] and the words' lengths."""
        lengths = np.array([len(x) for x in words])
        width = int(lengths.max(initial=1))
        letters = np.zeros((len(words), width + LONGEST), dtype=np.uint64)
        inside = np.arange(width + LONGEST)[None, :] < lengths[:, None]
        letters[inside] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        letters, inside = np.ascontiguousarray(letters.T), np.ascontiguousarray(inside.T)
        found = np.zeros((width, LONGEST, len(words)), dtype=np.int32)
        h = np.zeros((width, len(words)), dtype=np.uint64)
        for k in range(min(LONGEST, width)):
            h = h * np.uint64(_BASE) + letters[k : k + width]
            first, second = _spots(h[: width - k])
            piece = self.spots[first]
            miss = self.keys[piece] != h[: width - k]
            piece[miss] = self.more[second[miss]]
            ok = (self.keys[piece] == h[: width - k]) & inside[k:width]
            found[: width - k, k] = np.where(ok, piece, 0)
        lone = (found[:, 0] == 0) & inside[:width]
        found[:, 0][lone] = UNKNOWN
        return found, lengths

    def blocks(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Words of about equal length together: (their places in ``words``, pieces, lengths)."""
        order = np.argsort(np.array([len(x) for x in words]), kind="stable")
        for lo in range(0, len(words), 2048):
            at = order[lo : lo + 2048]
            yield (at, *self.pieces([words[i] for i in at]))

    @staticmethod
    def forward(found: np.ndarray, probability: np.ndarray) -> np.ndarray:
        """alpha[place, word, language]: summed probability of all cuts up to a place."""
        width, longest, n = found.shape
        alpha = np.zeros((width + 1, n, probability.shape[1]))
        alpha[0] = 1.0
        used = found.any(axis=2)
        for end in range(1, width + 1):
            for k in range(1, min(longest, end) + 1):
                if used[end - k, k - 1]:
                    alpha[end] += alpha[end - k] * np.take(probability, found[end - k, k - 1], axis=0)
        return alpha

    def log_likelihood(self, words: list[str], probability: np.ndarray) -> np.ndarray:
        """[word, language]"""
        out = np.zeros((len(words), probability.shape[1]))
        for at, found, lengths in self.blocks(words):
            alpha = self.forward(found, probability)
            out[at] = np.log(np.maximum(alpha[lengths, np.arange(len(at))], 1e-300))
        return out

    def expected(self, words: list[str], times: np.ndarray, probability: np.ndarray) -> np.ndarray:
        """Expected piece counts [language, piece]; times: [word, language]; probability: [piece, 1]."""
        out = np.zeros((times.shape[1], self.size))
        flat = probability[:, 0]
        for at, found, lengths in self.blocks(words):
            width, longest, n = found.shape
            alpha = self.forward(found, probability)[:, :, 0]
            beta = np.zeros((width + longest + 1, n))
            beta[lengths, np.arange(n)] = 1.0
            p = flat[found]
            for start in range(width - 1, -1, -1):
                beta[start] += (p[start] * beta[start + 1 : start + 1 + longest]).sum(axis=0)
            s, k, w = np.nonzero(found)
            piece = found[s, k, w]
            share = alpha[s, w] * p[s, k, w] * beta[s + k + 1, w] / np.maximum(beta[0, w], 1e-300)
            for lang in np.flatnonzero(times[at].any(axis=0)):
                out[lang] += np.bincount(piece, weights=share * times[at[w], lang], minlength=self.size)
        return out


def _spots(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mixed = h * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - TABLE_BITS)).astype(np.int64), ((mixed >> np.uint64(10)) & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)


def runs(word: str) -> list[str]:
    """The runs of letters of a word that was cut at ASCII characters only."""
    if len(word) <= RUN and word.isalpha():
        return [word]
    return [w[i : i + RUN] for w in _LETTERS(word) for i in range(0, len(w), RUN)]


def _strings(found: Words, at: np.ndarray) -> list[str]:
    data = found.raw.tobytes()
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(found.spans[0][at].tolist(), found.spans[1][at].tolist(), strict=True)]


def _by_word(strings: list[str]) -> tuple[list[str], np.ndarray]:
    """All runs of the words, and which word each belongs to."""
    cut = [runs(x) for x in strings]
    return [r for c in cut for r in c], np.repeat(np.arange(len(cut)), [len(c) for c in cut])


def first_distribution(size: int) -> np.ndarray:
    """Pieces weighted by rank; a letter outside the vocabulary is less likely than any piece."""
    p = 1.0 / (np.arange(size) + 10.0)
    p[UNKNOWN] = p[-1] / 10
    p[0] = 0.0
    return (p / p.sum())[:, None]


@lru_cache(maxsize=2)
def _lattice(pieces: tuple[str, ...]) -> Lattice:
    return Lattice(list(pieces))


def _count_batches(pieces: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, start = _lattice(pieces), first_distribution(len(pieces) + 2)
        totals: dict[str, np.ndarray] = {}
        numbers: dict[str, int] = {}
        known, strings = np.zeros(0, np.uint64), np.zeros(0, object)
        times = np.zeros((0, 0))

        def flush() -> None:
            some, owner = _by_word(list(strings))
            if some:
                counts = lattice.expected(some, times[owner], start)
                for lang, i in numbers.items():
                    totals[lang] = totals.get(lang, 0) + counts[i]

        for batch in parts(batches):
            found = hashed_words(batch["text"], IS_LETTER)
            langs = batch["lang"].to_pylist()
            for lang in langs:
                numbers.setdefault(lang, len(numbers))
            if times.shape[1] < len(numbers):
                times = np.pad(times, ((0, 0), (0, len(numbers) - times.shape[1])))
            lang_of = np.repeat([numbers[x] for x in langs], np.diff(found.first)).astype(np.int64)
            unique, first, back = np.unique(found.hashes, return_index=True, return_inverse=True)
            counts = np.bincount(back * len(numbers) + lang_of, minlength=len(unique) * len(numbers)).reshape(len(unique), len(numbers))
            spot = np.searchsorted(known, unique)
            hit = np.zeros(len(unique), bool)
            inside = spot < len(known)
            hit[inside] = known[spot[inside]] == unique[inside]
            times[spot[hit]] += counts[hit]
            fresh = np.array([*_strings(found, first[~hit]), None], object)[:-1]
            known, strings = np.insert(known, spot[~hit], unique[~hit]), np.insert(strings, spot[~hit], fresh)
            times = np.insert(times, spot[~hit], counts[~hit], axis=0)
            if len(known) > CACHE:
                flush()
                known, strings, times = known[:0], strings[:0], times[:0]
        flush()
        for lang, counts in totals.items():
            used = np.flatnonzero(counts > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(counts[used])], names=["lang", "piece", "n"])
    return run


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def train(docs: DataFrame, tokenizer: str = TOKENIZER) -> tuple[tuple[str, ...], list[str], np.ndarray]:
    """(pieces, languages, probability[piece, language]) from rows with text and lang whose
    crc32(doc_id) mod 3 is not 1. Tasks send expected counts: at most languages x vocabulary numbers."""
    pieces = tuple(read_pieces(tokenizer))
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL AND lang <> ''").where(
        F.coalesce(remainder(F.col("doc_id")), F.lit(0)) != 1)
    counts = rows.select("lang", F.lower("text").alias("text")).mapInArrow(released(_count_batches(pieces)), "lang string, piece long, n double")
    got = counts.groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(got["lang"].unique())
    table = np.full((len(pieces) + 2, len(langs)), SMOOTHING)
    table[0] = 0.0
    np.add.at(table, (got["piece"].to_numpy(int), got["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(int)), got["n"].to_numpy(float))
    return pieces, langs, table / np.maximum(table.sum(axis=0), 1e-300)


class Scores:
    """Log-likelihoods of words by language; remembers those of the first ``CACHE`` different words."""

    def __init__(self, pieces: tuple[str, ...], probability: np.ndarray):
        self.lattice, self.probability = _lattice(pieces), probability
        self.known, self.rows = np.zeros(0, np.uint64), np.zeros((0, probability.shape[1] + 1))

    def _new(self, strings: list[str]) -> np.ndarray:
        """[word, language]; the last column counts runs of letters."""
        some, owner = _by_word(strings)
        out = np.zeros((len(strings), self.rows.shape[1]))
        if some:
            each = self.lattice.log_likelihood(some, self.probability)
            np.add.at(out, owner, np.column_stack([each, np.ones(len(some))]))
        return out

    def of_texts(self, col) -> np.ndarray:
        """[text, language]; the last column is 0 for texts without a letter."""
        found = hashed_words(col, IS_LETTER)
        unique, first, back = np.unique(found.hashes, return_index=True, return_inverse=True)
        spot = np.searchsorted(self.known, unique)
        hit = np.zeros(len(unique), bool)
        inside = spot < len(self.known)
        hit[inside] = self.known[spot[inside]] == unique[inside]
        rows = np.zeros((len(unique), self.rows.shape[1]))
        rows[hit] = self.rows[spot[hit]]
        rows[~hit] = self._new(_strings(found, first[~hit]))
        if len(self.known) + (~hit).sum() <= CACHE:
            self.known = np.insert(self.known, spot[~hit], unique[~hit])
            self.rows = np.insert(self.rows, spot[~hit], rows[~hit], axis=0)
        total = np.zeros((len(col), rows.shape[1]))
        some = np.flatnonzero(np.diff(found.first))
        if len(some):
            total[some] = np.add.reduceat(rows[back], found.first[some], axis=0)
        return total


def _score_batches(pieces: tuple[str, ...], langs: list[str], probability: np.ndarray, column: str = "text"):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(pieces, probability)
        for batch in parts(batches):
            total = scores.of_texts(batch[column])
            told = (total[:, -1] > 0) & bool(langs)
            total = total[:, :-1] if langs else np.zeros((len(told), 1))
            best = total.argmax(axis=1)
            top = total[np.arange(len(best)), best]
            sure = 1.0 / np.exp(np.minimum(total - top[:, None], 0)).sum(axis=1)
            pred = [langs[k] if ok else "und" for k, ok in zip(best.tolist(), told.tolist(), strict=True)]
            keep = [c for c in batch.schema.names if c != column]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in keep), pa.array(pred, pa.string()), pa.array(np.where(told, sure, 0.0))],
                names=[*keep, "lang_pred", "score"])
    return run


def identify(docs: DataFrame, model=None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score (posterior of lang_pred under equal priors)."""
    pieces, langs, probability = model or train(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"))
    scored = rows.mapInArrow(released(_score_batches(pieces, langs, probability)), "doc_id long, lang_pred string, score double")
    return scored.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def _keep_batches(pieces: tuple[str, ...], langs: list[str], probability: np.ndarray, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(pieces, probability)
        for batch in parts(batches):
            # str.lower and Spark's lower differ in a few letters at most; neither decides a text.
            total = scores.of_texts(pa.compute.utf8_lower(batch["text"]))
            told, total = total[:, -1] > 0, total[:, :-1]
            keep = told & (1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1) >= least) if langs else told & False
            yield batch.filter(pa.array(keep))
    return run


def identified(docs: DataFrame, least: float = 0.3, model=None) -> DataFrame:
    """The rows of ``docs`` whose language is told with a score of at least ``least``, with all their columns."""
    pieces, langs, probability = model or train(docs)
    return docs.mapInArrow(released(_keep_batches(pieces, langs, probability, least)), docs.schema)
