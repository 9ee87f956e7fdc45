"""Language identification by segmentation-marginalised unigrams.

Each language has probabilities over the pieces of a fixed public vocabulary. The probability
of a word is the sum over all ways to cut it into pieces, computed by a forward recursion; a
text scores the sum of its words' log probabilities. The piece probabilities are learned by
expectation-maximisation over the same segmentations, from a bounded sample of labelled texts.

Scoring needs no shuffle: the model (pieces x languages) goes to the executors, and every text
is scored whole. Equal words of a batch are scored once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import sampled_texts, set_apart, text_column

START = "▁"  # word start in the vocabulary: a fixed value
UNDETERMINED = "und"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SAMPLE_DOCS = 1500  # per language
SAMPLE_BYTES = 1 << 20  # per language
ROUNDS = 3
SLOTS = 1 << 19
AT_ONCE = 1 << 18  # letters that are scored together


def letter_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Bounds and words of texts: runs of letters, lower-cased. NULL has none."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    lists = pc.split_pattern_regex(pc.utf8_lower(texts), pattern=r"[^\p{L}]+")
    words = lists.flatten()
    real = np.asarray(pc.not_equal(words, "")) if len(words) else np.zeros(0, bool)
    before = np.concatenate([[0], np.cumsum(real)])
    offsets = np.asarray(lists.offsets).astype(np.int64)
    return before[offsets - offsets[0]], words.filter(pa.array(real))


def vocabulary_pieces(path: str) -> list[str]:
    """Pieces of a vocabulary file that can occur in lower-cased words."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        bare = piece.removeprefix(START)
        special = model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
        if not special and (not bare or (bare.isalpha() and bare == bare.lower())):
            pieces.append(piece)
    return pieces


def _hash(points: np.ndarray) -> np.ndarray:
    """Polynomial hash of the rows of a matrix of code points."""
    h = np.zeros(len(points), np.uint64)
    for i in range(points.shape[1]):
        h = _next(h, points[:, i])
    return h


def _next(h: np.ndarray, points: np.ndarray) -> np.ndarray:
    return (h ^ points.astype(np.uint64)) * MULTIPLIER ^ (h >> np.uint64(29))


def code_points(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words as code points: numbers of words of equal length, and a matrix with a row for
    each. Groups hold a bounded number of letters, or one word."""
    words = words.cast(pa.large_string())
    data = words.buffers()[2]
    text = data.to_pybytes().decode() if data and len(words) else ""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    lengths = np.asarray(pc.utf8_length(words)).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(lengths, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        if len(group):
            n = int(lengths[group[0]])
            step = max(1, AT_ONCE // max(1, n))
            for at in range(0, len(group), step):
                part = group[at : at + step]
                yield part, points[starts[part][:, None] + np.arange(n)]


def _points(words: list[str]) -> np.ndarray:
    """Code points of equally long words, one row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def _started(points: np.ndarray) -> np.ndarray:
    """The same words with the mark of a word's start before them."""
    return np.concatenate([np.full((len(points), 1), ord(START), np.uint32), points], 1)


@dataclass
class Pieces:
    """Finds the number of a piece from the hash of its code points, for arrays of them. The
    last number stands for a letter that is no piece, -1 for anything else."""

    pieces: list[str]
    longest: int = field(init=False)
    keys: np.ndarray = field(init=False)
    slots: np.ndarray = field(init=False)
    probes: int = field(init=False)

    def __post_init__(self):
        self.longest = max(map(len, self.pieces), default=1)
        self.keys = np.array([_hash(_points([p]))[0] for p in self.pieces], np.uint64)
        self.slots = np.full(SLOTS, -1, np.int32)
        self.probes = 1
        for i, key in enumerate(self.keys.tolist()):
            at, tries = key >> 45, 1
            while self.slots[at] >= 0:
                at, tries = (at + 1) % SLOTS, tries + 1
            self.slots[at] = i
            self.probes = max(self.probes, tries)

    @property
    def unknown(self) -> int:
        return len(self.pieces)

    def find(self, h: np.ndarray) -> np.ndarray:
        at = (h >> np.uint64(45)).astype(np.int64)
        out = np.full(len(h), -1, np.int32)
        rest = np.arange(len(h))
        for _ in range(self.probes):
            got = self.slots[at[rest]]
            hit = (got >= 0) & (self.keys[got] == h[rest])
            out[rest[hit]] = got[hit]
            rest = rest[(got >= 0) & ~hit]
            if not len(rest):
                break
            at[rest] = (at[rest] + 1) % SLOTS
        return out

    def edges(self, points: np.ndarray) -> list[list[np.ndarray]]:
        """For equally long words, given as code points: the piece from position i to
        i + n + 1, as ``edges[i][n]`` over the words."""
        out = []
        for i in range(points.shape[1]):
            h = np.zeros(len(points), np.uint64)
            row = []
            for n in range(min(self.longest, points.shape[1] - i)):
                h = _next(h, points[:, i + n])
                found = self.find(h)
                row.append(np.where(found < 0, self.unknown, found) if n == 0 else found)
            out.append(row)
        return out


    def starting(self, points: np.ndarray, start: int, end: int, longest: int) -> np.ndarray:
        """For equally long words: the piece of n + 1 letters from position ``start`` + i, as
        ``[n, word, i]``."""
        w, n = points.shape
        h = np.zeros((w, end - start), np.uint64)
        out = np.full((longest, w, end - start), -1, np.int32)
        for k in range(longest):
            upto = min(end, n - k) - start
            if upto <= 0:
                break
            h = _next(h[:, :upto], points[:, start + k : start + k + upto])
            found = self.find(h.reshape(-1)).reshape(w, upto)
            out[k, :, :upto] = np.where(found < 0, self.unknown, found) if k == 0 else found
        return out


@dataclass
class LanguageModel:
    """Piece probabilities: ``p[piece, language]``, with a row for unknown letters and a last
    row of zeros, so that the number -1 means impossible."""

    pieces: Pieces
    languages: list[str]
    p: np.ndarray

    def forward(self, edges: list[list[np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Log probability of words (summed over segmentations) and, by position, the scaled
        sums: they are divided by the current one at each step, so long words do not vanish."""
        n, w = len(edges), len(edges[0][0])
        log = np.zeros((w, len(self.languages)))
        window = [np.ones_like(log)]
        scales = []
        for t in range(1, n + 1):
            total = np.zeros_like(log)
            for back, alpha in enumerate(reversed(window)):
                total += alpha * self.p[edges[t - 1 - back][back]]
            log += np.log(total)
            scales.append(total)
            window = [a / total for a in window[-(self.pieces.longest - 1):]] + [np.ones_like(log)]
            window = window[-self.pieces.longest:]
        return log, scales

    def scores(self, points: np.ndarray) -> np.ndarray:
        """The log probabilities alone: sums are pushed ahead by the pieces that start at a
        letter, so a word of any length needs those of its last letters only."""
        w, n = points.shape
        ahead = np.zeros((min(self.pieces.longest, n) + 1, w, len(self.languages)))
        ahead[0] = 1
        log = np.zeros(ahead.shape[1:])
        step = max(1, AT_ONCE // max(1, w * len(ahead)))
        for at in range(0, n, step):
            found = self.pieces.starting(points, at, min(at + step, n), len(ahead) - 1)
            for i in range(found.shape[2]):
                log += np.log(ahead[0])
                ahead /= ahead[0].copy()
                ahead[:-1] = ahead[1:] + self.p[found[:, :, i]]
                ahead[-1] = 0
        return log + np.log(ahead[0])

    def expected(self, edges: list[list[np.ndarray]], counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece by language in words that occur ``counts`` times."""
        n, w = len(edges), len(edges[0][0])
        uses = np.zeros_like(self.p)
        _, scales = self.forward(edges)
        # With the forward sums scaled to 1 at each position, an edge weighs its probability
        # over the scales it spans, times the scaled backward sum behind it.
        beta = [np.ones((w, len(self.languages))) for _ in range(n + 1)]
        for t in range(n - 1, -1, -1):
            total, scale = np.zeros_like(beta[n]), np.ones_like(beta[n])
            for k, piece in enumerate(edges[t]):
                scale = scale * scales[t + k]
                share = self.p[piece] / scale * beta[t + k + 1]
                total += share
                np.add.at(uses, piece, share * counts)
            beta[t] = total
        return uses

    def word_scores(self, words: pa.Array) -> np.ndarray:
        """Log probability of each word by language."""
        out = np.zeros((len(words), len(self.languages)))
        for group, points in code_points(words):
            out[group] = self.scores(_started(points))
        return out

    def text_scores(self, texts: pa.Array) -> list[np.ndarray]:
        """Number of the best language (-1 without a letter) and its posterior."""
        bounds, words = letter_words(texts)
        encoded = words.dictionary_encode()
        by_word = self.word_scores(encoded.dictionary)
        total = np.zeros((len(texts), len(self.languages)))
        full = np.flatnonzero(np.diff(bounds))
        if len(full):
            index = np.asarray(encoded.indices)
            total[full] = np.add.reduceat(by_word[index], bounds[full], axis=0)
        best = total.argmax(1)
        score = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        empty = np.diff(bounds) == 0
        return [np.where(empty, -1, best), np.where(empty, 0.0, score)]


def train(samples: list[tuple[str, str]], pieces: list[str], rounds: int = ROUNDS) -> LanguageModel:
    """Piece probabilities from (text, language) pairs."""
    known = Pieces(pieces)
    languages = sorted({language for _, language in samples})
    number = {language: i for i, language in enumerate(languages)}
    bounds, words = letter_words(pa.array([text for text, _ in samples], pa.string()))
    encoded = words.dictionary_encode()
    of = np.repeat([number[language] for _, language in samples], np.diff(bounds)).astype(np.int64)
    counts = np.zeros((len(encoded.dictionary), max(1, len(languages))))
    np.add.at(counts, (np.asarray(encoded.indices), of), 1)
    # Start: pieces in proportion to the letters they cover; unknown letters are rare.
    size = len(known.pieces) + 2
    p = np.full((size, len(languages)), 1.0 / size)
    p[-2], p[-1] = 1e-7, 0.0
    model = LanguageModel(known, languages, p)
    for _ in range(rounds if languages else 0):
        uses = np.zeros_like(model.p)
        for group, points in code_points(encoded.dictionary):
            uses += model.expected(known.edges(_started(points)), counts[group])
        # A small share for every piece: words not seen in a language stay possible.
        uses[:-1] += 0.01
        uses[-1] = 0
        model = LanguageModel(known, languages, uses / uses.sum(0))
    return model


def learn(
    docs: DataFrame, learnable: Column, vocabulary: str, doc_id: str = "doc_id",
    text: str = "text", lang: str = "lang", max_docs: int = SAMPLE_DOCS, max_bytes: int = SAMPLE_BYTES,
) -> LanguageModel:
    """Model from the ``learnable`` rows with a language: a sample of at most ``max_docs``
    whole texts and ``max_bytes`` for each language, chosen by the hash of the id."""
    rows = docs.where(learnable & F.col(lang).isNotNull())
    samples = sampled_texts(rows, doc_id, text, [lang], max_docs, max_bytes, per=lang)
    return train(samples, vocabulary_pieces(vocabulary))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (posterior of that language among the learned
    ones, 0 to 1), which replace columns of these names. NULL texts and texts without a letter
    are ``und`` with score 0, as is every text if nothing was learned. Only the text is read;
    rows are independent, so repeated rows agree and an empty table stays empty. Other columns
    are kept, whatever their names."""
    docs, back = set_apart(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = "struct<best:int,score:double>"

    @F.arrow_udf(kind)
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for batch in batches:
            if not model.languages or not len(batch):
                best, score = np.full(len(batch), -1), np.zeros(len(batch))
            else:
                best, score = text_column(model.text_scores, batch)
            yield pa.StructArray.from_arrays(
                [pa.array(best.astype(np.int32)), pa.array(score)], names=["best", "score"]
            )

    names = F.array(*(F.lit(x) for x in model.languages)) if model.languages else None
    out = docs.withColumn("_scored", scored(F.col(text)))
    best = F.col("_scored.best")
    name = F.when(best >= 0, F.get(names, best)) if names is not None else F.lit(None).cast("string")
    return out.withColumns({
        "lang_pred": F.coalesce(name, F.lit(UNDETERMINED)), "score": F.col("_scored.score"),
    }).drop("_scored").withColumnsRenamed(back)
