"""Quality rules: repetition and length of a text, and bands of its perplexity by language.

The perplexity of a text comes from a modified Kneser-Ney model of the characters of all texts
(:mod:`runledger.llm.kneser_ney`). Texts that are far from their language's usual perplexity on
either side go: above it is noise, below it the same few words again and again. The bands
come from all texts that pass the plain rules. Their quartiles are read from counts of rounded
values, so they do not depend on how Spark deals the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from runledger.llm.common import _words, attach, slices, written
from runledger.llm import kneser_ney
from runledger.llm.kneser_ney import (
    Alphabet,
    Model,
    characters,
    count_grams,
    gathered,
    probabilities,
    row_grams,
    text_bytes,
)
from runledger.operators.skew import split_join

LEAST_WORDS = 50
MOST_REPEATED = 50  # of a hundred words
WINDOW = 3
SIGNS = "#*$%&|<>"
WIDTH = 4.0  # of a band beyond its quartiles, in distances of the quartiles
LEAST_SPREAD = 0.02  # bits of a word: the least distance of the quartiles
STEPS = 1000  # a bit is rounded to that many parts
PRIOR = 50  # a language counts with its own texts and that many usual ones

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RESULTS = [*COUNTS, "perplexity", "lower", "upper", "base_failed", "kept"]

SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
ONE_SPACE = np.where(SPACES, 0x20, np.arange(256)).astype(np.uint8)
IS_SIGN = np.isin(np.arange(256), list(SIGNS.encode()))


def _per_text(marked: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(marked)])
    return np.diff(upto[offsets])


def _numbered(*columns: np.ndarray) -> np.ndarray:
    """A number for each different row of columns of numbers from 0."""
    out = columns[0]
    for column in columns[1:]:
        _, out = np.unique(out, return_inverse=True)
        out = out.astype(np.int64) * (int(column.max(initial=0)) + 1) + column
    return np.unique(out, return_inverse=True)[1]


def repeated_words(bounds: np.ndarray, words: pa.Array) -> np.ndarray:
    """Words of each text in windows of ``WINDOW`` that the text has more than once."""
    lengths = np.diff(bounds)
    ids = np.asarray(words.dictionary_encode().indices).astype(np.int64)
    of = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.flatnonzero(np.arange(len(ids)) + WINDOW <= bounds[1:][of])
    same = _numbered(*(ids[starts + k] for k in range(WINDOW)), of[starts])
    often = starts[np.bincount(same, minlength=1)[same] > 1] if len(starts) else starts
    marked = np.zeros(len(ids), bool)
    for k in range(WINDOW):
        marked[often + k] = True
    return _per_text(marked, bounds)


def repeated_lines(texts: pa.Array) -> np.ndarray:
    """Lines of each text that have a word and are equal to an earlier one."""
    lists = pc.split_pattern(texts, "\n")
    lines, bounds = lists.flatten(), np.asarray(lists.offsets).astype(np.int64)
    bounds = bounds - bounds[0]
    of = np.repeat(np.arange(len(texts)), np.diff(bounds))
    worded = np.flatnonzero(np.asarray(pc.not_equal(pc.ascii_trim_whitespace(lines), "")))
    ids = np.asarray(lines.dictionary_encode().indices).astype(np.int64)
    same = _numbered(ids[worded], of[worded])
    first = np.unique(same, return_index=True)[1]
    total, different = (np.bincount(of[x], minlength=len(texts)) for x in (worded, worded[first]))
    return total - different


def counts(texts: pa.Array) -> list[np.ndarray]:
    """The columns of ``COUNTS``. NULL has no words."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets, raw = text_bytes(texts)
    inside = ~SPACES[raw]
    bounds, words = _words(texts, ONE_SPACE)
    return [
        np.diff(bounds),
        _per_text(inside & ((raw & 0xC0) != 0x80), offsets),
        _per_text(IS_SIGN[raw], offsets),
        repeated_lines(texts),
        repeated_words(bounds, words),
    ]


def _measure(model, keep: int):
    """Counts and bits by word of each text, without a ``model`` no bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for texts in slices(batch.column(keep)):
                offsets, raw = text_bytes(texts)
                plain = counts(texts)
                bits = np.zeros(len(texts)) if model is None else model.value.bits(offsets, raw)
                parts.append([*plain, bits / np.maximum(plain[0], 1)])
            found = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [[]] * 6
            kinds = [*[pa.int64()] * len(COUNTS), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:keep], *(pa.array(c, t) for c, t in zip(found, kinds, strict=True))],
                names=[*batch.schema.names[:keep], *COUNTS, "_bits"],
            )

    return run


def _looked_up(rows: DataFrame, counted: DataFrame, alphabet: Alphabet, schema: StructType) -> DataFrame:
    """The columns of ``rows`` but the text, counts and bits by word, for models that no task
    can hold: the n-grams of each text are joined with their probabilities."""
    rows = written(rows.select(F.monotonically_increasing_id().alias("_row"), "*"), "rows")
    worded = rows.where(F.col("_text") != "").select("_row", "_text")
    found = worded.mapInArrow(row_grams(alphabet.order, alphabet), "row long, gram long, n long")
    known = probabilities(counted, alphabet.order, alphabet)
    # Decimals add up to the same in any order.
    bits = (-F.col("n") * F.col("log_p")).cast("decimal(28,12)")
    found = split_join(found, known, ["gram"], ["row"]).groupBy("row").agg(F.sum(bits).alias("all"))
    found = written(found.select(F.col("row").alias("_row"), F.col("all").cast("double")), "bits")
    plain = rows.mapInArrow(_measure(None, len(rows.columns) - 1), StructType([
        rows.schema["_row"], *schema.fields]))
    plain = attach(plain, found, ["_row"], ["_bits"], "left")
    by_word = F.coalesce("all", F.lit(0.0)) / F.greatest("n_words", F.lit(1))
    return plain.withColumn("_bits", by_word).select(schema.names)


LANGUAGE = ["_no_lang", "_lang"]


def _quartiles(measured: DataFrame, by: list[str]) -> DataFrame:
    """Quartiles ``q1`` and ``q3`` of rounded bits and the number of texts ``n``, for each group."""
    step = F.round(F.col("_bits") * STEPS).cast("long").alias("step")
    binned = measured.groupBy(*by, step).agg(F.count("*").alias("n"))
    upto = Window.partitionBy(*by).orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    binned = binned.withColumns({"upto": F.sum("n").over(upto), "all": F.sum("n").over(whole)})

    def quartile(quarters: int) -> Column:
        # The first value that at least so many quarters of all texts do not exceed.
        return F.min(F.when(F.col("upto") * 4 >= F.col("all") * quarters, F.col("step"))) / STEPS

    return binned.groupBy(*by).agg(
        quartile(1).alias("q1"), quartile(3).alias("q3"), F.sum("n").alias("n")
    )


def bands(measured: DataFrame) -> DataFrame:
    """``lower`` and ``upper`` bits of a word for each language of measured texts. The fewer
    texts a language has, the more its quartiles are those of all texts."""
    usual = _quartiles(measured.withColumn("_all", F.lit(0)), ["_all"]).first()
    own = _quartiles(measured, LANGUAGE)
    if usual is None:
        return own.select(*LANGUAGE, F.col("q1").alias("lower"), F.col("q3").alias("upper"))
    q1, q3 = (
        (F.col("n") * F.col(q) + PRIOR * F.lit(usual[q])) / (F.col("n") + PRIOR) for q in ("q1", "q3")
    )
    reach = WIDTH * F.greatest(q3 - q1, F.lit(LEAST_SPREAD))
    return own.select(*LANGUAGE, (q1 - reach).alias("lower"), (q3 + reach).alias("upper"))


def quality_rules(
    docs: DataFrame, keep: Sequence[str] = ("doc_id",), text_col: str = "text",
    lang_col: str = "lang", model: Model | None = None,
) -> DataFrame:
    """The ``keep`` columns of each row and those of ``RESULTS``: counts of its whole text, its
    ``perplexity`` by word (NULL for an empty text), the band of its language (as
    perplexities), ``base_failed`` (fewer than ``LEAST_WORDS`` words, or more than
    ``MOST_REPEATED`` of a hundred words in repeated windows) and ``kept``: neither that nor
    outside the band.

    The ``model`` is learned from all texts unless given. NULL texts have no words; a NULL
    language is a language of its own, and one whose texts all fail the base has the band of
    nobody and keeps nothing. Repeated rows are judged alike. ``keep`` columns that are named
    like results are left out; other columns are not read. An empty table stays empty."""
    keep = [c for c in keep if c.lower() not in RESULTS]
    apart = {f"_keep{i}": c for i, c in enumerate(keep)}
    rows = docs.select(
        *(F.col(c).alias(k) for k, c in apart.items()), F.col(lang_col).isNull().alias("_no_lang"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("_lang"),
        F.col(text_col).alias("_text"),
    )
    fields = [f for f in rows.schema.fields if f.name != "_text"]
    schema = StructType([
        *fields, *(StructField(c, LongType()) for c in COUNTS), StructField("_bits", DoubleType())
    ])
    counted = None
    if model is None:
        alphabet = characters(rows, "_text")
        counted = written(count_grams(rows, "_text", alphabet.order, alphabet), "counted-grams")
        if counted.count() <= kneser_ney.MODEL_GRAMS:
            model = gathered(counted, alphabet.order, alphabet)
    if model is None:
        measured = _looked_up(rows, counted, alphabet, schema)
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)
        measured = rows.mapInArrow(_measure(shared, len(fields)), schema)
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    measured = written(measured.withColumn("base_failed", failed), "measured")
    found = attach(measured, written(bands(measured.where("NOT base_failed")), "bands"),
                   LANGUAGE, list(apart) or ["_bits"], "left")
    inside = F.col("_bits").between(F.col("lower"), F.col("upper"))
    empty = F.col("_bits") == 0
    return found.select(
        *(F.col(k).alias(c) for k, c in apart.items()), *COUNTS,
        F.when(~empty, F.pow(F.lit(2.0), "_bits")).alias("perplexity"),
        F.pow(F.lit(2.0), "lower").alias("lower"), F.pow(F.lit(2.0), "upper").alias("upper"),
        "base_failed", (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
    )
