"""Shared by the operators: tables in the shared folder, hash splits, batches of text."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runledger.operators.skew import fits_broadcast, hot_keys, split_join

# Set only where the cluster names no folder: a single machine, as in tests.
LOCAL_CHECKPOINTS = "/tmp/runledger-checkpoints"

SLICE_BYTES = 2 << 20
SAMPLE_PARTS = 256  # parts of a group of labelled rows that are ranked apart


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors share: ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{(folder or LOCAL_CHECKPOINTS).rstrip('/')}/runledger-{spark.sparkContext.applicationId}"


# Spark keeps shuffled rows until the driver collects its garbage, unless it is told not to.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, which cuts its lineage. A lost
    executor costs the tasks that were running on it, not the table. What was shuffled for it is
    gone afterwards."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANED)
    spark.conf.set(CLEANED, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANED, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete ``written`` tables that nothing will read again."""
    for table in tables:
        spark = table.sparkSession
        files = table.inputFiles()
        if files:
            folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of an id's text modulo ``folds``; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary") if isinstance(doc_id, str)
                   else doc_id.cast("string").cast("binary")) % folds


# A document is known by its id (NULL is an id of its own) and the hash of its text.
KEY = ["_none", "_d", "_k"]


def document_key(doc_id: Column | str, text_key: Column | str) -> list[Column]:
    """The columns of ``KEY``, none of which is ever NULL."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    text_key = F.col(text_key) if isinstance(text_key, str) else text_key
    return [
        doc_id.isNull().alias("_none"),
        F.coalesce(doc_id.cast("long"), F.lit(0).cast("long")).alias("_d"),
        text_key.alias("_k"),
    ]


def set_apart(docs: DataFrame, *known: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns that begin with "_", as names inside the operators do, but for
    the ``known`` ones renamed, and their former names by the new ones."""
    taken, back = {c.lower() for c in docs.columns}, {}
    for column in docs.columns:
        if column.startswith("_") and column not in known:
            name = f"own{column}"
            while name.lower() in taken:
                name = f"own_{name}"
            taken.add(name.lower())
            back[name] = column
    return docs.withColumnsRenamed({old: new for new, old in back.items()}), back


def attach(
    left: DataFrame, right: DataFrame, on: list[str], by: list[str], how: str, even: bool = False
) -> DataFrame:
    """Equi-join on columns without NULL: the right side is broadcast if measured small, else
    hot keys of the left one are split by the hash of its ``by`` columns. Without hot keys, of
    which there are few, no row is repeated. The rows of each key are counted for that, unless
    ``even`` says that no key of the left side can have very many."""
    if fits_broadcast(right):
        return left.join(F.broadcast(right), on, how)
    if even:
        return left.join(right, on, how)
    hot = written(hot_keys(left, on), "hot-keys")
    return split_join(left, right, on, by, how, hot=hot, split=not hot.isEmpty())


def without_repeats(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """``docs`` (with the columns of ``KEY``) with one row for each of the ``repeated`` keys.
    Only rows of such keys are compared."""
    if repeated.isEmpty():
        return docs
    once = attach(docs, repeated, KEY, KEY, "left_semi").dropDuplicates(KEY)
    return attach(docs, repeated, KEY, KEY, "left_anti").unionByName(once)


def sampled_texts(
    rows: DataFrame, id_col: str, text_col: str, keep: list[str],
    max_docs: int, max_bytes: int, per: str | None = None, marks: DataFrame | None = None,
) -> list[tuple]:
    """A bounded sample of labelled rows for a classifier: (text, *keep) of the first rows by
    the hash of their id, at most ``max_docs`` rows and ``max_bytes`` of text, for each value
    of ``per`` if given. Texts are whole; one that would exceed the bound is passed over. The
    same on every run. Rows without a text are left out, repeated rows count repeatedly.

    ``marks`` has the labels, by ``id_col``, where ``rows`` has not; ``keep`` and ``per`` are
    then columns of it. Rows are chosen by id, length and hash of the text; only the texts of
    the chosen ones are read out, each once however often it is there."""
    shape = {
        "_id": F.col(id_col), "_n": F.octet_length(text_col), "_x": F.xxhash64(text_col),
        "_h": F.xxhash64(F.col(id_col).cast("string"), F.lit(17)),
    }
    worded = rows.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    labels = {"_g": F.col(per) if per else F.lit(0), **{f"_k{i}": F.col(c) for i, c in enumerate(keep)}}
    named = [c.alias(n) for n, c in labels.items()]
    if marks is None:
        sized = worded.select(*named, *(c.alias(n) for n, c in shape.items()))
    else:
        sized = attach(
            worded.select(*(c.alias(n) for n, c in shape.items())),
            marks.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), *named),
            ["_id"], ["_x", "_n"], "inner",
        )
    # The first rows of each part of a group, then those of the group: no task gets a whole group.
    order_of = ["_h", "_id", "_n", "_x"]
    ranked = sized
    for part in ([F.pmod("_h", F.lit(SAMPLE_PARTS))], []):
        first = Window.partitionBy("_g", *part).orderBy(*order_of)
        ranked = ranked.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= max_docs)
    chosen, total = [], Counter()
    for row in sorted(ranked.collect(), key=lambda r: r["_r"]):
        if total[row["_g"]] + row["_n"] <= max_bytes:
            chosen.append(row)
            total[row["_g"]] += row["_n"]
    if not chosen:
        return []
    spark = rows.sparkSession
    # At most max_docs for each group.
    wanted = spark.createDataFrame(
        [(r["_id"], r["_n"], r["_x"]) for r in chosen], sized.select("_id", "_n", "_x").schema
    ).distinct()
    keys = ["_id", "_n", "_x"]
    found = worded.select(*(shape[k].alias(k) for k in keys), F.col(text_col).alias("_t"))
    found = found.join(F.broadcast(wanted), keys, "left_semi").dropDuplicates(keys).collect()
    texts = {(r["_id"], r["_n"], r["_x"]): r["_t"] for r in found}
    chosen.sort(key=lambda r: (r["_h"], str(r["_id"]), r["_n"], r["_x"]))
    return [
        (texts[r["_id"], r["_n"], r["_x"]], *(r[f"_k{i}"] for i in range(len(keep)))) for r in chosen
    ]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive pieces of an array of texts, of about ``limit`` bytes or a single text. They
    are copies: some string kernels of Arrow read views from the wrong place."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > limit:
            yield texts.take(pa.array(np.arange(start, i)))
            start, total = i, 0
        total += n
    if start < len(texts):
        yield texts.take(pa.array(np.arange(start, len(texts))))


def text_column(
    score: Callable[[pa.Array], list[np.ndarray]], texts: pa.Array, limit: int = SLICE_BYTES
) -> list[np.ndarray]:
    """``score`` over bounded pieces of ``texts``, its columns put together again."""
    parts = [score(piece) for piece in slices(texts, limit)]
    return [np.concatenate(columns) for columns in zip(*parts, strict=True)] if parts else []


def _byte_table(separators: Iterable[int]) -> np.ndarray:
    """Lower-cases A-Z and makes the given bytes spaces."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    table[list(separators)] = 0x20
    return table


WHITE_SPACE = _byte_table([0x20, *range(0x09, 0x0E)])
NOT_ALNUM = _byte_table(b for b in range(128) if not chr(b).isalnum())


def _words(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[
        texts.offset : texts.offset + len(texts) + 1
    ]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    plain = pa.LargeStringArray.from_buffers(
        len(texts),
        pa.py_buffer((offsets - offsets[0]).tobytes()),
        pa.py_buffer(table[raw[offsets[0] : offsets[-1]]].tobytes()),
    )
    lists = pc.ascii_split_whitespace(plain)
    words = lists.flatten()
    real = np.asarray(pc.not_equal(words, "")) if len(words) else np.zeros(0, bool)
    before = np.concatenate([[0], np.cumsum(real)])
    starts = np.asarray(lists.offsets).astype(np.int64)
    return before[starts], words.filter(pa.array(real))


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words of texts, A-Z lower-cased and cut at the six ASCII white-space characters, as
    (bounds, words): those of text i are ``words[bounds[i]:bounds[i + 1]]``. NULL has none."""
    return _words(texts, WHITE_SPACE)


def alnum_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Bounds and words of texts: runs of digits, letters (A-Z lower-cased) and non-ASCII."""
    return _words(texts, NOT_ALNUM)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads the bits of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


SHORT_WORD = 64


def hash_words(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words, equal words having equal hashes on every machine. Words of equal
    length are hashed together, eight bytes at a time; very long ones one by one."""
    words = words.cast(pa.large_string())
    out = np.zeros(len(words), np.uint64)
    if not len(words):
        return out
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)
    lengths = np.diff(offsets)
    order = np.argsort(lengths, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        n = int(lengths[group[0]])
        if n > SHORT_WORD:
            out[group] = [
                xxhash.xxh64_intdigest(data[offsets[i] : offsets[i + 1]].tobytes()) for i in group
            ]
            continue
        padded = np.zeros((len(group), -(-max(n, 1) // 8) * 8), np.uint8)
        padded[:, :n] = data[offsets[group][:, None] + np.arange(n)]
        h = np.full(len(group), n + 1, np.uint64)
        for block in padded.view(np.uint64).T:
            h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + block)
        out[group] = h
    return out
