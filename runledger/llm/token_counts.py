"""Token counts by byte-pair merging over a byte-level vocabulary.

A text is cut into pieces by the vocabulary's pattern and each piece is merged on its own: its
bytes form a linked list, a heap holds the adjacent pairs that can be merged by rank and
position, and the lowest is merged until none is left. The count is the number of bytes less
the number of merges; no token id is looked up or emitted.
"""

from __future__ import annotations

import heapq
import json
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import slices

# Pattern of the byte-level vocabulary: a fixed value. White space is the Unicode property,
# which leaves out U+001C to U+001F, unlike Python's own ``\\s``.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
ASCII_WORDS = regex.compile(r" ?[A-Za-z]+")
CACHE = 400_000


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary file: itself for
    printable Latin-1, otherwise the next free one from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class MergeCounter:
    """Counts tokens of texts by the merge ranks and special strings of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(merges)}
        self.symbol = byte_symbols()
        self.pattern = regex.compile(PATTERN)
        special = [t["content"] for t in spec.get("added_tokens", [])]
        special.sort(key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.cache: dict[str, int] = {}

    def piece(self, text: str) -> int:
        """Tokens of one piece: bytes minus merges. n bytes take O(n log n) time."""
        symbols = [self.symbol[b] for b in text.encode()]
        n = len(symbols)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        ranks = self.ranks
        heap = [
            (rank, i, symbols[i], symbols[i + 1])
            for i in range(n - 1)
            if (rank := ranks.get((symbols[i], symbols[i + 1]))) is not None
        ]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i] if symbols[i] is not None else n
            # An entry is stale if either side has been merged since it was pushed.
            if j >= n or symbols[i] != left or symbols[j] != right:
                continue
            symbols[i], symbols[j] = left + right, None
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (rank := ranks.get((symbols[i], symbols[k]))) is not None:
                    heapq.heappush(heap, (rank, i, symbols[i], symbols[k]))
            h = before[i]
            if h >= 0 and (rank := ranks.get((symbols[h], symbols[i]))) is not None:
                heapq.heappush(heap, (rank, h, symbols[h], symbols[i]))
        return n - merges

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings. Equal pieces are merged once; the memory
        of them is bounded."""
        total = 0
        cache = self.cache
        for piece, times in Counter(self.pattern.findall(text)).items():
            count = cache.get(piece)
            if count is None:
                if len(cache) >= CACHE:
                    cache.clear()
                count = self.piece(piece)
                if len(piece) <= 64:
                    cache[piece] = count
            total += count * times
        return total

    def count(self, text: str | None) -> int:
        """Tokens of a text; a special string inside it is one token, as the library's
        default has it. NULL counts as empty."""
        if not text:
            return 0
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self.plain(part) for part in parts)


@lru_cache(maxsize=4)
def counter(path: str) -> MergeCounter:
    """One counter per Python worker and file."""
    return MergeCounter(path)


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    limit: int,
    text: str = "text",
) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``
    tokens), which replace columns of these names. ``tokenizer`` is the path of a byte-level
    tokenizer file that every executor has. NULL and empty texts have no tokens; rows are
    independent, so repeated rows get equal counts and an empty table stays empty. Columns of
    any other name are kept as they are. No shuffle."""

    @F.arrow_udf("long")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = counter(tokenizer)
        for batch in batches:
            counts = [own.count(x) for piece in slices(batch) for x in piece.to_pylist()]
            yield pa.array(np.array(counts, np.int64))

    return (
        docs.withColumn("n_tokens", counted(F.col(text)))
        .withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
