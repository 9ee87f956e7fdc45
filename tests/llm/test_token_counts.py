import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from runledger.llm.token_counts import MergeCounter, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["the", " the", "a", "é", "中", "\U0001f600", " ", "  ", "\n", "\t", "\x1c", "\x85", "　",
          "'s", "'ll", "'S", "1", "²", "!", "--", "<|endoftext|>", "<|endof", "\x00", "́"]


@pytest.fixture(scope="module")
def both():
    return MergeCounter(PATH), Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=6)), max_size=15))
def test_count_equals_the_library(parts):
    counter, library = MergeCounterOnce.get(), TokenizerOnce.get()
    text = "".join(parts).encode("utf-8", "ignore").decode()
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


class _Once:
    def __init__(self, make):
        self.make, self.made = make, None

    def get(self):
        self.made = self.made or self.make()
        return self.made


MergeCounterOnce = _Once(lambda: MergeCounter(PATH))
TokenizerOnce = _Once(lambda: Tokenizer.from_file(PATH))


def test_a_long_piece(both):
    counter, library = both
    for text in ("ab" * 20_000, "x" * 5000 + " " * 5000, "Zqj" * 3000):
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_column(spark, make_docs, both):
    rows = [(1, "Hello there, world"), (2, None), (3, ""), (3, ""), (None, "é" * 700)]
    docs = make_docs(rows).withColumnRenamed("n", "n_tokens")
    found = token_counts(docs, PATH, 512)
    assert found.columns[:-2] == docs.columns
    library = both[1]
    expected = sorted(
        (str(i), len((t or "").encode()), n := len(library.encode(t or "").ids), n > 512)
        for i, t in rows
    )
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in found.collect())
    assert got == expected
    assert token_counts(docs.limit(0), PATH, 512).count() == 0


def test_given_documents(spark, sf_dir, both):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for r in token_counts(docs, PATH, 512).collect():
        assert r.n_tokens == len(both[1].encode(r.text, add_special_tokens=False).ids)
