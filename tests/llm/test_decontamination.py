import hashlib
import random

import brute
import pytest

from runledger.llm import decontamination
from runledger.llm.decontamination import contamination, matches


def expected(rows, items):
    of_windows = brute.windows(items)
    out = []
    for doc_id, text in rows:
        n, positions, found = brute.hits(text, of_windows)
        names = sorted(map(str, found))
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        dirty = len(positions) > 0 and 20 * len(positions) >= n
        out.append((str(doc_id), n, len(positions), len(found), digest, dirty))
    return sorted(out)


def got(found):
    return sorted(
        (str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
        for r in found.collect()
    )


def text_of(rng, n, vocabulary=40):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(3)
    items = [(i, text_of(rng, rng.randint(1, 40))) for i in range(12)]
    items += [(12, "w1"), (13, items[0][1]), (14, ""), (15, None), (16, "Two, WORDS!")]
    rows = [(i, text_of(rng, rng.randint(1, 200), 3 if i % 4 else 40)) for i in range(40)]
    for i, (_, text) in enumerate(items[:8]):
        rows.append((100 + i, f"{text_of(rng, 30)} {text} {text} {text_of(rng, 300)}"))
    rows += [(200, None), (201, ""), (202, "?!"), (203, "two words"), (203, "two words"),
             (None, items[1][1]), (204, items[2][1].upper())]
    return rows, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_equals_brute_force(spark, make_docs, tables, block_bytes):
    rows, items = tables
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = contamination(make_docs(rows), benchmark, block_bytes=block_bytes)
    assert got(found) == expected(rows, items)


def test_phrases_and_proximity(spark, make_docs):
    item = " ".join(f"t{i}" for i in range(13))
    shuffled = " ".join(f"t{i}" for i in reversed(range(13)))
    gap = item.replace("t5", "t5 x x x")
    far = item.replace("t5", "t5 " + "x " * 60)
    rows = [(1, "a b " + item), (2, shuffled), (3, gap), (4, far), (5, item.replace("t5", "y"))]
    benchmark = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    found = matches(make_docs(rows), benchmark, near=20).collect()
    phrases = [(r.doc_id, r.item_id, r.word) for r in found if r.kind == "phrase"]
    assert phrases == [(1, "7", 2)]
    assert sorted({r.doc_id for r in found if r.kind == "proximity"}) == [1, 2, 3]


@pytest.mark.parametrize("item_id", [7, None])
def test_items_of_one_id_are_cut_into_blocks(spark, make_docs, tables, item_id, monkeypatch):
    """Items that share an id, or have none, count as one item and fill several blocks."""
    rows, items = tables
    same = [(item_id, text) for _, text in items if text] * 3
    benchmark = spark.createDataFrame(same, "item_id bigint, text string")
    sizes, of = [], decontamination.Windows.of
    monkeypatch.setattr(decontamination.Windows, "of", lambda found, size: sizes.append(
        sum(len(text) for _, text in found)) or of(found, size))
    found = contamination(make_docs(rows), benchmark, block_bytes=400)
    named = [(7 if item_id else "null", text) for _, text in same]
    assert got(found) == expected(rows, named)
    assert len(sizes) > 2 and sum(sizes) == sum(len(text) for text in {text for _, text in same})
    pairs = [tuple(r) for r in matches(make_docs(rows[:8]), benchmark, block_bytes=400).collect()]
    once = [tuple(r) for r in matches(make_docs(rows[:8]), benchmark).collect()]
    assert sorted(pairs) == sorted(once)


def test_a_phrase_does_not_span_documents(spark, make_docs):
    words = [f"t{i}" for i in range(13)]
    rows = [(1, " ".join(words[:6])), (2, " ".join(words[6:]))]
    benchmark = spark.createDataFrame([(7, " ".join(words))], "item_id bigint, text string")
    assert [r.n_hit for r in contamination(make_docs(rows), benchmark).collect()] == [0, 0]


def test_empty_tables(spark, make_docs):
    benchmark = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert contamination(make_docs([(1, "a")]).limit(0), benchmark).count() == 0
    none = contamination(make_docs([(1, "a b")]), benchmark.limit(0)).collect()
    assert [(r.n_words, r.n_hit, r.n_items) for r in none] == [(2, 0, 0)]
