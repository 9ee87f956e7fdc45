import random

import brute
import pytest

from runledger.llm import jaccard_join
from runledger.llm.jaccard_join import near_duplicates, one_of_each, tile_links


def grouped(rows):
    sets = [brute.shingles(text) for _, text in rows]
    groups = brute.Groups(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                groups.join(i, j)
    return sets, groups


def expected(rows):
    sets, groups = grouped(rows)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            root = groups.find(i)
            least[root] = min(least.get(root, doc_id), doc_id)
    return sorted(
        (str(doc_id), len(s), str(least.get(groups.find(i))))
        for i, ((doc_id, _), s) in enumerate(zip(rows, sets, strict=True))
    )


def got(found):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found.collect())


def varied(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(9999)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    texts = [" ".join(f"w{rng.randrange(500)}" for _ in range(rng.randint(40, 160))) for _ in range(12)]
    out = [(i, t) for i, t in enumerate(texts)]
    for k, text in enumerate(texts[:6]):
        for m in range(8):
            out.append((100 + 10 * k + m, varied(rng, text, rng.randint(0, 5))))
    common = " ".join(f"c{i}" for i in range(30))
    out += [(300 + i, f"{common} {texts[7][i * 9:i * 9 + 60]}") for i in range(6)]
    out += [(400, None), (401, ""), (402, " \n "), (403, "One two"), (404, "one TWO"), (405, "one"),
            (406, "one"), (407, "a b c d e"), (None, "a b c d e"), (1, texts[1]), (1, texts[2]),
            (409, texts[9] * 2), (None, None)]
    return out


@pytest.mark.parametrize(("block", "near"), [(1024, 32), (4, 2), (1, 1)])
def test_equals_brute_force(spark, make_docs, rows, monkeypatch, block, near):
    monkeypatch.setattr(jaccard_join, "NEAR", near)
    assert got(near_duplicates(make_docs(rows), block=block)) == expected(rows)


def test_equals_brute_force_without_broadcast(spark, make_docs, rows, monkeypatch):
    from runledger.llm import common, components

    monkeypatch.setattr(common, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(components, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 300)
    assert got(near_duplicates(make_docs(rows), block=3)) == expected(rows)


def test_candidates_connect_what_a_list_can_pair(monkeypatch):
    """Any batches of any lists: sets that may link are connected, by few edges."""
    import numpy as np

    monkeypatch.setattr(jaccard_join, "NEAR", 3)
    rng = random.Random(4)
    for _ in range(200):
        rows = sorted((rng.randrange(4), rng.randint(5, 9), rng.randrange(2))
                      for _ in range(rng.randint(0, 40)))
        token, n, at = (np.array(x, np.int64) for x in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 3
        groups = brute.Groups(range(len(rows)))
        start, kept, edges = 0, 0, 0
        while start < len(rows):
            stop = min(len(rows), start + rng.randint(1, 9))
            low = max(0, start - min(kept, 4))
            a, b = jaccard_join.candidate_edges(token[low:stop], n[low:stop], at[low:stop], start - low, 80)
            for x, y in zip((a + low).tolist(), (b + low).tolist(), strict=True):
                groups.join(x, y)
                edges += 1
            kept, start = stop - low, stop
        assert edges <= 2 * 3 * len(rows) + 4 * len(rows)
        for i in range(len(rows)):
            for j in range(i):
                if token[i] == token[j] and 100 * n[j] >= 80 * n[i]:
                    least = -(-80 * (n[i] + n[j]) // 180)
                    if min(n[i] - at[i], n[j] - at[j]) >= least:
                        assert groups.find(i) == groups.find(j)


def test_tile_pairs_at_the_threshold():
    import numpy as np

    uses = np.ones(1 << jaccard_join.BUCKETS, np.int64)
    rng = np.random.default_rng(1)
    for n in range(1, 40):
        a = np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64))
        for common in range(n + 1):
            b = np.sort(np.concatenate([a[:common], rng.integers(0, 1 << 63, n - common).astype(np.uint64)]))
            link = 100 * common >= 80 * (2 * n - common)
            found = tile_links([a, b], uses, np.array([0, 0]), 80)
            assert bool(found) == link, (n, common)


def test_sketches_rule_out_no_link():
    """Sets of all sizes, at, above and below the threshold, in one tile and over two sides."""
    import numpy as np

    rng = np.random.default_rng(3)
    sets = []
    for n in (1, 2, 5, 9, 60, 64, 65, 120, 500, 520, 1100):
        base = rng.integers(0, 1 << 63, n).astype(np.uint64)
        for _ in range(6):
            changed = int(rng.integers(0, n // 3 + 1))
            more = rng.integers(0, 1 << 63, int(rng.integers(0, n // 5 + 2))).astype(np.uint64)
            sets.append(np.unique(np.concatenate([base[changed:], more])))
    sets = [s for s in sets if len(s)]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    rows = jaccard_join.sketches(bounds, np.concatenate(sets))
    size = np.diff(bounds)
    for side in (np.zeros(len(sets), int), np.arange(len(sets)) % 2):
        both = len(set(side.tolist())) > 1
        groups = brute.Groups(range(len(sets)))
        pairs = jaccard_join.sketch_pairs(size, rows, side, 80)
        assert len(pairs) < len(sets)
        for i, j in pairs:
            groups.join(i, j)
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                common = len(np.intersect1d(a, b))
                if 100 * common >= 80 * (len(a) + len(b) - common) and not (both and side[i] == side[j]):
                    assert groups.find(i) == groups.find(j)
                if common == 0 and min(len(a), len(b)) > 400:
                    assert groups.find(i) != groups.find(j)


def test_one_of_each(spark, make_docs, rows):
    docs = make_docs(rows)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    found = [(r.doc_id, r.text) for r in kept.collect()]
    sets = [brute.shingles(text) for _, text in found]
    for i, a in enumerate(sets):
        for b in sets[:i]:
            assert not (a and b) or 100 * len(a & b) < 80 * len(a | b)
    # As many as there are components, and everything without words.
    all_sets, groups = grouped(rows)
    parts = {groups.find(i) for i, s in enumerate(all_sets) if s}
    assert len([s for s in sets if s]) == len(parts)
    assert len([s for s in sets if not s]) == 4


def test_empty_table(spark, make_docs):
    docs = make_docs([(1, "a b")]).limit(0)
    assert near_duplicates(docs).count() == 0
    assert one_of_each(docs).count() == 0
