import itertools
import math
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from runledger.llm import language_id, quality, queries, toxicity, url_filters
from runledger.llm.common import fold, sampled_texts


@pytest.fixture(scope="module")
def large_dir():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def truth(spark, large_dir):
    labels = spark.read.parquet(f"{large_dir}/labels.parquet").collect()
    docs = spark.read.parquet(f"{large_dir}/documents.parquet").select("doc_id", "lang").collect()
    return {r.doc_id: r for r in labels}, {r.doc_id: r.lang for r in docs}


# --- toxicity --------------------------------------------------------------------


def test_toxicity_of_documents_held_out(spark, large_dir, truth):
    found = queries.op3_toxicity(spark, large_dir).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    held = [(truth[0][r.doc_id].toxic, r.predicted) for r in found if r.held_out and r.doc_id in truth[0]]
    assert sum(a == b for a, b in held) / len(held) > 0.93
    assert sum(b for a, b in held if a) >= 0.6 * sum(a for a, _ in held)


def toxic_samples():
    rng = random.Random(1)
    rows = []
    for i in range(300):
        w = [f"w{rng.randrange(400)}" for _ in range(rng.randint(1, 80))]
        if i % 4 == 0:
            w[rng.randrange(len(w))] = f"badword{rng.randrange(5)}"
        rows.append((" ".join(w), int(i % 4 == 0)))
    return rows


def test_network_learns_and_reruns_agree():
    samples = toxic_samples()
    one, two = (toxicity.train(samples[:240], 0.25) for _ in range(2))
    texts = pa.array([t for t, _ in samples[240:]])
    a, b = one.scores(texts)[0], two.scores(texts)[0]
    assert (a == b).all()
    assert np.mean((a >= 0.5) == np.array([y for _, y in samples[240:]])) > 0.9


def test_scores_do_not_depend_on_the_batch():
    network = toxicity.train(toxic_samples()[:100], 0.25, epochs=1)
    texts = ["", None, "badword1", "w1 w2", "w1 w2 badword2", "x " * 5000, "w1"]
    alone = [float(network.scores(pa.array([t], pa.string()))[0][0]) for t in texts]
    together = network.scores(pa.array(texts, pa.string()))[0]
    assert together == pytest.approx(alone, rel=1e-5)


@pytest.mark.parametrize("labels", [[], [0], [1, 1]])
def test_too_few_labels(labels):
    network = toxicity.train([("some text", y) for y in labels], 0.5)
    (score,) = network.scores(pa.array(["a", None]))[0][:1]
    assert (score >= 0.5) == (labels == [1, 1])


def test_gradient_of_the_network():
    network = toxicity.Network(seed=3)
    words = toxicity.Words.of(pa.array(["a b c d", "b b", "c e a"]))
    labels, weight = np.array([1.0, 0.0, 1.0]), np.ones(3)

    def loss():
        z = network.log_odds(words).astype(float)
        return float((np.log1p(np.exp(z)) - labels * z).mean())

    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    grad = network.gradients(words, labels, weight)
    for name in ("dense", "filter2", "offset3", "bias"):
        flat, own = network.p[name].reshape(-1), np.asarray(grad[name]).reshape(-1)
        for i in range(0, len(flat), max(1, len(flat) // 5)):
            flat[i] += 1e-5
            up = loss()
            flat[i] -= 2e-5
            down = loss()
            flat[i] += 1e-5
            assert own[i] == pytest.approx((up - down) / 2e-5, abs=2e-4)


def group_counts(z):
    """Counts of scores around ``z``: toxic texts above, others below, for the numbers given."""
    counts = np.zeros((toxicity.GROUPS + 1, 2, toxicity.BINS), np.int64)
    for group, (middle, n) in enumerate(z):
        step = int((middle + toxicity.LIMIT) * toxicity.FINE)
        counts[group, 1, step + 3 : step + 35] += n
        counts[group, 0, step - 35 : step - 3] += n
    return counts


def test_small_groups_are_calibrated_without_a_step():
    found = []
    for n in (0, 1, 2, 4, 16):
        network = toxicity.Network()
        network.calibrate(group_counts([(0, 200), (0.5, n)]), 0.5)
        found.append(network.threshold[1])
    assert found == sorted(found) and found[1] > found[0] and found[-1] == pytest.approx(0.5, abs=0.2)


def test_groups_are_learned_from_the_texts():
    """Two languages that no list of words knows."""
    rng = random.Random(4)
    texts = [" ".join(rng.choice(w) for _ in range(40)) + f" x{i} y{i}" for i in range(100)
             for w in (["ja", "ei", "on", "se"], ["ve", "bir", "bu", "da"])]
    network = toxicity.train([(t, int(i % 7 == 0)) for i, t in enumerate(texts)], 0.1, epochs=1)
    groups = network.groups(toxicity.Words.of(pa.array(texts)))
    assert not set(groups[::2]) & set(groups[1::2]) and toxicity.GROUPS not in groups


def test_thresholds_are_calibrated_on_all_labels(spark, make_docs, monkeypatch):
    seen = []
    whole = toxicity.count_scores
    monkeypatch.setattr(toxicity, "count_scores", lambda *a: seen.append(whole(*a)) or seen[-1])
    rows = list(enumerate(toxic_samples()))
    docs = make_docs([(i, t) for i, (t, _) in rows])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in rows], "doc_id bigint, toxic int")
    toxicity.learn(docs, labels, F.lit(True), max_docs=20, epochs=1)
    # 32 of the 40 texts of the sample are fitted on.
    assert seen[0].sum() == len(rows) - 32


def test_toxicity_column(spark, make_docs):
    docs = make_docs([(1, "badword1"), (2, None), (2, None), (None, "")]).withColumnRenamed("n", "score")
    network = toxicity.train(toxic_samples(), 0.25)
    found = toxicity.toxicity(docs, network).orderBy("doc_id").collect()
    assert len({r.score for r in found if not r.text}) == 1
    assert [r.predicted for r in found if r.text] == [1]
    assert toxicity.toxicity(docs.limit(0), network).count() == 0


def test_learning_from_no_labels(spark, make_docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    network = toxicity.learn(make_docs([(1, "a b")]), labels, fold("_id", 5) != 0)
    assert [r.predicted for r in toxicity.toxicity(make_docs([(1, "a b")]), network).collect()] == [0]


# --- language --------------------------------------------------------------------


def test_language_of_documents_held_out(spark, large_dir, truth):
    found = queries.op5_language_id(spark, large_dir).collect()
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[1][r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_forward_sums_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "ba", "▁a", "aba"]
    rng = np.random.default_rng(2)
    p = rng.random((len(pieces) + 2, 2))
    p[-1] = 0
    model = language_id.LanguageModel(language_id.Pieces(pieces), ["x", "y"], p)

    def brute(text, k):
        number = {x: i for i, x in enumerate(pieces)}
        total = 0.0
        for cuts in itertools.product([0, 1], repeat=len(text) - 1):
            parts, last = [], 0
            for i, c in enumerate(cuts, start=1):
                if c:
                    parts.append(text[last:i])
                    last = i
            parts.append(text[last:])
            prob = 1.0
            for part in parts:
                own = number.get(part, len(pieces) if len(part) == 1 else -1)
                prob *= p[own, k]
            total += prob
        return math.log(total)

    words = ["ab", "aba", "q", "abab", "baq", "a"]
    found = model.word_scores(pa.array(words))
    for w, row in zip(words, found, strict=True):
        for k in range(2):
            assert row[k] == pytest.approx(brute("▁" + w, k))
    long = model.word_scores(pa.array(["ab" * 5000]))
    assert np.isfinite(long).all()


def test_expected_uses_add_up():
    """Each word is cut into pieces that cover it exactly."""
    pieces = ["▁", "a", "b", "ab", "▁a"]
    known = language_id.Pieces(pieces)
    p = np.full((len(pieces) + 2, 1), 0.1)
    p[-1] = 0
    model = language_id.LanguageModel(known, ["x"], p)
    words = ["▁abab", "▁qqab"]
    edges = known.edges(language_id._points(words))
    uses = model.expected(edges, np.array([[2.0], [3.0]]))[:, 0]
    length = np.array([*map(len, pieces), 1, 0])
    assert (uses * length).sum() == pytest.approx(2 * 5 + 3 * 5)


def test_language_column(spark, make_docs):
    samples = [("the house and the garden", "en"), ("das haus und der garten", "de")]
    pieces = language_id.vocabulary_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    model = language_id.train(samples, pieces)
    docs = make_docs([(1, "THE garden"), (2, "das Haus"), (3, None), (4, "12 !"), (None, "der")])
    found = {r.doc_id: r.lang_pred for r in language_id.identify(docs, model).collect()}
    assert found == {1: "en", 2: "de", 3: "und", 4: "und", None: "de"}
    nothing = language_id.identify(docs, language_id.train([], pieces)).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert language_id.identify(docs.limit(0), model).count() == 0


# --- quality ---------------------------------------------------------------------


def test_quality_of_documents_held_out(spark, large_dir, truth):
    found = queries.op8_quality(spark, large_dir).collect()
    held = [(truth[0][r.doc_id].quality, r.selected) for r in found if r.held_out and r.doc_id in truth[0]]
    assert sum(a == b for a, b in held) / len(held) > 0.9
    assert all(r.selected for r in found if r.held_out and r.doc_id in truth[0]
               and truth[0][r.doc_id].quality == 1 and r.tail_probability >= 0.5)


def test_grades_in_order():
    rng = random.Random(6)
    samples = []
    for i in range(400):
        grade = i % 4
        chars = "ab" if rng.random() < (grade + 0.5) / 4 else "yz"
        text = "".join(rng.choice("ab" if rng.random() < (grade + 0.5) / 4 else "yz") for _ in range(60))
        samples.append((text + chars * 2, grade))
    model = quality.train(samples[:300])
    assert (np.diff(model.cuts) > 0).all() and len(model.cuts) == 3
    places = np.array([model.place(t.encode()) for t, _ in samples[300:]])
    tails = model.tails(places)
    assert (np.diff(tails, axis=1) < 0).all()
    grades = np.array([g for _, g in samples[300:]])
    expected = model.expected(tails)
    assert np.corrcoef(expected, grades)[0, 1] > 0.8
    means = [expected[grades == g].mean() for g in range(4)]
    assert means == sorted(means)


def test_counts_of_long_texts_are_whole(monkeypatch):
    text = bytes(random.Random(1).choices(range(256), k=5000))
    whole = quality.ngram_counts(text)
    monkeypatch.setattr(quality, "LONGEST_PIECE", 700)
    assert (quality.ngram_counts(text) == whole).all()
    assert whole.sum() == 5000 + 4999 + 4998


def test_quality_column(spark, make_docs):
    samples = [("good text here", 1), ("$$$ %%%", 0), ("fine words", 1), ("%%% &&&", 0)] * 5
    model = quality.train(samples)
    docs = make_docs([(1, "good words"), (2, "%%%"), (3, None), (3, None), (4, "")])
    found = {r.doc_id: r for r in quality.quality(docs, model, least=1).collect()}
    assert found[1].selected and not found[2].selected
    assert found[3].tail_probability == found[4].tail_probability
    assert quality.quality(docs.limit(0), model, least=1).count() == 0
    (one,) = {(r.expected_grade, r.tail_probability, r.selected) for r in
              quality.quality(docs, quality.train([("x", 3)]), least=1).collect()}
    assert one == (3.0, 1.0, True)
    (none,) = {(r.expected_grade, r.tail_probability, r.selected) for r in
               quality.quality(docs, quality.train([]), least=1).collect()}
    assert none == (None, None, False)


# --- samples ---------------------------------------------------------------------


def test_samples_are_bounded_and_whole(spark):
    rows = [(i, "x" * (i % 50), i % 3) for i in range(200)] + [(5, "twice", 0), (5, "twice", 0), (None, "n", 1)]
    df = spark.createDataFrame(rows + [(900, None, 1)], "i bigint, t string, g int")
    texts = {(t, g) for _, t, g in rows}
    for docs, size in ((10, 10_000), (500, 300)):
        found = sampled_texts(df, "i", "t", ["g"], docs, size, per="g")
        assert found == sampled_texts(df.repartition(5), "i", "t", ["g"], docs, size, per="g")
        assert all(x in texts for x in map(tuple, found))
        for g in range(3):
            own = [t for t, h in found if h == g]
            assert len(own) <= docs and sum(map(len, own)) <= size and own
    everything = sampled_texts(df, "i", "t", ["g"], 500, 1 << 20)
    assert len(everything) == 202


def test_samples_of_marks_move_no_text(spark, conf, monkeypatch):
    """Only ids, lengths and hashes meet the labels, and a repeated row is read out once."""
    from runledger.llm import common

    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(common, "fits_broadcast", lambda df: False)
    rows = [(i, f"text {i}") for i in range(300)] + [(7, "again")] * 5000
    docs = spark.createDataFrame(rows, "i bigint, t string").withColumn("t", F.concat("t", F.lit("!")))
    marks = spark.createDataFrame([(i, i % 2) for i in range(0, 300, 3)] + [(7, 1)], "i bigint, g int")
    marks = marks.dropDuplicates(["i"])
    plans, whole = [], common.split_join

    def join(left, right, *a, **k):
        plans.append(left)
        return whole(left, right, *a, **k)

    monkeypatch.setattr(common, "split_join", join)
    found = sampled_texts(docs, "i", "t", ["g", "i"], 40, 10_000, per="g", marks=marks)
    assert plans and all("string" not in dict(p.dtypes).values() for p in plans)
    wanted = {r["i"]: r["g"] for r in marks.collect()}
    assert all(wanted[i] == g for _, g, i in found) and len(found) == 80
    assert {t for t, _, i in found} <= {f"{t}!" for _, t in rows}
    many = sampled_texts(docs, "i", "t", ["i"], 6000, 1 << 20, marks=marks)
    assert sum(t == "again!" for t, _ in many) == 5000


def test_scores_beyond_the_broadcast_limit(spark, make_docs, monkeypatch):
    """Places instead of texts meet the labels where these are too many to broadcast."""
    rows = list(enumerate(toxic_samples()))
    docs = make_docs([(i, t) for i, (t, _) in rows] + [(10_000, "no label")])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in rows], "doc_id bigint, toxic int")
    one = toxicity.learn(docs, labels, F.lit(True), max_docs=20, epochs=1)
    monkeypatch.setattr(toxicity, "fits_broadcast", lambda df: False)
    two = toxicity.learn(docs, labels, F.lit(True), max_docs=20, epochs=1)
    assert (one.threshold == two.threshold).all()


def test_columns_with_clashing_names_stay(spark, make_docs):
    docs = make_docs([(1, "some text"), (2, None)]).withColumns({"_scored": F.lit("mine"), "_host": F.lit("own")})
    named = [
        quality.quality(docs, quality.train([("x", 1), ("y", 0)]), least=1),
        language_id.identify(docs, language_id.train([], ["a", "b"])),
        url_filters.judge_urls(docs.withColumn("url", F.lit("http://a.net/x")), url_filters.rule_table(
            spark, [("net", "/", "block")])),
    ]
    for found in named:
        assert {(r["_scored"], r["_host"]) for r in found.collect()} == {("mine", "own")}
        assert found.columns[: len(docs.columns)] == docs.columns


def test_long_words_are_scored_as_by_the_forward_sums():
    rng = random.Random(2)
    samples = [("abba baab", "x"), ("cddc dccd", "y")] * 3
    model = language_id.train(samples, ["a", "ab", "bba", "c", "cd", "dcc", language_id.START + "a"])
    for n in (1, 2, 7, 50):
        words = ["".join(rng.choice("abcdz") for _ in range(n)) for _ in range(5)]
        points = language_id._started(language_id._points(words))
        want, _ = model.forward(model.pieces.edges(points))
        assert model.scores(points) == pytest.approx(want, rel=1e-12)
    long = "".join(rng.choice("abcd") for _ in range(200_000))
    tracemalloc.start()
    (best, score) = model.text_scores(pa.array([long]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert best[0] in (0, 1) and 0 <= score[0] <= 1 and peak < 200 << 20
