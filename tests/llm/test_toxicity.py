import random
import tracemalloc
import zlib

import numpy as np
from pyspark.sql import functions as F

from cladeweave.llm import toxicity as tx

from .conftest import ODD

LABELS = "doc_id long, toxic int"


def corpus(n, seed=0):
    """Toxic exactly where an insult meets a group; either alone is not."""
    rnd = random.Random(seed)
    plain = [f"word{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = [rnd.choice(plain) for _ in range(rnd.randint(5, 40))]
        insult, group = rnd.random() < 0.5, rnd.random() < 0.5
        words += ["vermin"] * insult + ["folk"] * group
        rnd.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(insult and group)))
    return docs, labels


def test_pairs_are_learned(spark, docs_of):
    docs, labels = corpus(1500)
    frame = docs_of(docs, "score")
    machine = tx.fit(frame, spark.createDataFrame(labels, LABELS))
    truth = dict(labels)
    got = {r.doc_id: r.score for r in tx.score(frame, machine).collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == truth[i] for i in held]) > 0.97
    score = lambda text: machine.score(tx.terms(text))
    assert score("vermin folk") > 0.5 > max(score("vermin"), score("folk"))
    # the pair counts beyond the sum of its parts
    logit = lambda text: np.log(score(text) / (1 - score(text)))
    assert logit("vermin folk") + machine.bias > logit("vermin") + logit("folk") + 0.5


def test_a_rare_group_that_tells_nothing_alone(spark, docs_of):
    """The pair of an insult and a rare group is toxic; by itself the group's share of toxic
    documents is about that of all."""
    rnd = random.Random(3)
    docs, truth, groups = [], {}, []
    for i in range(1800):
        insult, other = rnd.random() < 0.1, rnd.random() < 0.07
        group = rnd.random() < (0.12 if insult else 0.05)
        words = [f"w{rnd.randrange(300)}" for _ in range(rnd.randint(5, 40))]
        words += ["vermin"] * insult + ["folk"] * group + ["scum"] * other
        rnd.shuffle(words)
        docs.append((i, " ".join(words)))
        truth[i] = int(other or (insult and (group or rnd.random() < 0.2)))
        if group and zlib.crc32(str(i).encode()) % 5:
            groups.append(i)
    hits, n, share = sum(truth[i] for i in groups), len(groups), np.mean(list(truth.values()))
    gain = hits * np.log(hits / n / share) + (n - hits) * np.log((n - hits) / n / (1 - share))
    assert gain < 8  # a screening of single terms would not keep it
    machine = tx.fit(docs_of(docs), spark.createDataFrame(list(truth.items()), LABELS))
    logit = lambda text: np.log(1 / (1 / machine.score(tx.terms(text)) - 1))
    assert zlib.crc32(b"w folk") % tx.BUCKETS in machine.term
    assert logit("vermin folk") + machine.bias > logit("vermin") + logit("folk") + 0.5
    assert logit("folk") < 0 < logit("vermin folk")


def test_a_pair_whose_terms_tell_nothing_alone(spark, docs_of):
    """Toxic where exactly one of two words stands: neither word changes the share."""
    rnd = random.Random(11)
    docs, truth = [], {}
    for i in range(3000):
        insult, group = rnd.random() < 0.5, rnd.random() < 0.5
        words = [f"w{rnd.randrange(300)}" for _ in range(rnd.randint(5, 40))] + ["vermin"] * insult + ["folk"] * group
        rnd.shuffle(words)
        docs.append((i, " ".join(words)))
        truth[i] = int(insult != group)
    frame = docs_of(docs)
    machine = tx.fit(frame, spark.createDataFrame(list(truth.items()), LABELS))
    held = {r.doc_id: r.score for r in tx.score(frame, machine).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    assert np.mean([(s >= 0.5) == truth[i] for i, s in held.items()]) > 0.9


def test_scores_follow_the_formula(spark, docs_of):
    """A double loop over the pairs of a text's terms, with the terms found anew."""
    docs, labels = corpus(400, seed=2)
    frame = docs_of(docs)
    machine = tx.fit(frame, spark.createDataFrame(labels, LABELS))
    got = {r.doc_id: r.score for r in tx.score(frame, machine).collect()}
    for i, text in docs[:60]:
        found = set()
        for word in text.lower().split():
            found.add(zlib.crc32(b"w " + word.encode()) % (1 << 20))
            if len(word) > 5:
                found.add(zlib.crc32(b"p " + word[:5].encode()) % (1 << 20))
        rows = [machine.term[t] for t in found if t in machine.term]
        logit = machine.bias + sum(machine.weights[r] for r in rows)
        for a in range(len(rows)):
            for b in range(a):
                logit += sum(x * y for x, y in zip(machine.vectors[rows[a]], machine.vectors[rows[b]]))
        assert abs(got[i] - 1 / (1 + np.exp(-logit))) < 1e-9


def test_terms_left_out_could_not_move(monkeypatch):
    rnd = np.random.default_rng(4)
    sizes = rnd.integers(0, 30, 400)
    flat, y = rnd.integers(0, 500, sizes.sum()).astype(np.int32), (rnd.random(400) < 0.1).astype(float)
    keys = np.unique(np.repeat(np.arange(400), sizes) * 500 + flat)  # a text is a set of terms
    flat, sizes = (keys % 500).astype(np.int32), np.bincount(keys // 500, minlength=400)
    monkeypatch.setattr(tx, "STEPS", 30)
    _, w, v = tx._fit(flat, sizes, y, 500)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    noise = float(np.sqrt(2 * np.log(500) * np.mean((0.5 * weight) ** 2)))
    movable = tx._movable(flat, sizes, weight, noise, 500)
    assert 0 < movable.sum() < 500 and not w[~movable].any() and not v[~movable].any()
    _, every, _ = tx._descend(tx._Incidence(flat, sizes, 500), y, weight, noise)
    assert not every[~movable].any()


def test_the_fit_holds_little_beside_the_sample(monkeypatch):
    rng = np.random.default_rng(6)
    sizes = np.full(4000, 500)
    flat, y = rng.integers(0, 20_000, sizes.sum()).astype(np.int32), (np.arange(4000) % 10 == 0).astype(float)
    monkeypatch.setattr(tx, "STEPS", 1)
    tracemalloc.start()
    tx._fit(flat, sizes, y, 20_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5 * flat.nbytes


def test_the_sample_by_ranges_is_as_at_once(monkeypatch):
    monkeypatch.setattr(tx, "SLICE", 64)
    monkeypatch.setattr(tx, "ROWS_AT_ONCE", 7)
    rng = np.random.default_rng(7)
    sizes = np.append(rng.integers(0, 30, 200), [300, 0, 0])
    flat, terms = rng.integers(0, 50, sizes.sum()).astype(np.int32), rng.random(50) < 0.5
    doc = np.repeat(np.arange(len(sizes)), sizes)
    docs = tx._counts(flat, sizes, 50)
    assert (docs == np.bincount(flat, minlength=50)).all()
    assert (tx._turned(flat, sizes, docs) == doc[np.argsort(flat, kind="stable")]).all()
    left, left_sizes = tx._only(flat, sizes, terms)
    assert (left == flat[terms[flat]]).all() and (left_sizes == np.bincount(doc[terms[flat]], minlength=len(sizes))).all()
    for none in (tx._only(flat, sizes, terms & False), tx._only(flat[:0], np.zeros(0, np.int64), terms)):
        assert len(none[0]) == 0 and not none[1].any()
    by_blocks, at_once = tx._Adam(np.zeros((50, 3))), tx._Adam(np.zeros((50, 3)))
    a, b = np.zeros((50, 3)), np.zeros((50, 3))
    for _ in range(20):
        gradient, penalty = rng.standard_normal((50, 3)), rng.random(50)
        by_blocks.step(a, gradient, penalty)
        monkeypatch.setattr(tx, "ROWS_AT_ONCE", 50)
        at_once.step(b, gradient, penalty)
        monkeypatch.setattr(tx, "ROWS_AT_ONCE", 7)
        assert (a == b).all()


def test_few_documents_are_enough_for_a_telling_term(spark, docs_of):
    rnd = random.Random(5)
    docs, labels = [], []
    for i in [i for i in range(200) if zlib.crc32(str(i).encode()) % 5][:70]:
        toxic = len(docs) < 10
        words = [f"w{rnd.randrange(40)}" for _ in range(15)] + (["clown"] if len(docs) < 3 else ["scum"]) * toxic
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    machine = tx.fit(docs_of(docs), spark.createDataFrame(labels, LABELS))
    assert machine.score(tx.terms("clown")) > machine.score(tx.terms(""))


def test_scores_do_not_depend_on_held_out_labels(spark, docs_of):
    docs, labels = corpus(300)
    frame = docs_of(docs)
    other = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = (tx.fit(frame, spark.createDataFrame(rows, LABELS)) for rows in (labels, other))
    assert a.bias == b.bias and (a.weights == b.weights).all() and (a.vectors == b.vectors).all()


def test_held_out(spark):
    ids = [0, 1, 7, -3, 10**12, None]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", tx.held_out("doc_id").alias("h")).collect()
    assert [r.h for r in rows] == [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0 for i in ids]


def test_odd_rows_and_labels(spark, docs_of):
    docs, labels = corpus(200)
    labels += [(None, 1), (3, None), (4, 7), (5, 0), (5, 1), (10**6, 1)]
    frame = docs_of([*docs, *((1000 + i, t) for i, t in enumerate(ODD)), (None, "vermin"), (1, "repeated")])
    machine = tx.fit(frame, spark.createDataFrame(labels, LABELS))
    rows = tx.score(frame, machine).collect()
    assert len(rows) == 200 + len(ODD) + 2 and all(0 <= r.score <= 1 for r in rows)
    kept = tx.keep_clean(frame, machine)
    assert kept.columns == frame.columns
    assert kept.count() == sum(r.score < 0.5 for r in rows)


def test_without_labels(spark, docs_of):
    none = spark.createDataFrame([], LABELS)
    frame = docs_of([(1, "a"), (2, None)])
    assert [r.score < 1e-6 for r in tx.score(frame, tx.fit(frame, none)).collect()] == [True, True]
    assert tx.score(docs_of([]), tx.fit(docs_of([]), none)).count() == 0
    one_sided = spark.createDataFrame([(i, 0) for i in range(9)], LABELS)
    frame = docs_of([(i, "a") for i in range(9)])
    assert all(r.score < 0.5 for r in tx.score(frame, tx.fit(frame, one_sided)).collect())


def test_the_sample_is_bounded(spark, docs_of):
    docs, labels = corpus(120)
    frame, labels = docs_of(docs), spark.createDataFrame(labels, LABELS)
    machine = tx.fit(frame, labels, max_rows=50)
    assert tx.score(frame, machine).filter(F.col("score").isNull()).count() == 0


def test_sample_is_bounded_in_terms(spark, monkeypatch):
    rows = [(i, 0, list(range(10))) for i in range(50)]
    terms = spark.createDataFrame(rows, "doc_id long, y int, terms array<int>")
    assert tx._bounded(terms).count() == 50
    monkeypatch.setattr(tx, "TERMS", 205)
    kept = tx._bounded(terms).select("doc_id").collect()
    order = terms.orderBy(F.xxhash64("doc_id")).select("doc_id").limit(20).collect()
    assert {r.doc_id for r in kept} == {r.doc_id for r in order}
    monkeypatch.setattr(tx, "TERMS", 1)  # one document is always there
    assert tx._bounded(terms).count() == 1
