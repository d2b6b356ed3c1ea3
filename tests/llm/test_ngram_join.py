import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cladeweave.llm import ngram_join as nj
from cladeweave.llm.components import components
from cladeweave.llm.count_rtree import CountTree, group_counts, overlap_bound, read_points

from .conftest import ODD


def shingle_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(docs):
    sets = [shingle_set(t) for _, t in docs]
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) and sets[i] and sets[j]:
                up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(docs):
        known = [x for x in (least.get(root(i)), d) if x is not None]
        least[root(i)] = min(known) if known else None
    return sorted(((d, len(s), least[root(i)]) for i, ((d, _), s) in enumerate(zip(docs, sets))), key=str)


def corpus(rnd, n, passage_share=0.3):
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(vocabulary) for _ in range(30)]
    docs, texts = [], []
    for i in range(n):
        if texts and rnd.random() < 0.5:
            words = list(rnd.choice(texts))
            for _ in range(rnd.choice([0, 1, 1, 2, 3])):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        else:
            words = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 3, 5, 30, 60, 90]))]
            if rnd.random() < passage_share:
                words += passage
        texts.append(words)
        docs.append((i, " ".join(words)))
    return docs


def check(docs_of, docs):
    got = nj.ngram_join(docs_of(docs, "component_id"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs)


def test_like_brute_force(docs_of):
    check(docs_of, corpus(random.Random(1), 150))


def test_split_tokens_and_blocks(docs_of, monkeypatch):
    for name, value in {"REPEATED": 2, "WINDOW": 500, "SPLIT": 3, "BLOCK": 4, "BUCKET": 50, "FREQUENT": 40}.items():
        monkeypatch.setattr(nj, name, value)
    check(docs_of, corpus(random.Random(2), 120, 0.6))


def brute_links(docs):
    sets = [shingle_set(t) for _, t in docs]
    linked = lambda x, y: x and y and 100 * len(x & y) >= 75 * len(x | y)
    return [sum(bool(linked(x, y)) for j, y in enumerate(sets) if i != j) for i, x in enumerate(sets)]


def check_links(docs_of, docs):
    got = nj.ngram_links(docs_of(docs, "n_links"))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    want = [(*r, n) for r, n in zip(unsorted_brute(docs), brute_links(docs))]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)


def unsorted_brute(docs):
    """``brute`` in the order of ``docs``, whose doc_ids differ."""
    found = {r[0]: r for r in brute(docs)}
    return [found[d] for d, _ in docs]


def chain(rnd, copies, n):
    """Groups of more than two different sets, some similar only by way of others, with copies."""
    words = [f"c{rnd.randrange(10**6)}" for _ in range(60)]
    texts = []
    for i in range(n):
        words = list(words)
        words[(7 * i) % 60] = f"d{i}"
        texts += [" ".join(words)] * copies
    return texts


def test_links_like_brute_force(docs_of):
    rnd = random.Random(4)
    texts = [t for _, t in corpus(rnd, 80)] + chain(rnd, 3, 6) + chain(rnd, 1, 40) + [None, "", "a"]
    docs = list(enumerate(texts))
    n = brute_links(docs)
    assert max(n) > 4 and n[80] > 2 and len(set(n[80:98])) > 1  # more than the copies, not whole groups
    check_links(docs_of, docs)


def test_links_in_split_blocks(docs_of, monkeypatch):
    for name, value in {"WINDOW": 500, "SPLIT": 3, "BLOCK": 4, "BUCKET": 50, "FREQUENT": 40, "FANOUT": 2}.items():
        monkeypatch.setattr(nj, name, value)
    rnd = random.Random(6)
    check_links(docs_of, list(enumerate([t for _, t in corpus(rnd, 50)] + chain(rnd, 2, 12))))


def near_copies(rnd, n):
    """Texts that differ in one word each, after two that are like none of the others."""
    base = [f"b{rnd.randrange(10**6)}" for _ in range(130)]

    def changed(places, name):
        return " ".join(f"{name}x{k}" if k in places else w for k, w in enumerate(base))

    far = [changed(places, name) for places, name in (((20, 50, 80), "e"), ((35, 65, 95), "f"))]
    return far + [changed((5 + i % 120,), f"g{i}") for i in range(n)]


def stored_rows(monkeypatch):
    """Row counts of the tables that the join stores, by name, as they come up."""
    found, store = {}, nj.materialize

    def count(df, name, keep=False):
        out = store(df, name, keep)
        found[name] = max(found.get(name, 0), out.count())
        return out

    monkeypatch.setattr(nj, "materialize", count)
    return found


@pytest.mark.parametrize("n", [60, 180])
def test_rows_of_a_group_of_near_copies(docs_of, monkeypatch, n):
    """All pairs of the group link, but no step makes a row for each of them."""
    docs = list(enumerate(near_copies(random.Random(9), n)))
    rows = stored_rows(monkeypatch)
    check(docs_of, docs)
    pairs = [rows.get(name, 0) for name in ("stars", "left", "verified", "members", "found")]
    assert 0 < max(pairs) <= 4 * len(docs)


def test_near_copies_in_parts(docs_of, monkeypatch):
    rnd = random.Random(10)
    texts = [t for seed in (11, 12) for t in near_copies(random.Random(seed), 50)] + chain(rnd, 2, 30)
    for name, value in {"BLOCK": 20, "BLOCK_TOKENS": 2000, "FANOUT": 2}.items():
        monkeypatch.setattr(nj, name, value)
    check(docs_of, list(enumerate(texts)))


def test_blocks_of_one_first_node_unite_if_alike(spark, monkeypatch):
    rows = [(t, v, v, 1, 4, f) for t, f, vs in ((1, 7, range(7, 11)), (2, 7, range(7, 11)), (3, 20, range(20, 24)),
            (4, 20, (20, *range(30, 33))), (5, 20, (20, *range(40, 43)))) for v in vs]
    members = spark.createDataFrame(rows, "token long, node long, component long, size int, n long, first long")
    got = {(r.token, r.node) for r in nj._united(members).collect()}
    assert got == {(7, v) for v in range(7, 11)} | {(r[0], r[1]) for r in rows if r[0] > 2}


def test_odd_rows(docs_of):
    docs = list(enumerate(ODD)) + [(None, "a b c d e f"), (50, "A b\tc d e f"), (3, "a"), (3, "a"), (None, None)]
    check(docs_of, docs)


def test_empty(docs_of):
    check(docs_of, [])


def test_keep_one(docs_of):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    docs = docs_of([(5, a), (2, a.upper()), (2, b), (9, b), (9, b), (7, None), (8, ""), (8, ""), (None, "alone here")])
    kept = nj.keep_one(docs)
    assert kept.columns == docs.columns
    want = [(2, a.upper()), (2, b), (7, None), (8, ""), (None, "alone here")]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)


def test_tree_loses_no_pair():
    rng = np.random.default_rng(0)
    sets = []
    for _ in range(150):
        base = sets[rng.integers(len(sets))] if sets and rng.random() < 0.6 else rng.integers(0, 2**64, 40, np.uint64)
        sets.append(np.unique(np.where(rng.random(len(base)) < 0.05, rng.integers(0, 2**64, len(base), np.uint64), base)))
    points, over = read_points([group_counts(s) for s in sets])
    classes = np.arange(150) // 2
    tree = CountTree(points, over, np.array([len(s) for s in sets]), classes, 75)
    pairs = [(min(i, j), max(i, j)) for p, q in tree.pairs() for i, j in zip(p.tolist(), q.tolist())]
    found = set(pairs)
    assert len(found) == len(pairs) and all(classes[i] != classes[j] for i, j in found)
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if classes[i] != classes[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                assert (j, i) in found
    assert len(found) < 150 * 149 // 2


def test_tree_leaves_out_classes_joined_on_the_way():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**64, 60, np.uint64)
    sets = [np.unique(np.r_[base, rng.integers(0, 2**64, 2, np.uint64)]) for _ in range(100)]
    points, over = read_points([group_counts(s) for s in sets])
    tree = CountTree(points, over, np.array([len(s) for s in sets]), np.arange(100), 75)
    portions = tree.pairs()
    i, j = next(portions)
    assert len(i)
    classes = np.arange(100) % 2  # the rest pairs even with odd entries only
    tree.classify(classes)
    rest = [pair for portion in portions for pair in zip(*portion)]
    seen = {frozenset(p) for p in zip(i.tolist(), j.tolist())} | {frozenset(map(int, p)) for p in rest}
    assert rest and all(classes[p] != classes[q] for p, q in rest)
    assert seen >= {frozenset((p, q)) for p in range(0, 100, 2) for q in range(1, 100, 2)}


def test_points_of_large_counts():
    same = np.sort(np.random.default_rng(1).integers(0, 2**52, 2000).astype(np.uint64))  # all in one group
    points, over = read_points([group_counts(same), group_counts(same[:1500])])
    assert overlap_bound(points[:1], points[1:], over[:1], over[1:]).tolist() == [1500]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rnd = random.Random(seed)
    links = [(i, i + 1) for i in range(40)] + [(rnd.randrange(60, 160), rnd.randrange(60, 160)) for _ in range(60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for node in got:
        seen, todo = {node}, [node]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        assert got[node] == min(seen)
    assert set(got) == {x for a, b in links if a != b for x in (a, b)}
    empty = components(spark.createDataFrame([], "a long, b long"))
    assert empty.select(F.col("node"), F.col("component")).count() == 0
