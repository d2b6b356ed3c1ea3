import random
import re

from cladeweave.llm import decontaminate as dc

from .conftest import ODD

ITEMS = "item_id long, text string"


def brute(text, items, size):
    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    w, hit, found = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        n = min(size, len(iw))
        if item is None or not n:
            continue
        wins = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)}
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in wins:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


def check(spark, docs_of, docs, items, size):
    got = dc.decontaminate(docs_of(docs, "n_hit"), spark.createDataFrame(items, ITEMS), size).collect()
    want = sorted(((d, *brute(t, items, size)) for d, t in docs), key=str)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=str) == want
    return got


def test_like_brute_force(spark, docs_of):
    rnd = random.Random(3)
    text = lambda n: " ".join(rnd.choice(["a", "b", "Éc", "D1", "e-f"]) for _ in range(n))
    items = [(i % 25, text(rnd.randint(0, 9))) for i in range(30)] + [(None, "a b"), (7, None)]
    check(spark, docs_of, [(i, text(rnd.randint(0, 60))) for i in range(80)], items, 4)


def test_blocks_of_patterns(spark, docs_of, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_BYTES", 8)
    items = [(i, f"one two w{i} three") for i in range(6)]
    docs = [(1, "x one two w3 three one TWO w5, three y"), (2, "none")]
    got = check(spark, docs_of, docs, items, 10)
    assert {r.doc_id: r.n_hit for r in got} == {1: 8, 2: 0}


def test_spans_are_of_the_original(spark, docs_of):
    docs = [(1, "Well: The, CAT; sat!! down"), (None, "the cat"), (1, "Well: The, CAT; sat!! down")]
    got = check(spark, docs_of, docs, [(5, "the cat sat")], 10)
    assert [docs[0][1][a:b] for r in got if r.doc_id == 1 for a, b in r.spans] == ["The, CAT; sat"] * 2


def test_odd_and_empty(spark, docs_of):
    check(spark, docs_of, list(enumerate(ODD)), [(1, "the cat the"), (2, "ß É")], 10)
    check(spark, docs_of, [], [(1, "a b")], 10)
    check(spark, docs_of, [(1, "a b")], [], 10)


def test_keep_clean(spark, docs_of):
    items = spark.createDataFrame([(1, "one two three")], ITEMS)
    docs = docs_of([(1, "one two three"), (2, "one two"), (3, None), (4, "x ONE, two three")])
    kept = dc.keep_clean(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
