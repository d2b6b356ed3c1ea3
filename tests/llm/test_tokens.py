import bisect
import random
import zlib

import numpy as np
import pytest

from cladeweave.llm import common, pack, token_file
from cladeweave.llm.encoder import END_ID, Encoder, encoder
from cladeweave.llm.token_count import count_symbols, count_tokens, counter
from cladeweave.llm.tokens import Memo, pieces

from .conftest import ODD

PARTS = [" ", " ", "  ", "\n", " ", "　", "\x1c", "\x85", "a", "the", "'s", "x" * 9, "é", "中", "12", "!",
         "<|endoftext|>", "<|end", "oftext|>", " ", "​", "\x0b", "\r", "﻿", "😀", "\x00"]


def test_random_texts_like_the_library(library, tokenizer):
    rnd, c, e = random.Random(1), counter(tokenizer), encoder(tokenizer)
    for _ in range(5000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 9)))
        want = library.encode(text, add_special_tokens=False).ids
        assert c.count(text) == len(want)
        assert e.document(text).tolist() == [*want, END_ID]


def test_many_texts_at_once_like_the_library(library, tokenizer):
    rnd, e = random.Random(2), encoder(tokenizer)
    for special in ("", "<|endoftext|>"):
        texts = ["".join(rnd.choice([*PARTS[:10], *PARTS[11:], special]) for _ in range(rnd.randint(0, 30))) for _ in range(300)]
        want = [[*library.encode(t, add_special_tokens=False).ids, END_ID] for t in [*texts, *map(str, ODD[1:])]]
        assert [x.tolist() for x in e.documents([*texts, *ODD[1:]])] == want


def test_merging_takes_the_lowest_rank_and_then_the_leftmost():
    ranks = {(b"a", b"a"): 1, (b"aa", b"b"): 0, (b"b", b"c"): 2}
    assert count_symbols(b"aaa", ranks) == 2
    assert count_symbols(b"aabc", ranks) == 2
    assert count_symbols(b"", ranks) == 0 and count_symbols(b"z", ranks) == 1


def test_memo_is_bounded():
    memo = Memo(len, limit=3)
    assert memo.all(pieces("a bb ccc dddd eeeee")) == [1, 3, 4, 5, 6] and len(memo) <= 3


def test_count_tokens(docs_of, library, tokenizer):
    docs = [*enumerate(ODD), (None, "a b"), (1, "twice"), (1, "twice")]
    got = count_tokens(docs_of(docs, "n_tokens"), tokenizer).collect()
    ids = lambda t: library.encode(t or "", add_special_tokens=False).ids
    want = [(d, len((t or "").encode()), len(ids(t))) for d, t in docs]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert count_tokens(docs_of([]), tokenizer).count() == 0


@pytest.mark.parametrize("numbers", [[], [5], [0, 0, 0], [-7, -7, 2**62], list(range(300)), [3] * 100 + [10**12]])
def test_elias_fano(numbers):
    data = b"xy" + token_file.EliasFano.encode(numbers).to_bytes()
    ef, end = token_file.EliasFano.from_bytes(data, 2)
    assert end == len(data) and [ef.select(i) for i in range(ef.n)] == numbers


@pytest.mark.parametrize("numbers", [[], [0], [-(2**63), -1, 2**63 - 1], [0, 0, 5, 5], [*range(-90, 90)], [3] * 100 + [10**12]])
def test_elias_fano_all_at_once(numbers):
    ef, _ = token_file.EliasFano.from_bytes(token_file.EliasFano.encode(numbers).to_bytes(), 0)
    assert ef.numbers().tolist() == numbers


def test_all_documents_of_a_segment():
    ids = [np.arange(n, dtype="<u2") for n in (1, 3, 1, 200, 2)]
    segment = token_file.Segment(token_file.pack_segment([None, None, -5, 7, 7], ids))
    doc_ids, bounds = segment.documents()
    assert doc_ids == [segment.doc_id(i) for i in range(5)] == [None, None, -5, 7, 7]
    assert list(zip(bounds.tolist(), bounds.tolist()[1:])) == [segment.bounds(i) for i in range(5)]


def test_elias_fano_random_and_small():
    rng = np.random.default_rng(0)
    numbers = np.sort(rng.integers(0, 10**7, 5000))
    data = token_file.EliasFano.encode(numbers).to_bytes()
    ef, _ = token_file.EliasFano.from_bytes(data, 0)
    assert [ef.select(i) for i in range(5000)] == numbers.tolist()
    assert len(data) < 5000 * 2.1


@pytest.mark.parametrize("segment", [40, 1 << 20])
def test_token_file_round_trip(spark, docs_of, tokenizer, library, tmp_path, segment):
    docs = [(7 * i % 61 - 30, f"text number {i} " * (i % 9)) for i in range(61)]
    docs += [(100 + i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (None, None), (5, "a"), (5, "a"), (2**62, "z")]
    path = f"{tmp_path}/tokens"
    token_file.write_tokens(docs_of(docs, "ids").repartition(3), path, tokenizer, segment)
    rows = token_file.read_tokens(spark, path).orderBy("start").collect()
    got = [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in rows]
    want = [(d, [*library.encode(t or "", add_special_tokens=False).ids, END_ID]) for d, t in docs]
    assert sorted(got, key=str) == sorted(want, key=str)
    order = [d for d, _ in got]
    assert order[:2] == [None, None] and order[2:] == sorted(d for d, _ in docs if d is not None)
    at = 0
    for r, (_, ids) in zip(rows, got):
        assert (r.start, r.n_tokens) == (at, len(ids))
        at += len(ids)


def test_empty_token_file(spark, docs_of, tokenizer, tmp_path):
    token_file.write_tokens(docs_of([]), f"{tmp_path}/none", tokenizer)
    assert token_file.read_tokens(spark, f"{tmp_path}/none").count() == 0


def valid(rows, ids, capacity):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(ids)
    for d, pieces in by_doc.items():
        at = 0
        for k, r in enumerate(sorted(pieces, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at)
            part = np.array(ids[d][at : at + r.length], "<u4")
            assert zlib.crc32(part.tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids[d]) and (len(pieces) == 1) == (at <= capacity.tokens)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity.tokens and len(pieces) <= capacity.pieces
        assert sum(r.length**2 for r in pieces) <= capacity.cost
    return len(by_sequence)


@pytest.mark.parametrize(
    "capacity",
    [pack.Capacity(), pack.Capacity(tokens=32, pieces=3, cost=700), pack.Capacity(tokens=32, cost=1024, rule="dot")],
)
def test_packing(docs_of, tokenizer, capacity):
    docs = [(i, "a b " * (i * i % 23)) for i in range(200)] + [(1000 + i, t) for i, t in enumerate(ODD)]
    ids = {d: encoder(tokenizer).document(t).tolist() for d, t in docs}
    if capacity.cost < capacity.tokens**2:
        docs = [d for d in docs if len(ids[d[0]]) ** 2 <= capacity.cost]
        ids = {d: ids[d] for d, _ in docs}
    rows = pack.pack(docs_of(docs, "offset").repartition(3), tokenizer, capacity).collect()
    used = valid(rows, ids, capacity)
    least = -(-sum(map(len, ids.values())) // capacity.tokens)
    assert used >= least
    if capacity.pieces > capacity.tokens // 2 and capacity.rule == "residual":
        assert used <= least * 1.02 + 1


def test_packing_rows_without_id_and_none(docs_of, tokenizer):
    rows = pack.pack(docs_of([(None, "a"), (None, "a"), (3, "a"), (3, "a")]), tokenizer).collect()
    assert sorted(r.offset for r in rows) == [0, 2, 4, 6] and len({r.sequence_id for r in rows}) == 1
    assert pack.pack(docs_of([]), tokenizer).collect() == []


def best_fit_one_by_one(counts, capacity=1024):
    """Sequences that best fit with decreasing lengths takes, piece by piece."""
    left = []
    for n in sorted(counts, reverse=True):
        for _ in range(counts[n]):
            at = bisect.bisect_left(left, n)
            rest = left.pop(at) - n if at < len(left) else capacity - n
            bisect.insort(left, rest)
    return len(left)


@pytest.mark.parametrize("seed", [4, 5])
def test_plan_takes_as_few_sequences_as_one_by_one(seed):
    rnd = random.Random(seed)
    counts = {n: rnd.randint(1, 9) for n in range(1, 1025) if rnd.random() < 0.8}
    assert pack.plan(counts).sequences <= best_fit_one_by_one(counts)


def test_plan_does_not_grow_with_the_documents():
    counts = {n: 1 + n % 7 for n in range(1, 1025)}
    few, many = pack.plan(counts), pack.plan({n: 10**6 * c for n, c in counts.items()})
    assert len(many.rank) < 3 * len(few.rank) + 20_000


def test_plan_refuses_what_cannot_fit():
    with pytest.raises(ValueError):
        pack.plan({2000: 1})
    with pytest.raises(ValueError):
        pack.plan({1: 1}, pack.Capacity(rule="other"))


class _Counting(dict):
    looked_up = 0

    def __contains__(self, key):
        self.looked_up += isinstance(key, str)
        return super().__contains__(key)

    def __getitem__(self, key):
        self.looked_up += isinstance(key, str)
        return super().__getitem__(key)

    def get(self, key, default=None):
        self.looked_up += 1
        return super().get(key, default)


def test_known_words_are_looked_up_once(tokenizer, library):
    """The work of a batch: one look-up for every different word, long ones are forgotten."""
    e, texts = Encoder(tokenizer), ["the cat sat", "on the mat " + "y" * 500, ""]
    first = [x.tolist() for x in e.documents(texts)]
    assert first == [[*library.encode(t, add_special_tokens=False).ids, END_ID] for t in texts]
    assert not any(len(w) > 64 for w in e._place)
    e._place = _Counting(e._place)
    assert [x.tolist() for x in e.documents(texts[:1])] == first[:1]
    assert e._place.looked_up == 3


def test_words_of_known_runs_are_not_encoded_again(tokenizer, library):
    """New words made of known runs of letters and marks need nothing of the library."""
    e, encoded = Encoder(tokenizer), []
    e.documents(["a house, (cat) b.\nCat b"])
    ids_of = e._ids_of
    e._ids_of = lambda texts: encoded.extend(texts) or ids_of(texts)
    texts = ["a house.\nCat) b, (cat. (b", "a (cat.\nCat, b)"]
    got = [x.tolist() for x in e.documents(texts)]
    assert got == [[*library.encode(t, add_special_tokens=False).ids, END_ID] for t in texts]
    assert encoded == ["b"]  # it had not stood without a space


def test_runs_are_cut_as_by_the_library(library, tokenizer):
    rnd, e = random.Random(12), Encoder(tokenizer)
    assert e._runs
    parts = ["Été", "слово", "ver", "a", "'s", "'", ".", ",%%%", "\n", "\n\n", " ", " ", "  ", "12", "ß", "\u0300", "²", "×",
             "\u037e", "µ", "ª", "¡", "\t", "_", "`", "{|}", "<|endoftext|>", "中", "ǅ", "\u0482", "x" * 70]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(4000)]
    for at in range(0, len(texts), 50):
        some = texts[at : at + 50]
        want = [[*library.encode(t, add_special_tokens=False).ids, END_ID] for t in some]
        assert [x.tolist() for x in e.documents(some)] == want


def test_memory_of_memos_goes_back_once(monkeypatch):
    class Pool:
        released = 0

        def release_unused(self):
            self.released += 1

    pool = Pool()
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: pool)
    monkeypatch.setattr(common.pa, "system_memory_pool", lambda: pool)
    monkeypatch.setattr(common, "_holder", [None, None])
    for owner in ("a", "a", "b", "b"):
        common.claim(owner, lambda: None)
    assert pool.released == 2
