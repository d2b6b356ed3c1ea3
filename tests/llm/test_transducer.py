"""The streaming encoder and decoder against the tokenizers library."""

import hashlib
import itertools
import random
import string

import pytest
from pyspark.sql import functions as F

from cladeweave.llm import transducer
from cladeweave.llm.common import table
from cladeweave.llm.queries import all_queries

from .conftest import ODD

SCRAPS = [" ", "  ", "\n", "a", "e", "t", "'s", "'ll", "'", "é", "中", "1", "23", "!", "—", "\x85", "\x1c", "　", "<|endoftext|>", "<|endof", "the", "ing", "ÃÂ", "́", "😀"]


@pytest.fixture(scope="module")
def vocabulary(tokenizer):
    return transducer.Vocabulary(tokenizer)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_library_however_a_text_is_cut(vocabulary, library, monkeypatch):
    rnd = random.Random(1)
    for n in range(1500):
        monkeypatch.setattr(transducer, "PART", rnd.choice([1, 2, 3, 7, 50]))
        monkeypatch.setattr(transducer, "RUN", rnd.choice([5, 8, 20]))
        text = "".join(rnd.choices(rnd.sample(SCRAPS, rnd.randint(1, 6)), k=rnd.randint(0, 40)))
        ids = transducer.encode_text(vocabulary, text)
        assert ids == ids_of(library, text), repr(text)
        decoder = transducer.Decoder(vocabulary)
        assert "".join(decoder.feed([i]) for i in ids) + decoder.feed([], True) == text


def test_long_pieces_go_through_the_window(vocabulary, library, monkeypatch):
    rnd = random.Random(2)
    runs = [
        "x" * 30_000,
        "".join(rnd.choices(string.ascii_lowercase, k=30_000)),
        "".join(rnd.choices("ÃÂab", k=20_000)),
        " " * 20_000 + "a" + "\n" * 20_000,
        "".join(rnd.choices("-=_*", k=20_000)),
        "7" * 5000,
    ]
    for run, part in itertools.product(runs, [100, 1 << 16]):
        monkeypatch.setattr(transducer, "PART", part)
        for text in (run, f"q {run} z", f"{run}<|endoftext|>{run}'s"):
            assert transducer.encode_text(vocabulary, text) == ids_of(library, text)


def test_open_pieces_need_a_bounded_window(vocabulary):
    encoder = transducer.Encoder(vocabulary)
    for _ in range(50):
        encoder.feed("ab" * 2000)
        assert len(encoder._window) < vocabulary.window and len(encoder._tail) + len(encoder._text) < 100


def merged(rules, text):
    """Ends of the symbols, by merging the rule of lowest rank again and again."""
    symbols = [text[i : i + 1] for i in range(len(text))]
    for left, right in rules:
        i = 0
        while i < len(symbols) - 1:
            if (symbols[i], symbols[i + 1]) == (left, right):
                symbols[i : i + 2] = [left + right]
            i += 1
    return list(itertools.accumulate(map(len, symbols)))


def test_lookahead_is_sufficient_for_random_rules():
    rnd, reached = random.Random(4), 0
    for _ in range(300):
        symbols, rules = [b"a", b"b", b"c"], []
        for _ in range(rnd.randint(2, 12)):
            left, right = rnd.choice(symbols), rnd.choice(symbols)
            if left + right not in symbols and len(left + right) <= 5:
                rules.append((left, right))
                symbols.append(left + right)
        lookahead = transducer.sufficient_lookahead(rules)
        for _ in range(100):
            known = bytes(rnd.choices(b"abc", k=rnd.randint(1, 12)))
            a, b = (merged(rules, known + bytes(rnd.choices(b"abc", k=rnd.randint(0, 6)))) for _ in range(2))
            a, b = ({e for e in ends if e <= len(known)} for ends in (a, b))
            assert {e for e in a ^ b if e <= len(known) - lookahead} == set()
            reached = max([reached, *(len(known) - e for e in a ^ b)])
    assert reached > 3  # the rules do reach back


def test_decoder_equals_library_on_any_ids(vocabulary, library):
    rnd = random.Random(6)
    for _ in range(1500):
        ids = [rnd.randrange(256 if rnd.random() < 0.6 else 50_257) for _ in range(rnd.randint(0, 20))]
        decoder = transducer.Decoder(vocabulary)
        cut = rnd.randint(0, len(ids))
        assert decoder.feed(ids[:cut]) + decoder.feed(ids[cut:], True) == library.decode(ids, skip_special_tokens=False)


def want(library, doc_id, text):
    ids = ids_of(library, text)
    decoded = library.decode(ids, skip_special_tokens=False)
    return doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_odd_documents(spark, docs_of, tokenizer, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "a b"), (None, "a b"), (3, "again"), (3, None)]
    docs = docs_of(rows, extra="ids")
    got = sorted(map(tuple, transducer.digest(docs, tokenizer).collect()), key=str)
    assert got == sorted((want(library, *r) for r in rows), key=str)
    encoded = transducer.encode(docs, tokenizer)
    texts = sorted(map(tuple, transducer.decode(encoded, tokenizer).collect()), key=str)
    assert texts == sorted(((i, t or "") for i, t in rows), key=str)
    assert transducer.digest(docs.filter("false"), tokenizer).collect() == []
    nothing = encoded.withColumn("ids", F.lit(None).cast("array<int>"))
    assert {r.text for r in transducer.decode(nothing, tokenizer).collect()} == {""}


def test_query_equals_library(spark, smallest, library):
    docs = table(spark, smallest, "documents").select("doc_id", "text").collect()
    got = all_queries()["op12_transducer"](spark, smallest)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want(library, *r) for r in docs)
