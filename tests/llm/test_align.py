"""Alignment of two tokenizers against the libraries and a double loop."""

import hashlib
import random
from collections import Counter

import pytest

from cladeweave.llm import align
from cladeweave.llm.common import table
from cladeweave.llm.queries import all_queries, tokenizer_path

from .conftest import ODD

SCRAPS = [" ", "  ", "\n", "a", "e", "the", "x", "'s", "é", "中", "1", "23", "!", "—", "\x85", "\x1c", "　", "<|endoftext|>", "▁", "<s>", "<0x41>", "</s>", "\x00", "😀", "\t", "ﬁ", "́"]


@pytest.fixture(scope="module")
def tokens_of(tokenizer):
    """Ids and bytes of a text's tokens, straight from the libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(c): c for c in printable}
    letters |= {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in printable)}

    def tokens(text):
        if not text:
            return [], []
        by_a = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        by_b = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            by_b.append((i, bytes.fromhex(piece[3:5]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        same = all(b"".join(t for _, t in by) == (" " + text).encode() for by in (by_a, by_b))
        return (by_a, by_b) if same else ([], [])

    return tokens


def ends_of(tokens):
    at, found = 0, {}
    for place, (i, raw) in enumerate(tokens):
        at += len(raw)
        found[at] = place, i
    return found


def brute(tokens_of, rows):
    """All columns of the contract for (doc_id, text) rows."""
    links, shapes = [], []
    for doc_id, text in rows:
        a, b = tokens_of(text)
        ends_a, ends_b = ends_of(a), ends_of(b)
        groups, i, j, linked = [], 0, 0, []
        for end in sorted(set(ends_a) & set(ends_b)):
            (p, x), (q, y) = ends_a[end], ends_b[end]
            groups.append(",".join(str(t) for t, _ in a[i : p + 1]) + "|" + ",".join(str(t) for t, _ in b[j : q + 1]))
            i, j = p + 1, q + 1
            linked.append((x, y))
        links.append(linked)
        shapes.append((doc_id, len(a), len(b), len(groups), len(linked), ";".join(groups)))
    count = Counter(x for linked in links for x in linked)
    most = {}
    for (_, y), n in count.items():
        most[y] = max(most.get(y, 0), n)
    return [
        (*shape, sum(count[x] == most[x[1]] for x in linked), sum(count[x] for x in linked))
        for shape, linked in zip(shapes, links)
    ]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]


def aligned(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_gallop():
    rnd = random.Random(2)
    for _ in range(2000):
        a, b = (sorted(rnd.sample(range(600), rnd.randint(0, n))) for n in (20, 500))
        a, b = (a, b) if rnd.random() < 0.5 else (b, a)
        common = [x for x in a if x in b]
        assert align.gallop(a, b) == ([a.index(x) for x in common], [b.index(x) for x in common])


@pytest.mark.parametrize("broadcast_rows", [10**6, 0])
def test_odd_documents(spark, docs_of, tokenizer, tokens_of, broadcast_rows):
    rnd = random.Random(3)
    rows = [(i, t if t is None or len(t) < 10_000 else t[:9000]) for i, t in enumerate(ODD)]
    rows += [(None, "the cat"), (None, "the cat"), (3, None), (3, "sat  on the mat "), (4, " led"), (5, "cat\nthe cat ")]
    rows += [(100 + k, "".join(rnd.choices(rnd.sample(SCRAPS, rnd.randint(1, 7)), k=rnd.randint(0, 30)))) for k in range(400)]
    docs = docs_of(rows, extra="row").withColumnRenamed("lang", "pairs")
    got = align.align(docs, tokenizer, tokenizer_path("piece_bpe_32k.model"), broadcast_rows=broadcast_rows)
    assert aligned(got) == sorted(brute(tokens_of, rows), key=str)


def test_counts_are_handed_on_in_parts(spark, docs_of, tokenizer, tokens_of, monkeypatch):
    other = tokenizer_path("piece_bpe_32k.model")
    monkeypatch.setattr(align, "CHUNK", 3)
    keys = align.np.arange(10)
    parts = list(align._count_rows(keys, keys + 1, align.to_arrow_schema(align._LINKED)))
    assert [p.column(7)[0].as_py() for p in parts] == [[0, 1, 2], [3, 4, 5], [6, 7, 8], [9]]
    empty = docs_of([(1, "a")]).filter("false")
    assert align.align(empty, tokenizer, other).collect() == []


def test_one_long_word_and_many_words_agree(tokenizer, tokens_of):
    pair = align.Pair(tokenizer, tokenizer_path("piece_bpe_32k.model"))
    for text in ("x" * 4000, "the cat " * 3000 + "end", "中文" * 1000, "a  b " * 500 + "c"):
        batch = align._Batch(pair, ["q", text, ""], False)
        ((*_, groups, _, _),) = brute(tokens_of, [(1, text)])
        assert batch.groups[1] == groups and batch.groups[2] == "" and pair.whole(text).groups == groups


def test_query_equals_libraries(spark, smallest, tokens_of):
    docs = [tuple(r) for r in table(spark, smallest, "documents").select("doc_id", "text").collect()]
    got = all_queries()["op13_align"](spark, smallest).withColumnRenamed("groups_sha256", "groups")
    hashed = [
        (*r[:5], hashlib.sha256(r[5].encode()).hexdigest() if r[5] else "", *r[6:]) for r in brute(tokens_of, docs)
    ]
    assert aligned(got) == sorted(hashed, key=str)
