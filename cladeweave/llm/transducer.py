"""BPE encoding and decoding of texts as streams, in constant memory.

Encoding. A text arrives in parts of ``PART`` characters. The pre-tokeniser cuts them into
pieces; a piece is certain as soon as enough characters after it are known. A piece that
goes on and on (more than ``RUN`` characters) is not waited for: its bytes go through a
window. When the window is full it is merged, and the tokens that end at least
``lookahead`` bytes before its end are stable, whatever follows: they are emitted, and the
window goes on behind them.

The lookahead is computed from the merge list. Let two byte strings agree up to some place
and differ after it. The merged symbols can differ before that place only as far as merges
carry the difference to the left: a merge of (u, v) happens in one of them only, since the
symbol that starts at its v was merged further, or not, by an earlier rule (u', v') whose u'
begins v, and so on with ever earlier rules. Such a chain carries the difference over the
bytes of all its u, so the longest chain, by a pass over the rules in order of rank, bounds
how far a token can be from the end of what is known and still change
(:func:`sufficient_lookahead`). A token boundary is never crossed by a merge, so what
follows an emitted token can be merged without it.

Decoding. A state machine reads the bytes of tokens and gives text: its states are the
bytes of a character that is not finished yet, its transitions by token are computed once
per worker. Bytes that are no UTF-8 give U+FFFD per longest wrong beginning, as the library
does.

Special tokens in a text are cut out first, the text on both sides is a text of its own, as
the library has it by default.

Nulls and odd cases: a null text is empty and has no tokens; a text of any length needs the
memory of a part and a window besides itself; repeated rows each give a row, rows without
doc_id too; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import claim, map_batches, utf8

#: characters of a part, characters from which a piece goes through the window
PART, RUN = 1 << 16, 1 << 10
#: bytes of the window beyond the lookahead and the longest token
BLOCK = 1 << 11
#: remembered pieces, and the longest of them
MEMO, MEMO_LENGTH = 500_000, 64

# Fixed by the byte-level pre-tokeniser: the pattern, and how many characters past a match it
# can depend on. The kinds of characters that a long piece consists of are those of the pattern.
PATTERN = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
PEEK = 3
_SPACE = regex.compile(r"\s*")
_KINDS = [regex.compile(r"\p{L}*"), regex.compile(r"\p{N}*"), regex.compile(r"[^\s\p{L}\p{N}]*"), _SPACE]

#: Fixed by UTF-8: first bytes, range of the second byte, length of the character
_LEADS = [
    (0xC2, 0xDF, 0x80, 0xBF, 2),
    (0xE0, 0xE0, 0xA0, 0xBF, 3),
    (0xE1, 0xEC, 0x80, 0xBF, 3),
    (0xED, 0xED, 0x80, 0x9F, 3),
    (0xEE, 0xEF, 0x80, 0xBF, 3),
    (0xF0, 0xF0, 0x90, 0xBF, 4),
    (0xF1, 0xF3, 0x80, 0xBF, 4),
    (0xF4, 0xF4, 0x80, 0x8F, 4),
]
_LEAD = {first: (low, high, n) for a, b, low, high, n in _LEADS for first in range(a, b + 1)}
REPLACEMENT = "�"
#: ids that are decoded together
BLOCK_IDS = 32
#: ids are below 2**_SHIFT; a rank beyond all
_SHIFT, _NO_RULE = 32, 1 << 62


def byte_letters() -> dict[str, int]:
    """Bytes by the letters that stand for them in byte-level vocabularies."""
    own = {b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD}
    others = (b for b in range(256) if b not in own)
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def token_bytes(token: str, letters: dict[str, int]) -> bytes:
    """What a vocabulary entry stands for; one with other letters stands for itself."""
    if all(c in letters for c in token):
        return bytes(letters[c] for c in token)
    return utf8(token)


def sufficient_lookahead(rules: Iterable[tuple[bytes, bytes]]) -> int:
    """Bytes that have to be known after a token so that it cannot change any more.

    ``rules`` in order of rank; both parts of a rule are single bytes or made by rules
    before it.
    """
    begins: dict[bytes, set[bytes]] = {}  # symbols that a symbol grew out of at its left end
    carried: dict[bytes, int] = {}  # longest chain of earlier rules that ends in this left part
    longest = 0
    for left, right in rules:
        chain = max((carried.get(z, 0) for z in (right, *begins.get(right, ()))), default=0)
        chain += len(left)
        carried[left] = max(carried.get(left, 0), chain)
        begins.setdefault(left + right, set()).update({left}, begins.get(left, ()))
        longest = max(longest, chain)
    return longest


class _Memo(dict):
    """Results by piece in two generations: a full young one becomes the old one."""

    def __init__(self, fn):
        self._fn, self._old = fn, {}

    def __missing__(self, piece: str):
        found = self._old.get(piece) or self._fn(piece)
        if len(piece) <= MEMO_LENGTH:
            if len(self) >= MEMO:
                self._old = dict(self)
                self.clear()
            self[piece] = found
        return found


class Vocabulary:
    """A byte-level BPE tokenizer file in the JSON format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cutter = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("not a plain byte-level BPE tokenizer")
        letters = byte_letters()
        raw = lambda token: token_bytes(token, letters)
        self.ids = {raw(token): i for token, i in model["vocab"].items()}
        rules = [tuple(map(raw, m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
        self.ranks = {rule: i for i, rule in enumerate(rules)}
        self.lookahead = sufficient_lookahead(rules)
        self.window = self.lookahead + max(map(len, self.ids)) + BLOCK
        added = spec.get("added_tokens") or []
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that take their surroundings are not supported")
        self.added = {t["content"]: t["id"] for t in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, longest_first))) if added else None
        self.held = max(map(len, self.added), default=1) - 1
        self.bytes = {i: b for b, i in self.ids.items()} | {i: raw(t) for t, i in self.added.items()}
        self.names = {i: str(i) for i in self.bytes}
        #: rules by the ids of both parts, ids that rules make, ids of bytes
        self._rules = {self.ids[a] << _SHIFT | self.ids[b]: i for i, (a, b) in enumerate(rules)}
        self._made = [self.ids[a + b] for a, b in rules]
        self._first = [self.ids.get(bytes((b,))) for b in range(256)]
        self.pieces = _Memo(self._piece)
        self._steps: dict[bytes, dict[int, tuple[str, bytes]]] = {}
        #: texts of tokens that are whole characters
        self.whole = {i: text for i, b in self.bytes.items() for text, state in (advance(b"", b),) if not state}

    def _piece(self, piece: str) -> tuple[int, ...]:
        """Ids of a whole piece; of a short one by looking for the lowest rank each time."""
        data = utf8(piece)
        if len(data) > MEMO_LENGTH:
            return tuple(self.ids[s] for s in self.merge(data))
        if data in self.ids and len(data) == 1:
            return (self.ids[data],)
        rule, made = self._rules.get, self._made
        ids = list(map(self._first.__getitem__, data))
        ranks = [rule(a << _SHIFT | b, _NO_RULE) for a, b in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) != _NO_RULE:
            i = ranks.index(least)
            ids[i] = new = made[least]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rule(ids[i - 1] << _SHIFT | new, _NO_RULE)
            if i < len(ranks):
                ranks[i] = rule(new << _SHIFT | ids[i + 1], _NO_RULE)
        return tuple(ids)

    def merge(self, data: bytes) -> list[bytes]:
        """Symbols of ``data`` when no rule fits any more."""
        ranks, n = self.ranks, len(data)
        if data in self.ids and n == 1 or not n:
            return [data] if n else []
        symbols: list[bytes] = [data[i : i + 1] for i in range(n)]
        ahead, behind = list(range(1, n + 1)), list(range(-1, n - 1))
        open_pairs = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        heapq.heapify(open_pairs)
        while open_pairs:
            rank, i = heapq.heappop(open_pairs)
            j = ahead[i]
            if not symbols[i] or j >= n or ranks.get((symbols[i], symbols[j])) != rank:
                continue
            symbols[i], symbols[j] = symbols[i] + symbols[j], b""
            ahead[i] = after = ahead[j]
            if after < n:
                behind[after] = i
            for a, b in ((behind[i], i), (i, after)):
                if a >= 0 and b < n and (r := ranks.get((symbols[a], symbols[b]))) is not None:
                    heapq.heappush(open_pairs, (r, a))
        return [s for s in symbols if s]

    def steps(self, state: bytes) -> dict[int, tuple[str, bytes]]:
        """Transitions of the decoder out of ``state``: text and next state by token id."""
        if state not in self._steps:
            self._steps[state] = _Transitions(self, state)
        return self._steps[state]


class _Transitions(dict):
    def __init__(self, vocabulary: Vocabulary, state: bytes):
        self._bytes, self._state = vocabulary.bytes, state

    def __missing__(self, token: int):
        self[token] = found = advance(self._state, self._bytes.get(token, b""))
        return found


def advance(state: bytes, data: bytes) -> tuple[str, bytes]:
    """Text that ``data`` completes after the unfinished character ``state``, and the
    unfinished character it ends in."""
    out = []
    for byte in data:
        if state:
            low, high, n = _LEAD[state[0]]
            if len(state) > 1:
                low, high = 0x80, 0xBF
            if low <= byte <= high:
                state += bytes((byte,))
                if len(state) == n:
                    out.append(state.decode("utf-8"))
                    state = b""
                continue
            out.append(REPLACEMENT)
            state = b""
        if byte < 0x80:
            out.append(chr(byte))
        elif byte in _LEAD:
            state = bytes((byte,))
        else:
            out.append(REPLACEMENT)
    return "".join(out), state


class Encoder:
    """Ids of one text that is fed in parts; :meth:`feed` gives the ids that became stable."""

    def __init__(self, vocabulary: Vocabulary):
        self._v = vocabulary
        self._text = ""  # may still hold the beginning of a special token
        self._tail = ""  # begins with a piece and is not certain yet
        self._kind = None  # what the open long piece consists of
        self._window = b""  # bytes of the open long piece that are not emitted

    def feed(self, part: str, last: bool = False) -> list[int]:
        v, text, out = self._v, self._text + part, []
        while v.special and (found := v.special.search(text)):
            out += self._plain(text[: found.start()], True)
            out.append(v.added[found.group()])
            text = text[found.end() :]
        at = len(text) if last else max(0, len(text) - v.held)
        self._text = text[at:]
        return out + self._plain(text[:at], last)

    def _plain(self, part: str, last: bool) -> list[int]:
        text, out = self._tail + part, []
        self._tail = ""
        if self._kind:
            end = self._kind.match(text).end()
            if end == len(text) and not last:  # of white space the last one may belong to what follows
                end -= self._kind is _SPACE and end > 0
                self._tail = text[end:]
                return self._push(text[:end], False)
            end -= self._kind is _SPACE and 0 < end < len(text)
            out += self._push(text[:end], True)
            text = text[end:]
        pieces = PATTERN.findall(text)
        if not last:
            held, first = 0, len(pieces)
            while first and held < PEEK:
                first -= 1
                held += len(pieces[first])
            open_, pieces = pieces[first:], pieces[:first]
            self._tail = "".join(open_)
            if len(open_) == 1 and held > RUN:
                self._kind = next(k for k in _KINDS if k.fullmatch(self._tail[-1]))
                kept = self._tail[-1] if self._kind is _SPACE else ""
                start, self._tail = self._tail[: held - len(kept)], kept
                out += chain.from_iterable(map(self._v.pieces.__getitem__, pieces))
                return out + self._push(start, False)
        out += chain.from_iterable(map(self._v.pieces.__getitem__, pieces))
        return out

    def _push(self, part: str, closed: bool) -> list[int]:
        """Add to the open piece; its end is known when it is ``closed``."""
        v, out = self._v, []
        data = memoryview(utf8(part))
        while True:
            room = v.window - len(self._window)
            self._window += data[:room]
            data = data[room:]
            full = len(self._window) == v.window
            if not full and not closed:
                return out
            symbols, end = v.merge(self._window), 0
            stable = len(self._window) if closed and not data else len(self._window) - v.lookahead
            for s in symbols:
                if end + len(s) > stable:
                    break
                out.append(v.ids[s])
                end += len(s)
            self._window = self._window[end:]
            if closed and not data and not self._window:
                self._kind = None
                return out


def parts(text: str) -> Iterator[tuple[str, bool]]:
    for at in range(0, max(len(text), 1), PART):
        yield text[at : at + PART], at + PART >= len(text)


class Decoder:
    """Text of ids that are fed in parts."""

    def __init__(self, vocabulary: Vocabulary):
        self._v, self._state = vocabulary, b""

    def feed(self, ids: list[int], last: bool = False) -> str:
        out = []
        for at in range(0, len(ids), BLOCK_IDS):
            block = ids[at : at + BLOCK_IDS]
            if not self._state:  # mostly every token is whole characters
                whole = list(map(self._v.whole.get, block))
                if None not in whole:
                    out += whole
                    continue
            for i in block:
                text, self._state = self._v.steps(self._state)[i]
                out.append(text)
        if last and self._state:
            out.append(REPLACEMENT)
            self._state = b""
        return "".join(out)


@lru_cache(maxsize=1)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def vocabulary(path: str) -> Vocabulary:
    claim("transducer", _vocabulary.cache_clear)
    return _vocabulary(path)


def encode_text(v: Vocabulary, text: str | None) -> list[int]:
    encoder = Encoder(v)
    return [i for part, last in parts(text or "") for i in encoder.feed(part, last)]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id`` and ``ids`` of every document."""

    def batch(rows: dict[str, list]) -> dict[str, list]:
        v = vocabulary(tokenizer)
        return {"doc_id": rows["doc_id"], "ids": [encode_text(v, t) for t in rows["text"]]}

    return map_batches(_texts(docs), batch, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id`` and ``text`` of every row of ``doc_id`` and ``ids``; null ids are empty."""

    def batch(rows: dict[str, list]) -> dict[str, list]:
        v = vocabulary(tokenizer)
        return {"doc_id": rows["doc_id"], "text": [Decoder(v).feed(ids or (), True) for ids in rows["ids"]]}

    return map_batches(encoded.select("doc_id", "ids"), batch, "doc_id long, text string")


def _round_trip(v: Vocabulary, text: str | None) -> tuple[int, str, str]:
    """Number of ids, hash of the ids, hash of what they decode to; both made on the way."""
    encoder, decoder = Encoder(v), Decoder(v)
    ids_hash, text_hash, n = hashlib.sha256(), hashlib.sha256(), 0
    for part, last in parts(text or ""):
        ids = encoder.feed(part, last)
        if ids:
            comma = "," if n else ""
            ids_hash.update((comma + ",".join(map(v.names.__getitem__, ids))).encode())
            n += len(ids)
        text_hash.update(utf8(decoder.feed(ids, last)))
    return n, ids_hash.hexdigest(), text_hash.hexdigest()


def digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, and SHA-256 of the decimal ids and of the decoded text."""

    def batch(rows: dict[str, list]) -> dict[str, list]:
        v = vocabulary(tokenizer)
        found = [_round_trip(v, t) for t in rows["text"]]
        n, ids, texts = map(list, zip(*found)) if found else ([], [], [])
        return {"doc_id": rows["doc_id"], "n_tokens": n, "ids_sha256": ids, "decoded_sha256": texts}

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(_texts(docs), batch, schema)
