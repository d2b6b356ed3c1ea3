"""Repair of conversations: the cheapest edits that make turns alternate.

A conversation may begin with a system message and then goes user, assistant, user,
assistant. Rows have faults: blank (nothing but white space), duplicate (role and text seen
earlier), truncated (no full stop, exclamation or question mark at the end). Edits are Keep
(0), Rerole to user or assistant (3), Delete (4; blank rows and duplicates have to go) and
Insert of an empty message (3); a truncated row that stays adds 3. Of the cheapest ways the
one whose initials are least in ASCII order is taken: the *audit*.

:func:`search` is iterative-deepening A*. A state is the place in the conversation and the
role before; depth-first search tries the edits in ASCII order under a cost bound and prunes
by a lower bound of what is left; the bound rises to the least cost that was cut off. States
that failed are kept in a transposition table with the cost that they at least need, which
is what their successors need, so a state is searched again only under a larger budget. As
nothing is cut off but what cannot be accepted under the bound, the first path accepted is
the least.

The lower bound: blank rows and duplicates cost 4, truncated rows 3. Of the other rows,
neighbours that must not follow each other form chains. An edit mends at most two
neighbouring faults of a chain and never faults of two chains, so a chain of m needs at
least m / 2 edits of 3; deleting a truncated row costs only 1 more than keeping it and
mends one fault of a chain, or two if the row could not stay where it is.

Two sorted passes over the rows of a conversation run in a task with little memory: the
first sees no texts, only a letter for role and faults and a digest for duplicates, and
gives the audit; the second walks through the rows beside their audit, text by text.

Nulls and odd cases: null role or text count as one space; null turns come first; rows of
one turn follow in the order of role and digest of the text; rows without conv_id are one
conversation; a conversation without rows has an empty audit; roles other than by their first
letter s, u and a cannot stay; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import steps

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: signatures up to this length are remembered, and how many
MEMO_LENGTH, MEMO = 64, 1 << 16
WHITE = " \t\n\v\f\r"
STOPS = (".", "!", "?")

# Letters of a signature: role of a row, in capitals when truncated; a row that has to go.
GONE = "x"
START = "^"
END = "$"
#: what may follow what
_FOLLOWS = {START: "su" + END, "s": "u", "u": "a", "a": "u" + END, "o": ""}
#: the role that an edit gives, by the role before
_NEXT = {START: "u", "s": "u", "u": "a", "a": "u"}
ROLES = {"u": "user", "a": "assistant"}

AUDIT_SCHEMA = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [T.StructField("audit", T.StringType())]
)
REPAIRED_SCHEMA = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("place", T.LongType())]
    + [T.StructField(n, T.StringType()) for n in ("role", "text")]
)


class _Bound:
    """Least cost of what is left of a signature, by place and role before."""

    def __init__(self, signature: str):
        rows = [c for c in signature if c != GONE]
        self._rows = [c.lower() for c in rows]
        roles = [*self._rows, END]
        n = len(rows)
        # the first row that may stay at or after a place, and costs that are certain
        self._row = [*accumulate((c != GONE for c in signature), initial=0)]
        fixed = [DELETE if c == GONE else TRUNCATED if c.isupper() else 0 for c in signature]
        self._fixed = [*accumulate(reversed(fixed), initial=0)][::-1]
        # truncated rows, those that cannot stay counted apart
        misfit = [c.isupper() and (r in "so" or r == "a" and roles[k + 1] == "s") for k, (c, r) in enumerate(zip(rows, roles))]
        self._misfits = [*accumulate(misfit, initial=0)]
        self._cheap = [*accumulate((c.isupper() and not m for c, m in zip(rows, misfit)), initial=0)]
        bad = [b not in _FOLLOWS[a] for a, b in zip(roles, roles[1:])]
        self._run, self._chains = [0] * (n + 1), [0] * (n + 2)
        for k in reversed(range(n)):
            if bad[k]:
                self._run[k] = self._run[k + 1] + 1
                self._chains[k] = self._chain(k, 0) + self._chains[k + self._run[k]]
            else:
                self._chains[k] = self._chains[k + 1]
        self._n = n

    def _chain(self, k: int, before: int) -> int:
        """Least cost of the chain of faults from row ``k`` on, and ``before`` it."""
        faults, end = before + self._run[k], min(k + self._run[k], len(self._rows) - 1) + 1
        misfits = min(self._misfits[end] - self._misfits[k], -(-faults // 2))
        cheap = self._cheap[end] - self._cheap[k]
        best = None
        for two in {misfits, max(misfits - 1, 0)}:
            left = max(faults - 2 * two, 0)
            most = min(cheap, left)
            for one in {most, max(most - 1, 0), 0}:
                cost = two + one + REROLE * -(-(left - one) // 2)
                best = cost if best is None else min(best, cost)
        return best

    def __call__(self, place: int, role: str) -> int:
        k = self._row[place]
        after = self._rows[k] if k < self._n else END
        if after in _FOLLOWS[role]:
            return self._fixed[place] + self._chains[k]
        if k == self._n:
            return self._fixed[place] + INSERT
        return self._fixed[place] + self._chain(k, 1) + self._chains[k + self._run[k]]


def _edits(signature: str, place: int, role: str) -> Iterator[tuple[str, int, int, str]]:
    """Edits in ASCII order: initial, cost, next place and role."""
    row = signature[place] if place < len(signature) else None
    if row is not None:
        yield "D", DELETE, place + 1, role
    yield "I", INSERT, place, _NEXT[role]
    if row is not None and row != GONE:
        more = TRUNCATED if row.isupper() else 0
        if row.lower() in _FOLLOWS[role]:
            yield "K", KEEP + more, place + 1, row.lower()
        yield "R", REROLE + more, place + 1, _NEXT[role]


def _search(signature: str) -> tuple[str, int]:
    bound, n = _Bound(signature), len(signature)
    needs: dict[tuple[int, str], int] = {}  # transposition table: what failed states need

    def need(place: int, role: str) -> int:
        known = needs.get((place, role))
        return bound(place, role) if known is None else known

    while True:
        limit = need(0, START)
        # place, role, what may still be spent, edits to try, least need of those cut off
        path = [[0, START, limit, _edits(signature, 0, START), None]]
        audit: list[str] = []
        while path:
            frame = path[-1]
            place, role, budget = frame[:3]
            if place == n and END in _FOLLOWS[role]:
                return "".join(audit), limit
            for edit, cost, after, next_role in frame[3]:
                least = cost + need(after, next_role)
                if least <= budget:
                    audit.append(edit)
                    path.append([after, next_role, budget - cost, _edits(signature, after, next_role), None])
                    break
            else:
                needs[place, role] = min(c + need(p, r) for _, c, p, r in _edits(signature, place, role))
                path.pop()
                if audit:
                    audit.pop()


_remembered = lru_cache(maxsize=MEMO)(_search)


def search(signature: str) -> tuple[str, int]:
    """Audit and cost of a conversation given as letters: ``s u a o`` for the roles by first
    letter, in capitals if truncated, ``x`` for a row that has to go."""
    return (_remembered if len(signature) <= MEMO_LENGTH else _search)(signature)


# --- on Spark --------------------------------------------------------------------------


def _facts(messages: DataFrame) -> DataFrame:
    """What the search has to know of every row, without its text."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit(" ")), F.coalesce(F.col("text").cast("string"), F.lit(" "))
    body, initial = F.rtrim(F.col("_text"), F.lit(WHITE)), F.substring("_role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    ended = F.right(body, F.lit(1)).isin(*STOPS)
    faulty = F.when(body == "", GONE).when(ended, letter).otherwise(F.upper(letter))
    dropped = F.col("dropped") if "dropped" in messages.columns else F.lit(False)
    plain = messages.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("_role"), text.alias("_text"), dropped.alias("_dropped")
    )
    digest = F.unhex(F.md5(F.concat_ws(":", F.length("_role"), "_role", "_text")))
    return plain.select(
        "conv_id", "turn", F.col("_role").alias("role"), F.col("_text").alias("text"),
        digest.alias("digest"), letter.alias("letter"), faulty.alias("faulty"), F.col("_dropped").alias("dropped"),
    )


_ORDER = ["turn", "role", "digest"]


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", *first, *_ORDER)]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


class _Conversation:
    """Facts of the rows of one conversation as they come."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self._signature: list[str] = []
        self._seen: set[bytes] = set()
        self._last, self._turn = None, None
        self._low = None
        self._distinct = self._blank = self._duplicate = self._illegal = 0

    def add(self, turn: int | None, digest: bytes, letter: str, faulty: str) -> None:
        if turn is not None and turn != self._turn:
            self._low = turn if self._low is None else self._low
            self._turn = turn
            self._distinct += 1
        if self._last is not None and (letter == "o" or letter not in _FOLLOWS[self._last]):
            self._illegal += 1
        self._last = letter
        repeated = digest in self._seen
        self._seen.add(digest)
        self._blank += faulty == GONE
        self._duplicate += repeated and faulty != GONE
        self._signature.append(GONE if repeated else faulty)

    def row(self) -> tuple:
        signature = "".join(self._signature)
        audit, cost = search(signature)
        gaps = 0 if self._low is None else self._turn - self._low + 1 - self._distinct
        cut = sum(c.isupper() for c in signature)
        return self.conv_id, gaps, self._blank, self._duplicate, cut, self._illegal, cost, audit


_NOBODY = object()


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def audits(messages: DataFrame) -> DataFrame:
    """Faults, cost and audit of every conversation of ``messages`` (conv_id, turn, role,
    text). Rows with a true ``dropped``, if there is such a column, do not count as rows,
    but their conversation is there."""
    arrow = to_arrow_schema(AUDIT_SCHEMA)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        at = None
        for batch in batches:
            for conv_id, turn, digest, letter, faulty, dropped in zip(*(c.to_pylist() for c in batch.columns)):
                if at is None or conv_id != at.conv_id:
                    if at is not None:
                        yield at.row()
                    at = _Conversation(conv_id)
                if not dropped:
                    at.add(turn, digest, letter, faulty)
        if at is not None:
            yield at.row()

    slim = _facts(messages).drop("text")
    ordered = _in_order(slim).select("conv_id", "turn", "digest", "letter", "faulty", "dropped")
    return ordered.mapInArrow(lambda batches: _batches(rows(batches), arrow), AUDIT_SCHEMA)


def _edited(audit: str, next_row: Callable[[], tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Role and text of the repaired rows of a conversation."""
    before = START
    for edit in audit:
        if edit == "D":
            next_row()
        elif edit == "I":
            before = _NEXT[before]
            yield ROLES[before], ""
        else:
            role, text = next_row()
            before = role[:1] if edit == "K" else _NEXT[before]
            yield (role if edit == "K" else ROLES[before]), text


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[tuple[str, str]]]]:
    """Every conversation's audit row, and its repaired rows, which have to be read first."""
    rows = (row for batch in steps(batches) for row in batch.to_pylist())
    for found in rows:  # an audit stands before the rows that it speaks of

        def next_row() -> tuple[str, str]:
            row = next(rows)
            return row["role"], row["text"]

        yield found, _edited(found["audit"], next_row)


def _beside_audits(messages: DataFrame, found: DataFrame) -> DataFrame:
    rows = _facts(messages).filter(~F.col("dropped")).select("conv_id", *_ORDER, "text")
    return _in_order(found.unionByName(rows, allowMissingColumns=True).withColumn("_row", F.col("audit").isNull()), "_row")


def apply(messages: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, place (from 0), role, text. ``found`` is what
    :func:`audits` gave for ``messages``; store it before, it is read beside them."""
    arrow = to_arrow_schema(REPAIRED_SCHEMA)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for at, repaired in _repaired(batches):
            for place, (role, text) in enumerate(repaired):
                yield at["conv_id"], place, role, text

    return _beside_audits(messages, found).mapInArrow(lambda b: _batches(rows(b), arrow, 256), REPAIRED_SCHEMA)


def digests(messages: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with ``repaired_sha256``: hash of the repaired ``role:text``, a line each."""
    schema = T.StructType([*AUDIT_SCHEMA.fields, T.StructField("repaired_sha256", T.StringType())])
    arrow = to_arrow_schema(schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for at, repaired in _repaired(batches):
            hashed = hashlib.sha256()
            for place, (role, text) in enumerate(repaired):
                hashed.update((("\n" if place else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            yield *(at[f.name] for f in AUDIT_SCHEMA.fields), hashed.hexdigest()

    return _beside_audits(messages, found).mapInArrow(lambda b: _batches(rows(b), arrow), schema)


# --- damage, for trials ------------------------------------------------------------------


def damage(messages: DataFrame) -> DataFrame:
    """``messages`` with faults put in by a hash of conversation and turn: of twenty rows one
    is dropped (it stays, marked ``dropped``), one emptied, one robbed of its stops, one
    repeated, one given to the user. Null columns become one space."""
    space = F.lit(" ")
    text_of = lambda name: F.coalesce(F.col(name).cast("string"), space)
    draw: Column = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    drawn = messages.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), draw.alias("_draw"))
    text = F.when(F.col("_draw") == 1, "").when(F.col("_draw") == 2, F.translate("text", "".join(STOPS), "")).otherwise(F.col("text"))
    damaged = drawn.select(
        "conv_id", "turn", F.when(F.col("_draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), (F.col("_draw") == 0).alias("dropped"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("_draw") == 3, 2).otherwise(1))).alias("_copy"),
    )
    return damaged.drop("_copy")
