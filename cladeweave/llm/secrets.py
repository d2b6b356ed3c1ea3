"""Secret scans with corpus-wide ownership.

Patterns find base candidates: assignments of passwords and the like, access keys and
long hexadecimal strings. A further pattern finds loose candidates, mixed strings that
stand alone. The values of all candidates are hashed, and for each hash the distinct
repositories and owners that hold it are counted over the whole corpus. A value with
many owners is an example that people copy; one with few owners is their own and looks
live. Base spans are always reported; a loose one only where its value belongs to few
owners.

Counting goes by (hash, owner, repository) with partial sums, so a value that a third of
all rows hold shuffles as a few rows per task. Reading the counts back joins on the
hash, which Spark can split when one value is hot.

Nulls and odd cases: a null text is empty; a null owner or repository counts as one of
its own, named by the empty text; repeated rows each give a row, but an owner counts
once; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize
from .common import identity, map_batches, same_columns, unused

#: kinds in the order in which equal starts are listed; the last one needs its owners
KINDS = ("assign", "access", "hex", "loose")
LOOSE = "loose"

#: fixed patterns of the base kinds with the least length of what they catch
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: letters of both cases and digits, standing alone
LOOSE_TOKEN = re.compile(
    r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[a-z0-9+/_=-]*[A-Z])(?=[A-Z0-9+/_=-]*[a-z])"
    r"[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])"
)
#: a value with more owners than this is a copied example
MOST_OWNERS = 2

FOUND = (
    "owner string, repo string, doc_id long, _id string, _hash long, row long, "
    "found array<struct<kind:int,start:int,end:int,value_start:int,value_end:int,hash:long>>"
)


def _hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _union(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the disjoint spans that cover the same as the sorted ``spans``."""
    starts, ends = [], []
    for a, b in spans:
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def candidates(text: str | None) -> list[tuple]:
    """(kind, start, end, start and end of the value, its hash) by start and kind."""
    if not text:
        return []
    found = []

    def add(kind: int, m: re.Match, group: int) -> None:
        a, b = m.span(group)
        found.append((kind, *m.span(), a, b, _hash(m[group])))

    if "=" in text or ":" in text:
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST["assign"]:
                add(0, m, 2)
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= LEAST["access"]:
                add(1, m, 0)
    for m in HEX_LONG.finditer(text):
        add(2, m, 0)
    starts, ends = _union(sorted(f[1:3] for f in found))
    for m in LOOSE_TOKEN.finditer(text):
        before = bisect_left(starts, m.end())
        if not before or ends[before - 1] <= m.start():
            add(3, m, 0)
    return sorted(found, key=lambda f: (f[1], f[0]))


#: the runs of HEX that are long enough; shorter ones fail from every start
HEX_LONG = re.compile(r"[0-9a-f]{%d,}" % LEAST["hex"])


def find_candidates(docs: DataFrame, owner: Column, repo: Column) -> DataFrame:
    def batch(rows: dict[str, list]) -> dict[str, list]:
        names = ("kind", "start", "end", "value_start", "value_end", "hash")
        found = [[dict(zip(names, c)) for c in candidates(t)] for t in rows["text"]]
        return {k: v for k, v in rows.items() if k != "text"} | {"found": found}

    picked = docs.select(
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repo.cast("string"), F.lit("")).alias("repo"),
        F.col("doc_id").cast("long"),
        *identity(),
        F.monotonically_increasing_id().alias("row"),
        F.col("text").cast("string"),
    )
    return map_batches(picked, batch, FOUND)


def ownership(found: DataFrame) -> DataFrame:
    """Distinct owners and repositories per hash of a value."""
    values = found.select("owner", "repo", F.explode("found.hash").alias("hash"))
    pairs = values.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one"))
    owners = pairs.groupBy("hash", "owner").agg(F.count("one").alias("repos"))
    return owners.groupBy("hash").agg(F.count("owner").alias("n_owners"), F.sum("repos").alias("n_repos"))


def scan_secrets(
    docs: DataFrame, owner: Column | str = "source", repo: Column | None = None, most_owners: int = MOST_OWNERS
) -> DataFrame:
    """Per row: doc_id, ``_id`` and ``_hash`` as in ``identity``, ``spans`` by start and kind.

    A span has kind, start, end, the bounds of its value, n_owners, n_repos and live.
    """
    owner = F.col(owner) if isinstance(owner, str) else owner
    found = materialize(find_candidates(docs, owner, owner if repo is None else repo), "candidates")
    with_value = found.select("doc_id", "row", F.explode("found").alias("f")).select("*", F.col("f.hash").alias("hash"))
    known = with_value.join(ownership(found), "hash")
    fields = [F.col(f"f.{n}").alias(n) for n in ("start", "kind", "end", "value_start", "value_end")]
    live = (F.col("n_owners") <= most_owners).alias("live")
    spans = (
        known.filter((F.col("f.kind") != KINDS.index(LOOSE)) | live)
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct(*fields, "n_owners", "n_repos", live))).alias("spans"))
    )
    none = F.array().cast(spans.schema["spans"].dataType)
    rows = found.select("doc_id", "_id", "_hash", "row").join(spans, "row", "left").drop("row")
    return rows.withColumn("spans", F.coalesce("spans", none))


def span_text(spans: Column | str) -> Column:
    """kind:start:end of every span, comma-joined."""
    kind = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", kind[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with the values of all spans replaced; overlapping values become one."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(state: Column, s: Column) -> Column:
        a, b = F.greatest(s["value_start"], state["at"]), F.greatest(s["value_end"], state["at"])
        fresh = s["value_start"] >= state["at"]
        between = F.substring(text, state["at"] + 1, a - state["at"])
        return F.struct(
            F.when(fresh, F.concat(state["done"], between, F.lit(mark))).otherwise(state["done"]).alias("done"),
            b.alias("at"),
        )

    by_value = F.array_sort(F.transform(spans, lambda s: F.struct(s["value_start"], s["value_end"])))
    whole = F.aggregate(
        by_value, start, step, lambda s: F.concat(s["done"], F.substring(text, s["at"] + 1, F.length(text)))
    )
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def mask(docs: DataFrame, owner: Column | str = "source") -> DataFrame:
    """``docs`` with the values of all spans masked in ``text`` and ``n_chars`` counted anew."""
    spans = scan_secrets(docs, owner).filter(F.size("spans") > 0).dropDuplicates(["_id", "_hash"])
    id_, hash_, own = unused(docs, "_id", "_hash", "_spans")
    spans = spans.select(F.col("_id").alias(id_), F.col("_hash").alias(hash_), F.col("spans").alias(own))
    met = docs.withColumns(dict(zip((id_, hash_), identity()))).join(spans, [id_, hash_], "left")
    untouched = F.col(own).isNull()
    masked = met.withColumn("text", F.when(untouched, F.col("text")).otherwise(redact(F.col("text"), F.col(own))))
    if "n_chars" in docs.columns:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        masked = masked.withColumn("n_chars", F.when(untouched, F.col("n_chars")).otherwise(counted))
    return same_columns(masked, docs)
