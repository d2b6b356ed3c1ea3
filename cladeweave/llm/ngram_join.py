"""N-gram Jaccard self-join: which documents share enough of their word shingles.

Documents link when 100 * intersection >= percent * union of their shingle sets; the
result is each document's set size and connected component. It is exact up to 64-bit
hashes of shingles and 128-bit hashes of sets.

Vectors of hash-group counts bound the overlap (``count_rtree``), but an R-tree over
a whole corpus cannot be cut up so that every task has a share: unrelated sets of like
size are near each other in every few coordinates. So blocks are formed first: linked
sets share one of their first ``size - ceil(percent% of size) + 1`` tokens in any common
order of tokens, and each such token is a block. The order puts frequent tokens last,
which keeps passages that many documents share out of the blocks. Candidates of the
blocks are bounded by their count vectors and the rest is verified on the whole sets.

1. A scan counts the tokens that repeat within a task; sums over all tasks give the most
   frequent ones (``FREQUENT`` at most; which ones only changes the order).
2. A second scan makes per document its size, fingerprint and first tokens, at least all
   infrequent ones whose hash lies in the first ``SAMPLE`` of the range. Equal sets of a
   task are one node. Tokens travel packed by bucket of their hash, tokens that are
   estimated above ``SPLIT`` in several buckets.
3. Per bucket, tokens with two nodes or more stay. Of the sampled tokens of a linked set,
   all but (100 - percent)% of its size are tokens of another set, so nodes with fewer
   such tokens go, twice over. What is left is mostly groups of copies; their whole sets
   and points are made.
4. Each node is paired with the first node of its token. These pairs, as many as places
   in blocks, are bounded and verified; their components usually are whole groups.
5. Only tokens whose nodes lie in different components are left, one for each set of nodes.
   Blocks of one leaf are joined without a tree. The nodes of every other one, or of all
   that have the same first node and mostly the same others, are a block with an R-tree of
   their points. Pairs from different components that the tree cannot rule out are verified
   where they are found, and what links joins its components for the rest of the block: a
   block gives fewer links than it has nodes, however many pairs it holds. Blocks above
   ``BLOCK`` nodes or ``BLOCK_TOKENS`` tokens are cut into parts that meet pairwise.

``ngram_links`` counts links and so takes no short cut by components: in place of steps 4
and 5 every token with several nodes is a block, every pair of different sets in a block
that the bounds cannot rule out is a row that is verified, and a link of two sets counts
once for each copy.

A pair that shares a first token thus is in one component after step 4 or is looked at in
step 5; no link between different sets is lost, and copies are never expanded.

Nulls and odd cases: null or wordless texts have an empty set, link with nothing and are
their own component; documents of fewer words than a shingle have one; rows without
doc_id take part but name no component unless alone; repeated rows each give a row; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..runtime import materialize, shuffled, temporary
from .common import fields, identity, record, same_columns, steps, unused
from .components import components
from .count_rtree import FANOUT, CountTree, group_counts, may_link, overlap_bound, read_points
from .shingles import fingerprint, shingles
from .unions import Unions

PERCENT = 75
FREQUENT = 1 << 18
#: a token counts as repeated in a task from this many documents on
REPEATED = 2
#: tokens counted at a time in a task
WINDOW = 1 << 22
#: first tokens a bucket should hold, nodes of a token from which it is split, of a block
BUCKET, SPLIT, BLOCK = 500_000, 200_000, 4096
#: tokens of all sets of a block
BLOCK_TOKENS = 1 << 22
#: share of the range of hashes whose tokens are all compared
SAMPLE = 3 / 8

_COUNTS = fields("token long, n long")
_SIGNED = fields(
    "node long, doc_id long, row long, size int, hi long, lo long, sampled int, "
    "bucket long, base long, tokens binary, nodes binary"
)
_PACKED = fields("tokens binary, counts binary")
_MET = fields("token long, node long, sampled int")
_PAIR = fields("a long, b long")
_SET = fields("node long, size int, point binary, tokens binary")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
    """doc_ids, hashes of the row and texts in steps of bounded size."""
    for batch in steps(batches):
        yield tuple(batch.column(name).to_pylist() for name in ("doc_id", "row", "text"))


def prefix_length(size: int, percent: int = PERCENT) -> int:
    return size - -(-size * percent // 100) + 1


def _repeated(docs: DataFrame) -> DataFrame:
    """Tokens with their documents, as far as they repeat within a task; token null: all."""
    arrow = to_arrow_schema(_COUNTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, total, known = [], 0, 0, set()

        def flush():
            token, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= REPEATED
            return record([token[often].view(np.int64), n[often]], arrow)

        for _, _, texts in _texts(batches):
            for text in texts:
                tokens = shingles(text)
                print_ = fingerprint(tokens)
                if print_ in known:
                    continue
                known.add(print_)
                held.append(tokens)
                size += len(tokens)
                if size >= WINDOW:
                    yield flush()
                    held, size, total, known = [], 0, total + size, set()
        if size:
            yield flush()
        yield record([[None], [total + size]], arrow)

    return docs.mapInArrow(count, _COUNTS).groupBy("token").agg(F.sum("n").alias("n"))


def _sample_end() -> np.uint64:
    return np.uint64(int(SAMPLE * 2**64))


class Order:
    """The common order of tokens: rare ones by hash, then frequent ones by count."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        by = np.argsort(tokens)
        self._tokens, self._counts = tokens[by], counts[by]

    @staticmethod
    def of(repeated: DataFrame) -> "Order":
        """By the ``FREQUENT`` tokens of the highest counts, which reach the driver packed."""
        top = repeated.filter("token IS NOT NULL").orderBy(F.desc("n"), "token").limit(FREQUENT)
        arrow = to_arrow_schema(_PACKED)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield record([[batch.column(c).to_numpy().tobytes()] for c in (0, 1)], arrow)

        rows = top.select("token", "n").mapInArrow(pack, _PACKED).collect()
        tokens, counts = (b"".join(bytes(r[c]) for r in rows) for c in (0, 1))
        return Order(np.frombuffer(tokens, np.uint64), np.frombuffer(counts, np.int64))

    def first(self, tokens: np.ndarray, n: int) -> tuple[np.ndarray, int]:
        """The first ``n`` tokens or all sampled ones if more, and the number of the latter."""
        count = self.counts(tokens)
        rare = tokens[count == 0]
        sampled = int(np.searchsorted(rare, _sample_end()))
        if len(rare) >= n:
            return rare[: max(n, sampled)], sampled
        often = tokens[count > 0]
        return np.concatenate([rare, often[np.lexsort((often, count[count > 0]))][: n - len(rare)]]), sampled

    def counts(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self._tokens):
            return np.zeros(len(tokens), np.int64)
        at = np.minimum(np.searchsorted(self._tokens, tokens), len(self._tokens) - 1)
        return np.where(self._tokens[at] == tokens, self._counts[at], 0)


def _buckets(tokens: np.ndarray, order: Order, part: int, n: int) -> np.ndarray:
    """Bucket by the token's hash; a very frequent token goes by task as well."""
    splits = order.counts(tokens) // SPLIT + 1
    return ((tokens >> np.uint64(7)) % np.uint64(n) + np.uint64(part) % splits.astype(np.uint64)) % np.uint64(n)


def _sign(docs: DataFrame, order, n_buckets: int, percent: int) -> DataFrame:
    arrow = to_arrow_schema(_SIGNED)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        known: dict[tuple[int, int], int] = {}
        number = part << 33
        for doc_ids, hashes, texts in _texts(batches):
            base, rows, firsts, owners = number, [], [], []
            for doc_id, row, text in zip(doc_ids, hashes, texts):
                tokens = shingles(text)
                if not len(tokens):
                    rows.append((None, doc_id, row, 0, None, None, None))
                    continue
                print_ = fingerprint(tokens)
                node = known.get(print_)
                sampled = None
                if node is None:
                    known[print_] = node = number
                    number += 1
                    first, sampled = order.value.first(tokens, prefix_length(len(tokens), percent))
                    firsts.append(first)
                    owners.append(np.full(len(firsts[-1]), node - base, "<u4"))
                rows.append((node, doc_id, row, len(tokens), *print_, sampled))
            if len(known) > 1 << 19:
                known.clear()
            if rows:
                columns = [list(c) for c in zip(*rows)]
                yield record([*columns, *([[None] * len(rows)] * 4)], arrow)
            if firsts:
                tokens, owner = np.concatenate(firsts), np.concatenate(owners)
                bucket = _buckets(tokens, order.value, part, n_buckets).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                bucket, tokens, owner = bucket[by], tokens[by], owner[by]
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                starts, ends = [0, *cuts], [*cuts, len(bucket)]
                packed = [
                    bucket[starts],
                    np.full(len(starts), base),
                    [tokens[a:b].tobytes() for a, b in zip(starts, ends)],
                    [owner[a:b].tobytes() for a, b in zip(starts, ends)],
                ]
                yield record([*([[None] * len(starts)] * 7), *packed], arrow)

    return docs.mapInArrow(sign, _SIGNED)


def _meet(signed: DataFrame, order) -> DataFrame:
    """Tokens with two nodes or more: token, node, whether the token is a sampled one."""
    arrow = to_arrow_schema(_MET)

    def meet(rows: pa.Table) -> pa.Table:
        tokens = np.concatenate([np.frombuffer(t, np.uint64) for t in rows.column("tokens").to_pylist()])
        nodes = np.concatenate(
            [
                np.frombuffer(n, "<u4").astype(np.int64) + base
                for n, base in zip(rows.column("nodes").to_pylist(), rows.column("base").to_pylist())
            ]
        )
        by = np.lexsort((nodes, tokens))
        tokens, nodes = tokens[by], nodes[by]
        starts = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
        lengths = np.diff(np.r_[starts, len(tokens)])
        count = order.value.counts(tokens)
        shared = np.repeat(lengths > 1, lengths) | (count >= SPLIT)
        sampled = (count == 0) & (tokens < _sample_end())
        columns = [tokens[shared].view(np.int64), nodes[shared], sampled[shared].astype(np.int32)]
        return pa.Table.from_arrays([pa.array(c) for c in columns], schema=arrow)

    packed = signed.filter("bucket IS NOT NULL").select("bucket", "base", "tokens", "nodes")
    return packed.groupBy("bucket").applyInArrow(meet, _MET)


def _of_several(met: DataFrame) -> DataFrame:
    """Rows of the tokens that several nodes have."""
    several = met.groupBy("token").agg(F.min("node").alias("first"), F.max("node").alias("_last"))
    return met.drop("first").join(several.filter("first < _last").drop("_last"), "token")


def _promising(met: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Rows of the nodes that have enough tokens in common with others."""
    hits = met.groupBy("node").agg(F.sum("sampled").alias("hits"))
    own = F.floor(F.col("size") * (100 - percent) / F.lit(100))
    enough = hits.join(points.select("node", "size", "sampled"), "node").filter(F.col("hits") >= F.col("sampled") - own)
    return _of_several(met.join(enough.select("node"), "node"))


def _bounded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that the sum of coordinate minima does not rule out."""
    a = sets.select(F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("point").alias("point_a"))
    b = sets.select(F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("point").alias("point_b"))
    arrow = to_arrow_schema(_PAIR)

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
            (p, over_p), (q, over_q) = (read_points(batch.column(n).to_pylist()) for n in ("point_a", "point_b"))
            sizes = get("size_a").astype(np.int64) + get("size_b")
            keep = may_link(overlap_bound(p, q, over_p, over_q), sizes, percent)
            yield record([get("a")[keep], get("b")[keep]], arrow)

    least, most = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    return pairs.join(a, "a").join(b, "b").filter(least * 100 >= most * percent).mapInArrow(bound, _PAIR)


def _sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Whole sets and points of ``nodes(node, doc_id, row, hi, lo)``, made anew from their texts.

    A text is fetched by doc_id and hash, so rows that share a doc_id or have none meet
    their own node only.
    """
    arrow = to_arrow_schema(_SET)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in zip(*(batch.column(n) for n in ("text", "node", "hi", "lo"))):
                text, node, hi, lo = (v.as_py() for v in row)
                tokens = shingles(text)
                if fingerprint(tokens) == (hi, lo):  # else another text of the same hash
                    found.append((node, len(tokens), group_counts(tokens), tokens.tobytes()))
            yield record([list(c) for c in zip(*found)] or [[]] * 4, arrow)

    wanted = nodes.select(F.col("doc_id").alias("wanted"), F.col("row").alias("wanted_row"), "node", "hi", "lo")
    met = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")) & (F.col("row") == F.col("wanted_row")))
    return met.select("text", "node", "hi", "lo").mapInArrow(make, _SET)


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets are similar enough."""
    arrow = to_arrow_schema(_PAIR)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for a, b, x, y in zip(*(batch.column(n) for n in ("a", "b", "x", "y"))):
                if _similar(*(np.frombuffer(v.as_py(), np.uint64) for v in (x, y)), percent):
                    kept.append((a.as_py(), b.as_py()))
            yield record([[a for a, _ in kept], [b for _, b in kept]], arrow)

    x = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    met = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return materialize(met.mapInArrow(verify, _PAIR), "verified")


def _tree(rows: pa.Table, percent: int) -> CountTree:
    points, over = read_points(rows.column("point").to_pylist())
    return CountTree(points, over, rows.column("size").to_numpy(), rows.column("component").to_numpy(), percent)


def _met_pairs(rows: pa.Table, tree: CountTree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of the tree, of two parts only those from one to the other."""
    side = rows.column("side").to_numpy()
    across = rows.column("part")[0] != rows.column("other")[0]
    for i, j in tree.pairs():
        keep = side[i] != side[j] if across else np.ones(len(i), bool)
        yield i[keep], j[keep]


def _block_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in blocks (token, part, other, side, node, component, ...)."""
    arrow = to_arrow_schema(_PAIR)

    def pair(rows: pa.Table) -> pa.Table:
        node = rows.column("node").to_numpy()
        found = [np.zeros((0, 2), np.int64)]
        for i, j in _met_pairs(rows, _tree(rows, percent)):
            found.append(np.stack([np.minimum(node[i], node[j]), np.maximum(node[i], node[j])], 1))
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.Table.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=arrow)

    return members.groupBy("token", "part", "other").applyInArrow(pair, _PAIR).distinct()


def _block_links(members: DataFrame, percent: int) -> DataFrame:
    """Links that connect the components of blocks like those of ``_block_pairs``, with the
    tokens of their sets, as far as pairs within a block do."""
    arrow = to_arrow_schema(_PAIR)

    def link(rows: pa.Table) -> pa.Table:
        node = rows.column("node").to_numpy()
        sets = [np.frombuffer(t, np.uint64) for t in rows.column("tokens").to_pylist()]
        names, place = np.unique(rows.column("component").to_numpy(), return_inverse=True)
        own, joined, tree = place.tolist(), Unions(len(names)), _tree(rows, percent)
        found = []
        for i, j in _met_pairs(rows, tree):
            before = len(found)
            for p, q in zip(i.tolist(), j.tolist()):
                if joined.root(own[p]) != joined.root(own[q]) and _similar(sets[p], sets[q], percent):
                    joined.join(own[p], own[q])
                    found.append((p, q))
            if len(found) > before:
                tree.classify(np.array([joined.root(c) for c in range(len(names))])[place])
        a, b = (node[np.array([f[side] for f in found], np.int64)] for side in (0, 1))
        return pa.Table.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], schema=arrow)

    return members.groupBy("token", "part", "other").applyInArrow(link, _PAIR).distinct()


def _open_blocks(met: DataFrame, sizes: DataFrame, components_: DataFrame) -> DataFrame:
    """Nodes of the tokens whose nodes are in different components; of tokens with the same
    nodes one is enough."""
    known = met.join(components_, "node")
    same = ["_n", "_sum", "_xor", "_first", "_last"]
    open_ = (
        known.groupBy("token")
        .agg(
            F.min("component").alias("_l"),
            F.max("component").alias("_m"),
            F.count(F.lit(1)).alias("_n"),
            F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("_sum"),
            F.bit_xor(F.xxhash64(F.lit("x"), "node")).alias("_xor"),
            F.min("node").alias("_first"),
            F.max("node").alias("_last"),
        )
        .filter("_l != _m")
        .groupBy(*same)
        .agg(F.min("token").alias("token"))
        .select("token", F.col("_n").alias("n"), F.col("_first").alias("first"))
    )
    return known.join(open_, "token").join(sizes, "node")


def _leaf_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in blocks that fill one leaf of a tree at most."""
    names = ["node", "component", "size"]
    a, b = (members.select("token", *(F.col(c).alias(f"{c}_{side}") for c in names)) for side in "ab")
    sized = F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * percent
    met = a.join(b, "token").filter((F.col("node_a") < F.col("node_b")) & (F.col("component_a") != F.col("component_b")))
    return met.filter(sized).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def _united(members: DataFrame) -> DataFrame:
    """Blocks that have the same first node as one, each node once, unless all their nodes
    are more than twice those of the largest; the others as they are."""
    nodes = members.groupBy("first", "node").agg(F.max("n").alias("n"))
    alike = nodes.groupBy("first").agg(F.count(F.lit(1)).alias("_all"), F.max("n").alias("_most"))
    alike = alike.filter(F.col("_all") <= 2 * F.col("_most")).select("first", F.col("first").alias("_block"))
    of = members.select("token", "first").distinct().join(alike, "first").select("token", "_block")
    block = F.coalesce("_block", "token").alias("token")
    return members.join(of, "token", "left").select(block, "node", "component", "size").distinct()


def _tree_members(members: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """Members of larger blocks with these columns of their sets, cut into parts."""
    members = materialize(_united(members), "members")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("size") / BLOCK_TOKENS)).cast("int")
    members = members.join(members.groupBy("token").agg(parts.alias("parts")), "token")
    members = members.join(shuffled(sets.select("node", *columns)), "node")
    own = F.pmod(F.xxhash64("node", "token"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("_other")
    return members.withColumn("side", own).select("*", other).select(
        "token",
        F.least("side", "_other").alias("part"),
        F.greatest("side", "_other").alias("other"),
        "side",
        "node",
        "component",
        "size",
        *columns,
    )


def ngram_join(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Every row's doc_id, n_shingles and component_id."""
    return _joined(docs, percent).select("doc_id", "n_shingles", "component_id")


def ngram_links(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Every row's doc_id, n_shingles, component_id and n_links, the number of other rows
    that it links with: those of equal sets and those of similar ones."""
    return _joined(docs, percent, True).select("doc_id", "n_shingles", "component_id", "n_links")


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each component with all its columns: that of the least doc_id.

    Rows that repeat a doc_id and its text count as one document.
    """
    id_, hash_ = unused(docs, "_id", "_hash")
    with temporary(docs.sparkSession):
        found = _joined(docs, percent)
        own = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
        first = found.filter("component IS NOT NULL").groupBy("component").agg(F.min(own).alias("_own"))
        wordless = found.filter("component IS NULL").select("doc_id", "row")
        kept = first.select("_own.doc_id", "_own.row").unionByName(wordless).distinct()
        named = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(id_)
        kept = materialize(kept.select(named, F.col("row").alias(hash_)), "kept", keep=True)
    met = docs.withColumns(dict(zip((id_, hash_), identity()))).join(kept, [id_, hash_])
    return same_columns(met.dropDuplicates([id_, hash_]), docs)


def _joined(docs: DataFrame, percent: int, count_links: bool = False) -> DataFrame:
    """Every row's doc_id, hash, n_shingles, component (a node, none without words) and
    component_id, with n_links if they are counted."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), identity()[1].alias("row"), F.col("text").cast("string"))
    with temporary(spark):
        repeated = materialize(_repeated(docs), "repeated")
        total = repeated.filter("token IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        order = spark.sparkContext.broadcast(Order.of(repeated))
    firsts = total * (100 - percent) / 100
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(firsts / BUCKET))
    with temporary(spark):
        signed = materialize(_sign(docs, order, n_buckets, percent), "signed")
        rows = signed.filter("bucket IS NULL").select("node", "doc_id", "row", "size", "hi", "lo", "sampled")
        rows = materialize(rows, "rows", keep=True)
        met = materialize(_meet(signed, order), "met", keep=True)
    with temporary(spark):
        named = _named(docs, rows, met, percent, count_links)
    found = rows.join(named, ["hi", "lo"], "left")
    return found.select(
        "doc_id",
        "row",
        "component",
        F.col("size").cast("long").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        *([F.coalesce("n_links", F.lit(0)).alias("n_links")] if count_links else []),
    )


def _blocks(met: DataFrame, sets: DataFrame, groups: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of nodes of different components that share a token of few nodes and may link,
    and the rows of the tokens of more nodes."""
    blocks = _open_blocks(met.select("token", "node"), sets.select("node", "size"), groups)
    blocks = materialize(blocks, "blocks")
    pairs = _bounded(_leaf_pairs(blocks.filter(F.col("n") <= FANOUT), percent), sets, percent)
    return pairs, blocks.filter(F.col("n") > FANOUT)


def _link_counts(rows: DataFrame, links: DataFrame) -> DataFrame:
    """n_links of the rows of every set, by the node that ``links`` name it by."""
    copies = rows.filter("node IS NOT NULL").groupBy("hi", "lo").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("n"))
    copies = materialize(copies.select("node", "n"), "copies")
    ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = ends.join(copies.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.sum("n").alias("_similar"))
    counted = copies.join(others.withColumnRenamed("a", "node"), "node", "left")
    return counted.select("node", (F.col("n") - 1 + F.coalesce("_similar", F.lit(0))).alias("n_links"))


def _named(docs: DataFrame, rows: DataFrame, met: DataFrame, percent: int, count_links: bool = False) -> DataFrame:
    """Component and component_id of every set, with n_links if they are counted."""
    # nodes of equal sets in different tasks become the least of them
    points = materialize(
        rows.filter("node IS NOT NULL")
        .groupBy("hi", "lo")
        .agg(
            *(f(c).alias(c) for f, c in ((F.min, "node"), (F.min, "doc_id"), (F.max, "size"), (F.max, "sampled"))),
            # the hash of a row that has this doc_id, or of one without any
            F.coalesce(F.min_by("row", "doc_id"), F.min("row")).alias("row"),
        ),
        "points",
    )
    own = rows.filter("sampled IS NOT NULL").select("hi", "lo", F.col("node").alias("own"))
    canon = own.join(points.select("hi", "lo", "node"), ["hi", "lo"]).select("own", "node")
    met = met.withColumnRenamed("node", "own").join(canon, "own").drop("own").distinct()
    met = _promising(materialize(_of_several(met), "met"), points, percent)
    met = materialize(_promising(materialize(met, "met"), points, percent), "met")
    wanted = met.select("node").distinct()
    sets = materialize(_sets(docs, points.join(wanted, "node")).dropDuplicates(["node"]), "sets")

    if count_links:  # every node is a component of its own, so no pair is left out
        alone = wanted.select("node", F.col("node").alias("component"))
        pairs, larger = _blocks(met, sets, alone, percent)
        pairs = pairs.unionByName(_block_pairs(_tree_members(larger, sets, "point"), percent)).distinct()
        links = _verified(materialize(pairs, "pairs"), sets, percent)
    else:
        stars = met.filter("node != first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
        tried = materialize(_bounded(stars, sets, percent), "stars")
        links = _verified(tried, sets, percent)

        groups = components(links).withColumnRenamed("component", "_found")
        groups = wanted.join(groups, "node", "left").select("node", F.coalesce("_found", "node").alias("component"))
        left, larger = _blocks(met, sets, materialize(groups, "groups"), percent)
        left = materialize(left.join(tried, ["a", "b"], "left_anti"), "left")
        links = links.unionByName(_verified(left, sets, percent))
        found = _block_links(_tree_members(larger, sets, "point", "tokens"), percent)
        links = links.unionByName(materialize(found, "found"))

    named = points.join(components(links), "node", "left").select(
        "hi", "lo", "doc_id", "node", F.coalesce("component", "node").alias("component")
    )
    counts = ["n_links"] if count_links else []
    named = named.join(_link_counts(rows, links), "node") if count_links else named
    named = materialize(named.drop("node"), "named")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "component").select("hi", "lo", "component", "component_id", *counts)
    return materialize(named, "components", keep=True)
