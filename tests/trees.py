"""Random numbered taxa for tests."""

from __future__ import annotations

import random

from pyspark.sql import types as T

from cladeweave.model import RANK_CODES, ROOTS

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("TaxonomySourceID", T.LongType()),
        T.StructField("SourceTaxonID", T.LongType()),
        T.StructField("SourceParentTaxonID", T.LongType()),
        T.StructField("SourceProjectID", T.LongType()),
        T.StructField("taxon", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("parent_taxon", T.StringType()),
        T.StructField("rank", T.StringType()),
        T.StructField("scientificName", T.StringType()),
        T.StructField("parent_id", T.LongType()),
        T.StructField("rank_code", T.IntegerType()),
    ]
)
CODES = {rank: code for rank, code in RANK_CODES}


def row(i, source, taxon_id, parent, taxon, parent_taxon, rank, project=1, parent_id=None):
    return {
        "id": i,
        "TaxonomySourceID": source,
        "SourceTaxonID": taxon_id,
        "SourceParentTaxonID": parent,
        "SourceProjectID": project,
        "taxon": taxon,
        "author": f"author {i}",
        "parent_taxon": parent_taxon,
        "rank": rank,
        "scientificName": None,
        "parent_id": parent_id,
        "rank_code": CODES.get(rank, 0),
    }


def roots():
    return [row(i, 0, i, p, t, pt, r, project=0, parent_id=p) for i, p, t, r, pt in ROOTS]


def frame(spark, rows):
    data = [tuple(r[f.name] for f in SCHEMA.fields) for r in rows]
    return spark.createDataFrame(data, SCHEMA).coalesce(2)


def random_taxa(seed, size=60, forks=True):
    """Trees of few names over two sources, with forks, gaps, homonyms and odd ranks."""
    rng = random.Random(seed)
    ranks = ["reg.", "cl.", "ord.", "ord.", "subord.", "fam.", "fam.", "trib.", "gen.", "gen.", "sp.", "sp.", "subsp.", "var."]
    rows, i = roots(), 5
    for source in (1, 2):
        made = []
        for n in range(size):
            level = min(len(ranks) - 1, n * len(ranks) // size)
            rank = ranks[level]
            name = "Animalia" if n == 0 else f"{rank[0].upper()}{rng.randrange(1 + size // 6)}"
            higher = [m for m in made if CODES[m["rank"]] >= CODES[rank]]
            near = higher[-12:]
            parents = [rng.choice(near)] if near and rng.random() < 0.93 else [None]
            if forks and near and rng.random() < 0.08:
                parents.append(rng.choice(near))
            seen = set()
            for p in parents:
                pid = p["SourceTaxonID"] if p else rng.choice([None, 9999, n])
                if pid in seen:
                    continue
                seen.add(pid)
                parent_taxon = p["taxon"] if p else rng.choice([None, "Nowhere", "G1", "Animalia"])
                made.append(row(i, source, n, pid, name, parent_taxon, rank))
                rows.append(made[-1])
                i += 1
    return rows
