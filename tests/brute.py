"""The merge rules on Python lists, as slow and literal as possible."""

from __future__ import annotations

from collections import defaultdict

BANDS = [("family", 340, 500), ("genus", 270, 330), ("species", 150, 260)]


def key(r):
    return (r["TaxonomySourceID"], r["SourceProjectID"], r["SourceTaxonID"])


def closure(rows):
    """Bag of (key of ancestor, key of descendant, length), level by level."""
    by_key = defaultdict(list)
    for r in rows:
        by_key[key(r)].append(r)
    level = [(key(r), key(r), 0) for r in rows]
    out = []
    while level:
        out += level
        nxt = []
        for anc, des, n in level:
            for own in by_key[anc]:
                up = own["SourceParentTaxonID"]
                if up is None or up == own["SourceTaxonID"]:
                    continue
                for parent in by_key.get((anc[0], anc[1], up), []):
                    nxt.append((key(parent), des, n + 1))
        level = nxt
    return out


def lineage(rows):
    """key -> (depth, family)"""
    families = defaultdict(list)
    for r in rows:
        if r["rank"] == "fam.":
            families[key(r)].append((r["id"], r["taxon"]))
    depth, family = defaultdict(int), {}
    for anc, des, n in closure(rows):
        depth[des] = max(depth[des], n)
        for i, name in families.get(anc, []):
            best = family.get(des)
            if best is None or (n, i) < best[:2]:
                family[des] = (n, i, name)
    return {key(r): (depth[key(r)], family.get(key(r), (0, 0, None))[2]) for r in rows}


def survivors(rows):
    line = lineage(rows)
    banded = []
    for r in rows:
        for band, low, high in BANDS:
            if low <= r["rank_code"] <= high and r["parent_taxon"] is not None:
                depth, family = line[key(r)]
                banded.append({**r, "band": band, "depth": depth, "family": None if band == "family" else family, "state": 0})
    for b in banded:
        others = [o for o in banded if o["band"] == b["band"] and o["taxon"] == b["taxon"] and o["id"] != b["id"]]
        if b["band"] == "family":
            b["state"] = 2 if others else 0
        else:
            if b["family"] is not None and any(o["family"] == b["family"] for o in others):
                b["state"] = 2
            if b["family"] is None and others:
                b["state"] = 6
    for level in range(max((b["depth"] for b in banded), default=0), 0, -1):
        for band, taxon in {(b["band"], b["taxon"]) for b in banded}:
            open_ = [b for b in banded if b["band"] == band and b["taxon"] == taxon and b["state"] == 2]
            # a path of every length up to the depth exists
            reach = [b for b in open_ if b["depth"] >= level]
            if reach:
                winner = min(reach, key=lambda b: b["id"])
                for b in open_:
                    b["state"] = 4 if b is winner else 6
    kept = [{**b, "familyCache": b["family"]} for b in banded if b["state"] in (0, 4) and b["taxon"] != "root"]
    return kept + [{**r, "familyCache": None} for r in rows if r["taxon"] == "root"]


def link(rows):
    def lowest(test):
        ids = [p["id"] for p in rows if test(p)]
        return min(ids) if ids else None

    out = []
    for r in rows:
        p1 = lowest(
            lambda p: p["TaxonomySourceID"] == r["TaxonomySourceID"]
            and p["SourceProjectID"] == r["SourceProjectID"]
            and p["SourceTaxonID"] == r["SourceParentTaxonID"]
            and p["rank_code"] > r["rank_code"]
        )
        named = lambda p: r["parent_taxon"] is not None and p["taxon"] == r["parent_taxon"]
        rules = [
            lambda: p1,
            lambda: r["parent_id"],
            lambda: lowest(
                lambda p: named(p)
                and p["rank_code"] > r["rank_code"]
                and r["familyCache"] is not None
                and p["familyCache"] == r["familyCache"]
            ),
            lambda: lowest(lambda p: named(p) and p["rank_code"] > r["rank_code"]),
            lambda: lowest(lambda p: named(p) and p["rank_code"] == r["rank_code"] and p["taxon"] != r["taxon"]),
        ]
        parent = None
        for rule in rules:
            parent = rule()
            if parent is not None:
                break
        out.append({**r, "parent_id": parent})
    return out


def repair(rows, vocabulary, rounds=2):
    labels = {code: rank for rank, code in vocabulary}
    rows = [dict(r) for r in rows]
    for _ in range(rounds):
        by_id = {r["id"]: r for r in rows}
        children = defaultdict(list)
        for r in rows:
            children[r["parent_id"]].append(r)
        state = {}
        for r in rows:
            up = by_id.get(r["parent_id"])
            as_parent = up is not None and up["rank_code"] == r["rank_code"]
            as_child = any(c["rank_code"] == r["rank_code"] for c in children[r["id"]])
            state[r["id"]] = 3 if as_parent and as_child else 1 if as_child else 5 if as_parent else 0
        before = {r["id"]: r["rank_code"] for r in rows}
        for r in rows:
            code = before[r["id"]]
            if state[r["id"]] == 1 and 280 < code < 490 and code + 10 in labels and r["parent_id"] in by_id:
                if code + 10 < before[r["parent_id"]]:
                    r["rank_code"], r["rank"] = code + 10, labels[code + 10]
        raised = {r["id"]: r["rank_code"] for r in rows}
        for r in rows:
            code = before[r["id"]]
            if state[r["id"]] == 5 and 280 < code < 490 and code - 10 in labels:
                if any(code - 10 > raised[c["id"]] for c in children[r["id"]]):
                    r["rank_code"], r["rank"] = code - 10, labels[code - 10]
    return rows


def prune(rows):
    rows = [r for r in rows if r["parent_id"] is not None or r["taxon"] == "root"]
    while True:
        ids = {r["id"] for r in rows}
        kept = [r for r in rows if r["parent_id"] in ids or r["taxon"] == "root"]
        if len(kept) == len(rows):
            return kept
        rows = kept


def merge(rows, vocabulary):
    return prune(repair(link(survivors(rows)), vocabulary))
