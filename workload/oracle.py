"""The same queries as DuckDB SQL on the given tables.

Written in another form than the Spark code where a rule allows it: recursive
queries for trees, EXISTS and grouped self joins for doubles, winners and parents,
recursive descent from the root for pruning.
"""

from __future__ import annotations

import re

from cladeweave.model import CONSTRAINTS, RANK_CODES, RANK_RENAMES, REDLIST_LABELS, REDLIST_TERMS
from cladeweave.sources.checklist import TABLES

_RANKS = ", ".join(f"('{r}', {c})" for r, c in RANK_CODES)
_TERMS = ", ".join(f"({i}, '{t}', '{c}', '{lang}')" for i, t, c, lang in REDLIST_TERMS)
_LABELS = ", ".join(f"'{label}'" for label in REDLIST_LABELS)
_RENAME = "CASE rank " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in RANK_RENAMES.items()) + " ELSE rank END"

_CANONICAL = """CASE WHEN DisplayOrder < 180 THEN
  rtrim(GenusOrSupragenericName[1] || lower(substr(rtrim(GenusOrSupragenericName), 2))
    || coalesce(' ' || SpeciesEpithet, '') || coalesce(' ' || InfraspecificEpithet, ''))
  ELSE GenusOrSupragenericName[1] || lower(substr(rtrim(GenusOrSupragenericName), 2)) END"""

_ZOO = """concat(
  CASE WHEN rtrim(coalesce(BasionymAuthors, '')) = '' THEN ''
    WHEN IsRecombination = 1 THEN concat('(', rtrim(BasionymAuthors), ', ' || BasionymAuthorsYear, ')')
    WHEN IsRecombination = 0 THEN concat(rtrim(BasionymAuthors), ', ' || YearOfPubl)
    ELSE rtrim(BasionymAuthors) END,
  ' ' || rtrim(NonNomenclaturalNameSuffix))"""

_BOT = """concat(
  CASE WHEN rtrim(coalesce(BasionymAuthors, '')) = '' THEN ''
    WHEN rtrim(coalesce(CombiningAuthors, '')) = ''
      THEN concat(' ', rtrim(BasionymAuthors), ' : ' || nullif(rtrim(SanctioningAuthor), ''))
    ELSE concat(' (', rtrim(BasionymAuthors), ' : ' || nullif(rtrim(SanctioningAuthor), ''), ') ') END,
  rtrim(CombiningAuthors),
  CASE WHEN rtrim(InfraspecificEpithet) <> '' AND rtrim(SpeciesEpithet) = rtrim(InfraspecificEpithet)
    THEN concat(' ', CASE WHEN rtrim(TaxonomicRank) <> '' THEN TaxonomicRank || ' ' END, rtrim(InfraspecificEpithet)) END,
  ' ' || rtrim(NonNomenclaturalNameSuffix))"""

_AUTHORSHIP = f"CASE WHEN DisplayOrder < 180 THEN CASE WHEN NomenclaturalCode = 3 THEN {_ZOO} ELSE {_BOT} END END"

_FLAG_STATE = "CASE WHEN pc = code AND kid THEN 3 WHEN kid THEN 1 WHEN pc = code THEN 5 ELSE 0 END"


def _round(before: str, n: int) -> dict[str, str]:
    """One round of rank repair: flags, moves up, moves down, new ranks."""
    return {
        f"flag{n}": f"""SELECT id, parent_id, code, pc, {_FLAG_STATE} AS state FROM (
          SELECT t.id, t.parent_id, t.code, p.code AS pc,
            EXISTS (SELECT 1 FROM {before} c WHERE c.parent_id = t.id AND c.code = t.code) AS kid
          FROM {before} t LEFT JOIN {before} p ON p.id = t.parent_id)""",
        f"up{n}": f"""SELECT f.id, f.code, r.rank_code AS new_code, r.rank AS new_rank
          FROM flag{n} f JOIN ranks r ON r.rank_code = f.code + 10
          WHERE f.state = 1 AND f.code + 10 < f.pc AND f.code > 280 AND f.code < 490""",
        f"down{n}": f"""SELECT f.id, f.code, r.rank_code AS new_code, r.rank AS new_rank
          FROM flag{n} f JOIN ranks r ON r.rank_code = f.code - 10
          WHERE f.state = 5 AND f.code > 280 AND f.code < 490
            AND EXISTS (SELECT 1 FROM {before} c LEFT JOIN up{n} u ON u.id = c.id
              WHERE c.parent_id = f.id AND coalesce(u.new_code, c.code) < f.code - 10)""",
        f"round{n}": f"""SELECT t.* REPLACE (coalesce(u.new_code, d.new_code, t.code) AS code,
            coalesce(u.new_rank, d.new_rank, t.rank) AS rank)
          FROM {before} t LEFT JOIN up{n} u ON u.id = t.id LEFT JOIN down{n} d ON d.id = t.id""",
    }


_PARENT_RULES = {
    "par1": "p.s = t.s AND p.sid = t.psid AND p.code > t.code",
    "par2": "p.taxon = t.parent_taxon AND p.fc = t.fc AND p.code > t.code",
    "par3": "p.taxon = t.parent_taxon AND p.code > t.code",
    "par4": "p.taxon = t.parent_taxon AND p.code = t.code AND p.taxon <> t.taxon",
}

CTES: dict[str, str] = {
    "ranks": f"SELECT * FROM (VALUES {_RANKS}) v(rank, rank_code)",
    "terms": f"SELECT * FROM (VALUES {_TERMS}) v(id, term, category, lang)",
    # --- checklist
    "tn": """SELECT p_partkey AS NameID,
        CASE WHEN p_partkey = 0 THEN 'Animalia' ELSE upper(split_part(p_name, ' ', 1)) || p_partkey % 10 END AS GenusOrSupragenericName,
        CASE WHEN p_partkey % 7 <> 0 THEN split_part(p_name, ' ', 2) || p_partkey % 89 END AS SpeciesEpithet,
        CASE p_partkey % 4 WHEN 1 THEN '' WHEN 2 THEN CASE WHEN p_partkey % 7 <> 0 THEN split_part(p_name, ' ', 2) || p_partkey % 89 END
          WHEN 3 THEN 'minor' END AS InfraspecificEpithet,
        CASE WHEN p_partkey % 2 = 0 THEN 3 ELSE 1 END AS NomenclaturalCode,
        CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 5 = 0 THEN '' ELSE p_brand END AS BasionymAuthors,
        CASE WHEN p_size % 3 = 0 THEN p_type END AS CombiningAuthors,
        CASE WHEN p_size % 11 = 0 THEN 'Fr.' END AS SanctioningAuthor,
        CASE WHEN p_size % 6 <> 0 THEN 1800 + p_size END AS BasionymAuthorsYear,
        CASE WHEN p_size % 6 <> 0 THEN 1800 + p_size END AS YearOfPubl,
        p_size % 2 AS IsRecombination,
        CASE WHEN p_partkey % 13 = 0 THEN 's.l.' END AS NonNomenclaturalNameSuffix,
        CASE WHEN p_partkey = 0 THEN 'reg.' WHEN p_partkey < 10 THEN 'fam.' WHEN p_partkey < 100 THEN 'gen.'
          WHEN p_partkey < 1000 THEN 'sp.' WHEN p_partkey < 10000 THEN 'subsp.' ELSE 'var.' END AS TaxonomicRank,
        p_name AS TaxonNameCache
      FROM part""",
    "tnp": "SELECT NameID, 85 AS ProjectID FROM tn UNION ALL SELECT NameID, 930 FROM tn WHERE NameID % 2 = 0 OR NameID < 100",
    "th": "SELECT NameID, NameID // 10 AS NameParentID, ProjectID FROM tnp",
    "tan": """SELECT NameID, ProjectID, CASE WHEN NameID % 50 = 1 AND NameID >= 100 THEN 1 ELSE 0 END AS IgnoreButKeepForReference
      FROM tnp WHERE NameID % 5 <> 0 OR NameID < 100""",
    "tsyn": "SELECT NameID, NameID + CASE WHEN NameID % 2 = 0 THEN 2 ELSE 1 END AS SynNameID FROM tn WHERE NameID % 5 = 0",
    "tcn": """SELECT doc_id % (SELECT count(*) FROM part) AS NameID, text AS CommonName, lang AS LanguageCode
      FROM documents""",
    "li": "SELECT l_partkey AS NameID, 900 + l_suppkey % 50 AS ProjectID, l_returnflag, l_linenumber FROM lineitem",
    "tnl": "SELECT DISTINCT NameID, ProjectID FROM li",
    "tnlr": "SELECT DISTINCT NameID, ProjectID, 'List ' || l_returnflag AS TaxonNameListRefText FROM li",
    "tnla": "SELECT DISTINCT NameID, ProjectID, l_linenumber AS AnalysisID, l_returnflag AS AnalysisValue FROM li",
    "tnlac": """SELECT * FROM (VALUES (1, 'RoteListe_D_2009_RL-Kategorie'), (2, 'RoteListe_D_2009_Neobiota'),
      (3, 'RoteListe_D_2009_Sonderfälle'), (4, 'RoteListe_D_2016_RL-Kategorie'), (5, 'RoteListe_D_2016_LetzterNachweis'),
      (6, 'RoteListe_D_2011_Risikofaktoren'), (7, 'RoteListe_D_1998_RL-Kategorie')) v(AnalysisID, DisplayText)""",
    "named": f"""SELECT tn.*, r.rank_code AS DisplayOrder, {_CANONICAL} AS canonicalName
      FROM tn LEFT JOIN (SELECT rank AS Code, rank_code FROM ranks) r ON r.Code = tn.TaxonomicRank
      """.replace("DisplayOrder <", "r.rank_code <"),
    "accepted": """SELECT p.NameID, p.ProjectID FROM tnp p WHERE EXISTS (SELECT 1 FROM tan a WHERE a.NameID = p.NameID
      AND a.ProjectID = p.ProjectID AND a.IgnoreButKeepForReference = 0)""",
    "unaccepted": "SELECT NameID, ProjectID FROM tnp EXCEPT SELECT NameID, ProjectID FROM accepted",
    "xtaxa": f"""SELECT DISTINCT 1::BIGINT AS TaxonomySourceID, n.NameID AS SourceTaxonID, h.NameParentID AS SourceParentTaxonID,
        a.ProjectID::BIGINT AS SourceProjectID, n.canonicalName, {_AUTHORSHIP} AS scientificNameAuthorShip,
        p.canonicalName AS parentCanonicalName, n.TaxonomicRank AS taxonRank, n.TaxonNameCache AS scientificName
      FROM named n JOIN accepted a ON a.NameID = n.NameID LEFT JOIN tnl l ON l.NameID = n.NameID
        LEFT JOIN th h ON h.NameID = a.NameID AND h.ProjectID = a.ProjectID
        LEFT JOIN (SELECT NameID, canonicalName FROM named) p ON p.NameID = h.NameParentID""",
    "xsyn": f"""SELECT DISTINCT 1::BIGINT AS TaxonomySourceID, n.NameID AS SourceTaxonID, u.ProjectID::BIGINT AS SourceProjectID,
        s.SynNameID AS SourceAcceptedTaxonID, n.canonicalName, {_AUTHORSHIP} AS scientificNameAuthorShip,
        n.TaxonomicRank AS taxonRank
      FROM named n JOIN unaccepted u ON u.NameID = n.NameID JOIN tsyn s ON s.NameID = n.NameID""",
    "xnames": """SELECT DISTINCT 1::BIGINT AS TaxonomySourceID, c.NameID AS SourceTaxonID, p.ProjectID::BIGINT AS SourceProjectID,
        left(c.CommonName, 255) AS CommonName, left(c.LanguageCode, 2) AS Code, 'Vertebrata' AS db_name
      FROM tcn c JOIN tn ON tn.NameID = c.NameID JOIN tnp p ON p.NameID = c.NameID""",
    "rlvalues": f"""SELECT l.NameID, l.ProjectID::BIGINT AS ProjectID, c.DisplayText, a.AnalysisValue, r.TaxonNameListRefText
      FROM tnl l JOIN tnlr r ON r.NameID = l.NameID AND r.ProjectID = l.ProjectID
        LEFT JOIN tnla a ON a.NameID = r.NameID AND a.ProjectID = r.ProjectID
        LEFT JOIN tnlac c ON c.AnalysisID = a.AnalysisID
      WHERE c.DisplayText IN ({_LABELS}) AND l.ProjectID BETWEEN 923 AND 927""",
    "xred": """SELECT 1::BIGINT AS TaxonomySourceID, NameID AS SourceTaxonID, p.pid::BIGINT AS SourceProjectID,
        substr(DisplayText, 18, 255) AS Term, AnalysisValue AS Value, TaxonNameListRefText AS Reference
      FROM rlvalues CROSS JOIN (VALUES (85), (930)) p(pid)""",
    # --- backbone
    "bb": """SELECT c_custkey + 10 AS TaxonID, c_nationkey::BIGINT AS parentNameUsageID,
        CASE WHEN c_custkey % 3 = 1 AND c_custkey % 5 <> 0 THEN c_custkey + 9 END AS acceptedNameUsageID,
        CASE WHEN c_custkey % 17 = 0 THEN '' WHEN c_custkey % 19 = 0 THEN NULL ELSE c_name END AS canonicalName,
        NULL::VARCHAR AS scientificNameAuthorShip,
        CASE WHEN c_custkey % 23 <> 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 'Animalia' ELSE c_mktsegment END END AS parentCanonicalName, 'species' AS taxonRank,
        c_name AS scientificName, ['accepted', 'synonym', 'doubtful'][c_custkey % 3 + 1] AS taxonomicStatus,
        ['Animalia', 'Plantae'][c_nationkey % 2 + 1] AS kingdom FROM customer
      UNION ALL SELECT 1, NULL, NULL, 'Animalia', NULL, NULL, 'kingdom', 'Animalia', 'doubtful', 'Animalia'""",
    "bbtaxa": """SELECT DISTINCT 2::BIGINT AS TaxonomySourceID, TaxonID AS SourceTaxonID, parentNameUsageID AS SourceParentTaxonID,
        0::BIGINT AS SourceProjectID, canonicalName, scientificNameAuthorShip, parentCanonicalName, taxonRank, scientificName
      FROM bb WHERE taxonomicStatus = 'accepted' AND canonicalName <> '' AND parentCanonicalName <> ''
        AND kingdom IN ('Animalia') OR canonicalName IN ('Animalia')""",
    "bbsyn": """SELECT DISTINCT 2::BIGINT AS TaxonomySourceID, TaxonID AS SourceTaxonID, 0::BIGINT AS SourceProjectID,
        acceptedNameUsageID AS SourceAcceptedTaxonID, canonicalName, scientificNameAuthorShip, taxonRank
      FROM bb WHERE taxonomicStatus = 'synonym' AND acceptedNameUsageID IS NOT NULL""",
    # --- staged taxa
    "seg": """SELECT * FROM (VALUES (0, 'AUTOMOBILE'), (1, 'BUILDING'), (2, 'FURNITURE'), (3, 'HOUSEHOLD'),
      (4, 'MACHINERY')) v(g, seg)""",
    "mem": """SELECT s, id, k, n, m.g, seg, k % 37 AS ge FROM (
        SELECT 1 AS s, 1000000 + c_custkey AS id, c_custkey AS k, c_nationkey AS n, g
          FROM customer JOIN seg ON seg = c_mktsegment
        UNION ALL SELECT 2, 1000000 + c_custkey, c_custkey, c_nationkey, g
          FROM customer JOIN seg ON seg = c_mktsegment WHERE c_custkey % 3 = 0
        UNION ALL SELECT 2, 2000000 + s_suppkey, s_suppkey, s_nationkey, s_suppkey % 5 FROM supplier) m
      JOIN seg ON seg.g = m.g""",
    "nat": "SELECT n_nationkey AS n, n_name, n_regionkey, r_name FROM nation JOIN region ON r_regionkey = n_regionkey",
    "src": "SELECT * FROM (VALUES (1), (2)) v(s)",
    "stg": """SELECT s::BIGINT AS s, sid::BIGINT AS sid, psid::BIGINT AS psid, taxon, parent_taxon, rank FROM (
        SELECT s, 1 AS sid, NULL AS psid, 'Animalia' AS taxon, NULL AS parent_taxon, 'kingdom' AS rank FROM src
        UNION ALL SELECT s, 1000 + r_regionkey, 1, r_name, 'Animalia', 'class' FROM src CROSS JOIN region
        UNION ALL SELECT s, 2000 + n, 1000 + n_regionkey, n_name, r_name, 'order' FROM src CROSS JOIN nat
        UNION ALL SELECT 2, 3000 + n, 2000 + n, 'Sub' || n_name, n_name, CASE WHEN n % 4 = 0 THEN 'order' ELSE 'subord.' END
          FROM nat WHERE n % 2 = 0
        UNION ALL SELECT DISTINCT s, 4000 + 10 * m.n + g, CASE WHEN s = 2 AND m.n % 2 = 0 THEN 3000 ELSE 2000 END + m.n,
          seg || '_' || m.n, CASE WHEN s = 2 AND m.n % 2 = 0 THEN 'Sub' ELSE '' END || n_name, 'family'
          FROM mem m JOIN nat ON nat.n = m.n
        UNION ALL SELECT DISTINCT s, 100000 + 100 * (10 * n + g) + ge, 4000 + 10 * n + g, 'Genus' || ge, seg || '_' || n, 'genus'
          FROM mem
        UNION ALL SELECT s, id, 100000 + 100 * (10 * n + g) + ge, 'Genus' || ge || ' sp' || k % 211, 'Genus' || ge,
          CASE WHEN k % 13 = 0 THEN 'subspecies' WHEN k % 29 = 0 THEN 'variety' ELSE 'species' END FROM mem
        UNION ALL SELECT DISTINCT 1, 500000 + substr(p_brand, 7)::INT, NULL::INT, p_brand, 'NoFam', 'genus' FROM part
        UNION ALL SELECT 1, 3000000 + p_partkey, 500000 + substr(p_brand, 7)::INT, p_brand || ' p' || p_partkey, p_brand,
          'species' FROM part)""",
    "taxa": f"""SELECT t.*, coalesce(r.rank_code, 0)::BIGINT AS code FROM (
        SELECT 4 + row_number() OVER (ORDER BY s, sid) AS id, s, sid, psid, 1::BIGINT AS prj, taxon, parent_taxon, {_RENAME} AS rank,
          NULL::BIGINT AS parent_id FROM stg
        UNION ALL SELECT * FROM (VALUES (1, 0, 1, NULL, 0, 'root', NULL, 'root', NULL),
          (2, 0, 2, 1, 0, 'Animalia', 'root', 'reg.', 1), (3, 0, 3, 1, 0, 'Plantae', 'root', 'reg.', 1),
          (4, 0, 4, 1, 0, 'Fungi', 'root', 'reg.', 1))) t
      LEFT JOIN ranks r ON r.rank = t.rank""",
    "clo": """SELECT sid AS anc, sid AS des, 0::BIGINT AS len, s, prj FROM taxa
      UNION ALL SELECT t2.sid, c.des, c.len + 1, c.s, c.prj FROM clo c
        JOIN taxa t1 ON t1.sid = c.anc AND t1.s = c.s AND t1.prj = c.prj
        JOIN taxa t2 ON t2.sid = t1.psid AND t2.s = t1.s AND t2.prj = t1.prj WHERE t1.sid <> t1.psid""",
    "dep": "SELECT s, prj, des AS sid, max(len) AS depth FROM clo GROUP BY ALL",
    "anfam": """SELECT c.s, c.prj, c.des, c.len, f.taxon AS family, f.id AS family_id
      FROM clo c JOIN taxa f ON f.sid = c.anc AND f.s = c.s AND f.prj = c.prj WHERE f.rank = 'fam.'""",
    "fam": """SELECT s, prj, des AS sid, family FROM anfam a WHERE NOT EXISTS (SELECT 1 FROM anfam b WHERE b.s = a.s
      AND b.prj = a.prj AND b.des = a.des AND (b.len < a.len OR b.len = a.len AND b.family_id < a.family_id))""",
    "lin": """SELECT d.s, d.prj, d.sid, d.depth, f.family FROM dep d
      LEFT JOIN fam f ON f.s = d.s AND f.prj = d.prj AND f.sid = d.sid""",
    # --- doubles
    "band": """SELECT id, code, CASE WHEN code BETWEEN 340 AND 500 THEN 'family' WHEN code BETWEEN 270 AND 330 THEN 'genus'
      WHEN code BETWEEN 150 AND 260 THEN 'species' END AS band FROM taxa""",
    "bnd": """SELECT t.*, b.band, l.depth, CASE WHEN b.band <> 'family' THEN l.family END AS family
      FROM taxa t JOIN band b ON b.id = t.id JOIN lin l ON l.s = t.s AND l.prj = t.prj AND l.sid = t.sid
      WHERE b.band IS NOT NULL AND t.parent_taxon IS NOT NULL""",
    "cand": """SELECT t.* FROM bnd t WHERE t.band = 'family' AND EXISTS (SELECT 1 FROM bnd o WHERE o.band = t.band
        AND o.taxon = t.taxon AND o.id <> t.id)
      UNION ALL SELECT t.* FROM bnd t WHERE t.band <> 'family' AND EXISTS (SELECT 1 FROM bnd o WHERE o.band = t.band
        AND o.taxon = t.taxon AND o.family = t.family AND o.id <> t.id)""",
    "nofam": """SELECT t.* FROM bnd t WHERE t.band <> 'family' AND t.family IS NULL AND EXISTS (SELECT 1 FROM bnd o
      WHERE o.band = t.band AND o.taxon = t.taxon AND o.id <> t.id)""",
    "deepest": "SELECT band, taxon, max(depth) AS depth FROM cand GROUP BY ALL HAVING max(depth) >= 1",
    "win": """SELECT c.band, c.taxon, min(c.id) AS id FROM cand c JOIN deepest d ON d.band = c.band AND d.taxon = c.taxon
      AND d.depth = c.depth GROUP BY ALL""",
    "kept": """SELECT id FROM bnd EXCEPT SELECT id FROM cand EXCEPT SELECT id FROM nofam""",
    "keepers": "SELECT id FROM kept UNION ALL SELECT id FROM win",
    "surv": """SELECT b.id, b.s, b.sid, b.psid, b.prj, b.taxon, b.parent_taxon, b.rank, b.parent_id, b.code, b.family AS fc
        FROM bnd b JOIN keepers k ON k.id = b.id
      UNION ALL SELECT id, s, sid, psid, prj, taxon, parent_taxon, rank, parent_id, code, NULL FROM taxa WHERE taxon = 'root'""",
    # --- parents
    **{
        name: f"SELECT t.id, min(p.id) AS pid FROM surv t JOIN surv p ON {rule} GROUP BY t.id"
        for name, rule in _PARENT_RULES.items()
    },
    "linked": """SELECT t.* REPLACE (coalesce(a.pid, t.parent_id, b.pid, c.pid, d.pid) AS parent_id) FROM surv t
      LEFT JOIN par1 a ON a.id = t.id LEFT JOIN par2 b ON b.id = t.id LEFT JOIN par3 c ON c.id = t.id
      LEFT JOIN par4 d ON d.id = t.id""",
    # --- ranks, pruning
    **_round("linked", 1),
    **_round("round1", 2),
    "conn": """SELECT id FROM round2 WHERE taxon = 'root'
      UNION ALL SELECT c.id FROM round2 c JOIN conn ON c.parent_id = conn.id""",
    "merged": "SELECT t.* FROM round2 t JOIN conn ON conn.id = t.id",
    "placed": "SELECT * FROM round2 WHERE parent_id IS NOT NULL OR taxon = 'root'",
    "orph": """SELECT t.* FROM placed t WHERE t.taxon <> 'root'
      AND t.parent_id NOT IN (SELECT id FROM placed)""",
    "mclo": """SELECT sid AS anc, sid AS des, 0::BIGINT AS len, s, prj FROM merged
      UNION ALL SELECT t2.sid, c.des, c.len + 1, c.s, c.prj FROM mclo c
        JOIN merged t1 ON t1.sid = c.anc AND t1.s = c.s AND t1.prj = c.prj
        JOIN merged t2 ON t2.sid = t1.psid AND t2.s = t1.s AND t2.prj = t1.prj WHERE t1.sid <> t1.psid""",
    # --- dependents
    "syn": """SELECT CASE o_orderstatus WHEN 'P' THEN 1 ELSE 2 END::BIGINT AS s, 5000000 + o_orderkey AS sid, 1::BIGINT AS prj,
        1000000 + CASE o_orderstatus WHEN 'P' THEN o_custkey ELSE 3 * (o_custkey // 3) END AS acc, 'Syn' || o_orderkey AS taxon
      FROM orders""",
    "red": """SELECT (1 + l_orderkey % 2)::BIGINT AS s, 1000000 + 3 * l_suppkey AS sid, 1::BIGINT AS prj, 'RL-Kategorie' AS term,
        l_returnflag || l_linestatus AS value FROM lineitem""",
    "firstname": """SELECT t.s, t.prj, t.sid, t.taxon, f.family FROM taxa t
      LEFT JOIN fam f ON f.s = t.s AND f.prj = t.prj AND f.sid = t.sid""",
    "psyn": """SELECT y.*, f.taxon AS acc_taxon, f.family FROM syn y
      LEFT JOIN firstname f ON f.s = y.s AND f.prj = y.prj AND f.sid = y.acc""",
    "pred": """SELECT y.*, f.taxon, f.family FROM red y LEFT JOIN firstname f ON f.s = y.s AND f.prj = y.prj AND f.sid = y.sid""",
    "mkey": "SELECT s, prj, sid, min(id) AS id FROM merged GROUP BY ALL",
    "mname": "SELECT taxon, fc, min(id) AS id FROM merged WHERE fc IS NOT NULL GROUP BY ALL",
}

#: CTEs of the tables of a checklist
_CHECKLIST = {
    "TaxonName": "tn",
    "TaxonNameProject": "tnp",
    "TaxonHierarchy": "th",
    "TaxonAcceptedName": "tan",
    "TaxonSynonymy": "tsyn",
    "TaxonCommonName": "tcn",
    "TaxonNameList": "tnl",
    "TaxonNameListReference": "tnlr",
    "TaxonNameListAnalysis": "tnla",
    "TaxonNameListAnalysisCategory": "tnlac",
}


def _all_rows() -> str:
    """Every row of every checklist table as (table, row)."""
    parts = ["SELECT 'TaxonNameTaxonomicRank_Enum' AS \"table\", rank || '|' || rank_code AS \"row\" FROM ranks"]
    for name, cte in _CHECKLIST.items():
        columns = ", ".join(f"coalesce({c}::VARCHAR, '-')" for c in TABLES[name])
        parts.append(f"SELECT '{name}', concat_ws('|', {columns}) FROM {cte}")
    return " UNION ALL ".join(parts)


#: extracted rows by table, with the names of the staged columns
_EXTRACTED = {
    "taxa": """SELECT TaxonomySourceID, SourceTaxonID, SourceProjectID, canonicalName AS taxon,
        scientificNameAuthorShip AS author, parentCanonicalName AS parent_taxon, taxonRank AS rank, scientificName
        FROM (FROM xtaxa UNION ALL FROM bbtaxa)""",
    "synonyms": """SELECT TaxonomySourceID, SourceTaxonID, SourceProjectID, SourceAcceptedTaxonID, canonicalName AS taxon,
        scientificNameAuthorShip AS author, taxonRank AS rank
        FROM (FROM xsyn UNION ALL FROM bbsyn)""",
    "common_names": """SELECT 1::BIGINT AS TaxonomySourceID, NameID AS SourceTaxonID, 85::BIGINT AS SourceProjectID,
        CommonName AS name, LanguageCode AS code, 'Vertebrata' AS db_name FROM tcn""",
    "redlist": """SELECT TaxonomySourceID, SourceTaxonID, SourceProjectID, Term AS term, Value AS value, Reference AS reference
        FROM xred""",
}


def _broken() -> str:
    """Rows that break a rule, one line per rule."""
    parts = []
    for dataset, rules in CONSTRAINTS.items():
        for column, nullable, longest in rules:
            tests = [] if nullable else [("null", f"{column} IS NULL")]
            tests += [] if longest is None else [("length", f"length({column}) > {longest}")]
            for kind, test in tests:
                parts.append(
                    f"""SELECT '{dataset}' AS dataset, TaxonomySourceID, SourceTaxonID, SourceProjectID,
                      '{column}' AS "column", '{kind}' AS kind FROM ({_EXTRACTED[dataset]}) WHERE {test}"""
                )
    return " UNION ALL ".join(parts)


#: banded rows and the copies of ``fixtures.familyless_copies``
_COPIES = """SELECT id, band, taxon, family FROM bnd UNION ALL SELECT id + 1000000000, band, taxon, NULL FROM bnd
  WHERE band <> 'family' AND ((family IS NULL AND id % 3 = 0) OR (family IS NOT NULL AND id % 50 = 0))"""
_ORIGIN = "s AS TaxonomySourceID, prj AS SourceProjectID, sid AS SourceTaxonID"

FINAL: dict[str, str] = {
    "read_checklist": _all_rows(),
    "read_backbone": "SELECT * FROM bb",
    "union_sources": """SELECT TaxonomySourceID, SourceTaxonID, SourceParentTaxonID, SourceProjectID, canonicalName AS taxon,
        scientificNameAuthorShip AS author, parentCanonicalName AS parent_taxon, taxonRank AS rank, scientificName
      FROM (FROM xtaxa UNION ALL FROM bbtaxa)""",
    "source_registry": """SELECT TaxonomySourceID::BIGINT AS TaxonomySourceID, taxonomy_source_name,
        (SELECT count(*) FROM stg WHERE s = TaxonomySourceID) AS n
      FROM (VALUES (1, 'customers'), (2, 'suppliers')) v(TaxonomySourceID, taxonomy_source_name)""",
    "root_rows": """SELECT s AS TaxonomySourceID, sid AS SourceTaxonID, psid AS SourceParentTaxonID, taxon, parent_taxon, rank
        FROM stg UNION ALL
      SELECT 0, sid, psid, taxon, parent_taxon, rank FROM taxa WHERE s = 0""",
    "rank_dim": """SELECT r.rank, r.rank_code::BIGINT AS rank_code, count(t.id) AS n
      FROM ranks r LEFT JOIN taxa t ON t.rank = r.rank GROUP BY ALL""",
    "redlist_terms": """SELECT t.id::BIGINT AS id, t.term, t.category, t.lang, r.value, nullif(count(r.value), 0) AS n
      FROM terms t LEFT JOIN red r ON r.term = t.term GROUP BY ALL""",
    "write_taxa": f"""SELECT id, {_ORIGIN}, psid AS SourceParentTaxonID, taxon, parent_taxon, rank, parent_id,
      code AS rank_code, CASE WHEN s > 0 THEN 'Author ' || sid % 97 END AS author,
      CASE WHEN s > 0 THEN taxon || ' Author ' || sid % 97 END AS "scientificName" FROM taxa""",
    "write_synonyms": f"""SELECT {_ORIGIN}, acc AS SourceAcceptedTaxonID, taxon, NULL::VARCHAR AS author, 'species' AS rank
      FROM syn""",
    "write_common_names": """SELECT 1::BIGINT AS TaxonomySourceID,
        1000000 + doc_id % (SELECT count(*) FROM customer) AS SourceTaxonID, 1::BIGINT AS SourceProjectID,
        text AS name, lang AS code, 'customer' AS db_name FROM documents""",
    "write_redlist": f"SELECT {_ORIGIN}, term, value, NULL::VARCHAR AS reference FROM red",
    "write_closure": """SELECT anc AS AncestorID, des AS DescendantID, len AS PathLength, s AS TaxonomySourceID,
      prj AS SourceProjectID FROM clo""",
    "ordered_ids": "SELECT id, s AS TaxonomySourceID, sid AS SourceTaxonID, psid AS SourceParentTaxonID FROM taxa WHERE s > 0",
    "origin_unique": """SELECT 'synonyms' AS dataset, SourceTaxonID, TaxonomySourceID, SourceAcceptedTaxonID AS other, n
      FROM (SELECT SourceTaxonID, TaxonomySourceID, SourceAcceptedTaxonID, count(*) AS n FROM xsyn GROUP BY ALL HAVING n > 1)
      UNION ALL SELECT 'taxa', SourceTaxonID, TaxonomySourceID, SourceParentTaxonID, n
      FROM (SELECT SourceTaxonID, TaxonomySourceID, SourceParentTaxonID, count(*) AS n FROM xtaxa
        WHERE SourceParentTaxonID IS NOT NULL GROUP BY ALL HAVING n > 1)""",
    "constraint_violations": _broken(),
    "canonical_name": "SELECT NameID, canonicalName FROM named",
    "zoo_authorship": f"SELECT NameID, {_ZOO} AS authorship FROM named",
    "botanical_authorship": f"SELECT NameID, {_BOT} AS authorship FROM named",
    "authorship": f"SELECT NameID, {_AUTHORSHIP} AS scientificNameAuthorShip FROM named",
    "parent_canonical_name": """SELECT n.NameID, n.ProjectID::BIGINT AS ProjectID, h.NameParentID,
        p.canonicalName AS parentCanonicalName
      FROM tnp n LEFT JOIN th h ON h.NameID = n.NameID AND h.ProjectID = n.ProjectID
        LEFT JOIN named p ON p.NameID = h.NameParentID""",
    "null_or_empty": """SELECT NameID, coalesce(trim(BasionymAuthors), '') = '' AS BasionymAuthors,
        coalesce(trim(CombiningAuthors), '') = '' AS CombiningAuthors,
        coalesce(trim(SanctioningAuthor), '') = '' AS SanctioningAuthor,
        coalesce(trim(InfraspecificEpithet), '') = '' AS InfraspecificEpithet FROM tn""",
    "tag_source": """SELECT NameID, 1::BIGINT AS TaxonomySourceID, 85::BIGINT AS SourceProjectID, 'Vertebrata' AS db_name
      FROM tcn""",
    "truncate_cast": "SELECT NameID, left(CommonName, 255) AS CommonName, left(LanguageCode, 2) AS Code FROM tcn",
    "redlist_term": """SELECT NameID, ProjectID::BIGINT AS ProjectID, AnalysisValue,
      regexp_replace(DisplayText, '^.{17}', '') AS Term FROM tnla JOIN tnlac USING (AnalysisID)""",
    "year_text": "SELECT NameID, concat(', ' || YearOfPubl) AS year FROM tn",
    "rename_ranks": f"SELECT {_ORIGIN}, rank FROM taxa WHERE s > 0",
    "rank_codes": f"SELECT {_ORIGIN}, rank, code AS rank_code FROM taxa WHERE s > 0",
    "by_project": "SELECT NameID, ProjectID::BIGINT AS ProjectID FROM tnp WHERE ProjectID = 930",
    "accepted_only": "SELECT NameID, ProjectID::BIGINT AS ProjectID FROM accepted",
    "not_accepted": "SELECT NameID, ProjectID::BIGINT AS ProjectID FROM unaccepted",
    "backbone_accepted": """SELECT TaxonID, canonicalName, taxonomicStatus FROM bb
      WHERE (taxonomicStatus = 'accepted' AND canonicalName <> '' AND parentCanonicalName <> '' AND kingdom = 'Animalia')
        OR canonicalName = 'Animalia'""",
    "backbone_synonym": "SELECT TaxonID, acceptedNameUsageID FROM bb WHERE taxonomicStatus = 'synonym'",
    "has_accepted_id": "SELECT TaxonID, acceptedNameUsageID FROM bb WHERE acceptedNameUsageID IS NOT NULL",
    "redlist_properties": f"""SELECT NameID, ProjectID::BIGINT AS ProjectID, DisplayText, AnalysisValue
      FROM tnla JOIN tnlac USING (AnalysisID) WHERE DisplayText IN ({_LABELS})""",
    "redlist_projects": "SELECT NameID, ProjectID::BIGINT AS ProjectID FROM tnl WHERE ProjectID BETWEEN 923 AND 927",
    "rank_band": "SELECT t.id, t.rank, b.band FROM taxa t JOIN band b ON b.id = t.id",
    "drop_parentless": "SELECT id, band, parent_taxon FROM bnd",
    "name_project": "SELECT NameID, ProjectID::BIGINT AS ProjectID, TaxonNameCache FROM tn JOIN tnp USING (NameID)",
    "name_hierarchy": """SELECT p.NameID, p.ProjectID::BIGINT AS ProjectID, h.NameParentID FROM tnp p
      LEFT JOIN th h ON h.NameID = p.NameID AND h.ProjectID = p.ProjectID""",
    "parent_name": """SELECT n.NameID, n.ProjectID::BIGINT AS ProjectID, h.NameParentID,
        p.GenusOrSupragenericName AS genus, p.SpeciesEpithet AS species, p.TaxonomicRank AS rank
      FROM tnp n LEFT JOIN th h ON h.NameID = n.NameID AND h.ProjectID = n.ProjectID
        LEFT JOIN tn p ON p.NameID = h.NameParentID""",
    "rank_lookup": """SELECT NameID, r.rank_code::BIGINT AS DisplayOrder FROM tn
      LEFT JOIN ranks r ON r.rank = tn.TaxonomicRank""",
    "list_fanout": """SELECT l.ProjectID::BIGINT AS ListProjectID, p.ProjectID::BIGINT AS ProjectID, n.NameID, n.TaxonomicRank,
        n.TaxonNameCache
      FROM tnl l JOIN tn n ON n.NameID = l.NameID JOIN tnp p ON p.NameID = n.NameID""",
    "synonym_target": """SELECT u.NameID, u.ProjectID::BIGINT AS ProjectID, s.SynNameID
      FROM unaccepted u JOIN tsyn s ON s.NameID = u.NameID""",
    "common_name_join": """SELECT c.NameID, p.ProjectID::BIGINT AS ProjectID, c.CommonName, c.LanguageCode
      FROM tcn c JOIN tn ON tn.NameID = c.NameID JOIN tnp p ON p.NameID = c.NameID""",
    "redlist_join": "SELECT * FROM rlvalues",
    "closure_step": """SELECT anc AS AncestorID, des AS DescendantID, len AS PathLength, s AS TaxonomySourceID,
      prj AS SourceProjectID FROM clo WHERE len > 0""",
    "self_doubles": """SELECT t.id, t.band, EXISTS (SELECT 1 FROM bnd o WHERE o.band = t.band AND o.taxon = t.taxon
      AND o.id <> t.id) AS is_double FROM bnd t""",
    "ancestor_family": """SELECT s AS TaxonomySourceID, prj AS SourceProjectID, des AS DescendantID, len AS PathLength, family,
      family_id FROM anfam""",
    "parent_by_key": "SELECT t.id, a.pid AS p1 FROM surv t LEFT JOIN par1 a ON a.id = t.id",
    "parent_by_name": """SELECT t.id, c.pid AS p3, d.pid AS p4 FROM surv t LEFT JOIN par3 c ON c.id = t.id
      LEFT JOIN par4 d ON d.id = t.id""",
    "next_rank": """SELECT t.id, t.code AS rank_code, r.rank_code::BIGINT AS new_code, r.rank AS new_rank FROM linked t
      JOIN ranks r ON r.rank_code = t.code + 10 OR r.rank_code = t.code - 10""",
    "parent_child_probe": "SELECT id, parent_id, state::BIGINT AS state FROM flag1 WHERE state <> 0",
    "orphans": "SELECT id, taxon, parent_id FROM orph",
    "link_by_key": f"""SELECT y.s AS TaxonomySourceID, y.sid AS SourceTaxonID, m.id AS by_key FROM syn y
      LEFT JOIN mkey m ON m.s = y.s AND m.prj = y.prj AND m.sid = y.acc""",
    "link_by_name": """SELECT y.s AS TaxonomySourceID, y.sid AS SourceTaxonID, m.id AS by_name FROM psyn y
      LEFT JOIN mname m ON m.taxon = y.acc_taxon AND m.fc = y.family""",
    "count_rows": """SELECT 'taxa' AS dataset, TaxonomySourceID, count(*) AS n FROM (SELECT TaxonomySourceID FROM xtaxa
        UNION ALL SELECT TaxonomySourceID FROM bbtaxa) GROUP BY ALL
      UNION ALL SELECT 'synonyms', TaxonomySourceID, count(*) FROM (SELECT TaxonomySourceID FROM xsyn
        UNION ALL SELECT TaxonomySourceID FROM bbsyn) GROUP BY ALL
      UNION ALL SELECT 'common_names', TaxonomySourceID, count(*) FROM xnames GROUP BY ALL
      UNION ALL SELECT 'redlist', TaxonomySourceID, count(*) FROM xred GROUP BY ALL""",
    "max_path_length": "SELECT max(depth) AS max_path_length FROM dep",
    "first_copy": "SELECT band, taxon, min(id) AS id FROM bnd GROUP BY ALL",
    "closure_level_counts": "SELECT len AS PathLength, count(*) AS n FROM clo GROUP BY ALL",
    "distinct_payload": "SELECT left(CommonName, 255) AS CommonName, left(LanguageCode, 2) AS Code FROM tcn GROUP BY ALL",
    "count_orphans": "SELECT count(*) AS n FROM orph",
    "closure": """SELECT anc AS AncestorID, des AS DescendantID, len AS PathLength, s AS TaxonomySourceID,
      prj AS SourceProjectID FROM clo""",
    "depth": f"SELECT {_ORIGIN}, depth FROM dep",
    "family_of": f"SELECT {_ORIGIN}, depth, family FROM lin",
    "prune_unconnected": "SELECT id, taxon, parent_id FROM merged",
    "closure_after_merge": """SELECT anc AS AncestorID, des AS DescendantID, len AS PathLength, s AS TaxonomySourceID,
      prj AS SourceProjectID FROM mclo""",
    "cycle_guard": f"SELECT {_ORIGIN} FROM dep WHERE depth > 4",
    "cycle_members": """WITH RECURSIVE size AS (SELECT max(c_custkey) AS n FROM customer),
      e AS (SELECT c_custkey AS a, (c_custkey * c_custkey + 1) % n + 1 AS b FROM customer, size
        UNION SELECT c_custkey, (3 * c_custkey + 2) % n + 1 FROM customer, size WHERE c_nationkey = 0),
      x AS (SELECT a, b FROM e WHERE a <> b AND b IN (SELECT c_custkey FROM customer)),
      r AS (SELECT a, b FROM x UNION SELECT r.a, x.b FROM r JOIN x ON r.b = x.a)
      SELECT min(p.b) AS cycle, 1::BIGINT AS TaxonomySourceID, 1::BIGINT AS SourceProjectID, p.a AS SourceTaxonID
      FROM r p JOIN r q ON p.a = q.b AND p.b = q.a GROUP BY p.a""",
    "split_bands": "SELECT band, s AS TaxonomySourceID, count(*) AS n FROM bnd GROUP BY ALL",
    "doubles_by_name": "SELECT id, taxon FROM cand WHERE band = 'family'",
    "doubles_by_family": "SELECT id, band, taxon, family FROM cand WHERE band <> 'family'",
    "doubles_without_family": f"""SELECT id, band, taxon FROM ({_COPIES}) t WHERE band <> 'family' AND family IS NULL
      AND EXISTS (SELECT 1 FROM ({_COPIES}) o WHERE o.band = t.band AND o.id <> t.id AND o.taxon = t.taxon)""",
    "pick_deepest": "SELECT band, id FROM win",
    "surviving_rows": "SELECT id FROM keepers",
    "family_cache": 'SELECT id, fc AS "familyCache" FROM surv',
    "merge_doubles": f'SELECT id, {_ORIGIN}, taxon, rank, fc AS "familyCache" FROM surv',
    "parent_same_source": "SELECT id, pid AS p1 FROM par1",
    "parent_same_family": "SELECT id, pid AS p2 FROM par2",
    "parent_any_family": "SELECT id, pid AS p3 FROM par3",
    "parent_same_rank": "SELECT id, pid AS p4 FROM par4",
    "link_parents": "SELECT id, taxon, parent_id FROM linked",
    "same_rank_flags": "SELECT id, code AS rank_code, pc AS parent_code, state::BIGINT AS state FROM flag1",
    "raise_rank": "SELECT id, code AS rank_code, new_code::BIGINT AS new_code, new_rank FROM up1",
    "lower_rank": "SELECT id, code AS rank_code, new_code::BIGINT AS new_code, new_rank FROM down1",
    "repair_ranks": "SELECT id, rank, code AS rank_code FROM round2",
    "merge_taxonomy": f"""SELECT id, {_ORIGIN}, taxon, parent_taxon, parent_id, rank, code AS rank_code, fc AS "familyCache",
        CASE WHEN s > 0 THEN 'Author ' || sid % 97 END AS author,
        CASE WHEN s > 0 THEN taxon || ' Author ' || sid % 97 END AS "scientificName"
      FROM merged""",
    "synonym_accepted_name": """SELECT s AS TaxonomySourceID, sid AS SourceTaxonID, acc AS SourceAcceptedTaxonID,
      acc_taxon AS accepted_taxon FROM psyn""",
    "synonym_family": """SELECT s AS TaxonomySourceID, sid AS SourceTaxonID, acc AS SourceAcceptedTaxonID,
      family AS "familyCache" FROM psyn""",
    "relink_synonyms": """SELECT y.s AS TaxonomySourceID, y.sid AS SourceTaxonID, y.taxon, coalesce(k.id, m.id) AS syn_taxon_id
      FROM psyn y LEFT JOIN mkey k ON k.s = y.s AND k.prj = y.prj AND k.sid = y.acc
        LEFT JOIN mname m ON m.taxon = y.acc_taxon AND m.fc = y.family""",
    "redlist_taxon_name": f"SELECT {_ORIGIN}, value, taxon FROM pred",
    "redlist_family": f'SELECT {_ORIGIN}, value, family AS "familyCache" FROM pred',
    "relink_redlist": """SELECT y.s AS TaxonomySourceID, y.prj AS SourceProjectID, y.sid AS SourceTaxonID, y.term, y.value,
        coalesce(k.id, m.id) AS taxon_id
      FROM pred y LEFT JOIN mkey k ON k.s = y.s AND k.prj = y.prj AND k.sid = y.sid
        LEFT JOIN mname m ON m.taxon = y.taxon AND m.fc = y.family""",
    "extract_taxa": "SELECT * FROM xtaxa",
    "extract_synonyms": "SELECT * FROM xsyn",
    "extract_common_names": "SELECT * FROM xnames",
    "extract_redlist": "SELECT * FROM xred",
    "extract_backbone_taxa": "SELECT * FROM bbtaxa",
    "extract_backbone_synonyms": "SELECT * FROM bbsyn",
    "backbone_accepted_collated": """SELECT TaxonID, canonicalName FROM (
        SELECT * REPLACE (CASE WHEN TaxonID % 2 = 1 THEN upper(taxonomicStatus) ELSE taxonomicStatus END AS taxonomicStatus,
          CASE WHEN TaxonID % 2 = 1 THEN replace(kingdom, 'a', chr(225)) ELSE kingdom END AS kingdom) FROM bb)
      WHERE (strip_accents(lower(taxonomicStatus)) = 'accepted' AND canonicalName <> '' AND parentCanonicalName <> ''
          AND strip_accents(lower(kingdom)) = 'animalia')
        OR strip_accents(lower(canonicalName)) = 'animalia'""",
}

#: A whole run merges the extracted rows instead of the staged ones.
_RUN_CTES = {
    # two checklists, the second with one of the projects of the first, and the backbone
    **{
        run: f"SELECT * FROM {rows} UNION ALL SELECT * REPLACE (2 AS TaxonomySourceID) FROM {rows} WHERE SourceProjectID = 930"
        + (f" UNION ALL SELECT * REPLACE (3 AS TaxonomySourceID) FROM {backbone}" if backbone else "")
        for run, rows, backbone in (
            ("runtaxa", "xtaxa", "bbtaxa"), ("runsyn", "xsyn", "bbsyn"), ("runred", "xred", ""), ("runnames", "xnames", "")
        )
    },
    "stg": """SELECT TaxonomySourceID AS s, SourceTaxonID AS sid, SourceParentTaxonID AS psid, SourceProjectID AS prj,
        canonicalName AS taxon, scientificNameAuthorShip AS author, parentCanonicalName AS parent_taxon, taxonRank AS rank,
        scientificName FROM runtaxa""",
    "taxa": f"""SELECT t.*, coalesce(r.rank_code, 0)::BIGINT AS code FROM (
        SELECT 4 + row_number() OVER (ORDER BY s, prj, sid, psid NULLS FIRST) AS id, s, sid, psid, prj, taxon, parent_taxon,
          {_RENAME} AS rank, NULL::BIGINT AS parent_id FROM stg
        UNION ALL SELECT * FROM (VALUES (1, 0, 1, NULL, 0, 'root', NULL, 'root', NULL),
          (2, 0, 2, 1, 0, 'Animalia', 'root', 'reg.', 1), (3, 0, 3, 1, 0, 'Plantae', 'root', 'reg.', 1),
          (4, 0, 4, 1, 0, 'Fungi', 'root', 'reg.', 1))) t
      LEFT JOIN ranks r ON r.rank = t.rank""",
    "syn": """SELECT TaxonomySourceID AS s, SourceTaxonID AS sid, SourceProjectID AS prj, SourceAcceptedTaxonID AS acc,
        canonicalName AS taxon, scientificNameAuthorShip AS author FROM runsyn""",
    "red": """SELECT TaxonomySourceID AS s, SourceTaxonID AS sid, SourceProjectID AS prj, Term AS term, Value AS value,
        Reference AS reference FROM runred""",
}

_RUN_FINAL = {
    "write_run": " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", count(*) AS n FROM {rows}"""
        for name, rows in (
            ("ranks", "ranks"), ("redlist_terms", "terms"), ("relations", "mclo"), ("sources", "(VALUES (1), (2), (3))"),
            ("taxa", "merged"), ("synonyms", "syn"), ("common_names", "runnames"), ("redlist", "red"),
        )
    ),
    "full_run_taxa": f"""SELECT m.id, m.s AS TaxonomySourceID, m.prj AS SourceProjectID, m.sid AS SourceTaxonID,
        m.psid AS SourceParentTaxonID, m.taxon, x.author, m.parent_taxon, x.scientificName, m.parent_id, m.rank,
        m.fc AS "familyCache"
      FROM merged m LEFT JOIN stg x ON x.s = m.s AND x.prj = m.prj AND x.sid = m.sid
        AND x.psid IS NOT DISTINCT FROM m.psid""",
    "full_run_synonyms": """SELECT y.s AS TaxonomySourceID, y.prj AS SourceProjectID, y.sid AS SourceTaxonID,
        y.acc AS SourceAcceptedTaxonID, y.taxon, y.author, coalesce(k.id, m.id) AS syn_taxon_id
      FROM psyn y LEFT JOIN mkey k ON k.s = y.s AND k.prj = y.prj AND k.sid = y.acc
        LEFT JOIN mname m ON m.taxon = y.acc_taxon AND m.fc = y.family""",
    "full_run_redlist": """SELECT y.s AS TaxonomySourceID, y.prj AS SourceProjectID, y.sid AS SourceTaxonID, y.term, y.value,
        y.reference, coalesce(k.id, m.id) AS taxon_id
      FROM pred y LEFT JOIN mkey k ON k.s = y.s AND k.prj = y.prj AND k.sid = y.sid
        LEFT JOIN mname m ON m.taxon = y.taxon AND m.fc = y.family""",
    "full_run_common_names": """SELECT TaxonomySourceID, SourceTaxonID, SourceProjectID, CommonName AS name, Code AS code, db_name
      FROM runnames""",
}


#: the same rules on names without case and accents
_plain = lambda name: f"strip_accents(lower({name}))"
_COLLATED_CTES = {
    "spelled": "SELECT s, sid, psid, rank, " + ", ".join(
        f"""CASE WHEN s = 2 AND sid % {n} = 0 THEN upper({name}) WHEN s = 2 AND sid % {n} = 1
          THEN translate({name}, 'aeou', 'äéöú') ELSE {name} END AS {name}""" for name, n in (("taxon", 3), ("parent_taxon", 4))
    ) + " FROM first_spelled",
    "first_spelled": CTES["stg"],
    "stg": f"SELECT * REPLACE ({_plain('taxon')} AS taxon, {_plain('parent_taxon')} AS parent_taxon) FROM spelled",
    "taxa": re.sub(r"'(Animalia|Plantae|Fungi)'", lambda m: m.group().lower(), CTES["taxa"]),
}
_COLLATED_FINAL = {
    "merge_taxonomy_collated": """SELECT m.id, m.s AS TaxonomySourceID, m.prj AS SourceProjectID, m.sid AS SourceTaxonID,
        coalesce(p.taxon, CASE WHEN m.id = 1 THEN 'root' ELSE upper(m.taxon[1]) || m.taxon[2:] END) AS taxon,
        coalesce(p.parent_taxon, m.parent_taxon) AS parent_taxon, m.parent_id, m.rank, m.code AS rank_code, m.fc AS family
      FROM merged m LEFT JOIN spelled p ON p.s = m.s AND p.sid = m.sid""",
    "relink_synonyms_collated": """SELECT y.s AS TaxonomySourceID, y.sid AS SourceTaxonID, y.taxon,
        p.taxon AS accepted_taxon, coalesce(k.id, m.id) AS syn_taxon_id
      FROM psyn y LEFT JOIN mkey k ON k.s = y.s AND k.prj = y.prj AND k.sid = y.acc
        LEFT JOIN mname m ON m.taxon = y.acc_taxon AND m.fc = y.family
        LEFT JOIN spelled p ON p.s = y.s AND p.sid = y.acc""",
}


def _needed(text: str, ctes: dict[str, str], seen: dict[str, None], name: str = "") -> None:
    for word in re.findall(r"(?:FROM|JOIN)\s+(\w+)", text):
        if word in ctes and word != name and word not in seen:
            _needed(ctes[word], ctes, seen, word)
            seen[word] = None


def oracle_queries() -> dict[str, str]:
    """SQL per query: the final select with the common table expressions it needs."""
    out = {}
    for finals, ctes in ((FINAL, CTES), (_RUN_FINAL, CTES | _RUN_CTES), (_COLLATED_FINAL, CTES | _COLLATED_CTES)):
        for name, final in finals.items():
            seen: dict[str, None] = {}
            _needed(final, ctes, seen)
            parts = [
                f"{c} AS {'' if c in ('clo', 'conn', 'mclo') else 'MATERIALIZED '}({ctes[c]})" for c in seen
            ]
            out[name] = f"WITH RECURSIVE {', '.join(parts)}\n{final}" if seen else final
    return out
