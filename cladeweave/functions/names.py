"""Name and authorship texts as column expressions.

The source databases pad text with blanks on comparison: a text of blanks equals
the empty text, and trailing blanks never make a difference. Concatenation with a
null gives null, so optional parts are guarded one by one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZOOLOGICAL_CODE = 3
#: ranks below this display order name a species or something below it
SPECIES_GROUP_ORDER = 180


def _text(value: str) -> Column:
    return F.lit(value)


def is_blank(column: Column) -> Column:
    """Null, empty or only blanks."""
    return column.isNull() | (F.rtrim(column) == "")


def _below_species_group(display_order: Column) -> Column:
    return F.coalesce(display_order < SPECIES_GROUP_ORDER, F.lit(False))


def _uninomial(genus: Column) -> Column:
    return F.concat(F.substring(genus, 1, 1), F.lower(F.substring(F.rtrim(genus), 2, 1 << 30)))


def _epithet(column: Column) -> Column:
    return F.when(column.isNull(), _text("")).otherwise(F.concat(_text(" "), column))


def canonical_name(genus: Column, species: Column, infraspecific: Column, display_order: Column) -> Column:
    """Name without author: the genus or higher name with lower-cased tail, and the
    epithets for ranks of the species group and below."""
    first = _uninomial(genus)
    full = F.rtrim(F.concat(first, _epithet(species), _epithet(infraspecific)))
    return F.when(_below_species_group(display_order), full).otherwise(first)


def year_text(year: Column) -> Column:
    """Year with its separator, nothing when unknown."""
    return F.when(year.isNull(), _text("")).otherwise(F.concat(_text(", "), year.cast("string")))


def _suffix(suffix: Column) -> Column:
    return F.when(suffix.isNull(), _text("")).otherwise(F.concat(_text(" "), F.rtrim(suffix)))


def zoo_authorship(
    basionym_authors: Column, basionym_year: Column, publication_year: Column, is_recombination: Column, suffix: Column
) -> Column:
    """Zoological authorship: authors and year, in brackets for a recombination.

    A recombination shows the year of the basionym, an original combination that of
    its publication; with an unknown flag there is no year.
    """
    moved = F.coalesce(is_recombination == 1, F.lit(False))
    original = F.coalesce(is_recombination == 0, F.lit(False))
    year = (
        F.when(moved, year_text(basionym_year)).when(original, year_text(publication_year)).otherwise(_text(""))
    )
    plain = F.concat(F.rtrim(basionym_authors), year)
    authors = F.when(moved, F.concat(_text("("), plain, _text(")"))).otherwise(plain)
    return F.concat(F.when(is_blank(basionym_authors), _text("")).otherwise(authors), _suffix(suffix))


def botanical_authorship(
    basionym_authors: Column,
    combining_authors: Column,
    sanctioning_author: Column,
    species: Column,
    infraspecific: Column,
    rank: Column,
    suffix: Column,
) -> Column:
    """Botanical authorship: basionym authors, in brackets before combining authors,
    sanctioning author after a colon, rank and epithet repeated for autonyms."""
    sanctioned = F.when(is_blank(sanctioning_author), _text("")).otherwise(
        F.concat(_text(" : "), F.rtrim(sanctioning_author))
    )
    first = F.concat(F.rtrim(basionym_authors), sanctioned)
    combined = ~is_blank(combining_authors)
    basionym = (
        F.when(is_blank(basionym_authors), _text(""))
        .when(combined, F.concat(_text(" ("), first, _text(") ")))
        .otherwise(F.concat(_text(" "), first))
    )
    autonym = ~is_blank(infraspecific) & F.coalesce(F.rtrim(species) == F.rtrim(infraspecific), F.lit(False))
    rank_part = F.when(is_blank(rank), _text("")).otherwise(F.concat(rank, _text(" ")))
    repeated = F.when(autonym, F.concat(_text(" "), rank_part, F.rtrim(infraspecific))).otherwise(_text(""))
    return F.concat(
        basionym, F.when(combined, F.rtrim(combining_authors)).otherwise(_text("")), repeated, _suffix(suffix)
    )


def authorship(code: Column, display_order: Column, zoological: Column, botanical: Column) -> Column:
    """Authorship by nomenclatural code; null above the species group."""
    return F.when(
        _below_species_group(display_order),
        F.when(F.coalesce(code == ZOOLOGICAL_CODE, F.lit(False)), zoological).otherwise(botanical),
    )


def truncated(column: Column, length: int) -> Column:
    return F.substring(column, 1, length)


#: length of the edition prefix of a red-list property label
LABEL_PREFIX = 17
LONGEST_TERM = 255


def redlist_term(label: Column) -> Column:
    """Property label without its edition prefix."""
    return F.substring(label, LABEL_PREFIX + 1, LONGEST_TERM)
