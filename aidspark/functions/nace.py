"""NACE rev. 2 macro-sector of an activity code such as '(NACE 2) C.28.2'."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the 19 mapped sections, in order ---------------------------
# Sections T and U are not mapped and count as unclassified.
NACE_SECTIONS = [
    ("A", "A - Agricoltura"),
    ("B", "B - Estrazione"),
    ("C", "C - Manifatturiero"),
    ("D", "D - Energia"),
    ("E", "E - Acqua e rifiuti"),
    ("F", "F - Costruzioni"),
    ("G", "G - Commercio"),
    ("H", "H - Trasporti"),
    ("I", "I - Servizi alloggio e ristorazione"),
    ("J", "J - Informazione e comunicazione"),
    ("K", "K - Assicurazioni e credito"),
    ("L", "L - Attività immobiliari"),
    ("M", "M - Attività professionali"),
    ("N", "N - Noleggio e servizi"),
    ("O", "O - PA e difesa"),
    ("P", "P - Istruzione"),
    ("Q", "Q - Sanità"),
    ("R", "R - Cultura e sport"),
    ("S", "S - Altri servizi"),
]
UNCLASSIFIED = "Altro / Non classificato"
# The code must start with the prefix, then the section letter and a literal
# dot: LIKE '(NACE 2) X.%'.
PREFIX = "(NACE 2) "


def _lookup() -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(NACE_SECTIONS)])


def section_letter(c) -> Column:
    """The mapped section letter of a code, or NULL (unclassified). A prefix
    test and two fixed character positions: no regex, no lookup."""
    col = F.col(c) if isinstance(c, str) else c
    n = len(PREFIX)
    letter = F.substring(col, n + 1, 1)
    coded = col.startswith(PREFIX) & (F.substring(col, n + 2, 1) == ".")
    return F.when(coded & letter.isin([k for k, _ in NACE_SECTIONS]), letter)


def section_label(letter) -> Column:
    """Label of a section letter (literal map lookup), or UNCLASSIFIED."""
    col = F.col(letter) if isinstance(letter, str) else letter
    return F.coalesce(F.try_element_at(_lookup(), col), F.lit(UNCLASSIFIED))


def macro_sector(c) -> Column:
    """Section label of a code, or UNCLASSIFIED: no join, no UDF."""
    return section_label(section_letter(c))


def macro_sector_sql(col: str) -> str:
    """The same mapping as a SQL CASE (used by oracle text)."""
    whens = " ".join(
        f"WHEN {col} LIKE '(NACE 2) {k}.%' THEN '{v}'" for k, v in NACE_SECTIONS)
    return f"CASE {whens} ELSE '{UNCLASSIFIED}' END"
