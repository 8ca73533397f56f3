"""Restriction enzymes, ligation junctions and wildcard motifs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: nucleotide wildcards
WILDCARDS = {
    "N": "[ACGT]",
    "M": "[AC]",
    "R": "[AG]",
    "W": "[AT]",
    "Y": "[CT]",
    "S": "[CG]",
    "K": "[GT]",
    "H": "[ACT]",
    "B": "[CGT]",
    "V": "[ACG]",
    "D": "[AGT]",
}

# fixed values: recognition sites used to cut a genome
RECOGNITION = {
    "HindIII": ("AAGCTT",),
    "DpnII": ("GATC",),
    "MboI": ("GATC",),
    "Sau3AI": ("GATC",),
    "Arima": ("GATC", "GANTC"),
}

# fixed values: ligation junction per enzyme or enzyme mix
JUNCTIONS = {
    "HindIII": ("AAGCTAGCTT",),
    "MseI": ("TTATAA",),
    "DpnII": ("GATCGATC",),
    "MboI": ("GATCGATC",),
    "NlaIII": ("CATG",),
    "NcoI": ("CCATGCATGG",),
    "MspI": ("CCGCGG",),
    "HinP1I": ("GCGCGC",),
    "StyD4I": ("CCNGGCCNGG",),
    "SaII": ("GTCGATCGAC",),
    "NheI": ("GCTAGCTAGC",),
    "StyI": ("CCWWGCWWGG",),
    "XhoI": ("CTCGATCGAG",),
    "BglII": ("AGATCGATCT",),
    "CviJI": ("AGCC", "GGCT", "AGCT", "GGCC", "GGGG", "GGGA", "AGGG", "CCCT",
              "CCCC", "TCCC", "AGAG", "CTCT"),
    "MluCI": ("AATTAATT",),
    "CviAII": ("CATATG",),
    "Csp6I": ("GTATAC",),
    "Arima": ("GAATAATC", "GAATACTC", "GAATAGTC", "GAATATTC", "GAATGATC",
              "GACTAATC", "GACTACTC", "GACTAGTC", "GACTATTC", "GACTGATC",
              "GAGTAATC", "GAGTACTC", "GAGTAGTC", "GAGTATTC", "GAGTGATC",
              "GATCAATC", "GATCACTC", "GATCAGTC", "GATCATTC", "GATCGATC",
              "GATTAATC", "GATTACTC", "GATTAGTC", "GATTATTC", "GATTGATC"),
    "MboI+MseI": ("GATCGATC", "TTATAA"),
    "CviQI+MseI": ("GTATAC", "TTATAA", "GTATAA", "TTATAC"),
    "Csp6I+MseI": ("GTATAC", "TTATAA", "GTATAA", "TTATAC"),
    "CviAII+MseI": ("CATATG", "CATTAA", "TTAATG", "TTATAA"),
    "CviAII+Csp6I": ("CATATG", "GTATAC", "CATTAC", "GTAATG"),
    "Csp6I+CviAII+MseI": ("CATATG", "CATTAA", "CATTAC", "TTAATG", "TTATAA",
                          "TTATAC", "GTATAC", "GTATAA", "GTAATG"),
}

UNKNOWN_JUNCTION = "XXXX"


def junctions(enzyme: str) -> tuple[str, ...]:
    """Junction motifs of an enzyme; mixes may be written in either order."""
    wanted = sorted(enzyme.split("+"))
    for name, motifs in JUNCTIONS.items():
        if sorted(name.split("+")) == wanted:
            return motifs
    return ()


def iupac_regex(motifs: str | tuple[str, ...]) -> str:
    """Regular expression for one motif or any of several, wildcards expanded."""
    if isinstance(motifs, str):
        motifs = (motifs,)
    expanded = ["".join(WILDCARDS.get(base, base) for base in m.upper()) for m in motifs]
    return expanded[0] if len(expanded) == 1 else "(" + "|".join(expanded) + ")"


def junction_for(enzyme: str) -> str:
    """Junction pattern of an enzyme, ``XXXX`` when it has none."""
    motifs = junctions(enzyme)
    return iupac_regex(motifs) if motifs else UNKNOWN_JUNCTION


def junction_column(enzyme: Column) -> Column:
    """Junction pattern looked up per row; mixes may be written in any order."""
    table = F.create_map(*[F.lit(x) for n in sorted(JUNCTIONS) for x in ("+".join(sorted(n.split("+"))), junction_for(n))])
    name = F.array_join(F.array_sort(F.split(enzyme, r"\+")), "+")
    return F.coalesce(F.try_element_at(table, name), F.lit(UNKNOWN_JUNCTION))


def dangling_motif(junction: str) -> str | None:
    """Second half of a plain junction; alternatives have no single half."""
    if "|" in junction or "[" in junction or junction == UNKNOWN_JUNCTION:
        return None
    return junction[len(junction) // 2:]


def methyl_pattern(junction: str) -> str:
    """Only the first C may read as T after bisulfite conversion."""
    return junction.replace("C", "[CT]", 1)


def has_junction(seq: Column, junction: str) -> Column:
    if junction == UNKNOWN_JUNCTION:
        return F.lit(False)
    return F.coalesce(seq.rlike(junction), F.lit(False))
