"""The marts from one scan: rows are counted once for a few sets of columns, and
every mart is a coarser grouping of one of the sets (M1-M11).

One aggregate with grouping sets reads the raw layer once; each set keeps the
columns of its marts and, where they count firms, the firm, so distinct firms
stay exact. A single base at the grain of all marts together would keep nearly
every row, as a firm's grants seldom agree in all codes (measured: 561,552 groups
of 569,650 rows); the sets below hold far fewer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aidspark.functions.money import money, total
from aidspark.functions.nace import section_letter
from aidspark.operators import marts as M

SET = "insieme"
SETS = {
    "imprese": ["anno", M.REGION, "tipo_beneficiario", M.FIRM, "denominazione_beneficiario"],
    "codici": ["anno", "cod_procedimento", "procedimento", "strumento"],
    "obiettivi": ["anno", "cod_obiettivo", "obiettivo", M.FIRM],
    "sezioni": ["anno", M.REGION, M.SECTION, M.FIRM],
    "strumenti": ["anno", "cod_strumento", "strumento", M.FIRM],
}
#: The sets that each mart is a grouping of.
SETS_OF: dict[Callable, tuple[str, ...]] = {
    M.mart_per_regione: ("imprese",), M.mart_per_procedimento: ("codici",), M.mart_top_beneficiari: ("imprese",),
    M.mart_per_obiettivo: ("obiettivi",), M.mart_per_strumento: ("codici",), M.mart_tipo_beneficiario: ("imprese",),
    M.mart_settore_regione: ("sezioni",), M.mart_territorio: ("imprese",), M.mart_policy: ("obiettivi", "strumenti"),
    M.mart_top: ("imprese", "codici"),
}


def sets_for(marts: Iterable[Callable]) -> list[str]:
    """The sets that these marts need."""
    wanted = {s for fn in marts for s in SETS_OF[fn]}
    return [s for s in SETS if s in wanted]


def base(clean: DataFrame, sets: Iterable[str] = tuple(SETS)) -> DataFrame:
    """The counted rows of the sets: ``insieme``, the sets' columns (null outside
    their set) and ``_righe, _totale, _importi``."""
    sets = list(sets)
    columns = list(dict.fromkeys(c for s in sets for c in SETS[s]))
    rows = clean.withColumn(M.SECTION, section_letter("settore_attivita")) if M.SECTION in columns else clean
    # the bit of a column is set where a set leaves it out
    code = {sum((c not in SETS[s]) << (len(columns) - 1 - i) for i, c in enumerate(columns)): s for s in sets}
    counted = (rows.select(*columns, M.AMOUNT)
               .groupingSets([[F.col(c) for c in SETS[s]] for s in sets], *columns)
               .agg(F.grouping_id().alias("_gid"), F.count(F.lit(1)).alias(M.ROWS), total(M.AMOUNT).alias(M.TOTAL),
                    F.count(money(M.AMOUNT)).alias(M.AMOUNTS)))
    names = F.create_map(*[F.lit(x) for pair in code.items() for x in pair])
    return counted.select(names[F.col("_gid").cast("int")].alias(SET), *columns, M.ROWS, M.TOTAL, M.AMOUNTS)


def mart(fn: Callable, counted: DataFrame) -> DataFrame:
    """A mart from the counted rows (``insieme`` is a partition of the written
    ones, so a mart reads its sets only). A mart of two parts filters each by its
    own columns, which are null in the other's set."""
    return fn(counted.where(F.col(SET).isin(list(SETS_OF[fn]))))
