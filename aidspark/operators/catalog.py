"""Catalog statistics (D1-D6): manifests, column catalog, joinable columns,
file summary. All statistics are aggregates over the layer; nothing is
collected row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# --- fixed values: source coverage (first year, last year, months published in
# the last year) and the column-role rules of the catalog ---------------------
SOURCE_COVERAGE = (2017, 2026, 6)
SEMANTIC_TYPES = {
    "codice_fiscale_beneficiario": "fiscal_code",
    "regione_beneficiario": "region_code",
    "cup": "cup_code",
    "anno": "year",
    "mese": "month",
}
ENTITY_OF_TYPE = {"fiscal_code": "Ente (o Impresa)", "cup_code": "Progetto", "region_code": "Regione",
                  "year": "Tempo", "month": "Tempo"}
SQL_TYPE = {"string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT"}


def expected_months(year, coverage=SOURCE_COVERAGE):
    first, last, last_months = coverage
    return (F.when((year < first) | (year > last), F.lit(0))
            .when(year == last, F.lit(last_months)).otherwise(F.lit(12)))


def year_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``anno, size_mb`` of a written layer, from its files' metadata."""
    return file_summary(spark, path).where(F.col("anno").isNotNull()).select("anno", F.col("mb").alias("size_mb"))


def manifest_by_year(layer: DataFrame, coverage=SOURCE_COVERAGE, sizes: DataFrame | None = None) -> DataFrame:
    """Per year: rows, distinct months 1-12 present, months the source
    published, completeness = min(1, round_half_even(n / expected, 2)) or 0; with
    ``sizes`` (``year_sizes`` of the written layer) also ``size_mb``."""
    counts = layer.groupBy("anno", "mese").agg(F.count(F.lit(1)).alias("righe"))
    out = manifest_of_counts(counts, coverage)
    return out if sizes is None else out.join(sizes.select("anno", "size_mb"), "anno", "left")


def manifest_of_counts(counts: DataFrame, coverage=SOURCE_COVERAGE) -> DataFrame:
    """D1 from row counts (``righe``) per year, month and whatever else."""
    month = F.col("mese")
    g = counts.groupBy("anno").agg(
        F.sum("righe").cast("bigint").alias("righe"),
        F.array_sort(F.collect_set(F.when(month.between(1, 12), month))).alias("_m"))
    exp = expected_months(F.col("anno"), coverage)
    n = F.size("_m")
    return g.select(
        "anno", "righe",
        F.array_join(F.transform("_m", lambda x: x.cast("string")), ",").alias("mesi"),
        n.cast("bigint").alias("n_mesi"),
        exp.alias("mesi_attesi"),
        F.when(exp == 0, F.lit(0.0))
         .otherwise(F.least(F.lit(1.0), F.bround(n / exp, 2))).alias("completezza"))


def manifest_index(current: DataFrame, previous: DataFrame) -> DataFrame:
    """The current year manifests plus the years of the previous index
    that the current run does not cover (carried over), tagged by origin."""
    carried = previous.join(current.select("anno"), "anno", "left_anti")
    return (current.withColumn("origine", F.lit("corrente"))
            .unionByName(carried.withColumn("origine", F.lit("precedente"))))


def index_totals(index: DataFrame) -> DataFrame:
    """D2 totals: years and rows over the whole index, and its MB where the
    manifests carry sizes (carried-over years keep theirs)."""
    aggs = [F.count(F.lit(1)).alias("anni"), F.sum("righe").cast("bigint").alias("righe_totali")]
    if "size_mb" in index.columns:
        aggs.append(F.round(F.sum("size_mb"), 1).alias("mb_totali"))
    return index.agg(*aggs)


def manifest_measures(measures: DataFrame, size_bytes: int | None = None) -> DataFrame:
    """D3: rows and field count of the measure table; with ``size_bytes``
    (e.g. ``plans.storage.path_bytes`` of its folder) also its size in MB."""
    out = measures.agg(F.count(F.lit(1)).alias("righe")).withColumn(
        "campi", F.lit(len(measures.columns)).cast("bigint"))
    if size_bytes is not None:
        out = out.withColumn("size_mb", F.lit(round(size_bytes / 1_000_000, 1)))
    return out


def column_catalog(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """(dataset, column, type, role, semantic type) from each schema:
    double columns are metrics, everything else a dimension."""
    rows = []
    for ds, df in frames.items():
        for f in df.schema.fields:
            t = f.dataType.simpleString()
            rows.append((ds, f.name, SQL_TYPE.get(t, t.upper()), "metric" if t == "double" else "dimension",
                         SEMANTIC_TYPES.get(f.name)))
    schema = StructType([StructField(n, StringType()) for n in
                         ("dataset", "colonna", "tipo", "ruolo", "tipo_semantico")])
    return spark.createDataFrame(rows, schema)


def joinable_columns(catalog: DataFrame) -> DataFrame:
    """Entity index. One row per (entity, semantic type, dataset, column);
    ``colonne_stesso_tipo`` counts the columns that carry the same semantic
    type, and a column is joinable when that count is above one. Counts come
    from a grouped aggregate joined back on the type, not from listing pairs."""
    typed = catalog.where(F.col("tipo_semantico").isNotNull())
    ent = F.create_map(*[F.lit(x) for kv in ENTITY_OF_TYPE.items() for x in kv])
    per_type = typed.groupBy("tipo_semantico").agg(F.count(F.lit(1)).alias("colonne_stesso_tipo"))
    return (typed.join(per_type, "tipo_semantico")
            .select(F.try_element_at(ent, F.col("tipo_semantico")).alias("entita"), "tipo_semantico",
                    "dataset", "colonna", "colonne_stesso_tipo",
                    (F.col("colonne_stesso_tipo") > 1).alias("collegabile")))


def file_list(spark: SparkSession, path: str) -> DataFrame:
    """Rows and MB of each file of a written layer, one grouped count over
    ``_metadata``."""
    return (spark.read.parquet(path)
            .select("anno", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("b"))
            .groupBy("anno", "file").agg(F.count(F.lit(1)).alias("righe"), F.max("b").alias("byte"))
            .withColumn("mb", F.round(F.col("byte") / 1_000_000, 1)))


def file_summary(spark: SparkSession, path: str) -> DataFrame:
    """Files, rows and MB per year partition of a written layer, plus a
    total row (``anno`` NULL) via ROLLUP."""
    return (file_list(spark, path).rollup("anno")
            .agg(F.count(F.lit(1)).alias("file"), F.sum("righe").cast("bigint").alias("righe"),
                 F.round(F.sum("byte") / 1_000_000, 1).alias("mb")))


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that reads Parquet by the version 2 reader,
    which takes counts from file footers."""
    other = spark.newSession()
    other.conf.set("spark.sql.sources.useV1SourceList", "")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return other


def footer_plan(spark: SparkSession, path: str, by: str | None = "anno") -> DataFrame:
    """Rows of a written layer, by its partition column or in all, as an aggregate
    that the reader answers from footers. It belongs to a session of its own."""
    layer = _footer_session(spark).read.parquet(path)
    return layer.groupBy(*([by] if by else [])).agg(F.count(F.lit(1)).alias("righe"))


def footer_counts(spark: SparkSession, path: str) -> DataFrame:
    """``anno, righe, file, byte`` of a layer partitioned by year. Rows come from
    file footers and sizes from the file listing, so no data page is read. One
    row a year reaches the driver."""
    rows = {r["anno"]: r["righe"] for r in footer_plan(spark, path).collect()}
    year = F.regexp_extract("path", r"/anno=(-?[0-9]+)/", 1).try_cast("int")  # null for rows without a year
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
             .select(year.alias("anno"), "length").groupBy("anno").agg(F.count("*").alias("n"), F.sum("length").alias("b")).collect())
    size = {r["anno"]: (r["n"], r["b"]) for r in files}
    return spark.createDataFrame([(y, n, *size.get(y, (0, 0))) for y, n in rows.items()], "anno int, righe bigint, file bigint, byte bigint")


def rows_written(spark: SparkSession, path: str) -> int:
    """V2: rows of a written table, from its footers."""
    return footer_plan(spark, path, None).first()["righe"]
