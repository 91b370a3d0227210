"""Damaged XML dumps -> one parsed record per row.

The dump is read with the plain text source and the record close tag as line
separator (with the prefix that the file's head shows), so every file is split
across tasks like any text file (no whole-file reads, no single-threaded parser). Each chunk is cut to its record,
repaired with regular expressions, and parsed with the built-in ``from_xml``
in PERMISSIVE mode: a record that still fails lands in the corrupt-record
column instead of stopping the job.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from aidspark.functions.salvage import salvage_xml
from aidspark.functions.text import repair_record
from aidspark.schemas import (AID_RECORD_TAG, AID_XML_SCHEMA, CORRUPT_COL, MEASURE_RECORD_TAG,
                              MEASURE_XML_SCHEMA)

# --- fixed values: source file naming ------------------------------------------
AID_FILE_GLOB = "OpenData_Aiuti_*.xml"
FILE_YEAR_MONTH = r"^.*OpenData_Aiuti_(\d{4})_(\d{2})"  # the last such path part counts


def record_text(spark: SparkSession, path: str | list[str], tag: str,
                glob: str | None = None, skip_bad_files: bool = False) -> DataFrame:
    """One row per text chunk that mentions the tag: ``_file``, ``_block``,
    ``record`` (NULL if the chunk holds no record).

    A file that cannot be read whole (truncated archive, removed after listing)
    fails the job. With ``skip_bad_files`` every file is read through once first
    and only whole ones are taken (``readable_files``), so no file contributes a
    part of its records."""
    if skip_bad_files:
        path = [r["fonte"] for r in readable_files(spark, path, glob).where("letto").collect()]
        if not path:
            return to_records(spark.createDataFrame([], "_file string, _block long, value string"), tag)
        glob = None
    reader = (spark.read.option("recursiveFileLookup", "true")
              .option("ignoreCorruptFiles", "false").option("ignoreMissingFiles", "false"))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    by_close: dict[str, list[str]] = {}
    for file, close in close_tags(spark, reader.text(path).inputFiles(), tag).items():
        by_close.setdefault(close, []).append(file)
    if set(by_close) <= {f"</{tag}>"}:
        return to_records(with_position(reader.option("lineSep", f"</{tag}>").text(path)), tag)
    read = [with_position(reader.option("lineSep", close).text(files)) for close, files in sorted(by_close.items())]
    return to_records(reduce(DataFrame.unionByName, read), tag)


#: Bytes of a file that are looked through for its first record (most files show it
#: in the first of them), and threads that fetch them.
HEAD_BYTES, HEAD_THREADS = (1 << 10, 1 << 16), 16


def close_tags(spark: SparkSession, files: list[str], tag: str) -> dict[str, str]:
    """Each file's record close tag, with the prefix of the first open tag in the
    file's head (plain if none is there). Only heads are read, by the driver that
    lists the files anyway."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop, io = jvm.org.apache.hadoop, jvm.org.apache.commons.io
    uri, hadoop_path, bounded, to_bytes = jvm.java.net.URI, hadoop.fs.Path, io.input.BoundedInputStream, io.IOUtils.toByteArray
    codecs = hadoop.io.compress.CompressionCodecFactory(conf)
    opened = re.compile(rb"<((?:[A-Za-z_][\w.\-]*:)?)" + tag.encode() + rb"[\s>]")

    def close_tag(file: str) -> str:
        path, found, head = hadoop_path(uri(file)), None, b""
        try:
            stream = path.getFileSystem(conf).open(path)
            codec = codecs.getCodec(path)
            stream = codec.createInputStream(stream) if codec is not None else stream
            try:
                for upto in HEAD_BYTES:
                    more = bytes(to_bytes(bounded(stream, upto - len(head))))
                    head += more
                    found = opened.search(head)
                    if found or not more:
                        break
            finally:
                stream.close()
        except Exception:  # noqa: BLE001 - a file that cannot be read fails, or is left out, where it is read
            found = None
        return f"</{found.group(1).decode() if found else ''}{tag}>"

    with ThreadPoolExecutor(HEAD_THREADS) as pool:
        return dict(zip(files, pool.map(close_tag, files)))


def with_position(raw: DataFrame) -> DataFrame:
    """File path and split offset of each text chunk."""
    return raw.select(F.col("_metadata.file_path").alias("_file"),
                      F.col("_metadata.file_block_start").alias("_block"), F.col("value"))


def readable_files(spark: SparkSession, path, glob: str | None = None) -> DataFrame:
    """Per input file whether it can be read to its end: ``fonte, byte, letto``.
    One distributed read of all files that keeps nothing; where the reader
    reports a file, halves are read until it is found. Any other error, such as a
    lost executor, is raised."""
    listing = {r["path"]: r["length"] for r in (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob or "*").load(path).select("path", "length").collect())}

    def bad(files: list[str]) -> list[str]:
        if not files:
            return []
        try:
            (spark.read.option("ignoreCorruptFiles", "false").option("ignoreMissingFiles", "false")
             .text(files).agg(F.sum(F.length("value"))).collect())
            return []
        except (PySparkException, Py4JJavaError) as e:
            if not any(c in str(e) for c in READ_ERRORS):
                raise
        if len(files) == 1:
            return files
        half = len(files) // 2
        return bad(files[:half]) + bad(files[half:])

    broken = set(bad(sorted(listing)))
    return spark.createDataFrame([(f, n, f not in broken) for f, n in listing.items()], "fonte string, byte long, letto boolean")


#: Error conditions by which the reader reports a file.
READ_ERRORS = ("FAILED_READ_FILE", "PATH_NOT_FOUND", "java.io.EOFException", "java.util.zip", "FileNotFoundException")


def to_records(chunks: DataFrame, tag: str) -> DataFrame:
    """One row per record of each chunk (text up to a plain close tag).

    A chunk is cut before every open tag of a record (optionally prefixed, with
    or without attributes); what stands before the first is dropped. The last
    part ends where the chunk was split, so it gets its close tag back. A part
    before it either has a prefixed close tag, where it is cut, or none: such a
    record stays unclosed and is quarantined by the parser, while its neighbours
    are read. (Namespace prefixes are removed by the repair step.)

    A chunk that is white space and one plain record, as nearly all are, is cut
    there without the pattern, which looks at every character. Literals are looked
    for by ``contains``, which compares bytes; ``instr`` counts characters at ten times
    the cost. The only filter is a literal pre-check on the raw chunk (drops trailers
    without the tag name)."""
    name, value = r"(?:[A-Za-z_][\w.\-]*:)?", F.col("value")
    text = F.ltrim(value, F.lit(" \t\r\n"))
    single = text.startswith(f"<{tag}") & ~value.contains(f":{tag}") & ~F.ltrim(text, F.lit("<")).contains(f"<{tag}")
    parts = F.when(single, F.array(text)).otherwise(F.split(value, rf"(?=<{name}{tag}[\s>])"))
    cut = (chunks.where(F.col("value").contains(tag)).select("_file", "_block", parts.alias("_all"))
           .select("_file", "_block", F.size("_all").alias("_parts"), F.posexplode_outer("_all").alias("_part", "_text")))
    closed = F.regexp_extract(F.col("_text"), rf"(?s)^(.*</[A-Za-z_][\w.\-]*:{tag}\s*>)", 1)
    cut = cut.where(F.col("_text").startswith(f"<{tag}>") | F.col("_text").rlike(rf"^<{name}{tag}[\s>]"))
    rec = (F.when(F.col("_text").contains(f":{tag}"), F.when(closed != "", closed)
                 .otherwise(F.when(F.col("_part") == F.col("_parts") - 1, F.concat("_text", F.lit(f"</{tag}>")))
                            .otherwise(F.col("_text"))))
           .when(F.col("_part") == F.col("_parts") - 1, F.concat("_text", F.lit(f"</{tag}>")))
           .otherwise(F.col("_text")))
    return cut.select("_file", "_block", rec.alias("record"))


def select_files_by_year(records: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Keep records of files whose name carries a year in range.

    The filter is on file metadata, so it runs before parsing."""
    y = F.regexp_extract(F.col("_file"), FILE_YEAR_MONTH, 1)
    return records.where((y != "") & y.cast("int").between(first_year, last_year))


def parse_records(records: DataFrame, schema: StructType, salvage: str | None = None) -> DataFrame:
    """Repair (``repair_record``: forbidden bytes and character references,
    namespace prefixes, truncated tags, bare ampersands) and parse each
    record: ``_seq`` is the record's order inside its
    split, ``r`` the parsed struct (NULL for a chunk without a record),
    ``r._corrupt_record`` the text of a record that did not parse. With
    ``salvage`` (the record's tag) such a record is parsed again with its markup
    closed (``salvage_xml``); ``_salvaged`` tells where that worked, and only what
    still fails is corrupt.

    Nothing is filtered here. The optimizer pushes a filter on ``r`` below this
    projection by substituting the ``from_xml`` call, which would parse every
    record twice; so ingest jobs tag rows with a status instead and split good
    rows, rejects and quarantine when writing (see ``plans.storage``).
    There is no shuffle between the scan and this projection, so
    ``(_file, _block, _seq)`` follows file order and is stable on re-run."""
    full = StructType(schema.fields + [StructField(CORRUPT_COL, StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}
    parsed = records.select("_file", "_block", F.monotonically_increasing_id().alias("_seq"),
                            F.from_xml(repair_record(F.col("record")), full, opts).alias("r"))
    if salvage is None:
        return parsed
    corrupt = F.col(f"r.{CORRUPT_COL}")
    again = F.when(corrupt.isNotNull(), F.from_xml(salvage_xml(corrupt, salvage, schema), full, opts))
    worked = F.col("_again").isNotNull() & F.col(f"_again.{CORRUPT_COL}").isNull()
    return (parsed.withColumn("_again", again)
            .select("_file", "_block", "_seq", F.when(worked, F.col("_again")).otherwise(F.col("r")).alias("r"), worked.alias("_salvaged")))


def read_aid_xml(spark: SparkSession, path, glob: str | None = None,
                 years: tuple[int, int] | None = None, skip_bad_files: bool = False, salvage: bool = False) -> DataFrame:
    """Parsed ``<AIUTO>`` records of a file, a directory or a list."""
    rec = record_text(spark, path, AID_RECORD_TAG, glob, skip_bad_files)
    if years:
        rec = select_files_by_year(rec, *years)
    return parse_records(rec, AID_XML_SCHEMA, AID_RECORD_TAG if salvage else None)


def read_measure_xml(spark: SparkSession, path, glob: str | None = None, salvage: bool = False) -> DataFrame:
    """Parsed ``<MISURA>`` records."""
    return parse_records(record_text(spark, path, MEASURE_RECORD_TAG, glob), MEASURE_XML_SCHEMA,
                         MEASURE_RECORD_TAG if salvage else None)


def parse_counts(parsed: DataFrame, source=None) -> DataFrame:
    """S15 counts: good and quarantined records per source, one aggregate in
    one pass (conditional sums, no filter, so each record is parsed once)."""
    src = source if source is not None else F.col("_file")
    present = F.col("r").isNotNull()
    bad = present & F.col(f"r.{CORRUPT_COL}").isNotNull()
    good = present & F.col(f"r.{CORRUPT_COL}").isNull()
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    found = [count(good).alias("record_ok"), count(bad).alias("record_scartati")]
    if "_salvaged" in parsed.columns:
        found.append(count(F.coalesce("_salvaged", F.lit(False))).alias("record_recuperati"))
    return parsed.groupBy(src.alias("fonte")).agg(*found)


def file_report(spark: SparkSession, path, parsed: DataFrame, glob: str | None = None) -> DataFrame:
    """Per input file: size, good and quarantined records, and whether it can be
    read to its end (``letto``)."""
    return (readable_files(spark, path, glob).join(parse_counts(parsed), "fonte", "left")
            .select("fonte", "byte",
                    F.coalesce("record_ok", F.lit(0)).cast("bigint").alias("record_ok"),
                    F.coalesce("record_scartati", F.lit(0)).cast("bigint").alias("record_scartati"), "letto"))
