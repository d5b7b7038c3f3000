"""Tab-separated landing files with a header row and an explicit DDL schema.

Column names come from the DDL by position (the header row is skipped, not
matched), codes stay STRING so leading zeros survive, blanks around values
are kept, an empty field is NULL and an unparsable number is NULL.

Damaged files: ``read_tsv(..., corrupt=True)`` adds the raw line of every short,
long or unparsable row, whose readable fields are kept; ``strict_header=True``
makes the scan itself stop at a file whose header names other columns;
``header_report`` lists what each file's header is, for a rule to count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.quality import expect

CORRUPT = "_corrupt_record"
# Rules of a scan with its raw damaged lines, and of the headers of its files.
DAMAGE_RULES = [expect("well_formed_line", f"{CORRUPT} IS NULL")]
HEADER_RULES = [expect("header_as_declared", "as_declared")]

# Reader options of the landing files.
TSV_OPTIONS = {"header": "true", "sep": "\t"}
# The writer must not trim blanks, or fixed-width padded codes lose their width.
TSV_WRITE_OPTIONS = {"header": "true", "sep": "\t",
                     "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# DDL of each landing file (column order = file column order).
LANDING_DDL = {
    "class": "class_code STRING, class_text STRING, display_level INT, selectable STRING, sort_sequence INT",
    "duration": "duration_code STRING, duration_text STRING, display_level INT, selectable STRING, sort_sequence INT",
    "measure": "measure_code STRING, measure_text STRING, display_level INT, selectable STRING, sort_sequence INT",
    "sector": "sector_code STRING, sector_name STRING, display_level INT, selectable STRING, sort_sequence INT",
    "footnote": "footnote_code STRING, footnote_text STRING",
    "period": "period STRING, period_abbr STRING, period_name STRING",
    "seasonal": "seasonal_code STRING, seasonal_text STRING",
    "series": ("series_id STRING, sector_code STRING, class_code STRING, measure_code STRING, "
               "duration_code STRING, seasonal STRING, base_year STRING, footnote_codes STRING, "
               "begin_year STRING, begin_period STRING, end_year STRING, end_period STRING"),
    "data_0_current": "series_id STRING, year INT, period STRING, value DOUBLE, footnote_codes STRING",
    "data_1_alldata": "series_id STRING, year INT, period STRING, value DOUBLE, footnote_codes STRING",
}


def read_tsv(spark: SparkSession, path: str, ddl: str, corrupt: bool = False, strict_header: bool = False) -> DataFrame:
    """One scan, whatever is asked of it.  With ``corrupt`` a line that has too
    few or too many fields, or a number that does not parse, comes with its raw
    text in ``_corrupt_record``; its readable fields are as without."""
    reader = spark.read.options(**TSV_OPTIONS)
    if strict_header:
        reader = reader.option("enforceSchema", "false")
    if corrupt:
        ddl = f"{ddl}, {CORRUPT} STRING"
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    df = reader.schema(ddl).csv(path)
    if corrupt:
        # Only fields that a query asks for are parsed, so the raw line asks for all of them: by a
        # condition that always holds.
        fields = F.concat_ws("", *[F.col(c).cast("string") for c in df.columns if c != CORRUPT])
        df = df.withColumn(CORRUPT, F.when(F.length(fields) >= 0, F.col(CORRUPT)))
    return df


def header_report(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """file_path, header, as_declared: the first line of every file, and whether
    it names the columns of ``ddl`` in order.  The first line of a file is that
    of the split that starts at byte 0.  Texts are not carried along as lines are
    compared, which would sort a whole split: one scan keeps the hash of each
    file's first line, another the lines of that hash, so a task holds as many
    rows as it reads files.  What is broadcast is one hash a file."""
    want = "\t".join(StructType.fromDDL(ddl).names)
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file_path"), "value",
                                         F.col("_metadata.file_block_start").alias("_at"),
                                         F.monotonically_increasing_id().alias("_line")) \
        .where("_at = 0").withColumn("_hash", F.xxhash64("value"))
    hashes = lines.groupBy("file_path").agg(F.min_by("_hash", "_line").alias("_hash"))
    # Lines that only share the first one's hash come after it.
    texts = lines.join(F.broadcast(hashes), ["file_path", "_hash"]).groupBy("file_path", "value").agg(F.min("_line").alias("_line"))
    first = texts.groupBy("file_path").agg(F.min_by("value", "_line").alias("header"))
    return first.select("file_path", "header", (F.col("header") == want).alias("as_declared"))


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(**TSV_WRITE_OPTIONS).csv(path)
