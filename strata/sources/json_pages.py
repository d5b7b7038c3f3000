"""API response pages as multi-line JSON documents under dated directories.

Each document is one whole API response: ``{"data": [record, ...], ...}``.
Pages land under ``yyyy=/mm=/dd=`` directories (one directory level per date
part), one document per file.  Readers look through the nested directories
(``recursiveFileLookup``), so the directory names carry no schema.

``read_rescued`` / ``stream_rescued`` lose nothing of a damaged page: fields
that the declared schema does not know are kept as JSON in ``_rescued_data``,
and a document that does not parse in ``_corrupt_record``.

The bronze reader declares ``data`` as STRING: Spark then keeps the raw JSON
array text, which silver parses with an explicit record schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.quality import expect

RESCUED, CORRUPT = "_rescued_data", "_corrupt_record"
# Rules of pages that were read with all that they hold.
RESCUE_RULES = [expect("known_fields_only", f"{RESCUED} IS NULL"), expect("readable_page", f"{CORRUPT} IS NULL")]

# Top-level fields of a landed page as bronze reads them, and
# the number of records per API page.
PAGE_SCHEMA = "data STRING, load_no INT"
PAGE_SIZE = 5000
JSON_READ_OPTIONS = {"multiLine": "true", "recursiveFileLookup": "true"}


def write_population_pages(loads: DataFrame, root: str, load_no: int, load_date: str,
                           page_size: int = PAGE_SIZE) -> None:
    """Write one load as API-like pages: documents of at most about
    ``page_size`` records keyed like the API ("Nation ID", "Nation", "Year",
    "Population").  Records of one year are hashed into
    ``ceil(count / page_size)`` pages (the per-year counts are a small table),
    so no page -- and no task building one -- collects an unbounded group."""
    yyyy, mm, dd = load_date.split("-")
    rec = F.struct(F.col("nation_id").alias("Nation ID"), F.col("nation").alias("Nation"),
                   F.col("year").cast("string").alias("Year"),
                   F.col("population").cast("double").alias("Population"))
    one = loads.filter(F.col("load_no") == load_no)
    per_year = one.groupBy("year").agg(
        F.ceil(F.count(F.lit(1)) / page_size).cast("int").alias("_pages"))
    paged = one.join(per_year, "year").withColumn(
        "page", F.concat_ws("-", F.col("year").cast("string"),
                            F.pmod(F.xxhash64("nation_id"), F.col("_pages")).cast("string")))
    pages = (paged.groupBy("load_no", "page")
             .agg(F.sort_array(F.collect_list(rec)).alias("data"))
             .withColumns({"yyyy": F.lit(yyyy), "mm": F.lit(mm), "dd": F.lit(dd)}))
    (pages.repartition("yyyy", "mm", "dd", "page")
          .write.mode("append").partitionBy("yyyy", "mm", "dd", "page").json(root))


def read_pages(spark: SparkSession, root: str, schema: str = PAGE_SCHEMA) -> DataFrame:
    """Batch read of every landed page."""
    return spark.read.options(**JSON_READ_OPTIONS).schema(schema).json(root)


def stream_pages(spark: SparkSession, root: str, schema: str = PAGE_SCHEMA,
                 max_files_per_trigger: int | None = None, archive: str | None = None) -> DataFrame:
    """Incremental read: each file is delivered once (the file log lives in
    the query checkpoint); files present at the first start are included.

    ``max_files_per_trigger`` bounds a micro-batch, so that a first run over
    many files is many bounded batches.  ``archive`` (a folder outside ``root``)
    takes the files of every finished batch, so that neither the listing nor the
    log of seen files grows with what has ever arrived; the files of a run's
    last batch move when the next run's first batch is done."""
    r = spark.readStream.options(**JSON_READ_OPTIONS).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return r.json(root)


def with_file_audit(df: DataFrame) -> DataFrame:
    """load_timestamp (processing time) and file_arrival_timestamp (the
    file's modification time), plus the file path for ordering ties."""
    return df.withColumns({
        "load_timestamp": F.current_timestamp(),
        "file_arrival_timestamp": F.col("_metadata.file_modification_time"),
        "file_path": F.col("_metadata.file_path"),
    })


def rescued(documents: DataFrame, schema: str = PAGE_SCHEMA) -> DataFrame:
    """``documents`` (one whole JSON document as text in ``value``) as pages of
    the declared columns (read from the fields of the same name, NULL if they
    are absent or of another type), ``_rescued_data``, the other fields as one
    JSON object (NULL if there are none), and ``_corrupt_record``, the text of a
    document that is no JSON object."""
    known = StructType.fromDDL(schema)
    others = [c for c in documents.columns if c != "value"]
    page = documents.select("value", *others, F.from_json("value", "map<string,string>", {"mode": "PERMISSIVE"}).alias("_page"))
    more = F.map_filter("_page", lambda k, v: ~k.isin(known.names))
    return page.select(*[F.col("_page")[f.name].try_cast(f.dataType).alias(f.name) for f in known.fields], *others,
                       F.when(F.size(more) > 0, F.to_json(more)).alias(RESCUED),
                       F.when(F.col("_page").isNull(), F.col("value")).alias(CORRUPT))


def read_rescued(spark: SparkSession, root: str, schema: str = PAGE_SCHEMA) -> DataFrame:
    return rescued(spark.read.option("recursiveFileLookup", "true").text(root, wholetext=True), schema)


def stream_rescued(spark: SparkSession, root: str, schema: str = PAGE_SCHEMA) -> DataFrame:
    return rescued(spark.readStream.option("recursiveFileLookup", "true").text(root, wholetext=True), schema)
