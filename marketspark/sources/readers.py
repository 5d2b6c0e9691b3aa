"""Scans of layers and landed files. Schemas of landed files are declared; a layer's own schema is its Parquet footer's."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.text import or_blank, ticker_of_file
from ..operators.projections import normalised
from .scratch import stored


def read_layer(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All partitions of a Parquet layer in one scan."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_silver(spark: SparkSession, root: str, source: str) -> DataFrame:
    return read_layer(spark, f"{root}/silver/prices/{source}", schemas.SILVER_PRICES)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def files_in(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path``, ``file`` (as a URI) and ``bytes`` of every file below a folder, empty ones included. No content is read.

    Spark's listing knows all files by name; their sizes come from tasks, which skip empty ones.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    names = found.inputFiles()
    # The two differ in the slashes behind the scheme.
    plain = F.regexp_replace("file", "^([^:/]+):/+", "$1:/").alias("plain")
    listed = spark.createDataFrame([(name,) for name in names], "file string").select(F.col("file").alias("name"), plain)
    sizes = found.select("path", F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes")).select("*", plain)
    return sizes.join(listed, "plain", "full").select(
        F.coalesce("path", F.url_decode(F.replace("plain", F.lit("+"), F.lit("%2B")))).alias("path"),
        F.coalesce("file", "name").alias("file"),
        F.coalesce("bytes", F.lit(0).cast("bigint")).alias("bytes"),
    )


#: How landed CSV files are written: quotes are doubled inside quotes, blanks around fields do not count.
_CSV = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "mode": "PERMISSIVE"}


_NUMBERS = ("open", "high", "low", "close", "volume")


def _positions(number: int) -> T.StructType:
    return T.StructType([T.StructField(f"c{place}", T.StringType()) for place in range(number)])


def _ddl(shape: T.StructType) -> str:
    return ", ".join(f"{name} string" for name in shape.names)


def _lines(spark: SparkSession, paths) -> DataFrame:
    """``file``, ``value`` and ``place`` of every line; ``place`` is null behind a file's first split and grows within the first,
    which one task reads."""
    first = F.col("_metadata.file_block_start") == 0
    return _landed(spark, paths).text(paths).select(F.col("_metadata.file_path").alias("file"), "value", F.when(first, F.monotonically_increasing_id()).alias("place"))


def _headers(lines: DataFrame) -> DataFrame:
    """``file``, ``first`` and ``names``: the first line of each file that is not blank, its place and its normalised names."""
    begun = lines.filter(F.col("place").isNotNull() & (F.trim("value") != ""))
    first = stored(begun.groupBy("file").agg(F.min_by("value", "place").alias("line"), F.min("place").alias("first")))
    # No more fields than commas.
    commas = first.agg(F.max(F.length("line") - F.length(F.replace("line", F.lit(","), F.lit(""))))).first()[0] or 0
    shape = _positions(commas + 1)
    fields = F.from_csv("line", F.lit(_ddl(shape)), _CSV)
    names = first.select("file", "first", fields.alias("fields")).select("file", "first", F.array(*[F.col(f"fields.{name}") for name in shape.names]).alias("names"))
    plain = F.transform("names", lambda name: normalised(F.replace(name, F.lit("\ufeff"), F.lit(""))))
    return names.select("file", "first", plain.alias("names"))


def _landed(spark: SparkSession, paths):
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{csv,txt}")


def read_bulk_csv(spark: SparkSession, path: str, source: str, limit_files: int | None = None,
                  ticker_of=ticker_of_file, with_file: bool = False, quoted_breaks: bool = False) -> DataFrame:
    """A folder of one-ticker CSV/TXT files; the ticker is the file name unless ``ticker_of`` (from
    the path column) says otherwise.

    Each file is read by its own header, its first line, so column order and spelling may differ between files; fields may
    be quoted and hold commas then. Files without a date column give no rows, as do lines without a
    readable date. Files are split like any text, so a single very long one is still read by many tasks; with
    ``quoted_breaks`` quoted fields may hold line breaks, and a file is then read by one task.
    ``with_file`` adds the path of each row's file. Runs jobs that read the headers and store them, one row per file. Opening
    many small files costs more than their lines, so files are listed and opened once and all lines stored; with ``quoted_breaks``,
    where a record is not a line, files are opened twice.
    """
    paths = path
    if limit_files is not None:
        first = files_in(spark, path, "*.{csv,txt}").select("path").orderBy("path").limit(limit_files)
        paths = [row.path for row in first.collect()]
        if not paths:
            raise FileNotFoundError(f"no CSV files below {path}")
    lines = _lines(spark, paths)
    if not quoted_breaks:
        lines = stored(lines)
    headers = _headers(lines)
    number = headers.agg(F.max(F.size("names"))).first()[0] or 1
    # Where a file has a field, from 0; null, as is every value there, where it has none.
    places = [(F.nullif(F.array_position("names", name), F.lit(0)) - 1).cast("int").alias(name) for name in ("date", *_NUMBERS, "open_interest")]
    headers = headers.select("file", "first", F.struct(*places).alias("places"))
    shape = _positions(number)
    values = F.array(*[F.trim(f"fields.{name}") for name in shape.names]).alias("values")
    if quoted_breaks:
        # The reader drops each file's header and takes the columns by their place.
        rows = _landed(spark, paths).options(**_CSV, header="true", multiLine="true").schema(shape).csv(paths)
        rows = rows.select(F.col("_metadata.file_path").alias("file"), F.struct(*shape.names).alias("fields"))
        # One header row per file; how it is joined is left to its measured size.
        rows = rows.join(headers, "file")
    else:
        rows = lines.join(headers, "file").filter(F.col("place").isNull() | (F.col("place") > F.col("first")))
        rows = rows.select("file", "places", F.from_csv("value", F.lit(_ddl(shape)), _CSV).alias("fields"))
    rows = rows.select("file", "places", values)

    def field(name: str) -> Column:
        return F.get("values", F.col("places")[name])

    date = field("date").try_cast("timestamp_ntz")
    numbers = [field(name).try_cast("double").alias(name) for name in _NUMBERS]
    return rows.select(
        date.alias("date"),
        ticker_of(F.col("file")).alias("ticker"),
        *numbers,
        F.lit(source).alias("source"),
        F.current_timestamp().alias("ingested_at"),
        field("open_interest").try_cast("double").alias("open_interest"),
        *(["file"] if with_file else []),
    ).filter(F.col("date").isNotNull())


def read_news_json(spark: SparkSession, path: str) -> DataFrame:
    """Landed search responses, one JSON object per line."""
    return flatten_news(spark.read.schema(schemas.NEWS_PAYLOAD).json(path))


def flatten_news(payloads: DataFrame) -> DataFrame:
    """One row per article of a successful response; anything missing becomes an empty string."""
    articles = payloads.filter(F.col("status") == "ok").select("ticker", F.explode("articles").alias("a"))
    fields = {
        "title": "a.title",
        "description": "a.description",
        "url": "a.url",
        "source": "a.source.name",
        "published_at": "a.publishedAt",
        "content": "a.content",
    }
    return articles.select("ticker", *[or_blank(path).alias(name) for name, path in fields.items()])


def read_filings_json(spark: SparkSession, path: str, per_form: int | None = None) -> DataFrame:
    return flatten_filings(spark.read.schema(schemas.FILINGS_PAYLOAD).json(path), per_form)


def flatten_filings(payloads: DataFrame, per_form: int | None = None) -> DataFrame:
    """The hits of every successful response, or the first ``per_form`` of each; the form asked for stands in
    for a missing one."""
    found = F.col("hits.hits") if per_form is None else F.slice("hits.hits", 1, per_form)
    hits = payloads.filter(F.col("status") == 200).select("ticker", "form", F.posexplode(found).alias("position", "hit"))
    source = "hit._source."
    return hits.select(
        "ticker",
        F.coalesce(F.col(source + "form_type"), F.col("form")).alias("form_type"),
        *[
            or_blank(source + name).alias(name)
            for name in ("entity_name", "period_of_report", "file_date", "accession_no")
        ],
        F.col("position").cast("bigint").alias("position"),
    )


def footprint(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """Files and bytes of each dataset."""
    from ..operators.combine import union_sources

    return union_sources(
        *[
            files_in(spark, path).agg(
                F.lit(name).alias("dataset"),
                F.count(F.lit(1)).alias("files"),
                F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
            )
            for name, path in folders.items()
        ]
    )


def written_years(spark: SparkSession, path: str) -> DataFrame:
    """Rows, files and bytes of every year of a table partitioned by year."""
    files = files_in(spark, path, "*.parquet").groupBy(
        F.regexp_extract("path", r"year=(\d+)/", 1).cast("bigint").alias("year")
    ).agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    rows = spark.read.parquet(path).groupBy(F.col("year").cast("bigint").alias("year")).agg(F.count(F.lit(1)).alias("rows"))
    return rows.join(files, "year")


def load_summary(spark: SparkSession, rows: DataFrame, raw_path: str, written_path: str) -> DataFrame:
    """Files converted and skipped, rows, raw and written bytes and the space saved.

    ``rows`` are the rows read from ``raw_path``, with their ``file``. Empty files count as skipped.
    """
    raw = files_in(spark, raw_path, "*.{csv,txt}")
    per_file = rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    written = files_in(spark, written_path, "*.parquet").agg(F.coalesce(F.sum("bytes"), F.lit(0))).scalar()
    converted = F.col("rows").isNotNull()
    raw_bytes = F.coalesce(F.sum(F.when(converted, F.col("bytes"))), F.lit(0))
    return raw.join(per_file, "file", "left").agg(
        F.count_if(converted).alias("converted"),
        F.count_if(~converted).alias("skipped"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        raw_bytes.alias("raw_bytes"),
    ).withColumn("written_bytes", written).withColumn(
        "savings_pct",
        F.round((1 - F.col("written_bytes") / F.greatest(F.col("raw_bytes"), F.lit(1))) * 100, 2),
    )
