"""Data-quality checks. Every check becomes a row (check, status, value, expected).

``evaluate`` runs any number of single-pass checks over a dataset as one aggregation.
"""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .aggregates import duplicates
from ..sources.readers import files_in
from .combine import union_sources


@dataclass(frozen=True)
class Check:
    name: str
    value: Column  # an aggregate
    passes: Column  # over the aggregate
    expected: str
    otherwise: str = "failed"

    def row(self) -> Column:
        return F.struct(
            F.lit(self.name).alias("check"),
            F.when(self.passes, "passed").otherwise(self.otherwise).alias("status"),
            self.value.cast("string").alias("value"),
            F.lit(self.expected).alias("expected"),
        )


def evaluate(df: DataFrame, *checks: Check) -> DataFrame:
    rows = df.agg(F.array(*[check.row() for check in checks]).alias("_checks"))
    return rows.select(F.inline("_checks"))


def _none(name: str, condition: Column) -> Check:
    bad = F.count_if(condition)
    return Check(name, bad, bad == 0, "0")


def not_null(*columns: str) -> list[Check]:
    return [_none(f"not_null_{name}", F.col(name).isNull()) for name in columns]


def min_rows(n: int, name: str = "min_rows") -> Check:
    rows = F.count(F.lit(1))
    return Check(name, rows, rows >= n, f">= {n}")


def positive(column: str = "close") -> Check:
    return _none(f"positive_{column}", F.coalesce(F.col(column) <= 0, F.lit(True)))


def starts_in_year(column: str, year: int) -> Check:
    first = F.min(column).cast("date")
    return Check(f"{column}_starts_in_year", first, F.coalesce(F.year(first) == year, F.lit(False)), str(year))


def key_count(column: str, n: int) -> Check:
    keys = F.count_distinct(F.col(column))
    return Check(f"{column}_count", keys, keys == n, str(n))


def no_future(column: str = "date") -> Check:
    return _none(f"{column}_not_in_future", F.col(column) > F.current_date())


def share_check(column: str = "title", min_share: float = 0.0) -> Check:
    rows = F.count(F.lit(1))
    filled = F.count_if(F.coalesce(F.col(column), F.lit("")) != "")
    share = F.round(filled * 100.0 / F.greatest(rows, F.lit(1)), 1)
    return Check(f"{column}_present_pct", share, share >= min_share * 100, f">= {min_share * 100:.1f}", "warned")


def has_values(column: str, values) -> Check:
    """All the required values occur. Counts per value, so nothing grows with the column."""
    found = [F.count_if(F.col(column) == value) > 0 for value in values]
    present = sum((hit.cast("int") for hit in found[1:]), found[0].cast("int"))
    return Check(f"{column}_has_values", present, present == len(found), str(len(found)))


def universe_check(n=fv.UNIVERSE_SIZE, required=fv.UNIVERSE_REQUIRED, forbidden=fv.UNIVERSE_FORBIDDEN) -> list[Check]:
    """Checks for a frame with one row per ticker."""
    rows = F.count(F.lit(1))
    checks = [Check("universe_size", rows, rows == n, str(n))]
    for ticker in required:
        hits = F.count_if(F.col("ticker") == ticker)
        checks.append(Check(f"universe_has_{ticker}", hits, hits > 0, "> 0"))
    for ticker in forbidden:
        checks.append(_none(f"universe_without_{ticker}", F.col("ticker") == ticker))
    return checks


def unique(df: DataFrame, keys) -> DataFrame:
    """One check row; the value is the number of keys that occur more than once."""
    return evaluate(duplicates(df, keys), Check("unique_" + "_".join(keys), F.count(F.lit(1)), F.count(F.lit(1)) == 0, "0"))


def test_summary(failing: DataFrame) -> DataFrame:
    """Failures of a test whose failing rows are given, and whether they should warn or stop."""
    failures = F.count(F.lit(1))
    return failing.agg(
        failures.alias("failures"), (failures != 0).alias("should_warn"), (failures != 0).alias("should_error")
    )


def _readable(spark: SparkSession, path: str) -> DataFrame:
    """``file`` and ``rows`` of every Parquet file below a path whose footer can be read. Tasks read all footers."""
    options = {"ignoreCorruptFiles": "true", "mergeSchema": "true", "recursiveFileLookup": "true"}
    return spark.read.options(**options).parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))


def unreadable_files(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``bytes`` and ``error`` of every file below a path that is not readable Parquet.

    Files with rows that Spark can read are fine; only the others are opened again, by tasks that parse their footer, to tell
    those without rows from broken ones. Empty files are broken. Runs a job: the names of the others reach the driver, as only
    files that are named in the scan's filter are left closed or opened.
    """
    def probe(batches):
        import io

        import pandas as pd
        import pyarrow.parquet as pq

        for batch in batches:
            found = []
            for name, size, content in zip(batch["path"], batch["bytes"], batch["content"], strict=True):
                try:
                    pq.read_metadata(io.BytesIO(content or b""))
                except Exception as problem:
                    found.append((name, size, f"{type(problem).__name__}: {problem}".splitlines()[0]))
            yield pd.DataFrame(found, columns=["path", "bytes", "error"])

    files = files_in(spark, path)
    plain = F.regexp_replace("file", "^([^:/]+):/+", "$1:/").alias("plain")
    suspects = files.select("path", "bytes", "file", plain)
    try:
        suspects = suspects.join(_readable(spark, path).select(plain), "plain", "left_anti")
    except AnalysisException as problem:
        # Not one footer tells a schema.
        if problem.getCondition() == "PATH_NOT_FOUND":
            raise
    names = [row["file"] for row in suspects.filter(F.col("bytes") > 0).select("file").collect()]
    contents = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    contents = contents.filter(F.col("_metadata.file_path").isin(names)).select(F.col("path").alias("at"), "content")
    opened = suspects.join(contents, F.col("path") == F.col("at"), "left").select("path", "bytes", "content")
    return opened.mapInPandas(probe, "path string, bytes bigint, error string")


def dataset_health(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Row count of each dataset, or the reason why it cannot be read. The status is always healthy. A dataset with broken files
    has the rows of the others and the number of broken ones as its error; ``unreadable_files`` names them."""

    def one(name, path):
        shape = [F.lit(name).alias("dataset"), F.lit("healthy").alias("status")]
        try:
            broken = unreadable_files(spark, path).agg(F.count(F.lit(1)).alias("broken"))
            try:
                count = _readable(spark, path).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
            except AnalysisException:
                count = spark.range(1).select(F.lit(None).cast("bigint").alias("rows"))
        except AnalysisException as problem:
            reason = problem.getCondition() or "UNREADABLE"
            return spark.range(1).select(*shape, F.lit(None).cast("bigint").alias("rows"), F.lit(reason).alias("error"))
        error = F.when(F.col("broken") > 0, F.concat(F.lit("UNREADABLE_FILES: "), F.col("broken").cast("string")))
        return count.join(broken).select(*shape, "rows", error.alias("error"))

    return union_sources(*[one(name, path) for name, path in paths.items()])


def tally(checks: DataFrame) -> DataFrame:
    return checks.groupBy("status").agg(F.count(F.lit(1)).alias("checks"))
