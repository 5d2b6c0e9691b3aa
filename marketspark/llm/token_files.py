"""Token ids as Parquet files that can be read in part.

The documents are ordered by id across files and inside them. Ids are a list column with dictionary encoding
(two bytes a token for a vocabulary of 50,000), the numbers beside them are delta encoded, row groups and
pages have a bounded size, and every page has an entry in the page index: one document's tokens, or the
lengths of all documents, are read without the rest.

A null text is an empty one and has the end id alone. Repeated ids stay, one after the other; a null id sorts
first. An empty table gives no rows. Other columns are not read.
"""

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketspark.llm.bpe import VOCABULARY, read_vocabulary
from marketspark.llm.pieces import Pieces, alphabet

#: Units and pieces that a worker remembers, in characters of at most ``LONGEST`` each: a corpus has many more units than pieces.
UNITS = 500_000
PIECES = 20_000
LONGEST = 64
FILE_SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"
#: How the files are written: version 2 pages, so that numbers without a dictionary are delta encoded.
LAYOUT = {
    "compression": "snappy",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#part_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
}


class Encoder:
    """The tokenizers library, asked once for each piece that a worker meets."""

    def __init__(self, source: str):
        self.library = Tokenizer.from_str(source)
        self.library.no_truncation()
        self.library.no_padding()
        self.added = [token.content for token in self.library.get_added_tokens_decoder().values()]
        self.letters = str.maketrans({chr(byte): letter for byte, letter in enumerate(alphabet())})
        self.pieces = Pieces(self._piece, UNITS, PIECES, LONGEST)

    def _piece(self, piece: str) -> bytes:
        """By the library's model, which takes the bytes in the vocabulary's own letters."""
        letters = piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [token.id for token in self.library.model.tokenize(letters)]).tobytes()

    def encode(self, text: str) -> bytes:
        """Unsigned 32-bit ids. A text with an added token goes to the library as it is."""
        if any(content in text for content in self.added):
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        return self.pieces.encode(text) if text else b""


_loaded: dict[int, Encoder] = {}


def _encoder(source: str) -> Encoder:
    key = hash(source)
    if key not in _loaded:
        _loaded[key] = Encoder(source)
    return _loaded[key]


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Encodes every text, appends ``end_id`` and writes the files. Runs a job.

    Texts are dealt by ranges of ids, so a task holds a part of the order; equal ids are told apart by a hash of
    their text. ``part_start`` counts the ids before a document in its own part.
    """
    source = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path or public_tokenizers.path(VOCABULARY)))
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = _encoder(source.value), 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256)
                ids = [encoder.encode(text) + end for text in rows.column("text").to_pylist()]
                counts = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                places = np.concatenate([[0], np.cumsum(counts)])
                lists = pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(before + places[:-1]), pa.array(counts), lists], ["doc_id", "part_start", "n_tokens", "ids"])
                before += int(places[-1])

    inputs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    (
        inputs.repartitionByRange(F.col("doc_id"), tie)
        .sortWithinPartitions(F.col("doc_id"), tie)
        .mapInArrow(run, "doc_id long, part_start long, n_tokens long, ids array<int>")
        .select("doc_id", F.spark_partition_id().alias("part"), "part_start", "n_tokens", "ids")
        .write.options(**LAYOUT)
        .parquet(folder)
    )


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """The files as they are. Selecting columns and filtering on ``doc_id`` reads only those pages."""
    return spark.read.schema(FILE_SCHEMA).parquet(folder)


def part_starts(spark: SparkSession, folder: str) -> DataFrame:
    """The number of ids before each part; one row per file."""
    totals = read_files(spark, folder).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def index(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` of every document, without reading any token."""
    return _with_start(read_files(spark, folder).select("doc_id", "part", "part_start", "n_tokens"), spark, folder)


def _with_start(rows: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    return rows.join(part_starts(spark, folder), "part").withColumn("start", F.col("before") + F.col("part_start")).drop("part", "part_start", "before")


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` from the files' own tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values = memoryview(lists.values.to_numpy().astype("<u4", copy=False)).cast("B")
            places = lists.offsets.to_pylist()
            found = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(places, places[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(places).astype(np.int64)), pa.array(found, pa.int64())], ["doc_id", "part", "part_start", "n_tokens", "ids_crc32"])

    rows = read_files(spark, folder).select("doc_id", "part", "part_start", "ids")
    rows = rows.mapInArrow(run, "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long")
    return _with_start(rows, spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
