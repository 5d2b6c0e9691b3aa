"""BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a piece there is one last token that BPE would end it with. It is a vocabulary entry that
is a suffix of the prefix and whose pair with the last token of the remaining prefix BPE would leave alone.
All suffix matches of all prefixes come from one pass of an automaton with suffix links over the vocabulary;
the pair test undoes merges on both sides of the border and asks whether an earlier merge would have crossed
it. The last tokens are stored per prefix, and following them backwards gives the ids.

Ids equal those of the tokenizers library for the same file, added tokens in texts included. A null text
is an empty one, with no ids. Rows are kept as they are: repeated rows are encoded repeatedly, an empty table
gives an empty one, other columns are not read.
"""

import hashlib
import json
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.llm.pieces import Pieces, alphabet

VOCABULARY = "byte_bpe_50k.json"
#: Pair tests, and units of text, that a worker remembers.
PAIRS = 200_000
UNITS = 120_000


class Vocabulary:
    """Ids, merges and token bytes of a byte-level BPE file of the tokenizers library."""

    def __init__(self, source: str):
        model = json.loads(source)
        self.added = [(token["content"], token["id"]) for token in model["added_tokens"]]
        ids = model["model"]["vocab"]
        letters = alphabet()
        byte_of = {letter: byte for byte, letter in enumerate(letters)}
        # Tokens are numbered by the order of their merges, the single bytes first.
        strings = list(letters)
        self.split = [(byte, byte) for byte in range(256)]
        number = {letter: byte for byte, letter in enumerate(letters)}
        self.joined: dict[tuple[int, int], int] = {}
        for merge in model["model"]["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = number[left], number[right]
            if pair in self.joined:
                continue
            made = number.get(left + right)
            if made is None:
                made = number[left + right] = len(strings)
                strings.append(left + right)
                self.split.append(pair)
            self.joined[pair] = made
        self.ids = [ids[string] for string in strings]
        self.letters = str.maketrans({chr(byte): letter for byte, letter in enumerate(letters)})
        self.compatible: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for token, string in enumerate(strings):
            if token < 256 or self._apart(*self.split[token], limit=token):
                self.automaton.add_word(string, (token, len(string)))
        self.automaton.make_automaton()
        size = max([*ids.values(), *(made for _, made in self.added)]) + 1
        self.bytes = [b""] * size
        for string, made in ids.items():
            self.bytes[made] = bytes(byte_of[letter] for letter in string)
        for content, made in self.added:
            self.bytes[made] = content.encode()
        self.decimal = [str(made) for made in range(size)]
        self.pieces = Pieces(self._piece, UNITS)

    def _apart(self, left: int, right: int, limit: int = 1 << 62) -> bool:
        """Whether BPE leaves the border between two neighbouring tokens alone. ``limit``: the first merge
        that comes too late to cross it."""
        split, joined = self.split, self.joined
        while True:
            if joined.get((left, right), limit) < limit:
                return False
            # Before its last merge, the later-made token had a smaller part at the border.
            if left > right:
                limit, left = left, split[left][1]
                if left == limit:
                    limit, right = right + 1, split[right][0]
                    if right + 1 == limit:
                        return True
            else:
                limit, right = right + 1, split[right][0]
                if right + 1 == limit:
                    limit, left = left, split[left][1]
                    if left == limit:
                        return True

    def _piece(self, piece: str) -> bytes:
        """The ids of one piece, as unsigned 32-bit numbers."""
        string = piece.encode().decode("latin-1").translate(self.letters)
        last: list = [None] * len(string)
        known = self.compatible
        for end, (token, length) in self.automaton.iter(string):
            if last[end] is not None:
                continue
            rest = end - length
            if rest >= 0:
                before = last[rest][0]
                pair = before << 32 | token
                fits = known.get(pair)
                if fits is None:
                    if len(known) >= PAIRS:
                        known.clear()
                    fits = known[pair] = self._apart(before, token)
                if not fits:
                    continue
            last[end] = token, length
        found, place = [], len(string) - 1
        while place >= 0:
            token, length = last[place]
            found.append(self.ids[token])
            place -= length
        found.reverse()
        return array("I", found).tobytes()

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        return np.frombuffer(self._encode(text, 0), dtype=np.uint32)

    def _encode(self, text: str, added: int) -> bytes:
        """Added tokens are cut out of the text before anything else."""
        if not text:
            return b""
        if added == len(self.added):
            return self.pieces.encode(text)
        content, made = self.added[added]
        if content not in text:
            return self._encode(text, added + 1)
        between = array("I", [made]).tobytes()
        return between.join(self._encode(part, added + 1) for part in text.split(content))

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


_loaded: dict[int, Vocabulary] = {}


def loaded(source: str) -> Vocabulary:
    """One vocabulary per worker."""
    key = hash(source)
    if key not in _loaded:
        _loaded[key] = Vocabulary(source)
    return _loaded[key]


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = (), decoded: bool = True) -> DataFrame:
    """The ids of every text and the text that they decode to: ``id_column``, the columns ``keep``, ``ids`` array<int>,
    ``decoded``; or, without ``decoded``, ``round_trip``: whether they decode to the text.

    ``path`` is a vocabulary file of the tokenizers library, read on the driver and sent to the tasks (its size
    does not depend on the corpus).
    """
    source = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path or public_tokenizers.path(VOCABULARY)))

    name = "decoded" if decoded else "round_trip"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = loaded(source.value)
        for rows, texts in _groups(batches):
            ids = [known.encode(text) for text in texts]
            lengths = np.cumsum([0, *map(len, ids)])
            values = pa.array(np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32))
            lists = pa.ListArray.from_arrays(pa.array(lengths.astype(np.int32)), values)
            back = (known.decode(x.tolist()) for x in ids)
            last = pa.array(back, pa.string()) if decoded else pa.array([a == b for a, b in zip(back, texts, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([rows.column(0), *rows.columns[2:], lists, last], [id_column, *keep, "ids", name])

    kept = [F.col(id_column), F.coalesce(F.col(text_column), F.lit("")).alias("_encoded"), *map(F.col, keep)]
    inputs = docs.select(*kept)
    schema = T.StructType([inputs.schema[0], *inputs.schema.fields[2:], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField(name, T.StringType() if decoded else T.BooleanType())])
    return inputs.mapInArrow(run, schema)


def encode_digests(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The same encoding as digests: ``id_column``, ``n_tokens``, ``ids_sha256`` of the decimal ids joined by
    commas, ``decoded_sha256`` of the decoded text."""
    source = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path or public_tokenizers.path(VOCABULARY)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = loaded(source.value)
        decimal = known.decimal.__getitem__
        for rows, texts in _groups(batches):
            counts, of_ids, of_text = [], [], []
            for text in texts:
                ids = known.encode(text).tolist()
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                of_text.append(hashlib.sha256(known.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    inputs = docs.select(F.col(id_column).alias("key"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return inputs.mapInArrow(run, schema).withColumnRenamed("key", id_column)


def _groups(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Few rows at a time, so that outputs stay small; with the texts, which are the second column."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            part = batch.slice(start, size)
            yield part, part.column(1).to_pylist()
