"""BPE, token files, SimHash and substring deduplication on odd documents, against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from llm_fixtures import no_docs, odd_docs, odd_rows, passage  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketspark.llm import bpe, pieces, simhash, substrings, token_files
from marketspark.sources.scratch import new_folder, stored

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_bpe_is_the_library_s(odd_docs, odd_rows, library):
    expected = Counter()
    for row in odd_rows:
        ids = library.encode(row[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        expected[row[0], len(ids), sha(",".join(map(str, ids)).encode()), sha(text.encode())] += 1
    assert Counter(map(tuple, bpe.encode_digests(odd_docs).collect())) == expected


def test_bpe_keeps_columns_and_decodes(odd_docs, odd_rows):
    found = bpe.encode(odd_docs, keep=("key", "n_chars")).collect()
    assert Counter((row.doc_id, row.decoded, row.n_chars) for row in found) == Counter((row[0], row[1] or "", row[4]) for row in odd_rows)


def test_every_token_and_odd_character(library):
    own = bpe.loaded(bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json")))
    other = token_files.Encoder(bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json")))
    texts = [library.decode([k]) for k in range(0, 50_256, 7)]
    for code in [*range(0x250), *range(0x2000, 0x2070), 0x1680, 0x180E, 0x3000, 0xFEFF, 0x1F600, 0xB2, 0x2160]:
        x = chr(code)
        texts += [f"a{x}b {x} c{x}{x}d {x}e\n{x}f, {x}. {x}"]
    texts += ["a , b", ", x. y", "...,  x", "foo_, bar. baz", "x., y", "1, 2. 3.\n4,\n5", "a. ", "a,", ". ", "\n\n a", "a\n \nb"]
    for text in texts:
        expected = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == expected, text
        assert np.frombuffer(other.encode(text), dtype=np.uint32).tolist() == expected, text
        assert "".join(map(pieces.written, pieces.units(text))) == text


def test_remembering_is_bounded():
    made = pieces.Remembered(lambda key: key * 2, limit=10)
    assert [made[k % 37] for k in range(500)] == [k % 37 * 2 for k in range(500)]
    assert len(made) <= 11 and len(made.older) <= 10


def test_token_files(spark, odd_docs, odd_rows, library):
    folder = new_folder(spark)
    token_files.write_tokens(odd_docs, folder)
    found = sorted(token_files.checksums(spark, folder).collect(), key=lambda row: row.start)
    assert [row.doc_id for row in found] == sorted([row[0] for row in odd_rows], key=lambda x: (x is not None, x))
    place, known = 0, Counter()
    for row in odd_rows:
        ids = library.encode(row[1] or "", add_special_tokens=False).ids + [0]
        known[row[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    for row in found:
        assert row.start == place
        place += row.n_tokens
    assert Counter((row.doc_id, row.n_tokens, row.ids_crc32) for row in found) == known
    assert sorted(map(tuple, token_files.index(spark, folder).select("start", "n_tokens").collect())) == [(row.start, row.n_tokens) for row in found]
    one = token_files.read_files(spark, folder).where("doc_id = 4").select("ids").collect()
    assert one[0].ids == library.encode("Two Words").ids + [0]


def test_token_files_encodings(spark, odd_docs, tmp_path):
    import pyarrow.parquet as pq

    folder = f"{tmp_path}/tokens"
    token_files.write_tokens(odd_docs, folder)
    group = pq.ParquetFile(next(tmp_path.glob("tokens/*.parquet"))).metadata.row_group(0)
    encodings = {group.column(k).path_in_schema: group.column(k) for k in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in encodings["doc_id"].encodings
    assert any("DICTIONARY" in x for x in encodings["ids.list.element"].encodings)
    assert encodings["doc_id"].has_offset_index


def fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = np.array([xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles], dtype=np.uint64)
    return sum(1 << bit for bit in range(64) if len(hashes) and 2 * int(((hashes >> np.uint64(bit)) & np.uint64(1)).sum()) > len(hashes))


def groups(prints, bits):
    """Smallest id that each id reaches."""
    label = {key: key for key in prints}
    while True:
        new = {a: min(label[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= bits) for a in prints}
        if new == label:
            return label
        label = new


@pytest.mark.parametrize("bits", [0, 1, 3, 6])
def test_simhash(odd_docs, odd_rows, bits):
    prints = {row[0]: fingerprint(row[1]) for row in odd_rows if row[0] is not None}
    expected = groups(prints, bits)
    found = simhash.near_duplicates(odd_docs, max_bits=bits).collect()
    assert len(found) == len(odd_rows)
    for row in found:
        if row.doc_id is not None:
            assert (row.fingerprint, row.component_id) == (f"{prints[row.doc_id]:016x}", expected[row.doc_id])
        else:
            assert row.component_id == 7


def test_simhash_chain_and_many_copies(spark):
    """Fingerprints in a chain of steps of three bits, and a variant that many share."""
    chain = [sum(7 << (3 * k) for k in range(n)) for n in range(21)]
    hub = [(1 << 63) ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)]
    prints = {k: x for k, x in enumerate([*chain, *hub])}
    rows = [(k, x - (1 << 64) if x >> 63 else x) for k, x in prints.items()]
    pairs = simhash.near_pairs(spark.createDataFrame(rows, "node long, bits long"))
    found = Counter(frozenset(row) for row in pairs.collect())
    assert found == Counter(frozenset((a, b)) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3)


def test_variants_are_not_broadcast(spark):
    """A table of fingerprints is 64 times its size once it is exploded, which Spark's estimate leaves out."""
    distinct = spark.range(1000).select(F.xxhash64("id").alias("bits"))
    pairs = simhash.near_pairs(stored(distinct).select(F.col("bits").alias("node"), "bits"))
    pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_first_of_groups_keeps_columns(odd_docs, odd_rows):
    found = simhash.first_of_groups(odd_docs)
    assert found.columns == odd_docs.columns
    label = groups({row[0]: fingerprint(row[1]) for row in odd_rows if row[0] is not None}, 3)
    assert sorted([row.doc_id for row in found.collect()], key=lambda x: (x is None, x)) == [*sorted(set(label.values())), None]


def test_first_of_groups_by_row(spark):
    """An id on two rows with different texts loses neither, and only the near-duplicate of another document goes."""
    texts = [" ".join(f"{word}{k}" for k in range(80)) for word in ("ab", "cd", "ef")]
    rows = [(5, texts[0]), (5, texts[1]), (3, texts[2]), (7, texts[2]), (7, texts[1]), (5, texts[0])]
    found = simhash.first_of_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, found.collect())) == sorted([(5, texts[0]), (5, texts[1]), (3, texts[2])])


def kept_words(rows):
    first = {}
    words = [(row[0], (row[1] or "").encode().split()) for row in rows]
    for key, own in words:
        if key is not None:
            for k in range(len(own) - 12):
                window = tuple(own[k : k + 13])
                first[window] = min(first.get(window, key), key)
    for key, own in words:
        stays = [True] * len(own)
        for k in range(len(own) - 12 if key is not None else 0):
            if first[tuple(own[k : k + 13])] < key:
                stays[k : k + 13] = [False] * 13
        yield key, own, [word for word, stay in zip(own, stays, strict=True) if stay]


@pytest.mark.parametrize("hot", [256, 1])
def test_substrings(odd_docs, odd_rows, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    expected = Counter((key, len(own), len(own) - len(kept), sha(b" ".join(kept))) for key, own, kept in kept_words(odd_rows))
    assert Counter(map(tuple, substrings.digests(odd_docs).collect())) == expected
    assert any(key[2] for key in expected)


def test_substrings_with_full_filters(odd_docs, odd_rows, monkeypatch):
    """Filters that let everything through change nothing."""
    monkeypatch.setattr(substrings.bloom, "build", lambda items, blocks: np.full(blocks * substrings.bloom.BLOCK // 8, 255, dtype=np.uint8))
    expected = Counter((key, len(own) - len(kept)) for key, own, kept in kept_words(odd_rows))
    assert Counter((row.doc_id, row.n_removed) for row in substrings.digests(odd_docs).collect()) == expected


def test_many_variants_of_a_passage(spark):
    """One passage in many different surroundings: more variants than an index takes, and fewer."""
    middle = passage(77, 16)
    rows = [(k, f"{passage(100 + k, 9)} {middle} {passage(900 + k // 2, 9)}") for k in range(400)]
    found = substrings.digests(spark.createDataFrame(rows, "doc_id long, text string"))
    expected = Counter((key, len(own), len(own) - len(kept), sha(b" ".join(kept))) for key, own, kept in kept_words(rows))
    assert Counter(map(tuple, found.collect())) == expected


def test_cut_texts_keep_the_rest(odd_docs, odd_rows):
    found = substrings.without_repeats(odd_docs)
    assert found.columns == odd_docs.columns
    rows = found.collect()
    assert Counter((row.doc_id, tuple((row.text or "").encode().split())) for row in rows) == Counter((key, tuple(kept)) for key, _, kept in kept_words(odd_rows))
    assert all(row.n_chars == len(row.text) for row in rows if row.text is not None and row.doc_id is not None)
    texts = {row.doc_id: row.text for row in rows}
    assert texts[0] is None and texts[14] == odd_rows[14][1]


def test_empty_tables(spark, no_docs):
    assert bpe.encode_digests(no_docs).count() == 0
    folder = new_folder(spark)
    token_files.write_tokens(no_docs, folder)
    assert token_files.checksums(spark, folder).count() == 0
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.first_of_groups(no_docs).count() == 0
    assert substrings.digests(no_docs).count() == 0
    assert substrings.without_repeats(no_docs).count() == 0
