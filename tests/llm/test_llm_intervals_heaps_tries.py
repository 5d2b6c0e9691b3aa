"""Byte strings, clusters and tries against brute force."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import no_docs, odd_docs, odd_rows, passage  # noqa: F401
from pyspark.sql import functions as F

from marketspark.llm import centroids, prefix_trie, repeated_bytes, simhash, substrings
from marketspark.llm.interval_expansion import repeated, sorted_suffixes

LENGTH = repeated_bytes.LENGTH


# --- byte strings -----------------------------------------------------------------


@pytest.mark.parametrize("letters", [1, 2, 3, 255])
def test_repeated_strings(letters):
    rng = random.Random(letters)
    for _ in range(60):
        length = rng.choice([1, 2, 3, 5, 8, 13, 20])
        texts = [bytes(rng.randrange(256 - letters, 256) for _ in range(rng.choice([0, 1, 5, 30, 60]))) for _ in range(rng.randint(1, 8))]
        weights = [rng.choice([1, 1, 2]) for _ in texts]
        counts = Counter()
        for text, weight in zip(texts, weights, strict=True):
            for at in range(len(text) - length + 1):
                counts[text[at : at + length]] += weight
        expected = [at + length <= len(text) and counts[text[at : at + length]] > 1 for text in texts for at in range(len(text) + 1)]
        symbols = np.concatenate([np.append(np.frombuffer(text, dtype=np.uint8).astype(np.int64) + 1, 0) for text in texts])
        found = repeated(symbols, np.repeat(weights, [len(text) + 1 for text in texts]), length)
        assert found.tolist() == expected


def test_no_strings():
    assert not len(repeated(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 5))


def test_sorted_suffixes():
    rng = random.Random(5)
    text = bytes(rng.choice(b"ab") for _ in range(500))
    symbols = np.append(np.frombuffer(text, dtype=np.uint8).astype(np.int64) + 1, 0)
    assert sorted_suffixes(symbols, 600).tolist() == sorted(range(501), key=lambda at: symbols[at:].tolist())


def test_segments_hold_every_window_once():
    texts = [passage(k, 300).encode() for k in range(4)] + [b"x" * 1000, b"short", b""]
    texts.append(texts[1])
    data, offsets = np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0, *map(len, texts)])
    found = repeated_bytes.Segments(data, offsets)
    assert found.n.sum() == sum(max(len(text) - LENGTH + 1, 0) for text in texts) and found.n.max() <= repeated_bytes.RUN
    anchors, whole = {}, data.tobytes()
    for anchor, start, n in zip(found.anchor, found.start, found.n, strict=True):
        for at in range(start, start + n):
            assert anchors.setdefault(whole[at : at + LENGTH], anchor) == anchor
    assert found.inside[found.document == 4].all()


def brute_bytes(texts):
    counts = Counter(text[at : at + LENGTH] for text in texts for at in range(len(text) - LENGTH + 1))
    rows = []
    for text in texts:
        gone = np.zeros(len(text), dtype=bool)
        for at in range(len(text) - LENGTH + 1):
            if counts[text[at : at + LENGTH]] > 1:
                gone[at : at + LENGTH] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(int)))
        kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
        rows.append((len(text), int(gone.sum()), len(edges) // 2, kept, [tuple(map(int, edge)) for edge in edges.reshape(-1, 2)]))
    return rows


def byte_texts(odd_rows):
    """The odd rows, one common passage between many different ones, a periodic text, and copies."""
    common = passage(50, 90)
    more = [passage(100 + k, 20 + k) + common + passage(200 + k, 25) for k in range(30)]
    more += ["ab" * 700, "x" * 900, passage(70, 100), passage(70, 100) + "!", common[:150], common[-230:]]
    return [*odd_rows, *[(1000 + k, text, None, None, 0, "k", 1, 2, "h", "n", "s", "l") for k, text in enumerate(more)]]


# With hot = 2 nearly every anchor gets the longer one; with 1 << 20 none does.
@pytest.mark.parametrize("hot", [None, 2, 1 << 20])
def test_repeated_bytes(spark, odd_rows, odd_docs, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(repeated_bytes, "HOT", hot)
    rows = byte_texts(odd_rows)
    docs = spark.createDataFrame(rows, odd_docs.schema).repartition(5)
    texts = [(row[1] or "").encode() for row in rows]
    expected = [(row[0], *one) for row, one in zip(rows, brute_bytes(texts), strict=True)]
    assert sum(one[2] for one in expected) > 5000
    found = [tuple(row) for row in repeated_bytes.digests(docs).collect()]
    assert sorted(found, key=str) == sorted(((k, n, gone, spans, hashlib.sha256(kept).hexdigest()) for k, n, gone, spans, kept, _ in expected), key=str)
    if hot is None:
        whole = [(row["doc_id"], bytes(row["kept"]), [(span["begin"], span["end"]) for span in row["removed"]]) for row in repeated_bytes.without_repeats(docs).collect()]
        assert sorted(whole, key=str) == sorted(((k, kept, edges) for k, _, _, _, kept, edges in expected), key=str)


def test_common_windows_meet_once_for_each_slice(spark, monkeypatch):
    """A passage in very many segments is joined by slice, not by segment."""
    common = passage(50, 60).encode()
    assert len(common) > LENGTH + 20
    texts = [passage(300 + k, 3).encode()[-12:] + common[: LENGTH + 20] + passage(400 + k, 3).encode()[:12] for k in range(40)]
    rows = [(7, k, 1, text) for k, text in enumerate(texts)]
    classes = spark.createDataFrame(rows, "anchor long, segment long, weight long, bytes binary").coalesce(1)
    tables, stored = [], repeated_bytes.stored
    monkeypatch.setattr(repeated_bytes, "stored", lambda df, *folder: tables.append(stored(df, *folder)) or tables[-1])
    found = {row["segment"]: [row[name] for name in ("m0", "m1", "m2", "m3")] for row in repeated_bytes._hot_windows(classes).collect()}
    counts = Counter(text[at : at + LENGTH] for text in texts for at in range(len(text) - LENGTH + 1))
    for k, text in enumerate(texts):
        bits = sum(1 << at for at in range(len(text) - LENGTH + 1) if counts[text[at : at + LENGTH]] > 1)
        assert bits.bit_count() >= 20
        assert [one % 2**64 for one in found[k]] == [bits >> 64 * part & (2**64 - 1) for part in range(4)]
    each = tables[0].where("window IS NOT NULL").groupBy("window").count()
    assert each.agg(F.max("count")).first()[0] == 1 and each.count() == len(counts)


def test_no_texts(no_docs):
    assert repeated_bytes.digests(no_docs).isEmpty() and repeated_bytes.without_repeats(no_docs).isEmpty()


# --- clusters ---------------------------------------------------------------------


def brute_clusters(vectors, k, rounds):
    """(id, whole components) in, (id, cluster, distance, inertia of the cluster, inertia, digest) out."""
    start = sorted(vectors, key=lambda one: (one[0] is None, hashlib.sha256(f"3:{one[0]}".encode()).hexdigest(), one[1]))[:k]
    centres = [list(one[1]) for one in start]

    def assigned():
        for _, vector in vectors:
            yield min((sum((a - b) ** 2 for a, b in zip(vector, centre, strict=True)), place) for place, centre in enumerate(centres))

    for _ in range(rounds):
        found = list(assigned())
        for place in range(len(centres)):
            own = [vector for (_, vector), (_, cluster) in zip(vectors, found, strict=True) if cluster == place]
            if own:
                centres[place] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found = list(assigned())
    sums = Counter()
    for distance, place in found:
        sums[place] += distance
    digests = [hashlib.sha256(",".join(map(str, centre)).encode()).hexdigest() for centre in centres]
    return [(one[0], place, distance, sums[place], sum(sums.values()), digests[place]) for one, (distance, place) in zip(vectors, found, strict=True)]


VECTORS = "vec_id long, embedding array<float>, label int, id long, v string, cluster string, due int, was int, distance string"


def vector_frame(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, "v", "c", 3, 4, "d") for row in rows], VECTORS).repartition(4)


@pytest.mark.parametrize("spread", [1.0, 0.002])
def test_clusters(spark, spread):
    # A small spread leaves few different whole numbers: many ties, many equal vectors.
    rng = np.random.default_rng(1)
    points = [(k, [float(x) for x in rng.standard_normal(4) * spread + (k % 5) * spread]) for k in range(300)]
    points += [points[0], points[7], (None, [0.5, 0.0, -0.5, 1.0])]
    odd = [(900, None), (901, []), (902, [1.0] * 3), (903, [1.0, None, 0.0, 0.0]), (904, [float("nan"), 0.0, 0.0, 0.0]), (905, [float("inf"), 0.0, 0.0, 0.0]), (906, [3e38, 0.0, 0.0, 0.0])]
    whole = [(k, [int(np.floor(1024 * float(np.float32(x)))) for x in vector]) for k, vector in points]
    found = centroids.cluster(vector_frame(spark, points + odd), k=6, rounds=7, size=4)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute_clusters(whole, 6, 7), key=str)


def test_large_components(spark):
    rows = [(k, [float((-1) ** k * (131071 - k))] * 4) for k in range(12)]
    whole = [(k, [1024 * int(x) for x in vector]) for k, vector in rows]
    found = centroids.cluster(vector_frame(spark, rows), k=3, rounds=3, size=4)
    assert sorted(map(tuple, found.collect())) == sorted(brute_clusters(whole, 3, 3))


def test_few_and_no_vectors(spark):
    rows = [(1, [1.0, 2.0, 3.0, 4.0]), (2, [1.0, 2.0, 3.0, 5.0])]
    found = centroids.cluster(vector_frame(spark, rows), size=4)
    assert {row["distance"] for row in found.collect()} == {0} and found.columns[0] == "vec_id"
    empty = centroids.cluster(vector_frame(spark, []), size=4)
    assert empty.isEmpty() and empty.columns == found.columns and empty.dtypes == found.dtypes


def test_only_due_vectors_are_measured(spark):
    rng = np.random.default_rng(2)
    points = [(k, [float(x) for x in rng.standard_normal(4) * 0.1 + 10 * (k % 4)]) for k in range(400)]
    named = vector_frame(spark, points).select("vec_id", centroids.whole(centroids.F.col("embedding"), 4).alias("v")).withColumnRenamed("vec_id", "id")
    heaps = centroids.Heaps(named, centroids.first_centroids(named, 4, 3))
    while heaps.move():
        assert heaps.live().count() == 400
    filed = spark.read.parquet(*heaps.folders[1:]).count() if len(heaps.folders) > 1 else 0
    assert filed < 400 * (len(heaps.folders) - 1)


# --- tries ------------------------------------------------------------------------


def rebuild(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv: [one[2:] for one in sorted(turns, key=lambda one: one[:2])] for conv, turns in own.items()}
    result = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        result[conv] = own.get(conv - conv % 100, [])[:h] + turns[h:]
    return result


def brute_trie(conversations):
    members = {}
    for conv, turns in conversations.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv)
    rows = []
    for path, convs in members.items():
        below = [other for other in members if other[: len(path)] == path]
        children = [other for other in below if len(other) == len(path) + 1]
        leaves = [other for other in below if not any(len(more) == len(other) + 1 and more[:-1] == other for more in below)]
        saved = sum((len(members[other]) - 1) * len(other[-1][1]) for other in below if other)
        ends = ",".join(str(conv) for conv in sorted(convs) if len(conversations[conv]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        rows.append((min(convs), len(path), parent, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def talk():
    """Shared beginnings, equal conversations, single turns, null fields; conversation 200 is absent."""
    rng = random.Random(3)
    rows = []
    for conv in [*range(0, 60), *range(100, 130), *range(201, 215)]:
        base = 0 if conv % 3 else rng.randrange(4)
        for turn in range(rng.randint(1, 9)):
            text = f"turn {turn} of {base}é😀" if rng.random() < 0.8 else f"own {conv} {turn}"
            rows.append((conv, None if turn == 0 and conv % 7 == 0 else turn, ("user", "assistant", None)[turn % 3], None if conv % 11 == 5 and turn == 2 else text))
    return [*rows, (None, 0, "user", "nobody"), (300, 0, None, None), (301, 5, "", "")]


TALK = "conv_id long, turn long, role string, text string, seq string, key string, head string, n int, up string, depth string"


def talk_frame(spark, rows):
    rows = list(rows)
    random.Random(1).shuffle(rows)
    return spark.createDataFrame([(*row, "s", "k", "h", 1, "u", "d") for row in rows], TALK).repartition(4)


@pytest.mark.parametrize("container", [1, 9, 60, 1 << 16])
def test_trie(spark, container):
    rows = talk()
    found = prefix_trie.prefix_trie(talk_frame(spark, rows), container)
    assert {kind for _, kind in found.dtypes} == {"bigint", "string"}
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute_trie(rebuild(rows)), key=str)


def test_one_conversation_many_times(spark):
    """Ids beyond what one packed row holds end at one node, in order."""
    rows = [(conv, turn, "user", f"t{turn}") for conv in range(1, 9000, 2) for turn in range(3)]
    found = {row["depth"]: row for row in prefix_trie.nodes(prefix_trie.rebuilt(prefix_trie.sequences(talk_frame(spark, rows)))).where("n_children = 0").collect()}
    ends = {}
    for conv, turns in rebuild(rows).items():
        ends.setdefault(len(turns), []).append(str(conv))
    assert found[3]["n_convs"] == len(ends[3]) and found[3]["ends_sha256"] == hashlib.sha256(",".join(ends[3]).encode()).hexdigest()


def test_repeated_turns_and_negative_ids(spark):
    rows = [(-105, 0, "u", "a"), (-105, 0, "u", "a"), (-100, 1, "u", "a"), (7, 0, "u", "b"), (7, 0, "u", "b")]
    found = prefix_trie.rebuilt(prefix_trie.sequences(talk_frame(spark, rows))).collect()
    assert {row["conv_id"]: len(row["chars"]) for row in found}[-100] == 1
    assert prefix_trie.prefix_trie(talk_frame(spark, rows)).where("depth = 0").first()["n_convs"] == 3


def test_no_conversation(spark):
    assert prefix_trie.prefix_trie(talk_frame(spark, [])).isEmpty()


# --- callers' columns and odd tables through the pipeline ---------------------------


def clashing(spark):
    near = passage(2, 200)
    rows = [(1, near, "en", "a", 1), (2, near, "en", "a", 1), (3, passage(9, 60) + " " + passage(1, 40), "fr", "b", 1), (4, passage(8, 60) + " " + passage(1, 40), None, None, 1), (None, None, None, "a", None), (5, "", "en", "b", 0)]
    names = ["_row", "_key", "_spans", "row", "key", "spans", "place", "hash", "anchor"]
    return spark.createDataFrame([(*row, *names) for row in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{name}` string" for name in names)), names


def test_working_names_are_the_callers(spark):
    docs, names = clashing(spark)
    for found in (simhash.first_of_groups(docs), substrings.without_repeats(docs)):
        assert found.columns == docs.columns
        assert {tuple(row) for row in found.select(*names).collect()} == {tuple(names)}
    assert sorted(row["doc_id"] for row in simhash.first_of_groups(docs).where("doc_id IS NOT NULL").collect()) == [1, 3, 4, 5]
    assert substrings.without_repeats(docs).where("doc_id = 4").first()["text"].count(" ") < 99


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_over_odd_documents(spark, tmp_path, empty):
    import corpus_pipeline

    docs, _ = clashing(spark)
    (docs.limit(0) if empty else docs).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (3, 1, 1), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.count() == 0 if empty else found.where("NOT round_trip").isEmpty()


def test_long_units_are_not_remembered():
    from marketspark.llm.pieces import Pieces

    asked = []
    pieces = Pieces(lambda piece: asked.append(piece) or b"", 4, 2, 10)
    for _ in range(2):
        pieces.encode("x" * 50 + " short")
    assert sum(len(piece) > 10 for piece in asked) == 2 and sum(piece == " short" for piece in asked) == 1
    assert all(len(key) <= 10 for key in (*pieces.of_unit, *pieces.of_piece))
