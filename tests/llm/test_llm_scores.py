"""Quality rules, mixing, language model, classifiers and embeddings on odd rows, against brute force."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import no_docs, odd_docs, odd_rows  # noqa: F401
from pyspark.sql import functions as F

from marketspark.llm import bloom, byte_cnn, embeddings, language_model, mixing, quality_rules, toxicity
from marketspark.llm.components import components
from marketspark.llm.training import remainder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def form(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    windows = Counter(tuple(words[k : k + 8]) for k in range(n - 7))
    covered = set()
    for k in range(n - 7):
        if windows[tuple(words[k : k + 8])] > 1:
            covered.update(range(k, k + 8))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_form_statistics(odd_docs, odd_rows):
    rows = quality_rules.judge(odd_docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((row.doc_id, *(row[name] for name in names)) for row in rows) == Counter((row[0], *form(row[1])) for row in odd_rows)
    assert all(not (row.kept and row.base_failed) for row in rows)


def test_likelihood_ratio(spark):
    """The score from counts by hand: two buckets tell the difference."""
    good = [(k, " ".join(f"w{(k * 7 + i) % 40}" for i in range(40))) for k in range(20)]
    bad = [(100 + k, " ".join(f"w{(k * 7 + i) % 40}%%%" for i in range(40)) + " ###" * 3) for k in range(5)]
    docs = spark.createDataFrame([*good, *bad], "doc_id long, text string")
    worded = quality_rules.with_words(docs, "doc_id", "text")
    raw, target = Counter(), Counter()
    for row in worded.select(quality_rules.buckets().alias("b"), quality_rules.trusted().alias("t")).collect():
        raw.update(row.b)
        target.update(row.b if row.t else [])
    ratios = quality_rules.log_ratios(worded).first().ratios
    n = quality_rules.BUCKETS
    for b in list(raw)[:50]:
        assert math.isclose(ratios[b], math.log((target[b] + 1) / (sum(target.values()) + n)) - math.log((raw[b] + 1) / (sum(raw.values()) + n)), abs_tol=1e-12)
    judged = {row.doc_id: row for row in quality_rules.judge(docs).collect()}
    for row in worded.select("doc_id", quality_rules.buckets().alias("b")).collect():
        assert math.isclose(judged[row.doc_id].score, sum(ratios[b] for b in row.b) / len(row.b), abs_tol=1e-9)
    assert all(judged[k].score > judged[100].score for k in range(20))
    assert quality_rules.judge(docs).where("kept").count() == sum(row.kept for row in judged.values())


def mixed(rows, repeats):
    """Copies of each row from weights by hand: source tokens to the power of 1 - alpha."""
    tokens = defaultdict(int)
    for _, text, source in rows:
        tokens[source] += len(WORD.findall(text or ""))
    return tokens


def test_mixing_whole(odd_docs, odd_rows):
    found = mixing.mixed_rows(odd_docs, max_repeats=3.0).collect()
    tokens = mixed([(row[0], row[1], row[3]) for row in odd_rows], 3.0)
    some = {source: n for source, n in tokens.items() if n}
    copies = Counter(row.doc_id for row in found)
    # Nothing is lost, and nothing comes more often than the limit allows.
    assert set(copies) == {row[0] for row in odd_rows}
    read = defaultdict(int)
    for row in found:
        read[row.source] += row.n_words
    for source, n in some.items():
        assert n <= read[source] <= 3 * n + max(len(WORD.findall(row[1] or "")) for row in odd_rows if row[3] == source)
    assert Counter(copies.values())[0] == 0


@pytest.mark.parametrize("options", [{"max_repeats": 2.0}, {"max_repeats": None, "entropy": 0.9}, {"max_repeats": 1.5, "entropy": 0.99}, {"max_repeats": 4.0, "budget": 3000}])
def test_mixing_weights(spark, options):
    sizes = {"a": 100, "b": 20, "c": 5}
    rows = [(k, "w " * 10, source) for k, source in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    tokens = {s: 10 * n for s, n in sizes.items()}
    total = sum(tokens.values())

    def weights(alpha):
        mass = {s: (n / total) ** alpha for s, n in tokens.items()}
        return {s: m / sum(mass.values()) for s, m in mass.items()}

    def often(alpha):
        w = weights(alpha)
        budget = options.get("budget") or max(n / w[s] for s, n in tokens.items())
        return {s: w[s] * budget / n for s, n in tokens.items()}

    steps = [k / mixing.STEPS for k in range(mixing.STEPS + 1)]
    alpha = 0.0
    if options.get("entropy"):
        fits = [a for a in steps if -sum(w * math.log(w) for w in weights(a).values()) >= options["entropy"] * math.log(3)]
        alpha = max(fits)
    if options.get("max_repeats"):
        alpha = max(alpha, min((a for a in steps if max(often(a).values()) <= options["max_repeats"] + 1e-12), default=1.0))
    repeats = {s: round(r, 9) for s, r in often(alpha).items()}
    found = Counter(row.source for row in mixing.mixed_rows(docs, **options).collect())
    # Whole epochs, and of the rest as many documents as start within the quota.
    for s, n in sizes.items():
        full = math.floor(repeats[s])
        assert found[s] == full * n + math.ceil((repeats[s] - full) * tokens[s] / 10 - 1e-9)


def test_mixing_blocks_hold_the_mix(spark):
    rows = [(k, "w " * 10, "ab"[k % 5 == 0]) for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mixed_rows(docs, max_repeats=1.0, block_tokens=2000).collect()
    assert Counter(row.doc_id for row in found) == Counter(range(2000))
    by = Counter((row.block, row.source) for row in found)
    assert {block for block, _ in by} == set(range(10))
    assert all(abs(by[block, "b"] - 40) <= 1 and abs(by[block, "a"] - 160) <= 1 for block in range(10))


def test_mix_returns_the_documents(odd_docs, odd_rows):
    found = mixing.mix(odd_docs)
    assert found.columns == odd_docs.columns
    kinds = {tuple(row) for row in found.collect()}
    assert kinds == {tuple(row) for row in odd_docs.collect()}


def test_language_model(odd_docs, odd_rows):
    texts = [(row[0], WORD.findall((row[1] or "").translate(LOWER)) + [None]) for row in odd_rows]
    held = lambda key: key is not None and zlib.crc32(str(key).encode()) % 7 == 2
    counts = Counter()
    for key, words in texts:
        if not held(key):
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    expected = sorted((str(key), held(key), len(words), sum(counts[w] > 0 for w in words), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), 6)) for key, words in texts)
    rows = language_model.score_corpus(odd_docs, remainder("doc_id", 7) == 2).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == expected
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)


def test_model_counts_and_sums_to_one(spark):
    """Levels come back from the filter, and a context's probabilities add up to at most about one."""
    rows = [(k, " ".join(f"w{(i * i + k) % 9}" for i in range(60))) for k in range(30)]
    texts = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", F.col("text").cast("binary").alias("text"))
    counted, model = language_model.learn(texts)
    known = language_model.Vocabulary(model)
    pairs = Counter()
    for _, text in rows:
        tokens = language_model.Tokens(np.frombuffer(text.encode(), dtype=np.uint8), np.array([0, len(text)]))
        pairs.update(known.pairs(tokens, known.places(tokens.hashes))[1].tolist())
    every = np.array([h << 32 | w for h in range(len(known.hashes)) for w in range(len(known.hashes))], dtype=np.int64)
    levels = language_model.levels(every, model["filter"])
    for pair, level in zip(every.tolist(), levels, strict=True):
        n = pairs[pair]
        assert level >= (1 + math.floor(math.log2(n / 2)) if n >= 2 else 0)
    single = (known.counts + 1) / (model["n"][0] + model["v"][0] + 1)
    for h in range(len(known.hashes)):
        own = levels[h * len(known.hashes) : (h + 1) * len(known.hashes)]
        seen = 2 * language_model.MIDDLE * 2.0 ** (own - 1) / known.counts[h] * 10 ** model["shrink"][h]
        assert np.where(own > 0, seen, single * 10 ** model["backoff"][h]).sum() < 1.1


@pytest.mark.parametrize("bounds", [{}, {"FREQUENT": 40}, {"PAIRS": 60}, {"FREQUENT": 100, "PAIRS": 30}])
def test_all_pairs_of_all_words_count(spark, monkeypatch, bounds):
    """Rare words and pairs that occur once take part, and the bounds of the broadcasts do not change a score."""
    for name, value in bounds.items():
        monkeypatch.setattr(language_model, name, value)
    rng = np.random.default_rng(9)
    rows = [(k, " ".join(f"w{int(x)}" for x in rng.zipf(1.4, rng.integers(0, 40)) if x < 500)) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words, pairs = Counter(), Counter()
    for key, text in rows:
        if key % 4:
            own = [*text.split(), None]
            words.update(own)
            pairs.update(zip([None, *own], own))
    assert min(pairs.values()) == 1 and min(words.values()) == 1
    n, v = sum(words.values()), len(words)
    single = lambda w: (words[w] + 1) / (n + v + 1)
    worth = lambda n: 1.0 if n == 1 else 2 ** math.floor(math.log2(n)) * language_model.MIDDLE
    after = {h: [w for g, w in pairs if g == h] for h in words}

    def log(h, w):
        if h not in words:
            return math.log10(single(w))
        share = sum(worth(pairs[h, x]) for x in after[h]) / words[h]
        shrink = min(1, words[h] / (words[h] + len(after[h])) / share)
        if (h, w) in pairs:
            return math.log10(worth(pairs[h, w]) / words[h] * shrink)
        return math.log10((1 - share * shrink) / max(1 - sum(map(single, after[h])), 1e-3) * single(w))

    expected = {key: sum(map(log, [None, *text.split()], [*text.split(), None])) for key, text in rows}
    found = {row.doc_id: row.score for row in language_model.score_corpus(docs, F.col("doc_id") % 4 == 0).collect()}
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[key], expected[key], abs_tol=1e-4) for key in found)


def test_answers_are_added_up_before_they_leave_a_task(spark, monkeypatch):
    """Rows from the parts follow the tasks, not what is asked, and a text asked for twice, without id, has one text's score."""
    for name, value in {"FREQUENT": 40, "PAIRS": 10, "PART": 64, "GROUPS": 2, "ANSWERS": 256}.items():
        monkeypatch.setattr(language_model, name, value)
    rng = np.random.default_rng(4)
    rows = [(k, " ".join(f"w{int(x)}" for x in rng.zipf(1.4, 30) if x < 500)) for k in range(150)]
    rows += [(None, rows[0][1])] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", F.col("text").cast("binary").alias("text"))
    (joined, filters), model = language_model.learn(docs.where("doc_id % 4 > 0").select("text"))
    assert model["base"][0] > 0 and filters.count() > 20
    seen, tables = [], []
    finished, stored = language_model.finished, language_model.stored
    monkeypatch.setattr(language_model, "finished", lambda answers: seen.append(answers.coalesce(3)) or finished(answers))
    monkeypatch.setattr(language_model, "stored", lambda df, *folder: tables.append(df) or stored(df, *folder))
    found = language_model.score(docs, (joined, filters), model).collect()
    kinds = Counter(row["kind"] for row in seen[0].collect())
    # Without sums over the parts there are more than 20 rows for each text.
    assert kinds[2] == len(rows) and kinds[1] < len(rows) and not tables
    scores = {row.score for row in found if row.doc_id in (None, 0)}
    assert len(found) == len(rows) and max(scores) - min(scores) < 1e-9


def test_sums_in_bounded_memory(monkeypatch):
    monkeypatch.setattr(language_model, "ANSWERS", 16)
    rng, sums, given, expected = np.random.default_rng(2), language_model.Sums(), [], Counter()
    for _ in range(40):
        key, n = rng.integers(0, 30, 7), rng.integers(0, 9, 7)
        for one in zip(key.tolist(), n.tolist(), strict=True):
            expected[one[0]] += one[1]
        given += sums.add(key, n)
        assert sums.size <= 16
    given += sums.rest()
    found = Counter()
    for key, n in given:
        assert len(set(key.tolist())) == len(key) <= 16 + 7
        for one in zip(key.tolist(), n.tolist(), strict=True):
            found[one[0]] += one[1]
    assert found == expected and not list(sums.rest())


def test_bloom_filter(spark):
    items = np.random.default_rng(1).integers(-(2**62), 2**62, 20_000)
    filled = bloom.build(spark.createDataFrame([(int(x),) for x in items], "item long"), bloom.blocks_for(len(items)))
    assert len(bloom.contains(items.view(np.uint64), filled)) == len(items)
    others = np.random.default_rng(2).integers(-(2**62), 2**62, 20_000)
    assert len(bloom.contains(others.view(np.uint64), filled)) < 400


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(3)
    words = [f"{a}{b}" for a in "bcdfgkl" for b in ("ana", "oro", "ilu", "emy")]
    rows, labels = [], []
    for k in range(400):
        text = " ".join(rng.choice(words, rng.integers(5, 60)))
        toxic, junk = k % 5 == 0, k % 4 == 0
        if toxic:
            text += " vile" + words[k % 28] + " more words"
        if junk:
            text = text.replace(" ", " %%% ")
        rows.append((k, text, "en" if k % 2 else None))
        labels.append((k, int(not junk), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("model, label", [(toxicity, "toxic"), (byte_cnn, "quality")])
def test_held_out_accuracy(labelled, model, label):
    docs, labels = labelled
    learned = model.learn(docs, labels, rows=F.col("doc_id") % 3 != 0)
    known = {row.doc_id: row[label] for row in labels.collect()}
    held = [row for row in model.score(docs, learned).collect() if row.doc_id % 3 == 0]
    assert np.mean([(row.score >= 0.5) == (known[row.doc_id] == 1) for row in held]) > 0.93


@pytest.mark.parametrize("model", [toxicity, byte_cnn])
def test_classifiers_on_odd_rows(labelled, odd_docs, odd_rows, no_docs, model):
    docs, labels = labelled
    for learned in (model.learn(docs, labels), model.learn(docs, labels.limit(0))):
        rows = model.score(odd_docs, learned).collect()
        assert Counter(row.doc_id for row in rows) == Counter(row[0] for row in odd_rows)
        assert all(0 <= row.score <= 1 for row in rows)
        assert model.score(no_docs, learned).count() == 0
        # A score hangs on the text alone.
        again = {row.doc_id: row.score for row in model.score(odd_docs.withColumn("lang", F.lit("de")).repartition(1), learned).collect()}
        assert all(math.isclose(again[row.doc_id], row.score, rel_tol=1e-4, abs_tol=1e-6) for row in rows if row.doc_id is not None)


def test_without_toxic(labelled, odd_docs):
    docs, labels = labelled
    learned = toxicity.learn(docs, labels)
    flagged = {row.doc_id for row in toxicity.score(docs, learned).where("flagged").collect()}
    kept = toxicity.without_toxic(docs, learned)
    assert kept.columns == docs.columns
    assert {row.doc_id for row in kept.collect()} == set(range(400)) - flagged
    assert len(flagged) > 60
    assert toxicity.without_toxic(odd_docs, learned).columns == odd_docs.columns


def test_thresholds_are_set_on_all_labelled_rows(labelled):
    """A language with few toxic texts in the sample has the cut of all its labelled texts."""
    docs, labels = labelled
    few = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.lit("xx")).otherwise(F.lit("en")))
    learned = toxicity.learn(few, labels, rows=F.col("doc_id") % 8 != 1, per_class=30)
    assert list(learned["languages"]) == ["", "en", "xx"]
    known = {row.doc_id: row.toxic for row in labels.collect()}
    counts = toxicity.cut_counts(few, labels, "toxic", F.col("doc_id") % 8 != 1, 30, learned, np.zeros((2, toxicity.TABLE), dtype=np.float32), np.array([0.0])).collect()
    sizes = Counter()
    for row in counts:
        sizes[row["lang"], row["label"]] += row["count"]
    assert sizes == Counter(("xx" if k % 2 == 0 else "en", toxic) for k, toxic in known.items() if k % 8 != 1)


def test_thresholds_by_language():
    cuts = np.array([-1.0, 0.0, 1.0, 2.0])
    row = lambda lang, label, place, count: {"lang": lang, "label": label, "place": place, "count": count}
    counts = [row("a", 1, 4, 500), row("a", 0, 3, 400), row("a", 0, 0, 100), row("b", 1, 1, 300), row("b", 0, 0, 900), row("c", 1, 4, 19), row("c", 0, 3, 400)]
    found = toxicity.thresholds(counts, cuts, 0.0)
    limits = dict(zip(found["languages"], found["thresholds"], strict=True))
    assert limits["a"] == 2.0 and limits["b"] == -1.0 and limits["c"] == limits[""]
    assert dict(zip(*toxicity.thresholds([], cuts, 0.0).values(), strict=True)) == {"": 0.0}


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (9, 9), (None, 3), (7, 8), (8, 7), *[(100, 100 + k) for k in range(1, 60)], *[(k, k + 1) for k in range(1000, 1040)]]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 7: 7, 8: 7} | {100 + k: 100 for k in range(60)} | {k: 1000 for k in range(1000, 1041)}


def near(vectors, threshold=0.9):
    """Links and smallest reachable id of every row, by all pairs in double precision."""
    usable = [k for k, (_, x) in enumerate(vectors) if x and all(y is not None and math.isfinite(y) for y in x) and any(x)]
    units = {k: np.array(vectors[k][1], dtype=float) / np.linalg.norm(np.array(vectors[k][1], dtype=float)) for k in usable}
    links = {k: [j for j in usable if j != k and len(units[j]) == len(units[k]) and float(units[j] @ units[k]) >= threshold] for k in usable}
    label = {k: vectors[k][0] for k in range(len(vectors))}
    while True:
        new = {k: min([label[k], *(label[j] for j in links.get(k, []))]) for k in label}
        if new == label:
            return Counter((vectors[k][0], len(links.get(k, [])), label[k], label[k] == vectors[k][0]) for k in label)
        label = new


@pytest.mark.parametrize("chunk", [8192, 7])
def test_embeddings(spark, chunk):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((12, 16)).astype(np.float32)
    vectors = [(k, (centres[k % 12] + 0.12 * (k % 5) * rng.standard_normal(16)).astype(np.float32).tolist()) for k in range(150)]
    vectors += [(200 + k, vectors[3][1]) for k in range(20)]
    vectors += [(300, [2 * x for x in vectors[3][1]]), (301, None), (302, []), (303, [0.0] * 16), (304, [float("nan")] + [1.0] * 15), (305, [float("inf")] + [1.0] * 15)]
    vectors += [(306, [None] + [1.0] * 15), (307, [1.0]), (308, [1.0, 0.0, 0.0]), (309, [1.0, 0.1, 0.0]), (310, [1e-30] * 16), (311, [3e30] * 16), (5, vectors[5][1])]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("n", F.lit("clash")).withColumn("label", F.lit(1))
    found = embeddings.near_duplicates(table, chunk=chunk).collect()
    assert Counter(map(tuple, found)) == near([(row.vec_id, row.embedding) for row in table.collect()])
    assert embeddings.near_duplicates(table.limit(0)).count() == 0


@pytest.mark.parametrize("spread", [1.0, 0.05])
def test_embeddings_by_fitted_axes(spark, monkeypatch, spread):
    """Noise and narrow clusters, some pairs close to the threshold, with axes fitted on a few of the rows."""
    monkeypatch.setattr(embeddings, "SAMPLE", 50)
    rng = np.random.default_rng(5)
    base = rng.standard_normal((400, 24)) * np.where(np.arange(24) < 3, 1.0, spread)
    near_rows = base[:150] + rng.uniform(0.02, 0.12, (150, 1)) * np.linalg.norm(base[:150], axis=1, keepdims=True) * rng.standard_normal((150, 24))
    vectors = [(k, [float(x) for x in vector]) for k, vector in enumerate(np.concatenate([base, near_rows]))]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    axes = embeddings.principal_axes(table.select(F.xxhash64("embedding").alias("node"), F.col("embedding").alias("vector")), embeddings.BLOCKS)[24]
    assert np.allclose(axes.T @ axes, np.eye(24))
    found = embeddings.near_duplicates(table, chunk=64).collect()
    assert Counter(map(tuple, found)) == near(vectors)
    assert sum(row.n_links > 0 for row in found) > 100


def test_gap_within_the_slack_of_a_block(spark):
    """Two vectors whose gap lies in the first coordinate and is a little over the block's budget are linked."""
    cut = embeddings.Blocks(2, 0.9, 4)
    gap = np.sqrt(cut.budgets[0] + embeddings.SLACK / 4)
    turned = np.array([[-gap / 2, np.sqrt(1 - gap**2 / 4)], [gap / 2, np.sqrt(1 - gap**2 / 4)]])
    rows = [(k, [float(x) for x in vector]) for k, vector in enumerate(turned @ cut.rotation.T)]
    found = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((row.vec_id, row.n_links, row.component_id) for row in found) == [(0, 1, 0), (1, 1, 0)]


def test_scores_of_empty_tables(no_docs):
    assert quality_rules.judge(no_docs).count() == 0
    assert mixing.mixed_rows(no_docs).count() == 0
    assert mixing.mix(no_docs).count() == 0
    assert language_model.score_corpus(no_docs, remainder("doc_id", 7) == 2).count() == 0
