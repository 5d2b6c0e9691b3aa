"""The networks of the quality and toxicity classifiers and the FM-index against plain loops: one text, window, word and
symbol at a time. Gradients are compared with differences of the loss."""

import math
import re

import numpy as np
import pytest
from llm_fixtures import odd_rows  # noqa: F401

from marketspark.llm import byte_cnn, fm_index, toxicity, training

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
MASK = (1 << 64) - 1


def odd_texts(rows):
    return [(row[1] or "").encode() for row in rows]


def batch(texts):
    return np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0, *map(len, texts)])


def byte_logit(model, text):
    """Every window by itself; the last one is filled up with padding."""
    filters = model["filters"].astype(float)
    values, start = [], 0
    while True:
        window = [byte + 1 for byte in text[start : start + byte_cnn.WIDTH]]
        window += [0] * (byte_cnn.WIDTH - len(window))
        values.append([sum(float(model["table"][byte, d]) * filters[k * byte_cnn.DIMENSIONS + d, f] for k, byte in enumerate(window) for d in range(byte_cnn.DIMENSIONS)) for f in range(byte_cnn.FILTERS)])
        if start + byte_cnn.WIDTH >= len(text):
            break
        start += byte_cnn.STRIDE
    tops = [[max(column) for column in zip(*values[k : k + byte_cnn.CHUNK], strict=True)] for k in range(0, len(values), byte_cnn.CHUNK)]
    features = [sum(column) / len(tops) for column in zip(*tops, strict=True)] + [max(column) for column in zip(*tops, strict=True)] + [math.log1p(len(text)) / 10]
    hidden = [math.tanh(sum(x * float(w) for x, w in zip(features, model["hidden"][:, h], strict=True)) + float(model["shift"][h])) for h in range(byte_cnn.HIDDEN)]
    return sum(x * float(w) for x, w in zip(hidden, model["out"], strict=True)) + float(model["bias"][0])


def word_rows(word):
    """The table's rows of a word and of its beginnings."""

    def spread(x):
        x ^= x >> 32
        x = x * 0xD6E8FEB86659FD93 & MASK
        x ^= x >> 32
        x = x * 0xD6E8FEB86659FD93 & MASK
        return x ^ x >> 32

    def number(part):
        return spread(sum((byte + 1) * pow(0x9E3779B97F4A7C15, k, 1 << 64) for k, byte in enumerate(part)) & MASK)

    word = bytes(byte + 32 if 65 <= byte <= 90 else byte for byte in word)
    return [number(word) % toxicity.TABLE, *((number(word[:prefix]) ^ prefix) % toxicity.TABLE for prefix in toxicity.PREFIXES)]


def toxic_logit(model, text):
    """Every window of words by itself; a text of fewer words than a filter is wide is followed by empty words."""
    table = model["table"].astype(float)
    words = [sum(table[row] for row in word_rows(word)) for word in WORD.findall(text)]
    logit = float(model["bias"][0])
    for width in toxicity.WIDTHS:
        own = words + [np.zeros(toxicity.DIMENSIONS)] * (width - len(words)) if words else []
        windows = [np.concatenate(own[k : k + width]) for k in range(len(own) - width + 1)]
        for f in range(toxicity.FILTERS if windows else 0):
            logit += float(model[f"out{width}"][f]) * max(float(window @ model[f"filters{width}"][:, f]) for window in windows)
    return logit


def shaken(model, seed):
    """All arrays away from zero, so that none is untested."""
    rng = np.random.default_rng(seed)
    return {name: (x + rng.normal(0, 0.1, x.shape)).astype(np.float32) for name, x in model.items()}


def long_text(size):
    rng = np.random.default_rng(size)
    return " ".join("".join(rng.choice(list("abcdé#"), rng.integers(1, 9))) for _ in range(size)).encode()


def test_byte_network_forward(odd_rows):
    texts = [text for text in odd_texts(odd_rows) if len(text) < 3000]
    texts += [b"x" * size for size in range(1, 14)] + [b"", long_text(900), b"y" * (byte_cnn.STRIDE * byte_cnn.CHUNK + byte_cnn.WIDTH)]
    model = shaken(byte_cnn.Network.fresh().model, 1)
    found = byte_cnn.Network(model).logits(byte_cnn.Windows(*batch(texts)))
    assert np.allclose(found, [byte_logit(model, text) for text in texts], atol=1e-4)


def test_toxicity_network_forward(odd_rows):
    texts = [text for text in odd_texts(odd_rows) if len(text) < 3000] + [b"", b"A", b"a bC", b" \n", long_text(700), b"", "Ünd ÉÉ Zz".encode()]
    model = shaken(toxicity.Network.fresh(np.zeros(toxicity.TABLE, dtype=np.float32)).model, 2)
    network = toxicity.Network(model)
    expected = [toxic_logit(model, text) for text in texts]
    assert np.allclose(network.logits(*toxicity._buckets_of(texts)), expected, atol=1e-4)
    # A text's score does not depend on the texts beside it.
    assert np.allclose([network.logits(*toxicity._buckets_of([text]))[0] for text in texts], expected, atol=1e-4)


def loss(logits, labels):
    logits = logits.astype(np.float64)
    return float(np.mean(np.logaddexp(0, logits) - labels * logits))


def assert_slope(model, name, gradient, of, rng):
    """The loss along the gradient and along random directions that change few or all numbers."""
    size = np.linalg.norm(gradient)
    assert size > 1e-5, name
    directions = [gradient / size]
    for share in (1.0, 0.05):
        direction = rng.standard_normal(gradient.shape) * (rng.random(gradient.shape) < share)
        directions.append(direction / max(np.linalg.norm(direction), 1e-9))
    for direction in directions:
        step = 2e-3
        ahead, behind = (of({**model, name: (model[name] + side * step * direction).astype(np.float32)}) for side in (1, -1))
        assert math.isclose((ahead - behind) / (2 * step), float((gradient * direction).sum()), rel_tol=0.03, abs_tol=3e-4), name


def test_byte_network_gradients(odd_rows):
    texts = [text for text in odd_texts(odd_rows) if len(text) < 1500] + [b"", b"ab", long_text(400)]
    rng = np.random.default_rng(3)
    labels = rng.integers(0, 2, len(texts)).astype(np.float32)
    model = shaken(byte_cnn.Network.fresh().model, 4)
    windows = byte_cnn.Windows(*batch(texts))
    found = byte_cnn.Network(model).gradients(windows, labels)
    assert found.keys() == model.keys()
    for name, gradient in found.items():
        assert_slope(model, name, gradient, lambda changed: loss(byte_cnn.Network(changed).logits(windows), labels), rng)


def test_toxicity_network_gradients(odd_rows):
    texts = [text for text in odd_texts(odd_rows) if len(text) < 1500] + [b"", b"a", b"a b", long_text(300)]
    rng = np.random.default_rng(5)
    labels = rng.integers(0, 2, len(texts)).astype(np.float32)
    buckets, sizes = toxicity._buckets_of(texts)
    model = shaken(toxicity.Network.fresh(np.zeros(toxicity.TABLE, dtype=np.float32)).model, 6)
    odds = model["table"][buckets, 0]
    found, places, into = toxicity.Network(model).gradients(buckets, sizes, labels, odds)
    table = np.zeros_like(model["table"])
    np.add.at(table, places, into)
    # The first column is counted, not learned.
    assert not table[:, 0].any()
    found["table"] = table
    assert found.keys() == model.keys()

    def of(changed):
        return loss(toxicity.Network(changed).logits(buckets, sizes, odds), labels)

    for name, gradient in found.items():
        assert_slope(model, name, gradient, of, rng)


def test_first_at_maximum():
    rng = np.random.default_rng(7)
    values = rng.integers(0, 4, (60, 3)).astype(float)
    sizes = np.array([1, 7, 30, 2, 20])
    begins = np.cumsum(sizes) - sizes
    tops = np.maximum.reduceat(values, begins, axis=0)
    expected = [[begin + int(np.argmax(values[begin : begin + size, c])) for c in range(3)] for begin, size in zip(begins, sizes, strict=True)]
    assert training.first_at_maximum(values, begins, sizes, tops).tolist() == expected


@pytest.mark.parametrize("kinds, size", [(1, 1), (2, 63), (2, 64), (3, 65), (7, 300), (130, 900)])
def test_wavelet_matrix(kinds, size):
    symbols = np.random.default_rng(size).integers(0, kinds, size)
    matrix = fm_index.WaveletMatrix(symbols, kinds)
    asked = np.repeat(np.arange(kinds), size + 1)
    places = np.tile(np.arange(size + 1), kinds)
    expected = [int((symbols[:place] == symbol).sum()) for symbol, place in zip(asked, places, strict=True)]
    assert matrix.rank(asked, places).tolist() == expected


@pytest.mark.parametrize("kinds", [1, 2, 5, 40])
@pytest.mark.parametrize("width", [1, 2, 4])
def test_backward_search(kinds, width):
    """Ranges hold exactly the places where a pattern stands; patterns do not cross the end of a text."""
    rng = np.random.default_rng(kinds * 10 + width)
    texts = [rng.integers(1, kinds + 1, size) for size in (0, 1, 30, 7, 30, 0, 90)] + [np.ones(25, dtype=np.int64)]
    texts.append(texts[2])
    symbols = np.concatenate([np.append(text, 0) for text in texts])
    index = fm_index.Index(symbols)
    assert sorted(index.suffixes.tolist()) == list(range(len(symbols)))
    patterns = rng.integers(1, kinds + 1, (60, width))
    low, high = index.search(patterns)
    for pattern, begin, end in zip(patterns, low, high, strict=True):
        expected = [k for k in range(len(symbols) - width + 1) if np.array_equal(symbols[k : k + width], pattern)]
        assert sorted(index.suffixes[begin : max(begin, end)].tolist()) == expected
