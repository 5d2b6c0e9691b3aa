"""Odd documents that the operators' tests share; imported by name."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, row long, words int, hash string, node string, score string, label string"


def passage(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty and very long texts, ties, repeated rows, shared passages, odd white space, null ids."""
    shared, near = passage(1, 40), passage(2, 200).split()
    changed = [*near[:90], "other", *near[91:]]
    texts = {
        0: None, 1: "", 2: " \t\n\x0b\x0c\r ", 3: "one", 4: "Two Words", 5: "One", 6: passage(3, 60_000),
        7: " ".join(near), 8: " ".join(changed), 9: " ".join(near), 10: passage(4, 30) + " " + shared + "\n\n  " + passage(5, 25),
        11: shared.replace(" ", "\t"), 12: passage(6, 13) + " " + shared, 13: "<|endoftext|> a  b <|endoftext|>", 14: "it's we'll. x   y\x00\x01 z, w. ", 15: "日本語 テキスト 😀😀 ́e",
        16: "same same same same same same same same same same same same same same same same same same same same same same",
        17: "*** ### $$$ %%% &&& ||| <<< >>> *** ### $$$ %%% a b c d e f g h i j k l m n o p", 18: "THE THING IS!! LOUD!!\nTHE THING IS!! LOUD!!\n\n" * 6,
        19: (shared + "\n") * 3,
    }
    rows = [(k, text, ("en", "fr", None)[k % 3], ("a", "b", None, "a")[k % 4], len(text or ""), "k", 1, 2, "h", "n", "s", "l") for k, text in texts.items()]
    return [*rows, rows[7], rows[12], (None, " ".join(near), None, None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
