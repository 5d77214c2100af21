"""Common blocks of texts against the standard library's, and their cost."""

import random
import time
from difflib import SequenceMatcher

import pytest

from docloom.functions.matching import similarities
from docloom.operators import validation


def some_pairs(r):
    letters = r.choice(["ab", "abc", "abcdefghij ", "가나다 a😀"])
    for _ in range(r.randrange(1, 12)):
        a = "".join(r.choice(letters) for _ in range(r.choice([0, 1, 5, 40, 250, 400])))
        b = "".join(r.choice(letters) for _ in range(r.choice([0, 3, 30, 300])))
        if r.random() < 0.6:
            b = "".join(c for c in a if r.random() > 0.1)
            k = r.randrange(len(b) + 1)
            b = b[k:] + b[: k // 2]
        yield a, b


@pytest.mark.parametrize("autojunk", [True, False])
def test_random_pairs_as_the_library_has_them(autojunk):
    for seed in range(120):
        firsts, seconds = zip(*some_pairs(random.Random(seed)))
        assert similarities(firsts, seconds, autojunk) == [SequenceMatcher(None, a, b, autojunk=autojunk).ratio() for a, b in zip(firsts, seconds)], seed


def test_edges_and_repetitions():
    assert similarities([], []) == [] and similarities(["", "", "x"], ["", "x", ""]) == [1.0, 0.0, 0.0]
    for a, b in (("a" * 500, "a" * 300), ("ab" * 200, "ba" * 150), ("a" * 100 + "b" * 100, "b" * 100 + "a" * 100), ("\ud800x", "x\ud800")):
        for autojunk in (True, False):
            assert similarities([a], [b], autojunk) == [SequenceMatcher(None, a, b, autojunk=autojunk).ratio()]


def test_long_pairs_take_seconds():
    r = random.Random(1)
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(2, 9))) for _ in range(5000)]
    text = " ".join(r.choice(words) for _ in range(180_000))
    result = " ".join(w for i, w in enumerate(text.split(" ")) if i % 10)
    began = time.time()
    strict, loose = similarities([text], [result], False)[0], similarities([text], [result], True)[0]
    assert strict > 0.9 > loose and len(text) > 900_000
    assert similarities(["ab" * 250_000], ["ab" * 240_000], False)[0] > 0.97
    assert time.time() - began < 90


def test_whole_column(spark):
    rows = [("abcd", "bcde"), (None, "x"), (None, None), ("", ""), ("same", "same")]
    got = validation.similarity(spark.createDataFrame(rows, "original string, result string")).collect()
    assert {(r["original"], r["result"]): r["similarity"] for r in got} == {("abcd", "bcde"): 0.75, (None, "x"): 0.0, (None, None): 1.0, ("", ""): 1.0, ("same", "same"): 1.0}
