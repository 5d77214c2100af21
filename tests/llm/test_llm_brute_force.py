"""Packing against an exhaustive search, decontamination and chat on repetitive and long input against plain loops."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import decontamination
from docloom.llm.chat import chat_digest
from docloom.llm.decontamination import contamination_digest
from docloom.llm.jaccard import common_shingles
from docloom.llm.packing import cut_stream


def least_cost(doc_ends, sentence_ends, size, sentence_cost, word_cost):
    """The least cost of cutting a stream, by looking at every earlier cut from every place that may be one."""
    total = doc_ends[-1]
    places = sorted({0, *doc_ends, *(s for s in sentence_ends if 0 < s < total)})
    for a, b in list(zip(places, places[1:])):
        if b - a > size // 4:
            places += range(a + max(1, size // 16), b, max(1, size // 16))
    places = sorted(set(places))
    price = {p: 0 if p in doc_ends else sentence_cost if p in sentence_ends else word_cost for p in places}
    best = {0: 0.0}
    for p in places[1:]:
        best[p] = min(best[q] + size - (p - q) + price[p] for q in places if q < p and p - q <= size)
    tails = [best[q] + word_cost * ((total - q).bit_count() - 1) for q in places if 0 < total - q <= size]
    return min([best[total], *tails])


def cost_of(cuts, doc_ends, sentence_ends, size, sentence_cost, word_cost):
    out, before = 0.0, 0
    for cut in cuts:
        n, before = cut - before, cut
        out += 0 if n & (n - 1) == 0 else size - n
        out += 0 if cut in doc_ends else min(sentence_cost, word_cost) if cut in sentence_ends else word_cost
    return out


def test_no_cutting_is_cheaper_than_the_packing(spark):
    r = random.Random(6)
    for _ in range(400):
        size = r.choice([8, 16, 32, 64])
        doc_ends = np.cumsum([r.randrange(1, 3 * size) for _ in range(r.randrange(1, 9))]).tolist()
        sentence_ends = sorted(r.sample(range(1, doc_ends[-1] + 1), r.randrange(0, doc_ends[-1] // 3 + 1)))
        costs = (r.choice([0.0, 1.0, 8.0]), r.choice([2.0, 24.0]))
        cuts = cut_stream(np.array(doc_ends), np.array(sentence_ends, dtype=np.int64), size, *costs).tolist()
        assert cuts == sorted(set(cuts)) and cuts[-1] == doc_ends[-1] and max(np.diff([0, *cuts])) <= size
        assert cost_of(cuts, set(doc_ends), set(sentence_ends), size, *costs) <= least_cost(doc_ends, set(sentence_ends), size, *costs) + 1e-9


def test_a_phrase_that_repeats_in_a_document_and_in_many_items(spark):
    phrase = "one two three four five six seven eight nine ten"
    items = [(f"i{k}", f"lead{k} {phrase} tail{k}") for k in range(40)] + [("short", "two three"), ("none", " . "), ("far", "never to be found anywhere in the documents at all ever again")]
    docs = [(1, " x ".join([phrase] * 60)), (2, f"lead3 {phrase} tail3"), (3, "two, THREE"), (4, None), (5, phrase.replace(" ten", ""))]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    expected = set()
    for doc_id, text in docs:
        own, hit, found = words(text), set(), []
        for item, said in items:
            w = words(said)
            wide = min(10, len(w))
            windows = {tuple(w[p : p + wide]) for p in range(len(w) - wide + 1)} if w else set()
            at = [p for p in range(len(own) - wide + 1) if tuple(own[p : p + wide]) in windows]
            found += [item] * bool(at)
            hit |= {p + k for p in at for k in range(wide)}
        expected.add((doc_id, len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    got = contamination_digest(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(2), spark.createDataFrame(items, "item_id string, text string"))
    assert {tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in got.collect()} == expected
    assert max(x[3] for x in expected) == 41


def test_a_long_conversation_and_long_texts(spark):
    r = random.Random(2)
    pieces = ["</s>", "[INST]", "[/INST]", "<s>", "&amp;", "&#91;", "\n", "word ", "한국 "]
    text = lambda n: "".join(r.choice(pieces) for _ in range(n))
    rows = [(1, k, "assistant" if k % 2 else "user", text(4)) for k in range(3000)] + [(2, 0, "user", text(60_000)), (2, 1, "assistant", text(60_000)), (3, 0, "assistant", None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").orderBy(F.rand(1)).repartition(3)
    for x in chat_digest(frame).collect():
        turns = sorted(t for t in rows if t[0] == x["conv_id"])
        said = "".join(t[3] or "" for t in turns if t[2] == "assistant")
        whole = "".join(f"{t[2]}\n{t[3] or ''}\n" for t in turns)
        assert (x["n_turns"], x["turns_sha256"]) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (x["loss_chars"], x["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())


@pytest.mark.parametrize("together", [3, 50, 4_000_000])
def test_hits_are_what_the_matches_cover(together):
    r = random.Random(together)
    for _ in range(60):
        texts = [" ".join(r.choice("abc") for _ in range(r.randrange(40))).encode() for _ in range(r.randrange(1, 8))]
        said = [" ".join(r.choice("abcd") for _ in range(r.randrange(1, 12))).encode() for _ in range(r.randrange(0, 9))]
        words = decontamination.words_of(said, decontamination.ALPHANUMERIC)
        items = decontamination.Items([f"i{k}" for k in range(len(said))], [words.hashes[a:b] for a, b in zip(words.first, words.first[1:], strict=False)], 4)
        counts, (text, item, _, start, length) = decontamination.shard_matches(texts, items)
        covered = {(t, p) for t, a, n in zip(text.tolist(), start.tolist(), length.tolist(), strict=True) for p in range(a, a + n)}
        n_words, spans, pairs = decontamination.shard_hits(texts, items, together)
        assert n_words.tolist() == counts.tolist()
        own = [(t, p) for t, a, n in zip(*(x.tolist() for x in spans), strict=True) for p in range(a, a + n)]
        assert own == sorted(covered)
        assert list(zip(*(x.tolist() for x in pairs), strict=True)) == sorted(set(zip(text.tolist(), item.tolist(), strict=True)))


def test_a_phrase_thousands_of_times_in_a_document_and_in_thousands_of_items():
    phrase = [f"w{k}" for k in range(12)]
    texts = [" ".join(phrase * 4000).encode(), " ".join(phrase).encode(), b"w0 w1"]
    said = decontamination.words_of([" ".join([f"lead{k}", *phrase]).encode() for k in range(4000)], decontamination.ALPHANUMERIC)
    items = decontamination.Items([f"i{k}" for k in range(4000)], [said.hashes[a:b] for a, b in zip(said.first, said.first[1:], strict=False)], 10)
    began = time.time()
    _, spans, (owner, _) = decontamination.shard_hits(texts, items)
    assert [x.tolist() for x in spans] == [[0, 1], [0, 0], [48_000, 12]] and np.bincount(owner, minlength=3).tolist() == [4000, 4000, 0]
    assert time.time() - began < 10


@pytest.mark.parametrize("doc_id", ["cast(null as long)", "7L", "id"])
def test_the_sample_of_shingles_is_bounded_whatever_the_ids(spark, doc_id):
    docs = spark.range(20_000).selectExpr(f"{doc_id} AS doc_id", "concat_ws(' ', concat('a', id), concat('b', id), concat('c', id), concat('d', id)) AS text")
    assert 200 < len(common_shingles(docs, 4, 400, least=1)) < 700
