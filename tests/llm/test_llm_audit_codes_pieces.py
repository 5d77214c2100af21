"""Filter interaction audit, vector code compression and piece encoding against brute force, the library and odd input."""

import hashlib
import math
import random
from itertools import permutations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from docloom.llm import filter_audit, piece_encoding
from docloom.llm.filter_audit import Chains, audit, document_masks, route, settle
from docloom.llm.piece_encoding import PieceCoder, encode_texts
from docloom.llm.vector_codes import compress, integers, with_label_error

MODEL = public_tokenizers.path("piece_bpe_32k.model")


# Filter interaction audit


def naive_audit(docs, labels):
    """Every order and step by going through all documents."""
    failing = []
    for doc_id, lang, text in docs:
        text = text or ""
        words = [w for w in text.translate({c: " " for c in range(9, 14)}).split(" ") if w]
        bad = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": doc_id is not None and any(o is not None and o < doc_id and (t or "") == text for o, _, t in docs),
        }
        said = [(q, t) for i, q, t in labels if i == doc_id and i is not None]
        failing.append((lang or "", {k for k, v in bad.items() if v}, any(q == 1 for q, _ in said), any(t == 1 for _, t in said)))
    rows = {}
    for part in {x[0] for x in failing}:
        own, total = [x for x in failing if x[0] == part], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                gone = set(order[: step - 1])
                removed = [x for x in own if f in x[1] and not x[1] & gone]
                kept = sum(not x[1] & set(order[:step]) for x in own)
                total[f] += len(removed)
                redundant, alone = sum(f in x[1] and bool(x[1] & gone) for x in own), sum(x[1] == {f} for x in own)
                rows[part, "".join(order), step] = [kept, len(removed), redundant, alone, sum(x[2] for x in removed), sum(x[3] for x in removed), f]
        for (p, _, _), row in rows.items():
            if p == part:
                row[6] = total[row[6]]
    return {(*k, *v) for k, v in rows.items()}


def test_audit_equals_brute_force_with_copies_nulls_and_clashing_columns(spark):
    r = random.Random(4)
    texts = ["", None, "A $ b", "x " * 300, "\v a\x1cb \f", "한국어 é Äö", "word%d " * 3, " ".join(f"w{i}" for i in range(220)), " ".join(f"W{i}" for i in range(220)), "z" * 300_000]
    docs = [(i if i % 17 else None, r.choice(["en", "de", None, ""]), r.choice(texts)) for i in range(300)]
    docs += [docs[5], docs[5], docs[8], (-9, "en", "only here"), (docs[3][0], "fr", "another text of an id")]
    labels = [(i, r.randrange(2), r.randrange(2)) for i in range(0, 300, 3)] + [(3, 1, None), (3, None, 1), (None, 1, 1), (6, None, None), (99_999, 1, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, lang string, text string").withColumns({"mask": F.lit(7), "part": F.lit("no"), "n": F.lit(2), "good": F.lit(True)}).repartition(5)
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("mask", F.lit(1))
    found = audit(frame, said)
    assert {tuple(x) for x in found.collect()} == naive_audit(docs, labels)
    assert found.dtypes[2] == ("step", "int") and found.count() == 4 * 600
    assert document_masks(frame).agg(F.sum("n")).first()[0] == len(docs)


def test_audit_of_empty_tables(spark):
    docs, labels = spark.createDataFrame([], "doc_id long, lang string, text string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, None, None)], "doc_id long, lang string, text string")
    rows = audit(one, labels).collect()
    assert len(rows) == 600 and {r["part"] for r in rows} == {""} and {r["unique_fails"] for r in rows} <= {0, 1}


def test_a_collision_joins_no_texts_and_a_flush_loses_no_copy(monkeypatch):
    rows = [(5, "en", "a"), (3, "en", "b"), (9, "de", "a"), (1, "en", "a"), (3, "en", "b"), (4, "fr", "b"), (None, "en", "a")]
    expected = sorted([(5, "en", True), (3, "en", False), (9, "de", True), (1, "en", False), (3, "en", False), (4, "fr", True)])
    monkeypatch.setattr(filter_audit.xxhash, "xxh3_64_intdigest", lambda b: 0)  # every text collides
    for held in (0, 10_000_000):
        messages = [m for k in range(0, len(rows), 3) for m in route(rows[k : k + 3], held_bytes=held)]
        settled = [x for x in settle(sorted(messages, key=lambda m: m[0])) if x[0] is not None]
        assert sorted((i, part, bool(mask & filter_audit.COPY)) for i, part, mask, n in settled for _ in range(n)) == expected


def test_a_group_of_copies_sends_one_text_per_partition():
    messages = list(route(((i, "en", "same text") for i in range(50_000, 0, -1))))
    assert sum(isinstance(v[0], bytes) for _, v in messages) == 1
    assert len({k for k, _ in messages}) > 49_000  # settled rows go anywhere
    chains = Chains()
    assert list(chains.add(1, b"x", 2, {"en": 1}, 0)) == [] and list(chains.add(1, b"x", 1, {"de": 2}, 0)) == [(2, "en", filter_audit.COPY, 1)]


# Vector code compression


def naive_codes(rows, parts=8, entries=16, rounds=6):
    """Lloyd's rounds in plain integers; rows of (vec_id, vector, label)."""
    kept = [(i, [math.floor(4096 * v) for v in vector], label) for i, vector, label in rows if vector is not None and all(v is not None and math.isfinite(v) for v in vector)]
    width = len(kept[0][1]) // parts
    cut = lambda x, p: x[p * width : (p + 1) * width]
    first = [min(x for j, x, _ in kept if j == i) for i in sorted({i for i, _, _ in kept})[:entries]]
    books = [[cut(x, p) for x in first] for p in range(parts)]
    distance = lambda a, b: sum((u - v) ** 2 for u, v in zip(a, b, strict=True))
    nearest = lambda x, book: min(range(len(book)), key=lambda e: (distance(x, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            chosen = [(nearest(cut(x, p), books[p]), cut(x, p)) for _, x, _ in kept]
            for e in range(len(books[p])):
                own = [x for k, x in chosen if k == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    out = []
    for i, x, label in kept:
        code = [nearest(cut(x, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{c:02x}" for c in code), sum(distance(cut(x, p), books[p][c]) for p, c in enumerate(code)), label))
    return out, hashlib.sha256(",".join(str(v) for book in books for entry in book for v in entry).encode()).hexdigest()


def coded(spark, rows, width="array<float>"):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding {width}, label int").withColumns({"x": F.lit(1), "code": F.lit("c"), "error": F.lit(0), "part": F.lit(1)})
    return compress(spark, frame.repartition(3))


def found_rows(made):
    return sorted(((r["vec_id"], r["code"].hex(), r["error"], r["label"]) for r in made.codes.collect()), key=repr)


@pytest.mark.parametrize("n", [5, 16, 300])
def test_codes_equal_plain_lloyd(spark, n):
    r = random.Random(n)
    centres = [[r.gauss(0, 0.2) for _ in range(24)] for _ in range(7)]
    rows = [(3 * i - 50, [float(int((c + r.gauss(0, 0.02)) * 2**20)) / 2**20 for c in r.choice(centres)], r.choice([0, 1, None])) for i in range(n)]
    made = coded(spark, rows, "array<double>")
    expected, digest = naive_codes(rows)
    assert made.digest() == digest
    assert found_rows(made) == sorted(expected, key=repr)
    totals = {}
    for *_, error, label in expected:
        totals[label] = totals.get(label, 0) + error
    assert {(x["label"], x["label_error"]) for x in with_label_error(spark, made.codes).collect()} == set(totals.items())


def test_codes_of_odd_vectors(spark):
    r = random.Random(2)
    vector = lambda: [r.randrange(-4096, 4096) / 4096 for _ in range(8)]
    good = [(i, vector(), i % 3) for i in range(40)]
    good += [good[20], good[20]]  # repeated rows
    odd = [(100, None, 1), (101, [None] * 8, 1), (102, [math.nan] * 8, 1), (103, [math.inf] + [0.0] * 7, 1), (-7, [-math.inf] * 8, 1), (105, [1.0] * 9, 1), (106, [], 1)]
    made = coded(spark, good + odd, "array<double>")
    assert (found_rows(made), made.digest()) == (sorted(naive_codes(good)[0], key=repr), naive_codes(good)[1])


def test_codes_of_few_equal_huge_and_no_vectors(spark):
    same = coded(spark, [(i, [0.5] * 16, None) for i in range(20)])
    assert {x[1:3] for x in found_rows(same)} == {("00" * 8, 0)}
    assert coded(spark, []).codes.count() == 0 and coded(spark, [(1, None, 2)]).digest() == hashlib.sha256(b"").hexdigest()
    huge = found_rows(coded(spark, [(1, [1e300] * 8, 1), (2, [-1e300] * 8, 1), (None, [0.0] * 8, 1)], "array<double>"))
    assert len(huge) == 3 and huge[0][1] == "00" * 8
    ragged = coded(spark, [(i, [i / 10] * 11, 1) for i in range(30)])  # 11 isn't divisible by 8
    assert ragged.codes.count() == 30 and len([v for book in ragged.codebooks for v in book[0]]) == 11
    assert compress(spark, spark.createDataFrame([(1, [], 1)], "vec_id long, embedding array<float>, label int")).codes.first()["error"] == 0


def test_a_later_round_writes_only_what_changed(spark):
    from docloom.llm.vector_codes import _pass, parted

    import numpy as np

    rows = spark.createDataFrame([(i, [float(i)] * 8, 0) for i in range(50)], "vec_id long, embedding array<double>, label int")
    state = integers(rows).withColumn("code", F.lit(None).cast("binary"))
    books = parted(np.array([[4096 * v] * 8 for v in (0, 10, 40)], dtype=np.int64), 8).transpose(1, 0, 2)
    made = _pass(state.repartition(2), books, 8)
    again = _pass(made.filter("part is null").select("vec_id", "label", "x", "code"), books, 8)
    assert made.filter("part is not null").groupBy("part").agg(F.sum("n").alias("n")).filter("n = 50").count() == 8
    assert again.filter("part is not null").count() == 0
    books[0, 1] += 4096 * 12
    moved = _pass(made.filter("part is null").select("vec_id", "label", "x", "code"), books, 8).filter("part is not null")
    assert {r["part"] for r in moved.collect()} == {0} and moved.agg(F.sum("n")).first()[0] == 0


# Piece encoding


@pytest.fixture(scope="module")
def coder():
    return PieceCoder(MODEL)


def test_random_texts_and_ids_as_the_library_has_them(coder):
    r = random.Random(8)
    letters = "  ▁ab th in er <0x0A></s><s><unk>éßあ梦①²..--,_\n\t\r\x00​😀​é가나123"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(8000)] + ["", " ", "▁", "\n", "</s>", "a  b", "ab" * 5000, " " * 1000, "\x00" * 40]
    ids = coder.encode_all(texts, 2)
    for text, own, other in zip(texts, ids, coder.library.encode(texts), strict=True):
        assert own.tolist() == [*other, 2], text
        assert coder.decode(own.tolist()) == coder.library.decode([*other, 2])
    for _ in range(8000):
        some = [r.choice([0, 1, 2, *range(3, 259), 28705, 264, 259, 260, 1, 28705]) for _ in range(r.randrange(9))]
        assert coder.decode(some) == coder.library.decode(some), some
    assert not coder.differs


def test_long_units_blocks_and_a_full_cache(coder, monkeypatch):
    text = "the" * 40_000 + " " + "xy z." * 3000 + "梦" * 500
    expected = coder.library.encode(text)
    assert coder.encode(text).tolist() == expected
    small = PieceCoder(MODEL, cache_bytes=5000)
    monkeypatch.setattr(piece_encoding, "SLICE", 50)
    assert [x.tolist() for x in small.encode_all([text, "", "a b c " * 100])] == [expected, [], coder.library.encode("a b c " * 100)]
    assert small.held < 50_000 and not small.differs
    for odd in ("a" * 300, " " * 300 + "b", "a" + " " * 300 + "b c", " a" * 200, "a " * 200 + "x" * 200, ""):
        marked = ("▁" + odd).replace(" ", "▁")
        assert "".join(piece_encoding.slices(marked)) == marked
        assert small.encode(odd).tolist() == coder.library.encode(odd)


def test_other_models_are_refused(tmp_path):
    with pytest.raises(Exception):
        PieceCoder(str(tmp_path / "none.model"))


def test_encoded_tables_hold_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (3, " lead and trail "), (3, " lead and trail "), (4, "w " * 20_000), (5, "x" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit(1), "decoded": F.lit("no"), "agrees": F.lit(False)})
    for whole in (False, True):
        found = encode_texts(docs, MODEL, whole_check=whole).collect()
        assert sorted(((r["doc_id"], r["decoded"]) for r in found), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
        assert all(r["agrees"] for r in found) and [r["ids"] for r in found if r["doc_id"] in (1, 2)] == [[2], [2]]
    assert encode_texts(docs.limit(0), MODEL).count() == 0


def test_a_library_that_differs_is_told(coder):
    other = PieceCoder(MODEL)
    other.surfaces[264] = b" b"
    other.pairs.made[other.pairs.made == 264] = 265
    other.encode("a word")
    assert other.differs


def test_every_document_is_encoded_as_the_library_does(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = encode_texts(docs, MODEL, whole_check=True)
    assert found.filter("agrees").count() == docs.count()
    same = found.join(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id")
    assert same.filter("decoded = replace(text, '▁', ' ')").count() == docs.count()
