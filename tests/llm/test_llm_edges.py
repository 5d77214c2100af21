"""Nulls in any column, empty and long texts, ties, repeated rows, empty tables and extra columns with clashing names."""

import hashlib
import json
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import chat, decontamination, html_blocks, jaccard, language_id, line_dedup, nearest, packing, sharding, url_filter, wrappers

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n bigint, matches string, _row string, component_id string, label string, kept_text string, _stratum string"
SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977}" for i in range(40_000))
TEXTS = [None, "", " \n\t", "one two three four five six seven eight nine ten eleven", "one two three four five six seven eight nine ten eleven", LONG, "ab", "ÀÉ déjà vu\r\nligne deux", "x\x00y z"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 3 else None, "s" if i % 2 else None, None, 1, "m", "r", "c", "l", "k", "q") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[3], (None, "no id", None, None, None, None, None, None, None, None, None, None)], DOCS)


def test_language(spark, docs):
    model = language_id.fit_languages(docs)
    out = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language_id.identify(spark, docs, model).collect()}
    by_id = {i: (lang, score) for i, lang, score in out}
    assert by_id[0] == by_id[1] == by_id[2] == ("und", 0.0)
    assert by_id[3] == ("en", 1.0)
    assert language_id.identify(spark, docs, model).columns[: len(docs.columns)] == docs.columns
    empty = docs.limit(0)
    assert language_id.language_report(spark, empty).count() == 0
    assert {r["lang_pred"] for r in language_id.language_report(spark, docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert not language_id.has_letter("— 12 …".encode())
    assert language_id.known_language(spark, docs).columns == docs.columns


def test_language_mixture(spark):
    en = "the cat and the dog were in the house with the other one "
    fr = "les élèves étaient dans une maison avec leurs frères près du château "
    rows = [(i, (en if i % 2 else fr) * 5, "en" if i % 2 else "fr") for i in range(40)]
    model = language_id.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    shares = language_id.mixtures([(en * 8).encode(), (fr * 8).encode(), (en * 6 + fr * 6).encode()], model)
    assert shares[0].tolist() == [1.0, 0.0] and shares[1].tolist() == [0.0, 1.0]
    assert 0.3 < shares[2][0] < 0.7


def test_packing(spark, docs):
    rows = packing.pack(docs, packing.vocabulary_path(), stream_tokens=50_000, with_ids=True).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 0) == 1  # a null text is the end id alone
    assert packing.pack(docs.limit(0), packing.vocabulary_path()).count() == 0
    fill = {}
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) and len(r["ids"]) == r["length"]
        fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.vocabulary_path()).encode(LONG, add_special_tokens=False).ids
    own = sorted((r["start"], r["ids"]) for r in rows if r["doc_id"] == 5)
    assert [i for _, ids in own for i in ids] == [*whole, 2]


def test_html(spark):
    page = '<html><body><nav><a href="/">Home</a></nav><div class="post"><h1>A &amp; B</h1><p>First  <b>text</b><p>Second<br>line</div><div id="comments"><p>me too</div><footer>F</footer>'
    other = page.replace("First", "Another").replace("Second", "Third").replace("A &amp; B", "C")
    rows = [(1, "http://h.org/1", page, "x"), (2, "http://h.org/2", other, "x"), (3, None, None, "x"), (4, "http://h.org/3", "", None), (1, "http://h.org/1", page, "x"), (5, "nohost", "<article>ok<script>no</script></article>tail", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = wrappers.main_text(spark, pages).collect()
    texts = {r["page_id"]: r["text"] for r in out}
    assert len(out) == len(rows)
    assert texts[1] == "A & B\n\nFirst text\n\nSecond line" and texts[2].startswith("C\n\nAnother text")
    assert texts[3] == texts[4] == "" and texts[5] == "ok"
    assert wrappers.main_text(spark, pages.limit(0)).count() == 0


def test_wrapper_groups():
    blocks = [wrappers.Block(p, "plain", t, 0) for p, t in (("body>h1", "T"), ("body>dt", "a"), ("body>dd", "b"), ("body>dt", "c"), ("body>dd", "d"), ("body>div", "end"))]
    first = wrappers.fold(blocks)
    assert [(x[wrappers.TOKENS], x[wrappers.REPEATED]) for x in first] == [("body>h1", False), ("body>dt\tbody>dd", True), ("body>div", False)]
    other = [wrappers.Block("body>h1", "plain", "Another", 0), blocks[-1]]
    merged = wrappers.align(first, wrappers.fold(other))
    assert [x[wrappers.OPTIONAL] for x in merged] == [False, True, False]
    assert [len(x[wrappers.CONSTANTS]) for x in merged] == [0, 4, 1]
    rare = wrappers.generalised([[f"p{i}", False, i != 3, 1, [1], []] for i in range(8)], most=2)
    assert [x[wrappers.TOKENS] for x in rare] == ["p0", "p1", "*", "p3", "*"]


NAMELESS = """<html><body><div class="x1"><div class="x2"><p>Our house</p><p>Ways to us</p></div><div class="x3"><h1>Heading {0}</h1>{1}<p>Thank you for reading on to the end.</p></div>
<div class="x4"><p>Printed by the house of words</p></div></div></body></html>"""


def nameless_pages(n):
    """Pages without an article or main element or a telling class; three to six paragraphs each."""
    texts = {i: [f"Heading {i}", *(f"Paragraph {k} of page {i} speaks at some length of matters of its own." for k in range(3 + i % 4))] for i in range(n)}
    return texts, [(i, f"http://plain.org/{i}", NAMELESS.format(i, "".join(f"<p>{t}</p>" for t in own[1:]))) for i, own in texts.items()]


def test_wrapper_decides_without_telling_names(spark):
    texts, rows = nameless_pages(30)
    frame = spark.createDataFrame(spark.sparkContext.parallelize(rows, 3), "page_id long, url string, html string")
    out = {r["page_id"]: r["text"] for r in wrappers.main_text(spark, frame).collect()}
    assert out == {i: "\n\n".join(own) for i, own in texts.items()}
    blocks = wrappers.blocks_of(rows[0][2])
    assert len(wrappers.extract(blocks, "", set())) == len(blocks) > len(texts[0])  # an empty wrapper takes all


def test_copies_of_a_page_make_no_template(spark):
    _, rows = nameless_pages(1)
    frame = spark.createDataFrame(spark.sparkContext.parallelize([(i, *rows[0][1:]) for i in range(40)], 8), "page_id long, url string, html string")
    assert {"Heading 0" in r["text"] for r in wrappers.main_text(spark, frame).collect()} == {True}


def test_page_of_many_blocks_is_kept_whole(spark):
    page = lambda i: "<body>" + "".join(f'<div class="{"".join(chr(97 + int(d)) for d in str(k))}q"><p>Block {k} of {i}</p></div>' for k in range(2000)) + "</body>"
    rows = [(i, f"http://h.org/{i}", page(i)) for i in range(2)]
    for r in wrappers.main_text(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        assert r["text"].split("\n\n") == [f"Block {k} of {r['page_id']}" for k in range(2000)]


def test_hidden_block_speaks_for_itself(spark):
    page = "<html><body><article><h1>Title {0}</h1><p>First {0}</p><p>Second {0}</p></article></body></html>"
    odd = "<html><body><article><p>Shown</p><h2>Part</h2><p hidden>Not shown</p></article></body></html>"
    rows = [(i, f"http://h.org/{i}", page.format(i)) for i in range(4)] + [(4, "http://h.org/4", odd)]
    out = wrappers.main_text(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    texts = {r["page_id"]: r["text"] for r in out}
    assert texts == {i: f"Title {i}\n\nFirst {i}\n\nSecond {i}" for i in range(4)} | {4: "Shown\n\nPart"}
    mixed = [wrappers.Block("body>p", place, "x", 0) for place in ("plain", "outside", "outside")]
    assert [(x[wrappers.TOKENS], x[wrappers.REPEATED]) for x in wrappers.fold(mixed)] == [("body>p", False), ("body>p|outside", True)]


def test_host_with_more_paths_than_a_wrapper_holds(spark):
    """Containers named after each page's tags: the texts are those that the same pages have on a small table."""
    word = lambda i: "q" + "".join(chr(97 + int(d)) for d in str(i))
    part = lambda i, k: f'<div class="tag-{word(4 * i + k)}"><p>Part {k} of page {i}, long enough to count.</p></div>'
    page = lambda i: f'<body><nav><p>Menu</p></nav><div class="story"><h1>Title {i}</h1>{"".join(part(i, k) for k in range(4))}</div><div class="misc"><p>On every page.</p></div></body>'
    wanted = {i: "\n\n".join([f"Title {i}", *(f"Part {k} of page {i}, long enough to count." for k in range(4))]) for i in range(180)}
    for n in (12, 180):
        rows = spark.sparkContext.parallelize([(i, f"http://h.org/{i}", page(i)) for i in range(n)], 3)
        out = wrappers.main_text(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
        assert {r["page_id"]: r["text"] for r in out} == {i: wanted[i] for i in range(n)}


def test_line_dedup(spark, docs):
    out = line_dedup.dedup_lines(spark, docs)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[0]["n_lines"] == rows[1]["n_lines"] == 1 and rows[0]["kept_text"] == ""
    assert rows[3]["n_dropped"] == 0 and rows[4]["n_dropped"] == 1 and rows[4]["kept_text"] == ""
    assert out.count() == docs.count() and set(docs.columns) <= set(out.columns)
    assert line_dedup.dedup_lines(spark, docs.limit(0)).count() == 0


def test_columns_of_any_name(spark, docs):
    odd = docs.select("doc_id", "text", "source", *[F.lit(c).alias(c) for c in ("_lines", "_dropped", "_text", "_text_hash", "_hash", "_doc", "_row", "_bucket", "_cell", "_stratum", "_tie", "_at", "_shard", "shard", "h1", "kept_text")])
    lines = line_dedup.dedup_lines(spark, odd)
    assert lines.columns == [*[c for c in odd.columns if c != "kept_text"], "kept_text", "n_lines", "n_dropped"]
    assert {(r["_lines"], r["_dropped"], r["_text_hash"], r["_row"]) for r in lines.collect()} == {("_lines", "_dropped", "_text_hash", "_row")}
    shards = sharding.interleave(odd, 3)
    assert shards.columns == [*[c for c in odd.columns if c != "shard"], "shard", "slot"]
    assert {(r["_bucket"], r["_stratum"], r["_shard"]) for r in shards.collect()} == {("_bucket", "_stratum", "_shard")} and shards.count() == odd.count()


def test_sharding_buckets_follow_from_sizes(spark):
    """Where each bucket begins, against a count of all fractional ranks; strata smaller and larger than the number of buckets."""
    sizes = {"a": 1, "b": 7, "c": 16, "d": 17, "e": 1000}
    rows = spark.createDataFrame(list(sizes.items()), "_stratum string, _size long")
    got = {r["_bucket"]: r["_first"] for r in sharding.fraction_starts(rows, 4).collect()}
    ranks = sorted((2 * r - 1) * 16 // (2 * n) for n in sizes.values() for r in range(1, n + 1))
    assert got == {b: ranks.index(b) for b in set(ranks)}


@pytest.mark.skipif(not Path(SF).exists(), reason="needs the driver's benchmark table")
def test_pipeline_stages(spark, docs):
    import corpus_pipeline as pipeline

    kept = {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, SF)
        kept[name] = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out.collect())
        assert name == "packing" or out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    every = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in docs.collect())
    assert kept["line_dedup"] == kept["decontamination"] == every and sorted(set(kept["packing"])) == sorted(set(every))
    assert [x for x in every if x not in kept["language_id"]] == [(False, 0), (False, 1), (False, 2)]
    assert [x for x in every if x not in kept["jaccard_join"]] == [(False, 4)] and kept["jaccard_join"].count((False, 3)) == 2


def test_url_filter(spark):
    urls = [None, "", "nothing", "http://a.net/x", "HTTPS://X.Example.NET/en/1", "http://example.com/de/1", "http://notexample.com/de/", "http://b.org/fr/", "http://b.org/FR/", "http://net/", "http://a.net", "http://é.org/?q#f"]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    out = {r["page_id"]: (r["rule"], r["verdict"], r["host"], r["path"]) for r in url_filter.judge(pages).collect()}
    assert out[3][:2] == ("net/", "block") and out[4][:2] == ("example.net/en/", "allow") and out[5][:2] == ("example.com/de/", "block")
    assert out[7][:2] == ("org/fr/", "allow") and out[8][0] is None and out[9][0] == "net/" and out[10][0] is None
    assert out[0][2:] == out[2][2:] == ("", "")
    assert all(x[1] in ("allow", "block") for x in out.values())
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_decontamination(spark, docs):
    items = [("a", "FIVE six seven eight nine ten eleven one two three four five six"), ("b", "deux"), ("c", None), (None, "ligne"), ("d", ""), ("e", "one two three four five six seven eight nine ten zzz"), ("e", "word1")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    rows = {r["doc_id"]: r for r in decontamination.contamination_digest(spark, docs, bench).collect()}
    assert rows[0]["n_words"] == 0 and not rows[0]["contaminated"] and rows[0]["items_sha256"] == hashlib.sha256(b"").hexdigest()
    assert (rows[3]["n_hit"], rows[3]["n_items"]) == (10, 1) and rows[7]["n_hit"] == 1 and rows[7]["items_sha256"] == hashlib.sha256(b"b").hexdigest()
    found = decontamination.find_matches(spark, docs, bench, block_words=8)
    assert {r["doc_id"]: [m["item_id"] for m in r["matches"]] for r in found.collect()}[3] == ["e"]
    assert found.columns[-2:] == ["n_words", "matches"]
    assert decontamination.decontaminate(spark, docs, bench).columns == docs.columns
    assert decontamination.find_matches(spark, docs, bench.limit(0)).filter("size(matches) > 0").count() == 0
    assert decontamination.find_matches(spark, docs.limit(0), bench).count() == 0


def test_jaccard(spark, docs):
    out = jaccard.jaccard_components(spark, docs).collect()
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in out}
    assert len(out) == docs.count()
    assert {(0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 8, 3), (4, 8, 3), (6, 1, 6), (None, 1, None)} <= got
    assert jaccard.jaccard_components(spark, docs.limit(0)).count() == 0


def test_jaccard_across_levels(spark):
    # Each pair stands on both sides of a level's upper end, and each text is the largest of its partition.
    rows = []
    for k, (n, more) in enumerate(((97, 4), (121, 9), (366, 30), (890, 10), (1113, 1))):
        words = [f"w{k}x{i}" for i in range(n + more + jaccard.WIDTH - 1)]
        rows += [(2 * k, " ".join(words[: n + jaccard.WIDTH - 1])), (2 * k + 1, " ".join(words))]
    single = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), "doc_id long, text string")
    out = jaccard.jaccard_components(spark, single).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == {i: i // 2 * 2 for i in range(len(rows))}


@pytest.mark.parametrize("percent", [50, 80, 85, 99])
def test_levels_reach_as_far_as_links(percent):
    for small in range(1, 400):
        named = {k for k, _ in jaccard.Levels(percent, small).of(np.array([small]))}
        for large in range(small, 100 * small // percent + 1):
            levels = jaccard.Levels(percent, large)
            k = int(np.searchsorted(levels.top, large))
            assert k in named or not levels.apart[k]


def test_sharding(spark, docs):
    out = sharding.shard_documents(docs, n_shards=4).collect()
    sizes = [sum(r["shard"] == s for r in out) for s in range(4)]
    assert sum(sizes) == docs.count() and max(sizes) - min(sizes) <= 1
    for s in range(4):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sizes[s]))
    assert {r["size"] for r in out if r["doc_id"] in (0, 1)} == {16}
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def test_chat(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "a</s>[INST] & &amp; <s>\n"), (1, 1, "assistant", "a</s>[INST] & &amp; <s>\n"), (2, 0, None, ""), (2, None, "assistant", None), (None, 0, "user", "x")]
    talks = spark.createDataFrame([(*r, "t") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    out = {r["conv_id"]: r for r in chat.chat_digest(talks).collect()}
    text = "a</s>[INST] & &amp; <s>\n"
    assert out[1]["n_turns"] == 3 and out[1]["loss_chars"] == 2 * len(text) and out[1]["loss_sha256"] == hashlib.sha256((text * 2).encode()).hexdigest()
    assert out[2]["loss_chars"] == 0 and out[None]["n_turns"] == 1
    assert chat.chat_digest(talks.limit(0)).count() == 0


def test_chat_events(spark):
    log = [(1, 1, 0, "delta", "user", "hel"), (1, 1, 1, "delta", None, "lo"), (1, 2, 0, "delta", "assistant", "wrong"), (1, 2, 2, "delta", None, "B"), (1, 2, 1, "regenerate", None, "A"), (1, 3, 0, "delta", "user", "x"), (1, 3, 1, "delete", None, None), (1, 4, 0, "edit", "user", "new"), (1, 4, 1, None, None, "!")]
    events = spark.createDataFrame(log, "conv_id long, message long, seq long, op string, role string, text string")
    assert {(r["message"], r["role"], r["text"]) for r in chat.reconstruct(events).collect()} == {(1, "user", "hello"), (2, "assistant", "AB"), (4, "user", "new!")}


def test_nearest_edges(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (60, [float("nan"), 1.0]), (80, [1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, 0.5]), (4, [None, 1.0]), (None, [1.0, 1.0]), (5, [float("inf"), 0.0]), (100, [-1.0, 2.0])]
    vectors = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    out = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in nearest.nearest(spark, vectors, k=3).collect())
    assert out == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, 0.5), (100, 1, 3, 0.5), (100, 2, 0, -1.0), (100, 3, 1, -1.0)]
    assert nearest.nearest(spark, vectors.limit(0)).count() == 0
    twice = nearest.nearest(spark, vectors.unionByName(vectors), k=3).collect()  # a repeated row is two candidates, a repeated query one
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in twice if r["query_id"] == 0) == [(0, 1, 1), (0, 2, 1), (0, 3, 2)]


def test_wrappers_are_json():
    assert json.loads(json.dumps(wrappers.fold([wrappers.Block("p", "plain", "x", 0)])))[0][wrappers.TOKENS] == "p"


PROSE = "A paragraph of an article that says something at some length, so that nobody takes it for a label. " * 3


@pytest.mark.parametrize("name", ["social-policy", "menu-open", "research-form", "notice-period-guide", "post related-topics", "search-results-article", "story comment-free", "header-image", "promo2024"])
def test_a_telling_word_in_a_longer_name_empties_no_page(name):
    page = f"<body><nav>Home</nav><h1>A headline</h1><div class='{name}'><p>{PROSE}</p><p>{PROSE}</p></div><footer>All rights</footer></body>"
    assert wrappers.extract(html_blocks.blocks_of(page), "", set()) == ["A headline"] + [PROSE.strip()] * 2


def test_doubted_blocks_go_where_an_article_stands():
    blocks = html_blocks.blocks_of
    outside = f"<div class='comment-list'><p>{PROSE * 9}</p></div><form><p>{PROSE * 9}</p></form><div class='menu'>{PROSE}</div>"
    assert wrappers.extract(blocks(f"<body><div class=text><p>{PROSE}</p></div>{outside}"), "", set()) == [PROSE.strip()]
    assert wrappers.extract(blocks(f"<body><article><p>{PROSE}</p><div class='related-work'>x</div></article>{outside}"), "", set()) == [PROSE.strip()]
    assert wrappers.extract(blocks(f"<body><form id='aspnetForm'><div>Search</div><div class=menu>{PROSE}</div><article><p>{PROSE}</p></article></form>"), "", set()) == [PROSE.strip()]
    assert wrappers.extract(blocks(f"<body><form id='aspnetForm'><div><p>{PROSE}</p></div></form>"), "", set()) == [PROSE.strip()]
    assert wrappers.extract(blocks(f"<body><nav>{PROSE}</nav><div class=comments><p>{PROSE}</p></div>"), "", set()) == []


def test_deep_nesting_takes_memory_and_time_by_blocks():
    page = "<div class='abc'><p>t" * 50_000
    blocks = html_blocks.blocks_of(page)
    assert len(blocks) == 50_000 and max(len(b.path) for b in blocks) <= html_blocks.LONGEST_PATH and sum(len(b.path) for b in blocks) < 80_000_000
    assert len({b.path for b in blocks}) == 50_000  # still told apart
    assert [b.path for b in html_blocks.blocks_of(page)[-3:]] == [b.path for b in blocks[-3:]]
    unmatched = html_blocks.blocks_of("<div>" * 30_000 + "x</section>" * 30_000)
    assert len(unmatched) == 30_000 and {b.text for b in unmatched} == {"x"}
    wide = html_blocks.blocks_of(f"<div class='{'w' * 100_000}'><p>t</div><p>u")
    assert [b.text for b in wide] == ["t", "u"] and len(wide[0].path) < 100
