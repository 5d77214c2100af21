"""Wrappers of hosts: the aligner against brute force, names of pages, constants of groups that have no place."""

import random
import time

import pytest

from docloom.llm import wrappers
from docloom.llm.alignment import aligned
from docloom.llm.html_blocks import Block, blocks_of


def longest_common(left, right):
    best = [0] * (len(right) + 1)
    for x in left:
        row = [0]
        for j, y in enumerate(right):
            row.append(best[j] + 1 if x == y else max(best[j + 1], row[j]))
        best = row
    return best[-1]


def checked(left, right):
    pairs = aligned(left, right)
    assert all(left[i] == right[j] for i, j in pairs)
    assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:], strict=False))
    assert bool(pairs) == bool(set(left) & set(right))
    return len(pairs)


def test_tokens_that_do_not_repeat_get_a_longest_common_subsequence():
    r = random.Random(1)
    for _ in range(300):
        left, right = r.sample(range(30), r.randint(0, 25)), r.sample(range(30), r.randint(0, 25))
        pairs = checked(left, right)
        prefix = next((k for k, (x, y) in enumerate(zip(left, right, strict=False)) if x != y), min(len(left), len(right)))
        assert pairs >= prefix and pairs == longest_common(left, right)


def test_repeating_tokens_are_aligned_nearly_as_well():
    r, found, best = random.Random(2), 0, 0
    for _ in range(300):
        left = [r.choice("abcdefgh") for _ in range(r.randint(0, 60))]
        right = [x for x in left if r.random() < 0.8]
        for _ in range(r.randint(0, 8)):
            right.insert(r.randint(0, len(right)), r.choice("abcdefgh"))
        found, best = found + checked(left, right), best + longest_common(left, right)
    assert found >= 0.85 * best


@pytest.mark.parametrize("kinds", [3, 50, 20_000])
def test_twenty_thousand_units_take_seconds(kinds):
    r = random.Random(kinds)
    left = [r.randrange(kinds) for _ in range(20_000)]
    right = [x for x in left if r.random() < 0.9]
    began = time.time()
    assert len(aligned(left, right)) >= 0.3 * len(right)
    assert aligned(left[:0], right) == [] == aligned(["a"] * 20_000, ["b"] * 20_000)
    assert time.time() - began < 10


def page(i, footer, near=""):
    text = [f"Sentence {k} of page {i}{near}, which says something about a matter that no other page has at heart, at some length. " for k in range(4)]
    return f"<body><div class='q1'><p>{text[0] * 2}</p><p>{text[1] * 2}{text[2]}</p></div><div class='q2'><p>{footer}</p></div></body>", [(text[0] * 2).strip(), (text[1] * 2 + text[2]).strip()]


def texts_of(spark, pages, partitions=3):
    rows = spark.sparkContext.parallelize([(k, f"http://h.org/{k}", p) for k, p in enumerate(pages)], partitions)
    found = wrappers.main_text(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r["text"] for r in sorted(found, key=lambda r: r["page_id"])]


def test_a_footer_longer_than_every_article_is_template(spark):
    footer = "All rights to all that stands here are reserved by those who wrote it. " * 40
    pages, own = zip(*(page(i, footer) for i in range(30)), strict=True)
    assert texts_of(spark, pages) == ["\n\n".join(x) for x in own]


def test_near_copies_of_a_page_keep_their_article(spark):
    """Copies that differ in a paragraph which isn't the longest, and in a dated line, are one page."""
    footer = "All rights reserved."
    first, own = page(0, footer)
    pages = [first.replace(own[0], f"{own[0][:-20]} {i}").replace("<body>", f"<body><div class='q3'>Read on day {i}</div>") for i in range(20)]
    assert all(own[1] in t for t in texts_of(spark, pages))


def test_constants_do_not_depend_on_how_many_groups_a_host_has(spark, monkeypatch):
    """A notice in containers that stand at another place on every page, beside more groups than a wrapper holds."""
    word = lambda k: "".join(chr(97 + int(d)) for d in str(k))
    notice = "<div class='note'><p>This notice stands on each of these pages, wherever there is room for it.</p></div>"

    def own(i):
        return [f"Part {k} of page {i}, which is long enough to be counted as a text of its own among all others." for k in range(6)]

    def made(i):
        parts = [f"<div class='tag q{word(6 * i + k)}'><p>{t}</p></div>" for k, t in enumerate(own(i))]
        parts.insert(i % 7, notice)
        return f"<body><div class='story'>{''.join(parts)}</div></body>"

    wanted = ["\n\n".join(own(i)) for i in range(120)]
    assert texts_of(spark, [made(i) for i in range(12)]) == wanted[:12]
    for most in (wrappers.MOST, 5):
        monkeypatch.setattr(wrappers.generalised, "__defaults__", (most, None))
        assert texts_of(spark, [made(i) for i in range(120)]) == wanted


def test_groups_that_lose_their_place_are_handed_on():
    items = [[f"p{i}", False, True, 8 - i, [i], [[i, 3, 0]]] for i in range(8)]
    away = []
    kept = wrappers.generalised(items, 3, away)
    assert [x[0] for x in kept] == ["p0", "p1", "p2", "*"] and [x[0] for x in away] == [f"p{i}" for i in range(3, 8)]
    rare = wrappers.Rare(6)
    rare.add("h", away + [["p3", False, True, 2, [9], [[3, 3, 0], [4, 3, 0]]]])
    assert rare.full() and len(rare.held) == 5
    joined = rare.held["h", "p3"]
    assert joined[wrappers.STREAMS] == 7 and joined[wrappers.PAGES] == [3, 9] and [c[0] for c in joined[wrappers.CONSTANTS]] == [3]
    hosts, _ = rare.rows()
    assert hosts == ["h"] * 5 and not rare.held and not rare.full()


def test_page_names():
    name = lambda *x: wrappers.page_name([Block("a>p", place, t, linked, inside) for inside, place, t, linked in x])
    long, other = "t" * 300, "u" * 200
    assert name() == name()
    assert name((1, "plain", long, 0)) == name((1, "plain", long, 0), (1, "plain", other, 0)) == name((1, "plain", long, 0), (2, "plain", "day 1", 0))
    assert name((1, "plain", long, 0)) != name((1, "plain", long, 0), (2, "plain", other, 0))
    assert name((1, "plain", long, 0)) == name((1, "plain", long, 0), (2, "plain", other, 150)) == name((1, "plain", long, 0), (2, "outside", other * 9, 0))
    assert [b.inside for b in blocks_of("<body>x<div><p>a<p>b<ul><li>c</ul></div><div><p>d</div>e")] == [1, 2, 2, 3, 4, 1]
    assert blocks_of("") == [] and wrappers.fold([]) == []
