"""Main-text extraction by wrappers: union-free regular expressions inferred from the pages of a host.

A page is a stream of blocks; a block's token is its path of containers and, unless plain, its place. Consecutive equal tokens, or runs of up to
`RUN` tokens, fold into a repeated group. A wrapper starts as one page's stream; each further page, or wrapper, is aligned
with it: equal groups merge (repeated if either is), groups that only one side has become optional, and of a group's texts
those stay constants that both sides have: all others are text slots. A wrapper holds the places of at most `MOST` optional
groups. Of the rarest beyond them the place becomes "anything"; what they hold goes on beside the wrapper and is joined over the whole host by
the groups' tokens, as what a place shows on too few pages is, so no constant depends on how many groups a host has.

Inference is a fold in each partition, one wrapper per host there, and then merges of up to `fan_in` wrappers of a host
per task until each host has one. A host with most of the pages costs no task more than its own partition's pages.

The wrapper decides what is template: a text that is constant in its group, at its place or by its tokens, over at least
`TEMPLATE_PAGES` different pages goes, wherever it stands, and it counts for nothing when the content's container is looked for: the innermost one that
holds most of the slots' text of its host, by sums over all pages. Elements, classes, ids and roles are signals beside it: what
they mark as menu, header, footer, sidebar, notice, advert, form or comment is no slot and goes; where a page has an
article or main element, its content is the slots in there.
"""

from __future__ import annotations

import json
from collections import OrderedDict
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.alignment import aligned
from docloom.llm.html_blocks import Block, blocks_of
from docloom.llm.shared import ASCII_LOWER, ASCII_UPPER, Workspace

RUN = 4
MOST = 400
TEMPLATE_PAGES = 5
#: What isn't doubted on a page is no article if it has fewer characters outside links.
LEAST = 140
#: Fields of a wrapper's item: the group's tokens (tab between them; ANY: anything), repeated, optional, how many streams it
#: came from, the smallest TEMPLATE_PAGES different page names among them, and the constant texts as [key, characters, token].
TOKENS, REPEATED, OPTIONAL, STREAMS, PAGES, CONSTANTS = range(6)
ANY = "*"
#: A partition's wrappers (host, wrapper), groups without a place (host, rare: JSON of GROUP) and sums (host, path, chars, linked).
PARTIAL = pa.schema([(c, pa.string()) for c in ("host", "wrapper", "rare", "path")] + [(c, pa.int64()) for c in ("chars", "linked")])
GROUP = "tokens string, streams long, pages array<long>, constants array<struct<key: long, chars: long, place: int>>"


def token(block: Block) -> str:
    """What blocks are compared by: equal paths can differ in place, by attributes that a path doesn't name."""
    return block.path if block.place == "plain" else f"{block.path}|{block.place}"


def hashed(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), signed=True)


def block_key(block: Block) -> int:
    return hashed(f"{token(block)}\n{block.text}")


def page_name(blocks: list[Block]) -> int:
    """A page goes by its longest text and the longest one in another container, if that could be an article too.

    So neither copies and near copies of one page make a template of its article, nor does a footer that is longer than
    every article make all pages of a host one. Names are told by what isn't outside anyway.
    """
    shown = [b for b in blocks if b.place != "outside"] or blocks
    first = max(shown, key=lambda b: len(b.text), default=None)
    if first is None:
        return hashed("")
    others = (b.text for b in shown if len(b.text) - 2 * b.linked >= LEAST and b.inside != first.inside)
    return hashed("\n".join(sorted((first.text, max(others, key=len, default="")))))


def fold(blocks: list[Block]) -> list[list]:
    """The stream as items; repeated runs are folded, the longest fold first at each place."""
    out, i, tokens, name = [], 0, [token(b) for b in blocks], page_name(blocks)
    while i < len(blocks):
        width, times = 1, 1
        for w in range(1, RUN + 1):
            t = 1
            while tokens[i + t * w : i + (t + 1) * w] == tokens[i : i + w] and i + (t + 1) * w <= len(tokens):
                t += 1
            if t > 1 and w * t > width * times:
                width, times = w, t
        texts = {block_key(b): [len(b.text), k % width] for k, b in enumerate(blocks[i : i + width * times]) if b.place != "outside"}  # those go anyway
        out.append(["\t".join(tokens[i : i + width]), times > 1, False, 1, [name], [[key, *x] for key, x in texts.items()]])
        i += width * times
    return out


def merged(x: list, y: list) -> list:
    """One item for both: the pages of both, the constants that both have."""
    shared = {c[0] for c in y[CONSTANTS]}
    pages = sorted({*x[PAGES], *y[PAGES]})[:TEMPLATE_PAGES]
    return [x[TOKENS], x[REPEATED] or y[REPEATED], x[OPTIONAL] or y[OPTIONAL], x[STREAMS] + y[STREAMS], pages, [c for c in x[CONSTANTS] if c[0] in shared]]


def align(wrapper: list[list], other: list[list], away: list[list] | None = None) -> list[list]:
    """The wrapper that describes what both describe; optional groups that lose their place are added to `away`."""
    left, right = [x[TOKENS] for x in wrapper], [x[TOKENS] for x in other]
    if left == right:
        return [merged(x, y) for x, y in zip(wrapper, other, strict=True)]
    out, a, c = [], 0, 0
    for i, j in [*aligned(left, right), (len(left), len(right))]:
        out += [[*x[:OPTIONAL], True, *x[STREAMS:]] for x in wrapper[a:i] + other[c:j]]
        if i < len(left):
            out.append(merged(wrapper[i], other[j]))
        a, c = i + 1, j + 1
    return generalised(out, away=away)


def generalised(wrapper: list[list], most: int = MOST, away: list[list] | None = None) -> list[list]:
    """Beyond `most` optional items the rarest become ANY where they stand, neighbours one together; required items stay."""
    optional = [i for i, x in enumerate(wrapper) if x[OPTIONAL] and x[TOKENS] != ANY]
    if len(optional) <= most:
        return wrapper
    rare = set(sorted(optional, key=lambda i: (-wrapper[i][STREAMS], i))[most:])
    if away is not None:
        away += [wrapper[i] for i in sorted(rare)]
    out: list[list] = []
    for i, x in enumerate(wrapper):
        if i in rare or x[TOKENS] == ANY:
            x = [ANY, True, True, x[STREAMS], x[PAGES], []]
            if out and out[-1][TOKENS] == ANY:
                out[-1] = merged(out[-1], x)
                continue
        out.append(x)
    return out


class Rare:
    """Groups without a place, of equal tokens one per host, until there are too many to hold."""

    def __init__(self, most: int):
        self.most, self.held, self.size = most, {}, 0

    def add(self, host: str, items: list[list]) -> None:
        for x in items:
            own = self.held.get((host, x[TOKENS]))
            self.held[host, x[TOKENS]] = merged(own, x) if own else x
            self.size += 0 if own else 1 + len(x[CONSTANTS])
        items.clear()

    def full(self) -> bool:
        return self.size >= self.most

    def rows(self) -> tuple[list[str], list[str]]:
        """Hosts and JSON of all that is held, which then goes."""
        found = [h for h, _ in self.held], [rare_json(x) for x in self.held.values()]
        self.held, self.size = {}, 0
        return found


def rare_json(x: list) -> str:
    return json.dumps({"tokens": x[TOKENS], "streams": x[STREAMS], "pages": x[PAGES], "constants": [dict(zip(("key", "chars", "place"), c, strict=True)) for c in x[CONSTANTS]]})


def template_texts(wrapper: list[list]) -> Iterator[tuple[int, str, int]]:
    """(key, path, characters over all its streams) of each text that is constant over TEMPLATE_PAGES different pages."""
    for x in wrapper:
        if len(x[PAGES]) >= TEMPLATE_PAGES:
            tokens = x[TOKENS].split("\t")
            yield from ((key, tokens[k], chars * x[STREAMS]) for key, chars, k in x[CONSTANTS])


def rare_templates(rare: DataFrame) -> DataFrame:
    """host, key, path, fixed: what is constant in all groups of equal tokens that have no place of their own, `rare` (host, rare), over TEMPLATE_PAGES pages."""
    groups = rare.select("host", F.from_json("rare", GROUP).alias("g")).select("host", "g.*")
    pages = groups.select("host", "tokens", F.explode("pages").alias("page")).distinct().groupBy("host", "tokens").count().filter(F.col("count") >= TEMPLATE_PAGES)
    whole = groups.groupBy("host", "tokens").agg(F.count("*").alias("parts"), F.sum("streams").alias("streams")).join(pages.drop("count"), ["host", "tokens"])
    said = groups.select("host", "tokens", F.explode("constants").alias("c"))
    held = said.groupBy("host", "tokens", F.col("c.key").alias("key")).agg(F.count("*").alias("n"), F.max("c.chars").alias("chars"), F.min("c.place").alias("place"))
    path = F.element_at(F.split("tokens", "\t"), F.col("place") + 1)
    return held.join(whole, ["host", "tokens"]).filter("n = parts").select("host", "key", path.alias("path"), (F.col("chars") * F.col("streams")).alias("fixed"))


def host_templates(work: Workspace, wrappers: DataFrame, rare: DataFrame, paths: DataFrame) -> DataFrame:
    """host, root (null: none) and templates (keys of its template texts, no more than a page has blocks; null: none).

    `paths` (host, path, chars, linked) are partial sums over all plain blocks. A path's weight is its text outside links
    and templates; the root is the innermost container with 70 % of its host's weight.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                wrapper = json.loads(text)
                found += [(host, *t, None) for t in template_texts(wrapper)]
                found += [(host, None, None, None, rare_json(x)) for x in wrapper if x[OPTIONAL] and x[TOKENS] != ANY and len(x[PAGES]) < TEMPLATE_PAGES]
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t in enumerate(kinds)], ["host", "key", "path", "fixed", "rare"])

    told = work.write(wrappers.select("host", "wrapper").mapInArrow(run, "host string, key long, path string, fixed long, rare string"), "told")
    beside = rare_templates(told.filter("rare is not null").select("host", "rare").unionByName(rare))
    said = work.write(told.filter("rare is null").drop("rare").unionByName(beside), "templates")
    sums = paths.groupBy("host", "path").agg(F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    fixed = said.groupBy("host", "path").agg(F.sum("fixed").alias("fixed"))
    weighed = sums.join(fixed, ["host", "path"], "left").withColumn("weight", F.col("chars") - 2 * F.col("linked") - F.coalesce("fixed", F.lit(0)))
    slots = work.write(weighed.filter("weight > 0").select("host", "path", "weight"), "slots")
    steps = F.split("path", ">")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(steps, F.lit(1), k), ">").alias("root")))
    each = slots.select("host", "weight", F.explode(above).alias("c")).groupBy("host", "c.depth", "c.root").agg(F.sum("weight").alias("weight"))
    total = slots.groupBy("host").agg(F.sum("weight").alias("total"))
    name = F.substring_index(F.element_at(F.split("root", ">"), -1), ".", 1)
    most = each.join(total, "host").filter((F.col("weight") >= 0.7 * F.col("total")) & ~name.isin("p", "li", "td", "h1", "h2", "h3"))
    roots = most.groupBy("host").agg(F.max(F.struct("depth", "weight", "root"))["root"].alias("root"))
    return work.write(roots.join(said.groupBy("host").agg(F.collect_set("key").alias("templates")), "host", "full"), "hosts")


def extract(blocks: list[Block], root: str, templates: set[int]) -> list[str]:
    """The texts of a page's content blocks.

    Template texts and what is marked as outside go. Of the rest: the blocks in an article or main element, else those in
    the host's root (in all of the page, where it has none), without runs of blocks that are mostly links, which are menus.
    What is in doubt goes too, unless the page would be left without an article: a doubted article stays if it outweighs
    all that isn't doubted, other doubted blocks, with the headline, if what isn't is shorter than any article (LEAST characters).
    """
    slots = [b for b in blocks if b.place != "outside" and not (templates and block_key(b) in templates)]
    if any(b.place == "main" for b in blocks):
        return [b.text for b in slots if b.place == "main"]
    weight = {place: sum(max(0, len(b.text) - 2 * b.linked) for b in slots if b.place == place) for place in ("plain", "doubt", "doubt main")}
    if weight["doubt main"] > weight["plain"]:
        return [b.text for b in slots if b.place == "doubt main"]
    if weight["plain"] < min(LEAST, weight["doubt"]):
        within = [b for b in slots if b.place == "doubt" or b.path.rsplit(">", 1)[-1].split(".")[0] == "h1"]
    else:
        plain = [b for b in slots if b.place == "plain"]
        within = [b for b in plain if not root or b.path == root or b.path.startswith(root + ">")] or plain
    link = [2 * b.linked > len(b.text) for b in within]
    menu = [x and (link[max(0, i - 1)] and i > 0 or i + 1 < len(link) and link[i + 1]) for i, x in enumerate(link)]
    return [b.text for b, gone in zip(within, menu, strict=True) if not gone]


def host_of(url):
    """The url's host, A-Z lower-cased; empty for null or without ://."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, ASCII_UPPER, ASCII_LOWER)


def infer(work: Workspace, pages: DataFrame, fan_in: int = 32, held: int = 100_000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(host, wrapper (JSON)): one row per host of `pages` (host, html); and the groups without a place and partial sums that host_templates takes."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts: OrderedDict[str, list] = OrderedDict()
        sums: dict[tuple[str, str], list[int]] = {}
        rare, away = Rare(held), []
        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                blocks = blocks_of(page or "")
                stream = fold(blocks)
                hosts[host] = align(hosts[host], stream, away) if host in hosts else stream
                rare.add(host, away)
                for b in blocks:
                    if b.place == "plain":
                        own = sums.setdefault((host, b.path), [0, 0])
                        own[0] += len(b.text)
                        own[1] += b.linked
                if len(sums) >= held:
                    yield batch_of(PARTIAL, host=[k[0] for k in sums], path=[k[1] for k in sums], chars=[v[0] for v in sums.values()], linked=[v[1] for v in sums.values()])
                    sums = {}
                if rare.full():
                    yield batch_of(PARTIAL, **dict(zip(("host", "rare"), rare.rows(), strict=True)))
        yield batch_of(PARTIAL, host=[k[0] for k in sums], path=[k[1] for k in sums], chars=[v[0] for v in sums.values()], linked=[v[1] for v in sums.values()])
        yield batch_of(PARTIAL, **dict(zip(("host", "rare"), rare.rows(), strict=True)))
        yield batch_of(PARTIAL, host=list(hosts), wrapper=[json.dumps(w) for w in hosts.values()])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, whole, schema = None, None, pa.schema(list(PARTIAL)[:3])
        rare, away = Rare(held), []
        for batch in batches:
            for host, group, wrapper in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2)), strict=True):
                if (host, group) != last:
                    if whole is not None:
                        yield batch_of(schema, host=[last[0]], wrapper=[json.dumps(whole)])
                    last, whole = (host, group), json.loads(wrapper)
                else:
                    whole = align(whole, json.loads(wrapper), away)
                    rare.add(host, away)
                if rare.full():
                    yield batch_of(schema, **dict(zip(("host", "rare"), rare.rows(), strict=True)))
        if whole is not None:
            yield batch_of(schema, host=[last[0]], wrapper=[json.dumps(whole)])
        yield batch_of(schema, **dict(zip(("host", "rare"), rare.rows(), strict=True)))

    partial = work.write(pages.select("host", "html").mapInArrow(first, "host string, wrapper string, rare string, path string, chars long, linked long"), "partial")
    found, rare = partial.filter("wrapper is not null").select("host", "wrapper"), partial.filter("rare is not null").select("host", "rare")
    step = 0
    while (most := found.groupBy("host").count().agg(F.max("count")).first()[0] or 0) > 1:
        groups = -(-most // fan_in)
        dealt = found.withColumn("group", F.pmod(F.xxhash64("wrapper"), F.lit(groups))).select("host", "group", "wrapper")
        together = dealt.repartition("host", "group").sortWithinPartitions("host", "group", "wrapper").mapInArrow(merge, "host string, wrapper string, rare string")
        step += 1
        told = work.write(together, f"wrappers-{step}")
        found, rare = told.filter("wrapper is not null").select("host", "wrapper"), rare.unionByName(told.filter("rare is not null").select("host", "rare"))
    return found, rare, partial.filter("path is not null").select("host", "path", "chars", "linked")


def batch_of(schema: pa.Schema, **columns: list) -> pa.RecordBatch:
    """Rows of the given columns, the schema's others null."""
    n = len(columns["host"])
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def main_text(spark: SparkSession, pages: DataFrame, *, url_col: str = "url", html_col: str = "html", carry: list[str] | None = None) -> DataFrame:
    """The carried columns (all, if not given) plus text string: the content blocks, two line feeds between them.

    A null or empty html gives an empty text. Pages without a host share one wrapper. Repeated rows give equal texts, and
    copies of a page count as one page for its template; an empty table gives an empty result. Pages of any length and
    number of blocks are taken whole. A column named text is replaced; any other names may come.
    """
    work = Workspace(spark, "wrappers")
    carried = [c for c in (carry if carry is not None else pages.columns) if c != "text"]
    hosted = pages.select(F.struct(*carried).alias("_row"), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    joined = hosted.join(host_templates(work, *infer(work, hosted)), "host", "left").select("_row", "html", F.coalesce("root", F.lit("")).alias("root"), "templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["\n\n".join(extract(blocks_of(page or ""), root, set(keys or ()))) for page, root, keys in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["_row", "text"])

    return joined.mapInArrow(run, hosted.select("_row").schema.add("text", "string")).select("_row.*", "text")
