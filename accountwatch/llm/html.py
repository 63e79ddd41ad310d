"""Main text of web pages by wrappers: union-free regular expressions over a host's token streams.

A page is a stream of tokens, each the path of tags around a text slot; neighbours with
equal tokens, or equal groups of up to four, fold into a repeated group. The streams of
a host are aligned one after the other: what both have stays, a group repeated in one is
repeated in both, and a mismatch becomes an optional group. Each stream is then matched
with its host's wrapper, which gives every slot a place in it; of all ways that fit, the
one that leaves out the fewest groups that are not optional. What a slot is follows from
its place: what stands there over all pages of the host (links, text that is the same on
most pages, a group on all pages with one text), and the tags and names around it. A
page's main text are the slots of its own stream at such places, so that pages of
several templates on one host are judged apart.

Only distinct streams and sums by slot are shuffled, combined before. A host's streams
are aligned in parts of bounded size, then the parts, until one is left; texts of a host
never meet in a task.

Defined results: a null or empty html gives the empty text; a null url has the host '';
repeated rows are extracted alike; broken markup is read as far as it goes, an open tag
ends with its parent, an open script with the page. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountwatch.session import shared_folder

#: Streams of a host that one task aligns, about.
PART_STREAMS = 64
#: Tokens of a repeated group, at most.
LONGEST_GROUP = 4
#: A slot on so many pages whose text has so few variants per page is part of the template.
TEMPLATE_PAGES = 8
TEMPLATE_VARIANTS = 0.1
LINK_SHARE = 0.6
#: Share of the text that the container of the main text holds, if no tag names one.
MAIN_SHARE = 0.75
#: A container with so much of the text is the page's frame, whatever its class words say.
WIDE_SHARE = 0.5

# Tags and words in class, id and role that say what an element is.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE_TAGS = set("head title nav header footer aside form button select option menu dialog svg iframe object canvas audio video math map datalist template noscript".split())
OUTSIDE_WORDS = set(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside ad ads adv advert advertisement adsense sponsor sponsored "
    "promo promotion banner cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login search share sharing "
    "social related recommended recommendations trending comment comments disqus respond reply replies pagination pager toolbar widget widgets copyright "
    "complementary contentinfo".split()
)
MAIN_TAGS = {"article", "main"}
NOT_THE_ARTICLE = set("comment comments reply replies ad ads advert sponsored promo related teaser".split())
# Names with these first or last words speak of something else than the element itself, as "has-sidebar" or "comments-open".
OF_ELSE = set("has with no without category tag".split())
STATES = set("open closed enabled disabled allowed free".split())
MAIN_WORDS = set("article main content post entry story".split())
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr"}),
    "th": ({"td", "th"}, {"tr"}),
}

# A quoted value ends where its quote is followed by what may follow one; any other quote is a character like others,
# so that one which nothing closes swallows its own tag at most. A tag that the next one cuts short is a tag, too.
# Every character is looked at a bounded number of times.
_ATTRIBUTES = r"(?:\"[^\"]*\"(?=[\s/>])|'[^']*'(?=[\s/>])|[^'\"<>]++|['\"])*+"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?:script|style|textarea|xmp)\b{_ATTRIBUTES}>.*?(?:</(?:script|style|textarea|xmp)\s*>|\Z)"
    rf"|<[!?][^<>]*+(?:>|(?=<)|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:\-]*+)(?P<attributes>{_ATTRIBUTES})(?:>|(?=<)|\Z)",
    re.DOTALL | re.IGNORECASE,
)
#: Elements within each other that a path tells apart, as many as pages have; deeper ones add nothing to it.
DEEPEST = 256
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+")


class Block(NamedTuple):
    path: str
    text: str
    link_chars: int


class Item(NamedTuple):
    """A token or a group of them, repeated or optional."""

    paths: tuple[str, ...]
    repeated: bool = False
    optional: bool = False


@lru_cache(maxsize=20_000)
def _label(name: str, attributes: str) -> str:
    """The tag with its names. Marks: ``+`` says that it holds the main text, ``-`` that it does not.

    ``~`` and ``^``: only class words say that it does not, as a name's last word or before it
    ("site-header", "header-fixed"); a frame around the text may have such names too.
    """
    names = [n for found in _NAMES.findall(attributes) for n in " ".join(found).split()]
    own = [[w.lower() for w in _WORDS.findall(n)] for n in names]
    own = [group for group in own if group and group[0] not in OF_ELSE and group[-1] not in STATES]
    words = [w for group in own for w in group]
    if name in ("html", "body"):
        mark = ""
    elif name in OUTSIDE_TAGS or NOT_THE_ARTICLE.intersection(words):
        mark = "-"
    elif name in MAIN_TAGS:
        mark = "+"
    elif any(group[-1] in OUTSIDE_WORDS for group in own):
        mark = "~"
    elif OUTSIDE_WORDS.intersection(words):
        mark = "^"
    else:
        mark = "+" if MAIN_WORDS.intersection(words) else ""
    return mark + ".".join([name, *dict.fromkeys(words)][:4])


def blocks(page: str) -> list[Block]:
    """The text slots of a page in order, each with the path of block-level tags around it."""
    out: list[Block] = []
    names: list[str] = []
    paths: list[str] = [""]  # of the open elements; equal ones are one string
    known: dict[str, str] = {}
    deeper: Counter[str] = Counter()
    buffer: list[str] = []
    links = link_chars = 0

    def flush() -> None:
        nonlocal link_chars
        text = " ".join(entities.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            out.append(Block(paths[-1], text, link_chars))
        link_chars = 0

    def leave(depth: int) -> None:
        del names[depth:], paths[depth + 1 :]
        deeper.clear()

    def add(text: str) -> None:
        nonlocal link_chars
        buffer.append(text)
        if links:
            link_chars += len(text)

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        name = token["name"]
        if name is None:
            continue
        name = name.lower()
        if name in INLINE:
            if name == "a":
                links = 0 if token["close"] else 1
            continue
        if name == "br":
            buffer.append(" ")
            continue
        flush()
        links = 0
        if token["close"]:
            if deeper[name]:
                deeper[name] -= 1
            elif name in names:
                leave(len(names) - 1 - names[::-1].index(name))
        elif name not in VOID and not token["attributes"].endswith("/"):
            if names and names[-1] == "p":
                leave(len(names) - 1)
            closes, within = CLOSED_BY.get(name, ((), ()))
            for depth in range(len(names) - 1, -1, -1):
                if names[depth] in within:
                    break
                if names[depth] in closes:
                    leave(depth)
                    break
            if len(names) == DEEPEST:
                deeper[name] += 1
                continue
            names.append(name)
            label = _label(name, token["attributes"])
            path = f"{paths[-1]}/{label}" if paths[-1] else label
            paths.append(known.setdefault(path, path))
    add(page[at:])
    flush()
    return out


def traced(paths: list[str]) -> list[tuple[Item, list[int]]]:
    """The stream with neighbouring equal tokens, then equal groups of tokens, as repeated groups.

    With each group the token of it that every slot of the page is.
    """
    items: list[tuple[Item, list[int]]] = []
    for path in paths:
        if items and items[-1][0].paths == (path,):
            items[-1] = (Item((path,), repeated=True), [*items[-1][1], 0])
        else:
            items.append((Item((path,)), [0]))
    for size in range(2, LONGEST_GROUP + 1):
        out: list[tuple[Item, list[int]]] = []
        at = 0
        while at < len(items):
            group = items[at : at + size]
            end = at + size
            same = [i.paths for i, _ in group]
            while len(group) == size and [i.paths for i, _ in items[end : end + size]] == same:
                end += size
            if end > at + size:
                starts = [sum(map(len, same[:n])) for n in range(size)]
                tokens = [starts[n % size] + token for n, (_, own) in enumerate(items[at:end]) for token in own]
                out.append((Item(tuple(p for paths in same for p in paths), repeated=True), tokens))
                at = end
            else:
                out.append(items[at])
                at += 1
        items = out
    return items


def folded(paths: list[str]) -> list[Item]:
    return [item for item, _ in traced(paths)]


def streamed(found: list[Block]) -> tuple[str, list[int]]:
    """The stream of a page as an expression, and which slot of it every block fills."""
    items = traced([b.path for b in found])
    slots: list[int] = []
    first = 0
    for item, tokens in items:
        slots += [first + token for token in tokens]
        first += len(item.paths)
    return written([item for item, _ in items]), slots


def grouped(items: list[Item], groups: set[tuple[str, ...]]) -> list[Item]:
    """Single tokens in a row that spell one of the groups, as that group. Tokens that may be missing stay single."""
    sizes = sorted({len(g) for g in groups}, reverse=True)
    out: list[Item] = []
    at = 0
    while at < len(items):
        for size in sizes:
            run = items[at : at + size]
            paths = tuple(p for i in run for p in i.paths)
            if paths in groups and len(run) == size and not any(i.repeated or i.optional for i in run):
                out.append(Item(paths))
                at += size
                break
        else:
            out.append(items[at])
            at += 1
    return out


def aligned(wrapper: list[Item], other: list[Item]) -> list[Item]:
    """A wrapper of all that either describes; mismatches become optional groups."""
    groups = {i.paths for i in (*wrapper, *other) if len(i.paths) > 1}
    if groups:
        wrapper, other = grouped(wrapper, groups), grouped(other, groups)
    match = SequenceMatcher(None, [i.paths for i in wrapper], [i.paths for i in other], autojunk=False)
    out: list[Item] = []
    for tag, a, b, c, d in match.get_opcodes():
        if tag == "equal":
            for x, y in zip(wrapper[a:b], other[c:d], strict=True):
                out.append(Item(x.paths, x.repeated or y.repeated, x.optional or y.optional))
        else:
            out += [Item(i.paths, i.repeated, True) for i in (*wrapper[a:b], *other[c:d])]
    merged: list[Item] = []
    for item in out:
        if merged and merged[-1].paths == item.paths:
            merged[-1] = Item(item.paths, True, merged[-1].optional and item.optional)
        else:
            merged.append(item)
    return merged


def written(wrapper: list[Item]) -> str:
    """The wrapper as an expression: one group a line, ``+`` repeated, ``?`` optional, ``*`` both."""
    sign = {(False, False): "", (True, False): "+", (False, True): "?", (True, True): "*"}
    return "\n".join("(" + " ".join(f"{p}#" for p in i.paths) + ")" + sign[i.repeated, i.optional] for i in wrapper)


def read_wrapper(text: str) -> list[Item]:
    out = []
    for line in text.split("\n") if text else []:
        inner, sign = line[1:].rsplit(")", 1)
        out.append(Item(tuple(p[:-1] for p in inner.split(" ")), sign in ("+", "*"), sign in ("?", "*")))
    return out


def matched(wrapper: list[Item], stream: list[Item]) -> list[tuple[int, int]] | None:
    """The place (group of the wrapper, token in it) of every slot of a stream, or nothing if the wrapper does not describe it."""
    at_paths: dict[tuple[str, ...], list[int]] = {}
    fixed = [0]  # groups before each that no page may leave out
    for i, item in enumerate(wrapper):
        at_paths.setdefault(item.paths, []).append(i)
        fixed.append(fixed[-1] + (not item.optional))
    sizes = sorted({1, *(len(i.paths) for i in wrapper)})
    # After so many items of the stream, by the last group used: groups left out, items and group before.
    ways: list[dict[int, tuple[int, int, int]]] = [{} for _ in range(len(stream) + 1)]
    ways[0][-1] = (0, 0, -1)
    for k, item in enumerate(stream):
        if not ways[k]:
            continue
        for size in sizes:
            run = stream[k : k + size]
            if len(run) < size or (size > 1 and any(i.repeated or len(i.paths) > 1 for i in run)):
                break
            for i in at_paths.get(tuple(p for r in run for p in r.paths), ()):
                if item.repeated and not wrapper[i].repeated:
                    continue
                for j, (left_out, _, _) in ways[k].items():
                    if j < i or (j == i and wrapper[i].repeated):
                        cost = left_out + max(0, fixed[i] - fixed[j + 1])
                        if i not in ways[k + size] or cost < ways[k + size][i][0]:
                            ways[k + size][i] = (cost, k, j)
    if not ways[-1]:
        return None
    group = min(ways[-1], key=lambda i: (ways[-1][i][0] + fixed[-1] - fixed[i + 1], i))
    places: list[tuple[int, int]] = []
    k = len(stream)
    while k:
        _, before, last = ways[k][group]
        width = sum(len(i.paths) for i in stream[before:k])
        places[:0] = [(group, n) for n in range(width)]
        k, group = before, last
    return places


class Slot(NamedTuple):
    """A slot of a stream with what stands at its place on all pages of the host."""

    path: str
    repeated: bool
    optional: bool
    pages: int
    chars: int
    link_chars: int
    variants: int


def _template(slot: Slot) -> bool:
    return slot.pages >= TEMPLATE_PAGES and slot.variants <= TEMPLATE_VARIANTS * slot.pages


def _outside(slots: list[Slot]) -> set[int]:
    """The slots that tags and names put outside the main text."""
    every = [slot.path.split("/") for slot in slots]
    out = {k for k, labels in enumerate(every) if any(label.startswith("-") for label in labels)}
    # Text of an average page that neither links nor the template make up, by container.
    held: dict[tuple[str, ...], float] = {}
    for k, labels in enumerate(every):
        if k not in out and not _template(slots[k]):
            for depth in range(len(labels) + 1):
                container = tuple(labels[:depth])
                held[container] = held.get(container, 0) + (slots[k].chars - slots[k].link_chars) / slots[k].pages
    for k, labels in enumerate(every):
        for depth, label in enumerate(labels):
            if label[:1] not in ("~", "^"):
                continue
            inside = held.get(tuple(labels[: depth + 1]), 0)
            wide = inside > 0 and inside >= WIDE_SHARE * held[()]
            article = any(x[:1] == "+" and x[1:].split(".")[0] in MAIN_TAGS for x in labels[depth + 1 :])
            if not wide or (label[0] == "~" and not article):
                out.add(k)
    return out


def main_slots(slots: list[Slot]) -> list[int]:
    """Which slots of a stream hold main text."""
    every = range(len(slots))
    outside = _outside(slots)
    named = [k for k in every if k not in outside and any(label.startswith("+") for label in slots[k].path.split("/"))]
    if named:
        # In a container that says it holds the text, only a group on every page with one text is part of the template.
        fixed = {k for k in named if slots[k].pages >= TEMPLATE_PAGES and slots[k].variants == 1 and not (slots[k].optional or slots[k].repeated)}
        return [k for k in named if k not in fixed] or named
    inside = [k for k in every if k not in outside and slots[k].link_chars <= LINK_SHARE * slots[k].chars]
    rest = [k for k in inside if not _template(slots[k])]
    if not rest:
        return inside
    # The deepest container that still holds most of what is left of an average page.
    held: dict[str, float] = {}
    for k in rest:
        labels = slots[k].path.split("/")
        for depth in range(len(labels)):
            container = "/".join(labels[:depth])
            held[container] = held.get(container, 0) + slots[k].chars / slots[k].pages
    for k in rest:
        if slots[k].path and slots[k].path in held:
            held[slots[k].path] += slots[k].chars / slots[k].pages
    most = MAIN_SHARE * sum(slots[k].chars / slots[k].pages for k in rest)
    best = min((c for c in held if not c or held[c] >= most), key=lambda c: (-len(c), c))
    return [k for k in rest if slots[k].path == best or slots[k].path.startswith(best + "/") or not best]


def host_of(url: str):
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/@]*@)?([^/:?#]*)", 1), F.lit("")))


def name_of(stream: str) -> str:
    return xxhash.xxh128_hexdigest(stream)


def infer_wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """host, ``stream`` (its name) and ``main`` (its slots of main text, by their places in the host's wrapper) of every stream."""
    spark = pages.sparkSession

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = blocks(page)
                if not found:
                    continue
                what, slots = streamed(found)
                texts: dict[int, list[Block]] = {}
                for slot, block in zip(slots, found, strict=True):
                    texts.setdefault(slot, []).append(block)
                name = name_of(what)
                for slot, mine in texts.items():
                    digest = xxhash.xxh64_intdigest("\n".join(b.text for b in mine)) >> 1
                    sizes = sum(len(b.text) for b in mine), sum(b.link_chars for b in mine)
                    rows.append((host, name, slot, "" if slot else what, *sizes, digest))
            if rows:
                columns = zip(*rows, strict=True)
                kinds = (pa.string(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
                names = ["host", "stream", "slot", "what", "chars", "link_chars", "digest"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    seen = pages.select(host_of(url).alias("host"), F.coalesce(html, F.lit("")).alias("html")).mapInArrow(
        describe, "host string, stream string, slot int, what string, chars bigint, link_chars bigint, digest bigint"
    )
    # Tables are stored between the steps, so that Spark knows their size when it joins.
    root = shared_folder(spark, "streams")

    def stored(table: DataFrame, name: str) -> DataFrame:
        table.write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    sums = stored(
        seen.groupBy("host", "stream", "slot", "what").agg(
            F.count("*").alias("pages"), F.sum("chars").alias("chars"), F.sum("link_chars").alias("link_chars"), F.hll_sketch_agg("digest").alias("texts")
        ),
        "sums",
    )

    def in_parts(table: DataFrame, by: str) -> DataFrame:
        parts = table.groupBy("host").agg(F.ceil(F.count("*") / PART_STREAMS).cast("int").alias("parts"))
        return table.join(parts, "host").withColumn("part", F.pmod(F.xxhash64(by), F.col("parts")).cast("int"))

    def align(streams: pd.DataFrame) -> pd.DataFrame:
        # The commonest stream first, ties by its text, so that the result does not depend on the order of rows.
        streams = streams.sort_values(["pages", "what"], ascending=[False, True])
        wrapper: list[Item] = []
        for i, what in enumerate(streams.what):
            wrapper = aligned(wrapper, read_wrapper(what)) if i else read_wrapper(what)
        return pd.DataFrame({"host": [streams.host.iloc[0]], "what": [written(wrapper)], "pages": [int(streams.pages.sum())]})

    streams = stored(in_parts(sums.where("slot = 0").select("host", "stream", "what", "pages"), "stream"), "parts")
    wrappers, level = streams, 0
    while True:
        wrappers = stored(wrappers.groupBy("host", "part").applyInPandas(align, "host string, what string, pages bigint"), f"wrappers-{level}")
        if wrappers.groupBy("host").count().where("count > 1").isEmpty():
            break
        wrappers, level = in_parts(wrappers, "what"), level + 1
    wrappers = wrappers.select("host", F.col("what").alias("wrapper"))
    # One copy of a host's wrapper meets each part of its streams.
    copies = spark.read.parquet(f"{root}/parts").select("host", "part").distinct()

    def place(streams: pd.DataFrame, wrapper: pd.DataFrame) -> pd.DataFrame:
        items = read_wrapper(wrapper.wrapper.iloc[0])
        rows = []
        for host, name, what in zip(streams.host, streams.stream, streams.what, strict=True):
            places = matched(items, read_wrapper(what))
            if places is None:
                raise ValueError(f"the wrapper of {host} does not describe one of its streams: {what}")
            rows += [(host, name, slot, group, token) for slot, (group, token) in enumerate(places)]
        return pd.DataFrame(rows, columns=["host", "stream", "slot", "group", "token"])

    places = stored(
        streams.groupBy("host", "part").cogroup(copies.join(wrappers, "host").groupBy("host", "part")).applyInPandas(
            place, "host string, stream string, slot int, group int, token int"
        ),
        "places",
    )
    held = stored(
        sums.join(places, ["host", "stream", "slot"]).groupBy("host", "group", "token").agg(
            F.sum("pages").alias("pages"), F.sum("chars").alias("chars"), F.sum("link_chars").alias("link_chars"),
            F.hll_sketch_estimate(F.hll_union_agg("texts")).alias("variants"),
        ).groupBy("host").agg(F.collect_list(F.struct("group", "token", "pages", "chars", "link_chars", "variants")).alias("held")),
        "held",
    )

    def choose(streams: pd.DataFrame, wrapper: pd.DataFrame) -> pd.DataFrame:
        items = read_wrapper(wrapper.wrapper.iloc[0])
        at = {(h["group"], h["token"]): (h["pages"], h["chars"], h["link_chars"], h["variants"]) for h in wrapper.held.iloc[0]}
        main = []
        for what in streams.what:
            places = matched(items, read_wrapper(what)) or []
            main.append(main_slots([Slot(items[g].paths[n], items[g].repeated, items[g].optional, *at[g, n]) for g, n in places]))
        return pd.DataFrame({"host": streams.host, "stream": streams.stream, "main": main})

    described = copies.join(wrappers, "host").join(held, "host")
    return streams.groupBy("host", "part").cogroup(described.groupBy("host", "part")).applyInPandas(
        choose, "host string, stream string, main array<int>"
    )


def extract(pages: DataFrame, wrappers: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """id, url, ``text`` and ``n_chars`` of every page: the main slots of its stream in page order.

    A page whose stream is not among those described is judged by what it holds itself.
    """

    @F.pandas_udf("stream string, slots array<int>, texts array<string>, own array<int>")
    def read(html: pd.Series) -> pd.DataFrame:
        rows = []
        for page in html:
            found = blocks(page or "")
            what, slots = streamed(found)
            chars: dict[int, list[int]] = {}
            for slot, block in zip(slots, found, strict=True):
                sums = chars.setdefault(slot, [0, 0])
                sums[0] += len(block.text)
                sums[1] += block.link_chars
            paths = [p for item in read_wrapper(what) for p in item.paths]
            own = main_slots([Slot(p, False, False, 1, *chars[slot], 1) for slot, p in enumerate(paths)]) if found else []
            rows.append((name_of(what), slots, [b.text for b in found], own))
        return pd.DataFrame(rows, columns=["stream", "slots", "texts", "own"])

    rows = pages.select(id_col, url, host_of(url).alias("_host"), read(html).alias("_page"))
    rows = rows.withColumn("_stream", F.col("_page.stream"))
    known = wrappers.select(F.col("host").alias("_host"), F.col("stream").alias("_stream"), "main")
    joined = rows.join(known, ["_host", "_stream"], "left")
    main = F.coalesce("main", "_page.own")
    kept = F.filter(F.col("_page.texts"), lambda text, at: F.array_contains(main, F.get("_page.slots", at)))
    return joined.select(id_col, url, F.array_join(kept, "\n\n").alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))


def main_text(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The main text of every page. Wrappers are written first, so that Spark knows their size when it joins."""
    path = shared_folder(pages.sparkSession, "wrappers")
    infer_wrappers(pages, url, html).write.parquet(path)
    return extract(pages, pages.sparkSession.read.parquet(path), id_col, url, html)
