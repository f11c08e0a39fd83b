"""Main text of web pages: marked-up structure, and text that a host repeats from page to page.

The token streams of a host's pages, put one after the other, have a suffix array in which equal
runs stand together. Prefix doubling names every suffix by its first 2, 4, 8 and ``LONG`` tokens, a
name being made from the pair of names of half its length, with the host in it; equal names are the
neighbours of the array, and a token lies in a repeated run of ``LONG`` tokens or more exactly if it
lies in a repeated one of ``LONG``. Most text is unique, so the last doubling is left to suffixes
whose anchor, the least of the names of ``RUN`` tokens in the run, already occurs on several pages:
equal runs have equal anchors, so none is missed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Step, ship_code
from .url_rules import url_host

# Tokens of the names that anchors are chosen from, a power of two, and of a repeated run.
RUN = 8
LONG = 2 * RUN

# Distinct pages of a host that must hold a run: any two where no element marks the article; most
# pages of the host inside a marked article, where passages may well be quoted, and for blocks of
# less than ``LONG`` tokens, which are compared as a whole and may be equal by chance.
LEAST_OUTSIDE, LEAST_INSIDE, SHARE_INSIDE = 2, 3, 0.5

# A block goes if this share of its tokens is in repeated runs.
COVERED = 0.8

# A page is a copy of others, and keeps all its blocks, if less than one part in so many would be
# left of it. Outside of marked articles a host's text can well be most of a page.
PARTS_MARKED, PARTS_OUTSIDE = 2, 10

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section"
    " summary table tbody td tfoot th thead tr ul".split()
)
SKIPPED = frozenset(
    "head script style noscript template nav footer aside form iframe svg math canvas object"
    " button select textarea dialog audio video menu".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu"
    " menubar toolbar".split()
)
# Words in class names and ids that say what an element is for, whatever stands beside them.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo sidebar navbar nav"
    " navigation breadcrumb breadcrumbs footer masthead comment comments commentlist disqus cookie"
    " cookies gdpr newsletter pagination".split()
)
# Words that do so alone or beside words of layout, but not in names such as share-price.
WEAK_HINTS = frozenset(
    "banner promotion menu reply replies respond consent notice notices alert popup modal overlay"
    " subscribe subscription share sharing social related recommended teaser widget toolbar pager"
    " login signup search skip".split()
)
LAYOUT = frozenset(
    "area articles bar block body bottom box button buttons container content form icons inner item"
    " items left link links list main message outer page panel post posts right row section site"
    " small large tools top user widget wrap wrapper".split()
)
# Weak hints that parts of an article may be called by.
TOPICS = frozenset(["search", "skip"])
# What an element of the page's frame may be called after without being it.
FRAME = frozenset(["html", "body", "main"])
ARTICLE_HINTS = frozenset(
    "ad ads advert advertisement sponsored comment comments reply related teaser promo".split()
)
# Elements that end an open paragraph, and lists whose items end one another.
CLOSES_P = BLOCK - frozenset(["body", "html", "td", "th", "tr", "caption", "legend", "summary"])
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}

_NOT_WORD = re.compile("[^a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def _is_boilerplate(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool:
    if tag in SKIPPED:
        return True
    given = {k: v or "" for k, v in attrs}
    if "hidden" in given or _HIDDEN.search(given.get("style", "").lower()):
        return True
    if tag in FRAME:
        return False
    if given.get("role", "").lower() in ROLES:
        return True
    if tag == "header" and not in_article:
        return True
    named = f"{given.get('class', '')} {given.get('id', '')}".lower().split()
    names = [{w for w in _NOT_WORD.split(n) if w} for n in named]
    words = set().union(*names)
    if tag == "article":
        return not words.isdisjoint(ARTICLE_HINTS)
    if not words.isdisjoint(HINTS) or (not in_article and "header" in words):
        return True
    weak = WEAK_HINTS - TOPICS if in_article else WEAK_HINTS
    return any(n & weak and n <= WEAK_HINTS | LAYOUT for n in names)


class _Blocks(HTMLParser):
    """Blocks of text outside boilerplate elements, with the container each stands in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, str]] = []
        self.open: list[tuple[str, bool, str]] = []  # tag, in boilerplate, container
        self.parts: list[str] = []

    def _state(self) -> tuple[bool, str]:
        return self.open[-1][1:] if self.open else (False, "")

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts.clear()
        if text:
            self.blocks.append((text, self._state()[1]))

    def _close(self, at: int) -> None:
        self._flush()
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.handle_data(" ")
        if tag in BLOCK:
            self._flush()
        if tag in VOID:
            return
        self._close_implied(tag)
        skipped, container = self._state()
        if not skipped:
            skipped = _is_boilerplate(tag, attrs, container == "article")
        if not skipped:
            if tag == "article":
                container = "article"
            elif tag == "main" or ("role", "main") in attrs:
                container = container or "main"
        self.open.append((tag, skipped, container))

    def _close_implied(self, tag: str) -> None:
        if tag == "body":
            # A head that was not closed ends here.
            at = next((i for i, e in enumerate(self.open) if e[0] == "head"), None)
            if at is not None:
                self._close(at)
        peers, roots = SIBLINGS.get(tag, (set(), set()))
        if tag in CLOSES_P:
            peers = peers | {"p"}
            roots = roots | (BLOCK - {"p"} - peers)
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name in roots:
                return
            if name in peers:
                self._close(at)
                return

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                if tag in BLOCK:
                    self._close(at)
                elif self.open[at][1]:
                    del self.open[at:]
                else:
                    del self.open[at]
                return

    def handle_data(self, data: str) -> None:
        if not self._state()[0]:
            self.parts.append(data)


def text_blocks(html: str | None) -> tuple[list[str], bool]:
    """Blocks that may be main text, and whether an element marks them as the article."""
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    parser._flush()
    for container in ("article", "main"):
        found = [text for text, place in parser.blocks if place == container]
        if found:
            return found, True
    return [text for text, _ in parser.blocks], False


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mixed(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    x = (a ^ (b >> np.uint64(31))) * _FACTOR + b
    return x ^ (x >> np.uint64(29))


class _Stream:
    """Tokens of a page's blocks, one after the other, with names of what a host may repeat."""

    def __init__(self, host: str, blocks: list[str]) -> None:
        import xxhash

        tokens = [b.split() for b in blocks]
        self.seed = np.uint64(xxhash.xxh64_intdigest(host))
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        names = np.array([xxhash.xxh64_intdigest(t) for b in tokens for t in b], np.uint64)
        length = 1
        while length < RUN and len(names) > length:
            names = _mixed(names[:-length], names[length:])
            length *= 2
        # Names of RUN tokens; the last bit tells runs from whole blocks.
        self.names = _mixed(names, self.seed) & ~np.uint64(1) if length == RUN else names[:0]
        self.short = np.flatnonzero(self.sizes < LONG)
        whole = [xxhash.xxh64_intdigest(blocks[i], 1) for i in self.short]
        self.whole = _mixed(np.array(whole, np.uint64), self.seed) | np.uint64(1)

    def anchors(self) -> np.ndarray:
        """For each run of LONG tokens the place of its anchor, the first of its least names."""
        width = LONG - RUN + 1
        if len(self.names) < width:
            return np.zeros(0, np.int64)
        windows = np.lib.stride_tricks.sliding_window_view(self.names, width)
        return windows.argmin(axis=1) + np.arange(len(windows))

    def first_names(self) -> np.ndarray:
        """Anchors and short blocks, each once."""
        return np.unique(np.concatenate([self.names[np.unique(self.anchors())], self.whole]))

    def runs(self) -> np.ndarray:
        """Names of the runs of LONG tokens, by where they begin."""
        return _mixed(self.names[:-RUN], self.names[RUN:]) & ~np.uint64(1)

    def kept(self, repeated: np.ndarray, marked: bool) -> np.ndarray:
        """Which blocks stay if runs and short blocks of these names are the host's."""
        here = np.zeros(self.sizes.sum() + 1, np.int64)
        begins = np.flatnonzero(np.isin(self.runs(), repeated))
        np.add.at(here, begins, 1)
        np.add.at(here, begins + LONG, -1)
        covered = np.concatenate([[0], np.cumsum(np.cumsum(here[:-1]) > 0)])
        stops = np.cumsum(self.sizes)
        inside = covered[stops] - covered[stops - self.sizes]
        kept = inside < COVERED * self.sizes
        kept[self.short[np.isin(self.whole, repeated)]] = False
        parts = PARTS_MARKED if marked else PARTS_OUTSIDE
        if parts * self.sizes[kept].sum() < self.sizes.sum():
            kept[:] = True
        return kept


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [text_blocks(html.as_py()) for html in batch["html"]]
        yield pa.RecordBatch.from_arrays(
            [
                batch["row"],
                batch["host"],
                pa.array([b for b, _ in found], pa.list_(pa.string())),
                pa.array([marked for _, marked in found], pa.bool_()),
            ],
            ["row", "host", "blocks", "marked"],
        )


def _spread(batch: pa.RecordBatch, columns: list[str], names: list[np.ndarray]) -> pa.RecordBatch:
    """A row per name of a page, with the given columns of the page."""
    at = pa.array(np.repeat(np.arange(len(names)), [len(n) for n in names]).astype(np.int64))
    flat = np.concatenate([np.zeros(0, np.uint64), *names]).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [*(batch[c].take(at) for c in columns), pa.array(flat)], [*columns, "name"]
    )


def _streams(batch: pa.RecordBatch) -> Iterator[_Stream]:
    return map(_Stream, batch["host"].to_pylist(), batch["blocks"].to_pylist())


def _given_names(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.array(n, np.int64).view(np.uint64) for n in batch["names"].to_pylist()]


def _anchored(pages: DataFrame) -> DataFrame:
    """(page, site, marked, name) of anchors and short blocks."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [s.first_names() for s in _streams(batch)]
            yield _spread(batch, ["page", "site", "marked"], names)

    return pages.mapInArrow(named, "page long, site long, marked boolean, name long")


def _doubled(pages: DataFrame) -> DataFrame:
    """(page, site, marked, name) of the long runs whose anchor is among the page's ``names``."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for stream, names in zip(_streams(batch), _given_names(batch), strict=True):
                at = stream.anchors()
                likely = np.isin(stream.names[at], names)
                found.append(np.unique(stream.runs()[likely]) if len(at) else stream.names[:0])
            yield _spread(batch, ["page", "site", "marked"], found)

    return pages.mapInArrow(named, "page long, site long, marked boolean, name long")


def _judged(pages: DataFrame) -> DataFrame:
    """(page, kept): for each block whether it stays, its page's ``names`` being the host's."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = zip(_streams(batch), _given_names(batch), batch["marked"].to_pylist(), strict=True)
            kept = [stream.kept(names, marked).tolist() for stream, names, marked in parts]
            yield pa.RecordBatch.from_arrays(
                [batch["page"], pa.array(kept, pa.list_(pa.bool_()))], ["page", "kept"]
            )

    return pages.mapInArrow(judged, "page long, kept array<boolean>")


def _repeated(named: DataFrame, sites: DataFrame) -> DataFrame:
    """(name, inside) of what several pages of a host hold; each page has a name once.

    ``inside``: whether most of them do. What is not, and only marked articles have, or is a short
    block, is no boilerplate anywhere.
    """
    counts = named.groupBy("site", "name").agg(
        F.count("*").alias("n"), F.every("marked").alias("all_marked")
    )
    most = F.greatest(F.lit(LEAST_INSIDE), F.ceil(F.col("n_pages") * SHARE_INSIDE))
    inside = F.col("n") >= most
    outside = ~F.col("all_marked") & ~_is_block("name")
    found = counts.where(F.col("n") >= LEAST_OUTSIDE).join(sites, "site").where(inside | outside)
    return found.select("name", inside.alias("inside"))


def _is_block(name: str) -> Column:
    return F.col(name).bitwiseAND(F.lit(1)) == 1


def repeated_on_pages(parsed: DataFrame) -> DataFrame:
    """(page, names): runs and short blocks of a page that its host repeats, if there are any."""
    # Copies of a page say nothing about what its host repeats: one of them counts.
    halves = [F.xxhash64(F.lit(n), "blocks") for n in (0, 1)]
    marks = parsed.select("page", F.struct("host", *halves).alias("mark"))
    first = marks.groupBy("mark").agg(F.count("*").alias("n"), F.min("page").alias("first"))
    later = marks.join(first.where("n > 1"), "mark").where(F.col("page") != F.col("first"))
    later = Step(later.select("page"), "copies").df
    distinct = parsed.join(later, "page", "left_anti")
    sites = Step(distinct.groupBy("site").agg(F.count("*").alias("n_pages")), "sites").df
    first_names = Step(_repeated(_anchored(distinct), sites), "anchors")
    anchored = _anchored(parsed).join(first_names.df.select("name"), "name")
    anchored = anchored.groupBy("page").agg(F.collect_list("name").alias("names"))
    anchored = Step(anchored, "anchored")
    first_names.drop()
    runs = Step(_doubled(parsed.join(anchored.df, "page")), "runs")
    long = runs.df.join(_repeated(runs.df.join(later, "page", "left_anti"), sites), "name")
    long = long.where(F.col("inside") | ~F.col("marked")).select("page", "name")
    short = anchored.df.select("page", F.explode("names").alias("name")).where(_is_block("name"))
    names = long.unionByName(short).groupBy("page").agg(F.collect_list("name").alias("names"))
    found = Step(names, "repeated").df
    anchored.drop()
    runs.drop()
    return found


def main_text(pages: DataFrame) -> DataFrame:
    """(row, text, n_removed) for each page; ``row`` is the page as given, without ``html``.

    ``text`` are the blocks of main text in page order, joined by empty lines, empty if there are
    none; ``n_removed`` counts the blocks that went because the host repeats them. Blocks come
    from the elements marked as article, else as main, else from the whole page, without menus,
    headers, footers, asides, forms, scripts, hidden elements and those whose class, id or role
    says advert, notice, comment or the like. Character references are decoded, white space in a
    block is one space. Where repeated blocks make up most of a marked article, or nearly all of
    another page, the page is a copy, and nothing goes. A NULL page is empty; pages without a host
    count as one host's; pages of a host with the same blocks count as one, in ties any of them.
    Repeated rows give a row each. Columns may have any names.

    Pages are parsed once and kept as blocks in the scratch folder. Names of runs are counted by
    host in a shuffle that combines them first; a host of any size spreads over all tasks. Only
    pages that share an anchor with enough others are looked at again.
    """
    ship_code(pages.sparkSession)
    kept = [F.col(f"`{c}`") for c in pages.columns if c != "html"]
    rows = pages.select(F.struct(*kept).alias("row"), url_host(F.col("url")).alias("host"), "html")
    schema = (
        T.StructType([rows.schema["row"], rows.schema["host"]])
        .add("blocks", T.ArrayType(T.StringType()))
        .add("marked", T.BooleanType())
    )
    parsed = rows.mapInArrow(_parsed, schema)
    parsed = Step(parsed.withColumn("page", F.monotonically_increasing_id()), "blocks").df
    streams = parsed.select("page", "host", F.xxhash64("host").alias("site"), "blocks", "marked")
    judged = Step(_judged(streams.join(repeated_on_pages(streams), "page")), "judged").df
    whole = parsed.join(judged, "page", "left")
    left = F.filter("blocks", lambda _, i: F.coalesce(F.get("kept", i), F.lit(True)))
    return whole.select(
        "row",
        F.array_join(left, "\n\n").alias("text"),
        (F.size("blocks") - F.size(left)).alias("n_removed"),
    )
