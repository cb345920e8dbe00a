"""HTML extraction with a suffix array per host.

A page becomes blocks of text, each inside the article, inside page furniture
(by tag, role, class or id), or neither. The token streams of a host's pages
are concatenated and sorted as suffixes; long substrings that stand on several
distinct pages and mostly outside articles are boilerplate. Furniture goes; of
text that the page does not mark as its article, boilerplate goes and unique
runs stay. A host with many pages is split by
bytes into slices that fit a task; what their suffix arrays cannot decide alone
is counted over all slices of the host.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelweave.llm.tokens import mix
from modelweave.plans.workspace import store

GROUP_BYTES = 4 << 20  # of html per group of a host
HOT_HOSTS = 100_000  # broadcast while fewer hosts than this are split
LEAST = 8  # tokens of a repeated substring
DEPTH = 64  # tokens by which suffixes are sorted
PAGES = 3  # distinct pages a boilerplate substring stands on, at least

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<more>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<more2>[^>]*+)>|<[!?/][^>]*+>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_PARTS = re.compile(r"[a-z0-9]+")
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"

# fixed values: elements and names of HTML
_RAW = frozenset("script style template textarea noscript title iframe svg math object canvas".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_ITEMS = frozenset("li dt dd tr td th option".split())
_FURNITURE = frozenset("head nav footer aside form button select dialog menu fieldset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar sidenav cookie cookies consent gdpr notice banner ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo promotion newsletter subscribe subscription signup login social share sharing related recommended recommendations comment comments "
    "discussion reply replies disqus respond popup modal overlay pagination pager skip toolbar widget".split()
)
_ARTICLE_NAMES = frozenset("article articlebody post entry story maintext".split())


def _inside(name: str, more: str, before: int) -> int:
    """0 outside, 1 in the article, 2 in furniture; furniture holds all that is inside it."""
    if before == 2:
        return 2
    if name in _FURNITURE or (name == "header" and before != 1):
        return 2
    kind = 1 if name in ("article", "main") else before
    if more:
        for m in _ATTRIBUTE.finditer(more):
            key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
            if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
                return 2
            if key == "role":
                if value in _ROLES:
                    return 2
                kind = 1 if value in ("main", "article") else kind
            elif key == "itemprop":
                kind = 1 if value == "articlebody" else kind
            elif key in ("class", "id") and name not in ("html", "body", "article", "main"):
                parts = set(_PARTS.findall(value))
                if parts & _NAMES or (before != 1 and "header" in parts):
                    return 2
                kind = 1 if parts & _ARTICLE_NAMES else kind
    return kind


def blocks_of(page: str, to_article: bool = False) -> list[tuple[str, int, float]]:
    """(text, place, share of link text) of each block in page order; place as in ``_inside``.

    ``to_article`` ends with the first block of an article.
    """
    out: list[tuple[str, int, float]] = []
    text: list[str] = []
    links = 0
    stack: list[tuple[str, int]] = []
    place, in_link, at, size = 0, 0, 0, len(page)

    def put(piece: str) -> None:
        nonlocal links
        if piece:
            text.append(piece)
            if in_link:
                links += len(piece)

    def close() -> None:
        nonlocal links
        if text:
            whole = html.unescape("".join(text))
            joined = " ".join(whole.split())
            if joined:
                out.append((joined, place, min(1.0, links / max(len(whole), 1))))
            text.clear()
        links = 0

    while at < size:
        if to_article and out and out[-1][1] == 1:
            return out
        m = _TAG.search(page, at)
        if m is None:
            put(page[at:])
            break
        put(page[at : m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        if m["end"] or m["end2"]:
            if name not in _INLINE:
                close()
            if name == "a":
                in_link = max(0, in_link - 1)
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            after = stack[-1][1] if stack else 0
            if after != place:
                close()
                place = after
            continue
        if name in _RAW:
            end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            if name not in _INLINE:
                close()
            at = size if end is None else page.find(">", end.start()) + 1 or size
            continue
        if name == "br":
            text.append(" ")
            continue
        if name not in _INLINE:
            close()
        if name in _VOID:
            continue
        if name == "a":
            in_link += 1
        if name not in _INLINE:
            # a block ends an open paragraph, an item an open item of its kind, and what is inline in them
            cut, i = len(stack), len(stack) - 1
            while i >= 0 and (stack[i][0] in _INLINE or stack[i][0] == "p" or (name in _ITEMS and stack[i][0] == name)):
                if stack[i][0] not in _INLINE:
                    cut = i
                i -= 1
            del stack[cut:]
            place = stack[-1][1] if stack else 0
        kind = _inside(name, m["more"] or m["more2"] or "", place)
        if kind != place:
            close()
        place = kind
        stack.append((name, kind))
    close()
    return out


def suffix_order(tokens: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``depth`` tokens, and how many of these each shares with the one before."""
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    levels, span = [rank], 1
    while span < depth and n:
        ahead = np.full(n, -1, np.int64)
        ahead[: n - span] = rank[span:] if span < n else 0
        both = rank * (n + 1) + ahead + 1
        rank = np.unique(both, return_inverse=True)[1].astype(np.int64)
        levels.append(rank)
        span *= 2
        if rank.max() == n - 1:
            break
    order = np.argsort(rank, kind="stable")
    shared = np.zeros(n, np.int64)
    if n > 1:
        left, right = order[:-1].copy(), order[1:].copy()
        got = np.zeros(n - 1, np.int64)
        for level in range(len(levels) - 1, -1, -1):
            ok = (left < n) & (right < n)
            equal = np.zeros(n - 1, bool)
            equal[ok] = levels[level][left[ok]] == levels[level][right[ok]]
            got += equal * (1 << level)
            left, right = left + equal * (1 << level), right + equal * (1 << level)
        shared[1:] = got
    return order, shared


def repeated(tokens: np.ndarray, page: np.ndarray, outside: np.ndarray, least: int = LEAST, pages: int = PAGES) -> np.ndarray:
    """True for each token inside a substring of ``least`` tokens that stands on ``pages`` pages and mostly outside articles."""
    n = len(tokens)
    cover = np.zeros(n + 1, np.int64)
    if n < least:
        return np.zeros(n, bool)
    order, shared = suffix_order(tokens)
    group = np.cumsum(shared < least) - 1  # suffixes that share their first tokens stand together
    key = np.unique(group * (int(page.max()) + 1) + page[order])
    distinct = np.bincount(key // (int(page.max()) + 1), minlength=group[-1] + 1)
    beyond = np.bincount(group, outside[order], minlength=group[-1] + 1) / np.bincount(group, minlength=group[-1] + 1)
    found = order[(distinct >= pages)[group] & (beyond > 0.5)[group]]
    np.add.at(cover, found, 1)
    np.add.at(cover, np.minimum(found + least, n), -1)
    return np.cumsum(cover[:n]) > 0


class _Stream:
    """Blocks of some pages as one row of tokens; a mark of its own behind each page: no substring goes on into the next."""

    def __init__(self, pages: Iterable[str | None]) -> None:
        self.parsed = [blocks_of(p or "") for p in pages]
        self.ids: dict[str, int] = {}
        self.bounds: list[tuple[int, int]] = []
        tokens, owner, outside, asked = [], [], [], []
        for number, blocks in enumerate(self.parsed):
            has_article = _has_article(blocks)
            for text, place, links in blocks:
                begin = len(tokens)
                for w in text.split():
                    tokens.append(self.ids.setdefault(w, len(self.ids)))
                size = len(tokens) - begin
                self.bounds.append((begin, len(tokens)))
                owner += [number] * size
                outside += [place != 1] * size
                asked += [_undecided(place, links, has_article)] * size
            tokens.append(-1 - number)
            owner.append(number)
            outside.append(False)
            asked.append(False)
        self.tokens, self.owner = np.array(tokens, np.int64), np.array(owner, np.int64)
        self.outside, self.asked = np.array(outside, bool), np.array(asked, bool)

    def texts(self, gone: np.ndarray) -> list[str]:
        """Main text of each page, without the tokens that are ``gone`` from what is not its article."""
        lost = gone.tolist()
        out, at = [], 0
        for blocks in self.parsed:
            has_article = _has_article(blocks)
            kept = []
            for text, place, links in blocks:
                begin, end = self.bounds[at]
                at += 1
                undecided = _undecided(place, links, has_article)
                run = lost[begin:end] if undecided else []
                # a line of an article may also stand in an advert: what the page marks as its article stays
                if place == 1 or (undecided and not any(run)):
                    kept.append(text)
                elif undecided and not all(run):
                    # the unique runs of a block stay
                    kept.append(" ".join(w for w, g in zip(text.split(), run) if not g))
            out.append("\n".join(kept))
        return out

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the runs of LEAST tokens inside a page begin, and their hashes, which all slices of a host share."""
        code = np.array([int.from_bytes(blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest()) for w in self.ids] or [0], np.uint64)
        own = code[np.maximum(self.tokens, 0)]
        starts = np.arange(max(0, len(own) - LEAST + 1))
        last = starts + LEAST - 1
        starts = starts[(self.owner[starts] == self.owner[last]) & (self.tokens[last] >= 0)]
        h = np.zeros(len(starts), np.uint64)
        for j in range(LEAST):
            h = mix(h + own[starts + j])
        return starts, h.view(np.int64)


def _has_article(blocks: list[tuple[str, int, float]]) -> bool:
    return any(place == 1 for _, place, _ in blocks)


def _undecided(place: int, links: float, has_article: bool) -> bool:
    return place == 0 and not has_article and links <= 0.5


def main_texts(pages: Iterable[str | None]) -> list[str]:
    """Main text of each page of one host, empty where there is none."""
    stream = _Stream(pages)
    return stream.texts(repeated(stream.tokens, stream.owner, stream.outside))


def _rows(table: pa.Table, texts: list[str]) -> pa.Table:
    return pa.table({"page_id": table.column("page_id"), "url": table.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})


def _of_group(table: pa.Table) -> pa.Table:
    return _rows(table, main_texts(table.column("_html").to_pylist()))


def _asks(page: str | None) -> bool:
    """Whether the page has text that only boilerplate decides about."""
    blocks = blocks_of(page or "", to_article=True)
    has_article = _has_article(blocks)
    return any(_undecided(place, links, has_article) for _, place, links in blocks)


def _asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hosts of pages that ask."""
    known: set[str] = set()
    for batch in batches:
        for host, page in zip(batch.column(0), batch.column(1)):
            name = host.as_py()
            if name not in known and _asks(page.as_py()):
                known.add(name)
                yield pa.RecordBatch.from_arrays([pa.array([name], pa.string())], ["_asks"])


def _runs_of_slice(table: pa.Table) -> pa.Table:
    """Runs of LEAST tokens of a slice: pages, places, places outside articles, and whether a page asks about it."""
    stream = _Stream(table.column("_html").to_pylist())
    starts, run = stream.runs()
    order, shared = suffix_order(stream.tokens)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(shared < LEAST)
    first, which = np.unique(group[starts], return_index=True, return_inverse=True)[1:]
    code = run[first]
    asked = np.concatenate([[0], np.cumsum(stream.asked)])
    many = lambda x: np.bincount(which, x, minlength=len(code)).astype(np.int64)
    owners = np.unique(which * max(1, len(stream.parsed)) + stream.owner[starts]) // max(1, len(stream.parsed))
    return pa.table(
        {
            "_host": pa.array([table.column("_host")[0].as_py()] * len(code), pa.string()),
            "_part": pa.array([table.column("_part")[0].as_py()] * len(code), pa.int64()),
            "run": pa.array(code),
            "pages": pa.array(np.bincount(owners, minlength=len(code)).astype(np.int64)),
            "places": pa.array(many(np.ones(len(starts)))),
            "outside": pa.array(many(stream.outside[starts])),
            "asked": pa.array(many(asked[starts + LEAST] > asked[starts]) > 0),
        }
    )


def _of_slice(left: pa.Table, right: pa.Table) -> pa.Table:
    """Main texts of a slice, by the boilerplate runs of its whole host."""
    stream = _Stream(left.column("_html").to_pylist())
    starts, run = stream.runs()
    cover = np.zeros(len(stream.tokens) + 1, np.int64)
    found = starts[np.isin(run, right.column("run").to_numpy())]
    np.add.at(cover, found, 1)
    np.add.at(cover, found + LEAST, -1)
    return _rows(left, stream.texts(np.cumsum(cover[:-1]) > 0))


def extract_main_text(pages: DataFrame, group_bytes: int = GROUP_BYTES, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per row of ``pages``: page_id, url, text and n_chars.

    Pages meet the others of their host; a null or odd address is a host of its
    own kind, a null page has no text. Repeated rows give a row each. A host
    above ``group_bytes`` is split into slices. If any of its pages has text that
    boilerplate decides about, the runs of tokens that the suffix arrays of its
    slices find are counted over all of them, so that a host gives the same
    texts in any number of slices; a first look at the split hosts, page by page
    and as far as the article, finds these hosts.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(f"`{url}`"), _HOST, 1)), F.lit(""))
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{page}`").alias("_html"), host.alias("_host"))
    sizes = rows.groupBy("_host").agg(F.sum(F.coalesce(F.octet_length("_html"), F.lit(0)) + 64).alias("_n"))
    hot = sizes.filter(F.col("_n") > group_bytes).select(F.col("_host").alias("_hot"), F.ceil(F.col("_n") / group_bytes).alias("_parts"))
    split = hot.limit(HOT_HOSTS + 1).count()
    if split <= HOT_HOSTS:
        hot = F.broadcast(hot)
    spread = F.pmod(F.xxhash64("page_id", "url", F.length("_html")), F.coalesce("_parts", F.lit(1)))
    rows = rows.join(hot, rows["_host"] == hot["_hot"], "left").select("page_id", "url", "_html", "_host", spread.alias("_part"), F.coalesce("_parts", F.lit(1)).alias("_parts"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    place = ["_host", "_part"]
    if not split:
        return rows.drop("_parts").groupBy(*place).applyInArrow(_of_group, schema)

    asking = rows.filter("_parts > 1").select("_host", "_html").mapInArrow(_asking, "_asks string")
    hosts = store(asking.distinct(), "hosts")
    if hosts.isEmpty():
        return rows.drop("_parts").groupBy(*place).applyInArrow(_of_group, schema)
    alone = rows.join(hosts, F.col("_host") == F.col("_asks"), "left_anti").drop("_parts").groupBy(*place).applyInArrow(_of_group, schema)
    again = rows.join(hosts, F.col("_host") == F.col("_asks"), "left_semi").drop("_parts")
    runs = again.groupBy(*place).applyInArrow(_runs_of_slice, "_host string, _part long, run long, pages long, places long, outside long, asked boolean")
    runs = store(runs, "runs")
    sums = runs.groupBy("_host", "run").agg(*[F.sum(c).alias(c) for c in ("pages", "places", "outside")], F.bool_or("asked").alias("asked"))
    found = sums.filter(F.col("asked") & (F.col("pages") >= PAGES) & (2 * F.col("outside") > F.col("places"))).select("_host", "run")
    gone = runs.filter("asked").select(*place, "run").join(found, ["_host", "run"]).select(*place, "run")
    return alone.unionByName(again.groupBy(*place).cogroup(gone.groupBy(*place)).applyInArrow(_of_slice, schema))
