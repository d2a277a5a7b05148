"""Main text of web pages by nearest-URL page differencing.

A page is read into lines (blocks of text) with their zones. Pages of a host are sorted by
URL path and each is paired with its neighbour of the longest common path; the two line
sequences are aligned by longest common subsequence, and shared lines, which a template
made, are deleted. Two kinds of lines are settled by the markup before: those in menus,
headers, footers, sidebars, notices, adverts, forms, comments, scripts and the like go,
and where a page marks its article, only the lines inside are candidates, of which
differencing deletes those that are mostly links (share and related boxes); prose that
two articles share is a quotation, not a template. Without a marked article differencing
alone decides. Copies of one page say nothing about each other: pages with the same lines
are passed over, and a neighbour that has nearly all that a third page lacks is replaced
by the third.

For the pairing only hashes of lines move. Pages are range-partitioned and sorted by host
and path and read as a stream that holds ``AROUND`` differing pages on either side; those
beyond a partition's edge are added to it. So a hot host is spread evenly and every page
meets its true neighbours.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from feedlens.llm.common import materialise, read_table, text_udf, with_row_key

AROUND = 4         # differing pages that are looked at on either side
ROWS_BITS = 1 << 27        # pairs of lines up to which the rows of their comparison are kept (16 MB)
COLUMNS = 1 << 12
BROADCAST_EDGES = 100_000  # pages at the edges of parts: about 20 MB
COPY_SHARE = 0.8   # pages that share more of the lines a third page lacks are copies

# HTML element names and the usual class, id and role words of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
                  "section select summary table tbody td textarea tfoot th thead title tr ul".split())
DROPPED = frozenset("nav aside footer form script style noscript template head title iframe object svg math canvas audio video button "
                    "select option textarea menu dialog search fieldset input datalist".split())
CLOSED_BY_NEXT = frozenset("p li dt dd tr td th option".split())
SCOPES = frozenset("html body article main section div ul ol dl table blockquote aside nav header footer form".split())
FURNITURE = frozenset("ad ads adv advert adverts advertisement adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr "
                      "notice notices notification alert sidebar side sidenav menu menus nav navbar navigation topnav subnav breadcrumb "
                      "breadcrumbs footer pagefooter masthead pageheader topbar toolbar comment comments commentlist reply replies respond disqus "
                      "share sharing social related recommended newsletter subscribe subscription signup login popup modal overlay widget "
                      "widgets pagination pager skip".split())
ABOUT_LAYOUT = frozenset("has with without no".split())   # "has-sidebar" names what a layout has, not a sidebar
ARTICLE_MARKS = frozenset([("itemprop", "articlebody"), ("role", "main"), ("role", "article")])
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_TOKEN = re.compile(r"[A-Za-z]+")


class PageReader(HTMLParser):
    """Lines of a page as [text, in_article, link share], furniture left out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[list] = []
        self.open: list[tuple[str, bool, bool, bool]] = []   # (tag, dropped, in an article, in a link)
        self.parts: list[str] = []
        self.linked = 0

    def _state(self) -> tuple[bool, bool, bool]:
        return self.open[-1][1:] if self.open else (False, False, False)

    def _end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            _, article, _ = self._state()
            self.lines.append([text, article, min(1.0, self.linked / len(text))])
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSED_BY_NEXT:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == tag:
                    self._end_line()
                    del self.open[k:]
                    break
                if self.open[k][0] in SCOPES and not (tag in ("td", "th", "tr") and self.open[k][0] != "table"):
                    break
        if tag in BLOCK:
            self._end_line()
        if tag in VOID:
            return
        dropped, article, link = self._state()
        dropped = dropped or tag in DROPPED or (tag == "header" and not article) or self._furniture(tag, dict(attrs), article)
        article = article or tag in ("article", "main") or any((k, (v or "").lower()) in ARTICLE_MARKS for k, v in attrs)
        self.open.append((tag, dropped, article, link or tag == "a"))

    def _furniture(self, tag: str, attrs: dict, article: bool) -> bool:
        if tag in ("html", "body"):
            return False
        if "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attrs.get("style") or ""):
            return True
        if (attrs.get("role") or "").lower() in ROLES:
            return True
        if tag == "main":
            return False
        for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower().split():
            words = set(_TOKEN.findall(name))
            if not words & ABOUT_LAYOUT and (words & FURNITURE or "header" in words and not article):
                return True
        return False

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in VOID or tag in ("path", "use"):
            self.handle_starttag(tag, attrs)
        else:   # HTML ignores the slash of an element that isn't void
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self._end_line()
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """As browsers do: an unknown or unclosed "<![" is a comment up to the next ">"."""
        try:
            end = super().parse_marked_section(i, report)
        except AssertionError:
            end = -1
        return end if end >= 0 else self.parse_bogus_comment(i, 0)

    def handle_data(self, data: str) -> None:
        dropped, _, link = self._state()
        if not dropped:
            self.parts.append(data)
            if link:
                self.linked += len(data.strip())


def page_lines(html: str | None) -> list[tuple[str, bool]]:
    """Candidate lines of the main text in page order, and whether differencing may delete
    each. Null html has none."""
    reader = PageReader()
    reader.feed(html or "")
    reader.close()
    reader._end_line()
    if any(article for _, article, _ in reader.lines):
        return [(text, share > 0.5) for text, article, share in reader.lines if article]
    return [(text, True) for text, _, _ in reader.lines]


def _subsequence(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``, by bit-parallel rows; one
    bit of memory for every pair of lines."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    rows = [full]
    for x in a:
        v = rows[-1]
        u = v & places.get(x, 0)
        rows.append(((v + u) | (v - u)) & full)
    found: list[int] = []
    j = len(b)   # a zero bit j of rows[i] marks that the length grows at b[j]
    for i in range(len(a), 0, -1):
        while j and rows[i] >> (j - 1) & 1:
            j -= 1
        if not j:
            break
        if rows[i - 1] >> (j - 1) & 1:
            if b[j - 1] == a[i - 1]:
                found.append(i - 1)
                j -= 1
    return found[::-1]


def common_lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with b[:j], for each j: the last of the
    bit-parallel rows alone, ``COLUMNS`` bits at a time, with the carries that pass between."""
    carry = bytearray(len(a))
    steps = []
    for first in range(0, len(b), COLUMNS):
        part = b[first:first + COLUMNS]
        places: dict[int, int] = {}
        for j, x in enumerate(part):
            places[x] = places.get(x, 0) | 1 << j
        full = (1 << len(part)) - 1
        v, get = full, places.get
        for i, x in enumerate(a):
            match = get(x, 0)
            if match or carry[i]:
                u = v & match
                total = v + u + carry[i]
                carry[i] = total >> len(part)
                v = (total & full) | (v - u)
        bits = np.frombuffer(v.to_bytes((len(part) + 7) // 8, "little"), np.uint8)
        steps.append(1 - np.unpackbits(bits, bitorder="little")[:len(part)].astype(np.int64))
    return np.concatenate(([0], np.cumsum(np.concatenate(steps)))) if steps else np.zeros(1, np.int64)


def _divided(a: list[int], b: list[int]) -> list[int]:
    """``_subsequence`` in memory that grows with the lines, not with their pairs: where the
    rows are too large, ``a`` is halved and ``b`` cut where the halves' lengths add up best."""
    if len(a) * len(b) <= ROWS_BITS or len(a) < 2:
        return _subsequence(a, b)
    half = len(a) // 2
    cut = int((common_lengths(a[:half], b) + common_lengths(a[half:][::-1], b[::-1])[::-1]).argmax())
    return _divided(a[:half], b[:cut]) + [half + k for k in _divided(a[half:], b[cut:])]


def shared_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    both = set(a[head:len(a) - tail]) & set(b[head:len(b) - tail])
    mine = [k for k in range(head, len(a) - tail) if a[k] in both]
    found = _divided([a[k] for k in mine], [x for x in b[head:len(b) - tail] if x in both]) if mine else []
    return [*range(head), *(mine[k] for k in found), *range(len(a) - tail, len(a))]


def _described(html: str | None) -> dict:
    lines = page_lines(html)
    return {"lines": [t for t, _ in lines], "at_risk": [r for _, r in lines],
            "hashes": [int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(t)).view(np.int64))) for t, _ in lines]}


def _common(a: Sequence, b: Sequence) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


class _Run:
    """Consecutive pages of a host that have the same lines."""

    def __init__(self, host: str, hashes: list[int], path: str):
        self.host, self.hashes, self.lines, self.first, self.last = host, hashes, set(hashes), path, path
        self.open: list[tuple[str, str]] = []   # (row, path) of pages that await their neighbours
        self.shared: dict[int, list[int]] = {}

    def deletions(self, before: list[_Run], after: list[_Run]) -> Iterator[tuple[str, list[int]]]:
        """For each open page the lines shared with its nearest differing page by URL."""
        for row, path in self.open:
            near = [(r, r.last) for r in before[-1:]] + [(r, r.first) for r in after[:1]]
            if not near:
                return
            run = max(near, key=lambda x: _common(x[1], path))[0]
            others = [(r, r.last) for r in reversed(before) if r is not run] + [(r, r.first) for r in after if r is not run]
            third = self._third(path, others)
            if third and self._copies(run, third):
                run = third
            if id(run) not in self.shared:
                shared = shared_lines(self.hashes, run.hashes)
                self.shared[id(run)] = [] if not third and len(shared) == len(self.hashes) else shared
            if self.shared[id(run)]:
                yield row, self.shared[id(run)]

    def _third(self, path: str, others: list[tuple[_Run, str]]) -> _Run | None:
        """Of the pages with the most path segments in common the one with the fewest shared lines."""
        segments = [_common(p.split("/"), path.split("/")) for _, p in others]
        level = [r for (r, _), n in zip(others, segments) if n == max(segments)]
        return min(level, key=lambda r: len(self.lines & r.lines)) if level else None

    def _copies(self, run: _Run, third: _Run) -> bool:
        mine, its = self.lines - third.lines, run.lines - third.lines
        return len(mine & its) > COPY_SHARE * max(len(mine), len(its))


def _deletions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(row, shared lines) of pages sorted by part, host, path and row."""
    runs: list[_Run] = []   # AROUND settled runs at most, then AROUND and one that wait
    settled, part = 0, None

    def settle(wanted: int) -> list[tuple[str, list[int]]]:
        nonlocal settled
        out = []
        while len(runs) - settled > wanted:
            run = runs[settled]
            out += run.deletions(runs[max(0, settled - AROUND):settled], runs[settled + 1:settled + 1 + AROUND])
            run.open, run.shared = [], {}
            settled += 1
            if settled > AROUND:
                del runs[0]
                settled -= 1
        return out

    def frame(out: list) -> pd.DataFrame:
        return pd.DataFrame(out, columns=["__doc_row", "shared"])

    for batch in batches:
        out = []
        for here, host, path, row, hashes, wanted in zip(*(batch[c] for c in ("part", "host", "path", "__doc_row", "hashes", "wanted"))):
            if runs and (here != part or host != runs[-1].host):
                out += settle(0)
                runs, settled = [], 0
            part, hashes = here, list(hashes)
            if not runs or hashes != runs[-1].hashes:
                out += settle(AROUND)
                runs.append(_Run(host, hashes, path))
            runs[-1].last = path
            if wanted:
                runs[-1].open.append((row, path))
        yield frame(out)
    yield frame(settle(0))


def _edges(ranged: DataFrame) -> DataFrame:
    """(__doc_row, part): the pages of other parts that a part's first and last pages meet.

    A part gives the last pages of its first and last AROUND + 1 runs; the parts of one host
    hand them on in order, which a task does for each host from so many rows a part."""
    order = W.partitionBy("part").orderBy("host", "path", "__doc_row")
    change = [F.coalesce((F.col("host") != f("host").over(order)) | (F.col("list") != f("list").over(order)), F.lit(True)) for f in (F.lag, F.lead)]
    whole = W.partitionBy("part")
    runs = ranged.select("part", "host", "path", "__doc_row", F.xxhash64("hashes").alias("list")).select(
        "*", change[0].alias("begins"), change[1].alias("ends"), F.min("host").over(whole).alias("low"), F.max("host").over(whole).alias("high"))
    runs = runs.withColumn("run", F.sum(F.col("begins").cast("long")).over(order)).withColumn("runs", F.max("run").over(whole))
    head = F.col("begins") & (F.col("host") == F.col("low")) & (F.col("run") <= AROUND + 1)
    tail = F.col("ends") & (F.col("host") == F.col("high")) & (F.col("run") >= F.col("runs") - AROUND)
    rows = runs.select("host", "part", "low", "high", "list", "path", "__doc_row", "run", head.alias("head"), tail.alias("tail")).filter("head OR tail")
    return rows.groupBy("host").applyInPandas(_handed_on, "__doc_row string, part int")


def _handed_on(rows: pd.DataFrame) -> pd.DataFrame:
    """``_edges`` of the parts of one host."""
    rows = rows.sort_values(["part", "run", "path", "__doc_row"])
    parts = [(part, list(group.itertuples(index=False, name=None))) for part, group in rows.groupby("part", sort=True)]
    at = {c: k for k, c in enumerate(rows.columns)}
    out = []
    for side, other, step in (("tail", "low", 1), ("head", "high", -1)):
        held: list[tuple[int, str]] = []   # runs on the way to the next part, the nearest last
        for part, here in parts[::step]:
            if here[0][at[other]] == here[0][at["host"]]:
                out += [(row, part) for _, row in held]
            for r in here[::step]:
                if r[at[side]]:
                    if held and held[-1][0] == r[at["list"]]:
                        held.pop()
                    held.append((r[at["list"]], r[at["__doc_row"]]))
            held = held[-AROUND - 1:]   # one may have the lines of the part's own first or last pages
    return pd.DataFrame(out, columns=["__doc_row", "part"]).astype({"part": "int32"})


def main_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars.

    Null or empty html, and pages without a line of main text, give an empty text. A null
    url is a page of the host without a name. A page without a differing page on
    its host keeps its candidate lines; pages without lines are nobody's neighbour. Repeated rows each get a row; an empty table none."""
    keyed = with_row_key(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
                         if {page_id, url, html} != {"page_id", "url", "html"} else pages)
    read = text_udf("lines array<string>, at_risk array<boolean>, hashes array<long>", lambda: lambda texts: [_described(t) for t in texts])
    address = F.coalesce(F.col("url"), F.lit(""))
    rest = F.regexp_extract(address, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    described = materialise(
        keyed.select("page_id", "url", "__doc_row", F.lower(F.regexp_extract(address, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)).alias("host"),
                     rest.alias("path"), read(F.col("html")).alias("r"))
        .select("page_id", "url", "__doc_row", "host", "path", "r.*"), "pages")

    light = described.filter(F.size("hashes") > 0).select("__doc_row", "host", "path", "hashes", F.exists("at_risk", lambda x: x).alias("wanted"))
    ranged = materialise(light.repartitionByRange("host", "path", "__doc_row").withColumn("part", F.spark_partition_id()), "ranged")
    edges = materialise(_edges(ranged), "edges")
    if edges.count() <= BROADCAST_EDGES:
        edges = F.broadcast(edges)
    beyond = ranged.drop("part").join(edges, "__doc_row").withColumn("wanted", F.lit(False))
    shared = (ranged.unionByName(beyond).repartition("part").sortWithinPartitions("part", "host", "path", "__doc_row")
              .mapInPandas(_deletions, "__doc_row string, shared array<int>"))

    settled = described.filter(~F.exists("at_risk", lambda x: x)).select("page_id", "url", "lines")
    open_pages = described.filter(F.exists("at_risk", lambda x: x)).join(materialise(shared, "shared"), "__doc_row", "left")
    numbered = F.transform("lines", lambda t, k: F.struct(t.alias("t"), (F.element_at("at_risk", k + 1) & F.coalesce(
        F.array_contains("shared", k), F.lit(False))).alias("gone")))
    opened = (open_pages.select("page_id", "url", numbered.alias("l"))
              .select("page_id", "url", F.transform(F.filter("l", lambda x: ~x["gone"]), lambda x: x["t"]).alias("lines")))
    text = F.array_join("lines", " ")
    return settled.unionByName(opened).select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(read_table(spark, sf_dir, "pages"))
