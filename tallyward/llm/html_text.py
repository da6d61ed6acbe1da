"""Main text of web pages, by a consensus of each host's pages.

First pass: every page is cut into text blocks, and the containers around them (body, main,
article, section, div, ...) are scored by the text they hold, less their links. A container is named
by its tag-class path with digits generalised, and the page votes for its best. Spark counts, per
host and path, the votes and the pages that have the path; a path wins where most of them vote for
it. Second pass: of its own paths a page takes the best supported winner, and its text is the blocks
inside. Layouts of a mixed host win each among its own pages; a page without a winner takes its own
best container, and the body or the page as a whole only where that is its own best.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are
left out by tag, role, class or id wherever they stand, inside the container too.

Edge cases: null and empty html give an empty text, as does a page of nothing but left-out parts; a
page without a host (or url) votes and is extracted with all others without one; repeated rows each
vote and each get a row. Markup may break off anywhere. An empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.context import cut_lineage

#: A path wins on a host if it gets this share of the pages that have it, and of all the host's pages at least one in ``ONE_IN``.
SUPPORT, ONE_IN = 0.5, 200
#: Largest set of winners sent to every task, salts beyond.
BROADCAST_BYTES, SALTS = 4 << 20, 16

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp noembed noframes".split())
DROPPED_TAGS = RAW | set("head nav header footer aside form button select datalist dialog menu object svg canvas audio video map".split())
DROPPED_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert status form menu menubar toolbar".split())
DROPPED_NAMES = set(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar sidebars aside widget widgets ad ads adv advert adverts "
    "advertisement advertisements advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments commentlist disqus "
    "respond reply replies form search pagination pager toolbar copyright hidden".split()
)
COMMENT_NAMES = set("comment comments commentlist disqus respond reply replies".split())
GOOD_NAMES = set("article content post entry story main text body prose".split())
CONTAINERS = set("body main article section div td center blockquote".split())
BLOCKS = CONTAINERS | set(
    "html p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre table caption thead tbody tfoot tr hr address figure figcaption details summary fieldset legend hgroup th".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: A start tag closes these when they are the open element it may not be inside of; the search stops at the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
CELL = {"td", "th", "table"}

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.DOTALL)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
DIGITS = re.compile(r"\d+")
NOT_A_NAME = re.compile(r"\b(?:has|with|no|without|not|is)-", re.IGNORECASE)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)} if text and not text.isspace() else {}


def _names(attributes: dict[str, str]) -> set[str]:
    words = [w for w in f"{attributes.get('class', '')} {attributes.get('id', '')}".split() if not NOT_A_NAME.match(w)]
    return {n.lower() for w in words for n in NAME.findall(w)}


def _left_out(tag: str, attributes: dict[str, str], names: set[str]) -> bool:
    if tag in DROPPED_TAGS:
        return True
    if tag in ("html", "body"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return True
    if attributes.get("role", "").lower() in DROPPED_ROLES:
        return True
    if tag in ("main", "article"):
        return bool(names & COMMENT_NAMES)
    return bool(names & DROPPED_NAMES) and tag not in HEADINGS


class Page:
    """Blocks of a page: text, characters inside links, and the path of the innermost container.

    A path is the chain of tags and generalised classes down to a container. It is kept as its parent's number and a hash of the
    whole chain, so a page takes memory in proportion to its length, however deep it is nested. Path 0 is the page, and
    parents have smaller numbers than children.
    """

    def __init__(self, source: str):
        self.parent, self.hash, self.depth, self.prior, self.plain = [0], [0], [0], [0.8], [True]
        self._numbers: dict[tuple[int, str], int] = {}
        self.blocks: list[tuple[str, int, int]] = []
        self._parts: list[str] = []
        self._linked = 0
        self._read(source)

    def _end_block(self, path: int) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                self.blocks.append((text, min(self._linked, len(text)), path))
            self._parts, self._linked = [], 0

    def _container(self, path: int, tag: str, attributes: dict[str, str], names: set[str]) -> int:
        name = ".".join([tag, *sorted({DIGITS.sub("#", c) for c in attributes.get("class", "").split()})])
        number = self._numbers.setdefault((path, name), len(self.parent))
        if number == len(self.parent):
            self.parent.append(path)
            self.hash.append(xxhash.xxh64_intdigest(f"{self.hash[path]}>{name}") - (1 << 63))
            self.depth.append(self.depth[path] + 1)
            self.prior.append({"article": 1.35, "main": 1.25, "body": 0.8}.get(tag, 1.15 if names & GOOD_NAMES or attributes.get("role") == "main" else 1.0))
            self.plain.append(tag == "body" and self.plain[path])
        return number

    def _read(self, source: str) -> None:
        # An open element: tag, path of its content, whether it is left out, whether it is in a link.
        stack: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]
        at, size, opened = 0, len(source), Counter()

        def pop(depth: int) -> None:
            for element in reversed(stack[depth:]):
                opened[element[0]] -= 1
                if element[0] in BLOCKS:
                    self._end_block(element[1])
            del stack[depth:]

        while at < size:
            m = TAG.search(source, at)
            start = m.start() if m else size
            _, path, out, linked = stack[-1]
            if start > at and not out:
                text = source[at:start]
                if not m and (cut := re.search(r"<(?=[a-zA-Z/!?])", text)):
                    text = text[: cut.start()]  # a tag that breaks off
                if "&" in text:
                    text = entities.unescape(text)
                self._parts.append(text)
                if linked:
                    self._linked += len(text.strip())
            if not m:
                break
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                if opened[tag]:
                    self._close(stack, tag, pop)
                continue
            if tag in VOID:
                if not out:
                    if tag == "hr":
                        self._end_block(path)
                    else:
                        self._parts.append(" " if tag == "br" else "")
                continue
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.IGNORECASE).search(source, at)
                at = end.end() if end else size
                continue
            if tag == "body" or tag == "html":
                if opened[tag]:
                    continue
                if tag == "body" and opened["head"]:  # ends an unclosed head
                    depth = next((i for i, e in enumerate(stack) if e[0] == "head"), None)
                    if depth:
                        pop(depth)
            if tag in BLOCKS or tag in DROPPED_TAGS:
                self._open_block(stack, tag, pop, opened)
            _, path, out, linked = stack[-1]
            attributes = _attributes(m[3] or m[6] or "")
            names = _names(attributes) if "class" in attributes or "id" in attributes else set()
            out = out or _left_out(tag, attributes, names)
            if tag in BLOCKS:
                self._end_block(path)
            inner = self._container(path, tag, attributes, names) if tag in CONTAINERS and not out else path
            if not (m[3] or "").endswith("/") or tag in BLOCKS:
                stack.append((tag, inner, out, linked or tag == "a"))
                opened[tag] += 1
        pop(1)
        self._end_block(0)

    @staticmethod
    def _open_block(stack: list, tag: str, pop, opened: Counter) -> None:
        """A block ends an open paragraph; list items, cells and rows end their siblings."""
        for i in range(len(stack) - 1, 0, -1) if opened["p"] else ():
            if stack[i][0] == "p":
                pop(i)
                break
            if stack[i][0] in BLOCKS:
                break
        if tag in CLOSES:
            closed, stop = CLOSES[tag]
            for i in range(len(stack) - 1, 0, -1) if any(opened[t] for t in closed) else ():
                if stack[i][0] in closed:
                    pop(i)
                    break
                if stack[i][0] in stop:
                    break

    @staticmethod
    def _close(stack: list, tag: str, pop) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == tag:
                pop(i)
                return
            if stack[i][0] in CELL and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html", "article", "main"):
                return

    def scores(self) -> list[float]:
        """What is inside each path, links counting against it, times the prior of its tag and names; 0 without text."""
        total = [0.0] * len(self.parent)
        for text, linked, path in self.blocks:
            total[path] += max(0, len(text) - 3 * linked)
        for path in range(len(total) - 1, 0, -1):
            total[self.parent[path]] += total[path]
        return [t * p for t, p in zip(total, self.prior)]

    def best(self, scores: list[float]) -> int:
        """The path with the highest score; of equals the deepest."""
        return max(range(len(scores)), key=lambda n: (scores[n], self.depth[n], -n))

    def text(self, winners: dict[int, float]) -> str:
        """The blocks inside the chosen path. ``winners`` has the support that paths have on the host: of its own paths the page
        takes the best supported, of equals the deepest; where none of them wins, its own best. The page as a whole and its
        body never win, so a page is read as a whole only where that is its own best."""
        if not self.blocks:
            return ""
        scores = self.scores()
        mine = [(winners[h], self.depth[n], -n) for n, h in enumerate(self.hash) if scores[n] > 0 and h in winners]
        chosen = -max(mine)[2] if mine else self.best(scores) if max(scores) > 0 else 0
        inside = [n == chosen for n in range(len(scores))]
        for n in range(chosen + 1, len(inside)):
            inside[n] = inside[n] or inside[self.parent[n]]
        return "\n\n".join(text for text, _, path in self.blocks if inside[path])


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without user and port; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each host and path, the pages that vote for the path, and the pages that have it with text. Path 0 counts a host's pages."""
    for batch in batches:
        votes: Counter = Counter()
        seen: Counter = Counter()
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1)):
            page = Page(source.as_py() or "")
            scores = page.scores()
            seen[host, 0] += 1
            if max(scores) <= 0:
                continue
            best = page.best(scores)
            if not page.plain[best]:
                votes[host, page.hash[best]] += 1
            seen.update((host, h) for h, score, plain in zip(page.hash, scores, page.plain) if score > 0 and not plain)
        keys = list(seen)
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), pa.array([votes[k] for k in keys], pa.int64()), pa.array(list(seen.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["host", "path", "votes", "seen"])


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, paths): each host's winning paths with their support, the share of the pages having the path that vote for it.

    One page more is counted than there is, so that a path of a few pages does not outdo one that many agree on. A path that
    one page in ``ONE_IN`` votes for is not needed to win where each of its pages decides for itself, which bounds a host's winners.
    """
    counted = (
        pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(_vote, "host string, path long, votes long, seen long")
        .groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("seen").alias("seen"))
    )
    support = F.col("votes") / (F.col("seen") + 1)
    whole = F.max(F.when(F.col("path") == 0, F.col("seen"))).alias("pages")
    # Paths without enough support go before the host's size is known, so that a host gathers little more than its winners.
    listed = counted.filter((F.col("path") == 0) | (support >= SUPPORT) & (F.col("votes") > 1))
    sizes = listed.groupBy("host").agg(whole)
    return (
        listed.filter("path <> 0").withColumn("support", support).join(sizes, "host").filter(F.col("votes") * ONE_IN >= F.col("pages"))
        .groupBy("host").agg(F.array_sort(F.collect_list(F.struct("path", "support"))).alias("paths"))
    )


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    winners = cut_lineage(winning_paths(pages))
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    size = winners.agg(F.sum(F.length("host") + 16 * F.size("paths") + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        joined = rows.join(F.broadcast(winners), "host", "left")
    else:  # too large to send around: a host's pages are spread over salts, its winners repeated for each
        salted = winners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")
    id_type = pages.schema["page_id"].dataType.simpleString()

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, texts = (None, {}), []
            for source, listed in zip(batch.column(2), batch.column(3)):
                if known[0] is None or not listed.equals(known[0]):  # neighbours are often of one host
                    known = (listed, {w["path"]: w["support"] for w in listed.as_py() or ()})
                texts.append(Page(source.as_py() or "").text(known[1]))
            counts = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), counts], ["page_id", "url", "text", "n_chars"])

    return joined.select("page_id", "url", "html", "paths").mapInArrow(extract, f"page_id {id_type}, url string, text string, n_chars long")
