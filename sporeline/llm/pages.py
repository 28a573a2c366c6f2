"""Main text of web pages by consensus host paths.

First pass: each page's containers are scored by the running text in them; a container's path is its chain of tags and
classes, with digits generalised, and the page votes for the path of its best container. Spark adds up the votes per
host and path, and the path with most votes wins its host. Second pass: each page is extracted from the containers at its
host's winning path; where a page has none, or no text in them, from the container that it scores best itself. Menus,
notices, adverts, comments and the like are left out wherever they stand. In an article, a paragraph, heading, list item or
cell is left out for its classes only if one of them consists of such words alone. A form or an element left out for its
classes alone is a wrapper around the page, and stays, if it holds over half of the page's running text and what is marked
most clearly as the page's main part: an article or main element, or else a container with a class like content, or else
nothing is marked.

Votes are added up before they are shuffled, at most one row for each path of a task's hosts; winners are one row for
each host, joined with a salt so that a host with very many pages is dealt over several tasks.

Defined cases: a null or empty html has an empty text; a null url has host '' and shares that host's consensus;
repeated rows are votes of their own and are extracted alike; an empty table gives an empty result; html may be cut off
anywhere; very long and very deep pages take linear time and memory; columns other than page_id, url and html are dropped.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sporeline.llm.common import settle, table

# Elements by how they are handled.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template textarea select iframe object svg math canvas audio video title head".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("html body article main section div td center".split())
ASIDE = frozenset("nav footer aside form button menu dialog".split())
#: Elements that hold text themselves.
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dd dt figcaption caption".split())
# Words in classes, ids and roles that mark what isn't the page's main part: a choice, made by how pages are built.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion sidebar side menu nav navbar "
    "navigation breadcrumb breadcrumbs footer foot comment comments reply replies respond disqus cookie cookies consent gdpr "
    "notice notices alert popup modal overlay share sharing social related recommended recommendations newsletter subscribe "
    "subscription widget pagination pager toolbar login signup search masthead copyright legal disclaimer skip hidden "
    "contentinfo complementary dialog form".split()
)
#: What is about other parts of the page, and what readers or other pages say, however long.
MODIFIERS = frozenset("has with without no not is".split())
NEVER_MAIN = frozenset("comment comments reply replies respond disqus related recommended recommendations".split())
TOP_WORDS = frozenset("header head topbar top".split())
MAIN_WORDS = frozenset("article content post entry story main text body page".split())
ITEMS, LISTS = frozenset("li dd dt td th tr".split()), frozenset("ul ol dl table".split())

_token = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)", re.S)
_attr = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_parts = re.compile(r"[A-Z]?[a-z]+|[A-Z]+").findall
_digits = re.compile(r"\d+")
_host = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)")


def host_of(url: str | None) -> str:
    m = _host.match(url or "")
    return m[1].lower() if m else ""


class Page:
    """Blocks and containers of a page.

    containers: [step, parent, depth, bonus]; a step is a tag and class, and the steps from the root are the path.
    marks: how clearly each container is marked as the main part, and the aside that it is in; asides: [outer aside or -1, whether it may be a wrapper]; blocks: (container, text, link characters, aside or -1).
    """

    def __init__(self, source: str):
        self.containers: list[tuple[str, int, int, float]] = [("", -1, 0, 1.0)]
        self.marks: list[tuple[int, int]] = [(0, -1)]
        self.asides: list[tuple[int, bool]] = []
        self.blocks: list[tuple[int, str, int, int]] = []
        self._parse(source)
        self._unwrap()

    def _unwrap(self) -> None:
        """Blocks' asides become whether they are left out."""
        held = [0] * (len(self.asides) + 1)  # the last: what is in none
        for _, text, linked, aside in self.blocks:
            held[aside] += max(0, len(text) - 2 * linked)
        for k in range(len(self.asides) - 1, -1, -1):
            held[self.asides[k][0]] += held[k]
        within = [0.0] * len(self.containers)
        for c, text, linked, _ in self.blocks:
            within[c] += max(0, len(text) - 2 * linked)
        for k in range(len(within) - 1, 0, -1):
            within[self.containers[k][1]] += within[k]
        usable = [True] * (len(self.asides) + 1)  # no aside around is one for certain
        for k, (outer, wrapper) in enumerate(self.asides):
            usable[k] = wrapper and usable[outer]
        marked = [(mark, aside) for (mark, aside), n in zip(self.marks, within) if n > 0 and usable[aside]]
        most = max((mark for mark, _ in marked), default=0)
        has = [not most] * (len(self.asides) + 1)
        for mark, aside in marked:
            if mark == most:
                has[aside] = True
        for k in range(len(self.asides) - 1, -1, -1):
            has[self.asides[k][0]] |= has[k]
        dead = [True] * len(self.asides) + [False]
        for k, (outer, wrapper) in enumerate(self.asides):
            dead[k] = dead[outer] or not (wrapper and has[k] and 2 * held[k] > held[-1])
        self.blocks = [(c, text, linked, dead[aside]) for c, text, linked, aside in self.blocks]

    def _parse(self, s: str) -> None:
        # An open element: (tag, container, aside, in the article, in a link)
        stack: list[tuple[str, int, int, bool, bool]] = [("", 0, -1, False, False)]
        # Of the open elements: places of those at which a block's start looks, blocks by name, and inline ones by name
        # within each open block; so an end tag that closes nothing costs no search.
        marks: list[int] = []
        blocks: Counter = Counter()
        inline: list[Counter] = [Counter()]
        text: list[str] = []
        linked = 0
        at, end = 0, len(s)

        def close(k: int) -> None:
            for gone in reversed(stack[k:]):
                if gone[0] in BLOCKS:
                    inline.pop()
                    blocks[gone[0]] -= 1
                else:
                    inline[-1][gone[0]] -= 1
            del stack[k:]
            while marks and marks[-1] >= k:
                marks.pop()

        def flush() -> None:
            nonlocal linked
            if text:
                joined = " ".join("".join(text).split())
                if joined:
                    top = stack[-1]
                    self.blocks.append((top[1], joined, linked, top[2]))
                text.clear()
            linked = 0

        while at < end:
            m = _token.search(s, at)
            upto = m.start() if m else end
            if upto > at:
                piece = html.unescape(s[at:upto])
                text.append(piece)
                if stack[-1][4]:
                    linked += len(piece)
            if not m:
                break
            at = m.end()
            if not m[2]:
                continue  # a comment, a declaration or a tag cut off
            tag = m[2].lower()
            if m[1]:
                if tag in BLOCKS:
                    flush()
                if (blocks if tag in BLOCKS else inline[-1])[tag] > 0:  # an inline end tag doesn't close blocks
                    k = len(stack) - 1
                    while stack[k][0] != tag:
                        k -= 1
                    close(k)
                continue
            if tag in BLOCKS:
                flush()
                for k in reversed(marks):
                    # A paragraph ends where a block begins, a list item where the next does.
                    if stack[k][0] == "p" or (stack[k][0] == tag and tag in ITEMS):
                        close(k)
                        break
                    if stack[k][0] not in ITEMS:
                        break
            if tag in VOID:
                if tag in ("br", "hr"):
                    text.append(" ")
                continue
            if tag in RAW:
                if m[3].rstrip().endswith("/"):
                    continue
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(s, at)
                if tag == "head" and not stop:
                    continue
                at = stop.end() if stop else end
                continue
            parent = stack[-1]
            names, hidden, first, whole = self._names(m[3]) if m[3] else ((), False, "", False)
            in_article = parent[3] or tag in ("article", "main")
            never = hidden or (whole if in_article and tag in LEAVES else not NEVER_MAIN.isdisjoint(names))
            out = named = False
            if tag not in ("html", "body", "article", "main"):
                out = hidden or tag in ASIDE
                named = whole if in_article and tag in LEAVES else not ASIDE_WORDS.isdisjoint(names)
                if not in_article:
                    out = out or tag == "header"
                    named = named or not TOP_WORDS.isdisjoint(names)
            elif tag == "article":
                out = not ASIDE_WORDS.isdisjoint(names)  # a comment that is marked up as an article
            aside = parent[2]
            if out or named:
                self.asides.append((aside, not never and (tag == "form" or not out)))
                aside = len(self.asides) - 1
            container = parent[1]
            if tag in CONTAINERS:
                bonus = 1.5 if tag in ("article", "main") else 1.25 if not MAIN_WORDS.isdisjoint(names) and tag != "body" else 1.0
                step = tag + (f".{_digits.sub('#', first).replace('/', '|')}" if first else "")
                self.containers.append((step, container, self.containers[container][2] + 1, bonus))
                self.marks.append((2 if tag in ("article", "main") else 1 if bonus > 1 else 0, aside))
                container = len(self.containers) - 1
            if tag in BLOCKS:
                blocks[tag] += 1
                inline.append(Counter())
            else:
                inline[-1][tag] += 1
            if tag == "p" or tag in ITEMS or tag in CONTAINERS or tag in LISTS:
                marks.append(len(stack))
            stack.append((tag, container, aside, in_article, parent[4] or tag == "a"))
        flush()

    @staticmethod
    def _names(attributes: str) -> tuple[list[str], bool, str, bool]:
        """Words of class, id and role; whether the element isn't shown; its first class; whether a class has only words of
        asides."""
        names: list[str] = []
        out, first, whole = False, "", False
        for m in _attr.finditer(attributes):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "hidden" or (key == "aria-hidden" and value == "true"):
                out = True
            elif key == "style":
                out = out or "display:none" in value.replace(" ", "").lower()
            elif key != "aria-hidden":
                for token in value.split():
                    parts = [x.lower() for x in _parts(token)]
                    if parts and parts[0] not in MODIFIERS:  # has-sidebar is no sidebar
                        names += parts
                        whole |= key == "class" and ASIDE_WORDS.issuperset(parts)
                if key == "class" and value.split():
                    first = value.split()[0]
        return names, out, first, whole

    def scores(self) -> list[float]:
        """Of each container: its running text without links, by its kind; deeper ones win ties."""
        own = [0.0] * len(self.containers)
        for container, text, linked, out in self.blocks:
            if not out:
                own[container] += max(0, len(text) - 2 * linked)
        for k in range(len(own) - 1, 0, -1):
            own[self.containers[k][1]] += own[k]
        return [x * bonus * (1 + 0.001 * depth) for x, (_, _, depth, bonus) in zip(own, self.containers)]

    def path(self, k: int) -> str:
        steps = []
        while k > 0:
            steps.append(self.containers[k][0])
            k = self.containers[k][1]
        return "".join("/" + x for x in reversed(steps))

    def best(self) -> int:
        """The container with the best score, the deepest of equals."""
        scores = self.scores()
        return max(range(len(scores)), key=lambda k: (scores[k], k))

    def vote(self) -> str | None:
        """The path of the best container; none for a page without running text."""
        k = self.best()
        return self.path(k) if self.scores()[k] > 0 else None

    def text(self, path: str | None) -> str:
        """The text of the containers at the path, or else of the container that the page scores best."""
        found = self._within(self._at(path)) if path is not None else ""
        if not found:
            best = self.best()
            found = self._within([k == best for k in range(len(self.containers))])
        return found

    def _at(self, path: str) -> list[bool]:
        """Whether each container is at the path: its parent is at the path's beginning and its step is the next."""
        steps = path.split("/")
        on = [True]
        for step, parent, depth, _ in self.containers[1:]:
            on.append(on[parent] and depth < len(steps) and steps[depth] == step)
        return [x and c[2] == len(steps) - 1 for x, c in zip(on, self.containers)]

    def _within(self, chosen: list[bool]) -> str:
        for k in range(1, len(chosen)):
            chosen[k] = chosen[k] or chosen[self.containers[k][1]]
        return "\n\n".join(t for c, t, _, out in self.blocks if chosen[c] and not out)


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, path, votes), added up over the task's pages."""
    sums: dict[tuple[str, str], int] = {}
    for b in batches:
        for url, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            host = host_of(url)
            path = Page(source or "").vote()
            if path is not None:
                sums[host, path] = sums.get((host, path), 0) + 1
        if len(sums) > 200_000:
            yield _sums(sums)
            sums = {}
    if sums:
        yield _sums(sums)


def _sums(sums: dict) -> pa.RecordBatch:
    hosts, paths = zip(*sums)
    return pa.RecordBatch.from_arrays([pa.array(hosts), pa.array(paths), pa.array(list(sums.values()), pa.int64())], ["host", "path", "votes"])


def winners(pages: DataFrame) -> DataFrame:
    """(host, path): of each host, the path with most votes; among equals the longer path, then the first by name."""
    votes = pages.select("url", "html").mapInArrow(_vote, "host string, path string, votes long")
    totals = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    best = F.max_by(F.col("path"), F.struct("votes", F.length(F.regexp_replace("path", "[^/]", "")).alias("depth"), "path"))
    return totals.groupBy("host").agg(best.alias("path"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [Page(s).text(p) if s else "" for s, p in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"]
        )


def extract(pages: DataFrame, salts: int = 8) -> DataFrame:
    """(page_id, url, text, n_chars) of pages(page_id, url, html)."""
    won = settle(winners(pages)).select(F.col("host").alias("_h"), F.col("path"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_s"))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    rows = pages.select("page_id", "url", "html", host.alias("_host"), F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int").alias("_salt"))
    found = rows.join(won, (F.col("_host") == F.col("_h")) & (F.col("_salt") == F.col("_s")), "left")
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"
    return found.select("page_id", "url", "html", "path").mapInArrow(_extract, schema)


def op4_html_consensus(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))


QUERIES, ORACLES = {"op4_html_consensus": op4_html_consensus}, {}
