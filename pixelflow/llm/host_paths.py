"""Main text of web pages by consensus host paths.

1. Each page is read into elements; the text of its blocks (outside menus,
   forms, notices and the like; a part that only its class or id words speak
   against stays where it holds most of the page) is summed up the tree, and the page names one
   container: the path, as generalised tag-class steps, reached from the body
   by following the child that keeps most of the text, ending at an article
   or main element; without one, back out over parents whose other blocks are
   mostly article text (headings, paragraphs, sentences, few links).
2. The pages of a host vote; the path with most pages wins (ties: more text,
   then the smaller path).  Votes are summed by (host, path) before they are
   dealt, so a host with a third of all pages is no hot group.
3. Each page is read again and the blocks inside the winning path are its
   text; a page without that path uses its own container.

Blocks: character references decoded, white space made one space, trimmed,
empty ones left out, joined by two line feeds in page order.  Cut-off pages
are read as far as they go.

Nulls and edges: a null html counts as empty and gives the empty text; a null
or odd url belongs to the empty host; repeated rows are extracted each; other
columns are carried unread; an empty table gives no rows.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pixelflow.llm.common import map_batches, stored

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|(\Z))"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|(\Z))""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math select object video audio canvas".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var ruby rb rt rp wbr img br td th".split())
CONTAINERS = frozenset("body div article section main td center blockquote".split())
GOALS = frozenset(("article", "main"))
DROPPED = frozenset("nav header footer aside form button dialog menu fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Class or id words of parts that are not the article, unless they hold it.
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice "
    "notices popup modal overlay nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside footer "
    "footers masthead topbar toolbar share sharing social related recommended newsletter subscribe subscription signup "
    "login comment comments disqus respond reply replies pagination pager widget widgets skip".split())
#: Of these, words of readers' parts, which may be longer than the article.
READER_WORDS = frozenset("comment comments disqus respond reply replies".split())
#: A name with one of these at its start, or end, tells a state or a wrapper.
STATE_STARTS = frozenset("has have with without no not is hide show".split())
STATE_ENDS = frozenset("open opened closed enabled disabled container wrapper wrap inner content on off".split())
HEADER_WORDS = frozenset(("header", "site-header", "page-header"))
#: Blocks of these are article text, as are sentences elsewhere; lines that match NOTICE are not.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote".split())
SENTENCE = re.compile(r"(?:\S+ ){4,}.*[.!?\u2026][\"'\u201d\u2019)\u00bb]?\Z|.{8,}[\u3002\uff01\uff1f]\Z", re.S)
NOTICE = re.compile(r"\u00a9|\(c\) ?[12]|copyright|all rights reserved|powered by|cookies", re.I)
#: A start tag on the left ends an open element on the right.
ENDS = {"li": ("li",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd"),
        "option": ("option",)}
LISTS = frozenset(("ul", "ol", "table", "dl", "td", "div", "article", "section", "body"))


KEPT, NAMED, DROPPED_PART = 0, 1, 2


def _words(name: str) -> list[str]:
    return [w for w in re.split(r"[^a-z]+", name) if w]


def _level(tag: str, attributes: dict[str, str]) -> tuple[int, bool]:
    """KEPT, NAMED (only its class or id speaks against it) or DROPPED_PART,
    and whether it is named as a readers' part."""
    if tag in DROPPED:
        return DROPPED_PART, False
    if not attributes:
        return KEPT, False
    if (attributes.get("role", "").lower() in ROLES or attributes.get("aria-hidden", "").lower() == "true"
            or "display:none" in attributes.get("style", "").replace(" ", "").lower()):
        return DROPPED_PART, False
    if tag in ("html", "body"):
        return KEPT, False
    named = f'{attributes.get("class", "")} {attributes.get("id", "")}'.lower().split()
    found, words = False, set()
    for name in named:
        parts = _words(name)
        if len(parts) > 1 and (parts[0] in STATE_STARTS or parts[-1] in STATE_ENDS):
            continue
        words.update(parts)
        found = found or name in HEADER_WORDS
    if tag in GOALS:                                      # a single comment may be an article
        return (NAMED, True) if words & {"comment", "reply"} else (KEPT, False)
    return (NAMED, bool(words & READER_WORDS)) if found or words & DROPPED_WORDS else (KEPT, False)


def step(tag: str, attributes: dict[str, str]) -> str:
    """The generalised step of an element: tag and class words without digits."""
    words = sorted({re.sub(r"[0-9>]+", "", w) for w in attributes.get("class", "").lower().split()} - {""})
    return ".".join([tag, *words])


class Page:
    """Blocks and path tree of one page."""

    def __init__(self, html: str):
        self.paths: dict[tuple[int, str], int] = {}
        self.parent, self.steps = [-1], ["" ]          # path 0: the document
        self.kind = [""]
        self.named, self.readers, self.titled = [False], [False], [False]
        self.blocks: list[tuple[int, str, int]] = []    # (path, text, length of its link text)
        self.prose: list[bool] = []                      # of each block: in a heading or paragraph
        self._read(html)
        self._judge()

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int, int]] = [("", 0, KEPT)]      # tag, path, level (NAMED: of inline parts)
        text: list[str] = []
        plain = aside = False                            # words outside, and inside, NAMED inline parts
        links, in_link, at, n = 0, 0, 0, len(html)

        def flush():
            nonlocal links, plain, aside
            if text:
                block = " ".join(unescape("".join(text)).split())
                if block and (plain or not aside) and stack[-1][2] != DROPPED_PART:
                    self.blocks.append((stack[-1][1], block, links))
                    self.prose.append(next((x[0] for x in reversed(stack) if x[0] not in INLINE), "") in PROSE)
                text.clear()
            links, plain, aside = 0, False, False

        def pop_to(k: int):
            while len(stack) > k:
                stack.pop()

        def add(piece: str):
            nonlocal links, plain, aside
            if stack[-1][2] != DROPPED_PART:
                text.append(piece)
                if any(map(str.isalnum, piece)):
                    plain, aside = plain or stack[-1][2] == KEPT, aside or stack[-1][2] == NAMED
                if in_link:
                    links += len(piece)
        while at < n:
            m = TOKEN.search(html, at)
            if m is None:
                add(html[at:])
                break
            if m.start() > at:
                add(html[at:m.start()])
            at = m.end()
            g = 1 if m[2] else 5
            if not m[g + 1] or m[g + 3] is not None:    # comment, declaration, or a tag that never ends
                continue
            tag, closing = m[g + 1].lower(), bool(m[g])
            if closing:
                if tag == "a":
                    in_link = 0
                if tag in INLINE:
                    if tag in ("td", "th"):
                        add(" ")
                    for k in range(len(stack) - 1, max(len(stack) - 12, 0), -1):
                        if stack[k][0] == tag:
                            if any(x[0] not in INLINE for x in stack[k:]):
                                break
                            pop_to(k)
                            break
                    continue
                flush()
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        pop_to(k)
                        break
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                elif tag == "br":
                    add(" ")
                continue
            if tag in RAW:
                if not m[0].endswith("/>"):
                    end = re.compile(rf"</{re.escape(tag)}(?:\s[^>]*)?>", re.I).search(html, at)
                    at = end.end() if end else n
                continue
            attributes = {}
            if m[g + 2]:
                for a in ATTRIBUTE.finditer(m[g + 2]):
                    attributes.setdefault(a[1].lower(), unescape(a[2] or a[3] or a[4] or ""))
            if tag in INLINE and tag not in ("td", "th"):
                if tag == "a":
                    in_link = 1
                level = max(stack[-1][2], _level(tag, attributes)[0])
                if level:
                    stack.append((tag, stack[-1][1], level))
                continue
            if tag in ("td", "th"):
                add(" ")
            else:
                flush()
            for k in range(len(stack) - 1, 0, -1):        # implied ends
                if stack[k][0] == "p" and tag not in ("td", "th"):
                    pop_to(k)
                    break
                if stack[k][0] in ENDS.get(tag, ()):
                    pop_to(k)
                    break
                if stack[k][0] in LISTS:
                    break
            up, above = stack[-1][1], stack[-1][2]
            level, readers = _level(tag, attributes)
            if tag in ("td", "th"):
                stack.append((tag, up, max(above, level)))
                continue
            path = self._path(up, tag, attributes, level == NAMED, readers)
            if tag in ("h1", "main") and above != DROPPED_PART:
                self.titled[path] = True
            stack.append((tag, path, DROPPED_PART if level == DROPPED_PART else above))
        flush()

    def _path(self, up: int, tag: str, attributes: dict[str, str], named: bool, readers: bool) -> int:
        if tag not in CONTAINERS and tag != "html" and not named:
            return up                                     # not a container: its blocks are its parent's
        mark = f' #{re.sub(r"[0-9>]+", "", attributes.get("id", "").lower())}' if named else ""
        key = (up, step(tag, attributes) + mark)
        if key not in self.paths:
            self.paths[key] = len(self.parent)
            self.parent.append(up)
            self.steps.append(key[1])
            self.kind.append(tag)
            self.named.append(named)
            self.readers.append(readers)
            self.titled.append(False)
        return self.paths[key]

    def _judge(self) -> None:
        """A NAMED part that holds most of the page's text is no side part; a
        readers' part must also hold the title, or all of the text."""
        own = [0] * len(self.parent)
        for path, block, links in self.blocks:
            own[path] += max(len(block) - 2 * links, 0)
        total, titled = own[:], self.titled[:]
        for p in range(len(own) - 1, 0, -1):
            total[self.parent[p]] += total[p]
            titled[self.parent[p]] = titled[self.parent[p]] or titled[p]
        for p in range(1, len(own)):
            if self.named[p] and 2 * total[p] >= total[0] > 0 and (not self.readers[p] or titled[p] or total[p] == total[0]):
                self.named[p] = False

    def _hidden(self, top: int) -> list[bool]:
        """Per path: outside ``top`` or inside a NAMED part below it."""
        out = [True] * len(self.parent)
        out[top] = False
        for p in range(top + 1, len(out)):               # children come after their parents
            out[p] = out[self.parent[p]] or self.named[p]
        return out

    def name(self, path: int) -> str:
        out = []
        while path > 0:
            out.append(self.steps[path])
            path = self.parent[path]
        return ">".join(reversed(out))

    def find(self, name: str) -> int | None:
        """The path of that name, if the page has it."""
        at: int | None = 0
        for one in name.split(">") if name else ():
            at = self.paths.get((at, one))
            if at is None:
                return None
        return at

    def container(self) -> tuple[int, int]:
        """The page's own container and its text length without links."""
        own, hidden = [0.0] * len(self.parent), self._hidden(0)
        for path, block, links in self.blocks:
            if not hidden[path]:
                own[path] += max(len(block) - 2 * links, 0)
        total, children = own[:], [[] for _ in own]
        for p in range(len(own) - 1, 0, -1):              # children come after their parents
            total[self.parent[p]] += total[p]
            children[self.parent[p]].append(p)
        goals = [p for p in range(len(own)) if self.kind[p] in GOALS and total[p] >= 0.5 * total[0] > 0]
        if goals:
            at = min(goals, key=lambda p: (-total[p], p))
            return at, int(total[at])
        chain = [0]
        while children[chain[-1]]:
            best = max(children[chain[-1]], key=lambda p: (total[p], -p))
            if total[best] < 0.75 * total[chain[-1]]:
                break
            chain.append(best)
        at = self._outermost(chain, hidden)
        return at, int(total[at])

    def _outermost(self, chain: list[int], hidden: list[bool]) -> int:
        """Of nested paths the outermost whose blocks outside the next one are
        mostly article text, as on every level below it."""
        level = [0] * len(self.parent)                    # the last path of the chain around each path
        for k, p in enumerate(chain):
            level[p] = k
        on_chain = set(chain)
        for p in range(1, len(level)):
            if p not in on_chain:
                level[p] = level[self.parent[p]]
        good, other = [0] * len(chain), [0] * len(chain)
        for (path, block, links), prose in zip(self.blocks, self.prose):
            k = level[path]
            if hidden[path] or k == len(chain) - 1:
                continue
            if 3 * links <= len(block) and not NOTICE.search(block[:400]) and (prose or SENTENCE.match(block)):
                good[k] += len(block)
            else:
                other[k] += len(block)
        out = len(chain) - 1
        for k in range(len(chain) - 2, -1, -1):
            if good[k] > 2 * other[k]:
                out = k
            elif other[k]:
                break
        return chain[out]

    def text(self, names: tuple[str, ...]) -> str:
        """The blocks inside the first path of ``names`` that has any."""
        for name in names:
            if (top := self.find(name)) is not None:
                hidden = self._hidden(top)
                found = [b for path, b, _ in self.blocks if not hidden[path]]
                if found:
                    return "\n\n".join(found)
        return ""


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def votes(pages: DataFrame) -> DataFrame:
    """(_host, path, length): the container each page names."""
    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        named = []
        for h in b.column("html"):
            page = Page(h.as_py() or "")
            path, size = page.container()
            named.append((page.name(path), size))
        return pa.RecordBatch.from_arrays(
            [b.column("_host"), pa.array([x[0] for x in named], pa.string()), pa.array([x[1] for x in named], pa.int64())],
            ["_host", "path", "length"])
    return map_batches(pages.select(host(F.col("url")).alias("_host"), "html"), batch, "_host string, path string, length bigint")


def winners(named: DataFrame) -> DataFrame:
    """(_host, _path): the path with most pages, then most text, then the smaller one."""
    tally = named.where("length > 0").groupBy("_host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("s"))
    best = F.min(F.struct((-F.col("n")).alias("n"), (-F.col("s")).alias("s"), "path"))
    return tally.groupBy("_host").agg(best.alias("b")).select("_host", F.col("b.path").alias("_path"))


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` and the main ``text`` of each page."""
    fields = [f for f in pages.schema.fields if f.name in keep]
    names = [f.name for f in fields]
    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for h, path in zip(b.column("html"), b.column("_path")):
            page = Page(h.as_py() or "")
            own = page.name(page.container()[0])
            out.append(page.text((path.as_py(), own) if path.as_py() is not None else (own,)))
        return pa.RecordBatch.from_arrays([*map(b.column, names), pa.array(out, pa.string())], [*names, "text"])
    cols = [F.col(c) for c in dict.fromkeys([*names, "html"])]
    # a stored table has a size: while it is small the html is not moved, beyond that the join splits a hot host
    best = stored(winners(votes(pages)), "host-winners")
    joined = pages.select(*cols, host(F.col("url")).alias("_host")).join(best, "_host", "left")
    return map_batches(joined.select(*cols, "_path"), batch, ddl + "text string")
