"""Main text of web pages by equivalence-class template deduction.

Pages of one host are read together, in groups of bounded size (a host with a
third of all pages is many groups).  Tokens are start tags, end tags and text
blocks, each with the path of elements around it.

1. The occurrence vector of a token counts it on every distinct page of the group
   (pages that differ outside their text only count once).  Tokens with one vector,
   on more than half of the pages, form an equivalence class; it is valid when its
   tokens come in one order, over and over, on every page that has them.
2. Valid classes nest: a class lies in the slot between two neighbouring tokens
   of another.  The class of tokens that occur once on every page is the template's
   skeleton; a class that occurs several times in one slot of it makes the slot a
   repeating one.
3. A text block in a valid class is template and no content, inside an article or
   not, from two distinct pages on: one that is on every page in its place among
   the skeleton's tokens, or one that comes and goes with the element around it.
   Where such blocks would take more than half of the article's text on most pages,
   the pages are copies of one another, and their articles are left whole.
4. The remaining slots hold the varying text.  Repeating slots whose text is all
   links are lists of links.  The deepest skeleton element that holds most of the
   other varying text is the article, unless pages have an article or main element
   of their own.  Slots in menus, page headers, footers, sidebars, notices, adverts,
   forms, scripts, styles and reader comments are left out.  A class, id or role
   decides only below the article: on the page's body, its main or article element,
   or the elements around the article it says nothing.

A page without its group's article element, or alone on its host, is read by its
own elements.  Defined cases: NULL or empty html gives the empty text; a NULL url
counts as a host of its own; repeated rows give repeated results and count once in
the vectors; unclosed and stray tags are recovered from; order is page order.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.llm.common import stored

GROUP = 64               # pages of a host looked at together

# HTML element kinds and the usual names of page furniture.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title svg iframe object".split())
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
            "h4 h5 h6 head header hr html li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
FURNITURE = set("aside button dialog footer form head iframe menu nav noscript object script select style svg template textarea title".split())
FURNITURE_NAMES = set("ad ads adsbygoogle advert adverts advertisement banner breadcrumb breadcrumbs comment commentlist comments consent cookie cookies disqus footer "
                      "form gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo "
                      "recommended related respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar "
                      "widget".split())
ARTICLE = {"article", "main"}
ROOTS = {"html", "body", "main"}                           # never furniture by name
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
BARRIER = set("article aside blockquote body button div fieldset footer form header main nav ol section table td ul".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*>|<(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|"
    r"<(?P<end2>/)?(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>", re.S)
_ATTR = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


@dataclass
class Block:
    text: str
    path: str
    furniture: bool                      # by an element's tag
    marks: tuple[tuple[str, bool], ...]  # elements around it whose names are those of furniture: path, all words of a name are
    roots: tuple[tuple[int, int, int], ...]   # article elements around it, none within an article: number, whole marks, depth
    articles: tuple[str, ...]            # paths of the article elements around it, outermost first
    around: tuple[str, ...]              # paths of all elements around it
    linked: bool                         # all of it is link text

    @property
    def token(self) -> tuple[str, str]:
        return self.path, self.text


Token = str | tuple[str, str]                              # a tag's path, or a text block's path and text


@dataclass
class Page:
    tags: list[Token] = field(default_factory=list)      # all tokens in page order
    blocks: list[Block] = field(default_factory=list)


def parse(html: str) -> Page:
    """Structural tokens and text blocks of a page."""
    page = Page()
    stack: list[tuple[str, str, bool, bool, bool | None]] = []    # name, path, furniture, article, mark
    serial: list[int] = []                                # of the elements on the stack
    parts: list[str] = []
    lowered = html.lower()
    links, plain = 0, False                               # open links; text outside a link since the last block

    def add(text: str) -> None:
        nonlocal plain
        parts.append(text)
        plain = plain or (not links and bool(text.strip()))

    def flush() -> None:
        nonlocal plain
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        linked, plain = not plain, False
        if text:
            # inline elements do not name a block
            path = next((f[1] for f in reversed(stack) if f[0] in BLOCK), "")
            roots, strong = [], 0
            for depth, (number, (name, _, _, article, mark)) in enumerate(zip(serial, stack)):
                strong += mark is True
                if article and (mark is None or name in ARTICLE):
                    roots.append((number, strong, depth))
                    if name != "main":
                        break
            page.blocks.append(Block(text, path, bool(stack) and stack[-1][2], tuple((f[1], f[4]) for f in stack if f[4] is not None),
                                     tuple(roots), tuple(f[1] for f in stack if f[3]), tuple(f[1] for f in stack), linked))
            page.tags.append((path, text))

    def pop(count: int) -> None:
        nonlocal links
        for _ in range(count):
            name, path = stack[-1][:2]
            if name in BLOCK:
                flush()
            page.tags.append("/" + path)
            links -= name == "a"
            stack.pop()
            serial.pop()

    at = 0
    while True:
        m = _TOKEN.search(html, at)
        if not m:
            add(html[at:])
            break
        add(html[at:m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        if m["end"] or m["end2"]:
            for depth, frame in enumerate(reversed(stack)):
                if frame[0] == name:
                    pop(depth + 1)
                    break
                if name not in BARRIER and frame[0] in BARRIER:
                    break                                  # a stray end tag
            continue
        if name in BLOCK:
            flush()
        if name == "br":
            parts.append(" ")
        for depth, frame in enumerate(reversed(stack)):
            if frame[0] in CLOSES.get(name, ()) or (frame[0] == "p" and name in BLOCK):      # a block ends a paragraph
                pop(depth + 1)
                break
            if frame[0] in BARRIER or (frame[0] in BLOCK and name not in CLOSES):
                break
        given = [[w for w in re.split(r"[^a-z0-9]+", n) if w] for x in _ATTR.findall(m["attrs"] or m["attrs2"] or "") for n in "".join(x).lower().split()]
        names = [w for ws in given for w in ws]
        outer = stack[-1] if stack else ("", "", False, False, None)
        inside_article = any(f[3] for f in stack)
        furniture = outer[2] or name in FURNITURE or (not inside_article and name == "header")
        mark = None
        if name not in ROOTS:
            known = FURNITURE_NAMES if inside_article else FURNITURE_NAMES | {"header"}
            if any(ws and known.issuperset(ws) for ws in given):
                mark = True
            elif known & set(names) and (name != "article" or any(f[3] and f[0] != "main" for f in stack)):
                mark = False
        path = f"{outer[1]}/{name}" + (f".{'.'.join(sorted(set(names)))}" if names else "")
        page.tags.append(path)
        if name in VOID or (m["attrs"] or "").endswith("/"):
            continue
        if name in RAW:                                    # its content is not markup
            stop = lowered.find(f"</{name}", at)
            page.tags.append("/" + path)
            if stop < 0:
                at = len(html)
            else:
                close = html.find(">", stop)
                at = close + 1 if close >= 0 else len(html)
            continue
        links += name == "a"
        stack.append((name, path, furniture, name in ARTICLE or "article" in names, mark))
        serial.append(len(page.tags))
    pop(len(stack))
    flush()
    return page


@dataclass
class Template:
    skeleton: list[Token]                 # tokens that occur once on every page, in order
    slots: dict[tuple[str, str], int]     # neighbouring skeleton tokens -> characters of varying text between them
    nested: dict[tuple[str, str], list[list[Token]]]     # ... -> the valid classes that lie there
    element: str | None                   # path of the element that holds the article
    constant: set[tuple[str, str]]        # text blocks of valid classes
    spared: set[str]                      # paths whose names of furniture say nothing, on pages without an article element
    lists: set[str]                       # paths of repeating elements that hold links only


def _spared(blocks: list[Block]) -> set[str]:
    """Paths of the elements with names of furniture that hold the main text, so that their names say nothing.

    Elements on and around the largest article, among the articles with the fewest
    names that are furniture as a whole; without an article, the elements around
    half of the text or more.
    """
    blocks = [b for b in blocks if not b.furniture]
    size: dict[tuple[int, int, int], int] = defaultdict(int)
    around: dict[tuple[int, int, int], tuple[str, ...]] = {}
    rest: list[tuple[Block, int]] = []
    for b in blocks:
        r = b.roots[-1] if b.roots else None
        if r and b.around[r[2]].rpartition("/")[2].split(".")[0] != "main":
            size[r] += len(b.text)
            around[r] = b.around[:r[2] + 1]
        else:
            rest.append((b, len(b.text)))
    if size:
        least = min(strong for _, strong, _ in size)
        chosen = max((r for r in size if r[1] == least), key=lambda r: (size[r], -r[0]))
        # articles that are furniture by name, beside more text without such names: a page whose comments are articles
        if not least or size[chosen] >= sum(n for b, n in rest if not b.marks):
            return {around[r][-1] for r in size if r[1] == least} | set(around[chosen])
    return _around_half(rest)


def _around_half(sizes: list[tuple[Block, int]]) -> set[str]:
    """Paths of the marked elements that hold half of the text or more; whole marks are looked at only where all text has one."""
    spared: set[str] = set()
    while sizes:
        plain = [(b, n) for b, n in sizes if not any(strong and p not in spared for p, strong in b.marks)]
        inside: dict[str, int] = defaultdict(int)
        for b, n in plain or sizes:
            for p in {p for p, strong in b.marks if p not in spared and strong == (not plain)}:
                inside[p] += n
        if plain:
            total = sum(n for _, n in plain)
            return spared | {p for p, n in inside.items() if 2 * n >= total}
        # all text is within whole marks: the outermost of those that hold the most is looked into
        spared.add(max(inside, key=lambda p: (inside[p], -p.count("/"))))
    return spared


def _articles(page: Page) -> bool:
    return any(b.roots and not b.furniture for b in page.blocks)


def _kept(blocks: list[Block], spared: set[str]) -> list[Block]:
    """The blocks that are not furniture."""
    return [b for b in blocks if not b.furniture and all(p in spared for p, _ in b.marks)]


def deduce(pages: list[Page]) -> Template | None:
    """Template of the distinct pages of a group; None when there are fewer than two that differ in their text."""
    pages = list({tuple(b.token for b in p.blocks if not b.furniture): p for p in reversed(pages)}.values())[::-1]
    n = len(pages)
    if n < 2:
        return None
    on: dict[Token, int] = defaultdict(int)
    for p in pages:
        for t in set(p.tags):
            on[t] += 1
    vector = {t: np.zeros(n, np.int32) for t, c in on.items() if 2 * c > n}
    for k, p in enumerate(pages):
        for t in p.tags:
            if t in vector:
                vector[t][k] += 1
    classes: dict[bytes, list[Token]] = defaultdict(list)
    for t, v in vector.items():
        classes[v.tobytes()].append(t)

    def valid(tokens: list[Token]) -> list[Token]:
        """The class's order, if all its pages show its tokens round in that one order."""
        own = set(tokens)
        order: list[Token] = []
        for p in pages:
            seen = [t for t in p.tags if t in own]
            if not seen:
                continue
            order = order or seen[:len(own)]
            if len(seen) % len(order) or any(seen[i:i + len(order)] != order for i in range(0, len(seen), len(order))):
                return []
        return order

    def with_texts(tags: list[Token], texts: list[Token]) -> list[Token]:
        """The order of valid ``tags`` with those text blocks that keep a place among them."""
        order = valid(tags)
        whole = valid(tags + texts) if texts else order
        if whole or not order:
            return whole
        for t in texts:
            order = valid([*order, t]) or order
        return order

    ones = np.ones(n, np.int32).tobytes()
    once = classes.pop(ones, [])
    skeleton = with_texts([t for t in once if isinstance(t, str)], [t for t in once if not isinstance(t, str)])
    if not skeleton:
        return None
    place = {t: i for i, t in enumerate(skeleton) if isinstance(t, str)}
    constant = {t for t in skeleton if not isinstance(t, str)}
    nested: dict[tuple[str, str], list[list[Token]]] = defaultdict(list)
    repeated: set[str] = set()
    for members in classes.values():
        texts = [t for t in members if not isinstance(t, str)]
        tags = [t for t in members if isinstance(t, str)]
        order = with_texts(tags, [t for t in texts if on[t] == n or t[0] in tags])
        if not tags:
            order = [t for t in texts if on[t] == n]       # repeated on every page, in elements that hold other text too
        constant.update(t for t in order if not isinstance(t, str))
        order = [t for t in order if isinstance(t, str)]
        homes = {_home(t, place) for t in order}
        if len(order) > 1 and len(homes) == 1:             # the whole class lies in one slot
            home = homes.pop()
            nested[home, "/" + home].append(order)
            if vector[order[0]].max() > 1:
                repeated.update(t for t in order if not t.startswith("//"))
    constant = _without_copies(pages, constant)
    # repeating slots that hold links only
    text: dict[str, bool] = {}
    for p in pages:
        for b in p.blocks:
            for t in b.around:
                if t in repeated:
                    text[t] = text.get(t, True) and b.linked
    lists = {t for t, linked in text.items() if linked}

    opened = [t for t in skeleton if isinstance(t, str) and not t.startswith("//")]
    own = [p for p in pages if not _articles(p)]
    spared = _around_half([(b, len(b.text)) for p in own for b in p.blocks if not b.furniture and b.token not in constant])
    slots: dict[tuple[str, str], int] = defaultdict(int)
    for p in pages:
        for b in _kept(p.blocks, _spared(p.blocks) if _articles(p) else spared):
            if b.token not in constant and lists.isdisjoint(b.around):
                inner = [t for t in b.around if t in place]
                if inner:
                    slots[inner[-1], "/" + inner[-1]] += len(b.text)
    element = next((t for t in opened if t.rpartition("/")[2].split(".")[0] in ARTICLE), None)
    if element is None:
        total = sum(slots.values())
        inside = {t: sum(v for (a, _), v in slots.items() if a == t or a.startswith(t + "/")) for t in opened}
        fit = [t for t in opened if total and inside[t] >= 0.7 * total]
        element = max(fit, key=lambda t: t.count("/")) if fit else None
    return Template(skeleton, dict(slots), dict(nested), element, constant, spared, lists)


def _without_copies(pages: list[Page], constant: set[tuple[str, str]]) -> set[tuple[str, str]]:
    """``constant`` without blocks of articles that are mostly made of it on most pages: those pages are copies."""
    mostly, seen, inside = 0, 0, set()
    for p in pages:
        own = [b for b in p.blocks if b.articles and not b.furniture]
        same = [b for b in own if b.token in constant]
        if own:
            seen += 1
            mostly += 2 * sum(len(b.text) for b in same) > sum(len(b.text) for b in own)
            inside.update(b.token for b in same)
    return constant - inside if 2 * mostly > seen else constant


def _home(token: str, place: dict[str, int]) -> str:
    """The innermost skeleton element around a token."""
    path = token.removeprefix("/") if token.startswith("//") else token
    while "/" in path:
        path = path.rpartition("/")[0]
        if path in place:
            return path
    return ""


def extract(page: Page, template: Template | None) -> str:
    """Blocks of the article slots in page order, joined by an empty line; blocks of the template's classes are left out."""
    deduced = template is not None and template.element is not None and not _articles(page)
    blocks = _kept(page.blocks, template.spared if deduced else _spared(page.blocks))
    chosen = [b for b in blocks if template and template.element in b.around]
    if not chosen or (not any(b.articles for b in chosen) and any(b.articles for b in blocks)):
        chosen = [b for b in blocks if b.articles] or chosen or blocks
    if template is not None:
        # a page whose chosen part is template as a whole has no slot there: it is left as it is
        chosen = [b for b in chosen if b.token not in template.constant and (b.articles or template.lists.isdisjoint(b.around))] or chosen
    return "\n\n".join(b.text for b in chosen)


RESULT = "page_id long, url string, text string, n_chars long"


def main_text(pages: DataFrame, group: int = GROUP) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    own = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    own = own.withColumn("host", F.coalesce(host, F.lit("")))
    # stored, so that its size is known when the join is planned: few hosts are broadcast by Spark's own
    # size check, many are joined by shuffle
    sizes = stored(own.groupBy("host").agg(F.ceil(F.count("*") / group).alias("parts")), "page-hosts")
    # one key of host and part: a partitioning by host alone would not do, a host's parts go to different tasks
    cell = F.struct("host", F.pmod(F.xxhash64("page_id", "url"), F.col("parts")).alias("part"))
    dealt = own.join(sizes, "host").select(cell.alias("cell"), "page_id", "url", "html")

    def run(table: pa.Table) -> pa.Table:
        ids, urls, sources = (table[c].to_pylist() for c in ("page_id", "url", "html"))
        parsed: dict[str, Page] = {}
        for h in sources:
            if h and h not in parsed:
                parsed[h] = parse(h)
        # a part of a host can hold more copies than pages meant for it: read in pieces of distinct pages
        distinct = sorted(parsed)
        template: dict[str, Template | None] = {}
        for lo in range(0, len(distinct), 4 * group):
            piece = distinct[lo:lo + 4 * group]
            found = deduce([parsed[h] for h in piece])
            template.update(dict.fromkeys(piece, found))
        texts = {h: extract(p, template[h]) for h, p in parsed.items()}
        out = [texts[h] if h else "" for h in sources]
        return pa.table([pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(out, pa.string()),
                         pa.array([len(t) for t in out], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return dealt.groupBy("cell").applyInArrow(run, RESULT)
