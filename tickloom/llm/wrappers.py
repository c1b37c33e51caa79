"""Main text of web pages by wrappers: union-free regular expressions inferred from the pages of a host.

1. Each page becomes a token stream, the stream a *skeleton*: element names with their classes, text slots, neighbours
   of one name (or periods of up to three names) folded into a repeated group. Equal skeletons of a template are counted
   once, so a host with most of the pages, or with thousands of copies, is a few rows. Templates of a host are told by
   the page alone: whether it has article or main elements with text, else by the element that holds most of its text.
2. The skeletons of a template are aligned one after another into its wrapper. Where children differ, what only one side
   has becomes an optional group, neighbours of one name a repeated group; text stays a slot. Templates with more than
   ALIGNED skeletons are aligned in parts, then the parts' wrappers, in as many rounds as it takes.
3. With the wrapper and what is known of every slot of the template (how much text it holds, how much of that in links,
   whether it is the same on all pages, or on those of the host if the template has one page) the content region is
   marked: article or main elements, else the element that holds most of the changing text outside links. Of article
   elements those in repeated groups (teasers, lists) give way to one that stands alone, on all pages, even on those
   that have a single teaser. Copies of a page count as one page. If nothing changes, all that isn't cut is read.
4. A page is read along the wrapper of its template: blocks of the region, in order, but for menus, headers, footers,
   sidebars, adverts, forms and comments, told by element or class; class words cut neither html and body nor what holds
   an article. A page without text in the region is read by a region marked from its own slots.

Wrappers go to the pages as a broadcast while they are smaller than WRAPPER_BYTES in all, else by a join on the template.

Defined results: null html counts as empty and gives ""; null or odd urls have host "", whose
pages share templates but no other facts; broken markup is read as far as
it goes (open elements end where their parent or the page does); repeated pages give repeated results; no page is cut.
Elements of any depth are read and cut by their own names; regions lie at most DEEPEST elements deep. Other columns of
the pages, whatever their names, are ignored; ids are integers.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..ship import ship
from .arrow import slices
from .store import written

ALIGNED = 200
WRAPPER_BYTES = 16 << 20
#: Distinct pages of a slot are counted up to so many.
COUNTED_PAGES = 3
#: Depth below which elements share the path of their parent.
DEEPEST = 60

# HTML element names by kind, and class words of what isn't article.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style noscript template textarea iframe svg title select".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr math mi mn mo ms mtext mrow mfrac msup msub msubsup msqrt mroot mover munder munderover semantics".split())
#: End tags of BOUND don't close anything outside the innermost of BOUNDS.
BOUND = INLINE | {"p", "li"}
BOUNDS = {"article", "main", "body", "table"}
CUT = set("nav footer aside form button head dialog menu".split())
CUT_OUTSIDE_ARTICLE = {"header"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CUT_WORDS = set(
    (
        "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion popup modal cookie cookies consent notice notices alert gdpr "
        "nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside widget widgets footer masthead topbar toolbar share sharing social related recommended "
        "newsletter subscribe signup login search comment comments reply replies disqus respond form pagination pager copyright disclaimer"
    ).split()
)
CUT_HEADS = {"header"}
ARTICLES = {"article", "main"}
#: What cuts an element even if it holds an article.
CUT_ALWAYS = {"nav", "footer", "aside", "head", "menu"}
#: Beginnings of class names that say something of the layout and name no part of it.
ABOUT = ("has-", "no-", "with-", "without-", "is-", "not-")

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</?[A-Za-z](?:[^<>\"']|\"[^\"]*\"|'[^']*')*>|</?[A-Za-z][^<>]*>|[^<]+|<", re.S)
NAME = re.compile(r"</?([A-Za-z][A-Za-z0-9:-]*)")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", re.I)
HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.|m\.)?([^/?#:]+)", re.I)
CLASS_WORD = re.compile(r"[a-z]+")


class Element:
    """``block``: an inline element that has a block inside; ``holds``: an article, or it has one inside."""

    __slots__ = ("tag", "key", "kids", "words", "block", "holds")

    def __init__(self, tag: str, key: str, words: frozenset[str]):
        self.tag, self.key, self.words = tag, key, words
        self.kids: list[Element | str] = []
        self.block = self.holds = False


_keys: dict[str, tuple[str, str, frozenset[str]]] = {}


def opened(token: str) -> tuple[str, str, frozenset[str]]:
    """(name, key, class words) of a start tag. Digits in classes don't tell elements apart; the id of an article names it alone."""
    known = _keys.get(token)
    if known is None:
        tag = NAME.match(token)[1].lower()
        parts, words = [], set()
        for name, value in ATTRIBUTE.findall(token) if "=" in token else ():
            value = value.strip("\"'").lower()
            if name.lower() != "id" or tag not in ARTICLES:
                words |= {w for c in value.split() if not c.startswith(ABOUT) for w in CLASS_WORD.findall(c)}
            if name.lower() != "id":
                parts += sorted(re.sub(r"\d+", "", value).split())
        known = tag, ".".join([tag, *parts]), frozenset(words)
        if len(_keys) > 20_000:
            _keys.clear()
        if len(token) < 200:
            _keys[token] = known
    return known


def mark(stack: list[Element]) -> None:
    """The last of the stack is an article, the others hold it."""
    for e in reversed(stack):
        if e.holds:
            break
        e.holds = True


def parse(page: str) -> Element:
    """The elements of a page; raw elements (scripts, styles and the like) are left out with all they hold."""
    root = Element("", "", frozenset())
    stack = [root]
    names: dict[str, int] = {}  # open elements by name
    last = page.rfind(">")

    def close(i: int) -> None:
        for e in stack[i:]:
            names[e.tag] -= 1
        del stack[i:]

    at, n, doubtful = 0, len(page), []
    while at < n:
        if page[at] == "<" and at > last and not page.startswith("<!--", at):  # no tag from here on
            stack[-1].kids.append(page[at:])
            break
        m = TOKEN.match(page, at)
        token = m[0]
        at = m.end()
        if token[0] != "<" or token == "<":
            stack[-1].kids.append(token)
            continue
        if token[1] in "!?":
            continue
        name = NAME.match(token)[1].lower()
        if token[1] == "/":
            if names.get(name):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == name:
                        close(i)
                        break
                    if stack[i].tag in BOUNDS and name in BOUND:
                        break
            continue
        if name in RAW:
            if token[-2] != "/":
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = end.end() if end else n
            continue
        tag, key, words = opened(token)
        if tag not in INLINE:
            ended = SIBLINGS.get(tag, ())
            if names.get("p") or any(names.get(t) for t in ended):
                for i in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph, an item its sibling
                    if stack[i].tag == "p" or stack[i].tag in ended:
                        close(i)
                        break
                    if stack[i].tag not in INLINE:
                        break
            for e in reversed(stack):
                if e.tag not in INLINE or e.block:
                    break
                e.block = True
        e = Element(tag, key, words)
        stack[-1].kids.append(e)
        if tag not in VOID and token[-2] != "/":
            stack.append(e)
            names[tag] = names.get(tag, 0) + 1
            if tag in ARTICLES:
                if not words & CUT_WORDS:
                    mark(stack)
                elif not root.holds:
                    doubtful.append(list(stack))
    if not root.holds:  # class words speak against all articles: then they don't count
        for path in doubtful:
            mark(path)
    return root


# -- skeletons and wrappers: [key, optional, repeated, children]; "#" is a text slot, "()" a group -------------------


def merge(a: list, b: list) -> list:
    """The least expression for both nodes of one key."""
    return [a[0], a[1] | b[1], a[2] | b[2], align(a[3], b[3])]


def fold(nodes: list[list]) -> list[list]:
    """Neighbouring periods of equal keys become one repeated group."""
    for period in (1, 2, 3):
        out: list[list] = []
        for node in nodes:
            out.append(node)
            while len(out) >= 2 * period and [x[0] for x in out[-period:]] == [x[0] for x in out[-2 * period : -period]] and (period == 1 or len({x[0] for x in out[-period:]}) > 1) and out[-1][0] != "()":
                both = [merge(x, y) for x, y in zip(out[-2 * period : -period], out[-period:], strict=True)]
                out[-2 * period :] = both if period == 1 else [["()", 0, 1, both]]
                if period == 1:
                    out[-1][2] = 1
            if period > 1 and len(out) > period and out[-period - 1][0] == "()" and [x[0] for x in out[-period:]] == [x[0] for x in out[-period - 1][3]]:
                group = out[-period - 1]
                group[3] = [merge(x, y) for x, y in zip(group[3], out[-period:], strict=True)]
                del out[-period:]
        nodes = out
    return nodes


def align(a: list[list], b: list[list]) -> list[list]:
    """Align two lists of children: what both have is merged, what one has becomes optional."""
    if [x[0] for x in a] == [x[0] for x in b]:
        return [merge(x, y) for x, y in zip(a, b, strict=True)]
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i][0] == b[j][0]:
            out.append(merge(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append([a[i][0], 1, a[i][2], a[i][3]])
            i += 1
        else:
            out.append([b[j][0], 1, b[j][2], b[j][3]])
            j += 1
    return fold(out)


def skeleton(e: Element, depth: int = 0) -> list:
    kids: list[list] = []
    text = False
    for k in e.kids:
        if isinstance(k, str):
            text = text or not k.isspace()
        elif is_text(k) or depth >= DEEPEST:
            text = True
        else:
            kids.append(skeleton(k, depth + 1))
    return [e.key, 0, 0, ([["#", 0, 0, []]] if text else []) + fold(kids)]


def is_text(e: Element) -> bool:
    """An element inside a line."""
    return e.tag in INLINE and not e.block


def cut(e: Element, inside: bool) -> bool:
    if e.holds:
        return e.tag in CUT_ALWAYS
    if e.tag in ("html", "body"):
        return False
    if e.tag in CUT or e.words & CUT_WORDS:
        return True
    return not inside and (e.tag in CUT_OUTSIDE_ARTICLE or bool(e.words & CUT_HEADS))


def walk(root: Element, regions: frozenset[str] = frozenset()) -> Iterator[tuple[str, list[str], int]]:
    """Blocks of a page in order, without what is cut: (path, pieces of text, characters in links). Headers of ``regions`` and articles belong to them. No recursion: pages may be deep."""
    own: list[str] = []
    linked = 0
    todo: list[tuple] = [(root, "", 0, False, 0)]
    while todo:
        e, path, depth, inside, at = todo.pop()
        here = f"{path}/{e.key}" if not at and depth <= DEEPEST else path
        inside = inside or e.tag in ARTICLES or here in regions
        while at < len(e.kids):
            k = e.kids[at]
            at += 1
            if isinstance(k, str):
                own.append(k)
            elif is_text(k):
                if not k.words & CUT_WORDS:
                    t = inline_text(k)
                    own.append(t)
                    linked += len(t) if k.tag == "a" else 0
            else:
                if own:
                    yield here, own, linked
                    own, linked = [], 0
                if k.tag != "hr" and not cut(k, inside or k.tag in ARTICLES):
                    todo += [(e, here, depth, inside, at), (k, here, depth + 1, inside, 0)]
                    break
        else:
            if own:
                yield here, own, linked
                own, linked = [], 0


def slots(root: Element) -> dict[str, list]:
    """path of an element with text of its own -> [text (null of several), characters, characters in links, times]."""
    out: dict[str, list] = {}
    for here, own, linked in walk(root):
        text = " ".join("".join(own).split())
        if text:
            s = out.setdefault(here, [text, 0, 0, 0])
            s[0] = s[0] if s[0] == text else None
            s[1] += len(text)
            s[2] += linked
            s[3] += 1
    return out


def inline_text(e: Element) -> str:
    out: list[str] = []
    todo: list[Element | str] = [e]
    while todo:
        k = todo.pop()
        if isinstance(k, str):
            out.append(k)
        elif k.tag == "br":
            out.append(" ")
        else:
            todo += reversed(k.kids)
    return "".join(out)


def host_of(url: str | None) -> str:
    m = HOST.match(url or "")
    return m[1].lower() if m else ""


def most(worth: dict[str, int]) -> list[str]:
    """The deepest element that holds most of the worth of its slots, but not a single kind of paragraph."""
    mass: dict[str, int] = {}
    for path, w in worth.items():
        steps = path.split("/")
        for i in range(2, len(steps) + 1):
            p = "/".join(steps[:i])
            mass[p] = mass.get(p, 0) + w
    total = max(mass.values(), default=0)
    deep = [p for p, v in mass.items() if total and v >= 0.7 * total]
    deep = [p for p in deep if p.rsplit("/", 1)[1].split(".")[0] not in ("p", "h1", "h2", "h3", "li", "td", "pre", "blockquote")] or deep
    return [max(deep, key=lambda p: (p.count("/"), p))] if deep else []


def own_regions(own: dict[str, list]) -> list[str]:
    """The region of a page by its own slots alone; all of it if they hold nothing but links."""
    return most({path: max(0, chars - 2 * linked) for path, (_, chars, linked, _) in own.items()}) or ["/"]


def template_of(url: str | None, own: dict[str, list]) -> str:
    """Host and template of a page with these slots."""
    article = any(step.split(".")[0] in ("article", "main") for path in own for step in path.split("/"))
    return "\n".join([host_of(url), *(["article"] if article else own_regions(own))])


def inspect(pages: DataFrame) -> DataFrame:
    """(url, html) -> ``host`` (with template)``, kind, value`` with sums: kind "s" for skeletons, "t" for slots; summed up within slices.

    ``pages``: distinct pages of a slot, exact up to COUNTED_PAGES; a slice names so many of them by hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                rows: dict[tuple[str, str, str], list] = {}
                for url, page in zip(part.column("url").to_pylist(), part.column("html").to_pylist(), strict=True):
                    root = parse(page)
                    own = slots(root)
                    host, digest = template_of(url, own), xxhash.xxh64_intdigest(page.encode()) - (1 << 63)
                    s = rows.setdefault((host, "s", json.dumps(skeleton(root), separators=(",", ":"))), [0, 0, 0, 0, 0, ()])
                    s[0] += 1
                    for path, (text, chars, linked, times) in own.items():
                        h = zlib.crc32(text.encode()) if text is not None else -1
                        s = rows.setdefault((host, "t", path), [0, h, h, 0, 0, ()])
                        s[0] += 1
                        s[1], s[2] = (min(s[1], h), max(s[2], h)) if times == 1 else (-1, 1 << 40)
                        s[3] += chars
                        s[4] += linked
                        if digest not in s[5]:
                            s[5] = tuple(sorted((*s[5], digest))[:COUNTED_PAGES])
                host, kind, value = zip(*rows, strict=True) if rows else ((), (), ())
                n, low, high, chars, linked, digests = zip(*rows.values(), strict=True) if rows else ((),) * 6
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.string()) for x in (host, kind, value)), *(pa.array(x, pa.int64()) for x in (n, low, high, chars, linked)), pa.array([list(x) for x in digests], pa.list_(pa.int64()))], names=["host", "kind", "value", "n", "low", "high", "chars", "linked", "pages"])

    rows = pages.mapInArrow(run, "host string, kind string, value string, n long, low long, high long, chars long, linked long, pages array<long>")
    distinct = F.size(F.array_distinct(F.flatten(F.collect_set("pages"))))
    return rows.groupBy("host", "kind", "value").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), distinct.alias("pages"))


def align_all(frame: pd.DataFrame) -> pd.DataFrame:
    """The wrapper of the skeletons (or wrappers) of a host, most frequent first."""
    frame = frame.sort_values(["n", "value"], ascending=[False, True])
    out = None
    for value in frame["value"]:
        node = json.loads(value)
        out = node if out is None else merge(out, node)
    return pd.DataFrame({"host": [frame["host"].iloc[0]], "value": [json.dumps(out, separators=(",", ":"))], "n": [int(frame["n"].sum())]})


def region_of(wrapper: list, seen: list[dict], constant: frozenset[str] = frozenset()) -> dict:
    """What is read on pages of this wrapper: paths of the elements of the content region, and of slots to leave out.

    ``constant``: slots with one text on all pages of the host, for slots that one page of the template has.
    """
    found: dict[str, int] = {}  # articles -> whether they are repeated

    def search(node: list, path: str, repeated: int) -> None:
        here = path if node[0] == "()" else f"{path}/{node[0]}"
        repeated |= node[2]
        tag = node[0].split(".")[0]
        if tag in CUT_ALWAYS:
            return
        if tag in ARTICLES or "role" in node[0] and "main" in CLASS_WORD.findall(node[0]):
            found[here] = found.get(here, 0) | repeated
        for k in node[3]:
            search(k, here, repeated)

    search(wrapper, "", 0)

    def within(path: str, region: str) -> bool:
        return path == region or path.startswith(region + "/")

    with_text = {r: repeated for r, repeated in found.items() if any(within(s["path"], r) for s in seen)}
    if with_text:
        alone = [r for r, repeated in with_text.items() if not repeated]
        tops = [r for r in alone or with_text if not any(r != o and within(r, o) for o in alone or with_text)]
        # An article that stands alone is the article; main alone is only where to look for one.
        lists = [r for r, repeated in with_text.items() if repeated and r.rsplit("/", 1)[1].split(".")[0] == "article"]
        single = any(r.rsplit("/", 1)[1].split(".")[0] == "article" for r in alone)
        return {"regions": sorted(tops), "skip": sorted(lists) if single else []}
    # Text that changes from page to page and isn't a link, summed over each element's inside.
    changing = [s for s in seen if (s["low"] != s["high"] if s["pages"] > 1 else s["path"] not in constant)]
    return {"regions": most({s["path"]: max(0, s["chars"] - 2 * s["linked"]) for s in changing}) or ["/"], "skip": []}


def infer(pages: DataFrame) -> DataFrame:
    """``host`` (with template)``, wrapper, region``: the wrapper and, as JSON, what of it is read."""
    ship(pages.sparkSession)
    seen = written(inspect(pages), "page-slots")
    wrappers = seen.where("kind = 's'").select("host", "value", "n")
    schema = "host string, value string, n long"
    while True:
        per_host = wrappers.groupBy("host").agg(F.count("*").alias("c"))
        if (per_host.agg(F.max("c")).first()[0] or 0) <= ALIGNED:
            break
        dealt = wrappers.join(per_host, "host").withColumn("part", F.pmod(F.xxhash64("value"), F.ceil(F.col("c") / (ALIGNED // 2))))
        # Parts of many distinct wrappers each; every round leaves one per part.
        wrappers = written(dealt.select("host", "part", "value", "n").groupBy("host", "part").applyInPandas(align_all, schema), "wrappers")
    wrappers = wrappers.groupBy("host").applyInPandas(align_all, schema)
    slot = F.struct(F.col("value").alias("path"), "n", "low", "high", "chars", "linked", "pages")
    texts = seen.where("kind = 't'").groupBy("host").agg(F.to_json(F.collect_list(slot)).alias("slots"))
    # Slots with one text on all pages of a host, whatever the template.
    site = F.substring_index("host", "\n", 1).alias("site")
    same = seen.where("kind = 't'").select(site, "value", "pages", "low", "high").groupBy("site", "value").agg(F.sum("pages").alias("pages"), F.min("low").alias("low"), F.max("high").alias("high"))
    same = same.where("site <> '' and pages > 1 and low = high and low >= 0").groupBy("site").agg(F.to_json(F.collect_list("value")).alias("constant"))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            regions = [json.dumps(region_of(json.loads(w), json.loads(s or "[]"), frozenset(json.loads(c or "[]")))) for w, s, c in zip(*(batch.column(x).to_pylist() for x in ("value", "slots", "constant")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("value"), pa.array(regions, pa.string())], names=["host", "wrapper", "region"])

    return wrappers.join(texts, "host", "left").select("host", "value", "slots", site).join(same, "site", "left").select("host", "value", "slots", "constant").mapInArrow(marked, "host string, wrapper string, region string")


class Reader:
    """Reads pages along the region of a wrapper."""

    def __init__(self, region: str):
        spec = json.loads(region)
        self.regions, self.skip = frozenset(spec["regions"]), frozenset(spec["skip"])
        self.known: dict[str, bool] = {}

    def reads(self, path: str) -> bool:
        found = self.known.get(path)
        if found is None:
            if len(self.known) > 20_000:
                self.known.clear()
            found = self.known[path] = any(path == r or path.startswith(r if r == "/" else r + "/") for r in self.regions) and not any(path == r or path.startswith(r + "/") for r in self.skip)
        return found

    def read(self, root: Element, own: dict[str, list]) -> str:
        blocks = self.blocks(root)
        if own and not blocks:  # none of the regions is on this page
            blocks = Reader(json.dumps({"regions": own_regions(own), "skip": []})).blocks(root)
        return "\n".join(blocks)

    def blocks(self, root: Element) -> list[str]:
        texts = (" ".join(entities.unescape("".join(own)).split()) for path, own, _ in walk(root, self.regions) if self.reads(path))
        return [t for t in texts if t]


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    wrappers = written(infer(rows.select("url", "html")).select("host", "region"), "regions")
    small = (wrappers.agg(F.sum(F.length("region") + F.length("host"))).first()[0] or 0) <= WRAPPER_BYTES

    def read(known: dict[str, str] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            readers: dict[str, Reader] = {}
            for batch in batches:
                for part in slices(batch, "html"):
                    texts = []
                    regions = part.column("region").to_pylist() if known is None else [None] * len(part)
                    for url, page, region in zip(part.column("url").to_pylist(), part.column("html").to_pylist(), regions, strict=True):
                        root = parse(page)
                        own = slots(root)
                        if known is not None:
                            region = known.value.get(template_of(url, own))
                        if len(readers) > 5_000:
                            readers.clear()
                        reader = readers.get(region) or readers.setdefault(region, Reader(region or '{"regions": [], "skip": []}'))
                        texts.append(reader.read(root, own))
                    yield pa.RecordBatch.from_arrays([part.column("id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

        return run

    schema = "page_id long, url string, text string, n_chars long"
    if small:
        known = spark.sparkContext.broadcast({r.host: r.region for r in wrappers.collect()})
        return rows.mapInArrow(read(known), schema)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                hosts = [template_of(u, slots(parse(page))) for u, page in zip(part.column("url").to_pylist(), part.column("html").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", "url", "html")), pa.array(hosts, pa.string())], names=["id", "url", "html", "host"])

    return rows.mapInArrow(told, "id long, url string, html string, host string").join(wrappers, "host", "left").select("id", "url", "html", "region").mapInArrow(read(None), schema)
