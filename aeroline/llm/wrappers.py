"""Main text of web pages by wrappers: union-free expressions inferred from the pages of a host."""

from __future__ import annotations

import html as html_entities
import json
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroline.session import staged

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORDS = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+(?![a-z])")
SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: An open element on the left is closed by the start of one on the right.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
          "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option", "optgroup"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "head": {"body"}}
SCOPES = frozenset("table td th ul ol dl html body article section div main aside nav header footer form".split())

AROUND = frozenset("nav aside footer form script style noscript template iframe svg math canvas object audio video button select textarea input dialog menu head title".split())
AROUND_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice
notices alert nav navbar navigation menu breadcrumb breadcrumbs sidebar sidebars widget widgets footer masthead comment comments commentlist discussion disqus respond
replies related recommended share sharing social newsletter subscribe subscription signup popup modal overlay login pagination pager toolbar skip search hidden""".split())
AROUND_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
BOXES = frozenset(["div", "section"])
ARTICLES = frozenset(["article", "main"])
#: Repeated elements of these are items of a list (comments, teasers), not the paragraphs of one text.
ITEMS = frozenset("li div section article dd tr".split())
#: Pages of a host from which on text that never varies counts as part of the template, and its greatest share of the main text.
PAGES, FIXED_SHARE = 3, 0.3
_MOST_TEXT = 0.6
#: Elements nested deeper than this have no level of their own, so that no page exhausts the stack.
DEEPEST = 150
#: A list of nodes that grows beyond this is folded into repeated groups, so that a wrapper does not grow with its pages.
LONGEST = 64


class Element:
    __slots__ = ("around", "children", "doubtful", "sign", "tag")

    def __init__(self, tag: str, sign: str, around: bool):
        self.tag, self.sign, self.around, self.children, self.doubtful = tag, sign, around, [], not around and _doubtful(sign)


def _doubtful(sign: str) -> bool:
    """Class or id has a word of things around a text; whether the element is one is decided by its host's wrapper."""
    tag, *names = sign.split(".")
    return bool(names) and tag not in ("html", "body", "article", "main") and not AROUND_WORDS.isdisjoint(names)


def _flows(element: Element) -> bool:
    """Part of a line: inline, without blocks."""
    return element.tag in INLINE and not any(isinstance(c, Element) and c.tag not in INLINE for c in element.children)


def _speaks(element: Element) -> bool:
    """Whether there is text in the lines of an element beside doubtful inline elements: these are then words of a sentence,
    and a class or id alone does not take words out of a sentence."""
    return any(
        bool(child.strip()) if isinstance(child, str) else _flows(child) and not child.around and not child.doubtful and _speaks(child)
        for child in element.children)


def _start(tag: str, attributes: str, inside: bool) -> Element:
    """``inside``: in an article, where a header belongs to the text."""
    names, around = [], tag in AROUND or (tag == "header" and not inside)
    if attributes.strip():
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
        names = sorted({w.lower() for a in ("class", "id") for w in WORDS.findall(found.get(a, "")) if not w.isdigit()})
        around = around or found.get("role", "").lower() in AROUND_ROLES
        around = around or "hidden" in found or found.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none", found.get("style", ""), re.I))
        around = around and tag not in ("html", "body", "article", "main")
    return Element(tag, ".".join([tag, *names]), around)


def _border(element: Element) -> None:
    """The start or end of a block that shares its children with the element it is in."""
    if element.tag not in INLINE:
        element.children.append(Element("hr", "hr", False))


def _end(stack: list[Element], at: int) -> None:
    for element in stack[max(at, DEEPEST + 1):]:
        _border(element)
    del stack[at:]


def parse(page: str) -> Element:
    """The element tree of a page, whatever it looks like: end tags without a start are ignored, missing ones are implied,
    and levels end at ``DEEPEST``: what is nested deeper stays in its place and keeps its block borders."""
    root = Element("", "", False)
    stack, at, last = [root], 0, page.rfind(">") + 1
    while at < len(page):
        m = TOKEN.search(page, at, last) if at < last else None
        text = page[at:m.start()] if m else page[at:].partition("<!--")[0]
        if text:
            stack[-1].children.append(text)
        if not m:
            break
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                break
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    _end(stack, i)
                    break
            continue
        if tag not in INLINE:
            for i in range(len(stack) - 1, 0, -1):
                own = stack[i].tag
                if own == "p" or tag in CLOSES.get(own, ()):
                    _end(stack, i)
                elif own in SCOPES and own not in CLOSES:
                    break
        element = _start(tag, m[3], any(e.tag in ("article", "main") for e in stack))
        element.around = element.around or (element.doubtful and len(stack) > DEEPEST)
        if len(stack) > DEEPEST and not element.around and tag not in VOID and tag not in RAW:
            element.children = stack[-1].children
            _border(element)
        else:
            stack[-1].children.append(element)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not m[3].rstrip().endswith("/"):
            stack.append(element)
    return root


def _blocks(element: Element, out: list[list[str]], opened: set[tuple[str, ...]], path: tuple[str, ...] = (), line: bool = False) -> None:
    """Pieces of text by block; ``out`` ends with the open block. ``opened``: paths of doubtful elements that are text.
    ``line``: the element is part of a line that has text."""
    speaks = line or _speaks(element)
    for child in element.children:
        if isinstance(child, str):
            out[-1].append(child)
            continue
        here = path if _flows(child) else (*path, child.sign)
        if child.around or (child.doubtful and (not speaks if here is path else here not in opened)):
            if child.tag not in INLINE:
                out.append([])
        elif child.tag in INLINE:
            if child.tag in ("br", "wbr", "img"):
                out[-1].append(" " if child.tag == "br" else "")
            else:
                _blocks(child, out, opened, here, speaks and here is path)
        else:
            out.append([])
            _blocks(child, out, opened, here)
            out.append([])


def _lines(element: Element, rule: dict) -> list[str]:
    out: list[list[str]] = [[]]
    _blocks(element, out, {tuple(p) for p in rule.get("open", ())})
    lines = (SPACE.sub(" ", html_entities.unescape("".join(b))).strip() for b in out if b)
    fixed = set(rule["fixed"])
    return [line for line in lines if line and line not in fixed]


# A wrapper is a list of nodes [sign, kind, children, weight, text]. kind: "1" once, "?" optional, "+" repeated,
# "*" both. A text node has the sign "#"; its text is what all pages have there, or None: a slot. A node with the sign
# "()" is a group that is no element of its own. weight: characters of text below it over all pages.


def _pattern(element: Element) -> list:
    nodes: list[list] = []
    flow: list[str] = []

    def flush() -> None:
        line = SPACE.sub(" ", html_entities.unescape("".join(flow))).strip()
        flow.clear()
        if line:
            nodes.append(["#", "1", [], len(line), line])

    def walk(e: Element, line: bool = False) -> None:
        speaks = line or _speaks(e)
        for child in e.children:
            if isinstance(child, str):
                flow.append(child)
            elif child.around or (child.doubtful and _flows(child) and not speaks):
                continue
            elif _flows(child):
                if child.tag == "br":
                    flow.append(" ")
                walk(child, speaks)
            else:
                flush()
                inner = _pattern(child)
                nodes.append([child.sign, "1", inner, sum(n[3] for n in inner), None])

    walk(element)
    flush()
    return _folded(_repeats(nodes))


def _joined(a: list, b: list, kind: str) -> list:
    return [a[0], kind, merge(a[2], b[2]), a[3] + b[3], a[4] if a[4] == b[4] else None]


def _kind(a: str, b: str) -> str:
    return {(False, False): "1", (True, False): "?", (False, True): "+", (True, True): "*"}[a in "?*" or b in "?*", a in "+*" or b in "+*"]


def _repeats(nodes: list) -> list:
    """Neighbours of the same sign become one repeated group."""
    out: list[list] = []
    for node in nodes:
        if out and out[-1][0] == node[0] != "#":
            out[-1] = _joined(out[-1], node, "*" if out[-1][1] in "?*" and node[1] in "?*" else "+")
        else:
            out.append(node)
    return out


def _group(nodes: list) -> list:
    """A repeated group of optional members that covers the nodes in any order; too many signs are told apart by tag only."""
    def joined(sign_of) -> dict[str, list]:
        members: dict[str, list] = {}
        for node in _flat(nodes):
            sign, known = sign_of(node[0]), members.get(sign_of(node[0]))
            single = [sign, "?" if node[1] in "1?" else "*", *node[2:]]
            members[sign] = single if known is None else _joined(known, single, "*")
        return members

    members = joined(str)
    if len(members) > LONGEST:
        members = joined(lambda sign: sign.split(".")[0] + (".ad" if _doubtful(sign) else ""))
    return ["()", "*", list(members.values()), sum(n[3] for n in nodes), None]


def _flat(nodes: list) -> Iterator[list]:
    """The nodes, with the members of groups in their place."""
    for node in nodes:
        if node[0] == "()":
            yield from _flat(node[2])
        else:
            yield node


def _folded(nodes: list) -> list:
    """A list of bounded length: what stands between elements that are there once on every page becomes a group."""
    if len(nodes) <= LONGEST:
        return nodes
    often = Counter(n[0] for n in nodes)
    out: list[list] = []
    for single, run in groupby(nodes, lambda n: n[1] == "1" and often[n[0]] == 1):
        run = list(run)
        out += run if single or len(run) == 1 else [_group(run)]
    return out if len(out) <= LONGEST else [_group(out)]


def merge(a: list, b: list) -> list:
    """The wrapper that covers both: equal signs are aligned, what has no partner becomes optional, text that differs a slot."""
    if not a or not b:
        return [[n[0], _kind(n[1], "?"), *n[2:]] for n in a or b]
    out: list[list] = []
    for op, a0, a1, b0, b1 in SequenceMatcher(None, [n[0] for n in a], [n[0] for n in b], autojunk=False).get_opcodes():
        if op == "equal":
            out += [_joined(x, y, _kind(x[1], y[1])) for x, y in zip(a[a0:a1], b[b0:b1])]
        else:
            out += [[n[0], _kind(n[1], "?"), *n[2:]] for n in a[a0:a1] + b[b0:b1]]
    return _folded(_repeats(out))


def expression(wrapper: list) -> str:
    """The wrapper as a readable expression."""
    parts = []
    for sign, kind, children, _, text in wrapper:
        inner = expression(children)
        body = ("#slot" if text is None else repr(text)) if sign == "#" else inner if sign == "()" else f"<{sign}>{inner}</>"
        parts.append(body if kind == "1" else f"({body}){kind}")
    return "".join(parts)


def _articles(nodes: list, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], list]]:
    for node in _flat(nodes):
        here = (*path, node[0])
        if node[0].split(".")[0] in ("article", "main") and node[3]:
            yield here, node
        else:
            yield from _articles(node[2], here)


def main_path(wrapper: list) -> tuple[tuple[str, ...], list]:
    """Path of the element with the main text, and its nodes: the article or main element with most text, else down
    while one element that is no text holds most of it."""
    found = max(_articles(wrapper), key=lambda x: x[1][3], default=None)
    if found:
        inner = max((x for x in _articles(found[1][2], found[0])), key=lambda x: x[1][3], default=None)
        if inner and inner[1][3] >= _MOST_TEXT * found[1][3]:
            found = inner
        return found[0], found[1][2]
    path: tuple[str, ...] = ()
    nodes = wrapper
    while True:
        nodes = list(_flat(nodes))
        total = sum(n[3] for n in nodes)
        best = max((n for n in nodes if n[0] != "#" and n[1] in "1?"), key=lambda n: n[3], default=None)
        if best is None or best[0].split(".")[0] in ("p", "pre", "table", "ul", "ol", "blockquote") or best[3] < _MOST_TEXT * total or not total:
            return path, nodes
        path, nodes = (*path, best[0]), best[2]


def _own(nodes: list, fixed: bool) -> int:
    """Characters of text outside lists of items; ``fixed``: without what all pages have."""
    total = 0
    for sign, kind, children, weight, text in nodes:
        if sign == "#":
            total += 0 if fixed and text is not None and kind == "1" else weight
        elif sign == "()" or kind in "1?" or sign.split(".")[0] not in ITEMS:
            total += _own(children, fixed)
    return total


def _holds_article(nodes: list) -> bool:
    """An article or main element with text that is no item of a list."""
    return any(n[3] and n[1] in "1?" and (n[0].split(".")[0] in ARTICLES or _holds_article(n[2])) for n in _flat(nodes))


def _without_around(wrapper: list, pages: int) -> tuple[list, set[tuple[str, ...]]]:
    """The wrapper without the doubtful elements that are around the text, and the paths of those that are not: what
    holds the article or main element, or most of the text of the page, or of the article it is in."""
    fixed = pages >= PAGES and _own(wrapper, True) > 0
    opened: set[tuple[str, ...]] = set()

    def kept(nodes: list, path: tuple[str, ...], scope: int, inside: bool) -> list:
        out = []
        for node in nodes:
            sign, kind, children, _, text = node
            if sign == "#":
                out.append(node)
                continue
            here, within, whole = path, inside, scope
            if sign != "()":
                here = (*path, sign)
                if _doubtful(sign):
                    if not (not inside and _holds_article([node])) and _own([node], fixed) < max(1, _MOST_TEXT * scope):
                        continue
                    opened.add(here)
                elif sign.split(".")[0] in ARTICLES:
                    within, whole = True, _own(children, fixed)
            inner = kept(children, here, whole, within)
            out.append([sign, kind, inner, sum(n[3] for n in inner), text])
        return out

    return kept(wrapper, (), _own(wrapper, fixed), False), opened


def _fixed(nodes: list, box: bool = False) -> Iterator[str]:
    """Lines that all pages have in a box of their own; headings and paragraphs of the text itself are not meant."""
    for sign, kind, children, _, text in nodes:
        if sign == "#" and text is not None and kind == "1" and box:
            yield text
        elif kind == "1":
            yield from _fixed(children, box or sign.split(".")[0] in BOXES)


def rules(wrapper: list, pages: int) -> dict:
    """What extraction needs of a wrapper: the path of the main element, lines of the template in it, and the paths below
    it of doubtful elements that are text, if there are any."""
    wrapper, opened = _without_around(wrapper, pages)
    path, nodes = main_path(wrapper)
    fixed = set(_fixed(nodes)) if pages >= PAGES else set()
    if sum(map(len, fixed)) * pages > FIXED_SHARE * sum(n[3] for n in nodes):
        fixed = set()  # the pages are copies
    inner = sorted(list(p[len(path):]) for p in opened if len(p) > len(path) and p[:len(path)] == path)
    return {"path": list(path), "fixed": sorted(fixed)} | ({"open": inner} if inner else {})


def _at(element: Element, path: list[str]) -> list[Element]:
    level = [element]
    for sign in path:
        level = [c for e in level for c in e.children if isinstance(c, Element) and c.sign == sign and not c.around]
    return level


def extract(page: str | None, rule: dict | None) -> str:
    """Main text of a page by its host's rule; a page without the rule's element is judged by itself."""
    root = parse(page or "")
    own = _at(root, rule["path"]) if rule and rule["path"] else []
    lines = [line for e in own for line in _lines(e, rule)] if own else []
    if not lines:
        rule = rules(_pattern(root), 1)
        lines = [line for e in (_at(root, rule["path"]) if rule["path"] else [root]) for line in _lines(e, rule)]
    return "\n".join(lines)


def host(url: str = "url"):
    """Column: host of a URL in lower case, without user and port; no host: empty."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))


def infer(pages: DataFrame) -> DataFrame:
    """``host``, ``pages``, ``wrapper`` (JSON) for every host of ``pages`` (``host``, ``html``), from all its pages.

    Tasks merge the pages of a host that they have, then the wrappers of tasks are merged, one row per host and batch:
    a host with a third of all pages sends no more rows than others. A list of a wrapper has ``LONGEST`` nodes at most, or a group of as many.
    """

    def fold(rows: Iterator[tuple[str, int, list]]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list] = {}
        for name, n, wrapper in rows:
            known = seen.get(name)
            seen[name] = [n, wrapper] if known is None else [known[0] + n, merge(known[1], wrapper)]
        names = list(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([seen[k][0] for k in names], pa.int64()), pa.array([json.dumps(seen[k][1]) for k in names], pa.string())],
            ["host", "pages", "wrapper"])

    def of_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from fold((h, 1, _pattern(parse(p.as_py()))) for h, p in zip(batch.column(0).to_pylist(), batch.column(1)))

    def of_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fold((h, n, json.loads(w)) for b in batches for h, n, w in sorted(zip(*(c.to_pylist() for c in b.columns))))

    schema = "host string, pages long, wrapper string"
    rows = pages.where("html IS NOT NULL").select("host", "html")
    return rows.mapInArrow(of_pages, schema).repartition("host").mapInArrow(of_wrappers, schema)


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` per row of ``pages`` (``page_id``, ``url``, ``html``).

    A null html is empty, an empty page has an empty text. Pages without a host are taken as one host. Other columns
    are left behind. White space inside a block is one space, a line break element too; blocks are joined by a newline.
    """
    rows = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"), host().alias("host"))
    wrappers = infer(rows)

    def ruled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [json.dumps(rules(json.loads(w), n)) for n, w in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.string())], ["host", "rule"])

    known = staged(wrappers.mapInArrow(ruled, "host string, rule string"), "wrappers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsed: dict[str, dict] = {}
        for b in batches:
            texts = []
            for page, rule in zip(b.column(2), b.column(3).to_pylist()):
                if rule is not None and rule not in parsed:
                    if len(parsed) > 10_000:
                        parsed.clear()
                    parsed[rule] = json.loads(rule)
                texts.append(extract(page.as_py(), parsed.get(rule)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    kind = dict(rows.dtypes)["page_id"]
    joined = rows.join(known, "host", "left").select("page_id", "url", "html", "rule")
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
