"""Per-page HTML helper: a small element tree and CSS selector matching.

Runs inside ``mapInPandas`` tasks (one page at a time); Spark partitions and
shuffles the pages. Only the standard library is used. Supported selector
syntax: tag, ``.class``, ``#id``, ``[attr]``, ``[attr=value]``,
``:nth-child(n)``, ``:first-child``, combinators descendant (space), ``>``,
``+``, ``~`` and groups separated by ``,``. Matches come back in document
order, so ``select(...)[0]`` is the first element on the page.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
        "param", "source", "track", "wbr"}
# Start tags that implicitly close an open element of the listed kinds.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
          "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BLOCK_START_CLOSES_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset",
                        "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr",
                        "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
BLOCK = BLOCK_START_CLOSES_P | {"li", "dt", "dd", "tr", "td", "th", "br", "body", "html", "title"}


_SPACES = re.compile(r"[ \t\n\f\r]+")


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "content", "order", "place")

    def __init__(self, tag: str, attrs: dict, parent: Node | None, order: int):
        self.tag, self.attrs, self.parent, self.order = tag, attrs, parent, order
        self.children: list[Node] = []        # element children
        self.content: list = []               # text and element children, in order
        self.place = len(parent.children) if parent else 0      # among the parent's element children

    @property
    def classes(self) -> set:
        return set(self.attrs.get("class", "").split())

    def index(self) -> int:
        """1-based position among the parent's element children."""
        return self.place + 1

    def prev_sibling(self) -> Node | None:
        return self.parent.children[self.place - 1] if self.parent and self.place else None

    def next_sibling(self) -> Node | None:
        after = self.parent.children[self.place + 1:self.place + 2] if self.parent else ()
        return after[0] if after else None

    def text(self) -> str:
        """Combined text of the element and its descendants; runs of HTML white space become one blank.

        No-break spaces are text and stay.
        """
        out: list[str] = []
        todo: list = list(reversed(self.content))
        while todo:
            c = todo.pop()
            if isinstance(c, str):
                out.append(c)
                continue
            if c.tag in BLOCK:
                out.append(" ")
                todo.append(" ")
            if c.tag not in ("script", "style"):
                todo.extend(reversed(c.content))
        return _SPACES.sub(" ", "".join(out)).strip(" ")


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.count = 0
        self.root = Node("#root", {}, None, 0)
        self.stack = [self.root]
        self.all: list[Node] = []

    def _close_until(self, names: set, stop_at_block: bool = False):
        for i in range(len(self.stack) - 1, 0, -1):
            t = self.stack[i].tag
            if t in names:
                del self.stack[i:]
                return
            if stop_at_block and t in ("ul", "ol", "table", "dl", "div", "article", "section", "body"):
                return

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES:
            self._close_until(CLOSES[tag], stop_at_block=True)
        if tag in BLOCK_START_CLOSES_P and tag != "p":
            self._close_until({"p"}, stop_at_block=True)
        self.count += 1
        parent = self.stack[-1]
        node = Node(tag, {k: (v or "") for k, v in attrs}, parent, self.count)
        parent.children.append(node)
        parent.content.append(node)
        self.all.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack[-1].tag == tag:
            self.stack.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        self.stack[-1].content.append(data)


def parse(html: str) -> list[Node]:
    """All elements of the page in document order."""
    b = _Builder()
    b.feed(html)
    b.close()
    return b.all


_COMPOUND = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:[.#][\w-]+|\[[^\]]+\]|:[\w-]+(?:\([^)]*\))?)*)")
_PART = re.compile(r"[.#][\w-]+|\[[^\]]+\]|:[\w-]+(?:\([^)]*\))?")


def _compile_compound(text: str):
    m = _COMPOUND.fullmatch(text)
    if not m:
        raise ValueError(f"unsupported selector part: {text!r}")
    tag, rest = m.group(1), m.group(2)
    tests = []
    if tag and tag != "*":
        tests.append(lambda n, t=tag.lower(): n.tag == t)
    for part in _PART.findall(rest):
        if part[0] == ".":
            tests.append(lambda n, c=part[1:]: c in n.classes)
        elif part[0] == "#":
            tests.append(lambda n, i=part[1:]: n.attrs.get("id") == i)
        elif part[0] == "[":
            body = part[1:-1]
            if "=" in body:
                k, v = body.split("=", 1)
                v = v.strip().strip("\"'")
                tests.append(lambda n, k=k.strip(), v=v: n.attrs.get(k) == v)
            else:
                tests.append(lambda n, k=body.strip(): k in n.attrs)
        elif part.startswith(":nth-child("):
            k = int(part[len(":nth-child("):-1])
            tests.append(lambda n, k=k: n.index() == k)
        elif part == ":first-child":
            tests.append(lambda n: n.index() == 1)
        else:
            raise ValueError(f"unsupported pseudo-class: {part}")
    return lambda n: all(t(n) for t in tests)


def _compile_complex(text: str):
    tokens = re.findall(r"\s*([>+~])\s*|(\S+?)(?=\s*[>+~]|\s|$)", text.strip())
    steps, comb = [], None
    for c, compound in tokens:
        if c:
            comb = c
            continue
        steps.append((comb if steps else None, _compile_compound(compound)))
        comb = " "
    return steps


def _matches(node: Node, steps, i: int) -> bool:
    comb, test = steps[i]
    if not test(node):
        return False
    if i == 0:
        return True
    link = steps[i][0]
    if link == " ":
        p = node.parent
        while p is not None and p.tag != "#root":
            if _matches(p, steps, i - 1):
                return True
            p = p.parent
        return False
    if link == ">":
        return node.parent is not None and node.parent.tag != "#root" and _matches(node.parent, steps, i - 1)
    if link == "+":
        s = node.prev_sibling()
        return s is not None and _matches(s, steps, i - 1)
    if link == "~":
        s = node.prev_sibling()
        while s is not None:
            if _matches(s, steps, i - 1):
                return True
            s = s.prev_sibling()
        return False
    raise ValueError(link)


def compile_selector(selector: str):
    groups = [_compile_complex(g) for g in selector.split(",") if g.strip()]
    return lambda n: any(_matches(n, steps, len(steps) - 1) for steps in groups)


def select(elements: list[Node], selector: str) -> list[Node]:
    test = compile_selector(selector)
    return [n for n in elements if test(n)]


def select_first(elements: list[Node], selector) -> Node | None:
    """First element (document order) matching ``selector`` (text or compiled)."""
    test = compile_selector(selector) if isinstance(selector, str) else selector
    return next((n for n in elements if test(n)), None)
