"""Main-text extraction from web pages by a tree-structured graphical model.

A page's block elements and its blocks of text are the nodes of a tree. Each node
is content or not; features give its own potential and parent and child share a
potential. Sum-product messages passed up to the root and down again yield each
node's marginal. Weights are learnt by gradient ascent on the likelihood of
labelled pages; ``labelled_pages`` makes such pages from many templates.
"""

from __future__ import annotations

import functools
import html as _html
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import text_batches

# fixed values of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("script style template noscript head title svg math canvas iframe object audio video select option datalist button textarea xmp noembed noframes".split())
BLOCKS = frozenset(
    "html body address article aside blockquote center details dialog dd dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol p pre search section summary table caption tbody thead tfoot tr ul".split()
)
#: Starting one of these ends an open element of the set beside it, unless one of the bounds lies between.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    **{t: (frozenset(["tbody", "thead", "tfoot", "tr"]), frozenset(["table"])) for t in ("tbody", "thead", "tfoot")},
}
#: What may stand in a head; the start of anything else, or text, ends one that is open.
IN_HEAD = frozenset("html base basefont bgsound link meta title style script noscript template noframes".split())
#: Elements that a slash at the end of the start tag closes.
FOREIGN = frozenset(["svg", "math"])
ENDS_P = BLOCKS - {"html", "body", "tr", "tbody", "thead", "tfoot", "caption"}
#: What stands in these is not in the head itself.
_HEAD_BOUNDS = frozenset(["template", "noscript"])
_P_BOUNDS = frozenset("button table td th caption object template".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.DOTALL)
_ATTR = re.compile(r"([^\s=/\"'<>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_TOKEN = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Node:
    """A block element, or (tag "#text") a block of text right below one."""

    tag: str
    parent: int
    attrs: str = ""
    parts: list = field(default_factory=list)
    text: str = ""
    chars: int = 0
    links: int = 0
    controls: int = 0
    sentences: int = 0
    paragraphs: int = 0
    start: int = 0
    gold: int = 0


def parse(page: str) -> list[Node]:
    """Nodes of a page in order, parents first; all that is not shown is left out.

    Inline elements are part of the block of text around them, and so are line
    breaks and table cells, as white space.
    """
    nodes, stack, hidden, link, at, n = [Node("#root", -1)], [("#root", 0)], 0, 0, 0, len(page)
    open_text = -1

    def end_text():
        nonlocal open_text
        if open_text >= 0:
            node = nodes[open_text]
            node.text = " ".join("".join(node.parts).split())
            node.chars, node.parts = len(node.text), []
            open_text = -1

    def add(text: str):
        nonlocal open_text
        if hidden or not text:
            return
        if "&" in text:
            text = _html.unescape(text)
        if open_text < 0:
            if not text.strip():
                return
            owner = next(i for _, i in reversed(stack) if i >= 0)
            nodes.append(Node("#text", owner))
            open_text = len(nodes) - 1
        nodes[open_text].parts.append(text)
        if link:
            nodes[open_text].links += len(text.strip())

    def close(k: int):
        nonlocal hidden, link
        while len(stack) > k:
            tag, i = stack.pop()
            hidden -= tag in UNSEEN
            link -= tag == "a"
            if i >= 0:
                end_text()

    def close_open(of: frozenset, bounds: frozenset):
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in of:
                close(k)
                return
            if stack[k][0] in bounds:
                return

    def shown(text: str):
        if stack[-1][0] == "head" and text.strip():
            close(len(stack) - 1)
        add(text)

    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            shown(page[at:])
            break
        shown(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                add(_html.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and not any(t == "p" for t, _ in stack):
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
                if stack[k][0] in ("table", "td", "th") and tag not in BLOCKS and tag != "td" and tag != "th":
                    break
            if tag in ("td", "th"):
                add(" ")
            continue
        if hidden and tag not in IN_HEAD:
            close_open(frozenset(["head"]), _HEAD_BOUNDS)
        if tag in ENDS_P:
            close_open(frozenset(["p"]), _P_BOUNDS)
        if tag in IMPLIED:
            close_open(*IMPLIED[tag])
        if tag in VOID:
            if tag == "br" or tag == "hr":
                if tag == "hr":
                    end_text()
                elif open_text >= 0:
                    add("\n")
            elif tag in ("input", "img"):
                for _, i in reversed(stack):
                    if i >= 0:
                        nodes[i].controls += tag == "input"
                        break
            continue
        attrs = m[3]
        if tag in BLOCKS and not hidden:
            end_text()
            nodes.append(Node(tag, next(i for _, i in reversed(stack) if i >= 0), attrs))
            stack.append((tag, len(nodes) - 1))
        else:
            if tag in ("button", "select", "textarea") and not hidden:
                nodes[next(i for _, i in reversed(stack) if i >= 0)].controls += 1
            if attrs.rstrip().endswith("/") and (tag in FOREIGN or tag not in UNSEEN | RAW):
                continue
            stack.append((tag, -1))
            hidden += tag in UNSEEN
            link += tag == "a"
            if tag in ("td", "th"):
                add(" ")
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(page, at)
            if not end:
                break
            at = end.start()
    end_text()
    return nodes


def measure(nodes: list[Node]) -> None:
    """Give every node the sizes of what is below it, and where that begins."""
    seen = 0
    for node in nodes:
        node.start = seen
        if node.tag == "#text":
            seen += node.chars
            node.sentences = node.text.count(". ") + node.text.count(", ") + node.text.endswith((".", "!", "?"))
            node.links = min(node.links, node.chars)
    for i in range(len(nodes) - 1, 0, -1):
        node, up = nodes[i], nodes[nodes[i].parent]
        up.chars += node.chars
        up.links += node.links
        up.sentences += node.sentences
        up.controls += node.controls
        up.paragraphs += node.paragraphs + (node.tag == "p")


def _level(x: float, steps: tuple) -> int:
    return sum(x >= s for s in steps)


def features(nodes: list[Node], i: int) -> list[str]:
    """Names of a node's features."""
    node = nodes[i]
    whole = max(1, nodes[0].chars)
    out = ["bias", f"tag {node.tag}"]
    chars = _level(node.chars, (1, 20, 60, 150, 500, 2000))
    linked = _level(node.links / max(1, node.chars), (0.01, 0.2, 0.5, 0.9))
    kind = "t" if node.tag == "#text" else "e"
    out += [f"{kind} chars {chars}", f"{kind} links {linked}", f"{kind} chars {chars} links {linked}", f"{kind} sentences {_level(node.sentences, (1, 3, 8))}"]
    if kind == "e":
        out += [f"share {_level(node.chars / whole, (0.02, 0.1, 0.3, 0.6, 0.9))}", f"paragraphs {_level(node.paragraphs, (1, 2, 4))}", f"place {_level(node.start / whole, (0.01, 0.1, 0.5, 0.9))}"]
        if node.controls:
            out.append("controls")
        if node.attrs:
            for m in _ATTR.finditer(node.attrs):
                name = m[1].lower()
                if name in ("class", "id", "role", "itemprop", "aria-label", "data-testid"):
                    for token in set(_TOKEN.findall((m[2] or m[3] or m[4] or "").lower())):
                        out += [f"word {token}", f"stem {token[:5]}"]
                elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", m[0].lower()):
                    out.append("unshown")
            if re.search(r"(?:^|\s)hidden(?:[\s=>]|$)", node.attrs):
                out.append("unshown")
    else:
        out.append(f"in {nodes[node.parent].tag}")
    return out


def _pair(nodes: list[Node], i: int) -> str:
    tag = nodes[i].tag
    if tag == "#text":
        return "text"
    return "part" if tag in ("p", "li", "ul", "ol", "tr", "tbody", "table", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "dd", "dt", "dl", "pre", "figcaption", "figure") else "box"


def _up(u: float, t: tuple) -> float:
    """Log ratio of the message a child of log odds ``u`` sends; ``t``: log potentials (00, 01, 10, 11), parent first."""
    return _lse(t[2], t[3] + u) - _lse(t[0], t[1] + u)


def _lse(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


@dataclass
class Model:
    unary: dict[str, float] = field(default_factory=dict)
    pair: dict[str, tuple] = field(default_factory=lambda: {k: (0.5, -0.5, -0.5, 0.5) for k in ("text", "part", "box")})

    def infer(self, nodes: list[Node], names: list[list[str]]):
        """Sum-product: (marginal of each node, joint of each node with its parent)."""
        n, get = len(nodes), self.unary.get
        own = [sum(get(f, 0.0) for f in names[i]) for i in range(n)]
        table = [self.pair[_pair(nodes, i)] for i in range(n)]
        belief, sent = own[:], [0.0] * n
        for i in range(n - 1, 0, -1):  # children stand behind their parents
            sent[i] = _up(belief[i], table[i])
            belief[nodes[i].parent] += sent[i]
        inside = belief[:]
        joint: list = [None] * n
        for i in range(1, n):
            t, above = table[i], belief[nodes[i].parent] - sent[i]  # what the parent knows without this child
            belief[i] += _lse(t[1], t[3] + above) - _lse(t[0], t[2] + above)
            cells = (t[0], t[1] + inside[i], t[2] + above, t[3] + above + inside[i])
            top = max(cells)
            e = [math.exp(c - top) for c in cells]
            z = sum(e)
            joint[i] = [x / z for x in e]
        return [1 / (1 + math.exp(-max(-60.0, min(60.0, b)))) for b in belief], joint

    def blocks(self, page: str | None) -> list[str]:
        nodes = parse(page or "")
        measure(nodes)
        marginals, _ = self.infer(nodes, [features(nodes, i) for i in range(len(nodes))])
        return [x.text for x, p in zip(nodes, marginals) if x.tag == "#text" and p > 0.5 and x.text]


def extract(page: str | None, model: Model) -> str:
    """Main text of a page: its content blocks, one a line."""
    return "\n".join(model.blocks(page))


def train(pages: list[str], rounds: int = 15, rate: float = 0.15, decay: float = 1e-3, mark: str = "data-gold") -> Model:
    """Fit a model to pages whose content elements carry the attribute ``mark``, by stochastic gradient ascent (AdaGrad).

    A block of text is content if its nearest marked or unmarked ("data-noise")
    ancestor is marked; an element, if more than half of its text is.
    """
    data = []
    for page in pages:
        nodes = parse(page)
        for i, x in enumerate(nodes):
            x.gold = 1 if f"{mark}" in x.attrs else 0 if "data-noise" in x.attrs or i == 0 else nodes[x.parent].gold
        share = [x.gold * x.chars if x.tag == "#text" else 0 for x in nodes]
        for x in nodes:
            x.attrs = re.sub(r"\s*data-(?:gold|noise)", "", x.attrs)
        for i in range(len(nodes) - 1, 0, -1):
            share[nodes[i].parent] += share[i]
        measure(nodes)
        gold = [x.gold if x.tag == "#text" or not x.chars else int(2 * s > x.chars) for x, s in zip(nodes, share)]
        data.append((nodes, [features(nodes, i) for i in range(len(nodes))], gold))
    model, squares, order = Model(), defaultdict(float), random.Random(5)
    for _ in range(rounds):
        order.shuffle(data)
        for nodes, names, gold in data:
            marginals, joint = model.infer(nodes, names)
            grad: dict[str, float] = defaultdict(float)
            pairs: dict[str, list] = {}
            for i, x in enumerate(nodes):
                for f in names[i]:
                    grad[f] += gold[i] - marginals[i]
                if i:
                    g = pairs.setdefault(_pair(nodes, i), [0.0] * 4)
                    for k in range(4):
                        g[k] += (k == 2 * gold[x.parent] + gold[i]) - joint[i][k]
            for f, g in grad.items():
                w = model.unary.get(f, 0.0)
                g -= decay * w
                squares[f] += g * g
                model.unary[f] = w + rate * g / math.sqrt(squares[f] + 1e-6)
            for kind, g in pairs.items():
                t = list(model.pair[kind])
                for k in range(4):
                    squares[kind, k] += g[k] ** 2
                    t[k] += 0.3 * rate * g[k] / math.sqrt(squares[kind, k] + 1e-6)
                model.pair[kind] = tuple(t)
    return model


@functools.cache
def fitted() -> Model:
    """The model of ``labelled_pages``, fitted once in a session."""
    return train(list(labelled_pages()))


def extract_text(pages: DataFrame, model: Model, html_col: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with a column ``name``: the main text of each whole page.

    A null or empty page gives the empty text; a page that is broken off is read as
    far as it goes. Repeated rows give the same; an empty table gives an empty
    result. Pages stay in their own partitions.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model)
    text_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def main_text(column: pd.Series) -> pd.Series:
        return pd.Series([extract(x, sent.value) for x in column], dtype=object)

    return pages.withColumn(name, main_text(F.col(f"`{html_col}`")))


def labelled_pages(n: int = 400, seed: int = 11) -> Iterator[str]:
    """Pages from many templates; content elements carry data-gold, what is not content inside them data-noise."""
    r = random.Random(seed)
    syllables = "an the in er on re th st nd ing ion ou le de la que ment ten ver sch ung los cion mi ra".split()
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))
    link = lambda: f'<a href="/{word()}">{words(1, 3)}</a>'

    def sentence(a: int = 4, b: int = 18) -> str:
        x = words(a, b)
        if r.random() < 0.4:
            x = x.replace(" ", ", ", 1)
        if r.random() < 0.1:
            x += " " + link() + " " + words(1, 6)
        if r.random() < 0.1:
            x = f"<{(t := r.choice(['b', 'em', 'span', 'strong', 'i']))}>{x}</{t}>"
        return x[:1].upper() + x[1:] + r.choice([".", ".", ".", "!", "?", "", ".&amp;", " &mdash; " + word()])

    brief = False  # whether the page says little
    prose = lambda a=1, b=7: words(1, 3).capitalize() + r.choice([".", "", "!!"]) if brief and r.random() < 0.8 else " ".join(sentence() for _ in range(r.randint(a, b)))

    def named(tag: str, names: str, more: str = "") -> tuple[str, str]:
        label = r.choice(names.split()) if names else ""
        attr = "" if not label or r.random() < 0.1 else f' {r.choice(["class", "id", "class"])}="{r.choice(["", "", "site-", "page-", "js-", "c-"])}{label}{r.choice(["", "", "-inner", "-wrap", " clearfix", "__box"])}"'
        return f"<{tag}{attr}{more}>", f"</{tag}>"

    def links(tag: str, names: str, a: int = 3, b: int = 9) -> str:
        o, c = named(tag, names)
        items = [link() for _ in range(r.randint(a, b))]
        return o + r.choice(["<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>", " | ".join(items), "".join(f"<div>{x}</div>" for x in items)]) + c

    def notice(names: str) -> str:
        o, c = named(r.choice(["div", "div", "div", "section", "aside", "p"]), names)
        body = prose(1, 2) + r.choice(["", "", f"<button>{word()}</button>", link()])
        return o + (body if o.startswith("<p") or r.random() < 0.5 else f"<p>{body}</p>") + c

    def form() -> str:
        o, c = named("form", "search subscribe newsletter login contact signup")
        return o + r.choice(["", f"<p>{sentence()}</p>", f"<h3>{words(1, 4)}</h3>"]) + f"<label>{words(1, 3)}</label><input type=text><button>{word()}</button>" + c

    def comments() -> str:
        o, c = named(r.choice(["section", "div", "div", "ol"]), "comments comment-list responses discussion replies disqus", r.choice(["", ' aria-label="comments"']))
        one = lambda: (lambda x: x[0] + r.choice([f"<p>{words(1, 2)}</p>", f"<h4>{words(1, 2)}</h4>", f"<span>{words(1, 2)}</span>", ""]) + f"<p>{prose(1, 4)}</p>" + x[1])(named(r.choice(["div", "li", "article"]), "comment reply response comment-body"))
        return o + r.choice(["", f"<h3>{r.choice(['Comments', 'Responses', words(1, 2)])}</h3>"]) + "".join(one() for _ in range(r.randint(1, 5))) + r.choice(["", form()]) + c

    def aside() -> str:
        o, c = named(r.choice(["aside", "aside", "div", "section"]), "sidebar related widget side-column rail trending recommended more-stories promo")
        return o + "".join(r.choice([lambda: f"<h3>{words(1, 4)}</h3>" + links("div", "widget", 2, 5), lambda: f"<p>{prose(1, 2)}</p>", lambda: notice("ad widget promo"), form])() for _ in range(r.randint(1, 3))) + c

    def header() -> str:
        o, c = named(r.choice(["header", "header", "div"]), "header masthead topbar banner branding head")
        return o + r.choice([f"<h1>{words(1, 3)}</h1>", f"<p>{words(1, 5)}</p>", f"<div>{link()}</div>", ""]) + r.choice([links("nav", "nav menu"), f"<p>{sentence()}</p>"]) + c

    def footer() -> str:
        o, c = named(r.choice(["footer", "footer", "div"]), "footer colophon site-info bottom copyright legal")
        return o + "".join(r.choice([lambda: f"&copy; {word()}.example &middot; {sentence()}", lambda: f"<p>&copy; 2020 {words(1, 4)}</p>", lambda: links("ul", "footer-links"), lambda: f"<p>{prose(1, 2)}</p>"])() for _ in range(r.randint(1, 3))) + c

    ads, notices = "ad ads advert advertisement sponsor sponsored promo banner-ad adslot", "cookie-notice cookie consent gdpr alert notice banner popup modal newsletter subscribe-box disclaimer paywall"
    noise = [lambda: notice(ads), lambda: notice(ads), lambda: notice(notices), lambda: links("nav", "nav menu navbar breadcrumb pagination"), lambda: links("div", "share social tags menu related breadcrumbs toolbar pager"), aside, form, comments, header, footer]

    def part(depth: int = 0) -> str:
        k = r.random()
        if k < 0.62:
            return f"<p>{prose()}{r.choice(['</p>', '</p>', '</p>', '<br>'])}"
        if k < 0.72:
            h = r.choice(["h2", "h3", "h4"])
            return f"<{h}>{words(1, 8)}</{h}>"
        if k < 0.80:
            t = r.choice(["ul", "ol"])
            return f"<{t}>" + "".join(f"<li>{sentence() if r.random() < 0.7 else words(1, 5)}</li>" for _ in range(r.randint(2, 6))) + f"</{t}>"
        if k < 0.85:
            return f"<blockquote>{r.choice([prose(1, 2), f'<p>{prose(1, 2)}</p>'])}</blockquote>"
        if k < 0.88:
            return "<table>" + "".join(f"<tr><td>{words(1, 3)}</td><td>{words(1, 3)}</td></tr>" for _ in range(r.randint(2, 5))) + "</table>"
        if k < 0.91:
            return f"<pre>{words(3, 12)}</pre>"
        if k < 0.93:
            return f"<figure><img src=x><figcaption>{sentence()}</figcaption></figure>"
        if depth < 2:
            o, c = named(r.choice(["div", "section"]), r.choice(["", "", "section paragraph block body"]))
            return o + "".join(part(depth + 1) for _ in range(r.randint(1, 4))) + c
        return f"<div>{prose()}</div>"

    for _ in range(n):
        brief = r.random() < 0.2
        title = words(2, 9)
        o, c = r.choice([lambda: ("<article data-gold>", "</article>"), lambda: ("<article data-gold>", "</article>"), lambda: named("main", "content main", " data-gold"), lambda: named("div", "content article post entry story body post-content article-body entry-content main-text text", " data-gold"), lambda: named("section", "content article story post", " data-gold"), lambda: ("<div data-gold>", "</div>"), lambda: named("article", "post article hentry", " data-gold")])()
        inner = [f"<h1>{title}</h1>"] * (r.random() < 0.8) + [part() for _ in range(r.choice([1, 1, 2, 2, 3, 5, 8, 14, 25] + [100] * brief))]
        for _ in range(r.choice([0, 0, 0, 1, 2])):
            x = r.choice([lambda: notice(ads), lambda: links("div", "share social related tags"), form, lambda: notice(notices), comments])()
            at = len(inner) if x.startswith(("<section", "<ol")) else r.randint(0, len(inner))
            inner.insert(at, re.sub(r"^<(\w+)", r"<\1 data-noise", x))
        body = o + "".join(inner) + c
        for _ in range(r.choice([0, 0, 1, 2])):
            a, b = named(r.choice(["div", "div", "main"]), "wrapper container page layout row column main grid")
            body = a + "".join(r.choice(noise)() for _ in range(r.choice([0, 0, 1]))) + body + "".join(r.choice(noise)() for _ in range(r.choice([0, 0, 1]))) + b
        before = [r.choice([header, noise[3], noise[0], noise[2], noise[4]])() for _ in range(r.choice([1, 2, 2, 3]))]
        after = [r.choice([aside, comments, noise[0], noise[2], noise[4], form])() for _ in range(r.choice([0, 0, 1, 2]))] + [footer()] * (r.random() < 0.85)
        yield f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{margin:0}}</style></head><body>{''.join(before)}{body}{''.join(after)}</body></html>"
