"""Main-text extraction: a linear-chain conditional random field over the leaf blocks of a page.

The page is scanned once into leaf blocks: runs of text between boundaries of block-level elements, each with its open
ancestors.  A block's features are its ancestors' tags and the words of their class, id and role attributes, its own
tag, link share, length, punctuation and place.  The field's two labels are main text and the rest; weights of
features and of neighbouring labels are trained by gradient ascent on the likelihood (forward-backward) over labelled
pages, and the best labelling of a page is decoded by Viterbi.

The labelled pages are written by `labelled_page`: random layouts of articles, menus, headers, footers, sidebars,
notices, adverts, forms and reader comments in many mark-up habits, with the label known block by block.
"""

from __future__ import annotations

import html as html_lib
import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Elements that never hold readable text.
SILENT = frozenset("script style noscript template head title textarea select option iframe object svg math canvas audio video datalist".split())
#: Of these, those whose content is not mark-up.
RAW = frozenset("script style textarea title iframe noscript".split())
#: What can stand in head; any other start tag ends an open head.
HEAD = frozenset("html head base basefont bgsound link meta title style script noscript noframes template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol optgroup p pre search section summary table caption tbody td tfoot th thead tr ul".split())
#: Start tags that end an open element of the second set, up to the nearest of the third.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_ATTR = re.compile(r"""\b(class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


class Element:
    """An open element: its parent, the nearest block-level tag from it on, its own features and those that no open ancestor has.

    Blocks share their ancestors, so a page's memory grows with its length however deep it nests.
    """

    __slots__ = ("fresh", "name", "near", "own", "parent", "score")

    def __init__(self, parent: Element | None, name: str, own: tuple[str, ...], fresh: list[str]):
        self.parent, self.name, self.own, self.fresh, self.score = parent, name, own, fresh, None
        self.near: str = name if name in BLOCK else parent.near if parent else ""


class Block:
    """A leaf block: its text pieces, characters within links, and the innermost element it stands in."""

    __slots__ = ("element", "linked", "pieces", "text")

    def __init__(self, element: Element | None):
        self.element, self.pieces, self.linked, self.text = element, [], 0, ""


@lru_cache(maxsize=1 << 14)
def _own(name: str, attributes: str) -> tuple[str, ...]:
    """An element's own features: its tag if block-level, and the words of some attributes."""
    words = {w: None for a in _ATTR.finditer(attributes) for w in _WORD.findall((a[2] or a[3] or a[4] or "").lower())}
    return (*[f"word={w}" for w in words], *[f"in={name}"] * (name in BLOCK))


class Stack:
    """Open elements, with the places of each tag and of block-level ones, so that no search walks the stack."""

    def __init__(self):
        self.items: list[Element] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.features: dict[str, int] = {}
        self.silent = 0

    def top(self) -> Element | None:
        return self.items[-1] if self.items else None

    def last(self, names) -> int:
        """Place of the innermost element of one of the names, or -1."""
        return max((p[-1] for n in names if (p := self.places.get(n))), default=-1)

    def inner(self) -> int:
        """Place of the innermost block-level element, or -1."""
        return self.blocks[-1] if self.blocks else -1

    def push(self, name: str, attributes: str) -> None:
        own, held = _own(name, attributes) if len(attributes) < 256 else _own.__wrapped__(name, attributes), self.features
        fresh = [f for f in own if not held.get(f)]
        for f in own:
            held[f] = held.get(f, 0) + 1
        if name in BLOCK:
            self.blocks.append(len(self.items))
        self.silent += name in SILENT
        self.places.setdefault(name, []).append(len(self.items))
        self.items.append(Element(self.top(), name, own, fresh))

    def drop(self, to: int) -> None:
        while len(self.items) > to:
            e = self.items.pop()
            self.places[e.name].pop()
            self.silent -= e.name in SILENT
            if e.name in BLOCK:
                self.blocks.pop()
            for f in e.own:
                self.features[f] -= 1


def scan(page: str) -> list[Block]:
    """Leaf blocks with text, in page order; time and memory grow with the page's length."""
    out: list[Block] = []
    stack = Stack()
    block: Block | None = None
    at, n, last = 0, len(page), page.rfind(">")

    def close(block: Block | None) -> None:
        if block is not None and (text := " ".join("".join(block.pieces).split())):
            block.text = text
            out.append(block)

    def write(raw: str) -> None:
        nonlocal block
        if not raw or stack.silent:
            return
        if block is None:
            if raw.isspace():
                return
            block = Block(stack.top())
        text = html_lib.unescape(raw) if "&" in raw else raw
        block.pieces.append(text)
        if stack.places.get("a"):
            block.linked += len(text)

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            write(page[at:])
            break
        if page.startswith("<!--", lt):
            write(page[at:lt])
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            write(page[at:lt])
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = (_TAG.match(page, lt) or _LOOSE.match(page, lt)) if lt < last else None
        if m is None:
            letter = page[lt + 1 : lt + 3].lstrip("/")[:1]
            if letter.isascii() and letter.isalpha():  # a tag cut off by the end
                write(page[at:lt])
                break
            write(page[at : lt + 1])
            at = lt + 1
            continue
        write(page[at:lt])
        at = m.end()
        name = m[2].lower()
        if not m[1] and name not in HEAD and stack.items and stack.items[-1].name == "head":
            stack.drop(len(stack.items) - 1)
        if name == "br":
            write(" ")
            continue
        if name in BLOCK:
            close(block)
            block = None
        if m[1]:
            i = stack.last((name,))
            if i >= 0 and (name in BLOCK or i > stack.inner()):
                stack.drop(i)
            continue
        if name in VOID:
            continue
        if name in BLOCK and (i := stack.inner()) >= 0 and stack.items[i].name == "p":  # an open paragraph ends here
            stack.drop(i)
        if name in _ENDS:
            shut, stop = _ENDS[name]
            if (i := stack.last(shut)) > stack.last(stop):
                stack.drop(i)
        if name in RAW:
            end = re.compile(f"</{name}", re.I).search(page, at)
            if end is None:
                break
            at = end.start()
        stack.push(name, m[3])
    close(block)
    return out


def own_features(blocks: list[Block]) -> list[list[str]]:
    """Features of each block that don't come from its ancestors."""
    out = []
    for i, b in enumerate(blocks):
        f = ["bias", f"own={b.element.near if b.element else ''}"]
        n, words = len(b.text), b.text.count(" ") + 1
        f.append(f"words={min(6, int(math.log2(words)))}")
        f.append(f"links={min(3, 4 * b.linked // max(n, 1))}")
        f.append(f"stop={b.text[-1] in '.!?…'}")
        if b.text[0] in "©®" or "©" in b.text[:40]:
            f.append("sign")
        f.append(f"place={0 if i == 0 else 4 * i // len(blocks) + 1}")
        out.append(f)
    return out


def features(blocks: list[Block]) -> list[list[str]]:
    """All features of each block: its own, and the tags and words of its ancestors, each once."""
    out = own_features(blocks)
    for b, f in zip(blocks, out, strict=True):
        e = b.element
        while e is not None:
            f += e.fresh
            e = e.parent
    return out


class Field:
    """Linear-chain CRF with two labels: weights of (feature, label), of (label, label) and of the first label."""

    def __init__(self, index: dict[str, int]):
        self.index = index
        self.unary = np.zeros((len(index), 2))
        self.pair = np.zeros((2, 2))
        self.first = np.zeros(2)
        self.table: dict[str, tuple[float, float]] | None = None

    def encode(self, feats: list[list[str]]) -> list[list[int]]:
        get = self.index.get
        return [[i for x in f if (i := get(x)) is not None] for f in feats]

    def score(self, blocks: list[Block]) -> list[list[float]]:
        """Potentials of a page's blocks: what its ancestors add is summed once for each element."""
        if self.table is None:
            self.table = {f: tuple(self.unary[i].tolist()) for f, i in self.index.items()}
        get, out = self.table.get, []

        def more(a: float, b: float, names: list[str]) -> tuple[float, float]:
            for f in names:
                if (w := get(f)) is not None:
                    a += w[0]
                    b += w[1]
            return a, b

        for block, own in zip(blocks, own_features(blocks), strict=True):
            path, e = [], block.element
            while e is not None and e.score is None:
                path.append(e)
                e = e.parent
            sums = e.score if e is not None else (0.0, 0.0)
            for e in reversed(path):
                sums = e.score = more(*sums, e.fresh) if e.fresh else sums
            out.append(list(more(*sums, own)))
        return out

    def potentials(self, rows: list[list[int]]) -> np.ndarray:
        return np.array([self.unary[r].sum(axis=0) for r in rows]).reshape(len(rows), 2)

    def fit(self, data: list[tuple[list[list[int]], list[int]]], epochs: int = 12, rate: float = 0.3, decay: float = 1e-4) -> None:
        """Stochastic gradient ascent (AdaGrad) on the log-likelihood, the gradient by forward-backward."""
        self.table = None
        su, sp, sf = (np.full_like(x, 1e-6) for x in (self.unary, self.pair, self.first))
        for _ in range(epochs):
            for rows, labels in data:
                n = len(rows)
                if not n:
                    continue
                u = self.potentials(rows)
                fwd, back = np.zeros((n, 2)), np.zeros((n, 2))
                fwd[0] = u[0] + self.first
                for i in range(1, n):
                    fwd[i] = u[i] + np.logaddexp.reduce(fwd[i - 1][:, None] + self.pair, axis=0)
                for i in range(n - 2, -1, -1):
                    back[i] = np.logaddexp.reduce(self.pair + (u[i + 1] + back[i + 1])[None, :], axis=1)
                z = np.logaddexp.reduce(fwd[-1])
                node = -np.exp(fwd + back - z)
                node[np.arange(n), labels] += 1
                pair = np.zeros((2, 2))
                for i in range(1, n):
                    pair -= np.exp(fwd[i - 1][:, None] + self.pair + (u[i] + back[i])[None, :] - z)
                    pair[labels[i - 1], labels[i]] += 1
                at = np.array([j for r in rows for j in r])
                grad = np.repeat(node, [len(r) for r in rows], axis=0)
                touched, inverse = np.unique(at, return_inverse=True)
                g = np.zeros((len(touched), 2))
                np.add.at(g, inverse, grad)
                g -= decay * self.unary[touched]
                su[touched] += g * g
                self.unary[touched] += rate * g / np.sqrt(su[touched])
                for w, s, d in ((self.pair, sp, pair), (self.first, sf, node[0])):
                    s += d * d
                    w += rate * d / np.sqrt(s)

    def decode(self, rows: list[list[int]]) -> list[int]:
        """The most likely labels of rows of features."""
        return self.best(self.potentials(rows).tolist())

    def best(self, u: list[list[float]]) -> list[int]:
        """The most likely labels for the potentials of consecutive blocks (Viterbi); ties go to label 0."""
        if not u:
            return []
        (p00, p01), (p10, p11) = self.pair.tolist()
        a, b = u[0][0] + self.first[0], u[0][1] + self.first[1]
        back = []
        for x, y in u[1:]:
            f0, f1 = b + p10 > a + p00, b + p11 > a + p01
            back.append((int(f0), int(f1)))
            a, b = (b + p10 if f0 else a + p00) + x, (b + p11 if f1 else a + p01) + y
        label = int(b > a)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


# -- labelled pages ----------------------------------------------------------------------------------------------

#: Names that sites give to parts of a page.
NAMES = {
    "main": "article content main post entry story body text article-body post-content entry-content main-content story-body page-content single",
    "menu": "nav menu navbar navigation main-nav top-menu breadcrumb breadcrumbs topbar mega-menu tabs pagination pager links",
    "head": "header masthead site-header page-header branding logo top banner hero site-title tagline",
    "foot": "footer site-footer page-footer bottom copyright legal colophon credits footer-links",
    "side": "sidebar side aside widget related recommended popular trending rail secondary more-stories read-next teaser recent tags tag-cloud author-box archive",
    "note": "cookie cookies consent notice alert gdpr privacy popup modal overlay cookie-banner warning announcement paywall message toast disclaimer",
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion banner-ad ad-slot adsbygoogle partner commercial offer",
    "form": "form search newsletter subscribe signup login contact search-form register subscription",
    "talk": "comments comment comment-list reply replies discussion disqus responses reader-comments comment-body respond feedback thread",
    "share": "share social sharing social-links share-buttons follow like",
}
_TAGS = {
    "main": ["article", "article", "main", "div", "section", "td"],
    "menu": ["nav", "nav", "div", "ul", "header"],
    "head": ["header", "header", "div"],
    "foot": ["footer", "footer", "div"],
    "side": ["aside", "aside", "div", "section"],
    "note": ["div", "section", "aside", "p", "dialog"],
    "ad": ["div", "div", "aside", "section", "ins", "p"],
    "form": ["form", "form", "div"],
    "talk": ["section", "div", "ol", "ul", "article"],
    "share": ["div", "ul"],
}
_SYLLABLES = "an er on re in th en ou st al de la qu ie ch un ei au lo mi sa tor".split()


def _word(r: random.Random) -> str:
    return "".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4)))


def _sentence(r: random.Random, lo: int = 4, hi: int = 18) -> str:
    return " ".join(_word(r) for _ in range(r.randint(lo, hi))).capitalize() + r.choice("...!?")


def _prose(r: random.Random, sentences: int) -> str:
    return " ".join(_sentence(r) for _ in range(r.randint(1, sentences)))


def _open(r: random.Random, kind: str) -> tuple[str, str]:
    tag = r.choice(_TAGS[kind])
    name = r.choice(NAMES[kind].split())
    plain = tag in ("article", "main", "nav", "footer", "header", "aside", "form")
    how = r.random()
    attr = "" if plain and how < 0.6 else f' class="{name}{r.choice(["", "", " box", " wrap", "-1"])}"' if how < 0.9 else f' id="{name}"'
    return f"<{tag}{attr}>", f"</{tag}>"


def labelled_page(seed: int) -> tuple[str, list[int]]:
    """A page and the label of each of its leaf blocks: 1 for main text."""
    r = random.Random(seed)
    out: list[str] = ["<!DOCTYPE html><html><head><title>", _sentence(r), "</title><style>p{margin:0}</style></head><body>"]
    labels: list[int] = []

    def put(tag: str, text: str, label: int) -> None:
        out.append(f"<{tag}>{text}" + ("" if tag in ("p", "li") and r.random() < 0.3 else f"</{tag}>"))
        labels.append(label)

    def linked(tag: str = "li") -> None:
        put(tag, f'<a href="/{_word(r)}">{" ".join(_word(r) for _ in range(r.randint(1, 6)))}</a>', 0)

    def boiler(kind: str) -> None:
        a, b = _open(r, kind)
        out.append(a)
        if kind in ("menu", "share") or kind in ("side", "foot") and r.random() < 0.4:
            bare = a.startswith("<ul") or r.random() < 0.2
            out.append("" if bare else "<ul>")
            for _ in range(r.randint(2, 7)):
                linked()
            out.append("" if bare else "</ul>")
        elif kind == "talk":
            for _ in range(r.randint(1, 5)):
                if r.random() < 0.5:
                    put(r.choice(["h4", "div", "p"]), f"<a href='#'>{_word(r)}</a> {r.randint(1, 28)}", 0)
                put(r.choice(["p", "p", "div", "li"]), _prose(r, 4), 0)
        elif kind == "form":
            for _ in range(r.randint(1, 3)):
                put(r.choice(["label", "p", "div", "h3", "button"]), _sentence(r, 1, 9), 0)
            out.append('<input type="text">')
        elif kind == "foot":
            if r.random() < 0.8:
                sign = r.choice(["&copy; ", "&copy; 2024 ", "Copyright &copy; ", "© "])
                text = sign + _word(r) + ".example &middot; " + _prose(r, 2)
                if r.random() < 0.5:
                    out.append(text)
                    labels.append(0)
                else:
                    put("p", text, 0)
            else:
                put("p", _prose(r, 2), 0)
        else:
            if r.random() < 0.4:
                put(r.choice(["h2", "h3", "h4", "p", "div"]), _sentence(r, 1, 5), 0)
            if r.random() < 0.5 and not a.startswith("<p"):
                for _ in range(r.randint(1, 3)):
                    put(r.choice(["p", "div", "li"]), _prose(r, 3), 0)
            elif a.startswith("<p") and labels and out[-1] != a:
                out.append("")
            else:
                out.append(_prose(r, 2))
                labels.append(0)
        out.append(b)

    def main() -> None:
        bare = r.random() < 0.05
        a, b = ("", "") if bare else _open(r, "main")
        out.append(a)
        if r.random() < 0.85:
            put(r.choice(["h1", "h1", "h2"]), _sentence(r, 2, 14).rstrip("."), 1)
        inner = r.random() < 0.3
        out.append('<div class="%s">' % r.choice(NAMES["main"].split()) if inner else "")
        for _ in range(r.choice([1, 2, 3, 4, 6, 9, 14])):
            x = r.random()
            if x < 0.14:
                put("p", _sentence(r, 1, 4), 1)
            elif x < 0.72:
                put("p", r.choice(["", "", "<b>", "<em>x</em> "]) + _prose(r, 8) + r.choice(["", "", "", "<br>"]), 1)
            elif x < 0.8:
                put(r.choice(["h2", "h3"]), _sentence(r, 1, 8).rstrip("."), 1)
            elif x < 0.88:
                out.append("<ul>")
                for _ in range(r.randint(2, 5)):
                    put("li", _sentence(r, 2, 14), 1)
                out.append("</ul>")
            elif x < 0.93:
                put("blockquote", _prose(r, 3), 1)
            elif x < 0.96:
                put("p", f'{_sentence(r)} <a href="/x">{_word(r)}</a> {_sentence(r)}', 1)
            else:
                put(r.choice(["pre", "figcaption", "div"]), _sentence(r, 3, 12), 1)
            if r.random() < 0.06:
                boiler(r.choice(["ad", "share", "side", "form", "note"]))
        out.append("</div>" if inner else "")
        if r.random() < 0.08:
            boiler("talk")
        out.append(b)

    def some(kinds: list[str]) -> None:
        for k in kinds:
            if r.random() < 0.55:
                boiler(k)

    top = ["note", "head", "menu", "ad", "form"]
    r.shuffle(top)
    some(top)
    wrap = r.random() < 0.3
    out.append('<div class="%s">' % r.choice(["wrapper", "container", "row", "page", "site", "layout"]) if wrap else "")
    if r.random() < 0.2:
        boiler("side")
    main()
    out.append("</div>" if wrap else "")
    end = ["side", "talk", "form", "ad", "share"]
    r.shuffle(end)
    some(end)
    if r.random() < 0.9:
        boiler("foot")
    if r.random() < 0.2:
        boiler("note")
    out.append("</body></html>" if r.random() < 0.9 else "")
    return "".join(out), labels


def labelled(seeds: range) -> list[tuple[list[list[str]], list[int]]]:
    """Features and labels of those pages whose blocks are as many as the labels."""
    out = []
    for seed in seeds:
        page, labels = labelled_page(seed)
        blocks = scan(page)
        if len(blocks) == len(labels):
            out.append((features(blocks), labels))
    return out


@lru_cache(maxsize=4)
def trained(pages: int = 700) -> Field:
    """The field trained on that many labelled pages; the same everywhere."""
    data = labelled(range(pages))
    index: dict[str, int] = {}
    for feats, _ in data:
        for f in feats:
            for x in sorted(f):
                index.setdefault(x, len(index))
    field = Field(index)
    field.fit([(field.encode(f), y) for f, y in data])
    return field


def main_text(page: str | None, field: Field) -> str:
    """Main-text blocks joined by one space; '' for a null page or one without any."""
    blocks = scan(page or "")
    labels = field.best(field.score(blocks))
    return " ".join([b.text for b, y in zip(blocks, labels, strict=True) if y])


def extract(pages: DataFrame, key: str = "page_id", body: str = "html", also: tuple[str, ...] = ("url",), field: Field | None = None) -> DataFrame:
    """Per row: key, the columns of `also`, text, n_chars (code points).

    A null or empty page has ''; null keys stay null; repeated rows give repeated results; an empty table gives an
    empty one; no other column is read.
    """
    held = pages.sparkSession.sparkContext.broadcast(field or trained())
    names = [key, *also]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                text = [main_text(p, model) for p in part.column(len(names)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], [*[f"c{i}" for i in range(len(names))], "text", "n_chars"])

    schema = ", ".join(f"c{i} {pages.schema[c].dataType.simpleString()}" for i, c in enumerate(names))
    rows = pages.select(*[pages[c].alias(f"c{i}") for i, c in enumerate(names)], pages[body].cast("string").alias("b"))
    return rows.mapInArrow(run, f"{schema}, text string, n_chars bigint").toDF(*names, "text", "n_chars")
