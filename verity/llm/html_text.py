"""Main text of web pages by a tree-structured graphical model over DOM nodes.

Each node of a page's tree is content or not.  A node has a potential from what it is (tag, words of
its class and id, length and make-up of its text, share of links); each parent-child pair has one from
the child's kind.  Sum-product messages, from the leaves up and from the root down, give every node's
marginal, and a text is kept where its marginal reaches one half.  Weights are learned by gradient
ascent on the likelihood of labelled pages, with expectations from the same messages.  The labelled
pages are drawn from a grammar of page layouts (``labelled_pages``), where each block is marked.

Messages run level by level over all pages of a slice at once, so the work is in numpy.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_CHARS = 2_000_000
#: Attributes of this length or more are parsed anew each time, so the memory of those kept is bounded.
KEPT_CHARS = 500
TRAIN_PAGES = 500
EPOCHS = 150

# Fixed values of the HTML standard: elements without content, with raw text, that end an open
# paragraph, that stay within a line, and that are never shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
HIDDEN = frozenset("head script style title noscript template iframe object svg math canvas audio video map textarea select option datalist button".split())
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split()
)
#: An opening tag ends these, up to the element that bounds the search.
ENDS_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BOUNDS = frozenset("ul ol dl table menu select body html article section div".split())

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)", re.S)
#: An attribute, as the HTML standard reads it: a quote opens a value only right after the equals sign.
_ATTRIBUTE = r"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+"""
#: The rest of a tag up to its end, or to the end of the page; nothing is given back, so time is linear.
_REST = re.compile(rf"((?:[\s/]++|{_ATTRIBUTE})*+)(?:>|\Z)")
_NAMED = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+""")
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"[ \t\n\r\f\v]+")
FEATURES = 1 << 12
KINDS = 6
TEXT = "#text"


def _feature(name: str) -> int:
    """A stable slot for a feature's name."""
    h = 2166136261
    for b in name.encode():
        h = (h ^ b) * 16777619 & 0xFFFFFFFF
    return (h ^ h >> 15) % FEATURES


def _parsed(tag: str, attributes: str) -> tuple[tuple[int, ...], int, bool]:
    """Features, kind and whether hidden, of an element as written."""
    found = [(m[1].lower(), m[2] or m[3] or m[4] or "") for m in _NAMED.finditer(attributes)]
    names = " ".join(value for name, value in found if name in ("class", "id", "role"))
    plain = any(name == "hidden" for name, _ in found)
    words = list(dict.fromkeys(_WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", names).lower())))
    found = [f"tag {tag}"] + [f"name {w}" for w in words] + [f"name {w[:-1]}" for w in words if w.endswith("s") and len(w) > 3]
    kind = 1 if tag in INLINE else 2 if words else 3 if tag in ("p", "li", "td", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "dd", "dt") else 4
    return tuple(_feature(x) for x in dict.fromkeys(found)), kind, tag in HIDDEN or plain


_parsed_before = lru_cache(maxsize=20_000)(_parsed)


def _element(tag: str, attributes: str) -> tuple[tuple[int, ...], int, bool]:
    """``_parsed``, kept for attributes of usual length; long ones are parsed each time, whole."""
    return _parsed_before(tag, attributes) if len(attributes) < KEPT_CHARS else _parsed(tag, attributes)


def _block_features(text: str, linked: int, parent: str) -> tuple[int, ...]:
    """Features of a block of running text: ``linked`` characters of it are in links."""
    n = len(text)
    size = 0 if n < 12 else 1 if n < 40 else 2 if n < 120 else 3 if n < 400 else 4
    stops = text.count(". ") + text.count(".\n") + text.rstrip().endswith((".", "!", "?", "…"))
    share = 0 if not linked else 1 if 2 * linked < n else 2
    place = parent if parent in ENDS_P or parent in ("li", "td", "body", "div") else "line" if parent in INLINE else "other"
    found = (f"size {size}", f"linked {share}", f"size {size} linked {share}", f"stops {min(stops, 3)} size {size}", f"in {place}", f"in {place} size {size} linked {share}")
    return tuple(_feature(x) for x in found)


_PIECE = (_feature("piece of a block"),)


class Forest:
    """The trees of several pages: arrays over nodes, parents before children."""

    def __init__(self):
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.kind: list[int] = []
        self.node_features: list[tuple[int, ...]] = []
        self.page: list[int] = []
        self.texts: list[tuple[int, int, str, bool]] = []  # node, page, text, whether it starts a new block
        self.tags: list[str] = []
        self.pages = 0

    def _node(self, parent: int, tag: str, features: tuple, kind: int) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.kind.append(kind)
        self.node_features.append(features)
        self.tags.append(tag)
        return len(self.parent) - 1

    def add(self, source: str) -> None:
        """Parse one page, tolerant of unclosed and unopened elements."""
        page, self.pages = self.pages, self.pages + 1
        root = self._node(-1, "#root", (_feature("root"),), 0)
        stack = [(root, "#root", False)]
        open_tags: dict[str, int] = {}
        hidden = 0
        linked = 0
        breaks = True
        at = 0
        block: list[tuple[int, str, int]] = []  # nodes of the running block: node, text, characters in links

        def end_block() -> None:
            if block:
                joined = "".join(t for _, t, _ in block)
                first = block[0][0]
                self.node_features[first] = _block_features(joined.strip(), sum(n for *_, n in block), self.tags[self.parent[first]])
                block.clear()

        def pop_to(size: int) -> None:
            nonlocal hidden, linked, breaks
            while len(stack) > size:
                _, tag, hides = stack.pop()
                open_tags[tag] -= 1
                hidden -= hides
                linked -= tag == "a"
                breaks = breaks or tag not in INLINE

        def text(piece: str) -> None:
            nonlocal breaks
            if hidden or not piece:
                return
            piece = entities.unescape(piece) if "&" in piece else piece
            shown = piece.strip(" \t\n\r\f\v")
            if not shown:
                if self.texts and self.texts[-1][1] == page and not breaks:
                    self.texts.append((-1, page, " ", False))
                return
            if breaks:
                end_block()
            node = self._node(stack[-1][0], TEXT, _PIECE, 5)
            block.append((node, piece, len(piece) if linked else 0))
            self.texts.append((node, page, piece, breaks))
            breaks = False

        while at <= len(source):
            m = _MARKUP.search(source, at)
            if m is None:
                text(source[at:])
                break
            if m.start() > at:
                text(source[at : m.start()])
            at = m.end()
            tag = m[2]
            if tag is None:
                continue
            rest = _REST.match(source, at)
            at = rest.end()
            tag = tag.lower()
            if m[1]:
                if open_tags.get(tag):
                    k = len(stack) - 1
                    while stack[k][1] != tag:
                        k -= 1
                    pop_to(k)
                breaks = breaks or tag not in INLINE
                continue
            breaks = breaks or tag not in INLINE
            if tag in VOID:
                continue
            if tag in ENDS_P and open_tags.get("p"):
                k = len(stack) - 1
                while stack[k][1] != "p" and stack[k][1] not in ("button", "table", "td", "th"):
                    k -= 1
                if stack[k][1] == "p":
                    pop_to(k)
            if tag in ENDS_SAME:
                k = len(stack) - 1
                while k > 0 and stack[k][1] not in ENDS_SAME[tag] and stack[k][1] not in BOUNDS:
                    k -= 1
                if stack[k][1] in ENDS_SAME[tag]:
                    pop_to(k)
            if tag in ("body", "frameset") and open_tags.get("head"):
                pop_to(next(k for k, s in enumerate(stack) if s[1] == "head"))
            attributes = rest[1]
            features, kind, hides = _element(tag, attributes)
            if attributes.endswith("/") and tag not in ("p", "div", "a", "span"):
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                at = end.end() if end else len(source) + 1
                continue
            node = self._node(stack[-1][0], tag, features, kind)
            stack.append((node, tag, hides))
            open_tags[tag] = open_tags.get(tag, 0) + 1
            hidden += hides
            linked += tag == "a"
        end_block()


def _log_add(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(x[..., 0], x[..., 1])


class Model:
    """Weights: per feature (towards content) and, per kind of child, a 2 x 2 table of (parent, child)."""

    def __init__(self):
        self.unary = np.zeros(FEATURES)
        self.pair = np.zeros((KINDS, 2, 2))

    @staticmethod
    def layout(forest: Forest) -> dict:
        parent, depth = np.array(forest.parent, np.int64), np.array(forest.depth, np.int64)
        many = np.array([len(f) for f in forest.node_features])
        order = np.argsort(depth, kind="stable")
        edges = np.searchsorted(depth[order], np.arange(depth.max() + 2)) if len(depth) else np.zeros(1, np.int64)
        return {
            "parent": parent, "kind": np.array(forest.kind, np.int64),
            "features": np.array([f for own in forest.node_features for f in own], np.int64), "owner": np.repeat(np.arange(len(parent)), many),
            "levels": [order[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)],
        }

    def messages(self, g: dict) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of nodes (n, 2) and of parent-child pairs (n, 2, 2), by one sweep up and one down."""
        n, parent = len(g["parent"]), g["parent"]
        score = np.bincount(g["owner"], self.unary[g["features"]], n)
        belief = np.stack([np.zeros(n), score], axis=1)  # own potential and messages from children
        up = np.zeros((n, 2))
        table = self.pair[g["kind"]]
        for level in reversed(g["levels"][1:]):
            up[level] = _log_add(table[level] + belief[level][:, None, :])
            for s in (0, 1):
                np.add.at(belief[:, s], parent[level], up[level, s])
        down = np.zeros((n, 2))
        joint = np.zeros((n, 2, 2))
        for level in g["levels"][1:]:
            above = belief[parent[level]] + down[parent[level]] - up[level]
            both = table[level] + above[:, :, None]
            down[level] = _log_add(np.swapaxes(both, 1, 2))
            both = both + belief[level][:, None, :]
            joint[level] = np.exp(both - both.max(axis=(1, 2), keepdims=True))
            joint[level] /= joint[level].sum(axis=(1, 2), keepdims=True)
        total = belief + down
        marginal = np.exp(total - total.max(axis=1, keepdims=True))
        return marginal / marginal.sum(axis=1, keepdims=True), joint

    def fit(self, forest: Forest, labels: np.ndarray) -> Model:
        """Gradient ascent (with momentum and a Gaussian prior) on the likelihood of the labels."""
        g = self.layout(forest)
        child = np.flatnonzero(g["parent"] >= 0)
        seen = np.bincount(g["features"], labels[g["owner"]].astype(float), FEATURES)
        pairs = np.zeros_like(self.pair)
        np.add.at(pairs, (g["kind"][child], labels[g["parent"][child]], labels[child]), 1)
        scale = np.sqrt(np.bincount(g["features"], minlength=FEATURES) + 1.0)
        speed, pair_speed, pages = np.zeros(FEATURES), np.zeros_like(self.pair), np.sqrt(len(labels))
        for _ in range(EPOCHS):
            marginal, joint = self.messages(g)
            gap = seen - np.bincount(g["features"], marginal[g["owner"], 1], FEATURES) - 0.5 * self.unary
            expected = np.zeros_like(self.pair)
            np.add.at(expected, g["kind"][child], joint[child])
            speed = 0.8 * speed + 0.2 * gap / scale
            pair_speed = 0.8 * pair_speed + 0.2 * (pairs - expected - 0.5 * self.pair) / pages
            self.unary += 0.3 * np.clip(speed, -2, 2)
            self.pair += 0.1 * np.clip(pair_speed, -2, 2)
        return self


#: Layout words of the grammar below: class or id names of the parts that are not the article.
ASIDES = {
    "nav": ("nav", "menu", "navbar", "navigation", "breadcrumb", "pagination", "toc", "topnav", "menu links"),
    "header": ("header", "masthead", "site header", "top banner", "logo", "branding", "topbar"),
    "footer": ("footer", "site footer", "copyright", "bottom", "legal", "colophon"),
    "side": ("sidebar", "aside", "widget", "related", "recommended", "popular posts", "rail", "trending", "tags", "share social", "author bio"),
    "notice": ("notice", "cookie banner", "cookie", "consent", "gdpr", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "paywall", "message", "disclaimer"),
    "ad": ("ad", "ads", "advert", "advertisement", "banner", "sponsor", "sponsored", "promo", "promotion", "ad slot", "adsense"),
    "form": ("form", "search", "login", "signup", "contact form", "search box", "feedback"),
    "comments": ("comments", "comment", "comment list", "reply", "replies", "discussion", "disqus", "respond", "reader comments"),
}
BODIES = ("article", "content", "post", "entry content", "main", "story body", "post content", "article body", "text", "page content", "")


def labelled_pages(count: int, seed: int = 17) -> Iterator[tuple[str, list[bool]]]:
    """Pages drawn from a grammar of layouts, each with the labels of its texts in order."""
    rng = np.random.default_rng(seed)
    pick = lambda options: options[int(rng.integers(len(options)))]
    chance = lambda p: rng.random() < p

    def words(n: int) -> str:
        return " ".join("".join(chr(97 + int(c)) for c in rng.integers(0, 26, int(rng.integers(2, 9)))) for _ in range(max(1, n)))

    def sentence(n: int) -> str:
        return words(n).capitalize() + pick(".....!?")

    def prose(most: int) -> str:
        if chance(0.08):
            return sentence(int(rng.integers(1, 3)))
        if chance(0.06):
            return " ".join([words(1) + pick(("", ",", ".", " |"))] * int(rng.integers(2, 60)))
        if chance(0.06):
            return pick((" | ", "!! ", " ### ", ". ")).join(words(1).upper() for _ in range(int(rng.integers(1, 40))))
        return " ".join(sentence(int(rng.integers(3, 18))) for _ in range(int(rng.integers(1, most + 1))))

    def named(tag: str, names: str, inside: str) -> str:
        attribute = pick(("class", "class", "id"))
        return f'<{tag} {attribute}="{names}">{inside}</{tag}>' if names else f"<{tag}>{inside}</{tag}>"

    def boilerplate(part: str, labels: list[bool]) -> str:
        names = pick(ASIDES[part])
        if part == "nav" or part in ("side", "footer", "header") and chance(0.5):
            items = int(rng.integers(2, 8))
            labels += [False] * items
            rows = "".join(f'<li><a href="/{words(1)}">{words(int(rng.integers(1, 4)))}</a></li>' for _ in range(items))
            inside = f"<ul>{rows}</ul>"
        elif part == "form":
            labels.append(False)
            inside = f'<label>{words(2)}</label><input name="q"><button>{words(1)}</button>'
        elif part == "comments":
            inside = ""
            for _ in range(int(rng.integers(1, 4))):
                labels += [False, False]
                inside += named(pick(("div", "li", "article", "section")), pick(("comment", "comment body", "reply", "")), f"<b>{words(1)}</b><p>{prose(3)}</p>")
        else:
            labels.append(False)
            inside = prose(4) if chance(0.6) else f"<p>{prose(2)}</p>"
        semantic = {"nav": "nav", "header": "header", "footer": "footer", "side": "aside", "form": "form", "comments": "section"}.get(part)
        if semantic and chance(0.6):
            return named(semantic, names if chance(0.4) or part == "comments" else "", inside)
        return named(pick(("div", "div", "section", "aside", "p" if "<" not in inside else "div")), names, inside)

    def article(labels: list[bool]) -> str:
        out = ""
        if chance(0.8):
            labels.append(True)
            out += f"<h1>{words(int(rng.integers(2, 9)))}</h1>"
        for _ in range(int(rng.integers(1, 9))):
            r = rng.random()
            if r < 0.72:
                if chance(0.15):
                    labels += [True, True, True]
                    inner = pick((f'<a href="/x">{words(2)}</a>', f"<b>{words(1)}</b>", f"<em>{words(3)}</em>"))
                    out += f"<p>{words(int(rng.integers(1, 9)))} {inner} {prose(3)}</p>"
                elif chance(0.2):
                    labels.append(True)
                    out += f"<p><b>{prose(4)}<br>"
                else:
                    labels.append(True)
                    out += f"<p>{prose(5)}</p>"
            elif r < 0.79:
                labels.append(True)
                out += f"<{(h := pick(('h2', 'h3')))}>{words(4)}</{h}>"
            elif r < 0.85:
                items = int(rng.integers(2, 5))
                labels += [True] * items
                out += "<ul>" + "".join(f"<li>{sentence(6)}</li>" for _ in range(items)) + "</ul>"
            elif r < 0.89:
                labels.append(True)
                out += f"<blockquote>{prose(2)}</blockquote>"
            elif r < 0.92:
                labels += [True, True]
                out += f"<table><tr><td>{words(2)}</td><td>{words(3)}</td></tr></table>"
            else:
                out += boilerplate(pick(("ad", "side", "notice", "nav", "form")), labels)
        if chance(0.12):
            out += boilerplate("comments", labels)
        return out

    for _ in range(count):
        labels: list[bool] = []
        out = "<!DOCTYPE html><html><head><title>x</title></head><body>"
        if chance(0.3):
            out += boilerplate("notice", labels)
        for part in ("header", "nav"):
            if chance(0.6):
                out += boilerplate(part, labels)
        for part in ("ad", "side", "notice", "form"):
            if chance(0.25):
                out += boilerplate(part, labels)
        if chance(0.08):
            bare = [True] * int(rng.integers(1, 6))
            labels += bare
            yield out + pick(("", "<br>")).join(f"<p>{prose(5)}</p>" if len(bare) > 1 or chance(0.5) else sentence(15) for _ in bare), labels
            continue
        body = named(pick(("article", "article", "main", "div", "div", "section")), pick(BODIES) if chance(0.6) else "", article(labels))
        if chance(0.4):
            body = named(pick(("main", "div", "section")), pick(("", "wrapper", "container", "page", "layout", "content")), body + (boilerplate("side", labels) if chance(0.4) else ""))
        out += body
        for part, p in (("comments", 0.35), ("side", 0.3), ("ad", 0.2), ("form", 0.15), ("footer", 0.8), ("notice", 0.1)):
            if chance(p):
                out += boilerplate(part, labels)
        yield out + ("</body></html>" if chance(0.9) else ""), labels


def node_labels(forest: Forest, texts: list[bool]) -> np.ndarray:
    """Labels of all nodes from those of the texts: an element is content if most of its text is."""
    weight = np.zeros((len(forest.parent), 2))
    shown = [t for t in forest.texts if t[0] >= 0]
    if len(shown) != len(texts):
        raise ValueError("labels do not fit the page's texts")
    for (node, _, text, _), content in zip(shown, texts, strict=True):
        weight[node, int(content)] += len(text)
    for node in range(len(forest.parent) - 1, 0, -1):
        if forest.parent[node] >= 0:
            weight[forest.parent[node]] += weight[node]
    return (weight[:, 1] > weight[:, 0]).astype(np.int64)


@lru_cache(maxsize=2)
def trained(pages: int = TRAIN_PAGES, seed: int = 17) -> Model:
    forest, labels = Forest(), []
    for source, own in labelled_pages(pages, seed):
        forest.add(source)
        labels += own
    return Model().fit(forest, node_labels(forest, labels))


def main_texts(sources: list[str | None], model: Model) -> list[str]:
    """The main text of each page."""
    forest = Forest()
    for source in sources:
        forest.add(source or "")
    marginal = model.messages(Model.layout(forest))[0][:, 1] if forest.parent else np.zeros(0)
    parts: list[list[str]] = [[] for _ in sources]
    gap = [False] * len(sources)
    for node, page, text, starts in forest.texts:
        if node < 0:
            if parts[page]:
                parts[page].append(" ")
        elif marginal[node] >= 0.5:
            if starts or gap[page]:
                parts[page].append(" ")
            parts[page].append(text)
            gap[page] = False
        else:
            gap[page] = True
    return [_SPACE.sub(" ", "".join(p)).strip(" ") for p in parts]


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars per row of ``pages`` (page_id, url, html; others ignored).

    A null or empty html, or one without content, has an empty text and 0 characters.  Null ids and
    urls pass; rows that repeat a page_id are separate rows; an empty table gives none.
    """
    shared = pages.sparkSession.sparkContext.broadcast(trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum([len(x.as_py() or "") for x in batch.column("html")])
            lo = 0
            while lo < batch.num_rows:
                before = sizes[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(sizes, before + SLICE_CHARS, side="right")))
                part = batch.slice(lo, hi - lo)
                texts = main_texts(part.column("html").to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )
                lo = hi

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
