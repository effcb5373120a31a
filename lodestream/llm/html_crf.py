"""Main text of HTML pages by a linear-chain conditional random field.

A page is cut into DOM leaf blocks: the runs of text directly inside a block
element. Each block has features from its ancestor tags (with class, id and role
words) and from its text; the field labels the chain of blocks as content or not.
It is trained on labelled pages and decoded by Viterbi.

The labelled pages are the given pages' own blocks laid out again: a bounded
sample of pages whose markup says what is content (an ``article`` element, with
menus, adverts and footers outside it) yields passages of both kinds, which are
set into several layouts, with and without telling tags, whose labels are known.
Where no page says so, a few passages held here are set into the same layouts.

Blocks share their ancestors, and what the ancestors add to a block's score is
added up once per element, so that deep markup costs time and memory in
proportion to the page.
"""

from __future__ import annotations

import html as html_module
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bounds on the pages whose passages make up the labelled pages: how many, and how long and deep each is at most.
FIT_PAGES = 300
FIT_CHARS = 1 << 18
FIT_DEPTH = 64
DIMENSION = 1 << 14
RESULT = "page_id bigint, url string, text string, n_chars bigint"

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
# Their content is not text, whatever it looks like.
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "math", "noembed", "noframes", "xmp", "object", "select", "head"}
_OPAQUE = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub "
    "sup time tt u var wbr input".split()
)
_CLOSES_P = set(
    "address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p "
    "pre section table ul".split()
)
_CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = {"ul", "ol", "dl", "table", "select"}
_TELLING = ("class", "id", "role")


class Node:
    """An open element: its tag, its telling words and the element around it."""

    __slots__ = ("tag", "words", "parent", "depth", "article", "sums")

    def __init__(self, tag: str, words: str, parent: Node | None):
        self.tag, self.words, self.parent = tag, words, parent
        self.depth = parent.depth + 1 if parent else 1
        self.article = tag == "article" or (parent is not None and parent.article)
        self.sums: tuple[float, float] | None = None


class Block:
    __slots__ = ("text", "node", "links", "marks")

    def __init__(self, text: str, node: Node | None, links: int, marks: int):
        self.text, self.node, self.links, self.marks = text, node, links, marks

    @property
    def own(self) -> str:
        return self.node.tag if self.node else "none"

    @property
    def path(self) -> list[tuple[str, str]]:
        """(tag, telling words) of the ancestors, outermost first."""
        out, node = [], self.node
        while node:
            out.append((node.tag, node.words))
            node = node.parent
        return out[::-1]


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks in page order, without hidden and raw elements, white space folded."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, bool, Node | None]] = []
    # Where each tag is open, and where any tag but the inline ones, so that no step walks the stack.
    places: dict[str, list[int]] = {}
    outer: list[int] = []
    run: list[str] = []
    hidden = links = linked = marks = 0
    place = 0

    def flush() -> None:
        nonlocal run, linked, marks
        if run:
            text = " ".join(html_module.unescape("".join(run)).split())
            if text:
                out.append(Block(text, stack[outer[-1]][2] if outer else None, linked, marks))
        run, linked, marks = [], 0, 0

    def close(upto: int) -> None:
        nonlocal hidden, links
        while len(stack) > upto:
            tag, hides, _ = stack.pop()
            places[tag].pop()
            if tag not in _INLINE:
                outer.pop()
            hidden -= hides
            links -= tag == "a"

    def last(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    def add(text: str) -> None:
        nonlocal linked
        if text and not hidden:
            run.append(text)
            if links:
                linked += len(text.strip())

    while place < len(page):
        found = _TOKEN.search(page, place)
        if found is None:
            tail = page[place:]
            # A tag cut off at the end of the page is no text.
            at = re.search(r"<[/!?a-zA-Z]", tail)
            add(tail[: at.start()] if at else tail)
            break
        add(page[place : found.start()])
        place = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            at = last((tag,))
            if tag in _INLINE:
                # An inline element ends only where no other element was opened inside.
                if at > (outer[-1] if outer else -1):
                    close(at)
                continue
            flush()
            if at >= 0:
                close(at)
            continue
        if tag in _INLINE:
            marks += 1
            if tag in ("br", "wbr", "img", "input"):
                add(" " if tag == "br" else "")
                continue
        else:
            flush()
            if tag in _CLOSES_P:
                if outer and stack[outer[-1]][0] == "p":
                    close(outer[-1])
            elif tag in _CLOSES_SAME:
                at = last(_CLOSES_SAME[tag])
                if at > last(_SCOPES):
                    close(at)
        if tag in _VOID:
            continue
        attributes = {a.lower(): b or c or d for a, b, c, d in _ATTRIBUTE.findall(found[3])} if "=" in found[3] else {}
        bare = re.sub(r"\"[^\"]*\"|'[^']*'", "", found[3])
        hides = tag in _RAW or bool(re.search(r"\bhidden\b(?!\s*=)", bare)) or attributes.get("aria-hidden") == "true" or bool(_HIDING.search(attributes.get("style", "")))
        if tag in _OPAQUE:
            end = re.compile(f"</{tag}\\s*>", re.I).search(page, place)
            place = end.end() if end else len(page)
            continue
        if bare.rstrip().endswith("/") and tag in ("svg", "math"):
            continue
        words = " ".join(attributes.get(a, "") for a in _TELLING).strip()
        node = None
        if tag not in _INLINE:
            node = Node(tag, words, stack[outer[-1]][2] if outer else None)
            outer.append(len(stack))
        places.setdefault(tag, []).append(len(stack))
        stack.append((tag, hides, node))
        hidden += hides
        links += tag == "a"
    flush()
    return out


def element_features(tag: str, words: str) -> list[str]:
    """Names of the features that an ancestor turns on: its tag and the words of its attributes."""
    return [f"in={tag}"] + [f"attr={w.lower()}" for w in set(_WORDS.findall(words))]


def features(block: Block) -> list[str]:
    """Names of the features that are on, but for those of the ancestors: own tag, text bins."""
    text, own = block.text, block.own
    out = ["bias", f"own={own}", f"depth={min(block.node.depth if block.node else 0, 12)}"]
    n = len(text)
    words = text.split()
    size = min(9, n.bit_length())
    linked = 10 * block.links // max(1, n)
    ends = text[-1] in ".!?:;\"'”»"
    commas = sum(text.count(c) for c in ",.;")
    out += [f"size={size}", f"link={min(linked, 10)}", f"ends={ends}", f"commas={min(commas, 6)}", f"own={own}:size={size}", f"words={min(len(words), 12)}"]
    if text[:1] == "©" or "©" in text:
        out.append("copyright")
    if re.search(r"\d", text):
        out.append("digits")
    return out


_CODES: dict[str, int] = {}


def _code(name: str) -> int:
    code = _CODES.get(name)
    if code is None:
        import zlib

        code = zlib.crc32(name.encode()) % DIMENSION
        if len(_CODES) < 100_000:
            _CODES[name] = code
    return code


def own_codes(chain: list[Block]) -> list[list[int]]:
    """Feature codes per block, with the neighbours' element and size, without the ancestors'."""
    out = [[_code(f) for f in features(b)] for b in chain]
    own = [f"{b.own}:{min(9, len(b.text).bit_length())}" for b in chain]
    for i, codes in enumerate(out):
        codes.append(_code(f"before={own[i - 1] if i else 'start'}"))
        codes.append(_code(f"after={own[i + 1] if i + 1 < len(own) else 'end'}"))
    return out


def encode(chain: list[Block]) -> list[list[int]]:
    """All feature codes per block, as the field is trained on them."""
    return [codes + [_code(f) for step in b.path for f in element_features(*step)] for codes, b in zip(own_codes(chain), chain)]


class Field:
    """Weights of a two-label linear chain: per feature and label, and per step."""

    def __init__(self, emit: np.ndarray, step: np.ndarray):
        self.emit, self.step = emit, step

    def viterbi(self, codes: list[list[int]]) -> list[int]:
        return self.decode(self._sums(codes).tolist())

    def _sums(self, codes: list[list[int]]) -> np.ndarray:
        flat = np.fromiter((c for row in codes for c in row), np.int64)
        starts = np.cumsum([0, *map(len, codes)])[:-1]
        return np.add.reduceat(self.emit[flat], starts, axis=0) if codes else np.zeros((0, 2))

    def labels(self, chain: list[Block]) -> list[int]:
        """Best labels of a page's blocks; every element's part is added up once."""
        scores = self._sums(own_codes(chain)).tolist()
        for row, block in zip(scores, chain):
            if block.node:
                no, yes = self._around(block.node)
                row[0] += no
                row[1] += yes
        return self.decode(scores)

    def _around(self, node: Node) -> tuple[float, float]:
        above: list[Node] = []
        up: Node | None = node
        while up is not None and up.sums is None:
            above.append(up)
            up = up.parent
        no, yes = up.sums if up is not None and up.sums else (0.0, 0.0)
        for n in reversed(above):
            own = self.emit[[_code(f) for f in element_features(n.tag, n.words)]].sum(0).tolist()
            no, yes = no + own[0], yes + own[1]
            n.sums = (no, yes)
        return no, yes

    def decode(self, scores: list[list[float]]) -> list[int]:
        """Viterbi over scores per block and label."""
        if not scores:
            return []
        (a, b), (c, d) = self.step.tolist()
        back = []
        no, yes = scores[0]
        for s in scores[1:]:
            from_no, from_yes = no + a >= yes + c, no + b > yes + d
            back.append((0 if from_no else 1, 0 if from_yes else 1))
            no, yes = (no + a if from_no else yes + c) + s[0], (no + b if from_yes else yes + d) + s[1]
        label = int(yes > no)
        labels = [label]
        for choice in reversed(back):
            label = choice[label]
            labels.append(label)
        return labels[::-1]


def _marginals(scores: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of labels and of neighbouring label pairs (forward-backward)."""
    n = len(scores)
    forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
    forward[0] = scores[0]
    for i in range(1, n):
        forward[i] = scores[i] + np.logaddexp(forward[i - 1, 0] + step[0], forward[i - 1, 1] + step[1])
    for i in range(n - 2, -1, -1):
        onward = step + scores[i + 1] + backward[i + 1]
        backward[i] = np.logaddexp(onward[:, 0], onward[:, 1])
    total = np.logaddexp(forward[-1, 0], forward[-1, 1])
    pairs = np.exp(forward[:-1, :, None] + step[None] + (scores[1:] + backward[1:])[:, None, :] - total)
    return np.exp(forward + backward - total), pairs


def train(chains: list[tuple[list[list[int]], list[int]]], epochs: int = 5, rate: float = 0.2, decay: float = 1e-5, seed: int = 3) -> Field:
    """Adagrad on the conditional log likelihood, a chain at a time."""
    emit, step = np.zeros((DIMENSION, 2)), np.zeros((2, 2))
    emit_sum, step_sum = np.full((DIMENSION, 2), 1e-2), np.full((2, 2), 1e-2)
    rng = np.random.default_rng(seed)
    prepared = []
    for codes, labels in chains:
        if codes:
            flat = np.fromiter((c for row in codes for c in row), np.int64)
            lengths = np.array([len(row) for row in codes])
            prepared.append((flat, lengths, np.concatenate([[0], np.cumsum(lengths)[:-1]]), np.array(labels)))
    for _ in range(epochs):
        for i in rng.permutation(len(prepared)):
            flat, lengths, starts, labels = prepared[i]
            single, pairs = _marginals(np.add.reduceat(emit[flat], starts, axis=0), step)
            single[np.arange(len(labels)), labels] -= 1
            grown = np.repeat(single, lengths, axis=0)
            used, where = np.unique(flat, return_inverse=True)
            g = np.zeros((len(used), 2))
            np.add.at(g, where, grown)
            g += decay * emit[used]
            emit_sum[used] += g * g
            emit[used] -= rate * g / np.sqrt(emit_sum[used])
            if len(labels) > 1:
                s = pairs.sum(0)
                np.subtract.at(s, (labels[:-1], labels[1:]), 1)
                step_sum += s * s
                step -= rate * s / np.sqrt(step_sum)
    return Field(emit, step)


# Names that site templates give to the parts of a page, content last.
_PARTS = {
    "menu": (["nav", "div", "ul", "header"], "menu nav navbar navigation breadcrumb breadcrumbs topbar toolbar tabs links toc pagination pager skip".split()),
    "header": (["header", "div"], "header masthead banner site-header branding logo page-header head top hero tagline".split()),
    "footer": (["footer", "div", "section"], "footer site-footer bottom copyright legal colophon foot credits imprint".split()),
    "sidebar": (["aside", "div", "section"], "sidebar widget rail related recommended popular trending tags archive more-stories side secondary".split()),
    "advert": (["div", "aside", "section", "ins"], "ad ads advert advertisement sponsor sponsored promo banner-ad adsense commercial".split()),
    "notice": (["div", "section", "dialog"], "cookie cookies consent notice gdpr alert popup modal overlay newsletter subscribe paywall signup".split()),
    "comments": (["div", "section", "ol"], "comments comment discussion replies reply responses disqus respond thread feedback".split()),
    "form": (["form", "div"], "search login contact form subscribe-form search-form register".split()),
    "share": (["div", "ul"], "share social sharing follow share-buttons buttons social-links".split()),
    "byline": (["div", "aside"], "author-box related-posts post-tags metadata".split()),
}
_CONTENT = (["article", "main", "div", "section"], "article content post entry story main body post-content entry-content article-body text page-content main-content blog-post".split())


def layouts(passages: list[str], asides: list[str], rng: random.Random) -> str:
    """One labelled page: content passages carry a mark, and so do blocks of other parts."""

    def attributes(names: list[str]) -> str:
        kind = rng.choice(["class", "class", "id", "none"])
        if kind == "none":
            return ""
        name = rng.choice(names)
        if rng.random() < 0.2:
            name = f"{rng.choice(['site', 'page', 'js', 'l', 'block', 'main'])}-{name}"
        return f' {kind}="{name}"'

    def part(name: str) -> str:
        tags, names = _PARTS[name]
        tag = rng.choice(tags)
        given = attributes(names)
        if not given and tag in ("div", "section", "ul", "ol"):
            given = f' class="{rng.choice(names)}"'
        short = [" ".join(rng.choice(asides).split()[: rng.randint(1, 4)]) for _ in range(rng.randint(1, 6))]
        if tag in ("ul", "ol") or (name in ("menu", "share") and rng.random() < 0.7):
            inner = "".join(f'<li><a href="/x">{s}</a></li>' for s in short)
            inner = inner if tag in ("ul", "ol") else f"<ul>{inner}</ul>"
        elif name == "comments":
            inner = "".join(f'<div class="comment"><p>{rng.choice(passages + asides)}</p></div>' if rng.random() < 0.5 else f"<p>{rng.choice(passages + asides)}</p>" for _ in range(rng.randint(1, 4)))
            if rng.random() < 0.5:
                inner = f"<h3>{short[0]}</h3>" + inner
        elif name == "form":
            inner = f'<label>{short[0]}</label><input name="q"><button>{short[-1]}</button>'
        elif name == "footer":
            inner = rng.choice([f"&copy; example.org &middot; {rng.choice(asides)}", f"<p>&copy; 2020 {short[0]}</p>", f"<p>{rng.choice(asides)}</p>"])
        elif name == "header" and rng.random() < 0.5:
            inner = f'<a href="/">{short[0]}</a><p>{" ".join(short)}</p>'
        elif name == "sidebar" and rng.random() < 0.6:
            inner = f"<h3>{short[0]}</h3>" + "".join(f'<p><a href="/y">{s}</a></p>' for s in short) + (f"<p>{rng.choice(asides)}</p>" if rng.random() < 0.5 else "")
        else:
            inner = rng.choice(["<p>{}</p>", "{}", "<div>{}</div>", "<span>{}</span>"]).format(rng.choice(asides + [rng.choice(passages)]))
        return f"<{tag}{given}>{inner}</{tag}>"

    mark = "\x01"
    tag = rng.choice(_CONTENT[0])
    given = attributes(_CONTENT[1])
    if not given and tag in ("div", "section"):
        given = f' class="{rng.choice(_CONTENT[1])}"' if rng.random() < 0.85 else ""
    plain = rng.random() < 0.2
    if plain:
        tag, given = "div", ""
    inner = []
    for i, p in enumerate(passages):
        style = rng.random()
        if i == 0 and style < 0.8:
            title = f"<h1>{mark}{p[:80]}</h1>"
            inner.append(f"<header>{title}</header>" if rng.random() < 0.15 else title)
            inner.append(f"<p>{mark}{p}</p>")
        elif style < 0.08:
            inner.append(f"<h{rng.randint(2, 4)}>{mark}{' '.join(p.split()[:6])}</h2>")
        elif style < 0.14:
            inner.append("<ul>" + "".join(f"<li>{mark}{' '.join(p.split()[k : k + 9])}</li>" for k in range(0, 27, 9) if p.split()[k : k + 9]) + "</ul>")
        elif style < 0.18:
            inner.append(f"<blockquote>{mark}{p}</blockquote>")
        elif style < 0.22:
            inner.append(f"<div>{mark}{p}</div>")
        elif style < 0.25:
            inner.append(f"<pre>{mark}{p}</pre>")
        elif style < 0.28:
            inner.append(f"<table><tr><td>{mark}{p[:30]}</td><td>{mark}{p[30:60] or p}</td></tr></table>")
        elif style < 0.45:
            inner.append(f"<p>{mark}<b>{p}<br></p>")
        else:
            inner.append(f'<p>{mark}{p[:40]}<a href="/z">{p[40:60]}</a>{p[60:]}</p>' if style > 0.9 else f"<p>{mark}{p}</p>")
        if 0 < i and rng.random() < 0.05:
            inner.append(part(rng.choice(["advert", "share", "sidebar"])))
    body = f"<{tag}{given}>{''.join(inner)}</{tag}>"
    if rng.random() < 0.3:
        body = f'<div class="{rng.choice(["container", "wrapper", "row", "layout", "page", "col"])}">{body}</div>'
    if rng.random() < 0.25:
        body = f"<main>{body}</main>"
    if rng.random() < 0.15:
        # Columns made with a table: menus and adverts in the cells beside the content.
        name = rng.choice(["menu", "sidebar", "advert"])
        beside = "".join(f'<a href="/x">{" ".join(rng.choice(asides).split()[:3])}</a> ' for _ in range(rng.randint(1, 4)))
        cells = [f'<td class="{rng.choice(_PARTS[name][1])}">{beside if rng.random() < 0.7 else rng.choice(asides)}</td>', f"<td>{body}</td>"]
        if rng.random() < 0.4:
            cells = [cells[1], cells[0]]
        body = f"<table><tr>{''.join(cells)}</tr></table>"
    names = list(_PARTS)
    before = [part(n) for n in ["menu", "header", "notice", "advert", "sidebar", "share", "form"] if rng.random() < 0.45]
    after = [part(n) for n in ["footer", "comments", "sidebar", "share", "notice", "form", "advert", "byline"] if rng.random() < 0.45]
    if plain and rng.random() < 0.5:
        after = []
    if rng.random() < 0.1:
        rng.shuffle(names)
        before.append(part(names[0]))
    return f"<html><body>{''.join(before)}{body}{''.join(after)}</body></html>"


Chain = tuple[list[list[int]], list[int]]


def laid_out(passages: list[str], asides: list[str], copies: int, seed: int) -> list[Chain]:
    """Passages and other parts in several layouts, with labels per block."""
    out = []
    rng = random.Random(seed)
    clean, other = [html_module.escape(p) for p in passages], [html_module.escape(a) for a in asides]
    for _ in range(copies):
        chain = blocks(layouts(clean[: rng.randint(1, len(clean))], other, rng))
        labels = []
        for b in chain:
            labels.append(int("\x01" in b.text))
            b.text = b.text.replace("\x01", "") or "."
        out.append((encode(chain), labels))
    return out


def labelled(page: str, copies: int, seed: int) -> list[Chain]:
    """The page itself, and its passages in other layouts, with labels per block.
    Nothing from pages without an article, without other parts, or with deeper markup than ``FIT_DEPTH``."""
    own = blocks(page)
    inside = [b.node is not None and b.node.article for b in own]
    passages, asides = [b.text for b, i in zip(own, inside) if i], [b.text for b, i in zip(own, inside) if not i]
    if not passages or not asides or any(b.node and b.node.depth > FIT_DEPTH for b in own):
        return []
    return [(encode(own), [int(i) for i in inside]), *laid_out(passages, asides, copies, seed)]


# Passages to train on where no page of the table says what its content is.
_PASSAGES = [
    "How the harbour froze",
    "In the second week of January the harbour froze from the pier to the lighthouse, and for nine days no ship could leave.",
    "The fishermen walked out across the ice with sledges. They cut holes by hand, lowered their lines and talked about the winter of their grandfathers.",
    "Nobody was hurt, although a horse broke through near the customs house and had to be pulled out with ropes.",
    "When the wind turned to the south-west, the ice went out in a single night; by morning only a white rim was left along the quay.",
    "Measurements at the old tide gauge go back to 1871. They show that such winters came about every twelve years, and that the last one before this was in 1987.",
]
_ASIDES = ["Home", "About us", "Contact", "Sign in", "Read more", "Subscribe to our newsletter", "All rights reserved", "Share this page", "We use cookies to improve this site.", "Sponsored: try it free for thirty days"]


def _least(pages: DataFrame, most: int) -> DataFrame:
    """The ``most`` smallest different hashes ``h``; no task sends more than that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64)
        for batch in batches:
            held = np.unique(np.concatenate([held, batch.column(0).to_numpy()]))[:most]
        yield pa.RecordBatch.from_arrays([pa.array(held)], names=["h"])

    return pages.select("h").mapInArrow(run, "h bigint").distinct().orderBy("h").limit(most)


def fit(pages: DataFrame, most: int = FIT_PAGES, copies: int = 6) -> Field:
    """Train on a fixed sample of at most ``most`` different pages of at most ``FIT_CHARS``
    characters that have an ``article``, picked by a hash; without any, on built-in passages.
    There are about ``most * copies`` layouts in all."""
    usable = pages.select("page_id", "html", F.xxhash64("page_id", "html").alias("h")).where(
        (F.length("html") <= FIT_CHARS) & F.lower("html").contains("<article")
    )
    # Hashes first, so that no more pages than the sample's are moved, each once.
    last = _least(usable, most).agg(F.max("h")).first()[0]
    chosen = usable.where(F.col("h") <= F.lit(last)).dropDuplicates(["h"]).collect() if last is not None else []
    sample = sorted((r["h"], r["page_id"] or 0, r["html"]) for r in chosen)
    # The fewer pages there are, the more layouts each is set into.
    copies = most * copies // max(1, len(sample))
    chains = [chain for i, (_, _, page) in enumerate(sample) for chain in labelled(page, copies, i)]
    return train(chains or laid_out(_PASSAGES, _ASIDES, copies, 0))


def main_text(page: str | None, field: Field) -> str:
    chain = blocks(page)
    keep = field.labels(chain)
    return "\n\n".join(b.text for b, k in zip(chain, keep) if k)


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) per row; null and empty pages have an empty text. Map-only.

    Repeated rows are extracted each; markup cut off anywhere ends with the page.
    """
    field = field or fit(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), field) for page in batch.column(2)]
            arrays = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("bigint"), "url", "html").mapInArrow(run, RESULT)
