"""Main text of HTML pages: a linear-chain conditional random field over the leaf blocks of a page.

A page is cut into leaf blocks, runs of text between the borders of block elements. Each block has features of its
ancestors (tags, words of classes, ids and roles) and of its text (length, links, marks, place). The field labels
the blocks of a page as main text or not, together, and is decoded by Viterbi's algorithm. It is trained on pages
whose labels are known from their markup, and on the same texts set in other layouts, where articles hold adverts,
comments stand beside them, and the main text may lie in plain containers.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmart.llm.staging import stage

#: Pages the field is trained on, taken by the hash of their ids; each is also set in other layouts.
TRAINING_PAGES = 600
LAYOUTS = 4
CELLS = 1 << 14
STEPS, RATE, PENALTY = 150, 0.3, 1e-3

# Elements by how HTML treats them.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head noscript script style svg template".split())
RAW = frozenset("script style textarea title xmp iframe noembed".split())
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("article aside body div footer form header main nav ol section table td ul dl".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""", re.S)
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")


@dataclass
class Block:
    """Text of a leaf block, its ancestors from the outside in (tag, words of its attributes), letters in links."""

    text: str
    path: tuple[tuple[str, tuple[str, ...]], ...]
    linked: int


def _named(attributes: str) -> tuple[str, ...]:
    found = [a or b or c for _, a, b, c in _NAMES.findall(attributes)] if attributes else []
    return tuple(dict.fromkeys(w for value in found for w in _WORDS.findall(value.lower())))


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order, with character references decoded and white space made single."""
    out: list[Block] = []
    path: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, links, hidden = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, tuple(path), min(linked, len(text))))
            parts.clear()
        linked = 0

    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        tag = None if start < 0 else _TAG.match(page, start) or _LOOSE.match(page, start)
        if start < 0:
            start = size
        piece = page[at : start + (tag is None and start < size)]
        if piece and not hidden:
            parts.append(piece)
            if links:
                linked += len(piece)
        at = tag.end() if tag else start + 1
        if not tag or tag.lastindex is None:
            continue
        closing, name = bool(tag[1]), tag[2].lower()
        if name in RAW and not closing:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            if name in ("textarea", "title", "xmp") and not hidden:
                flush()
                if name != "title":
                    out.append(Block(" ".join(html.unescape(page[at : end.start() if end else size]).split()), (*path, (name, ())), 0))
            at = end.end() if end else size
            continue
        if name == "svg" and tag[3].endswith("/"):
            continue  # closes itself and hides nothing
        if name in HIDDEN:
            flush()
            hidden = max(0, hidden + (-1 if closing else 1)) if name not in ("head",) or closing or not hidden else hidden
            continue
        if name == "body":
            hidden = 0  # an unclosed head ends here
        if name == "br":
            parts.append(" ")
            continue
        if name in INLINE:
            if name == "a":
                links = max(0, links - 1) if closing else 1
            continue
        flush()
        if name in VOID or name in ("html", "body"):
            continue
        if closing:
            for i in range(len(path) - 1, -1, -1):
                if path[i][0] == name:
                    del path[i:]
                    links = 0
                    break
                if path[i][0] in SCOPES and name not in SCOPES:
                    break
            continue
        ends = CLOSES.get(name, ("p",) if name not in INLINE else ())
        for i in range(len(path) - 1, -1, -1):
            if path[i][0] in ends:
                del path[i:]
                break
            if path[i][0] in SCOPES:
                break
        path.append((name, _named(tag[3])))
    flush()
    return [b for b in out if b.text]


def features(page: list[Block]) -> list[list[str]]:
    """Names of the features of each block."""
    out = []
    for i, block in enumerate(page):
        text, n = block.text, len(block.text)
        names = ["bias", f"n{min(n, 2000).bit_length()}", f"l{4 * block.linked // n}", f"w{min(text.count(' '), 300).bit_length()}"]
        names.append("end" + (text[-1] if text[-1] in ".!?:,;" else "a" if text[-1].isalnum() else "o"))
        names.append("first" + ("A" if text[0].isupper() else "a" if text[0].islower() else "o"))
        if "©" in text or "|" in text[:40]:
            names.append("mark")
        names.append(f"place{min(3, 4 * i // len(page))}")
        if block.path:
            names.append("leaf:" + block.path[-1][0])
        for depth, (tag, words) in enumerate(reversed(block.path)):
            names.append("in:" + tag)
            if depth < 2:
                names.append(f"up{depth}:" + tag)
            for word in words[:8]:
                names.append("name:" + word)
                if len(word) > 5:
                    names.append("stem:" + word[:5])
        out.append(list(dict.fromkeys(names)))
    return out


class _Cells(dict):
    def __missing__(self, name: str) -> int:
        if len(self) > 200_000:
            self.clear()
        cell = self[name] = zlib.crc32(name.encode()) % CELLS
        return cell


# Containers of layouts that pages are set in for training.
MAIN = ("<article>", "<main>", '<div class="content">', '<div id="main-content">', '<div class="post-body entry">', '<section class="article-text">', '<div class="story">', '<div itemprop="articleBody" class="body-text">', "<article class='post'>", "<div>")
BESIDE = (
    ("menu", ("<nav>", '<div class="menu">', '<ul class="navigation">', '<div id="topnav">', '<div class="breadcrumbs">', '<div class="pagination">')),
    ("head", ("<header>", '<div class="header">', '<div id="masthead">', '<div class="site-title top-bar">')),
    ("foot", ("<footer>", '<div class="footer">', '<div id="copyright">', '<div class="legal disclaimer">')),
    ("side", ("<aside>", '<div class="sidebar">', '<div class="widget">', '<div class="related-posts">', '<div id="right-rail" class="side">', '<div class="recommended more-stories">')),
    ("notice", ('<div class="cookie-notice">', '<div class="banner">', '<div id="consent" class="gdpr popup modal">', '<div class="alert notice" role="alert">', '<div class="newsletter subscribe">')),
    ("advert", ('<div class="ad">', '<div class="advert">', '<div class="sponsored promo">', '<div id="ads" class="advertisement">')),
    ("form", ("<form>", '<form class="search">', '<div class="login signup">')),
    ("comment", ('<div class="comments">', '<section id="comments">', '<ul class="comment-list">', '<div class="comment reply">', '<div class="discussion responses">')),
    ("share", ('<div class="share social">', '<div class="tags meta">', '<div class="author-bio byline">')),
)


def _close(container: str) -> str:
    return f"</{re.match(r'<([a-z]+)', container)[1]}>"


def layout(main: list[str], other: list[str], rng: random.Random) -> tuple[str, str]:
    """A page with the paragraphs ``main`` as its article among parts made of ``other``; and the article's text."""
    write = lambda text: html.escape(text, quote=False)

    def part(kind: str, container: str) -> str:
        texts = [rng.choice(other) for _ in range(rng.randint(1, 4))]
        if kind == "menu":
            inner = "<ul>" + "".join(f'<li><a href="/x">{write(" ".join(t.split()[:2]))}</a></li>' for t in texts) + "</ul>"
        elif kind == "form":
            inner = f"<label>{write(texts[0][:20])}</label><input name=q><button>Go</button>" + "".join(f"<p>{write(t[:60])}</p>" for t in texts[1:2])
        elif kind == "foot":
            inner = f"&copy; {write(texts[0][:60])} &middot; <a href=/>{write(texts[-1][:12])}</a>"
        elif kind in ("comment", "side") and rng.random() < 0.8:
            inner = "".join(f"<div><p>{write(t)}</p></div>" if rng.random() < 0.5 else f"<p>{write(t)}</p>" for t in texts)
        else:
            inner = rng.choice(["<p>{}</p>", "{}", "<h3>{}</h3>", "<a href=/>{}</a>"]).format(write(texts[0][: rng.choice([30, 120, 400])]))
        return container + inner + _close(container)

    def some(kinds: str) -> str:
        picked = [(k, rng.choice(c)) for k, c in BESIDE if k in kinds.split() and rng.random() < 0.45]
        rng.shuffle(picked)
        return "".join(part(*p) for p in picked)

    tags = [rng.choice(("p", "p", "p", "div", "blockquote", "li", "h2")) if i else rng.choice(("h1", "h2", "p")) for i in range(len(main))]
    body = ""
    for tag, text in zip(tags, main, strict=True):
        words = write(text).split(" ")
        if len(words) > 3 and rng.random() < 0.2:
            words[1] = rng.choice(("<b>{}</b>", '<a href="/y">{}</a>', "<em>{}</em>")).format(words[1])
        body += f"<{tag}>{' '.join(words)}</{tag}>"
        if rng.random() < 0.12:
            body += some("advert side share notice")
    container = rng.choice(MAIN)
    inside = body + (some("comment share side form") if rng.random() < 0.4 else "")
    wrapped = container + inside + _close(container)
    if rng.random() < 0.4:
        wrapped = rng.choice(('<div class="wrapper">{}</div>', '<div id="page"><div>{}</div></div>', "<main>{}</main>")).format(wrapped)
    page = some("menu head notice advert") + wrapped + some("comment side share form advert") + some("foot menu notice")
    return f"<html><head><title>{write(main[0][:40])}</title></head><body>{page}</body></html>", " ".join(" ".join(main).split())


def marked(page: list[Block]) -> list[int] | None:
    """Labels of a page's blocks from its markup, or None where it does not tell: exactly what lies in its article."""
    inside = [any(tag == "article" for tag, _ in b.path) for b in page]
    out = [int(i and not any(t in ("nav", "aside", "footer", "form") for t, _ in b.path)) for i, b in zip(inside, page, strict=True)]
    return out if 0 < sum(out) < len(out) else None


def _labels_of(page: list[Block], text: str) -> list[int] | None:
    """Labels of the blocks of a set page: those that follow one another in ``text``, all of it."""
    out, at = [], 0
    for b in page:
        hit = text.startswith(b.text, at) and (at + len(b.text) == len(text) or text[at + len(b.text)] == " ")
        out.append(int(hit))
        at += (len(b.text) + 1) * hit
    return out if at == len(text) + 1 else None


@dataclass(frozen=True)
class Field:
    """Weights by label and feature cell, and by label and next label."""

    weights: np.ndarray
    steps: np.ndarray

    def decode(self, cells: list[list[int]]) -> list[int]:
        """Viterbi's path through the blocks of a page."""
        if not cells:
            return []
        flat = np.fromiter((c for block in cells for c in block), np.int64)
        starts = np.cumsum([0, *map(len, cells[:-1])])
        scores = np.add.reduceat(self.weights[:, flat], starts, axis=1).T.tolist()
        (a, b), (c, d) = self.steps.tolist()
        x, y = scores[0]
        back = []
        for u, v in scores[1:]:
            back.append((int(y + c > x + a), int(y + d > x + b)))
            x, y = max(x + a, y + c) + u, max(x + b, y + d) + v
        label = int(y > x)
        path = [label]
        for step in reversed(back):
            label = step[label]
            path.append(label)
        return path[::-1]


def fit(pages: list[tuple[list[list[int]], list[int]]]) -> Field:
    """Largest likelihood with a penalty on squared weights: forward-backward over all pages at once, adaptive steps."""
    weights, steps = np.zeros((2, CELLS)), np.zeros((2, 2))
    if not pages:
        return Field(weights, steps)
    pages = sorted(pages, key=lambda p: -len(p[1]))
    n, longest = len(pages), len(pages[0][1])
    lengths = np.array([len(y) for _, y in pages])
    row = np.concatenate([np.full(len(y), i) for i, (_, y) in enumerate(pages)])
    col = np.concatenate([np.arange(len(y)) for _, y in pages])
    truth = np.concatenate([np.array(y) for _, y in pages])
    flat = np.concatenate([np.array(c) for x, _ in pages for c in x])
    owner = np.repeat(np.arange(len(truth)), [len(c) for x, _ in pages for c in x])
    starts = np.searchsorted(owner, np.arange(len(truth)))
    seen = np.stack([np.bincount(flat[truth[owner] == k], minlength=CELLS) for k in (0, 1)]).astype(float)
    follow = (row[1:] == row[:-1]).nonzero()[0]
    seen_steps = np.zeros((2, 2))
    np.add.at(seen_steps, (truth[follow], truth[follow + 1]), 1)
    past, past_steps = np.full_like(weights, 1e-8), np.full((2, 2), 1e-8)
    live = [int((lengths > t).sum()) for t in range(longest)]
    for _ in range(STEPS):
        scores = np.zeros((n, longest, 2))
        scores[row, col] = np.add.reduceat(weights[:, flat], starts, axis=1).T
        ahead, behind = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        ahead[:, 0] = scores[:, 0]
        for t in range(1, longest):
            k = live[t]
            m = ahead[:k, t - 1, :, None] + steps
            ahead[:k, t] = np.logaddexp(m[:, 0], m[:, 1]) + scores[:k, t]
        for t in range(longest - 2, -1, -1):
            k = live[t + 1]
            m = steps + (scores[:k, t + 1] + behind[:k, t + 1])[:, None, :]
            behind[:k, t] = np.logaddexp(m[:, :, 0], m[:, :, 1])
        total = np.logaddexp(ahead[np.arange(n), lengths - 1, 0], ahead[np.arange(n), lengths - 1, 1])
        p = np.exp(ahead + behind - total[:, None, None])[row, col]
        expected = np.stack([np.bincount(flat, weights=p[owner, k], minlength=CELLS) for k in (0, 1)])
        pair = np.zeros((2, 2))
        for t in range(1, longest):
            k = live[t]
            pair += np.exp(ahead[:k, t - 1, :, None] + steps + (scores[:k, t] + behind[:k, t])[:, None, :] - total[:k, None, None]).sum(axis=0)
        slope, slope_steps = (seen - expected) / n - PENALTY * weights, (seen_steps - pair) / n - PENALTY * steps
        past, past_steps = past + slope**2, past_steps + slope_steps**2
        weights, steps = weights + RATE * slope / np.sqrt(past), steps + RATE * slope_steps / np.sqrt(past_steps)
    return Field(weights, steps)


def _training_rows(layouts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _Cells()
        for batch in batches:
            examples = []
            for page in batch["html"]:
                page = page.as_py() or ""
                own = blocks(page)
                labels = marked(own)
                if labels is None:
                    continue
                examples.append((own, labels))
                main = [b.text for b, y in zip(own, labels, strict=True) if y][:40]
                other = [b.text for b, y in zip(own, labels, strict=True) if not y] + main[1:]
                rng = random.Random(zlib.crc32(page.encode("utf-8", "surrogatepass")))
                for _ in range(layouts):
                    made, text = layout(main, other, rng)
                    made_blocks = blocks(made)
                    labels_made = _labels_of(made_blocks, text)
                    if labels_made:
                        examples.append((made_blocks, labels_made))
            rows = [[[cells[f] for f in names] for names in features(x)] for x, _ in examples]
            kind = pa.list_(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(rows, kind), pa.array([y for _, y in examples], pa.list_(pa.int32()))], names=["cells", "labels"])

    return run


def train(pages: DataFrame, many: int = TRAINING_PAGES, layouts: int = LAYOUTS) -> Field:
    """A field from the ``many`` pages (page_id, html) whose ids have the least hashes and whose markup has labels.

    The driver gets numbers of features and labels, no pages.
    """
    some = pages.select("page_id", "html").filter(F.lower("html").contains("<article") & (F.length("html") < 200_000))
    ids = some.select("page_id").filter("page_id is not null").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(many)
    rows = some.join(F.broadcast(stage(ids, "training-pages")), "page_id", "left_semi").select("html")
    examples = rows.mapInArrow(_training_rows(layouts), "cells array<array<int>>, labels array<int>").collect()
    return fit([(r["cells"], r["labels"]) for r in sorted(examples, key=lambda r: (len(r["labels"]), r["cells"]))])


def extract(pages: DataFrame, field: Field) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, n_blocks, n_kept.

    NULL and empty pages, and pages without main text, give an empty text. Repeated rows and NULL ids are kept,
    other columns go.
    """
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _Cells()
        for batch in batches:
            texts, sizes, found, kept = [], [], [], []
            for page in batch["html"]:
                own = blocks(page.as_py() or "")
                labels = field.decode([[cells[f] for f in names] for names in features(own)])
                text = " ".join(b.text for b, y in zip(own, labels, strict=True) if y)
                texts.append(text)
                sizes.append(len(text))
                found.append(len(own))
                kept.append(sum(labels))
            columns = [batch["page_id"], batch["url"], pa.array(texts, pa.string()), *(pa.array(c, pa.int64()) for c in (sizes, found, kept))]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"])

    shape = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long, n_blocks long, n_kept long"
    return pages.select("page_id", "url", "html").mapInArrow(run, shape)
