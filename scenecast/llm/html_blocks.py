"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags, each with the
path of open tags and their class, id and role words.  A block's vector holds the sum of
learned vectors of its path words, the mean of those of its hashed words, and three
plain numbers.  A bidirectional LSTM in numpy reads the blocks of the whole page in
order and gives each a probability of being main text; blocks of at least one half
are kept and joined by a newline.

Training needs no hand labels.  Pages of a bounded sample (``TRAIN_PAGES`` of smallest
hash, ``TRAIN_BLOCKS`` blocks at most) are labelled by where their blocks stand: in an
article and in none of the page parts that are never main text.  So that the network knows parts
the sample lacks, each training page is also shown with such parts put in at random
places, filled with words of other pages, and with other wrappers around the article.  Weights
go to the tasks; extraction is a column expression without shuffle, some pages at a time.

What names a page part: an element's name, or a class, id or role word of the block's
containers.  The words of body and html never do, and those of the article and its wrappers
only as marks of one word ("sidebar", not "has-sidebar" or "header-fixed").

Scripts, styles, comments and other raw elements never become blocks, nor does what
a reader is not shown of an element in ``UNSEEN``: it goes up to the element's own end
tag (nested ones counted).  Without that tag the element ends with its parent and its
words stay.  An svg or math ends at ``/>`` and before an html element; the words of
math are text.  White space (line breaks too) becomes one space, character references
are decoded.

Edge cases: null and empty html give the empty text; cut-off tags, unclosed raw elements
and unknown references are read as browsers do; elements nested deeper than ``MAX_DEPTH``
become siblings (no text is lost); repeated pages are read each; pages
without main text give the empty text; an empty table gives an empty result.
"""

from __future__ import annotations

import html as html_lib
import re
import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenecast.llm.common import require

PATH_SLOTS, WORD_SLOTS = 1 << 12, 1 << 9
DIM, HIDDEN = 16, 12
TRAIN_PAGES, TRAIN_BLOCKS, TRAIN_HTML = 200, 60, 60_000
EPOCHS, BATCH, RATE = 10, 24, 0.02
GROUP_BLOCKS = 4_096
MAX_DEPTH = 512      # open elements; browsers stop nesting there too

# HTML element names.
RAW = {"script", "style", "textarea", "title", "iframe"}
UNSEEN = {"noscript", "template", "object", "svg", "select", "canvas", "video", "audio"}
FOREIGN = {"svg", "math"}       # their elements are all inline and may end with "/>"
HTML_INSIDE = {"foreignobject", "annotation-xml"}      # html again inside them
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn",
          "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp",
          "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
          "img", "br", "button", "input"}
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Html elements that end an open svg or math.
BREAKS_OUT = {"article", "aside", "b", "big", "blockquote", "body", "br", "center", "code", "dd",
              "div", "dl", "dt", "em", "embed", "footer", "form", "h1", "h2", "h3", "h4", "h5",
              "h6", "head", "header", "hr", "i", "img", "li", "listing", "main", "menu", "meta",
              "nav", "nobr", "ol", "p", "pre", "ruby", "s", "section", "small", "span", "strike",
              "strong", "sub", "sup", "table", "tt", "u", "ul", "var"}
# Page parts that are never main text: element names, and words of class, id and role.
PARTS = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
PART_WORDS = {"ad", "ads", "advert", "advertisement", "banner", "sponsor", "sponsored", "promo",
              "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header",
              "masthead", "footer", "sidebar", "aside", "widget", "related", "recommended",
              "comment", "comments", "reply", "replies", "discussion", "cookie", "cookies",
              "consent", "notice", "gdpr", "newsletter", "subscribe", "signup", "login",
              "search", "form", "share", "social", "popup", "modal", "alert", "copyright",
              "complementary", "contentinfo", "disqus", "pagination", "pager", "toolbar"}
MAIN_WORDS = {"article", "main", "content", "post", "entry", "story"}
# First and last words of marks that tell a state or a layout and no part ("has-sidebar").
STATE_FIRST = {"has", "no", "not", "with", "without", "is", "hide", "hides", "show", "shows"}
STATE_LAST = {"open", "closed", "fixed", "sticky", "static", "results", "enabled", "disabled",
              "active", "visible", "hidden", "factor"}

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
    r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|([^<]+|<)", re.DOTALL)
_CUT_TAG = re.compile(r"</?[a-zA-Z][^<>]*\Z")
_MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME = re.compile(r"[a-z0-9]+")
_HIDES = re.compile(rf"<(?:{'|'.join(sorted(UNSEEN | FOREIGN))})(?=[\s/>])", re.I)


def mark_words(marks: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Words of an element's class, id and role: as a page part, and as a wrapper of the article.

    A mark of one word names a part in both.  A mark of several words ("site-header") names one only
    where it stands by itself, and never if it tells a state ("has-sidebar"): else it is one
    long word.
    """
    part: list[str] = []
    wrapper: list[str] = []
    for mark in marks.split():
        words = _NAME.findall(mark)
        whole = words if len(words) == 1 else ["-".join(words)] if words else []
        wrapper += whole
        state = len(words) > 1 and (words[0] in STATE_FIRST or words[-1] in STATE_LAST)
        part += whole if state else words
    return tuple(part), tuple(wrapper)


def path_words(stack) -> tuple[str, ...]:
    """Names and words of the open block elements.

    The words of html and body say nothing about a block.  The innermost article or main and what
    wraps it name parts by marks of one word only.
    """
    outer = [(n, words) for n, words, inline, _ in stack if not inline]
    last = max((i for i, (n, _) in enumerate(outer) if n in ("article", "main")), default=-1)
    return tuple(w for i, (n, (part, wrapper)) in enumerate(outer) for w in (
        f"<{n}>", *(() if n in ("html", "body") else wrapper if i <= last else part)))


@dataclass
class Block:
    """A leaf of the page: its text, the words of its path, and characters in links."""

    text: str
    path: tuple[str, ...]
    linked: int


def blocks_of(html: str | None) -> list[Block]:
    """Leaf blocks of a page in order."""
    html = _CUT_TAG.sub("", html or "")
    ends: dict[int, int] = {}
    if _HIDES.search(html):
        _read(html, ends, True)            # first which hidden elements have an end tag
    return _read(html, ends, False)


def _is_foreign(stack: list[tuple[str, tuple[tuple, tuple], bool, int]]) -> bool:
    """Whether the innermost element belongs to an svg or math."""
    for name, *_ in reversed(stack):
        if name in FOREIGN or name in HTML_INSIDE:
            return name in FOREIGN
    return False


def _read(html: str, ends: dict[int, int], look: bool) -> list[Block]:
    """Blocks of a page without hidden elements.

    ``ends`` maps where the tag of a hidden element ends to where its end tag does.  With
    ``look`` it is filled and hidden elements are read like others.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[tuple, tuple], bool, int]] = []   # name, words, inline, place
    parts: list[str] = []
    linked, pos, size = 0, 0, len(html)
    any_foreign = False

    def flush() -> None:
        nonlocal linked
        if parts and not look:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, path_words(stack), linked))
        parts.clear()
        linked = 0

    while pos < size:
        m = _TOKEN.match(html, pos)
        pos = m.end()
        close, name, attrs, text = m.groups()
        if text is not None:
            parts.append(text)
            if any(n == "a" for n, *_ in stack):
                linked += len(text)
            continue
        if name is None:
            continue
        name = name.lower()
        foreign = any_foreign and _is_foreign(stack)
        if foreign and not close and name in BREAKS_OUT:
            while foreign:
                stack.pop()
                foreign = _is_foreign(stack)
        if name == "head":
            continue                       # all it may hold is raw, hidden or void
        if name in RAW and not close and not foreign:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, pos)
            pos = end.end() if end else size
            continue
        if name == "br" or name.startswith("annotation"):
            parts.append(" ")
        if name in VOID and not foreign:
            if name == "hr":
                flush()
            continue
        own = attrs.rstrip().endswith("/")
        if close:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            inline = name in INLINE if at is None else all(e[2] for e in stack[at:])
            if name not in INLINE and not inline:
                flush()
            if at is not None and (name not in INLINE or inline):
                if look:
                    ends[stack[at][3]] = pos
                del stack[at:]
            continue
        hidden = name in UNSEEN or foreign and name in RAW
        inline = name in INLINE or foreign or name in FOREIGN
        if hidden and not look:
            if pos in ends:
                pos = ends[pos]
                continue
            if not inline:
                continue                   # it has no end tag: what follows is its parent's
        if not inline:
            flush()
        shut = set() if inline or hidden else CLOSES.get(name, {"p"})
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in shut:
                del stack[i:]
                break
            if not stack[i][2] or stack[i][0] in HTML_INSIDE:
                break
        if own and (foreign or name in FOREIGN or not inline and not hidden):
            continue
        if len(stack) >= MAX_DEPTH:
            stack.pop()                # like browsers: no deeper, a sibling of the last one
        any_foreign = any_foreign or name in FOREIGN
        marks = " ".join(v for found in _MARKS.findall(attrs) for v in found).lower()
        stack.append((name, mark_words(marks), inline, pos if hidden else -1))
    flush()
    return out


def weak_label(block: Block, has_article: bool) -> int:
    """Training label from the block's place: 1 in the article, 0 in any other page part."""
    names = {w[1:-1] for w in block.path if w[0] == "<"}
    words = {w for w in block.path if w[0] != "<"}
    if names & PARTS or words & PART_WORDS:
        return 0
    if "article" in names or "main" in names or words & MAIN_WORDS:
        return 1
    return int(not has_article)


# --- vectors --------------------------------------------------------------

def _slot(word: str, slots: int) -> int:
    return zlib.crc32(word.encode()) % slots


def features(page: list[Block]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
    """Path slots, word hashes and plain numbers of every block."""
    known: dict[tuple[str, ...], list[int]] = {}
    for b in page:
        if b.path not in known:
            known[b.path] = [_slot(w, PATH_SLOTS) for w in dict.fromkeys(b.path)]
    paths = [known[b.path] for b in page]
    words = [list(map(zlib.crc32, b.text.lower().encode().split())) or [0] for b in page]
    plain = np.array([[min(len(b.text), 2000) / 500, b.linked / max(1, len(b.text)), 1.0]
                      for b in page], dtype=np.float32).reshape(-1, 3)
    return paths, words, plain


def _bags(lists: list[list[int]], slots: int, mean: bool
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat slots, the row of each, and its weight."""
    sizes = np.array([len(x) for x in lists])
    flat = np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(sizes.sum())) % slots
    row = np.repeat(np.arange(len(lists)), sizes)
    weight = np.repeat(1 / np.maximum(sizes, 1) if mean else np.ones(len(lists)), sizes)
    return flat, row, weight.astype(np.float32)


def _vectors(table: np.ndarray, bags, rows: int) -> np.ndarray:
    flat, row, weight = bags
    out = np.zeros((rows, table.shape[1]), dtype=np.float32)
    if len(flat):
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        out[row[starts]] = np.add.reduceat(table[flat] * weight[:, None], starts, axis=0)
    return out


SHAPES = {"path": (PATH_SLOTS, DIM), "word": (WORD_SLOTS, DIM),
          "wf": (2 * DIM + 3 + HIDDEN, 4 * HIDDEN), "bf": (4 * HIDDEN,),
          "wb": (2 * DIM + 3 + HIDDEN, 4 * HIDDEN), "bb": (4 * HIDDEN,),
          "out": (2 * HIDDEN,), "off": (1,)}


def start_weights(seed: int = 11) -> dict[str, np.ndarray]:
    """Path and word vectors start at zero, so what training never saw adds nothing."""
    rng = np.random.default_rng(seed)
    w = {k: np.zeros(s, dtype=np.float32) for k, s in SHAPES.items()}
    for k in ("wf", "wb"):
        w[k] = rng.normal(0, 0.3, SHAPES[k]).astype(np.float32)
    for k in ("bf", "bb"):
        w[k][HIDDEN:2 * HIDDEN] = 1.0          # forget gates start open
    w["out"] = rng.normal(0, 0.3, SHAPES["out"]).astype(np.float32)
    return w


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(x: np.ndarray, mask: np.ndarray, w: np.ndarray, b: np.ndarray):
    """Hidden states of steps x pages x features, and what the way back needs.

    Rows past a page's end keep their state, so padding on either side is never read.
    """
    steps, pages, _ = x.shape
    h = np.zeros((pages, HIDDEN), dtype=np.float32)
    c = h.copy()
    out, trace = np.zeros((steps, pages, HIDDEN), dtype=np.float32), []
    for t in range(steps):
        z = np.concatenate([x[t], h], axis=1)
        g = z @ w + b
        i, f, o = (_sigmoid(g[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
        u = np.tanh(g[:, 3 * HIDDEN:])
        new_c = f * c + i * u
        tc = np.tanh(new_c)
        m = mask[t][:, None]
        trace.append((z, i, f, o, u, c, tc, m))
        c = np.where(m, new_c, c)
        h = np.where(m, o * tc, h)
        out[t] = h
    return out, trace


def _lstm_back(d_out: np.ndarray, trace, w: np.ndarray):
    d_w, d_b = np.zeros_like(w), np.zeros(w.shape[1], dtype=np.float32)
    width = w.shape[0] - HIDDEN
    d_x = np.zeros((*d_out.shape[:2], width), dtype=np.float32)
    d_h = np.zeros(d_out.shape[1:], dtype=np.float32)
    d_c = d_h.copy()
    for t in range(len(trace) - 1, -1, -1):
        z, i, f, o, u, c, tc, m = trace[t]
        d_h = d_h + d_out[t]
        dh, dc = np.where(m, d_h, 0), np.where(m, d_c, 0)
        dc = dc + dh * o * (1 - tc * tc)
        d_g = np.concatenate([dc * u * i * (1 - i), dc * c * f * (1 - f),
                              dh * tc * o * (1 - o), dc * i * (1 - u * u)], axis=1)
        d_w += z.T @ d_g
        d_b += d_g.sum(axis=0)
        d_z = d_g @ w.T
        d_x[t] = d_z[:, :width]
        d_h = np.where(m, d_z[:, width:], d_h)
        d_c = np.where(m, dc * f, d_c)
    return d_x, d_w, d_b


def forward(w: dict[str, np.ndarray], pages: list[list[Block]], train: bool = False):
    """Probability of every block of every page (a list of arrays)."""
    flat = [b for p in pages for b in p]
    paths, words, plain = features(flat)
    bags = _bags(paths, PATH_SLOTS, False), _bags(words, WORD_SLOTS, True)
    x = np.concatenate([_vectors(w["path"], bags[0], len(flat)),
                        _vectors(w["word"], bags[1], len(flat)), plain], axis=1)
    sizes = np.array([len(p) for p in pages])
    page = np.repeat(np.arange(len(pages)), sizes)
    step = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    grid = np.zeros((int(sizes.max()), len(pages), x.shape[1]), dtype=np.float32)
    grid[step, page] = x
    mask = np.arange(len(grid))[:, None] < sizes[None, :]
    ahead, trace_f = _lstm(grid, mask, w["wf"], w["bf"])
    back, trace_b = _lstm(grid[::-1], mask[::-1], w["wb"], w["bb"])
    states = np.concatenate([ahead, back[::-1]], axis=2)[step, page]
    prob = _sigmoid(states @ w["out"] + w["off"][0])
    if not train:
        return np.split(prob, np.cumsum(sizes)[:-1])
    return prob, (bags, x, step, page, grid, trace_f, trace_b, states)


def _gradients(w, pages, labels) -> dict[str, np.ndarray]:
    prob, (bags, x, step, page, grid, trace_f, trace_b, states) = forward(w, pages, True)
    delta = ((prob - labels) / len(labels)).astype(np.float32)
    d_states = np.zeros((*grid.shape[:2], 2 * HIDDEN), dtype=np.float32)
    d_states[step, page] = delta[:, None] * w["out"]
    dx_f, d_wf, d_bf = _lstm_back(d_states[:, :, :HIDDEN], trace_f, w["wf"])
    dx_b, d_wb, d_bb = _lstm_back(d_states[::-1, :, HIDDEN:], trace_b, w["wb"])
    d_x = (dx_f + dx_b[::-1])[step, page]
    grads = {"wf": d_wf, "bf": d_bf, "wb": d_wb, "bb": d_bb, "out": states.T @ delta,
             "off": np.array([delta.sum()], dtype=np.float32)}
    for name, (slots, row, weight), a in (("path", bags[0], 0), ("word", bags[1], DIM)):
        grads[name] = np.zeros_like(w[name])
        np.add.at(grads[name], slots, d_x[row, a:a + DIM] * weight[:, None])
    return grads


# --- training pages -------------------------------------------------------

def _varied(page: list[Block], spare: list[str], rng) -> list[Block]:
    """The page with page parts put in at random places and maybe another wrapper."""
    wrapper = [("<article>",), ("<main>",), ("<div>", "content"), ("<div>", "post"),
               ("<main>", "<article>"), ("<div>", "main", "<article>", "entry")][rng.integers(6)]
    out = []
    for b in page:
        path = b.path
        if "<article>" in path:
            at = path.index("<article>")
            path = path[:at] + wrapper + path[at + 1:]
        out.append(Block(b.text, path, b.linked))
    names, words = sorted(PARTS), sorted(PART_WORDS)
    for _ in range(rng.integers(2, 7)):
        if rng.random() < 0.4:
            part: tuple[str, ...] = (f"<{names[rng.integers(len(names))]}>",)
        else:
            part = (("<div>", "<section>", "<p>", "<ul>")[rng.integers(4)],
                    words[rng.integers(len(words))])
        at = int(rng.integers(len(out) + 1))
        inside = at < len(out) and rng.random() < 0.5
        outer = tuple(out[at].path[:-1]) if inside else ("<html>", "<body>")
        leaf = ((), ("<p>",), ("<ul>", "<li>"), ("<h3>",))[rng.integers(4)]
        for _ in range(rng.integers(1, 4)):
            text = spare[rng.integers(len(spare))]
            out.insert(at, Block(text, outer + part + leaf,
                                 len(text) if rng.random() < 0.3 else 0))
    return out


def fit(htmls: list[str], seed: int = 11) -> dict[str, np.ndarray]:
    """Weights learned from a list of pages; the same pages give the same weights."""
    w = start_weights(seed)
    pages = [b for b in (blocks_of(h)[:TRAIN_BLOCKS] for h in htmls) if b]
    if not pages:
        return w
    rng = np.random.default_rng(seed)
    spare = [b.text[:300] for p in pages for b in p][:2000]
    moment = {k: np.zeros_like(v) for k, v in w.items()}
    square = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        # every page as it is and in two fresh variations; pages without article parts too
        shown = pages + [_varied(p, spare, rng) for p in pages for _ in range(2)]
        order = rng.permutation(len(shown))
        for a in range(0, len(order), BATCH):
            batch = [shown[i] for i in order[a:a + BATCH]]
            labels = []
            for p in batch:
                marked = any(weak_label(b, True) for b in p)
                labels += [weak_label(b, marked) for b in p]
            step += 1
            for k, g in _gradients(w, batch, np.array(labels, dtype=np.float32)).items():
                moment[k] += 0.1 * (g - moment[k])
                square[k] += 0.001 * (g * g - square[k])
                w[k] -= (rate * (moment[k] / (1 - 0.9 ** step))
                         / (np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-7)).astype(np.float32)
    return w


def train(pages: DataFrame, html_col: str = "html",
          n: int = TRAIN_PAGES) -> dict[str, np.ndarray]:
    """Fit on the ``n`` distinct pages of smallest hash with at most ``TRAIN_HTML`` characters."""
    require(pages, html_col)
    # the hashes first, so that only the picked pages reach the driver
    texts = (pages.select(F.col(html_col).alias("h"), F.xxhash64(html_col).alias("k"))
             .filter(F.col("h").isNotNull() & (F.char_length("h") <= TRAIN_HTML)))
    picked = [r["k"] for r in texts.select("k").distinct().orderBy("k").limit(n).collect()]
    rows = texts.filter(F.col("k").isin(picked)).groupBy("k").agg(
        F.array_min(F.collect_set("h")).alias("h")).collect() if picked else []
    return fit(sorted(r["h"] for r in rows))


# --- extraction -----------------------------------------------------------

def extract_texts(htmls: list[str | None], w: dict[str, np.ndarray]) -> list[str]:
    """Main text of each page; pages of similar length go through the network together."""
    pages = [blocks_of(h) for h in htmls]
    out = [""] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    a = 0
    while a < len(order):
        b = a + 1
        while b < len(order) and len(pages[order[b]]) * (b + 1 - a) <= GROUP_BLOCKS:
            b += 1
        group = order[a:b]
        for i, prob in zip(group, forward(w, [pages[i] for i in group])):
            out[i] = "\n".join(x.text for x, p in zip(pages[i], prob) if p >= 0.5)
        a = b
    return out


def main_text(html: Column, w: dict[str, np.ndarray]) -> Column:
    """Column expression: main text of an html column."""
    @F.arrow_udf("string")
    def run(htmls: pa.Array) -> pa.Array:
        out = []
        for a in range(0, len(htmls), 256):
            out += extract_texts(htmls.slice(a, 256).to_pylist(), w)
        return pa.array(out, pa.string())
    return run(html)


def extract(pages: DataFrame, w: dict[str, np.ndarray], html_col: str = "html",
            out_col: str = "text") -> DataFrame:
    """Add every page's main text and its length in code points (``n_chars``)."""
    require(pages, html_col)
    return pages.withColumn(out_col, main_text(F.col(html_col), w)).withColumn(
        "n_chars", F.char_length(out_col).cast("long"))
