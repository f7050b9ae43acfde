"""Main-text extraction: a conditional random field over the leaf blocks of a page.

A tolerant scanner turns a page into leaf blocks (runs of text between block
tags) with the tags, class words and roles of their ancestors and a few figures
of the text.  A linear-chain field, trained on labelled pages, marks each block
as main text or not; Viterbi decoding keeps the main blocks in page order.

The labelled pages are made by :func:`labelled_page`: layouts of many kinds, with
the article and everything that is not it in varying elements, order and
wording, and each block's label known.  They are made anew from a seed; nothing
is stored.

Edge cases: null and empty pages give an empty text; unclosed, misnested and cut
markup is read as far as it goes, in time proportional to its length; a quote opens an
attribute's value only right after the equals sign, and only if it is closed; references that are cut stay as they are;
pages without main text give an empty string; ids may be null or repeat (rows are
never merged); an empty table gives none; a column named text is replaced, other
columns are kept.
"""

from __future__ import annotations

import functools
import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewatch.llm import crf
from tidewatch.llm.textblock import blocks

TRAIN_PAGES, SEED = 800, 11

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)|<[!?/][^>]*(?:>|\Z)", re.S)
#: An attribute: a quote opens a value only right after the equals sign, and only if another one closes it.  Possessive, so nothing is read twice.
_NAME, _VALUE = r"(=?+[^\s/>=]++|=)", r"(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+"
_ATTRIBUTE = re.compile(_NAME + _VALUE)
_TAG_END = re.compile(rf"(?:[\s/]++|{_NAME}{_VALUE})*+>")
#: Elements within more than so many others take part in no nesting.
DEPTH = 512
_CLASS_WORD = re.compile(r"[a-z]+")
#: Elements whose content no reader sees in the text, and those whose content is text without markup.
UNSEEN = frozenset("script style textarea title template iframe noembed noframes datalist".split())
PLAIN = frozenset("xmp listing".split())
#: Elements of other vocabularies, which may end in their start tag.
FOREIGN = frozenset("svg math path circle rect line polygon polyline ellipse use g stop mspace mprescripts none".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split())
#: What a start tag of the first kind closes when it is open.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("ul ol table dl select div section article aside nav header footer main form body html".split())

#: Ancestor features: tags, then words of class, id and role.
TAGS = ("article main nav header footer aside form li a p table blockquote pre figure section dialog address details".split())
GROUPS = {"heading": "h1 h2 h3 h4 h5 h6", "control": "button select option label fieldset legend menu", "list": "ul ol dl", "definition": "dt dd"}
WORDS = {
    "w_ad": "ad ads advert adverts advertisement adsbygoogle adslot sponsor sponsored promo promotion promoted banner commercial dfp",
    "w_nav": "nav navbar navigation menu breadcrumb breadcrumbs toolbar tabs pagination pager toc skip links",
    "w_footer": "footer foot colophon copyright legal bottom contentinfo",
    "w_header": "header masthead head topbar logo brand top site",
    "w_side": "sidebar side aside widget related recommended recommendations trending popular latest rail complementary teaser outbrain taboola",
    "w_comment": "comment comments commentlist reply replies respond disqus discussion responses feedback reactions thread",
    "w_notice": "cookie cookies consent gdpr notice alert warning popup modal overlay newsletter subscribe subscription paywall signup login privacy disclaimer toast",
    "w_share": "share sharing social tags tagcloud follow meta byline author date timestamp credit",
    "w_form": "form search searchbox input field contact register",
    "w_content": "article content post entry story main body text articlebody prose hentry page",
}
NAMES = [*TAGS, *GROUPS, *WORDS, "hidden"]
_BIT = {name: 1 << i for i, name in enumerate(NAMES)}
_TAG_BITS = {t: _BIT[t] for t in TAGS} | {t: _BIT[g] for g, ts in GROUPS.items() for t in ts.split()}
_WORD_BITS = {w: _BIT[g] for g, ws in WORDS.items() for w in ws.split()}


def _own_bits(tag: str, attributes: str) -> int:
    bits = _TAG_BITS.get(tag, 0)
    if attributes and not attributes.isspace():
        for name, value in _ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name in ("class", "id", "role"):
                for word in _CLASS_WORD.findall(value.lower()):
                    bits |= _WORD_BITS.get(word, 0)
            elif name == "hidden" or (name == "aria-hidden" and "true" in value.lower()) or (name == "style" and "display:none" in value.lower().replace(" ", "")):
                bits |= _BIT["hidden"]
    return bits


_own_bits = functools.lru_cache(maxsize=20_000)(_own_bits)


@functools.lru_cache(maxsize=64)
def _closing(name: str) -> re.Pattern:
    return re.compile(rf"</{name}\b[^>]*>?", re.I)


def leaf_blocks(page: str) -> list[tuple[str, int, int, int]]:
    """Per leaf block: its text, the bits of its ancestors, the characters of it in links, and how deep it stands."""
    out: list[tuple[str, int, int, int]] = []
    stack: list[tuple[str, int]] = []
    bits = 0
    parts: list[str] = []
    linked = links = 0
    block_bits = 0
    at, end = 0, len(page)
    #: Open elements by name, and those that stand too deep for the stack.
    opened: dict[str, int] = {}
    deep: dict[str, int] = {}
    quoted = True

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((text, block_bits, linked, len(stack)))
            parts.clear()
        linked = 0

    def add(text: str, markup: bool = True) -> None:
        nonlocal linked, block_bits
        if markup and "&" in text:
            text = html.unescape(text)
        if not parts:
            if not text or text.isspace():
                return
            block_bits = bits
        parts.append(text)
        if links:
            linked += len(text)

    def close(to: int) -> None:
        nonlocal bits, links
        for tag, _ in stack[to:]:
            links -= tag == "a"
            opened[tag] -= 1
        del stack[to:]
        bits = stack[-1][1] if stack else 0

    while at < end:
        found = _TOKEN.search(page, at)
        if found is None:
            add(page[at:])
            break
        if found.start() > at:
            add(page[at : found.start()])
        at = found.end()
        name = found.group(2)
        if name is None:
            continue
        tag = _TAG_END.match(page, at) if quoted else None
        stop = tag.end() if tag else page.find(">", at) + 1
        # a tag that swallows the rest of the page ends at the next sign that could end it, as do all after it
        quoted = tag is not None and quoted
        if not stop:
            # no tag ends any more: what follows is text, but for a last tag that is cut
            last = page.rfind("<")
            cut = last if page[last + 1 : last + 2].isalpha() or page[last + 1 : last + 2] in ("/", "!", "?") else end
            add(page[found.start() : cut])
            break
        attributes, at = page[at : stop - 1], stop
        name = name.lower()
        if found.group(1):
            if name in BLOCK:
                flush()
            if name == "br":
                add(" ")
            if deep.get(name):
                deep[name] -= 1
                continue
            for i in range(len(stack) - 1, -1, -1) if opened.get(name) else ():
                if stack[i][0] == name:
                    close(i)
                    break
                if name not in BLOCK and stack[i][0] in BLOCK and name != "a":
                    break
            continue
        if name in UNSEEN or name in PLAIN:
            stop = _closing(name).search(page, at)
            if name in PLAIN:
                flush()
                add(page[at : stop.start() if stop else end], False)
                flush()
            at = stop.end() if stop else end
            add(" ")
            continue
        if attributes.endswith("/") and name in FOREIGN:
            continue
        if name in VOID:
            if name in BLOCK:
                flush()
            else:
                add(" ") if name == "br" else None
            continue
        if name in BLOCK:
            flush()
            # a paragraph ends where another block begins
            for i in range(len(stack) - 1, -1, -1) if opened.get("p") else ():
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] in BLOCK:
                    break
            if any(opened.get(t) for t in CLOSES.get(name, ())):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in CLOSES[name]:
                        close(i)
                        break
                    if stack[i][0] in _SCOPE and not (name in ("td", "th") and stack[i][0] == "tr"):
                        break
        if len(stack) >= DEPTH:
            deep[name] = deep.get(name, 0) + 1
            continue
        bits |= _own_bits(name, attributes)
        stack.append((name, bits))
        opened[name] = opened.get(name, 0) + 1
        links += name == "a"
    flush()
    return out


FEATURES = len(NAMES) + 9
_SHIFT = np.arange(len(NAMES))


def block_features(found: list[tuple[str, int, int, int]]) -> np.ndarray:
    """Features of a page's blocks, in order."""
    out = np.zeros((len(found), FEATURES))
    if not found:
        return out
    bits = np.array([b for _, b, _, _ in found], np.int64)
    out[:, : len(NAMES)] = (bits[:, None] >> _SHIFT) & 1
    for i, (text, _, linked, _) in enumerate(found):
        n = len(text)
        words = text.count(" ") + 1
        out[i, len(NAMES) :] = (1.0, min(1.0, n / 400), words < 4, words > 12, min(1.0, linked / n), linked > 0.8 * n, text[-1] in ".!?:;\"”»", "©" in text or "All rights" in text, text[0].isupper())
    return out


_SYLLABLES = "ka lo mi ten ra vor is el un da pre con ti sa mer no qui per al ver on ist ar".split()


def labelled_page(rng: random.Random) -> tuple[str, list[tuple[str, int]]]:
    """A page and its blocks with their labels: 0 main text, 1 anything else."""
    truth: list[tuple[str, int]] = []

    def word() -> str:
        return "".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4)))

    def sentence(lo: int, hi: int, stop: bool = True) -> str:
        return " ".join(word() for _ in range(rng.randint(lo, hi))).capitalize() + ("." if stop else "")

    def text(lo: int, hi: int, label: int, stop: bool = True) -> str:
        out = sentence(lo, hi, stop)
        truth.append((out, label))
        return out

    def prose(label: int) -> str:
        return text(1, 3, label) if rng.random() < 0.2 else text(4, 90, label)

    def links(n: int, label: int = 1, item: str = "li") -> str:
        return "".join(f'<{item}><a href="/{word()}">{text(1, 3, label, False)}</a></{item}>' for _ in range(n))

    def wrap(kinds: list[str], body: str) -> str:
        kind = rng.choice(kinds)
        tag, _, attribute = kind.partition(" ")
        return f"<{tag}{' ' + attribute if attribute else ''}>{body}</{tag}>"

    def navigation() -> str:
        return wrap(["nav", 'div class="navbar"', 'div id="menu"', 'ul class="nav-menu"', 'div role="navigation"', "header", 'div class="breadcrumb"'], "<ul>" + links(rng.randint(2, 8)) + "</ul>" if rng.random() < 0.8 else links(rng.randint(2, 6), item="p") + "<p>" + text(2, 5, 1, False) + "</p>")

    def other() -> str:
        kind = rng.randrange(9)
        if kind == 0:
            return wrap(['div class="ad"', 'div class="advert"', 'aside class="sponsored"', 'div id="banner-ad"', 'div class="promo"', 'section class="advertisement"', 'p class="ad"'], prose(1))
        if kind == 1:
            return wrap(["aside", 'div class="sidebar"', 'div class="widget"', 'section class="related"', 'div id="side"'], f"<h3>{text(1, 4, 1, False)}</h3><p>{prose(1)}</p>" + ("<ul>" + links(rng.randint(1, 5)) + "</ul>" if rng.random() < 0.6 else f"<p>{prose(1)}</p>"))
        if kind == 2:
            return wrap(['div class="cookie-banner"', 'div class="notice"', 'div role="alert"', 'div class="consent"', 'section class="newsletter"', "dialog", 'div class="modal"', 'p class="notice"'], f"<p>{prose(1)}</p>" if rng.random() < 0.7 else prose(1))
        if kind == 3:
            return wrap(["form", 'form class="search"', 'div class="login"', 'form id="contact"'], f"<label>{text(1, 3, 1, False)}</label><input name=q><p>{prose(1)}</p><button>{text(1, 2, 1, False)}</button>")
        if kind == 4:
            return wrap(['section class="comments"', 'div id="comments"', 'ol class="commentlist"', 'div class="comment"', 'section id="respond"', 'div class="comment-list"'], "".join(rng.choice(["<div class=\"comment\"><p>{}</p></div>", "<p>{}</p>", "<li>{}</li>", "<article class=\"comment\"><p>{}</p></article>"]).format(prose(1)) for _ in range(rng.randint(1, 4))))
        if kind == 5:
            return wrap(['div class="share"', 'div class="social"', 'p class="byline"', 'div class="tags"', 'div class="meta"'], text(1, 5, 1, False))
        if kind == 6:
            return navigation()
        if kind == 7:
            return wrap(["header", 'div class="masthead"', 'div id="header"', 'div class="topbar"'], f"<p>{text(1, 12, 1, False)}</p>")
        return wrap(['div hidden', 'div style="display:none"', 'div class="popup"'], f"<p>{prose(1)}</p>")

    def content() -> str:
        out = []
        if rng.random() < 0.8:
            heading = f"<h1>{text(1, 12, 0, rng.random() < 0.5)}</h1>"
            out.append(f"<header>{heading}</header>" if rng.random() < 0.15 else heading)
        for _ in range(rng.randint(1, 12)):
            k = rng.random()
            if k < 0.68:
                out.append(f"<p>{prose(0)}</p>" if rng.random() < 0.8 else f"<p><b>{prose(0)}<br>")
            elif k < 0.76:
                out.append(f"<h{(h := rng.randint(2, 4))}>{text(1, 8, 0, False)}</h{h}>")
            elif k < 0.83:
                out.append("<ul>" + "".join(f"<li>{prose(0)}</li>" for _ in range(rng.randint(1, 4))) + "</ul>")
            elif k < 0.88:
                out.append(f"<blockquote>{prose(0)}</blockquote>")
            elif k < 0.91:
                out.append(f"<pre>{prose(0)}</pre>")
            elif k < 0.94:
                out.append("<table><tr>" + "".join(f"<td>{text(1, 6, 0, False)}</td>" for _ in range(rng.randint(1, 4))) + "</tr></table>")
            elif k < 0.96:
                out.append(f"<figure><figcaption>{text(2, 10, 0)}</figcaption></figure>")
            elif k < 0.98:
                out.append(f'<p>{text(2, 6, 0, False)} </p>')
            else:
                out.append(other())
        if rng.random() < 0.25:
            out.append(other())
        return "".join(out)

    before = "".join(f() for f in rng.choices([navigation, other], k=rng.randint(0, 4)))
    body = wrap(["article", "article", "article", "main", 'div class="content"', 'div id="main-content"', 'div class="post-body"', 'section class="entry"', 'div class="article-text"', "main><article"], content()).replace("</main><article>", "</article></main>")
    after = "".join(other() for _ in range(rng.randint(0, 3)))
    foot = wrap(["footer", 'div class="footer"', 'div id="footer"'], rng.choice(["", "<p>"]) + text(2, 20, 1)) if rng.random() < 0.85 else ""
    return f"<!DOCTYPE html><html><head><title>{word()}</title></head><body>{before}{body}{after}{foot}</body></html>", truth


@functools.lru_cache(maxsize=2)
def model(pages: int = TRAIN_PAGES, seed: int = SEED) -> crf.Model:
    """The field trained on ``pages`` labelled pages."""
    rng = random.Random(seed)
    xs, ys = [], []
    for _ in range(pages):
        page, truth = labelled_page(rng)
        found = leaf_blocks(page)
        if [t for t, *_ in found] == [t for t, _ in truth]:
            xs.append(block_features(found))
            ys.append(np.array([label for _, label in truth]))
    return crf.train(xs, ys, steps=200, penalty=1e-4)


def extract(pages: DataFrame, fitted: crf.Model | None = None, column: str = "html") -> DataFrame:
    """All columns of ``pages`` but ``column``, with ``text``, its main text."""
    fitted = fitted or model()
    own = [c for c in pages.columns if c.lower() not in (column.lower(), "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, column, 1 << 20):
            found = [leaf_blocks(x or "") for x in block.column(column).to_pylist()]
            off = np.cumsum([0] + [len(f) for f in found])
            labels = crf.viterbi(fitted, np.concatenate([block_features(f) for f in found]), off)
            texts = ["\n\n".join(b[0] for b, label in zip(f, labels[a:].tolist(), strict=False) if label == 0) for f, a in zip(found, off[:-1].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in own), pa.array(texts, pa.string())], [*own, "text"])

    return pages.select(*own, column).mapInArrow(run, pages.select(*own).schema.add("text", "string"))
