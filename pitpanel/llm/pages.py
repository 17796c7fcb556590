"""HTML as a sequence of leaf blocks with their tag paths, and pages laid out at random from
given texts, whose main text is known, for training.

The reader is one pass over the markup. A block is the text between two boundaries of block
elements; inline elements, comments and scripts don't end one, and a line break is white
space. Unclosed and stray tags are resolved by the nearest open element.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Callable
from typing import NamedTuple

import numpy as np

# A quote opens a value only after "=", and what isn't closed runs to the end, so that no
# markup is read twice.
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^"'>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=|["'])*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""",
    re.S,
)
HINT = re.compile(r"""(?:^|[\s"'/])(?:class|id|role|itemprop)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)
HIDDEN = re.compile(r"""display\s*:\s*none|(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*["']?true""", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
# Elements by their content in HTML.
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym area b base bdi bdo big br cite code data del dfn em embed font i img input ins kbd link mark meta nobr param q rp rt ruby s samp "
    "script small source span strike strong style sub sup time track tt u var wbr".split()
)
CLOSED_BY = {"li": {"p", "li"}, "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"}, "tr": {"p", "td", "th", "tr"}, "td": {"p", "td", "th"}, "th": {"p", "td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"}}
PARAGRAPH = frozenset({"p"})
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}
#: Elements of a path that describe a block: so many of the outermost and of the innermost.
OUTER, INNER = 4, 12
#: Words of an element's class, id, role and itemprop that describe it.
HINTS = 12


class Element(NamedTuple):
    name: str
    words: tuple[str, ...]
    linked: bool
    inline: Counter


class Block(NamedTuple):
    text: str
    path: list[Element]
    links: float


def described(name: str, rest: str) -> tuple[str, ...]:
    """The tag and the words of its attributes, in lower case."""
    if not rest or rest.isspace():
        return ("<" + name,)
    words = [w.lower() for m in HINT.finditer(rest) for w in NAME_PART.findall(m[1] or m[2] or m[3] or "")]
    return ("<" + name, *dict.fromkeys(words[:HINTS])) + (("~hidden",) if HIDDEN.search(rest) else ())


def blocks(html: str) -> list[Block]:
    """The leaf blocks of a page in order; blocks without text are left out."""
    root = Element("", ("<>",), False, Counter())
    stack, opened, out = [root], Counter(), []
    parts, chars = [], [0, 0]

    def flush() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, stack[:OUTER] + stack[OUTER:][-INNER:], chars[1] / max(1, chars[0])))
        parts.clear()
        chars[:] = 0, 0

    def say(text: str) -> None:
        if text:
            parts.append(text)
            n = len(text) - text.count(" ")
            chars[0] += n
            chars[1] += n if stack[-1].linked or stack[-1].inline["a"] > 0 else 0

    def close() -> None:
        opened[stack.pop().name] -= 1

    at, n = 0, len(html)
    while at < n:
        m = TOKEN.search(html, at)
        if m is None:
            say(html[at:])
            break
        say(html[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if m["end"]:
            if name in INLINE:
                if stack[-1].inline[name] > 0:
                    stack[-1].inline[name] -= 1
            else:
                flush()
                if opened[name]:
                    while stack[-1].name != name:
                        close()
                    close()
            continue
        if name in RAW:
            end = RAW_END[name].search(html, at)
            at = end.start() if end else n
            continue
        if name in INLINE:
            if name == "br":
                parts.append("\n")
            elif name not in VOID:
                stack[-1].inline[name] += 1
            continue
        flush()
        while stack[-1].name in CLOSED_BY.get(name, PARAGRAPH):
            close()
        if name not in VOID:
            top = stack[-1]
            stack.append(Element(name, described(name, m["rest"]), top.linked or top.inline["a"] > 0, Counter()))
            opened[name] += 1
    flush()
    return out


# What is known of a block from the markup that pages use for it. Only training sees this.
MAIN = frozenset({"<article", "<main", "articlebody"})
ASIDE = frozenset("<nav <footer <aside <form <button <head <dialog <menu <template nav menu footer sidebar ad ads advert advertisement sponsored promo cookie consent comment comments share social newsletter breadcrumb breadcrumbs".split())


def known(block: Block) -> float:
    """1 or 0 if the page's own elements say that the block is main text or not, else NaN."""
    found = np.nan
    for e in block.path:
        if not ASIDE.isdisjoint(e.words):
            return 0.0
        if not MAIN.isdisjoint(e.words):
            found = 1.0
    return 0.0 if np.isnan(found) and block.path[-1].name in ("header", "") else found


# How sites name what they put around a text: tag, class.
MAIN_BOXES = "article: main: div:content div:post div:entry-content div:article-body section:story div:text div:main section:article div:post-body td: div: section: div:body-text div:page-content div:single".split()
TEXT_TAGS = "p p p p p p p p div li blockquote h2 h3 pre td dd figcaption".split()
PLAIN_BOXES = "div: div:wrapper div:container div:row div:page div:layout div:inner div:column section: table: center:".split()
SIDE_BOXES = {
    "menu": "nav: nav: nav:main ul:menu div:navbar div:nav div:navigation ul:nav-links div:topbar div:breadcrumbs ol:breadcrumb menu: div:".split(),
    "header": "header: header: div:header div:masthead div:site-header div:logo div:banner div:top div:brand".split(),
    "footer": "footer: footer: div:footer div:site-footer div:bottom div:copyright div:legal p:copyright div:colophon".split(),
    "sidebar": "aside: aside: div:sidebar div:side aside:widget div:widget div:right-column div:related section:related-posts div:trending div:recommended div:tags div:rail div:most-read".split(),
    "notice": "div:cookie div:cookie-notice div:consent div:notice div:gdpr div:alert div:popup div:modal dialog: div:banner-notice div:paywall div:warning div:message section:notice div:announcement p:notice".split(),
    "advert": "div:ad div:ad div:ads div:advert div:advertisement div:sponsored div:promo div:banner-ad div:ad-slot aside:ad section:ad div:adsbox p:ad div:sponsor div:commercial".split(),
    "form": "form: form: form:search div:subscribe div:newsletter div:login fieldset: div:signup form:contact div:search-form".split(),
    "comments": "div:comments section:comments ol:comment-list div:comment div:replies div:responses div:discussion div:disqus section:reader-comments div:respond ul:commentlist div:user-comments div:feedback".split(),
    "share": "div:share div:social ul:social div:share-buttons div:follow div:author-box div:tools div:toolbar div:meta".split(),
}
#: Stands before each main block of a layout while it is read.
MARK = "\ue000"
STOCK = {
    "menu": ["Home", "About", "Contact", "News", "Menu", "Inicio", "Accueil", "Startseite"],
    "header": ["Log in", "Search", "Skip to content"],
    "footer": ["© 2024 All rights reserved", "Privacy policy", "Terms of use", "Impressum", "Mentions légales", "Aviso legal"],
    "sidebar": ["Related articles", "Most read", "Tags", "Read more", "Recent posts"],
    "notice": ["We use cookies to improve your experience.", "By continuing you accept our terms.", "Diese Seite verwendet Cookies.", "Ce site utilise des cookies.", "Please enable JavaScript."],
    "advert": ["Advertisement", "Sponsored", "Buy now and save 20%", "Anzeige", "Publicité"],
    "form": ["Subscribe to our newsletter", "Your email", "Password", "Search", "Submit"],
    "comments": ["Leave a reply", "3 comments", "Reply", "Report this comment"],
    "share": ["Share this", "Tweet", "Print", "Follow us"],
}


def box(kind: str, inside: str, noise: str = "") -> str:
    tag, _, hint = kind.partition(":")
    hint = f"{hint} {noise}".strip()
    key = "id" if hint and len(inside) % 5 == 0 else "class"
    return f"<{tag}{f' {key}="{hint}"' if hint else ''}>{inside}</{tag}>"


def layout(rng: np.random.Generator, texts: list[str], snip: Callable[[int, int], str]) -> tuple[list[Block], np.ndarray]:
    """The blocks of a page with ``texts`` as its main text among other things, in one of many
    forms, and which are main text. ``snip(a, b)`` gives from a to b words of some text."""
    esc = entities.escape
    texts = [t for text in texts for t in ([text, snip(1, 3) + "."] if rng.random() < 0.1 else [text])]
    pick = lambda xs: xs[rng.integers(len(xs))]
    noise = lambda: pick(["", "", "", "col", "clearfix", "x" + "".join(pick("abcdefgh") for _ in range(5))])

    def piece(kind: str, a: int, b: int) -> str:
        return esc(pick(STOCK[kind]) if rng.random() < 0.3 else snip(a, b))

    def side(kind: str) -> str:
        link = lambda a, b: f'<a href="/">{piece(kind, a, b)}</a>'
        n = rng.integers(1, 4)
        if kind == "menu":
            inside = "".join(f"<li>{link(1, 3)}</li>" for _ in range(n * 3))
            inside = f"<ul>{inside}</ul>" if rng.random() < 0.7 else re.sub("</?li>", " ", inside)
        elif kind == "sidebar":
            listed = rng.random() < 0.6
            inside = f"<h3>{piece(kind, 1, 4)}</h3>" + "".join(f"<li>{link(3, 10)}</li>" if listed else f"<p>{piece(kind, 4, 40)}</p>" for _ in range(n + 1))
        elif kind == "form":
            inside = f"<label>{piece(kind, 1, 4)}</label><input name=q><p>{piece(kind, 2, 15)}</p><button>{piece(kind, 1, 2)}</button>"
        elif kind == "comments":
            one = lambda: box(pick(["div:comment", "li:", "div:", "article:comment", "p:"]), f"<span class=author>{piece(kind, 1, 2)}</span>" * int(rng.integers(2)) + f"<p>{esc(snip(3, 60))}</p>")
            inside = f"<h3>{piece(kind, 1, 4)}</h3>" * int(rng.integers(2)) + "".join(one() for _ in range(n * 2))
        elif kind in ("share", "header"):
            inside = "".join(link(1, 2) if rng.random() < 0.6 else f"<p>{piece(kind, 1, 8)}</p>" for _ in range(n))
        else:
            tag = pick(["p", "", "div", "span"])
            inside = "".join(f"<{tag}>{piece(kind, 2, 30)}</{tag}>" if tag else piece(kind, 2, 30) for _ in range(n))
        return box(pick(SIDE_BOXES[kind]), inside, noise())

    some = lambda kinds, p: "".join(side(k) for k in kinds if rng.random() < p)
    body = ""
    for i, text in enumerate(texts):
        tag = pick(["h1", "h1", "h2", "header"]) if i == 0 and rng.random() < 0.8 else pick(TEXT_TAGS)
        inner = MARK + esc(text)
        if rng.random() < 0.2:
            words = inner.split(" ")
            k = rng.integers(len(words))
            words[k] = f'<a href="/">{words[k]}</a>' if rng.random() < 0.5 else f"<b>{words[k]}</b>"
            inner = " ".join(words)
        inner = f"<b>{inner}<br>" if rng.random() < 0.1 else inner
        body += f"<header><h1>{inner}</h1></header>" if tag == "header" else f"<{tag}>{inner}" if tag == "p" and rng.random() < 0.2 else f"<{tag}>{inner}</{tag}>"
        body += some(["advert", "share", "form", "sidebar"], 0.03)
    main = box(pick(MAIN_BOXES), body, noise())
    inside_main = main if rng.random() < 0.8 else box(pick(["article:", "main:"]), main + some(["comments", "share"], 0.5))
    page = some(["notice", "header", "menu", "advert", "form"], 0.5) + inside_main + some(["share", "advert", "comments", "sidebar", "form", "notice"], 0.4)
    for _ in range(rng.integers(3)):
        page = box(pick(PLAIN_BOXES), page, noise())
    page = some(["notice", "header", "menu"], 0.4) + page + some(["sidebar", "comments", "menu", "footer"], 0.5)
    found = blocks(f"<html><head><title>{esc(texts[0])}</title></head><body>{page}</body></html>")
    return [b._replace(text=b.text.replace(MARK, "")) for b in found], np.array([float(MARK in b.text) for b in found])
