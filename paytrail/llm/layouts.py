"""Labels for blocks that pages themselves give away, and pages laid out anew from labelled blocks.

What stands in an article or main element is main text, unless something around it says
otherwise; that is enough to label the pages that use such elements.  As other pages
don't, the labelled blocks of a page are also put into layouts drawn at random, in which
main text and the rest have other elements and names, or none.
"""

from __future__ import annotations

import html
import random

from .blocks import Block

MAIN = {"<article>", "<main>", "main", "article"}
#: Words that name the parts of a page which are not its main text.
OTHER = set(
    "nav menu navbar navigation breadcrumb footer sidebar aside ad advert advertisement adsense sponsor sponsored promo promotion banner cookie consent gdpr notice alert popup modal "
    "newsletter subscribe login signin signup search form comment reply discussion disqus respond share social related recommended recommendation widget copyright legal pagination "
    "pager toolbar skip hidden masthead contentinfo complementary trending outbrain taboola".split()
) | {"<nav>", "<footer>", "<aside>", "<form>", "<dialog>", "<menu>", "<fieldset>"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: A block of a page without such elements counts as main text from so many words on, with no more than this share in links.
WEAK_WORDS, WEAK_LINKED = 10, 0.3


def weak_labels(blocks: list[Block]) -> list[int]:
    """1 for main text; a header element counts only outside of articles."""
    marked = [bool(b.words & MAIN) for b in blocks]
    found = []
    for b, main in zip(blocks, marked, strict=True):
        other = bool(b.words & OTHER) or "<header>" in b.words and not main
        plain = len(b.text.split()) >= WEAK_WORDS and b.linked <= WEAK_LINKED * len(b.text)
        found.append(int(not other and (main if any(marked) else plain)))
    return found


MAIN_BOXES = ['<article>', '<main>', '<article class="post">', '<main id="content"><article>', '<div class="content">', '<div id="main">', '<div class="post-body">', '<div class="entry-content">', '<section class="story">', '<div role="main">', '<div itemprop="articleBody">', '<div class="article-text">', '<div>', '<section>', '<table><tr><td>', '<form id="aspnetForm"><div class="content">']
WRAPPERS = ["", "", "<div>", '<div class="container">', '<div id="page"><div class="row">', '<div class="wrapper"><section>']
PLACES = {
    "menu": ["<nav>", '<div class="menu">', '<ul class="navbar-nav">', '<div id="navigation">', '<div class="breadcrumbs">', '<div class="pagination">', '<nav role="navigation">', '<menu>', "<div>"],
    "header": ["<header>", '<div class="header">', '<div id="masthead">', '<header class="site-header">', '<div class="top-bar toolbar">'],
    "footer": ["<footer>", '<div class="footer">', '<div id="footer">', '<footer role="contentinfo">', '<div class="copyright">', '<div class="legal">'],
    "side": ["<aside>", '<div class="sidebar">', '<aside class="related">', '<div id="secondary" class="widget">', '<div class="recommended-posts">', '<div class="trending">', '<section class="related-articles">'],
    "advert": ['<div class="ad">', '<div class="advert">', '<div class="advertisement">', '<div class="sponsored">', '<div id="banner-ad">', '<section class="promo">', '<aside class="ads">', '<p class="ad">'],
    "notice": ['<div class="cookie-notice">', '<div id="cookie-consent">', '<div class="alert">', '<div class="notice">', '<dialog>', '<section class="gdpr-banner">', '<div class="popup modal">', '<p class="notice">'],
    "form": ["<form>", '<form class="newsletter">', '<form id="search"><fieldset>', '<div class="subscribe-form">', '<form class="login">', '<div class="signup">'],
    "comment": ['<section class="comments">', '<div id="comments">', '<div class="comment-list">', '<ol class="commentlist">', '<section id="discussion">', '<div id="disqus_thread">', '<div class="replies">', '<div class="comment">', '<section class="user-comments"><article>', '<section class="reader-comments">', '<div class="responses"><article class="comment">'],
    "share": ['<div class="social">', '<ul class="share-buttons">', '<div class="sharing">'],
}
SHAPES = {
    "": ("<p>{}</p>", "<div>{}</div>", "<div><p>{}</p></div>", "<h3>{}</h3>", "<li>{}</li>", "{}<hr>"),
    "menu": ("<li><a href='#'>{}</a></li>", "<a href='#'>{}</a><hr>", "<li>{}</li>"),
    "share": ("<li><a href='#'>{}</a></li>", "<a href='#'>{}</a><hr>", "<li>{}</li>"),
    "form": ("<label>{}</label><input>", "<p>{}</p>", "<div><label>{}</label></div>"),
}
INSIDE = ("advert", "comment", "side", "share", "notice", "form")
BEFORE, AFTER = ("header", "menu", "notice", "advert", "form", "side"), ("comment", "side", "menu", "share", "advert", "form", "footer")


def _ends(box: str) -> str:
    return "".join(f"</{t.split()[0].rstrip('>')}>" for t in reversed(box.split("<")[1:]))


def relay(blocks: list[Block], labels: list[int], pick: random.Random) -> tuple[list[str], list[int]] | None:
    """A page from these blocks in a layout drawn by pick, and the label of each of its blocks; None without main text."""
    main = [b for b, y in zip(blocks, labels, strict=True) if y]
    rest = [b.text for b, y in zip(blocks, labels, strict=True) if not y] or ["Menu"]
    if not main:
        return None
    first = pick.randrange(len(main)) if pick.random() < 0.5 else 0
    main = main[first : first + pick.randint(1, 10)]
    parts: list[str] = []
    told: list[int] = []
    say = lambda text: html.escape(text[:4000], quote=False)  # noqa: E731  (only what is learned from is cut)

    def put(kind: str) -> None:
        box = pick.choice(PLACES[kind])
        parts.append(box)
        for _ in range(pick.choice((1, 1, 2, 3, 6) if kind in {"menu", "side", "comment", "share"} else (1, 1, 2))):
            sentence = pick.choice(main).text if kind in {"comment", "side", "advert", "notice"} and pick.random() < 0.6 else pick.choice(rest)
            shape = "{}<hr>" if box.startswith("<p") else pick.choice(SHAPES.get(kind, SHAPES[""]))
            parts.append(shape.format(say(sentence)))
            told.append(0)
        parts.append(_ends(box))

    wrapper, box = pick.choice(WRAPPERS), pick.choice(MAIN_BOXES)
    parts.append(f"<body>{wrapper}")
    for kind in BEFORE:
        if pick.random() < (0.6 if kind in {"header", "menu"} else 0.25):
            put(kind)
    parts.append(box)
    top, lists = pick.choice(("", "", "<header>", '<div class="title">')), pick.random() < 0.3
    for i, b in enumerate(main):
        tag = b.tag if b.tag in HEADINGS else pick.choices(("p", "li", "blockquote", "h2", "pre", "div", "figcaption", "dd"), (20, 1, 1, 1, 1, 2, 1, 1))[0]
        before, after = (top, _ends(top)) if not i else ("<ul>", "</ul>") if lists and pick.random() < 0.5 else ("", "")
        parts.append(f"{before}<{'li' if before == '<ul>' else tag}>{say(b.text)}</{'li' if before == '<ul>' else tag}>{after}")
        told.append(1)
        if pick.random() < 0.08:
            put(pick.choice(INSIDE))
    if pick.random() < 0.3:
        put("comment")
    parts.append(_ends(box))
    for kind in AFTER:
        if pick.random() < (0.6 if kind == "footer" else 0.3):
            put(kind)
    return parts, told
