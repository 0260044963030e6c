"""Training pages: the texts of known pages in other layouts."""

from __future__ import annotations

import html

import numpy as np

#: Stands in every text of an article.
FLAG = "\ue000"

WRAPS = (
    '<article class="{}">', "<article>", "<main>", '<main id="content">', '<div class="content">', '<div id="main">',
    '<section class="post">', '<div class="entry-content">', '<div class="article-body">', "<div>", "<div>",
    '<div class="col-8">', "<section>", '<div role="main">', '<div class="{}">',
)
MENUS = (
    "<nav>{}</nav>", '<div class="menu">{}</div>', '<ul class="nav">{}</ul>', '<div id="navigation">{}</div>',
    '<div class="breadcrumbs">{}</div>', '<div role="navigation">{}</div>', '<header class="site-header">{}</header>',
    '<ul class="pagination">{}</ul>', "<ul>{}</ul>", "<div>{}</div>",
)
HEADS = (
    "<header>{}</header>", '<div class="header">{}</div>', '<div id="masthead">{}</div>',
    '<div class="topbar">{}</div>', '<header role="banner">{}</header>',
)
SIDES = (
    "<aside>{}</aside>", '<div class="sidebar">{}</div>', '<div id="side">{}</div>', '<section class="related">{}</section>',
    '<div class="widget">{}</div>', '<div class="recommended">{}</div>', '<aside class="rail">{}</aside>',
)
ADVERTS = (
    '<div class="ad">{}</div>', '<div class="advert">{}</div>', '<div id="ads-top">{}</div>',
    '<aside class="sponsored">{}</aside>', '<section class="promo">{}</section>', '<div class="ad-banner"><p>{}</p></div>',
    '<p class="advertisement">{}</p>',
)
NOTICES = (
    '<div class="cookie-notice">{}</div>', '<div role="alert">{}</div>', '<div id="consent">{}<button>OK</button></div>',
    '<section class="notice"><p>{}</p></section>', '<dialog open>{}</dialog>', '<div class="popup"><p>{}</p></div>',
    '<p class="notice">{}</p>', '<aside class="alert">{}</aside>',
)
FORMS = (
    '<form><label>{}</label><input name="q"><button>{}</button></form>',
    '<form class="newsletter"><p>{}</p><input type="email"><button>{}</button></form>',
    '<div class="subscribe"><p>{}</p><form><input><button>{}</button></form></div>',
    '<form class="login"><fieldset><label>{}</label><input></fieldset><button>{}</button></form>',
)
COMMENTS = (
    '<section id="comments"><h2>{0}</h2>{1}</section>', '<div class="comments">{1}</div>',
    '<ol class="commentlist">{1}</ol>', '<section class="discussion"><h3>{0}</h3>{1}</section>',
    '<div id="disqus">{1}</div>', '<div class="reader-comments"><h3>{0}</h3>{1}</div>', '<ul class="replies">{1}</ul>',
)
SHARES = (
    '<div class="share">{}</div>', '<ul class="social">{}</ul>', '<div class="tags">{}</div>', '<p class="byline">{}</p>',
)
FEET = (
    "<footer>{}</footer>", '<div class="footer">{}</div>', '<div id="copyright">{}</div>',
    '<footer class="site-footer"><p>{}</p></footer>', '<div class="legal">{}</div>', '<div role="contentinfo">{}</div>',
)


class Layout:
    def __init__(self, dice: np.random.Generator, words: list[str], prose: list[str]) -> None:
        self.dice, self.words, self.prose = dice, words, prose

    def one(self, of):
        return of[int(self.dice.integers(len(of)))]

    def some(self, low: int, high: int) -> int:
        return int(self.dice.integers(low, high + 1))

    def maybe(self, chance: float) -> bool:
        return self.dice.random() < chance

    def phrase(self, low: int = 1, high: int = 6) -> str:
        return html.escape(" ".join(self.one(self.words) for _ in range(self.some(low, high))))

    def links(self) -> str:
        link = self.one(("<li><a href='/x'>{}</a></li>", "<a href='/y'>{}</a> ", "<li><a href='#'><span>{}</span></a>"))
        found = "".join(link.format(self.phrase(1, 4)) for _ in range(self.some(2, 9)))
        return f"<ul>{found}</ul>" if link.startswith("<li") and self.maybe(0.5) else found

    def foreign(self) -> str:
        return html.escape(self.one(self.prose))[: self.some(60, 900)]

    def comment(self) -> str:
        body = self.one((
            "<p>{}</p>", "<div class='comment'><p class='author'>{1}</p><p>{0}</p></div>", "<li>{}</li>",
            "<div class='reply'>{}</div>", "<div><b>{1}</b><p>{0}</p></div>", "<article class='comment'><p>{}</p></article>",
        ))
        return body.format(self.foreign(), self.phrase(1, 3))

    def clutter(self) -> str:
        """A part that belongs to no article."""
        kind = self.some(0, 7)
        if kind == 0:
            return self.one(MENUS).format(self.links())
        if kind == 1:
            inner = self.links() if self.maybe(0.5) else f"<h3>{self.phrase()}</h3><p>{self.foreign()}</p>"
            return self.one(SIDES).format(inner)
        if kind in (2, 3):
            return self.one((ADVERTS, NOTICES)[kind - 2]).format(self.phrase(4, 40))
        if kind == 4:
            return self.one(FORMS).format(self.phrase(1, 12), self.phrase(1, 2))
        if kind == 5:
            found = "".join(self.comment() for _ in range(self.some(1, 5)))
            return self.one(COMMENTS).format(self.phrase(1, 3), found)
        if kind == 6:
            return self.one(SHARES).format(self.links() if self.maybe(0.6) else self.phrase(2, 6))
        return self.one(ADVERTS).format(self.foreign())

    def line(self, text: str) -> str:
        safe = html.escape(text)
        if self.maybe(0.2) and " " in safe:
            first, rest = safe.split(" ", 1)
            safe = f"<{(t := self.one(('b', 'em', 'a', 'span', 'strong')))}>{first}</{t}> {rest}"
        return FLAG + safe

    def article(self, title: str, lines: list[str]) -> str:
        frame = self.one(("<p>{}</p>",) * 6 + ("<div>{}</div>", "<p>{}", "<li>{}</li>", "<section><p>{}</p></section>"))
        parts = []
        if self.maybe(0.8):
            head = f"<h{(k := self.some(1, 2))}>{self.line(title)}</h{k}>"
            parts.append(f"<header>{head}</header>" if self.maybe(0.2) else head)
        for text in lines:
            if self.maybe(0.08):
                parts.append(f"<h2>{self.line(self.one(lines)[:60])}</h2>")
            shape = frame
            if self.maybe(0.12):
                shape = self.one((
                    "<blockquote><p>{}</p></blockquote>", "<ul><li>{}</li></ul>", "<p><b>{}<br>", "<pre>{}</pre>",
                    "<table><tr><td>{}</td></tr></table>", "<figure><figcaption>{}</figcaption></figure>", "<dl><dd>{}</dd></dl>",
                ))
            parts.append(shape.format(self.line(text)))
            if self.maybe(0.06):
                parts.append(self.clutter())
        body = "".join(parts)
        if frame.startswith("<li"):
            body = f"<ul>{body}</ul>"
        return body

    def page(self, title: str, lines: list[str]) -> str:
        lines = lines[:1] if self.maybe(0.1) else lines
        body = self.article(title, lines)
        if self.maybe(0.03):
            return body
        wrap = self.one(WRAPS)
        tag = wrap[1:].split()[0].rstrip(">")
        inside = self.clutter() if self.maybe(0.25) else ""
        body = f"{wrap.format(self.one(self.words))}{body}{inside}</{tag}>"
        before, after = [], []
        if self.maybe(0.6):
            before.append(self.one(HEADS).format(f"<a href='/'>{self.phrase()}</a>" + (self.links() if self.maybe(0.5) else "")))
        if self.maybe(0.7):
            before.append(self.one(MENUS).format(self.links()))
        before += [self.clutter() for _ in range(self.some(0, 2))]
        after += [self.clutter() for _ in range(self.some(0, 4))]
        if self.maybe(0.8):
            after.append(self.one(FEET).format(f"&copy; {self.phrase(2, 12)}"))
        whole = "".join(before) + body + "".join(after)
        for shell in ('<div class="wrapper">{}</div>', '<div id="page"><div class="container">{}</div></div>'):
            if self.maybe(0.25):
                whole = shell.replace("{}", whole)
        return f"<html><head><title>{self.phrase()}</title></head><body>{whole}</body></html>"
