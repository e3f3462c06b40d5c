"""Labelled pages for the main-text model, made from a rule.

Each page has a main part and things around and inside it that are not main text, in the ways common on the web. The
attribute data-label on an element tells what its text is: main or other.
"""

from __future__ import annotations

import random

PAGES = 900

_MAIN = [
    ("article", ""), ("article", ""), ("article", ""), ("article", "post"), ("main", ""), ("main", ""), ("main", "content"), ("div", "content"), ("div", "post-body"), ("div", "entry-content"),
    ("section", "story"), ("div", "article-text"), ("div", "main"), ("section", "body-text"), ("div", ""), ("div", "page"), ("div", "text"),
]
_WRAPPERS = [("div", "wrapper"), ("div", "container"), ("main", ""), ("div", "page"), ("section", ""), ("div", "row"), ("div", "")]
_MENUS = ["menu", "nav", "navbar", "breadcrumb", "breadcrumbs", "pagination", "toc", "links", "tags", "navigation", "skip"]
_ADVERTS = ["ad", "ads", "advert", "advertisement", "banner", "sponsored", "promo", "promotion", "adsense", "sponsor"]
_NOTICES = ["cookie", "cookie-notice", "notice", "alert", "popup", "modal", "consent", "subscribe", "newsletter", "paywall", "gdpr", "message", "disclaimer"]
_SIDES = ["sidebar", "related", "widget", "side", "recent", "popular", "recommended", "rail", "share", "social", "author-bio", "more"]
_COMMENTS = ["comments", "comment-list", "discussion", "responses", "replies", "reader-comments", "disqus"]


class _Page:
    def __init__(self, seed: int) -> None:
        self.random = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        r = self.random
        out = ["".join(r.choice("abcdefghiklmnoprstuvw") for _ in range(r.randint(1, 9))) + r.choice(["", "", "", "", "", ",", "."]) for _ in range(r.randint(low, high))]
        return " ".join(out).capitalize()

    def sentence(self, low: int, high: int) -> str:
        return self.words(low, high).rstrip(",.") + self.random.choice([".", ".", ".", ".", "!", "?", ""])

    def element(self, tag: str, name: str, inner: str, label: str = "") -> str:
        attributes = f' {self.random.choice(["class", "class", "id"])}="{name}"' if name else ""
        return f"<{tag}{attributes}{f' data-label="{label}"' if label else ''}>{inner}</{tag}>"

    def links(self, count: int) -> str:
        items = [f'<li><a href="/{i}">{self.words(1, 4)}</a></li>' for i in range(count)]
        if self.random.random() < 0.3:
            return " ".join(f'<a href="/{i}">{self.words(1, 3)}</a>' for i in range(count))
        return "<ul>" + "".join(items) + "</ul>"

    def other(self) -> str:
        """Something that is not main text."""
        r = self.random
        kind = r.randrange(8)
        if kind == 0:
            return self.element(r.choice(["nav", "nav", "div", "ul"]), r.choice(["", *_MENUS]), self.links(r.randint(3, 9)), "other")
        if kind == 1:
            inner = r.choice([self.sentence(3, 25), f"<p>{self.sentence(3, 30)}</p>", f'<a href="/x">{self.words(3, 12)}</a>'])
            return self.element(r.choice(["div", "div", "aside", "section"]), r.choice(_ADVERTS), inner, "other")
        if kind == 2:
            inner = f"<p>{self.sentence(5, 40)}</p>" + r.choice(["", f"<button>{self.words(1, 2)}</button>", f'<a href="/c">{self.words(1, 3)}</a>'])
            return self.element(r.choice(["div", "div", "section", "aside", "dialog"]), r.choice(_NOTICES), inner, "other")
        if kind == 3:
            inner = f"<h3>{self.words(1, 4)}</h3>" + r.choice([self.links(r.randint(2, 6)), f"<p>{self.sentence(5, 45)}</p>", f"<div>{self.sentence(5, 30)}</div>"])
            tag = r.choice(["aside", "aside", "div", "section"])
            return self.element(tag, r.choice(["", *_SIDES] if tag == "aside" else _SIDES), inner, "other")
        if kind == 4:
            inner = "".join(f"<label>{self.words(1, 3)}</label><input>" for _ in range(r.randint(1, 4))) + f"<p>{self.sentence(3, 20)}</p>"
            return self.element("form", r.choice(["", "search", "login", "contact", "signup"]), inner, "other")
        if kind == 5:
            tag = r.choice(["div", "div", "div", "li", "li", "p", "p", "article"])
            body = [self.element(tag, r.choice(["comment", "reply", "", "comment-body"]), r.choice(["", f"<h4>{self.words(1, 2)}</h4>"]) + self.sentence(4, 60)) for _ in range(r.randint(1, 6))]
            return self.element(r.choice(["section", "div", "ol", "aside"]), r.choice(_COMMENTS), f"<h3>{self.words(1, 3)}</h3>" + "".join(body), "other")
        if kind == 6:
            inner = r.choice([f"&copy; {self.words(2, 8)}", f"<p>&copy; {self.sentence(3, 20)}</p>", self.links(4) + f"<p>{self.sentence(4, 15)}</p>"])
            return self.element(r.choice(["footer", "footer", "div"]), r.choice(["footer", "copyright", "site-footer", "legal"]), inner, "other")
        inner = r.choice([f"<div>{self.words(1, 5)}</div>", f"<p>{self.words(2, 9)}</p>", f'<a href="/">{self.words(1, 3)}</a>']) + r.choice(["", self.links(4)])
        return self.element(r.choice(["header", "header", "div"]), r.choice(["header", "site-header", "masthead", "topbar", "logo"]), inner, "other")

    def main(self) -> str:
        r = self.random
        parts = [f"<h1>{self.words(2, 12)}</h1>"] if r.random() < 0.85 else []
        for _ in range(r.choice([1, 1, r.randint(1, 12), r.randint(3, 12)])):
            kind = r.randrange(21)
            if kind < 13:
                text = self.sentence(*r.choice([(1, 3), (4, 15), (10, 60), (40, 120)]))
                parts.append(f"<p>{text}</p>" if r.random() < 0.9 else f"<p>{text} <a href='/y'>{self.words(1, 4)}</a> {self.sentence(2, 9)}</p>")
            elif kind < 15:
                parts.append(f"<h2>{self.words(1, 8)}</h2>")
            elif kind in (15, 20):
                tag = r.choice(["ul", "ul", "ol"])
                parts.append(f"<{tag}>" + "".join(f"<li>{self.sentence(2, 20)}</li>" for _ in range(r.randint(2, 6))) + f"</{tag}>")
            elif kind == 16:
                parts.append(f"<blockquote><p>{self.sentence(5, 40)}</p></blockquote>")
            elif kind == 17:
                parts.append("<table>" + "".join(f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 3)}</td></tr>" for _ in range(3)) + "</table>")
            elif kind == 18:
                parts.append(f"<div>{self.sentence(8, 60)}</div>")
            else:
                parts.append(self.other())
        if r.random() < 0.2:
            parts.append(self.other())
        tag, name = r.choice(_MAIN)
        return self.element(tag, name, "".join(parts), "main")

    def html(self) -> str:
        r = self.random
        core = self.main()
        for _ in range(r.randint(0, 2)):
            tag, name = r.choice(_WRAPPERS)
            around = [self.other() for _ in range(r.randint(0, 1))]
            core = self.element(tag, name, core + "".join(around))
        before, after = (["", ""] if r.random() < 0.1 else ["".join(self.other() for _ in range(r.randint(0, 4))) for _ in range(2)])
        return f"<html><head><title>{self.words(2, 8)}</title></head><body>{before}{core}{after}</body></html>"


def labelled_pages(count: int = PAGES) -> list[str]:
    return [_Page(seed).html() for seed in range(count)]
