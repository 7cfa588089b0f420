"""Labelled pages to train the page model on: random layouts around random text, block by block marked as article or not."""

from __future__ import annotations

import random

#: Class and id names that sites use for the parts of a page, by part.
NAMES = {
    "menu": ["nav", "menu", "navbar", "navigation", "main-menu", "breadcrumb", "breadcrumbs", "site-nav", "topbar", "pagination", "toc", "links"],
    "header": ["header", "site-header", "masthead", "branding", "top", "logo", "page-header", "hero"],
    "footer": ["footer", "site-footer", "copyright", "legal", "bottom", "colophon", "page-footer", "credits"],
    "side": ["sidebar", "aside", "widget", "related", "recommended", "side", "trending", "popular", "more-stories", "tags", "rail", "see-also"],
    "notice": ["notice", "cookie", "cookie-banner", "cookie-notice", "consent", "alert", "banner", "gdpr", "popup", "modal", "paywall", "message", "disclaimer"],
    "advert": ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "ad-slot", "adbox", "banner-ad", "promotion"],
    "form": ["form", "search", "newsletter", "subscribe", "signup", "login", "contact-form", "search-form"],
    "share": ["share", "social", "share-buttons", "follow-us"],
    "comments": ["comments", "comment-list", "comment", "reader-comments", "discussion", "responses", "replies", "disqus"],
    "article": ["article", "content", "post", "entry", "main", "story", "post-content", "article-body", "entry-content", "main-content", "text", "body"],
}
LETTERS = "etaoinshrdlucmfwygpbvk"


class Page:
    """HTML of a page, and whether each of its text blocks is article."""

    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)
        self.html: list[str] = []
        self.kept: list[bool] = []
        self.words = ["".join(self.r.choices(LETTERS, k=self.r.randint(1, 10))) for _ in range(300)]

    def text(self, low: int, high: int) -> str:
        words = self.r.choices(self.words, k=self.r.randint(low, high))
        out = " ".join(words).capitalize()
        return out + self.r.choice([".", ".", ".", "", "!", "?", " |", " &amp;&amp;&amp;", ":"])

    def block(self, tag: str, text: str, kept: bool, link: bool = False) -> None:
        if link:
            text = f'<a href="/{self.r.choice(self.words)}">{text}</a>'
        elif self.r.random() < 0.2:
            text = f"<b>{text}" + "</b>" * self.r.randint(0, 1)
        close = "" if tag in ("p", "li") and self.r.random() < 0.2 else f"</{tag}>"
        self.html.append(f"<{tag}>{text}" + "<br>" * (self.r.random() < 0.1) + close)
        self.kept.append(kept)

    def open(self, part: str, tags: list[str]) -> str:
        tag, name = self.r.choice(tags), self.r.choice(NAMES[part])
        plain = tag not in ("div", "section", "ul") and self.r.random() < 0.5
        self.html.append(f"<{tag}>" if plain else f'<{tag} {self.r.choice(["class", "id"])}="{name}">')
        return tag

    def part(self, part: str) -> None:
        r = self.r
        if part == "menu":
            outer = self.open(part, ["nav", "div", "nav", "header"])
            self.html.append("<ul>")
            for _ in range(r.randint(2, 8)):
                self.block("li", self.text(1, 3), False, link=True)
            self.html.append("</ul>")
        elif part == "advert":
            outer = self.open(part, ["div", "div", "aside", "section"])
            if r.random() < 0.4:
                self.html.append(self.text(1, 30))
                self.kept.append(False)
            else:
                for _ in range(r.randint(1, 2)):
                    self.block(r.choice(["p", "div", "h3"]), self.text(1, 30), False, link=r.random() < 0.5)
        elif part == "form":
            outer = "form"
            self.html.append("<form>")
            for _ in range(r.randint(1, 3)):
                self.block(r.choice(["p", "h3", "button", "div"]), self.text(1, 8), False)
            self.html.append('<input type="text">')
        elif part == "footer":
            outer = self.open(part, ["footer", "footer", "div"])
            if r.random() < 0.5:
                self.html.append("&copy; " + self.text(3, 40))
                self.kept.append(False)
            else:
                for _ in range(r.randint(1, 4)):
                    self.block(r.choice(["p", "li", "div"]), self.text(1, 25), False, link=r.random() < 0.4)
        else:
            outer = self.open(part, {"header": ["header", "div"], "side": ["aside", "aside", "div", "section"], "comments": ["section", "div", "ul"]}.get(part, ["div", "section"]))
            for _ in range(r.randint(1, 6 if part == "comments" else 4)):
                self.block(r.choice(["p", "li", "h3", "div", "h1"] if part == "header" else ["p", "p", "li", "h3", "div"]), self.text(1, 40), False, link=r.random() < 0.3)
        self.html.append(f"</{outer}>")

    def article(self) -> None:
        r = self.r
        outer = ["article"] if r.random() < 0.65 else []
        if not outer or r.random() < 0.3:
            outer.insert(0, "main" if r.random() < 0.3 else "div")
        for tag in outer:
            self.html.append(f"<{tag}>" if tag != "div" else f'<div {r.choice(["class", "id"])}="{r.choice(NAMES["article"])}">')
        if r.random() < 0.9:
            self.block("h1", self.text(1, 14), True)
        for _ in range(r.choice([0, 1, 2, 3, 6, 12, 20])):
            kind = r.random()
            if kind < 0.78:
                self.block("p", self.text(1, r.choice([2, 10, 60, 100])), True)
            elif kind < 0.86:
                self.block(r.choice(["h2", "h3", "blockquote", "pre"]), self.text(1, 20), True)
            elif kind < 0.9:
                self.html.append("<ul>")
                for _ in range(r.randint(1, 4)):
                    self.block("li", self.text(1, 15), True)
                self.html.append("</ul>")
            else:
                self.part(r.choice(["advert", "side", "share", "form", "notice"]))
        if r.random() < 0.15:
            self.part("comments")
        for tag in reversed(outer):
            self.html.append(f"</{tag}>")

    def build(self) -> tuple[str, list[bool]]:
        r = self.r
        for part, often in (("notice", 0.3), ("header", 0.4), ("menu", 0.8), ("advert", 0.5), ("side", 0.2), ("form", 0.15)):
            if r.random() < often:
                self.part(part)
        self.article()
        for part, often in (("share", 0.2), ("comments", 0.35), ("side", 0.35), ("advert", 0.2), ("form", 0.15), ("notice", 0.1), ("footer", 0.85)):
            if r.random() < often:
                self.part(part)
        return f"<!DOCTYPE html><html><head><title>x</title></head><body>{''.join(self.html)}</body></html>", self.kept
