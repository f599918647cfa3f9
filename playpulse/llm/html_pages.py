"""Labelled pages to train on: layouts written by hand, filled with invented words.

Elements whose text is main text carry ``data-main="1"``; inside them ``data-main="0"`` takes
it back. Layouts use semantic elements, telling or meaningless class names, or old tables; some
pages are an article alone, in one element or in none. Names can mislead: themes name the page,
or a wrapper of the article, after parts that stand beside it. Prose can be one whole link.
"""

from __future__ import annotations

import random

from playpulse.llm.html_blocks import MARK

SYLLABLES = [
    "th er on an re he in ed nd ha at en es of or nt ti to it st ing ble ly".split(),
    "de la que el os as ción mente rr ñ ado ar ez co mi".split(),
    "en er ch ei sch ung keit lich ß ü be ver tz heit".split(),
    "на по ст но ен то ра ко ов ни ер ой ия".split(),
    "中 文 字 的 一 是 在 人 有 我 他 这 个 们".split(),
]
MAIN, PLAIN = f' {MARK}="1"', f' {MARK}="0"'


class Writer:
    """Invented text and the parts of a page."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.syllables = self.r.choice(SYLLABLES + SYLLABLES[:3])
        self.style = self.r.choice(["semantic", "semantic", "classes", "classes", "bare", "table"])

    def some(self, chance: float) -> bool:
        return self.r.random() < chance

    def word(self) -> str:
        return "".join(self.r.choices(self.syllables, k=self.r.randint(1, 4)))

    def words(self, a: int, b: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(a, b)))

    def sentence(self, a: int = 3, b: int = 18) -> str:
        return self.words(a, b).capitalize() + self.r.choice([".", ".", ".", "!", "?", ", " + self.words(2, 6) + "."])

    def prose(self) -> str:
        text = " ".join(self.sentence() for _ in range(self.r.choice([1, 1, 2, 3, 5, 9])))
        if self.some(0.07):
            return f'<a href="/{self.word()}">{text}</a>'
        if self.some(0.2):
            text = text.replace(" ", f' <a href="/{self.word()}">{self.word()}</a> ', 1)
        if self.some(0.25):
            text = f"<b>{text[: len(text) // 2]}" + ("</b>" if self.some(0.6) else "") + text[len(text) // 2 :]
        if self.some(0.1):
            text = text.replace(" ", self.r.choice([" &amp; ", " &quot;x&quot; ", " ### ", " *** ", " | ", "!! "]))
        return text

    def links(self, a: int = 3, b: int = 8) -> str:
        end = self.r.choice(["", "", "", ".", ",", " |"])
        items = "".join(f'<li><a href="/{self.word()}">{self.words(1, 3)}{end if self.some(0.3) else ""}</a></li>' for _ in range(self.r.randint(a, b)))
        return f"<ul>{items}</ul>" if self.some(0.8) else items.replace("<li>", " ").replace("</li>", " | ")

    def box(self, element: str, names: str, inner: str, extra: str = "") -> str:
        """A part by its own element, by a telling name, or by nothing."""
        if self.style == "semantic" and element and self.some(0.8):
            return f"<{element}{extra}>{inner}</{element}>"
        if self.style in ("semantic", "classes") or self.some(0.15):
            return f'<div {self.r.choice(["class", "class", "id"])}="{self.r.choice(names.split())}"{extra}>{inner}</div>'
        if self.style == "table":
            return f"<table><tr><td{extra}>{inner}</td></tr></table>"
        return f'<div class="{self.r.choice(["c1", "x", "box", "row", "wrap"])}"{extra}>{inner}</div>'

    def ad(self) -> str:
        text = f"<p>{self.sentence()}</p>" if self.some(0.4) else self.sentence(2, 12) if self.some(0.7) else self.prose()
        return f'<div class="{self.r.choice("ad ads advert sponsored promo ad-slot banner".split())}"{PLAIN}>{text}</div>'

    def notice(self) -> str:
        names = self.r.choice("notice cookie-notice consent alert popup cookie-banner message".split())
        role = ' role="alert"' if self.some(0.3) else ""
        text = f"<p>{self.sentence()} {self.sentence()}</p>" if self.some(0.6) else self.prose()
        button = f"<button>{self.word()}</button>" if self.some(0.6) else ""
        return f'<div class="{names}"{role}{PLAIN}>{text}{button}</div>'

    def form(self) -> str:
        inner = f"<label>{self.words(1, 3)}</label><input name=q><button>{self.word()}</button>"
        if self.some(0.5):
            inner = (f"<p>{self.sentence()}</p>" if self.some(0.7) else f"<label>{self.prose()}</label>") + inner
        if self.some(0.2):
            inner += f"<select><option>{self.word()}<option>{self.word()}</select>"
        form = f"<form action=/s{PLAIN}>{inner}</form>"
        return f'<div class="{self.r.choice("newsletter signup search login".split())}"{PLAIN}>{form}</div>' if self.some(0.5) else form

    def share(self) -> str:
        return f'<div class="{self.r.choice("share social share-bar follow".split())}"{PLAIN}>{self.links(2, 4)}</div>'

    def comments(self) -> str:
        items = ""
        for _ in range(self.r.randint(1, 6)):
            tag = self.r.choice(["li", "div", "article"])
            body = f"<p>{self.prose()}</p>" if self.some(0.8) else self.prose()
            items += f'<{tag} class="{self.r.choice(["comment", "comment", "reply"])}"><b>{self.word()}</b> {body}</{tag}>'
        names = self.r.choice("comments comment-list discussion respond comments-area".split())
        heading = f"<h2>{self.words(1, 3)}</h2>" if self.some(0.6) else ""
        form = self.form() if self.some(0.4) else ""
        tag = self.r.choice(["section", "div"])
        return f'<{tag} {self.r.choice(["class", "id"])}="{names}"{PLAIN}>{heading}{items}{form}</{tag}>'

    def sidebar(self) -> str:
        """With links, prose or both; one without a telling name has links."""
        told = self.style in ("semantic", "classes")
        prose = "".join(f"<p>{self.prose()}</p>" if self.some(0.8) else f"<div>{self.prose()}</div>" for _ in range(self.r.randint(1, 3)))
        inner = f"<h3>{self.words(1, 3)}</h3>" if self.some(0.6) else ""
        inner += self.links() if self.some(0.6) or not told else ""
        inner += prose if told and self.some(0.7) else f"<p>{self.sentence()}</p>"
        if told:
            name = self.r.choice("sidebar widget related rail aside".split())
            return f"<aside{PLAIN}>{inner}</aside>" if self.some(0.5) else f'<div {self.r.choice(["class", "id"])}="{name}"{PLAIN}>{inner}</div>'
        return self.box("aside", "sidebar widget related rail", inner, PLAIN) if self.style != "bare" or self.some(0.5) else ""

    def body(self) -> str:
        parts = []
        plain = self.some(0.12)  # paragraphs are mere divisions
        for _ in range(self.r.choice([1, 2, 3, 4, 6, 9, 14])):
            kind = self.r.random()
            if kind < 0.72 and plain:
                parts.append(f"<div>{self.prose()}</div>")
            elif kind < 0.72:
                end = self.r.choice(["</p>", "</p>", "</p>", "<br>", ""])
                parts.append(f"<p>{self.prose()}{end}")
            elif kind < 0.78:
                level = self.r.choice("23")
                parts.append(f"<h{level}>{self.words(1, 7)}</h{level}>")
            elif kind < 0.83:
                parts.append("<ul>" + "".join(f"<li>{self.sentence()}</li>" for _ in range(self.r.randint(2, 5))) + "</ul>")
            elif kind < 0.86:
                parts.append(f"<blockquote><p>{self.prose()}</p></blockquote>")
            elif kind < 0.88:
                parts.append(f"<pre>{self.words(3, 20)}</pre>")
            elif kind < 0.90:
                parts.append(f"<figure><img src=x><figcaption>{self.sentence()}</figcaption></figure>")
            elif kind < 0.92:
                cells = "".join(f"<tr><td>{self.words(1, 4)}</td><td>{self.r.randint(1, 999)}</td></tr>" for _ in range(3))
                parts.append(f"<table>{cells}</table>")
            elif kind < 0.95:
                parts.append(f"<div>{self.prose()}</div>")
            else:
                parts.append(self.r.choice([self.ad, self.share, self.form, self.notice])())
        return "".join(parts)

    def theme(self) -> str:
        """A name that speaks of other parts than the element that bears it."""
        form = self.r.choice(["has-{}", "no-{}", "with-{}", "{}-layout", "{}-page", "{}", "content-{}", "right-{}"])
        clear = "sidebar ads comments footer nav menu " if form not in ("{}", "content-{}", "right-{}") else ""  # alone they mean what they say
        return form.format(self.r.choice((clear + "header banner widget social message modal form share popup top").split()))

    def wrapped(self, inner: str) -> str:
        """In an element with a misleading name, now and then."""
        if not self.some(0.25):
            return inner
        more = self.r.choice(["", "", " body", " main", " post", " single"])
        return f'<div {self.r.choice(["class", "class", "id"])}="{self.theme()}{more}">{inner}</div>'

    def alone(self) -> str:
        """An article and nothing else."""
        inner = self.r.choice([
            lambda: self.body(), lambda: f"<h1>{self.words(2, 9)}</h1>{self.body()}", lambda: self.sentence(), lambda: self.prose(),
            lambda: f"<p>{self.prose()}</p>", lambda: "".join(f"<p>{self.prose()}</p>" for _ in range(self.r.randint(2, 6))),
            lambda: "<br><br>".join(self.prose() for _ in range(self.r.randint(1, 5))),
        ])()
        tag = self.r.choice(["", "", "div", "div", "article", "main", "section", "td"])
        inner = f"<table><tr><td>{inner}</td></tr></table>" if tag == "td" else f"<{tag}>{inner}</{tag}>" if tag else inner
        head = f"<head><title>{self.words(2, 9)}</title></head>" if self.some(0.5) else ""
        return f"<html>{head}<body{MAIN}>{self.wrapped(inner)}</body></html>"

    def article(self) -> str:
        title = f"<h1>{self.words(2, 9)}</h1>" if self.some(0.85) else ""
        byline = f'<div class="{self.r.choice("byline meta author date".split())}"{PLAIN}>{self.words(2, 5)} {self.r.randint(1, 31)}.{self.r.randint(1, 12)}.</div>' if self.some(0.25) else ""
        if self.some(0.12):
            title = f"<header>{title}</header>"
        inner = title + byline + self.wrapped(self.body())
        if self.some(0.12):
            tags = self.r.choice([f"{self.words(1, 2)}: {self.links(1, 3)}", f"<p>{self.sentence()}</p>", self.words(2, 6)])
            inner += f"<footer{PLAIN}>{tags}</footer>"
        after = "".join(f() for f, c in ((self.share, 0.15), (self.comments, 0.15), (self.sidebar, 0.1)) if self.some(c))
        element = self.r.choice(["article", "article", "main"])
        return self.box(element, "content article post entry story post-body main article-content", inner + after, MAIN)

    def page(self) -> str:
        if self.some(0.12):
            return self.alone()
        logo = f"<a href=/>{self.words(1, 2)}</a>" + (f"<p>{self.words(2, 6)}</p>" if self.some(0.4) else "")
        before = [
            (self.notice, 0.25), (lambda: self.box("header", "header masthead top branding", logo, PLAIN), 0.5),
            (lambda: self.box("nav", "nav menu navbar breadcrumbs", self.links(), PLAIN), 0.85), (self.form, 0.2), (self.ad, 0.4), (self.sidebar, 0.15),
        ]
        foot = self.r.choice(["&copy; ", "© ", "Copyright ", ""]) + f"{self.word()}.example.org &middot; {self.sentence()}"
        foot += self.links(2, 4) if self.some(0.3) else self.prose() if self.some(0.3) else ""
        after = [
            (self.ad, 0.25), (self.comments, 0.35), (self.sidebar, 0.3), (self.form, 0.15), (self.notice, 0.1),
            (lambda: self.box("footer", "footer copyright legal bottom", foot if self.some(0.6) else f"<p>{foot}</p>", PLAIN), 0.9),
        ]
        self.r.shuffle(before)
        part = lambda parts: "".join(f() for f, c in parts if self.some(c))
        open_ = self.some(0.08)  # the article stands in the page itself
        article = f"<h1>{self.words(2, 9)}</h1>" * self.some(0.7) + self.body() if open_ else self.wrapped(self.article())
        main = self.wrapped(part(before) + "<!-- x -->" + article + part(after))
        if self.some(0.3):
            main = f'<div class="{self.r.choice(["wrap", "container", "page", "site"])}">{main}</div>'
        head = f"<head><meta charset=utf-8><title>{self.words(2, 9)}</title><script>var a = '<p>';</script><style>p{{}}</style></head>"
        theme = f' class="{self.theme()} {self.theme()}"' if self.some(0.4) else ""
        return f"<!DOCTYPE html><html>{head}<body{theme}{MAIN if open_ else ''}>{main}" + ("</body></html>" if self.some(0.8) else "")


def labelled_pages(n: int, seed: int = 1) -> list[str]:
    return [Writer(seed * 1_000_003 + i).page() for i in range(n)]
