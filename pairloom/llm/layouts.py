"""Labelled pages: layouts put together at random from the usual parts of web pages, each block known to be main
text or not. The words mean nothing, and main and other parts draw on the same lengths, so a model has to learn from
structure first and from the look of a text second."""

from __future__ import annotations

import html
import random

SYLLABLES = "an ber co da el fi gu ha in jo ka lu mo ne or pa qui ro sa te un vi wo xe yo za ß é ñ ü ão 中 я".split()

# Names that sites give to their parts, by part.
NAMES = {
    "main": "content|main-content|post|post-body|entry|entry-content|article-body|story|text|page-content|body-text|copy",
    "nav": "nav|menu|navbar|main-menu|topnav|breadcrumb|breadcrumbs|pagination|tabs|site-navigation|links",
    "header": "header|masthead|site-header|top|topbar|banner|branding|logo|site-title",
    "footer": "footer|site-footer|bottom|colophon|copyright|legal|credits|imprint",
    "side": "sidebar|side|aside|widget|related|recommended|trending|popular|recent-posts|more-stories|right-column|rail|tags|author-box",
    "notice": "notice|cookie|cookie-notice|cookies|consent|gdpr|alert|banner-notice|privacy-notice|message|popup|modal|paywall|warning|disclaimer",
    "ad": "ad|ads|advert|advertisement|sponsored|sponsor|promo|promotion|ad-slot|banner-ad|adsbox|partner|teaser",
    "form": "form|search|search-form|newsletter|subscribe|signup|login|contact-form|subscription|register",
    "comments": "comments|comment|comment-list|comment-body|responses|reader-comments|discussion|replies|reply|disqus|guestbook|reactions",
    "share": "share|social|sharing|follow|share-buttons|social-media|toolbar|buttons|actions|byline-tools",
}
TAGS = {
    "main": ["article", "main", "div", "section", "div"],
    "nav": ["nav", "nav", "div", "ul", "menu"],
    "header": ["header", "header", "div"],
    "footer": ["footer", "footer", "div", "section"],
    "side": ["aside", "aside", "div", "section"],
    "notice": ["div", "section", "p", "aside", "dialog"],
    "ad": ["div", "div", "aside", "section", "p"],
    "form": ["form", "form", "div"],
    "comments": ["section", "div", "ol", "ul", "div"],
    "share": ["div", "ul"],
}
OWN_TAG = {"nav", "header", "footer", "aside", "form", "article", "main", "menu"}


class Layout:
    """One page under construction: its markup, and the text of its main blocks."""

    def __init__(self, rng: random.Random):
        self.rng = rng
        self.main: list[str] = []
        self.style = rng.choice(["plain", "plain", "plain", "marked", "capitals", "bars", "short"])

    def word(self) -> str:
        return "".join(self.rng.choice(SYLLABLES) for _ in range(self.rng.randint(1, 4)))

    def sentence(self, most: int) -> str:
        words = [self.word() for _ in range(self.rng.randint(1, most))]
        if self.style == "marked":
            words = [w + self.rng.choice(["***", "$$$", "%%%", "###", "&&&"]) for w in words]
        if self.style == "capitals":
            words = [w.upper() + "!!" for w in words]
        if self.style == "bars":
            return " | ".join(words)
        return " ".join(words).capitalize() + self.rng.choice([".", ".", ".", "", "?"])

    def text(self) -> str:
        most = self.rng.choice([1, 4, 12, 30] if self.style == "short" else [2, 6, 12, 30, 60])
        text = " ".join(self.sentence(most) for _ in range(self.rng.choice([1, 1, 2, 4, 8])))
        return self.rng.choice([text, text, text, f"{text} {self.rng.randint(1, 2030)}"])

    def block(self, tag: str, text: str, main: bool) -> str:
        if main:
            self.main.append(" ".join(text.split()))
        shown = html.escape(text, quote=False)
        if self.rng.random() < 0.15:
            shown = f"<b>{shown}</b>"
        if self.rng.random() < 0.1:
            shown += f'<a href="/{self.rng.randint(1, 99)}"></a>'
        end = "" if tag in ("p", "li") and self.rng.random() < 0.1 else f"</{tag}>"
        return f"<{tag}>{shown}{end}"

    def hidden(self) -> str:
        """Now and then a part is not shown at first, whatever it holds."""
        shown = self.rng.random() >= 0.04
        return "" if shown else self.rng.choice([" hidden", ' style="display:none"', ' aria-hidden="true" hidden'])

    def part(self, kind: str, inner: str, named: float = 0.75) -> str:
        tag = self.rng.choice(TAGS[kind])
        name = self.rng.choice(NAMES[kind].split("|"))
        hidden = self.hidden()
        if tag not in OWN_TAG or self.rng.random() < named * 0.5:
            attribute = self.rng.choice(["class", "class", "id"])
            more = self.rng.choice(["", " box", " col-8", " wide"]) if attribute == "class" else ""
            return f'<{tag} {attribute}="{name}{more}"{hidden}>{inner}</{tag}>'
        return f"<{tag}{hidden}>{inner}</{tag}>"

    def links(self, tag: str) -> str:
        items = "".join(
            f'<{tag}><a href="/{i}">{html.escape(self.sentence(3), quote=False)}</a></{tag}>'
            for i in range(self.rng.randint(1, 8))
        )
        return f"<ul>{items}</ul>" if tag == "li" else items

    def other(self, kind: str) -> str:
        rng = self.rng
        if kind == "nav":
            return self.part(kind, self.links(rng.choice(["li", "li", "div"])))
        if kind == "form":
            label = self.block("label", self.sentence(4), False)
            return self.part(kind, f"{label}<input type=text><button>{self.sentence(2)}</button>" + self.some(rng.randint(0, 2)))
        if kind == "side":
            title = self.block(rng.choice(["h2", "h3", "h4"]), self.sentence(4), False)
            return self.part(kind, title + rng.choice([self.links("li"), self.some(rng.randint(1, 4))]))
        if kind == "comments":
            title = self.block(rng.choice(["h2", "h3"]), self.sentence(4), False) if rng.random() < 0.7 else ""
            one = lambda: f'<{(t := rng.choice(["div", "li", "article", "blockquote"]))} class="{rng.choice(["comment", "reply", "comment-body", "item"])}">{self.some(rng.randint(1, 3))}</{t}>'
            return self.part(kind, title + "".join(one() for _ in range(rng.randint(1, 5))), 1.0)
        if kind == "footer":
            mark = html.escape(f"© {self.rng.randint(1990, 2030)} {self.sentence(6)}") if rng.random() < 0.6 else self.text()
            return self.part(kind, rng.choice(["", self.links("li")]) + rng.choice([f"<p>{mark}</p>", mark]))
        if kind == "share":
            return self.part(kind, self.links("li"), 1.0)
        inner = rng.choice([html.escape(self.text(), quote=False), self.some(rng.randint(1, 3))])
        return self.part(kind, inner)

    def some(self, n: int) -> str:
        return "".join(self.block(self.rng.choice(["p", "p", "p", "div", "span"]), self.text(), False) + " " for _ in range(n))

    def article(self) -> str:
        rng, out = self.rng, []
        # An article keeps to one way of making paragraphs: most use p, others a div, a span in a div, or bare text.
        paragraph = rng.choice(["p", "p", "p", "p", "div", "div", "div p", "bare", "section"])
        if rng.random() < 0.85:
            out.append(self.block(rng.choice(["h1", "h1", "h1", "h2", "h3", "div"]), self.sentence(10), True))
        for _ in range(rng.choice([1, 1, 2, 4, 8, 16])):
            kind = rng.random()
            if kind < 0.62:
                out.append(self.paragraph(paragraph))
            elif kind < 0.71:
                out.append(self.block(rng.choice(["h2", "h3", "h4", "h5", "h6", "pre"]), self.sentence(8), True))
            elif kind < 0.75:
                tag = rng.choice(["ul", "ol"])
                items = "".join(self.block("li", self.text(), True) for _ in range(rng.randint(1, 5)))
                out.append(f"<{tag}>{items}</{tag}>")
            elif kind < 0.78:
                items = "".join(self.block("dt", self.sentence(4), True) + self.block("dd", self.text(), True) for _ in range(rng.randint(1, 3)))
                out.append(f"<dl>{items}</dl>")
            elif kind < 0.81:
                out.append(f"<blockquote>{self.block('p', self.text(), True)}</blockquote>")
            elif kind < 0.83:
                out.append(f'<figure><img src="/{rng.randint(1, 99)}.png">{self.block("figcaption", self.sentence(12), True)}</figure>')
            elif kind < 0.87:
                names = [self.block("th", self.sentence(3), True) for _ in range(rng.choice([0, 2]))]
                head = f"<tr>{''.join(names)}</tr>" if names else ""
                rows = [f"<tr>{self.block('td', self.sentence(3), True)}{self.block('td', self.sentence(3), True)}</tr>" for _ in range(rng.randint(1, 4))]
                out.append(f"<table>{head}{''.join(rows)}</table>")
            else:
                out.append(self.other(rng.choice(["ad", "ad", "side", "form", "share", "notice"])))
        if rng.random() < 0.15:
            out.append(self.other("comments"))
        inner = "".join(out)
        wrap = rng.random()
        if wrap < 0.35:
            return f"<article>{inner}</article>"
        if wrap < 0.45:
            return f"<main>{rng.choice([inner, f'<article>{inner}</article>'])}</main>"
        if wrap < 0.75:
            return self.part("main", inner, 1.0)
        if wrap < 0.92:
            return f"<{(tag := rng.choice(['div', 'div', 'div', 'section']))}>{inner}</{tag}>"
        return inner

    def paragraph(self, kind: str) -> str:
        if kind == "div p":
            return f"<div>{self.block('p', self.text(), True)}</div>"
        if kind != "bare":
            return self.block(kind, self.text(), True)
        text = self.text()
        self.main.append(" ".join(text.split()))
        return f"{html.escape(text, quote=False)}<hr>"

    def page(self) -> str:
        rng = self.rng
        before = [k for k in ("notice", "header", "nav", "ad", "form", "share") if rng.random() < 0.4]
        after = [k for k in ("share", "ad", "side", "comments", "form", "nav", "notice", "footer") if rng.random() < 0.4]
        rng.shuffle(before)
        early = rng.random() < 0.2
        parts = [self.other(k) for k in before] + ([self.other("side")] if early else [])
        parts.append(self.article())
        parts += [self.other(k) for k in after]
        title = html.escape(self.sentence(8), quote=False)
        body = rng.choice(["", "\n"]).join(parts)
        if rng.random() < 0.3:
            body = f'<div class="{rng.choice(["wrapper", "container", "page", "site"])}">{body}</div>'
        return f"<!DOCTYPE html><html><head><title>{title}</title></head><body>{body}</body></html>"


def labelled_pages(n: int, seed: int = 7) -> list[tuple[str, list[str]]]:
    """``n`` pages with the texts of their main blocks in page order."""
    out = []
    for i in range(n):
        layout = Layout(random.Random(seed * 1_000_003 + i))
        out.append((layout.page(), layout.main))
    return out
