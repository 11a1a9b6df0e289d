"""Labelled pages for training the block labeller: layouts drawn at random, whose blocks are known to be article or not.

A page puts an article (headings, paragraphs, lists, quotes, tables, code) among menus, headers, sidebars, notices, adverts, forms, footers and
reader comments, in containers that name their part by their tag, by class or id words, or not at all. Texts are words made of random syllables, in
boilerplate mixed with words that are common there; so a block is told by its path, its words and what stands around it, never by one of them alone.
"""

from __future__ import annotations

import random

# Words that boilerplate often has, by part; and class or id words of parts.
WORDS = {
    "menu": "home about contact news blog products services login register sign in search menu archive topics sitemap help faq shop account start kontakt accueil inicio",
    "header": "welcome to our site logo tagline daily edition subscribe follow us today",
    "notice": "we use cookies to improve your experience accept all decline settings privacy policy this site uses consent agree wir verwenden nous utilisons",
    "ad": "sponsored advertisement buy now save offer deal free shipping click here limited discount sale anzeige publicité",
    "form": "your name email address message submit send subscribe to our newsletter password remember me required field search",
    "side": "related articles popular posts most read recent tags categories read more trending share tweet like follow see also you may also like",
    "footer": "copyright all rights reserved terms of use privacy imprint contact us powered by imprint impressum mentions légales",
    "comment": "reply posted by says ago thanks great post i agree disagree comment report flag likes user guest wrote upvote",
}
NAMES = {
    "menu": "nav navbar menu navigation main-nav topnav breadcrumb breadcrumbs submenu pagination skip-links",
    "header": "header masthead site-header page-header top-bar branding banner logo",
    "notice": "cookie-notice cookie-banner consent notice alert gdpr-popup modal message-bar warning disclaimer paywall",
    "ad": "ad ads advert advertisement sponsored promo adsense banner-ad ad-slot sponsor",
    "form": "form newsletter signup subscribe-box login-form search-form contact-form",
    "side": "sidebar aside related widget rail right-column share social tags trending popular",
    "footer": "footer site-footer page-footer bottom colophon copyright legal",
    "comment": "comments comment comment-list discussion replies respond disqus reader-comments thread",
    "article": "article content post entry main story article-body post-content entry-content text body page-content",
    "plain": "wrap wrapper container row col inner box section block outer layout grid page",
}
TAGS = {"menu": ("nav", "menu"), "header": ("header",), "notice": ("dialog", "div"), "ad": ("aside", "ins"), "form": ("form",), "side": ("aside",), "footer": ("footer",), "comment": ("section",), "article": ("article", "main")}
_SYLLABLES = "a an ar be ber ca ci con da de der di do e el en er es et fa ge ha he i in io is ja ka la le li lo ma me mi na ne no o on or pa per qu ra re ri ro sa se ser si ta te ter th ti to tion u ul un ve vi wa we y za é è ä ö ü ß ó ñ".split()


class Layout:
    """One random page; html and the texts of the article's blocks."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        r = self.r
        self.words = ["".join(r.choices(_SYLLABLES, k=r.choice((1, 1, 2, 2, 3, 4)))) for _ in range(300)]
        self.semantic, self.named = r.choice(((1.0, 0.1), (1.0, 0.7), (0.9, 0.9), (0.5, 0.9), (0.05, 1.0), (0.05, 0.95), (0.3, 0.6)))
        self.closed = r.random() < 0.8
        self.junk, self.dull = r.random() < 0.15, r.random() < 0.1
        self.out: list[tuple[str, bool]] = []
        self.html = self.page()

    # texts

    def some(self, n: int) -> list[str]:
        out = self.r.choices(self.words, weights=[1 / (k + 3) for k in range(len(self.words))], k=n)
        if self.dull and self.r.random() < 0.5:
            out = out[:1] * n
        return [w + self.r.choice(("###", "***", "%%%", "$$$", "&&&")) for w in out] if self.junk and self.r.random() < 0.7 else out

    def sentence(self) -> str:
        w = self.some(self.r.randint(1, 18))
        return " ".join(w).capitalize() + self.r.choice((".", ".", ".", "!", "?", ""))

    def sentences(self, most: int) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(1, most)))

    def boiler(self, part: str, n: int) -> str:
        own = WORDS[part].split()
        k = self.r.random()
        w = [self.r.choice(own) if self.r.random() < k else self.r.choice(self.words) for _ in range(n)]
        t = " ".join(w)
        return self.r.choice((t, t.capitalize(), t.title(), t + "."))

    # markup

    def escaped(self, t: str) -> str:
        return t.replace("&", self.r.choice(("&amp;", "&"))).replace("<", "&lt;")

    def block(self, tag: str, text: str, article: bool, link: float = 0.0, attrs: str = "") -> str:
        self.out.append((text, article))
        t = self.escaped(text)
        if self.r.random() < link:
            t = f'<a href="/{self.r.randint(1, 999)}">{t}</a>'
        elif article and self.r.random() < 0.25:
            words = t.split(" ")
            i = self.r.randrange(len(words))
            mark = self.r.choice(("b", "i", "em", "strong", "a", "span", "code"))
            words[i] = f"<{mark}>{words[i]}</{mark}>"
            t = " ".join(words)
        elif article and tag == "p" and self.r.random() < 0.1:
            return f"<p><b>{t}<br>"
        end = "" if tag in ("p", "li") and not self.closed else f"</{tag}>"
        return f"<{tag}{attrs}>{t}{end}" + self.r.choice(("", "\n", " "))

    def part(self, part: str, inner: str, tag: str | None = None) -> str:
        r = self.r
        tag = tag or (r.choice(TAGS[part]) if part in TAGS and r.random() < self.semantic else r.choice(("div", "div", "div", "section", "td") if part != "plain" else ("div",)))
        names = r.choice(NAMES[part].split()) if r.random() < self.named else r.choice(("", r.choice(NAMES["plain"].split()), f"x{r.randint(1, 99)}"))
        attrs = f' {r.choice(("class", "class", "id"))}="{names}"' if names else ""
        if tag == "td":
            return f"<table><tr><td{attrs}>{inner}</td></tr></table>"
        return f"<{tag}{attrs}>{inner}</{tag}>\n"

    def menu(self, part: str = "menu") -> str:
        n = self.r.randint(2, 9)
        if self.r.random() < 0.7:
            return self.part(part, "<ul>" + "".join(self.block("li", self.boiler(part, self.r.randint(1, 3)), False, 1.0) for _ in range(n)) + "</ul>")
        text = [self.boiler(part, self.r.randint(1, 3)) for _ in range(n)]
        sep = self.r.choice((" ", " | ", " · "))
        self.out.append((sep.join(text).strip(), False))
        return self.part(part, "<div>" + sep.join(f'<a href="#">{self.escaped(t)}</a>' for t in text) + "</div>")

    def boxed(self, part: str) -> str:
        r, inner = self.r, ""
        if r.random() < 0.5:
            inner += self.block(r.choice(("h2", "h3", "h4", "div")), self.boiler(part, r.randint(1, 4)), False)
        for _ in range(r.randint(1, 4 if part in ("side", "comment") else 2)):
            long = r.random() < (0.75 if part in ("comment", "ad", "notice") else 0.3)
            text = self.sentences(3) if long and r.random() < 0.7 else self.boiler(part, r.randint(2, 20 if long else 6))
            if part == "comment":
                inner += self.part("comment", self.block(r.choice(("div", "span", "h4")) if r.random() < 0.7 else "p", self.boiler("comment", r.randint(1, 4)), False) + self.block("p", text, False), r.choice(("div", "li", "div")))
            else:
                inner += self.block(r.choice(("p", "div", "li", "span") if part != "ad" else ("div", "p")), text, False, 0.5 if part == "side" else 0.2) if r.random() < 0.9 else self.menu(part)
        if part == "form":
            inner += f'<label>{self.escaped(self.said("form", 2))}</label><input name="q"><button>{self.escaped(self.said("form", 1))}</button>'
        if part in ("ad", "footer", "notice") and r.random() < 0.5:  # text right in the container
            text = self.boiler(part, r.randint(2, 12)) if r.random() < 0.5 else self.sentences(2)
            if part == "footer" and r.random() < 0.5:
                text = f"© {r.choice(('', '2024 ', r.choice(self.words) + '.example.com · '))}{text}"
            self.out.append((text, False))
            return self.part(part, self.escaped(text))
        return self.part(part, inner)

    def said(self, part: str, n: int) -> str:
        text = self.boiler(part, n)
        self.out.append((text, False))
        return text

    def story(self) -> str:
        r, inner = self.r, ""
        title = self.sentence() if r.random() < 0.8 else self.sentences(2)
        if r.random() < 0.85:
            inner += self.block("h1", title, True)
        for _ in range(r.choice((1, 2, 3, 5, 8, 13, 20))):
            k = r.random()
            if k < 0.75:
                inner += self.block("p", self.sentences(r.choice((1, 3, 8))), True)
            elif k < 0.83:
                inner += self.block(r.choice(("h2", "h3")), self.sentence(), True)
            elif k < 0.88:
                inner += r.choice(("<ul>{}</ul>", "<ol>{}</ol>")).format("".join(self.block("li", self.sentence(), True) for _ in range(r.randint(1, 5))))
            elif k < 0.92:
                inner += "<blockquote>" + self.block("p", self.sentences(2), True) + "</blockquote>"
            elif k < 0.94:
                inner += self.block("pre", self.sentences(2), True)
            elif k < 0.96:
                inner += "<figure><img src='x.png' alt='x'>" + self.block("figcaption", self.sentence(), True) + "</figure>"
            elif k < 0.975:
                inner += "<table>" + "".join("<tr>" + "".join(self.block("td", self.sentence(), True) for _ in range(2)) + "</tr>" for _ in range(r.randint(1, 3))) + "</table>"
            else:
                inner += self.boxed(r.choice(("ad", "side", "form", "notice")))
        return inner

    def page(self) -> str:
        r, top, body = self.r, "", ""
        some = lambda p: r.random() < p
        if some(0.3):
            top += self.boxed("notice")
        if some(0.5):
            top += self.part("header", (self.block(r.choice(("div", "p", "h2", "span")), self.boiler("header", r.randint(1, 6)), False)) + (self.menu() if some(0.5) else ""))
        if some(0.8):
            top += self.menu()
        if some(0.1):
            top += self.menu()
        if some(0.15):
            top += self.boxed("form")
        if some(0.4):
            top += f"<!-- ad {r.randint(0, 99)} -->" + self.boxed("ad")
        if some(0.3):
            top += self.boxed("side")
        story = self.part("article", self.story() + (self.menu("side") if some(0.1) else "") + (self.boxed("comment") if some(0.1) else ""))
        if some(0.3):
            story = self.part("plain", story)
        for p, part in ((0.35, "comment"), (0.3, "side"), (0.2, "ad"), (0.15, "form"), (0.1, "notice")):
            if some(p):
                body += self.boxed(part)
        if some(0.85):
            body += self.boxed("footer") if some(0.7) else self.menu("footer")
        head = f"<!DOCTYPE html><html><head><title>{self.escaped(self.sentence())}</title><style>p{{margin:0}}</style><script>var x = '</p>';</script></head><body>"
        end = "" if some(0.1) else "</body></html>"
        whole = top + story + body
        return head + (self.part("plain", whole, "div") if some(0.3) else whole) + end
