"""Labelled pages to train the extraction on: made by rule from a seed, in the shapes that sites commonly have.

A page is a list of (html, is main text). Words are invented, so that nothing is learnt from vocabulary.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

PAGES, SEED = 300, 3
Part = tuple[str, bool]


class Maker:
    def __init__(self, r: random.Random):
        self.r = r

    def words(self, a: int, b: int) -> str:
        r = self.r
        return " ".join("".join(r.choice(("ka", "lo", "mi", "re", "su", "ta", "né", "vo", "ü", "st")) for _ in range(r.randint(1, 4))) for _ in range(r.randint(a, b)))

    def sentence(self, a: int = 4, b: int = 18) -> str:
        return self.words(a, b).capitalize() + self.r.choice(("." * 6) + "?!")

    def prose(self, most: int = 6) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(1, most)))

    def link(self) -> str:
        return f'<a href="/{self.words(1, 1)}">{self.words(1, 3).capitalize()}</a>'

    def named(self, *names: str) -> str:
        """Attributes that name the part, or none."""
        kind, name = self.r.choice(("class", "class", "id")), self.r.choice(names)
        return f' {kind}="{self.r.choice((name, name, f"{name} {self.words(1, 1)}", f"site-{name}", f"{name}-box"))}"'

    def nav(self) -> str:
        links = [self.link() for _ in range(self.r.randint(3, 9))]
        body = "<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>" if self.r.random() < 0.7 else self.r.choice((" | ", " ", " · ")).join(links)
        return self.r.choice((f"<nav>{body}</nav>", f"<nav{self.named('menu', 'nav')}>{body}</nav>", f"<div{self.named('nav', 'menu', 'navbar', 'breadcrumb')}>{body}</div>", f'<div role="navigation">{body}</div>'))

    def header(self) -> str:
        inner = self.r.choice((f"<h1>{self.words(1, 3).capitalize()}</h1>", f"<p>{self.sentence(2, 8)}</p>", f"<a href='/'>{self.words(1, 2)}</a><span>{self.words(2, 6)}</span>", f"<div>{self.words(1, 4)}</div>"))
        return self.r.choice((f"<header>{inner}</header>", f"<div{self.named('header', 'masthead', 'topbar')}>{inner}</div>", f'<header role="banner">{inner}{self.nav()}</header>'))

    def footer(self) -> str:
        inner = self.r.choice((f"&copy; {self.words(1, 3)} &middot; {self.sentence()}", f"<p>&copy; 20{self.r.randint(10, 26)} {self.words(1, 4)}. {self.sentence()}</p>", f"<p>{self.prose(3)}</p>", f"{self.nav()}<p>{self.words(2, 6)}</p>"))
        return self.r.choice((f"<footer>{inner}</footer>", f"<footer>{inner}</footer>", f"<div{self.named('footer', 'copyright', 'legal')}>{inner}</div>"))

    def paras(self, most: int = 3) -> str:
        return "".join(f"<p>{self.prose(4)}</p>" for _ in range(self.r.randint(1, most)))

    def advert(self) -> str:
        inner = self.r.choice((self.prose(2), self.paras(1), f"<a href='x'>{self.sentence()}</a>", f"<p>{self.sentence()}</p><p>{self.link()}</p>"))
        return f"<{(t := self.r.choice(('div', 'div', 'section', 'aside', 'p')))}{self.named('ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo', 'banner')}>{inner if t != 'p' else self.prose(2)}</{t}>"

    def notice(self) -> str:
        inner = self.r.choice((self.prose(2), self.paras(1), f"<p>{self.sentence()}</p><button>{self.words(1, 2)}</button>"))
        return self.r.choice((f"<div{self.named('cookie', 'notice', 'consent', 'newsletter', 'alert', 'popup', 'cookie-notice', 'cookie-banner', 'subscribe')}>{inner}</div>", f'<div role="alert">{inner}</div>', f'<div role="dialog">{inner}</div>', f"<dialog>{inner}</dialog>"))

    def sidebar(self) -> str:
        inner = self.r.choice((self.paras(2), f"<h3>{self.words(1, 3)}</h3><ul>{''.join(f'<li>{self.link()}</li>' for _ in range(5))}</ul>", f"<h2>{self.words(1, 3)}</h2>{self.paras(2)}", self.prose(3)))
        return self.r.choice((f"<aside>{inner}</aside>", f"<aside{self.named('sidebar', 'related')}>{inner}</aside>", f"<div{self.named('sidebar', 'related', 'widget', 'popular')}>{inner}</div>", f'<div role="complementary">{inner}</div>'))

    def form(self) -> str:
        inner = self.r.choice((f"<label>{self.words(1, 3)}</label><input name=q><button>{self.words(1, 2)}</button>", f"<p>{self.sentence()}</p><input type=email><button>{self.words(1, 2)}</button>", f"<select><option>{self.words(1, 2)}<option>{self.words(1, 2)}</select><textarea>{self.words(1, 5)}</textarea>", f"{self.sentence()}<input>"))
        return self.r.choice((f"<form>{inner}</form>", f"<form action='/x'{self.named('search', 'login', 'signup')}>{inner}</form>", f"<div{self.named('search', 'login')}><form>{inner}</form></div>"))

    def comments(self) -> str:
        one = lambda: self.r.choice((f"<li><b>{self.words(1, 2)}</b><p>{self.prose(3)}</p></li>", f"<div class=comment><p>{self.prose(3)}</p></div>", f"<p>{self.prose(3)}</p>", f"<article class='comment'><p>{self.prose(3)}</p></article>"))
        inner = "".join(one() for _ in range(self.r.randint(1, 5)))
        head = self.r.choice(("", f"<h2>{self.words(1, 3)}</h2>", f"<h3>{self.r.randint(1, 30)} {self.words(1, 1)}</h3>"))
        return self.r.choice((f"<section{self.named('comments', 'comment-list', 'discussion', 'responses')}>{head}{inner}</section>", f"<div{self.named('comments', 'commentlist', 'replies')}>{head}{inner}</div>", f"<ol{self.named('comments', 'commentlist')}>{inner}</ol>"))

    def share(self) -> str:
        return f"<div{self.named('share', 'social', 'tools')}>{' '.join(self.link() for _ in range(3))}</div>"

    def block(self) -> str:
        r = self.r
        return r.choice((
            *[f"<p>{self.prose()}</p>"] * 8, f"<p>{self.words(2, 6)} {self.link()} {self.sentence()}</p>", f"<p><b>{self.sentence()}<br></p>", f"<p><b>{self.prose()}</b><br>", f"<h2>{self.words(2, 6).capitalize()}</h2>", f"<h3>{self.words(1, 4).capitalize()}</h3>",
            f"<ul>{''.join(f'<li>{self.sentence()}' for _ in range(r.randint(2, 5)))}</ul>", f"<ol><li>{self.sentence()}</li><li>{self.words(2, 5)}</li></ol>", f"<blockquote><p>{self.prose(3)}</p></blockquote>", f"<blockquote>{self.prose(2)}</blockquote>",
            f"<pre>{self.words(3, 12)}</pre>", f"<table><tr><th>{self.words(1, 2)}<th>{self.words(1, 2)}<tr><td>{self.words(1, 3)}<td>{r.randint(1, 999)}</table>", f"<figure><img src=x><figcaption>{self.sentence()}</figcaption></figure>", f"<p>{self.words(1, 3)}</p>", f"<div>{self.prose()}</div>", f"<section><p>{self.prose()}</p></section>",
        ))

    def page(self) -> list[Part]:
        r = self.r
        out: list[Part] = [(f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title><style>p{{margin:0}}</style></head><body>", False)]
        maybe = lambda p, *makers: [out.append((r.choice(makers)(), False)) for _ in range(r.random() < p)]
        maybe(0.45, self.header)
        maybe(0.75, self.nav)
        maybe(0.3, self.notice)
        maybe(0.4, self.advert)
        maybe(0.25, self.form)
        maybe(0.25, self.sidebar)
        opened, closed = r.choice((*[("<article>", "</article>")] * 5, ("<main>", "</main>"), ("<main><article>", "</article></main>"), ('<div class="content">', "</div>"), ('<div id="main">', "</div>"), ('<div class="post"><div class="entry">', "</div></div>"), ('<div role="main">', "</div>"), ("<div>", "</div>"), ('<section class="article-body">', "</section>"), ("", "")))
        out.append((opened, True))
        if r.random() < 0.8:
            out.append((f"<h1>{self.words(2, 9).capitalize()}</h1>", True))
        for _ in range(max(1, int(r.expovariate(1 / 7)))):
            out.append((self.block(), True))
            if r.random() < 0.12:
                out.append((r.choice((self.advert, self.sidebar, self.notice, self.share, self.form, self.nav))(), False))
        maybe(0.15, self.comments)
        out.append((closed, True))
        maybe(0.25, self.share)
        maybe(0.3, self.comments)
        maybe(0.3, self.sidebar)
        maybe(0.2, self.advert)
        maybe(0.2, self.form)
        maybe(0.2, self.notice)
        maybe(0.85, self.footer)
        out.append(("</body></html>", False))
        return out


def labelled_pages(pages: int = PAGES, seed: int = SEED) -> Iterator[list[Part]]:
    for i in range(pages):
        yield Maker(random.Random(seed * 100_003 + i)).page()
