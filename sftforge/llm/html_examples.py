"""Labelled pages from which the extraction model learns what parts of a page look like.

The table's pages carry no labels, so a seeded generator lays out pages of many
kinds and marks what is content: ``data-y="1"`` on an element marks all below it
as content (on ``body``: the whole page), ``data-y="0"`` as something else, the
nearest mark counting.  Words
are made up, so that the model learns markup and shape instead of a language.
"""

from __future__ import annotations

import random

#: Class and id names that pages give to parts that aren't content.
NAMES = {
    "menu": "nav navbar navigation menu main-menu topnav breadcrumb breadcrumbs site-nav submenu pager pagination tabs toolbar skip-link languages".split(),
    "header": "header site-header masthead banner topbar branding logo page-header-bar site-title hero-strip".split(),
    "footer": "footer site-footer colophon copyright legal bottom imprint footer-links page-foot".split(),
    "sidebar": "sidebar aside widget widgets right-col rail related recommended popular trending most-read tag-cloud tags also-like author-box "
               "secondary archive categories".split(),
    "notice": "cookie cookie-banner cookies consent gdpr notice alert popup modal overlay paywall disclaimer privacy-notice message toast notification".split(),
    "advert": "ad ads advert advertisement adsense adslot sponsor sponsored promo banner-ad promotion commercial outbrain teaser-ad ad-unit".split(),
    "form": "search search-form newsletter signup sign-up login subscribe contact-form subscription register".split(),
    "comments": "comments comment comment-list commentlist respond reply replies disqus_thread discussion reader-comments user-comments responses "
                "feedback comment-body guestbook".split(),
    "share": "share social share-buttons follow-us sharing social-links print-tools".split(),
}
#: Names of parts that hold the content.
CONTENT = ("article content main-content entry-content post post-content article-body story story-body body-text page-content main blog-post entry "
           "hentry articleBody article-text main-text text-block").split()
TAGS = {"menu": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "sidebar": ["aside", "div", "section"],
        "notice": ["div", "section", "dialog", "p"], "advert": ["div", "aside", "section", "p"], "form": ["form", "div"],
        "comments": ["section", "div", "ol", "article"], "share": ["div", "ul"]}
_PARTS = "an be con da el fi ga hu in jo ka lo mi nu or pe qua ri sa te un vo wa xi ya ze ção é ü ñ 文 章 да но".split()


def words(rng: random.Random, n: int) -> str:
    out = []
    for _ in range(n):
        w = "".join(rng.choices(_PARTS, k=rng.randint(1, 4)))
        out.append(w + rng.choices(["", ",", ".", "!", "&amp;"], [80, 8, 9, 1, 2])[0])
    return " ".join(out)


def sentence(rng: random.Random, n: int) -> str:
    s = words(rng, n)
    if rng.random() < 0.04:
        s = s.replace(" ", rng.choice([" | ", " &middot; "]))
    return s[:1].upper() + s[1:] + rng.choices([".", "?", "", " "], [85, 5, 8, 2])[0]


def links(rng: random.Random, n: int) -> str:
    item = [f'<a href="/{i}">{words(rng, rng.randint(1, 4))}</a>' for i in range(n)]
    return "<ul>" + "".join(f"<li>{x}</li>" for x in item) + "</ul>" if rng.random() < 0.7 else rng.choice([" ", " | ", " &middot; "]).join(item)


def named(rng: random.Random, tag: str, names: list[str], inner: str, mark: int, bare: float) -> str:
    name = rng.choice(names)
    if rng.random() < 0.2:
        name = rng.choice(["c-{}", "js-{}", "{}-wrap", "{}__inner", "site {}", "block {} block-1"]).format(name)
    attribute = "" if rng.random() < bare else f' {rng.choice(["class", "class", "id"])}="{name}"'
    return f'<{tag}{attribute} data-y="{mark}">{inner}</{tag}>'


def boilerplate(rng: random.Random, kind: str) -> str:
    n = rng.randint
    say = lambda low, high: sentence(rng, n(low, high))
    def heading() -> str:
        level = n(2, 4)
        return f"<h{level}>{words(rng, n(1, 4))}</h{level}>"

    inner = {
        "menu": lambda: links(rng, n(2, 9)),
        "header": lambda: rng.choice(["", f"<h1>{words(rng, n(1, 4))}</h1>", f'<a href="/">{words(rng, 2)}</a>']) + f"<p>{say(2, 9)}</p>",
        "footer": lambda: rng.choice(["&copy; 2024 ", "&copy; ", "<p>", ""]) + say(2, 14) + rng.choice(["", links(rng, 3)]),
        "sidebar": lambda: heading() + rng.choice([links(rng, n(2, 7)), f"<p>{say(5, 40)}</p>"]),
        "notice": lambda: rng.choice([say(5, 30), f"<p>{say(5, 40)}</p>", f"<p>{say(4, 20)}</p><button>{words(rng, 1)}</button>"]),
        "advert": lambda: rng.choice([say(2, 25), f"<p>{say(3, 30)}</p>", f'<a href="http://x">{say(2, 12)}</a>']),
        "form": lambda: f"<label>{words(rng, n(1, 4))}</label><input name=q><p>{say(2, 15)}</p><button>{words(rng, 1)}</button>",
        "comments": lambda: (heading() if rng.random() < 0.6 else "") + "".join(
            rng.choice(['<div class="comment"><p>{}</p></div>', '<li class="comment">{}</li>', "<p>{}</p>", '<article class="comment"><p>{}</p></article>',
                        "<div><b>x</b><p>{}</p></div>"]).format(say(2, 60)) for _ in range(n(1, 5))),
        "share": lambda: links(rng, n(2, 5)),
    }[kind]()
    tag = rng.choice(TAGS[kind])
    if tag == "p":
        inner = say(3, 25)
    semantic = tag in ("nav", "header", "footer", "aside", "form", "dialog")
    return named(rng, tag, NAMES[kind], inner, 0, 0.5 if semantic else 0.0)


def content(rng: random.Random) -> str:
    n = rng.randint
    say = lambda low, high: sentence(rng, n(low, high))
    out = [rng.choice(["<h1>{}</h1>", "<h1>{}</h1>", "<header><h1>{}</h1></header>", "<h2>{}</h2>", ""]).format(words(rng, n(2, 10)))]
    for _ in range(rng.choice([1, 2, 3, 5, 8, 14])):
        kind = rng.random()
        size = rng.choice([1, 2, 5, 12, 30, 60, 120])
        if kind < 0.72:
            text = sentence(rng, size)
            if rng.random() < 0.15:
                text += f' <a href="/x">{words(rng, n(1, 5))}</a> ' + say(2, 20)
            out.append(rng.choice(["<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<div>{}</div>", "<p>{}</p>"]).format(text))
        elif kind < 0.78:
            out.append(f"<h{n(2, 4)}>{words(rng, n(1, 6))}</h2>")
        elif kind < 0.86:
            out.append("<ul>" + "".join(f"<li>{say(1, 15)}</li>" for _ in range(n(2, 5))) + "</ul>")
        elif kind < 0.90:
            out.append(f"<blockquote><p>{say(4, 40)}</p></blockquote>")
        elif kind < 0.94:
            out.append("<table>" + "".join(f"<tr><td>{words(rng, n(1, 3))}</td><td>{n(1, 99)}</td></tr>" for _ in range(n(2, 4))) + "</table>")
        elif kind < 0.97:
            out.append(f"<figure><img src=x><figcaption>{say(2, 12)}</figcaption></figure>")
        else:
            out.append(f"<pre>{words(rng, n(2, 20))}</pre>")
        if rng.random() < 0.06:
            out.append(boilerplate(rng, rng.choice(["advert", "share", "sidebar", "form"])))
    return "".join(out)


def page(rng: random.Random) -> str:
    """One page; a tenth are cut off at a random place."""
    body = content(rng)
    kinds = lambda names, p: "".join(boilerplate(rng, k) for k in names if rng.random() < p)
    if rng.random() < 0.3:
        body += boilerplate(rng, "comments")  # reader comments inside the article
    wrap, head = rng.random(), "<body>"
    if wrap < 0.18:
        head = '<body data-y="1">'  # content side by side with the rest
        if rng.random() < 0.35:  # no markup, or hardly any
            body = sentence(rng, rng.choice([3, 6, 12, 40, 150])) + rng.choice(["", "", "<br>", "<br><br>"]) + rng.choice(["", sentence(rng, 9)])
    elif wrap < 0.45:
        body = named(rng, "article", CONTENT, body, 1, 0.7)
    elif wrap < 0.6:
        body = named(rng, "main", CONTENT, body, 1, 0.7)
    elif wrap < 0.85:
        body = named(rng, rng.choice(["div", "section", "td"]), CONTENT, body, 1, 0.1)
    else:
        body = f'<div data-y="1">{body}</div>'
    if wrap >= 0.18:
        for _ in range(rng.choice([0, 0, 1, 2])):
            body = f"<div>{body}</div>"
    often = rng.choice([0.0, 0.2, 1.0]) if wrap < 0.18 else 1.0
    before, after = kinds(["notice", "header", "menu", "advert", "form"], 0.5 * often), kinds(["comments", "sidebar", "share", "advert", "footer", "notice"], 0.45 * often)
    if rng.random() < 0.05:
        html = f"<form>{before}{body}{after}</form>"
    elif rng.random() < 0.3:
        html = f'<div class="{rng.choice(["wrapper", "container", "page", "site", "row", "outer"])}">{before}{body}{after}</div>'
    else:
        html = before + body + after
    html = f"<!DOCTYPE html><html><head><title>{words(rng, 4)}</title><style>p{{}}</style></head>{head}{html}</body></html>"
    return html[:rng.randint(len(html) // 2, len(html))] if rng.random() < 0.1 else html


def pages(count: int, seed: int = 1) -> list[str]:
    rng = random.Random(seed)
    return [page(rng) for _ in range(count)]
