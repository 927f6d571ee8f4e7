"""Page layouts that neither the tables nor the labeller's own training layouts hold, as (kind, HTML) parts.

``T`` is a paragraph of the main text, ``H`` its heading; all else is around it.  Class names are those of
common publishing systems, generated ones, or none."""

import numpy as np


def _links(words, n):
    return [f'<a href="/{w}">{w}</a>' for w in words[:n]]


def wordpress(h, ts, w):
    menu = "".join(f"<li id=menu-item-{i} class=menu-item>{a}</li>" for i, a in enumerate(_links(w, 5)))
    text = "".join(f"<p>{t}</p>" for t in ts)
    return (
        f'<div id="page" class="hfeed site"><header id="masthead" class="site-header"><p class="site-title">{w[0]} {w[1]}</p><nav id="site-navigation">'
        f'<ul>{menu}</ul></nav></header><div id="primary" class="content-area"><main id="main"><article class="post-812 hentry"><h1 class="entry-title">{h}</h1>'
        f'<div class="entry-content">{text}</div></article><div id="comments" class="comments-area"><ol class="comment-list"><li><p>{w[2]} {w[3]} {w[4]}, {w[5]}.</p>'
        f'</ol></div></main></div><footer id="colophon" class="site-footer">Powered by {w[6]}</footer></div>'
    )


def blogger(h, ts, w):
    text = "<br><br>".join(ts)
    return (
        f'<div class="navbar section">{" ".join(_links(w, 4))}</div><div class="main-outer"><div class="post hentry uncustomized-post-template"><h3 class="post-title">{h}</h3>'
        f'<div class="post-body entry-content">{text}</div></div></div><div class="sidebar section"><div class="widget BlogArchive"><ul><li>{w[3]}</li><li>{w[4]} 2019</li></ul></div></div>'
    )


def wiki(h, ts, w):
    text = "".join(f"<p>{t}</p>" for t in ts)
    return (
        f'<div id="mw-page-base"></div><div id="content" class="mw-body" role="main"><h1 id="firstHeading" class="firstHeading">{h}</h1><div id="mw-content-text" class="mw-body-content">'
        f'<div class="mw-parser-output">{text}</div></div></div><div id="mw-navigation"><div id="mw-panel"><div class="portal" role="navigation"><ul>'
        + "".join(f"<li>{a}</li>" for a in _links(w, 7))
        + f'</ul></div></div></div><div id="footer" role="contentinfo"><ul><li>{w[1]} was last edited on 3 May</li></ul></div>'
    )


def newspaper(h, ts, w):
    text = "".join(f'<p class="story-body-text">{t}</p>' for t in ts)
    return (
        f'<div class="masthead-strip">{" | ".join(_links(w, 6))}</div><div class="cookie-bar"><p>We use cookies, {w[0]}.</p></div><section class="story-body"><h1>{h}</h1>{text}'
        f'</section><aside class="trending"><h4>Most read</h4><ol>{"".join(f"<li>{a}</li>" for a in _links(w[6:], 5))}</ol></aside><div class="legal">&copy; {w[2]} 2021</div>'
    )


def docs_site(h, ts, w):
    text = "".join(f"<p>{t}</p>" for t in ts)
    return (
        f'<div class="wy-grid-for-nav"><nav class="wy-nav-side"><ul class="toctree">{"".join(f"<li>{a}</li>" for a in _links(w, 8))}</ul></nav>'
        f'<section class="wy-nav-content-wrap"><div class="rst-content"><div role="main" class="document"><h1>{h}</h1>{text}</div><footer><p>Built with {w[1]}.</p></footer></div></section></div>'
    )


def no_names(h, ts, w):
    text = "".join(f"<p>{t}</p>" for t in ts)
    return f'<ul>{"".join(f"<li>{a}</li>" for a in _links(w, 6))}</ul><h1>{h}</h1>{text}<hr><small>&copy; {w[0]} {w[1]}</small>'


def hashed_names(h, ts, w):
    text = "".join(f'<p class="sc-1kq{i}">{t}</p>' for i, t in enumerate(ts))
    return (
        f'<div class="css-9zxq"><div class="css-18n"><ul>{"".join(f"<li class=css-q1>{a}</li>" for a in _links(w, 5))}</ul></div></div><div class="css-7uv"><h1 class="css-0b">{h}</h1>'
        f'{text}</div><div class="css-f00"><ul>{"".join(f"<li>{a}</li>" for a in _links(w[5:], 6))}</ul></div>'
    )


def tables(h, ts, w):
    text = "<p>".join(ts)
    return (
        f'<table width=100%><tr><td colspan=2 bgcolor=navy><font color=white>{" - ".join(_links(w, 5))}</font><tr><td width=150>{"<br>".join(_links(w[5:], 6))}'
        f"<td><h2>{h}</h2><p>{text}</table><center><font size=1>{w[0]} {w[1]}</font></center>"
    )


def amp(h, ts, w):
    text = "".join(f"<p>{t}</p>" for t in ts)
    return (
        f'<amp-sidebar id="sidebar1"><ul>{"".join(f"<li>{a}</li>" for a in _links(w, 6))}</ul></amp-sidebar><header class="headerbar">{w[0]}</header><article><h1>{h}</h1>'
        f'<amp-ad width=300></amp-ad>{text}</article><amp-consent><div>{w[1]} uses cookies. {" ".join(_links(["Accept", "Reject"], 2))}</div></amp-consent>'
    )


def shop_blog(h, ts, w):
    text = "".join(f"<p>{t}</p>" for t in ts)
    return (
        f'<div class="announcement-bar">Free shipping on {w[0]}</div><div class="site-nav"><ul>{"".join(f"<li>{a}</li>" for a in _links(w, 5))}</ul></div><main><div class="article-template">'
        f'<h1>{h}</h1><div class="rte">{text}</div></div></main><div class="newsletter-section"><form><p>Subscribe to our emails</p><input><button>Go</button></form></div>'
        f'<footer><ul>{"".join(f"<li>{a}</li>" for a in _links(w[5:], 6))}</ul></footer>'
    )


def forum(h, ts, w):
    text = "".join(f"<div>{t}</div>" for t in ts)
    return (
        f'<div id="header-menu">{" ".join(_links(w, 6))}</div><div class="thread-head"><h2>{h}</h2></div><div class="first-message"><div class="message-content">{text}</div></div>'
        f'<div class="comments"><div class="comment"><p>{w[1]} {w[2]} {w[3]} {w[4]}.</p></div><div class="comment"><p>{w[5]} {w[6]}!</p></div></div><div class="footer">{w[0]} software</div>'
    )


def magazine(h, ts, w):
    half = len(ts) // 2
    return (
        f'<div class="topnav"><ul>{"".join(f"<li>{a}</li>" for a in _links(w, 7))}</ul></div><div class="feature"><h1>{h}</h1>{"".join(f"<p>{t}</p>" for t in ts[:half])}'
        f'<div class="ad-slot advert">Advertisement: {w[8]} {w[9]}</div>{"".join(f"<p>{t}</p>" for t in ts[half:])}</div><div class="more-stories related"><h5>More</h5>'
        f'{"".join(f"<div>{a}</div>" for a in _links(w[3:], 4))}</div><div class="copyright">&copy; {w[0]}</div>'
    )


LAYOUTS = [wordpress, blogger, wiki, newspaper, docs_site, no_names, hashed_names, tables, amp, shop_blog, forum, magazine]


def page(layout, heading, texts, words):
    return f"<!DOCTYPE html><html><head><title>{heading}</title><style>p{{margin:0}}</style></head><body>{layout(heading, texts, words)}</body></html>"


def pages(texts, n, seed):
    """(layout, html, main text) of ``n`` pages a layout from these paragraphs."""
    rng = np.random.default_rng(seed)
    out = []
    for layout in LAYOUTS:
        for _ in range(n):
            some = [texts[int(k)] for k in rng.choice(len(texts), int(rng.integers(3, 9)), replace=False)]
            words = [texts[int(k)].split()[0].strip(".,") for k in rng.choice(len(texts), 16)]
            heading = " ".join(some[0].split()[:6])
            joined = [" ".join(some)] if layout is blogger else some
            out.append((layout.__name__, page(layout, heading, some, words), "\n".join([heading, *joined])))
    return out
