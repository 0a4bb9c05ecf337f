"""Labelled pages for the extraction of main text: every main block begins with a mark.

Pages are put together from parts as sites have them: places for the article, and menus, headers, footers, sidebars,
notices, adverts, forms, related links and readers' comments around and inside it, with and without telling names.
"""

from __future__ import annotations

from itertools import count

_LONG = ("Nobody had expected the river to rise that quickly, and by noon the lower streets were under water, while "
         "the council was still waiting for news from the villages upstream and the schools stayed open.")
_MIDDLE = "The bridge was closed in the evening, and traffic went by the old road."
_SHORT = "It was late."
_WORDS = "Thirty years on"

_ARTICLE = ("<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>', '<div id="post-body"><div>{}</div></div>',
            '<section class="story"><div class="text">{}</div></section>', "<main><article>{}</article></main>", "<div>{}</div>",
            '<div class="entry-content">{}</div>')
_BODIES = (
    f"<h1>§{_WORDS}</h1><p>§{_LONG}</p><p>§{_MIDDLE}</p><p>§{_SHORT}</p><p>§{_LONG}</p>",
    f"<h1>§{_WORDS}</h1><p><b>§{_MIDDLE}<br><p>§{_LONG}<p>§{_SHORT}<p>§{_LONG}",
    f"<h1>§{_WORDS} {_MIDDLE}</h1><p>§{_LONG}</p><h2>§{_WORDS}</h2><p>§{_LONG}</p><ul><li>§{_SHORT}</li><li>§{_WORDS}</li></ul><p>§{_MIDDLE}</p>",
    f"<h2>§{_WORDS}</h2><blockquote><p>§{_MIDDLE}</p></blockquote><p>§{_LONG} <a href='x'>{_WORDS}</a></p><pre>§{_SHORT}</pre><p>§{_SHORT}</p>",
    f"<p>§{_SHORT}</p><p>§{_WORDS}</p><p>§{_SHORT}</p>",
    f"<h1>§Late.</h1><p>§Late.</p><p>§By noon, at last.</p><p>§By noon, at last.</p><p>§rain rain rain rain | rain</p><p>§{_LONG}</p><p>§Late.</p>",
    f"<h1>§{_WORDS}</h1><p>§RAIN!! RAIN!! AND WIND!!</p><p>§Rain</p><p>§{_MIDDLE}</p><p>§© 1999, from the letters.</p><p>§Rain|wind|snow|</p>",
    f"<h1>§{_WORDS}</h1><table><tr><td>§{_WORDS}</td><td>§12</td></tr><tr><td>§{_SHORT}</td><td>§7</td></tr></table><p>§{_LONG}</p><ol><li>§{_MIDDLE}</li></ol>",
    f"<h1>§{_WORDS}</h1><figure><img src='x'><figcaption>§{_MIDDLE}</figcaption></figure><p>§{_LONG}</p><p>§{_LONG}</p>",
)
_MENUS = (
    "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>World</a></li><li><a href='/c'>Sport</a></li></ul></nav>",
    "<div class='menu'><a href='/a'>Home</a> <a href='/b'>About us</a></div>",
    "<ul id='main-nav'><li><a href='/a'>Start</a></li><li><a href='/b'>Archive of all years</a></li></ul>",
    "<header><h1><a href='/'>The Daily</a></h1><p>News, since 1910.</p><nav><a href='/a'>Home</a></nav></header>",
    "<div class='breadcrumb'><a href='/'>Home</a> | <a href='/n'>News</a></div>",
    "<header><p>Welcome, reader. You are not signed in.</p></header>",
    "<div id='header'><div class='logo'>The Daily</div><p>News, views and weather for the valley.</p></div>",
)
_ADS = (
    f"<div class='ad'>{_MIDDLE}</div>", f"<div class='advert'><p>{_LONG}</p></div>", f"<div class='sponsored-box'><p>{_WORDS}</p></div>",
    f"<aside class='promo'><h3>Save now</h3><p>{_MIDDLE}</p></aside>", f"<div class='ad'>{_SHORT}</div>", f"<div id='ads'><p>{_LONG}</p></div>",
)
_NOTICES = (
    "<div class='cookie-notice'><p>We use cookies, as all do. By reading on you agree to them.</p><button>Accept</button></div>",
    "<div id='newsletter'><h3>Stay informed</h3><p>Get our letter, every Monday.</p><form><label>Mail</label><input><button>Send</button></form></div>",
    "<form class='search'><label>Search the site</label><input><button>Go</button></form>",
    "<div role='alert' class='notice'>This site will be down on Sunday, from six to nine.</div>",
    f"<form><p>{_MIDDLE}</p><label>Your name</label><select><option>One</option></select><button>Send it</button></form>",
    f"<div class='consent'><p>{_LONG}</p></div>",
)
_SIDES = (
    f"<aside><h3>Most read</h3><ul><li><a href='/x'>{_MIDDLE}</a></li><li><a href='/y'>{_WORDS}</a></li></ul></aside>",
    f"<div class='sidebar'><h2>About</h2><p>{_LONG}</p></div>", f"<aside><p>{_LONG}</p></aside>",
    f"<div id='related'><h3>More on this</h3><p><a href='/z'>{_MIDDLE}</a></p></div>",
    f"<div class='widget'><h4>Weather</h4><p>{_SHORT}</p></div>", f"<div class='share'><a href='#'>Share</a> <a href='#'>Send</a></div>",
)
_COMMENTS = (
    f"<section class='comments'><h2>Comments</h2><div class='comment'><p>{_LONG}</p></div><div class='comment'><p>{_SHORT}</p></div></section>",
    f"<div id='comments'><h3>3 replies</h3><ul><li><p>{_MIDDLE}</p></li><li><p>{_LONG}</p></li></ul></div>",
    f"<div class='reader-comments'><p>{_MIDDLE}</p><form><textarea></textarea><button>Reply</button></form></div>",
    f"<ol class='comment-list'><li class='comment'>{_LONG}</li><li class='comment'>{_SHORT}</li></ol>",
)
_FOOTERS = (
    "<footer>&copy; example.org &middot; All rights reserved.</footer>", f"<footer><p>{_MIDDLE}</p><a href='/i'>Imprint</a></footer>",
    "<div class='footer'><p>© 2020 The Daily</p><ul><li><a href='/p'>Privacy</a></li></ul></div>",
    f"<footer>&copy; example.org &middot; {_MIDDLE}</footer>", "<div id='copyright'>All rights reserved, 1999.</div>",
)


def pages(number: int = 120) -> list[str]:
    """``number`` pages; each part goes its own round, so all parts meet."""
    out = []
    for i in range(number):
        step = count(i)
        pick = lambda parts, every=1: parts[next(step) % len(parts)] if i // 2 % every == 0 else ""
        body, place = _BODIES[i % len(_BODIES)], _ARTICLE[i // 3 % len(_ARTICLE)]
        inside = ("", _ADS[i % len(_ADS)], _SIDES[i % len(_SIDES)], _COMMENTS[i % len(_COMMENTS)], _NOTICES[i % len(_NOTICES)])[i % 5]
        half = body.find("<p", len(body) // 3)
        body = body[:half] + inside + body[half:] if i % 2 else body + inside
        around = [pick(_MENUS), pick(_MENUS, 3), pick(_NOTICES, 2), pick(_ADS), place.format(body), pick(_ADS, 3), pick(_SIDES, 2),
                  pick(_COMMENTS, 2), pick(_NOTICES, 4), pick(_FOOTERS)]
        inner = "".join(around)
        out.append("<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body>"
                   + (f"<div class='page'><div>{inner}</div></div>" if i % 4 == 0 else inner) + "</body></html>")
    return out
