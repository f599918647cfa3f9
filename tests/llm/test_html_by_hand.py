"""Pages written by hand, which the generator of the training pages cannot make: each gives its whole article."""

import pytest

from playpulse.llm.html_extract import main_texts, trained

P = [
    "The old harbour wall was built in 1743, long before the railway came to the town.",
    "Fishermen mended their nets on it every morning; children fished for crabs from its steps.",
    "When the storm of last November broke a gap of forty metres into it, nobody was surprised.",
    "The council has now voted to rebuild the wall as it was. Work begins in spring.",
]
PS = "".join(f"<p>{p}</p>" for p in P)
NAV = '<nav class="main-nav"><ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/about">About us</a></li></ul></nav>'
FOOT = '<footer class="site-footer"><p>&copy; 2024 The Harbour Gazette. All rights reserved.</p></footer>'
SIDE = '<aside class="sidebar widget-area"><h3>Recent posts</h3><ul><li><a href="/1">A day at sea</a></li><li><a href="/2">The new ferry</a></li></ul></aside>'
COMMENTS = '<section id="comments" class="comments-area"><h2>2 comments</h2><ol><li class="comment"><p>I remember that storm very well, we lost our boat in it.</p></li><li class="comment"><p>About time that they rebuilt it, thank you for the report.</p></li></ol></section>'


def page(body, attrs="", head=""):
    return f"<!DOCTYPE html><html lang=en><head><title>Harbour wall</title>{head}</head><body{attrs}>{body}</body></html>"


H = "Harbour wall to be rebuilt"
ALL = [H, *P]
LIST = ["Take the wall down stone by stone and number the stones.", "Lay new foundations, two metres deeper than the old ones.", "Put the stones back in the order of their numbers."]
PAGES = {
    "theme with a sidebar": (page(f'{NAV}<div id="primary" class="content-area"><main><article class="post"><h1>{H}</h1>{PS}</article></main></div>{SIDE}{FOOT}', ' class="home has-sidebar right-sidebar single-post"'), ALL),
    "theme without ads": (page(f"{NAV}<main><h1>{H}</h1>{PS}</main>{FOOT}", ' class="single-post no-ads"'), ALL),
    "theme with comments": (page(f"<main><article><h1>{H}</h1>{PS}</article></main>{COMMENTS}", ' class="has-sidebar has-comments"'), ALL),
    "no names at all": (page(f"<main><article>{PS}</article></main>"), P),
    "message body": (page(f'{NAV}<article><h1>{H}</h1><div class="message body">{PS}</div></article>{FOOT}'), ALL),
    "one whole linked paragraph": (page(f'{NAV}<main><h1>{H}</h1><p>{P[0]}</p><p><a href="/x">{P[1]}</a></p><p>{P[2]}</p><p>{P[3]}</p></main>{FOOT}'), ALL),
    "two whole linked paragraphs": (page(f'{NAV}<main><h1>{H}</h1><p>{P[0]}</p><p><a href="/x">{P[1]}</a></p><p><a href="/y">{P[2]}</a></p></main>'), ALL[:4]),
    "one bare div": (f"<div>{' '.join(P)}</div>", [" ".join(P)]),
    "one bare sentence": (P[0], [P[0]]),
    "bare text in the body": (page(P[0] + "<br><br>" + P[1]), [P[0] + " " + P[1]]),
    "paragraphs in the body": (page(PS), P),
    "wrapper named after its sidebar": (page(f'{NAV}<div class="layout with-sidebar"><div class="col-8"><h1>{H}</h1>{PS}</div><div class="col-4">{SIDE}</div></div>{FOOT}'), ALL),
    "social layout": (page(f'{NAV}<div class="social-layout"><div class="header-spaced"><article><h1>{H}</h1>{PS}</article></div></div>{FOOT}'), ALL),
    "text between menu and footer": (page(f'<div class="menu"><a href="/">Home</a> | <a href="/b">News</a> | <a href="/c">Contact</a></div><h1>{H}</h1>{PS}<div class="footer">&copy; Harbour Gazette</div>'), ALL),
    "old tables": (page(f'<table><tr><td colspan=2><a href="/">Home</a> <a href="/n">News</a></td></tr><tr><td width=150><a href="/1">Boats</a><br><a href="/2">Tides</a></td><td><h1>{H}</h1>{PS}</td></tr><tr><td colspan=2>&copy; 1999 Harbour Gazette</td></tr></table>'), ALL),
    "article with a list": (page(f"{NAV}<main><article><h1>{H}</h1><p>{P[0]}</p><ol>{''.join(f'<li>{x}</li>' for x in LIST)}</ol><p>{P[3]}</p></article></main>{SIDE}{FOOT}"), [H, P[0], *LIST, P[3]]),
    "comments go": (page(f"{NAV}<article><h1>{H}</h1>{PS}{COMMENTS}</article>{FOOT}"), ALL),
    "comments after a short text": (page(f'{NAV}<article class="entry"><h1>{H}</h1><p>{P[0]}</p></article>{COMMENTS}{FOOT}'), ALL[:2]),
    "cookie notice and newsletter go": (page(f'<div class="cookie-consent" role="alert"><p>We use cookies to make this site work. Read our policy for more.</p><button>Accept</button></div>{NAV}<main><h1>{H}</h1>{PS}</main><form class="newsletter"><p>Get our weekly letter with all the news of the harbour.</p><input><button>Sign up</button></form>{FOOT}'), ALL),
    "an advert amid the text goes": (page(f'{NAV}<article><h1>{H}</h1><p>{P[0]}</p><p>{P[1]}</p><div class="ad-slot"><p>Buy one boat and get the second for half the price.</p></div><p>{P[2]}</p><p>{P[3]}</p></article>{FOOT}'), ALL),
    "linked teasers beside go": (page(f'{NAV}<main><h1>{H}</h1>{PS}</main><aside class="related"><h3>More</h3><p><a href="/1">The ferry will run on Sundays again from the first of May.</a></p><p><a href="/2">Herring are back in the bay, say the fishermen.</a></p></aside>{FOOT}'), ALL),
    "definition list": (page(f"{NAV}<main><h1>{H}</h1><p>{P[0]}</p><dl><dt>Length</dt><dd>Four hundred and twelve metres from the mole to the light.</dd></dl></main>{FOOT}"), [H, P[0], "Length", "Four hundred and twelve metres from the mole to the light."]),
    "quotation": (page(f"{NAV}<article><h1>{H}</h1><p>{P[0]}</p><blockquote><p>{P[1]}</p></blockquote><p>{P[2]}</p></article>{FOOT}"), [H, P[0], P[1], P[2]]),
    "sections with headlines": (page(f"{NAV}<main><h1>{H}</h1><section><h2>The wall</h2><p>{P[0]}</p><p>{P[1]}</p></section><section><h2>The storm</h2><p>{P[2]}</p></section></main>{SIDE}{FOOT}"), [H, "The wall", P[0], P[1], "The storm", P[2]]),
    "a modal page": (page(f'<div class="modal-page overlay"><div class="top"><h1>{H}</h1>{PS}</div></div>', ' class="modal-open"'), ALL),
    "ids that mislead": (page(f'{NAV}<div id="side-by-side"><div id="main-form"><h1>{H}</h1>{PS}</div></div>{FOOT}'), ALL),
    "unclosed paragraphs": (page(f"{NAV}<main><h1>{H}</h1>{''.join('<p>' + p for p in P)}</main>{FOOT}"), ALL),
    "a header in the article": (page(f"<header><a href=/>Gazette</a></header>{NAV}<article><header><h1>{H}</h1></header>{PS}<footer><a href=/t>Tags</a></footer></article>{FOOT}"), ALL),
    "long prose in divs": (page(f'{NAV}<div class="c"><div>{P[0]}</div><div>{P[1]}</div><div>{P[2]}</div><div>{P[3]}</div></div>{FOOT}'), P),
}


@pytest.mark.parametrize("name", PAGES)
def test_the_whole_article_comes_back(name):
    html, want = PAGES[name]
    assert main_texts([html], trained())[0].split("\n\n") == want


def test_deep_and_wide_pages_take_linear_time():
    import time

    began = time.time()
    for html in ("<div>x" * 20_000, "<div class='side ad'>" * 20_000 + "x", "<p class=menu>x</p>" * 20_000):
        main_texts([html], trained())
    assert time.time() - began < 60
