"""HTML extraction on mark-up that the trainer's generator doesn't write, and on hostile pages.

Blocks of main text begin with a mark that no feature looks at.
"""

import time

import pytest

from sparktel.llm import html_extraction

MARK = "§ "
LONG = "The river rose in the night, and by the morning most of the lower fields were under water. Nobody in the village had seen it as high before."
PAGES = {
    "theme": f"""<html lang=en><head><meta charset="utf-8"><title>x</title></head><body class="post-template-default single single-post postid-12 logged-out">
<div id="page" class="hfeed site"><header id="masthead" class="site-header"><p class="site-title"><a href="/">The Valley Gazette</a></p><nav id="site-navigation" class="main-navigation"><div class="menu-primary-container"><ul id="menu-primary"><li class="menu-item"><a href="/a">Home</a></li><li class="menu-item"><a href="/b">Sport</a></li></ul></div></nav></header>
<div id="content" class="site-content"><div id="primary" class="content-area"><main id="main" class="site-main"><article id="post-12" class="post-12 post type-post hentry"><header class="entry-header"><h1 class="entry-title">{MARK}High water again</h1></header><div class="entry-content"><p>{MARK}{LONG}</p><p>{MARK}{LONG}</p><h2>{MARK}What comes next</h2><ul><li>{MARK}Sandbags for the mill</li><li>{MARK}Boats from the town</li></ul></div></article></main></div>
<aside id="secondary" class="widget-area"><section class="widget widget_recent_entries"><h2 class="widget-title">Recent</h2><ul><li><a href="/1">A new bridge</a></li><li><a href="/2">The fair</a></li></ul></section></aside></div>
<footer id="colophon" class="site-footer"><div class="site-info">Proudly made in the valley. All rights reserved.</div></footer></div></body></html>""",
    "blocks": f"""<!doctype html><html><body><div class="l-header"><div class="c-nav"><a href="/">Start</a> <a href="/x">Section</a> <a href="/y">Video</a></div></div>
<div class="l-main"><article class="c-article"><div class="c-article__header"><h1 class="c-article__headline">{MARK}Flood warning for the lower valley</h1></div><div class="c-article__body"><p class="c-article__paragraph">{MARK}{LONG}</p><div class="c-ad-slot" data-slot="mid">Advertisement</div><p class="c-article__paragraph">{MARK}{LONG}</p><blockquote>{MARK}We have never had so much water.</blockquote></div></article></div>
<div class="l-rail"><div class="c-related"><h3>Related</h3><a href="/1">Ten pictures of the flood</a></div></div><div class="l-footer"><p>&copy; The paper. Terms and privacy.</p></div></body></html>""",
    "tables": f"""<HTML><BODY BGCOLOR=white><TABLE WIDTH=100%><TR><TD CLASS=menu><A HREF=a.html>Home</A><BR><A HREF=b.html>News</A><BR><A HREF=c.html>Links</A></TD><TD CLASS=content><H1>{MARK}My walk along the river</H1><P>{MARK}{LONG}<P>{MARK}{LONG}</TD></TR><TR><TD COLSPAN=2 CLASS=footer>Copyright &copy; 1999 by me. Mail to the webmaster.</TD></TR></TABLE></BODY></HTML>""",
    "docs": f"""<html><body><div class="sphinx-sidebar" role="navigation"><h3>Contents</h3><ul><li><a href="#a">Install</a></li><li><a href="#b">Use</a></li></ul></div><div class="document"><div class="body" role="main"><section id="install"><h1>{MARK}Install</h1><p>{MARK}{LONG}</p><pre>{MARK}pip install river</pre><p>{MARK}{LONG}</p></section></div></div><div class="footer" role="contentinfo">Built with a generator of pages.</div></body></html>""",
    "plain": f"""<html><head><title>t</title></head><body><h1>{MARK}A letter</h1><p>{MARK}{LONG}</p><p>{MARK}{LONG}</p><p>{MARK}{LONG}</p></body></html>""",
    "consent": f"""<html><body><div id="gdpr-consent-tool" class="cookie-consent" role="dialog"><p>We and our partners use cookies. Accept to go on.</p><button>Accept all</button></div><div class="page-wrapper"><header class="header"><a class="logo" href="/">Daily</a></header><main><h1>{MARK}Council meets</h1><p>{MARK}{LONG}</p><p>{MARK}{LONG}</p></main><section class="newsletter-signup"><h4>Get our letter</h4><form><label>Your address</label><input></form></section><footer><ul><li><a href="/t">Terms</a></li><li><a href="/p">Privacy</a></li></ul></footer></div></body></html>""",
    "forum": f"""<html><body><nav class="navbar navbar-expand"><ul class="navbar-nav"><li><a href="/">Board</a></li><li><a href="/u">Users</a></li></ul></nav><div class="container"><div class="post post-content"><h1>{MARK}How high did it get at your place?</h1><p>{MARK}{LONG}</p></div><div class="comments-area"><h3>Two replies</h3><ol class="comment-list"><li class="comment"><p>Up to the door here.</p></li><li class="comment"><p>We stayed dry, luckily, as the house stands on the hill.</p></li></ol></div></div></body></html>""",
    "recipe": f"""<html><body><div class="topbar"><a href="/">Kitchen</a> <a href="/login">Log in</a></div><div class="main-content"><h1>{MARK}Fish soup</h1><div class="share-buttons"><a href="#">Share</a> <a href="#">Pin</a></div><p>{MARK}{LONG}</p><h2>{MARK}You need</h2><ul><li>{MARK}Two carp</li><li>{MARK}Salt</li></ul><ol><li>{MARK}Clean the fish and cut it.</li><li>{MARK}Boil it for an hour with the salt.</li></ol><div class="sponsored"><p>Buy the best pots from our shop now.</p></div></div><div class="sidebar-right"><p>Follow us for more.</p></div><div class="bottom-footer"><p>Imprint and contact</p></div></body></html>""",
    "spans": f"""<html><body><div><div class="menu-bar"><span><a href="/">One</a></span><span><a href="/2">Two</a></span></div><div class="story-text"><div class="headline">{MARK}Bridge closed</div><div class="paragraph">{MARK}{LONG}</div><div class="paragraph">{MARK}{LONG}</div></div><div class="outbrain-widget"><div class="title">You may like</div><a href="/q">One odd trick</a></div></div></body></html>""",
    "nested": f"""<html><body><div class="row"><div class="col-md-8"><div class="blog-post"><h2 class="blog-post-title">{MARK}Notes from the dam</h2><p class="blog-post-meta">{MARK}January 1 by Mark</p><p>{MARK}{LONG}</p><hr><p>{MARK}{LONG}</p><h3>{MARK}Numbers</h3><table><tr><td>{MARK}Level</td><td>{MARK}7 m</td></tr></table></div></div><div class="col-md-4 blog-sidebar"><h4>About</h4><p>A blog of the dam keeper.</p><h4>Elsewhere</h4><ol><li><a href="#">Code</a></li></ol></div></div><footer class="blog-footer"><p>Blog template, back to top</p></footer></body></html>""",
}


def test_foreign_markup():
    """Held-out pages in the manner of common themes, frameworks and old sites: the share of blocks labelled right."""
    field, right, total, wrong = html_extraction.trained(), 0, 0, []
    for name, page in PAGES.items():
        blocks = html_extraction.scan(page)
        for b, y in zip(blocks, field.best(field.score(blocks)), strict=True):
            good = bool(y) == b.text.startswith(MARK.strip())
            right, total = right + good, total + 1
            if not good:
                wrong.append((name, b.text[:30]))
    assert total > 80 and right >= 0.9 * total, (right, total, wrong)


def test_shared_features_agree():
    """Scores summed once an element equal those of the features written out for each block."""
    field = html_extraction.trained()
    for page in [*PAGES.values(), *[html_extraction.labelled_page(s)[0] for s in range(60_000, 60_050)]]:
        blocks = html_extraction.scan(page)
        whole = field.potentials(field.encode(html_extraction.features(blocks))).tolist()
        assert field.score(blocks) == [pytest.approx(u) for u in whole]


HOSTILE = {
    "open elements": "<div>x" * 170_000, "open elements, each its own class": "".join(f"<div class='w{i} {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}b'>x" for i in range(30_000)), "end tags of nothing": "<div>" * 80_000 + "</p>" * 80_000,
    "inline end tags of nothing": "<i><div>" + "<b>" * 100_000 + "</i>" * 100_000, "tags without an end": "<a " * 300_000, "signs": "< " * 500_000, "quotes": "<a \"'>" * 150_000, "lists": "<ul><li>" * 60_000, "tables": "<table><tr><td>x" * 40_000,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_pages(name):
    """Pages of about a megabyte: time grows with the length."""
    field, page = html_extraction.trained(), HOSTILE[name]
    start = time.process_time()
    html_extraction.main_text(page, field)
    assert time.process_time() - start < 20
