"""Hand-marked layouts: block precision and recall of the main text, and what the cut itself decides.

In a layout, a block that belongs to the article is written ``+ tag text`` and any other ``- tag text`` (a text that
begins with ``a:`` is a link); all other lines are markup as it stands.
"""

import re

from tidegate.llm import html_extract

P1 = "The harbour town rebuilt its old pier over two winters, and the boats came back in spring."
P2 = "Most of the timber was cut in the hills behind the valley, dried for a year, and floated down the river."
P3 = "Nobody had expected the work to be done before the storms, yet the last plank was laid in October."
C1 = "I grew up two streets away from there and never thought that I would see it open again, thank you."
C2 = "My grandfather worked on the first one, he would have had something to say about the new railing."

LAYOUTS = {
    "semantic": "<header>|- p Daily Shore|</header><nav><ul>|- li a:Home|- li a:Sport|</ul></nav><main><article>|+ h1 The pier is back|+ p P1|+ p P2|</article></main><aside>|- p P3|</aside><footer>|- p © 2031 Daily Shore|</footer>",
    "layout with sidebar": '<div class="layout with-sidebar"><div class="content">|+ h1 The pier is back|+ p P1|+ p P2|+ p P3|</div><div class="sidebar">|- h3 Most read|- li a:Ten walks by the sea|- li a:Where to eat|</div></div>',
    "tagged story": '<div class="story post-tag-news">|+ h1 The pier is back|+ p P1|+ p P2|</div><div class="post-tags">|- a a:news|- a a:harbour|</div>',
    "social text": '<div class="article-social-text">|+ p P1|+ p P2|</div><div class="social-links">|- li a:Share|- li a:Send|</div>',
    "entry header": '<article><header class="entry-header">|+ h1 The pier is back|</header><div class="entry-content">|+ p P1|+ p P2|</div><footer class="entry-footer">|- p Filed under a:harbour|</footer></article>',
    "page header": '<main><div class="page-header">|+ h1 The pier is back|</div>|+ p P1|+ p P2|</main><div id="footer">|- p All rights reserved|</div>',
    "comments": '<article>|+ h1 The pier is back|+ p P1|+ p P2|</article><section id="comments">|- h2 2 comments|- p C1|- p C2|</section>',
    "comments as articles": '<article class="post">|+ h1 The pier is back|+ p P1|</article><ol class="comment-list"><li><article class="comment">|- p C1|</article></li><li><article class="comment">|- p C2|</article></li></ol>',
    "short post, many comments": '<div class="post">|+ h1 The pier is back|+ p P1|</div><div class="comments">|- p C1|- p C2|- p C1|- p C2|- p C1|</div>',
    "no classes": "<div>|- a a:Home|- a a:About|- a a:Contact|</div><div>|+ h1 The pier is back|+ p P1|+ p P2|</div><div>|- a a:Imprint|- a a:Privacy|</div>",
    "cookie bar": '<div class="cookie-notice">|- p We use cookies to make this site work and to learn how it is used by our readers every day.|- button Accept|</div><article>|+ h1 The pier is back|+ p P1|+ p P2|</article>',
    "advert inside": '<article>|+ p P1|<div class="ad">|- p Buy the new boots that hikers all over the country are talking about this season.|</div>|+ p P2|</article>',
    "related inside": '<article>|+ h1 The pier is back|+ p P1|<div class="related-posts">|- h3 Related|- li a:The old pier burns|- li a:A town and its boats|</div>|+ p P2|</article>',
    "newsletter form": '<article>|+ p P1|<form class="newsletter">|- p Sign up to get one letter from the coast in your inbox every Friday, free of charge.|</form>|+ p P2|</article>',
    "short lines": "<main>|+ h1 Notes|+ p Cold.|+ p P1|+ p Windy.|+ p P2|+ p Home by six.|</main><footer>|- p a:Top|</footer>",
    "list article": '<div class="post-content">|+ h1 What to bring|+ p P1|<ul>|+ li A coat that keeps the wind out, even if the morning looks calm and bright.|+ li Something to eat on the way, since nothing is open before noon.|</ul>|+ p P2|</div><ul class="menu">|- li a:Home|- li a:Archive|</ul>',
    "table layout": '<table><tr><td class="leftnav">|- a a:Home|- a a:News|</td><td>|+ h1 The pier is back|+ p P1|+ p P2|</td></tr></table>',
    "breadcrumb and share": '<div class="breadcrumbs">|- a a:Home|- a a:Coast|</div><article>|+ h1 The pier is back|<div class="share">|- a a:Share this|</div>|+ p P1|+ p P2|</article><div class="pagination">|- a a:Next|</div>',
    "quote": "<main><article>|+ p P1|<blockquote>|+ p We only wanted a place to sit and look at the water.|</blockquote>|+ p P2|</article></main><div class='copyright'>|- p Copyright 2031 the editors of this paper|</div>",
    "hidden and modal": '<div class="modal" style="display: none">|- p Please log in to read on, or make an account, it takes a minute and costs nothing.|</div><div id="main">|+ h1 The pier is back|+ p P1|+ p P2|</div>',
    "sidebar first": '<div id="wrapper"><div id="left-sidebar">|- h4 About|- p A small paper about the coast and those who live there, printed since 1974 in one room.|</div><div id="content">|+ h1 The pier is back|+ p P1|+ p P2|+ p P3|</div></div>',
    "docs": '<div class="page-body"><div class="toolbar">|- a a:Edit|- a a:History|</div><div class="prose">|+ h1 Setting up|+ p P1|+ pre cut --width 20 plank|+ p P2|</div><div class="toc-sidebar">|- li a:Setting up|</div></div>',
    "blank div soup": '<div class="c1"><div class="c2"><div class="c3">|+ p P1|</div><div class="c3">|+ p P2|</div></div></div><div class="c9">|- a a:More|- a a:Less|</div>',
    "poem in divs": "<div>|+ h1 Evening|+ div The gulls went home|+ div The sea was grey|+ div And no one came|+ p P1|+ p P2|</div><div>|- div a:Next poem|- div a:Index|</div>",
    "plain footer lines": '<div class="content">|+ p P1|+ p P2|</div><div>|- div a:Imprint|- div Printed in the old mill|- div a:Privacy|- div a:Jobs|</div>',
    "dialogue": '<div class="text">|+ p P1|+ div Who is there|+ p P2|+ div Only me|+ p P3|</div>',
    "caption": "<div>|+ p P1|<figure>|+ figcaption The pier in 1931|</figure>|+ p P2|</div>",
    "word among links": "<div>|- div a:Home|- div Sections|- div a:Sport|- div a:Culture|</div><div>|+ h1 The pier is back|+ p P1|+ p P2|</div>",
    "steps without classes": "<div>|+ h1 A small shelf|+ p P1|+ div Saw the boards|+ div Sand the edges|+ div Glue and wait|+ p P3|</div><div>|- div a:Print|- div a:Save|</div>",
    "closing line": "<div>|+ p P1|+ p P2|+ p Home by six|</div><div>|- div a:Older|- div a:Newer|- p Opening hours|- div a:Map|</div>",
    "body layout class": '<div class="single has-sidebar no-footer"><article class="hentry">|+ h1 The pier is back|+ p P1|+ p P2|</article><div class="widget">|- h3 Search|- p a:Advanced|</div></div>',
}


def page(layout):
    """(html, [(text, whether it belongs)]) of a layout."""
    out, blocks = [], []
    for line in re.split(r"\||(?<=>)(?=[+-] )", layout):
        m = re.match(r"([+-]) (\w+) (.*)", line)
        if not m:
            out.append(line)
            continue
        text = re.sub(r"\b(P1|P2|P3|C1|C2)\b", lambda x: globals()[x[0]], m[3])
        shown = re.sub(r"a:(.*)", r'<a href="/x">\1</a>', text)
        tag = "span" if m[2] == "a" else m[2]
        out.append(f"<{tag}>{shown}</{tag}>" if tag != "span" else f"<div>{shown}</div>")
        blocks.append((text.replace("a:", ""), m[1] == "+"))
    return f"<!DOCTYPE html><html><head><title>T</title></head><body>{''.join(out)}</body></html>", blocks


def test_gold_layouts():
    right = wrong = missed = blocks = flipped = 0
    failed = []
    for name, layout in LAYOUTS.items():
        html, marked = page(layout)
        found = html_extract.blocks(html)
        assert [b.text for b in found] == [t for t, _ in marked], name
        alone = [html_extract.preference(b) > 0 for b in found]
        cut = html_extract.minimum_cut([html_extract.preference(b) for b in found], html_extract.edges(found))
        flipped += sum(a != c for a, c in zip(alone, cut, strict=True))
        blocks += len(found)
        for (text, belongs), c in zip(marked, cut, strict=True):
            right, wrong, missed = right + (c and belongs), wrong + (c and not belongs), missed + (belongs and not c)
            if c != belongs:
                failed.append((name, text[:40], "kept" if c else "lost"))
    print(f"{len(LAYOUTS)} layouts, {blocks} blocks, precision {right / (right + wrong):.3f}, recall {right / (right + missed):.3f}, flipped by the cut {flipped}", failed)
    assert right / (right + wrong) >= 0.97 and right / (right + missed) >= 0.97 and flipped >= 5


def test_depth_and_bad_markup():
    deep = "<div>" * 8000 + "<p>" + P1 + "</p>" + "</div></section>" * 8000 + "<p>" + P2
    assert html_extract.extract(deep) == f"{P1}\n{P2}"
    assert html_extract.extract('<div class="sidebar">' * 3000 + "<p>" + P1) == P1  # it holds all the prose there is
    assert html_extract.hints("with-sidebar no-footer") == (0.0, False, 0.0)
    assert html_extract.hints("entry-header")[0] == html_extract.hints("page-header")[0] == 0.0 and html_extract.hints("site-header")[0] == 1.0
    assert html_extract.hints("siteFooter")[1] and html_extract.hints("articleBody") == (0.0, False, 1.0)
