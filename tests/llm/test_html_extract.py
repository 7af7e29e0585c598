import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tidemark.llm import html_extract as H
from tidemark.llm.html_extract import extract, main_text, smooth

LONG = "A sentence of the article that goes on for quite a while, as sentences in articles do."
PAGE = """<!doctype html><html><head><title>Site</title><style>p{{}}</style><script>x="</p><p>no</p>";</script></head><body class="has-sidebar">
<header><a href="/">Home</a> Slogan of the site</header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav><div class="cookie-notice">We use cookies on this site, really a lot of them.</div>
{0}
<aside>Sidebar text, which is not short at all and goes on.</aside><div id="sidebarRight"><p>Other things to read here</p></div><form><label>Name</label><input value=q> Send this long form now</form>
<section class="comments"><article class="comment"><p>{1} says a reader.</p></article></section><div class="ad">Buy this now</div><footer>&copy; 2024 Site &middot; all rights</footer></body></html>"""


def test_article_without_what_surrounds_it():
    body = f"<article><header><h1>Title &amp; more</h1></header><p><b>{LONG}<br><p>Short.\n\t<i>One</i>  block</p><ul><li>first<li>second</ul><div class='ad'>ad</div><p>&lt;tag&gt; caf&eacute; &#233;</p></article>"
    assert main_text(PAGE.format(body, LONG)) == f"Title & more\n{LONG}\nShort. One block\nfirst\nsecond\n<tag> café é"


@pytest.mark.parametrize("wrap", ["<div class='post-content'>{}</div>", "<div role=main>{}</div>", "<main><div>{}</div></main>", "<table><tr><td>{}</td></tr></table>"])
def test_pages_without_an_article_element(wrap):
    paragraphs = [LONG, "Brief.", LONG + " More."]
    body = wrap.format("".join(f"<p>{p}</p>" for p in paragraphs))
    assert main_text(PAGE.format(body, LONG)) == "\n".join(paragraphs)


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<html></html>") == main_text("<script>var a;") == ""
    assert main_text("just text\n here") == "just text here"
    assert main_text("<article><p>cut off in the mid") == "cut off in the mid"
    assert main_text("<article>a<p>b</div></article>c") == "a\nb"
    assert main_text("<article><p>x &am; &amp y < z</p>") == "x &am; & y < z"
    assert len(main_text("<article>" + "<p>word</p>" * 30_000)) == 30_000 * 5 - 1
    assert main_text("<b>" * 3000 + "deep" + "<p>er") == "deep\ner"


def test_a_short_last_paragraph_in_a_container_of_its_own_stays():
    parts = [LONG * 5, LONG * 4, LONG * 5, "The end."]
    for wrap in ("<div>{}</div>", "<div class=para>{}</div>", "<section><p>{}</p></section>"):
        body = "".join(wrap.format(p) for p in parts)
        assert main_text(PAGE.format(f"<div id=story>{body}</div>", LONG)) == "\n".join(parts)
    gallery = "".join(f"<div class=para>{p}</div>" for p in parts[:3]) + "".join(f"<div class=pic><img src={k}>i{k}</div>" for k in range(9)) + "<div class=para>The end.</div>"
    assert main_text(PAGE.format(f"<div id=story>{gallery}</div>", LONG)).endswith("i8\nThe end.")


def test_names_are_weak_evidence():
    for name in ("related-work", "comment-on-theory", "sharing-economy", "shared", "no-sidebar"):
        assert main_text(PAGE.format(f"<div class='{name}'><p>{LONG}</p><p>{LONG}</p></div>", LONG)) == f"{LONG}\n{LONG}"
    # furniture by name, but nothing else on the page
    assert main_text(f"<div class=sidebar><p>{LONG}</p></div>") == LONG
    assert main_text(f"<body><div class=comments><p>{LONG * 9}</p></div><div><p>{LONG}</p></div></body>") == LONG


def test_lists_quotes_and_tables_inside_stay_and_link_lists_beside_go():
    body = f"<h1>Title</h1><p>{LONG}</p><ul><li>one<li>two</ul><table><tr><td>x<td>y</table><p>{LONG}</p><blockquote>Quoted.</blockquote><ol><li>last</ol>"
    menu = "<div><ul>" + "".join(f"<li><a href=/{k}>Go to {k}</a>" for k in range(9)) + "</ul></div>"
    want = f"Title\n{LONG}\none\ntwo\nx\ny\n{LONG}\nQuoted.\nlast"
    assert main_text(PAGE.format(menu + f"<div class=text>{body}</div>" + menu, LONG)) == want
    assert main_text(PAGE.format(menu + body + menu, LONG)) == want


@pytest.mark.parametrize("odd", ["<![foo[", "<![ if gte mso ]>", "<![CDATA[x]]>", "<!ELEMENT br EMPTY>", "<!>", "<!-", "<?php echo 1 ?>", "</>", "<a <b>", "<!DOCTYPE [", "&#xFFFFFFFF;", "&#0;", "<p a='", "\x00", "<![endif]-->"])
def test_odd_markup_fails_no_page(odd):
    text = main_text(f"<article><p>{LONG}</p></article>{odd}")
    assert text == LONG
    assert LONG in main_text(f"{odd}<article><p>{LONG}</p></article>") or odd in ("<!-", "<a <b>", "<p a='", "<!DOCTYPE [", "<![foo[")


PIECES = st.sampled_from(
    ["<div>", "</div>", "<p>", "</p>", "<article>", "</article>", "<main>", "<nav>", "</nav>", "<ul>", "<li>", "</ul>", "<a href=x>", "</a>", "<br>", "<![foo[", "<!--", "-->", "<![if x]>", "<table>", "<tr>", "<td>", "</table>", "<script>", "</script>", "<header>",
     "</header>", "<div class=ad>", "<div id='comment-list'>", "<section class=para>", "</section>", "text", " more words here ", LONG, "&amp;", "&", "<", ">", "'", "\x00", "<svg/>", "<textarea>", "</textarea>", "<title>", "<!doctype html>", "<p hidden>"]
)


def plain(reader):
    """The choice of lines in words of the docstring: ancestors as lists, sums written out."""
    regions, lines = reader.regions, reader.lines

    def chain(r):
        out = [r]
        while out[-1]:
            out.append(regions[out[-1]].parent)
        return out[::-1]

    seen = [x for x in lines if not regions[x[3]].aside]
    seen = [x for x in seen if not regions[x[3]].named] or seen
    body = [x for x in seen if not regions[x[3]].header] or seen
    if not body:
        return []
    value = [max(0, len(t) - k) / max(1, n) for t, n, k, _ in body]
    smoothed = []
    for i in range(len(body)):
        near = [(np.exp(-0.5 * (i - j) ** 2), value[j]) for j in range(max(0, i - 3), min(len(body), i + 4))]
        smoothed.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
    dense = [v > 1e-12 and v >= 0.5 * np.std(smoothed) for v in smoothed]
    runs, now = [], []
    for x, ok in [*zip(body, dense), (None, False)]:
        if ok:
            now.append(x)
        elif now:
            runs, now = [*runs, now], []
    if not runs:
        return []
    weigh = lambda run: sum(max(0, len(x[0]) - x[2]) for x in run)
    heavy = [r for r in runs if weigh(r) >= 0.1 * max(map(weigh, runs))]
    built = lambda r: (regions[r].parent, regions[r].tag, regions[r].names)
    like = {built(x[3]) for r in heavy for x in r if x[3]}
    chosen = [x for r in runs if r in heavy or any(built(x[3]) in like and x[3] for x in r) for x in r]
    chosen += [x for x in body if regions[x[3]].names and built(x[3]) in like]
    said = [x for x in chosen if regions[x[3]].announced]
    if said and 2 * weigh(said) >= weigh(chosen):
        chosen = said
    marked = {x[3] for x in chosen}
    common = [a for a, *others in zip(*map(chain, marked)) if all(a == b for b in others)]
    while common[-1] and regions[common[-1]].tag not in H._CONTAINER:
        common.pop()
    announced = regions[common[-1]].announced
    while announced and regions[common[-2]].announced:
        common.pop()
    root = common[-1]
    inside = [x for x in seen if root in chain(x[3])]
    if announced:
        return [x[0] for x in inside]
    top = not root or regions[root].tag == "body"
    places, out = [k for k, x in enumerate(inside) if x[3] in marked], []
    for k, x in enumerate(inside):
        below = [*chain(x[3])[chain(x[3]).index(root) + 1 :], None][0]
        if below is None or any(below in chain(r) for r in marked):
            if not (regions[x[3]].header and top):
                out.append(x[0])
            continue
        same = [y for y in inside if below in chain(y[3])]
        if sum(y[2] for y in same) > 0.5 * sum(len(y[0]) for y in same):
            continue
        if places[0] < k < places[-1] or regions[below].tag not in H._CONTAINER or regions[below].header and not top:
            out.append(x[0])
    return out


@settings(max_examples=600, deadline=None)
@given(st.lists(PIECES, max_size=40))
def test_choice_of_lines_matches_a_plain_version_on_any_markup(parts):
    html = "".join(parts)
    reader = H._Reader()
    reader.feed(html)
    reader.close()
    reader.flush()
    assert main_text(html) == "\n".join(plain(reader))


def test_deep_and_long_pages_take_little_time():
    began = time.process_time()
    assert main_text("<div>" * 20_000 + "deep" + "</b>" * 20_000) == "deep"
    assert len(main_text("<div>" * 3000 + f"<div><p>{LONG}</p></div>" * 3000)) > 200_000
    assert time.process_time() - began < 20


def test_smoothing_keeps_constants():
    assert np.allclose(smooth(np.ones(9)), 1) and len(smooth(np.ones(1))) == 1
    v = smooth(np.asarray([0, 0, 9.0, 0, 0]))
    assert v[2] == v.max() and v[1] > v[0]


def test_rows(spark):
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("text", T.StringType())])
    rows = [(1, "u", "<article><p>é b</p>", "q"), (1, "u", "<article><p>é b</p>", "q"), (2, None, None, None), (None, "v", "", "")]
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in extract(spark.createDataFrame(rows, schema)).collect())
    assert got == [(0, "", 0), (1, "é b", 3), (1, "é b", 3), (2, "", 0)]
    assert extract(spark.createDataFrame([], schema)).count() == 0
