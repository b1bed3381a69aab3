"""Classes, nesting and text of small hosts."""

import time
from collections import Counter, defaultdict

from corpuscle.llm import html_template as h

DDL = "page_id LONG, url STRING, html STRING, host STRING, text STRING, template STRING"


def page(i, mark="article"):
    return (f"<!DOCTYPE html><html><head><title>T{i}</title><script>var a='</p>';</script></head><body><nav><ul>"
            + "".join(f"<li><a href=/{k}>n{i}-{k}</a></li>" for k in range(i % 4 + 1))
            + f"</ul></nav><!-- ad --><div class='top ad'>Buy {i}</div><div>All rights kept</div><{mark}><h1>Head {i}</h1><p><b>One  {i} &amp; &lt;two&gt;<br>"
            f"next {i}\n<p>Last&nbsp;{i}</p><div class=comments><p>me too</p></div></{mark}><footer>&copy; us</footer>")


def text(i):
    return f"Head {i}\n\nOne {i} & <two> next {i}\n\nLast {i}"


def rows(spark, pages):
    return spark.createDataFrame([(k, u, p, "h", "t", "x") for k, u, p in pages], DDL)


def test_marked_article(spark):
    pages = [(i, f"http://a.b/{i}", page(i)) for i in range(12)] + [(3, "http://a.b/3", page(3)), (50, None, page(5)), (51, "http://x.y/", None),
                                                                  (52, "http://x.y/", ""), (None, None, "<p>x"), (53, "u", "plain &amp; text")]
    got = h.extract(rows(spark, pages)).collect()
    assert len(got) == len(pages)
    for r in got:
        want = {51: "", 52: "", 53: "plain & text", None: "x", 50: text(5)}.get(r.page_id, text(r.page_id or 0))
        assert r.text == want and r.n_chars == len(want), r.page_id
    assert h.extract(rows(spark, [])).count() == 0


def test_unmarked_text_is_what_the_template_leaves(spark):
    pages = [(i, f"http://a.b/{i}", page(i, "div")) for i in range(12)] + [(90, "http://lone.host/", page(7, "div"))]
    got = {r.page_id: r.text for r in h.extract(rows(spark, pages)).collect()}
    assert all(got[i] == text(i) for i in range(12))
    assert got[90] == "All rights kept\n\n" + text(7)         # one page makes no template


def test_template_nests(spark):
    pages = [(i, f"http://a.b/{i}", page(i).replace("<li>", "<li><div><p>").replace("</li>", "</p></div></li>")) for i in range(12)]
    found = h.templates(rows(spark, pages)).collect()
    assert [r.host for r in found] == ["a.b"]
    first, second = found[0].template[:2]
    assert first.gap == -1 and second.gap > 0 and len(second.order) == 6      # li, div and p in the menu's gap


def test_order_and_gap():
    assert h.placed([[1, 2], [3]], None) == [None, None]
    tokens = {"<i>": 0}
    assert tokens and h.main_text("<article>a<p>b", set()) == "a\n\nb"
    assert h.main_text("<main><form>x</form>y<aside>z</aside></main>", set()) == "y"
    assert h.main_text("<script>if (a<b) '<p>x</p>'</script>t", set()) == "t"
    assert h.main_text("a <!-- b", set()) == "a"


def test_very_long_and_deep_pages():
    assert len(h.main_text("<article>" + "<p>word " * 50_000, set()).split()) == 50_000
    assert h.main_text("<div>" * 20_000 + "x", set()) == "x"


def boxed(i):
    return (f"<html><body><article><h1>Head {i}</h1><div class=x1><p>Pass it on</p></div>"
            + "".join(f"<p>Text {i} {k}</p>" for k in range(i % 3 + 1))
            + "<div class=x2><p>Read more</p><p>All rights kept</p></div></article></body></html>")


def test_template_text_in_articles(spark):
    want = {i: "\n\n".join([f"Head {i}", *[f"Text {i} {k}" for k in range(i % 3 + 1)]]) for i in range(12)}
    pages = [(i, f"http://a.b/{i}", boxed(i)) for i in range(12)]
    assert {r.page_id: r.text for r in h.extract(rows(spark, pages)).collect()} == want
    few = h.extract(rows(spark, pages[:4])).collect()                # too few pages for a template
    assert all("Pass it on" in r.text for r in few)


def test_copies_of_a_page_are_no_template(spark):
    same = [(i, f"http://a.b/{i // 2}", boxed(5)) for i in range(30)]
    got = h.extract(rows(spark, same + [(99, "http://a.b/x", boxed(6))])).collect()
    assert len(got) == 31 and all("Text 5 2" in r.text for r in got if r.page_id != 99)


def test_class_words_of_wrappers():
    whole = ('<body class="has-sidebar">', '<div class="no-sidebar single-post">', '<div id="page-with-nav">',
             '<div class="header-fixed">', '<html class="nav"><body class="menu">', '<main class="social">')
    for wrapper in whole:
        assert h.main_text(f"{wrapper}<article class='comments-open'><p>x</p></article>", set()) == "x", wrapper
        assert h.main_text(f"{wrapper}<p>x</p>", set()) == "x", wrapper
    assert h.main_text("<article class=sponsored>a<article class=comment>b</article></article>", set()) == "a"
    for name in ("sidebar", "left-sidebar", "site_header", "Nav", "x ad"):
        assert h.main_text(f"<div class='{name}'>a</div><p>x", set()) == "x", name


def test_quoted_signs_do_not_end_a_tag():
    assert h.main_text('<div title="a > b" class="x">Hello</div>', set()) == "Hello"
    assert h.main_text("<p title='a > b' class=ad>x</p>y", set()) == "y"
    assert h.main_text("<div title=it's>x</div><p>y's", set()) == "x\n\ny's"
    assert h.main_text('<div a="b>x</div>', set()) == "x"                    # a quote that is never closed


def test_inline_adverts():
    page = ('<article><p>Hello <ins class="adsbygoogle">Buy</ins>big <span class="ad">x<span>y</span>z</span>world'
            ' <a class="share" href=/>s</a><a href=/u>link</a></p><p>b <ins>new</ins></p></article>')
    assert h.main_text(page, set()) == "Hello big world link\n\nb new"
    assert h.main_text("<p>a <span class=ad>b<p>c", set()) == "a\n\nc"       # left open


def test_boxes_of_comments_and_adverts():
    for name in ("comments-list", "comment-list", "ad-container", "adBanner", "siteHeader", "commentsSection", "nav-links"):
        assert h.main_text(f'<article><p>t</p><div class="{name}"><p>c</p></div></article>', set()) == "t", name
    for name in ("list", "container", "header-fixed", "page-with-nav-list", "adapter", "content-area"):
        assert h.main_text(f'<div class="{name}"><p>c</p></div>', set()) == "c", name
    assert h.main_text('<p data-id="social" data-role="nav">kept</p><p id=social>gone</p>', set()) == "kept"


def test_forms_around_the_page():
    assert h.main_text("<form id=f><div><h1>T</h1><article><p>x</p><form>find</form></article></div></form>", set()) == "x"
    assert h.main_text("<form><h1>T</h1><p>x</p></form>", set()) == "T\n\nx"
    assert h.main_text("<p>a</p><form><p>name</p></form>", set()) == "a"


def test_stray_tags_take_linear_time():
    began = time.perf_counter()
    h.main_text("<div>" * 20_000 + "</section>" * 20_000 + "<li>x" * 20_000, set())
    h.main_text("<p " + "a= " * 20_000 + "x" + '<p a="' * 20_000 + "<a b='" * 20_000, set())
    assert time.perf_counter() - began < 10


def brute_classes(host, support, least_tokens):
    """Occurrence vectors compared as they are, page by page."""
    counts = [Counter(h.tokens(p)) for p in host]
    by_vector = defaultdict(set)
    for token in {t for c in counts for t in c}:
        vector = tuple(c[token] for c in counts)
        if sum(n > 0 for n in vector) >= support * len(host):
            by_vector[vector].add(token)
    return {frozenset(own) for own in by_vector.values() if len(own) >= least_tokens}


def test_classes_equal_brute_force(spark):
    """Fingerprints group the tokens that whole vectors do; invalid classes go, valid ones keep one order and gap."""
    hosts = {"a.b": [page(i) for i in range(12)], "c.d": [boxed(i) for i in range(9)], "e.f": [page(i, "div") + boxed(i) for i in range(10)]}
    pages = [(i, f"http://{host}/{i}", p) for host, own in hosts.items() for i, p in enumerate(own)]
    found = {r.host: r.template for r in h.templates(rows(spark, pages)).collect()}
    for host, own in hosts.items():
        classes = sorted(brute_classes(own, h.SUPPORT, h.LEAST_TOKENS), key=lambda c: sorted(c))
        kept = {frozenset(c.order) for c in found[host]}
        assert kept and kept <= set(classes)
        for c in found[host]:
            runs = [[t for t in h.tokens(p) if t in set(c.order)] for p in own]
            assert all(run == c.order * (len(run) // len(c.order)) for run in runs)
