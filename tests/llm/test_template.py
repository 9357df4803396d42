import html
import re

from tenderline.llm import template


def page(article, nav=4, ad="Buy now"):
    items = "".join(f'<li><a href="/{i}">Link {i}</a></li>' for i in range(nav))
    return (
        f'<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul>{items}</ul></nav><!-- x -->'
        f'<div class="ad">{ad}</div>{article}<footer>&copy; all rights</footer></body></html>'
    )


def text_of(source, t=None):
    return template.main_text(template.Page(source), t)


def test_blocks_references_and_white_space():
    got = text_of(page("<article><h1>A &amp; B</h1><p><b>First\n  line &lt;x&gt;<br>goes on<p>Second&nbsp;one &amp &am<ul><li>i<li>j</ul><p></p></article>"))
    assert got == "A & B\nFirst line <x> goes on\nSecond one & &am\ni\nj"


def test_parts_that_are_not_the_article():
    inside = '<article><p>Text.</p><aside>no</aside><div class="cookie-notice">no</div><form><p>no</p></form><section id="comments"><p>no</p></section><p>More.</p></article>'
    assert text_of(page(inside)) == "Text.\nMore."
    assert text_of("") == "" and text_of("plain words") == ""
    assert text_of("<p>only") == "only"


def test_main_slot_without_an_article_element():
    pages = [page(f'<div class="story"><p>Body {i} with words enough to be the largest slot of it.</p><p>Same on all.</p></div>', nav=3 + i % 3) for i in range(9)]
    tokens = {}
    for number, source in enumerate(pages):
        own = template.Page(source)
        for p, n in own.elements.items():
            tokens.setdefault(("/".join(p), 0), []).append((number, n))
        for p, t, _ in own.blocks:
            tokens.setdefault(("/".join(p), template._mark(t)), []).append((number, 1))
    chars = {}
    for source in pages:
        for p, t, linked in template.Page(source).blocks:
            chars.setdefault("/".join(p), [0, 0])
            chars["/".join(p)][0] += len(t)
            chars["/".join(p)][1] += linked
    rows = [
        {"path": p, "mark": m, "pages": len(v), "times": sum(n for _, n in v), "first": hash(tuple(v)), "second": 0, "chars": chars.get(p, (0, 0))[0] if not m else 0, "links": chars.get(p, (0, 0))[1] if not m else 0}
        for (p, m), v in tokens.items()
    ]
    found = template.deduce(rows, len(pages))
    assert found["main"] == ["html/body/div.story"]
    assert any(p.endswith("nav/ul/li") for p in found["lists"])
    assert text_of(pages[3], found) == "Body 3 with words enough to be the largest slot of it."


def test_pages_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in template.extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        body = r.html[r.html.find("<article>") + 9 : r.html.find("</article>")]
        blocks = [" ".join(html.unescape(re.sub(r"<br>|</?b>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        want = "\n".join(b for b in blocks if b)
        assert got[r.page_id].text == want, r.page_id
        assert got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url


def test_defined_cases(spark):
    rows = [(1, "http://a.b/c", None), (2, None, page("<article><p>x</p></article>")), (2, None, page("<article><p>x</p></article>")), (3, "not a url", ""), (None, "http://A.b:80/", "<p>y")]
    pages = spark.createDataFrame([(i, u, h, "t") for i, u, h in rows], "page_id bigint, url string, html string, template string")
    got = sorted([(r.page_id, r.url, r.text) for r in template.extract(pages).collect()], key=str)
    assert got == sorted([(1, "http://a.b/c", ""), (2, None, "x"), (2, None, "x"), (3, "not a url", ""), (None, "http://A.b:80/", "y")], key=str)
    assert template.extract(pages.limit(0)).count() == 0


def test_fixed_text_shares_its_class_with_an_element_around_it():
    def token(path, mark, pages, vector, chars=0):
        return {"path": path, "mark": mark, "pages": pages, "times": pages, "first": vector, "second": vector, "chars": chars, "links": 0}

    tokens = [
        token("html", 0, 10, 1), token("html/body", 0, 10, 1, 900), token("html/body/div.box", 0, 4, 2),
        token("html/body", 11, 10, 1),  # on all pages, as body
        token("html/body/div.box", 12, 4, 2),  # wherever the box is
        token("html/body", 13, 4, 3),  # on other pages than any element around it: what some pages say
    ]
    assert template.deduce(tokens, 10)["fixed"] == ["html/body\x0011", "html/body/div.box\x0012"]
