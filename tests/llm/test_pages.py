import pytest

from aljibe.llm import pages

SITE = """<html><body><header><a href=/>Site</a></header><nav><ul><li>Home<li>About</ul></nav><div class="cookie-notice">We use cookies</div>
<div id=content><h1>Title {i}</h1><p>First &amp; best {i}, long enough to be the text of the page<p>Second<br>para&#103;raph {i}<div class=share-bar>Share</div>{extra}</div>
<div class="sidebar"><p>Side {i} text</div><div class="comments"><p>a reader says {i}</div><form><label>Mail</label></form><footer>c {i}</footer><script>var x = "<p>no</p>"</script>"""
ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><nav><a href="/x">menu</a></nav><!-- <p>ad</p> --><div class="ad">buy</div>
<article><h1>Head {i}</h1><p><b>bold {i}<br><p>  two
 lines </p><aside>more</aside><section class="comments"><p>me too</p></section></article><footer>&copy; f</footer></body></html>"""


def wrapper(texts):
    whole = None
    for text in texts:
        own = pages.wrapper_of(pages.parse(text))
        whole = pages.merge(whole, own) if whole else own
    return whole


def site(i):
    return SITE.format(i=i, extra=f"<ul><li>x{i}<li>y{i}</ul><p>Tail {i}" if i % 2 else "")


def test_wrappers_are_union_free_expressions():
    same = wrapper(["<div><p>a</p><p>b</p></div>", "<div><p>c</p></div>"])
    assert pages.expression(same) == "<><div><p>#</>+</></>"
    optional = wrapper(["<div><h1>a</h1><p>b</p></div>", "<div><p>b</p><hr></div>"])
    assert pages.expression(optional) == "<><div>(<h1>#</>)? <p>#</> (<hr></>)?</></>"
    group = wrapper(["<div><p>a</p><ul><li>b</ul><p>c</p></div>", "<div><p>a</p></div>"])
    assert pages.expression(group) == "<><div>((<p>#</>+)? (<ul><li>#</></>)?)+</></>"
    order = wrapper(["<h1>a</h1><h2>b</h2>", "<h2>b</h2><h1>a</h1>"])
    assert pages.expression(order) == "<>((<h1>#</>)? (<h2>#</>)?)+</>"


def test_merging_wrappers_in_any_grouping_keeps_all_slots():
    texts = [site(i) for i in range(6)] + [ARTICLE.format(i=1)]
    one, two = wrapper(texts), pages.merge(wrapper(texts[:3]), wrapper(texts[3:]))
    for text in texts:
        assert pages.extract(text, pages.choose(one)) == pages.extract(text, pages.choose(two)) != ""


def test_main_text_by_container_and_by_mass(spark, with_clashes):
    data = [(i, f"http://one.net/{i}", site(i)) for i in range(8)] + [(100 + i, f"http://two.net/{i}", ARTICLE.format(i=i)) for i in range(3)]
    data += [(200, None, ARTICLE.format(i=7)), (201, "http://three.net", None), (202, "http://three.net", ""), (203, "http://four.net", "plain &lt; text"), (None, "http://five.net", "<p>x"), (0, "http://one.net/0", site(0))]
    got = pages.main_text(with_clashes(spark.createDataFrame(data, "page_id long, url string, html string"))).collect()
    found = {r.page_id: r.text for r in got}
    assert len(got) == len(data) and all(r.n_chars == len(r.text) for r in got)
    assert found[2] == "Title 2\n\nFirst & best 2, long enough to be the text of the page\n\nSecond paragraph 2"
    assert found[3].endswith("paragraph 3\n\nx3\n\ny3\n\nTail 3")
    assert found[101] == "Head 1\n\nbold 1\n\ntwo lines" and found[200] == "Head 7\n\nbold 7\n\ntwo lines"
    assert found[201] == found[202] == "" and found[203] == "plain < text" and found[None] == "x"
    assert pages.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_labels_keep_what_names_a_layout():
    assert pages.label("div", ' class="c1 col-md-8" id=post-12345') == "div.c1.col.md.post"
    assert pages.label("div", ' id="p7"') != pages.label("div", ' id="p8"') and pages.label("p", " hidden") == "p"


def test_layouts_without_telling_names():
    page = "<div class=c1><p>Welcome to our site</p></div><div class=c2><h1>Story {i}</h1><p>Once {i} upon a time there was a longer text than any other {i}</p></div><div class=c3><a href=x>Link {i}</a></div>"
    texts = [page.format(i=i) for i in range(6)]
    assert pages.extract(texts[4], pages.choose(wrapper(texts))) == "Story 4\n\nOnce 4 upon a time there was a longer text than any other 4"


def test_boilerplate_by_name():
    boiler = ["nav", "header", "div.ad", "div.ad2", "div.header.page", "section.comments", "article.comment", "article.related", "div.commentlist", "p.notice", "div.sidebar", "ul.menu"]
    text = ["div.content.sidebar.with", "article.post", "body.has.sidebar", "div.entry", "p", "main", "section.story"]
    assert all(pages.is_boiler(n, False) for n in boiler) and not any(pages.is_boiler(n, False) for n in text)
    assert not pages.is_boiler("header", True)


@pytest.mark.parametrize("page", ["<", "<p", "</p></div>", "<a href='x>y", "<p a=\"" * 2000, "<div>" * 3000, "&#xD800; &#0; &bogus;", "<script>", "<!--", "<![CDATA[x", "<table><tr><td>a<td>b<tr><td>c</table>"])
def test_broken_pages_do_not_stop(page):
    assert isinstance(pages.extract(page, pages.choose(pages.wrapper_of(pages.parse(page)))), str)


def text_of(page):
    return pages.extract(page, pages.choose(pages.wrapper_of(pages.parse(page))))


@pytest.mark.parametrize("size", [10, 4001, 300_000])
def test_long_attributes_are_part_of_their_tag(size):
    value = "a>" * (size // 2)
    page = f"""<body><article><h1>Title</h1><p>one<img src="data:image/png;base64,{value}"> two</p><div data-state='{value}'><p>three</p></div><p>four</p></article><footer>no</footer>"""
    assert text_of(page) == "Title\n\none two\n\nthree\n\nfour"


def test_an_unclosed_quote_ends_with_its_tag():
    assert text_of('<article><p title="x>one</p><p>two</p></article>') == "one\n\ntwo"
    assert text_of("<article><p title='x>one</p><p>it\u2019s \"two\"</p></article>") == 'one\n\nit\u2019s "two"'


def test_self_closed_pictures_and_formulas():
    assert text_of('<article><p>a<svg class="i" /> b</p><p>c<svg><path/></svg>d</p></article>') == "a b\n\ncd"
    formula = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation>x=1</annotation></semantics></math>"
    assert text_of(f"<article><p>so {formula} holds<math /></p><p>more</p></article>") == "so x=1 holds\n\nmore"


def test_titles_and_sections_named_like_boilerplate_stay():
    page = """<body class="has-sidebar"><header class="site-header"><p>Site</p></header><div class="has-banner no-comments"><article><header class="entry-header"><h1 class="header">Title</h1></header>
    <h2 id="related-work">Related work</h2><section id="search-algorithms"><p>one</p></section><section id="social-policy"><p>two</p></section>
    <div class="commentary"><p>three</p></div><div class="share-bar"><p>Share</p></div><section id="comments"><p>me too</p></section><div id="search-box"><p>Find</p></div></article></div></body>"""
    assert text_of(page) == "Title\n\nRelated work\n\none\n\ntwo\n\nthree"


def test_a_form_around_the_page():
    page = """<body><form id="aspnetForm" method="post"><div class="nav"><p>menu</p></div>{}<div class="footer"><p>imprint</p></div></form></body>"""
    body = "<h1>Title</h1><p>The text of the page is longer than all that stands around it</p>"
    want = "Title\n\nThe text of the page is longer than all that stands around it"
    assert text_of(page.format(f"<article>{body}</article>")) == text_of(page.format(f"<div id=main>{body}</div>")) == text_of(page.format(f"<div class=c1>{body}</div>")) == want
    assert text_of(f"<article>{body}<form><p>Mail</p></form></article>") == want


def texts_of(texts):
    whole = pages.choose(wrapper(texts))
    return [pages.extract(text, whole) for text in texts]


def test_the_template_inside_articles_is_left_out():
    """The same advert in a neutral element inside every article goes; the same heading stays, and so does what varies under the advert's label."""
    page = "<body><article><h1>Title {i}</h1><h2>Abstract</h2><p>Text {i} that differs from page to page.</p><div class=box><p>Buy two, get one</p></div><p>More {i}</p></article></body>"
    want = [f"Title {i}\n\nAbstract\n\nText {i} that differs from page to page.\n\nMore {i}" for i in range(20)]
    assert texts_of([page.format(i=i) for i in range(20)]) == want
    other = page.replace("Buy two, get one", "Aside {i}")
    assert all(f"Aside {i}" in text for i, text in enumerate(texts_of([other.format(i=i) for i in range(20)])))
    few = texts_of([page.format(i=i) for i in range(pages.LEAST_PAGES - 1)])
    assert all("Buy two" in text for text in few)  # too few pages to tell a template


def test_copies_of_one_page_keep_their_text():
    page = "<body><article><h1>Title</h1><p>The one text of this host</p><div class=box><p>and a box</p></div></article></body>"
    assert texts_of([page] * 30) == ["Title\n\nThe one text of this host\n\nand a box"] * 30


def test_repeats_on_one_page_make_no_template():
    page = "<body><article><p>Text {i} of this page and of no other one</p>" + "<div class=box><p>same</p></div>" * 9 + "</article></body>"
    assert texts_of([page.format(i=1)])[0].count("same") == 9 and texts_of([page.format(i=i) for i in range(5)])[0].count("same") == 0


def test_a_teaser_does_not_hide_the_page():
    story = "".join(f"<p>Sentence {i} of the story.</p>" for i in range(20))
    want = "short teaser\n\n" + "\n\n".join(f"Sentence {i} of the story." for i in range(20))
    assert text_of(f"<main><article><p>short teaser</p></article><div>{story}</div></main>") == want
    assert text_of(f"<main><article>{story}</article><div><p>also on this site</p></div></main>") == want.removeprefix("short teaser\n\n")


def test_layouts_mixed_on_one_host():
    article = ["<body><article><p>Article {i} with a text</p></article><div class=c9><p>Other {i}</p></div></body>".format(i=i) for i in range(8)]
    main = ["<body><main><p>Main {i} with a text</p></main><div class=c9><p>Much other text beside, longer than the main text of {i}</p></div></body>".format(i=i) for i in range(8)]
    assert texts_of(article + main) == [f"Article {i} with a text" for i in range(8)] + [f"Main {i} with a text" for i in range(8)]


def test_signs_that_are_no_tags_are_text():
    assert text_of("<article><p>3 < 4 and so on") == "3 < 4 and so on"
    assert text_of("<article><p>a <3 b</p><p>c <") == "a <3 b\n\nc <"
    assert text_of("<article><p>whole</p><p>cut <b") == "whole\n\ncut"


def test_made_up_class_names_do_not_make_a_wrapper_grow():
    page = "<body><div class='css-{n:x}a1b card_{n}x9'><article class='post-{n} sc-0{n}z'><p>Text {n}</p></article></div></body>"
    one, many = (len(pages._dump(wrapper([page.format(n=n) for n in range(k)]))) for k in (2, 200))
    assert many < one + 40


def aligned(texts):
    """Slots of a wrapper by plain means: per path of labels, the pages that have a text there and whether all texts are equal."""
    found = {}
    for page, text in enumerate(texts):
        def walk(node, path):
            for child in node[1]:
                if child[0] == pages.TEXT:
                    found.setdefault(path, []).append((page, child[1]))
                else:
                    walk(child, (*path, child[0]))
        walk(pages.parse(text), ())
    return {path: (len({page for page, _ in hits}), len({text for _, text in hits}) == 1, len(hits)) for path, hits in found.items()}


def slots_of(node, path=()):
    for child in node[pages.CHILDREN]:
        if child[pages.LABEL] == pages.TEXT:
            yield path, (child[pages.PAGES], child[pages.SAME] is not None, child[pages.SEEN])
        else:
            yield from slots_of(child, (*path, child[pages.LABEL]))


@pytest.mark.parametrize("seed", range(10))
def test_alignment_equals_brute_force_on_small_pages(seed):
    import random

    dice = random.Random(seed)

    def element(depth):
        tag = dice.choice(["div", "section", "div class=x", "p", "ul"])
        inner = dice.choice(["same", f"t{dice.randrange(3)}"]) if depth == 0 or dice.random() < 0.3 else "".join(element(depth - 1) for _ in range(dice.randrange(1, 4)))
        return f"<{tag}>{inner}</{tag.split()[0]}>"

    texts = ["<body>" + "".join(element(2) for _ in range(dice.randrange(1, 4))) + "</body>" for _ in range(dice.randrange(1, 9))]
    whole = wrapper(texts)
    got, want = dict(slots_of(whole)), aligned(texts)
    assert got == want
