import time

import pytest
from pyspark.sql import functions as F

from aljibe.operators import documents
from aljibe.operators.tag_tree import Selector, parse, select_elements, selected


def found(html, block, **fields):
    return selected(html, Selector(block), [(Selector(s) if s else None, what) for s, what in fields.values()])


def test_tags_attributes_and_quotes():
    html = """<A HREF='x'>one</A> <a class=big href="y>z" data-k='"'>t<b>w</b>o</a> <a href=z&amp;q>three &lt;</a> <a name=here>no</a> <a href>empty</a> <aside href=n>"""
    assert found(html, "a[href]", link=("", "href"), text=("", "text")) == [["x", "one"], ["y>z", "two"], ["z&q", "three <"], ["", "empty"]]
    assert found(html, "a.big", k=("", "data-k"), class_=("", "CLASS".lower())) == [['"', "big"]]
    with pytest.raises(ValueError):
        Selector("a[")


def test_nested_blocks_and_first_matches():
    html = "<div class='box a'><p>1</p><div class='a box'><p>2</p><p>3</p></div><p>4</p></div><p>5</p>"
    assert found(html, "div.box", p=("p", "text"), deep=("div p", "text"), all=("", "text")) == [["1", "1", "1234"], ["2", "2", "23"]]
    assert found(html, "div.box.a div", all=("", "text")) == [["23"]] and found(html, ".none", x=("", "text")) == []
    assert found(html, "p", em=("em", "text")) == [[None]] * 5


def test_elements_without_end_tags():
    assert found("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "li", t=("", "text")) == [["a"], ["bc"], ["c"], ["d"]]
    assert found("<p>a<p>b<div>c</div>d", "p", t=("", "text")) == [["a"], ["b"]]
    assert found("<table><tr><td>1<td>2<tr><td>3</table>", "td", t=("", "text")) == [["1"], ["2"], ["3"]]
    assert found("<div><span>a</div>b</span></i>", "div", t=("", "text")) == [["a"]]
    assert found("a<br>b<img src='>'>c<input/>d", "img", s=("", "src")) == [[">"]]


def test_text_that_is_no_markup():
    html = "<!-- <p>no</p> --><script>'<p>no</p>'</script><STYLE><p></STYLE ><textarea><p>x</textarea><p>3 < 4 &amp; 5<7</p><p title='it's>odd</p><p"
    assert found(html, "p", t=("", "text"))[0] == ["3 < 4 & 5<7"]
    assert found(html, "textarea", t=("", "text")) == [["<p>x"]]
    assert parse("")[0] == [] and parse("<")[1] == ["<"] and parse("<!-- open <p>")[0] == []


def test_long_pages_take_time_in_proportion():
    def seconds(n):
        page = "<div class='x'>" * n + "<a href='y'>z</a>\" '" * n + "</p>" * n
        started = time.process_time()
        parse(page)
        return time.process_time() - started

    seconds(1000)
    assert seconds(40_000) < 12 * max(seconds(10_000), 0.02)


def test_rows_per_element(spark, rows):
    pages = spark.createDataFrame([(1, "a", "<ul><LI class='k'>x</LI><li>y</li></ul>"), (2, "b", None), (3, "c", "no tags"), (1, "a", "<li>again")], "id int, more string, page string")
    got = select_elements(pages, ["more", "id"], "page", "li", {"text": ("", "text"), "class": ("", "class")}, "nth")
    assert got.columns == ["more", "id", "nth", "text", "class"]
    assert rows(got) == [("a", 1, 0, "again", None), ("a", 1, 0, "x", "k"), ("a", 1, 1, "y", None)]
    assert select_elements(pages.limit(0), ["id"], "page", "li", {"text": ("", "text")}).collect() == []
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_real_titles_and_links(spark, rows):
    pages = spark.createDataFrame([(1, "<HTML><TITLE lang='en'>One &amp; two</TITLE ><a\nclass=x HREF='x'>1</a><A href=y>2</A><a href=\"z\">3</a>")], "page_id int, html string")
    assert [r[0] for r in pages.select(documents.page_title(F.col("html"))).collect()] == ["One & two"]
    assert rows(documents.page_links(pages, "page_id", "html")) == [(1, 0, "x"), (1, 1, "y"), (1, 2, "z")]
