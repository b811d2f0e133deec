"""Scopes of unclosed and misnested elements."""

import pytest

from urlsift.operators.elements import _scanned, page_tree, scan_html


def tree(html):
    scan = _scanned(html, True)
    return [(row[0], parent, row[3]) for row, (parent, _) in zip(scan.rows, scan.parents, strict=True)]


@pytest.mark.parametrize(("html", "want"), [
    ("<p>a<p>b", [("p", None, False), ("p", None, False)]),
    ("<p><b>a<p>b", [("p", None, False), ("b", 0, False), ("p", None, False)]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", [("ul", None, False), ("li", 0, False), ("li", 0, False), ("ul", 2, False), ("li", 3, False), ("li", 0, False)]),
    ("<table><tr><td>a<td>b<tr><td>c</table><i>", [("table", None, False), ("tr", 0, False), ("td", 1, False), ("td", 1, False), ("tr", 0, False), ("td", 4, False), ("i", None, False)]),
    ("<form><div></form><input></div></form><input>", [("form", None, False), ("div", 0, True), ("input", 1, True), ("input", None, False)]),
    ("<form><form><input>", [("form", None, False), ("form", None, False), ("input", 1, True)]),
    ("<form><i><form><input>", [("form", None, False), ("i", 0, True), ("form", 1, True), ("input", 2, True)]),
    ("<dl><dt>a<dd>b<dt>c</dl>", [("dl", None, False), ("dt", 0, False), ("dd", 0, False), ("dt", 0, False)]),
    ("<html><body><p></body></html><div>", [("html", None, False), ("body", 0, False), ("p", 1, False), ("div", 1, False)]),
    ("</p></div><br></br><img>", [("br", None, False), ("img", None, False)]),
])
def test_trees(html, want):
    assert tree(html) == want


def test_footer_scopes():
    assert scan_html("<div><footer>a<b>b</div>c<footer>d</p>e</footer>f")["footer"] == "a b d e"
    assert scan_html("<footer><div>a</footer>b</div>c</footer>d")["footer"] == "a b c"


def test_tree_of_missing_pages(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "text"), (4, "<P NAME=x><p>")], "page_id long, html string")
    assert [(r.page_id, r.seq, r.tag, r.name, r.parent) for r in page_tree(rows).collect()] == [(4, 0, "p", "x", None), (4, 1, "p", None, None)]
