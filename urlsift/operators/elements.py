"""Pages to elements: the one step that needs a real tokenizer.

The scan keeps the open elements as a tree parser does: a start tag ends innermost elements whose end tag may be left out, and an
end tag closes what it may reach through, or nothing. ``scan_pages`` reads each page once in Arrow batches and adds, next to the
columns passed through, the title, the visible text, the footer text and the
elements that any page feature looks at. The elements stay an array on the
page's own row, so no feature needs a shuffle. ``page_elements`` gives the
exploded table.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ELEMENT = T.StructType(
    [
        T.StructField("tag", T.StringType()),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("text", T.StringType()),
        T.StructField("in_form", T.BooleanType()),
    ]
)
SCAN_FIELDS = [
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("footer", T.StringType()),
    T.StructField("elements", T.ArrayType(ELEMENT)),
]
_ARROW_ELEMENTS = pa.list_(
    pa.struct(
        [
            ("tag", pa.string()), ("attrs", pa.map_(pa.string(), pa.string())),
            ("text", pa.string()), ("in_form", pa.bool_()),
        ]
    )
)

# elements and attributes the page features read
READ_TAGS = frozenset(
    "link meta style script iframe frame form input button a img source".split()
)
READ_ATTRS = frozenset("rel href name property content http-equiv src action type".split())
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
HIDDEN_TEXT = frozenset("script style template rt rp".split())

# The markup's rules for tags that may be left out. An open element in the first column ends where one of the
# tags in the second begins, if it is the innermost one.
_BLOCKS = "address blockquote center dir div dl dt dd fieldset form h1 h2 h3 h4 h5 h6 hr li listing menu ol pre table tbody td tfoot th tr ul xmp"
_CELLS = "td th tr tbody tfoot"
ENDED_BY = {
    open_tag: frozenset(starts.split())
    for open_tags, starts in (
        ("p", f"{_BLOCKS} p body caption col colgroup frameset head title"),
        ("head", f"{_BLOCKS} a abbr b big body br cite code em font frameset i iframe img kbd map p q s samp small span strike strong sub sup tt u"),
        ("h1 h2 h3 h4 h5 h6", "fieldset form li p table"),
        ("b big i s small strike tt u", "p"),
        ("b font i u", "center td th"),
        ("span", "td th"),
        ("a", "a fieldset table td th"),
        ("li", "li"),
        ("dt", "dd dl"),
        ("dd", "dt"),
        ("option", "option optgroup"),
        ("ul ol", "form"),
        ("dl", "form ul"),
        ("hr form", "form"),
        ("caption colgroup col", "col colgroup tbody tfoot thead tr"),
        ("thead tbody", "tbody tfoot"),
        ("tfoot", "tbody"),
        ("tr", "tr tbody tfoot"),
        ("td th", _CELLS),
        ("style link title", "body frameset"),
        ("script", "noscript"),
    )
    for open_tag in open_tags.split()
}
for _tag in "b i u".split():
    ENDED_BY[_tag] |= frozenset(("p", "center", "td", "th"))
# An end tag reaches through open elements of at most its own rank; others have rank 100.
RANK = {"div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180, "tfoot": 180, "table": 190, "head": 200}
# These end with the page, wherever their end tag stands.
WITH_PAGE = frozenset(("body", "html"))


class _PageScan(HTMLParser):
    def __init__(self, everything: bool):
        super().__init__(convert_charrefs=True)
        self.everything = everything
        self.rows, self.texts, self.footers, self.titles = [], [], [], []
        self.stack, self.depth, self.pending = [], {}, []
        self.parents, self.open_rows = [], []
        self.title_state = 0  # 0 none seen, 1 inside the first, 2 done
        self.raw = None

    def flush(self):
        if not self.pending:
            return
        piece = "".join(self.pending).strip()
        self.pending = []
        if not piece:
            return
        if self.title_state == 1:
            self.titles.append(piece)
        if not any(self.depth.get(t) for t in HIDDEN_TEXT):
            self.texts.append(piece)
            if self.depth.get("footer"):
                self.footers.append(piece)

    def handle_starttag(self, tag, attrs):
        self.flush()
        kept = {}
        for name, value in attrs:
            if self.everything or name in READ_ATTRS or name.startswith("on"):
                kept.setdefault(name, value or "")
        while self.stack and tag in ENDED_BY.get(self.stack[-1], ()):
            self.pop()
        handlers = any(n.startswith("on") for n in kept)
        if self.everything or tag in READ_TAGS or handlers:
            row = [tag, list(kept.items()), None, bool(self.depth.get("form"))]
            self.rows.append(row)
            if self.everything:
                self.parents.append((self.open_rows[-1] if self.open_rows else None, len(self.stack)))
            if tag in ("script", "style"):
                row[2], self.raw = "", row
        if tag == "title" and self.title_state == 0:
            self.title_state = 1
        if tag not in VOID_TAGS:
            self.stack.append(tag)
            self.open_rows.append(len(self.rows) - 1)
            self.depth[tag] = self.depth.get(tag, 0) + 1

    def pop(self):
        top = self.stack.pop()
        self.open_rows.pop()
        self.depth[top] -= 1
        return top

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS and tag in ("script", "style", "title", "iframe"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.flush()
        if tag == "title" and self.title_state == 1:
            self.title_state = 2
        if tag in ("script", "style"):
            self.raw = None
        if not self.depth.get(tag) or tag in WITH_PAGE:
            return
        rank = RANK.get(tag, 100)
        for open_tag in reversed(self.stack):
            if open_tag == tag:
                break
            if open_tag in WITH_PAGE or RANK.get(open_tag, 100) > rank:
                return
        while self.pop() != tag:
            pass

    def handle_data(self, data):
        if self.raw is not None:
            self.raw[2] += data
        else:
            self.pending.append(data)

    def handle_comment(self, data):
        self.flush()

    def parse_marked_section(self, i, report=1):
        """A declaration in brackets that isn't known ends at the next ">", as in a browser."""
        if self.rawdata.startswith("<![CDATA[", i):
            return super().parse_marked_section(i, report)
        return self.parse_bogus_comment(i)


def _scanned(html: str, everything: bool) -> _PageScan:
    scan = _PageScan(everything)
    rest = html
    while rest:
        try:
            scan.feed(rest)
            scan.close()
            break
        except (AssertionError, ValueError, IndexError):
            # go on behind the character at which the parser gave up
            line, column = scan.getpos()
            lines = rest.split("\n")
            rest = rest[sum(len(x) + 1 for x in lines[: line - 1]) + column + 1 :]
            HTMLParser.reset(scan)
    scan.flush()
    return scan


def scan_html(html: str, everything: bool = False) -> dict:
    """Scan one page; malformed markup never raises."""
    scan = _scanned(html, everything)
    return {
        "title": "".join(scan.titles) or None,
        "text": " ".join(scan.texts),
        "footer": " ".join(scan.footers),
        "elements": [
            {"tag": t, "attrs": a, "text": x, "in_form": f} for t, a, x, f in scan.rows
        ],
    }


def _scanner(html_col: str, everything: bool, rows_per_batch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for start in range(0, big.num_rows, rows_per_batch):
                batch = big.slice(start, rows_per_batch)
                at = batch.schema.get_field_index(html_col)
                found = [
                    scan_html(h, everything) if h else
                    {"title": None, "text": None, "footer": None, "elements": None}
                    for h in batch.column(at).to_pylist()
                ]
                names = [n for n in batch.schema.names if n != html_col]
                cols = [batch.column(batch.schema.get_field_index(n)) for n in names]
                for field in ("title", "text", "footer"):
                    cols.append(pa.array([r[field] for r in found], pa.string()))
                cols.append(pa.array([r["elements"] for r in found], _ARROW_ELEMENTS))
                yield pa.RecordBatch.from_arrays(
                    cols, names=[*names, "title", "text", "footer", "elements"]
                )

    return run


def scan_pages(df: DataFrame, html: str = "html", everything: bool = False,
               rows_per_batch: int = 256) -> DataFrame:
    """Replace the page text by its title, text, footer text and elements."""
    kept = [f for f in df.schema.fields if f.name != html]
    return df.mapInArrow(
        _scanner(html, everything, rows_per_batch), T.StructType(kept + SCAN_FIELDS)
    )


def page_elements(df: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per start tag: key, position, tag, attributes, raw text, inside a form."""
    scanned = scan_pages(df.select(key, html), html, everything=True)
    return scanned.select(key, F.posexplode("elements").alias("seq", "e")).select(key, "seq", "e.*")


_TREE = pa.list_(pa.struct([("tag", pa.string()), ("name", pa.string()), ("parent", pa.int32()), ("depth", pa.int32()), ("in_form", pa.bool_())]))


def page_tree(df: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per element: key, seq, tag, its ``name`` attribute, parent (the seq of the element around it; NULL at the top), depth (number of
    elements around it) and whether a form is around it. NULL and empty pages have no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for start in range(0, big.num_rows, 64):
                batch = big.slice(start, 64)
                trees = []
                for text in batch.column(1).to_pylist():
                    scan = _scanned(text or "", True)
                    trees.append([
                        {"tag": tag, "name": dict(attrs).get("name"), "parent": parent, "depth": depth, "in_form": in_form}
                        for (tag, attrs, _, in_form), (parent, depth) in zip(scan.rows, scan.parents, strict=True)
                    ])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(trees, _TREE)], names=[key, "tree"])

    node = "array<struct<tag: string, name: string, parent: int, depth: int, in_form: boolean>>"
    fields = [df.schema[key], T.StructField("tree", T._parse_datatype_string(node))]
    trees = df.select(key, html).mapInArrow(run, T.StructType(fields))
    return trees.select(key, F.posexplode("tree").alias("seq", "e")).select(key, "seq", "e.*")
