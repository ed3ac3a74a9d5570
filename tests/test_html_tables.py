from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.sources import html_tables


class Plain(HTMLParser):
    """The same rows by the library's parser, with a list of open tables."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows, self.stack, self.n, self.quiet = [], [], 0, False

    def handle_starttag(self, tag, attributes):
        self.quiet = self.quiet or tag in ("script", "style")
        if tag == "table":
            self.stack.append({"number": self.n, "depth": len(self.stack), "section": None, "row": None, "cell": None, "count": 0})
            self.n += 1
        elif self.stack:
            t = self.stack[-1]
            if tag in html_tables.SECTIONS:
                t.update(section=tag, row=None, cell=None)
            elif tag == "tr" or (tag in ("td", "th") and t["row"] is None):
                t["row"] = {"table_number": t["number"], "depth": t["depth"], "section": t["section"], "row_number": t["count"], "cells": []}
                t.update(cell=None, count=t["count"] + 1)
                self.rows.append(t["row"])
            if tag in ("td", "th"):
                before = t["row"]["cells"]
                column = before[-1]["column"] + before[-1]["span"] if before else 0
                t["cell"] = {"kind": tag, "text": "", "column": column, "span": max(1, int(dict(attributes).get("colspan", 1)))}
                before.append(t["cell"])

    def handle_endtag(self, tag):
        self.quiet = self.quiet and tag not in ("script", "style")
        if tag == "table":
            self.stack = self.stack[:-1]
        elif self.stack:
            t = self.stack[-1]
            if tag in html_tables.SECTIONS:
                t.update(section=None, row=None, cell=None)
            elif tag == "tr":
                t.update(row=None, cell=None)
            elif tag in ("td", "th"):
                t["cell"] = None

    def handle_data(self, data):
        for t in self.stack:
            if t["cell"] is not None and not self.quiet:
                t["cell"]["text"] += data


def shape(rows):
    return [(r["table_number"], r["depth"], r["section"], r["row_number"], [(c["kind"], c["text"], c["column"]) for c in r["cells"]]) for r in rows]


def plain(page):
    parser = Plain()
    parser.feed(page)
    parser.close()
    return shape(parser.rows)


PIECES = [
    "<table>", "<TABLE class='a>b'>", "</table>", "<tr>", "</tr>", "<td>", "<td colspan=2>", '<td colspan="3">', "</td>", "<th>", "</th>", "<tbody>", "</tbody>",
    "<thead>", "</thead>", "text", " a &amp; b ", "<b>", "</b>", "<!-- <tr><td>no</td></tr> -->", "<script>'<td>no'</script>", "<p>", "\n", "Домаќинства",
]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40))
def test_walk_equals_a_plain_parser(pieces):
    page = "".join(pieces)
    assert shape(html_tables.walk(page)) == plain(page)


def test_open_and_odd_markup():
    page = "<table><tr><td>a<![CDATA[<tr><td>no</td></tr>]]>b<td>c<!-- never closed <tr><td>x"
    assert shape(html_tables.walk(page)) == [(0, 0, None, 0, [("td", "ab", 0), ("td", "c", 1)])]
    assert html_tables.walk("</table><td>x</td><tr>") == [] and html_tables.walk("") == []
    deep = "<table><tr><td>" * 500 + "x"
    rows = html_tables.walk(deep)
    assert len(rows) == 500 and rows[-1]["depth"] == 499 and rows[0]["cells"][0]["text"] == "x"


def test_rows_beside_their_page(spark):
    pages = spark.createDataFrame([(1, "<table><tr><td>a</td></tr><tr><td>b</td></tr></table>"), (2, None), (3, "no table")], "id int, html string")
    got = html_tables.table_rows(pages)
    assert [(r.id, r.row_number, r.cells[0].text) for r in got.orderBy("row_number").collect()] == [(1, 0, "a"), (1, 1, "b")]
    assert html_tables.table_rows(pages.filter("false")).count() == 0
    with pytest.raises(ValueError):
        html_tables.table_rows(pages.withColumnRenamed("id", "depth"))


def test_walk_makes_few_calls_per_tag():
    import cProfile
    import pstats

    page = "<table>" + "<tr><td>a</td><td class='x'>b</td><td><b>c</b></td></tr>" * 500 + "</table>"
    assert len(html_tables.walk(page)) == 500
    profile = cProfile.Profile()
    profile.runcall(html_tables.walk, page)
    assert pstats.Stats(profile).total_calls < 4 * page.count("<")
