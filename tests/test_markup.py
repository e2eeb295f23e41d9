"""Text and attributes of random markup against the standard library's parser."""

import html as stdlib
import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from ringledger.functions import html

WORDS = ["Ann", "O'Neil", "é", "3 < 4", "a > b", "R&R", "&amp;", "&eacute;", "&nbsp;", "&#39;", "&#x20AC;", "&quot;x&quot;", "&#150;"]
BLANKS = ["", " ", "\n", "\t ", "\xa0"]


class Nodes(HTMLParser):
    """Runs of text between tags, and the links met."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.nodes, self.links = [""], []

    def handle_starttag(self, tag, attrs):
        self.nodes.append("")
        if tag == "a":
            self.links.append(dict(attrs).get("href"))

    def handle_endtag(self, tag):
        self.nodes.append("")

    def handle_data(self, data):
        self.nodes[-1] += data

    def handle_entityref(self, name):
        known = stdlib.unescape(f"&{name};")
        self.nodes[-1] += f"&{name}" if known.startswith("&") and name != "amp" else known

    def handle_charref(self, name):
        self.nodes[-1] += stdlib.unescape(f"&#{name};")


def fragment(r, depth=0):
    out = ""
    for _ in range(r.randrange(4)):
        out += r.choice(BLANKS) + r.choice(WORDS) + r.choice(BLANKS)
        if depth < 2 and r.random() < 0.5:
            tag = r.choice(["b", "i", "span", "a"])
            quote = r.choice(['"', "'"])
            attrs = r.choice(["", f" class={quote}x y{quote}", f" title={quote}1 > 0{quote}", " id=k"])
            if tag == "a":
                attrs += r.choice(["", f" href={quote}/p?a=1&amp;b={r.randrange(9)}{quote}"])
            out += f"<{tag}{attrs}>{fragment(r, depth + 1)}</{tag}>"
        out += r.choice(["", "<br>", '<img src="/x.png">'])
    return out


def test_text_of_random_markup(spark):
    r = random.Random(7)
    pages = [f"<div>{fragment(r)}</div>" for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    link = html.attribute(html.first(F.col("html"), "a"), "href")
    got = df.select("i", html.text(F.col("html")), html.tight_text(F.col("html")), link).collect()
    for i, text, tight, href in got:
        parser = Nodes()
        parser.feed(pages[i])
        parser.close()
        assert text == "".join(parser.nodes).strip(), pages[i]
        assert tight == "".join(n.strip() for n in parser.nodes), pages[i]
        assert href == (parser.links[0] if parser.links else None), pages[i]


def test_elements_of_random_rows(spark):
    """Cells without inner cells: all of them, and those of one class."""
    r = random.Random(8)
    rows, expected = [], []
    for _ in range(200):
        cells = [(r.choice(["c", "c d", "dc", "", "e c"]), fragment(r, 1)) for _ in range(r.randrange(8))]
        rows.append("<tr>" + "".join(f'<td class="{c}">{t}</td>' for c, t in cells) + "</tr>")
        expected.append((len(cells), sum("c" in c.split() for c, _ in cells), sum(c == "c d" for c, _ in cells)))
    df = spark.createDataFrame(list(enumerate(rows)), "i int, html string")
    sizes = [F.size(html.elements(F.col("html"), "td", cls)) for cls in (None, "c", "c d")]
    assert [tuple(x)[1:] for x in df.select("i", *sizes).orderBy("i").collect()] == expected


HOLDERS = {"td": {"table"}, "th": {"table"}, "tr": {"table"}, "li": {"ul", "ol"}, "p": {"table", "td", "th", "li"}}
ENDED_BY = {"td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "li": {"li"}}
CLOSES_P = {"p", "ul", "ol", "table", "div", "li", "td", "th", "tr"}


class Tree(HTMLParser):
    """A tree with the end tags that HTML lets a page leave out; nodes are [tag, children], text nodes are texts."""

    def __init__(self):
        super().__init__()
        self.stack = [["root", []]]

    def _end(self, tags, within):
        """Close the innermost open element of the tags, unless a holder is nearer."""
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] in tags:
                del self.stack[k:]
                return
            if self.stack[k][0] in within:
                return

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._end({"p"}, HOLDERS["p"])
        if tag == "tr":
            self._end({"tr"}, {"table"})
        elif tag in ENDED_BY:
            self._end(ENDED_BY[tag] - {"tr"}, HOLDERS[tag])
        node = [tag, []]
        self.stack[-1][1].append(node)
        if tag not in ("br", "img"):
            self.stack.append(node)

    def handle_endtag(self, tag):
        self._end({tag}, HOLDERS.get(tag, set()) - {tag})

    def handle_data(self, data):
        self.stack[-1][1].append(data)


def words_of(node):
    return node if isinstance(node, str) else "".join(map(words_of, node[1]))


def outermost(node, tag):
    for child in node[1]:
        if not isinstance(child, str):
            if child[0] == tag:
                yield child
            else:
                yield from outermost(child, tag)


def sloppy(r, depth=0):
    """Text, paragraphs, lists and tables, with closing tags left out where HTML lets a page do so."""

    def end(tag):
        return r.choice(["", f"</{tag}>", f"</{tag.upper()} >"])

    out = ""
    for _ in range(r.randrange(1, 4)):
        kind = r.randrange(5 if depth < 3 else 2)
        word = f"w{r.randrange(100)} "
        if kind == 0:
            out += word + r.choice(["", "<br>", "<b>x</b>", '<img src="/i.png">'])
        elif kind in (1, 2):
            out += f"<p class=c>{word}<i>{word}</i>{end('p')}"
        elif kind == 3:
            items = "".join(f"<li>{word}{sloppy(r, depth + 1)}{end('li')}" for _ in range(r.randrange(1, 4)))
            name = r.choice(["ul", "ol"])
            out += f"<{name}>{items}</{name}>"
        else:
            lines = ""
            for _ in range(r.randrange(1, 3)):
                cell = r.choice(["td", "td", "th"])
                cells = "".join(f"<{cell}>{word}{sloppy(r, depth + 1)}{end(cell)}" for _ in range(r.randrange(1, 4)))
                lines += f"<tr>{cells}{end('tr')}"
            out += f"<table>{lines}</table>"
    return out


def test_elements_of_pages_without_closing_tags(spark):
    r = random.Random(11)
    pages = [f"<div>{sloppy(r)}</div>" for _ in range(500)]
    tags = ["td", "tr", "li", "p", "table", "ul"]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    found = df.select("i", *[F.transform(html.elements(F.col("html"), t), html.text).alias(t) for t in tags]).collect()
    nested = 0
    for row in found:
        tree = Tree()
        tree.feed(pages[row["i"]])
        tree.close()
        for tag in tags:
            want = [words_of(n).strip() for n in outermost(tree.stack[0], tag)]
            assert row[tag] == want, (tag, pages[row["i"]])
        nested += any(True for t in outermost(tree.stack[0], "table") for _ in outermost(t, "table"))
    assert nested > 20


def test_cells_without_closing_tags(spark):
    cases = {
        "<tr><td class=c>a<td class=c>b</tr>": ["a", "b"],
        "<tr><td class='c'>a<table><tr><td class='c'>in</table>z<td>b": ["ainz", "b"],
        "<tr><td>a</td>": ["a"],
        "<tr><td>a<tr><td>b": ["a", "b"],
        "<ul><li>x</ul><td>y</td>": ["y"],
    }
    df = spark.createDataFrame([(k,) for k in cases], "html string")
    got = df.select("html", F.transform(html.elements(F.col("html"), "td"), html.text)).collect()
    assert dict(map(tuple, got)) == cases


def test_depth_and_length(spark):
    deep = "<table><tr><td>" * 40 + "x" + "</td></tr></table>" * 40
    long = "<table>" + "<tr><td>a<td>b" * 30_000 + "</table>"
    df = spark.createDataFrame([(deep,), (long,), ("<td " * 20_000,), ("<table><td>" * 5_000,)], "html string")
    got = [r[0] for r in df.select(F.size(html.elements(F.col("html"), "td"))).collect()]
    assert got[1] == 60_000 and got[0] >= 1 and got[2] == 0


def test_lines_without_closing_tags(spark):
    cases = {
        '<tr><td class="c"><p>\n Ann <p> Bea <td class="c"> <p>1<p>2</tr>': [["Ann", "Bea"], ["1", "2"]],
        '<tr><td class="c"><p>Ann</p><p>Bea<td>no<td class="c"><p>1</p><p>2': [["Ann", "Bea"], ["1", "2"]],
        '<tr><td class="c"><p>A<div>x</div><p>B</td>': [["A", "B"]],
        '<tr><td class="c"><p>A &amp; B<p>C': [["A & B", "C"]],
    }
    df = spark.createDataFrame([(k,) for k in cases], "html string")
    got = df.select("html", html.stacked_cells(F.col("html"), "c")).collect()
    assert dict(map(tuple, got)) == cases
