import random
import re
from functools import cache

import pytest

from ratelake.llm.html_tree import parse
from ratelake.llm.html_wrapper import TreeMatch, _block_nodes, _matched, blocks, extract, induce, main_texts, sizes

PAGES = "page_id long, url string, html string"


def texts(spark, pages):
    rows = [(i, "http://h.example/x", p) for i, p in enumerate(pages)]
    got = main_texts(spark.createDataFrame(rows, PAGES)).collect()
    return [r.text for r in sorted(got, key=lambda r: r.page_id)]


def page(i, body, shell="article"):
    return (
        f"<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style><script>var t='</p><article>';</script></head><body>"
        f"<nav><ul><li><a href='/{i}'>Link {i}</a></li><li>Home</ul></nav><!-- <article>no</article> --><div class='ad'>Buy {i}</div>"
        f"{body if shell is None else f'<{shell}>{body}</{shell.split()[0]}>'}<aside>Side {i}</aside><footer>&copy; host {i}</footer></body></html>"
    )


#: Every block differs from page to page: what is alike on all pages of a host is template.
BODY = "<h1>Head &amp; {i}</h1><p>One {i}\n two<b>bold</b> <i>x</i><br>next &lt;tag&gt; caf&eacute; &#233;<p><b>open {i}<p>last {i}<form><input>name</form><script>x</script>"
TEXT = "Head & {i} One {i} twobold x next <tag> café é open {i} last {i}"


@pytest.mark.parametrize("shell", ["article", "main", "div id=content", "div class='post-body'"])
def test_main_text(spark, shell):
    rows = [(i, f"http://h.example/{i}", page(i, BODY.format(i=i), shell)) for i in range(6)]
    got = {r.page_id: (r.text, r.n_chars) for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: (TEXT.format(i=i), len(TEXT.format(i=i))) for i in range(6)}


def test_slots_and_template_of_a_plain_page():
    pages = [page(i, f"<div><div class='x'>All rights and the same</div><div><p>Story number {i} " + "with its own long text " * (i + 5) + "</p></div></div>", None) for i in range(3)]
    wrapper = induce([parse(p) for p in pages])
    # The box, and Home in the menu.
    assert len(wrapper.template) == 2
    assert [extract(parse(p), wrapper)[:14] for p in pages] == [f"Story number {i}" for i in range(3)]


@pytest.mark.parametrize("shell", ["article", "main", "div class=content", "div"])
@pytest.mark.parametrize("paragraphs", [5, 500])
def test_constant_box_goes_wherever_it_is(spark, shell, paragraphs):
    """A box without a telling name, behind another number of paragraphs on each page; what varies stays."""
    box = "<div class='k7'><p>Join our club today</p><p>Members pay less</p></div>"

    def body(i):
        told = [f"Story {i} line {j} of this page" for j in range(paragraphs + i % 4)]
        return "".join(f"<p>{t}</p>" for t in told[:-2]) + box + "".join(f"<p>{t}</p>" for t in told[-2:]), " ".join(told)

    made = [body(i) for i in range(7)]
    assert texts(spark, [page(i, b, shell) for i, (b, _) in enumerate(made)]) == [t for _, t in made]


def test_what_only_the_aligned_pages_share_stays(spark):
    """Four pages with a line in common among twenty of the host: whichever are aligned, it is no template."""
    pages = [page(i, f"<p>Page {i} tells of {i * 7}</p>" + ("<p>Shared by a few</p>" if i < 4 else f"<p>Own {i}</p>"), "article") for i in range(20)]
    got = texts(spark, pages)
    assert [t.endswith("Shared by a few") for t in got] == [i < 4 for i in range(20)]


def test_one_wrapper_for_a_host_with_most_pages(spark):
    box = "<div><b>Buy one get one</b></div>"
    rows = [(i, f"http://{'big' if i % 3 else i % 7}.example/{i}", page(i, f"<p>Text {i} here</p>{box}", "article")) for i in range(300)]
    rows += [(i, "http://big.example/copy", page(1, f"<p>Text 1 here</p>{box}", "article")) for i in range(300, 330)]
    got = {r.page_id: r.text for r in main_texts(spark.createDataFrame(rows, PAGES).repartition(5)).collect()}
    assert got == {i: f"Text {1 if i >= 300 else i} here" for i, _, _ in rows}


def test_deep_pages_of_one_host(spark):
    pages = ["<div>" * (1500 + i) + f"deep {i}" + "</div>" * (1500 + i) for i in range(20)]
    assert texts(spark, pages) == [f"deep {i}" for i in range(20)]


def random_tree(draw, depth=0):
    tag = draw.choice(["div", "p", "ul", "section"])
    inner = "".join(random_tree(draw, depth + 1) for _ in range(draw.randint(0, 4 - depth))) if depth < 4 and tag != "p" else ""
    return f"<{tag}>{draw.choice(['', 'x', 'y'])}{inner}</{tag}>"


def test_tree_match_is_the_largest_that_keeps_order():
    """Against the plain recursion over all ways to pair two lists."""

    def size(x, y):
        return 0 if x.key != y.key else 1 + lists(tuple(_matched(x)), tuple(_matched(y)))

    @cache
    def lists(a, b):
        if not a or not b:
            return 0
        return max(lists(a[1:], b), lists(a, b[1:]), size(a[0], b[0]) and size(a[0], b[0]) + lists(a[1:], b[1:]))

    draw = random.Random(3)
    for _ in range(150):
        a, b = (parse("".join(random_tree(draw) for _ in range(draw.randint(0, 4)))) for _ in range(2))
        match = TreeMatch(a, b)
        pairs = match.pairs()
        assert len(pairs) == match.size() == lists(tuple(_matched(a)), tuple(_matched(b)))
        assert len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == len(pairs)
        assert all(x.key == y.key for x, y in pairs)


def test_comments_and_notices_go():
    body = "<h2>A</h2><div class='cookie-notice'>we use</div><p>b</p><section id='comments'><p>reader says</p></section><div class='share'>share</div>"
    tree = parse(page(1, body))
    assert extract(tree, induce([tree])) == "A b"


def test_tree_match_keeps_order():
    a, b = parse("<div><p>1</p><ul><li>x</ul><p>2</p></div>"), parse("<div><ul><li>y</ul><p>3</p></div>")
    assert sorted(x.tag for x, _ in TreeMatch(a, b).pairs()) == ["div", "li", "p", "ul"]


def test_copies_of_one_page_keep_their_text(spark):
    rows = [(i, f"//h/{i}", page(1, BODY.format(i=1))) for i in range(9)]
    assert {r.text for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()} == {TEXT.format(i=1)}


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    long = "<article>" + "<p>word &amp; more</p>" * 20_000 + "</article>"
    cases = [None, "", "just text", "<p>a<p>b", "<", "<article", deep, long, "<article></article>", "<table><tr><td>a<td>b</table>", "</p></div>x", "<script>never closed", "<p title='a>b'>c"]
    rows = [(i, None if i % 2 else f"http://h{i % 3}/", c, "x", 5) for i, c in enumerate(cases)] + [(None, None, "<p>n", "y", 6), (3, None, "<p>a<p>b", "z", 7)]
    got = main_texts(spark.createDataFrame(rows, "page_id long, url string, html string, host string, salt int")).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert [text[i] for i in (0, 1, 2, 3, 6, 8, 9, 10, 11, 12)] == ["", "", "just text", "a b", "deep", "", "a b", "x", "", "c"]
    assert text[7] == " ".join(["word & more"] * 20_000) and not re.search(r"\s\s", text[7])
    assert main_texts(spark.createDataFrame(rows, "page_id long, url string, html string, host string, salt int").limit(0)).count() == 0


def test_a_node_on_half_of_the_pages_is_template_wherever_it_is(spark):
    """A box on two pages of three, at any place among the paragraphs: whichever pages are aligned, it goes from all."""
    draw = random.Random(11)
    made = []
    for i in range(30):
        told = [f"Story {i} line {j} of this page" for j in range(3 + i % 5)]
        body = [f"<p>{t}</p>" for t in told]
        if i % 3:
            body.insert(draw.randint(0, len(body)), "<div><p>Join our club today</p></div>")
        made.append(("".join(body), " ".join(told)))
    assert texts(spark, [page(i, b) for i, (b, _) in enumerate(made)]) == [t for _, t in made]


def test_template_is_counted_over_all_pages_of_a_large_host(spark):
    """Against plain counts: lines on 150 and on 149 of 300 distinct pages, more than one part; copies count once."""
    pages = [page(i, f"<p>Own {i}</p>" + ("<p>Half</p>" if i % 2 else "") + ("<p>Less</p>" if i % 2 and i > 1 else "")) for i in range(300)]
    rows = [(i, "http://h.example/x", p) for i, p in enumerate(pages)] + [(300 + i, "http://h.example/x", pages[3]) for i in range(50)]
    got = {r.page_id: r.text for r in main_texts(spark.createDataFrame(rows, PAGES).repartition(4)).collect()}
    want = {i: f"Own {i}" + (" Less" if i % 2 and i > 1 else "") for i in range(300)}
    assert got == want | {300 + i: "Own 3 Less" for i in range(50)}


@pytest.mark.parametrize("order", range(3))
def test_main_slot_is_that_of_most_pages(spark, order):
    """Some pages have another layout; whichever hash is smallest, the host's main slot is that of the many."""

    def many(i):
        return f"<div class=a><p>Number {order}{i}</p></div><div class=b><p>Story {order}{i} " + "that goes on and on " * (5 + i) + "</p></div>"

    odd = [f"<div class=a><p>Contents {order}{i} " + "with a long list of titles " * (i + 20) + "</p></div>" for i in range(6)]
    pages = [f"<body>{b}</body>" for b in [many(i) for i in range(14)] + odd]
    got = texts(spark, pages)
    assert all(t.startswith(f"Story {order}{i} ") for i, t in enumerate(got[:14]))
    assert all(t.startswith("Contents") for t in got[14:])


def test_sizes_are_those_of_blocks():
    draw = random.Random(7)
    tags = ["div", "p", "ul", "span", "b", "nav", "article", "div class=ad", "br", "aside"]

    def tree(depth=0):
        tag = draw.choice(tags)
        inner = "".join(draw.choice(["", " a ", "bc\n"]) + tree(depth + 1) for _ in range(draw.randint(0, 5 - depth))) if depth < 5 else ""
        return f"<{tag}>{draw.choice(['', ' x', 'y  z '])}{inner}</{tag.split()[0]}>"

    for _ in range(200):
        root = parse("".join(tree() for _ in range(4)))
        found = sizes(root)
        assert all(found.get(id(n), 0) == sum(map(len, blocks(n))) for n in [root, *_block_nodes(root)])
