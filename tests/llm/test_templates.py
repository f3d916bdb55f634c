"""Main text of pages whose hosts have templates of several kinds."""

import random

import pytest

from searchtide.llm import markup, templates
from tests.helpers import bag, tuples

SCHEMA = "page_id long, url string, html string"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(n))


def semantic(rng, i):
    title, parts = words(rng, 6), [words(rng, rng.randint(20, 60)) for _ in range(rng.randint(1, 6))]
    article = f"<h1>{title}</h1>" + "".join(f"<p class='t{i}'>{p}" + rng.choice(["</p>", "<br>", ""]) for p in parts)
    page = (
        f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{a:b}}</style></head><body>"
        f"<header><a href=/>Site</a></header><nav><ul><li><a href=/{i}>{words(rng, 2)}</a></ul></nav>"
        f"<div class='cookie-notice'>We use cookies {words(rng, 3)}</div><article>{article}"
        f"<div class=ad>{words(rng, 9)}</div><script>var t='</p>';</script></article>"
        f"<section class=comments><article class=comment><p>{words(rng, 40)}</p></article></section>"
        f"<form><label>{words(rng, 3)}</label><input name=q></form><footer>&copy; {words(rng, 8)}</footer>"
    )
    return page, "\n".join([title, *parts])


def plain(rng, i):
    """No element says what is what: the template alone does."""
    title, parts = words(rng, 6), [words(rng, rng.randint(20, 60)) for _ in range(rng.randint(2, 6))]
    links = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in words(rng, 30).split())
    body = "".join(f"<p>{p}</p>" for p in parts)
    page = (
        f"<html><body><div class=q1><b>Big Site</b> of everything</div><div class=q2><ul>{links}</ul></div>"
        f"<div class=q3><div class=q4><h1>{title}</h1>{body}<div class=q5>Thank you for reading us today</div></div></div>"
        f"<div class=q6>{words(rng, 6)}</div><div class=q7>All rights reserved</div></body></html>"
    )
    return page, "\n".join([title, *parts])


@pytest.fixture(scope="module")
def crawl():
    rng = random.Random(4)
    rows, wanted = [], {}
    for i in range(120):
        make, host = (semantic, "a.example.org") if i % 3 else (plain, "b.example.org")
        page, wanted[i] = make(rng, i)
        rows.append((i, f"http://{host}/{i}", page))
    return rows, wanted


@pytest.fixture(scope="module")
def pages(spark, crawl):
    return spark.createDataFrame(crawl[0], SCHEMA).repartition(6).cache()


def test_article_of_every_page(pages, crawl):
    found = {r["page_id"]: (r["text"], r["n_chars"]) for r in templates.digest(pages).collect()}
    assert found == {i: (text, len(text)) for i, text in crawl[1].items()}


def test_salted_join_gives_the_same(pages, monkeypatch):
    wanted = bag(templates.digest(pages))
    monkeypatch.setattr(templates, "BROADCAST", 0)
    assert bag(templates.digest(pages)) == wanted


def test_template_of_a_host(spark, pages):
    sequences = templates._sequences(pages.selectExpr("'b' AS host", "html").where("page_id % 3 = 0"))
    rows = templates.host_templates(sequences).collect()
    outer = [r for r in rows if r["share"] == 1.0 and r["parent"] == 0]
    assert len(outer) == 1 and outer[0]["n_pages"] == 40
    text = markup.parse("<html><body><div class=q7>All rights reserved</div>").tokens[-1]
    assert text in outer[0]["numbers"]
    # Items of the list share a vector and sit after the list's tag in the outer class.
    inner = [r for r in rows if r["parent"] == outer[0]["class"]]
    for row in inner:
        assert row["gap"] in outer[0]["numbers"]
    sets = [set(r["numbers"]) for r in rows]
    assert sum(map(len, sets)) == len(set().union(*sets))


def test_classes_equal_those_of_whole_vectors(spark, crawl):
    """The sums of hashes make the classes that the vectors themselves make."""
    texts = [page for i, _, page in crawl[0] if i % 3 == 0]
    vectors = {}
    for at, page in enumerate(texts):
        for number in markup.parse(page).tokens:
            vectors.setdefault(number, [0] * len(texts))[at] += 1
    groups = {}
    for number, vector in vectors.items():
        if sum(map(bool, vector)) >= len(texts) / 2:
            groups.setdefault(tuple(vector), set()).add(number)
    wanted = sorted(sorted(g) for g in groups.values() if len(g) > 1)
    rows = [("h", page) for page in texts] * 2  # repeated pages count once
    sequences = templates._sequences(spark.createDataFrame(rows, "host string, html string"))
    assert sorted(r["numbers"] for r in templates._classes(sequences).collect()) == wanted


def test_unsteady_order_is_no_class():
    places = {1: (1, 0, 0), 2: (1, 1, 1), 3: (1, 2, 2)}
    turned = {1: (1, 0, 0), 2: (1, 2, 2), 3: (1, 1, 1)}
    classes = [(7, 1.0, [1, 2, 3])]
    assert templates._placed(places, classes)[0][1] != templates._placed(turned, classes)[0][1]
    mixed = {1: (2, 0, 2), 2: (2, 3, 4)}
    assert templates._placed(mixed, [(7, 1.0, [1, 2])])[0][1] is None


def test_copies_do_not_make_an_article_a_template(spark):
    page, wanted = semantic(random.Random(1), 1)
    rows = [(i, "http://c.example.org/", page) for i in range(50)]
    found = templates.digest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["text"] for r in found} == {wanted} and len(found) == 50


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("just text", "just text"),
        ("a &lt;b&gt; &amp;amp; &#233;&nbsp;x &eacute &unknown; 1 < 2", "a <b> &amp; é x é &unknown; 1 < 2"),
        ("<article><p>one <b>two</b>\n\tthree<p>four<br>five</article>", "one two three\nfour five"),
        ("<article><p>x<script>y</script>z</p><!-- c <p>d</p> --></article>", "xz"),
        ("<article><h2>t</h2><ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "t\na\nb\nc\nd"),
        ("<form id=page><div><article><p>in a form</p></article></div></form>", "in a form"),
        ("<body class='has-sidebar'><div class='with-ads'><main>m</main></div><aside>s</aside>", "m"),
        ("<main><article><p>a</p></article><section id=comments>c</section></main>", "a"),
        ("<article><header><h1>t</h1></header><p>a</p><footer>f</footer></article>", "t\na"),
        ("<article>a<p class=\"x", "a"),
        ("<p title='a > b' data-x=\"it's\">q</p><style>x", "q"),
        ("<ARTICLE><P>Up</P></ARTICLE><FOOTER>f</FOOTER>", "Up"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
        ("<article><p>" + "<b>x " * 3000 + "</article>", " ".join("x" * 3000)),
    ],
)
def test_single_pages(page, text):
    assert templates.main_text(page, set(), None) == text


def test_odd_rows_and_clashing_columns(spark):
    rows = [
        (1, None, "<article>a</article>"), (1, None, "<article>a</article>"), (None, "http://x/", None),
        (2, "", ""), (3, "http://x/", "<p>" + "word " * 100_000),
    ]
    table = spark.createDataFrame(rows, SCHEMA)
    found = tuples(templates.digest(table))
    assert sorted((r[0] or 0, r[3]) for r in found) == [(0, 0), (1, 1), (1, 1), (2, 0), (3, 499_999)]
    names = ["text", "n_chars", "host", "fixed", "main", "part", "class", "found_text", "numbers"]
    more = table.selectExpr("*", *[f"'own' AS `{n}`" for n in names])
    kept = templates.extracted(more)
    assert sorted(kept.columns) == sorted([*more.columns])
    assert bag(kept, "page_id", "url", "text", "n_chars") == bag(templates.digest(table))
    assert {r["host"] for r in kept.collect()} == {"own"}
    assert not tuples(templates.digest(table.limit(0)))
