"""What belongs to an article: link paragraphs, and headings that all articles of a host have."""

import pytest

from larder.llm import html_template


def texts(spark, sources):
    rows = [(i, f"http://h.example/{i}", source) for i, source in enumerate(sources)]
    made = html_template.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    return {r["page_id"]: r["text"] for r in made.collect()}


def words(i):
    return f"Words of page {i} that no other page has, some {'more ' * (i + 3)}of them."


@pytest.mark.parametrize("tag", ["article", "div"])
def test_link_paragraphs_stay_and_link_lists_go(spark, tag):
    def page(i):
        links = "".join(f"<li><a href=/{n}>Place number {n}</a></li>" for n in range(6))
        body = f"<h1>Title {i}</h1><p>{words(i)}</p><p><a href=/x>All of this paragraph {i} is one long link.</a></p><p>End {i}.</p>"
        return f"<body><ul>{links}</ul><{tag} class=body>{body}</{tag}><ul>{links}</ul></body>"

    got = texts(spark, [page(i) for i in range(8)])
    for i, text in got.items():
        assert text == f"Title {i}\n{words(i)}\nAll of this paragraph {i} is one long link.\nEnd {i}."


@pytest.mark.parametrize("tag", ["article", "div"])
def test_headings_of_all_articles_stay_with_what_they_head(spark, tag):
    def page(i):
        notice = "<h2>Please note</h2><p>The same words below each article of this host.</p>"
        body = f"<h1>Title {i}</h1><h2>Summary</h2><p>{words(i)}</p><h2>Details</h2><p>Then {words(i + 20)}</p>{notice}"
        return f"<body><nav>Menu</nav><{tag}>{body}</{tag}></body>"

    got = texts(spark, [page(i) for i in range(8)])
    for i, text in got.items():
        assert text == f"Title {i}\nSummary\n{words(i)}\nDetails\nThen {words(i + 20)}"


def test_pages_survive_packing():
    source = "<body><h1 class=a>T &amp; U</h1><p>one <a href=x>two</a><div class=widget><p>three</p></div></body>"
    page = html_template.parse(source)
    again = html_template.Page.unpacked(page.packed())
    assert again == page and again.blocks[0].text == "T & U"


def test_classes_are_equal_vectors(spark):
    """Against brute force: tokens of a host fall into classes by their counts on each page."""
    sources = [
        f"<body><div class=top><b>Host</b></div><p>{words(i)}</p>{'<p>Twice</p>' * (i % 2 + 1)}<div class=end>Foot</div></body>"
        for i in range(6)
    ]
    rows = [(i, f"http://h.example/{i}", source) for i, source in enumerate(sources)]
    pages = html_template.parsed(spark.createDataFrame(rows, "k long, url string, html string"), "k", "url", "html")
    found = html_template.equivalence_classes(pages, 3, 0.5).where("layout = '*'").collect()
    vectors = {}
    for place, source in enumerate(sources):
        for number, _, _ in html_template.parse(source).tokens:
            vectors.setdefault(number, [0] * len(sources))[place] += 1
    classes = {}
    for number, vector in vectors.items():
        if sum(map(bool, vector)) >= 3:
            classes.setdefault(tuple(vector), set()).add(number)
    got = {}
    for row in found:
        got.setdefault(row["class"], set()).add(row["number"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, classes.values()))
