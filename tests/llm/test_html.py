import html
import re

import pytest

from fiscalmill.llm import html_text

PAGES = "page_id long, url string, html string, text string, n_chars int"


@pytest.fixture(scope="module")
def model():
    return html_text.train()


def test_held_out_pages_of_the_grammar(model):
    grammar, right, total = html_text.PageGrammar(4711), 0, 0
    for _ in range(200):
        page, labels = grammar.page()
        blocks = html_text.blocks_of(page)
        assert len(blocks) == len(labels)
        right += sum(bool(a) == bool(b) for a, b in zip(model.decode(blocks), labels, strict=True))
        total += len(labels)
    assert right / total > 0.99


def test_articles_of_the_table(spark, folder, model):
    """The table's pages have one article each: its blocks are the text."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    found = {r["page_id"]: r for r in html_text.extract(pages, model).collect()}
    for page in pages.collect():
        article = re.search(r"<article>(.*?)</article>", page["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", re.sub("<br>", " ", b))).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        text = "\n\n".join(b for b in blocks if b)
        assert found[page["page_id"]]["text"] == text
        assert found[page["page_id"]]["n_chars"] == len(text)


def test_parts_that_are_no_article(model):
    page = """<html><head><title>t</title></head><body><header><div class=logo>My site</div><nav><a href=x>Home</a></nav></header>
    <div class="cookie-banner">We use cookies.</div><main><article><h1>Title here</h1><p>First   para with <a href=z>link</a>
    text.<p>Second.<aside>Related: foo</aside><ul><li>One item<li>Two item</ul><div class="advertisement">Buy now</div>
    <p>Third &nbsp; para &amp; more<section id="comments"><p>Nice article, thanks a lot for writing.</p></section></article></main>
    <form><label>Mail</label></form><footer>(c) 2020</footer><script>var a = "<p>no</p>";</script></body></html>"""
    wanted = ["Title here", "First para with link text.", "Second.", "One item", "Two item", "Third para & more"]
    assert html_text.main_text(page, model).split("\n\n") == wanted


def test_edges(spark, model):
    broken = ["<p>open <b>never closed", "<!-- no end <p>x", "<script>no end <p>x", "a < b & c > d", "<p title='a>b'>kept</p>", '<p title="open>text', "</div></p>"]
    rows = [(None, None, None, "t", 1), (1, "u", "", "t", 1), (1, "u", "", "t", 1), (2, "v", "<p>" + "word " * 50000 + "</p>", "t", 1)]
    rows += [(10 + i, "w", b, "t", 1) for i, b in enumerate(broken)]
    found = html_text.extract(spark.createDataFrame(rows, PAGES), model).collect()
    assert len(found) == len(rows)
    assert [r["text"] for r in found if r["page_id"] in (None, 1)] == ["", "", ""]
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert html_text.extract(spark.createDataFrame([], PAGES), model).count() == 0


ARTICLE = "<article><h1>A long title of it</h1><p>The first paragraph has some words in it.</p><p>The second one follows here, as said.</p></article>"
BLOCKS = ["A long title of it", "The first paragraph has some words in it.", "The second one follows here, as said."]


@pytest.mark.parametrize(
    "before, after",
    [
        ("<html><head><title>t</title>", ""),
        ("<html><head><meta charset=utf-8><link rel=x><style>p {}</style><script>no()</script>", "</html>"),
        ("<title>t</title>", ""),
        ("<head><title>t</title></head><body><button>", ""),
        ("<body><div><button>Menu</div>", "</body>"),
        ("<body><div><button>Menu", "</div></body>"),
        ("<body><button>Menu</button></button>", ""),
        ("<body><div><button>One<button>Two</button></div>", "<div><button>Share</button></div>"),
        ("<body><object data=x>", "</body>"),
        ("<body><div><svg><path d=x><g>", "</div><svg></svg>"),
        ("<body><svg viewBox=x />", "<svg></svg>"),
        ("<body><svg><title/><text>no</button>no</text></svg>", "<svg><title>no</title></svg>"),
        ("<body><svg><foreignObject><div>no</div></foreignObject>no</svg>", ""),
        ("<body><svg><svg>no</svg>no</svg>", ""),
        ("<body><template><p>no</p><template>no</template>no</template>", ""),
        ("<body><button><div>no</div><p>no</button>", ""),
        ("<body><svg>no</math>no</object>no</svg>", ""),
        ("<body><div><math><mi>", "</div></body>"),
    ],
)
def test_skipped_elements_end(before, after):
    assert [b.text for b in html_text.blocks_of(before + ARTICLE + after)] == BLOCKS


def test_formulas_and_objects_are_text(model):
    page = ARTICLE.replace("some words", "<math><mi>E</mi><mo>=</mo><mi>m</mi></math> and <object data=x>a plain table</object>")
    wanted = [BLOCKS[0], "The first paragraph has E=m and a plain table in it.", BLOCKS[2]]
    assert [b.text for b in html_text.blocks_of(page)] == wanted
    assert html_text.main_text("<html><head><title>t</title>" + page, model).split("\n\n") == wanted
