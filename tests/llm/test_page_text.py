"""Blocks of pages, the labeller's gradient, and its accuracy on pages it has not seen."""

import html
import re

import numpy as np
import pytest

from cabrank.llm import page_text
from conftest import SMALL


def test_blocks():
    page = (
        "<!DOCTYPE html><head><title>T</title></head><body><!-- a <p>no</p> --><script>var x = '</p>';</script><ul><li>One<li><a href='x>y'>Two</a> b</ul>"
        "<p class=\"lead big\">A &amp; B&nbsp;&lt;c&gt;<br>d\t\n e <b>f</b>g<p>next<div id=x>in <span>div</span></div> tail</body>"
    )
    assert [(p, t) for p, t, _ in page_text.blocks_of(page)] == [
        (("body", "ul", "li"), "One"), (("body", "ul", "li"), "Two b"), (("body", "p lead big"), "A & B <c> d e fg"),
        (("body", "p"), "next"), (("body", "div x"), "in div"), (("body",), "tail"),
    ]
    assert [n for _, _, n in page_text.blocks_of("<p><a>four</a> more</p>")] == [4]
    assert [t for _, t, _ in page_text.blocks_of("<p>open <b>end")] == ["open end"]
    assert page_text.blocks_of(None) == page_text.blocks_of("") == page_text.blocks_of("<script>only") == []
    assert [t for _, t, _ in page_text.blocks_of("<p>1 < 2 and 3 > 2</p>")] == ["1 < 2 and 3 > 2"]


def test_gradient_against_differences():
    rnd = np.random.default_rng(3)
    sequences = [x for x in page_text.layouts(rnd, ["Some prose here. And more.", "Words, words."], ["Home", "About us"], 3)]
    labeller = page_text.Labeller(1)
    labeller.weights = {k: w.astype(np.float64) for k, w in labeller.weights.items()}
    batch = page_text.prepared([b for b, _ in sequences], [known for _, known in sequences])
    _, slopes = labeller.gradient(batch)
    for name, weights in labeller.weights.items():
        for _ in range(6):
            place = tuple(int(rnd.integers(n)) for n in weights.shape)
            kept = weights[place]
            losses = []
            for change in (1e-3, -1e-3):
                weights[place] = kept + change
                losses.append(labeller.gradient(batch)[0])
            weights[place] = kept
            assert slopes[name][place] == pytest.approx((losses[0] - losses[1]) / 2e-3, abs=2e-4)


def test_labels_do_not_depend_on_the_batch():
    rnd = np.random.default_rng(5)
    pages = [b for b, _ in page_text.layouts(rnd, ["Some prose here.", "Words."], ["Home"], 8)] + [[]]
    labeller = page_text.Labeller(2)
    together = labeller.probabilities(pages)
    for page, expected in zip(pages, together):
        assert np.allclose(labeller.probabilities([page])[0], expected, atol=1e-5)
    # Step by step for one page, from the first block on and from the last one back.
    paths, of, rest = page_text.vectors(pages[0])
    whole, w = np.concatenate([paths[of], rest], axis=1), labeller.weights
    states = {}
    for side, order in (("f", range(len(whole))), ("b", reversed(range(len(whole))))):
        h = c = np.zeros(page_text.HIDDEN)
        for t in order:
            i, f, o, g = np.split(whole[t] @ w[f"w{side}"] + h @ w[f"u{side}"] + w[f"c{side}"], 4)
            sigmoid = lambda x: 1 / (1 + np.exp(-x))
            c = sigmoid(f) * c + sigmoid(i) * np.tanh(g)
            h = sigmoid(o) * np.tanh(c)
            states[side, t] = h
    slow = [1 / (1 + np.exp(-(np.concatenate([states["f", t], states["b", t]]) @ w["v"] + w["d"][0]))) for t in range(len(whole))]
    assert np.allclose(slow, together[0], atol=1e-5)


def articles(page):
    """The article of the given pages by patterns, without the labeller."""
    found = re.search(r"<article>(.*)</article>", page or "", re.DOTALL)
    parts = re.split(r"</?(?:p|h1)>", found[1].replace("<br>", " ").replace("<b>", "")) if found else []
    cleaned = (re.sub(r"[\x20\x09-\x0D]+", " ", html.unescape(x)).strip(" ") for x in parts)
    return "\n\n".join(filter(None, cleaned))


@pytest.fixture(scope="module")
def labeller(spark):
    return page_text.labeller_of(spark.read.parquet(f"{SMALL}/pages.parquet"))


def test_pages_of_the_table(spark, labeller):
    rows = spark.read.parquet(SMALL.replace("0.001", "0.01") + "/pages.parquet").collect()
    assert list(page_text.texts_of([r.html for r in rows], labeller)) == [articles(r.html) for r in rows]


def test_held_out_layouts(spark, labeller):
    rows = spark.read.parquet(SMALL.replace("0.001", "0.01") + "/pages.parquet").collect()
    prose = [t for r in rows[100:] for t in articles(r.html).split("\n\n")]
    unseen = list(page_text.layouts(np.random.default_rng(77), prose, ["Home", "Contact us today", "Sign in"], 300))
    right = np.concatenate([(p > 0.5) == known for p, (_, known) in zip(labeller.probabilities([b for b, _ in unseen]), unseen)])
    assert right.mean() > 0.98


def test_another_design(labeller):
    page = """<html><body><header class="site-header"><h1>My Site</h1><nav><a>Home</a></nav></header><div class="cookie-notice">We use cookies.</div>
    <div id="main"><div class="story"><h1>The Title</h1><p>First paragraph with a <a href="x">link</a> &amp; more.</p><aside><h3>Related</h3><ul><li><a>One</a></li></ul></aside>
    <ul><li>first item of a list</li><li>second item</li></ul><p>Second paragraph, which goes on and on for a while.</p><form><label>Email</label></form>
    <section class="comments"><h2>Comments</h2><p>Great article, I liked it a lot.</p></section></div></div><div class="ad">Buy this now.</div><footer>Copyright</footer></body></html>"""
    assert list(page_text.texts_of([page], labeller)) == [
        "The Title\n\nFirst paragraph with a link & more.\n\nfirst item of a list\n\nsecond item\n\nSecond paragraph, which goes on and on for a while."
    ]


def designs(rnd, prose, side, names):
    """Pages of designs that no table holds, each with the blocks of its main text."""
    one = lambda values: values[int(rnd.integers(len(values)))]
    links = lambda n: "".join(f'<li><a href="/x">{one(names)}</a></li>' for _ in range(n))
    body, title = [one(prose) for _ in range(int(rnd.integers(2, 8)))], one(side)
    ps, more, bare = "".join(f"<p>{x}</p>" for x in body), [title, *body], "<p>".join(["", *body])
    return [
        (f'<div class="header"><a href="/">{one(names)}</a></div><div class="menu"><ul>{links(6)}</ul></div><div class="content"><h1>{title}</h1>'
         f'{ps}</div><div class="sidebar"><h3>{one(names)}</h3><p>{one(side)}</p></div><div class="footer">{one(side)}</div>', more),
        (f'<div><div><ul>{links(7)}</ul></div><div><h1>{title}</h1>{ps}</div><div><p><a href="/">{one(names)}</a> | <a href="/">{one(names)}</a></p></div></div>', more),
        (f'<div class="topbar">{one(names)}</div><div class="post"><h2 class="post-title">{title}</h2><div class="entry-content">{ps}</div>'
         f'<div class="share-buttons">{links(3)}</div><div class="related-posts"><h4>x</h4>{links(4)}</div></div><ol class="commentlist"><li>'
         f'<div class="comment-body"><p>{one(prose)}</p></div></li><li><p>{one(prose)}</p></li></ol><div class="promo"><p>{one(prose)}</p></div>', more),
        (f'<nav><ul>{links(6)}</ul></nav><article><h1>{title}</h1>{ps}<div class="ad">{one(prose)}</div><section class="comments"><h2>Comments</h2>'
         f"<p>{one(prose)}</p><p>{one(prose)}</p></section></article><footer>{one(side)}</footer>", more),
        (f'<div class="notice"><p>{one(prose)}</p></div><div role="main"><h1>{title}</h1>{ps}</div><div role="complementary"><p>{one(prose)}</p></div>'
         f'<div role="contentinfo"><p>{one(side)}</p></div>', more),
        (f'<HEADER><H2>{one(names)}</H2></HEADER><MAIN><H1>{title}</H1>{bare}<ASIDE><UL><LI><A>{one(names)}</A><LI>{one(side)}</UL></ASIDE></MAIN>'
         f"<FOOTER>{one(side)}</FOOTER>", more),
        (f'<div id="page"><div id="cookie-consent">{one(prose)}<button>OK</button></div><div id="story"><h1>{title}</h1><div class="newsletter"><p>{one(side)}</p>'
         f'<form><label>{one(names)}</label></form></div>{ps}</div><div id="respond"><h3>Reply</h3><p>{one(prose)}</p></div></div>', more),
        (f'<div class="site-header"><span>{one(names)}</span></div><section class="blog"><article class="post"><header><p>{one(names)}</p></header><div class="body">'
         f'{ps}</div><ul class="tags">{links(3)}</ul></article></section><div class="widget-area"><div class="widget"><p>{one(side)}</p></div></div>', body),
    ]


def test_designs_no_table_holds(spark, labeller):
    rows = spark.read.parquet(SMALL.replace("0.001", "0.01") + "/pages.parquet").collect()
    found = lambda pattern: [html.unescape(x) for r in rows for x in re.findall(pattern, r.html)]
    prose, side, names = found(r"<p>([^<&]{30,600})</p>"), found(r'<div class="ad">([^<&]+)</div>'), found(r'<a href="[^"]*">([^<&]+)</a>')
    rnd, right = np.random.default_rng(5), []
    for _ in range(40):
        for page, parts in designs(rnd, prose, side, names):
            text = next(page_text.texts_of([f"<html><head><title>t</title></head><body>{page}</body></html>"], labeller))
            right.append(text == "\n\n".join(" ".join(x.split()) for x in parts))
    by_design = np.array(right).reshape(40, -1).mean(axis=0)
    assert by_design.min() >= 0.9 and by_design.mean() >= 0.97, by_design


def test_rows_and_columns(spark, labeller):
    page = spark.read.parquet(f"{SMALL}/pages.parquet").first().html
    rows = [(1, "u", page, "x"), (1, "u", page, "x"), (2, None, None, None), (None, "v", "", "y"), (3, "w", "<nav>menu</nav>", "z")]
    frame = page_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert frame.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    text = articles(page)
    expected = [(1, "u", text, len(text))] * 2 + [(2, None, "", 0), (None, "v", "", 0), (3, "w", "", 0)]
    assert sorted(map(tuple, frame.collect()), key=str) == sorted(expected, key=str)
    assert page_text.extracted(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_long_pages(labeller):
    page = "<article>" + "<p>Some words that make up a paragraph of the text.</p>" * 20_000 + "</article><footer>End</footer>"
    assert next(page_text.texts_of([page], labeller)).count("\n\n") == 19_999
