import random
import re

import numpy as np
import pytest

from ledgerferry.llm import pages
from ledgerferry.llm.boosting import fit
from tests.llm.hand_pages import PAGES

SCHEMA = "page_id long, url string, html string, text string, blocks int"


def frame(spark, htmls):
    return spark.createDataFrame([(i, f"u{i}", h, "x", 1) for i, h in enumerate(htmls)], SCHEMA)


@pytest.fixture(scope="module")
def model():
    return pages.train()


def test_held_out_pages_are_extracted_whole(model):
    rng, right = random.Random(77), 0
    for _ in range(150):
        html = pages.labelled_page(rng)
        page = pages.Page(html, labels=True)
        for i, label in enumerate(page.labels):
            if label < 0:
                page.labels[i] = page.labels[page.parents[i]]
        want = [text for node, text, _ in page.runs if page.labels[node]]
        right += model.extract([re.sub(r" data-in=\d", "", html).removeprefix(pages.ROOT_IN)])[0] == want
    assert right >= 140


def test_rows_of_all_kinds(spark, model):
    article = "<p>" + "A sentence of some length, as articles have them. " * 5 + "</p>"
    page = (
        "<html><head><title>T</title><script>var a='<p>x</p>'</script></head><body><nav><a href=/>Home</a></nav>"
        f"<article><h1>Head &amp;\n  line</h1>{article}<p>two<br>lines &lt;b&gt; &eacute;</p><div class='ad'>Buy now</div></article>"
        "<section class='comments'><p>I disagree, strongly.</p></section><footer>&copy; me</footer></body></html>"
    )
    htmls = [page, None, "", "no markup", page, "<" * 5_000, "<div>" * 20_000 + "x", page[:-60], "<p title='a>b\">x", "<article>" + article * 2_000 + "</article>"]
    rows = {r["page_id"]: r for r in pages.digest(pages.extract(frame(spark, htmls), model)).collect()}
    assert len(rows) == len(htmls)
    body = ("A sentence of some length, as articles have them. " * 5).strip()
    text = f"Head & line\n{body}\ntwo lines <b> é"
    assert rows[0]["text"] == rows[4]["text"] == rows[7]["text"] == text
    assert (rows[0]["url"], rows[0]["n_chars"], rows[0]["n_blocks"]) == ("u0", len(text), 3)
    assert [(rows[i]["text"], rows[i]["n_chars"]) for i in (1, 2)] == [("", 0)] * 2
    assert rows[9]["text"] == "\n".join([body] * 2_000)
    assert pages.extract(frame(spark, []), model).collect() == []


@pytest.mark.parametrize(
    ("html", "texts"),
    [
        ("<p>one <svg class=i/> two</p><p>three</p>", ["one two", "three"]),
        ("<p>one <math/> two</p><p>three</p>", ["one two", "three"]),
        ("<p>one</p><button>go<p>two</p><p>three</p>", ["one", "go", "two", "three"]),
        ("<p>one</p><button>go<p>two</p><button>ok</button><p>three</p>", ["one", "go", "two", "three"]),
        ("<p>one</p><select><option>a<p>two</p>", ["one", "a", "two"]),
        ("<p>one</p><object data=x><p>two</p>", ["one", "two"]),
        ("<p>one</p><svg><p>two</p><noscript><p>three</p><template><p>four</p><iframe><p>five</p>", ["one", "two", "three", "four", "five"]),
        ("<p>one <math><mi>x</mi></math> two <object>three</object></p>", ["one x two three"]),
        ("<p>one</p><title-bar>two</title-bar><button-row>three</button-row><p>four</p>", ["one", "twothree", "four"]),
        ("<p>one</p><script>a</script x><p>two</p>", ["one", "two"]),
        ("<p>one<button a='b'>go</button><svg><text>t</text></svg><select><option>a</select><textarea>x<p></textarea></p><p>two<script>y", ["one", "two"]),
    ],
)
def test_only_what_is_closed_is_left_out(html, texts):
    assert [t for _, t, _ in pages.Page(html).runs] == texts


def test_articles_run_past_elements_left_open(spark, model):
    body = "A sentence of some length, as articles have them. " * 5
    htmls = [f"<body><nav><a href=/>Home</a></nav><article><h1>Head</h1><p>one {body}</p>{x}<p>two {body}</p></article></body>" for x in ("", "<svg class=i/>", "<math/>", "<object data=a>", "<select>", "<button>", "<svg>")]
    rows = pages.digest(pages.extract(frame(spark, htmls), model)).collect()
    assert {r["text"] for r in rows} == {f"Head\none {body.strip()}\ntwo {body.strip()}"}


def test_decoding_allows_no_contradiction_and_is_the_best():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randint(1, 7)
        parents = [-1, *(rng.randrange(i) for i in range(1, n))]
        odds = [rng.uniform(-6, 6) for _ in range(n)]
        inside = pages.decode(parents, odds)
        best = -1e9

        def above(i, parents=parents):
            return [] if parents[i] < 0 else [parents[i], *above(parents[i])]

        def worth(state, odds=odds, parents=parents):
            cuts = sum(s == 2 and state[parents[i]] == 1 for i, s in enumerate(state) if i)
            return sum(o for o, s in zip(odds, state, strict=True) if s == 1) - pages.CUT_COST * cuts

        for code in range(3**n):
            state = [code // 3**i % 3 for i in range(n)]
            if state[0] == 2 or any(state[i] < state[parents[i]] or (state[i] == 2 and state[parents[i]] == 0) for i in range(1, n)):
                continue
            best = max(best, worth(state))
        chosen = [1 if x else 2 if any(inside[a] for a in above(i)) else 0 for i, x in enumerate(inside)]
        assert abs(worth(chosen) - best) < 1e-9
        for i in range(1, n):
            path, at = [], i
            while at >= 0:
                path.append(inside[at])
                at = parents[at]
            assert "".join("01"[x] for x in path[::-1]).strip("0").count("0") == 0


def test_implied_ends_and_references():
    page = pages.Page("<ul><li>a<li>b <b>c</b></ul><p>d<p>e<table><tr><td>f<td>g<tr><td>h</table>i &am &amp &#233;")
    assert [t for _, t, _ in page.runs] == ["a", "b c", "d", "e", "f", "g", "h", "i &am & é"]
    assert [page.tags[n] for n, _, _ in page.runs] == ["li", "li", "p", "p", "td", "td", "td", "#root"]


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4_000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = fit(x[:3_000], y[:3_000])
    assert ((model.log_odds(x[3_000:]) > 0) == y[3_000:]).mean() > 0.95


def test_hand_written_pages_of_other_layouts(model):
    """Bare bodies, plain containers, layout tables, names that mislead, single paragraphs, plain text."""
    assert len(PAGES) >= 30
    for html, blocks in PAGES:
        assert model.extract([html])[0] == blocks, html[:200]


def test_a_part_is_cut_only_if_much_speaks_for_it():
    assert pages.decode([-1, 0, 1], [-5.0, 5.0, -pages.CUT_COST + 0.1]) == [False, True, True]
    assert pages.decode([-1, 0, 1], [-5.0, 5.0, -pages.CUT_COST - 0.1]) == [False, True, False]
    assert pages.decode([-1], [1.0]) == [True]
