import html
import itertools
import re

import numpy as np
import pytest

from sftforge.llm import html_examples as X
from sftforge.llm import htmltext as H

from .helpers import SF, rows_of, stored, table


def article(page):
    """The blocks of the tables' pages, whose content is their one article of plain blocks."""
    inner = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S).group(1)
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<[^>]*\Z", "", inner))
    said = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in blocks]
    return "\n\n".join(b for b in said if b)


@pytest.fixture(scope="module")
def model(spark):
    return H.train(spark.read.parquet(f"{SF}/pages.parquet"))


def test_query_gives_the_articles(spark):
    want = sorted((r["page_id"], r["url"], t, len(t)) for r in table("pages") for t in [article(r["html"])])
    assert sorted((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in rows_of(H.op12_tree_model_extraction(spark, SF))) == want


def test_marginals_match_enumeration():
    rng = np.random.default_rng(3)
    pages = [H.Page(h) for h in ("<div><p>a b c.<p>d</div><nav><a>x</a></nav>", "plain", "", "<ul><li>1<li>2<ul><li>3</ul></ul>")]
    model = H.Model(rng.normal(0, 1, H.DIMS), rng.normal(0, 1, (H.EDGES, 2, 2)))
    b = H.Batch(pages)
    p, both = model.marginals(b)
    own = np.bincount(b.where, model.node[b.feature], minlength=b.n)
    for first, page in zip(b.first, pages):
        n = len(page.tag)
        total, one, pairs = 0.0, np.zeros(n), np.zeros((n, 2, 2))
        for y in itertools.product((0, 1), repeat=n):
            s = sum(own[first + i] for i in range(n) if y[i])
            for i in range(1, n):
                e = b.edge[first + i]
                s += (model.edge[0] + model.edge[e])[y[page.parent[i]], y[i]]
            w = np.exp(s)
            total += w
            one += w * np.array(y)
            for i in range(1, n):
                pairs[i, y[page.parent[i]], y[i]] += w
        assert np.allclose(p[first:first + n], one / total)
        assert np.allclose(both[first + 1:first + n], pairs[1:] / total)


def test_held_out_pages(model):
    """Generated pages of another seed, by text blocks."""
    pages = [H.Page(h) for h in X.pages(300, seed=77)]
    y = np.concatenate([H.node_labels(p, lambda _, a: H.mark_of(a)) for p in pages])
    leaf = np.concatenate([[t is not None for t in p.text] for p in pages])
    right = (model.marginals(H.Batch(pages))[0] >= 0.5) == y
    assert right[leaf & (y == 1)].mean() > 0.97 and right[leaf & (y == 0)].mean() > 0.97


MAIN = ["A heading of the story", "The first paragraph tells, at some length, what has happened & why; it ends here.", "Short.",
        "A second long paragraph follows, with a link in it, and goes on for a while until it ends as well."]


def body(tag="p"):
    return f"<h1>{MAIN[0]}</h1>" + "".join(f"<{tag}>{t}</{tag}>" for t in [MAIN[1].replace("&", "&amp;"), MAIN[2], MAIN[3].replace("a link", '<a href="/l">a link</a>')])


@pytest.mark.parametrize("page", [
    f"<html><body><header class='site'><p>My site of things</p></header><nav><a href=/>Home</a> <a href=/b>News</a></nav><main>{body()}</main>"
    "<footer>&copy; 2020 The owners. All rights kept.</footer></body></html>",
    f"<div id='cookie-consent'><p>We use cookies to make this site better for you, please agree to it.</p><button>OK</button></div>"
    f"<div class='post'><div class='entry-content'>{body()}</div></div><div id='comments'><ol><li class='comment'><p>I think that this is a very good story, "
    "and I would like to read more of it.</p></li><li class='comment'>No!</li></ol></div><div class='sidebar'><h3>Popular</h3><ul><li><a href=/1>One</a></li></ul></div>",
    f"<article>{body('div')}<aside class='related'><h3>More</h3><a href=/x>Other story</a></aside><div class='advert'>Buy now, it is cheap and good.</div>"
    "<section class='comments'><h2>Comments</h2><div class='comment'><p>Nice one, thanks for writing it down for us all.</p></div></section></article>"
    "<form class='newsletter'><label>Your mail</label><input><p>Get the news each day.</p></form>",
    f"<body>{body()}</body>",
])
def test_layouts_that_were_not_generated(model, page):
    assert H.texts([page], model) == ["\n\n".join(MAIN)]


def test_parsing():
    def blocks(h):
        return [t for t in H.Page(h).text if t is not None]
    assert blocks("<p>a<br>b\n\t c&nbsp;d<p>e<b>f</b><!-- x -->g</p>h") == ["a b c d", "efg", "h"]
    assert blocks("a < b &lt; c &amp;amp; &am") == ["a < b < c &amp; &am"]
    assert blocks("<script>if (a<b) '</p>'</script>x<style>p{}</style><textarea><p>no</textarea>y") == ["xy"]
    assert blocks("<select><option>1</select><svg><text>no</text></svg><button><p>no</p></button>z") == ["z"]
    assert blocks("<table><tr><td>1<td>2<tr><td>3</table>4<dl><dt>a<dd>b</dl>") == ["1", "2", "3", "4", "a", "b"]
    assert blocks("<p title='a>b' x=\"</p>\">in</p><a href=\"un>closed") == ["in", "closed"]
    assert blocks("<div>x<p>y</div>z</article></p></h3>w") == ["x", "y", "z", "w"]
    assert blocks("cut<p>off <b") == ["cut", "off"]
    assert blocks("<script>never closed <p>x") == [] and blocks("<!-- never <p>x") == []
    assert len(H.Page("<div>" * 3000 + "deep").tag) == 3002


def test_edge_cases(spark, tmp_dir, model):
    long = "<article>" + "<p>Many words stand here, again and again.</p>" * 20_000 + "</article>"
    rows = [(1, "u", None), (2, "u", ""), (None, None, "just words, without any markup at all."), (3, "u", long), (3, "u", long),
            (4, "u", "<nav><a href=/>only a menu</a></nav>"), (5, "u", "   \n"), (6, "u", "<div>" * 2000 + "deep")]
    frame = stored(spark, [(*r, "t", 5, "h") for r in rows], "page_id long, url string, html string, text string, n_chars int, _html string", tmp_dir)
    out = sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in rows_of(H.extract(frame, model))), key=str)
    many = "\n\n".join(["Many words stand here, again and again."] * 20_000)
    got = {r[0]: r[2] for r in out}
    assert len(out) == len(rows) and all(r[3] == len(r[2]) for r in out)
    assert got[1] == got[2] == got[4] == got[5] == "" and got[None].startswith("just words") and [r[2] for r in out].count(many) == 2
    empty = frame.where("page_id > 99")
    assert rows_of(H.extract(empty, H.train(empty))) == []


def test_own_sample_is_bounded_and_distinct(spark, tmp_dir):
    rows = [(f"<article><p>{i % 30}</p></article>",) for i in range(200)] + [("<p>x</p>",), (None,), ("<main>" + "y" * 40_000,)]
    frame = stored(spark, rows, "html string", tmp_dir)
    assert len(H.labelled(frame, "html", 10)) == len(set(H.labelled(frame, "html", 10))) == 10
    assert len(H.labelled(frame, "html", 100)) == 30
