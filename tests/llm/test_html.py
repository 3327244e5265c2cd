import html as entities
import random
import re

import pytest

from tributary.llm import html

WORDS = "river stone market quiet lantern copper winter bridge garden letter harbour window orchard thunder velvet".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 9999)) for _ in range(n)) + "."


def main(source):
    return " ".join(html.Page(source).main_blocks())


@pytest.mark.parametrize(
    "source, text",
    [
        ("", ""),
        ("plain text", "plain text"),
        ("<p>a<p>b<br>c<div>d</div>e", "a b c d e"),
        ("<p>one <b>b</b>old <i>it</i>, x&nbsp;y &amp &lt;b&gt; &#8364;</p>", "one bold it, x y & <b> €"),
        ("<script>if (a < b) { x = '</p>'; }</script><style>p > b {}</style><p>t</p>", "t"),
        ("<script>never closed <p>x</p>", ""),
        ("<!-- <p>no</p> --><p>yes</p><!-- open <p>no</p>", "yes"),
        ("<!--><p>yes</p>", "yes"),
        ("a < b and 1<2 </ x><p>t", "a < b and 1<2 t"),
        ("<p title='a > b' data-x=\"</p>\">t</p>", "t"),
        ("<p class=lead id=x1>t</p", "t"),
        ("<body><div>out<article><h1>T</h1><p>in</p></article>side</div></body>", "T in"),
        ("<main><article class='comment'>c</article><p>m</p></main>", "m"),
        ("<article><header><h1>T</h1></header><p>x</p><section class='comments'><p>c</p></section><form>f</form><aside>s</aside></article><header>h</header>", "T x"),
        ("<nav>n<article>a</nav>b</article>", "a"),
        ("<article><p><b>x<br><p>y</p></article><footer>f", "x y"),
        ("<div class='has-sidebar'><p>t</p><div class='left-sidebar'>s</div><div id='cookie-notice'>c</div><p class='ad slot'>a</p></div>", "t"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a b c"),
        ("<p>x</b></div>y</p>", "x y"),
        ("<P>U</P><SCRIPT>s</SCRIPT ><Article>A</ARTICLE>", "A"),
        ("<p>a<select><option>1<option>2</select><button>go</button>b</p>", "a b"),
    ],
)
def test_pages_by_names(source, text):
    assert main(source) == text


def test_very_long_and_deep_pages():
    assert main("<div>" * 50_000 + "x" + "</p></span></div>" * 50_000) == "x"
    assert len(main("<article>" + "<p>w " * 100_000 + "</article>")) == 199_999
    assert main("<" * 100_000) == " ".join(["<" * 100_000])
    assert main("<p a=\"" * 3000) == ""


def test_given_pages_give_their_whole_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in html.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        wanted = " ".join(entities.unescape(re.sub("</?(p|h1|br)>", " ", body).replace("<b>", "")).split())
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (wanted, len(wanted), r.url)


def soup(rng, own, host):
    """A page without telling names: what repeats is template."""
    links = "".join(f"<div><a href='/{k}'>{host} part {k}</a></div>" for k in range(5))
    return f"<html><body><div class='a1'>{links}</div><div class='b2'><h1>{own[0]}</h1>{''.join(f'<div>{p}</div>' for p in own[1:])}</div><div class='c3'><div>All rights kept by {host}</div><div>Imprint</div></div></body></html>"


def test_low_branches_without_names_are_removed(spark):
    rng = random.Random(1)
    rows, wanted = [], {}
    for i in range(60):
        host = f"{'ab'[i % 2]}.example.org"
        own = [prose(rng, 6)] + [prose(rng, rng.randint(5, 30)) for _ in range(rng.randint(1, 6))]
        rows.append((i, f"http://{host}/{i}", soup(rng, own, host)))
        wanted[i] = " ".join(own)
    rows += [(100 + i, "http://a.example.org/copy", rows[0][2]) for i in range(30)]  # copies are no template
    wanted |= {100 + i: wanted[0] for i in range(30)}
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as host", "1 as low", "2 as path").repartition(4)
    assert {r.page_id: r.text for r in html.extract(frame).collect()} == wanted


def test_importance_is_the_entropy_of_the_definition(spark):
    import math

    rng = random.Random(2)
    pages = [f"<body><div class='t'>same</div><div class='v'><p>{prose(rng, 5)}</p>{'<p>more</p>' * (i % 2)}</div></body>" for i in range(8)]
    frame = spark.createDataFrame([("h", p) for p in pages], "host string, html string")
    path = {n.label: n.path for n in html.Page(pages[1]).nodes[1:]}
    got = {r.path: r.importance for r in html.importance(frame).collect()}
    log = lambda n: math.log(n, 8)
    assert got[path["div.t"]] == pytest.approx((1 - 0.9) * 0 + 0.9 * (1 - log(8)), abs=1e-9)
    # eight different texts and one that four pages share
    assert got[path["p"]] == pytest.approx(0.9 * (1 - log(4) / 9), abs=1e-9)
    assert got[path["div.v"]] == pytest.approx(0 * 0.1 + 0.9 * (1 - log(4) / 9), abs=1e-9)  # one look: p, p* is one run


def test_html_awkward(spark):
    rows = [(1, None, None), (2, "no scheme", ""), (None, None, None), (3, "http://H/x", "<p>t</p>"), (3, "http://H/x", "<p>t</p>"), (4, "http://h", " \n"), (5, "http://h", "\x00<p>퟿ é</p>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as host", "'y' as text", "7 as n_chars")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in html.extract(frame).collect()), key=str)
    assert got == sorted([(1, None, "", 0), (2, "no scheme", "", 0), (None, None, "", 0), (3, "http://H/x", "t", 1), (3, "http://H/x", "t", 1), (4, "http://h", "", 0), (5, "http://h", "\x00 \ud7ff é", 5)], key=str)
    assert html.extract(frame.limit(0)).count() == 0
