import itertools

import numpy as np
import pytest

from gatehouse.llm import html_crf as H
from gatehouse.llm.html_blocks import blocks
from tests.llm.frames import collect


@pytest.fixture(scope="module")
def crf():
    return H.train()


def texts(page):
    return [b.text for b in blocks(page)]


@pytest.mark.parametrize("page,want", [
    ("", []), ("plain", ["plain"]), ("<p>a<p>b", ["a", "b"]), ("<p><b>x<br><p>y", ["x", "y"]),
    ("<p>a &amp; b&nbsp;c\n d</p>", ["a & b c d"]), ("<script>var t='</p>'</script><p>z", ["z"]),
    ("<style>p{}</style>a<!-- <p>no</p> -->b", ["ab"]), ("a < b <p>c", ["a < b", "c"]), ("<p title='x>y'>t</p>", ["t"]),
    ("<p>one<script>", ["one"]), ("<p>end <foo", ["end"]), ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]),
    ("<title>no</title><textarea>no</textarea><h1>t</h1>", ["t"]), ("<p>a<span>b</span><i>c</i></p>", ["abc"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]), ("<p>&lt;b&gt; &#65;&#x42; &copy", ["<b> AB ©"]),
    ("<P CLASS=x>up</P>", ["up"]), ("<div>a<div>b</div>c</div>", ["a", "b", "c"]), ("<!DOCTYPE html><![CDATA[x]]>y", ["y"])])
def test_blocks(page, want):
    assert texts(page) == want


def test_long_and_broken_markup_takes_linear_time():
    for page in ("<" * 200_000, "<p " * 50_000, "<a href=\"x" * 2000, "<!--" * 50_000, "<p>" * 30_000, "&" * 100_000, "x" * 2_000_000):
        blocks(page)


def test_viterbi_and_marginals_against_all_labelings(crf):
    for seed in range(6):
        found = blocks(H.Writer(seed).page())[:9]
        if len(found) < 2:
            continue
        u = crf.potentials(crf.encode(H.features(found)))
        bond = H.bonds(found)
        score = {y: sum(u[i, y[i]] for i in range(len(y))) + sum(crf.move[b, p, q] for b, p, q in zip(bond, y, y[1:]))
                 for y in itertools.product((0, 1), repeat=len(found))}
        best = max(score, key=score.get)
        assert tuple(crf.viterbi(found)) == best
        w = np.exp(np.array(list(score.values())))
        marg = (w[:, None] * np.array(list(score))).sum(axis=0) / w.sum()
        assert np.allclose(crf.marginals(u, bond)[0][:, 1], marg)


def test_held_out_pages(crf):
    wrong = total = 0
    for found, y in H.labelled_pages(120, 77):
        wrong += int((crf.viterbi(found) != y).sum())
        total += len(y)
    assert wrong / total <= 0.03


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body>
<div class="cookie-banner"><p>We store cookies to make this better.</p><button>Fine</button></div>
<header><a href="/">Site</a></header><nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav>
<div class="ad">Buy now.</div><article><h1>A title</h1><p>First   paragraph &amp; more.</p><div class="advert">Ad inside.</div>
<p>Short.</p><ul><li>item one of the list</li></ul></article><aside class="sidebar"><h3>Related</h3><ul><li><a href=x>Other</a></ul></aside>
<section id="comments"><div class="comment"><p>I do not agree with this at all, it is a long comment.</p></div></section>
<form class="newsletter"><label>Mail</label><p>Subscribe to our letter.</p></form><footer>&copy; 2024 Site</footer></body></html>"""


def test_a_whole_page(crf):
    assert H.main_text(crf, PAGE) == "A title\nFirst paragraph & more.\nShort.\nitem one of the list"


def test_frames(spark, crf):
    rows = [(1, "u", PAGE, 5, "t"), (1, "u", PAGE, 5, "t"), (2, None, None, 5, "t"), (3, "v", "", 5, "t"),
            (None, "w", "<article><p>" + "long text " * 100_000 + "</p></article>", 5, "t")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars int, text string")
    out = H.extract(df, carry=["page_id", "url", "n_chars"], crf=crf)
    assert out.columns == ["page_id", "url", "n_chars", "text"]
    got = sorted(collect(out.select("page_id", "text")), key=str)
    want = H.main_text(crf, PAGE)
    assert got == sorted([(1, want), (1, want), (2, ""), (3, ""), (None, ("long text " * 100_000).strip())], key=str)
    assert collect(H.extract(df.limit(0), carry=["page_id"], crf=crf)) == []


SENTENCES = ("The wells were dry by August.", "Nobody knew why.", "Rain fell for nine days on the northern valleys, and the river rose above the old bridge.")


@pytest.mark.parametrize("wrap", ["%s", "<html><body>%s</body></html>", "<body>%s"])
def test_plain_pages_lose_nothing(crf, wrap):
    """Pages of unnamed elements, text behind a table; written by hand, not by the generator."""
    for title, a, b in itertools.permutations(("Wells of the valley", *SENTENCES), 3):
        table = "<table><tr><td>May</td><td>71</td></tr><tr><td>June</td><td>64</td></tr></table><p>Source as given.</p>"
        for page, want in [
                (f"<div><h1>{title}</h1><div>{a}</div><div>{b}</div></div>", [title, a, b]),
                (f"<div><div><h1>{title}</h1></div><div><div>{a}</div><div>{b}</div></div></div>", [title, a, b]),
                (f"<h1>{title}</h1><p>{a}</p><p>{b}</p>", [title, a, b]),
                (f"<div id=content><h1>{title}</h1><p>{a}</p>{table}</div>", [title, a, "May", "71", "June", "64", "Source as given."]),
                (f'<div class="article"><h1>{title}</h1><p>{a}</p>{table}</div>', [title, a, "May", "71", "June", "64", "Source as given."]),
                (f"<div><a href=/>Home</a> <a href=/n>News</a></div><div><h1>{title}</h1><div>{a}</div><div>{b}</div></div><div>&copy; 2020 X</div>",
                 [title, a, b])]:
            assert H.main_text(crf, wrap % page) == "\n".join(want)


def test_deep_pages_take_linear_time(crf):
    import time
    for page in ("<div>x" * 8000, "".join(f"<div class=n{i} id=m{i}>t{i}" for i in range(8000)), "<blockquote>x" * 8000, "<p><blockquote>y" * 8000,
                 "<ul><li>" * 8000):
        t = time.process_time()
        H.main_text(crf, page)
        assert time.process_time() - t < 2


def test_inherited_features_are_those_of_the_path():
    page = ('<html class="site"><body id="Top"><div class="post main"><article><p>a</p><div class="post x" hidden><section><p>b</p></section>'
            '</div></article></div>c</body></html>')
    for b in blocks(page):
        tags = [e.tag for e in b.path if e.tag not in ("html", "body")]
        e = b.leaf
        assert (e.own or "body") == (tags[-1] if tags else "body") and (e.outer or "body") == (tags[0] if tags else "body")
        assert e.depth == len(tags) and e.inside == frozenset(tags[:-1])
        assert e.pairs == frozenset(f"{x}>{y}" for x, y in zip(tags, tags[1:]))
        assert e.names == frozenset(w for x in b.path for w in x.words)
    assert [b.leaf.hidden for b in blocks(page)] == [False, True, False]
    assert all(b.leaf.names <= {"post"} for b in blocks(page, {"post"}))
