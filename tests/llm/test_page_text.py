"""Main text of pages whose layouts are told by names, by elements, or only by what varies."""

import random

import pytest

from starloom.llm import page_text
from starloom.llm.pages import parse


def say(seed, n=30):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeinorstu") for _ in range(r.randint(2, 9))) for _ in range(n))


def semantic(i):
    """An article among named parts, each of which varies."""
    page = f"""<!DOCTYPE html><html><head><title>t{i}</title><script>if (a<b) x="</p>";</script></head><body class="has-sidebar"><header><h1>Site {i}</h1></header>
    <div id="cookie-notice">{say(i, 4)}</div><nav><ul><li><a href="/{i}">{say(i + 1, 2)}</a></ul></nav><div class="ad-slot-{i}">{say(i + 2, 6)}</div>
    <article><header><h1>Head &amp; {i}</h1></header><p>{say(i + 3)} <b>bo</b>ld&nbsp;x<br>y<p>Same closing line.</p><form><input>mail</form>
    <div class="share">Share</div><ul><li>one<li>two &lt;3</ul><!-- {say(i)} --></article><aside>{say(i + 4)}</aside>
    <section id="comments"><article><p>{say(i + 5, 60)}</p></article></section><footer>{say(i, 3)}</footer></body></html>"""
    return page, f"Head & {i} {say(i + 3)} bold x y Same closing line. one two <3"


def plain(i):
    """No names at all: template is what all pages have."""
    extra = "<div>Follow us everywhere and often</div>" if i % 3 == 0 else ""
    page = f"""<body><div>{'Home About Contact Imprint ' * 5}</div><div><div>All rights are reserved by nobody</div>{extra}
    <div><h2>{say(i, 4)}</h2><div>{say(i + 50)}</div><div>{say(i + 90, 50)}</div></div></div><div>Made with care and more words than needed</div>"""
    return page, f"{say(i, 4)} {say(i + 50)} {say(i + 90, 50)}"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, "http://A.example.org/" + str(i), *semantic(10 * i)) for i in range(30)]
    rows += [(100 + i, f"https://b.example.org?{i}", *plain(200 * i)) for i in range(12)]
    rows += [(200, "http://alone.net", *semantic(7)), (201, None, "<p>only <i>th</i>is", "only this"), (202, "no host", None, ""), (203, "http://a.example.org/", "", "")]
    rows += [(204, "http://copies.org/1", *semantic(5))] * 6 + [(205, "http://alone.org", "just text & more", "just text & more")]
    long = "".join(f"<p>{say(i, 3)}</p>\n" for i in range(3000))
    rows += [(206, "http://a.example.org/long", f"<nav>menu</nav><article>{long}</article>", " ".join(say(i, 3) for i in range(3000)))]
    table = spark.createDataFrame([(i, u, h, "t", "z") for i, u, h, _ in rows], "page_id long, url string, html string, text string, tree string")
    return sorted((i, u, t) for i, u, _, t in rows if u) + [(201, None, "only this")], table.repartition(4)


def test_main_text(pages):
    want, table = pages
    found = page_text.main_text(table)
    assert found.columns == ["page_id", "url", "tree", "text", "n_chars"]
    got = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in found.collect()}
    assert got == {(i, u): (t, len(t)) for i, u, t in want}
    assert found.count() == table.count() and page_text.main_text(table.limit(0)).count() == 0


def test_matching_is_the_largest():
    def tree(*rows):
        return [p for p, _ in rows], [label for _, label in rows]

    a = tree((-1, "r"), (0, "x"), (0, "y"), (2, "p"), (0, "z"))
    b = tree((-1, "r"), (0, "y"), (0, "x"), (0, "y"), (3, "q"), (3, "p"), (0, "z"))
    assert page_text.match(*a, *b) == [0, 2, 3, 5, 6]
    assert page_text.match(*a, *a) == [0, 1, 2, 3, 4]
    assert page_text.match([-1], ["r"], *b) == [0]


@pytest.mark.parametrize("html", ["<div>" * 3000 + "x", "<" * 5000, "<p class='a" * 500, "<script>" + "y" * 99, "</p></div></article>x", "<table><td>a<td>b<tr><td>c</table>d", "<a "])
def test_broken_markup(html):
    page = parse(html)
    assert len(page.labels) <= 202 and len(page.parents) == len(page.labels) and all(p < i for i, p in enumerate(page.parents))
    assert " ".join(b[1] for b in page.blocks) == {"x": "x", "<": "<" * 5000 if html.startswith("<<") else "", "d": "a b c d"}.get(html[-1], "")
