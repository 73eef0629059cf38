"""Main text of hand-made pages; templates counted per host."""

import pytest

from sparkmart.llm.html_extract import extract, main_text, parse, subtrees

CASES = [
    ("<article><h1>T &amp; U</h1><p>a <b>b</b>c<p>d<br>e</article>", "T & U a bc d e"),
    ("<nav>m</nav><header>h</header><article>x<script>var a='</p>';</script><style>p{}</style> y</article><footer>f</footer>", "x y"),
    ("<body><div id='sidebar'>s</div><div class='ad box'>ad</div><p>text\n\t more&nbsp;here</p><form>f</form></body>", "text more here"),
    ("<main><p>a</p><section class='comments'><p>c</p></section><div class=cookie-notice>n</div></main>", "a"),
    ("<article><div class='header-note'>gone</div><p class=lead>stay</p><!-- <p>no</p> --></article>", "stay"),
    ("<article><header><h1>Title</h1></header><p>body</article><aside>z</aside>", "Title body"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></article>", "one two c1 c2"),
    ("<article><p>5 &lt; 6 &#233; &copy 7</p></article>", "5 < 6 é © 7"),
    ("plain words", "plain words"),
    ("<article><p>a</div>b</p></article>", "ab"),
    ("<article><p>open <b>bold <i>it", "open bold it"),
    ("<p hidden>x</p><p>y</p>", "y"),
    ("<div class='layout with-sidebar'><article><p>kept</p></article><div class=sidebar>s</div></div>", "kept"),
    ("<div class='content no-sidebar'><p>kept</p></div><div class=sidebar>s</div>", "kept"),
    ("<form><header>h</header><div><p>the whole page in a form</p></div><footer>f</footer></form>", "the whole page in a form"),
    ("<form><article>one</article></form><form>search</form>", "one"),
    ("<article><p>the <span class=share>share</span> of votes</p></article>", "the share of votes"),
    ("<div class='page header-wide'><main><p>in a marked wrapper</p></main></div><div>other</div>", "in a marked wrapper"),
    ("<article>a</article><div class=related><article>a longer teaser</article></div>", "a"),
    ("<p>short</p><section class=comments><p>a much longer comment of a reader</p></section>", "short"),
    ("<nav>n</nav><form>Login Password</form>", ""),
    ("", ""),
    ("<", "<"),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_main_text(page, text):
    assert main_text(page) == text


def test_subtrees_leave_the_articles_paragraphs_alone():
    page = "<nav>m</nav><article><p>a</p><div class=x>b</div></article>"
    assert set(subtrees(page)) == set(subtrees("<nav> m</nav><article><div class=x>b</div><p>c</p></article>".replace(" m", "m")))
    assert parse("<p>a<p>b").kids[1].name == "p"


def test_templates_per_host(llm):
    box = "<div class=x>Subscribe to us</div>"
    rows = [(i, f"http://a.com/{i}", f"<div>{box}<p>All rights of a.com</p><p>own text {i}</p></div>") for i in range(8)]
    rows += [(20 + i, f"http://b.com/{i}", f"<p>All rights of a.com</p><p>text {i}</p>") for i in range(2)]
    rows += [(40 + i, f"http://c.com/{i}", f"<article><p>a copied story</p><p>{box}</p></article><p>{i}</p>") for i in range(9)]
    rows += [(60, None, None), (61, "http://a.com/x", ""), (62, None, "<p>x</p>"), (None, "u", "<p>y</p>"), (0, rows[0][1], rows[0][2])]
    pages = llm.createDataFrame([(*r, "clash", 0) for r in rows], "page_id long, url string, html string, text string, hashes int").repartition(3)
    out = extract(pages).collect()
    assert len(out) == len(rows)
    got = {r["page_id"]: r["text"] for r in out}
    assert [got[i] for i in range(8)] == [f"own text {i}" for i in range(8)]
    assert got[20] == "All rights of a.com text 0"
    assert got[40] == "a copied story" and got[60] == got[61] == "" and got[62] == "x" and got[None] == "y"
    assert all(r["n_chars"] == len(r["text"]) for r in out)
    assert extract(pages.limit(0)).count() == 0


def test_copies_of_a_page_count_once(llm):
    rows = [(i, f"http://d.com/{i}", "<article><div><p>copied words</p></div></article>") for i in range(9)]
    rows += [(20 + i, f"http://e.com/{i}", "<p>copied words</p>") for i in range(9)]
    # Copies don't hide the template of the other pages either.
    rows += [(40 + i, f"http://f.com/{i}", "<article>a copied story</article>") for i in range(40)]
    rows += [(80 + i, f"http://f.com/x{i}", f"<article><p>own text {i}</p><div>About f.com</div></article>") for i in range(6)]
    pages = llm.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in extract(pages).collect()}
    assert {got[i] for i in range(9)} == {got[20 + i] for i in range(9)} == {"copied words"}
    assert {got[40 + i] for i in range(40)} == {"a copied story"}
    assert [got[80 + i] for i in range(6)] == [f"own text {i}" for i in range(6)]


def test_deep_pages_keep_their_blocks_apart():
    for name in ("div", "section", "b"):
        deep = f"<{name}>" * 3000 + "<p>a</p><p>b</p><ul><li>c<li>d</ul>"
        assert main_text(f"<article>{deep}</article>") == "a b c d"
    box = "<div>box</div>"
    page = "<article>" + "<section>" * 1000 + f"<p>a</p>{box}<p>b</p>"
    assert main_text(page, frozenset(subtrees(box))) == "a b"


@pytest.mark.parametrize("page", ["<div>" * 8000 + "x" * 200_000, "<a " * 20_000, "</b>" * 20_000 + "<p>x", "<b>" * 5000 + "</i>" * 20_000, "<p class='" * 5000])
def test_hostile_pages_take_linear_time(page):
    import time

    began = time.process_time()
    main_text(page, frozenset(subtrees(page)))
    assert time.process_time() - began < 4
