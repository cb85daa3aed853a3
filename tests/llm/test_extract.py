import html
import random
import re
import time

from carelake.llm import extract

LONG = "The quick brown fox is in the house of the king and it was a good day for all of them to be there with you."
PAGE = f"""<html><head><title>T</title><style>p {{}}</style></head><body><header><h1>Site name</h1></header>
<div class="cookie-notice">{LONG}</div><nav><ul><li><a href=x>Home</a></li></ul></nav>
<div id="main-text"><h1>Title &amp; more</h1><p>{LONG}</p><p>Short.</p><script>var a = "</p><p>{LONG}";</script>
<p>{LONG} <a href="y">and</a>&nbsp;so<br>on</p><form><p>{LONG}</p></form></div>
<section id="comments"><p>{LONG}</p></section><aside><p>{LONG}</p></aside><footer>&copy; us</footer></body></html>"""


def test_page_without_article():
    assert extract.main_text(PAGE) == f"Title & more {LONG} Short. {LONG} and so on"


def test_article_keeps_its_short_blocks():
    page = '<body><nav><a>x</a></nav><div class="ad">the ad</div><article><h1>Be.</h1><p><b>Of a<br><p>No</p></article><footer>f'
    assert extract.main_text(page) == "Be. Of a No"


def test_cut_off_and_odd_pages():
    assert extract.main_text(None) == "" and extract.main_text("") == "" and extract.main_text("<") == ""
    assert extract.main_text(f"<article><p>{LONG}</p><p>More te") == f"{LONG} More te"
    assert extract.main_text(f"<article><p>{LONG}</p><p cla") == LONG
    assert extract.main_text(f"<article><p>{LONG}<!-- <p>no</p> --></p><style>x") == LONG
    assert extract.main_text(f"<nav><p>{LONG}</p><article><p>1 &lt; 2 {LONG}</article>") == f"1 < 2 {LONG}"
    assert extract.main_text(f"<article><div hidden>{LONG}</div><p>{LONG}</p><div class='comments'>{LONG}</div></article>") == LONG
    long = "<article>" + f"<p>{LONG}</p>" * 5000 + "</article>"
    assert extract.main_text(long) == " ".join([LONG] * 5000)


def test_pages_of_the_driver(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r for r in extract.extract_main_text(pages).collect()}
    for p in pages.collect():  # the articles of these pages are well marked
        body = p.html[p.html.find("<article>") + 9:].split("</article>")[0]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"<[^>]*$", "", body))).split())
        assert (got[p.page_id].text, got[p.page_id].n_chars) == (want, len(want))


def test_odd_rows(spark):
    rows = [(1, None, None), (1, "u", f"<p>{LONG}</p>"), (None, None, ""), (1, "u", f"<p>{LONG}</p>")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    assert sorted(r.n_chars for r in extract.extract_main_text(pages).collect()) == [0, 0, len(LONG), len(LONG)]
    assert extract.extract_main_text(pages.limit(0)).count() == 0


def test_names_of_a_wrapper_do_not_empty_the_page():
    body = f"<h1>Title here</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
    for name in ("layout-sidebar-right", "page-with-sidebar", "col related", "widget-text", "post-header-image",
                 "content search-results", "overflow-hidden", "sidebar", "promo"):
        for page in (f"<body><div class='{name}'>{body}</div></body>", f"<article><div class='{name}'>{body}</div></article>"):
            assert extract.main_text(page) == f"Title here {LONG} Short. {LONG}", (name, page)
    inner = f"<div class='layout widget'>{body}<div class='sidebar'><p>{LONG}</p></div></div>"
    assert extract.main_text(inner) == f"Title here {LONG} Short. {LONG}"


def test_comments_stay_out_however_long():
    page = f"<div><p>{LONG}</p><div id='comments'>" + f"<article class='comment'><p>{LONG}</p></article>" * 9 + "</div></div>"
    assert extract.main_text(page) == LONG
    assert extract.main_text(f"<article><p>{LONG}</p></article><article class='comment-body'><p>{LONG}</p></article>") == LONG


def test_text_beside_an_article_does_not_outweigh_it():
    assert extract.main_text(f"<article><p>{LONG}</p></article><div class='related'>" + f"<p>{LONG}</p>" * 9 + "</div>") == LONG


def test_other_languages():
    polish = ("Wczoraj wieczorem dzieci poszły nad rzekę, żeby zobaczyć statki, które wracały z dalekiej podróży. "
              "Nikt nie wiedział, kiedy przypłyną następne.")
    chinese = "昨天晚上孩子们到河边去看从远方回来的船。没有人知道下一艘船什么时候会到，所以他们在那里等了很久。"
    for text in (polish, chinese):
        page = f"<body><div class='menu'><a href=x>{text}</a></div><div><p>{text}</p><p>Ok.</p><p>{text}</p></div></body>"
        assert extract.main_text(page) == f"{text} Ok. {text}"


def walked(blocks):
    """The second pass by walking to the neighbours."""
    first = [b.label for b in blocks]

    def neighbour(i, step):
        k = i + step
        while 0 <= k < len(blocks):
            inside = blocks[i].region > 0
            if first[k] in ("good", "bad") and (not inside or blocks[k].region == blocks[i].region and not blocks[k].bad):
                return first[k], abs(k - i)
            k += step
        return None, 0

    out = []
    for i, b in enumerate(blocks):
        (before, d1), (after, d2) = neighbour(i, -1), neighbour(i, 1)
        if first[i] in ("good", "bad"):
            out.append(first[i])
        elif first[i] == "near":
            out.append("bad" if b.region <= 0 and before == "bad" and after == "bad" else "good")
        elif b.region > 0:
            out.append("bad" if {before, after} in ({"bad"}, {"bad", None}) else "good")
        elif b.heading and after:
            out.append(after)
        elif before is None or after is None:
            out.append("bad")
        elif before == after:
            out.append(before)
        else:
            out.append(after if d2 < d1 else before if d1 < d2 else "bad")
    return out


def test_second_pass_against_walking():
    rnd = random.Random(5)
    for _ in range(3000):
        blocks = []
        for _ in range(rnd.randint(1, 14)):
            b = extract.Block(rnd.random() < 0.2, rnd.choice((0, 0, 1, 2)), 0, rnd.random() < 0.2)
            b.label = "bad" if b.bad else rnd.choice(("good", "bad", "near", "short", "short"))
            blocks.append(b)
        want = walked(blocks)
        extract.second_pass(blocks)
        assert [b.label for b in blocks] == want


def test_many_blocks_take_linear_time():
    for page in ("<p>few words</p>" * 100_000, "<div class=nav>" * 50_000 + "x" + "</div>" * 50_000,
                 "<b><i>" * 50_000 + "</p></u>" * 50_000, "<article>" + "<p>few words</p>" * 100_000):
        start = time.process_time()
        extract.main_text(page)
        assert time.process_time() - start < 8


def test_clashing_names(spark):
    pages = spark.createDataFrame([(1, "u", f"<p>{LONG}</p>", "a", "b", 3)],
                                  "page_id long, url string, html string, c0 string, r_text string, n_chars long")
    assert [tuple(r) for r in extract.extract_main_text(pages).collect()] == [(1, "u", LONG, len(LONG))]
