from tripfold.llm import extract

LONG = "This is a paragraph of the article that goes on for quite a while, as paragraphs do, with more than eighty characters."
MORE = "Another paragraph follows it and is just as long, so that the sums over lines surge here and stay high until the end."


def page(main, before="", after=""):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{before}{main}{after}</body></html>"


def test_marked_article():
    nav = '<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy this thing now, it is the best thing that has ever been sold in any shop.</div>'
    foot = f"<footer>&copy; {MORE}</footer>"
    html = page(f"<article><h1>Headline</h1><p><b>{LONG}<br><p>Short.</p><p>{MORE}</p><p>End.</p></article>", nav, foot)
    assert extract.main_text(html) == "\n".join(["Headline", LONG, "Short.", MORE, "End."])


def test_unmarked_page_uses_surge_and_dive():
    menu = "<div><a href=a>Home</a> <a href=b>News of the world and of all the other places that there are in it today</a></div>" * 4
    side = "<div id=sideBar>" + f"<p>{MORE}</p></div>"
    notes = f'<section class="reader-comments"><p>{LONG}</p></section>'
    html = page(f'<div class="content has-sidebar"><h2>A headline that is long enough to see</h2><p>{LONG}</p><p>{MORE}</p></div>', menu + side, "<p>x</p><p>y</p><p>z</p>" + notes)
    assert extract.main_text(html) == "\n".join(["A headline that is long enough to see", LONG, MORE])


def test_short_lines_of_an_unmarked_article_stay():
    menu = "<div class=top><a href=a>Home</a> <a href=b>World</a></div>"
    foot = "<div><p>Contact us</p><p>Imprint</p></div>"
    parts = ["Headline", "By A. Writer", LONG, "First.", "Second.", "Third.", MORE, LONG, "The end."]
    body = f"<h1>Headline</h1><p>By A. Writer</p><p>{LONG}</p><ul><li>First.</li><li>Second.</li><li>Third.</li></ul><p>{MORE}</p><div><p>{LONG}</p><p>The end.</p></div>"
    assert extract.main_text(page(f"<div id=content>{body}</div>", menu, foot)) == "\n".join(parts)
    assert extract.main_text(page(f"<div><div>{menu}</div><div id=content>{body}</div></div>", "", foot)) == "\n".join(parts)
    # a second part that is far shorter than the first, after a gap of links
    gap = "".join(f"<p><a href=x>{LONG}</a></p>" for _ in range(4))
    html = page(f"<div><p>{MORE * 9}</p>{gap}<p>{LONG}</p></div>", menu, foot)
    assert extract.main_text(html) == "\n".join([MORE * 9, LONG])


def test_surge_and_dive_decide():
    short = "Some thirty characters of text."
    html = page(f"<div><p>{short}</p></div>")
    assert extract.main_text(html) == "" and extract.main_text(html, surge=20) == short
    gap = "".join(f"<p><a href=x>{LONG}</a></p>" for _ in range(4))
    for mark in ("div", "article"):
        html = page(f"<{mark}><p>{LONG}</p>{gap}<p>x</p>{gap}<p>{MORE}</p></{mark}>")
        assert extract.main_text(html) == "\n".join([LONG, MORE])
        assert extract.main_text(html, dive=-1) == "\n".join([LONG, *[LONG] * 4, "x", *[LONG] * 4, MORE])  # the sums never dive


def test_the_header_of_an_article_is_its_own():
    html = page(f"<article><header><h1>Headline</h1><nav>no</nav></header><p>{LONG}</p></article>", "<header><h1>Site</h1></header>")
    assert extract.main_text(html) == f"Headline\n{LONG}"


def test_without_its_marks_a_page_gives_the_same_text(spark):
    import re

    same = total = 0
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        plain = re.sub(r"<(/?)(?:article|main)\b", r"<\1div", r.html or "")
        total += 1
        same += extract.main_text(plain) == extract.main_text(r.html)
    assert same >= 0.98 * total > 100


def test_deep_boxes():
    deep = 3000
    html = f"{'<div>' * deep}<p>{LONG}</p>{'</div>' * deep}<div><p>x</p></div>"
    assert extract.main_text(html) == LONG


def test_references_white_space_and_broken_markup():
    assert extract.main_text(f"<article><p>a &lt;p&gt; &amp;amp; &#233;&nbsp;b\n\t c <!-- no --> d{LONG}") == f"a <p> &amp; é b c d{LONG}"
    assert extract.main_text(f"<article><p title=don't>{LONG}</p></article>") == LONG
    assert extract.main_text(f"<main><form><p>{MORE}</p></form><p>{LONG}") == LONG
    assert extract.main_text("<p>unclosed <b") == ""
    for odd in (None, "", "<", "<>", "</p>", "<!--", "<script>", "&", "x" * 10):
        assert extract.main_text(odd) == ""


def test_rows_columns_and_empty_table(spark):
    rows = [(1, "u", f"<article>{LONG}</article>", "c"), (1, "u", f"<article>{LONG}</article>", "c"), (None, None, None, None), (2, "u", f"<article><p>{LONG}</p>" + "<p>" + "word " * 200_000 + "</article>", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, extract.digest(extract.extracted(pages, ["page_id", "url"])).collect()), key=repr)
    assert [(i, n) for i, _, _, n in got] == [(1, len(LONG)), (1, len(LONG)), (2, len(LONG) + 1 + 999_999), (None, 0)]
    assert extract.extracted(pages, pages.columns).first().doc["text"] == "c"
    assert extract.extracted(pages.where("false"), ["page_id"]).count() == 0


def test_blocks_match_brute_force():
    import random

    rng = random.Random(1)
    for _ in range(300):
        w = [rng.choice([0, 0, 0, 10, 50, 90, 200]) for _ in range(rng.randrange(20))]
        out, i = [], 0
        sums = [sum(w[k : k + 3]) for k in range(len(w))]
        while i < len(w):
            if sums[i] > 80 and w[i]:
                j = i + 1
                while j < len(w) and sums[j] > 0:
                    j += 1
                out.append((i, j))
                i = j
            i += 1
        assert extract.blocks(w) == out
