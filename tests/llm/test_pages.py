"""Main text of pages, host templates and broken markup."""

from pulsefold.llm import templates

PAGE = """<!DOCTYPE html><html><head><title>T {k}</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/">Home {k}</a></li></ul></nav><!-- ad --><div class="ad box">Buy {k}</div>
<article><div class="entry-header"><h1>Head &amp; {k}</h1></div><p><b>First&nbsp;  {k}<br><p>Second <i>part</i>s
of {k}</p><div class="comments"><p>Nice {k}</p></div><form>Mail {k}</form></article>
<footer>&copy; {k}</footer></body></html>"""
PLAIN = """<html><body><div id=top class="site-header">Site {k}</div><div class="wrap"><div class="story"><h2>Head {k}</h2><div>{long}</div>
<div>More {k} text here</div><div class="label">Filed under news</div></div><div class="side sidebar">Side {k}</div></div></body>"""


def texts(spark, frame, rows, settings=templates.Settings()):
    pages = frame("page_id long, url string, html string, host string, token long", *[(*r, "clash", 1) for r in rows])
    out = templates.main_text(pages, settings).collect()
    assert all(r.n_chars == len(r.text) for r in out) and len(out) == len(rows)
    return {r.page_id: r.text for r in out}


def test_article_pages(spark, frame):
    rows = [(k, f"https://a.example/{k}", PAGE.format(k=k)) for k in range(12)]
    rows += [(50, "https://alone.example/", PAGE.format(k=50)), (51, None, None), (52, "no url", ""), (53, "x://b.example", "just text"),
             (54, "https://b.example", "<article><p>cut off in the mid"), (55, "https://b.example", "<nav>only</nav>")]
    want = {k: f"Head & {k}\nFirst {k}\nSecond parts of {k}" for k in [*range(12), 50]}
    want |= {51: "", 52: "", 53: "just text", 54: "cut off in the mid", 55: ""}
    assert texts(spark, frame, rows) == want
    # The same through the salted join.
    assert texts(spark, frame, rows, templates.Settings(broadcast_tokens=0)) == want


def test_root_found_by_slots(spark, frame):
    rows = [(k, f"http://c.example/{k}", PLAIN.format(k=k, long=f"word{k} " * 80)) for k in range(12)]
    got = texts(spark, frame, rows)
    assert got == {k: f"Head {k}\n" + " ".join([f"word{k}"] * 80) + f"\nMore {k} text here" for k in range(12)}


def test_copies_of_one_page_keep_their_text(spark, frame):
    rows = [(k, f"http://d.example/{k}", PAGE.format(k="same")) for k in range(15)] + [(0, "http://d.example/0", PAGE.format(k="same"))]
    assert set(texts(spark, frame, rows).values()) == {"Head & same\nFirst same\nSecond parts of same"}
    assert templates.main_text(frame("page_id long, url string, html string")).count() == 0


def test_choice_of_root():
    rows = {1: (0, False, False, 1000), 2: (1, True, False, 900), 3: (1, False, False, 950), 4: (3, False, False, 100), 5: (3, False, False, 850), 6: (5, False, False, 400)}
    assert templates.choose(rows, 0.7) == [5]
    assert templates.choose({**rows, 7: (4, False, True, 10), 8: (7, False, True, 5)}, 0.7) == [7]
    assert templates.choose({}, 0.7) == [0]


def test_fixed_slots_at_every_number_of_pages(spark, frame):
    article = "<html><body><article><h1>Head {k}</h1><h2>Summary</h2><p>Text {k}</p><p>more</p></article></body></html>"
    rows = [(100 * n + k, f"https://a{n}.example/{k}", article.format(k=k)) for n in (2, 9, 12) for k in range(n)]
    want = {100 * n + k: f"Head {k}\nSummary\nText {k}\nmore" for n in (2, 9, 12) for k in range(n)}
    rows += [(10_000 + 100 * n + k, f"https://c{n}.example/{k}", PLAIN.format(k=k, long=f"word{k} " * 80)) for n in (2, 9, 12) for k in range(n)]
    want |= {10_000 + 100 * n + k: f"Head {k}\n" + " ".join([f"word{k}"] * 80) + f"\nMore {k} text here" for n in (2, 9, 12) for k in range(n)}
    assert texts(spark, frame, rows) == want


def test_an_element_once_below_a_repeated_one(spark, frame):
    page = """<html><body><div class="brand">Brand {k}</div><article><h1>Head {k}</h1><p><b>Bold {k}</b> one</p><p>two {k}</p><p>three</p></article>
<div class="legal">Terms {k}</div></body></html>"""
    rows = [(k, f"https://many.example/{k}", page.format(k=k)) for k in range(4)] + [(50, "https://alone.example/", page.format(k=50))]
    assert texts(spark, frame, rows) == {k: f"Head {k}\nBold {k} one\ntwo {k}\nthree" for k in [*range(4), 50]}


def test_several_layouts_on_a_host(spark, frame):
    story = "<h1>Head {k}</h1><p>" + "word{k} " * 30 + "</p><p>end</p>"
    layouts = [f'<div class="{c}bar">Brand</div><article class="{c}">{story}</article><div class="{c}foot">Terms</div>' for c in ("news", "blog", "tale")]
    words = f'<div class="brand">Brand</div><article class="post tag-{{t}}">{story}</article><div class="legal">Terms</div>'
    # A teaser of the article's class on two pages whose article is of another one, and on one that has it in a div.
    usual = f'<div class="brand">Brand</div><article class="post">{story}</article>'
    teaser = '<div class="brand">Brand</div><article class="post"><p>See {k}</p></article>' + f'<article class="review">{story}</article>'
    other = '<div class="brand">Brand</div><article class="post"><p>See {k}</p></article>' + f'<div class="review">{story}</div>'
    page = lambda k, form, **more: f"<html><body>{form.format(k=k, **more)}</body></html>"
    rows = [(k, f"https://l.example/{k}", page(k, layouts[k % 3])) for k in range(9)]
    rows += [(20 + k, f"https://w.example/{k}", page(20 + k, words, t="abcdefgh"[k])) for k in range(8)]
    rows += [(40 + k, f"https://t.example/{k}", page(40 + k, usual)) for k in range(7)]
    rows += [(k, f"https://t.example/{k}", page(k, teaser)) for k in (47, 48)] + [(49, "https://t.example/49", page(49, other))]
    body = lambda k: f"Head {k}\n" + " ".join([f"word{k}"] * 30) + "\nend"
    want = {k: (f"See {k}\n" if k in (47, 48) else "") + body(k) for k, *_ in rows}
    assert texts(spark, frame, rows) == want


def test_headings_stay_where_their_section_does(spark, frame):
    page = """<html><body><div class="brand"><h3>Daily</h3></div><div class="wrap"><div class="story"><h1>Head {k}</h1><h2>Summary</h2><p>{long}</p>
<h2><span>Details</span></h2><p>More {k} text here</p></div><div class="label"><h4>Filed under</h4><p>news</p></div></div></body></html>"""
    rows = [(k, f"http://h.example/{k}", page.format(k=k, long=f"word{k} " * 80)) for k in range(12)]
    got = texts(spark, frame, rows)
    assert got == {k: f"Head {k}\nSummary\n" + " ".join([f"word{k}"] * 80) + f"\nDetails\nMore {k} text here" for k in range(12)}
