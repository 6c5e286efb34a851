import random

import numpy as np
import pyarrow as pa

from precedent.llm import html_extract as he

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- ad --><div class="ad">Buy this.</div>
<article><h1>Head &amp; {n}</h1><p><b>First  {n}<br><p>Second\n line &eacute;.</p><aside>side</aside></article>
<section class="comments"><p>I disagree {n}</p></section><form>Name</form><footer>&copy; host</footer></body></html>"""


def test_structure():
    assert he.blocks_of(PAGE.format(n=1)) == [("Head & 1", True), ("First 1", True), ("Second line é.", True)]
    assert he.blocks_of("") == [] and he.blocks_of("just text < 5") == [("just text < 5", False)]
    assert he.blocks_of("<p>cut off <b") == [("cut off <b", False)] or he.blocks_of("<p>cut off <b") == [("cut off < b", False)]


def test_suffix_ranks_equal_sorting():
    rng = np.random.default_rng(1)
    stream = rng.integers(0, 3, 200)
    rank = he.suffix_ranks(stream, 4)
    keys = [tuple(stream[i : i + 4]) for i in range(len(stream))]
    order = {k: i for i, k in enumerate(sorted(set(keys)))}
    assert rank.tolist() == [order[k] for k in keys]


def test_repeats_across_pages_go(spark):
    rng = random.Random(2)
    rows = []
    for i in range(40):
        own = " ".join(f"w{rng.randrange(5000)}" for _ in range(30))
        rows.append((i, "http://a.example/p", f"<div>Welcome to our fine site today</div><div>{own}</div><div>All of this is by us alone</div>"))
    rows += [(50, "http://b.example/x", PAGE.format(n=2)), (51, None, None), (52, "http://c.example", ""), (52, "http://c.example", "")]
    rows += [(60, "http://d.example/", PAGE.format(n=3)), (60, "http://d.example/", PAGE.format(n=3))]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    found = he.main_texts(pages).collect()
    assert len(found) == len(rows)
    by = {r.page_id: r for r in found}
    for page_id, _, html in rows[:40]:
        assert by[page_id].text == html.split("<div>")[2].removesuffix("</div>")
    assert by[50].text == "Head & 2\nFirst 2\nSecond line é." and by[50].n_chars == len(by[50].text)
    assert by[51].text == "" and by[52].n_chars == 0 and by[60].text.startswith("Head & 3")
    assert he.main_texts(pages.limit(0)).count() == 0


def test_names_drop_whole_names_and_never_the_main_text():
    text = "<p>" + "long text of the page " * 5 + "</p>"
    own = he.blocks_of(text)
    for wrapper in ('class="content with-sidebar"', 'id="page" class="no-sidebar"', 'class="sidebar"', 'id="related-work"'):
        assert he.blocks_of(f"<div {wrapper}>{text}<div class='ad-slot'>Buy</div></div>") == own
    assert he.blocks_of(f'<div class="sidebar"><div>x</div><article>{text}</article></div>') == [(own[0][0], True)]
    assert he.blocks_of(f'<div class="post-header"><h1>Title</h1></div>{text}') == [("Title", False), *own]
    assert he.blocks_of(f'<div class="left-sidebar x"><p>aside</p></div>{text}<div id="site_footer">us</div>') == own


def _texts(spark, rows, **more):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in he.main_texts(pages, **more).collect()}


def _words(rng, n):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def test_runs_equal_exact_numbers():
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in rng.integers(0, 2, 300)]
    runs = he.runs_of([" ".join(words)], np.array([5]), he.WordHashes())
    exact = he.suffix_ranks(np.array([int(w[1:]) for w in words]), he.LONG_RUN)[: len(runs.key)]
    assert len(runs.key) == 300 - he.LONG_RUN + 1
    assert len(set(zip(runs.key.tolist(), exact.tolist()))) == len(set(runs.key.tolist())) == len(set(exact.tolist()))
    anchor = dict(zip(runs.key.tolist(), runs.anchor.tolist()))
    assert all(anchor[k] == a for k, a in zip(runs.key.tolist(), runs.anchor.tolist()))


def test_two_pages_of_a_large_host_are_enough(spark):
    rng = random.Random(4)
    own = [_words(rng, 20) for _ in range(1000)]
    notes = [_words(rng, 5 + 7 * (k % 2)) for k in range(500)]  # each on two pages far apart
    rows = [(i, "http://a.example/", f"<div>{notes[i % 500]}</div><div>{own[i]}</div>") for i in range(1000)]
    expected = dict(enumerate(own))
    assert _texts(spark, rows) == expected
    assert _texts(spark, rows, most=0) == expected  # every count by the join
    assert _texts(spark, rows[:20] + rows[500:520]) == {i: own[i] for i in (*range(20), *range(500, 520))}


def test_copies_keep_their_text_and_only_runs_are_cut(spark):
    rng = random.Random(5)
    foot = _words(rng, 12)
    own = [_words(rng, 60) for _ in range(8)]
    rows = [(i, "http://a.example/", f"<div>{own[i]} {foot}</div>") for i in range(8)]
    rows += [(10, "http://a.example/", rows[0][2]), (11, "http://a.example/", f"<div>{own[1]} updated {foot}</div>")]
    expected = dict(enumerate(own)) | {10: own[0], 11: f"{own[1]} updated"}
    assert _texts(spark, rows) == expected
    assert _texts(spark, rows, most=3) == expected


def test_broken_tags_take_linear_time():
    import time

    for piece in ("<a ' ", '<a " ', "<script ", "<!", "< ", "<a <", "<p '>x", "<b \"'> "):
        start = time.perf_counter()
        he.blocks_of("<p>before</p>" + piece * 100_000)
        assert time.perf_counter() - start < 8, piece


def test_tags_with_open_quotes_end_at_the_next_bracket():
    blocks = [text for text, *_ in he.blocks_of("<p>one</p><p class='x>two</p><p>three <b>bold</b></p> 1 < 2 <")]
    assert "two" in " ".join(blocks) and "three bold" in " ".join(blocks) and blocks[-1].endswith("1 < 2 <")


def test_runs_are_made_from_arrow_texts():
    texts = ["a b c d\né f  g", "", None, "x", "a b c d e f g h i\n\nz"]
    blocks = [t.split("\n") if t else [] for t in texts]
    lines = [(page, b.split(" ")) for page, own in enumerate(blocks) for b in own]
    runs = he.runs_of(pa.array(texts), np.arange(5), he.WordHashes())
    assert runs.words.to_pylist() == [w for _, line in lines for w in line]
    assert runs.page.tolist() == [page for page, line in lines for _ in line]
    assert runs.block.tolist() == [k for k, (_, line) in enumerate(lines) for _ in line]
    assert runs.at.tolist() == [0, 4, 9, 10] and runs.length.tolist() == [4, 4, 8, 8]
    none = he.runs_of(pa.array([None, ""], pa.string()), np.arange(2), he.WordHashes())
    assert not len(none.words) and not len(none.at)
