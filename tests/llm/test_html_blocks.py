import numpy as np
import pytest

from florilege.llm.html_blocks import FEATURES, HIDDEN, Labeller, Page, extract, main_texts, pad, scan, trained, training_set


@pytest.fixture(scope="module")
def model():
    return trained()


def test_scan():
    page = "<!DOCTYPE html><body><!-- <p>no</p> --><div class='a-b'>one <b>two</b>&amp; 3<br>4<script>var x = '</p>';</script> five</div><p>six<p>seven &#233;\n\t x</p><style>p{}</style><ul><li><a href='>'>eight</a><li>nine</ul>tail"
    blocks = scan(page)
    assert [b.text for b in blocks] == ["one two& 3 4", "five", "six", "seven é x", "eight", "nine", "tail"]
    assert [b.path.tag for b in blocks] == ["div", "div", "p", "p", "li", "li", "body"] and blocks[0].path.words == ("a", "b")
    assert blocks[4].linked == 5 and not blocks[5].linked


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<!--", "<script>", "</div></div>", "<a><b>", "a < b & c", "<p class=\"x", "&#0; &bogus;", "<div/>", "\x00<p>\ud800</p>"[:6]])
def test_odd_pages_do_not_crash(model, page):
    assert isinstance(main_texts([page], model)[0], str)


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    model = Labeller(1)
    rows = [rng.normal(size=(n, FEATURES)).astype(np.float32) for n in (5, 3)]
    x, lengths = pad(rows)
    y = (rng.random((5, 2)) > 0.5).astype(np.float32)
    mask = np.arange(5)[:, None] < lengths

    def loss():
        z = model.logits(x, lengths).astype(np.float64)
        return float(((np.logaddexp(0, z) - y * z) * mask).sum() / mask.sum())

    grad = model.gradients(x, y, lengths)
    for k in model.w:
        flat = model.w[k].reshape(-1)
        for at in rng.integers(0, len(flat), 4):
            was = flat[at]
            flat[at] = was + 1e-2
            up = loss()
            flat[at] = was - 1e-2
            down = loss()
            flat[at] = was
            assert grad[k].reshape(-1)[at] == pytest.approx((up - down) / 2e-2, abs=2e-3)
    assert HIDDEN * 4 == model.w["hf"].shape[1]


def test_held_out_accuracy(model):
    held = training_set(200, 4242)
    found = np.concatenate(model.label([x for x, _ in held]))
    want = np.concatenate([y for _, y in held]) > 0
    assert (found & want).sum() / found.sum() > 0.92 and (found & want).sum() / want.sum() > 0.92


def test_templates(model):
    page = """<html><head><title>T</title></head><body><div id="cookie-notice">We use cookies to improve your experience. <button>Accept</button></div>
    <header><div class="logo">Daily News</div></header><nav class="menu"><ul><li><a href="/">Home</a></li><li><a href="/s">Sports</a></li></ul></nav>
    <div class="post-content"><h1>Rivers rise after rain</h1><p>The river rose &amp; fell   again, as it had for years.</p><p>People along the bank moved their boats before the night came.</p></div>
    <div class="sidebar"><h3>Related articles</h3><ul><li><a href="/1">Other story</a></li></ul></div>
    <section class="comments"><div class="comment"><p>Great post, I liked it a lot.</p></div></section>
    <form class="newsletter"><label>Your email</label><input><button>Subscribe</button></form><footer>&copy; 2024 Daily News. All rights reserved.</footer></body></html>"""
    assert main_texts([page], model) == ["Rivers rise after rain The river rose & fell again, as it had for years. People along the bank moved their boats before the night came."]


def test_long_page(model):
    page = "<nav><a href='/'>Home</a></nav><article>" + "".join(f"<p>Line {i} of a very long article, that goes on.</p>" for i in range(5000)) + "</article><footer>© all rights reserved</footer>"
    text = main_texts([page], model)[0]
    assert text.startswith("Line 0 of") and text.endswith("Line 4999 of a very long article, that goes on.") and text.count("Line") == 5000


def test_rows(spark, model):
    rows = [(1, "u", "<article><p>Some words of a story that is told here.</p></article>", "x"), (1, "u", "<article><p>Some words of a story that is told here.</p></article>", "x"), (None, None, None, "y"), (3, "v", "", "")]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), model=model).collect()
    said = "Some words of a story that is told here."
    assert sorted(map(tuple, got), key=str) == sorted([(1, "u", said, len(said))] * 2 + [(None, None, "", 0), (3, "v", "", 0)], key=str)
    assert extract(spark.createDataFrame([], "page_id long, url string, html string"), model=model).collect() == []


@pytest.mark.parametrize("page, want", [
    ("<body><datalist><option value=a>x<option value=b>y</datalist><p>article</p></body>", ["article"]),
    ("<div><datalist><option>x</datalist></div><p>article</p><select><option>z</option></select>", ["article"]),
    ("<div><object data=f><div>no</div>old</div><p>article</p>", ["article"]),
    ("<div><object><div>no</div></object>yes</div><p>article</p>", ["yes", "article"]),
    ("<object>said<p>article</p>", ["said", "article"]),
    ("<p>one</p><script>two<p>three</p>", ["one"]),
])
def test_raw_elements_without_end_tag(page, want):
    assert [b.text for b in scan(page)] == want


@pytest.mark.parametrize("page, want", [
    ("<p>a</p><a href=\"x\"\">link words</a><p>next one</p><p class=\"q\">zz</p>", ["a", "link words", "next one", "zz"]),
    ("<p title=it's>hello world</p><p>second</p><p>don't</p>", ["hello world", "second", "don't"]),
    ("<p title=\"never closed>hello</p><p>second</p>", ["hello", "second"]),
    ("<a href=a'b title='x>y'>one</a><p a=b/c/>two</p>", ["one", "two"]),
    ("<script src=\"a.js\"/>var x=1;</script><p>text</p>", ["text"]),
    ("<script>a</scripty>b</script ><p>text</p>", ["text"]),
    ("<div/>in<p>text</p><svg/><p>more</p>", ["in", "text", "more"]),
    ("<!--><p>one</p><!-- x --!><p>two</p></ bogus><p>three</p>", ["one", "two", "three"]),
    ("<p>1 < 2 and a<b</p>", ["1 < 2 and a"]),
])
def test_tags_by_the_html_rules(page, want):
    assert [b.text for b in scan(page)] == want


def test_every_class_word_counts():
    words = " ".join(f"w{chr(97 + i)}" for i in range(20))
    assert len(scan(f"<div class='{words}'>x</div>")[0].path.words) == 20


def test_slices_equal_the_whole_page(model):
    page = max((x for x, _ in training_set(100, 99)), key=len)
    x, lengths = pad([page])
    assert np.abs(model.logits(x, lengths)[:, 0] - model.long_logits(page, 7)).max() < 1e-4


#: Pages by hand, none from the generator; what is article stands between « and ».
LAYOUTS = {
    "paper": "<body class=home><div id=wrapper><div id=\"masthead\"><a href=/><b>The Local Paper</b></a></div><ul class=main-menu><li><a href=/a>World</a><li><a href=/b>Money</a></ul><div class=\"hentry post-12\"><h1 class=entry-title>«Council votes for new bridge»</h1><div class=\"entry-content\"><p>«The council voted on Tuesday to build a <a href=/t>new bridge</a> across the river, after years of talk.»</p><blockquote>«We have waited long enough.»</blockquote><h2>«What comes next»</h2><ul><li>«Plans by spring»</li><li>«Work from autumn»</li></ul><p>«Costs are put at 3.5 million.»</p></div></div><div id=sidebar><h3>Popular</h3><ul><li><a href=/1>Ten tips</a></ul></div><div id=comments><h3>2 Comments</h3><ol><li><p>Finally!</p><li><p>Too expensive if you ask me.</p></ol></div><div id=footer>Copyright 2023 The Local Paper</div></div>",
    "plain": "<h1>«Notes on bread»</h1><p>«Bread needs flour, water and time.»</p><p>«Knead it for ten minutes, then wait.»<p>«Bake it hot.»",
    "essay": "<body><header><a href=/>Site</a><nav><a href=/x>X</a> <a href=/y>Y</a></nav></header><main><h1>«On walking»</h1><p>«Walking is slow. That is what is good about it.»</p><figure><img src=a><figcaption>«A path by the sea»</figcaption></figure><p>«One sees what one passes.»</p></main><aside><p>More essays</p></aside><footer><p>Imprint</p></footer>",
    "table": "<table><tr><td class=nav><a href=/>Home</a><br><a href=/l>Links</a></td><td class=content><h1>«My trip»</h1><p>«We left early in the morning and drove along the coast until noon.»</p><p>«It rained all day, and we did not mind.»</p></td></tr></table>",
    "manual": "<div class=navbar><a href=/>Docs</a></div><div class=toc><ul><li><a href=#i>Install</a><li><a href=#u>Use</a></ul></div><div class=page-body><h1>«Install»</h1><p>«Run the following command.»</p><pre>«make install»</pre><p>«Then restart the service.»</p><table><tr><th>«Option»</th><th>«Meaning»</th></tr><tr><td>«quiet»</td><td>«no output at all»</td></tr></table></div><div class=pager><a href=/n>Next</a></div>",
    "news": "<div class='cookie-banner'><p>We use cookies to improve your experience.</p><button>Accept all</button></div><article><h1>«Storm passes»</h1><p>«The storm passed over the island in the night.»</p><div class=ad>Advertisement Buy now cheap boots</div><p>«No one was hurt, the harbour master said.»</p><aside class=related><h3>Related articles</h3><ul><li><a href=/1>Storm nears</a></ul></aside></article><footer>All rights reserved</footer>",
    "comments": "<nav><a href=/>Home</a></nav><article><h1>«Title of it»</h1><p>«One para story told in full here.»</p><section class='comments'><h3>Comments</h3><p>nice one</p><p>I agree with this.</p></section></article><footer>x</footer>",
    "newsletter": "<main><h1>«Title of it»</h1><p>«One para story told in full here.»</p><p>«Second para of the same story.»</p><div class=newsletter><p>Sign up for our newsletter</p><form><input><button>Go</button></form></div></main><footer>© x</footer>",
    "bare": "<body><p>«One para story told in full here.»</p><p>«Second para of the same story.»</p>",
    "one div": "<div id=a><p>«One para story told in full here.»</p><p>«Second para of the same story.»</p></div>",
    "divs": "<div><div><h2>«Title»</h2><p>«Some text, which goes on for a while and then ends.»</p><p>«More of it.»</p></div></div>",
    "german": "<nav><a href=/>Start</a></nav><div id=inhalt><h1>«Der Fluss»</h1><p>«Der Fluss stieg in der Nacht um einen Meter, sagte die Feuerwehr.»</p><p>«Am Morgen sank er wieder.»</p></div><div class=footer>Impressum</div>",
}


def test_pages_by_hand(model):
    right = kept = wanted = 0
    for name, page in LAYOUTS.items():
        want = [b.text.startswith("«") for b in scan(page)]
        blocks = scan(page.replace("«", "").replace("»", ""))
        assert len(blocks) == len(want)
        text = main_texts([page.replace("«", "").replace("»", "")], model)[0]
        found = model.label([Page(blocks)])[0]
        assert text == " ".join(b.text for b, keep in zip(blocks, found) if keep) and text, name
        right, kept, wanted = right + sum(f and w for f, w in zip(found, want)), kept + sum(found), wanted + sum(want)
    assert right >= 0.95 * kept and right >= 0.9 * wanted, (right, kept, wanted)


@pytest.mark.parametrize("name", ["paper", "plain", "essay", "news", "comments", "newsletter", "bare", "one div"])
def test_whole_texts_of_pages_by_hand(model, name):
    page = LAYOUTS[name]
    want = " ".join(b.text[1:-1] for b in scan(page) if b.text.startswith("«"))
    assert main_texts([page.replace("«", "").replace("»", "")], model) == [want]


@pytest.mark.parametrize("page", ["<div class='a b'>x" * 50_000, "<div>x" * 25_000 + "</p></div>y" * 25_000, "<b>" * 50_000 + "x", "<ul><li>x" * 25_000 + "</i></ul>" * 25_000])
def test_deep_pages_take_memory_by_their_size(model, page):
    import tracemalloc

    tracemalloc.start()
    blocks = scan(page)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000 and sum(len(b.text.split()) for b in blocks) == page.count("x") + page.count("y")
    assert len(main_texts([page], model)[0].split()) <= sum(len(b.text.split()) for b in blocks)


def plain_forward(w, x):
    """Log odds of each block of one page, by the definition of the network: one block, one gate, one unit at a time."""
    import math

    sigma = lambda v: 1 / (1 + math.exp(-v))

    def run(rows, d):
        h, c, out = [0.0] * HIDDEN, [0.0] * HIDDEN, []
        for row in rows:
            z = [sum(float(a) * float(w["x" + d][k][j]) for k, a in enumerate(row) if a) + sum(h[k] * float(w["h" + d][k][j]) for k in range(HIDDEN)) + float(w["c" + d][j]) for j in range(4 * HIDDEN)]
            c = [sigma(z[HIDDEN + k]) * c[k] + sigma(z[k]) * math.tanh(z[3 * HIDDEN + k]) for k in range(HIDDEN)]
            h = [sigma(z[2 * HIDDEN + k]) * math.tanh(c[k]) for k in range(HIDDEN)]
            out.append(h)
        return out

    ahead, back = run(x, "f"), run(x[::-1], "b")[::-1]
    return [sum((f + b)[k] * float(w["o"][k]) for k in range(2 * HIDDEN)) + float(w["p"][0]) for f, b in zip(ahead, back, strict=True)]


def test_forward_pass_against_a_plain_one(model):
    for x, _ in training_set(2, 77):
        x = x[:12]
        lengths = np.array([len(x)])
        assert model.logits(x[:, None, :], lengths)[:, 0] == pytest.approx(plain_forward(model.w, x), abs=1e-3)
