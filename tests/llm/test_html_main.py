import time

import numpy as np
import pytest

from tidewheel.llm import html_main as H


@pytest.fixture(scope="module")
def field():
    return H.train()


def test_held_out_pages(field):
    wrong = total = 0
    for p in H.labelled_pages(150, seed=77):
        found = H.blocks(p)
        wrong += sum(b.main != bool(y) for b, y in zip(found, field.decode(H.features(found))))
        total += len(found)
    assert wrong < 0.005 * total


PAGES = {
    "plain": ("<html><body><nav><ul><li><a href=x>Home</a></ul></nav><article><h1>A title</h1><p>First  &amp;\n second.<p>Third&nbsp;one <b>bold</b>text.</article><footer>&copy; me</footer></body></html>", "A title\nFirst & second.\nThird one boldtext."),
    "unclosed": ('<body><div class="ad">Buy now, it is cheap.</div><article><p><b>Open bold text here.<br><p>More text.</article><footer>x</footer>', "Open bold text here.\nMore text."),
    "script": ('<article><script>var t="</p><p>no";</script><style>p{}</style><!-- <p>no</p> --><p>Yes, this one.</p><noscript><p>no</p></noscript></article>', "Yes, this one."),
    "comments": ('<main><article><h1>Title of it</h1><p>The story is told here, at length.</p></article></main><section class="comments"><h2>Comments</h2><article class="comment"><p>I like it, thank you.</p></article></section>', "Title of it\nThe story is told here, at length."),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages(field, name):
    page, want = PAGES[name]
    assert H.main_text(page, field) == want


def test_viterbi_against_all_labellings():
    draw = np.random.default_rng(5)
    for _ in range(30):
        f = H.Field(draw.normal(size=(H.WIDTH, 2)), draw.normal(size=(2, 2)), draw.normal(size=2))
        rows = [sorted(draw.choice(H.WIDTH, 4, replace=False).tolist()) for _ in range(6)]
        e = [f.emission[r].sum(axis=0) for r in rows]

        def value(y):
            return f.start[y[0]] + sum(e[i][y[i]] for i in range(6)) + sum(f.transition[y[i], y[i + 1]] for i in range(5))

        best = max((tuple(map(int, np.binary_repr(k, 6))) for k in range(64)), key=value)
        assert tuple(f.decode(rows)) == best


def test_frame(spark, field):
    long = "<article>" + "<p>Some words, again and again.</p>" * 30_000 + "</article>"
    rows = [(1, None, "mine"), (2, "", "mine"), (3, "<", "mine"), (4, "no markup at all", "mine"), (5, long, "mine"), (5, long, "mine"), (6, "<p title='" + "x" * 50_000, "mine"), (7, "</p></div>" * 5_000, "mine")]
    df = spark.createDataFrame(rows, "page_id bigint, html string, text string")
    out = H.extract(df, field).collect()
    assert len(out) == len(rows) and all(r.text is not None for r in out)
    by = {r.page_id: r.text for r in out}
    assert by[1] == by[2] == "" and by[5].count("\n") == 29_999
    assert H.extract(df.limit(0), field).count() == 0
    assert H.Field.train([]).decode([]) == []


def test_digits_are_counted_over_the_whole_block():
    figures, words = ("12345 " * 40), ("plain words " * 200)
    has = lambda text: H._INDEX["digits"] in H.features([H.Block(text, 0, None)])[0]
    assert not has(figures + words) and has("plain words " * 20 + figures * 20) and has(figures)


#: Written by hand, unlike the composed pages that the field is trained on: page, its main blocks.
HAND = {
"news": ("""<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>Harbour reopens | The Daily</title><script>window.x={"a":"<p>no</p>"};</script></head>
<body class="home page"><header class="site-header"><a href="/" class="logo">The Daily</a><nav class="main-nav"><ul><li><a href="/w">World</a></li><li><a href="/s">Sport</a></li></ul></nav></header>
<div class="breadcrumb"><a href="/">Home</a> &rsaquo; <a href="/w">World</a></div>
<main id="content"><article class="story"><h1>Harbour reopens after storm</h1><p>The harbour of the old town opened again on Monday, two weeks after the storm closed it.</p><figure><img src="h.jpg"><figcaption>Boats in the harbour on Monday morning.</figcaption></figure>
<p>&ldquo;We are glad,&rdquo; said the harbour master, who had slept in the office since the storm began.</p><div class="ad-slot"><p>Advertisement: the best shoes of the year are here.</p></div><p>Fishing boats left first; ferries will follow next week, the company said in a statement.</p></article></main>
<aside class="sidebar"><h3>Most read</h3><ul><li><a href="1">Ten walks in the hills</a></li><li><a href="2">What to cook tonight</a></li></ul></aside>
<section id="comments" class="comments"><h2>2 comments</h2><div class="comment"><p>About time, I missed the ferry.</p></div><div class="comment"><p>Great news for the town, well done everyone.</p></div></section>
<footer><p>&copy; 2020 The Daily. All rights reserved.</p></footer></body></html>""",
["Harbour reopens after storm","The harbour of the old town opened again on Monday, two weeks after the storm closed it.","Boats in the harbour on Monday morning.","“We are glad,” said the harbour master, who had slept in the office since the storm began.","Fishing boats left first; ferries will follow next week, the company said in a statement."]),
"blog": ("""<html><head><title>On bread</title></head><body><div id="wrapper"><div id="masthead"><h1><a href="/">Crumbs</a></h1><p>Notes on baking</p></div><ul id="menu"><li><a href="/about">About</a><li><a href="/archive">Archive</a></ul>
<div class="post"><h2 class="entry-title">On bread, again</h2><div class="entry-content"><p>I baked a loaf with rye today, and it turned out far better than the last one did.<p>Three things helped:<ul><li>more water than the book says<li>a longer rest in the cold<li>a hotter oven</ul><blockquote>Bread is patience made edible.</blockquote><p>Next time I will try spelt.</div></div>
<div id="respond" class="reply-form"><form action="/c"><label>Name</label><input name="n"><textarea>Leave a reply</textarea><button>Post</button></form></div>
<div class="widget newsletter"><p>Get new posts by mail every Friday. No spam, ever.</p></div><div id="footer"><p>Powered by flour and water.</p></div></div></body></html>""",
["On bread, again","I baked a loaf with rye today, and it turned out far better than the last one did.","Three things helped:","more water than the book says","a longer rest in the cold","a hotter oven","Bread is patience made edible.","Next time I will try spelt."]),
"docs": ("""<html><head><title>join</title></head><body><div class="topbar"><a href="/">Docs</a><form class="search"><input><button>Search</button></form></div><div class="container"><nav class="toc"><ul><li><a href="#a">Syntax</a></li><li><a href="#b">Examples</a></li></ul></nav>
<main><h1>join</h1><p>Joins the parts of a list into one text, with a separator between each two of them.</p><h2>Syntax</h2><pre>join(list, separator)</pre><h2>Examples</h2><table><tr><th>Call</th><th>Result</th></tr><tr><td>join([a, b], "-")</td><td>a-b</td></tr></table><p>An empty list gives an empty text.</p></main></div><footer class="legal">Terms | Privacy</footer></body></html>""",
["join","Joins the parts of a list into one text, with a separator between each two of them.","Syntax","join(list, separator)","Examples","Call","Result",'join([a, b], "-")',"a-b","An empty list gives an empty text."]),
"german": ("""<html><head><title>Wetter</title></head><body><div class="cookie-banner"><p>Diese Seite verwendet Cookies. Bitte stimmen Sie zu.</p><button>Zustimmen</button></div><div role="navigation"><a href=1>Start</a> <a href=2>Karte</a> <a href=3>Archiv</a></div>
<section class="article"><h1>Regen im Süden</h1><p>Im Süden regnet es heute bis in den Abend, im Norden bleibt es trocken und sonnig.</p><p>Morgen wird es überall wärmer; nur an der Küste weht ein frischer Wind.</p></section><div class="related"><h4>Mehr zum Thema</h4><a href=4>Hochwasser am Rhein</a></div><footer>© Wetterdienst</footer></body></html>""",
["Regen im Süden","Im Süden regnet es heute bis in den Abend, im Norden bleibt es trocken und sonnig.","Morgen wird es überall wärmer; nur an der Küste weht ein frischer Wind."]),
"bare": ("""<h1>Ferry times</h1><p>The first ferry leaves at six, the last one at ten in the evening.</p><p>On Sundays there is none before nine.</p>""",
["Ferry times","The first ferry leaves at six, the last one at ten in the evening.","On Sundays there is none before nine."]),
"nohead": ("""<html><head><title>T</title><meta name=x><article><h1>Bees</h1><p>Bees dance to tell each other where the flowers are.</p></article><footer>&copy; B</footer>""",["Bees","Bees dance to tell each other where the flowers are."]),
}


@pytest.mark.parametrize("name", HAND)
def test_pages_of_another_origin(field, name):
    page, want = HAND[name]
    assert H.main_text(page, field).split("\n") == want


#: Markup that takes quadratic time if every tag looks anew for its end, its element or its ancestors.
HOSTILE = {
    "nested": "<div>x" * 100_000, "no end": "<a " * 500_000, "quotes": '<a ">"' * 200_000 + "'", "blocked end tags": "<b><div>" + "<span>" * 50_000 + "</b>" * 100_000, "headings": "<span>" * 100_000 + "<h2>x</h2>" * 50_000,
    "end tags": "<div>" * 100_000 + "</p>" * 100_000, "declarations": "<!" * 300_000, "items": "<li>x" * 100_000, "paragraphs": "<p><b>x" * 100_000, "scripts": "<script>" * 100_000, "attributes": "<div class=" + "' class=" * 100_000 + ">x",
}


@pytest.mark.parametrize("name", HOSTILE)
def test_time_grows_with_the_length_only(field, name):
    start = time.process_time()
    H.main_text(HOSTILE[name], field)
    assert time.process_time() - start < 30


def test_odd_markup():
    text = lambda page: [b.text for b in H.blocks(page)]
    assert text("&#" + "9" * 5000 + ";&#" + "0" * 5000 + "65;&#x0041;&amp;amp;") == ["\ufffdAA&amp;"]
    assert text("<!-->a<!--->b<!-- x -->c<!-- d") == ["abc"]
    assert text("<p title='a>b'>c<p title=\"d>e") == ["c", 'e']
    assert text("<script>a</script >b<textarea>c<p>d</textarea>e<script>f") == ["b", "c<p>d", "e"]
    assert text("1 < 2 <3 </4 <") == ["1 < 2 <3 </4 <"]
    assert text("<head>no<div>yes") == ["yes"] and text("<b>a<div>b</b>c</div>d") == ["a", "bc", "d"]
    assert text("<ul><li>a<ul><li>b<li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]


def test_training_is_done_once():
    assert H.train() is H.train()


def test_no_text_is_lost_beside_elements_without_an_end():
    text = lambda page: [b.text for b in H.blocks(page)]
    rest = "<p>Two.</p><p>Three.</p></article>"
    for odd in ("<object data=x>", "<object data=x />", "<svg>", "<svg><path d='M0'/>", "<noscript>", "<template>", "<iframe src=x>", "<iframe src=x />", "<math><mi>", "<svg><title>t"):
        assert text(f"<article><p>One.</p>{odd}{rest}")[-2:] == ["Two.", "Three."], odd
    for hidden in ("<svg><g><svg><text>no</text></svg><text>no</text></g></svg>", "<template><p>no</p><template><p>no</p></template><p>no</p></template>", "<noscript><div>no<p>no</noscript>", "<svg><foreignObject><p>no</p></foreignObject><text>no</text></svg>", "<svg><title>no</title><desc>no</desc></svg>", "<noframes>no</noframes>"):
        assert text(f"<article><p>One.</p>{hidden}{rest}") == ["One.", "Two.", "Three."], hidden
    assert text("<p>As <math><mi>a</mi><mo>=</mo><mn>2</mn><annotation encoding=x>a=2</annotation></math> is so.<svg><text>no</text></svg> Yes.</p>") == ["As a=2 is so. Yes."]
    assert text("<p>See <object data=x><p>the fallback</object> here.") == ["See", "the fallback here."]
    assert text("<div><svg><g>no</div><p>Yes.</p><svg>no</svg>") == ["Yes."]  # the block's end tag ends what is open in it
    assert text("<svg><path/><circle r=1/></svg>Shown<p>more") == ["Shown", "more"]
    assert text("<head><noscript><div>no</div></noscript><title>no</title></head><body>yes") == ["yes"]


@pytest.mark.parametrize("page", ["<svg>" * 100_000 + "x", "<svg><title>" * 50_000 + "x", "<template>" * 100_000 + "x</template>", "<noscript><p>" * 50_000 + "</noscript>", "<iframe>" * 100_000, "<math><p>" * 50_000])
def test_time_of_elements_without_an_end(field, page):
    start = time.process_time()
    H.main_text(page, field)
    assert time.process_time() - start < 30
