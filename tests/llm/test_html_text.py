"""Main text of small pages."""

import pytest

from snapmerge.llm import html_text

LONG = "A sentence that is long enough to look like the running text of an article, with some more words at its end."
CASES = [
    (None, ""), ("", ""), ("plain words", "plain words"),
    (f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><a href=x>Home</a></nav><article><h1>Head</h1><p>{LONG}<p>To.<p>{LONG}</article><footer>&copy; me</footer>",
     f"Head\n\n{LONG}\n\nTo.\n\n{LONG}"),
    (f"<body><div class='site-menu'><ul><li><a>One</a><li><a>Two</a></ul></div><div><p>{LONG}</p><p>{LONG}</p><p>short</p><p>{LONG}</p></div><div id=comments><p>{LONG}</p></div></body>",
     f"{LONG}\n\n{LONG}\n\nshort\n\n{LONG}"),
    ("<article><p><b>bold &amp; <i>nested</b> text&nbsp;&#233;<br>next\n\t line</p><script>var t='</p>';</script><form><label>Name</label></form></article>",
     "bold & nested text é next line"),
    (f"<main><p>{LONG}</p><aside><p>{LONG}</p></aside><p hidden>{LONG}</p></main><div class='cookie-notice'>{LONG}</div>", LONG),
    ("<article><p>cut off in a tag</p><p>and <b", "cut off in a tag\n\nand"),
    (f"<body class='has-sidebar'><nav><ul><li><a>Menu</a><div class='content-with-sidebar'><article><div class='article-header'><h1>Head</h1></div><p>{LONG}</p></article></div>"
     f"<section id='comments'><article class='comment'><p>{LONG}</p></article></section>", f"Head\n\n{LONG}"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", "one\n\ntwo\n\na\n\nb"),
]


@pytest.mark.parametrize("html, text", CASES)
def test_main_text(html, text):
    assert html_text.main_text(html) == text


def test_frames(spark):
    rows = [(i, h, "u", "z") for i, (h, _) in enumerate(CASES)] + [(0, CASES[3][0], None, None), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, url string, text string")
    out = html_text.extract(pages)
    assert sorted(out.columns) == ["n_chars", "page_id", "text", "url"]
    got = [(r.page_id, r.text, r.n_chars) for r in out.collect()]
    want = [(r[0], html_text.main_text(r[1]), len(html_text.main_text(r[1]))) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_long_page():
    page = "<article>" + "".join(f"<p>{LONG} {i}</p>" for i in range(5000)) + "</article>"
    assert html_text.main_text(page).count("\n\n") == 4999


HEADED = f"Head\n\n{LONG}\n\nTo.\n\n{LONG}"


@pytest.mark.parametrize("html, text", [
    (f"<body><form id=aspnetForm role=form><nav>Menu</nav><article><h1>Head</h1><p>{LONG}<p>To.<p>{LONG}</article><footer>me</footer></form>", HEADED),
    (f"<body><form><div><p>{LONG}</p><p>{LONG}</p></div><label>Name</label><button>Go</button></form>", f"{LONG}\n\n{LONG}"),
    (f"<body><form><article><p>{LONG}</p><fieldset><legend>Pick</legend><label>Name</label><input></fieldset></article></form>", LONG),
    (f"<article><p>{LONG}</p><p>{LONG}</p><form><p>Write to us</p><label>Name</label></form></article>", f"{LONG}\n\n{LONG}"),
    (f"<body><form class=search-form><p>{LONG}</p></form><div><p>{LONG}</p></div>", LONG),
])
def test_forms(html, text):
    assert html_text.main_text(html) == text


PARAGRAPHS = [f"{k} " + "x" * 298 for k in "abcde"]
FIVE = "".join(f"<p>{t}</p>" for t in PARAGRAPHS)
MENU = "<div><ul><li><a href=x>One more place</a><li><a href=y>Another place</a></ul></div>"


@pytest.mark.parametrize("before, inside, after, extra", [
    ("", f"<h1>A headline of thirty letters</h1>{FIVE}", "", ["A headline of thirty letters"]),
    ("<nav>Menu</nav>", f"{FIVE}<p>A short closing paragraph.</p>", "<footer>me</footer>", ["A short closing paragraph."]),
    (MENU, f"<h1>Head</h1><p>By me</p>{FIVE}<p>The end.</p>", MENU, ["Head", "By me", "The end."]),
    (f"{MENU}<div><h1>Head</h1></div>", f"<p>By me</p>{FIVE}<p>The end.</p>", "<div>Copyright</div>", ["Head", "By me", "The end."]),
])
@pytest.mark.parametrize("box", ["<div class=content>{}</div>", "<div id=page><div>{}</div></div>", "{}"])
def test_short_first_and_last_block_without_region(before, inside, after, extra, box):
    got = html_text.main_text(f"<body>{before}{box.format(inside)}{after}</body>").split("\n\n")
    end = [t for t in extra if "end." in t or "closing" in t]
    assert got == [t for t in extra if t not in end] + PARAGRAPHS + end


STORY = f"<h1>Head</h1>{FIVE}<p>The end.</p>"
STORY_TEXT = ["Head", *PARAGRAPHS, "The end."]


@pytest.mark.parametrize("html", [
    f"<body><div class=content>{STORY}</div><article class=card><h3>Another story</h3></article></body>",
    f"<body><div class=content>{STORY}</div><article class=card><p>Read this too</p></article><article class=card><p>And this one</p></article></body>",
    f"<body><div id=page class='site social-enabled'><article>{STORY}</article></div></body>",
    f"<body><div class='layout-sidebar'><nav>Menu</nav><article>{STORY}</article><div class=sidebar><p>{LONG}</p></div></div></body>",
    f"<body><div class='post-widget'><article>{STORY}</article></div></body>",
    f"<body><div class='page widget-area-left'><article>{STORY}</article></div></body>",
    f"<body><div class='comments-open page'><article>{STORY}</article></div></body>",
    f"<body><div class='layout-sidebar'><div>{STORY}</div><div class=related><p>{LONG}</p></div></div></body>",
    f"<body><article>{STORY}</article><div id=comments>{FIVE * 3}</div></body>",
    f"<body><div class=related><article><p>{LONG}</p></article></div><article>{STORY}</article></body>",
    f"<body><article><button>Go{STORY}</article></body>",
])
def test_wrappers_and_teasers(html):
    assert html_text.main_text(html).split("\n\n") == STORY_TEXT


def test_deep_nesting_takes_little():
    import time
    import tracemalloc
    page = "<div>x y " * 100_000
    tracemalloc.start()
    began = time.time()
    text = html_text.main_text(page)
    took, (_, most) = time.time() - began, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert text.count("x y") == 100_000 and most < 200e6 and took < 60
    assert html_text.main_text("<form class=menu>" * 3000 + "<p>text" + "</i>" * 3000) == "text"
