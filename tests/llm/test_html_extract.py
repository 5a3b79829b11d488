from tidewire.llm import html_extract as h


def text(page):
    return h.main_text(page, h.decision_tree())


def test_tree_fits_its_table():
    x, y = h.labelled_table()
    assert [h.is_main(r, h.decision_tree()) for r in x.tolist()] == y.tolist() and len(y) < 200


def test_article_without_the_rest():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body class="has-menu">
    <nav><ul><li><a href=/a>Home</a></li></ul></nav><!-- ad --><div class="ad">Buy this now and then buy it again.</div>
    <div class="menu-layout"><article><h1>A &amp; B</h1><p><b>Bold start.<br><p>Second&nbsp; para
    graph with <a href=/l>a link</a>.<div class="comments"><p>I do not agree with any of this at all.</p></div><p>Be.</p></article></div>
    <aside>Read more about it here.</aside><form>Your name <input></form><footer>&copy; us</footer>"""
    assert text(page) == "A & B\nBold start.\nSecond para graph with a link.\nBe."


def test_hidden_and_odd_markup():
    assert text('<article><p hidden>no</p><p style="display: none">no</p><p title="a > b">yes &lt;tag&gt; 1 < 2 &#233;</p></article>') == "yes <tag> 1 < 2 é"
    assert text("<article><p>cut off <a href='x") == "cut off"
    assert text("<article><script>never closed <p>no") == ""
    assert text(None) == text("") == text("<p></p>") == ""


def test_loose_matches_drop_nothing():
    story = """<h2>How the mill was saved</h2><p>The old mill by the river had stood empty for thirty years when a few families of the village bought it
        together, and they have rebuilt its wheel with their own hands since then.</p><p>It turns again.</p><p>On Sundays they grind flour for all who come,
        and the children of the village school learn there how bread was made before there were shops, ovens and trucks to bring it.</p>"""
    want = text(f"<article>{story}</article>")
    assert want.startswith("How the mill was saved\n") and want.endswith("bring it.")
    for attribute in ('style="overflow:hidden"', 'class="overflow-hidden"', "data-hidden=1", 'class="content has-sidebar"', 'title="hidden"', 'class="post tags"'):
        assert text(f"<body><div {attribute}><article>{story}</article></div></body>") == want, attribute
        assert text(f"<body><div {attribute}>{story}</div></body>") == want, attribute
    assert text(f"<body><div class='layout-with-sidebar'>{story}<div class='cookie-notice'>We use cookies here.</div></div>") == want
    other = "<p>" + "Words of the menu that go on and on. " * 9 + "</p>"
    for foreign in (f"<nav>{other}</nav>", f"<footer>{other}</footer>", f"<div hidden>{other}</div>", f"<div class=comments>{other}</div>",
                    "<div class='ad'><p>Buy two now and get a third one for free.</p></div>"):
        assert text(f"<body><div>{story}</div>{foreign}</body>") == want, foreign
        assert text(f"<body><main>{story}{foreign}</main></body>") == want, foreign
    for tag in ("button", "svg", "noscript", "select"):
        assert text(f"<body><article><{tag}>{story}</article>") == want, tag
    assert text(f"<body><article><button>{story}<button>Send</button></article>") == want
    assert text("<article><p style='visibility:hidden'>no</p><p style='color:red; display:none'>no</p><p>yes</p></article>") == "yes"


def test_words_are_never_dropped_within_an_article():
    words = [f"w{i}" for i in range(20_000)]
    assert text("<main><p>" + " ".join(words) + "</p></main>") == " ".join(words)


def test_operator(spark):
    rows = [(1, "u", "<article><p>x</p></article>", "t"), (2, None, None, "t"), (None, "v", "", None), (1, "u", "<article><p>x</p></article>", "t")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    assert sorted(map(tuple, h.extract(df).fillna(-1, ["page_id"]).fillna("-").collect())) == [
        (-1, "v", "", 0), (1, "u", "x", 1), (1, "u", "x", 1), (2, "-", "", 0)
    ]
    assert h.extract(df.limit(0)).count() == 0


def test_elements_whose_names_begin_like_others():
    story = "<h1>Bridge opens</h1><p>The new bridge over the river was opened on Monday by the mayor and some hundred people who had waited for it.</p>"
    for name in ("title-bar", "style-guide", "script-box", "button-group", "video-player", "object-list", "textarea-label"):
        assert text(f"<body><article><{name}>{story}</{name}></article></body>") == text(f"<body><article>{story}</article></body>") != "", name
        assert text(f"<body><article><{name}>{story}</article></body>").startswith("Bridge opens\n"), name


def test_forms_round_whole_pages():
    story = "<h1>Bridge opens</h1><p>The new bridge over the river was opened on Monday by the mayor and some hundred people who had waited for it.</p>"
    want = text(f"<body><article>{story}</article></body>")
    assert want.startswith("Bridge opens\n")
    for page in (f"<article><form id=aspnet>{story}</form></article>", f"<form action=/x><article>{story}</article></form>", f"<form id=f><div class=content><main>{story}</main></div>"):
        assert text(f"<body>{page}</body>") == want, page
    asked = "<form><p>Tell us your name and where you live, and we will send you a letter with the news of the week every Sunday.</p></form>"
    assert text(f"<body><article>{story}{asked}</article></body>") == want


def test_controls_stand_between_words():
    assert text("<article><p>one<button>Buy</button>two<select><option>x</select>three</p></article>") == "one two three"
