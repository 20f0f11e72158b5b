"""Blocks of hand-written pages."""
from noisyframe.llm import html_extract as M

LONG = "The point of this is that it was there for all of us to see, and they were not the first to have been in it. " * 3
RARE = "Zorgl blarf quint mestu vorkal drimpa lutzen qarbi. " * 6


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{body}"


def test_article_of_a_page():
    html = page(f"""<header><h1>Site</h1></header><nav><ul><li><a href=/x>Home of the site</a></li></ul></nav><!-- c -->
    <div class="ad">Buy the best of all.</div><article><h1>Head&amp;line</h1><p><b>{LONG}<br><p>Tiny</p><p>{RARE}</p>
    <p>a&nbsp;b &lt;p&gt; &copy; &#228;</p><aside>Side {LONG}</aside><form>Mail <input> <button>Go</button></form></article>
    <div id="cookie-notice">{LONG}</div><section class="comments"><p>{LONG}</p></section><footer>&copy; {LONG}</footer>""")
    assert M.main_text(html) == f"Head&line {LONG.strip()} Tiny {RARE.strip()} a b <p> © ä"


def test_pages_without_article():
    html = page(f"<div><a href=a>{LONG}</a></div><p>{LONG}</p><p>Short one</p><p>{LONG}</p><div>{RARE}</div><p>© me</p>")
    assert M.main_text(html) == f"{LONG.strip()} Short one {LONG.strip()}"


def test_neighbours_decide():
    c, b, a = M.CONTENT, M.BOILERPLATE, M.AMBIGUOUS
    assert M.second_pass([c, a, a, b], [0] * 4) == [c, c, b, b]
    assert M.second_pass([c, a, b], [0] * 3) == [c, b, b]
    assert M.second_pass([b, a, a, b], [0, 1, 1, 0]) == [b, c, c, b]
    assert M.second_pass([a], [0]) == [b] and M.second_pass([], []) == []


def test_broken_markup():
    assert M.main_text(f"<article><p>{LONG}<p>cut <b>off</b> &am") == f"{LONG.strip()} cut off &am"
    assert M.main_text(f"<article><p>{LONG}</p><p cl") == LONG.strip()
    assert M.main_text(f"</div></p><article><div><p>{LONG}</article></div>after") == LONG.strip()
    assert M.main_text(None) == M.main_text("") == M.main_text("<script>x") == ""
    assert len(M.main_text("<article>" + f"<p>{LONG}</p>" * 2000)) > 400000


def test_table(spark):
    rows = [(1, "u", f"<article><p>{LONG}</p></article>", "x"), (1, "u", f"<article><p>{LONG}</p></article>", "x"), (2, None, None, "x"), (None, "u", "", "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r["page_id"] or 0), r["n_chars"], r["text"]) for r in M.extracted(frame).collect())
    assert got == [(0, 0, ""), (1, len(LONG.strip()), LONG.strip()), (1, len(LONG.strip()), LONG.strip()), (2, 0, "")]
    assert M.extracted(frame.limit(0)).count() == 0


EN = "Yesterday evening, several local residents gathered near Bridgeport harbour, hoping to watch returning fishing vessels unload."
RU = "Это обычный русский абзац, в котором рассказано о событиях прошлого лета и о том, как жители города встретили первые дни осени."


def test_wrappers_do_not_swallow_the_article():
    text = LONG.strip()
    for html in (f'<div class="content no-sidebar"><article><p>{LONG}</article></div>', f'<div class="page with-sidebar"><main><p>{LONG}</main></div>',
                 f'<div class="sidebar"><article><p>{LONG}</article></div>', f'<div class="has-comments single"><p>{LONG}</p></div>',
                 f'<form id="aspnetForm"><article><p>{LONG}</article><input></form>', f'<body class="menu"><p>{LONG}</p>',
                 f'<div id="main-content" class="widget-area-none"><p>{LONG}</p></div>', f'<div class="share"><main><p>{LONG}</main></div>'):
        assert M.main_text(html) == text, html
    assert M.main_text(f'<article><p>{LONG}</p><p class="share-holders">{LONG}</p></article>') == f"{text} {text}"
    assert M.main_text(f"<form><p>{LONG}</p><p>{LONG}</p><label>Name</label><input></form>") == f"{text} {text}"
    assert M.main_text(f"<p>{RU}</p><p>{RU}</p>") == f"{RU} {RU}" and M.main_text(f"<p>{EN}</p><p>{EN}</p>") == f"{EN} {EN}"


def test_boilerplate_by_class_tag_or_role_stays_out():
    text = LONG.strip()
    for part in (f'<div class="sidebar">{LONG}</div>', f'<div class="sidebar-left">{LONG}</div>', f'<div id="site-footer">{LONG}</div>',
                 f'<nav><article>{LONG}</article></nav>', f'<div role="complementary"><article>{LONG}</article></div>',
                 f'<div hidden><main>{LONG}</main></div>', f'<section class="comments list">{LONG}</section>',
                 f'<form class="newsletter"><p>{EN}</p><input></form>', f'<div class="cookie-banner">{LONG}</div>'):
        assert M.main_text(f"<article><p>{LONG}</p></article>{part}") == text, part
        assert M.main_text(f"{part}<p>{LONG}</p><p>{RARE}{RARE}</p>") == f"{text} {RARE}{RARE}".strip(), part


def test_generated_pages_give_their_text():
    """Pages put together from paragraphs of known label, in wrappers of all kinds."""
    import random
    g = random.Random(6)
    wrappers = ["<div class='page with-sidebar'>%s</div>", "<div id='content'>%s</div>", "<form id='f'>%s</form>", "<body class='no-menu'>%s", "%s"]
    bodies = ["<article>%s</article>", "<main>%s</main>", "<div class='entry-content'>%s</div>", "<section>%s</section>"]
    around = ["<nav><a href=/>Home</a> <a href=/a>All</a></nav>", "<div class='ad'>Buy the best of all, for you and for me.</div>",
              "<footer>© me</footer>", "<div id='cookie-notice'>We use cookies, as they all do.</div>", "<aside>%s</aside>" % LONG,
              "<form class='search'><label>Find</label><input></form>", "<div class='comments'><p>%s</p></div>" % LONG]
    for _ in range(300):
        paragraphs = [g.choice([LONG, RARE + RARE, EN + " " + RU, LONG + EN]).strip() for _ in range(g.randint(2, 6))]
        # an undecided paragraph next to boilerplate takes its label, so that outside articles the ends are decided
        paragraphs = [LONG.strip(), *paragraphs, LONG.strip()]
        body = g.choice(bodies) % "".join(f"<p>{p}</p>" for p in paragraphs)
        before, after = (g.sample(around, g.randint(0, 3)) for _ in (0, 1))
        html = g.choice(wrappers) % ("".join(before) + body + "".join(after))
        assert M.main_text(html) == " ".join(paragraphs), html
