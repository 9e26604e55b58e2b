import html
import re

import numpy as np

from corpusflow.llm import html_text as H


def test_blocks_and_main_text():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
    <header class="site"><a href="/">Home</a></header><nav><ul><li><a href="/a">A</a></li></ul></nav>
    <div id="cookie-notice">We use cookies on this site to make it better for everyone.</div>
    <article><h1>Head &amp; line</h1><p>One <b>bold</b>&nbsp;word<br>and   more
    text.</p><div class="advert">Buy now cheap things today</div><p>Be.</p><form><label>Name</label><input></form>
    <aside>Related stories of the day</aside><p>Last &#233;&lt;x&gt; <a href="#">linked words here</a></p>
    <section class="comments"><p>Great article, I liked it very much indeed.</p></section></article>
    <div class="sidebar"><p>Some long sidebar text with many words that looks like prose for sure.</p></div><footer>&copy; me</footer></body></html>"""
    assert H.main_text(page) == "Head & line\nOne bold word and more text.\nBe.\nLast é<x> linked words here"


def test_sloppy_markup():
    assert H.main_text("<article><p><b>Open bold<br><p>Next</p></div></article><footer>x</footer>") == "Open bold\nNext"
    assert H.main_text("<article><p>cut off &am") == "cut off &am"
    assert H.main_text("<html><head><title>T</title><meta x><body><article><p>no end of head") == "no end of head"
    assert H.main_text("<article><p>a < b and c > d</p>") == "a < b and c > d"
    assert H.main_text("plain words only in a page that has no markup at all") == "plain words only in a page that has no markup at all"
    assert H.main_text(None) == H.main_text("") == H.main_text("<article></article>") == ""


def test_headers():
    page = '<div class="page-header">Site</div><article><header class="entry-header"><h1 class="header">Title</h1></header><p>Text</p><p class="comment-form">say</p></article><div role="contentinfo">me</div>'
    assert H.main_text(page) == "Title\nText"


def test_pages_without_article():
    page = "<body><ul><li><a>Home</a></li><li><a>About us</a></li></ul><p>" + "prose " * 40 + "</p><p>" + "more " * 30 + "</p><div><a>x</a> <a>y</a></div></body>"
    assert H.main_text(page) == ("prose " * 40).strip() + "\n" + ("more " * 30).strip()


def test_tree_fits_its_table_and_ties_are_stable():
    tree = H.grow(H.LABELLED)
    assert ((H.decide(tree, H.LABELLED[:, :-1]) >= 0.5) == H.LABELLED[:, -1]).all()
    assert H.grow(H.LABELLED[np.random.default_rng(0).permutation(len(H.LABELLED))]) == tree
    assert H.grow(np.array([[1.0, 1], [1.0, 0]])) == ("leaf", 0.5)


def test_table(spark):
    rows = [(1, "u", "<article><p>Ünï</p></article>"), (1, "u", "<article><p>Ünï</p></article>"), (2, None, None), (None, "u", ""), (3, "u", "<p>" * 5000 + "deep" + "</p>" * 5000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    out = H.extract(df).collect()
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in out) == [("1", "Ünï", 3), ("1", "Ünï", 3), ("2", "", 0), ("3", "deep", 4), ("None", "", 0)]
    assert H.extract(df.limit(0)).count() == 0


PROSE = ["one prose " * 20, "two prose " * 30, "three prose " * 12]


def _page(before, after, beside=""):
    return f"<body><nav><a>Home</a></nav>{before}{''.join(f'<p>{p}</p>' for p in PROSE)}{after}{beside}<footer>me</footer></body>"


def test_names_of_wrappers_do_not_drop_the_article():
    want = "\n".join(p.strip() for p in PROSE)
    side = "<div class='sidebar'><p>" + "aside words " * 12 + "</p></div>"
    for outer in ("<div class='with-sidebar'>", "<div id='page' class='no-sidebar'>", "<div class='header-fixed'>", "<div class='hasSidebar layoutSidebarRight'>", "<div class='widget'>"):
        for inner in ("<article>", "<main>", "<div>"):
            assert H.main_text(_page(outer + inner, inner.replace("<", "</") + "</div>")) == want, outer + inner
    for tag in ("<article class='post has-comments'>", "<main class='layout-sidebar-right'>", "<article class='post social'>", "<article><div class='banner-story'>"):
        assert H.main_text(_page(tag, "</div></article></main>", side)) == want, tag
    short = "<div class='header-fixed'><article><p>Just this.</p></article></div>"
    assert H.main_text(short) == "Just this."


def test_compound_names_in_an_article_are_hints():
    for name in ("social-history", "legal-analysis", "relatedWork"):
        part = f"<section class='{name}'><p>" + "section prose " * 15 + "</p></section>"
        assert "section prose" in H.main_text(_page("<article>", part + "</article>")), name
        assert "More" not in H.main_text(_page("<article>", f"<div class='{name}'><a>More</a></div></article>")), name


def test_what_names_set_apart_stays_apart():
    want = "\n".join(p.strip() for p in PROSE)
    other = "<p>" + "other words " * 40 + "</p>"
    for mark in ("class='comments'", "id='comment-list'", "class='cookie-notice'", "class='sidebarLeft'", "class='related-posts'", "role='complementary'", "hidden"):
        assert H.main_text(_page("<article>", f"<div {mark}>{other}</div></article>")) == want, mark
        assert H.main_text(_page("<article>", "</article>", f"<div {mark}>{other}</div>")) == want, mark
        assert H.main_text(_page("<div>", "</div>", f"<div {mark}>{other}</div>")) == want, mark
    assert H.main_text(_page("<article>", "</article>", f"<div class='sidebar-zone'>{other}</div>")) == want
    talk = f"<div id='comments'><article class='comment-body'>{other * 9}</article></div>"
    assert H.main_text(_page("<article>", "</article>", talk)) == want
    assert H.main_text(_page("<article hidden>", "</article>")) == ""


def test_what_nothing_closes_does_not_swallow_the_page():
    want = "\n".join(p.strip() for p in PROSE)
    for tag in ("button", "select", "noscript", "svg", "object", "canvas", "video"):
        assert want in H.main_text(_page(f"<article><{tag}>", "</article>")), tag
        later = _page(f"<article><{tag}>", f"<{tag}>Go</{tag}></article>")
        assert PROSE[2].strip() in H.main_text(later) or tag not in H.FLAT, tag
        assert H.main_text(_page(f"<article><{tag}>Menu <i>x</i></{tag}>", f"<{tag} class='a'>Go</{tag}></article>")) == want, tag
    assert H.main_text(_page("<article><svg><svg></svg>in</svg>", "</article>")) == want


def test_neighbours_decide_where_no_article_is():
    prose, menu = "<p>" + "long prose words " * 8 + "</p>", "<p><a>Menu</a></p>"
    text = lambda *parts: H.main_text("<body>" + "".join(parts) + "</body>").split("\n")
    line = "<p>Short line</p>"
    assert "Short line" in text(menu, line, prose, menu) and "Short line" in text(menu, prose, line, menu) and "Short line" in text(prose, line, prose)
    assert "Short line" not in text(menu, line, menu, prose) and "Short line" not in text(prose, menu, line) and "Short line" not in text(line, menu, prose)
    linked = "<p><a>" + "many linked words " * 8 + "</a></p>"
    assert "Short line" not in text(prose, linked, line, linked, prose)
    used = set()

    def walk(t):
        if t[0] == "split":
            used.add(H.FEATURES[t[1]])
            walk(t[3]), walk(t[4])

    walk(H.default_tree())
    assert used == set(H.FEATURES)


def brute_blocks(page):
    """Blocks of the tables' plain markup by another way: the page as a list of tags and texts, read with a stack of names."""
    void, inline = {"br", "meta", "img", "input", "link"}, {"a", "b", "i", "em", "strong", "span"}
    page = re.sub(r"(?s)<(script|style|title)\b.*?</\1>|<!--.*?-->|<!doctype[^>]*>", "<p>", page, flags=re.I)
    out, stack, text, linked = [], [], "", 0

    def close():
        nonlocal text, linked
        words = html.unescape(text).split()
        if words:
            names = [n for n, _ in stack]
            inside = "article" in names or "main" in names
            apart = any(n in ("nav", "header", "footer", "aside", "form", "menu", "dialog") or k in ("ad",) for n, k in stack)
            out.append((" ".join(words), len(words), min(linked, len(words)), inside, apart))
        text, linked = "", 0

    for piece in re.split(r"(<[^>]*>)", page):
        found = re.fullmatch(r"<(/?)([a-z0-9]+)\b([^>]*)>", piece, re.I)
        if not found:
            text += piece
            if any(n == "a" for n, _ in stack):
                linked += len(html.unescape(piece).split())
            continue
        end, name, rest = found[1] == "/", found[2].lower(), found[3]
        if name == "br":
            text += " "
        elif name in inline or name in void:
            if name == "a":
                stack = [x for x in stack if x[0] != "a"] + ([] if end else [("a", "")])
        else:
            close()
            stack = [x for x in stack if x[0] != "a"]
            if not end:
                named = re.search(r'class="([^"]*)"', rest)
                stack.append((name, named[1] if named else ""))
            elif name in [n for n, _ in stack]:
                while stack.pop()[0] != name:
                    pass
    close()
    return out


def test_whole_table_matches_brute_force(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in H.extract(pages).collect()}
    tree = H.default_tree()
    for r in pages.collect():
        found = brute_blocks(r["html"] or "")
        some, kept = any(b[3] for b in found), []
        for k, (text, words, linked, inside, apart) in enumerate(found):
            side = lambda j: (found[j][1], found[j][2] / found[j][1]) if 0 <= j < len(found) else (0, 0)  # noqa: B023, E731
            row = [words, linked / words, *side(k - 1), *side(k + 1), 2 if inside else 0 if some else 1, int(apart)]
            node = tree
            while node[0] == "split":
                node = node[3] if row[node[1]] <= node[2] else node[4]
            if node[1] >= 0.5:
                kept.append(text)
        assert got[r["page_id"]] == "\n".join(kept), r["page_id"]
    assert len(got) == pages.count() and all(got.values())


ARTICLE = "<h1>Title</h1><p>" + "prose of the article " * 12 + "</p><p>Short.</p><p>" + "more of the same " * 12 + "</p>"
WANT = "Title\n" + ("prose of the article " * 12).strip() + "\nShort.\n" + ("more of the same " * 12).strip()


def test_elements_around_the_article_keep_it():
    for around in ('<form id="aspnetForm">{}</form>', "<aside>{}</aside>", '<div aria-hidden="true">{}</div>', "<nav><a href='/'>Home</a><p></p>{}", '<form><div hidden>{}</div></form>'):
        got = H.main_text(f"<body><header>Site of mine</header>{around.format(f'<article>{ARTICLE}</article>')}<footer>Copyright of somebody</footer></body>")
        assert got.removeprefix("Home\n") == WANT, around
    menu = "<nav><ul><li><a href='/'>Home</a></li></ul></nav>"
    for around in ('<form id="aspnetForm">{}</form>', "<aside>{}</aside>", '<div aria-hidden="true">{}</div>'):
        got = H.main_text(f"<body>{menu}{around.format('<div>' + ARTICLE + '</div>')}</body>")
        assert ("prose of the article " * 12).strip() in got and ("more of the same " * 12).strip() in got and "Home" not in got, around
    inner = f"<body><article>{ARTICLE}<form><p>{'subscribe to our letter of news ' * 20}</p></form><aside><p>{'other stories ' * 40}</p></aside></article></body>"
    assert H.main_text(inner) == WANT
    long_footer = f"<body><article>{ARTICLE}</article><footer><p>{'terms and conditions of use ' * 90}</p></footer></body>"
    assert H.main_text(long_footer) == WANT


def test_long_and_deep_pages_take_time_by_their_length():
    import time

    n = 100_000
    for page in ("<svg>" * n + "text", "<div>" * n + "</b>" * n + "text", "<ul><li>a<article>" + "<div>" * n + "</li>" * n + "x", "<button>" * n, "<span class=ad>" * n, "<p>a</p>" * n):
        began = time.process_time()
        H.blocks_of(page)
        assert time.process_time() - began < 12


def test_starts_that_an_end_closes():
    def plain(ends, flat):
        out = []
        for k, end in enumerate(ends):
            depth = 0
            closed = not end and flat and k + 1 < len(ends) and ends[k + 1]
            for x in [] if end or flat else ends[k:]:
                depth += -1 if x else 1
                if not depth:
                    closed = True
                    break
            out.append(bool(closed))
        return out

    rng = np.random.default_rng(4)
    for _ in range(300):
        ends = (rng.random(rng.integers(0, 12)) < 0.5).tolist()
        for flat in (True, False):
            assert H._matched(ends, flat) == plain(ends, flat)
