import hashlib
import zlib

import pyarrow as pa
import pytest

from sigweave.llm import common, html_extract, matroska

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="cookie-notice">We use cookies to make this site better for all of you.</div><div id=content>%s<h2>Heading</h2><p>First &amp; foremost   a paragraph
that is long enough, with <b>bold</b> words and a <a href=x>link</a>.<p>Second paragraph that is also long enough&nbsp;here, unclosed.
<ul><li>point one is short<li>point two</ul><form><input><label>Mail</label></form><div class="ad">Buy now!</div></div><aside>Read more of this and that</aside>
<section class="comments"><p>A reader's comment, which may be rather long and full of words, but is not the article.</p></section><footer>&copy; me</footer></body></html>"""
WANT = ["Heading", "First & foremost a paragraph that is long enough, with bold words and a link.", "Second paragraph that is also long enough here, unclosed.", "point one is short", "point two"]


@pytest.mark.parametrize("wrap", ["", "<!-- x -->", "<script>document.write('<p>no</p>')</script>"])
def test_main_text_without_the_rest(wrap):
    assert html_extract.extract(PAGE % wrap).split("\n\n") == WANT


def test_article_and_odd_pages():
    got = html_extract.extract("<body><nav>menu</nav><article><header><h1>Title</h1></header><p><b>Lead<br>more<br><p>Text.<section class='comments'><p>no</section><footer>no</footer></article><div><p>other</p></div>")
    assert got.split("\n\n") == ["Title", "Lead more", "Text."]
    for odd in ("", "<", "plain text", "<p>", "</p></div>", "<a <b>", "<!--", "<script>", "<div " * 3000, "<div>" * 3000 + "deep", "&#0;&bogus;&amp", "<p>" + "x" * 200000):
        html_extract.extract(odd)
    assert html_extract.extract("plain text") == "plain text" and html_extract.extract("<div>" * 3000 + "deep").endswith("deep")


def test_main_text_table(spark):
    rows = [(1, "u", PAGE % "", 3, "z"), (2, None, None, None, None), (3, "u", "", 1, ""), (3, "u", "", 1, "")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars int, text string")
    got = sorted(map(tuple, html_extract.main_text(df, ["page_id", "url"]).collect()), key=str)
    text = "\n\n".join(WANT)
    assert got == sorted([(1, "u", text, len(text)), (2, None, "", 0), (3, "u", "", 0), (3, "u", "", 0)], key=str)
    assert html_extract.main_text(df.limit(0), ["page_id"]).count() == 0


LONG = "Sentence number one is here, and it goes on for a while. " * 9


@pytest.mark.parametrize(
    "names", ['class="page has-sidebar"', 'id="x" class="no-sidebar"', 'class="content-with-footer"', 'class="search-results-page content"', 'class="social-history"', 'class="sidebar"', 'class="post no-comments"']
)
def test_names_that_wrap_the_article_do_not_drop_it(names):
    got = html_extract.extract(f"<body><nav><a href=/>Home</a></nav><div {names}><p>{LONG}</p><p>{LONG}</p></div><footer>bye</footer>")
    assert got == "\n\n".join([LONG.strip()] * 2)


@pytest.mark.parametrize("names", ["ad", "cookie-notice", "commentList", "comment-list", "site-footer", "related-posts", "sidebar-left", "side-bar", "ad-300x250", "navbar", "login-form", "newsletter_box x"])
def test_names_of_asides(names):
    assert html_extract.extract(f'<body><div class="text"><p>{LONG}</p><p>{LONG}</p></div><div class="{names}"><p>{LONG}</p></div>').count("number one") == 18


def test_forms_around_pages_and_comments_longer_than_the_article():
    page = f"<form><div class=menu><a href=x>a</a></div><div><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></div><input></form>"
    assert html_extract.extract(page) == "\n\n".join(["Title", LONG.strip(), LONG.strip()])
    page = f"<article><h1>T</h1><p>{LONG}</p></article><section id=comments><ol class=comment-list><li><article class=comment-body><p>{LONG * 40}</p></article></ol></section>"
    assert html_extract.extract(page) == "T\n\n" + LONG.strip()


def test_menus_inside_main_go_and_its_paragraphs_stay():
    page = f"<main><div><a href=x>Read this teaser now</a> more</div><h1>Head</h1><p>{LONG}</p><p>short one.</p><p>{LONG}</p><ul><li><a href=x>one</a><li><a href=y>two</a></ul></main>"
    assert html_extract.extract(page) == "\n\n".join(["Head", LONG.strip(), "short one.", LONG.strip()])


def test_time_grows_with_the_page():
    import time

    n = 25_000
    for page in ("</i>" * 10 * n, "<ul>" + "<b>" * n + "<li>" * n, "<div>" + "<b>" * n + "</u>" * n, "<div>" * n + "</p>" * n + "x", "<b>" * n + "<p>x</p>" * n, "<a x='" * n, "<table><tr><td>" * n + "</div>" * n, "<dl>" + "<span>" * n + "<dt>" * n):
        began = time.process_time()
        html_extract.extract(page)
        assert time.process_time() - began < 10, page[:20]  # quadratic parsing takes minutes


def test_densities_by_brute_force():
    import math
    import random

    def counts(node):
        c = t = lc = lt = 0
        for x in node.children:
            if isinstance(x, str):
                c += len(" ".join(x.split()))
                continue
            a, b, d, e = counts(x)
            c, t, lc, lt = c + a, t + b + 1, lc + d, lt + e + (x.tag == "a")
        return (c, t, c, t) if node.tag == "a" else (c, t, lc, lt)

    def density(node, share):
        c, t, lc, lt = counts(node)
        if not c:
            return 0.0
        base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
        amount = math.log(max(1.0, c / max(1, lc) * max(1, t) / max(1, lt)))
        return c / max(1, t) * (amount / math.log(base) if base > 1.0000001 else amount * 1e6)

    rng = random.Random(6)
    for _ in range(60):
        def tree(depth):
            return "".join(rng.choice([f"<div>{tree(depth - 1)}</div>" if depth else "x", f"<p>{'w' * rng.randrange(200)}</p>", f"<p>a <a href=x>{'l' * rng.randrange(60)}</a> b</p>"]) for _ in range(rng.randrange(1, 5)))

        root = html_extract.parse(f"<body>{tree(4)}</body>")
        body = root.children[0]
        nodes = html_extract._walk(body)
        live = html_extract._live(nodes)
        c, _, lc, _ = counts(body)
        sums = [sum(density(x, lc / max(1, c)) for x in n.children if not isinstance(x, str)) for n in nodes]
        assert live == nodes and all(math.isclose(n.total, s, rel_tol=1e-9, abs_tol=1e-9) for n, s in zip(nodes, sums, strict=True))
        best = html_extract._best(live, html_extract._largest(live))
        assert math.isclose(best.total, max(sums), rel_tol=1e-9)


@pytest.mark.parametrize("lacing", matroska.LACINGS)
@pytest.mark.parametrize("n", [1, 192, 193, 5000, 300_000])
def test_matroska_round_trip(lacing, n):
    payload = matroska.padded(bytes(i * 7 % 256 for i in range(n)))
    data = matroska.mux(payload, lacing)
    back, media = matroska.read_back(data)
    assert back == payload and media.whole and len(media.packets) == len(payload) // 192
    assert [p[1] for p in media.packets] == [i * 24_000_000 for i in range(len(media.packets))]
    assert [c[2] for c in media.cues] and all(data[data.index(bytes.fromhex("18538067")) :].find(bytes.fromhex("1f43b675")) > 0 for _ in media.cues)
    for cut in (3, 50, len(data) // 2):
        matroska.demux(data[:cut])


@pytest.mark.parametrize("kind", ["xiph", "ebml"])
def test_lacing_of_unequal_frames(kind):
    frames = [b"a" * 700, b"b" * 3, b"c" * 20000, b"d", b"", b"e" * 255]
    flags, body = matroska.lace(frames, kind)
    block = b"\x81\x00\x05" + bytes([0x80 | flags]) + body
    cluster = matroska._id(matroska.CLUSTER) + b"\x01" + b"\xff" * 7 + matroska._uint(matroska.CLUSTER_TIME, 100) + matroska.element(0xEC, b"void") + matroska.element(matroska.GROUP, matroska.element(matroska.BLOCK, block))
    data = matroska._id(matroska.SEGMENT) + b"\x01" + b"\xff" * 7 + cluster + cluster
    media = matroska.demux(data)
    assert [data[a : a + k] for _, _, a, k, _, _ in media.packets] == frames * 2 and media.whole
    assert {p[4] for p in media.packets} == {1, 2} and media.packets[0][1] == 105_000_000


def test_media_table(spark):
    rows = [(1, "héllo", "a"), (2, None, "b"), (3, "", "c"), (None, "x" * 100_000, None), (1, "héllo", "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, media string")
    for r in matroska.digests(df).collect():
        text = {1: "héllo", 2: "", 3: "", None: "x" * 100_000}[r.doc_id].encode()
        payload = text + b" " * (192 if not text else -len(text) % 192)
        assert (r.n_bytes, r.payload_bytes, r.tail_crc32) == (len(text), len(payload), zlib.crc32(payload[-16:]))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest()
        assert r.media_sha256 == hashlib.sha256(matroska.mux(payload)).hexdigest()
    table = matroska.packets(matroska.store(df, ["doc_id"]), ["doc_id"])
    assert table.count() == sum(max(1, -(-len((r[1] or "").encode()) // 192)) for r in rows)
    assert matroska.digests(df.limit(0)).count() == 0


@pytest.mark.parametrize("plain, named", [("text", "discussion"), ("text", "comments"), ("text", "share"), ("text", "promo"), ("text", "profit-share")])
def test_a_name_alone_drops_no_page(plain, named):
    page = '<body><div><a href=/>Home</a> <a href=/x>News</a></div><div class="{}">' + f"<p>{LONG}</p>" * 3 + "</div><div>&copy; x.com</div>"
    assert html_extract.extract(page.format(plain)) == html_extract.extract(page.format(named)) == "\n\n".join([LONG.strip()] * 3)


@pytest.mark.parametrize("name, stays", [("profit", 3), ("profit-share", 3), ("discussion", 3), ("related", 3), ("commentary", 3), ("comments", 2), ("ad", 2), ("cookie-notice", 2)])
def test_sections_of_an_article_by_name(name, stays):
    page = f'<body><article><h1>T</h1><p>{LONG}</p><section class="{name}"><p>{LONG}</p></section><p>{LONG}</p></article>'
    assert html_extract.extract(page) == "\n\n".join(["T", *[LONG.strip()] * stays])
    rows = '<li><a href="/a">Another page of this site</a></li>' * 4
    page = f'<body><article><h1>T</h1><p>{LONG}</p><section class="discussion"><ul>{"<li>me too, of course</li>" * 4}</ul></section><div class="related"><ul>{rows}</ul></div></article>'
    assert html_extract.extract(page) == "T\n\n" + LONG.strip()


def bare_page(rng):
    """A page of divs without names, and the text of its article."""
    words = lambda a, b: " ".join(rng.choice(["stone", "water", "of", "the", "light", "and", "river", "seldom", "turns"]) for _ in range(rng.randint(a, b)))
    link = lambda: f'<a href="/{rng.randint(1, 99)}">{words(1, 3)}</a>'
    menu = f"<div><ul>{''.join(f'<li>{link()}</li>' for _ in range(rng.randint(4, 12)))}</ul></div>"
    blocks, wanted = [], []
    for k in range(rng.randint(3, 9)):
        text = words(30, 120)
        if k % 3 == 0:
            wanted.append(words(3, 6))
            blocks.append(f"<h2>{wanted[-1]}</h2>")
        a, b = text[:40], text[40:]
        blocks.append(f"<p>{a}<b>{b[:10]}</b>{b[10:]}</p>" if rng.random() < 0.5 else f"<p>{text}</p>")
        wanted.append(" ".join(text.split()))
    if rng.random() < 0.5:  # the end of the article in a part of its own
        blocks[-1] = f"<div>{blocks[-1]}</div>"
    more = f"<div><ul>{''.join(f'<li>{link()} {link()}</li>' for _ in range(6))}</ul></div>"
    footer = f"<div>&copy; {words(3, 8)} &middot; {link()}</div>"
    return f"<body>{menu}<div><div>{''.join(blocks)}</div></div>{more}{footer}", "\n\n".join(wanted)


def test_pages_of_divs_without_names():
    import random

    rng = random.Random(12)
    pages = [bare_page(rng) for _ in range(60)]
    assert [html_extract.extract(p) for p, _ in pages] == [w for _, w in pages]


def test_densities_decide_on_bare_pages(monkeypatch):
    """With the same density for every node that holds text the article is lost among the rest."""
    import random

    rng, measure = random.Random(12), html_extract._measure

    def constant(nodes, body):
        measure(nodes, body)
        for n in nodes:
            n.density = 1.0 if n.chars else 0.0
        for n in nodes:
            n.total = sum(c.density for c in n.children if isinstance(c, html_extract.Node))

    pages = [bare_page(rng) for _ in range(60)]
    monkeypatch.setattr(html_extract, "_measure", constant)
    assert sum(html_extract.extract(p) == w for p, w in pages) < 30


def test_a_worker_has_few_texts_before_it_at_a_time(spark, monkeypatch):
    """A batch is cut into slices of bounded bytes; files are written and read back in one pass of Python."""
    texts = [None, "", *("x" * n for n in (900, 200, 3000, 5, 5)), None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], names=["id", "text"])
    got = [s.column(0).to_pylist() for s in common.slices(batch, 1, 1000)]
    assert sum(got, []) == list(range(8)) and got == [[0, 1, 2, 3], [4], [5, 6, 7]] and [s.num_rows for s in common.slices(batch, 1, None)] == [8]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    whole = sorted(map(tuple, matroska.digests(df).collect()))
    assert matroska.digests(df)._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    monkeypatch.setattr(matroska, "MOST_BYTES", 100)
    assert sorted(map(tuple, matroska.digests(df).collect())) == whole and len(whole) == 8
    stored = {r.doc_id: bytes(r.media) for r in matroska.store(df, ["doc_id"]).collect()}
    assert {i: hashlib.sha256(m).hexdigest() for i, m in stored.items()} == {r[0]: r[6] for r in whole}
