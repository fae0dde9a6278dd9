"""The paths' scores select the text: against a direct reading of the method, and on pages without an article element."""

import math
import random
import time

import pytest

from tilewright.llm import html_text

from .test_advice import marked_up, paragraphs

STORY = paragraphs(5)


def kept(html):
    return html_text.main_blocks(html)


@pytest.mark.parametrize(
    "html",
    [
        "<form id=aspnetForm><div class=menu><a href=/>Home</a></div><div>{}</div><div>Copyright 2024 Someone, all rights reserved.</div></form>",
        "<body><div class='legal-text'>{}</div><div>© 2024, Someone.</div></body>",
        "<body><div id='discussion-paper'>{}</div><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></body>",
        "<body><div class='search-result-page'><div>{}</div><div class=pager><a href=/2>2</a></div></div></body>",
        "<body><div class='page-header-wrap'><article>{}</article></div><div>All rights reserved.</div></body>",
        "<body><article>{}<div class='author-box'><p>Someone writes here, now and then.</p></div></article></body>",
        "<body><div>{}</div><div class=author-bio><p>Someone writes here, now and then.</p></div><p class=copyright>(c) 2024 Someone. Or other.</p></body>",
        "<body class=ad><div hidden><div class=advert>{}</div></div></body>",
        "<html><head><title>T</title><p>{}",
    ],
)
def test_pages_without_help_from_landmarks(html):
    assert kept(html.format(marked_up(STORY))) == STORY


def test_a_line_of_rights_in_the_article_stays():
    assert kept(f"<article>{marked_up(STORY)}<p>All rights reserved.</p></article>") == [*STORY, "All rights reserved."]


PAGE = f"<body><ul><li><a href=/>Home</a></li></ul><div>Short.</div><h1>Heading</h1><div>{marked_up(STORY)}</div><table><tr><td>1<td>2</table><div class=ad>Buy, now!</div><footer>Here. And there.</footer></body>"


def test_the_scores_decide(monkeypatch):
    """With other scores the page has another text."""
    want = kept(PAGE)
    assert want == ["Heading", *STORY]
    scores = html_text.path_scores
    monkeypatch.setattr(html_text, "path_scores", lambda found: dict.fromkeys(scores(found), 1.0))
    assert set(kept(PAGE)) > set(want)
    rng = random.Random(1)
    texts = set()
    for _ in range(20):
        monkeypatch.setattr(html_text, "path_scores", lambda found: {p: rng.random() ** 4 for p in scores(found)})
        texts.add(tuple(kept(PAGE)))
    assert len(texts) > 5


def brute_content(rows):
    """Which of rows (path with marks, text, linked characters, place of the block that leads to it, whether in an article) hold content; all sums written out."""
    marks = lambda text: sum(text.count(c) for c in ".,;:!?、。！，：；？…¿¡")

    def ratio(path, k):
        mine = [(len(t) - n, marks(t) if n < len(t) else 0) for p, t, n, *_ in rows if p == path]
        return sum(x[k] for x in mine) / len(mine)

    def kin(a, b):
        same = 0
        while same < min(len(a), len(b)) and a[same] == b[same]:
            same += 1
        return (same / max(len(a), len(b))) ** 2

    def weight(path):
        return (1, 0.5, 0.05, 0.01)[max(m for _, m in path)]

    def score(path):
        out = []
        for i, (p, t, n, lead, inside) in enumerate(rows):
            if p == path:
                if n >= 0.9 * len(t) and lead is None and not inside:
                    out.append(math.sqrt(ratio(p, 0) * (1 + ratio(p, 1))) * weight(path))
                    continue
                near = [(kin(path, rows[j][0]) * math.exp(-((i - j) ** 2) / 2), rows[j][0]) for j in range(len(rows)) if abs(i - j) <= 2]
                near += [(1, rows[lead][0])] if lead is not None else []
                text, mark = (sum(w * ratio(q, k) for w, q in near) / sum(w for w, _ in near) for k in (0, 1))
                out.append(math.sqrt(text * (1 + mark)) * weight(path))
        return sum(out) / len(out)

    mass = [len(t) * weight(p) for p, t, *_ in rows]
    usual = sum(m * score(p) for m, (p, *_) in zip(mass, rows, strict=True)) / sum(mass)
    return [score(p) >= 0.35 * usual for p, *_ in rows] if usual else None


def random_page(rng):
    def inside(depth):
        out = []
        for _ in range(rng.randrange(1, 5)):
            kind = rng.choice(["p", "p", "div", "section", "ul", "h2", "div class=ad", "nav", "blockquote"])
            name = kind.split()[0]
            words = " ".join(rng.choice(["word", "and,", "end.", "so", "why?"]) for _ in range(rng.choice([1, 3, 20, 60])))
            if rng.random() < 0.2:
                words = f"<a href=x>{words}</a>"
            if name == "ul":
                words = "".join(f"<li>{w}</li>" for w in words.split(" ")[:4]) if "<a" not in words else f"<li>{words}</li>"
            elif depth < 4 and name in ("div", "section", "nav"):
                words += inside(depth + 1)
            out.append(f"<{kind}>{words}</{name}>")
        return "".join(out)

    return f"<body>{inside(0)}</body>"


def test_scores_against_a_direct_reading():
    rng = random.Random(3)
    for _ in range(60):
        found = html_text.blocks(random_page(rng))
        leads = html_text._leads(found)
        rows = []
        for b, lead in zip(found, leads, strict=True):
            path, p = [], b.path
            while p is not None:
                path.insert(0, (p.name, p.mark))
                p = p.up
            rows.append((tuple(path), b.text, b.linked, None if lead is None else found.index(lead), b.element.inside))
        want = brute_content(rows)
        if want is not None:
            content = html_text.content_paths(found, html_text.path_scores(found))
            assert [b.path in content for b in found] == want


def test_what_leads_to_a_list():
    found = html_text.blocks("<div><p>One</p><ul><li>a<li><p>b</p></ul><table><tr><td>c</table></div><ul><li>d</ul><blockquote><p>e</p></blockquote>")
    leads = [None if x is None else x.text for x in html_text._leads(found)]
    assert [(b.text, x) for b, x in zip(found, leads, strict=True)] == [("One", None), ("a", "One"), ("b", "One"), ("c", "One"), ("d", None), ("e", None)]


@pytest.mark.parametrize("page", ["<div>{0}deep", "<b>{0}<div>x</div>{0}", "<span>{0}x<br>{0}</span>{0}", "<div class=ad>y{0}</div>z{0}", "<li>x{0}", "<ul><li>{0}x"])
def test_time_is_linear_in_depth(page):
    def seconds(n):
        parts = page.split("{0}")
        html = "".join(x * n if k < len(parts) - 1 else x for k, x in enumerate(parts))
        began = time.process_time()
        assert html_text.main_text(html)
        return time.process_time() - began

    seconds(1000)
    # ten times the elements take about ten times as long, not a hundred times
    assert seconds(30_000) < 40 * max(seconds(3000), 0.01)


def test_very_deep_pages():
    began = time.process_time()
    assert html_text.main_text("<div>" * 100_000 + "deep" + "</div>" * 100_000) == "deep"
    assert time.process_time() - began < 8


@pytest.mark.parametrize("item", ["<li><p>word, word.", "<dt>a<dd><p>x.", "<p><li>", "<tr><td><p>x", "<li><dd><p>x", "<p><table><tr><td>x"])
@pytest.mark.parametrize("start", ["<ul>", "<dl>", "<table>", ""])
def test_items_without_end_tags_take_linear_time(start, item):
    began = time.process_time()
    html_text.main_text(start + item * 30_000)
    assert time.process_time() - began < 4


def test_items_end_each_other():
    paths = {b.path for b in html_text.blocks("<ul><li><p>a<li><p>b<li>c</ul>")}
    assert len(paths) == 2  # ul li p and ul li
    found = html_text.blocks("<table><tr><td><p>a<td>b<tr><td><p>c</table>")
    assert [b.text for b in found] == ["a", "b", "c"] and len({b.path for b in found}) == 2
    assert [b.text for b in html_text.blocks("<dl><dt>a<dd><p>b<dt>c<dd>d</dl>")] == ["a", "b", "c", "d"]


SECTIONS = paragraphs(3)


@pytest.mark.parametrize("mark", ["share-price", "follow-up", "reply", "related-work", "search-history", "social-contract"])
def test_dense_text_makes_up_for_a_word(mark):
    """A section of the article whose class has a word that others use for menus and the like."""
    html = f"<body><nav><a href=/>Home</a></nav><article>{marked_up(STORY)}<section class={mark}>{marked_up(SECTIONS)}</section></article></body>"
    assert kept(html) == [*STORY, *SECTIONS]
    few = f"<body><article>{marked_up(STORY)}<section class={mark}><p>Send</p><p>To a friend</p></section></article></body>"
    assert kept(few) == STORY


@pytest.mark.parametrize("mark", ["id=kommentare", "class=werbung", "class='publicité'", "class=anuncios", "class=user-comments", "id=Kommentar-Liste", "class=comentarios"])
def test_marks_in_four_languages(mark):
    assert kept(f"<body><div>{marked_up(STORY)}</div><div {mark}>{marked_up(SECTIONS)}</div></body>") == STORY


@pytest.mark.parametrize("aside", ["<ul><li>Sol<li>Mar<li>Luz</ul>", "<div>Kurz</div><div>Neu</div>", "<table><tr><td>1<td>2<tr><td>3<td>4</table>", "<div><a href=/a>Home</a> <a href=/b>News</a> <a href=/c>Sport</a></div>"])
@pytest.mark.parametrize("before", [True, False])
def test_text_and_punctuation_alone_tell_content(aside, before):
    """Nothing but how long the text is and how it is punctuated: no class, id or landmark."""
    parts = [aside, f"<div><section>{marked_up(STORY)}</section></div>"]
    assert kept(f"<body><div>{''.join(parts if before else parts[::-1])}</div></body>") == STORY


def test_the_ratios_change_what_the_marks_alone_would_give(monkeypatch):
    pages = [f"<body><article>{marked_up(STORY)}<section class=share><p>Send</p><p>To a friend</p></section></article></body>", f"<body><div>{marked_up(STORY)}</div><ul><li>Sol<li>Mar</ul></body>", PAGE]
    want = [kept(p) for p in pages]
    monkeypatch.setattr(html_text, "path_scores", lambda found: {b.path: html_text.WEIGHTS[b.path.mark] for b in found})
    assert all(kept(p) != w for p, w in zip(pages, want, strict=True))
