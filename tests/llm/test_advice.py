"""What the review of round 1 found missing."""

import pytest

from tilewright.llm import html_text

from .test_models import documents, shingles


def brute_kept(rows, percent):
    """Ids of the texts that are the smallest of their component, the ids being distinct."""
    sets = {d: shingles(t) for d, t in rows}
    least = {d: d for d in sets}

    def root(d):
        while least[d] != d:
            d = least[d]
        return d

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return sorted(d for d in least if least[d] == d)


def test_pipeline_drops_near_copies_from_similarity_0_8_on(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_kept(rows, 80)
    assert want != brute_kept(rows, 85)  # the table has pairs between
    assert sorted(r.doc_id for r in corpus_pipeline.without_near_copies(spark, docs, sf_dir).collect()) == want
    words = [f"w{i}" for i in range(104)]  # 100 shingles, of which the other texts have 80 and 79 and no more
    texts = [" ".join(words), " ".join(words[:84]), " ".join(words[104 - 83 :])]
    found = corpus_pipeline.without_near_copies(spark, documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), sf_dir)
    assert sorted(r.doc_id for r in found.collect()) == [0, 2]


def paragraphs(n, first=0):
    return [f"Paragraph number {i} has a first sentence, with a comma. It has a second one, too." for i in range(first, first + n)]


def marked_up(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


LINKS = "".join(f"<li><a href=/{i}>Place {i}</a></li>" for i in range(6))


@pytest.mark.parametrize(
    "html",
    [
        "<body><div>{a}</div><ul>{links}</ul><div>{b}</div></body>",
        "<body><ul>{links}</ul><div>{b}</div><ul>{links}</ul><div>{a}</div></body>",
        "<main><article>{a}</article><div>{b}</div></main>",
        "<main><section>{b}</section><article>{a}</article></main>",
    ],
)
def test_text_in_several_siblings_is_whole(html):
    a, b = paragraphs(22), paragraphs(3, 22)
    want = b + a if html.index("{b}") < html.index("{a}") else a + b
    assert html_text.main_blocks(html.format(a=marked_up(a), b=marked_up(b), links=LINKS)) == want


@pytest.mark.parametrize(
    "html",
    [
        "<form id=aspnetForm><div>{text}</div></form>",
        "<form id=aspnetForm><div class=sidebar>Some more, here.</div><div>{text}</div></form>",
        "<div class=overflow-hidden><div class=header-fixed>{text}</div></div>",
        "<div class=layout-sidebar-right><article>{text}</article></div>",
        "<div class=layout-sidebar-right><main>{text}</main><div class=sidebar>Some more, here.</div></div>",
        "<div role=form><fieldset>{text}</fieldset></div>",
        "<body><p>Before it, a line.</p><div class=promo><article>{text}</article></div></body>",
    ],
)
def test_wrappers_with_the_text_are_not_left_out(html):
    texts = paragraphs(4)
    found = html_text.main_blocks(html.format(text=marked_up(texts)))
    assert [t for t in found if t != "Before it, a line."] == texts


def test_marks_on_lines():
    html = "<div><h1 class=page-header>Heading</h1><p class=teaser>A teaser, to begin with.</p>{}<p>Take <span class=warning>great</span> care, always.</p></div>"
    assert html_text.main_blocks(html.format(marked_up(paragraphs(3)))) == ["Heading", "A teaser, to begin with.", *paragraphs(3), "Take great care, always."]


@pytest.mark.parametrize("rest", ["<div class=comments><article>{}</article></div>", "<div hidden><article>{}</article></div>", "<nav>{}</nav>", "<div class=ad>{}</div>", "<noscript>{}</noscript>"])
def test_what_is_no_content_stays_out_however_long(rest):
    assert html_text.main_blocks(f"<div>{marked_up(paragraphs(2))}</div>{rest.format(marked_up(paragraphs(40, 2)))}") == paragraphs(2)


def test_lists_of_links_in_the_text_stay():
    places = [f"Place {i}" for i in range(6)]
    text, more = paragraphs(4), paragraphs(2, 4)
    story = f"{marked_up(text)}<ul>{LINKS}</ul>{marked_up(more)}"
    assert html_text.main_blocks(f"<article>{story}</article>") == text + places + more
    assert html_text.main_blocks(f"<ul>{LINKS}</ul><div>{story}</div><ul>{LINKS}</ul>") == text + places + more
    assert html_text.main_blocks(f"<div>{marked_up(text)}<h2>Sources</h2><ul>{LINKS}</ul></div>") == [*text, "Sources", *places]


def test_lists_of_links_around_the_text_go():
    text = paragraphs(4)
    assert html_text.main_blocks(f"<ul>{LINKS}</ul>{marked_up(text)}") == text
    assert html_text.main_blocks(f"<div><ul>{LINKS}</ul></div><div><div>{marked_up(text)}</div></div><div><ul>{LINKS}</ul></div>") == text


def test_near_copies_under_a_repeated_id(spark, sf_dir):
    import corpus_pipeline

    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (5, a + " end"), (5, b), (7, b + " end"), (8, c), (8, c + " end"), (None, a), (None, c), (9, None)]
    found = corpus_pipeline.without_near_copies(spark, documents(spark, [(i, t, "en", "s") for i, t in rows]), sf_dir).collect()
    kept = [(r.doc_id, r.text) for r in found]
    assert len([r for r in kept if r[0] == 8]) == 1 and {t for i, t in kept if i == 8} <= {c, c + " end"}
    assert sorted((str(i), str(t)) for i, t in kept if i != 8) == sorted((str(i), str(t)) for i, t in [(1, a), (5, b), (None, a), (None, c), (9, None)])
