from __future__ import annotations

from sparvane.llm import html_text as h

HEAD = "<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t='</p>';</script></head><body><!-- c --><nav><ul><li><a href=/>Home</a></li><li>About</li></ul></nav>"
TAIL = "<footer>&copy; us</footer></body></html>"


def test_article_without_the_rest():
    page = HEAD + "<div class='ad banner'>Buy</div><article><header><h1>Title &eacute;</h1></header><p>One <b>two</b>\n  three.<p>Four&nbsp;five &am<br>six<form>f</form><section class=comments><p>Reader</p></section></article><aside>side</aside>" + TAIL
    assert h.extract(page, set()) == "Title é\nOne two three.\nFour five &am\nsix"


def test_pages_without_article():
    page = HEAD + "<div id=cookie-notice>We use cookies</div><div><p>Main text.</p></div>" + TAIL
    assert h.extract(page, set()) == "Main text."
    assert h.extract(HEAD + "<div class=story><p>Told.</p></div><p>Other</p>" + TAIL, set()) == "Told."


def test_broken_pages():
    assert h.extract("", set()) == "" and h.extract("plain < text", set()) == "plain < text"
    assert h.extract("<article><p>cut of", set()) == "cut of"
    assert h.extract("<article><p>a</p><script>x", set()) == "a"
    assert h.extract("<article><p title='x > y'>a</p></article", set()) == "a"


def test_words_of_the_whole_page_are_no_boilerplate():
    page = "<html class='no-js cookie'><body class='has-sidebar'><main id=main class=widget><article class='post with-comments'><p>Text.</p><div class=comments>Reader</div></article></main><div class=sidebar>side</div></body></html>"
    assert h.extract(page, set()) == "Text."
    pages = [page.replace("Text.", t) for t in ("one", "two")]
    wrapper = h.align(h.stream(pages[0]), h.stream(pages[1]))
    assert h.extract(pages[1], set(h.article_paths(wrapper))) == "two"


def test_head_without_end_tag():
    head = "<html><head><meta charset=utf-8><title>T</title><link href=x><style>p{}</style><noscript><link href=y></noscript>\n"
    for rest in ("<body><p>Text.</p></body>", "<p>Text.</p>", "<div><p>Text.</p></div>", "<a href=z>Text.</a>", "Text."):
        assert h.extract(head + rest + "</html>", set()) == "Text."


def test_wrappers_generalise():
    pages = [HEAD + "<article><h1>%s</h1>%s</article>" % (t, "".join(f"<p>{t}{i}</p>" for i in range(n))) + TAIL for t, n in (("a", 1), ("b", 4), ("c", 2))]
    wrapper = h.stream(pages[0])
    for p in pages[1:]:
        wrapper = h.align(wrapper, h.stream(p))
    assert h.slots(wrapper)["html/body/article/p"] and not h.slots(wrapper)["html/body/footer"]
    size = len(str(wrapper))
    for p in pages * 3:
        wrapper = h.align(wrapper, h.stream(p))
    assert len(str(wrapper)) <= size + 100
    assert h.article_paths(wrapper) == ["html/body/article/h1", "html/body/article/p"]


def test_optional_and_repeated_groups():
    a, b = h.stream("<div><p>x</p><hr><p>y</p></div>"), h.stream("<div><p>x</p><p>y</p><p>z</p></div>")
    both = h.align(a, b)
    assert any(n[0] in "or" for n in both)
    assert [h.shape(n) for n in h.align(both, a)] == [h.shape(n) for n in h.align(both, b)]


def test_template_text_is_dropped_without_article():
    pages = [f"<div><p>Welcome to our site</p></div><main2><div><q>x</q><h2>{t} text</h2></div></main2>" for t in ("one", "two", "three")]
    wrapper = h.stream(pages[0])
    for p in pages[1:]:
        wrapper = h.align(wrapper, h.stream(p))
    paths = set(h.article_paths(wrapper))
    common = set.intersection(*[h.literals(h._blocks(p)) for p in pages])
    assert h.extract(pages[1], paths, common) == "two text"


def test_all_pages(spark):
    rows = [(i, f"http://H{i % 2}.example/{i}", HEAD + f"<article><p>text {i}</p></article>" + TAIL, "x") for i in range(9)]
    rows += [(9, None, None, "x"), (None, "odd", "<p>t</p>", "x"), (1, rows[1][1], rows[1][2], "x"), (11, "http://h0.example/", "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = h.main_text(df).collect()
    assert len(got) == len(rows)
    text = {r.page_id: (r.text, r.n_chars) for r in got}
    assert text[4] == ("text 4", 6) and text[9] == ("", 0) and text[None] == ("t", 1) and text[11] == ("", 0)
    assert h.main_text(df.limit(0)).collect() == []


def texts(spark, pages):
    """Each page's text, all pages of one host."""
    rows = [(i, f"http://a.example/{i}", p) for i, p in enumerate(pages)]
    return [r.text for r in h.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()]


def test_links_that_all_articles_have_are_dropped(spark):
    def page(i: int) -> str:
        return HEAD + f"<article><h1>Title {i}</h1><p class=social>the social contract {i}</p><div class=cta><a href=/f>Tell a <b>friend</b></a></div><p>Text {i} and <a href=/x>a link</a></p><p><a href=/{i}>Source {i}</a></p><p>All rights reserved here.</p></article><div class=comments>c {i}</div>" + TAIL

    # expected by hand: of what all pages have, only what is a link as a whole goes; one page alone tells nothing
    whole = lambda i, cta: f"Title {i}\nthe social contract {i}\n{cta}Text {i} and a link\nSource {i}\nAll rights reserved here."
    for n in (2, 3, 7):
        assert texts(spark, [page(i) for i in range(n)]) == [whole(i, "") for i in range(n)]
    assert texts(spark, [page(0)]) == [whole(0, "Tell a friend\n")]
    assert h.extract(page(3), set()) == whole(3, "Tell a friend\n")


def test_headings_and_sentences_that_a_host_repeats_stay(spark):
    cake = lambda i: f"<main><article><h1>Cake {i}</h1><h2>Ingredients</h2><p>flour {i} grams</p><h2>Method</h2><p>mix it {i} times</p><p>Serve warm.</p></article></main>"
    for n in (1, 2, 5):
        assert texts(spark, [cake(i) for i in range(n)]) == [f"Cake {i}\nIngredients\nflour {i} grams\nMethod\nmix it {i} times\nServe warm." for i in range(n)]


def test_names_count_as_a_whole():
    assert h.extract("<main><h1>Intro</h1><article><p>a</p></article><p>after</p></main>", set()) == "Intro\na\nafter"
    assert h.extract("<main><div class='social-science-form'><p>Real text of the article here.</p></div><p>Other.</p></main>", set()) == "Real text of the article here.\nOther."
    assert h.extract("<main><div class='x cookie-banner'><p>Cookies!</p></div><div id=comments_section><p>c</p></div><p>Other.</p></main>", set()) == "Other."


def test_text_between_own_texts_stays_without_article(spark):
    page = lambda i: f"<div>Welcome</div><div><h2>Day {i}</h2><div>Weather</div><div>sun {i}</div></div><div>(c) all of us</div>"
    assert texts(spark, [page(i) for i in range(3)]) == [f"Day {i}\nWeather\nsun {i}" for i in range(3)]


def test_copies_of_one_page_keep_their_text(spark):
    rows = [(i, "http://a.example/", HEAD + "<article><p>Same text.</p></article>" + TAIL) for i in range(5)]
    assert {r.text for r in h.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()} == {"Same text."}


def test_main_before_teasers():
    assert h.extract("<main><p>m</p></main><article><p>teaser</p></article>", set()) == "m"
    assert h.extract("<main><article><p>a</p></article><p>more</p></main>", set()) == "a\nmore"


def test_long_pages_are_aligned_in_time():
    import random
    import time

    def page(seed: int) -> str:
        rng = random.Random(seed)
        kinds = ["p", "h2", "div", "ul", "pre", "blockquote"]
        return HEAD + "<article>" + "".join(f"<{k} class=k{rng.randrange(40)}>{'word ' * rng.randint(5, 60)}{rng.random()}</{k}>" for k in (rng.choice(kinds) for _ in range(5_500))) + "</article>" + TAIL

    pages = [page(1), page(2)]
    assert min(map(len, pages)) > 1_000_000
    began = time.time()
    wrapper = h.align(h.stream(pages[0]), h.stream(pages[1]))
    assert time.time() - began < 20
    assert set(h.slots(wrapper)) >= set(h.slots(h.stream(pages[0]))) | set(h.slots(h.stream(pages[1])))


def test_matches_cover_both_sides():
    import random

    rng = random.Random(3)
    for _ in range(30):
        x, y = ([rng.choice("abcdefgh") + str(rng.randrange(200)) for _ in range(rng.randint(0, 900))] for _ in range(2))
        y = y + x[: len(x) // 2]
        i = p = 0
        for equal, a, b, c, d in h._matches(x, y):
            assert (a, c) == (i, p) and (not equal or x[a:b] == y[c:d])
            i, p = b, d
        assert (i, p) == (len(x), len(y))
