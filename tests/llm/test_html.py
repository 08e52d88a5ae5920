import pytest

from ledgerloom.llm.html import extract, main_text

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>'
    '<nav><ul><li><a href="/a">menu</a></li></ul></nav><!-- ad 1 --><div class="ad">buy this, now, please, do</div>'
    "<article><h1>Title &amp; more</h1><p><b>One,\n two &lt;three&gt;&nbsp;four.<br><p>Second &#233; <a href=x>link</a></p></article>"
    '<aside>side</aside><section id="comments"><p>reader says, well, a lot, of, things</p></section><footer>&copy; f</footer>'
)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<b>", ""),
        ("plain", "plain"),
        ("<p>one", "one"),
        ("<div><p>a</p></div><foo", "a"),
        ("<p>x<!-- never closed", "x"),
        ("<p>x<script>y", "x"),
        (PAGE, "Title & more\n\nOne, two <three> four.\n\nSecond é link"),
        (PAGE[: PAGE.index("<aside>")], "Title & more\n\nOne, two <three> four.\n\nSecond é link"),
        (PAGE + "</body></html>", "Title & more\n\nOne, two <three> four.\n\nSecond é link"),
        ("<ul><li>a<li>b</ul>", "a\n\nb"),
        ("<main><form>f<input></form><p>kept</p><button>b</button></main>", "kept"),
        ("<div role=navigation>n</div><p hidden>h</p><p style='display: none'>d</p><p>kept</p>", "kept"),
        ("<p a='>'>quoted</p>", "quoted"),
        ("<P>Upper</P><P>Case</P>", "Upper\n\nCase"),
        ("a < b & c", "a < b & c"),
    ],
)
def test_pages(page, text):
    assert extract(page) == text


def test_containers_without_an_article_element():
    body = "".join(f"<p>Paragraph {i}, long enough, with commas, to count for something.</p>" for i in range(5))
    links = "".join(f'<li><a href="{i}">link number {i}</a></li>' for i in range(30))
    assert extract(f"<body><div><ul>{links}</ul></div><div id=x>{body}</div></body>").count("Paragraph") == 5
    assert "link number" not in extract(f"<body><div><ul>{links}</ul></div><div id=x>{body}</div></body>")


ARTICLE = "<p>One, two, three of the article.</p><p>Four, five, six of it.</p>"
OUTSIDE = "<div class='top'><p>line at the top</p></div>"


@pytest.mark.parametrize("names", ["class='content has-sidebar'", "class='post no-sidebar'", "id=content class=with-comments", "class='entry notice-free'"])
def test_a_likely_name_beside_an_unlikely_one(names):
    assert "One, two, three of the article.\n\nFour, five, six of it." in extract(f"<body>{OUTSIDE}<div {names}>{ARTICLE}</div></body>")


@pytest.mark.parametrize("tag", ["article", "main", "div"])
@pytest.mark.parametrize("names", ["layout with-comments", "page-with-sidebar", "page sidebar"])
def test_a_container_of_the_article_is_no_menu_whatever_its_name(tag, names):
    thread = "<div id=comments class=comments-area><article class=comment-body><p>reader says, well</p></article></div>"
    page = f"<body><footer>f</footer><div class='{names}'><{tag}>{ARTICLE}</{tag}>{thread}</div></body>"
    assert extract(page) == "One, two, three of the article.\n\nFour, five, six of it."


def test_long_threads_and_teasers_stay_out():
    thread = "<div id=comments class=comments-area>" + "<div class=comment><p>reader says, well, a lot, of, things</p></div>" * 9 + "</div>"
    teasers = "<div class=related><article><p>Other, text</p></article></div><div class='main-menu'><p>menu, of, all</p></div>"
    for page in (f"<div id=x>{ARTICLE}</div>{thread}{teasers}", f"<article>{ARTICLE}</article>{thread}{teasers}"):
        assert extract(page) == "One, two, three of the article.\n\nFour, five, six of it."


@pytest.mark.parametrize("tag", ["article", "main"])
def test_lists_of_links_within_the_article_stay(tag):
    links = "".join(f"<li><a href={i}>reference {i}</a></li>" for i in range(5))
    table = "".join(f"<tr><td><a href={i}>cell {i}</a></td></tr>" for i in range(5))
    found = extract(f"<body><ul>{links}</ul><{tag}>{ARTICLE}<ul>{links}</ul><table>{table}</table></{tag}></body>")
    assert found.count("reference") == 5 and found.count("cell") == 5
    menu = f"<nav><ul>{links}</ul></nav><ul class=menu>{links}</ul>"
    assert "reference" not in extract(f"<body><{tag}>{menu}{ARTICLE}</{tag}></body>")


def section(i, depth, words="Paragraph {i} of the text, long enough, with commas, to count for something."):
    return "<div>" * depth + f"<h2>Heading {i}</h2><p>{words.format(i=i)}</p>" + "</div>" * depth


@pytest.mark.parametrize("depth", [1, 2, 3, 6])
@pytest.mark.parametrize("outer", ["<div id=x>{}</div>", "<div><div><div>{}</div></div></div>", "<table><tr><td>{}</td></tr></table>"])
def test_an_article_of_plain_divs_keeps_all_sections(depth, outer):
    links = "".join(f'<li><a href="{i}">link number {i}</a></li>' for i in range(30))
    sections = "<h1>The title</h1>" + "".join(section(i, depth) for i in range(12))
    references = "<h2>References</h2><ol>" + "".join(f"<li><a href={i}>reference {i}</a></li>" for i in range(5)) + "</ol>"
    page = f"<body><div><ul>{links}</ul></div>{outer.format(sections + references)}<div><ul>{links}</ul></div></body>"
    found = extract(page).split("\n\n")
    assert [b for b in found if b.startswith("Paragraph")] == [f"Paragraph {i} of the text, long enough, with commas, to count for something." for i in range(12)]
    assert found[0] == "The title" and sum(b.startswith("Heading") for b in found) == 12
    assert [b for b in found if b.startswith("reference")] == [f"reference {i}" for i in range(5)] and not any("link" in b for b in found)


@pytest.mark.parametrize("depth", [0, 1, 2])
def test_a_short_section_beside_a_long_one_and_its_heading_stay(depth):
    long = section(1, depth + 1, "Long {i}, " * 200)
    page = f"<body><div id=x>{long}<h2>Closing</h2>{'<div>' * depth}<p>The end.</p>{'</div>' * depth}</div></body>"
    assert extract(page).endswith("Closing\n\nThe end.") and extract(page).startswith("Heading 1\n\nLong 1")


def test_sections_in_the_body_are_all_kept():
    page = "<body>" + "".join(section(i, 4) for i in range(9)) + "</body>"
    assert extract(page).count("Paragraph") == 9


@pytest.mark.parametrize("name", ["related-work", "share-of-voice", "social-sciences", "comment-on-method", "notice-periods"])
@pytest.mark.parametrize("outer", ["<article>{}</article>", "<div id=x>{}</div>"])
def test_sections_named_by_their_topic_stay(name, outer):
    page = outer.format(f"{ARTICLE}<section class={name}><h2>Of that</h2><p>Others, too, have worked on it.</p></section>")
    assert extract(f"<body>{page}</body>").endswith("Of that\n\nOthers, too, have worked on it.")


@pytest.mark.parametrize("name", ["related-posts", "share-buttons", "social-bar", "comment-list", "comment-12", "cookie-info", "ad-slot-3", "my-ads", "newsletter-box"])
def test_parts_named_by_their_layout_go(name):
    assert extract(f"<body><article>{ARTICLE}<div class={name}><p>Some, words of it.</p></div></article></body>") == ARTICLE_TEXT


ARTICLE_TEXT = "One, two, three of the article.\n\nFour, five, six of it."


def test_deep_and_long_pages():
    assert extract("<div>" * 50_000 + "x") == "x"
    assert extract("<p>a</p></b>" * 20_000).count("a") == 20_000
    assert extract('<a "' * 5000) == ""


def test_table(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "<p>é😀</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as n_chars")
    found = main_text(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in found.collect()) == [(0, 2), (1, 51), (1, 51), (2, 0)]
    assert main_text(pages.limit(0)).count() == 0
