import random

import time

import pytest

from rowferry.llm.html_text import extract_text, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li><li><a href="/b">About us</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this long, long site of ours, do you agree?</div><!-- ad -->
<div class="ad">Buy this now, it is very cheap today only.</div>
<article><h1>Title &amp; more</h1>{body}</article>
<aside>See also other things that are here to read.</aside><form>Name <input name=n><button>Go</button></form>
<div id="comments"><p>A reader says something here that is quite long too.</p></div><footer>&copy; me</footer></body></html>"""


@pytest.mark.parametrize(
    "body, text",
    [
        ("<p>One  two\n three.</p><p>Four <b>five</b> <a href='x'>six</a>.</p>", "One two three.\nFour five six."),
        ("<p><b>Open<br><p>Next &lt;tag&gt; &#233;&nbsp;x</p>", "Open\nNext <tag> é x"),
        ("<div><p>Deep words that stand here.</p><div>More of them</div></div>tail", "Deep words that stand here.\nMore of them\ntail"),
        ("<p>a</p><script>x</script><p>b</p><style>c</style>", "a\nb"),
        ("<ul><li>first<li>second</ul><p>x &amp y</p>", "first\nsecond\nx & y"),
    ],
)
def test_article(body, text):
    assert main_text(PAGE.format(body=body)) == "Title & more\n" + text


def test_without_article_the_densest_part(spark):
    menu = "".join(f"<li><a href={i}>Link {i}</a>" for i in range(20))
    prose = "".join(f"<p>Sentence number {i} of a text that goes on for quite a while, as texts do.</p>" for i in range(6))
    found = main_text(f"<body><div><ul>{menu}</ul></div><div><div>{prose}</div></div><div><a href=x>Imprint</a></div></body>")
    assert found.count("\n") == 5 and found.startswith("Sentence number 0") and "Link" not in found and "Imprint" not in found


@pytest.mark.parametrize("page", ["", "<", "<p", "</p>", "<!-- x", "<script>x", "<nav>a", "<head><title>x</title>", " \n "])
def test_nothing(page):
    assert main_text(page).strip("<") == ""


def test_every_word_of_an_article_stays():
    draw = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    body = "".join(draw.choice(["<p>", "</p>", "<b>", "</b>", "<br>", "<div>", "</div>", " "]) + w + " " for w in words)
    assert main_text(PAGE.format(body=body)).split()[3:] == words


@pytest.mark.parametrize("page", ["<div>" * 20000 + "x", "<p>word " * 20000, "<b " * 20000, "<a href='" * 5000, "&" * 50000])
def test_long_broken_pages_end(page):
    assert isinstance(main_text(page), str)


def test_rows(spark):
    rows = [(1, "u", "<p>a</p>", "x"), (1, "u", "<p>a</p>", "x"), (None, None, None, None), (2, None, "", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = sorted(map(tuple, extract_text(df).collect()), key=repr)
    assert found == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0), (2, None, "", 0)], key=repr)
    assert extract_text(df.limit(0)).count() == 0


def test_unclosed_containers_keep_the_article():
    story = " ".join(f"word{i}" for i in range(80))
    for start in (
        "<head><title>x</title><meta name=a><body>",
        "<head><title>x</title>",
        "<body><div><select><option>one</div>",
        "<body><object data=x>",
        "<body><svg><path d='m0'>",
        "<body><nav><ul><li><a href=/>home</a></ul>",
        "<body><aside><a href=/>more</a>",
        "<body><form><input name=q>",
    ):
        assert main_text(f"<html>{start}<p>{story}</p><p>{story}</p></body></html>") == f"{story}\n{story}", start


@pytest.mark.parametrize(
    "page",
    [
        "<div class='content has-sidebar'>{}</div>",
        "<div id='wrapper' class='no-sidebar'>{}</div>",
        "<div class='sidebar-page banner'>{}</div>",
        "<div class='with-menu widget'><article>{}</article></div>",
        "<div class=ad>Buy now, today only.</div><div id='main-search'>{}<div class=ad>Cheap and cheerful offers.</div></div>",
        "<div><section id='related-work'>{}</section><div class='comments'><p>I read it all.</p></div></div>",
    ],
)
def test_names_of_wrappers_keep_the_article(page):
    story = " ".join(f"word{i}" for i in range(80))
    body = f"<h1 class='header'>Title</h1><p>{story}</p><p>{story}</p>"
    assert main_text(f"<html><body>{page.format(body)}</body></html>") == f"Title\n{story}\n{story}"


def test_long_comments_stay_out():
    story, said = "This is the article. " * 20, "<article class=comment><p>" + "A reader says so. " * 30 + "</p></article>"
    page = f"<body><article><p>{story}</p></article><div id=comments>{said * 4}</div></body>"
    assert main_text(page) == story.strip()


STORY = " ".join(f"word{i}" for i in range(60))


def test_line_breaks_are_white_space():
    assert main_text("<p>one<br>two<br/>three</p>") == "one two three"
    assert main_text(f"<div>{STORY}<hr>{STORY}</div>") == f"{STORY}\n{STORY}"


@pytest.mark.parametrize("wrapper", ["<form action=x>{}</form>", "<dialog open>{}</dialog>", "<div hidden>{}</div>", "<div hidden=''><form>{}</form></div>"])
def test_pages_inside_a_form_or_hidden_container(wrapper):
    body = f"<h1>Title</h1><p>{STORY}</p><nav><a href=/>home</a></nav><p>{STORY}</p>"
    assert main_text(f"<html><body>{wrapper.format(body)}</body></html>") == f"Title\n{STORY}\n{STORY}"


@pytest.mark.parametrize("name", ["notice", "cookie-notice", "ad", "newsletter-popup"])
@pytest.mark.parametrize("parts", [1, 6])
def test_large_notices_are_no_page(name, parts):
    said = "".join(f"<p>{' '.join(f'n{i}' for i in range(300))}</p>" for _ in range(parts))
    for page in (f"<p>{STORY}</p><div class={name}>{said}</div>", f"<div class={name}>{said}</div><div><p>{STORY}</p></div>"):
        assert main_text(f"<html><body>{page}</body></html>") == STORY


def test_hidden_and_form_parts_stay_out():
    page = f"<body><p>{STORY}</p><p>{STORY}</p><div hidden>not shown here</div><form>Name <p>and more fields</p></form></body>"
    assert main_text(page) == f"{STORY}\n{STORY}"


@pytest.mark.parametrize(
    "page",
    ["<nav>" * 20000 + "x", "<nav>" * 20000 + "</nav>" * 20000 + "<p>x", "<select>" * 20000, "<div class=ad>" * 20000 + "x", "<svg>" * 20000 + "<p>y"],
)
def test_hostile_pages_take_little_time(page):
    start = time.time()
    main_text(page)
    assert time.time() - start < 3


def recursive(node, share):
    """Densities of a small tree (tag, text, children), from the leaves up, by their definition."""
    import math

    tag, text, children = node
    below = [recursive(c, share) for c in children]
    linked = tag == "a"
    chars = len(text) + sum(b["chars"] for b in below)
    tags = 1 + sum(b["tags"] for b in below)
    link_chars = chars if linked else sum(b["link_chars"] for b in below)
    link_tags = tags if linked else sum(b["link_tags"] for b in below)
    density = 0.0
    if chars:
        odds = chars / max(link_chars, 1) * tags / max(link_tags, 1)
        base = math.log(chars / max(chars - link_chars, 1) * link_chars + share * chars + math.e)
        density = chars / tags * max(math.log(odds) / math.log(max(base, 1.000001) + 1e-9), 0)
    total = sum(b["density"] for b in below)
    found = {"chars": chars, "tags": tags, "link_chars": link_chars, "link_tags": link_tags, "density": density, "sum": total}
    best = max([found, *(b["best"] for b in below)], key=lambda b: b["sum"])
    return {**found, "best": best}


def test_selected_subtree_is_that_of_a_recursive_search():
    """Pages without names or articles: the element with the greatest sum of its children's densities is in the result."""
    draw = random.Random(6)

    def tree(depth):
        n = draw.randint(0, 4) if depth else 0
        tag = draw.choice(["div", "section", "div", "span"]) if depth else draw.choice(["b", "a", "i"])
        return tag, " ".join(f"x{draw.randint(100, 999)}" for _ in range(draw.choice([0, 0, 3, 25]))), [tree(depth - 1) for _ in range(n)]

    def source(node):
        return f"<{node[0]}>{node[1]}{''.join(map(source, node[2]))}</{node[0]}>"

    def words(node):
        return [*node[1].split(), *(w for c in node[2] for w in words(c))]

    def links(node, linked=False):
        linked = linked or node[0] == "a"
        return (len(node[1]) if linked else 0) + sum(links(c, linked) for c in node[2])

    checked = 0
    for _ in range(60):
        body = ("body", "", [tree(4) for _ in range(3)])
        size = recursive(body, 0)["chars"]
        if not size:
            continue
        found = main_text(f"<html>{source(body)}</html>")
        best = recursive(body, links(body) / size)["best"]
        # the subtree itself, found again by its sums
        def holders(node):
            own = recursive(node, links(body) / size)
            return [node] * (own["sum"] == best["sum"] and own["sum"] > 0) + [h for c in node[2] for h in holders(c)]

        for node in holders(body)[-1:]:
            assert all(word in found for word in words(node))
            checked += 1
    assert checked > 20
