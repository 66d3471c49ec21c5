"""Pages whose markup leaves out what HTML lets it leave out, and attributes that only mention a word."""

import random
import time
from html.parser import HTMLParser

import pytest

from colloquy.llm.html_extract import main_text

ARTICLE = "<article><p>One block, with commas, and text.</p><p>Another one, here.</p></article>"
TEXT = "One block, with commas, and text.\n\nAnother one, here."


@pytest.mark.parametrize("head", [
    "<html><head><title>x</title><body>", "<head><meta charset=utf-8><title>x</title>", "<head><script>var a = '<p>no, no</p>'</script><style>p{}</style>",
    "<head><noscript><img src=x></noscript><link rel=a><body>", "<head><template><p>no, no, no</p></template><body>", "<html><head><title>x</title></head><body>",
])
def test_open_head(head):
    assert main_text(head + ARTICLE) == TEXT


def test_bare_text_ends_a_head():
    assert main_text("<head><title>x</title> Bare text, here, and more") == "Bare text, here, and more"


@pytest.mark.parametrize("attributes", [
    'title="The hidden cost"', 'data-x="a hidden thing"', "title='see class=advert here'", 'data-a="x aria-hidden=true"', 'aria-hidden="false"', "data-hidden=1",
])
def test_words_in_values_hide_nothing(attributes):
    assert main_text(f"<div {attributes}><p>A block, with commas, and text.</p></div>") == "A block, with commas, and text."


@pytest.mark.parametrize("attributes", ["hidden", "HIDDEN", 'hidden=""', 'title="a b" hidden', "aria-hidden=true", "aria-hidden = 'TRUE'", 'id="x" class="big advert"', "role=navigation"])
def test_hidden_and_hinted_elements(attributes):
    assert main_text(f"<div {attributes}><p>A block, with commas, and text.</p></div><p>Rest.</p>") == "Rest."


@pytest.mark.parametrize("wrapper", [
    '<div class="container has-sidebar">%s</div>', '<div class="no-comments">%s</div>', '<div class="elementor-widget">%s</div>', '<form id="aspnetForm">%s</form>', '<div class="sidebar">%s</div>',
    '<form><div class="widget"><div class="page-header">%s</div></div></form>',
])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_wrappers_are_no_hints(wrapper, tag):
    page = "<nav><a href=x>Home</a></nav>" + wrapper % ARTICLE.replace("article", tag) + "<div class=ad>Buy this, now</div>"
    assert main_text(page) == TEXT


def test_hints_beside_and_in_an_article():
    inside = ARTICLE.replace("</article>", '<section class="notice-period"><p>Three months, as agreed.</p></section>%s</article>')
    assert main_text(inside % "") == TEXT + "\n\nThree months, as agreed."
    for left_out in ('<div class="notice">No, no, no.</div>', '<div class="comment-list"><p>First, of course!</p></div>', '<form class=x>Name, please</form>', '<div class="post-footer">Tags, tags</div>'):
        assert main_text(inside % left_out) == TEXT + "\n\nThree months, as agreed."
    comments = '<div id="comments">' + '<article class="comment-body"><p>A long comment, longer than the article, with many, many, many words in it.</p></article>' * 9 + "</div>"
    assert main_text(ARTICLE.replace("article", "div") + comments) == TEXT


@pytest.mark.parametrize("piece", [
    "<div>x", "<a '", "<a '>'", '<a "', "<li>x", "<ul><li>x", "<form>x", "<table><tr><td>x", "<p><td>", "<!--", "<a", "<div class=widget>x, y", "<head><template><div>", "</div><p>",
])
def test_time_is_linear(piece):
    """Pages of one piece over and over, a hundred thousand characters or more."""
    started = time.process_time()
    main_text(piece * (150_000 // len(piece)))
    main_text("<p><td>" + "<q1>" * 10_000 + piece * 10_000)
    assert time.process_time() - started < 20


class _Plain(HTMLParser):
    """An independent tree of well-formed pages: [tag, parent, items]."""

    def __init__(self, page):
        super().__init__()
        self.root = self.at = ["html", None, []]
        self.all = [self.root]
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        node = [tag, self.at, []]
        self.at[2].append(node)
        self.at = node
        self.all.append(node)

    def handle_endtag(self, tag):
        self.at = self.at[1]

    def handle_data(self, data):
        self.at[2].append(data)


def _plainly(page):
    """Points by walking up from each block, sums by walking down."""
    tree, points = _Plain(page), {}
    bonus = {"section": 3.0, "div": 3.0}

    def texts(node):
        return [t for x in node[2] for t in ([x] if isinstance(x, str) else texts(x))]

    for node in tree.all:
        for block in node[2]:
            if isinstance(block, str):
                up, level = node if node[0] in ("div", "section", "html") else node[1], 0
                while up and level < 8:
                    points[id(up)] = points.get(id(up), 0) + (1 + block.count(",") + min(len(block) / 100, 3)) * (1 if level == 0 else 1 / (2 * level))
                    up, level = up[1], level + 1
    score = {id(n): points[id(n)] + bonus.get(n[0], 0) if id(n) in points else 0 for n in tree.all}
    best = max(tree.all, key=lambda n: score[id(n)])
    if not score[id(best)]:
        return ""
    if best[1] is None:
        return "\n\n".join(texts(best))
    kept = []
    for x in best[1][2]:
        if isinstance(x, list) and (x is best or x[0] == best[0] and score[id(x)] >= 0.2 * score[id(best)] or x[0] == "p" and max(map(len, texts(x)), default=0) >= 80):
            kept += texts(x)
    return "\n\n".join(kept)


def test_scores_against_plain_walks():
    draw = random.Random(8)

    def made(depth):
        out = ""
        for _ in range(draw.randint(1, 4)):
            tag = draw.choice(["div", "section", "p", "h2", "div"] if depth < 9 else ["p"])
            if tag in ("div", "section"):
                out += f"<{tag}>{made(depth + 1) if draw.random() < 0.8 else ''}</{tag}>"
            else:
                out += f"<{tag}>{', '.join('w' * draw.randint(1, 30) for _ in range(draw.randint(1, 9)))}</{tag}>"
        return out

    for _ in range(300):
        page = made(0)
        assert main_text(page) == _plainly(page)
