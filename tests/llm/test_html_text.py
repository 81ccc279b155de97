import html
import random
import time

import pytest

from spanmask.llm import html_text as H
from spanmask.llm.html_text import extract, main_text

from .conftest import prose, vocabulary

ARTICLE = "The first words of it are here, and the rest of the text is long enough to be read with care by you."


def wrap(body, before="", after=""):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p><p>';</script></head><body>{before}{body}{after}</body></html>"


@pytest.mark.parametrize("before,after", [
    ("<nav><ul><li><a href='/a'>Home</a></li><li>Plain</li></ul></nav>", "<footer>&copy; all of the rights are in this and that for the rest of time itself.</footer>"),
    ("<header><h1>Site of the day</h1></header><div class='side-bar'>The best of the rest is in the list that you have to read on.</div>", "<aside>More of it</aside>"),
    ("<div id='cookieNotice'>We use the cookies for this and that and you have to say yes to all of them now.</div>", "<form><p>Name of the user that is to be sent with the rest of it, and so on.</p><input></form>"),
    ("<div class=\"ad\">Buy the best of all in the shop and it is for you, as it was for them.</div>", "<section class='comments'><p>I am of the view that this is the best of all that you have had.</p></section>"),
    ("<!-- <p>not the text</p> -->", "<div role=dialog>Sign in to the site and have all of it for free with no ad at all.</div>"),
])
def test_boilerplate_goes(before, after):
    for body in (f"<article><h1>Title.</h1><p>{ARTICLE}</p><p>Von.</p></article>", f"<main><h1>Title.</h1><p>{ARTICLE}<p>Von.</main>"):
        assert main_text(wrap(body, before, after)) == f"Title. {ARTICLE} Von."
    plain = f"<div><h1>Title.</h1><p>{ARTICLE}</p><p>Von.</p><p>{ARTICLE}</p></div>"
    assert main_text(wrap(plain, before, after)) == f"Title. {ARTICLE} Von. {ARTICLE}"


def test_references_white_space_and_broken_markup():
    assert main_text(wrap("<article><p>a &amp; b&nbsp;c\n\t d &lt;p&gt; &#233;&#x41; 1 < 2<p><b>x<br>y<p>z</article>")) == "a & b c d <p> éA 1 < 2 x y z"
    assert main_text(wrap("<article><p>one<div class=comments>two</div><p>three <span class='ad'>buy</span> four</article>")) == "one three four"
    assert main_text("just text") == "just text" and main_text("") == "" and main_text(None) == ""
    assert main_text("<p>open <b>never closed <script>x") == "open never closed"


def test_all_of_a_marked_article_stays():
    rng, vocab = random.Random(4), vocabulary(200)
    for _ in range(50):
        paragraphs = [" ".join(prose(rng, rng.randint(1, 60), vocab).split()) for _ in range(rng.randint(1, 9))]
        page = wrap("<article>" + "".join(f"<p>{html.escape(p)}</p>" for p in paragraphs) + "</article>", "<nav><a href='/'>x</a></nav>", "<footer>y</footer>")
        assert main_text(page) == " ".join(paragraphs)


def test_long_pages_and_rows(spark):
    big = "<div>" * 3000 + f"<p>{ARTICLE}</p>" * 2000
    rows = [(1, "u", wrap(f"<article><p>{ARTICLE}</article>")), (None, None, None), (3, "u", ""), (3, "u", big), (4, "v", "<" * 50_000), (5, "w", "<a \"" * 20_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = extract(df.selectExpr("*", "1 as text")).collect()
    assert len(got) == 6 and all(r.n_chars == len(r.text) for r in got)
    assert {(r.page_id, r.text) for r in got} >= {(1, ARTICLE), (None, ""), (3, ""), (3, " ".join([ARTICLE] * 2000))}
    assert extract(df.limit(0)).collect() == []


@pytest.mark.parametrize("wrapper", [
    "<article class='post comments-open'>", "<div class='content with-sidebar'>", "<main class='no-header'>",
    "<div class='page page-header-fixed'>", "<div class='social-science'>", "<div id='notice-of-meeting'>", "<form><div>",
])
def test_class_words_are_evidence(wrapper):
    close = "</div></form>" if wrapper == "<form><div>" else f"</{wrapper[1:].split()[0]}>"
    inner = f"<article><p>{ARTICLE}</p></article>" if "form" in wrapper else f"<h1>Title.</h1><p>{ARTICLE}</p>"
    page = wrap(wrapper + inner + close, "<nav><a href=/>x</a></nav>", "<footer>&copy; us</footer>")
    assert main_text(page).endswith(ARTICLE)
    # beside a longer article such a container stays out
    beside = wrap(f"<div><p>{ARTICLE}</p><p>{ARTICLE}</p></div>", f"<div class='share-this-now'><p>{ARTICLE}</p></div>")
    assert main_text(beside) == f"{ARTICLE} {ARTICLE}"


@pytest.mark.parametrize("run", [
    "<x", "<a ", "</b>", "<!", "<script", "<script></script ", "<a \"", "<a '\">", "<a \"><a '>", "<div>", "<article>", "<li>", "&#9", "<!--",
    "</div><div class='ad'>", "<span class=ad-x>", "<div class='no-header'>", "<a x= ", "<p><a href=\"",
])
def test_malformed_megabytes(run):
    for page in (run * ((1 << 20) // len(run)), run * ((1 << 20) // len(run)) + ">"):
        began = time.process_time()
        main_text(page)
        assert time.process_time() - began < 5


def test_references_of_any_length():
    assert main_text("&#" + "9" * 10_000 + "; x &#" + "0" * 10_000 + "65; &#x41;") == "\ufffd x A A"


# --- brute force: blocks from a tree that is known, every rule by its definition ---------------

CLASSES = {"": 0, "content": 0, "sidebar": 2, "comment-list": 2, "cookieNotice": 2, "with-sidebar": 1, "comments-open": 1, "notice-of-day": 1}
TEXTS = [ARTICLE, ARTICLE[:60], "Short one.", "Zorb glax trem plonk vax quil morn drex splat krum hond werf lopt", "a &amp; b", "  \n "]


def random_tree(rng, depth=0):
    """(tag, class, children); a child is a tree or a text."""
    tag = rng.choice(["div", "div", "section", "p", "p", "ul", "nav", "article", "main", "header", "aside"] if depth < 4 else ["p"])
    if tag == "p":
        inner = [rng.choice([rng.choice(TEXTS), ("a", "", [rng.choice(TEXTS)]), ("b", "", [rng.choice(TEXTS)]), ("span", rng.choice(list(CLASSES)), [rng.choice(TEXTS)])]) for _ in range(rng.randint(0, 3))]
        return tag, rng.choice(["", "", *CLASSES]), inner
    if tag == "ul":
        return tag, "", [("li", "", [rng.choice([("a", "", ["go there"]), rng.choice(TEXTS)])]) for _ in range(rng.randint(1, 3))]
    inner = [random_tree(rng, depth + 1) if rng.random() < 0.85 else rng.choice(TEXTS) for _ in range(rng.randint(0, 4))]
    return tag, rng.choice(["", "", "", *CLASSES]), inner


def markup(node):
    if isinstance(node, str):
        return node
    tag, name, inner = node
    return f"<{tag}{' class=' + chr(34) + name + chr(34) if name else ''}>" + "".join(map(markup, inner)) + f"</{tag}>"


def tree_blocks(trees):
    """[words, text, link characters, bad, inside, container, item, doubtful containers] of each block."""
    out, pieces, count = [], [], [0]

    def flush(path):
        text = " ".join(html.unescape("".join(x for x, _ in pieces)).split())
        if text:
            top = path[-1] if path else ("", False, False, 0, (), False)
            links = sum(len(" ".join(html.unescape(x).split())) for x, linked in pieces if linked)
            out.append([text.split(), text, links, top[1], top[2], top[3], any(p[0] == "li" for p in path[-2:]), top[4]])
        pieces.clear()

    def visit(node, path, linked):
        if isinstance(node, str):
            pieces.append((node, linked))
            return
        tag, name, inner = node
        top = path[-1] if path else ("", False, False, 0, (), False)
        level = 3 if tag in ("nav", "header", "aside") else CLASSES[name]
        if tag in ("article", "main") and level == 1 or tag == "header" and top[2]:
            level = 0
        block = tag in H.BLOCK_TAGS
        if block:
            flush(path)
        bad, inside, number, weak = top[1], top[2], top[3], top[4]
        if tag in ("article", "main") and level < 2 and not any(p[5] for p in path):
            bad, inside = False, True
        if block and tag not in ("p", "li"):
            count[0] += 1
            number = count[0]
        pushed = block or level or tag == "span" and any(p[0] == "span" for p in path)
        if level and not block:
            flush(path)
        below = [*path, (tag, bad or level >= 2, inside, number, (*weak, object()) if level == 1 else weak, level >= 2)] if pushed else path
        for child in inner:
            visit(child, below, linked or tag == "a")
        if pushed:
            flush(below)

    for t in trees:
        visit(t, [], False)
    flush([])
    return out


def brute_text(trees):
    found = tree_blocks(trees)
    dense = lambda b: len(b[0]) >= 12 and sum(w.strip(".,;:!?\"'()").lower() in H.STOP_WORDS for w in b[0]) >= 0.22 * len(b[0])
    heavy = [b for b in found if not b[3] and b[2] <= 0.5 * len(b[1]) and dense(b)]
    for b in found:
        b[3] = b[3] or any(2 * sum(len(x[0]) for x in heavy if w in x[7]) <= sum(len(x[0]) for x in heavy) for w in b[7])
    marked = any(b[4] and not b[3] for b in found)
    label = []
    for b in found:
        share = b[2] / len(b[1])
        no = b[3] or marked and not b[4] or share > 0.5 and (not marked or b[6] and share > 0.9)
        label.append(False if no else True if dense(b) else None)
    if True not in label:
        return " ".join(b[1] for b, x in zip(found, label) if x is None)
    out = []
    for i, b in enumerate(found):
        if label[i] is None:
            near = [max((j for j in range(i) if label[j] is not None), default=None), min((j for j in range(i, len(found)) if label[j] is not None), default=None)]
            near = [j for j in near if j is not None]
            j = min(near, key=lambda j: (marked and not found[j][4], found[j][5] != b[5], abs(j - i), not label[j]))
            if label[j] or marked and b[4] and not b[6]:
                out.append(b[1])
        elif label[i]:
            out.append(b[1])
    return " ".join(out)


def test_against_brute_force_on_random_markup():
    rng, several = random.Random(12), 0
    for _ in range(1500):
        trees = [random_tree(rng) for _ in range(rng.randint(1, 4))]
        page = "".join(map(markup, trees))
        want = brute_text(trees)
        assert main_text(page) == want, page
        several += len(want) > 200
    assert several > 50
