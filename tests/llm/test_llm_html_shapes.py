"""Page shapes whose article must come out whole, and an extractor of another kind on generated pages."""

from __future__ import annotations

import random
import xml.etree.ElementTree as ET

import pytest

from loamworks.llm import html

LONG = [f"Sentence number {i} of the long article, with words enough to make a dense line of text." for i in range(6)]
SHORT = ["It rained.", "We stayed in.", "Nobody came by."]
P = lambda lines: "".join(f"<p>{x}</p>" for x in lines)
LINKS = "<ul>" + "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(8)) + "</ul>"


@pytest.mark.parametrize(
    ("page", "lines"),
    [
        (f"<article>{P(LONG)}</article><article>{P(SHORT)}</article>", LONG + SHORT),
        (f"<article>{P(SHORT)}</article><article>{P(LONG)}</article>", SHORT + LONG),
        (f"<main><p>{SHORT[0]}</p><article>{P(LONG)}</article><p>{SHORT[1]}</p></main>", [SHORT[0], *LONG, SHORT[1]]),
        (f"<main><h1>A title</h1><article>{P(LONG)}</article></main>", ["A title", *LONG]),
        (f"<body><nav>{LINKS}</nav><section>{P(LONG)}</section><section>{P(SHORT)}</section></body>", LONG + SHORT),
        (f"<body>{LINKS}<div>{P(SHORT)}</div><div>{P(LONG)}</div><div>{P(SHORT)}</div></body>", SHORT + LONG + SHORT),
        (f"<body><div><section>{P(LONG)}</section><section>{P(SHORT)}</section></div><div>{LINKS}</div></body>", LONG + SHORT),
        (f"<article>{P(LONG[:3])}<section id=related>{P(LONG[3:])}</section></article>", LONG),
        (f"<article>{P(LONG[:3])}<section id=copyright>{P(LONG[3:])}</section></article>", LONG),
        (f"<article>{P(LONG[:3])}<div id=cookies>{P(LONG[3:])}</div></article>", LONG),
        (f"<article>{P(LONG[:3])}<div class=social-history>{P(LONG[3:])}</div></article>", LONG),
        (f"<article>{P(LONG[:3])}<h2 id=copyright>Copyright</h2>{P(LONG[3:])}</article>", [*LONG[:3], "Copyright", *LONG[3:]]),
        (f"<article>{P(LONG[:3])}<section id=related><h2>Related</h2>{LINKS}</section>{P(LONG[3:])}</article>", LONG),
        (f"<article>{P(LONG[:3])}<div id=comments>{P(LONG)}</div>{P(LONG[3:])}</article>", LONG),
        (f"<article>{P(LONG[:3])}<div class='cookie-notice'>{P(LONG)}</div>{P(LONG[3:])}</article>", LONG),
        (f"<article>{P(LONG[:3])}<div id=related><div class=ad>{P(LONG)}</div>{P(LONG[3:])}</div></article>", LONG),
        (f"<body><div id=content>{P(LONG)}</div><div class=responses>{P(LONG[::-1])}</div></body>", LONG),
        (f"<body><div id=content>{P(LONG)}</div><ol class=commentlist><li>{LONG[0]}<li>{LONG[1]}</ol></body>", LONG),
        (f"<article>{P(LONG)}</article><article><a href=/x>Another story that is to be read elsewhere</a></article>", LONG),
        (f"<article><ul>{''.join(f'<li>{x}</li>' for x in SHORT)}</ul>{P(LONG)}<blockquote>Ha!</blockquote></article>", [*SHORT, *LONG, "Ha!"]),
    ],
)
def test_the_article_comes_out_whole(page, lines):
    assert html.main_text(page).split("\n") == lines


def by_tree(page):
    """Another way to the same text for well-formed pages: a tree, from which named blocks are cut, then its article's blocks."""
    blocks = {"p", "h1", "h2", "li", "blockquote", "ul", "section", "div", "article", "main", "nav", "aside", "footer", "header", "body", "form"}
    out, parts = [], []

    def end():
        if text := " ".join("".join(parts).split()):
            out.append(text)
        parts.clear()

    def walk(node, inside):
        if node.tag in ("nav", "aside", "footer", "form", "script", "style") or node.tag == "header" and not inside or node.get("data-junk"):
            end() if node.tag in blocks else None
            if inside and node.tail:
                parts.append(node.tail)
            return
        within = inside or node.tag in ("article", "main")
        if node.tag in blocks:
            end()
        if within and node.text:
            parts.append(node.text)
        for child in node:
            walk(child, within)
        if node.tag in blocks:
            end()
        if inside and node.tail:
            parts.append(node.tail)

    walk(ET.fromstring(page), False)
    return "\n".join(out)


def generated(rng):
    words = lambda a, b: " ".join(rng.choices("stone river winter walks über mañana long windows speak slowly under lights".split(), k=rng.randint(a, b)))
    line = lambda: words(1, 4) if rng.random() < 0.3 else words(10, 70)
    block = lambda: rng.choice(["<p>{}</p>", "<div>{}</div>", "<p>a <b>{}</b> c</p>", "<ul><li>{}</li><li>x</li></ul>", "<blockquote><p>{}</p></blockquote>", "<section id='related'><p>{}</p></section>"])

    def one():
        shape = block()
        return shape.format(words(20, 60) if "section" in shape else line())

    junk = lambda: rng.choice(["<nav><ul><li><a href='/'>{}</a></li></ul></nav>", "<aside><p>{}</p></aside>", "<form><p>{}</p></form>", "<div class='ad' data-junk='1'><p>{}</p></div>", "<div id='comments' data-junk='1'><p>{}</p></div>", "<script>{}</script>"]).format(words(2, 40))
    article = lambda n: "<article>" + "".join(junk() if rng.random() < 0.2 else one() for _ in range(n)) + f"<p>{words(40, 70)}</p></article>"
    inner = article(rng.randint(2, 9))
    if rng.random() < 0.5:
        inner += f"<article><p>{line()}</p><p>{words(2, 5)}</p></article>"
    if rng.random() < 0.5:
        inner = f"<main><h1>{words(2, 6)}</h1>{inner}<p>{line()}</p></main>"
    return f"<html><body><header><a href='/'>Home</a></header>{junk()}{inner}{junk()}<footer>{words(3, 30)}</footer></body></html>"


def test_an_extractor_by_tree_agrees():
    rng = random.Random(11)
    for _ in range(300):
        page = generated(rng)
        assert html.main_text(page) == by_tree(page), page
