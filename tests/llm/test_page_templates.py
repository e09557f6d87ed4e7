"""The deduced classes decide the text: boilerplate inside articles, small hosts, copies, link lists."""

import random

import pytest

from capstan.llm import templates

WORDS = [f"word{i}" for i in range(400)]


def say(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


def page(rng, paragraphs, article=True, tools=True, note=None, links=()):
    """A host's page: the boilerplate has no telling tag or class name."""
    body = "".join(f"<p>{t}</p>" for t in paragraphs)
    top = '<div class="x1">Print this page</div>' if tools else ""
    end = f'<div class="x2">{note}</div>' if note else ""
    menu = "<ul class='k'>" + "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in links) + "</ul>" if links else ""
    inner = f"{top}<h1>{say(rng, 3)}</h1>{body}{end}<span class='z'>Copyright of this host</span>"
    return f"<html><body>{menu}" + (f"<article>{inner}</article>" if article else f"<div id='c'>{inner}</div>") + "</body></html>"


def texts(html, template):
    return templates.extract(templates.parse(html), template).split("\n\n")


@pytest.mark.parametrize("pages", [2, 3, 5, 7, 30])
@pytest.mark.parametrize("article", [True, False])
def test_boilerplate_inside_the_article_goes(pages, article):
    rng = random.Random(pages)
    bodies = [[say(rng, 40) for _ in range(rng.randrange(2, 6))] for _ in range(pages)]
    rows = [page(rng, b, article) for b in bodies]
    template = templates.deduce([templates.parse(h) for h in rows])
    for h, body in zip(rows, bodies, strict=True):
        got = texts(h, template)
        assert got[1:] == body and len(got) == len(body) + 1              # heading and paragraphs
        without = texts(h, None)
        assert "Print this page" in without and "Copyright of this host" in without       # only the template tells


def test_optional_element_on_most_pages_goes():
    rng = random.Random(1)
    bodies = [[say(rng, 30) for _ in range(3)] for _ in range(9)]
    rows = [page(rng, b, note="Rate this article" if i % 3 else None) for i, b in enumerate(bodies)]
    template = templates.deduce([templates.parse(h) for h in rows])
    assert all(texts(h, template)[1:] == b for h, b in zip(rows, bodies, strict=True))


def test_passages_that_some_pages_share_stay():
    """A paragraph on half of the pages, or at a different place on each, is content."""
    rng = random.Random(2)
    shared = say(rng, 12)
    bodies = [[say(rng, 40), *([shared] if i % 2 else []), say(rng, 40)] for i in range(10)]
    rows = [page(rng, b) for b in bodies]
    template = templates.deduce([templates.parse(h) for h in rows])
    assert all(texts(h, template)[1:] == b for h, b in zip(rows, bodies, strict=True))


def test_copies_stay_whole():
    """Pages with one article and different menus, and near copies, are no template of one another."""
    rng = random.Random(3)
    body = [say(rng, 40) for _ in range(5)]
    same = [f"<html><body><nav>{say(rng, 4)}</nav><article>" + "".join(f"<p>{t}</p>" for t in body) + "</article></body></html>" for _ in range(6)]
    template = templates.deduce([templates.parse(h) for h in same])
    assert all(texts(h, template) == body for h in same)
    near = [f"<html><body><article>" + "".join(f"<p>{t}</p>" for t in [*body, say(rng, 10)]) + "</article></body></html>" for _ in range(6)]
    template = templates.deduce([templates.parse(h) for h in near])
    assert all(texts(h, template)[:5] == body and len(texts(h, template)) == 6 for h in near)


def test_repeating_slots_of_links_are_no_content():
    """A list of links without any telling name, different on every page, longer than the text."""
    rng = random.Random(4)
    bodies = [[say(rng, 14) for _ in range(3)] for _ in range(8)]
    rows = [page(rng, b, article=False, links=[say(rng, 6) for _ in range(12 + i)]) for i, b in enumerate(bodies)]
    template = templates.deduce([templates.parse(h) for h in rows])
    assert template.nested and template.lists
    for h, b in zip(rows, bodies, strict=True):
        assert texts(h, template)[1:] == b
        assert len(texts(h, None)) > 12


def test_query_uses_the_template(spark):
    """Through the operator, with hosts of two to seven pages and one page alone."""
    rng = random.Random(5)
    rows, want, k = [], {}, 0
    for host in range(1, 8):
        for _ in range(host):
            body = [say(rng, 30) for _ in range(3)]
            rows.append((k, f"http://h{host}.example/{k}", page(rng, body)))
            want[k] = body
            k += 1
    rows += [rows[-1]] * 3                                                 # repeated rows count once
    got = templates.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows)
    for r in got:
        parts = r.text.split("\n\n")
        assert (parts[1:] == want[r.page_id]) if r.page_id else parts[2:-1] == want[0]
