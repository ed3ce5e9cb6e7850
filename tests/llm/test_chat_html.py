"""Chat pairs against a plain rendering; HTML against expected text."""

import random

import pytest

from ledgerlake.llm import chat_format as cf
from ledgerlake.llm import html_render as hr
from ledgerlake.llm.html_render import extract, page_text


def plain(turns):
    return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)


def spans(turns):
    at, out = 0, []
    for r, t in turns:
        begin = at + len(f"<|im_start|>{r}\n")
        at = begin + len(t) + len("<|im_end|>\n")
        if r == "assistant":
            out.append(f"{begin}-{at}")
    return ",".join(out)


def test_pairs_equal_a_plain_rendering(spark):
    rng = random.Random(4)
    chosen, rejected, want = [], [], {}
    for p in range(60):
        opening = [(rng.choice(["user", "assistant", "system"]), rng.choice(["", "hi", "é😀x", "a\nb"])) for _ in range(rng.randint(0, 4))]
        c = opening + [("assistant", "yes"), ("user", "ok")][:rng.randint(0, 2)]
        r = opening + [("assistant", "no")] * rng.randint(0, 2)
        chosen += [(p, i, *t) for i, t in enumerate(c)]
        rejected += [(p, i, *t) for i, t in enumerate(r)]
        if c and r:
            k = 0
            while k < min(len(c), len(r)) and c[k] == r[k]:
                k += 1
            want[p] = (p, k, plain(c[:k]), plain(c[k:]), plain(r[k:]), spans(c[k:]), spans(r[k:]))
    chosen += [(None, 0, "user", "x"), (900, 0, "user", "one side")]
    rng.shuffle(chosen)
    shape = "pair_id long, turn long, role string, text string"
    got = cf.format_pairs(spark.createDataFrame(chosen, shape), spark.createDataFrame(rejected, shape)).collect()
    assert {r.pair_id: tuple(r) for r in got} == want


def test_null_roles_texts_and_extra_columns(spark):
    side = spark.createDataFrame([(1, 0, None, None, "p"), (1, 1, "assistant", "a", "p")],
                                 "pair_id long, turn long, role string, text string, prompt string")
    r = cf.format_pairs(side, side).first()
    assert (r.n_prompt, r.prompt, r.chosen, r.chosen_mask) == (2, plain([("user", ""), ("assistant", "a")]), "", "")
    assert cf.format_pairs(side.limit(0), side).count() == 0


def test_html_layout():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
    <h1>Head &amp; more</h1><p>One<p>Two <b>bold</b> text<br>next<ul><li>a<li>b<ol start=3><li>x<li>y</ol></ul><div hidden>no</div>
    <span style="display: none">no</span><!-- no --><table><tr><th>Name<th>Val<tr><td>long name<td>1</table>end<pre> a
  b</pre><dl><dt>t<dd>d</dl></body>"""
    assert page_text(page)[0] == ("Head & more\n\nOne\n\nTwo bold text\nnext\n\n- a\n- b\n  3. x\n  4. y\n\n"
                                  "Name      | Val\nlong name | 1\n\nend\n\n a\n  b\n\nt\n  d")


def test_html_odd_markup():
    assert page_text(None)[0] == page_text("")[0] == page_text("<p>")[0] == ""
    assert page_text("a < b & c")[0] == "a < b & c"
    assert page_text("</div>x</b></p>y")[0] == "x\n\ny"
    assert page_text("<script>alert(1)")[0] == ""
    assert page_text("<td>loose</td><li>item")[0] == "loose\n- item"
    assert page_text("<table><tr><td><table><tr><td>in</table><td>out</table>")[0] == "in | out"
    deep = "<div>" * 20000 + "x" + "</div>" * 20000
    assert page_text(deep)[0] == "x"


def test_html_table(spark):
    pages = spark.createDataFrame([(1, "<p>a", "t"), (1, "<p>a", "t"), (None, None, "t")], "page_id long, html string, text string")
    got = extract(pages)
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got.collect()) == [(0, "", 0), (1, "a", 1), (1, "a", 1)]
    assert extract(pages.limit(0)).count() == 0


def test_html_drawings_formulas_and_dialogs():
    assert page_text('<p>a <svg width=1 /> b</p><p>c<math/>d</p>')[0] == "a b\n\ncd"
    assert page_text('<svg><g><svg><path d=""/></svg><text>in</text></g><rect/></svg>out')[0] == "in out"
    assert page_text('<svg><title>tip</title><style/><desc>no</desc><defs><text>no</text></defs>stray<text x=1>La<tspan>bel</tspan>'
                     '<title>tip</title></text><text>two</text><text display="none">no</text></svg> end')[0] == "Label two end"
    assert page_text('<svg><foreignObject><p>one</p><p>two</p></foreignObject></svg>')[0] == "one\n\ntwo"
    assert page_text('<p>So <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><annotation>no</annotation></math>.')[0] == "So x= 1 2 ."
    assert page_text('<div><svg><path><p>seen</div>more')[0] == "seen\n\nmore"  # a drawing left open
    assert page_text('<svg><text>a<!-- </svg> -->b</text></svg>')[0] == "ab"
    assert page_text('<dialog>no</dialog><dialog open>yes</dialog>')[0] == "yes"
    assert page_text("<svg>" * 20000 + "<text>x" + "</svg>" * 20000 + "y")[0] == "x y"


@pytest.mark.parametrize("page", [
    "<a ''" * 200_000 + '"', "<p><button>" + "<i>" * 50_000 + "<div></div>" * 80_000,
    "<b><table>" + "<i>" * 130_000 + "</b>" * 130_000, "<a b=\"'" * 120_000,
    "<table>" + "<tr><td>a<td>b</tr>" * 30_000 + "<tr><td>" + "x" * 400_000 + "<td>y</tr></table>"])
def test_pages_of_a_megabyte_take_linear_time(page):
    import time
    start = time.process_time()
    text = hr.render(hr.build(page))[0]
    assert time.process_time() - start < 10 and len(text) < 2 * len(page)


def test_text_of_simple_pages_equals_the_standard_librarys_parser():
    """Inline and block markup without tables, lists and hidden parts: the
    same words in the same order."""
    import random
    from html.parser import HTMLParser

    class Words(HTMLParser):
        def __init__(self):
            super().__init__()
            self.text = []

        def handle_data(self, data):
            self.text.append(data)

        def handle_starttag(self, tag, attrs):
            self.text.append(" " if tag in ("p", "div", "br", "h1") else "")

        handle_endtag = lambda self, tag: self.text.append(" " if tag in ("p", "div", "h1") else "")
    rng = random.Random(12)
    words = ["one", " two ", "&amp;", "&eacute;", "caf\u00e9", "<!-- not this -->", "\n", "<br>"]

    def inline(depth):
        parts = [rng.choice(words) for _ in range(rng.randint(0, 4))]
        if depth:
            parts += [rng.choice(["<b>{}</b>", "<i title='x > y'>{}</i>"]).format(inline(depth - 1)) for _ in range(rng.randint(0, 2))]
        rng.shuffle(parts)
        return "".join(parts)
    for _ in range(300):
        page = "".join(rng.choice(["<p>{}</p>", "<div class=\"a > b\">{}</div>", "<h1>{}</h1>", "{}"]).format(inline(3))
                       for _ in range(rng.randint(1, 8)))
        plain = Words()
        plain.feed(page)
        plain.close()
        assert hr.render(hr.build(page))[0].split() == "".join(plain.text).split(), page
