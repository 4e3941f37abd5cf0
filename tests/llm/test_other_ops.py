"""Classifier, chat formatting, HTML extraction."""

import json
import random
import zlib

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorgrid.llm import chat, classifier, htmltext

# ---- classifier


def test_boosting_learns_and_flattens():
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    m = classifier.Boosted.fit(x[:2000], y[:2000])
    assert ((m.predict(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.95

    def walk(row):
        total = m.base
        for root in m.roots:
            i = root
            while m.left[i] != i:
                i = m.left[i] if row[m.feature[i]] <= m.upper[i] else m.right[i]
            total += m.value[i]
        return 1 / (1 + np.exp(-total))
    assert np.allclose(m.predict(x[:50]), [walk(row) for row in x[:50]])


def test_boosting_without_both_labels():
    x = np.zeros((5, 2))
    assert classifier.Boosted.fit(x[:0], np.zeros(0)).predict(x).tolist() == [0.5] * 5
    assert (classifier.Boosted.fit(x, np.ones(5)).predict(x) > 0.99).all()


def test_classifier_held_out_accuracy(spark):
    import os
    sf = "/root/testdata/sf0.01"
    if not os.path.exists(sf):
        pytest.skip("test data not present")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = classifier.fit(docs, labels)
    out = classifier.score(docs, model).join(labels, "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)


def test_classifier_never_learns_from_held_out_rows(spark, small):
    docs, labels = small("documents"), small("labels")
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 3 = 1 then 1 - quality else quality end as quality")
    a, b = (classifier.fit(docs, x) for x in (labels, flipped))
    assert a.value.tolist() == b.value.tolist() and a.upper.tolist() == b.upper.tolist()


def test_classifier_edge(spark, edge, edge_rows, nothing):
    labels = spark.createDataFrame([(None, 1), (2, None), (4, 1), (6, 0), (6, 1), (43, 0)], "doc_id long, quality int")
    out = classifier.score(edge, classifier.fit(edge, labels))
    assert out.count() == len(edge_rows) and out.filter("score is null or held_out is null").count() == 0
    assert classifier.score(nothing, classifier.fit(nothing, labels)).count() == 0
    assert classifier.score(edge, classifier.fit(edge, labels.limit(0))).filter("score != 0.5").count() == 0


def test_statistics_have_one_length(edge_rows):
    assert {len(classifier.statistics((t or "").encode())) for _, t in edge_rows} == {len(classifier.STATISTICS)}


# ---- chat formatting

PIECES = [*chat.CONTROLS, "\\", "[", "<", "/", "]", ">", "|", "a", "\n", " ", "INST]", "s>", "<|image:0|>", "é", ""]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12), st.sampled_from(["user", "assistant", "system", "tool", "", "x]y [/ROLE]", "[ROLE:a] ", "assistant]"]))
def test_segments_are_reversible(parts, role):
    text = "".join(parts)
    body = chat.escape(text)
    assert not any(c in body for c in chat.CONTROLS)
    seg, a, z = chat.segment(role, body)
    got, back = chat.parse(seg)
    assert (got, chat.unescape(back)) == (role, text)
    assert (chat.unescape(seg[a:z]) == text) if role == "assistant" else a == z


def test_parts_are_flattened_in_order():
    parts = [{"type": "text", "text": "see <|im"}, {"type": "text", "text": "age:0|>"}, {"type": "image", "ref": "a.png", "width": 28, "height": 15}, "then",
             {"type": "document", "ref": "d.pdf", "pages": 2, "parts": [{"type": "audio", "ref": "s.ogg", "seconds": 1.5}, {"type": "text", "text": "end"}]}, None]
    body, attached = chat.flatten(None, json.dumps(parts))
    assert body == "see <\\|image:0|><|image:0|>then<|document:1|><|audio:2|>end"
    assert attached == [(0, "image", "a.png", 4), (1, "document", "d.pdf", 1200), (2, "audio", "s.ogg", 38)]
    with pytest.raises(ValueError):
        chat.flatten(None, '[{"type": "video"}]')


def test_chat_round_trip(spark, small):
    rows = [(1, 1, "assistant", "</s>"), (1, 0, "user", "hi\\"), (1, 0, "user", "hi\\"), (2, None, None, None), (None, 3, "tool", "x"), (None, 3, "assistant", "y"), (3, 0, "system", "")]
    for data in (rows, [tuple(r) for r in small("conversations").select("conv_id", "turn", "role", "text").collect()]):
        df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").withColumn("segment", chat.F.lit("clash")).repartition(4)
        got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.format_conversations(df).collect()}
        assert got == brute.op6(data)
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_chat_attachments(spark):
    content = json.dumps([{"type": "text", "text": "look"}, {"type": "image", "ref": "a", "width": 14, "height": 14}])
    df = spark.createDataFrame([(1, 0, "user", None, content)], "conv_id long, turn long, role string, text string, content string")
    r = chat.format_turns(df).first()
    assert r.segment == "[INST] look<|image:0|> [/INST]" and r.attachments[0].ref == "a" and r.expanded_tokens == 1


# ---- HTML extraction


def text_of(source, low=()):
    p = htmltext.parse_page(source)
    return htmltext.main_text(p.path, p.parent, p.kinds(), [i for i, _ in p.blocks], [t for _, t in p.blocks], low)


@pytest.mark.parametrize("source, want", [
    ("", ""), ("plain  text", "plain text"), ("a < b &lt;c&gt; &eacute;&#233;&nbsp;x &am &copy", "a < b <c> éé x &am ©"),
    ("<p>a<p>b<br>c<b>d</b>e", "a b cde"), ("<ul><li>1<li>2<ul><li>3</ul><li>4</ul>", "1 2 3 4"), ("<table><tr><td>a<td>b<tr><td>c</table>d", "a b c d"),
    ("<article><h1>T</h1><p>x</p><form>q</form><section id=comments><p>no</section><div class='share-buttons'>no</div></article><p>out", "T x"),
    ("<nav>n</nav><header>h</header><p>x</p><aside>no</aside><div role=complementary>no</div><footer>f", "x"),
    ("<script>var t='</p>';</script><style>p{}</style><!-- <p>no --><p>x<script>if(a<b){}</script>y", "x y"),
    ("<article><header><h1>t</h1></header><p>x</article><article class='comment'><p>no</article>", "t x"),
    ("<div class='page with-sidebar'><div class='post'><p>x</div><div class='sidebar'>no</div></div>", "x"),
    ("<p unclosed attr='x>text", "text"), ("<p>x</p></div></b></p>y<", "x y<"), ("<div hidden>no</div><p style='display: none'>no</p><p>x", "x"),
    ("<title>no</title><p>x<textarea><p>no</textarea>", "x"), ("<pre>a\n  b</pre>", "a b"), ("<article><p>x <span class='ad'>buy</span> y</p></article>", "x y"),
])
def test_pages(source, want):
    assert text_of(source) == want


LONG = "words of the article go on and on"


@pytest.mark.parametrize("source, want", [
    (f"<html class='cookie-accepted'><body class='content-sidebar'><div class='menu'>m</div><p>{LONG}", LONG),
    (f"<body class='sidebar-right'><article>{LONG}</article><div id=comments class='comments-area'><article class='comment-body'>no</article></div>", LONG),
    (f"<article class='post comments-open'>{LONG}</article><article class='comment'>no</article>", LONG),
    (f"<div class='content-sidebar'><main><h1>T</h1><p>{LONG}</main><div class='sidebar'>no</div></div>", f"T {LONG}"),
    (f"<div class='content-sidebar'><div class='post'><p>{LONG}</div><div class='sidebar'>no</div></div><p>x", f"{LONG} x"),
    ("".join(f"<div class='elementor-widget elementor-widget-text'><p>{LONG} {i}</p></div>" for i in range(4)) + "<p>x</p><div class='cookie-notice'>no</div>",
     " ".join(f"{LONG} {i}" for i in range(4)) + " x"),
    (f"<main><h1>T</h1><div class='elementor-widget'><article>{LONG}</article></div></main>", f"T {LONG}"),
    (f"<article><div class='widget'><p>{LONG}</div><div class='widget'><p>{LONG}</div><div class='widget-area'>no</div></article>", f"{LONG} {LONG}"),
    (f"<article class='comment'>{LONG}</article>", LONG), (f"<div class='comments'><p>{LONG}</div>", LONG),
    (f"<p>x</p><div class='menu-wrap'><a href=1>{LONG}</a></div><div class='comments'>{LONG}</div>", "x"),
])
def test_names_of_layout_do_not_empty_a_page(source, want):
    assert text_of(source) == want


def test_deep_markup_is_text_of_its_ancestor():
    assert text_of("<div>" * 3000 + "x" + "</div>" * 3000 + "<p>y") == "x y"


def test_deep_parts_are_marked():
    deep = "<div>" * 40
    assert text_of(deep + "<div>out</div><article><header><h1>T</h1></header><p>x</p></article>") == "T x"


def test_deep_branches_have_importance(spark):
    """As test_style_tree_removes_what_pages_share, below a chain of elements."""
    rows = [(i, u, h.replace("<body>", "<body>" + "<section>" * 40)) for i, u, h in host_pages(30)]
    got = {r.page_id: r.text for r in htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: text_of(h.replace("<b>Site</b>", "").replace("All rights", "")) for i, _, h in rows}


def test_branch_importance_is_that_of_the_levels(spark, monkeypatch):
    df = spark.createDataFrame(host_pages(12) + host_pages(7, "g"), "page_id long, url string, html string")
    low = lambda: sorted(map(tuple, htmltext.low_nodes(htmltext.parse_pages(df)).collect()))
    want = low()
    monkeypatch.setattr(htmltext, "DEPTH", 1)

    def shallow(parsed):  # the workers have the module's own DEPTH, so branches are dealt here
        up = htmltext.F.expr("transform(__llm_path, (x, i) -> if(__llm_depth[i] < 2, 0, __llm_path[1]))")
        return parsed.withColumn("__llm_branch", up)
    got = sorted(map(tuple, htmltext.low_nodes(shallow(htmltext.parse_pages(df))).collect()))
    assert got == want and want


def host_pages(n, host="h"):
    r = random.Random(3)
    pages = []
    for i in range(n):
        body = "".join(f"<p>{' '.join(str(r.random()) for _ in range(5))}</p>" + ("<ul><li>x</ul>" if r.random() < .5 else "") for _ in range(r.randrange(2, 9)))
        pages.append((i, f"http://{host}/{i}", f"<body><div class=top1><b>Site</b></div><div class=text>{body}</div><div class=bottom><p>All rights</p></div></body>"))
    return pages


def test_style_tree_removes_what_pages_share(spark):
    """Nothing in the names tells the branches apart: only the host's statistics do."""
    rows = host_pages(40) + [(100, "http://alone/x", "<div class=top1>Alone</div><p>text</p>"), (101, None, None), (101, None, None), (None, "http://[", "<p>odd")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", htmltext.F.lit("clash"))
    out = {r.page_id: r.text for r in htmltext.extract(df).collect()}
    for i, _, source in host_pages(40):
        assert "Site" not in out[i] and "rights" not in out[i]
        assert out[i] == text_of(source.replace("<b>Site</b>", "").replace("All rights", ""))
    assert out[100] == "Alone text" and out[101] == "" and out[None] == "odd"
    assert htmltext.extract(df.limit(0)).count() == 0


def test_hosts_of_few_pages_have_a_style_tree(spark):
    rows = [r for n in (1, 2, 3, 4) for r in [(10 * n + i, u, h) for i, u, h in host_pages(n, f"h{n}")]]
    got = {r.page_id: r.text for r in htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got.pop(10) == text_of(rows[0][2])
    assert got == {i: text_of(h.replace("<b>Site</b>", "").replace("All rights", "")) for i, _, h in rows[1:]}


def test_copies_of_one_article_stay(spark):
    """A host that repeats one article keeps it, marked or not."""
    marked = [(i, f"http://a/{i}", "<nav>n</nav><article><h1>T</h1><p>same</p></article>") for i in range(20)]
    plain = [(50 + i, f"http://b/{i}", "<div><p>same</p></div>") for i in range(20)]
    got = {r.text for r in htmltext.extract(spark.createDataFrame(marked + plain, "page_id long, url string, html string")).collect()}
    assert got == {"T same", "same"}


def test_importance_is_the_entropy_of_presentations(spark):
    rows = [(i, f"http://h/{i}", "<div class=a><p>x</p>" + ("<ul><li>y</ul>" if i % 2 else "") + "</div>") for i in range(8)]
    parsed = htmltext.parse_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))
    tree = htmltext.style_tree(parsed).collect()
    div = next(r for r in tree if r.styles == 2)
    assert div.pages == 8 and abs(div.presentation - np.log(2) / np.log(8)) < 1e-12
    assert all(abs(r.content) < 1e-12 for r in tree if r.content is not None and r.pages == 8)


def linked_pages(n, host):
    """Lists of links whose labels differ from page to page, in elements whose names say nothing."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(9))
    return [(i, f"http://{host}/{i}", "<div class=x><ul>" + "".join(f"<li><a href={word()}>{word()}</a></li>" for _ in range(6)) + "</ul></div>"
             f"<div class=y><p>text {word()} with <a href=q>a {word()}</a> and words</p>" + f"<p>{word()}</p>" * r.randrange(4) + "</div>") for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 9])
def test_lists_of_links_are_low_whatever_their_labels(spark, n):
    """Fails without the tree: no name, tag or repeated text tells the list."""
    rows = linked_pages(n, f"links{n}")
    got = {r.page_id: r.text for r in htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: text_of("<div class=y>" + h.split("<div class=y>")[1]) for i, _, h in rows}
    assert all(len(text_of(h).split()) == len(got[i].split()) + 6 for i, _, h in rows)


def test_low_nodes_are_those_of_the_whole_tree_in_memory(spark):
    import brute
    hosts = {"h": host_pages(15), "one": host_pages(1, "one"), "links": linked_pages(6, "links"),
             "mixed": [(i, f"http://mixed/{i}", h) for i, (_, _, h) in enumerate(linked_pages(4, "x") + host_pages(5))],
             "empty": [(0, "http://empty/", "<div><p></p><nav></nav></div>"), (1, "http://empty/1", "")]}
    rows = [(i, u.replace(u.split("/")[2], host), h) for host, pages in hosts.items() for i, u, h in pages]
    parsed = htmltext.parse_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = {}
    for r in htmltext.low_nodes(parsed).collect():
        got.setdefault(r.host, set()).add(r.node)
    for host, pages in hosts.items():
        trees = []
        for _, _, source in pages:
            p = htmltext.parse_page(source)
            size = [[] for _ in p.path]
            for i, t in p.blocks:
                size[i].append((t, 0, 0))
            for i, blocks in enumerate(size):  # the characters of a node go with its first block
                if blocks:
                    blocks[0] = (blocks[0][0], p.linked[i], p.prose[i] + p.linked[i])
            trees.append([(p.path[i], tuple(p.path[c] for c in p.children[i]), size[i]) for i in range(len(p.path))])
        assert got.get(host, set()) == brute.low_paths(trees, htmltext.THRESHOLD, htmltext.DECAY), host


def test_a_very_long_page_is_read_whole(spark):
    long = " ".join(f"word{i}" for i in range(300_000))
    rows = [(i, f"http://long/{i}", f"<div class=top>Same</div><article><h1>T</h1><p>{i} {long}</p></article>") for i in range(3)]
    got = htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: f"T {i} {long}" for i in range(3)} and all(r.n_chars == len(r.text) for r in got)


def test_pages_table(small):
    import html
    import re
    pages = small("pages").collect()
    want = {}
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        want[p.page_id] = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(p|br|h1)>", " ", article))).split())
    out = htmltext.extract(small("pages")).collect()
    assert {r.page_id: r.text for r in out} == want and all(r.n_chars == len(r.text) for r in out)
