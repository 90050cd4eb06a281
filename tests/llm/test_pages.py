import html
import math
import random
import re
import time
from collections import Counter

import brute

from tallyhouse.llm.html_template import LEAST_PAGES, _token, deduced_templates, extract_main_text, parse, tags
from tallyhouse.llm.queries import QUERIES
from tallyhouse.llm.url_markov import ORDER, RULES, WEIGHT, judge_urls, scored_urls

SMALL = "/root/testdata/sf0.001"
URLS = [
    None, "", "no scheme", "://x", "http://A.Org", "http://a.org/", "http://notexample.org/es/1", "http://EXAMPLE.org/es/1", "http://b.example.org/en/12",
    "http://b.example.org/EN/12", "https://x.com/fr/?a=://y", "https://x.com/de/#z", "http://com/de/", "http://u@h.net:80/p?q#f", "http://h.net?x/y", "a://b://c/d", "http://é.org/ü",
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", "clash") for i, u in enumerate(URLS)] + [(2, "x://y.org/", None, "clash")], "page_id long, url string, html string, host string")
    out = judge_urls(pages).collect()
    assert len(out) == len(URLS) + 1
    for r in out:
        url = URLS[r.page_id] if r.rule != "org/" or URLS[r.page_id] == "http://a.org/" or r.page_id != 2 else "x://y.org/"
        assert (r.host, r.path) == brute.host_path(url)
        rule, verdict = brute.rule_of(r.host, r.path, RULES)
        assert r.rule == rule and (r.verdict == verdict if rule else r.verdict in ("allow", "block"))
    assert judge_urls(pages.where("false")).collect() == []


def test_models_learn_from_rules(spark):
    out = QUERIES["op1_url_language_models"](spark, "/root/testdata/sf0.01").collect()
    ruled = [r for r in out if r.rule]
    for r in out:
        assert (r.rule, r.verdict if r.rule else None) == brute.rule_of(r.host, r.path, RULES)
    allowed, blocked = ([r.score for r in ruled if r.verdict == v] for v in ("allow", "block"))
    better = sum(a > b for a in allowed for b in blocked) / (len(allowed) * len(blocked))
    assert better > 0.95


def plain_difference(accepted, rejected, text):
    """The mixed models by their definition, from dictionaries of runs."""
    logs = []
    for texts in (accepted, rejected):
        seen = Counter()
        for t in texts:
            t = t.encode()
            for i in range(len(t)):
                for length in range(1, ORDER + 2):
                    seen[length, t[max(0, i + 1 - length) : i + 1]] += 1
        total = sum(len(t.encode()) for t in texts)
        log = 0.0
        t = text.encode()
        for i in range(len(t)):
            p = 1 / 256
            for length in range(1, ORDER + 2):
                before = total if length == 1 or i == 0 else seen[length - 1, t[max(0, i + 1 - length) : i]]
                p = (seen[length, t[max(0, i + 1 - length) : i + 1]] + WEIGHT * p) / (before + WEIGHT)
            log += math.log(p)
        logs.append(log)
    return (logs[0] - logs[1]) / max(1, len(text.encode()))


def test_scores_equal_a_plain_model(spark):
    rows = [(r.url.lower() if r.url.isascii() else r.url) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    labelled = [(u, i % 3 > 0) for i, u in enumerate(rows)]
    urls = [*rows, "", "x", "http://unseen.example/zzz?q=é", rows[0], "http://long.example/" + "ab/" * 2_000]
    frame = spark.createDataFrame([(u,) for u in urls], "text string")
    scored, totals = scored_urls(frame, spark.createDataFrame(labelled, "text string, allowed boolean"))
    got = {r.text: r.score for r in scored.collect()}
    accepted, rejected = [u for u, y in labelled if y], [u for u, y in labelled if not y]
    assert totals.tolist() == [sum(map(len, accepted)), sum(map(len, rejected))] and set(got) == set(urls)
    for text in {*urls[-5:], *rows[:10]}:
        assert abs(got[text] - plain_difference(accepted, rejected, text)) < 1e-9, text


def test_without_labels_nothing_is_rejected(spark):
    pages = spark.createDataFrame([(i, f"http://host{i}.net/a", None) for i in range(20)], "page_id long, url string, html string")
    assert {(r.verdict, r.score) for r in judge_urls(pages).collect()} == {("allow", 0.0)}


def test_sample_articles(spark):
    rows = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    out = QUERIES["op2_template_extraction"](spark, SMALL).collect()
    assert len(out) == len(rows)
    for r in out:
        article = re.search(r"<article>(.*?)</article>", rows[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


PAGE = """<html><head><title>T &amp; t</title><script>if (a < b) document.write("<p>no</p></article>")</script></head><body class="home">
<header><a href=/>Site</a><ul class='menu'><li>Home<li>About</ul></header><div id="cookie-notice"><p>We use cookies</p></div>
<div class="content-wrap"><div class="post"><h1>Title {i} &lt;x&gt;</h1><p>First&nbsp;  para {i}
 with <b>bold <i>text</b></i> and caf&eacute; &#233;&#x65;<p>Second one {i}<br>line</p><ul><li>Item {i}</ul><p>Read it on this site only.</p>
<aside>Side {i}</aside><form><label>Mail</label><input value="<p>"></form></div>
<section class="comments"><p>Reader {i} says hi, with a comment that is much longer than all of the article text put together, again and again and again.</p></section></div>
<!-- <p>hidden</p> --><div class="sidebar"><p>Also {i}</p></div><footer>Contact</footer></body></html>"""


def test_a_template_without_article_elements(spark):
    rows = [(i, f"http://host.example/{i}", PAGE.replace("{i}", str(i))) for i in range(30)]
    rows += [(100, None, None), (101, "x", ""), (102, None, "<p>alone"), (103, "http://host.example/x", "<div><p>Another layout with some text"), (0, rows[0][1], rows[0][2])]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, host int")
    out = {}
    for r in extract_main_text(pages).collect():
        out.setdefault(r.page_id, []).append(r.text)
    for i in range(30):
        expected = f"Title {i} <x>\nFirst para {i} with bold text and café ée\nSecond one {i} line\nItem {i}"
        assert out[i] == [expected] * (2 if i == 0 else 1)
    assert out[100] == out[101] == [""] and out[102] == ["alone"] and out[103] == ["Another layout with some text"]
    assert extract_main_text(pages.where("false")).collect() == []


def page_of(layout, i):
    """Pages of several layouts, each with two sentences of its own inside the main element."""
    words = " ".join(f"t{i}w{k}" for k in range(40))
    return (
        f"<html><body><div class='top{layout}'><p>Welcome to layout {layout}</p></div><div class='box{layout}'><h1>Title {i}</h1>"
        f"<p>{words}</p><p>Read more in edition {layout} of our paper.</p><p>{words} end</p><p>Printed by house {layout}.</p></div></body></html>"
    )


def texts(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in extract_main_text(pages).collect()}


def main_of(i):
    words = " ".join(f"t{i}w{k}" for k in range(40))
    return f"Title {i}\n{words}\n{words} end"


def test_every_layout_of_a_host_has_its_template(spark):
    rows = [(i, f"http://many.example/{i}", page_of(i % 4, i)) for i in range(40)]
    rows += [(100 + i, f"http://small.example/{i}", page_of(7, 100 + i)) for i in range(9)]
    rows += [(200 + i, f"http://even.example/{i}", page_of(8 + i % 2, 200 + i)) for i in range(200)]
    out = texts(spark, rows)
    assert {i: t for i, t in out.items() if t != main_of(i)} == {}


def test_copies_keep_their_text(spark):
    rows = [(i, f"http://copies.example/{i}", page_of(1, 5)) for i in range(12)]
    rows += [(100 + i, f"http://mixed.example/{i}", page_of(2, 7 if i < 6 else 100 + i)) for i in range(20)]
    out = texts(spark, rows)
    assert all(main_of(5) in out[i].replace("\nRead more in edition 1 of our paper.", "") for i in range(12))
    assert all(out[100 + i] == main_of(7 if i < 6 else 100 + i) for i in range(20))


def test_class_names_set_no_wrapper_of_the_main_text_apart(spark):
    words = " ".join(f"word{k}" for k in range(150))
    names = ["layout with-sidebar", "post no-comments", "related-work body", "share-story", "ad-free reader", "page-header-image main-text"]
    inner = f"<h1>A title</h1><p>{words}</p><div class='comments'><p>{words} {words}</p></div>"
    rows = [(i, f"http://h{i}.example/", f"<body><div class='{name}'>{inner}</div></body>") for i, name in enumerate(names)]
    rows += [(10 + i, f"http://p{i}.example/", f"<body><div class='{name}'><div><p>{words}</p></div></div></body>") for i, name in enumerate(names)]
    out = texts(spark, rows)
    assert all(out[i] == f"A title\n{words}" and out[10 + i] == words for i in range(6))


def test_hostile_pages_take_time_in_proportion(spark):
    n = 200_000
    pages = ["<a " * n, "<" * n, "</a" * n, "<a b='>' " * (n // 4), "<div class=ad>" * (n // 10) + "x", "<b><hr>" * (n // 10), "<li><blockquote>" * (n // 10),
             "<b>" * (n // 10) + "</i>" * (n // 10), "&" * n, "<!--" * n, "<script>" * (n // 10), "<p><a>" * (n // 10) + "text", "a < b " * (n // 10)]
    start = time.time()
    for page in pages:
        parse(page)
    assert time.time() - start < 30
    out = texts(spark, [(0, "x", pages[0]), (1, "x", "<p>kept</p>" + pages[3]), (2, "x", "<p>" + "long " * n)])
    assert out[1].startswith("kept") and out[2] == ("long " * n).strip()


def test_tags():
    found = [(t.opened, t.closed) for t in tags("<P a='>'>x<br/></p ><!-- <b> --><!DOCTYPE x><script>'<i>'</script>1 < 2<img")]
    assert found == [("p", ""), ("br", ""), ("", "p"), ("", ""), ("", ""), ("script", ""), ("", "")]


def test_deduced_classes_equal_plain_ones(spark):
    """Tokens with equal counts on the same pages, of enough pages, with an element around text of few pages."""
    generator = random.Random(3)
    pages = []
    for i in range(60):
        parts = [f"<div class='c{k}'><p>fixed {k}</p><span>{generator.random()}</span></div>" * generator.choice([1, 1, 2]) for k in range(6) if generator.random() < 0.5 or k == 0]
        pages.append("<body>" + "".join(parts) + "</body>")
    vectors, paths, mass = {}, {}, Counter()
    for i, page in enumerate(pages):
        blocks, elements = parse(page)
        for token, path, block in [(_token(p), p, False) for p in elements] + [(_token(b.path, b.text), b.path, True) for b in blocks]:
            vectors.setdefault(token, Counter())[i] += 1
            paths[token] = path, block
        for b in blocks:
            mass[_token(b.path, b.text)] += len(b.text)
    classes = {}
    for token, vector in vectors.items():
        if len(vector) >= LEAST_PAGES:
            classes.setdefault(frozenset(vector.items()), set()).add(token)
    slots = [paths[t][0] for t, v in vectors.items() if paths[t][1] and len(v) < LEAST_PAGES]
    expected = set()
    for vector, members in classes.items():
        above = [paths[t][0] for t in members if not paths[t][1]]
        if any(s == a or s.startswith(a + "/") for a in above for s in slots):
            expected.add((len(vector), frozenset(t for t in members if paths[t][1])))
    rows = spark.createDataFrame([("h", i, p) for i, p in enumerate(pages)], "host string, key long, html string").repartition(4)
    from pyspark.sql import functions as F

    from tallyhouse.llm.html_template import _STATS, _occurrences

    tokens = rows.mapInArrow(_occurrences, _STATS).groupBy("host", "token").agg(
        F.bit_xor("vector").alias("vector"), F.sum("pages").alias("pages"), F.min("path").alias("path"), F.first("is_block").alias("is_block"),
        F.bool_and("apart").alias("apart"), F.sum("chars").alias("chars"), (F.sum("place") / F.sum("pages")).alias("place"),
    )
    assert expected and {(r.pages, frozenset(r.fixed)) for r in deduced_templates(tokens).collect()} == expected
