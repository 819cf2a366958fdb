"""HTML extraction, line rules and the quality classifier."""

import re
import zlib

import numpy as np
import pytest

from cardweave.llm import boosted_quality, html_density, line_quality
from tests.llm.conftest import ROWS

PARAGRAPHS = ["A first paragraph that has quite some words, as articles do.", "Short one.",
              "Another paragraph, a little longer than the short one, with R&D in it."]
BODY = "".join(f"<p>{p.replace('&', '&amp;')}</p>" for p in PARAGRAPHS)


@pytest.mark.parametrize("outer", ["<article>{}</article>{}", "<main>{}</main>{}", "<div class=post>{}</div>{}"])
@pytest.mark.parametrize("name", [
    "site-header", "header", "page-header", "siteHeader", "main_header", "reader-comments", "user-comments", "readerComments",
    "google-ad", "adsbygoogle", "google-ad-slot", "top-ad-unit", "sticky-banner", "col-sidebar", "blog-sidebar left", "js-nav",
    "cookie-notice", "gdpr-consent", "newsletter-signup", "social-share", "related-posts", "footer-links", "mega-menu",
    "promo__banner--large", "disqus_thread comments", "site-footer", "mobile-nav", "email-popup", "page-breadcrumbs"])
def test_parts_by_compound_names_are_cut(name, outer):
    """Before or behind the article, with and without article and main, as class and as id."""
    extra = f"<div class='{name}'><p>SITE NAME and what else stands there.</p></div>"
    for page in (extra + outer.format(BODY, ""), outer.format(BODY, extra), outer.format(BODY, extra.replace("class", "id"))):
        assert html_density.main_text(f"<html><body>{page}</body></html>") == "\n\n".join(PARAGRAPHS)


@pytest.mark.parametrize("name", [
    "content-sidebar-wrap", "layout has-sidebar", "no-sidebar single-post", "comments-open post", "with-ads", "article-header-less",
    "post-content", "header-offset", "page-wrapper", "col-main", "story", "site-header", "google-ad", "reader-comments"])
def test_names_do_not_cut_what_holds_the_article(name):
    for inner in (f"<article>{BODY}</article>", f"<main>{BODY}</main>"):
        assert html_density.main_text(f"<body><div class='{name}'>{inner}</div></body>") == "\n\n".join(PARAGRAPHS)


def test_an_article_keeps_its_own_header():
    for name in ("header", "entry-header", "post-header", "article-header"):
        page = f"<body><article><div class='{name}'><h1>The Title</h1></div>{BODY}</article></body>"
        assert html_density.main_text(page) == "\n\n".join(["The Title", *PARAGRAPHS])


@pytest.mark.parametrize("page", [
    f"<html><body><nav><a href=/>Home</a></nav><article>{BODY}</article><footer>Imprint</footer></body></html>",
    f"<body><div class='page'><div class='sidebar'><a href=a>One</a></div><div class=post>{BODY}</div></div>",
    f"<header><h1>Site</h1></header><main>{BODY}<aside>See also</aside><form><input>Name</form></main>",
    f"<title>T</title><script>if (a < b) document.write('<p>x</p>')</script><style>p{{}}</style>{BODY}",
    f"<div id='cookie-notice'>We use cookies.</div>{BODY}<section class='comments'><p>{'Nice post. ' * 40}</p></section>",
    f"<article>{BODY.replace('</p>', '')}<div role=complementary>Extra</div><div hidden>Secret</div>",
    f"<article><!-- <p>old</p> -->{BODY}<div class='ad'>Buy</div></article",
])
def test_article_is_found_whole(page):
    assert html_density.main_text(page) == "\n\n".join(PARAGRAPHS)


@pytest.mark.parametrize("wrapper", [
    "div class='content-sidebar-wrap'", "div class='layout has-sidebar'", "div class='no-sidebar single-post'",
    "div class='comments-open post'", "form id='aspnetForm'", "div class='sidebar'", "div role=form class=page",
])
@pytest.mark.parametrize("inside", ["article", "main", "div"])
def test_wrapper_is_not_cut_with_the_article(wrapper, inside):
    page = (f"<body><{wrapper}><div class=site-nav><a href=/>Home</a></div><{inside}>{BODY}</{inside}>"
            f"<form><input>Name</form><ul class='social-links'><li>Share</ul></{wrapper.split()[0]}>")
    assert html_density.main_text(page) == "\n\n".join(PARAGRAPHS)


@pytest.mark.parametrize("part", [
    "<div class=no-sidebar><p>An intro.</p></div>", "<section class='comments-open'><p>An intro.</p></section>"])
def test_part_of_a_name_does_not_cut(part):
    assert "An intro." in html_density.main_text(f"<article>{BODY}{part}</article>")


def test_page_without_article_keeps_all_its_parts():
    long, short = [f"{k} " + "long text " * 20 for k in range(10)], [f"{k} " + "short text " * 7 for k in range(5)]
    paragraphs = lambda texts: "".join(f"<p>{t}</p>" for t in texts)
    links = "<ul>" + "".join(f"<li><a href={k}>Some other page {k}</a></li>" for k in range(8)) + "</ul>"
    page = (f"<body><p>An intro.</p>And <a href=x>one linked</a> line in the body.{links}<div class=post>"
            f"<div>{paragraphs(long)}</div><div>{paragraphs(short)}</div></div>"
            f"<div>{links}<p>{short[0]}</p></div><span><a href=y>More</a></span>")
    want = ["An intro.", "And one linked line in the body.", *long, *short, short[0]]
    assert html_density.main_text(page) == "\n\n".join(t.strip() for t in want)


@pytest.mark.parametrize(("page", "text"), [
    ('<p class="a"">Hello world</p><p>more</p>', "Hello world\n\nmore"), ("<p title=don't>Hello</p><p>more</p>", "Hello\n\nmore"),
    ("<p ' class=x>Hello</p><p>more</p>", "Hello\n\nmore"), ("<p title = '>' id=\">\">Hello</p>", "Hello"),
    ("<p title=a\"b class=ad>Hello</p><p>more</p>", "more"), ('<p title="a"class="ad">x</p><p>more</p>', "more"),
    ("<p title=>Hello</p><p>more</p>", "Hello\n\nmore"), ("<a/href='>'>x</a><p>more", "x\n\nmore"),
    ('Hello<p title="never closed>more</p>', "Hello"), ("<p " + "a = " * 50_000, ""),
])
def test_quotes_in_tags(page, text):
    body = f"<article>{page}"
    assert html_density.main_text(body) == text


def test_long_advert_beside_a_short_article_is_cut():
    page = f"<body><div class=ad>{'Buy now. ' * 20}</div><article><p>Short.</p></article>"
    assert html_density.main_text(page) == "Short."


def test_comments_are_cut_however_long():
    remark = f"<article class=comment-body><p>{'Nice post. ' * 90}</p></article>"
    for post in ("article", "div"):
        page = f"<body><{post}>{BODY}</{post}><div id=comments class=comment-list>{remark * 3}</div>"
        assert html_density.main_text(page) == "\n\n".join(PARAGRAPHS)


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("<p>", ""), ("only text", "only text"), ("<script>x", ""), ("<p>a &lt;b&gt; &#99;", "a <b> c"),
    ("<p>a<br>b <b>c\n d</b></p>", "a b c d"), ("<ul><li>x<li>y</ul>", "x\n\ny"), ("a < b", "a < b"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<p>" + "long " * 50_000, "long " * 49_999 + "long"),
])
def test_page_edges(page, text):
    assert html_density.main_text(page) == text


def test_pages_table(spark):
    rows = [(1, "u", "<p>a</p>", 1), (1, "u", "<p>a</p>", 1), (None, None, None, None), (2, "v", "", 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = sorted(map(tuple, html_density.extract_main_text(pages).collect()), key=str)
    assert got == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0), (2, "v", "", 0)], key=str)
    assert html_density.extract_main_text(pages.limit(0)).count() == 0


def slow_judge(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    covered = {k + d for k, w in enumerate(windows) if counts[w] > 1 for d in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered), failed)


def test_base_counts(spark, tricky, none):
    got = line_quality.judge_documents(tricky).collect()
    want = sorted(((i, *slow_judge(t)) for i, t in ROWS), key=str)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in got), key=str) == want
    assert all(not r.kept for r in got if r.base_failed)
    assert {r.doc_id: r.cleaned for r in got}[4] is None
    assert line_quality.judge_documents(none).count() == 0


def test_repeats_of_many_words_stay_exact():
    rng = np.random.default_rng(1)
    words = [b"%d" % k for k in rng.integers(0, 9000, 30_000)] * 2
    text = b" ".join(words[:31_000]).decode()
    assert line_quality.judge(text, line_quality.LineRules())["n_repeat_words"] == slow_judge(text)[4]


@pytest.mark.parametrize(("line", "kind"), [
    ("Home | News | Sport | Weather | Login", "navigation"), ("About us", "navigation"), ("Next", "navigation"),
    ("WOW!! THIS!! IS!! GREAT!!", "punctuation"), ("Copyright 2020 Example. All rights reserved.", "boilerplate"),
    ("Licensed under the Apache License, Version 2.0.", "boilerplate"),
    ("The clerk counted the crates, wrote down the sum, and went home.", None), ("Yes.", None),
])
def test_line_rules(line, kind):
    assert line_quality.line_fails(line, line_quality.LineRules()) == kind


PROSE_BY_SCRIPT = {
    "ja": "港は静かで、最初の船が入ってきたとき、岸壁の誰もささやき声より大きな声では話さなかった。",
    "zh": "第一批船只进港时，港口十分安静，码头上没有人大声说话，只有一名职员在清点橙子的箱数。",
    "th": "ท่าเรือเงียบสงบเมื่อเรือลำแรกเข้ามาและไม่มีใครบนท่าเรือพูดเสียงดังกว่าเสียงกระซิบจนกระทั่งฝนเริ่มตกในตอนเย็น",
    "hi": " ".join(["बंदरगाह शांत था जब पहली नावें आईं और घाट पर किसी ने फुसफुसाहट से ऊपर बात नहीं की"] * 3) + "।",
    "ar": "كان الميناء هادئا عندما دخلت القوارب الأولى، ولم يتحدث أحد على الرصيف بصوت أعلى من الهمس.",
    "el": "Το λιμάνι ήταν ήσυχο όταν μπήκαν οι πρώτες βάρκες, και κανείς δεν μιλούσε δυνατά.",
    "fr": "Le port était calme, « trop calme », quand les premiers bateaux sont entrés à l’aube.",
}
MENUS = {"ja": ["ホーム", "会社概要", "お問い合わせ", "採用情報"], "zh": ["首页", "产品中心", "联系我们"],
         "hi": ["मुखपृष्ठ", "हमारे बारे में", "संपर्क"], "ar": ["الرئيسية", "من نحن", "اتصل بنا"],
         "th": ["หน้าแรก", "ติดต่อเรา", "เกี่ยวกับเรา"], "fr": ["Actualités", "Boutique", "Météo"]}


@pytest.mark.parametrize("script", sorted(PROSE_BY_SCRIPT))
def test_prose_of_every_script_stays_and_its_menus_go(script):
    rules, prose = line_quality.LineRules(), PROSE_BY_SCRIPT[script]
    assert line_quality.line_fails(prose, rules) is None
    whole = "\n".join(f"{prose}{k}" if script == "th" else prose.replace(prose[-1], f"{k}{prose[-1]}") for k in range(30))
    judged = line_quality.judge(whole, rules)
    assert judged["n_failed_lines"] == 0 and judged["cleaned"] == whole
    menu = MENUS.get(script)
    if menu:
        judged = line_quality.judge("\n\n".join([*menu, prose, menu[0]]), rules)
        assert judged["cleaned"].strip("\n") == f"{prose}\n\n{menu[0]}" and judged["n_failed_lines"] == len(menu)


def test_headings_stay():
    text = f"Chapter Two\n\n{PARAGRAPHS[0]}\n\nThe Harbour\nA quiet morning\n{PARAGRAPHS[2]}"
    judged = line_quality.judge(text, line_quality.LineRules())
    assert judged["n_failed_lines"] == 0 and judged["cleaned"] == text


def slow_verdict(text, rules):
    """Lost characters told line by line, each entry by looking both ways."""
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\v\f\r")]
    kinds = [line_quality.line_fails(x, rules) for x in lines]
    menu = [k in ("entry", "navigation") for k in kinds]
    lost = 0
    for at, (line, kind) in enumerate(zip(lines, kinds)):
        low = high = at
        while low > 0 and menu[low - 1]:
            low -= 1
        while high + 1 < len(lines) and menu[high + 1]:
            high += 1
        if kind not in ("entry", None) or menu[at] and high - low + 1 >= rules.entries:
            lost += len(re.sub(r"[ \t\v\f\r]", "", line))
    n_words, chars, _, _, _, failed = slow_judge(text)
    return not failed and 100 * lost <= rules.lost_percent * chars


def test_verdict_equals_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rules = line_quality.LineRules()
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.kept for r in line_quality.judge_documents(docs, cleaned=False).collect()}
    assert got == {i: slow_verdict(t, rules) for i, t in texts.items()} and any(got.values())


def test_document_that_loses_too_much_goes():
    good = "The clerk counted the crates, wrote down the sum, and went home before the rain came."
    bad = "Home | News | Sport | Weather | Login | Shop | Jobs"
    judged = line_quality.judge(f"{good}\n{bad}", line_quality.LineRules())
    assert judged["kept"] and judged["cleaned"] == good and judged["n_failed_lines"] == 1
    assert not line_quality.judge("\n".join([good, bad, bad, bad]), line_quality.LineRules())["kept"]


def test_trees_walk_as_one_row_at_a_time():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(400, len(boosted_quality.STATISTICS))).astype(np.float32)
    good = (rows[:, 3] + rows[:, 7] * rows[:, 1] > 0).astype(float)
    trees = boosted_quality.fit_trees(rows, good, boosted_quality.Boosting(trees=15))
    for row, score in zip(rows[:50], trees.scores(rows)[:50]):
        total = trees.base
        for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += leaf[node - len(feature)]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))
    assert ((trees.scores(rows) > 0.5) == good).mean() > 0.9
    assert list(boosted_quality.fit_trees(rows[:0], good[:0]).scores(rows[:2])) == [0.5, 0.5]


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in boosted_quality.quality_scores(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    held = [(r.quality, got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(a == b for a, b in held) > 0.9 * len(held)


def test_quality_tables(spark, tricky, none):
    labels = spark.createDataFrame([(1, 1, 9), (1, 0, 9), (8, 1, 9), (13, 0, 9), (None, 1, 9), (7, None, 9)],
                                   "doc_id long, quality int, stats int")
    got = boosted_quality.quality_scores(tricky, labels).collect()
    assert len(got) == len(ROWS) and all(r.held_out for r in got if r.doc_id is None)
    assert boosted_quality.quality_scores(none, labels).count() == 0
    assert {r.score for r in boosted_quality.quality_scores(tricky, labels.limit(0)).collect()} == {0.5}
    kept = boosted_quality.keep_good(tricky, labels)
    assert kept.columns == tricky.columns
    assert kept.count() == sum(r.predicted for r in got)
