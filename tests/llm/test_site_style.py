import html
import math
import re
import time
from collections import Counter

import numpy as np
from cases import given

from tripkpi.llm import site_style


def texts(spark, rows):
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host string, low string")
    return {r.page_id: (r.text, r.n_chars) for r in site_style.extract(table).collect()}


def page(body):
    return f"<html><head><title>t</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_given_pages_give_their_articles(spark):
    pages = given(spark, "pages")
    got = {r.page_id: r for r in site_style.extract(pages).collect()}
    assert len(got) == pages.count()
    for row in pages.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", row.html, re.DOTALL)[1]
        plain = re.sub(r"<[^>]+>", " ", re.sub("</?b>", "", inner))
        assert got[row.page_id].text == " ".join(html.unescape(plain).split())
        assert got[row.page_id].n_chars == len(got[row.page_id].text)


def test_branches_that_a_host_s_pages_share_go(spark):
    rows = [
        (i, f"http://h.example/{i}", page(
            f"<div class=x1>Same words here</div><div class=x2><p>Story number {i} is this</div>"
        ), "x", "x", "x")
        for i in range(12)
    ]
    rows += [(100, "http://other.example/", rows[0][2], "x", "x", "x")]
    got = texts(spark, rows)
    assert all(got[i][0] == f"Story number {i} is this" for i in range(12))
    assert got[100][0] == "Same words here Story number 0 is this"  # nothing to compare it with


def test_copies_of_a_page_do_not_make_it_a_template(spark):
    body = page("<div class=x2><p>The only story</div>")
    rows = [(i, "http://copies.example/", body, "x", "x", "x") for i in range(9)]
    assert {t for t, _ in texts(spark, rows).values()} == {"The only story"}


def test_markup_of_all_kinds(spark):
    rows = [
        (1, None, page("<p>a<b>b</b>c<br>d &amp; &lt;e&gt;&nbsp; f<p>g")),
        (2, "http://a/", page("<nav>menu</nav><header>h</header><article><header><h1>T</h1></header><p>x</article><footer>f")),
        (3, "http://a/", page("<script>var t='</p>';</script><form>q</form><aside>s</aside><div class='cookie-notice'>c</div><p>y")),
        (4, "http://a/", page("<article><p>z<div class=comments><p>reader</div></article>")),
        (5, "http://a/", None),
        (6, "http://a/", ""),
        (7, "not a url", "plain < text"),
        (8, "http://a/", "<!-- never closed <p>gone"),
        (9, "http://a/", page("<p title='a>b'>quoted</p><p hidden>no</p>") + "<p" + "x" * 10),
        (10, "http://a/", page("<ul><li>one<li>two</ul>" + "<div>" * 3_000 + "deep")),
    ]
    got = texts(spark, [(*r, "x", "x", "x") for r in rows])
    assert {i: t for i, (t, _) in got.items()} == {
        1: "abc d & <e> f g", 2: "T x", 3: "y", 4: "z", 5: "", 6: "", 7: "plain < text", 8: "",
        9: "quoted", 10: "one two deep",
    }
    assert texts(spark, [(*rows[0], "x", "x", "x")] * 2)[1][0] == "abc d & <e> f g"
    assert site_style.extract(given(spark, "pages").limit(0)).count() == 0


def test_importance_decides_within_articles_too(spark):
    rows = [
        (i, f"http://h.example/{i}", page(
            f"<script>track({i})</script><div class=lead>Lead {i}</div><div class=date>All days</div>"
            f"<{tag}><p>Story number {i} is this</p><div class=x1>Same words here</div></{tag}>"
        ), "x", "x", "x")
        for tag, ids in (("article", range(8)), ("main", range(8, 16)))
        for i in ids
    ]
    rows += [(100, "http://other.example/", rows[0][2], "x", "x", "x")]
    # The same article with other numbers in its script is a copy, not a template.
    rows += [(200 + i, "http://copies.example/", rows[0][2].replace("track(0)", f"track({i})"), "x", "x", "x") for i in range(9)]
    got = texts(spark, rows)
    assert all(got[i][0] == f"Lead {i} Story number {i} is this" for i in range(16))
    assert got[100][0] == got[205][0] == "Story number 0 is this Same words here"


def test_articles_that_are_noise_or_empty_are_not_the_main_text(spark):
    own = "<div class=story><p>The text itself</div>"
    rows = [
        (1, "http://a.example/", page(own + "<div class=comments><article class=comment><p>reader</article></div>")),
        (2, "http://b.example/", page(own + "<aside><article><p>teaser</article></aside>")),
        (3, "http://c.example/", page(own + "<article class=related><p>other</article><main> <nav>menu</nav></main>")),
        (4, "http://d.example/", page("<p>beside<article><p>in<aside>x</aside></article>")),
    ]
    got = texts(spark, [(*r, "x", "x", "x") for r in rows])
    assert {i: t for i, (t, _) in got.items()} == {
        1: "The text itself", 2: "The text itself", 3: "The text itself", 4: "in",
    }


def test_only_attributes_that_hide_hide(spark):
    shown = [
        '<div style="overflow:hidden">{}</div>', "<div class=overflow-hidden>{}</div>",
        '<p aria-hidden="false">{}</p>', '<p title="a hidden valley">{}</p>',
        '<a href="/hidden-valley">{}</a>', '<p data-id="ad" data-x="display:none">{}</p>',
        '<p style="display:none; display:block">{}</p>', "<figure><figcaption>{}</figcaption></figure>",
        "<p hidden=until-found>{}</p>",
    ]
    gone = [
        "<p hidden>{}</p>", '<p class=a HIDDEN="">{}</p>', "<p hidden/>{}</p>", "<p aria-hidden=true>{}</p>",
        "<p aria-hidden = 'TRUE'>{}</p>", '<p style="color:red; display : none !important">{}</p>',
    ]
    rows = [
        (i, f"http://h{i}.example/", page(f"<article>{form.format(f'case {i}')}</article>"), "x", "x", "x")
        for i, form in enumerate(shown + gone)
    ]
    got = texts(spark, rows)
    assert [got[i][0] for i in range(len(rows))] == [f"case {i}" for i in range(len(shown))] + [""] * len(gone)


def test_importance_counts_all_pages_that_have_a_branch(spark):
    rows = [
        (i, f"http://h.example/{i}", page(
            f"<div class=intro>Series {i // 3} begins</div><p>Part {i}</p><div class=x>Menu</div>"
        ), "x", "x", "x")
        for i in range(9)
    ]
    rows += [(20 + i, "http://two.example/", page(f"<p>Part {i}</p><div class=x>Menu</div>"), "x", "x", "x") for i in range(2)]
    got = texts(spark, rows)
    assert all(got[i][0] == f"Series {i // 3} begins Part {i}" for i in range(9))
    assert [got[i][0] for i in (20, 21)] == ["Part 0 Menu", "Part 1 Menu"]  # too few to tell


def test_names_decide_outside_articles_and_are_a_prior_within(spark):
    kept = [
        "<article><div class='entry-header'><h1>T</h1></div></article>", "<article><h1 class='post-header'>T</h1></article>",
        "<article class=legal><p>T</article>", "<article><div class='search-result'>T</div></article>",
        "<article><p>T<span class=share> 50%</span></article>", "<article><p>T <math><mi>x</mi></math></article>",
        "<div class='entry-header'><h1>T</h1></div>", "<article><h2 id=menu>T</h2></article>",
        "<article><section id='related-work'>T</section></article>",
    ]
    gone = [
        "<article><div class=ad>T</div></article>", "<article><div class='box comments'>T</div></article>",
        "<main><div class=sidebar>T</div></main>", "<article class=comment>T</article>", "<div class='site-header'>T</div>",
        "<article><div id=comment-list>T</div></article>", "<article><div class='share-buttons'>T</div></article>",
    ]
    rows = [(i, f"http://h{i}.example/", page(form), "x", "x", "x") for i, form in enumerate(kept + gone)]
    got = texts(spark, rows)
    expected = ["T"] * 4 + ["T 50%", "T x"] + ["T"] * 3 + [""] * len(gone)
    assert [got[i][0] for i in range(len(rows))] == expected


def test_doubtful_names_within_articles_need_more_importance(spark):
    def rows_with(name):
        return [
            (i, f"http://h.example/{i}", page(
                f"<article><h1 class=entry-header>Title {i}</h1><p>Story {i}</p><div class={name}>Kind {i // 4}</div></article>"
            ), "x", "x", "x")
            for i in range(12)
        ]

    assert all(t == f"Title {i} Story {i} Kind {i // 4}" for i, (t, _) in texts(spark, rows_with("facts")).items())
    assert all(t == f"Title {i} Story {i}" for i, (t, _) in texts(spark, rows_with("footer")).items())


def brute_low(pages):
    """Paths below the threshold, from all texts, layouts and pages of a host in memory."""
    digest = site_style._digest()
    read = {}
    for source in pages:
        found = site_style.Page(source, digest)
        read[repr([b for b in found.blocks if not b.noise])] = found
    read = list(read.values())
    on, layouts, leaves = {}, {}, {}
    for number, found in enumerate(read):
        blocks = [b for b in found.blocks if not b.noise]
        for b in blocks:
            leaves.setdefault(b.leaf, {}).setdefault(b.text, set()).add(number)
            for path in found.branches(b.leaf):
                on.setdefault(path, (set(), set()))[0].add(number)
                on[path][1].add(b.leaf)
        for path, layout in set(found.nodes):
            layouts.setdefault(path, {}).setdefault(layout, set()).add(number)
    low = set()
    for path, (where, below) in on.items():
        shares = [math.log(len(w)) for leaf in below for w in leaves[leaf].values()]
        importance = 1 - sum(shares) / len(shares) / math.log(max(len(where), 2))
        if path in layouts:
            n = [len(w) for w in layouts[path].values()]
            all_n = sum(n)
            spread = math.log(all_n) - sum(x * math.log(x) for x in n) / all_n
            own = spread / math.log(all_n) if all_n > 1 else 0
            importance = (1 - site_style.GAMMA) * own + site_style.GAMMA * importance
        if len(where) >= site_style.LEAST_PAGES and importance < site_style.THRESHOLD:
            low.add(path)
    return low


def test_importance_equals_a_plain_count(spark):
    random = np.random.default_rng(4)
    pages = []
    for i in range(40):
        parts = [
            f"<div class=c{j}><p>Text {random.integers(1, 2 + 6 * j)}</p>" + "<ul><li>Item</ul>" * (random.random() < 0.5) + "</div>"
            for j in range(8) if random.random() < 0.9
        ]
        pages.append(page("".join(parts)))
    rows = [(i, "http://h.example/", source, "x", "x", "x") for i, source in enumerate(pages + pages[:5])]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host string, low string")
    got = {r.path for r in site_style.judged(table).where("low").collect()}
    assert got == brute_low(pages) and 2 < len(got) < 20


def test_masked_names_leave_the_given_articles_to_importance(spark):
    # No names that give a part away, and one sentence shared by a host's pages in the given footers,
    # whose own texts differ on every page.
    def masked(source):
        source = re.sub(r"<footer>(&copy; \S+).*?(?=</footer>|$)", r"<footer class=z>\1", source, flags=re.DOTALL)
        source = re.sub(r"<(/?)(?:nav|footer|aside|header|article|main)\b", r"<\1div", source)
        return re.sub(r"class=\"?ad\"?", "class=x", source)

    pages = given(spark, "pages", "sf0.01").collect()
    rows = [(r.page_id, r.url, masked(r.html), "x", "x", "x") for r in pages]
    got = texts(spark, rows)
    sizes = Counter(site_style.host_of(r.url) for r in pages)
    judged = 0
    for r, (_, _, source, *_) in zip(pages, rows, strict=True):
        inner = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", r.html, re.DOTALL)[1]
        article = " ".join(html.unescape(re.sub(r"<[^>]+>", " ", re.sub("</?b>", "", inner))).split())
        text = got[r.page_id][0]
        assert article in text
        if sizes[site_style.host_of(r.url)] >= 5 and "class=z" in source:
            judged += 1
            assert not text.endswith(site_style.host_of(r.url))
    assert judged > 50


def test_deep_and_unclosed_markup_takes_time_by_length():
    digest = site_style._digest()
    for source in ("<div>a" * 50_000, "<div>a<section>b" * 25_000, "<p><b>" * 25_000 + "</i>" * 25_000, "<title>" * 50_000):
        at = time.process_time()
        found = site_style.Page(source, digest)
        for leaf in {b.leaf for b in found.blocks}:
            found.branches(leaf)
        found.main_text(frozenset(), frozenset())
        assert time.process_time() - at < 4
    assert len(site_style.Page("<div>a" * 50_000, digest).blocks) == 50_000
