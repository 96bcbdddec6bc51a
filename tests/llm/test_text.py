"""Line dedup, decontamination, HTML extraction and URL filters."""

from __future__ import annotations

import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ratecraft.llm import common, html_extract, line_dedup, url_filters
from ratecraft.llm.decontamination import contaminated, drop_contaminated
from tests.llm import brute


def boundary(before, line):
    """The operator's rolling hash over two lines, computed alone."""

    def h(x):
        data = np.frombuffer(x.encode(), np.uint8)
        return common.span_hash(common.rolling(data), np.array([0]), np.array([len(data)]))

    one, two, _ = common.constants(3, 31)
    roll = h(line) * one + (h(before) * two if before is not None else np.uint64(0))
    return int(common.mix(roll)[0]) & 1 == 0


def test_line_dedup_equals_brute_force(make_docs, corpus):
    out = {r.doc_id: r for r in line_dedup.dedup_lines(make_docs(corpus)).collect()}
    expected = brute.line_dedup(corpus, boundary)
    assert {i: r.text for i, r in out.items()} == expected
    removed = [i for i, t in corpus if expected[i] != t]
    assert removed and all((out[i].n_removed > 0) == (i in removed) for i in out)


def test_repeated_passages_go_and_clean_texts_stay(make_docs):
    passage = " ".join(f"w{k}" for k in range(70))
    short = "a short line that many documents share"
    rows = [(k, f"{short}\nown text number {k} stays here\n{passage}\nand an end {k}") for k in range(1, 6)]
    rows += [(9, f"nothing shared {short[:5]}"), (None, passage), (10, None), (11, ""), (12, passage), (12, passage)]
    out = line_dedup.drop_repeated_lines(make_docs(rows))
    got = {(r.doc_id, r.text) for r in out.collect()}
    # the null id's row comes first of all, is left alone and counts as the first occurrence
    assert (None, passage) in got and sum(passage in (t or "") for _, t in got) == 1
    assert {i for i, _ in got} == {None, 1, 2, 3, 4, 5, 9, 10, 11}
    assert all(short in t for i, t in got if i in range(1, 6))
    assert out.columns == make_docs([]).columns
    assert all(r.n_chars == len(r.text) for r in out.collect() if r.text and r.doc_id is not None)
    assert line_dedup.dedup_lines(make_docs([])).count() == 0


def test_decontamination(spark, make_docs):
    item = "Ann has 12 apples and gives Bob 3 apples, then Ann buys 5 kg of flour for 20 dollars in total"
    other = "the quick brown fox jumps over the lazy dog near a quiet river bank at dawn every single day"
    bench = spark.createDataFrame([(1, item), (2, other), (3, "too short"), (4, None), (None, other)], "item_id long, text string")
    again = item.replace("Ann", "Eve").replace("Bob", "Tom").replace("12", "40").replace("20", "33")
    jumble = "x, Ann has 12 apples and gives Bob 3 apples, then Eve buys 5 kg of flour for 20 dollars in total"
    rows = [
        (1, f"intro words here. {item}. And more."), (2, f"so, {again}."), (3, "clean text about the quick brown fox and nothing else at all"),
        (4, other.upper().lower() + "\n" + other), (5, None), (6, ""), (None, other), (7, " ".join(other.split()[:9])), (8, jumble.replace("Eve", "Zoe").replace("12", "9").replace(" 3 ", " 8 ")),
        (1, f"intro words here. {item}. And more."),
    ]
    got = {(r.doc_id, r.item_id): r for r in contaminated(make_docs(rows), bench).collect()}
    assert set(got) >= {(1, 1), (2, 1), (4, 2)}
    assert {d for d, _ in got} <= {1, 2, 4, 8}
    assert got[2, 1].slots > 0 and got[2, 1].consistent == got[2, 1].slots
    left = drop_contaminated(make_docs(rows), bench)
    assert left.columns == make_docs([]).columns
    assert {r.doc_id for r in left.collect()} >= {None, 3, 5, 6, 7}
    assert contaminated(make_docs([]), bench).count() == 0
    assert contaminated(make_docs(rows), bench.limit(0)).count() == 0


def test_decontamination_judges_each_occurrence(spark, make_docs):
    """Lists whose windows repeat, and items beside variants of themselves."""
    even = "What number comes next in the list 2, 4, 6, 8, 10, 12, 14, 16, 18, 20?"
    shop = "Ann has 12 apples and gives Bob 3 apples, then Ann buys 5 kg of flour for 20 dollars in total"
    other = shop.replace("Ann", "Eve").replace("Bob", "Tom").replace("12", "40").replace("20", "33").replace(" 3 ", " 7 ").replace(" 5 ", " 9 ")
    third = other.replace("Eve", "Zoe").replace("Tom", "Max").replace("40", "41").replace("33", "34").replace(" 7 ", " 6 ").replace(" 9 ", " 8 ")
    coins = "First Ann pays Bob 7 coins, then Bob pays Ann 7 coins, so Ann and Bob have 7 coins each"
    jumble = "First Eve pays Tom 1 coins, then Zoe pays Max 2 coins, so Kim and Lea have 3 coins each"
    bench = spark.createDataFrame([(1, even), (2, "so " + shop), (3, coins)], "item_id long, text string")
    rows = [(1, f"quiz. {even} end"), (2, f"so {shop}. And so {other}."), (3, f"so {other}. And so {third}."), (4, "plain text"), (5, f"so {other.replace(' then', ' and then')}. And so {third}.")]
    got = {(r.doc_id, r.item_id): r for r in contaminated(make_docs([*rows, (6, f"{jumble}. {jumble}.")]), bench).collect()}
    assert {(1, 1), (2, 2), (3, 2)} <= set(got)
    assert {d for d, _ in got} <= {1, 2, 3, 5}
    assert got[1, 1].consistent == got[1, 1].slots == 10

def test_names_at_the_start_of_sentences_are_slots(spark, make_docs):
    item = "Natalia sold clips to 48 of her friends in April. Natalia then sold half as many clips in May. Natalia kept 12 clips. How many clips did she sell?"
    other = item.replace("Natalia", "Brenda").replace("48", "52").replace("12", "30")
    jumble = item.replace("Natalia", "Brenda", 1).replace("Natalia", "Zoe", 1).replace("48", "52")
    clean = "Natalia walked to 48 houses in April. Brenda then took half a day off. How many of them did she see?"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, f"Some words. {other} The end."), (2, f"Some words. {item.lower()}"), (3, clean), (4, f"He said: {other}"), (5, jumble)]
    got = {r.doc_id: r for r in contaminated(make_docs(rows), bench).collect()}
    assert set(got) - {5} == {1, 2, 4}
    assert all(got[k].share == 1 and got[k].slots == got[k].consistent for k in (1, 2, 4))


def test_many_numbers_take_linear_work(spark, make_docs):
    """Anchors meet the offsets around them only: rows of the join grow with the text."""
    rng = random.Random(1)
    item = "then " + " ".join(str(rng.randrange(100)) for _ in range(20)) + " now"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    numbers = lambda n: " ".join(str(rng.randrange(1000)) for _ in range(n))
    rows = [(1, numbers(3000)), (2, f"{numbers(1500)} {item} {numbers(1500)}"), (3, numbers(30))]
    assert {r.doc_id for r in contaminated(make_docs(rows), bench).collect()} == {2}


def test_decontamination_in_other_letter_case(spark, make_docs):
    """Names don't hide an item that is copied in other letter case or broken into lines."""
    item = "yesterday Ann met Bob near the old mill, where Tom and Eve waited, and Zoe told Max the whole story twice"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, item.lower()), (2, f"x {item.upper()} y"), (3, item.replace(" ", "\n")), (4, item.replace("Ann", "Kim")), (5, "yesterday ann met bob near the old mill and that was all that came of it in the end")]
    got = {r.doc_id: r for r in contaminated(make_docs(rows), bench).collect()}
    assert set(got) == {1, 2, 3, 4}
    assert all(r.share == 1 and r.slots == r.consistent == 6 for r in got.values())

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var t="</p><article>no</article>";</script></head><body>
<header class="site">Site</header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="ad">Buy &lt;now&gt;</div><div class="cookie-notice">Cookies</div>
{open}<h1>A  title&nbsp;&eacute; &#x41;</h1><p>First <b>bold</b>er
 text &amp;amp; more, {n}<br>line<p>Second paragraph that is not closed <a href="x">link</a> end<!-- <p>no</p> -->
<form><input value="x">Name</form><aside>Side</aside><ul><li>one<li>two</ul>{close}<section class="comments"><p>Reader comment that is long, long, long and longer than the rest of the page, in fact very long.</p></section><footer>&copy; foot</footer></body></html>"""


@pytest.mark.parametrize("tag", ["article", 'div class="post-12"', "main"])
def test_html_extraction(spark, tag):
    name = tag.split()[0]
    page = PAGE.format(open=f"<{tag}>", close=f"</{name}>", n=7)
    rows = [(1, "http://a.com/1", page), (2, "http://a.com/2", page.replace("7<br>", "8<br>")), (3, None, None), (4, "x", ""), (5, "http://A.com/3", page[: page.index("Second") + 9]), (1, "http://a.com/1", page)]
    df = spark.createDataFrame([(*r, 1, "t") for r in rows], "page_id long, url string, html string, path int, host string")
    out = {r.page_id: r for r in html_extract.extract_pages(df).collect()}
    expected = "A title é A\n\nFirst bolder text &amp; more, 7 line\n\nSecond paragraph that is not closed link end\n\none\n\ntwo"
    assert out[1].text == expected and out[1].n_chars == len(expected)
    assert out[2].text == expected.replace("7 line", "8 line")
    assert out[3].text == out[4].text == "" and out[4].n_chars == 0
    assert out[5].text == expected[: expected.index("Second") + 9].strip()
    assert html_extract.extract_pages(df.limit(0)).count() == 0


def test_main_text_of_the_test_pages(spark):
    """On given pages, the text is that of the article element."""
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in html_extract.extract_pages(pages).collect():
        body = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", source[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(filter(None, blocks))


def test_url_rules(spark):
    urls = [
        (1, "http://www.Example.com/en/x?q=1"), (2, "https://blog.example.com/en/"), (3, "http://a.net/es/1"), (4, "http://a.net/fr"), (5, "a.net/fr/"), (6, None),
        (7, "http://b.com"), (8, "http://b.com/x#y"), (9, "x://c.org/en/p?u=http://d.net/es/"), (10, ""), (11, "http://xexample.com/en/1"), (1, "http://www.Example.com/en/x?q=1"), (None, "http://q.net/fr/2"),
    ]
    pages = spark.createDataFrame([(*u, 1, "x") for u in urls], "page_id long, url string, rule int, tokens string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filters.judge_urls(pages, labels).collect()}
    assert got == {
        (1, "www.example.com", "/en/x", "www.example.com/en/", "allow"), (2, "blog.example.com", "/en/", "example.com/en/", "block"), (3, "a.net", "/es/1", "net/es/", "block"),
        (4, "a.net", "/fr", None, "allow"), (5, "", "", None, "allow"), (6, "", "", None, "allow"), (7, "b.com", "", None, "allow"), (8, "b.com", "/x", "com/", "allow"),
        (9, "c.org", "/en/p", None, "allow"), (10, "", "", None, "allow"), (11, "xexample.com", "/en/1", "com/", "allow"), (None, "q.net", "/fr/2", "net/fr/", "block"),
    }
    assert url_filters.judge_urls(pages.limit(0), labels).count() == 0


def test_association_rules_equal_brute_force(spark):
    """Mined, pruned and matched rules against enumeration of all token sets."""
    rng = np.random.default_rng(0)
    parts = ["bets", "pills", "news", "blog", "shop"]
    urls = [f"http://{'-'.join(rng.choice(parts, 2))}.org/{rng.choice(['a', 'b'])}/{k}" for k in range(300)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    bad = [("bets" in u and "/a/" in u) or "pills" in u and k % 3 > 0 for k, u in enumerate(urls)]
    labels = spark.createDataFrame([(k, 1, int(b)) for k, b in enumerate(bad) if k % 2], "doc_id long, quality int, toxic int")
    rows = pages.select("page_id", url_filters.url_tokens(url_filters.host_of("url"), url_filters.path_of("url"), url_filters.F.col("url")).alias("tokens"))
    tokens = {r.page_id: frozenset(r.tokens) for r in rows.collect()}
    seen, hits = Counter(), Counter()
    for k in range(1, 300, 2):
        for n in range(1, len(tokens[k]) + 1):
            for s in itertools.combinations(sorted(tokens[k]), n):
                seen[s] += 1
                hits[s] += bad[k]
    share = sum(bad[1::2]) / 150
    sure = {s: hits[s] / seen[s] for s in seen if hits[s] >= url_filters.MIN_PAGES and hits[s] / seen[s] >= max(url_filters.MIN_CONFIDENCE, min(1, url_filters.MIN_LIFT * share))}
    sure = {s: c for s, c in sure.items() if not any(sure.get(p, -1) >= c for n in range(1, len(s)) for p in itertools.combinations(s, n))}
    # a rule's list of lists stands for every choice of a token of each
    mined = {tuple(sorted(choice)): r.confidence for r in url_filters.mine_rules(rows, labels).collect() for choice in itertools.product(*r.tokens)}
    assert mined == pytest.approx(sure) and sure
    got = {r.page_id: r.verdict for r in url_filters.judge_urls(pages, labels).collect()}
    assert got == {k: "block" if any(set(s) <= t for s in sure) else "allow" for k, t in tokens.items()}


def test_rules_of_many_tokens(spark):
    """Bad only where four path parts stand together; parts that always stand together on one site."""
    rng = random.Random(2)
    parts = ["a", "b", "c", "d"]
    urls = [f"http://x.org/{'/'.join(parts)}/{k}" for k in range(20)]
    urls += [f"http://x.org/{'/'.join(rng.sample(parts, 3))}/{k}" for k in range(120)]
    long = "/".join(f"part{chr(97 + k)}" for k in range(20))
    urls += [f"http://long.org/{long}/{k}" for k in range(60)]
    pages = spark.createDataFrame([(None if k % 2 else 7, u) for k, u in enumerate(urls)], "page_id long, url string")
    labelled = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(k, 1, int(k < 20)) for k in range(200)], "doc_id long, quality int, toxic int")
    for table in (labelled, pages):
        rows = table.select("page_id", "url", url_filters.host_of("url").alias("host"), url_filters.path_of("url").alias("path"))
        rows = rows.withColumn("tokens", url_filters.F.array_sort(url_filters.url_tokens(url_filters.F.col("host"), url_filters.F.col("path"), url_filters.F.col("url"))))
        if table is labelled:
            rules = url_filters.mine_rules(rows.select("page_id", "tokens"), labels)
        hit = {tuple(r.tokens) for r in url_filters.match_rules(rows, rules).collect()}
        # judged by the url, whatever the page_id
        assert [tuple(r.tokens) in hit for r in rows.collect()] == [k < 20 for k in range(200)]
    verdicts = [r.verdict for r in url_filters.judge_urls(labelled, labels).orderBy("page_id").collect()]
    assert verdicts == ["block"] * 20 + ["allow"] * 180


def test_words_of_a_text_do_not_depend_on_its_neighbours():
    """Hashes of a column equal those of each text alone, also over the chunk size."""
    texts = ["a b", "c", None, "", " d ", "ef" * 10, "g h i " * 400_000, "x"]
    table = lambda xs: {first + r: h[off[r] : off[r + 1]].tolist() for first, off, h, _ in common.word_hashes(pa.array(xs, pa.string()), common.blank_table(), common.fold_table()) for r in range(len(off) - 1)}
    whole = table(texts)
    for k, x in enumerate(texts):
        assert whole[k] == table([x])[0], k
    assert len(whole[6]) == 1_200_000


@pytest.mark.parametrize(
    ("body", "expected"),
    [
        ("<p title=it's>First.</p><p>Second.</p><p>Third, it's the last.</p>", "First.\n\nSecond.\n\nThird, it's the last."),
        ("<p title='a>b' class=\"x>y\" data=>First.</p><p \"x>Second.</p>", "First.\n\nSecond."),
        ("<p class='share-price'>Price.</p><div class='side-effects'>Effects.</div><p id=ad-hoc>Hoc.</p>", "Price.\n\nEffects.\n\nHoc."),
        ("<p>Text.</p><div class='sidebar-left'>x</div><div class='main-nav'>x</div><div id='comment-list'>x</div><p class='b nav'>x</p>", "Text."),
        ("<p>Text.</p><p aria-hidden='true'>x</p><p aria-hidden=false>Seen.</p><p hidden>x</p>", "Text.\n\nSeen."),
        ("<p>" + "word " * 60000 + "</p><p title=" + "'" * 70001 + ">End.</p>", "word " * 59999 + "word\n\nEnd."),
    ],
)
def test_articles_keep_all_their_text(body, expected):
    page = f"<html><body><article>{body}</article><footer>foot</footer></body></html>"
    assert html_extract.extract(page, None) == expected


def test_the_vote_of_the_host_decides(spark):
    """One page's longest container is another one than the host's pages agree on."""
    page = "<body><div class='story'><p>{}</p></div><div class='facts'><p>{}</p></div></body>"
    rows = [(k, "http://a.org/x", page.format(f"Story {k}. " * 30, "Fact.")) for k in range(4)]
    rows += [(9, "http://a.org/y", page.format("Short story.", "Long fact, long fact. " * 20)), (10, "http://b.org/y", page.format("Short story.", "Long fact, long fact. " * 20))]
    out = {r.page_id: r.text for r in html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[9] == "Short story." and out[0] == ("Story 0. " * 30).strip()
    assert out[10].startswith("Long fact")  # alone on its host
