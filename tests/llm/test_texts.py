"""HTML extraction, I-Match, decontamination and mixing against plain versions."""

import hashlib
import random
import re

import duckdb
import pytest

from tillwatch.llm import decontam, html_extract, imatch, mixing
from tillwatch.llm.queries import op1_html_extraction, op5_imatch, op10_decontamination
from tillwatch.llm.textkit import words_of

SF = "/root/testdata/sf0.001"


# HTML extraction

def main_text(page):
    return " ".join(x.text for x in html_extract.lines_of(page))


@pytest.mark.parametrize(("page", "want"), [
    ("", ""),
    ("<p>a<p>b</p>c", "a b c"),
    ("<div>one <b>bo</b>ld<br>two</div>", "one bold two"),
    ("<nav>menu</nav><header>top</header><article><header><h1>T &amp; U</h1></header><p>x&nbsp; \n y&lt;z</p></article><footer>f</footer>", "T & U x y<z"),
    ("<div class='sidebar left'>s</div><p>t</p><div id=comments><p>c</p></div><section class='cookie-notice'>n</section>", "t"),
    ("<div class='loads padding headline'>kept</div>", "kept"),
    ("<form><p>f</p></form><script>var a='<p>';</script><style>p{}</style><!-- c --><p>t", "t"),
    ("<article><p>a</p><aside>b</aside><p>c<nav><a>d</a></nav></article>rest", "a c"),
    ("<article><p>cut off <b>here", "cut off here"),
    ("<p>1 &lt; 2 &am &amp; &#233;</p><p", "1 < 2 &am & é"),
    ("<p>a</p></article></div><p>b</p>", "a b"),
    ("<html><head><title>t</title><body><p>article text</p></body></html>", "article text"),
    ("<head class=nav><meta name=a><title>a < b</title><link rel=x><style>s{}</style><p>no body tag", "no body tag"),
    ("<html><head><title>t</title><script>s</script></head><body>b</body></html>", "b"),
    ("<head><title>never closed<body><p>text", "text"),
    ("<main><div role=navigation>n</div><p hidden>h</p><p>k</p></main>", "k"),
    ("<p>a</p><svg class='i'/><p>b</p>", "a b"),
    ("<p>a</p><iframe src='x'/><p>b</p><iframe>c</iframe>", "a b"),
    ("<div><select><option>o<option>p</div><p>after</p>", "after"),
    ("<body><form id=aspnetForm><nav>n</nav><p>the text of the whole page</p><div class=siteFooter>f</div></form></body>", "the text of the whole page"),
    ("<div class='article related-topic'><p>A long article about it.</p></div><div class=commentList><p>c</p></div>", "A long article about it."),
    ("<main><article><p>post</p></article><article class=comment><p>reader</p></article></main>", "post"),
    ("<p title='a > b'>x</p><a \"<p>y</p>", "x y"),
])
def test_main_text(page, want):
    assert main_text(page) == want


def test_time_is_linear():
    import time

    for page in ('<a "' * 250_000, "<a '\"" * 150_000 + ">", "<div>" * 150_000 + "</p>" * 150_000, "<" * 1_000_000, "<a " * 300_000, "<!-" * 300_000):
        start = time.perf_counter()
        html_extract.lines_of(page)
        assert time.perf_counter() - start < 3


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.choice("abcde") for _ in range(rng.randrange(9))] for _ in range(2))
        shared = sorted(html_extract.shared_lines(a, b))
        rest = iter(b)
        assert len(shared) == longest(a, b) and all(a[k] in rest for k in shared)


def extracted(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in html_extract.extract(pages).collect()}


def test_template_lines_of_the_nearest_page_go(spark):
    page = "<body><div>Site title</div><p>{0}</p><p>Call us</p></body>"
    rows = [(1, "http://a.org/news/1", page.format("first")), (2, "http://www.A.org/news/2#x", page.format("second")),
            (3, "http://b.org/1", page.format("alone")), (4, None, page.format("no url")), (5, "http://c.org/1", None),
            (6, "http://d.org/1", page.format("copy")), (7, "http://d.org/2", page.format("copy"))]
    got = extracted(spark, rows)
    assert got[1] == "first" and got[2] == "second"
    assert got[3] == "Site title alone Call us" and got[4] == "Site title no url Call us" and got[5] == ""
    assert got[6] == got[7] == "Site title copy Call us"


def test_shared_lines_of_articles_stay_but_link_lines_go(spark):
    page = "<article><p>{0}</p><p>A motto.</p><p><a href='/'>Read more</a></p></article>"
    got = extracted(spark, [(k, f"http://a.org/{k}", page.format(f"text {k}")) for k in range(3)])
    assert got == {k: f"text {k} A motto." for k in range(3)}


def test_pages_whose_lines_all_stay_are_aligned_too(spark):
    page = "<article><p>text {0}</p><p>A motto.</p><p>end {0}</p></article>"
    rows = [("a.org", f"/{k}", f"http://a.org/{k}", page.format(k)) for k in range(3)]
    pages = spark.createDataFrame(rows, "host string, path string, u string, h string")
    found = html_extract.deletions(html_extract.ordered_classes(pages)).collect()
    assert [list(r["gone"]) for r in found] == [[1]] * 3
    assert extracted(spark, [(k, r[2], r[3]) for k, r in enumerate(rows)]) == {k: f"text {k} A motto. end {k}" for k in range(3)}


def section_pages(sections, each=10):
    page = "<body><div>Site</div><div>Section {0}</div><p>Text {0} {1}</p></body>"
    return [(s * each + k, f"http://hot.org/{s:04d}/{k}", page.format(s, k)) for s in range(sections) for k in range(each)]


@pytest.mark.parametrize("block", [7, 64, 1024])
def test_section_lines_go_on_hosts_of_any_size(spark, monkeypatch, block):
    monkeypatch.setattr(html_extract, "BLOCK", block)
    rows = section_pages(120)
    got = extracted(spark, [*rows, (9999, "x", "<p>" + "long " * 50000)])
    assert all(got[i] == f"Text {i // 10} {i % 10}" for i, _, _ in rows)


@pytest.mark.parametrize("copies", [2, 3, 200])
def test_copies_have_one_text_and_are_no_template(spark, copies):
    page = "<body><div>Site title</div><p>{0}</p><p>Call us</p></body>"
    rows = [(0, "http://d.org/a", page.format("first")), (9000, "http://d.org/z", page.format("last"))]
    rows += [(k + 1, f"http://d.org/copy/{k}", page.format("copy")) for k in range(copies)]
    got = extracted(spark, rows)
    assert got.pop(0) == "first" and got.pop(9000) == "last" and set(got.values()) == {"copy"}


def test_near_copies_keep_their_body(spark):
    body = "".join(f"<p>Sentence {k} of the text.</p>" for k in range(20))
    page = "<body><div>Site title</div><p>{0}</p>{1}<p>Call us</p></body>"
    rows = [(k, f"http://d.org/n/{k}", page.format(f"On day {k}", body)) for k in range(3)]
    rows += [(7, "http://d.org/other", page.format("Else", "<p>entirely</p>"))]
    got = extracted(spark, rows)
    text = " ".join(f"Sentence {k} of the text." for k in range(20))
    assert got == {0: f"On day 0 {text}", 1: f"On day 1 {text}", 2: f"On day 2 {text}", 7: "Else entirely"}


def test_many_pages_without_url_are_extracted_alone(spark):
    rows = [(k, None if k % 2 else "", f"<div>Top</div><p>{k}</p>") for k in range(3000)]
    got = extracted(spark, rows)
    assert all(got[k] == f"Top {k}" for k in range(1, 3000, 2)) and all(got[k] == str(k) for k in range(0, 3000, 2))


def plain_texts(rows):
    """The operator's rule without Spark: classes by host, all neighbours compared."""
    pages = {i: html_extract.lines_of(h or "") for i, _, h in rows}
    reps = {}
    for i, u, _ in rows:
        host, path = u.split("/", 3)[2], "/" + u.split("/", 3)[3]
        c = html_extract.line_class(pages[i])
        if pages[i]:
            reps.setdefault(host, {}).setdefault(c, []).append((path, i))
    out = {}
    for i, u, _ in rows:
        host, page = u.split("/", 3)[2], pages[i]
        order = sorted((min(v), c) for c, v in reps.get(host, {}).items())
        order = [(path, rep, c) for (path, rep), c in sorted(order, key=lambda x: (x[0][0], x[1]))]
        gone = set()
        if page:
            at = next(k for k, o in enumerate(order) if o[2] == html_extract.line_class(page))
            path = order[at][0]
            others = [k for k in range(len(order)) if k != at and abs(k - at) <= html_extract.REACH]
            # both sides fall away from the page; the larger prefix first, then the nearer place, then the earlier one
            reach = {k: min(html_extract.nearness(path, order[n][0]) for n in (range(k, at) if k < at else range(at + 1, k + 1))) for k in others}
            ranked = sorted(others, key=lambda k: (-reach[k], k > at, abs(k - at)))
            as_page = [([x.text for x in pages[o[1]]], [not x.links and not x.inside for x in pages[o[1]]]) for o in order]
            gone = html_extract.shared_with_nearest(as_page[at], [as_page[k] for k in ranked])
        out[i] = " ".join(x.text for k, x in enumerate(page) if k not in gone or (x.inside and not x.links))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_differencing_equals_the_plain_rule(spark, monkeypatch, seed):
    monkeypatch.setattr(html_extract, "BLOCK", 16)
    rng = random.Random(seed)
    rows = []
    for k in range(250):
        host = rng.choice(["a.org", "a.org", "a.org", "b.org", f"c{k % 9}.org"])
        path = f"{rng.choice('xyz')}/{rng.choice('pq')}{rng.randrange(20)}/{rng.randrange(40)}"
        lines = [f"<p>{rng.choice('ABCDEFGH')}</p>" for _ in range(rng.randrange(6))] + rng.choice([[], ["<p><a>More</a></p>"]])
        if rng.random() < 0.4:
            lines = ["<article>", *lines, f"<p>{rng.randrange(5)}</p>", "</article>"]
        rows.append((k, f"http://{host}/{path}", "".join(lines)))
    assert extracted(spark, rows) == plain_texts(rows)


def test_pages_empty_and_clashing(spark):
    assert extracted(spark, []) == {}
    pages = spark.createDataFrame([(1, "u", "<p>a", "x", 1), (1, "u", "<p>a", "x", 1)], "page_id long, url string, html string, Text string, host int")
    assert [r.text for r in html_extract.extract(pages).collect()] == ["a", "a"]


def test_query_extracts_the_articles(spark):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op1_html_extraction(spark, SF).collect()
    assert {r.page_id for r in rows} == set(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id], re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article)).split()) and r.n_chars == len(r.text)


# I-Match

def test_edited_texts_and_likeness(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(texts, reverse=True)
    rows = {r.doc_id: r for r in op5_imatch(spark, SF).collect()}
    assert set(rows) == set(texts)
    same = {}
    for k, i in enumerate(ids):
        own, following = texts[i], texts[ids[(k + 1) % len(ids)]]
        third = len(own) // 3
        edited = own[:len(own) - third] + following[:third]
        assert rows[i].n_chars == len(own) and rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert same.setdefault(own, rows[i].fingerprint) == rows[i].fingerprint
    near = sorted(r.near_edited for r in rows.values())
    apart = sorted(r.near_next for r in rows.values())
    assert near[len(near) // 4] > 0.15 and apart[len(apart) * 3 // 4] < 0.1


def plain_lexicon(texts, low, high):
    from collections import Counter

    count = Counter(w for t in texts for w in {x for x in re.split(r"[\s!-/:-@\[-`{-~]+", t.lower()) if x})
    return {w for w, n in count.items() if max(2, low * len(texts)) <= n <= max(2, high * len(texts))}


def test_lexicon_is_the_band(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    want = plain_lexicon(texts, 0.02, 0.2)
    from pyspark.sql import functions as F

    hashes = {r[0] for r in spark.createDataFrame([(w,) for w in want], "w string").select(F.xxhash64("w")).collect()}
    assert {r.term for r in imatch.lexicon(docs, "text", 0.02, 0.2).collect()} == hashes


def test_imatch_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "alpha beta gamma"), (3, "alpha beta gamma"), (4, "beta Alpha, gamma gamma"), (None, "alpha beta"),
            (9, "word " * 60000), (3, "delta")]
    docs = spark.createDataFrame([(*r, 0, "z") for r in rows], "doc_id long, text string, row int, Term string")
    got = imatch.compare(docs).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].n_chars == by[2][0].n_chars == 0 and by[1][0].fingerprint == by[2][0].fingerprint
    assert by[1][0].edited_sha256 == hashlib.sha256(b"").hexdigest() and by[1][0].near_edited == 1.0
    assert len(by[3]) == 3 and len({r.fingerprint for r in by[3]}) == 2
    assert by[4][0].fingerprint in {r.fingerprint for r in by[3]}  # the same distinct terms
    assert by[None][0].near_next == 0.0
    assert by[3][0].n_chars and all(0 <= r.near_edited <= 1 for r in got)
    assert imatch.compare(docs.limit(0)).count() == 0


def test_edits_of_a_text_that_a_third_of_the_rows_copy(spark):
    import random

    rng = random.Random(5)
    def prose():
        return " ".join(f"w{int(rng.paretovariate(0.6)) % 3000}" for _ in range(120))

    copied = " ".join(f"own{n}" for n in range(120))
    texts = [copied if n % 3 == 0 else prose() for n in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = imatch.compare(docs).collect()
    copies = [r for r in rows if r.doc_id % 3 == 0]
    assert len({r.fingerprint for r in copies}) == 1
    assert sum(r.near_edited for r in copies) / len(copies) > 0.25 and min(r.near_edited for r in copies) > 0
    assert sum(r.near_next for r in rows) / len(rows) < 0.15


def plain_two_levels(terms, hashes):
    """What a plain reading of the module's text gives for a set of hashed terms."""
    import math

    level = max(0, math.ceil(math.log2(max(len(terms), 1) / (2 * imatch.SUBSETS)) / 2))
    parts = [str(level)]
    for size in (imatch.SUBSETS * 4 ** level, imatch.SUBSETS * 4 ** (level + 1)):
        subsets = [sorted(t for t in terms if t % size == s) for s in range(imatch.SUBSETS)]
        parts.append(".".join(hashes(tuple(s)) if s else "-" for s in subsets))
    return "|".join(parts)


def test_fingerprints_equal_a_plain_computation(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(10**9 + n, f"only{n} here{n} {'the ' * n}") for n in range(3)], docs.schema))
    texts = {r.doc_id: r.text for r in docs.collect()}
    words = {i: {w for w in re.split(r"[\s!-/:-@\[-`{-~]+", t.lower()) if w} for i, t in texts.items()}
    vocabulary = sorted(set().union(*words.values()))
    code = {r.w: r.h for r in spark.createDataFrame([(w,) for w in vocabulary], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    lexicon = {code[w] for w in plain_lexicon(texts.values(), 0.0005, 0.1)}
    wanted = set()

    def plain(i, hashes):
        every = {code[w] for w in words[i]}
        known = every & lexicon
        first = plain_two_levels(known, hashes) if known else "w|" + hashes(("whole", *sorted(every)))
        return first + ("~" + plain_two_levels(every, hashes) if len(known) * imatch.FEW < len(every) else "")

    for i in texts:  # which sets are hashed
        plain(i, lambda s: wanted.add(s) or "")
    sets = spark.createDataFrame([([str(x) for x in s],) for s in wanted], "s array<string>")
    value = F.xxhash64(F.transform(F.expr("filter(s, x -> x <> 'whole')"), lambda x: x.cast("long")))
    known = {tuple(r.s): r for r in sets.select(
        "s", F.lpad(F.lower(F.hex(F.pmod(value, F.lit(65536)))), 4, "0").alias("short"), F.hex(value).alias("long")).collect()}

    def hashes(s):
        row = known[tuple(str(x) for x in s)]
        return row.long if s[0] == "whole" else row.short

    got = {r.doc_id: r.fingerprint for r in imatch.compare(docs).collect()}
    assert got == {i: plain(i, hashes) for i in texts}
    assert any("~" in f for f in got.values()) and any("~" not in f for f in got.values())


def test_likeness_at_neighbouring_levels(spark):
    from pyspark.sql import functions as F

    rows = [("1|a.-|b.-", "1|a.c|b.-", 0.5), ("0|x.x|a.-", "1|a.c|b.b", 0.5), ("0|a.a|a.a", "2|a.a|a.a", 0.0), ("w|AA", "w|AA", 1.0),
            ("w|AA", "w|AB", 0.0), ("w|AA", "0|a.a|a.a", 0.0), (None, "w|A", 0.0), ("0|-.-|-.-", "0|-.-|-.a", 0.0),
            ("w|A~0|a.b|-.-", "0|x.x|-.-~0|a.c|-.-", 0.5), ("w|A~0|a.b|-.-", "0|a.b|-.-", 0.0), ("0|a.b|-.-~0|x.x|-.-", "0|a.c|-.-", 0.5)]
    df = spark.createDataFrame(rows, "a string, b string, want double")
    assert all(r.got == r.want for r in df.withColumn("got", imatch.likeness(F.col("a"), F.col("b"))).collect())


# Decontamination

def test_common_subsequence_equals_the_table():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(1, 12))] for _ in range(2))
        one, other = (words_of([" ".join(x).encode()]).words() for x in (a, b))
        assert decontam.common_subsequence(decontam.bits_of(one), len(one), other) == longest(a, b)


def noise(rng, n):
    return " ".join(f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.randrange(900)}" for _ in range(n))


def test_passages_paraphrases_and_clean_texts(spark):
    rng = random.Random(11)
    items = [(k, noise(rng, rng.randrange(15, 60))) for k in range(40)] + [(None, "x y"), (77, None), (78, "")]
    docs, want = [], {}
    for k in range(120):
        text = noise(rng, rng.randrange(0, 300))
        if k % 3 == 0:
            item, passage = items[k % 40]
            words = passage.split()
            if k % 2:  # every tenth word replaced, shouted and with marks
                words = [w if n % 10 else "other" for n, w in enumerate(words)]
                passage = "!! ".join(words).upper()
            text = text + "\n" + passage + " " + noise(rng, rng.randrange(0, 200))
            want[k] = [item]
        docs.append((k, text, 0))
    docs += [(500, None, 0), (501, "", 0), (501, "", 0), (None, items[3][1], 0), (502, noise(rng, 40000) + " " + items[4][1], 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, Items int")
    got = decontam.decontaminate(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(got) == len(docs)
    assert {r.doc_id: r["_items"] for r in got if r["_items"]} == {**want, None: [3], 502: [4]}
    # smaller blocks of items find the same
    few = decontam.decontaminate(df, spark.createDataFrame(items, "item_id long, text string"), block_items=9).collect()
    assert {r.doc_id: r["_items"] for r in few} == {r.doc_id: r["_items"] for r in got}


def test_a_passage_in_a_third_of_the_rows_is_found(spark):
    rng = random.Random(12)
    items = [(k, noise(rng, 30)) for k in range(20)]
    docs = [(k, noise(rng, 80) + (" " + items[7][1] if k % 3 == 0 else "") + " " + noise(rng, 80)) for k in range(150)]
    got = decontam.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"),
                                 spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: r["items"] for r in got} == {k: [7] if k % 3 == 0 else [] for k in range(150)}


@pytest.mark.parametrize("size", [200, 1500])
def test_large_benchmarks_lose_no_item(spark, size):
    rng = random.Random(13)
    vocabulary = [f"{rng.choice('bcdfgh')}{k}" for k in range(4000)]
    weights = [1 / (k + 5) for k in range(4000)]
    items = [rng.choices(vocabulary, weights, k=rng.randrange(15, 60)) for _ in range(size)]
    docs, want = [], {}
    for k in range(100):
        item = k * size // 100
        passage = [w if k % 2 or n % 10 else "other" for n, w in enumerate(items[item])]  # every other one paraphrased
        text = rng.choices(vocabulary, weights, k=100) + passage + rng.choices(vocabulary, weights, k=100)
        docs.append((k, " ".join(text)))
        want[k] = {n for n, own in enumerate(items) if longest_share(own, text) >= 0.7}
        assert item in want[k]
    got = decontam.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(
        [(n, " ".join(own)) for n, own in enumerate(items)], "item_id long, text string"), share_with_answer=0.7).collect()
    assert {r.doc_id: set(r["items"]) & want[r.doc_id] for r in got} == want


@pytest.mark.parametrize("size", [40, 400])
def test_recall_of_paraphrases_with_the_answer(spark, size):
    """Of 120 paraphrases with half or more of the words in order and the answer, nine in ten are found at least."""
    rng = random.Random(size)
    vocabulary = [f"{rng.choice('bcdfgh')}{k}" for k in range(4000)]
    weights = [1 / (k + 5) for k in range(4000)]
    items = [rng.choices(vocabulary, weights, k=rng.randrange(20, 60)) for _ in range(size)]
    docs, want = [], {}
    for k in range(120):
        own = items[k % size]
        kept = set(rng.sample(range(len(own) - 5), round(rng.uniform(0.55, 0.68) * len(own)) - 5))
        passage = [w if n in kept or n >= len(own) - 5 else rng.choices(vocabulary, weights)[0] for n, w in enumerate(own)]
        docs.append((k, " ".join([*rng.choices(vocabulary, weights, k=150), *passage, *rng.choices(vocabulary, weights, k=150)])))
        assert longest(own, passage) >= len(own) / 2
        want[k] = k % size
    bench = spark.createDataFrame([(n, " ".join(own)) for n, own in enumerate(items)], "item_id long, text string")
    got = {r.doc_id: r["items"] for r in decontam.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert sum(want[k] in got[k] for k in want) >= 0.9 * len(want)


@pytest.mark.parametrize("block_items", [128, 7])
def test_long_items_are_found(spark, block_items):
    rng = random.Random(14)
    items = [(k, noise(rng, n)) for k, n in enumerate([300, 2000, 700, 64, 65, 20] * 2)]
    docs, want = [], {}
    for k in range(48):
        words = items[k % 12][1].split()
        passage = [w if k % 2 or n % 10 else "other" for n, w in enumerate(words)]
        docs.append((k, " ".join([noise(rng, 90), *passage, noise(rng, 90)])))
        want[k] = [k % 12]
    got = decontam.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"),
                                 spark.createDataFrame(items, "item_id long, text string"), block_items=block_items).collect()
    assert {r.doc_id: r["items"] for r in got} == want


def longest_share(item, words):
    """The largest share of the item in order in any stretch of three times its length."""
    masks, n = {}, len(item)
    for k, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << k
    if len(set(item) & set(words)) < 0.7 * len(set(item)) * 0.7:
        return 0.0
    return max(decontam.common_subsequence(masks, n, Stretch(words[a:a + 2 * n])) for a in range(0, len(words), n)) / n


class Stretch(list):
    def tolist(self):
        return self


@pytest.mark.parametrize("block_items", [128, 6])
def test_the_bound_leaves_out_nothing_that_the_search_confirms(spark, monkeypatch, block_items):
    rng = random.Random(15)
    vocabulary = [f"{rng.choice('bcdfgh')}{k}" for k in range(300)]
    weights = [1 / (k + 2) for k in range(300)]
    items = [rng.choices(vocabulary, weights, k=n) for n in [1, 2, 3, 4, 5, 6, 9, 63, 64, 65, 150, 400] + [rng.randrange(15, 60) for _ in range(28)]]
    items += [items[9], ["same"] * 20]
    texts = [[], ["same"] * 15]
    for k in range(90):
        own = items[k % len(items)]
        kept = [w for w in own if rng.random() < rng.choice((0.5, 0.72, 0.9))] + own[-5:] * (k % 2)
        texts.append(rng.choices(vocabulary, weights, k=rng.choice((0, 100, 900))) + kept + rng.choices(vocabulary, weights, k=rng.choice((0, 40, 1500))))
    indexes, fit = [], decontam.fit
    monkeypatch.setattr(decontam, "fit", lambda *args, **options: indexes.append(fit(*args, **options)) or indexes[-1])
    got = decontam.decontaminate(spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1), spark.createDataFrame(
        [(n, " ".join(own)) for n, own in enumerate(items)], "item_id long, text string"), block_items=block_items).collect()
    want = []
    for _, part in decontam.pieces([decontam.pd.DataFrame({"text": [" ".join(t) for t in texts]})], "text", 1 << 18):
        every = [{} for _ in part]
        for index in indexes:
            for own, more in zip(every, decontam.leaks(index, part), strict=True):
                for item, share in more.items():
                    own[item] = max(own.get(item, 0.0), share)
        want += every
    assert {r.doc_id: (r["items"], r["share"]) for r in got} == {k: (sorted(w), max(w.values(), default=0.0)) for k, w in enumerate(want)}
    assert sum(map(len, want)) > 100


def test_few_texts_could_hold_an_item():
    rng = random.Random(16)
    vocabulary = [f"{rng.choice('bcdfgh')}{k}" for k in range(4000)]
    weights = [1 / (k + 5) for k in range(4000)]
    items = [rng.choices(vocabulary, weights, k=rng.randrange(15, 60)) for _ in range(150)]
    texts = [rng.choices(vocabulary, weights, k=100) + (items[k] if k % 20 == 0 else []) + rng.choices(vocabulary, weights, k=100) for k in range(150)]
    words = [words_of([" ".join(own).encode()], decontam.IS_BREAK).words() for own in items]
    terms = decontam.np.unique(decontam.np.concatenate(words))
    found = words_of([" ".join(t).encode() for t in texts], decontam.IS_BREAK)
    place = decontam.np.searchsorted(terms, found.words()).clip(max=len(terms) - 1)
    known = terms[place] == found.words()
    pairs = decontam.np.unique(found.text_of()[known] * len(terms) + place[known])
    weights = decontam.idf(decontam.np.bincount(pairs % len(terms), minlength=len(terms)), 150)
    pairs = decontam.Screen(list(range(150)), words, (terms, weights))(found).tolist()
    assert {(k, k) for k in range(0, 150, 20)} <= set(map(tuple, pairs)) and len(pairs) < 30  # of 22,500


def test_decontamination_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r["items"] for r in decontam.decontaminate(docs, none).collect()] == [[]]
    some = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    assert decontam.decontaminate(docs.limit(0), some).count() == 0


def test_query_finds_all_verbatim_items(spark):
    items = {r.item_id: " ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    texts = {r.doc_id: " ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in op10_decontamination(spark, SF).collect()}
    assert set(rows) == set(texts)
    for i, text in texts.items():
        assert {k for k, item in items.items() if item in text} <= set(rows[i]["items"])
        assert rows[i].leaked == bool(rows[i]["items"])


# Mixing

def mixed(spark, rows, **options):
    return mixing.plan(spark.createDataFrame(rows, "doc_id long, text string, source string"), **options)


def corpus(seed=6):
    rng = random.Random(seed)
    return [(k, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(0, 60))), rng.choice("aaaaaaaaaabbc")) for k in range(600)]


def test_plan_equals_its_sql(spark):
    rows = corpus() + [(5000, None, "a"), (5001, "", "empty"), (None, "x y", None), (None, "x y", None), (5002, "x " * 90000, "b")]
    got = sorted(map(tuple, mixed(spark, rows).collect()), key=str)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    assert got == sorted(con.execute(mixing.PLAN_SQL).fetchall(), key=str)


def test_budgets_and_repetitions(spark):
    rows = corpus()
    tokens = {}
    for _, text, source in rows:
        tokens[source] = tokens.get(source, 0) + len(text.split())
    total = sum(tokens.values())
    used = {r.source: r.used for r in mixed(spark, rows, entropy_share=None, repeat_limit=100, budget=3000, block_tokens=200)
            .groupBy("source").agg({"tokens": "sum"}).withColumnRenamed("sum(tokens)", "used").collect()}
    assert all(1000 <= n < 1100 for n in used.values())  # equal thirds, ended by a whole document
    limited = mixed(spark, rows, entropy_share=None, repeat_limit=2.0).collect()
    epochs = {}
    for r in limited:
        epochs[r.source] = max(epochs.get(r.source, 0), r.epoch + 1)
    assert max(epochs.values()) == 2 and {r.doc_id for r in limited} == {i for i, _, _ in rows}
    kept = mixed(spark, rows, entropy_share=0.0, repeat_limit=9.0, budget=total).collect()
    assert len(kept) == len(rows)  # the natural shares use everything once


def test_running_sums_in_two_levels(spark):
    rng = random.Random(4)
    rows = [("s", b, rng.randrange(1 << 60), 400, rng.randrange(1, 9)) for b in range(400)] + [(None, 0, 5, 1, 3)]
    df = spark.createDataFrame(rows, "src string, block long, block_key long, blocks long, tokens long")
    got = {(r.src, r.block): r.before for r in mixing.blocks_before(df, per_group=16).collect()}
    at = 0
    for _, block, _, _, n in sorted(rows[:-1], key=lambda r: r[2]):
        assert got[("s", block)] == at
        at += n
    assert got[(None, 0)] == 0


def test_mixing_of_empty_and_blank_tables(spark):
    assert mixed(spark, []).count() == 0
    blank = mixed(spark, [(1, None, "a"), (2, " ", None)]).collect()
    assert sorted((r.doc_id, r.epoch, r.tokens) for r in blank) == [(1, 0, 0), (2, 0, 0)]
    docs = spark.createDataFrame([(1, "x", "a", 9)], "doc_id long, text string, source string, Tokens int")
    assert [r.tokens for r in mixing.plan(docs).collect()] == [1]
