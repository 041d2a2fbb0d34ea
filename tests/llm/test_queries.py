"""The registered queries against plain Python on the small tables, and on rows that are odd."""

import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from reviewloom.llm import (
    chat_format, embedding_dedup, html_extract, minhash_dedup, mixing, packing, quality_rules, queries, sharding, url_filter, warc,
)
from reviewloom.llm.queries import CHAT_TOKENIZER, QUERIES, TOKENIZER, URL_RULES
from reviewloom.session import materialize

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i}" for i in range(30_000))
BODY = " ".join(f"word{i}" for i in range(60))
#: doc_id, text, lang, source, n_chars, and a column that operators use themselves.
ODD = [
    (1, BODY, "en", "a", 1, "x"), (2, BODY, "en", "a", 1, "x"), (3, BODY.upper(), "en", "b", 1, "x"),
    (4, BODY + " more words here", "en", "b", 1, None), (5, None, "en", "a", None, "x"), (6, "", "en", None, 0, "x"),
    (7, " \n\t ", None, None, 3, "x"), (8, "one two", "en", "c", 7, "x"), (9, "One  TWO", "en", "c", 8, "x"),
    (10, LONG, "en", "c", len(LONG), "x"), (11, LONG + " tail", "en", "c", 1, "x"), (12, "é ß 你好 " + BODY, "en", "é", 1, "x"),
    (13, "same words " * 40, "en", "a", 1, "x"), (None, "nobody's words", "en", "a", 1, "x"), (None, None, None, None, None, None),
]
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD + [ODD[3]], ODD_SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


# 1 and 2: near duplicates

def test_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 24))
    rows = [(i, [float(x) for x in np.float32(base[i % 40] + (i >= 40) * rng.normal(size=24) * 0.1)], i % 2) for i in range(160)]
    nan, inf = float("nan"), float("inf")
    rows += [(200, None, 1), (201, [0.0] * 24, 1), (202, [nan] * 24, 1), (203, [inf] * 24, 1), (204, rows[0][1], None),
             (205, [None] + rows[0][1][1:], 0), (206, rows[0][1], 0), (207, rows[0][1], 0), (208, [2 * x for x in rows[0][1]], 0),
             (209, [1.0], 0), (210, [3.0], 0), (211, [-1.0], 0), (212, [], 0), (213, [0.0, 1.0], 0), (214, [-0.0, 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("node", F.lit("clash"))
    want = brute.near_vectors([tuple(r)[:3] for r in df.collect()])
    got = embedding_dedup.near_duplicates(df, block=16).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got) and len(got) == len(rows)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_vectors_that_repeat(spark):
    df = spark.createDataFrame([(7, [1.0, 0.5], 1), (7, [1.0, 0.5], 1), (None, [1.0, 0.5], 1)], "vec_id long, embedding array<double>, label int")
    assert sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df).collect()) == [
        (0, 2, 7, False), (7, 2, 7, True), (7, 2, 7, True)]


def test_documents(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = QUERIES["op2_minhash_dedup"](spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_documents(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_odd_documents(odd, none):
    got = minhash_dedup.near_duplicates(odd).collect()
    want = brute.near_documents([(r[0], r[1]) for r in ODD if r[0] is not None])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in [*ODD, ODD[3]])
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert minhash_dedup.near_duplicates(none).count() == 0
    left = minhash_dedup.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter({r.doc_id: 1 + (r.doc_id is None) for r in got if r.kept})
    assert minhash_dedup.drop_near_duplicates(none).count() == 0


def test_texts_that_share_an_id(spark):
    """Of each group one text stays, however the ids of different groups repeat or lack."""
    a, b, c, d, e = (" ".join(f"{x}{k}" for k in range(30)) for x in "abcde")
    rows = [(None, a), (None, b), (None, a), (5, c), (5, d), (3, d), (7, e), (7, e + " tail"), (8, c), (9, ""), (9, "")]
    left = minhash_dedup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = Counter((r.doc_id, r.text) for r in left)
    assert got.pop((7, e), 0) + got.pop((7, e + " tail"), 0) == 1
    assert got == Counter([(None, a), (None, b), (5, c), (3, d), (9, "")])


def test_large_cluster_in_blocks(spark, monkeypatch):
    """A family of near copies, some linked and some not, cut into many blocks and hot buckets."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(240):
        own = list(words)
        for at in rng.integers(0, 150, int(rng.integers(0, 9))):
            own[at] = f"x{i}y{at}"
        rows.append((i, " ".join(own)))
    want = brute.near_documents(rows)
    assert 20 < len({c for _, c in want.values()}) < 230
    monkeypatch.setattr(minhash_dedup, "BLOCK_SETS", 30)
    monkeypatch.setattr(minhash_dedup, "BUCKET", 50)
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_all_signatures_under_the_distance_share_a_key(spark):
    """Pigeonhole: any 15 of 32 symbols may differ."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(200):
        a = rng.integers(0, 1 << 16, 32).astype(np.uint16)
        b = a.copy()
        b[rng.choice(32, 15, replace=False)] ^= 1
        rows.append((i, a.view(np.int64).tolist(), b.view(np.int64).tolist()))
    df = spark.createDataFrame(rows, "i int, a array<long>, b array<long>")
    met = df.select(F.arrays_overlap(F.array(*minhash_dedup.chunk_keys("a")), F.array(*minhash_dedup.chunk_keys("b"))).alias("m"))
    assert met.filter("m").count() == 200


# 3: urls

def test_urls(spark):
    urls = ["http://a.ORG/es/x", "https://example.org/es/", "http://www.example.org/en/12?q#f", "http://example.org", None, "",
            "nothing", "x://", "://h/p", "http://badorg/", "http://b.com/fr/1", "http://com/de/9", "http://b.com/fr", "http://org/",
            "https://www.listed.net/p/1.html?x=1", "http://m.listed.net/p/1/", "http://listed.net/p/2", "http://a?b/c://org/", "http://é.org/\n"]
    pages = spark.createDataFrame([(i, u, "key") for i, u in enumerate(urls)] + [(0, urls[0], "key"), (None, "http://a.org/", None)],
                                  "page_id long, url string, key string")
    listed = spark.createDataFrame([("http://listed.net/p/1",), (None,), ("http://listed.net/p/1#x",)], "url string")

    def judged(url):
        host, path = brute.url_parts(url)
        fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        if fits:
            return (host, path, *max(fits)[1:])
        return host, path, None, "block" if "listed.net/p/1" in (url or "") else "allow"

    got = url_filter.judge(pages, URL_RULES, listed).collect()
    assert len(got) == len(urls) + 2
    assert all((r.host, r.path, r.rule, r.verdict) == judged(r.url) for r in got)
    assert {r.verdict for r in url_filter.judge(pages, [], listed.limit(0)).collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), URL_RULES, listed).count() == 0


def test_rules_of_long_hosts(spark):
    """A rule's host may have any number of labels."""
    host = ".".join(f"l{i}" for i in range(41)) + ".org"
    pages = spark.createDataFrame([(1, f"http://{host}/x"), (2, f"http://sub.{host}/x"), (3, f"http://{host[3:]}/x")], "page_id long, url string")
    got = url_filter.judge(pages, [("allow", "org", "/"), ("block", host, "/")], pages.limit(0)).collect()
    assert {r.page_id: (r.rule, r.verdict) for r in got} == {1: (f"{host}/", "block"), 2: (f"{host}/", "block"), 3: ("org/", "allow")}


def test_filter_passes_all_that_is_listed(spark, monkeypatch):
    listed = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    keys = spark.range(30_000).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    for limit in (2_000_000, 0):  # broadcast, and joined by a shuffle
        monkeypatch.setattr(url_filter, "BROADCAST_BLOCKS", limit)
        passed = {r.id for r in url_filter.possible_hits(keys, listed).collect()}
        assert set(range(3000)) <= passed and len(passed) < 3000 + 27_000 * 0.01


# 4: sharding

def check_shards(rows, shards):
    places = defaultdict(list)
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None
        places[r.shard].append(r.slot)
        assert r.grown_to in (r.shard, shards)
    assert all(sorted(p) == list(range(len(p))) for p in places.values()) and set(places) <= set(range(shards))


def test_shards(spark, docs):
    got = QUERIES["op4_virtual_slots"](spark, SF).collect()
    check_shards(got, 24)
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {i: (len(t) + 8, zlib.crc32(t)) for i, t in texts.items()}
    assert len(got) == len(texts)


def test_shards_are_even_and_grow_into_the_new_one(spark):
    records = spark.range(40_000).select(F.col("id").alias("doc_id"), (8 + F.col("id") % 5000).alias("size"))
    got = sharding.assign(materialize(records, "test"), 24).toPandas()
    loads = got.groupby("shard")["size"].sum()
    assert loads.max() <= 1.01 * loads.mean() and loads.min() >= 0.99 * loads.mean()
    grown = got.groupby("grown_to")["size"].sum()
    assert len(grown) == 25 and grown.max() <= 1.02 * grown.mean() and grown.min() >= 0.9 * grown.mean()


def test_odd_shards(odd, none):
    for table in (odd, none):
        records = table.drop("size").select("doc_id", sharding.record_bytes().alias("size"), F.lit("bytes").alias("law"),
                                            F.lit(None).alias("grown_shard"))
        got = sharding.assign(materialize(records.withColumn("grown_shard", F.lit(None).cast("int")), "test"), 3).collect()
        assert len(got) == table.count()
        check_shards(got, 3)


# 5: html

def test_pages(spark):
    """The tables' pages mark their article, so a plain cut gives the right text."""
    import html
    import re

    want = {}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        article = r.html[r.html.index("<article>"):r.html.index("</article>")]
        blocks = re.split(r"</?(?:h1|p|br|article)>", article)
        plain = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks)
        want[r.page_id] = "\n".join(b for b in plain if b)
    got = QUERIES["op5_tag_path_ratios"](spark, SF).collect()
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p></p>", ""), ("<!-- only -->", ""), ("plain < text. ok", "plain < text. ok"),
    ("<article>w</article>", "w"),
    ("<header><h1>Site</h1></header><nav><a>Home</a></nav><div class='cookie-notice'>We use cookies, all of them.</div>"
     "<div id=content><h2>Head</h2><p>First, with <a href=x>a link</a> &amp; more. Yes.<p>Second&nbsp;  one.<ul><li>a</li></ul></div>"
     "<aside>side</aside><div class='comments'><p>Great, thanks, really a lot. Yes.</p></div><form>Name</form><footer>c</footer>",
     "Head\nFirst, with a link & more. Yes.\nSecond one.\na"),
    ("<main><script>a('</p>')</script><style>p{}</style><p>x&#233;&lt;b&gt;<b>y</b><br>z<!-- no --></main>", "xé<b>y\nz"),
    ("<article><p>Body text.</p><div class='ad'>Buy, now.</div><section id=comments><p>Me too.</p></section></article>", "Body text."),
    ("<article><p>unclosed <b>bold<p>next</article><p>after it all, and more. Much more.", "unclosed bold\nnext"),
])
def test_page(page, text):
    assert html_extract.main_text(page) == text


@pytest.mark.parametrize("start", [
    "<div class='has-sidebar'>", "<div class='no-sidebar'><div class='content-sidebar-wrap'>", "<div class='page-with-nav'>",
    "<div id='search-results'>", "<form action=x>"])
@pytest.mark.parametrize("mark", ["article", "main", "div"])
def test_named_wrappers(start, mark):
    """A word in the name of what is around the article doesn't delete it; side parts in it stay out."""
    page = (f"{start}<{mark}><h1 class='entry-header'>Head</h1><p class='tracking-wide'>First, with a comma. Yes, really so.</p>"
            f"<p>Second one, longer than the first, and more. Yes.</p></{mark}><div class='sidebar'><p>Side, too.</p></div>"
            "<div class='comments'><article><p>Great, thanks.</p></article></div>")
    assert html_extract.main_text(page) == (
        "Head\nFirst, with a comma. Yes, really so.\nSecond one, longer than the first, and more. Yes.")


def test_main_around_an_article():
    body = "The body, with commas, and long enough. Yes, really so, and again, more of it. Yes."
    items = "<ul><li>a</li><li>b</li><li>c</li><li>d</li></ul>"
    page = (f"<main><h1>Title</h1><h2>Lead.</h2><article>{items}<p>{body}</p>{items}</article>"
            "<h3>Closing.</h3><div class='comments'><article><p>Great.</p></article></div></main><p>Out.</p>")
    assert html_extract.main_text(page) == f"Title\nLead.\na\nb\nc\nd\n{body}\na\nb\nc\nd\nClosing."


def test_odd_pages(spark):
    rows = [(1, None, None, "t"), (None, "u", "<p>a", "t"), (2, "u", "<p>a", "t"), (2, "u", "<p>a", "t"),
            (3, "u", "<article>" + "<p>long words. " * 20_000, "t"), (4, "u", "<div>" * 5000 + "deep", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extract.extract(df).collect()
    assert Counter((r.page_id, len(r.text)) for r in got) == Counter({(1, 0): 1, (None, 1): 1, (2, 1): 2, (3, 12 * 20_000 - 1): 1, (4, 4): 1})
    assert html_extract.extract(df.limit(0)).count() == 0


BROKEN = ["<a", "a<w ", "<a b='", "</x ", '<a ">" ', "<b>x", "<div>x", "<p><b>x", "<script ", "<script></script ", "<!--", "<a b='>",
          "<table><td><b>x", "<ul><li>x", '<div class="nav">x', "&#1"]


@pytest.mark.parametrize("bit", BROKEN)
def test_broken_pages_take_linear_time(bit):
    """A megabyte of tags that never end, quotes that never close, or elements without end."""
    page = bit * ((1 << 20) // len(bit))
    start = time.process_time()
    html_extract.main_text(page)
    html_extract.main_text("<" + "w" * (1 << 20))
    assert time.process_time() - start < 15  # a second or two; it was minutes for a hundredth of it


def test_tags():
    page = "a<b c='>'>x<!-- <i> --><!D>y</B >< z <script>1<2</script><q 'r>s<u v=\"w>t"
    assert [(page[a:z], *rest) for a, z, *rest in html_extract.tags(page)] == [
        ("<b c='>'>", "", "b", " c='>'"), ("<!-- <i> -->", "", "", ""), ("<!D>", "", "", ""), ("</B >", "B", "", ""),
        ("<script>", "", "script", ""), ("</script>", "script", "", ""), ("<q 'r>", "", "q", " 'r"), ('<u v="w>', "", "u", ' v="w')]


# 6: quality

def test_quality_figures(spark):
    texts = [BODY, "a b c d e f g h " * 3, ("x y z " * 30).strip(), "a b c d e f g h\na b c d e f g h\n\n#$%|<>&* é", None, "", "one",
             "\x1c\x0b a\x85b \xa0", " ".join("pqrstuvw") + " tail " + " ".join("pqrstuvw"), LONG]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = df.select("doc_id", F.struct(*quality_rules.base_rules(F.col("text"))).alias("x")).collect()
    assert {r.doc_id: tuple(r.x) for r in got} == {i: brute.base_figures(t) for i, t in enumerate(texts)}


def test_common_lines(spark, none, odd):
    line = "all the pages of this host have this line of a dozen words"
    rows = [(i, f"{line.upper()}  \n{' '.join(f'v{i}w{k}' for k in range(40))}", "h" if i % 3 else None) for i in range(90)]
    rows += [(100 + i, f"{line}\n{line}\nshort {i}\n{line}", "h") for i in range(3)]  # hold little else
    rows += [(200 + i, BODY, "copies") for i in range(60)]  # one document, however often
    rows += [(300, f"{line}\n" + BODY, "other"), (301, None, "h"), (302, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_chars", F.lit(0)).withColumn("line", F.lit(1))
    want = brute.quality(rows)
    assert want[100][-2] > 0 and not want[100][-1] and want[200][-1] and want[1][-1] and want[300][-2] == 0
    got = quality_rules.judge(df).collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.removed_words, r.kept)
            for r in got} == want
    left = quality_rules.clean(df)
    kept = {r.doc_id: r for r in left.collect()}
    assert left.columns == df.columns and set(kept) == {i for i, w in want.items() if w[-1]}
    assert "\n" not in kept[1].text and kept[1].n_chars == len(kept[1].text) and kept[300].text == rows[-3][1]
    for table in (odd, none):
        got = quality_rules.judge(table)
        assert got.count() == table.count() and quality_rules.clean(table).columns == table.columns
    twice = df.unionAll(df)
    assert {r.doc_id: (r.removed_words, r.kept) for r in quality_rules.judge(twice).collect()} == {i: w[-2:] for i, w in want.items()}
    assert quality_rules.clean(twice).count() == 2 * len(kept)


def test_long_lines_of_different_documents(spark):
    """A shared line counts the documents that differ otherwise, also where it is their longest; near copies are one."""
    licence = " ".join(f"licence{k}" for k in range(60))
    rows = [(i, f"{licence}\n{' '.join(f'v{i}w{k}' for k in range(12))}\n{' '.join(f'x{i}y{k}' for k in range(12))}", "h")
            for i in range(30)]
    near = [" ".join(f"line{j}word{k}" for k in range(12)) for j in range(12)]
    rows += [(100 + i, "\n".join(x if j != i % 12 else f"{x} own{i}" for j, x in enumerate(near)), "n") for i in range(60)]
    got = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i].removed_words == 60 and not got[i].kept for i in range(30))
    assert all(got[100 + i].removed_words == 0 and got[100 + i].kept for i in range(60))


@pytest.mark.parametrize("share", [50, 70, 71, 80, 90, 95])
def test_pages_of_mostly_shared_lines(spark, share):
    """However much boilerplate a host's pages hold, it goes, and pages that are little else go with it."""
    shared = [" ".join(f"b{j}w{k}" for k in range(20)) for j in range(4)]
    own = round(8000 / share) - 80
    rows = [(i, "\n".join([*shared, " ".join(f"p{i}w{k}" for k in range(own))]), "h") for i in range(60)]
    got = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {(r.removed_words, r.kept) for r in got} == {(80, 80 <= 0.7 * (80 + own))}


@pytest.mark.parametrize("change", ["edits", "dropped lines", "added words", "exact"])
def test_near_copies_stay(spark, change):
    """A large group of near copies with lines of many lengths does not make its own lines common."""
    rng = random.Random(change)
    base = [[f"b{j}w{k}" for k in range(rng.randint(4, 60))] for j in range(14)]

    def copy(i):
        if change == "edits":
            return [[f"e{i}x{k}" if rng.random() < 0.03 else w for k, w in enumerate(x)] for x in base]
        if change == "dropped lines":
            return [x for x in base if rng.random() < 0.95]
        return [[*x, f"n{i}"] if change == "added words" and rng.random() < 0.3 else x for x in base]

    rows = [(i, "\n".join(" ".join(x) for x in copy(i)), "h") for i in range(200)] + [(900, "\n".join(" ".join(x) for x in base), "h")]
    got = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r.doc_id: (r.removed_words, r.kept) for r in got} == {i: w[-2:] for i, w in brute.quality(rows).items()}
    assert all(r.kept and not r.removed_words for r in got)


@pytest.mark.parametrize("bound", [quality_rules.BROADCAST_ROWS, 0])
def test_quality_of_random_lines(spark, monkeypatch, bound):
    """Few lines over few hosts, with edits, copies and lines of one word, by broadcast and by shuffle."""
    monkeypatch.setattr(quality_rules, "BROADCAST_ROWS", bound)
    rng = random.Random(9)
    pool = [" ".join(f"l{j}w{k}" for k in range(rng.choice((1, 2, 3, 9, 25)))) for j in range(40)]
    rows = []
    for i in range(500):
        lines = rng.sample(pool, rng.randint(0, 6)) + [f"own{i} {' '.join(f'o{i}w{k}' for k in range(rng.randint(0, 30)))}"] * rng.randint(0, 2)
        lines = [x + f" more{i}" if rng.random() < 0.2 else x.upper() if rng.random() < 0.1 else x for x in lines]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), rng.choice(("a", "a", "a", "b", None))))
    rows += [(600 + i, rows[i][1], rows[i % 7][2]) for i in range(60)]
    got = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    want = brute.quality(rows)
    assert {r.doc_id: (r.removed_words, r.kept) for r in got} == {i: w[-2:] for i, w in want.items()}
    assert 50 < sum(w[-2] > 0 for w in want.values())


def test_common_lines_of_a_large_host(spark):
    """The same line in the same number of documents is common on a small host and on a large one."""
    line = "all the pages of this part have this line"
    rows = [(k, f"{line}\n" * (k < 25) + " ".join(f"v{k}w{j}" for j in range(30)), "large") for k in range(600)]
    rows += [(1000 + k, f"{line}\n" + " ".join(f"s{k}w{j}" for j in range(30)), "small") for k in range(25)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id for r in quality_rules.judge(df).filter("removed_words = 9").collect()}
    assert got == {*range(25), *range(1000, 1025)}


# 7: packing

def check_packing(rows, texts, tokenizer, capacity=2048):
    found = defaultdict(list)
    for r in rows:
        found[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    want = {i: [(k, *p) for k, p in enumerate(brute.pieces(t, tokenizer, capacity))] for i, t in texts.items()}
    assert {i: sorted(p) for i, p in found.items()} == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins)


def test_packing(spark, docs, tokenizer):
    got = QUERIES["op7_best_fit_packing"](spark, SF).collect()
    n = check_packing(got, {r.doc_id: r.text for r in docs.collect()}, tokenizer)
    assert n == brute.best_fit([r.length for r in got], 2048)


def test_odd_packing(spark, odd, none, tokenizer):
    texts = {r[0]: r[1] for r in ODD if r[0] is not None}
    texts |= {1000: "<|endoftext|> a <|ENDOFTEXT|>. x<|startoftext|>y,", 1001: "don't I'll Can'T's. 12,345.67 É é.́ ǅ ﬁ İst ΣΑΣ. \"bar\". a\xa0b.c d \x00.",
              1002: "ŉa ĳ ſ. Æ, ²! १२. 你好。世界! ª º 'twas"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    cut = materialize(packing.pieces(df, TOKENIZER), "test")
    packed = packing.pack(cut, group_pieces=4)
    check_packing(packed.withColumn("ids_crc32", F.crc32("ids")).collect(), texts, tokenizer)
    whole = packing.sequences(packed).select(F.octet_length("ids").alias("n")).agg(F.sum("n")).first()[0]
    assert whole == 4 * sum(r.length for r in cut.collect())
    again = packing.pack(materialize(packing.pieces(odd, TOKENIZER).drop("ids"), "test"))
    assert Counter(r.doc_id for r in again.collect() if r.piece == 0) == Counter(r[0] for r in [*ODD, ODD[3]])
    assert packing.pack(materialize(packing.pieces(none, TOKENIZER), "test")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 7, 400])
def test_best_fit(n):
    lengths = np.random.default_rng(n).integers(1, 101, n)
    bins, _ = packing.best_fit_decreasing(lengths, 100)
    assert len(set(bins)) == brute.best_fit(lengths.tolist(), 100)


# 8: chats

def test_chats(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))]
    got = QUERIES["op8_prefix_trees"](spark, SF).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == brute.chats(rows)
    assert len(got) == len({r[0] for r in rows}) and all(r.formatted_chars > r.loss_chars for r in got)


def odd_chats(spark):
    tricky = ["<|end|>\n", "<\\|turn|>", "<", "|", "\\", "<\\\\|", "", None, "<|endoftext|>", "a<|text|>b", "é\u2028\x00\r\n你"]
    rows = [(i, k, role, t) for i, t in enumerate(tricky) for k, role in enumerate(("system<|", "user", "assistant"))]
    rows += [(50 + i, k, "assistant" if k % 2 else "user", f"shared {k}" if k < 4 else f"own {i}") for i in range(40) for k in range(6)]
    rows += [(50, 0, "user", "shared 0"), (None, 1, None, "x"), (99, None, "assistant", LONG), (98, 0, "user", "shared 0")]
    return rows


def test_odd_chats(spark):
    rows = odd_chats(spark)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("content", F.lit(1))
    talks = materialize(chat_format.conversations(df), "test")
    packed = materialize(chat_format.sequences(talks, CHAT_TOKENIZER, tokens=150), "test")
    got = talks.select("conv_id", "content").join(chat_format.read_back(packed, CHAT_TOKENIZER), "content").collect()
    want = brute.chats([(c, -1 if t is None else t, r, x) for c, t, r, x in rows])
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want
    assert chat_format.sequences(chat_format.conversations(df.limit(0)), CHAT_TOKENIZER).count() == 0


def test_trees(spark):
    """Shared turns once; positions go on from the parent; each node attends to its ancestors and itself."""
    df = spark.createDataFrame(odd_chats(spark), "conv_id long, turn long, role string, text string")
    talks = chat_format.conversations(df.filter("conv_id between 51 and 89"))
    trees = chat_format.sequences(talks.coalesce(1), CHAT_TOKENIZER, tokens=100_000).collect()
    assert sum(len(t.leaves) for t in trees) == 39
    for t in trees:
        assert len(t.nodes) == 1 + 4 + 2 * len(t.leaves)
        for k, node in enumerate(t.nodes):
            chain, at = [], k
            while at >= 0:
                chain = [*range(t.nodes[at].start, t.nodes[at].end), *chain]
                at = t.nodes[at].parent
            assert [i for x in t.attention[k] for i in range(x.start, x.end)] == chain
            own = range(node.start, node.end)
            assert [t.position_ids[i] for i in own] == list(range(len(chain) - len(own), len(chain)))
            below = [n for j, n in enumerate(t.nodes) if n.parent == k]
            assert node.subtree_end == max([node.end, *[n.subtree_end for n in below]])


def test_long_shared_beginnings_are_side_by_side(spark):
    """Conversations that part after their 12th turn: each of those turns is emitted once a group and sequence."""
    rows = [(i, k, "user", f"turn {k}" if k < 9 else f"turn {k} of group {i % 20}" if k < 12 else f"own {i}") for i in range(400) for k in range(13)]
    talks = chat_format.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    trees = chat_format.sequences(talks, CHAT_TOKENIZER, tokens=1500).collect()
    emitted = sum(len(t.nodes) for t in trees)
    assert len(trees) > 3 and emitted <= 400 + 3 * (20 + len(trees)) + 10 * len(trees)


def test_long_rows_are_read_a_few_at_a_time(spark, monkeypatch):
    """Sequences by the thousands in a batch took more than an executor's memory."""
    keys, seen = ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch"), {}
    before = [spark.conf.get(k) for k in keys]
    store = lambda df, purpose: (seen.update({purpose: max(int(spark.conf.get(k)) for k in keys)}), materialize(df, purpose))[1]
    monkeypatch.setattr(queries, "materialize", store)
    assert QUERIES["op8_prefix_trees"](spark, SF).count() > 0
    assert seen["sequences"] <= 64 and seen["read-back"] <= 64 and [spark.conf.get(k) for k in keys] == before


# 9: mixing

def check_mix(rows, want_sizes, targets):
    taken = defaultdict(int)
    for r in rows:
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] += r.taken
    assert {r.source: r.source_size for r in rows} == want_sizes
    assert all(abs(r.target - targets[r.source]) < 1e-6 * (1 + targets[r.source]) for r in rows)
    return taken


def test_mix(spark):
    rows = [(i, f"s{i % 100 if i % 7 == 0 else i % 3}", 1 + (i * 7919) % 900) for i in range(6000)] + [(9000, None, 500), (9001, "zero", 0)]
    df = spark.createDataFrame(rows, "doc_id long, source string, words long").withColumn("mix", F.lit("gone"))
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    targets = brute.mix_targets(dict(sizes))
    run = lambda: mixing.mix(df, F.col("words")).select("doc_id", "source", "mix.*").collect()
    got = run()
    taken = check_mix(got, dict(sizes), targets)
    assert all(abs(taken[s] - t) <= 0.02 * t + 1800 for s, t in targets.items())
    assert Counter(got) == Counter(run()) and len(got) == len(rows)
    emitted = Counter(r.doc_id for r in mixing.mixed(df, F.col("words")).collect())
    assert emitted == Counter({r.doc_id: r.copies for r in got if r.copies})


def test_odd_mix(odd, none):
    got = mixing.mix(odd, mixing.n_words())
    assert got.columns == [*odd.columns, "mix"] and got.count() == odd.count()
    check_mix(got.select("source", "mix.*").collect(), *(lambda sizes: (sizes, brute.mix_targets(sizes)))(
        dict(sum((Counter({r[3]: len(brute.WORD.findall(r[1] or ""))}) for r in [*ODD, ODD[3]]), Counter()) | {None: 0})))
    assert mixing.mix(none, mixing.n_words()).count() == 0 and mixing.mixed(odd, mixing.n_words()).columns == odd.columns


# 10: archives

def test_archives(spark):
    big, rows = "<p>" + "x é" * 600, []
    rows += [(i, f"http://h/{i}", big if i % 3 else f"{big}{i}", "payload") for i in range(60)]
    rows += [(100, None, None, "d"), (101, "http://a b\r\nX: y/é", "", "d"), (102, "u", "small", "d"), (103, "u", "small", "d"),
             (None, "u", big, "d"), (7, "http://h/7", big, "d"), (104, "u", LONG * 10, "d")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(3)
    archives = warc.write_archives(warc.with_originals(df), archive_bytes=20_000)
    assert archives.count() >= 4
    got = warc.read_archives(spark, archives).collect()
    facts = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(facts, key=lambda r: (r[0] is None, r[0] or 0, r)) == brute.page_records([(r[0], r[2]) for r in rows])
    texts = {r[0]: (r[2] or "").encode() for r in rows}
    assert all(r.payload == texts[r.page_id] for r in got if r.record_type == "response")
    empty = warc.write_archives(warc.with_originals(df.limit(0)))
    assert warc.read_archives(spark, empty).count() == 0


def test_archive_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()]
    got = QUERIES["op10_warc"](spark, SF).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got)) == brute.page_records(rows)


def test_broken_archives(tmp_path):
    import io

    from pyarrow.fs import LocalFileSystem

    path = str(tmp_path / "a.warc.zst")
    writer = warc.ArchiveWriter(LocalFileSystem(), path)
    good = [warc.page_record(i, "http://h/", b"payload %d " % i * 200, warc.hashlib.sha1(b"payload %d " % i * 200).hexdigest(), None, False)
            for i in range(100)]
    for data in good:
        writer.add(data)
    writer.close()
    data = open(path, "rb").read()
    assert warc.struct.unpack("<I", data[4:8])[0] > 0  # a dictionary was learnt
    assert list(warc.archive_frames(io.BytesIO(data), step=1000)) == good
    for wrong in (data[:-20], b"", data[1:], data[:6]):
        with pytest.raises(ValueError):
            list(warc.archive_frames(io.BytesIO(wrong)))
    record = good[0]
    for wrong in (record[:-1], record + b"x", record.replace(b"WARC/1.1", b"WARC/0.9"), record.replace(b"payload 0", b"payload 1"),
                  record.replace(b"WARC-Date", b"Date"), record.replace(b"Content-Length: ", b"Content-Length: 1"), b""):
        with pytest.raises(ValueError):
            warc.parse_record(wrong)


# the pipeline

def test_pipeline(spark, docs, tokenizer):
    """Each stage on its own input."""
    held = docs
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "mix_sources", "pack_sequences"]
    for name, stage in corpus_pipeline.STAGES:
        rows = [tuple(r) for r in held.select("doc_id", "text", "source").collect()]
        out = materialize(stage(spark, held, SF), name)
        after = Counter(r.doc_id for r in out.collect())
        if name == "quality_rules":
            assert after == Counter(i for i, w in brute.quality(rows).items() if w[-1])
        elif name == "near_duplicates":
            assert after == Counter(i for i, w in brute.near_documents([r[:2] for r in rows]).items() if w[1] == i)
        elif name == "mix_sources":
            assert set(after) <= {r[0] for r in rows} and max(after.values()) <= 3
        else:
            assert Counter(i for i, t, _ in rows for _ in brute.pieces(t, tokenizer)) == after
        if name != "pack_sequences":
            assert out.columns == docs.columns
        held = out
    assert corpus_pipeline.run(spark, SF).count() == held.count()
