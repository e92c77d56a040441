"""Pages, URLs, languages and quality."""

from pyspark.sql import functions as F

from tariffloom.llm import html_extract, language_id, quality, url_filter
from tariffloom.llm.url_filter import Rule

DATA = "/root/testdata/sf0.001"
PAGE = (
    "<html><head><title>T</title><script>var a='<p>no</p>'</script></head><body><header>Site</header><nav><a href=x>Home</a></nav>"
    "<div class='cookie-notice'>We use cookies</div><div id=main><h2>Title {0}</h2><p>Body {0} &amp; more&nbsp;text<p>Second<br>  line {0}</div>"
    "<div class='comments'><p>nice</div><div>Constant box</div><form>Mail <input></form><footer>f {0}</footer>"
)


def test_template_is_left_out():
    got = html_extract.extract_group([PAGE.format(k) for k in range(8)])
    assert got == [f"Title {k}\nBody {k} & more text\nSecond line {k}" for k in range(8)]


def test_copied_passages_of_an_article_stay():
    page = "<body><article><h1>Same</h1><p>Same passage</p><p>Own {0}</p><div>Share this</div></article></body>"
    got = html_extract.extract_group([page.format(k) for k in range(8)])
    assert got[3] == "Same\nSame passage\nOwn 3"


def measured(*pages):
    trees, aligner = [html_extract.parse(h) for h in pages], html_extract.Aligner()
    for t in trees:
        aligner.measure(t)
    return trees, aligner


def plain_matching(a, b):
    """Simple tree matching as it is defined, without numbers of shapes or halved tables."""
    if a.label != b.label:
        return 0
    best = [[0] * (len(b.elements) + 1) for _ in range(len(a.elements) + 1)]
    for i, x in enumerate(a.elements, 1):
        for j, y in enumerate(b.elements, 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + plain_matching(x, y))
    return 1 + best[-1][-1]


def test_matching_equals_its_definition():
    import random

    rng = random.Random(7)

    def page(depth):
        inside = "".join(page(depth - 1) for _ in range(rng.randint(0, 4))) if depth else "x"
        tag = rng.choice(["div", "section", "ul"])
        return f"<{tag} class='{rng.choice('ab')}'>{inside}</{tag}>"

    for _ in range(60):
        (a, b), aligner = measured(page(3) + page(2), page(3) + page(2))
        pairs = aligner.align(a, b)
        assert aligner.pairs(a.shape, b.shape) == plain_matching(a, b) == len(pairs)
        assert all(x.label == y.label for x, y in pairs) and len({id(x) for x, _ in pairs}) == len(pairs)


def test_halved_tables_give_the_same_sum():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(40):
        w = rng.integers(0, 5, (rng.integers(1, 30), rng.integers(1, 30)))
        whole, halved = html_extract.best_pairs(w), html_extract.best_pairs(w, 10)
        total = lambda ps: sum(int(w[p]) for p in ps)  # noqa: E731, B023
        assert total(whole) == total(halved) == html_extract._last_row(w)[-1]
        assert all(a < b and c < d for (a, c), (b, d) in zip(halved, halved[1:], strict=False))


def test_template_does_not_depend_on_the_number_of_pages():
    page = "<body><div>Top bar text</div><div>Body {0} words</div><div>Bottom boilerplate</div></body>"
    for n in (4, 8, 40):
        assert html_extract.extract_group([page.format(k) for k in range(n)]) == [f"Body {k} words" for k in range(n)]


def test_near_copies_are_not_template():
    """A group that is mostly copies of one article keeps it, with or without an article element."""
    text = "".join(f"<p>Paragraph {k} of the text" for k in range(9))
    for page in ("<body><nav>Menu</nav><article>{0}<p>Own {1}</article></body>", "<body><nav>Menu</nav><div>{0}<p>Own {1}</div></body>"):
        got = html_extract.extract_group([page.format(text, k) for k in range(12)] + [page.format("", 99)])
        assert got[3] == "\n".join([*(f"Paragraph {k} of the text" for k in range(9)), "Own 3"])


def test_boilerplate_paragraphs_need_different_pages():
    page = "<article><h1>Title {0}</h1><p>Text {0} a</p><p>Text {0} b</p><p>This site uses things.</p></article>"
    assert html_extract.extract_group([page.format(k) for k in range(8)])[2] == "Title 2\nText 2 a\nText 2 b"


WHOLE = {
    '<body class="single no-sidebar"><article><p>Text</p></article></body>': "Text",
    '<div class="layout has-sidebar"><article><p>Text</p></article></div>': "Text",
    '<div class="sidebar-left"><main><p>Text</p></main></div>': "Text",
    '<div class="search-page"><p>Only text of the page, and it is long enough</p></div><div class="ad">Buy</div>': "Only text of the page, and it is long enough",
    "<main><h1>Title</h1><article><p>Text</p></article><p>After</p></main>": "Title\nText\nAfter",
    "<article><p>One</p></article><article><p>Two is longer</p></article>": "One\nTwo is longer",
    '<article><p class="search-results">Found</p><p class="notice">Read this</p></article>': "Found",
    "<p>Read <a>the linked long title of something</a> now</p>": "Read the linked long title of something now",
    "<div><a>Home</a> | <a>About</a></div><p>Text</p>": "Text",
    "<main><header>Site</header><article><header><h1>Title</h1></header><p>Text</p></article></main>": "Title\nText",
    "<article><p>Text<div class='comments'><p>Long comment, longer than the text</div></article>": "Text",
    "<body><form action=x><div>Most of the page lies in a form</div></form></body>": "Most of the page lies in a form",
    "a <b>c</b> <!-- x --> d &lt;e&gt; <3 f < g <!x> h <": "a c d <e> <3 f < g h <",
    "<p>one<p>two <ul><li>three<li>four</ul> five": "one\ntwo\nthree\nfour\nfive",
    "<p title='a > b' class=x>one</p><p title=\"unclosed>two</p><p>three</p>": "one\ntwo\nthree",
    "<table><tr><td>a<td>b<tr><td>c</table>": "a\nb\nc",
    "</p></div>x</b>": "x",
}


def test_whole_pages():
    for page, text in WHOLE.items():
        assert html_extract.extract_group([page]) == [text], page


def test_bad_pages_take_time_that_grows_with_their_length():
    import time

    for bad in ("<a" * 500_000, "<a " * 300_000, "<p>x" * 100_000, "<b>" * 100_000 + "</i>" * 100_000, "<div>" * 50_000 + "deep", "<p><b>" * 50_000, "<a href=\"x" * 100_000, "<!--" * 200_000, "<script>" * 100_000, "</div>" * 200_000, "&" * 500_000, "<a =\"" * 100_000 + ">"):
        began = time.time()
        html_extract.extract_group([bad, bad + "x", None])
        assert time.time() - began < 10, bad[:20]


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "deep"
    some = [(1, "http://a.b/x", PAGE.format(1), 0), (1, "http://a.b/x", PAGE.format(1), 0), (2, None, None, 0), (3, "nothing", "", 0), (4, "http://a.b/y", deep, 0), (5, "http://c/", "a &am &amp b &#x41;<", 0)]
    got = html_extract.extract(spark.createDataFrame(some, "page_id bigint, url string, html string, text int"))
    by = {r.page_id: (r.text, r.n_chars) for r in got.collect()}
    assert got.count() == 6 and by[2] == by[3] == ("", 0) and by[4] == ("deep", 4) and by[5][0] == "a &am & b A<"
    assert html_extract.extract(spark.createDataFrame(some, "page_id bigint, url string, html string, text int").limit(0)).count() == 0


def test_articles_of_the_tables(spark):
    import re
    from html import unescape

    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    for r in pages.collect():
        body = r.html.split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split("<p>|<h1>", body)]
        assert got[r.page_id] == "\n".join(filter(None, blocks))


RULES = [Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow")]


def test_stated_rules(spark):
    urls = {
        "http://A.Example.NET/en/1?x": ("a.example.net", "/en/1", "example.net/en/", "allow"), "http://a.example.net/de": ("a.example.net", "/de", "net/", "block"), "http://x.net": ("x.net", "", None, "allow"),
        "https://example.com/de/1#t": ("example.com", "/de/1", "example.com/de/", "block"), "http://notexample.com/de/1": ("notexample.com", "/de/1", None, "allow"), "http://a.org/fr/": ("a.org", "/fr/", "org/fr/", "allow"),
        "no url": ("", "", None, "allow"), None: ("", "", None, "allow"), "a://b?c://d/e": ("b", "", None, "allow"), "x://ÄB.net:8/": ("Äb.net:8", "/", None, "allow"), "http://net/": ("net", "/", "net/", "block"),
    }
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(urls)], "page_id bigint, url string, rule string")
    labels = spark.createDataFrame([], "url string, bad boolean")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, labels, RULES).collect()}
    assert got == dict(enumerate(urls.values()))
    assert url_filter.judge(pages.limit(0), labels, RULES).count() == 0


def test_mined_rules(spark):
    good = [(f"http://news-{k % 7}.example.com/a/{k}.html", False) for k in range(60)]
    bad = [(f"http://win-casino.example.com/play/{k}", True) for k in range(30)] + [(f"http://win.example.com/a/{k}", False) for k in range(30)]
    labelled = spark.createDataFrame(good + bad, "url string, bad boolean")
    pages = spark.createDataFrame([(1, "http://big-casino.example.org/x"), (2, "http://win.example.com/a/5"), (3, "http://news-1.example.com/a/7.html"), (4, "http://casino-win.example.com/play/9")], "page_id bigint, url string")
    got = {r.page_id: (r.verdict, r.mined_rule) for r in url_filter.judge(pages, labelled, [], min_rows=10).collect()}
    assert got[1][0] == got[4][0] == "block" and got[2][0] == got[3][0] == "allow"
    assert got[1][1] == got[4][1] == "word:win"  # the greatest of the tokens that always stand together
    rules, _ = url_filter.mine(labelled, min_rows=10)
    assert rules.where("confidence < 0.6 or size(rule_tokens) > 1").count() == 0  # longer ones are covered


def test_mining_equals_brute_force(spark):
    """Rules and verdicts against counting every set of tokens of every labelled URL."""
    import itertools
    import random

    rng = random.Random(12)
    host = lambda: f"{rng.choice(['win', 'news', 'a'])}-{rng.choice(['casino', 'shop', 'blog'])}.{rng.choice(['net', 'com'])}"
    url = lambda: f"http://{host()}/{rng.choice(['play', 'read'])}/{rng.randint(1, 99)}{rng.choice(['', '.html'])}"
    urls = [url() for _ in range(150)]
    labelled = [(u, rng.random() < (0.9 if "casino" in u and "win" in u else 0.5 if "play" in u else 0.1)) for u in urls]
    pages = [(k, url()) for k in range(200)]
    df, pg = spark.createDataFrame(labelled, "url string, bad boolean"), spark.createDataFrame(pages, "page_id bigint, url string")
    tokens = {r.url: frozenset(r.t) for r in df.select("url").union(pg.select("url")).distinct().select("url", url_filter.tokens_of(F.col("url")).alias("t")).collect()}
    count, bad = {}, {}
    for u, b in labelled:
        for n in range(1, len(tokens[u]) + 1):
            for own in map(frozenset, itertools.combinations(tokens[u], n)):
                count[own] = count.get(own, 0) + 1
                bad[own] = bad.get(own, 0) + b
    rules = [own for own, n in bad.items() if n >= 12 and n >= 0.7 * count[own]]
    want = {k: "block" if any(r <= tokens[u] for r in rules) else "allow" for k, u in pages}
    got = {r.page_id: r.verdict for r in url_filter.judge(pg, df, [], min_rows=12, min_confidence=0.7).collect()}
    assert got == want and set(want.values()) == {"block", "allow"}


def test_tokens_that_always_stand_together_count_as_one(spark):
    """Thirty such tokens would make 2**30 frequent sets."""
    path = "/".join(f"w{k}x" for k in range(30))
    labelled = spark.createDataFrame([(f"http://bad.com/{path}/{k}", True) for k in range(40)] + [(f"http://good.com/{k}", False) for k in range(40)], "url string, bad boolean")
    pages = spark.createDataFrame([(1, "http://x.org/w7x"), (2, "http://bad.com/"), (3, "http://good.com/9"), (4, "http://x.org/w")], "page_id bigint, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge(pages, labelled, [], min_rows=10).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow"}


def test_long_urls(spark):
    long = "http://a.net/en/" + "x/" * 20_000 + "?" + "k=v&" * 20_000
    pages = spark.createDataFrame([(1, long), (1, long), (None, long)], "page_id bigint, url string")
    got = url_filter.judge(pages, spark.createDataFrame([], "url string, bad boolean"), RULES).collect()
    assert len(got) == 3 and {(r.host, r.rule) for r in got} == {("a.net", "net/")}


def test_url_query_equals_sql(spark, tmp_path):
    """The query against its SQL, on tables where mined rules decide."""
    import duckdb

    from tariffloom.llm import queries

    docs = [(k, k % 3) for k in range(120)]
    pages = [(k, f"http://{'win-casino' if q == 0 else 'news'}{k % 4}.example.{'org' if k % 2 else 'com'}/{'fr' if k % 5 == 0 else 'en'}/{k}{'.html' if k % 7 else '?a=1&b'}{'#x' if k % 11 == 0 else ''}", "x") for k, q in docs] + [(500, None, None), (501, "no url", ""), (502, "HTTP://X.Example.NET/en/1", "")]
    folder = str(tmp_path)
    spark.createDataFrame(pages, "page_id bigint, url string, html string").coalesce(1).write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame([(k, int(q > 0), 0) for k, q in docs], "doc_id bigint, quality int, toxic int").coalesce(1).write.parquet(f"{folder}/labels.parquet")
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.register(t, spark.read.parquet(f"{folder}/{t}.parquet").toPandas())
    got = queries.op3_url_filter(spark, folder)
    want = con.execute(queries.oracle_sql()["op3_url_filter"]).fetchall()
    assert sorted(map(tuple, got.select("page_id", "host", "path", "rule", "verdict", "mined").collect()), key=str) == sorted(want, key=str)
    assert sum(r[5] for r in want) >= 30


def test_labels_by_document(spark):
    pages = spark.createDataFrame([("http://a/en/12.html",), ("http://a/x2/7?p=3",), ("http://a/",), (None,)], "url string")
    labels = spark.createDataFrame([(12, 0, 0), (7, 1, 0), (7, 1, 1), (None, 0, 0)], "doc_id bigint, quality int, toxic int")
    assert sorted(map(tuple, url_filter.label_by_document(pages, labels).collect())) == [("http://a/en/12.html", True), ("http://a/x2/7?p=3", True)]


def test_language(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = language_id.identify_documents(docs)
    assert out.columns[:5] == docs.columns and out.where("language <> lang or not language_kept").count() == 0
    odd = docs.limit(50).select("doc_id", "text", "lang", "source", "n_chars").union(spark.createDataFrame([(900, None, "de", "s", 0), (901, "", None, None, 0), (902, "12 34 !", "xx", "s", 0), (None, docs.first().text, None, None, 0)], docs.schema)).withColumn("language", F.lit(1))
    got = {r.doc_id: r for r in language_id.identify_documents(odd).collect()}
    assert not any(got[k].language_kept for k in (900, 901, 902)) and got[900].language == "de" and got[None].language_kept
    assert language_id.identify_documents(docs.limit(0)).count() == 0


FOREIGN = {
    "it": "La casa è molto grande e il giardino è pieno di fiori che crescono vicino al muro della vecchia chiesa del paese.",
    "nl": "Het huis is erg groot en de tuin staat vol met bloemen die naast de muur van de oude kerk in het dorp groeien.",
    "pt": "A casa é muito grande e o jardim está cheio de flores que crescem perto do muro da velha igreja da aldeia.",
    "pl": "Dom jest bardzo duży, a ogród jest pełen kwiatów, które rosną obok muru starego kościoła we wsi.",
    "sv": "Huset är mycket stort och trädgården är full av blommor som växer bredvid muren till den gamla kyrkan i byn.",
    "tr": "Ev çok büyük ve bahçe, köydeki eski kilisenin duvarının yanında büyüyen çiçeklerle dolu.",
}


def test_other_languages_and_gibberish_are_not_kept(spark):
    import random

    rng = random.Random(4)
    draw = lambda signs, n: "".join(rng.choice(signs) for _ in range(n))
    latin, cyrillic, greek, han = (list(map(chr, range(*r))) for r in ((97, 123), (0x430, 0x450), (0x3B1, 0x3CA), (0x4E00, 0x9000)))
    texts = [*FOREIGN.values(), *(draw([*signs, " "] if n % 2 else signs, 20 + 31 * n) for signs in (latin, cyrillic, greek, han) for n in range(10))]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = spark.createDataFrame([(10**6 + 2 * k + said, t, ("en", "fr")[k % 2] if said else None, "s", len(t)) for k, t in enumerate(texts) for said in (0, 1)], docs.schema)
    out = language_id.identify_documents(docs.unionByName(odd))
    assert out.where(f"doc_id >= {10**6} and language_kept").count() == 0
    assert out.where(f"doc_id < {10**6} and not (language_kept and language = lang)").count() == 0


def test_page_language_uses_markup_and_host(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    out = language_id.identify_pages(pages)
    assert out.where("language <> declared_language or not language_kept").count() == 0


def test_declaration_and_host_decide_short_texts(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    extra = spark.createDataFrame([(9000 + k, "la", None, "only-french", 2) for k in range(3)] + [(9100 + k, docs.where("lang = 'fr'").first().text, "fr", "only-french", 9) for k in range(30)], docs.schema)
    got = [r.language for r in language_id.identify_documents(docs.union(extra)).where("doc_id between 9000 and 9002").collect()]
    assert got == ["fr"] * 3


def test_addresses_of_documents(spark):
    rows = [(4, "http://b.example.org/en/12.html"), (3, "https://A.Example.COM/x2/12?p=3"), (3, "https://c.example.net/12"), (1, "http://a/"), (2, None), (5, "/en/13"), (6, "http://host/7")]
    got = language_id.addresses(spark.createDataFrame(rows, "page_id int, url string"))
    assert sorted(map(tuple, got.collect())) == [(7, "host", "host"), (12, "a.example.com", "com")]


def test_suffix_of_a_documents_page_decides_short_texts(spark):
    """Two documents that only differ in the suffix of the page that shows them, each on a host of its own."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    text = {lang: docs.where(F.col("lang") == lang).first().text for lang in ("fr", "es")}
    known = [(9100 + 100 * n + k, text[lang], lang, "s", 9, lang) for n, lang in enumerate(text) for k in range(60)]
    short = [(9000 + n, "la", None, "s", 2, lang) for n, lang in enumerate(text)]
    extra = [*known, *short, (9002, "la", None, "s", 2, None)]
    pages = spark.createDataFrame([(i, f"http://www.h{i}.{end}/x/{i}.html") for i, *_, end in extra if end], "page_id int, url string")
    every = docs.union(spark.createDataFrame([r[:5] for r in extra], docs.schema)).withColumn("address_host", F.lit("mine"))
    out = language_id.identify_documents(every, pages)
    assert out.columns[:6] == every.columns and out.count() == every.count() and out.where("address_host <> 'mine'").count() == 0
    got = {r.doc_id: r.language for r in out.where("doc_id between 9000 and 9001").collect()}
    assert got == {9000: "fr", 9001: "es"}


def test_posterior_equals_brute_force(spark):
    """Languages and confidences against the same evidence put together row by row, without Spark."""
    import math
    from collections import Counter

    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(120)
    odd = spark.createDataFrame([(900, "la", None, "s1", 2), (901, "der die", "fr", "s1", 2), (902, None, "de", "s2", 0), (903, "of the", "xx", None, 2), (904, "", None, None, 0)], docs.schema)
    docs = docs.unionByName(odd).withColumn("end", F.when(F.col("doc_id") % 3 == 0, "com").when(F.col("doc_id") % 3 == 1, "org"))
    model = language_id.train(docs, F.col("text"), F.col("lang"), F.col("doc_id"))
    out = language_id.identify(docs, model, text="text", declared=F.col("lang"), host=F.col("source"), suffix=F.col("end"))
    rows = [(r.doc_id, model.evidence(r.text), r.lang, r.source, r.end) for r in docs.collect()]
    k, names = len(model.languages), model.languages
    best = lambda e: int(e.argmax()) if e.any() else None
    known = [(best(e), lang, host, end) for _, e, lang, host, end in rows if e.any()]
    whole, by_end, by_host = Counter(b for b, *_ in known), Counter((x, b) for b, _, _, x in known), Counter((h, x, b) for b, _, h, x in known)
    said = [(b, lang) for b, lang, *_ in known if lang in names]
    agreement = (sum(names[b] == lang for b, lang in said) + 9) / (len(said) + 10)
    shares = [(whole[b] + 1) / (len(known) + k) for b in range(k)]
    smooth = lambda counts, key, above: [(counts[*key, b] + 20 * above[b]) / (sum(counts[*key, c] for c in range(k)) + 20) for b in range(k)]
    want = {}
    for doc, e, lang, host, end in rows:
        seen = any(by_host[host, end, b] for b in range(k))
        prior = smooth(by_host, (host, end), smooth(by_end, (end,), shares)) if seen else shares
        logs = [float(e[b]) + math.log(prior[b]) + (0 if lang not in names else math.log(agreement) if names[b] == lang else math.log((1 - agreement) / (k - 1))) for b in range(k)]
        want[doc] = names[logs.index(max(logs))], 1 / sum(math.exp(x - max(logs)) for x in logs)
    got = {r.doc_id: (r.language, r.confidence) for r in out.collect()}
    assert {d: v[0] for d, v in got.items()} == {d: v[0] for d, v in want.items()}
    assert all(abs(got[d][1] - want[d][1]) < 1e-6 for d in want)


def test_evidence_is_bounded_but_reads_the_whole_text():
    import numpy as np

    logs = np.full((language_id.BUCKETS, 2), -9.0, np.float32)
    logs[language_id.trigrams("abc")] = [-1.0, -5.0]
    model = language_id.TextModel(["a", "b"], logs, np.full(2, -20.0))
    one, many = model.evidence("abc " * 40), model.evidence("abc " * 4000)
    assert np.allclose(one, many, rtol=0.02) and np.allclose(many / language_id.EFFECTIVE_TRIGRAMS, model.fits(language_id.trigrams("abc " * 4000)))
    assert model.evidence("xyz " * 5000 + "abc " * 5000)[0] > model.evidence("xyz " * 5000)[0]


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    seen, unseen = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    model = quality.train(docs, seen)
    got = quality.score(docs, model).join(unseen, "doc_id").select("quality_kept", "quality").collect()
    good, bad = ([r.quality_kept for r in got if r.quality == q] for q in (1, 0))
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_trailing_marks_are_counted_over_the_whole_text():
    """Marks between any strides count, and the share does not depend on the length."""
    share = lambda words: quality.text_features(" ".join(words))[13]
    assert share(["a!"] * 991) == share(["a!"] * 10) == 1.0
    assert share(["a", "b!"] * 10_000) == share(["a!", "b"] * 10_000) == 0.5
    assert share([]) == 0.0


def test_views_teach_each_other():
    import numpy as np

    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 400).astype(float)
    view = lambda noise: np.stack([2 * y - 1 + noise * rng.normal(size=400), np.ones(400)], axis=1)
    text, meta = view(0.6), view(0.9)
    asked = []

    def pool(views, good):
        asked.append(good)
        surest = lambda x, w: np.argsort(x[60:] @ w)
        give = lambda own, w, other: (other[60:][(ends := np.r_[(order := surest(own, w))[:20], order[-20:]])], (own[60:][ends] @ w > 0).astype(float))
        return {"text": give(text, views.text, meta), "meta": give(meta, views.meta, text)}

    model = quality.co_train(text[:60], meta[:60], y[:60], pool)
    right = ((model.log_odds(text, meta) >= 0) == (y == 1)).mean()
    assert right > 0.93 and model.cut <= 0 and len(asked) == quality.ROUNDS


def test_all_unlabelled_rows_set_the_bounds(spark):
    """The pool hands over the surest rows of all, whatever their number, and no more than asked for."""
    import numpy as np

    rng = np.random.default_rng(2)
    x = rng.normal(size=(5000, 2))
    rows = spark.createDataFrame([(k, [float(a), 1.0], [float(b), 1.0], (k * 7919 % 5003 - 2502) * 3_600_000_000_000_000) for k, (a, b) in enumerate(x)], "doc_id bigint, text array<float>, meta array<float>, place bigint")
    give = quality.distributed_pool(rows.repartition(3), handed=0.1, handed_rows=100)
    got = give(quality.Views(np.array([9.0, 0.0]), np.array([9.0, 0.0])), 0.8)
    for view, (own, other) in (("text", (0, 1)), ("meta", (1, 0))):
        features, labels = got[view]
        assert (labels == 1).sum() == 80 and (labels == 0).sum() == 20
        by_other = {np.float32(v): k for k, v in enumerate(x[:, other])}
        mine = np.array([x[by_other[np.float32(f[0])], own] for f in features])
        assert mine[labels == 1].min() >= np.quantile(x[:, own], 0.91) and mine[labels == 0].max() <= np.quantile(x[:, own], 0.03)


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "x" * 9999, "en", "s", 1)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    out = quality.score(docs, quality.train(docs, labels))
    assert out.where("quality_kept").count() == 4
    assert quality.score(docs.limit(0), quality.train(docs.limit(0), labels)).count() == 0
