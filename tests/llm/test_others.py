"""URL rules, shards, pages, languages, decontamination and licences against brute force."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from registrar.llm import decontam, html_extract, langid, licenses, sharding, url_filter
from registrar.llm.queries import RULES, QUERIES

from .conftest import CLASHING, prose

URLS = [None, "", "no scheme", "http://", "http://net", "http://NET/en/", "http://example.net/en/x", "http://a.Example.NET/en", "x://example.net/english/",
        "http://b.example.com/de/?q=/de/", "http://example.com/de", "http://fr.org/fr/1#a", "http://org/fr/", "http://orgs/fr/", "http://my.org?x=/fr/",
        "http://example.net:80/en/", "a://b://net/", "http://xexample.com/de/", "http://net./", "http://.net/"]


@pytest.fixture(scope="module")
def pages(spark):
    from pyspark.sql import functions as F
    rows = [(k, u, None) for k, u in enumerate(URLS)] + [(None, URLS[5], None), (3, URLS[3], None)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").select(
        "*", *(F.lit("clash").alias(c) for c in CLASHING if c not in ("url", "html")))


def brute_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: (len(r.host), len(r.path)), default=None)
    return host, path, best and best.host + best.path, best.verdict if best else "allow"


def test_urls(pages):
    found = url_filter.judge(pages, RULES).collect()
    want = [(k, *brute_rule(u)) for k, u in enumerate(URLS)] + [(None, *brute_rule(URLS[5])), (3, *brute_rule(URLS[3]))]
    assert sorted(map(str, (tuple(r) for r in found))) == sorted(map(str, want))
    assert url_filter.judge(pages.limit(0), RULES).count() == 0


def test_trie_prefers_longer_rules_and_block():
    rules = [url_filter.Rule("a.b", "/x", "allow"), url_filter.Rule("a.b", "/x/y", "block"), url_filter.Rule("a.b", "/x/y", "allow"),
             url_filter.Rule("c.a.b", "", "allow")]
    trie = url_filter.Trie(rules)
    assert trie.find("a.b", "/xyz").path == "/x" and trie.find("a.b", "/x/yz").verdict == "block"
    assert trie.find("c.a.b", "/x/y").host == "c.a.b" and trie.find("b", "/x") is None and trie.find("a.b", "/") is None


def jump(key, n):
    key, b, j = (key or 0) % 2**64, -1, 0
    while j < n:
        b = j
        key = (key * sharding.MULTIPLIER + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_shards(docs, rows):
    found = sharding.shard(docs, 24).collect()
    want = [(d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), "key", jump(d, 24), jump(d, 25)) for d, t, *_ in rows]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard)) for r in found)
    for s in range(24):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))
    assert all(r.grown_shard in (r.shard, 24) for r in found)
    assert sharding.shard(docs.limit(0), 24).count() == 0


def test_jumps_of_large_and_negative_keys(spark):
    keys = [0, 1, -1, 2**63 - 1, -2**63, 123456789012345678, -987654321]
    frame = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for n in (1, 2, 24, 100):
        found = frame.select(sharding.jumps(frame["k"], n).alias("p")).collect()
        assert [r.p[-1] for r in found] == [jump(k, n) for k in keys]


def page(body, tail="</body></html>"):
    return ('<!DOCTYPE html><html lang="en"><head><title>T &amp; U</title><style>p{}</style><script>var t="</p>";</script></head><body>'
            f'<nav><ul><li><a href="/a">menu</a></li></ul></nav><!-- x --><div class="ad">buy</div>{body}<footer>&copy; foot</footer>{tail}')


def test_pages(spark):
    rows = [
        (1, "http://h/1", page("<article><h1>A &amp;amp; B</h1><p><b>one\n  two<br><p>three&nbsp;four</article>")),
        (2, "http://h/2", page("<article><h1>C</h1><p>x</p><aside>side</aside><form>f</form><div class='comments'>no</div><p>y &lt;z&gt;</p></article>", "")),
        (3, "http://h/3", page("<article><h1>D</h1><p>" + "long " * 50_000 + "</p></article>")),
        (4, "http://h/4", None), (5, None, ""), (None, "http://g/1", "<p>only</p> text <"), (1, "http://h/1", page("<article><p>cut &am")),
        (6, "http://m/1", "<html><body><div class=menu>m</div><div class='main'><p>body text of a page without an article tag</p></div></body></html>"),
        (7, "http://h/5", "<html><body><main>other <i>kind</i> of page</main></body></html>"),
    ]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {(r.page_id, r.url, r.n_chars): r.text for r in html_extract.extract(frame).collect()}
    assert all(n == len(t) for (_, _, n), t in found.items())
    texts = sorted(found.values(), key=len)
    assert texts == sorted(["A &amp; B\none two\nthree four", "C\nx\ny <z>", "D\n" + " ".join(["long"] * 50_000), "", "", "only\ntext <", "cut &am",
                            "body text of a page without an article tag", "other kind of page"], key=len)
    assert html_extract.extract(frame.limit(0)).count() == 0


def texts_of(spark, rows):
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in html_extract.extract(frame).collect()}


def test_repeated_blocks_of_a_host_are_its_template(spark):
    note = "<div class='xq'><p>Sign our petition</p><p>Write to us</p></div>"
    rows = [(k, f"http://h/{k}", page(f"<article><h1>T{k}</h1><p>story {k} of its own, as long as it takes to be told in full</p>{note}<p>end {k}</p></article>")) for k in range(4)]
    rows += [(9, "http://h/9", page("<article><p>Write to us</p><p>then</p><p>Sign our petition</p></article>"))]  # elsewhere, so not the template's
    rows += [(20 + k, f"http://g/{k}", page(f"<article><p>one article</p><p>in copies</p></article><!-- {k} -->")) for k in range(4)]
    rows += [(30 + k, f"http://two/{k}", page(f"<article><p>own {k}, and a quotation:</p><p>to be</p></article>")) for k in range(2)]
    want = {k: f"T{k}\nstory {k} of its own, as long as it takes to be told in full\nend {k}" for k in range(4)}
    want[9] = "Write to us\nthen\nSign our petition"
    want |= {20 + k: "one article\nin copies" for k in range(4)} | {30 + k: f"own {k}, and a quotation:\nto be" for k in range(2)}
    assert texts_of(spark, rows) == want


def test_articles_of_few_pages_and_of_varying_class(spark):
    around = "<div class='x'>around {0} the article, and longer than the article: " + "word{0} " * 40 + "</div>"
    rows = [(k, f"http://h/{k}", page(around.format(k) + f"<article><p>story {k}</p></article>")) for k in range(2)]
    rows += [(10 + k, f"http://h/{k}", page(f"<div><p>front page {k}</p></div>")) for k in range(5)]
    rows += [(20 + k, f"http://g/{k}", page(around.format(k) + f"<article class='post-{k}7 post'><p>story {k}</p></article>"
                                            f"<article class='teaser'><p>next {k}</p></article>")) for k in range(4)]
    rows += [(30 + k, f"http://m/{k}", f"<html><body class='page-id-{k}'>{around.format(k)}<div class='w-1/2 main col{k}'>text {k}</div></body></html>")
             for k in range(4)]
    # per-page class names without digits: no path of the host's, but every page's own
    rows += [(40 + k, f"http://c/{k}", page(around.format(k) + f"<article class='tag-{'abcd'[k]}'><p>story {k}</p></article>")) for k in range(4)]
    want = {**{k: f"story {k}" for k in range(2)}, **{10 + k: f"front page {k}" for k in range(5)}, **{20 + k: f"story {k}" for k in range(4)},
            **{30 + k: f"text {k}" for k in range(4)}, **{40 + k: f"story {k}" for k in range(4)}}
    assert texts_of(spark, rows) == want
    slots = {r.host: r.slot for r in html_extract.templates(spark.createDataFrame(rows, "page_id bigint, url string, html string"),
                                                            html_extract.host(F.col("url"))).collect()}
    assert slots["m"] == "html/body/div.main.*"


def test_names_as_a_whole_are_boilerplate(spark):
    def wrapped(k, attributes, text="<article><p>whole story</p></article>"):
        return k, f"http://h{k}/1", page(f"<div {attributes}>{text}</div>")
    rows = [wrapped(1, "class='content has-sidebar'"), wrapped(2, "class='post comments-open'"), wrapped(3, "class='no-header'"),
            wrapped(4, "class='widget'"), wrapped(5, "id='search'"),
            (6, "http://h6/1", page("<article><p>one</p><section id='related-work'><p>two</p></section><div class='site-footer'>no</div>"
                                    "<div class='x related-posts'>no</div></article>")),
            # a comment's article is not the page's
            (7, "http://h7/1", page("<div><p>a long story of the page itself</p></div><div class='comments'><article>hi</article></div>"))]
    want = {k: "whole story" for k in range(1, 6)} | {6: "one\ntwo", 7: "a long story of the page itself"}
    assert texts_of(spark, rows) == want


def test_boilerplate_of_every_element(spark):
    bodies = {
        1: ("<p class='notice'>no<p>a<p class=ad>no <b>no</b></p>b", "a\nb"),
        2: ("<p>hello <span class='advert'>no <span>no</span> no</span> world <a class='share' href='x'>no</a><a id='comments'>!</a></p>", "hello world !"),
        3: ("<ul><li>one<li class='comment'>no<p>no</p><ul><li>no</ul><li>two</ul>", "one\ntwo"),
        4: ("<h3 class='related'>no</h3><h2 id='search'>S</h2><h2 class='header'>H</h2><p>x", "S\nH\nx"),
        5: ("<table><tr><td class='ad'>no<td>cell<tr><td>next</table><dl><dt class='ad'>no<dd>d</dl>", "cell\nnext\nd"),
        6: ("<p>a <span class='ad'>no</p>b <br class='ad'>c</span> d<div>e</p></div>", "a\nb\nc d\ne"),
    }
    rows = [(k, f"http://h{k}/1", page(f"<article>{body}</article>")) for k, (body, _) in bodies.items()]
    assert texts_of(spark, rows) == {k: text for k, (_, text) in bodies.items()}


def test_deep_pages():
    """Nesting costs no more than the paths' own length."""
    import time
    took = {}
    for depth in (1000, 4000):
        page = "<html><body>" + "<div>" * depth + "<article><p>deep text</p></article>" + "</div>" * depth + "</body></html>"
        start = time.process_time()
        slot = "html/body/" + "div/" * depth + "article"
        assert html_extract.main_text(page, slot) == "deep text"
        events = html_extract.walk(page)
        assert html_extract.page_tokens(events)[slot] == [1, 9] and len(html_extract.page_blocks(events)) == 1
        took[depth] = time.process_time() - start
    assert took[4000] < 5


def test_pages_of_a_table(spark):
    """Against a plain reading of the tables' one page layout."""
    import html
    sf = "/root/testdata/sf0.001"
    found = {r.page_id: r.text for r in QUERIES["op4_html"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inside = re.search(r"(?s)<article>(.*?)(</article>|\Z)", r.html)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inside)]
        assert found[r.page_id] == "\n".join(b for b in blocks if b)


def test_languages(docs, rows):
    labelled = langid.held_out(docs)
    model = langid.train(labelled.where("not held_out"))
    found = langid.identify(labelled, model).collect()
    assert len(found) == len(rows)
    letters = {str(d): bool(t and re.search(r"[^\W\d_]", t)) for d, t, *_ in rows}
    assert all((r.lang_pred != "und") == letters[str(r.doc_id)] and 0 <= r.score <= 1 for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found if r.doc_id is not None)
    kept = langid.keep_known(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.lang_pred != "und" and not r.ambiguous for r in found)
    nothing = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(labelled, nothing).collect()} == {"und"}
    assert langid.identify(labelled.limit(0), model).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    found = [r for r in QUERIES["op8_language_id"](spark, sf).collect() if r.held_out and lang[r.doc_id]]
    assert len(found) > 100 and np.mean([lang[r.doc_id] == r.lang_pred for r in found]) > 0.97


def test_codewords():
    for n in (2, 4, 5, 9, 30):
        code = langid.codewords(n)
        apart = [int((code[i] != code[j]).sum()) for i in range(n) for j in range(i)]
        assert min(apart) >= (1 << n - 2 if n <= 5 else 3)


def test_decontamination(spark, docs, rows, monkeypatch):
    items = [(0, " ".join(prose(1, 120)[20:50])), (1, "One two"), (2, None), (3, " "), (4, " ".join(prose(3, 60_000)[777:800])),
             (5, " ".join(prose(77, 30))), (None, "no id"), (6, "repeated row"), (6, "repeated row")]
    frame = spark.createDataFrame(items, "item_id bigint, text string")

    def grams(text, n):
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
    want = []
    for i, text in items:
        k = min(5, len((text or "").split()))
        own = grams(text, k) if k else set()
        for d, t, *_ in rows:
            n = len(own & grams(t, k)) if own else 0
            if own and 100 * n >= 80 * len(own):
                want.append((d, i, len(own), n))
    for block in (2_000_000, 20):
        monkeypatch.setattr(decontam, "BLOCK_SHINGLES", block)
        found = decontam.contaminated(docs, frame).collect()
        assert sorted(map(str, want)) == sorted(str((r.doc_id, r.item_id, r.n_shingles, r.n_found)) for r in found)
    left = decontam.clean(docs, frame)
    assert left.columns == docs.columns
    dirty = {str(d) for d, *_ in want}
    assert left.count() == sum(str(d) not in dirty for d, *_ in rows)
    assert decontam.contaminated(docs, frame.limit(0)).count() == 0 and decontam.contaminated(docs.limit(0), frame).count() == 0


def test_one_block_of_items_is_held_at_a_time(spark, docs, monkeypatch):
    from pyspark import Broadcast, SparkContext
    held, most, made = [], [], []

    def broadcast(self, value, make=SparkContext.broadcast):
        made.append(make(self, value))
        held.append(made[-1])
        most.append(len(held))
        return made[-1]

    def destroy(self, *args, end=Broadcast.destroy, **kwargs):
        held.remove(self)
        end(self, *args, **kwargs)
    frame = spark.createDataFrame([(k, " ".join(prose(1, 120)[k:k + 30])) for k in range(0, 60, 10)], "item_id bigint, text string")
    whole = sorted(map(str, decontam.contaminated(docs, frame).collect())), decontam.clean(docs, frame).count()
    monkeypatch.setattr(decontam, "BLOCK_SHINGLES", 60)
    monkeypatch.setattr(SparkContext, "broadcast", broadcast)
    monkeypatch.setattr(Broadcast, "destroy", destroy)
    assert sorted(map(str, decontam.contaminated(docs, frame).collect())) == whole[0]
    assert len(made) > 1 and max(most) == 1
    held.clear()
    assert decontam.clean(docs, frame).count() == whole[1] and max(most) == 1


def test_licences(docs, rows):
    base = [t for t in licenses.TEMPLATES if t.base]
    want = []
    for d, t, *_ in rows:
        w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())
        places = [(b.label, i) for b in base for p in [b.words.encode().split()] for i in range(len(w)) if w[i:i + len(p)] == p]
        starts = [i for _, i in places]
        want.append((d, len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for x, _ in places}))))
    found = licenses.scan(docs).collect()
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in found)
    labels = {r.doc_id: r.labels for r in found}
    assert labels[25] == "apache-2,cc-by-nc,mit" and labels[26] == "gpl-3" and labels[10] == ""
    assert all((r.score > 0) == bool(r.labels) and r.score <= 1 + 1e-9 for r in found)
    assert licenses.scan(docs.limit(0)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "MinHash near-dedup", "benchmark decontamination", "BPE encoding"]
    step = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, step = step.count(), stage(spark, step, sf)
        assert step.columns == docs.columns and step.count() <= before
    assert kept == {r.doc_id for r in step.select("doc_id").collect()} and len(kept) > 100
