import json

from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.functions.profiles import LATIN
from scriptorium.operators import sinks, translate
from scriptorium.plans import pipelines
from scriptorium.plans.catalog import Catalog
from scriptorium.sources import files, web
from scriptorium.streaming import intake
from tests.oracle import compare, connect


def put(path, *records):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in records), encoding="utf-8")


def test_read_pages(spark, tmp_path):
    put(tmp_path / "doc_0003.jsonl", {"text": "b", "engine": "e"}, "", "{broken", {"no": 1}, {"text": "c"})
    put(tmp_path / "doc_0004_norm.jsonl", {"text": "d", "quality_score": 0.5})
    put(tmp_path / "doc.jsonl", {"text": "e", "page_no": 7}, {"text": "f", "page_no": 8})
    put(tmp_path / "doc_more_0001.jsonl", {"text": "g"})
    got = files.read_pages(spark, f"{tmp_path}/*.jsonl", "doc").orderBy("page_no", "line").collect()
    # a name without digits counts as page 1
    assert [(r.page_no, r.line, r.text) for r in got] == [(1, 0, "e"), (1, 1, "f"), (3, 0, "b"), (3, 4, "c"), (4, 0, "d")]
    assert files.read_pages(spark, f"{tmp_path}/*.jsonl", "doc_more").count() == 1


def test_names_and_groups(spark):
    names = ["doc_0003.pdf", "doc_0004.pdf", "doc_0004_norm.jsonl", "book.pdf", "x.txt", "doc_0003.pdf"]
    rows = spark.createDataFrame([(n, 1) for n in names], "name string, length long")
    got = {(r.doc, r.kind): r.pages for r in files.group_pages(rows).collect()}
    assert got == {("doc", "pdf"): [3, 4], ("doc", "jsonl"): [4], ("book", "pdf"): [1]}
    assert sorted((r.doc, r.page) for r in files.missing_scans(rows).collect()) == [("book", 1), ("doc", 3)]
    stems = spark.createDataFrame([("doc_0003",), ("doc_0003_norm",), ("doc",)], "s string")
    assert [r.p for r in stems.select(files.page_from_name(F.col("s"), False).alias("p")).collect()] == [3, 1, 1]
    assert [r.p for r in stems.select(files.page_from_name(F.col("s")).alias("p")).collect()] == [3, 3, 1]


def test_etext(spark):
    raw = ["<b>01,001.003a</b> dharma &amp; x", "01,001.003c more", "01,001.000*0001_01 apparatus", "02,001.001 other", "01,002.001 next", "noise", "01,002.002 "]
    lines = files.etext_lines(spark.createDataFrame(list(enumerate(raw)), "pos int, value string"), 1)
    got = files.etext_verses(lines).orderBy("chapter", "verse").collect()
    assert [(r.chapter, r.verse, r.padas, r.text, r.page_no) for r in got] == [(1, 3, 2, "dharma & x\nmore", 1), (2, 1, 1, "next", 2)]


def test_references_terms_gazetteer(spark, tmp_path):
    put(tmp_path / "refs.csv", "normalized,sanskrit,bori,notes", "क ।,x,1,n", ",ख।,2,", ",,3,")
    got = files.read_references(spark, f"{tmp_path}/refs.csv").orderBy("bori").collect()
    assert [(r.norm, r.bori) for r in got] == [("क ।", "1"), ("ख ।", "2")]
    put(tmp_path / "terms.csv", "source,target", "bargad,banyan", ",x")
    assert files.read_terms(spark, f"{tmp_path}/terms.csv") == [("bargad", "banyan")]
    put(tmp_path / "a.json", json.dumps([{"surface": "A", "type": "LOC", "aliases": ["B"]}, {"name": "C"}]))
    put(tmp_path / "b.json", {"surface": "A", "type": "LOC", "aliases": ["B"]}, "", {"name": "C"})
    for name in "ab":
        got = files.read_gazetteer(spark, f"{tmp_path}/{name}.json").orderBy("gaz_index").collect()
        assert [(r.gaz_index, r.surface, r.type, r.aliases) for r in got] == [(0, "A", "LOC", ["B"]), (1, "C", None, None)]


PAGE = """<html><body><nav><p>Home</p></nav><p>before</p><main><h1>Title</h1><p>One <b>two</b></p><ul><li>Contact</li><li>item</li></ul>
<div class="ad"><p>buy</p></div><h2>Sub</h2><p>x</p><p>more &amp; more</p><h3>Comments:</h3><p>late</p></main></body></html>"""


def test_missing_end_tags_and_long_pages():
    import time

    texts = lambda page: [(x["tag"], x["text"]) for x in web._tag_texts(page)]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><p>e<p>f<h2>g</h2>h") == [("li", "a"), ("li", "b c"), ("li", "c"), ("li", "d"), ("p", "e"), ("p", "f"), ("h2", "g")]
    assert texts("<blockquote>x <p>y</p> z</blockquote></i></b>") == [("blockquote", "x y z"), ("p", "y")]
    for page in ("<li>x" * 100_000, "<b>" * 100_000 + "</i>" * 100_000, "<div>" * 100_000 + "x", "<p>x" * 100_000):
        began = time.perf_counter()
        web._tag_texts(page)
        assert time.perf_counter() - began < 5


def test_web(spark, one):
    assert one(web.content_lines(F.lit(PAGE), F.lit("t"), LATIN)) == ["# Title", "One two", "item", "# Sub", "x", "more & more"]
    assert one(web.content_lines(F.lit("<div>x</div>"), F.lit("t"))) == ["# t"]
    assert one(web.content_lines(F.lit(None).cast("string"), F.lit(""))) == []
    assert one(web.plain_lines(F.lit("Home\na\nAbout "), ("home", "about"))) == ["a"]
    urls = ["https://www.site.org/hinduism/book/the-book/d/doc123.html", "https://www.site.org/jainism/book/other", "https://www.site.org/definition/x"]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    got = web.scan_archive(pages, "site.org").orderBy("url").collect()
    assert [(r.section, r.book, r.book_doc) for r in got] == [("hinduism", "the-book", 123), ("jainism", "other", None)]
    assert web.books(web.scan_archive(pages, "site.org")).count() == 2
    assert web.search_pages(pages, ["url"], "JAINISM", "url").count() == 1


def test_references_without_semicolon(one):
    page = "<h1>R &amp; D &amp;amp &quot;x&quot</h1><p>a&copy=2 &#39;y&#39; &amp;lt; &lt;b&gt;"
    assert one(web.content_lines(F.lit(page), F.lit(None).cast("string"), LATIN)) == ['# R & D &amp "x"', "a©=2 'y' &lt; <b>"]
    assert one(web.content_lines(F.lit(page), F.lit(None).cast("string"), LATIN, web.MARKUP_REFERENCES)) == ['# R & D &amp "x&quot', "a&copy=2 &#39;y&#39; &lt; <b>"]


def test_lines_of_cut_headings_are_those_of_sql(spark, tmp_path):
    heads = ["and&amp", "and&amp;&amp", "and&am", "and&a", "and&", "and&quo", "and&quot", "and&lt", "&gt", "&ampx", "a &amp;lt", "a&copy;&nbsp;&#39;&eacute", "&amp", ""]
    pages = [f"<article><h1>{h}</h1><p><b>{h} &amp;quot; x<br><p>{h}</p><p>&amp;</p></article>" for h in heads]
    spark.createDataFrame(list(enumerate([*pages, "", None])), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    # an empty heading and an empty paragraph give no line, nor does a lone sign
    assert compare("html_lines", spark, connect(str(tmp_path)), str(tmp_path)) == 3 * len(heads) - 2


def test_write_pages(spark, tmp_path):
    rows = spark.createDataFrame([("d", 1, 1, "b"), ("d", 1, 0, "a"), ("e", 2, 0, "c")], "doc string, page_no int, idx int, text string")
    sinks.write_pages(rows, f"{tmp_path}/out")
    got = sorted(p.read_text() for p in (tmp_path / "out").rglob("part-*.txt"))
    assert got == ['{"idx":0,"text":"a"}\n{"idx":1,"text":"b"}\n', '{"idx":0,"text":"c"}\n']


def test_push_rows(spark, tmp_path):
    def send(batch):
        with open(f"{tmp_path}/{batch[0]['k']}", "w") as f:
            f.write(str(len(batch)))

    sinks.push_rows(spark.range(7).select(F.col("id").alias("k")).coalesce(1), send, size=3)
    assert sorted((p.name, p.read_text()) for p in tmp_path.iterdir()) == [("0", "3"), ("3", "3"), ("6", "1")]


VERSES = "धर्मक्षेत्रे कुरुक्षेत्रे समवेता युयुत्सवः ।\nमामकाः पाण्डवाश्चैव किमकुर्वत सञ्जय १॥\nदृष्ट्वा तु पाण्डवानीकं व्यूढं दुर्योधनस्तदा ।\nआचार्यमुपसङ्गम्य राजा वचनमब्रवीत् २॥"


def test_ingest_translate_heal(spark, tmp_path):
    pages = spark.createDataFrame([("gita", 1, 0, VERSES), ("gita", 1, 1, "अर्जुन उवाच ॥"), ("gita", 2, 0, " ")], "doc string, page_no int, line int, text string")
    catalog = Catalog(spark, f"{tmp_path}/catalog")
    pipelines.ingest(catalog, pages)
    first = catalog.read("passages").orderBy("page_no", "idx").collect()
    assert [(r.idx, r.verse_ref) for r in first] == [(0, "1"), (1, "2"), (2, None)] and first[0].iast.startswith("dharmakṣetre")
    cache = translate.with_cache_key(spark.createDataFrame([], "text string, output string"), "e", "sa", "en").select(*translate.CACHE_KEYS, "text", "output")
    catalog.write("mt_cache", cache)
    answers = lambda messages: ["On the field of righteousness they stood, eager for war and ready to fight. " + str(len(m)) for m in messages]
    pipelines.translate_document(catalog, "gita", answers, "dict")
    done = catalog.read("passages").orderBy("idx").collect()
    assert all(r.translation and r.engine == "dict" for r in done) and catalog.read("mt_cache").count() == 3
    # again: nothing is open, and a re-ingest leaves translations alone
    pipelines.ingest(catalog, pages)
    assert catalog.read("passages").orderBy("idx").collect() == done
    texts = {r.translation for r in done}
    pipelines.heal(catalog, below=2.0)
    kept = {r.translation for r in catalog.read("translation_history").collect()} | {r.translation for r in catalog.read("passages").collect()}
    assert texts <= kept and catalog.read("passages").filter(~T.is_blank(F.col("translation"))).count() == 0
    catalog.prune("passages", 1)
    assert len(catalog.versions("passages")) == 1


def test_advance_whole_corpus(spark, tmp_path):
    pages = spark.createDataFrame([("gita", 1, 0, VERSES), ("atha", 1, 0, VERSES), ("gita", 2, 0, "अर्जुन उवाच महाबाहो केशव माधव ॥ राम ॥")], "doc string, page_no int, line int, text string")
    catalog = Catalog(spark, f"{tmp_path}/catalog")
    answers = lambda messages: ["On the field of righteousness they stood, eager for war and ready to fight. " + str(len(m)) for m in messages]
    catalog.write("budget_settings", spark.createDataFrame([(0, "set", 0.0)], pipelines.SETTINGS))
    name = "openai:gpt-4o"
    assert pipelines.advance(catalog, pages, answers, name, f"{tmp_path}/one", ["gita"])  # there is nothing to spend
    assert catalog.read("usage_ledger").count() == 0 and catalog.read("budget_settings").count() == 2
    assert pipelines.translate_open(catalog, answers, name)  # a pause stands
    catalog.write("budget_settings", catalog.read("budget_settings").unionByName(spark.createDataFrame([(5, "set", 1.0)], pipelines.SETTINGS)))
    assert not pipelines.advance(catalog, pages, answers, name, f"{tmp_path}/two", ["gita"])
    rows = catalog.read("passages").collect()
    assert all(r.translation.startswith("On the field") and r.engine == name for r in rows if r.text_type == "mula")
    log = catalog.read("usage_ledger").collect()
    assert [(r.passages, r.kind, r.engine) for r in log] == [(4, "translation", name)]  # verses that both books have are sent once
    assert catalog.read("mt_cache").count() == 4
    assert not pipelines.translate_open(catalog, answers, name) and catalog.read("usage_ledger").count() == 1
    written = "".join(p.read_text() for p in sorted((tmp_path / "two").glob("doc=gita/*.txt")))
    assert written.startswith("<div class='titlepage'>") and written.count("On the field") == len([r for r in rows if r.doc == "gita" and r.translation])


def test_streams(spark, tmp_path):
    src = tmp_path / "events"
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts", "event_type", "value")
    events.orderBy("ts").repartitionByRange(3, "ts").write.parquet(str(src))
    stream = intake.hourly_usage(spark.readStream.schema(events.schema).parquet(str(src)), late="365 days")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("hourly").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(str, spark.table("hourly").collect())) == sorted(map(str, intake.hourly_usage(events).collect()))


def test_inbox_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        put(tmp_path / "in" / f"doc_{k:04d}.jsonl", {"text": f"t{k}"}, "bad")
    seen = {}

    def apply(batch, number):
        seen[number] = sorted(r.text for r in batch.collect())

    intake.upsert_stream(intake.inbox(spark, f"{tmp_path}/in", 1), apply, f"{tmp_path}/cp").awaitTermination()
    assert sorted(t for v in seen.values() for t in v) == ["t0", "t1", "t2"] and len(seen) == 3


def test_inbox_is_ingested_once(spark, tmp_path):
    catalog, box = Catalog(spark, f"{tmp_path}/catalog"), tmp_path / "in"
    box.mkdir()
    put(box / "gita_0001.jsonl", {"text": VERSES})
    for _ in range(2):
        pipelines.ingest_inbox(catalog, str(box), f"{tmp_path}/cp")
    put(box / "gita_0002.jsonl", {"text": "अर्जुन उवाच ॥"}, {"text": "राम ॥"})
    pipelines.ingest_inbox(catalog, str(box), f"{tmp_path}/cp")
    got = catalog.read("passages").orderBy("page_no", "idx").collect()
    assert [(r.doc, r.page_no, r.idx) for r in got] == [("gita", 1, 0), ("gita", 1, 1), ("gita", 2, 0), ("gita", 2, 1)]


def test_streak_state(spark, tmp_path):
    rows = spark.createDataFrame([("d", k >= 4, k) for k in range(6)] + [("e", False, 0)], "doc string, ok boolean, seq long")
    rows.repartition(2).write.parquet(f"{tmp_path}/in")
    stream = intake.streak_states(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), 3)
    q = stream.writeStream.outputMode("update").format("memory").queryName("streaks").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r.doc: (r.failures, r.aborted) for r in spark.table("streaks").collect()}
    assert got == {"d": (0, True), "e": (1, False)}


def test_streaks_say_what_comes_late(spark, tmp_path):
    schema, seen = "doc string, ok boolean, seq long", []
    for k, part in enumerate([[("d", False, 1), ("d", False, 2)], [("d", True, 2), ("d", False, 0), ("d", False, 3)]]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = intake.streak_states(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), 3)
        keep = lambda batch, _: seen.extend(batch.collect())
        query = stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        query.awaitTermination()
        assert (seen[-1].failures, seen[-1].aborted, seen[-1].late) == [(2, False, 0), (3, True, 2)][k]
