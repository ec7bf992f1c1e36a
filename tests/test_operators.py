import pytest
from pyspark.sql import functions as F

from scriptorium.functions.profiles import DEVA
from scriptorium.operators import gazetteer, reports, segment, sinks, translate, upsert

DEMO = """
        धर्मक्षेत्रे कुरुक्षेत्रे समवेता युयुत्सवः ।
        मामकाः पाण्डवाश्चैव किमकुर्वत सञ्जय ॥ १ ॥
        दृष्ट्वा तु पाण्डवानीकं व्यूढं दुर्योधनस्तदा ।
        आचार्यमुपसङ्गम्य राजा वचनमब्रवीत् ॥ २ ॥
"""


def pages(spark, *texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "page int, norm string")


def test_segment_demo(spark):
    from scriptorium.functions import text as T

    rows = pages(spark, DEMO).withColumn("norm", T.normalize_verses(F.col("norm")))
    got = segment.segment_pages(rows, ["page"]).orderBy("idx").collect()
    assert [(r.idx, r.verse_ref, r.text_type, r.text[-1]) for r in got] == [(0, None, "mula", "॥"), (1, None, "mula", "॥")]
    assert got[0].padas == 3 and got[0].chandas == "anustubh"


def test_segment_pairs_prose_and_fallback(spark):
    got = segment.segment_pages(pages(spark, "अ । ब । स ।", "केवलं गद्यं", "...!", " ", None), ["page"]).orderBy("page", "idx").collect()
    by_page = {}
    for r in got:
        by_page.setdefault(r.page, []).append((r.text, r.text_type))
    assert by_page[0] == [("अ ।\nब ।", "mula"), ("स ।", "mula")]
    assert by_page[1] == [("केवलं गद्यं", "mula")]
    assert by_page[2] == [("...!", "prose")]
    assert set(by_page) == {0, 1, 2}


def test_chapter_is_carried(spark):
    text = "क अध्याय १ २ ख ॥ ग ॥ सर्गः ॥ घ ॥"
    got = segment.segments(pages(spark, "आदौ ॥ " + text), ["page"]).orderBy("pos").collect()
    assert [r.chapter for r in got] == ["2", "2", "2", "सर्गः", "सर्गः"]


def test_resegment(spark):
    rows = spark.createDataFrame([("d", 1, "[Head] COLLECTION रामः वनं गच्छति १\nसीता अपि ॥ २ ॥\nabc def\nलक्ष्मणः")], "doc string, page int, text string")
    got = segment.resegment(rows, "doc", "page", "text").orderBy("pos").collect()
    assert [(r.text, r.verse_ref) for r in got] == [("रामः वनं गच्छति", "1"), ("सीता अपि", "2"), ("abc def\nलक्ष्मणः", None)]


def test_line_blocks(spark):
    rows = spark.createDataFrame([(1, k, c) for k, c in enumerate("HmHmmH", 1)], "doc int, n int, line string")
    got = segment.line_blocks(rows, ["doc"], "n", "line", F.col("line") == "H", 1).orderBy("block").collect()
    assert [(r.first_line, r.n_lines) for r in got] == [(1, 2), (6, 1)]


def test_greedy_chunks(one):
    lines = F.array(*map(F.lit, ["aaaa", "bbb", "cc", "ddddddd", "e"]))
    assert one(segment.greedy_chunks(lines, 10)) == ["aaaa\nbbb", "cc", "ddddddd\ne"]
    lines = F.array(*map(F.lit, ["a", "# H", "b", "", "c", "d" * 20]))
    assert one(segment.greedy_chunks(lines, 10)) == ["a", "# H", "b", "c", "d" * 20]
    assert one(segment.greedy_chunks(lines, 10, keep=0.03)) == ["# H"]


def test_upsert_keeps_translations(spark):
    schema = "doc string, page_no int, idx int, text string, norm string, iast string, chapter string, translation string"
    old = spark.createDataFrame([("d", 1, 0, "old", "n", "i", "1", "T"), ("d", 1, 9, "gone", "n", "i", None, "U")], schema)
    new = spark.createDataFrame([("d", 1, 0, "new", "n2", "i2", None, None), ("d", 1, 1, "more", "n2", "i2", "2", None)], schema)
    got = {r.idx: r for r in upsert.upsert_passages(old, new).collect()}
    assert (got[0].text, got[0].chapter, got[0].translation) == ("new", "1", "T")
    assert (got[1].text, got[1].chapter, got[9].translation) == ("more", "2", "U")
    again = upsert.upsert_passages(upsert.upsert_passages(old, new), new)
    assert sorted(again.collect(), key=str) == sorted(got.values(), key=str)


def test_adapt(spark):
    rows = spark.createDataFrame([("7", "x", "extra")], "pageno string, san string, other string")
    got = upsert.adapt(rows, {"page_no": "int", "text": "string", "translation": "string"}, upsert.ALIASES).first()
    assert got.asDict() == {"page_no": 7, "text": "x", "translation": None}


def test_context(spark):
    rows = spark.createDataFrame([("d", k, f"t{k}" if k != 2 else None) for k in range(6)], "doc string, n int, t string")
    got = translate.preceding(rows, "doc", ["n"], F.col("t"), 2, F.col("t").isNotNull()).orderBy("n").collect()
    assert [r.context for r in got] == [[], ["t0"], ["t0", "t1"], ["t0", "t1"], ["t1", "t3"], ["t3", "t4"]]


def test_budget_latches(spark):
    rows = spark.createDataFrame([(k, c) for k, c in enumerate([5.0, 2.0, 2.0, 0.5])], "n int, cost double")
    got = translate.budget_gate(rows, "n", "cost", 8.0, width=2).orderBy("n").collect()
    assert [r.accepted for r in got] == [True, True, False, False]


def test_budget_by_account(spark):
    rows = spark.createDataFrame([(a, k, c) for a in ("x", None) for k, c in enumerate([5.0, 2.0, 2.0, 0.5])] + [("y", 0, 1.0)], "a string, n int, cost double")
    got = translate.budget_gate(rows, "n", "cost", 8.0, ["a"], 3).orderBy("a", "n").collect()
    assert [r.accepted for r in got] == [True, True, False, False] * 2 + [True]
    assert [r.spent for r in got] == [5.0, 7.0, 9.0, 9.5] * 2 + [1.0]
    calm = translate.budget_gate(rows.filter("a = 'y'"), "n", "cost", 8.0).collect()
    assert [r.accepted for r in calm] == [True]


def test_failure_streaks(spark):
    rows = spark.createDataFrame([("d", k, x == "o") for k, x in enumerate("foffof")], "doc string, n int, ok boolean")
    got = translate.failure_streaks(rows, ["doc"], ["n"], F.col("ok"), 2).orderBy("n").collect()
    assert [r.streak for r in got] == [1, 0, 1, 2, 0, 1] and [r.aborts for r in got].count(True) == 1


def table_of(spark):
    return spark.createDataFrame(
        [("a", "d", "src", "A fine text.", "e", 0.9, "v2"), ("b", "d", "src", "Weak.", "e", 0.2, ""), ("c", "d", "src", None, None, None, None)],
        "key string, doc string, text string, translation string, engine string, translation_qa double, mt_prompt_version string",
    )


def test_history_loses_nothing(spark):
    rows = table_of(spark)
    history, cleared = translate.archive_and_clear(rows, translate.retranslate_pick(rows, below=0.6))
    before = {r.translation for r in rows.collect() if r.translation}
    after = {r.translation for r in history.collect()} | {r.translation for r in cleared.collect() if r.translation}
    assert before == after and [r.reason for r in history.collect()] == ["qa<0.6"]
    with pytest.raises(ValueError):
        translate.retranslate_pick(rows)
    new = spark.createDataFrame([("a", "Better.", "e2", 1.0, "v3")], "key string, translation string, engine string, translation_qa double, mt_prompt_version string")
    history, updated = translate.supersede(rows, new)
    assert [r.translation for r in history.collect()] == ["A fine text."]
    assert {r.key: r.translation for r in updated.collect()} == {"a": "Better.", "b": "Weak.", "c": None}


def test_cache_admits_no_junk(spark):
    rows = translate.with_cache_key(spark.createDataFrame([("x", "A fine text.", 0), ("y", "n/a", 1), ("x", "Another text.", 2), ("z", " ", 3)], "text string, output string, n int"), "e", "sa", "en")
    empty = rows.limit(0).select(*translate.CACHE_KEYS, "text", "output")
    got = translate.admit(empty, rows, "n").collect()
    assert [(r.text, r.output) for r in got] == [("x", "A fine text.")]


def test_translate_hits_misses_and_stitching(spark):
    rows = spark.createDataFrame(
        [(str(k), "d", 1, k, t, None, []) for k, t in enumerate(["क क", "ख ख", "क क"])],
        "key string, doc string, page_no int, idx int, text string, iast string, context array<struct<verse_ref: string, translation: string>>",
    )
    cache = translate.with_cache_key(spark.createDataFrame([("ख ख", "From the cache.")], "text string, output string"), "dict", "sa", "en")
    asked = []

    def engine(messages):
        asked.extend(messages)
        return ["Answer to the verse." for _ in messages]

    got = {r.key: (r.output, r.hit) for r in translate.translate(rows, cache, engine, "dict").collect()}
    assert got == {"0": ("Answer to the verse.", False), "1": ("From the cache.", True), "2": ("Answer to the verse.", False)}


def test_echo_engine_is_not_admitted(spark):
    rows = translate.run_engine(spark.createDataFrame([("क",)], "m string"), translate.echo_engine, "m")
    assert rows.first().output == "[ECHO] क"
    assert not rows.select(translate.admissible(F.col("m"), F.col("output")).alias("ok")).first().ok


def test_summary_identities(spark):
    got = reports.qa_summary(table_of(spark)).first()
    assert got.total == got.translated + got.pending and got.b0 + got.b1 + got.b2 + got.b3 + got.b4 == got.scored


def test_systematic_sample(spark):
    rows = spark.createDataFrame([("g", k) for k in range(10)] + [("h", k) for k in range(3)], "g string, n int")
    got = reports.systematic_sample(rows, ["g"], "n", 4, 3).collect()
    assert sorted(r.n for r in got if r.g == "g") == [0, 2, 5, 7] and len([r for r in got if r.g == "h"]) == 3
    for total in (5, 7, 23):
        rows = spark.createDataFrame([("g", k) for k in range(total)], "g string, n int")
        for n in (1, 3, 4, 6):
            want = sorted({k * total // n for k in range(n)}) if total > n else list(range(total))
            assert sorted(r.n for r in reports.systematic_sample(rows, ["g"], "n", n, 4).collect()) == want


def test_search_grammar(spark):
    rows = spark.createDataFrame([(1, "the red fox"), (2, "The blue bird"), (3, None), (4, "red bird")], "k int, t string")
    found = lambda q: sorted(r.k for r in rows.filter(reports.matches(["t"], q)).collect())
    assert found("red") == [1, 4] and found("red bird") == [4] and found("red OR blue") == [1, 2, 4]
    assert found("the NOT red") == [2] and found('"blue bird"') == [2] and found("(red OR blue) AND bird") == [2, 4] and found("re") == []
    with pytest.raises(ValueError):
        reports.matches(["t"], "(red")


def test_ranges(spark):
    rows = spark.createDataFrame([(k,) for k in range(0, 300, 7)], "page int")
    ranges = spark.createDataFrame([("a", 10, 50), ("b", 200, 60), ("c", 5, 5)], "run string, page_from int, page_to int")
    got = {(r.page, r.run) for r in reports.in_ranges(rows, ranges, "page").collect()}
    assert got == {(p, n) for p in range(0, 300, 7) for n, a, b in (("a", 10, 50), ("b", 60, 200), ("c", 5, 5)) if a <= p <= b}


def test_gazetteer(spark):
    entries = spark.createDataFrame([(0, "कुरु", "TRIBE", ["कौरव"]), (1, "गङ्गा", "RIVER", None)], "gaz_index int, surface string, type string, aliases array<string>")
    rows = spark.createDataFrame([(1, "कुरु गङ्गा कुरु"), (2, None), (3, "x")], "k int, t string")
    got = gazetteer.find_entities(rows, "k", "t", gazetteer.forms(entries)).orderBy("start").collect()
    assert [(r.k, r.start, r.end, r.label) for r in got] == [(1, 0, 4, "TRIBE"), (1, 5, 10, "RIVER"), (1, 11, 15, "TRIBE")]
    merged = gazetteer.merge(entries, spark.createDataFrame([("कुरु", "LOC"), ("काशी", "LOC")], "surface string, type string"))
    assert sorted(r.surface for r in merged.collect()) == sorted(["कुरु", "गङ्गा", "काशी"])
    nodes, edges = gazetteer.alias_graph(entries)
    assert {r.id for r in nodes.collect()} == {"कुरु", "कौरव", "गङ्गा"} and edges.count() == 1
    lines = [r.value for r in sinks.graphml(nodes, edges).collect()]
    assert lines[0].startswith("<?xml") and lines[-1] == "</graph></graphml>" and len(lines) == 6


def test_guess_kind(spark):
    given = ["name of a people and a city", "a capital", "Nadī of the north", "a parvata", "peoples", None]
    rows = spark.createDataFrame(list(enumerate(given)), "k int, e string")
    got = rows.select("k", gazetteer.guess_kind(F.col("e")).alias("t")).orderBy("k").collect()
    assert [r.t for r in got] == ["TRIBE", "LOC", "RIVER", "MOUNTAIN", None, None]


def test_intake(spark):
    from scriptorium.operators import intake

    reader = lambda content, dpi, lang, preproc, psm: " x " * 10 if dpi == 450 and content == b"b" else "y"
    got = {r.path: r for r in intake.read_scans(spark.createDataFrame([("a", b"a"), ("b", b"b")], "path string, content binary"), reader).collect()}
    assert got["a"].text == "y" and got["b"].dpi == 450 and len(got["b"].text) >= 20
    assert intake.read_scans(spark.createDataFrame([("a", b"a")], "path string, content binary")).first().text == ""
    skips = spark.createDataFrame([([3, 1], [2, 3]), (None, [1])], "a array<bigint>, b array<bigint>")
    assert sorted(r.s for r in skips.select(intake.merge_skips(F.col("a"), F.col("b")).alias("s")).collect()) == [[1], [1, 2, 3]]
    found = spark.range(1).select(intake.analyse(F.lit("रामः।सीता")).alias("v")).first().v
    assert found.normalized == "रामः । सीता" and found.clauses == [["रामः"], ["सीता"]]
    pages = spark.createDataFrame([("p",), ("q",)], "slug string")
    assert intake.pages_of(pages, ["p"]).count() == 1
    with pytest.raises(LookupError):
        intake.pages_of(pages, ["p", "z"])


def test_corpus_tree(spark, tmp_path):
    from scriptorium.operators import intake

    for name in ("veda/a.pdf", "veda/b.pdf", "purana/c.pdf", "purana/d.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"12")
    assert {r.category: (r.n_files, r.bytes) for r in intake.corpus_tree(spark, str(tmp_path)).collect()} == {"veda": (2, 4), "purana": (1, 2)}


def test_edition(spark):
    rows = spark.createDataFrame(
        [("d", 1, 0, "1", "1.1", "क", "ka", "First [i.e., one two] //"), ("d", 1, 1, "1", "1.2", "ख", None, "Second [see also this]"), ("d", 2, 0, "पर्व", None, "ग", None, "[lake] x")],
        "doc string, page_no int, idx int, chapter string, verse_ref string, text string, iast string, translation string",
    )
    got = sinks.edition(rows).collect()
    assert [(r.section, r.seq) for r in got] == [("chapter:1", 0), ("chapter:1", 1), ("chapter:1", 2), ("page:2", 0), ("page:2", 1)]
    assert "fn-1" in got[1].fragment and "fn-2" in got[2].fragment and "(lake) x" in got[4].fragment
    notes = sinks.numbered_notes(rows, ["doc"], ["page_no", "idx"], "translation").orderBy("number").collect()
    assert [(n.number, n.note) for n in notes] == [(1, "i.e., one two"), (2, "see also this")]


def test_sheets_and_diffs(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "a", "z")], "k int, engine string, output string")
    assert {r.k: (r.a, r.b) for r in sinks.benchmark_sheet(rows, "k", ["a", "b"]).collect()} == {1: ("x", "y"), 2: ("z", None)}
    diff = sinks.style_diff(spark.createDataFrame([(1, "the bargad"), (2, "same")], "k int, en string"), "k", "en").collect()
    assert [(r.k, r.rule_hits, r.new_en) for r in diff] == [(1, "terms:common", "the banyan")]


def test_no_ascii_classes_in_profiles():
    for name, value in vars(DEVA).items():
        assert "\\w" not in value and "\\d" not in value, name


def test_shared_folder_is_asked_for_on_a_cluster(spark):
    from types import SimpleNamespace

    from scriptorium.session import Durable, shared_dir

    def with_conf(master, folder=None):
        conf = SimpleNamespace(get=lambda key: folder)
        return SimpleNamespace(sparkContext=SimpleNamespace(master=master, getConf=lambda: conf))

    assert shared_dir(with_conf("local[4]")).startswith("file:") and shared_dir(with_conf("local")).startswith("file:")
    assert shared_dir(with_conf("spark://x:1", "hdfs://a/b/")) == "hdfs://a/b"
    for master in ("spark://x:1", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            shared_dir(with_conf(master))
    store = Durable(spark, "test")
    saved = [store.save(spark.range(3)), store.save(spark.range(4))]
    store.drop(saved[0])
    assert saved[1].count() == 4
    store.clear()
    with pytest.raises(Exception):
        spark.read.parquet(f"{store.root}/002")


def test_entities_in_both_plans(spark):
    texts = ["rāma rāmāyaṇa", "", None, "x" * 50, "ab abc abcd b", "ab abc abcd b"]
    entries = spark.createDataFrame([(0, "rāma", "PER", ["rām"]), (1, "abc", "X", ["ab", "b"]), (2, "abc", "Y", None), (3, "xxx", "Z", ["", None])], "gaz_index int, surface string, type string, aliases array<string>")
    known = gazetteer.forms(entries)
    rows = spark.createDataFrame(list(enumerate(texts)), "k long, t string").withColumn("form", F.lit(1)).withColumn("start", F.lit(2))
    want = sorted(
        (k, i, i + len(f.form), f.form, f.label, f.gaz_index)
        for k, t in enumerate(texts) for f in known.collect() for i in range(len(t or "")) if (t or "").startswith(f.form, i)
    )
    for most in (100, 0):
        got = gazetteer.find_entities(rows, "k", "t", known.union(known), max_forms=most)
        assert sorted((r.k, r.start, r.end, r.form, r.label, r.gaz_index) for r in got.collect()) == want
    assert gazetteer.find_entities(rows, "k", "t", known.limit(0)).count() == 0


def test_one_row_for_each_key(spark):
    old = spark.createDataFrame([(1, None, "o")], "k int, t string, v string")
    new = spark.createDataFrame([(1, None, "n"), (None, "a", "p"), (None, "a", "q"), (2, "", "r"), (2, None, "s")], "k int, t string, v string")
    assert sorted(r.v for r in upsert.first_wins(old, new, ["k", "t"], "v").collect()) == ["o", "p", "r", "s"]
    assert sorted(r.v for r in upsert.last_wins(new, ["k", "t"], "v").collect()) == ["n", "q", "r", "s"]
    twice = spark.createDataFrame([(1, "x", "b"), (1, "x", "a"), (5, "y", "c")], "k int, t string, v string")
    got = upsert.upsert(old.fillna("x"), twice, ["k", "t"], replace=["v"]).collect()
    assert sorted((r.k, r.v) for r in got) == [(1, "a"), (5, "c")]
    assert reports.first_seen(new, ["k"], ["v"]).count() == 3


@pytest.mark.parametrize("width", [None, 1, 3, 7, 1000])
def test_streaks_in_blocks(spark, width):
    import random

    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), k, rng.random() < 0.3, 5) for k in range(200)]
    want, runs = {}, {}
    for doc, n, ok, _ in rows:
        runs[doc] = want[n] = 0 if ok else runs.get(doc, 0) + 1
    frame = spark.createDataFrame(rows, "doc string, n long, ok boolean, streaky int")
    got = translate.failure_streaks(frame, ["doc"], ["n"], F.col("ok"), 4, width)
    assert {r.n: r.streak for r in got.collect()} == want and all(r.aborts == (r.streak >= 4) for r in got.collect())
    assert got.columns == [*frame.columns, "streak", "aborts"]


def test_postings(spark):
    from scriptorium.operators import search

    rows = spark.createDataFrame([(1, "Alpha beta", "x"), (2, "alphabet", None), (3, None, "ab"), (4, "", "BETA max"), (5, "ééé alp", "ha")], "k long, a string, b string")
    table = search.postings(rows, "k", ["a", "b"])
    for query in ("alpha", "beta", "ab", "a b", "ééé", "alpha beta", "zzz", "ha b"):
        want = sorted(r.k for r in rows.filter(reports.contains(["a", "b"], query)).collect())
        assert sorted(r.k for r in search.search(rows, table, "k", ["a", "b"], query).collect()) == want, query
    changed = spark.createDataFrame([(1, "gamma", None), (9, "alpha", None), (4, None, None)], rows.schema)
    now = rows.join(changed, "k", "left_anti").union(changed)
    got = search.refresh(table, changed, "k", ["a", "b"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, search.postings(now, "k", ["a", "b"]).collect()))


def test_few_splits_are_spread(spark, tmp_path, capsys):
    from scriptorium.session import spread

    spark.range(1000).selectExpr("id", "id % 7 as k", "cast(id as string) as t").coalesce(1).write.parquet(f"{tmp_path}/one")
    one = spark.read.parquet(f"{tmp_path}/one")
    cores = spark.sparkContext.defaultParallelism
    assert one.rdd.getNumPartitions() < cores == spread(one).rdd.getNumPartitions()
    assert sorted(r.id for r in spread(one).collect()) == list(range(1000))
    spread(one).filter("k = 3").select("id").explain()
    plan = capsys.readouterr().out
    assert "PushedFilters: [IsNotNull(k), EqualTo(k,3)]" in plan and "t:string" not in plan
    assert spread(one.repartition(cores + 3)).rdd.getNumPartitions() == cores + 3
    assert spread(one, most=0).rdd.getNumPartitions() == one.rdd.getNumPartitions()
