"""SimHash, packing, decontamination, HTML: each against plain Python."""

import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from scriptorium.llm import decontaminate as D
from scriptorium.llm import html_extract as H
from scriptorium.llm import packing as P
from scriptorium.llm import simhash as S
from scriptorium.llm import words as W
from scriptorium.session import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], DOCS)


# --- simhash


def fingerprint_brute(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(monkeypatch):
    rng = random.Random(1)
    texts = [None, "", " \t", "A", "a b", "A b\tC d É\x0be", "x " * 50] + [" ".join(rng.choices(["Ab", "c", "Dé", "\u00a0", "\n"], k=rng.randint(0, 40))) for _ in range(200)]
    for t in texts:
        assert S.fingerprint(t) == fingerprint_brute(t)
    monkeypatch.setattr(S, "word_blocks", lambda d, c: W.word_blocks(d, c, 9))
    for t in texts:
        assert S.fingerprint(t) == fingerprint_brute(t), t


def test_masks_cover_every_pair_within_the_radius():
    levels, rng = S.mask_levels(), random.Random(2)
    for _ in range(500):
        x = y = rng.getrandbits(64)
        for b in rng.sample(range(64), rng.randint(0, 3)):
            y ^= 1 << b
        first = [k for k, m in enumerate(levels[0]) if x & m == y & m]
        assert first
        for k in first:
            second = [j for j in range(15 * k, 15 * k + 15) if x & levels[1][j] == y & levels[1][j]]
            assert second and all(any(x & levels[2][i] == y & levels[2][i] for i in range(15 * j, 15 * j + 15)) for j in second)
    assert max(64 - m.bit_count() for m in levels[2]) <= 8


def groups(labels):
    out = {}
    for k, v in labels.items():
        out.setdefault(v, set()).add(k)
    return sorted(map(sorted, out.values()))


def brute_components(fps):
    label = {f: f for f in fps}
    changed = True
    near = {a: [b for b in fps if (a ^ b).bit_count() <= 3] for a in fps}
    while changed:
        changed = False
        for a in fps:
            least = min(label[b] for b in near[a])
            if least < label[a]:
                label[a], changed = least, True
    return label


@pytest.mark.parametrize("largest", [256, 4])
def test_components_against_brute_force(spark, largest):
    from scriptorium.session import Durable

    rng, fps = random.Random(3), set()
    for _ in range(25):
        centre = rng.getrandbits(64)
        for _ in range(rng.randint(1, 25)):
            y = centre
            for b in rng.sample(range(64), rng.randint(0, 5)):
                y ^= 1 << b
            fps.add(y)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    store = Durable(spark, "test")
    found = S.edges(spark.createDataFrame([(signed(x),) for x in fps], "fp long"), store, largest)
    roots = {r.node: r.root for r in S.components(found, store).collect()}
    assert groups({x: roots.get(signed(x), signed(x)) for x in fps}) == groups(brute_components(sorted(fps)))


def test_chain_of_links(spark):
    from scriptorium.session import Durable

    chain = [(k, k + 1) for k in range(40)]
    roots = S.components(spark.createDataFrame(chain, "a long, b long"), Durable(spark, "test")).collect()
    assert len(roots) == 41 and {r.root for r in roots} == {0}


def test_near_duplicates_odd_rows(spark):
    rows = [(5, "One two three four"), (3, "one TWO three four"), (9, None), (8, ""), (7, " \n"), (3, "one TWO three four"), (None, "one two three four"), (11, "else")]
    docs = docs_of(spark, rows).withColumn("fp", F.lit("x")).withColumn("component_id", F.lit("y"))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in S.near_duplicates(docs).collect())
    assert got == [(False, 3, 3), (False, 3, 3), (False, 5, 3), (False, 7, 7), (False, 8, 7), (False, 9, 7), (False, 11, 11), (True, 0, 3)]
    kept = S.deduplicate(docs)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 3), (False, 7), (False, 11), (True, 0)]
    assert kept.columns == docs.columns
    assert S.near_duplicates(docs_of(spark, [])).count() == 0 and S.deduplicate(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("rows_broadcast", [500_000, 0])
def test_rows_are_judged_one_by_one(spark, rows_broadcast):
    same, other = "a b c d e f g", "some other words of a text"
    rows = [(1, same, "x"), (3, same, "x"), (3, other, "y"), (3, other, "z"), (3, other, None), (4, other, "y"), (5, "alone", "u"), (5, "alone", "u"), (None, same, "x"), (None, same, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root string").withColumn("k0", F.lit(1)).withColumn("n", F.lit(None).cast("int"))
    kept = S.deduplicate(docs, broadcast_rows=rows_broadcast)
    got = sorted((r.doc_id or 0, r.text) for r in kept.collect())
    assert got == [(0, same), (0, same), (1, same), (3, other), (5, "alone")] and kept.columns == docs.columns
    again = S.deduplicate(docs.repartition(3), broadcast_rows=rows_broadcast)
    assert sorted(map(str, again.collect())) == sorted(map(str, kept.collect()))


def test_simhash_query_against_brute_force(spark):
    from scriptorium.llm.queries import op4_simhash

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    fps = {k: fingerprint_brute(t) for k, t in texts.items()}
    label = brute_components(sorted(set(fps.values())))
    least = {}
    for k, f in fps.items():
        least[label[f]] = min(least.get(label[f], k), k)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op4_simhash(spark, sf).collect()}
    assert got == {k: (f"{f:016x}", least[label[f]]) for k, f in fps.items()}


# --- packing


def test_fill_is_closest():
    rng = random.Random(4)
    for _ in range(300):
        counts = {rng.randint(1, 30): rng.randint(1, 4) for _ in range(rng.randint(0, 5))}
        capacity = rng.randint(1, 60)
        sums = {0}
        for length, many in counts.items():
            sums = {s + length * k for s in sums for k in range(many + 1) if s + length * k <= capacity}
        taken = P.fill(counts, capacity)
        assert all(many <= counts[length] for length, many in taken.items())
        assert sum(length * many for length, many in taken.items()) == max(sums)


def check_packing(rows, ids_of, capacity=4096):
    windows, docs = {}, {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault(r.doc_id, []).append(r)
    padding = 0
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    for doc, pieces in docs.items():
        ids, at = ids_of[doc], 0
        for r in sorted(pieces, key=lambda r: r.start):
            part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert r.start == at and r.ids_crc32 == zlib.crc32(part) and r.doc_tokens == len(ids)
            at += r.length
        assert at == len(ids)
    assert set(docs) == set(ids_of)
    return padding


def test_packing_odd_texts(spark):
    texts = ["", None, "it's They'LL 's 'd don''t", "<|endoftext|> hi", "naïve Ǆ ſoft K", "a\x1cb", "a\x85b ¡¿ « 12 3/4", "x" * 5000 + " y", "Ünïcödé ß ÿ Ÿ", "''s '''re", "a\x00b", "e\u0301 é", "word " * 9000, "日本 " * 3000, "the the"]
    library = P.Encoder(P.model_path("word_bpe_49k.json")).library
    docs = docs_of(spark, list(enumerate(texts))).withColumn("start", F.lit("x")).repartition(2)
    rows = P.pack(docs).collect()
    assert check_packing(rows, {k: library.encode(t or "", add_special_tokens=False).ids + [2] for k, t in enumerate(texts)}) == 0
    rows = P.pack(docs, capacity=64, pool_tokens=500).collect()
    assert check_packing(rows, {k: library.encode(t or "", add_special_tokens=False).ids + [2] for k, t in enumerate(texts)}, 64) == 0
    assert P.pack(docs_of(spark, [])).count() == 0
    twice = P.pack(docs_of(spark, [(7, "the same text"), (7, "the same text"), (None, "the same text")]).withColumn("offset", F.lit("x"))).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in twice if r.start == 0) == [(False, 7), (False, 7), (True, 0)]
    assert sum(r.length for r in twice) == sum(r.doc_tokens for r in twice if r.start == 0)


def test_short_sequences_are_few(spark):
    docs = docs_of(spark, [(k, "word " * (k % 900)) for k in range(400)]).coalesce(1)
    sizes = [r.n for r in P.pack(docs).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()]
    assert all(n & (n - 1) == 0 for n in sizes) and sum(n < 4096 for n in sizes) <= 12


def test_packing_query(spark):
    from scriptorium.llm.queries import op6_packing

    sf = "/root/testdata/sf0.001"
    library = P.Encoder(P.model_path("word_bpe_49k.json")).library
    ids = {r.doc_id: library.encode(r.text, add_special_tokens=False).ids + [2] for r in table(spark, sf, "documents").collect()}
    assert check_packing(op6_packing(spark, sf).collect(), ids) == 0


def test_encoder_forgets_and_still_agrees(monkeypatch):
    monkeypatch.setattr(P, "CACHED", 10)
    encoder, rng = P.Encoder(P.model_path("word_bpe_49k.json")), random.Random(5)
    for _ in range(60):
        text = " ".join("".join(rng.choices("abcdé'!1", k=rng.randint(1, 9))) for _ in range(20))
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == encoder.ids(text)


# --- decontamination


def shingles(text):
    words = re.findall(r"\w+", (text or "").lower())
    width = min(5, len(words))
    return width, {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if words else set()


def containment_brute(docs, items):
    out = set()
    for d, text in docs:
        words = re.findall(r"\w+", (text or "").lower())
        for i, item in items:
            width, own = shingles(item)
            have = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}
            if own and 10 * len(own & have) >= 8 * len(own):
                out.add((d, i, len(own), len(own & have)))
    return out


@pytest.mark.parametrize("block", [1 << 20, 25])
def test_containments_against_brute_force(spark, monkeypatch, block):
    rng = random.Random(6)
    pool = [f"w{k}" for k in range(12)]
    items = [(k, " ".join(rng.choices(pool, k=rng.randint(0, 30)))) for k in range(25)] + [(90, None), (91, "w1"), (92, "w1 W2, w3!"), (92, "w1 W2, w3!")]
    docs = []
    for k in range(60):
        words = rng.choices(pool + ["zz"], k=rng.randint(0, 120))
        if k % 3 == 0:
            item = rng.choice(items)[1] or ""
            words[5:5] = [w if rng.random() > 0.03 else "yy" for w in item.upper().split()]
        docs.append((k, "  ".join(words) if k else None))
    index = D.Index.build([i for i in items], 0.8)
    monkeypatch.setattr(D, "BLOCK", block)
    got = {(d, *hit) for d, t in docs for hit in index.find(t, 0.8)}
    assert got == containment_brute(docs, items)
    if block > 100:
        table_of_items = spark.createDataFrame(items, "item_id long, text string")
        for size in (8 << 20, 200):  # one block of items, and several
            rows = D.containments(docs_of(spark, docs).withColumn("item_id", F.lit("x")), table_of_items, block_bytes=size).collect()
            assert {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in rows} == got
            kept = D.clean(docs_of(spark, docs), table_of_items, block_bytes=size)
            assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, *_ in got}
        empty = table_of_items.limit(0)
        assert D.containments(docs_of(spark, docs), empty).count() == 0 and D.clean(docs_of(spark, docs), empty).count() == len(docs)
        assert D.containments(docs_of(spark, []), table_of_items).count() == 0


def test_sketches_choose_the_candidates():
    rng = random.Random(8)
    pool = [f"w{k}" for k in range(4000)]
    items = [(k, " ".join(rng.choices(pool, k=rng.randint(5, 300)))) for k in range(300)]
    index = D.Index.build(items, 0.8)
    assert sum(len(v) for v in index.sketch.values()) < 0.5 * sum(len(i[2]) for i in index.items)  # most shingles are in no sketch
    found = picked = parts = 0
    for _ in range(200):
        key, text = rng.choice(items)
        words, share = text.split(), rng.choice([0.2, 0.5, 0.9, 1.0])
        part = words[: max(5, int(share * len(words)))]
        doc = " ".join(rng.choices(pool, k=500) + part + rng.choices(pool, k=500))
        exact = containment_brute([(0, doc)], [(key, text)])
        chosen = index.candidates(doc)
        assert {h[0] for h in index.find(doc, 0.8)} == {i for _, i, *_ in exact}  # other items have nothing in common with it
        found += bool(exact)
        picked += len(chosen)
        parts += 1
    # every contained item is a candidate, and the sketches rule out most of those that are there in part
    assert found <= picked < found + 0.5 * (parts - found)
    for n in range(1, 400):
        size, need = D.sketch_size(n, 0.8)
        assert 1 <= need <= size <= n and size - need == n - -(-8 * n // 10) == D.may_lack(n, 0.8)


def test_short_items_and_clashing_names(spark):
    items = spark.createDataFrame([(1, "yes", "x"), (2, "one two three four five six", "y"), (None, "seven eight nine ten eleven", "z")], "item_id long, text string, doc_id string")
    docs = spark.createDataFrame(
        [(1, "yes", 1), (1, "yes", 1), (2, "say one two three four five six", 2), (None, "Seven eight nine ten eleven.", 3), (4, None, 4), (5, "", 5)],
        "doc_id long, text string, item_id int",
    ).withColumn("row", F.lit(0)).withColumn("a", F.lit("b"))
    for size in (8 << 20, 1):
        got = sorted((r.doc_id or 0, r.item_id or 0, r.containment) for r in D.containments(docs, items, block_bytes=size).collect())
        assert got == [(0, 0, 1.0), (1, 1, 1.0), (1, 1, 1.0), (2, 2, 1.0)]
        kept = D.clean(docs, items, least=D.WIDTH, block_bytes=size)
        assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 1, 4, 5]
        assert sorted(r.doc_id for r in D.clean(docs, items, block_bytes=size).collect()) == [4, 5]


def test_decontamination_query(spark):
    from scriptorium.llm.queries import op9_decontaminate

    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    got = {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in op9_decontaminate(spark, sf).collect()}
    assert got == containment_brute(docs, items)


# --- HTML

LONG = "A sentence of some length, with a comma, that goes on for a while. And another one follows it."


@pytest.mark.parametrize("page,text", [
    (None, ""),
    ("", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<p>a<p>b <br>c<div>d", "a b c d"),
    ("<article><h1>T</h1><p><b>x<br><p>y</p></article><footer>&copy; z</footer>", "T x y"),
    ("<article><header><h1>T</h1><p>By me, today</p></header><p>Body <script>x<y</script>more</p><div class=share>Share!</div><section id='comments'><p>Hi.</p></section></article><p>out</p>", "T Body more"),
    (f"<body><div id=menu><a href=x>Home</a></div><div><h2>Head</h2><p>{LONG}</p><p>{LONG}</p></div><div class=box><a href=1>One link</a> <a href=2>Two links</a></div></body>", f"Head {LONG} {LONG}"),
    ("<p style='display:none'>hid</p><p>shown</p><!-- <p>no</p> -->", "shown"),
    ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
    ("<p>foo<b>bar</b>&nbsp;\n baz</p>", "foobar baz"),
    ("<main><p>In.</p><form><p>Your name</p></form><aside>Side.</aside><div class='cookie-notice'>We use cookies.</div></main>", "In."),
    ("<title>t</title><textarea>x</textarea><p>y", "y"),
    ("<p title='a>b'>x</p>", "x"),
])
def test_main_text(page, text):
    assert H.main_text(page) == text


def test_pages_against_their_articles(spark):
    import html

    from scriptorium.llm.queries import op10_html_extract

    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in table(spark, sf, "pages").collect()}
    for r in op10_html_extract(spark, sf).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.DOTALL)[1]
        want = html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", article)))
        assert r.text == " ".join(want.split()) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def scores_brute(blocks):
    """Scores by path of ``(path, text, links)``, a path being a tuple of elements; for pages without names or articles."""
    by = {}
    for path, text, links in blocks:
        by.setdefault(path, []).append((len(text), sum(c in ",.;:!?" for c in text), links))
    mean = lambda path, k: sum(x[k] for x in by[path]) / len(by[path])

    def median(k):
        weighted = sorted((mean(path, k), sum(x[0] - x[2] for x in by[path])) for path in by)
        at = np.cumsum([w for _, w in weighted])
        return weighted[int(np.searchsorted(at, at[-1] / 2))][0]

    length, marks = median(0), median(1)
    fused = {path: min(1, (mean(path, 0) / length) ** 0.5) * (1 + (min(1, (mean(path, 1) / marks) ** 0.5) if marks else 1)) / 2 for path in by}
    out = {}
    for path in by:
        around = []
        for k, (other, *_) in enumerate(blocks):
            if other == path:
                around += [blocks[j][0] for j in (k - 1, k + 1) if 0 <= j < len(blocks)]
        same = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        weights = [1.0 if q == path else same(path, q) / max(len(path), len(q)) for q in around]
        near = sum(w * fused[q] for w, q in zip(weights, around, strict=True)) / sum(weights) if sum(weights) else fused[path]
        share = sum(x[2] for x in by[path]) / sum(x[0] for x in by[path])
        out[path] = (0.7 * fused[path] + 0.3 * near) ** 2 * (1 - share) ** 2
    return out


def test_path_scores_against_brute_force():
    rng = random.Random(7)
    for _ in range(200):
        blocks, page, path = [], [], ["html", "body"]
        page.append("<html><body>")
        for _ in range(rng.randint(1, 40)):
            if rng.random() < 0.3 and len(path) < 6:
                path.append(rng.choice(["div", "section", "div.a", "blockquote"]))
                page.append("<" + path[-1].replace(".a", " class='a b'") + ">")
            elif rng.random() < 0.3 and len(path) > 2:
                page.append(f"</{path.pop().split('.')[0]}>")
            else:
                text = "".join(rng.choices("ab,.", k=rng.randint(1, 80)))
                linked = rng.random() < 0.3
                page.append("<p>" + (f"<a href='x'>{text}</a>" if linked else text) + "</p>")
                blocks.append(((*path, "p"), text, len(text) if linked else 0))
        reader = H.Reader("".join(page))
        assert [b.text for b in reader.blocks] == [b[1] for b in blocks]
        if blocks and any(len(b[1]) > b[2] for b in blocks):
            got, want = H.path_scores(reader.blocks, reader.paths), scores_brute(blocks)
            assert {path: got[b.path] for b, (path, *_) in zip(reader.blocks, blocks, strict=True)} == pytest.approx(want)


def test_ratios_select_without_names_and_articles(spark):
    import html

    bare = right = without = total = 0
    for r in table(spark, "/root/testdata/sf0.01", "pages").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", article))).split())
        page = re.sub("<(/?)(article|nav|footer)>", r"<\1div>", r.html).replace(' class="ad"', "")
        total += 1
        bare += H.main_text(page) == want
        without += want in H.main_text(page)
        right += H.main_text(r.html, share=0) != want  # with no threshold menus, adverts and footers stay
    assert right == total and without >= 0.99 * total and bare >= 0.5 * total


def test_names_of_ids_and_long_blocks():
    related = f'<article><h2 id="related-work">Related work</h2><p id="comments">{LONG}</p><h2 id="legal-issues">Legal</h2><p>{LONG}</p></article>'
    assert H.main_text(related) == f"Related work {LONG} Legal {LONG}"
    for own in ("comments", "site-footer", "cookie-banner", "left_sidebar", "reader-comments", "share-buttons", "related-posts"):
        assert H.main_text(f"<article><p>{LONG}</p><div id='{own}'><p>{LONG}</p></div></article>") == LONG, own
    for own in ("related-work", "discussion", "social", "cookies", "notice", "top", "section-2", "menu", ""):
        assert H.main_text(f"<article><p>{LONG}</p><div id='{own}'><p>{LONG}</p></div></article>") == f"{LONG} {LONG}", own
    code = "".join(f"x[{k}] = f(y, z); " for k in range(500)).strip()
    page = "<article>" + f"<p>{LONG}</p>" * 150 + f"<pre>{code}</pre><table>" + "<tr><td>1<td>2" * 50 + "</table></article>"
    assert H.main_text(page) == " ".join([*[LONG] * 150, code, *["1 2"] * 50])
    bare = page.replace("article>", "div>").split("<table>")[0]
    assert H.main_text(f"<div class=top><p>Home</p></div>{bare}") == " ".join([*[LONG] * 150, code])
    post = f"<div class=post><h2>Title</h2><div class=meta>By Ann</div><p>{LONG}</p></div><div class=box><h3>Recent</h3><ul><li><a href=1>One</a></ul></div><p>x</p>"
    assert H.main_text(post) == f"Title {LONG}"
    cards = "<div class=box>" + "".join(f"<article><a href=/{k}>See {k}</a></article>" for k in range(9)) + "</div>"
    assert H.main_text(f"<body><div class=text><p>{LONG}</p><p>{LONG}</p></div>{cards}</body>") == f"{LONG} {LONG}"


@pytest.mark.parametrize("page", [
    "<b>" * 150_000 + "</i>" * 150_000, "<div>" * 250_000 + "x", "<li>x" * 200_000, "<ul><div>" + "<div>" * 50_000 + "<li></li>" * 50_000,
    "<i><div>" + "<b>" * 100_000 + "</i>" * 100_000, "<b>" * 60_000 + "<div></div>" * 60_000, '<b x="<b" x="' * 60_000 + ">",
    "<script>" + "</script " * 90_000 + ">", '<a b="' * 150_000 + ">", "<div>x" * 150_000, ("<div>" * 30 + "x" + "</div>" * 30 + "y") * 3000, "&" * 1_000_000, "<" * 1_000_000,
])
def test_long_and_broken_pages_take_linear_time(page):
    import time

    began = time.perf_counter()
    H.main_text(page)
    assert time.perf_counter() - began < 10


def test_extract_odd_rows(spark):
    rows = spark.createDataFrame([(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "<p>a", "y")], "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.url, r.text, r.n_chars) for r in H.extract(rows).collect() if r.url) + [r.text for r in H.extract(rows).collect() if not r.url]
    assert got == [(1, "u", "", 0), (1, "u", "", 0), "a"]
    assert H.extract(rows.limit(0)).count() == 0
    assert H.main_text("<div>" * 3000 + "x" + "<p>word, and word." * 3000).count("word, and word.") == 3000
    clash = spark.createDataFrame([(1, "u", "<p>a", 5, 6)], "page_id long, url string, html string, n_chars long, path long")
    assert [tuple(r) for r in H.extract(clash).collect()] == [(1, "u", "a", 1)]
