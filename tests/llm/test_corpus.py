"""Corpus operators against brute force, with nulls, empty tables, ties, repeated rows, very long texts and clashing columns."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from coverloom.llm import ann, chat, embeddings, html, langid, mixing, packing, queries, simhash, urls, warc
from coverloom.llm.common import join_labels, prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, fp long, score double, _i int, rank int"
#: Names that the stages use for columns of their own, now or before.
HELPERS = "_size _share _copy _id _n _src _times _sum _rows _kept_rank row place size copies copy more rows epochs cut at id taken target guess start mark chosen from".split()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def options(spark):
    prepare(spark)


def documents(spark, *rows):
    """Rows of (doc_id, text, lang, source), with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, None, "k", 7, 0.5, 3, 1, *[777] * len(HELPERS)) for r in rows], DOCS + "".join(f", `{h}` int" for h in HELPERS))


def untouched(got):
    """Whether the columns beside the documents' own are as given."""
    return all(r[h] == 777 for r in got.select(*[f"`{h}`" for h in HELPERS]).collect() for h in HELPERS)


def words(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choices(["ab", "cd", "ef", "ña", "ur", "el"], k=r.randrange(1, 4))) for _ in range(n))


# --- op1 -----------------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>No</title><script>var a = "</p><p>no";</script></head><body><!-- no <p>no</p> -->
<header class="site-header"><a href="/">My site</a></header><nav><ul><li><a href="/a">Home</a><li><a href="/b">About</a></ul></nav>
<div class="cookie-notice"><p>We use cookies. Accept</p></div>
<article><h1>A&nbsp;title &amp; more</h1><p>First   paragraph with <b>bold</b> and <a href="/x">a link</a>
 in it, long enough to be prose.<p>Second one &lt;here&gt;, it also has a few words to read.</p><div class="advert">Buy now</div></article>
<aside class="sidebar"><h3>Related</h3><ul><li><a href="/r">Another story</a></li></ul></aside>
<section class="comments"><div class="comment"><p>I liked it a lot, thanks for writing.</p></div></section>
<form class="search"><input name=q><button>Search</button></form><footer>&copy; 2024 My site</footer></body></html>"""


def test_main_text(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "u", ""), (3, "u", "<p"), (4, "u", "<script>x")],
                                  "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in html.extract(pages).collect())
    text = "A title & more\nFirst paragraph with bold and a link in it, long enough to be prose.\nSecond one <here>, it also has a few words to read."
    assert got == [(0, "", 0), (1, text, len(text)), (1, text, len(text)), (2, "", 0), (3, "", 0), (4, "", 0)]
    assert html.extract(pages.limit(0)).count() == 0


def test_stray_quotes_in_tags_end_with_the_tag():
    body = "<p><a title=Today's>First words here.</a></p><p class=\"x\"\">Second words here.</p><p>It isn't third.</p><p title='a>b' id = \"c>d\">Fourth.</p><p title=\"never closed>Fifth.</p>"
    assert [b.text for b in html.blocks(body)] == ["First words here.", "Second words here.", "It isn't third.", "Fourth.", "Fifth."]


def test_main_text_of_unseen_pages():
    r, right, total = random.Random(77), 0, 0
    made = [html.training_page(r) for _ in range(150)]
    made = [(b, t) for h, t in made if len(b := html.blocks(h)) == len(t)]
    for found, (_, truth) in zip(html.trained().label([b for b, _ in made]), made):
        right, total = right + (found == np.array(truth)).sum(), total + len(truth)
    assert right / total > 0.99


def test_a_very_long_page_among_short_ones():
    long = "<article>" + "<p>A paragraph of the story that goes on and on.</p>" * 20_000 + "</article><footer>Legal</footer>"
    net = html.trained()
    got = html.main_texts([PAGE, long, "", PAGE] + [PAGE] * 200, net)
    assert got[1].count("\n") > 19_000 and got[2] == "" and {got[0], *got[3:]} == set(html.main_texts([PAGE], net))
    found = [html.blocks(PAGE), html.blocks(long)[:50]]
    for a, b in zip(net.label(found), net.label(found, cells=1)):
        assert (a == b).all()


def test_main_text_of_given_pages(spark):
    for r in queries.op1_main_text(spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inside = r.html.split("<article>")[1].split("</article>")[0]
        blocks = (" ".join(html.unescape(p.replace("<b>", "").replace("<br>", " ")).split()) for p in html.re.split(r"</?(?:p|h1)>", inside))
        assert r.text == "\n".join(b for b in blocks if b)


def test_gradients_match_differences():
    net, r = html.Labeller(1), random.Random(2)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    pages = [html.blocks(html.training_page(r)[0])[:5] for _ in range(2)]
    x, mask, used = net.inputs(pages, keep=True)
    truth = (np.arange(mask.size).reshape(mask.shape) % 2).astype(np.float64)
    loss = lambda: (-(truth * np.log(p := 1 / (1 + np.exp(-net.scores(net.inputs(pages)[0], mask)[0]))) + (1 - truth) * np.log(1 - p)) * mask / mask.sum()).sum()
    g = net.gradients(x, mask, used, truth)
    for name in ("wf", "ub", "cf", "out", "path"):
        at = tuple(np.argwhere(np.abs(g[name]) == np.abs(g[name]).max())[0])
        keep, values = net.p[name][at], []
        for step in (1e-3, -1e-3):
            net.p[name][at] = keep + step
            values.append(loss())
        net.p[name][at] = keep
        assert (values[0] - values[1]) / 2e-3 == pytest.approx(g[name][at], rel=0.05)


# --- op2 -----------------------------------------------------------------------------------------------------------------

def test_url_verdicts(spark):
    rules = spark.createDataFrame([*queries.RULES, ("a.b", "/p", "block"), ("A.B", "/p", "allow"), (None, "/", "block"), ("x", "/", "other")], "host string, path string, action string")
    cases = {"http://COM/x": ("com", "/x", "com/", "allow"), "http://m.Example.com/en/1?q#f": ("m.example.com", "/en/1", "example.com/en/", "block"),
             "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"), "http://a.www.example.com/en/x": ("a.www.example.com", "/en/x", "www.example.com/en/", "allow"),
             "http://badexample.com/en/": ("badexample.com", "/en/", "com/", "allow"), "http://x.net/es": ("x.net", "/es", None, "allow"),
             "http://x.net/es/": ("x.net", "/es/", "net/es/", "block"), "http://com": ("com", "", None, "allow"), "no scheme": ("", "", None, "allow"),
             "http://z.a.b/please": ("z.a.b", "/please", "a.b/p", "block"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
             "http://a://com/": ("a:", "//com/", None, "allow"), "x?://net/fr/": ("net", "/fr/", "net/fr/", "block")}
    pages = spark.createDataFrame([(i % 5 or None, u) for i, u in enumerate([*cases, *cases])], "page_id long, url string").selectExpr("*", "'c' AS rule", "'c' AS _digest", "1 AS action")
    got = urls.judge(pages, rules).collect()
    assert len(got) == 2 * len(cases) and all((r.host, r.path, r.rule, r.verdict) == cases[r.url] for r in got)
    assert urls.judge(pages.limit(0), rules).count() == 0
    for width in (1, 0):  # hundreds of rules share a prefix
        many = rules.unionByName(spark.createDataFrame([(f"h{i}.org", f"/p{i % 7}", "block") for i in range(600)], rules.schema))
        again = urls.judge(pages, many, prefix_bytes=width).collect()
        assert sorted(map(str, again)) == sorted(map(str, got))
        plan = urls.judge(pages, many)._jdf.queryExecution().optimizedPlan().toString()
        assert "substring(_digest" in plan.split("Join LeftOuter")[1].split("\n")[0] and "= digest" not in plan.split("Join LeftOuter")[1].split("\n")[0]
    assert {r.verdict for r in urls.judge(pages, rules.limit(0), "block").collect()} == {"block"}


# --- op3 -----------------------------------------------------------------------------------------------------------------

def nearest(rows, queries_, k):
    out = {}
    for q, v in queries_:
        scored = sorted((-float(np.dot(np.array(w, float), np.array(v, float))), i) for i, w in rows if i != q)
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def vectors(spark, rows, label=True):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, label int").selectExpr("*", "'x' AS vector", "1 AS shard", "2 AS rank")


def test_neighbours_match_brute_force(spark):
    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(r.normal(size=(700, 8)) * r.uniform(0.5, 3, (700, 1)))]
    rows += [(1000 + i, rows[3][1]) for i in range(60)]  # many copies: ties go to the smaller ids
    bad = [(2000, None), (2001, [0.0] * 8), (2002, [None] + [1.0] * 7), (2003, [float("nan")] * 8), (2004, [float("inf")] * 8), (None, rows[0][1]), (20, rows[20][1])]
    frame = vectors(spark, rows + bad)
    got = collections.defaultdict(list)
    for x in ann.search(frame, frame.filter("vec_id % 20 = 0"), k=20, shard_rows=200, query_block=10).orderBy("query_id", "rank").collect():
        got[x.query_id].append((x.vec_id, x.score))
        assert x["rank"] == len(got[x.query_id])
    want = nearest(rows, [(i, v) for i, v in rows if i % 20 == 0], 20)
    assert got.keys() == want.keys()
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.98 * 20 * len(want)
    scores = dict(rows)
    for q, found in got.items():
        assert all(s == pytest.approx(float(np.dot(np.array(scores[q]), np.array(scores[i]))), rel=1e-12) for i, s in found)


@pytest.mark.parametrize("factor", [1e2, 1e4, 1e7])
def test_one_long_vector_hides_no_neighbours(spark, factor):
    r = np.random.default_rng(6)
    x = r.normal(size=(600, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[17] *= factor
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(set)
    for g in ann.search(rows, rows.filter("vec_id % 20 = 0"), k=10).collect():
        got[g.query_id].add(g.vec_id)
    truth = {q: [int(i) for i in np.argsort(-x @ x[q], kind="stable") if i != q][:10] for q in range(0, 600, 20)}
    found = sum(len(got[q].intersection(near)) for q, near in truth.items())
    assert found >= 0.95 * 10 * 30


def test_shards_do_not_grow_in_number_before_they_are_full(spark):
    vectors = spark.range(3000).selectExpr("transform(sequence(1, 32), i -> cast(id + i AS double)) AS vector")
    assert ann._parts(vectors, None, 1 << 23, 8) == ann._parts(vectors.limit(10), None, 1 << 23, 8) == 8
    assert ann._parts(vectors, None, 1000, 8) == 96 and ann._parts(vectors, 200, 1 << 23, 8) == 15 and ann._parts(vectors.limit(0), None, 1000, 1) == 1


def test_neighbours_of_few_rows(spark):
    few = vectors(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [1.0, 2.0, 3.0])])
    got = [(x.query_id, x["rank"], x.vec_id) for x in ann.search(few, few.filter("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2)]
    assert ann.search(few.limit(0), few.limit(0)).count() == 0


# --- op4 -----------------------------------------------------------------------------------------------------------------

def test_mix_targets_and_cuts(spark):
    r = random.Random(5)
    rows = [(i, words(r.randrange(0, 30), i), None, f"s{i % 3}") for i in range(300)] + [(i, words(400, i), None, None) for i in range(300, 330)]
    rows += [(None, "a b", None, "s1"), (5, rows[5][1], None, rows[5][3]), (900, None, None, "s2"), (901, "", None, "empty"), (902, words(30_000, 1), None, "s0")]
    got = mixing.mix(documents(spark, *rows), [5, 2, 1]).collect()
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for _, t, _, s in rows:
        sizes[s] += len((t or "").split())
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: [5, 2, 1][i % 3] for i, s in enumerate(names)}
    target, left, total = {}, set(names), sum(sizes.values())
    while True:  # by rounds, as the words say it
        share = {s: (total - sum(target.values())) * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if share[s] > 3 * sizes[s]}
        if not over:
            target |= share
            break
        target |= {s: 3 * sizes[s] for s in over}
        left -= over
    taken = collections.Counter()
    for x in got:
        taken[x.source] += x.taken
        assert x.target == pytest.approx(target[x.source]) and x.source_size == sizes[x.source] and 0 <= x.taken <= 3 * x.size
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in names)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(documents(spark, *rows).repartition(7), [5, 2, 1]).collect()))
    assert mixing.mix(documents(spark), [5, 2, 1]).count() == 0


def test_mixed_documents_repeat(spark):
    rows = [(i, words(10, i), None, "a" if i < 10 else "b") for i in range(100)] + [(100, None, None, "b"), (3, words(10, 3), None, "a")]
    got = mixing.mixed(documents(spark, *rows), [5, 2, 1])
    assert got.columns == documents(spark).columns
    n = collections.Counter(r.doc_id for r in got.collect())
    assert n[0] == 3 and n[3] == 6 and n[100] == 1 and sum(n[i] for i in range(10, 100)) in range(66, 69)
    assert untouched(got)


@pytest.mark.parametrize("same", [True, False])
def test_a_cut_among_rows_of_one_key(spark, same):
    one, other = words(10, 1), words(10, 2)
    rows = [(i, words(10, i), None, "a") for i in range(20)] + [(None, one if same or i % 2 else other, None, "b") for i in range(41)]
    got = mixing.mixed(documents(spark, *rows), [5, 2, 1]).collect()
    # 610 words: "a" weighs 5, its share is 436 and within 3 times its size, the rest of 174 goes to "b": 17 of its 41 rows
    n = collections.Counter((r.source, r.text) for r in got)
    assert sum(k for (s, _), k in n.items() if s == "a") == 44 and sum(k for (s, _), k in n.items() if s == "b") == 17
    assert sorted(map(str, got)) == sorted(map(str, mixing.mixed(documents(spark, *rows).repartition(5), [5, 2, 1]).collect()))


# --- op5 -----------------------------------------------------------------------------------------------------------------

def test_warc_round_trip(spark, tmp_path):
    big, crlf = "é" * 3000 + "\r\n\r\nWARC/1.1\r\n", "a\r\n\r\nb" * 500
    rows = [(1, "http://a/ b", big), (2, None, big), (2, None, big), (None, "u", big), (3, "", None), (4, "u", ""), (5, "u", "x"), (6, "u", "x"), (7, "u", crlf), (8, "ü\r\n", "p" * 1000), (9, "u", "p" * 1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS digest", "'y' AS data", "1 AS chunk")
    got = sorted((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or 0) for r in warc.round_trip(pages, size=512).collect())
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        best = max((j for j, _, g in rows if j and g == h), default=None)
        revisit = len(data) >= 1000 and i != best
        want.append((i or 0, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", best if revisit else 0))
    assert got == sorted(want)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_archives_are_unpacked_in_steps():
    import gzip

    records = [(f"<r{i}>", random.Random(i).randbytes([0, 5, 70_000, 300_000][i % 4])) for i in range(24)]
    plain = b"".join(f"WARC/1.1\r\nWARC-Record-ID: {n}\r\nContent-Length: {len(b)}\r\n\r\n".encode() + b + b"\r\n\r\n" for n, b in records)
    cut = len(plain) // 3
    for packed in (gzip.compress(plain), gzip.compress(plain[:cut]) + gzip.compress(plain[cut:]), gzip.compress(b"\0" * 0 + plain, 0)):
        for step in (97, 1 << 12, 1 << 18):
            seen = [(head["WARC-Record-ID"], b"".join(block)) for head, block in warc._records(warc.unpacked(memoryview(packed), step))]
            assert seen == records and all(len(p) <= step for p in warc.unpacked(memoryview(packed), step))
    with pytest.raises(ValueError, match="ends inside"):
        list((h, b"".join(b)) for h, b in warc._records(warc.unpacked(memoryview(gzip.compress(plain[:-40])))))


def test_warc_segments_rebuild_the_payload(spark, tmp_path):
    text = words(2000, 3)
    warc.write(spark.createDataFrame([(1, "u", text)], "page_id long, url string, html string"), f"{tmp_path}/w", size=1000)
    parts = sorted(warc.read_segments(spark, f"{tmp_path}/w").collect(), key=lambda r: r.segment)
    assert [p.segment for p in parts] == list(range(1, len(parts) + 1)) and parts[1].type == "continuation"
    assert b"".join(bytes(p.data) for p in parts) == text.encode()


# --- op6 -----------------------------------------------------------------------------------------------------------------

def plain_fingerprint(text):
    w = [x.encode() for x in (text or "").translate({c: c + 32 for c in range(65, 91)}).split() if x] if text is None or text.isascii() else (text or "").encode().lower().split()
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    bits = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if bits[b] * 2 > len(shingles))


def test_fingerprints():
    for text in (None, "", " \t\n", "One", "a b", "A b  C", "Ünder ÀB \u00a0 x", words(500, 1), words(40_000, 2), "x y z " * 50):
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    assert simhash.fingerprint(words(40_000, 2), block=1000) == simhash.fingerprint(words(40_000, 2))


def test_anchors_meet_all_pairs_within_three_bits():
    r = np.random.default_rng(6)
    x = r.integers(0, 1 << 64, 2000, dtype=np.uint64)
    y = x.copy()
    for k in range(2000):
        for b in r.choice(64, k % 4, replace=False):
            y[k] ^= np.uint64(1 << int(b))
    at, key, home = simhash.anchors(x)
    homes = collections.defaultdict(set)
    for a, k in zip(at[home], key[home]):
        homes[a].add(k)
    at, key, _ = simhash.anchors(y)
    lists = collections.defaultdict(set)
    for a, k in zip(at, key):
        lists[a].add(k)
    assert all(homes[k] & lists[k] for k in range(2000))


def test_groups_match_brute_force(spark):
    r = random.Random(8)
    base = [words(r.randrange(1, 200), i) for i in range(60)]
    rows = [(i, t, None, None) for i, t in enumerate(base)]
    for i in range(60, 400):
        w = r.choice(base[:20]).split()
        w[r.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w), None, None))
    rows += [(401, None, None, None), (402, "", None, None), (None, base[0], None, None), (None, "alone here", None, None), (7, base[7], None, None)]
    got = simhash.near_duplicates(documents(spark, *rows), cell_rows=8).collect()  # small cells: hot anchors are cut
    fps = np.array([int(g.fingerprint, 16) for g in got], np.uint64)
    assert collections.Counter(g.fingerprint for g in got) == collections.Counter(f"{plain_fingerprint(t):016x}" for _, t, _, _ in rows)
    label = np.arange(len(got))
    for k, g in enumerate(got):
        if g.doc_id is None:
            fps[k] = fps[k]
    i, j = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    some = np.array([got[a].doc_id is not None and got[b].doc_id is not None for a, b in zip(i, j)])
    join_labels(label, i[some], j[some])
    for k, g in enumerate(got):
        ids = [got[m].doc_id for m in range(len(got)) if label[m] == label[k] and got[m].doc_id is not None] if g.doc_id is not None else \
            [got[m].component_id for m in range(len(got)) if fps[m] == fps[k] and got[m].doc_id is not None]
        assert g.component_id == (min(ids) if ids else None)
    assert simhash.near_duplicates(documents(spark)).count() == 0


def test_keep_one(spark):
    docs = documents(spark, (4, "a b c d", None, None), (2, "a b c d", None, None), (2, "a b c d", None, "x"), (9, "other words stand here", None, None), (None, "a b c d", None, None))
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns and sorted(r.doc_id or 0 for r in got.collect()) == [0, 2, 9] and untouched(got)


# --- op7 -----------------------------------------------------------------------------------------------------------------

def test_language(spark):
    held = [r for r in queries.op7_language(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in held)
    held = [r for r in held if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) > 0.97 * len(held)


def test_language_edges(spark):
    rows = [(i, words(30, i), "xx", None) for i in range(40)] + [(i, "the of and with " * 9, "yy", None) for i in range(40, 80)]
    rows += [(90, None, "xx", None), (91, "", "xx", None), (92, "12 34 !?", "yy", None), (None, "the of and", "zz", None), (93, "the of and with", None, None), (94, words(50_000, 1), None, None), (1, rows[1][1], "xx", None)]
    got = langid.identify(documents(spark, *rows))
    by = {r.doc_id: (r.lang_pred, r.score) for r in got.collect()}
    assert got.count() == len(rows) and by[90] == by[91] == by[92] == ("und", 0.0) and by[93][0] == by[None][0] == "yy" and by[94][0] == "xx"
    kept = langid.keep_known(documents(spark, *rows))
    assert kept.columns == documents(spark).columns and kept.count() == len(rows) - 3 and untouched(kept)
    assert langid.identify(documents(spark)).count() == 0
    assert {r.lang_pred for r in langid.identify(documents(spark, (1, "abc", None, None))).collect()} == {"und"}


def test_documents_with_letters_stay_when_nothing_was_learnt(spark):
    docs = documents(spark, (1, "abc", None, None), (2, "12 !?", None, None), (3, None, None, None), (4, "", None, None), (None, "ñ", "xx", None))
    assert sorted(r.text for r in langid.keep_known(docs).collect()) == ["abc", "ñ"]
    assert {r.lang_pred for r in langid.identify(docs).collect()} == {"und"}


def test_languages_without_letters_are_not_learnt(spark):
    rows = [(i, words(30, i), "xx", None) for i in range(30)] + [(i, "12 34", "yy", None) for i in range(30, 90)]
    assert {r.lang_pred for r in langid.identify(documents(spark, *rows)).collect() if r.doc_id < 30} == {"xx"}
    none = [(i, "12 34", lang, None) for i, lang in enumerate(["yy", "zz"] * 20)] + [(50, "letters", None, None)]
    assert {r.lang_pred for r in langid.identify(documents(spark, *none)).collect()} == {"und"}


def test_copies_do_not_exceed_the_sample(spark, monkeypatch):
    seen = []
    train = langid.train
    monkeypatch.setattr(langid, "train", lambda sample, *a, **k: seen.extend(sample) or train(sample, *a, **k))
    rows = [(i, "the same text", "xx", None) for i in range(300)] + [(5, "one id too", "xx", None)] * 300 + [(i, words(20, i), "yy", None) for i in range(600, 900)]
    langid.identify(documents(spark, *rows), per_language=40).count()
    n = collections.Counter(lang for _, lang in seen)
    assert n == {"xx": 40, "yy": 40} and sum(t == "one id too" for t, _ in seen) <= 1


# --- op8 -----------------------------------------------------------------------------------------------------------------

def test_embedding_groups_match_brute_force(spark):
    r = np.random.default_rng(9)
    centre = r.normal(size=(20, 48))
    v = np.concatenate([r.normal(size=(200, 48)), centre[r.integers(0, 20, 300)] + r.normal(scale=0.08, size=(300, 48))]).astype(np.float32)
    v[10], v[11] = v[9], v[9] * 2
    rows = [(i, [float(c) for c in x], i % 3 if i > 12 else 0) for i, x in enumerate(v)]
    bad = [(800, None, 0), (801, [0.0] * 48, 0), (802, [None] * 48, 0), (803, [float("nan")] * 48, 0), (804, rows[9][1], None), (None, rows[9][1], 0), (805, [1.0], 0), (9, rows[9][1], 0)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS key", "2 AS rep", "'z' AS vector")
    got = embeddings.near_duplicates(frame, cell_rows=16).collect()  # small cells: hot buckets are cut
    assert len(got) == len(rows) + len(bad)
    live = rows + [bad[-1], (805, [1.0] + [0.0] * 47, 9)]
    x = np.array([w for _, w, _ in live], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([k for *_, k in live])
    link = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    root = np.arange(len(live))
    join_labels(root, *np.nonzero(link))
    want = collections.Counter((i, int(n), min(live[m][0] for m in np.flatnonzero(root == root[k]))) for k, ((i, *_), n) in enumerate(zip(live, link.sum(axis=1))))
    want.update([(i, 0, i) for i in (800, 801, 802, 803, 804, None)])
    found = collections.Counter((g.vec_id, g.n_links, g.component_id) for g in got)
    assert sum((found & want).values()) >= 0.97 * len(got) and sum(n for _, n, _ in found.elements()) >= 0.97 * link.sum()
    assert all(g.kept == (g.vec_id is not None and g.vec_id == g.component_id) for g in got)
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_buckets_catch_pairs_at_the_threshold():
    r = np.random.default_rng(1)
    v, u = (x / np.linalg.norm(x, axis=1)[:, None] for x in r.normal(size=(2, 1500, 64)))
    u -= (u * v).sum(axis=1)[:, None] * v
    u = 0.98 * v + np.sqrt(1 - 0.98**2) * u / np.linalg.norm(u, axis=1)[:, None]
    a, b = embeddings.buckets(v, 6, 2), embeddings.buckets(u, 6, 2)
    assert (a[:, :, :, None] == b[:, :, None, :]).any(axis=(1, 2, 3)).mean() > 0.999
    assert (a[:700, :, :, None] == b[700:1400, :, None, :]).any(axis=(1, 2, 3)).mean() < 0.05


@pytest.mark.parametrize("width, rows", [(2, 10**9), (8, 10**9), (16, 10**9), (64, 10**4), (64, 10**8), (768, 10**8)])
def test_buckets_catch_pairs_with_more_hashes(width, rows):
    r = np.random.default_rng(2)
    v, u = (x / np.linalg.norm(x, axis=1)[:, None] for x in r.normal(size=(2, 400, width)))
    u -= (u * v).sum(axis=1)[:, None] * v
    u = 0.98 * v + np.sqrt(1 - 0.98**2) * u / np.linalg.norm(u, axis=1)[:, None]
    a, b = (embeddings.buckets(x, 6, embeddings.hash_count(rows, width, 6)) for x in (v, u))
    assert (a[:, :, :, None] == b[:, :, None, :]).any(axis=(1, 2, 3)).mean() >= 0.98


def test_hashes_follow_the_rows():
    counts = [embeddings.hash_count(n, 64, 6) for n in (0, 100, 10_000, 1_000_000, 100_000_000)]
    assert counts == [2, 2, 3, 4, 5]
    for n, k in zip((10_000, 1_000_000, 100_000_000), counts[2:]):
        assert 6 * (1 + k) ** 2 * n / 128**k < 1  # others met by chance, in all buckets of a vector
    assert 6 * 2048 ** embeddings.hash_count(10**15, 1024, 6) < 2**63


@pytest.mark.parametrize("hashes", [2, 4])
def test_links_count_once_however_many_buckets_two_share(spark, hashes):
    r = np.random.default_rng(5)
    base = r.normal(size=(30, 32))
    v = np.concatenate([base[:1] + r.normal(scale=0.001, size=(90, 32)), base, base + r.normal(scale=0.001, size=(30, 32))])
    frame = spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    want = ((unit @ unit.T) >= 0.98).sum(axis=1) - 1
    for cell_rows in (8, 2048):
        got = {g.vec_id: g for g in embeddings.near_duplicates(frame, hashes=hashes, cell_rows=cell_rows).collect()}
        assert [got[i].n_links for i in range(len(v))] == want.tolist()
        assert {got[i].component_id for i in [*range(91), 120]} == {0} and all(got[121 + i].component_id == 91 + i for i in range(29))


# --- op9 -----------------------------------------------------------------------------------------------------------------

def test_perspectives(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "ann", "Hi <|im_end|>"), (1, 2, "bob b", None), (1, 9000, "ann", "Bye"), (1, 3, None, "?"), (1, 2, "bob b", None),
            (2, 0, "system", "only"), (None, 0, "ann", "x"), (3, None, "c", words(20_000, 1))]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'p' AS piece", "'h' AS head", "1 AS start")
    got = collections.defaultdict(list)
    for r in chat.rotate(turns).orderBy("start").collect():
        got[r.conv_id, r.perspective].append(r)
    assert got.keys() == {(1, "ann"), (1, "bob b"), (3, "c")}
    for (_, who), pieces in got.items():
        text = "".join(p.piece for p in pieces)
        assert all(text[p.start:p.start + p.length] == p.piece and (p.train_start is not None) == (p.speaker == who) for p in pieces)
        assert all(text[p.train_start:p.train_end].endswith("<|im_end|>") and "<|im_start|>" not in text[p.train_start:p.train_end] for p in pieces if p.role == "assistant")
    text = "".join(p.piece for p in got[1, "ann"])
    assert text.startswith("<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>assistant\nHi < |im_end|><|im_end|>\n<|im_start|>user name=bob_b\n<|im_end|>\n")
    assert text.endswith("<|im_start|>user name=unknown\n?<|im_end|>\n<|im_start|>assistant\nBye<|im_end|>\n")
    assert chat.rotate(turns.limit(0)).count() == 0


# --- op10 ----------------------------------------------------------------------------------------------------------------

def test_encoder_equals_the_tokenizer():
    encode = packing.Encoder(queries.tokenizer_file(), most=50)
    texts = ["", "a", "It's we'll  they'RE\t\n x\u00a0y", "naïve ÀÉ×÷ ñ² 12½3", "<|endoftext|> b", " lead  trail  ", "日本語 text", "\x1c\x85a", words(3000, 4), "tabs\t\tnew\r\n\r\nlines  ", "###$$$ a_b-c", "ǅ ƻ ǀ"]
    assert [np.frombuffer(b, "<u4").tolist() for b in encode(texts)] == [e.ids for e in encode.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in encode(texts)] == [e.ids for e in encode.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_special_tokens_as_the_plain_call_has_them():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer_file())
    encode = packing.Encoder(queries.tokenizer_file())
    for text in ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>", "<|endoftext", words(40, 3), "日本 <|endoftext|>"]:
        assert np.frombuffer(encode([text])[0], "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_fullest_is_exact():
    r = random.Random(3)
    for _ in range(200):
        counts = {r.randrange(1, 40): r.randrange(1, 4) for _ in range(r.randrange(1, 8))}
        room = r.randrange(0, 90)
        sums = {0}
        for k, n in counts.items():
            sums = {s + k * i for s in sums for i in range(n + 1)}
        used = packing.fullest(counts, room)
        assert all(used[k] <= counts[k] for k in used) and sum(k * n for k, n in used.items()) == max(s for s in sums if s <= room)


def test_packing(spark):
    r = random.Random(2)
    rows = [(i, words(r.randrange(0, 300), i), None, None) for i in range(300)] + [(300, words(9000, 1), None, None), (301, None, None, None), (302, "", None, None), (None, "x y", None, None), (1, words(5, 5), None, None), (1, words(5, 5), None, None)]
    got = packing.pack_documents(documents(spark, *rows), queries.tokenizer_file(), 256).collect()
    encode, want = packing.encoder(queries.tokenizer_file()), collections.Counter()
    for i, t, *_ in rows:
        ids, at, piece = np.append(np.frombuffer(encode([t or ""])[0], "<u4"), np.uint32(0)).astype("<u4"), 0, 0
        while at < len(ids):
            size = (len(ids) - 1) % 256 + 1 if at == 0 else 256
            want[i, piece, at, size, zlib.crc32(ids[at:at + size].tobytes())] += 1
            at, piece = at + size, piece + 1
    assert collections.Counter((g.doc_id, g.piece, g.start, g.length, g.ids_crc32) for g in got) == want
    sequences = collections.defaultdict(list)
    for g in got:
        sequences[g.sequence_id].append((g.offset, g.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(sequences) <= -(-sum(g.length for g in got) // 256) + 1
    assert packing.pack_documents(documents(spark), queries.tokenizer_file()).count() == 0


# --- pipeline ------------------------------------------------------------------------------------------------------------

def plain_pipeline(rows):
    """The four stages in plain Python: (doc_id, text) with the number of copies."""
    lettered = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    known = [r for r in lettered if r[0] is not None]
    fps, label = [plain_fingerprint(t) for _, t, *_ in known], np.arange(len(known))
    near = [(i, j) for i in range(len(known)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    join_labels(label, *np.array(near).T)
    root = [min(known[m][0] for m in np.flatnonzero(label == label[k])) for k in range(len(known))]
    first = {}
    for r, m in zip(known, root):
        if m == r[0]:
            first[m] = min(first.get(m, r), r, key=str)
    kept = list(first.values()) + [r for r in lettered if r[0] is None]
    size = {id(r): len(r[1].split()) for r in kept}
    total, sizes = sum(size.values()), collections.Counter()
    for r in kept:
        sizes[r[3]] += size[id(r)]
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight, target, left = {s: queries.WEIGHTS[k % 3] for k, s in enumerate(names)}, {}, set(names)
    while left:
        share = {s: (total - sum(target.values())) * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if share[s] > 3 * sizes[s]}
        target |= {s: 3 * sizes[s] for s in over} if over else share
        left -= over or left
    copies = collections.Counter()
    for s in names:
        room = int(target[s] + 0.5)
        epochs, rest = divmod(room, sizes[s])
        for r in sorted((r for r in kept if r[3] == s), key=lambda r: hashlib.md5(f"{'' if r[0] is None else r[0]}:{size[id(r)]}".encode()).hexdigest()):
            n = size[id(r)]
            copies[r[0], r[1]] += epochs + (2 * max(0, min(n, rest)) >= n)
            rest -= n
    return +copies


def test_pipeline_matches_plain_python(spark, tmp_path):
    r, rows = random.Random(12), []
    for i in range(150):
        source = r.choice(["big"] * 6 + ["mid", "low", None])
        rows.append((10 * i, words(r.randrange(30, 400), i), r.choice(["xx", "yy", None]), source))
    rows += [(10 * i + 1, rows[i][1], "xx", rows[i][3]) for i in range(0, 40, 3)]  # exact copies
    rows += [(10 * i + 2, rows[i][1].upper() + ("" if i % 2 else " ab"), "xx", "big") for i in range(0, 40, 4)]  # near copies
    rows += [(7000 + i, t, "yy", "low") for i, t in enumerate([None, "", "12 34", "?! -- 7", "\u0660 1"])]  # no letters
    rows += [(8000, "only one document here", "xx", "tiny"), (None, "no id, kept", None, "mid"), (20, "the second text of an id", "xx", "big")]
    rows += [(8001, words(3000, 5), "xx", "mid"), (8002, "a <|endoftext|> b c", None, None)]
    documents(spark, *rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want, encode, capacity = plain_pipeline(rows), packing.encoder(queries.tokenizer_file()), queries.CAPACITY
    assert any(n == 3 for n in want.values()) and len(want) < len(rows) - 25
    pieces, crc = collections.Counter(), zlib.crc32
    for (i, text), n in want.items():
        ids = np.append(np.frombuffer(encode([text])[0], "<u4"), np.uint32(0)).astype("<u4")
        cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
        pieces.update({(i, k, a, b - a, crc(ids[a:b].tobytes())): n for k, (a, b) in enumerate(zip(cuts, cuts[1:]))})
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert collections.Counter((g.doc_id, g.piece, g.start, g.length, g.ids_crc32) for g in got) == pieces
    places = collections.defaultdict(list)
    for g in got:
        places[g.sequence_id].append((g.offset, g.length))
    for parts in places.values():
        ends = [0]
        for offset, length in sorted(parts):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= capacity
    assert len(places) <= -(-sum(g.length for g in got) // capacity) + 1
