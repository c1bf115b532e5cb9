"""Token round trips, source divergence and vector codes against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest

from coverloom.llm import codebooks, divergence, tokens
from coverloom.llm.common import prepare

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, source string, ids string, block string, part string, `rank` int, value string, chunk int"


@pytest.fixture(scope="module", autouse=True)
def options(spark):
    prepare(spark)


def documents(spark, *rows):
    """Rows of (doc_id, text, lang, source), with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "i", "b", "p", 3, "v", 1) for r in rows], DOCS)


# --- op11 ----------------------------------------------------------------------------------------------------------------

def plain_ids(text):
    return tokens.encoding(RANKS, public_tokenizers.PATTERN).encode_ordinary(text)


def pattern_ids(text):
    """By the pattern's matches one at a time, from another engine."""
    import regex

    library = tokens.encoding(RANKS, public_tokenizers.PATTERN)
    return [i for m in regex.findall(public_tokenizers.PATTERN, text) for i in library._encode_single_piece(m)]


def test_cut_texts_have_the_ids_of_whole_ones():
    r = random.Random(5)
    bits = ["a", "the ", "don't", " it's", "'s", "''re", "  ", " \n", "\t", "　", " x", "12", "٣", "...", "!'", "日本、語。", "ñandú", "\x1c", "\x85", "🙂", "é", "<|endoftext|>", "\r\n\r\n"]
    for _ in range(400):
        text = "".join(r.choices(bits, k=r.randrange(1, 60)))
        for size in (1, 7, 40):
            assert "".join(p for p, _ in tokens.pieces(text, size)) == text
            assert np.frombuffer(tokens.token_ids(text, RANKS, public_tokenizers.PATTERN, size), "<u4").tolist() == plain_ids(text)


def test_long_runs():
    for text in ["x" * 300_000, "!" * 200_000, "漢字、" * 50_000, " " * 5000 + "x", "x" + "\n" * 5000, "x " + " \t" * 4000 + "\n y"]:
        assert np.frombuffer(tokens.token_ids(text, RANKS, public_tokenizers.PATTERN), "<u4").tolist() == plain_ids(text)
    space = "a" + " " * 1_500_000 + "b"  # the library's own engine runs out of stack here
    assert np.frombuffer(tokens.token_ids(space, RANKS, public_tokenizers.PATTERN), "<u4").tolist() == pattern_ids(space)


def test_round_trip(spark):
    texts = ["", None, "A text, it's  here.\n", "日本語 🙂 é", "<|endoftext|>", " ", "word " * 200_000, "same", "same"]
    rows = [(k if t != "same" else 7, t, None, None) for k, t in enumerate(texts)] + [(None, "no id", "en", "s")]
    got = sorted(((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)
                  for r in tokens.digests(documents(spark, *rows), RANKS, public_tokenizers.PATTERN).collect()))
    want = []
    for k, t, *_ in rows:
        ids = plain_ids(t or "")
        want.append((-1 if k is None else k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert tokens.digests(documents(spark), RANKS, public_tokenizers.PATTERN).count() == 0
    kept = tokens.encode(documents(spark, *rows[:4]), RANKS, public_tokenizers.PATTERN)
    back = tokens.decode(kept, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(b.bytes).decode() for b in back) == sorted(t or "" for t in texts[:4])
    part = spark.createDataFrame([(1, np.array(plain_ids("é🙂")[:1], "<u4").tobytes()), (2, None)], "doc_id long, ids binary")
    assert {r.doc_id: bytes(r.bytes) for r in tokens.decode(part, RANKS, public_tokenizers.PATTERN).collect()} == {
        1: tokens.encoding(RANKS, public_tokenizers.PATTERN).decode_bytes(plain_ids("é🙂")[:1]), 2: b""}


# --- op12 ----------------------------------------------------------------------------------------------------------------

def audited(rows, least_docs):
    """Brute force: every term against every group."""
    term = re.compile(divergence.TERM)
    docs, counts, groups = collections.defaultdict(set), collections.Counter(), set()
    for d, (_, text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for t in term.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")):
            docs[lang, t].add(d)
            counts[lang, source, t] += 1
    out = []
    for lang, source in groups:
        kept = [t for (g, t), found in docs.items() if g == lang and len(found) >= least_docs]
        of = {s: [counts[lang, s, t] for t in kept] for g, s in groups if g == lang}
        whole = [sum(c) for c in zip(*of.values())]
        share = lambda c: [1 + 10**9 * (n + 2) // (sum(c) + 2 * len(kept)) for n in c]
        gap = lambda p, q: (p - q) ** 2 // (p + q)
        p = share(of[source])
        pairs = [(-sum(map(gap, p, share(of[s]))), s.encode(), s) for s in of if s != source]
        terms = [(-gap(a, b), t.encode(), t) for a, b, t, n in zip(p, share(whole), kept, of[source]) if n and a > b]
        out += [(lang, source, "pair", s, -v, k) for k, (v, _, s) in enumerate(sorted(pairs), 1)]
        out += [(lang, source, "term", t, -v, k) for k, (v, _, t) in enumerate(sorted(terms)[:10], 1)]
    return sorted(out)


def test_divergence_matches_brute_force(spark):
    r = random.Random(9)
    vocabulary = ["the", "The", "THE,", "the-the", "año", "ÁRBOL", "x1y", "a b", "日本", "\x0bq", "--", "42", "𝔘𝔫", "z z", "it's"] + [f"w{chr(97 + k)}" for k in range(20)]
    rows = []
    for k in range(260):
        lang = r.choice(["en"] * 6 + ["de", "", None, "EN"])
        source = r.choice(["s1"] * 4 + ["s2", "s3", "É", "", None, "\U00010000", "￮"])
        text = r.choice(["\n", " ", "\t\t", "\x1c "]).join(r.choices(vocabulary, k=r.randrange(0, 25)))
        rows.append((k, text, lang, source))
    rows += [rows[3]] * 4 + [(None, None, "en", "only nulls"), (1, "", "xx", "empty"), (1, "?? 12", "xx", "other"), (1, "word " * 30_000, "en", "s1")]
    got = divergence.audit(documents(spark, *rows), least_docs=4)
    assert sorted(tuple(g) for g in got.drop("q").collect()) == audited(rows, 4)
    assert [f.dataType.simpleString() for f in got.drop("q").schema] == ["string"] * 4 + ["bigint", "int"]
    assert divergence.audit(documents(spark)).count() == 0
    docs = documents(spark, *[(i, t or "", g or "", s or "") for i, t, g, s in rows])
    plain = {tuple(c) for c in divergence.term_counts(docs).collect()}
    assert plain == {tuple(c) for c in divergence.term_counts(docs.repartition(3), slots=3, blocks_at_once=2, blocks_together=3, block_bytes=200, block_docs=7).collect()}


def test_documents_of_several_chunks_and_blocks_count_once(spark):
    rows = [(1, "The the, THE the-the", "en", "s"), (2, "the", "en", "s"), (3, "x" * 50 + " the", "en", "t")]
    docs = documents(spark, *rows).select("lang", "source", "text").coalesce(1)
    blocks = divergence.chunk_counts(docs, block_bytes=30).collect()
    numbers = lambda b: np.frombuffer(b.documents, "<u2").tolist()
    assert sorted((b.block, b.chunk, numbers(b)) for b in blocks if b.lang is None and "x" not in b.chunk) == [
        (0, "THE", [0]), (0, "The", [0]), (0, "the", [1, 2]), (0, "the,", [0]), (0, "the-the", [0])]
    assert [(b.block, b.lang, b.source, b.first) for b in blocks if b.lang is not None] == [(0, "en", "s", 0), (0, "en", "t", 2)]
    counts = {(c.source, c.term): (c.docs, c.times) for c in divergence.term_counts(docs).collect()}
    assert counts == {("s", "the"): (2, 6), ("t", "the"): (1, 1), ("t", "x" * 50): (1, 1)}


def test_shares_beyond_64_bits(spark):
    row = spark.createDataFrame([(9 * 10**15, 10**16, 5)], "c long, n long, v long")
    assert row.select(divergence.share(row.c, row.n, row.v).alias("p")).first().p == 1 + 10**9 * (9 * 10**15 + 2) // (10**16 + 10)


# --- op13 ----------------------------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<{}>, label int, x int, code string, error double, part int, entry string, pos int, n int, total int, radius int"


def vectors(spark, *rows, kind="float"):
    return spark.createDataFrame([(*r, 1, "c", 0.5, 1, "e", 2, 3, 4, 5) for r in rows], VECTORS.format(kind))


def coded(rows, parts, entries, rounds, scale=256):
    """Brute force in Python integers."""
    kept = [(i, [int(scale * c // 1) for c in v], lab) for i, v, lab in rows if v is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = lambda v: [tuple(v[p * len(v) // parts:(p + 1) * len(v) // parts]) for p in range(parts)]
    kept = [(i, cut(v), lab) for i, v, lab in kept if len(v) == len(kept[0][1])]
    books = [[v[p] for _, v, _ in kept[:entries]] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v, p: min(range(len(books[p])), key=lambda e: (away(v[p], books[p][e]), e))
    for _ in range(rounds):
        mine = collections.defaultdict(list)
        for _, v, _ in kept:
            for p in range(parts):
                mine[p, nearest(v, p)].append(v[p])
        for (p, e), found in mine.items():
            books[p][e] = tuple(sum(c) // len(found) for c in zip(*found))
    out, per = [], collections.Counter()
    for i, v, lab in kept:
        code = [nearest(v, p) for p in range(parts)]
        error = sum(away(v[p], books[p][e]) for p, e in enumerate(code))
        out.append((i, bytes(code).hex(), error, lab))
        per[lab] += error
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, c, e, per[lab], digest) for i, c, e, lab in out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_codes_match_brute_force(spark):
    r = np.random.default_rng(4)
    centres = r.normal(size=(9, 32))
    rows = [(i, (centres[i % 9] + r.normal(size=32) * [0.02, 0.4][i % 2]).astype(np.float32).tolist(), [None, 1, 2][i % 3]) for i in range(400)]
    rows += [(i, [float(v) for v in r.integers(-1, 2, size=32) / 256], 3) for i in range(400, 600)]  # many ties
    rows += [(7, rows[7][1], 2), (None, rows[5][1], None), (600, None, 1), (601, [float("nan")] + [0.0] * 31, 1), (602, [None] + [0.0] * 31, 1),
             (603, [float("inf")] * 32, 1), (604, [], 1), (605, [1.0] * 16, 1), (606, [0.0] * 32, 4)]
    want = coded([x for x in rows if x[0] not in (604, 605)], 16, 64, 2)
    assert got(codebooks.codes(vectors(spark, *rows))) == want
    assert got(codebooks.codes(vectors(spark, *rows).repartition(7))) == want
    few = rows[:5]
    assert got(codebooks.codes(vectors(spark, *few))) == coded(few, 16, 64, 2)
    assert got(codebooks.codes(vectors(spark, *rows[:1]))) == coded(rows[:1], 16, 64, 2)
    assert codebooks.codes(vectors(spark)).count() == 0
    assert codebooks.codes(vectors(spark, (1, None, 1))).count() == 0


def test_codes_of_long_vectors_are_exact(spark):
    r = random.Random(2)
    rows = [(i, [r.uniform(-1, 1) * 10 ** r.randrange(0, 6) for _ in range(16)], i % 2) for i in range(120)]
    assert got(codebooks.codes(vectors(spark, *rows, kind="double"), entries=8)) == coded(rows, 16, 8, 2)
    far = [(i, [1e15 * (i % 7) + i] * 16, 1) for i in range(40)]  # errors leave 64 bits
    fits = lambda v: v if v < 1 << 63 else None
    want = [(i, c, fits(e), None, d) for i, c, e, _, d in coded(far, 16, 4, 2)]
    assert any(w[2] is None for w in want)
    assert got(codebooks.codes(vectors(spark, *far, kind="double"), entries=4)) == sorted(want, key=str)


def test_rings_leave_no_part_out():
    r = np.random.default_rng(8)
    for width in (1, 3, 4):
        entries = r.integers(-40, 40, size=(20, width))
        x, code = r.integers(-60, 60, size=(500, width)), r.integers(0, 20, size=500)
        d = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        home = d[np.arange(500), code]
        radii = [int(home[code == e].max(initial=0)) for e in range(20)]
        for known in (None, radii):
            found, best = codebooks.Balls(entries, known).assign(x, code)
            assert (found == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
