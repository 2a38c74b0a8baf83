"""Substring dedup, source divergence and importance resampling against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerleaf.llm import divergence, html_text, resampling, substrings

SCHEMA = "doc_id long, text string, lang string, source string, bucket string, block int, n long"
WORDS = "alpha beta gamma delta Epsilon zeta éta theta iota kappa lambda mu".split()
ODD = "\x00\x1c\x1d\x1e\x1f\x85\xa0 　"  # white space to Unicode, or control characters: no separators of words here


def frame(spark, rows, parts=3):
    """rows: (doc_id, text, lang, source); the other columns have names that the operators use themselves."""
    return spark.createDataFrame([(*r, "x", 1, 9) for r in rows], SCHEMA).repartition(parts)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    passages = [[r.choice(WORDS) for _ in range(n)] for n in (5, 8, 30)]
    out = []
    for i in range(80):
        words = [r.choice(WORDS) + str(r.randint(0, 40)) for _ in range(r.randint(0, 30))]
        for _ in range(r.randint(0, 3)):
            at = r.randint(0, len(words))
            words[at:at] = r.choice(passages)
        text = "".join(w + r.choice([" ", "  ", "\t", "\n", "\r\n", "\x0b", "\x0c"]) for w in words)
        out.append((3 * i - 50, text, r.choice(["en", "de", None]), r.choice(["a", "b", "é", None])))
    out += [(500, None, "en", "a"), (501, "", "en", "c"), (502, " \n\t ", "xx", "a"), (503, f"a{ODD}b a{ODD}b", "en", "a"), (504, out[3][1], "de", "b")]
    out += [(505, "same word " * 40, "en", "a"), (None, out[5][1], None, None), (506, "no", "yy", "q"), (506, "no", "yy", "q")]
    return out


# ---------------------------------------------------------------- 11
def brute_substrings(rows, size):
    tag = {}
    out, seen = {}, set()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for doc_id, text, *_ in order:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
        gone = set()
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            if window in seen:
                gone |= set(range(i, i + size))
            seen.add(window)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        tag.setdefault(doc_id, []).append((len(words), len(gone), kept, gone))
    for doc_id, found in tag.items():
        out[doc_id] = sorted(x[:3] for x in found)
    return out, tag


@pytest.mark.parametrize("size", [1, 4, 20])
def test_substrings_brute_force(spark, rows, size):
    got, spans = {}, {}
    for r in substrings.dedup(frame(spark, rows), size).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, r.n_removed, r.text))
        spans.setdefault(r.doc_id, []).append({i for s in r.spans for i in range(s.first, s.last + 1)})
        assert all(a.last + 1 < b.first for a, b in zip(r.spans, r.spans[1:]))  # maximal: no two touch
    want, whole = brute_substrings(rows, size)
    assert {k: sorted(v) for k, v in got.items()} == want
    assert {k: sorted(map(sorted, v)) for k, v in spans.items()} == {k: sorted(sorted(x[3]) for x in v) for k, v in whole.items()}


def test_substrings_small_blocks_agree(spark, rows, monkeypatch):
    """Windows that repeat in one block and over many are found alike; names are few bits and many blocks."""
    want, _ = brute_substrings(rows, 4)
    blocks = substrings.ordered_blocks(frame(spark, rows), 300)
    assert blocks.select("block").distinct().count() > 10
    answers = substrings.seen_before(substrings.windows(blocks, 4, 128))
    got = {}
    for r in substrings.spans(blocks, answers, 4, 128).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, r.n_removed, r.text))
    assert {k: sorted(v) for k, v in got.items()} == want


def test_substrings_repeated_rows_and_hot_doc_id(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text, "en", "a")] * 3 + [(7, text + " end", "en", "a")]
    got = [(r.doc_id, r.n_removed, r.text) for r in substrings.dedup(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(None, 0, text), (None, 30, ""), (None, 30, ""), (7, 30, "end")], key=str)


def test_substrings_long_text_and_empty_table(spark):
    assert substrings.dedup(frame(spark, [(1, "x", "en", "a")]).where("doc_id < 0")).collect() == []
    words = [f"w{i}" for i in range(300_000)]
    long = " ".join(words + words[1000:1100])
    r = substrings.dedup(frame(spark, [(1, long, "en", "a")])).first()
    assert (r.n_words, r.n_removed) == (300_100, 100) and hashlib.sha256(r.text.encode()).digest() == hashlib.sha256(" ".join(words).encode()).digest()


def test_names_pack():
    names = np.unique(np.random.default_rng(1).integers(0, 1 << 56, 5000, dtype=np.uint64))
    raw = substrings.packed(names)
    assert (substrings.unpacked(raw) == names).all() and len(raw) < 6.6 * len(names)


def test_window_hash_is_the_polynomial():
    texts = pa.array(["a b c d e a b c", None, "a b c"])
    w = substrings.Windows(texts, 3, 64)
    assert w.first.tolist() == [0, 1, 2, 3, 4, 5, 8] and w.n_words.tolist() == [8, 0, 3]
    assert w.name[0] == w.name[5] == w.name[6] and len(set(w.name.tolist())) == 5
    assert w.bucket[0] == w.bucket[5] == w.bucket[6] and int(w.bucket.max()) < 64


# ---------------------------------------------------------------- 12
def brute_audit(rows, least, top):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))) for _, text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in set(d[2]))
        kept = [t for t in df if df[t] >= least]
        count = {s: Counter(t for d in own if d[1] == s for t in d[2] if df[t] >= least) for s in {d[1] for d in own}}
        every = sum(count.values(), Counter())

        def p(c, t):
            return 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))

        for s, c in count.items():
            pairs = [(sum(abs(p(c, t) - p(count[o], t)) for t in kept), o) for o in count if o != s]
            terms = [(p(c, t) - p(every, t), t) for t in kept if c[t] > 0 and p(c, t) > p(every, t)]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                out |= {(lang, s, part, item, v, k) for k, (v, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1)}
    return out


@pytest.mark.parametrize(("least", "top"), [(1, 3), (4, 50), (30, 50), (10_000, 5)])
def test_divergence_brute_force(spark, rows, least, top):
    got = [tuple(r) for r in divergence.audit(frame(spark, rows), least, top).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_audit(rows, least, top)


def test_histograms_hold_every_kept_term(spark, rows):
    """A pair's tallies, those of absent terms included, add up to the kept terms of its language."""
    docs = frame(spark, rows).select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    kept = divergence.kept_counts(docs, 2)
    groups = divergence.grouped(docs, kept)
    terms = {r.lang: r.n for r in kept.groupBy("lang").agg(F.count_distinct("term").alias("n")).collect()}
    hist = divergence.pair_histograms(kept, groups)
    assert hist.where("m < 0").count() == 0
    sums = hist.groupBy("lang", "i", "j").agg(F.sum("m").alias("n")).collect()
    assert sums and all(r.n == terms.get(r.lang, 0) for r in sums)


def test_divergence_empty_and_long(spark):
    assert divergence.audit(frame(spark, [(1, "x", "en", "a")]).where("doc_id < 0")).collect() == []
    big = "word " * 200_000 + "other"
    rows = [(1, big, "en", "a"), (2, "word", "en", "b")]
    assert {tuple(r) for r in divergence.audit(frame(spark, rows), 1, 50).collect()} == brute_audit(rows, 1, 50)


def test_weights_beyond_64_bits(spark):
    r = spark.range(1).select(divergence.weight(F.lit(10**13), F.lit(10**15), F.lit(10**7)).alias("p")).first()
    assert r.p == 1 + 10**9 * (10**13 + 5) // (10**15 + 5 * 10**7)


# ---------------------------------------------------------------- 13
def brute_resample(rows, target, buckets, least, percent):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        return len(w), [zlib.crc32(f.encode()) % buckets for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]

    docs = [(r[0], *features(r[1])) for r in rows]
    s, t = Counter(b for d in docs for b in d[2]), Counter(b for x in target for b in features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, n_words, f in docs:
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        out.append((doc_id, n_words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    rank = {id(x): k for k, x in enumerate(order[: percent * len(order) // 100], 1)}
    return sorted((((x[0], *x[2:], rank.get(id(x))) for x in out)), key=str)


@pytest.mark.parametrize(("buckets", "least", "percent"), [(10_000, 20, 25), (7, 1, 100), (100, 5, 0)])
def test_resampling_brute_force(spark, rows, buckets, least, percent):
    target = ["alpha Beta gamma9", None, "", "éta theta iota éta theta"]
    aim = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resampling.resample(frame(spark, rows), aim, buckets=buckets, least_words=least, percent=percent).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_resample(rows, target, buckets, least, percent)


def test_resampling_empty_tables(spark, rows):
    docs, none = frame(spark, rows), spark.createDataFrame([], "text string")
    assert resampling.resample(docs.where("doc_id = -1"), none).collect() == []
    got = resampling.resample(docs, none, percent=50).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_resample(rows, [], 10_000, 20, 50)


def test_trie_states_are_crcs(monkeypatch):
    texts = pa.array(["the cat sat on the cat", "", None, "the çat " * 3, "x" * 70_000 + " y"])
    trie = resampling.Trie(texts, 3)
    words = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t or "") for t in texts.to_pylist()]
    flat = [w for ws in words for w in ws]
    for level, (states, counts, places, nodes) in enumerate(zip(trie.states, trie.counts, trie.places, trie.nodes)):
        runs = [" ".join(flat[p : p + level + 1]) for p in places]
        assert [int(states[n]) for n in nodes] == [zlib.crc32(x.encode()) for x in runs]
        assert Counter(runs) == {runs[nodes.tolist().index(n)]: int(counts[n]) for n in set(nodes.tolist())}
    assert trie.n_features.tolist() == [sum(max(0, len(w) - k) for k in range(3)) for w in words]
    # small pieces give the same sums as a large one
    gains = np.arange(-50, 51)
    one = trie.totals(gains)
    assert one.tolist() == [int(x) for t in texts.to_pylist() for x in resampling.Trie(pa.array([t], pa.string()), 3).totals(gains)]


def test_resampling_ranks_over_many_partitions(spark):
    rows = [(i, "w " * 25 + f"u{i % 3}", "en", "a") for i in range(500)]
    aim = spark.createDataFrame([("u1",)], "text string")
    got = resampling.resample(frame(spark, rows, 7), aim).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_resample(rows, ["u1"], 10_000, 20, 25)
    ranks = sorted(r.rank for r in got if r.rank)
    assert ranks == list(range(1, 126))


def test_teaser_articles_do_not_swallow_the_page():
    own = "".join(f"<p>Paragraph {i} of the page's own long and winding story.</p>" for i in range(6))
    teaser = "<article><h3>Read next</h3><p>A teaser of another story.</p></article>"
    assert html_text.main_text(f"<main><h1>Title</h1>{own}{teaser}</main>").startswith("Title\nParagraph 0") and "Paragraph 5" in html_text.main_text(f"<main><h1>Title</h1>{own}{teaser}</main>")
    whole = html_text.main_text(f"<main><p>Intro.</p><article><h1>Title</h1>{own}</article></main>")
    assert whole.startswith("Title") and "Intro" not in whole
