"""The training-data operators against brute force, round trips and edge cases."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerleaf.llm import fingerprints, html_text, language, licenses, lines, mixing, packing, simhash, token_files, tokens, topk

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def make(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(5)
    texts = [" ".join(r.choice(WORDS) for _ in range(r.randint(1, 150))) for _ in range(60)]
    texts += [None, "", "  \n ", texts[0], texts[0], "é" * 9, "x"]
    rows = [(3 * i - 20, t, f"src{i % 3}") for i, t in enumerate(texts)]
    return rows + [(rows[1][0], rows[1][1], rows[1][2])], make


@pytest.fixture(scope="module")
def docs(spark, corpus):
    rows, fn = corpus
    return fn(spark, rows).repartition(5)


def encoded(texts, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.vocabulary_path())
    return [t.encode(x or "", add_special_tokens=False).ids + [end] for x in texts]


# ---------------------------------------------------------------- 1
def test_prefix_hash_spans_and_extensions():
    a, b = fingerprints.PrefixHash("abcabcabdé"), fingerprints.PrefixHash("xxabcabz")
    assert a.equal(0, a, 3, 5) and not a.equal(0, a, 3, 6)
    assert a.common_extension(0, b, 2) == 5 and a.common_extension(9, b, 0) == 0
    assert a.common_extension_back(5, b, 7) == 5 and a.common_extension_back(0, b, 4) == 0
    assert all(a.equal(i, b, j, n) == ("abcabcabdé"[i : i + n] == "xxabcabz"[j : j + n]) for n in range(5) for i in range(11 - n) for j in range(9 - n))
    assert fingerprints.PrefixHash("").n == 0


def brute_cover(a, b, least):
    """Places of a and of b in a common run of ``least`` code points or more, all pairs of positions compared."""
    ina, inb = set(), set()
    for i in range(len(a)):
        for j in range(len(b)):
            if a[i] == b[j] and (not i or not j or a[i - 1] != b[j - 1]):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
                    k += 1
                if k >= least:
                    ina |= set(range(i, i + k))
                    inb |= set(range(j, j + k))
    return len(ina) + len(inb)


def test_likeness_is_the_share_in_common_runs():
    r = random.Random(12)
    text = lambda n: "".join(r.choice("abcdefghij klmnop") for _ in range(n))
    of = lambda t: fingerprints.Fingerprint(fingerprints.codes_of(t))
    for turn in range(25):
        pieces = [text(r.randint(60, 120)) for _ in range(4)]
        a = "".join(pieces[k] + text(r.randint(20, 60)) for k in (0, 1, 2))
        b = "".join(text(r.randint(20, 60)) + pieces[k] for k in (2, 3, 0))
        x, y = of(a), of(b)
        for p, q, n in x.common_runs(y):
            assert a[p : p + n] == b[q : q + n]
            assert (p + n == len(a) or q + n == len(b) or a[p + n] != b[q + n]) and (not p or not q or a[p - 1] != b[q - 1])
        assert x.likeness(y) == pytest.approx(brute_cover(a, b, 20) / (len(a) + len(b)), abs=0.02)
        assert x.likeness(of(text(300))) < 0.05 and x.likeness(of(a)) == 1
        n = len(a)
        assert of(a).likeness(of(a[: n - n // 4] + b[: n // 4])) >= 0.74
    assert of("").likeness(of("")) == 1 and of("").likeness(of("x")) == 0
    # every place of either text lies in a run that the other has too
    a, b = "aaaa" * 50, "aaaa" * 40
    assert of(a).likeness(of(b)) == brute_cover(a, b, 12) / 360 == 1 and of("abcdefgh").likeness(of("abcdefxy")) == 0.75


def test_likeness_after_edits_of_any_kind():
    """Replaced, inserted, deleted and repeated code points against all pairs of positions."""
    r = random.Random(21)
    text = lambda n: "".join(r.choice("abcdefghij klmnop") for _ in range(n))
    of = lambda t: fingerprints.Fingerprint(fingerprints.codes_of(t))
    long = text(2000)
    for at in (0, 100, 1000, 1999):
        assert of(long).likeness(of(long[:at] + "#" + long[at + 1 :])) >= 0.99
        assert of(long).likeness(of(long[:at] + "##" + long[at:])) >= 0.99
    assert of(long).likeness(of(long + long)) == 1 and of(long * 2).likeness(of(long * 3)) == 1
    for turn in range(12):
        a = text(600)
        b = list(a)
        for _ in range(r.randint(1, 6)):
            at, kind = r.randrange(len(b)), r.randrange(3)
            b[at : at + (0 if kind == 0 else 1)] = "#" * (0 if kind == 2 else 1)
        b = "".join(b)
        if turn % 3 == 0:
            b = b[300:] + b[:400]
        x, y = of(a), of(b)
        assert x.likeness(y) == pytest.approx(brute_cover(a, b, 12) / (len(a) + len(b)), abs=0.02)
        assert x.likeness(y) == y.likeness(x)


def test_edited_fingerprints_brute(spark, docs, corpus):
    import hashlib

    rows = sorted(((i, t or "") for i, t, _ in corpus[0]))
    got = sorted(fingerprints.edited_fingerprints(docs, 4).collect(), key=lambda r: (r.doc_id, r.edited_sha256))
    want = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        q = len(t) // 4
        want.append((i, len(t), hashlib.sha256((t[: len(t) - q] + nxt[:q]).encode()).hexdigest()))
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    by_text = {}
    texts = dict(rows)
    for r in got:
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.n_chars < 4:
            assert r.near_edited == 1


def test_fingerprints_of_a_table(spark):
    """The query's contract columns by brute force on a whole table."""
    import hashlib

    sf = "/root/testdata/sf0.001"
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in fingerprints.op1_document_fingerprints(spark, sf).collect()}
    assert len(got) == len(rows)
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        q = len(t) // 4
        edited = t[: len(t) - q] + after[:q]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = (fingerprints.Fingerprint(fingerprints.codes_of(x)) for x in (t, edited, after))
        assert (got[i].fingerprint, got[i].edited_fingerprint, got[i].near_edited, got[i].near_next) == (str(a), str(b), a.likeness(b), a.likeness(c))


def test_fingerprints_of_empty_and_single_tables(spark):
    assert fingerprints.edited_fingerprints(make(spark, [])).count() == 0
    (r,) = fingerprints.edited_fingerprints(make(spark, [(None, "abcdefgh", "s")])).collect()
    assert r.doc_id is None and r.near_next == 1


# ---------------------------------------------------------------- 2
def test_language_fusion(spark):
    r = random.Random(1)
    en, de = ["the", "thing", "that", "with", "other"], ["der", "über", "schön", "und", "nicht"]
    rows = [(
        i,
        " ".join(r.choice(en if i % 2 else de) for _ in range(30)),
        "en" if i % 2 else "de",
        "a.de" if i % 2 == 0 else "b.com",
    ) for i in range(200)]
    rows += [
        (900, "", "en", "b.com"),
        (901, None, None, None),
        (902, "12345 %%", "de", "a.de"),
        (903, "the thing AKIAX7QZ3J9KD2 with that other", None, None),
    ]
    out = {x.id: x for x in language.identify(spark.createDataFrame(rows, "id long, text string, declared string, host string")).collect()}
    assert all(out[i].language == ("en" if i % 2 else "de") for i in range(200))
    assert [out[i].language for i in (900, 901, 902, 903)] == ["und", "und", "und", "en"]
    assert out[3].confidence > 0.99
    assert {x.language for x in language.identify(spark.createDataFrame(
        [(1, "abc", None, None)],
        "id long, text string, declared string, host string",
    )).collect()} == {"und"}


def test_language_every_suffix_counts(spark):
    rows = []
    for i in range(300):
        said = ("thing other thing other", "en") if i % 2 else ("gniht rehto gniht rehto", "de")
        rows += [(10 * i + k, *said, f"a{k}.t{i}") for k in range(3)] + [(10 * i + 9, "thing gniht", None, f"b.t{i}")]
    out = language.identify(spark.createDataFrame(rows, "id long, text string, declared string, host string")).where("declared is null").collect()
    assert len(out) == 300 and all(r.language == ("en" if r.id // 10 % 2 else "de") for r in out)


def test_many_languages(spark):
    """Three hundred declared languages of a few rows, each with letters of its own, beside a large one; one has a single row."""
    r = random.Random(3)
    rows = []
    for i in range(300):
        own = [chr(0x4E00 + 40 * i + r.randrange(40)) * 2 + chr(0x4E00 + 40 * i + r.randrange(40)) for _ in range(12)]
        for k in range(4):
            declared = None if k == 3 else f"l{i:03}"
            rows.append((10 * i + k, " ".join(r.choice(own) for _ in range(40)), declared, f"h{i}.x{i % 7}"))
    large = [(10_000 + i, " ".join(r.choice(WORDS) for _ in range(1500)), "en", "e.x") for i in range(400)]
    stray = [(5000, "zz qqz", "stray", "h.x"), (5001, " ".join(r.choice(WORDS) for _ in range(60)), "wrong", "h.x"), (5002, None, "no text", "h.x"), (5003, "ny", "", "h.x")]
    long = [(6000, " ".join(r.choice(WORDS) for _ in range(500)) * 3000, None, "h.x")]  # about 10 MB
    out = {x.id: x for x in language.identify(spark.createDataFrame(rows + large + stray + long, "id long, text string, declared string, host string").repartition(16)).collect()}
    assert all(out[10 * i + k].language == f"l{i:03}" for i in range(300) for k in range(4))
    assert all(out[10_000 + i].language == "en" for i in range(400))
    assert out[5000].said == "stray" and out[5000].text_language == "stray"
    # its own few trigrams do not win the text of a large language
    assert out[5001].text_language == "en" and out[6000].language == "en"
    assert out[5002].said is None and out[5002].language == "und" and out[5003].said is None


def test_trigram_blocks_and_sparse_scores(monkeypatch):
    """Texts in blocks give the trigrams of whole texts; the sparse model gives the sums of a dense one, in blocks or not."""
    r = random.Random(8)
    texts = ["", "a", " ", "a ", " a", "ab", "Ab, c--d  é1f", "ΑΣ ΟΔΟΣ", "漢字かな", "x" * 50] + ["".join(r.choice("aB é.1漢") for _ in range(n)) for n in range(40)]
    whole = [language.trigrams(t) for t in texts]
    counts = np.array([[r.randrange(3) for _ in range(language.BUCKETS)] for _ in range(5)])
    lang, bucket = np.nonzero(counts)
    model = language.Model(list("abcde"), lang, bucket, counts[lang, bucket])
    total = counts.sum(1, keepdims=True)
    noise = (language.NOISE * total + language.RARE) / (total + language.RARE)
    table = np.log((1 - noise) * counts / total + noise / language.BUCKETS)
    for size, block in ((1 << 18, 1 << 20), (1, 7), (3, 16), (7, 1)):
        monkeypatch.setattr(language, "TEXT_BLOCK", size)
        monkeypatch.setattr(language, "MODEL_BLOCK", block)
        for t, b in zip(texts, whole):
            assert np.array_equal(language.trigrams(t), b), (t, size)
            assert np.allclose(model.likelihoods(*language.trigram_counts(t)), table[:, b].sum(1), rtol=1e-5, atol=1e-4)


def test_language_of_repeats_long_texts_and_no_rows(spark):
    schema = "id long, text string, declared string, host string, language string, confidence string, n_trigrams string"
    long = "the other thing with that " * 40_000
    rows = [
        (1, long, "en", None),
        (2, "der über schön und nicht " * 20, "de", ""),
        (2, "der über schön und nicht " * 20, "de", ""),
        (None, "the thing", None, "x"),
    ]
    got = [(x.id, x.language) for x in language.identify(spark.createDataFrame([(*x, "a", "b", "c") for x in rows], schema)).collect()]
    assert sorted(got, key=str) == sorted([(1, "en"), (2, "de"), (2, "de"), (None, "en")], key=str)
    empty = spark.createDataFrame([], schema)
    assert language.identify(empty).collect() == [] and language.identify(empty, keep_text=False).collect() == []
    assert language.keep_identified(make(spark, [])).collect() == []


def brute_language(rows):
    """(language, confidence) by id from the formula itself: rows (id, text, declared, host)."""
    import math

    langs = sorted({d for _, _, d, _ in rows if d})
    grams = {i: language.trigrams(t or "") for i, t, _, _ in rows}
    count = {x: np.bincount(np.concatenate([grams[i] for i, _, d, _ in rows if d == x]), minlength=language.BUCKETS) for x in langs}
    noise = {x: (language.NOISE * c.sum() + language.RARE) / (c.sum() + language.RARE) for x, c in count.items()}
    p = {x: (1 - noise[x]) * c / c.sum() + noise[x] / language.BUCKETS for x, c in count.items()}
    like = {i: {x: float(np.log(p[x][g]).sum()) for x in langs} for i, g in grams.items()}
    best = {i: max(langs, key=lambda x: (like[i][x], -langs.index(x))) if len(grams[i]) else None for i in grams}
    domain = lambda h: ".".join(h.split(".")[-2:]) if h else None
    suffix = lambda h: h.rsplit(".", 1)[1] if h and "." in h else ""
    S = language.SMOOTH

    def n(x=None, **where):
        return sum(1 for i, _, d, h in rows if best[i] and (x is None or best[i] == x) and all({"host": h, "domain": domain(h), "suffix": suffix(h), "said": d}[k] == v for k, v in where.items()))

    every = {x: (n(x) + 1) / (n() + len(langs)) for x in langs}
    with_suffix = {x: sum(1 for i, _, _, h in rows if best[i] == x and suffix(h)) for x in langs}
    with_said = {x: sum(1 for i, _, d, _ in rows if best[i] == x and d) for x in langs}
    out = {}
    for i, _, d, h in rows:
        g = grams[i]
        if not len(g) or max(like[i].values()) <= -len(g) * math.log(language.BUCKETS):
            out[i] = ("und", 0.0)
            continue
        total = {}
        for x in langs:
            s = language.TEMPER * like[i][x]
            if h:
                over = (n(x, domain=domain(h)) + S * every[x]) / (n(domain=domain(h)) + S)
                s += math.log((n(x, host=h) + S * over) / (n(host=h) + S))
                if suffix(h):
                    share = max(n(suffix=suffix(h)) / sum(with_suffix.values()), 1e-6)
                    s += math.log((n(x, suffix=suffix(h)) + S * share) / (with_suffix[x] + S))
            else:
                s += math.log(every[x])
            if d:
                share = max(n(said=d) / sum(with_said.values()), 1e-6)
                s += math.log((n(x, said=d) + S * share) / (with_said[x] + S))
            total[x] = s
        top = max(langs, key=lambda x: (total[x], -langs.index(x)))
        out[i] = (top, 1 / sum(math.exp(v - total[top]) for v in total.values()))
    return out


def test_language_fusion_brute(spark):
    r = random.Random(21)
    words = {"en": "the thing that with other".split(), "de": "der über schön und nicht".split(), "fr": "le être où garçon avec".split()}
    rows = []
    for i in range(120):
        x = r.choice(list(words))
        mixed = words[x] + [r.choice(words[r.choice(list(words))])]
        text = r.choice([
            " ".join(r.choice(mixed) for _ in range(r.randint(1, 12))),
            "",
            "123 4",
        ]) if i % 9 == 0 else " ".join(r.choice(mixed) for _ in range(r.randint(1, 12)))
        rows.append((
            i,
            text,
            r.choice([x, x, None, r.choice(list(words))]),
            r.choice([f"{r.choice('ab')}.{x}{r.choice('12')}.{x}", "one.com", "local", None]),
        ))
    want = brute_language(rows)
    for x in language.identify(spark.createDataFrame(rows, "id long, text string, declared string, host string")).collect():
        assert x.language == want[x.id][0] and x.confidence == pytest.approx(want[x.id][1], rel=1e-3, abs=1e-4), (rows[x.id], want[x.id])


def test_language_keeps_documents_columns(spark, docs):
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.where("trim(translate(coalesce(text, ''), '\n', '')) = ''").collect()}


# ---------------------------------------------------------------- 3
def brute_lines(rows, min_words):
    """Every run of lines compared with every earlier one; blank lines go only within the shortest runs."""
    firsts, per, out = {}, {}, {}

    def passage(run):
        return len(run) >= lines.MIN_LINES or sum(len(s.split()) for _, s in run) >= min_words

    for i, t in sorted({(-(10**18) if i is None else i, t or "") for i, t in rows}):
        u = [(k, " ".join(x.replace("\t", " ").replace("\r", " ").split())) for k, x in enumerate(t.split("\n"))]
        per[i, t] = u = [(k, s) for k, s in u if s]
        for a in range(len(u)):
            for b in range(a, len(u)):
                if passage(u[a : b + 1]):
                    firsts.setdefault(tuple(s for _, s in u[a : b + 1]), (i, t, u[a][0]))
    for (i, t), u in per.items():
        gone = set()
        for a in range(len(u)):
            for b in range(a, len(u)):
                run = u[a : b + 1]
                if firsts.get(tuple(s for _, s in run), (i, t, u[a][0])) != (i, t, u[a][0]):
                    shortest = not (passage(run[1:]) and passage(run[:-1]))
                    gone |= set(range(u[a][0], u[b][0] + 1)) if shortest else {k for k, _ in run}
        out[i, t] = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)
    return out


@pytest.mark.parametrize("min_words", [lines.MIN_WORDS, 8, 50])
def test_line_dedup_brute(spark, min_words):
    r = random.Random(2)
    pool = [" ".join(r.choice(WORDS) for _ in range(n)) for n in (1, 1, 2, 2, 3, 4, 5, 6, 30, 60, 26, 27)]
    rows = [(i, "\n".join(r.choice(pool + ["", f"own {i} {k}"]) for k in range(r.randint(1, 9)))) for i in range(40)]
    rows += [(None, rows[0][1]), (100, None), (101, ""), (102, " \t\r\n\n"), rows[3]]
    want = brute_lines([x for x in rows if x[1] is not None], min_words)
    got = lines.dedup(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, tag int"), min_words).collect()
    assert len(got) == len(rows)
    for x in got:
        before = dict(rows)[x.doc_id]
        assert x.tag == 1
        if before is None:
            assert x.text is None
        else:
            assert x.text == want[-(10**18) if x.doc_id is None else x.doc_id, before]


def test_winnowing_stores_fewer_lines_and_meets_every_shared_window(spark):
    r = random.Random(7)
    text = "\n".join(" ".join(r.choice(WORDS) for _ in range(r.randint(1, 5))) for _ in range(300))
    docs = spark.createDataFrame([(1, text), (2, "other\n" + text)], "doc_id long, text string")
    rows = lines.selected(docs, 50).collect()
    assert 0 < len(rows) < 500 and not any(x.alone for x in rows)  # two of three lines at most are minima of three
    got = {x.doc_id: x.text for x in lines.dedup(docs, 50).collect()}
    assert got == {1: text, 2: "other"}
    assert lines.dedup(docs.limit(0)).collect() == []


def test_line_dedup_of_a_very_long_text(spark):
    body = "\n".join(f"line number {i} of it" for i in range(20_000))
    got = {x.doc_id: x.n_lines_removed for x in lines.dedup(spark.createDataFrame(
        [(1, body), (2, body + "\nand one more line")],
        "doc_id long, text string",
    )).collect()}
    assert got == {1: 0, 2: 20_000}


def test_clashing_columns(spark):
    extra = {c: F.lit(7) for c in (
        "_row",
        "_tag",
        "_spans",
        "fp",
        "term",
        "shard",
        "key",
        "leaf",
        "domain",
        "language",
        "confidence",
        "component_id",
        "text_language",
        "n_trigrams",
    )}
    docs = make(spark, [(1, "one two three\nfour", "s"), (2, "five six", "s")]).withColumns(extra)
    for stage in (lines.drop_repeats, simhash.keep_one, mixing.keep_mixed, language.keep_identified):
        out = stage(docs)
        assert out.columns == docs.columns and all(r[c] == 7 for r in out.collect() for c in extra)
    assert {r.doc_id for r in packing.pack(docs).collect()} == {1, 2}
    assert fingerprints.edited_fingerprints(docs, 2).count() == 2 and lines.dedup(docs).where("_tag = 7").count() == 2


# ---------------------------------------------------------------- 4
def test_encoder_equals_whole_texts():
    r = random.Random(3)
    letters = list("abcXYZ éÉßÀœŒİΣς's't're.,!?;:\n\t\r\x0b\x1c\x85\xa0 ́'’123½漢字한ﬁÅ√-_[]{}~`^|>/&#")
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(3000)] + ["", "don't I'LL", "a <|endoftext|>b <|x"]
    for part in (texts, texts[:-1]):
        ids, n = tokens.Encoder(tokens.vocabulary_path()).encode_array(pa.array(part, pa.string()), 7)
        want = encoded(part, 7)
        assert n.tolist() == list(map(len, want)) and ids.tolist() == [x for w in want for x in w]


def pairs_left(symbols, per):
    """Most places, none overlapping itself, of a pair of neighbouring symbols inside documents."""
    most, at = {}, 0
    for k in per.tolist():
        row, free = symbols[at : at + k].tolist(), {}
        at += k
        for i, pair in enumerate(zip(row, row[1:])):
            if free.get(pair, -2) < i - 1 or pair[0] != pair[1]:
                most[pair], free[pair] = most.get(pair, 0) + 1, i
    return max(most.values(), default=0)


@pytest.mark.parametrize("least", [2, 4])
def test_repair_runs_until_no_pair_is_frequent(least):
    rng = np.random.default_rng(1)
    for turn in range(6):
        n = rng.integers(1, 300, 60)
        ids = (rng.zipf(1.5, n.sum()) % (50, 3, 1, 2000, 50, 9)[turn]).astype(np.uint16)
        if turn == 4:  # exact copies, wherever they stand
            ids = np.concatenate([ids[:3000]] * 5 + [ids[17:3000]])
            n = np.array([3000] * 5 + [2983])
        alphabet, rules, lengths, symbols, per = token_files.repair(ids, n, least)
        assert (token_files.Grammar(alphabet, rules, lengths).expand(symbols) == ids[: n.sum()]).all() and per.sum() == len(symbols)
        assert pairs_left(symbols, per) < least
        assert lengths[len(alphabet) :].tolist() == [lengths[a] + lengths[b] for a, b in rules]
        if turn == 4:
            assert len(symbols) + 2 * len(rules) < len(ids) / 2.5


def test_random_access_inside_documents():
    rng = np.random.default_rng(2)
    n = np.array([1, 700, 3000, 50])
    ids = np.concatenate([rng.zipf(1.3, 751 - 50) % 40, np.tile(rng.integers(0, 30, 100), 30), rng.integers(0, 70_000 - 5_000, 50)]).astype(np.uint16)
    alphabet, rules, lengths, symbols, per = token_files.repair(ids, n)
    width, raw = token_files.packed(symbols)
    assert (token_files.unpacked(raw, width) == symbols).all() and lengths.max() > 16
    row = {
        "alphabet": alphabet.astype("<u4").tobytes(),
        "rules": rules.astype("<u4").tobytes(),
        "lengths": lengths.astype("<u4").tobytes(),
        "width": width,
        "symbols": raw,
        "doc_symbols": per.astype("<u4").tobytes(),
    }
    start = np.cumsum(n) - n
    for i in range(4):
        whole = ids[start[i] : start[i] + n[i]].tolist()
        assert token_files.decode(row, i).tolist() == whole
        for _ in range(20):
            a, b = sorted(rng.integers(0, n[i] + 2, 2).tolist())
            assert token_files.decode(row, i, a, b).tolist() == whole[a:b]
    for most, width in ((10, 2), (1 << 16, 3), (1 << 24, 4)):
        x = np.array([0, most], np.uint32)
        assert token_files.packed(x)[0] == width and (token_files.unpacked(token_files.packed(x)[1], width) == x).all()


def test_token_files_round_trip(spark, docs, corpus, tmp_path):
    path = str(tmp_path / "f")
    token_files.write(docs, path, parts=3, shard_tokens=500)
    got = sorted(token_files.read(spark, path).collect(), key=lambda r: r.start)
    rows = sorted((i, t or "") for i, t, _ in corpus[0])
    at = 0
    for r, (i, t), ids in zip(got, rows, encoded([t for _, t in rows], 1), strict=True):
        raw = np.array(ids, "<u4").tobytes()
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (i, at, len(ids), zlib.crc32(raw), raw)
        at += len(ids)
    shard = spark.read.parquet(path).first().asDict()
    whole = [x.tolist() for _, x in token_files.decode_shard(shard)]
    assert token_files.decode(shard, len(whole) - 1).tolist() == whole[-1]


def test_token_files_of_a_table_nulls_and_no_rows(spark, tmp_path):
    """The query's digests from brute force on a whole table; null ids come first; clashing columns; no rows."""
    sf = "/root/testdata/sf0.001"
    table = sorted(((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()))
    want, at = [], 0
    for (i, _), ids in zip(table, encoded([t for _, t in table], 1), strict=True):
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in token_files.op4_token_files(spark, sf).collect()) == want
    rows = make(
        spark,
        [(None, "alpha", "s"), (1, None, "s"), (1, "alpha", "s"), (1, "alpha", "s")],
    ).withColumn("shard", F.lit(1)).withColumn("key", F.lit(2))
    token_files.write(rows, str(tmp_path / "a"))
    assert [(r.doc_id, r.start) for r in token_files.read(spark, str(tmp_path / "a")).orderBy("start").collect()] == [(None, 0), (1, 2), (1, 3), (1, 5)]
    token_files.write(make(spark, []), str(tmp_path / "b"))
    assert token_files.read(spark, str(tmp_path / "b")).collect() == []


# ---------------------------------------------------------------- 5
def test_license_families(spark):
    rows = [
        (1, "Plain words here.\nReleased under the MIT License."),
        (2, "Licensed under the Apache License, Version 2.0.\nAll rights reserved."),
        (3, "the driver renewed her license yesterday"),
        (4, None),
        (5, ""),
        (6, "Licensed under the Frobnicator Public License 7"),
        (None, "Licensed under CC BY-NC 4.0."),
    ]
    got = {r.doc_id: r.licenses for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "mit", 2: "apache,proprietary", 3: "", 4: "", 5: "", 6: "unknown", None: "cc-by-nc"}


@pytest.fixture(scope="module")
def licence_model(spark):
    return licenses.fit(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


NOTICES = [
    "Released under the MIT terms",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "This work is under a Creative Commons Attribution 4.0 International",
    "CC BY-SA 4.0",
    "GPLv3",
    "dedicated under CC0",
    "free software under the terms",
]


def test_license_gate_is_exact(spark, licence_model):
    texts = [*NOTICES, "the", "", *licenses.UNKNOWN, *licenses.NONE, *licenses.TEMPLATES["bsd"]]
    prose = [t for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(40).collect() for t in r.text.split("\n")]
    docs = spark.createDataFrame(list(enumerate(texts + prose)), "doc_id long, text string")
    every = {r.doc_id: r.f for r in docs.select("doc_id", licenses.classify(F.col("text"), licence_model).family.alias("f")).collect()}
    got = {r.doc_id: r.licenses for r in licenses.scan(docs, licence_model).collect()}
    assert got == {i: "" if f == "none" else f for i, f in every.items()}
    assert all(got[i] for i in range(6)) and [got[i] for i in (1, 4, 5)] == ["mit", "gpl", "cc0"], got


def test_license_scores_brute(spark, licence_model):
    """Probabilities and similarities by plain Python from the model's weights."""
    m, texts = licence_model, [
        *NOTICES,
        "plain words of no licence at all",
        *licenses.UNKNOWN[:4],
        *(f"note that {t[0]}" for t in licenses.TEMPLATES.values()),
    ]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select(
        "i",
        licenses.classify(F.col("text"), m).alias("c"),
    ).orderBy("i").collect()
    families = sorted(licenses.TEMPLATES)
    for r, t in zip(got, texts):
        p = licenses._probabilities(m.logits(t), m.temperature)
        best = max(range(len(families)), key=p.__getitem__)
        pairs = licenses._grams(licenses.re.sub(r"[^\w]+|_", " ", t.lower()).split())
        like = max(licenses.likeness(pairs, families[best], x) for x in licenses.TEMPLATES[families[best]])
        none = p[m.classes.index("none")]
        family = families[best] if p[best] >= m.thresholds[best] and like >= licenses.CONFIRM and p[best] >= none else "none" if none >= max(p) else "unknown"
        assert r.c.probability == pytest.approx(p[best], abs=1e-9) and r.c.similarity == pytest.approx(like) and r.c.family == family


def test_license_notices_of_the_wild_and_prose_with_their_words(spark, licence_model):
    """Headers as projects write them are named; prose that holds a template's words and unlisted licences are not."""
    want = {
        "// SPDX-License-Identifier: Apache-2.0": "apache",
        "# SPDX-License-Identifier: GPL-2.0-only": "gpl",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.": "bsd",
        "GNU GENERAL PUBLIC LICENSE Version 2": "gpl",
        "This project is licensed under the MIT License - see the LICENSE.md file": "mit",
        "Copyright (c) 2001 Foo. All rights reserved.": "proprietary",
        "Boost Software License - Version 1.0": "unknown",
        "CC BY-ND 4.0": "unknown",
        "The MIT license plate fell off the car.": "",
        "all rights reserved for members": "",
        "Her MIT license exam was on Monday": "",
        "members keep all rights reserved for guests of the club": "",
        "the general public license fee rose": "",
    }
    docs = spark.createDataFrame(list(enumerate(want)), "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in licenses.scan(docs, licence_model).collect()}
    assert [got[i] for i in range(len(want))] == list(want.values())


def test_license_files_of_installed_packages(spark, licence_model):
    """Texts and labels by others: the licence files of the packages here and the licences that they declare."""
    from importlib.metadata import distributions

    declared = {"MIT": "mit", "Apache-2.0": "apache", "BSD-3-Clause": "bsd", "BSD-2-Clause": "bsd", "ISC": "isc", "MPL-2.0": "mpl"}
    classified = {"MIT License": "mit", "Apache Software License": "apache", "BSD License": "bsd"}
    rows = {}
    for d in distributions():
        tags = {c.rsplit(" :: ", 1)[-1] for c in d.metadata.get_all("Classifier") or [] if c.startswith("License ::")}
        expression = d.metadata.get("License-Expression") or ""
        label = {declared.get(expression), *(classified.get(c) for c in tags)} - {None}
        files = [f for f in d.files or [] if f.name in ("LICENSE", "LICENSE.txt", "LICENSE.md") and ".dist-info" in str(f)]
        if len(label) == 1 and len(files) == 1 and len(tags) < 2 and 400 < len(text := files[0].read_text("utf-8")) < 20_000:
            rows[text] = label.pop()
    if len(rows) < 10:
        pytest.skip("few packages declare one licence here")
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: set(r.licenses.split(",")) - {"unknown", "proprietary", ""} for r in licenses.scan(docs, licence_model).collect()}
    wrong = [(label, got[i]) for i, label in enumerate(rows.values()) if got[i] != {label}]
    assert sum(label in found for label, found in zip(rows.values(), map(got.get, range(len(rows))))) >= 0.95 * len(rows), wrong
    assert len(wrong) <= 0.1 * len(rows), wrong


def test_license_calibration_holds_whole_texts_out():
    held = {(n, t) for n, t, out in licenses.examples() if out}
    assert not held & {(n, t) for n, t, out in licenses.examples() if not out}
    assert {n for n, _ in held} == {*licenses.TEMPLATES, "unknown", "none"}


def test_license_of_wrapped_notices_edges_and_no_rows(spark, licence_model):
    wrapped = "First line of prose ends here.\n\n# Permission is hereby granted, free of\n# charge, to any person obtaining a\n# copy of this software.\n\nMore prose."
    loose = "Licensed under CC BY-SA 4.0\nand then the story goes on for many words without any stop or end at all of it"
    rows = [
        (1, wrapped),
        (2, loose),
        (2, loose),
        (3, None),
        (None, "All rights reserved."),
        (4, "word " * 200_000 + "end.\nAll rights reserved."),
        (5, "\n \t\r\n\n"),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, like string")
    got = sorted((r.doc_id or 0, r.licenses, [x["at"] for x in r.found]) for r in licenses.scan(docs, licence_model).collect())
    assert got == [
        (0, "proprietary", [0]),
        (1, "mit", [2]),
        (2, "cc-by-sa", [0]),
        (2, "cc-by-sa", [0]),
        (3, "", []),
        (4, "proprietary", [1]),
        (5, "", []),
    ]
    split = docs.where("doc_id in (1, 2)").select("doc_id", licenses.paragraphs(F.col("text")).alias("p")).distinct().orderBy("doc_id").collect()
    assert [[(x["at"], len(x["u"])) for x in r.p] for r in split] == [[(0, 1), (2, 3), (6, 1)], [(0, 2)]]
    empty = docs.limit(0)
    assert licenses.scan(empty).collect() == []


# ---------------------------------------------------------------- 6
def test_packing_whole(spark, docs, corpus):
    got = packing.pack(docs, window=256, shard_tokens=2000).collect()
    want = sorted((i, tuple(x)) for (i, _, _), x in zip(corpus[0], encoded([t for _, t, _ in corpus[0]], 2)))
    texts = dict(want)
    pieces, rows = {}, {}
    for r in got:
        ids = texts[r.doc_id][r.start : r.start + r.length]
        assert r.length > 0 and r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes()) and r.doc_tokens == len(texts[r.doc_id])
        pieces.setdefault(r.doc_id, []).extend(range(r.start, r.start + r.length))
        rows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, ids in want:
        assert sorted(pieces[i]) == sorted(list(range(len(ids))) * sum(j == i for j, _ in want))
    for spans in rows.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 256 and at & (at - 1) == 0  # full, or a power of two
    assert packing.pack(make(spark, [])).count() == 0


def bm25_of(texts):
    ids = [np.array(x, np.uint16) for x in texts]
    df = {}
    for x in ids:
        for t in set(x.tolist()):
            df[t] = df.get(t, 0) + 1
    return packing.Bm25(len(ids), sum(map(len, ids)), df), df


def brute_neighbours(texts, seed, df):
    """Positions by BM25 score of the seed's distinct terms, best first, from the formula itself."""
    import math

    n, average, scores = len(texts), max(1.0, sum(map(len, texts)) / len(texts)), []
    for x in texts:
        score = 0.0
        for t in set(texts[seed]):
            idf, tf = max(0.0, math.log((n - df[t] + 0.5) / (df[t] + 0.5))), x.count(t)
            score += idf * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(x) / average)) if tf else 0.0
        scores.append(score)
    return scores


def test_bm25_neighbours_brute():
    r = random.Random(9)
    texts = [[r.randrange(1, 400) if r.random() < 0.7 else r.randrange(1, 12) for _ in range(r.randint(1, 120))] for _ in range(80)]
    bm25, df = bm25_of(texts)
    shard = packing.Shard(np.concatenate([np.array(x, np.uint16) for x in texts]), np.array([len(x) for x in texts]), bm25)
    for seed in range(0, 80, 7):
        scores = brute_neighbours(texts, seed, df)
        got = shard.neighbours(seed).tolist()
        assert set(got) == {i for i, x in enumerate(scores) if x > 0}
        assert all(scores[a] >= scores[b] - 1e-4 for a, b in zip(got, got[1:]))


def test_strongest_term_brute():
    rng = np.random.default_rng(4)
    doc = np.sort(rng.choice([0, 1, 3, 4, 8], 60))
    term, w = np.arange(60) % 13 + 1, rng.integers(1, 5, 60).astype(np.float32)
    order = np.lexsort((term, doc))
    doc, term, w = doc[order], term[order], w[order]
    want = [min((t for d, t, x in zip(doc, term, w) if d == i and x == max(w[doc == i])), default=0) for i in range(10)]
    assert packing._strongest(doc, term, w, 10).tolist() == want and packing._strongest(doc[:0], term[:0], w[:0], 2).tolist() == [0, 0]


def test_windows_are_filled_greedily_by_best_unused_neighbour():
    r = random.Random(10)
    texts = [[r.randrange(1, 200) for _ in range(r.randint(5, 60))] for _ in range(60)]
    bm25, df = bm25_of(texts)
    shard = packing.Shard(np.concatenate([np.array(x, np.uint16) for x in texts]), np.array([len(x) for x in texts]), bm25)
    used, seen = set(), 0
    for pieces in shard.windows(64, carried=10):
        room = 54 if not seen else 64
        assert sum(m for _, _, m in pieces) <= room
        seed = pieces[0][0]
        used.add(seed)
        scores = brute_neighbours(texts, seed, df)
        for d, start, _ in pieces[1:]:
            assert start == 0 and d not in used
            best = max((x for i, x in enumerate(scores) if i not in used), default=0.0)
            assert scores[d] >= best - 1e-4 or best == 0.0
            used.add(d)
        seen += 1
    assert used == set(range(60)) and seen > 20


def test_powers_cut_without_padding():
    out = packing.powers([(1, 300, 0, np.arange(300)), (2, 77, 5, np.arange(72))])
    assert [sum(len(p[-1]) for p in x) for x in out] == [256, 64, 32, 16, 4]
    assert np.concatenate([p[-1] for q in out for p in q]).tolist() == [*range(300), *range(72)]
    assert [(d, start) for q in out for d, _, start, _ in q] == [(1, 0), (1, 256), (2, 5), (2, 25), (2, 57), (2, 73)]


def test_clusters_bring_neighbours_together(spark):
    """Recall of the corpus-wide BM25 top 10 within the same of 16 clusters: several times that of a deal by chance."""
    texts = [t.text for t in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").orderBy("doc_id").collect()]
    ids, n = tokens.Encoder(tokens.vocabulary_path()).encode_array(pa.array(texts, pa.string()), 2)
    df = dict(enumerate(np.bincount(packing.postings(ids, n)[1]).tolist()))
    bm25 = packing.Bm25(len(n), int(n.sum()), {t: x for t, x in df.items() if x})
    raw = [ids[e - k : e].tobytes() for e, k in zip(np.cumsum(n).tolist(), n.tolist())]
    doc, term, w = packing._vectors(bm25, raw, n)
    at = np.searchsorted(doc, np.arange(len(n) + 1)).tolist()
    centres, size = packing.clusters([(term[a:b], w[a:b]) for a, b in zip(at, at[1:])], 16)
    of = packing._nearest(centres, doc, term, w, len(n))
    assert np.bincount(of, minlength=len(size)).tolist() == size.tolist()
    shard = packing.Shard(ids, n, bm25)
    recall = [np.mean(of[[x for x in shard.neighbours(s)[:11] if x != s][:10]] == of[s]) for s in range(0, len(n), 10)]
    assert np.mean(recall) >= 0.4


def test_packing_of_null_ids_repeats_and_a_long_text(spark):
    long = " ".join(f"{WORDS[i % 24]}{i % 977}" for i in range(30_000))
    rows = [(None, f"text {i % 5} of none", "s") for i in range(300)] + [(7, "alpha beta", "s")] * 200 + [
        (8, long, "s"),
        (9, None, "s"),
        (10, "", "s"),
    ]
    docs = make(spark, rows).repartition(6).withColumn("part", F.lit("x")).withColumn("term", F.lit("y"))
    got = packing.pack(docs).collect()
    assert sum(r.length for r in got) == sum(len(x) for x in encoded([t for _, t, _ in rows], 2))
    assert {(r.length, r.doc_tokens) for r in got if r.doc_id in (9, 10)} == {(1, 1)}


# ---------------------------------------------------------------- 7
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><nav><a>Menu</a></nav>
<div class="cookie-notice">We use cookies</div><article><h1>Head &amp; tail</h1><p>One  <b>bold</b>word<br>next&nbsp;x</p><script>var a="<p>no</p>";</script>
<aside>aside</aside><form>f</form><div class="ad">buy</div><p>Last.</p></article><div id="comments"><p>first!</p></div><footer>&copy; x</footer>"""


def test_main_text():
    assert html_text.main_text(PAGE) == "Head & tail\nOne boldword next x\nLast."
    assert html_text.main_text(None) == html_text.main_text("") == ""
    plain = "<div>short</div>" * 6 + "<p>" + "long text " * 30 + "</p><p>more " + "words " * 20 + "</p>"
    assert html_text.main_text(plain).endswith("words") and "long text" in html_text.main_text(plain)
    assert html_text.main_text("<p>a<!-- open") == "" and html_text.main_text("<article>1 < 2 &lt; 3</article>") == "1 < 2 < 3"


def test_main_text_of_unmarked_pages():
    short = "A short paragraph of some sixty characters, no more than that."
    assert html_text.main_text(f"<body><nav><a>Menu</a></nav><h1>Head</h1><p>{short}</p><footer>f</footer></body>") == f"Head\n{short}"
    between = '<div class="ad">buy</div><form>f</form><aside>one</aside><div class="promo">two</div>'
    long = "long text " * 30
    assert html_text.main_text(f"<body><p>{long}</p>{between}<p>The end.</p></body>") == f"{long.strip()}\nThe end."
    assert html_text.main_text("<p>短い記事です</p>") == "短い記事です"


def labelled_pages():
    """(html, main text): articles in several templates, marked and unmarked, with parts that are no article."""
    r = random.Random(11)
    sentence = lambda n: (" ".join(r.choice(WORDS) for _ in range(n))).capitalize() + "."
    beside = [
        "<nav><ul>" + "".join(f"<li><a href=/x>{w}</a></li>" for w in WORDS[:6]) + "</ul></nav>",
        '<div class="cookie-notice">We use cookies to make this page better for you and for all others.</div>',
        '<div id="ad-slot-3" class="ad">Buy one, get another one for half the price, this week only, while stocks last.</div>',
        '<aside class="sidebar"><p>About the author of this page, who lives far away and writes a lot.</p></aside>',
        '<form><label>Your address</label><input name=q><button>Go</button></form>',
        "<div><a href=/1>One more page</a> <a href=/2>And another page</a> <a href=/3>A third one</a></div>",
    ]
    after = [
        '<div id="comments"><p>first! what a long comment this is, going on and on and on about it all</p></div>',
        "<footer>&copy; x, all of it, in every country and for ever and a day</footer>",
    ]
    for turn in range(120):
        body = [f"<h1>{sentence(4)}</h1>"] + [f"<p>{sentence(r.choice((1, 2, 12, 30, 60)))}</p>" for _ in range(r.randint(3, 9))]
        body[1] = f"<p>{sentence(40)}</p>"
        text = [b[b.index(">") + 1 : b.rindex("<")] for b in body]
        for _ in range(r.randint(0, 3)):
            body.insert(r.randint(2, len(body)), r.choice(beside[2:5]))
        inner = "\n".join(body)
        inner = [
            f"<article>{inner}</article>",
            f'<main><div class="post-body">{inner}</div></main>',
            f'<div class="entry">{inner}</div>',
            f'<div class="share-price"><div>{inner}</div></div>',
        ][turn % 4]
        yield f"<!DOCTYPE html><html><head><title>t</title></head><body>{''.join(r.sample(beside, 4))}{inner}{''.join(after)}</body></html>", "\n".join(text)


def test_main_text_of_labelled_pages_precision_and_recall():
    got_words = right = wanted = 0
    for html, text in labelled_pages():
        got, want = html_text.main_text(html).split("\n"), text.split("\n")
        got_words, wanted = got_words + len(got), wanted + len(want)
        right += len(set(got) & set(want))
    assert right >= 0.99 * wanted and right >= 0.99 * got_words


def test_sums_decide_what_is_main_text():
    """Without the choice between surge and dive, every block of the page would be there."""
    for html, text in labelled_pages():
        assert html_text.main_text(html) != "\n".join(r[0] for r in html_text.blocks(html))
    leading = "<div>12 May</div><div>By X</div><div>5 min</div><div>Print</div>"
    long = "long text " * 30
    page = f"<body>{leading}<h1>Head</h1><p>{long}</p><p>End.</p><div><a>One</a></div><div><a>Two</a></div></body>"
    assert html_text.main_text(page).split("\n")[-2:] == [long.strip(), "End."] and "12 May" not in html_text.main_text(page)
    assert html_text.surge_and_dive([5, 0, 0, 90, 3, 0, 0, 0, 4, 0]) == (3, 9) and html_text.surge_and_dive([]) == (0, 0)


def test_article_parts_with_names_like_menus_stay():
    for name in ("post-header", "share-price", "related-work", "menu-item", "notice-period-law"):
        assert html_text.main_text(f'<article><h1>T</h1><div class="{name}">Some text of it.</div></article>') == "T\nSome text of it."
    assert html_text.main_text("<header>Site</header><article><header><h1>Own title</h1></header><p>Text.</p></article>") == "Own title\nText."
    for name in ("cookie-notice", "ad", "ad slot-2", "site-footer", "related-posts", "sidebarLeft"):
        assert html_text.main_text(f'<article><p>Text.</p><div class="{name}">Some text of it.</div></article>') == "Text."


def test_linked_headings_of_unmarked_pages_stay():
    page = "<body><nav><a>Menu</a></nav><h2><a href=/x>Linked title</a></h2><p>" + "long text " * 20 + "</p><div><a>One more page</a></div></body>"
    assert html_text.main_text(page).split("\n") == ["Linked title", ("long text " * 20).strip()]


def test_unclosed_markup_takes_linear_time():
    import time

    start = time.perf_counter()
    for piece in ('<a href="', "<a '", "<", "<!--", "<script>", "<p class=", '<b "\'>', "&am"):
        html_text.main_text("<p>x</p>" + piece * (1_000_000 // len(piece)))
    assert time.perf_counter() - start < 8
    assert html_text.main_text("<article>one two<a href='x") == "one two"


def test_extract_reads_pages_by_row(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    long = "<article>" + "".join(f"<p>word {i}</p>" for i in range(30_000)) + "</article>"
    rows = [(1, "u", PAGE, "a", "b"), (1, "u", PAGE, "a", "b"), (2, None, None, None, None), (None, "v", "", "", ""), (3, "w", long, "", "")]
    got = [tuple(r) for r in html_text.extract(spark.createDataFrame(rows, schema)).collect()]
    want = [(r[0], r[1], html_text.main_text(r[2]), len(html_text.main_text(r[2]))) for r in rows]
    key = lambda x: (x[0] is None, x[0] or 0)
    assert sorted(got, key=key) == sorted(want, key=key) and want[-1][3] > 200_000
    assert html_text.extract(spark.createDataFrame([], schema)).collect() == []
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    assert {r.page_id: r.text for r in html_text.op7_main_text(spark, "/root/testdata/sf0.001").collect()} == {r.page_id: html_text.main_text(r.html) for r in table}


# ---------------------------------------------------------------- 8
def brute_simhash(text):
    from xxhash import xxh64_intdigest

    w = (text or "").encode().lower().split()
    g = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxh64_intdigest(x, 42) for x in g]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(labels):
    out = {}
    for k, v in labels.items():
        out.setdefault(v, set()).add(k)
    return sorted(map(sorted, out.values()))


@pytest.mark.parametrize("limit", [simhash.CELL_LIMIT, 2])
def test_near_duplicates_brute(spark, limit):
    r = random.Random(4)
    rows = []
    for i in range(12):
        base = [r.choice(WORDS) + str(r.randint(0, 40)) for _ in range(400)]
        for k in range(6):
            w = list(base)
            for _ in range(k // 2):
                w[r.randrange(400)] = "Changed"
            rows.append((i * 10 + k, " ".join(w)))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "one two"), (504, "ONE two")]
    got = {x.doc_id: x for x in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), limit).collect()}
    fp = {i: brute_simhash(t) for i, t in rows}
    assert {i: int(x.fingerprint, 16) for i, x in got.items()} == fp
    label = {i: i for i in fp}
    for _ in fp:
        for a in fp:
            for b in fp:
                if bin(fp[a] ^ fp[b]).count("1") <= 2:
                    label[a] = label[b] = min(label[a], label[b])
    assert {i: x.component_id for i, x in got.items()} == label


def test_gray_index_brute():
    rng = np.random.default_rng(3)
    for turn in range(25):
        base = rng.integers(0, 2**63, 6, dtype=np.uint64)
        f = np.unique(np.array(
            [int(rng.choice(base)) ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 5)), replace=False)) for _ in range(150)],
            np.uint64,
        ))
        side = rng.integers(0, 2, len(f)) if turn % 2 else None

        def joined(pairs):
            p = list(range(len(f)))

            def root(i):
                while p[i] != i:
                    i = p[i]
                return i

            for a, b in pairs:
                p[root(a)] = root(b)
            return groups({i: root(i) for i in range(len(f))})

        close = np.triu(np.bitwise_count(f[:, None] ^ f[None]) <= 2, 1)
        if side is not None:
            close &= side[:, None] != side[None]
        got = simhash.cell_links(f, side)
        assert joined(np.searchsorted(f, got).tolist()) == joined(np.argwhere(close).tolist()) and len(got) < len(f)


def test_masks_meet_every_pair_within_the_radius():
    masks = simhash.block_masks()
    assert len(masks) == 10 and all(m.bit_count() >= 38 for m in masks)
    pairs = [(1 << a) | (1 << b) for a in range(64) for b in range(64)]
    assert all(any(not d & m for m in masks) for d in pairs)


def test_word_index_recall(spark):
    """Of all pairs of sf0.01 and edited copies at 0.8 or more, the index brings at least 0.95 together."""
    r = random.Random(6)
    texts = [t.text for t in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    made = []
    for t in r.sample([t for t in texts if len(t) > 400], 150):
        w = t.split()
        for _ in range(max(1, len(w) // 60)):
            w[r.randrange(len(w))] = r.choice(WORDS)
        made.append(" ".join(w))
    sets = [simhash._sets_of(t, 5) for t in texts + made]
    last, near, met = len(texts), 0, 0
    masks = simhash.word_masks()
    for i, (a, f) in enumerate(sets):
        for b, g in sets[max(i + 1, last) :] if i < last else []:
            if len(a) and 4 * len(b) <= 5 * len(a) and 4 * len(a) <= 5 * len(b):
                if len(np.intersect1d(a, b, assume_unique=True)) * 9 >= (len(a) + len(b)) * 4:
                    near += 1
                    met += (f ^ g).bit_count() <= simhash.WORD_RADIUS and any(not (f ^ g) & m for m in masks)
    assert near > 80 and met >= 0.95 * near


def edited(r: random.Random, words: list[str]) -> list[str]:
    """A copy changed as far as a similarity of 0.8 allows: the last word, then single words anywhere."""
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    alike = lambda w: 9 * len(grams(words) & grams(w)) >= 4 * (len(grams(words)) + len(grams(w)))
    now = words + [f"x{r.random()}"] if len(words) < 14 else words[:-1] + [f"x{r.random()}"]
    for _ in range(len(words)):
        w = list(now)
        w[r.randrange(len(w))] = f"y{r.random()}"
        if alike(w):
            now = w
    return now if alike(now) else words + [words[0]]


def test_similar_finds_copies_of_every_length(spark):
    """At 0.8 or more, in each class of length at least 0.95 of the pairs meet, and unlike texts stay apart."""
    r, rows, of = random.Random(31), [], {}
    for size in (8, 10, 12, 16, 20, 30, 50, 100, 200, 300):
        for _ in range(60):
            i = 2 * len(of)
            words = [f"w{r.random()}" for _ in range(size)]
            rows += [(i, " ".join(words), "s"), (i + 1, " ".join(edited(r, words)), "s")]
            of[i] = size
    shared = [f"t{i}" for i in range(12)]
    first = 2 * len(of)
    rows += [(first + i, " ".join(shared + [f"w{r.random()}" for _ in range(12)]), "s") for i in range(200)]
    for limit in (simhash.CELL_LIMIT, 40):
        got = {x.doc_id: x.component_id for x in simhash.similar(make(spark, rows), limit=limit).collect()}
        for size in set(of.values()):
            ids = [i for i in of if of[i] == size]
            assert sum(got[i + 1] == i for i in ids) >= 0.95 * len(ids), (size, limit)
        assert all(got[i] == i for i in of) and all(got[first + i] == first + i for i in range(200))


def test_bands_meet_at_the_promised_rate():
    r = np.random.default_rng(5)
    for n in (5, 12, 40, 200, 2000):
        met = 0
        for _ in range(300):
            h = np.unique(r.integers(0, 1 << 63, n + max(1, n // 9), np.uint64))
            gone = max(1, n // 9)
            a, b = simhash.bands(np.sort(h[gone:])), simhash.bands(np.sort(h[:-gone] if n > 5 else h))
            met += any(x == y for x, y in zip(a, b))
        assert met >= 0.97 * 300, n
    assert simhash.bands(np.arange(3, dtype=np.uint64)) is None
    h = np.unique(r.integers(0, 1 << 63, 5000, np.uint64))
    assert simhash.bands(h) == simhash.bands(h.copy()) and len(simhash.bands(h)) == simhash.BANDS


def test_similar_of_repeats_nulls_and_no_rows(spark):
    assert simhash.keep_one(make(spark, [])).count() == 0 and simhash.near_duplicates(make(spark, [])).count() == 0
    text = "one two three four five six seven"
    docs = make(
        spark,
        [(1, text, "a"), (1, text, "a"), (2, text, "b"), (1, "quite another text of more words", "a"), (None, text, "c"), (None, text, "c")],
    )
    assert sorted((r.doc_id or 0, r.text) for r in simhash.keep_one(docs).collect()) == sorted([
        (1, text),
        (1, "quite another text of more words"),
        (0, text),
        (0, text),
    ])
    long = " ".join(f"w{i}" for i in range(60_000))
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(make(
        spark,
        [(1, long, "a"), (2, long + " w", "a"), (None, long, "a")],
    )).collect()}
    assert got == {1: 1, 2: 1, None: None}


def test_keep_one_and_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "u long, v long")
    got = {r.node: r.component for r in simhash.components(links).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}
    docs = make(
        spark,
        [(7, "same text here now", "s"), (3, "same text here now", "s"), (None, "same text here now", "s"), (9, "quite other words in this", "s")],
    )
    assert {r.doc_id for r in simhash.keep_one(docs).collect()} == {3, None, 9}


# ---------------------------------------------------------------- 9
def test_mixing_budget(spark, docs):
    out = mixing.mix(docs).collect()
    tokens_all = docs.select(F.sum(mixing.tokens_in(F.col("text")))).first()[0]
    leaf = {(r.domain, r.language, r.source): (r.leaf_tokens, r.leaf_budget) for r in out}
    assert sum(b for _, b in leaf.values()) <= tokens_all * 3 // 5 and all(b <= 2 * t for t, b in leaf.values())
    longest = docs.select(F.max(mixing.tokens_in(F.col("text")))).first()[0]
    for k, (_, b) in leaf.items():
        took = sum(r.n_tokens for r in out if (r.domain, r.language, r.source) == k)
        assert b <= took < b + 2 * longest
    assert mixing.mix(make(spark, [])).count() == 0


def test_mixing_shortage_goes_to_siblings(spark):
    rows = [(i, "w " * 10, s) for i, s in enumerate(["a"] * 1 + ["e"] * 20 + ["b"] * 20)]
    docs = make(spark, rows).withColumn("lang", F.lit("en"))
    out = mixing.mix(docs, total=(1, 2), max_epochs=1, domains={}, domain=F.when(F.col("source") == "b", "y").otherwise("x")).collect()
    budget = {r.source: r.leaf_budget for r in out}
    assert budget == {"a": 10, "e": 93, "b": 102}


# ---------------------------------------------------------------- 10
def test_top_k_brute(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(300, 8)), 1).astype(np.float32)
    rows = [(int(i), [float(v) for v in x[i]]) for i in range(300)] + [(1000, None), (1001, [float("nan")] * 8), (1002, [1.0, None] + [0.0] * 6)]
    v = topk.finite_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(v.where("vec_id % 50 = 0"), v, 10, 2, 64).collect()}
    n = np.floor(1024 * x.astype(float)).astype(int)
    for q in range(0, 300, 50):
        s = n @ n[q]
        best = [i for i in np.lexsort((np.arange(300), -s)) if i != q][:10]
        assert [got[q, k + 1] for k in range(10)] == [(i, s[i]) for i in best]
    assert len(got) == 60


def test_top_k_of_large_components_repeats_and_empty_tables(spark):
    """Exact beyond 64 bits, and at 3e6 x 64; repeated rows and rows of one vec_id; no rows at all."""
    schema = "vec_id long, embedding array<double>, v string, score string"

    def run(rows, k=10):
        v = topk.finite_vectors(spark.createDataFrame([(*r, "x", "y") for r in rows], schema), "vec_id", "embedding")
        return [tuple(r) for r in topk.top_k(v.where("vec_id % 100 = 0"), v, k).orderBy("query_id", "rank").collect()]

    assert run([(0, [3e6] * 64), (1, [3e6] * 64)]) == [(0, 1, 1, 2**63 - 1)]
    assert run([(0, [3e6] * 8), (1, [3e5] * 8)]) == [(0, 1, 1, 8 * 3_000_000 * 300_000 * 1024**2)]
    assert run([(0, [1e30, 1.0]), (1, [1e30, 0.0]), (2, [1e30, 1.0]), (3, [-1e300, 0.5])]) == [
        (0, 1, 2, 2**63 - 1),
        (0, 2, 1, 2**63 - 1),
        (0, 3, 3, -(2**63)),
    ]
    # ties to the smaller vec_id; a shorter vector; a row that repeats the query, and another of its vec_id
    rows = [(100, [1.0, 2.0]), (100, [1.0, 2.0]), (100, [9.0]), (5, [1.0, 2.0]), (4, [1.0, 2.0]), (6, [])]
    mb = 1 << 20
    one = [(100, 1, 100, 9 * mb), (100, 2, 4, 5 * mb), (100, 3, 5, 5 * mb), (100, 4, 100, 5 * mb), (100, 5, 6, 0)]
    other = [(100, 1, 4, 9 * mb), (100, 2, 5, 9 * mb), (100, 3, 100, 9 * mb), (100, 4, 100, 9 * mb), (100, 5, 6, 0)]
    assert sorted(run(rows)) == sorted(one + other)
    assert run([]) == [] and run([(100, [1.0])]) == []
