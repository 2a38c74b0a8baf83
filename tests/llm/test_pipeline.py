import random

import corpus_pipeline
from ledgerleaf.llm import queries, simhash

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "mixing", "packing"]
    before = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        names, docs = docs.columns, spark.read.parquet(str(tmp_path / name))
        assert docs.columns == names
        ids = {r.doc_id for r in docs.collect()}
        assert ids and ids <= before
        before = ids
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in out.collect()} == before


def test_query_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def brute_similar(rows):
    """Components of 5-word Jaccard 0.8 or more, every pair compared."""
    sets, label = {}, {i: i for i, _ in rows}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    near = [(a, b) for a in sets for b in sets if a < b and (sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))]
    for _ in sets:
        for a, b in near:
            label[a] = label[b] = min(label[a], label[b])
    return label, near


def test_near_dedup_brute(spark):
    """Components against every pair compared: none too large, 0.95 or more of the later copies found, at any cell limit."""
    r = random.Random(8)
    rows = []
    shared = " ".join(f"common{k}" for k in range(12))
    for i in range(25):
        n = r.choice((40, 60, 200, 400))
        base = [f"w{r.randrange(3000)}" for _ in range(n)]
        for k in range(6):
            w = list(base)
            for _ in range(k and r.randint(1, max(1, n // 60))):
                w[r.randrange(n) if k % 2 else -r.randint(1, 3)] = f"New{r.randrange(99)}"
            rows.append((i * 10 + k, " ".join(w) + (" " + shared if i % 2 else "")))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE two"), (905, "one three")]
    # a group of copies of many edits, which no single member is near to
    base = [f"g{k}" for k in range(150)]
    for k in range(60):
        w = list(base)
        for _ in range(k % 5):
            w[r.randrange(150)] = f"x{r.randrange(10**6)}"
        rows.append((1000 + k, " ".join(w)))
    want, near = brute_similar(rows)
    assert any(dict(rows)[a] != dict(rows)[b] for a, b in near)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for limit, nearest in ((simhash.CELL_LIMIT, 4), (20, 1)):
        got = {x.doc_id: x.component_id for x in simhash.similar(docs, limit=limit, nearest=nearest).collect()}
        assert all(want[i] == want[c] for i, c in got.items())
        later = [i for i, c in want.items() if i != c]
        assert sum(got[i] != i for i in later) >= 0.95 * len(later)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    ids = {x.doc_id for x in kept.collect()}
    assert {i for i, c in want.items() if i == c} <= ids and len(ids) <= len(set(want.values())) + 0.05 * len(later)


def test_line_dedup_takes_single_lines(spark):
    rows = [(
        i,
        f"own words of {i}\nOf.\nlast of {i} here\nRead more about this on our site",
    ) for i in range(5)] + [(9, "Read  more about this on our site")]
    out = corpus_pipeline.dedup_lines(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {0: rows[0][1], **{i: f"own words of {i}\nOf.\nlast of {i} here" for i in range(1, 5)}}


def test_run_of_repeats_nulls_and_extra_columns(spark, tmp_path):
    """The whole pipeline on a small table: each kept text is packed once, and every piece of it."""
    prose = [" ".join(f"{w}{(i * 7 + k) % 90}" for k, w in enumerate("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda".split() * 4)) for i in range(12)]
    rows = [(i, t, "en", f"src{i % 2}", len(t)) for i, t in enumerate(prose)]
    rows += [
        rows[3],
        rows[3],
        (50, prose[4] + " one more", "en", "src1", 1),
        (51, None, None, None, None),
        (52, "", "en", "src0", 0),
        (53, "123 456", "en", "src0", 7),
    ]
    docs = spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long",
    ).selectExpr("*", "1 as node", "2 as component", "3 as part")
    (tmp_path / "sf").mkdir()
    docs.write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "sf")).collect()
    assert {r.doc_id for r in got} <= set(range(12)) and len({r.doc_id for r in got}) >= 8
    assert len({(r.doc_id, r.start) for r in got}) == len(got)  # a repeated row is not packed twice
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), "").collect() == []
        assert stage(spark, docs, "").columns == docs.columns
