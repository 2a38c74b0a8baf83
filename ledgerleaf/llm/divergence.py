"""Source divergence audit: how far the sources of a language are apart, by joint histograms of their term counts.

A term is a run of letters, ASCII or beyond; only A-Z are lower-cased.  A language keeps the terms of at least ``LEAST_DOCS`` of its
documents.  Each (lang, source) group, and each language, gives every kept term an integer weight p = 1 + floor(1e9 * (count + 5) /
(N + 5 * V)); two groups differ by the sum of abs(p - q) over all kept terms of the language.

1. ``tallies``: a batch of documents is counted at once: occurrences and documents of each (lang, source, term).
2. ``kept_counts``: summed up by (lang, source, term), of which a language's rare terms go.
3. ``pair_histograms``: groups of one language meet term by term, and for each pair the distinct (count, count) combinations are
   tallied, not the terms.  Cells with a zero are implied: a term that both groups have takes one from their marginal cells (c, 0)
   and (0, d) and gives one to (0, 0), so the tallies of marginals and meetings add up to the whole histogram, absent terms included.
4. ``divergence``: abs(p - q) is evaluated once for each combination and multiplied by its tally.

A term meets as many groups as its language has sources, a group as many others: what is reported is all pairs of sources, so this work is
of the size of the result.  The table of groups is broadcast while it is small (it is counted).  All arithmetic is in whole numbers.

Null texts, languages and sources read as ''.  A group without kept terms has N = 0; a language without any has V = 0, and its pairs differ
by 0.  Repeated rows are documents of their own; doc_ids are not read.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from . import common

LEAST_DOCS, SMOOTH, SCALE, TOP_TERMS = 30, 5, 1_000_000_000, 50
#: What separates terms: ASCII but letters.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of text that are counted at once.
BATCH = 8 << 20
TALLY = "lang string, source string, term string, n long, docs long"


def _tally(langs: pa.Array, sources: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), BETWEEN)
    terms, of = lists.flatten(), np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    full = np.asarray(pc.greater(pc.binary_length(terms), 0))  # what is before the first separator or behind the last may be empty
    coded = terms.dictionary_encode()
    codes, of = coded.indices.to_numpy()[full].astype(np.int64), of[full]
    groups, names = pd.MultiIndex.from_arrays([langs.to_pandas(), sources.to_pandas()]).factorize()
    width = max(1, len(coded.dictionary))
    in_doc, n = np.unique(of * width + codes, return_counts=True)
    pairs, at = np.unique(groups[in_doc // width].astype(np.int64) * width + in_doc % width, return_inverse=True)
    group = pa.array(pairs // width)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([x[0] for x in names], pa.string()).take(group),
            pa.array([x[1] for x in names], pa.string()).take(group),
            coded.dictionary.take(pa.array(pairs % width)),
            pa.array(np.bincount(at, weights=n, minlength=len(pairs)).astype(np.int64)),
            pa.array(np.bincount(at, minlength=len(pairs)).astype(np.int64)),
        ],
        names=["lang", "source", "term", "n", "docs"],
    )


def tallies(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of pieces of docs: occurrences, and documents that have the term."""

    def run(batches):
        for b in batches:
            sizes = np.cumsum(pc.binary_length(b.column(2)).to_numpy(zero_copy_only=False))
            lo = 0
            while lo < b.num_rows:
                hi = min(b.num_rows, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + BATCH)) + 1)
                part = b.slice(lo, hi - lo)
                yield _tally(part.column(0), part.column(1), part.column(2))
                lo = hi
        common.trim()

    common.ship(docs.sparkSession)
    return docs.select("lang", "source", "text").mapInArrow(run, TALLY)


def kept_counts(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, term, n, lang_n): occurrences of the kept terms in each group that has them, and in the language."""
    sums = tallies(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")  # a row a source
    rows = sums.withColumns({"_docs": F.sum("docs").over(term), "lang_n": F.sum("n").over(term)})
    return rows.where(F.col("_docs") >= least_docs).select("lang", "source", "term", "n", "lang_n")


def weight(count: Column | int, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * terms)), exact; 1 for a language without terms."""
    count = F.lit(count) if isinstance(count, int) else count
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + SMOOTH).cast("decimal(19,0)")
    below = (total + SMOOTH * terms).cast("decimal(19,0)")
    return 1 + F.call_function("div", top, F.when(below > 0, below)).cast("long")


def grouped(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, g, total, terms, lang_total, lang_terms): every group by number; terms are those that it has."""
    groups = docs.select("lang", "source").distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    # sums by source first: a language's terms are not counted in one place
    of = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count("*").alias("lang_terms"))
    rows = groups.join(own, ["lang", "source"], "left").join(common.few(of), "lang", "left")
    return common.cut(rows.fillna(0, ["total", "terms", "lang_total", "lang_terms"]).withColumn("g", F.monotonically_increasing_id()))


def pair_histograms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, i, j, ci, cj, m): of each pair of groups i < j, how many of the language's kept terms have these two counts."""
    cells = kept.join(common.few(groups.select("lang", "source", "g")), ["lang", "source"]).select("lang", "term", "g", "n")
    a, b = cells.withColumnsRenamed({"g": "i", "n": "ci"}), cells.withColumnsRenamed({"g": "j", "n": "cj"})
    met = a.join(b, ["lang", "term"]).where("i < j")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def cell(ci, cj, m):
        return F.struct(ci.alias("ci"), cj.alias("cj"), m.alias("m"))

    ci, cj = F.col("ci"), F.col("cj")
    both = met.select("lang", "i", "j", F.inline(F.array(cell(ci, cj, one), cell(ci, zero, -one), cell(zero, cj, -one), cell(zero, zero, one))))
    # each group's own histogram, once for each other group
    own = cells.groupBy("lang", "g", "n").agg(F.count("*").alias("m"))
    others = common.few(groups.select("lang", F.col("g").alias("o")))
    own = own.join(others, "lang").where("g <> o")
    n, first = F.col("n"), F.col("g") < F.col("o")
    margins = own.select(
        "lang",
        F.least("g", "o").alias("i"),
        F.greatest("g", "o").alias("j"),
        F.inline(F.array(cell(F.when(first, n).otherwise(zero), F.when(first, zero).otherwise(n), F.col("m")), cell(zero, zero, -F.col("m")))),
    )
    every = groups.select("lang", F.col("g").alias("i"), "lang_terms").join(common.few(groups.select("lang", F.col("g").alias("j"))), "lang").where("i < j")
    absent = every.select("lang", "i", "j", zero.alias("ci"), zero.alias("cj"), F.col("lang_terms").alias("m"))
    return both.unionByName(margins).unionByName(absent).groupBy("lang", "i", "j", "ci", "cj").agg(F.sum("m").alias("m"))


def divergence(histograms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, i, j, value) of each pair i < j: the difference of a combination times the terms that have it."""
    side = groups.select("g", "total", "lang_terms")
    i = common.few(side.withColumnsRenamed({"g": "i", "total": "ti", "lang_terms": "v"}))
    j = common.few(side.select(F.col("g").alias("j"), F.col("total").alias("tj")))
    rows = histograms.join(i, "i").join(j, "j")
    apart = F.abs(weight(F.col("ci"), F.col("ti"), F.col("v")) - weight(F.col("cj"), F.col("tj"), F.col("v")))
    return rows.groupBy("lang", "i", "j").agg(F.sum(F.when(F.col("m") == 0, 0).otherwise(F.col("m") * apart)).alias("value"))


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): how far each group is from each other source of its language."""
    found = divergence(pair_histograms(kept, groups), groups)
    sides = F.inline(F.array(F.struct(F.col("i").alias("g"), F.col("j").alias("o")), F.struct(F.col("j").alias("g"), F.col("i").alias("o"))))
    both = found.select("value", sides)
    names = common.few(groups.select("lang", "source", "g"))
    others = common.few(groups.select(F.col("source").alias("item"), F.col("g").alias("o")))
    return both.join(names, "g").join(others, "o").select("lang", "source", "item", F.coalesce("value", F.lit(0)).alias("value"))


def marked_terms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): terms that a group holds more often than its language, by how much."""
    rows = kept.join(common.few(groups.drop("terms", "g")), ["lang", "source"])
    p = weight(F.col("n"), F.col("total"), F.col("lang_terms"))
    q = weight(F.col("lang_n"), F.col("lang_total"), F.col("lang_terms"))
    return rows.select("lang", "source", F.col("term").alias("item"), (p - q).alias("value")).where("value > 0")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): part 'pair' over all other sources, part 'term' the ``top_terms`` first."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    docs = docs.select(text("lang"), text("source"), text("text"))
    kept = common.cut(kept_counts(docs, least_docs))
    groups = grouped(docs, kept)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = source_pairs(kept, groups).withColumn("rank", rank).withColumn("part", F.lit("pair"))
    terms = marked_terms(kept, groups).withColumn("rank", rank).where(F.col("rank") <= top_terms).withColumn("part", F.lit("term"))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(common.table(spark, sf_dir, "documents").select("lang", "source", "text"))


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
QUERIES = {"op12_source_divergence": op12_source_divergence}
ORACLES = {
    "op12_source_divergence": f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), {_LETTERS}) AS text FROM documents),
x AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM x GROUP BY lang, term HAVING count(DISTINCT r) >= {LEAST_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM x GROUP BY ALL),
c AS (SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n, count(*) OVER (PARTITION BY g.lang, g.source) AS v
  FROM g JOIN k ON g.lang = k.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
s AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, sum(n) OVER (PARTITION BY lang, term) AS lang_n, sum(n) OVER (PARTITION BY lang) AS lang_total FROM c),
p AS (SELECT lang, source, term, n, 1 + CAST({SCALE} AS HUGEINT) * (n + {SMOOTH}) // (total + {SMOOTH} * v) AS p,
  1 + CAST({SCALE} AS HUGEINT) * (lang_n + {SMOOTH}) // (lang_total + {SMOOTH} * v) AS q FROM s),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
e AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM e)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM o WHERE part = 'pair' OR rank <= {TOP_TERMS}
""",
}
