"""Target-distribution importance resampling over hashed word and word-pair features, counted and scored in word tries.

Words are runs of letters and digits, ASCII or beyond, after A-Z are lower-cased.  A document's features are its runs of 1 to ``ORDER`` words,
joined by one space, repeats counted; a feature's bucket is its crc32 modulo ``BUCKETS``.

``Trie`` holds the features of one piece of a partition: a node is a run of words, its parent the run without the last word.  A node keeps how
often its run occurs and the crc32 state behind its bytes, so a child's state is carried on from its parent's (by tables for the length
of the last word, a level at once) and no feature's text is ever put together.

1. ``bucket_counts``: every piece's trie sums its nodes' counts by bucket; bucket totals are merged over the corpus, and over the target.
2. ``gains``: one whole number a bucket, the log ratio of the smoothed shares in target and corpus.
3. ``weights``: documents walk their piece's trie with gains attached to its nodes; a document's weight is the floored mean over its features.
4. ``draw``: Gumbel noise from the doc_id makes the highest scores a sample without replacement.  Ranks come from range partitions
   by score: counts of partitions are added up, never one sort of all documents.

Memory is bounded by ``PIECE`` bytes of text at once (a longer text is a piece of its own); what reaches the driver is one number a bucket and one a
partition.  A very frequent feature is one node of each piece, and a row a bucket is all that is shuffled.

Null texts have no features and weigh 0.  A null doc_id draws noise from '7:' alone and comes after others of equal score.  Repeated rows are
documents of their own, of equal scores and neighbouring ranks.  Empty tables give empty results (an empty target gives gains all the same).
Columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

ORDER, BUCKETS, SCALE, SEED = 2, 10_000, 1000, 7
LEAST_WORDS, PERCENT = 20, 25
PIECE = 6 << 20
#: What separates words: ASCII but letters and digits.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
POLYNOMIAL = 0xEDB88320
_TABLES: dict = {}


# ---------------------------------------------------------------- crc32 of runs of words
def _shifted(table: np.ndarray, states: np.ndarray) -> np.ndarray:
    out = np.zeros(len(states), np.uint32)
    for k in range(4):
        out ^= table[k][(states >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def shift_table(n: int) -> np.ndarray:
    """For each of a crc32's four bytes, what that byte becomes behind n more zero bytes; the crc of a run is then
    shift(crc of its beginning, length of its end) ^ crc of its end."""
    if n not in _TABLES:
        if n == 0:
            rows = np.arange(256, dtype=np.uint32)
            _TABLES[n] = np.stack([rows << np.uint32(8 * k) for k in range(4)])
        elif n & (n - 1) == 0 and n > 1:  # by doubling
            half = shift_table(n // 2)
            _TABLES[n] = np.stack([_shifted(half, row) for row in half])
        elif n > 1:
            low = n & -n
            one = shift_table(low)
            _TABLES[n] = np.stack([_shifted(one, row) for row in shift_table(n - low)])
        else:
            byte = np.arange(256, dtype=np.uint32)
            for _ in range(8):
                byte = (byte >> np.uint32(1)) ^ np.where(byte & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0)).astype(np.uint32)
            states = shift_table(0)
            _TABLES[n] = np.stack([(row >> np.uint32(8)) ^ byte[row & np.uint32(255)] for row in states])
    return _TABLES[n]


def carried_on(states: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """crc32 of each beginning (its crc in states) followed by an end of that crc and length."""
    out = np.empty(len(states), np.uint32)
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        out[at] = _shifted(shift_table(n), states[at])
    return out ^ ends


# ---------------------------------------------------------------- tries
class Trie:
    """The runs of 1 to ``order`` words of a piece's texts: by level, the nodes and the node of each word's place."""

    def __init__(self, texts: pa.Array, order: int = ORDER):
        lists = pc.split_pattern_regex(pc.ascii_lower(texts.fill_null("")), BETWEEN)
        words, n = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        full = np.asarray(pc.greater(pc.binary_length(words), 0))  # what is before the first separator or behind the last may be empty
        of = np.repeat(np.arange(len(n), dtype=np.int64), n)[full]
        coded = words.dictionary_encode()
        known, word = coded.dictionary, coded.indices.to_numpy()[full].astype(np.int64)
        self.n_docs, self.of, self.n_words = len(n), of, np.bincount(of, minlength=len(n))
        crc = np.fromiter((zlib.crc32(w.as_buffer()) for w in known), np.uint32, len(known))
        space = np.fromiter((zlib.crc32(w.as_buffer(), zlib.crc32(b" ")) for w in known), np.uint32, len(known))
        length = pc.binary_length(known).to_numpy(zero_copy_only=False).astype(np.int64)
        #: Per level: state and count of each node; place of each run's first word, and its node.
        self.states, self.counts, self.places, self.nodes = [crc], [np.bincount(word, minlength=len(known))], [np.arange(len(word))], [word]
        for level in range(1, order):
            inside = self.places[-1] + level < len(word)
            first, parent = self.places[-1][inside], self.nodes[-1][inside]
            same = of[first] == of[first + level]
            first, parent = first[same], parent[same]
            node, paths = pd.factorize(parent * max(1, len(known)) + word[first + level])
            above, last = paths // max(1, len(known)), paths % max(1, len(known))
            self.states.append(carried_on(self.states[-1][above], space[last], length[last] + 1))
            self.counts.append(np.bincount(node, minlength=len(paths)))
            self.places.append(first)
            self.nodes.append(node)

    @property
    def n_features(self) -> np.ndarray:
        return sum(np.bincount(self.of[p], minlength=self.n_docs) for p in self.places)

    def bucket_counts(self, buckets: int) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        for states, counts in zip(self.states, self.counts):
            np.add.at(out, states % np.uint32(buckets), counts)
        return out

    def totals(self, gains: np.ndarray) -> np.ndarray:
        """Sum of the gains along the paths of each text."""
        out = np.zeros(self.n_docs, np.int64)
        for states, places, nodes in zip(self.states, self.places, self.nodes):
            attached = gains[states % np.uint32(len(gains))]
            steps = np.concatenate(([0], np.cumsum(attached[nodes])))
            ends = np.searchsorted(self.of[places], np.arange(self.n_docs + 1))
            out += steps[ends[1:]] - steps[ends[:-1]]
        return out


def _pieces(b: pa.RecordBatch, text: int):
    """(from, to) of consecutive rows of about PIECE bytes of text."""
    sizes, lo = np.cumsum(pc.binary_length(b.column(text)).fill_null(0).to_numpy(zero_copy_only=False)), 0
    while lo < b.num_rows:
        hi = min(b.num_rows, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + PIECE)) + 1)
        yield lo, hi
        lo = hi


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """(bucket, n): features of all documents by bucket; buckets without any are left out."""

    def run(batches):
        total = np.zeros(buckets, np.int64)  # of the partition
        for b in batches:
            for lo, hi in _pieces(b, 0):
                total += Trie(b.column(0).slice(lo, hi - lo), order).bucket_counts(buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["bucket", "n"])
        common.trim()

    common.ship(docs.sparkSession)
    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, order: int = ORDER) -> list[int]:
    """By bucket, floor(SCALE * ln(share in target / share in docs)), each share smoothed by one feature a bucket."""
    rows = bucket_counts(docs, buckets, order).withColumn("here", F.lit(True)).unionByName(bucket_counts(target, buckets, order).withColumn("here", F.lit(False)))
    s, t = [0] * buckets, [0] * buckets
    for r in rows.collect():  # a row a bucket and table
        (s if r.here else t)[r.bucket] = r.n
    whole, aim = float(sum(s) + buckets), float(sum(t) + buckets)
    return [math.floor(SCALE * math.log((b + 1.0) * whole / ((a + 1.0) * aim))) for a, b in zip(s, t)]


def weights(docs: DataFrame, by_bucket: list[int], order: int = ORDER) -> DataFrame:
    """(doc_id, n_words, n_features, weight)"""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(np.array(by_bucket, np.int64))  # a number a bucket

    def run(batches):
        for b in batches:
            for lo, hi in _pieces(b, 1):
                trie = Trie(b.column(1).slice(lo, hi - lo), order)
                n = trie.n_features
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).slice(lo, hi - lo),
                        pa.array(trie.n_words.astype(np.int64)),
                        pa.array(n.astype(np.int64)),
                        pa.array(np.where(n > 0, trie.totals(held.value) // np.maximum(n, 1), 0)),
                    ],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )
        common.trim()

    common.ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


# ---------------------------------------------------------------- the draw
def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(SCALE * a Gumbel number) from the hash of the seed and the doc_id."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(hashed, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-float(SCALE)) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))


def draw(scored: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): rank 1, 2, .. of the drawn documents, null of all others."""
    spark = scored.sparkSession
    first = [F.desc("score"), F.asc_nulls_last("doc_id")]
    enough = scored.where(F.col("n_words") >= least_words)
    rows = enough.repartitionByRange(common.partitions(spark), *first).sortWithinPartitions(*first)
    # an id's upper bits are the partition, its lower ones the place in it
    rows = common.cut(rows.withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).orderBy("_part").collect()  # a row a partition
    before, total = [], 0
    for r in sizes:
        before.append((r._part, total))
        total += r.n
    base = F.broadcast(spark.createDataFrame(before or [(-1, 0)], "_part long, _before long"))
    ranked = rows.withColumn("_part", part).join(base, "_part").withColumn("rank", F.col("_before") + place + 1)
    drawn = F.when(F.col("rank") <= percent * total // 100, F.col("rank"))
    few_words = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    names = ("doc_id", "n_features", "weight", "score")
    return ranked.select(*names, drawn.alias("rank")).unionByName(few_words.select(*names, "rank"))


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, order: int = ORDER, seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """Every document with its weight towards target and its score; those drawn have a rank."""
    scored = weights(docs, gains(docs, target, buckets, order), order)
    scored = common.cut(scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    return draw(scored, least_words, percent)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(common.table(spark, sf_dir, "documents").select("doc_id", "text"), common.table(spark, sf_dir, "benchmark").select("text"))


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_STEP = f"CASE WHEN c % 2 = 1 THEN xor(c // 2, {POLYNOMIAL}) ELSE c // 2 END"
QUERIES = {"op13_importance_resampling": op13_importance_resampling}
ORACLES = {
    "op13_importance_resampling": f"""
WITH RECURSIVE
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT {_WORDS} AS w FROM benchmark),
fd AS MATERIALIZED (SELECT r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d),
fb AS MATERIALIZED (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM b),
z AS (SELECT i, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) AS t(i) UNION ALL SELECT i, {_STEP}, k + 1 FROM z WHERE k < 8),
y AS (SELECT list(c ORDER BY i) AS t FROM z WHERE k = 8),
u AS (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM fd UNION SELECT f FROM fb) AS a),
h AS MATERIALIZED (
  SELECT f, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(x), 2), lambda i: CAST('0x' || substr(x, CAST(i AS INTEGER), 2) AS BIGINT))),
    lambda c, v: xor(c // 256, t[xor(c % 256, v) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM u, y),
s AS (SELECT bucket, count(*) AS s FROM fd JOIN h ON fd.f = h.f GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM fb JOIN h ON fb.f = h.f GROUP BY bucket),
n AS (SELECT (SELECT count(*) FROM fd) AS s, (SELECT count(*) FROM fb) AS t),
g AS (SELECT h.f, CAST(floor({SCALE} * ln(CAST(coalesce(t.t, 0) + 1 AS DOUBLE) * (n.s + {BUCKETS}) / (CAST(coalesce(s.s, 0) + 1 AS DOUBLE) * (n.t + {BUCKETS})))) AS BIGINT) AS gain
  FROM h LEFT JOIN s ON h.bucket = s.bucket LEFT JOIN t ON h.bucket = t.bucket, n),
w AS (SELECT r, count(*) AS n_features, CAST(floor(sum(gain) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS weight FROM fd JOIN g ON fd.f = g.f GROUP BY r),
x AS (SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  CAST('0x' || substr(sha256('{SEED}:' || d.doc_id), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN w ON d.r = w.r),
o AS (SELECT *, weight + CAST(floor(-{SCALE} * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM x),
k AS (SELECT *, row_number() OVER (PARTITION BY n_words >= {LEAST_WORDS} ORDER BY score DESC, doc_id) AS k, count_if(n_words >= {LEAST_WORDS}) OVER () AS n FROM o)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CAST(CASE WHEN n_words >= {LEAST_WORDS} AND k <= {PERCENT} * n // 100 THEN k END AS BIGINT) AS rank FROM k
""",
}
