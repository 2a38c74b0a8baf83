"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark, repeated windows merged into spans.

A window is ``WINDOW`` consecutive words of one document.  A window is repeated if its words also start earlier: in a document of
smaller doc_id, or earlier in the same.  Overlapping repeated windows add up to maximal spans of words, and these are removed.

1. ``ordered_blocks``: documents are range-partitioned by doc_id and cut into blocks of about ``BLOCK_BYTES`` of text, numbered in
   the order of doc_id.  The blocks are written once, bucketed by block, so that no later step moves a text.
2. ``windows``: a block's window hashes are differences of prefix sums of word hash times power, modulo 2 ** 64.  Two hash functions
   are used: bits of the second choose the bucket, 56 bits of the first name the window in it.  A block sends every bucket
   its distinct names, sorted, as byte planes of their differences (five to six bytes a window, no positions).
3. ``seen_before``: a bucket counts its names over all blocks.  As blocks are in order, a name is repeated in every block but its first;
   the bucket answers each block with one bit a name.
4. ``spans``: a block meets its answers, hashes its windows again, and a window goes if its bit is set or the block itself has had it.

Buckets and blocks grow in number with the input, not in size: a bucket holds the names of about ``BUCKET_BYTES`` of text, however often
a window occurs in a block.  Two different windows are taken for equal with a probability of about 2 ** -56 for each of a
bucket's few million names, at any size of the corpus.

Null texts have no words.  A null doc_id comes before all others.  Rows of equal doc_id follow each other by a hash of their text;
of equal rows the first counts as the earlier.  Texts of fewer words than a window lose nothing.  An empty table gives an
empty result.  Columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, ordered

WINDOW = 20
BLOCK_BYTES, BUCKET_BYTES, LEAST_BUCKETS = 8 << 20, 16 << 20, 64
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so that they have inverses modulo 2 ** 64
NAME_BITS = 56
_POWERS: dict = {}


def _powers(k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base's inverse, and of the base."""
    had = _POWERS.get(k)
    if had is None or len(had[0]) < n:
        made = []
        for base in (pow(BASES[k], -1, 1 << 64), BASES[k]):
            row = np.full(max(n, 1 << 20), base, np.uint64)
            row[0] = 1
            made.append(np.cumprod(row, dtype=np.uint64))
        _POWERS[k] = had = tuple(made)
    return had[0][:n], had[1][:n]


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts, words per text): what ASCII white space separates."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts.fill_null("")))
    words, n = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    full = np.asarray(pc.greater(pc.binary_length(words), 0))
    if not full.all():  # a blank text is split into one empty word
        of = np.repeat(np.arange(len(n)), n)
        words, n = words.filter(pa.array(full)), np.bincount(of[full], minlength=len(n))
    return words, n


class Windows:
    """The windows of a block's texts: first word, bucket and name of each, in order."""

    def __init__(self, texts: pa.Array, size: int, buckets: int):
        self.words, self.n_words = words_of(texts)
        n = len(self.words)
        ends = np.cumsum(self.n_words)
        # the words at which a window begins: all but the last of each text
        short = np.minimum(self.n_words, size - 1)
        barred = np.repeat(ends - short, short) + np.arange(int(short.sum())) - np.repeat(np.cumsum(short) - short, short)
        begins = np.ones(n, bool)
        begins[barred] = False
        self.first = np.flatnonzero(begins)
        coded = self.words.dictionary_encode()
        raw = b"".join(xxhash.xxh3_128_digest(w.as_buffer()) for w in coded.dictionary)
        pairs, at = np.frombuffer(raw, "<u8").reshape(-1, 2), coded.indices.to_numpy()
        made = []
        for k in range(2):
            down, up = _powers(k, n + 1)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(pairs[:, k][at] * down[:n], out=sums[1:])
            made.append((sums[self.first + size] - sums[self.first]) * up[self.first])
        self.name = made[0] >> np.uint64(64 - NAME_BITS)
        bits = buckets.bit_length() - 1
        self.bucket = (made[1] >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32) if bits else np.zeros(len(self.first), np.uint16)

    def by_bucket(self):
        """(bucket, numbers of its windows, ascending)."""
        order = np.argsort(self.bucket, kind="stable")
        held = self.bucket[order]
        cuts = np.flatnonzero(np.diff(held)) + 1
        for rows in np.split(order, cuts) if len(order) else []:
            yield int(self.bucket[rows[0]]), rows


def packed(names: np.ndarray) -> bytes:
    """Ascending numbers as compressed byte planes of their differences."""
    steps = np.diff(names, prepend=np.uint64(0)).astype("<u8")
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").reshape(-1), dtype=np.uint64)


# ---------------------------------------------------------------- 1
def _numbered(block_bytes: int):
    """Block numbers for the sorted rows of a partition."""

    def run(batches):
        from pyspark import TaskContext

        block, held, seen = TaskContext.get().partitionId() << 32, 0, 0
        for b in batches:
            numbers = np.zeros(b.num_rows, np.int64)
            for i, n in enumerate(pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False).tolist()):
                if held and held + n > block_bytes:
                    block, held = block + 1, 0
                held += n + 16
                numbers[i] = block
            places = pa.array(np.arange(seen, seen + b.num_rows))
            seen += b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(numbers), places, *b.columns], names=["block", "at", "doc_id", "text"])

    return run


def ordered_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, at, doc_id, text) as a table bucketed by block; blocks ascend with doc_id, and inside one (doc_id, text's hash) do."""
    spark = docs.sparkSession
    common.ship(spark)
    n = common.partitions(spark)
    rows = common.with_defaults(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    rows = rows.withColumns({"key": F.coalesce("doc_id", F.lit(ordered.LOWEST)), "tag": F.xxhash64("text")})
    rows = rows.repartitionByRange(n, "key", "tag").sortWithinPartitions("key", "tag").select("doc_id", "text")
    rows = rows.mapInArrow(_numbered(block_bytes), "block long, at long, doc_id long, text string")
    path, name = common.new_path(spark, "blocks"), f"ledgerleaf_blocks_{uuid.uuid4().hex}"
    common.remove_later(spark, path)
    rows.write.bucketBy(n, "block").option("path", path).option("compression", "zstd").saveAsTable(name)

    def end() -> None:
        with contextlib.suppress(Exception):  # the session may have ended before
            spark.sql(f"DROP TABLE IF EXISTS {name}")

    atexit.register(end)
    return spark.table(name)


# ---------------------------------------------------------------- 2 and 3
def _sent(size: int, buckets: int):
    def run(batches):
        held, block = [], None

        def flush():
            w = Windows(pa.chunked_array(held).combine_chunks(), size, buckets)
            rows = [(b, block, packed(np.unique(w.name[at]))) for b, at in w.by_bucket()]
            cols = list(zip(*rows)) or [(), (), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())],
                names=["bucket", "block", "names"],
            )

        for b in batches:
            numbers = b.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if held and numbers[lo] != block:
                    yield flush()
                    held = []
                block = int(numbers[lo])
                held.append(b.column(1).slice(lo, hi - lo))
        if held:
            yield flush()
        common.trim()

    return run


def windows(blocks: DataFrame, size: int, buckets: int) -> DataFrame:
    """(bucket, block, names): the distinct names of a block's windows in each bucket, ascending and packed."""
    # a task has whole blocks, in the order of their numbers
    return blocks.sortWithinPartitions("block").select("block", "text").mapInArrow(_sent(size, buckets), "bucket int, block long, names binary")


def _answers(table: pa.Table) -> pa.Table:
    """Of each block that sent names, the bits of those that an earlier block has sent too."""
    blocks = table.column("block").to_numpy()
    names = [unpacked(x) for x in table.column("names").to_pylist()]
    order = np.argsort(blocks)
    every = np.concatenate([names[i] for i in order])
    by_name = np.argsort(every, kind="stable")
    sorted_names = every[by_name]
    again = np.zeros(len(every), bool)
    again[by_name[1:]] = sorted_names[1:] == sorted_names[:-1]
    bits, at = [], 0
    for i in order:
        n = len(names[i])
        bits.append(np.packbits(again[at : at + n]).tobytes() if again[at : at + n].any() else None)
        at += n
    out = pa.table({"block": pa.array(blocks[order]), "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())})
    return out.filter(pc.is_valid(out.column("bits")))


def seen_before(names: DataFrame) -> DataFrame:
    """(block, bucket, bits): a bit for each name of the block in that bucket, set if an earlier block has it."""
    return names.groupBy("bucket").applyInArrow(_answers, "block long, bucket int, bits binary")


# ---------------------------------------------------------------- 4
SPANS = "doc_id long, text string, n_words long, n_removed long, spans array<struct<first:int,last:int>>"


def _cut(size: int, buckets: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        docs = docs.sort_by("at")
        texts = docs.column("text").combine_chunks()
        w = Windows(texts, size, buckets)
        bits = dict(zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist()))
        gone = np.zeros(len(w.first), bool)
        for bucket, at in w.by_bucket():
            names, first, of = np.unique(w.name[at], return_index=True, return_inverse=True)
            again = np.arange(len(at)) != first[of]
            if bucket in bits:
                again |= np.unpackbits(np.frombuffer(bits[bucket], np.uint8), count=len(names)).astype(bool)[of]
            gone[at] = again
        n, starts = len(w.words), w.first[gone]
        edges = np.zeros(n + 1, np.int32)
        edges[starts] += 1
        np.add.at(edges, starts + size, -1)
        removed = np.cumsum(edges[:n]) > 0
        ends = np.cumsum(w.n_words)
        begins = ends - w.n_words
        kept = w.words.filter(pa.array(~removed))
        upto = np.concatenate(([0], np.cumsum(~removed)))
        at = np.concatenate((upto[begins], upto[-1:]))
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array(at, pa.int32()), kept), " ")
        # maximal spans, told apart at the edges of documents
        edge = np.zeros(n + 1, bool)
        edge[begins] = True
        opens = np.flatnonzero(removed & (edge[:n] | ~np.concatenate(([False], removed[:-1])))) if n else np.zeros(0, np.int64)
        closes = np.flatnonzero(removed & (edge[1:] | ~np.concatenate((removed[1:], [False])))) if n else np.zeros(0, np.int64)
        of = np.searchsorted(ends, opens, side="right")
        cut = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(ends)))))
        pairs = pa.StructArray.from_arrays([pa.array(opens - begins[of], pa.int32()), pa.array(closes - begins[of], pa.int32())], names=["first", "last"])
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "text": text,
                "n_words": pa.array(w.n_words, pa.int64()),
                "n_removed": pa.array(w.n_words - np.diff(at), pa.int64()),
                "spans": pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pairs),
            }
        )

    return run


def spans(blocks: DataFrame, answers: DataFrame, size: int, buckets: int) -> DataFrame:
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_cut(size, buckets), SPANS)


def dedup(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, text, n_words, n_removed, spans): the kept words joined by one space, and the removed spans [first, last] of words."""
    volume = docs.agg(F.sum(F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, 1 << max(0, (volume // BUCKET_BYTES).bit_length()))
    blocks = ordered_blocks(docs)
    return spans(blocks, seen_before(windows(blocks, size, buckets)), size, buckets)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {"op11_substring_dedup": op11_substring_dedup}
ORACLES = {
    "op11_substring_dedup": f"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW} + 2)) AS i FROM d WHERE len(w) >= {WINDOW}),
k AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ') ORDER BY doc_id, i) AS r FROM s),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM k WHERE r > 1),
x AS (SELECT doc_id, p, word FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) AS u),
t AS (SELECT x.doc_id, count(g.p) AS n_removed, string_agg(CASE WHEN g.p IS NULL THEN x.word END, ' ' ORDER BY x.p) AS kept
  FROM x LEFT JOIN g ON x.doc_id = g.doc_id AND x.p = g.p GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(t.n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(t.kept, '')) AS kept_sha256
FROM d LEFT JOIN t ON d.doc_id = t.doc_id
""",
}
