"""Packing token sequences by lexical retrieval.

Every document is encoded once.  Document frequencies of token ids come from all documents (at most one row for
each id of the vocabulary, so they fit anywhere).  The BM25 inverted index is sharded, and documents that are lexically close
are dealt to the same shard: lexical clusters (spherical k-means over BM25 weights, fitted on about ``SAMPLE`` documents, as
many clusters as partitions up to ``CLUSTERS``) take every document to the nearest centre; a cluster that holds more than a
partition's even share of some ``MEASURED`` other documents is split by its documents' strongest BM25 term, and a term with more documents than a partition's share
is salted, so no cluster and no term can fill a task.  Each partition is cut into shards of about ``SHARD_TOKENS`` ids.  In a
shard a seed document retrieves the unused ones in order of score, every document that shares a term among them, and they fill its
window greedily; the document that does not fit is cut, and its rest seeds the next window.  A shard's last window is carried to
the partition's next shard; the partition's last one is cut into sequences whose lengths are powers of two, which need no
padding, so nothing is padded at all.

Every row is packed, whole: null texts read as empty (the end id alone), null doc_ids stay null, repeated rows
are packed as often as they occur; an empty table gives an empty result.  Other columns, of any names, are ignored.
"""

from __future__ import annotations

import math
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens
from .tokens import runs

WINDOW, SHARD_TOKENS, END_ID = 4096, 1 << 20, 2
K1, B = 1.2, 0.75
VOCABULARY = 1 << 16
#: Lexical clusters: documents sampled to fit them and, others, to measure their sizes; most clusters; turns of fitting.
SAMPLE, MEASURED, CLUSTERS, TURNS = 2048, 8192, 256, 8


#: Bytes of text that a task encodes at once: its memory grows with them, its time falls a little.
ENCODE_BYTES = 8_000_000


def _encode(path: str, end_id: int, most_bytes: int = ENCODE_BYTES):
    def run(batches):
        enc = tokens.encoder(path)
        for b in batches:
            for lo, hi in tokens.batches(b.column(1), most_bytes):
                ids, n = enc.encode_array(b.column(1).slice(lo, hi - lo), end_id)
                ends = np.concatenate(([0], np.cumsum(n) * 2)).astype(np.int32)
                rows = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(ids))])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), rows, pa.array(n, pa.int64())], names=["doc_id", "ids", "n"])
        common.trim()

    return run


def postings(ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, frequency), by document and term."""
    wide = np.uint32 if len(n) <= 1 << 16 else np.uint64
    codes = np.sort((np.repeat(np.arange(len(n), dtype=wide), n) << wide(16)) | ids)
    edge = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) if len(codes) else np.zeros(0, np.int64)
    tf = np.diff(np.append(edge, len(codes)))
    return (codes[edge] >> wide(16)).astype(np.int64), (codes[edge] & wide(0xFFFF)).astype(np.int64), tf


def _frequencies(batches):
    df = np.zeros(VOCABULARY, np.int64)
    for b in batches:
        n = np.asarray(b.column(1))
        ids = np.frombuffer(b"".join(b.column(0).to_pylist()), "<u2")
        df += np.bincount(postings(ids, n)[1], minlength=VOCABULARY)
    terms = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(df[terms])], names=["term", "df"])


class Bm25:
    """Corpus-wide statistics; weight(tf, term, length) is a term's BM25 contribution (0 where idf is not positive)."""

    def __init__(self, documents: int, total: int, df: dict[int, int]):
        self.average = max(1.0, total / max(1, documents))
        f = np.zeros(VOCABULARY)
        f[list(df)] = list(df.values())
        self.idf = np.maximum(0.0, np.log((documents - f + 0.5) / (f + 0.5))).astype(np.float32)

    def weight(self, tf, term, length):
        return self.idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / self.average))


def _vectors(bm25: Bm25, raw: list[bytes], n: np.ndarray):
    """(document, term, weight) of the weighing terms, by document."""
    doc, term, tf = postings(np.frombuffer(b"".join(raw), "<u2"), n)
    w = bm25.weight(tf, term, n[doc])
    use = w > 0
    return doc[use], term[use], w[use].astype(np.float32)


def _sampled(bm25: Bm25):
    def run(batches):
        for b in batches:
            n = np.asarray(b.column(1))
            doc, term, w = _vectors(bm25, b.column(0).to_pylist(), n)
            at = np.searchsorted(doc, np.arange(len(n) + 1)).tolist()
            terms = [term[x:y].astype("<u2").tobytes() for x, y in zip(at, at[1:])]
            weights = [w[x:y].astype("<f4").tobytes() for x, y in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.binary()), pa.array(weights, pa.binary())], names=["terms", "weights"])

    return run


class Centres(NamedTuple):
    """A row of ``table`` (terms, clusters) for each term that some centre has; row 0 is for all others."""

    row: np.ndarray
    table: np.ndarray


def _nearest(centres: Centres, doc: np.ndarray, term: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    """The centre of the greatest inner product for each of n documents; 0 for one without a term."""
    out, rows = np.zeros(n, np.int64), centres.row[term]
    edge = np.searchsorted(doc, np.arange(n + 1))
    # runs of documents of a bounded number of terms
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(edge, edge[a] + 20_000, "right")) - 1)
        full = np.flatnonzero(np.diff(edge[a : b + 1])) + a
        if len(full):
            x, y = int(edge[a]), int(edge[b])
            out[full] = np.add.reduceat(centres.table[rows[x:y]] * w[x:y, None], edge[full] - x, axis=0).argmax(1)
        a = b
    return out


def _joined(sample: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, weight) of a sample of (terms, weights)."""
    doc = np.repeat(np.arange(len(sample)), [len(t) for t, _ in sample])
    return doc, np.concatenate([t for t, _ in sample]).astype(np.int64), np.concatenate([w for _, w in sample]).astype(np.float32)


def clusters(sample: list, k: int, measured: list | None = None) -> tuple[Centres, np.ndarray]:
    """(centres, documents of ``measured`` in each) of at most k clusters fitted to sample; both hold (terms, weights)."""
    measured = [x for x in measured or sample if len(x[0])]
    sample = [(np.asarray(t, np.int64), np.asarray(w, np.float32) / max(1e-9, float(np.linalg.norm(w)))) for t, w in sample if len(t)]
    k = max(1, min(k, len(sample) // 4))
    row = np.zeros(VOCABULARY, np.int32)
    if not sample:
        return Centres(row, np.zeros((1, 1), np.float32)), np.ones(1, np.int64)
    doc, term, w = _joined(sample)
    used = np.unique(term)
    row[used] = np.arange(1, len(used) + 1)
    centres = Centres(row, np.zeros((len(used) + 1, k), np.float32))
    for turn in range(TURNS):
        if turn:
            of = _nearest(centres, doc, term, w, len(sample))
        else:  # the first centres are single documents
            of = np.full(len(sample), -1)
            of[np.random.default_rng(1).choice(len(sample), k, replace=False)] = np.arange(k)
        fresh, use = np.zeros_like(centres.table), of[doc] >= 0
        np.add.at(fresh, (row[term[use]], of[doc[use]]), w[use])
        size = np.linalg.norm(fresh, axis=0)
        fresh /= np.maximum(size, 1e-9)
        centres = Centres(row, np.where(size > 0, fresh, centres.table))
    # centres that no document of the sample is nearest to are copies of others: a tie would be broken by rounding
    kept = np.unique(_nearest(centres, doc, term, w, len(sample)))
    centres, k = Centres(row, np.ascontiguousarray(centres.table[:, kept])), len(kept)
    if not measured:
        return centres, np.ones(k, np.int64)
    return centres, np.bincount(_nearest(centres, *_joined(measured), len(measured)), minlength=k)


def _strongest(doc: np.ndarray, term: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    """The term of greatest weight of each of n documents, the least of equal ones; 0 for one without a term."""
    top = np.zeros(n, np.int64)
    if len(doc):
        size = np.bincount(doc, minlength=n)
        full = np.flatnonzero(size)
        most = np.maximum.reduceat(w, (np.cumsum(size) - size)[full])
        at = np.flatnonzero(w == np.repeat(most, size[full]))
        lead = at[np.concatenate(([True], doc[at][1:] != doc[at][:-1]))]
        top[doc[lead]] = term[lead]
    return top


def _routed(bm25: Bm25, centres: Centres, first: np.ndarray, share: np.ndarray, salts: np.ndarray):
    """Adds part: the first of a cluster's ``share`` parts, moved by the strongest term and its salt."""

    def run(batches):
        from pyspark import TaskContext

        # a row's place in a checkpointed partition spreads a hot term, so that a retried task deals alike
        place = TaskContext.get().partitionId() * 7919
        for b in batches:
            n = np.asarray(b.column(2))
            if not len(n):
                continue
            doc, term, w = _vectors(bm25, b.column(1).to_pylist(), n)
            of = _nearest(centres, doc, term, w, len(n))
            top = _strongest(doc, term, w, len(n))
            row = place + np.arange(len(n))
            place += len(n)
            part = first[of] + (top * 40_503 + row % salts[top] * 9_973) % share[of]
            # documents without a term that weighs have no neighbours: they fill up all parts
            bare = np.bincount(doc, minlength=len(n)) == 0
            part[bare] = row[bare] % int(share.sum())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(part.astype(np.int32)), pa.array(top.astype(np.int32))],
                names=["doc_id", "ids", "n", "part", "term"],
            )
        common.trim()

    return run


class Shard:
    """BM25 inverted index over a shard's documents, and its greedy windows."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, bm25: Bm25):
        self.n = n
        doc, term, tf = postings(ids, n)
        w = bm25.weight(tf, term, n[doc])
        use = w > 0
        doc, term, w = doc[use], term[use], w[use]
        self.own_terms, self.own_from = term, np.searchsorted(doc, np.arange(len(n) + 1))
        by_term = np.argsort(term.astype(np.uint16), kind="stable")
        self.docs, self.weights = doc[by_term], w[by_term]
        self.term_from = np.searchsorted(term[by_term], np.arange(VOCABULARY + 1))

    def neighbours(self, seed: int) -> np.ndarray:
        """Documents that share a term with seed, best score first, ties by position."""
        t = self.own_terms[self.own_from[seed] : self.own_from[seed + 1]]
        at = runs(self.term_from[t], self.term_from[t + 1] - self.term_from[t]).astype(np.intp)  # else each use below would make it so
        score = np.bincount(self.docs[at], self.weights[at], minlength=len(self.n))
        found = np.flatnonzero(score > 0)
        return found[np.argsort(-score[found], kind="stable")]

    def windows(self, window: int, carried: int = 0):
        """Lists of (document, start, length), each filling window ids but for the last; ``carried`` ids of the first are taken."""
        n, used, cursor = self.n.tolist(), np.zeros(len(self.n), bool), 0
        whole, window, pieces = window, window - carried, []
        seed, start = None, 0
        while True:
            if seed is None:
                while cursor < len(n) and used[cursor]:
                    cursor += 1
                if cursor == len(n):
                    break
                seed, start = cursor, 0
                used[seed] = True
            rest = n[seed] - start
            if not pieces and rest >= window:
                yield [(seed, start, window)]
                start, window = start + window, whole
                if start == n[seed]:
                    seed = None
                continue
            # seed opens the window; its neighbours, then the next unused documents fill it
            pieces, room = [(seed, start, rest)], window - rest
            cut = None
            ranked = iter(self.neighbours(seed).tolist())
            while room:
                d = next((x for x in ranked if not used[x]), None)
                if d is None:
                    while cursor < len(n) and used[cursor]:
                        cursor += 1
                    if cursor == len(n):
                        break
                    d = cursor
                used[d] = True
                take = min(room, n[d])
                pieces.append((d, 0, take))
                room -= take
                if take < n[d]:
                    cut = (d, take)
            if room:
                break
            yield pieces
            pieces, window = [], whole
            seed, start = cut if cut else (None, 0)
        if pieces:
            yield pieces


def powers(pieces: list) -> list[list]:
    """Pieces (.., start, ids) cut into sequences whose lengths are the powers of two of their sum, longest first."""
    total, queue, out = sum(len(p[-1]) for p in pieces), list(reversed(pieces)), []
    for size in (1 << k for k in range(total.bit_length() - 1, -1, -1) if total >> k & 1):
        sequence, room = [], size
        while room:
            *who, start, ids = queue.pop()
            take = min(len(ids), room)
            sequence.append((*who, start, ids[:take]))
            room -= take
            if take < len(ids):
                queue.append((*who, start + take, ids[take:]))
        out.append(sequence)
    return out


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pack(bm25: Bm25, window: int, shard_tokens: int):
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches):
        from pyspark import TaskContext

        sequence = TaskContext.get().partitionId() << 40
        held: list[bytes] = []
        doc_ids: list = []
        carried: list = []  # (doc_id, tokens, start, ids) of a window that the next shard goes on filling
        size = 0

        def rows(sequences):
            nonlocal sequence
            out = []
            for pieces in sequences:
                offset = 0
                for doc_id, n, start, ids in pieces:
                    out.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n, sequence, offset))
                    offset += len(ids)
                sequence += 1
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names) if out else None

        def flush():
            nonlocal size, carried
            ids = np.frombuffer(b"".join(held), "<u2")
            n = np.array([len(x) // 2 for x in held], np.int64)
            base, full = np.cumsum(n) - n, []
            for pieces in Shard(ids, n, bm25).windows(window, sum(len(p[-1]) for p in carried)):
                carried = carried + [(doc_ids[d], int(n[d]), s, ids[base[d] + s : base[d] + s + m]) for d, s, m in pieces]
                if sum(len(p[-1]) for p in carried) == window:
                    full.append(carried)
                    carried = []
            carried = [(*who, x.copy()) for *who, x in carried]
            held.clear()
            doc_ids.clear()
            size = 0
            return rows(full)

        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.append(ids)
                doc_ids.append(doc_id)
                size += len(ids) // 2
                if size >= shard_tokens:
                    if (got := flush()) is not None:
                        yield got
        if held and (got := flush()) is not None:
            yield got
        if carried:
            yield rows(powers(carried))
        common.trim()

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    end_id: int = END_ID,
    window: int = WINDOW,
    shard_tokens: int = SHARD_TOKENS,
    encode_bytes: int = ENCODE_BYTES,
) -> DataFrame:
    """Pieces of all documents in sequences of at most window ids (a power of two)."""
    spark = docs.sparkSession
    common.ship(spark)
    texts = common.with_defaults(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    coded = common.cut(texts.mapInArrow(_encode(tokenizer_path or tokens.vocabulary_path(), end_id, encode_bytes), "doc_id long, ids binary, n long"))
    all_of = coded.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    df = coded.select("ids", "n").mapInArrow(_frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = {r.term: r.df for r in df.collect()}  # at most one row a vocabulary id
    bm25, parts = Bm25(all_of.documents, all_of.total, df), common.partitions(spark)
    each = max(1.0, all_of.documents / parts)
    salts = np.ones(VOCABULARY, np.int64)
    for term, n in df.items():
        salts[term] = max(1, math.ceil(n / each))
    # rows by hash: about SAMPLE to fit and MEASURED to measure, at most twice as many together
    wanted = min(1.0, (SAMPLE + MEASURED) / max(1, all_of.documents))
    draw = F.pmod(F.xxhash64("doc_id", "n"), F.lit(1 << 30)) < F.lit(int(wanted * (1 << 30)))
    sample = coded.where(draw).select("ids", "n").limit(2 * (SAMPLE + MEASURED)).mapInArrow(_sampled(bm25), "terms binary, weights binary").toPandas()
    sample = [(np.frombuffer(t, "<u2"), np.frombuffer(w, "<f4")) for t, w in zip(sample["terms"], sample["weights"])]
    step = max(1, len(sample) // SAMPLE)
    centres, size = clusters(sample[::step], min(parts, CLUSTERS), [x for i, x in enumerate(sample) if i % step] if step > 1 else None)
    share = np.maximum(1, np.ceil(size / max(1, size.sum()) * parts)).astype(np.int64)
    first, total = np.cumsum(share) - share, int(share.sum())
    routed = coded.mapInArrow(_routed(bm25, centres, first, share, salts), "doc_id long, ids binary, n long, part int, term int")
    dealt = routed.repartitionById(total, F.col("part")).sortWithinPartitions("part", "term", "doc_id", "n", "ids").select("doc_id", "ids")
    return dealt.mapInArrow(_pack(bm25, window, shard_tokens), SCHEMA)


def op6_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"))


QUERIES = {"op6_retrieval_packing": op6_retrieval_packing}
ORACLES: dict[str, str] = {}
