"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints: A-Z lower-cased, words split at ASCII white space, shingles as XXH64 (seed 42), a bit set where more
than half of the hashes have it.  ``near_duplicates`` takes 3-word shingles with repeats and links distinct
fingerprints at ``RADIUS`` or fewer bits.

Search: a fingerprint goes to one cell for each of a list of masks, that of its masked bits.  Of five blocks of bits
two fingerprints within 2 bits agree on three at least, so ten masks of three blocks (38 or 39 bits) bring every
such pair together in a small cell.  A cell's fingerprints are sorted by Gray rank and a binary hierarchy of contiguous runs
is built; every node keeps the mask and pattern of the bits that its members share.  Pairs of nodes are pruned by
the bits in which their patterns surely differ, and a pair whose members are already connected is skipped.  A cell beyond
``CELL_LIMIT`` members is cut into Gray-ordered runs, the same index one level up: each run is a cell, and so is each
pair of runs whose shared patterns do not differ too much.  Components come from alternating large-star and small-star
rounds over the spanning links, each round checkpointed.

``similar`` links documents at a Jaccard similarity of ``SIMILAR`` of their 5-word shingles.  No radius of 5-word
fingerprints holds that similarity (pairs at 0.8 differ in about 10 of 64 bits), but such documents share nearly all
their words: the fingerprint of the distinct words differs in about 3 bits, and unrelated texts begin at 12.  Candidates
are the pairs of the same index within ``WORD_RADIUS`` bits of that fingerprint, in the cells of ``WORD_MASKS``
masks of ``WORD_BITS`` bits; each is bounded by a signature of its shingles and then decided by the whole sets.  Pairs near 0.8 differ
in up to 10 bits, more in short texts, where one word weighs much, and meet in few of those cells.  So every text also goes to the cells of
``BANDS`` bands of ``BAND_ROWS`` least hashes of its shingles each: two sets at 0.8 agree on a band with probability 0.8 ** BAND_ROWS, and
on one at least of 12 bands of 4 with 0.998, whatever their length.  Such cells are not pruned by fingerprint bits.  tests/llm measures recall by class of length; no
pair that is found is left undecided.  The numbers of bits and bands are fixed, so recall does not depend on the number of
documents N; unrelated ones that share a cell are about WORD_MASKS * N * N / 2 ** (WORD_BITS + 1) comparisons of
two 64-bit words, which the index prunes and no row is written for.

Null texts read as empty; texts without words have fingerprint 0 and link like any other.  Rows with a null doc_id get a
fingerprint and a null component; they stay in ``keep_one``.  Repeated rows share fingerprint and component, and
``keep_one`` keeps one of them.  Columns beside doc_id and text, of any names, are ignored by ``fingerprints`` and kept
by ``keep_one``.  Empty tables give empty results.
"""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

RADIUS, SEED, SHINGLE = 2, 42, 3
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
CELL_LIMIT, LEAF = 8192, 16
#: A cell beyond the limit is cut at quantiles of Gray rank; this many are asked of it at most.
QUANTILES = 4096
SIMILAR, SIMILAR_SHINGLE = (4, 5), 5
WORD_RADIUS, WORD_BITS, WORD_MASKS = 10, 24, 40
#: Bands of least hashes (sets of fewer than 4 shingles have none: they are similar only if they are equal).
BANDS, BAND_ROWS = 12, 4
#: Bits of a signature of shingles (4 for each shingle, within these bounds).
SIGNATURE = (64, 1024)
#: Candidates that each member of a cell names in the first round of ``similar``.
NEAREST = 1
#: Links (pairs of numbers) that a task of a round of ``components`` takes, if there are more than two a core.
EDGES = 100_000


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def block_masks(blocks=BLOCKS, radius: int = RADIUS) -> list[int]:
    """Masks of all but ``radius`` blocks: two fingerprints within the radius agree on one of them."""
    bits = [((1 << n) - 1) << lo for lo, n in blocks]
    return [sum(kept) for kept in itertools.combinations(bits, len(bits) - radius)]


def word_masks(n: int = WORD_MASKS, bits: int = WORD_BITS, seed: int = 1) -> list[int]:
    """Masks of ``bits`` bits drawn by seed."""
    draw = random.Random(seed)
    return [sum(1 << b for b in draw.sample(range(64), bits)) for _ in range(n)]


# ---------------------------------------------------------------- fingerprints
def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of the shingles in order; fewer words than ``size`` are one shingle, none are none."""
    from xxhash import xxh64_intdigest

    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    joined, k = b" ".join(words), min(n, size)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts, stops = np.concatenate(([0], ends[: n - k])).tolist(), (ends[k - 1 :] - 1).tolist()
    return np.fromiter([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops)], np.uint64, n - k + 1)


def majority(h: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for a in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[a : a + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def fingerprint(text: str, size: int = SHINGLE) -> int:
    return majority(shingle_hashes(words_of(text), size))


def _fingerprint_batches(batches):
    for b in batches:
        fps = np.array([fingerprint(t or "") for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=["doc_id", "fp"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): one row per row of docs; fp holds the 64 bits as a signed long."""
    common.ship(docs.sparkSession)
    return _texts(docs).mapInArrow(_fingerprint_batches, "doc_id long, fp long")


# ---------------------------------------------------------------- search in one cell
def gray_rank(x: np.ndarray) -> np.ndarray:
    """Rank of a code word in the reflected Gray sequence."""
    r = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def gray_order(fp: Column) -> Column:
    """A long in the order of the (unsigned) Gray rank."""
    r = fp
    for s in (1, 2, 4, 8, 16, 32):
        r = r.bitwiseXOR(F.shiftrightunsigned(r, s))
    return r.bitwiseXOR(F.lit(-(1 << 63)))


class GrayIndex:
    """Nodes over contiguous runs of Gray-sorted fingerprints, with the bits all members of a run share.

    side tells the two runs of a pair apart: members of one side are not compared with each other.
    """

    def __init__(self, fps: np.ndarray, side: np.ndarray | None = None):
        rank = gray_rank(fps)
        self.order = np.argsort(rank, kind="stable") if side is None else np.lexsort((rank, side))
        self.fps = f = fps[self.order]
        self.side = None if side is None else side[self.order]
        starts = np.arange(0, len(f), LEAF)
        self.ones = [np.bitwise_and.reduceat(f, starts)]
        self.zeros = [np.bitwise_and.reduceat(~f, starts)]
        while len(self.ones[-1]) > 1:
            s = np.arange(0, len(self.ones[-1]), 2)
            self.ones.append(np.bitwise_and.reduceat(self.ones[-1], s))
            self.zeros.append(np.bitwise_and.reduceat(self.zeros[-1], s))

    def close(self, a: np.ndarray, b: np.ndarray, level: int, radius: int) -> np.ndarray:
        """Mask of node pairs that can hold a pair within radius: accumulated sure differences of their patterns."""
        o, z = self.ones[level], self.zeros[level]
        return np.bitwise_count((o[a] & z[b]) | (z[a] & o[b])) <= radius

    def near(self, radius: int, label: np.ndarray):
        """Blocks (u, v) of positions in Gray order, u < v, within radius and with labels that differ.

        label may change between blocks: it is looked up anew, so pairs that became connected are left out.
        """
        f, n = self.fps, len(self.fps)
        # depth-first over blocks of node pairs, so that memory stays bounded
        stack = [(len(self.ones) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, a, b = stack.pop()
            keep = self.close(a, b, level, radius)
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            starts = np.arange(0, n, LEAF << level)
            low, high = np.minimum.reduceat(label, starts), np.maximum.reduceat(label, starts)
            done = (low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b])
            a, b = a[~done], b[~done]
            if level:
                m = len(self.ones[level - 1])
                ca = np.concatenate([2 * a, 2 * a, 2 * a + 1, 2 * a + 1])
                cb = np.concatenate([2 * b, 2 * b + 1, 2 * b, 2 * b + 1])
                ok = (ca < m) & (cb < m) & (ca <= cb)
                ca, cb = ca[ok], cb[ok]
                # self pairs last in, first out: dense runs connect before pairs of runs are compared
                order = np.argsort(cb - ca, kind="stable")[::-1]
                stack += [(level - 1, ca[order[i : i + 4096]], cb[order[i : i + 4096]]) for i in range(0, len(ca), 4096)]
                continue
            for i in range(0, len(a), 512):
                ix = a[i : i + 512, None] * LEAF + np.arange(LEAF)
                iy = b[i : i + 512, None] * LEAF + np.arange(LEAF)
                real = (ix < n)[:, :, None] & (iy < n)[:, None, :] & (ix[:, :, None] < iy[:, None, :])
                ix, iy = np.minimum(ix, n - 1), np.minimum(iy, n - 1)
                real &= np.bitwise_count(f[ix][:, :, None] ^ f[iy][:, None, :]) <= radius
                real &= label[ix][:, :, None] != label[iy][:, None, :]
                if self.side is not None:
                    real &= self.side[ix][:, :, None] != self.side[iy][:, None, :]
                k, p, q = np.nonzero(real)
                if len(k):
                    yield ix[k, p], iy[k, q]

    def spanning_links(self, radius: int) -> np.ndarray:
        """Pairs of fingerprints that connect all members connected at radius, without redundant ones."""
        label, links = np.arange(len(self.fps)), []

        def root(i: int) -> int:
            while label[i] != i:
                label[i] = label[label[i]]
                i = int(label[i])
            return i

        for us, vs in self.near(radius, label):
            for u, v in zip(us.tolist(), vs.tolist()):
                ru, rv = root(u), root(v)
                if ru != rv:
                    label[max(ru, rv)] = min(ru, rv)
                    links.append((u, v))
            while True:  # all labels at their roots, for the look-ups by run
                up = label[label]
                if np.array_equal(up, label):
                    break
                label[:] = up
        return self.fps[np.array(links, np.int64).reshape(-1, 2)]


def cell_links(fps: np.ndarray, side: np.ndarray | None = None, radius: int = RADIUS) -> np.ndarray:
    """Spanning links of one cell's distinct fingerprints."""
    if len(fps) == 2:
        return fps.reshape(1, 2)[np.bitwise_count(fps[:1] ^ fps[1:]) <= radius]
    return GrayIndex(fps, side).spanning_links(radius)


def _by_cell(batches, keys: int):
    """Rows arrive sorted by the first ``keys`` columns; yields the table of each group of equal ones."""
    held: list = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [np.asarray(b.column(i)) for i in range(keys)]
        edges = [0, *(np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1).tolist(), b.num_rows]
        for s, e in zip(edges, edges[1:]):
            key = tuple(int(c[s]) for c in cols)
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(b.slice(s, e - s))
    if held:
        yield pa.Table.from_batches(held)


def _side(group: pa.Table) -> np.ndarray | None:
    """The run of each member in a pair of runs; None for a cell of its own."""
    part = np.asarray(group["part"])
    return None if (part == part[0]).all() else part


def _lagged(b: pa.RecordBatch, radius: int, masks: int | None = None):
    """Positions (i, j) of the pairs within radius in cells of at most LEAF members, all of them in this batch.

    Cells beyond the first ``masks`` masks are bands: there every pair counts.
    """
    cols = [np.asarray(b.column(i)) for i in range(2)]
    fp = np.asarray(b.column("fp")).view(np.uint64)
    most = np.full(len(fp), radius) if masks is None else np.where(cols[0] < masks, radius, 64)
    i = np.arange(len(fp))
    for lag in range(1, LEAF):
        i = i[i < len(fp) - lag]
        i = i[np.logical_and.reduce([c[i] == c[i + lag] for c in cols])]
        near = i[np.bitwise_count(fp[i] ^ fp[i + lag]) <= most[i]]
        if len(near):
            yield near, near + lag


def _whole_cells(batches):
    """The batches, cut so that none ends within a cell (mask, value) of at most LEAF members."""
    rest = None
    for b in batches:
        if rest is not None and rest.num_rows:
            b = pa.Table.from_batches([rest, b]).combine_chunks().to_batches()[0]
        n = b.num_rows
        last = np.flatnonzero((np.asarray(b.column(0)) != b.column(0)[n - 1].as_py()) | (np.asarray(b.column(1)) != b.column(1)[n - 1].as_py())) if n else []
        at = int(last[-1]) + 1 if len(last) else 0
        if at:
            yield b.slice(0, at)
        rest = b.slice(at)
    if rest is not None and rest.num_rows:
        yield rest


def _small_candidates(radius: int, masks: int):
    """Pairs of nodes of different components within radius (or in a band), for cells of at most LEAF members: one leaf of the index."""

    def run(batches):
        for b in _whole_cells(batches):
            node, component = np.asarray(b.column("node")), np.asarray(b.column("component"))
            for i, j in _lagged(b, radius, masks):
                keep = component[i] != component[j]
                u, v = node[i[keep]], node[j[keep]]
                if len(u):
                    yield _pairs(np.stack([np.minimum(u, v), np.maximum(u, v)], 1))
        common.trim()

    return run


def _small_links(radius: int):
    def run(batches):
        for b in _whole_cells(batches):
            fp = np.asarray(b.column("fp"))
            for i, j in _lagged(b, radius):
                yield _pairs(np.stack([fp[i], fp[j]], 1))
        common.trim()

    return run


def _links(radius: int):
    def run(batches):
        out, size = [], 0
        for group in _by_cell(batches, 4):
            got = cell_links(np.asarray(group["fp"]).view(np.uint64), _side(group), radius).view(np.int64)
            out.append(got)
            size += len(got)
            if size > 10_000:
                yield _pairs(np.concatenate(out))
                out, size = [], 0
        if out:
            yield _pairs(np.concatenate(out))
        common.trim()

    return run


def _pairs(uv: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(uv[:, i])) for i in (0, 1)], names=["u", "v"])


# ---------------------------------------------------------------- cells
def cells(members: DataFrame, masks: list[int], radius: int, limit: int) -> DataFrame:
    """(mask, value, one, two, part, count, ...members' columns) of the cells that hold two members or more.

    members have fp and columns as narrow.  In a cell within the limit one = two = part = 0.  A larger one is cut into runs at quantiles
    of Gray rank, of about half the limit each; a member is in its run's group (one = two) and in that of each other run
    whose shared bits differ from its own run's in radius bits or fewer.  So no group holds more than about the limit.
    A column bands of members (an array of longs, or null) names further cells, whose masks are numbered on; in those a run meets all others.
    """
    rest = [c for c in members.columns if c not in ("fp", "bands")]
    value = F.array(*(F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("value")) for i, m in enumerate(masks)))
    if "bands" in members.columns:
        more = F.transform("bands", lambda x, i: F.struct((i + len(masks)).cast("int").alias("mask"), x.alias("value")))
        value = F.when(F.col("bands").isNull(), value).otherwise(F.concat(value, more))
    rows = members.select("fp", *rest, F.explode(value).alias("c")).select("c.mask", "c.value", "fp", *rest)
    narrow = members.select("fp", F.explode(value).alias("c")).select("c.mask", "c.value", "fp")
    sizes = common.cut(narrow.groupBy("mask", "value").count().where("count > 1"))
    met = rows.join(common.few(sizes), ["mask", "value"])
    zero = F.lit(0)
    out = met.where(F.col("count") <= limit).select("mask", "value", zero.alias("one"), zero.alias("two"), zero.alias("part"), "count", "fp", *rest)
    large = sizes.where(F.col("count") > limit)
    if not large.isEmpty():
        rank = gray_order(F.col("fp"))
        ranked = met.where(F.col("count") > limit).withColumn("rank", rank)
        # a boundary for each quantile that the cell's size asks for
        step = F.greatest(F.lit(1), F.floor(F.lit(QUANTILES) / F.ceil(2 * F.col("count") / F.lit(limit)))).cast("int")
        marks = ranked.groupBy("mask", "value", "count").agg(F.percentile_approx(
            "rank",
            [i / QUANTILES for i in range(1, QUANTILES)],
            4 * QUANTILES,
        ).alias("at"))
        marks = common.cut(marks.select("mask", "value", F.array_distinct(F.filter("at", lambda _, i: (i + 1) % step == 0)).alias("at")))
        run = F.aggregate("at", F.lit(0), lambda n, x: n + F.when(x < F.col("rank"), 1).otherwise(0))
        ranked = ranked.join(common.few(marks, 500), ["mask", "value"]).withColumn("run", run).drop("at", "rank")
        shared = common.cut(ranked.groupBy("mask", "value", "run").agg(F.bit_and("fp").alias("ones"), F.bit_and(F.bitwise_not("fp")).alias("zeros")))
        a, b = (shared.select("mask", "value", *(F.col(c).alias(f"{c}_{s}") for c in ("run", "ones", "zeros"))) for s in "ab")
        differ = F.bit_count(F.col("ones_a").bitwiseAND(F.col("zeros_b")).bitwiseOR(F.col("zeros_a").bitwiseAND(F.col("ones_b"))))
        near = (F.col("mask") >= len(masks)) | (differ <= radius)
        pairs = a.join(b, ["mask", "value"]).where((F.col("run_a") <= F.col("run_b")) & near)
        ends = F.explode(F.array_distinct(F.array("run_a", "run_b")))
        pairs = pairs.select("mask", "value", F.col("run_a").alias("one"), F.col("run_b").alias("two"), ends.alias("run"))
        split = ranked.join(common.few(pairs), ["mask", "value", "run"])
        out = out.unionByName(split.select("mask", "value", "one", "two", F.col("run").alias("part"), "count", "fp", *rest))
    return out


CELL = ["mask", "value", "one", "two"]


def by_cell(rows: DataFrame, *columns: str) -> DataFrame:
    """The cell's key, then the columns; cells whole and in order."""
    return rows.select(*CELL, *columns).repartition(common.partitions(rows.sparkSession), *CELL).sortWithinPartitions(*CELL)


def _of_size(met: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells of one leaf, and larger ones."""
    return met.where(F.col("count") <= LEAF), met.where(F.col("count") > LEAF)


def linked(fps: DataFrame, limit: int = CELL_LIMIT, radius: int = RADIUS) -> DataFrame:
    """Links (u, v) that connect distinct fingerprints within ``radius`` bits; fps has one row per distinct fp."""
    common.ship(fps.sparkSession)
    small, large = _of_size(common.cut(cells(fps.select("fp"), block_masks(BLOCKS, radius), radius, limit)))
    links = by_cell(small, "fp").drop("one", "two").mapInArrow(_small_links(radius), "u long, v long")
    return links.unionByName(by_cell(large, "part", "fp").mapInArrow(_links(radius), "u long, v long")).distinct()


# ---------------------------------------------------------------- components
def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over links (u, v); only nodes that have a link.

    Alternating large-star and small-star: rounds grow with the logarithm of the longest chain.  Every round is
    checkpointed, and only its digest reaches the driver.  A component's least node is the one key that many rows share; its
    rows are pairs of numbers, aggregated before they are shuffled, and the joins to it are left to AQE to split.  A round's exchanges
    are written by as many tasks as the links ask for: a task of each leaves files, which stay until the driver collects its garbage.
    """

    def state(edges: DataFrame):
        """Count and two sums of hashes, which tell one round's links from the next one's."""
        sums = [F.sum(F.xxhash64(F.lit(i), "u", "v").cast("decimal(38,0)")) for i in (1, 2)]
        return tuple(edges.agg(F.count("*"), *sums).first())

    edges = common.cut(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    last = state(edges)
    while True:
        tasks = max(2 * edges.sparkSession.sparkContext.defaultParallelism, -(-2 * last[0] // EDGES))
        # large star: neighbours larger than a node link to the least of its neighbourhood
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct().coalesce(tasks)
        # small star: a node and its smaller neighbours link to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct("u", F.col("m").alias("v")),
        )).alias("x")).select("x.*")
        edges = common.cut(small.where("u <> v").distinct().coalesce(tasks))
        now = state(edges)
        if now == last:
            break
        last = now
    return edges.select(
        F.col("u").alias("node"),
        F.col("v").alias("component"),
    ).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _named(classes: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """(key, component_id) of every class (key, least doc_id): the least doc_id of its component."""
    owned = components(links).withColumnRenamed("node", key).join(classes, key)
    least = owned.groupBy("component").agg(F.min("least").alias("component_id"))
    moved = owned.join(least, "component").select(key, "component_id")
    return common.cut(classes.join(moved, key, "left").select(key, F.coalesce("component_id", "least").alias("component_id")))


def near_duplicates(docs: DataFrame, limit: int = CELL_LIMIT, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of docs."""
    rows = common.cut(fingerprints(docs))
    classes = common.cut(rows.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("least")))
    label = _named(classes, linked(classes, limit, radius), "fp")
    return rows.join(label, "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


# ---------------------------------------------------------------- documents by the similarity of their shingles
def node_of(h: np.ndarray) -> int:
    """Name of a set of hashes, given in ascending order."""
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(h.tobytes(), SEED)


def signature(h: np.ndarray) -> bytes:
    """Bit (hash modulo the number of bits) is set; the number of bits is a power of two."""
    m = min(SIGNATURE[1], max(SIGNATURE[0], 1 << int(4 * len(h) - 1).bit_length())) if len(h) else SIGNATURE[0]
    bits = np.zeros(m, bool)
    bits[(h & np.uint64(m - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _band_constants(seed: int = 2) -> tuple[np.ndarray, np.ndarray]:
    draw = random.Random(seed)
    made = np.array([[draw.getrandbits(64), draw.getrandbits(64) | 1] for _ in range(BANDS * BAND_ROWS)], np.uint64)
    return made[:, 0], made[:, 1]


BAND_CONSTANTS = _band_constants()


def bands(h: np.ndarray) -> list[int] | None:
    """A signed long for each band of least hashes of a set of shingle hashes; None for a set of fewer than 4."""
    if len(h) < 4:
        return None
    (flip, factor), least = BAND_CONSTANTS, np.full(BANDS * BAND_ROWS, -1, np.int64).view(np.uint64)
    for a in range(0, len(h), 1024):
        x = h[a : a + 1024, None] ^ flip
        x = (x ^ (x >> np.uint64(32))) * factor
        least = np.minimum(least, (x ^ (x >> np.uint64(29))).min(0))
    return [_signed(node_of(row)) for row in least.reshape(BANDS, BAND_ROWS)]


def _sets_of(text: str, size: int) -> tuple[np.ndarray, int]:
    """The sorted distinct shingle hashes, and the fingerprint of the distinct words."""
    words = words_of(text)
    return np.unique(shingle_hashes(words, size)), majority(shingle_hashes(list(dict.fromkeys(words)), 1))


def _described(size: int):
    def run(batches):
        for b in batches:
            made = [_sets_of(t, size) for t in b.column(1).to_pylist()]
            nodes = np.array([node_of(h) for h, _ in made], np.uint64).view(np.int64)
            fps = np.array([f for _, f in made], np.uint64).view(np.int64)
            arrays = [
                b.column(0),
                pa.array(nodes),
                pa.array(fps),
                pa.array([len(h) for h, _ in made], pa.int32()),
                pa.array([signature(h) for h, _ in made], pa.binary()),
                pa.array([bands(h) for h, _ in made], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "node", "fp", "n", "sig", "bands"])
        common.trim()

    return run


def _whole_sets(size: int):
    """(node, hashes) of every text."""

    def run(batches):
        for b in batches:
            sets = [np.unique(shingle_hashes(words_of(t), size)) for t in b.column(1).to_pylist()]
            nodes = np.array([node_of(h) for h in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array([h.view(np.int64) for h in sets], pa.list_(pa.int64()))],
                names=["node", "hashes"],
            )
        common.trim()

    return run


class Signatures:
    """Signatures of a cell's members, folded to one length where a pair needs it."""

    def __init__(self, n: np.ndarray, sigs: list[bytes], similar: tuple[int, int]):
        self.n, (self.num, self.den) = n.astype(np.int64), similar
        length = np.array([len(s) // 8 for s in sigs])
        widest = int(length.max())
        self.log = np.log2(length).astype(np.int64)
        self.at: dict[int, np.ndarray] = {}
        words = [np.frombuffer(s, "<u8") for s in sigs]
        for log in range(widest.bit_length()):
            # members of at least this length, folded down to it
            table = np.zeros((len(sigs), 1 << log), np.uint64)
            for i, w in enumerate(words):
                if len(w) >= 1 << log:
                    table[i] = np.bitwise_or.reduce(w.reshape(-1, 1 << log), axis=0)
            self.at[log] = table

    def differing(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """A lower bound of the number of shingles that one of u and v has and the other has not; -1 if surely too many."""
        out = np.zeros(len(u), np.int64)
        log = np.minimum(self.log[u], self.log[v])
        for k in np.unique(log):
            at = np.flatnonzero(log == k)
            t = self.at[int(k)]
            out[at] = np.bitwise_count(t[u[at]] ^ t[v[at]]).sum(1, dtype=np.int64)
        out = np.maximum(out, np.abs(self.n[u] - self.n[v]))
        # similar sets differ in at most (na + nb) * (den - num) / (num + den) elements
        out[out * (self.num + self.den) > (self.n[u] + self.n[v]) * (self.den - self.num)] = -1
        return out


def _candidates(radius: int, masks: int, similar: tuple[int, int], nearest: int | None):
    """Pairs of nodes of different components that may be similar: for each the ``nearest`` ones, or all."""

    def run(batches):
        for group in _by_cell(batches, 4):
            node, component = np.asarray(group["node"]), np.asarray(group["component"])
            index = GrayIndex(np.asarray(group["fp"]).view(np.uint64), _side(group))
            node, component = node[index.order], component[index.order]
            sigs = Signatures(np.asarray(group["n"])[index.order], group["sig"].take(pa.array(index.order)).to_pylist(), similar)
            best_u, best_v, best_d = (np.zeros(0, np.int64) for _ in range(3))
            for u, v in index.near(radius if group["mask"][0].as_py() < masks else 64, component):
                d = sigs.differing(u, v)
                keep = (d >= 0) & (node[u] != node[v])
                u, v, d = u[keep], v[keep], d[keep]
                if nearest is None:
                    if len(u):
                        yield _pairs(np.stack([np.minimum(node[u], node[v]), np.maximum(node[u], node[v])], 1))
                    continue
                best_u, best_v, best_d = np.concatenate([best_u, u]), np.concatenate([best_v, v]), np.concatenate([best_d, d])
                if len(best_u) > 8 * nearest * len(node):
                    best_u, best_v, best_d = _nearest(best_u, best_v, best_d, nearest)
            if len(best_u):
                u, v, _ = _nearest(best_u, best_v, best_d, nearest)
                yield _pairs(np.stack([np.minimum(node[u], node[v]), np.maximum(node[u], node[v])], 1))
        common.trim()

    return run


def _nearest(u: np.ndarray, v: np.ndarray, d: np.ndarray, k: int):
    """The pairs that are among the k least different ones of either end."""
    keep = np.zeros(len(u), bool)
    for end, other in ((u, v), (v, u)):
        order = np.lexsort((other, d, end))
        e = end[order]
        first = np.maximum.accumulate(np.where(np.concatenate(([True], e[1:] != e[:-1])), np.arange(len(e)), 0))
        keep[order[np.arange(len(e)) - first < k]] = True
    return u[keep], v[keep], d[keep]


def _bounded(similar: tuple[int, int]):
    """The pairs that their signatures do not rule out."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                n = np.concatenate([np.asarray(b.column("na")), np.asarray(b.column("nb"))])
                table = Signatures(n, b.column("x").to_pylist() + b.column("y").to_pylist(), similar)
                at = np.arange(b.num_rows)
                yield b.select(["u", "v"]).filter(pa.array(table.differing(at, at + b.num_rows) >= 0))

    return run


def _verified(rows: DataFrame, members: DataFrame, size: int, similar: tuple[int, int], pairs: DataFrame) -> DataFrame:
    """The pairs (u, v) of nodes whose whole sets are similar; members has node, n, sig and least, a row for each node.

    Only the texts of nodes in a pair that their signatures leave open are hashed again, one document for each node.
    """
    num, den = similar
    for c, n, sig in (("u", "na", "x"), ("v", "nb", "y")):
        pairs = pairs.join(members.select(F.col("node").alias(c), F.col("n").alias(n), F.col("sig").alias(sig)), c)
    pairs = common.cut(pairs.select("u", "v", "na", "nb", "x", "y").mapInArrow(_bounded(similar), "u long, v long"))
    ends = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    wanted = common.cut(members.join(ends, "node", "left_semi").select("node", F.col("least").alias("doc_id")))
    texts = rows.join(common.few(wanted.select("doc_id").distinct()), "doc_id", "left_semi")
    # another text of the same doc_id is left out by its node
    sets = texts.mapInArrow(_whole_sets(size), "node long, hashes array<long>").join(common.few(wanted.select("node")), "node", "left_semi")
    sets = common.cut(sets.dropDuplicates(["node"]))
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("hashes").alias("a")), "u").join(
        sets.select(F.col("node").alias("v"), F.col("hashes").alias("b")),
        "v",
    )
    return common.cut(both.where(F.size(F.array_intersect("a", "b")) * (num + den) >= (F.size("a") + F.size("b")) * num).select("u", "v"))


def similar(docs: DataFrame, size: int = SIMILAR_SHINGLE, least: tuple[int, int] = SIMILAR, limit: int = CELL_LIMIT, nearest: int = NEAREST) -> DataFrame:
    """(doc_id, component_id) of the rows with a doc_id: the least doc_id connected over similar documents.

    Documents with equal sets of shingles are one node.  In a first round each node of a cell names its ``nearest``
    candidates, which connects large groups of copies by a number of links in proportion to their members; the second
    round decides every candidate pair of nodes that are not connected by then.
    """
    spark = docs.sparkSession
    common.ship(spark)
    rows = _texts(docs).where("doc_id is not null")
    made = common.cut(rows.mapInArrow(_described(size), "doc_id long, node long, fp long, n int, sig binary, bands array<long>"))
    classes = common.cut(made.groupBy("node").agg(F.min("doc_id").alias("least")))
    described = common.cut(made.select("node", "fp", "n", "sig", "bands").dropDuplicates(["node"]).join(classes, "node"))
    met = common.cut(cells(described.select("fp", "node", "bands"), word_masks(), WORD_RADIUS, limit))
    members = described.drop("bands")

    def pairs(labelled: DataFrame, each: int | None) -> DataFrame:
        small, large = _of_size(met)
        few = by_cell(small.join(labelled.select("node", "component"), "node"), "fp", "node", "component").drop("one", "two")
        many = by_cell(large.join(labelled.drop("fp", "least"), "node"), "part", "fp", "node", "component", "n", "sig")
        found = few.mapInArrow(_small_candidates(WORD_RADIUS, WORD_MASKS), "u long, v long")
        return found.unionByName(many.mapInArrow(_candidates(WORD_RADIUS, WORD_MASKS, least, each), "u long, v long")).distinct()

    links = _verified(rows, members, size, least, pairs(members.withColumn("component", F.col("node")), nearest))
    labelled = members.join(components(links).distinct(), "node", "left").withColumn("component", F.coalesce("component", "node"))
    links = links.unionByName(_verified(rows, members, size, least, pairs(labelled, None)))
    label = _named(classes, links, "node")
    return made.select("doc_id", "node").join(label, "node").select("doc_id", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """docs without the documents whose component (``similar``) holds a smaller doc_id, each left document once.

    Rows with a null doc_id stay.  Of rows with equal doc_id and text one stays.  Whole documents move between
    machines only if the doc_ids to drop are too many to broadcast, or for the rows of a doc_id that repeats.
    """
    names = docs.columns
    labels = similar(docs.select("doc_id", "text"), **options)
    gone = common.cut(labels.where("component_id <> doc_id").select(F.col("doc_id").alias("_id")).distinct())
    again = common.cut(labels.groupBy(F.col("doc_id").alias("_id")).count().where("count > 1").select("_id"))
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"),
        F.col("doc_id").cast("long").alias("_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"),
    )
    rows = rows.join(common.few(gone), "_id", "left_anti")
    if not again.isEmpty():
        twice = common.few(again)
        rows = rows.join(twice, "_id", "left_anti").unionByName(rows.join(twice, "_id", "left_semi").groupBy("_id", F.md5("_text")).agg(
            F.first("_row").alias("_row"),
            F.first("_text").alias("_text"),
        ).select("_id", "_row", "_text"))
    return rows.select("_row.*")


def op8_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"))


QUERIES = {"op8_simhash_near_dedup": op8_simhash_near_dedup}
ORACLES: dict[str, str] = {}
