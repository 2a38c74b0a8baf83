"""Document fingerprints from prefix polynomial hashes.

``PrefixHash`` holds, for one text, the prefix sums of code point times power of a base modulo two primes.  Any
span's hash is a difference of two prefixes times an inverse power, so span equality is one comparison and the
longest common extension of two positions is a binary search.

``Fingerprint`` holds a text's prefix hashes and its anchors: spans of ``SPAN`` code points (shorter in short texts) whose
mixed hash ends in zero bits (two in long texts, none in short ones), and the first span.  The likeness of two fingerprints aligns their shared anchors, extends
each both ways to the longest common extension, and is the share of the code points of both texts that the common
runs cover: equal texts 1, texts without a common run 0.  Runs of a span and a few dozen code points are found for sure in
practice (each span of a long text is an anchor with probability 1/4).  Of an anchor that occurs several times each place has a partner, and
on each diagonal a new run is looked for behind every difference.
The written form is the whole text's hash and length and the ``SKETCH`` smallest mixed hashes of its spans, repeats
numbered, so equal texts have equal fingerprints, and ``sketch_likeness`` estimates a likeness from that form alone.

Null texts read as empty; two empty texts are alike (1), an empty and another are not (0).  A text shorter than
a span is one span.  Rows with equal doc_id follow each other by text; repeated rows are fingerprinted as often as they
occur; a null doc_id comes first and stays null.  A single row is its own next document.  An empty table gives an
empty result; other columns are ignored.  Long texts need about 100 bytes a code point while they are hashed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, ordered

P = (2147483647, 2147483629)  # primes under 2**31
BASE = (911382323, 972663749)
SPAN, SHORT, SHORT_SPAN, SKETCH = 12, 64, 3, 64
#: Beyond each of these lengths of the shorter text anchors are half as many.
DENSE = (768, 4096)
_POWERS: dict = {}


def _powers(n: int, k: int, inverse: bool = False) -> np.ndarray:
    """base**i mod P[k] for i < n at least, by doubling."""
    had = _POWERS.get((k, inverse))
    if had is None or len(had) < n:
        p = P[k]
        b = pow(BASE[k], -1, p) if inverse else BASE[k]
        out = np.ones(1, np.uint64)
        while len(out) < n:
            out = np.concatenate([out, out * np.uint64(pow(b, len(out), p)) % np.uint64(p)])
        _POWERS[k, inverse] = had = out
    return had


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


class PrefixHash:
    """Prefix arrays of a text; spans are [start, start + length)."""

    def __init__(self, text: str | np.ndarray):
        codes = codes_of(text) if isinstance(text, str) else text
        self.n = n = len(codes)
        self.prefix = []
        for k, p in enumerate(P):
            terms = (codes + np.uint64(1)) * _powers(max(n, 1), k)[:n] % np.uint64(p)
            self.prefix.append(np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms) % np.uint64(p))))

    def spans(self, starts, length: int) -> np.ndarray:
        """62-bit hashes of the spans of one length at starts."""
        starts = np.asarray(starts)
        parts = []
        for k, p in enumerate(P):
            pre, q = self.prefix[k], np.uint64(p)
            parts.append((pre[starts + length] + q - pre[starts]) % q * _powers(self.n + 1, k, True)[starts] % q)
        return (parts[0] << np.uint64(31)) | parts[1]

    def span(self, start: int, length: int) -> int:
        return int(self.spans(np.array([start]), length)[0])

    def equal(self, start: int, other: PrefixHash, other_start: int, length: int) -> bool:
        """One comparison a prime: prefix differences times the other text's power, in place of inverse powers."""
        for k, p in enumerate(P):
            a, b = self.prefix[k], other.prefix[k]
            power = _powers(max(self.n, other.n) + 1, k)
            if (int(a[start + length]) - int(a[start])) * int(power[other_start]) % p != (int(b[other_start + length]) - int(b[other_start])) * int(power[start]) % p:
                return False
        return True

    def common_extension(self, start: int, other: PrefixHash, other_start: int) -> int:
        """Length of the longest common run of code points from the two positions."""
        return _longest(min(self.n - start, other.n - other_start), lambda m: self.equal(start, other, other_start, m))

    def common_extension_back(self, stop: int, other: PrefixHash, other_stop: int) -> int:
        """Length of the longest common run of code points before the two positions."""
        return _longest(min(stop, other_stop), lambda m: self.equal(stop - m, other, other_stop - m, m))


def _longest(most: int, holds) -> int:
    """The greatest length up to most that holds, by doubling steps and then binary search; all shorter ones hold too."""
    low, step = 0, 4
    while low + step <= most and holds(low + step):
        low, step = low + step, 2 * step
    high = min(most, low + step - 1)
    while low < high:
        mid = (low + high + 1) // 2
        if holds(mid):
            low = mid
        else:
            high = mid - 1
    return low


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _numbered(h: np.ndarray) -> np.ndarray:
    """Repeated spans count as often as they occur: the k-th occurrence of a hash becomes a value of its own."""
    h = np.sort(h)
    first = np.ones(len(h), bool)
    np.not_equal(h[1:], h[:-1], out=first[1:])
    if first.all():
        return h
    at = np.arange(len(h))
    occurrence = (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64)
    with np.errstate(over="ignore"):
        return h + occurrence * np.uint64(0x9E3779B97F4A7C15)


def _least(h: np.ndarray) -> np.ndarray:
    """The SKETCH smallest distinct values (fewer, if there are fewer)."""
    most = 4 * SKETCH
    if len(h) > most:
        few = np.unique(np.partition(h, most)[:most])
        if len(few) >= SKETCH:
            return few[:SKETCH]
    return np.unique(h)[:SKETCH]


def span_length(n: int) -> int:
    """Length of the anchors' spans in a text of n code points."""
    return min(SPAN, max(2, n // 8), n)


class Anchors:
    """Anchors by hash: the distinct values, where in ``places`` the positions of each begin, and how many there are."""

    __slots__ = ("places", "values", "first", "times")

    def __init__(self, h: np.ndarray, at: np.ndarray):
        order = np.argsort(h)
        held = h[order]
        self.places, self.first = at[order], np.flatnonzero(np.concatenate(([True], held[1:] != held[:-1])))
        self.values, self.times = held[self.first], np.diff(np.append(self.first, len(h)))
        many = np.repeat(self.times > 1, self.times)
        if many.any():  # the positions of a repeated hash ascend
            places, of = self.places[many], np.repeat(np.arange(len(self.times)), self.times)[many]
            self.places[many] = places[np.lexsort((places, of))]


class Fingerprint:
    __slots__ = ("n", "whole", "sketch", "prefixes", "hashes", "grouped")

    def __init__(self, codes: np.ndarray):
        ph = self.prefixes = PrefixHash(codes)
        self.grouped: dict = {}
        n = self.n = ph.n
        self.whole = ph.span(0, n) if n else 0
        if not n:
            self.sketch = self.hashes = np.zeros(0, np.uint64)
            return
        width = min(SPAN, n)
        h = self.hashes = ph.spans(np.arange(n - width + 1), width)
        if n <= SHORT and n > SHORT_SPAN:
            h = np.concatenate([h, ph.spans(np.arange(n - SHORT_SPAN + 1), SHORT_SPAN)])
        self.sketch = _least(_mix(_numbered(h)) >> np.uint64(16))

    def __str__(self) -> str:
        return f"{self.whole:016x}.{self.n:x}." + self.sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes().hex()

    def anchors(self, width: int, bits: int) -> Anchors:
        """The anchors of one width: spans whose mixed hash ends in so many zero bits, and the first; a text is compared more than once."""
        if (width, bits) not in self.grouped:
            h = self.hashes if width == min(SPAN, self.n) else self.prefixes.spans(np.arange(self.n - width + 1), width)
            at = np.arange(len(h))
            if bits:
                take = _mix(h) & np.uint64((1 << bits) - 1) == 0
                take[0] = True
                at = np.flatnonzero(take)
                h = h[at]
            self.grouped[width, bits] = Anchors(h, at)
        return self.grouped[width, bits]

    def common_runs(self, other: Fingerprint) -> list[tuple[int, int, int]]:
        """(start here, start there, length) of common runs: shared anchors, extended both ways."""
        if not self.n or not other.n:
            return []
        width = min(span_length(self.n), span_length(other.n))
        bits = sum(min(self.n, other.n) > n for n in DENSE)
        i, j = _paired(self.anchors(width, bits), other.anchors(width, bits))
        order = np.lexsort((i, j - i))
        i, j = i[order], j[order]
        ends = np.append(np.flatnonzero(np.diff(j - i)) + 1, len(i)).tolist()
        a, b, runs, at = self.prefixes, other.prefixes, [], 0
        for end in ends if len(i) else []:  # a diagonal each
            while at < end:
                p, q = int(i[at]), int(j[at])
                back, ahead = a.common_extension_back(p, b, q), a.common_extension(p, b, q)
                if back + ahead >= width:
                    runs.append((p - back, q - back, back + ahead))
                # the anchors that lie in the run are done; behind the difference that ends it another run may begin
                at += max(1, int(np.searchsorted(i[at:end], p + ahead)))
        return runs

    def likeness(self, other: Fingerprint) -> float:
        if self.n == other.n and self.whole == other.whole:
            return 1.0
        runs = self.common_runs(other)
        covered = sum(_covered([(r[k], r[k] + r[2]) for r in runs]) for k in (0, 1))
        return covered / (self.n + other.n) if runs else 0.0

    def sketch_likeness(self, other: Fingerprint) -> float:
        """Dice coefficient of the spans, estimated from the written forms."""
        if self.n == other.n and self.whole == other.whole:
            return 1.0
        if not self.n or not other.n:
            return 0.0
        both = np.union1d(self.sketch, other.sketch)[:SKETCH]
        shared = np.intersect1d(self.sketch, other.sketch, assume_unique=True)
        j = np.isin(both, shared, assume_unique=True).sum() / len(both)
        return float(2 * j / (1 + j))


def _paired(a: Anchors, b: Anchors) -> tuple[np.ndarray, np.ndarray]:
    """Positions of shared anchors: each occurrence in either text gets a partner, the k-th the k-th or else the last of the other text."""
    at = np.minimum(np.searchsorted(b.values, a.values), len(b.values) - 1)
    x = np.flatnonzero(b.values[at] == a.values)
    y = at[x]
    na, fa, nb, fb = a.times, a.first, b.times, b.first
    n = np.maximum(na[x], nb[y])
    k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    left = np.repeat(fa[x], n) + np.minimum(k, np.repeat(na[x] - 1, n))
    right = np.repeat(fb[y], n) + np.minimum(k, np.repeat(nb[y] - 1, n))
    return a.places[left], b.places[right]


def _covered(spans: list[tuple[int, int]]) -> int:
    """Number of places in one span or more."""
    total = end = 0
    for a, b in sorted(spans):
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _stream(batches):
    """Rows of a shard in order; each is finished when its successor has been read."""
    shard = held = None
    done: list = []

    def finish(row, after):
        doc_id, codes, fp = row
        n = len(codes)
        q = n // 4
        edited = np.concatenate([codes[: n - q], after[1][:q]]) if q else codes
        new = Fingerprint(edited)
        raw = edited.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        done.append((doc_id, n, hashlib.sha256(raw).hexdigest(), str(fp), str(new), fp.likeness(new), fp.likeness(after[2])))

    def out():
        cols = list(zip(*done))
        done.clear()
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    for b in batches:
        for s, own, doc_id, text in zip(*(b.column(i).to_pylist() for i in range(4))):
            if s != shard:
                shard, held = s, None
            codes = codes_of(text)
            row = (doc_id, codes, Fingerprint(codes))
            if held is not None:
                finish(held, row)
            # the first follower ends the shard; repeats of its doc_id are not needed
            held = row if own else None
            if len(done) >= 512:
                yield out()
        if done:
            yield out()


def edited_fingerprints(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """Per document its fingerprint and that of its edited text (tail from the next document), with likenesses."""
    spark = docs.sparkSession
    common.ship(spark)
    rows = ordered.with_successors(docs, shards or common.partitions(spark))
    return rows.mapInArrow(_stream, SCHEMA)


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(common.table(spark, sf_dir, "documents"))


QUERIES = {"op1_document_fingerprints": op1_document_fingerprints}
ORACLES: dict[str, str] = {}
