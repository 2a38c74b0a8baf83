"""Token-id files compressed by Re-Pair.

Documents are range-partitioned by doc_id, encoded, and written in ascending order as shards of about ``SHARD_TOKENS``
ids (a shard ends with the document that fills it).  Each shard is a grammar of its own: pairs of neighbouring symbols that
occur often become nonterminals, again and again, until none occurs ``LEAST`` times without overlapping itself (a rule takes 12
bytes, two symbols and an expansion length, and saves 3 bytes a place, so fewer do not pay).  A round replaces all pairs of at least an
eighth of the highest count, the more frequent first where two overlap; one that is left fewer than LEAST places waits for the next.  Pairs never reach across a document's
end, so a document's symbols are a slice of the shard, and with the expansion lengths any run of its ids can be decoded
alone (``decode``).

File format: Parquet, one row a shard: part, shard, tokens_before (ids of the part before the shard), n_tokens, alphabet
(uint32 ids of terminal symbols), rules (uint32 symbol pairs; rule r is symbol len(alphabet) + r), lengths (uint32
expansion length of each symbol), width and symbols (2, 3 or 4 bytes each), and per document doc_ids (int64; null_ids marks
nulls), doc_symbols and doc_tokens (uint32).  All little-endian.

Null texts read as empty: they hold the end id alone.  Null doc_ids come first; rows with equal doc_ids follow
each other by text; repeated rows are written as often as they occur.  An empty table gives no shards.  Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, ordered, tokens
from .tokens import runs

SHARD_TOKENS, LEAST = 1 << 20, 5
END_ID = 1
_BUCKETS = 1 << 20


def _mixed(pairs: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def _frequent(pairs: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, counts) of those that occur floor times or more, ascending."""
    if len(pairs) > 1 << 15:
        # counts by a hash first: most pairs need not be sorted
        bucket = _mixed(pairs, 20)
        pairs = pairs[(np.bincount(bucket, minlength=_BUCKETS) >= floor)[bucket]]
    few = np.sort(pairs)
    edge = np.flatnonzero(np.concatenate(([True], few[1:] != few[:-1]))) if len(few) else np.zeros(0, np.int64)
    count = np.diff(np.append(edge, len(few)))
    return few[edge[count >= floor]], count[count >= floor]


def _known(where: np.ndarray, pairs: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, number in chosen) of the positions whose pair is chosen; chosen ascends."""
    slot, full = np.full(1 << 18, -1, np.int32), np.zeros(1 << 18, bool)
    key = _mixed(chosen, 18)
    slot[key] = np.arange(len(chosen))
    twice = slot[key] != np.arange(len(chosen))
    full[key[twice]] = True
    bucket = _mixed(pairs, 18)
    at = slot[bucket]
    hit = np.flatnonzero(at >= 0)
    at = at[hit]
    # where two of the chosen share a bucket, by search
    search = np.flatnonzero(full[bucket[hit]])
    at[search] = np.minimum(np.searchsorted(chosen, pairs[hit[search]]), len(chosen) - 1)
    same = chosen[at] == pairs[hit]
    return where[hit[same]], at[same].astype(np.int64)


def _winners(where: np.ndarray, following: np.ndarray, at: np.ndarray, chosen: np.ndarray, count: np.ndarray, least: int) -> np.ndarray:
    """Mask of the occurrences (positions of both symbols, numbers in chosen) that are replaced, none overlapping.

    Of two that overlap the more frequent pair wins, ties by hash, so that equal stretches are parsed alike wherever they
    stand; in a stretch of one repeated symbol it is every other place from the left.
    """
    place = np.arange(len(where))
    next_to = np.concatenate(([False], following[:-1] == where[1:])) if len(where) else np.zeros(0, bool)
    again = next_to & np.concatenate(([False], at[1:] == at[:-1])) if len(where) else next_to
    nth = place - np.maximum.accumulate(np.where(again, 0, place))
    # pairs of one symbol hold too few places where they overlap themselves: those give way
    own = np.bincount(at[nth % 2 == 0], minlength=len(chosen)) >= least
    rank = np.empty(len(chosen), np.int32)
    rank[np.lexsort((_mixed(chosen, 62), count))] = np.arange(1, len(chosen) + 1, dtype=np.int32)
    mine = np.where(own, rank, 0)[at]
    before = np.where(next_to, np.concatenate(([0], mine[:-1])), 0) if len(where) else mine
    after = np.where(np.concatenate((next_to[1:], [False])), np.concatenate((mine[1:], [0])), 0) if len(where) else mine
    return (mine > 0) & (nth % 2 == 0) & (again | (before < mine)) & (after <= mine)


def repair(ids: np.ndarray, doc_tokens: np.ndarray, least: int = LEAST):
    """Re-Pair of concatenated documents: (alphabet, rules, lengths, symbols, doc_symbols).

    Symbols are linked by position, so a round's work is that of the places it looks at.  Once a floor has been worked off at all
    places, only those can matter whose pair was frequent before or has a new symbol: all others' counts have not grown.
    """
    alphabet = np.flatnonzero(np.bincount(ids)).astype(np.uint32)
    place = np.zeros(int(alphabet[-1]) + 1 if len(alphabet) else 1, np.uint32)
    place[alphabet] = np.arange(len(alphabet), dtype=np.uint32)
    seq, n = place[ids], len(ids)
    last, rules, lengths = np.zeros(n, bool), [], np.ones(len(alphabet), np.uint32)
    last[np.cumsum(doc_tokens) - 1] = True
    after, before = np.arange(1, n + 1), np.arange(-1, n)  # of each place the next and the one before
    gone = np.zeros(n, bool)
    floor = None
    places = np.flatnonzero(~last)
    while len(places):
        pairs = (seq[places].astype(np.uint64) << np.uint64(32)) | seq[after[places]]
        if floor is None:
            # no pair is more frequent than the fullest of the buckets of their hashes
            floor = max(least, int(np.bincount(_mixed(pairs, 16)).max()) // 8)
        known, count = _frequent(pairs, floor)
        where = at = met = np.zeros(0, np.int64)
        if len(known):
            met, of = _known(places, pairs, known)
            wins = _winners(met, after[met], of, known, count, least)
            where, at = met[wins], of[wins]
            enough = np.bincount(at, minlength=len(known)) >= least
            use, number = enough[at], np.cumsum(enough) - 1
            where, at = where[use], number[at[use]]
        if len(where):
            new = known[enough]
            new = np.stack([new >> np.uint64(32), new & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
            second = after[where]
            third = after[second]
            seq[where], last[where], after[where] = (len(lengths) + at).astype(np.uint32), last[second], third
            before[third], gone[second] = where, True
            lengths = np.concatenate([lengths, lengths[new[:, 0]] + lengths[new[:, 1]]])
            rules.append(new)
        if floor > least:
            floor = max(least, floor // 8)
            places = np.flatnonzero(~(gone | last))
        elif len(where):
            look = np.zeros(n, bool)
            look[met] = look[where] = True
            look[before[where][before[where] >= 0]] = True
            places = np.flatnonzero(look & ~gone & ~last)
        else:
            break
    stay = ~gone
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    return alphabet, table, lengths, seq[stay], np.diff(np.flatnonzero(last[stay]), prepend=-1).astype(np.uint32)


def packed(symbols: np.ndarray) -> tuple[int, bytes]:
    """(width, bytes) of symbols in 2, 3 or 4 bytes each."""
    most = int(symbols.max(initial=0))
    width = 2 if most < 1 << 16 else 3 if most < 1 << 24 else 4
    return width, symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def unpacked(raw: bytes, width: int) -> np.ndarray:
    few = np.frombuffer(raw, np.uint8).reshape(-1, width)
    out = np.zeros((len(few), 4), np.uint8)
    out[:, :width] = few
    return out.reshape(-1).view("<u4")


class Grammar:
    """Expands slices of a shard's symbols, by the expansions of all of them."""

    def __init__(self, alphabet: np.ndarray, rules: np.ndarray, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        n = len(alphabet)
        self.flat = np.zeros(int(self.lengths.sum()), np.uint32)
        self.flat[:n] = alphabet
        done = n
        while done < len(lengths):
            # rules whose parts are expanded already
            part = rules[done - n :].astype(np.int64)
            ready = np.flatnonzero((part >= done).any(1))
            stop = int(ready[0]) if len(ready) else len(part)
            both = part[:stop].reshape(-1)
            self.flat[self.starts[done] : self.starts[done + stop - 1] + self.lengths[done + stop - 1]] = self.flat[runs(self.starts[both], self.lengths[both])]
            done += stop

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        s = symbols.astype(np.int64)
        return self.flat[runs(self.starts[s], self.lengths[s])]


FILE_SCHEMA = "part int, shard int, tokens_before long, n_tokens long, alphabet binary, rules binary, lengths binary, width int, symbols binary, doc_ids binary, null_ids binary, doc_symbols binary, doc_tokens binary"


def _shards(path: str, end_id: int, shard_tokens: int, names: list[str], types: list):
    def run(batches):
        from pyspark import TaskContext

        enc = tokens.encoder(path)
        part = TaskContext.get().partitionId()
        held_ids: list[np.ndarray] = []
        held_docs: list = []
        size = shard = before = 0

        def flush():
            nonlocal size, shard, before
            ids = np.concatenate(held_ids)
            n = np.array([len(x) for x in held_ids], np.uint32)
            alphabet, rules, lengths, symbols, doc_symbols = repair(ids, n)
            doc_ids = np.array([x or 0 for x in held_docs], "<i8")
            nulls = np.array([x is None for x in held_docs], np.uint8)
            width, raw = packed(symbols)
            row = (
                part,
                shard,
                before,
                len(ids),
                alphabet.astype("<u4"),
                rules.astype("<u4"),
                lengths.astype("<u4"),
                width,
                raw,
                doc_ids,
                nulls,
                doc_symbols.astype("<u4"),
                n.astype("<u4"),
            )
            before, shard, size = before + len(ids), shard + 1, 0
            held_ids.clear()
            held_docs.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes() if isinstance(x, np.ndarray) else x], t) for x, t in zip(row, types)],
                names=names,
            )

        for b in batches:
            doc_ids = b.column(0).to_pylist()
            for lo, hi in tokens.batches(b.column(1)):
                ids, n = enc.encode_array(b.column(1).slice(lo, hi - lo), end_id)
                for doc_id, stop, k in zip(doc_ids[lo:hi], np.cumsum(n).tolist(), n.tolist()):
                    held_ids.append(ids[stop - k : stop])
                    held_docs.append(doc_id)
                    size += k
                    if size >= shard_tokens:
                        yield flush()
        if held_ids:
            yield flush()
        common.trim()

    return run


def write(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = END_ID, parts: int | None = None, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encodes docs (doc_id, text) and writes the token files to path, a folder that executors share."""
    spark = docs.sparkSession
    common.ship(spark)
    rows = ordered.in_order(
        common.with_defaults(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")),
        parts or common.partitions(spark),
    ).select("doc_id", "text")
    names = [x.split()[0] for x in FILE_SCHEMA.split(", ")]
    types = [{"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in FILE_SCHEMA.split(", ")]
    rows.mapInArrow(_shards(tokenizer_path or tokens.vocabulary_path(), end_id, shard_tokens, names, types), FILE_SCHEMA).write.parquet(path)


def _grammar(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(row["alphabet"], "<u4"), np.frombuffer(row["rules"], "<u4").reshape(-1, 2), np.frombuffer(row["lengths"], "<u4")


def decode_shard(row: dict):
    """(doc_id, ids) of each document of a shard."""
    symbols, cuts = unpacked(row["symbols"], row["width"]), np.cumsum(np.frombuffer(row["doc_symbols"], "<u4"), dtype=np.int64)
    ids = Grammar(*_grammar(row)).expand(symbols)
    ends = np.cumsum(np.frombuffer(row["doc_tokens"], "<u4"), dtype=np.int64)
    if len(ids) != (ends[-1] if len(ends) else 0) or len(symbols) != (cuts[-1] if len(cuts) else 0):
        raise ValueError("a shard's lengths do not agree")
    doc_ids, nulls = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["null_ids"], np.uint8)
    for i, (s, e) in enumerate(zip(np.concatenate(([0], ends[:-1])), ends)):
        yield (None if nulls[i] else int(doc_ids[i])), ids[s:e]


def decode(row: dict, i: int, first: int = 0, last: int | None = None) -> np.ndarray:
    """Random access: ids [first, last) of the shard's i-th document.

    The expansion lengths of the document's symbols tell which of them hold the run; of these only the rules that reach
    into it are expanded.
    """
    alphabet, rules, lengths = _grammar(row)
    ends = np.cumsum(np.frombuffer(row["doc_symbols"], "<u4"), dtype=np.int64)
    width, s = row["width"], int(ends[i - 1]) if i else 0
    symbols = unpacked(row["symbols"][s * width : int(ends[i]) * width], width)
    upto = np.concatenate(([0], np.cumsum(lengths[symbols], dtype=np.int64)))
    last = min(int(upto[-1]), int(upto[-1]) if last is None else last)
    first = max(0, first)
    if first >= last:
        return np.zeros(0, np.uint32)
    a, b = int(np.searchsorted(upto, first, "right")) - 1, int(np.searchsorted(upto, last))
    stack, out = [(int(symbols[k]), int(upto[k])) for k in range(b - 1, a - 1, -1)], []
    while stack:
        symbol, at = stack.pop()
        if at >= last or at + int(lengths[symbol]) <= first:
            continue
        if symbol < len(alphabet):
            out.append(alphabet[symbol])
        else:
            left, right = (int(x) for x in rules[symbol - len(alphabet)])
            stack += [(right, at + int(lengths[left])), (left, at)]
    return np.array(out, np.uint32)


READ_SCHEMA = "part int, doc_id long, at long, n_tokens long, ids_crc32 long, ids binary"


def _decoded(with_ids: bool):
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                at, out = row["tokens_before"], []
                for doc_id, ids in decode_shard(row):
                    raw = ids.astype("<u4").tobytes()
                    out.append((row["part"], doc_id, at, len(ids), zlib.crc32(raw), raw if with_ids else None))
                    at += len(ids)
                cols = list(zip(*out))
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[x.split()[0] for x in READ_SCHEMA.split(", ")])

    return run


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) decoded from the files; start counts the ids before the document."""
    common.ship(spark)
    shards = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()  # a row a part
    base, before = [], 0
    for r in totals:
        base.append((r.part, before))
        before += r.n
    bases = spark.createDataFrame(base or [(0, 0)], "part int, base long")
    docs = shards.mapInArrow(_decoded(with_ids), READ_SCHEMA).join(F.broadcast(bases), "part")
    return docs.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.new_path(spark, "token-files")
    common.remove_later(spark, path)
    write(common.table(spark, sf_dir, "documents"), path)
    return read(spark, path, with_ids=False)


QUERIES = {"op4_token_files": op4_token_files}
ORACLES: dict[str, str] = {}
