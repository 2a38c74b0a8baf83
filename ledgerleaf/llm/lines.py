"""Line dedup by winnowing over line hashes, in DataFrame operations only.

Units are a document's non-blank lines, compared after runs of blanks, tabs and carriage returns become one space.  A run of
lines is a passage if it has ``MIN_LINES`` lines or ``MIN_WORDS`` words, so a single line of three words is one.  A line is
deleted if it lies in a passage that occurred before: in a document of smaller doc_id, or earlier in the same.

Winnowing: the windows are the shortest passages from each line in both directions; of each window the least line hash is
selected (the last of equal ones), and only selected lines are stored, with their positions: whatever passage two places
share, they have selected a common line in it.  Positions join on the line's two hashes; a line selected in one place
only is done.  From the others a match extends both ways over the neighbouring lines' hashes to the ends of the windows that
selected it, which must agree with an earlier place as a whole; overlapping matches add up to the maximal repeated run,
and that is deleted.  Two 64-bit hash functions of each line, and of the hashes of a window, decide equality.

The first occurrence of a passage stays.  Rows with equal doc_id and text count as one document and get equal
results; a null doc_id comes before all others.  Null and blank texts stay as they are.  A text whose lines all
go becomes empty.  Blank lines stay unless they lie inside a deleted window.  An empty table gives an empty result.
A line that very many documents share is one hot key of narrow rows: its first place is an aggregate with partial sums, and the
join to it is by broadcast or left to AQE to split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

MIN_LINES, MIN_WORDS = 3, 3
#: Tables of first places up to this many rows (of six numbers) are broadcast; larger ones are joined by a shuffle, which AQE may split.
FEW = 200_000


def selected(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, tag, at, a, b, alone, more): the selected lines; tag tells texts of a doc_id apart.

    a and b are the line's hashes; alone: the line is a window of its own; more: the longer windows that selected
    it, as (first, last, a, b).
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.transform(
        F.split(text, "\n"),
        lambda x,
        i: F.struct(i.cast("int").alias("at"), F.trim(F.regexp_replace(x, r"[ \t\r]+", " ")).alias("s")),
    )

    def unit(x):
        # the second function has another seed: the hash of the number before the line
        return F.struct(
            x.at.alias("at"),
            F.xxhash64(x.s).alias("a"),
            F.xxhash64(F.lit(1), x.s).alias("b"),
            (F.length(x.s) - F.length(F.translate(x.s, " ", "")) + 1).alias("w"),
        )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("tag"),
        F.transform(F.filter(lines, lambda x: x.s != ""), unit).alias("u"),
    )

    def window(u, i, step):
        """The shortest passage from unit i in the direction of step, (first << 32) + last; null if there is none."""
        n = F.size(u)
        w = [F.coalesce(F.get(u, i + step * k)["w"], F.lit(0)) for k in range(MIN_LINES)]
        length = F.lit(MIN_LINES)
        for k in range(MIN_LINES - 2, -1, -1):
            length = F.when(sum(w[1 : k + 1], w[0]) >= min_words, k + 1).otherwise(length)
        far = i + step * (length - 1)
        first, last = (i, far) if step > 0 else (far, i)
        return F.when((far >= 0) & (far < n), F.shiftleft(first.cast("long"), 32) + last)

    # numbers, because lists of structs are told apart pair by pair; a line that is a window alone needs none
    short = F.filter(F.transform("u", lambda x, i: F.when(x.w < min_words, i)), lambda i: i.isNotNull())
    spans = F.array_distinct(F.filter(
        F.concat(F.transform(short, lambda i: window(F.col("u"), i, 1)), F.transform(short, lambda i: window(F.col("u"), i, -1))),
        lambda x: x.isNotNull(),
    ))

    def content(span):
        """A window's ends, hashes and selected unit."""
        first, last = F.shiftright(span, 32).cast("int"), span.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
        units = F.slice("u", first + 1, last - first + 1)
        least = F.array_min(F.transform(units, lambda x, i: F.struct(x.a.alias("a"), (-i).alias("i"))))
        return F.struct(
            F.col("u")[first]["at"].alias("first"),
            F.col("u")[last]["at"].alias("last"),
            F.xxhash64(F.transform(units, lambda x: x.a)).alias("a"),
            F.xxhash64(F.transform(units, lambda x: x.b)).alias("b"),
            (first - least["i"]).alias("chosen"),
        )

    rows = rows.withColumn("long", F.transform(spans, content))
    of = F.transform(
        "u",
        lambda x,
        i: F.struct(
            x.at.alias("at"),
            x.a.alias("a"),
            x.b.alias("b"),
            (x.w >= min_words).alias("alone"),
            F.filter("long", lambda y: y.chosen == i).alias("more"),
        ),
    )
    plain = F.transform(
        "u",
        lambda x: F.struct(x.at.alias("at"), x.a.alias("a"), x.b.alias("b"), (x.w >= min_words).alias("alone"), F.slice("long", 1, 0).alias("more")),
    )
    chosen = F.filter(F.when(F.size("long") == 0, plain).otherwise(of), lambda x: x.alone | (F.size(x.more) > 0))
    return rows.select("doc_id", "tag", F.explode(chosen).alias("x")).select("doc_id", "tag", "x.*")


def repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, tag, spans): per document, the passages [first, last] (line numbers) that occurred before."""
    rows = common.cut(selected(docs, min_words))
    place, key = F.struct("doc_id", "tag", F.col("at").alias("first")), ["a", "b"]
    shared = rows.groupBy(*key).agg(F.min(place).alias("least"), F.max(place).alias("most")).where("least <> most").select(*key, "least")
    # first places are broadcast while they are few, so that a line of very many documents is no hot key of a join
    met = common.cut(rows.join(common.few(common.cut(shared), FEW), key))
    alone = met.where(F.col("alone") & ~(place == F.col("least"))).select("doc_id", "tag", F.col("at").alias("first"), F.col("at").alias("last"))
    # extended both ways to the ends of the windows: their whole content must have an earlier place
    grown = met.select("doc_id", "tag", F.explode("more").alias("x")).select("doc_id", "tag", "x.first", "x.last", "x.a", "x.b")
    at = F.struct("doc_id", "tag", "first")
    firsts = grown.groupBy(*key).agg(F.min(at).alias("least"), F.max(at).alias("most")).where("least <> most").select(*key, "least")
    later = grown.join(common.few(common.cut(firsts), FEW), key).where(~(at == F.col("least"))).select("doc_id", "tag", "first", "last")
    return alone.unionByName(later).groupBy("doc_id", "tag").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def _outside(lines, spans):
    """Lines that lie in no span.  A line lies in a handful of windows, so the work is linear in the text."""
    gone = F.flatten(F.transform(spans, lambda p: F.sequence(p["first"], p["last"])))
    return F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: lines[i])


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with text and n_chars of what is left, n_lines_removed and chars_before; rows and other columns stay.

    Columns of docs may have any names; those four are replaced if they are there.
    """
    names = docs.columns
    made = ("text", "n_chars", "n_lines_removed", "chars_before")
    docs = docs.select(F.struct(*(F.col(f"`{c}`") for c in names if c not in made)).alias("_row"), "doc_id", "text")
    spans = repeats(docs.select("doc_id", "text"), min_words).select(
        F.col("doc_id").alias("_d"),
        F.col("tag").alias("_t"),
        F.col("spans").alias("_spans"),
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.withColumn("_tag", F.xxhash64(text))
    rows = rows.join(spans, (F.col("doc_id").cast("long").eqNullSafe(F.col("_d"))) & (F.col("_tag") == F.col("_t")), "left")
    rows = rows.withColumn("_lines", F.when(F.col("_spans").isNotNull(), F.split("text", "\n")))
    rows = rows.withColumn("_kept", _outside(F.col("_lines"), F.col("_spans")))
    rows = rows.withColumn("_before", F.length(text)).withColumn("n_lines_removed", F.coalesce(F.size("_lines") - F.size("_kept"), F.lit(0)))
    rows = rows.withColumn("n_lines_removed", F.when(F.col("_spans").isNotNull(), F.col("n_lines_removed")).otherwise(0))
    rows = rows.withColumn("text", F.when(F.col("_spans").isNotNull(), F.array_join("_kept", "\n", "")).otherwise(F.col("text")))
    rows = rows.withColumn(
        "n_chars",
        F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long"),
    ).withColumn("chars_before", F.col("_before").cast("long"))
    kept = [F.col(c) if c in made else F.col("_row")[c].alias(c) for c in names]
    return rows.select(*kept, *(F.col(c) for c in made if c not in names))


def drop_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The columns of docs; documents whose text is repeated wholly go, those that were blank before stay.

    Rows with equal doc_id and text are one document and lose the same lines: the first of them is not told from the
    others here.
    """
    names = docs.columns
    out = dedup(docs, min_words)
    return out.where(~((F.col("n_lines_removed") > 0) & (F.trim(F.translate("text", "\n\t\r", "")) == ""))).select(*names)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", "n_chars", "chars_before", F.col("n_lines_removed").cast("long").alias("n_lines_removed"))


QUERIES = {"op3_line_dedup": op3_line_dedup}
ORACLES = {
    "op3_line_dedup": f"""
WITH l AS (
  SELECT doc_id, u.i - 1 AS pos, u.s AS raw, trim(regexp_replace(u.s, '[ \\t\\r]+', ' ', 'g')) AS s
  FROM (SELECT doc_id, unnest(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x, i: {{'i': i, 's': x}})) AS u FROM documents)),
n AS (
  SELECT doc_id, pos, s, length(s) - length(replace(s, ' ', '')) + 1 AS w, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k
  FROM l WHERE s <> ''),
f AS (
  SELECT doc_id, pos, k,
    CASE WHEN w >= {MIN_WORDS} THEN 1 WHEN w + lead(w) OVER o >= {MIN_WORDS} THEN 2 ELSE 3 END AS ahead,
    CASE WHEN w >= {MIN_WORDS} THEN 1 WHEN w + lag(w) OVER o >= {MIN_WORDS} THEN 2 ELSE 3 END AS back,
    s, lead(s) OVER o AS s1, lead(s, 2) OVER o AS s2, lag(s) OVER o AS p1, lag(s, 2) OVER o AS p2,
    lead(pos) OVER o AS a1, lead(pos, 2) OVER o AS a2, lag(pos) OVER o AS b1, lag(pos, 2) OVER o AS b2
  FROM n WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
x AS (
  SELECT DISTINCT * FROM (
    SELECT doc_id, pos AS first, CASE ahead WHEN 1 THEN pos WHEN 2 THEN a1 ELSE a2 END AS last,
      CASE ahead WHEN 1 THEN s WHEN 2 THEN s || chr(10) || s1 ELSE s || chr(10) || s1 || chr(10) || s2 END AS content FROM f
    UNION ALL
    SELECT doc_id, CASE back WHEN 1 THEN pos WHEN 2 THEN b1 ELSE b2 END, pos,
      CASE back WHEN 1 THEN s WHEN 2 THEN p1 || chr(10) || s ELSE p2 || chr(10) || p1 || chr(10) || s END FROM f)
  WHERE first IS NOT NULL AND last IS NOT NULL),
r AS (
  SELECT doc_id, first, last FROM (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, first) AS k FROM x) WHERE k > 1),
gone AS (SELECT DISTINCT r.doc_id, l.pos FROM r JOIN l ON l.doc_id = r.doc_id AND l.pos BETWEEN r.first AND r.last),
t AS (
  SELECT l.doc_id, coalesce(string_agg(CASE WHEN gone.pos IS NULL THEN l.raw END, chr(10) ORDER BY l.pos), '') AS text,
    count(gone.pos) AS n_lines_removed
  FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.pos = gone.pos GROUP BY l.doc_id)
SELECT t.doc_id, t.text, CAST(length(t.text) AS BIGINT) AS n_chars, CAST(length(coalesce(d.text, '')) AS BIGINT) AS chars_before,
  CAST(t.n_lines_removed AS BIGINT) AS n_lines_removed
FROM t JOIN documents d ON d.doc_id = t.doc_id
""",
}
