"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations only.

A leaf is a (domain, language, source).  The budget of tokens is dealt down the tree: each node's budget goes to
its children in proportion to their weights, none above what its subtree can hold (its tokens times
``max_epochs``); what a child cannot take goes to its siblings first, and only what the whole node cannot hold
has been left to the node's own siblings before.  All of it is whole-number arithmetic, so it does not depend on
the order of rows.

A leaf's documents are read in epochs, each in an order seeded by (seed, epoch, document).  Whole epochs are
taken as long as they fit; of the next one the token-prefix: the documents that begin before the budget ends.
The cut is found from sums over 4,096 ranges of the order key, so no leaf is ever sorted in one task; only the
range in which the budget ends is.

Null domains, languages and sources are leaves of their own (named ''); null texts hold no token and come with
the prefix like any other document.  Documents of equal doc_id and text have the same place in the order and
come or go together.  A leaf without tokens takes its documents if its budget allows one epoch of nothing: they
are kept once.  An empty table gives an empty result.  Weights not named count 1; a weight of 0 takes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from . import common

SEED = 20240
BUDGET = (3, 5)  # of all tokens
MAX_EPOCHS = 2
DOMAINS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANGUAGES = {"en": 5, "de": 2, "fr": 2, "es": 1}
RANGES = 4096
LEVELS = ("domain", "language", "leaf")


def tokens_in(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^ \t\n\r]+")).cast("long")


def domain_of(source: Column) -> Column:
    """The tables have no domain: four are made from a source's last character."""
    s = F.coalesce(source.cast("string"), F.lit(""))
    return F.concat(F.lit("d"), F.pmod(F.ascii(F.right(s, F.lit(1))), F.lit(4)).cast("string"))


def weight_of(name: Column, weights: dict) -> Column:
    out = F.lit(1)
    for k, w in weights.items():
        out = F.when(name == k, w).otherwise(out)
    return out.cast("long")


def _share(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Adds budget: the parent's budget ``b`` dealt to its children by weight ``w`` up to capacity ``cap``.

    Children are taken by ascending capacity per weight; those that the running rate fills are full, the others
    share the rest by weight, and single tokens left by rounding go to the first of them by name.
    """
    wide = "decimal(38,0)"
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    ratio = F.col("cap").cast("double") / F.col("w")
    order = by.orderBy(F.when(F.col("w") == 0, 1).otherwise(0), F.when(F.col("w") > 0, ratio), "name")
    sofar = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = nodes.withColumn("before", F.sum("cap").over(sofar) - F.col("cap")).withColumn("weights", F.sum("w").over(rest))
    # full: its fair part of what those before it have left covers its capacity
    full = (F.col("w") > 0) & ((F.col("b") - F.col("before")).cast(wide) * F.col("w").cast(wide) >= F.col("cap").cast(wide) * F.col("weights").cast(wide))
    rows = rows.withColumn("full", full)
    taken = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(by)
    weights = F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(by)
    rows = rows.withColumn("left", F.col("b") - taken).withColumn("open", weights)
    part = F.when(F.col("full"), F.col("cap")).when(
        (F.col("w") == 0) | (F.col("open") == 0),
        0,
    ).otherwise(F.expr("cast(cast(left as decimal(38,0)) * w div open as bigint)"))
    rows = rows.withColumn("budget", part)
    open_rows = by.orderBy(F.when(F.col("full") | (F.col("w") == 0), 1).otherwise(0), "name")
    short = F.when(F.col("open") > 0, F.col("left") - F.sum(F.when(F.col("full"), 0).otherwise(F.col("budget"))).over(by)).otherwise(0)
    rows = rows.withColumn("short", short).withColumn("k", F.row_number().over(open_rows))
    extra = F.when(~F.col("full") & (F.col("w") > 0) & (F.col("k") <= F.col("short")), 1).otherwise(0)
    return rows.withColumn(
        "budget",
        F.least("cap", F.col("budget") + extra).cast("long"),
    ).drop("before", "weights", "full", "left", "open", "short", "k")


def budgets(leaves: DataFrame, total: tuple[int, int], max_epochs: int, domains: dict, languages: dict, sources: dict) -> DataFrame:
    """(domain, language, leaf, tokens, budget) from (domain, language, leaf, tokens); the tree is one row a leaf."""
    leaves = common.cut(leaves.withColumn("cap", F.col("tokens") * max_epochs))
    root = leaves.agg(F.least(F.expr(f"sum(tokens) * {total[0]} div {total[1]}"), F.sum("cap")).cast("long").alias("b")).first().b  # one number
    tree = leaves.groupBy("domain").agg(F.sum("cap").alias("cap")).withColumn("b", F.lit(root).cast("long"))
    tree = _share(tree.withColumn("name", F.col("domain")).withColumn("w", weight_of(F.col("domain"), domains)), [])
    tree = tree.select("domain", F.col("budget").alias("b"))
    tree = leaves.groupBy("domain", "language").agg(F.sum("cap").alias("cap")).join(tree, "domain")
    tree = _share(tree.withColumn("name", F.col("language")).withColumn("w", weight_of(F.col("language"), languages)), ["domain"])
    tree = tree.select("domain", "language", F.col("budget").alias("b"))
    tree = leaves.join(tree, ["domain", "language"])
    tree = _share(tree.withColumn("name", F.col("leaf")).withColumn("w", weight_of(F.col("leaf"), sources)), ["domain", "language"])
    return tree.select("domain", "language", "leaf", "tokens", "budget")


LEAF = ["domain", "language", "leaf"]


def plan(docs: DataFrame, total=BUDGET, max_epochs: int = MAX_EPOCHS, domains=None, languages=None, sources=None, seed: int = SEED, domain: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, cuts): rows (doc_id, tag, domain, language, leaf, n_tokens) of all documents; cuts a row a leaf:
    tokens, budget, epochs (whole ones) and last_key (of the next epoch, documents up to this key are taken)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.md5(text).alias("tag"),
        (domain if domain is not None else domain_of(F.col("source"))).alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("language"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("leaf"),
        tokens_in(F.col("text")).alias("n_tokens"),
    )
    rows = common.cut(rows)
    tree = budgets(
        rows.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens")),
        total,
        max_epochs,
        DOMAINS if domains is None else domains,
        LANGUAGES if languages is None else languages,
        sources or {},
    )
    epochs = F.when(F.col("tokens") == 0, 1).otherwise(F.expr("budget div tokens"))
    tree = common.cut(tree.withColumn("epochs", epochs.cast("int")).withColumn(
        "rest",
        F.when(F.col("tokens") == 0, 0).otherwise(F.col("budget") % F.col("tokens")),
    ))
    small = _small(tree)
    keyed = rows.join(small(tree.where("rest > 0").select(*LEAF, "rest", "epochs")), LEAF)
    keyed = keyed.withColumn("key", order_key(F.col("epochs"), F.col("doc_id"), F.col("tag"), seed))
    keyed = keyed.withColumn("range", F.conv(F.substring("key", 1, 3), 16, 10).cast("int"))
    sums = keyed.groupBy(*LEAF, "rest", "range").agg(F.sum("n_tokens").alias("n"))
    upto = Window.partitionBy(*LEAF).orderBy("range")  # at most RANGES rows a leaf
    ends = sums.withColumn(
        "before",
        F.sum("n").over(upto) - F.col("n"),
    ).where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("n") >= F.col("rest")))
    at = common.cut(ends.select(*LEAF, "range", "before"))
    inside = keyed.join(small(at), [*LEAF, "range"]).groupBy(*LEAF, "rest", "before", "key").agg(F.sum("n_tokens").alias("n"))
    within = Window.partitionBy(*LEAF).orderBy("key")
    last = inside.withColumn(
        "start",
        F.col("before") + F.sum("n").over(within) - F.col("n"),
    ).where(F.col("start") < F.col("rest")).groupBy(*LEAF).agg(F.max("key").alias("last_key"))
    cuts = common.cut(tree.join(last, LEAF, "left"))
    return rows, cuts


def order_key(epoch: Column, doc_id: Column, tag: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), epoch.cast("string"), F.lit("|"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), tag))


#: A table of leaves is broadcast up to this many rows.
BROADCAST_LEAVES = 50_000


def _small(tree: DataFrame):
    return F.broadcast if tree.count() <= BROADCAST_LEAVES else (lambda df: df)


def select(rows: DataFrame, cuts: DataFrame, seed: int = SEED) -> DataFrame:
    """A row for each document and epoch taken, with its leaf's tokens and budget."""
    small = _small(cuts)
    out = rows.join(small(cuts), LEAF).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs"))))
    taken = (F.col("epoch") < F.col("epochs")) | (order_key(F.col("epochs"), F.col("doc_id"), F.col("tag"), seed) <= F.col("last_key"))
    return out.where(taken)


def mix(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, epoch, domain, language, source, n_tokens, leaf_tokens, leaf_budget): what the mixture reads."""
    rows, cuts = plan(docs, **options)
    out = select(rows, cuts, options.get("seed", SEED))
    return out.select(
        "doc_id",
        F.col("epoch").cast("long").alias("epoch"),
        "domain",
        "language",
        F.col("leaf").alias("source"),
        "n_tokens",
        F.col("tokens").alias("leaf_tokens"),
        F.col("budget").alias("leaf_budget"),
    )


def keep_mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mixture reads, with their columns, once for each epoch."""
    names, seed = docs.columns, options.get("seed", SEED)
    _, cuts = plan(docs, **options)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.md5(text).alias("tag"),
        (options.get("domain") if options.get("domain") is not None else domain_of(F.col("source"))).alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("language"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("leaf"),
    )
    return select(rows, cuts, seed).select("_row.*")


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.table(spark, sf_dir, "documents"))


QUERIES = {"op9_source_mixing": op9_source_mixing}


def _case(name: str, weights: dict) -> str:
    return f"CASE {name} " + " ".join(f"WHEN '{k}' THEN {w}" for k, w in weights.items()) + " ELSE 1 END"


def _level(name: str, source: str, parent: str, col: str) -> str:
    """One level of the deal as SQL: rows (.., b, cap, w, name) to rows with budget."""
    over = f"PARTITION BY {parent}" if parent else ""
    return f"""
{name}1 AS (
  SELECT *, sum(cap) OVER s - cap AS before, sum(w) OVER r AS weights FROM {source}
  WINDOW s AS ({over} ORDER BY CASE WHEN w = 0 THEN 1 ELSE 0 END, CASE WHEN w > 0 THEN cap::DOUBLE / w END, name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         r AS ({over} ORDER BY CASE WHEN w = 0 THEN 1 ELSE 0 END, CASE WHEN w > 0 THEN cap::DOUBLE / w END, name ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
{name}2 AS (SELECT *, w > 0 AND (b - before)::HUGEINT * w >= cap::HUGEINT * weights AS is_full FROM {name}1),
{name}3 AS (SELECT *, b - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({over}) AS lft, sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ({over}) AS opn FROM {name}2),
{name}4 AS (SELECT *, CASE WHEN is_full THEN cap WHEN w = 0 OR opn = 0 THEN 0 ELSE (lft::HUGEINT * w) // opn END AS part FROM {name}3),
{name}5 AS (SELECT *, CASE WHEN opn > 0 THEN lft - sum(CASE WHEN is_full THEN 0 ELSE part END) OVER ({over}) ELSE 0 END AS short,
    row_number() OVER ({over} ORDER BY CASE WHEN is_full OR w = 0 THEN 1 ELSE 0 END, name) AS k FROM {name}4),
{name} AS (SELECT {col}, least(cap, part + CASE WHEN NOT is_full AND w > 0 AND k <= short THEN 1 ELSE 0 END)::BIGINT AS budget FROM {name}5)"""


def oracle(total=BUDGET, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> str:
    return f"""
WITH d AS (
  SELECT doc_id, md5(coalesce(text, '')) AS tag, 'd' || CAST(ascii(right(coalesce(source, ''), 1)) % 4 AS VARCHAR) AS domain,
    coalesce(lang, '') AS language, coalesce(source, '') AS leaf, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r]+')) AS n_tokens
  FROM documents),
leaves AS (SELECT domain, language, leaf, sum(n_tokens) AS tokens, sum(n_tokens) * {max_epochs} AS cap FROM d GROUP BY ALL),
root AS (SELECT least(sum(tokens) * {total[0]} // {total[1]}, sum(cap)) AS b FROM leaves),
a AS (SELECT domain, domain AS name, {_case('domain', DOMAINS)} AS w, sum(cap) AS cap, any_value(root.b) AS b FROM leaves, root GROUP BY domain),{_level('da', 'a', '', 'domain')},
b AS (SELECT l.domain, language, language AS name, {_case('language', LANGUAGES)} AS w, sum(cap) AS cap, any_value(budget) AS b
  FROM leaves l JOIN da ON l.domain = da.domain GROUP BY l.domain, language),{_level('db', 'b', 'domain', 'domain, language')},
c AS (SELECT l.domain, l.language, leaf, tokens, leaf AS name, 1 AS w, cap, budget AS b
  FROM leaves l JOIN db ON l.domain = db.domain AND l.language = db.language),{_level('dc', 'c', 'domain, language', 'domain, language, leaf, tokens')},
t AS (SELECT *, CASE WHEN tokens = 0 THEN 1 ELSE budget // tokens END AS epochs, CASE WHEN tokens = 0 THEN 0 ELSE budget % tokens END AS rest FROM dc),
k AS (SELECT d.*, t.tokens, t.budget, t.epochs, t.rest, md5('{seed}|' || CAST(CAST(t.epochs AS INTEGER) AS VARCHAR) || '|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || tag) AS key
  FROM d JOIN t ON d.domain = t.domain AND d.language = t.language AND d.leaf = t.leaf),
p AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, language, leaf ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0) AS start FROM k),
e AS (SELECT p.*, unnest(range(0, CAST(epochs AS BIGINT) + 1)) AS epoch FROM p)
SELECT doc_id, CAST(epoch AS BIGINT) AS epoch, domain, language, leaf AS source, CAST(n_tokens AS BIGINT) AS n_tokens,
  CAST(tokens AS BIGINT) AS leaf_tokens, CAST(budget AS BIGINT) AS leaf_budget
FROM e WHERE epoch < epochs OR start < rest
"""


ORACLES = {"op9_source_mixing": oracle()}
