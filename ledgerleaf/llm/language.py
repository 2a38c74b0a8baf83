"""Language identification by Bayesian evidence fusion.

log P(language | row) = TEMPER * text log-likelihood + log P(declared | language) + log P(suffix | language)
+ log P(language | host), normalised over the languages.

* Languages: the declared values whose rows hold a letter trigram, however few they are and any number of them.
* Text: naive Bayes over hashed letter trigrams (``BUCKETS`` buckets), trained here on all rows with a declared
  value; digits and marks count as word ends.  A language backs off to the uniform noise model with the weight of ``RARE`` trigrams: one of
  few rows says little more than noise about buckets it has not seen, and does not win texts of a large one by its own few.
  The model holds only the buckets that a language has, so its size is that of the distinct (language, bucket) pairs.
* Declared markup language: the declared value's share among rows whose text says the language, smoothed.
* Address suffix: the last label of the host, likewise.
* Host prior: grouped counts of text languages, each level smoothed towards the next with weight ``SMOOTH``:
  host, domain (the host's last two labels), all.

A row is rejected ('und') if its text has no letter trigram, or its best language explains the text no better
than the uniform noise model over buckets.  Null texts read as empty and are rejected; null or unknown declared
languages, suffixes and hosts give no evidence.  Repeated rows get equal results and count each time.  Counts
cover all rows.  Tables without a declared row have no languages: every row is rejected; empty tables give empty results.
Ties go to the language first in the alphabet.  Columns of the rows that are named like a result (``MADE``) are replaced by it
in ``identify``; ``keep_identified`` keeps all columns as they are.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

BUCKETS = 1 << 15
RARE = 8192
#: Code points of a text, and numbers of the model, that are looked at together.
TEXT_BLOCK, MODEL_BLOCK = 1 << 18, 1 << 20
TEMPER, SMOOTH = 0.25, 20.0
#: Share of the noise model in each language's: a short text with a code or name in it stays explained.
NOISE = 0.1
#: Tables of evidence up to this many numbers are broadcast; larger ones are joined by a shuffle of the rows' keys.
BROADCAST_NUMBERS = 1 << 21
MADE = ("likelihoods", "n_trigrams", "text_language", "said", "language", "confidence")
_LETTERS: list = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([chr(i).isalpha() for i in range(1 << 16)]))
    return _LETTERS[0]


def _trigram_blocks(text: str):
    """Buckets of the letter trigrams of a text, word ends included, in blocks of bounded size."""
    text = text.lower()
    held, after_letter, any_letter = np.zeros(1, np.uint32), False, False
    for a in range(0, len(text) + 1, TEXT_BLOCK):
        codes = np.frombuffer(text[a : a + TEXT_BLOCK].encode("utf-32-le", "surrogatepass"), "<u4")
        letter = np.where(codes < 1 << 16, _letters()[np.minimum(codes, (1 << 16) - 1)], True)
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # one word end after each word
        if len(letter):
            keep[0] |= after_letter
            after_letter, any_letter = bool(letter[-1]), any_letter or bool(letter.any())
        ends = [np.zeros(1, np.uint32)] if a + TEXT_BLOCK > len(text) else []
        codes = np.concatenate([held, np.where(letter, codes, 0)[keep].astype(np.uint32), *ends])
        held = codes[-2:]
        if len(codes) >= 3 and any_letter:
            with np.errstate(over="ignore"):
                h = codes[:-2] * np.uint32(0x9E3779B1) ^ codes[1:-1] * np.uint32(0x85EBCA77) ^ codes[2:] * np.uint32(0xC2B2AE3D)
                h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            yield (h >> np.uint32(17)).astype(np.int64)


def trigrams(text: str) -> np.ndarray:
    """Buckets of the letter trigrams of a text, in order."""
    return np.concatenate([np.zeros(0, np.int64), *_trigram_blocks(text)])


def trigram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a text's trigrams, and how often each occurs."""
    if len(text) < BUCKETS:
        return np.unique(trigrams(text), return_counts=True)
    total = np.zeros(BUCKETS, np.int64)
    for b in _trigram_blocks(text):
        total += np.bincount(b, minlength=BUCKETS)
    bucket = np.flatnonzero(total)
    return bucket, total[bucket]


class Model:
    """languages, and log P(bucket | language): ``base`` of each language, and a gain above it for each bucket that it has.

    language, bucket and n: the trigram counts, a row for each pair that occurs; language is a position in languages.
    """

    def __init__(self, languages: list[str], language: np.ndarray, bucket: np.ndarray, n: np.ndarray):
        self.languages = languages
        order = np.lexsort((language, bucket))
        language, bucket, n = language[order], bucket[order], n[order]
        total = np.zeros(len(languages), np.int64)
        np.add.at(total, language, n)
        noise = (NOISE * total + RARE) / (total + RARE)
        self.base = np.log(noise / BUCKETS)
        self.language = language.astype(np.int32)
        share = (1 - noise[language]) * n / total[language]
        self.gain = (np.log(share + noise[language] / BUCKETS) - self.base[language]).astype(np.float32)
        self.start = np.searchsorted(bucket, np.arange(BUCKETS + 1))

    def likelihoods(self, bucket: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The log-likelihood of each language of a text with these trigram counts; memory does not grow with the text."""
        out = self.base * n.sum()
        first, size = self.start[bucket], self.start[bucket + 1] - self.start[bucket]
        ends = np.cumsum(size)
        cuts = np.searchsorted(ends, np.arange(MODEL_BLOCK, (ends[-1] if len(ends) else 0) + 1, MODEL_BLOCK))
        for a, b in zip([0, *cuts], [*cuts, len(bucket)]):
            if a < b:
                w = size[a:b]
                at = np.repeat(first[a:b] - (np.cumsum(w) - w), w) + np.arange(w.sum())
                out += np.bincount(self.language[at], self.gain[at] * np.repeat(n[a:b], w), len(out))
        return out

    def scores(self, texts: pd.Series, declared: pd.Series) -> pd.DataFrame:
        """Per text the log-likelihood of each language, the number of trigrams, and the most likely language; the declared
        value if it is a language."""
        out, n, best, known = [], [], [], set(self.languages)
        for t in texts:
            bucket, count = trigram_counts(t or "")
            out.append(self.likelihoods(bucket, count))
            n.append(int(count.sum()))
            best.append(self.languages[int(out[-1].argmax())] if n[-1] and known else None)
        common.trim()
        return pd.DataFrame({
            "likelihoods": out,
            "n_trigrams": np.array(n, np.int64),
            "text_language": best,
            "said": [d if d in known else None for d in declared],
        })


#: Languages whose counts a task holds before it sends them on (BUCKETS numbers each).
HELD = 256


def _counts(batches):
    """(declared, bucket, n): trigrams by bucket of each declared value, partial sums."""
    held: dict[str, np.ndarray] = {}

    def sent():
        at = {x: np.flatnonzero(c) for x, c in held.items()}
        name = pa.array(list(held), pa.string()).take(pa.array(np.repeat(np.arange(len(held)), [len(x) for x in at.values()])))
        bucket = np.concatenate([np.zeros(0, np.int64), *at.values()]).astype(np.int32)
        n = np.concatenate([np.zeros(0, np.int64), *(held[x][b] for x, b in at.items())])
        held.clear()
        return pa.RecordBatch.from_arrays([name, pa.array(bucket), pa.array(n)], names=["declared", "bucket", "n"])

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if lang and text:
                bucket, n = trigram_counts(text)
                if lang not in held:
                    if len(held) == HELD:
                        yield sent()
                    held[lang] = np.zeros(BUCKETS, np.int64)
                held[lang][bucket] += n
    yield sent()
    common.trim()


def fit(rows: DataFrame, languages: list[str] | None = None) -> Model:
    """rows: declared, text.  What is trained has a number for each (language, bucket) that occurs: BUCKETS for a language at most."""
    common.ship(rows.sparkSession)
    rows = rows.select(F.col("declared").cast("string").alias("declared"), F.col("text").cast("string").alias("text"))
    if languages is not None:
        rows = rows.where(F.col("declared").isin(list(languages)))
    counts = rows.mapInArrow(_counts, "declared string, bucket int, n long").groupBy("declared", "bucket").agg(F.sum("n").alias("n"))
    got = counts.groupBy("declared").agg(F.collect_list(F.struct("bucket", "n")).alias("x")).orderBy("declared").toArrow()  # a row a language
    had = got["declared"].to_pylist()
    pairs = got["x"].combine_chunks()
    pairs = pairs.chunk(0) if isinstance(pairs, pa.ChunkedArray) else pairs
    size = np.asarray(pairs.value_lengths())
    flat = pairs.flatten()
    names = sorted(had) if languages is None else list(languages)
    at = np.array([names.index(x) for x in had], np.int64)
    return Model(names, np.repeat(at, size), np.asarray(flat.field("bucket"), np.int64), np.asarray(flat.field("n"), np.int64))


SCORES = "likelihoods array<double>, n_trigrams long, text_language string, said string"


def with_scores(rows: DataFrame, model: Model) -> DataFrame:
    """Adds likelihoods, n_trigrams, text_language (null where there is no letter) and said (declared, if a language)."""
    scores = model.scores

    @F.pandas_udf(SCORES)
    def scored(texts: pd.Series, declared: pd.Series) -> pd.DataFrame:
        return scores(texts, declared)

    rest = [c for c in rows.columns if c not in MADE]
    return rows.select(*(F.col(f"`{c}`") for c in rest), scored("text", "declared").alias("_s")).select(*(F.col(f"`{c}`") for c in rest), "_s.*")


def suffix_of(host) -> F.Column:
    return F.regexp_extract(host, r"\.([^.]+)$", 1)


def _dense(at: dict, names, counts, n: int) -> np.ndarray:
    out = np.zeros(n)
    if names is not None:
        out[[at[x] for x in names]] = counts
    return out


class Evidence:
    """Grouped counts of scored rows (text_language, said, host), and what follows from them.

    Counts are rows (key, language, n), so their number is bounded by the data and not by the number of languages; each
    key's rows are put together to one array of a number for each language once they are sums.
    """

    def __init__(self, scored: DataFrame, model: Model):
        self.model, langs = model, model.languages
        at, size = {x: i for i, x in enumerate(langs)}, len(langs)
        domain = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
        rows = scored.select(
            "text_language",
            "said",
            "host",
            F.when(domain == "", F.col("host")).otherwise(domain).alias("domain"),
            suffix_of(F.col("host")).alias("suffix"),
        )
        # rows without a language leave after the cut: a filter before it would run the scores twice
        counts = common.cut(rows.groupBy(
            "text_language",
            "said",
            "host",
            "domain",
            "suffix",
        ).agg(F.count("*").alias("n"))).where("text_language is not null")

        def whole(of: DataFrame) -> np.ndarray:
            got = of.groupBy("text_language").agg(F.sum("n").alias("n")).collect()  # a row a language
            return _dense(at, [r.text_language for r in got], [r.n for r in got], size)

        every = whole(counts)
        self.all = (every + 1) / (every.sum() + max(1, size))
        if not langs:
            self.hosts = None
            return

        def lists(key: str, *beside: str) -> DataFrame:
            """(key, beside.., x_key): the languages and counts of each key."""
            some = counts.where((F.col(key) != "")).groupBy(key, *beside, "text_language").agg(F.sum("n").alias("n"))
            some = some.groupBy(key, *beside).agg(F.collect_list(F.struct("text_language", "n")).alias("x"))
            return some.select(
                key,
                *beside,
                F.transform("x", lambda y: y["text_language"]).alias(f"l_{key}"),
                F.transform("x", lambda y: y["n"]).alias(f"n_{key}"),
            )

        p, ending, said = self.all, whole(counts.where("suffix <> ''")), whole(counts.where("said is not null"))
        total, known = max(1.0, ending.sum()), max(1.0, said.sum())

        def given(n: np.ndarray, of_all: float, of_language: np.ndarray) -> np.ndarray:
            """log P(key | language), smoothed by the key's share in all rows."""
            return np.log((n + SMOOTH * max(n.sum() / of_all, 1e-6)) / (of_language + SMOOTH))

        @F.pandas_udf("array<double>")
        def prior(lh: pd.Series, nh: pd.Series, ld: pd.Series, nd: pd.Series, ls: pd.Series, ns: pd.Series) -> pd.Series:
            out = []
            for a, b, c, d, e, f in zip(lh, nh, ld, nd, ls, ns):
                host, over, end = _dense(at, a, b, size), _dense(at, c, d, size), _dense(at, e, f, size)
                over = (over + SMOOTH * p) / (over.sum() + SMOOTH)
                # a suffix is part of the host, so its evidence comes with the host's row; all suffixes count
                out.append(np.log((host + SMOOTH * over) / (host.sum() + SMOOTH)) + (given(end, total, ending) if e is not None else 0.0))
            return pd.Series(out)

        @F.pandas_udf("array<double>")
        def declares(names: pd.Series, n: pd.Series) -> pd.Series:
            return pd.Series([given(_dense(at, x, y, size), known, said) for x, y in zip(names, n)])

        hosts = lists("host", "domain", "suffix").join(lists("domain"), "domain", "left").join(lists("suffix"), "suffix", "left")
        self.hosts = common.cut(hosts.select("host", prior("l_host", "n_host", "l_domain", "n_domain", "l_suffix", "n_suffix").alias("host_prior")))
        self.said = common.cut(lists("said").select("said", declares("l_said", "n_said").alias("said_evidence")))

    def fused(self, likelihoods, n, evidence, host) -> pd.DataFrame:
        """language ('und' if rejected) and confidence of scored rows."""
        langs, least, base = self.model.languages, -math.log(BUCKETS), np.log(self.all)
        out = []
        for x, k, e, h in zip(likelihoods, n, evidence, host):
            if not k or not langs or x.max() <= k * least:
                out.append(("und", 0.0))
                continue
            s = TEMPER * x + (0.0 if e is None else e) + (base if h is None else h)
            i = int(s.argmax())
            out.append((langs[i], float(1 / np.exp(s - s[i]).sum())))
        return pd.DataFrame(out, columns=["language", "confidence"])

    def joined(self, rows: DataFrame, said: str) -> DataFrame:
        """rows with host_prior and said_evidence, both null where there is none; said names the column of declared values."""
        if self.hosts is None:
            nothing = F.lit(None).cast("array<double>")
            return rows.withColumn("host_prior", nothing).withColumn("said_evidence", nothing)
        most = max(1, BROADCAST_NUMBERS // len(self.model.languages))
        rows = rows.join(common.few(self.hosts.withColumnRenamed("host", "_host"), most), F.col("host") == F.col("_host"), "left").drop("_host")
        # at most a row a language
        return rows.join(F.broadcast(self.said.withColumnRenamed("said", "_said")), F.col(said) == F.col("_said"), "left").drop("_said")

    def _light(self) -> Evidence:
        """Without the tables, to be sent to executors."""
        out = object.__new__(Evidence)
        out.model, out.all = self.model, self.all
        return out

    def fuse(self, scored: DataFrame) -> DataFrame:
        """Scored rows with language and confidence."""
        rows, fused = self.joined(scored, "said"), self._light().fused

        @F.pandas_udf("language string, confidence double")
        def run(likelihoods: pd.Series, n: pd.Series, evidence: pd.Series, host: pd.Series) -> pd.DataFrame:
            return fused(likelihoods, n, evidence, host)

        rest = [F.col(f"`{c}`") for c in rows.columns if c not in ("said_evidence", "host_prior", "likelihoods")]
        return rows.select(*rest, run("likelihoods", "n_trigrams", "said_evidence", "host_prior").alias("_f")).select(*rest, "_f.*")

    def score_and_fuse(self, rows: DataFrame) -> DataFrame:
        """The same of rows with text, declared and host, in one pass of Python over the text."""
        rest = [c for c in rows.columns if c not in MADE]
        rows, fused, scores = self.joined(rows.select(*(F.col(f"`{c}`") for c in rest)), "declared"), self._light().fused, self.model.scores

        @F.pandas_udf("n_trigrams long, text_language string, said string, language string, confidence double")
        def run(texts: pd.Series, declared: pd.Series, evidence: pd.Series, host: pd.Series) -> pd.DataFrame:
            s = scores(texts, declared)
            return pd.concat([s.drop(columns="likelihoods"), fused(s["likelihoods"], s["n_trigrams"], evidence, host)], axis=1)

        rest = [F.col(f"`{c}`") for c in rest]
        return rows.select(*rest, run("text", "declared", "said_evidence", "host_prior").alias("_f")).select(*rest, "_f.*")


def identify(rows: DataFrame, languages: list[str] | None = None, keep_text: bool = True) -> DataFrame:
    """rows (text, declared, host and any others) with language, confidence, text_language, said and n_trigrams.

    Reads the text for training, for the host counts and for the result; with keep_text=False the scores without the text
    are cut in between and the text is read twice.  No text moves between machines unless the hosts are too many to broadcast.
    """
    model = fit(rows, languages)
    if keep_text:
        scored = with_scores(rows.select("text", "declared", "host"), model).select("text_language", "said", "host")
        return Evidence(scored, model).score_and_fuse(rows)
    scored = common.cut(with_scores(rows, model).drop("text"))
    return Evidence(scored.select("text_language", "said", "host"), model).fuse(scored)


def host_of(url) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def declared_in(html) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))


def keep_identified(docs: DataFrame, languages: list[str] | None = None) -> DataFrame:
    """docs (documents' columns) without the rejected ones; source serves as host, lang as the declared language."""
    names = docs.columns
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col("lang").alias("declared"),
        F.col("source").alias("host"),
    )
    return identify(rows, languages).where("language <> 'und'").select("_row.*")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import html_text

    pages = common.table(spark, sf_dir, "pages")
    common.ship(spark)

    @F.pandas_udf("string")
    def text_of(html: pd.Series) -> pd.Series:
        return html.map(html_text.main_text)

    declared = declared_in(F.col("html"))
    rows = pages.select(
        "page_id",
        "url",
        F.when(declared != "", declared).alias("declared"),
        host_of(F.col("url")).alias("host"),
        text_of("html").alias("text"),
    )
    found = identify(rows, keep_text=False)
    return found.select("page_id", "url", "declared", "host", "text_language", "language", F.round("confidence", 6).alias("confidence"), "n_trigrams")


QUERIES = {"op2_language_id": op2_language_id}
ORACLES: dict[str, str] = {}
