"""Quality classifier: document evidence combined with host and path posteriors by hierarchical empirical Bayes.

*Evidence.* From most of a bounded sample of labelled documents, grouped counts give words and word beginnings
log-likelihood ratios for "low quality" and "toxic"; what chance explains or hardly tells the kinds apart is left out. On
the rest of the sample a small logistic regression weighs the two sums over a document's distinct words against binned
measures of its shape; its margin, less the base rate, is the document's evidence.

*Sites.* Over all documents, each document's evidence and the global rate give an expected share of bad documents per host
and per path of a host. The spread between hosts (and between paths of a host) beyond sampling noise sets how strongly a
sparse host shrinks to the global rate and a sparse path to its host. A document's posterior is its evidence on top of its
path's rate.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.targets import stage
from .common import few, map_rows, only, text_or_empty, without

#: Labelled documents used for fitting, and features kept in the model (the strongest, if more pass).
MOST_LABELLED, MOST_FEATURES = 20_000, 100_000
#: A feature needs this many labelled documents, this many standard deviations from chance and this ratio between the kinds.
LEAST_DOCS, LEAST_Z, LEAST_RATIO = 4, 5.0, 3.0
#: Share of the labelled sample that the regression is fitted on, in percent; sums over words are cut at CUT either way.
HELD, CUT, BINS = 30, 12.0, 20
#: Letters of the word beginnings that are features of their own.
PREFIXES = (4, 5, 6)
#: Words whose evidence a worker remembers; labelled documents whose counts are added up before they leave a worker.
WORDS, COUNTED = 150_000, 2048
KINDS = ("low", "toxic")
FIND = re.compile(r"[^\W\d_]+").findall
BREAKS = re.compile(r"[.!?](?:\s|$)|\n")


def parts(word: str) -> list[str]:
    """The features of a word: itself and its beginnings."""
    return [word, *(f"{word[:n]}~" for n in PREFIXES if len(word) > n)]


MEASURES = ("length", "distinct", "again", "capitals", "letters", "short", "breaks", "symbols", "calls")


def shape(text: str, words: list[str]) -> list[int]:
    """The bin of each measure of a document's form, from 0 to BINS."""
    n, size = max(len(words), 1), max(len(text), 1)
    symbols = sum(map(text.count, "#$%&*+/<=>@[\\]^_`{|}~"))
    shares = (len(words).bit_length() / BINS, len(set(words)) / n, sum(a == b for a, b in zip(words, words[1:])) / n, sum(map(str.isupper, text)) / size,
              sum(map(len, words)) / size, sum(len(w) < 3 for w in words) / n, len(BREAKS.findall(text)) / n * 2, symbols / size * 5, text.count("!") / size * 5)
    return [int(min(1.0, v) * BINS) for v in shares]


def number(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature) - (1 << 63)


def counts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(feature, docs, low, toxic) over the labelled documents; feature 0 counts the documents."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        only("quality", lambda: None)
        found: dict[int, list[int]] = {}
        for x, low, toxic in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            text = x.as_py()
            words = FIND(text.lower())
            features = {number(f) for w in set(words) for f in parts(w)} | {0}
            for f in features:
                row = found.setdefault(f, [0, 0, 0])
                row[0] += 1
                row[1] += low
                row[2] += toxic
        columns = list(zip(*((k, *v) for k, v in found.items())))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["feature", "docs", *KINDS])

    picked = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).join(labels, "id").select("text", *KINDS)
    out = map_rows(picked, run, "feature long, docs long, low long, toxic long", COUNTED)
    return out.groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("docs", *KINDS)])


def word_weights(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted features and their (n, 2) weights, from ``counts``. What comes to the driver is bounded by MOST_FEATURES."""
    total = table.where("feature = 0").first()
    n = total["docs"] if total else 0
    seen = [k for k in KINDS if n and 2 <= total[k] < n]  # a kind seen in under two documents cannot be learnt
    if not seen:
        return np.empty(0, np.int64), np.empty((0, 2))
    chance = {k: total[k] / n for k in seen}
    z = F.greatest(*[F.abs(F.col(k) - F.col("docs") * chance[k]) / F.sqrt(F.col("docs") * (chance[k] * (1 - chance[k]))) for k in seen], F.lit(0.0))
    strong = table.where((F.col("feature") != 0) & (F.col("docs") >= LEAST_DOCS)).withColumn("z", z).where(F.col("z") >= LEAST_Z)
    rows = sorted(strong.orderBy(F.desc("z"), "feature").limit(MOST_FEATURES).collect())
    held, weights = np.array([r["docs"] for r in rows], float), np.zeros((len(rows), 2))
    for i, k in enumerate(KINDS):
        if k in seen:
            bad = np.array([r[k] for r in rows], float)
            z = np.abs(bad - held * chance[k]) / np.sqrt(held * chance[k] * (1 - chance[k]))
            ratio = np.log((bad + chance[k]) / (total[k] + 1)) - np.log((held - bad + 1 - chance[k]) / (n - total[k] + 1))
            weights[:, i] = np.where((z >= LEAST_Z) & (np.abs(ratio) >= np.log(LEAST_RATIO)), ratio, 0)
    some = weights.any(axis=1)
    return np.array([r["feature"] for r in rows], np.int64)[some], weights[some]


def columns(sums: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The regression's input: 1, the two cut sums and one column for each bin of each measure."""
    hot = (bins[:, :, None] == np.arange(BINS + 1)).reshape(len(bins), -1)
    return np.hstack([np.ones((len(bins), 1)), np.clip(sums, -CUT, CUT), hot])


def regression(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Logistic regression by Newton steps, with a ridge on all but the constant."""
    w, penalty = np.zeros(x.shape[1]), np.r_[1e-3, np.full(x.shape[1] - 1, ridge)]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most_labelled: int = MOST_LABELLED) -> tuple:
    """(rate of each kind, sorted features, their weights, regression weights (2, columns)). ``labels``: (id, quality 0/1, toxic 0/1); a null counts as good.

    Of more than ``most_labelled`` labelled documents a hash of the id picks about that many; the regression's part of them
    comes to the driver as two sums and nine bins each.
    """
    known = labels.where("id IS NOT NULL").groupBy("id").agg(F.max(F.coalesce(1 - F.col("quality"), F.lit(0))).cast("int").alias("low"), F.max(F.coalesce("toxic", F.lit(0))).cast("int").alias("toxic"))
    known = stage(known)
    share = min(1.0, most_labelled / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < round(share * 1_000_000))
    later = F.pmod(F.xxhash64("id", F.lit("regression")), F.lit(100)) < HELD
    features, weights = word_weights(stage(counts(docs, few(known.where(~later), most_labelled * 2), id_col, text_col)))
    picked = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).join(few(known.where(later), most_labelled * 2), "id").select("text", *KINDS)
    rows = measured(picked, features, weights, KINDS, "text").collect()
    coefs = np.zeros((2, 3 + len(MEASURES) * (BINS + 1)))
    rates = {k: (sum(r[k] for r in rows) + 0.5) / (len(rows) + 1) if rows else 0.01 for k in KINDS}
    if rows:
        x = columns(np.array([[r["sum_low"], r["sum_toxic"]] for r in rows]), np.array([r["bins"] for r in rows]))
        for i, k in enumerate(KINDS):
            y = np.array([r[k] for r in rows], float)
            if 2 <= y.sum() < len(y):
                coefs[i] = regression(x, y)
                coefs[i, 0] -= np.log(rates[k] / (1 - rates[k]))
    return rates, features, weights, coefs


class Evidence(dict):
    """Word to its two weights: of the word and its beginnings, the strongest one counts."""

    def __init__(self, features: np.ndarray, weights: np.ndarray):
        super().__init__()
        self.weights = dict(zip(features.tolist(), map(tuple, weights.tolist())))

    def strongest(self, features: list[str]) -> tuple[float, float] | None:
        found = [w for f in features if (w := self.weights.get(number(f)))]
        return tuple(max((w[i] for w in found), key=abs) for i in (0, 1)) if found else None

    def __missing__(self, word: str):
        if len(self) > WORDS:
            self.clear()
        self[word] = out = self.strongest(parts(word))
        return out

    def of(self, text: str) -> tuple[float, float, list[int]]:
        words = FIND(text.lower())
        found = [w for w in map(self.__getitem__, set(words)) if w]
        return sum(w[0] for w in found), sum(w[1] for w in found), shape(text, words)


def measured(docs: DataFrame, features: np.ndarray, weights: np.ndarray, keys: Sequence[str], text_col: str) -> DataFrame:
    """(``keys``, sum_low, sum_toxic, bins) of every document; a null text counts as empty."""
    shipped = docs.sparkSession.sparkContext.broadcast((features, weights))
    held: list[Evidence] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        only("quality", lambda: None)
        if not held:
            held.append(Evidence(*shipped.value))
        scores = [held[0].of(x.as_py()) for x in batch.column(len(keys))]
        values = [*(pa.array([s[i] for s in scores], pa.float64()) for i in (0, 1)), pa.array([s[2] for s in scores], pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *values], [*(f"k{i}" for i in range(len(keys))), "sum_low", "sum_toxic", "bins"])

    schema = ", ".join(f"k{i} {docs.schema[k].dataType.simpleString()}" for i, k in enumerate(keys))
    out = map_rows(docs.select(*[F.col(k) for k in keys], text_or_empty(text_col)), run, f"{schema}, sum_low double, sum_toxic double, bins array<int>")
    return out.toDF(*keys, "sum_low", "sum_toxic", "bins")


def evidence(scored: DataFrame, coefs: np.ndarray) -> DataFrame:
    """``measured`` rows with llr_low and llr_toxic in place of sums and bins."""
    for i, k in enumerate(KINDS):
        own, table = coefs[i], F.array(*[F.lit(float(v)) for v in coefs[i, 3:]])
        cut = [F.greatest(F.lit(-CUT), F.least(F.lit(CUT), F.col(f"sum_{x}"))) * float(own[1 + j]) for j, x in enumerate(KINDS)]
        bins = [F.get(table, F.get("bins", m) + m * (BINS + 1)) for m in range(len(MEASURES))]
        scored = scored.withColumn(f"llr_{k}", sum([*cut, *bins], F.lit(float(own[0]))))
    return scored.drop("sum_low", "sum_toxic", "bins")


def posterior(llr: str, rate):
    """Probability from evidence on top of a rate; the exponent is bounded so that it stays finite."""
    return 1 / (1 + F.exp(F.greatest(F.lit(-500.0), F.least(F.lit(500.0), -F.col(llr) - F.log(rate / (1 - rate))))))


def strength(groups: DataFrame, share: str, n: str, centre) -> float:
    """Prior documents of a beta-binomial: how alike the groups' shares are beyond sampling noise (method of moments)."""
    row = groups.where(F.col(n) >= 2).agg(F.sum(F.col(n) * (F.col(share) - centre) ** 2).alias("ss"), F.sum(n).alias("n"), F.count("*").alias("k"), F.sum(F.col(n) * centre * (1 - centre)).alias("v")).first()
    if not row["k"] or row["n"] <= 2 or not row["v"]:
        return 100.0
    noise, size = row["v"] / row["n"], row["n"] / row["k"]
    between = max(0.0, row["ss"] / row["n"] - noise / size)
    return min(1e4, max(2.0, noise / between - 1)) if between > 0 else 1e4


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", limit: float = 0.5) -> DataFrame:
    """(id, host, path, llr_low, llr_toxic, host_low, path_low, p_low, host_toxic, path_toxic, p_toxic, kept), one row per input row.

    ``labels`` has the id, quality (1 good) and toxic (1 toxic). A document is kept where both probabilities are under
    ``limit``. A null host or path is a group of its own; a null id is scored like any other. Without labels every document
    is kept.
    """
    told = labels.select(F.col(id_col).alias("id"), F.col("quality"), F.col("toxic"))
    rates, features, weights, coefs = fit(docs, told, id_col, text_col)
    scored = measured(docs, features, weights, [id_col, host_col, path_col], text_col).toDF("id", "host", "path", "sum_low", "sum_toxic", "bins")
    scored = stage(evidence(scored, coefs))
    soft = {k: posterior(f"llr_{k}", F.lit(rates[k])) for k in KINDS}
    paths = stage(scored.groupBy("host", "path").agg(F.count("*").alias("n"), *[F.sum(soft[k]).alias(f"bad_{k}") for k in KINDS]))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n_host"), *[F.sum(f"bad_{k}").alias(f"host_bad_{k}") for k in KINDS])
    all_docs = hosts.agg(F.sum("n_host").alias("n"), *[F.sum(f"host_bad_{k}").alias(k) for k in KINDS]).first()
    centre = {k: min(0.999, max(1e-4, (all_docs[k] or 0) / max(1, all_docs["n"] or 0))) for k in KINDS}
    for k in KINDS:
        hosts = hosts.withColumn(f"share_{k}", F.col(f"host_bad_{k}") / F.col("n_host"))
    hosts = stage(hosts)
    for k in KINDS:
        s = strength(hosts, f"share_{k}", "n_host", F.lit(centre[k]))
        hosts = hosts.withColumn(f"host_{k}", (F.col(f"host_bad_{k}") + s * centre[k]) / (F.col("n_host") + s))
    sites = stage(paths.join(hosts.withColumnRenamed("host", "site"), F.col("host").eqNullSafe(F.col("site"))).drop("site"))
    for k in KINDS:
        sites = sites.withColumn("share", F.col(f"bad_{k}") / F.col("n"))
        s = strength(sites, "share", "n", F.col(f"host_{k}"))
        rate = (F.col(f"bad_{k}") + s * F.col(f"host_{k}")) / (F.col("n") + s)
        sites = sites.withColumn(f"path_{k}", F.least(F.lit(0.999), F.greatest(F.lit(1e-4), rate)))
    sites = stage(sites.select(F.col("host").alias("site"), F.col("path").alias("part"), *[f"{x}_{k}" for k in KINDS for x in ("host", "path")]))
    out = scored.join(few(sites, 20_000), F.col("host").eqNullSafe(F.col("site")) & F.col("path").eqNullSafe(F.col("part")))
    for k in KINDS:
        out = out.withColumn(f"p_{k}", posterior(f"llr_{k}", F.col(f"path_{k}")))
    return out.select("id", "host", "path", *[c for k in KINDS for c in (f"llr_{k}", f"host_{k}", f"path_{k}", f"p_{k}")], ((F.col("p_low") < limit) & (F.col("p_toxic") < limit)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The input rows, all columns as they are, without documents that ``classify`` rejects. Rows that share an id go together; rows without one stay."""
    return without(docs, id_col, classify(docs, labels, id_col, **how).where("NOT kept").select("id"))
