"""Document quality by pairwise ranking (Bradley-Terry).

A document's score is linear in features of its whole text: shares of kinds of
characters, lengths, and the shares of words by their hash, so that words tell
good documents from bad ones too. The weights come from preference pairs, a document marked good against one marked bad, by
logistic loss on the differences of their features. A document passes when its
score is at or above a quantile of the labelled scores.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .language_id import held_out
from .scratch import staged

#: Labelled rows that the fit may gather, chosen by a hash of the id.
MOST_LABELS = 20_000
#: Preference pairs drawn from them.
PAIRS = 40_000
#: Buckets into which words are hashed.
BUCKETS = 128
#: Penalties of the weights of features and of buckets.
PENALTY, BUCKET_PENALTY = 1e-3, 1e-2


def features(text: Column) -> dict[str, Column]:
    """Shares and lengths of a text, all Spark functions; an empty text has zeros.

    Words are what white space divides. Shares enter as square roots, so that
    small but telling shares count.
    """
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    words = F.greatest(F.size("w"), F.lit(1)).cast("double")
    without = lambda pattern: F.length(text) - F.length(F.regexp_replace(text, pattern, ""))
    literal = lambda mark: F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))
    return {
        "length": F.log1p(F.length(text).cast("double")),
        "symbols": F.sqrt(without(r"[#&$%*~^=<>{}\[\]\\_@+]+") / n),
        "bars": F.sqrt(literal("|") / words),
        "capitals": F.sqrt(without(r"\p{Lu}+") / n),
        "shouts": F.sqrt(literal("!") / words),
        "digits": F.sqrt(without("[0-9]+") / n),
        "stops": F.sqrt(literal(".") / words),
        "commas": F.sqrt(literal(",") / words),
        "distinct": F.log1p(F.size(F.array_distinct("w")).cast("double")) / F.log1p(words),
        "word_length": F.log1p(n / words),
    }


def bucket(word: Column) -> Column:
    """The bucket of a word, from 0 on."""
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def word_score(weights: list[float]) -> Column:
    """The mean weight of the words' buckets."""
    if not any(weights):
        return F.lit(0.0)
    table = F.array(*map(F.lit, weights))
    total = F.aggregate("w", F.lit(0.0), lambda s, x: s + F.get(table, bucket(x)))
    return total / F.greatest(F.size("w"), F.lit(1))


def _read(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """id, t (text, null as empty), w (words in lower case)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("t"), F.split(F.lower(text), r"\s+").alias("w"), *more)


def _featured(docs: DataFrame, id_col: str, text_col: str, *more: Column, words: Column | None = None) -> DataFrame:
    rows = _read(docs, id_col, text_col, *more)
    return rows.select("id", *[c.alias(f"f_{k}") for k, c in features(F.col("t")).items()], (F.lit(0.0) if words is None else words).alias("f_words"), *[F.col(c) for c in rows.columns[3:]])


def bucket_shares(docs: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """id, shares: of each document's words the share in each bucket, BUCKETS numbers."""
    each = _read(docs, id_col, text_col).select("id", F.size("w").alias("n"), F.explode("w").alias("x")).groupBy("id", "n", bucket(F.col("x")).alias("b")).agg(F.count(F.lit(1)).alias("m"))
    lists = each.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("b", F.col("m") / F.col("n")))).alias("of"))
    return lists.select("id", F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.coalesce(F.try_element_at("of", b), F.lit(0.0))).alias("shares"))


@dataclass
class QualityModel:
    """Weights of the features and the score from which a document passes."""

    weights: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.0
    words: list[float] = field(default_factory=list)

    def score(self) -> Column:
        """From 0 to 1; 0.5 at the threshold."""
        total = sum((F.col(f"f_{k}") * F.lit(w) for k, w in self.weights.items()), F.col("f_words"))
        return 1 / (1 + F.exp(-(total - F.lit(self.threshold))))


def bradley_terry(better: np.ndarray, worse: np.ndarray, penalty: float | np.ndarray = PENALTY, steps: int = 30) -> np.ndarray:
    """Weights that minimise the mean of log(1 + exp(-(better - worse) w)) + penalty w w / 2, by Newton's method; a penalty for all or for each weight."""
    x = better - worse
    w = np.zeros(x.shape[1])
    penalty = np.broadcast_to(penalty, w.shape)
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(x @ w, -30, 30)))
        slope = -x.T @ p / len(x) + penalty * w
        bend = (x * (p * (1 - p))[:, None]).T @ x / len(x) + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-10:
            break
    return w


def quantile_threshold(scores: np.ndarray, good: np.ndarray) -> float:
    """The score quantile with the best mean of the two classes' hit rates; in the middle where several are best."""
    cuts = np.quantile(scores, np.linspace(0, 1, 401))
    rates = np.array([((scores >= c) & good).sum() / good.sum() + ((scores < c) & ~good).sum() / (~good).sum() for c in cuts])
    return float(cuts[rates >= rates.max() - 1e-9].mean())


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", *, most_labels: int = MOST_LABELS, pairs: int = PAIRS, seed: int = 7) -> QualityModel:
    """Learns from at most most_labels labelled rows that aren't held out.

    Null labels and ids play no part; a repeated id counts once, with its
    largest label and its least text, whatever its copies. Without both kinds of labels nothing is learned, and every
    document scores 0.5.
    """
    usable = labels.select(F.col(id_col).alias("lid"), F.col(label_col).alias("label")).dropna().filter(~held_out("lid"))
    chosen = usable.groupBy("lid").agg(F.max("label").alias("label")).orderBy(F.xxhash64("lid"), "lid").limit(most_labels)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("lid"))
    sample = staged(rows.groupBy("id", "label").agg(F.coalesce(F.min("text"), F.lit("")).alias("text")), "quality-sample")
    names = list(features(F.col("t")))
    plain = _featured(sample, "id", "text", F.col("label").alias("label")).drop("f_words")
    table = plain.join(bucket_shares(sample), "id").orderBy("id").drop("id").toArrow()  # at most one row for each chosen id
    good = table.column("label").to_numpy() > 0.5
    if good.all() or not good.any():
        return QualityModel()
    shares = np.stack(table.column("shares").to_numpy())
    x = np.concatenate([np.stack([table.column(f"f_{k}").to_numpy() for k in names], axis=1), shares], axis=1)
    spread = x.std(axis=0)
    spread[spread < 1e-9] = np.inf
    z = x / spread
    rng = np.random.default_rng(seed)
    penalty = np.array([PENALTY] * len(names) + [BUCKET_PENALTY] * BUCKETS)
    w = bradley_terry(z[good][rng.integers(0, good.sum(), pairs)], z[~good][rng.integers(0, (~good).sum(), pairs)], penalty)
    of = (w / spread).tolist()
    return QualityModel(dict(zip(names, of, strict=False)), quantile_threshold(z @ w, good), of[len(names) :])


def scored(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, score, predicted (1 if score >= 0.5). Null text counts as empty."""
    out = _featured(docs, id_col, text_col, words=word_score(model.words)).select(F.col("id").alias(id_col), model.score().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learns from labels that aren't held out and scores all: id, held_out, score, predicted."""
    return scored(docs, fit(docs, labels, id_col, text_col), id_col, text_col).select(id_col, held_out(id_col).alias("held_out"), "score", "predicted")


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that the classifier passes, with all their columns, whatever their names.

    Null texts are judged as empty ones; repeated rows pass or go together;
    without labels of both kinds every row passes; an empty table gives no rows.
    """
    model = fit(docs, labels, id_col, text_col)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return _featured(docs, id_col, text_col, row, words=word_score(model.words)).filter(model.score() >= 0.5).select("row.*")
