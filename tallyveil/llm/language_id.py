"""Language identification, word first, with backoff to character n-grams.

Training takes a sample of labelled rows of each language, bounded in rows and
characters, and counts every word of it by language in one distributed
aggregation; n-grams are counted over the different words of each language, so
that frequent words don't drown the rest. All that the sample holds is kept:
the bounds of the sample bound the model, which is broadcast. A word that
training has not seen is scored by n-grams: at each of its places by the
longest known one, from `longest` letters down to one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import staged

#: Runs of letters (and numerals that aren't decimal digits); case is folded first.
WORD = re.compile(r"[^\W\d_]+")
LONGEST = 5
#: Rows and characters of each language that training takes, about.
MOST_ROWS = 5_000
MOST_CHARACTERS = 20_000_000
#: Distinct keys that a task holds before it passes its counts on.
FLUSH = 400_000
UNKNOWN = "und"
SMOOTH = 1.0
#: Words after which more text no longer sharpens the score.
ENOUGH = 20


def held_out(id_col: str) -> Column:
    """Rows that no model here learns from: CRC-32 of the id as text leaves 1 when divided by 3; null ids are held out too."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(True))


def grams_of(word: str, longest: int = LONGEST) -> list[str]:
    """All n-grams of the word between its marks, up to `longest` characters."""
    marked = f"<{word}>"
    return [marked[i : i + n] for n in range(1, longest + 1) for i in range(len(marked) - n + 1)]


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, Counter] = {}

    def flush() -> pd.DataFrame:
        rows = [(lang, word, n) for lang, c in counts.items() for word, n in c.items()]
        counts.clear()
        return pd.DataFrame(rows, columns=["lang", "word", "n"])

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            counts.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
            if sum(map(len, counts.values())) > FLUSH:
                yield flush()
    yield flush()


def _gram_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, Counter] = {}

    def flush() -> pd.DataFrame:
        rows = [(lang, gram, n) for lang, c in counts.items() for gram, n in c.items()]
        counts.clear()
        return pd.DataFrame(rows, columns=["lang", "gram", "n"])

    for batch in batches:
        for lang, word in zip(batch["lang"], batch["word"], strict=True):
            counts.setdefault(lang, Counter()).update(grams_of(word))
        if sum(map(len, counts.values())) > FLUSH:
            yield flush()
    yield flush()


@dataclass
class Logs:
    """Log frequencies of keys by language, kept for the languages only in which a key occurs.

    A key's frequency is smoothed by SMOOTH draws from all languages together.
    Where it doesn't occur, its log is that of the smoothing less the log of
    the language's size: the first part is the same for all languages and left
    out, the second is one number for each kind of key (words, n-grams of one
    length) and language. So memory grows with what was counted.
    """

    starts: np.ndarray
    langs: np.ndarray
    gains: np.ndarray
    kinds: np.ndarray
    sizes: np.ndarray

    def add(self, total: np.ndarray, places: np.ndarray, weights: np.ndarray) -> None:
        """Adds the keys' logs, by weight, to a total for each language."""
        first = self.starts[places]
        many = self.starts[places + 1] - first
        at = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
        total += np.bincount(self.langs[at], self.gains[at] * np.repeat(weights, many), len(total))
        total -= np.bincount(self.kinds[places], weights, len(self.sizes)) @ self.sizes


@dataclass
class LanguageModel:
    """Languages in order of code points, and log frequencies by language of known words and n-grams."""

    langs: list[str]
    words: dict[str, int]
    word_logs: Logs
    grams: dict[str, int]
    gram_logs: Logs

    def unseen(self, word: str) -> list[int]:
        """At every place of the word between its marks the longest known n-gram; a place without any is left out."""
        marked, grams, out = f"<{word}>", self.grams, []
        for i in range(len(marked)):
            for n in range(LONGEST, 0, -1):
                at = grams.get(marked[i : i + n])
                if at is not None:
                    out.append(at)
                    break
        return out

    def totals(self, words: list[str]) -> np.ndarray:
        """Sums of logs by language: a known word's own, an unseen word's mean over its places."""
        total = np.zeros(len(self.langs))
        known = [at for at in map(self.words.get, words) if at is not None]
        if known:
            self.word_logs.add(total, np.array(known), np.ones(len(known)))
        if len(known) < len(words):
            places: list[int] = []
            weights: list[float] = []
            for word, n in Counter([w for w in words if w not in self.words]).items():
                found = self.unseen(word)
                places += found
                weights += [n / (len(word) + 2)] * len(found)
            if places:
                self.gram_logs.add(total, np.array(places), np.array(weights))
        return total

    def predict(self, texts: pd.Series) -> pd.DataFrame:
        langs, scores = [], []
        for text in texts:
            words = WORD.findall(text.lower()) if text else []
            if not self.langs or not any(any(map(str.isalpha, w)) for w in words):
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            total = self.totals(words)
            best = int(np.argmax(total))
            share = np.exp((total - total[best]) * min(1.0, ENOUGH / len(words)))
            langs.append(self.langs[best])
            scores.append(float(1 / share.sum()))
        return pd.DataFrame({"lang_pred": langs, "score": scores})


def _sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, most_rows: int, most_characters: int) -> DataFrame:
    """(lang, text) of rows chosen by a hash of id and text, so many of each language that neither bound is expected to be passed.

    Rows that repeat both count once: they would be taken or left together.
    """
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), F.col(text_col), F.lit("sample")).alias("h")).dropna(subset=["lang", "text"])
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("text")).alias("characters"))
    share = F.least(F.lit(1.0), F.lit(most_rows) / F.col("rows"), F.lit(most_characters) / F.greatest("characters", F.lit(1)))
    shares = staged(sizes.select("lang", share.alias("share")), "language-shares")
    taken = rows.join(F.broadcast(shares), "lang").filter(F.pmod("h", F.lit(1 << 30)) < F.col("share") * (1 << 30))
    return taken.dropDuplicates(["lang", "h"]).select("lang", "text")


def _log_frequencies(counts: DataFrame, key: str, langs: list[str], kind: Column, kinds: int) -> tuple[dict[str, int], Logs]:
    """Places of the keys of counts (key, lang, n), and their logs; kind: from 0 to kinds - 1, keys of one kind share a language's size."""
    at = {lang: i for i, lang in enumerate(langs)}
    lists = counts.groupBy(key).agg(F.collect_list("lang").alias("langs"), F.collect_list("n").alias("n")).withColumn("kind", kind)
    table = lists.select(key, "langs", "n", "kind").toArrow().combine_chunks()
    keys = table.column(0).to_pylist()
    own = table.column(1).combine_chunks()
    coded = own.flatten().dictionary_encode()
    codes = np.array([at[x] for x in coded.dictionary.to_pylist()], dtype=np.int32)
    langs_of = codes[coded.indices.to_numpy(zero_copy_only=False)] if len(keys) else np.empty(0, np.int32)
    n = table.column(2).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float)
    many = np.diff(own.offsets.to_numpy()) if len(keys) else np.empty(0, np.int64)
    kind_of = table.column(3).to_numpy().astype(np.int8)
    owner = np.repeat(np.arange(len(keys)), many)
    sums = np.zeros((kinds, len(langs)))
    np.add.at(sums, (kind_of[owner], langs_of), n)
    common = np.bincount(owner, n, len(keys)) / np.maximum(1.0, sums.sum(axis=1))[kind_of]
    smoothing = SMOOTH * common[owner]
    starts = np.concatenate([[0], np.cumsum(many)]).astype(np.int64)
    return {k: i for i, k in enumerate(keys)}, Logs(starts, langs_of, np.log((n + smoothing) / smoothing).astype(np.float32), kind_of, np.log(sums + SMOOTH))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *, most_rows: int = MOST_ROWS, most_characters: int = MOST_CHARACTERS) -> LanguageModel:
    """Learns from about most_rows rows and most_characters characters of each language; without rows that have text and language the model knows no language."""
    rows = _sample(docs, id_col, text_col, lang_col, most_rows, most_characters)
    counted = rows.mapInPandas(_word_counts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = staged(counted, "word-counts")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    words, word_logs = _log_frequencies(counts, "word", langs, F.lit(0), 1)
    grams = staged(counts.mapInPandas(_gram_counts, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "gram-counts")
    known, gram_logs = _log_frequencies(grams, "gram", langs, F.length("gram") - 1, LONGEST)
    return LanguageModel(langs, words, word_logs, known, gram_logs)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, lang_pred, score.

    lang_pred is the language with the highest sum of log frequencies over all
    words (ties: the first by code point), score its share among the languages,
    with the sum scaled down to ENOUGH words for longer texts. Null texts and
    texts without a letter are `und` with score 0. Other columns play no part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = shared.value.predict(batch["text"])
            out.insert(0, "id", batch["id"])
            yield out

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInPandas(run, "id string, lang_pred string, score double")
    return out.select(F.col("id").cast(kind).alias(id_col), "lang_pred", "score")


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learns from the rows that aren't held out and predicts all: id, held_out, lang_pred, score."""
    model = fit(docs.filter(~held_out(id_col)), id_col, text_col, lang_col)
    return predict(docs, model, id_col, text_col).select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score")
