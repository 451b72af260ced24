"""Toxic documents by a lexicon that also finds misspelled terms, and by the context of what it finds.

Lexicon: a short list of insults, and terms learned from labelled documents, as
whole words or as stems (any word that begins with them). A learned term is far
more frequent in documents marked toxic and stands in contexts of its own, so
words of a passage that is copied a thousand times don't become terms.

Matching: the terms are a trie. The Levenshtein automaton of a word runs in step
with the trie: a state is a set of (trie node, edits so far), and sets that have
been met are kept with their transitions, so that a word costs one lookup a
letter and most words die after a few. Swapped neighbours count as one edit.

Context: every hit gets a score from its window (quotation marks, words that
report speech or name a word, words that address somebody, other hits), and a
document gets its score from those of its windows. Both are logistic models
that start from stated weights and move with the labels.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import staged

#: Labelled documents that the fit takes, chosen by a hash of the id; and hits, by a hash of id and place.
MOST_LABELS = 20_000
MOST_HITS = 40_000
#: Insults known without labels, fixed values; labels can show one to be harmless.
BASE = (
    "asshole", "bastard", "bitch", "clown", "creep", "cretin", "cunt", "degenerate", "disgusting", "dumbass", "fuck", "fucking", "garbage", "idiot", "idiotic", "imbecile",
    "jerk", "loser", "lowlife", "moron", "moronic", "pathetic", "pig", "retard", "scum", "scumbag", "shit", "slut", "stupid", "subhuman", "trash", "vermin", "whore", "worthless",
)
BASE_WEIGHT = 3.0
#: Lengths of a stem; a learned term's least documents, share of toxic ones, log likelihood ratio and contexts of its own.
STEM = range(3, 9)
MIN_DOCS, MIN_SHARE, MIN_RATIO, MIN_CONTEXTS = 4, 0.5, 22.0, 4
#: A longer stem or word replaces a stem when it covers so much of it.
COVER = 0.75
#: Clean documents from which on a word is an ordinary one, which is no misspelled term.
ORDINARY = 2
#: Words, letters and digits, with marks inside that stand for letters.
TOKEN = re.compile(r"[@$]?[^\W_]+(?:[@$*!]+[^\W_]+)*")
LETTERS_FOR = str.maketrans("01345789@$!", "oieastbgasi")
#: Window of a hit: words before and after it; characters in which quotation marks are sought.
NEAR, AROUND = 8, 300
#: Words that report speech or name a word, and words that address somebody, fixed values.
REPORTING = frozenset("said says say told called calls calling wrote writes written quoted quote quotes word words term terms insult insults slur phrase means meaning definition defined reads sagte nannte schrieb zitat wort dit appelé écrit mot citation dijo llamó escribió palabra cita".split())
ADDRESS = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti eres usted ustedes vos".split())
OPEN_MARKS, CLOSE_MARKS = "“«„‘", "”»“’"
#: Starting weights of a window: constant, quoted, reported, addressed, other hits, misspelled, stem, term weight.
WINDOW_START = np.array([0.0, -2.5, -1.0, 0.8, 0.8, -2.5, -0.3, 0.5])
#: Starting weights of a document: constant, sum of windows, largest window, share of words, different terms.
DOCUMENT_START = np.array([-3.0, 1.0, 4.0, 1.0, 1.0])
PULL = 1.0
#: Words and automaton states that a task keeps ready; what isn't kept is computed again.
MEMO, STATES = 300_000, 100_000
WORD, STEM_HIT, MISSPELLED = 0, 1, 2


def held_out(id_col: str) -> Column:
    """Rows that no model here learns from: CRC-32 of the id as text leaves 0 when divided by 5; null ids are held out too."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


def edits_of(term: str) -> int:
    """Edits that a misspelled form of a term may have."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


def plain(token: str) -> str:
    """A token with marks and digits read as the letters that they stand for; empty if it has no letter."""
    return token if token.isalpha() else token.translate(LETTERS_FOR) if any(map(str.isalpha, token)) else ""


@dataclass(frozen=True)
class Term:
    text: str
    stem: bool = False
    weight: float = BASE_WEIGHT


class _State:
    """Trie nodes with edits so far, the stem that the word began with, the best match if the word ends here."""

    __slots__ = ("found", "live", "next", "over", "stem")

    def __init__(self, live: dict, stem: int | None, found: tuple[int, int, int] | None) -> None:
        self.live, self.stem, self.found, self.next, self.over = live, stem, found, {}, not live


class Automaton:
    """All terms' Levenshtein automata on one trie; states are made when a word first reaches them."""

    def __init__(self, terms: Sequence[Term]) -> None:
        self.kids: list[dict[str, int]] = [{}]
        self.words: dict[int, int] = {}
        self.stems: dict[int, int] = {}
        self.room = [0]
        for i, term in enumerate(terms):
            at, room = 0, 0 if term.stem else edits_of(term.text)
            self.room[0] = max(self.room[0], room)
            for c in term.text:
                if c not in self.kids[at]:
                    self.kids[at][c] = len(self.kids)
                    self.kids.append({})
                    self.room.append(0)
                at = self.kids[at][c]
                self.room[at] = max(self.room[at], room)
            (self.stems if term.stem else self.words)[at] = i
        self.bounds = [0 if t.stem else edits_of(t.text) for t in terms]
        self.letters = {c for kids in self.kids for c in kids}
        self._restart()

    def _restart(self) -> None:
        self.states: dict[tuple, _State] = {}
        self.root = self._state(self._closed({(0, ""): 0}), None)

    def _closed(self, live: dict) -> dict:
        """With what is reached by leaving out letters of a term."""
        todo = list(live)
        while todo:
            node, wanted = todo.pop()
            edits = live[node, wanted] + 1
            for kid in () if wanted else self.kids[node].values():
                if edits <= self.room[kid] and edits < live.get((kid, ""), 99):
                    live[kid, ""] = edits
                    todo.append((kid, ""))
        return live

    def _state(self, live: dict, stem: int | None) -> _State:
        key = (frozenset(live.items()), stem)
        if key not in self.states:
            ends = [(WORD if e == 0 else MISSPELLED, e, self.words[n]) for (n, wanted), e in live.items() if not wanted and n in self.words and e <= self.bounds[self.words[n]]]
            if stem is not None:
                ends.append((STEM_HIT, 0, stem))
            self.states[key] = _State(live, stem, min(ends, default=None))
        return self.states[key]

    def _step(self, state: _State, c: str) -> _State:
        live: dict = {}

        def reach(node: int, edits: int, wanted: str = "") -> None:
            if edits <= self.room[node] and edits < live.get((node, wanted), 99):
                live[node, wanted] = edits

        for (node, wanted), edits in state.live.items():
            if wanted:
                if c == wanted:
                    reach(node, edits)
                continue
            kids = self.kids[node]
            if c in kids:
                reach(kids[c], edits)
            if edits < self.room[node]:
                reach(node, edits + 1)
                for letter, kid in kids.items():
                    reach(kid, edits + 1)
                    if letter != c and c in self.kids[kid]:
                        reach(self.kids[kid][c], edits + 1, letter)
        stem = next((self.stems[n] for (n, wanted), e in live.items() if e == 0 and not wanted and n in self.stems), None)
        return self._state(self._closed(live), stem if stem is not None else state.stem)

    def find(self, word: str) -> tuple[int, int, int] | None:
        """(kind, edits, term) of the best match of the whole word: a term itself, else a stem, else the fewest edits."""
        if len(self.states) > STATES:
            self._restart()
        state = self.root
        for c in word:
            if state.over:
                break
            after = state.next.get(c)
            if after is None:
                known = c if c in self.letters else ""
                after = state.next.get(known)
                if after is None:
                    after = state.next[known] = self._step(state, known)
            state = after
        return state.found


@dataclass
class Model:
    terms: list[Term] = field(default_factory=list)
    ordinary: frozenset[str] = frozenset()
    window: np.ndarray = field(default_factory=lambda: WINDOW_START)
    document: np.ndarray = field(default_factory=lambda: DOCUMENT_START)


class Reader:
    """Finds the hits of texts; one for each task."""

    def __init__(self, terms: Sequence[Term], ordinary: frozenset[str] = frozenset()) -> None:
        self.terms, self.ordinary, self.automaton = terms, ordinary, Automaton(terms)
        self.memo: dict[str, tuple[int, int, int] | None] = {}

    def look(self, token: str) -> tuple[int, int, int] | None:
        memo = self.memo
        if token in memo:
            return memo[token]
        found = self.automaton.find(plain(token))
        if found and found[0] != WORD and token in self.ordinary:
            found = None
        if len(memo) < MEMO:
            memo[token] = found
        return found

    def hits(self, text: str | None) -> tuple[list[tuple[int, int, int, int, tuple[int, int, int]]], list[str], str]:
        """(place, start, end, other hits near, match) of every hit, all words, and the text in lower case."""
        low = (text or "").lower()
        words = TOKEN.findall(low)
        found = {w: m for w in set(words) if (m := self.look(w))}
        if not found:
            return [], words, low
        spans = [(i, m.start(), m.end(), found[m[0]]) for i, m in enumerate(TOKEN.finditer(low)) if m[0] in found]
        out, first, last = [], 0, 0
        for i, start, end, match in spans:
            while spans[first][0] < i - NEAR:
                first += 1
            while last < len(spans) and spans[last][0] <= i + NEAR:
                last += 1
            out.append((i, start, end, last - first - 1, match))
        return out, words, low

    def windows(self, text: str | None) -> tuple[np.ndarray, list[int], int]:
        """A row of features for each hit, the hits' terms, and the number of words."""
        hits, words, low = self.hits(text)
        rows = np.zeros((len(hits), len(WINDOW_START)))
        for row, (i, start, end, others, (kind, _, term)) in zip(rows, hits, strict=True):
            near = words[max(0, i - NEAR) : i + NEAR + 1]
            row[:] = (1, quoted(low, start, end), not REPORTING.isdisjoint(near), not ADDRESS.isdisjoint(near), math.log1p(others), kind == MISSPELLED, kind == STEM_HIT, self.terms[term].weight / 4)
        return rows, [h[4][2] for h in hits], len(words)


def quoted(text: str, start: int, end: int) -> bool:
    """Whether a place is between quotation marks of its line, no further than AROUND characters."""
    before, after = text[max(0, start - AROUND) : start].rpartition("\n")[2], text[end : end + AROUND].partition("\n")[0]
    if before.count('"') % 2 and '"' in after:
        return True
    if before[-1:] == "'" and after[:1] == "'":
        return True
    opened = max(map(before.rfind, OPEN_MARKS))
    closed = max(before.rfind(c) for c in CLOSE_MARKS if c not in OPEN_MARKS)
    return opened > closed and any(c in after for c in CLOSE_MARKS)


def chance(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))


def logistic(rows: np.ndarray, label: np.ndarray, start: np.ndarray, pull: float = PULL, steps: int = 30) -> np.ndarray:
    """Weights with the least sum of log loss and pull |weights - start|^2 / 2, by Newton's method; a step that doesn't lower the sum is halved."""

    def loss(w: np.ndarray) -> float:
        x = rows @ w
        return float((np.logaddexp(0, x) - label * x).sum() + pull * ((w - start) ** 2).sum() / 2)

    w = start.copy()
    for _ in range(steps):
        p = chance(rows, w)
        slope = rows.T @ (p - label) + pull * (w - start)
        bend = (rows * (p * (1 - p))[:, None]).T @ rows + pull * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-12:
            step = step / 2
        w = w - step
    return w


def document_row(windows: np.ndarray, terms: list[int], words: int, weights: np.ndarray) -> tuple[float, ...]:
    p = chance(windows, weights)
    if not len(p):
        return (1.0, 0.0, 0.0, 0.0, 0.0)
    return (1.0, math.log1p(p.sum()), float(p.max()), math.sqrt(p.sum() / words), math.log1p(len({t for t, q in zip(terms, p, strict=True) if q >= 0.5})))


def _keys(word: str) -> list[tuple[str, bool]]:
    """A word and its stems."""
    return [(word, False), *((word[:n], True) for n in STEM if n < len(word))]


def _words(text: str) -> list[str]:
    return [w for t in TOKEN.findall(text.lower()) if (w := plain(t))]


def _counted(sample: DataFrame, label: int, among: frozenset | None = None) -> DataFrame:
    """key, stem, n: documents with the label that have a word or stem; only of the given ones."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()

        def flush() -> pd.DataFrame:
            out = pd.DataFrame([(k, s, n) for (k, s), n in counts.items()], columns=["key", "stem", "n"])
            counts.clear()
            return out

        for batch in batches:
            for text in batch["text"]:
                keys = {k for w in set(_words(text)) for k in _keys(w)}
                counts.update(keys if among is None else keys & among)
                if len(counts) > MEMO:
                    yield flush()
        yield flush()

    return sample.filter(F.col("label") == label).select("text").mapInPandas(run, "key string, stem boolean, n long").groupBy("key", "stem").agg(F.sum("n").alias("n"))


def _contexts(sample: DataFrame, among: frozenset) -> DataFrame:
    """key, stem, own: neighbours of a key in toxic documents, counted where both differ from its most frequent ones."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                words = ["", *_words(text), ""]
                out += [(*k, words[i - 1], words[i + 1]) for i in range(1, len(words) - 1) for k in _keys(words[i]) if k in among]
            yield pd.DataFrame(out, columns=["key", "stem", "before", "after"])

    found = sample.filter("label = 1").select("text").mapInPandas(run, "key string, stem boolean, before string, after string")
    found = staged(found.groupBy("key", "stem", "before", "after").count(), "contexts")
    usual = found.groupBy("key", "stem").agg(F.max_by("before", F.struct("count", "before", "after")).alias("b"), F.max_by("after", F.struct("count", "before", "after")).alias("a"))
    other = found.join(usual, ["key", "stem"]).filter("before <> b AND after <> a")
    return other.groupBy("key", "stem").agg(F.count_distinct("before").alias("before"), F.count_distinct("after").alias("after")).select("key", "stem", (F.least("before", "after") + 1).alias("own"))


def ratio(toxic: int, clean: int, of_toxic: int, of_clean: int) -> float:
    """Log likelihood ratio (Dunning) of a key's documents by label against the labels' shares; 0 where it is not more frequent in toxic ones."""
    share, n = of_toxic / (of_toxic + of_clean), toxic + clean
    if not n or toxic / n <= share:
        return 0.0
    return 2 * sum(k * math.log(k / (n * p)) for k, p in ((toxic, share), (clean, 1 - share)) if k and p)


def chosen_terms(counts: dict[tuple[str, bool], tuple[int, int]], of_toxic: int, of_clean: int) -> list[Term]:
    """Of learned keys (with toxic and clean documents) those that cover the rest: from each shortest stem on to longer ones while they cover as much."""
    longer: dict[str, list[tuple[str, bool]]] = {}
    for key, stem in counts:
        for n in STEM:
            if n < len(key) + (not stem):
                longer.setdefault(key[:n], []).append((key, stem))
    out, done = [], set()
    for key in sorted(counts, key=lambda k: (len(k[0]), k)):
        if key in done:
            continue
        at = key
        while at[1]:
            ahead = [k for k in longer.get(at[0], []) if k != at and counts[k][0] >= COVER * counts[at][0]]
            if not ahead:
                break
            at = max(ahead, key=lambda k: (k[1], -len(k[0]), counts[k][0], k)) if any(k[1] for k in ahead) else max(ahead, key=lambda k: (counts[k][0], k))
        done.add(at)
        if key[1]:
            done.update(k for k in longer.get(key[0], []))
        toxic, clean = counts[at]
        out.append(Term(at[0], at[1], min(8.0, max(1.0, math.log((toxic + 0.5) / (of_toxic + 1)) - math.log((clean + 0.5) / (of_clean + 1))))))
    return out


def _rows_of(df: DataFrame) -> list:
    return [tuple(r) for r in df.collect()]


def _lexicon(sample: DataFrame, of_toxic: int, of_clean: int, base: Sequence[str]) -> list[Term]:
    many = _counted(sample, 1).filter(F.col("n") >= MIN_DOCS)
    toxic = {(k, s): n for k, s, n in _rows_of(many)}
    wanted = frozenset(toxic) | {(b, False) for b in base}
    clean = {(k, s): n for k, s, n in _rows_of(_counted(sample, 0, wanted))}
    telling = {k: (n, clean.get(k, 0)) for k, n in toxic.items() if n >= MIN_SHARE * (n + clean.get(k, 0)) and ratio(n, clean.get(k, 0), of_toxic, of_clean) >= MIN_RATIO}
    if telling:
        own = {(k, s): n for k, s, n in _rows_of(_contexts(sample, frozenset(telling)))}
        telling = {k: v for k, v in telling.items() if own.get(k, 0) >= MIN_CONTEXTS}
    learned = chosen_terms(telling, of_toxic, of_clean)
    known = {t.text for t in learned if not t.stem}
    harmless = {b for b in base if clean.get((b, False), 0) >= MIN_DOCS and ratio(toxic.get((b, False), 0), clean[b, False], of_toxic, of_clean) == 0}
    return sorted([*learned, *(Term(b) for b in base if b not in known and b not in harmless)], key=lambda t: (t.text, t.stem))


def _ordinary(sample: DataFrame, terms: list[Term]) -> frozenset[str]:
    """Words that match a term by a stem or with edits, and are as frequent in clean documents as elsewhere."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, counts = Reader(terms), Counter()
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                counts.update((w, label) for w in set(TOKEN.findall(text.lower())) if (m := reader.look(w)) and m[0] != WORD)
        yield pd.DataFrame([(w, y == 0, n) for (w, y), n in counts.items()], columns=["word", "clean", "n"])

    found = sample.select("text", "label").mapInPandas(run, "word string, clean boolean, n long").groupBy("word").agg(F.sum(F.when(F.col("clean"), F.col("n")).otherwise(0)).alias("clean"), F.sum("n").alias("n"))
    return frozenset(r["word"] for r in found.filter((F.col("clean") >= ORDINARY) & (F.col("clean") * 2 >= F.col("n"))).select("word").collect())


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int) -> DataFrame:
    """id, text, label: one row for each of the chosen labelled ids, whatever its copies."""
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna().filter(~held_out("id"))
    ids = usable.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(most)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")  # ids are bounded by `most`
    return staged(rows.groupBy("id", "label").agg(F.coalesce(F.min("text"), F.lit("")).alias("text")), "toxicity-sample")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", *, most_labels: int = MOST_LABELS, most_hits: int = MOST_HITS, base: Sequence[str] = BASE) -> Model:
    """Learns from at most most_labels labelled documents that aren't held out.

    Null labels and ids play no part; a repeated id counts once, with its
    largest label and its least text. Without both kinds of labels the base
    terms and the starting weights stand.
    """
    sample = _sample(docs, labels, id_col, text_col, label_col, most_labels)
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model([Term(b) for b in base])
    terms = _lexicon(sample, sizes[1], sizes[0], base)
    ordinary = _ordinary(sample, terms)

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(terms, ordinary)
        for batch in batches:
            out = [(i, at, label, row.tolist()) for i, label, text in zip(batch["h"], batch["label"], batch["text"], strict=True) for at, row in enumerate(reader.windows(text)[0])]
            yield pd.DataFrame(out, columns=["h", "at", "label", "row"])

    hashed = sample.select(F.xxhash64("id").alias("h"), "label", "text")
    hits = _rows_of(hashed.mapInPandas(windows, "h long, at int, label int, row array<double>").orderBy(F.xxhash64("h", "at"), "h", "at").limit(most_hits).select("row", "label"))
    window = WINDOW_START
    if hits:
        window = logistic(np.array([r for r, _ in hits]), np.array([y for _, y in hits], dtype=float), WINDOW_START)

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(terms, ordinary)
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "row": [list(document_row(*reader.windows(t), window)) for t in batch["text"]]})

    rows = sorted(_rows_of(hashed.select("label", "text").mapInPandas(documents, "label int, row array<double>")))
    return Model(terms, ordinary, window, logistic(np.array([r for _, r in rows]), np.array([y for y, _ in rows], dtype=float), DOCUMENT_START))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, score, predicted (1 if score >= 0.5), n_hits, n_misspelled.

    Null and empty texts have no hits and the score of such documents; repeated
    rows give repeated results; an empty table gives no rows. Other columns
    play no part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        reader = Reader(m.terms, m.ordinary)
        for batch in batches:
            out = []
            for i, text in zip(batch["id"], batch["text"], strict=True):
                windows, terms, words = reader.windows(text)
                row = np.array([document_row(windows, terms, words, m.window)])
                out.append((i, float(chance(row, m.document)[0]), len(windows), int(windows[:, 5].sum())))
            yield pd.DataFrame(out, columns=["id", "score", "n_hits", "n_misspelled"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInPandas(run, "id string, score double, n_hits long, n_misspelled long")
    return out.select(F.col("id").cast(kind).alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_hits", "n_misspelled")


def hit_spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every hit: id, start and end (code points of the text in lower case), word, term, edits, abuse (0 to 1, the window's score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        reader = Reader(m.terms, m.ordinary)
        for batch in batches:
            out = []
            for i, text in zip(batch["id"], batch["text"], strict=True):
                abuse = chance(reader.windows(text)[0], m.window)
                hits, _, low = reader.hits(text)
                out += [(i, start, end, low[start:end], m.terms[term].text + "*" * m.terms[term].stem, edits, float(p)) for (_, start, end, _, (_, edits, term)), p in zip(hits, abuse, strict=True)]
            yield pd.DataFrame(out, columns=["id", "start", "end", "word", "term", "edits", "abuse"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInPandas(run, "id string, start int, end int, word string, term string, edits int, abuse double")
    return out.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learns from labels that aren't held out and scores all: id, held_out, score, predicted, n_hits, n_misspelled; cases as in `fit` and `scored`."""
    out = scored(docs, fit(docs, labels, id_col, text_col), id_col, text_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), "score", "predicted", "n_hits", "n_misspelled")
