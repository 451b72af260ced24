"""Personal data by candidate spans and boosted trees.

Base patterns with their exact checks always count. Beside them, generators
with high recall propose spans of each kind, overlapping ones too; gradient
boosted trees score every candidate by its format and context, and a threshold
for each kind, set on held-out candidates for a wanted precision, selects what
is redacted beyond the base.

No marked text is needed. Good examples are the corpus' own base spans,
rewritten in the ways in which people write such data past a pattern (`(at)`,
`[.]`, 00 or nothing for +, dots in card numbers), in their own context. Bad
examples are candidates that stay no base span even when such forms are undone.
No feature is a base check.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import staged
from .spans import SPAN, digest_columns, listed, matches, span

KINDS = ("email", "ip", "card", "phone")
#: Base patterns. Possessive repeats match what the plain ones do and need no stack. What can't begin a match behind
#: the like of its own characters (but behind a match) isn't tried there, or a long run would be read once from each place.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators: (kind, pattern). They propose more than they should.
PROPOSE = (
    ("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?:@|\x20?[(\[]at[)\]]\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)*+"),
    ("ip", r"(?<![0-9])[0-9]++(?:(?:\.|\[\.\]|\(\.\))[0-9]++){2,5}+"),
    ("card", r"[0-9](?:[\x20.-]?[0-9]){11,18}+"),
    ("phone", r"(?:\+|\(|\b00|\b)[0-9][\x20()./0-9-]{6,22}[0-9]"),
)
#: Characters of context on either side, and of the pieces of a text that it is taken from.
CONTEXT = 24
PIECE = 1024
PRECISION = 0.98
#: Steps of the scores that thresholds lie between.
STEPS = 10_000
FEATURES = ("size", "digits", "letters", "separators", "dots", "spaces", "dashes", "brackets", "round", "first_run", "last_run", "runs", "largest_run", "word_before", "word_after", "cue_email", "cue_ip", "cue_card", "cue_phone", "is_email", "is_ip", "is_card", "is_phone")
CUES = {"email": "(?i)mail|contact|@|write", "ip": "(?i)\\bip|host|addr|server", "card": "(?i)card|visa|pay|credit", "phone": "(?i)tel|phone|call|mobile|fax"}


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the last digit completes the sum that card numbers have; false for no digits."""
    places = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))

    def value(i: Column) -> Column:
        twice = (F.ascii(digits.substr(-i, F.lit(1))) - 48) * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.transform(places, value), F.lit(0), lambda a, x: a + x)
    return (F.length(digits) > 0) & (total % 10 == 0)


def _octets(hit: Column) -> Column:
    """Whether all parts between dots are at most 255; leading zeros don't count."""
    parts = F.transform(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & F.coalesce(p.try_cast("int") <= 255, F.lit(False)))


def holds(kind: str, hit: Column) -> Column:
    """Whether a match of the base pattern counts."""
    digits = F.length(digits_of(hit))
    return {"email": F.lit(True), "ip": _octets(hit), "card": digits.between(14, 19) & luhn(digits_of(hit)), "phone": digits.between(10, 15)}[kind]


def base_spans(text: Column) -> Column:
    """Sorted base spans of a text."""
    has = {"email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike("[0-9]"), "phone": text.rlike(r"\+[0-9]")}

    def of(place: int, kind: str) -> Column:
        good = F.filter(matches(text, BASE[kind]), lambda m: holds(kind, m["hit"]))
        return F.when(has[kind], F.transform(good, lambda m: span(place, kind, m["start"], m["end"]))).otherwise(F.array().cast(f"array<{SPAN}>"))

    return F.array_sort(F.concat(*[of(place, kind) for place, kind in enumerate(KINDS)]))


def undone(kind: Column, hit: Column) -> Column:
    """A candidate with the forms that hide it undone; what is in no such form is as it was."""
    at = F.regexp_replace(F.regexp_replace(hit, r"(?i)\x20?[(\[]at[)\]]\x20?", "@"), r"(?i)\x20?[(\[]dot[)\]]\x20?", ".")
    dotted = F.regexp_replace(hit, r"[(\[]\.[)\]]", ".")
    grouped = hit.rlike(r"^(?:00|[(]|[0-9]{1,3}[\x20-]?[(])") | hit.rlike(r"^[0-9]{1,4}(?:[\x20-][0-9]{2,4}){2,}$")
    called = F.when(hit.startswith("+") | hit.contains("."), hit).when(grouped, F.concat(F.lit("+"), F.regexp_replace(hit, r"^(?:00|[(])", "")))
    return F.when(kind == "email", at).when(kind == "ip", dotted).when(kind == "card", F.replace(hit, F.lit("."), F.lit(""))).otherwise(F.coalesce(called, hit))


def hidden(kind: Column, hit: Column) -> Column:
    """Array of the ways to write a base span past its pattern."""
    at = lambda a, dot: F.regexp_replace(F.regexp_replace(hit, "@", a), r"\.", dot)
    four = lambda mark: F.regexp_replace(digits_of(hit), r"([0-9]{4})(?=[0-9])", f"$1{mark}")
    email = F.array(at(" (at) ", " (dot) "), at("[at]", "."), at("(at)", "(dot)"))
    ip = F.array(F.regexp_replace(hit, r"\.", "[.]"), F.regexp_replace(hit, r"\.", "(.)"))
    phone = F.array(F.concat(F.lit("00"), F.substring(hit, 2, 99)), F.substring(hit, 2, 99), F.regexp_replace(hit, r"^\+[0-9]+\x20?", ""))
    return F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", F.array(four("."))).otherwise(phone)


def _passes(kind: Column, hit: Column) -> Column:
    """Whether all of hit passes its kind's base pattern and check."""
    out = F.lit(False)
    for k in KINDS:
        out = F.when(kind == k, hit.rlike(f"^(?:{BASE[k]})$") & holds(k, hit)).otherwise(out)
    return out


def _before(pieces: Column, at: Column) -> Column:
    """Up to CONTEXT characters in front of a place, from the two pieces of PIECE characters that hold them."""
    k = F.floor(at / PIECE).cast("int")
    near = F.concat(F.when(k > 0, F.get(pieces, k - 1)).otherwise(""), F.coalesce(F.get(pieces, k), F.lit("")))
    off = (at - F.greatest(k - 1, F.lit(0)) * PIECE).cast("int")
    return near.substr(F.greatest(off - CONTEXT, F.lit(0)) + 1, F.least(off, F.lit(CONTEXT)))


def _after(pieces: Column, at: Column) -> Column:
    k = F.floor(at / PIECE).cast("int")
    near = F.concat(F.coalesce(F.get(pieces, k), F.lit("")), F.coalesce(F.get(pieces, k + 1), F.lit("")))
    return near.substr((at - k * PIECE + 1).cast("int"), F.lit(CONTEXT))


def _below(values: Column, x: Column) -> Column:
    """How many of a sorted array's values are below x, by halving."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(values) + F.lit(1.0))).cast("int"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        less = F.coalesce(F.get(values, middle) < x, F.lit(False))
        return F.when(s["lo"] >= s["hi"], s).otherwise(F.struct(F.when(less, middle + 1).otherwise(s["lo"]).alias("lo"), F.when(less, s["hi"]).otherwise(middle).alias("hi")))

    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(values).alias("hi")), halve)["lo"]


def candidates(rows: DataFrame) -> DataFrame:
    """Proposed spans of rows (id, body, t): id, body, kind, place, start, end, hit, before, after, clear (of base spans).

    Work grows with a text's length but for a logarithm: context comes from
    pieces of the text, and base spans are met by halving.
    """

    def of(place: int, kind: str, pattern: str) -> Column:
        def one(m: Column) -> Column:
            meets = _below(F.col("starts"), m["end"]) - _below(F.col("ends"), m["start"] + 1)
            own = {"kind": F.lit(kind), "place": F.lit(place), "start": m["start"], "end": m["end"], "hit": m["hit"], "before": _before(F.col("pieces"), m["start"]), "after": _after(F.col("pieces"), m["end"]), "clear": meets == 0}
            return F.struct(*[c.alias(name) for name, c in own.items()])

        return F.transform(matches(F.col("t"), pattern), one)

    worth = rows.filter(F.contains("t", F.lit("@")) | F.col("t").rlike(r"[0-9]|[(\[](?i:at)[)\]]"))
    ends = lambda key: F.array_sort(F.transform("base", lambda s: s[key]))
    cut = worth.select("id", "body", "t", F.regexp_extract_all("t", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)).alias("pieces"), base_spans(F.col("t")).alias("base"))
    cut = cut.select("id", "body", "t", "pieces", ends("start").alias("starts"), ends("end").alias("ends"))
    return cut.select("id", "body", F.explode(F.concat(*[of(KINDS.index(k), k, p) for k, p in PROPOSE])).alias("c")).select("id", "body", "c.*")


def _best(selected: DataFrame) -> DataFrame:
    """id, body, more: of a text's selected candidates the best scored ones that overlap no better one.

    Candidates are taken in groups that overlap; those of different groups don't meet.
    """
    text = Window.partitionBy("id", "body").orderBy("start", "end")
    top = F.max("end").over(text.rowsBetween(Window.unboundedPreceding, -1))
    fresh = selected.select("id", "body", "start", "end", "place", "kind", "score", F.when(F.col("start") >= top, 1).otherwise(0).alias("new"))
    grouped = fresh.withColumn("group", F.sum("new").over(text.rowsBetween(Window.unboundedPreceding, 0)))
    option = F.struct((-F.col("score")).alias("cost"), "start", "place", "end", "kind")
    each = grouped.groupBy("id", "body", "group").agg(F.array_sort(F.collect_set(option)).alias("options"))

    def add(spans: Column, x: Column) -> Column:
        clear = ~F.exists(spans, lambda s: (s["start"] < x["end"]) & (x["start"] < s["end"]))
        one = F.struct(x["start"].alias("start"), x["place"].alias("place"), x["end"].alias("end"), x["kind"].alias("kind"))
        return F.when(clear, F.concat(spans, F.array(one))).otherwise(spans)

    some = each.select("id", "body", F.aggregate("options", F.array().cast(f"array<{SPAN}>"), add).alias("some"))
    return some.groupBy("id", "body").agg(F.flatten(F.collect_list("some")).alias("more"))


def _featured(found: DataFrame) -> DataFrame:
    """Adds FEATURES, which need kind, hit, before and after."""
    hit = F.col("hit")
    count = lambda pattern: F.length(hit) - F.length(F.regexp_replace(hit, pattern, ""))
    runs = F.transform(F.regexp_extract_all(hit, F.lit("[0-9]+"), F.lit(0)), lambda r: F.length(r))
    value = {
        "size": F.length(hit), "digits": count("[0-9]"), "letters": count(r"\p{L}"), "separators": count(r"[\x20./()-]"), "dots": count(r"\."), "spaces": count(r"\x20"), "dashes": count("-"),
        "brackets": count(r"[()\[\]]"), "round": count("[()]"), "first_run": F.coalesce(F.try_element_at(runs, F.lit(1)), F.lit(0)),
        "last_run": F.coalesce(F.try_element_at(runs, F.lit(-1)), F.lit(0)), "runs": F.size(runs), "largest_run": F.coalesce(F.array_max(runs), F.lit(0)),
        "word_before": F.col("before").rlike(r"[\p{L}0-9]$"), "word_after": F.col("after").rlike(r"^[\p{L}0-9]"),
        **{f"cue_{k}": F.col("before").rlike(c) for k, c in CUES.items()}, **{f"is_{k}": F.col("kind") == k for k in KINDS},
    }
    return found.withColumns({name: value[name].cast("double") for name in FEATURES})


@dataclass
class SpanModel:
    """Boosted trees, and by kind the score from which a candidate is redacted."""

    trees: GBTClassificationModel | None
    thresholds: dict[str, float]

    def selected(self, found: DataFrame) -> DataFrame:
        """Candidates at or above their kind's threshold, with score."""
        if self.trees is None:
            return found.withColumn("score", F.lit(0.0)).filter(F.lit(False))
        limit = F.lit(2.0)
        for kind, at in self.thresholds.items():
            limit = F.when(F.col("kind") == kind, F.lit(at)).otherwise(limit)
        return _scores(self.trees, found).filter(F.col("score") >= limit)


def _scores(trees: GBTClassificationModel, found: DataFrame) -> DataFrame:
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(found)
    return trees.transform(vectors).withColumn("score", vector_to_array("probability")[1]).drop("vector", "rawPrediction", "probability", "prediction")


def examples(found: DataFrame, most: int | None = None) -> DataFrame:
    """All different examples from candidates: kind, hit, before, after, copies, FEATURES, good (1 or 0), part (0 to 3).

    Equal candidates are one, merged in map tasks first. Base spans give a good
    example for each way to hide them that the generators propose whole;
    candidates that are no base span, nor one in disguise, are bad ones. All
    examples made of one candidate's text are in one part. most: for callers
    who want no more, so many examples, of each kind and goodness the same
    number at most, chosen by hash.
    """
    different = staged(found.groupBy("kind", "hit", "before", "after").agg(F.count(F.lit(1)).cast("double").alias("copies")), "pii-different")
    kind, hit = F.col("kind"), F.col("hit")
    made = different.withColumn("root", hit)
    base = made.filter(_passes(kind, hit)).withColumn("hit", F.explode(hidden(kind, hit)))
    whole = F.lit(False)
    for k, pattern in PROPOSE:
        whole = F.when(kind == k, hit.rlike(f"^(?:{pattern})$")).otherwise(whole)
    good = base.filter(whole & ~_passes(kind, hit)).withColumn("good", F.lit(1.0))
    bad = made.filter(~_passes(kind, hit) & ~_passes(kind, undone(kind, hit))).withColumn("good", F.lit(0.0))
    order = F.xxhash64("hit", "before", "after")
    chosen = [good, bad] if most is None else [rows.filter(kind == k).orderBy(order, "hit", "before", "after").limit(most // (2 * len(KINDS))) for rows in (good, bad) for k in KINDS]
    return staged(_featured(reduce(DataFrame.unionByName, chosen)).withColumn("part", F.pmod(F.xxhash64("root"), F.lit(4))), "pii-examples")


def merged(sample: DataFrame) -> DataFrame:
    """Examples whose kind, goodness, part and FEATURES are equal as one row, with n, their number, and weight.

    An example weighs 1 and the log of its copies. Weights are scaled so that
    both goodnesses of a kind weigh the same, whatever their numbers, and 1 on
    average.
    """
    each = staged(sample.groupBy("kind", "good", "part", *FEATURES).agg(F.count(F.lit(1)).alias("n"), F.sum(1 + F.log("copies")).alias("own")), "pii-merged")
    totals = each.filter("part > 0").groupBy("kind", "good").agg(F.sum("own").alias("held")).collect()  # eight rows at most
    share, mean = F.lit(0.0), sum(r.held for r in totals) / max(1, len(totals))
    for r in totals:
        share = F.when((F.col("kind") == r.kind) & (F.col("good") == r.good), mean / r.held).otherwise(share)
    return each.withColumn("weight", F.col("own") * share).drop("own")


def fit(sample: DataFrame, *, precision: float = PRECISION, seed: int = 7) -> SpanModel:
    """Learns from three quarters of the examples, weighed by the log of their copies, and calibrates on the rest.

    Equal examples count as one row with their weight. The trees' bins are cut
    by all rows: MLlib would draw a sample for them beyond the square of their
    most. A kind's threshold is the lowest score, in STEPS, whose held-out
    examples above it are good in at least `precision` of the cases; a kind for
    which there is none selects nothing. Without both good and bad examples
    there are no trees, and nothing is selected.
    """
    rows = merged(sample)
    learn = rows.filter("part > 0")
    if learn.select("good").distinct().count() < 2:
        return SpanModel(None, {})
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(learn)
    bins = max(32, math.isqrt(learn.count()) + 1)
    trees = GBTClassifier(featuresCol="vector", labelCol="good", weightCol="weight", maxIter=12, maxDepth=5, stepSize=0.3, maxBins=bins, seed=seed).fit(vectors)
    held = _scores(trees, rows.filter("part = 0")).groupBy("kind", F.floor(F.col("score") * STEPS).alias("step")).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"))
    return SpanModel(trees, thresholds([(r.kind, r.step, r.n, r.good) for r in held.collect()], precision))  # STEPS + 1 rows of a kind at most


def thresholds(steps: list[tuple[str, int, int, float]], precision: float) -> dict[str, float]:
    """By kind the lowest score from which on at least `precision` of the examples are good, from their numbers in each step: (kind, step, examples, good ones).

    It lies midway to the next examples below; where there are none, at the step, or at a half if that is lower.
    """
    out = {}
    for kind in KINDS:
        rows = sorted(((step, n, good) for k, step, n, good in steps if k == kind), reverse=True)
        every = fine = 0.0
        for i, (step, n, good) in enumerate(rows):
            every, fine = every + n, fine + good
            if fine / every >= precision:
                out[kind] = (step + rows[i + 1][0] + 1) / 2 / STEPS if i + 1 < len(rows) else min(step / STEPS, 0.5)
    return out


def _found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs as a struct `row`, with id, t (text, null as empty), base and all spans."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("body"), text.alias("t"))
    found = staged(candidates(rows), "pii-candidates")
    more = _best(fit(examples(found)).selected(_featured(found.filter(F.col("clear") & ~_passes(F.col("kind"), F.col("hit")))))).alias("m")
    based = rows.withColumn("base", base_spans(F.col("t"))).alias("d")
    both = based.join(more, F.col("d.id").eqNullSafe(F.col("m.id")) & (F.col("d.body") == F.col("m.body")), "left")
    spans = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))
    return both.select("row", F.col("d.id").alias("id"), "t", "base", spans.alias("spans"))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, base, spans (sorted arrays of start, place, end, kind).

    spans has all of base, and of the candidates that the model selects the
    best scored ones that overlap no base span nor a better candidate of their
    text. A table whose base spans give no good examples, or without bad
    ones, teaches nothing, and spans are the base. Null text counts as empty
    and has no spans; repeated rows give repeated results; an empty table gives
    no rows. Other columns play no part.
    """
    return _found(docs, id_col, text_col).select(F.col("id").alias(id_col), "base", "spans")


def personal_data_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: id, n_email, n_ip, n_card, n_phone and base_sha256 over base spans, and all spans."""
    *of_base, _ = digest_columns(F.col("base"), KINDS)
    return personal_data(docs, id_col, text_col).select(id_col, *of_base, listed(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with every span of a text replaced by its kind in brackets, overlapping ones by that of the first; null texts stay null."""
    found = _found(docs, id_col, text_col)
    t = F.col("t")

    def cut(seen: Column, s: Column) -> Column:
        piece = F.concat(seen["out"], t.substr(seen["at"] + 1, s["start"] - seen["at"]), F.lit("["), s["kind"], F.lit("]"))
        return F.struct(F.greatest(seen["at"], s["end"]).alias("at"), F.when(s["start"] >= seen["at"], piece).otherwise(seen["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.aggregate("spans", start, cut, lambda seen: F.concat(seen["out"], t.substr(seen["at"] + 1, F.length(t))))
    text = F.when(F.size("spans") > 0, text).otherwise(F.col(f"row.`{text_col}`"))
    return found.select(*[(text if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
