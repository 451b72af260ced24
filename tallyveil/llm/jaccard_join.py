"""Near copies by an exact Jaccard join of word shingles, with small and large sets apart.

Two sets of sizes a <= b link when their overlap is at least c(a, b). Small
sets list all their subsets of exactly c elements for every size they can link
with: two that link share one. For large sets that would explode, so their
elements' inverted lists are scanned. The boundary of small sets is where the
sum of both costs over the corpus' sizes is least.

Lists are scanned in two steps, both exact. In any one order of all elements,
two sets that link share at least l of their first size - c + l elements:

1. Every set enters the lists of its first elements in a random order, and
   stays when enough of its entries meet another set there. Most sets go.
2. For those that stay, the lists of all elements are counted. With the rarest
   elements first, each enters the lists of its first size - c + 1, so passages
   that many documents share bring no sets together.

Sets that share a list form candidate groups, large groups are cut into
blocks, and every pair of blocks is one piece of work that counts all overlaps
and passes on links as trees, so no step emits the pairs of a group. Every
task merges its own list entries before they are shuffled, so a list that a
third of all sets enter reaches its reducer as one entry for each batch.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.prefix import copy_numbers
from .components import components
from .scratch import batches_of, staged

SALTS = 64
#: Sizes up to which sets may count as small.
MOST_SMALL = 40
#: What reading an entry of an element's list costs, in subsets listed.
SCAN = 3.0
#: One in so many elements is entered beyond the fewest, to tell apart sets that share little.
EXTRA = 10
#: Sets, and elements in all, of a block of a candidate group.
BLOCK = 512
BLOCK_ELEMENTS = 2_000_000
#: Elements that one piece of work counts at a time.
CHUNK = 2048
#: Bytes of text that are cut into words at a time, and sets that a task remembers.
SLICE = 1_000_000
REMEMBERED = 200_000
#: Rows of candidates up to which they are broadcast to find their texts.
MOST_BROADCAST = 500_000
#: Rows, texts or sets, that pass to Python at a time.
BATCH = 1_000

U = np.uint64
P = U(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Join:
    """width words a shingle; sets link when den * intersection >= num * union."""

    width: int = 3
    num: int = 90
    den: int = 100

    def overlap(self, a: int, b: int) -> int:
        """The least intersection with which sizes a and b link."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def most(self, a: int) -> int:
        """The largest size that can link with size a."""
        return a * self.den // self.num

    def least(self, b: int) -> int:
        """The smallest size that can link with size b, and the least intersection of b with any set it links with."""
        return -(-self.num * b // self.den)

    def wanted(self, n: int) -> int:
        """How many list entries two linked sets share, the smaller of size n, when each enters size - least + wanted lists."""
        return 1 + min(n // EXTRA, self.least(n) - 1)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(33))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def _cut(texts: pa.Array) -> Iterator[pa.Array]:
    """texts in slices of about SLICE bytes, a longer text on its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE, "right")))
        yield texts.slice(start, stop - start)
        start = stop


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """For each text its sorted distinct 64-bit shingles; fewer words than width are one shingle, no words are none."""
    out: list[np.ndarray] = []
    for some in _cut(texts):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(some, "")))
        words = lists.flatten()
        filled = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
        coded = words.dictionary_encode()
        hashes = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False), categorize=False)
        h = hashes[coded.indices.to_numpy(zero_copy_only=False)][filled]
        counts = np.bincount(np.repeat(np.arange(len(some)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))[filled], minlength=len(some)).tolist()
        with np.errstate(over="ignore"):
            full = max(0, len(h) - width + 1)
            total = np.zeros(full, U)
            for i in range(width):
                total = total * P + h[i : full + i]
            total, start = mixed(total), 0
            for n in counts:
                if n >= width:
                    own = np.sort(total[start : start + n - width + 1])
                    out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
                elif n:
                    few = U(n)
                    for x in h[start : start + n]:
                        few = few * P + x
                    out.append(mixed(np.array([few], U)))
                else:
                    out.append(np.empty(0, U))
                start += n
    return out


def class_of(tokens: np.ndarray) -> bytes:
    """Sixteen bytes that stand for the whole set."""
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def short_of(cls: bytes) -> int:
    """The first eight bytes of a class, by which first lists know it; classes that share them stay together."""
    return int.from_bytes(cls[:8], "little", signed=True)


@cache
def _subsets(size: int, keep: int) -> np.ndarray:
    return np.array(list(itertools.combinations(range(size), keep)), dtype=np.intp).reshape(-1, keep)


def _partners(join: Join, size: int, small: int) -> list[tuple[int, int]]:
    """Pairs of sizes, the smaller first, in which a small set of this size can link with a small one."""
    return [(size, b) for b in range(size, min(join.most(size), small) + 1)] + [(a, size) for a in range(join.least(size), size)]


def subset_cost(join: Join, size: int) -> float:
    return float(sum(comb(size, join.overlap(a, b)) for a, b in _partners(join, size, join.most(size))))


def list_cost(join: Join, size: int) -> float:
    return (1 + SCAN) * (size - join.least(size) + join.wanted(size))


def boundary(join: Join, sizes: dict[int, int]) -> int:
    """The size up to which sets are small, with the least cost over a histogram of sizes."""
    cost = [sum(n * (subset_cost(join, s) if s <= x else list_cost(join, s)) for s, n in sizes.items() if 0 < s <= MOST_SMALL) for x in range(MOST_SMALL + 1)]
    return int(np.argmin(cost))


def subset_keys(tokens: np.ndarray, join: Join, small: int) -> np.ndarray:
    """Keys of a small set's subsets; small sets that link share one. Large sets have none."""
    size, out = len(tokens), []
    if size <= small:
        with np.errstate(over="ignore"):
            values = mixed(tokens)
            for a, b in _partners(join, size, small):
                rows = values[_subsets(size, join.overlap(a, b))]
                out.append(mixed(rows.sum(axis=1, dtype=U) + U(a * 1_000_003 + b) * P))
    return np.unique(np.concatenate(out)).view(np.int64) if out else np.empty(0, np.int64)


def first_keys(tokens: np.ndarray, join: Join, small: int) -> np.ndarray:
    """Keys of the first lists of a set that can link with a large one: its first elements in a random order."""
    size = len(tokens)
    if not size or join.most(size) <= small:
        return np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        return np.sort(mixed(~tokens))[: size - join.least(size) + join.wanted(size)].view(np.int64)


def _sets(rows: DataFrame, join: Join) -> DataFrame:
    """id, body, n, cls, short of each document; without shingles the last two are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = shingle_sets(batch.column("text"), join.width)
            classes = [class_of(t) if len(t) else None for t in tokens]
            columns = [batch.column("id"), batch.column("body"), pa.array(map(len, tokens), pa.int64()), pa.array(classes, pa.binary()), pa.array([c and short_of(c) for c in classes], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "body", "n", "cls", "short"])

    kind = rows.schema["id"].dataType
    out = rows.withColumn("id", F.col("id").cast("string")).mapInArrow(run, "id string, body long, n long, cls binary, short long")
    return out.withColumn("id", F.col("id").cast(kind))


#: What an entry of a subset's list counts: enough for a set to stay.
ALWAYS = 1 << 40


def _meeting(rows: DataFrame, join: Join, small: int) -> DataFrame:
    """owner (short name) of the sets that meet others in a subset's list, or in as many first lists as linked sets do.

    Rows on the way are list entries (key, owner, what the entry counts; no
    owner where a batch had several, which then have counted it) and counts (no key).
    """
    shape = pa.schema([("key", pa.int64()), ("owner", pa.int64()), ("n", pa.int64()), ("need", pa.int64())])

    def made(key, owner, n, need) -> pa.RecordBatch:
        size = len(n)
        columns = [pa.nulls(size, pa.int64()) if c is None else c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in (key, owner, n, need)]
        return pa.RecordBatch.from_arrays(columns, schema=shape)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            keys, owners, counts, names, needs = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], [], []
            for tokens in shingle_sets(batch.column(0), join.width):
                if not len(tokens) or (cls := class_of(tokens)) in seen:
                    continue
                if len(seen) > REMEMBERED:
                    seen.clear()
                seen.add(cls)
                names.append(short_of(cls))
                needs.append(join.wanted(join.least(len(tokens))))
                for found, counted in ((subset_keys(tokens, join, small), ALWAYS), (first_keys(tokens, join, small), 1)):
                    keys.append(found)
                    owners.append(np.full(len(found), names[-1], np.int64))
                    counts.append(np.full(len(found), counted, np.int64))
            key, owner, n = np.concatenate(keys), np.concatenate(owners), np.concatenate(counts)
            order = np.argsort(key, kind="stable")
            key, owner, n = key[order], owner[order], n[order]
            _, starts, times = np.unique(key, return_index=True, return_counts=True)
            alone = np.repeat(times == 1, times)
            own, place = np.unique(np.concatenate([owner[~alone], np.array(names, np.int64)]), return_inverse=True)
            met = np.bincount(place, np.concatenate([n[~alone], np.zeros(len(names))]), len(own)).astype(np.int64)
            need = np.zeros(len(own), np.int64)
            np.maximum.at(need, place[len(place) - len(names) :], np.array(needs, np.int64))
            yield made(None, own, met, need)
            yield made(key[starts], pa.array(owner[starts], pa.int64(), mask=times > 1), n[starts], np.zeros(len(starts), np.int64))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = made(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
        for batch in batches:
            counts = batch.filter(batch.column(0).is_null())
            if counts.num_rows:
                yield counts
            entries = pa.Table.from_batches([open_, batch.filter(batch.column(0).is_valid())]).combine_chunks()
            if not entries.num_rows:
                continue
            key = entries.column("key").to_numpy()
            first = np.concatenate([[True], key[1:] != key[:-1]])
            place = np.cumsum(first) - 1
            meets = np.bincount(place)[place] > 1
            owned = entries.column("owner").is_valid().to_numpy(zero_copy_only=False)
            some = entries.filter(pa.array(meets & owned))
            if some.num_rows:
                yield made(None, some.column("owner").combine_chunks(), some.column("n").combine_chunks(), some.column("need").combine_chunks())
            # The last list may go on: its only entry waits, or one without an owner stands for those that have met.
            last = entries.slice(len(key) - 1, 1).to_batches()[0]
            open_ = made(last.column(0), pa.nulls(1, pa.int64()), last.column(2), last.column(3)) if meets[-1] else last

    fields = "key long, owner long, n long, need long"
    entered = rows.select("text").mapInArrow(enter, fields)
    dealt = entered.repartition(F.coalesce("key", F.xxhash64("owner"))).sortWithinPartitions("key")
    counts = dealt.mapInArrow(meet, fields).groupBy("owner").agg(F.sum("n").alias("n"), F.max("need").alias("need"))
    return counts.filter("n >= need").select("owner")


def _staying(rows: DataFrame, sets: DataFrame, join: Join, small: int) -> DataFrame:
    """Different sets that may link: k (a number), cls, copies, n, tokens, keys (of subsets)."""
    meeting = staged(_meeting(rows, join, small), "meeting")
    classes = sets.filter("n > 0").groupBy("cls", "short").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    chosen = staged(classes.join(meeting, F.col("short") == F.col("owner"), "left_semi").drop("short"), "candidates")
    different = chosen.count()
    wanted = F.broadcast(chosen) if different <= MOST_BROADCAST else chosen
    texts = rows.alias("d").join(wanted.alias("c"), F.col("d.id").eqNullSafe(F.col("c.id"))).select("cls", "copies", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = shingle_sets(batch.column("text"), join.width)
            same = [i for i, (t, c) in enumerate(zip(own, batch.column("cls").to_pylist(), strict=True)) if len(t) and class_of(t) == c]  # ids may repeat
            lists = pa.list_(pa.int64())
            columns = [batch.column("cls").take(pa.array(same, pa.int64())), batch.column("copies").take(pa.array(same, pa.int64())), pa.array([len(own[i]) for i in same], pa.int64())]
            columns += [pa.array([own[i].view(np.int64) for i in same], lists), pa.array([subset_keys(own[i], join, small) for i in same], lists)]
            yield pa.RecordBatch.from_arrays(columns, ["cls", "copies", "n", "tokens", "keys"])

    found = texts.mapInArrow(run, "cls binary, copies long, n long, tokens array<long>, keys array<long>")
    found = staged(found.withColumn("k", F.monotonically_increasing_id()), "staying-sets")
    if found.count() > different:  # rows with one id and one set
        found = found.join(found.groupBy("cls").agg(F.min("k").alias("k")), ["cls", "k"], "left_semi")
    return found


def _ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b).cast("long")


def _shared_lists(found: DataFrame, join: Join, small: int) -> DataFrame:
    """(a, b): k of sets that share a subset, or one of their rarest elements, as stars.

    An element that no other set has needs no list: what counts is how many of
    a set's elements others have, and where those stand behind the others.
    """
    each = found.filter((F.col("n") > small) | (F.floor(F.col("n") * join.den / join.num) > small)).select("k", "n", F.explode("tokens").alias("key"))
    often = each.groupBy("key").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    least = _ceil_div(F.col("n") * join.num, join.den)
    own = Window.partitionBy("k")
    placed = each.join(often, "key").withColumn("shared", F.count(F.lit(1)).over(own)).withColumn("place", F.row_number().over(own.orderBy("often", "key")))
    rare = placed.filter(F.col("place") <= F.col("shared") - least + 1).select("k", "key")
    entries = staged(rare.unionByName(found.select("k", F.explode("keys").alias("key"))), "rare-entries")
    hubs = entries.groupBy("key").agg(F.min("k").alias("hub"), F.count(F.lit(1)).alias("often")).filter("often > 1")
    return entries.join(hubs, "key").filter("k <> hub").select(F.col("k").alias("a"), F.col("hub").alias("b"))


def linked(sets: list[np.ndarray], join: Join) -> np.ndarray:
    """Whether each two of the sets link: overlaps are counted by scanning the inverted lists of elements that occur more than once."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times[token] > 1
    owner, token = owner[common], np.unique(token[common], return_inverse=True)[1]
    counts = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    for start in range(0, int(token[-1]) + 1 if len(token) else 0, CHUNK):
        lo, hi = np.searchsorted(token, [start, start + CHUNK])
        lists = np.zeros((len(sets), min(CHUNK, int(token[-1]) + 1 - start)), dtype=np.float32)
        lists[owner[lo:hi], token[lo:hi] - start] = 1
        counts += lists @ lists.T
    both = counts.astype(np.int64)
    return both * (join.num + join.den) >= join.num * (sizes[:, None] + sizes[None, :])


def _trees(links: np.ndarray) -> list[tuple[int, int]]:
    """Edges that span the components of a small link matrix."""
    out, open_ = [], set(range(len(links)))
    while open_:
        todo = [open_.pop()]
        while todo:
            x = todo.pop()
            for y in [y for y in np.flatnonzero(links[x]).tolist() if y in open_]:
                open_.discard(y)
                out.append((x, y))
                todo.append(y)
    return out


def _true_links(found: DataFrame, groups: DataFrame, join: Join) -> DataFrame:
    """(a, b, links): trees of true links between sets, and with b null the number of documents that set a links with."""
    own = groups.join(found, F.col("node") == F.col("k"))
    sizes = own.groupBy("root").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_ELEMENTS)).cast("int").alias("blocks"))
    sizes = staged(sizes, "candidate-groups")
    if sizes.count() <= MOST_BROADCAST:
        sizes = F.broadcast(sizes)
    block = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    rows = own.join(sizes, "root").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("root", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "k", "copies", "tokens")
    rows = rows.repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi", "k")

    def work(group: pd.DataFrame) -> list[tuple]:
        if len(group) < 2:
            return []
        k, side, lo, hi = group["k"].tolist(), group["block"].to_numpy(), *group[["lo", "hi"]].iloc[0]
        links = linked(list(group["tokens"]), join)
        np.fill_diagonal(links, False)
        if lo != hi:
            links &= side[:, None] != side[None, :]
        weight = links @ group["copies"].to_numpy()
        return [(k[x], k[y], 0) for x, y in _trees(links)] + [(k[i], None, int(weight[i])) for i in np.flatnonzero(weight)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        piece = ["root", "lo", "hi"]
        shape = {"a": "Int64", "b": "Int64", "links": "Int64"}
        open_: list[pd.DataFrame] = []
        for batch in batches:
            out: list[tuple] = []
            for at, part in batch.groupby(piece, sort=False):
                if open_ and tuple(open_[0][piece].iloc[0]) != at:
                    out += work(pd.concat(open_, ignore_index=True))
                    open_ = []
                open_.append(part)
            yield pd.DataFrame(out, columns=list(shape)).astype(shape)
        yield pd.DataFrame(work(pd.concat(open_, ignore_index=True)) if open_ else [], columns=list(shape)).astype(shape)

    return staged(rows.mapInPandas(run, "a long, b long, links long"), "true-links")


def _placed(docs: DataFrame, id_col: str, text_col: str, join: Join) -> DataFrame:
    """id, body, n_shingles, first (the row that stands for the component: its least id, of equal ids the least body; null ids come last), n_links."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("body"), F.col(text_col).alias("text"))
    with batches_of(docs.sparkSession, BATCH):  # every step with Python is written inside
        sets = staged(_sets(rows, join), "shingle-sets")
        sizes = {r.s: r.n for r in sets.groupBy(F.least("n", F.lit(MOST_SMALL + 1)).cast("int").alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
        small = boundary(join, sizes)
        found = _staying(rows, sets, join, small)
        links = _true_links(found, components(_shared_lists(found, join, small)), join)
    roots = components(links.filter("b IS NOT NULL"))
    degree = links.filter("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    near = found.select("cls", "k").join(roots, F.col("k") == F.col("node")).join(degree, F.col("k") == F.col("a"), "left").select("cls", "root", "links")

    row = F.struct(F.col("id").isNull().alias("without"), "id", "body")
    salt = F.pmod(F.xxhash64("id", "body"), F.lit(SALTS)).cast("int")
    own = sets.filter("n > 0").withColumn("salt", salt)
    classes = own.groupBy("cls").agg(F.min(row).alias("first"), F.count(F.lit(1)).alias("copies"), F.collect_set("salt").alias("salts")).join(near, "cls", "left")
    lane = F.pmod(F.xxhash64("cls"), F.lit(SALTS)).cast("int")  # a component may hold a third of all sets
    classes = staged(classes.select("cls", "first", "salts", "root", lane.alias("lane"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "classes")
    many = classes.filter("root IS NOT NULL").groupBy("root").agg(F.min("first").alias("least"), F.collect_set("lane").alias("lanes")).withColumn("lane", F.explode("lanes")).drop("lanes")
    final = classes.join(many, ["root", "lane"], "left").select("cls", F.explode("salts").alias("salt"), F.coalesce("least", "first").alias("first"), "n_links")
    full = own.join(final, ["cls", "salt"]).select("id", "body", F.col("n").alias("n_shingles"), "first", "n_links")
    return full.unionByName(sets.filter("n = 0").select("id", "body", F.col("n").alias("n_shingles"), row.alias("first"), F.lit(0).cast("long").alias("n_links")))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, join: Join = Join()) -> DataFrame:
    """One row for each row of docs: id, body (hash of the text), n_shingles, component_id, n_links.

    component_id is the smallest id that links reach, the row's own included;
    n_links counts the other rows that the row links with directly. Words are
    what ASCII white space divides, with A-Z lowered. Null and empty texts
    have no shingles and link with nothing. Repeated rows are rows that link.
    Null ids come after all others: a component of null ids only has a null id.
    An empty table gives no rows. Other columns play no part.
    """
    return _placed(docs, id_col, text_col, join).select(F.col("id").alias(id_col), "body", "n_shingles", F.col("first.id").alias("component_id"), "n_links")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, join: Join = Join(5, 80, 100)) -> DataFrame:
    """One row of docs for each component, with all its columns, whatever their names: that with the least id.

    Null ids come after all others; of equal ids one text stays, chosen by its
    hash, and of rows equal in both one. Texts without words (null, empty,
    blank) link with nothing and all stay, but for rows that repeat id and
    text. An empty table gives no rows.
    """
    found = staged(_placed(docs, id_col, text_col, join).select("id", "body", (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("body") == F.col("first.body"))).alias("stays")), "near-copies")
    stay = found.filter("stays").select("id", "body").distinct()
    if stay.count() <= MOST_BROADCAST:
        stay = F.broadcast(stay)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("body"))
    kept = rows.alias("d").join(stay.alias("s"), F.col("d.id").eqNullSafe(F.col("s.id")) & (F.col("d.body") == F.col("s.body")), "left_semi")
    if not found.groupBy("id", "body").count().filter("count > 1").isEmpty():
        kept = copy_numbers(kept, ["id", "body"], "copy_no").filter("copy_no = 1")
    return kept.select("row.*")


#: DuckDB SQL for `near_copies` with its default join: all overlaps by a self-join, all reachable pairs by recursion.
OP5_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT k, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT k, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT k, count(*) AS n FROM s GROUP BY k),
o AS (SELECT a.k AS x, b.k AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.k < b.k GROUP BY a.k, b.k),
e AS (SELECT x, y FROM o JOIN n p ON p.k = x JOIN n q ON q.k = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
u AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(x, y) AS (SELECT k, k FROM d UNION SELECT r.x, u.y FROM r JOIN u ON u.x = r.y),
c AS (SELECT r.x AS k, min(d.doc_id) AS component_id FROM r JOIN d ON d.k = r.y GROUP BY r.x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(l, 0) AS n_links
FROM d JOIN c USING (k) LEFT JOIN n USING (k) LEFT JOIN (SELECT x AS k, count(*) AS l FROM u GROUP BY x) USING (k)"""
