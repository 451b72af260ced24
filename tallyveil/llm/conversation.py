"""Repair of conversations by the cheapest edits, of equal ones by the least audit.

A row is kept, given another role, or deleted; rows without text are inserted.
The roles that remain must read `(s?(ua)+)?`. Conversations are rows in order,
cut into blocks of a bounded number of rows; a block is a string of one letter
for each row, so the work in Python sees no texts. In a block

1. a cost DP from the end gives the cheapest cost from every node (place and
   state of the roles so far), and with it the arcs that lie on cheapest paths;
2. nodes are ranked by the least audit along such arcs: by its first letter,
   then by audits of 2, 4, 8 ... letters, as pairs of the ranks of the node and
   of the node that its doubled pointer leads to;
3. every node goes on to the arc with the least letter and rank, and the path
   is read off by doubling: the first 2^k nodes and where their pointers lead.

Conversations of several blocks need the cost behind each block (a suffix scan
of the blocks' min-plus matrices) and the state in front of it (a prefix scan
of the blocks' exits), both by joins of doubling distance. So no task holds a
conversation; only its digest, one hash over all that it keeps, is computed in
order, by a task that streams through the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from .scratch import staged

#: Most rows of a block.
BLOCK = 16_384
#: Nodes that a step of the ranking handles together.
NODES = 250_000
WHITE = " \t\n\x0b\x0c\r"
#: States: no role yet, after s, after u, after a. Costs and moves of the edits.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
AFTER_NEW = np.array([2, 2, 3, 2])
NONE = 4
AFTER_KEPT = np.array([[1, NONE, NONE, NONE], [2, 2, NONE, 2], [NONE, NONE, 3, NONE], [NONE] * 4])
#: Cost behind the last row: nothing, insert u and a, insert a, nothing.
LAST = [0, 2 * INSERT, INSERT, 0]
FAR = 1 << 40
#: Letters of an edit in detail: delete, insert user or assistant, keep, make user or assistant.
DETAIL, AUDIT = "dijkrs", "DIIKRR"
ROLES = {"i": "user", "j": "assistant", "r": "user", "s": "assistant"}
DIGEST_OF_NOTHING = hashlib.sha256(b"").hexdigest()


def _parts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Initial (0 to 3: s, u, a, other), whether the row must go, and what keeping it adds, of letters from A on."""
    n = codes.astype(np.int64) - 65
    return n // 4 % 4, n // 2 % 2 == 1, n % 2 * TRUNCATED


def _aligned(codes: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters as a table whose rows end together, and the lengths."""
    lengths = np.array([len(c) for c in codes])
    width = max(1, lengths.max(initial=0))
    return np.frombuffer("".join(c.rjust(width, "A") for c in codes).encode(), dtype=np.uint8).reshape(len(codes), width), lengths


def costs(table: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Cheapest cost from every node (block, place, state) to the block's end and on, given the costs from its end."""
    blocks, width = table.shape
    initial, gone, extra = _parts(table)
    out = np.empty((blocks, width + 1, NONE + 1), dtype=np.int64)
    out[:, :, NONE] = FAR
    out[:, width, :NONE] = ends
    every = np.arange(blocks)[:, None]
    for at in range(width - 1, -1, -1):
        behind, e = out[:, at + 1], extra[:, at, None]
        stay = np.minimum(KEEP + e + behind[every, AFTER_KEPT[initial[:, at]]], REROLE + e + behind[:, AFTER_NEW])
        c = np.minimum(DELETE + behind[:, :NONE], np.where(gone[:, at, None], FAR, stay))
        user, assistant = np.minimum(c[:, 2], INSERT + c[:, 3]), np.minimum(c[:, 3], INSERT + c[:, 2])
        out[:, at, 0], out[:, at, 1] = np.minimum(c[:, 0], INSERT + user), np.minimum(c[:, 1], INSERT + user)
        out[:, at, 2], out[:, at, 3] = user, assistant
    return np.minimum(out, FAR)


def _arcs(table: np.ndarray, h: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every node the nodes that its cheapest arcs D, I, K and R lead to, and which of these exist."""
    blocks, width = table.shape
    initial, gone, extra = (np.concatenate([p, p[:, :1]], axis=1) for p in _parts(table))
    node = np.arange(blocks * (width + 1) * 4).reshape(blocks, width + 1, 4)
    row = np.arange(width + 1) < width
    here, behind = h[:, :, :NONE], np.concatenate([h[:, 1:], h[:, -1:]], axis=1)
    first, after = node[:, :, :1], np.concatenate([node[:, 1:, :1], node[:, -1:, :1]], axis=1)
    kept = AFTER_KEPT[initial]
    e = extra[:, :, None]
    far = here < FAR
    to = np.stack([after + np.arange(4), first + AFTER_NEW, after + np.minimum(kept, 3), after + AFTER_NEW], axis=-1)
    keep, renamed = np.take_along_axis(behind, kept, axis=2), behind[:, :, AFTER_NEW]
    consumed = row[None, :, None] & far
    stays = consumed & ~gone[:, :, None]
    there = np.stack([
        consumed & (here == DELETE + behind[:, :, :NONE]),
        far & (row[None, :, None] | last[:, None, None]) & (here == INSERT + here[:, :, AFTER_NEW]),
        stays & (kept < NONE) & (here == KEEP + e + keep),
        stays & (here == REROLE + e + renamed),
    ], axis=-1)
    return to.reshape(-1, 4), there.reshape(-1, 4)


def ranked(to: np.ndarray, there: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """For every node the next one on its least audit (itself where the audit ends), and the arc's place among D, I, K, R (-1 at the end).

    Arcs of a node differ in their letter, so its least arc is known at once;
    ranks then compare ever longer audits, an audit that ends coming first.
    """
    nodes = np.arange(len(to))
    some = there.any(axis=1)
    least = there.argmax(axis=1)
    pointer = np.where(some, to[nodes, least], nodes)
    rank = np.where(some, least + 1, 0)
    length = 1
    while length < longest:
        rank = np.unique(rank * (len(nodes) + 5) + rank[pointer], return_inverse=True)[1].reshape(-1)
        pointer = pointer[pointer]
        length *= 2
    best = np.where(there, np.arange(4) * len(nodes) + rank[to], 4 * len(nodes)).argmin(axis=1)
    return np.where(some, to[nodes, best], nodes), np.where(some, best, -1)


def _letters(arc: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Detail letters of arcs that leave a state; 0 at the end."""
    names = np.frombuffer(b"dikrdjks", dtype=np.uint8).reshape(2, 4)
    return np.where(arc < 0, 0, names[(state == 2).astype(int), arc])


def solve(codes: list[str], ends: np.ndarray, last: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Cost from each block's start in the state entry, states at its end for each state at its start, and the edits in detail."""
    table, lengths = _aligned(codes)
    blocks, width = table.shape
    h = costs(table, ends)
    longest = 2 * width + 4
    go, arc = ranked(*_arcs(table, h, last), longest)
    letters = _letters(arc, np.arange(len(go)) % 4)
    start = (np.arange(blocks) * (width + 1) + width - lengths) * 4
    seq, ahead, length = (start + entry)[:, None], go, 1
    far = start[:, None] + np.arange(4)
    while length < longest:
        seq = np.concatenate([seq, ahead[seq]], axis=1)
        ahead = ahead[ahead]
        length *= 2
    spelled = letters[seq].astype(np.uint8)
    return h[np.arange(blocks), width - lengths, entry], ahead[far] % 4, [row[row > 0].tobytes().decode() for row in spelled]


def matrices(codes: list[str]) -> np.ndarray:
    """Cheapest cost from each state at a block's start to each at its end, 16 numbers for each block."""
    table, lengths = _aligned(codes)
    out = np.empty((len(codes), 4, 4), dtype=np.int64)
    for to in range(4):
        ends = np.full((len(codes), 4), FAR)
        ends[:, to] = 0
        out[:, :, to] = costs(table, ends)[np.arange(len(codes)), table.shape[1] - lengths, :4]
    return out.reshape(-1, 16)


def _chunks(codes: list[str]) -> Iterator[np.ndarray]:
    """Places of blocks of like lengths, so many that their padded nodes stay below NODES."""
    order = np.argsort([len(c) for c in codes], kind="stable")
    at = 0
    while at < len(order):
        upto = at + 1
        while upto < len(order) and (upto + 1 - at) * 4 * (len(codes[order[upto]]) + 1) <= NODES:
            upto += 1
        yield order[at:upto]
        at = upto


SOLVED = StructType().add("cost", LongType()).add("exits", ArrayType(IntegerType())).add("detail", StringType()).add("illegal", LongType())


@F.pandas_udf(SOLVED)
def _solved(code: pd.Series, ends: pd.Series, last: pd.Series, entry: pd.Series) -> pd.DataFrame:
    codes = list(code)
    out: list = [None] * len(codes)
    for part in _chunks(codes):
        mine = [codes[i] for i in part]
        found = solve(mine, np.stack([np.asarray(ends.iloc[i]) for i in part]), last.to_numpy(dtype=bool)[part], entry.to_numpy(dtype=np.int64)[part])
        for i, c, cost, exits, detail in zip(part, mine, *found, strict=True):
            initial = _parts(np.frombuffer(c.encode(), dtype=np.uint8))[0]
            pair = initial[:-1] * 4 + initial[1:]
            out[i] = (int(cost), exits.tolist(), detail, int((~np.isin(pair, (1, 6, 9))).sum()))  # su, ua, au
    return pd.DataFrame(out, columns=["cost", "exits", "detail", "illegal"])


@F.pandas_udf(ArrayType(LongType()))
def _matrix(code: pd.Series) -> pd.Series:
    codes = list(code)
    out = np.empty((len(codes), 16), dtype=np.int64)
    for part in _chunks(codes):
        out[part] = matrices([codes[i] for i in part])
    return pd.Series(list(out))


def _scanned(values: DataFrame, blocks: int, step: int, joined) -> DataFrame:
    """cid, block, v: v combined with those of all blocks behind (step 1) or before (step -1) it in its conversation, by joins of doubling distance."""
    distance = 1
    while distance < blocks:
        x, y = values.alias("x"), values.alias("y")
        near = (F.col("x.cid") == F.col("y.cid")) & (F.col("y.block") == F.col("x.block") + F.lit(step * distance))
        both = x.join(y, near, "left")
        v = F.when(F.col("y.v").isNull(), F.col("x.v")).otherwise(joined(F.col("x.v"), F.col("y.v")))
        values = staged(both.select(F.col("x.cid").alias("cid"), F.col("x.block").alias("block"), v.alias("v")), "scan")
        distance *= 2
    return values


def _min_plus(a: Column, b: Column) -> Column:
    cell = lambda k: F.array_min(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda m: F.get(a, F.floor(k / 4).cast("int") * 4 + m) + F.get(b, m * 4 + k % 4)))
    return F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: F.least(cell(k), F.lit(FAR)))


def _ends_and_entries(blocks: DataFrame, most: int) -> DataFrame:
    """blocks with ends (costs from a block's end on) and last; then solved with the state that each is entered in."""
    values = staged(blocks.select("cid", "block", _matrix("code").alias("v")), "matrices")
    behind = _scanned(values, most, 1, _min_plus)
    last = F.array(*[F.lit(c).cast("long") for c in LAST])
    cost = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda q: F.array_min(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda r: F.get("v", q * 4 + r) + F.get(last, r))))
    ends = behind.select("cid", (F.col("block") - 1).alias("block"), cost.alias("next"))
    placed = blocks.join(ends, ["cid", "block"], "left").withColumn("last", F.col("next").isNull()).withColumn("ends", F.coalesce("next", last)).drop("next")
    placed = staged(placed, "blocks-ends")
    exits = staged(placed.select("cid", "block", _solved("code", "ends", "last", F.lit(0))["exits"].alias("v")), "exits")
    # where the blocks up to this one lead: what those before it lead to, looked up in its own exits
    led = _scanned(exits, most, -1, lambda own, before: F.transform(before, lambda q: F.get(own, q)))
    entries = led.select("cid", (F.col("block") + 1).alias("block"), F.get("v", F.lit(0)).alias("entry"))
    return placed.join(entries, ["cid", "block"], "left").withColumn("entry", F.coalesce("entry", F.lit(0)))


def damaged(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """cid, turn, role, text, copy: the rows after the damage that CRC-32 of `conv_id:turn` names; nulls of role and text are one space."""
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), F.lit(" ")))
    plain = rows.select(_cid(id_col), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"), (F.crc32(key) % 20).alias("harm"))
    harm = F.col("harm")
    text = F.when(harm == 1, "").when(harm == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(harm == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return plain.filter(harm != 0).select("cid", "turn", role.alias("role"), text.alias("text"), copies.alias("copy"))


def undamaged(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows as `damaged` gives them, without any damage."""
    return rows.select(_cid(id_col), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"), F.lit(0).alias("copy"))


def _cid(id_col: str) -> Column:
    """The id as a text that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("")).alias("cid")


def _placed(rows: DataFrame) -> DataFrame:
    """rows with pos: places from 0 on in the order of cid, turn (nulls first), role, text; equal rows in any order.

    A range of the sort is a task, a conversation spans as many as it needs;
    equal rows are told apart by where they were read, so they can be split.
    """
    order = [F.col("cid"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("copy"), F.col("tie")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = tied.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("copy", "tie").withColumn("part", F.spark_partition_id()).withColumn("at", inside)
    ordered = staged(ordered, "turns")
    starts, total = [], 0
    for r in sorted(ordered.groupBy("part").count().collect()):
        starts.append((r["part"], total))
        total += r["count"]
    first = F.broadcast(rows.sparkSession.createDataFrame(starts, "part int, start long"))  # one row for each task of the sort
    return ordered.join(first, "part").withColumn("pos", F.col("start") + F.col("at")).drop("part", "start", "at")


def _marked(rows: DataFrame, block: int) -> DataFrame:
    """cid, pos, turn, block, code and the row's first fault, without texts."""
    bare = F.rtrim("text", F.lit(WHITE))
    blank = bare == ""
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    initial = F.when(F.col("role").startswith("s"), 0).when(F.col("role").startswith("u"), 1).when(F.col("role").startswith("a"), 2).otherwise(3)
    plain = rows.select("cid", "pos", "turn", digest.alias("digest"), blank.alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("open"), initial.alias("initial"))
    plain = staged(plain, "turn-marks")
    fresh = plain.groupBy("cid", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("fresh"))
    seen = plain.join(fresh, "pos", "left").withColumn("seen", F.col("fresh").isNull())
    duplicate, truncated = ~F.col("blank") & F.col("seen"), ~F.col("blank") & ~F.col("seen") & F.col("open")
    code = F.char(65 + F.col("initial") * 4 + (F.col("blank") | F.col("seen")).cast("int") * 2 + truncated.cast("int"))
    return seen.select("cid", "pos", F.floor(F.col("pos") / block).cast("long").alias("block"), "blank", duplicate.alias("duplicate"), truncated.alias("truncated"), code.alias("code"))


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hashes of what conversations keep; rows come in order, each block's edits before its rows. Holds one batch and one block's edits."""
    cid, edits, at, found, some = None, "", 0, None, False

    def add(role: str, text: str) -> None:
        nonlocal some
        found.update(f"{chr(10) if some else ''}{role}:{text}".encode())
        some = True

    def inserts() -> None:
        nonlocal at
        while at < len(edits) and edits[at] in "ij":
            add(ROLES[edits[at]], "")
            at += 1

    for batch in batches:
        out = []
        for key, kind, role, text in zip(batch["cid"], batch["kind"], batch["role"], batch["text"], strict=True):
            if key != cid:
                if found is not None:
                    inserts()
                    out.append((cid, found.hexdigest()))
                cid, edits, at, found, some = key, "", 0, hashlib.sha256(), False
            if kind == 0:
                inserts()
                edits, at = text, 0
                continue
            inserts()
            edit = edits[at]
            at += 1
            if edit != "d":
                add(ROLES.get(edit, role), text)
        yield pd.DataFrame(out, columns=["cid", "digest"])
    if found is not None:
        inserts()
        yield pd.DataFrame([(cid, found.hexdigest())], columns=["cid", "digest"])


def _edited(rows: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Placed rows, and blocks with their edits in detail."""
    placed = _placed(rows)
    marks = staged(_marked(placed, block), "turn-faults")
    letters = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"]), "")
    faults = [F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")]
    blocks = staged(marks.groupBy("cid", "block").agg(letters.alias("code"), F.min("pos").alias("pos"), *faults), "blocks")
    most = blocks.groupBy("cid").agg((F.max("block") - F.min("block") + 1).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 1
    if most > 1:
        ready = _ends_and_entries(blocks, most)
    else:
        ready = blocks.withColumn("ends", F.array(*[F.lit(c).cast("long") for c in LAST])).withColumn("last", F.lit(True)).withColumn("entry", F.lit(0))
    out = ready.withColumn("s", _solved("code", "ends", "last", "entry")).select("cid", "block", "pos", "code", "blank", "duplicate", "truncated", "s.cost", "s.detail", "s.illegal")
    return placed, staged(out, "edits")


def _repaired_digests(placed: DataFrame, blocks: DataFrame) -> DataFrame:
    rows = placed.select("cid", "pos", F.lit(1).alias("kind"), "role", "text")
    edits = blocks.select("cid", "pos", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("role"), F.col("detail").alias("text"))
    parts = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stream = rows.unionByName(edits).repartition(parts, "cid").sortWithinPartitions("cid", "pos", "kind")
    return stream.mapInPandas(_digests, "cid string, digest string")


def audited(rows: DataFrame, ids: DataFrame, id_col: str = "conv_id", *, block: int = BLOCK) -> DataFrame:
    """One row for each id of ids: gaps, faults, the cheapest repair's cost and audit, and the digest of what it keeps."""
    placed, blocks = _edited(rows, block)
    turns = placed.select("cid", "turn").distinct().groupBy("cid").agg(F.max("turn").alias("high"), F.min("turn").alias("low"), F.count("turn").alias("n"))
    gaps = turns.select("cid", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("n"), F.lit(0)).cast("long").alias("gaps"))
    # pairs of the last row of a block and the first of the next one
    ends = blocks.select("cid", "block", F.right("code", F.lit(1)).alias("code"))
    after = blocks.select("cid", (F.col("block") - 1).alias("block"), F.left("code", F.lit(1)).alias("next"))
    kind = lambda c: F.floor((F.ascii(c) - 65) / 4)
    across = ends.join(after, ["cid", "block"]).select("cid", F.lit(None).cast("string").alias("detail"), (~(kind("code") * 4 + kind("next")).isin(1, 6, 9)).cast("long").alias("illegal"))
    per = blocks.select("cid", "block", "pos", "blank", "duplicate", "truncated", "cost", "detail", "illegal").unionByName(across, allowMissingColumns=True)
    edits = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("detail").isNotNull(), F.struct("pos", "detail")))), lambda x: x["detail"]), "")
    sums = [F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal")]
    found = per.groupBy("cid").agg(*sums, F.min_by("cost", "pos").alias("cost"), F.translate(edits, DETAIL, AUDIT).alias("audit"))
    every = ids.select(id_col).distinct().withColumn("cid", _cid(id_col))
    out = every.join(found, "cid", "left").join(gaps, "cid", "left").join(_repaired_digests(placed, blocks), "cid", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(id_col, *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", F.lit(DIGEST_OF_NOTHING)).alias("repaired_sha256"))


def repair_audit(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", *, block: int = BLOCK) -> DataFrame:
    """One row for each id of rows, damaged as `damaged` says: id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows go by turn, null turns first; rows of one turn by role and text. Nulls
    of role and text are one space, so a null text is blank and a null role
    must be changed; a null id is a conversation of its own. Roles count by
    their first letter. Repeated rows are duplicates from the second on. An id
    of which the damage leaves no row has zeros, an empty audit and the digest
    of an empty text; an empty table gives no rows. Other columns play no part.
    """
    return audited(damaged(rows, id_col, turn_col, role_col, text_col), rows, id_col, block=block)


def repaired(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", *, block: int = BLOCK) -> DataFrame:
    """The repaired rows themselves, undamaged input: id, place (from 0 on, with gaps where rows were deleted), sub, turn (null for inserted rows), role, text.

    Cases as in `repair_audit`; conversations of which nothing stays give no rows.
    """
    placed, blocks = _edited(undamaged(rows, id_col, turn_col, role_col, text_col), block)
    # edits of a block by row: all inserts before the row, then what happens to it; the last piece has inserts only
    pieces = F.regexp_extract_all("detail", F.lit("[ij]*[dkrs]|[ij]+$"), F.lit(0))
    steps = blocks.select("cid", F.col("pos").alias("first"), F.posexplode(pieces).alias("i", "piece"))
    each = steps.select("cid", (F.col("first") + F.col("i")).alias("pos"), F.posexplode(F.split("piece", "")).alias("sub", "edit")).filter("edit <> '' AND edit <> 'd'")
    new = F.col("edit").isin("i", "j")
    out = each.join(placed.select(F.col("pos").alias("p"), F.col("cid").alias("c"), "turn", "role", "text"), (F.col("pos") == F.col("p")) & (F.col("cid") == F.col("c")) & ~new, "left")
    role = F.when(F.col("edit").isin("i", "r"), "user").when(F.col("edit").isin("j", "s"), "assistant").otherwise(F.col("role"))
    ids = rows.select(id_col).distinct().withColumn("k", _cid(id_col))
    return out.join(ids, F.col("cid") == F.col("k")).select(id_col, F.col("pos").alias("place"), "sub", "turn", role.alias("role"), F.when(new, "").otherwise(F.col("text")).alias("text"))


def op11_sql() -> str:
    """The same by a recursion over rows that keeps the cheapest edits, of equal ones the least, for each state of the roles."""
    add = lambda s, cost, letter, piece=None: f"CASE WHEN {s} IS NOT NULL THEN {{'c': {s}.c + {cost}, 'a': {s}.a || '{letter}', 't': " + (f"list_append({s}.t, {piece})" if piece else f"{s}.t") + "} END"
    least = lambda *s: f"list_min([{', '.join(s)}])"
    user, assistant = (lambda s: add(s, INSERT, "I", "'user:'")), (lambda s: add(s, INSERT, "I", "'assistant:'"))
    kept = lambda s, initial: f"CASE WHEN NOT must AND initial = '{initial}' THEN {add(s, 'trunc', 'K', 'role || chr(58) || text')} END"
    renamed = lambda s, role: f"CASE WHEN NOT must THEN {add(s, f'trunc + {REROLE}', 'R', f'''{role!r} || chr(58) || text''')} END"
    gone = lambda s: add(s, DELETE, "D")
    return f"""
WITH RECURSIVE w AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
b AS (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(key) + 1), lambda i: CAST(ascii(key[i]) AS BIGINT))),
    lambda s, x: list_reduce(list_prepend(xor(s, x), range(8)), lambda v, _: xor(v >> 1, 3988292384 * (v & 1))))) % 20 AS harm FROM w),
d AS (SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN harm = 1 THEN '' WHEN harm = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN harm = 3 THEN [0, 1] ELSE [0] END) AS copy FROM b WHERE harm <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM d),
f AS (SELECT *, left(role, 1) AS initial, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM n),
r AS MATERIALIZED (SELECT *, blank OR duplicate AS must, NOT blank AND NOT duplicate AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated,
    CASE WHEN NOT blank AND NOT duplicate AND right(bare, 1) NOT IN ('.', '!', '?') THEN {TRUNCATED} ELSE 0 END AS trunc FROM f),
p AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': '', 't': CAST([] AS VARCHAR[])}} AS x0, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, t VARCHAR[])) AS x1,
        CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, t VARCHAR[])) AS x2, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, t VARCHAR[])) AS x3 FROM (SELECT DISTINCT conv_id FROM r)
    UNION ALL
    SELECT conv_id, i, {gone("y0")}, {least(gone("y1"), kept("y0", "s"))},
        {least(gone("y2"), *(kept(s, "u") for s in ("y0", "y1", "y3")), *(renamed(s, "user") for s in ("y0", "y1", "y3")))},
        {least(gone("y3"), kept("y2", "a"), renamed("y2", "assistant"))}
    FROM (SELECT conv_id, i, role, text, initial, must, trunc, x0 AS y0, x1 AS y1, {least("u2", user("x3"))} AS y2, {least("x3", assistant("u2"))} AS y3
          FROM (SELECT r.conv_id, r.i, role, text, initial, must, trunc, x0, x1, x3, {least("x2", user("x0"), user("x1"))} AS u2
                FROM p JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1))),
e AS (SELECT conv_id, {least("x0", "x3", assistant("x2"), assistant("u1"))} AS best
      FROM (SELECT p.*, {user("x1")} AS u1 FROM p JOIN (SELECT conv_id, count(*) AS n FROM r GROUP BY conv_id) k ON p.conv_id IS NOT DISTINCT FROM k.conv_id AND p.i = k.n)),
s AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
      count(*) FILTER (truncated) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id)
SELECT q.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
    CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
    coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) q LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM q.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM q.conv_id
"""
