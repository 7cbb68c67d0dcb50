"""Prefix trie of conversations, built as a burst trie.

Every turn becomes an entry of 24 bytes (128 bits of a digest and the length of
its text), a conversation the path of its entries. Equal paths are folded
first. A prefix that more than ``burst`` different paths share becomes a trie
head: its container is oversized and bursts by the next turn. All other
paths wait in the container below their last head; containers are dealt to
tasks by their key, sorted, and swept into nodes with a stack. Heads add up
what their containers and lower heads hold.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import functions as F

from catalogflow.session import materialize

ENTRY = 24  # bytes of a turn in a path
SHARE, HEADS = 5, 9  # fixed values: conversations of one donor, and the modulus of the turns taken from it
BURST = 1000
CHUNK = 8192  # conversation ids that are written together
SALTS = 64
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NODE_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
SWEPT = f"{NODE}, head binary, top boolean"
EMPTY = hashlib.sha256(b"").hexdigest()
OUT = 4096  # rows of a batch that a task sends


# --- paths ------------------------------------------------------------------


def paths(turns, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text"):
    """conv_id, path: the entries of each conversation's turns, by turn (null first) and then entry.

    Rows without a conversation take no part. A conversation is one row, with
    24 bytes for each turn; texts are not shuffled.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    name = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    size = F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0")
    turn = F.col(turn_col).cast("long")
    rows = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), turn.isNotNull().alias("some"), turn.alias("turn"),
        F.concat(F.substring(name, 1, 32), size).alias("entry"))
    sorted_turns = F.array_sort(F.collect_list(F.struct("some", F.coalesce("turn", F.lit(0)).alias("turn"), "entry")))
    joined = F.array_join(F.transform(sorted_turns, lambda t: t["entry"]), "")
    return rows.groupBy("conv_id").agg(F.unhex(joined).alias("path"))


def rebuilt(convs):
    """The path of each conversation after it took the first turns of its donor.

    Conversation c gets the first h turns of c - c % 5 (none if that does not
    exist) and keeps its own after its first h, with h = crc32(c) % 9.
    """
    donors = convs.filter(F.col("conv_id") % SHARE == 0).select(
        F.col("conv_id").alias("donor"), F.substring("path", 1, ENTRY * (HEADS - 1)).alias("lead"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % SHARE
    joined = convs.withColumns({"h": h, "base": base}).join(donors, F.col("base") == F.col("donor"), "left")
    lead = F.expr(f"coalesce(substring(lead, 1, h * {ENTRY}), X'')")
    return joined.select("conv_id", F.concat(lead, F.expr(f"substring(path, h * {ENTRY} + 1)")).alias("path"))


def _signed_ends(batches):
    """Folds sorted chunks of ids of each path: n, smallest id, hash of the comma-joined ids."""
    open_key, row, state, out = None, None, None, []

    def closed():
        return (*row, state.hexdigest())

    def batch_of(rows):
        kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.string()]
        names = ["seq", "path", "n", "conv_id", "ends"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for r in batch.to_pylist():
            if r["seq"] != open_key:
                if row:
                    out.append(closed())
                open_key, row, state = r["seq"], [r["seq"], r["path"], 0, r["first"]], hashlib.sha256()
            else:
                state.update(b",")
            state.update(r["ids"].encode())
            row[2] += r["n"]
        if len(out) >= OUT:
            yield batch_of(out)
            out = []
    if row:
        out.append(closed())
    if out:
        yield batch_of(out)


def folded(convs):
    """One row per distinct path: seq (its digest), path, n, conv_id (smallest), ends (hash of the ids).

    Ids are first written together in chunks of neighbouring ids, so the task
    of a path that a third of all conversations have streams few rows.
    """
    seq = F.unhex(F.sha2("path", 256))
    chunk = F.floor(F.col("conv_id") / F.lit(CHUNK))
    ids = F.array_sort(F.collect_list("conv_id"))
    chunks = convs.groupBy(seq.alias("seq"), chunk.alias("chunk")).agg(
        F.first("path").alias("path"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"),
        F.array_join(F.transform(ids, lambda i: i.cast("string")), ",").alias("ids"))
    ordered = chunks.repartition("seq").sortWithinPartitions("seq", "first")
    return ordered.select("seq", "path", "n", "first", "ids").mapInArrow(
        _signed_ends, "seq binary, path binary, n long, conv_id long, ends string")


# --- bursting ---------------------------------------------------------------


def _prefix(depth):
    return F.unhex(F.md5(F.substring("path", F.lit(1), depth * ENTRY)))


def _burst_round(waiting, low, high, burst):
    """Count the prefixes of depth low+1..high; those that more than ``burst`` paths share are heads."""
    depths = F.sequence(F.lit(low + 1), F.least(F.lit(high), F.col("len")))
    rows = waiting.filter(F.col("len") > low).select("seq", "path", "len", "n", "conv_id", "ends", F.explode(depths).alias("d"))
    rows = rows.withColumn("key", _prefix(F.col("d"))).withColumn("salt", F.pmod(F.xxhash64("seq"), F.lit(SALTS)))
    counted = rows.groupBy("key", F.col("d").alias("depth")).agg(
        F.count(F.lit(1)).alias("paths"), F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.max(F.when(F.col("len") == F.col("d"), F.col("ends"))).alias("ends"), F.first("path").alias("path"))
    heads = counted.filter(F.col("paths") > burst).withColumn("path", F.substring("path", F.lit(1), F.col("depth") * ENTRY))
    heads = materialize(heads, "heads")
    # a hot prefix has rows of many salts, each of which meets a copy of the head
    copies = heads.select("key", F.col("conv_id").alias("head_conv"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    found = rows.select("seq", "d", "key", "salt").join(copies, ["key", "salt"]).groupBy(F.col("seq").alias("_seq")).agg(
        F.max(F.struct("d", "key", "head_conv")).alias("last"))
    return heads, found


def burst_heads(folds, burst=BURST):
    """(paths with the head above their container, heads); no head is the root.

    Rounds look at 1, 2, 4, ... more levels, and only at the paths whose
    container is still oversized.
    """
    none = F.lit(None)
    waiting = folds.withColumns({"len": (F.length("path") / ENTRY).cast("int"), "at": F.lit(0), "head": none.cast("binary"),
                                 "head_conv": none.cast("long")})
    settled, heads, low, width = None, None, 0, 1
    while True:
        high = low + width
        more, found = _burst_round(waiting, low, high, burst)
        joined = waiting.join(found, F.col("seq") == F.col("_seq"), "left")
        step = joined.select(
            *folds.columns, "len", F.coalesce("last.d", "at").alias("at"), F.coalesce("last.key", "head").alias("head"),
            F.coalesce("last.head_conv", "head_conv").alias("head_conv"))
        step = materialize(step, "burst")
        is_open = (F.col("at") == high) & (F.col("len") > high)
        done = step.filter(~is_open)
        settled = done if settled is None else settled.unionByName(done)
        heads = more if heads is None else heads.unionByName(more)
        waiting = step.filter(is_open)
        if waiting.isEmpty():
            return settled, heads
        low, width = high, 2 * width


# --- sweeping ---------------------------------------------------------------


class _Sweep:
    """Turns sorted paths of one container into nodes.

    A node is sent when its parent closes, because only then the parent's
    smallest member is known; a container bounds what waits.
    """

    def __init__(self):
        self.stack, self.out, self.key, self.path = [], [], None, b""

    def _close(self):
        depth, n, conv, size, children, leaves, saved, ends, head = self.stack.pop()
        leaves, saved = leaves or 1, saved + (n - 1) * size
        for child in children:
            self.out.append((child[0], child[1], conv, *child[2:], None, False))
        mine = (conv, depth, n, len(children), leaves, saved, ends)
        if self.stack:
            up = self.stack[-1]
            up[1] += n
            up[2] = conv if up[2] is None else min(up[2], conv)
            up[4].append(mine)
            up[5] += leaves
            up[6] += saved
        else:
            key, head_conv = head
            self.out.append((conv, depth, head_conv, *mine[2:], key, True))

    def close_to(self, count):
        while len(self.stack) > count:
            self._close()

    def add(self, r):
        path, at, key = r["path"], r["at"], r["container"]
        if key != self.key:
            self.close_to(0)
            self.key, self.path = key, path[: at * ENTRY]
        same, most = len(self.stack) * ENTRY + at * ENTRY, min(len(path), len(self.path))
        common = at * ENTRY
        while common < min(same, most) and path[common : common + ENTRY] == self.path[common : common + ENTRY]:
            common += ENTRY
        self.close_to(common // ENTRY - at)
        for start in range(common, len(path), ENTRY):
            size = int.from_bytes(path[start + 16 : start + ENTRY], "big")
            head = (r["head"], r["head_conv"])
            self.stack.append([start // ENTRY + 1, 0, None, size, [], 0, 0, EMPTY, head])
        top = self.stack[-1]
        top[1], top[2], top[7] = r["n"], r["conv_id"], r["ends"]
        self.path = path

    def sent(self):
        columns = [pa.array(c, t) for c, t in zip(zip(*self.out), [*NODE_TYPES, pa.binary(), pa.bool_()])]
        self.out = []
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SWEPT.split(", ")])


def _sweep(batches):
    sweep = _Sweep()
    for batch in batches:
        for r in batch.to_pylist():
            sweep.add(r)
            if len(sweep.out) >= OUT:
                yield sweep.sent()
    sweep.close_to(0)
    if sweep.out:
        yield sweep.sent()


def swept(settled):
    """The nodes of all containers; ``top`` marks those right below a head (null: the root)."""
    rows = settled.filter("len > at").withColumn("container", _prefix(F.col("at") + 1))
    dealt = rows.repartition("container").sortWithinPartitions("container", "path")
    return dealt.select("container", "path", "at", "head", "head_conv", "n", "conv_id", "ends").mapInArrow(_sweep, SWEPT)


def _head_nodes(heads, nodes, folds):
    """The heads and the root, with what their containers and lower heads hold."""
    size = F.conv(F.hex(F.expr(f"substring(path, (depth - 1) * {ENTRY} + 17, 8)")), 16, 10).cast("long")
    root = folds.groupBy().agg(
        F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.max(F.when(F.length("path") == 0, F.col("ends"))).alias("ends")).filter("n_convs is not null")
    root = root.select(F.lit(b"").alias("key"), F.lit(0).alias("depth"), "n_convs", "conv_id", "ends", F.lit(b"").alias("path"),
                       F.lit(0).cast("long").alias("own"))
    all_heads = heads.select("key", "depth", "n_convs", "conv_id", "ends", "path", ((F.col("n_convs") - 1) * size).alias("own"))
    all_heads = materialize(all_heads.unionByName(root), "trie-heads")
    tops = nodes.filter("top").groupBy(F.coalesce("head", F.lit(b"")).alias("_key")).agg(
        F.count(F.lit(1)).alias("n_tops"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    above = F.transform(F.sequence(F.lit(0), F.col("depth")), lambda j: F.struct(j.alias("d"), F.when(j == 0, F.lit(b"")).otherwise(
        _prefix(j)).alias("key")))
    held = all_heads.join(tops, F.col("key") == F.col("_key"), "left").select(
        "depth", F.coalesce("n_tops", F.lit(0)).alias("n_tops"), F.coalesce("leaves", F.lit(0)).alias("leaves"),
        (F.coalesce("saved", F.lit(0)) + F.col("own")).alias("saved"), F.explode(above).alias("up"))
    gap = F.col("depth") - F.col("up.d")
    sums = held.groupBy(F.col("up.key").alias("_key")).agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
        F.sum(F.when(gap == 0, F.col("n_tops")).when(gap == 1, 1).otherwise(0)).alias("n_children"))
    rows = all_heads.withColumn("up", F.when(F.col("depth") == 1, F.lit(b"")).when(F.col("depth") > 1, _prefix(F.col("depth") - 1)))
    parents = all_heads.select(F.col("key").alias("_up"), F.col("conv_id").alias("parent_conv_id"))
    rows = rows.join(sums, F.col("key") == F.col("_key")).join(parents, F.col("up") == F.col("_up"), "left")
    # the root of a trie without turns is its own leaf
    return rows.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), "saved_tokens", F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"))


def trie(convs, burst=BURST):
    """One row per node of the prefix trie of ``convs`` (conv_id, path as in ``paths``).

    conv_id (smallest member), depth, parent_conv_id, n_convs (members),
    n_children, n_leaves, saved_tokens (bytes that shared prefixes save in the
    subtree) and ends_sha256 (ids of the members that end here). No
    conversations give no nodes; conversations without turns are members of the root.
    """
    folds = materialize(folded(convs), "folded")
    settled, heads = burst_heads(folds, burst)
    nodes = materialize(swept(settled), "nodes")
    # members of the root wait in containers without a head
    low = folds.agg(F.min("conv_id")).first()[0]
    plain = nodes.select(
        "conv_id", "depth",
        F.when(F.col("top") & F.col("head").isNull(), F.lit(low).cast("long")).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return _head_nodes(heads, nodes, folds).unionByName(plain)


def conversation_trie(turns, burst=BURST, **columns):
    """The trie of the rebuilt conversations of a table of turns.

    Turns are ordered by number, null first; equal numbers by digest, so
    repeated rows are repeated turns. A null role or text is empty; rows
    without a conversation take no part; an empty table gives no rows. Texts of
    any length become 24 bytes before the first shuffle. Other columns are left
    out, so none of them can clash.
    """
    return trie(rebuilt(materialize(paths(turns, **columns), "paths")), burst)

