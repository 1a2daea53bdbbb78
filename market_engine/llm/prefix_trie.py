"""Conversation prefix trie, built by bursting.

A conversation is the sequence of its turns; a turn's id is 128 bits of the SHA-256 of its role and text, so
a sequence is one binary ``path`` of 16 bytes a turn, and its order as bytes is its order turn by turn. Equal
sequences are one row with their number and smallest conversation (``distinct_sequences``), so copies of one
conversation are summed before anything moves.

Burst trie: sequences with a common prefix lie in one container under that prefix. A container of more than
``capacity`` sequences bursts: what all of them share (the common prefix of its smallest and its largest
path) becomes a trie head, and its sequences go on to containers of their own by their next turn id. The
root always bursts. Rounds go on until no container is too large; each takes a whole common prefix at once, so
a long one costs no more rounds than a short one. The remaining containers are dealt out by prefix, sorted by
path and swept: neighbours' common prefixes open and close nodes on a stack. What a container's top node
sums up is added to all heads above it.

Defined results: null roles and texts are empty, turns come in the order of ``turn`` (null first), of equal
ones in that of their ids; repeated rows are turns of their own; rows with a null conversation id are left
out; a conversation without turns ends at the root; other columns are ignored; an empty table has no nodes.

What must fit a task: a container's nodes (``capacity`` sequences) and the turn ids of one conversation (16
bytes and a number a turn, never the texts). A node's list of conversations is hashed as a stream.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from market_engine.llm.common import stored

#: Bytes of a turn's id in a path.
ID = 16
#: Conversations (by id) whose ids are joined to one text before they are hashed: 2 ** CHUNK_BITS.
CHUNK_BITS = 16
_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends long, heads array<binary>")


def sequences(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (id in hex, code points of the text)."""
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    said = F.sha2(F.concat(F.char_length(r).cast("string"), F.lit(":"), r, t).cast("binary"), 256)
    rows = conversations.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
                                F.substring(said, 1, 2 * ID).alias("id"), F.char_length(t).alias("n"))
    turns = F.sort_array(F.collect_list(F.struct("turn", "id", "n")))
    return rows.filter("conv_id is not null").groupBy("conv_id").agg(turns.alias("turns")).select(
        "conv_id", F.transform("turns", lambda x: F.struct(x["id"].alias("id"), x["n"].alias("n"))).alias("turns"))


def regrown(seqs: DataFrame, block: int = 100, most: int = 5) -> DataFrame:
    """``seqs`` with the first h turns of c replaced by the first h (all if fewer, none if absent) of conversation
    c - c % block; h = crc32(c in decimal) % (most + 1)."""
    first = seqs.filter(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("first_id"), F.slice("turns", 1, most).alias("lead"))
    both = seqs.join(first, F.col("conv_id") - F.col("conv_id") % block == F.col("first_id"), "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    both = both.withColumn("h", h)
    lead = F.slice(F.coalesce("lead", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return both.select("conv_id", F.concat(lead, own).alias("turns"))


def _paths(seqs: DataFrame) -> DataFrame:
    return seqs.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda x: x["id"]), "")).alias("path"),
                       F.transform("turns", lambda x: x["n"]).alias("sizes"))


def distinct_sequences(paths: DataFrame) -> DataFrame:
    """(path, sizes, n, conv_id): each sequence once, with its number of conversations and the smallest."""
    return paths.groupBy("path").agg(F.first("sizes").alias("sizes"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))


def _hash_ends(batches):
    of, first, state = None, None, None
    for batch in batches:
        done = []
        for key, low, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if key == of:
                state.update(b",")
            else:
                if of is not None:
                    done.append((first, state.hexdigest()))
                of, first, state = key, low, hashlib.sha256()
            state.update(ids.encode())
        if done:
            yield _ends_batch(done)
    if of is not None:
        yield _ends_batch([(first, state.hexdigest())])


def _ends_batch(rows):
    ids, digests = zip(*rows)
    return pa.record_batch([pa.array(ids, pa.int64()), pa.array(digests, pa.string())], names=["ends", "ends_sha256"])


def end_digests(paths: DataFrame) -> DataFrame:
    """(ends, ends_sha256): for each distinct sequence, named by its smallest conversation, the digest of the ids of all
    of its conversations in order. Ids are first joined in ranges, so a sequence of very many comes as few rows."""
    part = paths.groupBy(F.sha2("path", 256).alias("key"), F.shiftright("conv_id", CHUNK_BITS).alias("part")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids"))
    rows = part.select("key", "part", F.col("ids")[0].alias("low"), F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
    return rows.repartition("key").sortWithinPartitions("key", "part").select("key", "low", "ids").mapInArrow(
        _hash_ends, "ends long, ends_sha256 string")


class _Container:
    """Nodes of one container, from its sequences in order."""

    def __init__(self, depth: int, heads: list[bytes], head_conv: int | None):
        self.depth, self.heads, self.head_conv = depth, heads, head_conv
        self.path = b""
        self.open: list[int] = []
        self.at: list[int] = []
        self.parent: list[int] = []
        self.size: list[int] = []
        self.conv: list[int | None] = []
        self.convs: list[int] = []
        self.children: list[int] = []
        self.ends: list[int | None] = []

    def add(self, path: bytes, sizes: list[int], n: int, conv: int) -> None:
        if self.open:
            i, top = ID * self.depth, min(len(path), len(self.path))
            while i < top and path[i:i + ID] == self.path[i:i + ID]:
                i += ID
            del self.open[i // ID - self.depth + 1:]
        for d in range(self.depth + len(self.open), len(path) // ID + 1):
            self.parent.append(self.open[-1] if self.open else -1)
            if self.open:
                self.children[self.open[-1]] += 1
            self.open.append(len(self.at))
            self.at.append(d)
            self.size.append(sizes[d - 1])
            self.conv.append(None)
            self.convs.append(0)
            self.children.append(0)
            self.ends.append(None)
        last = self.open[-1]
        self.conv[last], self.convs[last], self.ends[last] = conv, n, conv
        self.path = path

    def rows(self) -> list[tuple]:
        leaves, saved = [0] * len(self.at), [0] * len(self.at)
        for i in range(len(self.at) - 1, -1, -1):  # a node stands after its parent
            leaves[i] = leaves[i] or 1
            saved[i] += (self.convs[i] - 1) * self.size[i]
            p = self.parent[i]
            if p >= 0:
                self.convs[p] += self.convs[i]
                self.conv[p] = self.conv[i] if self.conv[p] is None else min(self.conv[p], self.conv[i])
                leaves[p] += leaves[i]
                saved[p] += saved[i]
        above = [self.head_conv if p < 0 else self.conv[p] for p in self.parent]
        tops = [self.heads if p < 0 else None for p in self.parent]
        return list(zip(self.conv, self.at, above, self.convs, self.children, leaves, saved, self.ends, tops))


def _sweep(batches):
    types = [pa.int64()] * 8 + [pa.list_(pa.binary())]
    names = [c.split()[0] for c in _NODE.split(", ")]

    def batch_of(rows):
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    of, box, rows = None, None, []
    for batch in batches:
        for key, depth, heads, head_conv, path, sizes, n, conv in zip(*(batch.column(i).to_pylist() for i in range(8))):
            if key != of:
                rows += box.rows() if box else []
                of, box = key, _Container(depth, heads, head_conv)
                if len(rows) > 10_000:
                    yield batch_of(rows)
                    rows = []
            box.add(path, sizes, n, conv)
    rows += box.rows() if box else []
    if rows:
        yield batch_of(rows)


def _key(length: str):
    """Name of the container of a path's first ``length`` turns."""
    return F.unhex(F.substring(F.sha2(F.expr(f"substring(path, 1, {ID} * ({length}))"), 256), 1, 2 * ID))


def _shared(lo: str, hi: str):
    """Number of turns that two paths share at their beginning."""
    least = F.least(F.octet_length(lo), F.octet_length(hi)) / ID
    differ = F.expr(f"transform(sequence(0, cast(least(octet_length({lo}), octet_length({hi})) / {ID} as int)),"
                    f" i -> substring({lo}, {ID} * i + 1, {ID}) <> substring({hi}, {ID} * i + 1, {ID}))")
    at = F.array_position(differ, F.lit(True))
    return F.when(at > 0, at - 1).otherwise(least).cast("int")


def burst(distinct: DataFrame, capacity: int) -> tuple[DataFrame, DataFrame]:
    """(heads, swept): the heads of burst containers, and the nodes of all others."""
    live = stored(distinct.withColumn("depth", F.lit(0)).withColumn("key", _key("0")).withColumns(
        {"heads": F.array().cast("array<binary>"), "head_conv": F.lit(None).cast("long")}), "sequences")
    heads = small = None
    while True:
        found = live.groupBy("key").agg(
            F.count(F.lit(1)).alias("c"), F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("path").alias("hi"),
            F.min(F.struct("path", "sizes", "depth", "heads", "head_conv", F.col("conv_id").alias("own"))).alias("lo"))
        big = found if heads is None else found.filter(F.col("c") > capacity)
        big = big.select("key", "n_convs", "conv_id", "lo", "hi").withColumn("bottom", _shared("lo.path", "hi"))
        big = stored(big.select(
            "key", "conv_id", "n_convs", "lo.depth", "bottom", "lo.heads", "lo.head_conv",
            F.slice("lo.sizes", F.greatest(F.col("lo.depth"), F.lit(1)), F.col("bottom") - F.greatest(F.col("lo.depth"), F.lit(1)) + 1).alias("sizes"),
            F.when(F.octet_length("lo.path") == ID * F.col("bottom"), F.col("lo.own")).alias("ends")), "heads")
        keep = live if heads is not None and big.isEmpty() else live.join(big.select("key"), "key", "left_anti")
        small = keep if small is None else small.unionByName(keep)
        if heads is not None and keep is live:
            break
        heads = big if heads is None else heads.unionByName(big)
        to = big.select("key", "bottom", F.col("conv_id").alias("top_conv"))
        live = stored(live.join(to, "key").filter(F.octet_length("path") > ID * F.col("bottom")).select(
            "path", "sizes", "n", "conv_id", (F.col("bottom") + 1).alias("depth"), _key("bottom + 1").alias("key"),
            F.array_append("heads", F.col("key")).alias("heads"), F.col("top_conv").alias("head_conv")), "sequences")
    swept = small.select("key", "depth", "heads", "head_conv", "path", "sizes", "n", "conv_id").repartition(
        "key").sortWithinPartitions("key", "path").mapInArrow(_sweep, _NODE)
    return heads, stored(swept, "nodes")


def _head_nodes(heads: DataFrame, swept: DataFrame) -> DataFrame:
    """The nodes of the heads: each is a chain of the turns that all of its container share."""
    own = (F.col("n_convs") - 1) * F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    parts = swept.filter("heads is not null").select("heads", "n_leaves", "saved_tokens").unionByName(
        heads.select("heads", F.lit(0).cast("long").alias("n_leaves"), own.alias("saved_tokens")))
    each = parts.select(F.posexplode("heads").alias("i", "key"), F.size("heads").alias("of"), "n_leaves", "saved_tokens")
    below = each.groupBy("key").agg(F.count(F.when(F.col("i") == F.col("of") - 1, F.lit(1))).alias("n_children"),
                                    F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"))
    rows = heads.join(below, "key", "left").na.fill(0, ["n_children", "n_leaves", "below"])
    chain = rows.withColumn("sizes", F.when(F.col("depth") == 0, F.concat(F.array(F.lit(0)), "sizes")).otherwise(F.col("sizes")))
    chain = chain.select("*", F.posexplode("sizes").alias("i", "size")).withColumn("at", (F.col("depth") + F.col("i")).cast("long"))
    bottom = F.col("at") == F.col("bottom")
    upward = Window.partitionBy("key").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, 0)
    return chain.select(
        "conv_id", F.col("at").alias("depth"), F.when(F.col("i") == 0, F.col("head_conv")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs", F.when(bottom, F.col("n_children")).otherwise(1).alias("n_children"),
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
        (F.col("below") + (F.col("n_convs") - 1) * F.sum("size").over(upward)).alias("saved_tokens"),
        F.when(bottom, F.col("ends")).alias("ends"))


def prefix_trie(seqs: DataFrame, capacity: int = 256) -> DataFrame:
    """The nodes of the trie of (conv_id, turns): conv_id (smallest member), depth, parent_conv_id (null at the root),
    n_convs, n_children, n_leaves, saved_tokens (code points that members beyond the first repeat, in the whole subtree),
    ends_sha256 (digest of the conversations that end there)."""
    paths = stored(_paths(seqs), "paths")
    heads, swept = burst(distinct_sequences(paths), capacity)
    nodes = stored(_head_nodes(heads, swept).unionByName(swept.drop("heads")), "trie")
    none = F.lit(hashlib.sha256(b"").hexdigest()).alias("ends_sha256")
    ended = nodes.filter("ends is not null").join(end_digests(paths), "ends")
    return ended.drop("ends").unionByName(nodes.filter("ends is null").drop("ends").withColumn("ends_sha256", none))
