"""N-gram Jaccard join with parity sketches.

A text's set holds its distinct shingles of ``words`` consecutive words. Sets A and B with Jaccard of
``percent`` / 100 or more differ in at most D = (|A| + |B|) (100 - percent) / (100 + percent) shingles.

Sketch: shingle hashes are dealt by their leading bits to P blocks, and each block is the XOR of its
shingles' 64-bit hashes. A shingle that only one of two sets has changes one block, so the number of
unequal blocks (the Hamming distance over blocks) is a lower bound on the symmetric difference, and
shared shingles cancel out of it. Size bands fix P: a band's pairs have their smaller set in the band,
and P = D + 1 + spare blocks for the band's largest D. By the pigeonhole principle at least
1 + spare blocks of such a pair are equal. Blocks without a shingle say little, so they are left out
of the join as long as a set has at most ``spare`` of them: one equal block with shingles is then left.
A set with more joins on its empty blocks too, and so still meets any other such set.

The join goes by (band, block, XOR) in one exchange: a window over the sorted keys gives each member its group's
smallest, the pivot. A group is a row of 16 bytes a document at most, and its window spills. Texts with the same set
are one class: of those in one task only the first is dealt out, so exact copies cost one row a task. A similar pair agrees
in many of a band's blocks, not in one: a set that meets others in fewer than it must (``_needs``) leaves the band before
pivots are chosen, as do most texts that only have a passage in common. Each group is compared with its pivot. A pair is verified
in two steps: a second sketch of four bits a shingle, whose Hamming distance again is a lower bound, drops most pairs
before any text moves; the others are told on their whole sets.

Where a key's members still are of several components, those with too many shingles that no other such member has
are done (``_not_alone``). The others are joined by what differs between them and the pivot (``_meet``): members without
a common difference by their one nearest, the others by each common difference. Such a group is compared member by member (few first: a
member's level is the number of trailing zeros of its hash) until no two of it are left that are neither
connected nor compared. No link is lost, and a large group of copies with edits of their own costs rows, not pairs.

Shingles are 64-bit hashes; a word's hash mixes its bytes, eight at a time, with their places in two ways. Classes are
told by two digests of sets made from word hashes of two kinds.

Defined results: a null or blank text has no set, is linked with nothing and its component is its own
id; fewer words than ``words`` make one shingle of all; rows that repeat a doc_id are one node; rows
with a null id are linked with nothing; other columns are ignored; empty tables give empty tables.
"""

from __future__ import annotations

import math
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from market_engine.llm import hashing as H
from market_engine.llm.common import drop_stored, stored, worker_of
from market_engine.llm.components import components
from market_engine.llm.packing import pack, unpack_slices

#: Ratio of the sizes that bound a band.
BAND_RATIO = 1.5
#: Pairs that a round of pivots compares at most per member row, unless one level alone needs more.
PAIRS_PER_ROW = 4
#: Distinct sets that a task remembers, so as to deal out copies once.
SEEN = 100_000
#: Bytes of a batch of texts that goes to a worker.
BATCH = 4 << 20


def most_different(a: int, b: int, percent: int) -> int:
    """Largest symmetric difference of sets of sizes a and b at a Jaccard of percent / 100."""
    return (a + b) * (100 - percent) // (100 + percent)


def bands(percent: int, largest: int) -> list[tuple[int, int, int, int]]:
    """(first size, size after the last, P, spare) of all bands up to ``largest``; P is 0 where sets must
    be equal."""
    out, lo = [], 1
    while lo <= largest:
        hi = max(lo + 1, math.ceil(lo * BAND_RATIO))
        d = max(most_different(a, a * 100 // percent, percent) for a in (hi - 1, lo))
        p = spare = 0
        if d:
            while spare < max(1, d // 2):  # more than that makes emptier blocks; any number is correct
                empty = (d + 1 + spare) * math.exp(-lo / (d + 1 + spare))
                if math.ceil(empty + 4 * math.sqrt(empty)) <= spare:
                    break
                spare += 1
            p = d + 1 + spare
        out.append((lo, hi, p, spare))
        lo = hi
    return out


def _sets(column, words: int, kind: int = 0):
    """Yields the sorted distinct shingle hashes of a string column's texts, one after the other."""
    worker_of("parity_join")
    data, offsets = H.text_bytes(column)
    for i, j in H.doc_groups(offsets):
        own = H.ASCII_LOWER[data[offsets[i]:offsets[j]]]
        starts, ends, first = H.word_places(own, offsets[i:j + 1] - offsets[i])
        seq = H.Sequences(H.word_hashes(own, starts, ends, kind), words + 100 * kind)
        grams = seq.all(words)
        for d in range(j - i):
            lo, hi = int(first[d]), int(first[d + 1])
            if hi - lo >= words:
                yield np.unique(grams[lo:hi - words + 1])
            elif hi > lo:
                yield seq.hash(np.array([lo]), np.array([hi]))
            else:
                yield np.zeros(0, np.uint64)


def _digest(s: np.ndarray) -> int:
    """64-bit digest of a set (order does not matter)."""
    return int(H.mix(s).sum(dtype=np.uint64).view(np.int64))


def _joined(n: int, percent: int, known: list) -> list[tuple[int, tuple[int, int, int, int]]]:
    """The bands, with their numbers, that a set of size n joins in; ``known`` has all bands so far."""
    if n and (not known or n >= known[-1][1]):
        known[:] = bands(percent, 2 * n)
    least = -(-n * percent // 100)  # smallest partner's size
    return [(b, x) for b, x in enumerate(known) if x[2] and x[0] <= n and x[1] > least]


def _needs(s: np.ndarray, percent: int, known: list) -> list[int]:
    """For each band that a set joins in, the least number of keys that it has in common with a similar set there, and
    the band: all blocks but one for each difference, and but those that are left out as empty in both."""
    out, n = [], len(s)
    for b, (_, hi, p, spare) in _joined(n, percent, known):
        most = most_different(n, n * 100 // percent if n < hi else hi - 1, percent)
        full = np.count_nonzero(np.diff(_block_of(s, p).astype(np.int64))) + 1
        out.append(p - most - min(p - full, spare) << 6 | b & 63)
    return out


def _classes(words: int, percent: int):
    """Size of each text's set, two digests of it, from word hashes of two kinds, and what it needs in its bands."""
    def work(batches):
        known: list[tuple[int, int, int, int]] = []
        for batch in batches:
            rows = [(len(s), _digest(s), _digest(t), _needs(s, percent, known))
                    for s, t in zip(_sets(batch.column(1), words), _sets(batch.column(1), words, 1))]
            n, c1, c2, needs = zip(*rows) if rows else ((), (), (), ())
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(c1, pa.int64()), pa.array(c2, pa.int64()),
                                   pa.array(needs, pa.list_(pa.int64()))], names=["doc_id", "n", "c1", "c2", "needs"])
    return work


def _block_of(s: np.ndarray, p: int) -> np.ndarray:
    return ((s >> np.uint64(32)) * np.uint64(p)) >> np.uint64(32)


def _blocks(s: np.ndarray, p: int, spare: int, band: int) -> np.ndarray:
    """Join keys of a set's sketch in a band of p blocks; their last six bits are the band's."""
    block = _block_of(s, p)  # s is sorted, so blocks are runs
    heads = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    at, xor = block[heads], np.bitwise_xor.reduceat(H.mix(s), heads)
    if p - len(heads) > spare:
        every = np.zeros(p, np.uint64)
        every[at.astype(np.int64)] = xor
        at, xor = np.arange(p, dtype=np.uint64), every
    return H.mix(xor ^ H.mix(at + np.uint64(band << 40))) & ~np.uint64(63) | np.uint64(band & 63)


def _keys(words: int, percent: int):
    def work(batches):
        seen: set[bytes] = set()
        known: list[tuple[int, int, int, int]] = []
        for batch in batches:
            ids = batch.column(0)
            at, keys, size = [], [], 0
            for r, s in enumerate(_sets(batch.column(1), words)):
                n = len(s)
                if not n or (c := blake2b(s.tobytes(), digest_size=16).digest()) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(c)
                for b, (_, _, p, spare) in _joined(n, percent, known):
                    keys.append(_blocks(s, p, spare, b))
                    at.append((r, len(keys[-1])))
                    size += len(keys[-1])
                if size > 1 << 18:
                    yield _key_batch(ids, at, keys)
                    at, keys, size = [], [], 0
            if at:
                yield _key_batch(ids, at, keys)
    return work


def _key_batch(ids, at, keys):
    row, n = (np.array(x, np.int64) for x in zip(*at))
    return pa.record_batch([pa.array(np.concatenate(keys).view(np.int64)), ids.take(pa.array(np.repeat(row, n)))],
                           names=["key", "doc_id"])


def _sketch(s: np.ndarray) -> np.ndarray:
    """Parity sketch of a set: every hash turns one bit round; at least four bits a hash, in numbers of 64 bits whose
    count is a power of two, so a longer sketch folds to a shorter one."""
    bits = 64 << max(0, (4 * len(s) - 1).bit_length() - 6)
    odd = np.bincount((H.mix(s ^ np.uint64(0x632BE59BD9B4E019)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def _sketches(words: int):
    def work(batches):
        for batch in batches:
            for i, j, (texts,) in unpack_slices([batch.column(1)], H.GROUP_BYTES):
                sets = list(_sets(texts, words))
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()), _lists(map(_sketch, sets), pa.int64())],
                                      names=["doc_id", "n", "sketch"])
    return work


def _lists(arrays, kind) -> pa.ListArray:
    arrays = list(arrays)
    at = np.append(0, np.cumsum([len(a) for a in arrays])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(arrays), kind))


def _shingles(words: int):
    """Rows (f, doc_id): the shingles of texts."""
    def work(batches):
        for batch in batches:
            for i, j, (texts,) in unpack_slices([batch.column(1)], H.GROUP_BYTES // 4):
                sets = list(_sets(texts, words))
                row = np.repeat(np.arange(i, j), [len(s) for s in sets])
                yield pa.record_batch([pa.array(np.concatenate(sets).view(np.int64)), batch.column(0).take(pa.array(row))], names=["f", "doc_id"])
    return work


def _both(words: int, columns):
    """Yields (row, row after the last, sets of the first column, sets of the second) of packed texts."""
    for i, j, (x, y) in unpack_slices(columns, H.GROUP_BYTES):
        yield i, j, list(_sets(x, words)), list(_sets(y, words))


def _alike(words: int, percent: int):
    """Of rows (a, b, packed_a, packed_b) those whose sets are similar enough."""
    def work(batches):
        for batch in batches:
            for i, j, xs, ys in _both(words, batch.columns[2:]):
                common = np.array([len(np.intersect1d(x, y, True)) for x, y in zip(xs, ys)])
                whole = np.array([len(x) + len(y) for x, y in zip(xs, ys)]) - common
                yield batch.slice(i, j - i).select(["a", "b"]).filter(pa.array(common * 100 >= whole * percent))
    return work


def _differing(words: int):
    """Of rows (pivot, doc_id, packed, packed_pivot): n and the shingles that only one of the two has."""
    def work(batches):
        for batch in batches:
            for i, j, xs, ys in _both(words, batch.columns[2:]):
                diff = _lists((np.setxor1d(x, y, True).view(np.int64) for x, y in zip(xs, ys)), pa.int64())
                own = batch.slice(i, j - i)
                yield pa.record_batch([own.column(0), own.column(1), pa.array([len(x) for x in xs], pa.int64()), diff],
                                      names=["pivot", "doc_id", "n", "diff"])
    return work


def _possible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches allow the similarity: a pair's sketches, folded to one length, differ in no
    more bits than its sets in shingles."""
    a, b = (sketches.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")) for x in "ab")
    both = pairs.join(a, "a").join(b, "b").filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    folded = "transform(sequence(1, m), i -> aggregate(sequence(0, cast(size({0}) div m as int) - 1), 0L, (x, j) -> x ^ element_at({0}, i + j * m)))"
    both = both.withColumn("m", F.least(F.size("sa"), F.size("sb")))
    apart = F.expr(f"aggregate(zip_with({folded.format('sa')}, {folded.format('sb')}, (x, y) -> bit_count(x ^ y)), 0, (t, x) -> t + x)")
    most = F.floor((F.col("na") + F.col("nb")) * (100 - percent) / (100 + percent))
    return both.filter(apart <= most).select("a", "b").distinct()


def _verified(pairs: DataFrame, sketches: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, told on the whole sets."""
    near = stored(_possible(pairs, sketches, percent), "possible")
    a, b = (texts.select(F.col("doc_id").alias(x), F.col("packed").alias(f"packed_{x}")) for x in "ab")
    out = stored(near.join(a, "a").join(b, "b").select("a", "b", "packed_a", "packed_b").mapInArrow(
        _alike(words, percent), "a long, b long"), "links", BATCH)
    drop_stored(near)
    return out


def _with_component(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with the component of doc_id; a node without links is its own."""
    return rows.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id"))


def _mixed(members: DataFrame, found: DataFrame) -> DataFrame:
    """The rows (key, pivot, doc_id) of keys whose members are of several components."""
    several = _with_component(members, found).groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("key")
    return members.join(several, "key").select("key", "pivot", "doc_id")


def _differences(stars: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Rows (pivot, doc_id, n, diff): the size of a member's set and its symmetric difference to the pivot's."""
    base = texts.select(F.col("doc_id").alias("pivot"), F.col("packed").alias("packed_pivot"))
    both = stars.join(texts, "doc_id").join(base, "pivot").select("pivot", "doc_id", "packed", "packed_pivot")
    return both.mapInArrow(_differing(words), "pivot long, doc_id long, n long, diff array<long>")


def _not_alone(docs: DataFrame, texts: DataFrame, sketches: DataFrame, words: int, percent: int) -> DataFrame:
    """Of ``docs`` (doc_id) those that share enough of their shingles with others of them to be similar to one: a text
    that only has a passage in common with others goes here, in one exchange."""
    one = texts.join(docs, "doc_id", "left_semi").mapInArrow(_shingles(words), "f long, doc_id long")
    own = one.groupBy("f").agg(F.count(F.lit(1)).alias("c"), F.min("doc_id").alias("doc_id")).filter("c = 1")
    own = own.groupBy("doc_id").agg(F.count(F.lit(1)).alias("own"))
    return docs.join(sketches.select("doc_id", "n"), "doc_id").join(own, "doc_id", "left").na.fill(0, ["own"]).filter(
        (F.col("n") - F.col("own")) * 100 >= F.col("n") * percent).select("doc_id")


def _meet(delta: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """What members of a pivot must be compared with, without forming pairs of all of them.

    Taken against their majority (shingles that over half of the members differ from the pivot in are
    turned round), two members x and y differ in m_x + m_y - 2 * shared shingles. Without a shared one they
    are linked just if w_x + w_y <= 0, w = (100 + percent) m - (100 - percent) n: so if any such link of x
    exists, x links to the member of smallest w, its ``nearest``. All other links share differences, so many
    that, with each member's differences in one order, rarest first, the first D + 1 of both hold a common
    one (prefix filter), for the member of fewer differences among its first D / 2 + 1 (``early``): they
    meet in its group (key, doc_id, m, early). One edited copy more adds rows, not pairs."""
    one = delta.select("pivot", "doc_id", F.explode("diff").alias("f"))
    size = delta.groupBy("pivot").agg(F.count(F.lit(1)).alias("g"))
    freq = one.groupBy("pivot", "f").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").join(size, "pivot").select(
        "pivot", "f", (2 * F.col("c") > F.col("g")).alias("most"), F.least("c", F.col("g") - F.col("c")).alias("c"))
    freq = stored(freq, "shared")
    turned = freq.filter("most").groupBy("pivot").agg(F.count(F.lit(1)).alias("turned"))
    shared = stored(one.join(freq, ["pivot", "f"]), "sharing")
    has = shared.groupBy("pivot", "doc_id").agg(F.count(F.when(F.col("most"), F.lit(1))).alias("has"), F.count(F.lit(1)).alias("shares"))
    m = delta.select("pivot", "doc_id", "n", F.size("diff").alias("d")).join(turned, "pivot", "left").join(
        has, ["pivot", "doc_id"], "left").na.fill(0, ["turned", "has", "shares"])
    most = F.floor((F.col("n") + F.floor(F.col("n") * 100 / percent)) * (100 - percent) / (100 + percent))
    m = stored(m.select(
        "pivot", "doc_id", (F.col("turned") - F.col("has")).alias("lacks"), (most + 1 - (F.col("d") - F.col("shares"))).alias("room"),
        (F.floor(most / 2) + 1 - (F.col("d") - F.col("shares"))).alias("near_room"),
        (F.col("d") - 2 * F.col("has") + F.col("turned")).alias("m"),
        ((F.col("d") - 2 * F.col("has") + F.col("turned")) * (100 + percent) - F.col("n") * (100 - percent)).alias("w")), "weights")
    first = m.groupBy("pivot").agg(F.min(F.struct("w", "doc_id")).alias("z"))
    near = m.join(first, "pivot").filter("w + z.w <= 0 and doc_id <> z.doc_id").select("doc_id", F.col("z.doc_id").alias("nearest"))
    lacking = m.filter("lacks > 0").select("pivot", "doc_id").join(freq.filter("most").select("pivot", "f", "c"), "pivot").join(
        shared.select("pivot", "doc_id", "f"), ["pivot", "doc_id", "f"], "left_anti")
    cols = ["pivot", "doc_id", "f", "c"]
    ranked = shared.filter("not most").select(*cols).unionByName(lacking.select(*cols)).withColumn(
        "rank", F.row_number().over(Window.partitionBy("pivot", "doc_id").orderBy("c", "f")))
    groups = ranked.join(m.filter("room > 0").select("pivot", "doc_id", "room", "near_room", "m"), ["pivot", "doc_id"]).filter("rank <= room")
    return near.distinct(), groups.select(F.xxhash64("pivot", "f").alias("key"), "doc_id", "m", (
        F.col("rank") <= F.col("near_room")).alias("early")).distinct()


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def link(documents: DataFrame, words: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text"
         ) -> tuple[DataFrame, DataFrame]:
    """(classes, links): classes (doc_id, n, rep) with the smallest id of those with the same set, and
    links (node, component) of the class representatives that have a link."""
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    own = stored(docs.mapInArrow(_classes(words, percent), "doc_id long, n long, c1 long, c2 long, needs array<long>"), "classes", BATCH)
    full = own.filter("n > 0 and doc_id is not null")
    reps = full.groupBy("n", "c1", "c2").agg(F.min("doc_id").alias("rep"))
    classes = stored(full.join(reps, ["n", "c1", "c2"]).select("doc_id", "n", "rep").unionByName(
        own.filter("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("rep"))), "reps")
    rep_of = classes.filter("n > 0 and doc_id is not null").select("doc_id", "rep").distinct()

    keys = docs.filter("doc_id is not null and text is not null").mapInArrow(_keys(words, percent), "key long, doc_id long")
    group, doc = Window.partitionBy("key"), F.col("doc_id")
    meeting = stored(keys.withColumn("apart", F.min(doc).over(group) < F.max(doc).over(group)).filter("apart").select(
        "key", "doc_id").distinct(), "meeting", BATCH)
    needs = full.select("doc_id", F.explode("needs").alias("need")).groupBy("doc_id", F.col("need").bitwiseAND(63).alias("band")).agg(
        F.shiftright(F.min("need"), 6).alias("need"))
    enough = meeting.groupBy("doc_id", F.col("key").bitwiseAND(63).alias("band")).agg(F.count(F.lit(1)).alias("c")).join(
        needs, ["doc_id", "band"]).filter("c >= need").select("doc_id", "band")
    met = meeting.withColumn("band", F.col("key").bitwiseAND(63)).join(enough, ["doc_id", "band"], "left_semi").select(
        "key", "doc_id", F.min(doc).over(group).alias("pivot"), (F.count(F.lit(1)).over(group) > 2).alias("several"))
    # of a key of two members their one comparison is all; only larger ones are looked at again
    met = stored(met.filter("doc_id <> pivot").select(
        F.when(F.col("several"), F.col("key")).alias("key"), "doc_id", "pivot").distinct(), "met")
    drop_stored(meeting, own)
    by_rep = met.join(rep_of, "doc_id").select("key", "pivot", F.col("rep").alias("doc_id"))
    by_rep = stored(by_rep.join(rep_of.select(F.col("doc_id").alias("pivot"), "rep"), "pivot").select(
        "key", F.col("rep").alias("pivot"), "doc_id").filter("doc_id <> pivot").distinct(), "groups")
    drop_stored(met)
    stars = by_rep.select("pivot", "doc_id").distinct()

    pairs = stars.select(*_ordered("doc_id", "pivot")).distinct()
    nodes = stars.select("doc_id").unionByName(stars.select(F.col("pivot").alias("doc_id"))).distinct()
    texts = stored(pack(docs).join(nodes, "doc_id").dropDuplicates(["doc_id"]), "texts", BATCH)
    sketches = stored(texts.mapInArrow(_sketches(words), "doc_id long, n long, sketch array<long>"), "sketches", BATCH)
    links = _verified(pairs, sketches, texts, words, percent)
    found = components(links)

    # members of a key whose components differ: what two of them share is told from their differences to the pivot
    members = by_rep.filter("key is not null")
    members = members.unionByName(members.select("key", "pivot", F.col("pivot").alias("doc_id")).distinct())
    members = stored(_mixed(members, found), "mixed")
    left = _not_alone(members.select("doc_id").distinct(), texts, sketches, words, percent)
    left = stored(_mixed(members.join(left, "doc_id"), found), "left", BATCH)
    delta = stored(_differences(left.select("pivot", "doc_id").distinct(), texts, words), "deltas", BATCH)
    drop_stored(members, left)
    near, member = _meet(delta, percent)
    near = stored(_with_component(near, found).join(found.select(F.col("node").alias("nearest"), F.col("component").alias("nc")), "nearest", "left")
                  .filter("component <> coalesce(nc, nearest)").select(*_ordered("doc_id", "nearest")).distinct()
                  .join(pairs, ["a", "b"], "left_anti"), "pairs")
    more = _verified(near, sketches, texts, words, percent)
    if not more.isEmpty():
        links = stored(links.unionByName(more), "links")
        found = components(links)
    pairs = pairs.unionByName(near)

    level = F.length(F.regexp_extract(F.bin(F.xxhash64("doc_id")), "0*$", 0))
    member = stored(member.withColumn("level", level), "members")
    drop_stored(delta)
    done, top = pairs, None
    while True:
        labelled = _with_component(member, found)
        mixed = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("c"))
        left = stored(labelled.join(mixed.filter("lo <> hi").select("key", "c"), "key"), "mixed")
        cost = left.filter(F.lit(True) if top is None else F.col("level") < top).groupBy("level").agg(
            F.sum("c").alias("pairs"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect()  # at most 65 rows
        if not cost:
            drop_stored(left, member, texts, sketches)
            return classes, found
        room = PAIRS_PER_ROW * max(1_000_000, sum(r["n"] for r in cost))
        high, low = cost[0]["level"], cost[0]["level"]
        for r in cost:
            room -= r["pairs"]
            if room < 0 and r["level"] != high:
                break
            low = r["level"]
        p = left.filter(F.col("level").between(low, high)).select(
            "key", F.col("doc_id").alias("pivot"), F.col("component").alias("pc"), F.col("level").alias("pl"),
            F.col("m").alias("pm"), F.col("early").alias("pe"))
        new = left.join(p, "key").filter("component <> pc and (level < pl or level = pl and doc_id < pivot)"
                                         " and (early and m <= pm or pe and pm <= m)").select(*_ordered("doc_id", "pivot")).distinct()
        new = stored(new.join(done, ["a", "b"], "left_anti"), "pairs")
        drop_stored(left)
        more = _verified(new, sketches, texts, words, percent)
        if not more.isEmpty():
            links = stored(links.unionByName(more), "links")
            found = components(links)
        done, top = done.unionByName(new), low


def label(documents: DataFrame, words: int = 3, percent: int = 90, **names) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable by links)."""
    classes, found = link(documents, words, percent, **names)
    return classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))


def keep_first(documents: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``documents`` that are the first of their component (all with a null id)."""
    gone = label(documents, words, percent, doc_id=doc_id, text=text).filter("doc_id <> component_id").select(
        F.col("doc_id").alias("_gone")).distinct()
    return documents.join(gone, F.col(f"`{doc_id}`") == F.col("_gone"), "left_anti")
