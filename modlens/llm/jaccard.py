"""Exact join of near duplicates by parity sketches over word shingles.

A document is the set of its distinct shingles, as 64-bit hashes.  Two sets of sizes a <= b reach a
Jaccard similarity of 0.75 only if a >= 0.75 b and at most (a + b) / 7 elements are in just one of them.

Sketch.  Per size band the hash space is dealt into parts.  A part's word is the XOR of the hashes in it; its
bit is their number's parity.  An element that only one set has changes one part, so the number of parts that
differ, and the Hamming distance of the bits, are lower bounds of the symmetric difference.

Join.  If at most D elements differ, at most D parts do.  So, in any order of parts, the first D + 1 words of
two such documents share one (pigeonhole).  Parts are ordered by how often their shingles occur in the whole
corpus, rarest first: a passage that very many documents share comes last and is seldom a join key.  Sets in
neighbouring bands meet because a set near the lower end of its band is also sketched for the band below.

Verify.  Equal sets are one class from the start.  Classes that share a word are compared with the least class of
that word only (a star): by their bits, and where these are near enough, exactly on the sets.  Whatever is linked by
then needs no more comparing.  In the words whose other members still lie in several components another hub is
drawn, and so on while that joins components.  What then is still apart is compared by bits in tiles, members of
different components only, and verified exactly where the bits are near enough.  Two tiles list a forest of what is near;
where a pair of it is no link, its word is compared again, without that pair, and at last pair by pair.  So all links
between components are found, and no group's pairs are listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modlens.llm.common import digest, discard, forget_others, hashed_words, having, pieces, saved, texts_of, with_arrow
from modlens.llm.graph import components

WORDS = 5
#: Counters of shingle occurrences, by hash; a fixed size, as they only order the parts.
COUNTERS = 1 << 18
BAND = 4
#: Bands whose sets are small have a part for every hash.
SINGLE = 64
#: Sets in a tile, about; a tile is compared in one task.
TILE = 1024
#: Rows that hold texts, sets or bits come to Python so many at a time.
LONG = 512
#: Turns in which tiles list a forest of what is near, before they list every pair that is left.
FORESTS = 2
#: Bits of a sketch at least: the more there are per element, the closer is their distance to the symmetric difference.
LEAST_BITS = 4096
#: Components that a turn may join for their new roots to be broadcast.
FEW = 1 << 18
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles: words between ASCII white space, A-Z lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))], np.uint64)
    return np.unique(_runs(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))))


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The :func:`shingles` of every text, of many texts at a time."""
    for part, words, at in hashed_words(texts):
        runs = _runs(words) if len(words) >= WORDS else words
        for i, (begin, end) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
            if end - begin >= WORDS:
                own = np.sort(runs[begin : end - WORDS + 1])
                yield own[np.concatenate([[True], own[1:] != own[:-1]])]
            else:
                yield shingles(part[i].as_py()) if end > begin else np.zeros(0, np.uint64)


def nodes_of(texts: pa.Array) -> list[int]:
    """The class of every text."""
    return [node_of(h) for h in shingle_sets(texts)]


def _runs(words: np.ndarray) -> np.ndarray:
    """Hashes of all runs of ``WORDS`` words."""
    n = len(words) - WORDS + 1
    out = words[:n].copy()
    for k in range(1, WORDS):
        out ^= out >> np.uint64(29)
        out *= GOLDEN
        out += words[k : n + k]
    return _mixed(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def node_of(hashes: np.ndarray) -> int:
    """Id of a set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).view(np.int64))


def bands(n: int) -> list[tuple[int, int, int]]:
    """Sketches of a set of n: band, end of the band, most differing elements in pairs whose smaller set is in that band."""
    band, end = 0, BAND
    while n >= end:
        band, end = band + 1, end * BAND
    found = [(band, end, n // 3)]
    if band and 3 * n <= 4 * (end // BAND):
        found.append((band - 1, end // BAND, 2 * n // 7))
    return found


def _parts(hashes: np.ndarray, end: int) -> np.ndarray:
    high = hashes >> np.uint64(32)
    return high if end <= SINGLE else high * np.uint64(2 * end) >> np.uint64(32)


def join_keys(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The words by which a set is joined, of all its sketches."""
    keys = []
    often = counts[(hashes & np.uint64(COUNTERS - 1)).astype(np.int64)]
    for band, end, differ in bands(len(hashes)):
        part = _parts(hashes, end)  # ascending, as the hashes are
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        word = np.bitwise_xor.reduceat(hashes, starts)
        rare = np.minimum.reduceat(often, starts)
        key = _mixed(word + part[starts] * GOLDEN + np.uint64(band + 1))
        # in one number: how often, and most of the key
        both = np.minimum(rare, (1 << 24) - 1).astype(np.uint64) << np.uint64(40) | key >> np.uint64(24)
        order = np.argsort(both)
        if (np.diff(both[order]) == 0).any():
            order = np.lexsort((key, both))
        keys.append(key[order[: differ + 1]])
    return np.concatenate(keys).view(np.int64)


def sketch_bits(hashes: np.ndarray, end: int) -> bytes:
    """Parities of the number of hashes per part."""
    size = max(LEAST_BITS, end)
    at = (hashes >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)  # ascending, as the hashes are
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    odd = np.zeros(size, np.uint8)
    odd[at[starts]] = np.diff(starts, append=len(at)) & 1
    return np.packbits(odd).tobytes()


BITS = "band int, bits binary, bits_below binary"


def _sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per row key, set size, class, the text's digest and bits; and, as further rows, how often shingles of each hash value occur."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(__name__)
        counts = np.zeros(COUNTERS, np.int64)
        keys = None
        for batch in pieces(batches):
            keys = batch.column(0)
            sizes, nodes, own, below, at, seen = [], [], [], [], [], []
            for h in shingle_sets(batch.column(1)):
                found = bands(len(h)) if len(h) else []
                at.append(found[0][0] if found else None)
                own.append(sketch_bits(h, found[0][1]) if found else None)
                below.append(sketch_bits(h, found[1][1]) if len(found) > 1 else None)
                seen.append(h)
                sizes.append(len(h))
                nodes.append(node_of(h))
            if seen:
                counts += np.bincount((np.concatenate(seen) & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
            none = pa.nulls(len(sizes), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), batch.column(2), none, none, pa.array(at, pa.int32()), pa.array(own, pa.binary()), pa.array(below, pa.binary())],
                names,
            )
        used = np.flatnonzero(counts)
        if keys is not None:
            none, bare = pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(used), keys.type), none, none, none, pa.array(used), pa.array(counts[used]), pa.nulls(len(used), pa.int32()), bare, bare], names
            )

    names = ["key", "n", "node", "digest", "counter", "times", "band", "bits", "bits_below"]
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), digest(text).alias("digest"))
    return rows.mapInArrow(run, f"key {kind}, n bigint, node bigint, digest bigint, counter bigint, times bigint, {BITS}")


def _key_rows(docs: DataFrame, text: str, counts: np.ndarray) -> DataFrame:
    """(word, n, node) of every class, once per task at most."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(__name__)
        counts, seen = shared.value, set()
        for batch in pieces(batches):
            words, sizes, nodes, n_words = [], [], [], 0

            def made() -> pa.RecordBatch:
                flat = np.concatenate(words)
                each = np.array([len(w) for w in words])
                return pa.RecordBatch.from_arrays(
                    [pa.array(flat), pa.array(np.repeat(np.array(sizes, np.int32), each)), pa.array(np.repeat(np.array(nodes, np.int64), each))],
                    ["word", "n", "node"],
                )

            for h in shingle_sets(batch.column(0)):
                if not len(h) or (node := node_of(h)) in seen:
                    continue
                seen.add(node)
                words.append(join_keys(h, counts))
                sizes.append(len(h))
                nodes.append(node)
                n_words += len(words[-1])
                if n_words > 200_000:
                    yield made()
                    words, sizes, nodes, n_words = [], [], [], 0
            if words:
                yield made()

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "word bigint, n int, node bigint")


def _class_sets(texts: DataFrame) -> DataFrame:
    """(node, elements): the packed set of each row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(__name__)
        for batch in pieces(batches):
            sets = [h.tobytes() for h in shingle_sets(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "elements"])

    return texts.mapInArrow(run, "node bigint, elements binary")


def _near(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """Those pairs (a, b) whose sizes and bits do not rule a link out."""
    sides = [bits.select(F.col("node").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("n", "band", "bits", "bits_below"))) for x in "ba"]
    # the members' bits travel, each with its few pairs; a hub of many pairs is met where its pairs are
    both = pairs.join(sides[0], "b").join(sides[1], "a").where("4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b)")
    x = F.when(F.expr("band_a <= band_b"), F.col("bits_a")).otherwise(F.col("bits_below_a"))
    y = F.when(F.expr("band_b <= band_a"), F.col("bits_b")).otherwise(F.col("bits_below_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(__name__)
        for batch in pieces(batches):
            most = batch.column(2).to_pylist()
            keep = [
                7 * (int.from_bytes(p, "little") ^ int.from_bytes(q, "little")).bit_count() <= n
                for p, q, n in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), most, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", (F.col("n_a") + F.col("n_b")).alias("n"), x.alias("x"), y.alias("y")).mapInArrow(run, "a bigint, b bigint")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs (a, b) whose sets are similar enough, decided on the sets."""
    own = sets.select(F.col("node").alias("b"), F.col("elements").alias("of_b"))
    hub = sets.select(F.col("node").alias("a"), F.col("elements").alias("of_a"))
    both = pairs.join(own, "b").join(hub, "a")  # as in _near: the hub is met where its pairs are

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(__name__)
        for batch in pieces(batches, 256):
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "of_a", "of_b").mapInArrow(run, "a bigint, b bigint")


def _across(mixed: DataFrame, forest: bool = False) -> DataFrame:
    """Pairs of members of a word's different components whose bits are close enough; compared tile by tile.

    With ``forest`` two tiles list no pair whose ends the pairs listed before would join, so never more pairs than they have members;
    ``more`` says that some were left out.  If all that were listed prove to be links, then so joined are the ends of those left out.
    A row's ``barred`` members are not compared with it.

    Members are dealt by set size, in steps of more than 4 / 3, and within a step by hash into tiles: linked sets lie in the same
    step or in neighbouring ones, so a member meets the tiles of these only.
    """
    # the step is a little longer than 4 / 3, so no rounding of the logarithm parts linked sets by two steps
    steps = mixed.withColumn("step", F.floor(F.ln("n") / F.lit(float(np.log(1.35)))).cast("int"))
    sizes = steps.groupBy("word", "step").agg(F.count(F.lit(1)).alias("members"))
    dealt = F.struct("step", F.ceil(F.col("members") / TILE).cast("int").alias("tiles"))
    shape = sizes.groupBy("word").agg(F.map_from_entries(F.collect_list(dealt)).alias("tiles"), F.sum("members").alias("members"))  # some sixty steps at most
    # the members of most words are one tile together
    one = F.col("members") <= TILE
    shape = shape.select("word", one.alias("one"), F.when(one, F.create_map(F.lit(0), F.lit(1))).otherwise(F.col("tiles")).alias("tiles"))
    tiled = steps.join(shape, "word").withColumn("step", F.when(F.col("one"), 0).otherwise(F.col("step")))
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("node"), F.element_at("tiles", F.col("step"))).cast("int"))

    def against(step: Column, place) -> Column:
        """A pair of tiles for every tile of a step, none where the word has no such step."""
        there = F.coalesce(F.try_element_at("tiles", step), F.lit(0))
        return F.transform(F.when(there > 0, F.sequence(F.lit(0), there - 1)).otherwise(F.array().cast("array<int>")), place)

    def pair(a: Column, x: Column, b: Column, y: Column) -> Column:
        return F.struct(a.cast("int").alias("a"), x.cast("int").alias("x"), b.cast("int").alias("b"), y.cast("int").alias("y"))

    step, tile = F.col("step"), F.col("tile")
    meets = F.concat(
        against(step, lambda o: pair(step, F.least(tile, o), step, F.greatest(tile, o))),
        against(step + 1, lambda o: pair(step, tile, step + 1, o)),
        against(step - 1, lambda o: pair(step - 1, o, step, tile)),
    )
    if "barred" not in mixed.columns:
        tiled = tiled.withColumn("barred", F.lit(None).cast("array<bigint>"))
    placed = tiled.select("word", "node", "root", "n", "band", "bits", "bits_below", "barred", "step", "tile", F.explode(meets).alias("p"))
    placed = placed.select("*", "p.*").drop("p")

    def run(key, rows):
        first, second = (key[1].as_py(), key[2].as_py()), (key[3].as_py(), key[4].as_py())
        step, tile, root, n, node, band = (rows[c].to_numpy() for c in ("step", "tile", "root", "n", "node", "band"))
        left, right = ((step == s) & (tile == t) for s, t in (first, second))
        own, below, barred = (rows[c].to_pylist() for c in ("bits", "bits_below", "barred"))
        pairs = [np.zeros((0, 3), np.int64)]
        for b in np.unique(band).tolist():
            has = [(i, own[i] if band[i] == b else below[i]) for i in range(len(own)) if band[i] == b or (band[i] == b + 1 and below[i])]
            at = np.array([i for i, _ in has])
            packed = np.frombuffer(b"".join(v for _, v in has), np.uint64).reshape(len(has), -1)
            p, q = np.flatnonzero(left[at]), np.flatnonzero(right[at])
            lines = max(1, (1 << 21) // max(1, packed[q].size))
            for x in (p[k : k + lines] for k in range(0, len(p), lines)):
                i, j = at[x][:, None], at[q][None, :]
                near = (root[i] != root[j]) & (4 * n[j] >= 3 * n[i]) & (3 * n[j] <= 4 * n[i])
                if first == second:
                    near &= j > i
                far = np.bitwise_count(packed[x][:, None] ^ packed[q][None, :]).sum(axis=2, dtype=np.int32)
                i, j = np.nonzero(near & (7 * far <= n[i] + n[j]))
                pairs.append(np.stack([at[x[i]], at[q[j]], far[i, j]], axis=1))
        pairs = np.concatenate(pairs)
        pairs = pairs[[not barred[i] or node[j] not in barred[i] for i, j, _ in pairs.tolist()]] if len(pairs) and any(barred) else pairs
        found, more = pairs[:, :2].tolist(), False
        if forest and found:
            up = dict(zip(root.tolist(), root.tolist(), strict=True))  # by their roots, and by the pairs listed so far

            def top(x):
                while up[x] != x:
                    up[x] = x = up[up[x]]
                return x

            found = []
            for i, j, _ in pairs[np.argsort(pairs[:, 2], kind="stable")].tolist():  # the nearest first
                x, y = top(int(root[i])), top(int(root[j]))
                if x != y:
                    up[x] = y
                    found.append((i, j))
            more = len(found) < len(pairs)
        found = [(min(node[i], node[j]), max(node[i], node[j])) for i, j in found]
        return pa.table(
            [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64()), pa.array(np.full(len(found), key[0].as_py(), np.int64)), pa.array(np.full(len(found), more))],
            ["a", "b", "word", "more"],
        )

    listed = placed.groupBy("word", "a", "x", "b", "y").applyInArrow(run, "a bigint, b bigint, word bigint, more boolean")
    return listed if forest else listed.select("a", "b")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, ``n_shingles``, ``component_id``, the row's ``node`` (equal sets share it)
    and its component's ``root``, a node.

    ``component_id`` is the least key reached by links from the row, itself included.  A text without words, null or
    empty, has no shingles and is linked with nothing.  Repeated rows and texts share a class; a null key is never the
    least unless all are null.  An empty table gives an empty table; other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    found = saved(_sets(docs, key, text), "shingle-sets", LONG)
    rows = found.where("node IS NOT NULL").select("key", "n", "node")
    counts = np.zeros(COUNTERS, np.int64)
    times = saved(found.where("counter IS NOT NULL").groupBy("counter").agg(F.sum("times").alias("times")), "shingle-counts")
    sums = times.toArrow()  # COUNTERS rows at most
    counts[sums["counter"].to_numpy()] = sums["times"].to_numpy()
    discard(times)

    # words that several classes hold
    word = Window.partitionBy("word")
    shared = _key_rows(docs, text, counts).select("*", F.min(F.struct("node", "n")).over(word).alias("hub"), F.max("node").over(word).alias("last"))
    shared = shared.where("hub.node <> last AND hub.node <> node")
    shared = saved(shared.select("word", "node", "n", "hub").distinct(), "shared-words", LONG)
    first = rows.where("n > 0").groupBy("node").agg(F.min("key").alias("first"))
    sharing = shared.select("node").unionByName(shared.select(F.col("hub.node").alias("node"))).distinct()
    bits = found.where("n > 0").join(sharing, "node", "left_semi").groupBy("node")
    bits = saved(bits.agg(*(F.first(c).alias(c) for c in ("n", "band", "bits", "bits_below")), F.min("digest").alias("digest")), "sketches")

    def linked(pairs: DataFrame, name: str, others: DataFrame | None = None) -> DataFrame:
        """The links among the pairs of a saved table, and ``others``; only the sets of these pairs' ends are made and shuffled."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        ends = saved(ends.join(bits.select("node", "digest"), "node"), f"{name}-ends")
        sets = saved(_class_sets(texts_of(docs, text, ends)), f"{name}-sets", LONG)
        found = _linked(pairs, sets)
        out = saved(found if others is None else others.unionByName(found), f"{name}-links", LONG)
        discard(ends)
        discard(sets)
        return out

    size_fits = "4 * least(n, hub.n) >= 3 * greatest(n, hub.n)"
    near = saved(_near(shared.where(size_fits).select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct(), bits), "star-candidates", LONG)
    links = linked(near, "star")
    discard(near)
    root = components(links)

    def apart(members: DataFrame, joined: DataFrame) -> DataFrame:
        """Members of words that still hold several components; ``joined`` has the roots of what was a root before and is none now."""
        new = joined.select(F.col("node").alias("root"), F.col("root").alias("new"))
        new = F.broadcast(new) if joined.count() <= FEW else new
        now = members.join(new, "root", "left").withColumn("root", F.coalesce("new", "root"))
        now = now.select("*", F.min("root").over(word).alias("low"), F.max("root").over(word).alias("high")).where("low <> high")
        return saved(now.select("word", "n", "node", "root"), "members-apart")

    # the hubs are compared with everyone; other hubs follow, as long as that joins components, and then the rest in tiles
    members = apart(shared.select("word", "n", "node", F.col("node").alias("root")), root)
    discard(shared)
    left = members.count()
    if left:
        turn = 0
        while left:
            turn += 1
            pick = F.min_by(F.struct("node", "n", "root"), F.xxhash64("node", F.lit(turn))).over(word)
            dealt = members.withColumn("hub", pick).where("node <> hub.node")
            pairs = dealt.where(f"root <> hub.root AND {size_fits}").select(F.col("hub.node").alias("a"), F.col("node").alias("b"))
            pairs = saved(pairs.distinct(), "hub-pairs")
            ends = pairs.select(F.explode(F.array("a", "b")).alias("node"))
            near = saved(_near(pairs, having(bits, "node", ends)), "hub-candidates", LONG)
            past, rooted = (links, members, near, pairs), root
            links = linked(near, "hub", links)
            root = components(links)
            joined = root.where("node <> root").join(rooted.where("node <> root"), "node", "left_anti")
            members = apart(dealt.select("word", "n", "node", "root"), joined)
            for table in past:
                discard(table)
            before, left = left, members.count()
            if left > 0.8 * before:
                break
        alike = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("node").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("node", F.lit(1))))
        words = members.groupBy("word").agg(alike.alias("members")).groupBy("members").agg(F.min("word").alias("word")).select("word")
        rest, turn, tried = members.join(words, "word"), 0, None
        while rest is not None:
            turn += 1
            mixed = rest.join(bits.drop("n", "digest"), "node")
            if tried is not None:
                both = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
                mixed = mixed.join(both.groupBy(F.col("a").alias("node")).agg(F.collect_set("b").alias("barred")), "node", "left")
            listed = saved(_across(mixed, turn <= FORESTS), "tile-pairs", LONG)
            pairs = listed.select("a", "b").distinct()
            new = linked(pairs, "tile")
            past = links
            links = saved(links.unionByName(new), "links")
            discard(past)
            root = components(links)
            rest = None
            if turn <= FORESTS:
                # a pair that is no link may have kept others from being listed: its word is compared again
                again = listed.join(new, ["a", "b"], "left_anti")
                words = saved(again.where("more").select("word").distinct(), "words-again")
            if turn <= FORESTS and not words.isEmpty():
                failed = again.select("a", "b").distinct()
                tried = saved(failed if tried is None else tried.unionByName(failed).distinct(), "tile-failed")
                rest = saved(members.join(words, "word").drop("root").join(root, "node", "left").withColumn("root", F.coalesce("root", "node")), "members-again")
                rest = rest.select("word", "n", "node", "root")
            discard(listed)
            discard(new)
        discard(members)

    discard(bits)
    least = root.join(first, "node").groupBy("root").agg(F.min("first").alias("component"))
    named = root.join(least, "root").select("node", "root", "component")
    out = rows.join(first, "node", "left").join(named, "node", "left")
    return out.select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("key")).otherwise(F.coalesce("component", "first")).alias("component_id"), "node",
        F.coalesce("root", "node").alias("root"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component: a row with its least key (null last), of several the one whose text's digest is least.

    Rows without words are all kept, as they are linked with nothing.  Each task drops its own copies of a text before
    rows are shuffled, by class and once.
    """
    found = near_duplicates(docs, key, text).where("n_shingles > 0")
    heads = found.groupBy("root").agg(F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), "node")).alias("head"))
    at = docs.columns.index(text)

    def classes(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(nodes_of(batch.column(at)), pa.int64())]

    bare = ~F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    full = with_arrow(docs.where(~bare), classes, "__node bigint")
    first = Window.partitionBy("__node").orderBy(F.col(key).asc_nulls_last(), F.sha2(F.col(text), 256))
    ranked = full.withColumn("__n", F.row_number().over(first)).where("__n = 1")
    kept = ranked.join(heads.select(F.col("head.node").alias("__node")), "__node", "left_semi")
    return kept.select(*docs.columns).unionByName(docs.where(bare))
