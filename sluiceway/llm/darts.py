"""Near-duplicate documents by DartMinHash signatures, banded joining and an exact check.

A document is the weighted set of its five-word shingles, the weight being how often one occurs. Darts are thrown at
each element's weight region: a Poisson process of arrival times, both times and targets taken from a hash of
the element, so that equal regions get equal darts in every document. Each coordinate of the signature keeps the
earliest dart that hits it; two documents agree in a coordinate with the probability of their weighted Jaccard
similarity. Only darts before a time that fills all coordinates are ever computed: about k log k for a document instead
of k for each element.

Documents that share a band are joined through one of them, the bucket's centre, another one in each bucket, and the exact similarity is
computed for those pairs. A bucket whose members then lie in one component is done. Of the others, members that share one of their
rarest units with another component stay: two documents of the threshold's similarity always do, pages of one template that differ in the
rest do not. Those outside the bucket's main component meet its members in tiles: blocks of documents whose similarities come from matrix
products within a task, of which only links leave it. So no similar pair that shares a band is lost, and no pair is a row of a join but those with a centre.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.shared import chunks, stored, texts_of
from sluiceway.llm.shingles import WordHashes, mixed, normal_words, run_hashes

_STEP = np.uint64(0xD1B54A32D192ED03)
_EMPTY = np.uint64(2**64 - 1)


def shingles(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the unit regions of a document's weighted shingle set, sorted: the i-th copy of a shingle is a unit of its own.

    A document with fewer words than a shingle has one shingle of all of them.
    """
    if not len(words):
        return np.zeros(0, np.uint64)
    runs = np.sort(run_hashes(words, min(length, len(words))))
    first = np.searchsorted(runs, runs)
    copy = (np.arange(len(runs)) - first).astype(np.uint64)
    return np.sort(mixed(runs + copy * _STEP))


def similarity(left: np.ndarray, right: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted unit sets."""
    if not len(left) or not len(right):
        return 0.0
    both = len(np.intersect1d(left, right, assume_unique=True))
    return both / (len(left) + len(right) - both)


def signatures(units: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """Earliest dart of each of ``k`` coordinates for documents whose units lie one after another.

    A row is 64 bits a coordinate: 32 of arrival time, 32 of the dart's name. Documents without units get a row of ones.
    """
    n = len(sizes)
    best = np.full(n * k, _EMPTY)
    owner = np.repeat(np.arange(n), sizes)
    filled = sizes == 0
    horizon = np.where(sizes > 0, k * (np.log(k) + 2) / np.maximum(sizes, 1), 0.0)
    scale = 2.0**27 / np.where(sizes > 0, horizon, 1.0)  # of times to whole numbers: only their order counts
    base = np.zeros(n)
    while not filled.all():
        live = np.flatnonzero(~filled[owner])
        state, doc = units[live], owner[live]
        time = np.zeros(len(live))
        while len(state):
            state = mixed(state + _STEP)
            uniform = ((state >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53
            time = time - np.log(uniform)
            near = time < horizon[doc]
            state, doc, time = state[near], doc[near], time[near]
            fresh = time >= base[doc]
            dart = mixed(state[fresh] ^ np.uint64(0xA5A5A5A5A5A5A5A5))
            place = doc[fresh] * k + (dart >> np.uint64(32)).astype(np.int64) % k
            order = np.minimum(time[fresh] * scale[doc[fresh]], 2.0**32 - 2).astype(np.uint64)
            np.minimum.at(best, place, (order << np.uint64(32)) | (dart & np.uint64(0xFFFFFFFF)))
        filled |= (best.reshape(n, k) != _EMPTY).all(1)
        base, horizon = np.where(filled, base, horizon), np.where(filled, horizon, horizon * 2)
    return best.reshape(n, k)


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """A hash for each ``rows`` coordinates, by the names of their darts."""
    names = (signature & np.uint64(0xFFFFFFFF)).reshape(len(signature), -1, rows)
    total = np.zeros(names.shape[:2], np.uint64) + np.arange(names.shape[1], dtype=np.uint64)
    for i in range(rows):
        total = mixed(total * _STEP + names[:, :, i])
    return total.view(np.int64)


def _sketch(length: int, n_bands: int, rows: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in chunks(batch, "text"):
                words = [hashes.of(normal_words(t)) for t in texts_of(part)]
                units = [shingles(w, length) for w in words]
                sizes = np.array([len(u) for u in units], np.int64)
                found = bands(signatures(np.concatenate(units), sizes, n_bands * rows), rows)
                prints = [xxhash.xxh3_128_digest(w.tobytes()) if len(w) else None for w in words]
                flat = pa.ListArray.from_arrays(np.arange(len(words) + 1, dtype=np.int32) * n_bands, pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(prints, pa.binary()), flat], names=["doc_id", "print", "bands"])

    return sketch


def _units(length: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in chunks(batch, "text"):
                words = [hashes.of(normal_words(t)) for t in texts_of(part)]
                prints = [xxhash.xxh3_128_digest(w.tobytes()) if len(w) else None for w in words]
                units = [shingles(w, length).tobytes() for w in words]
                yield pa.RecordBatch.from_arrays([pa.array(prints, pa.binary()), pa.array(units, pa.binary())], names=["print", "units"])

    return find


def _similar(threshold: float):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch[c].to_pylist() for c in ("left_units", "right_units"))
            good = [similarity(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) >= threshold for a, b in zip(left, right, strict=True)]
            yield batch.select(["left", "right"]).filter(pa.array(good, pa.bool_()))

    return check


def components(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, root``: the smallest node of each node's component, for all ``nodes`` (node) and ``links`` (left, right).

    Every node takes the smallest root among its neighbours' and then its root's root, until none changes; the number of rounds
    grows with the logarithm of a component's diameter. Each round is stored.
    """
    both = stored(links.select("left", "right").union(links.select("right", "left")).distinct())
    roots = stored(nodes.select("node", F.col("node").alias("root")))
    while True:
        around = both.join(roots, both["right"] == roots["node"]).groupBy("left").agg(F.min("root").alias("near"))
        lower = roots.join(around, roots["node"] == around["left"], "left").select("node", "root", F.least("root", "near").alias("next"))
        # The old root hears of it too, so that whole trees join at once.
        heard = lower.filter("next < root").groupBy("root").agg(F.min("next").alias("heard")).withColumnRenamed("root", "told")
        lower = stored(
            lower.join(heard, lower["node"] == heard["told"], "left").select("node", "root", F.least("next", "heard").alias("next"))
        )
        jump = lower.select(F.col("node").alias("parent"), F.col("next").alias("grand"))
        changed = stored(
            lower.join(jump, lower["next"] == jump["parent"], "left").select("node", F.coalesce("grand", "next").alias("root"), (F.coalesce("grand", "next") != F.col("root")).alias("moved"))
        )
        if changed.filter("moved").isEmpty():
            return changed.select("node", "root")
        roots = changed.select("node", "root")


def _joined_components(roots: DataFrame, late: DataFrame) -> DataFrame:
    """Components after more links: those of the graph of the old components."""
    left, right = (roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("left", "right"))
    met = late.join(left, "left").join(right, "right").select(F.col("left_root").alias("left"), F.col("right_root").alias("right"))
    met = stored(met.filter("left <> right").distinct())
    ends = met.select(F.col("left").alias("node")).union(met.select(F.col("right").alias("node"))).distinct()
    moved = components(met, ends).select(F.col("node").alias("root"), F.col("root").alias("lower"))
    return stored(roots.join(moved, "root", "left").select("node", F.coalesce("lower", "root").alias("root")))


def _star(members: DataFrame, centres: DataFrame) -> DataFrame:
    """Pairs of each bucket's centre with its members, each pair once."""
    pairs = members.join(centres, "bucket").filter(F.col("node") != F.col("centre"))
    return pairs.select(F.least("node", "centre").alias("left"), F.greatest("node", "centre").alias("right")).distinct()


def shared_units(left: list[np.ndarray], right: list[np.ndarray], cells: int = 1 << 22) -> np.ndarray:
    """How many units each left set shares with each right one, by products of presence matrices over the left units."""
    found = np.zeros((len(left), len(right)), np.int64)
    i = 0
    while i < len(left):
        j, total = i, 0
        while j < len(left) and (j == i or total + len(left[j]) <= cells // 256):
            total += len(left[j])
            j += 1
        names, place = np.unique(np.concatenate(left[i:j]), return_inverse=True)
        if len(names):
            held = np.zeros((j - i, len(names)), np.float32)
            held[np.repeat(np.arange(j - i), [len(u) for u in left[i:j]]), place] = 1
            step = max(1, cells // len(names))
            for k in range(0, len(right), step):
                some = right[k : k + step]
                flat = np.concatenate(some)
                at = np.minimum(np.searchsorted(names, flat), len(names) - 1)
                owner, hit = np.repeat(np.arange(len(some)), [len(u) for u in some]), names[at] == flat
                other = np.zeros((len(some), len(names)), np.float32)
                other[owner[hit], at[hit]] = 1
                found[i:j, k : k + step] = np.rint(held @ other.T)
        i = j
    return found


def _tile(threshold: float):
    """Links between documents of different components, one for each document and other component of a tile."""

    def compare(outside: pa.Table, inside: pa.Table) -> pa.Table:
        if not len(outside) or not len(inside):
            return pa.Table.from_pydict({"left": pa.array([], pa.int64()), "right": pa.array([], pa.int64())})
        sets = [[np.frombuffer(u, np.uint64) for u in table[name].to_pylist()] for table, name in ((outside, "o_units"), (inside, "units"))]
        sizes = [np.array([len(u) for u in own]) for own in sets]
        roots, others = outside["o_root"].to_numpy(), inside["root"].to_numpy()
        both = shared_units(*sets)
        similar = both >= threshold * (sizes[0][:, None] + sizes[1][None, :] - both)
        row, column = np.nonzero(similar & (roots[:, None] != others[None, :]) & (both > 0))
        _, first = np.unique(np.stack([row, others[column]]), axis=1, return_index=True)
        a, b = outside["o_node"].to_numpy()[row[first]], inside["node"].to_numpy()[column[first]]
        return pa.Table.from_pydict({"left": pa.array(np.minimum(a, b), pa.int64()), "right": pa.array(np.maximum(a, b), pa.int64())})

    return compare


def rarest(units: np.ndarray, common: np.ndarray, counts: np.ndarray, threshold: float) -> np.ndarray:
    """The first units of a set in an order from rare to common, so many that two sets of ``threshold`` similarity share one of theirs.

    They share at least the part ``threshold`` of the larger set, so the last units of either, one fewer than that part, can't be all they
    share. ``common`` holds, sorted, the units that are not rare, ``counts`` how common each is; any such order does, if it is the same for both.
    """
    weight = np.zeros(len(units), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, units), len(common) - 1)
        weight = np.where(common[at] == units, counts[at], 0)
    return units[np.lexsort((units, weight))[: len(units) - int(np.ceil(threshold * len(units) - 1e-9)) + 1]]


def _common(members: pa.Table) -> pa.Table:
    """The units that several members of a group's sample hold, and how many do."""
    sets = [np.frombuffer(u, np.uint64) for u in members["units"].to_pylist()]
    names, n = np.unique(np.concatenate(sets), return_counts=True)
    columns = [names[n > 1].tobytes(), n[n > 1].astype(np.int64).tobytes()]
    return pa.Table.from_arrays([members["main"][:1], *(pa.array([c], pa.binary()) for c in columns)], names=["main", "common", "counts"])


def _rarest(threshold: float):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("units", "common", "counts")), strict=True)
            found = [rarest(np.frombuffer(u, np.uint64), np.frombuffer(c, np.uint64), np.frombuffer(n, np.int64), threshold).view(np.int64) for u, c, n in rows]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("main", "node", "root")), pa.array(found, pa.list_(pa.int64()))], names=["main", "node", "root", "rare"])

    return cut


def sharing_rare_units(group: DataFrame, threshold: float, sample: int = 16) -> DataFrame:
    """``main, node`` of the members of each group (main, node, root, units) that share one of their rarest units with a member of another root.

    What is common in a group is told from ``sample`` members: that sets the order of the units, so it bears on the cost alone.
    """
    place = F.row_number().over(Window.partitionBy("main").orderBy(F.xxhash64("node"), "node"))
    drawn = group.select("main", "node", place.alias("place")).filter(F.col("place") <= sample).select("main", "node")
    common = stored(group.join(stored(drawn), ["main", "node"]).select("main", "units").groupBy("main").applyInArrow(_common, "main bigint, common binary, counts binary"))
    cut = stored(group.join(common, "main").mapInArrow(_rarest(threshold), "main bigint, node bigint, root bigint, rare array<bigint>"))
    entries = cut.select("main", "node", "root", F.explode("rare").alias("unit"))
    shared = entries.groupBy("main", "unit").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    return stored(entries.join(stored(shared.select("main", "unit")), ["main", "unit"], "left_semi").select("main", "node").distinct())


def _late_links(members: DataFrame, roots: DataFrame, units: DataFrame, threshold: float, block: int = 512) -> DataFrame | None:
    """Links that no centre showed: of buckets in several components, members outside the main one against all of its kind.

    Buckets with the same main component are one group, of which the members that can be similar to one of another component are cut into
    blocks of documents; None if there are none.
    """
    placed = stored(members.join(roots, "node"))
    parts = placed.groupBy("bucket", "root").agg(F.count("*").alias("size"))
    main = parts.groupBy("bucket").agg(F.max_by("root", F.struct("size", "root")).alias("main"), F.count("*").alias("parts"))
    main = stored(main.filter("parts > 1").select("bucket", "main"))
    if main.isEmpty():
        return None
    mixed_members = placed.join(main, "bucket").select("main", "node", "root").distinct()
    group = stored(mixed_members.join(units, "node"))
    near = sharing_rare_units(group, threshold)
    if near.isEmpty():
        return None
    group = stored(group.join(near, ["main", "node"]))
    counts = group.groupBy("main").agg(F.count_if(F.col("root") != F.col("main")).alias("n_outside"), F.count("*").alias("n_inside"))
    counts = stored(counts.select("main", *(F.ceil(F.col(n) / block).cast("int").alias(n) for n in ("n_outside", "n_inside"))))
    dealt = group.join(counts, "main").withColumn("own", F.xxhash64("node"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    inside = dealt.select("main", "node", "root", "units", F.pmod("own", "n_inside").cast("int").alias("j"), every("n_outside").alias("i"))
    outside = dealt.filter("root != main")
    outside = outside.select(
        F.col("main").alias("o_main"), F.col("node").alias("o_node"), F.col("root").alias("o_root"), F.col("units").alias("o_units"),
        F.pmod("own", "n_outside").cast("int").alias("o_i"), every("n_inside").alias("o_j"),
    )
    tiles = outside.groupBy("o_main", "o_i", "o_j").cogroup(inside.groupBy("main", "i", "j"))
    return stored(tiles.applyInArrow(_tile(threshold), "left bigint, right bigint").distinct())


def _verified(pairs: DataFrame, units: DataFrame, threshold: float) -> DataFrame:
    left = units.select(F.col("node").alias("left"), F.col("units").alias("left_units"))
    right = units.select(F.col("node").alias("right"), F.col("units").alias("right_units"))
    return stored(pairs.join(left, "left").join(right, "right").mapInArrow(_similar(threshold), "left bigint, right bigint"))


def _one_document(worded: DataFrame, texts: DataFrame) -> DataFrame | None:
    """Links between the texts of one doc_id, all to the one with the smallest node; None if every doc_id has one text."""
    several = worded.groupBy("doc_id").agg(F.min("print").alias("low"), F.max("print").alias("high")).filter("low <> high")
    several = stored(several.select("doc_id"))
    if several.isEmpty():
        return None
    held = worded.join(several, "doc_id", "left_semi").select("doc_id", "print").distinct()
    held = stored(held.join(texts.select("print", "node"), "print").select("doc_id", "node"))
    least = held.groupBy("doc_id").agg(F.min("node").alias("left"))
    return stored(held.join(least, "doc_id").filter("node <> left").select("left", F.col("node").alias("right")).distinct())


def near_duplicates(docs: DataFrame, threshold: float = 0.8, words: int = 5, n_bands: int = 36, rows: int = 7) -> DataFrame:
    """``doc_id, class_id, n_links`` for every row of ``docs`` (doc_id, text).

    Two documents are linked if the weighted Jaccard similarity of their shingles of ``words`` words (letters, digits and
    underscores, lower case) is at least ``threshold``; ``class_id`` is the smallest doc_id of a connected component, and
    ``n_links`` the number of verified links of the document's text to other texts (a lower bound: members of a component are
    not all compared). Documents of equal words share a class without a comparison. Documents without words, null texts included,
    are alone. Rows that share a doc_id are one document, so its texts share a class and any of them may link to others; rows without doc_id
    have no class. Other columns are not read. An empty table gives no rows.

    With 36 bands of 7, a pair of similarity 0.8 shares a band with probability 0.9998.
    """
    sketched = stored(docs.select("doc_id", "text").mapInArrow(_sketch(words, n_bands, rows), "doc_id bigint, print binary, bands array<bigint>"))
    worded = sketched.filter("doc_id IS NOT NULL AND print IS NOT NULL")
    # A node is a text: one doc_id may have several, and one text many doc_ids.
    texts = stored(worded.groupBy("print").agg(F.min("doc_id").alias("doc_id")).withColumn("node", F.monotonically_increasing_id()))
    first = worded.join(texts, ["print", "doc_id"])
    entries = stored(first.select("node", F.explode("bands").alias("bucket")).distinct())
    # A bucket's first centre is its member with the smallest hash, another one in each bucket.
    draw = F.xxhash64("node", "bucket")
    shared = stored(entries.groupBy("bucket").agg(F.count("*").alias("n"), F.min_by("node", draw).alias("centre")).filter("n > 1"))
    members = stored(entries.join(shared.select("bucket"), "bucket"))
    nodes = stored(members.select("node").distinct())
    held = stored(texts.join(nodes, "node"))
    wanted = docs.join(held.select("doc_id").distinct(), "doc_id", "left_semi").select("text")
    found_units = wanted.mapInArrow(_units(words), "print binary, units binary").groupBy("print").agg(F.max("units").alias("units"))
    units = stored(held.join(found_units, "print").select("node", "units"))
    links = _verified(_star(members, shared.select("bucket", "centre")), units, threshold)
    roots = components(links, nodes)
    late = _late_links(members, roots, units, threshold)
    if late is not None:
        links = links.union(late)
        roots = _joined_components(roots, late)
    one = _one_document(worded, texts)
    if one is not None:
        ends = one.select(F.col("left").alias("node")).union(one.select(F.col("right").alias("node"))).distinct()
        alone = ends.join(roots, "node", "left_anti").select("node", F.col("node").alias("root"))
        roots = _joined_components(stored(roots.union(alone)), one)
    ends = links.select("left").union(links.select("right")).groupBy(F.col("left").alias("node")).agg(F.count("*").alias("n_links"))
    named = texts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = roots.join(texts, "node").groupBy("root").agg(F.min("doc_id").alias("least")).withColumnRenamed("root", "class_root")
    known = named.join(classes, named["root"] == classes["class_root"], "left").join(ends, "node", "left")
    known = stored(
        known.select(
            F.col("print").alias("known"), F.coalesce("least", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links")
        )
    )
    found = sketched.join(known, (sketched["print"] == known["known"]) & sketched["doc_id"].isNotNull(), "left")
    return found.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"))
