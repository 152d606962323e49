"""N-gram Jaccard join by chosen paths, and the classes of near copies it makes.

A text is the set of its SHINGLE-word shingles (lower case, words between white space; a shorter
text is one shingle). Two texts are linked if the Jaccard similarity of their sets is at least
``threshold``. Texts with equal sets are joined first: one of them stands for all, with their
number, and equal texts are never compared or expanded.

The join splits the sets recursively. At a node every set goes, for each of BRANCHES sampled
coordinates, to the child named by its smallest token under the coordinate's hash (minwise
hashing: two sets choose the same token with a probability equal to their similarity). A child
with at most LEAF sets is a bucket; so is one that keeps most of its parent (its sets agree, so
more splits would only repeat them) and one at depth DEPTH. A pair of similarity s takes the same
path with a probability of at least 1 - q, where q is (1 - s + s q)^BRANCHES taken DEPTH times from
0. Runs with other coordinates repeat this; their number makes q^runs, at the
threshold itself, no more than 1 - ``recall``.

Buckets with the same sets are one. In a bucket all pairs are compared, in blocks: one of more than
BLOCK sets or TOKENS tokens is dealt by a hash over chunks, and each two chunks are a task's group
of bounded size. First only sketches are sent, a byte of each coordinate: a pair at the threshold
agrees in fewer than ``agreements`` of them with a probability of at most (1 - ``recall``) / 10, so
sets without a partner that agrees in as many leave the block. Tokens are made and sent for those
that stay, and compared exactly. A pair belongs to the first bucket both its sets are in, so links
are counted once. Blocks send on a row a set: its links and the root of its group in the block,
never pairs. Connected components of these rows, by large and small stars, are the classes.

Nothing grows on the driver; tables between steps go to the shared folder.

Defined results: texts that are null or without words are in no set, hence alone: their own class,
no links. Rows that agree in doc_id and text are one document, each gets the same row (its links
count them as often as they are there). The class id is the smallest doc_id of the class; null ids
take part in all, and a class of null ids only has a null class id. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tierlake.llm.common import (
    SMALL_BYTES, Stored, free_name, in_batches, join_to_texts, map_texts, type_of)
from tierlake.session import materialise

SHINGLE, THRESHOLD = 5, 0.8
COORDINATES, BRANCHES, RECALL = 64, 2, 0.99999
LEAF, DEPTH, AGREEING = 96, 4, 0.6
BLOCK, TOKENS = 1024, 3_000_000
#: Of the matrix of sets by tokens that a task multiplies at once.
CELLS = 2_000_000
#: More than a bucket has chunks.
SIDES = 1 << 31

_ODD = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.default_rng(20)
_FACTORS = _RANDOM.integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _RANDOM.integers(0, 2**63, COORDINATES, dtype=np.uint64)


def tokens_of(text: str | None) -> np.ndarray:
    """The hashed shingles of a text, sorted and distinct."""
    words = (text or "").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    digest = xxhash.xxh3_64_intdigest
    names = np.fromiter((digest(w) for w in words), dtype=np.uint64, count=len(words))
    size = min(SHINGLE, len(words))
    n = len(words) - size + 1
    mixed = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _ODD + names[i:i + n]
    return np.unique((mixed ^ (mixed >> np.uint64(32))) * _ODD)


def signature(tokens: np.ndarray) -> np.ndarray:
    """Per coordinate a name of the token with the smallest hash."""
    least = np.empty(COORDINATES, dtype=np.uint64)
    for i in range(COORDINATES):
        mixed = tokens * _FACTORS[i] + _OFFSETS[i]
        least[i] = (mixed ^ (mixed >> np.uint64(31))).min()
    return ((least * _ODD) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def n_runs(threshold: float, recall: float) -> int:
    """How many runs miss a pair at the threshold with a probability of at most 1 - recall."""
    q = 0.0
    for _ in range(DEPTH):
        q = (1 - threshold + threshold * q) ** BRANCHES
    runs = max(1, math.ceil(math.log(1 - recall) / math.log(q)))
    if runs > COORDINATES // BRANCHES:
        raise ValueError(f"a recall of {recall} at {threshold} needs {runs} runs; there are "
                         f"coordinates for {COORDINATES // BRANCHES}")
    return runs


def agreements(threshold: float, recall: float) -> int:
    """The coordinates in which a pair at the threshold agrees but for (1 - recall) / 10."""
    missed, least = 0.0, 0
    while True:
        missed += (math.comb(COORDINATES, least) * threshold ** least
                   * (1 - threshold) ** (COORDINATES - least))
        if missed > (1 - recall) / 10:
            return least
        least += 1


# ---- sets -----------------------------------------------------------------------------------

def text_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, hash, sid, size, least, sketch) of every text with words; sid names the set."""
    def run(part):
        sets = [tokens_of(t) for t in part.column("text").to_pylist()]
        rows = [i for i, s in enumerate(sets) if len(s)]
        sets = [sets[i] for i in rows]
        at = pa.array(rows, pa.int64())
        least = np.concatenate([signature(s) for s in sets]) if sets else np.empty(0, np.int32)
        sketches = least.astype(np.uint8).reshape(-1, COORDINATES)
        return [part.column("doc_id").take(at), part.column("hash").take(at),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int32()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32)
                                                  * COORDINATES), pa.array(least)),
                pa.array([x.tobytes() for x in sketches], pa.binary())]

    return map_texts(docs.select("doc_id", F.xxhash64("text").alias("hash"), "text"),
                     f"doc_id {type_of(docs, 'doc_id')}, hash bigint, sid binary, size int, "
                     "least array<int>, sketch binary", run)


# ---- chosen paths ---------------------------------------------------------------------------

def _split(nodes: DataFrame) -> DataFrame:
    """(node, sid, size, above) of children; nodes: (node, sid, size, least, above, c0, c1)."""
    children = F.array(*(F.xxhash64("node", c, F.element_at("least", c + 1))
                         for c in (F.col("c0"), F.col("c1"))))
    return nodes.select(F.explode(F.array_distinct(children)).alias("node"), "sid", "size", "above")


def _counted(nodes: DataFrame) -> DataFrame:
    """The nodes of two sets or more, with how many they have."""
    n = nodes.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1")
    return nodes.join(n, "node")


def buckets(sets: DataFrame, runs: int, stored=materialise) -> DataFrame:
    """(node, sid, size): the leaves of all runs. sets: (sid, size, least), a row a set."""
    start = sets.select("sid", "size", "least", F.explode(F.sequence(
        F.lit(0), F.lit(runs - 1))).alias("run")).select(
        F.col("run").cast("bigint").alias("node"), "sid", "size", "least",
        F.lit(None).cast("bigint").alias("above"), (F.col("run") * BRANCHES).alias("c0"),
        (F.col("run") * BRANCHES + 1).alias("c1"))
    leaves, nodes = None, start
    for depth in range(1, DEPTH + 1):
        children = _split(nodes)
        if depth > 1:  # read twice, and so joined twice if not stored
            children = stored(children, "children")
        level = stored(_counted(children), "paths")
        done = (F.col("n") <= LEAF) | (F.col("n") > AGREEING * F.coalesce("above", F.lit(math.inf)))
        if depth == DEPTH:
            done = F.lit(True)
        ended = level.filter(done).select("node", "sid", "size")
        leaves = ended if leaves is None else leaves.unionByName(ended)
        if depth < DEPTH:
            # The coordinates of a node depend on its name only, so all its sets split alike.
            first = F.pmod(F.xxhash64("node"), F.lit(COORDINATES)).cast("int")
            step = 1 + F.pmod(F.xxhash64("node", F.lit(1)), F.lit(COORDINATES - 1)).cast("int")
            nodes = level.filter(~done).join(sets.select("sid", "least"), "sid").select(
                "node", "sid", "size", "least", F.col("n").alias("above"), first.alias("c0"),
                F.pmod(first + step, F.lit(COORDINATES)).alias("c1"))
    return leaves


def distinct_buckets(leaves: DataFrame) -> DataFrame:
    """(node, sid, chunks): each collection of sets once, with the number of its chunks."""
    name = F.xxhash64("sid")
    kept = (leaves.groupBy("node").agg(
        F.count("*").alias("n"), F.sum("size").alias("tokens"),
        F.bit_xor(name).alias("a"), F.bit_xor(F.xxhash64("sid", F.lit(1))).alias("b"))
        .groupBy("n", "tokens", "a", "b").agg(F.min("node").alias("node")))
    chunks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("tokens") / TOKENS))
    return leaves.join(kept.select("node", chunks.cast("int").alias("chunks")), "node").select(
        "node", "sid", "chunks")


# ---- blocks ---------------------------------------------------------------------------------

def overlaps(lists: list[np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """How many values the lists of two index sets have in common, for all pairs."""
    total = np.zeros((len(rows), len(columns)), dtype=np.float32)
    sizes = [len(x) for x in lists]
    if not sum(sizes):
        return total
    values, at = np.unique(np.concatenate(lists), return_inverse=True)
    owner = np.repeat(np.arange(len(lists)), sizes)
    shared = np.bincount(at, minlength=len(values)) > 1
    column = np.cumsum(shared) - 1
    owner, at = owner[shared[at]], column[at[shared[at]]]
    width = max(1, CELLS // max(1, len(lists)))
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    alone = len(rows) == len(columns) == len(lists)  # all against all: no copies of the matrix
    for start in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(at, [start, start + width])
        there = np.zeros((len(lists), min(width, int(shared.sum()) - start)), dtype=np.float32)
        there[owner[lo:hi], at[lo:hi] - start] = 1
        total += there @ there.T if alone else there[rows] @ there[columns].T
    return total


def compare(sids, copies, sides, earlier, tokens, threshold) -> Iterator[tuple]:
    """(sid, root, links) of a block: links to other documents, the root of its group if any."""
    n = len(sids)
    inner = sides.max() == sides.min()
    rows = np.arange(n) if inner else np.flatnonzero(sides == sides.min())
    columns = rows if inner else np.flatnonzero(sides == sides.max())
    sizes = np.array([len(t) for t in tokens], dtype=np.float64)
    both = sizes[rows][:, None] + sizes[columns][None, :]
    linked = overlaps(tokens, rows, columns) * (1 + threshold) >= threshold * both - 1e-6
    if inner:
        np.fill_diagonal(linked, False)
    if not linked.any():
        return
    linked &= overlaps(earlier, rows, columns) == 0
    links, root = np.zeros(n, dtype=np.int64), np.arange(n)
    links[rows] += linked @ copies[columns]
    if not inner:
        links[columns] += linked.T @ copies[rows]
    while True:
        before = root.copy()
        root[rows] = np.minimum(root[rows], np.where(linked, root[columns][None, :], n).min(axis=1))
        root[columns] = np.minimum(root[columns],
                                   np.where(linked, root[rows][:, None], n).min(axis=0))
        root = root[root]
        if (root == before).all():
            break
    for i in np.flatnonzero(links):
        yield sids[i], sids[root[i]], int(links[i])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(node, part) and its batches, of batches sorted by them."""
    key, held = None, []
    for batch in batches:
        keys = list(zip(batch.column("node").to_pylist(), batch.column("part").to_pylist()))
        cuts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
        for start, end in zip(cuts, [*cuts[1:], len(keys)]):
            if keys[start] != key and held:
                yield key, held
                held = []
            key = keys[start]
            held.append(batch.slice(start, end - start))
    if held:
        yield key, held


def _candidates(members: DataFrame, least: int) -> DataFrame:
    """The rows (node, part, side, sid) of members whose sketch agrees with another's of the block
    in ``least`` bytes; of two chunks, with one of the other chunk."""
    def run(batches):
        for (node, part), parts in _groups(batches):
            table = pa.Table.from_batches(parts)
            sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()),
                                     np.uint8).reshape(-1, COORDINATES)
            side = table.column("side").to_numpy()
            inner = part // SIDES == part % SIDES
            rows = np.arange(len(side)) if inner else np.flatnonzero(side == part // SIDES)
            columns = rows if inner else np.flatnonzero(side != part // SIDES)
            if len(rows) < 1 or len(columns) < 1 or len(side) < 2:
                continue
            alike = np.zeros((len(rows), len(columns)), np.uint8)
            for i in range(COORDINATES):
                alike += sketches[rows, i][:, None] == sketches[columns, i][None, :]
            found = alike >= least
            if inner:
                np.fill_diagonal(found, False)
            stays = np.zeros(len(side), bool)
            stays[rows] |= found.any(axis=1)
            stays[columns] |= found.any(axis=0)
            if stays.any():
                chosen = table.drop(["sketch"]).filter(pa.array(stays)).combine_chunks()
                yield from chosen.select(["node", "part", "side", "sid"]).to_batches()

    return in_batches(
        members.repartition("node", "part").sortWithinPartitions("node", "part"), run,
        "node bigint, part bigint, side int, sid binary")


def _blocks(members: DataFrame, threshold: float) -> DataFrame:
    """(sid, root, links) of all blocks. members: (node, part, side, sid, copies, nodes, tokens);
    part has the numbers of the block's two chunks."""
    def arrays(parts, name):
        return [column[i].values.to_numpy() for p in parts for column in (p.column(name),)
                for i in range(p.num_rows)]

    def run(batches):
        found = []
        for (node, part), parts in _groups(batches):
            sids = [s for p in parts for s in p.column("sid").to_pylist()]
            if len(sids) < 2:
                continue
            copies, sides = (np.concatenate([p.column(c).to_numpy() for p in parts])
                             for c in ("copies", "side"))
            if part // SIDES != part % SIDES and sides.max() == sides.min():
                continue  # the other chunk has no sets; this one has a block of its own
            earlier = [x[x < node] for x in arrays(parts, "nodes")]
            found += compare(sids, copies, sides, earlier, arrays(parts, "tokens"), threshold)
            if len(found) > 20_000:
                yield batch_of(found)
                found = []
        yield batch_of(found)

    def batch_of(rows):
        a, b, n = list(zip(*rows)) or [()] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64())],
            names=["sid", "root", "links"])

    return in_batches(
        members.repartition("node", "part").sortWithinPartitions("node", "part"), run,
        "sid binary, root binary, links bigint")


def _with_tokens(docs: DataFrame, sets: DataFrame, stored: Stored) -> DataFrame:
    """(sid, copies, tokens), from one text of each set. sets: (sid, copies, text_of)."""
    def run(part):
        lists = [tokens_of(t).view(np.int64) for t in part.column("text").to_pylist()]
        ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
        return [part.column("sid"), part.column("copies"), pa.ListArray.from_arrays(
            pa.array(ends), pa.array(np.concatenate(lists) if lists else np.empty(0, np.int64)))]

    wanted = stored(sets.select("sid", "copies", F.col("text_of.doc_id").alias("id"),
                                F.col("text_of.hash").alias("h")), "wanted")
    texts = join_to_texts(
        docs.select("doc_id", "text", F.xxhash64("text").alias("hash")), wanted,
        (F.col("hash") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("id")), "inner", stored)
    return map_texts(texts.select("sid", "copies", "text"),
                     "sid binary, copies bigint, tokens array<bigint>", run).dropDuplicates(["sid"])


def components(edges: DataFrame) -> DataFrame:
    """(sid, root) of all nodes with an edge: large and small stars until nothing changes."""
    def stars(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both if large else both.filter("v < u")
        least = near.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        moved = near.join(least, "u").filter("v > u" if large else "true")
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not large:
            out = out.unionByName(least.select("u", F.col("m").alias("v")))
        return out.filter("u != v").distinct()

    def print_of(pairs: DataFrame):
        return pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    pairs = materialise(edges.filter("u != v").distinct(), "stars")
    seen = print_of(pairs)
    while True:
        pairs = materialise(stars(stars(pairs, True), False), "stars")
        now = print_of(pairs)
        if now == seen:
            break
        seen = now
    return pairs.select(F.col("u").alias("sid"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("sid"), F.col("v").alias("root")).distinct())


def classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(doc_id, hash, class_id, n_links, kept) of every document that has a set.

    kept is true for the first document of a class, by doc_id (nulls last) and hash.
    """
    stored = Stored(docs.sparkSession)
    texts = stored(text_sets(docs), "texts")
    # A document that is there several times counts as often, and is one row from here on.
    own = stored(texts.groupBy("sid", "doc_id", "hash").agg(F.count("*").alias("times")), "own")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "hash")
    # All rows of a set have the same coordinates: one row a set has them, found by its name.
    sets = stored(own.groupBy("sid").agg(
        F.sum("times").alias("copies"), F.min(order).alias("text_of")), "sets")
    about = stored(texts.select("sid", "size", "least", "sketch").dropDuplicates(["sid"]), "about")
    stored.drop(texts)
    members = stored(distinct_buckets(buckets(about, n_runs(threshold, recall), stored)), "buckets")
    chunk = F.pmod(F.xxhash64("sid", F.lit(2)), F.col("chunks")).cast("int")
    dealt = members.withColumn("side", chunk).select("node", "sid", "chunks", "side", F.explode(
        F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")).select(
        "node", "sid", "side",
        (F.least("side", "other").cast("bigint") * SIDES + F.greatest("side", "other")).alias("part"))
    chosen = stored(_candidates(dealt.join(about.select("sid", "sketch"), "sid"),
                                agreements(threshold, recall)), "candidates")
    stored.drop(about)
    wanted = stored(chosen.select("sid").distinct(), "partners")
    nodes = members.join(wanted, "sid").groupBy("sid").agg(
        F.array_sort(F.collect_set("node")).alias("nodes"))
    tokens = _with_tokens(docs, sets.join(wanted, "sid"), stored)
    partners = stored(tokens.join(nodes, "sid"), "tokens")
    stored.drop(members)
    blocks = stored(_blocks(chosen.join(partners, "sid"), threshold), "blocks")
    stored.drop(chosen, partners, wanted)
    links = blocks.groupBy("sid").agg(F.sum("links").alias("links"))
    roots = components(blocks.select(F.col("sid").alias("u"), F.col("root").alias("v")))
    placed = (sets.select("sid", "copies", "text_of").join(links, "sid", "left")
              .join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid")))
    heads = placed.groupBy("root").agg(F.min("text_of").alias("head"))
    return own.join(placed.join(heads, "root").select(
        "sid", "head", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")),
        "sid").select("doc_id", "hash", F.col("head.doc_id").alias("class_id"), "n_links",
                      order.eqNullSafe(F.col("head")).alias("kept"), "times")


def join_documents(docs: DataFrame, threshold: float = THRESHOLD,
                   recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, n_links): one row a row of documents."""
    found = classes(docs, threshold, recall).select(
        "doc_id", "class_id", "n_links", F.explode(F.sequence(F.lit(1), F.col("times"))))
    alone = map_texts(docs.select("doc_id", "text"), f"doc_id {type_of(docs, 'doc_id')}, "
                      "words boolean", lambda part: [part.column("doc_id"), pa.array(
                          [bool((t or "").split()) for t in part.column("text").to_pylist()])])
    return found.drop("col").unionByName(alone.filter(~F.col("words")).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links")))


def keep_first(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The documents, all columns, without those that a class has besides its first."""
    name, key, times = (free_name(c, docs.columns) for c in ("id", "hash", "copies"))
    dropped = classes(docs, threshold, recall).filter(~F.col("kept")).select(
        F.col("doc_id").alias(name), F.col("hash").alias(key))
    stored = Stored(docs.sparkSession)
    gone = stored(dropped, "dropped")
    named = docs.withColumn(times, F.xxhash64("text"))
    gone = F.broadcast(gone) if stored.bytes_of(gone) <= SMALL_BYTES else gone
    return named.join(gone, (F.col(times) == F.col(key))
                      & F.col("doc_id").eqNullSafe(F.col(name)), "left_anti").drop(times)
