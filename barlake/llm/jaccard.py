"""N-gram Jaccard join by a size-aware split into light and heavy sets, and its connected groups.

Equal sets are one node. Two sets of sizes n and m link if they share at least t(n, m) shingles, and light sets, the small
ones, are found by subsets: each enumerates its subsets of exactly t(n, m) shingles for every size m that can link. Sets that
meet in such a subset link by definition, so nothing is verified and a star of links per subset is enough.

Heavy sets are found by inverted lists. The hash range of a shingle is cut into blocks, more than two linked sets can
differ in, and a list holds the sets that have the same shingles in a block; as many of a set's smallest blocks as are spare
are not listed, and at least one list holds any two sets that link. A list of single shingles would be as long as a phrase is frequent; a block
is rare even if each of its shingles is not. Blocks depend on the larger set of a pair, so sizes are dealt into bands,
and a set enters those of its possible partners: one or two. Members of a list are compared in full with one of them, the
leader. Where a list then still holds several groups, links across them are sought through a second inverted index, over the
shingles in which members differ from their leader, rarest first; members that share a change are joined by one of them
before any two are paired. No link between different groups is lost, and what is in one group already is not paired.

The boundary is the size up to which enumerating costs less than listing and verifying: both costs are per set and grow
with its size, so where they cross is best for any mix of sizes. Light sets near it also enter the lists of heavy partners.

A document without words has no shingles (0) and stays alone. Null texts are empty. Repeated rows are one node; a null doc_id
joins a group but never names it unless all are null. An empty table gives no row. Sets are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from barlake.llm.common import bounded, join_hot, stored, sub_batches, texts_of
from barlake.llm.tokens import release_encoder
from barlake.session import scratch_scope

SHINGLE, PERCENT = 3, 90
VERIFY_COST, BAND_RATIO, SPARE = 20.0, 1.5, 6
CACHED_WORDS, CACHED_LEADERS, LEADER_STEPS, ALWAYS_SHUFFLE = 300_000, 32, 3, 1 << 62
COMPARED = "a bigint, b bigint, n_a bigint, n_b bigint, linked boolean, added bigint, differ array<bigint>"
SETS = "doc_id bigint, text_hash bigint, node bigint, n bigint, light array<bigint>, side array<int>, heavy array<bigint>"
ODD = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


# Sets of shingles.


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class ShingleSets:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self, width: int = SHINGLE):
        self.width, self.words = width, {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()
        if len(self.words) > CACHED_WORDS:
            self.words = {}
        known = self.words
        for word in words:
            if word not in known:
                known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        if not width:
            return hashes
        total = np.full(len(words) - width + 1, np.uint64(width))
        for i in range(width):
            total = mixed(total * ODD[0] + hashes[i : len(words) - width + 1 + i] * ODD[1 + i % 2])
        return np.unique(total)


def least_overlap(n: int, m: int, percent: int = PERCENT) -> int:
    """Shared shingles that two sets of these sizes need: 100 * shared >= percent * union."""
    return -(-percent * (n + m) // (100 + percent))


def partner_sizes(n: int, percent: int = PERCENT) -> range:
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def most_different(both: int, percent: int = PERCENT) -> int:
    """The largest symmetric difference of linked sets with ``both`` shingles together."""
    return both * (100 - percent) // (100 + percent)


class Plan:
    """Boundary, bands and blocks for one similarity."""

    def __init__(self, percent: int = PERCENT, verify_cost: float = VERIFY_COST):
        self.percent = percent
        self.boundary, n = 0, 1
        while self._subsets(n) <= self._lists(n) + verify_cost + n / 5 and n < 64:
            self.boundary, n = n, n + 1
        self.edges = [self.boundary + 1]

    def _subsets(self, n: int) -> int:
        return sum(comb(n, least_overlap(n, m, self.percent)) for m in partner_sizes(n, self.percent) if least_overlap(n, m, self.percent) <= n)

    def _lists(self, n: int) -> int:
        return 2 * (most_different(2 * n, self.percent) + 2)

    def band(self, size: int) -> int:
        while self.edges[-1] <= size:
            self.edges.append(int(self.edges[-1] * BAND_RATIO) + 1)
        return int(np.searchsorted(self.edges, size, "right")) - 1

    def bands(self, n: int) -> list[int]:
        """Bands of the larger sets that a set of this size can link with, its own size included."""
        largest = 100 * n // self.percent
        if largest <= self.boundary:
            return []
        low, high = self.band(max(n, self.boundary + 1)), self.band(largest)
        return list(range(low, high + 1))

    def blocks(self, band: int) -> int:
        """Number of blocks of a band: what its largest sets can differ in, and spare ones so that small blocks need not be listed."""
        self.band(self.edges[band])
        differ = most_different(2 * (self.edges[band + 1] - 1), self.percent)
        return differ + 2 + differ // SPARE

    def surely_equal(self, n: int, band: int) -> int:
        """In how many blocks of a band, at least, a set of ``n`` agrees with any set that it links with."""
        partner = min(100 * n // self.percent, self.edges[band + 1] - 1)
        return self.blocks(band) - most_different(n + partner, self.percent)


@lru_cache(maxsize=256)
def _cuts(count: int) -> np.ndarray:
    return np.array([(i << 64) // count for i in range(1, count)], np.uint64)


def heavy_keys(shingles: np.ndarray, plan: Plan) -> np.ndarray:
    """Keys of the blocks that have at least ``least`` shingles, as large a bound as leaves one block that partners agree in.

    Fewer blocks are smaller than ``least`` than partners surely agree in, and a block that they agree in is of one size. Of
    two partners the one with the larger bound so shares a block that the other lists too. Blocks of a shingle or two, which
    texts with one common passage may share, need not be listed.
    """
    keys = []
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(shingles + ODD[0]), dtype=np.uint64)])
    for band in plan.bands(len(shingles)):
        count = plan.blocks(band)
        ends = np.concatenate([[0], np.searchsorted(shingles, _cuts(count)), [len(shingles)]])
        sizes = np.diff(ends)
        at = plan.surely_equal(len(shingles), band) - 1
        least = np.partition(sizes, at)[at]
        digest = sums[ends[1:]] - sums[ends[:-1]]
        key = mixed(mixed(digest) + np.uint64(band << 32) + np.arange(count, dtype=np.uint64) * ODD[1])
        keys.append(key[sizes >= least])
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def light_keys(shingles: np.ndarray, plan: Plan) -> tuple[list[int], list[int]]:
    """Keys of all subsets that a light partner may share, and whether this set is the smaller (-1) or the larger (1)."""
    n, keys, side = len(shingles), [], []
    if not 0 < n <= plan.boundary:
        return keys, side
    values = mixed(shingles + ODD[2]).tolist()
    for m in partner_sizes(n, plan.percent):
        size = least_overlap(n, m, plan.percent)
        if m > plan.boundary or size > n:
            continue
        seed = min(n, m) << 8 | max(n, m)
        for subset in combinations(values, size):
            keys.append((sum(subset) + seed * 0x9E3779B97F4A7C15) & (1 << 64) - 1)
            side.append((n > m) - (n < m))
    return keys, side


def document_sets(docs: DataFrame, plan: Plan, width: int = SHINGLE) -> DataFrame:
    """Size, node and keys of every document; the node is a digest of the set, null if it is empty."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoder()
        shingled = ShingleSets(width)
        for batch in sub_batches(batches):
            rows = []
            for doc_id, text, text_hash in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                shingles = shingled(text)
                node = _signed([xxhash.xxh3_64_intdigest(shingles.tobytes())])[0] if len(shingles) else None
                light, side = light_keys(shingles, plan)
                rows.append((doc_id, text_hash, node, len(shingles), _signed(light), side, heavy_keys(shingles, plan).view(np.int64)))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(v), k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                names=[c.split()[0] for c in SETS.split(", ")],
            )

    return docs.select("doc_id", "text", F.xxhash64("text")).mapInArrow(describe, SETS)


def _signed(values: list[int]) -> list[int]:
    return np.array(values, np.uint64).view(np.int64).tolist()


# Links.


def _rows(keys: DataFrame) -> tuple[int, int]:
    """Rows behind the keys, and the number of keys."""
    return keys.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count("*")).first()


def light_links(sets: DataFrame) -> DataFrame:
    """a, b: stars of links from shared subsets. In a subset for two sizes each side links with a member of the other."""
    keyed = sets.select("node", F.explode(F.arrays_zip("light", "side")).alias("k")).select(
        "node", F.col("k.light").alias("key"), F.col("k.side").alias("side")
    )
    leaders = stored(
        keyed.groupBy("key").agg(
            *[F.min(F.when(F.col("side") == side, F.col("node"))).alias(name) for side, name in ((-1, "low"), (0, "same"), (1, "high"))],
            F.count("*").alias("rows"),
        ).where("low <> high OR rows > 1"),
        "jaccard-subsets",
    )
    total, counted = _rows(leaders)
    met = join_hot(keyed, leaders, "key", "rows", total, ["node"], counted=counted)
    other = F.when(F.col("side") == 0, F.col("same")).when(F.col("side") == 1, F.col("low")).otherwise(F.col("high"))
    return met.select(F.col("node").alias("a"), other.alias("b")).where("a <> b").distinct()


def _listed_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key and node of all block keys; a node that repeats among a task's rows is listed once."""
    seen: set[int] = set()
    for batch in batches:
        fresh = []
        for at, node in enumerate(batch.column(0).to_pylist()):
            if node is not None and node not in seen:
                seen.add(node)
                fresh.append(at)
        rows = batch.take(pa.array(fresh, pa.int64()))
        for part in sub_batches([rows]):
            keys = part.column(1)
            lengths = np.diff(keys.offsets.to_numpy())
            nodes = np.repeat(part.column(0).to_numpy(), lengths)
            yield pa.RecordBatch.from_arrays([keys.flatten(), pa.array(nodes, pa.int64())], names=["key", "node"])


def _with_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and node, once each, those whose key the row before or after has too.

    The first and the last row always pass, since the tasks before and after may hold the same key.
    """
    def out(key: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(node, pa.int64())], names=["key", "node"])

    last_key, last_node, last_kept = np.zeros(0, np.int64), np.zeros(0, np.int64), True
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.concatenate([last_key, batch.column(0).to_numpy()])
        node = np.concatenate([last_node, batch.column(1).to_numpy()])
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        key, node = key[new], node[new]
        kept, same = np.zeros(len(key), bool), key[1:] == key[:-1]
        kept[1:] |= same
        kept[:-1] |= same
        kept[0] |= last_kept
        last_key, last_node, last_kept = key[-1:], node[-1:], bool(kept[-1])
        yield out(key[:-1][kept[:-1]], node[:-1][kept[:-1]])
    if len(last_key):
        yield out(last_key, last_node)


def shared_lists(sets: DataFrame) -> DataFrame:
    """key, node and rows: members of all block lists with more than one node, and how many members each list has.

    Most keys occur once. Keys are dealt by ranges of (key, node), so a long list is split over tasks, and a sorted range shows
    which keys have neighbours; only these, and those at the borders of ranges, are counted and joined.
    """
    keyed = sets.select("node", "heavy").mapInArrow(_listed_nodes, "key bigint, node bigint")
    sorted_keys = keyed.repartitionByRange("key", "node").sortWithinPartitions("key", "node")
    near = stored(sorted_keys.mapInArrow(_with_neighbours, "key bigint, node bigint"), "jaccard-near")
    lists = stored(near.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1"), "jaccard-lists")
    total, _ = _rows(lists)
    # Lists grow with the corpus, so they are joined by shuffle at every size.
    return join_hot(near, lists, "key", "rows", total, ["node"], counted=ALWAYS_SHUFFLE).where("rows IS NOT NULL")


def starred(lists: DataFrame) -> DataFrame:
    """key, node and leader of each list: the member that meets the most others in all its lists, then the leader among
    those of that member's own lists that does, and so on a few times.

    Lists of one group of copies so come to share a few leaders. Any leader will do, since all members of a list get the same.
    """
    weights = lists.groupBy("node").agg(F.sum("rows").alias("weight"), F.count("*").alias("lists"))
    weighed = stored(lists.join(weights, "node"), "jaccard-weights")
    total = weighed.count()
    leaders = stored(
        weighed.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("best"), F.count("*").alias("members")), "jaccard-leaders"
    )
    led = stored(join_hot(weighed.select("key", "node"), leaders, "key", "members", total, ["node"], counted=ALWAYS_SHUFFLE).drop("members"), "jaccard-starred")
    # What each leader finds in its own lists; most sets lead none.
    heads = led.select(F.col("best.node").alias("node")).distinct()
    above = led.join(heads, "node", "left_semi").groupBy("node").agg(F.max("best").alias("higher"))
    above = stored(above.where("higher.node <> node").select("node", "higher"), "jaccard-above")
    for _ in range(LEADER_STEPS):
        step = above.select(F.col("node").alias("_via"), F.col("higher").alias("_next"))
        above = stored(
            above.join(step, F.col("higher.node") == F.col("_via"), "left").select("node", F.coalesce("_next", "higher").alias("higher")), "jaccard-above"
        )
    final = leaders.join(above, F.col("best.node") == above["node"], "left")
    final = stored(final.select("key", F.coalesce("higher.node", "best.node").alias("leader"), "members"), "jaccard-leaders")
    return join_hot(weighed.select("key", "node"), final, "key", "members", total, ["node"], counted=ALWAYS_SHUFFLE).drop("members")


def compared(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, percent: int, width: int = SHINGLE) -> DataFrame:
    """The pairs (a, b) with both sizes and whether their whole sets link.

    ``differ`` lists the shingles in which the two sets differ: first those that ``b`` adds, then those that it lacks. Texts
    travel, not sets, which are several times larger; only those of documents that occur in pairs are read again.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingled, leaders = ShingleSets(width), {}
        for batch in sub_batches(batches):
            rows = []
            for a, one, other in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if a not in leaders:
                    if len(leaders) >= CACHED_LEADERS:
                        leaders = {}
                    leaders[a] = shingled(one.as_py())
                x, y = leaders[a], shingled(other.as_py())
                more, less = np.setdiff1d(y, x, assume_unique=True), np.setdiff1d(x, y, assume_unique=True)
                linked = len(x) - len(less) >= least_overlap(len(x), len(y), percent)
                rows.append((len(x), len(y), linked, len(more), np.concatenate([more, less]).view(np.int64)))
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.int64()))
            columns = [pa.array(list(v), k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["a", "b", "n_a", "n_b", "linked", "added", "differ"])

    pairs = stored(pairs, "jaccard-pairs")
    # A node in very many pairs is copied to as many salts as it fills, so no task holds all its pairs.
    leaders = stored(pairs.groupBy("a").agg(F.count("*").alias("rows")), "jaccard-leaders")
    total, counted = _rows(leaders)
    salts = F.ceil(F.col("rows") / 256)
    salted = join_hot(pairs, leaders, "a", "rows", total, ["b"], counted=counted).select("a", "b", F.pmod(F.xxhash64("b"), salts).alias("salt"))
    at = nodes.select("node", "rep", "rep_text")
    left = stored(leaders.join(at, leaders["a"] == at["node"]).select("a", salts.alias("salts"), "rep", "rep_text"), "jaccard-left")
    right = stored(salted.join(at, salted["b"] == at["node"]).select("a", "b", "salt", "rep", "rep_text"), "jaccard-right")
    # Only rows that repeat their id and text bring a text twice.
    if not nodes.where("copies > 1").isEmpty():
        read = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).join(
            left.select("rep", "rep_text").union(right.select("rep", "rep_text")).distinct(),
            F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("text_hash") == F.col("rep_text")), "left_semi",
        )
        docs = stored(read.dropDuplicates(["doc_id", "text_hash"]).select("doc_id", "text"), "jaccard-texts")

    def with_text(places: DataFrame, name: str) -> DataFrame:
        placed = F.broadcast(places) if bounded(places) else places
        found = docs.join(placed, docs["doc_id"].eqNullSafe(placed["rep"]) & (F.xxhash64(docs["text"]) == placed["rep_text"]))
        return found.withColumnRenamed("text", name).drop("doc_id", "rep", "rep_text")

    copies = with_text(left, "text_a").select("a", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)).alias("salt"), "text_a")
    joined = with_text(right, "text_b").join(copies, ["a", "salt"]).select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(compare, COMPARED)


def _verified(met: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b_1, b_2) of members of the star of ``a`` that link, as a, b: sizes of their differences and what these share decide."""
    for side in (1, 2):
        met = met.join(members.select("a", F.col("b").alias(f"b_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in ("n", "differ")]), ["a", f"b_{side}"])
    apart = F.size("differ_1") + F.size("differ_2") - 2 * F.size(F.array_intersect("differ_1", "differ_2"))
    links = met.where(apart * (100 + percent) <= (F.col("n_1") + F.col("n_2")) * (100 - percent))
    return stored(links.select(F.col("b_1").alias("a"), F.col("b_2").alias("b")).distinct(), "jaccard-dense")


def _held(members: DataFrame, shingles: Column) -> DataFrame:
    """a, b and key of every shingle of the members' ``shingles``; a key is a shingle in the star of ``a``."""
    return members.select("a", "b", "group", F.explode(shingles).alias("shingle")).select("a", "b", "group", F.xxhash64("a", "shingle").alias("key"))


def _prefixes(members: DataFrame, groups: DataFrame) -> DataFrame:
    """a, b, group, n, d, key and ``at``: the shingles by which members may meet, and how many of their differences come before.

    Differences that one group alone holds come first, and no row is needed for them; the others follow, rarest first. Most
    who meet nobody are known by what they alone add, which is counted without a join.
    """
    members = members.drop("group").join(groups.select(F.col("node").alias("b"), "group"), "b", "left")
    members = stored(members.withColumn("group", F.coalesce("group", "b")), "jaccard-members")
    added = _held(members, F.slice("differ", 1, F.col("added").cast("int")))
    alone = added.groupBy("key").agg(F.min("a").alias("a"), F.min("b").alias("b"), F.count("*").alias("rows")).where("rows = 1")
    alone = alone.groupBy("a", "b").agg(F.count("*").alias("alone"))
    members = stored(members.join(alone, ["a", "b"], "left").where("coalesce(alone, 0) < reach").drop("alone"), "jaccard-members")

    held = stored(_held(members, F.col("differ")), "jaccard-held")
    counts = held.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.count("*").alias("rows")).where("low <> high")
    counts = stored(counts.select("key", "rows"), "jaccard-counts")
    total, _ = _rows(counts)
    shared = join_hot(held, counts, "key", "rows", total, ["b"], counted=ALWAYS_SHUFFLE).where("rows IS NOT NULL")
    shared = shared.groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct("rows", "key"))).alias("shared"))
    members = members.join(shared, ["a", "b"]).withColumn("own", F.col("d") - F.size("shared")).where("own < reach")
    first = F.slice("shared", 1, (F.col("reach") - F.col("own")).cast("int"))
    prefix = members.select("a", "b", "group", "n", "d", "own", F.posexplode(first).alias("place", "first"))
    return prefix.select("a", "b", "group", "n", "d", "first.key", (F.col("own") + F.col("place")).alias("at"))


def _in_several(prefix: DataFrame) -> DataFrame:
    """The rows of ``prefix`` whose key members of several groups have."""
    prefix = stored(prefix, "jaccard-prefix")
    several = prefix.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.count("*").alias("rows")).where("low <> high")
    several = stored(several.select("key", "rows"), "jaccard-several")
    total, _ = _rows(several)
    open_rows = join_hot(prefix, several, "key", "rows", total, ["b"], counted=ALWAYS_SHUFFLE).where("rows IS NOT NULL").drop("rows")
    return stored(open_rows, "jaccard-open")


def _may_link(percent: int, at: tuple[Column, Column], d: tuple[Column, Column], n: tuple[Column, Column]) -> Column:
    """Whether two members may link if the shingle they meet in is the first they share: all before it and the rest's sizes differ."""
    return (at[0] + at[1] + F.abs(d[0] - at[0] - d[1] + at[1])) * (100 + percent) <= (n[0] + n[1]) * (100 - percent)


def dense_links(pairs: DataFrame, links: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Links across groups between members of one star, found in the space of differences from its leader.

    Two members differ in what only one of their differences holds. Of two members in different groups at least one does
    not link with the leader; then their differences must share shingles, and more the larger they are. So both have a shared
    shingle among the first of any common order: with ``d`` differences, the first min(d, most + 1) where ``most`` linked sets
    can differ in, and about half if the member links with the leader. In the order taken, differences that one group alone
    holds come first: two members in different groups share none of these, so who has more of them than linked sets differ in
    meets nobody, and who has few meets others by rare shingles.

    Members that meet in a shingle are first compared with one of them, the nearest to the leader, which joins those that
    made the same change. Those left with keys of several groups are ordered anew under the groups so joined, and then paired.
    The first shingle two members share tells a bound: what comes before it in either is not shared, and the rest differs by
    its sizes at least. By that bound one of two that link comes to it within its own part of what may differ, so only such
    members look for others.
    """
    most = F.floor((F.col("n_b") + F.floor(F.col("n_b") * 100 / percent)) * (100 - percent) / (100 + percent))
    d = F.size("differ").cast("bigint")
    need = F.floor((d * (100 + percent) + (F.col("n_a") - F.col("n_b")) * (100 - percent)) / (2 * (100 + percent))) + 1
    reach = F.when(F.col("linked"), F.least(d, d - need + 1)).otherwise(F.least(d, most + 1))
    members = stored(
        pairs.select("a", "b", F.col("n_b").alias("n"), "differ", "added", d.alias("d"), reach.alias("reach")).where("reach > 0"), "jaccard-members"
    )
    prefix = _in_several(_prefixes(members, groups))
    heads = stored(prefix.groupBy("key").agg(F.min(F.struct("d", "b", "group", "n", "at")).alias("head"), F.count("*").alias("rows")), "jaccard-heads")
    total, _ = _rows(heads)
    near = join_hot(prefix, heads, "key", "rows", total, ["b"], counted=ALWAYS_SHUFFLE).where(F.col("group") != F.col("head.group"))
    near = near.where(_may_link(percent, *[(F.col(c), F.col(f"head.{c}")) for c in ("at", "d", "n")]))
    near = _verified(near.select("a", F.col("b").alias("b_1"), F.col("head.b").alias("b_2")).distinct(), members, percent)
    if not near.isEmpty():
        groups = stored(connected(links.unionByName(near)), "jaccard-groups")
    # Only who meets another group is ordered again; without the others more shingles are a group's own.
    left = members.join(prefix.select("a", "b").distinct(), ["a", "b"], "left_semi")
    prefix = _in_several(_prefixes(left, groups))
    return near.unionByName(_verified(_meetings(prefix, percent), members, percent))


def _meetings(prefix: DataFrame, percent: int) -> DataFrame:
    """a, b_1, b_2: members of different groups that have a key in common and may link if it is the first they share."""
    early = F.col("at") * (100 + percent) <= F.col("n") * (100 - percent)
    one, two = (
        prefix.withColumn("early", early).select("key", "a", *[F.col(c).alias(f"{c}_{side}") for c in ("b", "group", "n", "d", "at", "early")])
        for side in (1, 2)
    )
    close = _may_link(percent, *[(F.col(f"{c}_1"), F.col(f"{c}_2")) for c in ("at", "d", "n")])
    once = ~F.col("early_2") | (F.col("b_1") < F.col("b_2"))
    met = one.where("early_1").join(two, ["key", "a"]).where(once & (F.col("group_1") != F.col("group_2")) & close)
    return met.select("a", F.least("b_1", "b_2").alias("b_1"), F.greatest("b_1", "b_2").alias("b_2")).distinct()


# Groups.


def _with_least(edges: DataFrame, key: str, other: str, count: int) -> DataFrame:
    """Edges (at most ``count``) with the smallest ``other`` of their ``key`` as ``least``."""
    least = edges.groupBy(key).agg(F.min(other).alias("least"), F.count("*").alias("rows"))
    return join_hot(edges, least, key, "rows", count, [other], counted=count).drop("rows")


def connected(edges: DataFrame) -> DataFrame:
    """node and group (its smallest node) of all nodes in edges (a, b), by alternating stars."""
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "stars")
    state = None
    while True:
        seen = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
        if seen[0] == 0 or seen == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("group"))
        state = seen
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Larger neighbours move to the smallest neighbour ...
        large = stored(
            _with_least(both, "a", "b", 2 * seen[0]).where("b > a").select(F.col("b").alias("a"), F.least("a", "least").alias("b")).where("a <> b").distinct(), "stars"
        )
        # ... then a node's smaller neighbours do.
        small = _with_least(large, "a", "b", 2 * seen[0])
        edges = stored(
            small.select(F.explode(F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct(),
            "stars",
        )


def _mixed_lists(lists: DataFrame, groups: DataFrame) -> DataFrame:
    """key, node, leader and group of the members, without their leader, of lists in which these are of more than one group.

    Members have been compared with their leader already.
    """
    grouped = lists.where("node <> leader").join(groups, "node", "left").select("key", "node", "leader", F.coalesce("group", "node").alias("group"))
    several = grouped.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.count("*").alias("rows")).where("low <> high")
    several = stored(several.select("key", "rows"), "jaccard-several")
    total, _ = _rows(several)
    return stored(
        join_hot(grouped, several, "key", "rows", total, ["node"], counted=ALWAYS_SHUFFLE).where("rows IS NOT NULL").drop("rows"), "jaccard-mixed"
    )


def _grouped(docs: DataFrame, percent: int, width: int) -> tuple[DataFrame, DataFrame]:
    """The sets of all rows, and node, group, component_id and number of rows of every set."""
    rows = texts_of(docs)
    plan = Plan(percent)
    spark = docs.sparkSession
    # Tables that only one step needs go with it.
    with scratch_scope(spark):
        keyed = stored(document_sets(rows, plan, width), "jaccard-keys")
        sets = stored(keyed.select("doc_id", "text_hash", "node", "n"), "jaccard-docs", keep=True)
        light = stored(light_links(keyed), "jaccard-light", outer=True)
        lists = stored(shared_lists(keyed), "jaccard-shared", outer=True)
    # A node stands for texts with one set. The first document of its smallest id (null comes last) represents it.
    documents = sets.where("node IS NOT NULL").groupBy("node", "doc_id", "text_hash").agg(F.count("*").alias("copies"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "copies")).alias("first")
    nodes = documents.groupBy("node").agg(first, F.sum("copies").alias("rows")).select(
        "node", F.col("first.doc_id").alias("rep"), F.col("first.text_hash").alias("rep_text"), F.col("first.copies").alias("copies"), "rows"
    )
    nodes = stored(nodes, "jaccard-nodes")
    with scratch_scope(spark):
        lists = stored(starred(lists), "jaccard-starred", outer=True)
    with scratch_scope(spark):
        pairs = lists.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
        pairs = stored(compared(pairs, rows, nodes, percent, width), "jaccard-compared", outer=True)
    links = light.unionByName(pairs.where("linked").select("a", "b"))
    groups = stored(connected(links), "jaccard-groups")
    mixed_lists = _mixed_lists(lists, groups)
    if not mixed_lists.isEmpty():
        # Sets of different groups that link share a list, which then holds several groups; other members need no second look.
        open_pairs = pairs.join(mixed_lists.select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), ["a", "b"], "left_semi")
        links = stored(links, "jaccard-links")
        groups = stored(connected(links.unionByName(dense_links(open_pairs, links, groups, percent))), "jaccard-groups")
    named = nodes.join(groups, "node", "left").withColumn("group", F.coalesce("group", "node"))
    least = stored(named.groupBy("group").agg(F.min("rep").alias("component_id"), F.count("*").alias("members")), "jaccard-names")
    _, counted = _rows(nodes)
    answers = join_hot(named, least, "group", "members", counted, ["node"], counted=counted).select("node", "group", "component_id", "rows")
    return sets, stored(answers, "jaccard-answers", keep=True)


def linked_groups(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id reachable over links, of every row."""
    with scratch_scope(docs.sparkSession):
        sets, answers = _grouped(docs, percent, width)
        total, counted = _rows(answers)
    return join_hot(sets.select("doc_id", "node", "n"), answers, "node", "rows", total, ["doc_id"], counted=counted).select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def one_of_each_group(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """The rows of ``docs``, with all columns, of one document of each group: the smallest doc_id's (null comes last).

    A document is an id with a text. Rows that share an id but not the text are judged apart; rows that repeat both are the
    same document, and stay or go together. Rows without words stay.
    """
    with scratch_scope(docs.sparkSession):
        sets, answers = _grouped(docs, percent, width)
        total, counted = _rows(answers)
        placed = join_hot(sets.select("doc_id", "text_hash", "node"), answers, "node", "rows", total, ["doc_id"], counted=counted)
        placed = placed.where("node IS NOT NULL").select("group", F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash").alias("document"))
        documents = stored(placed.distinct(), "jaccard-documents")
        keepers = documents.groupBy("group").agg(F.min("document").alias("keeper"), F.count("*").alias("members")).where("members > 1")
        keepers = stored(keepers, "jaccard-keepers")
        grouped, several = keepers.agg(F.coalesce(F.sum("members"), F.lit(0)), F.count("*")).first()
        met = join_hot(documents, keepers, "group", "members", grouped, ["document"], counted=several).where("document <> keeper")
        gone = stored(met.select(F.col("document.doc_id").alias("gone_id"), F.col("document.text_hash").alias("gone_text")).distinct(), "jaccard-gone", keep=True)
    same = docs["doc_id"].cast("bigint").eqNullSafe(gone["gone_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == gone["gone_text"])
    return docs.join(F.broadcast(gone) if bounded(gone) else gone, same, "left_anti")
