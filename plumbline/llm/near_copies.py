"""Operator 7: near-copies by a chosen-path set similarity join.

A document is its set of word shingles; equal sets are joined first and stand for all their
documents. A set has 64 minwise values. Each tree starts with all sets in one node; a node chooses
two positions by its own hash, the same for all its members, and every member goes on to the child
that its value at each of them names. So similar sets share many paths and others part quickly. Small
nodes are compared exhaustively, first by the minwise values, then, for those that may be linked, on
the full sets; larger nodes branch again. A pair of similarity s survives any depth of one tree with
probability (2 s - 1) / s^2 at least, and trees are repeated up to the target recall. All trees draw from
the same values, so their number follows from the share of equal values among those, not from s alone, and
what the comparison of minwise values may drop is taken off the recall beforehand.

Only connected components are wanted, so a node whose members are already connected needs no
comparison. Nodes that stay large, or keep half of their parent's members, hold crowds: many copies of one
text, or many texts with one passage. Members of crowds go on to the children that all 64 of their values
name. Small children are compared as other nodes are. A large child's members are compared with its pivot on
the full sets, and what lies near a pivot without being linked to it is compared with what the pivot is
linked with, as the triangle inequality asks. Members left in so many large children that they may have partners
there meet by their full sets: linked sets share one of their shingles rarest among these members, and as few of them as linked
sets may differ in and one more. Groups by a rare shingle are small; larger ones get pivots as long as those take away half of
them, and what is left then is compared at last.

Set identity is a 64-bit hash of the full set. Shingles are 64-bit hashes of their words, of which the full
sets that are compared keep 48 bits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.base import map_batches, query, table
from plumbline.operators.scale import spread
from plumbline.session import reliable_checkpoint

POSITIONS = 64
#: Values by which sets that met in a node are compared before their full sets are fetched.
FINE_POSITIONS = 256
BRANCHES = 2
#: Largest node that is compared exhaustively, and the depth at which larger ones are crowds at last.
NODE = 512
DEPTH = 6
RECALL = 0.9999
#: Standard errors by which minwise values may understate a similarity.
MARGIN = 5.0

_RNG = np.random.default_rng(20_177)
_MULTIPLY = _RNG.integers(0, 2**63, FINE_POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _RNG.integers(0, 2**63, FINE_POSITIONS, dtype=np.uint64)


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles, its letters A-Z lowered.

    A text of fewer words is one shingle; one without words has none.
    """
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=1)], dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    n = len(words) - size + 1
    mixed = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        mixed = (mixed ^ hashes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def minwise(hashes: np.ndarray, positions: int = POSITIONS) -> np.ndarray:
    """The minwise value of a set at every position, as 24 bits."""
    best = np.full(positions, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 2_048):
        part = (hashes[at : at + 2_048][None, :] ^ _FLIP[:positions, None]) * _MULTIPLY[:positions, None]
        np.minimum(best, part.min(axis=1), out=best)
    return (best >> np.uint64(40)).astype("<u4")


def _low(sig: np.ndarray) -> bytes:
    """The last 8 bits of every value."""
    return (sig & 0xFF).astype(np.uint8).tobytes()


def sketch(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_hash, key (identity of the set, null if empty), n_shingles, sig (24-bit values), low (their last 8 bits)."""

    def make():
        import xxhash

        def step(batch: dict[str, list]) -> dict[str, list]:
            out = {"doc_id": batch["doc_id"], "text_hash": batch["text_hash"], "key": [], "n_shingles": [], "sig": [], "low": []}
            for text in batch["text"]:
                hashes = shingle_hashes(text or "", size)
                sig = minwise(hashes) if len(hashes) else None
                out["key"].append(None if sig is None else xxhash.xxh3_64_intdigest(hashes.tobytes()) - 2**63)
                out["n_shingles"].append(len(hashes))
                out["sig"].append(None if sig is None else sig.view(np.uint8).reshape(-1, 4)[:, :3].tobytes())
                out["low"].append(None if sig is None else _low(sig))
            return out

        return step

    return map_batches(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), make, "doc_id bigint, text_hash bigint, key bigint, n_shingles bigint, sig binary, low binary")


def trees_for(threshold: float, recall: float) -> int:
    """Trees that find a pair at the threshold with the recall."""
    survives = (2 * threshold - 1) / threshold**2 if threshold < 1 else 1 - 1e-9
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - survives)))


def equal_values(threshold: float, n: int) -> list[float]:
    """Probability that a pair at the threshold has 0, ..., n of n minwise values equal."""
    return [math.comb(n, m) * threshold**m * (1 - threshold) ** (n - m) for m in range(n + 1)]


def least_equal(threshold: float, n: int, recall: float) -> int:
    """Fewest equal values among n of a pair that may be linked; fewer have a tenth of what the recall allows."""
    least = max(0, math.ceil(n * (threshold - MARGIN * math.sqrt(threshold * (1 - threshold) / n))))
    chances = equal_values(threshold, n)
    while sum(chances[:least]) > (1 - recall) / 10:
        least -= 1
    return least


def shared_trees_for(threshold: float, recall: float) -> int:
    """Trees over the same values that find and keep a pair at the threshold with the recall."""
    dropped = sum(sum(equal_values(threshold, n)[: least_equal(threshold, n, recall)]) for n in (POSITIONS, FINE_POSITIONS))
    allowed = 1 - recall - dropped
    misses = [1 - max(0.0, 2 * x - 1) / x**2 if x else 1.0 for x in (m / POSITIONS for m in range(POSITIONS + 1))]
    # A pair below the least is dropped already.
    first = least_equal(threshold, POSITIONS, recall)
    ways = list(zip(equal_values(threshold, POSITIONS), misses))[first:]
    trees = trees_for(threshold, recall)
    while sum(p * miss**trees for p, miss in ways) > allowed:
        trees += 1
    return trees


def _children(path: Column) -> Column:
    """The child paths of a set (column ``sig``) in a node: the node's hash chooses the positions."""
    first = F.pmod(F.xxhash64(path, F.lit(1)), F.lit(POSITIONS)).cast("int")
    other = F.pmod(first + 1 + F.pmod(F.xxhash64(path, F.lit(2)), F.lit(POSITIONS - 1)), F.lit(POSITIONS)).cast("int")
    return F.array(*[F.xxhash64(path, p, F.substring(F.col("sig"), p * 3 + 1, F.lit(3))) for p in (first, other)[:BRANCHES]])


def _grouped(df: DataFrame, key: str, judge: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """Apply ``judge`` to the rows of each group of bounded size, group after group of sorted partitions."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    parsed = StructType.fromDDL(schema)
    arrow = to_arrow_schema(parsed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] | None = None

        def judged(columns: dict[str, list], last: bool) -> tuple[dict[str, list], dict[str, list]]:
            ids = columns[key]
            cuts = [0, *[i for i in range(1, len(ids)) if ids[i] != ids[i - 1]], len(ids)]
            out: dict[str, list] = {f.name: [] for f in arrow}
            for a, b in zip(cuts, cuts[1:] if last else cuts[1:-1]):
                if b - a > 1:
                    for name, values in judge({c: v[a:b] for c, v in columns.items()}).items():
                        out[name].extend(values)
            rest = cuts[-1] if last else cuts[-2]
            return out, {c: v[rest:] for c, v in columns.items()}

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = batch.to_pydict()
            held = columns if held is None else {c: held[c] + v for c, v in columns.items()}
            out, held = judged(held, last=False)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)
        if held is not None:
            out, _ = judged(held, last=True)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, key).sortWithinPartitions(key).mapInArrow(run, parsed)


def _packed(hashes: np.ndarray) -> bytes:
    """A full set as 48-bit values, in order."""
    return np.unique(hashes >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked(grams: bytes) -> np.ndarray:
    out = np.zeros((len(grams) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(grams, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _equal_values(lows: list[bytes]) -> np.ndarray:
    """For every pair of sets, the positions at which their minwise values are equal."""
    values = np.frombuffer(b"".join(lows), dtype=np.uint8).reshape(len(lows), -1)
    out = np.empty((len(lows), len(lows)), dtype=np.int32)
    for at in range(0, len(lows), 16):
        out[at : at + 16] = (values[at : at + 16, None, :] == values[None, :, :]).sum(axis=2, dtype=np.int32)
    return out


def _common(grams: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every pair of full sets the size of their intersection, and the sizes of the sets.

    Every shingle that two sets hold is a bit; intersections are the bits two sets share, counted over
    one stretch of bits after another.
    """
    sizes = np.array([len(g) // 6 for g in grams], dtype=np.int64)
    owner = np.repeat(np.arange(len(grams)), sizes)
    _, bit, times = np.unique(_unpacked(b"".join(grams)), return_inverse=True, return_counts=True)
    shared = times[bit] > 1
    number = np.cumsum(times > 1) - 1
    owner, bit = owner[shared], number[bit[shared]]
    out = np.zeros((len(grams), len(grams)), dtype=np.int64)
    stretch = 1 << 15
    for at in range(0, int(number[-1]) + 1, stretch):
        own = (bit >= at) & (bit < at + stretch)
        has = np.zeros((len(grams), min(stretch, -(-(int(number[-1]) + 1 - at) // 64) * 64)), dtype=bool)
        has[owner[own], bit[own] - at] = True
        packed = np.packbits(has, axis=1).view(np.uint64)
        for row in range(0, len(grams), 16):
            out[row : row + 16] += np.bitwise_count(packed[row : row + 16, None, :] & packed[None, :, :]).sum(axis=2, dtype=np.int64)
    return out, sizes


def _connect(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (key, comp) after joining the components that ``edges`` (u, v) link.

    Every component takes the least label among its neighbours, then the label of its label, until
    nothing changes; all steps are joins and aggregates.
    """
    links = reliable_checkpoint(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    if links.isEmpty():
        return labels
    near = links.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("root"))
    roots = reliable_checkpoint(near.select("node", "root"))
    while True:
        jump = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
        stepped = roots.join(jump, "root").select("node", F.col("root").alias("was"), F.col("next").alias("root"))
        near = links.join(stepped.select(F.col("node").alias("v"), "root"), "v").groupBy(F.col("u").alias("node")).agg(F.min("root").alias("least"))
        lower = reliable_checkpoint(stepped.join(near, "node").select("node", "was", F.least("root", "least").alias("root")))
        roots = lower.select("node", "root")
        if lower.where("root <> was").isEmpty():
            break
    moved = labels.join(roots.withColumnRenamed("node", "comp"), "comp", "left")
    return reliable_checkpoint(moved.select("key", F.coalesce("root", "comp").alias("comp")))


class _Join:
    """One similarity join: shingle size, threshold in hundredths, and the sizes of the method."""

    def __init__(self, size: int, percent: int, node: int, depth: int, recall: float):
        self.size, self.percent, self.node, self.depth = size, percent, node, depth
        threshold = percent / 100
        self.trees = shared_trees_for(threshold, recall)
        # Fewest equal values of linked sets, among the first positions and among all.
        self.least, self.least_fine = least_equal(threshold, POSITIONS, recall), least_equal(threshold, FINE_POSITIONS, recall)

    def grow(self, sets: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """(run, gid, key) of the members of small nodes that may be linked there, and (key) of the members of crowds.

        A run is a branch at the root of a tree.
        """
        least, found, crowds = self.least, [], []
        roots = F.array(*[F.lit(t) for t in range(self.trees)])
        rows = sets.select("key", "low", "sig", F.explode(roots).alias("run")).withColumns({"path": F.xxhash64(F.lit("root"), "run"), "parent_n": F.lit(2**62)})

        def judge(group: dict[str, list]) -> dict[str, list]:
            alike = _equal_values(group["low"]) >= least
            np.fill_diagonal(alike, False)
            at = np.flatnonzero(alike.any(axis=1)).tolist()
            return {"run": [group["run"][i] for i in at], "gid": [group["path"][i] for i in at], "key": [group["key"][i] for i in at]}

        for level in range(1, self.depth + 1):
            run = F.col("run") * BRANCHES + F.col("branch") if level == 1 else F.col("run")
            branched = rows.select("run", "key", "low", "parent_n", F.posexplode(_children(F.col("path"))).alias("branch", "path"))
            branched = branched.select(run.cast("int").alias("run"), "key", "low", "parent_n", "path")
            counted = branched.groupBy("path").agg(F.count("*").alias("n"))
            crowded = reliable_checkpoint(counted.where(F.col("n") > self.node))
            small = branched.join(crowded, "path", "left_anti").select("path", "run", "key", "low")
            found.append(_grouped(small, "path", judge, "run int, gid bigint, key bigint"))
            if crowded.isEmpty():
                break
            large = reliable_checkpoint(branched.join(crowded, "path").select("run", "path", "key", "n", "parent_n"))
            # A node that keeps half of its parent's members holds a crowd of similar sets.
            crowd = F.lit(level == self.depth) | (2 * F.col("n") > F.col("parent_n"))
            crowds.append(large.where(crowd).select("key"))
            rest = large.where(~crowd)
            if level == self.depth or rest.isEmpty():
                break
            rows = rest.select("run", "path", "key", F.col("n").alias("parent_n")).join(sets.select("key", "low", "sig"), "key")
        every = lambda parts: reduce(DataFrame.unionByName, parts)
        return reliable_checkpoint(every(found)), reliable_checkpoint(every(crowds).distinct()) if crowds else None

    def full_sets(self, docs: DataFrame, keys: DataFrame) -> DataFrame:
        """(key, fine, grams): all minwise values and the full sets of the wanted keys.

        ``keys``: key, _id and _hash, the doc_id and text hash of one of its documents.
        """
        size = self.size

        def make():
            import xxhash

            def step(batch: dict[str, list]) -> dict[str, list]:
                out = {"key": [], "fine": [], "grams": []}
                for text, key in zip(batch["text"], batch["key"]):
                    hashes = shingle_hashes(text or "", size)
                    if len(hashes) and xxhash.xxh3_64_intdigest(hashes.tobytes()) - 2**63 == key:
                        out["key"].append(key)
                        out["fine"].append(_low(minwise(hashes, FINE_POSITIONS)))
                        out["grams"].append(_packed(hashes))
                return out

            return step

        # Spark drops most other texts by a Bloom filter of the wanted ids, before they are shuffled.
        wanted = reliable_checkpoint(keys.withColumn("_wanted", F.lit(1))).where("_wanted > 0")
        named, nameless = wanted.where(F.col("_id").isNotNull()), wanted.where(F.col("_id").isNull())
        texts = docs.select("doc_id", "text").join(named, F.col("doc_id") == F.col("_id")).select("key", "text").unionByName(
            docs.where(F.col("doc_id").isNull()).select("text").join(nameless, F.xxhash64("text") == F.col("_hash")).select("key", "text"))
        return reliable_checkpoint(map_batches(texts, make, "key bigint, fine binary, grams binary").dropDuplicates(["key"]))

    def crowd_nodes(self, crowd: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members of crowds go on to the children that all their values name: (gid, key) of small ones, (gid, key, n, pivot) of large ones.

        Linked sets share as many children as they have equal values, so of small ones those of any positions will do but as
        many as linked sets may differ in.
        """
        own = spread(crowd.join(sets.select("key", "sig"), "key"), "key")
        named = F.transform(F.sequence(F.lit(0), F.lit(POSITIONS - 1)), lambda p: F.xxhash64(F.lit("crowd"), p, F.substring(F.col("sig"), p * 3 + 1, F.lit(3))))
        rows = own.select("key", F.posexplode(named).alias("pos", "gid"))
        return self.by_size(rows, F.col("pos") <= POSITIONS - self.least)

    def by_size(self, rows: DataFrame, wanted: Column | None = None) -> tuple[DataFrame, DataFrame]:
        """(gid, key) of groups that are compared exhaustively; (gid, key, n, pivot) of larger ones, and their pivots.

        ``wanted`` says which rows small groups are made of. Without it, of groups of the same members one stays. The largest
        ``was`` of a group, if there is one, stays with it.
        """
        was = [F.max("was").alias("was")] if "was" in rows.columns else []
        counted = rows.groupBy("gid").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("key").alias("h"), "key")).alias("first"), F.bit_xor(F.xxhash64("key")).alias("same"), *was)
        counted = counted.where("n > 1")
        counted = reliable_checkpoint((counted if wanted is not None else counted.dropDuplicates(["n", "same"])).drop("same").withColumn("pivot", F.col("first.key")).drop("first"))
        members = rows.select("gid", "key")
        small = (members if wanted is None else rows.where(wanted).select("gid", "key")).join(counted.where(F.col("n") <= self.node).select("gid"), "gid")
        return reliable_checkpoint(small), reliable_checkpoint(members.join(counted.where(F.col("n") > self.node), "gid"))

    def _left(self, large: DataFrame, met: DataFrame) -> DataFrame:
        """The members of large groups but those linked with the pivot there, with the group's size as ``was``.

        Two members that are linked, but neither of them with a pivot, are both left in every group they share.
        """
        linked = met.where("linked").select("key", "pivot")
        return large.where("key <> pivot").join(linked, ["key", "pivot"], "left_anti").select("gid", "key", F.col("n").alias("was"))

    def beside_pivots(self, large: DataFrame, met: DataFrame) -> DataFrame:
        """(key) of the members of large children that may be linked with one that no pivot they share is linked with.

        Such partners are left in as many children as linked sets have equal values; who is left in fewer has none.
        """
        left = self._left(large, met).groupBy("key").count()
        return reliable_checkpoint(left.where(F.col("count") >= self.least).select("key"))

    def rare_groups(self, keys: DataFrame, grams: DataFrame) -> DataFrame:
        """(gid, key): the wanted sets by the rarest of their shingles, so many that linked sets share one.

        A set of n has at least ``percent`` hundredths of n in common with one it is linked with. In one order of all
        shingles, the rarest among these sets first, the first that both hold lies in both so early that the rest is enough.
        """
        percent = self.percent

        def make():
            def step(batch: dict[str, list]) -> dict[str, list]:
                tokens = [_unpacked(g).view(np.int64) for g in batch["grams"]]
                return {"key": batch["key"], "size": [len(t) for t in tokens], "tokens": tokens}

            return step

        listed = map_batches(grams.select("key", "grams").join(keys, "key"), make, "key bigint, size bigint, tokens array<bigint>")
        rows = reliable_checkpoint(listed.select("key", "size", F.explode("tokens").alias("token")))
        # A shingle of one set is rarer than all others and leads to nobody.
        shared = rows.join(reliable_checkpoint(rows.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")), "token")
        ordered = shared.groupBy("key", "size").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("shared"))
        n = F.size("shared") + 1 - F.floor((F.col("size") * percent + 99) / 100)
        return reliable_checkpoint(ordered.select("key", F.explode(F.slice("shared", F.lit(1), F.greatest(n, F.lit(0)).cast("int"))).alias("s")).select(F.xxhash64(F.lit("rare"), "s.token").alias("gid"), "key"))

    def beyond_pivots(self, large: DataFrame, met: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """What large groups hold besides what is linked with their pivots: small groups, cells, and large groups with new pivots.

        Where a pivot takes away half of a group, the rest gets another one; else all the rest is compared, in cells of
        two halves of a node.
        """
        small, again = self.by_size(reliable_checkpoint(self._left(large, met)))
        cut = again.where(2 * F.col("n") > F.col("was")).withColumn("_parts", F.ceil(F.col("n") / max(1, self.node // 2)))
        cut = cut.withColumn("_i", F.pmod(F.xxhash64("key"), "_parts")).withColumn("_j", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)))
        cells = cut.select(F.xxhash64(F.lit("rest"), "gid", F.least("_i", "_j"), F.greatest("_i", "_j")).alias("gid"), "key")
        return small, cells, reliable_checkpoint(again.where(2 * F.col("n") <= F.col("was")).drop("was"))

    def against_pivots(self, pairs: DataFrame, grams: DataFrame) -> DataFrame:
        """(key, pivot, linked) of the pairs that are linked, or so near that the set may be linked with one that the pivot is linked with.

        One minus the similarity is a metric, so a set linked with a pivot's partner is at most twice as far from the pivot.
        """
        percent = self.percent
        sets_a, sets_b = grams.select("key", F.col("grams").alias("set_a")), grams.select(F.col("key").alias("pivot"), F.col("grams").alias("set_b"))

        def make():
            def step(batch: dict[str, list]) -> dict[str, list]:
                out = {"key": [], "pivot": [], "linked": []}
                for key, pivot, a, b in zip(batch["key"], batch["pivot"], batch["set_a"], batch["set_b"]):
                    a, b = _unpacked(a), _unpacked(b)
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    union = len(a) + len(b) - common
                    if 100 * common >= (2 * percent - 100) * union:
                        out["key"].append(key)
                        out["pivot"].append(pivot)
                        out["linked"].append(100 * common >= percent * union)
                return out

            return step

        return reliable_checkpoint(map_batches(pairs.join(sets_a, "key").join(sets_b, "pivot").select("key", "pivot", "set_a", "set_b"), make, "key bigint, pivot bigint, linked boolean"))

    def near_groups(self, met: DataFrame, labels: DataFrame) -> DataFrame:
        """(gid, side, key, comp, tested): what is near a pivot but apart from it, against what the pivot is linked with.

        Both sides are cut into halves of a group; ``side`` tells them apart, and only pairs across are new.
        """
        pivots = met.select("pivot").distinct().join(labels.select(F.col("key").alias("pivot"), F.col("comp").alias("own")), "pivot")
        placed = met.join(labels, "key").join(pivots, "pivot")
        near = placed.where(~F.col("linked") & (F.col("comp") != F.col("own"))).select("pivot", "key", "comp", F.lit(1).alias("side"))
        linked = placed.where("linked").select("pivot", "key", "comp", F.lit(0).alias("side"))
        rows = near.unionByName(linked.join(near.select("pivot").distinct(), "pivot", "left_semi"))
        half = max(1, self.node // 2)
        parts = rows.groupBy("pivot").agg(*[F.greatest(F.lit(1), F.ceil(F.count_if(F.col("side") == side) / half)).alias(f"_n{side}") for side in (0, 1)])
        cut = rows.join(reliable_checkpoint(parts), "pivot")
        mine = F.when(F.col("side") == 0, F.col("_n0")).otherwise(F.col("_n1"))
        theirs = F.when(F.col("side") == 0, F.col("_n1")).otherwise(F.col("_n0"))
        cut = cut.withColumn("_i", F.pmod(F.xxhash64("key"), mine)).withColumn("_j", F.explode(F.sequence(F.lit(0).cast("bigint"), theirs - 1)))
        i, j = F.when(F.col("side") == 0, F.col("_i")).otherwise(F.col("_j")), F.when(F.col("side") == 0, F.col("_j")).otherwise(F.col("_i"))
        return cut.select(F.xxhash64(F.lit("near"), "pivot", i, j).alias("gid"), "side", "key", "comp", F.lit(None).cast("array<bigint>").alias("tested"))

    def candidates(self, groups: DataFrame, grams: DataFrame) -> DataFrame:
        """The rows of ``groups`` (gid, side, key, comp, tested) that may be linked to another component there.

        ``tested`` are groups of an earlier run: pairs that met in one of them are not tested again.
        """
        least = self.least_fine

        def judge(group: dict[str, list]) -> dict[str, list]:
            alike = _equal_values(group["fine"]) >= least
            comps, sides = np.array(group["comp"]), np.array(group["side"])
            alike &= comps[:, None] != comps[None, :]
            if sides.min() != sides.max():
                alike &= sides[:, None] != sides[None, :]
            met: dict[int, list[int]] = {}
            for i, tested in enumerate(group["tested"]):
                for gid in tested or ():
                    met.setdefault(gid, []).append(i)
            for members in met.values():
                alike[np.ix_(members, members)] = False
            at = np.flatnonzero(alike.any(axis=1)).tolist()
            return {c: [group[c][i] for i in at] for c in ("gid", "side", "key", "comp")}

        rows = groups.join(grams.select("key", "fine"), "key").select("gid", "side", "key", "comp", "tested", "fine")
        return reliable_checkpoint(_grouped(rows, "gid", judge, "gid bigint, side int, key bigint, comp bigint"))

    def confirm(self, groups: DataFrame, grams: DataFrame) -> DataFrame:
        """Edges (u, v) of components within groups of bounded size (gid, side, key, comp), on the full sets.

        Every component gets one edge, to the least of those it is linked with in the group.
        """
        percent = self.percent

        def judge(group: dict[str, list]) -> dict[str, list]:
            common, sizes = _common(group["grams"])
            comps, sides = np.array(group["comp"]), np.array(group["side"])
            linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
            linked &= comps[:, None] != comps[None, :]
            if sides.min() != sides.max():
                linked &= sides[:, None] != sides[None, :]
            parent: dict[int, int] = {}

            def find(x: int) -> int:
                while parent.setdefault(x, x) != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(linked)))):
                u, v = find(group["comp"][i]), find(group["comp"][j])
                parent[max(u, v)] = min(u, v)
            found = [(c, find(c)) for c in list(parent) if find(c) != c]
            return {"u": [f[0] for f in found], "v": [f[1] for f in found]}

        # The condition, true of all rows, tells Spark to drop other sets by a Bloom filter before the shuffle.
        rows = groups.where("side >= 0").join(grams.select("key", "grams"), "key").select("gid", "side", "comp", "grams")
        return _grouped(rows, "gid", judge, "u bigint, v bigint")

    def components(self, docs: DataFrame, members: DataFrame) -> DataFrame:
        """(key, comp) of every set that may have partners."""
        filled = members.where(F.col("key").isNotNull())
        sets = reliable_checkpoint(filled.groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("one"), F.first("sig").alias("sig"), F.first("low").alias("low")))
        found, crowd = self.grow(sets)
        keys = found.select("key")
        keys = reliable_checkpoint((keys if crowd is None else keys.unionByName(crowd)).distinct())
        labels = keys.select("key", F.col("key").alias("comp"))
        grams = self.full_sets(docs, sets.select("key", F.col("one.doc_id").alias("_id"), F.col("one.text_hash").alias("_hash")).join(keys, "key"))
        none = F.lit(None).cast("array<bigint>")
        # The first run finds most links; what met in it is not tested again in the others.
        first = F.col("run") == 0
        tested = found.where(first).groupBy("key").agg(F.collect_list("gid").alias("tested"))
        waves = [found.where(first).select("gid", "key").withColumn("tested", none)]
        rest = found.where(~first).select("gid", "key")
        met = None
        if crowd is not None:
            small, large = self.crowd_nodes(crowd, sets)
            rest = rest.unionByName(small)
            while not large.isEmpty():
                pairs = large.where("key <> pivot").select("key", "pivot").distinct()
                near = self.against_pivots(pairs, grams)
                labels = _connect(labels, near.where("linked").select(F.col("key").alias("u"), F.col("pivot").alias("v")))
                if met is None:
                    met = near
                    small, large = self.by_size(self.rare_groups(self.beside_pivots(large, near), grams))
                else:
                    met = met.unionByName(near).distinct()
                    small, cells, large = self.beyond_pivots(large, near)
                    rest = rest.unionByName(cells)
                rest = rest.unionByName(small)
        waves.append(rest.join(reliable_checkpoint(tested), "key", "left"))
        for own in waves:
            seen = own.join(labels, "key")
            counted = seen.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            live = reliable_checkpoint(counted.where("lo <> hi").select("gid"))
            if not live.isEmpty():
                groups = seen.join(live, "gid").select("gid", F.lit(0).alias("side"), "key", "comp", "tested")
                labels = _connect(labels, self.confirm(self.candidates(groups, grams), grams))
        if met is not None:
            labels = _connect(labels, self.confirm(self.candidates(self.near_groups(met, labels), grams), grams))
        return labels


def near_copies(docs: DataFrame, size: int = 3, percent: int = 85, node: int = NODE, depth: int = DEPTH, recall: float = RECALL) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text).

    Rows are linked whose shingle sets have a similarity of ``percent`` hundredths or more;
    ``component_id`` is the least doc_id reachable, and the row that has it is kept. A null text is
    empty; a row without words is linked with nothing. Rows of one doc_id with different texts are
    rows of their own, and each is kept that has the component's id. A null doc_id is the least only
    if its component has no other. Other columns are ignored.
    """
    members = reliable_checkpoint(sketch(docs, size))
    labels = _Join(size, percent, node, depth, recall).components(docs, members)
    plain = members.select("doc_id", "n_shingles", "key").join(labels, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    # Sets without words have no key, and hot nulls would meet in one task.
    empty, filled = members.where(F.col("key").isNull()), reliable_checkpoint(plain.where(F.col("key").isNotNull()))
    least = reliable_checkpoint(filled.groupBy("comp").agg(F.min("doc_id").alias("component_id")))
    joined = filled.join(least, "comp").select("doc_id", "n_shingles", "component_id")
    every = joined.unionByName(empty.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return every.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


@query("op7_chosen_path_copies")
def op7_chosen_path_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-copies over all documents."""
    return near_copies(table(spark, sf_dir, "documents"))
