"""N-gram Jaccard join: a MinHash LSH forest for candidates, exact verification for links.

Texts become sequences of lower-case words (ASCII letters, digits and all characters beyond ASCII), and these
sets of five-word shingles; texts with fewer words are one shingle. Texts of equal word sequences are one node.

The forest has TREES tries; a node's label in each is its DEPTH MinHash values there, and the labels of a trie are
kept sorted, so that nodes with a common prefix stand together. Matching begins at whole labels and shortens the
prefix by one value at a time. How far is decided for each node: until the modelled recall of the least similar
link that a set of its size can have reaches the target (a set of three shingles has no link but to an equal set,
and is done at full depth; large sets go up to the depth of the threshold itself). At each step only nodes that no
longer prefix has tied yet are compared, by their whole signatures; those five standard deviations below the
threshold are passed over. The connected nodes are candidate clusters, and all pairs inside a cluster are verified
exactly, on the whole shingle sets.

Crowded tries (many nodes under the shortest prefix) are cut into blocks. A first pass ties nodes inside blocks,
each node being in one. In a second, nodes that are not in their trie's largest cluster yet visit its other
blocks; so what is sent grows with the nodes of a trie of near copies, not with their square, and no pair of a trie
goes unseen unless both are tied already. Counting the links inside a cluster does take all its pairs: a large cluster is cut into
blocks, a task takes two, and hands on one row a node (its number of links, and a node it is tied to), never the pairs.
Components are found with alternating stars on written tables. Their nodes are named by id and hash, in that order, so
that the name of a component says its smallest doc_id, and nothing is joined on a component that may be large.

Defined cases: a text that is null or has no word is linked to nothing; rows equal in id and text count as
copies of each other's text like any others; a class is named by its smallest doc_id, null ids only if there
are no others; texts in different classes stay apart even if they share an id; an empty table gives no rows; other
columns are not read, but kept by first_of_each().
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import bound_batches, release_memory, scratch_path, stage_table
from gridledger.sources.scratch import drop, job

WORDS = 5
SIMILARITY = 0.8
TREES = 20
DEPTH = 8
RECALL = 0.999
#: Standard deviations by which the agreement of two signatures may lie below the threshold.
DEVIATIONS = 5
#: Nodes of a trie, and nodes and shingles of a cluster, that a block holds. A cluster's blocks grow with it up to
#: the second number, so that a node goes to few block pairs.
TRIE_BLOCK = 512
CLUSTER_BLOCK = (256, 1024)
SHINGLE_BLOCK = 400_000
EDGES_PER_FILE = 50_000

_BLOCK_CHARS = 300_000
_rng = np.random.default_rng(41)
_BYTE = _rng.integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_PLACE = _rng.integers(1, 1 << 63, 64, np.uint64) | np.uint64(1)
_MULTIPLY = _rng.integers(0, 1 << 32, TREES * DEPTH, np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, TREES * DEPTH, np.uint32)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_IS_WORD = np.zeros(256, bool)
_IS_WORD[np.r_[48:58, 97:123, 128:256]] = True


def recall_at(similarity: float, depth: int) -> float:
    """The probability that two nodes of this similarity have a common prefix of this length in some tree."""
    return 1 - (1 - similarity**depth) ** TREES


def depth_for(similarity: float, recall: float = RECALL) -> int:
    """The prefix is shortened from the whole label until nodes of this similarity meet with the target probability."""
    depth = DEPTH
    while depth > 1 and recall_at(similarity, depth) < recall:
        depth -= 1
    return depth


def least_link(n: int, similarity: float) -> float:
    """The least similarity, not below the threshold, that a set of n shingles can have with any set."""
    least = 1.0
    for m in range(int(np.ceil(similarity * n - 1e-9)), int(n / similarity + 1e-9) + 1):
        c = max(1, int(np.ceil(similarity * (n + m) / (1 + similarity) - 1e-9)))
        if c <= min(n, m):
            least = min(least, c / (n + m - c))
    return least


def node_depths(similarity: float, recall: float = RECALL) -> list[int]:
    """Depths at which nodes of 0, 1, 2... shingles are done; the last holds for all larger sets.

    From 1 / (1 - similarity) shingles squared on, the least link differs so little from the threshold that its depth is taken.
    """
    small = int(np.ceil((1 / max(1e-3, 1 - similarity)) ** 2)) + 1
    return [DEPTH] + [depth_for(least_link(n, similarity), recall) for n in range(1, small)] + [depth_for(similarity, recall)]


# ---- shingles and signatures -----------------------------------------------------------------------------
def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _sums(values: np.ndarray, base: int, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Of each range of values, the sum with powers of base by place in the range, modulo 2**64."""
    up = _powers(base, len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up, out=total[1:])
    inverse = _powers(pow(base, -1, 1 << 64), len(values) + 1)
    return (total[stops] - total[starts]) * inverse[starts]


def shingled(texts: list[str], words: int = WORDS):
    """For a block of texts: 128-bit hashes of their word sequences, shingles of all, and where each text's start and stop."""
    encoded = [t.lower().encode("utf-8", "replace") + b"\0" for t in texts]
    raw = np.frombuffer(b"".join(encoded), np.uint8)
    inside = np.zeros(raw.size + 2, bool)
    inside[1:-1] = _IS_WORD[raw]
    change = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = change[0::2], change[1::2]
    hashes = _mix(_sums(_BYTE[raw], _BASES[0], starts, stops) + (stops - starts).astype(np.uint64))
    # Words before the end of each text, by its bytes: a text may hold zero bytes itself.
    ends = np.searchsorted(starts, np.cumsum([len(e) for e in encoded]) - 1)
    begins = np.concatenate(([0], ends[:-1]))
    count = ends - begins
    sequence = np.stack([_mix(_sums(_mix(hashes + _PLACE[60 + i]), b, begins, ends) + count.astype(np.uint64)) for i, b in enumerate(_BASES)], 1) if len(hashes) else np.zeros((len(texts), 2), np.uint64)
    made = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    shingle_stops = np.cumsum(made)
    shingle_starts = shingle_stops - made
    # First word of each shingle, and how many of the words after it belong to it.
    first = np.repeat(begins - shingle_starts, made) + np.arange(shingle_stops[-1] if len(made) else 0)
    last = np.repeat(ends, made)
    padded = np.concatenate((hashes, np.zeros(words, np.uint64)))
    shingles = np.zeros(len(first), np.uint64)
    for j in range(words):
        shingles += np.where(first + j < last, padded[first + j] * _PLACE[j], np.uint64(0))
    return sequence, _mix(shingles), shingle_starts, shingle_stops


def signatures(shingles: np.ndarray, starts: np.ndarray, stops: np.ndarray, size: int = TREES * DEPTH) -> np.ndarray:
    """MinHash values (texts, size); texts without shingles have the greatest."""
    out = np.full((len(starts), size), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(stops > starts)
    if some.size:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        for i in range(size):
            out[some, i] = np.minimum.reduceat(x * _MULTIPLY[i] + _ADD[i], starts[some])
    return out


def _text_blocks(column, limit: int = _BLOCK_CHARS):
    """(first row, texts) of consecutive rows with about limit characters."""
    block, first, chars = [], 0, 0
    for i in range(len(column)):
        text = column[i].as_py() or ""
        block.append(text)
        chars += len(text)
        if chars >= limit:
            yield first, block
            block, first, chars = [], i + 1, 0
    if block:
        yield first, block


def labels(sig: np.ndarray) -> np.ndarray:
    """A byte for each MinHash value: the tries' labels side by side. Unlike values seldom share a byte, and
    what they lead to is verified."""
    return ((sig * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def _signed(words: int):
    """doc_id, text_key, node, n_shingles, labels (DEPTH bytes a tree)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _text_blocks(batch["text"]):
                part = batch.slice(first, len(texts))
                sequence, shingles, starts, stops = shingled(texts, words)
                some = stops > starts
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        part["text_key"],
                        pa.array([x.tobytes() if ok else None for x, ok in zip(sequence, some)], pa.binary()),
                        pa.array(stops - starts, pa.int64()),
                        pa.array([x.tobytes() for x in labels(signatures(shingles, starts, stops))], pa.binary()),
                    ],
                    names=["doc_id", "text_key", "node", "n_shingles", "labels"],
                )
            release_memory()

    return run


# ---- candidates ------------------------------------------------------------------------------------------
class _Forest:
    """Union of positions; find() halves paths."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def union(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups of sorted rows, as many groups at a time as a batch has."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows, bool)
        for k in keys:
            v = batch[k].to_numpy(zero_copy_only=False)
            changed[1:] |= v[1:] != v[:-1]
            if held:
                changed[0] |= v[0] != held[-1][k][-1].as_py()
        cuts = np.flatnonzero(changed)
        if not cuts.size:
            held.append(batch)
            continue
        last = int(cuts[-1])
        held.append(batch.slice(0, last))
        yield pa.Table.from_batches(held)
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Starts of the groups of sorted rows, and the number of rows."""
    changed = np.ones(table.num_rows, bool)
    if table.num_rows:
        changed[1:] = False
        for k in keys:
            v = table[k].to_numpy()
            changed[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(changed), table.num_rows)


def common_prefix(sorted_labels: np.ndarray) -> np.ndarray:
    """For each row of sorted labels, how many leading bytes it shares with the row before; 0 for the first."""
    out = np.zeros(len(sorted_labels), np.int64)
    if len(out) > 1:
        same = sorted_labels[1:] == sorted_labels[:-1]
        out[1:] = np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1))
    return out


def trie_ties(group: np.ndarray, label: np.ndarray, done: np.ndarray, signature: np.ndarray, tied: np.ndarray, active: np.ndarray, visiting: np.ndarray, least: float, floor: int) -> tuple[list[int], list[int]]:
    """Positions of node pairs that tie together what has a common prefix and near enough signatures.

    Rows are sorted by group and label. The prefix is shortened from whole labels to floor; two nodes are compared where
    their longest common prefix ends, if it isn't shorter than either node's depth (done), unless they are tied
    already, neither is active, or both are visiting.
    """
    n = len(group)
    forest = _Forest(n)
    first: dict[int, int] = {}
    for i, t in enumerate(tied.tolist()):
        forest.union(i, first.setdefault(t, i))
    find = lambda: np.array([forest.find(i) for i in range(n)], np.int64)
    shared = common_prefix(label)
    shared[1:][group[1:] != group[:-1]] = -1
    shared[:1] = -1
    root = find()
    left, right = [], []
    deeper = np.arange(n)  # the run of each row at the depth before
    for depth in range(label.shape[1], floor - 1, -1):
        run = np.cumsum(shared < depth) - 1
        end = np.searchsorted(run, run, side="right")
        i = np.flatnonzero(end - np.arange(n) > 1)
        step = 0
        while i.size:
            step += 1
            i = i[i + step < end[i]]
            j = i + step
            ask = (deeper[i] != deeper[j]) & (root[i] != root[j]) & (active[i] | active[j]) & ~(visiting[i] & visiting[j]) & (np.maximum(done[i], done[j]) <= depth)
            x, y = i[ask], j[ask]
            for a in range(0, len(x), 65_536):
                p, q = x[a : a + 65_536], y[a : a + 65_536]
                near = (signature[p] == signature[q]).sum(axis=1) >= least
                for u, v in zip(p[near].tolist(), q[near].tolist()):
                    if forest.union(u, v):
                        left.append(u)
                        right.append(v)
            if step & (step - 1) == 0:
                root = find()
        root = find()
        deeper = run
    return left, right


def _ties(similarity: float, floor: int):
    """a, b: what trie_ties() finds in each block of a trie."""
    size = TREES * DEPTH
    least = size * (similarity - DEVIATIONS * (similarity * (1 - similarity) / size) ** 0.5)
    keys = ["trie", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, keys):
            bounds = _bounds(table, keys)
            signature = np.frombuffer(b"".join(table["labels"].to_pylist()), np.uint8).reshape(-1, size)
            tree = table["tree"].to_numpy()
            label = np.take_along_axis(signature.reshape(-1, TREES, DEPTH), tree[:, None, None].astype(np.int64), 1)[:, 0]
            group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            # Clusters are told apart within a group; a node without one is its own.
            cluster = pd.factorize(np.array(table["cluster"].to_pylist(), object))[0] * np.int64(len(bounds)) + group
            left, right = trie_ties(group, label, table["done"].to_numpy(), signature, cluster, table["active"].to_numpy(zero_copy_only=False), table["visiting"].to_numpy(zero_copy_only=False), least, floor)
            nodes = table["node"].combine_chunks()
            yield pa.RecordBatch.from_arrays([nodes.take(pa.array(left, pa.int64())), nodes.take(pa.array(right, pa.int64()))], names=["a", "b"])

    return run


def _compared(rows: DataFrame, similarity: float) -> DataFrame:
    """Ties of rows (trie, block, tree, node, labels, done, cluster, active, visiting), dealt by block and sorted by label."""
    label = F.expr(f"substring(labels, tree * {DEPTH} + 1, {DEPTH})")
    rows = rows.select("trie", "block", "tree", label.alias("label"), "node", "labels", "done", "cluster", "active", "visiting")
    dealt = rows.repartition("trie", "block").sortWithinPartitions("trie", "block", "label", "node")
    return dealt.mapInArrow(_ties(similarity, depth_for(similarity)), "a binary, b binary").distinct()


def candidate_ties(nodes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """a, b: pairs that connect all nodes that meet in the forest and whose signatures are near enough.

    nodes: node, n_shingles, labels.
    """
    floor, depths = depth_for(similarity), node_depths(similarity)
    done = F.element_at(F.array(*[F.lit(d) for d in depths]), F.least(F.col("n_shingles") + 1, F.lit(len(depths))).cast("int"))
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    prefix = F.expr(f"substring(labels, tree * {DEPTH} + 1, {floor})")
    # What goes to the tries is short; the labels join those that meet someone there.
    keyed = nodes.select("node", "labels", tree.alias("tree")).select("node", "tree", F.xxhash64("tree", prefix).alias("trie"))
    labelled = nodes.select("node", "labels", done.alias("done"))
    crowded = stage_table(keyed.groupBy("trie").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "forest-tries")
    blocks = F.ceil(F.col("n") / TRIE_BLOCK)
    own = F.pmod(F.xxhash64("node", "tree"), F.col("n_blocks"))
    met = keyed.join(crowded, "trie").join(labelled, "node").withColumn("n_blocks", blocks).withColumn("block", own)
    inside = met.withColumns({"cluster": F.col("node"), "active": F.lit(True), "visiting": F.lit(False)})
    first = stage_table(_compared(inside, similarity), "forest-ties")
    if crowded.where(blocks > 1).isEmpty():
        return first

    # Crowded tries: whoever isn't in the largest cluster of its trie visits the blocks that are not its own.
    known = components(first, "blocks")
    large = crowded.where(blocks > 1)
    placed = keyed.join(large, "trie").withColumn("n_blocks", blocks).withColumn("block", own).join(known, "node", "left").withColumn("cluster", F.coalesce("component", "node"))
    placed = stage_table(placed.join(labelled, "node").select("trie", "tree", "node", "labels", "done", "n_blocks", "block", "cluster"), "forest-crowded")
    shares = placed.groupBy("trie", "cluster").agg(F.count(F.lit(1)).alias("n"))
    largest = stage_table(shares.groupBy("trie").agg(F.max(F.struct("n", "cluster"))["cluster"].alias("largest"), F.count(F.lit(1)).alias("clusters")).where("clusters > 1"), "forest-largest")
    rows = placed.join(largest, "trie").withColumn("active", F.col("cluster") != F.col("largest"))
    host = rows.withColumn("visiting", F.lit(False))
    other = F.explode(F.expr("filter(sequence(0, n_blocks - 1), b -> b <> block)"))
    guest = rows.where("active").withColumn("at", other).withColumn("block", F.col("at")).drop("at").withColumn("visiting", F.lit(True))
    return first.unionByName(_compared(host.unionByName(guest), similarity))


def _blocks(n: Column, sizes: tuple[int, int]) -> Column:
    """Into how many blocks a cluster of n nodes is cut."""
    least, most = sizes
    return F.ceil(n / F.least(F.lit(most), F.greatest(F.lit(least), n / 8)))


def _block_pairs(rows: DataFrame) -> DataFrame:
    """Rows once for each pair of the n_blocks of their cluster that they belong to: own, low, high."""
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    return rows.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})


# ---- components ------------------------------------------------------------------------------------------
def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges as stars: each node of a connected part tied to the least one. A task has a file's share of edges."""
    table = pa.Table.from_batches(list(batches), pa.schema([("u", pa.binary()), ("v", pa.binary())]))
    both = pa.concat_arrays([c for n in ("u", "v") for c in table[n].chunks]) if table.num_rows else pa.array([], pa.binary())
    names = pa.array(sorted(both.unique().to_pylist()), pa.binary())
    at = pa.compute.index_in(both, names).to_numpy()
    forest = _Forest(len(names))
    for i, j in zip(at[: table.num_rows].tolist(), at[table.num_rows :].tolist()):
        forest.union(i, j)  # the least is the root
    root = np.array([forest.find(i) for i in range(len(names))], np.int64)
    away = np.flatnonzero(root != np.arange(len(names)))
    yield pa.RecordBatch.from_arrays([names.take(pa.array(away)), names.take(pa.array(root[away]))], names=["u", "v"])


def _settled(edges: DataFrame) -> bool:
    """Whether edges (u, v) are stars: no u has two v or is itself a v."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(edges: DataFrame, name: str) -> DataFrame:
    """node, component (its least node) of all nodes with an edge, by alternating stars.

    Every task first makes stars of the edges it holds. A large star then ties the greater neighbours of a node to its least
    one, and a small star does so with the lesser neighbours, until only stars are left. Each round is written, so a lost
    executor costs a reread.
    """
    spark = edges.sparkSession
    path = scratch_path(spark, f"{name}-edges")
    with job(spark):
        given = stage_table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"), f"{name}-given")
        # Tables of few edges in few files: a round is several small jobs, whose tasks would else cost more than their rows.
        files = max(1, given.count() // EDGES_PER_FILE)
        edges = stage_table(given.repartition(files).mapInArrow(_contracted, "u binary, v binary"), f"{name}-edges", path)
    while not _settled(edges):
        before, path = path, scratch_path(spark, f"{name}-edges")
        with job(spark):
            both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            # Least neighbours are written before they are joined, so that a join is of two plain shuffles and the
            # many edges of a hub can be split.
            least = stage_table(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(files), f"{name}-least")
            large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
            large = stage_table(large.coalesce(files), f"{name}-large")
            least = stage_table(large.groupBy("u").agg(F.min("v").alias("m")).coalesce(files), f"{name}-least")
            tied = large.join(least, "u")
            small = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
            edges = stage_table(small.coalesce(files), f"{name}-edges", path)
        drop(spark, before)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


# ---- verification ----------------------------------------------------------------------------------------
def _shingle_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _text_blocks(batch["text"]):
                part = batch.slice(first, len(texts))
                _, shingles, starts, stops = shingled(texts, words)
                sets = [np.unique(shingles[a:b]).tobytes() for a, b in zip(starts, stops)]
                keep = [i for i, n in enumerate(part.schema.names) if n != "text"]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in keep), pa.array(sets, pa.binary())], names=[*(part.schema.names[i] for i in keep), "shingles"])
            release_memory()

    return run


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets have in common."""
    n = len(sets)
    if n == 2:
        both = np.concatenate(sets)
        both.sort(kind="stable")
        c = int((both[1:] == both[:-1]).sum())
        return np.array([[len(sets[0]), c], [c, len(sets[1])]], np.float64)
    number, unique = pd.factorize(np.concatenate(sets))
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    shared = np.bincount(number, minlength=len(unique)) > 1
    column = np.cumsum(shared) - 1
    at = shared[number]
    row, number = row[at], column[number[at]]
    out = np.zeros((n, n), np.float64)
    width = 4096
    order = np.argsort(number, kind="stable")
    row, number = row[order], number[order]
    cuts = np.searchsorted(number, np.arange(0, (number[-1] if len(number) else -1) + 1 + width, width))
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        held = np.zeros((n, width), np.float32)
        held[row[a:b], number[a:b] - k * width] = 1
        out += held @ held.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def _links(similarity: float):
    """For each node of a cluster's block pair: documents linked to it there, and a node it is tied to."""
    keys = ["cluster", "low", "high"]
    schema = pa.schema([("node", pa.binary()), ("links", pa.int64()), ("tie", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, keys):
            bounds = _bounds(table, keys)
            nodes, own = table["node"].to_pylist(), table["own"].to_numpy()
            copies = table["copies"].to_numpy()
            raw = table["shingles"]
            crossing = table["low"].to_numpy() != table["high"].to_numpy()
            out = {"node": [], "links": [], "tie": []}
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                at = [i for i in range(a, b) if i == a or nodes[i] != nodes[i - 1]]  # a text that came twice counts once
                if len(at) < 2:
                    continue
                sets = [np.frombuffer(raw[i].as_py(), np.uint64) for i in at]
                size = np.array([len(s) for s in sets], np.float64)
                linked = common_counts(sets) * (1 + similarity) >= similarity * (size[:, None] + size[None]) - 1e-6
                np.fill_diagonal(linked, False)
                if crossing[a]:
                    linked &= own[at][:, None] != own[at][None]
                links = linked @ copies[at]
                forest = _Forest(len(at))
                first = linked.argmax(axis=1)
                for i in np.flatnonzero(linked.any(axis=1)).tolist():
                    out["node"].append(nodes[at[i]])
                    out["links"].append(int(links[i]))
                    out["tie"].append(nodes[at[int(first[i])]])
                    forest.union(i, int(first[i]))
                # Where first neighbours leave parts untied that a link ties, add that link.
                label = np.array([forest.find(i) for i in range(len(at))])
                if len(np.unique(label[linked.any(axis=1)])) > 1:
                    for i, j in np.argwhere(np.triu(linked) & (label[:, None] != label[None])).tolist():
                        if forest.union(i, j):
                            out["node"].append(nodes[at[i]])
                            out["links"].append(0)
                            out["tie"].append(nodes[at[j]])
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return run


# ---- the join --------------------------------------------------------------------------------------------
_SIGN = -(1 << 63)


def _named(doc_id: Column, node: Column) -> Column:
    """A node's name: bytes that sort by id, null last, and then by node."""
    number = F.unhex(F.lpad(F.hex(doc_id.bitwiseXOR(F.lit(_SIGN).cast("bigint"))), 16, "0"))
    return F.when(doc_id.isNull(), F.concat(F.unhex(F.lit("FF" + "0" * 16)), node)).otherwise(F.concat(F.unhex(F.lit("00")), number, node))


def _id_of(name: Column) -> Column:
    """The id in a name."""
    number = F.conv(F.hex(F.substring(name, 2, 8)), 16, -10).cast("bigint").bitwiseXOR(F.lit(_SIGN).cast("bigint"))
    return F.when(F.substring(name, 1, 1) == F.unhex(F.lit("00")), number)


def near_copies(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its connected group), n_links (documents at
    least this similar, copies included)."""
    return _classed(docs, words, similarity).select("doc_id", "class_id", "n_links")


def _classed(docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """doc_id, text_key, class_id, n_links of every row, and whether it speaks for its class (stays)."""
    spark = docs.sparkSession
    bound_batches(spark)
    signed = stage_table(
        docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(_signed(words), "doc_id bigint, text_key bigint, node binary, n_shingles bigint, labels binary"),
        "forest-signatures",
    )
    path = scratch_path(spark, "forest-classes")
    with job(spark):
        found = stage_table(_found(docs, signed, words, similarity), "forest-classes", path)
    out = signed.select("doc_id", "text_key", "node").join(found, "node", "left")
    alone = F.col("node").isNull()
    speaker = F.col("heads") & F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("text_key") == F.col("rep_key"))
    return out.select(
        "doc_id",
        "text_key",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        (alone | speaker).alias("stays"),
    )


def _found(docs: DataFrame, signed: DataFrame, words: int, similarity: float) -> DataFrame:
    """node, class_id, n_links, rep_id, rep_key, heads (whether its name is its class's) of all nodes."""
    # Copies are merged where they are read; one of a node's rows speaks for it.
    with_id = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_key")
    reps = signed.where(F.col("node").isNotNull()).groupBy("node").agg(F.min(with_id).alias("rep"), F.count(F.lit(1)).alias("copies"), F.max("n_shingles").alias("n_shingles"))
    reps = stage_table(
        reps.select("node", _named(F.col("rep.doc_id"), F.col("node")).alias("name"), F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_key").alias("rep_key"), "copies", "n_shingles"), "forest-nodes"
    )
    speaks = signed["doc_id"].eqNullSafe(reps["rep_id"]) & (signed["text_key"] == reps["rep_key"]) & (signed["node"] == reps["node"])
    chosen = signed.join(reps.hint("merge"), speaks, "left_semi").select("node", "n_shingles", "labels")
    # Rows equal in id and text are alike here.
    chosen = stage_table(chosen.groupBy("node").agg(F.first("n_shingles").alias("n_shingles"), F.first("labels").alias("labels")), "forest-chosen")
    clusters = components(candidate_ties(chosen, similarity), "candidates")

    # Exact verification inside the clusters.
    inside = stage_table(clusters.join(reps, "node"), "forest-clusters")
    sizes = stage_table(inside.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("weight")), "forest-sizes")
    blocks = F.greatest(_blocks(F.col("n"), CLUSTER_BLOCK), F.ceil(F.col("weight") / SHINGLE_BLOCK)).cast("int")
    members = stage_table(inside.join(sizes, "component").select(F.col("name").alias("node"), F.xxhash64("component").alias("cluster"), blocks.alias("n_blocks"), "rep_id", "rep_key", "copies"), "forest-members")
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    sets = (
        texts.join(members.hint("merge"), texts["doc_id"].eqNullSafe(members["rep_id"]) & (texts["text_key"] == members["rep_key"]))
        .select("node", "cluster", "n_blocks", "copies", "text")
        .mapInArrow(_shingle_sets(words), "node binary, cluster bigint, n_blocks int, copies bigint, shingles binary")
    )
    rows = _block_pairs(sets).select("cluster", "low", "high", "own", "node", "copies", "shingles")
    dealt = rows.repartition("cluster", "low", "high").sortWithinPartitions("cluster", "low", "high", "node")
    links = stage_table(dealt.mapInArrow(_links(similarity), "node binary, links bigint, tie binary"), "forest-links")
    groups = components(links.select(F.col("node").alias("a"), F.col("tie").alias("b")), "links")
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    name = reps["name"]
    root = F.coalesce("component", name)
    return (
        reps.join(groups.withColumnRenamed("node", "name"), "name", "left")
        .join(counted.withColumnRenamed("node", "name"), "name", "left")
        .select("node", _id_of(root).alias("class_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "rep_id", "rep_key", (root == name).alias("heads"))
    )


def first_of_each(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs without those that are linked to another of their group that stays: one of each group does.

    That is the row with the smallest id, and of these the one with the smallest hash of its text. Rows equal in id and
    text are one; where their other columns differ, the row with the smallest hash of all its columns stands for them.
    """
    stays = _classed(docs, words, similarity).where("stays").select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"), F.col("doc_id").alias("row_id"), F.xxhash64("text").alias("row_key"))
    kept = rows.join(stays, rows["row_id"].eqNullSafe(stays["kept_id"]) & (rows["row_key"] == stays["kept_key"]), "left_semi")
    return kept.groupBy("row_id", "row_key").agg(F.min_by("d", F.xxhash64("d")).alias("d")).select("d.*")
