"""N-gram Jaccard join by chosen paths (operator 10).

Documents are sets of hashed word 5-grams. A node of a chosen-path tree samples coordinates of the
sets' MinHash values, about 1 / threshold of them, and sends each set to one child for each sampled
value, so a pair at the threshold shares one child on average. Leaves, nodes of up to LEAF_SETS
sets, lose no pair: pivots are compared with all, small ones by brute force. One tree finds a pair with some chance only, so trees are repeated until the chance of a pair
at the threshold reaches the target recall; pairs above it are found more surely.

1. Equal sets become one row, with its number of copies.
2. Trees run at once. Their first level is an exchange of (node, set) pairs. Nodes of one set
   go. Nodes of up to TASK_SETS sets recurse inside a task. In larger ones a pivot is compared with
   all sets; what is nearly equal to it stays with it, the rest goes on to children in another
   exchange. Comparisons use the MinHash values and a margin below the threshold. A pair may be
   lost at every level, so sets that went deeper than LEVELS get more trees, until there are
   enough for the depth they reached. Those look for pairs of different components only: nodes
   whose sets earlier trees hold together already are left out.
3. What comparisons hold together are candidate components. Brute force on the exact sets settles
   them, in blocks of bounded size: links are counted inside a task and never written as pairs.
   A component of several blocks is compared block by block.
4. Exact links give classes. A document has the class of its set, and as links all other documents
   with a set of Jaccard similarity of at least the threshold, copies included.

A text with fewer than five words has one n-gram of all its words. A null text, or one without a
word, is similar to none: it is a class of its own without links. Rows that share a doc_id are rows
like any other; a null doc_id is one too, and a class of such rows alone has the id null. An empty
table gives an empty result. Sets are known by 64-bit hashes of their content.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from assayframe.llm import common
from assayframe.llm.components import components

WORDS = 5
THRESHOLD = 0.8
COORDINATES = 64
RECALL = 0.9999
MARGIN = 0.2  # comparisons of MinHash values let pass what is this far below the threshold
PIVOT_MARGIN = 0.35  # what a pivot holds together: neighbours of its near copies pass too
NEARLY_EQUAL = 0.85
TASK_SETS = 20_000
LEAF_SETS = 4_000  # compared with one another: a pivot after the other meets the rest
PAIR_SETS = 64  # of a leaf whose pairs are listed
DEEPEST = 24  # levels inside a task, below which sets are compared with one another
LEVELS = 3  # levels that the trees of all sets are many enough for
BLOCK_SETS, BLOCK_GRAMS = 2_000, 2_000_000
BROADCAST_SETS = 1_000_000  # members of candidate components, at 48 bytes each
KEPT_WORDS = 200_000
#: Fixed value: an odd multiplier of public 64-bit mixers.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

SETS = T.StructType(
    [
        T.StructField("sid", T.LongType()),
        T.StructField("grams", T.IntegerType()),
        T.StructField("mins", T.BinaryType()),
    ]
)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=1)
def _functions() -> tuple[np.ndarray, np.ndarray]:
    seeds = _mixed(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * MULTIPLIER)
    return seeds[:COORDINATES] | np.uint64(1), seeds[COORDINATES:]


class Shingler:
    """N-gram sets of texts, with a table of the words met so far (bounded)."""

    def __init__(self, words: int = WORDS):
        self.words, self.known = words, {}

    def grams(self, text: str) -> np.ndarray:
        """The distinct 64-bit hashes of a text's n-grams, in order of size."""
        split = text.encode("utf-8", "surrogatepass").split()
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        known = self.known
        for word in set(split).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        n = len(split)
        hashes = np.fromiter(map(known.__getitem__, split), np.uint64, n)
        width = min(self.words, n)
        if not width:
            return hashes
        rolled = np.full(n - width + 1, width, np.uint64)
        for k in range(width):
            rolled = rolled * MULTIPLIER + hashes[k : k + len(rolled)]
        return np.unique(_mixed(rolled))


def min_hashes(grams: np.ndarray) -> np.ndarray:
    times, plus = _functions()
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(grams), 2048):
        part = grams[start : start + 2048, None] * times[None, :] + plus[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def _set_function():
    shingler = Shingler()

    def compute(texts: list) -> list[pa.Array]:
        sids, sizes, mins = [], [], []
        for text in texts:
            grams = shingler.grams(text)
            if len(grams):
                digest = xxhash.xxh3_64_intdigest(grams.tobytes())
                sids.append(digest - (1 << 64) if digest >> 63 else digest)
                mins.append(min_hashes(grams).tobytes())
            else:
                sids.append(None)
                mins.append(None)
            sizes.append(len(grams))
        return [pa.array(sids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(mins, pa.binary())]

    return compute


def lost_within(levels: int) -> float:
    """The chance that a tree loses a pair at the threshold within some levels.

    Of q, that chance, the next level's is (3 * f(q) + f(q)**2) / 4 with f(q) = 1 - THRESHOLD *
    (1 - q): a node samples one coordinate, or two with a chance of a quarter.
    """
    lost = 0.0
    for _ in range(levels):
        child = 1 - THRESHOLD * (1 - lost)
        lost = (3 * child + child**2) / 4
    return lost


def runs_for(recall: float = RECALL, levels: int = LEVELS) -> int:
    """Trees needed so that a pair at the threshold meets in a leaf of one of them."""
    return math.ceil(math.log(1 - recall) / math.log(lost_within(levels)))


def _sampled(node: int) -> list[int]:
    """The coordinates that a node samples: one, or two with a chance of a quarter."""
    seed = xxhash.xxh64_intdigest(node.to_bytes(8, "little", signed=True))
    first = seed % COORDINATES
    if (seed >> 32) % 4:
        return [first]
    return [first, (first + 1 + (seed >> 40) % (COORDINATES - 1)) % COORDINATES]


# ---------------------------------------------------------------- step 2: chosen paths


def first_level(sets: DataFrame, runs: Iterable[int]) -> DataFrame:
    """node, sid (and root, if the sets have it): the children of the roots of the trees ``runs``."""
    nodes = []
    for run in runs:
        for i in _sampled(run + 1):
            value = F.substring("mins", 4 * i + 1, 4)
            nodes.append(F.xxhash64(F.lit(run), F.lit(i), value))
    names = [c for c in ("sid", "root") if c in sets.columns]
    return sets.select(*names, F.explode(F.array(*nodes)).alias("node")).select("node", *names)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """nodes, sids, MinHash values and known depths of whole nodes, of sorted rows (node, sid, mins)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        nodes = batch.column("node").to_numpy()
        last = int(np.searchsorted(nodes, nodes[-1]))  # the last node may go on
        if last == 0:
            held.append(batch)
            if nodes[0] != held[0].column("node")[0].as_py():
                yield _columns(held[:-1])
                held = held[-1:]
            continue
        yield _columns([*held, batch.slice(0, last)])
        held = [batch.slice(last)]
    if held:
        yield _columns(held)


def _columns(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
    table = pa.Table.from_batches(batches)
    mins = b"".join(table.column("mins").to_pylist())
    return (
        table.column("node").to_numpy(),
        table.column("sid").to_numpy(),
        np.frombuffer(mins, "<u4").reshape(-1, COORDINATES),
        table.column("reached").to_numpy() if "reached" in table.column_names else LEVELS,
    )


def leaves(
    node: int, mins: np.ndarray, deepest: int = DEEPEST, most: int | None = None
) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Rows of the leaves below a node, at most ``most`` (LEAF_SETS) that share a path; pairs of a pivot
    and each row that it holds; and the levels below the node that each row was sent down,
    also alone.

    At the level ``deepest`` rows are no longer sent down: pivots are drawn until a leaf is left.
    """
    out, pairs, most = [], [], most or LEAF_SETS
    levels = np.zeros(len(mins), np.int32)
    todo = [(node, np.arange(len(mins)), 0)]
    while todo:
        key, rows, depth = todo.pop()
        levels[rows] = np.maximum(levels[rows], min(depth, deepest))
        if len(rows) <= most:
            if len(rows) > 1:
                out.append(rows)
            continue
        pivot = rows[key % len(rows)]
        alike = (mins[rows] == mins[pivot]).mean(axis=1)
        held = rows[alike >= THRESHOLD - PIVOT_MARGIN]
        pairs.append(np.column_stack([np.full(len(held), pivot), held]))
        # a neighbour of what is nearly equal to the pivot is held as well
        rest = rows[alike < NEARLY_EQUAL]
        if depth >= deepest:
            todo.append((key, rest[rest != pivot], depth + 1))  # the next pivot, with all
            continue
        levels[rest] = np.maximum(levels[rest], depth + 1)
        for i in _sampled(key):
            values = mins[rest, i]
            order = np.argsort(values, kind="stable")
            cuts = np.flatnonzero(np.diff(values[order])) + 1
            for part in np.split(rest[order], cuts):
                if len(part) > 1:
                    child = xxhash.xxh64_intdigest(b"%d %d %d" % (key, i, mins[part[0], i]))
                    todo.append((child - (1 << 63), part, depth + 1))
    return out, pairs, levels


def by_pivots(rows: np.ndarray, mins: np.ndarray) -> np.ndarray:
    """Pairs, fewer than ``rows``, that hold together the alike rows of a leaf.

    What is nearly equal to a pivot needs no pivots of its own: its neighbours are held as well.
    """
    n = len(rows)
    values = np.ascontiguousarray(mins[rows].T)
    label, left = np.arange(n), np.ones(n, bool)
    for i in range(n):
        if not left[i]:
            continue
        same = (values[:, i:] == values[:, i, None]).view(np.uint8).sum(axis=0, dtype=np.uint8)
        same[~left[i:]] = 0
        equal = same >= COORDINATES * NEARLY_EQUAL
        margin = MARGIN if equal.sum() == 1 else PIVOT_MARGIN
        held = label[i:][same >= COORDINATES * (THRESHOLD - margin)]
        left[i:] &= ~equal
        if (held != held[0]).any():
            joined = np.zeros(n, bool)
            joined[held] = True
            label[joined[label]] = held.min()
    moved = np.flatnonzero(label != np.arange(n))
    return np.column_stack([rows[label[moved]], rows[moved]])


def held_together(
    parts: list[np.ndarray], pairs: list[np.ndarray], mins: np.ndarray
) -> np.ndarray:
    """Labels of rows, equal where a path of ``pairs`` or of alike rows of a part joins them."""
    pairs = [*pairs, *(by_pivots(p, mins) for p in parts if len(p) > PAIR_SETS)]
    parts = [p for p in parts if len(p) <= PAIR_SETS]
    sizes = np.array([len(p) for p in parts], np.int64)
    label = np.arange(len(mins))
    none = [np.zeros(0, np.int64)]
    flat = np.concatenate(parts or none)
    starts = np.cumsum(sizes) - sizes
    left, right = list(none), list(none)
    for size in np.unique(sizes):
        a, b = np.triu_indices(size, 1)
        first = starts[sizes == size][:, None]
        left.append((first + a[None, :]).ravel())
        right.append((first + b[None, :]).ravel())
    left, right = flat[np.concatenate(left)], flat[np.concatenate(right)]
    near = np.empty(len(left), bool)
    for start in range(0, len(left), 1 << 16):
        part = slice(start, start + (1 << 16))
        near[part] = (mins[left[part]] == mins[right[part]]).sum(axis=1) >= COORDINATES * (
            THRESHOLD - MARGIN
        )
    fixed = np.concatenate([np.zeros((0, 2), np.int64), *pairs])
    left = np.concatenate([left[near], fixed[:, 0]])
    right = np.concatenate([right[near], fixed[:, 1]])
    while True:
        least = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, least)
        np.minimum.at(label, right, least)
        label = label[label]
        if (label == before).all():
            return label


def _join_nodes(level: int, most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) of nodes at a level, and how deep u went; with v null sets that went deeper than
    LEVELS, or than is known of them, and have no edge."""
    for nodes, sids, mins, reached in _groups(batches):
        edges = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1], [True]]))
        parts, pairs = [], []
        depth = np.full(len(sids), level, np.int32)
        for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if end - begin <= most:
                parts.append(np.arange(begin, end))
            else:
                below, held, levels = leaves(int(nodes[begin]), mins[begin:end], most=most)
                depth[begin:end] += levels
                parts += [begin + p for p in below]
                pairs += [begin + p for p in held]
        label = held_together(parts, pairs, mins)
        moved = label != np.arange(len(label))
        rows = np.flatnonzero(moved | (depth > reached))
        v = pa.array(sids[label[rows]], mask=~moved[rows])
        columns = [pa.array(sids[rows]), v, pa.array(depth[rows])]
        yield pa.RecordBatch.from_arrays(columns, names=["u", "v", "depth"])


def _alike(a, b) -> F.Column:
    """The share of equal MinHash values of two columns of them."""
    same = [
        (F.substring(a, 4 * i + 1, 4) == F.substring(b, 4 * i + 1, 4)).cast("int")
        for i in range(COORDINATES)
    ]
    total = same[0]
    for s in same[1:]:
        total = total + s
    return total / COORDINATES


def _with_mins(entries: DataFrame, sets: DataFrame) -> DataFrame:
    """node and the columns of ``sets`` of entries (node, sid): a set is looked up once, with the list of its nodes."""
    nodes = entries.groupBy("sid").agg(F.collect_list("node").alias("nodes"))
    return nodes.join(sets, "sid").select(F.explode("nodes").alias("node"), *sets.columns)


def _split(large: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """Edges of the pivots of large nodes at a level, with v null the sets that go deeper than
    is known of them, and the entries of their children."""
    drawn = F.struct(F.xxhash64("node", "sid").alias("draw"), "sid", "mins")
    pivots = common.settled(
        large.groupBy("node").agg(F.min(drawn).alias("p")).select(
            "node", F.col("p.sid").alias("pivot"), F.col("p.mins").alias("pivot_mins")
        ),
        "pivots",
    )
    near = common.settled(
        large.join(pivots, "node").withColumn("alike", _alike("mins", "pivot_mins")), "near"
    )
    edges = near.where((F.col("alike") >= THRESHOLD - PIVOT_MARGIN) & (F.col("sid") != F.col("pivot")))
    rest = near.where(F.col("alike") < NEARLY_EQUAL)
    seed = F.xxhash64("node", F.lit("sampled"))
    first = F.pmod(seed, F.lit(COORDINATES))
    more = (first + 1 + F.pmod(F.shiftright(seed, 40), F.lit(COORDINATES - 1))) % COORDINATES
    two = F.pmod(F.shiftright(seed, 32), F.lit(4)) == 0
    chosen = F.when(two, F.array(first, more)).otherwise(F.array(first))
    names = [c for c in ("sid", "root") if c in large.columns]
    children = rest.select(*names, "mins", "node", F.explode(chosen).alias("i")).select(
        F.xxhash64("node", "i", F.expr("substring(mins, cast(4 * i + 1 AS int), 4)")).alias("node"),
        *names,
    )
    found = edges.select(F.col("sid").alias("u"), F.col("pivot").alias("v"))
    if level + 1 > LEVELS:
        known = F.col("reached") if "reached" in large.columns else F.lit(LEVELS)
        deep = rest.where(known < level + 1)
        found = found.unionByName(deep.select(F.col("sid").alias("u"), F.lit(None).cast("long").alias("v")))
    return found.withColumn("depth", F.lit(level + 1)), children


def _trees(sets: DataFrame, runs: Iterable[int]) -> DataFrame:
    """u, v, depth of the trees ``runs``: edges and how deep u went; v is null for other sets that
    went deeper than LEVELS.

    Sets may have a ``root`` and ``reached``, the component and the depth that earlier trees found. Nodes of one component are
    left out: their sets are held together and will be compared exactly whatever is found here.
    """
    entries, level, out = first_level(sets, runs), 1, []
    several = F.min("root") < F.max("root") if "root" in sets.columns else F.count("*") > 1
    while True:
        entries = common.settled(entries, "entries")
        sizes = entries.groupBy("node").agg(F.count("*").alias("n"), several.alias("several"))
        sizes = common.settled(sizes.where("several").select("node", "n"), "nodes")
        shared = entries.join(sizes, "node")
        small = shared.where(F.col("n") <= TASK_SETS).select("node", "sid")
        out.append(
            _with_mins(small, sets.drop("root"))
            .repartition("node")
            .sortWithinPartitions("node", "sid")
            .mapInArrow(partial(_join_nodes, level, LEAF_SETS), "u long, v long, depth int")
        )
        if sizes.where(F.col("n") > TASK_SETS).isEmpty():
            return reduce(DataFrame.unionByName, out)
        large = shared.where(F.col("n") > TASK_SETS).select("node", "sid")
        found, entries = _split(_with_mins(large, sets), level)
        out.append(found)
        level += 1


def candidate_edges(sets: DataFrame, recall: float = RECALL) -> DataFrame:
    """u, v: edges that hold together all sets which any comparison found alike.

    The trees so far are enough for ``levels``. A pair that all of them lost needs more only if
    both its sets went deeper in some tree: else each tree lost it within that many levels. The
    chances of a loss for the levels of all rounds add up to no more than 1 - ``recall``.
    """
    done, levels, spare, edges, marks = 0, LEVELS, 1 - recall, [], []
    wanted = runs_for(recall, levels)
    while True:
        made = common.settled(_trees(sets, range(done, wanted)), "trees")
        edges.append(made.where("v IS NOT NULL").select("u", "v"))
        marks.append(made.select(F.col("u").alias("sid"), "depth"))
        deep = reduce(DataFrame.unionByName, marks).where(F.col("depth") > levels)
        deepest = deep.agg(F.max("depth")).first()[0]
        if deepest is None:
            return reduce(DataFrame.unionByName, edges)
        held = common.settled(components(reduce(DataFrame.unionByName, edges)), "held")
        edges = [held.select(F.col("node").alias("u"), F.col("root").alias("v"))]
        spare -= lost_within(levels) ** wanted
        done, levels = wanted, min(2 * levels, deepest)
        wanted = max(done + 1, runs_for(1 - spare / 2, levels))
        reached = deep.groupBy("sid").agg(F.max("depth").alias("reached"))
        some = sets.select("sid", "mins").join(reached, "sid")
        some = some.join(held.withColumnRenamed("node", "sid"), "sid", "left")
        sets = common.settled(some.withColumn("root", F.coalesce("root", "sid")), "deep-sets")


# ---------------------------------------------------------------- step 3: exact links

MEMBERS = "part string, whole boolean, sid long, copies long, first boolean, grams binary"
FOUND = "sid long, root long, links long"


def common_grams(sets: list[np.ndarray]) -> np.ndarray:
    """The number of common n-grams of all pairs of sets.

    N-grams of many sets are columns of a matrix that is multiplied by itself; those of few sets
    add one to each of their pairs.
    """
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    owner, flat = owner[order], flat[order]
    edges = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1], [True]]))
    starts, counts = edges[:-1], np.diff(edges)
    often = np.flatnonzero(counts >= 32)
    for begin in range(0, len(often), 2048):
        part = often[begin : begin + 2048]
        columns = np.repeat(np.arange(len(part)), counts[part])
        where = np.concatenate([np.arange(starts[c], starts[c] + counts[c]) for c in part])
        matrix = np.zeros((n, len(part)), np.float32)
        matrix[owner[where], columns] = 1
        out += matrix @ matrix.T
    pairs = out.reshape(-1)
    for count in range(2, 32):
        those = starts[counts == count]
        a, b = np.triu_indices(count, 1)
        for begin in range(0, len(those), 1 + (1 << 20) // len(a)):
            first = those[begin : begin + 1 + (1 << 20) // len(a), None]
            cells = owner[first + a].astype(np.int64) * n + owner[first + b]
            which, times = np.unique(cells, return_counts=True)
            pairs[which] += times
    return np.maximum(out, out.T)


def exact_links(sets: list[np.ndarray]) -> np.ndarray:
    """Which pairs have a Jaccard similarity of at least the threshold."""
    both = common_grams(sets)
    sizes = np.array([len(s) for s in sets], np.float64)
    links = both >= THRESHOLD * (sizes[:, None] + sizes[None, :] - both) - 1e-6
    np.fill_diagonal(links, False)
    return links


def _link_block(
    whole: bool, sids: list[int], copies: list[int], first: list[bool], sets: list[np.ndarray]
):
    links = exact_links(sets)
    if not whole:  # two blocks, either may be empty: pairs inside one are another part's
        side = np.array(first)
        links &= side[:, None] != side[None, :]
    label = np.arange(len(sids))
    left, right = np.nonzero(links)
    while len(left):
        before = label.copy()
        np.minimum.at(label, left, label[right])
        label = label[label]
        if (label == before).all():
            break
    roots = np.array(sids)[label]
    counts = links.astype(np.float64) @ np.array(copies, np.float64)
    return roots, counts.astype(np.int64)


def _link_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """FOUND for every part of sorted MEMBERS."""
    part, rows = None, []

    def linked():
        whole, sids, copies, first, grams = zip(*rows, strict=True)
        sets = [np.frombuffer(g, np.uint64) for g in grams]
        roots, links = _link_block(whole[0], list(sids), list(copies), list(first), sets)
        columns = [pa.array(sids, pa.int64()), pa.array(roots, pa.int64()), pa.array(links)]
        return pa.RecordBatch.from_arrays(columns, names=["sid", "root", "links"])

    for batch in batches:
        for small in common.slices(batch, "grams", 16 << 20):
            parts, *columns = (c.to_pylist() for c in small.columns)
            for name, *row in zip(parts, *columns, strict=True):
                if name != part and rows:
                    yield linked()
                    rows = []
                part = name
                rows.append(row)
    if rows:
        yield linked()


GRAMS = T.StructType([T.StructField("grams", T.BinaryType())])


def _gram_function():
    shingler = Shingler()

    def compute(texts: list) -> list[pa.Array]:
        return [pa.array([shingler.grams(t).tobytes() for t in texts], pa.binary())]

    return compute


def _blocks(members: DataFrame) -> DataFrame:
    """``members`` with level, block, and others: the blocks that a set has to meet, its own included.

    A component that fits is one block. Of others, sets of like sizes make a level, whose
    blocks are drawn by hash: a set may link to its own level and the two next to it only, since
    the smaller of two linked sets has at least THRESHOLD of the larger one's n-grams.
    """
    total = members.groupBy("root").agg(F.count("*").alias("sets"), F.sum("grams").alias("total"))
    fits = (F.col("sets") <= BLOCK_SETS) & (F.col("total") <= BLOCK_GRAMS)
    # a little wider than the threshold, so that rounding parts no linked sizes
    log = F.log(F.col("grams").cast("double")) / (math.log(1 / THRESHOLD) + 1e-9)
    level = F.when(F.col("fits"), F.lit(0)).otherwise(F.floor(log).cast("int"))
    leveled = members.join(total.select("root", fits.alias("fits")), "root").withColumn("level", level)
    many = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("grams") / BLOCK_GRAMS))
    sizes = common.settled(
        leveled.groupBy("root", "level", "fits")
        .agg(many.cast("int").alias("blocks"))
        .withColumn("blocks", F.when(F.col("fits"), F.lit(1)).otherwise(F.col("blocks"))),
        "blocks",
    )
    near = sizes.select(
        "root", F.col("level").alias("next"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b")
    )
    met = sizes.join(near, "root").where(F.abs(F.col("next") - F.col("level")) <= 1)
    others = F.collect_list(F.struct(F.col("next").alias("level"), F.col("b").alias("block")))
    lists = met.groupBy("root", "level", "blocks").agg(others.alias("others"))
    return (
        leveled.drop("fits")
        .join(lists, ["root", "level"])
        .withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    )


def exact_classes(docs: DataFrame, members: DataFrame) -> DataFrame:
    """sid, root, links of members (sid, root, copies, grams, doc_id, text_hash).

    ``root`` names the candidate component; doc_id and text_hash a document that has the set.
    """
    placed = _blocks(members).drop("grams")
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    one = placed.withColumnRenamed("doc_id", "of")
    if members.count() <= BROADCAST_SETS:  # else the texts meet the members in a shuffle
        one = F.broadcast(one)
    matched = texts.join(
        one, (texts.text_hash == one.text_hash) & texts.doc_id.eqNullSafe(one["of"])
    ).drop("of", "doc_id", "text_hash")
    sets = common.map_texts(matched, _gram_function, GRAMS, "made").drop("text")
    # a part for each pair of blocks whose sizes allow a link, and for each block
    here, there = F.struct("level", "block"), F.struct("other.level", "other.block")
    parts = (
        sets.withColumn("other", F.explode("others"))
        .withColumn("low", F.least(here, there))
        .withColumn("high", F.greatest(here, there))
        .select(
            F.concat_ws(" ", "root", "low.level", "low.block", "high.level", "high.block").alias("part"),
            (F.col("low") == F.col("high")).alias("whole"),
            "sid",
            "copies",
            (here == F.col("low")).alias("first"),
            F.col("made.grams").alias("grams"),
        )
        .dropDuplicates(["part", "sid"])
    )
    found = common.settled(
        parts.repartition("part").sortWithinPartitions("part", "sid").mapInArrow(_link_parts, FOUND),
        "found",
    )
    links = found.groupBy("sid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("sid").alias("u"), F.col("root").alias("v")))
    return links.join(roots.select(F.col("node").alias("sid"), "root"), "sid", "left").select(
        "sid", F.coalesce("root", "sid").alias("root"), "links"
    )


# ---------------------------------------------------------------- the operator


def joined(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """doc_id, text_hash, class_id, class_hash and n_links of documents (doc_id, text).

    class_id and class_hash are doc_id and text_hash of the class's first document; both are null
    for documents without a word.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sized = common.map_texts(slim, _set_function, SETS, "made")
    known = common.settled(
        sized.select("doc_id", F.xxhash64("text").alias("text_hash"), "made.*"), "sets"
    )
    some = known.where("sid IS NOT NULL")
    head = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    distinct = common.settled(
        some.groupBy("sid").agg(
            F.min(head).alias("head"),
            F.count("*").alias("copies"),
            F.first("grams").alias("grams"),
            F.first("mins").alias("mins"),
        ),
        "distinct",
    )
    edges = candidate_edges(distinct.select("sid", "mins"), recall)
    held = components(edges)
    members = common.settled(
        distinct.join(held.withColumnRenamed("node", "sid"), "sid").select(
            "sid", "root", "copies", "grams", "head.doc_id", "head.text_hash"
        ),
        "members",
    )
    exact = exact_classes(slim, members)
    by_set = distinct.select("sid", "head", "copies").join(exact, "sid", "left").select(
        "sid",
        "head",
        F.coalesce("root", "sid").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    by_set = common.settled(by_set, "by-set")
    classes = by_set.groupBy("root").agg(F.min("head").alias("class"))
    result = common.settled(by_set.join(classes, "root").select("sid", "class", "n_links"), "classes")
    return known.select("doc_id", "text_hash", "sid").join(result, "sid", "left").select(
        "doc_id",
        "text_hash",
        F.col("class.doc_id").alias("class_id"),
        F.col("class.text_hash").alias("class_hash"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.col("sid").isNull().alias("alone"),
    )


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_links of documents (doc_id, text)."""
    own = F.when(F.col("alone"), F.col("doc_id")).otherwise(F.col("class_id"))
    return joined(docs).select("doc_id", own.alias("class_id"), "n_links")


def first_of_each(docs: DataFrame) -> DataFrame:
    """The first document of each class, with all its columns; documents without words stay."""
    found = joined(docs)
    same = F.col("doc_id").eqNullSafe(F.col("class_id"))
    first = found.where("NOT alone").where(same & (F.col("text_hash") == F.col("class_hash")))
    keys = common.settled(
        first.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(),
        "firsts",
    )
    rows = docs.select(
        F.struct(*docs.columns).alias("payload"),
        F.col("doc_id").cast("long").alias("own_id"),
        F.xxhash64("text").alias("own_hash"),
    )
    kept = rows.join(
        keys, (F.col("own_hash") == F.col("_hash")) & F.col("own_id").eqNullSafe(F.col("_id"))
    )
    once = F.row_number().over(Window.partitionBy("own_hash", "own_id").orderBy(F.lit(0)))
    firsts = kept.withColumn("once", once).where("once = 1").select("payload.*")
    wordless = docs.where(~F.coalesce("text", F.lit("")).rlike(f"[^{common.SPACE}]"))
    return firsts.unionByName(wordless)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(common.documents(spark, sf_dir, "doc_id", "text"))
