"""Trie of conversation prefixes, with subtree totals by parallel tree contraction (operator 11).

Conversations that begin with the same turns share a path from the root; a node is one distinct
sequence of first turns. Its members are counted by grouping; what its subtree holds is summed by
contraction of the tree, in rounds of joins over the nodes that are left:

* rake: every leaf is taken off and its total is added to its parent;
* compress: of the nodes that have one child left, those whose coin is up and whose child's coin is
  down are taken out, their total goes to their parent, and their child hangs on that parent. No two
  neighbours are ever taken out in a round. Coins are the bits of the depth, one bit a round, so a
  round halves a chain, and rounds grow with the logarithm of the nodes.

Afterwards contracted nodes are expanded again: a raked node's total was right when it went; a
node that was taken out has its own total and that of the child it had then. These pointers are
resolved by doubling, so it takes the logarithm of the number of rounds.

No task holds a conversation, a node's children or a node's members. Turns are put in order by one
range sort, with places counted inside the pieces of a conversation that its tasks hold. The
identity of a prefix is 128 bits, each turn's hash with its place, combined by exclusive or, so
that a long conversation's prefixes are combined by blocks. Only hashes move after the sort.

Rows without a conv_id belong to no conversation. Null roles and texts are empty ones. Turns with
one number go by role, then text; repeated rows are turns of their own. Conversations without turns
end at the root. An empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayframe.llm import common

FAMILY = 5  # fixed values of the rebuilt conversations: c - c % 5 lends its first crc32(c) % 9 turns
LENT = 9
BLOCK = 1024  # turns whose prefixes are combined in one window
MAX_ROUNDS = 400  # far more than any tree takes; a guard against tables with a cycle
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
NODE = ["p1", "p2"]


def ordered(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), t1, t2 (hashes of role and text), bytes of turns, in order."""
    turns = conversations.where("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    in_order = turns.orderBy("conv_id", F.asc_nulls_first("turn"), "role", "text").select(
        "conv_id",
        F.monotonically_increasing_id().alias("at"),
        F.xxhash64(F.lit(1), "role", "text").alias("t1"),
        F.xxhash64(F.lit(2), "role", "text").alias("t2"),
        F.octet_length("text").cast("long").alias("bytes"),
    )
    rows = common.settled(in_order, "turns").withColumn("task", F.shiftright("at", 33))
    pieces = rows.groupBy("conv_id", "task").agg(F.min("at").alias("low"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("task")
    before = F.coalesce(F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = pieces.select("conv_id", "task", (before + 1 - F.col("low")).alias("shift"))
    return rows.join(pieces, ["conv_id", "task"]).select(
        "conv_id", (F.col("at") + F.col("shift")).alias("place"), "t1", "t2", "bytes"
    )


def lengths(turns: DataFrame) -> DataFrame:
    """conv_id and n, the number of its turns."""
    return turns.groupBy("conv_id").agg(F.count("*").alias("n"))


def rebuilt(turns: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations with a beginning that others lend, and their lengths.

    The first h turns of conversation c - c % 5, then the own turns after the first h.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % LENT
    lender = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < LENT))
    borrowers = sizes.select("conv_id", "n", h.alias("h"), lender.alias("lender"))
    lenders = sizes.select(F.col("conv_id").alias("lender"), F.col("n").alias("has"))
    plan = common.settled(
        borrowers.join(lenders, "lender", "left").select(
            "conv_id",
            "lender",
            "h",
            F.least("h", F.coalesce("has", F.lit(0))).alias("lent"),
            F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("own"),
        ),
        "borrowers",
    )
    borrowed = heads.withColumnRenamed("conv_id", "lender").join(
        plan.select("conv_id", "lender", "h"), "lender"
    )
    own = turns.join(plan.select("conv_id", "h", "lent"), "conv_id").where("place > h")
    columns = ["conv_id", "place", "t1", "t2", "bytes"]
    out = borrowed.where("place <= h").select(*columns).unionByName(
        own.withColumn("place", F.col("place") - F.col("h") + F.col("lent")).select(*columns)
    )
    return out, plan.select("conv_id", (F.col("lent") + F.col("own")).alias("n"))


def prefixes(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """conv_id, depth, p1, p2 (the prefix), q1, q2 (the prefix before), bytes, ends of every
    conversation at every depth, from the root on."""
    block = F.shiftright(F.col("place") - 1, BLOCK.bit_length() - 1)
    marked = common.settled(
        turns.select(
            "conv_id",
            "place",
            block.alias("block"),
            F.xxhash64(F.lit(1), "place", "t1").alias("z1"),
            F.xxhash64(F.lit(2), "place", "t2").alias("z2"),
            "bytes",
        ),
        "marked",
    )
    # what the blocks before one come to; no row for a first block
    whole = marked.groupBy("conv_id", "block").agg(F.bit_xor("z1").alias("z1"), F.bit_xor("z2").alias("z2"))
    earlier = (
        Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = whole.select(
        "conv_id", "block", *[F.bit_xor(z).over(earlier).alias(f"c{z}") for z in ("z1", "z2")]
    ).where("block > 0")
    so_far = Window.partitionBy("conv_id", "block").orderBy("place")
    inside = marked.select(
        "*", *[F.bit_xor(z).over(so_far).alias(f"i{z}") for z in ("z1", "z2")]
    )

    def prefix(z: str) -> Column:
        return F.col(f"i{z}").bitwiseXOR(F.coalesce(F.col(f"c{z}"), F.lit(0)))

    deeper = (
        inside.join(carried, ["conv_id", "block"], "left")
        .join(sizes, "conv_id")
        .select(
            "conv_id",
            F.col("place").alias("depth"),
            prefix("z1").alias("p1"),
            prefix("z2").alias("p2"),
            prefix("z1").bitwiseXOR(F.col("z1")).alias("q1"),
            prefix("z2").bitwiseXOR(F.col("z2")).alias("q2"),
            "bytes",
            (F.col("place") == F.col("n")).alias("ends"),
        )
    )
    none = [F.lit(0).cast("long").alias(c) for c in ("depth", "p1", "p2", "q1", "q2", "bytes")]
    return deeper.unionByName(sizes.select("conv_id", *none, (F.col("n") == 0).alias("ends")))


def numbered(found: DataFrame) -> DataFrame:
    """The nodes, with numbers: id, parent (root: null), conv_id, depth, n_convs, own, p1, p2."""
    grouped = found.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.count("*").alias("n_convs"),
        F.max("bytes").alias("bytes"),
        F.max("q1").alias("q1"),
        F.max("q2").alias("q2"),
    )
    own = ((F.col("n_convs") - 1) * F.col("bytes")).alias("own")
    nodes = common.settled(
        grouped.select(
            F.monotonically_increasing_id().alias("id"), *NODE, "q1", "q2", "conv_id", "depth", "n_convs", own
        ),
        "nodes",
    )
    above = nodes.select(
        F.col("id").alias("parent"),
        F.col("p1").alias("q1"),
        F.col("p2").alias("q2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    below = nodes.where("depth > 0").join(above, ["q1", "q2"])
    root = nodes.where("depth = 0").select(
        "*", *[F.lit(None).cast("long").alias(c) for c in ("parent", "parent_conv_id")]
    )
    return common.settled(below.unionByName(root).drop("q1", "q2"), "tree")


def _coin(depth: Column, bit: int) -> Column:
    return F.shiftright(depth, bit).bitwiseAND(F.lit(1)) == 1


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """id and, for each of ``values``, its sum over the subtree of every node.

    ``tree``: id, parent (root: null), depth, n_children and the values, all long. Sums must fit.
    """
    sums = [f"sum_{v}" for v in values]
    live = common.settled(
        tree.select(
            "id", "parent", "depth", (F.col("n_children") == 0).alias("leaf"),
            *[F.col(v).alias(s) for v, s in zip(values, sums, strict=True)],
        ),
        "live",
    )
    bits = max(1, (live.agg(F.max("depth")).first()[0] or 0).bit_length())
    gone: list[DataFrame] = []
    pending: DataFrame | None = None  # totals of nodes taken out, for the parents they had
    for number in range(MAX_ROUNDS):
        state, left = _round(live, pending, sums, number % bits)
        gone.append(state.where("fate <> 'live'"))
        live = state.where("fate = 'live'").select("id", "parent", "depth", "leaf", *sums)
        pending = state.where("fate = 'compressed'").select(F.col("parent").alias("to"), *sums)
        if not left:
            break
    else:
        raise RuntimeError("the tree did not contract; is there a cycle?")
    known = live
    for part in gone:
        known = known.unionByName(part, allowMissingColumns=True)
    return _expanded(known, sums).select(
        "id", *[F.col(s).alias(v) for v, s in zip(values, sums, strict=True)]
    )


def _round(live: DataFrame, pending: DataFrame | None, sums: list[str], bit: int) -> tuple[DataFrame, int]:
    """One rake and one compress: the nodes with their fate, and how many but the root are left."""
    sent = live.where("parent IS NOT NULL").select(
        F.col("parent").alias("to"),
        *[F.when(F.col("leaf"), F.col(s)).alias(s) for s in sums],
        *[F.when(~F.col("leaf"), F.col(c)).alias(f"kid_{c}") for c in ("id", "depth")],
    )
    if pending is not None:
        sent = sent.unionByName(pending, allowMissingColumns=True)
    got = sent.groupBy("to").agg(
        *[F.sum(s).alias(f"more_{s}") for s in sums],
        F.count("kid_id").alias("kids"),
        F.min("kid_id").alias("kid"),
        F.min("kid_depth").alias("kid_depth"),
    )
    raked = live.join(got, live["id"] == got["to"], "left").drop("to")
    single = F.col("parent").isNotNull() & ~F.col("leaf") & (F.col("kids") == 1)
    out = single & _coin(F.col("depth"), bit) & ~_coin(F.col("kid_depth"), bit)
    judged = raked.select(
        "id",
        "parent",
        "depth",
        (F.coalesce("kids", F.lit(0)) == 0).alias("leaf"),
        *[(F.col(s) + F.coalesce(f"more_{s}", F.lit(0))).alias(s) for s in sums],
        "kid",
        F.when(F.col("leaf") & F.col("parent").isNotNull(), "raked")
        .when(out, "compressed")
        .otherwise("live")
        .alias("fate"),
    )
    moved = judged.where("fate = 'compressed'").select(
        F.col("kid").alias("id"), F.col("parent").alias("new_parent")
    )
    state = judged.join(moved, "id", "left").select(
        "id",
        F.coalesce("new_parent", "parent").alias("parent"),
        "depth",
        "leaf",
        *sums,
        F.when(F.col("fate") == "compressed", F.col("kid")).alias("kid"),
        "fate",
    )
    seen = Observation()
    rest = F.count_if((F.col("fate") == "live") & F.col("parent").isNotNull())
    return common.settled(state.observe(seen, rest.alias("left")), "round"), seen.get["left"]


def _expanded(known: DataFrame, sums: list[str]) -> DataFrame:
    """id and totals of all nodes, from nodes whose total lacks that of ``kid``, where there is one."""
    known = common.settled(known.select("id", "kid", *sums), "contracted")
    open_ = known.where("kid IS NOT NULL")
    done = [known.where("kid IS NULL").drop("kid")]
    while not open_.isEmpty():
        other = known.select(
            F.col("id").alias("kid"),
            F.col("kid").alias("next"),
            *[F.col(s).alias(f"more_{s}") for s in sums],
        )
        step = open_.join(other, "kid").select(
            "id",
            F.col("next").alias("kid"),
            *[(F.col(s) + F.col(f"more_{s}")).alias(s) for s in sums],
        )
        # pointers of open nodes lead to nodes whose pointers are doubled alike
        open_now = common.settled(step, "expanded")
        done.append(open_now.where("kid IS NULL").drop("kid"))
        open_ = open_now.where("kid IS NOT NULL")
        closed = done[0]
        for part in done[1:]:
            closed = closed.unionByName(part)
        known = open_.unionByName(closed.withColumn("kid", F.lit(None).cast("long")))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def end_digests(found: DataFrame) -> DataFrame:
    """p1, p2, ends_sha256: SHA-256 of the conversations that end at a node, in ascending order.

    A digest of a list is a chain, so the numbers of one node go through one task, sorted by Spark
    and hashed as they come; the task holds one digest, however many there are.
    """
    ends = found.where("ends").select(*NODE, "conv_id")
    sorted_ends = ends.repartition(*NODE).sortWithinPartitions(*NODE, "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest = None, None
        for batch in batches:
            a, b, c = (batch.column(i).to_numpy() for i in range(3))
            new = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
            out = []
            for low, high in zip([0, *new.tolist()], [*new.tolist(), len(a)], strict=True):
                if low == high:
                    continue
                key, text = (int(a[low]), int(b[low])), ",".join(map(str, c[low:high].tolist()))
                if key == last:
                    digest.update(b"," + text.encode())
                else:
                    if last is not None:
                        out.append((*last, digest.hexdigest()))
                    last, digest = key, hashlib.sha256(text.encode())
            yield _rows(out)
        if last is not None:
            yield _rows([(*last, digest.hexdigest())])

    return sorted_ends.mapInArrow(run, "p1 long, p2 long, ends_sha256 string")


def _rows(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.string())
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["p1", "p2", "ends_sha256"])


def trie(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """The nodes of conversations: ``turns`` as ``ordered`` gives them, and their lengths.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, and node, the identity of the prefix, as 32 hexadecimal digits.
    """
    found = common.settled(prefixes(turns, sizes), "prefixes")
    tree = numbered(found)
    children = tree.where("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("n_children"))
    with_children = common.settled(
        tree.join(children.withColumnRenamed("parent", "id"), "id", "left").withColumn(
            "n_children", F.coalesce("n_children", F.lit(0))
        ),
        "children",
    )
    leaves = with_children.withColumn("leaves", (F.col("n_children") == 0).cast("long"))
    totals = subtree_totals(leaves, ["leaves", "own"])
    return (
        with_children.drop("own")
        .join(totals, "id")
        .join(end_digests(found), NODE, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("own").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
            F.lower(F.concat(*[F.lpad(F.hex(p), 16, "0") for p in NODE])).alias("node"),
        )
    )


def conversation_trie(conversations: DataFrame, *, rebuild: bool = False) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text), as they are or rebuilt."""
    turns = ordered(conversations)
    sizes = lengths(turns)
    if rebuild:
        turns, sizes = rebuilt(common.settled(turns, "places"), common.settled(sizes, "sizes"))
    return trie(turns, sizes)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversation_trie(conversations, rebuild=True).drop("node")


SQL = f"""
WITH ordered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
  SELECT conv_id, count(*) AS n,
    xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::BIGINT) % {LENT} AS h
  FROM ordered GROUP BY conv_id
), plan AS (
  SELECT s.*, s.conv_id - s.conv_id % {FAMILY} AS lender, least(s.h, coalesce(o.n, 0)) AS lent
  FROM sizes s LEFT JOIN sizes o ON o.conv_id = s.conv_id - s.conv_id % {FAMILY}
), rebuilt AS (
  SELECT p.conv_id, place AS depth, role, text FROM plan p JOIN ordered o
    ON o.conv_id = p.lender AND o.place <= p.h
  UNION ALL SELECT p.conv_id, place - h + lent, role, text FROM plan p JOIN ordered o
    ON o.conv_id = p.conv_id AND o.place > p.h
), paths AS (
  SELECT conv_id, depth, strlen(text) AS bytes, string_agg(md5(role || chr(0) || text), '')
    OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM sizes
), nodes AS (
  SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * any_value(bytes) AS own, left(path, length(path) - 32) AS above
  FROM paths GROUP BY path
), children AS (
  SELECT above AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY above
), counted AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (path)
), totals AS (
  SELECT a.path, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, sum(b.own)::BIGINT AS saved
  FROM counted a JOIN counted b ON starts_with(b.path, a.path) GROUP BY a.path
), ends AS (
  SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS digest FROM (
    SELECT conv_id, arg_max(path, depth) AS path FROM paths GROUP BY conv_id) GROUP BY path
)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves,
  saved AS saved_tokens, coalesce(digest, sha256('')) AS ends_sha256
FROM counted c JOIN totals USING (path) LEFT JOIN ends USING (path)
LEFT JOIN nodes p ON p.path = c.above AND c.depth > 0
"""
