"""The prefix trie of conversations, by family-first merging.

Conversations of one hundred (the family of a base id) begin with turns of the family's base conversation. Families are
brought together by base id, rebuilt in a stream, and each makes a small trie of its own, so that what the family shares is
combined before anything meets globally; only combined nodes are shuffled again, by node, and merged by partial aggregates.
A node is named by a 128-bit hash of its parent's name and its turn.

Values of subtrees need no step for each level: the nodes whose smallest member is one conversation form a vertical chain,
so the trie is a tree of chains. Chains add up into the chains above them by pointer doubling (a round for each power of
two of the height of that tree), and a running sum along each chain gives every node its subtree.

Memory: a family is streamed, never collected; its trie is emitted and begun anew at `FLUSH` nodes, as merging is a sum. The
hash of a node's ending members is taken in a stream over rows of at most a family's ids, ordered within partitions.

Defined results: a null role or text is empty; turns stand by turn (null first), ties by role, then by text; repeated rows
are turns of their own; rows without conv_id are left out; the base of a negative id is that of SQL's `%`; extra columns are
ignored; an empty table has no rows, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, drop_cut, small_batches

FAMILY, SHARED = 100, 6
#: Nodes that a family's trie may have before it is emitted in part.
FLUSH = 50_000
ROOT = hashlib.blake2b(b"", digest_size=16).digest()

_NODES = "id binary, parent binary, depth long, chars long, low long, n long, base long, ends array<bigint>"
_ARROW = pa.schema([("id", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("chars", pa.int64()), ("low", pa.int64()), ("n", pa.int64()), ("base", pa.int64()), ("ends", pa.list_(pa.int64()))])


class _Family:
    """The trie of one family, fed turn by turn."""

    def __init__(self, base: int):
        self.base, self.head, self.nodes = base, [], {}
        self.conv = self.at = None

    def visit(self, parent: bytes | None, chars: int, n: int = 1) -> list:
        node = self.nodes.get(self.at)
        if node is None:
            node = self.nodes[self.at] = [parent, self.depth, chars, self.conv, 0, []]
        node[3] = min(node[3], self.conv)
        node[4] += n
        return node

    def step(self, role: str, text: str) -> None:
        parent, r = self.at, role.encode()
        self.at, self.depth = hashlib.blake2b(b"%s%d:%s%s" % (parent, len(r), r, text.encode()), digest_size=16).digest(), self.depth + 1
        self.visit(parent, len(text))

    def begin(self, conv: int, shared: int) -> None:
        self.conv, self.shared, self.own, self.at, self.depth, self.last = conv, shared, 0, ROOT, 0, (None, 0)
        self.visit(None, 0)
        if conv != self.base:
            for turn in self.head[:shared]:
                self.last = (self.at, len(turn[1]))
                self.step(*turn)

    def turn(self, role: str, text: str) -> None:
        if self.conv == self.base and len(self.head) < SHARED - 1:
            self.head.append((role, text))
        if self.conv == self.base or self.own >= self.shared:
            self.last = (self.at, len(text))
            self.step(role, text)
        self.own += 1

    def end(self) -> None:
        self.visit(*self.last, n=0)[5].append(self.conv)

    def rows(self) -> Iterator[tuple]:
        for name, (parent, depth, chars, low, n, ends) in self.nodes.items():
            yield name, parent, depth, chars, low, n, self.base, ends
        self.nodes = {}


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


def family_nodes(turns: DataFrame) -> DataFrame:
    """Combined nodes of each family's rebuilt conversations: (id, parent, depth, chars, low, n, base, ends); sums over equal ids are the trie's."""
    small_batches(turns.sparkSession, 2000)
    conv = F.col("conv_id").cast("bigint")
    rows = turns.select(conv.alias("conv_id"), F.col("turn").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]).filter("conv_id IS NOT NULL")
    rows = rows.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn("shared", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, out = None, []
        for batch in batches:
            for base, conv, shared, role, text in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if family is None or family.base != base or family.conv != conv:
                    if family is not None:
                        family.end()
                    if family is None or family.base != base:
                        out.extend(family.rows() if family else ())
                        family = _Family(base)
                    family.begin(conv, shared)
                family.turn(role, text)
                if len(family.nodes) >= FLUSH:
                    out.extend(family.rows())
                if len(out) >= 5000:
                    yield _batch(out)
                    out = []
        if family is not None:
            family.end()
            out.extend(family.rows())
        for at in range(0, len(out), 5000):
            yield _batch(out[at : at + 5000])

    # The base conversation comes first, whatever the sign of its id.
    ordered = rows.repartition("base").sortWithinPartitions("base", F.col("conv_id") != F.col("base"), "conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.select("base", "conv_id", "shared", "role", "text").mapInArrow(run, _NODES)


def ending_hashes(combined: DataFrame) -> DataFrame:
    """(id, ends_sha256) of the nodes at which conversations end: ids ascending, comma-joined, in a stream over families in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, base, ids, state, first, done = None, None, [], None, True, []

        def put() -> None:
            nonlocal first, ids
            if ids:
                state.update(("" if first else ",").encode() + ",".join(map(str, sorted(ids))).encode())
                first, ids = False, []

        def batch_of() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["id", "ends_sha256"])
            done.clear()
            return made

        for batch in batches:
            for name, b, ends in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if name != now or b != base:
                    if now is not None:
                        put()
                    if name != now:
                        if now is not None:
                            done.append((now, state.hexdigest()))
                        now, state, first = name, hashlib.sha256(), True
                    base = b
                ids.extend(ends)  # at most a family's ids
            if done:
                yield batch_of()
        if now is not None:
            put()
            done.append((now, state.hexdigest()))
            yield batch_of()

    rows = combined.filter("size(ends) > 0").select("id", "base", "ends").repartition("id").sortWithinPartitions("id", "base")
    return rows.mapInArrow(run, "id binary, ends_sha256 string")


def chain_totals(chains: DataFrame) -> DataFrame:
    """chains (chain, up, top, w, leaves) with w and leaves summed over all chains below; rounds of pointer doubling in durable files."""
    now = cut(chains.withColumn("far", F.col("up")), "trie-chains")
    while not now.filter("far IS NOT NULL").isEmpty():
        below = now.filter("far IS NOT NULL").groupBy(F.col("far").alias("__at")).agg(F.sum("w").alias("__w"), F.sum("leaves").alias("__leaves"))
        next_ = now.filter("far IS NOT NULL").select(F.col("chain").alias("__x"), F.col("far").alias("__far"))
        both = now.join(below, F.col("chain") == F.col("__at"), "left").join(next_, F.col("far") == F.col("__x"), "left")
        new = cut(both.select("chain", "up", "top", (F.col("w") + F.coalesce("__w", F.lit(0))).alias("w"), (F.col("leaves") + F.coalesce("__leaves", F.lit(0))).alias("leaves"), F.col("__far").alias("far")), "trie-chains")
        drop_cut(now)
        now = new
    return now.drop("far")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node, all numbers long.

    turns: (conv_id, turn, role, text).
    """
    combined = cut(family_nodes(turns), "trie-families")
    nodes = cut(combined.groupBy("id").agg(F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("chars").alias("chars"), F.min("low").alias("conv_id"), F.sum("n").alias("n_convs")), "trie-nodes")
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("__p")).agg(F.count("*").alias("n_children"))
    owners = nodes.select(F.col("id").alias("__o"), F.col("conv_id").alias("parent_conv_id"))
    ends = ending_hashes(combined).withColumnRenamed("id", "__e")
    named = nodes.join(children, F.col("id") == F.col("__p"), "left").join(owners, F.col("parent") == F.col("__o"), "left").join(ends, F.col("id") == F.col("__e"), "left")
    named = cut(named.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), F.when(F.col("n_children").isNull(), 1).otherwise(0).alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("w"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")), "trie-named")
    drop_cut(combined, nodes)
    chains = named.groupBy(F.col("conv_id").alias("chain")).agg(F.min_by("parent_conv_id", "depth").alias("up"), F.min("depth").alias("top"), F.sum("w").alias("w"), F.sum("leaf").cast("bigint").alias("leaves"))
    hung = chain_totals(chains).filter("up IS NOT NULL").groupBy(F.col("up").alias("__c"), (F.col("top") - 1).alias("__d")).agg(F.sum("w").alias("__w"), F.sum("leaves").alias("__leaves"))
    whole = named.join(hung, (F.col("conv_id") == F.col("__c")) & (F.col("depth") == F.col("__d")), "left")
    down = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.sum(F.col("leaf") + F.coalesce("__leaves", F.lit(0))).over(down).alias("n_leaves"),
        F.sum(F.col("w") + F.coalesce("__w", F.lit(0))).over(down).alias("saved_tokens"), "ends_sha256")


#: CRC-32 bit by bit over the decimal id, turns numbered and rebuilt, paths as texts, subtrees through their members.
ORACLE = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base,
  xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [CAST(i AS BIGINT) for i in range(8)]), lambda s, i: xor(s >> 1, (s & 1) * 3988292384))), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, t.k, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.k <= c.h UNION ALL SELECT c.conv_id, t.k, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.k > c.h),
p AS (SELECT conv_id, row_number() OVER w AS depth, length(text) AS chars, sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w) AS node FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
m AS (SELECT conv_id, depth, chars, node FROM p UNION ALL SELECT conv_id, 0, 0, 'root' FROM c),
e AS (SELECT conv_id, max(depth) AS size FROM m GROUP BY 1),
n AS (SELECT node, depth, min(m.conv_id) AS conv_id, min(chars) AS chars, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(m.conv_id AS VARCHAR), ',' ORDER BY m.conv_id) FILTER (e.size = m.depth), '')) AS ends_sha256 FROM m JOIN e USING (conv_id) GROUP BY 1, 2),
up AS (SELECT n.node, any_value(q.node) AS parent FROM n LEFT JOIN m AS q ON q.conv_id = n.conv_id AND q.depth = n.depth - 1 GROUP BY 1),
kids AS (SELECT parent, count(*) AS k FROM up WHERE parent IS NOT NULL GROUP BY 1),
below AS (SELECT DISTINCT a.node AS top, b.node AS sub FROM m AS a JOIN m AS b ON b.conv_id = a.conv_id AND b.depth >= a.depth),
sums AS (SELECT top AS node, count(*) FILTER (kids.k IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved FROM below JOIN n ON n.node = sub LEFT JOIN kids ON kids.parent = sub GROUP BY 1)
SELECT n.conv_id, n.depth, o.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.k, 0) AS n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN up USING (node) LEFT JOIN n AS o ON o.node = up.parent LEFT JOIN kids ON kids.parent = n.node JOIN sums ON sums.node = n.node
"""
