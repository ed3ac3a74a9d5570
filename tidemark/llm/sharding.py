"""Shards of near equal bytes, by a k-d tree over text metadata.

Every split cuts a node at the weighted median of its widest dimension; weights are bytes, medians are found by
histograms that narrow around the cut, so no node is sorted or collected: the driver sees at most ``BINS`` sums per
node and dimension. Leaves hold one shard's share of the bytes each.

The dimensions (bytes, bytes beyond one per character, lines) are functions of the text, ties are ordered by a hash
of the text, so rows of equal text share a shard. Where such a group lies across the median of the widest
dimension, the next widest that cuts evenly is used; further text hashes serve as last dimensions. Only a group
that is larger than a whole shard is cut, by a hash of its rows.

A row's shard is an expression over its own columns: no join, no shuffle. Slots number the rows of a shard from 0 by
small hash buckets and their offsets.

Defined cases: null text weighs one byte, as the empty one; null ids are ordinary; repeated rows count each; an empty
table gives an empty result; other columns of ``docs`` are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import stored, whole_text

META = ("bytes", "wide", "lines")
HASHED = ("hash1", "hash2", "hash3")
DIMS = META + HASHED
BINS = 512
#: A cut may miss its share by this part of a shard before another dimension is tried.
TOLERANCE = 0.01
SLOT_ROWS = 20_000


@dataclass
class Node:
    first: int
    shards: int
    cut: str = ""
    left: Node | None = None
    right: Node | None = None

    def expression(self) -> str:
        """The shard of a row below this node, as SQL."""
        if self.left is None:
            return str(self.first)
        return f"case when {self.cut} then {self.left.expression()} else {self.right.expression()} end"


def shard_rows(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, cut keys and a row hash of every row; slim, without the text."""
    text = whole_text()
    size = F.octet_length(text)
    tie = F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF))
    values = {
        "bytes": size, "wide": size - F.char_length(text),
        "lines": size - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))),
    }
    keys = [(v.cast("long") * 2**31 + tie).alias(k) for k, v in values.items()]
    # Equal texts have equal keys in every dimension.
    hashes = [F.xxhash64(F.lit(i), text).bitwiseAND(F.lit(2**62 - 1)).alias(k) for i, k in enumerate(HASHED)]
    base = docs.select(
        "doc_id", (size + 1).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"), *keys, *hashes,
        F.monotonically_increasing_id().alias("row"),
    )
    # The row number is hashed at writing; later reads see the written value.
    return base.withColumn("salt", F.xxhash64("row").bitwiseAND(F.lit(2**62 - 1))).drop("row")


def _histogram(rows: DataFrame, spans: dict[tuple[int, str], tuple[int, int]], at: str) -> dict:
    """Bytes by node, dimension and bin, in each one's span [low, high); bin -1 is below it."""
    cases = [
        f"struct({n} as node, '{d}' as dim, case when {d} < {lo} then -1 when {d} >= {hi} then {BINS}"
        f" else ({d} - {lo}) div {_step(lo, hi)} end as bin)"
        for (n, d), (lo, hi) in spans.items()
    ]
    by_node: dict[int, list[str]] = {}
    for (n, _), case in zip(spans, cases, strict=True):
        by_node.setdefault(n, []).append(case)
    arrays = " ".join(f"when {n} then array({', '.join(c)})" for n, c in by_node.items())
    binned = rows.selectExpr("size", f"explode(case {at} {arrays} end) as key")
    sums = binned.groupBy("key").agg(F.sum("size").alias("w")).selectExpr("key.*", "w").collect()
    found: dict = {}
    for r in sums:
        found.setdefault((r.node, r.dim), {})[r.bin] = r.w
    return found


def _step(lo: int, hi: int) -> int:
    return max(1, -(-(hi - lo) // BINS))


def _cuts(rows: DataFrame, at: str, spans: dict, wanted: dict[int, float], near: dict[int, float]) -> dict:
    """Per node and dimension: (key to cut below, bytes below it, bytes of the key's own rows if the cut fell there).

    Spans narrow until the bin that holds the wanted weight is light enough, or a single key.
    """
    spans, done = dict(spans), {}
    while spans:
        sums = _histogram(rows, spans, at)
        following = {}
        for (n, d), (lo, hi) in spans.items():
            bins, step = sums.get((n, d), {}), _step(lo, hi)
            below, b = bins.get(-1, 0), 0
            while b < BINS - 1 and below + bins.get(b, 0) <= wanted[n]:
                below, b = below + bins.get(b, 0), b + 1
            weight, start = bins.get(b, 0), lo + b * step
            if weight > near[n] and step > 1:
                following[n, d] = (start, start + step)
            elif step == 1 and weight > near[n]:
                done[n, d] = (start, below, weight)
            else:
                up = abs(below + weight - wanted[n]) < abs(below - wanted[n])
                done[n, d] = (start + step, below + weight, 0) if up else (start, below, 0)
        spans = following
    return done


def _split(rows: DataFrame, nodes: list[Node], root: Node, extent: dict[str, int]) -> None:
    """Cuts every given node into two, by one set of passes for all of them."""
    at = root.expression()
    stats = rows.groupBy(F.expr(at).alias("node")).agg(
        F.sum("size").alias("w"), *[f(d).alias(f"{d}_{n}") for d in DIMS for n, f in (("lo", F.min), ("hi", F.max))]
    ).collect()
    known = {r["node"]: r for r in stats}
    spans, wanted, near, share = {}, {}, {}, {}
    for node in nodes:
        r = known.get(node.first)
        k = node.shards // 2
        share[node.first] = (r["w"] if r else 0) / node.shards
        wanted[node.first], near[node.first] = share[node.first] * k, share[node.first] * TOLERANCE
        if r:
            spans.update({(node.first, d): (r[f"{d}_lo"], r[f"{d}_hi"] + 1) for d in DIMS})
    cuts = _cuts(rows, at, spans, wanted, near)
    for node in nodes:
        k, n = node.shards // 2, node.first
        node_cut, best = "false", None
        if n in known:
            r, options = known[n], []
            width = {d: (r[f"{d}_hi"] - r[f"{d}_lo"]) / max(1, extent[d]) for d in META}
            for d in [*sorted(META, key=lambda d: -width[d]), *HASHED]:
                key, below, own = cuts[n, d]
                # A group on the cut goes to the side that leaves the smaller miss.
                miss, upper = min((abs(below - wanted[n]), 0), (abs(below + own - wanted[n]), 1))
                options.append((miss, d, key, own, upper, below))
            even = [o for o in options if o[0] <= near[n]]
            best = even[0] if even else min(options, key=lambda o: o[0])
            _, d, key, own, upper, below = best
            node_cut = f"{d} < {key + upper if own else key}"
            if own > share[n]:
                mine = rows.filter(f"({at}) = {n} and {d} = {key}")
                salt = _salt_cut(mine, wanted[n] - below, near[n])
                node_cut = f"({d} < {key} or ({d} = {key} and salt < {salt}))"
        node.cut, node.left, node.right = node_cut, Node(n, k), Node(n + k, node.shards - k)


def _salt_cut(rows: DataFrame, wanted: float, near: float) -> int:
    """Where to cut a group of equal texts by the hash of its rows."""
    as_node = rows.withColumn("node", F.lit(0))
    return _cuts(as_node, "node", {(0, "salt"): (0, 2**62)}, {0: wanted}, {0: near})[0, "salt"][0]


def kd_tree(rows: DataFrame, n_shards: int) -> Node:
    """The tree over stored ``shard_rows``; it has ``n_shards`` leaves."""
    root = Node(0, n_shards)
    whole = rows.agg(*[(F.max(d) - F.min(d)).alias(d) for d in META]).first().asDict()
    extent = {d: v or 1 for d, v in whole.items()}
    level = [root]
    while level := [n for n in level if n.shards > 1]:
        _split(rows, level, root, extent)
        level = [c for n in level for c in (n.left, n.right)]
    return root


def with_slots(rows: DataFrame, n_shards: int) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each ``shard``, numbering rows within small hash buckets."""
    total = rows.count()
    buckets = max(32, -(-total // (n_shards * SLOT_ROWS)))
    bucketed = rows.withColumn("bucket", F.pmod("salt", F.lit(buckets)).cast("int"))
    counts = bucketed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")
    offsets = stored(counts.select(F.col("shard").alias("to_shard"), F.col("bucket").alias("to_bucket"), ahead.alias("ahead")), "slots")
    number = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("salt"))
    numbered = bucketed.withColumn("number", number)
    placed = numbered.join(offsets, (F.col("shard") == F.col("to_shard")) & (F.col("bucket") == F.col("to_bucket")))
    return placed.withColumn("slot", F.expr("ahead + number - 1"))


def shard_by_bytes(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    rows = stored(shard_rows(docs), "shard-rows")
    tree = kd_tree(rows, n_shards)
    placed = rows.select("doc_id", "size", "text_crc32", "salt", F.expr(tree.expression()).cast("int").alias("shard"))
    return with_slots(placed, n_shards).selectExpr(
        "doc_id", "size", "text_crc32", "'bytes' as law", "shard", "slot", "cast(null as int) as grown_shard"
    )
