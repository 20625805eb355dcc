"""Exact top-k inner-product search with cover trees over queries and data.

Vectors are dealt to shards of similar vectors: a bounded sample of rows gives centres, one per shard's worth of rows
and not more than fixed many, every row joins the nearest one, and a centre's group with many rows is split further by
hash. One task builds the cover tree of a shard, and tree and points land as one row; queries land in the same way, in blocks
with trees of their own.

No inner product of a point within r of c and one within s of d exceeds c.d + r|d| + s|c| + rs. That bound is used three
times. A block first searches one shard of the group most like it, which gives each query a score that k vectors
reach. Against the block's worst k-th score, groups are ruled out as a whole, then single shards of the groups that are
left, by rows of a few numbers. Inside a shard both landed trees are walked together, best pair of nodes first,
against the worst k-th score of the query node. Only strictly smaller bounds are pruned, so ties are whole; they go to the smaller id.

Vectors without structure cannot be pruned by any such bound: where a net of a node's points would need too many
centres the node stays a leaf, and pairs of leaves are scored as matrices. On random directions the search
thus does as much arithmetic as brute force, and ``explain_pruning`` says how much was saved.

Each query's candidates from its shards are merged by a rank limit, which Spark applies before the shuffle.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part; a shorter
vector counts as filled up with zeros; rows are told apart by numbers of their own: of rows with equal ids each is a candidate, and
each a query if the id says so, and only a query's own row is no candidate of it; a row without an id is a candidate, behind
equal scores of others, and no query; with fewer than k candidates all are returned; an empty table gives an
empty result. Scores must stay below 2^53 in size, else the task fails rather than round.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bikeflow.llm.tables import landed, table

K = 20
SCALE = 64
QUERY_MODULUS = 20
CENTRES = 64
SHARD_ROWS = 4096
BLOCK_QUERIES = 512
PAIRS_PER_TASK = 4
LEAF = 64
# A node whose net is larger has no structure at this scale that a bound could use: it stays a leaf.
MOST_CHILDREN = 64
LEAF_COLUMNS = 2048
SHRINK = 0.7  # children cover with this share of their parent's radius

# ``tree`` has a row per node, in the order of a walk: first and past last point, centre's point, past its last
# descendant, radius. Points stand in the order of the leaves; ``rows``, ``ids`` and ``named`` describe them.
TREE = (
    "shard long, group long, n long, centre array<double>, radius double, rows binary, ids binary, named binary, "
    "vectors binary, tree binary, width long"
)
NODE = np.dtype([("first", "<i8"), ("past", "<i8"), ("centre", "<i8"), ("end", "<i8"), ("radius", "<f8")])


@dataclass
class Node:
    centre: np.ndarray
    radius: float
    rows: np.ndarray
    children: list


def landed_tree(root: Node, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the points by leaves, nodes in the order of a walk)."""
    order, nodes, place = [], [], 0

    def walk(node: Node) -> None:
        nonlocal place
        at, first = len(nodes), place
        nodes.append(None)
        if node.children:
            for child in node.children:
                walk(child)
        else:
            order.append(node.rows)
            place += len(node.rows)
        nodes[at] = (first, place, node, len(nodes))

    walk(root)
    order = np.concatenate(order)
    spot = np.empty(len(order), np.int64)
    spot[order] = np.arange(len(order))
    found = np.zeros(len(nodes), NODE)
    for row, (first, past, node, end) in zip(found, nodes):
        centre = next(r for r in node.rows if (points[r] == node.centre).all())
        row["first"], row["past"], row["centre"], row["end"], row["radius"] = first, past, spot[centre], end, node.radius
    return order, found


def opened_tree(nodes: np.ndarray, points: np.ndarray) -> Node:
    """The tree of points in leaf order; nothing is computed anew."""

    def node(at: int) -> Node:
        first, past, centre, end, radius = nodes[at].tolist()
        children, child = [], at + 1
        while child < end:
            children.append(node(child))
            child = int(nodes[child]["end"])
        return Node(points[centre], radius, np.arange(first, past), children)

    return node(0)


def cover_tree(points: np.ndarray, rows: np.ndarray, radius: float | None = None) -> Node:
    """Nodes with a point as centre and the distance to their farthest point as covering radius.

    The children's centres are a net of the node's points: no two within the shrunk radius of each
    other, and every point within it of its centre.
    """
    own = points[rows]
    centre = own[0] if radius is not None else own[np.argmin(((own - own.mean(axis=0)) ** 2).sum(axis=1))]
    apart = np.sqrt(((own - centre) ** 2).sum(axis=1))
    node = Node(centre, float(apart.max()), rows, [])
    if len(rows) <= LEAF or node.radius == 0:
        return node
    reach = node.radius * SHRINK
    nearest, place = apart.copy(), np.zeros(len(rows), np.int64)
    net = [int(np.argmin(apart))]
    while nearest.max() > reach:  # the farthest point becomes the next centre
        if len(net) == MOST_CHILDREN:
            return node
        k = int(np.argmax(nearest))
        distance = np.sqrt(((own - own[k]) ** 2).sum(axis=1))
        closer = distance < nearest
        nearest[closer], place[closer] = distance[closer], len(net)
        net.append(k)
    for c, k in enumerate(net):
        members = rows[place == c]
        if len(members):
            first = rows[k]
            node.children.append(cover_tree(points, np.concatenate([[first], members[members != first]]), reach))
    return node


def bounds(one: Node, centres: np.ndarray, radii: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """No inner product of a point of ``one`` and one of each other node exceeds these."""
    c = float(np.sqrt(one.centre @ one.centre))
    return (centres @ one.centre + one.radius * norms + radii * c + one.radius * radii) * (1 + 1e-12) + 1e-6


class Search:
    """The walk over a tree of queries and a tree of data."""

    def __init__(self, k: int, queries, query_rows, data, data_rows, data_ids, floor):
        """Points, the numbers of their rows, and the ids that settle ties."""
        self.k, self.queries, self.query_rows = k, queries, query_rows
        self.data, self.data_rows, self.data_ids = data, data_rows, data_ids
        self.scores = np.full((len(queries), k), -np.inf)
        self.ids = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.places = np.full((len(queries), k), -1)  # in the data
        self.floor = floor
        self.tested = 0

    def worst(self, rows: np.ndarray) -> float:
        return float(np.maximum(self.scores[rows, -1], self.floor[rows]).min())

    def leaf(self, rows: np.ndarray, found: np.ndarray) -> None:
        """Score every pair and keep each query's k best, ties by id."""
        for at in range(0, len(found), LEAF_COLUMNS):
            part = found[at : at + LEAF_COLUMNS]
            self.tested += len(rows) * len(part)
            scores, ids = self.queries[rows] @ self.data[part].T, self.data_ids[part]
            scores[self.data_rows[part][None, :] == self.query_rows[rows][:, None]] = -np.inf
            limit = np.maximum(self.scores[rows, -1], self.floor[rows])
            if len(part) > self.k:
                limit = np.maximum(limit, np.partition(scores, -self.k, axis=1)[:, -self.k])
            who, column = np.nonzero((scores >= limit[:, None]) & (scores > -np.inf))
            if not len(who):
                continue
            held = np.repeat(np.arange(len(rows)), self.k)
            who_all = np.concatenate([held, who])
            values = np.concatenate([self.scores[rows].ravel(), scores[who, column]])
            names = np.concatenate([self.ids[rows].ravel(), ids[column]])
            places = np.concatenate([self.places[rows].ravel(), part[column]])
            order = np.lexsort((names, -values, who_all))
            place = np.arange(len(order)) - np.searchsorted(who_all[order], np.arange(len(rows)))[who_all[order]]
            best = order[place < self.k]
            self.scores[rows] = values[best].reshape(len(rows), self.k)
            self.ids[rows] = names[best].reshape(len(rows), self.k)
            self.places[rows] = places[best].reshape(len(rows), self.k)

    def walk(self, query: Node, nodes: list[Node]) -> None:
        centres = np.stack([n.centre for n in nodes])
        radii = np.array([n.radius for n in nodes])
        limit = bounds(query, centres, radii, np.sqrt((centres**2).sum(axis=1)))
        if query.children and sum(len(n.rows) for n in nodes) > LEAF:
            live = [n for n, b in zip(nodes, limit) if b >= self.worst(query.rows)]
            for child in query.children if live else ():
                self.walk(child, live)
            return
        inner = []
        for k in np.argsort(-limit):
            if limit[k] < self.worst(query.rows):
                break
            node = nodes[k]
            if node.children:
                inner.extend(node.children)
            else:
                self.leaf(query.rows, node.rows)
        if inner:
            self.walk(query, inner)


def _matrix(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, np.float64).reshape(-1, width) if width else np.zeros((0, 0))


def _nearest(batches, centres: np.ndarray):
    """The centre that each vector is most like."""
    for batch in batches:
        vectors = _padded(batch.column("vector"), centres.shape[1])
        away = (centres**2).sum(axis=1)[None, :] - 2 * vectors @ centres.T
        columns = [batch.column(c) for c in ("row", "id", "vector")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(np.argmin(away, axis=1))], ["row", "id", "vector", "centre"])


def _padded(column: pa.Array, width: int) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy())
    width = max(width, int(sizes.max(initial=0)))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    found = np.zeros((len(sizes), width))
    found[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return found


def _shards(batches: Iterator[pa.RecordBatch], width: int):
    """Rows come sorted by shard; each shard becomes one row with its tree."""
    at, held = None, []

    def row():
        points, rows, ids, named = (np.concatenate(c) for c in list(zip(*held))[1:])
        order, nodes = landed_tree(root := cover_tree(points, np.arange(len(points))), points)
        values = [at, held[0][0], len(points), root.centre.tolist(), root.radius]
        values += [c[order].tobytes() for c in (rows, ids, named, points)] + [nodes.tobytes(), width]
        kinds = [pa.int64()] * 3 + [pa.list_(pa.float64()), pa.float64()] + [pa.binary()] * 5 + [pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], [c.split()[0] for c in TREE.split(", ")])

    for batch in batches:
        shards, groups = batch.column("shard").to_numpy(), batch.column("centre").to_numpy()
        vectors, rows = _padded(batch.column("vector"), width), batch.column("row").to_numpy()
        named = batch.column("id").is_valid().to_numpy(zero_copy_only=False)
        # A missing id stands behind all others in ties.
        ids = batch.column("id").fill_null(np.iinfo(np.int64).max).to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], shards[1:] != shards[:-1]])) if len(shards) else []
        for a, b in zip(cuts, [*cuts[1:], len(shards)]):
            if shards[a] != at and held:
                yield row()
                held = []
            at = int(shards[a])
            held.append((int(groups[a]), vectors[a:b], rows[a:b], ids[a:b], named[a:b]))
    if held:
        yield row()


def sharded(vectors: DataFrame, centres: np.ndarray, rows: int, name: str) -> DataFrame:
    """Shards of at most about ``rows`` similar vectors, one row each."""
    spark = vectors.sparkSession
    placed = vectors.mapInArrow(lambda it: _nearest(it, centres), "row long, id long, vector array<double>, centre long")
    sizes = placed.groupBy("centre").agg(F.count("*").alias("n")).collect()  # at most CENTRES rows
    parts = {r["centre"]: -(-r["n"] // rows) for r in sizes}
    first, total = {}, 0
    for c in sorted(parts):
        first[c], total = total, total + parts[c]
    lookup = lambda d: F.element_at(F.create_map(*[F.lit(x) for c in sorted(d) for x in (c, d[c])]), F.col("centre"))
    if not total:
        return landed(spark, spark.createDataFrame([], TREE), name)
    shard = lookup(first) + F.pmod(F.xxhash64("row"), lookup(parts))
    width = centres.shape[1]
    dealt = placed.select(shard.cast("long").alias("shard"), "centre", "row", "id", "vector")
    dealt = dealt.repartition(total, "shard").sortWithinPartitions("shard")
    return landed(spark, dealt.mapInArrow(lambda it: _shards(it, width), TREE), name)


def _opened(row: dict, prefix: str, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Node]:
    points = _matrix(row[f"{prefix}vectors"], width)
    rows, ids = (np.frombuffer(row[prefix + c], np.int64) for c in ("rows", "ids"))
    return points, rows, ids, np.frombuffer(row[f"{prefix}named"], bool), opened_tree(np.frombuffer(row[f"{prefix}tree"], NODE), points)


def _searched(batches: Iterator[pa.RecordBatch], k: int):
    """Rows of (query block, shard) to the block's best k of that shard."""
    for batch in batches:
        for r in batch.to_pylist():
            queries, query_rows, query_ids, _, query_tree = _opened(r, "q_", r["width"])
            data, data_rows, data_ids, named, tree = _opened(r, "", r["width"])
            if np.sqrt((queries**2).sum(axis=1).max() * (data**2).sum(axis=1).max()) >= 2**53:
                raise OverflowError("inner products beyond 2^53 are not exact here")
            floor = np.frombuffer(r["floor"], np.float64) if r["floor"] else np.full(len(queries), -np.inf)
            search = Search(k, queries, query_rows, data, data_rows, data_ids, floor)
            search.walk(query_tree, [tree])
            who, place = np.nonzero((search.scores > -np.inf) & (search.scores >= floor[:, None]))
            kth = np.maximum(search.scores[:, -1], floor)
            found = search.places[who, place]
            arrays = [
                pa.array(np.full(len(who), r["q_shard"])),
                pa.array(query_rows[who]),
                pa.array(query_ids[who]),
                pa.array(data_ids[found], mask=~named[found]),
                pa.array(search.scores[who, place].astype(np.int64)),
                pa.array(([search.tested] if len(who) else []) + [0] * (len(who) - 1), pa.int64()),
                pa.array([kth.tobytes()] + [None] * (len(who) - 1) if len(who) else [], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _FOUND.split(", ")])


_FOUND = "q_shard long, q_row long, query_id long, vec_id long, score long, tested long, kth binary"


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _bound(one: str, two: str):
    """No inner product of points of two balls, given as columns <name>centre and <name>radius, exceeds this."""
    (c, r), (d, s) = ((F.col(f"{x}centre"), F.col(f"{x}radius")) for x in (one, two))
    whole = _dot(c, d) + r * F.sqrt(_dot(d, d)) + s * F.sqrt(_dot(c, c)) + r * s
    return whole * (1 + 1e-12) + 1e-6


def _groups(data: DataFrame) -> DataFrame:
    """A ball around all shards of a centre's group: its first shard's centre, and the farthest reach of any."""
    outline = data.select("shard", "group", "centre", "radius")
    heads = outline.groupBy("group").agg(F.min("shard").alias("head"), F.min_by("centre", "shard").alias("g_centre"))
    rows = outline.join(heads, "group")
    away = F.zip_with("centre", "g_centre", lambda x, y: x - y)
    reach = F.sqrt(_dot(away, away)) + F.col("radius")
    return rows.groupBy("group").agg(F.first("head").alias("head"), F.first("g_centre").alias("g_centre"), F.max(reach).alias("g_radius"))


_NEAR = "q_shard long, group long, head long, bound double, turn int"


def _near(batches: Iterator[pa.RecordBatch], groups: list):
    """Each block with each group: the bound, and the turn of the group by its likeness."""
    centres = np.array([g["g_centre"] for g in groups])
    radii, norms = np.array([g["g_radius"] for g in groups]), np.sqrt((centres**2).sum(axis=1))
    for batch in batches:
        for shard, centre, radius in zip(*(batch.column(c).to_pylist() for c in ("q_shard", "q_centre", "q_radius"))):
            node = Node(np.array(centre), radius, np.zeros(0, np.int64), [])
            turn = np.empty(len(groups), np.int32)
            turn[np.argsort(-(centres @ node.centre), kind="stable")] = np.arange(1, len(groups) + 1)
            values = [np.full(len(groups), shard), [g["group"] for g in groups], [g["head"] for g in groups]]
            arrays = [*map(pa.array, values), pa.array(bounds(node, centres, radii, norms)), pa.array(turn)]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _NEAR.split(", ")])


def _centres(vectors: DataFrame, count: int, wanted: int, width: int) -> np.ndarray:
    """Some rows' vectors, drawn by a hash of their numbers."""
    share = min(1.0, 4 * wanted / max(1, count))
    drawn = vectors.filter(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) <= int(share * (1 << 30))).select("row", "vector").collect()
    drawn = sorted(drawn, key=lambda r: (hash(tuple(r["vector"])), r["row"]))[:wanted] or [{"vector": []}]
    centres = np.zeros((len(drawn), width))
    for row, r in zip(centres, drawn):
        row[: len(r["vector"])] = r["vector"]
    return centres


def _pairs_found(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame | None:
    """Candidates of each query, k at least where there are so many, with the pairs of vectors that were scored."""
    spark = vectors.sparkSession
    (count, wide), (asked, asked_wide) = (x.agg(F.count("*"), F.max(F.size("vector"))).first() for x in (vectors, queries))
    if not count or not asked:
        return None
    width = max(wide, asked_wide)
    few = lambda n, rows: max(1, min(CENTRES, -(-n // rows)))
    data = sharded(vectors, _centres(vectors, count, few(count, SHARD_ROWS), width), SHARD_ROWS, "shards")
    blocks = sharded(queries, _centres(vectors, count, few(asked, BLOCK_QUERIES), width), BLOCK_QUERIES, "query-blocks")
    blocks = blocks.select(*[F.col(c).alias(f"q_{c}") for c in blocks.columns if c not in ("width", "group")])

    def search(chosen: DataFrame, name: str) -> DataFrame:
        tasks = max(1, chosen.count() // PAIRS_PER_TASK)
        rows = chosen.join(blocks.drop("q_centre", "q_radius", "q_n"), "q_shard")
        rows = rows.join(data.drop("centre", "radius", "n", "group"), "shard")
        rows = rows.repartition(tasks, "q_shard", "shard").drop("shard")
        return landed(spark, rows.mapInArrow(lambda it: _searched(it, k), _FOUND), name)

    # Each block against each group, of which there are fixed many; then against the shards of those that are left.
    groups = _groups(data).orderBy("group").collect()  # at most CENTRES rows
    outline = blocks.select("q_shard", "q_centre", "q_radius")
    near = landed(spark, outline.mapInArrow(lambda it: _near(it, groups), _NEAR), "group-pairs")

    first = search(near.filter("turn = 1").select("q_shard", F.col("head").alias("shard"), F.lit(None).cast("binary").alias("floor")), "first-search")
    floors = first.filter("kth is not null").select("q_shard", F.col("kth").alias("floor"))
    # The block's worst k-th score decides what can still matter; each query keeps its own.
    worst = first.groupBy("q_shard", "q_row").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
    worst = worst.groupBy("q_shard").agg(F.min("kth").alias("kth"), F.min("n").alias("n"), F.count("*").alias("asked"))
    worst = worst.join(blocks.select("q_shard", "q_n"), "q_shard")
    worst = worst.withColumn("kth", F.when((F.col("n") >= k) & (F.col("asked") == F.col("q_n")), F.col("kth"))).select("q_shard", "kth")
    possible = F.col("kth").isNull() | (F.col("bound") >= F.col("kth"))
    left = near.join(worst, "q_shard", "left").filter(possible).drop("bound").join(outline, "q_shard")
    left = left.join(data.select("shard", "group", "centre", "radius"), "group")
    left = left.filter((F.col("turn") > 1) | (F.col("shard") != F.col("head"))).withColumn("bound", _bound("q_", ""))
    rest = left.filter(possible).select("q_shard", "shard").join(floors, "q_shard", "left")
    return first.unionByName(search(rest, "second-search"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score of the k largest inner products; both have row, id and an integer vector.

    ``row`` numbers the rows of both; a query's own row is left out. Ties go to the smaller id.
    """
    found = _pairs_found(vectors, queries, k)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("q_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def explain_pruning(vectors: DataFrame, queries: DataFrame, k: int = K) -> float:
    """The share of pairs of a query and a vector that were never scored."""
    found = _pairs_found(vectors, queries, k)
    if found is None:
        return 0.0
    return 1 - found.agg(F.sum("tested")).first()[0] / (vectors.count() * queries.count())


def integer_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """Row numbers, id and floor(64 * x) of the vectors whose components are all finite; they land, so the numbers stay."""
    value = F.transform("vector", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vector").isNotNull() & (F.size("vector") > 0) & finite
    usable = rows.select(F.col(key).alias("id"), F.col(vector).alias("vector")).filter(usable)
    usable = usable.select(F.monotonically_increasing_id().alias("row"), F.col("id").cast("long").alias("id"), value.alias("vector"))
    return landed(rows.sparkSession, usable, "vectors")


def op10_exact_topk_search(spark: SparkSession, sf: str) -> DataFrame:
    vectors = integer_vectors(table(spark, sf, "embeddings"), "vec_id", "embedding")
    return top_k(vectors, vectors.filter(F.pmod("id", F.lit(QUERY_MODULUS)) == 0))


OP10_SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, [CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(d.e AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v d ON q.r <> d.r WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s) WHERE rank <= 20
"""
