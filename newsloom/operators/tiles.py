"""Exact nearest neighbours and exact top-N by inner product, by tiles.

Vectors of one group (a channel) are sorted along a locality key and cut into *tiles*: an id list and
one matrix each, with a centre and radius (distance) or the largest norm (inner product). Work is done
per pair of tiles, as one matrix product, and vectors travel per tile, never per pair of rows:

1. Every query tile meets the ``seeds`` most promising data tiles; the k-th best value of each of its
   queries is a threshold.
2. Of all other tile pairs of the group, those that cannot improve any query of the tile are skipped,
   from tile statistics alone: by the triangle inequality (distance of the centres less both radii),
   or by Cauchy-Schwarz (norm of the query times the largest norm of the data tile).
3. Neighbouring query tiles make a *block*. The remaining data tiles are sent to the blocks that have a
   tile to meet them, once a block, most promising first, in chunks of bounded size (a group with a
   third of all rows is many blocks and chunks); a task carries each query's best k along and goes on
   skipping with the thresholds it has reached. So data travel once for every block of queries, and
   queries once for every chunk of data, not once a pair of tiles.
4. The best k of the chunks are merged by a salted top-k.

The result is exact and has total order: value rounded to 9 places, then id. Products select
candidates within ``SLACK`` of the threshold; the values returned are computed from the vectors
themselves. Null vectors take no part.

If both sides have ``cells`` (int64 numbers, ``cell_width`` a table), two rows are partners only if all
numbers of some table agree; the cells are compared once a pair has passed the thresholds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.arrays import euclidean
from newsloom.operators.topk import top_k
from newsloom.session import write_once

TILE_ROWS = 256
SEEDS = 2          # data tiles a query tile meets before anything is skipped
CHUNK_TILES = 256  # data tiles in one chunk of a block
BLOCK_TILES = 64   # query tiles in a block at most
BLOCK_BYTES = 1 << 26   # of queries and their best partners in a block
SLACK = 1e-6       # products are off by far less than this times the scale of the vectors
LOCALITY_BITS = 16
SPARE = 32         # partners beyond k whose true values are computed
EXACT_NUMBERS = 1 << 21   # numbers handled at once there
DISTANCE, INNER, FARTHEST = "distance", "inner", "farthest"   # farthest below the limit

TILE_SCHEMA = ("tile long, group_id int, members array<long>, ids binary, matrix binary, centre array<double>, radius double, "
               "low_norm double, top_norm double, cells binary")


def locality_key(dim: int, bits: int = LOCALITY_BITS, seed: int = 0):
    """Rows -> a number whose high bits agree for vectors that point the same way."""
    directions = np.random.default_rng(seed).standard_normal((dim, bits))
    weights = 1 << np.arange(bits - 1, -1, -1)
    return lambda rows: (rows @ directions > 0) @ weights


def make_tiles(vectors: DataFrame, metric: str, dim: int, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Tiles of ``id long, group_id int, vec array<double>`` (and ``cells binary``, if there). For inner products
    a tile holds neighbours in norm (largest first), for distances neighbours along the locality key."""
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = locality_key(dim)
        for batch in batches:
            rows = batch.column("vec").flatten().to_numpy().reshape(batch.num_rows, dim)
            found = -np.linalg.norm(rows, axis=1) if metric == INNER else key(rows).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("id", "group_id", "vec", "cells")] + [pa.array(found)],
                                             names=["id", "group_id", "vec", "cells", "key"])

    def tile(number: int, group: int, ids: list[np.ndarray], rows: list[np.ndarray], cells: list[bytes | None]) -> pa.RecordBatch:
        matrix, names = np.concatenate(rows), np.concatenate(ids)
        centre, norms = matrix.mean(axis=0), np.linalg.norm(matrix, axis=1)
        radius = np.linalg.norm(matrix - centre, axis=1).max()
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([group], pa.int32()), pa.array([names.tolist()], pa.list_(pa.int64())), pa.array([names.tobytes()]),
             pa.array([matrix.tobytes()]), pa.array([centre.tolist()], pa.list_(pa.float64())), pa.array([radius]),
             pa.array([norms.min()]), pa.array([norms.max()]),
             pa.array([None if None in cells else b"".join(cells)], pa.binary())], names=[f.split()[0] for f in TILE_SCHEMA.split(", ")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, group, ids, rows, cells, held = TaskContext.get().partitionId() << 33, None, [], [], [], 0
        for batch in batches:
            matrix = batch.column("vec").flatten().to_numpy().reshape(batch.num_rows, dim)
            names, groups = batch.column("id").to_numpy(), batch.column("group_id").to_numpy()
            at = 0
            while at < batch.num_rows:
                if held and (groups[at] != group or held == tile_rows):
                    yield tile(number, group, ids, rows, cells)
                    number, ids, rows, cells, held = number + 1, [], [], [], 0
                group = int(groups[at])
                end = min(at + tile_rows - held, int(np.searchsorted(groups, group, side="right")))
                ids.append(names[at:end])
                rows.append(matrix[at:end])
                cells += batch.column("cells").slice(at, end - at).to_pylist()
                held, at = held + end - at, end
        if held:
            yield tile(number, group, ids, rows, cells)

    if "cells" not in vectors.columns:
        vectors = vectors.withColumn("cells", F.lit(None).cast("binary"))
    clean = vectors.where(F.col("vec").isNotNull() & F.col("group_id").isNotNull()).select(
        F.col("id").cast("long").alias("id"), F.col("group_id").cast("int").alias("group_id"), "vec", "cells")
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["group_id", "key", "id"]
    dealt = clean.mapInArrow(keyed, "id long, group_id int, vec array<double>, cells binary, key double")
    return dealt.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(cut, TILE_SCHEMA)


class Best:
    """The best ``k`` partners of each query of a tile, so far."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, k: int, metric: str, limit: float, floor: np.ndarray | None,
                 cells: np.ndarray | None = None):
        self.ids, self.matrix, self.k, self.metric, self.limit, self.cells = ids, matrix, k, metric, limit, cells
        n = len(ids)
        # costs: distance, or the inner product or the distance negated
        self.cost = np.full((n, k), np.inf)
        self.partner = np.full((n, k), np.iinfo(np.int64).max)
        self.floor = np.full(n, np.inf) if floor is None else floor  # known thresholds of the queries
        self.squares = (matrix ** 2).sum(axis=1)
        self.norms = np.sqrt(self.squares)

    def thresholds(self) -> np.ndarray:
        """What a partner's cost must not exceed to matter to each query."""
        reached = np.minimum(self.cost[:, -1], self.floor)
        return np.minimum(reached, self.limit) if self.metric == DISTANCE else reached

    def may_improve(self, bound: float) -> bool:
        """``bound``: least distance to the tile (farthest: the largest, negated), or the largest norm in it."""
        if self.metric != INNER:
            return bool(bound <= self.thresholds().max() + SLACK)
        return bool((-self.norms * bound <= self.thresholds() + SLACK).any())

    def _exact(self, queries: np.ndarray, ids: np.ndarray, matrix: np.ndarray, at: np.ndarray, there: np.ndarray) -> None:
        """Take the partners ``at`` (one row of places a query; only those ``there`` count) by their true cost."""
        mine = self.matrix[queries][:, None, :]
        if self.metric != INNER:
            cost = np.sqrt(((matrix[at] - mine) ** 2).sum(axis=2))
            there = there & (cost < self.limit)
            cost = -cost if self.metric == FARTHEST else cost
        else:
            cost = -(matrix[at] * mine).sum(axis=2)
        cost = np.concatenate((self.cost[queries], np.where(there, cost, np.inf)), axis=1)
        partner = np.concatenate((self.partner[queries], np.where(there, ids[at], np.iinfo(np.int64).max)), axis=1)
        order = np.lexsort((partner, np.round(cost, 9)), axis=-1)[:, : self.k]
        self.cost[queries] = np.take_along_axis(cost, order, axis=1)
        self.partner[queries] = np.take_along_axis(partner, order, axis=1)

    def _apart(self, rough: np.ndarray, cells: np.ndarray) -> None:
        """Take out the pairs that agree in no table of cells."""
        q, d = np.nonzero(np.isfinite(rough))
        for t in range(cells.shape[1]):
            left = (self.cells[q, t] != cells[d, t]).any(axis=1)
            q, d = q[left], d[left]
        rough[q, d] = np.inf

    def meet(self, ids: np.ndarray, matrix: np.ndarray, cells: np.ndarray | None = None) -> None:
        product = self.matrix @ matrix.T
        scale = max(1.0, float(self.norms.max()), float(np.sqrt((matrix ** 2).sum(axis=1).max())))
        if self.metric == INNER:
            rough, slack = np.negative(product, out=product), SLACK * scale ** 2
        else:  # rounding errors under the root stay far below the slack, also near 0
            rough = np.sqrt(np.maximum(self.squares[:, None] + (matrix ** 2).sum(axis=1) - 2 * product, 0.0))
            slack = SLACK * scale
            if self.metric == FARTHEST:
                rough = np.where(rough > self.limit + slack, np.inf, -rough)
            rough[self.ids[:, None] == ids[None, :]] = np.inf
        rough[rough > self.thresholds()[:, None] + slack] = np.inf
        if self.cells is not None:
            self._apart(rough, cells)
        queries = np.flatnonzero(np.isfinite(rough).any(axis=1))
        if not len(queries):
            return
        rough = rough[queries]
        wide = min(rough.shape[1], self.k + SPARE)
        at = np.argpartition(rough, wide - 1, axis=1)[:, :wide] if wide < rough.shape[1] else \
            np.broadcast_to(np.arange(wide), rough.shape)
        if wide < rough.shape[1]:  # more than SPARE partners may tie with the k-th: all that could are taken
            kth = np.partition(rough, self.k - 1, axis=1)[:, self.k - 1]
            tied = np.flatnonzero(((rough <= kth[:, None] + slack) & np.isfinite(rough)).sum(axis=1) > wide)
            for q in tied:
                some = np.flatnonzero(rough[q] <= kth[q] + slack)[None, :]
                self._exact(queries[q:q + 1], ids, matrix, some, np.ones(some.shape, dtype=bool))
            plain = np.setdiff1d(np.arange(len(queries)), tied)
            queries, rough, at = queries[plain], rough[plain], at[plain]
        step = max(1, EXACT_NUMBERS // (wide * matrix.shape[1]))
        for lo in range(0, len(queries), step):
            some = slice(lo, lo + step)
            self._exact(queries[some], ids, matrix, at[some], np.isfinite(np.take_along_axis(rough[some], at[some], axis=1)))

    def rows(self) -> pa.RecordBatch:
        q, at = np.nonzero(np.isfinite(self.cost))
        value = self.cost[q, at] if self.metric == DISTANCE else -self.cost[q, at]
        return pa.RecordBatch.from_arrays([pa.array(self.ids[q]), pa.array(self.partner[q, at]), pa.array(value)],
                                          names=["id", "partner", "value"])


def _meet(sent: DataFrame, dim: int, k: int, metric: str, limit: float, cell_width: int) -> DataFrame:
    """Rows of one (block, chunk) follow each other: the query tiles, then data tiles by promise."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, at = {}, None
        for batch in batches:
            columns = [batch.column(c) for c in ("block", "chunk", "turn", "tile", "ids", "matrix", "floors", "cells", "takers")]
            for row in range(batch.num_rows):
                where, chunk, turn, tile, ids, matrix, floors, cells, takers = (c[row].as_py() for c in columns)
                if (where, chunk) != at:
                    yield from (best.rows() for best in block.values())
                    block, at = {}, (where, chunk)
                names, rows = np.frombuffer(ids, dtype=np.int64), np.frombuffer(matrix).reshape(-1, dim)
                marks = np.frombuffer(cells, dtype=np.int64).reshape(len(names), -1, cell_width) if cells else None
                if turn == 0:  # sorted first: the queries themselves
                    block[tile] = Best(names, rows, k, metric, limit, np.frombuffer(floors) if floors else None, marks)
                    continue
                for taker in takers:
                    best = block[taker["query_tile"]]
                    if best.may_improve(taker["bound"]):
                        best.meet(names, rows, marks)
        yield from (best.rows() for best in block.values())

    return sent.mapInArrow(run, "id long, partner long, value double")


def _send(pairs: DataFrame, queries: DataFrame, data: DataFrame) -> DataFrame:
    """The query tiles of each (block, chunk), and once each the data tiles that any of them is to meet."""
    heads = pairs.select("block", "chunk", F.col("query_tile").alias("tile")).distinct().join(
        queries.select("tile", "ids", "matrix", "floors", "cells"), "tile").select(
        "block", "chunk", F.lit(0).alias("turn"), F.lit(0.0).alias("promise"), "tile", "ids", "matrix", "floors", "cells",
        F.lit(None).cast("array<struct<query_tile:bigint,bound:double>>").alias("takers"))
    # a list has at most the tiles of a block
    takers = pairs.groupBy("block", "chunk", F.col("data_tile").alias("tile")).agg(
        F.min("promise").alias("promise"), F.collect_list(F.struct("query_tile", "bound")).alias("takers"))
    tiles = takers.join(data.select("tile", "ids", "matrix", "cells"), "tile").select(
        "block", "chunk", F.lit(1).alias("turn"), "promise", "tile", "ids", "matrix",
        F.lit(None).cast("binary").alias("floors"), "cells", "takers")
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return heads.unionByName(tiles).repartition(parts, "block", "chunk").sortWithinPartitions(
        "block", "chunk", "turn", "promise", "tile")


def _blocks(queries: DataFrame, size: int) -> DataFrame:
    """(query_tile, block): every ``size`` tiles of a group that follow each other. One row a tile is read."""
    place = F.row_number().over(Window.partitionBy("group_id").orderBy("tile")) - 1
    return queries.select(F.col("tile").alias("query_tile"),
                          (F.col("group_id").cast("long") * (1 << 32) + F.floor(place / size)).alias("block"))


def tile_pairs(queries: DataFrame, data: DataFrame, metric: str) -> DataFrame:
    """Pairs of tiles of a group with ``bound`` and ``promise`` (smaller is better). Statistics only."""
    q = queries.select("group_id", F.col("tile").alias("query_tile"), F.col("centre").alias("qc"), F.col("radius").alias("qr"))
    d = data.select("group_id", F.col("tile").alias("data_tile"), F.col("centre").alias("dc"), F.col("radius").alias("dr"), "top_norm")
    both = q.join(d, "group_id")
    if metric != INNER:
        apart = euclidean(F.col("qc"), F.col("dc"))
        if metric == FARTHEST:
            return both.select("query_tile", "data_tile", (-(apart + F.col("qr") + F.col("dr"))).alias("bound"), (-apart).alias("promise"))
        return both.select("query_tile", "data_tile", F.greatest(apart - F.col("qr") - F.col("dr"), F.lit(0.0)).alias("bound"),
                           apart.alias("promise"))
    return both.select("query_tile", "data_tile", F.col("top_norm").alias("bound"), (-F.col("top_norm")).alias("promise"))


def _reach(queries: DataFrame, found: DataFrame, dim: int, k: int, metric: str) -> DataFrame:
    """Query tiles with ``floors``, the thresholds that ``found`` proves (k values known), and ``reach``, one
    number to test a pair's bound with: the largest threshold, or the least norm that can matter."""
    kth = found.groupBy("id").agg(F.count("*").alias("n"), (F.max("value") if metric == DISTANCE else F.min("value")).alias("kth"))
    owner = queries.select("tile", F.explode("members").alias("id")).join(kth.where(F.col("n") >= k), "id", "left")
    lists = owner.groupBy("tile").agg(F.collect_list(F.struct("id", F.coalesce("kth", F.lit(float("nan"))).alias("kth"))).alias("known"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors, reach = [], []
            for ids, matrix, known in zip(*(batch.column(c).to_pylist() for c in ("ids", "matrix", "known"))):
                kth = {r["id"]: r["kth"] for r in known}
                value = np.array([kth[i] for i in np.frombuffer(ids, dtype=np.int64).tolist()])
                if metric != INNER:
                    cost = np.where(np.isnan(value), np.inf, value if metric == DISTANCE else -value)
                    reach.append(float(cost.max()))
                else:
                    cost = np.where(np.isnan(value), np.inf, -value)
                    norm = np.linalg.norm(np.frombuffer(matrix).reshape(-1, dim), axis=1)
                    with np.errstate(divide="ignore", invalid="ignore"):
                        least = np.where(np.isinf(cost), -np.inf, np.where(norm > 0, -cost / norm, np.where(cost <= 0, np.inf, -np.inf)))
                    # a query of norm 0 has product 0 with everything: it can only matter if its threshold is 0 or worse
                    least = np.where((norm == 0) & np.isfinite(cost) & (cost >= 0), -np.inf, least)
                    reach.append(float(least.min()))
                floors.append(cost.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("tile", "ids", "matrix", "cells")] + [pa.array(floors), pa.array(reach)],
                                             names=["tile", "ids", "matrix", "cells", "floors", "reach"])

    rows = queries.join(lists, "tile").select("tile", "ids", "matrix", "cells", "known")
    return rows.mapInArrow(run, "tile long, ids binary, matrix binary, cells binary, floors binary, reach double")


def best_partners(queries: DataFrame, data: DataFrame, k: int, metric: str, dim: int, limit: float = float("inf"),
                  known: DataFrame | None = None, tile_rows: int = TILE_ROWS, seeds: int = SEEDS,
                  chunk_tiles: int = CHUNK_TILES, block_tiles: int = BLOCK_TILES, cell_width: int = 1) -> tuple[DataFrame, DataFrame]:
    """(``id, partner, value, rank``; ``n_pairs, n_sent``): the ``k`` best partners in ``data`` of every row of
    ``queries`` (both ``id, group_id, vec``; ids are unique) in its group, and how many tile pairs there
    were and how many had to be sent. Distances are below ``limit``, nearest first, never to the row itself;
    inner products come largest first. Rows with ``cells`` are partners only if all ``cell_width`` numbers of
    some table agree.

    ``known`` (``id, partner, value``) are partners found before, outside ``data``: they take part in the
    result and give the thresholds at once, so no seeds are needed.
    """
    spark = queries.sparkSession
    data_tiles = write_once(make_tiles(data, metric, dim, tile_rows), "data-tiles")
    query_tiles = write_once(make_tiles(queries, metric, dim, tile_rows), "query-tiles")
    pairs = write_once(tile_pairs(query_tiles, data_tiles, metric), "tile-pairs")
    size = max(1, min(block_tiles, BLOCK_BYTES // (tile_rows * 8 * (dim + 2 * k))))
    blocks = write_once(_blocks(query_tiles, size), "tile-blocks")
    left, n_first = pairs, 0
    if known is None:
        ranked = top_k(pairs, ["query_tile"], [F.col("promise").asc(), F.col("data_tile").asc()], seeds, salt=16)
        first = write_once(ranked.join(blocks, "query_tile").withColumn("chunk", F.lit(0)), "tile-seeds")
        blank = query_tiles.withColumn("floors", F.lit(None).cast("binary"))
        known = write_once(_meet(_send(first, blank, data_tiles), dim, k, metric, limit, cell_width), "tile-seeded")
        left = pairs.join(first.select("query_tile", "data_tile"), ["query_tile", "data_tile"], "left_anti")
        n_first = first.count()
    reached = write_once(_reach(query_tiles, known, dim, k, metric), "tile-reach")
    left = left.join(reached.select(F.col("tile").alias("query_tile"), "reach").join(blocks, "query_tile"), "query_tile")
    useful = (F.col("bound") >= F.col("reach") - SLACK if metric == INNER
              else F.col("bound") <= F.least("reach", F.lit(limit if metric == DISTANCE else float("inf"))) + SLACK)
    left = write_once(left.where(useful).drop("reach"), "tile-left")
    wanted = left.groupBy("block").agg(F.countDistinct("data_tile").alias("n"))
    chunks = wanted.select("block", F.ceil(F.col("n") / chunk_tiles).alias("chunks"))
    dealt = left.join(chunks, "block").withColumn("chunk", F.pmod(F.xxhash64("data_tile"), "chunks").cast("int"))
    rest = _meet(_send(dealt, reached, data_tiles), dim, k, metric, limit, cell_width)
    order = [F.round("value", 9).asc() if metric == DISTANCE else F.round("value", 9).desc(), F.col("partner").asc()]
    out = top_k(known.select("id", "partner", "value").unionByName(rest), ["id"], order, k, rank_col="rank")
    counts = spark.range(1).select(F.lit(pairs.count()).alias("n_pairs"), F.lit(n_first + left.count()).alias("n_sent"))
    return out, counts


def _listed(found: DataFrame, group: DataFrame) -> DataFrame:
    return found.join(group, "id").select(F.col("id").alias("article_id"), F.col("group_id").alias("channel_id"),
                                          F.col("partner").alias("similar_id"), F.col("value").alias("distance"), "rank")


def _named(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col("channel_id").cast("int").alias("group_id"),
                          F.col(vec_col).cast("array<double>").alias("vec")).where(F.col("vec").isNotNull())


def _width(v: DataFrame, dim: int | None) -> int:
    if dim is None:
        probe = v.select("vec").first()   # one-row probe
        dim = len(probe[0]) if probe else 1
    return dim


def similar_lists(vectors: DataFrame, k: int, threshold: float, of: DataFrame | None = None, id_col: str = "article_id",
                  vec_col: str = "articleVector", dim: int | None = None, tile_rows: int = TILE_ROWS) -> DataFrame:
    """The true similar articles: (article_id, channel_id, similar_id, distance, rank), the ``k`` nearest
    of the same channel below ``threshold``. ``of`` (with article_id) restricts the articles that get a list."""
    v = _named(vectors, id_col, vec_col)
    asked = v if of is None else v.join(of.select(F.col("article_id").alias("id")).distinct(), "id", "left_semi")
    found, _ = best_partners(asked, v, k, DISTANCE, _width(v, dim), threshold, tile_rows=tile_rows)
    return _listed(found, v.select("id", "group_id"))


def updated_lists(lists: DataFrame, vectors: DataFrame, arrived: DataFrame, k: int, threshold: float,
                  id_col: str = "article_id", vec_col: str = "articleVector", dim: int | None = None,
                  tile_rows: int = TILE_ROWS) -> tuple[DataFrame, DataFrame]:
    """(rows of the new lists, ``article_id`` of all lists they replace) after some articles arrived or got new vectors. With the other lists left as they are, that is ``similar_lists`` of
    all ``vectors``.

    ``lists`` are those before, ``vectors`` all articles now, ``arrived`` (article_id) the new and the
    changed ones. Their own lists are searched against all articles; so are the lists that held a
    changed article, since what takes its place is not known. Every other list keeps its entries and
    meets the arrived articles only (reverse neighbours): a tile of old articles is skipped if no arrived
    tile can come nearer than the last entry of any of its lists. A replaced list may have no rows left.
    """
    v = _named(vectors, id_col, vec_col)
    dim = _width(v, dim)
    fresh = write_once(arrived.select(F.col("article_id").cast("long").alias("id")).distinct(), "arrived")
    old = lists.select(F.col("article_id").alias("id"), F.col("similar_id").alias("partner"), F.col("distance").alias("value"))
    broken = old.join(fresh.select(F.col("id").alias("partner")), "partner", "left_semi").select("id")
    search = write_once(fresh.union(broken).distinct(), "lists-searched")
    found, _ = best_partners(v.join(search, "id", "left_semi"), v, k, DISTANCE, dim, threshold, tile_rows=tile_rows)
    kept = write_once(old.join(search, "id", "left_anti"), "lists-kept")
    settled = v.join(search, "id", "left_anti")
    merged, _ = best_partners(settled, v.join(fresh, "id", "left_semi"), k, DISTANCE, dim, threshold, known=kept,
                              tile_rows=tile_rows)
    merged = write_once(merged, "lists-merged")
    touched = merged.join(fresh.select(F.col("id").alias("partner")), "partner", "left_semi").select("id").distinct()
    out = found.unionByName(merged.join(touched, "id", "left_semi"))
    return _listed(out, v.select("id", "group_id")), search.union(touched).distinct().withColumnRenamed("id", "article_id")


def replace_lists(lists: DataFrame, changed: DataFrame, replaced: DataFrame) -> DataFrame:
    """``lists`` after an update as returned by ``updated_lists``."""
    return lists.join(replaced, "article_id", "left_anti").unionByName(changed)
