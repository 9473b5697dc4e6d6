"""Exact top-N by inner product for many short vectors (W4), lists finished inside a task.

1. Items are packed into batches and sent once to every block of users; a block's task holds the items of one chunk
   (at most ``CHUNK_ITEMS``) and takes its users ``TILE_USERS`` at a time. The lists of a user are complete at once,
   so no list is shuffled or merged unless there are several chunks.
2. The items of a chunk are cut into tiles of neighbours (median splits along the widest component). A user meets a tile
   only if the tile's box and ball let some product reach the user's n-th score so far; most promising tiles first.
3. Products in single precision select candidates, with a slack beyond their rounding errors; the scores returned and
   all comparisons between candidates are of double precision, rounded to 9 places, ties by id.

Names and channels travel with the items, so the lists are never joined row by row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.tiles import locality_key
from newsloom.operators.topk import top_k
from newsloom.session import write_once

CHUNK_ITEMS = 2_000_000   # items that a task holds
BLOCK_USERS = 1 << 15     # users of a block at most
LEAST_BLOCKS = 12         # blocks if there are that many thousands of users
TILE_USERS = 512
TILE_ITEMS = 256
SEEDS = 20                # times n: items of the nearest tiles that give a user's first floor
PENDING = 1 << 16         # candidates of a tile of users that are held unsorted


def neighbours(rows: np.ndarray, size: int) -> np.ndarray:
    """An order of ``rows`` in which every ``size`` that follow each other are near each other."""
    order, left = np.arange(len(rows)), [(0, len(rows))]
    while left:
        a, b = left.pop()
        if b - a <= size:
            continue
        part = rows[order[a:b]]
        half = max(1, -(-(b - a) // size) // 2) * size
        order[a:b] = order[a:b][np.argpartition(part[:, int(part.var(axis=0).argmax())], half - 1)]
        left += [(a, a + half), (a + half, b)]
    return order


class Items:
    """The items of a chunk in tiles of neighbours, with boxes and balls of the tiles."""

    def __init__(self, ids: np.ndarray, names: np.ndarray, matrix: np.ndarray, sizes: np.ndarray, channels: np.ndarray, tile: int = TILE_ITEMS):
        order = neighbours(matrix, tile)
        self.ids, self.names, self.matrix, self.tile = ids[order], names[order], np.ascontiguousarray(matrix[order]), tile
        self.sizes, self.first = sizes[order], (np.cumsum(sizes) - sizes)[order]
        self.channels = channels
        self.lowest = np.argsort(self.ids, kind="stable")
        at = np.arange(0, len(ids), tile)
        self.low, self.high = np.minimum.reduceat(self.matrix, at), np.maximum.reduceat(self.matrix, at)
        self.centre = (self.low + self.high) / 2
        apart = ((self.matrix - np.repeat(self.centre, tile, axis=0)[:len(ids)]) ** 2).sum(axis=1, dtype=np.float64)
        self.radius = (np.sqrt(np.maximum.reduceat(apart, at)) * (1 + 1e-5)).astype(np.float32)
        self.corner = float(np.sqrt((np.maximum(np.abs(self.low), np.abs(self.high)).astype(np.float64) ** 2).sum(axis=1)).max())

    def best(self, users: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(user, item, score): the ``k`` items of largest product with each row of ``users``, best first."""
        n, dim = users.shape
        k = min(k, len(self.ids))
        norm = np.sqrt((users.astype(np.float64) ** 2).sum(axis=1))
        # more than the rounding errors of a product or bound in single precision, and of 9 places
        slack = (dim + 8) * 2.0 ** -22 * norm * self.corner + 2e-9
        bound = np.maximum(users, 0) @ self.high.T + np.minimum(users, 0) @ self.low.T
        np.minimum(bound, users @ self.centre.T + norm.astype(np.float32)[:, None] * self.radius, out=bound)
        # a product below the floor of its user cannot matter
        floor = np.where(norm == 0, np.inf, self._reached(users, k) - 2 * slack).astype(np.float32)
        null = np.flatnonzero(norm == 0)   # all their products are 0: the lowest ids
        kept = (np.repeat(null, k), np.tile(self.lowest[:k], len(null)), np.zeros(len(null) * k))
        turns = np.argsort(-bound.max(axis=0), kind="stable")
        bound, held, waiting = np.ascontiguousarray(bound.T), 0, []
        for t in turns[(bound[turns] >= floor).any(axis=1)].tolist():
            rows = (bound[t] >= floor).nonzero()[0]
            if not len(rows):
                continue
            product = users[rows] @ self.matrix[t * self.tile:(t + 1) * self.tile].T
            at = (product >= floor[rows, None]).ravel().nonzero()[0]
            if len(at):
                waiting.append((rows[at // product.shape[1]], t * self.tile + at % product.shape[1]))
                held += len(at)
            if held > PENDING:
                kept, held, waiting = self._cut(users, kept, waiting, k, floor, slack), 0, []
        return self._cut(users, kept, waiting, k, floor, slack) if waiting else kept

    def _reached(self, users: np.ndarray, k: int) -> np.ndarray:
        """The ``k``-th product of each user with the items of its nearest tiles."""
        tiles = min(len(self.centre), -(-SEEDS * k // self.tile))
        near = np.argpartition(-(users @ self.centre.T), tiles - 1, axis=1)[:, :tiles]
        item = (near[:, :, None] * self.tile + np.arange(self.tile)).reshape(len(users), -1)
        product = np.matmul(self.matrix[np.minimum(item, len(self.ids) - 1)], users[:, :, None])[:, :, 0]
        product[item >= len(self.ids)] = -np.inf
        return np.partition(product, product.shape[1] - k, axis=1)[:, product.shape[1] - k].astype(np.float64)

    def _cut(self, users: np.ndarray, kept: tuple, waiting: list[tuple], k: int, floor: np.ndarray, slack: np.ndarray) -> tuple:
        """The best ``k`` of each user among those kept and those waiting; raises ``floor``."""
        user, item = (np.concatenate(x) for x in zip(*waiting))
        score = (self.matrix[item].astype(np.float64) * users[user]).sum(axis=1)
        user, item, score = (np.concatenate(x) for x in zip(kept, (user, item, score)))
        order = np.lexsort((self.ids[item], np.round(-score, 9), user))
        user = user[order]
        rank = np.arange(len(user)) - np.searchsorted(user, user)
        whole, last = user[rank == k - 1], order[rank == k - 1]
        floor[whole] = np.maximum(floor[whole], np.nextafter((score[last] - slack[whole]).astype(np.float32), np.float32(-np.inf)))
        order, user = order[rank < k], user[rank < k]
        return user, item[order], score[order]

    def rows(self, ids: np.ndarray, names: np.ndarray, users: np.ndarray, k: int) -> pa.RecordBatch:
        user, item, score = self.best(users, k)
        place = np.arange(len(user)) - np.searchsorted(user, user)
        size, first = self.sizes[item], self.first[item]
        ends = np.concatenate(([0], np.cumsum(size)))
        own = np.arange(ends[-1]) - np.repeat(ends[:-1] - first, size)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[user]), pa.array(names[user]), pa.array(self.ids[item]), pa.array(self.names[item]), pa.array(score),
             pa.array(place.astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(self.channels[own]))],
            names=["user", "user_name", "item", "item_name", "score", "pos", "channels"])


def _packed(rows: DataFrame) -> DataFrame:
    """(part, ids, names, matrix, sizes, channels): the rows of a batch with the same ``part``, as binaries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("part").to_numpy()
            for part in np.unique(parts):
                own = batch.take(pa.array(np.flatnonzero(parts == part)))
                lists = own.column("channels")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(part)])] + [pa.array([x.astype(kind).tobytes()]) for x, kind in (
                        (own.column("id").to_numpy(), np.int32), (own.column("name").to_numpy(), np.int64),
                        (own.column("vec").flatten().to_numpy(), np.float32), (pc.list_value_length(lists).to_numpy(), np.int32),
                        (lists.flatten().to_numpy(), np.int32))],
                    names=["part", "ids", "names", "matrix", "sizes", "channels"])

    return rows.select("part", "id", "name", "vec", "channels").mapInArrow(
        run, "part long, ids binary, names binary, matrix binary, sizes binary, channels binary")


def _near(users: DataFrame, blocks: int, dim: int) -> DataFrame:
    """``users`` dealt to ``blocks`` (``part``) of neighbours."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = locality_key(dim)
        for batch in batches:
            found = key(batch.column("vec").flatten().to_numpy().reshape(-1, dim).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.astype(np.int64))], names=[*batch.schema.names, "key"])

    keyed = users.select("id", "name", "vec").mapInArrow(run, "id int, name long, vec array<float>, key long")
    dealt = keyed.repartitionByRange(blocks, "key", "id").withColumn("part", (F.spark_partition_id() % blocks).cast("long"))
    return write_once(dealt.withColumn("channels", F.array().cast("array<int>")), "product-users")


def _spread(spark: SparkSession, parts: int) -> Column:
    """Numbers that a shuffle by them sends to each of ``parts`` partitions."""
    found = spark.range(parts * 32).groupBy(F.pmod(F.hash("id"), F.lit(parts)).alias("p")).agg(F.min("id").alias("id"))
    place = {r["p"]: r["id"] for r in found.collect()}
    return F.array(*[F.lit(place.get(p, -1 - p)).cast("long") for p in range(parts)])


def _meet(sent: DataFrame, k: int, dim: int) -> DataFrame:
    """Rows of one (block, chunk) follow each other: the items, then the users."""
    def finished(held: dict[int, list]) -> Iterator[pa.RecordBatch]:
        if len(held) == 2:
            whole = {turn: [np.concatenate(x) for x in zip(*rows)] for turn, rows in held.items()}
            items = Items(whole[0][0], whole[0][1], whole[0][2].reshape(-1, dim), whole[0][3], whole[0][4])
            ids, names, matrix = whole[1][0], whole[1][1], whole[1][2].reshape(-1, dim)
            order = neighbours(matrix, TILE_USERS)
            for at in range(0, len(order), TILE_USERS):
                some = order[at:at + TILE_USERS]
                yield items.rows(ids[some], names[some], matrix[some], k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = {}, None
        for batch in batches:
            for row in range(batch.num_rows):
                where = batch.column("block")[row].as_py(), batch.column("chunk")[row].as_py()
                if where != at:
                    yield from finished(held)
                    held, at = {}, where
                held.setdefault(batch.column("turn")[row].as_py(), []).append(tuple(
                    np.frombuffer(batch.column(c)[row].as_py(), dtype=kind) for c, kind in (
                        ("ids", np.int32), ("names", np.int64), ("matrix", np.float32), ("sizes", np.int32), ("channels", np.int32))))
        yield from finished(held)

    return sent.mapInArrow(run, "user int, user_name long, item int, item_name long, score double, pos int, channels array<int>")


def top_products(users: DataFrame, items: DataFrame, k: int, dim: int, chunk_items: int = CHUNK_ITEMS,
                 block_users: int = BLOCK_USERS) -> tuple[DataFrame, DataFrame]:
    """(user, user_name, item, item_name, score, pos, channels) and the counts (n_pairs, n_sent) of blocks that met a
    chunk: the ``k`` of ``items`` with the largest product with each of ``users``. Both are ``id int, name long, vec
    array<float>`` with unique ids; the ``channels array<int>`` of an item travel along. ``pos`` starts at 0."""
    spark = users.sparkSession
    items = write_once(items, "product-items")
    n_users, n_items = users.count(), items.count()
    blocks = max(1, -(-n_users // block_users), min(LEAST_BLOCKS, n_users // 1024))
    chunks = max(1, -(-n_items // chunk_items))
    block, chunk = (F.explode(F.array(*[F.lit(x).cast("long") for x in range(n)])) for n in (blocks, chunks))
    mine = _packed(_near(users, blocks, dim)).withColumnRenamed("part", "block").withColumn("chunk", chunk).withColumn("turn", F.lit(1))
    theirs = _packed(items.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(chunks)))).withColumnRenamed("part", "chunk") \
        .withColumn("block", block).withColumn("turn", F.lit(0))
    sent = mine.unionByName(theirs).withColumn("key", F.get(_spread(spark, blocks * chunks), (F.col("block") * chunks + F.col("chunk")).cast("int")))
    sent = sent.repartition(blocks * chunks, "key").sortWithinPartitions("block", "chunk", "turn")
    found = _meet(sent, k, dim)
    if chunks > 1:
        found = top_k(found.drop("pos"), ["user"], [F.round("score", 9).desc(), F.col("item").asc()], k, rank_col="pos").withColumn("pos", F.col("pos") - 1)
    counts = spark.range(1).select(F.lit(blocks * chunks).alias("n_pairs"), F.lit(blocks * chunks).alias("n_sent"))
    return found, counts
