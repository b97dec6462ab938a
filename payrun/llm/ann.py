"""Approximate nearest neighbours by cosine over balanced posting lists.

Centroids come from spherical k-means with a size penalty on a bounded sample, so
lists stay balanced. A centroid graph in memory (each linked to its nearest
others, both ways) is searched best-first to find the lists of a vector. A vector
near a boundary is replicated to every list almost as close as its nearest; a
query always probes its nearest ``least_probes`` lists, and of the ``most_probes``
nearest those within a distance ratio of its nearest list, however many lists there
are. A query for which these hold fewer than ``k`` other ids searches all lists. Scores are exact cosines in double precision, rounded
to 12 decimals, so that equal directions tie; ties go to smaller ids.

Rows with equal vectors share one posting. The posting carries their smallest
``k + 1`` ids: equal vectors score alike and ties go to smaller ids, so no other id
can be among anyone's ``k`` nearest, and a vector that a third of all rows share
needs no more work than one row. A list that outgrows ``block_rows`` is split in
blocks. Blocks are dealt out to shards of about ``shard_rows`` postings (``least_shards``
of them at least); a shard keeps the best ``k + 1`` vectors of each query over all its
blocks, and one that very many queries probe is searched by several tasks.

Defined results: vectors null, empty, zero or with null or non-finite components,
and rows with a null id, take no part as queries or candidates; of the rest only
vectors of the dimension that most rows have (the larger on a tie) are compared;
a row repeated with id and vector counts once; extra columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payrun.llm.common import stage


@dataclass
class Centroids:
    """Unit centroids and their graph; searched without Spark."""

    points: np.ndarray
    links: np.ndarray
    entries: np.ndarray

    @staticmethod
    def build(points: np.ndarray, degree: int = 12, seed: int = 5) -> "Centroids":
        k = len(points)
        near = np.empty((k, min(degree, max(1, k - 1))), np.int32)
        for a in range(0, k, 1024):
            sims = points[a:a + 1024] @ points.T
            sims[np.arange(len(sims)), a + np.arange(len(sims))] = -2 if k > 1 else 1
            near[a:a + 1024] = np.argsort(-sims, axis=1, kind="stable")[:, :near.shape[1]]
        links = np.tile(np.arange(k, dtype=np.int32)[:, None], (1, 2 * near.shape[1]))
        links[:, :near.shape[1]] = near
        used = np.full(k, near.shape[1])
        for a in range(k):                          # links back, as far as there is room
            for b in near[a]:
                if used[b] < links.shape[1] and a not in links[b, :used[b]]:
                    links[b, used[b]] = a
                    used[b] += 1
        rng = np.random.default_rng(seed)
        return Centroids(points, links, rng.choice(k, min(16, k), replace=False).astype(np.int32))

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroids found for each unit vector: ids and cosines, best first.

        Best-first walk of the graph for many vectors at once; -1 marks unused places.
        """
        beam = min(beam, len(self.points))
        found = [self._walk(x[a:a + 1024], beam) for a in range(0, len(x), 1024)]
        return tuple(np.concatenate(parts) for parts in zip(*found))

    def _walk(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        n, width = len(x), max(beam, len(self.entries))
        seen = np.zeros((n, len(self.points)), bool)
        seen[:, self.entries] = True
        ids = np.full((n, width), -1, np.int32)
        ids[:, :len(self.entries)] = self.entries
        sims = np.full((n, width), -2, np.float32)
        sims[:, :len(self.entries)] = x @ self.points[self.entries].T
        done = ids < 0
        while len(live := np.flatnonzero(~done.all(axis=1))):
            pick = np.where(done[live], -3, sims[live]).argmax(axis=1)
            done[live, pick] = True
            new = self.links[ids[live, pick]]
            fresh = ~seen[live[:, None], new]
            seen[live[:, None], new] = True
            sim = np.where(fresh, np.einsum("bmd,bd->bm", self.points[new], x[live]), -2)
            all_ids = np.concatenate([ids[live], np.where(fresh, new, -1)], axis=1)
            all_sims = np.concatenate([sims[live], sim], axis=1)
            all_done = np.concatenate([done[live], ~fresh], axis=1)
            order = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
            ids[live] = np.take_along_axis(all_ids, order, 1)
            sims[live] = np.take_along_axis(all_sims, order, 1)
            done[live] = np.take_along_axis(all_done, order, 1)
        order = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def lists(self, x: np.ndarray, ratio: float, least: int, most: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, list): the ``least`` nearest lists, and of the ``most`` nearest
        those within ``ratio`` times the distance of the nearest."""
        ids, sims = self.search(x, max(beam, most))
        distance = np.sqrt(np.maximum(0, 2 - 2 * sims[:, :most]))
        wanted = (np.arange(distance.shape[1]) < least) | (distance <= ratio * distance[:, :1] + 1e-6)
        near = (ids[:, :most] >= 0) & wanted
        row, place = np.nonzero(near)
        return row, ids[row, place]


def balanced_kmeans(x: np.ndarray, k: int, rounds: int = 10, weight: float = 0.05, seed: int = 3) -> np.ndarray:
    """Unit centroids; a list's excess size lowers its appeal to further vectors."""
    rng = np.random.default_rng(seed)
    points = x[rng.choice(len(x), k, replace=False)]
    size = np.ones(k)
    for _ in range(rounds):
        owner = np.empty(len(x), np.int64)
        for a in range(0, len(x), 4096):
            owner[a:a + 4096] = (x[a:a + 4096] @ points.T - weight * np.log(size + 1)[None]).argmax(axis=1)
        size = np.bincount(owner, minlength=k)
        sums = np.zeros_like(points)
        np.add.at(sums, owner, x)
        empty = size == 0
        sums[empty] = x[rng.choice(len(x), int(empty.sum()))]
        points = sums / np.maximum(1e-12, np.linalg.norm(sums, axis=1, keepdims=True))
    return points.astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and vec of the rows that take part, each once, in one dimension."""
    vec = vectors[vec_col].cast("array<double>")
    finite = ~F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = (vectors.select(vectors[id_col].cast("long").alias("vec_id"), vec.alias("vec"))
            .where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
            .where(finite & F.exists("vec", lambda v: v != 0)))
    sizes = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    return rows.where(F.size("vec") == (sizes["d"] if sizes else 0))


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
           sample: int = 20_000, list_rows: int = 256, max_lists: int = 4096, replicas: int = 4,
           replica_ratio: float = 1.05, least_probes: int = 48, most_probes: int = 64, probe_ratio: float = 1.35,
           block_rows: int = 4096, shard_rows: int = 65_536, least_shards: int = 32, shard_queries: int = 32_768) -> DataFrame:
    """The ``k`` nearest rows found for each row where ``is_query`` (on vec_id) holds.

    ``max_lists`` centroids of one dimension are what the driver and each task
    hold; the sample that they are fitted on is bounded by ``sample`` rows. A query
    probes between ``least_probes`` and ``most_probes`` lists, so the work grows with
    the number of queries and the size of a list.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col)
    by_vec = Window.partitionBy("vec").orderBy("vec_id")
    postings = stage(rows.withColumn("place", F.dense_rank().over(by_vec)).where(F.col("place") <= k + 1)
                     .groupBy("vec").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
                     .withColumn("key", F.col("ids")[0]), "postings")
    queries = rows.where(is_query).distinct()
    n = postings.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    share = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(min(1.0, sample / n) * (1 << 30))
    fitted = unit(np.stack([r["vec"] for r in postings.where(share).select("vec").toLocalIterator()]
                           or [postings.first()["vec"]]))
    lists = int(np.clip(n // list_rows, 1, min(max_lists, max(1, len(fitted) // 8))))
    model = spark.sparkContext.broadcast(Centroids.build(balanced_kmeans(fitted, lists)))

    def placed(ratio: float, least: int, most: int, kept: list[str]):
        def run(batches):
            for pdf in batches:
                if len(pdf):
                    row, of = model.value.lists(unit(np.stack(pdf["vec"])), ratio, least, most, beam=most + 16)
                    yield pd.DataFrame({"list": of, **{c: pdf[c].to_numpy()[row] for c in kept}})
        return run

    indexed = stage(postings.mapInPandas(placed(replica_ratio, 1, replicas, ["key", "vec", "ids"]),
                                         "list int, key long, vec array<double>, ids array<long>"), "lists")
    sizes = {r["list"]: r["count"] for r in indexed.groupBy("list").count().collect()}      # at most max_lists rows
    split = [max(1, -(-sizes.get(i, 0) // block_rows)) for i in range(lists)]
    shards = max(least_shards, -(-sum(sizes.values()) // shard_rows))
    n_blocks = F.element_at(F.array(*map(F.lit, split)), F.col("list") + 1)
    cell = (F.col("list").cast("long") * (1 << 32) + F.col("block")).alias("cell")
    shard = F.pmod(F.xxhash64("cell"), F.lit(shards)).cast("int").alias("shard")
    asked = stage(queries.groupBy("vec").agg(F.min("vec_id").alias("key")), "asked")
    spread = asked.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "key")
    probing = spread.mapInPandas(placed(probe_ratio, least_probes, max(least_probes, most_probes), ["key"]), "list int, key long")
    indexed = (indexed.withColumn("block", F.pmod(F.xxhash64("key"), n_blocks).cast("int"))
               .select(cell, "key", "vec", "ids").select("*", shard))

    def nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Of one shard: the best ``k + 1`` vectors of each probing query, exactly scored."""
        out = {"key": [], "score": [], "ids": []}
        if len(left) and len(right):
            once = right.drop_duplicates("key").reset_index(drop=True)          # a vector may be in several lists
            p = np.stack(once["vec"])
            p_norm = np.sqrt((p * p).sum(axis=1))
            ids, smallest = once["ids"].to_numpy(), once["key"].to_numpy()
            place = pd.Series(np.arange(len(once)), index=smallest)
            members = {c: place[keys].to_numpy() for c, keys in right.groupby("cell")["key"]}
            step = max(1, 4_000_000 // len(p))
            for a in range(0, len(left), step):
                part = left.iloc[a:a + step]
                vecs = np.stack(part["vec"])
                probed = part["cells"].explode()
                probed.index = np.repeat(np.arange(len(part)), part["cells"].str.len())
                rough = np.full((len(part), len(p)), -np.inf)
                for c, of in probed.groupby(probed).groups.items():
                    if c in members:
                        at, mine = np.asarray(of), members[c]
                        rough[np.ix_(at, mine)] = vecs[at] @ p[mine].T / p_norm[mine]
                for key, vec, row in zip(part["key"], vecs, rough):
                    top, norm = np.flatnonzero(row > -np.inf), np.sqrt((vec * vec).sum())
                    if len(top) > k + 1:             # with all that may tie with the last place
                        margin = norm * (2e-12 + 4 * len(vec) * np.finfo(float).eps)
                        top = top[row[top] >= np.partition(row, -k - 1)[-k - 1] - margin]
                    score = np.round((p[top] * vec).sum(axis=1) / (norm * p_norm[top]), 12)
                    best = np.lexsort((smallest[top], -score))[:k + 1]
                    out["key"] += [key] * len(best)
                    out["score"] += score[best].tolist()
                    out["ids"] += ids[top[best]].tolist()
        out["ids"] = pd.Series(out["ids"], dtype=object)     # also where there are none
        return pd.DataFrame(out)

    first = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")

    def scanned(probing: DataFrame) -> DataFrame:
        """The best ``k + 1`` ids of each key in the lists that it probes (``list, key``)."""
        cells = (probing.withColumn("block", F.explode(F.sequence(F.lit(0), n_blocks - 1))).select("key", cell).select("*", shard)
                 .groupBy("shard", "key").agg(F.collect_list("cell").alias("cells")))
        probes = stage(cells.join(asked, "key"), "probes")
        parts = probes.groupBy("shard").agg(F.ceil(F.count("*") / shard_queries).cast("int").alias("parts"))
        left = probes.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")).drop("parts")
        right = indexed.join(parts, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        found = (left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part"))
                 .applyInPandas(nearest, "key long, score double, ids array<long>"))
        return (found.select("key", "score", F.explode("ids").alias("vec_id")).groupBy("key", "vec_id")
                .agg(F.max("score").alias("score")).withColumn("place", F.row_number().over(first))
                .where(F.col("place") <= k + 1).drop("place"))

    best = stage(scanned(probing), "best")
    full = best.groupBy("key").count().where(F.col("count") > k).select("key")
    short = stage(asked.join(full, "key", "left_anti").select("key"), "short")
    if not short.isEmpty():                          # too few ids in the probed lists: search all
        every = short.withColumn("list", F.explode(F.sequence(F.lit(0), F.lit(lists - 1))))
        best = best.join(short.select("key"), "key", "left_anti").unionByName(scanned(every))
    own = queries.select("vec", F.col("vec_id").alias("query_id"))
    ranked = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return (own.join(asked, "vec").drop("vec").join(best, "key").where(F.col("vec_id") != F.col("query_id"))
            .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
