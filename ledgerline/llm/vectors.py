"""Near-duplicate vectors by product quantisation (operator 8).

Vectors alike in direction to the last bit are one class and are searched once. Coarse
centroids split the classes into inverted lists; what remains of a vector after its centroid
is cut into subspaces, and each part is stored as the code of its nearest sub-centroid. Both
codebooks are fitted on a bounded sample; every class is indexed. A class is searched for in
the lists of its own centroid and of those nearest to it. There, table look-ups give its
distance to every code (asymmetric: the query isn't coded); codes too far even for their own
coding error are left out, and the rest are compared exactly, in double precision.

A list and its visitors are dealt out in tiles of bounded size. A link that the two sides
would find in different lists is counted once for each side: a tile counts it for the member
too only if the member's own search doesn't reach the visitor's list. Tiles return counts and
the links of a spanning forest, never all pairs.

Nulls and odd input: a vector that is null, empty, zero or has null or non-finite parts links
with nothing, as do vectors of different lengths. Rows that repeat a vec_id count as vectors of
their own. A row without a vec_id is searched like any other; component_id is the least vec_id
that is not null, and such a row isn't kept. An empty table gives no rows. Other columns, labels
among them, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import components

LEAST_COSINE = 0.9
#: Codebooks are fitted on so many classes, or so many for each list if that is more, whose hashes
#: are lowest, as far as their vectors fit into SAMPLE_BYTES.
SAMPLE, SAMPLE_PER_LIST, SAMPLE_BYTES = 20_000, 16, 256 << 20
#: Classes in a list, on average; there are at least 8 lists and at most MOST_LISTS.
PER_LIST, MOST_LISTS = 256, 16_384
#: Lists that are searched for a vector: this many, or all.
PROBES = 12
SUBSPACES, CODES = 8, 64
#: Most members and visitors in a tile.
TILE_MEMBERS, TILE_VISITORS = 4_096, 16_384
_ROUNDS = 8


@dataclass
class Index:
    centroids: np.ndarray  # (lists, dimensions), unit length
    codebooks: np.ndarray  # (subspaces, codes, dimensions of a subspace)

    def parts(self, x: np.ndarray) -> np.ndarray:
        """(vector, subspace, dimensions of a subspace), with zeros behind the last."""
        wide = np.zeros((len(x), self.codebooks.shape[0] * self.codebooks.shape[2]), np.float32)
        wide[:, : x.shape[1]] = x
        return wide.reshape(len(x), self.codebooks.shape[0], -1)

    def probes(self, x: np.ndarray, n: int) -> np.ndarray:
        """The n nearest lists of each vector, the nearest first."""
        n = min(n, len(self.centroids))
        near = x @ self.centroids.T
        at = np.argpartition(-near, n - 1, axis=1)[:, :n] if n < near.shape[1] else np.tile(np.arange(n), (len(x), 1))
        order = np.lexsort((at, -np.take_along_axis(near, at, 1)), axis=1)
        return np.take_along_axis(at, order, 1)

    def coded(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, coding error: the length of what they don't hold)."""
        rest = self.parts(x - self.centroids[lists])
        codes = np.empty(rest.shape[:2], np.uint8)
        left = np.zeros(len(x))
        for m, book in enumerate(self.codebooks):
            d = (rest[:, m] ** 2).sum(1)[:, None] - 2 * rest[:, m] @ book.T + (book**2).sum(1)
            codes[:, m] = d.argmin(1)
            left += ((rest[:, m] - book[codes[:, m]]) ** 2).sum(1)
        return codes, np.sqrt(left)


def means(x: np.ndarray, k: int, unit: bool, seed: int) -> np.ndarray:
    """k-means by Lloyd's rounds from a fixed random start."""
    draw = np.random.default_rng(seed)
    at = x[draw.choice(len(x), k, replace=len(x) < k)].astype(np.float32)
    for _ in range(_ROUNDS):
        own = np.concatenate([((at**2).sum(1) - 2 * b @ at.T).argmin(1) for b in np.array_split(x, max(1, len(x) * k // 5_000_000))])
        n = np.bincount(own, minlength=k)
        sums = np.zeros((k, x.shape[1]))
        np.add.at(sums, own, x)
        at = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], at).astype(np.float32)
        if unit:
            at /= np.maximum(np.linalg.norm(at, axis=1, keepdims=True), 1e-12)
    return at


def lists_for(n: int) -> int:
    return int(min(max(8, n // PER_LIST), MOST_LISTS))


def sampled(classes: DataFrame, n: int, size: int) -> np.ndarray:
    """The vectors that the codebooks are fitted on, of n classes with size bytes a vector."""
    rows = min(max(SAMPLE, SAMPLE_PER_LIST * lists_for(n)), max(1, SAMPLE_BYTES // size))
    found = common.hash_sample(classes.select("rep", "unit"), rows, 8, "rep").select("unit").toArrow().column(0)
    return np.concatenate([vectors_of(x.to_pylist()).astype(np.float32) for x in found.chunks if len(x)])


def fit(sample: np.ndarray, n: int) -> Index:
    """sample: unit vectors. n: classes to be indexed."""
    lists = min(lists_for(n), max(1, len(sample) // 4))
    centroids = means(sample, lists, True, 8)
    own = np.concatenate([(b @ centroids.T).argmax(1) for b in np.array_split(sample, max(1, len(sample) * lists // 5_000_000))])
    size = -(-sample.shape[1] // SUBSPACES)
    index = Index(centroids, np.zeros((SUBSPACES, CODES, size), np.float32))
    rest = index.parts(sample - centroids[own])
    index.codebooks = np.stack([means(rest[:, m], CODES, False, 80 + m) for m in range(SUBSPACES)])
    return index


def unit_rows(vectors: DataFrame) -> DataFrame:
    """vec_id, unit (binary, doubles; null if it can't link), and a digest that a class shares."""
    schema = pa.schema([("vec_id", pa.int64()), ("unit", pa.binary()), ("same", pa.binary())])

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for table in common.sliced(batches):
            ids, xs = common.batches_of(table, "vec_id", "embedding")
            out, same = [], []
            for x in xs:
                v = np.array([np.nan if y is None else y for y in x], np.float64) if x else np.zeros(1)
                size = np.linalg.norm(v / np.abs(v).max()) * np.abs(v).max() if np.isfinite(v).all() and v.any() else 0.0
                out.append((v / size).tobytes() if size else None)
                same.append(xxhash.xxh3_128_digest(out[-1]) if size else None)
            yield common.batch(schema, ids, out, same)

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(units, "vec_id long, unit binary, same binary")


def vectors_of(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def placed(classes: DataFrame, index: Index) -> DataFrame:
    """Each class once for each list it visits: list, home (is it its own list?), the class,
    its size, its unit vector, the lists it probes, codes and coding error."""
    shared = classes.sparkSession.sparkContext.broadcast(index)  # MOST_LISTS centroids at most
    kind = "list int, home boolean, rep long, n long, unit binary, probes array<int>, codes binary, error double"
    schema = pa.schema([("list", pa.int32()), ("home", pa.bool_()), ("rep", pa.int64()), ("n", pa.int64()), ("unit", pa.binary()),
        ("probes", pa.list_(pa.int32())), ("codes", pa.binary()), ("error", pa.float64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for whole in batches:
            for a in range(0, whole.num_rows, 1024):
                table = whole.slice(a, 1024)
                reps, sizes, units = common.batches_of(table, "rep", "n", "unit")
                x = vectors_of(units).astype(np.float32)
                probes = own.probes(x, PROBES)
                codes, error = own.coded(x, probes[:, 0])
                k = np.repeat(np.arange(len(reps)), probes.shape[1])
                home = np.tile(np.arange(probes.shape[1]) == 0, len(reps))
                told = probes.tolist()
                yield common.batch(
                    schema, probes.reshape(-1), home, [reps[i] for i in k], [sizes[i] for i in k], [units[i] for i in k], [told[i] for i in k],
                    [codes[i].tobytes() if h else None for i, h in zip(k, home, strict=True)], error[k],
                )

    return classes.mapInArrow(place, kind)


def tiles(rows: DataFrame) -> DataFrame:
    """rows with the tiles (list, m, v) that they are in: a member is in one block of members
    and meets all blocks of visitors, a visitor the other way round."""
    sums = rows.groupBy("list").agg(F.count_if("home").alias("members"), F.count("*").alias("visitors"))
    both = rows.join(sums, "list")
    blocks = lambda n, most: F.greatest(F.lit(1), F.ceil(F.col(n) / most)).cast("int")
    both = both.withColumn("ms", blocks("members", TILE_MEMBERS)).withColumn("vs", blocks("visitors", TILE_VISITORS))
    h = F.xxhash64("rep")
    as_member = both.where("home").withColumn("m", F.pmod(h, F.col("ms")).cast("int")).withColumn("v",
        F.explode(F.sequence(F.lit(0), F.col("vs") - 1))).withColumn("member", F.lit(True))
    as_visitor = both.withColumn("v", F.pmod(h, F.col("vs")).cast("int")).withColumn("m",
        F.explode(F.sequence(F.lit(0), F.col("ms") - 1))).withColumn("member", F.lit(False))
    return as_member.unionByName(as_visitor).where("members > 0").drop("members", "visitors", "ms", "vs", "home")


def tile_links(index: Index, members: pd.DataFrame, visitors: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """(links of each visitor, links of each member that its own search misses, the visitors'
    least linked member, and further links so that all that are linked in the tile are joined)."""
    y, x = vectors_of(members["unit"]), vectors_of(visitors["unit"])
    here = int(members["list"].iloc[0])
    codes = np.frombuffer(b"".join(members["codes"]), np.uint8).reshape(len(y), SUBSPACES)
    reach = np.sqrt(2 - 2 * LEAST_COSINE) + members["error"].to_numpy() + 1e-4
    size, extra = members["n"].to_numpy(), np.zeros(len(y), np.int64)
    links, least = np.zeros(len(x), np.int64), np.full(len(x), -1)
    probed = np.stack(members["probes"].to_numpy())
    home = np.array([p[0] for p in visitors["probes"]])
    group = np.arange(len(y))  # members joined so far
    joins = []
    books = index.codebooks
    for a in range(0, len(x), 512):
        q = x[a : a + 512]
        rest = index.parts((q - index.centroids[here]).astype(np.float32))
        far = np.zeros((len(q), len(y)), np.float32)
        for m in range(SUBSPACES):
            table = (rest[:, m] ** 2).sum(1)[:, None] - 2 * rest[:, m] @ books[m].T + (books[m] ** 2).sum(1)
            far += table[:, codes[:, m]]
        i, k = np.nonzero(far <= (reach**2).astype(np.float32) + 1e-4)
        same = np.concatenate([np.einsum("ij,ij->i", q[i[b : b + 65536]], y[k[b : b + 65536]])
            for b in range(0, len(i), 65536)]) >= LEAST_COSINE if len(i) else np.zeros(0, bool)
        i, k = i[same], k[same]
        other = visitors["rep"].to_numpy()[a + i] != members["rep"].to_numpy()[k]
        i, k = i[other], k[other]
        np.add.at(links, a + i, size[k])
        missed = ~(probed[k] == home[a + i][:, None]).any(1)
        np.add.at(extra, k[missed], visitors["n"].to_numpy()[a + i[missed]])
        for v, at in zip(*_runs(i, k), strict=True):
            roots = np.unique(group[at])
            least[a + v] = at[0]
            if len(roots) > 1:  # joined by this visitor
                joins += [(a + v, int(r)) for r in roots]
                group[np.isin(group, roots)] = roots[0]
    return links, extra, least, joins


def _runs(i: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    if not len(i):
        return i, []
    cuts = np.flatnonzero(np.diff(i)) + 1
    return i[np.concatenate(([0], cuts))], np.split(k, cuts)


def searched(rows: DataFrame, index: Index) -> DataFrame:
    """a, b (classes), links: what tiles found. links counts vectors that a is linked with; a and b are
    linked (b is null in rows that only count)."""
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def search(tile: pd.DataFrame) -> pd.DataFrame:
        members, visitors = tile[tile["member"]], tile[~tile["member"]]
        if not len(members) or not len(visitors):
            return pd.DataFrame({"a": [], "b": [], "links": []})
        links, extra, least, joins = tile_links(shared.value, members, visitors)
        mine, theirs = visitors["rep"].to_numpy(), members["rep"].to_numpy()
        out = [(mine[v], theirs[least[v]], links[v]) for v in np.flatnonzero(links)]
        out += [(theirs[m], None, extra[m]) for m in np.flatnonzero(extra)]
        out += [(mine[v], theirs[m], 0) for v, m in joins]
        return pd.DataFrame(out, columns=["a", "b", "links"]).astype({"a": "int64", "b": "Int64", "links": "int64"})

    return tiles(rows).groupBy("list", "m", "v").applyInPandas(search, "a long, b long, links long")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector. vectors: vec_id, embedding."""
    spark = vectors.sparkSession
    rows = common.saved(unit_rows(vectors).withColumn("rep", F.xxhash64("same")), "units")
    alike = rows.where(F.col("same").isNotNull()).groupBy("rep", F.length("unit").alias("size"))
    classes = common.saved(alike.agg(F.min("vec_id").alias("least"), F.count("*").alias("n"), F.min("unit").alias("unit")), "classes")
    found = []
    for size, n in sorted((r["size"], r["count"]) for r in classes.groupBy("size").count().collect()):  # one row for each length of vector
        own = classes.where(F.col("size") == size)
        index = fit(sampled(own, n, size), n)
        found.append(searched(placed(own.select("rep", "n", "unit"), index), index))
    links = spark.createDataFrame([], "a long, b long, links long")
    for x in found:
        links = links.unionByName(x)
    links = common.saved(links, "found")
    joined = components(links.where(F.col("b").isNotNull()).select("a", "b"))
    counts = links.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    per = classes.join(counts, "rep", "left").join(joined.withColumnRenamed("vertex", "rep"), "rep", "left")
    per = per.select("rep", "least", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    least = per.groupBy("component").agg(F.min("least").alias("component_id"))
    per = per.join(least, "component").select("rep", "n_links", "component_id")
    linked = rows.where(F.col("same").isNotNull()).join(per, "rep").select("vec_id", "n_links", F.coalesce("component_id", "vec_id").alias("component_id"))
    alone = rows.where(F.col("same").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
