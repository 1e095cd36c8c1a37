"""Documents joined by the Jaccard similarity of their word shingles (operator 4).

Every pair with similarity of 0.8 or more is found; nothing is sampled.

1. A document's set is that of its distinct shingles, as 64-bit hashes in ascending order.
   Documents with the same set are one class, which is searched once.
2. Sets A and B that are similar share at least 0.8 of either's elements. So of the first
   |A| - ceil(0.8 |A|) + l elements of A, in the order of their hashes, and the like of B, the
   first l common ones are in both: the regions. l grows with the size (spare()).
3. How many classes have each element in their region is counted over all documents. Elements
   that only one class has say nothing more; a class that shares fewer elements than l with
   all others together, as documents do that have a passage in common, has no partner.
4. Of what is left, each class lists its rarest elements, so many that a partner must have
   one of them. They are keyed by element and size band: sets whose sizes differ by more than
   0.8 don't meet. These tiles are the candidates.
5. In a tile each class is first compared with one leader only. Links make components, and
   then only classes of a tile that aren't in one component yet are compared. So a group of
   near copies costs about as many comparisons as it has members.
6. A comparison first counts the bits in which two hashed bitmaps differ. A bit is the parity
   of the elements hashed to it, so no more bits differ than elements do; too many, and the
   pair is out. The rest are intersected exactly, as sorted arrays.

Elements on a large share of documents (hot_elements()) are known to be shared, so they go
past step 3's count, and no task has to hold all classes with such an element.

Nulls and odd input: a null text, or one without words, has an empty set and links with
nothing. Texts of fewer than SHINGLE words have one shingle. Every row is a document of its own:
rows that repeat a doc_id with another text are searched each for itself, and rows without a
doc_id are searched like any other; component_id is the least doc_id that is not null, and null
if a group has none. Of equal rows stage() keeps one. Texts are taken whole, however long. An
empty table gives no rows. Other columns are ignored, and kept by stage().
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import components

SHINGLE = 5
#: The least l, but for sets that have no more to share.
SPARE_LEAST = 128
#: Rounds in which a class is compared with one leader of a tile.
STAR_ROUNDS = 1
#: An element counts as hot from this share of the documents; where a task sees fewer
#: documents than HOT_LEAST with it, it isn't looked at.
HOT_SHARE, HOT_LEAST = 1 / 256, 8
#: Representatives that are broadcast at most, to pick their texts; more are joined by shuffle.
BROADCAST_ROWS = 200_000
#: Tiles of up to so many classes are compared many at a time.
SMALL_TILE = 64
#: Classes of a tile that meet in one task, about.
TILE_ROWS = 1024
#: Groups with so great a part of all rows are joined where their rows are.
HOT_GROUP = 1024
#: Elements that a task holds before it sends them on.
HELD = 1 << 19
_HOT = np.int64(1) << 40


def shingles(text: str | None) -> np.ndarray:
    """The set of a text: ascending 64-bit hashes."""
    return np.unique(common.ngram_ids(common.word_ids(text), SHINGLE))


def least_common(n):
    """What a set of n elements shares at least with a similar one: ceil(0.8 n)."""
    return (4 * n + 4) // 5


def spare(n):
    """l of step 2; it never falls as n grows. Short texts are held against each other whole."""
    return np.maximum(1 + n // 10, np.minimum(least_common(n), SPARE_LEAST))


def region_size(n):
    return np.minimum(n, n - least_common(n) + spare(n))


def band_edges(top: int = 1 << 40) -> np.ndarray:
    """The least sizes of the bands: similar sets are in one band or in neighbouring ones."""
    edges = [1]
    while edges[-1] < top:
        edges.append(edges[-1] * 5 // 4 + 1)
    return np.array(edges)


EDGES = band_edges()


def digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def class_of(d: bytes) -> int:
    return int.from_bytes(d[:8], "little", signed=True)


def sets_of(docs: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, keys (columns of longs), n and class (64 bits of the set's digest) of each
    document; and for each task one more row, with hot: the elements that many of its regions
    have, and how many."""
    kept = ["doc_id", *keys]
    schema = pa.schema([*((k, pa.int64()) for k in kept), ("n", pa.int64()), ("class", pa.int64()), ("hot", pa.binary())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        regions, held, docs_seen, counts = [], 0, 0, {}

        def count() -> None:
            found, n = np.unique(np.concatenate(regions), return_counts=True)
            many = n >= HOT_LEAST
            for e, k in zip(found[many].tolist(), n[many].tolist(), strict=True):
                counts[e] = counts.get(e, 0) + k

        for table in common.sliced(batches):
            rows = []
            for text in table.column("text").to_pylist():
                s = shingles(text)
                rows.append((len(s), class_of(digest(s)) if len(s) else None, None))
                if len(s):
                    regions.append(s[: region_size(len(s))])
                    held, docs_seen = held + len(regions[-1]), docs_seen + 1
                if held >= 2 * HELD:
                    count()
                    regions, held = [], 0
            if rows:
                yield common.batch(schema, *(table.column(k) for k in kept), *map(list, zip(*rows, strict=True)))
        if regions:
            count()
        hot = [(e, k) for e, k in counts.items() if k >= docs_seen * HOT_SHARE]
        if hot:
            pairs = np.array([e for e, _ in hot], np.uint64), np.array([k for _, k in hot], np.uint64)
            yield common.batch(schema, *([None] for _ in kept), [-1], [None], [np.stack(pairs).tobytes()])

    kind = ", ".join(f"`{k}` long" for k in kept) + ", n long, class long, hot binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *keys).mapInArrow(build, kind)


def hot_elements(sets: DataFrame) -> np.ndarray:
    """The elements that tasks found on HOT_SHARE of all documents together: fewer than the
    regions' mean size over HOT_SHARE. Elements that are spread thinner may be left out."""
    schema = pa.schema([("element", pa.int64()), ("n", pa.int64())])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.sliced(batches):
            for x in table.column("hot").to_pylist():
                e, n = np.frombuffer(x, np.uint64).reshape(2, -1)
                yield common.batch(schema, e.view(np.int64), n.astype(np.int64))

    total = sets.where("n > 0").count()
    sums = sets.where(F.col("hot").isNotNull()).select("hot").mapInArrow(unpack, "element long, n long").groupBy("element").agg(F.sum("n").alias("n"))
    found = sums.where(F.col("n") >= total * HOT_SHARE).select("element").toArrow().column(0)
    return np.sort(found.to_numpy().astype(np.int64).view(np.uint64))


PACKED = "bucket int, kind int, packed binary"
_PACKED = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("packed", pa.binary())])
_ELEMENTS, _HITS, _SIZES = 0, 1, 2


def packed_by(bucket: np.ndarray, kind: int, *columns: np.ndarray) -> pa.RecordBatch:
    """64-bit columns as one row for each bucket, so that a shuffle moves few rows."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    parts = np.split(order, cuts) if len(order) else []
    whole = np.stack([c.view(np.int64) for c in columns])
    return common.batch(_PACKED, [int(bucket[p[0]]) for p in parts], [kind] * len(parts), [whole[:, p].tobytes() for p in parts])


def unpacked(rows: list[bytes], width: int) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, np.int64).reshape(width, -1) for x in rows], axis=1) if rows else np.zeros((width, 0), np.int64)


def bucket_of(x: np.ndarray, buckets: int) -> np.ndarray:
    return (common.mixed(x.view(np.uint64)) >> np.uint64(32)).astype(np.int64) * buckets >> 32


def region_elements(docs: DataFrame, hot: np.ndarray, buckets: int) -> DataFrame:
    """(element, class) of all regions, packed by element; of hot elements, as hits, by class."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, elements, classes, held = set(), [], [], 0

        def sent() -> Iterator[pa.RecordBatch]:
            e, c = np.concatenate(elements), np.concatenate(classes)
            known = np.isin(e, shared.value)
            yield packed_by(bucket_of(e[~known], buckets), _ELEMENTS, e[~known], c[~known])
            if known.any():
                yield packed_by(bucket_of(c[known], buckets), _HITS, c[known], e[known], np.full(known.sum(), _HOT))

        for table in common.sliced(batches):
            for text in table.column("text").to_pylist():
                s = shingles(text)
                if not len(s):
                    continue
                c = class_of(digest(s))
                if c in seen:  # a copy in the same task
                    continue
                seen.add(c)
                own = s[: region_size(len(s))]
                elements.append(own)
                classes.append(np.full(len(own), c, np.int64))
                held += len(own)
                if held >= HELD:
                    yield from sent()
                    seen, elements, classes, held = set(), [], [], 0
        if held:
            yield from sent()

    return docs.select("text").mapInArrow(build, PACKED)


def counted(packed: DataFrame, buckets: int) -> DataFrame:
    """Hits (class, element, classes with it) for elements of several classes, by class. Hot
    hits pass through."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for table in common.sliced(batches):
            known = np.array(table.column("kind")) == _HITS
            rows += table.filter(pa.array(~known)).column("packed").to_pylist()
            yield table.filter(pa.array(known))
        e, c = unpacked(rows, 2)
        del rows
        order = np.lexsort((c, e))
        e, c = e[order], c[order]
        new = np.ones(len(e), bool)
        new[1:] = (e[1:] != e[:-1]) | (c[1:] != c[:-1])
        e, c = e[new], c[new]
        if not len(e):
            return
        first = np.flatnonzero(np.concatenate(([True], e[1:] != e[:-1])))
        n = np.diff(np.append(first, len(e)))
        many = np.repeat(n, n)
        keep = many > 1
        yield packed_by(bucket_of(c[keep], buckets), _HITS, c[keep], e[keep], many[keep])

    parts = common.shuffle_parts(packed.sparkSession)
    return packed.repartition(parts, "bucket").mapInArrow(count, PACKED)


def tiles(hits: DataFrame, buckets: int) -> DataFrame:
    """tile, class, n, native: the classes that may have a partner, by their rarest shared
    elements and size band. A class is native in its own band's tile and a guest in the next
    larger one's. hits also has rows of kind _SIZES: (class, n)."""
    schema = pa.schema([("tile", pa.int64()), ("class", pa.int64()), ("n", pa.int64()), ("native", pa.bool_()), ("rank", pa.int64())])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit_rows, size_rows = [], []
        for table in common.sliced(batches):
            for kind, x in zip(*common.batches_of(table, "kind", "packed"), strict=True):
                (hit_rows if kind == _HITS else size_rows).append(x)
        c, e, many = unpacked(hit_rows, 3)
        known, n = unpacked(size_rows, 2)
        del hit_rows, size_rows
        if not len(c):
            return
        order = np.lexsort((e, many, c))
        c, e, many = c[order], e[order], many[order]
        new = np.ones(len(c), bool)
        new[1:] = (c[1:] != c[:-1]) | (e[1:] != e[:-1])
        c, e = c[new], e[new]
        own, first, found = np.unique(c, return_index=True, return_counts=True)
        by = np.argsort(known)
        size = n[by][np.searchsorted(known[by], own)]
        region = region_size(size)
        # a partner has 0.8 of the elements at least, so this much is shared inside the regions
        shared = spare(least_common(size))
        chosen = np.minimum(found, region - shared + 1 - (region - found))
        pick = np.arange(len(c)) - np.repeat(first, found) < np.repeat(chosen, found)
        c, e, m = c[pick], e[pick], np.repeat(size, found)[pick]
        band = np.searchsorted(EDGES, m, "right")
        rank = np.repeat(chosen * 1000 // np.maximum(region, 1), found)[pick]
        for native in (True, False):
            tile = common.mixed(e.view(np.uint64) + (band + (not native)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
            yield common.batch(schema, tile, c, m, np.full(len(c), native), rank)

    parts = common.shuffle_parts(hits.sparkSession)
    return hits.repartition(parts, "bucket").mapInArrow(choose, "tile long, class long, n long, native boolean, rank long")


def sizes_packed(classes: DataFrame, buckets: int) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.sliced(batches):
            c, n = (table.column(x).to_numpy() for x in ("class", "n"))
            if len(c):
                yield packed_by(bucket_of(c, buckets), _SIZES, c, n)

    return classes.select("class", "n").mapInArrow(build, PACKED)


def bitmap(s: np.ndarray) -> bytes:
    """Parities of the elements hashed to each bit; more bits than four times |s|, a
    power of two. A bitmap of half the size is this one's halves, exclusive-or."""
    bits = max(64, 4 << int(len(s)).bit_length())
    parity = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: bytes, width: int) -> np.ndarray:
    """A bitmap at a smaller size of width bytes."""
    x = np.frombuffer(bits, np.uint64)
    while len(x) * 8 > width:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def bits_apart(a: bytes, b: bytes) -> int:
    """Bits in which two bitmaps differ, at the smaller one's size: at most |A - B| + |B - A|."""
    width = min(len(a), len(b))
    return int(np.bitwise_count(folded(a, width) ^ folded(b, width)).sum())


def similar(a: bytes, b: bytes, bits_a: bytes, bits_b: bytes) -> bool:
    na, nb = len(a) // 8, len(b) // 8
    if 9 * bits_apart(bits_a, bits_b) > na + nb:
        return False
    common_n = len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True))
    return 100 * common_n >= 80 * (na + nb - common_n)


def sets_with_bits(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """class, elements and bits of the classes whose representatives are given."""
    schema = pa.schema([("class", pa.int64()), ("elements", pa.binary()), ("bits", pa.binary())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.sliced(batches):
            own = [shingles(t) for t in table.column("text").to_pylist()]
            if own:
                yield common.batch(schema, [class_of(digest(s)) for s in own], [s.tobytes() for s in own], [bitmap(s) for s in own])

    small = reps.count() <= BROADCAST_ROWS
    sent = lambda x: F.broadcast(x) if small else x
    # a representative's doc_id may be null, or on other rows, too: what they have beside is left out by class
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    own = own.join(sent(reps.select("rep").distinct()), F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
    found = own.mapInArrow(build, "class long, elements binary, bits binary")
    return found.join(sent(reps.select("class")), "class", "left_semi").dropDuplicates(["class"])


def links_among(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that are similar."""
    side = lambda x: sets.select(F.col("class").alias(x), F.col("elements").alias(f"elements_{x}"), F.col("bits").alias(f"bits_{x}"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.sliced(batches):
            rows = zip(*common.batches_of(table, "a", "b", "elements_a", "elements_b", "bits_a", "bits_b"), strict=True)
            found = [(a, b) for a, b, x, y, p, q in rows if similar(x, y, p, q)]
            if found:
                yield common.batch(schema, *map(list, zip(*found, strict=True)))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.mapInArrow(compare, "a long, b long")


def labelled(tile_rows: DataFrame, links: DataFrame | None) -> DataFrame:
    """tile_rows with label: the component so far."""
    if links is None:
        return tile_rows.withColumn("label", F.col("class"))
    own = components(links).select(F.col("vertex").alias("class"), "component")
    return tile_rows.join(own, "class", "left").withColumn("label", F.coalesce("component", "class")).drop("component")


def near(a: str, b: str):
    """Sizes that similar sets may have."""
    return (5 * F.col(a) >= 4 * F.col(b)) & (5 * F.col(b) >= 4 * F.col(a))


def led_pairs(rows: DataFrame, seed: int) -> DataFrame:
    """A pair for each class: with one native class of its tiles, in another component. Of two
    copies of one text, the one that was changed less shares more with the others, so a tile is
    led by the class with the most tiles."""
    order = F.struct(-F.col("rank"), F.xxhash64("class", F.lit(seed)))
    leaders = rows.where("native").groupBy("tile").agg(F.min(F.struct(order.alias("k"), F.col("class").alias("other"),
        F.col("n").alias("m"), F.col("label").alias("theirs"))).alias("l")).select("tile", "l.*")
    both = rows.join(leaders, "tile").where((F.col("label") != F.col("theirs")) & near("n", "m"))
    return both.groupBy("class").agg(F.min(F.struct("k", "other")).alias("l")).select(F.greatest("class", "l.other").alias("a"),
        F.least("class", "l.other").alias("b")).distinct()


def open_pairs(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs of a tile that are in different components, of sizes that allow it, one of them
    native, and whose bitmaps don't rule it out. In a tile, only classes outside its commonest
    component are held against all, as rows of a matrix; no pair leaves the task unless the
    bits let it. Bitmaps are only sent for tiles of several components.

    A tile of more than TILE_ROWS classes is dealt out: its classes fall into blocks, and every two
    blocks (and each with itself) meet in a task of their own, so no task has more than about
    twice TILE_ROWS classes of a tile, however many the tile has."""
    counts = rows.groupBy("tile", "label").agg(F.count("*").alias("k"))
    most = counts.groupBy("tile").agg(F.max(F.struct("k", "label")).alias("top"), F.count("*").alias("labels"), F.sum("k").alias("classes")).where("labels > 1")
    most = most.select("tile", F.col("top.label").alias("main"), F.ceil(F.col("classes") / TILE_ROWS).cast("int").alias("blocks"))
    own = rows.join(most, "tile").withColumn("block", F.pmod(F.xxhash64("class", F.lit(3)), F.col("blocks")).cast("int"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    first, second = F.least("block", "other"), F.greatest("block", "other")
    meeting = F.when(F.col("blocks") == 1, F.col("tile")).otherwise(F.xxhash64("tile", first, second))
    own = own.select(meeting.alias("tile"), "class", "n", "label", "main", "native",
        F.when(first == second, F.lit(-1)).otherwise((F.col("block") == first).cast("int")).alias("side"))
    mixed = own.join(sets.select("class", "bits"), "class").select("tile", "class", "n", "label", "main", "native", "side", "bits")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [pa.Table.from_batches([t]) for t in common.sliced(batches, 100_000) if t.num_rows]
        if not tables:
            return
        table = pa.concat_tables(tables)
        tile, names, n, label, main, side = (table.column(c).to_numpy() for c in ("tile", "class", "n", "label", "main", "side"))
        native, bits = np.array(table.column("native").to_pylist(), bool), table.column("bits").to_pylist()
        order = np.argsort(tile, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], np.diff(tile[order]) != 0)))
        size = np.diff(np.append(first, len(order)))
        own_names, row_of, number = np.unique(names, return_index=True, return_inverse=True)
        codes = [np.zeros(0, np.int64)]  # pairs as number * classes + lesser number

        def fits(i: np.ndarray, k: np.ndarray) -> np.ndarray:
            meet = (side[i] < 0) | (side[i] != side[k])
            return meet & (label[i] != label[k]) & (5 * n[i] >= 4 * n[k]) & (5 * n[k] >= 4 * n[i]) & (native[i] | native[k])

        def add(i: np.ndarray, k: np.ndarray) -> None:
            x, y = number[i], number[k]
            codes.append(np.unique(np.maximum(x, y) * len(own_names) + np.minimum(x, y)))

        for k in np.unique(size[size <= SMALL_TILE]):  # all tiles of one size at once
            i, j = np.triu_indices(k, 1)
            starts = first[size == k]
            for part in np.array_split(starts, max(1, len(starts) * len(i) // 2_000_000)):
                rows_of = order[part[:, None] + np.arange(k)]
                x, y = rows_of[:, i].ravel(), rows_of[:, j].ravel()
                good = fits(x, y)
                add(x[good], y[good])
        pairs = zip(*np.divmod(np.unique(np.concatenate(codes)), max(1, len(own_names))), strict=True)
        found = [(x, y) for x, y in pairs if 9 * bits_apart(bits[row_of[x]], bits[row_of[y]]) <= n[row_of[x]] + n[row_of[y]]]
        codes = [np.array([x * len(own_names) + y for x, y in found], np.int64)]
        for at, k in zip(first[size > SMALL_TILE], size[size > SMALL_TILE], strict=True):
            own = order[at : at + k]
            width = min(len(bits[r]) for r in own)
            maps = np.stack([folded(bits[r], width) for r in own])
            for part in np.unique(side[own]):  # one side's open classes against the other side
                few = np.flatnonzero((label[own] != main[own]) & (side[own] == part))
                all_ = np.flatnonzero((side[own] != part) | (part < 0))
                for block in np.array_split(few, max(1, len(few) // 256)):
                    apart = np.zeros((len(block), len(all_)), np.int64)
                    for word in range(maps.shape[1]):
                        apart += np.bitwise_count(maps[block, word][:, None] ^ maps[all_, word][None, :])
                    x, y = np.nonzero(9 * apart <= n[own][block][:, None] + n[own][all_][None, :])
                    x, y = own[block[x]], own[all_[y]]
                    good = fits(x, y)
                    add(x[good], y[good])
        x, y = np.divmod(np.unique(np.concatenate(codes)), max(1, len(own_names)))
        if len(x):
            yield common.batch(schema, np.maximum(own_names[x], own_names[y]), np.minimum(own_names[x], own_names[y]))

    parts = common.shuffle_parts(rows.sparkSession)
    return mixed.repartition(parts, "tile").mapInArrow(compare, "a long, b long").distinct()


def labelled_rows(docs: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, keys, n and component of every row: a number that the rows of a group share, null
    for empty sets. docs: doc_id, text and keys (columns of longs). Saved; what led there isn't."""
    spark = docs.sparkSession
    buckets = 4 * common.shuffle_parts(spark)
    sets = common.saved(sets_of(docs, keys), "sets")
    rows = sets.where("n >= 0").select("doc_id", *keys, "n", F.expr("if(n > 0, class, null)").alias("class"))
    classes = common.saved(rows.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"),
        F.count("*").alias("rows")), "classes")
    hits = counted(region_elements(docs, hot_elements(sets), buckets), buckets)
    every = common.saved(tiles(hits.unionByName(sizes_packed(classes, buckets)), buckets), "tiles")
    shared = every.groupBy("tile").agg(F.count("*").alias("k"), F.count_if("native").alias("h")).where("k > 1 and h > 0").select("tile")
    tile_rows = common.saved(every.join(shared, "tile", "left_semi"), "tiles")
    common.forget(every)
    reps = common.saved(classes.join(tile_rows.select("class").distinct(), "class", "left_semi").select("class", "rep"), "reps")
    own_sets = common.saved(sets_with_bits(docs, reps), "elements")
    links, steps = None, []
    for k in range(STAR_ROUNDS + 1):
        now = labelled(tile_rows, links)
        if k == STAR_ROUNDS:
            now = common.saved(now, "labelled")
            steps.append(now)
        pairs = common.saved(led_pairs(now, k) if k < STAR_ROUNDS else open_pairs(now, own_sets), "pairs")
        more = common.saved(links_among(pairs, own_sets), "similar")
        steps += [pairs, more]
        links = more if links is None else links.unionByName(more)
    named = components(links).select(F.col("vertex").alias("class"), "component")
    groups = common.saved(classes.join(named, "class", "left").select("class", "rows", F.coalesce("component", "class").alias("component")), "groups")
    found = common.saved(with_group(rows, groups, "component", "class").select("doc_id", *keys, "n", "component"), "joined")
    common.forget(sets, classes, tile_rows, reps, own_sets, groups, *steps)
    return found


def with_group(rows: DataFrame, groups: DataFrame, value: str, key: str = "component") -> DataFrame:
    """rows with the value of their group; null for rows in none. groups: key, rows (its size) and
    value. A group with a HOT_GROUP-th of all rows would be one task's: of these there are at
    most HOT_GROUP, which are sent to where their rows are. Rows in no group aren't moved either."""
    hot = F.broadcast(groups.where(F.col("rows") * HOT_GROUP >= rows.count()).select(key, value))
    own = rows.where(F.col(key).isNotNull())
    cold = own.join(hot.select(key), key, "left_anti").join(groups.select(key, value), key, "left")
    alone = rows.where(F.col(key).isNull()).withColumn(value, F.lit(None).cast(groups.schema[value].dataType))
    return own.join(hot, key).unionByName(cold).unionByName(alone)


def joined(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document. docs: doc_id, text."""
    rows = labelled_rows(docs)
    groups = rows.where("component is not null").groupBy("component").agg(F.count("*").alias("rows"), F.min("doc_id").alias("least"))
    out = with_group(rows, common.saved(groups, "groups"), "least")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(common.documents(spark, sf_dir))


#: Names for columns beside a caller's: two hashes of the text, which tell rows apart that share a doc_id.
_KEYS = ("__ledgerline_text", "__ledgerline_again")


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, but of each group of linked rows only one: the
    first by doc_id (null last), then by hash of the text. Rows with empty sets all stay."""
    own = docs.withColumn(_KEYS[0], F.xxhash64("text")).withColumn(_KEYS[1], F.xxhash64(F.lit(7), F.col("text")))
    rows = labelled_rows(own, _KEYS).where("n > 0")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), *(F.col(k) for k in _KEYS))
    groups = common.saved(rows.groupBy("component").agg(F.min(order).alias("stays"), F.count("*").alias("rows")).where("rows > 1"), "groups")
    both = with_group(rows, groups, "stays").where(F.col("stays").isNotNull()).withColumn("goes", order != F.col("stays"))
    names = {"doc_id": "__ledgerline_doc", _KEYS[0]: "__ledgerline_k", _KEYS[1]: "__ledgerline_l"}
    by_name = lambda df: df.select(*(F.col(a).alias(b) for a, b in names.items())).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__ledgerline_doc"))
    for a, b in list(names.items())[1:]:
        same = same & (F.col(a) == F.col(b))  # never null: the hash of a null text is its seed's
    kept = own.join(by_name(both.where("goes")), same, "left_anti")
    again = both.where("not goes").groupBy("doc_id", *_KEYS).agg(F.count("*").alias("n")).where("n > 1")
    again = common.saved(by_name(again), "equal-rows")
    if again.head(1):  # rows equal to the one that stays: summed before the shuffle, as they may be many
        firsts = kept.join(again, same, "left_semi").dropDuplicates(["doc_id", *_KEYS])
        kept = kept.join(again, same, "left_anti").unionByName(firsts)
    return kept.select(*docs.columns)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: that with the smallest doc_id."""
    return without_copies(docs)
