"""Who is who across two id schemes: overrides, display names, near duplicates, entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as X


def with_overrides(df: DataFrame, overrides: DataFrame, name: str, ident: str, key: str) -> DataFrame:
    """key and override_display, from the override whose text is the row's name or, failing
    that, its id. overrides: probe (lower case, trimmed), to_key, to_display; a hand-kept file,
    whose size Spark checks before it broadcasts it."""
    probe = lambda c: F.lower(F.trim(F.col(c)))
    one = overrides.groupBy("probe").agg(F.max_by("to_key", "line").alias("to_key"), F.max_by("to_display", "line").alias("to_display"))
    side = lambda n: one.select(F.col("probe").alias(f"_p{n}"), F.col("to_key").alias(f"_k{n}"), F.col("to_display").alias(f"_d{n}"))
    both = df.join(side(1), probe(name) == F.col("_p1"), "left").join(side(2), probe(ident) == F.col("_p2"), "left")
    shown = F.when(F.col("_p1").isNotNull(), F.col("_d1")).otherwise(F.col("_d2"))
    return both.withColumn(key, F.coalesce("_k1", "_k2", key)).withColumn("override_display", F.nullif(shown, F.lit(""))).drop("_p1", "_k1",
        "_d1", "_p2", "_k2", "_d2")


def display_names(rows: DataFrame, key: str, name: str) -> DataFrame:
    """key, display: the override's name, else the commonest; ties to the longest, then the
    first in the alphabet. rows may have override_display."""
    counts = rows.groupBy(key, name).agg(F.count("*").alias("_n"))
    order = Window.partitionBy(key).orderBy(F.desc("_n"), F.desc(F.length(name)), name)
    common = counts.withColumn("_r", F.row_number().over(order)).where("_r = 1").select(key, F.col(name).alias("_common"))
    if "override_display" not in rows.columns:
        return common.withColumnRenamed("_common", "display")
    forced = rows.groupBy(key).agg(F.max("override_display").alias("_forced"))
    return common.join(forced, key).select(key, F.coalesce("_forced", "_common").alias("display"))


def aliases(rows: DataFrame, key: str = "ref_key") -> DataFrame:
    """key, raw_ids, raw_names, eras: what each canonical person appears as."""
    sets = [F.array_sort(F.collect_set(c)).alias(n) for c, n in (("official_id", "raw_ids"), ("official_name", "raw_names"), ("era", "eras"))]
    return rows.groupBy(key).agg(*sets)


def _shortened(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each key k without one letter (s, g) and without two (s, g, h): what is left, and how many
    letters of it come before each gap. A key's rows follow one another, none is an array."""
    one = own.withColumn("i", F.explode(F.sequence(F.lit(1), F.length("k"))))
    two = one.where(F.col("i") < F.length("k")).withColumn("j", F.explode(F.sequence(F.col("i") + 1, F.length("k"))))
    return (one.select("k", F.expr("concat(left(k, i - 1), substring(k, i + 1))").alias("s"), (F.col("i") - 1).alias("g")),
        two.select("k", F.expr("concat(left(k, i - 1), substring(k, i + 1, j - i - 1), substring(k, j + 1))").alias("s"), (F.col("i") - 1).alias("g"),
        (F.col("j") - 2).alias("h")))


def within_two_edits(keys: DataFrame) -> DataFrame:
    """Pairs a < b of different keys (column k) at most two edits apart, by a deletion index.

    An edit takes a letter from one of the keys or, as a replacement, one from both at the same gap
    of what they have in common. So two keys are that near just if what is left of them is the same
    and they lose 0 and 1 or 0 and 2 letters, one each, one and two with a gap in common, or two each
    at the same gaps. Keys meet on the hash of exactly that and on nothing shorter: whoever meets is a
    true pair, whatever the names have in common. A key of n letters gives about 2 n^2 rows; Spark
    takes them for as few as the keys and would send them all through the driver, so it is told to
    sort and merge them."""
    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = keys.select("k").distinct().repartition(tasks)  # so many tasks, however small the keys are
    one, two = _shortened(own.where("k <> ''"))

    def signed(df: DataFrame, tag: int, *by) -> DataFrame:
        return df.select("k", F.xxhash64(F.lit(tag), *by).alias("t"))

    left = signed(own, 0, "k").unionByName(signed(one, 1, "s")).unionByName(signed(one, 2, "s", "g")).unionByName(signed(two, 3, "s", "g", "h"))
    right = signed(one, 0, "s").unionByName(signed(two, 0, "s")).unionByName(signed(one, 1, "s")).unionByName(signed(two, 2, "s", "g"))
    right = right.unionByName(signed(two, 2, "s", F.col("h").alias("g"))).unionByName(signed(two, 3, "s", "g", "h"))
    met = left.withColumnRenamed("k", "a").join(right.withColumnRenamed("k", "b").hint("merge"), "t").where("a <> b")
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs.where(F.levenshtein("a", "b", 2) >= 0)  # hashes may meet by chance


def near_duplicates(keys: DataFrame, key: str = "ref_key") -> DataFrame:
    """a, b (a < b) and reason, for a person to judge: equal but for initials, else at most two
    edits apart. Both are equi-joins whose groups hold true pairs only."""
    own = keys.select(F.col(key).alias("k")).where("k IS NOT NULL").distinct()
    plain = own.withColumn("p", X.without_initials("k")).where("p <> ''")
    same = plain.alias("x").join(plain.alias("y"),
        (F.col("x.p") == F.col("y.p")) & (F.col("x.k") < F.col("y.k"))).select(F.col("x.k").alias("a"), F.col("y.k").alias("b"),
        F.lit("same-after-dropping-initials").alias("reason"))
    both = same.unionByName(within_two_edits(own).withColumn("reason", F.lit("edit-distance<=2")))
    return both.groupBy("a", "b").agg(F.max("reason").alias("reason"))


def segments(logs: DataFrame, games: DataFrame) -> DataFrame:
    """One row for each player id in each scheme: seg_id, era, player_id, display, name_key,
    smin, smax, seasons, teams, games."""
    rows = logs.join(games.select("game_id", "season", "era"), "game_id").withColumn("seg_id", F.concat_ws(":", "era", "player_id"))
    named = display_names(rows, "seg_id", "player_name")
    start = X.season_start("season")
    per = rows.groupBy("seg_id", "era", "player_id").agg(
        F.min(start).alias("smin"), F.max(start).alias("smax"), F.array_sort(F.collect_set("season")).alias("seasons"),
        F.array_sort(F.collect_set("team_abbr")).alias("teams"), F.countDistinct("game_id").alias("games"),
    )
    return per.join(named, "seg_id").withColumn("name_key", X.name_key("display", keep_suffixes=True))


def adjacent(segs: DataFrame) -> DataFrame:
    """Pairs a < b of one key and different schemes whose seasons overlap or nearly meet."""
    own = segs.select("name_key", "seg_id", "era", "smin", "smax")
    x, y = own.alias("x"), own.alias("y")
    meet = F.when(F.col("x.smin") <= F.col("y.smin"), F.col("y.smin") <= F.col("x.smax") + 2).otherwise(F.col("x.smin") <= F.col("y.smax") + 2)
    return x.join(y, (F.col("x.name_key") == F.col("y.name_key")) & (F.col("x.seg_id") < F.col("y.seg_id"))
        & (F.col("x.era") != F.col("y.era")) & meet).select(F.col("x.seg_id").alias("a"), F.col("y.seg_id").alias("b"))


def entity_of(segs: DataFrame) -> DataFrame:
    """seg_id, component: the least segment that it is joined with, directly or through others.

    A segment joins all segments of one key and other schemes that begin up to two years after it
    ends, or have not ended two years before it begins. While one is open, whatever else begins
    joins it or is of its own scheme, and a segment without any of another scheme near is alone. So
    entities of more than one segment follow each other in time: sorted by first season, a new one
    begins where no earlier segment reaches. For that it is enough to know of each key and scheme
    in which years segments begin and the last year that those end; a window only sees a key's
    years, however many segments the key has. A segment without key or season is alone."""
    own = segs.select("name_key", "seg_id", "era", "smin", "smax")
    starts = own.groupBy("name_key", "era", "smin").agg(F.max("smax").alias("end"))
    starts = starts.groupBy("name_key").agg(F.collect_list(F.struct("era", F.col("smin").alias("year"), "end")).alias("starts"))
    others = F.filter("starts", lambda t: t["era"] != F.col("era"))
    after = F.filter(others, lambda t: t["year"].between(F.col("smin"), F.col("smax") + 2))
    before = F.exists(others, lambda t: (t["year"] <= F.col("smin")) & (t["end"] + 2 >= F.col("smin")))
    seen = own.join(starts, "name_key", "left").select("name_key", "seg_id", "smin",
        F.array_max(F.transform(after, lambda t: t["year"])).alias("reach"), F.coalesce(before, F.lit(False)).alias("met"))
    joined = F.col("reach").isNotNull() | F.col("met")
    years = seen.where(joined).groupBy("name_key", "smin").agg(F.max(F.coalesce("reach", "smin")).alias("reach"), F.min("seg_id").alias("least"))
    in_order = Window.partitionBy("name_key").orderBy("smin")
    earlier = F.max("reach").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    islands = years.withColumn("new", F.when(earlier >= F.col("smin"), 0).otherwise(1)).withColumn("island", F.sum("new").over(in_order))
    named = islands.select("name_key", "smin", F.min("least").over(Window.partitionBy("name_key", "island")).alias("least"))
    return seen.join(named, ["name_key", "smin"], "left").select("seg_id", F.when(joined, F.col("least")).otherwise(F.col("seg_id")).alias("component"))


def entities(segs: DataFrame) -> DataFrame:
    """component, key, display, slug, seg_ids, eras, seasons, teams, smin. The slug is the key,
    with -2, -3 and so on for later ones by first season, name and least segment."""
    rows = segs.join(entity_of(segs), "seg_id")
    best = F.max_by("display", F.struct("games", F.struct(-F.length("display"), "display")))
    forced = F.max("override_display") if "override_display" in segs.columns else F.lit(None).cast("string")
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    per = rows.groupBy("component").agg(
        F.min("name_key").alias("key"), F.coalesce(forced, best).alias("display"), F.array_sort(F.collect_set("seg_id")).alias("seg_ids"),
        F.array_sort(F.collect_set("era")).alias("eras"), flat("seasons").alias("seasons"), flat("teams").alias("teams"), F.min("smin").alias("smin"),
    )
    n = F.row_number().over(Window.partitionBy("key").orderBy("smin", "display", "component"))
    return per.withColumn("_n", n).withColumn("slug",
        F.when(F.col("_n") == 1, F.col("key")).otherwise(F.concat_ws("-", "key", F.col("_n").cast("string")))).drop("_n")


def merge_audit(segs: DataFrame, ents: DataFrame) -> DataFrame:
    """One row of counts: segments, entities, merges over schemes, keys left split, slug clashes."""
    per_key = ents.groupBy("key").agg(F.count("*").alias("n"))
    a = ents.agg(F.count("*").alias("entities"), F.count_if(F.size("eras") > 1).alias("cross_era_merges"))
    b = per_key.agg(F.count_if(F.col("n") > 1).alias("split_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("slug_collisions"))
    return segs.agg(F.count("*").alias("segments")).crossJoin(a).crossJoin(b)


def era_spans(alias_rows: DataFrame) -> DataFrame:
    """One row: how many people span both schemes, and how many are in one."""
    return alias_rows.agg(F.count_if(F.size("eras") == 2).alias("both_eras"), F.count_if(F.size("eras") == 1).alias("one_era"))
