"""Rows keep their written order over files of unequal sizes, headers and compression."""

import gzip

from ledgerline.operators import crew
from ledgerline.sources import readers


def test_order_over_files(spark, tmp_path):
    heads = [["game_id", "official_id", "official_name", "jersey_num"], ["official_name", "game_id", "official_id"], ["game_id", "official_id", "official_name", "jersey_num"], ["official_id", "game_id"]]
    sizes, want, games = [5, 3000, 1, 40], [], 7
    for k, (head, n) in enumerate(zip(heads, sizes, strict=True)):
        lines = [",".join(head)]
        for _ in range(n):
            row = {"game_id": f"g{len(want) % games}", "official_id": f"o{len(want):06}", "official_name": f"N {len(want)}", "jersey_num": "9"}
            want.append((row["game_id"], row["official_id"]))
            lines.append(",".join(row[c] for c in head))
        text = "\n".join(lines) + "\n"
        if k % 2:
            with gzip.open(tmp_path / f"{k}.csv.gz", "wt") as f:
                f.write(text)
        else:
            (tmp_path / f"{k}.csv").write_text(text)
    got = readers.officials(spark, str(tmp_path)).orderBy("row_order").collect()
    assert [(r["game_id"], r["official_id"]) for r in got] == want and [r["row_order"] for r in got] == list(range(len(want)))
    first = {}
    for game, official in want:
        first.setdefault(game, []).append(official)
    kept = crew.without_alternates(readers.officials(spark, str(tmp_path)))
    assert {(r["game_id"], r["official_id"]) for r in kept.collect()} == {(g, o) for g, own in first.items() for o in own[:3]}


def test_order_over_blocks_of_one_file(spark, tmp_path):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    (tmp_path / "a.csv").write_text("game_id,official_id\n" + "".join(f"g,{k}\n" for k in range(4000)))
    (tmp_path / "b.csv").write_text("official_id,game_id\n" + "".join(f"{k},g\n" for k in range(4000, 4100)))
    try:
        for k, v in (("spark.sql.files.maxPartitionBytes", "3000"), ("spark.sql.files.openCostInBytes", "100")):
            spark.conf.set(k, v)
        got = readers.officials(spark, str(tmp_path))
        assert [int(r["official_id"]) for r in got.orderBy("row_order").collect()] == list(range(4100))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("game_id,official_id\n")
    assert readers.officials(spark, str(tmp_path)).collect() == []
