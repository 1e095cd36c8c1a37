"""The feed day by day: offsets, one rate over all tasks, failures."""

import http.server
import json
import threading
import time
from collections import Counter

import pytest

from ledgerline.sources import feed, tables
from ledgerline.streaming import ingest

from test_sources import EVENT


@pytest.fixture
def served():
    """An address whose scoreboards hold one game a day; what was asked for, and when."""
    asked, failing = [], set()

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append((self.path, time.monotonic()))
            if self.path in failing:
                self.send_error(503)
                return
            kind, day = self.path.strip("/").split("-")
            event = json.loads(json.dumps(EVENT)) | {"id": kind + day, "date": f"{day[:4]}-{day[4:6]}-{day[6:]}T18:00Z"}
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps({"events": [event]}).encode())

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", asked, failing
    server.shutdown()


def walk(spark, tmp_path, url, types, today, **options):
    stream = ingest.days(spark, url + "/{type}-{day}", types, "2001-09-29", today=today, delay="0.01", **options)
    q = ingest.run(stream, ingest.merge_games(str(tmp_path / "games")), str(tmp_path / "check"))
    q.awaitTermination(120)
    assert q.exception() is None


def test_a_walk_goes_on_at_its_offset(spark, tmp_path, served):
    url, asked, _ = served
    walk(spark, tmp_path, url, ["2"], "2001-10-02")
    assert Counter(p for p, _ in asked) == Counter(f"/2-{d}" for d in ("20010929", "20010930", "20011001"))
    walk(spark, tmp_path, url, ["2"], "2001-10-04")
    assert sorted(p for p, _ in asked[3:]) == ["/2-20011002", "/2-20011003"]
    # a further type begins at the first day
    walk(spark, tmp_path, url, ["2", "4"], "2001-10-04")
    assert sorted(p for p, _ in asked[5:]) == [f"/4-{d}" for d in ("20010929", "20010930", "20011001", "20011002", "20011003")]
    games = {(r["game_id"], r["season"]) for r in tables.stored(spark, str(tmp_path / "games")).collect()}
    want = {(f"{t}{d}", s) for t in "24" for d, s in (("20010929", "2000-01"), ("20010930", "2000-01"), ("20011001", "2001-02"), ("20011002", "2001-02"), ("20011003", "2001-02"))}
    assert games == want


def test_all_tasks_share_one_rate(spark, served):
    url, asked, _ = served
    feed.register(spark)
    urls = [f"{url}/2-2001{k:04}" for k in range(1010, 1034)]
    read = spark.read.format("feed").options(urls=json.dumps(urls), delay="0.1", lanes="4")
    assert sum(r["json"] is not None for r in read.load().collect()) == 24
    times = sorted(t for _, t in asked)
    assert len(times) == 24
    # in no second more than ten requests, but for what tasks that start late make up
    assert max(sum(a <= t < a + 1 for t in times) for a in times) <= 10 + 4
    assert times[-1] - times[0] >= 24 * 0.1 - 0.5


def test_a_failure_is_a_null_answer(spark, served):
    url, asked, failing = served
    failing.add("/2-20011002")
    feed.register(spark)
    urls = [f"{url}/2-20011001", f"{url}/2-20011002"]
    got = {r["url"]: r["json"] for r in spark.read.format("feed").options(urls=json.dumps(urls), delay="0.01", retries="3", wait="0.01").load().collect()}
    assert got[urls[0]] and got[urls[1]] is None and sum(p == "/2-20011002" for p, _ in asked) == 3


def test_days_that_are_not_finished_are_not_asked_for():
    options = {"url": "{type}-{day}", "types": "2,4", "first": "2020-01-30", "last": "2020-02-02", "delay": "0"}
    reader = feed.DaysReader(options | {"today": "2020-01-01"})
    assert reader.latestOffset() == reader.initialOffset() and reader.partitions(reader.initialOffset(), reader.latestOffset()) == []
    reader = feed.DaysReader(options | {"today": "2021-01-01"})
    found = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert [p.urls[0][0] for p in found][:2] == ["2-20200130", "4-20200130"] and len(found) == 8


def test_lanes_hold_every_url_once():
    urls = [(str(k),) for k in range(10)]
    found = feed.lanes(urls, 0.5, 4)
    assert sorted(u for lane in found for u in lane.urls) == sorted(urls) and {lane.pace for lane in found} == {2.0}
    assert feed.lanes([], 0.5, 4) == []
