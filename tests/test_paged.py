"""The paged source against servers of our own: one budget for all slices, and streams that go on where they broke off."""

import heapq
import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from tallyfold.sources import budget, paged


def most_in_a_second(starts):
    return max(sum(s <= t < s + 1 for t in starts) for s in starts)


@pytest.mark.parametrize("n", [1, 4, 16])
@pytest.mark.parametrize("shared", [True, False])
def test_slices_keep_to_one_budget(n, shared):
    """A clock of our own; each slice asks for a page of 100 items as soon as it may, and an answer takes 0.07 seconds."""
    one = budget.Bucket()
    buckets = [one if shared else budget.Bucket(budget.PAUSE * n) for _ in range(n)]
    queue, starts = [(0.01 * k, k) for k in range(n)], []
    while len(starts) < 200:
        now, k = heapq.heappop(queue)
        wait = buckets[k].turn(now)
        if wait > 0:
            heapq.heappush(queue, (now + wait, k))
            continue
        starts.append(now)
        heapq.heappush(queue, (now + 0.07, k))
    assert 100 * most_in_a_second(starts) <= 200 if shared else len(starts) * 100 / (starts[-1] - starts[0] + n * 0.5) <= 200
    if shared:
        assert 100 * 199 / (starts[-1] - starts[0]) > 195


def test_a_hold_holds_all():
    b = budget.Bucket(0.5)
    assert b.turn(10.0) == 0 and b.turn(10.2) == pytest.approx(0.3)
    b.hold(70.0)
    assert b.turn(11.0) == pytest.approx(59.0) and b.turn(70.0) == 0


def test_own_gate_waits_for_the_reset():
    now, slept = [100.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    gate = budget.OwnGate(sleep=sleep, clock=lambda: now[0])
    gate.enter()
    gate.seen({"X-RateLimit-Remaining": "3", "X-RateLimit-Reset": "130"})
    gate.enter()
    gate.seen({})
    gate.enter()
    assert slept == pytest.approx([31.0, 0.5])


def test_tasks_ask_the_driver():
    starts, lock = [], threading.Lock()

    def task(address):
        gate = budget.SharedGate(address)
        for _ in range(6):
            gate.enter()
            with lock:
                starts.append(time.monotonic())
            gate.seen({})

    with budget.Budget(pause=0.03) as b:
        threads = [threading.Thread(target=task, args=(b.address,)) for _ in range(5)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        gate = budget.SharedGate(b.address, clock=lambda: 0.0)
        gate.seen({"x-ratelimit-remaining": "0", "x-ratelimit-reset": "99"})
        assert gate._ask("turn") > 90
    starts.sort()
    # thirty turns take twenty-nine pauses at least; stamps come a little after the turns
    assert len(starts) == 30 and starts[-1] - starts[0] > 29 * 0.03 - 0.02


class Service:
    """Items by second, in pages; from page ``broken`` on it answers no more."""

    def __init__(self, n, per_second):
        self.items = [{"id": f"i{k}", "body": f"b{k}", "created_utc": 1000 + k // per_second, "score": k, "subreddit": "s"} for k in range(n)]
        self.asked, self.broken = [], None
        service = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
                service.asked.append((q["subreddit"], int(q["after"]), int(q["before"])))
                if service.broken is not None and len(service.asked) > service.broken:
                    self.send_error(503)
                    return
                found = [x for x in service.items if int(q["after"]) < x["created_utc"] < int(q["before"])][: int(q["limit"])]
                body = json.dumps({"data": found}).encode()
                self.send_response(200)
                self.send_header("Content-Length", str(len(body)))
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *_):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.base = f"http://127.0.0.1:{self.server.server_address[1]}/items"


@pytest.fixture
def service():
    s = Service(1500, 3)
    yield s
    s.server.shutdown()


def test_slices_read_all(spark, service):
    spark.dataSource.register(paged.PagedSource)
    with budget.Budget(pause=0.005) as b:
        options = {"base": service.base, "subreddit": "s", "after": 1000, "before": 1500, "slices": 4, "budget": b.address}
        got = spark.read.format("paged").options(**options).load().select("id", "score").collect()
    assert sorted(r["score"] for r in got) == list(range(1500))
    assert len({a for _, a, _ in service.asked}) >= 16


def test_a_stream_goes_on_where_it_broke_off(spark, service, tmp_path):
    """The service goes away in the third batch of five; then all is started again."""
    out, checkpoints = str(tmp_path / "out"), str(tmp_path / "checkpoints")
    with budget.Budget(pause=0.005) as b:
        options = {"base": service.base, "after": 1000, "before": 1500, "span": 100, "slices": 2, "budget": b.address}
        service.broken = 14
        with pytest.raises(Exception, match="503|STREAM_FAILED|PYTHON"):
            paged.download(spark, options, ["s"], out, checkpoints)
        before = sorted(r["score"] for r in spark.read.parquet(out).collect())
        assert 0 < len(before) < 1500 and before == list(range(len(before)))
        service.broken, broke = None, len(service.asked)
        paged.download(spark, options, ["s"], out, checkpoints)
        asked = service.asked[broke:]
        assert min(after for _, after, _ in asked) >= 1000 + len(before) // 3 - 1
        assert sorted(r["score"] for r in spark.read.parquet(out).where("source = 's'").collect()) == list(range(1500))
        done = len(service.asked)
        paged.download(spark, options, ["s"], out, checkpoints)
        assert len(service.asked) == done and spark.read.parquet(out).count() == 1500
