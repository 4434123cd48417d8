"""The fetch's hard deadline and byte budget. No server: pipes, and HTTP over a socket pair."""

from __future__ import annotations

import os
import socket
import subprocess
import sys
import threading
import time

import pyarrow as pa
import pytest

from feedlens.sources import download
from feedlens.sources.download import ByteBudget, body, fetcher

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def fetched(urls, timeout=30.0, deadline=60.0, threads=4, batch_bytes=1 << 20, budget=1 << 22):
    source = pa.RecordBatch.from_pydict({"feed_id": list(range(len(urls))), "feed_name": ["n"] * len(urls), "url": pa.array(urls, pa.string())})
    return list(fetcher(timeout, deadline, threads, batch_bytes, budget)(iter([source])))


def contents(batches) -> dict:
    return {k: v for b in batches for k, v in zip(b.column(0).to_pylist(), b.column(3).to_pylist(), strict=True)}


def slow_pipe(path: str, stop: threading.Event, every: float = 0.2) -> threading.Thread:
    os.mkfifo(path)

    def write():
        handle = os.open(path, os.O_WRONLY)
        try:
            while not stop.wait(every):
                os.write(handle, b"x")
        except BrokenPipeError:
            pass
        finally:
            os.close(handle)

    thread = threading.Thread(target=write, daemon=True)
    thread.start()
    return thread


def test_trickling_body_ends_at_the_deadline(tmp_path):
    stop = threading.Event()
    slow_pipe(str(tmp_path / "slow"), stop)
    (tmp_path / "good").write_text("ok")
    begun = time.monotonic()
    got = contents(fetched([f"file://{tmp_path}/slow", f"file://{tmp_path}/good"], deadline=1.0))
    stop.set()
    assert time.monotonic() - begun < 2 and got == {0: None, 1: "ok"}


def test_silent_pipe_ends_at_the_deadline(tmp_path):
    os.mkfifo(tmp_path / "silent")  # nobody ever writes
    begun = time.monotonic()
    assert contents(fetched([f"file://{tmp_path}/silent"], deadline=0.5)) == {0: None}
    assert time.monotonic() - begun < 1.5


def test_pipe_that_ends_in_time_is_read_whole(tmp_path):
    os.mkfifo(tmp_path / "pipe")
    threading.Thread(target=lambda: (tmp_path / "pipe").write_text("añb" * 100_000), daemon=True).start()
    assert contents(fetched([f"file://{tmp_path}/pipe"], deadline=20.0)) == {0: "añb" * 100_000}


class Pair(socket.socket):
    def setsockopt(self, *args):  # options of TCP mean nothing to a pair
        pass


@pytest.fixture()
def http(monkeypatch):
    """``http(write)``: the next connection is one end of a socket pair; ``write`` gets the other."""

    def serve(write):
        ours, theirs = socket.socketpair()
        ours = Pair(fileno=ours.detach())

        def run():
            try:
                theirs.recv(65536)
                write(theirs)
            except OSError:
                pass
            finally:
                theirs.close()

        threading.Thread(target=run, daemon=True).start()
        monkeypatch.setattr(download.socket, "create_connection", lambda *a, **k: ours)

    return serve


def trickle(sock, data: bytes, every: float = 0.1):
    for k in range(len(data)):
        sock.sendall(data[k : k + 1])
        time.sleep(every)


def test_http_body(http):
    http(lambda s: s.sendall("HTTP/1.1 200 OK\r\nContent-Length: 4\r\nConnection: close\r\n\r\nñab".encode()))
    assert contents(fetched(["http://feeds.example/x"])) == {0: "ñab"}


@pytest.mark.parametrize(
    "write",
    [
        lambda s: trickle(s, b"HTTP/1.1 200 OK\r\nX: " + b"y" * 1000),  # headers trickle
        lambda s: (s.sendall(b"HTTP/1.1 200 OK\r\nContent-Length: 1000\r\n\r\n"), trickle(s, b"z" * 1000)),
        lambda s: (s.sendall(b"HTTP/1.1 200 OK\r\n\r\n"), trickle(s, b"z" * 1000)),  # no length: an early end is no body
        lambda s: time.sleep(20),  # silence
    ],
)
def test_slow_http_ends_at_the_deadline(http, write):
    http(write)
    begun = time.monotonic()
    assert contents(fetched(["http://feeds.example/x"], deadline=0.7)) == {0: None}
    assert time.monotonic() - begun < 2


@pytest.mark.parametrize("answer", [b"HTTP/1.1 200 OK\r\nContent-Length: 10\r\n\r\nshort", b"HTTP/1.1 404 No\r\nContent-Length: 0\r\n\r\n", b"HTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\n\xff\xfe", b"nonsense"])
def test_failed_http(http, answer):
    http(lambda s: s.sendall(answer))
    assert contents(fetched(["http://feeds.example/x"])) == {0: None}


def test_bad_urls():
    urls = [None, "", "no url", "file:///missing/file", "file://elsewhere/x", "gopher://x/y", "http://"]
    assert contents(fetched(urls)) == dict.fromkeys(range(len(urls)))


def test_budget_lets_only_the_oldest_pass():
    budget = ByteBudget(100)
    first, second = budget.enter(), budget.enter()
    budget.take(first, 90)
    budget.take(first, 90)  # beyond the total: the oldest goes on
    taken = threading.Event()
    threading.Thread(target=lambda: (budget.take(second, 50), taken.set()), daemon=True).start()
    assert not taken.wait(0.3)
    budget.leave(first)  # now the second is the oldest
    assert taken.wait(2)
    budget.give(180)
    assert budget.used == 50


def test_waiting_for_the_budget_is_not_the_feeds_time(tmp_path):
    (tmp_path / "a").write_text("a" * 1000)
    budget = ByteBudget(500)
    first = budget.enter()
    budget.take(first, 500)
    threading.Timer(1.0, budget.leave, [first]).start()  # longer than the deadline
    text, size = body(f"file://{tmp_path}/a", 5, 0.5, budget)
    assert size == 1000 and text.to_pylist() == ["a" * 1000]


def test_more_bodies_than_the_budget_all_arrive(tmp_path):
    for k in range(30):
        (tmp_path / str(k)).write_text(str(k % 10) * 700_000)
    got = contents(fetched([f"file://{tmp_path}/{k}" for k in range(30)], threads=8, batch_bytes=500_000, budget=1_000_000))
    assert got == {k: str(k % 10) * 700_000 for k in range(30)}


def test_hundred_bodies_of_50_mb_in_512_mb(tmp_path):
    """In a process of its own, whose largest memory is looked at."""
    with open(tmp_path / "big", "wb") as f:
        for _ in range(50):
            f.write(b"0123456789" * 100_000)
    code = """
import resource, sys
import pyarrow as pa
from feedlens import config
from feedlens.sources.download import fetcher
url = sys.argv[1]
source = (pa.RecordBatch.from_pydict({"feed_id": [k], "feed_name": ["n"], "url": [url]}) for k in range(100))
n = size = 0
for batch in fetcher(30, 300, 8, config.FETCH_BATCH_BYTES, config.FETCH_BUDGET_BYTES)(source):
    n += batch.num_rows
    size += sum(len(x.as_buffer()) for x in batch.column(3) if x.is_valid)
    del batch
print(n, size, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    run = subprocess.run([sys.executable, "-c", code, f"file://{tmp_path}/big"], env=os.environ | {"PYTHONPATH": ROOT}, capture_output=True, text=True, timeout=300)
    n, size, mb = map(int, run.stdout.split())
    assert (n, size) == (100, 100 * 50_000_000) and mb < 512, run.stdout
