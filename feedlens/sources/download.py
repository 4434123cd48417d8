"""Downloads under a hard deadline and a byte budget (S3).

What runs inside the fetch tasks. The module is shipped to Python workers by value and uses
nothing else of this package, so executors do not need ``feedlens`` installed.

* **Deadline.** A body is read as it comes, never by waiting for a block to fill. Local files
  and pipes are polled for the time that is left; sockets are watched by a guard that shuts
  them down when the time is up, whatever they wait for then (TLS, headers, body).
* **Byte budget.** The bodies of a task, under way or not yet handed on, share a budget. A
  download that would pass it waits, and the wait is added to its deadline. The oldest
  download never waits, so one always ends: a task holds at most the budget and one body.
"""

from __future__ import annotations

import http.client
import os
import select
import socket
import sys
import threading
import time
import urllib.request
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from urllib.parse import urlsplit

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

READ_BYTES = 256 * 1024


class ByteBudget:
    """Bytes that the downloads of a task may hold together."""

    def __init__(self, total: int):
        self.total, self.used, self.waiting = total, 0, 0
        self.tickets: set[int] = set()
        self.last = 0
        self.changed = threading.Condition()

    def enter(self) -> int:
        """A ticket for a download that begins; the smallest is the oldest."""
        with self.changed:
            self.last += 1
            self.tickets.add(self.last)
            return self.last

    def take(self, ticket: int, size: int) -> float:
        """Hold ``size`` more bytes; the seconds that took. Only the oldest may pass the total."""
        begun = time.monotonic()
        with self.changed:
            self.waiting += 1
            self.changed.wait_for(lambda: self.used + size <= self.total or ticket == min(self.tickets))
            self.waiting -= 1
            self.used += size
        return time.monotonic() - begun

    def leave(self, ticket: int) -> None:
        """The download has ended (its bytes may still be held)."""
        with self.changed:
            self.tickets.discard(ticket)
            self.changed.notify_all()

    def give(self, size: int) -> None:
        with self.changed:
            self.used -= size
            self.changed.notify_all()


class Guard:
    """The time left for one download. ``watch`` starts a thread that shuts the download's
    sockets down at the end of it."""

    def __init__(self, seconds: float):
        self.end = time.monotonic() + seconds
        self.sockets: list[socket.socket] = []
        self.over, self.expired = threading.Event(), False

    def left(self) -> float:
        seconds = self.end - time.monotonic()
        if seconds <= 0:
            raise TimeoutError
        return seconds

    def connect(self, address, timeout, *args, **kwargs) -> socket.socket:
        """``socket.create_connection``, watched: a second handle stays valid under TLS."""
        sock = socket.create_connection(address, min(timeout, self.left()), *args, **kwargs)
        sock.settimeout(timeout)
        self.sockets.append(sock.dup())
        return sock

    def watch(self) -> None:
        def run():
            while not self.over.wait(max(0.0, self.end - time.monotonic())):
                if time.monotonic() >= self.end:
                    self.expired = True
                    for sock in self.sockets:
                        try:
                            sock.shutdown(socket.SHUT_RDWR)
                        except OSError:
                            pass
                    self.over.wait(0.05)  # a connection made since is shut down next

        threading.Thread(target=run, daemon=True).start()

    def close(self) -> None:
        self.over.set()
        for sock in self.sockets:
            sock.close()


def guarded_opener(guard: Guard):
    """urllib's opener, its HTTP and HTTPS connections made by ``guard``."""

    def made(kind):
        def connection(host, **kwargs):
            out = kind(host, **kwargs)
            out._create_connection = guard.connect
            return out

        return connection

    class Http(urllib.request.HTTPHandler):
        def http_open(self, request):
            return self.do_open(made(http.client.HTTPConnection), request)

    class Https(urllib.request.HTTPSHandler):
        def https_open(self, request):
            return self.do_open(made(http.client.HTTPSConnection), request, context=self._context)

    return urllib.request.build_opener(Http, Https)


def file_parts(path: str, guard: Guard):
    """The bytes of a local file or pipe, as they come."""
    handle = os.open(path, os.O_RDONLY | os.O_NONBLOCK)
    try:
        ready = select.poll()
        ready.register(handle, select.POLLIN)
        while True:
            if not ready.poll(1000 * guard.left()):
                raise TimeoutError
            part = os.read(handle, READ_BYTES)
            if not part:
                return
            yield part
    finally:
        os.close(handle)


def url_parts(url: str, timeout: float, guard: Guard):
    """The bytes of any other url, as they come."""
    guard.watch()
    try:
        with guarded_opener(guard).open(url, timeout=timeout) as response:
            read = getattr(response, "read1", response.read)
            while part := read(READ_BYTES):
                guard.left()
                yield part
            if guard.expired or getattr(response, "length", None):
                raise OSError("the body ended early")
    finally:
        guard.close()


def body(url: str | None, timeout: float, deadline: float, budget: ByteBudget):
    """The whole body as a string array of one value, and the bytes it holds of the budget; None
    for a bad url, an error, bytes that are not UTF-8, or a body not read within ``deadline``
    seconds."""
    import pyarrow as pa

    if not url:
        return None, 0
    ticket, data = budget.enter(), bytearray()
    try:
        guard, parts = Guard(deadline), urlsplit(url)
        if parts.scheme == "file":
            if parts.netloc not in ("", "localhost"):
                raise OSError(f"not a local file: {url}")
            source = file_parts(urllib.request.url2pathname(parts.path), guard)
        else:
            source = url_parts(url, timeout, guard)
        for part in source:
            guard.end += budget.take(ticket, len(part))
            data += part
        offsets = pa.array([0, len(data)], pa.int32()).buffers()[1]
        text = pa.Array.from_buffers(pa.binary(), 1, [None, offsets, pa.py_buffer(data)]).cast(pa.string())  # checks UTF-8
        return text, len(data)
    except Exception:
        budget.give(len(data))
        return None, 0
    finally:
        budget.leave(ticket)


def fetcher(timeout: float, deadline: float, threads: int, batch_bytes: int, budget_bytes: int):
    """The fetch of one partition: Arrow batches ``feed_id, feed_name, url`` in, the same with
    ``content`` out. Bodies go out as soon as they have ``batch_bytes`` together, or when a
    download waits for the budget."""

    def fetch(batches):
        import pyarrow as pa

        budget = ByteBudget(budget_bytes)
        schema = pa.schema([("feed_id", pa.int64()), ("feed_name", pa.string()), ("url", pa.string()), ("content", pa.string())])
        done, held = [], 0

        def handed_on():
            nonlocal done, held
            columns = [pa.array([d[0][k] for d in done], schema.field(k).type) for k in range(3)]
            texts = [pa.nulls(1, pa.string()) if d[1] is None else d[1] for d in done]
            content = pa.concat_arrays(texts) if texts else pa.array([], pa.string())
            out, size = pa.RecordBatch.from_arrays([*columns, content], schema=schema), held
            done, held = [], 0
            del texts, content, columns
            return out, size

        def collect(running):
            nonlocal held
            for task in wait(running, timeout=1.0, return_when=FIRST_COMPLETED).done:
                row = running.pop(task)
                text, size = task.result()
                if held and held + size > batch_bytes:
                    out, given = handed_on()
                    yield out
                    del out
                    budget.give(given)
                done.append((row, text))
                held += size
                del task, text
            if held >= batch_bytes or held and budget.waiting:
                out, given = handed_on()
                yield out
                del out
                budget.give(given)

        with ThreadPoolExecutor(max_workers=threads) as pool:
            running: dict = {}
            for batch in batches:
                for row in zip(*(batch.column(name).to_pylist() for name in ("feed_id", "feed_name", "url")), strict=True):
                    while len(running) >= threads:
                        yield from collect(running)
                    running[pool.submit(body, row[2], timeout, deadline, budget)] = row
            while running:
                yield from collect(running)
            yield handed_on()[0]

    return fetch
