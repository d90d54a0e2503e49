"""Texts read by a program of their own: documents in, the same documents in another form out.

Each task runs one child process. A line ``locator<tab>text`` goes to it for each document, and it answers
with lines of the same form. Writing, reading and Spark's own rows go on at the same time over queues of
bounded size, so neither pipe can fill up while the other waits. Answers belong to documents by the
locator they echo, whatever order they come in.
"""

from __future__ import annotations

import queue
import re
import subprocess
import threading
from collections import defaultdict, deque
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from .readers import DOCUMENT

#: Documents and characters of one parcel, and parcels that may wait on either side.
PARCEL, PARCEL_CHARS, WAITING = 256, 1 << 20, 4
#: Characters of the child's last words that an error quotes.
QUOTED = 2_000
_PATIENCE = 0.02

Row = tuple[str, int, str, str]


class ReaderFailed(RuntimeError):
    """The child ended with an error, or answered what it wasn't asked while ``strict``."""


def _lines(raw: bytes) -> list[str]:
    """Lines by any system's line ends, without empty ones."""
    return [x for x in re.split("[\r\n]+", raw.decode("utf-8")) if x]


class _Child:
    """A running reader with a thread for each of its pipes."""

    def __init__(self, command: Sequence[str]):
        self.command = list(command)
        self.process = subprocess.Popen(self.command, stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.PIPE)
        self.out: queue.Queue[str | None] = queue.Queue(WAITING)
        self.answers: queue.Queue[list[str] | None] = queue.Queue(WAITING)
        self.said: deque[str] = deque(maxlen=40)
        self.broken: BaseException | None = None
        self.over = threading.Event()
        self.threads = [threading.Thread(target=t, daemon=True) for t in (self._write, self._read, self._listen)]
        for t in self.threads:
            t.start()

    def _write(self) -> None:
        try:
            with self.process.stdin as pipe:
                while (parcel := self.out.get()) is not None:
                    pipe.write(parcel.encode("utf-8", "surrogatepass"))
        except OSError:  # the child is gone; how it ended says why
            while not self.over.is_set() and self.out.get() is not None:
                pass

    def _give(self, lines: list[str] | None) -> None:
        while not self.over.is_set():
            try:
                return self.answers.put(lines, timeout=0.5)
            except queue.Full:
                pass

    def _read(self) -> None:
        parts: list[bytes] = []  # of a line that isn't whole yet
        try:
            while chunk := self.process.stdout.read1(PARCEL_CHARS):
                whole, end, rest = chunk.rpartition(b"\n")
                if end:
                    self._give(_lines(b"".join([*parts, whole])))
                    parts = []
                parts.append(rest)
            self._give(_lines(b"".join(parts)))
        except (OSError, UnicodeDecodeError) as e:
            self.broken = e
            self.process.kill()
        self._give(None)

    def _listen(self) -> None:
        for raw in self.process.stderr:
            self.said.append(raw.decode("utf-8", "replace"))

    def end(self) -> None:
        """Wait for the child; raises if it ended badly."""
        code = self.process.wait()
        self.threads[2].join(5)
        if self.broken or code:
            raise ReaderFailed(f"{self.command[0]} exited {code}: {self.broken or ''.join(self.said)[-QUOTED:].strip()}")

    def close(self) -> None:
        self.over.set()
        if self.process.poll() is None:
            self.process.kill()
        self.process.wait()


_NOTHING = object()


def _taken(answers: queue.Queue):
    try:
        return answers.get_nowait()
    except queue.Empty:
        return _NOTHING


def exchange(rows: Iterable[Row], command: Sequence[str], strict: bool = False) -> Iterator[list[Row]]:
    """Rows (source, seq, locator, text) in parcels, each with the text that the child answered."""
    # documents that wait for an answer, without their texts; equal locators are answered in turn
    asked: dict[str, deque[tuple[str, int]]] = defaultdict(deque)
    child = _Child(command)

    def matched(lines: list[str]) -> list[Row]:
        out = []
        for line in lines:
            locator, tab, text = line.partition("\t")
            waiting = asked.get(locator) if tab and locator else None
            if not waiting:
                if strict:
                    raise ReaderFailed(f"{child.command[0]} answered what it wasn't asked: {line[:80]!r}")
                continue
            source, seq = waiting.popleft()
            if not waiting:
                del asked[locator]
            if text:
                out.append((source, seq, locator, text))
        return out

    def parcels() -> Iterator[str]:
        held, size = [], 0
        for source, seq, locator, text in rows:
            if re.search(r"[\t\n\r]", locator or ""):
                raise ValueError(f"a locator with a tab or a line end can't be asked about: {locator!r}")
            if not locator:
                continue
            asked[locator].append((source, seq))
            held.append(f"{locator}\t{re.sub('[\t\n\r]+', ' ', text or '')}\n")
            size += len(held[-1])
            if len(held) >= PARCEL or size >= PARCEL_CHARS:
                yield "".join(held)
                held, size = [], 0
        if held:
            yield "".join(held)

    try:
        for parcel in parcels():
            while True:  # what comes back is taken whenever what goes out has to wait
                try:
                    child.out.put(parcel, timeout=_PATIENCE)
                    break
                except queue.Full:
                    pass
                if (lines := _taken(child.answers)) is not _NOTHING:
                    if lines is None:
                        child.end()
                        raise ReaderFailed(f"{child.command[0]} ended before it was told to")
                    yield matched(lines)
        done = False
        while True:
            if not done:
                try:
                    child.out.put_nowait(None)
                    done = True
                except queue.Full:
                    pass
            try:
                lines = child.answers.get(timeout=None if done else _PATIENCE)
            except queue.Empty:
                continue
            if lines is None:
                break
            yield matched(lines)
        child.end()
    finally:
        child.close()


def readings_by_process(docs: DataFrame, command: Sequence[str], strict: bool = False) -> DataFrame:
    """(source, seq, locator, text) with the texts that ``command`` answers, one process a task.

    Tabs and line ends within a text count as one space, and a null text as an empty one. A document whose
    answer is empty, or that gets none, is left out, as is one without a locator. Lines without a tab and
    lines for locators that weren't asked about, or not as often, are passed over, so a reader can't
    invent a place; with ``strict`` they are errors. A child that ends with another code than 0, by a
    signal too, fails the job with its last words, as do answers that aren't UTF-8. ``command`` must exist
    on every executor; a script can be given whole, as ``[python, "-c", text]``.
    """
    kinds = (pa.string(), pa.int64(), pa.string(), pa.string())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for at in range(0, batch.num_rows, PARCEL) for row in zip(*(c.to_pylist() for c in batch.slice(at, PARCEL).columns)))
        for found in exchange(rows, command, strict):
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=["source", "seq", "locator", "text"])

    return docs.select("source", "seq", "locator", "text").mapInArrow(read, DOCUMENT)
