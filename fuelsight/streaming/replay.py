"""Batch replay of the refuelling detector (T8) without rounds.

The rule of :mod:`.refuel` has a closed form.  A level below the first one of the buffer is
always below the last one too, so the first is the smallest level since the buffer was last
emptied by an event, and a reading emits if it and the two before lie within a plateau, it is more than ``RISE``
above that minimum, and the minimum (where it first occurred) is at least ``MIN_LEN`` readings back.

So what a stretch of readings does depends on what came before through one level only, in few steps.
Each (vehicle, chunk of time) is summarised for itself: where the buffer restarts for an entry minimum (falling
minima of the chunk) or emits it (rising plateaus), and what follows from each such place on, whatever came before: a chain of
events to an exit state.  Chains that meet are stored once.  The summaries of a vehicle are then composed in time
order, one small row per chunk.  One pass over the readings, one over the summaries, no loop of jobs, no staged table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .refuel import MIN_LEN, PLATEAU, RISE, RefuelMachine, level_samples

_HEAD = 2  # readings whose plateau test looks into the chunk before
_WHOLE = 8  # a chunk of so few readings is kept as it is
_WINDOW = 256

_SUMMARY = pa.schema([
    ("vin", pa.string()), ("chunk", pa.int64()), ("n", pa.int64()),
    ("head_t", pa.list_(pa.int64())), ("head_x", pa.list_(pa.float64())),  # fed one by one
    ("last_t", pa.int64()), ("last_x", pa.float64()), ("before", pa.list_(pa.float64())),  # the newest reading and the two before it
    ("min_k", pa.list_(pa.int64())), ("min_x", pa.list_(pa.float64())), ("min_node", pa.list_(pa.int64())),
    ("rise_k", pa.list_(pa.int64())), ("rise_x", pa.list_(pa.float64())), ("rise_mass", pa.list_(pa.float64())), ("rise_t", pa.list_(pa.int64())),
    ("rise_node", pa.list_(pa.int64())),
    # chains: an event (its own minimum, mass and times) and the node after it, or (node -1) the state at the end
    ("node_next", pa.list_(pa.int64())), ("node_n", pa.list_(pa.int64())), ("node_f", pa.list_(pa.float64())), ("node_f_t", pa.list_(pa.int64())),
    ("node_mass", pa.list_(pa.float64())), ("node_t", pa.list_(pa.int64()))])
_SUMMARY_SCHEMA = ("vin string, chunk long, n long, head_t array<long>, head_x array<double>, last_t long, last_x double, before array<double>, "
                   "min_k array<long>, min_x array<double>, min_node array<long>, rise_k array<long>, rise_x array<double>, rise_mass array<double>, "
                   "rise_t array<long>, rise_node array<long>, node_next array<long>, node_n array<long>, node_f array<double>, node_f_t array<long>, "
                   "node_mass array<double>, node_t array<long>")
_EVENT = pa.schema([("vin", pa.string()), ("fuel_mass", pa.float64()), ("fill_amount", pa.float64()), ("start_us", pa.int64()), ("end_us", pa.int64())])
_EVENT_SCHEMA = "vin string, fuel_mass double, fill_amount double, start_us long, end_us long"


class _Chunk:
    """The readings of one (vehicle, chunk); positions from ``_HEAD`` to ``end`` (the newest is left out) are summarised."""

    def __init__(self, t: np.ndarray, x: np.ndarray):
        self.t, self.x, self.end = t, x, len(x) - 1
        flat = np.abs(np.diff(x)) < PLATEAU
        self.plateau = np.zeros(len(x), bool)
        self.plateau[2:] = flat[1:] & flat[:-1]
        body = x[: self.end]
        self.low = np.minimum.accumulate(body[::-1])[::-1]  # smallest level from here to the end
        high = np.where(self.plateau[: self.end], body, -np.inf)
        self.high = np.maximum.accumulate(high[::-1])[::-1]  # largest plateau level from here on
        at_low = np.where(body == self.low, np.arange(self.end), self.end)
        self.low_at = np.minimum.accumulate(at_low[::-1])[::-1]  # where the smallest level first occurs
        self.nodes: list[tuple] = []
        self.known: dict[int, int] = {}

    def first_event(self, start: int) -> tuple[int | None, int]:
        """Where a buffer that begins at ``start`` emits (none before the end), and where its minimum is then."""
        if self.high[start] - self.low[start] <= RISE:
            return None, int(self.low_at[start])
        a, width, smallest, where = start, _WINDOW, np.inf, start
        while a < self.end:
            b = min(self.end, a + width)
            seg = self.x[a:b]
            running = np.minimum.accumulate(np.append(smallest, seg))
            at = np.maximum.accumulate(np.append(where, np.where(seg < running[:-1], np.arange(a, b), 0)))[1:]
            emits = self.plateau[a:b] & (seg - running[1:] > RISE) & (np.arange(a, b) - at >= MIN_LEN)
            if emits.any():
                k = int(emits.argmax())
                return a + k, int(at[k])
            smallest, where = running[-1], at[-1]
            a, width = b, 2 * width
        return None, int(where)

    def chain(self, start: int) -> int:
        """The node of a buffer that begins at ``start``; nodes after it are made as well."""
        path = []
        while start not in self.known:
            if start >= self.end:
                self.known[start] = self._add(-1, 0, 0.0, 0, 0.0, 0)
                break
            k, j = self.first_event(start)
            if k is None:
                self.known[start] = self._exit(j)
                break
            path.append((start, k, j))
            start = k + 1
        for begin, k, j in reversed(path):
            self.known[begin] = self._event(k, j)
        return self.known[path[0][0] if path else start]

    def _add(self, *node) -> int:
        self.nodes.append(node)
        return len(self.nodes) - 1

    def _event(self, k: int, j: int) -> int:
        return self._add(self.known[k + 1], 0, self.x[j], self.t[j], self.x[k - 2], self.t[k])

    def _exit(self, j: int) -> int:
        return self._add(-1, self.end - j, self.x[j], self.t[j], 0.0, 0)

    def minima(self) -> list[tuple[int, float, int]]:
        """The falling minima and the chain of a buffer that restarts there; one that nothing can tell from the next is left out."""
        x = self.x[_HEAD : self.end]
        running = np.minimum.accumulate(x)
        new = np.append(True, x[1:] < running[:-1])
        records = np.flatnonzero(new)
        at = records[np.cumsum(new) - 1]
        emits = np.flatnonzero(self.plateau[_HEAD : self.end] & (x - running > RISE) & (np.arange(len(x)) - at >= MIN_LEN))
        ending = dict(zip(at[emits][::-1].tolist(), emits[::-1].tolist(), strict=True))  # record -> its first event
        out: list[tuple[int, float, int]] = []
        rises = np.array([k for k, *_ in self.rises], np.int64)
        ends = sorted({*ending, int(records[-1])})  # the records whose buffer is not replaced by the next record's
        bounds = np.append(0, np.searchsorted(records, ends, side="right"))
        for r, lo, hi in reversed(list(zip(ends, bounds[:-1], bounds[1:], strict=True))):
            j = r + _HEAD
            if r in ending:
                k = ending[r] + _HEAD
                self.chain(k + 1)
                node = self._event(k, j)
            else:
                node = self._exit(j)
            places = records[lo:hi] + _HEAD  # the records that lead here
            keep = np.append(np.searchsorted(rises, places[1:]) > np.searchsorted(rises, places[:-1]), True)
            out += [(int(p), float(self.x[p]), node) for p in places[keep][::-1]]
        return out[::-1]

    def find_rises(self) -> None:
        """Plateau readings that can emit an entry minimum: those above all plateaus before, and the first ones, which may be too near to it."""
        k = np.flatnonzero(self.plateau[: self.end])
        k = k[k >= _HEAD]
        near = _HEAD + MIN_LEN - 1  # the entry minimum is at most at _HEAD - 1
        late = k[k >= near]
        high = np.maximum.accumulate(self.x[late]) if len(late) else self.x[late]
        late = late[np.append(True, self.x[late][1:] > high[:-1])] if len(late) else late
        self.rises = [(int(i), float(self.x[i]), float(self.x[i - 2]), int(self.t[i]), self.chain(int(i) + 1)) for i in np.concatenate([k[k < near], late])]

    def row(self, vin: str, chunk: int) -> tuple:
        n = len(self.x)
        if n <= _WHOLE:
            return (vin, chunk, n, self.t.tolist(), self.x.tolist(), *[None] * 17)
        self.find_rises()
        low = self.minima()
        columns = [list(c) for c in zip(*low, strict=True)] if low else [[]] * 3
        columns += [list(c) for c in zip(*self.rises, strict=True)] if self.rises else [[]] * 5
        columns += [list(c) for c in zip(*self.nodes, strict=True)]
        return (vin, chunk, n, self.t[:_HEAD].tolist(), self.x[:_HEAD].tolist(), int(self.t[-1]), float(self.x[-1]), self.x[-3:-1].tolist(), *columns)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per (vehicle, chunk); rows arrive clustered by chunk and sorted by time."""
    key, parts, done = None, [], []

    def close():
        t, x = (np.concatenate(p) for p in zip(*parts, strict=True))
        done.append(_Chunk(t, x).row(*key))

    def give():
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), _SUMMARY, strict=True)], schema=_SUMMARY)
        done.clear()
        return out

    for b in batches:
        vins, chunks = b.column("vin").to_pylist(), b.column("chunk").to_numpy()
        t_us, levels = b.column("t_us").to_numpy(), b.column("level").to_numpy()
        cuts = [i for i in range(1, len(vins)) if chunks[i] != chunks[i - 1] or vins[i] != vins[i - 1]]
        for i, j in zip([0, *cuts] if vins else [], [*cuts, len(vins)]):
            if (vins[i], int(chunks[i])) != key:
                if key is not None:
                    close()
                key, parts = (vins[i], int(chunks[i])), []
            parts.append((t_us[i:j].astype(np.int64), levels[i:j].astype(np.float64)))
        if len(done) > 1000:
            yield give()
    if key is not None:
        close()
    if done:
        yield give()


def compose(machine: RefuelMachine, s: dict, out: list) -> None:
    """Takes a vehicle's state over all but the newest reading of a summarised chunk (of more than ``_WHOLE``)."""
    for t, x in zip(s["head_t"], s["head_x"], strict=True):
        machine._feed(t, x, out)
    node, body = None, s["n"] - 1 - _HEAD
    if machine.n == 0:
        node = s["min_node"][0]
    else:
        at = _HEAD - machine.n  # of the entry minimum
        falls = next((i for i, x in enumerate(s["min_x"]) if x < machine.f), None)
        rises = next((i for i, (k, x) in enumerate(zip(s["rise_k"], s["rise_x"], strict=True)) if k - at >= MIN_LEN and x - machine.f > RISE), None)
        if rises is not None and (falls is None or s["rise_k"][rises] < s["min_k"][falls]):
            out.append((s["rise_mass"][rises], s["rise_mass"][rises] - machine.f, machine.f_t, s["rise_t"][rises]))
            node = s["rise_node"][rises]
        elif falls is not None:
            node = s["min_node"][falls]
        else:
            machine.n += body
    if node is not None:
        while s["node_next"][node] >= 0:
            out.append((s["node_mass"][node], s["node_mass"][node] - s["node_f"][node], s["node_f_t"][node], s["node_t"][node]))
            node = s["node_next"][node]
        machine.n, machine.f, machine.f_t = s["node_n"][node], s["node_f"][node], s["node_f_t"][node]
    machine.l2, machine.l = s["before"]


def _compose_all(newest_open: bool):
    """mapInArrow over the summaries, clustered by vehicle and in time order: the events."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vin, machine, waiting = None, None, []
        for b in batches:
            events: list[tuple] = []
            for s in b.to_pylist():
                if s["vin"] != vin:
                    vin, machine, waiting = s["vin"], RefuelMachine(), []
                out: list[tuple] = []
                for t, x in waiting:  # what was the newest is not any more
                    machine._feed(t, x, out)
                if s["n"] > _WHOLE:
                    compose(machine, s, out)
                    waiting = [(s["last_t"], s["last_x"])]
                else:
                    for t, x in zip(s["head_t"][:-1], s["head_x"][:-1], strict=True):
                        machine._feed(t, x, out)
                    waiting = [(s["head_t"][-1], s["head_x"][-1])]
                if not newest_open:
                    for t, x in waiting:
                        machine._feed(t, x, out)
                    waiting = []
                events += [(vin, *e) for e in out]
            if events:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*events, strict=True), _EVENT, strict=True)], schema=_EVENT)

    return run


def _partitions(df: DataFrame) -> int:
    """A fixed number: small shuffles merged into one partition would leave the Python work to one task."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def chunk_summaries(samples: DataFrame, chunk_seconds: int) -> DataFrame:
    """Level samples ``(vin, t_us, level)`` as one summary per (vehicle, chunk)."""
    chunked = samples.select("vin", F.floor(F.col("t_us") / (chunk_seconds * 1_000_000)).alias("chunk"), "t_us", "level")
    return chunked.repartition(_partitions(samples), "vin", "chunk").sortWithinPartitions("vin", "chunk", "t_us", "level").mapInArrow(_summaries, _SUMMARY_SCHEMA)


def refuel_events(signals: DataFrame, step: str | None = "5 seconds", chunk_seconds: int = 86_400) -> DataFrame:
    """T8 batch replay: refuel events of every vehicle (D26: each emitted once).

    A vehicle with a third of all readings is spread over as many tasks as it has chunks; a task holds one chunk's
    readings, and then one summary at a time.  Readings of one time count in the order of their levels.  With ``step`` the newest
    step of a vehicle stays open.  Nothing runs until the result is used.
    """
    found = chunk_summaries(level_samples(signals, step), chunk_seconds)
    events = found.repartition(_partitions(found), "vin").sortWithinPartitions("vin", "chunk").mapInArrow(_compose_all(step is not None), _EVENT_SCHEMA)
    return events.select("vin", "fuel_mass", "fill_amount", _wall("start_us").alias("fill_start_time"), _wall("end_us").alias("fill_end_time"),
                         F.lit(0.0).alias("gps_latitude"), F.lit(0.0).alias("gps_longitude"))


def _wall(micros: str) -> Column:
    """A wall-clock timestamp from its microseconds, not through the session's zone."""
    return F.timestamp_add("MICROSECOND", F.col(micros), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
