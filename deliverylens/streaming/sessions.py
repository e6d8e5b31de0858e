"""Session journals as a stream: an ordered state machine a session, with timers for what is left open.

The state of a session is small: its open run, running counters and places in one
value; pending calls, sub-agents, gates and commit ranges in maps of their own, which
are read by key. While a session's records are handled its maps are held: a key is read from the
store once, of a new session none, and only what is left at the end is written. A session that is silent for a day is over: by a timer, or when its next
record shows the gap. Then an open run is abandoned, pending calls and sub-agents are let go,
and what is bound is told; a binding once told stays, though its head moves back to its base.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from deliverylens.operators.sessions import AGENT, IDLE_S, RESOLVED, events, records

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FIELDS = [f.split(" ")[0] for f in RESOLVED.split(", ")]
IDLE_US = IDLE_S * 1_000_000
_VALUE = {"run": "string", "run_at": "long", "repo": "string", "branch": "string", "host": "string", "skill": "string", "skills": "long", "turns": "long", "last": "long", "roots": "array<string>"}
_CALL = ("tool", "server", "gate", "path", "parent")


class _Held:
    """A map of one session's state while its rows are handled; ``empty`` if the store has none of it."""

    def __init__(self, store, empty: bool) -> None:
        self.store, self.empty, self.now, self.changed = store, empty, {}, set()

    def get(self, key: str) -> tuple | None:
        if key not in self.now:
            self.now[key] = tuple(self.store.getValue((key,))) if not self.empty and self.store.containsKey((key,)) else None
        return self.now[key]

    def put(self, key: str, value: tuple | None) -> None:
        self.now[key] = value
        self.changed.add(key)

    def clear(self) -> None:
        if not self.empty:
            self.store.clear()
        self.empty, self.now, self.changed = True, {}, set()

    def items(self) -> list[tuple[str, tuple]]:
        if not self.empty:
            for (key,), value in self.store.iterator():
                self.now.setdefault(key, tuple(value))
        return [(k, v) for k, v in sorted(self.now.items()) if v is not None]

    def write(self) -> None:
        for key in self.changed:
            if self.now[key] is not None:
                self.store.updateValue((key,), self.now[key])
            elif not self.empty:
                self.store.removeKey((key,))


class JournalFold(StatefulProcessor):
    """Resolved rows of a session's records, in the order of their times and ids."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("session", ", ".join(f"{n} {t}" for n, t in _VALUE.items()))
        self.maps = {
            "calls": handle.getMapState("calls", "call string", ", ".join(f"{c} string" for c in _CALL)),
            "subs": handle.getMapState("subs", "call string", "name string, run string"),
            "gates": handle.getMapState("gates", "gate string", "n long"),
            "ranges": handle.getMapState("ranges", "branch string", "base string, head string"),
        }

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        s = self._load()
        for r in sorted(rows, key=lambda r: (r.at_us, r.record_id or "")):
            if s["last"] is not None and r.at_us - s["last"] >= IDLE_US:
                yield from self._over(key[0], s)
            yield from self._take(s, r)
            s["last"] = max(r.at_us, s["last"] or r.at_us)
        known = self.known
        self._store(s)
        for timer in list(self.handle.listTimers()) if known else ():
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(-(-(s["last"] + IDLE_US) // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        s = self._load()
        yield from self._over(key[0], s)
        self._store(s)

    def close(self) -> None:
        pass

    # state

    def _load(self) -> dict:
        self.known = self.value.exists()
        self.calls, self.subs, self.gates, self.ranges = (_Held(self.maps[n], not self.known) for n in ("calls", "subs", "gates", "ranges"))
        if self.known:
            return dict(zip(_VALUE, self.value.get()))
        return dict.fromkeys(_VALUE) | {"skills": 0, "turns": 0, "roots": []}

    def _store(self, s: dict) -> None:
        self.value.update(tuple(s[n] for n in _VALUE))
        for held in (self.calls, self.subs, self.gates, self.ranges):
            held.write()

    @staticmethod
    def _row(s: dict, session: str, record: str | None, kind: str, at: int, **more) -> Row:
        skill = s["skill"] if s["skills"] == 1 else None
        have = {"session_id": session, "record_id": record, "kind": kind, "at_us": at, "agent": AGENT, "skill": skill, "repo": s["repo"], "branch": s["branch"], "host": s["host"], "roots": s["roots"]} | more
        return Row(**{n: have.get(n) for n in FIELDS})

    def _over(self, session: str, s: dict) -> Iterator[Row]:
        if s["run"] is not None:
            yield self._row(s, session, s["run"], "run.abandoned", s["last"] + IDLE_US, run=s["run"], roots=None)
            s["run"] = s["run_at"] = None
        yield from self._bound(session, s, s["last"])
        self.calls.clear()
        self.subs.clear()

    def _bound(self, session: str, s: dict, at: int) -> Iterator[Row]:
        for branch, (base, head) in self.ranges.items() if s["repo"] is not None else ():
            if base is not None and head is not None and base != head:
                yield self._row(s, session, None, "run.bound", at, branch=branch, base=base, head=head, roots=None)

    def _take(self, s: dict, r) -> Iterator[Row]:
        kind, call = r.kind, r.call
        row = lambda **more: self._row(s, r.session_id, r.record_id, kind, r.at_us, body=r.body, **more)
        for name in ("repo", "branch", "host"):
            s[name] = getattr(r, name) or s[name]
        s["roots"] = list(dict.fromkeys([*s["roots"], *(r.roots or [])]))
        if r.skill is not None and r.skill != s["skill"]:
            s["skill"], s["skills"] = s["skill"] or r.skill, s["skills"] + 1
        if kind in ("session.start", "session.resume"):
            s["run"], s["run_at"] = r.own_run, r.at_us
            if s["branch"] is not None:
                base, head = self.ranges.get(s["branch"]) or (None, None)
                self.ranges.put(s["branch"], (base or r.base, r.head or head))
            yield row(run=s["run"])
        elif kind == "subagent.started" and r.own_run is not None:
            self.subs.put(call, (r.name, r.own_run))
            yield row(run=r.own_run, parent_run=s["run"], agent=r.name)
        elif kind in ("subagent.completed", "subagent.failed") and call is not None and self.subs.get(call) is not None:
            name, child = self.subs.get(call)
            yield row(run=child, parent_run=s["run"], agent=name)
        elif kind == "tool.execution_start" and call is not None:
            self.calls.put(call, tuple(getattr(r, c) for c in _CALL))
        elif kind == "tool.execution_complete":
            start: dict = {}
            if call is not None and self.calls.get(call) is not None:
                start = dict(zip(_CALL, self.calls.get(call)))
                self.calls.put(call, None)
            parent = start.pop("parent", None) or r.parent
            name, run = AGENT, s["run"]
            if parent is not None and self.subs.get(parent) is not None:
                name, run = self.subs.get(parent)
            attempt, gate = None, start.get("gate")
            if gate is not None:
                attempt = (self.gates.get(gate) or (0,))[0]
                self.gates.put(gate, (attempt + 1,))
            yield row(run=run, agent=name, attempt=attempt, **start)
        elif r.human:
            s["turns"] += 1
            yield row(run=s["run"], turn=s["turns"] - 1)
        elif kind == "session.shutdown":
            yield row(run=s["run"], started_us=s["run_at"])
            s["run"] = s["run_at"] = None
            yield from self._bound(r.session_id, s, r.at_us)


def session_facts(lines: DataFrame, lateness: str) -> DataFrame:
    """RESOLVED rows of a stream of journal lines (session_id, value). Needs the RocksDB state store (``PROVIDER``).

    Records older than the watermark are left out; those of one micro-batch are put in order first.
    """
    rows = records(lines).withWatermark("at", lateness)
    return rows.groupBy("session_id").transformWithState(statefulProcessor=JournalFold(), outputStructType=RESOLVED, outputMode="append", timeMode="eventTime")


def run_facts(lines: DataFrame, lateness: str, out: str, checkpoint: str) -> None:
    """Take in the journal lines that are there and append their resolved rows to a folder."""
    spark = lines.sparkSession
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, PROVIDER)
    try:
        facts = session_facts(lines, lateness)
        facts.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(key, before)


def stored_events(facts: DataFrame) -> DataFrame:
    return events(facts.select(*FIELDS))
