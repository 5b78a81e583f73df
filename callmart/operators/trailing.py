"""Counts and sums of a key's events in windows that trail each probe row.

The meaning is an interval join: for a probe at time t, the events e of the same key with
``lower(t) <= e <= upper(t)``, aggregated. A join would form every (probe, event) pair of a key.
Here each end of a window finds the total of all events up to it, and a window is the difference of its two ends: by
frames that begin with the key's first row where windows have a fixed length, else both ends become rows of their own
among the events. Work grows with the number
of events, not with its square, and ends may lie anywhere (a month back with its clamped day, the
last midnight).

Rows of ordinary keys are shuffled once, narrow and as they are: the events of one instant are summed, and probes
become window ends, where the key's rows then lie. Rows of hot keys are summed by instant before they move, and their
running sums are split (``ordered.running``).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmart.operators.ordered import HOT_ROWS, Hot, find_hot, paths

_BEFORE, _EVENT, _AFTER = 0, 1, 2  # sort order among rows of the same instant

UPTO = "upto"  # events up to the probe's own time, included
UNTIL = "until"  # events before the probe's own time
MIDNIGHT = "midnight"  # events up to the start of the probe's day, included

# Units of ``Trailing.back`` that always have one length, unlike months.
_FIXED = ("HOUR", "DAY", "WEEK")
# Most days that a unit of ``Trailing.back`` can span.
_DAYS = {"HOUR": 1, "DAY": 1, "WEEK": 7, "MONTH": 31, "YEAR": 366}


@dataclass(frozen=True)
class Trailing:
    """A window behind a probe: how far back (None: from the beginning) and where it stops."""

    back: str | None
    stop: str = UPTO

    @property
    def days(self) -> int:
        """Days that cover ``back``, which must have a start."""
        number, unit = self.back.split()
        return int(number) * _DAYS[unit.upper().rstrip("S")]

    @property
    def ends(self) -> list[str]:
        return [self.stop] + ([self.back] if self.back else [])


def _end(name: str, ts: str) -> tuple[str, int]:
    """Instant of a window end, and on which side of that instant's events it lies."""
    if name == UPTO:
        return ts, _AFTER
    if name == UNTIL:
        return ts, _BEFORE
    if name == MIDNIGHT:
        return f"cast(date_trunc('DAY', {ts}) as timestamp_ntz)", _AFTER
    return f"{ts} - interval {name}", _BEFORE


def _mark(number: int, name: str, ts: str) -> str:
    at, side = _end(name, ts)
    return f"named_struct('_t', {at}, '_side', {side}, '_end', {number})"


def trailing(
    probes: DataFrame,
    events: DataFrame,
    keys: list[str],
    probe_ts: str,
    event_ts: str,
    sums: Mapping[str, str],
    windows: Mapping[str, Trailing],
    outputs: Mapping[str, tuple[str, str]],
    latest: Mapping[str, tuple[str, str]] | None = None,
    since: str | None = None,
    hot: Hot | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per distinct (key, ``probe_ts``) of ``probes`` with the trailing values.

    ``sums`` names SQL expressions over ``events`` (never missing), summed in their own type: take decimals where
    fractions must be exact; ``outputs`` maps a
    result column to (sum name, window name); ``latest`` maps a result column to (a nullable event
    time, window name) and gives the newest such time inside the window. Missing keys match each
    other. With ``since``, a timestamp in SQL, only probes from then on are answered, and events too
    old for any of their windows are not read.
    """
    latest = dict(latest or {})
    used = {w for _, w in outputs.values()} | {w for _, w in latest.values()}
    ends = {e: i for i, e in enumerate(sorted({e for w in used for e in windows[w].ends}))}
    kept = [f"_s_{name}" for name in sums]
    tops = {f"_l_{out}": e for out, (e, _) in latest.items()}

    backs = [windows[w].back for w in used]
    kept_events = events.where(F.col(event_ts).isNotNull())
    if since and all(backs):
        # From the start of that day, as clamped months are not in order within it.
        oldest = ", ".join(f"date_trunc('DAY', {since} - interval {b})" for b in sorted({*backs}))
        oldest = f"least({oldest}, {since})" if len({*backs}) > 1 else oldest
        kept_events = kept_events.where(f"{event_ts} >= cast({oldest} as timestamp_ntz)")
    line = kept_events.selectExpr(
        *keys, f"{event_ts} as _t", f"{_EVENT} as _side",
        *[f"{e} as _s_{name}" for name, e in sums.items()],
        *[f"{e} as {top}" for top, e in tops.items()],
    )
    # Rows of a key before copies are summed bound its rows after; each asks for all window ends.
    own = probes is events and probe_ts == event_ts
    weight = len(ends) + 1
    if hot is None:
        counted = events if own else events.select(*keys).unionByName(probes.select(*keys))
        hot = find_hot(counted, keys, hot_rows // weight)
    totals = {"sums": {f"_r{s}": s for s in kept}, "maxes": {f"_r{top}": top for top in tops}}
    # The last column only tells equal ends of a hot key apart, so that they can be split.
    order = ["_t", "_side", "_at"]

    def sweep_own(rows: DataFrame, run) -> DataFrame:
        """The events ask about themselves: totals up to each event first, then window ends.

        The ends are made where the key's events already are and only look up the last total, so
        neither the shuffle nor the sums see more rows than there are instants. An event row is its
        own UPTO end.
        """
        summed = run(instants(rows), ["_t"], **totals)
        total = ", ".join(f"'{name}', {name}" for part in totals.values() for name in part)
        itself = f"named_struct('_t', _t, '_side', {_EVENT}, '_end', {{}})"
        marks = [itself.format(ends.get(UPTO, "cast(null as int)"))]
        marks += [_mark(i, name, "_t") for name, i in ends.items() if name != UPTO]
        marks = f"array({', '.join(marks)})"
        if since:
            marks = f"if(_t >= {since}, {marks}, array({itself.format('cast(null as int)')}))"
        line = summed.selectExpr(*keys, "_t as _at", f"named_struct({total}) as _total", f"explode({marks}) as _m")
        line = line.selectExpr(*keys, "_at", "_m.*", f"if(_m._side = {_EVENT}, _total, null) as _total")
        swept = run(line, order, lasts={"_found": "_total"}, weight=weight)
        return swept.selectExpr(
            *keys, "_at", "_end",
            *[f"coalesce(_found.{name}, 0L) as {name}" for name in totals["sums"]],
            *[f"_found.{name} as {name}" for name in totals["maxes"]],
        )

    def sweep(rows: DataFrame, run) -> DataFrame:
        """Probes become their window ends where the key's rows already are."""
        marks = ", ".join(_mark(i, name, "_t") for name, i in ends.items())
        itself = f"named_struct('_t', _t, '_side', {_EVENT}, '_end', cast(null as int))"
        marks = f"if(_side = {_EVENT}, array({itself}), array({marks}))"
        placed = instants(rows).selectExpr(*keys, f"if(_side = {_EVENT}, null, _t) as _at", f"explode({marks}) as _m", *kept, *tops)
        return run(placed.selectExpr(*keys, "_at", "_m.*", *kept, *tops), order, weight=weight, **totals)

    def instants(rows: DataFrame) -> DataFrame:
        """One row for each instant of a key and side."""
        return rows.groupBy(*keys, "_t", "_side").agg(
            *[F.expr(f"coalesce(sum({s}), 0L) as {s}") for s in kept], *[F.expr(f"max({top}) as {top}") for top in tops]
        )

    if own:
        sweep = sweep_own
    else:
        asked = probes.where(f"{probe_ts} >= {since}" if since else f"{probe_ts} is not null")
        asked = asked.selectExpr(*keys, f"{probe_ts} as _t", f"{_AFTER} as _side")
        line = line.unionByName(asked, allowMissingColumns=True)

    def by_ranges(rows: DataFrame) -> DataFrame:
        """For windows of a fixed length: each end is a frame that begins with the key's first row, so rows are not multiplied.

        Such a frame only ever takes rows in. The rows of one day (a row at midnight belongs to the day before) see the same midnight.
        """
        over = "partition by {} order by {} range between unbounded preceding and {}".format
        by = ", ".join(keys)
        day = "date_trunc('DAY', _t - interval 1 microsecond)"
        found, needed = {}, {e: set() for e in ends}
        for name, window in outputs.values():
            for e in windows[window].ends:
                needed[e].add(f"_s_{name}")
        for out, (_, window) in latest.items():
            needed[windows[window].stop].add(f"_l_{out}")
        total = lambda s: f"max({s})" if s.startswith("_l_") else f"sum({s})"
        every = list(dict.fromkeys([*kept, *tops]))
        out = instants(rows)
        if MIDNIGHT in ends:
            out = out.withColumn("_day", F.expr(f"cast({day} as timestamp_ntz)"))
            out = out.selectExpr(*[c for c in out.columns if c != "_day"], *[
                f"if(_t = date_trunc('DAY', _t), {total(s)} over ({over(by, '_day', 'current row')}), {total(s)} over ({over(by, '_day', 'interval 1 day preceding')})) as _midnight{s}"
                for s in every if s in needed[MIDNIGHT]
            ])
        bounds = {UPTO: "current row", UNTIL: "interval 1 microsecond preceding"}
        columns = [
            f"{total(s)} over ({over(by, '_t', bounds.get(e, f'interval {e} 1 microsecond preceding'))}) as _{i}{s}"
            for e, i in ends.items() if e != MIDNIGHT
            for s in every if s in needed[e]
        ]
        out = out.selectExpr("*", *columns).where(f"_t >= {since}" if since and own else "true" if own else f"_side = {_AFTER}")
        at = lambda e, s: f"_midnight{s}" if e == MIDNIGHT else f"_{ends[e]}{s}"
        values = []
        for name, (s, window) in outputs.items():
            w = windows[window]
            value = f"coalesce({at(w.stop, f'_s_{s}')}, 0L)"
            if w.back:
                value += f" - coalesce({at(w.back, f'_s_{s}')}, 0L)"
            if w.back and w.stop == MIDNIGHT:
                value = f"if({_end(w.back, '_t')[0]} <= {_end(MIDNIGHT, '_t')[0]}, {value}, 0L)"
            values.append(f"{value} as {name}")
        for name, (_, window) in latest.items():
            w, newest = windows[window], at(windows[window].stop, f"_l_{name}")
            values.append(f"if({newest} >= {_end(w.back, '_t')[0]}, {newest}, null) as {name}" if w.back else f"{newest} as {name}")
        return out.selectExpr(*keys, "_t as _at", *values)

    results = []
    for out, (name, window) in outputs.items():
        w, total = windows[window], f"_r_s_{name}"
        value = f"case when _end = {ends[w.stop]} then {total}"
        if w.back:
            value += f" when _end = {ends[w.back]} then -{total}"
        value += " end"
        if w.back and w.stop == MIDNIGHT:
            # A window shorter than a day can end before it starts; it is then empty.
            value = f"if({_end(w.back, '_at')[0]} <= {_end(MIDNIGHT, '_at')[0]}, {value}, 0L)"
        results.append(f"sum({value}) as {out}")
    for out, (_, window) in latest.items():
        w, found = windows[window], f"_r_l_{out}"
        recent = f" and {found} >= {_end(w.back, '_at')[0]}" if w.back else ""
        results.append(f"max(if(_end = {ends[w.stop]}{recent}, {found}, null)) as {out}")
    fixed = all(b is None or b.split()[1].upper().rstrip("S") in _FIXED for b in backs)
    answers = [
        by_ranges(rows) if fixed and plain
        else sweep(rows, run).where("_end is not null").groupBy(*keys, "_at").agg(*[F.expr(r) for r in results])
        for plain, (rows, run) in zip((True, False), paths(line, keys, hot, hot_rows, gather=True))
    ]
    return reduce(DataFrame.unionByName, answers).withColumnRenamed("_at", probe_ts)


def count_before(
    probes: DataFrame,
    events: DataFrame,
    keys: list[str],
    probe_ts: str,
    event_ts: str,
    counts: Mapping[str, str],
    hot: Hot | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """How many events of the same key lie strictly before each probe, per counted condition."""
    return trailing(
        probes,
        events,
        keys,
        probe_ts,
        event_ts,
        sums={out: f"if({condition}, 1, 0)" for out, condition in counts.items()},
        windows={"ever": Trailing(None, UNTIL)},
        outputs={out: (out, "ever") for out in counts},
        hot=hot,
        hot_rows=hot_rows,
    )
