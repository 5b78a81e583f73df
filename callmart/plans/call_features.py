"""P2: features of a call from the earlier calls of the same phone and client."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmart.context import RunContext
from callmart.fixed_values import DAY_PARTS
from callmart.functions.calendar import day_key
from callmart.functions.decode import SUCCESS, is_success
from callmart.functions.phone import pair_key
from callmart.operators.categories import slot_names
from callmart.operators.dedupe import top_per
from callmart.operators.history import lag_features
from callmart.operators.joins import lookup
from callmart.operators.ordered import HOT_ROWS, Hot, find_hot
from callmart.operators.trailing import MIDNIGHT, Trailing, trailing
from callmart.plans.call_log import HISTORY_DAYS

KEYS = ["phone_number", "cuid"]
TS = "dtime_call_start"
WHO_KEY = "_who"

# What tells calls of one instant apart. Calls of the second source have no id of their own.
TIES = ["interaction_id", "dtime_call_end", "code_call_result_type", "interaction_type_code", "talk_duration"]

# Calls are stored under a day (part_date) at most this many days from their start.
LOOSE_DAYS = 7

# The long window includes the call; the shorter ones stop at the midnight before it.
WINDOWS = {
    "6m": Trailing("6 MONTHS"),
    "3m": Trailing("3 MONTHS", MIDNIGHT),
    "1m": Trailing("1 MONTH", MIDNIGHT),
}


def with_previous_call(
    calls: DataFrame,
    keys: list[str] = KEYS,
    tie: list[str] = TIES,
    hot: Hot | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Time, result, direction and success of the previous call of the same phone and client."""
    return lag_features(
        calls.withColumn("call_result", is_success().cast("int")),
        keys,
        TS,
        tie,
        {
            "last_dtime_call": TS,
            "last_code_call_result_type": "code_call_result_type",
            "last_interaction_type_code": "interaction_type_code",
            "last_call_result": "call_result",
        },
        hot=hot,
        hot_rows=hot_rows,
    )


def measures() -> dict[str, str]:
    """What is summed per call: every count and average below is a quotient of these."""
    one = lambda condition: f"if({condition}, 1, 0)"
    talk = lambda condition: f"if({condition}, coalesce(talk_duration, 0), 0)"
    out = {
        "calls": "1",
        "ok": one(SUCCESS),
        "talk": talk(SUCCESS),
        "timed": one(f"{SUCCESS} and talk_duration is not null"),
    }
    for success in (False, True):
        also = f" and {SUCCESS}" if success else ""
        parts, days = slot_names(success)
        out |= {name: one(f"day_part = '{p}'{also}") for p, name in parts.items()}
        out |= {name: one(f"weekday = '{d}'{also}") for d, name in days.items()}
    for direction, short in (("OUTBOUND", "out"), ("INBOUND", "in")):
        kind = f"interaction_type_code = '{direction}'"
        out[f"cnt_{short}_calls_6m"] = one(kind)
        out[f"cnt_success_{short}_calls_6m"] = one(f"{kind} and {SUCCESS}")
    for part in DAY_PARTS:
        here = f"day_part = '{part}' and {SUCCESS}"
        out[f"talk_{part.lower()}"] = talk(here)
        # A call that is answered in this part but has no talk time is left out of the average.
        out[f"untimed_{part.lower()}"] = one(f"{here} and talk_duration is null")
    return out


# Start of a call that was answered.
LAST_SUCCESS = f"if({SUCCESS}, {TS}, null)"


def trailing_features(
    calls: DataFrame,
    keys: list[str] = KEYS,
    windows: dict[str, Trailing] | None = None,
    since: str | None = None,
    hot: Hot | None = None,
    hot_rows: int = HOT_ROWS,
    events: DataFrame | None = None,
) -> DataFrame:
    """Trailing counts, averages and last success per key and call start, in one pass.

    The calls are each other's history, unless ``events`` holds it: rows of (keys, start, ``measured`` columns), each
    for one call or for several that lie in the same windows.
    """
    windows = windows or WINDOWS
    sums = measures()
    long_only = [m for m in sums if m not in ("calls", "ok", "talk", "timed")]
    outputs = {m: (m, "6m") for m in long_only}
    for w in windows:
        outputs[f"cnt_calls_{w}"] = ("calls", w)
        outputs[f"cnt_successful_calls_{w}"] = ("ok", w)
        outputs[f"_talk_{w}"] = ("talk", w)
        outputs[f"_timed_{w}"] = ("timed", w)
    # A missing phone is nobody's: such calls are not each other's history and get no features.
    known = calls.where("phone_number is not null")
    latest = LAST_SUCCESS
    if events is not None:
        sums, latest = {m: m for m in sums}, "last_success"
    swept = trailing(
        known,
        known if events is None else events,
        keys,
        TS,
        TS,
        sums,
        windows,
        outputs,
        latest={"last_success_dtime_call2": (latest, "6m")},
        since=since,
        hot=hot,
        hot_rows=hot_rows,
    )
    averages = {
        f"avg_talk_{p.lower()}_6m": f"try_divide(talk_{p.lower()}, cnt_calls_6m - untimed_{p.lower()})"
        for p in DAY_PARTS
    }
    averages |= {f"avg_talk_{w}": f"try_divide(_talk_{w}, _timed_{w})" for w in windows}
    kept = [c for c in swept.columns if c in keys or not c.startswith(("_", "talk_", "untimed_"))]
    return swept.selectExpr(*kept, *[f"{e} as {out}" for out, e in averages.items()])


def call_features(
    calls: DataFrame,
    ctx: RunContext,
    days: int = 180,
    windows: dict[str, Trailing] | None = None,
    tie: list[str] = TIES,
    keep_key: bool = False,
    hot: Hot | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Calls of the last ``days`` days with previous-call and trailing features.

    The windows look back as far as they reach; only the calls that get a row are limited, so a
    nightly run asks for ``days=1`` and sweeps half a year once. Stored days that no window reaches are
    not read, by the literal day key. The previous call may lie further back, within the year of calls that the log
    keeps; that scan reads a few columns. The calls are shuffled once, by phone and client in one key: the window of the previous call and the
    join with the trailing features both find them in place. ``keep_key`` leaves that key
    (``_who``) in the result for further joins.
    """
    keyed = calls.withColumn(WHO_KEY, pair_key())
    windows = windows or WINDOWS
    swept = stored_since(keyed, ctx, days + reach(windows))
    hot = hot or hot_pairs(calls, ctx, days, windows, hot_rows)
    since = ctx.midnight(days)

    # Of the calls before the first wanted one, only the newest of each pair can be a previous call.
    carried = dict.fromkeys([WHO_KEY, TS, *tie, "talk_duration", "code_call_result_type", "interaction_type_code"])
    before = stored_since(keyed, ctx, max(days, HISTORY_DAYS)).where(f"{TS} < {since}").select(*carried)
    before = top_per(before, [WHO_KEY], [F.col(c).desc() for c in (TS, *tie)])
    candidates = stored_since(keyed, ctx, days).where(f"{TS} >= {since}").unionByName(before, allowMissingColumns=True)
    previous = with_previous_call(candidates, [WHO_KEY], tie, hot, hot_rows)
    wanted = previous.where(f"{TS} >= {since}").withColumn("partition_date", day_key(TS))

    features = trailing_features(swept, [WHO_KEY], windows, since, hot, hot_rows)
    out = lookup(wanted, features, [WHO_KEY, TS], in_place=hot.keys is None)
    return out if keep_key else out.drop(WHO_KEY)


def reach(windows: Mapping[str, Trailing]) -> int:
    """Days that the longest window looks back, rounded up; the kept year for one without a start."""
    return max(w.days if w.back else HISTORY_DAYS for w in windows.values())


def stored_since(calls: DataFrame, ctx: RunContext, days: int) -> DataFrame:
    """Calls stored under one of the last ``days`` days, or a little earlier: earlier partitions are not read."""
    return calls.where(F.col("part_date") >= F.lit(ctx.day_key(days + LOOSE_DAYS)))


def hot_pairs(
    calls: DataFrame, ctx: RunContext, days: int, windows: Mapping[str, Trailing] | None = None, hot_rows: int = HOT_ROWS
) -> Hot:
    """Pairs with too many calls among those read; the sweep has a row per window end and call, hence the divisor."""
    read = stored_since(calls, ctx, days + reach(windows or WINDOWS))
    return find_hot(read.select(pair_key().alias(WHO_KEY)), [WHO_KEY], hot_rows // 6)
