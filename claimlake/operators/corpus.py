"""Catalogues, queues and logs: categories, buckets, priorities, guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lexicons import CATEGORIES
from .ordinal import rolling_mean, running_total, with_ordinal, with_previous


def categorize(title: Column, rules: tuple[tuple[str, tuple[str, ...]], ...] = CATEGORIES, override: Column | None = None) -> Column:
    """The first category one of whose words the title contains, unless overridden; UNKNOWN if none does."""
    low, out = F.lower(title), F.when(F.lit(False), "")
    for name, words in rules:
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(low, F.lit(word))
        out = out.when(hit, name)
    out = out.otherwise("UNKNOWN")
    return out if override is None else F.coalesce(override, out)


def tag_topics(text: Column, patterns: tuple[tuple[str, str], ...]) -> Column:
    """Names of all patterns that the lower-case text matches."""
    tagged = F.array(*(F.struct(F.lit(name).alias("name"), F.lower(text).rlike(pattern).alias("hit")) for name, pattern in patterns))
    return F.transform(F.filter(tagged, lambda x: x["hit"]), lambda x: x["name"])


def build_queue(rows: DataFrame, strategy: str, category_order: tuple[str, ...] = ()) -> DataFrame:
    """Adds position from 1. Columns: ord (input order), category, view_count, upload_date; only what orders the queue is sorted, and ord joins it back."""
    rank = F.lit(99)
    for i, name in reversed(list(enumerate(category_order))):
        rank = F.when(F.col("category") == name, i).otherwise(rank)
    first = {"mentorship_first": [rank, -F.col("view_count")], "chronological": [F.col("upload_date")], "views": [-F.col("view_count")]}.get(strategy, [])
    keys = [f"key{i}" for i in range(len(first))]
    light = rows.select("ord", *(c.alias(k) for k, c in zip(keys, first, strict=True)))
    order = [F.col(k).asc_nulls_last() if strategy != "chronological" else F.col(k) for k in keys]
    return rows.join(with_ordinal(light, [*order, F.col("ord")], "position").select("ord", "position"), "ord")


def top_per(rows: DataFrame, by: str, order: list[Column], n: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= n)


def cost_guard(log: DataFrame, session_limit: float, daily_limit: float, halt: bool = True) -> DataFrame:
    """Running cost of the session and of the day over all sessions, what remains, and a halt of the session that stays once a limit is reached.

    Costs add up exactly, to a millionth. Days and sessions of any size are dealt over several tasks; other columns than event_id, ts, session and cost join their rows afterwards.
    """
    order = ["ts", "event_id"]
    cost = F.coalesce(F.col("cost").cast("decimal(18,6)"), F.lit(0))
    totals = running_total(log.select(*order, "session", "cost", F.to_date("ts").alias("day")), "day", order, cost, "daily_total")
    totals = running_total(totals, "session", order, cost, "session_total").withColumns({c: F.col(c).cast("double") for c in ("daily_total", "session_total")})
    out = _with_others(totals, log)
    over = (F.col("session_total") >= session_limit) | (F.col("daily_total") >= daily_limit)
    first = out.where(over & F.lit(halt)).groupBy(F.col("session").alias("__of")).agg(F.min(F.struct(*order)).alias("__first"))
    met = out.join(first, F.col("session").eqNullSafe(F.col("__of")), "left")
    halted = F.coalesce(F.struct(*order) >= F.col("__first"), F.lit(False))
    return met.withColumns({"remaining": F.greatest(F.lit(0.0), F.round(session_limit - F.col("session_total"), 6)), "halted": halted}).drop("__of", "__first")


def guard_status(log: DataFrame, turns: int | None = 20, stall_minutes: float | None = 5, limits: tuple[float, float] | None = (0.5, 1.0)) -> DataFrame:
    """(session, turns_ok, active, within_cost, allowed): what each guard says of a session; one that is None is off and always agrees."""
    yes, sessions = F.lit(True), log.select("session").distinct()
    out = sessions.withColumns({"turns_ok": yes, "active": yes, "within_cost": yes})
    if turns is not None:
        count = log.groupBy("session").agg(F.count(F.lit(1)).alias("n"))
        out = out.join(count, "session").withColumn("turns_ok", F.col("n") < turns).drop("n")
    if stall_minutes is not None:
        stalled = stall_guard(log.select("event_id", "ts", "session"), stall_minutes).groupBy("session").agg(F.bool_or("stalled").alias("stalled"))
        out = out.join(stalled, "session").withColumn("active", ~F.col("stalled")).drop("stalled")
    if limits is not None:
        halted = cost_guard(log.select("event_id", "ts", "session", "cost"), *limits).groupBy("session").agg(F.bool_or("halted").alias("halted"))
        out = out.join(halted, "session").withColumn("within_cost", ~F.col("halted")).drop("halted")
    return out.withColumn("allowed", F.col("turns_ok") & F.col("active") & F.col("within_cost"))


def gates(found: DataFrame, least: int = 10, rejection: tuple[float, float] = (0.1, 0.3), most_errors: float = 0.05) -> DataFrame:
    """Adds to (total, rejected, error_rate) the rejection rate, a verdict for each gate, and whether all pass."""
    rate = F.col("rejected") / F.greatest("total", F.lit(1))
    told = lambda ok, text: F.when(ok, "PASS").otherwise(F.concat(F.lit("FAIL ("), text, F.lit(")")))
    percent = lambda c, form: F.format_string(form, 100 * c)
    out = found.withColumns({"signatures": told(F.col("total") >= least, F.col("total").cast("string")), "rejection": told(rate.between(*rejection), percent(rate, "%.0f%%")), "jargon": told(F.col("error_rate") <= most_errors, percent(F.col("error_rate"), "%.1f%%"))})
    return out.withColumns({"rate": F.round(rate, 4), "all_pass": (F.col("signatures") == "PASS") & (F.col("rejection") == "PASS") & (F.col("jargon") == "PASS")})


def _with_others(found: DataFrame, log: DataFrame) -> DataFrame:
    """What was found of the rows of a log with the columns that weren't sorted along, by the row's id, which is unique then."""
    others = [c for c in log.columns if c not in found.columns]
    return found.join(log.select("event_id", *others), "event_id") if others else found


def _in_session(log: DataFrame) -> DataFrame:
    """Rows with their number in the session and the time, in microseconds, of the row before; sessions of any size are dealt over several tasks."""
    light = log.select("session", "ts", "event_id").withColumn("us", F.unix_micros("ts"))
    return _with_others(with_previous(light, "session", ["ts", "event_id"], "us", "us_before", "turn"), log)


def turn_guard(log: DataFrame, warn: int = 15, most: int = 20) -> DataFrame:
    """Adds the row's turn in its session, whether it is a warning or a halt, and the share of turns used."""
    out = _in_session(log).withColumn("turn", F.col("turn").cast("int")).drop("us", "us_before")
    return out.withColumns({"state": F.when(F.col("turn") >= most, "HALT").when(F.col("turn") >= warn, "WARN").otherwise("OK"), "pct_used": F.round(F.col("turn") * 100.0 / most, 1)})


def stall_guard(log: DataFrame, minutes: float = 5) -> DataFrame:
    """Adds the seconds since the session's row before, and whether these are a stall."""
    out = _in_session(log).withColumn("gap_s", F.round((F.col("us") - F.col("us_before")) / 1e6, 3)).drop("us", "us_before", "turn")
    return out.withColumn("stalled", F.coalesce(F.col("gap_s") >= minutes * 60, F.lit(False)))


def drift_alert(verdicts: DataFrame, order: list[str], size: int = 100, least: float = 0.05) -> DataFrame:
    """Adds the share of rejections (column verdict) over the last `size` rows in a total order, and whether it is too low to be trusted; the first size - 1 rows never alarm."""
    rejected = (F.col("verdict") == "REJECT").cast("double")
    light = with_ordinal(verdicts.select(*order, "verdict"), [F.col(c) for c in order], "place")
    out = rolling_mean(light, ["place"], rejected, size, "share").withColumn("drifting", (F.col("place") >= size) & (F.col("share") < least))
    return out


def silent_rejections(verdicts: DataFrame, time: str, at: str, hours: int = 24) -> DataFrame:
    """One row (last_rejection, silent): whether no rejection was made in the hours before a time."""
    last = F.max(F.when(F.col("verdict") == "REJECT", F.col(time)))
    return verdicts.agg(last.alias("last_rejection")).withColumn("silent", F.coalesce(F.unix_micros(F.lit(at).cast("timestamp")) - F.unix_micros("last_rejection") >= hours * 3_600_000_000, F.lit(True)))


def last_n(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The last n rows; a distributed top-n, not a sort of all."""
    return rows.orderBy(*order).limit(n)
