"""Operators that remember something per key between micro-batches.

Native deduplication and window aggregation are used where they can say it. The rest keep a small value per key: keys are dealt into
buckets, and a bucket's rows of a micro-batch are worked on as columns, against the bucket's known values, which are read and written
as one Arrow table. Rows travel as one opaque text that Spark packs and unpacks, so only keys, times and what rows are ordered by
are looked at in Python, and measures change sign natively.

Outputs do not depend on the order in which rows reach a task, nor, for first_of_day and login_marks, on how rows are dealt into files
and batches: an earlier row that comes later takes back what was sent before. Rows behind the watermark are dropped. What is known of a key is forgotten
`ttl` of event time after its last row.

A bucket's known values are rewritten whenever it has rows, so `buckets` should grow with the number of keys within `ttl`: about 100,000 keys
in a bucket keep a rewrite within a second. A bucket's rows of a micro-batch are in a worker's memory at once, so it should also grow with the
rows of a micro-batch (buckets_for). It is fixed by a job's checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from terrace.streaming.bounded import watermark

BUCKETS = 64
ROWS_PER_BUCKET = 25_000
DAY_US = 86_400_000_000
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def buckets_for(rows: int) -> int:
    """How many buckets `rows` rows need, where a micro-batch may bring them all: a worker holds those of one bucket at a time."""
    return max(BUCKETS, -(-rows // ROWS_PER_BUCKET))


def drop_repeats(df: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Exact removal of repeats that arrive within `delay` of each other, with bounded state."""
    return watermark(df, ts, delay).dropDuplicatesWithinWatermark(list(keys))


def emit_last(df: DataFrame, key: str, ts: str, delay: str, lateness: str, order: Sequence[str]) -> DataFrame:
    """Newest version of a record per `delay` interval, emitted once when the interval has passed."""
    rest = [c for c in df.columns if c != key]
    return (watermark(df, ts, lateness).groupBy(F.window(ts, delay), key)
            .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")).select(key, "_last.*").select(*df.columns))


class _Bucketed(StatefulProcessor):
    """Known values of a bucket's keys, and what its rows of a micro-batch make of them.

    Rows have `_key`, `_row` (the packed row), `_us` (event time in microseconds), `_day` (days since 1970) and `_o0`, `_o1`, .. to be
    ordered by, computed by Spark and never null.
    """

    added: tuple[str, ...] = ()

    def __init__(self, orders: int, ttl_us: int | None):
        self.orders, self.ttl_us = [f"_o{i}" for i in range(orders)], ttl_us

    columns: tuple[str, ...] = ()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("known", T.StructType([T.StructField("table", T.BinaryType())]))

    def step(self, rows, known):
        """(output with `_row`, `_us` and the added columns, values known from now on with `_us`) from rows and known values (or None)."""
        raise NotImplementedError

    def expired(self, known, now_us: int):
        """Which known values no row that is still accepted can need."""
        return known["_us"] < now_us - self.ttl_us if self.ttl_us is not None else None

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd
        import pyarrow as pa

        now_us = (max(timerValues.getCurrentWatermarkInMs(), 0) + 1) * 1000  # earlier rows are late, and must not be sent on
        batch = pd.concat(list(rows), ignore_index=True).set_axis(self.columns, axis=1)  # they come by position
        timeless = batch[batch["_us"] < 0]
        batch = batch[(batch["_us"] >= now_us) | (now_us == 1000) & (batch["_us"] >= 0)]
        held = self.state.get()
        known = pa.ipc.open_stream(held[0]).read_pandas() if held is not None else None
        if len(batch):
            out, known = self.step(batch, known)
            gone = self.expired(known, now_us)
            known = known if gone is None else known[~gone]
            table, sink = pa.Table.from_pandas(known, preserve_index=False), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            self.state.update((sink.getvalue().to_pybytes(),))
            if self.ttl_us is not None:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer[0] if isinstance(timer, tuple) else timer)
                self.handle.registerTimer((int(max(known["_us"].max() if len(known) else 0, batch["_us"].max())) + self.ttl_us) // 1000 + 1)
            yield self.finished(out.assign(_us=out["_us"].clip(lower=now_us)))
        if len(timeless):
            yield self.finished(self.untimed(timeless).assign(_us=now_us))

    def untimed(self, rows):
        raise ValueError("rows without a time")

    def finished(self, out):
        import pandas as pd

        out = out[["_row", "_us", *self.added]].rename(columns={"_us": "_time"})
        return out.assign(_time=pd.to_datetime(out["_time"], unit="us").astype("datetime64[us]"))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


class _FirstOfDay(_Bucketed):
    """The earliest row of each key and day, and whether the key's day before that with a row was `back_days` or more earlier."""

    added = ("_sign", "_back")

    def __init__(self, orders: int, ttl_us: int | None, back_days: int | None):
        super().__init__(orders, ttl_us)
        self.back_days = back_days

    def step(self, rows, known):
        import pandas as pd

        order = ["_key", "_day", "_us", *self.orders]
        rows = rows[[*order, "_row"]].assign(_new=1)
        both = rows if known is None else pd.concat([known.assign(_new=0), rows], ignore_index=True)
        best = both.sort_values([*order, "_new"], kind="stable").drop_duplicates(["_key", "_day"])
        back = 0
        if self.back_days is not None:
            same = best["_key"] == best["_key"].shift()
            back = (same & (best["_day"] - best["_day"].shift() >= self.back_days)).astype("int64")
        best = best.assign(_was=best.get("_back", 0), _back=back)
        changed = best[(best["_new"] == 1) | (best["_was"] != best["_back"])]
        out = changed.assign(_sign=1)
        if known is not None:
            again = known.merge(changed[["_key", "_day"]], on=["_key", "_day"])
            out = pd.concat([again.assign(_sign=-1), out], ignore_index=True)
        return out, best[[*order, "_row", "_back"]]

    def expired(self, known, now_us):
        over = (known["_day"] + 1) * DAY_US <= now_us  # no row of that day is accepted any more
        if self.back_days is None:
            return over
        newest_over = over & (known["_day"] == known["_day"].where(over).groupby(known["_key"]).transform("max"))
        old = known["_us"] < now_us - self.ttl_us if self.ttl_us is not None else False
        return over & (old | ~newest_over)


class _IsNew(_Bucketed):
    added = ("_flag",)

    def step(self, rows, known):
        import pandas as pd

        rows = rows.sort_values(["_key", *self.orders], kind="stable")
        first = rows.drop_duplicates("_key")
        # A key first met with flag 0 was there before: it counts as seen the day before.
        first = pd.DataFrame({"_key": first["_key"], "_day": first["_day"] - (first["_flag"] != "1")})
        last = rows.groupby("_key", as_index=False)["_us"].max()
        now = first.merge(last, on="_key")
        if known is not None:
            now = pd.concat([known, now], ignore_index=True)
            now = now.groupby("_key", as_index=False, sort=False).agg({"_day": "first", "_us": "max"})
        day = rows["_key"].map(now.set_index("_key")["_day"])
        new = (rows["_flag"] == "1") & (rows["_day"] == day)
        return rows.assign(_flag=new.map({True: "1", False: "0"})), now

    def untimed(self, rows):
        return rows


class _Newest(_Bucketed):
    def step(self, rows, known):
        import pandas as pd

        rows = rows.sort_values(["_key", *self.orders], kind="stable")
        before = rows["_key"].map(known.set_index("_key")["_us"]).fillna(-1).astype("int64") if known is not None else -1
        best = rows.groupby("_key")["_us"].cummax()
        passed = best.groupby(rows["_key"]).shift(fill_value=-1)
        out = rows[(rows["_us"] > passed) & (rows["_us"] > before)]
        now = out[["_key", "_us"]] if known is None else pd.concat([known, out[["_key", "_us"]]], ignore_index=True)
        return out, now.groupby("_key", as_index=False, sort=False)["_us"].max()


class _Retract(_Bucketed):
    added = ("_sign",)

    def step(self, rows, known):
        import pandas as pd

        rows = rows.sort_values(["_key", *self.orders], kind="stable")
        before = rows.groupby("_key")["_row"].shift()
        if known is not None:
            before = before.fillna(rows["_key"].map(known.set_index("_key")["_row"]))
        undo = rows.assign(_row=before)[before.notna()]
        now = rows.drop_duplicates("_key", keep="last")[["_key", "_row", "_us"]]
        if known is not None:
            now = pd.concat([known, now], ignore_index=True).drop_duplicates("_key", keep="last")
        return pd.concat([undo.assign(_sign=-1), rows.assign(_sign=1)], ignore_index=True), now


def _places(order: Sequence[str], types: dict[str, T.DataType]) -> list[Column]:
    """What rows are ordered by, nulls first: for each column whether it holds a value, and the value."""
    out = []
    for c in order:
        kind = types[c]
        if isinstance(kind, T.TimestampType):
            value = F.unix_micros(c)
        elif isinstance(kind, (T.IntegralType, T.BooleanType)):
            value = F.col(c).cast("long")
        elif isinstance(kind, T.DateType):
            value = F.unix_date(c).cast("long")
        else:
            value = F.col(c)
        filler = F.lit("") if isinstance(kind, T.StringType) else F.lit(0).cast(kind if isinstance(kind, (T.FractionalType,)) else "long")
        out += [F.col(c).isNotNull().cast("int"), F.coalesce(value, filler)]
    return out


def _first_in_batches(rows: DataFrame, orders: int) -> DataFrame:
    """The earliest row per key and day of every Arrow batch, before the shuffle: a key that has most of the rows leaves few of them."""
    order = ["_key", "_day", "_us", *(f"_o{i}" for i in range(orders))]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            frame = pa.Table.from_batches([batch]).to_pandas()
            yield from pa.Table.from_pandas(frame.sort_values(order, kind="stable").drop_duplicates(["_key", "_day"]), batch.schema, preserve_index=False).to_batches()

    return rows.mapInArrow(run, rows.schema)


def _transform(df: DataFrame, keys: Sequence[str], processor, ts: str, delay: str, order: Sequence[str], buckets: int, flag: str | None = None, firsts: bool = False) -> DataFrame:
    """The rows of df that a processor returns, with the columns it adds.

    Rows without an event time have no place in the order of a key. With a `flag` they go through, as do rows whose key is null; otherwise
    callers send them elsewhere, and here they are dropped.
    """
    places = _places(order, {f.name: f.dataType for f in df.schema.fields})
    bare = processor(len(places))
    rows = watermark(df, ts, delay)
    key, us, row = F.to_json(F.struct(*keys)), F.unix_micros(ts), F.to_json(F.struct(*df.columns), JSON)
    if flag:
        whole = F.col(ts).isNotNull()
        for k in keys:
            whole = whole & F.col(k).isNotNull()
        us = F.when(whole, us).otherwise(F.lit(-1).cast("long"))
    else:
        rows = rows.where(F.col(ts).isNotNull())
        whole = F.lit(True)
    packed = rows.select(key.alias("_key"), us.alias("_us"), F.when(whole, F.unix_date(F.to_date(ts))).otherwise(0).cast("long").alias("_day"),
                         *(p.alias(f"_o{i}") for i, p in enumerate(places)), row.alias("_row"), *([F.col(flag).cast("string").alias("_flag")] if flag else []))
    if firsts:
        packed = _first_in_batches(packed, len(places))
    spread = F.when(F.col("_us") >= 0, F.xxhash64("_key")).otherwise(F.xxhash64("_row"))
    kinds = {"_flag": "string", "_sign": "int", "_back": "long"}
    schema = ", ".join(["_row string", "_time timestamp", *(f"{c} {kinds[c]}" for c in bare.added)])
    dealt = packed.withColumn("_bucket", F.pmod(spread, F.lit(buckets)).cast("int"))
    bare.columns = tuple(dealt.columns)
    out = dealt.groupBy("_bucket").transformWithStateInPandas(
        statefulProcessor=bare, outputStructType=schema, outputMode="Append", timeMode="EventTime", eventTimeColumnName="_time")
    whole_row = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    out = out.withColumn("_doc", F.from_json("_row", whole_row, JSON))
    moment = F.col("_time") if not flag else F.col(f"_doc.{ts}")
    return out.select(*(moment.alias(c) if c == ts else (F.col("_flag").alias(c) if c == flag else F.col(f"_doc.{c}").alias(c)) for c in df.columns),
                      *(c for c in bare.added if c != "_flag"))


def _us(ttl: str | None) -> int | None:
    """'10 seconds', '1 day' and the like in microseconds."""
    if ttl is None:
        return None
    number, unit = ttl.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")] * 1_000_000


def first_of_day(df: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 day", order: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """The earliest row per key and day, with delta = 1, as soon as it is seen.

    If an earlier one comes in a later batch, the row sent before comes again with delta = -1, at its own time, whose window is still
    open as the earlier row is not late. So sums of delta, in windows or per row (settled), are the same for every layout of the input.
    `delay` bounds lateness only; a key is remembered until its day is over. Rows of equal time follow `order`.
    """
    out = _transform(df, keys, lambda n: _FirstOfDay(n, 2 * DAY_US, None), ts, delay, list(order), buckets, firsts=True)
    return out.drop("_back").withColumnRenamed("_sign", "delta")


def settled(df: DataFrame, delta: str = "delta") -> DataFrame:
    """Rows of first_of_day, once written, without those that were taken back."""
    rest = [c for c in df.columns if c != delta]
    return df.groupBy(*rest).agg(F.sum(delta).alias(delta)).where(F.col(delta) != 0).select(*rest)


def login_marks(df: DataFrame, key: str, ts: str, delay: str, back_days: int = 8, ttl: str | None = "400 days", order: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """First login of each day with uu = 1, and back = 1 when the login day before is `back_days` or more earlier.

    What an earlier login in a later batch changes is taken back by rows of negative marks, as in first_of_day. A user who stays away for longer than `ttl`
    is forgotten, and comes as new.
    """
    out = _transform(df, [key], lambda n: _FirstOfDay(n, _us(ttl), back_days), ts, delay, list(order), buckets, firsts=True)
    return out.withColumns({"uu": F.col("_sign").cast("long"), "back": F.col("_sign") * F.col("_back")}).drop("_sign", "_back")


def repair_is_new(df: DataFrame, key: str, flag: str, ts: str, delay: str, ttl: str | None = "400 days", order: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """Correct a client's "new visitor" flag: 1 only on the day the key was first seen. Rows without key or time go through as they are."""
    return _transform(df, [key], lambda n: _IsNew(n, _us(ttl)), ts, delay, order or [ts], buckets, flag=flag)


def newest_only(df: DataFrame, keys: Sequence[str], ts: str, delay: str, ttl: str | None = "1 day", order: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """Rows whose time is later than every time seen before for their key, in the order of arrival or of `order`."""
    return _transform(df, keys, lambda n: _Newest(n, _us(ttl)), ts, delay, list(order), buckets)


def hand_over(snapshot: DataFrame, changes: DataFrame, delay: str, key: str = "id", ttl: str | None = "1 day", buckets: int = BUCKETS) -> DataFrame:
    """Change records of tables from an initial snapshot on.

    The snapshot is read as records of op r with the time of each row's version, while changes are recorded from a position before it was read. Where
    both hold a version of a row, it goes on once; a change that is older than the row's snapshot is in it and is dropped, also if it
    comes later. `delay` must cover the time between the position and the end of the snapshot.
    """
    known = F.coalesce(F.col("after")[key], F.col("before")[key])
    rows = snapshot.unionByName(changes).withColumns({"_table": F.col("source")["table"], "_id": known, "_at": F.timestamp_millis("ts_ms"), "_last": (F.col("op") != "r").cast("int")})
    return newest_only(rows, ["_table", "_id"], "_at", delay, ttl, ["_last", "_at"], buckets).drop("_table", "_id", "_at", "_last")


def retract_dedup(df: DataFrame, key: str, measures: Sequence[str], ts: str, delay: str, ttl: str | None = "1 day", order: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """When a record comes again, take the old version back (negated measures, at the time of the new one) and add the new one.

    Sums over the output count every record once, in its newest version, as long as versions come within `ttl` of each other.
    """
    out = _transform(df, [key], lambda n: _Retract(n, _us(ttl)), ts, delay, order or [ts], buckets)
    types = {f.name: f.dataType for f in df.schema.fields}
    return out.withColumns({c: (F.col(c) * F.col("_sign")).cast(types[c]) for c in measures}).drop("_sign")
