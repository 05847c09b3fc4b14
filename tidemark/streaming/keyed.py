"""Stateful jobs per key: batches by size or time, alerts while nothing arrives, previous images across micro-batches.

All of them are ``applyInPandasWithState``: Spark keeps a small state per key in the checkpoint, so a restart neither loses
nor repeats rows, and wakes a key by processing time although no row of it arrives. That needs a trigger with a time
between batches (``every``): a run over what is there that then stops has no later time to wake at.

Rows wait, and images are kept, as JSON of their columns, whatever these are; they come back typed. Keys must not be null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}

BY_SIZE, BY_TIME = "size", "time"
FIRING, RESOLVED = "FIRING", "RESOLVED"


def _text(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), _JSON)


def _typed(schema: T.StructType, text: str) -> Column:
    return F.from_json(F.col(text), schema, _JSON)


def _fields(df: DataFrame, names: Sequence[str]) -> T.StructType:
    return T.StructType([df.schema[c] for c in names])


def _whole(parts: Iterable[pd.DataFrame]) -> pd.DataFrame | None:
    """The rows of a key in this micro-batch; none when its time has come."""
    frames = [p for p in parts if len(p)]
    if len(frames) < 2:
        return frames[0] if frames else None
    return pd.concat(frames, ignore_index=True)


def _ordered(rows: pd.DataFrame, by: Sequence[str]) -> np.ndarray:
    """Places of the rows in this order, nulls last, ties as they came. Of a key's few rows the set-up of a sort costs most,
    so numbers and times are sorted as they are."""
    values = [rows[c].to_numpy() for c in by]
    if any(v.dtype.kind == "O" for v in values):
        return rows.reset_index(drop=True).sort_values(list(by), kind="stable").index.to_numpy()
    return np.lexsort(values[::-1])


#: Rows that a task puts into a packet (whole batches, one at least), and the characters of rows it holds for that.
PACKET_ROWS, PACKET_CHARS = 10_000, 1 << 24


def batches(events: DataFrame, lane: str | Column, size: int, wait_ms: int) -> DataFrame:
    """Hand on rows in batches of ``size``, or whatever waits once the oldest waiting row is ``wait_ms`` old, whichever comes
    first. Adds ``batch_lane``, ``batch`` (from 0 in each lane) and ``closed_by`` (``size`` or ``time``).

    ``lane`` is what is batched on its own: a destination table, a source partition, or a hash that spreads a busy table
    over several lanes. At most ``size - 1`` rows wait per lane.

    The tasks that read the rows put those of a lane into compressed packets of whole batches. The one task with the lane's state
    numbers the packets and opens only those of rows left over; other tasks open the rest. Spark hands it all packets that a lane
    has in a micro-batch at once, so their bytes have to fit its memory, and are 2 GB at most.
    """
    if size < 1 or wait_ms < 1:
        raise ValueError("size and wait_ms are at least 1")
    name = F.col(lane) if isinstance(lane, str) else lane
    rows = events.select(name.cast("string").alias("lane"), _text(events.columns).alias("row"))
    enough = max(1, PACKET_ROWS // size) * size

    def tight(texts: list[str]) -> bytes:  # a row's JSON has no line breaks
        return zlib.compress("\n".join(texts).encode(), 1)

    def loose(packet: bytes) -> list[str]:
        return zlib.decompress(packet).decode().split("\n")

    def pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, chars = {}, 0

        def frames(groups: Iterable[tuple[str | None, list[str]]]) -> Iterator[pd.DataFrame]:
            made = ((of, len(texts), tight(texts)) for of, texts in groups)
            while some := list(islice(made, 1000)):
                yield pd.DataFrame(some, columns=["lane", "n", "packet"])

        def everything() -> Iterator[tuple[str | None, list[str]]]:
            for of, texts in held.items():
                cut = len(texts) // size * size
                yield from ((of, some) for some in (texts[:cut], texts[cut:]) if some)

        for part in filter(len, parts):
            codes, names = pd.factorize(part["lane"])
            texts, order, full = part["row"].to_numpy(), np.argsort(codes, kind="stable"), []
            for places in np.split(order, np.flatnonzero(np.diff(codes[order])) + 1):
                code, more = codes[places[0]], texts[places].tolist()
                of = None if code < 0 else names[code]
                mine = held.setdefault(of, [])
                mine += more
                chars += sum(map(len, more))
                if len(mine) >= enough:
                    cut = len(mine) // size * size
                    full.append((of, mine[:cut]))
                    chars -= sum(map(len, mine[:cut]))
                    del mine[:cut]
            yield from frames(full)
            if chars > PACKET_CHARS:
                yield from frames(everything())
                held, chars = {}, 0
        yield from frames(everything())

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting, since, batch = state.get if state.exists else ([], 0, 0)
        waiting, now = list(waiting), state.getCurrentProcessingTimeMs()
        old = len(waiting) > 0  # rows of an earlier micro-batch go first

        def frame(why: str, packet: bytes) -> pd.DataFrame:
            return pd.DataFrame({"lane": [key[0]], "batch": [batch], "closed_by": [why], "packet": [packet]})

        for part in () if state.hasTimedOut else parts:
            for n, packet in zip(part["n"].tolist(), part["packet"]):
                if n % size == 0 and not old:
                    yield frame(BY_SIZE, packet)
                    batch += n // size
                    continue
                since = since if waiting else now
                waiting += loose(packet)
                if cut := len(waiting) // size * size:
                    yield frame(BY_SIZE, tight(waiting[:cut]))
                    waiting, since, batch, old = waiting[cut:], now, batch + cut // size, False  # what is left came just now
        if waiting and (state.hasTimedOut or now >= since + wait_ms):
            yield frame(BY_TIME, tight(waiting))
            waiting, batch = [], batch + 1
        state.update((waiting, since, batch))
        if waiting:
            state.setTimeoutDuration(max(1, since + wait_ms - now))

    def unpack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = {"lane": [], "batch": [], "closed_by": [], "row": []}
        for part in parts:
            for of, first, why, packet in zip(part["lane"], part["batch"].tolist(), part["closed_by"], part["packet"]):
                texts = loose(packet)
                n = len(texts)
                for column, values in zip(out.values(), ([of] * n, [first + k // size for k in range(n)], [why] * n, texts)):
                    column += values
                if len(out["row"]) >= PACKET_ROWS:
                    yield pd.DataFrame(out)
                    out = {column: [] for column in out}
        if out["row"]:
            yield pd.DataFrame(out)

    packets = rows.mapInPandas(pack, "lane string, n bigint, packet binary").groupBy("lane").applyInPandasWithState(
        run, "lane string, batch bigint, closed_by string, packet binary", "waiting array<string>, since bigint, batch bigint",
        "append", GroupStateTimeout.ProcessingTimeTimeout,
    )
    # Spark can't shuffle what comes out of the state as it is, so the place is computed
    spread = packets.withColumn("place", F.xxhash64("lane", "batch")).repartition("place")
    closed = spread.mapInPandas(unpack, "lane string, batch bigint, closed_by string, row string")
    return closed.select("lane", "batch", "closed_by", _typed(events.schema, "row").alias("r")).select("r.*", F.col("lane").alias("batch_lane"), "batch", "closed_by")


ALERT = "key string, status string, at_ms bigint, value double"


def _alerts(df: DataFrame) -> DataFrame:
    return df.select("key", "status", F.timestamp_millis("at_ms").alias("at"), "value")


def silence(events: DataFrame, by: str | Column, quiet_ms: int) -> DataFrame:
    """Live form of the staleness check: ``key, status, at, value``. A key without events for ``quiet_ms`` gives a
    ``FIRING`` row by the clock alone, and the next event a ``RESOLVED`` one. ``value`` is the seconds of silence."""
    rows = events.select((F.col(by) if isinstance(by, str) else by).cast("string").alias("key"))

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        seen, firing = state.get if state.exists else (now, False)
        if state.hasTimedOut:
            state.update((seen, True))  # no further timer: it stays silent until an event comes
            yield pd.DataFrame({"key": [key[0]], "status": [FIRING], "at_ms": [now], "value": [(now - seen) / 1000]})
            return
        for _ in parts:
            pass
        state.update((now, False))
        state.setTimeoutDuration(quiet_ms)
        if firing:
            yield pd.DataFrame({"key": [key[0]], "status": [RESOLVED], "at_ms": [now], "value": [(now - seen) / 1000]})

    found = rows.groupBy("key").applyInPandasWithState(run, ALERT, "seen bigint, firing boolean", "append", GroupStateTimeout.ProcessingTimeTimeout)
    return _alerts(found)


def sustained(events: DataFrame, by: str | Column, value: str, ts: str, threshold: float, hold_ms: int) -> DataFrame:
    """Live form of the sustained threshold: ``key, status, at, value``. A key whose latest ``value`` (by ``ts``) has been above the
    threshold for ``hold_ms`` gives a ``FIRING`` row, also while nothing arrives, and the first value at or below it a
    ``RESOLVED`` one. Null values change nothing."""
    name = F.col(by) if isinstance(by, str) else by
    rows = events.select(name.cast("string").alias("key"), F.col(value).cast("double").alias("value"), F.unix_micros(F.col(ts).cast("timestamp")).alias("at"))

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        since, firing, last, last_at = state.get if state.exists else (-1, False, 0.0, -(2**62))
        out = []

        def tell(status: str) -> None:
            out.append((key[0], status, now, last))

        new = None if state.hasTimedOut else _whole(parts)
        if new is not None:
            for v, at in new.dropna(subset=["value", "at"]).sort_values("at", kind="stable")[["value", "at"]].itertuples(index=False):
                if at < last_at:
                    continue  # older than what is known
                last, last_at = float(v), int(at)
                if last > threshold:
                    since = now if since < 0 else since
                else:
                    if firing:
                        tell(RESOLVED)
                    since, firing = -1, False
        if since >= 0 and not firing and now >= since + hold_ms:
            firing = True
            tell(FIRING)
        state.update((since, firing, last, last_at))
        if since >= 0 and not firing:
            state.setTimeoutDuration(max(1, since + hold_ms - now))
        if out:
            yield pd.DataFrame(out, columns=["key", "status", "at_ms", "value"])

    kept = "since bigint, firing boolean, last double, last_at bigint"
    return _alerts(rows.groupBy("key").applyInPandasWithState(run, ALERT, kept, "append", GroupStateTimeout.ProcessingTimeTimeout))


def previous_image(changes: DataFrame, keys: Sequence[str], order_by: Sequence[str], columns: Sequence[str], keep_ms: int | None = None) -> DataFrame:
    """Add ``before``: the ``columns`` of the key's preceding change, across micro-batches; null for its first one.

    Changes of a key are put in order inside a micro-batch; one that arrives after a later one of an earlier micro-batch
    follows it all the same. The state is one image per key, forgotten when the key was quiet for ``keep_ms``. As in a batch, with
    events in order, whatever the cuts between micro-batches.
    """
    image = _fields(changes, columns)
    order = [f"o{n}" for n in range(len(order_by))]
    rows = changes.select(
        *[F.col(k).alias(f"k{n}") for n, k in enumerate(keys)],
        *[F.col(o).alias(n) for o, n in zip(order_by, order)],
        _text(changes.columns).alias("row"),
        _text(columns).alias("image"),
    )

    def run(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        new = _whole(parts)
        if new is None:
            return
        places = _ordered(new, order)
        before = [state.get[0] if state.exists else None, *new["image"].to_numpy()[places]]
        state.update((before[-1],))
        if keep_ms is not None:
            state.setTimeoutDuration(keep_ms)
        yield pd.DataFrame({"row": new["row"].to_numpy()[places], "before": np.array(before[:-1], object)})

    timer = GroupStateTimeout.NoTimeout if keep_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    out = rows.groupBy(*[f"k{n}" for n in range(len(keys))]).applyInPandasWithState(run, "row string, before string", "image string", "append", timer)
    return out.select(_typed(changes.schema, "row").alias("r"), _typed(image, "before").alias("before")).select("r.*", "before")
