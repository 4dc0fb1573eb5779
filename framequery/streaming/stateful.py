"""Streams with typed state and timers: keyframes after a warm-up, and overlapping count windows blended.

Frames of a stream may come in any order and any number a trigger, as long as they aren't later than the
watermark allows: each waits in a map until those before it are there, so what comes out doesn't depend on
the triggers. When the watermark passes a stream's last frame by ``gap``, a timer ends the
stream: what still waits is taken in order, and the last frame is a keyframe whatever it shows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ready(spark: SparkSession) -> None:
    """Typed state needs the state store that keeps column families."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


class InOrder(StatefulProcessor):
    """Hands a stream's frames, numbered from 0, to ``took`` in order; a timer ``gap_ms`` after the last one ends the stream."""

    def __init__(self, gap_ms: int) -> None:
        self.gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "frame long", "value double")
        self.place = handle.getValueState("place", "next long, end long")

    def _in_order(self, key: tuple, next_: int, everything: bool) -> tuple[list[dict], int]:
        """What the frames that can be taken give; at the end also those after a gap."""
        out = []
        if everything:
            for (frame,), (value,) in sorted(self.waiting.iterator()):
                out += self.took(key, frame, value)
                next_ = frame + 1
            self.waiting.clear()
            return out, next_
        while self.waiting.containsKey((next_,)):
            out += self.took(key, next_, self.waiting.getValue((next_,))[0])
            self.waiting.removeKey((next_,))
            next_ += 1
        return out, next_

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        next_, end = self.place.get() or (0, -1)
        last = end
        for b in rows:
            for frame, value, ts in zip(b["frame"].tolist(), b["value"].tolist(), b["ts"], strict=True):
                self.waiting.updateValue((frame,), (value,))
                last = max(last, int(ts.timestamp() * 1000))
        if last > end:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old if isinstance(old, int) else old[0])
            self.handle.registerTimer(last + self.gap_ms)
        out, next_ = self._in_order(key, next_, False)
        self.place.update((next_, last))
        yield self._table(out)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        out, _ = self._in_order(key, (self.place.get() or (0, -1))[0], True)
        out += self.ended(key)
        self.place.clear()
        yield self._table(out)

    def close(self) -> None:
        pass

    def _table(self, out: list[dict]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=self.columns)

    def took(self, key: tuple, frame: int, value: float) -> list[dict]:
        raise NotImplementedError

    def ended(self, key: tuple) -> list[dict]:
        raise NotImplementedError


class Keyframes(InOrder):
    """Frames that differ by more than ``threshold`` from the last one taken; the first ``warm`` frames are judged together."""

    columns = ["stream", "frame"]

    def __init__(self, threshold: float, warm: int, gap_ms: int) -> None:
        super().__init__(gap_ms)
        self.threshold, self.warm = threshold, warm

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "reference double, frame long, taken boolean")
        self.warming = handle.getListState("warming", "frame long, value double")

    def _judge(self, key: tuple, frame: int, value: float) -> list[dict]:
        reference = self.last.get()
        taken = reference is None or abs(value - reference[0]) > self.threshold
        self.last.update((value if taken else reference[0], frame, taken))
        return [{"stream": key[0], "frame": frame}] if taken else []

    def _warmed(self, key: tuple) -> list[dict]:
        held = list(self.warming.get())
        self.warming.clear()
        return [r for frame, value in held for r in self._judge(key, frame, value)]

    def took(self, key: tuple, frame: int, value: float) -> list[dict]:
        if self.last.get() is None and self.warm > 1:
            self.warming.appendValue((frame, value))
            return self._warmed(key) if sum(1 for _ in self.warming.get()) >= self.warm else []
        return self._judge(key, frame, value)

    def ended(self, key: tuple) -> list[dict]:
        out = self._warmed(key)
        last = self.last.get()
        self.last.clear()
        return out + ([{"stream": key[0], "frame": last[1]}] if last and not last[2] else [])


class BlendedWindows(InOrder):
    """Values less the mean of their window of ``length`` frames, blended where windows overlap; a window is worked out when it is full."""

    columns = ["stream", "frame", "value"]

    def __init__(self, length: int, overlap: int, gap_ms: int) -> None:
        super().__init__(gap_ms)
        self.length, self.overlap = length, overlap

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.window = handle.getListState("window", "frame long, value double")
        self.faded = handle.getListState("faded", "frame long, value double, weight double")

    def _worked(self, key: tuple, held: list[tuple], whole: bool) -> list[dict]:
        """A window's frames: those that no later window holds come out, the others wait with their weight."""
        stride = self.length - self.overlap
        first = held[0][0] // stride * stride
        mean = sum(v for _, v in held) / len(held)
        earlier = {frame: (value, weight) for frame, value, weight in self.faded.get()}
        out, fading = [], []
        for frame, value in held:
            at = frame - first
            weight = 1.0
            if first > 0 and at < self.overlap:
                weight = (at + 1) / (self.overlap + 1)
            elif at >= stride:
                weight = 1 - (at - stride + 1) / (self.overlap + 1)
            before = earlier.get(frame, (0.0, 0.0))
            total, share = before[0] + (value - mean) * weight, before[1] + weight
            if at >= stride and not whole:
                fading.append((frame, total, share))
            else:
                out.append({"stream": key[0], "frame": frame, "value": total / share})
        self.faded.clear()
        if fading:
            self.faded.put(fading)
        return out

    def took(self, key: tuple, frame: int, value: float) -> list[dict]:
        self.window.appendValue((frame, value))
        held = list(self.window.get())
        if len(held) < self.length:
            return []
        out = self._worked(key, held, False)
        self.window.put(held[self.length - self.overlap :])
        return out

    def ended(self, key: tuple) -> list[dict]:
        held = list(self.window.get())
        out = []
        while held:
            # frames of the last windows: what a next one would hold is told after this one
            more = held[self.length - self.overlap :]
            out += self._worked(key, held, not more)
            held = more
        self.window.clear()
        self.faded.clear()
        return out


def _run(frames: DataFrame, processor: InOrder, schema: str, late: str) -> DataFrame:
    ready(frames.sparkSession)
    marked = frames.select("stream", "frame", "value", "ts").withWatermark("ts", late)
    return marked.groupBy("stream").transformWithStateInPandas(processor, schema, "Append", "EventTime")


def keyframes(frames: DataFrame, threshold: float, warm: int = 8, late: str = "1 day", gap_ms: int = 0) -> DataFrame:
    """(stream, frame) of the keyframes of streaming (stream, frame, value, ts), frames numbered from 0 in each stream.

    Equal to the batch operator select_keyframes() once all streams have ended. State holds a
    stream's waiting frames, at most ``warm`` of the first, and one reference. Null streams are a stream; a
    frame that comes twice counts once, and one that comes after its stream's end begins the stream anew.
    """
    return _run(frames, Keyframes(threshold, warm, gap_ms), "stream long, frame long", late)


def blended_windows(frames: DataFrame, length: int, overlap: int, late: str = "1 day", gap_ms: int = 0) -> DataFrame:
    """(stream, frame, value): each value less its windows' means, blended as the batch operator blended() does.

    State holds one window of frames and the blended part of the one before.
    """
    return _run(frames, BlendedWindows(length, overlap, gap_ms), "stream long, frame long, value double", late)
