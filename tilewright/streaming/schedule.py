"""When requests are sent under both of a model's limits, as a stream whose state outlives restarts.

Requests of a model are sent one after the other.  Each waits until fewer than
`per_minute` of its model were sent in the seconds before, and then until fewer
than `in_flight` are running.  What has to be remembered of a model is the time
at which its last request was sent, the times of its last `per_minute` ones, and
a heap with the ends of the running ones.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SCHEDULE = "model string, request_id long, arrival_us long, submit_us long, start_us long, end_us long"
_STATE = "sent long, times array<bigint>, ends array<bigint>"


@dataclass
class Sender:
    """One model's state; a limit of 0 is none."""

    per_minute: int = 0
    in_flight: int = 0
    window_us: int = 60_000_000
    sent: int = -(1 << 62)
    times: list[int] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)

    def send(self, arrival: int, busy: int) -> tuple[int, int, int]:
        """(when the rate allows it, when it starts, when it ends) of the next request."""
        submit = max(arrival, self.sent)
        if self.per_minute:
            if len(self.times) >= self.per_minute:
                submit = max(submit, self.times.pop(0) + self.window_us)
            self.times.append(submit)
        start = submit
        if self.in_flight:
            if len(self.ends) >= self.in_flight:
                start = max(start, heapq.heappop(self.ends))
            heapq.heappush(self.ends, start + busy)
        self.sent = start
        return submit, start, start + busy


def scheduled(stream: DataFrame, limits: dict[str, tuple[int, int]], default: tuple[int, int] = (10, 0), seconds: int = 60) -> DataFrame:
    """submit_us, start_us and end_us of each request of a stream model, request_id, arrival_us, busy_us.

    limits has (per_minute, in_flight) by model, 0 for none.  The requests of a
    micro-batch are sent by arrival, then id, after those of the batches before;
    one that arrives late is sent when its turn comes.  A null busy_us is 0, and
    requests without an arrival arrive at 0.  A task holds one model's requests
    of one micro-batch, whose size maxFilesPerTrigger bounds, and per_minute and
    in_flight numbers.
    """

    def send(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        per_minute, in_flight = limits.get(key[0], default)
        sender = Sender(per_minute, in_flight, seconds * 1_000_000)
        if state.exists:
            sent, times, ends = state.get
            sender.sent, sender.times, sender.ends = int(sent), [int(t) for t in times], [int(e) for e in ends]
        rows = pd.concat(list(batches)).fillna({"arrival_us": 0, "busy_us": 0}).sort_values(["arrival_us", "request_id"])
        sends = [sender.send(int(a), int(b)) for a, b in zip(rows["arrival_us"], rows["busy_us"], strict=True)]
        state.update((sender.sent, sender.times, sender.ends))
        out = pd.DataFrame(sends, columns=["submit_us", "start_us", "end_us"])
        yield pd.DataFrame({"model": key[0], "request_id": rows["request_id"].to_numpy(), "arrival_us": rows["arrival_us"].to_numpy(), **{c: out[c].to_numpy() for c in out}})

    return stream.groupBy("model").applyInPandasWithState(send, SCHEDULE, _STATE, "append", GroupStateTimeout.NoTimeout)
