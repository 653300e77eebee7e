"""The acquisition ledger as a stream: a region is published once, when its plan is closed and all its files are there."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: kind is need (a region needs a file), done, failed or closed; seq orders events.
EVENTS = "region_id string, seq long, kind string, filename string"
OUT = "region_id string, state string, assets long"
STATE = "waiting array<string>, done array<string>, failed array<string>, closed boolean, published boolean"


def _step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    waiting, done, failed, closed, published = (set(state.get[0]), set(state.get[1]), set(state.get[2]), *state.get[3:]) if state.exists else (set(), set(), set(), False, False)
    for e in pd.concat(frames).sort_values("seq").itertuples():
        if e.kind == "need":
            if closed and e.filename not in waiting | done | failed:
                raise ValueError(f"region {key[0]} is closed and needs no more files")
            if e.filename not in done | failed:
                waiting.add(e.filename)
        elif e.kind == "closed":
            closed = True
        elif e.filename in (failed if e.kind == "done" else done):
            raise ValueError(f"file {e.filename} of region {key[0]} has come and failed")
        elif e.filename in done | failed:
            continue  # a batch that ran again
        else:
            waiting.discard(e.filename)
            (done if e.kind == "done" else failed).add(e.filename)
    ready = closed and not waiting and not published
    state.update((sorted(waiting), sorted(done), sorted(failed), closed, published or ready))
    if ready:
        yield pd.DataFrame([(key[0], "failed" if failed else "ready" if done else "empty", len(done))], columns=["region_id", "state", "assets"])


def publish(events: DataFrame) -> DataFrame:
    """Regions of a stream of EVENTS as they become ready. The state of a region grows with its own files alone."""
    return events.groupBy("region_id").applyInPandasWithState(_step, OUT, STATE, "append", GroupStateTimeout.NoTimeout)


def deliver(events: DataFrame) -> DataFrame:
    """Files of a stream of (filename, seq, kind, region_id) handed to the regions that need them: (filename, region_id, status).

    The first region that asks owns a file and gets its own status; the others, and those that ask after it came, get reused
    for a success. Completing a file twice is an error."""
    return events.groupBy("filename").applyInPandasWithState(_hand_over, "filename string, region_id string, status string", "regions array<string>, status string", "append", GroupStateTimeout.NoTimeout)


def _hand_over(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    regions, status = (list(state.get[0]), state.get[1]) if state.exists else ([], None)
    out = []

    def given(region: str) -> tuple[str, str, str]:
        return key[0], region, status if status == "failed" or region == regions[0] else "reused"

    for e in pd.concat(frames).sort_values("seq").itertuples():
        if e.kind == "need":
            if e.region_id not in regions:
                regions.append(e.region_id)
                if status is not None:
                    out.append(given(e.region_id))
        else:
            if status is not None:
                raise ValueError(f"file {key[0]} is completed twice")
            status = "failed" if e.kind == "failed" else "success"
            out += [given(r) for r in regions]
    state.update((regions, status))
    if out:
        yield pd.DataFrame(out, columns=["filename", "region_id", "status"])
