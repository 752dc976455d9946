"""Streams that keep the same state as the batch operators of operators.state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.state import case_months, monthly_state

OUT = "ref_no string, state string, pos long, prop_id string, case_type string, cited string, lat double, lng double"
STATE = "state string, pos long, prop_id string, case_type string, cited string, lat double, lng double"


def _step(key: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
    state = list(held.get) if held.exists else [None] * 7
    rows = pd.concat(list(frames)).sort_values("pos")
    for r in rows.itertuples():
        if r.is_open and r.passes:
            coordinates = [new if not pd.isna(new) else old for new, old in ((r.lat, state[5]), (r.lng, state[6]))]
            state = ["open", int(r.pos), r.prop_id, r.case_type, r.cited, *coordinates]
        elif not r.is_open:
            state[0] = "closed"
    if state[0] is not None:
        state = [None if x is None or (isinstance(x, float) and pd.isna(x)) else x for x in state]
        held.update(tuple(state))
        yield pd.DataFrame([(key[0], *state)], columns=[c.split()[0] for c in OUT.split(", ")])


def ledger_stream(reports: DataFrame) -> DataFrame:
    """Report rows (see state.ledger_merge) to the changed ledger rows of each micro-batch.

    State is one row for each reference and never expires, as a closed case must stay closed
    until it is reported open again. Rows count in the order of pos within a micro-batch, and
    micro-batches in the order in which they come.
    """
    return reports.groupBy("ref_no").applyInPandasWithState(_step, OUT, STATE, "update", GroupStateTimeout.NoTimeout)


def month_sink(path: str, out: str):  # noqa: ANN201
    """For foreachBatch, one micro-batch for each report: adds the report's months to the
    table under path and writes the state of all cases under out/batch=N.

    That a case is gone shows only in a whole report, so a report may not be split. A batch
    that is repeated replaces its own months and changes nothing else.
    """

    def take(batch: DataFrame, number: int) -> None:
        case_months(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")
        months = batch.sparkSession.read.parquet(path).groupBy("case_id", "period").agg(F.max_by("balance", "batch").alias("balance"))
        monthly_state(months).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return take
