"""The call budget as a stream: the state of a key is kept between batches."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType

from sievework.operators.quota import BUSY, DONE, SPENT

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Budget(StatefulProcessor):
    """State of a key: calls charged, whether its first model is spent, and the fallbacks that are."""

    def __init__(self, order: list[str], model: str, status: str, first: str, cap: int) -> None:
        self.order, self.model, self.status, self.first, self.cap = order, model, status, first, cap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("budget", "calls long, exhausted boolean, spent array<string>")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        calls, exhausted, spent = self.state.get() if self.state.exists() else (0, False, [])
        spent = list(spent)
        # a batch holds what a trigger takes in; later batches must not bring earlier attempts
        for row in sorted(rows, key=lambda r: [r[c] for c in self.order]):
            first, status = row[self.model] is None or row[self.model] == self.first, row[self.status]
            if exhausted or calls >= self.cap:
                outcome = "refused"
            elif not first and row[self.model] in spent:
                outcome = "skipped"
            elif status == BUSY:
                outcome = "refunded"
            elif status == SPENT and not first:
                outcome = "fallback_spent"
                spent.append(row[self.model])
            else:
                calls += 1
                exhausted = status == SPENT
                outcome = "admitted" if status == DONE else "exhausted" if exhausted else "error"
            yield Row(**row.asDict(), outcome=outcome)
        self.state.update((calls, exhausted, spent))

    def close(self) -> None:
        pass


def outcomes(attempts: DataFrame, key: str, order: list[str], model: str, status: str, first: str, cap: int) -> DataFrame:
    """The outcomes of ``operators.quota`` for a stream of attempts that comes in order from batch to batch. The session's
    state store must be able to hold typed state, so it is set to ``PROVIDER``."""
    attempts.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    shape = StructType([*attempts.schema.fields, StructField("outcome", StringType())])
    return attempts.groupBy(key).transformWithState(Budget(order, model, status, first, cap), shape, "Append", "None")
