"""Raw -> bronze for raw directories that a stream fills."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tierline.operators import ledger, sinks
from tierline.spec import BronzeSpec
from tierline.streaming import control


@dataclass
class Promotion:
    """Totals of one streaming promotion."""

    batches: int = 0
    rows: int = 0


def stream_bronze(raw: DataFrame, bronze: BronzeSpec, derive: Callable[[DataFrame], DataFrame], name: str) -> Promotion:
    """K5: append what is new in a raw stream to bronze, then stop.

    The micro-batch id names the bronze batch, so a replay finds its commit row and adds
    nothing.
    """
    total = Promotion()

    def one_batch(df: DataFrame, epoch: int) -> None:
        batch_id = control.batch_identity(df, epoch)
        known = ledger.state(df.sparkSession, bronze.path)
        if known.has(batch_id):
            return
        total.rows += sinks.write_bronze(derive(df), bronze, batch_id, known=known).rows
        total.batches += 1

    sinks.align_table(raw.sparkSession, bronze)
    control.run_available(raw, one_batch, bronze.checkpoint, control.query_name("raw_to_bronze", name))
    return total
