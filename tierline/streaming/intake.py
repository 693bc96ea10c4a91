"""Landing -> raw, new files only."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tierline import storage
from tierline.operators import ledger, sinks
from tierline.sources import files
from tierline.spec import DatasetSpec
from tierline.streaming import control


@dataclass
class Intake:
    """Totals of one intake run."""

    batches: int = 0
    files: int = 0
    rows: int = 0
    archived: int = 0
    skipped: int = 0


def ingest_new_files(spark: SparkSession, spec: DatasetSpec, prepare: Callable[[DataFrame], DataFrame]) -> Intake:
    """Bring every file that is new in landing into raw, then stop.

    Per micro-batch: write its rows, record the commit, archive its files, in this order. A
    replay finds either no commit row, and then all files are still there to be read again, or
    the row, and then only the archiving is finished. Files the stream has passed over, such as
    a new file under a name seen before, stay in landing and are counted as skipped. Files of zero
    bytes have no rows; they are counted and archived. The commit rows are read once, as the layer
    has one writer.
    """
    total = Intake()
    run_id = uuid.uuid4().hex
    if spec.archive:
        ledger.remember_files(spec.raw, run_id, files.landing_files(spark, spec))
    seen = {"known": ledger.state(spark, spec.raw)}

    def one_batch(manifest: DataFrame, epoch: int) -> None:
        session = manifest.sparkSession
        members = manifest.collect()  # at most max_files_per_trigger rows
        if not members:
            return
        batch_id = control.batch_identity(manifest, epoch)
        known = seen["known"]
        if not known.has(batch_id):
            staging = ledger.staging_path(spec.raw, batch_id)
            rows = files.read_files(session, spec, [m.path for m in members], known.schema(), staging)
            if rows is not None:
                details = {"files": str(len(members))}
                written = sinks.append_batch(
                    prepare(rows), spec.raw, batch_id, spec.partition_by, spec.optimize_write, parameters=details, known=known
                )
                total.rows += written.rows
                seen["known"] = written.known
            storage.remove(session, staging)
        total.batches += 1
        total.files += len(members)
        if spec.archive:
            total.archived += ledger.archive(session, session.createDataFrame(members, manifest.schema), spec.archive)

    control.run_available(
        files.stream_files(spark, spec), one_batch, spec.checkpoint, control.query_name("landing_to_raw", spec.name)
    )
    if spec.archive:
        before = ledger.remembered_files(spark, spec.raw, run_id)
        moved = ledger.archive(spark, before.where("length = 0"), spec.archive)
        total.files, total.archived = total.files + moved, total.archived + moved
        total.skipped = ledger.still_there(before, files.landing_files(spark, spec)).count()
        ledger.forget_files(spark, spec.raw, run_id)
    return total
