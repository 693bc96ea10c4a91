"""Gaps, repeats and late messages, followed over micro-batches."""

import random
import time

import numpy as np
import pytest

from tierline.streaming import continuity as c
from tierline.streaming import control

from .conftest import rows


def spread(findings, kind):
    return sorted(o for k, a, b in findings if k == kind for o in range(a, b + 1))


@pytest.mark.parametrize("seed", range(200))
def test_ranges_say_what_offsets_say(seed):
    rng = random.Random(seed)
    offsets = [o for o in range(5, 40) for _ in range(rng.choice([0, 1, 1, 1, 2]))]
    rng.shuffle(offsets)
    batches = [offsets[i::4] for i in range(4)] if seed % 2 else [sorted(offsets)[i : i + 9] for i in range(0, len(offsets), 9)]
    seen, missing, count, late = None, [], {}, []
    for batch in batches:
        ranges = list(c.to_ranges(np.array(batch, np.int64)))
        assert sorted(o for a, b in ranges for o in range(a, b + 1)) == sorted(batch)
        findings, seen, missing = c.follow(ranges, seen, missing) if ranges else ([], seen, missing)
        repeated = spread(findings, c.REPEATED)
        want = []
        for o in sorted(batch):
            if count.get(o):
                want.append(o)
            count[o] = count.get(o, 0) + 1
        assert repeated == want
        late += spread(findings, c.LATE)
    left = [o for a, b in missing for o in range(a, b + 1)]
    assert left == [o for o in range(min(count), max(count) + 1) if o not in count] and not set(left) & set(late)


def test_many_gaps_are_gone_through_once():
    count, began = 20_000, time.monotonic()
    findings, seen, missing = c.follow([(13 * i, 13 * i + 11) for i in range(count)], None, [])
    assert missing == [(13 * i + 12, 13 * i + 12) for i in range(count - 1)] and len(findings) == count - 1
    findings, seen, missing = c.follow([(13 * i + 12, 13 * i + 12) for i in range(0, count, 2)], seen, missing)
    assert [k for k, _, _ in findings] == [c.LATE] * (count // 2) and missing == [(13 * i + 12, 13 * i + 12) for i in range(1, count - 1, 2)]
    assert seen == (0, 13 * count - 2) and time.monotonic() - began < 10


def test_state_goes_on_after_a_restart(spark, place):
    kind = "topic string, partition int, offset long"

    def send(values):
        spark.createDataFrame(values, kind).write.mode("append").parquet(place("topic"))

    def catch_up(**options):
        stream = c.findings(spark.readStream.schema(kind).parquet(place("topic")), **options)
        control.run_streams(spark, [stream.writeStream.format("parquet").option("checkpointLocation", place("check")).trigger(availableNow=True).start(place("out"))])
        return rows(spark.read.schema(c.FINDINGS).parquet(place("out")), "topic", "partition", "kind", "first", "last")

    send([("a", 0, o) for o in (0, 1, 2, 5)] + [("b", 1, 7), ("b", 1, None), (None, 0, 3)])
    assert catch_up() == [("a", 0, "missing", 3, 4)]
    send([("a", 0, o) for o in (4, 6, 6)] + [("b", 1, 9)])
    assert catch_up() == sorted([
        ("a", 0, "missing", 3, 4), ("a", 0, "late", 4, 4), ("a", 0, "repeated", 6, 6), ("b", 1, "missing", 8, 8),
    ], key=repr)
    send([("a", 0, 9)])
    with pytest.raises(Exception, match="offsets 3 to 3 are missing"):
        catch_up(fail_on_data_loss=True)
