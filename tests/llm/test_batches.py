"""Arrow batches bounded by bytes."""

import pyarrow as pa
from pyspark.sql import functions as F

from loadlake.llm import common


def test_batches_are_bounded_by_bytes(spark):
    """Rows of 200 kB come a few at a time, not 10,000 at once."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [batch.nbytes]})

    @common.shipping
    def told(session):
        rows = session.range(0, 200, 1, 1).select(F.repeat(F.lit("x"), 200_000).alias("text"))
        return rows.mapInArrow(sizes, "n long, size long").collect()

    found = told(spark)
    assert sum(r.n for r in found) == 200 and max(r.size for r in found) < 2 * common.BATCH_BYTES
