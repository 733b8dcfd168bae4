import pyarrow as pa
from pyspark.sql import functions as F

from codesift.session import ARROW_BATCH_BYTES, ship_package

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def largest_batch(session) -> int:
    rows = session.range(0, 800, 1, 1).select(F.repeat(F.lit("x"), 20_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

    return rows.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]


def test_batches_of_whole_texts_are_bounded_by_bytes(spark):
    bare = spark.newSession()
    bare.conf.unset(SETTING)
    ship_package(bare)
    assert largest_batch(bare) <= ARROW_BATCH_BYTES + 100_000


def test_a_bound_of_the_session_stays(spark):
    own = spark.newSession()
    own.conf.set(SETTING, "1000000")
    ship_package(own)
    assert own.conf.get(SETTING) == "1000000" and largest_batch(own) <= 1_100_000
