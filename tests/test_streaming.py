"""Row-local columns on a stream of files: as one batch, however the files come."""

from pyspark.sql import functions as F

from reviewlens.schema import RAW_REVIEWS
from reviewlens.streaming import reviews as stream
from tests.test_stages import make_reviews


def prepared(df):
    return sorted(map(repr, df.collect()))


def test_files_in_sequence_equal_one_batch(spark, folder):
    odd = [(900, None, None, 0, None, None, None, None), (901, "p", 5, 2, 3, -1, "", "\n")]
    df = spark.createDataFrame(make_reviews(40) + odd, RAW_REVIEWS)
    expected = stream.prepared_columns(df)
    seen = []
    for part in (0, 1):
        df.where(F.pmod("Id", F.lit(2)) == part).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        query = stream.prepare_stream(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", files_per_batch=1)
        query.awaitTermination()
        seen.append(spark.read.parquet(f"{folder}/out").count())
    done = spark.read.parquet(f"{folder}/out")
    assert seen == [21, 42] and dict(done.dtypes) == dict(expected.dtypes)
    assert prepared(done.select(*expected.columns)) == prepared(expected)
    # nothing new: nothing is done again
    stream.prepare_stream(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 42


def test_the_stream_keeps_no_state(spark, folder):
    spark.createDataFrame(make_reviews(4), RAW_REVIEWS).write.parquet(f"{folder}/in")
    plan = stream.prepared_columns(stream.stream_reviews(spark, f"{folder}/in"))
    assert plan.isStreaming and "Aggregate" not in plan._jdf.queryExecution().analyzed().toString()
