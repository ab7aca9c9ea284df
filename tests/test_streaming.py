from __future__ import annotations

from truegrain.operators import scalar
from truegrain.streaming.monitor import failures, monitor, read_results


def test_every_batch_is_judged_once(spark, tmp_path):
    source, output, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "id int, grade string"

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def checks(df):
        return [scalar.nulls(df, "grade"), scalar.numeric_range(df, "id", 0, 10)]

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        query = monitor(stream, checks, output, state)
        assert query.awaitTermination(60)

    arrive([(1, None), (50, "A")])
    run()
    arrive([(2, None), (3, None)])
    run()
    results = read_results(spark, output)
    assert results.select("batch_id").distinct().count() == 2
    found = {r["test"]: (r["batches"], r["violations"]) for r in failures(results).collect()}
    assert found == {"check_nulls": (2, 3), "validate_numeric_range": (1, 1)}
