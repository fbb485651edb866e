import os

from fixtures import sales_df
from strata.operators.rollup import Periods, sales_rollup
from strata.streaming.rollup_stream import compact_partials, read_rollup, start_incremental_rollup

SPEC = Periods()


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_incremental_rollup_restart_and_new_file(spark, tmpdir_path):
    df = sales_df(spark)
    src, parts, ckpt = (os.path.join(tmpdir_path, d) for d in ("src", "partials", "ckpt"))
    first = df.where("customer_id <= 4")
    second = df.where("customer_id > 4")
    first.repartition(2).write.parquet(f"{src}/a")
    schema = df.schema

    def run():
        q = start_incremental_rollup(spark, f"{src}/*", schema, parts, ckpt, SPEC,
                                     max_files_per_trigger=1)
        q.awaitTermination()

    run()
    after_first = _rows(read_rollup(spark, parts, SPEC))
    assert after_first == _rows(sales_rollup(first, SPEC))
    run()  # restart on the same checkpoint: nothing new, nothing doubled
    assert _rows(read_rollup(spark, parts, SPEC)) == after_first
    second.write.parquet(f"{src}/b")  # new data arrives
    run()
    assert _rows(read_rollup(spark, parts, SPEC)) == _rows(sales_rollup(df, SPEC))
    one = os.path.join(tmpdir_path, "compacted")
    compact_partials(spark, parts, one)  # a row for each customer says the same
    assert _rows(read_rollup(spark, one, SPEC)) == _rows(sales_rollup(df, SPEC))
    assert spark.read.parquet(one).count() <= spark.read.parquet(parts).count()
