import time

import numpy as np
import pyarrow as pa

from umbu.llm import neighbours, tables
from umbu.llm.line_dedup import COUNT_BITS, word_counts


def test_what_a_write_has_shuffled_goes_with_it(spark):
    """Else it stays on disk until the driver happens to collect garbage."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {files.apply(i).getName() for i in range(files.length()) if files.apply(i).getName().endswith(".data")}

    before, setting = shuffled(), spark.conf.get(tables._FILES_GO, "false")
    kept = tables.keep(spark.range(10_000).repartition(4, "id"), "kept")
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffled() - before
    assert spark.conf.get(tables._FILES_GO, "false") == setting
    assert kept.count() == 10_000


def test_rounds_write_over_what_no_one_reads_any_more(spark, monkeypatch):
    for name, value in (("LEAF", 100), ("PART_NODES", 300), ("QUERY_BLOCK", 7), ("SAMPLE", 256)):
        monkeypatch.setattr(neighbours, name, value)
    places, keep = {}, tables.keep

    def kept(df, purpose, place=None):
        out = keep(df, purpose, place)
        places.setdefault(purpose, []).append(out.inputFiles()[0].rsplit("/", 1)[0])
        return out

    monkeypatch.setattr(neighbours, "keep", kept)
    random = np.random.default_rng(3)
    rows = [(i, random.normal(size=16).tolist()) for i in range(1000)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = neighbours.search(vectors, vectors.where("vec_id % 50 = 0"), 5)
    assert got.count() == 100
    assert len(places["graph"]) > 2 and len(places["lists"]) > 1 and len(places["opened"]) > 1
    assert len({*places["graph"]}) == 2 and len({*places["pools"]}) <= 2
    assert len({*places["lists"]}) == len({*places["opened"]}) == 1


def test_counts_are_summed_without_python_of_rows(spark, monkeypatch):
    """A second Python worker for each task takes memory from the first."""
    parts = spark.range(4).repartition(4).mapInArrow(
        lambda batches: tables.counted(np.bincount(np.concatenate([b.column(0).to_numpy() for b in batches] or [[0]]).astype(int), minlength=6)),
        tables.COUNTED,
    )
    assert tables.summed(parts, 6)[1:].tolist() == [1, 1, 1, 0, 0]
    assert not [*tables.counted(np.zeros(3, np.int64))]
    sizes = [b.num_rows for b in tables.counted(np.ones((1 << 16) + 1, np.int64))]
    assert sizes == [1 << 16, 1] and pa.types.is_int64(next(tables.counted(np.ones(1, np.int64))).column(0).type)
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.rdd", property(lambda df: 1 / 0))
    counts = word_counts(spark.createDataFrame([("a b a",), (None,), ("B\n",)], "text string"))
    assert len(counts) == 1 << COUNT_BITS and sorted(counts[counts > 0]) == [2, 2]
