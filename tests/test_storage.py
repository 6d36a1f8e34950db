import time
from pathlib import Path

from turnwright.llm import op6_join
from turnwright.session import Shelf, stored


def test_a_stored_table_leaves_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {str(f) for top in disk.localDirs() for f in Path(str(top)).rglob("shuffle_*")}
    before = files()
    stored(spark.range(1000).repartition(3).groupBy("id").count())
    for _ in range(50):  # executors delete them by the way
        left = {f for f in files() - before if f.endswith(".data")}
        if not left:
            return
        time.sleep(0.1)
    raise AssertionError(left)


def test_a_shelf_takes_its_tables_with_it(spark):
    shelf = Shelf(spark)
    assert shelf.put(spark.range(5)).count() == 5
    [path] = shelf.paths
    shelf.clear()
    assert not Path(path.removeprefix("file:")).exists()


def test_marks_hold_all_ids_and_few_others(spark):
    docs = spark.range(20_000).withColumnRenamed("id", "doc_id")
    seen = op6_join.marked(docs, docs.where("doc_id % 100 = 7"))
    assert seen.count() == 20_000
    assert seen.where("doc_id % 100 = 7 and not __marked").isEmpty()
    assert seen.where("doc_id % 100 <> 7 and __marked").count() < 100
