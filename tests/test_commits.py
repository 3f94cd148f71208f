"""Atomic publication: sinks, batch jobs and models."""
import os

import pytest
from pyspark.sql import functions as F

from stridex.sources import models, sinks
from stridex.sources.commits import CommitLog


def _local(path):
    return path.removeprefix("file:")


def _rows(spark, n, name="u"):
    return spark.range(n).select(F.concat(F.lit(name), "id").alias("user_id"), F.lit(1).cast("long").alias("timestamp"),
                                 F.lit("Walking").alias("prediction"))


def test_a_key_is_published_once(spark, tmp_shared):
    log = CommitLog(spark, tmp_shared("log"))
    assert log.keys() == [] and log.entry("a") is None and not log.exists()
    first = log.publish("a", lambda f: _rows(spark, 3).write.parquet(f), place="p=1")
    second = log.publish("a", lambda f: pytest.fail("written again"))
    assert first == second and spark.read.parquet(first.folder).count() == 3 and log.keys() == ["a"]
    other = CommitLog(spark, log.path)
    assert other.entry("a").folder == first.folder


def test_of_two_attempts_one_is_published(spark, tmp_shared):
    """A second writer publishes while the first still writes: the first finds its key taken and removes its folder."""
    path = tmp_shared("log")
    slow, fast = CommitLog(spark, path), CommitLog(spark, path)
    folders = []

    def write(folder):
        _rows(spark, 2).write.parquet(folder)
        folders.append(folder)
        if len(folders) == 1:
            fast.publish("a", write)
    got = slow.publish("a", write)
    assert got.folder == folders[1] and not os.path.exists(_local(folders[0]))
    assert os.path.exists(_local(folders[1]))
    assert not [f for f in os.listdir(_local(f"{path}/_commits")) if f.endswith(".tmp")]


def test_half_written_folder_is_invisible(spark, tmp_shared):
    path = tmp_shared("sink")
    sinks.append_predictions(_rows(spark, 2), path, run="one")

    def dies(folder):
        _rows(spark, 50, "ghost").write.parquet(folder)
        raise RuntimeError("lost")
    log = CommitLog(spark, path)
    with pytest.raises(RuntimeError):
        log.publish("run=two,batch_id=000000000000", dies, place="run=two/batch_id=0")
    assert sinks.read_predictions(spark, path).count() == 2
    assert log.vacuum() == []                                    # too young to be dead
    gone = log.vacuum(older_than=-60)
    assert len(gone) == 1 and "run=two" in gone[0] and sinks.read_predictions(spark, path).count() == 2
    sinks.append_predictions(_rows(spark, 3), path, run="two")
    assert sinks.read_predictions(spark, path).count() == 5


def test_a_plain_table_is_read(spark, tmp_shared):
    path, dead = tmp_shared("plain"), tmp_shared("dead")
    _rows(spark, 4).write.parquet(path)
    assert sinks.read_predictions(spark, path).count() == 4
    _rows(spark, 4).write.parquet(f"{dead}/data/run=x/batch_id=0/attempt=1")      # a first attempt that was never published
    assert sinks.read_predictions(spark, dead).count() == 0


def test_batches_and_runs(spark, tmp_shared):
    path = tmp_shared("sink")
    assert sinks.read_predictions(spark, path, with_batch=True).columns == ["user_id", "timestamp", "prediction", "run", "batch_id"]
    for run, batch in (("r1", 0), ("r1", 1), ("r1", 1), ("r2", 0), ("r1", 0)):
        sinks.write_batch(_rows(spark, 2 + batch), path, run, batch)
    got = sinks.read_predictions(spark, path, with_batch=True).groupBy("run", "batch_id").count().collect()
    assert sorted(map(tuple, got)) == [("r1", 0, 2), ("r1", 1, 3), ("r2", 0, 2)]
    sinks.append_predictions(_rows(spark, 1), path)               # without an id each run is its own
    sinks.append_predictions(_rows(spark, 1), path)
    assert sinks.read_predictions(spark, path).count() == 9


def test_a_save_that_dies_leaves_the_model_before(spark, tmp_shared):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(float(i % 2), Vectors.dense([float(i)])) for i in range(20)], ["label", "features"])
    model = DecisionTreeClassifier(maxDepth=3).fit(df)
    path = tmp_shared("model")
    models.save_model(model, path)

    class Dies:
        def write(self):
            return self

        def save(self, folder):
            model.write().save(folder + "/half")
            raise RuntimeError("lost")
    with pytest.raises(RuntimeError):
        models.save_model(Dies(), path)
    assert models.load_tree(path).toDebugString == model.toDebugString
    for n in range(2, 7):
        assert models.publish_model(model, path) == n
    assert len(models._versions(CommitLog(spark, path))) == models.KEEP
    plain = tmp_shared("plain")
    model.write().save(plain)                                     # a model saved without versions still loads
    assert models.load_tree(plain).depth == model.depth


def test_predict_and_store_returns_the_stored_rows(spark, tmp_shared):
    from fixtures import m1
    from stridex.plans import prediction as pred
    from stridex.plans import training as tr
    samples = m1(spark, users=4, extra_user=False)
    model = tr.train_models(tr.labeled_points(samples), models=("tree",)).tree
    live, path = samples.drop("activity"), tmp_shared("out")
    first = sorted(map(tuple, pred.predict_and_store(live, model, path, run="x", n=20).collect()))
    again = sorted(map(tuple, pred.predict_and_store(live, model, path, run="x", n=20).collect()))
    assert first == again == sorted(map(tuple, sinks.read_predictions(spark, path).collect()))      # time stamps too
