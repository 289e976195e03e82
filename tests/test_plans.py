"""Plan shape on inputs with many splits: no exchange under tagging and stance, no token x label join."""

import pytest

from clausework.operators import labels as L, scoring, stance as Z
from clausework.plans import pipelines
from clausework.session import scratch_path
from clausework.sources import tables


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()          # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def many_splits(spark, sf_small):
    """The documents as 12 files, read back as a plain scan."""
    path = scratch_path(spark, "splits")
    tables.stance_input(spark, sf_small).repartition(12).write.parquet(path)
    return spark.read.parquet(path)


def test_tag_has_no_exchange(spark, many_splits):
    vocab = spark.createDataFrame([(0, "de"), (1, "en")], "label_id int, label string")
    plan = _plan(pipelines.tag(many_splits, scoring.hash_head(vocab), vocab))
    assert "Exchange" not in plan and "Join" not in plan and "Generate" not in plan
    assert plan.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("options", [{}, {"templates": Z.TEMPLATES_FIRST_VERSION}, {"pair_model": scoring.overlap_pair_model},
                                     {"templates": [("positive", "Ünd {actor}"), ("negative", "not {actor}")]}])
def test_stance_is_one_projection(many_splits, options):
    plan = _plan(Z.stance(many_splits, **options))
    assert "Exchange" not in plan and "Join" not in plan and "Aggregate" not in plan and "Generate" not in plan


def test_windows_and_cells_need_no_join(spark, many_splits):
    vocab = spark.createDataFrame([(0, "de"), (1, "en")], "label_id int, label string")
    rows = L.with_label_ids(many_splits.selectExpr("row_id", "clause", "array('en', 'zz') AS actors"), vocab)
    plan = _plan(pipelines.training_windows(rows))
    assert "Exchange" not in plan and "Join" not in plan


def test_scan_prunes_columns(spark, sf_small):
    df = tables.table(spark, sf_small, "documents").select("doc_id", "lang")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan


def test_tagging_reads_no_labels(spark, sf_small):
    vocab = spark.createDataFrame([(0, "de"), (1, "en")], "label_id int, label string")
    plan = _plan(pipelines.tag(tables.documents(spark, sf_small), scoring.hash_head(vocab), vocab))
    assert "labels.parquet" not in plan and "Join" not in plan


def test_spread_only_short_scans(spark, sf_small, many_splits):
    from clausework.operators._util import spread

    cores = spark.sparkContext.defaultParallelism
    assert spread(many_splits.select("row_id"), "row_id").rdd.getNumPartitions() >= cores
    many = many_splits.select("row_id")
    assert many.rdd.getNumPartitions() < cores or spread(many, "row_id") is many
    assert tables.documents(spark, sf_small).rdd.getNumPartitions() == cores


def test_checkpoint_folder_of_a_cluster_must_be_named(monkeypatch):
    from clausework import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
