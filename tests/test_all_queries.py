"""Every registered query without an oracle runs and gives rows of a stable schema."""

import math

import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL

QUERIES, ORACLES = E.queries(), E.oracle_sql()
REST = sorted(n for n in QUERIES if n not in ORACLES)


@pytest.mark.parametrize("name", REST)
def test_query_without_oracle(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.collect()
    assert rows and all(len(r) == len(df.columns) for r in rows)
    for c, kind in df.dtypes:
        if kind == "double":
            assert not any(r[c] is not None and math.isnan(r[c]) for r in rows), c


def test_explained_rows_are_the_scored_rows(spark):
    scored = {r.c_custkey: r.predicted_class for r in QUERIES["score_batch"](spark, SF_SMALL).collect()}
    explained = {r.c_custkey: r.predicted_class for r in QUERIES["explain_batch"](spark, SF_SMALL).collect()}
    assert explained == scored


def test_the_library_stands_without_the_corpus_operators():
    import subprocess
    import sys
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name.startswith('ledgerlens.llm') or name == 'corpus_pipeline':\n"
            "            raise ModuleNotFoundError('gone', name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as E\n"
            "names = E.queries()\n"
            "assert not any(n.startswith('op') or n == 'pipeline' for n in names), names\n"
            "assert set(E.oracle_sql()) <= set(names) and len(names) > 100\n")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]


def test_importances_are_fitted_at_the_same_time(spark, monkeypatch):
    import threading

    import numpy as np

    from ledgerlens.plans import modeling as MD
    met = threading.Barrier(3, timeout=30)

    class Table:
        def rdd(self):
            return None

    def fit(k):
        met.wait()                                     # breaks unless all three fits are under way
        return np.eye(3)[k]

    monkeypatch.setattr(MD, "_split", lambda *_: (None, None, ["a", "b", "c"]))
    monkeypatch.setattr(MD, "binned_matrix", lambda *_: Table())
    monkeypatch.setattr(MD, "importance_sources", lambda *_: {
        n: lambda k=k: fit(k) for k, n in enumerate(("Random Forest", "GBT A (Tuned)", "GBT B (Tuned)"))})
    first = [(r.model, r.place, r.feature) for r in MD.q_importance_all(spark, "").collect() if r["rank"] == 1]
    assert first == [("GBT B (Tuned)", 1, "c"), ("GBT A (Tuned)", 2, "b"), ("Random Forest", 3, "a")]


def test_importances_come_from_every_model_in_the_order(spark, monkeypatch):
    import numpy as np

    from ledgerlens.plans import modeling as MD

    class Fitted:
        """Any of the models, with importances of its own."""

        def __init__(self, n):
            self.featureImportances = self
            self.toArray = self.splits = self.gains = lambda: np.arange(3.0) + n

        def rdd(self):
            return None

    monkeypatch.setattr(MD, "_split", lambda *_: (None, None, ["a", "b", "c"]))
    monkeypatch.setattr(MD, "binned_matrix", lambda *_: Fitted(0))
    monkeypatch.setattr(MD, "fitted_search", lambda *a: (Fitted({"search_gbt_b": 1, "search_gbt_a": 2}[a[2]]), []))
    monkeypatch.setattr(MD, "fitted_early", lambda *_: Fitted(3))
    monkeypatch.setattr(MD, "fitted_weighted", lambda *_: Fitted(4))
    monkeypatch.setattr(MD, "fitted_forest_search", lambda *_: Fitted(5), raising=False)
    monkeypatch.setattr(MD, "fitted", lambda *a: Fitted({"rf": 6, "gbt": 7}[a[2]]))
    got = [tuple(r) for r in MD.q_importance_all(spark, "").orderBy("place", "rank").collect()]
    assert got == [(n, k + 1, j + 1, "cba"[j], 2.0 - j + k + 1) for k, n in enumerate(MD.IMPORTANCE_ORDER) for j in range(3)]


def test_the_searches_of_search_draws_run_at_the_same_time(spark, monkeypatch):
    import threading
    from collections import namedtuple

    from ledgerlens.plans import modeling as MD
    met, mean = threading.Barrier(2, timeout=30), {"draw": 3, "auc": 0.7}

    def fitted_search(spark, sf_dir, key):
        met.wait()                                     # breaks unless both searches are under way
        return None, [mean]

    monkeypatch.setattr(MD, "binned_matrix", lambda *_: None)
    monkeypatch.setattr(MD, "fitted_search", fitted_search)
    got = [(r.search, r.place, r.draw, r.rate, r.cv_mean_auc) for r in MD.q_search_draws(spark, "").collect()]
    assert got == [(k, 1, 3, round(MD.drawn_params(k)[3].rate, 6), 0.7) for k in MD.BOOSTED_SEARCHES]


def test_the_forest_search_has_few_large_partitions(spark, monkeypatch):
    from types import SimpleNamespace

    from pyspark.ml.linalg import Vectors

    from ledgerlens.plans import modeling as MD
    tr = spark.createDataFrame([(i, i % 2, float(i % 2), 1.0, Vectors.dense([i % 5])) for i in range(90)],
                               [MD.KEY, MD.TARGET, "label", "weight", "features"]).repartition(9)
    monkeypatch.setattr(MD, "_CACHE", {})
    monkeypatch.setattr(MD, "_split", lambda *_: (tr, tr, ["a"]))
    monkeypatch.setitem(MD.SEARCHES, "search_rf", ("F", lambda: MD.MO.forest(n_trees=2), 1, {}, {"numTrees": 3}))
    seen = []

    def search(est, space, n_iter, df, fold, parallelism):
        seen.append((df.rdd.getNumPartitions(), df.count()))
        return SimpleNamespace(bestModel=SimpleNamespace(extractParamMap=dict))

    monkeypatch.setattr(MD.SP, "kfold", lambda df, *a, **k: df)
    monkeypatch.setattr(MD.MO, "random_search", search)
    for small in (100, 50):                            # few rows stay as they are
        MD._CACHE.clear()
        monkeypatch.setattr(MD.MO, "FOREST_ROWS", 40)
        monkeypatch.setattr(MD.MO, "FOREST_SMALL", small)
        assert MD.fitted_forest_search(spark, "", "search_rf").getNumTrees == 3
    assert seen == [(9, 90), (3, 90)]
