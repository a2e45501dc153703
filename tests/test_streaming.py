import numpy as np
import pandas as pd

from tickwise.operators import forest
from tickwise.streaming.scoring import read_rows, score_stream, write_flagged


def test_a_stream_gets_the_batch_scores(spark, tmp_path):
    rng = np.random.default_rng(8)
    base = spark.createDataFrame(pd.DataFrame({"x": rng.normal(size=400), "y": rng.normal(size=400)}))
    fitted = forest.fit(base, ["x", "y"], (), forest.Settings(n_estimators=20))
    fresh = spark.createDataFrame(pd.DataFrame({"x": [0.0, 30.0, 0.1], "y": [0.0, 30.0, 0.2]}))
    fresh.write.parquet(str(tmp_path / "in"))
    stream = read_rows(spark, str(tmp_path / "in"), fresh.schema)
    query = write_flagged(
        score_stream(stream, fitted), str(tmp_path / "out"), str(tmp_path / "progress")).trigger(availableNow=True).start()
    assert query.awaitTermination(60)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    want = forest.score(fresh, fitted).where("flagged").collect()
    assert got == want and [r["x"] for r in got] == [30.0]
