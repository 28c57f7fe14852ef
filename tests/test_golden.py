"""Golden check: the shipped NB parameter files were fitted on 548 rows per
class; rebuilding the recovered counts must give back each theta."""

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import nb

# Beta-prior hyperparameters (a, b) of the shipped fit, the
# recovered first-word counts per class, and the first theta row of each file.
GOLDEN = {
    "Q3": ((13.336718587418781, 0.6174191599884395), (521, 89, 222), (0.9508547, 0.1821087, 0.4187828)),
    "Q7": ((0.2232578131743815, 14.70119762487217), (485, 382, 387), (0.8619687, 0.6789957, 0.6878778)),
    "Q8": ((3.056348578264306, 14.70119762487217), (258, 455, 154), (0.4614280, 0.8096337, 0.2776036)),
}
NK = 548


@pytest.mark.parametrize("q", sorted(GOLDEN))
def test_theta_first_row(spark, q):
    (a, b), counts, expected = GOLDEN[q]
    rows = []
    for k, n in enumerate(counts):
        for i in range(NK):
            rows.append((k * NK + i, k, "w" if i < n else None))
    df = spark.createDataFrame(rows, "id long, y int, token string")
    model = nb.fit(df, df.select("id", "y"), ["Pizza", "Shawarma", "Sushi"], 1.0, a, b)
    theta = model.theta.where(F.col("token") == "w").first()["theta"]
    assert [round(t, 7) for t in theta] == list(expected)
    assert [round(p, 7) for p in model.prior] == [0.3333333] * 3
