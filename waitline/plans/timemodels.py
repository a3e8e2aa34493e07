"""Three models of the wait on one half split (M14): linear on raw minutes, linear on
log10 minutes mapped back by 10**x, and a random forest on raw minutes, each on the
truncated SVD of a union of text blocks.

``evaluate`` takes the rows of a snapshot's ``combined_time`` stage or any table with
an id, the wait and the blocks' columns.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate as EV
from ..operators import sampling as SP
from . import models as MD
from .variants import VARIANTS

SVD_K = 100
TREES = 30
SEED = 42


def published_blocks() -> Mapping[str, MD.TextBlock]:
    """Title, paragraphs and tags with the reference's document frequency cuts."""
    v = VARIANTS["combined_forest_time"]
    cuts = {k: values[0] for k, values in v.grid.items() if "." in k}
    out = {}
    for name, block in v.blocks.items():
        own = {k.split(".", 1)[1]: x for k, x in cuts.items() if k.startswith(name + ".")}
        out[name] = replace(block, **own)
    return out


def stages(blocks: Mapping[str, MD.TextBlock], svd_k: int = SVD_K) -> list:
    return [*MD.union_stages(blocks, out="features_raw"), MD.TruncatedSvd("features_raw", "features", svd_k)]


def evaluate(
    rows: DataFrame,
    blocks: Mapping[str, MD.TextBlock] | None = None,
    id_col: str = "id",
    wait: str = "elapsed",
    svd_k: int = SVD_K,
    trees: int = TREES,
    depth: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """``variant, mae, n`` of the half that is not fitted. Rows without a wait, or with
    one that has no logarithm, are left out; null texts are empty. Frames cached on the
    way are released."""
    blocks = blocks or published_blocks()
    rows = rows.where(F.col(wait) > 0).withColumn(wait, F.col(wait).cast("double"))
    train, test = SP.train_test_split(rows, id_col, 0.5, seed)
    fitted = MD.fit_staged(stages(blocks, svd_k), train)
    train, test = (fitted.transform(x).select(wait, "features").persist() for x in (train, test))
    found = []
    for name, est, log in (
        ("linear", MD.linear_regression(), False),
        ("linear_log10", MD.linear_regression(), True),
        ("forest", MD.forest_regressor(trees, depth), False),
    ):
        label = F.log10(wait) if log else F.col(wait)
        pred = est.fit(train.withColumn("label", label)).transform(test)
        if log:
            pred = pred.withColumn("prediction", F.pow(F.lit(10.0), "prediction"))
        r = EV.mean_absolute_error(pred, wait, "prediction").first()
        found.append((name, r["mae"], r["n"]))
    train.unpersist()
    test.unpersist()
    MD.release(fitted)
    return rows.sparkSession.createDataFrame(found, "variant string, mae double, n long")
