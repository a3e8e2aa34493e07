"""The reference's named model variants (J16) with their parameter grids.

Each variant is a ``Variant``: text blocks, whether a truncated SVD sits
between the union and the estimator, an estimator builder and the grid.
Grid keys are ``<block>.<field>`` for text-block fields (``min_df``,
``max_df``, ``ngram_max``), ``svd_k``, and estimator keys (``C``,
``depth``). ``run_variant`` feeds them to ``tuning.grid_search``; only
feature keys trigger a feature refit.

The full grids are listed as published; running them is a choice of the
caller (some hold hundreds of candidates).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from ..functions.text import english_stop_words
from . import models as MD
from . import tuning as TU

# fixed values: the list itself is a constant, nothing is read at import
STOP = english_stop_words()


def _title(**kw):
    return MD.TextBlock("title", "lemmas", stop_words=STOP, **kw)


def _paragraphs(**kw):
    return MD.TextBlock("paragraphs", "lemmas", stop_words=STOP, **kw)


def _tags(**kw):
    return MD.TextBlock("tags", "tags", **kw)


def _badges(**kw):
    return MD.TextBlock("badges", "words", **kw)


@dataclass
class Variant:
    name: str
    blocks: Mapping[str, MD.TextBlock]
    estimator: Callable[[dict, int], object]
    grid: Mapping[str, Sequence]
    kind: str = "classification"
    folds: int = 3
    svd: bool = False
    label: str = "success"
    normalize: bool = False  # unit rows between SVD and estimator

    def feature_grid(self) -> dict:
        return {k: v for k, v in self.grid.items() if "." in k or k == "svd_k"}

    def estimator_grid(self) -> dict:
        return {k: v for k, v in self.grid.items() if "." not in k and k != "svd_k"}

    def feature_stages(self, params: dict, tokenize: bool = True) -> list:
        blocks = {}
        for name, b in self.blocks.items():
            kw = {k.split(".", 1)[1]: v for k, v in params.items() if k.startswith(name + ".")}
            blocks[name] = replace(b, **kw)
        if not self.svd:
            return MD.union_stages(blocks, tokenize=tokenize)
        stages = MD.union_stages(blocks, out="features_raw", tokenize=tokenize)
        k = params.get("svd_k", 100)
        if not self.normalize:
            return [*stages, MD.TruncatedSvd("features_raw", "features", k)]
        from pyspark.ml.feature import Normalizer

        return [*stages, MD.TruncatedSvd("features_raw", "features_svd", k), Normalizer(inputCol="features_svd", outputCol="features", p=2.0)]


def _weighted(blocks: dict, w: float) -> dict:
    return {k: replace(b, weight=w) for k, b in blocks.items()}


def _svc(p, n):
    return MD.linear_svc(p["C"], n, weight_col="weight")


def _logistic(p, n):
    return MD.logistic(p["C"], n)


def _rf_class(p, n):
    return MD.forest_classifier(50, p["depth"], weight_col="weight")


def _rf_reg(trees):
    return lambda p, n: MD.forest_regressor(trees, p["depth"])


# fixed values: the published grids, one dict per variant
VARIANTS: dict[str, Variant] = {
    "content_svm": Variant(
        "content_svm",
        _weighted({"title": _title(), "paragraphs": _paragraphs(), "tags": _tags()}, 0.33),
        _svc,
        {
            "title.max_df": [0.8, 0.6, 0.4], "title.min_df": [1],
            "paragraphs.max_df": [0.8, 0.6, 0.4], "paragraphs.min_df": [1, 5, 10],
            "tags.max_df": [1.0, 0.8, 0.6, 0.4], "tags.min_df": [1],
            "C": [0.001, 0.01, 1.0, 10.0],
        },
    ),
    "tags_svm": Variant(
        "tags_svm",
        {"tags": _tags()},
        _svc,
        {"tags.max_df": [1.0, 0.8, 0.6, 0.4, 0.2], "tags.min_df": [1], "C": [0.001, 0.01, 1.0, 10.0]},
    ),
    "content_forest": Variant(
        "content_forest",
        _weighted({"title": _title(), "paragraphs": _paragraphs(), "tags": _tags()}, 0.33),
        _rf_class,
        {
            "title.max_df": [0.8, 0.6, 0.4], "title.min_df": [1],
            "paragraphs.max_df": [0.8, 0.6, 0.4], "paragraphs.min_df": [1, 5, 10],
            "tags.max_df": [1.0, 0.8, 0.6, 0.4], "tags.min_df": [1],
            "depth": [10, 20, 30, 40, 50, 60],
        },
    ),
    "content_forest_time": Variant(
        "content_forest_time",
        _weighted({"title": _title(), "paragraphs": _paragraphs(), "tags": _tags()}, 0.33),
        _rf_reg(20),
        {
            "title.max_df": [0.8, 0.6, 0.4], "title.min_df": [1],
            "paragraphs.max_df": [0.8, 0.6, 0.4], "paragraphs.min_df": [1, 5, 10],
            "tags.max_df": [1.0, 0.8, 0.6, 0.4], "tags.min_df": [1],
            "depth": [10, 20, 30, 40, 50, 60],
        },
        kind="regression",
        label="elapsed",
    ),
    "badge_success": Variant(
        "badge_success",
        {"badges": _badges()},
        lambda p, n: MD.forest_classifier(20, p["depth"]),
        {"badges.max_df": [1.0], "badges.min_df": [2], "depth": [20], "svd_k": [512]},
        svd=True,
        normalize=True,
    ),
    "badge_time": Variant(
        "badge_time",
        {"badges": _badges()},
        _rf_reg(20),
        {
            "badges.max_df": [1.0, 0.8, 0.6, 0.4, 0.2], "badges.min_df": [1, 2, 3],
            "depth": [10, 20, 30, 40, 50, 60],
        },
        kind="regression",
        label="elapsed",
    ),
    "combined": Variant(
        "combined",
        {"title": _title(), "paragraphs": _paragraphs(), "tags": _tags()},
        _logistic,
        {
            "title.max_df": [0.6], "title.min_df": [2],
            "paragraphs.max_df": [0.6], "paragraphs.min_df": [8], "paragraphs.ngram_max": [1, 2, 3],
            "tags.max_df": [0.6], "tags.min_df": [2],
            "C": [0.1, 1, 10], "svd_k": [100],
        },
        svd=True,
    ),
    "combined_time": Variant(
        "combined_time",
        {"title": _title(), "paragraphs": _paragraphs(), "tags": _tags()},
        lambda p, n: MD.linear_regression(),
        {
            "title.max_df": [0.6], "title.min_df": [2],
            "paragraphs.max_df": [0.6], "paragraphs.min_df": [8], "paragraphs.ngram_max": [1],
            "tags.max_df": [0.6], "tags.min_df": [2], "svd_k": [100],
        },
        kind="regression",
        folds=2,
        svd=True,
        label="log_elapsed",
    ),
    "combined_forest_time": Variant(
        "combined_forest_time",
        {"title": _title(), "paragraphs": _paragraphs(), "tags": _tags()},
        lambda p, n: MD.forest_regressor(30, None),
        {
            "title.max_df": [0.6], "title.min_df": [2],
            "paragraphs.max_df": [0.6], "paragraphs.min_df": [8], "paragraphs.ngram_max": [1],
            "tags.max_df": [0.6], "tags.min_df": [2], "svd_k": [100],
        },
        kind="regression",
        folds=2,
        svd=True,
        label="elapsed",
    ),
    "badges_logistic": Variant(
        "badges_logistic",
        {"badges": _badges()},
        _logistic,
        {
            "badges.max_df": [1.0, 0.8, 0.6, 0.4, 0.2], "badges.min_df": [2, 4, 8],
            "C": [0.1, 1, 10], "svd_k": [20, 50, 100, 200],
        },
        svd=True,
    ),
    "content_logistic": Variant(
        "content_logistic",
        {"title": _title(), "paragraphs": _paragraphs(), "tags": _tags()},
        _logistic,
        {
            "title.max_df": [1.0, 0.8, 0.6, 0.4, 0.2], "title.min_df": [2, 4, 8],
            "paragraphs.max_df": [1.0, 0.8, 0.6, 0.4, 0.2], "paragraphs.min_df": [2, 4, 8],
            "tags.max_df": [1.0, 0.8, 0.6, 0.4, 0.2], "tags.min_df": [2, 4, 8],
            "C": [0.1, 1, 10], "svd_k": [100, 200, 300],
        },
        svd=True,
    ),
    "tags_logistic": Variant(
        "tags_logistic",
        {"tags": _tags()},
        _logistic,
        {"tags.max_df": [0.6], "tags.min_df": [1], "C": [0.1], "svd_k": [100]},
        svd=True,
    ),
}


def candidates(v: Variant) -> int:
    n = 1
    for vals in v.grid.values():
        n *= len(vals)
    return n


def run_variant(
    v: Variant, df: DataFrame, fold_col: str = "fold", parallelism: int = 2, grid=None
) -> DataFrame:
    """Grid-search one variant on ``df`` (which carries ``label`` and folds);
    ``grid`` overrides the published one (e.g. a small slice)."""
    g = dict(grid) if grid is not None else dict(v.grid)
    run = replace(v, grid=g)
    return TU.grid_search(
        df,
        # tokens depend on column and kind only: tokenise once for all folds
        feature_stages=lambda p: run.feature_stages(p, tokenize=False),
        prepare=MD.tokenize_stages(run.blocks),
        estimator=lambda p, n: run.estimator(p, n).setLabelCol(v.label),
        feature_grid=run.feature_grid(),
        estimator_grid=run.estimator_grid(),
        fold_col=fold_col,
        kind=v.kind,
        label=v.label,
        parallelism=parallelism,
        weight_col="weight" if "weight" in df.columns else None,
    )
