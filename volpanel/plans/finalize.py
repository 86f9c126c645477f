"""Finalise the shipped model: documented walk-forward record, refit on all rows, bundle."""

from __future__ import annotations

from pyspark.sql import DataFrame

from volpanel.operators import linear
from volpanel.plans.evaluate import documented_metrics
from volpanel.plans.serve import model_row
from volpanel.schemas import TARGET, V1
from volpanel.session import reuse
from volpanel.sources.models import model_meta, save_model


def finalize(clean: DataFrame, feats: list[str] = V1) -> tuple[DataFrame, DataFrame]:
    """(model row with documented metrics, metadata row) for the linear model on ``feats``."""
    clean = reuse(clean)
    record = documented_metrics(clean, feats)
    coefs = linear.fit(clean, feats, TARGET)
    return model_row(coefs, feats, record), model_meta(clean)


def finalize_and_save(clean: DataFrame, path: str, feats: list[str] = V1) -> None:
    model, meta = finalize(clean, feats)
    save_model(model, meta, path, tickers=clean)
