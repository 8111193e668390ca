from .dates import epoch_date, epoch_day_text, epoch_minute_text, epoch_of, iso_timestamp, run_date
from .labels import METRICS, metric_category, source_label
from .scores import bayesian_rating, guarded_ratio, inverted, weighted_score

__all__ = [
    "METRICS",
    "bayesian_rating",
    "epoch_date",
    "epoch_day_text",
    "epoch_minute_text",
    "epoch_of",
    "guarded_ratio",
    "inverted",
    "iso_timestamp",
    "metric_category",
    "run_date",
    "source_label",
    "weighted_score",
]
