"""Whole workflows, from a table to predictions and metrics."""

from tabfold.plans.classification import classify, late_flights
from tabfold.plans.regression import arrival_delay, tuned_regression
from tabfold.plans.segmentation import segment, segment_customers
from tabfold.plans.sentiment import sentiment, tweet_sentiment

__all__ = [
    "arrival_delay",
    "classify",
    "late_flights",
    "segment",
    "segment_customers",
    "sentiment",
    "tuned_regression",
    "tweet_sentiment",
]
