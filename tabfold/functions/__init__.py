from tabfold.functions.hashing import hash_bucket
from tabfold.functions.labels import cast_label, threshold_label
from tabfold.functions.tokens import split_words, without_words, word_counts
from tabfold.functions.vectors import as_array, rescale, squared_distance

__all__ = [
    "as_array",
    "cast_label",
    "hash_bucket",
    "rescale",
    "split_words",
    "squared_distance",
    "threshold_label",
    "without_words",
    "word_counts",
]
