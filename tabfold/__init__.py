"""Table analytics and model building as plain PySpark DataFrame functions."""
