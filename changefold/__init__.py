"""changefold: folds change-data-capture logs into analytics tables on Spark."""
