"""Training, comparison, storage and application of delinquency classifiers."""
