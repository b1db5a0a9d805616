"""Feature pipelines, classifiers, search and evaluation."""
