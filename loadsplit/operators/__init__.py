"""DataFrame -> DataFrame stages of the pipeline."""
