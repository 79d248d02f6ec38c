"""Training-data operators. Nothing outside this folder (and the guarded
registry in ``__spark_entry__``) imports it."""
