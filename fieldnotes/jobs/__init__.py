"""spark-submit entry points: train, predict, sample, check_ids."""
