"""rollmill: rollout curation and training-data preparation as Spark DataFrame operators."""
