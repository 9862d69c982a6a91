"""corpusflow: corpus preparation and rollout analytics as lazy Spark plans."""
