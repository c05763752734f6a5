"""Entity-feature and audience-scoring operators expressed as Spark plans."""
