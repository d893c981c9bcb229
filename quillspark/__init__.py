"""Evidence analytics as Spark jobs: scoring, audit, identity and text operators over DataFrames."""
