"""riskloom: tabular classification and risk scoring as Spark DataFrame jobs."""
