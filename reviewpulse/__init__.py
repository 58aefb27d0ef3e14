"""Review analytics as Spark jobs: cleaning, profiling, sampling, warehouse checks and monitoring."""
