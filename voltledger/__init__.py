"""Energy-trade analytics and surveillance as Spark jobs."""
