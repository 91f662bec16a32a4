"""arrivalmart: star-schema visit analytics as PySpark DataFrame jobs."""
