"""martkit: reporting tables, quality gates and simple forecasts as PySpark jobs."""
