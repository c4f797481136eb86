"""millrace: a kit of PySpark jobs and DataFrame operators for retail and trip data."""
