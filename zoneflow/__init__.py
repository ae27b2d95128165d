"""zoneflow: zoning-document extraction, edit audit and land-use analytics as Spark jobs."""

__version__ = "0.1.0"
