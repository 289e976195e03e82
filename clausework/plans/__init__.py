"""End-to-end pipelines and the driver's query registry."""
