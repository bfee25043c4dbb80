"""Audio listening analytics on Spark: sources, cleaning, monthly marts, views."""
