"""Feature layers, reorder prediction and top-N recommendation as Spark jobs."""
