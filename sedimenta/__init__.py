"""Document-corpus analytics on Spark: scan, extract, clean, identify, chunk, vectorise."""
