"""Text retrieval and evaluation on Spark: chunk, encode, rank, fuse, filter and score whole tables."""
