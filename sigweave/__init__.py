"""sigweave: Spark-native operators that turn versioned report archives into a weighted, pruned graph."""
