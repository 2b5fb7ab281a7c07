"""tessera: a Spark-native record-linkage and corpus-processing engine."""
