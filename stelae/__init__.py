"""stelae: a Spark-native standards-graph, schema-mapping and corpus-preparation engine."""
