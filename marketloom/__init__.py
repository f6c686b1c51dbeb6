"""A retail warehouse on Spark: raw text -> validated tables -> marts -> knowledge graph."""
