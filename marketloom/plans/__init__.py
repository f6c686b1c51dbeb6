"""Composites: marts, knowledge graph, run reports, the daily run."""
