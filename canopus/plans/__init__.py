"""Composite jobs (vectorise, cluster, dump, all) and cluster report writers."""
