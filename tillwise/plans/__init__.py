"""Plans: the warehouse build, the query catalogue and the end-to-end run."""
