"""DataFrame -> DataFrame steps, the same for batches and streams where not said otherwise."""
