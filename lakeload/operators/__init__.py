"""DataFrame -> DataFrame steps; none of them collects."""
