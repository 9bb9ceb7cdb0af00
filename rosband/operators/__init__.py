"""DataFrame -> DataFrame steps of the price-band and average-price jobs."""
