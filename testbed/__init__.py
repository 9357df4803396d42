"""Source tables of the pricing domain, derived by plain projections from the driver's tables."""
