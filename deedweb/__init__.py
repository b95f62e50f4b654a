"""Property-ownership linkage on Spark: cleaning, matching and networks as DataFrame operators."""
