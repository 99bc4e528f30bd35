"""Trip analytics on Spark: raw monthly trip files to a cleaned, modelled and checked warehouse."""
