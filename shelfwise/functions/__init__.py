"""Column -> Column functions. All are built-in expressions except Unicode NFKC (Arrow UDF)."""
