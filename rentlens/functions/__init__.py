"""Column expressions, exact quantiles and small numeric helpers."""
