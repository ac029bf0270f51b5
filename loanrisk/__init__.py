"""Loan-risk analytics on Spark: raw loan records to scored loans, as plain DataFrame steps."""
