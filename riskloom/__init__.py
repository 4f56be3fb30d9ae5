"""Loan-risk feature building, checking and scoring on Spark DataFrames."""
