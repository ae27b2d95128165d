"""Operators for preparing training data: ten DataFrame-in, DataFrame-out modules and their queries."""
