"""Scalar column expressions and the code lists behind them."""
