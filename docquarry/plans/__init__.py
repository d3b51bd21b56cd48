"""Whole requests: one search, many searches at once, and the postings tables behind them."""
