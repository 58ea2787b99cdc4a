"""Whole jobs made from the operators: split, train, predict, evaluate, report."""
