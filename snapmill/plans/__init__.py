"""Compositions of operators: training sets, model training and batch scoring."""
