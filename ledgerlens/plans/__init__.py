"""Analyses as lazy DataFrame plans, parameterised by column names."""
