"""Whole batch jobs put together from the operators."""
