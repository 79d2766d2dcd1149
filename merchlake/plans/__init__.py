"""Whole plans: field mapping, history, price drops, and the registered queries."""
