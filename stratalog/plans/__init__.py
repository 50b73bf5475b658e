"""Operator chains that make up a whole job."""
