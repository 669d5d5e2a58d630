"""Scalar column functions shared by the models."""
