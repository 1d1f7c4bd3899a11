"""The staging, intermediate and mart layers."""
