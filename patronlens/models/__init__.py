"""Segmentation, lifetime value, churn, anomalies, topics and insights."""
