"""Subscription actions as a stream."""
