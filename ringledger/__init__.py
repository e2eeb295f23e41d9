"""Spark jobs and report operators for combat-sports results."""
