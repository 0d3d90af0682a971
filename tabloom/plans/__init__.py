"""Stages that combine operators, and the full run."""
